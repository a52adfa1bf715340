"""Parameter clamps: values outside a range go to its nearer end, missing or unreadable ones to the default."""

from __future__ import annotations

# Fixed values: (least, most, default) of each parameter.
RANGES = {
    "search_limit": (1, 100, 25),
    "neighborhood_limit": (5, 500, 80),
    "path_hops": (1, 10, 6),
    "algorithm_hops": (1, 4, 2),
    "pagerank_limit": (1, 100, 25),
}


def clamp(value: int, least: int, most: int) -> int:
    return max(least, min(most, int(value)))


def parameter(name: str, value: object = None) -> int:
    """The value to use for a parameter of RANGES."""
    least, most, default = RANGES[name]
    try:
        return clamp(int(value), least, most)  # type: ignore[call-overload]
    except (TypeError, ValueError):
        return default
