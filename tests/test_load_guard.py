"""The load refuses a loaded folder, and can be run again after one that died."""

import pytest

from orbweave.sources import etl


def test_load_guard(make_graph, tmp_path):
    m = etl.mirror(make_graph([(1, ["Officer"], {"name": "a"}), (2, ["Entity"], {"name": "b"})], [(5, "officer_of", 1, 2)]))
    path = str(tmp_path / "mirror")
    m.officers.write.parquet(f"{path}/officers")  # what a load that died leaves
    first = etl.load_graph(m, path).count()
    assert first > 0
    with pytest.raises(RuntimeError):
        etl.load_graph(m, path)
    assert etl.load_graph(m, path, truncate=True).count() == first
