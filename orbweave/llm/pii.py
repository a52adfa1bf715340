"""Format-preserving pseudonyms of personal numbers, dates and addresses, in DataFrame functions only.

Found kinds: e-mail addresses, IPv4 addresses, dates, telephone numbers, US
social security numbers and payment card numbers. A match is *validated*
(octets up to 255, real calendar dates, number ranges, Luhn check digit);
what fails stays as it is. A valid value goes through a keyed Feistel network
of ``ROUNDS`` rounds over the values of its own format, so

* the pseudonym has the same form (separators, lengths, letter classes), is
  valid again (Luhn digit, calendar, octets, number ranges), and
* the map is a permutation: equal values get equal pseudonyms in all documents
  and different values different ones.

Each round adds a keyed SHA-256 digest of one half to the other half, modulo
that half's size. Kept in clear: an e-mail's domain (its letters tweak the
local part's permutation), a telephone's country code, a card's first digit.

Defined results: a null text stays null; an empty text stays empty; repeated
rows give repeated results; other columns pass unchanged. A format with very
few values (a one-letter local part) may map a value to itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
#: Stands in for a secret; a production job passes its own.
DEFAULT_KEY = "orbweave"

EMAIL = r"(?<![\p{L}\p{M}\p{N}._%+-])[\p{L}\p{M}\p{N}._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IPV4 = r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?!\.?[0-9])"
DATE = r"(?<![0-9])(?:(?:19|20)[0-9]{2}([-/])[0-9]{2}\1[0-9]{2}|[0-9]{2}([-/.])[0-9]{2}\2(?:19|20)[0-9]{2})(?![0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])"
PHONE = (r"(?<![0-9+])\+1[ .-]?\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9])"
         r"|(?<![0-9+])\+[2-9][0-9]{0,2}(?:[ .-]?\(?[0-9]{2,4}\)?){2,4}(?![0-9])"
         r"|(?<![0-9])\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}(?![0-9])"
         r"|(?<![0-9.-])[0-9]{3}([.-])[0-9]{3}\3[0-9]{4}(?![0-9])")
CARD = r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\4[0-9]{4}\4[0-9]{1,7}|[0-9]{4}([ -])[0-9]{6}\5[0-9]{5})(?![0-9])"
PATTERN = "|".join([EMAIL, IPV4, DATE, SSN, PHONE, CARD])

#: Days from 1900-01-01 to 2099-12-31: 17 x 4297.
_DAYS, _DAY_PARTS = 73_049, (17, 4297)
#: Steps along a cycle at most; each leaves two dates in five to go on (after all of them, less than one in 10**70).
_WALK = 180


class _Feistel:
    """Column expressions of the keyed permutations."""

    def __init__(self, key: str):
        self.key = key

    def _digest(self, tweak: Column, i: Column, half: Column) -> Column:
        return F.sha2(F.concat_ws("|", F.lit(self.key), tweak, i.cast("string"), half.cast("string")), 256)

    def numbers(self, left: Column, right: Column, m1: Column, m2: Column, tweak: Column) -> Column:
        """Permute (left, right) of Z_m1 x Z_m2; a struct l, r."""
        def add(i: Column, half: Column) -> Column:
            return F.conv(F.substring(self._digest(tweak, i, half), 1, 13), 16, 10).cast("long")

        def step(s: Column, i: Column) -> Column:
            return F.when(i % 2 == 1, F.struct(F.pmod(s["l"] + add(i, s["r"]), m1).alias("l"), s["r"].alias("r"))).otherwise(
                F.struct(s["l"].alias("l"), F.pmod(s["r"] + add(i, s["l"]), m2).alias("r")))

        begin = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))
        return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), begin, step)

    def digits(self, value: Column, tweak: Column) -> Column:
        """Permute strings of the same number of digits (2 to 30)."""
        n = F.length(value)
        h = F.floor(n / 2).cast("int")
        p1, p2 = F.pow(F.lit(10.0), h).cast("long"), F.pow(F.lit(10.0), n - h).cast("long")
        out = self.numbers(F.substr(value, F.lit(1), h), F.substr(value, h + 1, n), p1, p2, F.concat_ws("|", tweak, n.cast("string")))
        return F.transform(F.array(out), lambda s: F.concat(F.lpad(s["l"].cast("string"), h, F.lit("0")), F.lpad(s["r"].cast("string"), n - h, F.lit("0"))))[0]

    def letters(self, value: Column, tweak: Column) -> Column:
        """Permute strings of the same pattern of small and capital letters, digits and other characters."""
        h = F.floor(F.length(value) / 2).cast("int")

        def shift(text: Column, digest: Column) -> Column:
            def one(c: Column, at: Column) -> Column:
                by = F.conv(F.substr(digest, (at * 3) % 60 + 1, F.lit(3)), 16, 10).cast("int")
                code = F.ascii(c)

                def turned(low: int, n: int, gap: int = 1 << 20) -> Column:
                    """The n characters from ``low`` on, without the one at ``gap``, turned round."""
                    to = (code - low - (code > gap).cast("int") + by) % n + low
                    return F.char(to + (to >= gap).cast("int"))

                return (F.when((code >= 48) & (code <= 57), turned(48, 10)).when((code >= 97) & (code <= 122), turned(97, 26))
                        .when((code >= 65) & (code <= 90), turned(65, 26))
                        .when((code >= 223) & (code <= 255) & (code != 247), turned(223, 32, 247))
                        .when((code >= 192) & (code <= 222) & (code != 215), turned(192, 30, 215)).otherwise(c))

            return F.array_join(F.transform(F.split(text, ""), one), "")

        def step(s: Column, i: Column) -> Column:
            return F.when(i % 2 == 1, F.struct(shift(s["l"], self._digest(tweak, i, s["r"])).alias("l"), s["r"].alias("r"))).otherwise(
                F.struct(s["l"].alias("l"), shift(s["r"], self._digest(tweak, i, s["l"])).alias("r")))

        begin = F.struct(F.substr(value, F.lit(1), h).alias("l"), F.substr(value, h + 1, F.length(value)).alias("r"))
        out = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), begin, step)
        return F.transform(F.array(out), lambda s: F.concat(s["l"], s["r"]))[0]


def _only_digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _refill(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced in order by ``digits``."""
    def step(s: Column, c: Column) -> Column:
        digit = c.rlike("^[0-9]$")
        return F.struct(F.concat(s["t"], F.when(digit, F.substr(digits, s["i"], F.lit(1))).otherwise(c)).alias("t"),
                        (s["i"] + digit.cast("int")).alias("i"))

    return F.aggregate(F.split(shape, ""), F.struct(F.lit("").alias("t"), F.lit(1).alias("i")), step, lambda s: s["t"])


def _luhn_sum(digits: Column, doubled_from: int) -> Column:
    """Sum of the digits from the right, every second one doubled (the last one too if ``doubled_from`` is 0)."""
    def one(c: Column, at: Column) -> Column:
        d = c.cast("int")
        twice = 2 * d
        return F.when(at % 2 == doubled_from, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(d)

    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), one), F.lit(0), lambda a, x: a + x)


def _let(value: Column, body) -> Column:  # noqa: ANN001
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def kind(match: Column) -> Column:
    """email, ipv4, date, ssn, phone or card of a match of PATTERN, null if it isn't valid."""
    digits = _only_digits(match)
    octets = F.split(match, r"\.")
    date = _as_date(match)
    return (F.when(match.contains("@"), F.lit("email"))
            .when(match.rlike(r"^(?:[0-9]{1,3}\.){3}[0-9]{1,3}$"), F.when(F.forall(octets, lambda o: o.cast("int") <= 255), F.lit("ipv4")))
            .when(match.rlike(r"^(?:[0-9]{4}[-/][0-9]{2}[-/][0-9]{2}|[0-9]{2}[-/.][0-9]{2}[-/.][0-9]{4})$"), F.when(date.isNotNull(), F.lit("date")))
            .when(match.rlike(r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$"),
                  F.when(~match.rlike(r"^(?:000|666|9)|-00-|-0000$"), F.lit("ssn")))
            .when(match.rlike(r"^[+(]|^[0-9]{3}[.-][0-9]{3}[.-]"), F.when(F.length(digits).between(8, 15) , F.lit("phone")))
            .when(F.length(digits).between(13, 19) & (_luhn_sum(digits, 1) % 10 == 0), F.lit("card")))


def _parts(match: Column, y: int, m: int, d: int) -> Column:
    p = F.split(match, "[-/.]")
    return F.concat_ws("-", p[y], p[m], p[d]).try_cast("date")


def _as_date(match: Column) -> Column:
    return (F.when(match.rlike("^[0-9]{4}"), _parts(match, 0, 1, 2))
            .when(match.contains("."), _parts(match, 2, 1, 0))
            .otherwise(F.coalesce(_parts(match, 2, 0, 1), _parts(match, 2, 1, 0))))


def pseudonym(match: Column, what: Column, key: str) -> Column:
    """The pseudonym of a match of kind ``what`` (itself if ``what`` is null)."""
    fe = _Feistel(key)
    local, domain = F.substring_index(match, "@", 1), F.substring_index(match, "@", -1)
    email = F.concat(fe.letters(local, F.concat(F.lit("email|"), F.lower(domain))), F.lit("@"), domain)

    o = F.transform(F.split(match, r"\."), lambda x: x.cast("long"))
    word, byte = F.lit(65536).cast("long"), F.lit(256)
    ipv4 = _let(fe.numbers(o[0] * 256 + o[1], o[2] * 256 + o[3], word, word, F.lit("ipv4")),
                lambda s: F.concat_ws(".", *(x.cast("long").cast("string") for x in (F.floor(s["l"] / byte), s["l"] % byte, F.floor(s["r"] / byte), s["r"] % byte))))

    day = F.datediff(_as_date(match), F.lit("1900-01-01").cast("date"))
    a, b = _DAY_PARTS
    first = F.lit("1900-01-01").cast("date")
    # Day first, between slashes or dashes: read so only if the day can't be a month. Else the pseudonym would be
    # another date's, so the permutation is repeated until it reads back as it was written.
    day_first = ~match.rlike("^[0-9]{4}") & ~match.contains(".") & _parts(match, 2, 0, 1).isNull()

    def once(at: Column) -> Column:
        return _let(fe.numbers(F.floor(at / b), at % b, F.lit(a), F.lit(b), F.lit("date")), lambda s: s["l"] * b + s["r"])

    walk = F.array_repeat(F.lit(0), F.when(day_first, _WALK).otherwise(0))
    moved = _let(F.aggregate(walk, once(day.cast("long")), lambda at, _: F.when(F.dayofmonth(F.date_add(first, at.cast("int"))) > 12, at).otherwise(once(at))),
                 lambda at: F.date_add(first, at.cast("int")))
    sep = F.regexp_extract(match, "[-/.]", 0)
    y, m, d = (F.date_format(moved, x) for x in ("yyyy", "MM", "dd"))
    date = (F.when(match.rlike("^[0-9]{4}"), F.concat(y, sep, m, sep, d))
            .when(match.contains(".") | day_first, F.concat(d, sep, m, sep, y))
            .otherwise(F.concat(m, sep, d, sep, y)))

    area, rest = F.substring(match, 1, 3).cast("long"), F.substring(match, 5, 2).cast("long")
    serial = F.substring(match, 8, 4).cast("long")
    ssn = _let(fe.numbers(area - 1 - (area > 666).cast("long"), (rest - 1) * 9999 + serial - 1, F.lit(898), F.lit(99 * 9999), F.lit("ssn")),
               lambda s: F.concat(F.lpad((s["l"] + 1 + (s["l"] >= 665).cast("long")).cast("string"), 3, "0"), F.lit("-"),
                                  F.lpad((F.floor(s["r"] / 9999) + 1).cast("string"), 2, "0"), F.lit("-"),
                                  F.lpad((s["r"] % 9999 + 1).cast("string"), 4, "0")))

    code = F.regexp_extract(match, r"^\+[0-9]{1,3}(?=[ .(-])|^\+[0-9]", 0)
    national = F.substr(match, F.length(code) + 1, F.length(match))
    phone = F.concat(code, _refill(national, fe.digits(_only_digits(national), F.concat(F.lit("phone|"), code))))

    digits = _only_digits(match)
    n = F.length(digits)
    body = F.concat(F.substr(digits, F.lit(1), F.lit(1)), fe.digits(F.substr(digits, F.lit(2), n - 2), F.concat(F.lit("card|"), F.substr(digits, F.lit(1), F.lit(1)))))
    card = _refill(match, _let(body, lambda x: F.concat(x, ((10 - _luhn_sum(x, 0) % 10) % 10).cast("string"))))

    return (F.when(what == "email", email).when(what == "ipv4", ipv4).when(what == "date", date)
            .when(what == "ssn", ssn).when(what == "phone", phone).when(what == "card", card).otherwise(match))


def pseudonymise(docs: DataFrame, key: str = DEFAULT_KEY, column: str = "text", found: str | None = None) -> DataFrame:
    """``docs`` with every valid personal value of ``column`` replaced by its pseudonym.

    ``found``, if given, names a new column of the values' kinds, in text order.
    """
    made = f"__{column}_values"
    while made in docs.columns:
        made = f"_{made}"
    text = F.col(f"`{column}`")
    values = F.transform(F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0)), lambda m: _let(
        kind(m), lambda k: F.struct(k.alias("kind"), pseudonym(m, k, key).alias("value"))))
    rest = F.split(text, PATTERN, -1)
    joined = F.concat(F.array_join(F.transform(F.arrays_zip(F.slice(rest, 1, F.size(F.col(made))).alias("a"), F.col(made).alias("b")),
                                               lambda p: F.concat(p["a"], p["b"]["value"])), ""), F.element_at(rest, -1))
    out = docs.withColumn(made, values).withColumn(column, F.when(F.size(F.col(made)) > 0, joined).otherwise(text))
    if found:
        out = out.withColumn(found, F.filter(F.transform(F.col(made), lambda v: v["kind"]), lambda k: k.isNotNull()))
    return out.drop(made)
