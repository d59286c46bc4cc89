"""Value conversions with rules Spark's casts don't have."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DAY = 86_400_000_000


def _micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp_ntz").cast("timestamp"))


def _tick(scale: int) -> int:
    return 10 ** (6 - min(scale, 6))


def round_timestamp(ts: Column, scale: int) -> Column:
    """A timestamp without zone at 0 to 6 digits of a second: half rounds up and carries into the date. Session zone: UTC."""
    d = _tick(scale)
    x = _micros(ts)
    rest = F.pmod(x, F.lit(d))
    up = F.when(rest * 2 >= d, F.lit(d)).otherwise(0) if d > 1 else F.lit(0)
    return F.timestamp_micros(x - rest + up).cast("timestamp_ntz")


def round_time_micros(micros: Column, scale: int) -> Column:
    """Microseconds of a day at 0 to 6 digits: half rounds up, but never past the day's last tick."""
    d = _tick(scale)
    return F.least(F.floor((micros + d // 2) / d).cast("bigint") * d, F.lit(_DAY - d)).cast("bigint")


def truncate_utf16(text: Column, units: int) -> Column:
    """The longest prefix of at most `units` UTF-16 units; characters beyond the BMP cost two and stay whole."""
    return _prefix(text, units, lambda c: F.when(F.octet_length(c) == 4, 2).otherwise(1), 2)


def truncate_utf8(text: Column, size: int) -> Column:
    """The longest prefix of at most `size` bytes of UTF-8."""
    return _prefix(text, size, F.octet_length, 4)


def _prefix(text: Column, limit: int, cost, most: int) -> Column:
    # few values are too long: only those are looked at character by character
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("used"), F.lit(False).alias("full"))

    def step(acc, c):
        full = acc["full"] | (acc["used"] + cost(c) > limit)
        return F.struct(F.when(full, acc["out"]).otherwise(F.concat(acc["out"], c)).alias("out"), F.when(full, acc["used"]).otherwise(acc["used"] + cost(c)).alias("used"), full.alias("full"))

    chars = F.filter(F.split(F.substring(text, 1, limit), ""), lambda c: c != "")
    cut = F.aggregate(chars, start, step)["out"]
    return F.when(F.length(text) * most <= limit, text).otherwise(F.when(text.isNotNull(), cut))


def narrow(value: Column, remote: str) -> Column:
    """A number as a remote integer type; what doesn't fit raises, also under tinyint's 0 to 255."""
    kinds = {"tinyint": "smallint", "smallint": "smallint", "int": "int", "bigint": "bigint"}
    out = value.cast(kinds[remote])
    if remote != "tinyint":
        return out
    bad = F.raise_error(F.concat(F.lit("value out of range for tinyint: "), out.cast("string"))).cast("smallint")
    return F.when(out.isNull() | out.between(0, 255), out).otherwise(bad)


def canonical_uuid(text: Column) -> Column:
    return F.lower(text)
