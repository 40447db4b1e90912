"""Row-level column expressions: text match, clamping, keys, hashing."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col, as_list


def text_contains(c, pattern: str, regex: bool = True) -> Column:
    """Case-insensitive contains; null input is False (not null)."""
    pat = pattern if regex else re.escape(pattern)
    return F.coalesce(as_col(c).rlike(f"(?i){pat}"), F.lit(False))


def clamp_zero(c) -> Column:
    """Negative -> 0, null stays null (unlike ``greatest``)."""
    x = as_col(c)
    return F.when(x < 0, F.lit(0)).otherwise(x)


def clamp_columns(cols, keep_suffix: str = "_actual") -> list[Column]:
    """For each column: clamped value under the same name plus the raw copy."""
    out = []
    for name in as_list(cols):
        out.append(clamp_zero(name).alias(name))
        out.append(F.col(name).alias(f"{name}{keep_suffix}"))
    return out


def concat_key(cols, sep: str = "_") -> Column:
    return F.concat_ws(sep, *[as_col(c) for c in as_list(cols)])


def parse_suffix(c, prefix_len: int) -> Column:
    """``d_12`` -> 12: drop a fixed-length prefix and cast to int."""
    return F.substring(as_col(c), prefix_len + 1, 1 << 20).cast("int")


def signed_fraction(c) -> Column:
    """Fractional part keeping the sign of the value (like ``modf``)."""
    return as_col(c) % F.lit(1.0)


def hash_shard(c, n: int) -> Column:
    """md5 of the text read as a 128-bit unsigned integer, modulo ``n``.

    The 32 hex digits are folded left to right with ``(acc*16 + digit) % n``,
    which equals the big-integer remainder without leaving 64-bit arithmetic.
    """
    digits = F.split(F.md5(as_col(c).cast("string")), "")
    return F.aggregate(
        F.slice(digits, 1, 32), F.lit(0).cast("long"),
        lambda acc, ch: (acc * 16 + F.conv(ch, 16, 10).cast("long")) % F.lit(n).cast("long"),
    )


def utc_stamp(c, zone: str) -> Column:
    """Wall-clock time of ``zone`` as UTC wall-clock time, whatever the session's zone."""
    local = as_col(c).cast("timestamp_ntz")
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), local)
