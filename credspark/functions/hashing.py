"""md5-based buckets as column expressions (no Python on the row path).

The bucket of a text ``x`` is ``int(md5(x), 16) % n``.  Spark has no
128-bit integer, so the 32-hex digest is read as four 32-bit pieces and
folded with Horner's rule modulo ``n``:
``r = (r * (2**32 mod n) + piece) mod n``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def md5_bucket(text: Column, n: int = 1000) -> Column:
    """Bucket in [0, n) of the md5 digest of ``text`` (a string column)."""
    digest = F.md5(text)
    mult = (1 << 32) % n
    r = F.lit(0).cast("bigint")
    for k in range(4):
        piece = F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint")
        r = (r * F.lit(mult) + piece) % F.lit(n)
    return r


def duck_md5_bucket(text_sql: str, n: int = 1000) -> str:
    """The same fold written for DuckDB (used by oracle SQL only)."""
    mult = (1 << 32) % n
    r = "CAST(0 AS BIGINT)"
    for k in range(4):
        piece = f"CAST(('0x' || substr(md5({text_sql}), {8 * k + 1}, 8)) AS BIGINT)"
        r = f"(({r} * {mult} + {piece}) % {n})"
    return r
