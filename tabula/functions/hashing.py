"""Content keys and hash buckets.

All are built-in Spark expressions (codegen, no Python):

* ``content_key``   - SHA-256 hex of a string/binary column (G6).
* ``xxhash_bucket`` - ``pmod(xxhash64(cols...), n)``, the fast native form (G5).
* ``md5_bucket``    - portable form whose value any SQL engine with md5 can
  reproduce: the first 32 bits of md5 as an unsigned integer, mod n.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def content_key(col: Column) -> Column:
    return F.sha2(col, 256)


def xxhash_bucket(n: int, *cols: Column) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(n))


def md5_prefix_int(key: Column) -> Column:
    """First 8 hex digits of md5(key) as a non-negative bigint (0 .. 2^32-1)."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint")


def md5_bucket(key: Column, n: int) -> Column:
    return F.pmod(md5_prefix_int(key), F.lit(n))


def md5_unit(key: Column) -> Column:
    """A deterministic pseudo-uniform number in [0, 1) from a key."""
    return md5_prefix_int(key) / F.lit(float(2 ** 32))
