"""Key hashing, row keys and salt buckets."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_BUCKETS = 128

# Addresses known to be hot and the bucket each one gets.
HOT_BUCKETS = {
    "0x0000000000000000000000000000000000000000": "9001",
    "0xdac17f958d2ee523a2206206994597c13d831ec7": "9002",
    "0x7a250d5630b4cf539739df2c5dacb4c659f2488d": "9003",
    "0xea674fdde714fd979de3edf0f56aa9716b898ec8": "9004",
    "0xc02aaa39b223fe8d0a0e5c4f27ead9083c756cc2": "9005",
    "0x0000000000000000000000000000000000000001": "9006",
    "0xa0b86991c6218b36c1d19d4a2e9eb0ce3606eb48": "9007",
}


def md5_key(key: Column) -> Column:
    """md5 hex of a key rendered as text."""
    return F.md5(key.cast("string"))


def rowkey(fields: Iterable[str], separator: str = "", hashed: Iterable[str] = (), hash_all: bool = False) -> Column:
    """joined fields, some hashed on their own, the whole optionally hashed."""
    hashed = set(hashed)
    parts = [md5_key(F.col(f)) if f in hashed else F.col(f).cast("string") for f in fields]
    joined = F.concat_ws(separator, *parts)
    return F.md5(joined) if hash_all else joined


def salt_bucket(key: Column, buckets: int = DEFAULT_BUCKETS, hot: Mapping[str, str] | None = None) -> Column:
    """four-digit bucket from the last three hex digits of the key's md5.

    Keys listed in ``hot`` (compared without case) take their fixed bucket.
    """
    number = F.conv(F.right(md5_key(key), F.lit(3)), 16, 10).cast("int") % buckets
    bucket = F.lpad(number.cast("string"), 4, "0")
    if not hot:
        return bucket
    pairs = [F.lit(x) for pair in hot.items() for x in pair]
    fixed = F.try_element_at(F.create_map(*pairs), F.lower(key.cast("string")))
    return F.coalesce(fixed, bucket)
