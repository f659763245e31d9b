"""Which month holds a key: a side table of a merged table, filed by the hash of the key.

A merge has to know the months that hold older copies of its keys. Instead of scanning the keys of
the whole table it reads the buckets its keys fall into. The side table is a table of the lake
like any other, partitioned by bucket; a bucket never changes for a key, so merging it touches
the buckets of the batch and nothing else.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEYS_PER_BUCKET = 1_000_000
MAX_BUCKETS = 4096
BUCKET, BUCKETS, KEY, MONTH = "bucket", "n_buckets", "held_key", "held_month"


def side_table(table: str) -> str:
    return f"{table}__keys"


def bucket_count(rows: int, keys_per_bucket: int = KEYS_PER_BUCKET) -> int:
    return max(1, min(MAX_BUCKETS, -(-rows // keys_per_bucket)))


def filed(rows: DataFrame, key: str, month: str, buckets: int) -> DataFrame:
    """The entries of ``rows``; each carries the number of buckets it was filed by."""
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    return rows.select(
        F.col(key).alias(KEY), F.col(month).alias(MONTH), F.lit(buckets).alias(BUCKETS), bucket.alias(BUCKET)
    )


def buckets_of(entries: DataFrame) -> int | None:
    """The number of buckets entries were filed by; None without entries."""
    first = entries.select(BUCKETS).first()
    return first[0] if first else None


def held_keys(entries: DataFrame, batch: DataFrame, key: str, buckets: int) -> DataFrame:
    """The entries (key and month) of the keys of ``batch``, out of the buckets its keys fall into."""
    asked = filed(batch, key, key, buckets).select(F.col(KEY).alias("asked_key"), BUCKET)
    # One value per bucket: bounded by MAX_BUCKETS.
    touched = [r[0] for r in asked.select(BUCKET).distinct().collect()]
    near = entries.filter(F.col(BUCKET).isin(touched) if touched else F.lit(False))
    return near.join(asked.select("asked_key"), F.expr(f"{KEY} <=> asked_key"), "left_semi").select(KEY, MONTH)
