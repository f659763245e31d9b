"""Merging an append-only raw table into a fact as files arrive.

The state is the fact table itself: a micro-batch is staged like a batch load and merged by
key, a row older than the one the table holds being ignored. A batch that is repeated after a
failure merges to the same table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from starloom.sources.lake import FACTS, Lake


def raw_stream(spark: SparkSession, path: str, schema: StructType, files_per_batch: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def merge_stream(
    stream: DataFrame, lake: Lake, table: str, build: Callable[[DataFrame], DataFrame], *, layer: str = FACTS, **merge
) -> None:
    """Merge everything available now, batch by batch, then stop.

    ``build`` turns raw rows into rows of the table; ``merge`` goes to :meth:`Lake.merge`.
    """

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        lake.merge(layer, table, build(batch), **merge)

    query = (
        stream.writeStream.foreachBatch(one_batch)
        .option("checkpointLocation", f"{lake.path(layer, table)}__progress")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
