"""Helpers the operators share."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from starloom.session import work_folder

# A word, as every operator here counts it: a run without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def written(spark: SparkSession, df: DataFrame, purpose: str, *folders: str) -> DataFrame:
    """``df`` as a table below ``spark.checkpoint.dir``, in ``folders`` by these columns: its lineage
    ends there, so a lost executor costs a reread and not a recomputation."""
    path = f"{work_folder(spark, purpose)}/{uuid.uuid4().hex}"
    df.write.partitionBy(*folders).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def row_key(df: DataFrame) -> Column:
    """A hash of all columns: rows of one key are equal, whatever ids are null or used again."""
    parts = (F.md5(F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit(""))) for c in df.columns)
    return F.unhex(F.md5(F.concat(*parts)))


def arrow_schema(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


def map_batches(df: DataFrame, ddl: str, columns: Callable[[pa.RecordBatch], list[list]]) -> DataFrame:
    """Apply ``columns`` to each Arrow batch; it returns one list per column of ``ddl``."""
    schema = arrow_schema(ddl)

    def run(batches):
        for batch in batches:
            made = [pa.array(values, f.type) for values, f in zip(columns(batch), schema, strict=True)]
            yield pa.RecordBatch.from_arrays(made, schema=schema)

    return df.mapInArrow(run, ddl)


# --- compact columns ----------------------------------------------------------------------

# Much cheaper than making the numbers; what is packed travels more than once.
LEVEL = 9


def pack(numbers: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, byte plane by byte plane, so that small numbers cost little."""
    planes = np.ascontiguousarray(numbers, dtype="<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=LEVEL).compress(planes.tobytes())


def unpack(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def pack_texts(texts: list[bytes]) -> bytes:
    """Byte strings as their packed lengths and their joined, compressed bytes."""
    lengths = pack(np.fromiter(map(len, texts), np.uint32, len(texts)))
    return len(lengths).to_bytes(4, "little") + lengths + zstandard.ZstdCompressor(level=LEVEL).compress(b"".join(texts))


def unpack_texts(blob: bytes) -> list[bytes]:
    cut = 4 + int.from_bytes(blob[:4], "little")
    ends = np.cumsum(unpack(blob[4:cut]), dtype=np.int64).tolist()
    joined = zstandard.ZstdDecompressor().decompress(blob[cut:])
    return [joined[a:b] for a, b in zip([0, *ends[:-1]], ends)] if ends else []


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... of every run, one run after the other."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))
