"""Finished tables on shared storage: full overwrite for small ones, merge by month for facts."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starloom.operators.increment import ROWS_PER_PIECE, duplicated, in_shape, merge_months, merge_rows, not_older
from starloom.sources import key_months
from starloom.sources.key_months import side_table
from starloom.sources.storage import Storage

STAGING, ENTITIES, DIMENSIONS, FACTS = "silver/staging", "silver/intermediate", "gold/dim", "gold/fact"
# Spark passes over files whose names start with an underscore.
SCHEMA_FILE, MARK_FILE = "_schema.json", "_mark.json"

# Rows are written several times on their way into a table; this takes about a quarter less than Spark's default.
PACKED = {"compression": "zstd"}

# What looks at a table as it will be, and raises if it must not be published.
Inspection = Callable[[DataFrame], None]


@dataclass(frozen=True)
class MergeReport:
    table: str
    first_load: bool
    partitions_rewritten: int
    rows_written: int
    source_rows: int


class Lake(Storage):
    """A folder per layer and table. ``root`` is storage that all executors share."""

    def __init__(self, spark: SparkSession, root: str, keys_per_bucket: int = key_months.KEYS_PER_BUCKET):
        super().__init__(spark)
        self.root = root.rstrip("/")
        self.keys_per_bucket = keys_per_bucket

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def exists(self, layer: str, table: str) -> bool:
        return self._there(self.path(layer, table))

    def read(self, layer: str, table: str, schema: StructType | None = None) -> DataFrame:
        """The table in its own schema, or in the one given. Files written before a column existed
        read as NULL there and removed columns are left out; no old file is rewritten for it."""
        path = self.path(layer, table)
        schema = schema or self._kept_schema(path)[0]
        if not schema:
            return self.spark.read.parquet(path)
        # Spark puts the partition column last.
        return self.spark.read.schema(schema).parquet(path).select([F.col(f"`{name}`") for name in schema.names])

    def _kept_schema(self, folder: str) -> tuple[StructType | None, set[str]]:
        """The schema kept with a table, and the removed columns that old files may still hold."""
        note = f"{folder}/{SCHEMA_FILE}"
        if not self._there(note):
            return None, set()
        kept = self._load(note)
        return StructType.fromJson(kept["schema"]), set(kept["removed"])

    def _keep_schema(self, folder: str, schema: dict, removed: list[str]) -> None:
        self._store(f"{folder}/{SCHEMA_FILE}", {"schema": schema, "removed": removed})

    def mark(self, layer: str, table: str) -> dict | None:
        """How far the table has read its source, as noted by :meth:`set_mark`. A full rebuild forgets it."""
        note = f"{self.path(layer, table)}/{MARK_FILE}"
        return self._load(note)["mark"] if self._there(note) else None

    def set_mark(self, layer: str, table: str, mark: dict) -> None:
        self._store(f"{self.path(layer, table)}/{MARK_FILE}", {"mark": mark})

    # --- full overwrite ---------------------------------------------------------------

    def overwrite(self, layer: str, table: str, df: DataFrame, partition_by: str | None = None) -> DataFrame:
        """Write to a fresh folder, then swap it in; a failed write leaves the table as it was."""
        self.recover(layer, table)
        current = self.path(layer, table)
        fresh = f"{current}__next_{uuid.uuid4().hex}"
        if partition_by:
            df.hint("rebalance", partition_by).write.options(**PACKED).partitionBy(partition_by).parquet(fresh)
        else:
            df.hint("rebalance").write.options(**PACKED).parquet(fresh)
        self._keep_schema(fresh, df.schema.jsonValue(), [])
        self._publish({"swap": fresh}, layer, table)
        return self.read(layer, table, df.schema)

    def _finish_swap(self, fresh: str, current: str) -> None:
        new, old = self._path(fresh), self._path(current)
        retired = self._path(f"{current}__old_{uuid.uuid4().hex}")
        files = self._files(old)
        replaced = files.exists(old)
        if replaced and not files.rename(old, retired):
            raise OSError(f"cannot retire {current}")
        if not files.rename(new, old):
            raise OSError(f"cannot publish {fresh} as {current}; the previous table is {retired}")
        if replaced:
            files.delete(retired, True)

    # --- merge ------------------------------------------------------------------------

    def merge(
        self,
        layer: str,
        table: str,
        source: DataFrame,
        *,
        key: str,
        month: str,
        key_fixes_month: bool,
        newer_by: str | tuple[str, ...] | None = None,
        inspect: Inspection | None = None,
    ) -> MergeReport:
        """Merge ``source`` into a table partitioned by ``month``, rewriting touched months only.
        Without a table yet, ``source`` becomes it.

        The source is written down once (it is read several times and may be expensive). The
        merged months are then written to a pending folder and moved in from there, so the table
        is never read while it is replaced. A publication that breaks off is finished by the next
        run (:meth:`recover`). ``inspect`` sees the table as it will be, with the pending months in
        place; if it raises, the table stays as it was.

        Columns follow the source: new ones are NULL in older rows, missing ones go. A column that
        changes its type, or comes back after it was removed, is rewritten in every month, since
        old files cannot be read in the new shape; a value that does not fit the new type fails
        the merge before anything is published.

        ``key_fixes_month`` says that a key never moves to another month. Where it may, the
        months of the target's old copies are touched too. They are looked up in a side table by
        key, of which the buckets of the source's keys are read; see :mod:`key_months`. ``newer_by`` names
        one stamp, or columns that order the versions of a row: source rows older than the target's are ignored.
        """
        self.recover(layer, table)
        if not self.exists(layer, table):
            return self.replace(
                layer, table, source, key=key, month=month, key_fixes_month=key_fixes_month, inspect=inspect
            )
        current, run = self.path(layer, table), uuid.uuid4().hex
        batch, pending = f"{current}__batch_{run}", f"{current}__pending_{run}"
        source.write.options(**PACKED).parquet(batch)
        source = self.spark.read.schema(source.schema).parquet(batch)
        self._refuse_duplicates(table, source, key, batch)

        target = self.read(layer, table)
        removed = self._kept_schema(current)[1]
        rewrites_all = _reshaped(target.schema, source.schema, removed)
        removed = set() if rewrites_all else removed | set(target.columns) - set(source.columns)
        held = None if key_fixes_month else self._held(layer, table, source, key, month, f"{current}__held_{run}")
        if newer_by and not rewrites_all:
            within = _months(source.select(month) if held is None else source.select(month).unionByName(held.select(month)))
            accepted = f"{current}__accepted_{run}"
            not_older(target.filter(_in_months(month, within)), source, key, newer_by).write.options(**PACKED).parquet(accepted)
            self._drop(batch)
            batch, source = accepted, self.spark.read.schema(source.schema).parquet(accepted)
            if held is not None:
                kept = source.select(F.col(key).alias("__kept"))
                held = held.join(kept, F.col(key).eqNullSafe(F.col("__kept")), "left_semi")
        months = source.select(month)
        if rewrites_all:
            months = months.unionByName(target.select(month))
        elif held is not None:
            months = months.unionByName(held.select(month))
        touched = _months(months)
        old, arrived = target.filter(_in_months(month, touched)), source.count()
        if rewrites_all:
            merged = merge_rows(old, source, key, newer_by=newer_by).hint("rebalance", month)
        else:
            pieces = -(-(old.count() + arrived) // (ROWS_PER_PIECE * max(1, len(touched)))) or 1
            merged = merge_months(old, source, key, month, held, pieces)
        merged.write.options(**PACKED).partitionBy(month).parquet(pending)
        written = self.spark.read.schema(source.schema).parquet(pending)
        aside = [pending, batch] if key_fixes_month else [pending, batch, f"{current}__held_{run}"]
        self._inspect(inspect, target.filter(~_in_months(month, touched)), written, *aside)
        report = MergeReport(
            table=table,
            first_load=False,
            partitions_rewritten=len(touched),
            rows_written=written.count(),
            source_rows=arrived,
        )
        # A month whose last row moved away has no pending folder.
        filled = self._folders(pending)
        emptied = {_folder(month, value) for value in touched} - set(filled)
        plan = {
            "pending": pending,
            "batch": batch,
            "filled": filled,
            "emptied": sorted(emptied),
            "schema": source.schema.jsonValue(),
            "removed": sorted(removed),
        }
        if not key_fixes_month:
            # Filed before the months are moved: what was accepted can't be told afterwards.
            entries = f"{current}__moved_{run}"
            buckets = key_months.buckets_of(self.read(layer, side_table(table))) or 1
            key_months.filed(source, key, month, buckets).write.options(**PACKED).parquet(entries)
            plan |= {"entries": entries, "held": f"{current}__held_{run}"}
        self._publish(plan, layer, table)
        return report

    def _inspect(self, inspect: Inspection | None, kept: DataFrame, written: DataFrame, *folders: str) -> None:
        if inspect:
            try:
                inspect(in_shape(kept, written.schema).unionByName(written))
            except Exception:
                for folder in folders:
                    self._drop(folder)
                raise

    def _held(self, layer: str, table: str, source: DataFrame, key: str, month: str, folder: str) -> DataFrame:
        """Which months hold older copies of the source's keys, written down, as it is read several times."""
        if not self.exists(layer, side_table(table)):
            self._file_keys(layer, table, key, month)
        entries = self.read(layer, side_table(table))
        buckets = key_months.buckets_of(entries) or 1
        held = key_months.held_keys(entries, source, key, buckets).toDF(key, month)
        held.write.options(**PACKED).parquet(folder)
        return self.spark.read.schema(held.schema).parquet(folder)

    def _file_keys(self, layer: str, table: str, key: str, month: str) -> None:
        """The side table of a table's keys, made anew from two of its columns."""
        rows = self.read(layer, table)
        buckets = key_months.bucket_count(rows.count(), self.keys_per_bucket)
        self.overwrite(layer, side_table(table), key_months.filed(rows, key, month, buckets), key_months.BUCKET)

    # --- publishing -------------------------------------------------------------------

    def _publish(self, plan: dict, layer: str, table: str) -> None:
        """Note what is about to be published, publish it, drop the note."""
        current = self.path(layer, table)
        self._note(current, plan)
        self._finish(plan, layer, table)

    def _finish(self, plan: dict, layer: str, table: str) -> None:
        """Publish what a note says, whatever of it was done before."""
        current = self.path(layer, table)
        if "swap" in plan:
            if self._there(plan["swap"]):
                self._finish_swap(plan["swap"], current)
            if "keys" in plan:
                self._file_keys(layer, table, *plan["keys"])
        else:
            self._finish_merge(plan, current)
            if "entries" in plan:
                entries = self.spark.read.parquet(plan["entries"])
                filing = {"key": key_months.KEY, "month": key_months.BUCKET, "key_fixes_month": True}
                self.merge(layer, side_table(table), entries, **filing)
        self._drop(self._manifest(current))
        for folder in ("pending", "batch", "entries", "held"):
            if folder in plan:
                self._drop(plan[folder])

    def _finish_merge(self, plan: dict, current: str) -> None:
        self._move_months(plan["pending"], current, plan["filled"])
        for folder in plan["emptied"]:
            self._drop(f"{current}/{folder}")
        self._keep_schema(current, plan["schema"], plan["removed"])

    def _move_months(self, pending: str, current: str, folders: list[str]) -> None:
        """Put pending months in the place of the table's. A folder that is no longer pending was
        moved before. (Where storage has no rename this copies the touched months, no more.)"""
        for folder in folders:
            new, old = self._path(f"{pending}/{folder}"), self._path(f"{current}/{folder}")
            files = self._files(old)
            if files.exists(new):
                files.delete(old, True)
                if not files.rename(new, old):
                    raise OSError(f"cannot publish {pending}/{folder} in {current}")

    def recover(self, layer: str, table: str) -> bool:
        """Finish a publication that broke off; whether there was one.

        Months replace one another one by one and a swap is two renames, so what is to be
        published is noted first and the note goes last. Every writer calls this before it looks
        at the table; so must whoever reads a watermark from it. Publishing twice changes nothing.
        """
        note = self._manifest(self.path(layer, table))
        if not self._there(note):
            return False
        self._finish(self._load(note), layer, table)
        return True

    def _manifest(self, current: str) -> str:
        return f"{current}__publishing.json"

    def _note(self, current: str, plan: dict) -> None:
        """Written aside and renamed: a note is there whole or not at all."""
        aside, note = self._path(f"{current}__note_{uuid.uuid4().hex}"), self._path(self._manifest(current))
        self._store(aside.toString(), plan)
        if not self._files(aside).rename(aside, note):
            raise OSError(f"cannot note the publication of {current}")

    def _refuse_duplicates(self, table: str, source: DataFrame, key: str, folder: str) -> None:
        clashes = duplicated(source, key)
        if clashes:
            self._drop(folder)
            raise ValueError(f"{table}: several source rows for one key, e.g. {clashes}")

    def replace(
        self,
        layer: str,
        table: str,
        source: DataFrame,
        *,
        key: str,
        month: str,
        key_fixes_month: bool = True,
        inspect: Inspection | None = None,
    ) -> MergeReport:
        """Full refresh: rebuild the partitioned table from ``source`` alone, written once and swapped in.

        With ``key_fixes_month=False`` the side table for :meth:`merge` is made along with it. ``inspect`` sees the new table
        before it takes the place of the old one.
        """
        self.recover(layer, table)
        fresh = f"{self.path(layer, table)}__next_{uuid.uuid4().hex}"
        source.hint("rebalance", month).write.options(**PACKED).partitionBy(month).parquet(fresh)
        held = self.spark.read.schema(source.schema).parquet(fresh)
        self._refuse_duplicates(table, held, key, fresh)
        self._inspect(inspect, held.filter("false"), held, fresh)
        rows, months = held.count(), len(self._folders(fresh))
        self._keep_schema(fresh, source.schema.jsonValue(), [])
        self._publish({"swap": fresh} | ({} if key_fixes_month else {"keys": [key, month]}), layer, table)
        return MergeReport(table, True, months, rows, rows)


def _months(rows: DataFrame) -> list:
    """One value per calendar month: bounded by the span of the data, not by its volume."""
    return [r[0] for r in rows.distinct().collect()]


def _in_months(month: str, touched: list):
    known = [m for m in touched if m is not None]
    inside = F.coalesce(F.col(month).isin(known), F.lit(False)) if known else F.lit(False)
    return inside | F.col(month).isNull() if None in touched else inside


def _folder(month: str, value: date | int | None) -> str:
    return f"{month}=" + ("__HIVE_DEFAULT_PARTITION__" if value is None else str(value))


def _reshaped(held: StructType, new: StructType, removed: set[str]) -> bool:
    """Whether files of the held schema cannot be read in the new one."""
    types = {f.name: f.dataType for f in held.fields}
    return any(types.get(f.name, f.dataType) != f.dataType or f.name in removed for f in new.fields)
