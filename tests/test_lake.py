import datetime as dt
import os

import pytest

from starloom.session import work_folder
from starloom.sources.lake import DIMENSIONS, FACTS, Lake

JAN, FEB, MAR = dt.date(2025, 1, 1), dt.date(2025, 2, 1), dt.date(2025, 3, 1)
SCHEMA = "id string, month date, ts timestamp, v int"
MERGE = {"key": "id", "month": "month", "key_fixes_month": False}


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path))


def day(n):
    return dt.datetime(2025, 1, n)


def content(lake):
    return {r.id: (r.month, r.v) for r in lake.read(FACTS, "t").collect()}


def test_overwrite_replaces_the_whole_table(lake, rows):
    lake.overwrite(DIMENSIONS, "d", rows("a int", (1,), (2,)))
    after = lake.overwrite(DIMENSIONS, "d", rows("a int, b string", (3, "x")))
    assert [tuple(r) for r in after.collect()] == [(3, "x")]
    assert os.listdir(f"{lake.root}/gold/dim") == ["d"]


def test_a_failed_overwrite_leaves_the_table_alone(lake, rows):
    lake.overwrite(DIMENSIONS, "d", rows("a int", (1,)))
    with pytest.raises(Exception):
        lake.overwrite(DIMENSIONS, "d", rows("a string", ("x",)).selectExpr("cast(a as int) as a"))
    assert lake.read(DIMENSIONS, "d").count() == 1


def test_a_table_may_be_overwritten_from_itself(lake, rows):
    lake.overwrite(DIMENSIONS, "d", rows("a int", (1,), (2,)))
    lake.overwrite(DIMENSIONS, "d", lake.read(DIMENSIONS, "d").filter("a = 2"))
    assert [r.a for r in lake.read(DIMENSIONS, "d").collect()] == [2]


def test_merge_rewrites_touched_months_only(lake, rows):
    first = lake.merge(FACTS, "t", rows(SCHEMA, ("a", JAN, day(1), 1), ("b", FEB, day(1), 2), ("c", None, day(1), 3)), **MERGE)
    assert (first.first_load, first.rows_written, first.partitions_rewritten) == (True, 3, 3)
    untouched = set(os.listdir(f"{lake.path(FACTS, 't')}/month=2025-01-01"))
    second = lake.merge(FACTS, "t", rows(SCHEMA, ("b", FEB, day(2), 20), ("d", FEB, day(2), 4)), **MERGE)
    assert (second.first_load, second.rows_written, second.partitions_rewritten, second.source_rows) == (False, 2, 1, 2)
    assert content(lake) == {"a": (JAN, 1), "b": (FEB, 20), "c": (None, 3), "d": (FEB, 4)}
    assert set(os.listdir(f"{lake.path(FACTS, 't')}/month=2025-01-01")) == untouched
    assert sorted(os.listdir(f"{lake.root}/gold/fact")) == ["t", "t__keys"]


def test_a_row_that_moves_to_another_month_leaves_the_old_one(lake, rows):
    lake.merge(FACTS, "t", rows(SCHEMA, ("a", JAN, day(1), 1), ("b", FEB, day(1), 2), ("c", None, day(1), 3)), **MERGE)
    lake.merge(FACTS, "t", rows(SCHEMA, ("a", MAR, day(2), 10), ("c", FEB, day(2), 30)), **MERGE)
    assert content(lake) == {"a": (MAR, 10), "b": (FEB, 2), "c": (FEB, 30)}


def test_an_empty_increment_changes_nothing(lake, rows):
    lake.merge(FACTS, "t", rows(SCHEMA, ("a", JAN, day(1), 1)), **MERGE)
    report = lake.merge(FACTS, "t", rows(SCHEMA, ("a", JAN, day(1), 1)).filter("false"), **MERGE)
    assert (report.partitions_rewritten, report.rows_written) == (0, 0)
    assert content(lake) == {"a": (JAN, 1)}


def test_a_merge_can_be_repeated(lake, rows):
    source = rows(SCHEMA, ("a", JAN, day(1), 1), ("b", FEB, day(1), 2))
    for _ in range(2):
        lake.merge(FACTS, "t", source, **MERGE)
    assert content(lake) == {"a": (JAN, 1), "b": (FEB, 2)}


def test_an_ambiguous_merge_fails_before_writing(lake, rows):
    lake.merge(FACTS, "t", rows(SCHEMA, ("a", JAN, day(1), 1)), **MERGE)
    with pytest.raises(ValueError, match="several source rows.*b"):
        lake.merge(FACTS, "t", rows(SCHEMA, ("b", JAN, day(1), 1), ("b", FEB, day(1), 2)), **MERGE)
    with pytest.raises(ValueError, match="several source rows"):
        lake.replace(FACTS, "t", rows(SCHEMA, ("b", JAN, day(1), 1), ("b", FEB, day(1), 2)), key="id", month="month")
    assert content(lake) == {"a": (JAN, 1)} and sorted(os.listdir(f"{lake.root}/gold/fact")) == ["t", "t__keys"]


def test_columns_come_and_go_without_rewriting_old_months(lake, rows):
    lake.merge(FACTS, "t", rows("id string, month date, gone int", ("a", JAN, 1)), **MERGE)
    newer = rows("id string, month date, fresh string", ("b", FEB, "x"))
    lake.merge(FACTS, "t", newer, **MERGE)
    read = lake.read(FACTS, "t", newer.schema)
    assert {(r.id, r.fresh) for r in read.collect()} == {("a", None), ("b", "x")} and "gone" not in read.columns


@pytest.mark.parametrize("type_, shown", [("string", "1"), ("decimal(12,2)", 1), ("bigint", 1)])
def test_a_column_changes_its_type_in_months_that_the_source_does_not_touch(lake, rows, type_, shown):
    lake.merge(FACTS, "t", rows("id string, month date, v int", ("a", JAN, 1), ("n", None, 1)), **MERGE)
    newer = rows("id string, month date, v int", ("b", FEB, 2)).selectExpr("id", "month", f"cast(v as {type_}) as v")
    lake.merge(FACTS, "t", newer, **MERGE)
    assert lake.read(FACTS, "t").schema["v"].dataType == newer.schema["v"].dataType
    assert {r.id: r.v for r in lake.read(FACTS, "t").collect() if r.id != "b"} == {"a": shown, "n": shown}


def test_a_value_that_does_not_fit_the_new_type_leaves_the_table_alone(lake, rows):
    lake.merge(FACTS, "t", rows("id string, month date, v string", ("a", JAN, "x")), **MERGE)
    with pytest.raises(Exception):
        lake.merge(FACTS, "t", rows("id string, month date, v int", ("b", FEB, 2)), **MERGE)
    assert [tuple(r) for r in lake.read(FACTS, "t").collect()] == [("a", JAN, "x")]


def test_the_table_keeps_its_current_schema(lake, rows):
    lake.merge(FACTS, "t", rows("id string, month date, gone int", ("a", JAN, 1)), **MERGE)
    newer = rows("id string, month date, fresh string", ("b", FEB, "x"))
    lake.merge(FACTS, "t", newer, **MERGE)
    assert lake.read(FACTS, "t").columns == ["id", "month", "fresh"]
    # A removed column that comes back is empty in old rows, whatever their files hold.
    lake.merge(FACTS, "t", rows("id string, month date, gone string", ("c", FEB, "y")), **MERGE)
    assert {(r.id, r.gone) for r in lake.read(FACTS, "t").collect()} == {("a", None), ("b", None), ("c", "y")}


class Settings:
    def __init__(self, **values):
        self.conf = {k.replace("_", "."): v for k, v in values.items()}


def test_the_work_folder_is_the_shared_one(tmp_path):
    cluster = Settings(spark_checkpoint_dir=f"{tmp_path}/", spark_master="yarn")
    one, two = work_folder(cluster, "x"), work_folder(cluster, "x")
    assert one.startswith(f"{tmp_path}/x-") and one != two


def test_only_a_local_session_may_do_without_a_shared_folder():
    assert work_folder(Settings(spark_master="local[2]"), "x")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        work_folder(Settings(spark_master="yarn"), "x")


def test_a_merge_that_breaks_off_is_finished_by_the_next_run(lake, rows, monkeypatch):
    lake.merge(FACTS, "t", rows(SCHEMA, ("a", JAN, day(1), 1), ("b", FEB, day(1), 1), ("c", MAR, day(1), 1)), **MERGE)
    move = Lake._move_months

    def broken(self, pending, current, folders):
        move(self, pending, current, [f"month={FEB}"])
        raise OSError("the driver is gone")

    monkeypatch.setattr(Lake, "_move_months", broken)
    news = rows(SCHEMA, ("a", JAN, day(2), 2), ("b", FEB, day(2), 2), ("c", JAN, day(2), 2))
    with pytest.raises(OSError):
        lake.merge(FACTS, "t", news, **MERGE)
    monkeypatch.undo()
    assert content(lake) != {"a": (JAN, 2), "b": (FEB, 2), "c": (JAN, 2)}
    again = Lake(lake.spark, lake.root)
    assert again.recover(FACTS, "t") and not again.recover(FACTS, "t")
    assert content(lake) == {"a": (JAN, 2), "b": (FEB, 2), "c": (JAN, 2)}
    assert sorted(os.listdir(f"{lake.root}/gold/fact")) == ["t", "t__keys"]


@pytest.mark.parametrize("renames", [0, 1])
def test_a_swap_that_breaks_off_is_finished(lake, rows, monkeypatch, renames):
    lake.overwrite(DIMENSIONS, "d", rows("a int", (1,)))

    def broken(self, fresh, current):
        if renames:
            os.rename(current, f"{current}__old_x")
        raise OSError("the driver is gone")

    monkeypatch.setattr(Lake, "_finish_swap", broken)
    with pytest.raises(OSError):
        lake.overwrite(DIMENSIONS, "d", rows("a int", (2,)))
    monkeypatch.undo()
    assert lake.recover(DIMENSIONS, "d")
    assert [r.a for r in lake.read(DIMENSIONS, "d").collect()] == [2]


def unreadable(folder):
    """Spoil every file below a folder, so that whoever reads one fails."""
    for place, _, names in os.walk(folder):
        for name in names:
            if name.endswith(".parquet"):
                with open(f"{place}/{name}", "wb") as out:
                    out.write(b"not parquet")
                crc = f"{place}/.{name}.crc"
                if os.path.exists(crc):
                    os.unlink(crc)


def test_a_merge_reads_the_buckets_and_months_of_its_keys_alone(spark, rows, tmp_path):
    lake = Lake(spark, str(tmp_path), keys_per_bucket=1)
    first = [(f"k{i}", dt.date(2025, 1 + i % 12, 1), day(1), i) for i in range(24)]
    lake.merge(FACTS, "t", rows(SCHEMA, *first), **MERGE)
    entries = lake.read(FACTS, "t__keys")
    buckets = {r.held_key: r.bucket for r in entries.collect()}
    assert {r.n_buckets for r in entries.collect()} == {24}
    # k0 moves from January to March; k24 is new and lands in March.
    news = rows(SCHEMA, ("k0", MAR, day(2), 100), ("k24", MAR, day(2), 24))
    touched = {buckets["k0"], lake.spark.range(1).selectExpr("pmod(xxhash64('k24'), 24) as b").first().b}
    for bucket in set(buckets.values()) - touched:
        unreadable(f"{lake.path(FACTS, 't__keys')}/bucket={bucket}")
    for month in range(1, 13):
        if month not in (1, 3):
            unreadable(f"{lake.path(FACTS, 't')}/month=2025-{month:02}-01")
    report = lake.merge(FACTS, "t", news, newer_by="ts", **MERGE)
    assert (report.partitions_rewritten, report.source_rows) == (2, 2)
    held = lake.read(FACTS, "t").filter("month in (date'2025-01-01', date'2025-03-01')").collect()
    assert {r.id: (r.month, r.v) for r in held} == {"k0": (MAR, 100), "k24": (MAR, 24), "k2": (MAR, 2), "k14": (MAR, 14), "k12": (JAN, 12)}


def test_the_keys_follow_the_table(spark, rows, tmp_path):
    lake = Lake(spark, str(tmp_path), keys_per_bucket=2)
    months = [JAN, FEB, MAR, None]
    expected = {}
    for step in range(4):
        batch = [(f"k{i}" if i else None, months[(i + step) % 4], day(step + 1), step) for i in range(step, step + 6)]
        lake.merge(FACTS, "t", rows(SCHEMA, *batch), **MERGE)
        expected |= {b[0]: (b[1], b[3]) for b in batch}
        # A missing key is a key like any other.
        assert content(lake) == expected and lake.read(FACTS, "t").count() == len(expected)
        held = {r.held_key: r.held_month for r in lake.read(FACTS, "t__keys").collect()}
        assert held == {k: m for k, (m, _) in expected.items()}
    lake.replace(FACTS, "t", rows(SCHEMA, ("z", FEB, day(1), 0)), **MERGE)
    assert [r.held_key for r in lake.read(FACTS, "t__keys").collect()] == ["z"]


def test_keys_are_filed_when_a_broken_off_merge_is_finished(lake, rows, monkeypatch):
    lake.merge(FACTS, "t", rows(SCHEMA, ("a", JAN, day(1), 1), ("b", FEB, day(1), 1)), **MERGE)
    finish = Lake._finish_merge

    def broken(self, plan, current):
        finish(self, plan, current)
        if current.endswith("/t"):
            raise OSError("the driver is gone")

    monkeypatch.setattr(Lake, "_finish_merge", broken)
    with pytest.raises(OSError):
        lake.merge(FACTS, "t", rows(SCHEMA, ("a", MAR, day(2), 2)), **MERGE)
    monkeypatch.undo()
    lake.merge(FACTS, "t", rows(SCHEMA, ("a", FEB, day(3), 3)), **MERGE)
    assert content(lake) == {"a": (FEB, 3), "b": (FEB, 1)}


def test_versions_are_ordered_by_several_columns(lake, rows):
    ordered = {**MERGE, "newer_by": ("ts", "v")}
    lake.merge(FACTS, "t", rows(SCHEMA, ("a", JAN, day(2), 5), ("b", JAN, None, 1), ("c", JAN, day(1), None)), **MERGE)
    news = rows(SCHEMA, ("a", FEB, day(2), 4), ("b", FEB, day(1), 0), ("c", FEB, day(1), None))
    assert lake.merge(FACTS, "t", news, **ordered).source_rows == 2
    assert content(lake) == {"a": (JAN, 5), "b": (FEB, 0), "c": (FEB, None)}


def test_what_fails_inspection_is_not_published(lake, rows):
    def refuse(pending):
        seen.append({r.id: r.v for r in pending.collect()})
        raise ValueError("no")

    seen = []
    with pytest.raises(ValueError, match="no"):
        lake.merge(FACTS, "t", rows(SCHEMA, ("a", JAN, day(1), 1)), inspect=refuse, **MERGE)
    assert not lake.exists(FACTS, "t")
    lake.merge(FACTS, "t", rows(SCHEMA, ("a", JAN, day(1), 1), ("b", FEB, day(1), 1)), **MERGE)
    before = sorted(os.listdir(f"{lake.root}/gold/fact"))
    with pytest.raises(ValueError, match="no"):
        lake.merge(FACTS, "t", rows(SCHEMA, ("a", MAR, day(2), 2)), inspect=refuse, **MERGE)
    with pytest.raises(ValueError, match="no"):
        lake.replace(FACTS, "t", rows(SCHEMA, ("c", MAR, day(2), 3)), inspect=refuse, **MERGE)
    assert seen == [{"a": 1}, {"a": 2, "b": 1}, {"c": 3}]
    assert content(lake) == {"a": (JAN, 1), "b": (FEB, 1)}
    assert sorted(os.listdir(f"{lake.root}/gold/fact")) == before


def test_merged_rows_are_shuffled_once(lake, rows, monkeypatch):
    """Old and new rows of a month meet by month and share of the keys, and are written where they met."""
    from starloom.operators import increment
    from starloom.sources import lake as lakes

    spark, plans = lake.spark, []
    merge_months = increment.merge_months

    def seen(*given):
        merged = merge_months(*given)
        plans.append((given[-1], merged._jdf.queryExecution().executedPlan().toString()))
        return merged

    lake.merge(FACTS, "t", rows(SCHEMA, ("a", JAN, day(1), 1), (None, FEB, day(1), 2), ("c", None, day(1), 3), ("d", JAN, day(1), 4)), **MERGE)
    monkeypatch.setattr(lakes, "merge_months", seen)
    monkeypatch.setattr(lakes, "ROWS_PER_PIECE", 1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lake.merge(FACTS, "t", rows(SCHEMA, ("a", FEB, day(2), 10), (None, JAN, day(2), 20), ("c", None, day(2), 30)), **MERGE)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert content(lake) == {"a": (FEB, 10), None: (JAN, 20), "c": (None, 30), "d": (JAN, 4)}
    assert lake.read(FACTS, "t").count() == 4
    pieces, plan = plans[0]
    assert pieces > 1 and plan.split("== Initial Plan ==")[0].count("Exchange") == 1
    assert sorted(os.listdir(f"{lake.root}/gold/fact")) == ["t", "t__keys"]
