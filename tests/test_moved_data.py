"""What is shuffled and written on the way, on tables of the tests' own."""

from __future__ import annotations

import os
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.bindings import queries
from tidemark.bindings import training_log as log
from tidemark.plans import progress, sets
from tidemark.sources import files
from tidemark.sources.tables import Table, by_session
from tests import test_series
from tests.test_sets import DIM, LOC, RAW, row

LINE = """l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double,
  l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"""


@pytest.fixture
def tables(spark, folder):
    day = datetime(1997, 3, 4)
    lines = [
        (1, 7, 3, 1, 5.0, 10.0, 0.0, 0.08, "N", "O", day),  # copied a day later and once more at the same time
        (1, 7, 4, 2, 6.0, 10.0, 0.0, 0.0, "A", "F", day),  # a day later only
        (1, 8, 5, 3, 7.0, 10.0, 0.1, None, "R", "F", None),
        (1, 8, 5, 4, 7.0, 10.0, None, 0.08, "N", "F", None),  # once more, load time unknown
        (2, 9, 5, 1, 7.0, 10.0, 0.0, 0.0, "N", "F", day),  # no such part
        (None, 7, 5, 1, 7.0, 10.0, 0.0, 0.0, "N", "F", day),
    ]
    made = {
        "lineitem": (lines, LINE),
        "orders": ([(1, 5, "O", 1.0, day, "1-URGENT"), (2, 5, "O", 1.0, day, "1-URGENT")],
                   "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"),
        "part": ([(7, "hot bolt", "b", "SMALL", 3, 1.0), (8, "big ring", "b", "PROMO", 4, 1.0)],
                 "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"),
        "customer": ([(5, "c", 11, 1.0, "M")], "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
    }
    for name, (rows, schema) in made.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return folder


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return len(re.findall(r"Exchange (?:hash|range|single|Round)", plan(df)))


def test_raw_log_is_joined_once_with_all_copies(spark, tables):
    raw = log.raw_workouts(spark, tables)
    later, same = datetime(1997, 3, 5), datetime(1997, 3, 4)
    found = sorted(((r.set_index, r._loaded_at) for r in raw.collect()), key=str)
    assert found == sorted([(1, same), (1, later), (1, same), (2, same), (2, later), (3, None), (4, None), (4, None)], key=str)
    first = raw.filter("set_index = 1").first()
    assert (first.athlete, first.exercise_title, first.workout_id) == (11, "bolt (Cable)", "1")
    # Every table is read once, and none that grows with the log goes through the driver.
    planned = plan(log.raw_workouts(spark, tables))
    assert "Union" not in planned and "Broadcast" not in planned and planned.count("FileScan") == 4


def test_ungathered_table_is_written_without_a_shuffle(spark, folder):
    # Eight tasks with both folders each: eight files a folder, unless they were brought together.
    rows = spark.range(0, 800, 1, 8).withColumn("part", (F.col("id") % 2).cast("int"))
    for gather, files_each in ((True, 1), (False, 8)):
        table = Table(spark, f"{folder}/{gather}")
        read = table.replace(rows, ["part"], gather=gather)
        assert sorted(r.id for r in read.collect()) == list(range(800))
        assert len([n for n in os.listdir(f"{folder}/{gather}/v=0/part=0") if n.endswith(".parquet")]) == files_each


def test_sessions_stay_together_unless_too_large(spark):
    rows = [row(set_index=i, _loaded_at=datetime(2026, 6, d)) for i in range(4) for d in (1, 2)]
    rows += [row(workout_id=None, set_index=i) for i in range(3)]
    raw, places, dim = spark.createDataFrame(rows, RAW), spark.createDataFrame([], LOC), spark.createDataFrame([], DIM)
    usual, large = (sets.clean_sets(raw, places, dim, one_task_rows=n) for n in (1_000, 4))
    assert "hashpartitioning(workout_id" in plan(usual) and not re.search(r"hashpartitioning\(workout_id#\d+, exercise_title", plan(usual))
    assert re.search(r"hashpartitioning\(workout_id#\d+, exercise_title", plan(large))
    key = lambda df: sorted(df.select("workout_id", "set_index", "set_occurrence").collect(), key=str)
    assert key(usual) == key(large) and len(key(usual)) == 7


def test_rebuilt_sessions_stage_working_sets_only(spark, monkeypatch):
    staged = {}

    def stage(df, path):
        out = files.stage(df, path)
        staged[os.path.basename(path).split("-")[0]] = out
        return out

    monkeypatch.setattr(sets, "stage", stage)
    old, new = datetime(2026, 6, 1), datetime(2026, 6, 9)
    rows = [
        row(_loaded_at=old), row(set_index=1, _loaded_at=old), row(set_index=2, set_type="warmup", _loaded_at=old),
        row(workout_id="w2", _loaded_at=old), row(workout_id="w2", set_index=1, set_type="warmup", _loaded_at=new),  # touched by it
    ]
    raw = by_session(spark.createDataFrame(rows, RAW))
    places, dim = spark.createDataFrame([], LOC), spark.createDataFrame([], DIM)
    first = sets.clean_sets(raw.filter(F.col("_loaded_at") <= old), places, dim)
    touched, rebuilt = sets.rebuilt_sessions(first, raw, places, dim)
    assert [r.workout_id for r in touched.collect()] == ["w2"]
    assert rebuilt.count() == 1 and staged["again"].filter("set_type = 'warmup'").count() == 0


def test_landed_json_is_compressed_and_read_back(spark, folder, monkeypatch):
    monkeypatch.setattr(files, "FILE_ROWS", 40, raising=False)
    rows = spark.range(100).selectExpr("CAST(id AS STRING) AS workout_id", "'t' AS title", "CAST(id AS INT) AS set_index").coalesce(1)
    path = files.write_jsonl(rows, folder, "20260101_000000")
    written = [n for n in os.listdir(path) if n.startswith("part-")]
    assert len(written) == 3 and all(n.endswith(".json.gz") for n in written)
    assert sorted(r.set_index for r in files.good_rows(files.load_jsonl(spark, path)).collect()) == list(range(100))


def test_workouts_take_one_shuffle_of_the_lines(spark, tables):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        docs = queries.workout_docs(spark, tables)
        assert exchanges(docs) == 2  # lines and orders
        assert {r.id: sum(len(e.sets) for e in r.exercises) for r in docs.collect()} == {"1": 4, "2": 1}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_window_sync_builds_its_workouts_once(spark, tables, monkeypatch):
    staged, stage = [], files.stage
    monkeypatch.setattr(files, "stage", lambda df, path: staged.append(os.path.basename(path).split("-")[0]) or stage(df, path))
    out = queries.window_sync(spark, tables)
    assert "workouts" in staged and out.count() == 5


def test_lines_are_shuffled_with_their_marks_packed(spark, tables):
    # A negative and a missing supplier read as they did unpacked.
    day = datetime(1997, 3, 4)
    more = [(1, 8, -6, 5, 7.0, 10.0, 0.1, 0.01, "A", "F", day), (1, 8, None, 6, 7.0, 10.0, 0.1, 0.01, "A", "F", day),
            (1, 8, 100, 7, 7.0, 10.0, 0.1, None, "A", "F", day), (1, 8, -8, 8, 7.0, 10.0, 0.1, 0.02, None, None, day)]
    spark.createDataFrame(more, LINE).write.mode("append").parquet(f"{tables}/lineitem.parquet")
    raw = log.raw_workouts(spark, tables)
    found = {r.set_index: (r.superset_id, r.set_type, r._source, r.rpe) for r in raw.collect()}
    assert found == {
        1: (None, "failure", "api", "6.5"), 2: ("1", "normal", "csv", None), 3: ("", "warmup", "api", None),
        4: ("", "dropset", "api", "9.5"), 5: (None, "normal", "csv", "5.5"), 6: (None, "normal", "api", "6.5"),
        7: ("1", "Normal", "csv", None), 8: ("-2", "dropset", "csv", "8.5"),
    }
    lines = next(n for n in plan(raw).split("\n") if "Project" in n and "l_partkey" in n and "_marks" in n)
    assert not re.search(r", l_(returnflag|linestatus|tax|discount)#\d+[,\]]", lines)


def test_tables_are_written_densely(spark, folder):
    table = Table(spark, f"{folder}/t")
    table.replace(spark.range(5))
    table.append_batch(spark.range(5), "b")
    for below in ("v=0", "batch=b"):
        written = [n for n in os.listdir(f"{folder}/t/{below}") if n.endswith(".parquet")]
        assert written and all(n.endswith(".zstd.parquet") for n in written)
    assert table.read().count() == 10


def test_landed_lines_never_meet_a_broadcast(spark, tables):
    planned = plan(queries.export_rows(spark, tables))
    assert "SortMergeJoin" in planned and "Broadcast" not in planned


def test_progression_shuffles_its_sets_once(spark):
    frame = test_series.sets(spark, [(0, 100, 5), (0, 100, 6), (1, 90, 5), (1, 110, 1, {"gym_detail": "g2"})])
    bests = progress.best_sets(frame)
    # One for the sets and their history, two for the join with the weights.
    assert exchanges(bests) == 1 and exchanges(progress.progression(frame, test_series.weights(spark, []))) == 3
    found = sorted((r.gym_detail, r.workout_date, r.top_set_weight_kg, r.top_set_reps, r.sets_n) for r in bests.collect())
    assert [(g, int(w), n, c) for g, _, w, n, c in found] == [("g1", 100, 6, 2), ("g1", 90, 5, 1), ("g2", 110, 1, 1)]
