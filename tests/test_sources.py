"""Files, audit and gate, versioned tables, state and the sync runs."""

from __future__ import annotations

import hashlib
import json
import os
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tidemark.sources import audit, documents, files, schemas, state, tables
from tidemark.sources.audit import SyncError
from tidemark.streaming import ingest


def write(folder, name, text):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)
    return path


HEADER = ",".join(schemas.EXPORT_COLUMNS)


def test_csv_nulls_quotes_and_bad_rows(spark, folder):
    path = write(folder, "in/a.csv", "\n".join([
        HEADER,
        'Push,t0,t1,"a, ""b""",Bench,,NULL,0,normal,100,5,null,,8',
        "Pull,t0,t1,d,Row,,n,first,normal,50,8,,,",
        "broken,line",
    ]) + "\n")
    staged = files.stage(files.load_csv(spark, path), f"{folder}/staged")
    good = sorted(files.good_rows(staged).collect(), key=lambda r: r.title, reverse=True)
    assert [r.title for r in good] == ["Push", "Pull"]
    assert good[0].description == 'a, "b"' and good[0].exercise_notes is None and good[0].distance_km is None
    assert good[0].set_index == 0 and good[1].set_index is None and good[0]._source == "csv"
    result = audit.read_audit(audit.audit(staged))
    assert (result.rows_parsed, result.rows_loaded, result.errors_seen) == (3, 2, 1)
    assert result.first_error == "broken,line" and result.status == "partially_loaded"
    with pytest.raises(SyncError):
        audit.gate(result)
    total, titles = audit.verify(files.good_rows(staged))
    assert total.first()[0] == 2 and [r.title for r in titles.collect()] == ["Pull", "Push"]


def test_jsonl_round_trip(spark, folder):
    rows = spark.createDataFrame([("w", "t", 1), ("v", None, 2)], "workout_id string, title string, set_index int")
    path = files.write_jsonl(rows, folder, "20260101_000000")
    assert path.endswith("workouts/incremental/20260101_000000")
    loaded = files.stage(files.load_jsonl(spark, path), f"{folder}/staged")
    assert audit.gate(audit.read_audit(audit.audit(loaded))).rows_loaded == 2
    assert files.good_rows(loaded).filter("title is null").count() == 1


def test_gate_refuses_empty_loads():
    clean = audit.LoadResult("loaded", 0, 0, 0, None)
    with pytest.raises(SyncError):
        audit.gate(clean)
    with pytest.raises(SyncError):
        audit.gate(audit.LoadResult("loaded", 3, 3, 0, None), rows_expected=0)


def test_landmark_seed(spark, folder):
    marks = files.default_landmarks(spark)
    assert marks.count() == 21 and marks.filter("mev_sets is null").count() == 4
    assert marks.schema["mev_sets"].dataType.simpleString() == "decimal(3,0)"
    path = write(folder, "seed.csv", files.LANDMARK_SEED)
    assert sorted(files.load_seed(spark, path, schemas.LANDMARK).collect()) == sorted(marks.collect())


WORKOUT = {
    "id": "w1", "title": "Push", "start_time": "2026-01-01T07:00:00Z", "end_time": "2026-01-01T08:00:00Z",
    "description": None, "updated_at": "2026-01-01T08:00:00Z",
    "exercises": [
        {"title": "Bench", "superset_id": "0", "notes": "n", "sets": [
            {"index": 0, "type": "normal", "weight_kg": 0.0, "reps": 0, "distance_meters": 0.0, "duration_seconds": 0, "rpe": 0.0},
            {"index": 1, "type": "failure", "weight_kg": 80.5, "reps": 6, "distance_meters": 1234.56, "duration_seconds": 30, "rpe": 9.5},
        ]},
        {"title": "Empty", "superset_id": None, "notes": None, "sets": []},
    ],
}


def docs(spark, *workouts):
    text = spark.createDataFrame([(json.dumps(w),) for w in workouts], "value string")
    return text.select(F.from_json("value", schemas.WORKOUT_DOC).alias("w")).select("w.*")


def test_flatten_zero_rules(spark):
    first, second = documents.flatten_workouts(docs(spark, WORKOUT)).orderBy("set_index").collect()
    assert (first.weight_kg, first.reps) == ("0.0", "0")
    assert (first.distance_km, first.duration_seconds, first.rpe) == (None, None, None)
    assert first.superset_id == "0" and second.distance_km == "1.2346" and second.duration_seconds == "30"
    assert documents.flatten_workouts(docs(spark, WORKOUT), drop_first_superset=True).first().superset_id is None


def test_split_events_counts_the_rest(spark):
    events = spark.createDataFrame(
        [("updated", ("a",)), ("deleted", ("b",)), ("updated", None), (None, ("c",))], "type string, workout struct<id:string>"
    )
    changed, counts = documents.split_events(events)
    assert [r.id for r in changed.collect()] == ["a"] and tuple(counts.first()) == (1, 3)


def test_dimension_rows(spark):
    one = [("1", "Bench", "barbell", "chest", ["triceps"], None), ("2", "Row", None, "lats", None, True)]
    got = documents.template_rows(spark.createDataFrame(one, schemas.TEMPLATE_DOC)).collect()
    assert [(r.secondary_muscle_groups, r.is_custom) for r in got] == [('["triceps"]', False), ("[]", True)]
    readings = documents.measurement_rows(spark.createDataFrame([("2026-01-01", 80.5, None)], schemas.MEASUREMENT_DOC))
    assert tuple(readings.first()) == ("2026-01-01", "80.5", None)


def test_upsert_updates_inserts_and_follows_columns(spark, folder):
    table = tables.Table(spark, f"{folder}/t")
    table.replace(spark.createDataFrame([(1, "a", "old"), (2, "b", "old"), (None, "n", "old")], "k int, v string, gone string"))
    after = table.upsert(spark.createDataFrame([(2, "B", 1), (3, "C", 1), (None, "N", 1)], "k int, v string, fresh int"), ["k"])
    assert after.columns == ["k", "v", "fresh"]
    assert sorted(((r.k, r.v, r.fresh) for r in after.collect()), key=repr) == [
        (1, "a", None), (2, "B", 1), (3, "C", 1), (None, "N", 1)
    ]
    assert table.versions() == [0, 1]


def rows_of(table):
    return sorted(tuple(r) for r in table.read().collect())


def test_batches_are_taken_into_the_next_version(spark, folder):
    make = lambda *rows: spark.createDataFrame(list(rows), "k int, v string, m int")
    table = tables.Table(spark, f"{folder}/t")
    table.append_batch(make((1, "a", 1), (2, "b", 1)), "x-0")
    table.upsert(make((2, "B", 1)), ["k"])
    assert rows_of(table) == [(1, "a", 1), (2, "B", 1)]
    table.append_batch(make((3, "c", 2)), "x-1")
    assert rows_of(table) == [(1, "a", 1), (2, "B", 1), (3, "c", 2)]
    table.append_batch(make((2, "late", 1)), "x-0")  # a retry of a batch already merged
    table.swap(make((3, "C", 2)), ["k"], "m")
    assert rows_of(table) == [(1, "a", 1), (2, "B", 1), (3, "C", 2)]
    table.replace(make((9, "z", 1)))
    assert rows_of(table) == [(9, "z", 1)]
    table.forget(1)
    assert rows_of(table) == [(9, "z", 1)] and not [f for f in os.listdir(f"{folder}/t") if f.startswith("batch=")]


def test_swap_of_a_table_with_batches_only(spark, folder):
    make = lambda *rows: spark.createDataFrame(list(rows), "k int, m int")
    table = tables.Table(spark, f"{folder}/t")
    table.append_batch(make((1, 1), (2, 2)), "x-0")
    table.swap(make((1, 3)), ["k"], "m")
    assert rows_of(table) == [(1, 3), (2, 2)]


def test_two_writers_never_share_a_version(spark, folder):
    table = tables.Table(spark, f"{folder}/t")
    table.replace(spark.range(1))
    first, second = table._claim(set()), table._claim(set())
    assert first != second
    table.replace(spark.range(4))  # the claimed versions were never finished
    assert table.read().count() == 4


def test_two_streams_land_beside_each_other(spark, folder):
    bronze = tables.Table(spark, f"{folder}/bronze")
    for n in (1, 2):
        land(f"{folder}/{n}", "a", {"type": "updated", "workout": {**WORKOUT, "id": f"w{n}"}})
        held = state.SyncState(spark, f"{folder}/state{n}")
        ingest.run_sync(spark, f"{folder}/{n}/landing", bronze, held, f"{folder}/checkpoint{n}")
    assert {r.workout_id for r in bronze.read().collect()} == {"w1", "w2"}


def test_window_runs_of_one_second_land_beside_each_other(spark, folder):
    bronze = tables.Table(spark, f"{folder}/bronze")
    now = datetime(2026, 1, 5, tzinfo=timezone.utc)
    for n in (1, 2, 2):
        held = state.SyncState(spark, f"{folder}/state{n}")
        ingest.run_window_sync(docs(spark, {**WORKOUT, "id": f"w{n}", "updated_at": "2026-01-04T00:00:00Z"}), bronze, held, now)
    assert sorted({r.workout_id for r in bronze.read().collect()}) == ["w1", "w2"]


def test_unreadable_change_times_refuse_the_run(spark, folder):
    bronze = tables.Table(spark, f"{folder}/bronze")
    held = state.SyncState(spark, f"{folder}/state")
    now = datetime(2026, 1, 5, tzinfo=timezone.utc)
    for bad in ("not a time", None):
        with pytest.raises(Exception, match="without a readable change time"):
            ingest.run_window_sync(docs(spark, WORKOUT, {**WORKOUT, "id": "w9", "updated_at": bad}), bronze, held, now)
        assert held.get() is None and not bronze.exists()


def test_unfinished_version_is_not_read(spark, folder):
    table = tables.Table(spark, f"{folder}/t")
    table.replace(spark.range(3))
    os.makedirs(f"{folder}/t/v=1")  # a write that never finished
    assert table.versions() == [0] and table.read().count() == 3
    table.replace(spark.range(5))
    assert table.read().count() == 5


def test_partition_swap_moves_rows_and_takes_over_other_folders(spark, folder):
    table = tables.Table(spark, f"{folder}/t")
    schema = "s string, v int, m int"
    table.replace(spark.createDataFrame([("a", 1, 1), ("a", 2, 1), ("b", 3, 2), ("c", 4, 3)], schema), ["m"])
    reader = table.read()
    groups = spark.createDataFrame([("a",)], "s string")
    got = table.swap(spark.createDataFrame([("a", 9, 2)], schema), ["s"], "m", groups)
    now = [("a", 9, 2), ("b", 3, 2), ("c", 4, 3)]
    for rows in (got, table.read()):
        assert sorted(tuple(r) for r in rows.select("s", "v", "m").collect()) == now
    assert not os.path.exists(f"{folder}/t/v=1/m=3") and not os.path.exists(f"{folder}/t/v=1/m=1")
    # Who read before the swap still sees the table as it was.
    assert sorted(r.v for r in reader.collect()) == [1, 2, 3, 4]
    # Partition 3 lies in the first version and outlives it.
    table.swap(spark.createDataFrame([("b", 5, 4)], schema), ["s"], "m")
    table.forget(keep=1)
    assert table.versions() == [2] and os.listdir(f"{folder}/t/v=0") == ["m=3"]
    assert sorted(tuple(r) for r in table.read().select("s", "v", "m").collect()) == [("a", 9, 2), ("b", 5, 4), ("c", 4, 3)]
    table.replace(spark.createDataFrame([("z", 1, 1)], schema), ["m"])
    table.forget(keep=1)
    assert [n for n in os.listdir(f"{folder}/t") if n.startswith("v=")] == ["v=3"]


def test_interrupted_swap_leaves_the_table(spark, folder):
    table = tables.Table(spark, f"{folder}/t")
    schema = "s string, v int, m int"
    table.replace(spark.createDataFrame([("a", 1, 1), ("b", 3, 2)], schema), ["m"])
    rebuilt = spark.createDataFrame([("a", 9, 2)], schema)
    # It dies with its number claimed, then with a part of the folders written.
    table._claim(set())
    assert sorted(r.v for r in table.read().collect()) == [1, 3]
    rebuilt.write.partitionBy("m").parquet(f"{folder}/t/v=1")
    os.remove(f"{folder}/t/v=1/_SUCCESS")
    assert sorted(r.v for r in table.read().collect()) == [1, 3]
    assert sorted(r.v for r in table.swap(rebuilt, ["s"], "m").collect()) == [3, 9] and table.versions() == [0, 2]


def test_a_table_that_swaps_lose_all_rows_of_is_empty(spark, folder):
    table = tables.Table(spark, f"{folder}/t")
    table.replace(spark.createDataFrame([("a", 1, 1)], "s string, v int, m int"), ["m"])
    table.swap(spark.createDataFrame([], "s string, v int, m int"), ["s"], "m", spark.createDataFrame([("a",)], "s string"))
    assert table.read().columns == ["s", "v", "m"] and table.read().count() == 0


def test_batches_are_compacted(spark, folder):
    table = tables.Table(spark, f"{folder}/t")
    for n in range(3):
        table.append_batch(spark.createDataFrame([(n,)], "k int"), f"x-{n}")
    assert sorted(r.k for r in table.compact().collect()) == [0, 1, 2]
    table.append_batch(spark.createDataFrame([(7, "w")], "k int, w string"), "x-3")
    table.compact()
    table.forget(1)
    assert sorted(r.k for r in table.read().collect()) == [0, 1, 2, 7]
    assert not [f for f in os.listdir(f"{folder}/t") if f.startswith("batch=")]


def test_large_exports_are_read_in_splits(spark, folder):
    line = 'Push,t0,t1,"a ""b"" c",Bench,,,8.5,normal,100,%d,,,\n'
    path = write(folder, "in/a.csv", HEADER + "\n" + "".join(line % n for n in range(5000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", 32 * 1024)
    try:
        plain = files.load_csv(spark, path)
        assert plain.rdd.getNumPartitions() > 1 and plain.count() == 5000 and plain.distinct().count() == 5000
        whole = files.load_csv(spark, path, line_breaks=True)
        assert whole.rdd.getNumPartitions() == 1 and plain.exceptAll(whole).isEmpty()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_old_versions_are_forgotten(spark, folder):
    table = tables.Table(spark, f"{folder}/t")
    for n in range(4):
        table.replace(spark.range(n))
    table.forget(keep=2)
    assert table.versions() == [2, 3] and table.read().count() == 3


def test_export_becomes_raw_sets(spark, folder):
    path = write(folder, "in/a.csv", HEADER + '\nPush,t0,t1,"two\nlines",Bench,,,8.5,normal,100,5,,,\n')
    rows = files.as_raw_sets(files.good_rows(files.load_csv(spark, path)), datetime(2026, 1, 1)).collect()
    assert len(rows) == 1 and rows[0].description == "two\nlines" and rows[0].set_index == 9
    assert rows[0].workout_id == hashlib.md5(b"Pusht0").hexdigest() and rows[0]._loaded_at == datetime(2026, 1, 1)


def test_swap_removes_a_group_without_new_rows(spark, folder):
    table = tables.Table(spark, f"{folder}/t")
    schema = "s string, v int, m int"
    table.replace(spark.createDataFrame([("a", 1, 1), ("b", 3, 1)], schema), ["m"])
    got = table.swap(spark.createDataFrame([], schema), ["s"], "m", spark.createDataFrame([("a",)], "s string"))
    assert [r.s for r in got.collect()] == ["b"]


def test_catalog_names(spark, folder):
    catalog = tables.Catalog(spark, folder)
    with pytest.raises(ValueError):
        catalog.table("platinum", "x")
    with pytest.raises(ValueError):
        catalog.source("unknown")
    catalog.materialise("GOLD", "x", spark.range(2))
    assert catalog.table("gold", "x").read().count() == 2


def test_state_first_run_update_and_malformed(spark, folder):
    held = state.SyncState(spark, f"{folder}/state")
    assert held.get() is None
    now = datetime(2026, 1, 8, tzinfo=timezone.utc)
    assert state.sync_window(held, now) == (datetime(2026, 1, 1, tzinfo=timezone.utc), now)
    held.set(now)
    assert held.get() == now and state.sync_window(held, now)[0] == now
    held.table.upsert(spark.createDataFrame([(state.WORKOUT_SYNC, "yesterday")], state.STATE_SCHEMA), ["key"])
    with pytest.raises(SyncError):
        held.get()


def land(folder, name, *events, broken=False):
    lines = [json.dumps(e) for e in events] + (['{"type": "upd'] if broken else [])
    write(folder, f"landing/{name}.json", "\n".join(lines) + "\n")


def test_stream_loads_once_and_keeps_state_on_a_bad_batch(spark, folder):
    bronze = tables.Table(spark, f"{folder}/bronze")
    held = state.SyncState(spark, f"{folder}/state")
    go = lambda hour: ingest.run_sync(
        spark, f"{folder}/landing", bronze, held, f"{folder}/checkpoint", datetime(2026, 1, 1, hour, tzinfo=timezone.utc)
    )
    land(folder, "a", {"type": "updated", "workout": WORKOUT}, {"type": "deleted", "workout": {"id": "x"}})
    go(1)
    assert bronze.read().count() == 2
    go(2)  # nothing new: rows stay, state moves
    assert bronze.read().count() == 2 and held.get().hour == 2

    land(folder, "b", {"type": "updated", "workout": {**WORKOUT, "id": "w2"}}, broken=True)
    with pytest.raises(Exception, match="state kept"):
        go(3)
    assert held.get().hour == 2 and bronze.read().count() == 2
    # The file is repaired; the same batch is read again and lands once.
    os.remove(f"{folder}/landing/b.json")
    land(folder, "b", {"type": "updated", "workout": {**WORKOUT, "id": "w2"}})
    go(4)
    assert bronze.read().count() == 4 and held.get().hour == 4


def test_stream_refuses_workouts_without_sets(spark, folder):
    bronze = tables.Table(spark, f"{folder}/bronze")
    held = state.SyncState(spark, f"{folder}/state")
    land(folder, "a", {"type": "updated", "workout": {**WORKOUT, "exercises": []}})
    with pytest.raises(Exception, match="hold no sets"):
        ingest.run_sync(spark, f"{folder}/landing", bronze, held, f"{folder}/checkpoint")
    assert held.get() is None


def test_window_sync(spark, folder):
    bronze = tables.Table(spark, f"{folder}/bronze")
    held = state.SyncState(spark, f"{folder}/state")
    now = datetime(2026, 1, 5, tzinfo=timezone.utc)
    old = {**WORKOUT, "id": "old", "updated_at": "2025-12-01T00:00:00Z"}
    ingest.run_window_sync(docs(spark, WORKOUT, old), bronze, held, now)
    assert {r.workout_id for r in bronze.read().collect()} == {"w1"} and held.get() == now
    later = now.replace(day=6)
    ingest.run_window_sync(docs(spark, WORKOUT, old), bronze, held, later)  # nothing changed since
    assert held.get() == later and bronze.read().count() == 2
    newer = {**WORKOUT, "exercises": [], "updated_at": "2026-01-07T00:00:00Z"}
    with pytest.raises(SyncError):
        ingest.run_window_sync(docs(spark, newer), bronze, held, now.replace(day=8))
    assert held.get() == later


def test_stream_drops_repeats_in_the_delay(spark, folder):
    write(folder, "events/a.json", "\n".join(
        json.dumps({"id": i, "at": f"2026-01-01T00:0{m}:00"}) for i, m in [(1, 0), (1, 1), (2, 2)]
    ))
    stream = spark.readStream.schema("id int, at timestamp_ntz").json(f"{folder}/events")
    out = f"{folder}/out"
    query = (
        ingest.drop_repeated(stream, "id", "at", "10 minutes").writeStream.format("parquet")
        .option("checkpointLocation", f"{folder}/cp").option("path", out).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [1, 2]


def test_the_staging_write_counts_its_own_audit(spark, folder):
    lines = ['{"workout_id": "a"}', "broken", '{"workout_id": "b"}', "also broken"]
    for n, own in enumerate((lines, lines[:1], lines[1::2], [])):
        os.makedirs(f"{folder}/{n}")
        with open(f"{folder}/{n}/x.json", "w") as f:
            f.write("".join(line + "\n" for line in own))
        staged, result = audit.stage_audited(files.load_jsonl(spark, f"{folder}/{n}"), f"{folder}/staged{n}")
        assert staged.count() == len(own) and (not own or result == audit.read_audit(audit.audit(staged)))
        assert (result.rows_parsed, result.errors_seen) == (len(own), sum("broken" in x for x in own))


def test_only_files_with_line_breaks_are_read_whole(spark, folder):
    plain = 'Push,t0,t1,"a ""b"" c",Bench,,,8.5,normal,100,%d,,,\n'
    names = ["a.csv", "b c.csv", "d[1].csv", "e%20f.csv"]
    for k, name in enumerate(names):
        write(folder, f"in/{name}", HEADER + "\n" + "".join(plain % (n + 10_000 * k) for n in range(3000)))
    write(folder, "in/g {x}.csv", HEADER + '\nPush,t0,t1,"two\nlines",Bench,,,8.5,normal,100,77777,,,\n' + "".join(plain % (n + 90_000) for n in range(3000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", 32 * 1024)
    try:
        loaded = files.load_csv(spark, f"{folder}/in")
        rows = loaded.withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(rows) == 15_001 and len({r.reps for r in rows}) == 15_001 and not [r for r in rows if r._corrupt_record]
    tasks = lambda low, high: {r.task for r in rows if low <= int(r.reps) < high}
    assert len(tasks(77_777, 100_000)) == 1 and all(len(tasks(10_000 * k, 10_000 * k + 3000)) > 1 for k in range(4))
    assert [r.description for r in rows if r.reps == "77777"] == ["two\nlines"]
