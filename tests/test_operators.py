"""Numbering, lookups, retrieval and question logs against plain Python."""

from __future__ import annotations

import math
import random
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import arith, text
from tidemark.operators import documents, lookup, ordering, quality, questions, similarity
from tidemark.plans import curated, sets


def test_sliced_numbering_of_one_hot_key(spark):
    rng = random.Random(3)
    rows = [("hot", rng.randrange(10_000), i) for i in range(3000)] + [("k%d" % (i % 50), i, i) for i in range(1000)]
    frame = spark.createDataFrame(rows, "k string, o int, id int").repartition(5)
    order = [F.col("o"), F.col("id")]
    big = ordering.oversized_groups(frame, ["k"], limit=500, fraction=1.0)
    assert [r.k for r in big.collect()] == ["hot"]
    got = {(r.k, r.id): r.n for r in ordering.number_within(frame, ["k"], order, "n", big, slices=7).collect()}
    want, seen = {}, {}
    for k, o, i in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        seen[k] = seen.get(k, 0) + 1
        want[(k, i)] = seen[k]
    assert got == want


def test_sampling_finds_a_large_group(spark):
    frame = spark.range(400_000).selectExpr("if(id % 3 = 0, 0, id) as k")
    assert [r.k for r in ordering.oversized_groups(frame, ["k"], limit=50_000).collect()] == [0]


def test_duplicates_are_limited_before_the_shuffle(spark):
    frame = spark.range(1000).selectExpr("id % 2 as k", "id as t")
    plan = ordering.keep_first(frame, ["k"], [F.desc("t")])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


@pytest.mark.parametrize("longest", [100, 400, 20_000, 10**7])
@pytest.mark.parametrize("broadcast_rows", [500_000, 10])
def test_range_lookup_against_brute_force(spark, monkeypatch, broadcast_rows, longest):
    monkeypatch.setattr(lookup, "BROADCAST_ROWS", broadcast_rows)
    rng = random.Random(5)
    day = lambda n: date.fromordinal(730_000 + n)
    facts = [(i, rng.randrange(2), day(rng.randrange(900))) for i in range(300)] + [(999, 0, None)]
    ranges = []
    for i in range(60):
        a = rng.randrange(900)
        ranges.append((rng.randrange(2), day(a), date.fromordinal(min(730_000 + a + rng.randrange(-3, longest), date.max.toordinal())), f"r{i}"))
    ranges += [(0, None, day(5), "no start"), (1, day(3), None, "no end")]
    if longest > 400:
        ranges += [(0, day(300), date.max, "open"), (1, date(1, 1, 1), day(200), "until"), (1, date(1, 1, 1), date.max, "always")]
    frame = spark.createDataFrame(facts, "id int, e int, d date")
    out = lookup.range_lookup(
        frame, spark.createDataFrame(ranges, "e int, start_date date, end_date date, name string"),
        "d", ["name"], ["e"], days=frame.union(frame) if broadcast_rows == 10 else None,
    )
    got = sorted(((r.id, r.range_name) for r in out.collect()), key=repr)
    want = []
    for i, e, d in facts:
        hits = [n for re, a, b, n in ranges if d and a and b and re == e and a <= d <= b]
        want += [(i, n) for n in hits] or [(i, None)]
    assert got == sorted(want, key=repr)


def test_bins_of_a_range_are_few_and_make_it_up(spark):
    rng = random.Random(1)
    rows = [(i, date.fromordinal(rng.randrange(600_000, 730_000)), rng.choice([0, 5, 100, 250, 260, 1000, 20_000, 10**6])) for i in range(200)]
    rows = [(i, a, date.fromordinal(min(a.toordinal() + n, date.max.toordinal()))) for i, a, n in rows] + [(900, date.min, date.max)]
    bins = {}
    for r in lookup.range_bins(spark.createDataFrame(rows, "i int, a date, b date"), "a", "b").collect():
        size = lookup.BIN_BITS + lookup.LEVEL_BITS * r._level
        bins.setdefault(r.i, []).append((r._bin << size, (r._bin + 1 << size) - 1))
    for i, a, b in rows:
        own, low, high = sorted(bins[i]), a.toordinal() - 719_163, b.toordinal() - 719_163
        assert all(x[1] + 1 == y[0] for x, y in zip(own, own[1:])) and own[0][0] == low >> 5 << 5 and own[-1][1] == (high >> 5 << 5) + 31
        assert len(own) <= 2 + 14 * math.ceil(math.log((high - low) / 32 + 2, 8))


def brute_top(queries, items, k, threshold, metric):
    out = []
    for qid, q in queries:
        scored = []
        for iid, v in items:
            a, b = np.array(q, float), np.array(v, float)
            if metric == "cosine":
                s = a @ b / (np.linalg.norm(a) * np.linalg.norm(b))
            elif metric == "dot":
                s = a @ b
            else:
                s = 1 - ((a - b) ** 2).sum() / np.sqrt(2)
            scored.append((-round(s, 9), iid))
        kept = [(iid, -s) for s, iid in sorted(scored)[: 2 * k] if -s > threshold][:k]
        out += [(qid, n, iid, round(float(s), 3)) for n, (iid, s) in enumerate(kept, 1)]
    return sorted(out)


@pytest.mark.parametrize("block_bytes", [None, 4 * 8 * 8])  # all queries at once, or blocks of about four
@pytest.mark.parametrize("metric, threshold", [("cosine", 0.1), ("dot", 0.0), ("euclidean", -5.0)])
def test_top_k_against_brute_force(spark, monkeypatch, metric, threshold, block_bytes):
    rng = np.random.default_rng(1)
    items = [(i, rng.normal(size=8).tolist()) for i in range(200)]
    items += [(1000 + i, items[i][1]) for i in range(40)]  # exact copies: ties by id
    queries = [(i, rng.normal(size=8).tolist()) for i in range(11)]
    if block_bytes:
        monkeypatch.setattr(similarity, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(similarity, "STEP_SCORES", 100)
    schema = "{} bigint, embedding array<double>"
    out = similarity.top_k(
        spark.createDataFrame(queries, schema.format("query_id")),
        spark.createDataFrame(items, schema.format("item_id")).repartition(6),
        k=4, threshold=threshold, metric=metric,
    )
    assert sorted(tuple(r) for r in out.collect()) == brute_top(queries, items, 4, threshold, metric)


def test_top_k_without_queries_or_items(spark):
    none = spark.createDataFrame([], "query_id bigint, embedding array<double>")
    one = spark.createDataFrame([(1, [1.0, 0.0])], "query_id bigint, embedding array<double>")
    items = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 0.0])], "item_id bigint, embedding array<double>")
    assert similarity.top_k(none, items).count() == 0
    assert similarity.top_k(one, items.filter("1 = 0")).count() == 0
    assert [tuple(r) for r in similarity.top_k(one, items).collect()] == [(1, 1, 1, 1.0)]
    with pytest.raises(ValueError):
        similarity.top_k(one, items, metric="other")


@pytest.mark.parametrize(
    "question, want",
    [
        ("What did I do last session?", "raw_sets"), ("What is my bench PR?", "pr"), ("How do I progress?", "strength"),
        ("Should I deload?", "fatigue"), ("Am I overtrained, what is my 1RM?", "pr"), ("which muscles are weak", "volume"),
        ("is my push ok", "balance"), ("enough for hypertrophy?", "volume"), ("how often last week", "sessions"),
        ("my press", "llm"), ("preprogress", "llm"), ("régain", "llm"), ("TODAY'S WORKOUT please", "raw_sets"),
        ("imbalanced?", "balance"), ("sets_x", "llm"), ("", "llm"),
    ],
)
def test_routes(spark, question, want):
    got = questions.route_questions(spark.createDataFrame([(question,)], "q string"), "q").first()
    assert got.route == want


def talk(spark, n, convs=1):
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"m{t}") for c in range(convs) for t in range(n)]
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")


@pytest.mark.parametrize("block", [4096, 8])
def test_recent_messages(spark, block):
    got = {r.turn: r.context for r in questions.recent_messages(talk(spark, 40), block=block).collect()}
    for t in range(40):
        want = [f"{'user' if i % 2 == 0 else 'assistant'}: m{i}" for i in range(max(0, t - 6), t)]
        assert got[t] == "\n".join(want)


def test_answer_history_keeps_last_three_good(spark):
    asked = spark.createDataFrame([(1, t) for t in (0, 2, 4, 6, 8, 10)], "conv_id bigint, turn bigint")
    answers = spark.createDataFrame(
        [(1, t, f"q{t - 1}", "a" * 400 if t == 9 else f"a{t}", t == 5) for t in (1, 3, 5, 7, 9)],
        "conv_id bigint, turn bigint, question string, answer string, is_error boolean",
    )
    got = {r.turn: (r.n_answers, r.history) for r in questions.answer_history(asked, answers).collect()}
    assert got[0] == (0, "") and got[2] == (1, "user: q0\nassistant: a1")
    assert got[8] == (3, "user: q0\nassistant: a1\nuser: q2\nassistant: a3\nuser: q6\nassistant: a7")
    assert got[10][0] == 3 and got[10][1].endswith("user: q8\nassistant: " + "a" * 300)


def test_long_conversation_in_slices(spark, monkeypatch):
    plainly = {r.turn: r.context for r in questions.recent_messages(talk(spark, 60)).collect()}
    monkeypatch.setattr(
        questions, "oversized_groups", lambda df, keys: ordering.oversized_groups(df, keys, limit=5, fraction=1.0)
    )
    assert {r.turn: r.context for r in questions.recent_messages(talk(spark, 60), block=16).collect()} == plainly


def test_answer_pairs(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "a"), (1, 2, "assistant", "b")]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = sorted(tuple(r) for r in questions.answer_pairs(frame, "conv_id", "turn", "role", "text").collect())
    assert got == [(1, 1, "q", "a"), (1, 2, "", "b")]


def test_citations(spark):
    asked = spark.createDataFrame([(1, [3, 1, 3, 0, 9]), (2, [])], "query_id bigint, sources_used array<int>")
    evidence = spark.createDataFrame([(q, i, f"t{i}", "x" * 600) for q in (1, 2) for i in (1, 2, 3, 4)],
                                     "query_id bigint, rank int, title string, content string")
    assert sorted(r.citation for r in questions.cited_items(asked, evidence).collect()) == [1, 3]
    contexts = {r.query_id: r.context for r in questions.evidence_context(evidence).collect()}
    assert contexts[1] == "\n\n".join(f"[{i}] t{i}\n" + "x" * 500 for i in (1, 2, 3, 4))


def test_answer_quality(spark):
    schema = "asked_data boolean, data_error boolean, data_rows int, asked_papers boolean, paper_rows int, n_notes int"
    rows = [(True, False, 3, True, 2, 0), (True, True, 3, False, 0, 0), (True, False, 0, False, 0, 0),
            (True, False, 1, True, 0, 0), (False, True, 0, False, 0, 2), (True, False, None, False, None, 0)]
    got = [r.confidence for r in questions.answer_quality(spark.createDataFrame(rows, schema)).collect()]
    assert got == ["high", "low", "low", "low", "medium", "low"]


def test_texts(spark):
    frame = spark.createDataFrame([("  A \n b  ",), ("a B",), ("   ",)], "t string")
    assert [r[0] for r in frame.select(text.squeeze(F.col("t"))).collect()] == ["a b", "a b", ""]
    assert [r[0] for r in frame.select(text.is_blank(F.col("t"))).collect()] == [False, False, True]
    fenced = spark.createDataFrame([("```sql\nSELECT 1;\n```",), ("SELECT 2;;",), ("```SQL select 3```",)], "t string")
    assert [r[0] for r in fenced.select(text.strip_fences(F.col("t"))).collect()] == ["SELECT 1", "SELECT 2", "select 3"]
    tags = spark.createDataFrame([("at Gym:  Iron Den, ok",), ("gym: ",), (None,)], "t string")
    assert [r[0] for r in tags.select(text.explicit_tag(F.col("t"))).collect()] == ["iron_den", None, None]


def test_documents(spark):
    frame = spark.createDataFrame([(7, "T", ["a", "b"]), (8, "U", ["", " "]), (9, "V", None)], "id int, title string, parts array<string>")
    got = documents.assemble(frame, "id", "title", "parts", "https://x/").collect()
    assert [(r.content, r.source_url) for r in got] == [("T\n\na b", "https://x/7/")]
    seen = spark.createDataFrame([("p1", 2, "late"), ("p1", 1, "first"), ("p2", 3, "only")], "pmid string, q int, note string")
    assert sorted(r.note for r in documents.first_by_key(seen, "pmid", ["q"]).collect()) == ["first", "only"]


def test_rounding_is_half_away_from_zero(spark):
    frame = spark.createDataFrame([(1005, 1000), (-1005, 1000), (1, 0), (2, 3)], "a int, b int")
    got = [r[0] for r in frame.select(arith.rounded_ratio(F.col("a"), F.col("b"), 2)).collect()]
    assert [str(v) for v in got] == ["1.01", "-1.01", "None", "0.67"]


def test_report_day_and_empty_report(spark):
    schema = "workout_date date, workout_title string, gym_detail string, total_sets int, total_exercises int," \
             " muscles_trained int, total_tonnage int, session_duration_min int, tonnage_per_min int"
    rows = [(date(2026, 1, d), "t", "g", 1, 1, 1, 1, 1, 1) for d in (1, 2, 31)]
    frame = spark.createDataFrame(rows, schema)
    assert [r.workout_date.day for r in curated.sessions(frame).collect()] == [31, 2, 1]
    assert [r.workout_date.day for r in curated.sessions(frame, as_of=date(2026, 2, 1)).collect()] == [31, 2]
    assert curated.sessions(frame.filter("1 = 0")).count() == 0


def test_reports_are_cut_for_each_entity(spark):
    from datetime import timedelta

    rows = [("a", date(2026, 1, 1) + timedelta(days=n), n) for n in range(40)] + [("b", date(2025, 3, 1) + timedelta(days=n), n) for n in range(3)]
    rows += [(None, date(2024, 1, 1), 7)]
    columns = "athlete string, workout_date date, total_sets int"
    rest = ["workout_title", "gym_detail", "total_exercises", "muscles_trained", "total_tonnage", "session_duration_min", "tonnage_per_min"]
    frame = spark.createDataFrame(rows, columns)
    for c in rest:
        frame = frame.withColumn(c, F.lit(None).cast("string"))
    got = curated.sessions(frame, entity=["athlete"]).collect()
    days = lambda who: sorted(r.workout_date for r in got if r.athlete == who)
    assert days("a") == [date(2026, 1, 1) + timedelta(days=n) for n in range(10, 40)]
    assert days("b") == [date(2025, 3, n) for n in (1, 2, 3)] and days(None) == [date(2024, 1, 1)]
    assert len(curated.sessions(frame, entity=["athlete"], limit=2).collect()) == 5


def test_ranges_of_report_days():
    day = lambda n: date(2026, 1, 1) + timedelta(days=n)
    assert curated.day_ranges([], 30, 4) == []
    assert curated.day_ranges([day(40), day(0), day(5), day(100)], 7, 4) == [(day(-7), day(5)), (day(33), day(40)), (day(93), day(100))]
    assert curated.day_ranges([day(40), day(0), day(100)], 7, 2) == [(day(-7), day(40)), (day(93), day(100))]
    assert curated.day_ranges([day(n) for n in range(0, 1000, 50)], 7, 1) == [(day(-7), day(950))]


def test_missing_texts_keep_their_lines(spark):
    asked = spark.createDataFrame([(1, 9)], "conv_id int, turn int")
    answers = spark.createDataFrame([(1, 1, "q", "a", False), (1, 2, None, None, False)], "conv_id int, turn int, question string, answer string, is_error boolean")
    got = questions.answer_history(asked, answers).first()
    assert got.n_answers == 2 and got.history == "user: q\nassistant: a\nuser: \nassistant: "
    evidence = spark.createDataFrame([(1, 1, "t", "x"), (1, 2, None, "y"), (1, 3, "u", None)], "query_id int, rank int, title string, content string")
    assert questions.evidence_context(evidence).first().context == "[1] t\nx\n\n[2] \ny\n\n[3] u\n"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("limit", [1_000_000, 1])
def test_totals_and_distinct_in_both_ways(spark, limit):
    from tidemark.operators import rollup

    rows = [("a", None, 1, "x"), ("a", None, 2, "x"), (None, 1, 3, "y"), (None, 1, 4, None), ("b", 2, None, None), ("a", None, 2, "z")]
    frame = spark.createDataFrame(rows, "k string, m int, v int, w string")
    totals = [rollup.summed("v", "s", "bigint"), rollup.counted("n"), rollup.counted_if(F.col("v") > 2, "big"), rollup.largest("w"), rollup.smallest("v", "low")]
    distinct = {"d_w": "w", "d_v": "v"}
    want = sorted([("a", None, 5, 3, 0, "z", 1, 2, 2), (None, 1, 7, 2, 2, "y", 3, 1, 2), ("b", 2, None, 1, 0, None, None, 0, 0)], key=repr)
    got = rollup.totals_and_distinct(frame, ["k", "m"], totals, distinct, limit)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want
    reduced = rollup.parts(frame, ["k", "m"], totals, ["w", "v"])
    assert sorted((tuple(r) for r in rollup.from_parts(reduced, ["k", "m"], totals, distinct, limit).collect()), key=repr) == want


def scored(queries, items, k):
    return {(r.query_id, r.item_id) for r in similarity.top_k(queries, items, k=k, threshold=-9).collect()}


def test_index_of_all_cells_is_exact_and_few_probes_find_most(spark, folder):
    # Items around 40 places, as real embeddings lie; queries near some of them.
    rng = np.random.default_rng(4)
    places = rng.normal(size=(40, 24))
    near = lambda n, spread: places[rng.integers(0, 40, n)] + rng.normal(size=(n, 24)) * spread
    items = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(near(3000, 0.4))] + [(9000, None)], "item_id int, embedding array<double>")
    queries = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(near(60, 0.3))], "query_id int, embedding array<double>")
    index = similarity.build_index(items, f"{folder}/ix", 32)
    assert index.items.count() == 3000 and len(index.centroids()) == 32
    want = scored(queries, items, 10)
    found = lambda probes: {(r.query_id, r.item_id) for r in similarity.indexed_top_k(queries, index, probes, k=10, threshold=-9).collect()}
    assert found(32) == want and len(found(4) & want) >= 0.9 * len(want)
    with pytest.raises(ValueError):
        similarity.build_index(items, f"{folder}/iy", 4, metric="other")


@pytest.mark.parametrize("metric", similarity.METRICS)
def test_index_in_blocks_of_queries(spark, folder, monkeypatch, metric):
    monkeypatch.setattr(similarity, "BLOCK_BYTES", 200)
    monkeypatch.setattr(similarity, "MERGED_TASKS", 2)
    rng = np.random.default_rng(5)
    make = lambda n, name: spark.createDataFrame([(i, rng.normal(size=4).tolist()) for i in range(n)], f"{name} int, embedding array<double>").repartition(7)
    items, queries = make(90, "item_id"), make(20, "query_id")
    index = similarity.build_index(items, f"{folder}/ix", 6, metric=metric)
    key = lambda df: sorted(map(tuple, df.collect()))
    want = key(similarity.top_k(queries, items, k=3, threshold=-99, metric=metric))
    assert len(want) == 60 and key(similarity.indexed_top_k(queries, index, 6, k=3, threshold=-99)) == want
    none = items.limit(0)
    assert similarity.indexed_top_k(queries, similarity.build_index(none, f"{folder}/no", 4, metric=metric), 2).count() == 0
    assert similarity.indexed_top_k(queries.limit(0), index, 2).count() == 0


def test_index_reads_the_probed_folders_only(spark, folder):
    rng = np.random.default_rng(6)
    items = spark.createDataFrame([(i, rng.normal(size=4).tolist()) for i in range(200)], "item_id int, embedding array<double>")
    index = similarity.build_index(items, f"{folder}/ix", 10)
    one = spark.createDataFrame([(1, rng.normal(size=4).tolist())], "query_id int, embedding array<double>")
    scan = next(line for line in plan_of(similarity.indexed_top_k(one, index, 2)).split("\n") if "FileScan" in line)
    assert "PartitionFilters: [cell" in scan and scan.split("PartitionFilters: [")[1].split("]")[0].count(",") == 1


def test_candidates_of_many_tasks_meet_in_two_steps(spark):
    rng = random.Random(8)
    rows = [(rng.randrange(3), n, rng.randrange(50) / 10) for n in range(600)]
    frame = spark.createDataFrame(rows, similarity.CANDIDATE).repartition(12)
    one, two = (similarity.rank_candidates(frame, 4, 0.5, salts) for salts in (1, 5))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect())) and one.count() == 12
    assert plan_of(two).count("Exchange hashpartitioning(query_id") == 2 * plan_of(one).count("Exchange hashpartitioning(query_id")
    assert "salt" in plan_of(two) and "salt" not in plan_of(one)


def test_totals_and_distinct_scan_and_shuffle_once(spark, folder):
    from tidemark.operators import rollup

    spark.range(1000).selectExpr("id % 7 AS k", "id % 5 AS a", "id % 3 AS b", "id AS v").write.parquet(f"{folder}/t")
    got = rollup.totals_and_distinct(spark.read.parquet(f"{folder}/t"), ["k"], [rollup.summed("v")], {"n_a": "a", "n_b": "b"})
    plan = plan_of(got)
    assert "Expand" not in plan and plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1


def test_routes_are_the_published_ones(spark):
    asked = {
        "what did i do yesterday": "raw_sets", "my prs": "pr", "should i deload": "fatigue", "am i getting stronger": "strength",
        "which muscle do i neglect": "volume", "push to pull": "balance", "enough sets": "volume", "how often": "sessions", "hello": "llm",
    }
    frame = spark.createDataFrame([(k,) for k in asked], "q string")
    assert {r.q: r.route for r in questions.route_questions(frame, "q").collect()} == asked


def test_the_size_sample_is_taken_once(spark):
    # Ids drawn anew at each evaluation would show a second look at the sample.
    frame = spark.range(0, 4000, 1, 4).select((F.col("id") % 4).alias("k"), F.col("id").alias("o"))
    drawn = frame.withColumn("k", F.when(F.rand() < 0.5, F.col("k")).otherwise(F.col("k") + 4))
    big = ordering.oversized_groups(drawn, ["k"], limit=900, fraction=1.0)
    assert [sorted(tuple(r) for r in big.collect()) for _ in range(3)].count(sorted(tuple(r) for r in big.collect())) == 3
    got = ordering.number_within(frame, ["k"], [F.col("o")], "n", ordering.oversized_groups(frame, ["k"], limit=900, fraction=1.0))
    rows = got.collect()
    assert len(rows) == 4000 and all(r.n == r.o // 4 + 1 for r in rows)


def test_rules_are_parameters(spark):
    frame = spark.createDataFrame([("my knee hurts",), ("how heavy",)], "q string")
    got = questions.route_questions(frame, "q", routes=[("health", ["knee"], []), ("load", [], ["heavy"])]).collect()
    assert {r.q: r.route for r in got} == {"my knee hurts": "health", "how heavy": "load"}
    venue = sets.venue_from_text(F.lower("q"), F.lit(None).cast("string"), venue_words=[("knee", "clinic")])
    places = frame.select("q", sets.venue_parent(venue, {"clinic": "town"}).alias("p"), sets.venue_parent(venue, {}).alias("none"))
    assert {tuple(r) for r in places.collect()} == {("my knee hurts", "town", "other"), ("how heavy", None, None)}


def test_history_shows_the_resolved_question(spark):
    asked = spark.createDataFrame([(1, 9)], "conv_id int, turn int")
    answers = spark.createDataFrame(
        [(1, 1, "and legs?", "Volume of legs?", "a", False), (1, 2, "plain", None, None, False)],
        "conv_id int, turn int, question string, resolved string, answer string, is_error boolean",
    )
    got = questions.answer_history(asked, answers).first()
    assert got.history == "user: Volume of legs?\nassistant: a\nuser: plain\nassistant: "


def test_repeated_keys_share_one_scan(spark, folder):
    rows = [(1, "a", None), (1, "a", None), (2, "a", 1.0), (None, "b", 1.0), (None, "b", 2.0), (3, None, None), (3, "null", None), (4, "c", 0.1)]
    spark.createDataFrame(rows, "i int, s string, x double").write.parquet(f"{folder}/t")
    frame = spark.read.parquet(f"{folder}/t")
    checks = {"i": ["i"], "s": ["s"], "i+s": ["i", "s"], "all": ["i", "s", "x"]}
    got = {r.check_name: r.violations for r in quality.repeated_keys(frame, checks).collect()}
    assert got == {name: quality.unique(frame, *keys).count() for name, keys in checks.items()} == {"i": 2, "s": 2, "i+s": 2, "all": 1}
    clean = quality.repeated_keys(frame.filter("i IN (2, 4)"), checks)
    assert {r.violations for r in clean.collect()} == {0} and "FileScan" not in plan_of(clean)


def test_rows_sent_as_text_come_back_as_they_were(spark):
    from datetime import datetime
    from decimal import Decimal

    texts = ["", "a", "\x01", "\x02", "\x02n", "\x02a", "\x02b\x01", "n", "1\n2", "\u00fc\u4e2d", None]
    times = [datetime(2024, 3, 31, 2, 30, 0, 1), datetime(1900, 1, 1), None]
    rows = [
        (k % 3 if k % 4 else None, t, texts[-k % len(texts)], when, date(2024, 2, 29) if k % 2 else None, Decimal("-0.10") if k % 5 else None,
         k % 2 == 0, 0.1 * k, [t, None], None)
        for k, t in enumerate(texts * 2) for when in times
    ]
    kind = "key int, t string, u string, w timestamp, d date, n decimal(6,2), b boolean, x double, l array<string>, z bigint"
    frame = spark.createDataFrame(rows, kind)
    for keys in (["key"], ["key", "t"], ["w", "u"]):
        got = ordering.gathered(frame, keys)
        assert got.dtypes == frame.dtypes
        assert sorted(map(repr, got.collect())) == sorted(map(repr, frame.collect()))
    few = frame.select("key", "t")
    assert sorted(map(repr, ordering.gathered(few, ["key"]).collect())) == sorted(map(repr, few.collect()))
    invalid = spark.sql("select 1 as k, cast(x'41ff42' as string) as t, 'x' as u")
    assert ordering.gathered(invalid, ["k"]).select(F.hex("t")).first()[0] == "41FF42"


def test_sets_are_shuffled_as_few_columns(spark):
    import re

    from tidemark.bindings.training_log import locations, raw_workouts, templates

    d = "/root/testdata/sf0.001"
    clean = sets.clean_sets(raw_workouts(spark, d), locations(spark, d), templates(spark, d), ["athlete"])
    plan = clean._jdf.queryExecution().optimizedPlan().toString().split("\n")
    at = next(n for n, line in enumerate(plan) if "RepartitionByExpression" in line and "workout_id" in line)
    below = re.search(r"Project \[(.*)\]", plan[at + 1])[1]
    assert "AS _sent" in below and "exercise_notes#" not in below.split("concat_ws")[0]
