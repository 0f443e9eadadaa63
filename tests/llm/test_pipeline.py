"""The stages one after another: what goes goes, what stays is unchanged."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline as cp
from tests.llm.conftest import SF, alnum
from tests.llm.test_learned_operators import statistics_by_hand
from tests.llm.test_text_operators import base_spans, contaminated, groups
from tidemark.llm import mixing


def test_stages_take_effect(spark, docs):
    now, names = docs, docs.columns
    for number, (_, stage) in enumerate(cp.STAGES):
        before = {r.doc_id: r for r in now.collect()}
        out = stage(spark, now, SF)
        after = {r.doc_id: r for r in out.collect()}
        assert set(after) <= set(before)
        if number < 4:
            assert out.columns == names
        if number == 0:
            assert not [r for r in after.values() if statistics_by_hand(r.text)[5]]
        if number == 1:
            _, component = groups([(r.doc_id, r.text) for r in before.values()])
            assert set(after) == set(component.values())
        if number == 2:
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            assert set(after) == {k[0] for k in contaminated(before.values(), items) if not k[5]}
        if number == 3:
            assert set(after) == set(before)
            for i, r in after.items():
                assert not base_spans(r.text) and (r.text == before[i].text) == (not base_spans(before[i].text) and r.n_chars == before[i].n_chars)
        if number == 4:
            rows = out.collect()
            assert Counter(r.doc_id for r in rows) == {r.doc_id: r.copies for r in rows} and all(r.rate > 0 for r in rows)
        now = out


def test_five_stages_in_their_order():
    assert [name.split()[0] for name, _ in cp.STAGES] == ["quality", "near-duplicate", "benchmark", "secret", "mixing"]


def test_run_gives_the_rows_of_the_last_stage(spark):
    rows = cp.run(spark, SF).collect()
    assert rows and {"doc_id", "rate", "copies"} <= set(rows[0].asDict())
    assert all(len(alnum(str(r.doc_id))) == 1 for r in rows)


def test_odd_rows_pass_all_stages(spark, odd, empty):
    for frame in (odd, empty):
        now = frame
        for number, (_, stage) in enumerate(cp.STAGES):
            now = stage(spark, now, SF)
            if number < 4:
                assert now.columns == frame.columns
                # Other columns come through as they were.
                assert all(r.rank == 1 and r.q_all == 2 and r._id == 5 for r in now.collect() if frame is odd)
        now.collect()


def test_the_mixed_corpus_has_each_document_as_often_as_its_copies_say(docs, odd, labels):
    for frame in (docs, odd):
        rated = mixing.rated(frame, labels)
        assert set(frame.columns) <= set(rated.columns)
        # Rates away from 1, so that some documents go and others are repeated.
        rated = rated.withColumn("copies", F.pmod(F.xxhash64("text"), F.lit(4)))
        want = Counter()
        for r in rated.collect():
            want[r.doc_id, r.text, r.source] += r.copies
        rows = mixing.repeated(rated).collect()
        assert Counter((r.doc_id, r.text, r.source) for r in rows) == +want and len(want) > len(+want) and max(want.values()) > 1
        assert all(1 <= r.copy <= r.copies for r in rows)


def test_run_ends_in_the_mixed_corpus(spark):
    rows = cp.run(spark, SF).collect()
    assert Counter((r.doc_id, r.copies) for r in rows) == {(r.doc_id, r.copies): r.copies for r in rows}
    assert all(r.copies > 0 and r.text is not None for r in rows if r.tokens)
