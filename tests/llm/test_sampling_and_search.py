"""Fill-in-middle, top-k search and resampling against brute force, over a fixture and the odd rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.llm.conftest import SF, alnum
from tidemark.llm import fill_middle, resampling, vector_file
from tidemark.llm.textbuf import ALNUM, words

LINE = re.compile(r"[^\n]*\n|[^\n]+")
sha = lambda text: hashlib.sha256(text.encode()).hexdigest()


def hash_of(doc_id):
    return sha(f"7:{'' if doc_id is None else doc_id}")


def cut_by_hand(doc_id, text, percent=100, spm=50):
    text = text or ""
    units = LINE.findall(text)
    n, h = len(units), [int(hash_of(doc_id)[8 * k:8 * k + 8], 16) for k in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= percent:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = ("".join(units[i:j]) for i, j in ((0, a), (a, b), (b, n)))
    form = "spm" if h[3] % 100 < spm else "psm"
    output = f"<P>{prefix}<S>{suffix}<M>{middle}" if form == "psm" else f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, n, form, len(prefix), len(middle), output


@pytest.mark.parametrize("share", [(100, 50), (40, 0)])
@pytest.mark.parametrize("which", ["docs", "odd", "lines"])
def test_fill_in_middle_equals_plain_cuts(spark, which, share, request):
    if which == "lines":
        chance = random.Random(3)
        line = lambda: chance.choice(["", "é" * chance.randrange(900), "a" * chance.randrange(600), "日本", "<", "S>", "<P", " <M> "])
        rows = [(i, "\n".join(line() for _ in range(chance.randrange(60)))) for i in range(300)] + [(900, "\n"), (901, "\n\n"), (902, "x" * 5000), (903, "<S>")]
        frame = spark.createDataFrame(rows, "doc_id long, text string")
    else:
        frame = request.getfixturevalue(which)
    want = Counter(cut_by_hand(r.doc_id, r.text, *share) for r in frame.collect())
    cut = fill_middle.fill_in_middle(frame, percent=share[0], spm_percent=share[1])
    assert Counter(tuple(r) for r in cut.collect()) == want
    texts = Counter((r.doc_id, sha(r.text or "")) for r in frame.collect())
    assert Counter((r.doc_id, r.restored_sha256) for r in fill_middle.digests(cut).collect()) == texts


def test_transformed_rows_keep_their_columns(spark, odd, empty):
    out = fill_middle.transformed(odd)
    assert out.columns == [*odd.columns, "fim_form"]
    want = Counter((r.doc_id, None if r.text is None else cut_by_hand(r.doc_id, r.text)[5], r.lang, r.key) for r in odd.collect())
    assert Counter((r.doc_id, r.text, r.lang, r.key) for r in out.collect()) == want
    assert fill_middle.transformed(empty).count() == 0 and fill_middle.digests(fill_middle.fill_in_middle(empty)).count() == 0


def test_fenwick_tree_equals_running_sums():
    chance = np.random.default_rng(5)
    for size in (0, 1, 2, 3, 7, 8, 9, 64, 1000):
        counts = chance.integers(0, 4, size)
        tree, total = fill_middle.Fenwick(counts), np.concatenate([[0], np.cumsum(counts)])
        assert (tree.before(np.arange(size + 1)) == total).all()
        target = np.arange(1, total[-1] + 1)
        block, before = tree.find(target)
        assert (block == np.searchsorted(total, target) - 1).all() and (before == total[block]).all()


def whole(vector):
    if vector is None or any(x is None or not math.isfinite(x) for x in vector):
        return None
    return tuple(math.floor(256 * x) for x in vector)


def nearest_by_hand(rows, queries, k):
    items = {(i, whole(v)) for i, v in rows if i is not None and whole(v) is not None}
    out = Counter()
    for i, v in {(i, whole(v)) for i, v in queries if i is not None and whole(v) is not None}:
        scores = sorted((-sum(x * y for x, y in zip(v, w)), j) for j, w in items if (j, w) != (i, v))
        out.update((i, n + 1, j, -s) for n, (s, j) in enumerate(scores[:k]))
    return out


def odd_vectors(chance):
    some = lambda n, by=1.0: [chance.gauss(0, by) for _ in range(n)]
    hot = some(6)
    rows = [(i, some(6)) for i in range(150)] + [(200 + i, hot) for i in range(120)] + [(350, hot), (350, hot), (400, some(6)), (400, some(6)), (450, hot)]
    rows += [(500, None), (550, []), (600, [1.0, None, 2.0]), (650, [math.nan] * 6), (700, [math.inf]), (None, some(6)), (750, [0.5, -0.25]), (800, some(6, 1e4)), (850, [0.0] * 6)]
    return rows


@pytest.mark.parametrize("sizes", [{}, {"bits": 2, "block_bytes": 60}, {"bits": 8, "block_bytes": 200}])
@pytest.mark.parametrize("k", [1, 5, 400])
def test_top_k_equals_all_scores(spark, k, sizes):
    rows = odd_vectors(random.Random(9))
    frame = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, exact string, number int").repartition(5)
    got = vector_file.top_k(frame, frame.filter("vec_id % 50 = 0"), k=k, **sizes)
    assert Counter(tuple(r) for r in got.collect()) == nearest_by_hand(rows, [r for r in rows if r[0] is not None and r[0] % 50 == 0], k)


def test_top_k_of_large_components(spark):
    chance = random.Random(2)
    rows = [(i, [chance.uniform(-1, 1) * 10**6 for _ in range(5)]) for i in range(60)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert Counter(tuple(r) for r in vector_file.top_k(frame, frame).collect()) == nearest_by_hand(rows, rows, 5)


def test_top_k_of_nothing(spark):
    frame = spark.createDataFrame([(1, [1.0]), (2, None)], "vec_id long, embedding array<float>")
    assert vector_file.top_k(frame.limit(0), frame.limit(0)).count() == 0
    assert vector_file.top_k(frame, frame.limit(0)).count() == 0 and vector_file.top_k(frame.limit(0), frame).count() == 0
    assert vector_file.top_k(frame, frame).count() == 0
    assert [tuple(r) for r in vector_file.top_k(frame, frame, leave_out_self=False).collect()] == [(1, 1, 1, 256 * 256)]


def test_top_k_with_other_queries(spark):
    chance = random.Random(4)
    rows = [(i, [chance.gauss(0, 1) for _ in range(4)]) for i in range(80)]
    asked = [(i, [chance.gauss(0, 1) for _ in range(4)]) for i in range(20)]
    items = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    queries = spark.createDataFrame(asked, "asked long, embedding array<double>")
    got = vector_file.top_k(items, queries, query_id="asked", k=3)
    assert Counter(tuple(r) for r in got.collect()) == nearest_by_hand(rows, asked, 3)


def features(text):
    w = alnum(text)
    return w, [zlib.crc32(x.encode()) % 10_000 for x in w + [f"{a} {b}" for a, b in zip(w, w[1:])]]


def resampled_by_hand(rows, target, share=25, least=20):
    own = [(r.doc_id, *features(r.text)) for r in rows]
    s, t = Counter(k for _, _, f in own for k in f), Counter(k for x in target for k in features(x)[1])
    s_all, t_all = s.total(), t.total()
    gain = lambda k: math.floor(1000 * math.log((t[k] + 1) * (s_all + 10_000) / ((s[k] + 1) * (t_all + 10_000))))
    out = []
    for i, w, f in own:
        weight = sum(map(gain, f)) // len(f) if f else 0
        noise = math.floor(-1000 * math.log(-math.log((int(hash_of(i)[:8], 16) + 0.5) / 4294967296)))
        out.append([len(w), i, len(f), weight, weight + noise])
    able = sorted((r for r in out if r[0] >= least), key=lambda r: (-r[4], r[1] is None, r[1] or 0))
    rank = {id(r): n + 1 for n, r in enumerate(able[:share * len(able) // 100])}
    return Counter((*r[1:], rank.get(id(r))) for r in out)


@pytest.mark.parametrize("sizes", [{}, {"bits": 3, "chunk": 7}, {"share": 100, "least_words": 0, "bits": 16}])
@pytest.mark.parametrize("which", ["docs", "odd"])
def test_resampling_equals_plain_ranks(spark, which, sizes, request):
    frame = request.getfixturevalue(which)
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    want = resampled_by_hand(frame.collect(), [r.text for r in bench.collect()], sizes.get("share", 25), sizes.get("least_words", 20))
    assert Counter(tuple(r) for r in resampling.resampled(frame, bench, **sizes).collect()) == want


def test_drawn_rows_are_whole(spark, docs, odd, empty):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    ranked = {r.doc_id for r in resampling.resampled(docs, bench).collect() if r["rank"]}
    rows = resampling.drawn(docs, bench)
    assert rows.columns == docs.columns and {r.doc_id for r in rows.collect()} == ranked
    every = resampling.drawn(odd, bench, share=100, least_words=0)
    assert Counter(map(str, every.collect())) == Counter(map(str, odd.collect()))
    assert resampling.drawn(empty, bench).count() == 0 and resampling.resampled(empty, bench).count() == 0
    assert resampling.resampled(docs, bench.limit(0)).count() == docs.count()


@pytest.mark.parametrize("sizes", [{"bits": 1, "chunk": 3}, {"bits": 11, "chunk": 50}])
def test_radix_ranks_of_extreme_and_equal_keys(spark, sizes):
    chance = random.Random(6)
    ends = [-(2**63), 2**63 - 1, 0, -1, 1, None]
    rows = [(chance.choice(ends), chance.choice([*ends, *range(-9, 9)]), n) for n in range(200)]
    frame = spark.createDataFrame(rows, "a long, b long, n long").repartition(4)
    got = sorted(resampling.radix_ranked(frame, [("a", True), ("b", False)], **sizes).collect(), key=lambda r: r["rank"])
    assert [r["rank"] for r in got] == list(range(1, 201)) and {r.n for r in got} == set(range(200))
    key = lambda a, b: (a is None, -(a or 0), b is None, b or 0)
    assert [(r.a, r.b) for r in got] == [r[:2] for r in sorted(rows, key=lambda r: key(*r[:2]))]


def test_checksums_of_words_and_pairs():
    raw = (" ".join(["Hello wörld", "x" * 60, "a", "b" * 47, "c" * 48, "d" * 49, "é" * 40, "z", "日本語"])).encode()
    found = words(np.array([0, len(raw)]), np.frombuffer(raw, np.uint8), ALNUM)
    own = [found.data[a:b].tobytes() for a, b in zip(found.starts, found.ends)]
    assert resampling.word_crcs(found).tolist() == [zlib.crc32(w) for w in own]
    single, pair, doc = resampling.feature_buckets(found, 1 << 31)
    assert pair.tolist() == [zlib.crc32(a + b" " + b) % (1 << 31) for a, b in zip(own, own[1:])] and not doc.any()
