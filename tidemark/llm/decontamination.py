"""Benchmark decontamination by Wu-Manber multi-pattern search.

Documents and benchmark texts become `` w1 w2 ... `` with single spaces, so a
window of words is a byte pattern with a space at both ends. The shift table
over hashed blocks says how far a search window may jump; at shift 0 the bucket
of the block's value names the patterns to compare byte by byte. Many search
windows advance at once as numpy lanes.

Edge cases: a NULL or empty text has no words and no hits (``items_sha256`` is
the digest of the empty string); items without words or without an id are no
patterns; repeated documents give a row each; repeated item ids count once.
Rows without an id and ids with several texts are judged text by text.
Extra columns are ignored, and kept by ``clean``. An empty benchmark leaves
every document clean.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.frames import packed, stored
from tidemark.llm.textbuf import ALNUM, Words, slices, words

WINDOW = 13
#: Bytes of patterns that one pass over the documents carries.
BLOCK_BYTES = 16 << 20
#: Patterns are searched in classes of similar length, as the shortest bounds the shift.
CLASSES = (3, 6, 12, 24, 48)
TABLE_BITS = 20
LANE = 512

#: Hit words as ranges (first and last word, from 0), and the items whose windows occur, in order.
FOUND = "n_words long, hits array<struct<first:long,last:long>>, items array<string>"


def spaced(found: Words) -> tuple[np.ndarray, np.ndarray]:
    """Each document as newline, space, then each word and a space; and where each word starts."""
    size = found.ends - found.starts
    doc = found.of_doc()
    begin = np.cumsum(size + 1) - (size + 1) + 2 * (doc + 1)
    total = int((size + 1).sum()) + 2 * len(found.counts)
    out = np.full(total + 8, 0x20, np.uint8)
    at = np.concatenate([[0], np.cumsum(size + 1)])[found.first[:-1]] + 2 * np.arange(len(found.counts))
    out[at] = 0x0A
    out[total:] = 0x0A
    shift = np.repeat(begin - found.starts, size)
    inside = np.repeat(found.starts - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    out[inside + shift] = found.data[inside]
    return out, begin


class Searcher:
    """The tables of one length class."""

    def __init__(self, patterns: list[bytes], numbers: list[int]):
        self.patterns, self.numbers = patterns, np.array(numbers)
        self.m = min(map(len, patterns))
        self.b = min(8, self.m)
        heads = np.frombuffer(b"".join(p[:self.m] for p in patterns), np.uint8).reshape(len(patterns), self.m)
        reach = self.m - self.b
        self.shift = np.full(1 << TABLE_BITS, min(reach + 1, 255), np.uint8)
        for j in range(reach + 1):
            np.minimum.at(self.shift, self._slot(self._value(heads[:, j:j + self.b])), np.uint8(min(reach - j, 255)))
        tail = self._value(heads[:, reach:])
        order = np.argsort(tail, kind="stable")
        self.values, first = np.unique(tail[order], return_index=True)
        self.first = np.append(first, len(order))
        self.order = order

    def _value(self, block: np.ndarray) -> np.ndarray:
        wide = np.zeros((len(block), 8), np.uint8)
        wide[:, :self.b] = block
        return wide.view(np.uint64)[:, 0]

    @staticmethod
    def _slot(value: np.ndarray) -> np.ndarray:
        return ((value * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)

    def find(self, data: np.ndarray) -> Iterator[tuple[int, int]]:
        """(start, pattern number) of every occurrence."""
        first, last = self.m - 1, len(data)
        if first >= last:
            return
        at = np.arange(first, last, LANE)
        end = np.minimum(at + LANE, last)
        back = np.arange(1 - self.b, 1)
        whole = data.tobytes()
        while len(at):
            value = self._value(data[at[:, None] + back])
            step = self.shift[self._slot(value)]
            zero = np.flatnonzero(step == 0)
            if len(zero):
                bucket = np.searchsorted(self.values, value[zero])
                bucket[bucket == len(self.values)] = 0
                same = self.values[bucket] == value[zero]
                for place, k in zip((at[zero[same]] - self.m + 1).tolist(), bucket[same].tolist()):
                    for p in self.order[self.first[k]:self.first[k + 1]].tolist():
                        pattern = self.patterns[p]
                        if whole[place:place + len(pattern)] == pattern:
                            yield place, int(self.numbers[p])
            at = at + np.maximum(step, 1)
            alive = at < end
            at, end = at[alive], end[alive]


class Matcher:
    """All windows of one block: pattern, number of words, items that hold it."""

    def __init__(self, windows: list[tuple[str, int, list[str]]]):
        self.size = np.array([w[1] for w in windows], np.int64)
        self.items = [w[2] for w in windows]
        self.patterns = [f" {w[0]} ".encode() for w in windows]
        self.searchers: list[Searcher] | None = None

    def __getstate__(self):
        return self.__dict__ | {"searchers": None}

    def hits(self, found: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First word, word count and window of every occurrence in a slice."""
        if self.searchers is None:
            classes: dict[int, list[int]] = {}
            for n, p in enumerate(self.patterns):
                classes.setdefault(sum(len(p) >= c for c in CLASSES), []).append(n)
            self.searchers = [Searcher([self.patterns[n] for n in own], own) for own in classes.values()]
        data, begin = spaced(found)
        got = [x for s in self.searchers for x in s.find(data)]
        place, window = (np.array(x, np.int64) for x in zip(*got)) if got else (np.zeros(0, np.int64),) * 2
        return np.searchsorted(begin, place + 1), self.size[window] if got else window, window


def _blocks(benchmark: DataFrame, window: int, block_bytes: int) -> Iterator[tuple[bool, Matcher]]:
    """Distinct windows with their items, as many at a time as the block size allows, and whether one block holds all."""

    def cut(batches):
        for batch in batches:
            for part, offsets, data in slices(batch):
                found = words(offsets, data, ALNUM)
                ids = part.column("item_id").to_pylist()
                rows = []
                for d, item in enumerate(ids):
                    lo, hi = found.first[d], found.first[d + 1]
                    if item is None or lo == hi:
                        continue
                    own = [found.data[s:e].tobytes().decode() for s, e in zip(found.starts[lo:hi], found.ends[lo:hi])]
                    size = min(window, len(own))
                    rows += [(" ".join(own[i:i + size]), size, item) for i in range(len(own) - size + 1)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.string())],
                    names=["words", "size", "item_id"],
                )

    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    windows = stored(items.mapInArrow(cut, "words string, size long, item_id string").groupBy("words", "size").agg(
        F.sort_array(F.collect_set("item_id")).alias("items")
    ), "windows")
    total = windows.agg(F.sum(F.octet_length("words") + 64 + F.size("items") * 16)).first()[0] or 0
    parts = max(1, -(-total // block_bytes))
    for k in range(parts):
        own = windows if parts == 1 else windows.filter(F.pmod(F.xxhash64("words"), F.lit(parts)) == k)
        yield parts == 1, Matcher([(r[0], r[1], list(r[2])) for r in own.collect()])


def _ranges(firsts: np.ndarray, lasts: np.ndarray) -> list[dict]:
    """Ranges of words joined where they touch or overlap."""
    order = np.argsort(firsts, kind="stable")
    firsts, lasts = firsts[order], np.maximum.accumulate(lasts[order]) if len(order) else lasts
    begins = np.flatnonzero(np.concatenate([[True], firsts[1:] > lasts[:-1] + 1])) if len(order) else order
    ends = np.append(begins[1:], len(firsts)) - 1 if len(order) else order
    return [{"first": a, "last": b} for a, b in zip(firsts[begins].tolist(), lasts[ends].tolist())]


def _batch(part: pa.RecordBatch, rows: np.ndarray, n_words: list[int], hits: list, items: list, drop_text: bool = True) -> pa.RecordBatch:
    kept = [c for c in part.schema.names if c not in ("text" if drop_text else "", "found")]
    own = part if len(rows) == part.num_rows else part.take(pa.array(rows))
    kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
    return pa.RecordBatch.from_arrays(
        [*[own.column(c) for c in kept], pa.array(n_words, pa.int64()), pa.array(hits, kind), pa.array(items, pa.list_(pa.string()))],
        names=[*kept, "n_words", "hits", "items"],
    )


def _scan(block, every: bool, drop_text: bool = True):
    """What one block of windows finds: a row per document, or only for those with a hit."""

    def run(batches):
        matcher = block.value
        for batch in batches:
            for part, offsets, data in slices(batch):
                found = words(offsets, data, ALNUM)
                firsts, lengths, window = matcher.hits(found)
                doc = np.searchsorted(found.first, firsts, "right") - 1
                order = np.argsort(doc, kind="stable")
                firsts, lasts, window, doc = firsts[order], (firsts + lengths - 1)[order], window[order], doc[order]
                rows = np.arange(part.num_rows) if every else np.unique(doc)
                lo, hi = np.searchsorted(doc, rows), np.searchsorted(doc, rows, "right")
                hits, items = [], []
                for d, a, b in zip(rows.tolist(), lo.tolist(), hi.tolist()):
                    begin = found.first[d]
                    hits.append(_ranges(firsts[a:b] - begin, lasts[a:b] - begin) if b > a else [])
                    items.append(sorted({i for w in set(window[a:b].tolist()) for i in matcher.items[w]}) if b > a else [])
                yield _batch(part, rows, found.counts[rows].tolist(), hits, items, drop_text)

    return run


def _merge(batches):
    """Words counted, and what the blocks found put together."""
    for batch in batches:
        for part, offsets, data in slices(batch):
            found = words(offsets, data, ALNUM)
            hits, items = [], []
            for runs in part.column("found").to_pylist():
                own = [h for r in runs or [] for h in r["hits"]]
                hits.append(_ranges(np.array([h["first"] for h in own], np.int64), np.array([h["last"] for h in own], np.int64)))
                items.append(sorted({i for r in runs or [] for i in r["items"]}))
            yield _batch(part, np.arange(part.num_rows), found.counts.tolist(), hits, items)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES, digest: bool = False) -> DataFrame:
    """Per document its number of words, the ranges of hit words and the items whose windows occur in it.

    The windows travel to the tasks in blocks of ``block_bytes``, one block at a
    time. If all fit in one block the documents are scanned once and not shuffled. Otherwise
    each block is a pass whose hits are written out, and only documents with a
    hit meet again, by id and digest of the text. ``digest`` adds that digest.
    """
    context = docs.sparkSession.sparkContext
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.sha2("text", 256).alias("digest"), F.col("text").cast("string").alias("text"))
    parts = []
    for alone, matcher in _blocks(benchmark, window, block_bytes):
        block = context.broadcast(matcher)
        if alone:
            found = (own if digest else own.drop("digest")).mapInArrow(_scan(block, True), f"doc_id long, {'digest string, ' * digest}{FOUND}")
            return found
        parts.append(stored(own.mapInArrow(_scan(block, False), f"doc_id long, digest string, {FOUND}"), "hits"))
        block.unpersist()
    hits = parts[0]
    for more in parts[1:]:
        hits = hits.unionByName(more)
    runs = hits.distinct().groupBy("doc_id", "digest").agg(F.collect_list(F.struct("hits", "items")).alias("found")).alias("b")
    same = F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & F.col("a.digest").eqNullSafe(F.col("b.digest"))
    every = own.alias("a").join(stored(runs, "runs").alias("b"), same, "left").select("a.*", "b.found")
    out = every.mapInArrow(_merge, f"doc_id long, digest string, {FOUND}")
    return out if digest else out.drop("digest")


def n_hit() -> Column:
    """Words inside any occurrence of a window."""
    return F.aggregate("hits", F.lit(0).cast("long"), lambda a, h: a + h["last"] - h["first"] + 1)


def is_contaminated() -> Column:
    """At least a twentieth of a document's words are hit, and some word is."""
    return (n_hit() > 0) & (20 * n_hit() >= F.col("n_words"))


def counted(found: DataFrame) -> DataFrame:
    """The result of ``contamination`` as counts and a digest of the items."""
    return found.select(
        "doc_id", "n_words", n_hit().alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), is_contaminated().alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without the contaminated ones.

    Rows go by id and text: of an id with several texts, or of rows without an
    id, those with a contaminated text go and all others stay.
    """
    alone, matcher = next(_blocks(benchmark, window, block_bytes))
    if alone:
        # One block: the scan that judges a row passes it on, so nothing is joined.
        rest = F.struct(*[c for c in docs.columns if c != "text"])
        own = docs.select(rest.alias("row"), F.col("text").cast("string").alias("text"))
        block = docs.sparkSession.sparkContext.broadcast(matcher)
        schema = T.StructType([*own.schema.fields, *T.StructType.fromDDL(FOUND).fields])
        judged = own.mapInArrow(_scan(block, True, drop_text=False), schema).filter(~is_contaminated())
        return judged.select(*[F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])
    found = contamination(docs, benchmark, window, block_bytes, digest=True).filter(is_contaminated())
    bad = found.select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest")).distinct()
    # Written first, so that its size is known when the join is planned: few rows are broadcast and the texts stay in place.
    own = packed(docs, F.col("doc_id").cast("long").alias("_own_id"), F.sha2(F.col("text").cast("string"), 256).alias("_own_digest"))
    same = F.col("_own_id").eqNullSafe(F.col("_id")) & (F.col("_own_digest") == F.col("_digest"))
    return own.join(stored(bad, "contaminated"), same, "left_anti").select("row.*")
