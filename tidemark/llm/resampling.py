"""Importance resampling towards a target distribution, ranked by a distributed radix sort.

Weights. Features are the runs of one and two consecutive words; a feature's
bucket is its CRC-32 modulo ``BUCKETS``. Tasks count buckets in an array each; the
arrays of all documents and of the target add up to one array of gains (the
floored log ratio of the two bucket frequencies), which is broadcast: its size
is the number of buckets. A document's weight is the floored mean of its gains, and
its score adds Gumbel noise drawn from its id.

Ranks. A least-significant-digit radix sort over the composite key (score
downwards, then id): for each digit, from the last to the first, a stable
counting sort. Rows lie in chunks of consecutive positions. Rows are counted per
(digit, chunk), a prefix sum over these counts gives where each chunk's rows
of a digit begin in the whole, and a row's place among those adds up to its
destination, from which its next chunk follows. Each pass is written to the shared
folder, so a lost executor costs one pass at most. Digits in which all
keys agree need no pass.

A chunk holds at most ``CHUNK`` rows whatever their keys are, so ties and hot
scores load no task more than others. A pass moves keys and counts only, never texts.

CRCs of words are computed for all words of a slice at once: CRC-32 is linear, so
each byte's share follows from its value and its distance from the word's end,
and the CRC of two joined words from the CRCs of both.

Edge cases: NULL and empty texts have no features, weight 0 and a score of noise alone; an
empty target or no documents leave every gain defined; documents of fewer than
``least_words`` words are never drawn; rows without an id draw their noise
from the empty id and come last among equal scores; repeated rows are drawn
each on its own; an id with several texts is several documents; extra columns are
ignored by ``resampled`` and kept by ``drawn``.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.frames import packed, stored
from tidemark.llm.textbuf import ALNUM, Words, slices, words

BUCKETS = 10_000
SEED = 7
LEAST_WORDS = 20
SHARE = 25
#: Bits of a digit of the radix sort.
DIGIT = 11
#: Rows of a chunk.
CHUNK = 1 << 17

#: Words up to so many bytes are hashed together, longer ones one by one.
SHORT = 48


# ---- CRC-32 of words and pairs of words ---------------------------------------------------------


def _shifts(count: int) -> np.ndarray:
    """[n, byte, value]: what the byte of a CRC becomes when n zero bytes follow; the CRC's start and end masks left out."""
    step = np.array([zlib.crc32(bytes([v]), 0xFFFFFFFF) ^ 0xFFFFFFFF for v in range(256)], np.uint32)
    out = np.zeros((count + 1, 4, 256), np.uint32)
    for b in range(4):
        out[0, b] = np.arange(256, dtype=np.uint32) << np.uint32(8 * b)
    for n in range(count):
        out[n + 1] = (out[n] >> np.uint32(8)) ^ step[out[n] & np.uint32(0xFF)]
    return out


_SHIFTS = _shifts(SHORT + 1)
#: The CRC of n zero bytes.
_ZEROS = np.array([zlib.crc32(bytes(n)) for n in range(SHORT + 2)], np.uint32)


def _shifted(crc: np.ndarray, count: np.ndarray) -> np.ndarray:
    """What CRCs contribute when so many bytes follow."""
    out = _SHIFTS[count, 0, crc & np.uint32(0xFF)]
    for b in range(1, 4):
        out = out ^ _SHIFTS[count, b, (crc >> np.uint32(8 * b)) & np.uint32(0xFF)]
    return out


def word_crcs(found: Words) -> np.ndarray:
    """CRC-32 of the bytes of each word."""
    size = found.ends - found.starts
    out = np.zeros(len(size), np.uint32)
    short = np.flatnonzero(size <= SHORT)
    if len(short):
        n = size[short]
        begin = np.cumsum(n) - n
        at = np.arange(int(n.sum())) - np.repeat(begin, n)
        byte = found.data[at + np.repeat(found.starts[short], n)]
        # A byte enters the register at its low end, and the rest of its word follows.
        share = _SHIFTS[np.repeat(n, n) - at, 0, byte]
        out[short] = np.bitwise_xor.reduceat(share, begin) ^ _ZEROS[n]
    for w in np.flatnonzero(size > SHORT).tolist():
        out[w] = zlib.crc32(found.data[found.starts[w]:found.ends[w]].tobytes())
    return out


def feature_buckets(found: Words, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all words, buckets of all pairs of neighbours, and the document of each pair."""
    crc = word_crcs(found)
    doc = found.of_doc()
    first = np.flatnonzero(doc[1:] == doc[:-1])
    second, size = first + 1, (found.ends - found.starts)[first + 1]
    # CRC(a b) = CRC(a) moved on by what follows, xor CRC(" b"); and CRC(" b") likewise.
    blank = np.full(len(first), zlib.crc32(b" "), np.uint32)
    left = _shifted(crc[first], np.ones(len(first), np.int64)) ^ blank
    pair = np.zeros(len(first), np.uint32)
    short = size <= SHORT
    pair[short] = _shifted(left[short], size[short]) ^ crc[second[short]]
    for i in np.flatnonzero(~short).tolist():
        pair[i] = zlib.crc32(found.data[found.starts[second[i]]:found.ends[second[i]]].tobytes(), int(left[i]))
    return crc % np.uint32(buckets), pair % np.uint32(buckets), doc[first]


# ---- weights --------------------------------------------------------------------------------------


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features per bucket over all texts: one array per task, added up by Spark."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, offsets, data in slices(batch):
                single, pair, _ = feature_buckets(words(offsets, data, ALNUM), buckets)
                total += np.bincount(single, minlength=buckets) + np.bincount(pair, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some], pa.int64())], names=["bucket", "n"])

    text = docs.select(F.col("text").cast("string").alias("text"))
    rows = text.mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(buckets, np.int64)
    for r in rows:
        out[r.bucket] = r.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Floored thousandths of the log ratio of smoothed frequencies, target over source."""
    size, s_all, t_all = len(source), int(source.sum()), int(target.sum())
    return np.array(
        [math.floor(1000 * math.log((int(t) + 1) * (s_all + size) / ((int(s) + 1) * (t_all + size)))) for s, t in zip(source, target)], np.int64
    )


def _weighing(gain, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = gain.value
        for batch in batches:
            for part, offsets, data in slices(batch):
                found = words(offsets, data, ALNUM)
                single, pair, pair_doc = feature_buckets(found, buckets)
                # Sums of whole numbers far below 2^53, so doubles are exact.
                total = np.bincount(found.of_doc(), table[single], part.num_rows) + np.bincount(pair_doc, table[pair], part.num_rows)
                n_words = found.counts.astype(np.int64)
                n = np.maximum(2 * n_words - 1, 0)
                weight = np.floor_divide(total.astype(np.int64), np.maximum(n, 1))
                kept = [part.column(c) for c in part.schema.names if c != "text"]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(n_words), pa.array(n), pa.array(weight)],
                    names=[*[c for c in part.schema.names if c != "text"], "n_words", "n_features", "weight"],
                )

    return run


def _noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, from the first 32 bits of the id's digest."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def scored(docs: DataFrame, target: DataFrame, seed: int = SEED, buckets: int = BUCKETS) -> DataFrame:
    """``docs`` (doc_id, text and columns named otherwise) with n_words, n_features, weight and score for the text."""
    context = docs.sparkSession.sparkContext
    gain = context.broadcast(gains(bucket_counts(docs, buckets), bucket_counts(target, buckets)))
    kept = [f for f in docs.schema.fields if f.name != "text"]
    schema = T.StructType([*kept, *[T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight")]])
    own = docs.select(*[F.col(f.name) for f in kept], F.col("text").cast("string").alias("text"))
    return own.mapInArrow(_weighing(gain, buckets), schema).withColumn("score", F.col("weight") + _noise(F.col("doc_id"), seed))


# ---- distributed radix sort -------------------------------------------------------------------------

#: A column and whether its largest value comes first.
Order = tuple[str, bool]


def _distance(name: str, down: bool, low: int, high: int) -> Column:
    """The column as a number of 64 bits that, read unsigned, has the wanted order and starts at 0 if the range allows it."""
    if high - low < 1 << 63:
        return F.lit(high) - F.col(name) if down else F.col(name) - F.lit(low)
    bits = F.col(name).bitwiseXOR(F.lit(-(1 << 63)))
    return F.bitwise_not(bits) if down else bits


def digits(rows: DataFrame, order: Sequence[Order], bits: int) -> list[Column]:
    """The digits of the composite key in which rows can differ, the least significant first; NULL comes last in its column."""
    ends = rows.agg(
        F.lit(0).alias("_"), *[f(c).alias(f"{n}_{c}") for c, _ in order for n, f in (("low", F.min), ("high", F.max), ("filled", F.count))],
        F.count("*").alias("_rows"),
    ).first()
    out = []
    for name, down in reversed(order):
        low, high = ends[f"low_{name}"], ends[f"high_{name}"]
        if low is None:
            continue
        distance = F.coalesce(_distance(name, down, low, high), F.lit(0).cast("long"))
        reach = (high - low).bit_length()
        out += [F.shiftrightunsigned(distance, s).bitwiseAND(F.lit((1 << bits) - 1)).cast("int") for s in range(0, reach, bits)]
        if ends[f"filled_{name}"] < ends["_rows"]:
            out.append(F.col(name).isNull().cast("int"))
    return out or [F.lit(0)]


def counting_pass(rows: DataFrame, digit: Column, chunk: int) -> DataFrame:
    """One stable counting sort of ``rows`` (with _at and _chunk): their positions and chunks by this digit."""
    own = rows.withColumn("_digit", digit)
    counts = stored(own.groupBy("_digit", "_chunk").agg(F.count("*").alias("_n")), "radix_counts")
    # At most 2^bits digits meet in one task; the chunks of a digit have a window of their own.
    smaller = Window.orderBy("_digit").rowsBetween(Window.unboundedPreceding, -1)
    begin = counts.groupBy("_digit").agg(F.sum("_n").alias("_all")).select("_digit", F.coalesce(F.sum("_all").over(smaller), F.lit(0)).alias("_begin"))
    earlier = Window.partitionBy("_digit").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_digit", "_chunk", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")).join(begin, "_digit")
    place = F.row_number().over(Window.partitionBy("_digit", "_chunk").orderBy("_at"))
    moved = own.withColumn("_place", place).join(offsets, ["_digit", "_chunk"])
    to = moved.withColumn("_to", F.col("_begin") + F.col("_before") + F.col("_place") - 1)
    kept = [c for c in rows.columns if c not in ("_at", "_chunk")]
    return stored(to.select(*kept, F.col("_to").alias("_at"), F.expr(f"_to div {chunk}").alias("_chunk")), "radix")


def radix_ranked(rows: DataFrame, order: Sequence[Order], bits: int = DIGIT, chunk: int = CHUNK) -> DataFrame:
    """``rows`` with ``rank`` from 1 by the long columns of ``order``, the most significant first.

    Rows equal in all of them keep no fixed order among themselves.
    """
    start = rows.withColumn("_at", F.monotonically_increasing_id())
    # The first chunks are the runs of each task; the order inside and among them is what the first pass keeps for ties.
    state = stored(start.withColumn("_chunk", F.expr(f"_at div {chunk}")), "radix")
    for digit in digits(state, order, bits):
        state = counting_pass(state, digit, chunk)
    return state.select(*rows.columns, (F.col("_at") + 1).alias("rank"))


# ---- resampling ---------------------------------------------------------------------------------------

ORDER: list[Order] = [("score", True), ("doc_id", False)]


def _sorted(scores: DataFrame, share: int, least_words: int, bits: int, chunk: int) -> tuple[DataFrame, int]:
    """Documents of enough words by rank, and how many of them are drawn."""
    able = scores.filter(F.col("n_words") >= least_words)
    return radix_ranked(able, ORDER, bits, chunk), share * able.count() // 100


def resampled(
    docs: DataFrame, target: DataFrame, share: int = SHARE, seed: int = SEED, least_words: int = LEAST_WORDS, buckets: int = BUCKETS,
    bits: int = DIGIT, chunk: int = CHUNK,
) -> DataFrame:
    """Per document its features, weight and score, and the rank of the ``share`` percent drawn."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scores = stored(scored(own, target, seed, buckets), "scores")
    ranked, drawn_rows = _sorted(scores, share, least_words, bits, chunk)
    rank = F.when(F.col("rank") <= drawn_rows, F.col("rank")).cast("long")
    rest = scores.filter(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    columns = ["doc_id", "n_features", "weight", "score"]
    return ranked.select(*columns, rank.alias("rank")).unionByName(rest.select(*columns, "rank"))


def drawn(docs: DataFrame, target: DataFrame, share: int = SHARE, seed: int = SEED, least_words: int = LEAST_WORDS, buckets: int = BUCKETS) -> DataFrame:
    """The rows of ``docs`` that are drawn, whole.

    The last drawn key decides, so that no text is joined or sorted; rows that
    equal it in id and score are drawn with it.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scores = stored(scored(own, target, seed, buckets), "scores")
    ranked, drawn_rows = _sorted(scores, share, least_words, DIGIT, CHUNK)
    last = ranked.filter(F.col("rank") == drawn_rows).first()
    if last is None:
        return docs.limit(0)
    rows = scored(packed(docs, F.col("doc_id").cast("long").alias("doc_id"), F.col("text")), target, seed, buckets)
    known = F.lit(True) if last.doc_id is None else F.coalesce(F.col("doc_id") <= last.doc_id, F.lit(False))
    ahead = (F.col("score") > last.score) | ((F.col("score") == last.score) & known)
    return rows.filter((F.col("n_words") >= least_words) & ahead).select("row.*")
