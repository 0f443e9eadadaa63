"""Language identification: sparse multinomial logistic regression over TF-IDF character n-grams.

Features are hashed runs of two and three characters of the case-folded text,
everything but letters read as a space. Their value is the share of the text's
n-grams times the inverse document frequency, which is counted over all
documents that may be learned from. Weights come from FTRL with elastic-net
penalties on at most ``PER_LANGUAGE`` documents of each language (those first
in hash order), a fifth of them kept aside for the temperature.

Edge cases: NULL, empty and letterless texts are ``und`` with score 0. Without
anything to learn from every text is ``und``. Rows without an id are never
learned from and are not held out. Repeated rows give a row each. Ties go to
the first language in order. Columns other than doc_id, text and lang are ignored.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.frames import stored
from tidemark.llm.ftrl import Ftrl, softmax
from tidemark.llm.textbuf import slices

BITS = 15
PER_LANGUAGE = 600
EPOCHS = 4
#: The sample is taken in so many parts of each language first.
PARTS = 1024
SCALE = 30.0
HELD_OUT = 2
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _fold() -> np.ndarray:
    """Code point to its lower-case letter; 0x20 for all that is no letter."""
    table = np.full(0x110000, 0x20, np.uint32)
    for point in range(0x110000):
        c = chr(point)
        if c.isalpha():
            low = c.lower()
            table[point] = ord(low) if len(low) == 1 else point
    return table


def ngrams(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed n-grams of a slice, grouped by document; their offsets; documents with a letter."""
    points = _fold()[np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)]
    lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    letters = np.concatenate([[0], np.cumsum(points != 0x20)])
    doc = np.repeat(np.arange(len(lead) - 1), np.diff(lead))
    # A space on either side of the text.
    padded = np.full(len(points) + 2 * (len(lead) - 1), 0x20, np.uint64)
    padded[np.arange(len(points)) + 2 * doc + 1] = points
    edge = lead + 2 * np.arange(len(lead))
    mask = np.uint64((1 << BITS) - 1)
    pair = padded[:-1] * np.uint64(0x9E3779B1) + padded[1:] * np.uint64(0x85EBCA77)
    triple = pair[:-1] * np.uint64(0xC2B2AE3D) + padded[2:] * np.uint64(0x27D4EB2F)
    two = (pair ^ (pair >> np.uint64(17))) & mask
    three = (triple ^ (triple >> np.uint64(19))) & mask
    # Runs must not cross into the next text; each text has at least two characters with its spaces.
    inside = np.ones(len(padded), bool)
    inside[edge[1:] - 1] = False
    inner = inside.copy()
    inner[edge[1:] - 2] = False
    grams = np.stack([np.append(two, 0), np.append(three, [0, 0])], axis=1)
    keep = np.stack([inside, inner], axis=1)
    per = np.concatenate([[0], np.cumsum(keep.sum(axis=1))])[edge]
    return grams[keep].astype(np.int32), per, np.diff(letters[lead]) > 0


def _frequencies(batches):
    total = np.zeros(1 << BITS, np.int64)
    docs = 0
    mark = np.zeros(1 << BITS, bool)
    for batch in batches:
        for _, offsets, data in slices(batch):
            grams, at, _ = ngrams(offsets, data)
            for lo, hi in zip(at[:-1], at[1:]):
                mark[:] = False
                mark[grams[lo:hi]] = True
                total += mark
            docs += len(at) - 1
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(seen, -1).astype(np.int32)), pa.array(np.append(total[seen], docs))], names=["feature", "n"]
    )


def _features(batches):
    for batch in batches:
        for part, offsets, data in slices(batch):
            grams, at, _ = ngrams(offsets, data)
            own = [np.unique(grams[lo:hi], return_counts=True) for lo, hi in zip(at[:-1], at[1:])]
            rows = [{"lang": x, "feature": f, "n": n} for x, (f, n) in zip(part.column("lang").to_pylist(), own)]
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("lang", pa.string()), ("feature", pa.list_(pa.int32())), ("n", pa.list_(pa.int32()))]))


def _predict(model):
    def run(batches):
        names, table, temperature = model.value
        for batch in batches:
            for part, offsets, data in slices(batch):
                grams, at, lettered = ngrams(offsets, data)
                size = np.diff(at)
                guess, score = [UNKNOWN] * part.num_rows, np.zeros(part.num_rows)
                some = lettered & (size > 0)
                if names and some.any():
                    total = np.add.reduceat(table[grams], at[:-1][size > 0], axis=0)
                    logits = total / size[size > 0][:, None] * SCALE
                    p = softmax(logits / temperature)
                    best = p.argmax(axis=1)
                    for row, b, q in zip(np.flatnonzero(size > 0).tolist(), best.tolist(), p.max(axis=1).tolist()):
                        if lettered[row]:
                            guess[row], score[row] = names[b], q
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(guess, pa.string()), pa.array(np.minimum(score, 1.0))],
                    names=["doc_id", "held_out", "lang_pred", "score"],
                )

    return run


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == HELD_OUT, F.lit(False))


def _first_in_hash_order(ids: DataFrame, most: int, parts: int = PARTS) -> DataFrame:
    """At most ``most`` distinct ids of each language, those first in the order of a hash.

    Every task passes on ``most`` ids of a language at most. They meet in ``parts``
    parts of the language, and what these leave (``parts`` times ``most`` ids at most) in one task.
    """
    ids = ids.withColumn("part", F.spark_partition_id() % parts)
    for keys in (["lang", "part"], ["lang"]):
        order = Window.partitionBy(*keys).orderBy(F.xxhash64("doc_id"), "doc_id")
        # Repeated ids have one rank.
        ids = ids.withColumn("nth", F.dense_rank().over(order)).filter(F.col("nth") <= most).select("doc_id", *keys).distinct()
    return ids


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE) -> tuple[list[str], np.ndarray, float]:
    """Languages, weights times inverse document frequencies, and the temperature."""
    learn = docs.filter("doc_id is not null and lang is not null").filter(~held_out())
    df = np.zeros(1 << BITS)
    counts = learn.select("text").mapInArrow(_frequencies, "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n")).toArrow()
    feature, n = counts.column("feature").to_numpy(), counts.column("n").to_numpy()
    df[feature[feature >= 0]] = n[feature >= 0]
    total = n[feature < 0].sum() if len(n) else 0
    idf = np.log((1 + total) / (1 + df)) + 1

    ids = _first_in_hash_order(learn.select("doc_id", "lang"), per_language)
    # Bounded by languages times per_language.
    sample = learn.join(F.broadcast(stored(ids, "sample")), ["doc_id", "lang"]).select("lang", "text")
    got = sample.mapInArrow(_features, "lang string, feature array<int>, n array<int>").toArrow().sort_by([("lang", "ascending")])
    names = sorted(set(got.column("lang").to_pylist()))
    if not names:
        return [], np.zeros((1 << BITS, 1), np.float32), 1.0
    labels = np.array([names.index(x) for x in got.column("lang").to_pylist()])
    rows = []
    for f, n in zip(got.column("feature"), got.column("n")):
        index, count = f.values.to_numpy(), n.values.to_numpy().astype(np.float64)
        rows.append((index, count / max(count.sum(), 1) * idf[index] * SCALE))
    aside = np.arange(len(rows)) % 5 == 4
    kept = [r for r, a in zip(rows, aside) if not a]
    model = Ftrl(1 << BITS, len(names), alpha=0.5, l1=0.002, l2=0.01).fit(kept, labels[~aside], EPOCHS)
    weights = model.weights()
    temperature = 1.0
    if aside.any():
        logits = np.array([rows[r][1] @ weights[rows[r][0]] for r in np.flatnonzero(aside)])
        truth = labels[aside]
        grid = np.exp(np.linspace(np.log(0.05), np.log(20), 121))
        loss = [-np.log(np.maximum(softmax(logits / t)[np.arange(len(truth)), truth], 1e-12)).mean() for t in grid]
        temperature = float(grid[int(np.argmin(loss))])
    return names, (weights * idf[:, None]).astype(np.float32), temperature


def identify(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """Per document the predicted language and its calibrated probability."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang"))
    model = docs.sparkSession.sparkContext.broadcast(fit(own, per_language))
    rows = own.select("doc_id", held_out().alias("held_out"), "text")
    return rows.mapInArrow(_predict(model), "doc_id long, held_out boolean, lang_pred string, score double")
