"""Toxicity by a classifier chain over label columns.

Each category has a linear model (logistic regression, FTRL with elastic net)
on the words present in a text. The chain runs in the given order: a model also
reads the probabilities of the categories before it. For training these are
out-of-fold predictions, so that a later model does not trust its
forerunners more than it may on new texts. Thresholds come from the
out-of-fold probabilities too (largest F1).

Training reads at most ``SAMPLE`` labelled documents (first in hash order);
all documents are scored whole.

Edge cases: a NULL, empty or wordless text has only the models' intercepts and
is never flagged; without labels all probabilities are 0 and nothing is
flagged; rows without an id are scored; repeated rows give a row each; extra
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import labelled_sample, sampled_texts, stored
from tidemark.llm.ftrl import Ftrl, softmax
from tidemark.llm.textbuf import ALNUM, ragged, slices, words

SAMPLE = 16_000
FOLDS = 3
EPOCHS = 3
#: Words in fewer sampled documents are no features.
LEAST_DOCS = 5
#: The chain: category name, label column, label value that means yes.
CHAIN = (("low_quality", "quality", 0), ("toxic", "toxic", 1))


def _distinct_words(offsets, data) -> tuple[np.ndarray, np.ndarray]:
    found = words(offsets, data, ALNUM)
    hashes = found.hashes()
    own = [np.unique(hashes[lo:hi]) for lo, hi in zip(found.first[:-1], found.first[1:])]
    return np.concatenate(own) if own else hashes, np.array([len(x) for x in own], np.int64)


def _features(batches):
    for batch in batches:
        for part, offsets, data in slices(batch):
            values, counts = _distinct_words(offsets, data)
            columns = [c for n, c in zip(part.schema.names, part.columns) if n != "text"]
            names = [n for n in part.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays([*columns, ragged(values.view(np.int64), counts, pa.int64())], names=[*names, "words"])


def _logit(p):
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p)) / 4.0


class Chain:
    """Models over the kept words, one intercept and one coordinate per earlier category."""

    def __init__(self, vocabulary: np.ndarray, weights: list[np.ndarray], cuts: list[float]):
        # Only words with a weight in some model take part in scoring.
        used = np.any([w[: len(vocabulary)] != 0 for w in weights], axis=0) if len(weights) else np.zeros(0, bool)
        self.words = vocabulary[used]
        self.word_weights = np.stack([w[: len(vocabulary)][used] for w in weights], axis=1) if len(weights) else np.zeros((0, 0))
        self.extra = [w[len(vocabulary):] for w in weights]
        self.cuts = cuts

    def score(self, offsets, data) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities (documents x categories) and whether a text has words."""
        found = words(offsets, data, ALNUM)
        hashes = found.hashes()
        at = np.minimum(np.searchsorted(self.words, hashes), max(len(self.words) - 1, 0))
        hit = np.flatnonzero(self.words[at] == hashes) if len(self.words) else np.zeros(0, np.int64)
        n = len(found.counts)
        once = np.unique(found.of_doc()[hit].astype(np.int64) * max(len(self.words), 1) + at[hit])
        doc, word = once // max(len(self.words), 1), once % max(len(self.words), 1)
        p = np.zeros((n, len(self.extra)))
        for k, extra in enumerate(self.extra):
            total = np.bincount(doc, self.word_weights[word, k], minlength=n).astype(np.float64) + extra[0]
            for j in range(k):
                total += extra[1 + j] * _logit(p[:, j])
            p[:, k] = 1 / (1 + np.exp(-np.clip(total, -40, 40)))
        return p, found.counts > 0


def _train(rows: list[np.ndarray], features: int, truth: np.ndarray, before: list[np.ndarray], which: np.ndarray) -> np.ndarray:
    model = Ftrl(features + 1 + len(before), 2, alpha=1.0, l1=2.0, l2=0.02)
    index = [np.concatenate([rows[r], np.arange(features, features + 1 + len(before))]) for r in which]
    value = [np.concatenate([np.ones(len(rows[r]) + 1), [_logit(b[r]) for b in before]]) for r in which]
    w = model.fit(list(zip(index, value)), truth[which], EPOCHS).weights()
    return w[:, 1] - w[:, 0]


def _apply(rows, weights, features, before, which) -> np.ndarray:
    out = []
    for r in which:
        total = weights[rows[r]].sum() + weights[features] + sum(weights[features + 1 + j] * _logit(b[r]) for j, b in enumerate(before))
        out.append(1 / (1 + np.exp(-np.clip(total, -40, 40))))
    return np.array(out)


def _best_cut(p: np.ndarray, truth: np.ndarray) -> float:
    order = np.argsort(-p, kind="stable")
    hits = np.cumsum(truth[order])
    if not truth.any():
        return 1.0
    f1 = 2 * hits / (np.arange(1, len(p) + 1) + truth.sum())
    last = np.append(p[order][1:] < p[order][:-1], True)  # a cut lies between different values
    k = int(np.argmax(np.where(last, f1, -1)))
    below = p[order][k + 1] if k + 1 < len(p) else 0.0
    return float((p[order][k] + below) / 2)


def fit(docs: DataFrame, labels: DataFrame, chain=CHAIN, sample: int = SAMPLE) -> Chain:
    picked = stored(labelled_sample(labels, sorted({c for _, c, _ in chain}), sample), "sample")
    texts = sampled_texts(docs, picked)
    kinds = ", ".join(f"{c} int" for c in texts.columns if c not in ("doc_id", "text"))
    got = texts.mapInArrow(_features, f"doc_id long, {kinds}, words array<long>").toArrow().sort_by([("doc_id", "ascending")])
    if not got.num_rows:
        return Chain(np.zeros(0, np.uint64), [np.zeros(1 + k) - 40 for k in range(len(chain))], [1.0] * len(chain))
    each = [x.values.to_numpy().view(np.uint64) for x in got.column("words")]
    found, n = np.unique(np.concatenate(each), return_counts=True)
    vocabulary = found[n >= LEAST_DOCS]
    rows = [np.flatnonzero(np.isin(vocabulary, x, assume_unique=True)) if len(vocabulary) < len(x) else _index(vocabulary, x) for x in each]
    every = np.arange(len(rows))
    fold = every % FOLDS
    before: list[np.ndarray] = []
    weights, cuts = [], []
    for _, column, yes in chain:
        truth = (got.column(column).to_numpy() == yes).astype(int)
        out = np.zeros(len(rows))
        for f in range(FOLDS):
            inner, outer = every[fold != f], every[fold == f]
            out[outer] = _apply(rows, _train(rows, len(vocabulary), truth, before, inner), len(vocabulary), before, outer)
        weights.append(_train(rows, len(vocabulary), truth, before, every))
        cuts.append(_best_cut(out, truth))
        before = [*before, out]
    return Chain(vocabulary, weights, cuts)


def _index(vocabulary: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    if not len(vocabulary):
        return np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
    return at[vocabulary[at] == hashes]


def toxicity(docs: DataFrame, labels: DataFrame, chain=CHAIN, sample: int = SAMPLE) -> DataFrame:
    """Per document a probability and a flag for each category of the chain."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    model = docs.sparkSession.sparkContext.broadcast(fit(own, labels, chain, sample))
    names = [n for n, _, _ in chain]

    def run(batches):
        for batch in batches:
            for part, offsets, data in slices(batch):
                p, worded = model.value.score(offsets, data)
                p = np.where(worded[:, None] | (p < 0.5), p, 0.5)
                columns = [part.column("doc_id")]
                for k in range(len(names)):
                    columns += [pa.array(p[:, k]), pa.array(worded & (p[:, k] > model.value.cuts[k]))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *[x for n in names for x in (f"p_{n}", f"is_{n}")]])

    return own.mapInArrow(run, "doc_id long, " + ", ".join(f"p_{n} double, is_{n} boolean" for n in names))
