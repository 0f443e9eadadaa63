"""Stupid-backoff scores of every document against the counts of all others.

``order`` is the length of the longest n-grams, 2 at least. Counts of all documents
are used, and a document's own occurrences are taken off before it is scored
(otherwise every n-gram would be known). With c' for counts without the document's
own, a word w after the context x of up to order - 1 words scores

* log(c'(xw) / c'(x)) if c'(xw) > 0,
* otherwise log(0.4) and the score of w after x without its first word,
* log(max(c'(w), 1) / N) without any context.

N is the number of words of the corpus; ``score`` is the mean over the words.

How the work is cut. Documents fall into blocks of about ``BLOCK_BYTES`` of text by a
hash of the row, and n-grams of all lengths into parts by the range of their
hash, so many that a part's n-grams are about those of ``PART_BYTES`` of text. A block
sends each part its distinct n-grams in order, as steps from one to the next, and
how often it has them: about five bytes an n-gram. A part adds up all blocks and sends each
block, in the block's own order, how often the others have its n-grams; most do not, and
a row of zeros takes next to nothing. A block's texts then meet these numbers,
cut and sorted as before, and every word is scored in one go. A frequent n-gram has one entry
per block at most, so no group grows with its frequency, and nothing is sent to every task.

The n-grams may be worked on in ``turns``, by parts: each reads the texts again and
needs that much less of the disk at once.

Edge cases: a NULL or empty text, or one without words, has no score (NULL);
repeated rows count and score as separate documents; rows without an id are
scored; extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import released
from tidemark.llm.textbuf import ALNUM, Words, mix, stream, texts, words

BACKOFF = 0.4
#: Bounds of what was once known to every task. Nothing is any more; they change no result.
HOT = 1024
HEAVY = 1 << 16
KNOWN = 1 << 21
TURNS = 2
BLOCK_BYTES = 4 << 20
PART_BYTES = 8 << 20
#: Bytes of an n-gram's hash, of its count in a block, and in all other blocks.
GRAM, OWN, OTHERS = 7, 4, 6

CELLS = "block long, part int, grams binary, own binary, words long"
COUNTS = "block long, part int, others binary, words long"
SCORES = "doc_id long, n_words long, log_score double"
ODD = stream(3, 23)
#: The lowest bytes of eight, by number.
LOWEST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
#: Words of up to so many bytes are hashed eight bytes at a time.
SHORT = 32


def _hashes(found: Words) -> np.ndarray:
    """A 64-bit hash per word, the same in every batch."""
    size = found.ends - found.starts
    padded = np.concatenate([found.data, np.zeros(SHORT + 8, np.uint8)])
    eight = np.ndarray(len(padded) - 7, "<u8", padded, strides=(1,))
    value = mix(size.astype(np.uint64) * ODD[0])
    left = np.arange(len(size))
    for at in range(0, SHORT, 8):
        some = eight[found.starts[left] + at] & LOWEST[np.minimum(size[left] - at, 8)]
        value[left] = mix((value[left] ^ some) * ODD[1])
        left = left[size[left] > at + 8]
    if len(left):
        value[left] = Words(found.data, found.offsets, found.starts[left], found.ends[left], found.first).hashes()
    return value


def _grams(found: Words, order: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each length from 1 on the positions where such n-grams begin, and 56 bits of their hashes."""
    doc, gram, each = found.of_doc(), _hashes(found), []
    for k in range(order):
        if k:
            gram = mix(gram[:-1] * ODD[2] + mix(gram[1:]))
        at = np.flatnonzero(doc[k:] == doc[:len(gram)])
        each.append((at, gram[at] >> np.uint64(8)))
    return each


def _part(grams: np.ndarray, parts: int) -> np.ndarray:
    """Parts follow each other in the order of the hashes."""
    return ((grams >> np.uint64(24)) * np.uint64(parts)) >> np.uint64(32)


def _packed(values: np.ndarray, width: int) -> bytes:
    """The lowest ``width`` bytes of each number: all first ones, then all second ones, and so on, as they compress best."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def _unpacked(data: bytes, width: int) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.view("<u8").ravel()


def _starts(values: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    return np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.int64)


def _runs(first: np.ndarray, size: int) -> np.ndarray:
    return np.diff(np.append(first, size))


def _cells(order: int, parts: int, turn: int, turns: int):
    """A block's distinct n-grams of a turn's parts, and beside its very first one its number of words."""

    def run(key, rows):
        found = words(*texts(rows.column("text")), ALNUM)
        grams = np.sort(np.concatenate([gram for _, gram in _grams(found, order)]))
        first = _starts(grams)
        own, grams = _runs(first, len(grams)), grams[first]
        cuts = np.searchsorted(_part(grams, parts), np.arange(parts + 1))
        mine = [p for p in range(turn, parts, turns) if cuts[p] < cuts[p + 1]]
        spans = [slice(cuts[p], cuts[p + 1]) for p in mine]
        n_words = np.zeros(len(mine), np.int64)
        n_words[[k for k, p in enumerate(mine) if cuts[p] == 0]] = len(found.starts)
        return pa.table(
            {
                "block": pa.array([key[0].as_py()] * len(mine), pa.int64()),
                "part": pa.array(mine, pa.int32()),
                "grams": pa.array([_packed(np.diff(grams[s], prepend=np.uint64(0)), GRAM) for s in spans], pa.binary()),
                "own": pa.array([_packed(own[s], OWN) for s in spans], pa.binary()),
                "words": pa.array(n_words),
            }
        )

    return run


def _added(cells):
    """For each block of a part how often the other blocks have its n-grams."""
    listed = [np.cumsum(_unpacked(x, GRAM), dtype=np.uint64) for x in cells.column("grams").to_pylist()]
    grams = np.concatenate(listed)
    own = np.concatenate([_unpacked(x, OWN) for x in cells.column("own").to_pylist()])
    order = np.argsort(grams)
    first = _starts(grams[order])
    others = np.empty(len(grams), np.uint64)
    others[order] = np.repeat(np.add.reduceat(own[order], first), _runs(first, len(grams)))
    others -= own
    cuts = np.cumsum([len(x) for x in listed])[:-1]
    packed = pa.array([_packed(x, OTHERS) for x in np.split(others, cuts)], pa.binary())
    return cells.select(["block", "part"]).append_column("others", packed).append_column("words", cells.column("words"))


def _elsewhere(each: list[tuple[np.ndarray, np.ndarray]], doc: np.ndarray, counts: pa.Table) -> list[np.ndarray]:
    """For each length the counts of the n-grams outside of their document, in text order."""
    grams = np.concatenate([gram for _, gram in each])
    order = np.argsort(grams, kind="stable")
    first = _starts(grams[order])
    by_part = np.argsort(counts.column("part").to_numpy())
    listed = counts.column("others").to_pylist()
    others = np.concatenate([np.zeros(0, np.uint64), *[_unpacked(listed[k], OTHERS) for k in by_part]]).astype(np.int64)
    if len(others) != len(first):
        raise RuntimeError("a block's texts have changed since they were counted")
    inside = _runs(first, len(grams))
    total = np.repeat(others + inside, inside)
    # Equal n-grams stand in text order, and so by document.
    of = np.concatenate([doc[at] for at, _ in each])[order]
    same = np.repeat(np.arange(len(first)), inside) * (int(doc[-1]) + 1 if len(doc) else 1) + of
    runs = _runs(_starts(same), len(same))
    left = np.empty(len(grams), np.int64)
    left[order] = total - np.repeat(runs, runs)
    return np.split(left, np.cumsum([len(at) for at, _ in each])[:-1])


def _scored(order: int, total: int):
    def run(rows, counts):
        found = words(*texts(rows.column("text")), ALNUM)
        each, doc = _grams(found, order), found.of_doc()
        left = _elsewhere(each, doc, counts)
        logs = np.log(np.maximum(left[0], 1).astype(np.float64))
        score = logs - np.log(total)
        for k, ((at, _), c) in enumerate(zip(each[1:], left[1:]), 1):
            # An n-gram and its context begin at the same word.
            context, logs = logs, np.zeros(len(doc))
            logs[at] = np.log(np.maximum(c, 1).astype(np.float64))
            score[at + k] = np.where(c > 0, logs[at] - context[at], np.log(BACKOFF) + score[at + k])
        n_words = found.counts.astype(np.int64)
        sums = np.bincount(doc, score, minlength=rows.num_rows).astype(np.float64)  # whole numbers without any word
        return pa.table({"doc_id": rows.column("doc_id"), "n_words": pa.array(n_words), "log_score": pa.array(sums, mask=n_words == 0)})

    return run


def stupid_backoff(
    docs: DataFrame, hot: int = HOT, known: int = KNOWN, order: int = 2, heavy: int = HEAVY, turns: int = TURNS,
    block_bytes: int = BLOCK_BYTES, part_bytes: int = PART_BYTES,
) -> DataFrame:
    """Per document its words, summed log score and mean log score (natural logarithms)."""
    if order < 2:
        raise ValueError("order is 2 at least")
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    size = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks, parts = 1 + size // block_bytes, 1 + size // part_bytes
    # As many tasks as groups: a task's rows are bounded whatever the size of the corpus.
    own = own.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks))).repartition(blocks, "block")
    counts = []
    for turn in range(turns):
        cells = own.groupBy("block").applyInArrow(_cells(order, parts, turn, turns), CELLS).repartition(parts, "part")
        counts.append(released(cells.groupBy("part").applyInArrow(_added, COUNTS), f"counts{turn}"))
    counted = reduce(DataFrame.unionByName, counts)
    total = max(counted.agg(F.sum("words")).first()[0] or 0, 1)
    counted = counted.drop("words").repartition(blocks, "block")
    scored = own.groupBy("block").cogroup(counted.groupBy("block")).applyInArrow(_scored(order, total), SCORES)
    return scored.select("doc_id", "n_words", "log_score", (F.col("log_score") / F.col("n_words")).alias("score"))
