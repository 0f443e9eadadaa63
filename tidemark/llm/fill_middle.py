"""Fill-in-the-middle transformation: each text is cut into prefix, middle and suffix at line ends.

A text is cut into fixed blocks of bytes. Two Fenwick trees hold, per block, how
many lines end in it and how many code points begin in it. To cut after k lines,
a binary-lifting descent over the first tree finds the block in which the k-th
line ends; the boundary is then located inside this one block, and the second
tree gives the code points before it. The texts of one Arrow slice share a pair
of trees, so all cuts descend at once as numpy lanes.

The documents are scanned once and never shuffled. A task holds one slice of
texts (a few megabytes, or one longer text) with its output.

Edge cases: NULL and empty texts are plain with no lines and an empty output; a text
that holds one of the marks stays plain; a text without a newline is one line;
rows without an id are cut as if the id were the empty text; repeated rows
give a row each with the same cuts, an id with several texts cuts each on its
own; extra columns are ignored by ``fill_in_middle`` and kept by ``transformed``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.textbuf import slices

BLOCK = 512
NEWLINE = 0x0A
#: Marks of prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")

NEW = "n long, form string, prefix_chars long, middle_chars long, output string"


class Fenwick:
    """Prefix sums over counts by index, 1-based inside."""

    def __init__(self, counts: np.ndarray):
        self.size = len(counts)
        self.tree = np.concatenate([[0], counts.astype(np.int64)])
        step = 1
        while step <= self.size:
            # Odd multiples of the step hand their sum to the next multiple of twice the step.
            giver = np.arange(step, self.size + 1 - step, 2 * step)
            self.tree[giver + step] += self.tree[giver]
            step *= 2

    def before(self, index: np.ndarray) -> np.ndarray:
        """Sum of the counts below each index."""
        at, total = index.astype(np.int64), np.zeros(len(index), np.int64)
        while at.any():
            total += self.tree[at]  # tree[0] is 0
            at = at & (at - 1)
        return total

    def find(self, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The block in which each running total is reached, and the sum before that block."""
        at, total = np.zeros(len(target), np.int64), np.zeros(len(target), np.int64)
        step = 1 << max(self.size.bit_length() - 1, 0)
        while step:
            to = at + step
            there = to <= self.size
            sums = total + self.tree[np.where(there, to, 0)]
            go = there & (sums < target)
            at, total = np.where(go, to, at), np.where(go, sums, total)
            step >>= 1
        return at, total


class Cutter:
    """The blocks of a slice of texts and the trees over them."""

    def __init__(self, offsets: np.ndarray, data: np.ndarray):
        self.data = data
        size = np.diff(offsets)
        blocks = -(-size // BLOCK)
        self.first = np.concatenate([[0], np.cumsum(blocks)])
        number = np.arange(self.first[-1]) - np.repeat(self.first[:-1], blocks)
        self.start = np.repeat(offsets[:-1], blocks) + number * BLOCK
        self.end = np.minimum(self.start + BLOCK, np.repeat(offsets[1:], blocks))
        line_end = data == NEWLINE
        line_end[offsets[1:][size > 0] - 1] = True  # the last line ends with its text
        self.line_end, self.begins = line_end, (data & 0xC0) != 0x80
        count = lambda marks: np.add.reduceat(marks, self.start, dtype=np.int64) if len(self.start) else np.zeros(0, np.int64)
        self.lines, self.chars = Fenwick(count(self.line_end)), Fenwick(count(self.begins))
        self.lines_before = self.lines.before(self.first)
        self.chars_before = self.chars.before(self.first)

    def counts(self) -> np.ndarray:
        return np.diff(self.lines_before)

    def cut(self, doc: np.ndarray, lines: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Byte and code point (from the text's start) after the given number of lines of a text."""
        byte, char = begin.astype(np.int64), np.zeros(len(doc), np.int64)
        some = np.flatnonzero(lines > 0)
        block, sums = self.lines.find(self.lines_before[doc[some]] + lines[some])
        rest = self.lines_before[doc[some]] + lines[some] - sums
        chars = self.chars.before(block) - self.chars_before[doc[some]]
        for i, b, nth, c in zip(some.tolist(), block.tolist(), rest.tolist(), chars.tolist()):
            lo, hi = self.start[b], self.end[b]
            local = int(np.flatnonzero(self.line_end[lo:hi])[nth - 1]) + 1
            byte[i], char[i] = lo + local, c + int(np.count_nonzero(self.begins[lo:lo + local]))
        return byte, char


def _draws(doc_id: Column, seed: int) -> Column:
    """The first four groups of eight hex digits of the seeded digest."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return F.array(*[F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)])


def _cutting(percent: int, spm_percent: int):
    marks = [m.encode() for m in MARKS]
    p, s, m = marks

    def one(text: bytes, form: str, a: int, b: int) -> bytes:
        if form == "psm":
            return b"".join([p, text[:a], s, text[b:], m, text[a:b]])
        if form == "spm":
            return b"".join([s, text[b:], p, text[:a], m, text[a:b]])
        return text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, offsets, data in slices(batch):
                cutter = Cutter(offsets, data)
                n, rows = cutter.counts(), part.num_rows
                h = part.column("draws").flatten().to_numpy().reshape(rows, 4)
                raw = data.tobytes()
                each = [raw[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
                kept = np.array([not t or any(x in t for x in marks) for t in each], bool) | (h[:, 2] % 100 >= percent)
                form = np.where(kept, "plain", np.where(h[:, 3] % 100 < spm_percent, "spm", "psm")).tolist()
                one_cut, other = h[:, 0] % (n + 1), h[:, 1] % (n + 1)
                doc, begin = np.arange(rows), offsets[:-1]
                a, a_char = cutter.cut(doc, np.minimum(one_cut, other), begin)
                b, b_char = cutter.cut(doc, np.maximum(one_cut, other), begin)
                output = [one(t, f, x, y) for t, f, x, y in zip(each, form, (a - begin).tolist(), (b - begin).tolist())]
                passed = [c for c in part.schema.names if c not in ("text", "draws")]
                yield pa.RecordBatch.from_arrays(
                    [
                        *[part.column(c) for c in passed], pa.array(n, pa.int64()), pa.array(form, pa.string()),
                        pa.array(a_char, pa.int64(), mask=kept), pa.array(b_char - a_char, pa.int64(), mask=kept),
                        pa.array([t.decode() for t in output], pa.string()),
                    ],
                    names=[*passed, "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    return run


def _cut(docs: DataFrame, passed: list[Column], seed: int, percent: int, spm_percent: int) -> DataFrame:
    own = docs.select(*passed, F.col("text").cast("string").alias("text"), _draws(F.col("doc_id").cast("long"), seed).alias("draws"))
    schema = T.StructType([f for f in own.schema.fields if f.name not in ("text", "draws")])
    return own.mapInArrow(_cutting(percent, spm_percent), T.StructType([*schema, *T.StructType.fromDDL(NEW)]))


def fill_in_middle(docs: DataFrame, seed: int = 7, percent: int = 100, spm_percent: int = 50) -> DataFrame:
    """Per document its number of lines, form (plain, psm or spm), lengths in code points and output text.

    ``percent`` of the texts are cut, ``spm_percent`` of these put the suffix first.
    """
    return _cut(docs, [F.col("doc_id").cast("long").alias("doc_id")], seed, percent, spm_percent)


def transformed(docs: DataFrame, seed: int = 7, percent: int = 100, spm_percent: int = 50) -> DataFrame:
    """``docs`` with the output in place of each text, and its form as ``fim_form``. NULL texts stay NULL."""
    rest = F.struct(*[c for c in docs.columns if c != "text"])
    cut = _cut(docs, [rest.alias("row"), F.col("text").isNull().alias("empty")], seed, percent, spm_percent)
    text = F.when(~F.col("empty"), F.col("output"))
    return cut.select(*[text.alias(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns if c != "fim_form"], F.col("form").alias("fim_form"))


def restored(output: Column, form: Column) -> Column:
    """The exact text again, from output and form alone. No mark occurs in a cut text, so the first of each kind is the boundary."""
    p, s, m = MARKS
    after = lambda text, mark: F.substring(text, F.locate(mark, text) + len(mark), F.length(text))
    until = lambda text, mark: F.substring_index(text, mark, 1)
    middle = after(output, m)
    psm = F.concat(until(after(output, p), s), middle, until(after(output, s), m))
    spm = F.concat(until(after(output, p), m), middle, until(after(output, s), p))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def digests(cut: DataFrame) -> DataFrame:
    """The result of ``fill_in_middle`` with digests of output and restored text instead of the text."""
    output = F.col("output")
    return cut.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(output, 256).alias("output_sha256"), F.sha2(restored(output, F.col("form")), 256).alias("restored_sha256"),
    )
