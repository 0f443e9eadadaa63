"""License scan: a generalised suffix automaton over the words of license templates.

A text's words are streamed through the automaton. At each word it knows the
longest run of words ending there that occurs in any template (the matching
statistic), and along the suffix links the longest one in each template. Long maximal runs are chained, in template order and with small
gaps, into covered spans of a template; a template covered far enough gives its
label. The phrases of the contract are templates too: a phrase ends at a word
when its state lies on the suffix-link path of the current state.

Edge cases: NULL and empty texts have no words, score 0 and empty labels; an
empty table gives no rows; phrases and templates of one word are found like
any other (templates only from ``min_match`` words on); repeated rows and rows
without an id give a row each; extra columns are ignored; long texts are streamed
whole; of chains that cover equally many words the earliest is the span.
"""

from __future__ import annotations

import bisect
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.license_texts import TEXTS
from tidemark.llm.textbuf import ALNUM, slices, words

# The phrases of the contract and their labels.
PHRASES = [("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")]

# How texts name a license in one line, lower case, words only.
NOTICES = [
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("mit", "released under the mit license"),
    ("gpl-3.0", "licensed under the gnu general public license version 3"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    ("cc-by-4.0", "licensed under a creative commons attribution 4 0 international license"),
]

#: One-line notices and whole license texts.
TEMPLATES = [*NOTICES, *TEXTS]

MIN_MATCH = 3
MAX_GAP = 4
MIN_COVER = 0.8

SPAN = "struct<label:string,template:int,first:long,last:long,words:long,share:double>"
RESULT = f"doc_id long, n_words long, places array<struct<label:string,first:long,last:long>>, spans array<{SPAN}>"


def word_list(text: str) -> list[str]:
    """A template's words by the rule that documents follow."""
    raw = np.frombuffer(text.encode(), np.uint8)
    found = words(np.array([0, len(raw)]), raw, ALNUM)
    return [found.data[a:b].tobytes().decode() for a, b in zip(found.starts, found.ends)]


class SuffixAutomaton:
    """All runs of words of several templates. State 0 is the empty run."""

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len = [-1], [0]
        #: Where the runs of a state end: (template, position of the last word).
        self.ends: list[set[tuple[int, int]]] = [set()]
        for t, sequence in enumerate(sequences):
            last = 0
            for at, word in enumerate(sequence):
                last = self._extend(last, word)
                self.ends[last].add((t, at))
        for state in sorted(range(1, len(self.len)), key=self.len.__getitem__, reverse=True):
            if self.link[state] > 0:
                self.ends[self.link[state]] |= self.ends[state]

    def _state(self, length: int, moves: dict[int, int], link: int) -> int:
        self.next.append(moves)
        self.len.append(length)
        self.link.append(link)
        self.ends.append(set())
        return len(self.len) - 1

    def _split(self, parent: int, child: int, word: int) -> int:
        copy = self._state(self.len[parent] + 1, dict(self.next[child]), self.link[child])
        self.link[child] = copy
        while parent >= 0 and self.next[parent].get(word) == child:
            self.next[parent][word] = copy
            parent = self.link[parent]
        return copy

    def _extend(self, last: int, word: int) -> int:
        known = self.next[last].get(word)
        if known is not None:
            return known if self.len[known] == self.len[last] + 1 else self._split(last, known, word)
        new = self._state(self.len[last] + 1, {}, 0)
        while last >= 0 and word not in self.next[last]:
            self.next[last][word] = new
            last = self.link[last]
        if last >= 0:
            child = self.next[last][word]
            self.link[new] = child if self.len[child] == self.len[last] + 1 else self._split(last, child, word)
        return new

    def step(self, state: int, length: int, word: int) -> tuple[int, int]:
        while state and word not in self.next[state]:
            state = self.link[state]
            length = self.len[state]
        to = self.next[state].get(word)
        return (to, length + 1) if to is not None else (0, 0)

    def path(self, state: int) -> list[int]:
        out = []
        while state > 0:
            out.append(state)
            state = self.link[state]
        return out


@dataclass
class Chain:
    """Runs of one template in its order: where they begin and end in the text, and the template words covered."""

    first: int
    last: int
    end: int
    words: int


class Scanner:
    """Templates and phrases as one automaton, with the phrases marked on its states."""

    def __init__(self, templates, phrases, min_match: int, max_gap: int):
        self.min_match, self.max_gap = min_match, max_gap
        named = [(label, word_list(text)) for text, label in phrases] + [(label, word_list(text)) for label, text in templates]
        vocabulary = sorted({w for _, own in named for w in own})
        number = {w: i for i, w in enumerate(vocabulary)}
        self.sequences = sequences = [[number[w] for w in own] for _, own in named]
        self.known_occurrences: dict[int, list] = {}
        self.labels = [label for label, _ in named]
        self.sizes = [len(s) for s in sequences]
        self.n_phrases = len(phrases)
        self.machine = SuffixAutomaton(sequences)
        raw = "".join(vocabulary).encode()
        ends = np.cumsum([len(w.encode()) for w in vocabulary])
        data = np.frombuffer(raw, np.uint8)
        hashes = np.array([words(np.array([0, e - s]), data[s:e], ALNUM).hashes()[0] for s, e in zip([0, *ends[:-1]], ends)], np.uint64)
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        size = len(vocabulary)
        self.pairs = np.zeros((size, size), bool)
        for s in sequences:
            self.pairs[s[:-1], s[1:]] = True
        #: Words that are a whole phrase, or a whole template as far as runs of one word count.
        self.alone = np.zeros(size + 1, bool)
        for k, s in enumerate(sequences):
            if len(s) == 1 and (k < self.n_phrases or min_match <= 1):
                self.alone[s[0]] = True
        if min_match <= 1:
            self.alone[:size] = True
        at = []
        for s in sequences[: self.n_phrases]:
            state, length = 0, 0
            for w in s:
                state, length = self.machine.step(state, length, w)
            at.append(state)
        self.marks = []
        for state in range(len(self.machine.len)):
            path = set(self.machine.path(state))
            self.marks.append([(p, self.sizes[p]) for p, s in enumerate(at) if s in path and self.sizes[p]])

    def known(self, found) -> np.ndarray:
        """Template word numbers of a slice's words, -1 for all other words."""
        if not len(self.hashes):
            return np.full(len(found.starts), -1)
        hashes = found.hashes()
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.order[at], -1)

    def occurrences(self, state: int) -> list[tuple[int, int, int | None, int]]:
        """(template, last word, length, word after it) of all runs that end where the state's does; None for its own length."""
        out = self.known_occurrences.get(state)
        if out is None:
            out, seen, at, size = [], set(), state, None
            while at > 0 and (size is None or size >= self.min_match):
                fresh = self.machine.ends[at] - seen
                out += [(t, e, size, (*self.sequences[t], -1)[e + 1]) for t, e in sorted(fresh) if t >= self.n_phrases]
                seen |= fresh
                at = self.machine.link[at]
                size = self.machine.len[at]
            self.known_occurrences[state] = out
        return out

    def stream(self, run: list[int], start: int):
        """Phrase places (phrase, first word), and maximal runs (last word, template, its last word, length).

        A run is maximal in a template if no word before or after it continues it there.
        """
        places, longest = [], []
        state, length = 0, 0
        for i, (word, after) in enumerate(zip(run, [*run[1:], -2])):
            state, length = self.machine.step(state, length, word)
            places += [(p, start + i - n + 1) for p, n in self.marks[state] if length >= n]
            if length >= self.min_match:
                longest += [
                    (start + i, t, e, length if size is None else size) for t, e, size, follows in self.occurrences(state) if follows != after
                ]
        return places, longest

    def chains(self, longest) -> list[tuple[int, Chain]]:
        """(template, chain): the spans of each template, the best chain that ends in each run it does not go beyond.

        A run joins the chain before it where it continues the template at most
        ``max_gap`` words later in the text; overlapping words count once.
        """
        by_template: dict[int, list[tuple[int, int, int]]] = {}
        for last, t, end, length in longest:
            by_template.setdefault(t, []).append((last, end, length))
        out = []
        for t, runs in by_template.items():
            runs.sort()
            chains: list[Chain] = []  # in order of their last word
            for last, end, length in runs:
                best = Chain(last - length + 1, last, end, length)
                for c in reversed(chains):
                    if last - length - c.last > self.max_gap:
                        break  # all others end even farther away
                    new = min(length, end - c.end, last - c.last)
                    if new > 0 and c.words + new > best.words:
                        best = Chain(c.first, last, end, c.words + new)
                chains.append(best)
            out += [(t, c) for c in self._apart(chains)]
        return out

    @staticmethod
    def _apart(chains: list[Chain]) -> list[Chain]:
        """Of chains that share text only the one that covers most, the earliest of equals."""
        kept: list[Chain] = []
        for c in sorted(chains, key=lambda c: (-c.words, c.first, c.last)):
            at = bisect.bisect([k.first for k in kept], c.first)
            if (at == 0 or kept[at - 1].last < c.first) and (at == len(kept) or kept[at].first > c.last):
                kept.insert(at, c)
        return kept

    def scan(self, batches):
        for batch in batches:
            for part, offsets, data in slices(batch):
                found = words(offsets, data, ALNUM)
                ids = self.known(found)
                doc = found.of_doc()
                inside = self.alone[ids]  # the last entry, for unknown words, is never set
                if len(ids) > 1:
                    # Two neighbours that no template has beside each other end every match of two words or more.
                    pair = (ids[1:] >= 0) & (ids[:-1] >= 0) & (doc[1:] == doc[:-1]) & self.pairs[ids[:-1], ids[1:]]
                    joined = np.concatenate([[False], pair])
                    inside = inside | joined | np.concatenate([pair, [False]])
                else:
                    joined = np.zeros(len(ids), bool)
                n = part.num_rows
                places: list[list] = [[] for _ in range(n)]
                longest: list[list] = [[] for _ in range(n)]
                at = np.flatnonzero(inside)
                if len(at):
                    cut = np.flatnonzero(~joined[at][1:] | (np.diff(at) > 1)) + 1
                    for lo, hi in zip(at[np.concatenate([[0], cut])].tolist(), (at[np.concatenate([cut - 1, [len(at) - 1]])] + 1).tolist()):
                        d = int(doc[lo])
                        p, m = self.stream(ids[lo:hi].tolist(), int(lo - found.first[d]))
                        places[d] += p
                        longest[d] += m
                yield self._rows(part.column("doc_id"), found.counts, places, longest)

    def _rows(self, ids, counts, places, longest) -> pa.RecordBatch:
        base, spans = [], []
        for p, m in zip(places, longest):
            base.append([{"label": self.labels[k], "first": at, "last": at + self.sizes[k] - 1} for k, at in sorted(p, key=lambda x: (x[1], x[0]))])
            own = [
                {"label": self.labels[t], "template": t - self.n_phrases, "first": c.first, "last": c.last, "words": c.words, "share": c.words / self.sizes[t]}
                for t, c in (self.chains(m) if m else ())
            ]
            spans.append(sorted(own, key=lambda s: (s["first"], s["last"], s["template"])))
        place = pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64())])
        span = pa.struct([
            ("label", pa.string()), ("template", pa.int32()), ("first", pa.int64()), ("last", pa.int64()), ("words", pa.int64()), ("share", pa.float64()),
        ])
        return pa.RecordBatch.from_arrays(
            [ids, pa.array(counts, pa.int64()), pa.array(base, pa.list_(place)), pa.array(spans, pa.list_(span))],
            names=["doc_id", "n_words", "places", "spans"],
        )


def license_spans(
    docs: DataFrame, templates=TEMPLATES, phrases=PHRASES, min_match: int = MIN_MATCH, max_gap: int = MAX_GAP
) -> DataFrame:
    """Per document the places of phrases and the covered spans of templates, in words from 0.

    A span says which template it covers, its first and last word in the text, how
    many words of the template it has and what share of them that is; spans of one
    template do not overlap. The automaton is built from the given templates (a few thousand states) and
    travels in the task closure; the documents are scanned once, without a shuffle.
    """
    scanner = Scanner(templates, phrases, min_match, max_gap)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(scanner.scan, RESULT)


def license_labels(found: DataFrame, min_cover: float = MIN_COVER) -> DataFrame:
    """The result of ``license_spans`` as counts, labels and a score: 1 with a phrase, else the largest covered share."""
    covered = F.filter("spans", lambda s: s["share"] >= min_cover)
    own = F.transform("places", lambda p: p["label"])
    text = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    firsts = F.transform("places", lambda p: p["first"])
    share = F.coalesce(F.array_max(F.transform("spans", lambda s: s["share"])), F.lit(0.0))
    return found.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min(firsts).alias("first_word"),
        F.array_max(firsts).alias("last_word"), text(own).alias("base_labels"),
        text(F.concat(own, F.transform(covered, lambda s: s["label"]))).alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.least(share, F.lit(1.0))).alias("score"),
    )
