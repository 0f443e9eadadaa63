"""Quality rules: a learned decision list over text statistics, in DataFrame operations only.

Sequential covering: a rule is grown on two thirds of the labelled documents,
condition by condition (feature above or below a threshold, largest FOIL
gain), then pruned from its end on the last third. Rules that still reject
precisely enough are kept in order; the documents they cover leave, and the
next rule is grown. Counts come from Spark aggregates over the labelled
statistics, one job per condition; the driver sees (feature, bin) counts only.
The list is an ordered CASE expression.

Training reads at most ``SAMPLE`` labelled documents (first in hash order), of
them those that pass the base rule; the statistics and the verdict are computed for every document.

Edge cases: NULL and empty texts have no words and fail the base rule; without
usable labels, or with one label only, the list is empty and the base rule
alone decides; rows without an id are judged; repeated rows give a row each;
extra columns pass through ``rejected_out`` untouched, whatever their names.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import labelled_sample, let, packed, sampled_texts, stored

SAMPLE = 20_000
BINS = 32
MOST_RULES = 12
MOST_CONDITIONS = 4
#: A rule must reject this precisely on the pruning third, and this many documents there.
PRECISION = 0.95
LEAST_COVERED = 3

BLANK = "[ \\t\\n\\x0B\\f\\r]+"
SYMBOLS = "[#*$%&|<>]"


def statistics(text: Column) -> Column:
    """Counts of one text as a struct; all zero for NULL.

    ``n_repeat_words``: windows of three words are compared by a 64-bit hash.
    """
    text = F.coalesce(text, F.lit(""))

    def repeats(words: Column) -> Column:
        windows = F.when(
            F.size(words) >= 3,
            F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))),
        ).otherwise(F.array().cast("array<bigint>"))

        def covered(hashes: Column) -> Column:
            placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

            def again(s: Column) -> Column:
                twice = F.filter(
                    F.transform(s, lambda x, k: F.when((F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"]), x["i"])),
                    lambda i: i.isNotNull(),
                )
                # Each window adds the words up to the next one, three at most.
                return let(
                    F.array_sort(twice),
                    lambda p: F.aggregate(
                        F.transform(p, lambda i, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - i, F.lit(3)))),
                        F.lit(0).cast("long"), lambda a, x: a + x,
                    ),
                )

            return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(let(placed, again))

        return let(windows, covered)

    def counted(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.aggregate(words, F.lit(0).cast("long"), lambda a, w: a + F.length(w)).alias("word_chars"),
            repeats(words).alias("n_repeat_words"),
        )

    words = let(F.filter(F.split(text, BLANK), lambda w: w != ""), counted)
    lines = let(
        F.filter(F.split(text, "\n"), lambda x: F.regexp_like(x, F.lit("[^ \\t\\n\\x0B\\f\\r]"))),
        lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")),
    )
    return F.struct(
        words.alias("w"), lines.alias("l"), F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.regexp_count(text, F.lit("[A-Z]")).cast("long").alias("n_upper"), F.regexp_count(text, F.lit("[!?]")).cast("long").alias("n_marks"),
    )


def with_statistics(docs: DataFrame) -> DataFrame:
    """``docs`` with the counts and the features of the rules, all named ``q_...``."""
    own = docs.withColumn("q_all", statistics(F.col("text")))
    count = {
        "n_words": "w.n_words", "word_chars": "w.word_chars", "n_repeat_words": "w.n_repeat_words", "n_lines": "l.n_lines",
        "n_dup_lines": "l.n_dup_lines", "n_symbols": "n_symbols", "n_upper": "n_upper", "n_marks": "n_marks",
    }
    own = own.select(*docs.columns, *[F.col(f"q_all.{path}").alias(f"q_{name}") for name, path in count.items()])
    words = F.greatest(F.col("q_n_words"), F.lit(1)).cast("double")
    ratio = {
        "symbols_per_word": F.col("q_n_symbols") / words,
        "marks_per_word": F.col("q_n_marks") / words,
        "upper_share": F.col("q_n_upper") / F.greatest(F.col("q_word_chars"), F.lit(1)),
        "word_length": F.col("q_word_chars") / words,
        "dup_line_share": F.col("q_n_dup_lines") / F.greatest(F.col("q_n_lines"), F.lit(1)),
        "repeat_share": F.col("q_n_repeat_words") / words,
        "words_per_line": F.col("q_n_words") / F.greatest(F.col("q_n_lines"), F.lit(1)),
    }
    return own.withColumns({f"q_{name}": value.cast("double") for name, value in ratio.items()})


FEATURES = (
    "q_symbols_per_word", "q_marks_per_word", "q_upper_share", "q_word_length", "q_dup_line_share", "q_repeat_share", "q_words_per_line",
)


def base_failed() -> Column:
    """The base rule of the contract."""
    return (F.col("q_n_words") < 50) | (100 * F.col("q_n_repeat_words") > 50 * F.col("q_n_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def sql(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} CAST({self.threshold!r} AS DOUBLE)"


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]

    def sql(self) -> str:
        return " AND ".join(c.sql() for c in self.conditions)

    def plain(self) -> Rule:
        """One condition per feature and side: the tightest."""
        tight: dict[tuple[str, bool], Condition] = {}
        for c in self.conditions:
            old = tight.get((c.feature, c.above))
            if old is None or (c.threshold > old.threshold) == c.above:
                tight[c.feature, c.above] = c
        return Rule(tuple(tight.values()))


def verdict(rules: list[Rule]) -> Column:
    """The decision list: rejected by the first rule that holds, else kept."""
    out = F.when(F.lit(False), F.lit(False))
    for rule in rules:
        out = out.when(F.expr(rule.sql()), F.lit(False))
    return out.otherwise(F.lit(True))


def _gain(p: int, n: int, p0: int, n0: int) -> float:
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p else 0.0


def _bin(feature: str, cuts: list[float]) -> Column:
    """How many thresholds the feature exceeds."""
    if not cuts:
        return F.lit(0)
    return F.size(F.filter(F.array(*[F.lit(float(v)) for v in cuts]), lambda v: F.col(feature) > v))


class _Learner:
    """Counts over the binned statistics of the labelled sample."""

    def __init__(self, labelled: DataFrame, features=FEATURES, bins: int = BINS):
        self.features = features
        quantiles = [k / bins for k in range(1, bins)]
        rows = labelled.filter("bad = 1"), labelled
        cuts: list[set] = [set() for _ in features]
        for part in rows:  # thresholds follow the rejected documents as well as all
            for own, values in zip(cuts, part.approxQuantile(list(features), quantiles, 0.002)):
                own.update(values)
        self.cuts = [sorted(c) for c in cuts]
        bin_of = [_bin(f, c) for f, c in zip(features, self.cuts)]
        third = F.pmod(F.xxhash64("doc_id", F.lit(8)), F.lit(3))
        self.rows = stored(labelled.select("bad", *features, (third == 0).alias("prune"), F.array(*bin_of).alias("bins")).coalesce(4), "labelled")

    def counts(self, where: str) -> tuple[list[dict], int, int]:
        """Bad and good documents in each bin of each feature, and in all."""
        got = (
            self.rows.filter(where).select("bad", F.posexplode("bins").alias("feature", "bin"))
            .groupBy("feature", "bin").agg(F.sum("bad").alias("p"), F.sum(1 - F.col("bad")).alias("n")).collect()
        )
        each: list[dict] = [{} for _ in self.features]
        for r in got:
            each[r.feature][r.bin] = (r.p, r.n)
        p, n = (sum(v[k] for v in each[0].values()) for k in (0, 1))
        return each, p, n

    def covered(self, wheres: list[str], split: str) -> list[tuple[int, int]]:
        sums = [F.expr(f"coalesce(sum(CASE WHEN {w} THEN {v} END), 0)") for w in wheres for v in ("bad", "1 - bad")]
        row = self.rows.filter(split).agg(*[s.alias(f"x{i}") for i, s in enumerate(sums)]).first()
        return [(row[2 * i], row[2 * i + 1]) for i in range(len(wheres))]


def learn(labelled: DataFrame, precision: float = PRECISION) -> list[Rule]:
    """The decision list for documents with ``bad`` 0 or 1 and the features."""
    learner = _Learner(labelled)
    rules: list[Rule] = []
    while len(rules) < MOST_RULES:
        left = " AND ".join(["true", *[f"NOT ({r.sql()})" for r in rules]])
        conditions: list[Condition] = []
        while len(conditions) < MOST_CONDITIONS:
            where = " AND ".join([left, "NOT prune", *[c.sql() for c in conditions]])
            each, p0, n0 = learner.counts(where)
            if not p0 or not n0:
                break
            best, chosen = 0.0, None
            for feature, cuts, bins in zip(learner.features, learner.cuts, each):
                for k, cut in enumerate(cuts):
                    p = sum(v[0] for b, v in bins.items() if b > k)
                    n = sum(v[1] for b, v in bins.items() if b > k)
                    for above, q in ((True, (p, n)), (False, (p0 - p, n0 - n))):
                        gain = _gain(*q, p0, n0)
                        if gain > best + 1e-9:
                            best, chosen = gain, Condition(feature, above, cut)
            if chosen is None:
                break
            conditions.append(chosen)
        if not conditions:
            break
        heads = [Rule(tuple(conditions[:k])) for k in range(1, len(conditions) + 1)]
        seen = learner.covered([h.sql() for h in heads], f"{left} AND prune")
        worth = [((p - n) / (p + n) if p + n else -1.0, p, h) for (p, n), h in zip(seen, heads)]
        value, p, rule = max(worth, key=lambda x: (x[0], x[1]))
        if (value + 1) / 2 < precision or p < LEAST_COVERED:
            break
        rules.append(rule.plain())
    return rules


def labelled_statistics(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Features and ``bad`` of at most ``sample`` labelled documents, without those that fail the base rule."""
    picked = stored(labelled_sample(labels, ["quality"], sample), "sample")
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    got = with_statistics(sampled_texts(own, picked)).withColumn("bad", (F.col("quality") == 0).cast("int"))
    return stored(got.filter(~base_failed()).select("doc_id", "bad", *FEATURES), "statistics")


def judge(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``docs`` with statistics, ``q_base_failed`` and ``q_kept``."""
    labelled = labelled_statistics(docs, labels, sample)
    kinds = labelled.agg(F.min("bad"), F.max("bad")).first()
    rules = learn(labelled) if kinds[0] == 0 and kinds[1] == 1 else []
    return with_statistics(docs).withColumn("q_base_failed", base_failed()).withColumn("q_kept", ~base_failed() & verdict(rules))


def rejected_out(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``docs`` without the rejected ones."""
    return judge(packed(docs, "doc_id", "text"), labels, sample).filter("q_kept").select("row.*")


def quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Per document the counts, the base rule and the verdict."""
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return judge(own, labels, sample).select("doc_id", *[F.col(f"q_{n}").alias(n) for n in names])
