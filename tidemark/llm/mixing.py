"""Mixing to target weights with soft domain membership, in DataFrame operations only.

A naive Bayes classifier learned from the labelled table gives every document a
posterior over domains (the combinations of its labels). Rates r >= 0 are then
fitted so that the expected tokens of each domain, sum of r * tokens *
posterior, meet their targets: projected gradient on a weighted least-squares
loss, see ``fit_rates``. The steps add up in one small vector, and a step is one
aggregate over the documents; no rate is stored before the last.

The classifier reads at most ``SAMPLE`` labelled documents (first in hash
order): which words mark a domain, in how many documents of each domain they
occur, and bins of two ratios. Posteriors, tokens and totals cover all documents.

Edge cases: NULL and empty texts have no tokens and the classifier's view of an
empty text; their rate is fitted like any other and changes no total. Without
usable labels there is one domain ``all``. Targets of domains that no label
names are shared among the rest; with no target left all domains weigh as they do
now. Targets out of reach give the nearest token sums within the budget and a
warning (an error if ``strict``). Rows without an id, repeated rows and extra columns are no special case.
"""

from __future__ import annotations

import math
import warnings
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import labelled_sample, let, packed, sampled_texts, stored
from tidemark.llm.quality import SYMBOLS

SAMPLE = 8000
MARKERS = 32
BINS = 8
#: A domain's tokens may miss their target by this share of all tokens before it is reported.
TOLERANCE = 1e-3
#: The fit ends when no domain's gradient is larger, as a share of the budget.
CLOSE = 1e-6
#: Far more steps than any fit takes; one that gets there is reported like any other miss.
MOST_STEPS = 200
#: Lengths tried in each step.
LENGTHS = (1.0, 0.5, 0.2, 0.05, 0.005)
#: Factors on the lengths, tried one after another while none lowers the loss (where hardly a rate is free the step is far too long).
SHRINK = (1.0, 1e-3, 1e-6)
SOFT = 1e-6
HOLD = 1e3
#: Share of all tokens that goes to each domain: good, good but toxic, poor, poor and toxic.
TARGETS = {"q1t0": 0.92, "q1t1": 0.03, "q0t0": 0.04, "q0t1": 0.01}

WORD = "[^ \\t\\n\\x0B\\f\\r]+"


def _ratios(text: Column) -> Column:
    size = F.greatest(F.length(text), F.lit(1)).cast("double")
    return F.array(F.regexp_count(text, F.lit(SYMBOLS)) / size, F.regexp_count(text, F.lit("[A-Z]")) / size)


def _bins(ratios: Column, cuts: list[list[float]]) -> list[Column]:
    def place(f: int, own: list[float]) -> Column:
        return F.size(F.filter(F.array(*[F.lit(v) for v in own]), lambda v: F.get(ratios, F.lit(f)) > v)) if own else F.lit(0)

    return [place(f, own) for f, own in enumerate(cuts)]


def _flags(text: Column, markers: list[str]) -> Column:
    return let(F.lower(text), lambda t: F.array(*[F.contains(t, F.lit(m)) for m in markers])) if markers else F.array().cast("array<boolean>")


@dataclass
class Classifier:
    """Log weights per domain: prior, marker seen, marker not seen, ratio bins."""

    domains: list[str]
    markers: list[str]
    cuts: list[list[float]]
    prior: list[float]
    seen: list[list[float]]
    unseen: list[list[float]]
    bins: list[list[list[float]]]

    def posterior(self, text: Column) -> Column:
        def logits(view: Column) -> Column:
            flags, places = view["flags"], view["places"]
            out = []
            for k in range(len(self.domains)):
                odds = F.array(*[F.lit(a - b) for a, b in zip(self.seen[k], self.unseen[k])]).cast("array<double>")
                hits = F.aggregate(F.zip_with(flags, odds, lambda f, w: F.when(f, w).otherwise(0.0)), F.lit(0.0), lambda a, x: a + x)
                fits = [F.get(F.array(*[F.lit(v) for v in own]), F.get(places, F.lit(f))) for f, own in enumerate(self.bins[k])]
                total = F.lit(self.prior[k] + sum(self.unseen[k])) + hits
                for fit in fits:
                    total = total + fit
                out.append(total)
            return F.array(*out)

        def softmax(x: Column) -> Column:
            raised = F.transform(x, lambda v: F.exp(v - F.array_max(x)))
            return let(raised, lambda e: F.transform(e, lambda v: v / F.aggregate(e, F.lit(0.0), lambda a, y: a + y)))

        places = let(_ratios(text), lambda r: F.array(*_bins(r, self.cuts)))
        view = F.struct(_flags(text, self.markers).alias("flags"), places.alias("places"))
        return let(let(view, logits), softmax)


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Classifier:
    picked = stored(labelled_sample(labels, ["quality", "toxic"], sample), "sample")
    domain = F.concat(F.lit("q"), F.col("quality"), F.lit("t"), F.col("toxic"))
    texts = sampled_texts(docs, picked).select(domain.alias("domain"), F.coalesce("text", F.lit("")).alias("text"))
    texts = stored(texts.withColumn("ratios", _ratios(F.col("text"))), "sampled")
    sizes = {r.domain: r["count"] for r in texts.groupBy("domain").count().collect()}
    domains = sorted(sizes)
    if not domains:
        return Classifier(["all"], [], [[], []], [0.0], [[]], [[]], [[[0.0]], [[0.0]]])
    total = sum(sizes.values())
    words = texts.select("domain", F.explode(F.array_distinct(F.split(F.lower("text"), "[^\\p{L}]+"))).alias("word")).filter(F.length("word") > 2)
    n = [F.count(F.when(F.col("domain") == d, 1)).alias(f"n{k}") for k, d in enumerate(domains)]
    counted = words.groupBy("word").agg(F.count("*").alias("n"), *n).filter(F.col("n") >= 5)
    # Chi-square of one domain against the rest, the largest over the domains.
    chi = [
        (F.col(f"n{k}") * total - F.col("n") * sizes[d]) ** 2 / (F.col("n") * (total - F.col("n") + 1.0) * sizes[d] * (total - sizes[d] + 1.0))
        for k, d in enumerate(domains)
    ]
    top = counted.withColumn("chi", F.greatest(*chi, F.lit(0.0))).orderBy(F.desc("chi"), "word").limit(MARKERS)
    markers = [r.word for r in top.select("word").collect()] if len(domains) > 1 else []
    quantiles = [k / BINS for k in range(1, BINS)]
    split = texts.select("domain", "text", F.get("ratios", F.lit(0)).alias("r0"), F.get("ratios", F.lit(1)).alias("r1"))
    cuts = [sorted(set(c)) for c in split.approxQuantile(["r0", "r1"], quantiles, 0.001)]
    viewed = texts.select("domain", _flags(F.col("text"), markers).alias("flags"), F.array(*_bins(F.col("ratios"), cuts)).alias("places"))
    hits = viewed.select("domain", F.posexplode("flags").alias("m", "hit")).filter("hit").groupBy("domain", "m").count().collect()
    bins = viewed.select("domain", F.posexplode("places").alias("f", "bin")).groupBy("domain", "f", "bin").count().collect()
    hit = {(r.domain, r.m): r["count"] for r in hits}
    at = {(r.domain, r.f, r.bin): r["count"] for r in bins}
    rate = lambda d, m: (hit.get((d, m), 0) + 0.5) / (sizes[d] + 1)
    return Classifier(
        domains, markers, cuts, [math.log(sizes[d] / total) for d in domains],
        [[math.log(rate(d, m)) for m in range(len(markers))] for d in domains],
        [[math.log(1 - rate(d, m)) for m in range(len(markers))] for d in domains],
        [[[math.log((at.get((d, f, b), 0) + 0.5) / (sizes[d] + 0.5 * (len(c) + 1))) for b in range(len(c) + 1)] for f, c in enumerate(cuts)] for d in domains],
    )


@dataclass
class Fit:
    """Fitted rates and how well they meet the targets; token sums are shares of all tokens."""

    domains: list[str]
    #: One number per domain; a document's rate follows from it and the posterior.
    vector: np.ndarray
    budget: float
    most: float | None
    goal: dict[str, float]
    got: dict[str, float]
    steps: int

    @property
    def miss(self) -> dict[str, float]:
        return {d: self.got[d] - self.goal[d] for d in self.domains}

    @property
    def met(self) -> bool:
        return all(abs(x) <= TOLERANCE for x in self.miss.values())

    def rate(self) -> Column:
        return _rate(self.vector, self.budget, self.most)


def _rate(vector: np.ndarray, budget: float, most: float | None) -> Column:
    """The sum of all gradient steps from the rate ``budget``, projected to zero and above (and at most ``most``)."""
    moved = F.lit(float(budget))
    for k, x in enumerate(vector):
        moved = moved - F.get("p", F.lit(k)) * F.lit(float(x))
    return F.greatest(F.lit(0.0), moved if most is None else F.least(moved, F.lit(float(most))))


def fit_rates(members: DataFrame, domains: list[str], targets: dict[str, float], budget: float, most: float | None = None) -> Fit:
    """Rates for ``members`` (tokens, p) by projected gradient on the weighted least squares of the targets.

    The gradient of a document's rate is its tokens times the product of its
    posterior with one vector, the weighted misses. So the steps add up in
    one vector of as many numbers as there are domains, and the rates are the
    projection of what it gives. A step is scaled by the second moments of the
    rates that are free to move; its length is the best of ``LENGTHS``, judged on the
    dual of the loss, which falls until the projected gradient is zero. Each
    step is one aggregate over the documents, whatever the lengths.

    ``SOFT`` bounds the weights of the loss, so that targets out of reach have a
    finite nearest answer; the total weighs ``HOLD`` times more than any share, so
    the budget is kept then.
    """
    size = len(domains)
    p = [F.get("p", F.lit(k)) for k in range(size)]
    every = members.agg(F.sum("tokens").alias("n"), *[F.sum(F.col("tokens") * q).alias(f"t{k}") for k, q in enumerate(p)]).first()
    total = float(every.n or 0)
    if not total or not budget:
        zero = dict.fromkeys(domains, 0.0)
        return Fit(domains, np.zeros(size), budget, most, zero, zero, 0)
    now = np.array([float(every[f"t{k}"]) for k in range(size)]) / total
    weight = np.array([max(targets.get(d, 0.0), 0.0) for d in domains])
    # A domain without tokens can meet no target.
    weight = np.where(now > 0, weight, 0.0)
    goal = (weight / weight.sum() if weight.sum() > 0 else now) * budget
    # The inverse of the weights: soft in all directions, far less so along the sum of all domains.
    slack = SOFT * (np.eye(size) - (1 - 1 / HOLD) * np.full((size, size), 1 / size))

    def looked_at(vectors: list[np.ndarray]) -> list[tuple[float, np.ndarray, np.ndarray]]:
        """Dual loss, token sums and second moments of the free rates, for several vectors in one pass."""
        sums = []
        for n, v in enumerate(vectors):
            rate, moved = F.col(f"r{n}"), F.col(f"x{n}")
            free = (moved > 0) & (F.lit(True) if most is None else moved < most)
            sums.append(F.sum(F.col("tokens") * rate * (moved - rate / 2)).alias(f"d{n}"))
            sums += [F.sum(F.col("tokens") * rate * p[k]).alias(f"t{n}_{k}") for k in range(size)]
            sums += [F.sum(F.when(free, F.col("tokens") * p[i] * p[j])).alias(f"m{n}_{i}_{j}") for i in range(size) for j in range(i, size)]
        moved = {f"x{n}": F.lit(float(budget)) - sum((p[k] * F.lit(float(v[k])) for k in range(size)), F.lit(0.0)) for n, v in enumerate(vectors)}
        row = members.withColumns(moved).withColumns({f"r{n}": _rate(v, budget, most) for n, v in enumerate(vectors)}).agg(*sums).first()
        out = []
        for n, v in enumerate(vectors):
            moment = np.zeros((size, size))
            for i in range(size):
                for j in range(i, size):
                    moment[i, j] = moment[j, i] = (row[f"m{n}_{i}_{j}"] or 0.0) / total
            out.append((row[f"d{n}"] / total + goal @ v + v @ slack @ v / 2, np.array([row[f"t{n}_{k}"] for k in range(size)]) / total, moment))
        return out

    vector = np.zeros(size)
    dual, now, moment = looked_at([vector])[0]
    steps = 0
    while True:
        gradient = now - goal - slack @ vector
        if np.abs(gradient).max() <= CLOSE * budget or steps >= MOST_STEPS:
            break
        step = np.linalg.solve(moment + slack, gradient)
        for shrink in SHRINK:
            tried = [vector + shrink * length * step for length in LENGTHS]
            found = looked_at(tried)
            best = min(range(len(tried)), key=lambda n: found[n][0])
            if found[best][0] < dual:
                break
        else:
            break  # no length gets any lower: as near as doubles go
        vector, (dual, now, moment) = tried[best], found[best]
        steps += 1
    return Fit(domains, vector, budget, most, dict(zip(domains, goal.tolist())), dict(zip(domains, now.tolist())), steps)


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, **options) -> DataFrame:
    """Per document its tokens, most likely domain, posteriors, rate and whole copies.

    Options: ``budget``, the wanted number of tokens as a share of all tokens;
    ``most``, the largest rate allowed; ``sample``, labelled documents to learn
    from; ``strict``, raise where targets are missed instead of warning. A rate of
    2.3 means two copies, and a third for 30 % of such documents (by a hash of id and text).
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return _rated(own, ["doc_id"], labels, targets, **options)


def rated(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, **options) -> DataFrame:
    """``docs`` with the columns of ``mix`` beside their own; of two with one name the one of ``mix`` stays."""
    own = packed(docs, F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    out = _rated(own, ["doc_id", "row"], labels, targets, **options)
    new = [c for c in out.columns if c not in ("doc_id", "row")]
    return out.select(*[F.col("row")[c].alias(c) for c in docs.columns if c not in new], *new)


def repeated(docs: DataFrame) -> DataFrame:
    """Each document as often as its ``copies`` say, numbered by ``copy`` from 1 on; none where they are 0."""
    every = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")
    return docs.filter("copies > 0").select(*[c for c in docs.columns if c != "copy"], every)


def mixed(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, **options) -> DataFrame:
    """The mixed corpus: the rows of ``rated``, each as often as its copies say."""
    return repeated(rated(docs, labels, targets, **options))


def _rated(
    own: DataFrame, keep: list[str], labels: DataFrame, targets: dict[str, float] | None, budget: float = 1.0, most: float | None = None,
    sample: int = SAMPLE, strict: bool = False,
) -> DataFrame:
    model = learn(own, labels, sample)
    members = own.select(
        *keep, F.regexp_count("text", F.lit(WORD)).cast("long").alias("tokens"), model.posterior(F.col("text")).alias("p"),
        (F.pmod(F.xxhash64("doc_id", "text", F.lit(5)), F.lit(1 << 20)) / float(1 << 20)).alias("draw"),
    )
    members = stored(members, "members")
    fit = fit_rates(members.select("tokens", "p"), model.domains, TARGETS if targets is None else targets, budget, most)
    if not fit.met:
        said = "tokens beyond the targets, as shares of all tokens: " + ", ".join(f"{d} {x:+.4f}" for d, x in fit.miss.items())
        if strict:
            raise ValueError(said)
        warnings.warn(said, stacklevel=3)
    best = F.array_position("p", F.array_max("p")).cast("int") - 1
    return members.withColumn("rate", fit.rate()).select(
        *keep, "tokens", F.get(F.array(*[F.lit(d) for d in model.domains]), best).alias("domain"),
        *[F.get("p", F.lit(k)).alias(f"p_{d}") for k, d in enumerate(model.domains)],
        "rate", F.floor(F.col("rate") + F.col("draw")).cast("long").alias("copies"),
    )
