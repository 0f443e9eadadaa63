"""Secret scan over a trigram inverted index, in DataFrame operations only.

1. ``trigram_query`` derives from each rule's regular expression a Boolean query
   over trigrams that every match must contain, as an OR of trigram sets.
2. The index has a posting (trigram, doc_id) for each trigram of those queries
   that a text contains, letters in lower case, as far as its set can still be
   fulfilled. (An index of all trigrams would be several times the texts; no
   rule would read the rest.)
3. Postings of a document are intersected per trigram set. Documents that have
   all trigrams of one set of a rule are that rule's candidates.
4. Candidates meet their texts by doc_id and are verified with the expression.
   Rules without mandatory trigrams (runs of hex digits) scan every text instead.

Matches are the leftmost non-overlapping ones of each rule's expression; those
whose measured group is too short are dropped afterwards. Positions count code
points, the end is exclusive.

Edge cases: NULL and empty texts have no spans; repeated rows give a row each;
rows without an id are scanned (candidates are matched null-safely); a doc_id with
several texts is a candidate if one of them is, and verification settles
it; extra columns pass through ``redact`` untouched, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from itertools import product
from re import _constants as op
from re import _parser as parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import let, packed, stored


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its expression, and the group that needs a least length."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# The base rules of the contract. ``[0-9a-f]{16,}`` finds the runs of 16 and more of ``[0-9a-f]+``:
# a run ends only at another character, so both see the same runs. The same holds for AKIA.
KEYWORDS = "|".join([*map(_either_case, ("password", "passwd", "secret", "token")), _either_case("api") + "_?" + _either_case("key")])
BASE = (
    Rule("assign", f"({KEYWORDS})[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 12),
    Rule("access", "AKIA[A-Z0-9]{14,}"),
    Rule("hex", "[0-9a-f]{16,}"),
)
# Published formats of keys.
MORE = (
    Rule("private_key", "-----BEGIN [A-Z ]{0,24}PRIVATE KEY-----"),
    Rule("jwt", "eyJ[A-Za-z0-9_-]{8,}[.]eyJ[A-Za-z0-9_-]{8,}[.][A-Za-z0-9_-]{8,}"),
    Rule("code_host", "gh[opsur]_[A-Za-z0-9]{36}"),
    Rule("chat", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("cloud_key", "AIza[A-Za-z0-9_-]{35}"),
    Rule("payment", "[rs]k_live_[A-Za-z0-9]{16,}"),
)
RULES = BASE + MORE

#: Strings that are followed at once while a query is derived; beyond it the query gets weaker, never wrong.
MOST_STRINGS = 64

SPANS = "array<struct<start:int,rank:int,end:int,kind:string>>"
#: Matches that are walked through together, see ``_chunks``.
CHUNK = 256


# ---- from expression to Boolean query -----------------------------------------------------------


def _strings(node) -> set[str] | None:
    """All strings of one parsed item, letters folded, or None if they are too many."""
    kind, value = node
    if kind is op.LITERAL:
        return {chr(value).lower()}
    if kind is op.IN:
        out = set()
        for sub, v in value:
            if sub is op.LITERAL:
                out.add(chr(v).lower())
            elif sub is op.RANGE and v[1] - v[0] < 4:
                out |= {chr(c).lower() for c in range(v[0], v[1] + 1)}
            else:
                return None
        return out if len(out) <= 8 else None
    if kind is op.SUBPATTERN:
        return _sequence_strings(value[3])
    if kind is op.BRANCH:
        parts = [_sequence_strings(b) for b in value[1]]
        return None if None in parts else set().union(*parts)
    if kind is op.MAX_REPEAT and value[0] <= value[1] <= 2:
        part = _sequence_strings(value[2])
        if part is None:
            return None
        return {"".join(p) for n in range(value[0], value[1] + 1) for p in product(part, repeat=n)}
    return None


def _sequence_strings(nodes) -> set[str] | None:
    out = {""}
    for node in nodes:
        part = _strings(node)
        if part is None or len(out) * len(part) > MOST_STRINGS:
            return None
        out = {a + b for a in out for b in part}
    return out


Query = frozenset  # of frozensets of trigrams: one of the sets must be there in full
ANYTHING: Query = frozenset([frozenset()])


def _of_strings(strings: set[str]) -> Query:
    return _least(frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings)


def _least(sets) -> Query:
    """Without sets that hold another one."""
    sets = set(sets)
    return frozenset(s for s in sets if not any(t < s for t in sets))


def _both(a: Query, b: Query) -> Query:
    joined = _least(x | y for x in a for y in b)
    return joined if len(joined) <= MOST_STRINGS else max(a, b, key=lambda q: min(map(len, q)))


def _query(nodes) -> Query:
    query, strings = ANYTHING, {""}
    for node in nodes:
        part = _strings(node)
        if part is not None and len(strings) * len(part) <= MOST_STRINGS:
            strings = {a + b for a in strings for b in part}
            continue
        query, strings = _both(query, _of_strings(strings)), {""}
        if part is not None:
            strings = part if len(part) <= MOST_STRINGS else {""}
            continue
        kind, value = node
        if kind is op.SUBPATTERN:
            query = _both(query, _query(value[3]))
        elif kind is op.BRANCH:
            query = _both(query, _least(s for b in value[1] for s in _query(b)))
        elif kind is op.MAX_REPEAT and value[0] > 0:
            query = _both(query, _query(value[2]))
    return _both(query, _of_strings(strings))


def trigram_query(pattern: str) -> list[list[str]]:
    """Trigram sets of which every match contains at least one in full; [[]] if nothing is mandatory."""
    return sorted(sorted(s) for s in _query(list(parser.parse(pattern))))


# ---- index, candidates, verification ---------------------------------------------------------------


def _sql(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


# Letters of running text, the most frequent first.
LETTERS = "etaoinshrdlcumwfgypbvkjxqz"


def _rarest_first(trigrams) -> list[str]:
    """Trigrams by how seldom their letters are; a text without the first is settled by one look."""
    seldom = lambda g: sum(LETTERS.find(c) if c in LETTERS else len(LETTERS) for c in g)
    return sorted(trigrams, key=lambda g: (-seldom(g), g))


def postings(docs: DataFrame, queries: list[list[str]]) -> DataFrame:
    """The inverted index (trigram, doc_id) over the trigrams of the given sets.

    A set is looked up from its rarest trigram on; once one is missing, the set cannot
    be fulfilled and its other trigrams get no posting from it.
    """

    def of_set(text: Column, rest: list[str]) -> Column:
        none = F.array().cast("array<string>")
        further = F.concat(F.array(F.lit(rest[0])), of_set(text, rest[1:])) if len(rest) > 1 else F.array(F.lit(rest[0]))
        return F.when(F.contains(text, F.lit(rest[0])), further).otherwise(none)

    folded = F.lower(F.coalesce("text", F.lit("")))
    found = let(folded, lambda t: F.array_distinct(F.concat(*[of_set(t, _rarest_first(q)) for q in queries])))
    return docs.select("doc_id", F.explode(found).alias("trigram"))


def candidates(index: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(doc_id, kinds): the rules whose query a document's postings fulfil."""
    sets = [(r.kind, k, g, len(s)) for r in rules for k, s in enumerate(trigram_query(r.pattern)) for g in s]
    spark = index.sparkSession
    query = ", ".join(f"named_struct('kind', {_sql(k)}, 'nr', {n}, 'trigram', {_sql(g)}, 'need', {need})" for k, n, g, need in sets)
    needed = spark.range(1, numPartitions=1).selectExpr(f"inline(array({query}))")  # as many rows as the rules have trigrams
    return (
        index.join(F.broadcast(needed), "trigram")
        .groupBy("doc_id", "kind", "nr", "need")
        .agg(F.size(F.collect_set("trigram")).alias("have"))
        .filter("have = need")
        .groupBy("doc_id")
        .agg(F.collect_set("kind").alias("kinds"))
    )


def _chunks(items: Column) -> Column:
    """A non-empty array cut into arrays of ``CHUNK``: a running state is copied per chunk and not per element."""
    return F.transform(F.sequence(F.lit(1), F.size(items), F.lit(CHUNK)), lambda i: F.slice(items, i, F.lit(CHUNK)))


def _before(values: Column, add: Callable[[Column, Column], Column]) -> Column:
    """For each value what the ones before it add up to, starting from 0, and at last the sum of all."""
    state = F.struct(F.lit(0).cast("int").alias("at"), F.array().cast("array<int>").alias("out"))
    one = lambda s, v: F.struct(add(s["at"], v).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out"))
    return F.aggregate(values, state, one, lambda s: F.concat(s["out"], F.array(s["at"])))


def _matches(text: Column, rule: Rule, rank: int) -> Column:
    """Spans of one rule as an array of (start, rank, end, kind).

    The text is split at the matches; lengths of pieces and matches add up to positions.
    """
    pattern = F.lit(rule.pattern)

    def one(s: Column, p: Column) -> Column:
        start = s["at"] + p["gap"]
        end = start + p["size"]
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(rule.kind).alias("kind"))
        out = F.when(p["weight"] >= rule.least, F.concat(s["out"], F.array(span))).otherwise(s["out"])
        return F.struct(end.alias("at"), out.alias("out"))

    def walk(chunks: Column) -> Column:
        sizes = F.transform(chunks, lambda c: F.aggregate(c, F.lit(0).cast("int"), lambda a, p: a + p["gap"] + p["size"]))
        begin = lambda at: F.struct(at.alias("at"), F.array().cast(SPANS).alias("out"))
        spans = lambda at: F.transform(chunks, lambda c, k: F.aggregate(c, begin(F.get(at, k)), one, lambda s: s["out"]))
        return F.flatten(let(_before(sizes, lambda a, n: a + n), spans))

    hits = F.regexp_extract_all(text, pattern, F.lit(0))
    groups = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else hits
    sized = F.zip_with(hits, groups, lambda h, g: F.struct(F.length(h).alias("size"), F.length(g).alias("weight")))
    gaps = F.transform(F.split(text, rule.pattern, -1), F.length)
    parts = F.zip_with(F.slice(gaps, F.lit(1), F.size(gaps) - 1), sized, lambda g, s: F.struct(g.alias("gap"), s["size"].alias("size"), s["weight"].alias("weight")))
    return F.when(F.regexp_like(text, pattern), let(let(parts, _chunks), walk)).otherwise(F.array().cast(SPANS))


def with_spans(docs: DataFrame, rules: tuple[Rule, ...] = RULES, column: str = "spans") -> DataFrame:
    """``docs`` (doc_id, text and columns named otherwise than ``_...``) with all spans in order of start and rule."""
    text = F.coalesce("text", F.lit(""))
    indexed = tuple(r for r in rules if trigram_query(r.pattern) != [[]])
    rest = [(n, r) for n, r in enumerate(rules) if r not in indexed]
    empty = F.array().cast(SPANS)
    scanned = F.concat(empty, *[_matches(text, r, n) for n, r in rest])
    own = docs.withColumn("_scanned", scanned)
    if indexed:
        queries = sorted({tuple(s) for r in indexed for s in trigram_query(r.pattern)})
        # Written first, so that their size is known when the join is planned: few candidates are broadcast and the texts stay in place.
        found = stored(candidates(postings(docs, queries), indexed), "candidates").select(F.col("doc_id").alias("_id"), F.col("kinds").alias("_kinds"))
        own = own.join(found, F.col("doc_id").eqNullSafe(F.col("_id")), "left").drop("_id")
        verified = [
            F.when(F.array_contains("_kinds", r.kind), _matches(text, r, n)).otherwise(empty) for n, r in enumerate(rules) if r in indexed
        ]
        own = own.withColumn("_scanned", F.concat("_scanned", *verified)).drop("_kinds")
    return own.withColumn(column, F.array_sort("_scanned")).drop("_scanned")


def joined(spans: Column) -> Column:
    """kind:start:end of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per document the counts and spans of secrets."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["rank"] < len(BASE))
    return with_spans(own, rules).select(
        "doc_id", *[count(r.kind).alias(f"n_{r.kind}") for r in BASE],
        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
    )


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mask: str = "[secret]") -> DataFrame:
    """``docs`` with every span, and every union of overlapping spans, replaced by ``mask``.

    ``n_chars`` follows the text where the column is there. NULL texts stay NULL.
    """

    def cut(chunks: Column) -> Column:
        ends = F.transform(chunks, lambda c: F.array_max(F.transform(c, lambda s: s["end"])))

        def pieces(at: Column) -> Column:
            return F.transform(chunks, lambda c, k: piece(c, F.get(at, k), F.get(at, k + 1)))

        def piece(spans: Column, begin: Column, end: Column) -> Column:
            return let(F.substring(F.col("text"), begin + 1, end - begin), lambda own: masked(spans, begin, own))

        def masked(spans: Column, begin: Column, own: Column) -> Column:
            def one(s: Column, p: Column) -> Column:
                before = F.substring(own, s["at"] - begin + 1, p["start"] - s["at"])
                out = F.when(p["start"] >= s["at"], F.concat(s["out"], before, F.lit(mask))).otherwise(s["out"])
                return F.struct(F.greatest(s["at"], p["end"]).alias("at"), out.alias("out"))

            return F.aggregate(spans, F.struct(begin.alias("at"), F.lit("").alias("out")), one, lambda s: s["out"])

        def whole(at: Column) -> Column:
            rest = F.substring(F.col("text"), F.element_at(at, -1) + 1, F.length("text"))
            return F.concat(F.array_join(pieces(at), ""), rest)

        return let(_before(ends, F.greatest), whole)

    found = with_spans(packed(docs, "doc_id", "text"), rules)
    row = F.col("row").withField("text", let(_chunks(F.col("spans")), cut))
    if "n_chars" in docs.columns:
        row = row.withField("n_chars", F.length(row["text"]).cast(docs.schema["n_chars"].dataType))
    return found.select(F.when(F.size("spans") > 0, row).otherwise(F.col("row")).alias("row")).select("row.*")
