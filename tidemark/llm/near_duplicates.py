"""Near-duplicate groups: SuperMinHash, banding, verification, union-find.

1. Each text becomes its set of 5-word shingles (64-bit hashes), a digest of the
   set and a SuperMinHash signature. Equal sets are one class from here on.
2. A signature has 25 bands of 5 of its 128 values. Two sets with a similarity
   of 0.85 share no band with a probability of 4e-7.
3. In every bucket all classes are compared with one hub, by signature (at 0.85
   the chance to be dropped here is below 1e-6) and then by full sets. The links
   found join most of a bucket without pairs inside it.
4. Buckets that still hold several components meet another hub, and then are
   compared inside, in blocks, by full sets and across components only; a cell
   gives no more links than it takes to join its components.
5. Union-find over all links.

Edge cases: a text without words is NULL or empty, has no shingles and is linked
with nothing. With fewer than five words the whole text is one shingle. Repeated
rows are one class. A row without a doc_id links like any other but names no
component: its component is the smallest id in reach, or NULL, and it is kept
only if that is NULL. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.frames import packed, stored
from tidemark.llm.textbuf import NON_BLANK, Words, mix, ragged, slices, words

SHINGLE = 5
SIGNATURE = 128
BANDS, ROWS = 25, 5
#: Pairs are links from this share of 100 on.
PERCENT = 85
#: Equal signature values out of 128; at a similarity of 0.85 fewer are seen with a probability of 1e-7.
LEAST_EQUAL = 86
#: Set elements in one block of a bucket that is compared inside.
BLOCK_ELEMENTS = 1 << 20
#: A class with more than this part of all documents is hot: there are fewer than this many.
HOT_CLASSES = 256


def shingles(found: Words) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, sorted per document, and their number per document."""
    w = found.hashes()
    factor = stream_of = mix(np.arange(1, SHINGLE + 1, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019)) | np.uint64(1)
    total = np.zeros(max(len(w) - SHINGLE + 1, 0), np.uint64)
    for t in range(SHINGLE):
        total += w[t:t + len(total)] * factor[t]
    total = mix(total)
    sets, counts = [], np.zeros(len(found.counts), np.int64)
    for d, (lo, hi) in enumerate(zip(found.first[:-1].tolist(), found.first[1:].tolist())):
        if hi - lo >= SHINGLE:
            own = np.unique(total[lo:hi - SHINGLE + 1])
        elif hi > lo:
            own = mix((w[lo:hi] * stream_of[:hi - lo]).sum(keepdims=True) + np.uint64(hi - lo))
        else:
            continue
        sets.append(own)
        counts[d] = len(own)
    return np.concatenate(sets) if sets else np.zeros(0, np.uint64), counts


def super_min_hash(elements: np.ndarray, counts: np.ndarray, m: int = SIGNATURE) -> np.ndarray:
    """One byte per signature value, for each non-empty set.

    In round j every element draws the next position of its own random
    permutation (Fisher-Yates) and offers j plus a random fraction there. A set
    whose m values all lie below the next round's offers is done: its elements
    leave. Values are integers, the round above 25 random bits.
    """
    n = int((counts > 0).sum())
    best = np.full((n, m), 0xFFFFFFFF, np.uint32)
    owner = np.repeat(np.arange(n), counts[counts > 0])
    seed, order = elements, None
    flat = best.reshape(-1)
    for j in range(m):
        draw = mix(seed + np.uint64((j + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        value = np.uint32(j << 25) | (draw >> np.uint64(39)).astype(np.uint32)
        pick = j + (((draw & np.uint64(0xFFFFFFFF)) * np.uint64(m - j)) >> np.uint64(32)).astype(np.int64)
        if order is None:
            place = pick
        else:
            row = np.arange(len(pick))
            place = order[row, pick].astype(np.int64)
            order[row, pick] = order[:, j]
        np.minimum.at(flat, owner * m + place, value)
        open_sets = best.max(axis=1) >= np.uint64((j + 1) << 25)
        alive = open_sets[owner]
        if not alive.any():
            break
        if order is None:
            order = np.tile(np.arange(m, dtype=np.uint8), (int(alive.sum()), 1))
            order[np.arange(len(order)), pick[alive]] = 0
            seed, owner = seed[alive], owner[alive]
        elif not alive.all():
            seed, owner, order = seed[alive], owner[alive], order[alive]
    return (mix(best.astype(np.uint64)) & np.uint64(0xFF)).astype(np.uint8)


def _set_ids(elements: np.ndarray, counts: np.ndarray) -> list[bytes | None]:
    at = np.concatenate([[0], np.cumsum(counts)]).tolist()
    raw = elements.tobytes()
    return [hashlib.blake2b(raw[8 * a:8 * b], digest_size=16).digest() if b > a else None for a, b in zip(at[:-1], at[1:])]


def _sketch(batches):
    for batch in batches:
        for part, offsets, data in slices(batch, limit=1 << 20):
            elements, counts = shingles(words(offsets, data, NON_BLANK))
            signature = np.zeros((part.num_rows, SIGNATURE), np.uint8)
            signature[counts > 0] = super_min_hash(elements, counts)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"), pa.array(counts, pa.int64()), pa.array(_set_ids(elements, counts), pa.binary()),
                    pa.array([s.tobytes() if c else None for s, c in zip(signature, counts)], pa.binary()),
                ],
                names=["doc_id", "n_shingles", "set_id", "signature"],
            )


def _sets(batches):
    for batch in batches:
        for part, offsets, data in slices(batch, limit=1 << 20):
            elements, counts = shingles(words(offsets, data, NON_BLANK))
            yield pa.RecordBatch.from_arrays(
                [pa.array(_set_ids(elements, counts), pa.binary()), ragged(elements.view(np.int64), counts, pa.int64())],
                names=["set_id", "elements"],
            )


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), SIGNATURE)


def _alike(batches):
    """Pairs whose signatures do not rule a link out."""
    for batch in batches:
        if batch.num_rows:
            same = (_matrix(batch.column("sig_a")) == _matrix(batch.column("sig_b"))).sum(axis=1)
            keep = pa.array(same >= LEAST_EQUAL)
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["a", "b"])


def _confirm(batches):
    """Pairs that are links by their full sets."""
    for batch in batches:
        keep = np.zeros(batch.num_rows, bool)
        left, right = batch.column("set_a"), batch.column("set_b")
        for i in range(batch.num_rows):
            a = left[i].values.to_numpy().view(np.uint64)
            b = right[i].values.to_numpy().view(np.uint64)
            if 100 * min(len(a), len(b)) < PERCENT * max(len(a), len(b)):
                continue
            at = np.searchsorted(b, a)
            at[at == len(b)] = 0
            both = int((b[at] == a).sum())
            keep[i] = 100 * both >= PERCENT * (len(a) + len(b) - both)
        mask = pa.array(keep)
        yield pa.RecordBatch.from_arrays([batch.column("a").filter(mask), batch.column("b").filter(mask)], names=["a", "b"])


def _cell_links(ids: list, comps: list, sets: list[np.ndarray]) -> list[tuple]:
    """Links that join components of one cell, found by exact intersection sizes.

    Postings of all elements give the intersections of one set with all others
    at once. The next set is one of the component with the fewest sets not yet
    taken. The search ends when all of these lie in one component: every pair
    across components then has an end that had its turn.
    """
    number = {c: k for k, c in enumerate(dict.fromkeys(comps))}
    if len(number) < 2:
        return []
    comp = np.array([number[c] for c in comps])
    size = np.array([len(x) for x in sets])
    element = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), size)
    order = np.argsort(element, kind="stable")
    element, owner = element[order], owner[order]
    links = []
    todo = np.arange(len(sets))
    while (comp[todo] != comp[todo[0]]).any():
        at = int(np.bincount(comp[todo])[comp[todo]].argmin())
        x, todo = int(todo[at]), np.delete(todo, at)
        lo, hi = np.searchsorted(element, sets[x], "left"), np.searchsorted(element, sets[x], "right")
        n = hi - lo
        at = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        both = np.bincount(owner[at], minlength=len(sets))
        near = (100 * both >= PERCENT * (size + size[x] - both)) & (comp != comp[x])
        for y in np.flatnonzero(near).tolist():
            if comp[y] != comp[x]:
                links.append((ids[x], ids[y]))
                comp[comp == comp[y]] = comp[x]
    return links


def _across(batches):
    """Links across components in each (bucket, block, block) cell; a cell's rows arrive one after another."""
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])
    now, rows = None, ([], [], [])
    for batch in batches:
        out = []
        keys = list(zip(*(batch.column(c).to_pylist() for c in ("key", "i", "j"))))
        ids, comps, sets = batch.column("set_id").to_pylist(), batch.column("comp").to_pylist(), batch.column("elements")
        for k, cell in enumerate(keys):
            if cell != now:
                out += _cell_links(*rows)
                now, rows = cell, ([], [], [])
            rows[0].append(ids[k])
            rows[1].append(comps[k])
            rows[2].append(np.array(sets[k].values.to_numpy().view(np.uint64)))
        yield pa.RecordBatch.from_pylist([{"a": a, "b": b} for a, b in out], schema=schema)
    yield pa.RecordBatch.from_pylist([{"a": a, "b": b} for a, b in _cell_links(*rows)], schema=schema)


PAIR = "a binary, b binary"


def _with_signatures(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    side = lambda c: classes.select(F.col("set_id").alias(c), F.col("signature").alias(f"sig_{c}"))
    return pairs.join(side("a"), "a").join(side("b"), "b")


def _links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    side = lambda c: sets.select(F.col("set_id").alias(c), F.col("elements").alias(f"set_{c}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "set_a", "set_b").mapInArrow(_confirm, PAIR)


def _sets_of(nodes: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """Full sets of the named classes, from the texts of one document of each."""
    wanted = classes.join(nodes, "set_id", "left_semi").select("doc_id").distinct()
    texts = docs.alias("d").join(wanted.alias("w"), F.col("d.doc_id").eqNullSafe(F.col("w.doc_id")), "left_semi")
    own = texts.mapInArrow(_sets, "set_id binary, elements array<long>")
    # Repeated ids may bring other texts along; each wanted set is kept once.
    return stored(own.join(nodes, "set_id", "left_semi").dropDuplicates(["set_id"]), "sets")


def near_duplicates(docs: DataFrame, star_rounds: int = 2) -> DataFrame:
    """Per document its shingle count, component and whether it is the one to keep.

    ``star_rounds`` trades rounds of hub comparison against work inside buckets;
    the result is the same for any number from 1 on.
    """
    return _verdicts(docs, star_rounds).select("doc_id", "n_shingles", "component_id", "kept")


def _verdicts(docs: DataFrame, star_rounds: int = 2) -> DataFrame:
    """With the document's set, and one of the sets of its component that names it also where no row has an id."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    sketch = stored(own.mapInArrow(_sketch, "doc_id long, n_shingles long, set_id binary, signature binary"), "sketch")
    classes = stored(
        sketch.filter("set_id is not null").groupBy("set_id").agg(
            F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"), F.first("signature").alias("signature"),
            F.count("*").alias("copies"),
        ),
        "classes",
    )
    band = F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda b: F.xxhash64(b, F.substring(F.col("signature"), b * ROWS + 1, F.lit(ROWS))),
    )
    every = classes.select("set_id", "n", F.explode(band).alias("key"))
    shared = stored(every.groupBy("key").agg(F.count("*").alias("size"), F.sum("n").alias("elements")).filter("size > 1"), "buckets")
    members = stored(every.join(shared, "key"), "members")
    alike = stored(_with_signatures(_stars(members, 0), classes).mapInArrow(_alike, PAIR), "pairs")
    # Full sets are needed where a hub looks alike, and in all buckets whose members a hub alone cannot settle.
    likely = alike.select(F.col("a").alias("set_id")).union(alike.select("b")).union(members.filter("size > 2").select("set_id"))
    nodes = stored(likely.distinct(), "nodes")
    sets = _sets_of(nodes, own, classes)
    links = stored(_links(alike, sets), "links")
    roots = components(links)
    for turn in range(1, star_rounds + 1):
        members = stored(_mixed(members, roots), "mixed")
        if members.isEmpty():
            break
        if turn < star_rounds:
            pairs = _with_signatures(_stars(members, turn), classes).mapInArrow(_alike, PAIR)
            found = _links(pairs, sets)
        else:
            found = _inside(members, sets)
        links = links.union(stored(found, "links"))
        roots = components(links)
    group = classes.join(roots, F.col("set_id") == F.col("node"))
    least = group.groupBy("root").agg(F.min("doc_id").alias("least"))
    named = group.join(least, "root").select("set_id", "root", F.col("least").alias("linked"))
    component = classes.select("set_id", "copies", F.col("doc_id").alias("least")).join(named, "set_id", "left")
    component = component.select("set_id", "copies", F.coalesce("linked", "least").alias("component_id"), F.coalesce("root", "set_id").alias("root"))
    component = stored(component, "named")
    return _spread(sketch.select("doc_id", "n_shingles", "set_id"), component).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def _spread(sketch: DataFrame, component: DataFrame) -> DataFrame:
    """Each document with its class's component.

    Documents of classes with more than a ``1 / HOT_CLASSES`` share of all, at
    most ``HOT_CLASSES`` of them, meet their component by broadcast and those
    without words meet none, so no task gets all copies of one text.
    """
    floor = (component.agg(F.sum("copies")).first()[0] or 0) / HOT_CLASSES
    hot = F.broadcast(component.filter(F.col("copies") > floor).drop("copies"))
    rest = sketch.filter("set_id is not null").join(hot.select("set_id"), "set_id", "left_anti")
    parts = [
        sketch.join(hot, "set_id"),
        rest.join(component.filter(F.col("copies") <= floor).drop("copies"), "set_id"),
        sketch.filter("set_id is null").withColumn("component_id", F.col("doc_id")).withColumn("root", F.col("set_id")),
    ]
    named = [p.select("doc_id", "n_shingles", "set_id", "root", "component_id") for p in parts]
    return named[0].unionByName(named[1]).unionByName(named[2])


def _stars(members: DataFrame, turn: int) -> DataFrame:
    """One hub of each bucket with all others, or with those of other components where these are known."""
    rank = F.col("set_id") if turn == 0 else F.xxhash64("set_id", "key", F.lit(turn))
    comp = F.col("comp") if "comp" in members.columns else F.col("set_id")
    named = members.select("key", "set_id", comp.alias("comp"))
    hubs = named.groupBy("key").agg(F.min_by(F.struct("set_id", "comp"), rank).alias("hub"))
    pairs = named.join(hubs, "key").filter("comp <> hub.comp")
    return pairs.select(F.least("set_id", "hub.set_id").alias("a"), F.greatest("set_id", "hub.set_id").alias("b")).distinct()


def _mixed(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Members of buckets with three and more classes (in pairs the hub met the other) in several components."""
    placed = (
        members.filter("size > 2")
        .select("key", "set_id", "n", "size", "elements")
        .join(roots, F.col("set_id") == F.col("node"), "left")
        .select("key", "set_id", "n", "size", "elements", F.coalesce("root", "set_id").alias("comp"))
    )
    placed = stored(placed, "placed")
    mixed = placed.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi").select("key")
    return placed.join(mixed, "key", "left_semi")


def _inside(members: DataFrame, sets: DataFrame) -> DataFrame:
    blocks = F.ceil(F.col("elements") / F.lit(BLOCK_ELEMENTS)).cast("long")
    cells = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1),
        lambda x: F.struct(F.least(x, F.col("block")).alias("i"), F.greatest(x, F.col("block")).alias("j")),
    )
    return (
        members.withColumn("blocks", blocks)
        .withColumn("block", F.pmod(F.xxhash64("set_id"), F.col("blocks")))
        .select("key", "set_id", "comp", F.explode(cells).alias("c"))
        .join(sets, "set_id")
        .select("key", "c.i", "c.j", "set_id", "comp", "elements")
        .repartition("key", "i", "j")
        .sortWithinPartitions("key", "i", "j")
        .mapInArrow(_across, PAIR)
    )


def _text_sets(batches):
    for batch in batches:
        for part, offsets, data in slices(batch, "_text", 1 << 20):
            sets = pa.array(_set_ids(*shingles(words(offsets, data, NON_BLANK))), pa.binary())
            yield pa.RecordBatch.from_arrays([part.column("_id"), part.column("_text"), sets], names=["_id", "_text", "set_id"])


def deduplicated(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each group.

    Only the ids to drop are joined, where an id has one row. Of other ids and of
    rows without one, those stay whose set represents its group (rows without an
    id only where no row of the group has one), with the least text that has this
    set. Rows equal in id and text count as one. A text without words is a group
    of its own for each id.
    """
    rows = stored(_verdicts(docs).select("doc_id", "set_id", "root", "kept"), "verdicts")
    ids = rows.filter("doc_id is not null").groupBy("doc_id").agg(F.max("kept").alias("kept"), F.count("*").alias("n"))
    ids = stored(ids.filter("not kept or n > 1").select(F.col("doc_id").alias("_id"), "n"), "verdict")
    row_id = F.col("row.doc_id").cast("long")
    own = packed(docs)
    once = own.join(ids.select("_id"), row_id == F.col("_id"), "left_anti")
    if ids.filter("n > 1").isEmpty() and rows.filter("doc_id is null").isEmpty():
        return once.select("row.*")
    several = own.join(ids.filter("n > 1").select("_id"), row_id == F.col("_id"), "left_semi").union(own.filter(row_id.isNull()))
    several = stored(several, "several")
    kept = rows.filter("kept and set_id is not null").groupBy("root").agg(F.min(F.struct("set_id", "doc_id")).alias("least"))
    kept = kept.select("least.set_id", F.col("least.doc_id").alias("kept_id"))
    texts = several.select(row_id.alias("_id"), F.col("row.text").alias("_text")).distinct()
    texts = stored(texts.mapInArrow(_text_sets, "_id long, _text string, set_id binary"), "texts")
    stay = texts.alias("t").join(kept.alias("k"), (F.col("t.set_id") == F.col("k.set_id")) & F.col("_id").eqNullSafe(F.col("kept_id")))
    stay = stay.groupBy("t.set_id", "_id").agg(F.min("_text").alias("_text")).select("_id", "_text")
    stay = stored(stay.union(texts.filter("set_id is null").select("_id", "_text")), "stay")
    same = row_id.eqNullSafe(F.col("_id")) & F.col("row.text").eqNullSafe(F.col("_text"))
    again = several.join(stay, same, "left_semi").select("row.*").dropDuplicates(["doc_id", "text"])
    return once.filter(row_id.isNotNull()).select("row.*").union(again)
