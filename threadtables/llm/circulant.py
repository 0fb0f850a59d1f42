"""Near-duplicate documents by circulant MinHash: two permutations give a whole signature."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from threadtables.llm.components import connected
from threadtables.llm.ngram_join import shingle_sets
from threadtables.llm.prefilter import likely
from threadtables.llm.textbytes import as_long, mix
from threadtables.session import stage

#: Signature of BANDS x ROWS coordinates. A pair at similarity 0.8 shares no band with odds of 1e-7.
BANDS, ROWS = 30, 4
COORDINATES = BANDS * ROWS
#: Shingles of the texts that one task compares at a time, and members of a bucket whose signatures it does.
TILE, MEMBERS = 1 << 21, 1 << 11
_CIRCLE = np.uint32(0x9E3779B1)


def place(shingles: np.ndarray) -> np.ndarray:
    """The first permutation: it scatters shingles over a circle of 2^32 places."""
    return (mix(shingles ^ np.uint64(0x2545F4914F6CDD1D)) >> np.uint64(32)).astype(np.uint32)


def _second(turned: np.ndarray, out: np.ndarray) -> np.ndarray:
    """The second permutation, a bijection of 32 bits, of places that were multiplied by _CIRCLE."""
    np.right_shift(turned, np.uint32(15), out=out)
    np.bitwise_xor(out, turned, out=out)
    np.multiply(out, np.uint32(0x85EBCA77), out=out)
    np.bitwise_xor(out, out >> np.uint32(13), out=out)
    return np.multiply(out, np.uint32(0xC2B2AE3D), out=out)


def signatures(places: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A row of COORDINATES for each set that is not empty; set i has places[first[i]:first[i + 1]].

    Coordinate k is the least value of the second permutation after the circle was shifted by k. The shift is added
    behind the multiplication, which is the same modulo 2^32.
    """
    least = np.empty((COORDINATES, len(first) - 1), np.uint32)
    turned = places * _CIRCLE
    work = np.empty_like(turned)
    for k in range(COORDINATES):
        least[k] = np.minimum.reduceat(_second(turned, work), first[:-1])
        turned += _CIRCLE
    return least.T


def _gathered(texts: pa.Array, n: int, most: int = 1 << 17) -> Iterator[list[np.ndarray]]:
    """Sets of consecutive rows, about `most` shingles at a time."""
    held, size = [], 0
    for s in shingle_sets(texts, n):
        held.append(s)
        size += len(s)
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def prints(docs: DataFrame, n: int) -> DataFrame:
    """doc_id, print, n_shingles, f1, f2 (of the whole set), bands and sketch (a byte of each coordinate); nulls without
    words. `docs`: doc_id, print, text."""

    def rows(batches):
        for batch in batches:
            at = 0
            for sets in _gathered(batch.column(2), n):
                sizes = np.array([len(s) for s in sets])
                full = np.flatnonzero(sizes)
                f1, f2, bands, sketch = ([None] * len(sets) for _ in range(4))
                if len(full):
                    flat, first = np.concatenate([sets[i] for i in full]), np.concatenate([[0], np.cumsum(sizes[full])])
                    least = signatures(place(flat), first)
                    keys = (mix(least.astype(np.uint64) + (np.arange(COORDINATES, dtype=np.uint64) << np.uint64(32))).reshape(-1, BANDS, ROWS)
                            * np.array([1, 3, 5, 7], np.uint64)).sum(axis=2)
                    keys = as_long(mix(keys))
                    short = (mix(least.astype(np.uint64)) >> np.uint64(56)).astype(np.uint8)
                    one, two = (as_long(np.add.reduceat(x, first[:-1])) for x in (flat, mix(flat ^ np.uint64(0x5851F42D4C957F2D))))
                    for k, i in enumerate(full):
                        f1[i], f2[i], bands[i], sketch[i] = int(one[k]), int(two[k]), keys[k], short[k].tobytes()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(sets)), batch.column(1).slice(at, len(sets)), pa.array(sizes, pa.int64()), pa.array(f1, pa.int64()), pa.array(f2, pa.int64()),
                     pa.array(bands, pa.list_(pa.int64())), pa.array(sketch, pa.binary())],
                    names=["doc_id", "print", "n_shingles", "f1", "f2", "bands", "sketch"])
                at += len(sets)

    return docs.mapInArrow(rows, "doc_id long, print long, n_shingles long, f1 long, f2 long, bands array<long>, sketch binary")


def _matrix(sketches: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(sketches.to_pylist()), np.uint8).reshape(-1, COORDINATES)


def agreeing(percent: int) -> int:
    """So many coordinates agree at least in all but about one of 10^11 pairs at that similarity."""
    p = percent / 100
    return int(COORDINATES * p - 6.9 * (COORDINATES * p * (1 - p)) ** 0.5)


def _alike(pairs: DataFrame, agree: int) -> DataFrame:
    """member, center of the pairs whose signatures agree in so many coordinates."""

    def keep(batches):
        for batch in batches:
            if batch.num_rows:
                near = pa.array((_matrix(batch.column(2)) == _matrix(batch.column(3))).sum(axis=1) >= agree)
                yield pa.RecordBatch.from_arrays([batch.column(0).filter(near), batch.column(1).filter(near)], names=["member", "center"])

    return pairs.select("member", "center", "sm", "sc").mapInArrow(keep, "member long, center long")


def _overlaps(one: np.ndarray, two: np.ndarray, percent: int) -> bool:
    if 100 * min(len(one), len(two)) < percent * max(len(one), len(two)):
        return False
    at = np.minimum(np.searchsorted(two, one), len(two) - 1)
    both = int((two[at] == one).sum())
    return 100 * both >= percent * (len(one) + len(two) - both)


def _stars(near: DataFrame, sizes: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """a, b: the pairs of member and center that are similar by their whole sets. A center with many members goes to
    several tasks, each with its text once."""
    tiles = near.join(sizes.withColumnRenamed("node", "member"), "member").groupBy("center").agg(F.ceil(F.sum("n_shingles") / TILE).alias("tiles"))
    tiles = stage(tiles, "circulant-tiles")
    dealt = near.join(tiles, "center").select("center", F.pmod(F.xxhash64("member"), F.col("tiles")).alias("tile"), "member")
    heads = tiles.select("center", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)).alias("tile"), F.col("center").alias("member"))
    rows = dealt.unionByName(heads).join(texts.withColumnRenamed("node", "member"), "member")
    rows = rows.select("center", "tile", (F.col("member") != F.col("center")).alias("later"), "member", "text")

    def compare(batches):
        head = None
        for batch in batches:
            found = []
            columns = (batch.column(i).to_pylist() for i in (0, 2, 3))
            for center, later, member, s in zip(*columns, shingle_sets(batch.column(4), n), strict=True):
                if not later:
                    head = s
                elif _overlaps(s, head, percent):
                    found.append((member, center))
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], names=["a", "b"])

    keys = ["center", "tile"]
    return rows.repartition(*keys).sortWithinPartitions(*keys, "later", "member").mapInArrow(compare, "a long, b long")


def _undecided(banded: DataFrame, roots: DataFrame, sketches: DataFrame) -> DataFrame:
    """block, node, root, outside, sketch: members of buckets that are not in one component yet, each set of members
    once. `outside`: not in the bucket's largest component, so it must be compared with all others."""
    rooted = banded.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    buckets = rooted.groupBy("band").agg(
        F.min("root").alias("lo"), F.max("root").alias("hi"), F.bit_xor(F.xxhash64("node")).alias("x1"),
        F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("x2")).where("lo < hi")
    once = buckets.groupBy("x1", "x2").agg(F.min("band").alias("band")).select("band")
    open_rows = stage(rooted.join(once, "band", "left_semi"), "circulant-open")
    sizes = open_rows.groupBy("band", "root").agg(F.count("*").alias("k"))
    main = sizes.groupBy("band").agg(F.max(F.struct("k", "root"))["root"].alias("main"))
    rows = open_rows.join(main, "band").select(F.col("band").alias("block"), "node", "root", (F.col("root") != F.col("main")).alias("outside"))
    return rows.join(sketches, "node")


def _tiled(rows: DataFrame, weight: str, most: int) -> DataFrame:
    """Members of each block dealt out so that every outside member meets every member in some tile: outside members
    are cut into parts, all members into slices, and a tile is a part with a slice. `own`: a member of the slice."""
    sums = rows.groupBy("block").agg(F.greatest(F.lit(1), F.ceil(F.sum(weight) / most)).alias("slices"),
                                     F.greatest(F.lit(1), F.ceil(F.sum(F.when(F.col("outside"), F.col(weight))) / most)).alias("parts"))
    placed = rows.join(sums, "block").withColumn("slice", F.pmod(F.xxhash64("node"), F.col("slices"))).withColumn("part", F.pmod(F.xxhash64("node", F.lit(1)), F.col("parts")))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    as_slice = placed.withColumn("part", every("parts")).withColumn("own", F.lit(True))
    as_part = placed.where("outside").withColumn("slice", every("slices")).withColumn("own", F.lit(False))
    return as_slice.unionByName(as_part).drop("slices", "parts")


def _candidates(open_rows: DataFrame, agree: int) -> DataFrame:
    """block, node of the members that agree with one of another component, by signatures alone."""

    def search(batches):
        for key, table in _by_key(batches, 3):
            nodes, roots, own = (table.column(c).combine_chunks().to_numpy(zero_copy_only=False) for c in ("node", "root", "own"))
            sketch = _matrix(table.column("sketch"))
            slice_ = np.flatnonzero(own)
            hit = np.zeros(len(nodes), bool)
            for i in np.flatnonzero(~own):
                near = slice_[(sketch[slice_] == sketch[i]).sum(axis=1) >= agree]
                near = near[roots[near] != roots[i]]
                if len(near):
                    hit[near] = hit[i] = True
            found = np.unique(nodes[hit])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), key[0])), pa.array(found)], names=["block", "node"])

    rows = _tiled(open_rows.withColumn("one", F.lit(1)), "one", MEMBERS)
    keys = ["block", "part", "slice"]
    rows = rows.select(*keys, "node", "root", "own", "sketch").repartition(*keys).sortWithinPartitions(*keys)
    return rows.mapInArrow(search, "block long, node long").distinct()


def _by_key(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[tuple, pa.Table]]:
    """Consecutive rows with equal first `width` columns."""
    key, held = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.column_stack([batch.column(i).to_numpy() for i in range(width)])
        cuts = np.concatenate([[0], np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1, [len(keys)]])
        for b, e in zip(cuts[:-1], cuts[1:], strict=True):
            if key is not None and tuple(keys[b]) != key:
                yield key, pa.Table.from_batches(held)
                held = []
            key = tuple(keys[b])
            held.append(batch.slice(b, e - b))
    if held:
        yield key, pa.Table.from_batches(held)


def _links_among(sets: list[np.ndarray], own: np.ndarray, roots: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Positions (probe, member of the slice) of similar sets that connect all similar ones of different components.

    Inverted lists of the slice give the exact overlap of a probe with every member at once.
    """
    members = np.flatnonzero(own)
    sizes = np.array([len(s) for s in sets])
    flat = np.concatenate([sets[i] for i in members]) if len(members) else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(members)), sizes[members])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    names, label = np.unique(roots, return_inverse=True)
    parent = list(range(len(names)))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for q in np.flatnonzero(~own):
        lo, hi = np.searchsorted(flat, sets[q], "left"), np.searchsorted(flat, sets[q], "right")
        n = hi - lo
        at = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
        both = np.bincount(owner[at], minlength=len(members))
        near = np.flatnonzero(100 * both >= percent * (sizes[q] + sizes[members] - both))
        for k in near:
            a, b = find(label[q]), find(label[members[k]])
            if a != b:
                parent[a] = b
                out.append((int(q), int(members[k])))
    return out


def _block_links(open_rows: DataFrame, sizes: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """a, b: links that connect all similar members of each block."""

    def search(batches):
        for _, table in _by_key(batches, 3):
            nodes, roots, own = (table.column(c).combine_chunks().to_numpy(zero_copy_only=False) for c in ("node", "root", "own"))
            sets = [s for c in table.column("text").chunks for s in shingle_sets(c, n)]
            found = _links_among(sets, own, roots, percent)
            yield pa.RecordBatch.from_arrays([pa.array([int(nodes[f[i]]) for f in found], pa.int64()) for i in (0, 1)], names=["a", "b"])

    keys = ["block", "part", "slice"]
    rows = _tiled(open_rows.join(sizes, "node"), "n_shingles", TILE).select(*keys, "node", "root", "own").join(texts, "node")
    return rows.select(*keys, "node", "root", "own", "text").repartition(*keys).sortWithinPartitions(*keys).mapInArrow(search, "a long, b long")


def near_duplicates(docs: DataFrame, n: int = 2, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: groups of documents whose sets of `n`-word shingles overlap by `percent`.

    1. One pass gives every set its circulant signature and fingerprints; equal sets are one class, for which the text
       with its smallest doc_id stands.
    2. Classes that share a band fall into a bucket. All are compared with its least and greatest member, first by
       signature, then by their whole sets; these links are joined by union-find.
    3. Of a bucket that is still in several components, all members outside the largest one are compared with all its
       members of other components, again by signature and then by whole sets, tile by tile. So every pair that shares
       a band and agrees in most coordinates is either found similar, found not, or already connected.
    Only members and links leave a task, never the pairs that were compared. Null or empty texts have no shingles and
    are their own component; a null doc_id gets none and is kept; rows with one doc_id are one document, linked by any
    of their texts; `kept` is the smallest doc_id of a component; extra columns are ignored.
    """
    if percent < 80:
        raise ValueError("the bands are made for similarities of 80 percent or more")
    docs = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("print"), F.col("text").cast("string"))
    table = stage(prints(docs, n), "circulant-prints")
    kinds = ["n_shingles", "f1", "f2"]
    alive = table.where("n_shingles > 0 and doc_id is not null")
    classes = alive.groupBy(*kinds).agg(F.min_by(F.struct("doc_id", "print", "bands", "sketch"), F.struct("doc_id", "print")).alias("rep"))
    classes = stage(classes.select(F.monotonically_increasing_id().alias("node"), *kinds, "rep.*"), "circulant-classes")
    banded = classes.select("node", F.explode("bands").alias("band"))
    ends = banded.groupBy("band").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi")
    banded = stage(banded.join(ends, "band"), "circulant-buckets")
    held = stage(classes.join(banded.select("node").distinct(), "node", "left_semi").drop("bands", "f1", "f2"), "circulant-members")
    sizes, sketches = held.select("node", "n_shingles"), held.select("node", "sketch")
    texts = likely(docs, "print", held).join(held.select("doc_id", "print", "node"), ["doc_id", "print"]).select("node", "text")
    texts = stage(texts.dropDuplicates(["node"]), "circulant-texts")
    pairs = banded.select(F.col("node").alias("member"), F.explode(F.array("lo", "hi")).alias("center")).where("member <> center").distinct()
    side = lambda x, to: sketches.select(F.col("node").alias(x), F.col("sketch").alias(to))
    near = stage(_alike(pairs.join(side("member", "sm"), "member").join(side("center", "sc"), "center"), agreeing(percent)), "circulant-pairs")
    several = alive.groupBy("doc_id").agg(F.min(F.struct(*kinds)).alias("lo"), F.max(F.struct(*kinds)).alias("hi")).where("lo <> hi").select("doc_id")
    several = alive.join(several, "doc_id", "left_semi").select("doc_id", *kinds).distinct().join(classes.select("node", *kinds), kinds).select("doc_id", "node")
    several = stage(several, "circulant-several")
    one_id = several.join(several.groupBy("doc_id").agg(F.min("node").alias("b")), "doc_id").select(F.col("node").alias("a"), "b").where("a <> b")
    links = _stars(near, sizes, texts, n, percent).unionByName(one_id)
    links = stage(links, "circulant-links")
    roots = connected(links)
    open_rows = stage(_undecided(banded.select("node", "band"), roots, sketches), "circulant-undecided")
    if not open_rows.isEmpty():
        wanted = stage(_candidates(open_rows, agreeing(percent)), "circulant-candidates")
        rest = open_rows.drop("sketch").join(wanted, ["block", "node"], "left_semi")
        links = links.unionByName(stage(_block_links(rest, sizes, texts, n, percent), "circulant-more"))
        roots = connected(links)
    rooted = classes.select("node", *kinds, "doc_id").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    rooted = stage(rooted, "circulant-rooted")
    least = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = rooted.join(least, "root").select(*kinds, "component_id")
    found = table.select("doc_id", *kinds).join(named, kinds, "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
