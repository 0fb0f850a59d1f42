"""Documents linked by the Jaccard similarity of their word shingles, found by T-occurrence search in inverted lists."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from threadtables.llm.components import connected
from threadtables.llm.prefilter import likely
from threadtables.llm.textbytes import as_long, chunks, flags, grams, mix
from threadtables.session import stage

#: Words end at a blank or at \t \n \v \f \r.
WORD = flags(" \t\n\x0b\x0c\r", among=False)
#: Shingles of the texts that one task searches at a time (8 bytes each, and some 50 while it searches).
TILE = 1 << 21
#: Signature: BANDS x ROWS least values. A pair at similarity 0.8 shares no band with odds of 1e-7.
BANDS, ROWS = 30, 4
_FACTORS = mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)) | np.uint64(1)
#: Of the signature's values, so many agree at least in all but one of 10^10 pairs at similarity 0.8.
AGREE = 66
#: Members of a band whose signature agrees so far with that of a pivot stand for nothing else: what is near them is near
#: enough to the pivot, since the values that differ are a distance.
TIGHT = 110
#: Members of a band that are compared with each other in one go; larger bands are dealt into pairs of such parts.
PART = 512


def shingle_sets(texts: pa.Array, n: int = 5) -> Iterator[np.ndarray]:
    """The sorted shingle fingerprints of each text; a shorter text is one shingle, none without words."""
    for chunk in chunks(texts):
        chunk.lower()
        begin, end, first = chunk.words(WORD)
        words = mix(chunk.fingerprints(begin, end))
        places, prints = grams(words, first, n)
        at = np.searchsorted(places, first)
        for row in range(len(chunk)):
            if 0 < first[row + 1] - first[row] < n:
                own = words[first[row]:first[row + 1]]
                yield grams(own, np.array([0, len(own)]), len(own))[1]
            else:
                yield np.unique(prints[at[row]:at[row + 1]])


def _signature(shingles: np.ndarray) -> np.ndarray:
    least = np.full(len(_FACTORS), np.iinfo(np.uint64).max)
    for k in range(0, len(shingles), 2048):
        part = shingles[k:k + 2048]
        for i in range(0, len(_FACTORS), 8):
            np.minimum(least[i:i + 8], (part[None, :] * _FACTORS[i:i + 8, None]).min(axis=1), out=least[i:i + 8])
    return least


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, f1, f2 (of the whole set), bands and sketch (of the signature); nulls without shingles."""

    def prints(batches):
        for batch in batches:
            sizes, sums, bands, sketches = [], [], [], []
            for s in shingle_sets(batch.column(1)):
                sizes.append(len(s))
                if not len(s):
                    sums.append((None, None))
                    bands.append(None)
                    sketches.append(None)
                    continue
                sums.append((int(as_long(s.sum(keepdims=True))[0]), int(as_long(mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(keepdims=True))[0])))
                least = _signature(s)
                keys = mix(least).reshape(BANDS, ROWS) * np.array([1, 3, 5, 7], np.uint64)
                bands.append(as_long(mix(keys.sum(axis=1) + np.arange(BANDS, dtype=np.uint64))))
                sketches.append((mix(least) >> np.uint64(56)).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array([x[0] for x in sums], pa.int64()), pa.array([x[1] for x in sums], pa.int64()),
                 pa.array(bands, pa.list_(pa.int64())), pa.array(sketches, pa.binary())],
                names=["doc_id", "n_shingles", "f1", "f2", "bands", "sketch"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        prints, "doc_id long, n_shingles long, f1 long, f2 long, bands array<long>, sketch binary")


def _agreeing(rows: DataFrame) -> DataFrame:
    """Rows (a, b, sa, sb) as (a, b, agree): how many values of two signatures agree."""
    def count(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            one, two = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, BANDS * ROWS) for i in (2, 3))
            agree = pa.array((one == two).sum(axis=1), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), agree], names=["a", "b", "agree"])

    return rows.select("a", "b", "sa", "sb").mapInArrow(count, "a long, b long, agree int")


def _near_pairs(held: DataFrame) -> DataFrame:
    """Pairs (a, b) that connect all documents (doc_id, bands, sketch) which share a band and agree in AGREE values.

    Each member of a band is compared with the smallest and the largest one. Who agrees with such a pivot in TIGHT values
    is done: its partners agree with the pivot in AGREE less the values it differs by, and are paired with the pivot. All
    others of a band are compared with each other, in pairs of parts of some PART members; so copies cost one comparison
    each, and no pair is left out because neither is like the pivots. Of each such comparison only pairs that connect what
    is not yet connected are given, fewer than it has members.

    Bands are shuffled without signatures, which take 8 times their room: only members of a band that others share meet
    signatures, a member and a pivot once for all their bands.
    """
    loose = AGREE - (BANDS * ROWS - TIGHT)
    banded = held.select("doc_id", F.explode("bands").alias("band"))
    ends = banded.groupBy("band").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi")
    banded = stage(banded.join(ends, "band").distinct(), "shared-bands")
    sketches = stage(likely(held.select("doc_id", "sketch"), "doc_id", banded).distinct(), "sketches")
    side = lambda x, to: sketches.select(F.col("doc_id").alias(x), F.col("sketch").alias(to))
    pairs = banded.select(F.col("doc_id").alias("a"), F.explode(F.array("lo", "hi")).alias("b")).where("a <> b").distinct()
    seen = stage(_agreeing(pairs.join(side("a", "sa"), "a").join(side("b", "sb"), "b")), "band-pivots")
    tight = seen.where(F.col("agree") >= TIGHT).groupBy(F.col("a").alias("doc_id")).agg(F.collect_set("b").alias("near"))
    # a doc_id that repeats with other texts has several signatures and stays open
    prints = sketches.groupBy("doc_id").agg(F.min(F.xxhash64("sketch")).alias("p"), F.max(F.xxhash64("sketch")).alias("q"))
    several = prints.where("p <> q").select("doc_id", F.lit(True).alias("several"))
    members = banded.join(tight, "doc_id", "left").join(several, "doc_id", "left")
    done = "doc_id = lo or doc_id = hi or array_contains(near, lo) or array_contains(near, hi)"
    rest = stage(members.where(f"several or not coalesce({done}, false)").select("band", "doc_id"), "band-rest")
    parts = rest.groupBy("band").agg(F.ceil(F.count(F.lit(1)) / PART).alias("parts"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    dealt = rest.join(parts, "band").withColumn("part", F.pmod(F.xxhash64("doc_id"), F.col("parts")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))
    dealt = dealt.withColumns({"one": F.least("part", "other"), "two": F.greatest("part", "other")})
    dealt = dealt.select("band", "one", "two", "doc_id").join(sketches, "doc_id")

    def links(batches):
        key, ids, sketches = None, [], []

        def done():
            s = np.frombuffer(b"".join(sketches), np.uint8).reshape(-1, BANDS * ROWS)
            docs, found, label = np.array(ids, np.int64), [], np.arange(len(s))
            for i in range(len(s) - 1):
                apart = i + 1 + np.flatnonzero(label[i + 1:] != label[i])
                near = apart[(s[apart] == s[i]).sum(axis=1) >= AGREE]
                groups, first = np.unique(label[near], return_index=True)
                found += [(docs[i], d) for d in docs[near[first]]]
                label[np.isin(label, groups)] = label[i]
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

        for batch in batches:
            for *k, doc, sketch in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if k != key and ids:
                    yield done()
                    ids, sketches = [], []
                key = k
                ids.append(doc)
                sketches.append(sketch)
        if ids:
            yield done()

    keys = ["band", "one", "two"]
    among = dealt.select(*keys, "doc_id", "sketch").repartition(*keys).sortWithinPartitions(*keys).mapInArrow(links, "a long, b long")
    return seen.where((F.col("agree") >= loose) & (F.col("a") != F.col("b"))).select("a", "b").unionByName(among.where("a <> b"))


def t_occurrence_links(sets: list[np.ndarray], percent: int = 80) -> np.ndarray:
    """A label for each set: equal in a group linked by intersections of `percent` of the union.

    Each set is searched against those before it. A partner shares at least T of its r shingles; so by DivideSkip up to
    T - 1 of its longest lists are left out, the short ones are merged, and whoever occurs in T - L of them is probed by
    binary search in the L long ones. Members of its own group are not searched again.
    """
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    order = np.argsort(flat, kind="stable")
    heads = np.ones(len(flat), bool)
    heads[1:] = flat[order][1:] != flat[order][:-1]
    begin = np.flatnonzero(heads)
    of = np.cumsum(heads) - 1
    lists, earlier = np.empty(len(flat), np.int64), np.empty(len(flat), np.int64)
    lists[order], earlier[order] = of, np.arange(len(flat)) - begin[of]
    posted = owner[order]
    label = np.arange(len(sets))
    at = 0
    for q, own in enumerate(sets):
        r = len(own)
        before = earlier[at:at + r]
        mine = np.flatnonzero(before)
        need = -(-percent * r // 100)
        if r and len(mine) >= need:
            mine = mine[np.argsort(before[mine], kind="stable")]
            longest = int(before[mine[-1]])
            skip = min(need - 1, int(need / (0.0085 * np.log2(longest + 1) + 1)))
            short, long = mine[:len(mine) - skip], mine[len(mine) - skip:]
            merged = np.concatenate([posted[b:b + k] for b, k in zip(begin[lists[at + short]], before[short], strict=True)])
            found, times = np.unique(merged, return_counts=True)
            keep = times >= need - skip
            found, times = found[keep], times[keep]
            rank = np.argsort(-times, kind="stable")
            found, times = found[rank], times[rank]
            while len(found):
                keep = label[found] != label[q]
                found, times = found[keep], times[keep]
                linked = False
                for i, (c, k) in enumerate(zip(found, times, strict=True)):
                    other = sets[c]
                    probe = own[long]
                    place = np.searchsorted(other, probe)
                    both = int(k) + int((other[np.minimum(place, len(other) - 1)] == probe).sum())
                    if 100 * both >= percent * (r + len(other) - both):
                        label[label == label[q]] = label[c]
                        found, times, linked = found[i + 1:], times[i + 1:], True
                        break
                if not linked:
                    break
        at += r
    return label


def _search(rows: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) of rows (block, tile, doc_id, text): a chain through each group found in a tile."""

    def links(batches):
        key, ids, sets = None, [], []

        def done():
            label = t_occurrence_links(sets, percent)
            order = np.lexsort((np.array(ids), label))
            same = np.flatnonzero(label[order][1:] == label[order][:-1])
            a, b = np.array(ids, np.int64)[order[same]], np.array(ids, np.int64)[order[same + 1]]
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
            for k, doc, s in zip(keys, batch.column(2).to_pylist(), shingle_sets(batch.column(3)), strict=True):
                if k != key and ids:
                    yield done()
                    ids, sets = [], []
                key = k
                ids.append(doc)
                sets.append(s)
        if ids:
            yield done()

    keys = ["block", "tile"]
    return rows.select(*keys, "doc_id", "text").repartition(*keys).sortWithinPartitions(*keys, "doc_id").mapInArrow(links, "a long, b long")


def similar_documents(docs: DataFrame, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id: groups of documents whose sets of 5-word shingles overlap by `percent`.

    1. One pass fingerprints every set; equal sets become one class, kept by its smallest doc_id.
    2. Classes that share a band of their signatures, and most of the signature, fall into one block (_near_pairs). A
       band of n near copies makes some 2n pairs; only members unlike its pivots are compared with each other.
    3. In each block T-occurrence search finds every link by exact counts. A block beyond TILE shingles is dealt into
       tiles that share its first part; if its documents are then not all in one group, those outside the largest group
       are searched against the whole block, tile by tile.
    Links joined by union-find give the components. Null or empty texts have no shingles and are their own component;
    a null doc_id gets none; rows with one doc_id count as one document; extra columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    prints = stage(fingerprints(docs), "shingle-prints")
    kinds = ["n_shingles", "f1", "f2"]
    classes = prints.where("n_shingles > 0 and doc_id is not null").groupBy(*kinds).agg(F.min("doc_id").alias("rep"))
    classes = stage(classes, "classes")
    reps = classes.select(F.col("rep").alias("doc_id"), *kinds)
    held = stage(prints.join(reps, ["doc_id", *kinds], "left_semi").select("doc_id", "n_shingles", "bands", "sketch"), "class-prints")
    blocks = connected(_near_pairs(held))
    blocks = blocks.unionByName(blocks.select(F.col("root").alias("node"), "root").distinct())
    members = held.select(F.col("doc_id").alias("node"), "n_shingles").distinct().join(blocks, "node")
    members = stage(members.groupBy("node", F.col("root").alias("block")).agg(F.sum("n_shingles").alias("n")), "members")
    tiles = stage(members.groupBy("block").agg(F.ceil(F.sum("n") / TILE).alias("tiles")), "tiles")
    texts = likely(docs.withColumnRenamed("doc_id", "node"), "node", members)
    placed = members.join(tiles, "block").withColumn("salt", F.pmod(F.xxhash64("node"), F.col("tiles")))
    first = placed.withColumn("tile", F.explode(F.expr("case when tiles > 1 and salt = 0 then sequence(1L, tiles - 1) else array(salt) end")))
    links = stage(_search(_with_text(first, texts), percent), "links")
    if not tiles.where("tiles > 1").isEmpty():
        links = _outsiders(links, placed.where("tiles > 1"), texts, percent)
    roots = connected(links)
    return (
        prints.join(classes, kinds, "left").withColumn("node", F.when(F.col("doc_id").isNotNull(), F.coalesce("rep", "doc_id")))
        .join(roots, "node", "left").select("doc_id", "n_shingles", F.coalesce("root", "node").alias("component_id"))
    )


def _with_text(placed: DataFrame, texts: DataFrame) -> DataFrame:
    return placed.select("node", "block", "tile").join(texts, "node").withColumnRenamed("node", "doc_id")


def _outsiders(links: DataFrame, placed: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Add the links between the members of a tiled block outside its largest group and all its members."""
    roots = connected(links)
    grouped = placed.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    sizes = grouped.groupBy("block", "root").agg(F.sum("n").alias("w"))
    largest = sizes.groupBy("block").agg(F.max(F.struct("w", "root"))["root"].alias("main"))
    out = stage(grouped.join(largest, "block").where("root <> main").select("node", "block", "n", "tiles", "salt"), "outsiders")
    parts = out.groupBy("block").agg(F.ceil(F.sum("n") / TILE).alias("parts"))
    out = out.join(parts, "block").withColumn("part", F.pmod(F.xxhash64("node", F.lit(1)), F.col("parts")))
    rows = out.withColumn("salt", F.explode(F.expr("sequence(0L, tiles - 1)"))).select("node", "block", "tiles", "salt", "part")
    rest = placed.join(parts, "block").withColumn("part", F.explode(F.expr("sequence(0L, parts - 1)"))).select("node", "block", "tiles", "salt", "part")
    tiled = rows.unionByName(rest).distinct().withColumn("tile", F.col("part") * F.col("tiles") + F.col("salt"))
    return links.unionByName(stage(_search(_with_text(tiled, texts), percent), "more-links"))


def one_of_each(docs: DataFrame, percent: int = 80) -> DataFrame:
    """The document with the smallest doc_id of each component, with all its columns. A row without doc_id stays; of
    rows that repeat a doc_id all stay."""
    gone = similar_documents(docs, percent).where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti")
