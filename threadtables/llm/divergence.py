"""How the sources of each language differ in their words, from stripes that each partition folds and Spark merges."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from threadtables.llm.textbytes import Chunk, chunks, flags, mix, rows_of
from threadtables.session import stage

#: Terms are of A-Z, a-z and every character beyond ASCII.
_TERM = flags("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ") | (np.arange(256) >= 128)
#: Cells, and bytes of their terms, that a task holds before it spills them.
HELD_CELLS, HELD_BYTES = 1_000_000, 1 << 26
#: Terms times sources that one task compares at a time.
TILE = 1 << 22
#: Parts of one: shares are whole numbers of them.
ONE = 1_000_000_000
#: Added to each count.
PRIOR = 5
_FOLD_BYTES, _SPILL_ROWS = 1 << 22, 1 << 16
_CELL = ["lang", "source", "term", "n_docs", "n"]


class _Stripes:
    """Stripes of terms to documents and occurrences in each source, held as arrays that are sorted by the hash of
    (lang, term) and then by source when they are folded together."""

    def __init__(self, most: int):
        self.most = most
        self.groups: dict[tuple[str, str], int] = {}
        self.langs: dict[str, int] = {}
        self._clear()

    def _clear(self) -> None:
        self.held: list[tuple[np.ndarray, ...]] = []
        self.cells = self.bytes = 0

    def add(self, chunk: Chunk, pairs: list[tuple[str, str]]) -> None:
        """Fold the documents of a chunk; `pairs`: lang and source of each."""
        number = [self.groups.setdefault(p, len(self.groups)) for p in pairs]
        lang = [self.langs.setdefault(p[0], len(self.langs)) for p in pairs]
        chunk.lower()
        begin, end, first = chunk.words(_TERM)
        if not len(begin):
            return
        row = rows_of(first)
        stripe = mix(chunk.fingerprints(begin, end) + np.array(lang, np.uint64)[row] * np.uint64(0xD6E8FEB86659FD93))
        group = np.array(number)[row]
        key = stripe + group.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        order = np.argsort(key, kind="stable")
        key, row = key[order], row[order]
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        document = new.copy()
        document[1:] |= row[1:] != row[:-1]
        head = np.flatnonzero(new)
        at = order[head]
        text, size = _cut(chunk.data, begin[at], end[at])
        self.held.append((stripe[at], group[at], np.add.reduceat(document.astype(np.int64), head), np.diff(np.append(head, len(key))), size, text))
        self.cells += len(at)
        self.bytes += len(text)

    def full(self) -> bool:
        return self.cells >= self.most or self.bytes >= HELD_BYTES

    def spill(self) -> Iterator[pa.RecordBatch]:
        if not self.cells:
            return
        stripe, group, n_docs, n, size, text = (np.concatenate([h[k] for h in self.held]) for k in range(6))
        self._clear()
        order = np.argsort(group, kind="stable")
        order = order[np.argsort(stripe[order], kind="stable")]
        stripe, group = stripe[order], group[order]
        new = np.ones(len(order), bool)
        new[1:] = (stripe[1:] != stripe[:-1]) | (group[1:] != group[:-1])
        head = np.flatnonzero(new)
        n_docs, n = np.add.reduceat(n_docs[order], head), np.add.reduceat(n[order], head)
        end = np.cumsum(size)
        begin = (end - size)[order[head]]
        end, group = end[order[head]], group[head]
        langs, sources = (pa.array([p[k] for p in self.groups], pa.string()) for k in (0, 1))
        for k in range(0, len(head), _SPILL_ROWS):
            part = slice(k, k + _SPILL_ROWS)
            data, sizes = _cut(text, begin[part], end[part])
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            terms = pa.StringArray.from_buffers(len(sizes), pa.py_buffer(offsets), pa.py_buffer(data))
            of = pa.array(group[part])
            yield pa.RecordBatch.from_arrays([langs.take(of), sources.take(of), terms, pa.array(n_docs[part]), pa.array(n[part])], names=_CELL)

    def named(self) -> pa.RecordBatch:
        """A row without term for each group."""
        langs, sources = (pa.array([p[k] for p in self.groups], pa.string()) for k in (0, 1))
        none = pa.array(np.zeros(len(self.groups), np.int64))
        return pa.RecordBatch.from_arrays([langs, sources, pa.nulls(len(self.groups), pa.string()), none, none], names=_CELL)


def _cut(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the given spans end to end, and their sizes."""
    size = end - begin
    if size.sum() > 4 * _FOLD_BYTES:  # very long terms are copied as they are
        return np.concatenate([data[b:e] for b, e in zip(begin, end, strict=True)]), size
    return data[np.repeat(begin - np.cumsum(size) + size, size) + np.arange(size.sum())], size


def stripes(docs: DataFrame, held_cells: int = HELD_CELLS) -> DataFrame:
    """lang, source, term, n_docs, n: the cells of each partition's stripes, to be added up by key.

    A document is folded whole, so it counts once in n_docs of each of its terms. A row without term names each group
    that occurs. What a task holds is bounded; beyond it is spilled, and a term may come again.
    """

    def fold(batches):
        held = _Stripes(held_cells)
        for batch in batches:
            pairs = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
            for chunk in chunks(batch.column(2), _FOLD_BYTES):
                held.add(chunk, pairs[chunk.first:chunk.first + len(chunk)])
                if held.full():
                    yield from held.spill()
        yield from held.spill()
        yield held.named()

    named = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")]
    return docs.select(*named).mapInArrow(fold, "lang string, source string, term string, n_docs long, n long")


def share(count: np.ndarray, total: np.ndarray | int, terms: int) -> np.ndarray:
    """1 + floor(ONE * (count + PRIOR) / (total + PRIOR * terms)) by long division, exact below 9e15 occurrences."""
    below = np.asarray(total, np.int64) + PRIOR * terms
    rest, out = count + PRIOR, np.zeros(np.broadcast(count, below).shape, np.int64)
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // below
        rest = rest % below
    return 1 + out


def _compare(top: int):
    """Divergences of one tile: its terms' merged stripes against all sources of the language."""

    def tile(left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.sort_by("source")
        lang, sources = right.column("lang")[0].as_py(), right.column("source").combine_chunks()
        v, lang_total = right.column("v")[0].as_py(), right.column("lang_n")[0].as_py()
        totals = right.column("n").to_numpy()
        left = left.sort_by("term")
        terms, stripe = left.column("term").combine_chunks(), left.column("stripe").combine_chunks()
        cells = stripe.flatten()
        term_of = np.repeat(np.arange(len(stripe)), pc.list_value_length(stripe).to_numpy(zero_copy_only=False))
        count = np.zeros((len(terms), len(sources)), np.int64)
        count[term_of, pc.index_in(cells.field("source"), value_set=sources).to_numpy(zero_copy_only=False)] = cells.field("n").to_numpy()
        own, whole = share(count, totals[None, :], v), share(count.sum(axis=1), lang_total, v)
        source, part, item, value = [], [], [], []
        for i in range(len(sources)):
            others = np.delete(np.arange(len(sources)), i)
            apart = np.abs(own - own[:, i:i + 1]).sum(axis=0)[others]
            # the terms stand in UTF-8 order, which a stable sort keeps among ties
            more = np.flatnonzero((count[:, i] > 0) & (own[:, i] > whole))
            more = more[np.argsort(whole[more] - own[more, i], kind="stable")[:top]]
            for kind, names, figures in (("pair", sources.take(pa.array(others)), apart), ("term", terms.take(pa.array(more)), own[more, i] - whole[more])):
                source.append(pa.repeat(sources[i], len(names)))
                part.append(pa.repeat(pa.scalar(kind), len(names)))
                item.append(names)
                value.append(pa.array(figures, pa.int64()))
        source, part, item, value = (pa.concat_arrays(x) for x in (source, part, item, value))
        return pa.table({"lang": pa.repeat(pa.scalar(lang, pa.string()), len(source)), "source": source, "part": part, "item": item, "value": value})

    return tile


def divergences(docs: DataFrame, least_docs: int = 30, top: int = 50) -> DataFrame:
    """lang, source, part, item, value, rank: sources that differ (`pair`) and the `top` terms each uses more (`term`).

    A language keeps the terms of `least_docs` of its documents or more. With V of them, a group (lang, source) with N
    occurrences gives each the share p (see `share`), the whole language q. `pair`: for each other source of the
    language the sum of |p - p'| over the kept terms, 0 without any. `term`: kept terms of the group with p > q, valued
    p - q. Ranks go by value, then by the item's UTF-8 bytes.

    Partitions fold documents into stripes and spill cells; these are added up by (lang, source, term) before and after
    the shuffle and laid together as one stripe for each kept term, of one entry a source at most. A tile of terms times
    sources is compared at a time, and only sums and its `top` terms leave it, so no term or language meets in one task.
    Null text, lang and source are ''; texts without terms still name their group; repeated rows count each; extra
    columns are ignored; no rows give none.
    """
    merged = stage(stripes(docs).groupBy("lang", "source", "term").agg(F.sum("n_docs").alias("n_docs"), F.sum("n").alias("n")), "stripe-cells")
    kept = merged.where("term is not null").groupBy("lang", "term").agg(
        F.sum("n_docs").alias("n_docs"), F.collect_list(F.struct("source", "n")).alias("stripe")).where(F.col("n_docs") >= least_docs)
    kept = stage(kept.drop("n_docs"), "stripes")
    used = kept.select("lang", F.inline("stripe")).groupBy("lang", "source").agg(F.sum("n").alias("n"))
    groups = merged.where("term is null").select("lang", "source").join(used, ["lang", "source"], "left").na.fill(0, ["n"])
    groups = stage(groups, "groups")
    langs = groups.groupBy("lang").agg(F.count("*").alias("sources"), F.sum("n").alias("lang_n"))
    langs = langs.join(kept.groupBy("lang").agg(F.count("*").alias("v")), "lang", "left").na.fill(0, ["v"])
    langs = stage(langs.withColumn("tiles", F.greatest(F.lit(1), F.ceil(F.col("v") * F.col("sources") / TILE))), "langs")
    left = kept.join(langs.select("lang", "tiles"), "lang").select("lang", F.pmod(F.xxhash64("term"), F.col("tiles")).alias("tile"), "term", "stripe")
    right = groups.join(langs, "lang").select("lang", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)).alias("tile"), "source", "n", "v", "lang_n")
    found = left.groupBy("lang", "tile").cogroup(right.groupBy("lang", "tile")).applyInArrow(
        _compare(top), "lang string, source string, part string, item string, value long")
    found = stage(found, "divergences")
    pairs = found.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    place = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    ranked = pairs.unionByName(found.where("part = 'term'")).withColumn("rank", place)
    return ranked.where((F.col("part") == "pair") | (F.col("rank") <= top))
