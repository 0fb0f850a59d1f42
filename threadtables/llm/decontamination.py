"""Benchmark passages in documents, by suffix arrays over shards of the documents."""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from threadtables.llm.textbytes import chunks, flags, grams, mix
from threadtables.session import stage

#: Digits, a-z and every byte beyond ASCII; upper case is folded before.
WORD = flags("0123456789abcdefghijklmnopqrstuvwxyz") | (np.arange(256) >= 128)
#: Test suffixes that one pass over the documents takes along (16 bytes each); a larger benchmark makes more passes.
SUFFIXES_PER_PASS = 1 << 20

MATCHES = "doc_id long, n_words long, hits array<struct<item: string, place: long, at: long, words: long>>"


def _word_prints(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for chunk in chunks(texts):
        chunk.lower()
        begin, end, first = chunk.words(WORD)
        yield chunk.first, mix(chunk.fingerprints(begin, end)), first


def test_suffixes(benchmark: DataFrame, words: int = 13) -> Iterator[dict[int, tuple]]:
    """The benchmark's suffixes in blocks of SUFFIXES_PER_PASS: by the number of words compared, their fingerprints in
    order, their items and places. An item of fewer words is one suffix, an item without words none."""
    block: dict[int, list] = defaultdict(list)
    held = 0
    for row in benchmark.where("item_id is not null").select(F.col("item_id").cast("string"), "text").toLocalIterator():
        for _, prints, first in _word_prints(pa.array([row[1]], pa.string())):
            n = min(words, len(prints))
            if n:
                places, keys = grams(prints, first, n)
                block[n].append((keys, row[0], places))
                held += len(keys)
        if held >= SUFFIXES_PER_PASS:
            yield _sorted_block(block)
            block, held = defaultdict(list), 0
    yield _sorted_block(block)


def _sorted_block(block: dict[int, list]) -> dict[int, tuple]:
    out = {}
    for n, parts in block.items():
        keys = np.concatenate([p[0] for p in parts])
        items = np.concatenate([np.full(len(p[0]), i) for i, p in enumerate(parts)])
        places = np.concatenate([p[2] for p in parts])
        order = np.argsort(keys, kind="stable")
        out[n] = (keys[order], items[order], places[order], [p[1] for p in parts])
    return out


def verbatim_matches(docs: DataFrame, benchmark: DataFrame, words: int = 13) -> DataFrame:
    """doc_id, n_words, hits: each document with its longest verbatim matches of `words` words or more.

    Every task holds shards of about a megabyte of documents. A shard's suffix array orders all its suffixes by the
    fingerprint of their first `words` words, and every test suffix is found in it by binary search. Neighbouring finds
    on one diagonal join into one match: item, its word `place` in the item, the word `at` in the document, and its
    length. Nulls, empty texts and texts without words have no match; repeated rows each get theirs; extra columns are
    ignored. Each pass takes a bounded block of test suffixes along; for several passes the rows are numbered in a
    staged table, by which their hits are put together.
    """
    blocks = test_suffixes(benchmark, words)
    block, second = next(blocks), next(blocks, None)
    if second is None:
        return _one_pass(docs.select("doc_id", "text"), block, words)
    rows = stage(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"), "rows")
    out = None
    for block in chain([block, second], blocks):
        found = stage(_one_pass(rows, block, words), "matches")
        out = found if out is None else out.unionByName(found)
    out = out.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), F.flatten(F.collect_list("hits")).alias("hits"))
    return out.drop("row")


def _one_pass(docs: DataFrame, block: dict[int, tuple], words: int) -> DataFrame:
    """The columns of `docs` with n_words and hits in place of text, the last."""
    names_kept = docs.columns[:-1]

    def search(batches):
        for batch in batches:
            texts = batch.column(len(names_kept))
            n_words = np.zeros(len(texts), np.int64)
            hits: list[list] = [[] for _ in range(len(texts))]
            for row, prints, first in _word_prints(texts):
                n_words[row:row + len(first) - 1] = np.diff(first)
                for n, (tests, items, places, names) in block.items():
                    suffixes, keys = grams(prints, first, n)
                    order = np.argsort(keys)
                    keys, suffixes = keys[order], suffixes[order]
                    low, high = np.searchsorted(keys, tests, "left"), np.searchsorted(keys, tests, "right")
                    found = np.flatnonzero(high > low)
                    if not len(found):
                        continue
                    times = (high - low)[found]
                    at = suffixes[np.repeat(low[found] - np.cumsum(times) + times, times) + np.arange(times.sum())]
                    _join_diagonals(at, np.repeat(items[found], times), np.repeat(places[found], times), n, names, first, row, hits)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(n_words), pa.array(hits, pa.list_(pa.struct([("item", pa.string()), ("place", pa.int64()), ("at", pa.int64()), ("words", pa.int64())])))],
                names=[*names_kept, "n_words", "hits"])

    return docs.mapInArrow(search, "row long, " + MATCHES if "row" in names_kept else MATCHES)


def _join_diagonals(at, item, place, n, names, first, row, hits) -> None:
    order = np.lexsort((at, at - place, item))
    at, item, place = at[order], item[order], place[order]
    text = np.searchsorted(first, at, side="right") - 1
    new = np.ones(len(at), bool)
    new[1:] = (item[1:] != item[:-1]) | (text[1:] != text[:-1]) | (at[1:] - place[1:] != at[:-1] - place[:-1]) | (at[1:] != at[:-1] + 1)
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(at)) - 1
    for h, t in zip(heads, tails, strict=True):
        hits[row + text[h]].append({"item": names[item[h]], "place": int(place[h]), "at": int(at[h] - first[text[h]]), "words": int(at[t] - at[h] + n)})


def contamination(matches: DataFrame, share: int = 20) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated (n_hit > 0 and share * n_hit >= n_words)."""

    def digest(batches):
        for batch in batches:
            hit, items, sums = [], [], []
            for hits in batch.column(2).to_pylist():
                hits = hits or []
                reached = covered = 0
                for begin, end in sorted((h["at"], h["at"] + h["words"]) for h in hits):
                    covered += max(0, end - max(begin, reached))
                    reached = max(reached, end)
                names = sorted({h["item"] for h in hits})
                hit.append(covered)
                items.append(len(names))
                sums.append(hashlib.sha256(",".join(names).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(hit, pa.int64()), pa.array(items, pa.int64()), pa.array(sums, pa.string())],
                                             names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256"])

    out = matches.mapInArrow(digest, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string")
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words")))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, words: int = 13, share: int = 20) -> DataFrame:
    """The documents that are not contaminated, with all their columns. A null doc_id is never judged and stays."""
    bad = contamination(verbatim_matches(docs, benchmark, words), share).where("contaminated").select("doc_id").distinct()
    return docs.join(bad, "doc_id", "left_anti")
