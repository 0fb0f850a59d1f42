"""Bytes of repeated passages, by prefix-free parsing: phrases between rolling-hash triggers stand for whole texts."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from threadtables.llm.textbytes import Chunk, as_long, chunks, mix
from threadtables.session import stage

#: A trigger is the least hash of TRIGGER bytes among SPREAD neighbouring places, so that every passage has one.
TRIGGER, SPREAD = 16, 128
#: Bits of the filter that keeps phrases of unrepeated cores at home: 8 MB however long the corpus. A full filter only
#: lets more phrases through.
FILTER_BITS = 1 << 26


@dataclass
class Phrases:
    """Phrases of a chunk. `trigger` is a place; strings that start in first..last have it as their trigger; all of
    them hold the core, and together they are the text."""

    row: np.ndarray
    trigger: np.ndarray
    first: np.ndarray
    last: np.ndarray
    core: np.ndarray
    text: np.ndarray


def parse(chunk: Chunk, length: int) -> Phrases:
    """Cut a chunk into phrases. The trigger of a string depends on its own bytes alone, so equal strings of `length`
    bytes have equal cores at equal distance."""
    n = len(chunk.data)
    none = np.zeros(0, np.int64)
    if n < length:
        return Phrases(none, none, none, none, none.view(np.uint64), none.view(np.uint64))
    at = np.arange(n - TRIGGER + 1)
    least = mix(chunk.fingerprints(at, at + TRIGGER)) >> np.uint64(32) << np.uint64(32) | at.astype(np.uint64)
    k = 1
    while k < SPREAD:
        least = np.minimum(least[:-k], least[k:])
        k *= 2
    row = np.repeat(np.arange(len(chunk)), np.diff(chunk.starts))[:len(least)]
    start = np.flatnonzero(at[:len(least)] + length <= chunk.starts[row + 1])
    trigger = (least[start] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.ones(len(start), bool)
    new[1:] = trigger[1:] != trigger[:-1]
    head = np.flatnonzero(new)
    trigger, first, last = trigger[head], start[head], start[np.append(head[1:], len(start)) - 1] if len(head) else none
    core = mix(chunk.fingerprints(trigger, trigger + length - SPREAD + 1))
    text = mix(chunk.fingerprints(first, last + length) + ((trigger - first) * 256 + trigger - last).astype(np.uint64))
    return Phrases(row[first], trigger, first, last, core, text)


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows by doc_id and `crc`, 64 bits of the text and of whether the id is null, so that rows that repeat a doc_id or
    have none stay apart."""
    doc = F.col("doc_id").cast("long")
    return docs.select(F.coalesce(doc, F.lit(0)).alias("id"), F.xxhash64(doc.isNull(), "text").alias("crc"), F.coalesce("text", F.lit("")).alias("text"), doc.alias("doc_id"))


def _bits(core: np.ndarray) -> list[np.ndarray]:
    return [(core >> np.uint64(s)).astype(np.int64) & (FILTER_BITS - 1) for s in (0, 37)]


def _repeated_cores(keyed: DataFrame, length: int) -> np.ndarray:
    """A filter of the cores that occur more than once."""

    def cores(batches):
        for batch in batches:
            for chunk in chunks(batch.column(0)):
                yield pa.RecordBatch.from_arrays([pa.array(as_long(parse(chunk, length).core))], names=["core"])

    seen = keyed.select("text").mapInArrow(cores, "core long").groupBy("core").count().where("count > 1")
    place = F.explode(F.array(*(F.shiftrightunsigned("core", s).bitwiseAND(F.lit(FILTER_BITS - 1)) for s in (0, 37)))).alias("place")
    parts = seen.select(place).groupBy(F.shiftright("place", 15).alias("part")).agg(
        F.bitmap_construct_agg(F.col("place").bitwiseAND(F.lit(32767))).alias("bits")).collect()
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in parts:
        out[r["part"] * 4096:(r["part"] + 1) * 4096] = np.frombuffer(r["bits"], np.uint8)
    return out


def _repeated_phrases(keyed: DataFrame, length: int, known) -> DataFrame:
    """id, crc, core, text, first, last, trigger of the phrases whose core the filter knows; places within the row."""

    def phrases(batches):
        bits = known.value
        for batch in batches:
            ids, crcs = batch.column(0), batch.column(1)
            for chunk in chunks(batch.column(2)):
                p = parse(chunk, length)
                hit = np.ones(len(p.core), bool)
                for b in _bits(p.core):
                    hit &= (bits[b >> 3] >> (b & 7) & 1).astype(bool)
                row = pa.array(p.row[hit] + chunk.first)
                begin = chunk.starts[p.row[hit]]
                yield pa.RecordBatch.from_arrays(
                    [ids.take(row), crcs.take(row), pa.array(as_long(p.core[hit])), pa.array(as_long(p.text[hit])),
                     *(pa.array(x[hit] - begin) for x in (p.first, p.last, p.trigger))],
                    names=["id", "crc", "core", "text", "first", "last", "trigger"])

    return keyed.mapInArrow(phrases, "id long, crc long, core long, text long, first long, last long, trigger long")


def _packed(keyed: DataFrame) -> DataFrame:
    """Texts compressed before they are shuffled."""

    def pack(batches):
        squeeze = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            texts = [squeeze.compress(t.as_buffer()) for t in batch.column(2).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.binary()), batch.column(3)], names=["id", "crc", "packed", "doc_id"])

    return keyed.mapInArrow(pack, "id long, crc long, packed binary, doc_id long")


def _strings(packed: DataFrame, edges: DataFrame, length: int) -> DataFrame:
    """id, crc, start, core, string: the single strings of the phrases in `edges`."""

    def cut(batches):
        open_up = zstandard.ZstdDecompressor()
        for batch in batches:
            ids, crcs, spans = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3).to_pylist()
            for i, packed_text in enumerate(batch.column(2).to_pylist()):
                data = np.frombuffer(open_up.decompress(packed_text), np.uint8)
                chunk = Chunk(0, data, np.array([0, len(data)]))
                runs = np.array([(s["first"], s["last"], s["core"]) for s in spans[i]], np.int64)
                n = runs[:, 1] - runs[:, 0] + 1
                start = np.repeat(runs[:, 0] - np.cumsum(n) + n, n) + np.arange(n.sum())
                string = mix(chunk.fingerprints(start, start + length))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[i]] * len(start), pa.int64()), pa.array([crcs[i]] * len(start), pa.int64()), pa.array(start),
                     pa.array(as_long(mix(string ^ np.repeat(runs[:, 2], n).view(np.uint64)))), pa.array(as_long(string))],
                    names=["id", "crc", "start", "core", "string"])

    lists = edges.groupBy("id", "crc").agg(F.collect_list(F.struct("first", "last", "core")).alias("spans"))
    return packed.join(lists, ["id", "crc"]).select("id", "crc", "packed", "spans").mapInArrow(cut, "id long, crc long, start long, core long, string long")


def repeated_spans(docs: DataFrame, length: int = 400) -> DataFrame:
    """id, crc, runs: for each document (see _keyed) the first and last starts of strings of `length` bytes that start
    elsewhere too.

    1. Every text is parsed into phrases at rolling-hash triggers. A string lies in one phrase and is told apart by the
       phrase's core, its distance from the trigger and the bytes beyond; so the dictionary of phrases and their order
       in the corpus stand for its suffixes, to a depth of `length` bytes.
    2. Phrases with a core of their own are dropped. Where a whole phrase repeats, all its strings do.
    3. What is left are phrases at the edges of repeats; their strings are compared one by one, with one phrase of each
       kind that shares the core.
    Groups are counted before they are shuffled and joined by key, so a passage may be in any number of documents.
    """
    keyed = _keyed(docs)
    known = docs.sparkSession.sparkContext.broadcast(_repeated_cores(keyed, length))
    hits = stage(_repeated_phrases(keyed, length, known), "phrases")
    kinds = hits.groupBy("core", "text").agg(F.count("*").alias("n"), *(F.first(c).alias(c) for c in ("id", "crc", "first", "last")))
    kinds = stage(kinds, "phrase-kinds")
    cores = kinds.groupBy("core").agg(F.sum("n").alias("all"), F.min("n").alias("least")).where("all > 1 and least = 1").select("core")
    whole = hits.join(kinds.where("n > 1").select("core", "text"), ["core", "text"], "left_semi").select("id", "crc", "first", "last")
    edges = kinds.join(cores, "core", "left_semi").select("id", "crc", "first", "last", "core")
    strings = _strings(_packed(keyed.where(F.octet_length("text") >= length)), edges, length)
    again = strings.groupBy("core", "string").count().where("count > 1").select("core", "string")
    single = strings.join(again, ["core", "string"], "left_semi").select("id", "crc", F.col("start").alias("first"), F.col("start").alias("last"))
    single = stage(single, "edge-strings")
    return whole.unionByName(single).groupBy("id", "crc").agg(F.collect_list(F.struct("first", "last")).alias("runs"))


def remove_repeats(docs: DataFrame, length: int = 400) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept: every document without the bytes of its repeated strings.

    Overlapping strings remove their union, judged on the input; the first occurrence goes as well. Texts are UTF-8
    bytes; null is empty; texts under `length` bytes keep all. Repeated rows repeat each other. `kept` is binary, since
    a cut may split a character. Extra columns are ignored.
    """
    spans = stage(repeated_spans(docs, length), "spans")

    def cut(batches):
        open_up = zstandard.ZstdDecompressor()
        for batch in batches:
            sizes, gone, n_spans, kept = [], [], [], []
            for packed, runs in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                data = open_up.decompress(packed)
                left, at, count = [], 0, 0
                for first, last in sorted((r["first"], r["last"]) for r in runs or []):
                    if count == 0 or first > at:
                        left.append(data[at:first])
                        count += 1
                        at = last + length
                    at = max(at, last + length)
                left.append(data[at:])
                text = b"".join(left)
                sizes.append(len(data))
                gone.append(len(data) - len(text))
                n_spans.append(count)
                kept.append(text)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(kept, pa.binary())],
                                             names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    rows = _packed(_keyed(docs)).join(spans, ["id", "crc"], "left").select("doc_id", "packed", "runs")
    return rows.mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def digest(removed: DataFrame) -> DataFrame:
    return removed.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
