"""Documents packed into token sequences of one length: length patterns fitted by non-negative least squares."""

from __future__ import annotations

import bisect
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from threadtables.llm.ranks import group_slots
from threadtables.session import stage

#: Ids of so many words, and of so many bytes of words and ids together, are kept in a worker at most.
CACHED_WORDS, CACHED_BYTES = 100_000, 1 << 23
#: Texts tokenized together.
_ROWS = 256


#: Fixed value: where this vocabulary parts a text before its pairs are merged.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _token_bytes(vocabulary: dict[str, int]) -> dict[bytes, int]:
    """Tokens as bytes: the file writes each byte as one character, printable ones as themselves and the rest from
    U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    return {bytes(of[c] for c in token): i for token, i in vocabulary.items() if all(c in of for c in token)}


class _Words:
    """Ids of whole texts by byte-level BPE. The pattern always starts a token at a blank that stands before a visible
    character, so the words between such blanks are encoded once each and joined. Merges are ranked by their ids, which
    lets the faster of the two installed libraries give the ids of the other. A text that holds an added token of the
    file is left to the tokenizer itself, which knows it there."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.added = {t.content for t in self.model.get_added_tokens_decoder().values()}
        ranks = _token_bytes({t: i for t, i in self.model.get_vocab().items() if t not in self.added})
        self.encode = tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, bytes] = {}
        self.bytes = 0

    def _ids(self, text: str) -> bytes:
        return np.array(self.encode(text), "<u4").tobytes()

    def ids(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        out = []
        for text in texts:
            if any(a in text for a in self.added):
                out.append(np.array(self.model.encode(text, add_special_tokens=False).ids, "<u4").tobytes())
                continue
            if len(self.known) > CACHED_WORDS or self.bytes > CACHED_BYTES:
                self._forget()
            parts = _BLANK.split(text) if _LONE_BLANK.search(text) else text.split(" ")
            head = self._ids(parts[0])
            rest = parts[1:]
            for word in set(rest).difference(self.known):
                own = self.known[word] = self._ids(" " + word)
                self.bytes += len(word) + len(own)
            out.append(head + b"".join(map(self.known.__getitem__, rest)))
        return out


_loaded: dict[str, _Words] = {}


def _words(path: str) -> _Words:
    """Loaded once in each worker."""
    if path not in _loaded:
        _loaded[path] = _Words(path)
    return _loaded[path]


_BLANK = re.compile(r" (?=\S)")
_LONE_BLANK = re.compile(r" (?!\S)")


def token_pieces(docs: DataFrame, tokenizer: str, length: int = 2048, end: int = 0, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids): each document's ids and `end`, cut if longer than `length`.

    The first piece of a cut document takes the remainder. `tokenizer` is a file every executor can read.
    """
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else "")
    closing = np.array([end], "<u4").tobytes()

    def cut(batches):
        words = _words(tokenizer)
        for batch in batches:
            for k in range(0, batch.num_rows, _ROWS):
                part = batch.slice(k, _ROWS)
                rows = []
                for doc, ids in zip(part.column(0).to_pylist(), words.ids(part.column(1).to_pylist()), strict=True):
                    ids += closing
                    n = len(ids) // 4
                    at, to = 0, n % length or length
                    while at < n:
                        own = ids[4 * at:4 * to]
                        rows.append((doc, -(-at // length), at, to - at, zlib.crc32(own), own))
                        at, to = to, to + length
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()][:6 if with_ids else 5]
                columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"][:len(columns)])

    return docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(cut, schema)


def few_document_patterns(units: int) -> list[tuple[int, ...]]:
    """One to three lengths that fill a sequence of so many units."""
    found: list[tuple[int, ...]] = [(units,)]
    for a in range(1, units // 2 + 1):
        found.append((units - a, a))
    for a in range(1, units // 3 + 1):
        for b in range(a, (units - a) // 2 + 1):
            found.append((units - a - b, b, a))
    return found


def nnls(patterns: list[tuple[int, ...]], goal: np.ndarray) -> np.ndarray:
    """Repeat counts x >= 0 of the patterns that bring their lengths nearest to `goal` (index 0 is unused), by the
    active-set method; only few of them are above 0. It ends where no pattern could win half a document any more, or
    after four rounds for each length."""
    columns = np.zeros((len(patterns), 3), np.int64)
    for i, p in enumerate(patterns):
        columns[i, :len(p)] = p
    a = lambda i: np.bincount(columns[i], minlength=len(goal))
    used: list[int] = []
    x = np.zeros(0)
    matrix = np.zeros((len(goal), 0))
    goal = goal.astype(float)
    goal[0] = 0
    rest = goal.copy()
    for _ in range(4 * len(goal)):
        slope = rest[columns].sum(axis=1)
        slope[used] = -1
        best = int(np.argmax(slope))
        if slope[best] <= 0.5:
            break
        used.append(best)
        column = a(best).astype(float)
        column[0] = 0
        matrix = np.column_stack([matrix, column])
        x = np.append(x, 0.0)
        while True:
            gram = matrix.T @ matrix
            free = np.linalg.solve(gram + 1e-9 * np.eye(len(gram)), matrix.T @ goal)
            if free.min() > 0:
                x = free
                break
            low = free <= 0
            step = (x[low] / np.maximum(x[low] - free[low], 1e-300)).min()
            x = x + step * (free - x)
            keep = x > 1e-12
            used, x, matrix = [u for u, k in zip(used, keep, strict=True) if k], x[keep], matrix[:, keep]
            if not len(x):
                break
        rest = goal - matrix @ x
    out = np.zeros(len(patterns))
    out[used] = x
    return out


def plan(histogram: dict[int, int], length: int = 2048, unit: int = 8) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of document lengths and how often each is used, for all documents of the histogram.

    Lengths are rounded up to units, patterns of one to three are fitted to their histogram, and the counts are rounded
    down. What they leave goes longest first into the sequence with the least room that is enough, gaps of the fitted
    patterns included. Its work depends on the number of different lengths, not of documents.
    """
    left = {n: k for n, k in histogram.items() if k > 0}
    open_by_gap: dict[int, list[list]] = defaultdict(list)
    gaps: list[int] = []

    def put(items: tuple[int, ...], times: int) -> None:
        gap = length - sum(items)
        if gap not in open_by_gap or not open_by_gap[gap]:
            if gap not in open_by_gap:
                bisect.insort(gaps, gap)
        open_by_gap[gap].append([items, times])

    if length in left:
        put((length,), left.pop(length))
    units = length // unit
    goal = np.zeros(units + 1)
    held: dict[int, list[int]] = defaultdict(list)  # lengths of a unit, the longest first
    for n in sorted(left, reverse=True):
        goal[-(-n // unit)] += left[n]
        held[-(-n // unit)].append(n)
    patterns = [p for p in few_document_patterns(units) if all(goal[u] for u in p)]
    if patterns and goal.sum() >= units:
        for p, times in zip(patterns, np.floor(nnls(patterns, goal) + 1e-6).astype(int), strict=True):
            while times > 0 and all(len(held[u]) for u in p):
                items = tuple(held[u][0] for u in p)
                uses = {n: items.count(n) for n in items}
                k = min([times, *(left[n] // c for n, c in uses.items())])
                if k:
                    put(items, k)
                    times -= k
                for n, c in uses.items():
                    left[n] -= c * k
                    if left[n] < c:
                        held[-(-n // unit)].remove(n)
        # a length left too rare for a double pattern stays in `left` for the next step
    for n in sorted((n for n, k in left.items() if k > 0), reverse=True):
        k = left[n]
        while k:
            i = bisect.bisect_left(gaps, n)
            while i < len(gaps) and not open_by_gap[gaps[i]]:
                i += 1
            if i == len(gaps):
                each = length // n
                if k >= each:
                    put((n,) * each, k // each)
                    k %= each
                if k:
                    put((n,) * k, 1)
                    k = 0
                break
            items, times = open_by_gap[gaps[i]].pop()
            fits = min(gaps[i] // n, max(1, -(-k // times)))
            whole = min(times, k // fits)
            put(items + (n,) * fits, whole) if whole else None
            k -= whole * fits
            if times > whole:
                put(items, times - whole)
                if not whole:
                    items, times = open_by_gap[length - sum(items)].pop()
                    put(items + (n,) * k, 1)
                    if times > 1:
                        put(items, times - 1)
                    k = 0
    return [(items, times) for g in open_by_gap.values() for items, times in g]


def _places(patterns: list[tuple[tuple[int, ...], int]]) -> tuple[np.ndarray, ...]:
    """For each length the rank from which a pattern takes its documents, its first sequence and their offset."""
    taken: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for items, times in patterns:
        at = 0
        for n in items:
            rows.append((n, taken[n], sequence, at))
            taken[n] += times
            at += n
        sequence += times
    rows.sort()
    return tuple(np.array([r[i] for r in rows], np.int64) for i in range(4))


def pack(docs: DataFrame, tokenizer: str, length: int = 2048, end: int = 0) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: every piece of every document in a sequence.

    The driver gets the histogram of piece lengths, `length` rows at most, and plans patterns for it. Pieces of equal
    length are interchangeable, so each is ranked within its length and finds its pattern, sequence and offset from
    the rank alone. Null and empty texts are the end id alone; repeated rows are packed each; no rows give none; other
    columns are ignored.
    """
    pieces = stage(token_pieces(docs, tokenizer, length, end), "pieces")
    ranked = group_slots(pieces, ["length"], ["doc_id", "piece"], "rank")
    histogram = {r["length"]: r["count"] for r in ranked.groupBy("length").count().collect()}
    lengths, ranks, sequences, offsets = _places(plan(histogram, length))
    keys = (lengths << 44) + ranks

    def place(batches):
        for batch in batches:
            n, rank = (batch.column(i).to_numpy(zero_copy_only=False) for i in (3, 5))
            i = np.searchsorted(keys, (n << 44) + rank, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in range(5)), pa.array(sequences[i] + rank - ranks[i]), pa.array(offsets[i])],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    rows = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank")
    return rows.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def sequences(docs: DataFrame, packed: DataFrame, tokenizer: str, length: int = 2048, end: int = 0) -> DataFrame:
    """sequence_id, ids (little-endian unsigned 32-bit): the packed sequences themselves. doc_id must be unique."""
    pieces = token_pieces(docs, tokenizer, length, end, with_ids=True).select("doc_id", "piece", "ids")
    rows = packed.select("doc_id", "piece", "sequence_id", "offset").join(pieces, ["doc_id", "piece"])
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return rows.groupBy("sequence_id").agg(parts.alias("parts")).select("sequence_id", F.aggregate("parts.ids", F.lit(b""), lambda x, y: F.concat(x, y)).alias("ids"))
