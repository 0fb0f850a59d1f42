"""Texts rearranged for fill-in-the-middle training, cut by a sparse index of their multibyte characters."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from threadtables.llm.textbytes import chunks, flags

#: What stands before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Words end at a blank or at \t \n \v \f \r.
_WORD = flags(" \t\n\x0b\x0c\r", among=False)
_BLANK = ~_WORD


class SparseIndex:
    """Where a UTF-8 text departs from one byte a character: the places of its multibyte characters, in bytes and in
    code points, and the running sum of their excess bytes. Between them both places differ by a constant, so a cut is
    converted by one search and one addition; an ASCII text has an empty index."""

    def __init__(self, data: np.ndarray):
        self.at_byte = np.flatnonzero(data >= 0xC0)
        lead = data[self.at_byte]
        each = 1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
        self.excess = np.concatenate([np.zeros(1, np.int64), np.cumsum(each)])
        self.at_point = self.at_byte - self.excess[:-1]

    def points(self, cuts: np.ndarray) -> np.ndarray:
        """Code points before each byte cut; a cut lies between characters."""
        return cuts - self.excess[np.searchsorted(self.at_byte, cuts)]

    def bytes(self, cuts: np.ndarray) -> np.ndarray:
        """Bytes before each code-point cut."""
        return cuts + self.excess[np.searchsorted(self.at_point, cuts)]


def dice(doc_id: int | None, seed: int) -> tuple[int, int, int, int]:
    """The first four 32-bit numbers of the sha256 of `seed:doc_id`; a null id adds nothing after the colon."""
    drawn = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(drawn[k:k + 4], "big") for k in (0, 4, 8, 12))


def fill_in_middle(docs: DataFrame, seed: int = 42, share: int = 50, suffix_first: int = 80, unit: str = "word",
                   marks: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output: every text as it is (plain) or as prefix, suffix and middle.

    A text has n units: words with the blanks before them and blanks at the end (`unit="word"`), or code points
    (`unit="char"`). The dice of a doc_id cut it after two numbers of units, leave 100 - `share` percent of the texts
    plain and write `suffix_first` percent of the others suffix first (spm), the rest prefix first (psm). Empty texts
    and texts that hold a mark stay plain, so `restore` always gives the text back. A null text is empty. Repeated rows
    each get the same result; extra columns are ignored.
    """
    if unit not in ("word", "char"):
        raise ValueError("unit is word or char")
    p, s, m = (x.encode() for x in marks)

    def cut(batches):
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for chunk in chunks(batch.column(1)):
                _, ends, first = chunk.words(_WORD)
                rows = []
                for i in range(len(chunk)):
                    begin, end = chunk.starts[i], chunk.starts[i + 1]
                    own = chunk.data[begin:end]
                    text = own.tobytes()
                    words = first[i + 1] - first[i]
                    h1, h2, h3, h4 = dice(ids[chunk.first + i], seed)
                    index = SparseIndex(own)
                    if unit == "char":
                        n = int(index.points(np.array([len(own)]))[0])
                    else:
                        n = int(words + (1 if text and _BLANK[own[-1]] else 0))
                    if not text or p in text or s in text or m in text or h3 % 100 >= share:
                        rows.append((n, "plain", None, None, text))
                        continue
                    units = np.array(sorted((h1 % (n + 1), h2 % (n + 1))))
                    if unit == "char":
                        points, at = units, index.bytes(units)
                    else:
                        at = np.array([0 if u == 0 else ends[first[i] + u - 1] - begin if u <= words else len(own) for u in units])
                        points = index.points(at)
                    head, middle, tail = text[:at[0]], text[at[0]:at[1]], text[at[1]:]
                    spm = h4 % 100 < suffix_first
                    output = b"".join((s, tail, p, head, m, middle) if spm else (p, head, s, tail, m, middle))
                    rows.append((n, "spm" if spm else "psm", int(points[0]), int(points[1] - points[0]), output))
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
                columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(chunk.first, len(chunk)), *columns],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        cut, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restore(output: str = "output", form: str = "form", marks: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)) -> Column:
    """The text that `fill_in_middle` rearranged. No mark can overlap itself, so each first hit is the one written."""
    p, s, m = marks

    def parted(first: str, second: str) -> tuple[Column, Column, Column]:
        """What follows the first, second and third mark."""
        rest = F.substr(F.col(output), F.lit(len(first) + 1))
        one = F.substring_index(rest, second, 1)
        rest = F.substr(rest, F.length(one) + len(second) + 1)
        two = F.substring_index(rest, m, 1)
        return one, two, F.substr(rest, F.length(two) + len(m) + 1)

    suffix, prefix, middle = parted(s, p)
    prefix2, suffix2, middle2 = parted(p, s)
    return (
        F.when(F.col(form) == "spm", F.concat(prefix, middle, suffix))
        .when(F.col(form) == "psm", F.concat(prefix2, middle2, suffix2)).otherwise(F.col(output))
    )


def digest(cut: DataFrame) -> DataFrame:
    return cut.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(restore(), 256).alias("restored_sha256"))
