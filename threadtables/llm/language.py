"""Language of a text by error-correcting output codes over byte n-grams."""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from threadtables.llm.textbytes import chunks

#: Three neighbouring bytes of the lower-cased text fall into one of so many features.
FEATURES = 4096
#: Bits of a codeword where there are too many languages for all bipartitions.
BITS = 31
#: Documents of each language whose bits are tried out to weigh the decoding.
TRIED = 2_000
#: Below this lead over the second nearest codeword, as a share of the loss, a text is ambiguous.
LEAD = 0.1


def codewords(n: int) -> np.ndarray:
    """A row of -1 and 1 for each of n languages: all ways to part them for up to five, else the best of many draws."""
    if n <= 5:
        columns = [c for c in itertools.product((1, -1), repeat=n) if c[0] == 1 and -1 in c]
        return np.array(columns, np.int8).T.reshape(n, -1)
    rng = np.random.default_rng(n)
    best, most = None, -1.0
    for _ in range(200):
        code = rng.choice(np.array([-1, 1], np.int8), (n, BITS))
        code[:, np.abs(code.sum(axis=0)) == n] *= np.where(np.arange(n) % 2, 1, -1)[:, None].astype(np.int8)
        apart = min((code[i] != code[j]).sum() for i in range(n) for j in range(i))
        if apart > most:
            best, most = code, apart
    return best


def _profiles(texts: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """First row, and the n-gram counts of some rows."""
    for chunk in chunks(texts, rows=512):
        d = chunk.data.astype(np.uint32)
        if len(d) < 3:
            yield chunk.first, np.zeros((len(chunk), FEATURES))
            continue
        gram = (d[:-2] << 16 | d[1:-1] << 8 | d[2:]) * np.uint32(2654435761) >> np.uint32(20)
        row = np.repeat(np.arange(len(chunk)), np.diff(chunk.starts))
        inside = row[:-2] == row[2:]
        flat = np.bincount(row[:-2][inside] * FEATURES + gram[inside], minlength=len(chunk) * FEATURES)
        yield chunk.first, flat.reshape(len(chunk), FEATURES)


@dataclass
class Model:
    """`weights`: features x bits, the evidence of a feature for a bit. `trust`: languages x bits, from 0 to 1."""

    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    trust: np.ndarray

    def margins(self, counts: np.ndarray) -> np.ndarray:
        return counts @ self.weights / np.sqrt(np.maximum(counts.sum(axis=1), 1))[:, None]

    def losses(self, counts: np.ndarray) -> np.ndarray:
        """For each text and language the weighted logistic loss of its codeword's bits."""
        signed = np.clip(self.margins(counts)[:, None, :] * self.code[None], -30, 30)
        return (np.logaddexp(0, -signed) * self.trust[None]).sum(axis=2) / np.maximum(self.trust.sum(axis=1), 1e-9)


def fit(labelled: DataFrame) -> Model:
    """A model from all rows (text, lang). Each bit's classifier weighs a feature by its log odds between the languages
    on either side, every language counting alike. How far a bit is trusted for a language is its accuracy on TRIED
    documents of it."""
    labelled = labelled.where("lang is not null and text is not null").select("lang", F.lower("text").alias("text"))
    sizes = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros((0, 0)), np.zeros((FEATURES, 0)), np.zeros((0, 0)))
    place = {lang: i for i, lang in enumerate(languages)}

    def count(batches):
        total = np.zeros((len(languages), FEATURES))
        for batch in batches:
            at = np.array([place[x] for x in batch.column(0).to_pylist()], np.int64)
            for first, counts in _profiles(batch.column(1)):
                np.add.at(total, at[first:first + len(counts)], counts)
        seen, features = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(features), pa.array(total[seen, features])], names=["lang", "feature", "n"])

    sums = labelled.mapInArrow(count, "lang long, feature long, n double").groupBy("lang", "feature").agg(F.sum("n").alias("n")).toPandas()
    total = np.full((len(languages), FEATURES), 0.5)
    total[sums["lang"], sums["feature"]] += sums["n"]
    share = total / total.sum(axis=1, keepdims=True)
    code = codewords(len(languages))
    weights = np.column_stack([np.log(share[code[:, b] > 0].mean(axis=0) / share[code[:, b] < 0].mean(axis=0)) for b in range(code.shape[1])]) if code.size else np.zeros((FEATURES, 0))
    model = Model(languages, code, weights, np.ones(code.shape))

    def right(batches):
        hits, tried = np.zeros(code.shape), np.zeros(len(languages))
        for batch in batches:
            at = np.array([place[x] for x in batch.column(0).to_pylist()], np.int64)
            for first, counts in _profiles(batch.column(1)):
                own = at[first:first + len(counts)]
                np.add.at(hits, own, np.sign(model.margins(counts)) == code[own])
                np.add.at(tried, own, 1)
        for i in range(len(languages)):
            yield pa.RecordBatch.from_arrays([pa.array([i]), pa.array([tried[i]]), pa.array([hits[i]], pa.list_(pa.float64()))], names=["lang", "tried", "hits"])

    dice = F.pmod(F.xxhash64("text"), F.lit(1 << 20)) / (1 << 20)
    share_tried = F.coalesce(*(F.when(F.col("lang") == x, F.lit(min(1.0, TRIED / n))) for x, n in sizes.items()))
    rows = labelled.where(dice < share_tried).mapInArrow(right, "lang long, tried double, hits array<double>").collect()
    hits, tried = np.zeros(code.shape), np.zeros(len(languages))
    for r in rows:
        hits[r["lang"]] += r["hits"]
        tried[r["lang"]] += r["tried"]
    accuracy = (hits + 1) / (tried + 2)[:, None]
    return Model(languages, code, weights, np.maximum(2 * accuracy - 1, 0.01))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score, ambiguous of every whole text. A null text or one without a letter is `und` with score
    0, as is everything without a learned language; repeated rows each get theirs; extra columns are ignored."""

    def decode(batches):
        for batch in batches:
            names, scores, unsure = [], np.zeros(batch.num_rows), np.zeros(batch.num_rows, bool)
            for first, counts in _profiles(batch.column(1)):
                part = slice(first, first + len(counts))
                if not model.languages:
                    names += ["und"] * len(counts)
                    continue
                loss = model.losses(counts)
                order = np.argsort(loss, axis=1, kind="stable")
                best = order[:, 0]
                near = np.exp(-8 * (loss - loss.min(axis=1, keepdims=True)))
                scores[part] = (1 / near.sum(axis=1))
                if len(model.languages) > 1:
                    two = np.take_along_axis(loss, order[:, :2], axis=1)
                    unsure[part] = two[:, 1] - two[:, 0] < LEAD * np.maximum(two[:, 1], 1e-9)
                names += [model.languages[b] for b in best]
            letters = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([n if ok else "und" for n, ok in zip(names, letters, strict=True)], pa.string()),
                 pa.array(np.where(letters, scores, 0.0)), pa.array(unsure | ~letters)],
                names=["doc_id", "lang_pred", "score", "ambiguous"])

    rows = docs.select("doc_id", F.lower("text").alias("text"), F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters"))
    return rows.mapInArrow(decode, "doc_id long, lang_pred string, score double, ambiguous boolean")


def held_out(doc_id: str, folds: int, fold: int):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % folds == fold, F.lit(False))
