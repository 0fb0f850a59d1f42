"""Toxicity of whole texts: boosted trees over dense features, calibrated by isotonic regression."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from threadtables.llm.textbytes import Chunk, chunks, flags, rows_of
from threadtables.session import stage

#: Labelled documents, at most about so many, from which lexicon, trees and calibration are learned.
SAMPLE = 20_000
#: Words that the labels add to the lexicon at most.
LEARNED = 100
#: Insults and words of address in the corpus's languages.
INSULTS = (
    "idiot idiots moron morons stupid dumb loser losers pathetic scum trash worthless clown clowns disgusting fool fools jerk "
    "garbage filthy vermin imbecile imbécile crétin débile ordure connard salaud nul pauvre minable dégoûtant "
    "idiota imbécil estúpido estúpida basura asqueroso payaso inútil patético escoria tonto "
    "trottel dummkopf blöd dumm abschaum versager widerlich wertlos müll erbärmlich arschloch"
).split()
YOU = "you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta tes vous votre vos tú ti usted ustedes vosotros".split()


def lexicon(labelled: DataFrame) -> list[str]:
    """Words of letters that documents marked toxic hold far more often: rows (text, toxic)."""
    words = labelled.select("toxic", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0)))).alias("word"))
    bad, good = (labelled.where(F.col("toxic") == x).count() + 1.0 for x in (1, 0))
    counts = words.groupBy("word").agg(F.sum("toxic").alias("t"), F.count("*").alias("n"))
    odds = ((F.col("t") + 0.5) / bad) / ((F.col("n") - F.col("t") + 0.5) / good)
    rows = counts.where((F.col("t") >= 8) & (odds >= 8) & (F.char_length("word") > 2)).orderBy(odds.desc(), "word").limit(LEARNED)
    return [r["word"] for r in rows.collect()]


#: Letters of every script; digits and signs that stand for letters.
_LETTER = flags("abcdefghijklmnopqrstuvwxyz") | (np.arange(256) >= 128)
_LEET = dict(zip(b"013457@$", b"oieasta" + b"s", strict=True))
_READ_AS = np.array([_LEET.get(b, b) for b in range(256)], np.uint8)
_SIGN = flags("0123456789@$*#")
NAMES = ["insults", "insult_rate", "hidden_rate", "you_rate", "near_you", "near_you_rate", "capitals", "shouted", "exclaims", "asks",
         "punctuation", "masked", "stretched", "length"]
#: Words between an insult and the address that it counts for.
NEAR = 4


def _prints(words: list[str]) -> np.ndarray:
    return np.sort(np.concatenate([c.fingerprints(c.starts[:-1], c.starts[1:]) for c in chunks(pa.array(words, pa.string()))]))


def _among(prints: np.ndarray, known: np.ndarray) -> np.ndarray:
    return known[np.minimum(np.searchsorted(known, prints), len(known) - 1)] == prints


def _features(chunk: Chunk, insults: np.ndarray, you: np.ndarray) -> np.ndarray:
    """A row of NAMES for each text of a chunk."""

    def per_row(flag: np.ndarray) -> np.ndarray:
        total = np.zeros(len(chunk.data) + 1, np.int64)
        flag = flag[:len(chunk.data)]
        np.cumsum(flag, out=total[1:1 + len(flag)])
        total[1 + len(flag):] = total[len(flag)]
        return np.diff(total[chunk.starts]).astype(float)

    raw = chunk.data
    upper = (raw >= 65) & (raw <= 90)
    chunk.lower()
    letter = _LETTER[chunk.data]
    begin, end, first = chunk.words(_LETTER)
    row = rows_of(first)
    per_word = lambda flag: np.bincount(row[flag], minlength=len(chunk)).astype(float)
    words = chunk.fingerprints(begin, end)
    bad, address = np.flatnonzero(_among(words, insults)), np.flatnonzero(_among(words, you))
    near = np.zeros(len(words), bool)
    for side in ("left", "right"):
        at = np.searchsorted(address, bad, side) - (side == "right")
        ok = (at >= 0) & (at < len(address))
        other = address[at[ok]]
        close = (np.abs(other - bad[ok]) <= NEAR) & (row[other] == row[bad[ok]])
        near[bad[ok][close]] = True
    ups = np.concatenate([[0], np.cumsum(upper)])
    loud = (ups[end] - ups[begin] == end - begin) & (end - begin >= 3)
    same = (chunk.data[2:] == chunk.data[1:-1]) & (chunk.data[1:-1] == chunk.data[:-2]) & letter[2:]
    sign = _SIGN[raw]
    between = sign[1:-1] & letter[:-2] & (letter[2:] | sign[2:])
    read = Chunk(0, _READ_AS[chunk.data], chunk.starts)
    b2, e2, f2 = read.words(_LETTER | _SIGN)
    signs = np.concatenate([[0], np.cumsum(sign)])
    hidden = _among(read.fingerprints(b2, e2), insults) & (signs[e2] > signs[b2])
    size = np.maximum(np.diff(chunk.starts), 1).astype(float)
    n = np.diff(first).astype(float)
    each = np.maximum(n, 1)
    flag = lambda at: np.bincount(row[at], minlength=len(chunk)).astype(float)
    found, close = flag(bad), per_word(near)
    hidden = np.bincount(rows_of(f2)[hidden], minlength=len(chunk)) / each
    mark = lambda b: per_row(raw == b) / size
    visible = per_row((raw > 32) & (raw < 127) & ~letter & ~upper & ~((raw >= 48) & (raw <= 57))) / size
    return np.column_stack([found, found / each, hidden, flag(address) / each, close, close / each, per_row(upper) / size, per_word(loud) / each,
                            mark(33), mark(63), visible, per_row(np.append(False, between)) / each, per_row(same) / each, np.log1p(n)])


def features(docs: DataFrame, words: list[str]) -> DataFrame:
    """doc_id, the `print` of the text and the NAMES as doubles; null and empty texts have all 0."""
    insults, you = _prints(words), _prints(YOU)

    def rows(batches):
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                x = _features(chunk, insults, you)
                ids, prints = (batch.column(c).slice(chunk.first, len(chunk)) for c in (0, 2))
                yield pa.RecordBatch.from_arrays([ids, prints, *(pa.array(np.ascontiguousarray(x[:, i])) for i in range(len(NAMES)))], names=["doc_id", "print", *NAMES])

    return docs.select("doc_id", "text", F.xxhash64("text").alias("print")).mapInArrow(rows, "doc_id long, print long, " + ", ".join(f"{n} double" for n in NAMES))


@dataclass
class Forest:
    """Trees of one depth over binned features; node i has the children 2i + 1 and 2i + 2."""

    cuts: list[np.ndarray]
    feature: np.ndarray  # trees x inner nodes
    bound: np.ndarray
    leaf: np.ndarray  # trees x leaves
    start: float
    knots: np.ndarray  # of the calibration
    levels: np.ndarray

    def raw(self, x: np.ndarray) -> np.ndarray:
        bins = _bins(x, self.cuts)
        total = np.full(len(x), self.start)
        inner = self.feature.shape[1]
        for f, b, leaf in zip(self.feature, self.bound, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(int(np.log2(inner + 1))):
                node = 2 * node + 1 + (bins[np.arange(len(x)), f[node]] > b[node])
            total += leaf[node - inner]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(x), self.knots, self.levels)


def _bins(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    return np.column_stack([np.searchsorted(c, x[:, i], side="left") for i, c in enumerate(cuts)]) if len(x) else np.zeros((0, len(cuts)), np.int64)


def boost(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 48, calm: float = 2.0) -> Forest:
    """Gradient-boosted trees for the logistic loss; leaves are Newton steps."""
    cuts = [np.unique(np.quantile(x[:, i], np.linspace(0, 1, bins)[1:-1])) if len(x) else np.zeros(0) for i in range(x.shape[1])]
    cuts = [np.unique(np.append(c, 0.0)) for c in cuts]
    binned = _bins(x, cuts)
    share = np.clip(y.mean() if len(y) else 0.0, 1e-3, 1 - 1e-3)
    start = float(np.log(share / (1 - share)))
    total = np.full(len(x), start)
    inner, wide = 2**depth - 1, bins + 2
    feature, bound, leaf = np.zeros((trees, inner), np.int64), np.zeros((trees, inner), np.int64), np.zeros((trees, inner + 1))
    for t in range(trees):
        p = 1 / (1 + np.exp(-total))
        slope, bend = y - p, p * (1 - p)
        node = np.zeros(len(x), np.int64)
        for level in range(depth):
            first, n = 2**level - 1, 2**level
            gain, pick = np.full(n, 1e-6), [(0, wide)] * n
            for f in range(x.shape[1]):
                key = (node - first) * wide + binned[:, f]
                g = np.bincount(key, slope, n * wide).reshape(n, wide).cumsum(axis=1)
                h = np.bincount(key, bend, n * wide).reshape(n, wide).cumsum(axis=1)
                worth = lambda a, b: a * a / (b + calm)
                won = worth(g, h) + worth(g[:, -1:] - g, h[:, -1:] - h) - worth(g[:, -1:], h[:, -1:])
                best = won.argmax(axis=1)
                for i in range(n):
                    if won[i, best[i]] > gain[i]:
                        gain[i], pick[i] = won[i, best[i]], (f, int(best[i]))
            for i, (f, b) in enumerate(pick):
                feature[t, first + i], bound[t, first + i] = f, b
            node = 2 * node + 1 + (binned[np.arange(len(x)), feature[t][node]] > bound[t][node])
        at = node - inner
        leaf[t] = rate * np.bincount(at, slope, inner + 1) / (np.bincount(at, bend, inner + 1) + calm)
        total += leaf[t][at]
    return Forest(cuts, feature, bound, leaf, start, np.array([-30.0, 30.0]), np.array([0.0, 1.0]))


def isotonic(raw: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots and levels of the best non-decreasing fit, by pooling neighbours that fall."""
    order = np.argsort(raw, kind="stable")
    pools: list[list[float]] = []  # sum of labels, rows, sum of raw
    for r, label in zip(raw[order], y[order], strict=True):
        pools.append([float(label), 1.0, float(r)])
        while len(pools) > 1 and pools[-2][0] / pools[-2][1] >= pools[-1][0] / pools[-1][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    return np.array([p[2] / p[1] for p in pools]), np.array([p[0] / p[1] for p in pools])


def fit(x: np.ndarray, y: np.ndarray, part: np.ndarray) -> Forest:
    """Trees from the rows with part 0, calibrated on those with part 1; without both labels, the constant."""
    model = boost(x[part == 0], y[part == 0])
    other = y[part == 1]
    if 0 < other.sum() < len(other):
        model.knots, model.levels = isotonic(model.raw(x[part == 1]), other)
    else:
        grid = np.linspace(-30, 30, 601)
        model.knots, model.levels = grid, 1 / (1 + np.exp(-grid))
    return model


def one_each(rows: DataFrame) -> DataFrame:
    """toxic, part and the NAMES of one row of each doc_id, so that what is collected is bounded by the ids drawn."""
    least = rows.groupBy("doc_id", "toxic", "part").agg(F.min(F.struct(*NAMES)).alias("x"))
    return least.select("toxic", "part", *(F.col(f"x.{n}").alias(n) for n in NAMES))


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document, learned from `labels` (doc_id, toxic).

    Documents with crc32(doc_id as text) mod 5 = 0 are held out: their labels are never seen. Of the others about
    SAMPLE are drawn by hash; half of them add words to the lexicon, the other half fit the trees and, a third of it,
    the calibration. Of several rows of a doc_id one is learned from (the least text, the least features). Null and empty texts have features 0 and get a score as well; a null doc_id is not held out and
    never learned from; of several labels of a document the greatest counts; without any label the score is a constant
    below 0.5. Repeated rows each get theirs; extra columns are ignored.
    """
    return _judged(docs, labels).drop("print")


def _judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`score` with the 64-bit `print` of each text."""
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    crc = F.crc32(F.col("doc_id").cast("string"))
    known = labels.where("doc_id is not null and toxic is not null").where(crc % 5 != 0).groupBy(F.col("doc_id").cast("long")).agg(F.max("toxic").cast("int").alias("toxic"))
    n = known.count()
    dice = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    sample = stage(known.where(dice < SAMPLE / max(n, 1)).withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(6))), "labelled")
    sample = F.broadcast(sample)  # SAMPLE rows of three numbers
    first = docs.join(sample.where("part >= 3"), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    words = sorted(set(INSULTS) | set(lexicon(first)))
    rows = stage(features(docs, words), "toxicity-features")
    learned = one_each(rows.join(sample.where("part < 3"), "doc_id")).toPandas()
    model = fit(learned[NAMES].to_numpy(np.float64), learned["toxic"].to_numpy(np.float64), (learned["part"] == 0).to_numpy(np.int64))
    held = F.coalesce(crc % 5 == 0, F.lit(False)).alias("held_out")

    def judge(batches):
        for batch in batches:
            own = np.column_stack([batch.column(3 + i).to_numpy() for i in range(len(NAMES))]).reshape(batch.num_rows, len(NAMES))
            s = np.clip(model.score(own), 0, 1)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in range(3)), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], names=["doc_id", "print", "held_out", "score", "predicted"])

    return rows.select("doc_id", "print", held, *NAMES).mapInArrow(judge, "doc_id long, print long, held_out boolean, score double, predicted int")


def drop_toxic(docs: DataFrame, labels: DataFrame, without_id: bool = False) -> DataFrame:
    """The documents that are not predicted toxic, with all their columns. Rows that share a doc_id are judged by their own
    texts. Rows without doc_id stay, or are judged like others `without_id`."""
    bad = _judged(docs, labels).where("predicted = 1")
    if not without_id:
        bad = bad.where("doc_id is not null")
    bad = bad.select(F.xxhash64("doc_id", "print").alias("key")).distinct()
    rows = docs.select(F.struct("*").alias("row"), F.xxhash64(F.col("doc_id").cast("long"), F.xxhash64("text")).alias("key"))
    return rows.join(bad, "key", "left_anti").select("row.*")
