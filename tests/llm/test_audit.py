"""Source divergence, fill-in-the-middle and circulant MinHash against plain Python."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.test_pairs import corpus, frame, groups, lowered
from threadtables.llm import circulant, divergence, fim, queries

DOCS = "doc_id long, text string, lang string, source string, n int, value long, rank string, tile int, node string"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is not None, str(x)) for x in r))


def documents(spark, rows):
    return spark.createDataFrame([(d, t, a, s, 5, 6, "x", 7, "y") for d, t, a, s in rows], DOCS)


# ---- source divergence ----

def spoken(seed=3, docs=260):
    rng = random.Random(seed)
    vocabulary = [w + x for w in "ala bor cin dov".split() for x in ("", "é", "x", "日本", "Q")]
    rows = []
    for i in range(docs):
        source = rng.choice(["web"] * 6 + ["news", "böök", "forum", None])
        words = [rng.choice(vocabulary[: 12 if source == "web" else 20]) for _ in range(rng.randrange(40))]
        rows.append((i, rng.choice([" ", "-", "1", "\n"]).join(words), rng.choice(["en", "en", "de", None]), source))
    rows += [(900, None, "xx", "web"), (901, "", "xx", "news"), (902, "one two", "yy", "web"), (902, "one two", "yy", "web"), (None, "ala " * 500, "en", "web")]
    return rows


def plain_divergence(rows, least, top):
    docs = [(a or "", s or "", re.findall("[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered(t).decode())) for _, t, a, s in rows]
    seen, count, sources = defaultdict(int), defaultdict(Counter), defaultdict(set)
    for a, s, words in docs:
        sources[a].add(s)
        count[a, s].update(words)
        for w in set(words):
            seen[a, w] += 1
    out = []
    for a, own in sources.items():
        kept = [w for (b, w), k in seen.items() if b == a and k >= least]
        share = lambda c, n: 1 + 10**9 * (c + 5) // (n + 5 * len(kept))
        total = {s: sum(count[a, s][w] for w in kept) for s in own}
        p = {s: {w: share(count[a, s][w], total[s]) for w in kept} for s in own}
        q = {w: share(sum(count[a, s][w] for s in own), sum(total.values())) for w in kept}
        for s in own:
            pairs = [(o, sum(abs(p[s][w] - p[o][w]) for w in kept)) for o in own if o != s]
            terms = [(w, p[s][w] - q[w]) for w in kept if count[a, s][w] and p[s][w] > q[w]]
            for part, found in (("pair", pairs), ("term", terms)):
                for rank, (item, value) in enumerate(sorted(found, key=lambda x: (-x[1], x[0].encode())), 1):
                    if part == "pair" or rank <= top:
                        out.append((a, s, part, item, value, rank))
    return sorted(out, key=lambda r: tuple((x is not None, str(x)) for x in r))


@pytest.mark.parametrize("tile", [divergence.TILE, 7])
def test_divergence_equals_plain_sums(spark, monkeypatch, tile):
    monkeypatch.setattr(divergence, "TILE", tile)
    rows = spoken()
    found = divergence.divergences(documents(spark, rows).repartition(5), least_docs=6, top=5)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert rows_of(found) == plain_divergence(rows, 6, 5)


def test_spilled_stripes_add_up_to_the_same(spark):
    docs = documents(spark, spoken()).coalesce(1)
    total = lambda cells: rows_of(cells.groupBy("lang", "source", "term").agg(F.sum("n_docs"), F.sum("n")))
    assert total(divergence.stripes(docs, held_cells=1)) == total(divergence.stripes(docs))
    assert divergence.stripes(docs).where("term is null").select("lang", "source").distinct().count() == 2 + 3 * 5 + 1


def test_shares_are_exact_beyond_64_bits():
    count, total = np.array([0, 7, 10**13, 8 * 10**14]), 8 * 10**14 + 10**13 + 7
    assert divergence.share(count, total, 4).tolist() == [1 + 10**9 * (int(c) + 5) // (total + 20) for c in count]


def test_no_documents_have_no_divergence(spark):
    assert divergence.divergences(documents(spark, [])).count() == 0


# ---- fill in the middle ----

def plain_fim(doc, text, unit="word", marks=("<P>", "<S>", "<M>")):
    text = text or ""
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text) if unit == "word" else list(text)
    hexed = hashlib.sha256(f"42:{'' if doc is None else doc}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(hexed[k:k + 8], 16) for k in (0, 8, 16, 24))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    head, middle, tail = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    p, s, m = marks
    if not text or any(x in text for x in marks) or h3 % 100 >= 50:
        return doc, n, "plain", None, None, text
    if h4 % 100 < 80:
        return doc, n, "spm", len(head), len(middle), s + tail + p + head + m + middle
    return doc, n, "psm", len(head), len(middle), p + head + s + tail + m + middle


def shaped(seed=5):
    rng = random.Random(seed)
    pieces = ["a", "bc", " ", "\n", "\t ", "é", "日本", "😀", "\x0b", "\x85", " ", "<", "P>", "<S", ">"]
    rows = [(i, "".join(rng.choice(pieces) for _ in range(rng.randrange(60)))) for i in range(400)]
    rows += [(500, None), (501, ""), (502, "   "), (503, "<P>"), (504, "x" * 200_000 + " é" * 50_000), (None, "null id here"), (506, "é"), (506, "é"), (507, "a<"), (508, "<P <S <M")]
    return rows


@pytest.mark.parametrize("unit", ["word", "char"])
def test_middles_equal_plain_slices(spark, unit):
    rows = shaped()
    found = fim.fill_in_middle(documents(spark, [(d, t, "en", "web") for d, t in rows]), unit=unit)
    assert rows_of(found) == sorted((plain_fim(d, t, unit) for d, t in rows), key=lambda r: tuple((x is not None, str(x)) for x in r))
    forms = {r[2] for r in found.collect()}
    assert forms == {"plain", "spm", "psm"}


def test_texts_come_back(spark):
    rows = shaped(6)
    marks = ("<|p|>", "<|s|>", "<|m|>")
    docs = documents(spark, [(d, t, "en", "web") for d, t in rows])
    cut = fim.fill_in_middle(docs, share=100, suffix_first=50, marks=marks)
    back = cut.select("doc_id", fim.restore(marks=marks))
    assert rows_of(back) == sorted(((d, t or "") for d, t in rows), key=lambda r: tuple((x is not None, str(x)) for x in r))
    assert rows_of(fim.fill_in_middle(docs).select("doc_id", fim.restore())) == rows_of(back)
    assert fim.fill_in_middle(docs.limit(0)).count() == 0


def test_sparse_index_converts_both_ways():
    text = "aé日😀b" * 7 + "plain ascii" + "ñ"
    index = fim.SparseIndex(np.frombuffer(text.encode(), np.uint8))
    points = np.arange(len(text) + 1)
    byte_cuts = np.array([len(text[:k].encode()) for k in points])
    assert index.bytes(points).tolist() == byte_cuts.tolist() and index.points(byte_cuts).tolist() == points.tolist()
    assert not len(fim.SparseIndex(np.frombuffer(b"ascii", np.uint8)).at_byte)


# ---- circulant MinHash ----

def pairs_of(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", lowered(text))
    return {tuple(w[i:i + 2]) for i in range(len(w) - 1)} if len(w) >= 2 else ({tuple(w)} if w else set())


def plain_components(rows):
    sets = {d: pairs_of(t) for d, t in rows}
    linked = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    root = groups(sets, linked)
    return sorted((d, len(s), root[d], d == root[d]) for d, s in sets.items())


def chained(seed=11, n=40):
    """Texts of which each is similar to the next only, and many that share most words but are not similar."""
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(120)]
    rows, words = [], list(base)
    for i in range(n):
        words = list(words)
        words[(3 * i) % 120] = f"new{i}"
        words[(3 * i + 60) % 120] = f"more{i}"
        rows.append((1000 + i, " ".join(words)))
    for i in range(60):
        own = list(base)
        for k in rng.sample(range(120), 9):
            own[k] = f"odd{i}x{k}"
        rows.append((2000 + i, " ".join(own)))
    return rows


@pytest.mark.parametrize("small", [False, True])
def test_components_equal_all_pairs(spark, monkeypatch, small):
    if small:
        monkeypatch.setattr(circulant, "TILE", 600)
        monkeypatch.setattr(circulant, "MEMBERS", 5)
    rows = corpus() + chained()
    found = circulant.near_duplicates(frame(spark, rows).repartition(6))
    assert rows_of(found) == sorted(plain_components(rows), key=lambda r: tuple((x is not None, str(x)) for x in r))


def test_odd_rows_have_their_own_components(spark):
    long = " ".join(f"t{i}" for i in range(40))
    rows = [(1, long), (1, long), (2, long.upper()), (None, long), (None, None), (3, None), (4, " "), (5, "one"), (6, "ONE"), (7, "two words"), (8, " ".join(f"u{i}" for i in range(30))), (2, " ".join(f"u{i}" for i in range(30)))]
    found = rows_of(circulant.near_duplicates(frame(spark, rows)))
    assert found == sorted([(1, 39, 1, True), (1, 39, 1, True), (2, 39, 1, False), (None, 39, None, True), (None, 0, None, True), (3, 0, 3, True), (4, 0, 4, True),
                            (5, 1, 5, True), (6, 1, 5, False), (7, 1, 7, True), (8, 29, 1, False), (2, 29, 1, False)],
                           key=lambda r: tuple((x is not None, str(x)) for x in r))
    assert circulant.near_duplicates(frame(spark, [])).count() == 0
    with pytest.raises(ValueError):
        circulant.near_duplicates(frame(spark, rows), percent=50)


def test_circulant_signatures_estimate_similarity():
    rng = np.random.default_rng(2)
    agree, shared = [], 0
    for _ in range(400):
        x = rng.integers(0, 1 << 63, 90, dtype=np.uint64)
        sets = np.concatenate([x[:80], x[:72], x[80:88]])  # 72 of 88 in common
        one, two = circulant.signatures(circulant.place(sets), np.array([0, 80, 160]))
        agree.append((one == two).mean())
        shared += (one == two).reshape(circulant.BANDS, circulant.ROWS).all(axis=1).any()
    assert abs(np.mean(agree) - 72 / 88) < 0.01
    assert np.std(agree) < 0.045  # 120 independent coordinates would have 0.035
    assert min(agree) * circulant.COORDINATES >= circulant.agreeing(80) and shared == 400


def test_queries_read_whole_tables(spark, tmp_path):
    rows = [(d, t, "en" if d % 2 else "de", "web" if d % 3 else "news") for d, t in corpus()[:60]]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    assert rows_of(queries.op11_source_divergence(spark, str(tmp_path))) == plain_divergence(rows, 30, 50)
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    wanted = [(*r[:5], digest(r[5]), digest(t or "")) for r, t in ((plain_fim(d, t), t) for d, t, _, _ in rows)]
    assert rows_of(queries.op12_fill_in_middle(spark, str(tmp_path))) == sorted(wanted, key=lambda r: tuple((x is not None, str(x)) for x in r))
    assert rows_of(queries.op13_circulant_minhash(spark, str(tmp_path))) == sorted(plain_components([r[:2] for r in rows]), key=lambda r: tuple((x is not None, str(x)) for x in r))
