"""Filters, shards, neighbours, models, packing and decontamination."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from threadtables.llm import decontamination, language, packing, queries, sharding, toxicity, urlfilter, vptree
from threadtables.llm.textbytes import Chunk, flags, grams, mix

from .test_pairs import corpus, frame, lowered, words

DATA = "/root/testdata/sf0.01"
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def test_fingerprints_tell_spans_apart():
    data = np.frombuffer(b"abcabcabd" * 3, np.uint8)
    chunk = Chunk(0, data, np.array([0, len(data)]))
    spans = [(i, j) for i in range(len(data)) for j in range(i + 1, len(data) + 1)]
    prints = chunk.fingerprints(np.array([s[0] for s in spans]), np.array([s[1] for s in spans]))
    by = {}
    for (i, j), p in zip(spans, prints):
        assert by.setdefault(int(p), data[i:j].tobytes()) == data[i:j].tobytes()
    assert len(by) == len({data[i:j].tobytes() for i, j in spans})


def test_words_and_grams_stay_in_their_row():
    data = np.frombuffer(b"one twothree four", np.uint8)
    chunk = Chunk(0, data, np.array([0, 7, 7, 12, 17]))
    begin, end, first = chunk.words(flags(" ", among=False))
    assert [data[b:e].tobytes() for b, e in zip(begin, end)] == [b"one", b"two", b"three", b"four"]
    assert first.tolist() == [0, 2, 2, 3, 4]
    places, _ = grams(mix(chunk.fingerprints(begin, end)), first, 2)
    assert places.tolist() == [0]


# ---- URL filters ----

def plain_verdict(url, hosts):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = lowered(host).decode()
    fits = [(len(h + p), h + p, v) for v, h, p in queries.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    rule = max(fits, default=None)
    return host, path, rule and rule[1], rule[2] if rule else "block" if host in hosts else "allow"


URLS = ["http://a.example.org/es/1", "http://example.org/es", "https://EXAMPLE.org/en/12?q#x", "http://org/", "http://org", "ftp://x.com/de/", "http://x.com/fr/a/../de/", "http://notexample.org/es/1",
        "http://xorg/es/", "no scheme", "", None, "http://", "://x.org/a", "http://a.b.c.com/de/x", "http://spam-farm.net/", "http://spam-farm.example.com/fr/1", "http://É.ORG/ü", "http://h?://org/es/"]


def test_url_verdicts(spark):
    pages = spark.createDataFrame([(i, u, "h", "k") for i, u in enumerate(URLS + URLS)], "page_id long, url string, host string, key string")
    hosts = urlfilter.hosts_with_label(pages, queries.BLOCKED_LABELS)
    assert {r[0] for r in hosts.collect()} == {"spam-farm.net", "spam-farm.example.com"}
    found = [tuple(r)[1:] for r in urlfilter.judge(pages, queries.RULES, hosts).orderBy("page_id").collect()]
    assert found == [plain_verdict(u, {"spam-farm.net", "spam-farm.example.com"}) for u in URLS + URLS]
    assert urlfilter.judge(pages.limit(0), queries.RULES, hosts.limit(0)).collect() == []


def test_cascade_is_exact(spark, monkeypatch):
    keys = [(f"key {i}", i % 7 == 0) for i in range(6000)]
    table = spark.createDataFrame(keys, "key string, listed boolean")
    monkeypatch.setattr(urlfilter, "KEY_BITS", 3)  # many false positives
    filters = urlfilter.cascade(table)
    assert len(filters.levels) > 3
    assert table.where(F.col("listed") != filters.holds(F.col("key"))).count() == 0
    assert not urlfilter.cascade(table.where("not listed")).levels


def test_long_lists_take_more_passes(spark, monkeypatch):
    monkeypatch.setattr(urlfilter, "PASS_BYTES", 2)
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id long, url string")
    hosts = urlfilter.hosts_with_label(pages, queries.BLOCKED_LABELS)
    found = [tuple(r)[1:] for r in urlfilter.judge(pages, queries.RULES, hosts).orderBy("page_id").collect()]
    assert found == [plain_verdict(u, {"spam-farm.net", "spam-farm.example.com"}) for u in URLS]


# ---- shards ----

def shard_rows(spark, rows):
    return spark.createDataFrame([(d, t, lang, "src0", 5, 6) for d, t, lang in rows], "doc_id long, text string, lang string, source string, shard int, slot int")


def test_shards_have_equal_bytes(spark):
    rng = random.Random(1)
    rows = [(d, "é" * rng.randrange(1, 60) if d % 3 else "the same text", rng.choice(["en", None])) for d in range(4000)]
    found = sharding.document_shards(shard_rows(spark, rows), 24).collect()
    texts = {d: t for d, t, _ in rows}
    assert sorted(r["doc_id"] for r in found) == list(range(4000))
    assert all(r["size"] == len(texts[r["doc_id"]].encode()) + 8 and r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode()) for r in found)
    sums, slots = {}, {}
    for r in found:
        sums[r["shard"]] = sums.get(r["shard"], 0) + r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
        assert r["law"] == "bytes" and r["grown_shard"] is None
    assert sorted(sums) == list(range(24))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(sums.values()) - min(sums.values()) <= 2 * max(r["size"] for r in found)


def test_shards_of_odd_rows(spark):
    assert sharding.document_shards(shard_rows(spark, []), 24).collect() == []
    found = sharding.document_shards(shard_rows(spark, [(1, None, None), (1, None, None), (None, "", "en"), (3, "x" * 100_000, "en")]), 24).collect()
    assert sorted((r["doc_id"] or 0, r["size"], r["text_crc32"]) for r in found if r["text_crc32"] is not None) == [(0, 8, 0), (3, 100_008, zlib.crc32(b"x" * 100_000))]
    assert len(found) == 4 and all(0 <= r["shard"] < 24 for r in found)


# ---- neighbours ----

def plain_nearest(rows, k=10):
    good = {}
    for i, v in rows:
        if i is not None and v is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good[i] = np.array(v, np.float64)
    out = {}
    for q in good:
        if q % 100 == 0:
            far = sorted((float(np.sqrt(((good[q] - good[i]) ** 2).sum())), i) for i in good if i != q and len(good[i]) == len(good[q]))
            out[q] = far[:k]
    return out


def vector_rows():
    rng = np.random.default_rng(0)
    rows = [(int(i), rng.normal(size=8).round(2).tolist()) for i in range(1, 1200)]
    rows += [(2000 + i, [1.0] * 8) for i in range(600)] + [(5000, None), (5100, [0.0] * 8), (5200, [1.0, None] * 4), (5300, [float("nan")] * 8), (5400, [float("inf")] * 8), (5500, [1.0, 2.0]), (5501, [1.0, 2.5]), (None, [1.0] * 8)]
    return rows


@pytest.mark.parametrize("shard_rows", [100, 10_000])
def test_exact_neighbours(spark, monkeypatch, shard_rows):
    monkeypatch.setattr(vptree, "LEAF", 16)
    rows = vector_rows()
    table = spark.createDataFrame([(i, v, 1, 2.0) for i, v in rows + rows[:50]], "vec_id long, embedding array<double>, rank int, score double")
    found = {}
    for r in vptree.nearest(table, table.where("vec_id % 100 = 0"), shard_rows=shard_rows).orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append((r["score"], r["vec_id"], r["rank"]))
    expected = plain_nearest(rows)
    assert set(found) == {q for q, far in expected.items() if far}
    for q, far in found.items():
        assert [r for _, _, r in far] == list(range(1, len(far) + 1))
        assert [i for _, i, _ in far] == [i for _, i in expected[q]]
        assert np.allclose([d for d, _, _ in far], [d for d, _ in expected[q]], rtol=1e-12, atol=1e-12)
    assert vptree.nearest(table.limit(0), table.limit(0)).collect() == []


def test_a_smaller_factor_prunes_more():
    rng = np.random.default_rng(1)
    points = rng.normal(size=(5000, 6))
    tree = vptree.Tree(np.arange(5000), points)
    asked, own = points[:200], np.arange(200)
    exact, _ = tree.search(asked, own, 10, 1.0)
    seen = {}
    for factor in (1.0, 0.4):
        merges = []
        plain = tree._merge
        tree._merge = lambda p, a, *rest, m=merges, f=plain: (m.append(len(p) * len(a)), f(p, a, *rest))
        names, _ = tree.search(asked, own, 10, factor)
        del tree._merge
        seen[factor] = (sum(merges), np.mean([len(set(a) & set(b)) / 10 for a, b in zip(exact, names)]))
    assert seen[0.4][0] < 0.8 * seen[1.0][0] and 0.5 < seen[0.4][1] < 1 == seen[1.0][1]


# ---- models ----

def test_toxicity_on_held_out_rows(spark):
    rng = random.Random(3)
    rows, labels = [], []
    for d in range(1500):
        bad = rng.random() < 0.3
        text = words(rng, rng.randrange(20, 200))
        if bad:
            for _ in range(rng.randrange(1, 5)):
                text.insert(rng.randrange(len(text)), rng.choice(["idiot", "you stupid", "STUPID", "grobzork"]))
        rows.append((d, " ".join(text)))
        labels.append((d, int(bad)))
    rows += [(9000, None), (9001, ""), (9002, "you idiot " * 40_000), (None, "text"), (9001, "")]
    marks = spark.createDataFrame(labels + [(7777, 1), (None, 1), (5, None)], "doc_id long, toxic int")
    found = toxicity.score(frame(spark, rows), marks).collect()
    assert len(found) == len(rows)
    by = {r["doc_id"]: r for r in found}
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in found)
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in by.items() if d is not None)
    truth = dict(labels)
    held = [d for d in truth if by[d]["held_out"]]
    assert np.mean([by[d]["predicted"] == truth[d] for d in held]) > 0.95
    assert by[9000]["predicted"] == by[9001]["predicted"] == 0 and by[9002]["predicted"] == 1
    docs = frame(spark, rows)
    left = toxicity.drop_toxic(docs, marks)
    assert left.columns == docs.columns and left.where("doc_id = 9002").isEmpty() and left.where("doc_id is null").count() == 1


def test_toxicity_without_labels_or_rows(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r["predicted"] for r in toxicity.score(frame(spark, [(1, "idiot"), (2, None)]), none).collect()] == [0, 0]
    assert toxicity.score(frame(spark, []), none).collect() == []


def test_isotonic_is_the_best_monotone_fit():
    raw, y = np.arange(6.0), np.array([0, 1, 0, 0, 1, 1.0])
    knots, levels = toxicity.isotonic(raw, y)
    assert levels.tolist() == [0, pytest.approx(1 / 3), 1] and (np.diff(knots) > 0).all()


def language_rows():
    rng = random.Random(6)
    ends = {"aa": ["ing", "tion"], "bb": ["heit", "ung"], "cc": ["ção", "mente"], "dd": ["ović", "anje"], "ee": ["kään", "issa"], "ff": ["elle", "eaux"]}
    return [(d, " ".join(rng.choice("bdfgklmprst") + rng.choice("aeiou") + rng.choice(ends[lang]) for _ in range(rng.randrange(3, 60))), lang)
            for d in range(900) for lang in [rng.choice(sorted(ends))]]


@pytest.mark.parametrize("n", [1, 2, 4, 6])
def test_language_of_held_out_rows(spark, n):
    rows = [r for r in language_rows() if r[2] <= "abcdef"[n - 1] * 2]
    docs = spark.createDataFrame([(d, t, lang, "x") for d, t, lang in rows], "doc_id long, text string, lang string, score string")
    model = language.fit(docs.where("doc_id % 4 <> 2"))
    found = {r["doc_id"]: r for r in language.predict(docs, model).collect()}
    held = [(d, lang) for d, _, lang in rows if d % 4 == 2]
    assert np.mean([found[d]["lang_pred"] == lang for d, lang in held]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in found.values())


def test_language_of_odd_rows(spark):
    train = spark.createDataFrame([(1, "la mente", "cc"), (2, "the thing", "aa"), (3, None, "aa"), (4, "x", None)], "doc_id long, text string, lang string")
    model = language.fit(train)
    assert model.languages == ["aa", "cc"]
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "123 !?"), (4, "é"), (5, "thing " * 300_000), (5, "thing " * 300_000)], "doc_id long, text string")
    found = sorted((r["doc_id"], r["lang_pred"], r["score"] > 0) for r in language.predict(odd, model).collect())
    assert found[:3] == [(1, "und", False), (2, "und", False), (3, "und", False)]
    assert found[4:] == [(5, "aa", True), (5, "aa", True)] and found[3][1] in ("aa", "cc")
    empty = language.fit(train.limit(0))
    assert {r["lang_pred"] for r in language.predict(odd, empty).collect()} == {"und"}
    assert language.predict(odd.limit(0), model).collect() == []


def test_codewords_are_apart():
    for n in range(2, 20):
        code = language.codewords(n)
        assert min((code[i] != code[j]).sum() for i in range(n) for j in range(i)) >= (1 if n < 3 else 2)
        assert (np.abs(code.sum(axis=0)) < n).all()


# ---- packing ----

def test_pieces_are_the_tokenizers_ids(spark):
    from tokenizers import Tokenizer

    rng = random.Random(2)
    odd = ["", None, " ", "  two  blanks ", "\n \n x", " \t", "don't  stop  here", "\x1c a \x85 b", "日本 語 😀", "<|endoftext|> x", "word " * 5000, "a" * 9000, " lead", "trail "]
    rows = list(enumerate(odd + [t for _, t in corpus()][:40] + ["".join(rng.choice(" \n\tab1'.é ") for _ in range(60)) for _ in range(300)]))
    docs = frame(spark, rows)
    packed = packing.pack(docs, TOKENIZER)
    model = Tokenizer.from_file(TOKENIZER)
    found, seqs = {}, {}
    for r in packed.orderBy("doc_id", "piece").collect():
        found.setdefault(r["doc_id"], []).append(r)
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"], r["doc_id"], r["start"]))
    total, ids_of = 0, {}
    for d, t in rows:
        ids = ids_of[d] = np.array([*model.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        total += len(ids)
        assert b"".join(ids[r["start"]:r["start"] + r["length"]].tobytes() for r in found[d]) == ids.tobytes()
        assert [r["piece"] for r in found[d]] == list(range(len(found[d])))
        assert all(r["ids_crc32"] == zlib.crc32(ids[r["start"]:r["start"] + r["length"]].tobytes()) for r in found[d])
        assert all(r["length"] == 2048 for r in found[d][1:]) and 0 < found[d][0]["length"] <= 2048
    for parts in seqs.values():
        at = 0
        for offset, length, _, _ in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(seqs) <= -(-total // 2048) + 1
    whole = {r["sequence_id"]: bytes(r["ids"]) for r in packing.sequences(docs, packed, TOKENIZER).collect()}
    assert whole == {s: b"".join(ids_of[d][a:a + n].tobytes() for _, n, d, a in sorted(parts)) for s, parts in seqs.items()}


def test_packing_odd_rows(spark):
    assert packing.pack(frame(spark, []), TOKENIZER).collect() == []
    found = packing.pack(frame(spark, [(1, "same"), (1, "same"), (None, None)]), TOKENIZER).collect()
    assert [r["length"] for r in sorted(found, key=lambda r: r["length"])] == [1, 2, 2] and len({(r["sequence_id"], r["offset"]) for r in found}) == 3


def test_added_tokens_inside_texts_have_their_own_id():
    """The ids are those of the plain call, which knows added tokens inside texts too."""
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(TOKENIZER)
    texts = ["a<|endoftext|>b", "<|endoftext|>", "x <|endoftext|><|endoftext|> y", " <|endoftext|>\n", "<|endoftext", "a <|endoftext|> two  words"]
    found = [np.frombuffer(ids, "<u4").tolist() for ids in packing._words(TOKENIZER).ids(texts)]
    assert found == [model.encode(t, add_special_tokens=False).ids for t in texts]
    assert found[0] == [64, 50256, 65]


def test_kept_words_are_bounded_in_bytes():
    words = packing._Words(TOKENIZER)
    for i in range(40):
        words.ids([" ".join(f"{i}x{k}" * 5_000 for k in range(20))])
        assert words.bytes <= packing.CACHED_BYTES + 20 * 5_000 * 40
    assert len(words.known) < 800


@pytest.mark.parametrize("case", ["few", "many", "one length", "halves", "tiny"])
def test_plan_covers_the_histogram(case):
    rng = random.Random(7)
    lengths = {"few": [700] * 3, "many": [min(2048, int(rng.expovariate(1 / 600)) + 1) for _ in range(60_000)], "one length": [683] * 1000, "halves": [1024] * 999 + [1025] * 100, "tiny": [1] * 5000 + [2040] * 3}[case]
    histogram = {n: lengths.count(n) for n in set(lengths)}
    plan = packing.plan(histogram)
    used = {}
    for items, times in plan:
        assert sum(items) <= 2048 and times > 0
        for n in items:
            used[n] = used.get(n, 0) + times
    assert used == histogram
    best = {"few": 2, "many": int(1.006 * sum(lengths) / 2048), "one length": 500, "halves": 600, "tiny": 6}[case]
    assert sum(t for _, t in plan) <= best


# ---- decontamination ----

def bench_words(text):
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))


def plain_contamination(rows, items):
    windows = {}
    for i, t in items:
        w = bench_words(t)
        for k in range(max(0, min(len(w), 1) if len(w) < 13 else len(w) - 12)):
            windows.setdefault(tuple(w[k:k + 13]), set()).add(i)
    out = []
    for d, t in rows:
        w = bench_words(t)
        hit, found = set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in windows:
                    hit |= set(range(k, k + n))
                    found |= windows[tuple(w[k:k + n])]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((d, len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return out


def bench_case():
    rng = random.Random(11)
    items = [(str(i), " ".join(words(rng, n))) for i, n in enumerate([1, 5, 12, 13, 14, 40, 40, 200])] + [("8", None), ("9", "!!"), ("10", " ".join(["echo"] * 20))]
    rows = []
    for d in range(120):
        w = words(rng, rng.randrange(0, 300))
        if d % 2:
            part = bench_words(rng.choice(items[2:8])[1])
            a = rng.randrange(len(part))
            b = min(len(part), a + rng.randrange(1, 30))
            at = rng.randrange(len(w) + 1)
            w[at:at] = [x.decode().upper() for x in part[a:b]]
        rows.append((d, rng.choice([" ", ", ", "\n"]).join(w)))
    return rows + [(200, None), (201, ""), (202, items[5][1]), (203, "echo " * 15), (203, "echo " * 15), (204, "x " * 400_000 + items[7][1])], items


@pytest.mark.parametrize("suffixes", [1 << 20, 20])
def test_contamination_equals_plain_windows(spark, monkeypatch, suffixes):
    monkeypatch.setattr(decontamination, "SUFFIXES_PER_PASS", suffixes)
    rows, items = bench_case()
    if suffixes == 20:
        rows = [r for r in rows if r[0] != 203]  # passes are put together by doc_id
    benchmark = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id string, text string, doc_id long")
    found = decontamination.contamination(decontamination.verbatim_matches(frame(spark, rows), benchmark))
    assert sorted(map(tuple, found.collect())) == sorted(plain_contamination(rows, items))
    assert decontamination.contamination(decontamination.verbatim_matches(frame(spark, []), benchmark)).collect() == []


@pytest.mark.parametrize("suffixes", [1 << 20, 20])
def test_repeated_and_null_ids_in_any_number_of_passes(spark, monkeypatch, suffixes):
    monkeypatch.setattr(decontamination, "SUFFIXES_PER_PASS", suffixes)
    rows, items = bench_case()
    rows += [(None, items[5][1]), (None, "no match"), (None, "lead " * 9 + items[7][1]), (7, items[6][1]), (None, None)]
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    found = decontamination.contamination(decontamination.verbatim_matches(frame(spark, rows), benchmark))
    assert sorted(map(tuple, found.collect()), key=str) == sorted(plain_contamination(rows, items), key=str)


def test_longest_matches_and_removal(spark):
    rows, items = bench_case()
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    docs = frame(spark, rows + [(None, items[5][1])])
    hits = {r["doc_id"]: r["hits"] for r in decontamination.verbatim_matches(docs, benchmark).collect() if r["doc_id"] in (202, 204)}
    assert [tuple(h) for h in hits[202]] == [("5", 0, 0, 40)]
    assert [tuple(h) for h in hits[204]] == [("7", 0, 400_000, 200)]
    left = decontamination.remove_contaminated(docs, benchmark)
    bad = {r[0] for r in plain_contamination(rows, items) if r[5]}
    assert left.columns == docs.columns
    assert {r["doc_id"] for r in left.collect()} == {r[0] for r in rows if r[0] not in bad} | {None}
    nothing = benchmark.limit(0)
    assert decontamination.remove_contaminated(docs, nothing).count() == len(rows) + 1


def test_toxicity_collects_one_row_of_a_document(spark):
    names = [f"{i}D AS {n}" for i, n in enumerate(toxicity.NAMES)]
    rows = spark.range(500).selectExpr("id % 5 AS doc_id", "cast(id % 5 = 1 AS int) AS toxic", "0 AS part", *names)
    found = toxicity.one_each(rows).collect()
    assert sorted((r["toxic"], r[toxicity.NAMES[3]]) for r in found) == [(0, 3.0)] * 4 + [(1, 3.0)]


def test_cascades_stay_within_their_bytes(spark):
    """All levels count, whatever share of the corpus is listed."""
    for listed, universe in ((5, 20_000), (300, 20_000), (15_000, 20_000)):
        keys = spark.range(universe).selectExpr("concat('host ', id) AS key", f"id < {listed} AS listed")
        built = urlfilter.cascade(keys)
        assert sum(f.size for f in built.levels) / 8 <= 1.2 * urlfilter.expected_bytes(listed, universe) + 64
        assert keys.where(built.holds(F.col("key")) != F.col("listed")).count() == 0
    assert urlfilter.expected_bytes(1_000_000, 10**10) < 12e6  # 217 MB at 10 bits a key on every level


def test_judge_in_passes_set_by_the_corpus(spark, monkeypatch):
    pages = spark.range(3000).selectExpr("id AS page_id", "concat('https://h', id, '.net/') AS url")
    blocked = spark.createDataFrame([("h7.net",), ("h2999.net",)], "host string")
    assert urlfilter.expected_bytes(2, 3000) > 4
    monkeypatch.setattr(urlfilter, "PASS_BYTES", 4)
    found = urlfilter.judge(pages, [], blocked).where("verdict = 'block'").collect()
    assert sorted(r["page_id"] for r in found) == [7, 2999]
