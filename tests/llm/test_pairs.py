"""Joins, line dedup and repeated passages against plain Python."""

import hashlib
import os
import random
import re
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from threadtables.llm import circulant, components, line_dedup, ngram_join, prefilter, repeats

WORDS = [a + b for a in "ka lo mi tu ne sor vin dal".split() for b in "ra pe shi gon tek um".split()]
SCHEMA = "doc_id long, text string, id long, crc string, block string, n int"


def words(rng, n):
    return [rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n)]


def corpus(seed=1):
    """Originals, copies, near copies around the threshold, shared passages and awkward rows."""
    rng = random.Random(seed)
    texts = [" ".join(words(rng, n)) for n in (3, 4, 5, 6, 30, 60, 120, 200, 400) for _ in range(3)]
    passage = " ".join(words(rng, 60))
    for t in list(texts):
        texts.append(t)
        for edits in (1, 2, 4, 9):
            w = t.split(" ")
            for _ in range(edits):
                w[rng.randrange(len(w))] = "changed" + str(rng.randrange(9999))
            texts.append(" ".join(w))
    texts += [" ".join(words(rng, 20)) + " " + passage + " " + " ".join(words(rng, k)) for k in range(0, 30, 3)]
    texts += [None, "", "  \n ", "one", "One", "é ü ñ é", "a" * 3000, "ab" * 2000, " ".join(["same"] * 500)]
    return list(enumerate(texts))


def frame(spark, rows):
    return spark.createDataFrame([(d, t, 7, "x", "y", 3) for d, t in rows], SCHEMA)


def lowered(text):
    return (text or "").encode().translate(bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256)))


def shingles(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", lowered(text))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def groups(keys, linked):
    parent = {k: k for k in keys}

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in linked:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {k: find(k) for k in keys}


def plain_components(rows):
    sets = {d: shingles(t) for d, t in rows}
    ids = sorted(sets)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[:i] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    root = groups(ids, links)
    return {d: (len(sets[d]), root[d]) for d in ids}


def test_ngram_join_equals_all_pairs(spark):
    rows = corpus()
    found = {r[0]: (r[1], r[2]) for r in ngram_join.similar_documents(frame(spark, rows)).collect()}
    assert found == plain_components(rows)


def test_ngram_join_in_tiles(spark, monkeypatch):
    """A block far beyond the tile size gives the same groups, those of outsiders included."""
    monkeypatch.setattr(ngram_join, "TILE", 600)
    rng = random.Random(4)
    base = words(rng, 150)
    rows, chain = [], list(base)
    for d in range(60):
        w = list(base)
        for _ in range(2):
            w[rng.randrange(150)] = f"new{rng.randrange(10**6)}"
        rows.append((d, " ".join(w)))
    for d in range(60, 100):
        chain[rng.randrange(150)] = f"step{d}"
        rows.append((d, " ".join(chain)))
    found = {r[0]: (r[1], r[2]) for r in ngram_join.similar_documents(frame(spark, rows)).collect()}
    assert found == plain_components(rows)


def test_ngram_join_odd_rows(spark):
    rows = frame(spark, [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, "A B C D E F"), (3, None)])
    found = sorted(map(tuple, ngram_join.similar_documents(rows).collect()), key=str)
    assert found == sorted([(1, 2, 1), (1, 2, 1), (None, 2, None), (2, 2, 1), (3, 0, 3)], key=str)
    assert ngram_join.similar_documents(frame(spark, [])).collect() == []
    kept = ngram_join.one_of_each(rows)
    assert kept.columns == rows.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == [1, 1, 3, None]


def test_t_occurrence_links():
    rng = np.random.default_rng(3)
    base = [rng.integers(0, 2**62, n, dtype=np.uint64) for n in (1, 2, 30, 200)]
    sets = []
    for b in base:
        for keep in (1.0, 0.95, 0.9, 0.85, 0.5):
            sets.append(np.unique(np.concatenate([b[:max(1, int(len(b) * keep))], rng.integers(0, 2**62, int(len(b) * (1 - keep)), dtype=np.uint64)])))
    label = ngram_join.t_occurrence_links(sets)
    links = [(i, j) for i in range(len(sets)) for j in range(i) if 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))]
    root = groups(range(len(sets)), links)
    assert all((label[i] == label[j]) == (root[i] == root[j]) for i in root for j in root)


def test_connected(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000, x) for x in range(400, 700)] + [(2000 + i, 2001 + i) for i in range(60)] + [(5, 5), (None, 3)]
    found = dict(map(tuple, components.connected(spark.createDataFrame(edges, "a long, b long")).collect()))
    good = [(a, b) for a, b in edges if a is not None]
    root = groups({x for e in good for x in e}, good)
    assert found == {k: v for k, v in root.items() if k != v}
    assert components.connected(spark.createDataFrame([], "a long, b long")).collect() == []


def plain_lines(rows, percent=80):
    """Lines kept by all-pairs comparison."""
    first = {}
    for d, t in sorted(rows):
        for i, line in enumerate(t.split("\n") if t is not None else []):
            if line.strip(" "):
                first.setdefault(line, (d, i))
    lines = list(first)
    sets = {x: {x[i:i + 8] for i in range(max(1, len(x) - 7))} for x in lines}
    index, links = defaultdict(list), []
    for x in lines:
        near = {y for s in sets[x] for y in index[s]}
        links += [(first[x], first[y]) for y in near if 100 * len(sets[x] & sets[y]) >= percent * len(sets[x] | sets[y])]
        for s in sets[x]:
            index[s].append(x)
    root = groups(first.values(), links)
    out = {}
    for d, t in rows:
        if t is None:
            out[d] = (0, 0, None)
            continue
        own = t.split("\n")
        left = [x for i, x in enumerate(own) if not x.strip(" ") or root[first[x]] == (d, i)]
        out[d] = (len(own), len(own) - len(left), "\n".join(left))
    return out


def line_corpus(seed=5):
    rng = random.Random(seed)
    lines = [" ".join(words(rng, rng.choice((1, 3, 8, 20)))) for _ in range(60)] + ["Licensed to all.", "x", "", "  ", "ünï çödé líne with letters", "y" * 5000]
    rows = []
    for d in range(80):
        own = []
        for _ in range(rng.randrange(6)):
            line = rng.choice(lines)
            if rng.random() < 0.4 and len(line) > 60:
                at = rng.randrange(len(line))
                line = line[:at] + rng.choice("qz") + line[at + 1:]
            own.append(line)
        rows.append((d, "\n".join(own)))
    return rows + [(80, None), (81, ""), (82, "\n\n")]


def test_line_dedup_equals_all_pairs(spark):
    rows = line_corpus()
    found = {r[0]: tuple(r)[1:] for r in line_dedup.dedup_lines(frame(spark, rows)).collect()}
    expected = plain_lines(rows)
    assert found == expected
    assert sum(e[1] for e in expected.values()) > 40


def test_similar_lines_through_a_middle_line(spark):
    """Copies of one line with a word changed each are similar to it but few to each other: one component, though the
    line they share is neither the least nor the greatest."""
    rng = random.Random(12)
    base = words(rng, 24)
    lines = {" ".join(base[:k] + [f"new{d}"] + base[k + 1:]) for d in range(300) for k in [rng.randrange(24)]}
    lines = sorted(lines)
    lines.insert(len(lines) // 2, " ".join(base))
    links = line_dedup.similar_lines(spark.createDataFrame(list(enumerate(lines)), "line_id long, line string"))
    assert sorted(map(tuple, components.connected(links).collect())) == [(i, 0) for i in range(1, len(lines))]


def test_short_lines_at_the_threshold_share_a_band(spark):
    """16 of 20 shingles in common: independent orders lose 0.08 % of such pairs."""
    rng = random.Random(14)
    texts = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(27)) for _ in range(6000)]
    lines = [(2 * i + k, t[2 * k:25 + 2 * k]) for i, t in enumerate(texts) for k in (0, 1)]
    bands = line_dedup._banded(spark.createDataFrame(lines, "line_id long, line string"))
    shared = bands.groupBy(F.expr("line_id div 2").alias("pair"), "band").count().where("count = 2").select("pair").distinct().count()
    print("lost", len(texts) - shared)
    assert len(texts) - shared < 15


def test_line_dedup_along_a_chain(spark):
    """Each line is similar to its neighbours only."""
    rng = random.Random(13)
    w = words(rng, 40)
    rows = []
    for d in range(40):
        w[d] = words(rng, 1)[0] + "x"
        rows.append((d * 7 % 40, " ".join(w)))
    found = {r[0]: tuple(r)[1:] for r in line_dedup.dedup_lines(frame(spark, rows)).collect()}
    assert found == plain_lines(rows)


def test_line_dedup_odd_rows(spark):
    assert line_dedup.dedup_lines(frame(spark, [])).collect() == []
    rows = frame(spark, [(1, "a line of text\nmore"), (1, "a line of text\nmore"), (2, "a line of text"), (None, "more"), (3, "")])
    found = sorted(map(tuple, line_dedup.dedup_lines(rows).collect()), key=str)
    assert found == sorted([(1, 2, 1, "a line of text")] * 2 + [(2, 1, 1, ""), (None, 1, 0, "more"), (3, 1, 0, "")], key=str)
    left = line_dedup.drop_emptied(rows, line_dedup.dedup_lines(rows))
    assert left.columns == rows.columns
    assert sorted((r["doc_id"] for r in left.collect()), key=str) == [1, 1, 3, None]


def test_rows_that_share_an_id_get_their_own_text(spark):
    rows = [(0, "first line of all\nsecond line of all"), (1, "first line of all\nkept in one"), (1, "second line of all\nkept in another"), (1, "whole"),
            (None, "left alone here"), (2, "left alone here\nother"), (None, "whole again\nleft alone here")]
    docs = frame(spark, rows)
    left = line_dedup.drop_emptied(docs, line_dedup.dedup_texts(docs))
    expected = {r[0]: [] for r in rows}
    for r in line_dedup.dedup_lines(docs).collect():
        expected[r["doc_id"]].append(r["text"])
    assert sorted(((r["doc_id"], r["text"]) for r in left.collect()), key=str) == sorted(((d, t) for d, own in expected.items() for t in own if t), key=str)
    assert sorted(expected[1]) == ["kept in another", "kept in one", "whole"]


def test_line_dedup_uses_no_python(spark):
    plan = line_dedup.dedup_lines(frame(spark, line_corpus()))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def plain_repeats(rows, length):
    data = [(d, (t or "").encode()) for d, t in rows]
    seen = defaultdict(int)
    for _, b in data:
        for i in range(len(b) - length + 1):
            seen[b[i:i + length]] += 1
    out = {}
    for d, b in data:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = True
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out[d] = (len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


def test_repeats_equal_all_strings(spark):
    rows = corpus(9)
    rng = random.Random(8)
    long = " ".join(words(rng, 3000))
    rows += [(1000, long), (1001, "x" + long[200:6000] + "y" + long[8000:8399] + "z" + long[9000:9400]), (1002, long[500:899]), (1003, long[500:900])]
    found = {r[0]: tuple(r)[1:] for r in repeats.digest(repeats.remove_repeats(frame(spark, rows))).collect()}
    expected = plain_repeats(rows, 400)
    assert found == expected
    assert sum(e[1] for e in expected.values()) > 20_000


def test_repeats_odd_rows(spark):
    text = " ".join(words(random.Random(1), 90))
    assert repeats.remove_repeats(frame(spark, [])).collect() == []
    rows = [(1, text), (1, text), (1, text[:450] + "other"), (None, None), (2, "short")]
    found = sorted((r["doc_id"] or -1, r["n_bytes"], r["n_removed"]) for r in repeats.remove_repeats(frame(spark, rows)).collect())
    assert found == [(-1, 0, 0), (1, 455, 450), (1, len(text), len(text)), (1, len(text), len(text)), (2, 5, 0)]


def test_repeats_with_a_full_filter(spark, monkeypatch):
    """Then all phrases are looked at, with the same result."""
    monkeypatch.setattr(repeats, "_repeated_cores", lambda keyed, length: np.full(repeats.FILTER_BITS // 8, 255, np.uint8))
    rows = corpus(9)[:60]
    found = {r[0]: tuple(r)[1:] for r in repeats.digest(repeats.remove_repeats(frame(spark, rows))).collect()}
    assert found == plain_repeats(rows, 400)


def test_a_passage_in_a_third_of_the_rows(spark):
    rng = random.Random(3)
    passage = " ".join(words(rng, 70))
    rows = [(d, " ".join(words(rng, 30)) + (" " + passage + " " if d % 3 == 0 else " ") + " ".join(words(rng, 30))) for d in range(300)]
    found = {r[0]: tuple(r)[1:] for r in repeats.digest(repeats.remove_repeats(frame(spark, rows).withColumn("text", F.col("text")))).collect()}
    assert found == plain_repeats(rows, 400)


def equal_crc(first, second):
    """Four bytes that give `second` the crc32 of `first` when they follow it."""
    import zlib

    table = []
    for i in range(256):
        c = i
        for _ in range(8):
            c = (c >> 1) ^ (0xEDB88320 if c & 1 else 0)
        table.append(c)
    high = {t >> 24: i for i, t in enumerate(table)}
    state, want, picks = zlib.crc32(second) ^ 0xFFFFFFFF, zlib.crc32(first) ^ 0xFFFFFFFF, []
    for _ in range(4):
        picks.append(high[want >> 24])
        want = ((want ^ table[picks[-1]]) << 8) & 0xFFFFFFFF
    tail = b""
    for i in reversed(picks):
        tail += bytes([(state ^ i) & 0xFF])
        state = (state >> 8) ^ table[i]
    assert zlib.crc32(second + tail) == zlib.crc32(first)
    return second + tail


def test_rows_without_id_and_with_equal_crc_stay_apart(spark):
    """Texts of null ids are told apart by more than 32 bits, in line dedup and in the removal of repeats."""
    rng = random.Random(9)
    passage = "".join(rng.choice("abcdefghij ") for _ in range(500))
    one = ("start " + passage).encode()
    while True:
        two = equal_crc(one, ("".join(rng.choice("klmnopqrst ") for _ in range(700)) + "\n").encode())
        if all(32 < b < 127 for b in two[-4:]):
            break
    rows = [(None, one.decode()), (None, two.decode()), (-(1 << 63), passage)]
    found = {r["n_bytes"]: r for r in repeats.remove_repeats(frame(spark, rows)).collect()}
    assert found[len(two)]["n_removed"] == 0 and found[len(one)]["n_removed"] == len(passage) and found[500]["doc_id"] == -(1 << 63)
    lines = ["alpha beta gamma delta %d" % i for i in range(3)]
    rows = [(None, "\n".join([lines[0], "x" * 30])), (5, lines[0])]
    kept = {r["text"] for r in line_dedup.dedup_lines(frame(spark, rows)).collect()}
    assert kept == {rows[0][1], ""}


def test_sketches_count_the_values_that_differ(spark):
    rng = random.Random(12)
    n = line_dedup.BANDS * line_dedup.ROWS
    rows = [([rng.randrange(1 << 32) for _ in range(n)], rng.randrange(n + 1)) for _ in range(200)]
    rows = [(a, [x ^ (1 + rng.randrange(255) if i < k else 0) for i, x in enumerate(a)], k) for a, k in rows]
    df = spark.createDataFrame(rows, "a array<long>, b array<long>, k int")
    for side in "ab":
        df = _with_words(df, side, n)
    assert df.where(line_dedup._differing("sa", "sb") != F.col("k")).count() == 0
    assert line_dedup.may_differ(80) == 17 and line_dedup.may_differ(100) == 0


def _with_words(df, side, n):
    flat = df.select("*", *(F.col(side)[i].alias(f"m{i}") for i in range(n)))
    return flat.select(*df.columns, F.struct(*(line_dedup._word(w).alias(f"w{w}") for w in range(line_dedup.WORDS))).alias(f"s{side}"))


def test_parity_sketches_never_part_similar_lines(spark):
    """Lines of any length with repeated shingles: whatever the sketches tell apart is less similar, and most of the
    dissimilar pairs are told apart."""
    rng = random.Random(31)
    lines = []
    for _ in range(120):
        base = words(rng, rng.choice((1, 2, 6, 30, 120))) * rng.choice((1, 1, 2))
        for share in (0, 0.02, 0.05, 0.2):
            lines.append(" ".join(w if rng.random() >= share else rng.choice("qz") * rng.randrange(1, 9) for w in base))
    lines = sorted(set(lines))
    df = spark.createDataFrame(list(enumerate(lines)), "line_id long, line string")
    sketches = line_dedup._parities(df)
    sets = [{line[i:i + 8] for i in range(max(1, len(line) - 7))} for line in lines]
    assert {r["line_id"]: r["size"] for r in sketches.collect()} == {i: len(s) for i, s in enumerate(sets)}
    pairs = sketches.alias("x").join(sketches.alias("p"), F.expr("x.line_id < p.line_id"))
    for percent in (80, 95):
        passed = pairs.where(line_dedup._may_be_similar("x", "p", percent)).select("x.line_id", "p.line_id").collect()
        passed = set(map(tuple, passed))
        similar = {(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])}
        assert similar and similar <= passed and len(passed) < 3 * len(similar) + 200


def test_a_pair_unlike_the_ends_of_its_band(spark):
    """Four signatures in one band: the two in the middle agree, the smallest and the largest agree with nobody."""
    rng = random.Random(4)
    size = ngram_join.BANDS * ngram_join.ROWS
    sketch = [bytes(rng.randrange(256) for _ in range(size)) for _ in range(3)]
    middle = sketch[1][:100] + sketch[0][100:]
    rows = [(1, [7], sketch[0]), (2, [7], sketch[1]), (3, [7], middle), (4, [7], sketch[2])]
    held = spark.createDataFrame([(d, b, bytearray(s)) for d, b, s in rows], "doc_id long, bands array<long>, sketch binary")
    assert [(r["a"], r["b"]) for r in ngram_join._near_pairs(held).collect()] in ([(2, 3)], [(3, 2)])


def test_a_band_of_near_copies_gives_few_pairs(spark):
    """200 signatures alike each other between two ends they are unlike: they are connected by fewer pairs than members."""
    rng = random.Random(8)
    size = ngram_join.BANDS * ngram_join.ROWS
    low, middle, high = (bytes(rng.randrange(256) for _ in range(size)) for _ in range(3))
    rows = [(0, [7], low), *((i, [7], middle[:i % 7] + low[i % 7:i % 7 + 3] + middle[i % 7 + 3:]) for i in range(1, 201)), (201, [7], high)]
    held = spark.createDataFrame([(d, b, bytearray(s)) for d, b, s in rows], "doc_id long, bands array<long>, sketch binary")
    pairs = ngram_join._near_pairs(held)
    assert pairs.count() == 199
    assert {(r["node"], r["root"]) for r in components.connected(pairs).collect()} == {(i, 1) for i in range(2, 201)}


def staged(monkeypatch, module):
    """name: (columns, rows) of the tables that `module` stages from now on."""
    seen, own = {}, module.stage

    def spy(df, name, *rest, **more):
        out = own(df, name, *rest, **more)
        seen.setdefault(name, []).append((out.columns, out.count()))
        return out

    monkeypatch.setattr(module, "stage", spy)
    return seen


def lonely_and_near(n=300):
    """Documents unlike each other, and two near copies, each with its id."""
    rng = random.Random(6)
    texts = [" ".join(words(rng, 40)) for _ in range(n)]
    texts.append(texts[7] + " kara1")
    return list(enumerate(texts))


def test_bands_travel_without_signatures(spark, monkeypatch):
    seen = staged(monkeypatch, ngram_join)
    docs = spark.createDataFrame(lonely_and_near(), "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in ngram_join.similar_documents(docs).collect()}
    assert found == {i: 7 if i == 300 else i for i in range(301)}
    assert not [name for name, tables in seen.items() for columns, _ in tables if {"band", "sketch"} <= set(columns)]
    assert [rows for _, rows in seen["sketches"]] == [2]  # only members of a band that others share meet signatures


def test_only_texts_to_be_compared_are_moved_and_once(spark, monkeypatch):
    seen = staged(monkeypatch, circulant)
    docs = spark.createDataFrame(lonely_and_near(), "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in circulant.near_duplicates(docs).collect()}
    assert found == {i: 7 if i == 300 else i for i in range(301)}
    members, texts = seen["circulant-members"][0][1], seen["circulant-texts"]
    assert [rows for _, rows in texts] == [members] and members < 100


def test_a_repeated_id_with_several_signatures_stays_open(spark):
    """Id 2 stands in one band with two signatures; its second one alone is like that of 3, and neither is like a pivot."""
    rng = random.Random(5)
    size = ngram_join.BANDS * ngram_join.ROWS
    sketch = [bytes(rng.randrange(256) for _ in range(size)) for _ in range(4)]
    rows = [(1, [7], sketch[0]), (2, [7], sketch[1]), (2, [7], sketch[2]), (2, [7], sketch[2]), (3, [7], sketch[2]), (4, [7], sketch[3])]
    held = spark.createDataFrame([(d, b, bytearray(s)) for d, b, s in rows], "doc_id long, bands array<long>, sketch binary")
    assert {tuple(sorted(r)) for r in ngram_join._near_pairs(held).collect()} == {(2, 3)}


def test_line_dedup_leaves_no_texts_behind(spark, monkeypatch):
    """The staged lines and signatures are written by zstd and emptied as soon as nothing reads them any more."""
    folders, own = {}, line_dedup.stage

    def spy(df, name, *rest, **more):
        out = own(df, name, *rest, **more)
        if files := out.inputFiles():
            assert all(f.endswith(".zstd.parquet") for f in files)
            folders[name] = os.path.dirname(files[0])
        return out

    monkeypatch.setattr(line_dedup, "stage", spy)
    rows = spark.createDataFrame(lonely_and_near(), "doc_id long, text string")
    found = line_dedup.dedup_lines(rows).where("n_removed > 0")
    assert [r["doc_id"] for r in found.collect()] == [300]
    left = {name: spark.read.parquet(folder).count() for name, folder in folders.items()}
    assert left["lines"] == left["signatures"] == 0 and left["near-lines"] > 0 and left["line-places"] > 0


def test_a_class_that_a_line_lacks_tells_nothing(spark):
    """Lines of few shingles lack classes; similar ones among them pass the sketches all the same."""
    texts = [f"{c * 9}{c * k}" for c in "abc" for k in range(3)] + ["abcdefghij", "abcdefghijk", "abcdefghijkl"]
    lines = spark.createDataFrame(list(enumerate(texts)), "line_id long, line string")
    signed = line_dedup._signed(lines)
    assert signed.groupBy("line_id").count().where("count = 1").count() >= 9
    words = line_dedup._words(signed)
    pairs = words.alias("x").join(words.alias("p"), F.expr("x.line_id < p.line_id")).where(line_dedup._differing("x", "p") <= line_dedup.may_differ(80))
    links = {(r["a"], r["b"]) for r in line_dedup.similar_lines(lines).collect()}
    assert {(r["node"], r["root"]) for r in components.connected(spark.createDataFrame(links, "a long, b long")).collect()} >= {(3 * c + k, 3 * c) for c in range(3) for k in (1, 2)}
    passed = {tuple(r) for r in pairs.select("x.line_id", "p.line_id").collect()}
    assert {(3 * c, 3 * c + k) for c in range(3) for k in (1, 2)} <= passed


def test_prefilter_loses_no_wanted_row(spark):
    rows = spark.range(200_000).select((F.col("id") * 7919 - 10**9).alias("key"), F.col("id").alias("n"))
    wanted = rows.where("n % 1000 = 0")
    left = prefilter.likely(rows, "key", wanted.unionByName(wanted))
    assert left.columns == ["key", "n"]
    assert left.join(wanted, "key", "left_semi").count() == 200 and left.count() < 400
    assert prefilter.likely(rows, "key", wanted.limit(0)).isEmpty()
