"""The pipeline's stages against plain Python, each on what its predecessor kept."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline

from .test_pairs import corpus, groups, line_corpus, plain_lines, shingles, words
from .test_single import TOKENIZER, bench_case, plain_contamination

SCHEMA = "doc_id long, lang string, source string, text string, n_chars int"


def mixed_documents():
    """Copies, shared lines, benchmark passages and insults; ids that are null or repeat with other texts."""
    rng = random.Random(8)
    texts = [t for _, t in corpus()[:70]] + [t for _, t in line_corpus()[:30]] + [t for _, t in bench_case()[0][:60]]
    labels = []
    rows = list(enumerate(texts))
    for d in range(1000, 2200):
        bad = d % 4 == 0
        own = words(rng, 30)
        for _ in range(3 * bad):
            own.insert(rng.randrange(len(own)), rng.choice(["idiot", "you stupid", "STUPID"]))
        rows.append((d, " ".join(own)))
        labels.append((d, int(bad)))
    toxic, clean = "you idiot " + " ".join(words(rng, 20)) + " you stupid idiot", " ".join(words(rng, 40))
    item = bench_case()[1][5][1]
    odd = [(None, toxic), (1001, toxic), (None, clean), (None, clean + " end"), (1001, clean + " last words"), (None, item), (1003, item), (None, None), (None, ""), (None, "x\ny")]
    return rows + odd, labels, toxic, clean, item


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The rows before the first stage and after each."""
    rows, labels, *_ = mixed_documents()
    folder = str(tmp_path_factory.mktemp("tables"))
    docs = spark.createDataFrame([(d, "l", f"s{(d or 0) % 3}", t, None if t is None else len(t)) for d, t in rows], SCHEMA)
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(bench_case()[1], "item_id string, text string").write.parquet(f"{folder}/benchmark.parquet")
    out, docs = [docs.collect()], spark.read.parquet(f"{folder}/documents.parquet")
    for i, (name, step) in enumerate(corpus_pipeline.STAGES):
        docs = corpus_pipeline.stage(step(spark, docs, folder), f"test-{i}")
        assert i == 4 or docs.columns == ["doc_id", "lang", "source", "text", "n_chars"]
        out.append(docs.collect())
    return out


def pairs(rows):
    return Counter((r["doc_id"], r["text"]) for r in rows)


def test_toxic_rows_go_whatever_their_id(stages):
    rows, labels, toxic, clean, _ = mixed_documents()
    before, after = pairs(stages[0]), pairs(stages[1])
    assert not after - before and not [k for k in after if k[1] == toxic]
    assert after[(None, clean)] == after[(1001, clean + " last words")] == after[(None, None)] == 1
    gone = {d for d, _ in before - after}
    assert gone - {None, 1001} <= {d for d, t in labels if t} and len(gone) > 290


def test_lines_equal_all_pairs(stages):
    """Rows are numbered in the order in which the operator keeps lines: null ids first, then by doc_id."""
    before = stages[1]
    ids = Counter(r["doc_id"] for r in before)
    plain = {r["doc_id"]: r["text"] for r in before if ids[r["doc_id"]] == 1 and r["doc_id"] is not None}
    odd = {r["text"] for r in before if ids[r["doc_id"]] > 1 or r["doc_id"] is None}
    expected = plain_lines([(d, t) for d, t in plain.items()])
    shared = {line for t in odd for line in (t or "").split("\n")}
    after = {r["doc_id"]: r for r in stages[2]}
    seen = 0
    for d, (_, removed, text) in expected.items():
        if any(line in shared for line in (plain[d] or "").split("\n") if line.strip(" ")):
            continue
        if removed and not text.strip():
            assert d not in after
        elif d in after:
            seen += after[d]["text"] == text and after[d]["n_chars"] == (None if text is None else len(text))
    assert seen > 0.95 * len([d for d in expected if d in after])


def test_one_document_of_each_group_stays(stages):
    before, after = stages[2], pairs(stages[3])
    kinds = sorted({(r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "", r["text"] is None) for r in before})
    sets = [shingles(k[2]) for k in kinds]
    index, links = {}, []
    for i, own in enumerate(sets):
        near = {j for s in own for j in index.get(s, ())}
        links += [(i, j) for j in near if 100 * len(own & sets[j]) >= 80 * len(own | sets[j])]
        for s in own:
            index.setdefault(s, []).append(i)
    root = groups(range(len(kinds)), links)
    names = Counter(root.values())
    kept = {(None if k[0] else k[1], None if k[3] else k[2]) for i, k in enumerate(kinds)
            if names[root[i]] == 1 or k[:2] == min(kinds[j][:2] for j in root if root[j] == root[i])}
    assert set(after) <= kept and len(after) >= len(set(root.values()))
    assert len({root[i] for i, k in enumerate(kinds) if (None if k[0] else k[1], None if k[3] else k[2]) in after}) == len(set(root.values()))


def test_contaminated_rows_go_whatever_their_id(stages):
    before, after = pairs(stages[3]), pairs(stages[4])
    judged = plain_contamination(list(before), bench_case()[1])
    assert after == Counter({k: n for (k, n), j in zip(before.items(), judged, strict=True) if not j[5]})
    assert before != after


def test_pieces_hold_every_token(stages):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(TOKENIZER)
    found = Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in stages[5])
    expected = Counter()
    for r in stages[4]:
        ids = np.array([*model.encode(r["text"] or "", add_special_tokens=False).ids, 0], "<u4")
        assert len(ids) <= 2048
        expected[(r["doc_id"], 0, len(ids), zlib.crc32(ids.tobytes()))] += 1
    assert found == expected
