import random

from conftest import note, notes_df, root
from threadtables.operators import papers as P
from threadtables.operators.threads import forum_notes, reply_parent, resolve_targets, with_target


def _resolved(spark, rows, max_hops=12):
    parts = P.thread_parts(notes_df(spark, rows))
    replies = parts.where("part = 'reply'").drop("text")
    return {r["id"]: r["target"] for r in with_target(replies, resolve_targets(parts, max_hops)).collect()}


def _chain(length):
    """A reply whose walk meets `length` notes, the last one a review."""
    rows = [root("f"), note("f", "n1", "Reviewer_a", 1, {"summary": "s"})]
    rows += [note("f", f"n{i}", "Reviewer_a", i, {"comment": "c"}, f"n{i - 1}", invitation="Official_Comment")
             for i in range(2, length + 1)]
    return rows + [note("f", "reply", "Authors", 99, {"comment": "c"}, f"n{length}")]


def test_hop_limit(spark):
    assert _resolved(spark, _chain(12))["reply"] == "n1"
    assert _resolved(spark, _chain(13))["reply"] is None
    assert _resolved(spark, _chain(3), max_hops=2)["reply"] is None


def test_dead_ends(spark):
    rows = [
        root("f"), note("f", "review", "Reviewer_a", 1, {"summary": "s"}),
        note("f", "to_root", "Authors", 2, {"comment": "c"}), note("f", "lost", "Authors", 3, {"comment": "c"}, "gone"),
        note("f", "null", "Authors", 4, {"comment": "c"}, None), note("f", "blank", "Authors", 5, {"comment": "c"}, ""),
        note("f", "x", "Authors", 6, {"comment": "c"}, "y"), note("f", "y", "Authors", 7, {"comment": "c"}, "x"),
        note("f", "direct", "Authors", 8, {"comment": "c"}, "review"),
        note("g", "elsewhere", "Authors", 9, {"comment": "c"}, "review"),
    ]
    assert _resolved(spark, rows) == {
        "to_root": None, "lost": None, "null": None, "blank": None, "x": None, "y": None, "direct": "review",
        "elsewhere": None,
    }


def test_random_threads_match_a_plain_walk(spark):
    draw = random.Random(3)
    rows, expected = [], {}
    for f in range(60):
        size = draw.randint(2, 40)
        ids = [f"f{f}_{i}" for i in range(size)]
        parent, kinds = {}, {}
        for i, n in enumerate(ids):
            parent[n] = draw.choice([*ids, f"f{f}", "gone", None] if draw.random() < 0.3 else ids[max(0, i - 2):i + 1])
            kinds[n] = draw.choice(["review", "comment", "comment", "reply", "reply"])
        rows.append(root(f"f{f}"))
        for i, n in enumerate(ids):
            role = "Authors" if kinds[n] == "reply" else "Reviewer_a"
            invitation = "Official_Review" if kinds[n] == "review" else "Official_Comment"
            rows.append(note(f"f{f}", n, role, i, {"comment": "c"}, parent[n], invitation=invitation))
        for n in ids:
            if kinds[n] == "reply":
                at, hops = parent[n], 0
                while at in kinds and kinds[at] != "review" and hops < 11:
                    at, hops = parent[at], hops + 1
                expected[n] = at if kinds.get(at) == "review" else None
    found = _resolved(spark, rows)
    assert found == expected and any(expected.values())


def test_many_answers_to_one_note_and_repeated_notes(spark):
    rows = [root("f"), note("f", "review", "Reviewer_a", 1, {"summary": "s"})] * 2
    rows += [note("f", f"r{i}", "Authors", i, {"comment": "c"}, "review") for i in range(300)]
    assert _resolved(spark, rows) == {f"r{i}": "review" for i in range(300)}


def test_parents_and_forum_notes(spark):
    rows = [root("f"), note("f", "a", "Reviewer_a", 1, {"summary": "s"}), note("f", "b", "Authors", 2, {"comment": "c"}, "a"),
            note("g", "c", "Authors", 3, {"comment": "c"}, "a")]
    notes = notes_df(spark, rows)
    found = {r["id"]: r["parent_signature"] for r in reply_parent(notes).collect()}
    assert found["b"].endswith("/Reviewer_a") and found["a"].endswith("/Authors") and found["c"] is None
    assert forum_notes(notes.where("id = forum"), notes).count() == 3
