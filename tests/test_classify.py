from pyspark.sql import functions as F

from conftest import VENUE, note, notes_df, root
from threadtables.operators.classify import classify, in_venue, loose_note_kind, matching_keys
from threadtables.operators import discovery as D


def test_kinds(spark):
    rows = [
        root("f"),
        note("f", "review", "Reviewer_a", 1, {"summary": "s"}),
        note("f", "suffix", "Reviewer_a", 2, {"summary": "s"}, invitation="Official_Review/-/Rebuttal"),
        note("f", "comment", "Reviewer_a", 3, {"comment": "c"}, invitation="Official_Comment"),
        note("f", "meta", "Area_Chair_b", 4, {"summary": None}),
        note("f", "metareview", "Area_Chair_b", 5, {"metareview": "m"}),
        note("f", "decision", "Program_Chairs", 6, {"decision": ""}),
        note("f", "reply", "Authors", 7, {"comment": {"value": "c"}}),
        note("f", "silent", "Authors", 8, {"comment": {"value": ""}}),
        note("f", "unsigned", None, 9, None),
        note("f", "pc", "Program_Chairs", 10, {"comment": "c"}),
    ]
    found = {r["id"]: (r["kind"], r["is_reply"]) for r in classify(notes_df(spark, rows)).collect()}
    assert found == {
        "f": ("submission", False), "review": ("official_review", False), "suffix": ("other", False),
        "comment": ("other", False), "meta": ("meta_review", False), "metareview": ("other", False),
        "decision": ("decision", False), "reply": ("other", True), "silent": ("other", False),
        "unsigned": ("other", False), "pc": ("other", False),
    }
    wider = classify(notes_df(spark, rows), meta_keys=("summary", "metareview"))
    assert wider.where("kind = 'meta_review'").count() == 2


def test_loose_kinds_and_venue(spark):
    rows = [(["V/-/Official_Review"],), (["x", "V/-/Meta_Review"],), (["V/-/Submission"],),
            (["V/Submission1/-/Official_Comment"],), (None,)]
    df = spark.createDataFrame(rows, "invitations array<string>").select(loose_note_kind(F.col("invitations")))
    assert [r[0] for r in df.collect()] == ["official_review", "meta_review", "submission", "other", "other"]
    venues = spark.createDataFrame([(VENUE + "/Rejected",), ("Other",), (None,)], "v string")
    assert [r[0] for r in venues.select(in_venue(F.col("v"), F.lit(VENUE))).collect()] == [True, False, False]


def test_censuses(spark):
    rows = [root("f"), note("f", "a", "Reviewer_a", 1, {"b": 1, "a": 2}), note("f", "c", None, 2, None)]
    notes = notes_df(spark, rows)
    census = {(r["kind"], r["content_keys"]): r["notes"] for r in D.note_census(classify(notes)).collect()}
    assert census == {("submission", "title,venue,venueid"): 1, ("official_review", "a,b"): 1, ("other", ""): 1}
    listing = {r["id"]: (r["signature"], r["content_keys"]) for r in D.note_listing(notes).collect()}
    assert listing["c"] == ("?", "") and listing["a"][1] == "b,a"
    first = {r["kind"]: r["id"] for r in D.first_of_kind(classify(notes), ["seq", "id"]).collect()}
    assert first == {"submission": "f", "official_review": "a", "other": "c"}
    keys = matching_keys(classify(notes).select("id", "parsed"), F.col("parsed"))
    assert {(r["key"], r["value"]) for r in keys.collect()} == {("venue", "Main Oral"), ("venueid", VENUE)}
    profiles = spark.createDataFrame([('{"x": [1], "y": "b"}',), ('{"y": "a"}',)], "content string")
    assert {tuple(r) for r in D.key_census(profiles, "content").collect()} == {("x", 1, "[1]"), ("y", 2, '"a"')}
