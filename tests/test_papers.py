import json

import pytest
from pyspark.sql import functions as F

from conftest import VENUE, as_dicts, note, notes_df, root
from threadtables.operators import buckets as B
from threadtables.operators import discovery as D
from threadtables.operators import papers as P
from threadtables.operators import reshape as R
from threadtables.plans import papers as plan
from threadtables.streaming.tables import last_copies

SITE = "https://site.example"
OPTS = plan.Options(site=SITE)
REJECTED = f"{VENUE}/Rejected_Submission"


def buckets_df(spark, headings, rejected=REJECTED):
    content = {"decision_heading_map": {"value": headings}, "rejected_venue_id": {"value": rejected}}
    return B.buckets_from_groups(spark.createDataFrame([(VENUE, json.dumps(content))], "venue_id string, content string"))


HEADINGS = {"Main Oral": "Accept (Oral)", "Main Poster": "Accept (Poster)", "Submitted": "Reject"}


def venue_notes():
    review = {"summary": {"value": "s"}, "rating": {"value": 8}, "confidence": "high"}
    return [
        root("oral", 1, authors=["A", "B"], authorids=["~a1", "b@x"], keywords=["k1", "k2"], abstract="abs",
             primary_area="area"),
        note("oral", "r2", "Reviewer_zz", 1, {"summary": {"value": "late"}}),
        note("oral", "r1", "Reviewer_aa", 2, review),
        note("oral", "c1", "Reviewer_aa", 3, {"comment": {"value": "more?"}}, "r1", invitation="Official_Comment"),
        note("oral", "a3", "Authors", 4, {"comment": {"value": "> more?\n\n\n\nthird"}}, "c1", cdate=30),
        note("oral", "a1", "Authors", 5, {"comment": {"value": "first"}}, "r1"),
        note("oral", "a2", "Authors", 6, {"rebuttal": {"value": "second"}}, "r1", cdate=30),
        note("oral", "a4", "Authors", 7, {"comment": {"value": "> only a quote"}}, "r1", cdate=1),
        note("oral", "all", "Authors", 8, {"comment": {"value": "to all"}}, cdate=5),
        note("oral", "m1", "Area_Chair_b", 9, {"summary": {"value": "old"}}),
        note("oral", "m2", "Area_Chair_c_d", 10, {"summary": {"value": "new"}, "metareview": {"value": "mr"}}),
        note("oral", "d1", "Program_Chairs", 11, {"decision": {"value": "Accept (Best)"}}),
        note("oral", "d2", "Program_Chairs", 12, {"decision": {"value": ""}}),
        root("poster", 2, venue="Main Poster", keywords="k1; k2"),
        root("mirror", 3, venueid="Other/2030", venue="Main Poster"),
        root("rejected", 4, venueid=REJECTED, venue="Submitted"),
        note("rejected", "r3", "Reviewer_aa", 1, review),
        root("silent", 5, venueid=REJECTED, venue="Submitted"),
        root("pending", 6, venue="Submitted"),
        root("both", 7, venueid=REJECTED, venue="Main Poster"),
    ]


def test_papers_of_a_venue(spark):
    papers, reviews = plan.assemble(notes_df(spark, venue_notes()), buckets_df(spark, HEADINGS), OPTS, venue_id=VENUE)
    rows = {r["forum"]: r for r in as_dicts(papers)}
    assert {f: r["bucket"] for f, r in rows.items()} == {
        "oral": "Accept (Oral)", "poster": "Accept (Poster)", "rejected": "Reject", "both": "Accept (Poster)"}
    oral = rows["oral"]
    assert oral["type"] == "Accept (Best)" and rows["poster"]["type"] == "Accept (Poster)"
    assert oral["authors"] == f"A ({SITE}/profile?id=~a1); B" and oral["author_ids"] == ["~a1"]
    assert oral["keywords"] == "k1, k2" and rows["poster"]["keywords"] == "k1; k2"
    assert oral["link"] == f"{SITE}/forum?id=oral" and oral["submission_number"] == 1
    assert oral["meta_review_text"] == "Summary:\nnew\n\nMetareview:\nmr" and oral["meta_reviewer_handle"] == "Area Chair c d"
    assert oral["general_response"] == "to all" and rows["poster"]["general_response"] == ""

    long = as_dicts(plan.long_reviews(reviews, OPTS), "forum", "review_idx")
    assert [(r["forum"], r["review_idx"], r["reviewer"]) for r in long] == [
        ("oral", 1, "Reviewer aa"), ("oral", 2, "Reviewer zz"), ("rejected", 1, "Reviewer aa")]
    # no time counts as 0, equal times keep the landed order, a reply of quotes only is left out
    assert long[0]["rebuttal_text"] == "first\n\n---\n\nthird\n\n---\n\nsecond"
    assert long[1]["rebuttal_text"] == "" and long[1]["ratings"] == {"rating": "", "confidence": ""}
    assert long[0]["ratings"] == {"rating": "8", "confidence": "high"}


def test_rejects_without_rejected_venue_go_by_label(spark):
    papers, _ = plan.assemble(notes_df(spark, venue_notes()), buckets_df(spark, HEADINGS, None), OPTS, [])
    assert {r["forum"] for r in as_dicts(papers) if r["bucket"] == "Reject"} == {"rejected"}
    rows = [*venue_notes(), note("pending", "r9", "Reviewer_aa", 1, {"summary": "s"})]
    papers, _ = plan.assemble(notes_df(spark, rows), buckets_df(spark, HEADINGS, None), OPTS, [])
    assert {r["forum"] for r in as_dicts(papers) if r["bucket"] == "Reject"} == {"rejected", "pending"}


def test_dropped_reject_may_fall_to_a_later_bucket(spark):
    headings = {"Submitted": "Reject", "Main Poster": "Accept (Poster)"}
    papers, _ = plan.assemble(notes_df(spark, venue_notes()), buckets_df(spark, headings), OPTS, [])
    assert {r["forum"]: r["bucket"] for r in as_dicts(papers)} == {
        "rejected": "Reject", "poster": "Accept (Poster)", "both": "Accept (Poster)"}


def test_limit_counts_before_drops(spark):
    limited = plan.Options(site=SITE, limit_per_bucket=1)
    papers, _ = plan.assemble(notes_df(spark, venue_notes()), buckets_df(spark, HEADINGS), limited, [])
    assert {r["forum"] for r in as_dicts(papers)} == {"oral", "poster", "rejected"}
    rows = [r for r in venue_notes() if r[1] != "rejected"]
    papers, _ = plan.assemble(notes_df(spark, rows), buckets_df(spark, HEADINGS), limited, [])
    assert {r["forum"] for r in as_dicts(papers)} == {"oral", "poster"}


def test_any_limit_ranks_like_a_window(spark):
    rows = [("v", i % 2, "b", False, f"f{i}", i % 97) for i in range(2000)]
    df = spark.createDataFrame(rows, "venue_id string, ord int, bucket string, is_reject boolean, forum string, number int")
    for n in (1, 300, 5000):
        first = {f for bucket in (0, 1) for _, f in sorted((r[5], r[4]) for r in rows if r[1] == bucket)[:n]}
        assert {r["forum"] for r in B.top_n_per_bucket(df, n).collect()} == first


def test_buckets_keep_the_order_of_their_map(spark):
    headings = {"Z Oral": "Accept (Oral)", "A Poster": "Accept (Poster)", "M": "Reject"}
    found = B.buckets_from_groups(spark.createDataFrame(
        [(VENUE, json.dumps({"decision_heading_map": {"value": headings}, "rejected_venue_id": {"value": REJECTED}}))],
        "venue_id string, content string"))
    assert [(r["ord"], r["venue_label"]) for r in as_dicts(found, "ord")] == [(0, "Z Oral"), (1, "A Poster"), (2, "M")]
    # a rejected paper that carries the label of the first bucket goes there, as that comes first
    notes = notes_df(spark, [root("both", venue_id=VENUE), note("both", "r", "Reviewer_a", 1, {"summary": "s"})]).withColumn(
        "content", F.when(F.col("id") == "both", json.dumps({"venue": {"value": "Z Oral"}, "venueid": {"value": REJECTED}})).otherwise(F.col("content")))
    papers, _ = plan.assemble(notes, found, OPTS, [])
    assert [r["bucket"] for r in as_dicts(papers)] == ["Accept (Oral)"]


def test_no_bucket_is_an_error(spark):
    with pytest.raises(ValueError, match="no decision buckets"):
        plan.assemble(notes_df(spark, venue_notes()), buckets_df(spark, HEADINGS).limit(0), OPTS, [])


def test_notes_landed_twice_count_once(spark):
    rows, buckets = venue_notes(), buckets_df(spark, HEADINGS)
    older = [r[:6] + (-5,) + r[7:9] + (json.dumps({"summary": "older", "rating": 1}),) for r in rows if r[2] in ("r1", "r2")]
    once = plan.assemble(notes_df(spark, rows), buckets, OPTS, ["rating"])
    twice = plan.assemble(notes_df(spark, rows + rows + older), buckets, OPTS, ["rating"])
    for a, b, order in zip(once, twice, ("forum", "note_id"), strict=True):
        assert as_dicts(a, order) == as_dicts(b, order)


def test_bucket_groups_need_a_wrapped_map(spark):
    content = json.dumps({"decision_heading_map": HEADINGS, "rejected_venue_id": REJECTED})
    groups = spark.createDataFrame([(VENUE, content)], "venue_id string, content string")
    assert B.buckets_from_groups(groups).count() == 0
    rows = as_dicts(buckets_df(spark, HEADINGS), "ord")
    assert [(r["ord"], r["venue_label"], r["decision"]) for r in rows] == [
        (i, k, v) for i, (k, v) in enumerate(HEADINGS.items())]


def test_bucket_counts_fall_back_to_type(spark):
    rows = [("v", "", "Accept", 2), ("v", "Accept", "x", 3), ("v", "(!)", "x", 0)]
    df = spark.createDataFrame(rows, "venue_id string, bucket string, type string, n_reviews int")
    assert {(r["bucket"], r["papers"], r["max_reviews"], r["bucket_slug"]) for r in B.bucket_counts(df).collect()} == {
        ("Accept", 2, 3, "Accept"), ("(!)", 1, 0, "Unknown")}


def test_rating_fields(spark):
    parts = P.thread_parts(notes_df(spark, venue_notes()))
    assert D.discover_rating_fields(parts, VENUE) == ["rating", "confidence"]
    subs = P.submissions(P.root_notes(parts), SITE)
    # the first review of the first submission has no rating keys
    assert D.discover_rating_fields(parts, VENUE, subs) == ["soundness", "presentation", "contribution", "rating",
                                                            "confidence"]
    assert D.discover_rating_fields(parts, "elsewhere", default=["x"]) == ["x"]
    labels = D.venue_label_counts(subs, spark.createDataFrame([(VENUE, "Main Oral"), (VENUE, "None")], "venue_id string, venue_label string"))
    assert {(r["venue_label"], r["submissions"]) for r in labels.collect()} == {("Main Oral", 1), ("None", 0)}


def test_wide_and_back(spark):
    papers, reviews = plan.assemble(notes_df(spark, venue_notes()), buckets_df(spark, HEADINGS), OPTS, venue_id=VENUE)
    fields = ["rating", "confidence"]
    wide = R.wide_reviews(papers, reviews, fields)
    assert len(wide.columns) == 11 + 2 * (3 + 2)
    assert wide.columns[11:16] == ["Review 1", "Reviewer 1", "Rebuttal 1", "Review 1 Rating", "Review 1 Confidence"]
    assert wide.where(" OR ".join(f"`{c}` IS NULL" for c in wide.columns)).count() == 0
    back = {(r["link"][-5:], r["review_idx"]): r for r in as_dicts(R.unpivot_wide(wide))}
    assert set(back) == {("=oral", 1), ("=oral", 2), ("ected", 1)}
    assert back[("=oral", 1)]["ratings"] == {"Rating": "8", "Confidence": "high"} and back[("=oral", 2)]["ratings"] == {}
    assert len(R.wide_reviews(papers, reviews, fields, width=4).columns) == 11 + 4 * 5
    with pytest.raises(Exception, match="more than 1 reviews"):
        R.wide_reviews(papers, reviews, fields, width=1).collect()
    assert len(R.wide_reviews(papers, reviews, [], width=1_001).columns) == 11 + 1_001 * 3
    with pytest.raises(ValueError, match="share a column"):
        R.wide_reviews(papers, reviews, ["a_b", "A_b"])
    assert R.unpivot_wide(wide.select("link", "title")).count() == 0


def test_wide_rows_are_made_of_what_is_asked_for(spark):
    """Reviews are sorted without a lambda; whoever counts reviews filters no ratings."""
    papers, reviews = plan.assemble(notes_df(spark, venue_notes()), buckets_df(spark, HEADINGS), OPTS, ["rating"])
    wide = R.wide_reviews(papers, reviews, ["rating"])
    plan_of = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "array_sort" not in plan_of(wide) and "sort_array" in plan_of(wide)
    back = R.unpivot_wide(wide)
    assert "map_filter" in plan_of(back) and "map_filter" not in plan_of(back.groupBy("link").count())


def test_firsts(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("b", 3)], "type string, n int")
    assert {(r["type"], r["n"]) for r in R.first_per_type(df, ["n"]).collect()} == {("a", 1), ("b", 3)}
    assert R.first_match_or_first(df, F.col("type") == "b", ["n"]).first()["n"] == 3
    assert R.first_match_or_first(df, F.col("type") == "z", ["n"]).first()["n"] == 1
    assert [r["n"] for r in R.sample_rows(df, ["n"], 2).collect()] == [1, 2]


def test_top_n_with_ties_gaps_and_missing_numbers(spark):
    numbers = [None] * 5 + [7] * 300 + [10**12 + i for i in range(200)] + [-(2**62), 2**62]
    rows = [("v", 0, f"f{i:04}", n, "x") for i, n in enumerate(numbers)] + [("v", 1, f"g{i}", None, "y") for i in range(4)]
    df = spark.createDataFrame(rows, "venue_id string, ord int, forum string, number bigint, title string")
    for n in (0, 3, 6, 200, 400, 10_000):
        order = lambda r: (r[3] is not None, r[3] or 0, r[2])
        first = {r for bucket in (0, 1) for r in sorted((r for r in rows if r[1] == bucket), key=order)[:n]}
        found = B.top_n_per_bucket(df, n)
        assert found.columns == df.columns and sorted(map(tuple, found.collect()), key=str) == sorted(first, key=str)
    assert B.top_n_per_bucket(df.limit(0), 3).count() == 0


def test_unique_notes_are_left_in_place(spark):
    rows = notes_df(spark, [root("f", 1), note("f", "r", "Reviewer_a", 1), note("f", None, "Reviewer_b", 2), note("f", None, "Reviewer_b", 2)])
    once = plan.last_copies(rows)
    assert once.count() == 4 and "Exchange" not in once._jdf.queryExecution().executedPlan().toString()
    # only the copies of `r` are gathered; notes without id stay
    twice = plan.last_copies(rows.unionByName(notes_df(spark, [note("f", "r", "Reviewer_c", 9)])))
    assert sorted((r["id"] or "", r["seq"]) for r in twice.collect()) == [("", 2), ("", 2), ("f", -1), ("r", 9)]


def test_streamed_copies_take_null_keys_as_one(spark):
    rows = spark.createDataFrame([(None, 1, "x"), (None, 2, "y"), ("a", 1, "z"), ("b", 3, "u"), ("b", 2, "v")], "k string, n int, t string")
    assert sorted((r["k"] or "", r["n"], r["t"]) for r in last_copies(rows, ["k"], ["n"]).collect()) == [("", 2, "y"), ("a", 1, "z"), ("b", 3, "u")]
    assert "Exchange" not in last_copies(rows.where("k = 'a'"), ["k"], ["n"])._jdf.queryExecution().executedPlan().toString()


def test_submissions_do_not_meet_at_their_buckets(spark):
    subs = notes_df(spark, [root(f"s{i}", i, venue="Main Poster") for i in range(300)]).repartition(4)
    buckets = buckets_df(spark, HEADINGS).repartition(3)
    found = B.bucket_candidates(P.submissions(subs, SITE), buckets)
    assert "hashpartitioning(route_key" not in found._jdf.queryExecution().executedPlan().toString().replace("venue_id, ", "")
    assert "SortMergeJoin" not in found._jdf.queryExecution().executedPlan().toString()
    assert B.top_n_per_bucket(found, 7).count() == 7
