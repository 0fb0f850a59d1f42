import pytest

from conftest import VENUE, as_dicts, note, notes_df, root
from test_authors import profile
from test_papers import HEADINGS, OPTS, buckets_df, venue_notes
from threadtables.operators import authors as A
from threadtables.plans import papers as plan
from threadtables.session import fresh_dir
from threadtables.sources import schemas
from threadtables.streaming.papers import PaperStream, pending_forums
from threadtables.streaming.profiles import ProfileStream
from threadtables.streaming.tables import path_key


def _land(spark, rows, landing, schema=schemas.NOTES):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(landing)


def test_increments_equal_one_run(spark):
    rows, buckets = venue_notes(), buckets_df(spark, HEADINGS)
    fields = ["rating", "confidence"]
    papers, reviews = plan.assemble(notes_df(spark, rows), buckets, OPTS, fields)
    base, landing = fresh_dir(spark, "base"), fresh_dir(spark, "landing")
    stream = PaperStream(base, VENUE, OPTS, buckets)

    late = [r for r in rows if r[2] in ("a1", "r3")]
    _land(spark, [r for r in reversed(rows) if r not in late], landing)
    other_venue = [root("x", venue_id="Other.cc/2030"), note("x", "xr", "Reviewer_a", 1, {"summary": "s"}, venue="Other.cc/2030")]
    _land(spark, other_venue, landing)
    stream.run(spark, landing, max_files_per_batch=1)
    before = {r["note_id"]: r for r in as_dicts(stream.reviews(spark))}
    assert set(before) == {"r1", "r2"} and before["r1"]["rebuttal_text"] == "third\n\n---\n\nsecond"
    assert {r["forum"] for r in as_dicts(pending_forums(
        notes_df(spark, rows).where("id = forum"), stream.papers(spark)))} == {"mirror", "rejected", "silent", "pending"}

    # late notes, one of them landed twice, and a batch that repeats everything
    _land(spark, late + late, landing)
    stream.run(spark, landing)
    _land(spark, rows, landing)
    stream.run(spark, landing)
    stream.run(spark, landing)
    assert as_dicts(stream.papers(spark).select(*papers.columns), "forum") == as_dicts(papers, "forum")
    columns = ["forum", "note_id", "reviewer", "full_text", "ratings", "rebuttal_text"]
    mine = stream.reviews(spark).select(*columns)
    assert as_dicts(mine, "note_id") == as_dicts(reviews.select(*columns), "note_id")

    again = PaperStream(base, VENUE, OPTS, buckets, rating_fields=["rating"], version=2)
    again.run(spark, landing)
    assert {tuple(r["ratings"]) for r in as_dicts(again.reviews(spark))} == {("rating",)}
    assert stream.reviews(spark).count() == reviews.count()


def test_repeated_batch_id_replaces_its_rows(spark):
    stream = PaperStream(fresh_dir(spark, "base"), VENUE, OPTS)
    batch = notes_df(spark, venue_notes())
    stream._batch(batch, 0)
    first = as_dicts(stream.reviews(spark), "note_id")
    stream._batch(batch, 0)
    assert as_dicts(stream.reviews(spark), "note_id") == first and len(first) == 3
    stream._batch(batch, 1)
    assert as_dicts(stream.reviews(spark), "note_id") == first


def test_edits_and_late_rating_fields(spark):
    landing = fresh_dir(spark, "landing")
    stream = PaperStream(fresh_dir(spark, "base"), VENUE, OPTS)
    _land(spark, [root("p"), note("p", "a", "Reviewer_a", 1, {"summary": "first", "rating": 3})], landing)
    stream.run(spark, landing)
    _land(spark, [note("p", "a", "Reviewer_a", 1, {"summary": "edited", "rating": 9})], landing)
    _land(spark, [root("q"), note("q", "b", "Reviewer_b", 1, {"summary": "s", "rating": 2, "confidence": 4})], landing)
    stream.run(spark, landing)
    found = {r["note_id"]: r for r in as_dicts(stream.reviews(spark))}
    assert "edited" in found["a"]["full_text"] and found["a"]["ratings"] == {"rating": "9", "confidence": ""}
    assert found["b"]["ratings"] == {"rating": "2", "confidence": "4"}


def test_limit_counts_finished_papers(spark):
    landing = fresh_dir(spark, "landing")
    limited = plan.Options(site="s", limit_per_bucket=1)
    stream = PaperStream(fresh_dir(spark, "base"), VENUE, limited, buckets_df(spark, HEADINGS))
    rows = [root(f, number=n) for n, f in enumerate("abc")]
    _land(spark, rows, landing)
    stream.run(spark, landing)
    assert [r["forum"] for r in as_dicts(stream.papers(spark))] == ["a"]


def test_profiles_found_later(spark):
    landing = fresh_dir(spark, "landing")
    stream = ProfileStream(fresh_dir(spark, "base"))
    ids = spark.createDataFrame([("~a",), ("~b",)], "author_id string")
    _land(spark, [profile("~a", names=[("A", True)])], landing, schemas.PROFILES)
    stream.run(spark, landing)
    assert [r[0] for r in A.missing_profiles(ids, stream.profiles(spark)).collect()] == ["~b"]
    _land(spark, [profile("~a", names=[("A2", True)]), profile("~b", "~a")], landing, schemas.PROFILES)
    stream.run(spark, landing)
    assert A.missing_profiles(ids, stream.profiles(spark)).count() == 0
    rows = as_dicts(stream.profiles(spark), "query_id")
    assert [(r["query_id"], r["id"]) for r in rows] == [("~a", "~a"), ("~b", "~a")]
    assert rows[0]["content"]["names"][0]["fullname"] == "A"


def test_settings_and_venue_are_guarded(spark):
    base, landing = fresh_dir(spark, "base"), fresh_dir(spark, "landing")
    _land(spark, [root("p"), note("p", "a", "Reviewer_a", 1, {"summary": "s"})], landing)
    PaperStream(base, VENUE, OPTS).run(spark, landing)
    with pytest.raises(ValueError, match="separator"):
        PaperStream(base, VENUE, plan.Options(site=OPTS.site, separator="|")).run(spark, landing)
    stolen = PaperStream(base, "Other.cc/2030", OPTS)
    stolen.store = PaperStream(base, VENUE, OPTS).store
    with pytest.raises(ValueError, match=VENUE):
        stolen.run(spark, landing)
    with pytest.raises(ValueError, match="no run had"):
        PaperStream(base, VENUE, OPTS).papers(spark)


def test_folder_names_are_all_different():
    names = ["A/B", "A_B", "A__B", "A.B", "a b", "A_2f_B", "Ä", "日", "_", "__", "", "a-b"]
    keys = [path_key(n) for n in names]
    assert len(set(keys)) == len(names) and not any("/" in k or " " in k for k in keys)
    assert path_key("Conf.cc/2030/Main") == "Conf.cc_2f_2030_2f_Main"


def test_many_batches_are_read_from_few_folders(spark):
    """Nine batches, of which each edits a review and answers another, equal one run; merged folders are emptied."""
    stream = PaperStream(fresh_dir(spark, "base"), VENUE, OPTS, buckets_df(spark, HEADINGS), tier=2)
    batches = 9
    rows = [root(f"p{i}", number=i) for i in range(3)]
    for b in range(batches):
        new = [note(f"p{b % 3}", "r", "Reviewer_a", b, {"summary": f"edit {b}", "rating": b}), note("p0", f"n{b}", f"Reviewer_{b}", b, {"summary": f"s{b}"})]
        if b == 0:
            new += rows
        stream._batch(notes_df(spark, new), b)
    runs = stream.store.record(spark).runs
    assert [(r.first, r.last) for r in runs] == [(0, 7), (8, 8)]
    folders = {f.split("/batch=")[1].split("/")[0] for f in stream.store.read(spark, "reviews", runs).inputFiles()}
    assert folders == {"7", "8"}
    full = {("p0", f"n{b}"): f"s{b}" for b in range(batches)} | {(f"p{b % 3}", "r"): f"edit {b}" for b in range(batches)}
    found = {(r["forum"], r["note_id"]): r["full_text"].split("\n")[1] for r in as_dicts(stream.reviews(spark))}
    assert found == full
    # a batch whose record was written but not its commit runs again, also over merged rows
    stream._batch(notes_df(spark, [note("p1", "z", "Reviewer_z", 1, {"summary": "z"})]), 8)
    assert {(r["forum"], r["note_id"]) for r in as_dicts(stream.reviews(spark))} == {k for k in full if k != ("p0", "n8")} | {("p1", "z")}


def test_a_changed_map_reroutes_untouched_papers(spark):
    rows, landing = venue_notes(), fresh_dir(spark, "landing")
    _land(spark, rows, landing)
    base = fresh_dir(spark, "base")
    before = {k: f"was {v}" for k, v in list(HEADINGS.items())[1:]}
    PaperStream(base, VENUE, OPTS, buckets_df(spark, before)).run(spark, landing)
    PaperStream(base, VENUE, OPTS, buckets_df(spark, HEADINGS)).run(spark, landing)  # nothing new landed
    papers, _ = plan.assemble(notes_df(spark, rows), buckets_df(spark, HEADINGS), OPTS, ["rating"])
    again = PaperStream(base, VENUE, OPTS)
    assert as_dicts(again.papers(spark).select(*papers.columns), "forum") == as_dicts(papers, "forum")
    for n in (1, 2):
        limited = plan.Options(**{**OPTS.__dict__, "limit_per_bucket": n})
        wanted, _ = plan.assemble(notes_df(spark, rows), buckets_df(spark, HEADINGS), limited, ["rating"])
        found = PaperStream(base, VENUE, limited).papers(spark)
        assert as_dicts(found.select(*papers.columns), "forum") == as_dicts(wanted, "forum")


def test_failed_attempts_are_counted_and_retried(spark):
    landing = fresh_dir(spark, "landing")
    stream = ProfileStream(fresh_dir(spark, "base"), tier=2)
    ids = spark.createDataFrame([("~a",), ("~b",), ("~c",), ("~d",)], "author_id string")
    failed = lambda who: (who, None, None)
    for rows in ([profile("~a"), failed("~b"), failed("~c")], [failed("~b"), failed("~c")], [profile("~b"), failed("~c"), failed("~a")]):
        _land(spark, rows, landing, schemas.PROFILES)
        stream.run(spark, landing)
    tried = {r["query_id"]: (r["found"], r["attempts"]) for r in as_dicts(stream.attempts(spark))}
    assert tried == {"~a": (True, 2), "~b": (True, 3), "~c": (False, 3)}
    assert {tuple(r) for r in stream.pending(spark, ids).collect()} == {("~c", 3), ("~d", 0)}
    assert {tuple(r) for r in stream.pending(spark, ids, max_attempts=3).collect()} == {("~d", 0)}
    assert {r["query_id"] for r in as_dicts(stream.profiles(spark))} == {"~a", "~b"}
