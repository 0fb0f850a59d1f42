"""One query per operator or group of operators, over the whole test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadtables import bindings as X
from threadtables.functions import content as C
from threadtables.functions import fields as FL
from threadtables.functions import text as T
from threadtables.operators import authors as A
from threadtables.operators import buckets as B
from threadtables.operators import discovery as D
from threadtables.operators import papers as P
from threadtables.operators import reshape as R
from threadtables.operators import threads as H
from threadtables.operators.classify import classify, loose_note_kind, matching_keys
from threadtables.plans import papers as plan
from threadtables.plans.authors import author_rows
from threadtables.session import fresh_dir, scratch, stage
from threadtables.sources import readers, writers
from threadtables.streaming import papers as stream_papers
from threadtables.streaming import profiles as stream_profiles

OPTS = plan.Options(site=X.SITE)
THREAD_RATINGS = ["rating", "confidence"]


def _pairs(column: str) -> Column:
    """A string map as `key=value` text, sorted by key."""
    entries = F.array_sort(F.transform(F.map_entries(column), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return F.array_join(entries, ",")


def _thread(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    parts = plan.staged_parts(X.thread_notes(spark, d), OPTS)
    return parts, plan.staged_replies(parts, OPTS)


# ---- threads ----

def reviews_with_rebuttals(spark, d):
    parts, replies = _thread(spark, d)
    table = plan.review_table(parts, replies, THREAD_RATINGS, OPTS)
    return table.select("forum", "note_id", "reviewer", "full_text", _pairs("ratings").alias("ratings"),
                        "rebuttal_text")


def general_response(spark, d):
    return P.general_response(_thread(spark, d)[1]).select("forum", "general_response")


def resolve_target_review(spark, d):
    parts = plan.staged_parts(X.thread_notes(spark, d), OPTS)
    replies = parts.where("part = 'reply'").select(*H.FORUM, "id", "replyto")
    return H.with_target(replies, H.resolve_targets(parts)).select("forum", "id", "replyto", "target")


def reply_parent(spark, d):
    return H.reply_parent(X.thread_notes(spark, d)).select("forum", "id", "parent_signature")


def forum_notes(spark, d):
    roots = X.thread_notes(spark, d).where("id = forum")
    notes = X.thread_notes(spark, d)
    return H.forum_notes(roots, notes).groupBy("forum").agg(F.count(F.lit(1)).alias("notes"))


def note_kinds(spark, d):
    return D.note_census(classify(X.thread_notes(spark, d)))


def note_listing(spark, d):
    return D.note_listing(X.thread_notes(spark, d)).select("id", "replyto", "signature", "invitation", "content_keys")


def loose_note_kinds(spark, d):
    kind = loose_note_kind(F.col("invitations"))
    return X.thread_notes(spark, d).groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("notes"))


def first_of_kind(spark, d):
    return D.first_of_kind(classify(X.thread_notes(spark, d)), ["number", "seq", "id"])


def first_examples(spark, d):
    found = D.first_examples(classify(X.thread_notes(spark, d)), ["number", "seq", "id"])
    return found.select("kind", "id", "signature", "position", "key", "value")


def stitch_review_text(spark, d):
    return P.reviews(P.thread_parts(X.thread_notes(spark, d)), []).select("note_id", "reviewer", "full_text")


def stitch_meta_text(spark, d):
    metas = P.thread_parts(X.thread_notes(spark, d)).where("part = 'meta_review'")
    return metas.select("id", T.handle(F.col("signature")).alias("handle"), F.col("text").alias("meta_review_text"))


def stitch_reply_text(spark, d):
    return P.author_replies(P.thread_parts(X.thread_notes(spark, d))).select("id", "posted", "text")


def discover_rating_fields(spark, d):
    return D.rating_field_counts(P.thread_parts(X.thread_notes(spark, d))).select("field", "n_reviews", "position")


def sample_rating_fields(spark, d):
    notes = X.thread_notes(spark, d)
    return D.sample_rating_fields(P.thread_parts(notes), P.submissions(notes, X.SITE)).select("field", "position")


def rating_audit(spark, d):
    notes = X.thread_notes(spark, d)
    fields = D.discover_rating_fields(P.thread_parts(notes), X.VENUE)
    return D.rating_audit(classify(notes), fields).select("note_id", "reviewer", "field", "shown", "field_class")


def strip_quoted_text(spark, d):
    docs = X.quoted_documents(spark, d)
    return docs.select("doc_id", T.strip_quoted_text(F.col("text")).alias("text"))


def text_excerpts(spark, d):
    docs = X.quoted_documents(spark, d)
    return docs.select("doc_id", T.excerpt(F.col("text"), 600).alias("excerpt"),
                       T.shortened(F.col("text"), 60).alias("shortened"))


def content_value(spark, d):
    p = F.col("parsed")
    parsed = X.event_contents(spark, d).select("event_id", C.parse(F.col("content")).alias("parsed"))
    return parsed.select(
        "event_id", C.content_value(p, "k").alias("k"), C.content_value(p, "t", "none").alias("t"),
        C.content_value(p, "n", "none").alias("n"), C.truthy(p, "k").alias("k_truthy"),
        C.has_key(p, "n").alias("has_n"),
    )


# ---- papers ----

def decision_and_meta(spark, d):
    parts = P.thread_parts(X.order_replies(spark, d))
    return P.decision_and_meta(parts).select("forum", "decision", "meta_review_text", "meta_reviewer_handle")


def submission_columns(spark, d):
    return P.submissions(X.order_submissions(spark, d), X.SITE).select(
        "forum", "link", "title", "keywords", "abstract", "primary_area", "submission_number", "venue", "venueid")


def format_authors(spark, d):
    subs = P.submissions(X.order_submissions(spark, d), X.SITE)
    return subs.select("forum", "authors", F.array_join("author_ids", ",").alias("author_ids"))


def split_author_cells(spark, d):
    subs = P.submissions(X.order_submissions(spark, d), X.SITE)
    return subs.select(F.explode(T.split_author_cell(F.col("authors"))).alias("author")).groupBy("author").agg(
        F.count(F.lit(1)).alias("papers"))


def distinct_author_ids(spark, d):
    return A.distinct_author_ids(P.submissions(X.order_submissions(spark, d), X.SITE))


def _candidates(spark, d):
    return B.bucket_candidates(P.submissions(X.order_submissions(spark, d), X.SITE), X.order_buckets(spark, d))


def assign_bucket(spark, d):
    return B.first_bucket(_candidates(spark, d)).select("forum", "bucket", "ord")


def top_n_per_bucket(spark, d):
    return B.top_n_per_bucket(_candidates(spark, d), 100).select("forum", "bucket", "number")


def top_5000_per_bucket(spark, d):
    return B.top_n_per_bucket(_candidates(spark, d), 5_000).select("forum", "bucket", "number")


def buckets_from_groups(spark, d):
    path = fresh_dir(spark, "groups")
    X.order_groups(spark, d).write.json(path)
    return B.buckets_from_groups(readers.scan_groups(spark, path)).select("ord", "venue_label", "decision", "rejected_venueid")


def drop_reject_without_reviews(spark, d):
    counts = P.review_counts(P.thread_parts(X.order_replies(spark, d)))
    kept = B.first_bucket(B.drop_reject_without_reviews(_candidates(spark, d), counts))
    return kept.select("forum", "bucket", "n_reviews")


def _order_papers(spark, d):
    return plan.assemble(X.order_notes(spark, d), X.order_buckets(spark, d), OPTS, X.ORDER_RATINGS)


def paper_rows(spark, d):
    papers, _ = _order_papers(spark, d)
    return papers.select("forum", "type", "bucket", "meta_review_text", "meta_reviewer_handle", "general_response",
                         "n_reviews")


def pending_forums(spark, d):
    papers, _ = _order_papers(spark, d)
    return stream_papers.pending_forums(X.order_submissions(spark, d), papers).select("forum")


def sample_papers(spark, d):
    papers, _ = _order_papers(spark, d)
    return R.sample_rows(papers, ["submission_number", "forum"], 20).select("forum", "type")


def long_reviews(spark, d):
    # numbering looks at the rows more than once, so they are written before
    rows = stage(P.reviews(P.thread_parts(X.order_replies(spark, d)), X.ORDER_RATINGS), "reviews")
    return P.number_reviews(rows).select(
        "forum", "review_idx", "reviewer", "full_text", _pairs("ratings").alias("ratings"))


def max_reviews_per_bucket(spark, d):
    papers, _ = _order_papers(spark, d)
    return B.bucket_counts(papers).select("bucket", "max_reviews")


def bucket_counts(spark, d):
    papers, _ = _order_papers(spark, d)
    return B.bucket_counts(papers).select("bucket", "bucket_slug", "papers", "max_reviews")


def wide_reviews(spark, d):
    papers, reviews = _order_papers(spark, d)
    return R.wide_reviews(papers, reviews, X.ORDER_RATINGS)


def unpivot_wide(spark, d):
    papers, reviews = _order_papers(spark, d)
    back = R.unpivot_wide(R.wide_reviews(papers, reviews, X.ORDER_RATINGS))
    return back.select("link", "review_idx", "reviewer", "full_text", _pairs("ratings").alias("ratings"))


def first_per_type(spark, d):
    papers, _ = _order_papers(spark, d)
    first = R.first_per_type(papers, ["submission_number", "forum"])
    return first.select("type", "link", T.excerpt(F.col("abstract"), 8).alias("abstract"))


def first_match_or_first(spark, d):
    papers, _ = _order_papers(spark, d)
    found = R.first_match_or_first(papers, F.col("type") == "Decided O", ["submission_number"])
    missing = R.first_match_or_first(papers, F.col("type") == "Withdrawn", ["submission_number"])
    return found.select(F.lit("found").alias("case"), "link", "type").unionByName(
        missing.select(F.lit("missing").alias("case"), "link", "type"))


def venue_label_counts(spark, d):
    subs = P.submissions(X.order_submissions(spark, d), X.SITE)
    return D.venue_label_counts(subs, X.order_buckets(spark, d)).select("venue_label", "submissions")


# ---- authors ----

def author_table(spark, d):
    return R.wide_history(A.author_table(X.customer_profiles(spark, d), X.SITE))


def scan_profiles(spark, d):
    path = fresh_dir(spark, "profiles")
    writers.write_nested(X.customer_profiles(spark, d), path)
    return A.long_history(A.author_table(readers.scan_profiles(spark, path), X.SITE))


def long_history(spark, d):
    return A.long_history(A.author_table(X.customer_profiles(spark, d), X.SITE))


def unpivot_history(spark, d):
    return R.unpivot_history(R.wide_history(A.author_table(X.customer_profiles(spark, d), X.SITE)))


def _manifest(spark, d):
    return A.author_ids(P.submissions(X.order_submissions(spark, d), X.SITE))


def manifest_profiles(spark, d):
    found = A.manifest_profiles(_manifest(spark, d), X.found_profiles(spark, d))
    return found.select("author_id", "id")


def missing_profiles(spark, d):
    return A.missing_profiles(_manifest(spark, d), X.found_profiles(spark, d))


def paper_authors(spark, d):
    subs = P.submissions(X.order_submissions(spark, d), X.SITE)
    rows = author_rows(subs, X.found_profiles(spark, d), X.SITE, distinct=True)
    return rows.select("Link", "Name", F.size("history").alias("entries"))


def merged_profile_chains(spark, d):
    profiles = X.merged_profiles(spark, d)
    ids = A.merged_profiles(profiles).groupBy(F.col("profile").alias("id")).agg(F.count(F.lit(1)).alias("ids"))
    return A.distinct_profiles(profiles).join(ids, "id").select("id", "query_id", "name", "ids")


def profile_key_census(spark, d):
    profiles = X.customer_profiles(spark, d)
    return D.key_census(profiles.select(F.to_json("content").alias("content")), "content").select("key", "rows")


def key_contains(spark, d):
    subs = X.order_submissions(spark, d).select("forum", C.parse(F.col("content")).alias("parsed"))
    return matching_keys(subs, F.col("parsed")).select("forum", "key", "value")


# ---- sinks and sources ----

def csv_roundtrip(spark, d):
    papers, _ = _order_papers(spark, d)
    path = fresh_dir(spark, "csv")
    # a NULL and a text with quotes, commas and line breaks must survive
    awkward = papers.select("forum", "title", "submission_number", F.nullif("meta_review_text", F.lit("")).alias("meta"),
                            F.concat(F.lit('"q", '), "authors", F.lit("\nnext")).alias("authors"))
    writers.write_csv(awkward, path)
    return readers.read_text_csv(spark, path)


def parquet_text_roundtrip(spark, d):
    authors = A.author_table(X.customer_profiles(spark, d), X.SITE)
    path = fresh_dir(spark, "parquet")
    writers.write_parquet_text(authors.select("Link", "Name", "Expertise", F.size("history").alias("entries")), path)
    return readers.read_text_parquet(spark, path)


def bucket_files_union(spark, d):
    papers, reviews = _order_papers(spark, d)
    out = fresh_dir(spark, "buckets")
    writers.write_per_bucket(papers, reviews, X.ORDER_RATINGS, X.VENUE, out, "parquet")
    union = writers.load_bucket_tables(spark, out, X.VENUE, "parquet")
    long = R.unpivot_wide(union).groupBy("link").agg(F.count(F.lit(1)).alias("reviews"))
    return union.join(long, "link", "left").select("link", "title", "type", F.coalesce("reviews", F.lit(0)).alias("reviews"))


def bucket_files_both(spark, d):
    """Both formats are written; the text files are read back."""
    papers, reviews = _order_papers(spark, d)
    out = fresh_dir(spark, "buckets")
    writers.write_per_bucket(papers, reviews, X.ORDER_RATINGS, X.VENUE, out, "both")
    return writers.load_bucket_tables(spark, out, X.VENUE, "csv").select("link", "title", "authors", "abstract", "type", F.col("Meta Review").alias("meta"))


def scan_notes(spark, d):
    path = fresh_dir(spark, "notes")
    X.thread_notes(spark, d).write.json(path)
    return readers.scan_notes(spark, path).select("forum", "id", "replyto", "seq")


def _nested_papers_file(spark, d):
    """The papers as JSON lines, gzipped; what was staged to make them is emptied, since only the lines are read."""
    path = fresh_dir(spark, "jsonl")
    with scratch(spark):
        papers, reviews = _order_papers(spark, d)
        writers.write_nested(plan.nested_papers(papers, reviews), path, compression="gzip")
    return path


def jsonl_roundtrip(spark, d):
    path = _nested_papers_file(spark, d)
    back = readers.scan_nested_papers(spark, path)
    first = F.get("reviews", F.lit(0))
    return back.select("forum", "type", "bucket", F.size("reviews").alias("reviews"),
                       first["reviewer_handle"].alias("reviewer"), first["full_text"].alias("text"),
                       F.try_element_at(first["ratings"], F.lit("quantity")).alias("quantity"))


def jsonl_reviews(spark, d):
    """The nested reviews of the JSON lines, whole."""
    path = _nested_papers_file(spark, d)
    rows = readers.scan_nested_papers(spark, path).select("forum", F.posexplode("reviews").alias("place", "r"))
    return rows.select("forum", "place", "r.reviewer_handle", "r.reviewer_signature", "r.note_id", "r.full_text",
                       _pairs("r.ratings").alias("ratings"), "r.rebuttal_text")


def id_manifest_roundtrip(spark, d):
    path = fresh_dir(spark, "ids")
    writers.write_id_manifest(_manifest(spark, d), path)
    return readers.scan_manifest(spark, path)


# ---- incremental ----

def incremental_papers(spark, d):
    landing, base = fresh_dir(spark, "landing"), fresh_dir(spark, "incremental")
    X.thread_notes(spark, d).repartition(4, "id").write.json(landing)
    run = stream_papers.PaperStream(base, X.VENUE, OPTS)
    run.run(spark, landing, max_files_per_batch=2)
    run.run(spark, landing)
    rows = plan.long_reviews(run.reviews(spark), OPTS)
    return rows.select("forum", "review_idx", "reviewer", "full_text", _pairs("ratings").alias("ratings"),
                       "rebuttal_text")


def incremental_profiles(spark, d):
    landing, base = fresh_dir(spark, "landing"), fresh_dir(spark, "incremental")
    writers.write_nested(X.found_profiles(spark, d).repartition(4, "query_id"), landing)
    run = stream_profiles.ProfileStream(base)
    run.run(spark, landing, max_files_per_batch=2)
    done = run.profiles(spark)
    pending = A.missing_profiles(_manifest(spark, d), done)
    names = A.manifest_profiles(_manifest(spark, d), done)
    table = A.author_table(names, X.SITE).select("Link", "Name")
    return table.select("Link", "Name", F.lit("done").alias("state")).unionByName(
        pending.select(T.profile_url(F.col("author_id"), X.SITE).alias("Link"), F.lit("").alias("Name"),
                       F.lit("pending").alias("state")))


def _waves(spark, landing, notes, n, by):
    """Land the notes in n parts that the caller takes in one after the other."""
    for wave in range(n):
        notes.where(F.pmod(by, F.lit(n)) == wave).write.mode("append").option("compression", "gzip").json(landing)
        yield wave


def _older_buckets(buckets):
    """The map before decisions were final: one label was called otherwise and another not there yet."""
    changed = F.when(F.col("ord") == 2, F.lit("Undecided")).otherwise(F.col("decision"))
    return buckets.where("ord <> 3").withColumn("decision", changed)


def incremental_paper_rows(spark, d):
    """Papers of three increments, between which the decision buckets changed."""
    landing, base = fresh_dir(spark, "landing"), fresh_dir(spark, "incremental")
    buckets = X.order_buckets(spark, d)
    for wave in _waves(spark, landing, X.order_notes(spark, d), 3, F.crc32("id")):
        run = stream_papers.PaperStream(base, X.VENUE, OPTS, _older_buckets(buckets) if wave == 0 else buckets, X.ORDER_RATINGS, tier=2)
        run.run(spark, landing)
    # buckets and columns of the last run are kept with it
    again = stream_papers.PaperStream(base, X.VENUE, OPTS)
    return again.papers(spark).select("forum", "type", "bucket", "title", "keywords", "meta_review_text", "meta_reviewer_handle", "n_reviews")


def incremental_top_n(spark, d):
    """At most 100 valid submissions of each bucket, over increments."""
    landing, base = fresh_dir(spark, "landing"), fresh_dir(spark, "incremental")
    opts = plan.Options(site=X.SITE, limit_per_bucket=100)
    for _ in _waves(spark, landing, X.order_notes(spark, d), 2, F.crc32("id")):
        run = stream_papers.PaperStream(base, X.VENUE, opts, X.order_buckets(spark, d))
        run.run(spark, landing)
    return run.papers(spark).select("forum", "bucket", "n_reviews")


def two_venues_one_slug(spark, d):
    """Two venues whose files would have one name, landed in one folder and run under one base."""
    landing, base = fresh_dir(spark, "landing"), fresh_dir(spark, "incremental")
    notes = X.thread_notes(spark, d)
    other = X.VENUE.replace("/Main", "_Main")
    renamed = {c: F.concat(F.lit("g"), F.substring(c, 2, 100)) for c in ("forum", "id", "replyto")}
    notes.unionByName(notes.withColumns(renamed).withColumn("venue_id", F.lit(other))).write.json(landing)
    tables = []
    for venue in (X.VENUE, other):
        run = stream_papers.PaperStream(base, venue, OPTS)
        run.run(spark, landing)
        tables.append(run.reviews(spark))
    both = tables[0].unionByName(tables[1])
    return both.select("venue_id", "forum", "note_id", "reviewer", _pairs("ratings").alias("ratings"), "rebuttal_text")


def restart(spark, d):
    """A new version starts over with all that landed; the old one stays as it was."""
    landing, base = fresh_dir(spark, "landing"), fresh_dir(spark, "incremental")
    waves = _waves(spark, landing, X.thread_notes(spark, d), 2, F.col("seq"))
    next(waves)
    old = stream_papers.PaperStream(base, X.VENUE, OPTS)
    old.run(spark, landing)
    next(waves)
    new = stream_papers.PaperStream(base, X.VENUE, plan.Options(site=X.SITE, separator=" | "), version=2)
    new.run(spark, landing)
    kept = old.reviews(spark).select(F.lit(1).alias("version"), "forum", "note_id", F.lit("").alias("rebuttal_text"))
    return kept.unionByName(new.reviews(spark).select(F.lit(2).alias("version"), "forum", "note_id", "rebuttal_text"))


def profile_retries(spark, d):
    """Three attempts, of which some fail; what is pending is asked again."""
    landing, base = fresh_dir(spark, "landing"), fresh_dir(spark, "incremental")
    for attempt in (1, 2, 3):
        rows = X.profile_attempts(spark, d, attempt)
        rows.write.mode("append").option("ignoreNullFields", False).json(landing)
        run = stream_profiles.ProfileStream(base, tier=2)
        run.run(spark, landing)
    ids = X.customer_profiles(spark, d).select(F.col("query_id").alias("author_id"))
    pending = run.pending(spark, ids, max_attempts=3).select(F.col("author_id").alias("query_id"), F.lit(True).alias("pending"))
    rows = run.attempts(spark).join(pending, "query_id", "left").join(run.profiles(spark).select("query_id", "id"), "query_id", "left")
    return rows.select("query_id", "found", "attempts", F.coalesce("pending", F.lit(False)).alias("pending"), F.coalesce("id", F.lit("")).alias("id"))


ALL = [
    reviews_with_rebuttals, general_response, resolve_target_review, reply_parent, forum_notes, note_kinds,
    note_listing, loose_note_kinds, first_of_kind, stitch_review_text, stitch_meta_text, stitch_reply_text,
    discover_rating_fields, sample_rating_fields, rating_audit, strip_quoted_text, text_excerpts, content_value,
    decision_and_meta, submission_columns, format_authors, split_author_cells, distinct_author_ids, assign_bucket,
    top_n_per_bucket, drop_reject_without_reviews, paper_rows, long_reviews, max_reviews_per_bucket, bucket_counts,
    wide_reviews, unpivot_wide, first_per_type, first_match_or_first, venue_label_counts, author_table, long_history,
    unpivot_history, manifest_profiles, missing_profiles, paper_authors, profile_key_census, key_contains,
    csv_roundtrip, parquet_text_roundtrip, bucket_files_union, jsonl_roundtrip, id_manifest_roundtrip,
    incremental_papers, incremental_profiles, top_5000_per_bucket, buckets_from_groups, scan_profiles, pending_forums,
    sample_papers, bucket_files_both, scan_notes, first_examples, merged_profile_chains, jsonl_reviews,
    incremental_paper_rows, incremental_top_n, two_venues_one_slug, restart, profile_retries,
]
