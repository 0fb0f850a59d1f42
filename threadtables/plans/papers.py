"""From notes and venue buckets to papers and reviews."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadtables.functions import fields as FL
from threadtables.operators import buckets as B
from threadtables.operators import papers as P
from threadtables.operators.discovery import discover_rating_fields
from threadtables.operators.threads import FORUM, MAX_HOPS, resolve_targets
from threadtables.session import repeated_apart, stage
from threadtables.sources import schemas


@dataclass(frozen=True)
class Options:
    """What a venue may need changed: field lists, separator, limits."""

    site: str
    text_fields: tuple[str, ...] = tuple(FL.REVIEW_TEXT_FIELDS)
    reply_fields: tuple[str, ...] = tuple(FL.REPLY_TEXT_FIELDS)
    housekeeping_fields: tuple[str, ...] = tuple(FL.HOUSEKEEPING_FIELDS)
    meta_keys: tuple[str, ...] = ("summary",)
    separator: str = FL.REPLY_SEPARATOR
    max_hops: int = MAX_HOPS
    limit_per_bucket: int | None = None


def thread_parts(notes: DataFrame, opts: Options) -> DataFrame:
    return P.thread_parts(notes, list(opts.text_fields), list(opts.reply_fields), opts.meta_keys,
                          list(opts.housekeeping_fields))


def staged_parts(notes: DataFrame, opts: Options) -> DataFrame:
    """Thread parts written once, one folder per part: each later step reads its own rows and columns only."""
    return stage(thread_parts(notes, opts), "thread-parts", "part")


def staged_replies(parts: DataFrame, opts: Options) -> DataFrame:
    """Author replies with the review each answers; both merges and their size checks read this table."""
    return stage(P.replies_with_target(parts, resolve_targets(parts, opts.max_hops)), "replies")


def review_table(parts: DataFrame, replies: DataFrame, rating_fields: list[str], opts: Options) -> DataFrame:
    """Every official review with the authors' answer to it, not numbered."""
    return P.with_ratings(scored_review_table(parts, replies, opts), rating_fields)


def scored_review_table(parts: DataFrame, replies: DataFrame, opts: Options) -> DataFrame:
    """The same with every rating-like value, for runs that do not know the rating fields yet."""
    return P.attach_rebuttals(P.scored_reviews(parts), P.merge_rebuttals(replies, opts.separator))


def chosen_submissions(parts: DataFrame, buckets: DataFrame, opts: Options) -> DataFrame:
    """Submissions with their bucket: matched, limited, rejects without reviews dropped, first bucket kept."""
    candidates = B.bucket_candidates(P.submissions(P.root_notes(parts), opts.site), buckets)
    if opts.limit_per_bucket is not None:
        candidates = B.top_n_per_bucket(candidates, opts.limit_per_bucket)
    return B.first_bucket(B.drop_reject_without_reviews(candidates, P.review_counts(parts)))


def paper_table(parts: DataFrame, replies: DataFrame, buckets: DataFrame, opts: Options) -> DataFrame:
    """One row per chosen paper with decision, meta review and general response."""
    papers = (
        chosen_submissions(parts, buckets, opts)
        .join(P.decision_and_meta(parts), FORUM, "left")
        .join(P.general_response(replies, opts.separator), FORUM, "left")
    )
    text = {c: F.coalesce(c, F.lit("")) for c in ("meta_review_text", "meta_reviewer_handle", "general_response")}
    return papers.withColumns(text).withColumn("type", F.coalesce("decision", "bucket")).select(
        *FORUM, "link", "title", "authors", "author_ids", "keywords", "abstract", "primary_area",
        "submission_number", "type", "meta_review_text", "meta_reviewer_handle", "general_response", "bucket",
        "n_reviews",
    )


def paper_facts(parts: DataFrame, replies: DataFrame, opts: Options) -> DataFrame:
    """One row per submission with all that a paper row holds and its bucket depends on, but no bucket yet."""
    papers = (
        P.submissions(P.root_notes(parts), opts.site)
        .join(P.decision_and_meta(parts), FORUM, "left")
        .join(P.general_response(replies, opts.separator), FORUM, "left")
        .join(P.review_counts(parts), FORUM, "left")
    )
    text = {c: F.coalesce(c, F.lit("")) for c in ("meta_review_text", "meta_reviewer_handle", "general_response")}
    return papers.withColumns(text).withColumn("n_reviews", F.coalesce("n_reviews", F.lit(0).cast("bigint"))).select(
        *FORUM, "number", "link", "title", "authors", "author_ids", "keywords", "abstract", "primary_area",
        "submission_number", "venue", "venueid", "decision", "meta_review_text", "meta_reviewer_handle",
        "general_response", "n_reviews",
    )


def routed_papers(facts: DataFrame, buckets: DataFrame, opts: Options) -> DataFrame:
    """Paper rows of the chosen submissions: matched, limited, rejects without reviews dropped, first bucket kept.

    Submissions are routed by their narrow columns alone, and the wide ones joined to those that are chosen.
    """
    narrow = facts.select(*FORUM, "number", "venue", "venueid", "n_reviews")
    candidates = B.bucket_candidates(narrow, buckets)
    if opts.limit_per_bucket is not None:
        candidates = B.top_n_per_bucket(candidates, opts.limit_per_bucket)
    chosen = B.first_bucket(candidates.where(~(F.col("is_reject") & (F.col("n_reviews") == 0)))).select(*FORUM, "bucket")
    papers = facts.join(chosen, FORUM).withColumn("type", F.coalesce("decision", "bucket"))
    return papers.select(
        *FORUM, "link", "title", "authors", "author_ids", "keywords", "abstract", "primary_area",
        "submission_number", "type", "meta_review_text", "meta_reviewer_handle", "general_response", "bucket",
        "n_reviews",
    )


def last_copies(notes: DataFrame) -> DataFrame:
    """Each note once: of several copies of an id the one with the greatest `seq`, then content.

    Repeated ids are found from the keys alone; only their rows are gathered. Notes that lack a key all stay.
    """
    keys = [*FORUM, "id"]
    rest, repeated = repeated_apart(notes, keys, among=reduce(Column.__and__, [F.col(k).isNotNull() for k in keys]))
    if repeated is None:
        return rest
    last = repeated.groupBy(*keys).agg(F.max_by(F.struct(*notes.columns), F.struct("seq", "content")).alias("row"))
    return rest.unionByName(last.select("row.*"))


def assemble(notes: DataFrame, buckets: DataFrame, opts: Options, rating_fields: list[str] | None = None,
             venue_id: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(papers, reviews) of the chosen papers; contents are parsed once and chains walked once.

    Without `rating_fields` those of `venue_id` are discovered. A note that landed more than once counts once, as its
    last copy by `seq`. Without any bucket there is nothing to sort papers into, which is an error.
    """
    if rating_fields is None and venue_id is None:
        raise ValueError("give rating_fields, or the venue_id to discover them for")
    if buckets.isEmpty():
        raise ValueError("no decision buckets were found")
    parts = staged_parts(last_copies(notes), opts)
    if rating_fields is None:
        rating_fields = discover_rating_fields(parts, venue_id)
    replies = staged_replies(parts, opts)
    papers = stage(paper_table(parts, replies, buckets, opts), "papers")
    reviews = review_table(parts, replies, rating_fields, opts)
    return papers, reviews.join(papers.select(*FORUM), FORUM, "left_semi")


def long_reviews(reviews: DataFrame, opts: Options) -> DataFrame:
    """The core table: one row per review, numbered in handle order within its paper."""
    return P.number_reviews(stage(reviews, "reviews")).select(
        *FORUM, "review_idx", "reviewer", "reviewer_signature", "note_id", "full_text", "ratings", "rebuttal_text"
    )


def nested_papers(papers: DataFrame, reviews: DataFrame) -> DataFrame:
    """Papers with their reviews nested: the row a JSON-lines export holds."""
    none = F.array().cast(f"array<{schemas.REVIEW}>")
    return papers.join(P.collect_reviews(reviews), FORUM, "left").withColumn(
        "reviews", F.coalesce("reviews", none)
    ).drop("n_reviews")

