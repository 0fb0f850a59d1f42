"""Submissions, reviews, decisions, meta reviews and author replies of each forum."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadtables.functions import content as C
from threadtables.functions import fields as FL
from threadtables.functions import text as T
from threadtables.operators.classify import DECISION, META_REVIEW, OTHER, REPLY, REVIEW, SUBMISSION, classify
from threadtables.operators.skew import group_rank, join_texts
from threadtables.operators.threads import FORUM, with_target

REVIEW_ORDER = ["reviewer", "seq", "note_id"]
REPLY_ORDER = ["posted", "seq", "id"]
PAPER_KEYS = ["title", "authors", "authorids", "keywords", "abstract", "primary_area", "venue", "venueid"]


def submissions(notes: DataFrame, site: str) -> DataFrame:
    """One row per submission note, with the fixed paper columns."""
    s, none = F.col("shown"), F.array().cast("array<string>")
    # values and lists are used several times, so they are read from their JSON in steps of their own
    parsed = notes.where("id = forum").select(*FORUM, "number", C.parse(F.col("content")).alias("parsed"))
    shown = parsed.select(*FORUM, "number", C.shown_values(F.col("parsed"), PAPER_KEYS).alias("shown"))
    listed = shown.select(
        "*", F.coalesce(C.shown_list(s, "authors"), none).alias("names"), F.coalesce(C.shown_list(s, "authorids"), none).alias("ids"))
    names, ids = F.col("names"), F.col("ids")
    return listed.select(
        *FORUM,
        "number",
        T.forum_url(F.col("forum"), site).alias("link"),
        C.shown_text(s, "title").alias("title"),
        T.format_authors(names, ids, site).alias("authors"),
        T.author_ids(ids).alias("author_ids"),
        F.coalesce(F.array_join(C.shown_list(s, "keywords"), ", "), C.shown_text(s, "keywords")).alias("keywords"),
        C.shown_text(s, "abstract").alias("abstract"),
        C.shown_text(s, "primary_area").alias("primary_area"),
        F.col("number").alias("submission_number"),
        C.shown_text(s, "venue").alias("venue"),
        C.shown_text(s, "venueid").alias("venueid"),
    )


def thread_parts(notes: DataFrame, text_fields: list[str] = FL.REVIEW_TEXT_FIELDS,
                 reply_fields: list[str] = FL.REPLY_TEXT_FIELDS, meta_keys: tuple[str, ...] = ("summary",),
                 housekeeping: list[str] = FL.HOUSEKEEPING_FIELDS) -> DataFrame:
    """Everything later steps need of a note, from one look at its content.

    One row per note with its kind as `part`, the text that kind contributes, and for a review the values of all
    keys that are neither prose nor housekeeping. An author reply has a second row with part `reply`, a forum's
    root one with part `submission`, whose text is the whole content.
    """
    parsed, part = F.col("parsed"), F.col("part")
    own = F.when(F.col("kind") == SUBMISSION, OTHER).otherwise(F.col("kind"))
    rows = (
        F.when(F.col("is_reply"), F.array(own, F.lit(REPLY))).when(F.col("id") == F.col("forum"), F.array(own, F.lit(SUBMISSION)))
        .otherwise(F.array(own))
    )
    text = (
        F.when(part == REVIEW, T.review_text(parsed, text_fields))
        .when(part == META_REVIEW, T.meta_review_text(parsed))
        .when(part == DECISION, C.truthy_text(parsed, "decision"))
        .when(part == REPLY, T.reply_text(parsed, reply_fields))
        .when(part == SUBMISSION, F.col("content"))
    )
    scores = F.when(part == REVIEW, C.values_except(parsed, text_fields + housekeeping))
    # only names are exploded, so that a step which wants some parts or columns makes no texts for the others
    keys = [*FORUM, "id", "number", "replyto", "cdate", "seq", "signature"]
    named = classify(notes, meta_keys, reply_fields).select(*keys, "content", "parsed", F.explode(rows).alias("part"))
    return named.select(*keys, "part", text.alias("text"), scores.alias("scores"))


def root_notes(parts: DataFrame) -> DataFrame:
    """The submission notes again, from the thread parts."""
    return parts.where(F.col("part") == SUBMISSION).select(*FORUM, "id", "number", F.col("text").alias("content"))


def scored_reviews(parts: DataFrame) -> DataFrame:
    """One row per official review, not yet numbered, with all its rating-like values as `scores`."""
    return parts.where(F.col("part") == REVIEW).select(
        *FORUM,
        F.col("id").alias("note_id"),
        "seq",
        T.handle(F.col("signature")).alias("reviewer"),
        F.col("signature").alias("reviewer_signature"),
        F.col("text").alias("full_text"),
        "scores",
    )


def with_ratings(review_rows: DataFrame, rating_fields: list[str]) -> DataFrame:
    """`ratings`, the given fields of `scores` in the given order, in its place."""
    ratings = C.pick(F.col("scores"), rating_fields).alias("ratings")
    return review_rows.select(*(ratings if c == "scores" else F.col(c) for c in review_rows.columns))


def reviews(parts: DataFrame, rating_fields: list[str]) -> DataFrame:
    """One row per official review, not yet numbered."""
    return with_ratings(scored_reviews(parts), rating_fields)


def review_counts(parts: DataFrame) -> DataFrame:
    return parts.where(F.col("part") == REVIEW).groupBy(*FORUM).agg(F.count(F.lit(1)).alias("n_reviews"))


def decision_and_meta(parts: DataFrame) -> DataFrame:
    """Per forum, the last decision with a value, and text and handle of the last meta review: one aggregate."""
    place = F.struct("seq", "id")
    decided = F.when((F.col("part") == DECISION) & F.col("text").isNotNull(), place)
    meta = F.struct(F.col("text").alias("meta_review_text"), T.handle(F.col("signature")).alias("meta_reviewer_handle"))
    last = parts.where(F.col("part").isin(DECISION, META_REVIEW)).groupBy(*FORUM).agg(
        F.max_by("text", decided).alias("decision"),
        F.max_by(meta, F.when(F.col("part") == META_REVIEW, place)).alias("meta"),
    )
    return last.select(*FORUM, "decision", "meta.*").where("decision IS NOT NULL OR meta_review_text IS NOT NULL")


def author_replies(parts: DataFrame) -> DataFrame:
    """Author replies with something left after quotes are stripped; `posted` is the posting time, 0 if unknown."""
    return parts.where((F.col("part") == REPLY) & (F.col("text") != "")).select(
        *FORUM, "id", "seq", "replyto", F.coalesce("cdate", F.lit(0)).alias("posted"), "text"
    )


def replies_with_target(parts: DataFrame, targets: DataFrame) -> DataFrame:
    return with_target(author_replies(parts), targets)


def merge_rebuttals(replies: DataFrame, separator: str = FL.REPLY_SEPARATOR) -> DataFrame:
    """One cell per answered review, replies in posting order."""
    answered = replies.where("target IS NOT NULL").withColumnRenamed("target", "note_id")
    return join_texts(answered, [*FORUM, "note_id"], REPLY_ORDER, "text", separator, "rebuttal_text")


def general_response(replies: DataFrame, separator: str = FL.REPLY_SEPARATOR) -> DataFrame:
    """One cell per forum, of the replies that answer no review."""
    general = replies.where("target IS NULL")
    return join_texts(general, FORUM, REPLY_ORDER, "text", separator, "general_response")


def attach_rebuttals(review_rows: DataFrame, rebuttals: DataFrame) -> DataFrame:
    """Reviews with the authors' answer to each, '' when there is none."""
    return review_rows.join(rebuttals, [*FORUM, "note_id"], "left").withColumn(
        "rebuttal_text", F.coalesce("rebuttal_text", F.lit(""))
    )


def number_reviews(review_rows: DataFrame) -> DataFrame:
    """Add `review_idx`: 1..N per forum in handle order."""
    return group_rank(review_rows, FORUM, REVIEW_ORDER, "review_idx")


def collect_reviews(review_rows: DataFrame) -> DataFrame:
    """One row per forum with its reviews nested in handle order: the shape of a nested paper row."""
    # the order keys lead, so the array sorts by them
    entry = F.struct(*REVIEW_ORDER, "reviewer_signature", "full_text", F.map_entries("ratings").alias("ratings"),
                     "rebuttal_text")
    nested = review_rows.groupBy(*FORUM).agg(F.sort_array(F.collect_list(entry)).alias("reviews"))
    return nested.withColumn("reviews", F.transform(
        "reviews",
        lambda r: F.struct(
            r["reviewer"].alias("reviewer_handle"), r["reviewer_signature"].alias("reviewer_signature"),
            r["note_id"].alias("note_id"), r["full_text"].alias("full_text"),
            F.map_from_entries(r["ratings"]).alias("ratings"), r["rebuttal_text"].alias("rebuttal_text"),
        ),
    ))
