"""Note kinds and the columns every later step reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadtables.functions import content as C
from threadtables.functions import fields as FL
from threadtables.functions import text as T

DECISION, META_REVIEW, REVIEW = "decision", "meta_review", "official_review"
SUBMISSION, OTHER = "submission", "other"
REPLY = "reply"

# How signatures and invitations mark the kinds.
REVIEWER_MARK = "/Reviewer_"
AREA_CHAIR_MARK = "/Area_Chair_"
PROGRAM_CHAIRS_END = "/Program_Chairs"
AUTHORS_END = "/Authors"
REVIEW_INVITATION_END = "/-/Official_Review"


def _some(invitations: Column, test) -> Column:
    return F.coalesce(F.exists(invitations, test), F.lit(False))


def is_official_review(signature: Column, invitations: Column) -> Column:
    """A reviewer's note under the review invitation itself, not under a suffix of it."""
    return signature.contains(REVIEWER_MARK) & _some(invitations, lambda i: i.endswith(REVIEW_INVITATION_END))


def is_meta_review(signature: Column, parsed: Column, keys: tuple[str, ...] = ("summary",)) -> Column:
    """An area chair's note that has one of the keys, whatever its value."""
    present = F.lit(False)
    for key in keys:
        present = present | C.has_key(parsed, key)
    return signature.contains(AREA_CHAIR_MARK) & present


def is_decision(signature: Column, parsed: Column) -> Column:
    return signature.endswith(PROGRAM_CHAIRS_END) & C.has_key(parsed, "decision")


def is_author_reply(signature: Column, note_id: Column, forum: Column, parsed: Column,
                    fields: list[str] = FL.REPLY_TEXT_FIELDS) -> Column:
    """An authors' note other than the submission, with text in one of the fields."""
    return signature.endswith(AUTHORS_END) & (note_id != forum) & C.any_truthy(parsed, fields)


def note_kind(signature: Column, invitations: Column, parsed: Column, note_id: Column, forum: Column,
              meta_keys: tuple[str, ...] = ("summary",)) -> Column:
    """Decision before meta review before official review."""
    return (
        F.when(is_decision(signature, parsed), DECISION)
        .when(is_meta_review(signature, parsed, meta_keys), META_REVIEW)
        .when(is_official_review(signature, invitations), REVIEW)
        .when(note_id == forum, SUBMISSION)
        .otherwise(OTHER)
    )


def loose_note_kind(invitations: Column) -> Column:
    """Kind by substrings of the invitations only, for audits of unknown venues."""
    return (
        F.when(_some(invitations, lambda i: i.contains("Official_Review")), REVIEW)
        .when(_some(invitations, lambda i: i.contains("Meta_Review")), META_REVIEW)
        .when(
            _some(invitations, lambda i: i.contains("Submission") & ~i.contains("Review") & ~i.contains("Comment")),
            SUBMISSION,
        )
        .otherwise(OTHER)
    )


def classify(notes: DataFrame, meta_keys: tuple[str, ...] = ("summary",),
             reply_fields: list[str] = FL.REPLY_TEXT_FIELDS) -> DataFrame:
    """Add `parsed`, `signature`, `kind` and `is_reply`. Replies are tested apart from the kind."""
    with_content = notes.withColumns(
        {"parsed": C.parse(F.col("content")), "signature": T.first_signature(F.col("signatures"))}
    )
    return with_content.withColumns({
        "kind": note_kind(F.col("signature"), F.col("invitations"), F.col("parsed"), F.col("id"), F.col("forum"),
                          meta_keys),
        "is_reply": is_author_reply(F.col("signature"), F.col("id"), F.col("forum"), F.col("parsed"), reply_fields),
    })


def in_venue(venueid: Column, venue_id: Column) -> Column:
    """Drops mirrors of papers that belong to another venue."""
    return F.coalesce(venueid.startswith(venue_id), F.lit(False))


def matching_keys(df: DataFrame, parsed: Column,
                  parts: tuple[str, ...] = ("venue", "decision", "submission")) -> DataFrame:
    """One row per content key whose name holds one of the parts, with the value's text."""
    keys = df.select("*", F.explode_outer(C.entries(parsed)).alias("key", "entry"))
    wanted = F.lower("key").rlike("|".join(parts))
    return keys.where(wanted).withColumn("value", F.col("entry.text")).drop("entry")
