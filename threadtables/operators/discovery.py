"""What is in the data: rating fields, note and profile keys, venue labels, examples, rating audit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadtables.functions import content as C
from threadtables.functions import fields as FL
from threadtables.functions import text as T
from threadtables.operators.classify import REVIEW
from threadtables.operators.threads import FORUM


def field_class(key: Column, rating_fields: list[str], text_fields: list[str] = FL.REVIEW_TEXT_FIELDS) -> Column:
    """What a review key is used for."""
    return F.when(key.isin(rating_fields), "rating").when(key.isin(text_fields), "text").otherwise("housekeeping")


def rating_field_counts(parts: DataFrame) -> DataFrame:
    """Every rating-like key of all reviews: reviews that have it, and its earliest place among them."""
    keys = parts.where(F.col("part") == REVIEW).select(
        "venue_id", F.posexplode(F.map_keys("scores")).alias("position", "field")
    )
    return keys.groupBy("venue_id", "field").agg(
        F.count(F.lit(1)).alias("n_reviews"), F.min("position").alias("position")
    )


def sample_rating_fields(parts: DataFrame, submissions: DataFrame) -> DataFrame:
    """Rating-like keys of one review: the first one of the first submission whose venue id is the venue itself."""
    sample = submissions.where(F.col("venueid") == F.col("venue_id")).groupBy("venue_id").agg(
        F.min_by("forum", F.struct("number", "forum")).alias("forum")
    )
    first = (
        parts.where(F.col("part") == REVIEW).join(sample, FORUM, "left_semi")
        .groupBy("venue_id").agg(F.min_by(F.map_keys("scores"), F.struct("seq", "id")).alias("keys"))
    )
    return first.select("venue_id", F.posexplode("keys").alias("position", "field"))


def discover_rating_fields(parts: DataFrame, venue_id: str, submissions: DataFrame | None = None,
                           default: list[str] = FL.DEFAULT_RATING_FIELDS) -> list[str]:
    """Rating fields of a venue as a list, in key order; the defaults when no review shows any.

    All reviews are looked at; with `submissions`, only the sample review of that venue.
    """
    mine = parts.where(F.col("venue_id") == venue_id)
    if submissions is None:
        found = rating_field_counts(mine)
    else:
        found = sample_rating_fields(mine, submissions.where(F.col("venue_id") == venue_id))
    rows = found.orderBy("position", "field").select("field").collect()
    return [r["field"] for r in rows] or list(default)


def rating_audit(classified: DataFrame, rating_fields: list[str], length: int = 60) -> DataFrame:
    """Every field of every review with its shortened value and its class."""
    fields = classified.where(F.col("kind") == REVIEW).select(
        *FORUM, F.col("id").alias("note_id"), T.handle(F.col("signature")).alias("reviewer"),
        F.explode_outer(C.entries(F.col("parsed"))).alias("field", "entry"),
    ).where("field IS NOT NULL")
    shown = F.when(F.col("entry").isNull(), "").otherwise(F.coalesce("entry.text", F.lit("None")))
    return fields.select(
        *FORUM, "note_id", "reviewer", "field", T.shortened(shown, length).alias("shown"),
        field_class(F.col("field"), rating_fields).alias("field_class"),
    )


def _last_invitation() -> Column:
    return F.coalesce(F.get("invitations", F.size("invitations") - 1), F.lit("?"))


def note_census(classified: DataFrame) -> DataFrame:
    """Notes per kind, last invitation and set of content keys."""
    keys = F.coalesce(F.array_join(F.array_sort(F.map_keys("parsed")), ","), F.lit(""))
    return classified.groupBy(
        "kind", "is_reply", _last_invitation().alias("invitation"), keys.alias("content_keys")
    ).agg(F.count(F.lit(1)).alias("notes"))


def note_listing(notes: DataFrame) -> DataFrame:
    """Every note with its signature, last invitation and content keys, `?` for what is missing."""
    parsed = C.parse(F.col("content"))
    return notes.select(
        *FORUM, "id", "number", "replyto",
        F.coalesce(F.get("signatures", F.lit(0)), F.lit("?")).alias("signature"),
        _last_invitation().alias("invitation"),
        F.coalesce(F.array_join(F.map_keys(parsed), ","), F.lit("")).alias("content_keys"),
    )


def first_of_kind(classified: DataFrame, order: list[str]) -> DataFrame:
    """The first note of each kind as an example."""
    place = F.struct(*order)
    example = F.struct("forum", "id", "signature", F.array_join(F.map_keys("parsed"), ",").alias("content_keys"))
    return classified.groupBy("kind").agg(F.min_by(example, place).alias("first")).select("kind", "first.*")


def first_examples(classified: DataFrame, order: list[str]) -> DataFrame:
    """The first note of each kind, and the first author reply, with all its content: one row per key."""
    kinds = F.when(F.col("is_reply"), F.array("kind", F.lit("author_reply"))).otherwise(F.array("kind"))
    example = F.struct("forum", "id", F.coalesce(F.get("signatures", F.lit(0)), F.lit("?")).alias("signature"), F.map_entries(C.entries(F.col("parsed"))).alias("entries"))
    first = classified.select("*", F.explode(kinds).alias("example_of")).groupBy("example_of").agg(F.min_by(example, F.struct(*order)).alias("first"))
    rows = first.select(F.col("example_of").alias("kind"), "first.forum", "first.id", "first.signature", F.posexplode("first.entries").alias("position", "entry"))
    shown = F.when(F.col("entry.value").isNull(), "").otherwise(F.coalesce("entry.value.text", F.lit("None")))
    return rows.select("kind", "forum", "id", "signature", "position", F.col("entry.key").alias("key"), shown.alias("value"))


def key_census(objects: DataFrame, content: str, example_length: int = 300) -> DataFrame:
    """Keys of a column of JSON objects: how many rows have each, and the smallest start of its JSON text."""
    keys = objects.select(F.explode(C.parse(F.col(content))).alias("key", "value"))
    return keys.groupBy("key").agg(
        F.count(F.lit(1)).alias("rows"), F.min(F.left(F.to_json("value"), F.lit(example_length))).alias("example")
    )


def venue_label_counts(submissions: DataFrame, labels: DataFrame) -> DataFrame:
    """Submissions per (venue_id, venue_label) of the given labels, 0 for a label nobody has."""
    counts = submissions.groupBy("venue_id", F.col("venue").alias("venue_label")).agg(
        F.count(F.lit(1)).alias("submissions")
    )
    return labels.select("venue_id", "venue_label").distinct().join(counts, ["venue_id", "venue_label"], "left").select(
        "venue_id", "venue_label", F.coalesce("submissions", F.lit(0).cast("bigint")).alias("submissions")
    )
