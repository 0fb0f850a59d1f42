"""Reply chains within a forum."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadtables.functions import text as T
from threadtables.operators.classify import REPLY, REVIEW, SUBMISSION
from threadtables.session import stage

FORUM = ["venue_id", "forum"]
MAX_HOPS = 12
JOINS_PER_ROUND = 2


def _pointers(parts: DataFrame) -> DataFrame:
    """One row per note id that is there or answered: `at`, where one hop leads (NULL where the walk ends), `hops` made,
    whether `at` is a review (`found`), and whether an author reply answers the note (`start`).

    A review points at itself without a hop. Of several copies of a note the last one counts.
    """
    reply = F.col("part") == REPLY
    rows = parts.where((F.col("part") != SUBMISSION) & (~reply | ((F.col("replyto") != "") & (F.col("replyto") != F.col("forum")))))
    nodes = rows.groupBy(*FORUM, F.when(reply, F.col("replyto")).otherwise(F.col("id")).alias("node")).agg(
        F.max_by("replyto", F.when(~reply, F.struct("seq", "replyto"))).alias("next"),
        F.max(F.col("part") == REVIEW).alias("found"), F.max(reply).alias("start"),
    )
    return nodes.select(
        *FORUM, "node", F.when(F.col("found"), F.col("node")).otherwise(F.nullif("next", F.lit(""))).alias("at"),
        F.when(F.col("found"), 0).otherwise(1).alias("hops"), "found", "start")


def _doubled(pointers: DataFrame) -> DataFrame:
    """Pointers that go twice as far. A note that is not there ends a walk; a review that was found is kept.

    Ended rows join on their own node, so they spread over the partitions instead of meeting at NULL.
    """
    walking = ~F.col("p.found") & F.col("p.at").isNotNull()
    steps = pointers.withColumn("probe", F.when(~F.col("found") & F.col("at").isNotNull(), F.col("at")).otherwise(F.col("node"))).alias("p")
    meets = (
        (F.col("p.venue_id") == F.col("n.venue_id")) & (F.col("p.forum") == F.col("n.forum"))
        & (F.col("p.probe") == F.col("n.node")) & walking
    )
    ahead = pointers.select(*FORUM, "node", "at", "hops", "found").alias("n")
    return steps.join(ahead, meets, "left").select(
        "p.venue_id", "p.forum", "p.node", F.when(walking, F.col("n.at")).otherwise(F.col("p.at")).alias("at"),
        F.when(walking, F.col("p.hops") + F.col("n.hops")).otherwise(F.col("p.hops")).alias("hops"),
        F.when(walking, F.coalesce("n.found", F.lit(False))).otherwise(F.col("p.found")).alias("found"), "p.start")


def resolve_targets(parts: DataFrame, max_hops: int = MAX_HOPS) -> DataFrame:
    """(venue_id, forum, start, target): the review reached from `start`, the note an author reply answers.

    The walk is by notes, not replies, so many answers to one note are one row here. Each round lets every pointer go as
    far again as the one it points at, so `max_hops` notes are met in log2(max_hops) joins, and a written table ends
    every two of them; it stops as soon as no pointer of a start is open. A missing parent, the hop limit or a cycle end
    a chain: pointers in a cycle go on, but what they find lies beyond the limit.
    """
    replying = parts.where((F.col("part") == REPLY) & (F.col("replyto") != "") & (F.col("replyto") != F.col("forum")))
    if replying.isEmpty():
        return replying.select(*FORUM, F.col("replyto").alias("start"), F.lit(None).cast("string").alias("target"))
    open_forums = replying.select(*FORUM).distinct()
    pointers = stage(_pointers(parts.join(open_forums, FORUM, "left_semi")), "reply-pointers")
    rounds = max(0, max_hops - 1).bit_length()
    for k in range(0, rounds, JOINS_PER_ROUND):
        if pointers.where("start AND NOT found AND at IS NOT NULL").isEmpty():
            break
        for _ in range(min(JOINS_PER_ROUND, rounds - k)):
            pointers = _doubled(pointers)
        pointers = stage(pointers, "reply-pointers")
    reached = pointers.where(F.col("start") & F.col("found") & (F.col("hops") < max_hops))
    return reached.select(*FORUM, F.col("node").alias("start"), F.col("at").alias("target"))


def with_target(replies: DataFrame, targets: DataFrame) -> DataFrame:
    """Replies with the review they answer, NULL for those aimed at the whole forum, which are not looked up."""
    to_note = F.col("replyto").isNotNull() & (F.col("replyto") != F.col("forum"))
    rest = replies.where(~to_note).withColumn("target", F.lit(None).cast("string"))
    on = [F.col(f"r.{k}") == F.col(f"t.{k}") for k in FORUM] + [F.col("r.replyto") == F.col("t.start")]
    aimed = replies.where(to_note).alias("r").join(targets.alias("t"), on, "left").select("r.*", "t.target")
    return aimed.unionByName(rest)


def reply_parent(notes: DataFrame) -> DataFrame:
    """Every note with the first signature of the note it answers, NULL when there is none in the forum."""
    parents = notes.select(
        *FORUM, F.col("id").alias("parent_id"), T.first_signature(F.col("signatures")).alias("parent_signature")
    ).alias("p")
    on = [F.col(f"n.{k}") == F.col(f"p.{k}") for k in FORUM] + [F.col("n.replyto") == F.col("p.parent_id")]
    return notes.alias("n").join(parents, on, "left").select("n.*", "p.parent_signature")


def forum_notes(submissions: DataFrame, notes: DataFrame) -> DataFrame:
    """All notes of the forums of the given submissions."""
    return notes.join(submissions.select(*FORUM).distinct(), FORUM, "left_semi")
