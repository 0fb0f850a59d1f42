"""Author ids of papers and the author table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadtables.functions import profile as P
from threadtables.functions import text as T
from threadtables.session import stage


def author_ids(papers: DataFrame) -> DataFrame:
    """Every author id once."""
    # an outer explode adds no size filter, which would be pushed down and compute the ids a second time
    ids = papers.select(F.explode_outer("author_ids").alias("author_id")).distinct()
    return ids.where("author_id IS NOT NULL")


def distinct_author_ids(papers: DataFrame) -> DataFrame:
    """Every author id once, sorted."""
    return author_ids(papers).orderBy("author_id")


def manifest_profiles(ids: DataFrame, profiles: DataFrame, keep_missing: bool = False) -> DataFrame:
    """Profiles of the requested ids. Two ids may lead to one profile; both rows stay."""
    how = "left" if keep_missing else "inner"
    return ids.join(profiles, ids["author_id"] == profiles["query_id"], how)


def missing_profiles(ids: DataFrame, profiles: DataFrame) -> DataFrame:
    """Requested ids without a profile; these are also the ones still to be landed."""
    return ids.join(profiles, ids["author_id"] == profiles["query_id"], "left_anti")


def merged_profiles(profiles: DataFrame) -> DataFrame:
    """query_id, profile: where each requested id ends, over any number of merges.

    An id leads to the profile it was merged into, which may have been merged again. Every round lets an id go as far
    again as the one it has reached, so chains of n merges take log2(n) joins. An id that was not requested ends a
    chain; ids merged in a circle are one profile, named by the smallest of them.
    """
    at = profiles.groupBy(F.coalesce("query_id", "id").alias("node")).agg(F.min("id").alias("at"))
    steps = stage(at.select("node", "at", (F.col("at") == F.col("node")).alias("done"), F.least("node", "at").alias("least")), "merges")
    before = None
    while True:
        state = steps.where("NOT done").agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("node", "least"), F.lit(1 << 40)))).first()
        if not state[0] or tuple(state) == before:
            break
        before = tuple(state)
        # ids that have ended join on themselves, so they spread over the partitions
        ahead = steps.select("node", F.col("at").alias("next"), F.col("done").alias("ends"), F.col("least").alias("low")).alias("n")
        probe = F.when(F.col("p.done"), F.col("p.node")).otherwise(F.col("p.at"))
        met = steps.alias("p").join(ahead, (probe == F.col("n.node")) & ~F.col("p.done"), "left")
        steps = stage(met.select(
            "p.node", F.coalesce("n.next", "p.at").alias("at"), (F.col("p.done") | F.coalesce("n.ends", F.lit(True))).alias("done"),
            F.least("p.least", "n.low").alias("least")), "merges")
    circle = steps.where("NOT done").select(F.col("node").alias("at"), F.col("least").alias("circle"))
    ended = steps.join(circle, "at", "left")  # what has not ended has reached its circle
    return ended.select(F.col("node").alias("query_id"), F.when(F.col("done"), F.col("at")).otherwise(F.col("circle")).alias("profile"))


def distinct_profiles(profiles: DataFrame) -> DataFrame:
    """One row per profile, merged ones over all hops: of the rows that lead to it directly the one with the smallest
    requested id, else of all its rows. `id` is the profile."""
    columns = profiles.columns
    keyed = profiles.withColumn("_node", F.coalesce("query_id", "id")).join(
        merged_profiles(profiles).withColumnRenamed("query_id", "_node"), "_node")
    first = F.min_by(F.struct(*columns), F.struct(F.col("id") != F.col("profile"), F.col("_node")))
    kept = keyed.groupBy("profile").agg(first.alias("p"))
    return kept.select(*(F.col("profile").alias(c) if c == "id" else F.col(f"p.{c}") for c in columns))


def author_table(profiles: DataFrame, site: str) -> DataFrame:
    """One row per profile: the four fixed columns and the nested history."""
    content = F.col("content")
    none = F.array().cast("array<struct<title:string,location:string,start:string,end:string>>")
    return profiles.select(
        T.profile_url(F.col("id"), site).alias("Link"),
        P.preferred_name(content["names"]).alias("Name"),
        P.personal_links(content).alias("Personal Links"),
        P.expertise(content["expertise"]).alias("Expertise"),
        F.coalesce(P.history_entries(content["history"]), none).alias("history"),
    )


def long_history(authors: DataFrame) -> DataFrame:
    """One row per history entry, numbered from 1 in the given order."""
    rows = authors.select("Link", "Name", F.posexplode("history").alias("pos", "entry"))
    return rows.select("Link", "Name", (F.col("pos") + 1).alias("history_idx"), "entry.*")
