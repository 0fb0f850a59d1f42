"""Decision buckets: which bucket a submission belongs to, how many are taken, which are dropped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadtables.functions import content as C
from threadtables.functions import text as T
from threadtables.operators.classify import in_venue
from threadtables.operators.skew import group_rank
from threadtables.operators.threads import FORUM
from threadtables.session import stage

# Counts of the histogram that finds where the first n of a bucket end.
BINS = 1024


def is_reject(decision: Column) -> Column:
    return F.lower(decision).startswith("reject")


def buckets_from_groups(groups: DataFrame) -> DataFrame:
    """Venue groups (venue_id, content JSON) -> one row per bucket, in map order.

    The heading map must be wrapped: a plain object gives no buckets. The rejected venue id may be either.
    """
    content = F.col("content")
    # taken as JSON text: a VARIANT would sort the headings
    headings = F.from_json(F.get_json_object(content, "$.decision_heading_map.value"), "map<string,string>")
    parsed = groups.select("venue_id", C.parse(content).alias("parsed"), headings.alias("headings"))
    return parsed.select(
        "venue_id",
        F.nullif(C.content_value(F.col("parsed"), "rejected_venue_id"), F.lit("")).alias("rejected_venueid"),
        F.posexplode(F.map_entries("headings")).alias("ord", "entry"),
    ).select("venue_id", "ord", F.col("entry.key").alias("venue_label"), F.col("entry.value").alias("decision"),
             "rejected_venueid")


def _routes(buckets: DataFrame) -> DataFrame:
    """How each bucket finds its submissions: rejects by venue id when the venue has one, others by label."""
    by_id = is_reject(F.col("decision")) & F.col("rejected_venueid").isNotNull()
    return buckets.select(
        F.col("venue_id").alias("route_venue"),
        "ord",
        F.col("decision").alias("bucket"),
        is_reject(F.col("decision")).alias("is_reject"),
        by_id.alias("by_id"),
        F.when(by_id, F.col("rejected_venueid")).otherwise(F.col("venue_label")).alias("route_key"),
    )


def bucket_candidates(submissions: DataFrame, buckets: DataFrame) -> DataFrame:
    """Submissions of the venue with every bucket they match (`bucket`, `ord`, `is_reject`).

    `submissions` needs venue_id, forum, venue, venueid. Both keys of a submission meet the buckets in one join. A venue
    has few buckets: they are written first, so that their size is known when the join is planned, and submissions need
    not meet at the keys of their buckets.
    """
    keys = F.array(
        F.struct(F.lit(False).alias("by_id"), F.col("venue").alias("route_key")),
        F.struct(F.lit(True).alias("by_id"), F.col("venueid").alias("route_key")),
    )
    # a NULL array gives no rows: unlike a filter, this is not pushed below the parsing of the content
    own = F.when(in_venue(F.col("venueid"), F.col("venue_id")), keys)
    keyed = submissions.select("*", F.inline(own)).alias("s")
    routes = stage(_routes(buckets), "routes").alias("b")
    on = (
        (F.col("s.venue_id") == F.col("b.route_venue")) & (F.col("s.by_id") == F.col("b.by_id"))
        & (F.col("s.route_key") == F.col("b.route_key"))
    )
    return keyed.join(routes, on).select("s.*", "b.bucket", "b.ord", "b.is_reject").drop("by_id", "route_key")


def _bin(number: Column, lo: Column, hi: Column) -> Column:
    """Which of BINS equal parts of lo..hi a number falls into; no number comes first."""
    part = F.floor((number.cast("double") - lo) / (hi - lo) * BINS)
    return F.when(number.isNull(), -1).when(hi > lo, F.least(part, F.lit(BINS - 1))).otherwise(0)


def top_n_per_bucket(candidates: DataFrame, n: int) -> DataFrame:
    """The first n candidates of each bucket by number, then id.

    A histogram of each bucket's numbers, BINS counts at most, tells the bin in which its n-th candidate lies. What falls
    into earlier bins is taken, and only the rows of that bin are ranked, on a path that takes groups of any size.
    """
    keys, columns = ["venue_id", "ord"], candidates.columns
    rows = stage(candidates, "candidates")
    ends = rows.groupBy(*keys).agg(F.min("number").cast("double").alias("_lo"), F.max("number").cast("double").alias("_hi"))
    ends = stage(ends, "ends")  # as large as the buckets, and known to be when it is joined
    placed = lambda table: rows.join(table, keys).withColumn("_bin", _bin(F.col("number"), F.col("_lo"), F.col("_hi")))
    counts = placed(ends).groupBy(*keys, "_lo", "_hi", "_bin").agg(F.count(F.lit(1)).alias("_rows"))
    # the counts are added up in order until they reach n; a bucket of fewer rows is taken whole
    start = F.struct(F.lit(None).cast("bigint").alias("cut"), F.lit(0).cast("bigint").alias("before"))
    step = lambda at, x: (
        F.when(at["cut"].isNotNull(), at)
        .when(at["before"] + x["_rows"] >= n, F.struct(x["_bin"].alias("cut"), at["before"].alias("before")))
        .otherwise(F.struct(at["cut"].alias("cut"), (at["before"] + x["_rows"]).alias("before"))))
    listed = F.array_sort(F.collect_list(F.struct(F.col("_bin").cast("bigint").alias("_bin"), "_rows")))
    cuts = counts.groupBy(*keys, "_lo", "_hi").agg(F.aggregate(listed, start, step).alias("_at"))
    cuts = stage(cuts.select(*keys, "_lo", "_hi", F.coalesce("_at.cut", F.lit(BINS)).alias("_cut"), F.col("_at.before").alias("_before")), "cuts")
    found = placed(cuts)
    edge = group_rank(found.where("_bin = _cut").select(*columns, "_before"), keys, ["number", "forum"], "_n")
    return found.where("_bin < _cut").select(*columns).unionByName(edge.where(F.col("_n") <= n - F.col("_before")).select(*columns))


def drop_reject_without_reviews(candidates: DataFrame, review_counts: DataFrame) -> DataFrame:
    """Reject candidates need a review; others stay. Adds `n_reviews`."""
    counted = candidates.join(review_counts.select(*FORUM, "n_reviews"), FORUM, "left").withColumn(
        "n_reviews", F.coalesce("n_reviews", F.lit(0).cast("bigint"))
    )
    return counted.where(~(F.col("is_reject") & (F.col("n_reviews") == 0)))


def first_bucket(candidates: DataFrame) -> DataFrame:
    """A forum listed in several buckets keeps the first one in map order."""
    w = Window.partitionBy(*FORUM).orderBy("ord")
    return candidates.withColumn("_n", F.row_number().over(w)).where(F.col("_n") == 1).drop("_n")


def output_bucket(bucket: Column, type_: Column) -> Column:
    """The group a paper is written under."""
    return F.coalesce(F.nullif(bucket, F.lit("")), type_)


def bucket_counts(papers: DataFrame) -> DataFrame:
    """Papers and widest paper per output bucket; `papers` needs bucket, type and n_reviews."""
    group = output_bucket(F.col("bucket"), F.col("type"))
    return (
        papers.groupBy("venue_id", group.alias("bucket"))
        .agg(F.count(F.lit(1)).alias("papers"), F.max("n_reviews").alias("max_reviews"))
        .withColumn("bucket_slug", T.bucket_slug(F.col("bucket")))
    )
