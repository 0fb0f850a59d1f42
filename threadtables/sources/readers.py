"""Reads landed notes, venue groups, profiles, and tables written before. A line that is not JSON stops the read."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadtables.sources import schemas
from threadtables.sources.csv_records import records


#: Broken lines are an error, in batch and in streams; else they would become rows of NULLs.
STRICT = {"mode": "FAILFAST"}


def _json(spark: SparkSession, schema: str, path: str) -> DataFrame:
    return spark.read.schema(schema).options(**STRICT).json(path)


def scan_notes(spark: SparkSession, path: str) -> DataFrame:
    """Landed notes as JSON lines; `content` may be an object or a string holding one, and is kept as JSON text."""
    return _json(spark, schemas.NOTES, path)


def scan_groups(spark: SparkSession, path: str) -> DataFrame:
    return _json(spark, schemas.GROUPS, path)


def scan_profiles(spark: SparkSession, path: str) -> DataFrame:
    """Landed profiles; a row without `query_id` was asked for by its own id."""
    return with_query_id(_json(spark, schemas.PROFILES, path))


def with_query_id(profiles: DataFrame) -> DataFrame:
    return profiles.withColumn("query_id", F.coalesce(F.nullif("query_id", F.lit("")), F.col("id")))


def scan_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The author ids of a paper run; reading fails when the folder is missing."""
    return _json(spark, "author_id string", path)


def scan_nested_papers(spark: SparkSession, path: str) -> DataFrame:
    """Nested papers from JSON lines, with defaults for keys that an older file lacks."""
    papers = _json(spark, schemas.PAPERS_NESTED, path)
    texts = ["keywords", "abstract", "primary_area", "meta_review_text", "meta_reviewer_handle", "general_response",
             "bucket"]
    defaults = {c: F.coalesce(c, F.lit("")) for c in texts}
    defaults["author_ids"] = F.coalesce("author_ids", F.array().cast("array<string>"))
    defaults["reviews"] = F.coalesce("reviews", F.array().cast(f"array<{schemas.REVIEW}>"))
    return papers.withColumns(defaults)


#: How text tables are written: quotes are doubled, lines end with a line feed.
CSV = {"quote": '"', "escape": '"', "multiLine": True, "lineSep": "\n", "maxColumns": 1_000_000}


def read_text_csv(spark: SparkSession, path: str, whole_bytes: int = 128 << 20) -> DataFrame:
    """A CSV table of text cells; empty cells come back as ''. Every file starts with the same header.

    Files of up to `whole_bytes` are read by one task each. If one is larger, its records are found first, so that many
    tasks read it. An empty line is an empty cell of a table of one column, else nothing.
    """
    whole = spark.read.options(header=True, inferSchema=False, **CSV).csv(path)
    names = whole.columns
    largest = spark.read.format("binaryFile").load(path).agg(F.max("length")).first()[0] or 0
    if largest <= whole_bytes and len(names) > 1:
        return _filled(whole)
    rows = records(spark, path)
    if len(names) > 1:
        rows = rows.where("text <> ''")
    schema = ", ".join("`" + n.replace("`", "``") + "` string" for n in names)
    options = {k: str(v).lower() if isinstance(v, bool) else str(v) for k, v in CSV.items()}
    return _filled(rows.select(F.from_csv("text", F.lit(schema), options).alias("cells")).select("cells.*"))


def _filled(df: DataFrame) -> DataFrame:
    """Text columns with '' for NULL."""
    return df.na.fill("")


def read_text_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def union_ragged(tables: list[DataFrame]) -> DataFrame:
    """All rows of tables of different width; a missing column is ''."""
    return _filled(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables))
