"""From papers and landed profiles to the author table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadtables.operators import authors as A
from threadtables.operators.reshape import wide_history


def author_rows(papers: DataFrame, profiles: DataFrame, site: str, distinct: bool = False,
                keep_missing: bool = False) -> DataFrame:
    """Author rows with nested history for every author id of the papers.

    By default one row per id found, so merged profiles repeat; `distinct` keeps each profile once.
    """
    found = A.manifest_profiles(A.author_ids(papers), profiles, keep_missing)
    if keep_missing:
        found = found.withColumn("id", F.coalesce("id", "author_id"))
    if distinct:
        found = A.distinct_profiles(found.select("query_id", "id", "content"))
    return A.author_table(found, site)


def wide_authors(papers: DataFrame, profiles: DataFrame, site: str, distinct: bool = False,
                 width: int | None = None) -> DataFrame:
    return wide_history(author_rows(papers, profiles, site, distinct), width)
