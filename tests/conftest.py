import json
import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from threadtables.sources import schemas  # noqa: E402

VENUE = "Conf.cc/2030/Main"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]").appName("threadtables-tests")
        .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g").config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("staged")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def note(forum, note_id, role, seq, content=None, replyto="root", cdate=None, invitation=None, number=None,
         venue=VENUE):
    """A landed note. `role` is the end of the signature; `replyto` defaults to the forum's root."""
    group = f"{venue}/Submission1/"
    signatures = None if role is None else [f"{venue}/{role}" if role == "Program_Chairs" else group + role]
    if invitation is None:
        invitation = "Official_Review" if role and role.startswith("Reviewer") else "Official_Comment"
    return (venue, forum, note_id, number, forum if replyto == "root" else replyto, cdate, seq, signatures,
            [f"{venue}/-/{invitation}"], json.dumps(content) if isinstance(content, dict) else content)


def root(forum, number=1, venue_id=VENUE, **content):
    fields = {"title": {"value": f"Paper {forum}"}, "venueid": {"value": venue_id}, "venue": {"value": "Main Oral"}}
    fields.update({k: {"value": v} for k, v in content.items()})
    return note(forum, forum, "Authors", -1, fields, None, None, "Submission", number, venue_id)


def notes_df(spark, rows):
    return spark.createDataFrame(rows, schemas.NOTES)


def as_dicts(df, *order):
    return [r.asDict(recursive=True) for r in (df.orderBy(*order) if order else df).collect()]
