"""The folder for staged tables of a session that names none, as in tests and benches on one machine."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def give_work_dir(spark: SparkSession) -> None:
    context = spark.sparkContext
    if spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir():
        return
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="threadtables-"))
