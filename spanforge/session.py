"""Session defaults and tables that cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: What the engine expects of a session; a cluster sets its own sizes.
DEFAULTS = {"spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", "spark.sql.session.timeZone": "UTC"}


def session(name: str = "spanforge", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    for k, v in (DEFAULTS | conf).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def durable(df: DataFrame) -> DataFrame:
    """The table, kept in the checkpoint folder that all executors share; loops cut their lineage here.

    The folder is the session's spark.checkpoint.dir; a temporary one is set only where there is none. Joins with the table
    are merges: it keeps the estimate of the files that it came from, and what these pack in a few bytes a row looks small
    enough to be sent whole to the driver."""
    folder(df.sparkSession)
    return df.checkpoint().hint("merge")


def kept(df: DataFrame) -> DataFrame:
    """The table, written once as Parquet below the checkpoint folder, for steps that read it several times: what it costs to make is paid once."""
    path = f"{folder(df.sparkSession)}/kept-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def folder(spark: SparkSession) -> str:
    """The checkpoint folder; a temporary one is set on one machine alone."""
    context = spark.sparkContext
    if not (spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()):
        if not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="spanforge-"))
    return context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir")
