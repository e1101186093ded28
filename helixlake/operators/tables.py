"""Tables: lineage cut in the shared folder, rows added or replaced, and checks of what is written."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors see; one is made up only on a single machine, for tests."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not where:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors see")
        where = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, *by: str) -> DataFrame:
    """df as a table in the shared folder, with a folder for each value of ``by``, read back: its lineage ends here."""
    path = scratch(df.sparkSession, name)
    (df.write.partitionBy(*by) if by else df.write).option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def cut(df: DataFrame) -> DataFrame:
    """df with its lineage cut at a checkpoint in the folder that spark.checkpoint.dir names."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def create(spark: SparkSession, name: str, schema: str, replace: bool = False) -> None:
    """An empty table of the schema, unless there is one; with ``replace`` a new one in any case."""
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet")


def insert(rows: DataFrame, name: str) -> None:
    """Append the rows by the names of their columns; columns that the table has and they lack are null."""
    spark = rows.sparkSession
    empty = spark.table(name).limit(0)
    empty.unionByName(rows, allowMissingColumns=True).select(*empty.columns).write.insertInto(name)


def attached(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A second database read only: the table ``name`` among the Parquet tables under another path."""
    return spark.read.parquet(f"{path.rstrip('/')}/{name}.parquet")
