"""Folder that all executors share, tables written there to cut lineage, and names that clash with none."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of a table that may be broadcast, as its rows count with `row_bytes` each; beyond, Spark shuffles both sides.
BROADCAST_BYTES = 16 << 20
#: Bytes in an Arrow batch: whole texts, so few rows.
BATCH_BYTES = 2 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; where that is unset, one that all executors see.

    With a local master driver and executors are one machine, so a new temporary folder will do; on a
    cluster it is one within the warehouse.
    """
    key = "spark.checkpoint.dir"
    path = spark.sparkContext.getConf().get(key) or spark.conf.get(key, None)
    if not path:
        master = spark.sparkContext.master
        local = master == "local" or master.startswith("local[")
        path = "file://" + tempfile.mkdtemp(prefix="tapeweave-") if local else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_tapeweave"
        spark.conf.set(key, path)
    return path.rstrip("/")


def small_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes, for the session and for good; a lower bound of the user's stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(key).rstrip("b")) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def short_shuffles(spark: SparkSession) -> None:
    """Shuffle files go when the query that wrote them ends, for the session and for good; else they stay until the driver collects garbage."""
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


#: Lists of scratch() that are open: each holds the tables written since.
_scratch: list[list[DataFrame]] = []


@contextmanager
def scratch() -> Iterator[list[DataFrame]]:
    """A list of the tables of written() that are made within and not deleted there."""
    made: list[DataFrame] = []
    _scratch.append(made)
    try:
        yield made
    finally:
        _scratch[:] = [m for m in _scratch if m is not made]


def written(df: DataFrame, tag: str) -> DataFrame:
    """Write df as Parquet in the shared folder and return a scan of it."""
    spark = df.sparkSession
    small_batches(spark)
    short_shuffles(spark)
    path = f"{shared_dir(spark)}/tables/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written = path
    for made in _scratch:
        made.append(out)
    return out


def dropped(*tables: DataFrame) -> None:
    """Delete tables of written() that nothing reads any more."""
    for df in tables:
        for made in _scratch:
            made[:] = [t for t in made if t._written != df._written]
        jvm, spark = df.sparkSession._jvm, df.sparkSession
        path = jvm.org.apache.hadoop.fs.Path(df._written)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def small_side(df: DataFrame, rows: int, row_bytes: int = 16) -> DataFrame:
    """Mark df, of so many rows and bytes a row, for broadcast if it is within BROADCAST_BYTES; otherwise Spark shuffles it."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df


def free(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores put on until none is a column of df; case counts for nothing, as in Spark."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def aside(df: DataFrame, *added: str) -> tuple[DataFrame, list[tuple[str, str]]]:
    """(df with columns c0, c1, ..., which no operator adds; [(c0, its name), ...] of those that stay beside the added ones)."""
    gone = {n.lower() for n in added}
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))]), [(f"c{i}", c) for i, c in enumerate(df.columns) if c.lower() not in gone]


def at(df: DataFrame, name: str) -> str:
    """The column of aside(df) that holds df's column of that name; where case alone tells several apart, that of the same case."""
    same = [i for i, c in enumerate(df.columns) if c == name] or [i for i, c in enumerate(df.columns) if c.lower() == name.lower()]
    return f"c{same[0]}"


def quoted(name: str) -> str:
    """A column's name as Spark's parser takes it, dots and blanks included."""
    return "`" + name.replace("`", "``") + "`"
