"""Facts stored between layers: prices, indicators and snapshots are derived once in a session and then read."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_STORED: dict[tuple[str, str, str], tuple[str, tuple]] = {}
_COUNTED: dict[tuple[str, str, str], tuple[int, tuple]] = {}


def _folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; else a temporary one of a local master, or one in the warehouse."""
    path = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    master = spark.sparkContext.master
    if master == "local" or master.startswith("local["):
        path = "file://" + tempfile.mkdtemp(prefix="tapeweave-facts-")
    else:
        path = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_tapeweave"
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def short_shuffles(spark: SparkSession) -> None:
    """Shuffle files go when the query that wrote them ends, for the session and for good; else those of every fact and step stay until the driver collects garbage."""
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def _state(spark: SparkSession, folder: str) -> tuple:
    """Names, sizes and times of what is in a folder; () if there is none."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in files.listStatus(path))) if files.exists(path) else ()


def stored(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame], *, sort: tuple[str, ...] = ("stock_id", "price_date")) -> DataFrame:
    """The fact table `name` over the tables in sf_dir: built and written once in an application, sorted by
    instrument and day (without `sort` as its rows come), then read with pruned columns and pushed filters. It is built anew when tables in
    sf_dir have other sizes or times than they had; refresh() forgets what was stored."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    state = _state(spark, sf_dir)
    if key not in _STORED or _STORED[key][1] != state:
        path = f"{_folder(spark)}/facts/{uuid.uuid4().hex}/{name}"
        short_shuffles(spark)
        rows = build()
        (rows.sortWithinPartitions(*sort) if sort else rows).write.parquet(path)
        _STORED[key] = (path, state)
    return spark.read.parquet(_STORED[key][0])


def counted(spark: SparkSession, sf_dir: str, name: str) -> int:
    """Rows of a table in sf_dir, which Spark reads from the files' footers, once in an application while the tables are as they are."""
    key, state = (spark.sparkContext.applicationId, sf_dir, name), _state(spark, sf_dir)
    if key not in _COUNTED or _COUNTED[key][1] != state:
        _COUNTED[key] = (spark.read.parquet(f"{sf_dir}/{name}.parquet").count(), state)
    return _COUNTED[key][0]


def landing(spark: SparkSession, sf_dir: str, land: Callable[[str], None]) -> str:
    """A folder that land(path) has filled once in an application, for the tables in sf_dir as they are."""
    key, state = (spark.sparkContext.applicationId, sf_dir, "landing"), _state(spark, sf_dir)
    if key not in _STORED or _STORED[key][1] != state:
        path = f"{_folder(spark)}/landing/{uuid.uuid4().hex}"
        land(path)
        _STORED[key] = (path, state)
    return _STORED[key][0]


def cut_lineage(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder, and read from there."""
    path = f"{_folder(df.sparkSession)}/steps/{uuid.uuid4().hex}/{name}"
    short_shuffles(df.sparkSession)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written = path
    return out


def dropped(df: DataFrame) -> None:
    """Delete a table of cut_lineage() that nothing reads any more."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df._written)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def refresh(sf_dir: str | None = None) -> None:
    """Forget the facts over sf_dir, or all; the next query derives them again."""
    for key in [k for k in _STORED if sf_dir is None or k[1] == sf_dir]:
        del _STORED[key]
