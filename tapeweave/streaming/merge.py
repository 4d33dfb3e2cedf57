"""Key-wise merges that rewrite only what a batch touches, a lossless dedupe, and a high-water mark.

A BucketedTable keeps its rows in buckets by a hash of their key. A merge reads the buckets that the batch
has keys in, writes these anew beside the old ones, and then puts a new manifest in place: a small file that
names each bucket's folder and the last batch merged. Readers see the old version or the new one, never a
mixture. A merge that fails leaves folders that no manifest names; a batch that is run again is left out.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tapeweave.sources.readers import keep_one


class _Files:
    """Small files beside tables, by Hadoop's file systems: local, HDFS and object stores alike."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._fs = self._path("").getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str) -> list[str]:
        path = self._path(folder)
        return sorted(f.getPath().getName() for f in self._fs.listStatus(path)) if self._fs.exists(path) else []

    def read(self, name: str) -> dict:
        stream = self._fs.open(self._path(name))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def put(self, name: str, value: dict, *, over: bool = False) -> None:
        """Write a file whole, then give it its name; without `over` no such file may be there."""
        draft, target = self._path(f"drafts/{uuid.uuid4().hex}"), self._path(name)
        stream = self._fs.create(draft, True)
        stream.write(bytearray(json.dumps(value).encode()))
        stream.close()
        self._fs.mkdirs(target.getParent())
        if over:
            self._fs.delete(target, False)
        elif self._fs.exists(target):
            raise RuntimeError(f"{target} was written by another merge")
        if not self._fs.rename(draft, target):
            raise RuntimeError(f"{target} could not be written")

    def delete(self, name: str) -> None:
        self._fs.delete(self._path(name), True)


class BucketedTable:
    """A table of one row for each key at `path`, in `buckets` buckets; their number is fixed by the first merge."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: list[str], *, buckets: int = 64):
        self.spark, self.path, self.schema, self.keys, self.buckets = spark, path.rstrip("/"), schema, keys, buckets
        self._files = _Files(spark, self.path)

    def versions(self) -> list[int]:
        return [int(n.removesuffix(".json")) for n in self._files.names("versions") if n.endswith(".json")]

    def _state(self, version: int | None = None) -> dict:
        have = self.versions()
        if not have:
            return {"version": 0, "batch": -1, "buckets": self.buckets, "folders": {}}
        state = self._files.read(f"versions/{max(have) if version is None else version:012d}.json")
        if state["buckets"] != self.buckets:
            raise ValueError(f"the table has {state['buckets']} buckets, not {self.buckets}")
        return state

    def _rows(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{f}" for f in folders])

    def read(self, version: int | None = None) -> DataFrame:
        """All rows, of the newest version or of an older one that vacuum has left."""
        return self._rows(list(self._state(version)["folders"].values()))

    def merge(self, batch: DataFrame, *, number: int | None = None, newest: tuple[str, ...] = (), resets: dict[str, Column] | None = None) -> bool:
        """Put the batch's rows in place of those of the same key; False if batch `number` was merged before.

        Of rows of the batch that share a key the one greatest in `newest` stays, then the greatest in the other
        columns. resets: columns set in the batch's rows. One shuffle, by bucket, of the batch and the buckets it
        touches; nothing is read or written of others.
        """
        state = self._state()
        if number is not None and number <= state["batch"]:
            return False
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        new = batch.select(*self.schema.names).withColumns(resets or {}).withColumn("_bucket", bucket).persist()
        try:
            touched = sorted(r["_bucket"] for r in new.select("_bucket").distinct().collect())  # as many as buckets, at most
            if not touched:
                return False
            folder = f"data/{uuid.uuid4().hex}"
            old = self._rows([state["folders"][str(b)] for b in touched if str(b) in state["folders"]]).withColumn("_bucket", bucket)
            both = old.withColumn("_side", F.lit(0)).unionByName(new.withColumn("_side", F.lit(1))).repartition(min(len(touched), self.buckets), "_bucket")
            rest = [c for c in self.schema.names if c not in self.keys and c not in newest]
            kept = keep_one(both, ["_bucket", *self.keys], [F.col(c).desc_nulls_last() for c in ("_side", *newest, *rest)])
            kept.select(*self.schema.names, "_bucket").write.partitionBy("_bucket").parquet(f"{self.path}/{folder}")
        finally:
            new.unpersist()
        folders = {**state["folders"], **{str(b): f"{folder}/_bucket={b}" for b in touched}}
        version = state["version"] + 1
        self._files.put(f"versions/{version:012d}.json", {"version": version, "batch": state["batch"] if number is None else number, "buckets": self.buckets, "folders": folders})
        return True

    def vacuum(self, keep: int = 2) -> None:
        """Delete versions but the last `keep`, and folders that none of these names; no merge may run meanwhile."""
        have = self.versions()
        last = have[-keep:]
        used = {f.split("/")[1] + "/" + f.split("/")[2] for v in last for f in self._state(v)["folders"].values()}
        for version in have[: -keep or None]:
            if version not in last:
                self._files.delete(f"versions/{version:012d}.json")
        for folder in self._files.names("data"):
            parts = [n for n in self._files.names(f"data/{folder}") if n.startswith("_bucket=")]
            live = [n for n in parts if f"{folder}/{n}" in used]
            for name in set(parts) - set(live):
                self._files.delete(f"data/{folder}/{name}")
            if not live:
                self._files.delete(f"data/{folder}")
        self._files.delete("drafts")


def merge_batches(stream: DataFrame, table: BucketedTable, checkpoint: str, *, newest: tuple[str, ...] = (), resets: dict[str, Column] | None = None, prepare: Callable[[DataFrame], DataFrame] = lambda df: df):
    """Run the stream over what is there and merge each micro-batch into the table; replayed batches change nothing."""

    def merge(batch: DataFrame, number: int) -> None:
        table.merge(prepare(batch), number=number, newest=newest, resets=resets)

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


class _FirstSeen(StatefulProcessor):
    """Lets the first row of each key pass, and remembers the key for so many milliseconds."""

    def __init__(self, order: list[str], keep_ms: int):
        self.order, self.keep_ms = order, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "seen boolean", self.keep_ms or None)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        if self.seen.exists():
            for _ in rows:
                pass
            return
        first = None
        for frame in rows:
            frame = frame if first is None else pd.concat([first, frame])
            first = frame.sort_values(self.order, kind="stable").head(1)
        self.seen.update((True,))
        yield first

    def close(self) -> None:
        pass


def once_each(events: DataFrame, *, key: str = "event_id", order: tuple[str, ...] = ("ts",), keep_ms: int = 0) -> DataFrame:
    """A stream of events without repeated keys; no row is lost for being late.

    State holds a flag for each key, partitioned by key: for keep_ms after it was first seen, or for good if 0.
    Of rows of a key in one batch the least by `order` passes. The session must use a state store that
    expires state (RocksDB).
    """
    return events.groupBy(key).transformWithStateInPandas(_FirstSeen(list(order), keep_ms), events.schema, "Append", "ProcessingTime" if keep_ms else "None")


class HighWaterMark:
    """The greatest value of a column that was handled, kept in a small file."""

    def __init__(self, spark: SparkSession, path: str):
        self._files = _Files(spark, path)

    def get(self) -> str | None:
        return self._files.read("mark.json")["mark"] if "mark.json" in self._files.names("") else None

    def run(self, df: DataFrame, column: str, work: Callable[[DataFrame], None]) -> bool:
        """work(rows at or after the mark), then move the mark to their greatest value; False if there are none.

        Rows at the mark are handled again, as more of the same value may have come: work must bear that, as
        merges by key do. If work fails the mark stays, and the next run sees the same rows and more.
        """
        mark = self.get()
        kind = df.schema[column].dataType.simpleString()
        rows = df if mark is None else df.filter(F.col(column) >= F.lit(mark).cast(kind))
        last = rows.agg(F.max(column).cast("string")).first()[0]
        if last is None:
            return False
        work(rows.filter(F.col(column) <= F.lit(last).cast(kind)))
        if last != mark:
            self._files.put("mark.json", {"mark": last}, over=True)
        return True
