"""A Spark data source over landed quotes: one folder a day, CSV files with a header in each.

    spark.dataSource.register(landed.LandedQuotes)
    spark.read.format("landed_quotes").option("path", ...).load().filter("price_date >= '2001-06-01'")

Filters on price_date choose the folders that are listed and opened (with spark.sql.python.filterPushdown.enabled).
Tasks read byte ranges: a task owns the lines that start within its ranges, so that large files are split.
"""

from __future__ import annotations

import datetime as dt
import io
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual
from pyspark.sql.types import StructType

FOLDER = "price_date="
_FIRST, _LAST = dt.date.min, dt.date.max
_ONE = dt.timedelta(days=1)


def land(quotes: DataFrame, path: str) -> None:
    """Write stock_code, close_price, volume, source by day of price_date, as sources leave them."""
    columns = ["stock_code", "close_price", "volume", "source", "price_date"]
    parts = int(quotes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    quotes.select(*columns).repartition(parts, "price_date").write.partitionBy("price_date").option("header", True).csv(path)


class Ranges(InputPartition):
    """(day, file, from, to, size) of each byte range that a task reads."""

    def __init__(self, ranges: list[tuple[dt.date, str, int, int, int]]):
        super().__init__(None)
        self.ranges = ranges


class LandedQuotes(DataSource):
    """Options: path, a folder that executors see; range_bytes, what a task reads, about."""

    @classmethod
    def name(cls) -> str:
        return "landed_quotes"

    def schema(self) -> str:
        return "stock_code string, price_date date, close_price double, volume bigint, source string"

    def reader(self, schema: StructType) -> LandedReader:
        return LandedReader(self.options["path"], int(self.options.get("range_bytes", 16 << 20)))


class LandedReader(DataSourceReader):
    """Codes are trimmed and in upper case; numbers that do not parse are null; lines hold no line ends within."""

    def __init__(self, path: str, range_bytes: int):
        self.path, self.range_bytes = path, range_bytes
        self.low, self.high, self.days = _FIRST, _LAST, None

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:  # noqa: N802
        for f in filters:
            value = getattr(f, "value", None)
            if f.attribute != ("price_date",) or not (isinstance(f, IsNotNull) or isinstance(value, dt.date) or isinstance(f, In)):
                yield f
            elif isinstance(f, EqualTo):
                self.low, self.high = max(self.low, value), min(self.high, value)
            elif isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                self.low = max(self.low, value + _ONE if isinstance(f, GreaterThan) and value < _LAST else value)
            elif isinstance(f, (LessThan, LessThanOrEqual)):
                self.high = min(self.high, value - _ONE if isinstance(f, LessThan) and value > _FIRST else value)
            elif isinstance(f, In):
                self.days = set(f.value) if self.days is None else self.days & set(f.value)
            elif not isinstance(f, IsNotNull):
                yield f

    def _wanted(self, day: dt.date) -> bool:
        return self.low <= day <= self.high and (self.days is None or day in self.days)

    def partitions(self) -> list[InputPartition]:
        from pyarrow import fs

        files, root = fs.FileSystem.from_uri(self.path)
        tasks, held, room = [], [], self.range_bytes
        for folder in sorted(files.get_file_info(fs.FileSelector(root)), key=lambda i: i.path):
            if not folder.base_name.startswith(FOLDER) or not self._wanted(day := dt.date.fromisoformat(folder.base_name.removeprefix(FOLDER))):
                continue
            for info in sorted(files.get_file_info(fs.FileSelector(folder.path)), key=lambda i: i.path):
                if info.base_name.startswith(("_", ".")) or not info.size:
                    continue
                at = 0
                while at < info.size:
                    upto = min(info.size, at + room)
                    held.append((day, info.path, at, upto, info.size))
                    room -= upto - at
                    at = upto
                    if room <= 0:
                        tasks.append(Ranges(held))
                        held, room = [], self.range_bytes
        return [*tasks, Ranges(held)]  # a last one, maybe empty

    def read(self, partition: Ranges) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        files, _ = fs.FileSystem.from_uri(self.path)
        for day, path, start, stop, size in partition.ranges:
            data = _own_lines(files, path, start, stop, size)
            if data:
                yield _batch(data, day)


def _own_lines(files, path: str, start: int, stop: int, size: int) -> bytes:
    """The lines that start in [start, stop), without the file's header."""
    with files.open_input_file(path) as f:
        f.seek(max(start - 1, 0))
        data = f.read(stop - max(start - 1, 0))
        cut = data.find(b"\n") + 1  # past the header, or past the line that an earlier range owns
        if not cut:
            return b""
        data = data[cut:]
        while data and not data.endswith(b"\n") and stop < size:
            more = f.read(min(1 << 16, size - stop))
            end = more.find(b"\n") + 1
            data, stop = data + (more[:end] if end else more), stop + len(more)
            if end:
                break
    return data


def _batch(data: bytes, day: dt.date) -> pa.RecordBatch:
    import pyarrow.compute as pc
    from pyarrow import csv

    names = ["stock_code", "close_price", "volume", "source"]
    table = csv.read_csv(io.BytesIO(data), read_options=csv.ReadOptions(column_names=names), convert_options=csv.ConvertOptions(column_types=dict.fromkeys(names, pa.string()), strings_can_be_null=True))

    def number(column: pa.ChunkedArray, pattern: str, kind: pa.DataType) -> pa.ChunkedArray:
        return pc.if_else(pc.fill_null(pc.match_substring_regex(column, pattern), False), column, None).cast(kind)

    close, volume = number(table["close_price"], r"^[+-]?\d+(\.\d*)?([eE][+-]?\d+)?$", pa.float64()), number(table["volume"], r"^[+-]?\d{1,18}$", pa.int64())
    days = pa.array([day], pa.date32()).take(pa.array([0] * table.num_rows, pa.int32()))
    arrays = [pc.utf8_upper(pc.utf8_trim_whitespace(table["stock_code"])), days, close, volume, table["source"]]
    return pa.RecordBatch.from_arrays([a.combine_chunks() if isinstance(a, pa.ChunkedArray) else a for a in arrays], ["stock_code", "price_date", "close_price", "volume", "source"])
