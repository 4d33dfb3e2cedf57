"""Readers with declared schemas; files that break their contract raise errors."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tapeweave.functions.scalars import is_unknown_sector, standard_code
from tapeweave.schemas import require_columns

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scan(df: DataFrame, order: list[str], limit: int | None = None, offset: int = 0) -> DataFrame:
    """A page of a table in a stated order."""
    out = df.orderBy(*order).offset(offset)
    return out if limit is None else out.limit(limit)


def read_quotes(spark: SparkSession, path: str, source: str) -> DataFrame:
    """Landed live quotes (CSV with a header): one row for each code, the first of the file.

    Rows without code or price go; codes are trimmed and in upper case; numbers that do not parse are null.
    """
    raw = spark.read.csv(path, header=True, schema="Ticker string, Name string, Volume string, Price string, Change string").withColumn("_at", F.monotonically_increasing_id())
    number = lambda c: F.expr(f"try_cast(replace({c}, ',', '') as double)")
    rows = raw.select(F.upper(F.trim("Ticker")).alias("stock_code"), F.col("Name").alias("company_name"), number("Price").alias("close_price"), number("Volume").cast("long").alias("volume"), number("Change").alias("price_change_amount"), "_at")
    rows = rows.filter((F.col("stock_code") != "") & F.col("close_price").isNotNull())
    first = F.row_number().over(Window.partitionBy("stock_code").orderBy("_at"))
    return rows.withColumn("_n", first).filter("_n = 1").drop("_n", "_at").withColumn("source", F.lit(source))


def read_history(spark: SparkSession, path: str, start: str, end: str, source: str) -> DataFrame:
    """Landed history (CSV): rows of [start, end], the last of the file for each code and date."""
    raw = spark.read.csv(path, header=True, schema="stock_code string, price_date date, close_price double, volume long").withColumn("_at", F.monotonically_increasing_id())
    rows = raw.filter(F.col("price_date").between(start, end)).withColumn("stock_code", F.upper(F.trim("stock_code")))
    return keep_one(rows, ["stock_code", "price_date"], [F.col("_at").desc()]).drop("_at").withColumn("source", F.lit(source))


def keep_one(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key in the order given."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_n = 1").drop("_n")


@dataclass(frozen=True)
class Capabilities:
    """What a source gives: live quotes, history, fields, and how many instruments a call may ask for."""

    live: bool = False
    history: bool = False
    volume: bool = True
    batch_limit: int | None = None


@dataclass(frozen=True)
class Source:
    """A named source of landed files: fetch(spark, path, start, end) gives rows of the quotes' or the history's schema."""

    name: str
    capabilities: Capabilities

    def fetch(self, spark: SparkSession, path: str, start: str | None = None, end: str | None = None) -> DataFrame:
        if start is None and end is None:
            if not self.capabilities.live:
                raise ValueError(f"{self.name} gives no live quotes")
            return read_quotes(spark, path, self.name)
        if not self.capabilities.history:
            raise ValueError(f"{self.name} gives no history")
        return read_history(spark, path, start or "0001-01-01", end or "9999-12-31", self.name)


def universe(df: DataFrame) -> DataFrame:
    return df.select(F.upper(F.trim("stock_code")).alias("stock_code")).distinct().orderBy("stock_code")


def read_sector_map(spark: SparkSession, path: str) -> DataFrame:
    """The reference map (CSV): stock_code, sector_name, sector_source, verified_on. Breaches raise ValueError."""
    names = ["stock_code", "sector_name", "sector_source", "verified_on"]
    df = require_columns(spark.read.csv(path, header=True), names).select(*names).withColumn("stock_code", standard_code(F.col("stock_code")))
    blank = F.coalesce(F.col("stock_code") == "", F.lit(True))
    bad = df.agg(F.count_if(blank).alias("empty"), F.count_if(is_unknown_sector(F.col("sector_name"))).alias("unknown"), (F.count("stock_code") - F.countDistinct("stock_code")).alias("duplicate")).first()
    if broken := [k for k, v in bad.asDict().items() if v]:
        raise ValueError(f"sector map {path}: {', '.join(broken)} rows")
    return df.withColumn("verified_on", F.to_date("verified_on"))


def read_vendor_history(spark: SparkSession, path: str) -> DataFrame:
    """The older vendor format: numbered column names, a date column first."""
    schema = "date date, `1. open` double, `2. high` double, `3. low` double, `4. close` double, `5. volume` long"
    return spark.read.csv(path, header=True, schema=schema).withColumnsRenamed({"date": "price_date", "1. open": "open_price", "2. high": "high_price", "3. low": "low_price", "4. close": "close_price", "5. volume": "volume"})
