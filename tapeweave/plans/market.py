"""The market view: a deterministic end-of-day market derived from lineitem and supplier.

The close of an instrument is 100 * exp of a running sum of small steps, so daily moves are a few
percent. Steps are summed as decimals, whatever their order. Everything is one aggregate and windows
over one partitioning by instrument.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tapeweave.operators.indicators import by_day
from tapeweave.plans.facts import counted, stored
from tapeweave.sources.readers import table


def stocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.select(F.col("s_suppkey").alias("stock_id"), F.upper(F.regexp_replace("s_name", "[^A-Za-z0-9.]", "")).alias("stock_code"), F.col("s_name").alias("company_name"), F.col("s_nationkey").alias("sector_id"), F.when(F.col("s_suppkey") % 10 == 0, "LSE").otherwise("NGX").alias("exchange"), (F.col("s_acctbal") >= 0).alias("is_active"))


def sectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("sector_id"), F.col("n_name").alias("sector_name"))


#: Lines of the table, and bytes, for each part of a shuffle: a task then holds as much at any size of the table.
PART_LINES, PART_BYTES = 500_000, 8 << 20


def sized(spark: SparkSession, sf_dir: str) -> None:
    """Tells Spark, for the session and for good, to cut shuffles into parts of PART_LINES lines and PART_BYTES.

    Without it the number of parts is fixed (or AQE joins them up to 64 MB, compressed), and the sorts of a task grow with the table. So a smaller
    number of parts or a larger size is replaced even where it was set; a larger number or a smaller size stays; a table of PART_LINES or less changes nothing.
    """
    parts = -(-counted(spark, sf_dir, "lineitem") // PART_LINES)
    if parts > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    if parts > 1 and spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(size)) > PART_BYTES:
        spark.conf.set(size, str(PART_BYTES))


def dealt_lines(spark: SparkSession, sf_dir: str, *columns: Column) -> DataFrame:
    """stock_id, price_date and columns of all lines, dealt by both: few lines share a day, so summing up before the shuffle would only fill memory."""
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("stock_id"), F.col("l_shipdate").cast("date").alias("price_date"), *columns)
    return lines.repartition("stock_id", "price_date")


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """stock_id, price_date, close_price, volume, source_count."""
    sized(spark, sf_dir)
    step = F.col("l_discount").cast("decimal(9,2)") - F.lit("0.05").cast("decimal(9,2)")
    lines = dealt_lines(spark, sf_dir, step.alias("_step"), F.col("l_quantity").cast("long").alias("_quantity"))
    daily = lines.groupBy("stock_id", "price_date").agg(F.sum("_step").alias("_step"), F.sum("_quantity").alias("volume"), F.count("*").alias("source_count"))
    run = F.sum("_step").over(by_day().rowsBetween(Window.unboundedPreceding, 0))
    return daily.select("stock_id", "price_date", F.round(F.exp(run.cast("double")) * 100, 4).alias("close_price"), "volume", "source_count")


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The price fact, stored once in a session."""
    sized(spark, sf_dir)
    return stored(spark, sf_dir, "prices", lambda: derived_prices(spark, sf_dir))


def derived_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars with the trust columns and changes that the fact table has.

    Status, flag and confidence follow from instrument and day, so that every band occurs.
    """
    day = F.datediff("price_date", F.lit("1992-01-01"))
    odd = F.pmod(F.col("stock_id") * 31 + day, F.lit(50))
    df = bars(spark, sf_dir).withColumns({
        "bar_status": F.when(F.col("source_count") >= 2, "RECONCILED").when(F.pmod(F.col("stock_id") + day, F.lit(7)) == 0, "OBSERVED").otherwise("OFFICIAL"),
        "data_quality_flag": F.when(odd == 0, "SUSPICIOUS").when(odd == 1, "INCOMPLETE").otherwise("GOOD"),
        "confidence_score": F.when(F.pmod(F.col("stock_id") * 17 + day, F.lit(20)) == 0, None).when(F.pmod(F.col("stock_id") * 17 + day, F.lit(20)) == 1, 55.0).otherwise(85.0),
        "has_complete_data": odd != 1,
    })
    before = F.lag("close_price").over(by_day())
    first = F.first("close_price").over(Window.partitionBy("stock_id", F.year("price_date")).orderBy("price_date"))
    return df.withColumns({"change_1d_pct": F.round((F.col("close_price") - before) / before * 100, 4), "change_ytd_pct": F.round((F.col("close_price") - first) / first * 100, 4)})


def staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes of up to three sources a day: stock_code, price_date, source, close_price, volume, staging_id.

    The sources are the return flags; each quotes the close scaled by 0, 0.4, 2 or 4 percent
    by day, so that all bands of agreement occur.
    """
    lines = dealt_lines(spark, sf_dir, F.col("l_returnflag").alias("source"), F.col("l_quantity").cast("long").alias("_quantity")).groupBy("stock_id", "price_date", "source").agg(F.sum("_quantity").alias("volume"))
    day = F.datediff("price_date", F.lit("1992-01-01"))
    rank = F.when(F.col("source") == "A", 0).when(F.col("source") == "N", 1).otherwise(2)
    spread = F.element_at(F.array(F.lit(0.0), F.lit(0.004), F.lit(0.02), F.lit(0.04)), F.pmod(day, F.lit(4)) + 1)
    out = lines.join(bars(spark, sf_dir).select("stock_id", "price_date", "close_price"), ["stock_id", "price_date"]).join(F.broadcast(stocks(spark, sf_dir).select("stock_id", "stock_code")), "stock_id")
    return out.select("stock_id", "stock_code", "price_date", "source", F.round(F.col("close_price") * (1 + spread * rank) + 1e-7, 4).cast("decimal(15,4)").alias("close_price"), "volume", (F.col("stock_id") * 100000 + day * 10 + rank).alias("staging_id"))


#: The same tables for DuckDB, as the head of a WITH.
STOCKS_SQL = "stocks AS (SELECT s_suppkey AS stock_id, upper(regexp_replace(s_name, '[^A-Za-z0-9.]', '', 'g')) AS stock_code, s_name AS company_name, s_nationkey AS sector_id, CASE WHEN s_suppkey % 10 = 0 THEN 'LSE' ELSE 'NGX' END AS exchange, s_acctbal >= 0 AS is_active FROM supplier), sectors AS (SELECT n_nationkey AS sector_id, n_name AS sector_name FROM nation)"
BARS_SQL = """daily AS (SELECT l_suppkey AS stock_id, CAST(l_shipdate AS DATE) AS price_date, sum(CAST(l_discount AS DECIMAL(9,2)) - CAST(0.05 AS DECIMAL(9,2))) AS step, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS volume, count(*) AS source_count FROM lineitem GROUP BY 1, 2),
bars AS (SELECT stock_id, price_date, round(100 * exp(CAST(sum(step) OVER (PARTITION BY stock_id ORDER BY price_date ROWS UNBOUNDED PRECEDING) AS DOUBLE)), 4) AS close_price, volume, source_count FROM daily)"""
PRICES_SQL = f"""{BARS_SQL},
dated AS (SELECT *, date_diff('day', DATE '1992-01-01', price_date) AS dn FROM bars),
prices AS (SELECT stock_id, price_date, close_price, volume, source_count,
  CASE WHEN source_count >= 2 THEN 'RECONCILED' WHEN (stock_id + dn) % 7 = 0 THEN 'OBSERVED' ELSE 'OFFICIAL' END AS bar_status,
  CASE WHEN (stock_id * 31 + dn) % 50 = 0 THEN 'SUSPICIOUS' WHEN (stock_id * 31 + dn) % 50 = 1 THEN 'INCOMPLETE' ELSE 'GOOD' END AS data_quality_flag,
  CASE WHEN (stock_id * 17 + dn) % 20 = 0 THEN NULL WHEN (stock_id * 17 + dn) % 20 = 1 THEN 55.0::DOUBLE ELSE 85.0::DOUBLE END AS confidence_score,
  (stock_id * 31 + dn) % 50 <> 1 AS has_complete_data,
  round((close_price - lag(close_price) OVER w) / lag(close_price) OVER w * 100, 4) AS change_1d_pct,
  round((close_price - first_value(close_price) OVER y) / first_value(close_price) OVER y * 100, 4) AS change_ytd_pct
  FROM dated WINDOW w AS (PARTITION BY stock_id ORDER BY price_date), y AS (PARTITION BY stock_id, year(price_date) ORDER BY price_date))"""
STAGING_SQL = f"""{BARS_SQL}, {STOCKS_SQL},
staging AS (SELECT l.stock_id, s.stock_code, l.price_date, l.source, CAST(round(b.close_price * (1 + [0.0::DOUBLE, 0.004::DOUBLE, 0.02::DOUBLE, 0.04::DOUBLE][(date_diff('day', DATE '1992-01-01', l.price_date) % 4) + 1] * l.rank) + 1e-7::DOUBLE, 4) AS DECIMAL(15,4)) AS close_price, l.volume, l.stock_id * 100000 + date_diff('day', DATE '1992-01-01', l.price_date) * 10 + l.rank AS staging_id
  FROM (SELECT l_suppkey AS stock_id, CAST(l_shipdate AS DATE) AS price_date, l_returnflag AS source, CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS rank, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS volume FROM lineitem GROUP BY 1, 2, 3) l
  JOIN bars b USING (stock_id, price_date) JOIN stocks s USING (stock_id))"""
