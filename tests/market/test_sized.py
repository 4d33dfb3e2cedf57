"""Shuffles are cut by the lines of the table, not into a fixed number of parts."""

from pyspark.sql import functions as F

from tapeweave import catalog
from tapeweave.operators import features, indicators, staging
from tapeweave.plans import market, views

SF = "/root/testdata/sf0.01"


def test_parts_grow_with_the_table(spark, monkeypatch):
    plain = {tuple(r) for r in market.bars(spark, SF).collect()}
    monkeypatch.setattr(market, "PART_LINES", 2_000)
    other = spark.newSession()
    other.conf.set("spark.sql.shuffle.partitions", "8")
    other.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the rows are less than AQE's smallest part
    bars = market.bars(other, SF)
    assert {tuple(r) for r in bars.collect()} == plain
    quotes = staging.merge_batches(market.staging(other, SF).select("stock_code", "price_date", "source"), keys=["stock_code", "price_date"])
    for rows in (bars, market.derived_prices(other, SF), features.price_features(bars), indicators.older_windows(bars.select("stock_id", "price_date", "close_price")), quotes):
        sizes = [r["n"] for r in rows.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        assert len(sizes) > 16 and max(sizes) <= len(plain) / 4  # in 8 parts before, an eighth or more in each


    assert other.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == str(market.PART_BYTES)


def test_small_tables_change_nothing(spark):
    other = spark.newSession()
    other.conf.set("spark.sql.shuffle.partitions", "8")
    market.sized(other, SF)
    assert other.conf.get("spark.sql.shuffle.partitions") == "8"
    assert other.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", None) is None


def most_in_a_part(spark, monkeypatch, name):
    """Rows of a query, and the most in one part, where the session has a size of parts that holds the whole table."""
    monkeypatch.setattr(market, "PART_LINES", 2_000)
    monkeypatch.setattr(market, "PART_BYTES", 20_000)
    other = spark.newSession()
    for key, value in (("advisoryPartitionSizeInBytes", "64m"), ("coalescePartitions.parallelismFirst", "false"), ("coalescePartitions.minPartitionSize", "1b")):
        other.conf.set(f"spark.sql.adaptive.{key}", value)
    sizes = [r["n"] for r in catalog.QUERIES[name](other, SF).groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    return sum(sizes), max(sizes)


def test_older_windows_with_a_size_that_was_set(spark, monkeypatch):
    """A size of parts that was set stayed, and the sorts of a task grew with the table."""
    rows, most = most_in_a_part(spark, monkeypatch, "w25_older_windows")
    assert rows == 50_407 and most <= rows / 4


def test_merged_batches_with_a_size_that_was_set(spark, monkeypatch):
    """As above: joins of quotes and bars, and rows dealt by code and day, held a part as large as the setting."""
    rows, most = most_in_a_part(spark, monkeypatch, "u02_merge_batches")
    assert rows == 53_307 and most <= rows / 4


def test_smaller_sizes_stay(spark, monkeypatch):
    monkeypatch.setattr(market, "PART_LINES", 2_000)
    for was, then in (("1m", "1m"), ("8MB", "8MB"), ("9m", str(market.PART_BYTES))):
        other = spark.newSession()
        other.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", was)
        market.sized(other, SF)
        assert other.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == then


def test_daily_run_deals_rows_once(spark, monkeypatch):
    """Windows come before the scan: its output was dealt anew for the year's first close, and again for the last bars."""
    plans, cut = [], indicators.cut_lineage

    def seen(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return cut(df, name)

    monkeypatch.setattr(indicators, "cut_lineage", seen)
    bars = market.bars(spark, SF).select("stock_id", "price_date", "close_price").localCheckpoint()
    _, state = indicators.continue_indicators(bars.filter("price_date < '2000-12-20'"), spark.createDataFrame([], indicators.STATE))
    assert "Exchange" not in plans[0][: plans[0].index("MapInArrow")] and "Window" not in plans[0][: plans[0].index("MapInArrow")]
    assert state.filter("smooth is null").count() == 0 and state.count() == bars.select("stock_id").distinct().count()


def test_last_values_without_a_sort(spark):
    """A struct in max_by made Spark sort all rows of a task before it summed them up, in memory that grew with the table."""
    prices = spark.createDataFrame([(1, "2001-01-01", 1.0, 10, 0.5), (1, "2001-01-03", 3.0, 30, None), (1, "2001-01-02", 2.0, 20, 0.7), (2, "2001-01-01", 5.0, None, 0.1)], "stock_id long, price_date string, close_price double, volume long, change_1d_pct double").withColumn("price_date", F.to_date("price_date"))
    stocks = spark.createDataFrame([(1, "A", 1, True), (2, "B", 1, True), (3, "C", 2, True), (4, "D", 2, False)], "stock_id long, stock_code string, sector_id long, is_active boolean")
    latest = views.latest_prices(prices, stocks)
    assert sorted((r.stock_id, str(r.price_date), r.close_price, r.volume, r.change_1d_pct) for r in latest.collect()) == [(1, "2001-01-03", 3.0, 30, None), (2, "2001-01-01", 5.0, None, 0.1), (3, "None", None, None, None)]
    indicators = prices.select("stock_id", "price_date", F.col("close_price").alias("ma_30"), F.col("change_1d_pct").alias("rsi_14"))
    alerts = spark.createDataFrame([], "stock_id long, alert_date date, rule_type string")
    shown = views.investment_dashboard(latest, indicators, alerts)
    assert sorted((r.stock_id, r.ma_30, r.rsi_14, r.alert_count) for r in shown.collect()) == [(1, 3.0, None, 0), (2, 5.0, 0.1, 0), (3, None, None, 0)]
    for df, names in ((latest, ["volume"]), (shown, ["volume", "ma_30"])):
        plan = df.select("stock_id", *names)._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan.replace("\n", " ") and "HashAggregate" in plan
