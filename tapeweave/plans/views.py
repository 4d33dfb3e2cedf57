"""The dashboard views as functions of their tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tapeweave.operators.backtest import equity_curve, return_bucket


def latest_day(prices: DataFrame) -> DataFrame:
    return prices.agg(F.max("price_date").alias("latest_date"))


def market_overview(prices: DataFrame) -> DataFrame:
    """One row for the latest day, also of an empty table."""
    day = latest_day(prices)
    c = F.col("change_1d_pct")
    rows = prices.join(F.broadcast(day), F.col("price_date") == F.col("latest_date")).groupBy("latest_date").agg(
        F.count("*").alias("priced"), F.count_if(c > 0).alias("advancers"), F.count_if(c < 0).alias("decliners"), F.count_if(c.isNull() | (c == 0)).alias("unchanged"), F.round(F.avg(c), 4).alias("avg_change_1d"),
        F.sum("volume").alias("total_volume"), F.count_if(F.col("data_quality_flag") == "GOOD").alias("good_rows"), F.count_if("has_complete_data").alias("complete_rows"),
    )
    rows = rows.withColumn("good_pct", F.round(F.col("good_rows") / F.nullif(F.col("priced"), F.lit(0)) * 100, 2))
    return day.join(rows, "latest_date", "left")


def price_panel(prices: DataFrame, indicators: DataFrame, stocks: DataFrame, sectors: DataFrame) -> DataFrame:
    """Prices with their instrument, sector and same-day indicators. Dimensions are small tables that Spark broadcasts by size."""
    return prices.join(stocks, "stock_id").join(sectors, "sector_id", "left").join(indicators, ["stock_id", "price_date"], "left")


def recommendation_board(recs: DataFrame, stocks: DataFrame, *, digits: int | None = None) -> DataFrame:
    """Recommendations with their place on the day's board of the profile.

    With digits, values that are the same to so many digits tie; percentages are made of the values as they are.
    """
    key = lambda c: F.col(c) if digits is None else F.round(c, digits)
    order = Window.partitionBy("recommendation_date", "profile").orderBy(
        F.col("portfolio_approved").desc(), F.col("portfolio_rank").asc_nulls_last(), F.col("probability").isNotNull().desc(), key("probability").desc_nulls_last(), key("score").desc(), key("agreement").desc(), F.col("stock_code"),
    )
    return recs.join(stocks.select("stock_id", "company_name", "sector_id"), "stock_id").withColumns({"board_rank": F.row_number().over(order), "probability_pct": F.round(F.col("probability") * 100 + 1e-9, 2), "agreement_pct": F.round(F.col("agreement") * 100 + 1e-9, 2)})


def daily_board(board: DataFrame) -> DataFrame:
    """The approved rows of the latest day."""
    day = board.agg(F.max("recommendation_date").alias("_day"))
    return board.join(F.broadcast(day), F.col("recommendation_date") == F.col("_day")).filter("portfolio_approved").drop("_day")


def sector_performance(prices: DataFrame, recs: DataFrame, stocks: DataFrame, sectors: DataFrame) -> DataFrame:
    """Every sector on the latest day: active and priced instruments, averages, approved picks. Conditions stay in the joins."""
    day = latest_day(prices)
    p = prices.join(F.broadcast(day), F.col("price_date") == F.col("latest_date")).select("stock_id", "change_1d_pct", "change_ytd_pct", "volume")
    r = recs.join(F.broadcast(day), F.col("recommendation_date") == F.col("latest_date")).select("stock_id", "score", "portfolio_approved")
    active = stocks.filter("is_active").select("stock_id", "sector_id")
    rows = sectors.crossJoin(F.broadcast(day)).join(active, "sector_id", "left").join(p.withColumn("_priced", F.col("stock_id")), "stock_id", "left").join(r, "stock_id", "left")
    return rows.groupBy("latest_date", "sector_id", "sector_name").agg(F.countDistinct("stock_id").alias("active_stocks"), F.countDistinct("_priced").alias("priced_stocks"), F.round(F.avg("change_1d_pct"), 4).alias("avg_change_1d"), F.round(F.avg("change_ytd_pct"), 4).alias("avg_change_ytd"), F.sum("volume").alias("volume"), F.round(F.avg("score"), 4).alias("avg_score"), F.count_if(F.coalesce("portfolio_approved", F.lit(False))).alias("approved"))


def json_number(c: Column | str, path: str) -> Column:
    return F.get_json_object(c, path).try_cast("double")


def model_health(runs: DataFrame, signals: DataFrame) -> DataFrame:
    """Runs with the day's decision of their profile; two runs of a day both meet it."""
    s = signals.select(F.col("signal_date").alias("run_date"), "profile", "signal")
    return runs.join(s, ["run_date", "profile"], "left").withColumns({n: json_number("run_metadata", f"$.portfolio.{n}") for n in ("win_rate", "return_pct", "profit_factor", "max_drawdown_pct")})


def latest_verdict(runs: DataFrame, signals: DataFrame) -> DataFrame:
    """The newest full validation with its decision."""
    top = runs.filter("run_type = 'full_validation'").orderBy(F.col("run_date").desc(), F.col("created_at").desc(), F.col("run_id").desc()).limit(1)
    s = signals.select(F.col("signal_date").alias("run_date"), "profile", "run_type", "signal")
    return top.join(s, ["run_date", "profile", "run_type"], "left").withColumns({n: json_number("run_metadata", f"$.portfolio.{n}") for n in ("win_rate", "return_pct", "profit_factor", "max_drawdown_pct", "trades")})


def with_run(child: DataFrame, runs: DataFrame) -> DataFrame:
    """A child table of the runs with the run's attributes."""
    return child.join(runs.select("run_id", "run_date", "profile", "run_type"), "run_id")


def backtest_equity(trades: DataFrame, runs: DataFrame) -> DataFrame:
    return with_run(equity_curve(trades), runs)


def trade_distribution(trades: DataFrame, runs: DataFrame) -> DataFrame:
    return with_run(trades.withColumn("return_bucket", return_bucket(F.col("net_return_pct"))), runs)


#: Counts of staged rows without a change; sources that give none miss it in all rows.
MISSING = {"missing_staging_1d_change": "change_1d_pct", "missing_staging_ytd_change": "change_ytd_pct"}


def data_quality_monitor(staging: DataFrame, prices: DataFrame, indicators: DataFrame) -> DataFrame:
    """Counts of the three tables for each day that any of them has, and their ratios."""
    s = staging.groupBy("price_date").agg(F.count("*").alias("staged_rows"), F.countDistinct("source").alias("sources"), F.count_if(F.coalesce(F.col("close_price") <= 0, F.lit(True))).alias("invalid_staging_prices"), *[F.count_if(F.col(c).isNull() if c in staging.columns else F.lit(True)).alias(n) for n, c in MISSING.items()])
    p = prices.groupBy("price_date").agg(F.count("*").alias("fact_rows"), F.count_if(F.col("data_quality_flag") == "GOOD").alias("good_rows"), F.count_if("has_complete_data").alias("complete_rows"), F.count_if(F.coalesce(F.col("close_price") <= 0, F.lit(True))).alias("invalid_fact_prices"))
    i = indicators.groupBy("price_date").agg(F.count("*").alias("indicator_rows"))
    out = s.join(p, "price_date", "full_outer").join(i, "price_date", "full_outer")
    counts = ["staged_rows", "sources", "invalid_staging_prices", *MISSING, "fact_rows", "good_rows", "complete_rows", "invalid_fact_prices", "indicator_rows"]
    out = out.fillna(0, counts)
    ratio = lambda a, b: F.round(F.col(a) / F.nullif(F.col(b), F.lit(0)) * 100, 2)
    return out.withColumns({"good_pct": ratio("good_rows", "fact_rows"), "indicator_pct": ratio("indicator_rows", "fact_rows")})


def command_center(verdict: DataFrame, overview: DataFrame, board: DataFrame) -> DataFrame:
    """One row: the verdict, the market, and how many picks the day has."""
    picks = board.agg(F.count("*").alias("approved_picks"))
    return overview.crossJoin(picks).join(verdict.select("run_id", "signal", "win_rate"), F.lit(True), "left")


def newest_values(rows: DataFrame, *names: str) -> DataFrame:
    """stock_id, the last day of its rows as _day, and columns of numbers of that day. Each column by itself: of a struct Spark would sort all rows."""
    return rows.groupBy("stock_id").agg(F.max("price_date").alias("_day"), *[F.max_by(n, "price_date").alias(n) for n in names])


def latest_prices(prices: DataFrame, stocks: DataFrame) -> DataFrame:
    """The last price of each active instrument, null without any; one aggregate instead of a lateral lookup."""
    last = newest_values(prices, "close_price", "volume", "change_1d_pct").withColumnRenamed("_day", "price_date")
    return stocks.filter("is_active").select("stock_id", "stock_code", "sector_id").join(last, "stock_id", "left")


def investment_dashboard(latest: DataFrame, indicators: DataFrame, alerts: DataFrame) -> DataFrame:
    """Latest prices with the last indicators and that day's alerts: count and names."""
    last = newest_values(indicators, "ma_30", "rsi_14").drop("_day")
    hits = alerts.groupBy("stock_id", F.col("alert_date").alias("price_date")).agg(F.count("*").alias("alert_count"), F.array_join(F.array_sort(F.collect_set("rule_type")), ",").alias("alert_types"))
    return latest.join(last, "stock_id", "left").join(hits, ["stock_id", "price_date"], "left").fillna(0, ["alert_count"])


def price_history(prices: DataFrame, stocks: DataFrame, code: str, start: str, end: str) -> DataFrame:
    return prices.join(stocks.filter(F.col("stock_code") == code).select("stock_id", "stock_code"), "stock_id").filter(F.col("price_date").between(start, end)).orderBy("price_date")


def price_histories(prices: DataFrame, stocks: DataFrame, asked: DataFrame) -> DataFrame:
    """price_history for every row of asked (stock_code, d1, d2): one join, whatever the number of codes."""
    return asked.join(stocks.select("stock_id", "stock_code"), "stock_code").join(prices, "stock_id").filter(F.col("price_date").between(F.col("d1"), F.col("d2")))


def active_alerts(alerts: DataFrame, stocks: DataFrame, code: str) -> DataFrame:
    return alerts.join(stocks.filter(F.col("stock_code") == code).select("stock_id", "stock_code"), "stock_id").orderBy(F.col("alert_date").desc(), "rule_id")


def snapshot_top(recs: DataFrame, n: int = 10, day: str = "recommendation_date") -> DataFrame:
    """The first n recommendations of each day: approved ones by rank, then probability, score and agreement downwards, then code."""
    order = Window.partitionBy(day).orderBy(F.col("portfolio_rank").asc_nulls_last(), F.col("probability").desc_nulls_last(), F.col("score").desc(), F.col("agreement").desc(), "stock_code")
    return recs.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= n)


def newest_prices(prices: DataFrame, n: int = 20) -> DataFrame:
    """The newest n bars of each instrument."""
    order = Window.partitionBy("stock_id").orderBy(F.col("price_date").desc())
    return prices.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= n).drop("_n")


def chart(df: DataFrame, by: list[str], metrics: dict[str, Column], limit: int | None = None) -> DataFrame:
    """A dashboard chart: metrics by dimensions, ordered, up to a row limit (the chart's own)."""
    out = df.groupBy(*by).agg(*[c.alias(n) for n, c in metrics.items()]).orderBy(*by)
    return out if limit is None else out.limit(limit)


def custom_metrics(board: DataFrame, trades: DataFrame, monitor: DataFrame) -> DataFrame:
    """(metric, dimension, value): the dashboard's own measures over the latest day's board, the trades and the quality monitor."""
    day = board.agg(F.max("recommendation_date").alias("_day"))
    daily = board.join(F.broadcast(day), F.col("recommendation_date") == F.col("_day"))
    measures = (
        ("rejected_candidates", daily, F.col("recommendation_date").cast("string"), F.count_if(~F.col("portfolio_approved"))), ("rejections_by_reason", daily.filter(~F.col("portfolio_approved")), F.col("portfolio_reason"), F.count("*")),
        ("return_distribution", trades, return_bucket(F.col("net_return_pct")), F.count("*")), ("invalid_prices", monitor, F.col("price_date").cast("string"), F.sum(F.col("invalid_staging_prices") + F.col("invalid_fact_prices"))),
        ("missing_change_fields", monitor, F.col("price_date").cast("string"), F.sum(F.col("missing_staging_1d_change") + F.col("missing_staging_ytd_change"))),
    )
    parts = [df.groupBy(by.alias("dimension")).agg(value.cast("long").alias("value")).select(F.lit(name).alias("metric"), "dimension", "value") for name, df, by, value in measures]
    return reduce(DataFrame.unionByName, parts)


def top_picks(recs: DataFrame, n: int, *, nulls_first: bool = False, day: str = "recommendation_date") -> DataFrame:
    """The first n of each day by probability, score and agreement downwards, then code; nulls_first: rows without a probability lead, as where a database sorts nulls high."""
    p = F.col("probability").desc_nulls_first() if nulls_first else F.col("probability").desc_nulls_last()
    order = Window.partitionBy(day).orderBy(p, F.col("score").desc(), F.col("agreement").desc(), "stock_code")
    return recs.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= n)


def extremes(indicators: DataFrame, n: int, *, oversold: float = 30.0, overbought: float = 70.0, volatile: float = 0.3) -> DataFrame:
    """(list, place, stock_id, value): each list in its own order, ties by instrument: oversold upwards, overbought and volatile downwards."""
    rsi, vol = F.col("rsi_14"), F.col("volatility_30")
    entry = lambda name, on, value, key: F.when(on, F.struct(F.lit(name).alias("list"), value.alias("value"), key.alias("key")))
    entries = F.array(entry("oversold", rsi <= oversold, rsi, rsi), entry("overbought", rsi >= overbought, rsi, -rsi), entry("volatile", vol >= volatile, vol, -vol))
    rows = indicators.select("stock_id", F.explode(F.filter(entries, lambda e: e.isNotNull())).alias("e")).select("stock_id", "e.*")
    return rows.withColumn("place", F.row_number().over(Window.partitionBy("list").orderBy("key", "stock_id"))).filter(F.col("place") <= n).drop("key")
