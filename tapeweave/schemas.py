"""Declared schemas of the tables and the values that their columns may take."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Enumerations of the data model.
BAR_STATUSES = ("OBSERVED", "RECONCILED", "OFFICIAL", "ESTIMATED")
QUALITY_FLAGS = ("GOOD", "INCOMPLETE", "SUSPICIOUS", "MISSING", "STALE", "POOR")
ACTIONS = ("STRONG_BUY", "BUY", "HOLD", "AVOID", "STRONGLY_AVOID")
SIGNALS = ("STRONG_BUY", "BUY", "HOLD", "SELL", "STRONG_SELL")
EXCHANGES = ("NGX", "LSE")

STAGING = T.StructType([
    T.StructField("stock_code", T.StringType()), T.StructField("price_date", T.DateType()), T.StructField("source", T.StringType()),
    T.StructField("close_price", T.DoubleType()), T.StructField("volume", T.LongType()), T.StructField("reconciled", T.BooleanType()),
    T.StructField("promoted_at", T.TimestampNTZType()), T.StructField("staging_id", T.LongType()),
])

PRICES = T.StructType([
    T.StructField("stock_id", T.LongType()), T.StructField("price_date", T.DateType()), T.StructField("close_price", T.DoubleType()),
    T.StructField("volume", T.LongType()), T.StructField("source_count", T.LongType()), T.StructField("bar_status", T.StringType()),
    T.StructField("data_quality_flag", T.StringType()), T.StructField("confidence_score", T.DoubleType()), T.StructField("has_complete_data", T.BooleanType()),
    T.StructField("change_1d_pct", T.DoubleType()), T.StructField("change_ytd_pct", T.DoubleType()),
])

TRADES = T.StructType([
    T.StructField("run_id", T.LongType()), T.StructField("trade_id", T.LongType()), T.StructField("stock_code", T.StringType()),
    T.StructField("entry_date", T.DateType()), T.StructField("exit_date", T.DateType()), T.StructField("entry_price", T.DoubleType()),
    T.StructField("exit_price", T.DoubleType()), T.StructField("gross_return_pct", T.DoubleType()), T.StructField("net_return_pct", T.DoubleType()),
    T.StructField("score", T.DoubleType()), T.StructField("confidence", T.DoubleType()),
])


def require_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """df itself, or an error that names the columns it lacks."""
    if missing := sorted(set(names) - set(df.columns)):
        raise ValueError(f"missing columns: {missing}")
    return df


def price_violations() -> dict[str, Column]:
    """What a row of prices must not be, by the name of the rule."""
    return {
        "close_not_positive": ~F.coalesce(F.col("close_price") > 0, F.lit(False)),
        "unknown_flag": ~F.col("data_quality_flag").isin(*QUALITY_FLAGS),
        "unknown_status": ~F.col("bar_status").isin(*BAR_STATUSES),
        "no_source": F.col("source_count") < 1,
        "confidence_out_of_range": ~F.col("confidence_score").between(0, 100),
    }


def violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(rule, rows): how many rows break each rule, in one pass."""
    counts = df.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(name) for name, c in rules.items()])
    return counts.unpivot([], list(rules), "rule", "rows")
