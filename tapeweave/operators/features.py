"""Feature snapshots, labels and the modelling dataset, for all instruments and days at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeweave.functions.scalars import drawdown, mean_of, pct, pct_distance, rebound
from tapeweave.operators.indicators import by_day, last
from tapeweave.operators.quality import modelable

RETURNS = (1, 3, 5, 10, 20, 30, 60)


def price_features(df: DataFrame) -> DataFrame:
    """Returns, volume ratios, ranges and volatilities; windows may be partial, as far as history goes."""
    c, v = F.col("close_price"), F.col("volume").cast("double")
    out: dict[str, Column] = {f"change_{n}d": pct(c, F.lag("close_price", n).over(by_day())) for n in RETURNS}
    before = F.avg(v).over(by_day().rowsBetween(-20, -1))
    out["volume_ratio"] = F.when(before > 0, v / before)
    for n in (20, 60):
        out |= {f"high_{n}d": F.max(c).over(last(n)), f"low_{n}d": F.min(c).over(last(n))}
    for n in (5, 20):
        out[f"avg_volume_{n}d"] = F.avg(v).over(last(n))
    out["trusted_history_days"] = F.row_number().over(by_day())
    df = df.withColumns(out)
    df = df.withColumn("_neg", F.when(F.col("change_1d") < 0, F.col("change_1d")))
    return df.withColumns({
        "volatility_10d": F.coalesce(F.stddev_pop("change_1d").over(last(10)), F.lit(0.0)),
        "volatility_20d": F.coalesce(F.stddev_pop("change_1d").over(last(20)), F.lit(0.0)),
        "downside_volatility_20d": F.coalesce(F.stddev_pop("_neg").over(last(20)), F.lit(0.0)),
        "volume_trend": F.when(F.col("avg_volume_20d") > 0, F.col("avg_volume_5d") / F.col("avg_volume_20d")),
        "drawdown_20d": drawdown(c, F.col("high_20d")), "drawdown_60d": drawdown(c, F.col("high_60d")),
        "rebound_20d": rebound(c, F.col("low_20d")), "rebound_60d": rebound(c, F.col("low_60d")),
    }).drop("_neg")


def live_history_days(df: DataFrame, *, most: int = 90) -> DataFrame:
    """df with live_history_days: an instrument's trusted days so far as the live screen counts them, which looks at `most` of them."""
    return df.withColumn("live_history_days", F.least(F.row_number().over(by_day()), F.lit(most)))


def with_label(df: DataFrame, *, horizon: int = 10, threshold: float = 0.0) -> DataFrame:
    """Forward return over `horizon` rows and whether it is above threshold; null at the end of history."""
    later = F.lead("close_price", horizon).over(by_day())
    forward = F.when(F.col("close_price") > 0, (later - F.col("close_price")) / F.col("close_price") * 100)
    return df.withColumns({"horizon_date": F.lead("price_date", horizon).over(by_day()), "forward_return": forward, "target": (forward > threshold).cast("int")})


def dataset(prices: DataFrame, indicators: DataFrame, *, start: str, end: str, horizon: int = 10, threshold: float = 0.0, outlier: float = 50.0, min_history: int = 30, min_confidence: float = 65.0) -> DataFrame:
    """Labelled rows: the range first, then the windows; outliers at the anchor and ahead are left out."""
    eligible = prices.filter(F.col("price_date").between(start, end)).filter(modelable(min_confidence))
    move = F.coalesce(F.col("change_1d_pct"), pct(F.col("close_price"), F.lag("close_price").over(by_day())))
    rows = with_label(price_features(eligible).withColumn("_move", move), horizon=horizon, threshold=threshold)
    rows = rows.filter((F.coalesce(F.abs("_move"), F.lit(0.0)) <= outlier) & F.col("forward_return").isNotNull() & (F.abs("forward_return") <= outlier) & (F.col("trusted_history_days") >= min_history)).drop("_move")
    return rows.join(indicators, ["stock_id", "price_date"])


def feature_vector(df: DataFrame) -> DataFrame:
    """The 39 features of the probability models, on their scales; what is missing takes the value that says nothing."""
    d = lambda name, x=0.0: F.coalesce(F.col(name).cast("double"), F.lit(float(x)))
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    away = lambda a, b: F.coalesce(pct_distance(F.col(a), F.col(b)), F.lit(0.0))
    c, gap = "close_price", F.col("macd") - F.coalesce("macd_signal", F.lit(0.0))  # a missing signal counts as 0
    official = F.col("is_official") if "is_official" in df.columns else F.col("bar_status").isin("RECONCILED", "OFFICIAL")
    values = (
        d("change_1d"), d("change_3d"), d("change_5d"), d("change_10d"), d("change_20d"), d("change_30d"), d("change_60d"),
        (d("rsi_14", 50) - 50) / 50, d("macd"), F.coalesce(gap, F.lit(0.0)), d("volatility_10d"), d("volatility_20d"), d("volatility_30"), d("downside_volatility_20d"),
        d("volume_ratio", 1) - 1, d("avg_volume_20d") / 1e6, d("volume_trend", 1) - 1, d("confidence_score", 50) / 100, d("trusted_history_days") / 100,
        away(c, "ma_7"), away(c, "ma_30"), away(c, "ma_90"), away("ma_7", "ma_30"), away("ma_30", "ma_90"),
        away(c, "high_20d"), away(c, "high_60d"), away(c, "low_20d"), away(c, "low_60d"), d("drawdown_20d"), d("drawdown_60d"), d("rebound_20d"), d("rebound_60d"), d("trend_strength", 50) / 100,
        flag(F.col("data_quality_flag") == "GOOD"), flag(F.col("data_quality_flag") == "INCOMPLETE"), flag(F.col("bar_status") == "RECONCILED"), flag(F.col("bar_status") == "OFFICIAL"), flag(official), flag(F.col("has_complete_data")),
    )
    return df.withColumns(dict(zip(FEATURES, values, strict=True)))


# Names of the models' features, in their order.
FEATURES = (
    "price_change_pct", "price_change_3d", "price_change_5d", "price_change_10d", "price_change_20d", "price_change_30d", "price_change_60d",
    "rsi_14_centered", "macd_level", "macd_signal_gap", "volatility_10d_level", "volatility_20d_level", "volatility_30_level", "downside_volatility_20d_level",
    "volume_ratio_centered", "avg_volume_20d_millions", "volume_trend_ratio_centered", "price_confidence_score_scaled", "trusted_history_days_scaled",
    "close_vs_ma_7_pct", "close_vs_ma_30_pct", "close_vs_ma_90_pct", "ma_7_vs_ma_30_pct", "ma_30_vs_ma_90_pct",
    "close_vs_20d_high_pct", "close_vs_60d_high_pct", "close_vs_20d_low_pct", "close_vs_60d_low_pct", "drawdown_20d_pct", "drawdown_60d_pct", "rebound_20d_pct", "rebound_60d_pct", "trend_strength_scaled",
    "quality_good_flag", "quality_incomplete_flag", "bar_reconciled_flag", "bar_official_flag", "official_flag", "complete_data_flag",
)
RISK_FEATURES = (*FEATURES, "heuristic_proxy_score", "signal_agreement_proxy", "score_x_agreement", "near_20d_high_flag", "extended_20d_runup_flag", "high_rebound_20d_flag")


def risk_features(df: DataFrame) -> DataFrame:
    """Six more features for the risk of bad trades, of rows with feature_vector()'s columns."""
    df = proxy_score(df).withColumnsRenamed({"proxy_score": "heuristic_proxy_score", "proxy_agreement": "signal_agreement_proxy"})
    flag = lambda c: c.cast("double")
    return df.withColumns({
        "score_x_agreement": F.col("heuristic_proxy_score") * F.col("signal_agreement_proxy"), "near_20d_high_flag": flag(F.col("close_vs_20d_high_pct") >= -2),
        "extended_20d_runup_flag": flag(F.col("price_change_20d") >= 12), "high_rebound_20d_flag": flag(F.col("rebound_20d_pct") >= 20),
    })


def _line(x: Column, low: float, high: float) -> Column:
    return F.least(F.greatest((x - low) / (high - low) * 100, F.lit(0.0)), F.lit(100.0))


def proxy_score(df: DataFrame) -> DataFrame:
    """Cheap stand-ins of score and agreement from the features alone."""
    rsi = F.col("rsi_14")
    band = F.when(rsi.isNull(), 50.0).when(rsi.between(40, 60), 100.0).when(rsi.between(30, 70), 80.0).when(rsi.between(20, 80), 60.0).otherwise(30.0)
    calm = F.greatest(100 - F.coalesce(F.col("volatility_20d"), F.lit(0.0)) * 10, F.lit(0.0))
    score = band * 0.25 + _line(F.coalesce(F.col("change_10d"), F.lit(0.0)), -5, 10) * 0.32 + calm * 0.23 + _line(F.col("ma_30_vs_ma_90_pct"), -10, 15) * 0.15 + 50 * 0.05
    checks = [F.col("change_10d") > 0, F.col("ma_30_vs_ma_90_pct") > 0, F.col("close_vs_ma_30_pct") > 0, rsi.between(40, 75), F.col("macd") > F.col("macd_signal")]
    return df.withColumns({"proxy_score": score, "proxy_agreement": mean_of(*[F.coalesce(k.cast("double"), F.lit(0.0)) for k in checks], default=0.0)})


def feature_health(df: DataFrame, names: tuple[str, ...], *, high_missing: float = 0.25) -> DataFrame:
    """One row for each feature: nulls, distinct values (9 digits), range and whether it tells anything; one pass."""
    long = df.select(*[F.col(n).cast("double").alias(n) for n in names]).unpivot([], list(names), "feature", "v")
    # by value first: distinct values are then counted without a second copy of the rows
    values = long.groupBy("feature", F.round("v", 9).alias("_r")).agg(F.count("*").alias("_n"), F.count("v").alias("_c"), F.min("v").alias("_min"), F.max("v").alias("_max"), F.sum("v").alias("_sum"))
    out = values.groupBy("feature").agg(F.sum("_n").alias("rows"), (F.sum("_n") - F.sum("_c")).alias("nulls"), F.count("_r").alias("distinct_values"), F.min("_min").alias("min_value"), F.max("_max").alias("max_value"), (F.sum("_sum") / F.nullif(F.sum("_c"), F.lit(0))).alias("mean_value"))
    return out.withColumns({"null_rate": F.when(F.col("rows") > 0, F.col("nulls") / F.col("rows")), "is_constant": F.col("distinct_values") <= 1, "all_zero": F.coalesce((F.col("min_value") == 0) & (F.col("max_value") == 0), F.lit(False))}).withColumn("high_missing", F.coalesce(F.col("null_rate") >= high_missing, F.lit(False)))
