"""Alert rules: every rule over the latest trusted row of every instrument, in one pass."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tapeweave.operators.quality import trusted

# The seeded rules (name, type, threshold, severity).
RULES = (
    (1, "Price Movement Alert", "PRICE_MOVEMENT", 5.0, "WARNING"), (2, "Bullish MA Crossover", "MA_CROSSOVER", None, "INFO"), (3, "Bearish MA Crossover", "MA_CROSSOVER", None, "WARNING"),
    (4, "RSI Oversold", "RSI", 30.0, "INFO"), (5, "RSI Overbought", "RSI", 70.0, "WARNING"), (6, "MACD Bullish", "MACD", 0.0, "INFO"), (7, "MACD Bearish", "MACD", 0.0, "INFO"),
    (8, "High Volatility", "VOLATILITY", 0.3, "WARNING"), (9, "Volume Spike", "VOLUME_SPIKE", 2.5, "INFO"), (10, "Custom", "CUSTOM", None, "INFO"),
)


def seeded_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(RULES), "rule_id long, rule_name string, rule_type string, threshold double, severity string")


def latest_rows(prices: DataFrame, indicators: DataFrame, *, as_of: str | None = None) -> DataFrame:
    """Each instrument's last trusted price row, with the indicators of that very day if there are any.

    mean_other_volume: mean volume of the other rows of the 30 calendar days up to it, if five at least.
    """
    rows = prices.filter(trusted())
    if as_of:
        rows = rows.filter(F.col("price_date") <= F.lit(as_of).cast("date"))
    day = F.datediff("price_date", F.lit("1970-01-01"))
    month = Window.partitionBy("stock_id").orderBy(day).rangeBetween(-30, -1)
    rows = rows.withColumns({"_others": F.count("volume").over(month), "_mean": F.avg("volume").over(month), "_n": F.row_number().over(Window.partitionBy("stock_id").orderBy(F.col("price_date").desc()))}).filter("_n = 1")
    rows = rows.withColumn("mean_other_volume", F.when(F.col("_others") >= 4, F.col("_mean"))).drop("_n", "_others", "_mean")
    return rows.join(indicators, ["stock_id", "price_date"], "left")


#: What a rule may be told, by the name in its JSON.
PARAMETERS = ("threshold", "oversold", "overbought", "multiplier")


def rule_parameters(rules: DataFrame) -> DataFrame:
    """rules with `p`, a struct of PARAMETERS as doubles; null is what a rule does not say.

    A JSON object in `parameters` says all. Without one, threshold_value (or threshold) says the threshold, for rules on RSI
    also that of their side, and a JSON object in condition_sql says the rest and wins. Text that is no JSON says nothing.
    """
    given = lambda c, t: F.col(c).cast(t) if c in rules.columns else F.lit(None).cast(t)
    whole, more = F.try_parse_json(given("parameters", "string")), F.try_parse_json(given("condition_sql", "string"))
    is_object = lambda v: F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    plain, name, rsi = given("threshold_value" if "threshold_value" in rules.columns else "threshold", "double"), F.upper("rule_name"), F.col("rule_type") == "RSI"
    fallback = {"threshold": plain, "overbought": F.when(rsi & name.contains("OVERBOUGHT"), plain), "oversold": F.when(rsi & ~name.contains("OVERBOUGHT") & name.contains("OVERSOLD"), plain), "multiplier": F.lit(None).cast("double")}
    df = rules.withColumns({"_whole": whole, "_more": more})
    said = lambda v, k: F.when(is_object(F.col(v)), F.try_variant_get(v, f"$.{k}", "double"))
    values = [F.when(is_object(F.col("_whole")), said("_whole", k)).otherwise(F.coalesce(said("_more", k), fallback[k])).alias(k) for k in PARAMETERS]
    return df.withColumn("p", F.struct(*values)).drop("_whole", "_more")


def _pairs(**values: Column) -> Column:
    """key=value, key=value."""
    return F.concat_ws(", ", *[F.concat(F.lit(f"{k}="), F.coalesce(v.cast("string"), F.lit("None"))) for k, v in values.items()])


def evaluate(latest: DataFrame, rules: DataFrame) -> DataFrame:
    """(stock_id, rule_id, alert_date, rule_type, severity, message, trigger_value, details) of the rules that hold.

    Rules are data: few rows, broadcast, with the parameters that rule_parameters reads; each type has a condition,
    a message and details (key=value, in a list) of its own. A type that is not known never holds. Instruments are
    named by stock_code, or by their number where latest has none.
    """
    code = F.col("stock_code") if "stock_code" in latest.columns else F.col("stock_id").cast("string")
    name, kind = F.upper("rule_name"), F.col("rule_type")
    named = lambda *w: F.greatest(*[name.contains(x) for x in w])
    bull_rule, bear_rule = named("BULL", "BUY", "POSITIVE"), named("BEAR", "SELL", "NEGATIVE")
    macd, signal, hist = F.col("macd"), F.col("macd_signal"), F.coalesce("macd_histogram", F.col("macd") - F.col("macd_signal"))
    edge = F.abs(F.coalesce("p.threshold", F.lit(0.0)))
    bull, bear = (macd > signal) & (hist >= edge), (macd < signal) & (F.abs(hist) >= edge)
    crossed = (bull | bear) & (~bull_rule | bull) & (~bear_rule | bear)
    way = F.when(bull, "BULLISH").otherwise("BEARISH")
    change, rsi, volatility, cross = F.col("change_1d_pct"), F.col("rsi_14"), F.col("volatility_30"), F.col("ma_crossover_signal")
    moved, high, times = F.coalesce("p.threshold", F.lit(5.0)), F.coalesce("p.threshold", F.lit(0.3)), F.coalesce("p.multiplier", F.lit(2.0))
    low_side = name.contains("OVERSOLD")
    band = F.when(low_side, F.coalesce("p.oversold", F.lit(30.0))).when(name.contains("OVERBOUGHT"), F.coalesce("p.overbought", F.lit(70.0)))
    volume, mean = F.col("volume"), F.col("mean_other_volume")
    ratio = volume / mean
    digits = lambda c, n: c.cast(f"decimal(18,{n})").cast("string")
    side = F.when(cross == "BULLISH", F.lit("Bullish crossover detected (Golden Cross)")).otherwise("Bearish crossover detected (Death Cross)")
    types = {
        "PRICE_MOVEMENT": (
            F.abs(change) >= moved, F.concat(code, F.when(change > 0, " increased by ").otherwise(" decreased by "), digits(F.abs(change).cast("decimal(18,4)"), 2), F.lit("% (threshold: "), moved.cast("string"), F.lit("%)")),
            F.abs(change), _pairs(change_pct=change, close_price=F.col("close_price"), threshold=moved),
        ),
        "MA_CROSSOVER": (cross.isin("BULLISH", "BEARISH") & name.contains(cross), F.concat(code, F.lit(": "), side), F.col("ma_7"), _pairs(signal=cross, ma_short=F.col("ma_7"), ma_long=F.col("ma_30"))),
        "RSI": (
            F.when(low_side, rsi <= band).otherwise(rsi >= band), F.concat(code, F.when(low_side, ": RSI oversold at ").otherwise(": RSI overbought at "), F.format_string("%.2f", rsi), F.lit(" (threshold: "), band.cast("string"), F.lit(")")),
            rsi, _pairs(rsi=rsi, threshold=band, condition=F.when(low_side, "OVERSOLD").otherwise("OVERBOUGHT")),
        ),
        "MACD": (
            crossed, F.format_string("%s: MACD %s signal detected (MACD=%.4f, Signal=%.4f, Hist=%.4f)", code, F.lower(way), macd, signal, hist),
            hist, _pairs(macd=macd, signal=signal, histogram=hist, threshold=edge, direction=way),
        ),
        "VOLATILITY": (volatility >= high, F.format_string("%s: High volatility detected at %.2f%% (threshold: %.2f%%)", code, volatility * 100, high * 100), volatility, _pairs(volatility=volatility, threshold=high)),
        "VOLUME_SPIKE": (
            F.col("has_complete_data") & (F.coalesce("confidence_score", F.lit(75.0)) >= 75) & (volume >= mean * times),
            F.concat(code, F.lit(": Volume spike detected - "), F.format_number(volume, 0), F.lit(" ("), F.format_string("%.1f", F.round(ratio, 1)), F.lit("x average)")),
            ratio, _pairs(volume=volume, avg_volume=mean.cast("long"), multiplier=ratio),
        ),
    }
    of_type = lambda n: reduce(lambda c, t: c.when(kind == t, types[t][n]), list(types)[1:], F.when(kind == next(iter(types)), types[next(iter(types))][n]))
    hits = latest.crossJoin(F.broadcast(rule_parameters(rules))).filter(F.coalesce(of_type(0), F.lit(False)))
    return hits.select("stock_id", "rule_id", F.col("price_date").alias("alert_date"), "rule_type", "severity", of_type(1).alias("message"), of_type(2).cast("double").alias("trigger_value"), of_type(3).alias("details"))


def alert_rows(hits: DataFrame) -> DataFrame:
    """Hits as rows of the alert table: the message followed by its details."""
    return hits.withColumn("message", F.concat_ws(" | ", "message", F.nullif("details", F.lit("")))).drop("details")


def new_alerts(hits: DataFrame, history: DataFrame) -> DataFrame:
    """Hits that are not in history by instrument, rule and day."""
    keys = ["stock_id", "rule_id", "alert_date"]
    return hits.join(history.select(*keys), keys, "left_anti")


def merge_alerts(history: DataFrame, hits: DataFrame) -> DataFrame:
    """history with hits; one that fires again is open again."""
    from tapeweave.operators.staging import upsert

    return upsert(history, hits, ["stock_id", "rule_id", "alert_date"], {"is_resolved": F.lit(False)})


def digest(alerts: DataFrame, *, page_size: int = 500) -> DataFrame:
    """One text for each day, severity and page, in the order of instruments and rules; a page holds so many instruments' alerts."""
    lines = F.array_sort(F.collect_list(F.struct("stock_id", "rule_id", "message")))
    page = F.floor(F.col("stock_id") / page_size).alias("page")
    return alerts.groupBy("alert_date", "severity", page).agg(F.count("*").alias("alerts"), F.array_join(F.transform(lines, lambda x: x["message"]), "\n").alias("body"))
