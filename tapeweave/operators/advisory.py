"""Scores, signals, gates and policy: decision tables as expressions over all instruments and days."""

from __future__ import annotations

from collections import deque

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tapeweave.functions.scalars import mean_of, pct_distance

# Weights of the score's parts, thresholds of the profile, and the gates.
WEIGHTS = {"technical": 0.25, "momentum": 0.32, "volatility": 0.23, "trend": 0.15, "volume": 0.05}
RSI = {"strong_oversold": 25, "oversold": 35, "overbought": 72, "strong_overbought": 80}
SIGNAL_ORDER = ("STRONG_BUY", "BUY", "HOLD", "SELL", "STRONG_SELL")


def bands(x: Column, steps: list[tuple[float, float]], default: float, *, inclusive: bool = False) -> Column:
    """The value of the first step that x is below (or up to, inclusive), else default; null stays null."""
    out = F.when(x.isNull(), F.lit(None).cast("double"))
    for edge, value in steps:
        out = out.when((x <= edge) if inclusive else (x < edge), float(value))
    return out.otherwise(float(default))


def with_score(df: DataFrame) -> DataFrame:
    """Sub-scores, total, trust multiplier and category. Columns as the snapshot has them."""
    rsi, diff, macd = F.col("rsi_14"), F.col("macd") - F.col("macd_signal"), F.col("macd")
    rsi_part = F.when(rsi.isNull(), F.lit(None).cast("double")).when(rsi.between(40, 60), 100.0).when(rsi.between(30, 70), 80.0).when(rsi.between(20, 80), 60.0).when(rsi < 20, 40.0).otherwise(20.0)
    macd_part = F.when(diff.isNull(), F.lit(None).cast("double")).when((diff > 0) & (macd > 0), 100.0).when(diff > 0, 80.0).when((diff < 0) & (macd < 0), 20.0).when(diff < 0, 40.0).otherwise(60.0)

    def move(name: str, a: float, b: float, c: float, d: float, low: float) -> Column:
        """Best in [a, b], then (b, c], [0, a), (c, d], above d, and below 0 in two steps."""
        x = F.col(name)
        return F.when(x.isNull(), F.lit(None).cast("double")).when(x.between(a, b), 100.0).when((x > b) & (x <= c), 80.0).when((x >= 0) & (x < a), 70.0).when((x > c) & (x <= d), 60.0).when(x > d, 40.0).when(x >= (-2 if name == "change_1d" else -5), 50.0).when(x >= low, 30.0).otherwise(20.0)

    over = F.when(F.col("ma_30") > 0, (F.col("close_price") - F.col("ma_30")) / F.col("ma_30") * 100)
    over_part = F.when(over > 0, F.least(70 + over * 3, F.lit(100.0))).when(over <= 0, F.greatest(50 + over * 2, F.lit(20.0)))
    gap = F.when(F.col("ma_90") > 0, (F.col("ma_30") - F.col("ma_90")) / F.col("ma_90") * 100)
    gap_part = F.when(gap.isNull(), F.lit(None).cast("double")).when(gap > 5, 100.0).when(gap > 2, 85.0).when(gap > 0, 70.0).when(gap > -2, 50.0).when(gap > -5, 35.0).otherwise(20.0)
    p, m30, m90 = F.col("close_price"), F.col("ma_30"), F.col("ma_90")
    stand = F.when(m30.isNull() | m90.isNull(), F.lit(None).cast("double")).when((p > m30) & (m30 > m90), 100.0).when((p > m30) | (p > m90), 70.0).when((p < m30) & (m30 < m90), 20.0).otherwise(40.0)
    ratio = F.col("volume_ratio")
    rising = F.when(ratio > 2, 100.0).when(ratio > 1.5, 85.0).when(ratio > 1, 70.0).otherwise(50.0)
    falling = F.when(ratio > 2, 30.0).when(ratio > 1.5, 40.0).when(ratio > 1, 55.0).otherwise(70.0)
    parts = {
        "technical_score": mean_of(rsi_part, macd_part, default=50.0),
        "momentum_score": mean_of(move("change_1d", 2, 5, 10, 15, -5), move("change_10d", 5, 20, 30, 40, -10), move("change_20d", 8, 25, 35, 45, -12), over_part, default=50.0),
        "volatility_score": F.coalesce(bands(F.col("volatility_30"), [(0.2, 100), (0.3, 85), (0.4, 70), (0.5, 55), (0.7, 40)], 20), F.lit(50.0)),
        "trend_score": mean_of(gap_part, stand, default=50.0),
        "volume_score": F.when(ratio.isNull(), 50.0).when(F.col("change_1d") > 0, rising).otherwise(falling),
    }
    df = df.withColumns(parts)
    total = sum((F.col(f"{k}_score") * w for k, w in list(WEIGHTS.items())[1:]), F.col("technical_score") * WEIGHTS["technical"])
    days, conf, bar, flag = F.col("trusted_history_days"), F.col("confidence_score"), F.col("bar_status"), F.col("data_quality_flag")
    trust = F.when(days >= 90, 1.0).when(days >= 60, 0.85).when(days >= 30, 0.65).otherwise(0.4) * F.when(flag == "GOOD", 1.0).when(flag == "INCOMPLETE", 0.9).otherwise(0.5) * F.when(conf.isNull(), 0.85).when(conf >= 80, 1.0).when(conf >= 70, 0.9).when(conf >= 60, 0.75).otherwise(0.5) * F.when(bar.isin("RECONCILED", "OFFICIAL"), 1.0).when(bar == "OBSERVED", 0.8).otherwise(0.6)
    df = df.withColumn("trust_multiplier", trust).withColumn("score", total / sum(WEIGHTS.values()) * F.col("trust_multiplier"))
    return df.withColumn("score_category", F.when(F.col("score") >= 80, "EXCELLENT").when(F.col("score") >= 60, "GOOD").when(F.col("score") >= 40, "FAIR").when(F.col("score") >= 20, "POOR").otherwise("VERY_POOR"))


def with_signal(df: DataFrame) -> DataFrame:
    """signal, agreement and the votes' reasons. Ties go to the first of the signal order."""
    rsi, macd, diff = F.col("rsi_14"), F.col("macd"), F.col("macd") - F.col("macd_signal")
    vote = lambda s, w, why: F.struct(F.lit(s).alias("s"), F.lit(float(w)).alias("w"), F.lit(why).alias("why"))
    rsi_vote = F.when(rsi <= RSI["strong_oversold"], vote("STRONG_BUY", 1.5, "RSI strongly oversold")).when(rsi <= RSI["oversold"], vote("BUY", 1.0, "RSI oversold")).when(rsi >= RSI["strong_overbought"], vote("STRONG_SELL", 1.5, "RSI strongly overbought")).when(rsi >= RSI["overbought"], vote("SELL", 1.0, "RSI overbought")).when(rsi.isNotNull(), vote("HOLD", 0.5, "RSI neutral"))
    macd_vote = F.when((diff > 0) & (macd > 0), vote("STRONG_BUY", 1.2, "MACD rising above zero")).when(diff > 0, vote("BUY", 0.8, "MACD rising")).when((diff < 0) & (macd < 0), vote("STRONG_SELL", 1.2, "MACD falling below zero")).when(diff < 0, vote("SELL", 0.8, "MACD falling")).when(diff.isNotNull(), vote("HOLD", 0.3, "MACD flat"))
    off = pct_distance(F.col("close_price"), F.col("ma_30"))
    m30, m90 = F.col("ma_30"), F.col("ma_90")
    ma_vote = F.when(m30 > m90, vote("STRONG_BUY", 1.3, "Short average above long")).when(m30 < m90, vote("STRONG_SELL", 1.3, "Short average below long")).when(off > 5, vote("BUY", 0.7, "Price above average")).when(off < -5, vote("SELL", 0.7, "Price below average")).otherwise(vote("HOLD", 0.5, "Averages neutral"))
    ratio = F.col("volume_ratio")
    volume_vote = F.when(ratio > 2, vote("BUY", 0.6, "Volume surge")).when(ratio > 1.5, vote("BUY", 0.4, "Volume above average")).when(ratio < 0.5, vote("HOLD", 0.2, "Volume thin"))
    df = df.withColumn("_votes", F.filter(F.array(rsi_vote, macd_vote, ma_vote, volume_vote), lambda v: v.isNotNull()))
    weight = lambda s: F.aggregate(F.filter("_votes", lambda v: v["s"] == s), F.lit(0.0), lambda a, v: a + v["w"])
    df = df.withColumns({f"_{s}": weight(s) for s in SIGNAL_ORDER}).withColumn("_all", sum((F.col(f"_{s}") for s in SIGNAL_ORDER[1:]), F.col(f"_{SIGNAL_ORDER[0]}")))
    df = df.withColumns({f"_{s}": F.when(F.col("_all") > 0, F.col(f"_{s}") / F.col("_all")).otherwise(0.0) for s in SIGNAL_ORDER})
    top = F.greatest(*[F.col(f"_{s}") for s in SIGNAL_ORDER])
    best = F.when(F.col(f"_{SIGNAL_ORDER[0]}") == top, SIGNAL_ORDER[0])
    for s in SIGNAL_ORDER[1:]:
        best = best.when(F.col(f"_{s}") == top, s)
    buy, sell, hold = F.col("_STRONG_BUY") + F.col("_BUY"), F.col("_STRONG_SELL") + F.col("_SELL"), F.col("_HOLD")
    mixed, idle = (buy > 0.3) & (sell > 0.3), hold > 0.5
    share = F.when(mixed, top * 0.6).when(idle, hold).otherwise(top)
    out = df.withColumns({"signal": F.when(F.col("_all") == 0, "HOLD").when(~mixed & idle, "HOLD").otherwise(best), "agreement": F.when(F.col("_all") == 0, 0.5).otherwise(F.least(F.greatest(share, F.lit(0.1)), F.lit(0.95))), "reasons": F.transform("_votes", lambda v: v["why"])})
    return out.drop("_votes", "_all", *[f"_{s}" for s in SIGNAL_ORDER])


def with_policy(df: DataFrame) -> DataFrame:
    """action, target and stop, upside, downside, reward over risk, and risk level."""
    action = F.when(F.col("signal") == "SELL", "AVOID").when(F.col("signal") == "STRONG_SELL", "STRONGLY_AVOID").otherwise(F.col("signal"))
    p, strong, buy = F.col("close_price"), F.col("signal") == "STRONG_BUY", F.col("signal") == "BUY"
    target, stop = F.when(strong, p * 1.25).when(buy, p * 1.2), F.when(strong, p * 0.92).when(buy, p * 0.94)
    vol, rsi = F.col("volatility_30"), F.col("rsi_14")
    factors = sum((F.coalesce(k, F.lit(False)).cast("int") for k in (F.col("agreement") < 0.6, F.col("score") < 50, (rsi != 0) & ((rsi < 25) | (rsi > 75)))), F.coalesce(vol < 0.2, F.lit(False)).cast("int"))
    risk = F.when(vol > 0.5, "HIGH").when(factors >= 3, "HIGH").when(factors >= 1, "MEDIUM").otherwise("LOW")
    df = df.withColumns({"action": action, "target_price": target, "stop_price": stop, "risk_level": risk})
    up, down = (F.col("target_price") - p) / p * 100, (p - F.col("stop_price")) / p * 100
    return df.withColumns({"upside_pct": up, "downside_pct": down, "reward_risk": F.when(down != 0, up / down)})


def with_gates(df: DataFrame) -> DataFrame:
    """rejection_reason: the first gate that fails, eligibility before selection; null where none does."""
    off = lambda c: F.coalesce(c, F.lit(False))  # noqa: E731  a null passes
    reason = (
        F.when(off(F.col("close_price") < 8), "min_price").when(off(F.col("volatility_30") > 0.75), "max_volatility").when(off(F.col("volume_ratio") < 0.8), "min_volume_ratio")
        .when(off(F.col("trusted_history_days") < 30), "min_history").when(off(F.col("confidence_score") < 60), "min_confidence").when(~F.coalesce(F.col("has_complete_data"), F.lit(False)), "incomplete_data")
        .when(~F.coalesce(F.col("bar_status").isin("RECONCILED", "OFFICIAL"), F.lit(False)), "unofficial_bar").when(off(F.col("drawdown_20d") < 1), "near_high").when(off(F.col("change_20d") > 12), "overextended")
        .when(off(~F.col("rsi_14").between(40, 75)), "rsi_out_of_range").when(~F.col("action").isin("BUY", "STRONG_BUY"), "not_a_buy").when(F.col("score") < 70, "min_score").when(F.col("agreement") < 0.6, "min_agreement")
    )
    if "probability" in df.columns:
        reason = reason.when(F.col("probability").isNull(), "probability_missing").when(F.col("probability") < 0.55, "min_probability")
    return df.withColumn("rejection_reason", reason)


def rank_key(probability: str | None = None) -> Column:
    key = F.round("score", 9) * 1000 + F.round("agreement", 9) * 100  # equal scores tie, however they were summed
    return key + F.coalesce(F.col(probability), F.lit(0.0)) if probability else key


def actionable() -> Column:
    return F.col("action").isin("BUY", "STRONG_BUY") & F.col("rejection_reason").isNull()


def positions_before(df: DataFrame, *, day: str = "price_date", daily_limit: int = 1, capacity: int = 3, lookback_days: int = 21) -> DataFrame:
    """(day, open_before): positions approved within the `lookback_days` before each day that has actionable rows.

    What a day may approve depends on the days before, so days are folded in order. The rows are
    counted by day first: the fold sees a number for each day of the calendar, whatever the market.
    """
    kind = df.schema[day].dataType.simpleString()
    per_day = df.groupBy(F.col(day).alias("day")).agg(F.count_if(actionable()).alias("able")).filter("able > 0").withColumn("book", F.lit(0))

    def fold(frame: pd.DataFrame) -> pd.DataFrame:
        recent: deque = deque()  # (day, approvals)
        before = []
        for at, able in frame.sort_values("day")[["day", "able"]].itertuples(index=False):
            while recent and (at - recent[0][0]).days > lookback_days:
                recent.popleft()
            open_ = sum(k for _, k in recent)
            before.append((at, open_))
            recent.append((at, min(daily_limit, max(capacity - open_, 0), able)))
        return pd.DataFrame(before, columns=[day, "open_before"])

    return per_day.groupBy("book").applyInPandas(fold, f"{day} {kind}, open_before int")


def portfolio_gate(df: DataFrame, *, day: str = "price_date", daily_limit: int = 1, capacity: int = 3, lookback_days: int = 21, open_positions: Column | None = None, size: float = 0.2) -> DataFrame:
    """rank among a day's actionable rows that no gate rejects, and the approvals that limit and free slots allow.

    open_positions: those that are open before the row's day; by default what the rows of the days before got approved. Rejected
    rows have no rank and are non_actionable.
    """
    if open_positions is None:
        book = positions_before(df, day=day, daily_limit=daily_limit, capacity=capacity, lookback_days=lookback_days)
        df = df.join(F.broadcast(book), day, "left")  # a row for each day of the calendar
    else:
        df = df.withColumn("open_before", open_positions)
    df = df.withColumn("_able", actionable())
    order = Window.partitionBy(day).orderBy(rank_key("probability" if "probability" in df.columns else None).desc(), "stock_code")
    # only rows that have a rank are dealt by day
    ranked = df.filter("_able").withColumn("rank", F.row_number().over(order))
    df = ranked.unionByName(df.filter("_able is null or not _able").withColumn("rank", F.lit(None).cast("int")))
    df = df.withColumns({"_free": F.greatest(F.lit(capacity) - F.coalesce("open_before", F.lit(0)), F.lit(0))})
    approved = F.col("_able") & (F.col("rank") <= F.least(F.lit(daily_limit), F.col("_free")))
    reason = F.when(~F.col("_able"), "non_actionable").when(approved, None).when(F.col("_free") >= daily_limit, "daily_entry_limit").otherwise("max_concurrent_positions")
    df = df.withColumns({"portfolio_approved": F.coalesce(approved, F.lit(False)), "portfolio_reason": reason})
    df = df.withColumn("portfolio_rank", F.when(F.col("portfolio_approved"), F.col("rank")))
    return df.withColumn("position_size", F.when(F.col("portfolio_approved"), F.lit(size))).drop("_able", "_free", "open_before")


def with_guard(df: DataFrame, *, least_drawdown: float = 1.0, most_change: float = 12.0, near_high: float = 0.99, most_momentum: float = 8.0) -> DataFrame:
    """guarded: too near the 20-day high, risen too far, or near the high on strong momentum; nulls pass."""
    off = lambda c: F.coalesce(c, F.lit(False))
    near = (F.col("close_price") >= F.col("high_20d") * near_high) & off(F.col("change_10d") > most_momentum)
    return df.withColumn("guarded", off(F.col("drawdown_20d") < least_drawdown) | off(F.col("change_20d") > most_change) | near)


def gated(snapshot: DataFrame) -> DataFrame:
    """Score, signal, policy and gates of snapshot rows: what is known of a row by itself."""
    return with_gates(with_policy(with_signal(with_score(snapshot))))


def screen(snapshot: DataFrame) -> DataFrame:
    """Score, signal, policy, gates and portfolio approval of snapshot rows."""
    return portfolio_gate(gated(snapshot))
