"""The older research screens over whole histories: metrics, scores, lists and phased purchase plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Points of the trend score, the risk-free rate in percent, and bars in a year.
TREND = (("price", "ma_7", 15), ("price", "ma_30", 20), ("price", "ma_90", 25), ("price", "ma_200", 40), ("ma_7", "ma_30", 10), ("ma_30", "ma_90", 10))
RISK_FREE, YEAR = 15.0, 252
#: Bars back that returns count from; the last bar is the first.
OFFSETS = {"ret_1w": 5, "ret_1m": 20, "ret_3m": 60, "ret_6m": 126, "ret_1y": 252}


def screen(bars: DataFrame, *, least: int = 30) -> DataFrame:
    """One row for each instrument with `least` bars or more: its metrics, trend score, 10x and quality scores as of its last bar.

    Where history is too short a mean is the price, and a return or volatility 0. ret_ytd counts from the first
    bar of the market's last year. One shuffle by instrument, whatever the number of metrics.
    """
    back = F.row_number().over(Window.partitionBy("stock_id").orderBy(F.col("price_date").desc()))
    before = F.lag("close_price").over(Window.partitionBy("stock_id").orderBy("price_date"))
    year = bars.agg(F.year(F.max("price_date")).alias("_year"))
    rows = bars.withColumns({"_k": back, "_ret": F.col("close_price") / before - 1}).crossJoin(F.broadcast(year))
    c, k = F.col("close_price"), F.col("_k")
    upto = lambda n, x: F.when(k <= n, x)
    found = rows.groupBy("stock_id").agg(
        F.count("*").alias("points"), F.max(F.when(k == 1, c)).alias("price"), *[F.avg(upto(n, c)).alias(f"ma_{n}") for n in (7, 30, 90, 200)], *[F.max(F.when(k == n, c)).alias(name) for name, n in OFFSETS.items()],
        *[F.stddev_samp(upto(n, F.col("_ret"))).alias(f"vol_{n}") for n in (30, 90)], F.avg("_ret").alias("_mean"), F.max(upto(YEAR, c)).alias("high_52w"), F.min(upto(YEAR, c)).alias("low_52w"), F.min_by(c, F.when(F.year("price_date") == F.col("_year"), F.col("price_date"))).alias("_opened"),
    )
    p, points = F.col("price"), F.col("points")
    change = lambda x: (p / x - 1) * 100
    out = {f"ma_{n}": F.when(points >= n, F.col(f"ma_{n}")).otherwise(p) for n in (7, 30, 90, 200)}
    out |= {name: F.when(points >= n, change(F.col(name))).otherwise(0.0) for name, n in OFFSETS.items()}
    out |= {f"vol_{n}": F.when(points >= n, F.col(f"vol_{n}") * F.sqrt(F.lit(float(YEAR))) * 100).otherwise(0.0) for n in (30, 90)}
    out |= {"ret_ytd": F.coalesce(change(F.col("_opened")), F.lit(0.0)), "from_high": change(F.col("high_52w")), "from_low": change(F.col("low_52w"))}
    found = found.filter(points >= least).withColumns(out)
    trend = sum((F.when(F.col(a) > F.col(b), n).otherwise(0) for a, b, n in TREND[1:]), F.when(F.col(TREND[0][0]) > F.col(TREND[0][1]), TREND[0][2]).otherwise(0))
    found = found.withColumns({"trend_score": F.least(trend, F.lit(100)), "sharpe": F.when(F.col("vol_90") > 0, (F.col("_mean") * YEAR * 100 - RISK_FREE) / F.col("vol_90")).otherwise(0.0)})
    return found.withColumns({"score_10x": tenfold_score(), "quality_score": quality_score()}).drop("_mean", "_opened")


def tenfold_score() -> Column:
    """Cheap, moving, trending, volatile: what may grow tenfold."""
    return 20 / F.col("price") * 30 + F.col("ret_1m") / 10 * 25 + F.col("trend_score") * 25 + F.col("vol_30") / 10 * 10 + F.col("ret_ytd") / 10 * 10


def quality_score() -> Column:
    """Steady growth: trend, returns up to a limit, low volatility, Sharpe, length of history."""
    most = lambda x, n: F.least(x, F.lit(float(n)))
    return F.col("trend_score") * 0.30 + most(F.col("ret_ytd"), 100) * 0.20 + most(F.col("ret_1m"), 80) * 0.15 + (100 - most(F.col("vol_30"), 100)) * 0.15 + F.col("sharpe") * 10 * 0.10 + most(F.col("points") / 10, 100) * 0.10


def list_rules() -> dict[str, tuple[Column, Column, int]]:
    """name: (who is on it, by what it goes, downwards; how many)."""
    col, every = F.col, F.lit(True)
    price, trend, month, ytd, vol = col("price"), col("trend_score"), col("ret_1m"), col("ret_ytd"), col("vol_30")
    quality = (trend >= 90) & (ytd > 5) & (ytd < 300) & (vol < 100) & (price < 100) & (col("sharpe") > 0) & (col("points") > 500)
    return {
        "best_ytd": (every, ytd, 20), "worst_ytd": (every, -ytd, 20), "strongest_trend": (every, trend, 20), "value_near_low": ((col("from_low") < 20) & (trend > 40), trend, 20), "momentum": (every, month * 0.6 + trend * 0.4, 20),
        "best_sharpe": (col("sharpe") > 0, col("sharpe"), 20), "buy": ((trend >= 60) & (ytd > 0) & (vol < 80), trend, 10), "watch": ((vol > 80) & (month > 20), month, 10),
        "tenfold_cheap": ((price < 10) & (trend >= 80) & (month > 20), month, 15), "tenfold_affordable": ((price >= 10) & (price < 20) & (trend >= 80) & (month > 15), month, 15), "tenfold_proven": ((price < 30) & (col("ret_1y") > 400) & (trend >= 60), col("ret_1y"), 15),
        "tenfold_turnaround": ((price < 15) & (col("from_low") < 30) & (month > 30) & (trend >= 60), month, 15), "tenfold_top": ((price < 30) & (trend >= 60) & (month > 0), col("score_10x"), 20),
        "quality_top": (quality, col("quality_score"), 25), "quality_low_price": (quality & (price < 20), col("quality_score"), 15), "quality_mid_price": (quality & (price >= 20) & (price < 50), col("quality_score"), 15), "quality_blue_chip": (quality & (price >= 50), col("quality_score"), 15),
    }


def lists(screened: DataFrame) -> DataFrame:
    """(list, place, stock_id, value): all lists in one pass; ties by instrument."""
    entries = [F.when(on, F.struct(F.lit(name).alias("list"), by.cast("double").alias("value"), F.lit(n).alias("most"))) for name, (on, by, n) in list_rules().items()]
    rows = screened.select("stock_id", F.explode(F.filter(F.array(*entries), lambda e: e.isNotNull())).alias("e")).select("stock_id", "e.*")
    place = F.row_number().over(Window.partitionBy("list").orderBy(F.desc("value"), "stock_id"))
    most = max(n for _, _, n in list_rules().values())
    return rows.withColumn("place", place).filter((F.col("place") <= most) & (F.col("place") <= F.col("most"))).drop("most")


def purchase_plan(screened: DataFrame, *, first: float = 8750.0, then: float = 8000.0, monthly: float = 2500.0, months: int = 10, multiples: tuple[float, ...] = (1.5, 2.0, 2.5, 3.0, 5.0)) -> DataFrame:
    """screened with whole shares that each phase buys at the last price, what they cost, and their worth at multiples of it."""
    p = F.col("price")
    phases = {"phase_1": F.floor(F.lit(first) / p), "phase_2": F.floor(F.lit(then) / p), "phase_3": F.floor(F.lit(monthly) / p * months)}
    out = screened.withColumns({k: v.cast("long") for k, v in phases.items()}).withColumn("shares", F.col("phase_1") + F.col("phase_2") + F.col("phase_3"))
    out = out.withColumn("cost", F.col("shares") * p)
    return out.withColumns({f"worth_{str(m).replace('.', '_').removesuffix('_0')}x": F.col("cost") * m for m in multiples})
