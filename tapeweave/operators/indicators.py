"""Technical indicators as windows over one partitioning by instrument."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tapeweave.operators.scan import scan_by_key
from tapeweave.plans.facts import cut_lineage


def by_day():
    """An instrument's bars in the order of days."""
    return Window.partitionBy("stock_id").orderBy("price_date")


def last(n: int):
    return by_day().rowsBetween(-(n - 1), 0)


def full(value: Column, counted: Column, n: int) -> Column:
    """value, where the last n rows all count."""
    return F.when(F.count(counted).over(last(n)) >= n, value)


def sma(n: int, c: str = "close_price") -> Column:
    return full(F.avg(c).over(last(n)), F.col(c), n)


def with_moving(df: DataFrame) -> DataFrame:
    """Averages of 7, 30 and 90 days, bands, yearly volatility and crossovers."""
    before = F.lag("close_price").over(by_day())
    df = df.withColumns({"_ret": F.when(before > 0, F.col("close_price") / before - 1), "ma_7": sma(7), "ma_30": sma(30), "ma_90": sma(90), "_std": full(F.stddev_samp("close_price").over(last(20)), F.col("close_price"), 20), "bollinger_middle": sma(20)})
    df = df.withColumns({"bollinger_upper": F.col("bollinger_middle") + F.col("_std") * 2, "bollinger_lower": F.col("bollinger_middle") - F.col("_std") * 2, "volatility_30": full(F.stddev_samp("_ret").over(last(30)), F.col("_ret"), 30) * F.sqrt(F.lit(252.0))})
    short, long = F.lag("ma_7").over(by_day()), F.lag("ma_30").over(by_day())
    cross = F.when((short <= long) & (F.col("ma_7") > F.col("ma_30")), "BULLISH").when((short >= long) & (F.col("ma_7") < F.col("ma_30")), "BEARISH")
    known = short.isNotNull() & long.isNotNull() & F.col("ma_7").isNotNull() & F.col("ma_30").isNotNull()
    return df.withColumn("ma_crossover_signal", F.when(known, F.coalesce(cross, F.lit("NEUTRAL")))).drop("_ret", "_std")


def _smoothing(state: list | None = None, *, rsi_moves: int = 14, fast: int = 12, slow: int = 26, signal: int = 9):
    """Starts the recurrences of an instrument, or goes on from a state: a function from each close to (rsi, macd, signal); its state() is where it is."""
    i, before, up, down, short, long, trigger = (int(state[0]), *state[1:]) if state else (0, None, None, None, None, None, None)

    def ema(old: float | None, new: float, alpha: float) -> float:
        return new if old is None else new * alpha + old * (1 - alpha)

    def step(close: float | None) -> tuple[float | None, float | None, float | None]:
        nonlocal i, before, up, down, short, long, trigger
        if close is None:
            return None, None, None
        i += 1
        if before is not None:
            up, down = ema(up, max(close - before, 0.0), 1 / rsi_moves), ema(down, max(before - close, 0.0), 1 / rsi_moves)
        before, short, long = close, ema(short, close, 2 / (fast + 1)), ema(long, close, 2 / (slow + 1))
        macd = short - long if i >= slow else None
        if macd is not None:
            trigger = ema(trigger, macd, 2 / (signal + 1))
        rsi = None
        if i > rsi_moves and (up or down):
            rsi = 100.0 if not down else 0.0 if not up else 100 - 100 / (1 + up / down)
        return rsi, macd, trigger if i >= slow + signal - 1 else None

    step.state = lambda: [float(i), before, up, down, short, long, trigger]
    return step


def _continued(state: list | None):
    """As _smoothing, over rows of which old ones are passed over, and with the state after the last row."""
    step = _smoothing(state)

    def go_on(close: float | None, old: bool, ends: bool) -> tuple:
        return (*((None, None, None) if old else step(close)), step.state() if ends else None)

    return go_on


def with_exponential(df: DataFrame, *, partitioned: bool = False) -> DataFrame:
    """df with rsi_14, macd, macd_signal and macd_histogram.

    A bar depends on all before it, so a pass over each instrument's bars in order computes them.
    Smoothing starts at the first value, without correction for the start: RSI needs 14 moves, MACD
    26 closes, its signal 9 values of it. Rows without a close are passed over.
    """
    close = df.withColumn("_close", F.col("close_price").cast("double"))
    out = scan_by_key(close, "stock_id", ["price_date"], ["_close"], _smoothing, {"rsi_14": "double", "macd": "double", "macd_signal": "double"}, partitioned=partitioned)
    return out.withColumn("macd_histogram", F.col("macd") - F.col("macd_signal")).drop("_close")


def exponential(df: DataFrame) -> DataFrame:
    """(stock_id, price_date, rsi_14, macd, macd_signal, macd_histogram) alone."""
    return with_exponential(df.select("stock_id", "price_date", "close_price")).drop("close_price")


def with_indicators(df: DataFrame, *, min_history: int = 90) -> DataFrame:
    """All indicators of the rows from the min_history-th on; atr_14 and trend_strength are never computed."""
    # numbered before the scan, whose output Spark would deal anew for a window
    moving = with_moving(df.repartition("stock_id")).withColumn("_n", F.row_number().over(by_day()))
    out = with_exponential(moving, partitioned=True).filter(F.col("_n") >= min_history).drop("_n")
    return out.withColumns({"atr_14": F.lit(None).cast("double"), "trend_strength": F.lit(None).cast("double")})


#: Bars that the windows of with_moving look back on.
TAIL = 90
#: What is known of an instrument between two batches: bars so far, the last TAIL of them, where smoothing stands, and the first close of the year.
STATE = "stock_id long, n long, tail array<struct<price_date: date, close_price: double>>, smooth array<double>, year int, first_close double"


def continue_indicators(batch: DataFrame, state: DataFrame, *, min_history: int = TAIL) -> tuple[DataFrame, DataFrame]:
    """(indicators and changes of the batch's bars, state after them), from the state before them; history is not read.

    A batch holds bars of days after those of the state, any number for each instrument; instruments may be new (an empty
    state starts all) or have no bar. Results equal those of one pass over all bars to the last bit: windows look
    back on the state's tail, smoothing goes on from its values. Rows before the min_history-th have changes but
    no indicators. change_1d and change_ytd are in percent, not rounded; both are null for an instrument's first bar and
    change_ytd is against the first close of the calendar year, from the state where the year began before the batch.
    """
    d, c = F.col("price_date"), F.col("close_price").cast("double")
    old = state.select("stock_id", F.explode("tail").alias("b")).select("stock_id", F.col("b.price_date"), F.col("b.close_price"), F.lit(True).alias("_old"))
    new = batch.select("stock_id", d, c.alias("close_price"), F.lit(False).alias("_old"))
    known = state.select("stock_id", F.col("n").alias("_had"), F.size("tail").alias("_kept"), F.col("smooth").alias("_smooth"), F.col("year").alias("_year"), F.col("first_close").alias("_first"))
    rows = old.unionByName(new).join(known, "stock_id", "left").repartition("stock_id")
    # all windows before the scan, whose output Spark would deal anew for one
    of_year = F.first(F.when(~F.col("_old"), F.col("close_price")), ignorenulls=True).over(Window.partitionBy("stock_id", F.year(d)).orderBy("price_date").rowsBetween(Window.unboundedPreceding, 0))
    whole = by_day().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = with_moving(rows).withColumns({"_place": F.row_number().over(by_day()), "_all": F.count("*").over(whole), "_before": F.lag("close_price").over(by_day()), "_opened": of_year})
    rows = rows.withColumns({"_n": F.col("_place") + F.coalesce(F.col("_had") - F.col("_kept"), F.lit(0)), "_back": F.col("_all") - F.col("_place") + 1, "_opened": F.when(F.year(d) == F.col("_year"), F.coalesce("_first", "_opened")).otherwise(F.col("_opened"))})
    rows = rows.withColumn("_ends", F.col("_back") == 1).drop("_place", "_all", "_had", "_kept", "_year")
    outputs = {"rsi_14": "double", "macd": "double", "macd_signal": "double", "_after": "array<double>"}
    rows = scan_by_key(rows, "stock_id", ["price_date"], ["close_price", "_old", "_ends"], _continued, outputs, partitioned=True, resume="_smooth").drop("_smooth")
    rows = cut_lineage(rows.withColumn("macd_histogram", F.col("macd") - F.col("macd_signal")), "indicators")  # read for both results
    out = rows.filter("not _old").withColumns({"change_1d": (F.col("close_price") - F.col("_before")) / F.col("_before") * 100, "change_ytd": F.when(F.col("_n") > 1, (F.col("close_price") - F.col("_opened")) / F.col("_opened") * 100)})
    shown = ["ma_7", "ma_30", "ma_90", "bollinger_upper", "bollinger_middle", "bollinger_lower", "volatility_30", "ma_crossover_signal", "rsi_14", "macd", "macd_signal", "macd_histogram"]
    out = out.select("stock_id", "price_date", "close_price", "change_1d", "change_ytd", *[F.when(F.col("_n") >= min_history, F.col(x)).alias(x) for x in shown])
    ends = rows.filter(F.col("_back") <= TAIL)
    bars = F.array_sort(F.collect_list(F.struct("price_date", "close_price")))
    newest = lambda x: F.max(F.when(F.col("_back") == 1, F.col(x)))
    after = ends.groupBy("stock_id").agg(newest("_n").cast("long").alias("n"), bars.alias("tail"), F.max("_after").alias("smooth"), F.year(F.max("price_date")).alias("year"), F.max_by(F.coalesce("_opened", "_first"), "price_date").alias("first_close"))
    return out, after


def backfill(df: DataFrame, start: str, end: str, *, warm_up_days: int = 365) -> DataFrame:
    """Indicators of [start, end] from trusted bars since warm_up_days before start."""
    history = df.filter(F.col("price_date").between(F.date_sub(F.lit(start).cast("date"), warm_up_days), F.lit(end).cast("date")))
    return with_indicators(history).filter(F.col("price_date").between(start, end))


def changes(df: DataFrame, *, recompute: Column | None = None) -> DataFrame:
    """One-day and year-to-date change where missing (or where recompute holds), rounded, the rest 0."""
    before, first = F.lag("close_price").over(by_day()), F.first("close_price").over(Window.partitionBy("stock_id", F.year("price_date")).orderBy("price_date"))
    redo = F.col("change_1d_pct").isNull() if recompute is None else F.col("change_1d_pct").isNull() | recompute
    return df.withColumns({
        "change_1d_pct": F.coalesce(F.when(redo, F.round((F.col("close_price") - before) / before * 100, 4)).otherwise(F.col("change_1d_pct")), F.lit(0.0)),
        "change_ytd_pct": F.coalesce(F.col("change_ytd_pct"), F.round((F.col("close_price") - first) / first * 100, 4), F.lit(0.0)),
    })


def screen_metrics(df: DataFrame) -> DataFrame:
    """Metrics of the older market screens: long averages, offset returns, drawdown, yearly highs and lows, Sharpe."""
    out = {f"ma_{n}": sma(n) for n in (7, 30, 90, 200)}
    out |= {f"ret_{n}": (F.col("close_price") / F.lag("close_price", n - 1).over(by_day()) - 1) * 100 for n in (5, 20, 60, 126, 252)}
    df = df.withColumns(out).withColumn("_ret", F.col("close_price") / F.lag("close_price").over(by_day()) - 1)
    run = by_day().rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumns({"vol_30": full(F.stddev_samp("_ret").over(last(30)), F.col("_ret"), 30) * F.sqrt(F.lit(252.0)) * 100, "vol_90": full(F.stddev_samp("_ret").over(last(90)), F.col("_ret"), 90) * F.sqrt(F.lit(252.0)) * 100, "_dd": (F.col("close_price") / F.max("close_price").over(run) - 1) * 100, "high_52w": F.max("close_price").over(last(252)), "low_52w": F.min("close_price").over(last(252))})
    df = df.withColumns({"max_drawdown": F.min("_dd").over(run), "from_high": (F.col("close_price") / F.col("high_52w") - 1) * 100, "from_low": (F.col("close_price") / F.col("low_52w") - 1) * 100})
    return df.withColumn("sharpe", F.when(F.col("vol_90") > 0, (F.col("ret_252") - 15.0) / F.col("vol_90"))).drop("_ret", "_dd")


def older_windows(df: DataFrame) -> DataFrame:
    """The older load's windows: means of 7 and 30 closes, their deviation over 30 and daily change; whole rows only, each once."""
    c = F.col("close_price")
    out = df.withColumns({"sma_7": sma(7), "sma_30": sma(30), "std_30": full(F.stddev_samp(c).over(last(30)), c, 30), "daily_change_pct": (c / F.lag(c).over(by_day()) - 1) * 100})
    return out.dropna().dropDuplicates()
