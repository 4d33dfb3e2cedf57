"""Backtests: entries and exits by rows, trade metrics, rollups, and the portfolio simulator."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tapeweave.functions.scalars import exact_mean
from tapeweave.operators.advisory import actionable, rank_key
from tapeweave.operators.indicators import by_day
from tapeweave.operators.running import running_equity
from tapeweave.operators.scan import scan_by_key


def candidate_trades(screened: DataFrame, *, horizon: int = 10, cost_pct: float = 0.2, top_n: int = 5, keep: Column | Callable[[pd.DataFrame], pd.Series] | None = None) -> DataFrame:
    """The top_n actionable rows of each day that no gate rejects, with exit `horizon` rows later; returns in percent, rounded to 4.

    keep: a filter of recommendations before the ranking: a condition, as for the risk of bad trades, or a function of a
    day's actionable rows that says which stay; it is called once a day, with that day's rows alone.
    """
    df = screened.withColumns({"exit_date": F.lead("price_date", horizon).over(by_day()), "exit_price": F.lead("close_price", horizon).over(by_day()), "_row": F.row_number().over(by_day())})
    df = df.filter(actionable() & keep if isinstance(keep, Column) else actionable())
    if callable(keep) and not isinstance(keep, Column):
        df = df.groupBy("price_date").applyInPandas(lambda day: day[keep(day)], df.schema)
    order = Window.partitionBy("price_date").orderBy(rank_key().desc(), "stock_id")
    df = df.withColumn("_n", F.row_number().over(order)).filter((F.col("_n") <= top_n) & F.col("exit_date").isNotNull()).drop("_n")
    gross = (F.col("exit_price") - F.col("close_price")) / F.col("close_price") * 100
    return df.select("stock_id", "stock_code", F.col("price_date").alias("entry_date"), "exit_date", F.col("close_price").alias("entry_price"), "exit_price", F.round(gross, 4).alias("gross_return_pct"), F.round(gross - cost_pct, 4).alias("net_return_pct"), "score", F.col("agreement").alias("confidence"), "_row")


def without_overlap(trades: DataFrame, *, horizon: int = 10, outlier: float = 50.0) -> DataFrame:
    """Trades of an instrument that begin after the one before has ended; then outliers are dropped.

    Greedy from the first, by a pass over each instrument's trades in order. A trade that is dropped
    as an outlier has blocked its days all the same.
    """

    def start():
        until = None

        def step(entry, exit_) -> tuple[bool]:
            nonlocal until
            free = until is None or entry > until
            if free:
                until = exit_
            return (free,)

        return step

    kept = scan_by_key(trades, "stock_id", ["entry_date"], ["entry_date", "exit_date"], start, {"_free": "boolean"})
    return kept.filter(F.col("_free") & (F.abs("gross_return_pct") <= outlier)).drop("_row", "_free")


def not_bad(probability: str = "bad_probability", *, most: float = 0.55) -> Column:
    """The block on bad trades: rows whose estimated risk is `most` or more go; those without an estimate stay."""
    return F.col(probability).isNull() | (F.col(probability) < most)


def trade_metrics(trades: DataFrame, by: list[str]) -> DataFrame:
    """Counts, rates, averages and profit factor (null without losses) of each group."""
    r = F.col("net_return_pct")
    win, loss = r > 0, r <= 0
    gain, lost = F.sum(F.when(win, r)), -F.sum(F.when(loss, r))
    return trades.groupBy(*by).agg(
        F.count("*").alias("trades"), F.count_if(win).alias("wins"), F.count_if(loss).alias("losses"), (F.count_if(win) / F.count("*") * 100).alias("win_rate"), exact_mean(r).alias("avg_return"), exact_mean(F.when(win, r)).alias("avg_win"), exact_mean(F.when(loss, r)).alias("avg_loss"),
        F.when(lost > 0, F.coalesce(gain, F.lit(0.0)) / lost).alias("profit_factor"), F.max(r).alias("best"), F.min(r).alias("worst"), (F.count_if(F.col("gross_return_pct") > 0) / F.count("*")).alias("directional_accuracy"),
    )


def max_drawdown(trades: DataFrame, by: str, order: list[str]) -> DataFrame:
    """(by, max_drawdown_pct): of compounded returns in a total order of a run's trades, the peak at 1 at least.

    A trade of -100 % is a drawdown of 100. A run's trades spread over all tasks.
    """
    rows = running_equity(trades, by, order)
    return rows.groupBy(by).agg(F.max((F.col("peak") - F.col("equity")) / F.col("peak") * 100).alias("max_drawdown_pct"))


def equity_curve(trades: DataFrame, run: str = "run_id", order: tuple[str, ...] = ("entry_date", "trade_id")) -> DataFrame:
    """Compounded return in percent after each trade of a run; losses of all or more count for nothing."""
    rows = running_equity(trades, run, list(order), skip_ruin=True)
    return rows.withColumn("cumulative_return_pct", (F.col("equity") - 1) * 100).drop("equity", "peak")


def year_equity(trades: DataFrame, run: str = "run_id", order: list[str] | None = None) -> DataFrame:
    """(run, year, start_equity, end_equity): equity as of the ends of the years of entry, from 1; years without trades keep it."""
    order = order or ["entry_date", "trade_id"]
    rows = running_equity(trades, run, order).groupBy(run, F.year("entry_date").alias("year")).agg(F.max_by("equity", F.struct(*order)).alias("_end"))
    every = rows.groupBy(run).agg(F.explode(F.sequence(F.min("year"), F.max("year"))).alias("year")).join(rows, [run, "year"], "left")
    upto = Window.partitionBy(run).orderBy("year").rowsBetween(Window.unboundedPreceding, 0)
    out = every.withColumn("end_equity", F.last("_end", ignorenulls=True).over(upto))
    return out.select(run, "year", F.coalesce(F.lag("end_equity").over(Window.partitionBy(run).orderBy("year")), F.lit(1.0)).alias("start_equity"), "end_equity")


def simulate_portfolios(trades: DataFrame, *, run: str = "run_id", cash: float = 100_000.0, slots: int = 3, size_pct: float = 20.0, daily_limit: int = 1, cooldown_days: int = 0) -> DataFrame:
    """Accepted and rejected trades of each run, with equity after the run.

    A run's state is sequential, so a run is one group; runs are independent. Trades go by day, score
    and confidence downwards, and code. Positions that end by then are closed first; a loss keeps the
    portfolio from entering for cooldown_days. A position takes size_pct of equity, as far as cash goes.
    """
    schema = f"{run} long, stock_code string, entry_date date, exit_date date, accepted boolean, reason string, position_value double, pnl double, equity double, max_drawdown_pct double"

    def play(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.assign(_s=-frame["score"], _c=-frame["confidence"]).sort_values(["entry_date", "_s", "_c", "stock_code"])
        money, held, out, until, peak, worst = cash, [], [], None, cash, 0.0
        entered: dict = {}

        def close(day) -> None:
            nonlocal money, until, peak, worst
            for p in sorted((p for p in held if day is None or p["exit"] <= day), key=lambda p: (p["exit"], p["code"])):
                held.remove(p)
                money += p["value"] + p["pnl"]
                if p["pnl"] < 0 and cooldown_days:
                    until = max(until or p["exit"], p["exit"] + timedelta(days=cooldown_days))
                equity = money + sum(x["value"] for x in held)
                peak = max(peak, equity)
                worst = max(worst, (peak - equity) / peak * 100)

        for t in frame.itertuples():
            close(t.entry_date)
            equity = money + sum(p["value"] for p in held)
            reason = None
            if until is not None and t.entry_date <= until:
                reason = "cooldown"
            elif entered.get(t.entry_date, 0) >= daily_limit:
                reason = "daily_entry_limit"
            elif len(held) >= slots:
                reason = "max_concurrent_positions"
            value = 0.0 if reason else min(equity * size_pct / 100, money)
            if reason is None and value <= 0:
                reason = "no_cash"
            pnl = value * t.net_return_pct / 100
            if reason is None:
                money -= value
                held.append({"exit": t.exit_date, "code": t.stock_code, "value": value, "pnl": pnl})
                entered[t.entry_date] = entered.get(t.entry_date, 0) + 1
            out.append((getattr(t, run), t.stock_code, t.entry_date, t.exit_date, reason is None, reason, value, pnl if reason is None else 0.0))
        close(None)
        done = pd.DataFrame(out, columns=schema.replace(",", "").split()[0:16:2])
        return done.assign(equity=money, max_drawdown_pct=worst)

    return trades.select(run, "stock_code", "entry_date", "exit_date", "net_return_pct", "score", "confidence").groupBy(run).applyInPandas(play, schema)


def rollup_years(trades: DataFrame, run: str = "run_id") -> DataFrame:
    """Trade metrics of every year from a run's first to its last, years without trades included."""
    years = trades.groupBy(run).agg(F.explode(F.sequence(F.year(F.min("entry_date")), F.year(F.max("entry_date")))).alias("year"))
    found = trade_metrics(trades.withColumn("year", F.year("entry_date")), [run, "year"])
    return years.join(found, [run, "year"], "left").fillna(0, ["trades", "wins", "losses"])


def return_bucket(r: Column) -> Column:
    return F.when(r >= 10, ">= 10%").when(r >= 5, "5% to 10%").when(r >= 0, "0% to 5%").when(r >= -5, "-5% to 0%").when(r >= -10, "-10% to -5%").otherwise("< -10%")


def match_positions(positions: DataFrame, trades: DataFrame, keys: list[str]) -> DataFrame:
    """Positions with their trades, equal keys paired one by one in the order of trade_id."""
    nth = lambda order: F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    return positions.withColumn("_n", nth("position_id")).join(trades.withColumn("_n", nth("trade_id")), [*keys, "_n"], "left").drop("_n")


def decision(runs: DataFrame, *, as_of: str, most: int = 4) -> DataFrame:
    """One verdict from the last comparable runs, one for each day: means, worst drawdown, and a colour."""
    last = runs.filter(F.col("run_date") <= F.lit(as_of).cast("date")).withColumn("_n", F.row_number().over(Window.partitionBy("run_date").orderBy(F.col("run_id").desc()))).filter("_n = 1").orderBy(F.col("run_date").desc()).limit(most)
    out = last.agg(F.count("*").alias("runs"), F.coalesce(F.avg("win_rate"), F.lit(0.0)).alias("win_rate"), F.coalesce(F.avg("return_pct"), F.lit(0.0)).alias("return_pct"), F.coalesce(F.avg("profit_factor"), F.lit(0.0)).alias("profit_factor"), F.coalesce(F.max("max_drawdown_pct"), F.lit(0.0)).alias("max_drawdown_pct"))
    return out.withColumn("signal", colour())


def colour() -> Column:
    """GREEN, YELLOW or RED by win_rate, return_pct, profit_factor and max_drawdown_pct; what is null does not pass."""
    green = (F.col("win_rate") >= 45) & (F.col("return_pct") > 0) & (F.col("profit_factor") >= 1.2) & (F.col("max_drawdown_pct") <= 25)
    yellow = (F.col("win_rate") >= 35) & (F.col("return_pct") > -2) & (F.col("profit_factor") >= 0.9) & (F.col("max_drawdown_pct") <= 35)
    return F.when(green, "GREEN").when(yellow, "YELLOW").otherwise("RED")
