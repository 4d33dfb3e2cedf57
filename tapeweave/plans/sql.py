"""The market in SQL: tables, views and set-returning functions of a session.

register() names everything; the rest is Spark's SQL. Functions are SQL table functions, so a lateral call for
every row of a table is one join, and their parameters reach the scans as filters where they are constants.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeweave.operators import alerts, backtest
from tapeweave.plans import market, snapshot, views

#: Table functions: (name, parameters, columns, body).
FUNCTIONS = (
    ("price_history", "code STRING, d1 DATE, d2 DATE", "price_date DATE, close_price DOUBLE, volume BIGINT, change_1d_pct DOUBLE", "SELECT p.price_date, p.close_price, p.volume, p.change_1d_pct FROM stocks s JOIN prices p ON p.stock_id = s.stock_id WHERE s.stock_code = price_history.code AND p.price_date BETWEEN price_history.d1 AND price_history.d2"),
    ("active_alerts", "code STRING", "rule_id BIGINT, alert_date DATE, severity STRING, message STRING", "SELECT a.rule_id, a.alert_date, a.severity, a.message FROM stocks s JOIN alerts a ON a.stock_id = s.stock_id WHERE s.stock_code = active_alerts.code AND NOT a.is_resolved"),
)


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Base tables by name."""
    return {
        "prices": market.prices(spark, sf_dir), "stocks": market.stocks(spark, sf_dir), "sectors": market.sectors(spark, sf_dir), "staging": market.staging(spark, sf_dir),
        "indicators": snapshot.indicator_rows(spark, sf_dir), "recommendations": snapshot.recommendations(spark, sf_dir), "trades": snapshot.trades(spark, sf_dir),
        "backtest_runs": snapshot.runs(spark, sf_dir), "decision_signals": snapshot.decisions(spark, sf_dir),
        "alerts": alert_table(spark, sf_dir),
    }


def alert_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = alerts.latest_rows(market.prices(spark, sf_dir), snapshot.indicator_rows(spark, sf_dir)).join(market.stocks(spark, sf_dir).select("stock_id", "stock_code"), "stock_id")
    return alerts.alert_rows(alerts.evaluate(latest, alerts.seeded_rules(spark))).withColumn("is_resolved", F.lit(False))


#: Tables that a function's body reads.
READS = {"price_history": {"stocks": market.stocks, "prices": market.prices}, "active_alerts": {"stocks": market.stocks, "alerts": alert_table}}


def register_function(spark: SparkSession, sf_dir: str, name: str) -> None:
    """Name one function and the tables that it reads, in place of those of the same name; nothing else is derived."""
    for table, read in READS[name].items():
        read(spark, sf_dir).createOrReplaceTempView(table)
    _create(spark, name)


def _create(spark: SparkSession, name: str) -> None:
    _, parameters, columns, body = next(f for f in FUNCTIONS if f[0] == name)
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS TABLE ({columns}) RETURN {body}")


def view_frames(t: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The dashboard views by name, over the tables."""
    board = views.recommendation_board(t["recommendations"], t["stocks"])
    verdict, overview = views.latest_verdict(t["backtest_runs"], t["decision_signals"]), views.market_overview(t["prices"])
    latest = views.latest_prices(t["prices"], t["stocks"])
    with_sector = t["trades"].join(t["stocks"].select("stock_id", "sector_id"), "stock_id")
    return {
        "vw_market_overview": overview, "vw_price_panel": views.price_panel(t["prices"], t["indicators"], t["stocks"], t["sectors"]), "vw_recommendation_board": board, "vw_daily_board": views.daily_board(board),
        "vw_sector_performance": views.sector_performance(t["prices"], t["recommendations"], t["stocks"], t["sectors"]), "vw_model_health": views.model_health(t["backtest_runs"], t["decision_signals"]), "vw_backtest_equity_curve": views.backtest_equity(t["trades"], t["backtest_runs"]),
        "vw_data_quality_monitor": views.data_quality_monitor(t["staging"], t["prices"], t["indicators"]), "vw_latest_verdict": verdict, "vw_yearly_performance": views.with_run(backtest.rollup_years(t["trades"]), t["backtest_runs"]),
        "vw_stock_performance": views.with_run(backtest.trade_metrics(t["trades"], ["run_id", "stock_code"]), t["backtest_runs"]), "vw_sector_model_performance": views.with_run(backtest.trade_metrics(with_sector, ["run_id", "sector_id"]), t["backtest_runs"]),
        "vw_trade_distribution": views.trade_distribution(t["trades"], t["backtest_runs"]), "vw_command_center": views.command_center(verdict, overview, views.daily_board(board)), "vw_latest_prices": latest, "vw_investment_dashboard": views.investment_dashboard(latest, t["indicators"], t["alerts"]),
    }


def register(spark: SparkSession, sf_dir: str) -> list[str]:
    """Name the tables, views and functions over sf_dir in the session, in place of those of the same name; their names."""
    base = tables(spark, sf_dir)
    frames = {**base, **view_frames(base)}
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    for name, *_ in FUNCTIONS:
        _create(spark, name)
    return [*frames, *(f[0] for f in FUNCTIONS)]
