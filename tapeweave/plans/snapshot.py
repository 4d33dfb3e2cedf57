"""Snapshot rows (prices, indicators, features) and what the screener makes of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeweave.operators import advisory, backtest, features, indicators, quality
from tapeweave.operators.running import running_equity
from tapeweave.plans import market
from tapeweave.plans.facts import stored


def trusted_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return market.prices(spark, sf_dir).filter(quality.trusted())


def indicator_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["stock_id", "price_date", "ma_7", "ma_30", "ma_90", "bollinger_upper", "bollinger_middle", "bollinger_lower", "volatility_30", "ma_crossover_signal", "rsi_14", "macd", "macd_signal", "macd_histogram", "atr_14", "trend_strength"]
    return stored(spark, sf_dir, "indicators", lambda: indicators.with_indicators(trusted_prices(spark, sf_dir).select("stock_id", "price_date", "close_price")).select(*names))


def snapshot_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days from the 90th trusted one on, with stock codes, as a plan: readers compute and shuffle the columns that they use.

    An instrument's rows lie together after the features' windows, so the join with its indicators moves these alone; Spark is told, for
    the session and for good, that rows dealt by instrument need not be dealt anew by instrument and day.
    """
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    rows = features.price_features(trusted_prices(spark, sf_dir)).join(indicator_rows(spark, sf_dir), ["stock_id", "price_date"])
    return rows.join(market.stocks(spark, sf_dir).select("stock_id", "stock_code"), "stock_id")


def snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """snapshot_rows, stored with all its columns."""
    return stored(spark, sf_dir, "snapshot", lambda: snapshot_rows(spark, sf_dir))


#: What gates, boards, lists and trades read of a screened row.
GATED = ("stock_id", "stock_code", "price_date", "close_price", "score", "score_category", "signal", "agreement", "action", "risk_level", "target_price", "stop_price", "upside_pct", "downside_pct", "reward_risk", "rejection_reason")


def gated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows by themselves, before the portfolio: stored with the columns of GATED alone, in the order that the windows left them in."""
    return stored(spark, sf_dir, "gated", lambda: advisory.gated(snapshot_rows(spark, sf_dir)).select(*GATED), sort=())


def screened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The screener's rows; what the gate counts by day is read from a stored table, as its columns are deep expressions."""
    return advisory.portfolio_gate(gated(spark, sf_dir))


def recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The recommendation fact: one row for each instrument and day of the last 30 trading days."""
    names = ["stock_id", "stock_code", "recommendation_date", "profile", "score", "agreement", "signal", "action", "probability", "rejection_reason", "portfolio_approved", "portfolio_reason", "portfolio_rank", "target_price", "stop_price", "risk_level", "close_price"]
    rows = screened(spark, sf_dir)
    return rows.withColumns({"recommendation_date": F.col("price_date"), "profile": F.lit("balanced"), "probability": F.when(F.col("score") >= 50, F.col("score") / 100)}).select(*names)


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Backtest trades over all days, stored once; a run holds those entered in half a year."""
    def build() -> DataFrame:
        picked = backtest.without_overlap(backtest.candidate_trades(screened(spark, sf_dir)))
        run = (F.year("entry_date") - 1990) * 2 + (F.month("entry_date") > 6).cast("int")
        return picked.withColumns({"run_id": run.cast("long"), "trade_id": F.datediff("entry_date", F.lit("1992-01-01")) * 100_000 + F.col("stock_id")})

    return stored(spark, sf_dir, "trades", build, sort=("stock_id", "entry_date"))


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs of trades(), one row each, with what they came to as JSON metadata; dated by the last exit."""
    t = trades(spark, sf_dir)
    sums = backtest.trade_metrics(t, ["run_id"]).select("run_id", F.round("win_rate", 4).alias("win_rate"), F.round("profit_factor", 4).alias("profit_factor"), F.col("trades").alias("_count"))
    rows = running_equity(t, "run_id", ["trade_id"])
    falls = rows.groupBy("run_id").agg(F.round(F.max((F.col("peak") - F.col("equity")) / F.col("peak") * 100), 4).alias("max_drawdown_pct"), F.round((F.max_by("equity", "trade_id") - 1) * 100, 4).alias("return_pct"), F.max("exit_date").alias("run_date"))
    numbers = F.struct("win_rate", "return_pct", "profit_factor", "max_drawdown_pct", F.col("_count").alias("trades"))
    n = F.col("run_id")
    return sums.join(falls, "run_id").select(n, "run_date", F.lit("balanced").alias("profile"), F.when(n % 2 == 1, "full_validation").otherwise("weekly").alias("run_type"), n.alias("created_at"), F.to_json(F.struct(numbers.alias("portfolio"))).alias("run_metadata"))


def decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The colour of each run by itself."""
    number = lambda k: F.get_json_object("run_metadata", f"$.portfolio.{k}").try_cast("double")
    rows = runs(spark, sf_dir).withColumns({k: number(k) for k in ("win_rate", "return_pct", "profit_factor", "max_drawdown_pct")})
    return rows.select(F.col("run_date").alias("signal_date"), "profile", "run_type", backtest.colour().alias("signal"))


TRADES_SQL = """candidates AS MATERIALIZED (SELECT * FROM (SELECT stock_id, stock_code, price_date AS entry_date, close_price AS entry_price, lead(price_date, 10) OVER w AS exit_date, lead(close_price, 10) OVER w AS exit_price, score, agreement, rejection_reason, action FROM gated WINDOW w AS (PARTITION BY stock_id ORDER BY price_date))
  WHERE rejection_reason IS NULL AND action IN ('BUY', 'STRONG_BUY') QUALIFY row_number() OVER (PARTITION BY entry_date ORDER BY round(score, 9) * 1000 + round(agreement, 9) * 100 DESC, stock_id) <= 5),
closed AS MATERIALIZED (SELECT * FROM candidates WHERE exit_date IS NOT NULL),
followers AS MATERIALIZED (SELECT c.stock_id, c.entry_date, min(d.entry_date) AS following FROM closed c LEFT JOIN closed d ON d.stock_id = c.stock_id AND d.entry_date > c.exit_date GROUP BY 1, 2),
taken AS (SELECT stock_id, min(entry_date) AS entry_date FROM closed GROUP BY 1 UNION ALL SELECT f.stock_id, f.following FROM taken t JOIN followers f ON f.stock_id = t.stock_id AND f.entry_date = t.entry_date WHERE f.following IS NOT NULL),
trades AS MATERIALIZED (SELECT CAST((year(entry_date) - 1990) * 2 + (month(entry_date) > 6)::INT AS BIGINT) AS run_id, date_diff('day', DATE '1992-01-01', entry_date) * 100000 + stock_id AS trade_id, stock_id, stock_code, entry_date, exit_date, entry_price, exit_price, score, agreement,
  round((exit_price - entry_price) / entry_price * 100, 4) AS gross_return_pct, round((exit_price - entry_price) / entry_price * 100 - 0.2::DOUBLE, 4) AS net_return_pct FROM closed JOIN taken USING (stock_id, entry_date) WHERE abs(round((exit_price - entry_price) / entry_price * 100, 4)) <= 50)"""
_COLOUR_SQL = "CASE WHEN win_rate >= 45 AND return_pct > 0 AND profit_factor >= 1.2 AND max_drawdown_pct <= 25 THEN 'GREEN' WHEN win_rate >= 35 AND return_pct > -2 AND profit_factor >= 0.9 AND max_drawdown_pct <= 35 THEN 'YELLOW' ELSE 'RED' END"
RUNS_SQL = f"""curves AS (SELECT run_id, trade_id, exp(sum(ln(1 + net_return_pct / 100)) OVER (PARTITION BY run_id ORDER BY trade_id ROWS UNBOUNDED PRECEDING)) AS equity FROM trades),
falls AS (SELECT run_id, round(max((peak - equity) / peak * 100), 4) AS max_drawdown_pct, round((arg_max(equity, trade_id) - 1) * 100, 4) AS return_pct FROM (SELECT *, greatest(1, max(equity) OVER (PARTITION BY run_id ORDER BY trade_id ROWS UNBOUNDED PRECEDING)) AS peak FROM curves) GROUP BY 1),
runs AS (SELECT run_id, max(exit_date) AS run_date, 'balanced' AS profile, CASE WHEN run_id % 2 = 1 THEN 'full_validation' ELSE 'weekly' END AS run_type, run_id AS created_at, round(count(*) FILTER (net_return_pct > 0) / count(*) * 100, 4) AS win_rate, any_value(return_pct) AS return_pct,
  round(CASE WHEN -sum(net_return_pct) FILTER (net_return_pct <= 0) > 0 THEN coalesce(sum(net_return_pct) FILTER (net_return_pct > 0), 0) / -sum(net_return_pct) FILTER (net_return_pct <= 0) END, 4) AS profit_factor, any_value(max_drawdown_pct) AS max_drawdown_pct, count(*)::DOUBLE AS trade_count FROM trades JOIN falls USING (run_id) GROUP BY run_id),
decisions AS (SELECT run_date AS signal_date, profile, run_type, {_COLOUR_SQL} AS signal FROM runs)"""

TRUSTED_SQL = "bar_status IN ('RECONCILED', 'OFFICIAL') AND data_quality_flag IN ('GOOD', 'INCOMPLETE') AND (confidence_score IS NULL OR confidence_score >= 65)"


def _full(n: int, value: str, counted: str = "close_price") -> str:
    return f"CASE WHEN count({counted}) OVER w{n} >= {n} THEN {value} END"


INDICATORS_SQL = f"""base AS (SELECT * FROM prices WHERE {TRUSTED_SQL}),
returns AS (SELECT stock_id, price_date, close_price, row_number() OVER w AS i, CASE WHEN lag(close_price) OVER w > 0 THEN close_price / lag(close_price) OVER w - 1 END AS ret FROM base WINDOW w AS (PARTITION BY stock_id ORDER BY price_date)),
moving AS (SELECT *, {_full(7, 'avg(close_price) OVER w7')} AS ma_7, {_full(30, 'avg(close_price) OVER w30')} AS ma_30, {_full(90, 'avg(close_price) OVER w90')} AS ma_90,
  {_full(20, 'avg(close_price) OVER w20')} AS bollinger_middle, {_full(20, 'stddev_samp(close_price) OVER w20')} AS sd, {_full(30, 'stddev_samp(ret) OVER w30', 'ret')} * sqrt(252.0::DOUBLE) AS volatility_30
  FROM returns WINDOW w7 AS (PARTITION BY stock_id ORDER BY price_date ROWS 6 PRECEDING), w20 AS (PARTITION BY stock_id ORDER BY price_date ROWS 19 PRECEDING), w30 AS (PARTITION BY stock_id ORDER BY price_date ROWS 29 PRECEDING), w90 AS (PARTITION BY stock_id ORDER BY price_date ROWS 89 PRECEDING)),
crossed AS (SELECT *, bollinger_middle + 2 * sd AS bollinger_upper, bollinger_middle - 2 * sd AS bollinger_lower,
  CASE WHEN lag(ma_7) OVER w IS NULL OR lag(ma_30) OVER w IS NULL OR ma_7 IS NULL OR ma_30 IS NULL THEN NULL WHEN lag(ma_7) OVER w <= lag(ma_30) OVER w AND ma_7 > ma_30 THEN 'BULLISH' WHEN lag(ma_7) OVER w >= lag(ma_30) OVER w AND ma_7 < ma_30 THEN 'BEARISH' ELSE 'NEUTRAL' END AS ma_crossover_signal
  FROM moving WINDOW w AS (PARTITION BY stock_id ORDER BY price_date)),
ema AS (SELECT stock_id, i, close_price AS c, NULL::DOUBLE AS up, NULL::DOUBLE AS down, close_price AS fast, close_price AS slow, NULL::DOUBLE AS sig FROM returns WHERE i = 1
  UNION ALL
  SELECT n.stock_id, n.i, n.close_price, CASE WHEN e.up IS NULL THEN greatest(n.close_price - e.c, 0) ELSE greatest(n.close_price - e.c, 0) * (1.0::DOUBLE / 14) + e.up * (1 - 1.0::DOUBLE / 14) END,
    CASE WHEN e.down IS NULL THEN greatest(e.c - n.close_price, 0) ELSE greatest(e.c - n.close_price, 0) * (1.0::DOUBLE / 14) + e.down * (1 - 1.0::DOUBLE / 14) END,
    n.close_price * (2.0::DOUBLE / 13) + e.fast * (1 - 2.0::DOUBLE / 13), n.close_price * (2.0::DOUBLE / 27) + e.slow * (1 - 2.0::DOUBLE / 27),
    CASE WHEN n.i < 26 THEN NULL WHEN e.sig IS NULL THEN (n.close_price * (2.0::DOUBLE / 13) + e.fast * (1 - 2.0::DOUBLE / 13)) - (n.close_price * (2.0::DOUBLE / 27) + e.slow * (1 - 2.0::DOUBLE / 27))
      ELSE ((n.close_price * (2.0::DOUBLE / 13) + e.fast * (1 - 2.0::DOUBLE / 13)) - (n.close_price * (2.0::DOUBLE / 27) + e.slow * (1 - 2.0::DOUBLE / 27))) * 0.2::DOUBLE + e.sig * 0.8::DOUBLE END
  FROM ema e JOIN returns n ON n.stock_id = e.stock_id AND n.i = e.i + 1),
indicators_all AS (SELECT c.*, CASE WHEN c.i < 15 THEN NULL WHEN down = 0 AND up > 0 THEN 100 WHEN up = 0 AND down > 0 THEN 0 WHEN down > 0 THEN 100 - 100 / (1 + up / down) END AS rsi_14,
  CASE WHEN c.i >= 26 THEN fast - slow END AS macd, CASE WHEN c.i >= 34 THEN sig END AS macd_signal, CASE WHEN c.i >= 34 THEN fast - slow - sig END AS macd_histogram
  FROM crossed c JOIN ema e ON c.stock_id = e.stock_id AND c.i = e.i),
indicators AS (SELECT * FROM indicators_all WHERE i >= 90)"""

FEATURES_SQL = """moves AS (SELECT *, CASE WHEN lag(close_price) OVER w > 0 THEN (close_price - lag(close_price) OVER w) / lag(close_price) OVER w * 100 END AS change_1d,
  CASE WHEN lag(close_price, 10) OVER w > 0 THEN (close_price - lag(close_price, 10) OVER w) / lag(close_price, 10) OVER w * 100 END AS change_10d,
  CASE WHEN lag(close_price, 20) OVER w > 0 THEN (close_price - lag(close_price, 20) OVER w) / lag(close_price, 20) OVER w * 100 END AS change_20d,
  CASE WHEN avg(volume) OVER (PARTITION BY stock_id ORDER BY price_date ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) > 0 THEN volume / avg(volume) OVER (PARTITION BY stock_id ORDER BY price_date ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) END AS volume_ratio,
  max(close_price) OVER w20 AS high_20d, min(close_price) OVER w20 AS low_20d, avg(volume) OVER w5 AS avg_volume_5d, avg(volume) OVER w20 AS avg_volume_20d, row_number() OVER w AS trusted_history_days
  FROM base WINDOW w AS (PARTITION BY stock_id ORDER BY price_date), w5 AS (PARTITION BY stock_id ORDER BY price_date ROWS 4 PRECEDING), w20 AS (PARTITION BY stock_id ORDER BY price_date ROWS 19 PRECEDING)),
features AS (SELECT *, coalesce(stddev_pop(change_1d) OVER w10, 0) AS volatility_10d, coalesce(stddev_pop(change_1d) OVER w20, 0) AS volatility_20d, coalesce(stddev_pop(CASE WHEN change_1d < 0 THEN change_1d END) OVER w20, 0) AS downside_volatility_20d,
  CASE WHEN avg_volume_20d > 0 THEN avg_volume_5d / avg_volume_20d END AS volume_trend, greatest((high_20d - close_price) / high_20d * 100, 0) AS drawdown_20d, greatest((close_price - low_20d) / low_20d * 100, 0) AS rebound_20d
  FROM moves WINDOW w10 AS (PARTITION BY stock_id ORDER BY price_date ROWS 9 PRECEDING), w20 AS (PARTITION BY stock_id ORDER BY price_date ROWS 19 PRECEDING))"""

_RSI_PART = "CASE WHEN rsi_14 BETWEEN 40 AND 60 THEN 100 WHEN rsi_14 BETWEEN 30 AND 70 THEN 80 WHEN rsi_14 BETWEEN 20 AND 80 THEN 60 WHEN rsi_14 < 20 THEN 40 WHEN rsi_14 > 80 THEN 20 END"
_MACD_PART = "CASE WHEN macd > macd_signal AND macd > 0 THEN 100 WHEN macd > macd_signal THEN 80 WHEN macd < macd_signal AND macd < 0 THEN 20 WHEN macd < macd_signal THEN 40 WHEN macd IS NOT NULL AND macd_signal IS NOT NULL THEN 60 END"
_MOVES = {"change_1d": (2, 5, 10, 15, -2, -5), "change_10d": (5, 20, 30, 40, -5, -10), "change_20d": (8, 25, 35, 45, -5, -12)}
_MOVE_PARTS = [f"CASE WHEN {x} BETWEEN {a} AND {b} THEN 100 WHEN {x} > {b} AND {x} <= {c} THEN 80 WHEN {x} >= 0 AND {x} < {a} THEN 70 WHEN {x} > {c} AND {x} <= {d} THEN 60 WHEN {x} > {d} THEN 40 WHEN {x} >= {e} THEN 50 WHEN {x} >= {f} THEN 30 WHEN {x} IS NOT NULL THEN 20 END" for x, (a, b, c, d, e, f) in _MOVES.items()]
_OVER = "CASE WHEN ma_30 > 0 AND close_price > ma_30 THEN least(100, 70 + 3 * ((close_price - ma_30) / ma_30 * 100)) WHEN ma_30 > 0 THEN greatest(20, 50 + 2 * ((close_price - ma_30) / ma_30 * 100)) END"
_GAP = "CASE WHEN ma_90 > 0 AND ma_30 IS NOT NULL THEN CASE WHEN (ma_30 - ma_90) / ma_90 * 100 > 5 THEN 100 WHEN (ma_30 - ma_90) / ma_90 * 100 > 2 THEN 85 WHEN (ma_30 - ma_90) / ma_90 * 100 > 0 THEN 70 WHEN (ma_30 - ma_90) / ma_90 * 100 > -2 THEN 50 WHEN (ma_30 - ma_90) / ma_90 * 100 > -5 THEN 35 ELSE 20 END END"
_STAND = "CASE WHEN ma_30 IS NULL OR ma_90 IS NULL THEN NULL WHEN close_price > ma_30 AND ma_30 > ma_90 THEN 100 WHEN close_price > ma_30 OR close_price > ma_90 THEN 70 WHEN close_price < ma_30 AND ma_30 < ma_90 THEN 20 ELSE 40 END"
_mean = lambda *p: f"coalesce(list_avg(list_filter([{', '.join(f'({x})::DOUBLE' for x in p)}], lambda x: x IS NOT NULL)), 50)"
SCORE_SQL = f"""snap AS (SELECT f.*, s.stock_code, i.ma_7, i.ma_30, i.ma_90, i.volatility_30, i.rsi_14, i.macd, i.macd_signal FROM features f JOIN indicators i USING (stock_id, price_date) JOIN stocks s USING (stock_id)),
parts AS (SELECT *, {_mean(_RSI_PART, _MACD_PART)} AS technical_score, {_mean(*_MOVE_PARTS, _OVER)} AS momentum_score,
  (CASE WHEN volatility_30 IS NULL THEN 50 WHEN volatility_30 < 0.2 THEN 100 WHEN volatility_30 < 0.3 THEN 85 WHEN volatility_30 < 0.4 THEN 70 WHEN volatility_30 < 0.5 THEN 55 WHEN volatility_30 < 0.7 THEN 40 ELSE 20 END)::DOUBLE AS volatility_score,
  {_mean(_GAP, _STAND)} AS trend_score,
  (CASE WHEN volume_ratio IS NULL THEN 50 WHEN change_1d > 0 THEN CASE WHEN volume_ratio > 2 THEN 100 WHEN volume_ratio > 1.5 THEN 85 WHEN volume_ratio > 1 THEN 70 ELSE 50 END ELSE CASE WHEN volume_ratio > 2 THEN 30 WHEN volume_ratio > 1.5 THEN 40 WHEN volume_ratio > 1 THEN 55 ELSE 70 END END)::DOUBLE AS volume_score,
  (CASE WHEN trusted_history_days >= 90 THEN 1 WHEN trusted_history_days >= 60 THEN 0.85 WHEN trusted_history_days >= 30 THEN 0.65 ELSE 0.4 END)::DOUBLE * (CASE data_quality_flag WHEN 'GOOD' THEN 1 WHEN 'INCOMPLETE' THEN 0.9 ELSE 0.5 END)::DOUBLE * (CASE WHEN confidence_score IS NULL THEN 0.85 WHEN confidence_score >= 80 THEN 1 WHEN confidence_score >= 70 THEN 0.9 WHEN confidence_score >= 60 THEN 0.75 ELSE 0.5 END)::DOUBLE * (CASE WHEN bar_status IN ('RECONCILED', 'OFFICIAL') THEN 1 WHEN bar_status = 'OBSERVED' THEN 0.8 ELSE 0.6 END)::DOUBLE AS trust_multiplier FROM snap),
scored AS (SELECT *, (technical_score * 0.25::DOUBLE + momentum_score * 0.32::DOUBLE + volatility_score * 0.23::DOUBLE + trend_score * 0.15::DOUBLE + volume_score * 0.05::DOUBLE) * trust_multiplier AS score FROM parts)"""

_VOTES = {
    "rsi": "CASE WHEN rsi_14 <= 25 THEN {'s': 1, 'w': 1.5} WHEN rsi_14 <= 35 THEN {'s': 2, 'w': 1.0} WHEN rsi_14 >= 80 THEN {'s': 5, 'w': 1.5} WHEN rsi_14 >= 72 THEN {'s': 4, 'w': 1.0} WHEN rsi_14 IS NOT NULL THEN {'s': 3, 'w': 0.5} END",
    "macd": "CASE WHEN macd > macd_signal AND macd > 0 THEN {'s': 1, 'w': 1.2} WHEN macd > macd_signal THEN {'s': 2, 'w': 0.8} WHEN macd < macd_signal AND macd < 0 THEN {'s': 5, 'w': 1.2} WHEN macd < macd_signal THEN {'s': 4, 'w': 0.8} WHEN macd = macd_signal THEN {'s': 3, 'w': 0.3} END",
    "ma": "CASE WHEN ma_30 > ma_90 THEN {'s': 1, 'w': 1.3} WHEN ma_30 < ma_90 THEN {'s': 5, 'w': 1.3} WHEN (close_price - ma_30) / ma_30 * 100 > 5 THEN {'s': 2, 'w': 0.7} WHEN (close_price - ma_30) / ma_30 * 100 < -5 THEN {'s': 4, 'w': 0.7} ELSE {'s': 3, 'w': 0.5} END",
    "volume": "CASE WHEN volume_ratio > 2 THEN {'s': 2, 'w': 0.6} WHEN volume_ratio > 1.5 THEN {'s': 2, 'w': 0.4} WHEN volume_ratio < 0.5 THEN {'s': 3, 'w': 0.2} END",
}
_weight = lambda k: f"coalesce(list_sum(list_transform(list_filter(votes, lambda v: v.s = {k}), lambda v: v.w::DOUBLE)), 0)"
SIGNAL_SQL = f"""voted AS (SELECT *, list_filter([{', '.join(_VOTES.values())}], lambda v: v IS NOT NULL) AS votes FROM scored),
weighed AS (SELECT *, {', '.join(f'{_weight(k)} AS w{k}' for k in range(1, 6))} FROM voted),
shares AS (SELECT * EXCLUDE (w1, w2, w3, w4, w5), {', '.join(f'w{k} / (w1 + w2 + w3 + w4 + w5) AS w{k}' for k in range(1, 6))} FROM weighed),
topped AS (SELECT *, greatest(w1, w2, w3, w4, w5) AS top, w1 + w2 > 0.3 AND w4 + w5 > 0.3 AS mixed FROM shares),
signalled AS (SELECT *, CASE WHEN NOT mixed AND w3 > 0.5 THEN 'HOLD' WHEN w1 = top THEN 'STRONG_BUY' WHEN w2 = top THEN 'BUY' WHEN w3 = top THEN 'HOLD' WHEN w4 = top THEN 'SELL' ELSE 'STRONG_SELL' END AS signal,
  least(greatest(CASE WHEN mixed THEN top * 0.6::DOUBLE WHEN w3 > 0.5 THEN w3 ELSE top END, 0.1::DOUBLE), 0.95::DOUBLE) AS agreement FROM topped),
policy AS (SELECT *, CASE signal WHEN 'SELL' THEN 'AVOID' WHEN 'STRONG_SELL' THEN 'STRONGLY_AVOID' ELSE signal END AS action,
  CASE signal WHEN 'STRONG_BUY' THEN close_price * 1.25::DOUBLE WHEN 'BUY' THEN close_price * 1.2::DOUBLE END AS target_price, CASE signal WHEN 'STRONG_BUY' THEN close_price * 0.92::DOUBLE WHEN 'BUY' THEN close_price * 0.94::DOUBLE END AS stop_price,
  CASE WHEN volatility_30 > 0.5 THEN 'HIGH' WHEN f >= 3 THEN 'HIGH' WHEN f >= 1 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level
  FROM (SELECT *, coalesce((volatility_30 < 0.2)::INT, 0) + (agreement < 0.6)::INT + (score < 50)::INT + coalesce((rsi_14 <> 0 AND (rsi_14 < 25 OR rsi_14 > 75))::INT, 0) AS f FROM signalled)),
gated AS (SELECT *, CASE WHEN close_price < 8 THEN 'min_price' WHEN volatility_30 > 0.75 THEN 'max_volatility' WHEN volume_ratio < 0.8 THEN 'min_volume_ratio' WHEN trusted_history_days < 30 THEN 'min_history' WHEN confidence_score < 60 THEN 'min_confidence' WHEN NOT has_complete_data THEN 'incomplete_data'
  WHEN bar_status NOT IN ('RECONCILED', 'OFFICIAL') THEN 'unofficial_bar' WHEN drawdown_20d < 1 THEN 'near_high' WHEN change_20d > 12 THEN 'overextended' WHEN rsi_14 < 40 OR rsi_14 > 75 THEN 'rsi_out_of_range' WHEN action NOT IN ('BUY', 'STRONG_BUY') THEN 'not_a_buy' WHEN score < 70 THEN 'min_score' WHEN agreement < 0.6 THEN 'min_agreement' END AS rejection_reason FROM policy),
able AS MATERIALIZED (SELECT stock_id, price_date, row_number() OVER (PARTITION BY price_date ORDER BY round(score, 9) * 1000 + round(agreement, 9) * 100 DESC, stock_code) AS nth FROM gated WHERE rejection_reason IS NULL AND action IN ('BUY', 'STRONG_BUY')),
days AS MATERIALIZED (SELECT price_date AS d, count(*) AS n, row_number() OVER (ORDER BY price_date) AS i FROM able GROUP BY 1),
book AS (SELECT i, d, 0::BIGINT AS opened, least(1, n)::BIGINT AS k, [{{'d': d, 'k': least(1, n)::BIGINT}}] AS hist FROM days WHERE i = 1
  UNION ALL
  SELECT i, d, opened, least(1, greatest(3 - opened, 0), n)::BIGINT, list_append(list_filter(hist, lambda h: h.d >= d - 21), {{'d': d, 'k': least(1, greatest(3 - opened, 0), n)::BIGINT}})
  FROM (SELECT x.i, x.d, x.n, b.hist, coalesce(list_sum(list_transform(list_filter(b.hist, lambda h: h.d >= x.d - 21), lambda h: h.k)), 0)::BIGINT AS opened FROM book b JOIN days x ON x.i = b.i + 1)),
screened AS (SELECT g.*, a.nth AS rank, coalesce(a.nth <= least(1, greatest(3 - k.opened, 0)), FALSE) AS portfolio_approved,
  CASE WHEN a.nth IS NULL THEN 'non_actionable' WHEN a.nth <= least(1, greatest(3 - k.opened, 0)) THEN NULL WHEN k.opened < 3 THEN 'daily_entry_limit' ELSE 'max_concurrent_positions' END AS portfolio_reason,
  CASE WHEN a.nth <= least(1, greatest(3 - k.opened, 0)) THEN a.nth END AS portfolio_rank
  FROM gated g LEFT JOIN able a ON a.stock_id = g.stock_id AND a.price_date = g.price_date LEFT JOIN book k ON k.d = g.price_date)"""
SCREEN_HEAD = f"WITH RECURSIVE {market.PRICES_SQL}, {market.STOCKS_SQL}, {INDICATORS_SQL}, {FEATURES_SQL}, {SCORE_SQL}, {SIGNAL_SQL}"
INDICATOR_HEAD = f"WITH RECURSIVE {market.PRICES_SQL}, {market.STOCKS_SQL}, {INDICATORS_SQL}"
