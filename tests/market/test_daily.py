"""Indicators that continue from a state, against one pass over all bars; rules as data; SQL functions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tapeweave.operators import alerts, indicators
from tapeweave.plans import market, snapshot, sql

SF = "/root/testdata/sf0.001"
NAMES = ["ma_7", "ma_30", "ma_90", "bollinger_upper", "bollinger_middle", "bollinger_lower", "volatility_30", "ma_crossover_signal", "rsi_14", "macd", "macd_signal", "macd_histogram"]


def test_batch_by_batch_equals_one_pass(spark):
    bars = snapshot.trusted_prices(spark, SF).select("stock_id", "price_date", "close_price")
    bars = bars.withColumn("close_price", F.when(F.dayofyear("price_date") % 50 != 0, F.col("close_price")))  # some without a close
    whole = {(r["stock_id"], r["price_date"]): tuple(r[n] for n in NAMES) for r in indicators.with_indicators(bars).collect()}
    state, got = spark.createDataFrame([], indicators.STATE), {}
    cuts = ["1900-01-01", "1995-03-01", "1995-03-02", "1998-01-01", "2001-10-01", "2001-10-02", "2001-10-03", "2999-01-01"]
    for start, end in zip(cuts, cuts[1:]):
        part = bars.filter((F.col("price_date") >= start) & (F.col("price_date") < end))
        if start == "1998-01-01":
            part = part.filter("stock_id <> 3")  # an instrument without bars in a batch
            whole = {k: v for k, v in whole.items() if k[0] != 3}
        out, state = indicators.continue_indicators(part, state)
        got |= {(r["stock_id"], r["price_date"]): tuple(r[n] for n in NAMES) for r in out.collect() if r["stock_id"] != 3}
        assert state.agg(F.max(F.size("tail"))).first()[0] <= indicators.TAIL
    filled = {k: v for k, v in got.items() if k in whole}
    assert filled == whole and all(v == (None,) * len(NAMES) for k, v in got.items() if k not in whole)


def test_year_to_date_from_the_state(spark):
    day = dt.date(2000, 12, 28)
    bars = [(1, day + dt.timedelta(days=d), 100.0 + d) for d in range(10)] + [(2, dt.date(2001, 1, 3), 50.0)]
    df = spark.createDataFrame(bars, "stock_id long, price_date date, close_price double")
    state, got = spark.createDataFrame([], indicators.STATE), {}
    for d in range(10):
        out, state = indicators.continue_indicators(df.filter(F.col("price_date") == day + dt.timedelta(days=d)), state)
        got |= {(r["stock_id"], r["price_date"]): (r["change_1d"], r["change_ytd"]) for r in out.collect()}
    assert got[1, dt.date(2000, 12, 31)] == pytest.approx((100 / 102, 3.0)) and got[1, dt.date(2001, 1, 1)] == pytest.approx((100 / 103, 0.0))
    assert got[1, dt.date(2001, 1, 6)] == pytest.approx((100 / 108, (109 - 104) / 104 * 100)) and got[2, dt.date(2001, 1, 3)] == (None, None) and len(got) == 11


def test_parameters_of_rules(spark):
    rows = [
        (1, "x", "VOLATILITY", 0.5, '{"threshold": 0.1}', '{"threshold": 9}'), (2, "x", "VOLATILITY", 0.5, None, '{"threshold": 0.2}'), (3, "x", "VOLATILITY", 0.5, "no json", "a > b"), (4, "RSI overbought", "RSI", 60.0, "", None),
        (5, "RSI oversold", "RSI", 25.0, "[1]", '{"oversold": 10}'), (6, "v", "VOLUME_SPIKE", None, '{"multiplier": "3.5"}', None), (7, "v", "VOLUME_SPIKE", 2.5, None, None), (8, "RSI oversold", "RSI", 25.0, "{}", None),
    ]
    rules = spark.createDataFrame(rows, "rule_id int, rule_name string, rule_type string, threshold_value double, parameters string, condition_sql string")
    got = {r["rule_id"]: tuple(r["p"]) for r in alerts.rule_parameters(rules).collect()}
    none = None
    assert got == {1: (0.1, none, none, none), 2: (0.2, none, none, none), 3: (0.5, none, none, none), 4: (60.0, none, 60.0, none), 5: (25.0, 10.0, none, none), 6: (none, none, none, 3.5), 7: (2.5, none, none, none), 8: (none, none, none, none)}


def test_messages_and_rows_of_alerts(spark):
    row = (7, "GTCO", dt.date(2001, 1, 5), -6.125, 50.0, 1_234_567, True, 85.0, 400_000.0, 101.5, 99.0, 25.5, 1.25, 1.0, 0.25, 0.31, "BULLISH")
    latest = spark.createDataFrame([row], "stock_id long, stock_code string, price_date date, change_1d_pct double, close_price double, volume long, has_complete_data boolean, confidence_score double, mean_other_volume double, ma_7 double, ma_30 double, rsi_14 double, macd double, macd_signal double, macd_histogram double, volatility_30 double, ma_crossover_signal string")
    hits = alerts.evaluate(latest, alerts.seeded_rules(spark))
    assert {r["rule_id"]: r["message"] for r in hits.collect()} == {
        1: "GTCO decreased by 6.13% (threshold: 5.0%)", 2: "GTCO: Bullish crossover detected (Golden Cross)", 4: "GTCO: RSI oversold at 25.50 (threshold: 30.0)",
        6: "GTCO: MACD bullish signal detected (MACD=1.2500, Signal=1.0000, Hist=0.2500)", 8: "GTCO: High volatility detected at 31.00% (threshold: 30.00%)", 9: "GTCO: Volume spike detected - 1,234,567 (3.1x average)",
    }
    full = {r["rule_id"]: r["message"] for r in alerts.alert_rows(hits).collect()}
    assert full[4] == "GTCO: RSI oversold at 25.50 (threshold: 30.0) | rsi=25.5, threshold=30.0, condition=OVERSOLD" and full[2].endswith("| signal=BULLISH, ma_short=101.5, ma_long=99.0")


def test_market_in_sql(spark):
    names = sql.register(spark, SF)
    assert {"vw_market_overview", "vw_investment_dashboard", "price_history", "active_alerts"} <= set(names)
    for name in names[: -len(sql.FUNCTIONS)]:
        assert len(spark.sql(f"SELECT * FROM {name}").columns) > 0
    code = market.stocks(spark, SF).orderBy("stock_id").first()["stock_code"]
    got = spark.sql(f"SELECT * FROM price_history('{code}', DATE '1996-01-01', DATE '1996-12-31')")
    expected = market.prices(spark, SF).join(market.stocks(spark, SF).filter(F.col("stock_code") == code), "stock_id").filter("year(price_date) = 1996")
    assert got.count() == expected.count() > 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "1996-01-01" in plan and "PushedFilters: [IsNotNull(price_date)" in plan or "GreaterThanOrEqual(price_date" in plan
    assert spark.sql("SELECT count(DISTINCT s.stock_code) FROM stocks s, LATERAL price_history(s.stock_code, DATE '1996-01-01', DATE '1996-12-31') h").first()[0] == market.stocks(spark, SF).count()
