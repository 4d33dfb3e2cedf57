"""Portfolio state, features, folds and trades against plain replays."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tapeweave.operators import advisory, backtest, features, indicators, modeling, staging
from tapeweave.plans import facts, snapshot, views
from tapeweave.sources import readers

SF = "/root/testdata/sf0.001"
DAY = dt.date(2001, 1, 1)


def recs(spark, rows):
    return spark.createDataFrame([(DAY + dt.timedelta(days=d), code, float(score), 0.7, action, reason) for d, code, score, action, reason in rows], "price_date date, stock_code string, score double, agreement double, action string, rejection_reason string")


def test_open_positions_reach_the_gate(spark):
    rows = [(d, code, score, "BUY", None) for d in (0, 1, 2, 3, 10, 21, 22, 60) for code, score in (("A", 80), ("B", 75))] + [(0, "R", 99, "BUY", "min_history"), (1, "H", 99, "HOLD", "not_a_buy")]
    got = {((r["price_date"] - DAY).days, r["stock_code"]): (r["rank"], r["portfolio_approved"], r["portfolio_reason"], r["portfolio_rank"]) for r in advisory.portfolio_gate(recs(spark, rows)).collect()}
    assert got[0, "R"] == got[1, "H"] == (None, False, "non_actionable", None)
    for d in (0, 1, 2, 22, 60):  # on day 22 that of day 0 has left the 21 days before
        assert got[d, "A"] == (1, True, None, 1) and got[d, "B"] == (2, False, "daily_entry_limit", None), d
    for d in (3, 10, 21):
        assert got[d, "A"] == (1, False, "max_concurrent_positions", None) and not got[d, "B"][1], d


def test_capacity_binds_over_the_table(spark):
    rows = snapshot.screened(spark, SF).select("price_date", "stock_code", "score", "agreement", "action", "rejection_reason", "rank", "portfolio_approved", "portfolio_reason").collect()
    able, book, reasons = {}, [], set()
    for r in rows:
        if r["rejection_reason"] is None and r["action"] in ("BUY", "STRONG_BUY"):
            able.setdefault(r["price_date"], []).append(r)
        else:
            assert r["rank"] is None and r["portfolio_reason"] == "non_actionable"
    for day in sorted(able):
        open_ = sum(k for d, k in book if day - dt.timedelta(days=21) <= d < day)
        taken = 0
        for n, r in enumerate(sorted(able[day], key=lambda r: (-(round(r["score"], 9) * 1000 + round(r["agreement"], 9) * 100), r["stock_code"])), 1):
            reason = "daily_entry_limit" if taken >= 1 else "max_concurrent_positions" if open_ + taken >= 3 else None
            taken += reason is None
            reasons.add(reason)
            assert (r["rank"], r["portfolio_approved"], r["portfolio_reason"]) == (n, reason is None, reason)
        book.append((day, taken))
    assert able and None in reasons


def test_feature_mapping(spark):
    row = dict(
        close_price=110.0, ma_7=105.0, ma_30=100.0, ma_90=80.0, rsi_14=60.0, macd=1.2, macd_signal=0.7, volatility_10d=0.09, volatility_20d=0.13, volatility_30=0.15, downside_volatility_20d=0.08, volume_ratio=1.4, avg_volume_20d=2_500_000.0,
        volume_trend=1.25, change_1d=3.5, change_3d=5.0, change_5d=6.5, change_10d=8.0, change_20d=12.0, change_30d=15.0, change_60d=20.0, confidence_score=85.0, trusted_history_days=45, trend_strength=70.0, high_20d=112.0, high_60d=120.0, low_20d=100.0,
        low_60d=88.0, drawdown_20d=2.0, drawdown_60d=5.0, rebound_20d=10.0, rebound_60d=25.0, data_quality_flag="GOOD", bar_status="RECONCILED", is_official=True, has_complete_data=False,
    )
    df = spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} {'string' if isinstance(v, str) else 'boolean' if isinstance(v, bool) else 'int' if isinstance(v, int) else 'double'}" for k, v in row.items()))
    got = features.risk_features(features.feature_vector(df)).first()
    expected = {
        "price_change_pct": 3.5, "price_change_60d": 20.0, "rsi_14_centered": 0.2, "macd_level": 1.2, "macd_signal_gap": 0.5, "volatility_30_level": 0.15, "downside_volatility_20d_level": 0.08, "volume_ratio_centered": 0.4, "avg_volume_20d_millions": 2.5, "volume_trend_ratio_centered": 0.25,
        "price_confidence_score_scaled": 0.85, "trusted_history_days_scaled": 0.45, "close_vs_ma_7_pct": 5 / 105 * 100, "close_vs_ma_30_pct": 10.0, "close_vs_ma_90_pct": 37.5, "ma_7_vs_ma_30_pct": 5.0, "ma_30_vs_ma_90_pct": 25.0, "close_vs_20d_high_pct": -2 / 112 * 100,
        "close_vs_60d_low_pct": 25.0, "drawdown_60d_pct": 5.0, "rebound_20d_pct": 10.0, "trend_strength_scaled": 0.7, "quality_good_flag": 1.0, "quality_incomplete_flag": 0.0, "bar_reconciled_flag": 1.0, "bar_official_flag": 0.0, "official_flag": 1.0, "complete_data_flag": 0.0,
        "near_20d_high_flag": 1.0, "extended_20d_runup_flag": 1.0, "high_rebound_20d_flag": 0.0, "signal_agreement_proxy": 1.0,
    }
    assert {k: got[k] for k in expected} == pytest.approx(expected)
    assert len(features.FEATURES) == 39 and len(features.RISK_FEATURES) == 45 and all(got[f] is not None for f in features.RISK_FEATURES)


def test_only_known_labels_train(spark):
    """Day 40 may learn from rows whose horizon ended by day 39, whatever other days may know."""
    rows = [(s, DAY + dt.timedelta(days=d), DAY + dt.timedelta(days=d + 10), d % 2, 1.0, float(d)) for d in range(60) for s in range(3)]
    data = spark.createDataFrame(rows, "stock_id long, price_date date, horizon_date date, target int, forward_return double, x double")
    modeling.FITTERS["count"] = (lambda x, y: (len(y), x.max()), lambda m, x: np.full(len(x), m[0] + m[1] / 1000))
    days = spark.createDataFrame([(DAY + dt.timedelta(days=d),) for d in (40, 55)], "price_date date")
    got = {(r["price_date"] - DAY).days: r["probability"] for r in modeling.rolling_probabilities(data, days, ("x",), window_days=35, kind="count", least_rows=1, least_class=1).collect()}
    assert got == {40: pytest.approx((29 - 5 + 1) * 3 + 0.029), 55: pytest.approx((44 - 20 + 1) * 3 + 0.044)}
    assert all(r["probability"] is None for r in modeling.rolling_probabilities(data, days, ("x",), kind="none", least_rows=1, least_class=1).collect())


def test_trades_against_a_replay(spark):
    rows = snapshot.screened(spark, SF).select("stock_id", "stock_code", "price_date", "close_price", "score", "agreement", "action", "rejection_reason").collect()
    bars, by_day = {}, {}
    for r in sorted(rows, key=lambda r: r["price_date"]):
        bars.setdefault(r["stock_id"], []).append((r["price_date"], r["close_price"]))
        if r["rejection_reason"] is None and r["action"] in ("BUY", "STRONG_BUY"):
            by_day.setdefault(r["price_date"], []).append(r)
    until, expected = {}, {}
    for day in sorted(by_day):
        best = sorted(by_day[day], key=lambda r: (-(round(r["score"], 9) * 1000 + round(r["agreement"], 9) * 100), r["stock_id"]))[:5]
        for r in best:
            own = bars[r["stock_id"]]
            at = own.index((day, r["close_price"]))
            if at + 10 >= len(own) or day <= until.get(r["stock_id"], dt.date.min):
                continue
            until[r["stock_id"]] = own[at + 10][0]
            gross = (own[at + 10][1] - r["close_price"]) / r["close_price"] * 100
            if abs(round(gross, 4)) <= 50:
                expected[r["stock_id"], day, own[at + 10][0]] = gross
    got = {(r["stock_id"], r["entry_date"], r["exit_date"]): r["gross_return_pct"] for r in snapshot.trades(spark, SF).collect()}
    assert got == pytest.approx(expected, abs=1e-4)


def test_bad_trades_are_blocked(spark):
    df = spark.createDataFrame([(1, 0.54), (2, 0.55), (3, None)], "id int, bad_probability double")
    assert [r["id"] for r in df.filter(backtest.not_bad()).orderBy("id").collect()] == [1, 3]


def test_sources_say_what_they_give(spark, tmp_path):
    (tmp_path / "h.csv").write_text("stock_code,price_date,close_price,volume\n ab ,2001-01-02,5,10\nAB,2001-01-02,6,11\nAB,2002-01-01,7,1\n")
    source = readers.Source("landed", readers.Capabilities(history=True))
    got = source.fetch(spark, f"file://{tmp_path}/h.csv", "2001-01-01", "2001-12-31").collect()
    assert [(r["stock_code"], r["close_price"], r["source"]) for r in got] == [("AB", 6.0, "landed")]
    with pytest.raises(ValueError):
        source.fetch(spark, "nowhere")
    (tmp_path / "v.csv").write_text("date,1. open,2. high,3. low,4. close,5. volume\n2001-01-02,1,2,0.5,1.5,100\n")
    assert readers.read_vendor_history(spark, f"file://{tmp_path}/v.csv").first()["close_price"] == 1.5


def test_staging_helpers(spark):
    rows = spark.createDataFrame([("A", DAY, False), ("B", DAY, False)], "stock_code string, price_date date, reconciled boolean")
    audit = rows.filter("stock_code = 'A'")
    assert {(r["stock_code"], r["reconciled"]) for r in staging.mark_reconciled(rows, audit).collect()} == {("A", True), ("B", False)}
    facts_ = spark.createDataFrame([(1, DAY, 10.0)], "stock_id long, price_date date, close_price double")
    batch = spark.createDataFrame([(1, DAY + dt.timedelta(days=1), 11.0), (1, DAY + dt.timedelta(days=2), 12.0)], "stock_id long, price_date date, close_price double")
    assert [r["previous_close"] for r in staging.running_changes(batch, facts_).orderBy("price_date").collect()] == [10.0, 11.0]
    assert staging.distinct_outcomes(facts_, facts_, batch).count() == 3
    again = spark.createDataFrame([(1, None, 5), (1, DAY, 3), (1, DAY, 4)], "k int, at date, id int")
    assert [r["id"] for r in staging.keep_newest(again, ["k"], ["at", "id"]).collect()] == [4]


def test_views_of_a_code(spark):
    stocks = spark.createDataFrame([(1, "AB"), (2, "CD")], "stock_id long, stock_code string")
    prices = spark.createDataFrame([(s, DAY + dt.timedelta(days=d), float(d)) for s in (1, 2) for d in range(30)], "stock_id long, price_date date, close_price double")
    assert [r["close_price"] for r in views.price_history(prices, stocks, "CD", "2001-01-03", "2001-01-04").collect()] == [2.0, 3.0]
    alerts = spark.createDataFrame([(1, 7, DAY), (2, 8, DAY)], "stock_id long, rule_id long, alert_date date")
    assert [r["rule_id"] for r in views.active_alerts(alerts, stocks, "AB").collect()] == [7]
    assert views.newest_prices(prices).groupBy("stock_id").agg(F.min("close_price").alias("low"), F.count("*").alias("n")).filter("low = 10 and n = 20").count() == 2


def test_facts_are_stored_once(spark):
    built = []

    def build():
        built.append(1)
        return spark.createDataFrame([(1, DAY, 2.0)], "stock_id long, price_date date, x double")

    for _ in range(2):
        assert facts.stored(spark, "nowhere", "fact", build).collect()[0]["x"] == 2.0
    assert len(built) == 1
    facts.refresh("nowhere")
    facts.stored(spark, "nowhere", "fact", build)
    assert len(built) == 2


def test_filter_of_a_days_list(spark):
    """A function sees each day's actionable rows, whole and alone, before the ranking."""
    rows = snapshot.screened(spark, SF)
    days = {r["entry_date"]: r["n"] for r in backtest.candidate_trades(rows).groupBy("entry_date").agg(F.count("*").alias("n")).collect()}
    assert max(days.values()) > 1
    best = backtest.candidate_trades(rows, keep=lambda day: day["score"] == day["score"].max())
    first = backtest.candidate_trades(rows, top_n=1)
    assert {r["entry_date"] for r in best.collect()} == set(days)
    assert best.select("entry_date", F.round("score", 9)).distinct().exceptAll(first.select("entry_date", F.round("score", 9)).distinct()).count() == 0
    assert backtest.candidate_trades(rows, keep=lambda day: day["score"] < 0).count() == 0


def test_reports_are_json_lines(spark, tmp_path):
    staging.write_report(snapshot.runs(spark, SF).select("run_id", "run_type"), str(tmp_path / "r"))
    assert spark.read.json(str(tmp_path / "r")).columns == ["run_id", "run_type"] and spark.read.json(str(tmp_path / "r")).count() == snapshot.runs(spark, SF).count()


def test_summary_of_a_dataset(spark):
    rows = [(1, DAY, 1, 2.0, None, "x"), (1, DAY, 0, None, None, "x"), (2, DAY, 1, 2.0, None, "x")]
    df = spark.createDataFrame(rows, "stock_id long, price_date date, target int, a double, b double, c string")
    got = modeling.dataset_summary(df, ("c", "b", "a")).first()
    assert (got["rows"], got["stocks"], got["duplicates"], got["missing"], got["all_null"], got["constants"]) == (3, 2, 1, "a=1,b=3", "b", "b,c")
    empty = modeling.dataset_summary(df.limit(0), ("a",)).first()
    assert (empty["rows"], empty["duplicates"], empty["missing"], empty["constants"]) == (0, 0, "", "")


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_indicators_are_dealt_once(spark):
    bars = spark.createDataFrame([(1, DAY, 2.0)], "stock_id long, price_date date, close_price double")
    assert exchanges(indicators.with_indicators(bars)) == 1


def test_stored_screen_is_narrow_and_rows_without_a_rank_stay(spark):
    assert tuple(snapshot.gated(spark, SF).columns) == snapshot.GATED
    # features, indicators and prices: an instrument's rows are not dealt anew by instrument and day
    assert "hashpartitioning(stock_id#" in (plan := snapshot.snapshot_rows(spark, SF)._jdf.queryExecution().executedPlan().toString())
    assert not any("price_date" in part.split(")")[0] for part in plan.split("Exchange hashpartitioning(")[1:])
    rows = snapshot.screened(spark, SF)
    assert rows.count() == snapshot.gated(spark, SF).count()
    assert rows.filter("rank is null").count() == snapshot.gated(spark, SF).filter("rejection_reason is not null or action not in ('BUY', 'STRONG_BUY')").count()


def test_alerts_in_sql_derive_no_trades(spark):
    from tapeweave import catalog

    facts.refresh(SF)
    assert catalog.QUERIES["v20_sql_active_alerts"](spark, SF).columns == ["stock_code", "rule_id", "alert_date"]
    assert {name for _, folder, name in facts._STORED if folder == SF} == {"prices", "indicators"}


def test_percentages_of_a_board_are_rounded_once(spark):
    """Values that tie to nine digits go by their code; percentages are of the values as they are, not of rounded ones."""
    stocks = spark.createDataFrame([(1, "AA", 3), (2, "BB", 3)], "stock_id long, company_name string, sector_id int")
    rows = [(1, "AA", 0.709449999950, 70.9449999950), (2, "BB", 0.709449999951, 70.9449999951)]
    recs = spark.createDataFrame([(i, code, DAY, "balanced", False, None, p, s, 0.46425) for i, code, p, s in rows], "stock_id long, stock_code string, recommendation_date date, profile string, portfolio_approved boolean, portfolio_rank int, probability double, score double, agreement double")
    board = views.recommendation_board(recs, stocks, digits=9).orderBy("board_rank").collect()
    assert [(r["stock_code"], r["probability_pct"]) for r in board] == [("AA", 70.94), ("BB", 70.94)]
