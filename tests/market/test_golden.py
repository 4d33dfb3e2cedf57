"""Small inputs with results worked out by hand."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tapeweave.functions import scalars
from tapeweave.operators import advisory, alerts, asof, backtest, features, fits, indicators, modeling, quality, staging
from tapeweave.plans import views
from tapeweave.sources import readers

DAY = dt.date(2026, 1, 1)


def bars(spark, closes, volumes=None, stock=1):
    rows = [(stock, DAY + dt.timedelta(days=n), float(c), None if volumes is None or volumes[n] is None else int(volumes[n])) for n, c in enumerate(closes)]
    return spark.createDataFrame(rows, "stock_id long, price_date date, close_price double, volume long")


def last(df, *names):
    return tuple(df.orderBy(F.col("price_date").desc()).select(*names).first())


def test_volume_ratio_and_returns(spark):
    rows = features.price_features(bars(spark, [100.0] * 22, [100 + 10 * d for d in range(22)]))
    assert last(rows, "volume_ratio")[0] == pytest.approx(310 / 205)
    rows = features.price_features(bars(spark, [100, 110, 121], [1, 1, 1]))
    one, three = last(rows, "change_1d", "change_3d")
    assert one == pytest.approx(10.0) and three is None


def test_long_history(spark):
    rows = features.price_features(bars(spark, [100 + 2 * d for d in range(65)], [1000 + 50 * d for d in range(65)]))
    avg, draw, rebound = last(rows, "avg_volume_20d", "drawdown_20d", "rebound_20d")
    assert avg == pytest.approx(3725) and draw == 0 and rebound == pytest.approx((228 - 190) / 190 * 100)


def test_exponential_against_pandas(spark):
    rng = np.random.default_rng(0)
    close = 100 * np.exp(np.cumsum(rng.normal(0, 0.03, 150)))
    close[60:90] = close[60]
    got = indicators.exponential(bars(spark, close)).orderBy("price_date").toPandas()
    c = pd.Series(close)
    d = c.diff()
    up, down = (x.ewm(alpha=1 / 14, adjust=False, min_periods=14).mean() for x in (d.clip(lower=0), (-d).clip(lower=0)))
    macd = (c.ewm(span=12, adjust=False).mean() - c.ewm(span=26, adjust=False).mean()).where(np.arange(150) >= 25)
    signal = macd.dropna().ewm(span=9, adjust=False, min_periods=9).mean().reindex(range(150))
    np.testing.assert_allclose(got["rsi_14"].to_numpy(float)[14:], (100 - 100 / (1 + up / down)).to_numpy()[14:], rtol=1e-9)
    np.testing.assert_allclose(got["macd"].to_numpy(float), macd, rtol=1e-9, atol=1e-12)
    np.testing.assert_allclose(got["macd_signal"].to_numpy(float), signal, rtol=1e-9, atol=1e-12)
    assert got["rsi_14"].isna().sum() == 14


def test_flat_prices_have_no_rsi(spark):
    assert indicators.exponential(bars(spark, [5.0] * 30)).filter("rsi_14 is not null").count() == 0
    assert set(r[0] for r in indicators.exponential(bars(spark, range(1, 31))).filter("rsi_14 is not null").select("rsi_14").collect()) == {100.0}


def test_moving_needs_full_windows(spark):
    rows = indicators.with_moving(bars(spark, range(1, 41))).orderBy("price_date").collect()
    assert [r["ma_7"] for r in rows[:7]] == [None] * 6 + [4.0]
    assert rows[28]["ma_30"] is None and rows[29]["ma_30"] == 15.5
    assert rows[29]["volatility_30"] is None and rows[30]["volatility_30"] is not None


def test_label_is_by_rows(spark):
    rows = features.with_label(bars(spark, [100, 101, 102, 90]), horizon=2).orderBy("price_date").collect()
    assert rows[0]["forward_return"] == pytest.approx(2.0) and rows[0]["target"] == 1
    assert rows[1]["target"] == 0 and rows[2]["target"] is None


def test_trust_treats_null_confidence_differently(spark):
    df = spark.createDataFrame([("OFFICIAL", "GOOD", None, True, 5.0), ("OFFICIAL", "GOOD", 64.0, True, 5.0), ("OBSERVED", "GOOD", 90.0, True, 5.0)], "bar_status string, data_quality_flag string, confidence_score double, has_complete_data boolean, close_price double")
    assert df.filter(quality.trusted()).count() == 1 and df.filter(quality.modelable()).count() == 0


def test_validate(spark):
    q = spark.createDataFrame([("A", DAY, 5.0, "NGX", 1.0, "Banking"), ("A", DAY, 5.0, "NGX", 1.0, "Banking"), ("B", DAY, 2e6, "NGX", None, " n/a "), (None, DAY, 5.0, "NYSE", 60.0, None)], "stock_code string, price_date date, close_price double, exchange string, change_1d_pct double, sector_name string")
    valid, rules = quality.validate(q)
    assert sorted((r["stock_code"], r["data_quality_flag"]) for r in valid.collect()) == [("A", "GOOD"), ("A", "GOOD"), ("B", "SUSPICIOUS")]
    found = {r["rule"]: r["count"] for r in rules.groupBy("rule").count().collect()}
    assert found == {"duplicate": 2, "price_out_of_range": 1, "unknown_sector": 2, "missing_value": 1, "unknown_exchange": 1, "jump": 1}


def test_scalars(spark):
    df = spark.createDataFrame([("  gtco.l  ", "o'neil   gtb-plc mtn2go", "+1.5%"), (None, None, "-")], "a string, b string, c string")
    rows = df.select(scalars.standard_code(F.col("a")), scalars.title_case(F.col("b")), scalars.percent_text(F.col("c"))).collect()
    assert tuple(rows[0]) == ("GTCO.L", "O'Neil Gtb-Plc Mtn2Go", 1.5) and tuple(rows[1]) == (None, None, None)


def test_reconciliation_bands(spark):
    rows = [("X", "A", 100.0, 1), ("X", "N", 100.5, 2), ("Y", "A", 100.0, 3), ("Y", "N", 102.0, 4), ("Z", "N", 100.0, 5), ("Z", "A", 110.0, 6), ("S", "N", 7.0, 7)]
    df = spark.createDataFrame([(c, DAY, s, p, i) for c, s, p, i in rows], "stock_code string, price_date date, source string, p double, staging_id long").withColumn("close_price", F.col("p").cast("decimal(15,4)")).drop("p")
    audit = staging.reconcile(df)
    got = {r["stock_code"]: (r["method"], r["severity"], float(r["selected_price"]), r["selected_source"]) for r in audit.collect()}
    assert got == {"X": ("AVERAGE", "LOW", 100.25, "A"), "Y": ("PREFER_SOURCE", "MEDIUM", 100.0, "A"), "Z": ("PREFER_SOURCE", "HIGH", 110.0, "A"), "S": ("SINGLE_SOURCE", "LOW", 7.0, "N")}
    rows = {r["stock_code"]: float(r["close_price"]) for r in staging.canonical(df, audit).collect()}
    assert rows == {"X": 100.25, "Y": 100.0, "Z": 110.0, "S": 7.0}


def test_upsert_is_idempotent(spark):
    old = spark.createDataFrame([(1, "a", True), (2, "b", True)], "k long, v string, reconciled boolean")
    new = spark.createDataFrame([(2, "c", True), (3, "d", True)], "k long, v string, reconciled boolean")
    once = staging.upsert(old, new, ["k"], {"reconciled": F.lit(False)})
    twice = staging.upsert(once, new, ["k"], {"reconciled": F.lit(False)})
    expected = [(1, "a", True), (2, "c", False), (3, "d", False)]
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect())) == expected


def test_replace_partitions(spark, tmp_path):
    path = str(tmp_path / "recs")
    staging.replace_partitions(spark.createDataFrame([(1, "d1"), (2, "d2")], "x long, d string"), path, ["d"])
    staging.replace_partitions(spark.createDataFrame([(9, "d2")], "x long, d string"), path, ["d"])
    assert sorted((r["x"], r["d"]) for r in spark.read.parquet(path).collect()) == [(1, "d1"), (9, "d2")]


def test_as_of(spark):
    facts = spark.createDataFrame([(1, 10, "a"), (1, 20, None), (2, 5, "z")], "k long, t long, v string")
    asked = spark.createDataFrame([(1, 9), (1, 10), (1, 25), (2, 5), (3, 1)], "k long, t long")
    get = lambda strict: sorted(map(tuple, asof.asof(asked, facts, by="k", on="t", values=["v"], strict=strict).collect()), key=str)
    assert get(False) == sorted([(1, 9, None), (1, 10, "a"), (1, 25, None), (2, 5, "z"), (3, 1, None)], key=str)
    assert get(True) == sorted([(1, 9, None), (1, 10, None), (1, 25, None), (2, 5, None), (3, 1, None)], key=str)


def test_folds(spark):
    folds = asof.fold_windows("2025-12-11", "2026-02-08", train_days=30, eval_days=10, step_days=10, spark=spark).orderBy("fold").collect()
    assert [(str(f["train_end"]), str(f["eval_start"]), str(f["eval_end"])) for f in folds] == [("2026-01-09", "2026-01-10", "2026-01-19"), ("2026-01-19", "2026-01-20", "2026-01-29"), ("2026-01-29", "2026-01-30", "2026-02-08")]


def trades(spark, rows):
    return spark.createDataFrame([(1, c, DAY + dt.timedelta(days=a), DAY + dt.timedelta(days=b), r, s, 0.5) for c, a, b, r, s in rows], "run_id long, stock_code string, entry_date date, exit_date date, net_return_pct double, score double, confidence double")


def test_portfolio_simulation(spark):
    rows = trades(spark, [("AAA", 0, 5, 10.0, 90.0), ("BBB", 0, 5, -5.0, 80.0), ("CCC", 6, 9, 20.0, 70.0)])
    got = {r["stock_code"]: r for r in backtest.simulate_portfolios(rows, slots=2, size_pct=50.0, daily_limit=1).collect()}
    assert got["BBB"]["reason"] == "daily_entry_limit" and got["AAA"]["equity"] == pytest.approx(115_500)
    rows = trades(spark, [("AAA", 0, 2, -10.0, 90.0), ("BBB", 4, 6, 30.0, 80.0), ("CCC", 7, 9, 20.0, 70.0)])
    got = {r["stock_code"]: r for r in backtest.simulate_portfolios(rows, slots=1, size_pct=100.0, cooldown_days=3).collect()}
    assert (got["BBB"]["reason"], got["CCC"]["accepted"]) == ("cooldown", True)
    assert got["AAA"]["equity"] == pytest.approx(108_000) and got["AAA"]["max_drawdown_pct"] == pytest.approx(10.0)


def test_overlap_is_greedy(spark):
    rows = [(1, DAY + dt.timedelta(days=a), DAY + dt.timedelta(days=b), g, 1) for a, b, g in ((0, 5, 60.0), (3, 8, 1.0), (6, 9, 2.0))]
    df = spark.createDataFrame(rows, "stock_id long, entry_date date, exit_date date, gross_return_pct double, _row int")
    assert [r["gross_return_pct"] for r in backtest.without_overlap(df).collect()] == [2.0]


def test_trade_metrics_and_years(spark):
    rows = trades(spark, [("A", 0, 1, 10.0, 1.0), ("B", 1, 2, -4.0, 1.0), ("C", 800, 801, 0.0, 1.0)]).withColumn("gross_return_pct", F.col("net_return_pct"))
    r = backtest.trade_metrics(rows, ["run_id"]).first()
    assert (r["trades"], r["wins"], r["losses"], r["profit_factor"]) == (3, 1, 2, 2.5)
    assert [(y["year"], y["trades"]) for y in backtest.rollup_years(rows).orderBy("year").collect()] == [(2026, 2), (2027, 0), (2028, 1)]


def test_gate_closed_form(spark):
    rows = [("A", 90.0, "BUY"), ("B", 80.0, "HOLD"), ("C", 70.0, "STRONG_BUY"), ("D", 60.0, "BUY")]
    df = spark.createDataFrame([(DAY, c, s, 0.7, a, None) for c, s, a in rows], "price_date date, stock_code string, score double, agreement double, action string, rejection_reason string")
    got = {r["stock_code"]: (r["portfolio_approved"], r["portfolio_reason"], r["position_size"]) for r in advisory.portfolio_gate(df).collect()}
    assert got == {"A": (True, None, 0.2), "B": (False, "non_actionable", None), "C": (False, "daily_entry_limit", None), "D": (False, "daily_entry_limit", None)}
    full = advisory.portfolio_gate(df, daily_limit=2, capacity=3, open_positions=F.lit(2))
    assert {r["stock_code"]: r["portfolio_reason"] for r in full.collect()}["C"] == "max_concurrent_positions"


def test_buckets_and_scores(spark):
    df = spark.createDataFrame([(0.80, 1, 5.0), (0.65, 1, 9.0), (0.35, 0, -1.0), (0.20, 0, 2.0)], "probability double, target int, forward_return double").withColumn("stock_id", F.lit(1))
    assert [r["rows"] for r in modeling.buckets(df, (0.0, 0.4, 0.7, 1.0)).orderBy("bucket").collect()] == [2, 1, 1]
    assert modeling.scores(df).first()["accuracy"] == 1.0
    assert sum(r["forward_return"] for r in modeling.top_k(df, "probability", 2).collect()) / 2 == 7.0


def test_logistic_orders_cases(spark):
    """The four cases of the logistic fixture, and a threshold that stumps find."""
    def fit(kind, x, y):
        rows = spark.createDataFrame([(0, 0, float(b), a.tolist()) for a, b in zip(x, y)], "_day int, _known int, _y double, _x array<double>")
        one = fits.Folds(*(np.array([v]) for v in (0, 0, 0, 0)))
        how = {"steps": 60} if kind == "logistic" else {"rounds": 30}
        learn, predict = fits.FITS[kind]
        return predict(learn(fits.training_blocks(rows), one, x.shape[1], least_rows=4, least_class=2, **how)[0], x)

    p = fit("logistic", np.array([[0.0, 0], [1, 0], [3, 1], [4, 1]]), np.array([0.0, 0, 1, 1]))
    assert p[0] < p[1] < p[2] < p[3]
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 3))
    y = (x[:, 1] > 0.3).astype(float)
    p = fit("stumps", x, y)
    assert ((p > 0.5) == (y > 0)).mean() > 0.95


def test_alert_digest_and_dedupe(spark):
    hits = spark.createDataFrame([(1, 4, DAY, "RSI", "INFO", "m1"), (1, 5, DAY, "RSI", "INFO", "m2")], "stock_id long, rule_id long, alert_date date, rule_type string, severity string, message string")
    assert alerts.new_alerts(hits, hits.filter("rule_id = 4")).count() == 1
    assert alerts.digest(hits).first()["body"] == "m1\nm2"
    again = alerts.merge_alerts(hits.withColumn("is_resolved", F.lit(True)), hits.filter("rule_id = 4"))
    assert {r["rule_id"]: r["is_resolved"] for r in again.collect()} == {4: False, 5: True}


def test_empty_overview_has_a_row(spark):
    empty = spark.createDataFrame([], "price_date date, change_1d_pct double, volume long, data_quality_flag string, has_complete_data boolean")
    rows = views.market_overview(empty).collect()
    assert len(rows) <= 1


def test_readers(spark, tmp_path):
    p = tmp_path / "q.csv"
    p.write_text("Ticker,Name,Volume,Price,Change\n gtco ,G,\"1,000\",52.1,x\nGTCO,G2,1,1,1\n,None,1,1,1\nZEN,Z,5,,1\n")
    rows = readers.read_quotes(spark, str(p), "live").collect()
    assert [(r["stock_code"], r["volume"], r["close_price"], r["price_change_amount"]) for r in rows] == [("GTCO", 1000, 52.1, None)]
    p = tmp_path / "m.csv"
    p.write_text("stock_code,sector_name,sector_source,verified_on\nA,Banking,x,2026-01-01\na,Banking,x,2026-01-01\n")
    with pytest.raises(ValueError, match="duplicate"):
        readers.read_sector_map(spark, str(p))
    p.write_text("stock_code,sector_name\nA,Banking\n")
    with pytest.raises(ValueError, match="missing columns"):
        readers.read_sector_map(spark, str(p))
