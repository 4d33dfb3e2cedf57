"""Scans over blocks against plain folds, where one key has all rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tapeweave.operators import asof, backtest, running
from tapeweave.plans import facts

DAY = dt.date(2000, 1, 1)


@pytest.fixture
def written(monkeypatch):
    """Tables that scans have written, so that tests can see how rows were dealt."""
    kept = []

    def cut(df, name):
        kept.append(facts.cut_lineage(df, name))
        return kept[-1]

    monkeypatch.setattr(running, "cut_lineage", cut)
    return kept


def trades_of(spark, rows):
    return spark.createDataFrame([(run, DAY + dt.timedelta(days=d), i, r) for i, (run, d, r) in enumerate(rows)], "run_id long, entry_date date, trade_id long, net_return_pct double")


@pytest.mark.parametrize("ruin", [None, -100.0, -150.0])
def test_one_run_over_all_tasks(spark, written, ruin):
    draw = random.Random(3)
    rows = [(1, draw.randint(0, 900), None if i % 97 == 0 else round(draw.uniform(-9, 10), 2)) for i in range(4000)] + [(r, d, 5.0) for r in range(2, 30) for d in (1, 2)]
    if ruin is not None:
        rows += [(1, 500, ruin), (1, 700, ruin), (7, 9, ruin)]
    df = trades_of(spark, rows)
    order = ["entry_date", "trade_id"]
    got = {(r["run_id"], r["trade_id"]): (r["equity"], r["peak"]) for r in running.running_equity(df, "run_id", order).collect()}
    assert written[0].filter("run_id = 1").select("_block").distinct().count() >= 6
    dealt = written[0].groupBy("_block").count().agg(F.max("count"), F.avg("count")).first()
    assert dealt[0] < 2.5 * dealt[1]
    worst = {}
    for run in {r for r, _, _ in rows}:
        equity, peak = 1.0, 1.0
        for _, i, r in sorted((d, i, r) for i, (own, d, r) in enumerate(rows) if own == run):
            equity *= 1 + (r or 0.0) / 100
            peak = max(peak, equity)
            worst[run] = max(worst.get(run, 0.0), (peak - equity) / peak * 100)
            assert got[run, i] == (pytest.approx(equity, rel=1e-9, abs=1e-12), pytest.approx(peak, rel=1e-9))
    assert len(got) == len(rows)
    assert {r["run_id"]: r["max_drawdown_pct"] for r in backtest.max_drawdown(df, "run_id", order).collect()} == pytest.approx(worst, abs=1e-7)


def test_years(spark):
    df = trades_of(spark, [(1, 0, 10.0), (1, 5, 10.0), (1, 800, -50.0), (2, 400, 100.0)])
    got = {(r["run_id"], r["year"]): (r["start_equity"], r["end_equity"]) for r in backtest.year_equity(df).collect()}
    assert got == {k: pytest.approx(v) for k, v in {(1, 2000): (1.0, 1.21), (1, 2001): (1.21, 1.21), (1, 2002): (1.21, 0.605), (2, 2001): (1.0, 2.0)}.items()}


def test_losses_of_all_count_for_nothing_in_the_curve(spark):
    got = [r["cumulative_return_pct"] for r in backtest.equity_curve(trades_of(spark, [(1, 0, 10.0), (1, 1, -100.0), (1, 2, 10.0)])).orderBy("trade_id").collect()]
    assert got == pytest.approx([10.0, 10.0, 21.0])


@pytest.mark.parametrize("strict", [False, True])
def test_as_of_where_one_instrument_has_all_rows(spark, written, strict):
    draw = random.Random(4)
    f = spark.createDataFrame([(7, d, None if d % 11 == 0 else float(d), str(d)) for d in sorted(draw.sample(range(100, 5000), 1200))] + [(9, 3, 1.0, "x")], "stock_id long, d int, close double, name string")
    q = spark.createDataFrame([(i, 7, draw.randint(0, 5200)) for i in range(3000)] + [(9000 + i, s, d) for i, (s, d) in enumerate([(9, 3), (9, 2), (9, 99), (5, 5), (None, 4), (7, None)])], "id long, stock_id long, d int")
    one = asof.asof(q, f, by="stock_id", on="d", values=["close", "name"], strict=strict)
    spread = running.last_before(q, f, by="stock_id", on="d", values=["close", "name"], strict=strict)
    assert spread.columns == one.columns
    assert sorted(map(repr, spread.collect())) == sorted(map(repr, one.collect()))
    assert written[0].filter("_by = 7").select("_block").distinct().count() >= 6


def test_no_rows(spark):
    empty = trades_of(spark, [(1, 0, 1.0)]).limit(0)
    assert running.running_equity(empty, "run_id", ["entry_date", "trade_id"]).count() == 0 and backtest.year_equity(empty).count() == 0
