"""The landed-quotes data source: what it opens, how it cuts files, and what it makes of odd lines."""

import datetime as dt
import pathlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, In, LessThanOrEqual, StringContains

from tapeweave.sources import landed

DAY = dt.date(2001, 1, 1)


@pytest.fixture(scope="module")
def source(spark):
    spark.dataSource.register(landed.LandedQuotes)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    yield lambda path, **options: spark.read.format("landed_quotes").options(path=str(path), **options).load()
    spark.conf.unset("spark.sql.python.filterPushdown.enabled")


@pytest.fixture(scope="module")
def quotes(spark):
    rows = [(f"C{i}", DAY + dt.timedelta(days=d), i + d / 4, 10 * i + d, "A") for d in range(40) for i in range(30)]
    return spark.createDataFrame(rows, "stock_code string, price_date date, close_price double, volume long, source string")


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_whatever_the_ranges(source, quotes, tmp_path):
    path = tmp_path / "q"
    landed.land(quotes, str(path))
    for size in (7, 100, 5000, 1 << 24):
        assert rows(source(path, range_bytes=size)) == rows(quotes)
    assert source(path, range_bytes=100).rdd.getNumPartitions() > 50


def test_only_asked_days_are_opened(source, quotes, tmp_path):
    path = tmp_path / "q"
    landed.land(quotes, str(path))
    asked = source(path).filter((F.col("price_date") > DAY + dt.timedelta(days=9)) & (F.col("price_date") <= DAY + dt.timedelta(days=12)) & (F.col("close_price") > 5))
    expected = rows(quotes.filter((F.datediff("price_date", F.lit(DAY)).between(10, 12)) & (F.col("close_price") > 5)))
    for folder in pathlib.Path(path).glob("price_date=*"):  # other days cannot be read any more
        if not DAY + dt.timedelta(days=9) < dt.date.fromisoformat(folder.name.removeprefix("price_date=")) <= DAY + dt.timedelta(days=12):
            for file in folder.glob("*.csv"):
                file.write_bytes(b"a,b\n1,2,3,4,5,6\n")
    assert rows(asked) == expected and expected
    with pytest.raises(Exception, match="(?i)csv|column"):
        source(path).count()


def test_filters_that_it_takes_and_leaves():
    reader = landed.LandedReader("nowhere", 1)
    day = ("price_date",)
    left = [EqualTo(("stock_code",), "A"), StringContains(("source",), "x")]
    assert list(reader.pushFilters([GreaterThan(day, DAY), LessThanOrEqual(day, DAY + dt.timedelta(days=3)), In(day, (DAY, DAY + dt.timedelta(days=2), DAY + dt.timedelta(days=9))), *left])) == left
    assert [d for d in range(-1, 11) if reader._wanted(DAY + dt.timedelta(days=d))] == [2]


def test_odd_lines(source, tmp_path):
    folder = tmp_path / "q" / "price_date=2001-01-02"
    folder.mkdir(parents=True)
    (folder / "a.csv").write_text('stock_code,close_price,volume,source\n gtco ,52.1,"1000",A\nZEN,,x,\nBIG,1e3,99999999999999999999,B')
    (folder / "empty.csv").write_text("")
    (folder / "head.csv").write_text("stock_code,close_price,volume,source\n")
    (folder / "_SUCCESS").write_text("x")
    day = dt.date(2001, 1, 2)
    assert sorted(source(tmp_path / "q").collect(), key=str) == sorted([("GTCO", day, 52.1, 1000, "A"), ("ZEN", day, None, None, None), ("BIG", day, 1000.0, None, "B")], key=str)
    assert source(tmp_path / "q").filter(F.col("price_date") == DAY).count() == 0
