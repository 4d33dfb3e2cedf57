"""Trust predicates, validation flags and completeness of price rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tapeweave.functions.scalars import is_unknown_sector
from tapeweave.schemas import EXCHANGES


def trusted(min_confidence: float | None = 65.0, *, complete: bool = False, volume: bool = False) -> Column:
    """Official or reconciled bars of good or incomplete quality; a null confidence passes."""
    c = F.col("bar_status").isin("RECONCILED", "OFFICIAL") & F.col("data_quality_flag").isin("GOOD", "INCOMPLETE")
    if min_confidence is not None:
        c &= F.col("confidence_score").isNull() | (F.col("confidence_score") >= min_confidence)
    if complete:
        c &= F.col("has_complete_data")
    if volume:
        c &= F.col("volume").isNotNull()
    return c


def modelable(min_confidence: float | None = 65.0, *, complete: bool = True) -> Column:
    """As trusted, for the dataset: a null confidence fails where a minimum is set."""
    c = trusted(None, complete=complete) & (F.col("close_price") > 0)
    return c if min_confidence is None else c & F.coalesce(F.col("confidence_score") >= min_confidence, F.lit(False))


def significant_move() -> Column:
    return F.coalesce(F.abs("change_1d_pct") >= 4.0, F.lit(False))


def suspicious() -> Column:
    return F.col("data_quality_flag").isin("SUSPICIOUS", "MISSING", "STALE")


def validate(quotes: DataFrame, *, low: float = 0.01, high: float = 1e6, most_change: float = 50.0) -> tuple[DataFrame, DataFrame]:
    """(valid rows with data_quality_flag, one row for each warning or error with its rule).

    Rows without code, close or date, or of another exchange, are errors and not in the first; prices
    out of range, bars that contradict themselves and jumps are SUSPICIOUS; sectors that are unknown
    and repeated (code, date) are warnings only.
    """
    names = set(quotes.columns)
    null = F.lit(False)
    for c in ("stock_code", "close_price", "price_date"):
        null |= F.col(c).isNull()
    exchange = ~F.coalesce(F.col("exchange").isin(*EXCHANGES), F.lit(False)) if "exchange" in names else F.lit(False)
    jump = F.coalesce(F.abs("change_1d_pct") > most_change, F.lit(False)) if "change_1d_pct" in names else F.lit(False)
    contradiction = F.coalesce((F.col("high_price") < F.col("low_price")) | (F.col("close_price") > F.col("high_price")) | (F.col("close_price") < F.col("low_price")), F.lit(False)) if {"high_price", "low_price"} <= names else F.lit(False)
    copies = F.count("*").over(Window.partitionBy("stock_code", "price_date")) > 1
    marks = {"missing_value": null, "unknown_exchange": exchange, "price_out_of_range": ~F.coalesce(F.col("close_price").between(low, high), F.lit(True)), "contradiction": contradiction, "jump": jump, "unknown_sector": is_unknown_sector(F.col("sector_name")) if "sector_name" in names else F.lit(False), "duplicate": copies}
    marked = quotes.withColumn("_rules", F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in marks.items()]), lambda x: x.isNotNull()))
    errors = F.arrays_overlap("_rules", F.array(F.lit("missing_value"), F.lit("unknown_exchange")))
    doubtful = F.arrays_overlap("_rules", F.array(F.lit("price_out_of_range"), F.lit("contradiction"), F.lit("jump")))
    valid = marked.filter(~errors).withColumn("data_quality_flag", F.when(doubtful, "SUSPICIOUS").otherwise("GOOD")).drop("_rules")
    return valid, marked.select(*[c for c in ("stock_code", "price_date") if c in names], F.explode("_rules").alias("rule"))
