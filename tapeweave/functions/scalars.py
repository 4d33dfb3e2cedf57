"""Scalar expressions shared by operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names that say that a sector is not known.
UNKNOWN_SECTORS = ("", "unknown", "unclassified", "n/a", "na", "none", "null", "nan")


def standard_code(c: Column) -> Column:
    """Code in upper case without anything but A-Z, 0-9 and dots; null stays null."""
    return F.regexp_replace(F.upper(F.trim(c)), "[^A-Z0-9.]", "")


def title_case(c: Column) -> Column:
    """Blanks collapsed, and each run of letters with a capital first (also after digits and marks)."""
    clean = F.regexp_replace(F.trim(c), "\\s+", " ")
    runs = F.regexp_extract_all(clean, F.lit("([\\p{L}]+|[^\\p{L}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, lambda x: F.concat(F.upper(F.substring(x, 1, 1)), F.lower(F.substring(x, 2, 1 << 30)))), "")


def is_unknown_sector(c: Column) -> Column:
    return F.coalesce(F.lower(F.trim(c)).isin(*UNKNOWN_SECTORS), F.lit(True))


def best_sector(*candidates: Column) -> Column:
    """The first candidate that names a sector, in order of precedence."""
    return F.coalesce(*[F.when(~is_unknown_sector(c), F.trim(c)) for c in candidates], F.lit("Unknown"))


def pct(new: Column, old: Column) -> Column:
    """Change in percent; null where the old value is null or not positive."""
    return F.when(old > 0, (new - old) / old * 100)


def pct_distance(value: Column, base: Column) -> Column:
    """Distance from base in percent; 0 where either is null or base is 0."""
    return F.coalesce(F.when(base != 0, (value - base) / base * 100), F.lit(0.0))


def drawdown(value: Column, high: Column) -> Column:
    return F.greatest(-pct_distance(value, high), F.lit(0.0))


def rebound(value: Column, low: Column) -> Column:
    return F.greatest(pct_distance(value, low), F.lit(0.0))


def percent_text(c: Column) -> Column:
    """Number of a text such as '+1.5%'; '-' and what does not parse are null."""
    return F.regexp_replace(c, "[%+\\s]", "").try_cast("double")


def confidence_of(flag: Column) -> Column:
    # Confidence by quality flag, in the model's order.
    return F.when(flag == "GOOD", 85).when(flag == "INCOMPLETE", 70).when(flag == "SUSPICIOUS", 45).when(flag == "STALE", 30).when(flag == "POOR", 30).when(flag == "MISSING", 20).otherwise(50)


def freshness(age_days: Column) -> Column:
    return F.greatest(F.lit(0), 100 - F.least(age_days, F.lit(30)) * 3)


def strength(trend: Column) -> Column:
    """Signal by trend strength; null: HOLD."""
    return F.when(trend >= 80, "STRONG_BUY").when(trend >= 60, "BUY").when(trend.isNull() | (trend >= 40), "HOLD").when(trend >= 20, "SELL").otherwise("STRONG_SELL")


def mean_of(*parts: Column, default: float) -> Column:
    """Mean of the parts that are not null; default where all are."""
    n = sum((p.isNotNull().cast("int") for p in parts[1:]), parts[0].isNotNull().cast("int"))
    total = sum((F.coalesce(p, F.lit(0.0)) for p in parts[1:]), F.coalesce(parts[0], F.lit(0.0)))
    return F.when(n > 0, total / n).otherwise(F.lit(default))


def as_day(c: Column) -> Column:
    """The day of a date, a timestamp or a text in ISO form; null for what is none."""
    return F.to_date(F.try_to_timestamp(c.cast("string")))


def filled(df, sector: str = "sector_name"):
    """Doubles that are not numbers as null, and a sector for every row."""
    numbers = {c: F.when(~F.isnan(c), F.col(c)) for c, t in df.dtypes if t in ("double", "float")}
    out = df.withColumns(numbers) if numbers else df
    return out.withColumn(sector, F.coalesce(sector, F.lit("Unknown"))) if sector in df.columns else out


def exact_mean(c: Column, digits: int = 4) -> Column:
    """The mean of values with so many digits: summed and divided as decimals, in whatever order, to ten digits."""
    return F.round(F.sum(c.cast(f"decimal(18,{digits})")) / F.nullif(F.count(c), F.lit(0)).cast("decimal(19,0)"), 10).cast("double")
