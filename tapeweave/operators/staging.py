"""Staging, reconciliation of sources, canonical rows, and key-wise upserts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tapeweave.sources.readers import keep_one

DAY_KEY = ["stock_code", "price_date"]


def upsert(old: DataFrame, new: DataFrame, keys: list[str], resets: dict[str, Column] | None = None) -> DataFrame:
    """old with the rows of new in place of those of the same key; resets: columns set in rows of new.

    One shuffle on the keys: rows of both sides meet by union, the newer side wins.
    """
    both = old.withColumn("_side", F.lit(0)).unionByName(new.withColumns(resets or {}).withColumn("_side", F.lit(1)), allowMissingColumns=True)
    return keep_one(both, keys, [F.col("_side").desc()]).drop("_side")


def replace_partitions(df: DataFrame, path: str, by: list[str]) -> None:
    """Write df over its own partitions of the table at path; others stay."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def conflicts(staging: DataFrame) -> DataFrame:
    """(code, date) with several quotes: how many, and the least and greatest price."""
    return staging.groupBy(*DAY_KEY).agg(F.count("*").alias("quotes"), F.min("close_price").alias("low"), F.max("close_price").alias("high")).filter("quotes > 1")


def reconcile(staging: DataFrame, preferred: str = "A") -> DataFrame:
    """One audit row for each (code, date): method, severity, selected price and source, all sources and prices.

    The spread of prices decides, in decimals: under 1 % the average, under 3 % the preferred source,
    else the preferred source with high severity. The first row is the one of the smallest staging_id.
    """
    first = lambda c: F.min_by(c, "staging_id")
    rows = staging.groupBy(*DAY_KEY).agg(
        F.count("*").alias("quotes"), F.min("close_price").alias("low"), F.max("close_price").alias("high"), F.sum("close_price").alias("_sum"),
        F.min_by("close_price", F.when(F.col("source") == preferred, F.col("staging_id"))).alias("_preferred"), first("close_price").alias("_first"), first("source").alias("_first_source"),
        F.array_sort(F.collect_list(F.struct("staging_id", "source", "close_price"))).alias("_all"),
    )
    variance = F.when(F.col("quotes") == 1, F.lit(0).cast("decimal(20,6)")).when(F.col("low") == 0, F.lit(100).cast("decimal(20,6)")).otherwise(((F.col("high") - F.col("low")) / F.col("low") * 100).cast("decimal(20,6)"))
    rows = rows.withColumn("variance_pct", variance)
    single, average = F.col("quotes") == 1, F.col("variance_pct") < 1
    method = F.when(single, "SINGLE_SOURCE").when(average, "AVERAGE").otherwise("PREFER_SOURCE")
    severity = F.when(single | average, "LOW").when(F.col("variance_pct") < 3, "MEDIUM").otherwise("HIGH")
    chosen = F.when(single, F.col("_first")).when(average, (F.col("_sum") / F.col("quotes")).cast("decimal(15,4)")).otherwise(F.coalesce("_preferred", "_first"))
    source = F.when(single | average | F.col("_preferred").isNull(), F.col("_first_source")).otherwise(F.lit(preferred))
    return rows.select(*DAY_KEY, "quotes", "variance_pct", method.alias("method"), severity.alias("severity"), chosen.cast("decimal(15,4)").alias("selected_price"), source.alias("selected_source"), F.transform("_all", lambda x: x["source"]).alias("sources"), F.transform("_all", lambda x: x["close_price"]).alias("prices"))


def canonical(staging: DataFrame, audit: DataFrame, preferred: str = "A") -> DataFrame:
    """One row for each (code, date): the preferred source's, else the first, with the audit's price and source."""
    best = keep_one(staging, DAY_KEY, [F.when(F.col("source") == preferred, 0).otherwise(1), F.col("staging_id")])
    known = audit.select(*DAY_KEY, "selected_price", "selected_source")
    return best.join(known, DAY_KEY, "left").withColumns({"close_price": F.coalesce("selected_price", "close_price"), "source": F.coalesce("selected_source", "source")}).drop("selected_price", "selected_source")


def latest_audit(audits: DataFrame) -> DataFrame:
    return keep_one(audits, DAY_KEY, [F.col("created_at").desc(), F.col("audit_id").desc()])


def missing_facts(staged: DataFrame, facts: DataFrame, keys: list[str]) -> DataFrame:
    """Staged rows without a fact."""
    return staged.join(facts.select(*keys), keys, "left_anti")


def merge_batches(*batches: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of all batches, the last batch's for each key."""
    out = None
    for n, b in enumerate(batches):
        b = b.withColumn("_batch", F.lit(n))
        out = b if out is None else out.unionByName(b, allowMissingColumns=True)
    return keep_one(out, keys, [F.col("_batch").desc()]).drop("_batch")


def mark_reconciled(staging: DataFrame, audit: DataFrame) -> DataFrame:
    """Staging rows of audited days as reconciled."""
    done = audit.select(*DAY_KEY, F.lit(True).alias("_done"))
    return staging.join(done, DAY_KEY, "left").withColumn("reconciled", F.coalesce("_done", "reconciled", F.lit(False))).drop("_done")


def repair_flags(prices: DataFrame) -> DataFrame:
    """Flag, confidence and completeness from what the row holds."""
    price, change = F.col("close_price").isNotNull() & (F.col("close_price") > 0), F.col("change_1d_pct").isNotNull() & F.col("change_ytd_pct").isNotNull()
    flag = F.when(~price, "POOR").when(change, "GOOD").otherwise("INCOMPLETE")
    return prices.withColumn("data_quality_flag", flag).withColumns({"confidence_score": F.when(F.col("data_quality_flag") == "GOOD", 85.0).when(F.col("data_quality_flag") == "INCOMPLETE", 70.0).otherwise(30.0), "has_complete_data": F.col("data_quality_flag") == "GOOD"})


def retain(df: DataFrame, day: str, as_of: str, days: int) -> DataFrame:
    """Rows not older than `days` before as_of."""
    return df.filter(F.col(day) >= F.date_sub(F.lit(as_of).cast("date"), days))


def sector_sync(mapped: DataFrame, dims: DataFrame) -> DataFrame:
    """(stock_code, status): how the reference map and the dimension differ, by one full outer join."""
    m, d = mapped.select("stock_code", F.col("sector_name").alias("_new")), dims.select("stock_code", F.col("sector_name").alias("_old"))
    status = F.when(F.col("_old").isNull() & F.col("_new").isNotNull(), "missing_in_dim").when(F.col("_new").isNull(), "missing_in_map").when(F.col("_old").eqNullSafe(F.col("_new")), "unchanged").otherwise("updated")
    return m.join(d, "stock_code", "full_outer").select("stock_code", status.alias("status"))


def running_changes(batch: DataFrame, facts: DataFrame) -> DataFrame:
    """batch with the previous close of facts and batch, strictly before the row's day."""
    w = Window.partitionBy("stock_id").orderBy("price_date")
    both = facts.select("stock_id", "price_date", "close_price").withColumn("_new", F.lit(False)).unionByName(batch.select("stock_id", "price_date", "close_price").withColumn("_new", F.lit(True)))
    return both.withColumn("previous_close", F.lag("close_price").over(w)).filter("_new").drop("_new")


# Names under which indicators may come, with the fact's own.
INDICATOR_ALIASES = {"rsi": "rsi_14", "macd_line": "macd", "bb_upper": "bollinger_upper", "bb_middle": "bollinger_middle", "bb_lower": "bollinger_lower", "sma_7": "ma_7", "sma_30": "ma_30", "sma_90": "ma_90"}


def upsert_indicators(facts: DataFrame, batch: DataFrame) -> DataFrame:
    """facts with the batch's indicators by (stock_id, price_date), aliases resolved; columns that the fact has not go."""
    known = batch.withColumnsRenamed({a: n for a, n in INDICATOR_ALIASES.items() if a in batch.columns and n not in batch.columns})
    return upsert(facts, known.select(*[c for c in known.columns if c in facts.columns]), ["stock_id", "price_date"])


def replace_run(tables: dict[str, DataFrame], runs: DataFrame, new: DataFrame, match: list[str]) -> dict[str, DataFrame]:
    """runs and its dependent tables (by run_id) without the runs that new ones replace, equal in the `match` columns, with `new` among the runs."""
    old = runs.join(new.select(*match).distinct(), match, "left_semi").select("run_id").distinct()
    kept = {name: t.join(old, "run_id", "left_anti") for name, t in tables.items()}
    return kept | {"runs": runs.join(old, "run_id", "left_anti").unionByName(new, allowMissingColumns=True)}


def updated(df: DataFrame, where: Column, **values: Column) -> DataFrame:
    """df with values set where the condition holds: resolving, expiring, activating, delisting, metadata."""
    hit = F.coalesce(where, F.lit(False))
    return df.withColumns({c: F.when(hit, v).otherwise(F.col(c)) for c, v in values.items()})


def keep_newest(df: DataFrame, keys: list[str], newest: list[str]) -> DataFrame:
    """One row for each key: the newest, nulls last, for alerts by time and id or recommendations by id."""
    return keep_one(df, keys, [F.col(c).desc_nulls_last() for c in newest])


def repair_state(staged: DataFrame, facts: DataFrame, alerts: DataFrame, recommendations: DataFrame) -> dict[str, DataFrame]:
    """The pending repairs as plans: staged days without a fact are loaded, flags made anew, and of repeated alerts and
    recommendations the newest stay."""
    loaded = facts.unionByName(missing_facts(staged, facts, ["stock_id", "price_date"]), allowMissingColumns=True)
    return {
        "prices": repair_flags(loaded), "alerts": keep_newest(alerts, ["stock_id", "rule_id", "alert_date"], ["alert_timestamp", "alert_id"]),
        "recommendations": keep_newest(recommendations, ["stock_id", "recommendation_date", "profile"], ["recommendation_id"]),
    }


def write_report(df: DataFrame, path: str) -> None:
    """A report as JSON lines under path."""
    df.write.mode("overwrite").json(path)


def distinct_outcomes(*frames: DataFrame) -> DataFrame:
    """Rows of all frames, each once."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out.dropDuplicates()
