"""Scans that continue from block to block, so that a single key's rows spread over all tasks.

Rows are dealt by ranges of (key, order): a block is a stretch of keys' rows in order. Windows run within
(key, block); each block is summed up by a small summary, summaries merge from left to right (their merge is
associative), and what the blocks before add up to is joined back. Only keys that reach over several blocks
have anything to carry: at most two rows for each block, whatever the number of keys, so these are broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tapeweave.plans.facts import cut_lineage


def in_blocks(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """df with `_block`. Ranges are drawn anew whenever the plan runs: write the rows before they are read twice."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(parts, *by, *order).withColumn("_block", F.spark_partition_id())


def _within(by: list[str], order: list[str]):
    return Window.partitionBy(*by, "_block").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)


def _before(by: list[str]):
    return Window.partitionBy(*by).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)


def _carried(summaries: DataFrame, by: list[str], carry: dict[str, Column]) -> DataFrame:
    """(by, _block, carry) of blocks that others of the same key come before."""
    later = F.row_number().over(Window.partitionBy(*by).orderBy("_block")) > 1
    return F.broadcast(summaries.withColumns({**carry, "_later": later}).filter("_later").select(*by, "_block", *carry))


def running_equity(trades: DataFrame, run: str, order: list[str], *, pct: str = "net_return_pct", skip_ruin: bool = False) -> DataFrame:
    """trades with equity, the product of 1 + pct / 100 up to each trade of a run, and peak, its highest so far, 1 at least.

    A trade of -100 % takes equity to 0 for good, one beyond turns its sign; skip_ruin leaves both out. `order` must
    tell all trades of a run apart. A null return leaves equity as it is. Block summary: sum of logarithms, zeros
    and sign changes, highest and lowest product within; its merge is that of products and of peaks.
    """
    factor = F.when(F.col(pct) > -100, 1 + F.col(pct) / 100) if skip_ruin else 1 + F.col(pct) / 100
    w = _within([run], order)
    sums = {"_log": F.when(F.col("_factor") != 0, F.ln(F.abs("_factor"))), "_zeros": (F.col("_factor") == 0).cast("long"), "_turns": (F.col("_factor") < 0).cast("long")}

    def product(log: Column, zeros: Column, turns: Column) -> Column:
        return F.when(zeros > 0, 0.0).otherwise(F.exp(log) * F.when(turns % 2 == 1, -1.0).otherwise(1.0))

    dealt = in_blocks(trades.withColumn("_factor", factor), [run], order).withColumns(sums)
    rows = dealt.withColumns({f"{c}_run": F.sum(F.coalesce(c, F.lit(0))).over(w) for c in sums})
    rows = rows.withColumn("_own", product(*(F.col(f"{c}_run") for c in sums))).withColumns({"_high": F.max("_own").over(w), "_low": F.min("_own").over(w)})
    rows = cut_lineage(rows.drop("_factor", *(f"{c}_run" for c in sums)), "equity")
    blocks = rows.groupBy(run, "_block").agg(*[F.sum(F.coalesce(c, F.lit(0))).alias(c) for c in sums], F.max("_own").alias("_top"), F.min("_own").alias("_bottom"))
    blocks = blocks.withColumn("_base", product(*(F.coalesce(F.sum(c).over(_before([run])), F.lit(0)) for c in sums)))
    reached = F.greatest(F.col("_base") * F.col("_top"), F.col("_base") * F.col("_bottom"))
    carried = _carried(blocks.withColumn("_reached", reached), [run], {"_start": F.col("_base"), "_peak": F.max("_reached").over(_before([run]))})
    out = rows.join(carried, [run, "_block"], "left").withColumn("_start", F.coalesce("_start", F.lit(1.0)))
    here = F.greatest(F.col("_start") * F.col("_high"), F.col("_start") * F.col("_low"))
    return out.select(*trades.columns, (F.col("_start") * F.col("_own")).alias("equity"), F.greatest(F.lit(1.0), F.col("_peak"), here).alias("peak"))


def last_before(requests: DataFrame, facts: DataFrame, *, by: str, on: str, values: list[str], strict: bool = False) -> DataFrame:
    """As asof.asof, in blocks: a key with most of the rows is not one task's. Block summary: the last fact."""
    f = facts.select(F.col(by).alias("_by"), F.col(on).alias("_on"), F.struct(*values).alias("_fact"), F.lit(0).alias("_kind"))
    q = requests.withColumns({"_by": F.col(by), "_on": F.col(on), "_kind": F.lit(-1 if strict else 1)})
    both = in_blocks(q.unionByName(f, allowMissingColumns=True), ["_by"], ["_on", "_kind"])
    rows = cut_lineage(both.withColumn("_here", F.last("_fact", ignorenulls=True).over(_within(["_by"], ["_on", "_kind"]))), "asof")
    ends = rows.groupBy("_by", "_block").agg(F.max_by("_here", F.struct("_on", "_kind")).alias("_last"))
    carried = _carried(ends, ["_by"], {"_old": F.last("_last", ignorenulls=True).over(_before(["_by"]))})
    out = rows.filter("_kind <> 0").join(carried, ["_by", "_block"], "left").withColumn("_fact", F.coalesce("_here", "_old"))
    return out.select(*requests.columns, *[F.col(f"_fact.{v}").alias(f"asof_{v}") for v in values])
