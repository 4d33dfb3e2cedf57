"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import aside, at, free, written

#: Ties of source and size are ranked within so many lots, so that equal documents spread over tasks.
LOTS = 4096
#: Sizes whose running counts are summed in one group are alike but for so many low bits.
LOW_BITS = 6


def n_words(text):
    """Number of runs of characters other than ASCII white space; null: 0."""
    return F.coalesce(F.size(F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, *, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Targets of sources (columns source, source_size), one row each.

    Sources by code point, null last, take the weights in turn and share `share` of all sizes; a
    target stops at `most` times its source's size, and the excess is shared by weight among the
    others until none is above. With sources ordered by cap / weight, those that stop are a prefix,
    so one running sum finds it. Sources are far fewer than documents: one task orders them.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    s = sizes.withColumn("_w", weight).withColumn("_cap", F.col("source_size") * F.lit(float(most)))
    every = Window.partitionBy()
    order = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    upto = order.rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumns({"_all": F.sum("source_size").over(every) * F.lit(float(share)), "_caps": F.coalesce(F.sum("_cap").over(upto), F.lit(0.0)), "_weights": F.sum("_w").over(every) - F.coalesce(F.sum("_w").over(upto), F.lit(0))})
    # at a source's turn, all before it stop; it is the first that doesn't if its share is within its cap
    s = s.withColumn("_fair", (F.col("_all") - F.col("_caps")) * F.col("_w") / F.col("_weights"))
    s = s.withColumn("_open", F.max(F.when(F.col("_fair") <= F.col("_cap"), 1).otherwise(0)).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    first = Window.orderBy(F.col("_open").desc(), F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    s = s.withColumns({"_rest": F.first(F.col("_all") - F.col("_caps")).over(first), "_left": F.first("_weights").over(first)})
    return s.select("source", "source_size", F.when(F.col("_open") == 1, F.col("_rest") * F.col("_w") / F.col("_left")).otherwise(F.col("_cap")).alias("target"))


def mix_sources(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0, seed: str = "mix") -> DataFrame:
    """docs with `size`, `source_size`, `target` and `copies` (how often the mix holds the document).

    Every document of a source has target / source_size expected copies. In the order of size, then
    id, a running sum of these with one offset per source (of seed and source) passes integers; a
    document is emitted once for each integer that its own step crosses. As neighbours are alike in
    size, the words taken come near the target. Null texts have size 0; a source without words has
    target 0. Ids are whole numbers; null ids are ranked last; rows that are alike are interchangeable. Input columns of the
    added names are replaced; columns of any other names are left as they are. An empty table stays
    empty. The running sum is split into lots of (source, size, id lot), which are counted, summed
    over the counts (within blocks of sizes, then over a source's blocks), and ranked within.
    """
    cols, keep = aside(docs, "size", "source_size", "target", "copies")
    id_, text_, source_ = at(docs, id_col), at(docs, text_col), at(docs, source_col)
    lot = F.coalesce(F.pmod(F.col(id_), F.lit(LOTS)), F.lit(LOTS))
    sized = cols.withColumn("_size", n_words(F.col(text_))).withColumn("_lot", lot)
    # counts need the narrow columns only
    groups = sized.select(F.col(source_).alias("source"), F.col("_size").alias("size"), F.col("_lot").alias("lot"))
    groups = written(groups.groupBy("source", "size", "lot").agg(F.count("*").alias("n")).withColumn("block", F.shiftright("size", LOW_BITS)), "mix-counts")
    targets = source_targets(groups.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), weights=weights, share=share, most=most)
    earlier = lambda *by: Window.partitionBy(*by[:-1]).orderBy(*by[-1]).rowsBetween(Window.unboundedPreceding, -1)
    blocks = groups.groupBy("source", "block").agg(F.sum("n").alias("n")).select(F.col("source").alias("_s"), F.col("block").alias("_b"), F.coalesce(F.sum("n").over(earlier("source", ["block"])), F.lit(0)).alias("before"))
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.lit(":"), F.coalesce("source", F.lit("")))), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    plan = blocks.join(targets.select("source", "source_size", "target", rate.alias("rate"), offset.alias("offset")), F.col("_s").eqNullSafe(F.col("source"))).drop("source")
    plan = groups.withColumn("within", F.coalesce(F.sum("n").over(earlier("source", "block", ["size", "lot"])), F.lit(0))).join(plan, F.col("source").eqNullSafe(F.col("_s")) & (F.col("block") == F.col("_b")))
    plan = plan.withColumn("before", F.col("before") + F.col("within")).select("source", "size", "lot", "before", "source_size", "target", "rate", "offset")
    ranked = sized.withColumn("_k", F.row_number().over(Window.partitionBy(source_, "_size", "_lot").orderBy(F.col(id_).asc_nulls_last())))
    out = ranked.join(plan, F.col(source_).eqNullSafe(F.col("source")) & (F.col("_size") == F.col("size")) & (F.col("_lot") == F.col("lot")))
    k = F.col("before") + F.col("_k")
    copies = F.least(F.floor(F.col("rate") * k + F.col("offset")) - F.floor(F.col("rate") * (k - 1) + F.col("offset")), F.ceil(F.lit(float(most))))
    return out.select(*[F.col(c).alias(name) for c, name in keep], "size", "source_size", "target", copies.cast("long").alias("copies"))


def emit_copies(mixed: DataFrame) -> DataFrame:
    """The mix itself: each row of mix_sources() as often as its copies say, without the added columns."""
    (turn,) = free(mixed, "turn")
    rows = mixed.filter(F.col("copies") > 0).withColumn(turn, F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return rows.drop(turn, "size", "source_size", "target", "copies")
