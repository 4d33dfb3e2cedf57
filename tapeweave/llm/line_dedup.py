"""Line dedup: explode normalised lines, hash, count distinct documents per hash, drop, reassemble."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import aside, at, small_side, written

BLANKS = " \t\n\u000b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z alone; lower() is the same, and faster, where all characters are ASCII."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def dedup_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """Drop lines whose key stands in at least min_docs documents, but for the largest id with it.

    A key is the line, stripped of ASCII white space and with A-Z in lower case; keys of under
    min_chars code points are left alone. All columns of docs stay; text_col holds the lines that
    stay, joined by \\n, and `n_lines` (before dropping) and `n_dropped` are added (a column of such
    a name is replaced). A null or empty text is one empty line and gives an empty text. Rows that
    share an id count as one document and keep or lose lines together. Rows with a null id are
    passed through and count for nothing. An empty table stays empty; a key as often in a document as
    may be counts once. Columns of any other names are left as they are.
    """
    cols, kept = aside(docs, "n_lines", "n_dropped")
    id_, text_ = at(docs, id_col), at(docs, text_col)
    text = F.coalesce(F.col(text_).cast("string"), F.lit(""))
    # 128-bit digests are exact at any size that could be met; the lines themselves are not shuffled
    lines = cols.filter(F.col(id_).isNotNull()).select(F.col(id_).alias("_id"), F.posexplode_outer(F.split(text, "\n")).alias("_pos", "_line"))
    # an outer explode: for an inner one, Spark would split the texts once more to leave out empty arrays
    lines = lines.withColumn("_line", F.btrim("_line", F.lit(BLANKS))).filter(F.char_length("_line") >= min_chars)
    lines = lines.select("_id", "_pos", F.unhex(F.md5(ascii_lower(F.col("_line")))).alias("_hash"))
    lines = written(lines, "lines")  # read twice: to count, and to find the places
    common = lines.groupBy("_hash").agg(F.countDistinct("_id").alias("_docs"), F.max("_id").alias("_keep")).filter(F.col("_docs") >= min_docs).select("_hash", "_keep")
    common = written(common, "common-lines")
    # sent to the lines while small; beyond that both are shuffled, and Spark splits what a line in a third of all documents fills
    places = lines.join(small_side(common, common.count(), 64), "_hash").filter(F.col("_id") != F.col("_keep"))
    dropped = places.groupBy("_id").agg(F.sort_array(F.collect_set("_pos")).alias("_gone"))
    n = F.size("_lines")
    # the runs of lines between dropped places, each copied once
    edges = F.concat(F.array(F.lit(-1)), F.col("_gone"), F.array(n))
    runs = F.transform(F.sequence(F.lit(1), F.size("_gone") + 1), lambda i: F.slice("_lines", F.element_at("_edges", i) + 2, F.element_at("_edges", i + 1) - F.element_at("_edges", i) - 1))
    out = cols.join(dropped, F.col(id_) == F.col("_id"), "left").withColumn("_lines", F.split(text, "\n")).withColumn("_edges", F.when(F.col("_gone").isNotNull(), edges))
    stays = F.when(F.col("_gone").isNull(), text).otherwise(F.array_join(F.flatten(runs), "\n"))
    out = out.withColumn("_kept", stays)
    return out.select(*[F.col("_kept" if c == text_ else c).alias(name) for c, name in kept], n.cast("long").alias("n_lines"), F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_dropped"))
