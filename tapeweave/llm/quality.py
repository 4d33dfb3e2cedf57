"""Quality rules: counts of each text, and a hashed n-gram log-likelihood ratio against a trusted target."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import aside, at, quoted, small_side, written

SPACE = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"
#: Above so many repeated windows in a text, their places are found by sorting, not by look-ups.
FEW = 64
ADDED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept")


def tokens(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def _repeated_places(windows: Column, ordered: Column) -> Column:
    """Sorted places (from 0) of the values that stand more than once; ordered: the values sorted."""
    twice = F.array_distinct(F.filter(ordered, lambda x, i: (i > 0) & (x == F.element_at(ordered, F.greatest(i, F.lit(1))))))
    few = F.filter(F.transform(windows, lambda h, i: F.when(F.array_contains("_twice", h), i)), lambda i: i.isNotNull())
    pairs = F.col("_pairs")
    near = F.filter(pairs, lambda x, i: ((i > 0) & (x["h"] == F.element_at(pairs, F.greatest(i, F.lit(1)))["h"])) | ((i < F.size(pairs) - 1) & (x["h"] == F.element_at(pairs, F.least(i + 2, F.size(pairs)))["h"])))
    many = F.sort_array(F.transform(near, lambda x: x["i"]))
    return twice, few, many


def with_hashes(df: DataFrame, text_col: str) -> DataFrame:
    """Adds _words and _hashes, the words' hashes; columns, so that each is computed once."""
    return df.withColumn("_words", tokens(F.col(text_col))).withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))


def text_counts(docs: DataFrame, text_col: str, window: int = 3) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of text_col (null: none), and _row, a number."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    df = with_hashes(docs, text_col)
    n = F.size("_hashes")
    places = F.when(n >= window, F.sequence(F.lit(1), n - (window - 1))).otherwise(F.array().cast("array<int>"))
    df = df.withColumn("_windows", F.transform(places, lambda i: F.xxhash64(*[F.element_at("_hashes", i + k) for k in range(window)])))
    df = df.withColumn("_sorted", F.sort_array("_windows"))
    twice, few, many = _repeated_places(F.col("_windows"), F.col("_sorted"))
    df = df.withColumn("_twice", twice)
    df = df.withColumn("_pairs", F.when(F.size("_twice") > FEW, F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    df = df.withColumn("_places", F.when(F.size("_twice") == 0, F.array().cast("array<int>")).when(F.size("_twice") <= FEW, few).otherwise(many))
    # each window covers its own words up to the next repeated window's start
    p = F.col("_places")
    steps = F.zip_with(F.slice(p, 2, F.greatest(F.size(p) - 1, F.lit(0))), F.slice(p, 1, F.greatest(F.size(p) - 1, F.lit(0))), lambda b, a: F.least(b - a, F.lit(window)))
    covered = F.when(F.size(p) == 0, F.lit(0)).otherwise(F.aggregate(steps, F.lit(window), lambda a, x: a + x))
    df = df.withColumn("_lines", F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")))
    some = text.rlike(f"[{SYMBOLS}]")
    out = {
        "n_words": n.cast("long"),
        "word_chars": F.char_length(F.array_join("_words", "")).cast("long"),
        "n_symbols": F.when(some, F.char_length(F.regexp_replace(text, f"[^{SYMBOLS}]+", ""))).otherwise(0).cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": covered.cast("long"),
    }
    # numbered rows: a filter on the counts stays above them, as Spark would else work them out for it again, nested
    return df.withColumns(out | {"_row": F.monotonically_increasing_id()}).drop("_words", "_hashes", "_windows", "_sorted", "_twice", "_pairs", "_places", "_lines")


def gram_rows(docs: DataFrame, text_col: str, orders: tuple[int, ...], buckets: int) -> DataFrame:
    """docs without the text, a row with `bucket` for each hashed word n-gram of each text."""
    df = with_hashes(docs, text_col).drop(text_col, "_words")
    names = []
    for n in range(1, max(orders) + 1):
        last = F.col(f"_g{n - 1}") if n > 1 else F.col("_hashes")
        more = F.greatest(F.size("_hashes") - (n - 1), F.lit(0))
        df = df.withColumn(f"_g{n}", last if n == 1 else F.zip_with(F.slice(last, 1, more), F.slice("_hashes", n, more), lambda h, w: F.xxhash64(h, w)))
        names.append(f"_g{n}")
    df = df.withColumn("_grams", F.concat(*[F.col(f"_g{n}") for n in orders])).drop("_hashes", *names)
    # an outer explode: for an inner one, Spark would work the arrays out once more to leave out empty ones
    df = df.withColumn("bucket", F.explode_outer("_grams")).filter(F.col("bucket").isNotNull()).drop("_grams")
    return df.withColumn("bucket", F.pmod("bucket", F.lit(buckets)).cast("int"))


def gram_ratios(docs: DataFrame, trusted: DataFrame, *, orders: tuple[int, ...], buckets: int, prior: float) -> DataFrame:
    """(bucket, ratio): log of the bucket's share in the trusted documents (column _id) over that in all of docs (_id, _text).

    Both counts get `prior` more, on the scale of the trusted counts, so that buckets too rare to
    tell anything have a ratio near 0. Counted over all documents in one pass; the table has
    `buckets` rows at most, whatever the corpus.
    """
    trusted = trusted.select("_id", F.lit(1).alias("_trusted")).distinct()
    marked = docs.join(small_side(trusted, trusted.count()), "_id", "left").withColumn("_trusted", F.coalesce("_trusted", F.lit(0)))
    counts = gram_rows(marked, "_text", orders, buckets).groupBy("bucket").agg(F.count("*").alias("_raw"), F.sum("_trusted").alias("_target"))
    counts = written(counts, "gram-counts")
    scale = counts.agg((F.sum("_target") / F.sum("_raw")).alias("_scale"))
    return counts.crossJoin(F.broadcast(scale)).select("bucket", F.log((F.col("_target") + F.lit(prior)) / (F.col("_raw") * F.col("_scale") + F.lit(prior))).alias("ratio"))


def gram_scores(docs: DataFrame, trusted: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", orders: tuple[int, ...] = (1, 2), buckets: int = 1 << 16, prior: float = 10.0) -> DataFrame:
    """(id, score): mean log ratio of the document's n-grams; documents without any are not in it.

    Rows that share an id are scored together. trusted: the target's ids, in a column named id_col.
    """
    narrow = docs.select(F.col(quoted(id_col)).alias("_id"), F.col(quoted(text_col)).cast("string").alias("_text"))
    ratios = gram_ratios(narrow, trusted.select(F.col(quoted(id_col)).alias("_id")), orders=orders, buckets=buckets, prior=prior)
    return gram_rows(narrow, "_text", orders, buckets).join(F.broadcast(ratios), "bucket").groupBy("_id").agg(F.avg("ratio").alias("score")).withColumnRenamed("_id", id_col)


def quality_rules(docs: DataFrame, trusted: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = -0.15, min_words: int = 50, max_repeat_percent: int = 50, orders: tuple[int, ...] = (1, 2), buckets: int = 1 << 16, prior: float = 10.0) -> DataFrame:
    """docs with the counts of text_counts, base_failed, score and kept; trusted has the target's ids.

    base_failed: under min_words words, or more than max_repeat_percent of 100 words in repeated
    3-word windows. kept: not base_failed, and the score is at least `threshold`. A document
    without n-grams, or with a null id, scores 0 (null and empty texts fail the base rules). Where no
    document is trusted all scores are 0. Input columns of the added names are replaced, those of any
    other names left as they are. An empty table stays empty; rows that share an id are scored together.
    """
    cols, keep = aside(docs, *ADDED)
    id_, text_ = at(docs, id_col), at(docs, text_col)
    scores = gram_scores(cols, trusted.select(F.col(quoted(id_col)).alias(id_)), id_col=id_, text_col=text_, orders=orders, buckets=buckets, prior=prior).withColumnRenamed(id_, "_id")
    out = text_counts(cols, text_).join(scores, F.col(id_) == F.col("_id"), "left")
    out = out.withColumn("score", F.coalesce(F.nanvl("score", F.lit(0.0)), F.lit(0.0)))
    out = out.withColumn("base_failed", (F.col("n_words") < min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * max_repeat_percent))
    out = out.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold) & (F.col("_row") >= 0))
    return out.select(*[F.col(c).alias(name) for c, name in keep], *ADDED)
