"""Estimators fitted per fold or training day, and validation analytics over labelled rows."""

from __future__ import annotations

import datetime as dt
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeweave.operators.fits import FITS, Folds, fit_folds

# Probability buckets, half open but for the last.
BUCKETS = (0.0, 0.4, 0.5, 0.6, 0.7, 1.0)


#: Estimators that users add, by kind: fit(x, y) -> model and predict(model, x) -> probabilities, fitted in one task on a
#: bounded sample of a fold. The one that knows nothing is "none". Those of fits.FITS see all rows of a fold.
FITTERS = {"none": (lambda x, y: None, lambda model, x: np.full(len(x), np.nan))}

_EVER = 1 << 40


def _days(c: str) -> Column:
    return F.unix_date(F.col(c).cast("date"))


def _training_rows(data: DataFrame, features: tuple[str, ...], label: str, known: bool) -> DataFrame:
    x = F.array(*[F.col(f).cast("double") for f in features])
    return data.select("stock_id", "price_date", "forward_return", _days("price_date").alias("_day"), (_days("horizon_date") if known else F.lit(0)).alias("_known"), F.col(label).cast("double").alias("_y"), x.alias("_x"))


def _sampled_models(rows: DataFrame, folds: Folds, kind: str, least_rows: int, least_class: int, most_rows: int) -> dict[int, object]:
    """Models of a user's estimator. Rows are counted by day and drawn by hash before they meet their folds."""
    fit = FITTERS[kind][0]
    days = rows.groupBy("_day", "_known").count().toPandas()
    inside = folds.inside(np.arange(len(folds.number)), days["_day"].to_numpy(), days["_known"].to_numpy())
    share = np.minimum(most_rows / np.maximum(days["count"].to_numpy() @ inside, 1), 1.0)
    table = rows.sparkSession.createDataFrame([(int(n), int(a), int(b), int(k), float(s)) for n, a, b, k, s in zip(folds.number, folds.start, folds.end, folds.known, share, strict=True)], "fold int, _start long, _end long, _by long, _share double")
    draw = F.pmod(F.xxhash64("stock_id", "price_date"), F.lit(1 << 30)) / float(1 << 30)
    drawn = rows.withColumn("_draw", draw).filter(F.col("_draw") < float(share.max(initial=0)))
    train = drawn.join(F.broadcast(table), F.col("_day").between(F.col("_start"), F.col("_end")) & (F.col("_known") <= F.col("_by")) & (F.col("_draw") < F.col("_share")))

    def learn(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["price_date", "stock_id"])
        y = frame["_y"].to_numpy()
        if len(y) < least_rows or min(y.sum(), len(y) - y.sum()) < least_class:
            return pd.DataFrame(columns=["fold", "_model"])
        return pd.DataFrame({"fold": frame["fold"].iloc[:1], "_model": [pickle.dumps(fit(np.stack(frame["_x"].to_numpy()), y))]})

    found = train.select("fold", "stock_id", "price_date", "_y", "_x").groupBy("fold").applyInPandas(learn, "fold int, _model binary")
    return {r["fold"]: pickle.loads(r["_model"]) for r in found.collect()}


def fitted(rows: DataFrame, folds: Folds, p: int, kind: str, *, least_rows: int, least_class: int, most_rows: int = 200_000) -> dict[int, object]:
    """{fold: model} of rows (_day, _known, _y, _x); folds with too few rows or cases have none."""
    if kind in FITS:
        return fit_folds(rows.sparkSession, rows, folds, p, kind, least_rows=least_rows, least_class=least_class)
    return _sampled_models(rows, folds, kind, least_rows, least_class, most_rows)


def predictor(kind: str):
    return (FITS if kind in FITS else FITTERS)[kind][1]


def walk_forward(data: DataFrame, folds: DataFrame, features: tuple[str, ...], *, kind: str = "logistic", label: str = "target", least_rows: int = 100, least_class: int = 20, most_rows: int = 200_000) -> DataFrame:
    """Predictions of each fold's evaluation rows by a model fitted on the fold's training rows.

    Where folds have a `label_by`, only rows whose horizon_date is no later train. Folds are few; models are
    fitted on all training rows (fits.py), or a user's on at most about `most_rows` of them, those of the lowest
    hashes of instrument and day. Models are sent to the tasks once, and all evaluation rows are predicted where
    they lie. Folds with too few rows or cases predict nothing.
    """
    known = "label_by" in folds.columns
    found = folds.select("fold", *[_days(c).alias(c) for c in ("train_start", "train_end", "eval_start", "eval_end", *(["label_by"] if known else []))]).orderBy("fold").toPandas()
    windows = Folds(*(found[c].to_numpy(np.int64) for c in ("fold", "train_start", "train_end")), found["label_by"].to_numpy(np.int64) if known else np.full(len(found), _EVER))
    rows = _training_rows(data, features, label, known)
    models = fitted(rows, windows, len(features), kind, least_rows=least_rows, least_class=least_class, most_rows=most_rows)
    have = found[found["fold"].isin(list(models))]
    sent = data.sparkSession.sparkContext.broadcast(([models[f] for f in have["fold"]], *(have[c].to_numpy(np.int64) for c in ("fold", "eval_start", "eval_end"))))
    predict = predictor(kind)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, fold, start, end = sent.value
        for batch in batches:
            if not batch.num_rows:
                continue
            day = batch.column(3).to_numpy()
            x = batch.column(5).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            for i in np.flatnonzero((start <= day.max()) & (end >= day.min())).tolist():
                at = np.flatnonzero((day >= start[i]) & (day <= end[i]))
                if len(at):
                    some = batch.take(pa.array(at))
                    yield pa.RecordBatch.from_arrays([pa.array([fold[i]] * len(at), pa.int32()), some.column(0), some.column(1), some.column(4).cast(pa.int32()), some.column(2), pa.array(predict(own[i], x[at]), from_pandas=True)], ["fold", "stock_id", "price_date", "target", "forward_return", "probability"])

    ahead = rows.filter(F.col("_day") >= int(have["eval_start"].min())) if len(have) else rows.limit(0)
    return ahead.select("stock_id", "price_date", "forward_return", "_day", "_y", "_x").mapInArrow(apply, "fold int, stock_id long, price_date date, target int, forward_return double, probability double")


def model_store(data: DataFrame, features: tuple[str, ...], *, kind: str = "logistic", label: str = "target", window_days: int = 540, refit_days: int = 7, least_rows: int = 100, least_class: int = 20) -> DataFrame:
    """(kind, as_of, model): a model for each as-of day, fitted on the window that ends the day before.

    Only rows whose label was known by that day train. Models are fitted anew on the first day that data has in
    each run of refit_days days; 1 fits one for every day. Days with too few rows or cases have no model.
    """
    days = data.groupBy(F.floor(_days("price_date") / refit_days)).agg(F.min(_days("price_date")).alias("day")).select("day").toPandas()["day"].sort_values().to_numpy(np.int64)
    models = fitted(_training_rows(data, features, label, True), Folds(days, days - window_days, days - 1, days - 1), len(features), kind, least_rows=least_rows, least_class=least_class)
    rows = [(kind, dt.date(1970, 1, 1) + dt.timedelta(days=d), pickle.dumps(m)) for d, m in sorted(models.items())]
    return data.sparkSession.createDataFrame(rows, "kind string, as_of date, model binary")


def with_probability(rows: DataFrame, store: DataFrame, features: tuple[str, ...], *, kind: str = "logistic", name: str = "probability") -> DataFrame:
    """rows with the probability that the store's latest model of that kind as of their day gives; null before the first.

    The models are sent to the tasks, not the rows to the models: a row finds its model by its day.
    """
    found = store.filter(F.col("kind") == kind).orderBy("as_of").select(_days("as_of").alias("day"), "model").collect()
    sent = rows.sparkSession.sparkContext.broadcast((np.array([r["day"] for r in found], np.int64), [pickle.loads(r["model"]) for r in found]))
    predict = predictor(kind)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        days, models = sent.value
        for batch in batches:
            out = np.full(batch.num_rows, np.nan)
            if batch.num_rows:
                x = batch.column(batch.num_columns - 1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                at = np.searchsorted(days, batch.column(batch.num_columns - 2).to_numpy(), "right") - 1
                for i in np.unique(at[at >= 0]).tolist():
                    some = np.flatnonzero(at == i)
                    out[some] = predict(models[i], x[some])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(out, from_pandas=True)], names=names)

    names = [*rows.columns, name]
    wide = rows.select("*", _days("price_date").cast("long").alias("_day"), F.array(*[F.col(f).cast("double") for f in features]).alias("_x"))
    return wide.mapInArrow(apply, T.StructType([*rows.schema.fields, T.StructField(name, T.DoubleType())]))


def rolling_probabilities(data: DataFrame, days: DataFrame, features: tuple[str, ...], *, window_days: int = 540, **how) -> DataFrame:
    """Probabilities of the rows of each day in `days` (column price_date), trained on the window that ends the day before.

    Only rows whose label was known by the last day of a day's own window train its model.
    """
    numbered = days.select("price_date").distinct().withColumn("fold", F.datediff("price_date", F.lit("1970-01-01")))
    last = F.date_sub("price_date", 1)
    folds = numbered.select("fold", F.date_sub("price_date", window_days).alias("train_start"), last.alias("train_end"), last.alias("label_by"), F.col("price_date").alias("eval_start"), F.col("price_date").alias("eval_end"))
    return walk_forward(data, folds, features, **how)


def bucket_of(p: Column, edges: tuple[float, ...] = BUCKETS) -> Column:
    out = F.when(p < edges[1], 0)
    for n in range(1, len(edges) - 2):
        out = out.when(p < edges[n + 1], n)
    return out.when(p <= edges[-1], len(edges) - 2)


def buckets(predictions: DataFrame, edges: tuple[float, ...] = BUCKETS) -> DataFrame:
    """One row for each bucket, empty ones too."""
    every = predictions.sparkSession.createDataFrame([(n, edges[n], edges[n + 1]) for n in range(len(edges) - 1)], "bucket int, low double, high double")
    found = predictions.groupBy(bucket_of(F.col("probability"), edges).alias("bucket")).agg(F.count("*").alias("rows"), F.avg("probability").alias("mean_probability"), F.avg(F.col("target").cast("double")).alias("hit_rate"), F.avg("forward_return").alias("avg_forward_return"))
    return every.join(found, "bucket", "left").fillna(0, ["rows"])


def scores(predictions: DataFrame) -> DataFrame:
    right = (F.col("probability") >= 0.5) == (F.col("target") == 1)
    return predictions.agg(F.count("*").alias("rows"), F.avg(right.cast("double")).alias("accuracy"), F.avg(F.pow(F.col("probability") - F.col("target"), 2)).alias("brier"), F.avg(F.when(F.col("probability") >= 0.5, F.col("forward_return"))).alias("avg_return_when_up"))


def top_k(predictions: DataFrame, key: str, k: int) -> DataFrame:
    """The k rows of the greatest key; ties by forward return, then instrument, all downwards."""
    return predictions.orderBy(F.col(key).desc(), F.col("forward_return").desc(), F.col("stock_id").desc()).limit(k)


def momentum_baseline(data: DataFrame, k: int, *, by: str = "change_10d") -> DataFrame:
    """The k rows that momentum alone would pick: by ten-day change, forward return and code, all downwards."""
    return data.orderBy(F.col(by).desc_nulls_last(), F.col("forward_return").desc_nulls_last(), F.col("stock_id").desc()).limit(k)


def threshold_sweep(predictions: DataFrame, thresholds: tuple[float, ...], *, cost_pct: float = 0.2) -> DataFrame:
    """What each threshold keeps: rows meet all thresholds in one pass."""
    net = F.col("forward_return") - cost_pct
    df = predictions.withColumn("threshold", F.explode(F.array(*[F.lit(float(t)) for t in thresholds])))
    kept = F.col("probability") >= F.col("threshold")
    k = lambda c: F.when(kept, c)
    return df.groupBy("threshold").agg(F.count_if(kept).alias("kept"), (F.count_if(kept) / F.count("*") * 100).alias("retained_pct"), F.avg(k(F.col("target").cast("double"))).alias("positive_rate"), F.avg(k(net)).alias("avg_net_return"), F.avg(k((net > 0).cast("double"))).alias("win_rate"), F.avg(F.when(kept & (net > 0), net)).alias("avg_win"), F.avg(F.when(kept & (net <= 0), net)).alias("avg_loss"))


def block_sweep(predictions: DataFrame, thresholds: tuple[float, ...]) -> DataFrame:
    """What blocking at each threshold of P(bad) removes, and how bad the rest is."""
    df = predictions.withColumn("threshold", F.explode(F.array(*[F.lit(float(t)) for t in thresholds])))
    blocked, bad = F.col("probability") >= F.col("threshold"), F.col("target") == 1
    rate = lambda c: F.avg(F.when(c, bad.cast("double")))
    return df.groupBy("threshold").agg((F.count_if(blocked) / F.count("*") * 100).alias("blocked_pct"), (F.count_if(blocked & bad) / F.nullif(F.count_if(bad), F.lit(0))).alias("recall"), rate(~blocked).alias("bad_rate_kept"), rate(blocked).alias("bad_rate_blocked"))


def grid(predictions: DataFrame, cases: dict[str, float], *, least_rows: int) -> DataFrame:
    """One row for each case (its lowest probability): what it keeps, and whether it is ready."""
    table = predictions.sparkSession.createDataFrame(list(cases.items()), "name string, low double")
    out = predictions.crossJoin(F.broadcast(table)).groupBy("name").agg(F.count_if(F.col("probability") >= F.col("low")).alias("rows"), F.avg(F.when(F.col("probability") >= F.col("low"), F.col("target").cast("double"))).alias("positive_rate"), F.avg(F.when(F.col("probability") >= F.col("low"), F.col("forward_return"))).alias("avg_return"))
    return out.withColumn("ready", (F.col("rows") >= least_rows) & (F.col("avg_return") > 0))


def cohorts(data: DataFrame) -> DataFrame:
    """Rows, retained share, positive rate and averages of each trust cohort; empty ones are there."""
    conf, days = F.col("confidence_score"), F.col("trusted_history_days")
    bands = {
        "confidence:high": F.coalesce(conf >= 80, F.lit(False)), "confidence:medium": F.coalesce((conf >= 60) & (conf < 80), F.lit(False)), "confidence:low": F.coalesce(conf < 60, F.lit(True)),
        "history:long": days >= 90, "history:medium": days.between(60, 89), "history:short": days < 60,
        "quality:good": F.col("data_quality_flag") == "GOOD", "quality:other": F.col("data_quality_flag") != "GOOD",
    }
    return _labelled(data, bands, "cohort")


def trust_filters(data: DataFrame) -> DataFrame:
    """The same metrics for what six filters let pass."""
    conf = F.coalesce(F.col("confidence_score"), F.lit(0.0))
    good, days = F.col("data_quality_flag") == "GOOD", F.col("trusted_history_days")
    rules = {"all": F.lit(True), "confidence_60": conf >= 60, "confidence_80": conf >= 80, "good_only": good, "history_60": days >= 60, "strict": (conf >= 80) & good & (days >= 90)}
    return _labelled(data, rules, "filter")


def _labelled(data: DataFrame, rules: dict[str, Column], name: str) -> DataFrame:
    """One row for each rule, in one pass over the data: an aggregate for each, then unpivoted."""
    parts = []
    for label, c in rules.items():
        w = lambda x, c=c: F.avg(F.when(c, x))
        parts.append(F.struct(F.lit(label).alias(name), F.count_if(c).alias("rows"), (F.count_if(c) / F.nullif(F.count("*"), F.lit(0)) * 100).alias("retained_pct"), w(F.col("target").cast("double")).alias("positive_rate"), w(F.col("forward_return")).alias("avg_forward_return"), w(F.coalesce("confidence_score", F.lit(0.0))).alias("avg_confidence"), w(F.col("trusted_history_days").cast("double")).alias("avg_history")).alias(label.replace(":", "_")))
    out = data.agg(*parts)
    return out.select(F.explode(F.array(*out.columns)).alias("s")).select("s.*")


def dataset_summary(data: DataFrame, fields: tuple[str, ...] = ()) -> DataFrame:
    """One row: counts, share of positives, days, repeated keys, and of `fields` those with nulls (name=count), all null, and constant.

    A field is constant if all its values are equal, nulls too; lists are in the order of names. One pass for all fields.
    """
    names = sorted(fields)
    keys = data.groupBy("stock_id", "price_date").count().agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("duplicates"))
    per_field = [x for n in names for x in (F.count_if(F.col(n).isNull()).alias(f"_null_{n}"), (F.min(n) == F.max(n)).alias(f"_same_{n}"))]
    out = data.agg(F.count("*").alias("rows"), F.countDistinct("stock_id").alias("stocks"), F.avg(F.col("target").cast("double")).alias("positive_rate"), F.min("price_date").alias("first_date"), F.max("price_date").alias("last_date"), *per_field).crossJoin(keys)
    null, rows = lambda n: F.col(f"_null_{n}"), F.col("rows")
    listed = lambda on, text=lambda n: F.lit(n): F.concat_ws(",", *[F.when(on(n), text(n)) for n in names])
    return out.select(
        "rows", "stocks", "positive_rate", "first_date", "last_date", "duplicates",
        listed(lambda n: null(n) > 0, lambda n: F.concat(F.lit(f"{n}="), null(n).cast("string"))).alias("missing"), listed(lambda n: (rows > 0) & (null(n) == rows)).alias("all_null"),
        listed(lambda n: (rows > 0) & ((null(n) == rows) | ((null(n) == 0) & F.col(f"_same_{n}")))).alias("constants"),
    )
