"""Approximate nearest neighbours by multi-index hashing over learned rotated binary codes."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import quoted

#: Bits of a substring of a code; a substring is an index of its own.
PIECE = 8
_WEIGHT = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def learn_rotation(sample: np.ndarray, rounds: int = 20, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """(mean, rotation): principal axes, turned so that signs lose least (iterative quantisation)."""
    mean = sample.mean(axis=0) if len(sample) else np.zeros(sample.shape[1])
    x = sample - mean
    size = sample.shape[1]
    axes = np.linalg.svd(x.T @ x + 1e-9 * np.eye(size))[0]
    turn = np.linalg.qr(np.random.default_rng(seed).normal(size=(size, size)))[0]
    v = x @ axes
    for _ in range(rounds):
        u, _, w = np.linalg.svd(np.where(v @ turn > 0, 1.0, -1.0).T @ v)
        turn = (u @ w).T
    return mean, axes @ turn


def learn_codes(sample: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(mean, rotations side by side): learned rotations from as many starts as make codes of `bits` bits or more."""
    size = sample.shape[1]
    turns = [learn_rotation(sample, seed=7 + k) for k in range(max(1, -(-bits // size)))]
    return turns[0][0], np.concatenate([r for _, r in turns], axis=1)


def encode(vectors: np.ndarray, mean: np.ndarray, rotation: np.ndarray) -> np.ndarray:
    """Codes as rows of bytes, padded with zeros to whole 64-bit words."""
    bits = np.packbits((vectors - mean) @ rotation > 0, axis=1)
    return np.ascontiguousarray(np.pad(bits, ((0, 0), (0, -bits.shape[1] % 8))))


def distances(code: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Bits in which the codes differ from one."""
    return np.bitwise_count(codes.view(np.uint64) ^ code.view(np.uint64)).sum(axis=1, dtype=np.int32)


def learn_radius(unit: np.ndarray, codes: np.ndarray, k: int, recall: float, asked: int = 256) -> int:
    """Radius that holds the share `recall` of the k nearest of some rows within the sample.

    In a larger table the k nearest are no further, so there it holds no less.
    """
    score = unit[:asked] @ unit.T
    score[np.arange(len(score)), np.arange(len(score))] = -np.inf
    k = min(k, len(unit) - 1)
    if k < 1:
        return codes.shape[1] * 8
    nearest = np.argpartition(-score, k - 1, axis=1)[:, :k]
    return int(np.quantile(np.concatenate([distances(codes[q], codes[n]) for q, n in enumerate(nearest)]), recall, method="higher"))


class SubstringIndex:
    """Rows of a block by the value of each substring of their codes."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.order = [np.argsort(codes[:, j], kind="stable") for j in range(codes.shape[1])]
        self.starts = [np.searchsorted(codes[o, j], np.arange(257)) for j, o in enumerate(self.order)]

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Rows of all codes within radius: one substring of such a code at least is within radius // substrings.

        Where the substrings to be probed hold more rows than there are, the codes are gone through in
        their order instead; the rows found are the same.
        """
        m = len(code)
        ball = _WEIGHT <= radius // m
        if int(ball.sum()) * m >= 256:
            return np.flatnonzero(distances(code, self.codes) <= radius)
        seen = [self.order[j][self.starts[j][value] : self.starts[j][value + 1]] for j in range(m) for value in np.flatnonzero(ball[np.arange(256) ^ code[j]])]
        rows = np.unique(np.concatenate(seen))
        return rows[distances(code, self.codes[rows]) <= radius]


def _searcher(mean: np.ndarray, rotation: np.ndarray, k: int, radius: int):
    def search(block: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        columns = ["query_id", "vec_id", "score"]
        if block.empty or asked.empty:
            return pd.DataFrame(columns=columns).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})
        ids = block["vec_id"].to_numpy()
        vectors = np.stack(block["vector"].to_numpy()).astype(np.float64)
        norms = np.sqrt((vectors * vectors).sum(axis=1))
        index = SubstringIndex(encode(vectors / norms[:, None], mean, rotation))
        questions = np.stack(asked["vector"].to_numpy()).astype(np.float64)
        lengths = np.sqrt((questions * questions).sum(axis=1))
        codes = encode(questions / lengths[:, None], mean, rotation)
        out = []
        for q, query_id in enumerate(asked["query_id"].to_numpy()):
            reach = radius
            rows = index.within(codes[q], reach)
            while len(rows) < min(k + 1, len(ids)):  # fewer than asked for: further out
                reach = reach * 2 + 1
                rows = index.within(codes[q], reach)
            rows = rows[ids[rows] != query_id]
            score = (vectors[rows] * questions[q]).sum(axis=1) / (norms[rows] * lengths[q])
            best = np.lexsort((ids[rows], -score))[:k]
            out.append((np.full(len(best), query_id), ids[rows][best], score[best]))
        return pd.DataFrame(dict(zip(columns, map(np.concatenate, zip(*out, strict=True)), strict=True)))

    return search


def _finite(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Vectors that take part, as arrays of doubles: not null, not zero, all components finite."""
    v = F.transform(F.col(quoted(vector_col)), lambda x: x.cast("double"))
    out = df.filter(F.col(quoted(vector_col)).isNotNull() & F.col(quoted(id_col)).isNotNull()).select(F.col(quoted(id_col)).cast("long").alias("vec_id"), v.alias("vector"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return out.filter(~F.coalesce(bad, F.lit(True)) & F.exists("vector", lambda x: x != 0))


def nearest(df: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", query_every: int = 50, k: int = 5, bits: int = 256, recall: float = 0.97, block_rows: int = 8192, query_rows: int = 2048, sample_rows: int = 20_000) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest by cosine that the index finds for each query.

    Queries are the rows with ids divisible by query_every; candidates are all others'. The rotations
    and the radius are fitted on at most sample_rows rows, the lowest by hash; every row is indexed.
    Rows are cut into blocks of about block_rows, each with an index for every substring of the codes,
    and meet the queries in lots of about query_rows. A query takes all codes of a block within the
    radius, which holds the share `recall` of the sample's own nearest, and ranks them by the float
    vectors; where these are fewer than k, the radius grows.

    Of rows with the same vector the k + 1 smallest ids stand for all, since ties go to the smaller
    id. Vectors that are null, zero, or hold null or non-finite components take no part. Vectors of
    different lengths have no cosine: those of one length are searched among themselves, a length
    after another. Rows that repeat id and vector are one; of a query id with several vectors one is
    asked. Rows with null ids take no part. An empty table gives no rows. Other columns are not read, whatever
    their names.
    """
    all_rows = _finite(df, id_col, vector_col)
    lengths = sorted(r[0] for r in all_rows.groupBy(F.size("vector")).count().collect())
    found = [_nearest_of(all_rows.filter(F.size("vector") == n), query_every, k, bits, recall, block_rows, query_rows, sample_rows) for n in lengths]
    none = df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return reduce(DataFrame.unionByName, found) if found else none


def _nearest_of(all_rows: DataFrame, query_every: int, k: int, bits: int, recall: float, block_rows: int, query_rows: int, sample_rows: int) -> DataFrame:
    """nearest() of rows (vec_id, vector) of one length."""
    sample = np.stack([np.asarray(v) for v in all_rows.orderBy(F.xxhash64("vec_id"), "vec_id").select("vector").limit(sample_rows).toPandas()["vector"]])
    unit = sample / np.linalg.norm(sample, axis=1)[:, None]
    mean, rotation = learn_codes(unit, bits)
    radius = learn_radius(unit, encode(unit, mean, rotation), k, recall)
    queries = all_rows.filter(F.col("vec_id") % query_every == 0).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("vector").alias("vector"))
    # one large group of equal vectors: the smallest ids by lot first, then of all lots
    smallest = lambda c: F.slice(F.array_sort(F.array_distinct(c)), 1, k + 1)
    lots = all_rows.groupBy("vector", F.pmod(F.xxhash64("vec_id"), F.lit(64)).alias("_lot"), F.floor(F.col("vec_id") / 4096).alias("_range")).agg(smallest(F.collect_set("vec_id")).alias("_ids"))
    lots = lots.groupBy("vector", "_lot").agg(smallest(F.flatten(F.collect_list("_ids"))).alias("_ids"))
    kept = lots.groupBy("vector").agg(smallest(F.flatten(F.collect_list("_ids"))).alias("_ids")).select("vector", F.explode("_ids").alias("vec_id"))
    n, n_queries = all_rows.count(), queries.count()
    blocks, asked = max(1, -(-n // block_rows)), max(1, -(-n_queries // query_rows))
    by_block = kept.withColumn("_block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")).withColumn("_asked", F.explode(F.sequence(F.lit(0), F.lit(asked - 1))))
    by_lot = queries.withColumn("_asked", F.pmod(F.xxhash64("query_id"), F.lit(asked)).cast("int")).withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    found = by_block.groupBy("_block", "_asked").cogroup(by_lot.groupBy("_block", "_asked")).applyInPandas(_searcher(mean, rotation, k, radius), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
