"""Ranked search against scores of all documents, and how far lists are read."""

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
from pyspark.sql import functions as F

from tapeweave.llm import bestposition
from tapeweave.llm.queries import ORACLES, op12_best_position

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(0x41, 0x5B)}


def terms_of(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k):
    held = [(i, Counter(terms_of(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n_docs, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms_of(text))
    out = []
    for item, terms in asked.items():
        scored = []
        for i, c in held:
            m = 50 + 50 * sum(c.values()) * n_docs // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in terms if t in c)
            if score > 0:
                scored.append((-score, i is None, i))
        scored.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        out += [(item, r, i, -s) for r, (s, _, i) in enumerate(scored[:k], 1)]
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_odd_rows(spark):
    long = " ".join(f"w{i % 977}" for i in range(200_000))
    docs = [(1, "alpha beta"), (2, "Alpha ALPHA beta!"), (2, "Alpha ALPHA beta!"), (3, None), (4, ""), (5, "..."), (None, "alpha beta"), (None, "gamma"), (6, long), (7, "É é à alpha\x00beta 12 ½"), (8, "x" * 500_000), (9, "alpha beta")]
    items = [(1, "alpha"), (2, None), (3, "?!"), (4, "w5 w6 gamma É"), (4, "alpha alpha"), (None, "beta é 12"), (5, "nowhere"), (6, "x" * 500_000)]
    left = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"score": F.lit("clash"), "rank": F.lit(1), "_id": F.lit(2)})
    right = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit("clash"))
    for k in (2, 50):
        assert got(bestposition.ranked_search(left, right, k=k)) == brute(docs, items, k)
    assert got(bestposition.ranked_search(left.limit(0), right)) == got(bestposition.ranked_search(left, right.limit(0))) == []


def test_ties_over_shards_blocks_and_ids(spark, monkeypatch):
    draw = random.Random(3)
    docs = [(i, " ".join(draw.choices("abcdefgh", k=draw.choice([3, 3, 3, 8])))) for i in range(3000)]
    items = [(i, " ".join(draw.sample("abcdefgh", 3))) for i in range(20)]
    monkeypatch.setattr(bestposition, "BLOCK_TERMS", 16)
    left, right = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert got(bestposition.ranked_search(left, right, k=7)) == brute(docs, items, 7)


def test_lists_are_read_in_part():
    draw = np.random.default_rng(5)
    doc, term = np.repeat(np.arange(4000), 3), np.tile(np.arange(3), 4000)
    impact = (draw.pareto(1.5, 12_000) * 1000).astype(np.int64) + 1
    shard = bestposition.Shard(list(range(4000)), doc, term, impact, 3)
    best, depth = shard.search(np.arange(3), [], 5)
    scores = impact.reshape(4000, 3).sum(axis=1)
    assert [(-s, i) for s, _, i in best] == [(int(scores[i]), int(i)) for i in np.lexsort((np.arange(4000), -scores))[:5]]
    assert depth < 1000
    assert shard.search(np.arange(3), best, 5)[1] <= depth  # what came before stops it as soon or sooner


def test_whole_tables_by_sql(spark):
    sf_dir = "/root/testdata/sf0.001"
    db = duckdb.connect()
    for name in ("documents", "benchmark"):
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    rows = db.execute(f"SELECT item_id, rank, doc_id, score FROM ({ORACLES['op12_best_position']})").fetchall()
    assert got(op12_best_position(spark, sf_dir)) == sorted(rows, key=str) and rows
