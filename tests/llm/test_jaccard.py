"""The Jaccard join against all pairs, on tables, odd rows, and groups that need every level."""

import os
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tapeweave.llm import jaccard, sketch


def expected(rows, shingle, num, den):
    sets, ids = [], []
    for doc, text in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        w = re.findall("[^\x20\x09-\x0d]+", low)
        sets.append(frozenset(tuple(w[i : i + shingle]) for i in range(len(w) - shingle + 1)) if len(w) >= shingle else frozenset([tuple(w)] if w else []))
        ids.append(doc)
    parent = {d: d for d in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = {}
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    pairs = {(a, b) for h in holders.values() for k, a in enumerate(h) for b in h[k + 1 :]}
    for a, b in pairs:
        if ids[a] is not None and ids[b] is not None and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
            x, y = sorted((root(ids[a]), root(ids[b])))
            parent[y] = x
    return sorted(((d, len(s), root(d) if d is not None else None) for d, s in zip(ids, sets, strict=True)), key=str)


def got(df, **how):
    return sorted((tuple(r) for r in jaccard.jaccard_components(df, **how).select("doc_id", "n_shingles", "component_id").collect()), key=str)


@pytest.mark.parametrize(("shingle", "num"), [(4, 85), (5, 80)])
def test_tables(spark, shingle, num):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert got(df, shingle=shingle, num=num) == expected([(r["doc_id"], r["text"]) for r in df.collect()], shingle, num, 100)


def near_copies(seed=4):
    """Chains and clusters of edits, passages that many texts share, and short texts."""
    rng = random.Random(seed)
    rows, base = [], [f"b{i}" for i in range(300)]
    chain = list(base)
    for i in range(60):  # each near the one before, far from the first
        at = rng.randrange(290)
        chain[at : at + 1] = [f"c{i}x", f"c{i}y"]
        rows.append(" ".join(chain))
    for i in range(60):  # around one text at several distances
        t = list(base)
        for _ in range(rng.randrange(14)):
            t[rng.randrange(300)] = f"e{rng.randrange(40)}"
        rows.append(" ".join(t))
    passage = [f"p{i}" for i in range(60)]
    for i in range(60):
        rows.append(" ".join([f"own{i}w{k}" for k in range(rng.choice((3, 8, 60)))] + passage))
    for i in range(120):
        rows.append(" ".join(rng.choices("abc", k=rng.randrange(12))))
    for i in range(60):
        w = [f"s{k}" for k in range(rng.choice((9, 11, 14, 20)))]
        w[rng.randrange(len(w))] = f"t{rng.randrange(3)}"
        rows.append(" ".join(w))
    rng.shuffle(rows)
    return [(1000 + i, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("leaf", [2, 12, 1024])
def test_levels(spark, monkeypatch, leaf):
    monkeypatch.setattr(jaccard, "LEAF", leaf)
    monkeypatch.setattr(jaccard, "PIVOTS", 2)
    monkeypatch.setattr(jaccard, "FIRST", 1)
    rows = near_copies()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(df) == expected(rows, 4, 85, 100)


def hubs(n=40, seed=9):
    """Short hubs with a near copy on either side close to the limit; those two don't link."""
    rng, rows = random.Random(seed), []
    for i in range(n):
        hub = [f"h{i}w{k}" for k in range(30)]
        for text in ([f"a{i}", f"b{i}", *hub[2:]], hub, [*hub[:-2], f"y{i}", f"z{i}"]):
            rows.append(" ".join(text))
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_pivots_split_regions():
    """Regions of a metric: all pairs within reach and of other labels, and pivots at work."""
    rng = np.random.default_rng(6)
    for n, spread in ((3, 4), (60, 4), (400, 30), (400, 3)):
        homes = rng.integers(0, 256, (8, 120), dtype=np.uint8)
        rows = homes[rng.integers(0, 8, n)]
        for r in rows:
            r[rng.integers(0, 120, rng.integers(0, spread))] += 1
        label = rng.integers(0, max(2, n // 3), n)
        apart = lambda k, others: (rows[k] != rows[others]).sum(axis=-1)  # noqa: B023, E731
        left, right, d, splits = jaccard.metric_pairs(label, apart, 12)
        expected = {(i, j): int((rows[i] != rows[j]).sum()) for i in range(n) for j in range(i + 1, n) if label[i] != label[j] and (rows[i] != rows[j]).sum() <= 12}
        assert dict(zip(zip(left.tolist(), right.tolist(), strict=True), d.tolist(), strict=True)) == expected
        assert n < 20 or splits > 0


LARGE = "/root/testdata/check_h/documents.parquet"


@pytest.mark.skipif(not os.path.isdir(LARGE), reason="the table with a large group of near copies is not here")
def test_pivots_split_regions_of_a_table(spark, caplog):
    """With production parameters, regions of a large group of near copies are split by pivots."""
    with caplog.at_level("INFO", logger="tapeweave.llm.jaccard"):
        jaccard.jaccard_components(spark.read.parquet(LARGE)).count()
    assert sum(r.args[2] for r in caplog.records) > 0


def test_every_row_twice(spark):
    rows = hubs() * 2
    assert got(spark.createDataFrame(rows, "doc_id long, text string")) == expected(rows, 4, 85, 100)


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "One"), (5, "one"), (6, "É one"), (7, "é one"), (8, long), (9, long + " x"), (9, long + " x"), (10, "a b c d e f g"), (11, "a b c d e f g"), (11, "quite another text of ten words that is not alike"), (12, "quite another text of ten words that is not alike"), (None, "one")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"id": F.lit("clash"), "component": F.lit(1), "region": F.lit(2)})
    assert got(df) == expected(rows, 4, 85, 100)
    assert jaccard.jaccard_components(df.limit(0)).count() == 0
    kept = jaccard.one_of_each(df)
    assert kept.columns == df.columns
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 1, 2, 3, 4, 6, 7, 8, 10]


def test_sketch_has_a_cell_for_each_key_of_6_gb():
    """With fewer cells than keys most sets pass it, and each is dealt to dozens of regions."""
    keys = int(jaccard.SHARE * 6e9 / 6)
    assert sketch.width_for(keys, jaccard.CELLS) >= keys
    assert sketch.width_for(1000, jaccard.CELLS) == sketch.width_for(1000) == 1 << 12
