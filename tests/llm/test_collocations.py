"""Collocations against counts of all n-grams in plain Python and SQL."""

import random
import re
from collections import Counter

import duckdb
import numpy as np
from pyspark.sql import functions as F

from tapeweave.llm import collocations
from tapeweave.llm.queries import ORACLES, op11_collocations

LOWER = {c: c + 32 for c in range(0x41, 0x5B)}


def brute(rows, longest=3, least=10, cover=50, top=2000):
    counts, totals = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for k in range(1, longest + 1):
                counts.setdefault(lang, Counter()).update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        frequent = {p: a for p, a in f.items() if a >= least and len(p) > 1}
        most = Counter()
        for p, a in frequent.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    most[p[i : i + k]] = max(most[p[i : i + k]], a)
        scored = []
        for p, a in frequent.items():
            if most[p] and 100 * most[p] >= cover * a:
                continue
            score, _, l, r = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), l, r))
        out += [(lang, i, p.decode(), -a, l, r, totals[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out)


def got(df):
    return sorted(map(tuple, df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()))


def test_bidirectional_index_counts_and_intervals():
    draw = np.random.default_rng(2)
    ids = draw.integers(0, 5, 3000)
    ids = np.concatenate([[0], ids, [0]])
    index = collocations.ShardIndex(ids, 4)
    found, every = index.words(), lambda columns: np.ones(len(columns[0]), bool)
    line = "".join(chr(97 + i) for i in ids)
    for turn, side in enumerate(("left", "right", "right", "left")):
        found = index.extend(found, side, every)
        columns, low, high, count = found
        for row in range(len(count)):
            phrase = "".join(chr(97 + c[row]) for c in columns)
            assert count[row] == sum(line.startswith(phrase, i) for i in range(len(line))) and "a" not in phrase
        if turn < 3:  # rows are ordered by 4 ids: intervals of up to 3 ids, and their neighbours, are whole
            assert len(set(low.tolist())) == len(low) == len(set(high.tolist()))
    assert len(columns) == 5


def test_planted_phrases_of_all_lengths(spark, monkeypatch):
    monkeypatch.setattr(collocations, "SHARD", 500)
    draw = random.Random(4)
    rows = []
    for i in range(400):
        some = draw.choices("abcdefghijklmno", k=draw.randint(0, 30))
        some += draw.choice([[], ["red", "hot", "iron", "bar"], ["red", "hot"], ["hot", "iron", ","], ["x", "x", "x", "x"]])
        rows.append((" ".join(some).replace(" f ", ". ").replace(" g ", "\r"), draw.choice(["en", "de", None, ""])))
    rows += [("the same line. the same line", "en")] * 30
    df = spark.createDataFrame(rows, "text string, lang string").repartition(7)
    for longest in (2, 3, 4, 5):
        assert got(collocations.collocations(df, longest=longest, least=4, top=40)) == brute(rows, longest, 4, 50, 40)


def test_odd_rows(spark):
    long = " ".join(f"w{i % 97}" for i in range(100_000))
    rows = [(None, "a"), ("", "a"), (" \t\n.,;", "a"), ("one", None), (long, "a"), (long, "a"), ("É ß İ " * 20, "und"), ("x" * 300_000, "b"), ("AB ab\x00c " * 15, None)]
    df = spark.createDataFrame(rows, "text string, lang string").withColumns({"f": F.lit("clash"), "w1": F.lit("clash"), "word": F.lit(1), "n": F.lit(2)})
    assert got(collocations.collocations(df)) == brute(rows)
    assert got(collocations.collocations(df.limit(0))) == []


def test_whole_table_by_sql(spark):
    sf_dir = "/root/testdata/sf0.001"
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    rows = sorted(db.execute(f"SELECT lang, rank, phrase, a, l, r, n, score FROM ({ORACLES['op11_collocations']})").fetchall())
    assert got(op11_collocations(spark, sf_dir)) == rows and rows
