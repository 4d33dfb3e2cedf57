"""The pipeline's stages, each on its own input, against brute force."""

import math
import re
import time
from collections import Counter, defaultdict
from pathlib import Path

import corpus_pipeline as pipeline
import pytest

from tapeweave.llm import shared
from tapeweave.llm.queries import tokenizer_path

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """Each stage's input and output, written and read again."""
    folder, out = tmp_path_factory.mktemp("stages"), {}
    df = spark.read.parquet(f"{SF}/documents.parquet")
    for k, (name, stage) in enumerate(pipeline.STAGES):
        stage(spark, df, SF).write.parquet(f"{folder}/{k}")
        done = spark.read.parquet(f"{folder}/{k}")
        out[name] = (df.collect(), done.collect())
        df = done
    return out


def test_order_and_columns(steps):
    assert list(steps) == ["quality rules", "line dedup", "n-gram Jaccard join", "mixing sources", "best-fit packing"]
    for name in list(steps)[:-1]:
        assert set(steps[name][1][0].asDict()) == set(pipeline.COLUMNS)


def test_quality_keeps_clean(spark, steps):
    before, after = steps["quality rules"]
    kept = {r["doc_id"] for r in after}
    texts = {r["doc_id"]: r["text"] for r in before}
    assert all(texts[r["doc_id"]] == r["text"] for r in after)
    good = [r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 1").collect()]
    long = [d for d in good if len(texts[d].split()) >= 60]
    assert sum(d in kept for d in long) / len(long) > 0.9


def test_lines(steps):
    before, after = steps["line dedup"]
    key = lambda line: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\f\r"))
    holders = defaultdict(set)
    for r in before:
        for line in r["text"].split("\n"):
            if len(key(line)) >= 20:
                holders[key(line)].add(r["doc_id"])
    expected = {r["doc_id"]: "\n".join(x for x in r["text"].split("\n") if len(holders[key(x)]) < 3 or r["doc_id"] == max(holders[key(x)])) for r in before}
    assert {r["doc_id"]: r["text"] for r in after} == expected
    assert all(r["n_chars"] == len(r["text"]) for r in after)


def test_near_copies(steps):
    before, after = steps["n-gram Jaccard join"]
    sets = {}
    for r in before:
        w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), r["text"]))
        sets[r["doc_id"]] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    group = {d: d for d in sets}

    def root(d):
        return d if group[d] == d else root(group[d])

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if sets[a] and sets[b] and 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                group[y] = x
    assert sorted(r["doc_id"] for r in after) == [d for d in ids if root(d) == d]


def test_mix(steps):
    before, after = steps["mixing sources"]
    copies = Counter(r["doc_id"] for r in after)
    assert max(copies.values()) <= 2 and set(copies) <= {r["doc_id"] for r in before}
    size = lambda rows: sum(len(r["text"].split()) for r in rows)
    assert abs(size(after) / size(before) - 1.5) < 0.1


def test_packing(steps):
    from tokenizers import Tokenizer

    before, after = steps["best-fit packing"]
    whole = Tokenizer.from_file(tokenizer_path())
    tokens = Counter()
    for r in before:
        tokens[r["doc_id"]] += len(whole.encode(r["text"], add_special_tokens=False).ids) + 1
    got, filled = Counter(), defaultdict(list)
    for r in after:
        got[r["doc_id"]] += r["length"]
        filled[r["sequence_id"]].append((r["offset"], r["length"]))
    assert got == tokens
    for places in filled.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(filled) <= math.ceil(sum(tokens.values()) / 2048) + 1


def test_run_gives_the_last_stage(spark, steps):
    rows = pipeline.run(spark, SF)
    pick = lambda r: (r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])
    assert Counter(map(pick, rows.collect())) == Counter(map(pick, steps["best-fit packing"][1]))


GOOD = " ".join(f"alpha{i} beta{i} gamma{i}" for i in range(40))
ODD = [(1, None, "a"), (2, "", None), (3, " \n ", "a"), (4, GOOD, "a"), (5, GOOD, "b"), (5, GOOD, "b"), (6, GOOD + " x", None), (None, GOOD, "a"), (7, "line of more than twenty chars\nown 7", "a"), (8, "line of more than twenty chars\nown 8", "a"), (9, "line of more than twenty chars", "a"), (10, " ".join(f"w{i % 5000}x" for i in range(40_000)), "b")]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(d, t, "en", s, len(t or "")) for d, t, s in ODD]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.selectExpr("*", "'!' as _id", "'!' as Text", "'!' as size", "'!' as kept", "'!' as _words", "1 as component_id")


def pairs(df):
    return Counter((r["doc_id"], r["text"]) for r in df.collect())


def test_stages_on_odd_rows(spark, odd):
    out = {name: stage(spark, odd, SF) for name, stage in pipeline.STAGES}
    for name in list(out)[:-1]:
        assert out[name].columns == list(pipeline.COLUMNS)
    assert pairs(out["quality rules"]) == Counter((d, t) for d, t, _ in ODD if t and len(t.split()) >= 50 and d != 10)
    lines = pairs(out["line dedup"])
    assert lines[7, "own 7"] == lines[8, "own 8"] == lines[9, "line of more than twenty chars"] == lines[1, ""] == lines[2, ""] == 1 and sum(lines.values()) == len(ODD)
    near = pairs(out["n-gram Jaccard join"])
    assert Counter(d for d, _ in near.elements()) == Counter([1, 2, 3, 4, None, 7, 8, 9, 10])
    mixed = Counter(r["doc_id"] for r in out["mixing sources"].collect())
    assert mixed and all(n <= 2 * sum(d == doc for d, _, _ in ODD) for doc, n in mixed.items())
    packed = out["best-fit packing"].collect()
    assert {(r["doc_id"], r["length"]) for r in packed if r["doc_id"] in (1, 2, 3)} == {(1, 1), (2, 1), (3, 1)}
    assert sum(r["piece"] == 0 for r in packed) == len(ODD)


def test_stages_on_empty_tables(spark, odd):
    for name, stage in pipeline.STAGES:
        assert stage(spark, odd.limit(0), SF).count() == 0, name


def tables(folder):
    return sorted(p.name.rsplit("-", 1)[0] for p in (folder / "tables").iterdir())


def test_run_leaves_the_last_stage_alone(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(shared, "shared_dir", lambda _: f"file://{tmp_path}")
    assert pipeline.run(spark, SF).count() > 0
    assert tables(tmp_path) == ["best-fit-packing"]
    assert pipeline.drop_near_copies(spark, spark.read.parquet(f"{SF}/documents.parquet"), SF).count() > 0
    assert tables(tmp_path) == ["best-fit-packing", "near-copies"]


def test_shuffle_files_go_with_their_query(spark, tmp_path, monkeypatch):
    """No garbage has to be collected by the driver for it."""
    monkeypatch.setattr(shared, "shared_dir", lambda _: f"file://{tmp_path}")
    folders = [Path(str(d)) for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()]
    shuffled = lambda: {f.name for d in folders for f in d.rglob("shuffle_*")}
    before = shuffled()
    shared.written(spark.range(10_000).repartition(4, "id"), "dealt")
    for _ in range(50):
        if shuffled() <= before:
            break
        time.sleep(0.2)
    assert shuffled() <= before
