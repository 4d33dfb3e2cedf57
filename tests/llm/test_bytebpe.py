"""Byte-level BPE against the tokenizer library itself, and exact round trips."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
import tiktoken

from pyspark.sql import functions as F
from tapeweave.llm import bytebpe
from tapeweave.llm.queries import op13_byte_bpe, ranks_path
from tapeweave.llm.textops import text_chunks


@pytest.fixture(scope="module")
def ranks():
    return bytebpe.Ranks(ranks_path())


@pytest.fixture(scope="module")
def library(ranks):
    import public_tokenizers

    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks.ids, special_tokens={})


def encoded(encoder, texts):
    out = []
    for first, end, data, offsets in text_chunks(pa.array(texts, pa.string())):
        ids, _, rows = encoder.encode(data, offsets)
        out += [ids[rows[i] : rows[i + 1]].tolist() for i in range(end - first)]
    return out


def test_boundaries_and_merges(ranks, library):
    encoder = bytebpe.Encoder(ranks, bytebpe.codepoint_classes())
    draw = random.Random(7)
    some = ["'", "s", "t", "r", "e", "v", "l", "m", "d", " ", "  ", "\n", "\t", "a", "É", "1", "½", "!", "-", " ", "　", "漢", "😀", "́", "\x00", "\r\n", "ll", "re", "'ll", "'S"]
    texts = ["".join(draw.choice(some) for _ in range(draw.randint(0, n))) for n in (3, 8, 30, 300) for _ in range(2000)]
    texts += [None, "", "x" * 2000 + " " + "ab" * 1500, " " * 3000, "!" * 1000 + "é" * 900]
    assert encoded(encoder, texts) == [library.encode_ordinary(t or "") for t in texts]


def test_every_codepoint(ranks, library):
    encoder = bytebpe.Encoder(ranks, bytebpe.codepoint_classes())
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{c}1 {c}" for c in every[i : i + 200]) for i in range(0, len(every), 200)]
    assert encoded(encoder, texts) == [library.encode_ordinary(t) for t in texts]


def test_slices_that_share_a_hash(ranks, library):
    weak = lambda data, starts, ends: ((ends - starts) * 7 + data[starts]).astype(np.uint64) if len(starts) else np.zeros(0, np.uint64)
    encoder = bytebpe.Encoder(ranks, bytebpe.codepoint_classes(), weak)
    texts = ["the cat and the cot, the cut; 12 21", "thx ehx " * 20, "one two six ten"]
    assert encoded(encoder, texts) == [library.encode_ordinary(t) for t in texts]


def test_cache_starts_afresh(ranks, library, monkeypatch):
    monkeypatch.setattr(bytebpe, "CACHED", 50)
    encoder = bytebpe.Encoder(ranks, bytebpe.codepoint_classes())
    for n in range(5):
        texts = [" ".join(f"wo{n}rd{i}xyz" for i in range(80)) + "q" * 100]
        assert encoded(encoder, texts) == [library.encode_ordinary(t) for t in texts]


def test_parts_of_long_texts():
    data = np.frombuffer((" word" * 200_000).encode() + b"x" * 600_000 + b" y" * 10, np.uint8)
    parts = list(bytebpe._parts(data))
    assert parts[0][0] == 0 and parts[-1][1] == len(data) and all(a[1] == b[0] for a, b in zip(parts, parts[1:]))
    assert len(parts) > 3 and all(data[a] == 0x20 for a, _ in parts)


def digests(library, text):
    ids = library.encode_ordinary(text or "")
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def test_query_on_whole_table(spark, library):
    sf_dir = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in op13_byte_bpe(spark, sf_dir).collect()}
    assert got == {k: digests(library, t) for k, t in texts.items()}


def test_odd_rows(spark, library):
    long = " ".join(f"w{i % 977}é's" for i in range(150_000))
    rows = [(1, None), (2, ""), (None, "no id"), (3, "same"), (3, "same"), (4, long), (5, "x" * 700_000), (6, "'s't'll \n 'x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"ids": F.lit("clash"), "n_tokens": F.lit("clash"), "_text": F.lit(1)})
    out = bytebpe.decode(bytebpe.encode(docs, ranks_path()), ranks_path()).collect()
    got = sorted(((r["doc_id"] or 0, r["n_tokens"], hashlib.sha256(r["ids"]).hexdigest(), hashlib.sha256(r["decoded"]).hexdigest()) for r in out))
    assert got == sorted((i or 0, *digests(library, t)) for i, t in rows)
    ends = np.frombuffer(next(r["ends"] for r in out if r["doc_id"] == 4), "<u4")
    assert ends[-1] == len(long.encode()) and (np.diff(ends.astype(int)) > 0).all()
    assert bytebpe.decode(bytebpe.encode(docs.limit(0), ranks_path()), ranks_path()).count() == 0
