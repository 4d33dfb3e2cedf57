"""License scans by diagonal voting over rolling word k-gram hashes."""

from __future__ import annotations

import re
from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import quoted, small_batches, small_side, written
from .textops import LOWER, rolling, text_chunks, word_hashes, words

#: Phrases whose every place counts, with their labels. Fixed values of the query's contract.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
#: Wordings whose close matches give labels beside those of the phrases. A parameter.
TEMPLATES = (
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
    (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software "
        "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense "
        "and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions "
        "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software "
        "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability "
        "fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable for any claim damages or "
        "other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or "
        "other dealings in the software",
        "mit",
    ),
    (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above "
        "copyright notice and this permission notice appear in all copies the software is provided as is and the author disclaims all warranties with "
        "regard to this software including all implied warranties of merchantability and fitness in no event shall the author be liable for any special "
        "direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract "
        "negligence or other tortious action arising out of or in connection with the use or performance of this software",
        "isc",
    ),
    ("this work is licensed under the gnu general public license version 3", "gpl-3.0"),
    ("licensed under cc by nc 4 0", "cc-by-nc-4.0"),
    ("licensed under cc by sa 4 0", "cc-by-sa-4.0"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl"),
)

_SEPARATORS = np.ones(256, bool)
_SEPARATORS[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
_LOWER = {upper: upper + 32 for upper in range(0x41, 0x5B)}


def _split(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, word hashes, first word of each row) of runs of rows."""
    for first, end, data, offsets in text_chunks(column):
        data = LOWER[data]
        starts, ends, rows = words(data, offsets, _SEPARATORS)
        yield first, end, word_hashes(data, starts, ends), rows


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, end, _, rows in _split(batch.column(1)):
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, end - first), pa.array(np.diff(rows), pa.int64())], ["_id", "n_words"])


def _grams(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, hashes, rows in _split(batch.column(1)):
                if len(hashes) < k:
                    continue
                grams = rolling(hashes, k)
                row = np.repeat(np.arange(end - first), np.diff(rows))[: len(grams)]
                place = np.arange(len(grams)) - rows[:-1][row]
                inside = np.arange(len(grams)) + k <= rows[1:][row]
                ids = batch.column(0).slice(first, end - first)
                for at in range(0, len(grams), 1 << 16):
                    s = slice(at, at + (1 << 16))
                    take = np.flatnonzero(inside[s]) + at
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(row[take])), pa.array(place[take], pa.int64()), pa.array(grams[take].view(np.int64))], ["_id", "_place", "_gram"])

    return run


def _verified(templates: list[list[str]], n_phrases: int, coverage: float):
    """Of each row's spans those that hold their template: (_id, _template, _start, _share)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, out = [], []
            for r, text in enumerate(batch.column(1).to_pylist()):
                own = _WORD.findall((text or "").translate(_LOWER))
                for span in batch.column(2)[r].as_py():
                    wanted, start = templates[span["_template"]], span["_start"]
                    here = own[start : start + span["_span"]]
                    if span["_template"] < n_phrases:
                        share = float(here == wanted)
                    else:
                        share = sum(b.size for b in SequenceMatcher(None, wanted, here, autojunk=False).get_matching_blocks()) / len(wanted)
                    if share >= coverage and share > 0:
                        rows.append(r), out.append((span["_template"], start, share))
            template, start, share = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(template, pa.int32()), pa.array(start, pa.int64()), pa.array(share, pa.float64())], ["_id", "_template", "_start", "_share"])

    return run


def template_grams(texts: tuple[tuple[str, str], ...], k: int) -> list[tuple[int, int, int]]:
    """(gram, template number, place) of every k-gram of the templates."""
    out = []
    for number, (text, _) in enumerate(texts):
        for _, _, hashes, _ in _split(pa.array([text])):
            out += [(int(g), number, place) for place, g in enumerate(rolling(hashes, k).view(np.int64))]
    return out


def license_scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", phrases: tuple[tuple[str, str], ...] = PHRASES, templates: tuple[tuple[str, str], ...] = TEMPLATES, k: int = 2, gap: int = 3, coverage: float = 0.8) -> DataFrame:
    """One row per document: id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    All rolling k-gram hashes of all texts meet the templates' k-grams (a fixed table, joined by
    broadcast). Hits vote for their diagonal, the place in the text less that in the template. A
    phrase may stand where its diagonal has every vote. For templates, neighbouring diagonals
    (up to `gap` apart, for words put in or left out) whose spans meet are merged; the merged span
    must cover at least `coverage` of the template's k-grams and be at most twice as long as the
    template. All spans are then verified on the texts' words: a phrase's word by word, a template's by
    the share of its words that stand in it in order, `coverage` at least. score is the best such
    share, 1 for a phrase, 0 without any label.

    Words are runs of a-z, 0-9 and non-ASCII characters, with A-Z in lower case. A null or empty
    text has no words. Rows that share an id are one document whose places are counted once for each
    place; null ids give rows without labels. first_word and last_word are null without a phrase. An
    empty table gives no rows; other columns of docs are not read, whatever their names.
    """
    spark = docs.sparkSession
    texts = (*phrases, *templates)
    lengths = [len(text.split()) for text, _ in texts]
    table = spark.createDataFrame(template_grams(texts, k), "_gram long, _template int, _at int")
    names = spark.createDataFrame([(i, label, lengths[i], i < len(phrases)) for i, (_, label) in enumerate(texts)], "_template int, _label string, _length int, _phrase boolean")
    small_batches(spark)
    narrow = docs.select(F.col(quoted(id_col)).alias("_id"), F.col(quoted(text_col)).cast("string").alias("_text"))
    id_type = narrow.schema["_id"].dataType.simpleString()
    counted = narrow.mapInArrow(_counted, f"_id {id_type}, n_words long")
    hits = narrow.filter(F.col("_id").isNotNull()).mapInArrow(_grams(k), f"_id {id_type}, _place long, _gram long").join(F.broadcast(table), "_gram")
    diagonals = hits.groupBy("_id", "_template", (F.col("_place") - F.col("_at")).alias("_diagonal")).agg(F.collect_set("_at").alias("_seen"), F.min("_place").alias("_from"), F.max("_place").alias("_to")).join(F.broadcast(names), "_template")
    diagonals = written(diagonals, "diagonals")  # read twice
    exact = diagonals.filter(F.col("_phrase") & (F.size("_seen") == F.col("_length") - (k - 1)))
    # runs of neighbouring diagonals whose spans are near each other
    order = Window.partitionBy("_id", "_template").orderBy("_from", "_diagonal")
    near = (F.col("_diagonal") - F.lag("_diagonal").over(order) > gap) | (F.col("_diagonal") - F.lag("_diagonal").over(order) < -gap) | (F.col("_from") - F.lag("_to").over(order) > gap + k)
    runs = diagonals.filter(~F.col("_phrase")).withColumn("_new", F.coalesce(near, F.lit(True)).cast("int")).withColumn("_run", F.sum("_new").over(order))
    merged = runs.groupBy("_id", "_template", "_run", "_label", "_length").agg(F.size(F.array_distinct(F.flatten(F.collect_list("_seen")))).alias("_votes"), F.min("_from").alias("_start"), (F.max("_to") - F.min("_from") + k).alias("_span"))
    merged = merged.withColumn("_share", F.col("_votes") / (F.col("_length") - (k - 1)))
    likely = merged.filter((F.col("_share") >= coverage) & (F.col("_span") <= F.col("_length") * 2))
    spans = exact.select("_id", "_template", F.col("_diagonal").alias("_start"), F.col("_length").cast("long").alias("_span")).unionByName(likely.select("_id", "_template", F.col("_start"), F.col("_span")))
    # spans of a document by the ten thousand places, so that a very long one's are not one list
    spans = written(spans.groupBy("_id", F.floor(F.col("_start") / 10_000)).agg(F.collect_list(F.struct("_template", "_start", "_span")).alias("_spans")).select("_id", "_spans"), "spans")
    texts_ = narrow.join(small_side(spans, spans.count(), 256), "_id")
    verified = texts_.select("_id", "_text", "_spans").mapInArrow(_verified([text.split() for text, _ in texts], len(phrases), coverage), f"_id {id_type}, _template int, _start long, _share double").distinct().join(F.broadcast(names), "_template")
    phrase = F.col("_phrase")
    found = verified.groupBy("_id").agg(F.count_if(phrase).alias("n_base"), F.min(F.when(phrase, F.col("_start"))).alias("first_word"), F.max(F.when(phrase, F.col("_start"))).alias("last_word"), F.collect_set(F.when(phrase, F.col("_label"))).alias("_base"), F.collect_set("_label").alias("_more"), F.max("_share").alias("_best"))
    out = counted.join(found, "_id", "left")
    none = F.array().cast("array<string>")
    joined = lambda *c: F.array_join(F.array_sort(F.array_distinct(F.concat(*[F.coalesce(x, none) for x in c]))), ",")
    return out.select(
        F.col("_id").alias(id_col), "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), F.col("first_word").cast("long").alias("first_word"), F.col("last_word").cast("long").alias("last_word"),
        joined("_base").alias("base_labels"), joined("_more").alias("labels"), F.coalesce("_best", F.lit(0.0)).alias("score"),
    )
