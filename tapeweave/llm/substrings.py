"""Substring dedup: a count-min prefilter, then exact grouping of the windows estimated as repeated."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import aside, at, small_batches, small_side, written
from .sketch import maybe_repeated, repeated_cells, width_for
from .textops import mix, rolling, rolling_long, text_chunks, word_hashes, words

#: Words of the short grams whose smallest in a window stands for the window in the sketch.
GRAM = 8


def _sliding(op, x: np.ndarray, n: int) -> np.ndarray:
    """op over every n values in a row, by doubling."""
    done = 1
    while done * 2 <= n:
        x = op(x[:-done], x[done:])
        done *= 2
    return op(x[: len(x) - (n - done)], x[n - done :]) if n > done else x


def _windows(data: np.ndarray, offsets: np.ndarray, window: int):
    """(word hashes, first word of each row, valid starts, anchor of each start, gram hashes)."""
    starts, ends, rows = words(data, offsets)
    hashes = word_hashes(data, starts, ends)
    n = len(hashes) - window + 1
    if n <= 0:
        return hashes, rows, np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    gram = min(GRAM, window)
    grams = rolling(hashes, gram)
    anchors = _sliding(np.minimum, grams, window - gram + 1)
    valid = np.zeros(n, bool)
    for a, b in zip(rows[:-1], rows[1:], strict=True):
        if b - a >= window:
            valid[a : b - window + 1] = True
    return hashes, rows, np.flatnonzero(valid), anchors, grams


def _anchor_keys(window: int):
    """The grams that are the smallest of some window, once for each place that they stand at.

    Two windows of the same words hold the same smallest gram at two places, so a window whose
    smallest gram is counted once is not repeated. Few places hold such grams.
    """

    def keys(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for _, _, data, offsets in text_chunks(batch.column(0)):
            _, _, valid, anchors, grams = _windows(data, offsets, window)
            if len(valid):
                smallest = np.zeros(len(anchors), np.uint64)
                smallest[valid] = anchors[valid]
                span = len(grams) - len(anchors) + 1
                padded = np.concatenate([np.zeros(span - 1, np.uint64), smallest, np.zeros(span - 1, np.uint64)])
                yield grams[_sliding(np.maximum, padded, span) == grams]

    return keys


def _copies(digests: DataFrame) -> DataFrame:
    """(_id, _digest, _first) of rows whose digest others share; a group is counted before the shuffle."""
    groups = digests.groupBy("_digest").agg(F.count("*").alias("_n"), F.min("_id").alias("_first")).filter("_n > 1").drop("_n")
    return digests.join(groups, "_digest").select("_id", "_digest", "_first").distinct()


def substring_dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = 35, hash_bits: int = 64) -> DataFrame:
    """docs with n_words, n_removed and text_col without the words of repeated windows.

    A window is `window` words in a row of one document; words are runs of anything but ASCII white
    space, unchanged. A word goes if a window over it has the same words as a window that starts
    anywhere else, in the same document or another. Texts that lose words keep the others joined by
    one space; so do those that lose none. Null and empty texts become empty. Rows that share an id
    are told apart by their place in the input only if the ids are unique: a row with a repeated id
    loses what any row of that id loses. Rows with null ids keep their words (as joined), and count.

    Of rows with equal texts the one of the smallest id stands for all: its windows count twice, and
    all of the group lose every word that a window covers. First pass: the anchors of all windows are counted in a merged sketch, which only overestimates.
    Second pass: windows with a repeated anchor are grouped by a hash of hash_bits bits; the rest are not moved. Groups
    are held against a second hash of 64 bits, and those that it tells apart are grouped by both. A
    window that a third of all rows hold is counted before the shuffle. Columns of any other names are
    left as they are; an empty table stays empty.
    """
    small_batches(docs.sparkSession)
    cols, kept = aside(docs, "n_words", "n_removed")
    key, text_ = at(docs, id_col), at(docs, text_col)
    narrow = cols.select(F.col(key).alias("_id"), F.col(text_).cast("string").alias("_text"))
    id_type = narrow.schema["_id"].dataType.simpleString()
    size = narrow.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    width = width_for(size // 60)  # about one anchor in 11 words
    bitmaps = repeated_cells(narrow.select("_text"), _anchor_keys(window), width=width)

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in text_chunks(batch.column(1)):
                hashes, rows, valid, anchors, _ = _windows(data, offsets, window)
                if not len(valid):
                    continue
                # neighbours share their anchor: each run is looked up once
                values = anchors[valid]
                change = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
                known = maybe_repeated(bitmaps.value, values[change], width)
                take = valid[np.repeat(known, np.diff(np.append(change, len(values))))]
                whole, again = rolling_long(hashes, window) >> np.uint64(64 - hash_bits), rolling_long(mix(hashes ^ np.uint64(0x2545F4914F6CDD1D)), window)
                row = np.searchsorted(rows, take, "right") - 1
                ids, copied = batch.column(0).slice(first, end - first), batch.column(2).slice(first, end - first)
                for at in range(0, len(take), 1 << 16):
                    s = slice(at, at + (1 << 16))
                    yield pa.RecordBatch.from_arrays([ids.take(at_row := pa.array(row[s])), copied.take(at_row), pa.array((take[s] - rows[row[s]]).astype(np.int32)), pa.array(whole[take[s]].view(np.int64)), pa.array(again[take[s]].view(np.int64))], ["_id", "_copied", "_place", "_window", "_check"])

    digest = F.md5(F.coalesce(F.col("_text"), F.lit("")))
    copies = written(_copies(narrow.filter(F.col("_id").isNotNull()).select("_id", digest.alias("_digest"))), "copies")
    n_copies = copies.count()
    marks = copies.withColumnsRenamed({"_id": "_same", "_digest": "_d"})
    own = narrow.withColumn("_digest", digest).join(small_side(marks, n_copies, 96), (F.col("_id") == F.col("_same")) & (F.col("_digest") == F.col("_d")), "left")
    own = own.filter(F.col("_first").isNull() | (F.col("_first") == F.col("_id"))).select("_id", "_text", F.col("_first").isNotNull().alias("_copied"))
    found = own.mapInArrow(candidates, f"_id {id_type}, _copied boolean, _place int, _window long, _check long")
    groups = lambda rows, *by: rows.groupBy(*by).agg(F.count("*").alias("_n"), F.max("_copied").alias("_any"), F.min("_check").alias("_low"), F.max("_check").alias("_high")).filter("_n > 1 or _any")
    repeated = written(groups(found, "_window").select("_window", F.when(F.col("_low") == F.col("_high"), F.col("_low")).alias("_check")), "windows")
    n_repeated, n_told = repeated.agg(F.count("*"), F.count("_check")).first()
    if n_told < n_repeated:  # windows whose hash other words share
        mixed = found.join(repeated.filter("_check is null").select("_window"), "_window", "left_semi")
        repeated = written(repeated.filter("_check is not null").unionByName(groups(mixed, "_window", "_check").select("_window", "_check")), "windows")
    # sent to the places while small; beyond that both are shuffled, and Spark splits what one common window fills
    places = found.filter(F.col("_id").isNotNull() & ~F.col("_copied"))
    if n_told < n_repeated:
        places = places.join(small_side(repeated, n_repeated), ["_window", "_check"])
    else:
        places = places.drop("_check").join(small_side(repeated.select("_window"), n_repeated), "_window")
    places = places.groupBy("_id").agg(F.collect_set("_place").alias("_places"))

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, n_words, n_removed = [], [], []
            column, hits, copied = (batch.column(batch.num_columns - k) for k in (3, 2, 1))
            for r in range(batch.num_rows):
                own = column[r].as_buffer().to_pybytes().split() if column[r].is_valid else []
                gone = 0
                n_words.append(len(own))
                if copied[r].is_valid and len(own) >= window:
                    gone, own = len(own), []
                elif hits[r].is_valid:
                    edge = np.zeros(len(own) + window + 1, np.int32)
                    at = hits[r].values.to_numpy(zero_copy_only=False)
                    at = at[at + window <= len(own)]
                    edge[at] += 1
                    edge[at + window] -= 1
                    stay = np.cumsum(edge[: len(own)]) == 0
                    gone = len(own) - int(stay.sum())
                    own = list(compress(own, stay.tolist()))
                n_removed.append(gone)
                text.append(b" ".join(own).decode())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-3], pa.array(text, pa.string()), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())], names=out_names)

    rest = [(c, name) for c, name in kept if c != text_]
    types = {f.name: f.dataType.simpleString() for f in cols.schema}
    out_names = [*(c for c, _ in rest), text_, "n_words", "n_removed"]
    joined = cols.join(places.withColumnRenamed("_id", "_other"), F.col(key) == F.col("_other"), "left")
    joined = joined.withColumn("_digest", F.md5(F.coalesce(F.col(text_).cast("string"), F.lit("")))).join(small_side(marks, n_copies, 96), (F.col(key) == F.col("_same")) & (F.col("_digest") == F.col("_d")), "left")
    whole = joined.select(*(c for c, _ in rest), F.col(text_).cast("string"), "_places", F.when(F.col("_first").isNotNull(), True).alias("_copied"))
    out = whole.mapInArrow(strip, ", ".join(f"{c} {t}" for c, t in [*((c, types[c]) for c, _ in rest), (text_, "string"), ("n_words", "long"), ("n_removed", "long")]))
    return out.select(*[F.col(c).alias(name) for c, name in kept], "n_words", "n_removed")
