"""Ranked lexical search by the Best Position Algorithm over impact lists.

Documents are held in shards of a few thousand. A shard has a list of (impact, document) for every query
term, highest impact first. For an item all lists of its terms are read in step; each document met is
looked up in the others at once (direct access), so it counts as seen in all. A list's best position is
the end of its unbroken run of seen places: no unseen document has a higher impact there than the first
unseen place, however far reading has come. The impacts at these places sum up to the highest score that
an unseen document can have; reading stops once it is strictly below the k-th score so far, as an equal
one could still win by its id. The k best of a task go on to its next shard.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.window import Window

from .shared import quoted, small_batches, written
from .textops import LOWER, text_chunks, word_hashes, words

#: Terms of a block of items, about, and their bytes; each block of items is held against all documents.
BLOCK_TERMS, BLOCK_BYTES = 1 << 14, 4 << 20
#: Documents of a shard, at most, and cells of its table of places (terms x documents).
SHARD, CELLS = 4096, 1 << 25
#: Places of each list that are read first; each further step reads twice as many.
FIRST = 16
#: Lots in which the tasks' best are ranked before these meet.
LOTS = 64
_ABSENT = np.uint16(0xFFFF)

_SEPARATORS = np.ones(256, bool)
_SEPARATORS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


def _split(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes with A-Z lower-cased, starts, ends, first term of each row) of runs of rows."""
    for first, end, data, offsets in text_chunks(column):
        data = LOWER[data]
        yield first, end, data, *words(data, offsets, _SEPARATORS)


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, end, data, starts, ends, rows in _split(batch.column(1)):
            row = np.repeat(np.arange(first, end), np.diff(rows))
            terms = [data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), pa.array(terms, pa.string())], ["_item", "_term"])


class Vocabulary:
    """Terms by number, and the numbers of words that are among them, byte by byte."""

    def __init__(self, terms: list[str]):
        coded = [t.encode() for t in terms]
        self.lengths = np.array([len(t) for t in coded], np.int64)
        self.at = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(coded), np.uint8)
        hashes = word_hashes(self.bytes, self.at, self.at + self.lengths)
        self.order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[self.order]
        if (self.hashes[1:] == self.hashes[:-1]).any():
            raise ValueError("two query terms share a hash")

    def find(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(words that are terms, their terms' numbers)."""
        hashes = word_hashes(data, starts, ends)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        hit = np.flatnonzero(self.hashes[at] == hashes)
        number = self.order[at[hit]]
        length = ends[hit] - starts[hit]
        fits = length == self.lengths[number]
        hit, number, length = hit[fits], number[fits], length[fits]
        if not len(hit):
            return hit, number
        stops = np.cumsum(length)
        step = np.arange(stops[-1]) - np.repeat(stops - length, length)
        same = data[np.repeat(starts[hit], length) + step] == self.bytes[np.repeat(self.at[number], length) + step]
        same = np.logical_and.reduceat(same, stops - length)
        return hit[same], number[same]


def _postings(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        size = len(vocabulary.lengths)
        for batch in batches:
            for first, end, data, starts, ends, rows in _split(batch.column(1)):
                hit, number = vocabulary.find(data, starts, ends)
                row = np.searchsorted(rows, hit, "right") - 1
                key, times = np.unique(row * size + number, return_counts=True)
                cuts = pa.array(np.searchsorted(key, np.arange(end - first + 1) * size).astype(np.int32))
                lists = [pa.ListArray.from_arrays(cuts, pa.array(x)) for x in ((key % size).astype(np.int32), times.astype(np.int64))]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, end - first), pa.array(np.diff(rows), pa.int64()), *lists], ["_id", "_n", "_terms", "_tf"])

    return run


class Shard:
    """Impact lists of some documents: highest impact first, with every document's place in each list."""

    def __init__(self, ids: list, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, terms: int):
        self.ids = ids
        order = np.lexsort((-impact, term))
        self.docs, self.impacts = doc[order], impact[order]
        self.length = np.bincount(term, minlength=terms)
        self.start = np.cumsum(self.length) - self.length
        self.places = np.full((terms, len(ids)), _ABSENT, np.uint16)
        term = term[order]
        self.places[term, self.docs] = np.arange(len(term)) - self.start[term]

    def search(self, terms: np.ndarray, best: list[tuple], k: int) -> tuple[list[tuple], int]:
        """(the k best of `best` and this shard, (-score, id is null, id) in order; places read in each list)."""
        terms = terms[self.length[terms] > 0]
        start, length = self.start[terms][:, None], self.length[terms][:, None]
        seen = np.zeros(len(self.ids), bool)
        reached = np.zeros((len(terms), 1), np.int64)  # best positions: places up to here are seen
        depth, step, last = 0, FIRST, len(self.docs) - 1
        while len(terms):
            at = start + reached
            bound = int(np.where(reached < length, self.impacts[np.minimum(at, last)], 0).sum())
            if bound == 0 or (len(best) == k and bound < -best[-1][0]):
                break
            reading = depth + np.arange(step)
            found = self.docs[(start + reading)[reading < length]]  # sorted access
            fresh = np.unique(found[~seen[found]])
            seen[fresh] = True
            place = self.places[terms[:, None], fresh]  # direct access
            score = np.where(place != _ABSENT, self.impacts[np.minimum(start + place, last)], 0).sum(axis=0)
            take = np.arange(len(fresh)) if len(best) < k else np.flatnonzero(score >= -best[-1][0])
            if len(take) > k:  # ties with the k-th stay in
                take = take[score[take] >= np.partition(score[take], len(take) - k)[len(take) - k]]
            if len(take):
                best = sorted([*best, *((-s, self.ids[d] is None, self.ids[d]) for s, d in zip(score[take].tolist(), fresh[take].tolist(), strict=True))])[:k]
            depth += step
            step *= 2
            moved = np.arange(len(terms))
            while len(moved):  # past all that is seen
                ahead = reached[moved] + np.arange(step)
                run = (ahead < length[moved]) & seen[self.docs[np.minimum(start[moved] + ahead, last)]]
                whole = run.all(axis=1)
                reached[moved, 0] += np.where(whole, step, run.argmin(axis=1))
                moved = moved[whole]
        return best, depth


def _searched(shared, k: int, id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weights, n_docs, n_terms = shared.value
        room = max(64, min(SHARD, CELLS // len(weights)))
        best: list[list[tuple]] = [[] for _ in items]

        def search(rows: pa.RecordBatch) -> None:
            n = rows.column(1).to_numpy()
            m = 50 + 50 * n * n_docs // n_terms
            cuts = rows.column(2).offsets.to_numpy()
            term, tf = (rows.column(c).flatten().to_numpy().astype(np.int64) for c in (2, 3))
            doc = np.repeat(np.arange(len(n)), np.diff(cuts))
            impact = weights[term] * (1_000_000_000 * tf // (1000 * tf + 20 * m[doc]))
            some = impact > 0
            shard = Shard(rows.column(0).to_pylist(), doc[some], term[some], impact[some], len(weights))
            for i, terms in enumerate(items):
                best[i], _ = shard.search(terms, best[i], k)

        held, many = [], 0
        for batch in batches:
            held.append(batch)
            many += batch.num_rows
            while many >= room:
                whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                search(whole.slice(0, room))
                held, many = [whole.slice(room)], many - room
        if many:
            search(pa.Table.from_batches(held).combine_chunks().to_batches()[0])
        for i, found in enumerate(best):
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([i] * len(found), pa.int32()), pa.array([f[2] for f in found], id_type), pa.array([-f[0] for f in found], pa.int64())], ["_number", "_id", "score"])

    return run


def ranked_search(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", k: int = 50) -> DataFrame:
    """Each item's k documents of the highest score above 0: item id, rank (int, from 1), document id, score.

    Terms are runs of 0-9, A-Z, a-z and non-ASCII characters of whole texts, A-Z lower-cased. With N
    documents that have terms, L terms in all, n in a document, df documents holding a term and tf its
    places in one: w = floor(1000 ln((2N + 2) / (2 df + 1))), m = 50 + (50 n N div L), and a document's
    score sums w * (10^9 tf div (1000 tf + 20 m)) over an item's distinct terms. Equal scores go by
    ascending id, null ids last.

    A null or empty text has no terms; such documents and items have no rows. Rows that share a document
    id are documents of their own; rows that share an item id are one item of all their terms. Empty
    tables give no rows. Other columns are not read, whatever their names. Texts of any length count whole.

    Items are taken in blocks of about BLOCK_TERMS terms, which are broadcast; a block is held against
    all documents. Per block the documents' counts of its terms are written once, as lists; df is summed from them (a
    number for each term of the block goes to the driver). A task holds one shard, and the k best of each
    item of the block; its output doesn't grow with its input. Tasks' best are ranked in lots first.
    """
    spark = docs.sparkSession
    small_batches(spark)
    narrow = docs.select(F.col(quoted(id_col)).alias("_id"), F.col(quoted(text_col)).cast("string").alias("_text"))
    asked = items.select(F.col(quoted(item_col)).alias("_item"), F.col(quoted(item_text)).cast("string").alias("_text"))
    id_type, item_type = (df.schema[0].dataType.simpleString() for df in (narrow, asked))
    terms = written(asked.mapInArrow(_item_terms, f"_item {item_type}, _term string").distinct(), "item-terms")
    pairs, size = terms.agg(F.count("*"), F.sum(F.octet_length("_term"))).first()
    blocks = max(1, -(-pairs // BLOCK_TERMS), -(-(size or 0) // BLOCK_BYTES))
    out = None
    for block in range(blocks):
        own = terms.filter(F.pmod(F.xxhash64("_item"), F.lit(blocks)) == block).collect()
        found = _block(narrow, [(r["_item"], r["_term"]) for r in own], f"_number int, _item {item_type}", id_type, k)
        if found is not None:
            out = found if out is None else out.unionByName(found)
    if out is None:
        out = spark.createDataFrame([], f"_item {item_type}, rank int, _id {id_type}, score long")
    return out.select(F.col("_item").alias(item_col), "rank", F.col("_id").alias(id_col), "score")


def _block(narrow: DataFrame, pairs: list[tuple], names_schema: str, id_type: str, k: int) -> DataFrame | None:
    """(_item, rank, _id, score) of the items that stand in pairs of item and term; None without terms anywhere."""
    spark = narrow.sparkSession
    vocabulary = sorted({t for _, t in pairs})
    if not vocabulary:
        return None
    number = {t: i for i, t in enumerate(vocabulary)}
    by_item: dict = {}
    for item, term in pairs:
        by_item.setdefault(item, []).append(number[term])
    shared = spark.sparkContext.broadcast(Vocabulary(vocabulary))
    postings = written(narrow.mapInArrow(_postings(shared), f"_id {id_type}, _n long, _terms array<int>, _tf array<long>").filter("_n > 0"), "postings")
    n_docs, n_terms = postings.agg(F.count("*"), F.sum("_n")).first()
    if not n_docs:
        return None
    weights = np.zeros(len(vocabulary), np.int64)
    for r in postings.select(F.explode("_terms").alias("_term")).groupBy("_term").agg(F.count("*").alias("df")).collect():
        weights[r["_term"]] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * r["df"] + 1)))
    plan = spark.sparkContext.broadcast(([np.array(sorted(t), np.int64) for t in by_item.values()], weights, n_docs, n_terms))
    names = spark.createDataFrame(list(enumerate(by_item)), names_schema)
    arrow_id = to_arrow_type(narrow.schema["_id"].dataType)
    found = postings.filter(F.size("_terms") > 0).mapInArrow(_searched(plan, k, arrow_id), f"_number int, _id {id_type}, score long")
    order = [F.desc("score"), F.asc_nulls_last("_id")]
    found = found.withColumn("_lot", F.pmod(F.xxhash64("_id"), F.lit(LOTS)))
    first = found.withColumn("rank", F.row_number().over(Window.partitionBy("_number", "_lot").orderBy(*order))).filter(F.col("rank") <= k)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("_number").orderBy(*order))).filter(F.col("rank") <= k)
    return ranked.join(F.broadcast(names), "_number").select("_item", "rank", "_id", "score")
