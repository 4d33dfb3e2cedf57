"""Phrase collocation mining with a bidirectional FM-index over word ids in each shard.

A shard is some texts of one language: pieces of word ids joined by 0. Its index has the BWT of the ids and
that of the ids reversed. A phrase is an interval of rows in both; the symbols before its rows are its left
extensions with their counts, and in the reversed index the right ones. An extension's interval in the other
index follows from the counts of smaller symbols. Phrases of a level are extended all at once, left and right
in turns, and only by phrases that are frequent over all shards, as counted at the levels before.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import quoted, small_batches, small_side, written
from .sketch import maybe_repeated, repeated_cells, width_for
from .textops import LOWER, mix, text_chunks, word_hashes, words

#: Words of a shard, about; a longer text is a shard of its own.
SHARD = 1 << 19
#: Bytes of texts whose words are counted at a time.
CHUNK = 2 << 20
#: Lots in which a language's phrases are ranked before the best of these meet.
LOTS = 512

_CUTS = np.zeros(256, bool)
_CUTS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_SEPARATORS = _CUTS.copy()
_SEPARATORS[[0x20, 0x09]] = True
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _split(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes with A-Z lower-cased, starts, ends, whether a word opens a piece, row of each word) of runs of rows."""
    for first, end, data, offsets in text_chunks(column, CHUNK):
        data = LOWER[data]
        starts, ends, rows = words(data, offsets, _SEPARATORS)
        cuts = np.cumsum(_CUTS[data])[starts] if len(starts) else starts
        opens = np.empty(len(starts), bool)
        opens[:1] = True
        opens[1:] = cuts[1:] != cuts[:-1]
        opens[rows[:-1][rows[:-1] < len(starts)]] = True
        yield data, starts, ends, opens, np.repeat(np.arange(first, end), np.diff(rows))


def _seeds(column: pa.Array) -> np.ndarray:
    """A number for each row's language, by the language's name alone."""
    codes = column.dictionary_encode()
    names = [n.encode() for n in codes.dictionary.to_pylist()]
    ends = np.cumsum([len(n) for n in names])
    hashes = word_hashes(np.frombuffer(b"".join(names), np.uint8), ends - [len(n) for n in names], ends) if names else np.zeros(0, np.uint64)
    return mix(hashes + _MULTIPLIER)[codes.indices.to_numpy()]  # other than the number of a word that is the language's name


def phrase_keys(columns: list[np.ndarray]) -> np.ndarray:
    """A number for each phrase, of its words' numbers; a word alone is its own."""
    return reduce(lambda key, word: mix(key * _MULTIPLIER + word), columns)


def _counted_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of a batch with their counts by language."""
    for batch in batches:
        by_row = _seeds(batch.column(0))
        for data, starts, ends, _, row in _split(batch.column(1)):
            if not len(starts):
                continue
            keys, first, count = np.unique(mix(word_hashes(data, starts, ends) ^ by_row[row]), return_index=True, return_counts=True)
            size = ends[first] - starts[first]
            stops = np.cumsum(size)
            text = data[np.repeat(starts[first] - stops + size, size) + np.arange(stops[-1])]
            found = pa.StringArray.from_buffers(len(first), pa.py_buffer(np.append(0, stops).astype(np.int32)), pa.py_buffer(text))
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), batch.column(0).take(pa.array(row[first])), found, pa.array(count)], ["w1", "lang", "word", "f"])


class ShardIndex:
    """FM-index of ids and of the ids reversed; 0 stands between pieces. Rows are ordered by their first `depth` ids."""

    def __init__(self, ids: np.ndarray, depth: int):
        self.ids, self.depth = ids, depth
        self.size = int(ids.max(initial=0)) + 1
        self.counts = np.bincount(ids, minlength=self.size)
        self.first = np.cumsum(self.counts) - self.counts  # where each id's interval starts, in either index

    def _bwt(self, ids: np.ndarray) -> np.ndarray:
        key, span = ids, self.size
        for k in range(1, self.depth):
            if span > (1 << 62) // self.size:
                key = np.unique(key, return_inverse=True)[1]
                span = int(key.max()) + 1
            key, span = key * self.size + np.roll(ids, -k), span * self.size
        return np.roll(ids, 1)[np.argsort(key)]

    @cached_property
    def left(self) -> np.ndarray:
        """The id before each row."""
        return self._bwt(self.ids)

    @cached_property
    def right(self) -> np.ndarray:
        """The id after each row of the index of the ids reversed."""
        return self._bwt(self.ids[::-1])

    def _ranks(self, bwt: np.ndarray) -> np.ndarray:
        """For each row how often its symbol stands in earlier rows."""
        rank = np.empty(len(bwt), np.int64)
        order = np.argsort(bwt, kind="stable")
        rank[order] = np.arange(len(bwt)) - self.first[bwt[order]]
        return rank

    @cached_property
    def ranks(self) -> dict[str, np.ndarray]:
        return {"left": self._ranks(self.left), "right": self._ranks(self.right)}

    def words(self) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
        """Phrases of one word: (their words, interval starts in both indexes, counts)."""
        some = np.flatnonzero(self.counts[1:]) + 1
        return [some], self.first[some], self.first[some], self.counts[some]

    def extend(self, phrases: tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray], side: str, keep, *, both: bool = True) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
        """Phrases with one more word on the left or right, those that keep(columns of words) holds, with their counts.

        both=False: only the interval for the next extension on the other side is needed, not that on this side.
        """
        columns, here, other, count = phrases if side == "left" else (phrases[0], phrases[2], phrases[1], phrases[3])
        bwt = self.left if side == "left" else self.right
        owner = np.repeat(np.arange(len(count)), count)
        rows = here[owner] + np.arange(len(owner)) - (np.cumsum(count) - count)[owner]
        key = owner * self.size + bwt[rows]
        order = np.argsort(key, kind="stable") if both else None
        key = key[order] if both else np.sort(key)
        heads = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        many = np.diff(np.append(heads, len(key)))
        whose, symbol = key[heads] // self.size, key[heads] % self.size
        smaller = heads - (np.cumsum(count) - count)[whose]  # rows of the owner with smaller symbols come first in the other index
        new = [c[whose] for c in columns]
        new = [symbol, *new] if side == "left" else [*new, symbol]
        stay = np.flatnonzero(symbol > 0)
        stay = stay[keep([c[stay] for c in new])]
        there = other[whose[stay]] + smaller[stay]
        at = self.first[symbol[stay]] + self.ranks[side][rows[order[heads[stay]]]] if both else np.zeros(len(stay), np.int64)
        pair = (at, there) if side == "left" else (there, at)
        return [c[stay] for c in new], *pair, many[stay]


def _phrases(level: int, sketches: list[tuple[Broadcast, int]]):
    """(w1, ..., f): the phrases of `level` words of each shard that may be frequent, with their counts there.

    sketches: of the frequent phrases of 1, 2, ... words. A phrase is left out only if a part of it is not frequent.
    """

    def frequent(columns: list[np.ndarray]) -> np.ndarray:
        bits, width = sketches[len(columns) - 1]
        return maybe_repeated(bits.value, phrase_keys(columns), width)

    def enumerate_(parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        keys, ids = np.unique(np.concatenate(parts), return_inverse=True)  # 0 is the separator's key
        index = ShardIndex(ids, max(1, level - 1))

        def keep(columns: list[np.ndarray]) -> np.ndarray:
            hashed = [keys[c] for c in columns]
            if len(hashed) < level:
                return frequent(hashed)
            return frequent(hashed[:-1]) & frequent(hashed[1:]) if level > 2 else np.ones(len(hashed[0]), bool)

        found = index.words()
        for turn in range(level - 1):
            found = index.extend(found, "right" if turn % 2 else "left", keep, both=turn + 3 < level)
        for a in range(0, len(found[3]), 1 << 16):
            s = slice(a, a + (1 << 16))
            yield pa.RecordBatch.from_arrays([*(pa.array(keys[c[s]].view(np.int64)) for c in found[0]), pa.array(found[3][s])], [*(f"w{i + 1}" for i in range(level)), "f"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[np.ndarray]] = {}
        many: dict[str, int] = {}
        for batch in batches:
            by_row = _seeds(batch.column(0))
            codes = batch.column(0).dictionary_encode()
            names, code = codes.dictionary.to_pylist(), codes.indices.to_numpy()
            for data, starts, ends, opens, row in _split(batch.column(1)):
                hashes = mix(word_hashes(data, starts, ends) ^ by_row[row])
                hashes[~frequent([hashes])] = 0  # no frequent phrase has it
                lang = code[row]
                for c in np.unique(lang).tolist():
                    own = np.flatnonzero(lang == c)
                    some = np.insert(hashes[own], np.flatnonzero(opens[own]), np.uint64(0))
                    some = some[np.concatenate([[True], (some[1:] != 0) | (some[:-1] != 0)])]
                    held.setdefault(names[c], []).append(some)
                    many[names[c]] = many.get(names[c], 0) + len(some)
                full = list(many) if sum(many.values()) >= 4 * SHARD else [n for n, k in many.items() if k >= SHARD]
                for name in full:
                    del many[name]
                    yield from enumerate_([*held.pop(name), np.zeros(1, np.uint64)])
        for parts in held.values():
            yield from enumerate_([*parts, np.zeros(1, np.uint64)])

    return run


def _sketched(frequent: DataFrame, level: int, rows: int) -> tuple[Broadcast, int]:
    """A sketch of bounded size that knows all frequent phrases, and few others."""
    width = width_for(4 * rows)

    def keys(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        some = phrase_keys([batch.column(i).to_numpy().view(np.uint64) for i in range(level)])
        yield some
        yield some  # counted twice: repeated

    return repeated_cells(frequent.select(*(f"w{i + 1}" for i in range(level))), keys, width=width), width


def collocations(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", longest: int = 3, least: int = 10, cover: int = 50, top: int = 2000) -> DataFrame:
    """Each language's first `top` phrases of 2 to `longest` words: lang, rank, phrase, a, l, r, n, score, all long but lang and phrase.

    Texts are lower-cased in A-Z and split at . , ; : ! ? and line ends into pieces, these at blanks and
    tabs into words; phrases lie within pieces. Per language (null: `und`) n counts words, a the phrase's
    places; a phrase with a >= least is a candidate. Cut after its first k words it scores
    floor(1000000 a a / (l r)), l and r being the counts of its parts; the lowest-scoring cut counts, the first of
    equals. Candidates that lie within a longer candidate with 100 f(longer) >= cover * a are dropped. Order: score and
    a descending, phrase ascending by its bytes.

    Null and empty texts have no words. Repeated rows count as often as they stand there. An empty table
    gives no rows; other columns are not read, whatever their names. Texts of any length count whole: a shard
    ends after SHARD words, or with the text that passes that.

    Every shard gives all its phrases whose parts of one word less are frequent over all shards (by sketches of
    bounded size that never miss one), whatever their count there; counts are summed by phrase. A hot phrase is
    one row of each shard. Words are 64-bit numbers until the end; were two words to share one, that is found in the
    table of all words, and an error says so.
    """
    spark = docs.sparkSession
    small_batches(spark)
    narrow = docs.select(F.coalesce(F.col(quoted(lang_col)).cast("string"), F.lit("und")).alias("_lang"), F.col(quoted(text_col)).cast("string").alias("_text")).filter(F.octet_length("_text") > 0)
    every = written(narrow.mapInArrow(_counted_words, "w1 long, lang string, word string, f long").groupBy("w1", "lang", "word").agg(F.sum("f").alias("f")), "all-words")
    if every.groupBy("w1").count().filter("count > 1 or w1 = 0").limit(1).count():
        raise ValueError("two words share a number, or one has that of the separator")
    totals = every.groupBy("lang").agg(F.sum("f").alias("n"))
    levels = [written(every.filter(F.col("f") >= least), "words")]
    rows = [levels[0].count()]
    sketches: list[tuple[Broadcast, int]] = []
    for level in range(2, longest + 1):
        sketches.append(_sketched(levels[-1], level - 1, rows[-1]))
        names = [f"w{i + 1}" for i in range(level)]
        found = narrow.mapInArrow(_phrases(level, sketches), ", ".join(f"{c} long" for c in names) + ", f long")
        levels.append(written(found.groupBy(*names).agg(F.sum("f").alias("f")).filter(F.col("f") >= least), f"phrases-{level}"))
        rows.append(levels[-1].count())

    def counted(part: list[str], name: str) -> DataFrame:
        """The counts of phrases that stand in columns `part`, under that name."""
        k = len(part)
        own = levels[k - 1].select(*[F.col(f"w{i + 1}").alias(c) for i, c in enumerate(part)], F.col("f").alias(name))
        return small_side(own, rows[k - 1], 8 * (k + 1) + 16)

    texts = small_side(levels[0].select("w1", "lang", "word"), rows[0], 96)
    candidates = []
    for level in range(2, longest + 1):
        names = [f"w{i + 1}" for i in range(level)]
        out = levels[level - 1].withColumnRenamed("f", "a")
        if level < longest:
            longer = [levels[m - 1].select(*[F.col(f"w{i + 1}").alias(c) for i, c in zip(range(at, at + level), names, strict=True)], "f") for m in range(level + 1, longest + 1) for at in range(m - level + 1)]
            most = reduce(DataFrame.unionByName, longer).groupBy(*names).agg(F.max("f").alias("_most"))
            out = out.join(most, names, "left").filter(F.coalesce(F.col("_most") * 100 < F.col("a") * cover, F.lit(True))).drop("_most")
        for k in range(1, level):
            out = out.join(counted(names[:k], f"_l{k}"), names[:k]).join(counted(names[k:], f"_r{k}"), names[k:])
        wide = "cast({} as decimal(19,0))".format
        score = lambda k: F.expr(f"(cast(1000000 as decimal(7,0)) * ({wide('a')} * {wide('a')})) div ({wide(f'_l{k}')} * {wide(f'_r{k}')})")
        out = out.withColumns({f"_s{k}": score(k) for k in range(1, level)})
        best = F.array_min(F.array(*[F.struct(F.col(f"_s{k}").alias("score"), F.lit(k).alias("k"), F.col(f"_l{k}").alias("l"), F.col(f"_r{k}").alias("r")) for k in range(1, level)]))
        out = out.select(*names, "a", best.alias("_best"))
        for i, c in enumerate(names):
            own = texts.withColumnsRenamed({"w1": c, "word": f"_t{i}"})
            out = out.join(own if i == 0 else own.drop("lang"), c)
        candidates.append(out.select("lang", F.concat_ws(" ", *[f"_t{i}" for i in range(level)]).alias("phrase"), "a", "_best.l", "_best.r", "_best.score"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    found = reduce(DataFrame.unionByName, candidates).withColumn("_lot", F.pmod(F.xxhash64("phrase"), F.lit(LOTS)))
    first = found.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_lot").orderBy(*order))).filter(F.col("rank") <= top)
    first = written(first, "ranked")  # read twice
    # where every lot has so many phrases of a score or a better one, no lower score is among the top
    each = -(-top // LOTS)
    bounds = first.filter(F.col("rank") == each).groupBy("lang").agg(F.min("score").alias("_least"), F.count("*").alias("_lots")).filter(F.col("_lots") == LOTS)
    bounds = written(bounds.drop("_lots"), "bounds")
    first = first.join(small_side(bounds, bounds.count(), 64), "lang", "left").filter(F.coalesce(F.col("score") >= F.col("_least"), F.lit(True)))
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
