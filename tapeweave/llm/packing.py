"""Best-fit packing of documents into sequences by bin completion."""

from __future__ import annotations

import logging
import os
import random
import re
import struct
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import quoted, small_batches, written

#: Entries of each generation of what a Python worker remembers.
REMEMBERED = 200_000
#: Steps of the search for a bin plan, and lengths that they may go over in all if that gives more steps.
NODES, WORK = 8_000, 6_000_000
#: Bins at the end of a plan in the making whose other fillings are kept for backtracking, so that memory is bounded.
KEPT = 100
#: Of a filling of up to so many lengths all subsets are tried for a length that could replace them; of others, ones and twos.
SUBSETS = 8
#: Lots that pieces of one length are ranked in.
LOTS = 4096


class Remembered(dict):
    """A function's values in two generations: when one is full, what it was not asked for again goes."""

    def __init__(self, compute, most: int):
        super().__init__()
        self.compute, self.most, self.old = compute, most, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class Encoder:
    """ids of whole texts: those of their white-space separated words, which a worker remembers.

    The tokenizer never joins across white space, so a text's ids are its words' ids in a row. A word
    of ASCII and the letters of Latin-1 is also cut here into the runs that the tokenizer cuts it into,
    so that equal runs of different words are tokenised once; other words go to the tokenizer whole.
    """

    #: Words whose normal form is their lower case, and the runs that they are cut into.
    plain = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]*")
    cut = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+|[0-9]|[^a-z0-9\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")

    def __init__(self, path: str, end_id: int, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.end = np.array([end_id], "<u4").tobytes()
        # bytes as characters: printable Latin-1 as it is, the others in their order from 256 on
        shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
        hidden = [b for b in range(256) if b not in set(shown)]
        self.letters = {b: chr(b) for b in shown} | {b: chr(256 + n) for n, b in enumerate(hidden)}
        self.runs, self.words = Remembered(self._run, remembered), Remembered(self._word, remembered)

    def _run(self, run: str) -> bytes:
        if not run.isascii():
            run = "".join(map(self.letters.__getitem__, run.encode()))
        ids = [t.id for t in self.model.tokenize(run)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _word(self, word: bytes) -> bytes:
        text = word.decode()
        if (text.isprintable() if text.isascii() else self.plain.fullmatch(text)) and "<|" not in text:  # special tokens are the tokenizer's matter
            return b"".join(map(self.runs.__getitem__, self.cut.findall(text.lower())))
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: bytes) -> bytes:
        """Little-endian 32-bit ids of the text and the closing id."""
        return b"".join(map(self.words.__getitem__, text.split())) + self.end


_encoders: dict[tuple[str, int], Encoder] = {}


def token_pieces(docs: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048, end_id: int = 0, remembered: int = REMEMBERED) -> DataFrame:
    """One row per piece: id, piece (from 0), start, length, ids_crc32. Null text: empty, one closing id."""
    small_batches(docs.sparkSession)
    narrow = docs.select(F.col(quoted(id_col)).alias("_id"), F.col(quoted(text_col)).cast("string").alias("_text"))
    id_type = narrow.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = (tokenizer_path, end_id, remembered)
        if key not in _encoders:  # workers are used again
            _encoders[key] = Encoder(*key)
        encoder = _encoders[key]
        for batch in batches:
            rows, piece, start, length, crc = [], [], [], [], []
            texts = batch.column(1)
            for r in range(batch.num_rows):
                ids = encoder.encode(texts[r].as_buffer().to_pybytes() if texts[r].is_valid else b"")
                for p, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append(r), piece.append(p), start.append(at // 4), length.append(len(part) // 4), crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())], ["_id", "piece", "start", "length", "ids_crc32"])

    return narrow.mapInArrow(run, f"_id {id_type}, piece int, start long, length long, ids_crc32 long")


def best_fit(histogram: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing of {length: count}, as (lengths, how many bins hold exactly these).

    Bins of the same content are one entry. Items of one length fill the fullest bins that they fit, each
    to the brim, so a length cuts at most one entry in pieces.
    """
    bins: list[tuple[int, tuple[int, ...], int]] = []  # (free, lengths, how many), least free first
    for n in sorted((n for n, c in histogram.items() if c), reverse=True):
        rest, at, new = histogram[n], bisect_left(bins, (n,)), []
        kept = bins[:at]
        for k, (free, lengths, many) in enumerate(bins[at:], at):
            if not rest:
                kept += bins[k:]
                break
            each = free // n
            full = min(many, rest // each)
            part = rest - full * each if full < many else 0  # fewer than fill a bin
            rest -= full * each + part
            new += [(free - each * n, lengths + (n,) * each, full)] * bool(full) + [(free - part * n, lengths + (n,) * part, 1)] * bool(part)
            if many > full + bool(part):
                kept.append((free, lengths, many - full - bool(part)))
        each = capacity // n
        full, part = divmod(rest, each)
        new += [(capacity - each * n, (n,) * each, full)] * bool(full) + [(capacity - part * n, (n,) * part, 1)] * bool(part)
        bins = sorted(kept + new)
    return [(lengths, many) for _, lengths, many in bins]


def _fillings(left: list[int], counts: dict[int, int], room: int, slack: int) -> Iterator[tuple[int, list[int]]]:
    """(waste, lengths) of all undominated fillings of `room` with waste up to `slack`, least waste first.

    left: the lengths at hand, longest first. A filling that leaves room for a further length is
    dominated by the one that takes it. Sums that each tail of `left` can reach are bits of a number,
    so no way is taken that does not end in a filling.
    """
    left = [n for n in left if n <= room]
    mask, reach = (1 << room + 1) - 1, [1]
    for n in reversed(left):
        sums, times, block = reach[-1], min(counts[n], room // n), 1
        while times:
            block = min(block, times)
            sums |= sums << n * block & mask
            times, block = times - block, block * 2
        reach.append(sums)
    reach.reverse()
    falling = [-n for n in left]
    for waste in range(min(slack, room) + 1):
        if not reach[0] >> room - waste & 1:
            continue
        small = left[bisect_left(falling, -waste) :]
        stack: list[tuple[int, int, tuple[int, ...]]] = [(0, room - waste, ())]
        while stack:
            at, need, taken = stack.pop()
            if not need:
                if all(taken.count(n) == counts[n] for n in small):
                    yield waste, list(taken)
                continue
            at = bisect_left(falling, -need, at)  # the longest that fits
            n = left[at]
            for t in range(min(counts[n], need // n) + 1):  # most copies on top
                if reach[at + 1] >> need - t * n & 1:
                    stack.append((at + 1, need - t * n, taken + (n,) * t))


def _dominated(taken: list[int], waste: int, spare: int) -> bool:
    """Whether a length not taken (a bit of `spare`) could stand in for some that are, and no worse.

    It holds at least as much as those that it replaces and still fits, so wherever it would have gone
    they can go instead (Martello and Toth's dominance).
    """
    sums: set[tuple[int, bool]] = set()  # (sum, of two or more)
    if len(taken) <= SUBSETS:
        for n in taken:
            sums |= {(n, False)} | {(n + s, True) for s, _ in sums}
    else:
        kinds = Counter(taken)
        sums = {(n, False) for n in kinds} | {(n + m, True) for n in kinds for m in kinds if n < m or (n == m and kinds[n] > 1)}
    return any(spare >> s & ((1 << waste + 1) - 1 if several else (1 << waste + 1) - 2) for s, several in sums)


def least_bins(histogram: dict[int, int], capacity: int) -> int:
    """No plan has fewer bins: lengths of over capacity - a have bins of their own, those of over half are apart,
    and what those down to a need beyond the room that these leave takes more bins; for each a."""
    lengths = sorted(n for n, c in histogram.items() if c)
    best = -(-sum(n * histogram[n] for n in lengths) // capacity)
    for a in [0, *(n for n in lengths if 2 * n <= capacity)]:
        alone = sum(histogram[n] for n in lengths if n > capacity - a)
        half = [n for n in lengths if 2 * n > capacity and n <= capacity - a]
        apart = sum(histogram[n] for n in half)
        room = apart * capacity - sum(n * histogram[n] for n in half)
        rest = sum(n * histogram[n] for n in lengths if a <= n and 2 * n <= capacity)
        best = max(best, alone + apart + max(0, -(-(rest - room) // capacity)))
    return best


def _complete(histogram: dict[int, int], capacity: int, bins: int, nodes: int, most_off: int | None = None) -> tuple[list[tuple[tuple[int, ...], int]] | None, int]:
    """(plan of at most so many bins or None, steps left: none if they ended the search).

    The longest length left is completed with each undominated filling that leaves no more waste than
    `bins` bins allow, as many times over as the counts allow and then fewer times, depth first with
    backtracking up to KEPT bins. What is left after some bins is not searched again with as much waste. most_off: turns
    off the first branches, at most; then nothing is remembered.
    """
    counts, key, allowed = dict(histogram), 0, bins * capacity - sum(n * c for n, c in histogram.items())
    draw = random.Random(capacity)
    sign = {n: draw.getrandbits(96) for n in sorted(histogram)}
    failed: dict[int, int] = {}

    def branches(waste: int) -> Iterator[tuple[tuple[int, ...], int, int]]:
        left = sorted((n for n, c in counts.items() if c), reverse=True)
        top = left[0]
        have = counts | {top: counts[top] - 1}
        spare = sum(1 << n for n in left if have[n])
        for free, taken in _fillings([n for n in left if have[n]], have, capacity - top, allowed - waste):
            used = Counter(taken)
            if free and _dominated(taken, free, spare - sum(1 << n for n, k in used.items() if have[n] == k)):
                yield (), 0, 0  # a step as well
                continue
            used[top] += 1
            for times in range(min(counts[n] // k for n, k in used.items()), 0, -1):
                yield (top, *taken), times, free * times

    plan: list[tuple[tuple[int, ...], int]] = []
    open_, at, lost, cut = [enumerate(branches(0))], [(0, 0)], 0, False  # at: (waste, turns off the first branches) so far
    while open_:
        if len(plan) == len(open_):  # back from below
            lengths, times = plan.pop()
            for n in lengths:
                counts[n] += times
                key -= sign[n] * times
            at.pop()
        waste, off = at[-1]
        turn, step = next(open_[-1], (0, None))
        if step is None or most_off is not None and off + turn > most_off:
            if most_off is None and len(open_) > lost:
                failed[key] = min(failed.get(key, waste), waste)
            open_.pop()
            lost = min(lost, len(open_))
            continue
        if not nodes:
            return None, 0
        nodes -= 1
        lengths, times, free = step
        if not times or waste + free > allowed:
            continue
        after = key + sum(sign[n] for n in lengths) * times
        if failed.get(after, waste + free + 1) <= waste + free:
            continue
        plan.append((lengths, times))
        at.append((waste + free, off + turn))
        key = after
        for n in lengths:
            counts[n] -= times
        if not any(counts.values()):
            return plan, nodes
        open_.append(enumerate(branches(waste + free)))
        if len(open_) - lost > KEPT:
            open_[lost], lost, cut = iter(()), lost + 1, True
    return None, 0 if cut else nodes


def bin_plan(histogram: dict[int, int], capacity: int, *, nodes: int | None = None) -> list[tuple[tuple[int, ...], int]]:
    """(lengths, how many bins hold exactly these): all items of {length: count} in few bins of `capacity`.

    Bin completion. The incumbent is best-fit decreasing; if it has as few bins as the lower bound, it is
    the plan. Else a plan of the bound's number of bins is searched for by branch and bound, with half
    of the `nodes` steps (NODES, or WORK by the number of lengths if that is more); a search that ends
    without one raises the bound. With the other half, plans better than the incumbent are searched for
    with 1, 2, 4, ... turns off the first branches. When the steps are used up the incumbent stands.
    """
    histogram = {n: c for n, c in histogram.items() if c}
    best, bins = best_fit(histogram, capacity), least_bins(histogram, capacity)
    count = lambda plan: sum(many for _, many in plan)
    nodes = max(NODES, WORK // (len(histogram) + 1)) if nodes is None else nodes
    left, turns = nodes // 2, 1
    while left and bins < count(best):
        plan, left = _complete(histogram, capacity, bins, left)
        if plan is not None:
            return plan
        bins += left > 0
    left = nodes // 2
    while left and turns <= len(histogram) and bins < count(best):
        plan, left = _complete(histogram, capacity, count(best) - 1, left, turns)
        best, turns = (best, turns * 2) if plan is None else (plan, turns)
    return best


def pack(pieces: DataFrame, *, capacity: int = 2048) -> DataFrame:
    """pieces (columns _id, piece, start, length, ...) with sequence_id and offset.

    The corpus is summed up by its histogram of lengths, at most `capacity` numbers at any size,
    which the bin plan is made of on the driver. Pieces take the plan's slots by their rank within
    their length: ranks run within (length, lot), on top of the lots' running counts, so a length
    that many pieces share is spread over tasks. Equal rows are interchangeable.
    """
    spark = pieces.sparkSession
    lot = F.pmod(F.xxhash64("_id", "piece"), F.lit(LOTS))
    pieces = pieces.withColumn("_lot", lot)
    counts = written(pieces.groupBy("length", "_lot").agg(F.count("*").alias("_n")), "pack-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    plan = bin_plan(histogram, capacity)
    logging.getLogger(__name__).info("%d sequences, at least %d", sum(many for _, many in plan), least_bins(histogram, capacity))
    taken: dict[int, int] = {}
    slots: dict[int, list[tuple[int, int, int, int]]] = {}
    sequence = 0
    for lengths, bins in plan:
        use: dict[int, tuple[int, int]] = {}
        at = 0
        for n in lengths:  # equal lengths stand side by side
            use[n] = (use[n][0], use[n][1] + 1) if n in use else (at, 1)
            at += n
        for n, (offset, k) in use.items():
            slots.setdefault(n, []).append((taken.get(n, 0), k, sequence, offset))
            taken[n] = taken.get(n, 0) + k * bins
        sequence += bins
    # by length, the steps that take it: a table bound by the plan, not by the corpus
    table = spark.createDataFrame(list(slots.items()), "length long, _slots array<struct<rank: long, each: long, sequence: long, offset: long>>")
    before = Window.partitionBy("length").orderBy("_lot").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    ranked = pieces.withColumn("_rank", F.row_number().over(Window.partitionBy("length", "_lot").orderBy("_id", "piece")) - 1)
    out = ranked.join(counts, ["length", "_lot"]).withColumn("_rank", F.col("_rank") + F.col("_before")).join(F.broadcast(table), "length")
    # the last step that begins at or before the rank, found by halving
    low, high = F.lit(0), F.size("_slots") - 1
    steps = max(1, max((len(s) for s in slots.values()), default=1).bit_length())
    state = F.struct(low.alias("a"), high.alias("b"))
    middle = lambda s: F.floor((s["a"] + s["b"] + 1) / 2).cast("int")
    fits = lambda s: F.element_at("_slots", middle(s) + 1)["rank"] <= F.col("_rank")
    found = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), state, lambda s, _: F.struct(F.when(fits(s), middle(s)).otherwise(s["a"]).alias("a"), F.when(fits(s), s["b"]).otherwise(F.greatest(middle(s) - 1, s["a"])).alias("b")))
    out = out.withColumn("_slot", F.element_at("_slots", found["a"] + 1)).withColumn("_in", F.col("_rank") - F.col("_slot.rank"))
    sequence_id = (F.col("_slot.sequence") + F.floor(F.col("_in") / F.col("_slot.each"))).cast("long")
    offset = (F.col("_slot.offset") + F.pmod("_in", F.col("_slot.each")) * F.col("length")).cast("long")
    return out.withColumns({"sequence_id": sequence_id, "offset": offset}).drop("_lot", "_slots", "_before", "_rank", "_slot", "_in")


def pack_documents(docs: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048, end_id: int = 0, remembered: int = REMEMBERED) -> DataFrame:
    """Pieces of all rows of docs, each with its place in a sequence of at most `capacity` tokens.

    Only documents longer than a sequence are cut. Rows with null ids, and rows that share an id, are
    documents of their own. No rows give no pieces. Other columns are not read, whatever their names; a very
    long text is tokenised whole, in one task. The tokenised pieces are written to the shared
    folder once, so that texts are not tokenised again. remembered: entries of each generation of the words that a worker
    remembers; fewer take less memory and more time.
    """
    pieces = written(token_pieces(docs, tokenizer_path, id_col=id_col, text_col=text_col, capacity=capacity, end_id=end_id, remembered=remembered), "pieces")
    out = pack(pieces, capacity=capacity)
    return out.select(F.col("_id").alias(id_col), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
