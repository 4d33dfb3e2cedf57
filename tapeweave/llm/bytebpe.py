"""Byte-level BPE encoding and decoding: vectorised pre-tokenisation, cached pair merging, offsets for decoding.

Texts are cut where the pattern of public_tokenizers (contractions, words, numbers, other runs, each with
a space before it, and white space) ends a match. Every codepoint has a class, every class is a transition
function of a small automaton, and functions compose associatively: an inclusive scan over the ids of
their compositions gives the automaton's state after every codepoint, over all rows of a buffer at once.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import quoted, small_batches
from .textops import text_chunks, word_hashes

#: Bytes of text handled at a time; a longer text is cut before white space where it can be.
CHUNK = 1 << 18
#: Slices that a worker remembers before it starts afresh, and the bytes of the longest one remembered.
CACHED, CACHED_BYTES = 1 << 18, 64
#: Slices of more bytes are merged by a heap, shorter ones all at once.
LONG = 512

OTHER, LETTER, NUMBER, SPACE, WHITE, QUOTE, STMD, RV, ELL, E = range(10)
#: States: start of a text, in a word, number or other run, after a space or other white space, after a
#: quote that may begin a contraction, after 'r or 'v, after 'l, after a whole contraction.
START, WORD, DIGITS, RUN, BLANK, GAP, OPEN, OPEN_RV, OPEN_L, DONE = range(10)
_STATES = 10
_NONE = np.int64(1 << 40)


def _next(state: int, cls: int) -> int:
    if cls == NUMBER:
        return DIGITS
    if cls == SPACE:
        return BLANK
    if cls == WHITE:
        return GAP
    if cls == OTHER:
        return RUN
    if cls == QUOTE:
        return RUN if state in (BLANK, RUN, OPEN) else OPEN
    if state == OPEN and cls in (STMD, RV, ELL):
        return {STMD: DONE, RV: OPEN_RV, ELL: OPEN_L}[cls]
    return DONE if (state, cls) in ((OPEN_RV, E), (OPEN_L, ELL)) else WORD


@lru_cache(maxsize=1)
def _functions() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(id of each class's function, and of the same at the start of a text; composition of ids, left one first; the one state of constant functions, else -1)."""
    made = [tuple(_next(s, c) for s in range(_STATES)) for c in range(10)]
    made += [(_next(START, c),) * _STATES for c in range(10)]
    ids: dict[tuple, int] = {}
    first = [ids.setdefault(f, len(ids)) for f in made]
    known, at = list(ids), 0
    while at < len(known):  # all compositions of the functions
        for g in made:
            both = tuple(g[s] for s in known[at])
            if both not in ids:
                ids[both] = len(ids)
                known.append(both)
        at += 1
    compose = np.array([[ids[tuple(g[s] for s in f)] for g in known] for f in known], np.uint16)
    return np.array(first, np.uint16), compose, np.array([f[0] if len(set(f)) == 1 else -1 for f in known], np.int8)


@lru_cache(maxsize=1)
def codepoint_classes() -> np.ndarray:
    """The class of every codepoint; letters, numbers and white space as tiktoken's own Unicode tables have them."""
    import tiktoken

    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    one_byte = {bytes([b]): b for b in range(256)}
    out = np.full(0x110000, OTHER, np.uint8)
    for expression, cls in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", WHITE)):
        probe = tiktoken.Encoding("probe", pat_str=expression, mergeable_ranks=one_byte, special_tokens={})
        out[[ord(c) for c in bytes(probe.encode_ordinary(every)).decode()]] = cls
    for some, cls in ((" ", SPACE), ("'", QUOTE), ("stmd", STMD), ("rv", RV), ("l", ELL), ("e", E)):
        out[[ord(c) for c in some]] = cls
    return out


def _codepoints(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of each codepoint's first byte, codepoints) of UTF-8 bytes; broken bytes are U+FFFD."""
    at = np.flatnonzero((data & 0xC0) != 0x80)
    lead = data[at]
    code = lead.astype(np.int64)
    padded = np.concatenate([data, np.zeros(3, np.uint8)]).astype(np.int64)
    for low, high, size, mask in ((0xC0, 0xE0, 2, 0x1F), (0xE0, 0xF0, 3, 0x0F), (0xF0, 0x100, 4, 0x07)):
        some = np.flatnonzero((lead >= low) & (lead < high))
        value = code[some] & mask
        for k in range(1, size):
            value = value << 6 | padded[at[some] + k] & 0x3F
        code[some] = np.where(value < 0x110000, value, 0xFFFD)
    return at, code


# the group that a state's last codepoint belongs to: none, words, numbers, others
_GROUP = np.array([0, 1, 2, 3, 0, 0, 3, 1, 1, 1], np.uint8)
_CLASS_GROUP = np.array([3, 1, 2, 0, 0, 3, 1, 1, 1, 1], np.uint8)


def slice_starts(data: np.ndarray, offsets: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Byte places where the pattern's matches start, over rows data[offsets[i]:offsets[i + 1]]."""
    at, code = _codepoints(data)
    n = len(at)
    if not n:
        return at
    cls = classes[code]
    fresh = np.zeros(n, bool)
    rows = np.searchsorted(at, offsets[:-1])
    fresh[rows[(rows < n) & (np.diff(offsets) > 0)]] = True
    fresh[0] = True
    first, compose, constant = _functions()
    f = first[cls + 10 * fresh]
    step = 1
    while (constant[f] < 0).any():
        f[step:] = compose[f[:-step], f[step:]]
        step *= 2
    state = constant[f]
    before = np.empty(n, np.int8)
    before[0], before[1:] = START, state[:-1]
    before[fresh] = START
    white = (cls == SPACE) | (cls == WHITE)
    last_white = np.zeros(n, bool)  # the last white space before something else of the same row
    last_white[:-1] = white[:-1] & ~white[1:] & ~fresh[1:]
    within = state == DONE
    within[:-1] |= ((state[:-1] == OPEN_RV) | (state[:-1] == OPEN_L)) & (state[1:] == DONE) & ~fresh[1:]
    after_white = (before == BLANK) | (before == GAP)
    starts = np.where(white, ~after_white | last_white, (before == GAP) | (before == DONE) | ((before != BLANK) & (_GROUP[before] != _CLASS_GROUP[cls]))) & ~within
    return at[starts | fresh]


class Ranks:
    """A vocabulary of byte strings with ranks, which are their ids."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.ids = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.size = max(self.ids.values(), default=0) + 1
        tokens: list[bytes] = [b""] * self.size
        for token, rank in self.ids.items():
            tokens[rank] = token
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.at = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.of_byte = np.array([self.ids[bytes([b])] for b in range(256)], np.int64)
        pairs = {}
        for token, rank in self.ids.items():
            for cut in range(1, len(token)):
                left, right = self.ids.get(token[:cut]), self.ids.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left * self.size + right] = rank
        self.keys = np.array(sorted(pairs), np.int64)
        self.merged = np.array([pairs[k] for k in self.keys.tolist()], np.int64)
        self.pairs = pairs

    def of_pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The ids that pairs merge to; _NONE for pairs that don't."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.merged[at], _NONE)

    def merge_one(self, piece: bytes) -> np.ndarray:
        """ids of a long slice, by a heap of pairs: lowest rank first, leftmost of equals."""
        ids = self.of_byte[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        after, back = list(range(1, n + 1)), list(range(-1, n - 1))
        find, size = self.pairs.get, self.size
        heap = [r << 32 | i for i in range(n - 1) if (r := find(ids[i] * size + ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = divmod(heapq.heappop(heap), 1 << 32)
            j = after[i]
            if ids[i] < 0 or j >= n or find(ids[i] * size + ids[j]) != rank:
                continue  # merged away since
            ids[i], ids[j], after[i] = rank, -1, after[j]
            if after[i] < n:
                back[after[i]] = i
                if (r := find(rank * size + ids[after[i]])) is not None:
                    heapq.heappush(heap, r << 32 | i)
            if back[i] >= 0 and (r := find(ids[back[i]] * size + rank)) is not None:
                heapq.heappush(heap, r << 32 | back[i])
        found = np.array(ids, np.int64)
        return found[found >= 0]

    def merge(self, data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many for each) of short slices that stand one after the other, a merge of each slice in every round."""
        token = self.of_byte[data]
        owner = np.repeat(np.arange(len(lengths)), lengths)
        done_token, done_owner = [], []
        rank = np.full(len(token), _NONE)
        rank[:-1] = np.where(owner[1:] == owner[:-1], self.of_pairs(token[:-1], token[1:]), _NONE)
        while len(token):
            heads = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            sizes = np.diff(np.append(heads, len(token)))
            least = np.minimum.reduceat(rank, heads)
            if (over := least == _NONE).any():
                gone = np.repeat(over, sizes)
                done_token.append(token[gone]), done_owner.append(owner[gone])
                token, owner, rank = token[~gone], owner[~gone], rank[~gone]
                continue
            hits = np.flatnonzero(rank == np.repeat(least, sizes))
            hits = hits[np.concatenate([[True], owner[hits[1:]] != owner[hits[:-1]]])]  # leftmost
            token[hits] = rank[hits]
            stay = np.ones(len(token), bool)
            stay[hits + 1] = False
            place = hits - np.arange(len(hits))  # one went before each earlier one
            token, owner, rank = token[stay], owner[stay], rank[stay]
            changed = np.concatenate([place, place[place > 0] - 1])
            inner = changed[changed < len(token) - 1]
            rank[changed] = _NONE
            rank[inner] = np.where(owner[inner] == owner[inner + 1], self.of_pairs(token[inner], token[inner + 1]), _NONE)
        token, owner = np.concatenate([*done_token, token]), np.concatenate([*done_owner, owner])
        return token[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(lengths))


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ..., so many for each."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)


class Encoder:
    """Encodes buffers of texts; remembers the ids of slices by their hash, up to CACHED of them."""

    def __init__(self, ranks: Ranks, classes: np.ndarray, hashes=word_hashes):
        self.ranks, self.classes, self.hashes = ranks, classes, hashes
        present = np.flatnonzero(ranks.lengths)
        at, lengths = ranks.at[present], ranks.lengths[present]
        self._known = dict(zip(hashes(ranks.bytes, at, at + lengths).tolist(), range(len(present)), strict=True))
        self._forget()

    def _forget(self) -> None:
        self.slots = dict(self._known)
        present = np.flatnonzero(self.ranks.lengths)
        self.pool, self.at, self.length = present, np.arange(len(present)), np.ones(len(present), np.int64)

    def _merged(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many for each) of slices, without the cache."""
        lengths = ends - starts
        short = lengths <= LONG
        ids, counts = self.ranks.merge(data[_ranges(starts[short], lengths[short])], lengths[short])
        if short.all():
            return ids, counts
        found: list[np.ndarray] = [np.zeros(0, np.int64)] * len(starts)
        for i, some in zip(np.flatnonzero(short).tolist(), np.split(ids, np.cumsum(counts)[:-1]), strict=False):
            found[i] = some
        for i in np.flatnonzero(~short).tolist():
            piece = data[starts[i] : ends[i]].tobytes()
            whole = self.ranks.ids.get(piece)
            found[i] = self.ranks.merge_one(piece) if whole is None else np.array([whole])
        return np.concatenate(found), np.array([len(x) for x in found])

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, end of each in data, first id of each row and the end) of rows data[offsets[i]:offsets[i + 1]]."""
        starts = slice_starts(data, offsets, self.classes)
        ends = np.append(starts[1:], len(data)) if len(starts) else starts
        value, first, which = np.unique(self.hashes(data, starts, ends), return_index=True, return_inverse=True)
        if len(self.slots) > CACHED + len(self._known):
            self._forget()
        slot = np.array([self.slots.get(h, -1) for h in value.tolist()], np.int64)
        new = np.flatnonzero(slot < 0)
        pool, at, length = self.pool, self.at, self.length
        if len(new):
            a, b = starts[first[new]], ends[first[new]]
            ids, counts = self._merged(data, a, b)
            slot[new] = len(at) + np.arange(len(new))
            pool, at, length = np.concatenate([pool, ids]), np.concatenate([at, len(pool) + np.cumsum(counts) - counts]), np.concatenate([length, counts])
            if int((b - a).max()) <= CACHED_BYTES:
                self.pool, self.at, self.length = pool, at, length
                self.slots.update(zip(value[new].tolist(), slot[new].tolist(), strict=True))
            elif len(keep := np.flatnonzero(b - a <= CACHED_BYTES)):
                kept = slot[new[keep]]
                self.slots.update(zip(value[new[keep]].tolist(), range(len(self.at), len(self.at) + len(keep)), strict=True))
                more = pool[_ranges(at[kept], length[kept])]
                self.at = np.concatenate([self.at, len(self.pool) + np.cumsum(length[kept]) - length[kept]])
                self.pool, self.length = np.concatenate([self.pool, more]), np.concatenate([self.length, length[kept]])
        each = slot[which]
        ids = pool[_ranges(at[each], length[each])]
        if not self._same(ids, data):  # two slices share a hash
            ids, counts = self._plain(data, starts, ends)
        ends = np.cumsum(self.ranks.lengths[ids])
        return ids, ends, np.searchsorted(ends, offsets, "right") if len(ends) else np.zeros(len(offsets), np.int64)

    def _same(self, ids: np.ndarray, data: np.ndarray) -> bool:
        got = decoded(ids, self.ranks)
        return len(got) == len(data) and bool((got == data).all())

    def _plain(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        whole = [self.ranks.ids.get(data[a:b].tobytes(), -1) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        rest = np.flatnonzero(np.array(whole) < 0)
        parts: list[np.ndarray] = [np.array([x]) for x in whole]
        if len(rest):
            ids, counts = self._merged(data, starts[rest], ends[rest])
            for i, some in zip(rest.tolist(), np.split(ids, np.cumsum(counts)[:-1]), strict=True):
                parts[i] = some
        return np.concatenate(parts), np.array([len(x) for x in parts])


def decoded(ids: np.ndarray, ranks: Ranks) -> np.ndarray:
    """The bytes of ids, one after the other."""
    return ranks.bytes[_ranges(ranks.at[ids], ranks.lengths[ids])]


def _parts(data: np.ndarray) -> Iterator[tuple[int, int]]:
    """Parts of a text, cut before white space that follows something else: a match always starts there."""
    start = 0
    while len(data) - start > CHUNK:
        white = (data[start + 1 :] == 0x20) | (data[start + 1 :] == 0x0A)
        other = (data[start:-1] > 0x20) & (data[start:-1] < 0x80)
        window = slice(CHUNK // 2, CHUNK)
        cuts = np.flatnonzero(white[window] & other[window])
        cut = start + 1 + CHUNK // 2 + int(cuts[-1]) if len(cuts) else 0
        if not cut:  # the next such place, or the rest
            later = np.flatnonzero(white[CHUNK:] & other[CHUNK:])
            cut = start + 1 + CHUNK + int(later[0]) if len(later) else len(data)
        yield start, cut
        start = cut
    if start < len(data):
        yield start, len(data)


def _binary(values: list[np.ndarray]) -> pa.Array:
    return pa.array([v.astype("<u4").tobytes() for v in values], pa.binary())


def encode(docs: DataFrame, ranks_path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, n_tokens long, ids and ends, binaries of little-endian unsigned 32-bit numbers.

    ends has the byte of the text where each token ends. A null or empty text has no tokens; rows with
    null or repeated ids are rows like others; an empty table gives an empty one; other columns are not
    read, whatever their names. Texts of any length are encoded part by part; a word as long as a whole
    text is merged at once, by a heap. A slice whose hash another has is found, as its ids decode to other
    bytes, and merged again. Nothing is shuffled; a lost task is run again. The vocabulary's file is
    read where the driver runs, and broadcast: its size is that of the file.
    """
    spark = docs.sparkSession
    small_batches(spark)
    id_type = docs.select(F.col(quoted(id_col))).schema[0].dataType.simpleString()
    shared = spark.sparkContext.broadcast((Ranks(ranks_path), codepoint_classes()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(*shared.value)
        for batch in batches:
            for first, end, data, offsets in text_chunks(batch.column(1), CHUNK):
                if end - first == 1:
                    parts = [(encoder.encode(data[a:b], np.array([0, b - a])), a) for a, b in _parts(data)]
                    ids, ends = [np.concatenate([p[0] for p, _ in parts] or [np.zeros(0)])], [np.concatenate([p[1] + a for p, a in parts] or [np.zeros(0)])]
                else:
                    flat, stops, rows = encoder.encode(data, offsets)
                    ids = [flat[a:b] for a, b in zip(rows[:-1].tolist(), rows[1:].tolist(), strict=True)]
                    ends = [stops[a:b] - o for a, b, o in zip(rows[:-1].tolist(), rows[1:].tolist(), offsets.tolist(), strict=False)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, end - first), pa.array([len(x) for x in ids], pa.int64()), _binary(ids), _binary(ends)], ["_id", "n_tokens", "ids", "ends"])

    out = docs.select(F.col(quoted(id_col)).alias("_id"), F.col(quoted(text_col)).cast("string").alias("_text"))
    return out.mapInArrow(run, f"_id {id_type}, n_tokens long, ids binary, ends binary").select(F.col("_id").alias(id_col), "n_tokens", "ids", "ends")


def decode(tokens: DataFrame, ranks_path: str) -> DataFrame:
    """tokens (of encode) with `decoded`, the bytes of ids, each put where ends has it; null ids: null.

    Raises where ends and the tokens' lengths differ. ids that the vocabulary hasn't raise too.
    """
    spark = tokens.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(Ranks(ranks_path))
    names = tokens.columns
    place = {n: i for i, n in enumerate(names)}
    schema = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in tokens.schema) + ", decoded binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = shared.value
        for batch in batches:
            out = []
            for ids, ends in zip(batch.column(place["ids"]), batch.column(place["ends"]), strict=True):
                if not ids.is_valid:
                    out.append(None)
                    continue
                some = np.frombuffer(ids.as_buffer(), "<u4").astype(np.int64)
                if not np.array_equal(np.cumsum(ranks.lengths[some]), np.frombuffer(ends.as_buffer(), "<u4")):
                    raise ValueError("ends are not those of the ids' bytes")
                out.append(decoded(some, ranks).tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], names=[*names, "decoded"])

    return tokens.mapInArrow(run, schema)
