"""N-gram Jaccard join: an exact metric-space join of documents' shingle sets, with their components.

Jaccard distance is a metric, but over a corpus nearly all distances of shingle sets are 1, so pivots
alone would send every document to every region. Two lemmas come first, both exact. Linked sets share
all but (1 - t) n of a set's n shingles, so a set of which more than that are met nowhere else links
with none: a merged sketch of one slice of the shingles finds most such sets. And sets that link
differ in at most D shingles, so of more than D parts of the universe at least one holds the same of
both: documents whose part is the same share a first region. Regions are then joined by pivots, each
member at home in its nearest pivot's Voronoi region and replicated to those within the window that
the triangle inequality leaves, recursively, until few are left. Distances are taken between short
profiles, a byte for each of more parts: how many bytes differ is a metric too, and never more than
the shingles that differ. Pairs that it leaves meet with whole sets.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import dropped, free, quoted, scratch, small_batches, small_side, written
from .sketch import maybe_repeated, repeated_cells, width_for
from .textops import LOWER, mix, rolling, text_chunks, word_hashes, words

#: Regions of at most so many documents, with profiles of at most so many bytes, are joined within one task, by pivots of their own.
LEAF, LEAF_BYTES = 4096, 16 << 20
#: Regions of at most so many documents are compared pair by pair.
SMALL = 8
#: Share of the universe of shingles that the sketch counts.
SHARE = 0.5
#: Cells of one row of that sketch, at most: 64 MB of bits. It lets sets through that link with none where keys are more than cells.
CELLS = 1 << 29
#: Pairs for each of its members that a region may send to be compared by whole sets before links known by then are taken out.
FIRST = 8
#: First regions of a document that travel with it.
KNOWN = 16
#: Pivots of a region at the second level; each further level has twice as many.
PIVOTS = 8
#: A document is near a pivot up to so many times the limit; others share a region of the far.
NEAR = 2.0
#: Parts of a profile for each shingle that linked sets may differ in.
FINE = 3
#: Edges that a task contracts at a time.
CHUNK = 500_000
_TINY = 1e-9


class Threshold:
    """Links: sets with den * intersection >= num * union."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.distance = 1 - num / den
        self.bounds = [1]
        while self.bounds[-1] < 1 << 40:  # sets that link are in the same class of sizes or in neighbours
            self.bounds.append(max(self.bounds[-1] + 1, -(-self.bounds[-1] * den // num)))

    def most_apart(self, total):
        """Shingles in which linked sets of so many in all may differ; numbers or arrays."""
        return total - 2 * (-(-self.num * total // (self.num + self.den)))

    def at_least_met(self, n: int, counted: int) -> int:
        """Of so many counted shingles of a set of n, how many a linked set holds at least."""
        return counted - (n - -(-n * self.num // self.den))

    def size_class(self, n: int) -> int:
        return int(np.searchsorted(self.bounds, n, "right")) - 1

    def differ(self, i: int) -> int:
        """Shingles in which linked sets of classes i - 1 and i may differ."""
        return (self.den - self.num) * 2 * (self.bounds[i + 1] - 1) // (self.num + self.den)

    def leaf(self, c):
        """Members of a region of class c (a column) that one task joins."""
        most = [max(2, min(LEAF, LEAF_BYTES // (FINE * (self.differ(i) + 1)))) for i in range(len(self.bounds) - 1)]
        return F.element_at(F.array(*map(F.lit, most)), c + 1)

    @lru_cache(maxsize=4096)  # noqa: B019
    def fine(self, i: int) -> np.ndarray:
        """Edges of the parts of a profile."""
        n = FINE * (self.differ(i) + 1)
        return np.array([(k << 64) // n for k in range(1, n)], np.uint64)

    @lru_cache(maxsize=4096)  # noqa: B019
    def parts(self, i: int) -> tuple[int, int, np.ndarray] | None:
        """(slack, what counts as weak, edges) of the parts for sets of classes i - 1 and i; None: only equal sets link."""
        differ = self.differ(i)
        if differ == 0:
            return None
        slack = max(1, (differ + 1) // 16)
        n = differ + 1 + slack
        edges = np.array([(k << 64) // n for k in range(1, n)], np.uint64)
        return slack, int(n >= 20), edges


def _sets(column: pa.Array, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingles) of each text."""
    for first, end, data, offsets in text_chunks(column):
        data = LOWER[data]
        starts, ends, rows = words(data, offsets)
        hashes = word_hashes(data, starts, ends)
        shingles = rolling(hashes, n)
        for r in range(end - first):
            a, b = int(rows[r]), int(rows[r + 1])
            if b - a >= n:
                yield first + r, np.unique(shingles[a : b - n + 1])
            else:
                yield first + r, rolling(hashes[a:b], b - a) if b > a else np.zeros(0, np.uint64)


def _signatures(s: np.ndarray, limit: Threshold) -> np.ndarray:
    """One key for each part of the set that a linked set may hold alike.

    Of the parts, slack + 1 at least are alike in linked sets. Parts with next to nothing in them
    say little, and a set with at most `slack` of these leaves them out: one of the others is alike.
    """
    out = []
    sums = np.zeros(len(s) + 1, np.uint64)
    np.cumsum(mix(s ^ np.uint64(0x5851F42D4C957F2D)), out=sums[1:])
    i = limit.size_class(len(s))
    for k in (i, i + 1):
        if (parts := limit.parts(k)) is None:
            continue
        slack, weak, edges = parts
        at = np.concatenate([[0], np.searchsorted(s, edges), [len(s)]])
        strong = np.diff(at) > weak
        salt = np.arange(len(at) - 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(k * 0xD1342543DE82EF95 & (1 << 64) - 1)
        keys = mix((sums[at[1:]] - sums[at[:-1]]) ^ mix(salt))
        keys = keys & ~np.uint64(255) | np.uint64(k)  # the class can be read from the key
        out.append(keys[strong] if int((~strong).sum()) <= slack else keys)
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _profile(s: np.ndarray, k: int, limit: Threshold) -> bytes:
    """A byte for each part of the set: equal parts have equal bytes."""
    sums = np.zeros(len(s) + 1, np.uint64)
    np.cumsum(mix(s), out=sums[1:])
    at = np.concatenate([[0], np.searchsorted(s, limit.fine(k)), [len(s)]])
    return mix(sums[at[1:]] - sums[at[:-1]]).astype(np.uint8).tobytes()


def set_digests(docs: DataFrame, id_col: str, text_col: str, n: int) -> DataFrame:
    """(_id, n_shingles, _a, _b): size and 128-bit digest of each row's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, a, b = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for r, s in _sets(batch.column(1), n):
                size[r], a[r], b[r] = len(s), mix(s).sum().view(np.int64), mix(s ^ np.uint64(0x2545F4914F6CDD1D)).sum().view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size), pa.array(a), pa.array(b)], ["_id", "n_shingles", "_a", "_b"])

    return docs.select(F.col(quoted(id_col)).cast("long").alias("_id"), F.col(quoted(text_col)).cast("string").alias("_text")).mapInArrow(run, "_id long, n_shingles long, _a long, _b long")


def _first_regions(own: DataFrame, n: int, limit: Threshold) -> DataFrame:
    """(region, id) of the documents of which a count-min sketch leaves enough shingles as held by others."""
    size = own.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    width = width_for(int(SHARE * size / 6), CELLS)
    edge = np.uint64(int(SHARE * (1 << 64)))

    def keys(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        held, total = [], 0
        for _, s in _sets(batch.column(0), n):
            held.append(s[: np.searchsorted(s, edge)])
            total += len(held[-1])
            if total > 1 << 16:
                yield np.concatenate(held)
                held, total = [], 0
        if total:
            yield np.concatenate(held)

    bitmaps = repeated_cells(own.select("_text"), keys, width=width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, lists, held = [], [], 0
            ids = batch.column(0)
            for r, s in _sets(batch.column(1), n):
                counted = s[: np.searchsorted(s, edge)]
                if len(s) and int(maybe_repeated(bitmaps.value, counted, width).sum()) >= limit.at_least_met(len(s), len(counted)) and len(parts := _signatures(s, limit)):
                    rows.append(r), lists.append(parts.view(np.int64))
                    held += len(parts)
                if held > 1 << 16:
                    yield _listed(ids, rows, lists)
                    rows, lists, held = [], [], 0
            if rows:
                yield _listed(ids, rows, lists)

    found = own.select("id", "_text").mapInArrow(run, "id long, keys array<long>")
    out = written(found.select(F.explode_outer("keys").alias("region"), "id"), "regions")
    bitmaps.destroy()
    return out


def _listed(ids: pa.Array, rows: list[int], lists: list[np.ndarray]) -> pa.RecordBatch:
    ends = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
    return pa.RecordBatch.from_arrays([ids.take(pa.array(rows)), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(lists)))], ["id", "keys"])


def _same_members_once(members: DataFrame, tag: str) -> DataFrame:
    """(region, id, pivot, n) of regions with two members or more; of regions with equal members one stays.

    Rows that share an id may be in a region more than once, so members are summed up: with xor, two
    of a kind would leave no trace. Halves of the hash are summed, which no number of rows overflows.
    """
    h = F.xxhash64("id")
    regions = members.groupBy("region").agg(F.count("*").alias("n"), F.min(F.struct(h.alias("h"), F.col("id"))).alias("p"), F.sum(F.shiftright(h, 32)).alias("x"), F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF))).alias("y")).filter("n > 1")
    kept = regions.groupBy(F.col("p.id").alias("pivot"), "n", "x", "y", _class("region").alias("_c")).agg(F.min("region").alias("region")).select("region", "pivot", "n")
    return written(members.join(kept, "region"), tag)


def _apart(left: np.ndarray, right: np.ndarray, n_left, n_right) -> np.ndarray:
    """Shingles in which sets differ at least, by their profiles and sizes; a metric."""
    return np.maximum((left != right).sum(axis=-1), np.abs(n_left - n_right))


def _whole(pairs: DataFrame, sets: DataFrame, limit: Threshold, tag: str) -> DataFrame:
    """Those of the pairs (id, other) that link, by their whole sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            link = np.zeros(batch.num_rows, bool)
            left, right = batch.column(2), batch.column(3)
            for r in range(batch.num_rows):
                both = np.concatenate([np.frombuffer(x[r].as_buffer(), np.uint64) for x in (left, right)])
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                link[r] = limit.den * common >= limit.num * (len(both) - common)
            take = pa.array(np.flatnonzero(link))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take)], ["id", "other"])

    pairs = written(pairs.groupBy("id", "other").agg(F.lit(1).alias("_")).drop("_"), f"likely-{tag}")
    rows = pairs.count()
    # either side's sets travel only if they are asked for
    ids, others = pairs.select("id").distinct(), pairs.select(F.col("other").alias("id")).distinct()
    left, right = sets.join(small_side(ids, rows), "id", "left_semi"), sets.join(small_side(others, rows), "id", "left_semi")
    whole = pairs.join(left.select("id", F.col("set").alias("_l")), "id").join(right.select(F.col("id").alias("other"), F.col("set").alias("_r")), "other")
    return written(whole.select("id", "other", "_l", "_r").mapInArrow(run, "id long, other long").distinct(), f"links-{tag}")


def _distances(pairs: DataFrame, profiles: DataFrame, sets: DataFrame, limit: Threshold, tag: str) -> DataFrame:
    """(id, other, class, d, link) of distinct pairs: d by profiles, in units of the class's limit; link by whole sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d, likely = np.zeros(batch.num_rows), np.zeros(batch.num_rows, bool)
            n_left, n_right = (batch.column(c).to_numpy() for c in (3, 4))
            most, classes = limit.most_apart(n_left + n_right), batch.column(2).to_pylist()
            left, right = batch.column(5), batch.column(6)
            for r in range(batch.num_rows):
                apart = int(_apart(*(np.frombuffer(x[r].as_buffer(), np.uint8) for x in (left, right)), n_left[r], n_right[r]))
                d[r], likely[r] = apart / limit.differ(classes[r]), apart <= most[r]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(d), pa.array(likely)], ["id", "other", "class", "d", "likely"])

    pairs = pairs.filter("id <> other").groupBy("id", "other", "class").agg(F.lit(1).alias("_")).drop("_")
    side = lambda key, n: profiles.select(F.col("id").alias(key), "class", F.col("n").alias(f"_n{n}"), F.col("profile").alias(f"_p{n}"))
    both = pairs.join(side("id", 1), ["id", "class"]).join(side("other", 2), ["other", "class"]).select("id", "other", "class", "_n1", "_n2", "_p1", "_p2")
    near = written(both.mapInArrow(run, "id long, other long, class int, d double, likely boolean"), f"distances-{tag}")
    links = _whole(near.filter("likely").select("id", "other"), sets, limit, tag)
    return near.drop("likely").join(links.withColumn("_link", F.lit(True)), ["id", "other"], "left").withColumn("link", F.coalesce("_link", F.lit(False))).drop("_link")


def _voronoi(rows: np.ndarray, apart: Callable, reach: int) -> list[np.ndarray] | None:
    """Regions that members split into, so that each two at most `reach` apart share one; None: pivots don't separate them.

    A member is at home with its nearest pivot, if that is near, and is replicated to each pivot no
    further than the triangle inequality allows for a partner at home there. Those far from all pivots
    share a region.
    """
    pivots = rows[:: -(-len(rows) // PIVOTS)]
    d = np.stack([apart(p, rows) for p in pivots])
    best = d.min(axis=0)
    near = best <= NEAR * reach
    window = d <= np.minimum(best + 2 * reach, (NEAR + 1) * reach)
    regions = [rows[window[p]] for p in np.unique(d.argmin(axis=0)[near])] + [rows[~near]]
    return regions if sum(len(x) ** 2 for x in regions) <= 0.75 * len(rows) ** 2 else None


def metric_pairs(label: np.ndarray, apart: Callable, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(k, o, distance, regions split) of all pairs k < o of members with other labels that are at most `reach` apart.

    apart(k, rows) is a metric. Regions of over SMALL members are split by pivots, recursively, unless
    they are of one label.
    """
    n, found, splits, open_ = len(label), [], 0, [np.arange(len(label))]
    while open_:
        rows = open_.pop()
        if not (label[rows] != label[rows[:1]]).any():
            continue
        regions = _voronoi(rows, apart, reach) if len(rows) > SMALL else None
        if regions is not None:
            splits += 1
            open_ += regions
            continue
        for at, k in enumerate(rows[:-1]):
            others = rows[at + 1 :]
            others = others[label[others] != label[k]]
            d = apart(k, others)
            found.append(np.stack([k * n + others, d])[:, d <= reach])
    if not found:
        return *(np.zeros(0, np.int64) for _ in range(3)), splits
    code, d = np.concatenate(found, axis=1)
    code, first = np.unique(code, return_index=True)
    return code // n, code % n, d[first], splits


def _likely_pairs(units: DataFrame, profiles: DataFrame, limit: Threshold, most: int) -> DataFrame:
    """(unit, id, other, splits): pairs of a unit's members that profiles leave and labels don't tie; a unit has at most LEAF members.

    Members of sides 1 and 2 are compared across only, those of side 0 with all. A pair that shares
    several regions is not sent where both know of an earlier one, so the first always sends it. From a unit with over
    `most` such pairs for each member, each member sends its first. A row without ids tells how many
    regions were split by pivots, and with a unit that it has more pairs.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[int | None, int | None, int | None, int]] = []
            total = 0
            for unit, region, kind, members in zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True):
                members.sort(key=lambda m: m["id"])
                regions = [frozenset(m["regions"]) for m in members]
                who, n, label, side = (np.array([m[c] for m in members]) for c in ("id", "n", "label", "side"))
                bytes_ = np.stack([np.frombuffer(m["profile"], np.uint8) for m in members])
                left, right, d, splits = metric_pairs(label, lambda k, rows: _apart(bytes_[k], bytes_[rows], n[k], n[rows]), limit.differ(kind))  # noqa: B023
                total += splits
                fits = (d <= limit.most_apart(n[left] + n[right])) & ((side[left] == 0) | (side[left] != side[right]))
                fits &= np.array([min(regions[k] & regions[o], default=region) >= region for k, o in zip(left, right, strict=True)], bool)
                left, right = left[fits], right[fits]
                if len(left) > most * len(who):  # a cover: each member once, with the first that it may link with
                    out.append((unit, None, None, 0))
                    first = np.unique(right, return_index=True)[1]
                    left, right = left[first], right[first]
                out += zip([unit] * len(left), who[left].tolist(), who[right].tolist(), [0] * len(left), strict=True)
            out.append((None, None, None, total))
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out, strict=True)], ["unit", "id", "other", "splits"])

    rows = units.join(profiles, ["id", "class"])
    lists = rows.groupBy("unit").agg(F.min("region").alias("region"), F.min("class").alias("class"), F.collect_list(F.struct("id", "n", "label", "side", "profile", "regions")).alias("_m"))
    return lists.mapInArrow(run, "unit long, id long, other long, splits long")


def _compare(units: DataFrame, links: list[DataFrame], profiles: DataFrame, sets: DataFrame, limit: Threshold, tag: str) -> None:
    """Add to links those of the units' members (unit, region, id, class, side, regions), as far as the components need them."""
    turn = 0
    while True:
        labels = components(reduce(DataFrame.unionByName, links)).withColumnRenamed("component", "label")
        known = units.join(small_side(labels, labels.count()), "id", "left").withColumn("label", F.coalesce("label", "id"))
        likely = written(_likely_pairs(known, profiles, limit, FIRST << (3 * turn)), f"pairs-{tag}-{turn}")
        links.append(_whole(likely.filter("id is not null").select("id", "other"), sets, limit, f"{tag}-{turn}"))
        more = likely.filter("id is null and unit is not null").select("unit")
        n_more, splits = likely.agg(F.count_if(F.expr("id is null and unit is not null")), F.sum("splits")).first()
        logging.getLogger(__name__).info("%s, turn %d: %d regions split within tasks", tag, turn, splits or 0)
        if not n_more:
            return
        units = units.join(small_side(more, n_more), "unit", "left_semi")
        turn += 1


def _class(region: str):
    return F.pmod(region, F.lit(256)).cast("int")


def _region(*parts):
    """A region within another one, of the same class."""
    return F.xxhash64(*parts).bitwiseAND(F.lit(~255)).bitwiseOR(F.pmod("region", F.lit(256))).alias("region")


def _edge_of_ball(rows: DataFrame) -> DataFrame:
    """Members of (region, id, d, link) that may have links not yet known; d: to the region's pivot.

    Those that link with the pivot are linked by way of it. One of them can link to a member that
    does not only if that one's distance to the pivot is at most its own plus the limit.
    """
    nearest = rows.filter(~F.col("link")).groupBy("region").agg(F.min("d").alias("_out"))
    return rows.join(nearest, "region").filter(~F.col("link") | (F.col("d") >= F.col("_out") - 1 - _TINY)).drop("_out", "d", "link")


def _set_tables(own: DataFrame, compared: DataFrame, n: int, limit: Threshold) -> tuple[DataFrame, DataFrame]:
    """Sets (id, set) and profiles (id, class, n, profile) of the documents in `compared`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "set", "n", "class", "profile", "class2", "profile2"]
        for batch in batches:
            rows, out, size = [], [], 0
            for r, s in _sets(batch.column(1), n):
                if len(s):
                    i = limit.size_class(len(s))
                    out.append((s.tobytes(), len(s), i, _profile(s, i, limit), i + 1, _profile(s, i + 1, limit)))
                    rows.append(r)
                    size += len(out[-1][0])
                if size > 1 << 20:
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), *map(pa.array, zip(*out, strict=True))], names)
                    rows, out, size = [], [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), *map(pa.array, zip(*out, strict=True))], names)

    wanted = own.select("id", "_text").join(small_side(compared, compared.count()), "id", "left_semi")
    both = written(wanted.mapInArrow(run, "id long, set binary, n long, class long, profile binary, class2 long, profile2 binary"), "sets")
    profiles = both.select("id", F.col("class").cast("int").alias("class"), "n", "profile").unionByName(both.select("id", F.col("class2").cast("int").alias("class"), "n", F.col("profile2").alias("profile")))
    return both.select("id", "set"), profiles


def _links(own: DataFrame, n: int, limit: Threshold) -> DataFrame:
    """Pairs (id, other) that link, enough of them for the components to be exact; own: one document for each set."""
    first = _first_regions(own, n, limit)
    members = _same_members_once(first, "members-0")
    dropped(first)
    compared = written(members.select("id").distinct(), "compared")
    sets, profiles = _set_tables(own, compared, n, limit)

    # level 0: one pivot for each region
    known = _distances(members.select("id", F.col("pivot").alias("other"), _class("region").alias("class")), profiles, sets, limit, "0")
    links = [known.filter("link").select("id", "other")]
    rows = members.withColumn("class", _class("region")).join(known.withColumnRenamed("other", "pivot"), ["id", "pivot", "class"])
    rest, level = _edge_of_ball(rows.select("region", "id", "d", "link")), 0
    while True:
        level += 1
        members = _same_members_once(rest, f"members-{level}").withColumn("class", _class("region"))
        if members.isEmpty():
            return reduce(DataFrame.unionByName, links)
        first = members.groupBy("id").agg(F.slice(F.array_sort(F.collect_set("region")), 1, KNOWN).alias("regions"))
        members = members.join(first, "id")
        units = members.filter(F.col("n") <= limit.leaf(F.col("class"))).select(F.col("region").alias("unit"), "region", "id", "class", F.lit(0).alias("side"), "regions")
        large = members.filter(F.col("n") > limit.leaf(F.col("class")))
        if large.isEmpty():
            _compare(units, links, profiles, sets, limit, f"leaves-{level}")
            return reduce(DataFrame.unionByName, links)
        rest, whole = _split(large, links, profiles, sets, limit, level)
        _compare(units.unionByName(whole), links, profiles, sets, limit, f"leaves-{level}")


def _split(large: DataFrame, links: list[DataFrame], profiles: DataFrame, sets: DataFrame, limit: Threshold, level: int) -> tuple[DataFrame, DataFrame]:
    """(members of the regions that large ones split into, units of those that don't split).

    Pivots are drawn by hash, so that regions which overlap share pivots. A member is at home with its nearest pivot, if that is near, and is
    replicated to each pivot no further than the triangle inequality allows for a partner at home there;
    members far from all pivots share a region. Where all are about equally far, this replicates more
    than it separates: such a region is cut into blocks instead, and each two blocks are a unit.
    """
    slot = F.pmod(F.xxhash64("id", F.lit(-level)), F.lit(PIVOTS << (level - 1)))
    pivots = large.groupBy("region", slot.alias("_slot")).agg(F.min(F.struct(F.xxhash64("id", F.lit(level)).alias("h"), F.col("id"))).alias("p")).select("region", F.col("p.id").alias("other"))
    faced = written(large.select("region", "id", "class").join(pivots, "region"), f"faced-{level}")
    known = _distances(faced.select("id", "other", "class"), profiles, sets, limit, str(level))
    links.append(known.filter("link").select("id", "other"))
    done = faced.filter("id = other").select("region", "id")
    facts = written(faced.join(known, ["id", "other", "class"]).join(done, ["region", "id"], "left_anti"), f"facts-{level}")
    nearest = facts.groupBy("region", "id").agg(F.min("d").alias("_best"))
    window = facts.join(nearest, ["region", "id"]).filter(F.col("d") <= F.least(F.col("_best") + 2, F.lit(NEAR + 1)) + _TINY)
    near = _edge_of_ball(window.select(F.col("region").alias("parent"), _region("region", "other", F.lit(level)), "id", "d", "link"))
    far = nearest.filter(F.col("_best") > NEAR).select(F.col("region").alias("parent"), _region("region", F.lit(-1), F.lit(level)), "id")
    children = written(near.unionByName(far), f"children-{level}")
    before = large.groupBy("region").agg(F.count("*").alias("_n")).withColumnRenamed("region", "parent")
    kept = F.greatest(*[F.coalesce(F.col(c), F.lit(0)) for c in ("_largest", "_half")])
    sizes = children.groupBy("parent", "region").agg(F.count("*").alias("_c")).groupBy("parent").agg(F.max("_c").alias("_largest"), (F.sum("_c") / 2).alias("_half"))
    stuck = written(before.join(sizes, "parent", "left").filter(kept > F.col("_n") * 0.75).select("parent", "_n"), f"stuck-{level}")
    children = children.join(small_side(stuck, stuck.count()), "parent", "left_anti").select("region", "id")
    # blocks of half a leaf: a member meets its own block and each other one
    blocks = F.ceil(F.col("_n") / F.floor(limit.leaf(_class("region")) / 2) * 1.25).cast("long")
    cut = large.join(stuck.withColumnRenamed("parent", "region"), "region").withColumn("_b", F.pmod(F.xxhash64("id", F.lit(level)), blocks)).withColumn("_o", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    unit = F.xxhash64("region", F.least("_b", "_o"), F.greatest("_b", "_o"))
    side = F.when(F.col("_b") == F.col("_o"), 0).when(F.col("_b") < F.col("_o"), 1).otherwise(2)
    return children, cut.select(unit.alias("unit"), "region", "id", "class", side.alias("side"), "regions")


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(u, v) with v the smallest id that a chunk of the edges (u, v) joins u with; a chunk is bounded by CHUNK."""

    def joined(edges: list[np.ndarray]) -> pa.RecordBatch:
        ids, code = np.unique(np.concatenate(edges, axis=1), return_inverse=True)
        root = list(range(len(ids)))
        for u, v in code.reshape(2, -1).T.tolist():
            while root[u] != u:
                root[u] = u = root[root[u]]
            while root[v] != v:
                root[v] = v = root[root[v]]
            root[max(u, v)] = min(u, v)
        for u in range(len(root)):  # a root is smaller than what hangs from it
            root[u] = root[root[u]]
        low = ids[root]
        return pa.RecordBatch.from_arrays([pa.array(ids[low != ids]), pa.array(low[low != ids])], ["u", "v"])

    held, total = [], 0
    for batch in batches:
        held.append(np.stack([batch.column(c).to_numpy() for c in (0, 1)]))
        total += batch.num_rows
        if total >= CHUNK:
            yield joined(held)
            held, total = [], 0
    if held:
        yield joined(held)


def components(edges: DataFrame) -> DataFrame:
    """(id, component): smallest id reachable over edges (id, other).

    Chunks of at most CHUNK edges are contracted within tasks first. If there are several, large and
    small stars in turn join what is left.
    """

    def state(e: DataFrame):
        return e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()

    own = written(edges.select(F.greatest("id", "other").alias("u"), F.least("id", "other").alias("v")).filter("u <> v").distinct(), "edges")
    chunks = max(1, -(-own.count() // CHUNK))
    e = written(own.coalesce(chunks).mapInArrow(_forest, "u long, v long"), "forest")
    dropped(own)
    before = state(e)
    while chunks > 1:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        old, large = e, written(large, "large-star")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        e = written(small.filter("u <> v").distinct(), "small-star")
        dropped(old, large)
        after = state(e)
        if after == before:
            break
        before = after
    return e.select(F.col("u").alias("id"), F.col("v").alias("component"))


def jaccard_components(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, num: int = 85, den: int = 100) -> DataFrame:
    """One row per row of docs: id_col (long), n_shingles, component_id (smallest id reachable by links).

    A text's set is its distinct shingles of `shingle` words, A-Z in lower case; with fewer words, the
    whole sequence as one; null texts and texts without words have an empty set and link with none.
    Two documents link when den * intersection >= num * union. Rows that share an id are one document,
    which has the links of all. Rows with a null id have no links and a null component. An empty table
    gives an empty one. Texts of any length count whole: one text's words and shingles are in a task's
    memory at a time. Other columns are not read, whatever their names.

    Equal sets are made one first, by digest. Of the links between different sets only those that the
    components need are looked for: not those within a component known by then.
    """
    limit = Threshold(num, den)
    small_batches(docs.sparkSession)
    narrow = docs.select(F.col(quoted(id_col)).cast("long").alias("id"), F.col(quoted(text_col)).cast("string").alias("_text")).filter(F.col("id").isNotNull())
    digests = written(set_digests(docs, id_col, text_col, shingle), "digests")
    classes = written(digests.filter((F.col("n_shingles") > 0) & F.col("_id").isNotNull()).groupBy("_a", "_b").agg(F.min("_id").alias("id"), F.count("*").alias("_n")), "classes")
    # documents that stand for no set: copies of an earlier one, and those without words
    others = written(digests.filter("_id is not null").select(F.col("_id").alias("id")).distinct().join(classes.select("id").distinct(), "id", "left_anti"), "others")
    links = _links(narrow.join(small_side(others, others.count()), "id", "left_anti"), shingle, limit)
    # rows that share an id tie the classes of their sets
    copies = digests.join(classes.filter("_n > 1").select("_a", "_b", "id"), ["_a", "_b"], "left").filter(F.col("_id").isNotNull() & (F.col("n_shingles") > 0))
    same = copies.filter(F.col("_id") != F.col("id")).select(F.col("_id").alias("u"), F.col("id").alias("other"))
    shared_ids = digests.filter("n_shingles > 0").groupBy("_id").agg(F.count("*").alias("_c")).filter("_c > 1").select(F.col("_id").alias("u"))
    ties = same.join(shared_ids, "u", "left_semi").select(F.col("u").alias("id"), "other")
    found = components(links.unionByName(ties)).withColumnRenamed("id", "_rep")
    out = digests.join(classes.filter("_n > 1").select("_a", "_b", F.col("id").alias("_first")), ["_a", "_b"], "left")
    out = out.withColumn("_rep", F.when(F.col("_id").isNotNull(), F.when(F.col("n_shingles") > 0, F.coalesce("_first", "_id")).otherwise(F.col("_id"))))
    out = out.join(found, "_rep", "left")
    return out.select(F.col("_id").alias(id_col), "n_shingles", F.coalesce("component", "_rep").alias("component_id"))


def one_of_each(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """docs without all but one document, that of the smallest id, of each component. Rows with null ids stay."""
    gone, = free(docs, "gone")
    with scratch() as made:
        groups = jaccard_components(docs, id_col=id_col, text_col=text_col, shingle=shingle, num=num, den=den)
        others = written(groups.filter(F.col(id_col) != F.col("component_id")).select(F.col(id_col).alias(gone)).distinct(), "near-copies")
    dropped(*[t for t in made if t is not others])
    return docs.join(small_side(others, others.count()), F.col(quoted(id_col)) == F.col(gone), "left_anti")
