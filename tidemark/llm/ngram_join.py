"""Documents whose n-gram sets are similar, as components of their links.

N-grams stand in one global order, that of their hashes, and are cut into fragments.

Candidates. Two sets with Jaccard similarity of at least t differ in at most D n-grams,
by their sizes. Cut into F > D fragments, all but D of them are alike in both sets, F - D
at least, so a set posts a key per fragment that is not empty: the fragment's hash. (A set
with as many empty fragments as that, which F makes rare, also posts which F - D of them
are empty, so that pairs alike in empty fragments only are found as well.) Sizes are grouped so that
linked sets are in the same group or in neighbouring ones, and a set posts to both. Pairs
that share a key, and whose sketches do not rule a link out, are candidates. Keys with
many sets never become pairs of rows: their sets are dealt into blocks, and each two
blocks pass on a spanning forest of their candidates.

Links. Components of the candidates are clusters, each linked pair within one. A cluster's
sets are dealt into blocks, and for each two blocks the partial overlaps of all pairs are
counted fragment by fragment of the order, as matrix products, and summed per pair. A
spanning forest of the links that this gives is passed on; its components are the result.

Equal sets are one set from the first batch on. The result is exact up to collisions of
64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import (
    apart,
    columns,
    mix,
    parts,
    prepare,
    stash,
    windows,
    word_hashes,
    word_list,
)
from tidemark.session import shuffle_tasks

# Fragments beyond those that may differ, at least; sets of MANY n-grams get so many that
# empty ones do not use them up, but for chances of DEVIATIONS standard deviations.
SPARE, MANY, DEVIATIONS = 3, 48, 4
# Sets of a key that become pairs of rows; beyond that, sets of a block of sketches.
FEW, BLOCK_SKETCHES = 8, 512
# Sets of a block in a cluster, and distinct n-grams of one fragment there.
BLOCK_SETS, COLUMNS = 256, 4096
# Bits of a set's sketch, at least.
SKETCH = 512
# A bitmap of this size says which keys or sets are worth posting again. It only spares
# work: what it lets through is joined exactly, and a full one lets all through.
BITS = 1 << 25
# Slices that all keys are cut into, at least, and for each task of a shuffle: a task
# holds the keys of one at a time.
SLICES, SLICES_PER_TASK = 4096, 16
# Rows of ids that are sent to every task.
MOST_SENT = 300_000


def sets_of(texts: list[str | None], size: int) -> list[np.ndarray]:
    """The sorted n-gram hashes of each text."""
    words = [word_list(t) for t in texts]
    hashes = word_hashes(list(chain.from_iterable(words)))
    grams = windows(hashes, size)  # of all texts in a row; those over an end are passed by
    out, at = [], 0
    for found in words:
        n = len(found)
        if n >= size:
            mine = np.sort(grams[at : at + n - size + 1])
            new = np.ones(len(mine), bool)
            np.not_equal(mine[1:], mine[:-1], out=new[1:])
            out.append(mine[new])
        else:
            out.append(windows(hashes[at : at + n], size))
        at += n
    return out


def set_id(grams: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(grams.tobytes()) - (1 << 63)


class Groups:
    """Size groups for similarity ``num / den``, and their numbers of fragments.

    For each group, as that of a pair's smaller set: D, the most n-grams a linked pair
    there may differ in, and F, the number of fragments. F is so large that sets have
    more than D fragments that are not empty; all but a few among those of over MANY
    n-grams, by DEVIATIONS standard deviations.
    """

    def __init__(self, num: int, den: int):
        if not 0 < num <= den or 10 * num < 7 * den:
            raise ValueError("the similarity must be between 0.7 and 1")
        self.num, self.den = num, den
        self.starts = [1]
        self.differ: list[int] = []
        self.cuts: list[int] = []

    def _grow(self, most: int) -> None:
        while self.starts[-1] <= most:
            first = self.starts[-1]
            self.starts.append(first * self.den // self.num + 1)
            small = self.starts[-1] - 1
            large = small * self.den // self.num
            differ = (small + large) * (self.den - self.num) // (self.den + self.num)
            self.differ.append(differ)
            self.cuts.append(self._fragments(differ, first) if differ else 0)

    def _fragments(self, differ: int, first: int) -> int:
        cuts = differ + 1 + SPARE
        while MANY <= first and cuts < 20 * first:
            load = first / cuts
            none = math.exp(-load)  # the share of fragments that are empty
            spread = math.sqrt(cuts * (none - (1 + load) * none * none))
            if cuts * (1 - none) - DEVIATIONS * spread > differ:
                break
            cuts += 1 + cuts // 200
        return cuts

    def of(self, sizes: np.ndarray) -> np.ndarray:
        self._grow(int(sizes.max(initial=0)))
        return np.searchsorted(self.starts, sizes, "right") - 1

    def most(self, group: np.ndarray) -> np.ndarray:
        """The largest size in each group."""
        return np.array(self.starts)[group + 1] - 1


def keys_of(sets: list[np.ndarray], groups: Groups) -> tuple[np.ndarray, np.ndarray]:
    """All keys the sets post, and which set posts them."""
    sizes = np.array([len(s) for s in sets], np.int64)
    group = groups.of(sizes)
    grams = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    scrambled = mix(grams ^ np.uint64(0x9E3779B97F4A7C15))
    out, who = [], []
    for lower in (0, 1):
        home = group - lower  # the group of the pair's smaller set
        fits = (home >= 0) & (sizes > 0)
        home = np.maximum(home, 0)
        fits &= sizes * groups.num <= groups.most(home) * groups.den
        cuts = np.where(fits, np.array(groups.cuts)[home], 0)
        spare = cuts - np.array(groups.differ)[home] - 1
        here = cuts[owner] > 0
        if not here.any():
            continue
        mine, value = owner[here], scrambled[here]
        n = cuts[mine].astype(np.uint64)
        place = ((grams[here] >> np.uint64(32)) * n) >> np.uint64(32)
        new = np.ones(len(mine), bool)
        new[1:] = (mine[1:] != mine[:-1]) | (place[1:] != place[:-1])
        first = np.flatnonzero(new)
        poster = mine[first]
        sums = np.add.reduceat(value, first)
        mark = mix((home[poster].astype(np.uint64) << np.uint64(32)) | place[first])
        out.append(mix(sums ^ mark))
        who.append(poster)
        empty = cuts - np.bincount(poster, minlength=len(sets))
        for k in np.flatnonzero((cuts > 0) & (empty > spare)):
            used = set(place[first[poster == k]].tolist())
            rest = [p for p in range(int(cuts[k])) if p not in used]
            marks = [
                xxhash.xxh3_64_intdigest(f"empty {home[k]} {chosen}")
                for chosen in combinations(rest, int(spare[k]) + 1)
            ]
            out.append(np.array(marks, np.uint64))
            who.append(np.full(len(marks), k))
    if not out:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(out), np.concatenate(who)


class _Bitmap:
    def __init__(self, words: np.ndarray):
        self.words = words

    def __contains__(self, value: int) -> bool:
        return bool(self.hits(np.array([value]))[0])

    def hits(self, values: np.ndarray) -> np.ndarray:
        bit = values.astype(np.int64).view(np.uint64) & np.uint64(BITS - 1)
        word = self.words[(bit >> np.uint64(6)).astype(np.int64)]
        return (word >> (bit & np.uint64(63))) & np.uint64(1) > 0


def bitmap(values: DataFrame, column: str) -> _Bitmap:
    """The low bits of a column, at most BITS / 64 rows of which reach the driver."""
    bit = F.col(column).bitwiseAND(F.lit(BITS - 1))
    one = F.expr(f"shiftleft(1L, cast({column} & 63 as int))")
    rows = (
        values.groupBy(F.shiftright(bit, 6).alias("word")).agg(F.bit_or(one).alias("bits")).toArrow()
    )
    words = np.zeros(BITS // 64, np.uint64)
    words[rows.column("word").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return _Bitmap(words)


def extremes(key: np.ndarray, mark: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct keys in their order, with the least and the greatest mark of each."""
    order = np.argsort(key, kind="stable")
    key, mark = key[order], mark[order]
    new = np.ones(len(key), bool)
    np.not_equal(key[1:], key[:-1], out=new[1:])
    first = np.flatnonzero(new)
    return key[first], np.minimum.reduceat(mark, first), np.maximum.reduceat(mark, first)


def posted(docs: DataFrame, size: int, groups: Groups) -> DataFrame:
    """(slice, keys, marks): every key of every set, a row per batch and slice of the keys,
    and of a key's marks there the least and the greatest. Two sets have the same mark for
    a key with a chance of 2**-32, anew for every key they share."""
    slices = max(SLICES, SLICES_PER_TASK * shuffle_tasks(docs.sparkSession))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, marks = [np.zeros(0, np.uint64)], [np.zeros(0, np.int32)]
            for part in parts(batch, "text"):
                found = {set_id(s): s for s in sets_of(columns(part, "text")[0], size) if len(s)}
                ids = np.fromiter(found, np.int64, len(found))
                key, who = keys_of(list(found.values()), groups)
                mark = mix(ids[who].view(np.uint64) ^ key).astype(np.uint32).view(np.int32)
                keys.append(key)
                marks.append(mark)
            key, least, most = extremes(np.concatenate(keys), np.concatenate(marks))
            times = 1 + (least < most)
            mark = np.repeat(least, times)
            mark[np.cumsum(times) - 1] = most
            key = np.repeat(key, times)
            place = ((key >> np.uint64(32)) * np.uint64(slices)) >> np.uint64(32)
            first = np.flatnonzero(np.diff(place.astype(np.int64), prepend=-1))
            cuts = pa.array(np.append(first, len(key)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(place[first].astype(np.int32)),
                    pa.ListArray.from_arrays(cuts, pa.array(key.view(np.int64))),
                    pa.ListArray.from_arrays(cuts, pa.array(mark)),
                ],
                names=["slice", "keys", "marks"],
            )

    return docs.select("text").mapInArrow(run, "slice int, keys array<long>, marks array<int>")


def shared_keys(posts: DataFrame) -> DataFrame:
    """(key): the keys of ``posted`` that have two marks, each once.

    Nearly all keys have one, so grouping rows of single keys would fill a task's memory
    with groups of one; here it holds a slice of them, whose number grows with the tasks."""
    sliced = posts.repartition("slice").sortWithinPartitions("slice")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in in_turn(batches):
            keys, marks = (np.concatenate(lists_of(rows.column(c))) for c in ("keys", "marks"))
            key, least, most = extremes(keys, marks)
            yield pa.RecordBatch.from_arrays([pa.array(key[least < most])], names=["key"])

    return sliced.mapInArrow(run, "key long")


def identified(docs: DataFrame, size: int, groups: Groups, only: _Bitmap) -> DataFrame:
    """Two kinds of rows. With a NULL key: a row of ``docs`` (its columns but the text),
    its set's id (NULL for an empty one), size and sketch. With a key: a set that posts
    it, if ``only`` lets the key through."""
    # NULL in the rows of keys, even where the input has no NULL
    others = [T.StructField(f.name, f.dataType) for f in docs.schema if f.name != "text"]
    sent = docs.sparkSession.sparkContext.broadcast(only)  # BITS bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chain.from_iterable(parts(b, "text") for b in batches):
            sets = sets_of(columns(batch, "text")[0], size)
            ids = [set_id(s) if len(s) else None for s in sets]
            own = [batch.column(batch.schema.get_field_index(f.name)) for f in others]
            names = [*(f.name for f in others), "key", "sid", "n", "sketch"]
            yield pa.RecordBatch.from_arrays(
                [
                    *own,
                    pa.nulls(len(sets), pa.int64()),
                    pa.array(ids, pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(sketches(sets), pa.list_(pa.int64())),
                ],
                names=names,
            )
            found = {k: s for k, s in zip(ids, sets, strict=True) if k is not None}
            key, who = keys_of(list(found.values()), groups)
            key = key.view(np.int64)
            hit = sent.value.hits(key)
            key, who = key[hit], who[hit]
            n = np.array([len(s) for s in found.values()], np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    *(pa.nulls(len(key), c.type) for c in own),
                    pa.array(key),
                    pa.array(np.fromiter(found, np.int64, len(found))[who]),
                    pa.array(n[who]),
                    pa.nulls(len(key), pa.list_(pa.int64())),
                ],
                names=names,
            )

    made = [T.StructField(c, T.LongType()) for c in ("key", "sid", "n")]
    made.append(T.StructField("sketch", T.ArrayType(T.LongType())))
    return docs.mapInArrow(run, T.StructType([*others, *made]))


def sketches(sets: list[np.ndarray]) -> list[np.ndarray]:
    """Per set, a bit for each of 2**k values: whether an odd number of its n-grams falls
    on it. There are as many bits as n-grams or more, SKETCH at least. Two sets differ in
    at least as many n-grams as their sketches in bits; the longer of two is folded."""
    out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(sets)
    widths = np.array([max(SKETCH, 1 << (len(s) - 1).bit_length()) if len(s) else 0 for s in sets])
    for width in np.unique(widths[widths > 0]).tolist():
        mine = np.flatnonzero(widths == width)
        some = [sets[k] for k in mine]
        bit = mix(np.concatenate(some) ^ np.uint64(0xA5A5A5A5A5A5A5A5)) & np.uint64(width - 1)
        row = np.repeat(np.arange(len(some)), [len(s) for s in some])
        odd = np.bincount(row * width + bit.astype(np.int64), minlength=len(some) * width) & 1
        words = np.packbits(odd.astype(np.uint8)).view(np.int64).reshape(len(some), -1)
        for k, sketch in zip(mine, words, strict=True):
            out[k] = sketch
    return out


def near(pairs: DataFrame, sketched: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b, na, nb) whose sketches do not rule a link out."""
    one = sketched.select(F.col("sid").alias("a"), F.col("sketch").alias("sa"))
    two = sketched.select(F.col("sid").alias("b"), F.col("sketch").alias("sb"))
    size = F.least(F.size("sa"), F.size("sb"))

    def folded(name: str) -> Column:  # linked sets differ by one doubling at most
        halves = F.slice(name, F.lit(1), size), F.slice(name, size + 1, size)
        whole = F.zip_with(*halves, lambda x, y: x.bitwiseXOR(y))
        return F.when(F.size(name) > size, whole).otherwise(F.col(name))

    unlike = F.aggregate(
        F.zip_with(folded("sa"), folded("sb"), lambda x, y: F.bit_count(x.bitwiseXOR(y))),
        F.lit(0),
        lambda total, n: total + n,
    )
    most = (F.col("na") + F.col("nb")) * (den - num)
    return (
        pairs.join(one, "a")
        .join(two, "b")
        .filter(unlike * (den + num) <= most)
        .select("a", "b", "na", "nb")
    )


def grams_of(docs: DataFrame, size: int, wanted: DataFrame) -> DataFrame:
    """(sid, grams): the sorted n-grams of the sets in ``wanted`` (sid, rep), once each;
    ``rep`` is a document that has the set."""
    hashed = F.xxhash64("rep").alias("h")
    sent = docs.sparkSession.sparkContext.broadcast(bitmap(wanted.select(hashed), "h"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chain.from_iterable(parts(b, "text") for b in batches):
            hit = sent.value.hits(batch.column(batch.schema.get_field_index("h")).to_numpy())
            some = batch.filter(pa.array(hit))
            found = {set_id(s): s for s in sets_of(columns(some, "text")[0], size) if len(s)}
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(found), pa.int64()),
                    pa.array([s.view(np.int64) for s in found.values()], pa.list_(pa.int64())),
                ],
                names=["sid", "grams"],
            )

    rows = docs.select(F.xxhash64("doc_id").alias("h"), "text")
    rows = rows.mapInArrow(run, "sid long, grams array<long>")
    return rows.join(wanted.select("sid"), "sid", "left_semi").dropDuplicates(["sid"])


def forest(linked: np.ndarray, sids: np.ndarray) -> pa.RecordBatch:
    """(a, b): edges that connect what ``linked``, a symmetric matrix, connects."""
    n = len(sids)
    label = np.arange(n)
    while True:
        least = np.where(linked, label[None, :], n).min(axis=1)
        least = np.minimum(least, label)
        least = least[least]
        if (least == label).all():
            break
        label = least
    some = np.flatnonzero(label != np.arange(n))
    return pa.RecordBatch.from_arrays(
        [pa.array(sids[some], pa.int64()), pa.array(sids[label[some]], pa.int64())],
        names=["a", "b"],
    )


def by_sketch(sketch: list[np.ndarray], n: np.ndarray, num: int, den: int) -> np.ndarray:
    """Which pairs of sets may be linked, by what their sketches tell."""
    size = min(map(len, sketch))
    while max(map(len, sketch)) > size:
        sketch = [
            x if len(x) == size else x[: len(x) // 2] ^ x[len(x) // 2 :] for x in sketch
        ]
    unlike = np.zeros((len(n), len(n)), np.int64)
    for word in np.stack(sketch).T.copy().view(np.uint64):
        unlike += np.bitwise_count(word[:, None] ^ word[None, :])
    return unlike * (den + num) <= (n[:, None] + n[None, :]) * (den - num)


def by_overlap(sets: list[np.ndarray], num: int, den: int) -> np.ndarray:
    """Which pairs of sets are linked: overlaps in fragments of the order, summed."""
    sizes = np.array([len(s) for s in sets], np.int64)
    grams, place = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(place, kind="stable")
    place, row = place[order], row[order]
    overlap = np.zeros((len(sets), len(sets)), np.int64)
    for low in range(0, len(grams), COLUMNS):
        a, b = np.searchsorted(place, [low, low + COLUMNS])
        part = np.zeros((len(sets), min(COLUMNS, len(grams) - low)), np.float32)
        part[row[a:b], place[a:b] - low] = 1
        overlap += (part @ part.T).astype(np.int64)
    return den * overlap >= num * (sizes[:, None] + sizes[None, :] - overlap)


def in_turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each value of the first column, by which ``batches`` are sorted."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        value = batch.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(value[1:] != value[:-1]) + 1).tolist(), len(value)]
        for low, high in zip(cuts, cuts[1:], strict=False):
            if low == high:
                continue
            if held and held[-1].column(0)[0].as_py() != value[low]:
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
            held.append(batch.slice(low, high - low))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def in_blocks(grouped: DataFrame, size: int, solve) -> DataFrame:
    """(a, b): ``solve(rows)`` for every two blocks of every group of ``grouped``.

    ``grouped`` has a group's key, its number of sets m, a sid and what ``solve`` needs.
    A group's sets are dealt into m / size blocks by a hash; each two blocks are a task's
    work, whose size does not depend on the group's.
    """
    blocks = F.ceil(F.col("m") / size).cast("long")
    own = F.pmod(F.xxhash64("sid"), blocks)
    other = F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1))
    more = [c for c in grouped.columns if c not in ("key", "m")]
    dealt = (
        grouped.select("key", *more, own.alias("own"), other.alias("other"))
        .select(
            F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("task"),
            *more,
        )
        .repartition("task")
        .sortWithinPartitions("task", "sid")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from map(solve, in_turn(batches))

    return dealt.mapInArrow(run, "a long, b long")


def lists_of(column: pa.ChunkedArray) -> list[np.ndarray]:
    """The values of each list of 64-bit numbers, without copies."""
    column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = column.chunk(0)
    ends = column.offsets.to_numpy()
    values = column.values.to_numpy()
    return [values[a:b] for a, b in zip(ends, ends[1:], strict=False)]


def candidates(members: DataFrame, reps: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b): edges that connect all candidate pairs of ``members`` (key, sid, n)."""
    sized = stash(
        members.join(members.groupBy("key").agg(F.count("*").alias("m")), "key"), "sized"
    )
    few = (
        sized.filter(F.col("m") <= FEW)
        .groupBy("key")
        .agg(F.array_sort(F.collect_list(F.struct("n", "sid"))).alias("sets"))
        .select("sets")
        .distinct()  # copies of a text share many keys, with the same sets
    )
    pairs = (
        few.select(F.posexplode("sets").alias("at", "x"), "sets")
        .select("x", F.explode(F.slice("sets", F.col("at") + 2, F.lit(FEW))).alias("y"))
        .filter(num * F.col("y.n") <= den * F.col("x.n"))
        .select(
            F.col("x.sid").alias("a"),
            F.col("y.sid").alias("b"),
            F.col("x.n").alias("na"),
            F.col("y.n").alias("nb"),
        )
        .distinct()
    )

    def solve(rows: pa.Table) -> pa.RecordBatch:
        n, sid = rows.column("n").to_numpy(), rows.column("sid").to_numpy()
        return forest(by_sketch(lists_of(rows.column("sketch")), n, num, den), sid)

    crowded = sized.filter(F.col("m") > FEW).join(reps.select("sid", "sketch"), "sid")
    found = in_blocks(crowded, BLOCK_SKETCHES, solve)
    return near(pairs, reps, num, den).select("a", "b").unionByName(found)


def links_in(clusters: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b): edges that connect all links within ``clusters`` (key, sid, m)."""

    def solve(rows: pa.Table) -> pa.RecordBatch:
        grams = [x.view(np.uint64) for x in lists_of(rows.column("grams"))]
        return forest(by_overlap(grams, num, den), rows.column("sid").to_numpy())

    return in_blocks(clusters.join(sets, "sid"), BLOCK_SETS, solve)


def components(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node that is reachable, for every node of ``links``
    (a, b). Stars are contracted by turns, each round written to the shared folder."""
    high, low = F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    edges = stash(links.filter("a <> b").select(high, low).distinct(), "edges")
    before = None
    while True:
        size = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if size == before or not size[0]:
            break
        before = size
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = (
            both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        large = large.distinct()
        near = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(near, "u")
        small = joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stash(
            small.unionByName(near.select("u", F.col("m").alias("v"))).distinct(), "edges"
        )
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label"))


def _whole(labels: DataFrame) -> DataFrame:
    """(sid, label) of all nodes of components, the labels themselves among them."""
    own = labels.select(F.col("label").alias("sid"), "label").distinct()
    return labels.withColumnRenamed("node", "sid").unionByName(own)


def classes(
    docs: DataFrame, size: int = 3, num: int = 90, den: int = 100, *carried: str
) -> DataFrame:
    """doc_id, n_shingles, component_id, and the columns ``carried``, of every row of
    ``docs`` (doc_id, text).

    Sets of distinct n-grams of ``size`` words (the whole text, if it has fewer words)
    are linked where ``den * |intersection| >= num * |union|``. component_id is the
    smallest doc_id reachable, itself included. NULL texts and texts without words are
    linked with nothing. Rows that share a doc_id are linked by their texts alone; a
    NULL doc_id is no smallest one unless all in its component are NULL.
    """
    spark = docs.sparkSession
    prepare(spark)
    groups = Groups(num, den)
    whole, docs = docs.select("doc_id", "text", *carried), docs.select("doc_id", "text")
    shared = stash(shared_keys(posted(docs, size, groups)), "keys")
    posts = stash(identified(whole, size, groups, bitmap(shared, "key")), "posts")
    base = posts.filter("key is null").drop("key")
    reps = stash(
        base.filter("sid is not null")
        .groupBy("sid")
        .agg(F.min("doc_id").alias("rep"), F.first("sketch").alias("sketch")),
        "reps",
    )
    members = stash(
        posts.filter("key is not null")
        .select("key", "sid", "n")
        .join(shared, "key", "left_semi")
        .distinct(),
        "members",
    )
    edges = candidates(members, reps, num, den)
    clusters = stash(_whole(components(edges)), "clusters").withColumnRenamed("label", "key")
    sets = stash(grams_of(docs, size, clusters.join(reps, "sid").select("sid", "rep")), "grams")
    sized = clusters.join(clusters.groupBy("key").agg(F.count("*").alias("m")), "key")
    every = _whole(components(links_in(sized, sets, num, den)))
    # a label is a component's smallest set; the component's smallest doc_id follows
    reps = reps.drop("sketch")
    first = every.join(reps, "sid").groupBy("label").agg(F.min("rep").alias("first"))
    named = every.join(first, "label").select("sid", "first")
    return (
        base.join(reps, "sid", "left")
        .join(named, "sid", "left")
        .select(
            "doc_id",
            F.col("n").alias("n_shingles"),
            F.coalesce("first", "rep", "doc_id").alias("component_id"),
            *carried,
        )
    )


def sql() -> str:
    """``classes`` of documents in another engine's words, by all pairs that share one."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN []
    WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
    END) AS s FROM words),
grams AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM grams a JOIN grams b
  ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, min(r.y) AS component_id
FROM sets s JOIN reach r ON r.x = s.doc_id GROUP BY s.doc_id, len(s.s)"""


def keep_one(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of ``docs`` whose doc_id names their component, with their columns.

    Of rows alike in doc_id and text one stays; rows alike in doc_id alone are one
    document and stay or go by their own texts. A NULL doc_id stays if its component
    has no other. The ids that go are sent to every task while they are MOST_SENT or
    fewer, and joined by a shuffle beyond that.
    """
    plain, restore = apart(docs, "doc_id", "text")
    marked = plain.withColumn("_h", F.xxhash64("text"))
    found = stash(classes(marked, size, num, den, "_h"), "classes")
    gone = found.filter(~F.col("doc_id").eqNullSafe(F.col("component_id")))
    gone = gone.select(F.col("doc_id").alias("_id"), F.col("_h").alias("_g")).distinct()
    again = found.groupBy("doc_id", "_h").agg(F.count("*").alias("m")).filter("m > 1")
    again = again.join(gone, _same(again, gone), "left_anti")
    again = again.select(F.col("doc_id").alias("_id"), F.col("_h").alias("_g"))

    def without(rows: DataFrame, ids: DataFrame, how: str = "left_anti") -> DataFrame:
        ids = stash(ids, "ids")
        sent = F.broadcast(ids) if ids.count() <= MOST_SENT else ids
        return rows.join(sent, _same(rows, sent), how)

    kept = without(marked, gone)
    if again.isEmpty():
        return restore(kept)
    copies = without(kept, again, "left_semi").dropDuplicates(["doc_id", "_h"])
    return restore(without(kept, again).unionByName(copies))


def _same(rows: DataFrame, ids: DataFrame):
    return rows["doc_id"].eqNullSafe(ids["_id"]) & rows["_h"].eqNullSafe(ids["_g"])
