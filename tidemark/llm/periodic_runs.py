"""Periodic runs of words: stretches that repeat a group of words at least four times.

A run is a stretch with smallest period q (words q apart are equal), of at least
``max(6, 4 * q)`` words, that no neighbouring word extends. Periods up to SHORT are found
by comparing a text with itself at each lag. Longer ones are found scale by scale, a
scale being the periods above ``low`` up to ``2 * low``: of all windows of ``low / 2``
grams of ``low / 2`` words each, the least gram is taken. Inside a run the windows one
period apart are equal, so are their minima; so every run has two equal minima at the
distance of its period, and each such pair is extended to both sides as far as the words
agree.

Nothing is missed or capped. A gram that has itself a period of at most a quarter of its
length lies in a run of a smaller scale, which is known by then, and is never a minimum;
not all grams of a run are of that kind, since two runs with different periods share
fewer words than a gram has. The others occur more than a quarter of a gram apart, so a
minimum has at most 16 partners within a scale. Grams are compared by 64-bit hashes,
words themselves by numbers: a collision costs a comparison, no result.

Texts are worked on by themselves, without a shuffle. Several are laid side by side,
parted by numbers that occur once and so are in no run.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from functools import cache
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import columns, mix, prepare, word_list

# A run's least words, and how often it repeats its period at least.
LEAST_WORDS, LEAST_TIMES = 6, 4
# Periods up to here are compared directly.
SHORT = 16
# Words laid side by side, so that arrays stay in a processor's cache.
WORDS_AT_ONCE = 1 << 16
RUN = "struct<start: long, length: long, period: long>"
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


@cache
def _divisors(q: int) -> tuple[int, ...]:
    """q by each of its prime factors."""
    out, rest, p = [], q, 2
    while p * p <= rest:
        if rest % p == 0:
            out.append(q // p)
            while rest % p == 0:
                rest //= p
        p += 1
    if rest > 1:
        out.append(q // rest)
    return tuple(out)


def _smallest(ids: np.ndarray, start: int, q: int) -> bool:
    """Whether a stretch of four times its period q has no smaller one: that would divide
    q, and hold over the first q words already."""
    here = ids[start : start + q]
    return not any(np.array_equal(here, ids[start + d : start + d + q]) for d in _divisors(q))


def _at_lag(ids: np.ndarray, q: int) -> Iterator[tuple[int, int, int]]:
    """Runs with period q, from a comparison of all words with those q further on."""
    same = ids[q:] == ids[:-q]
    need = max(LEAST_WORDS, LEAST_TIMES * q) - q
    if np.count_nonzero(same) < need:
        return
    apart = np.flatnonzero(~same)
    bounds = np.concatenate([[-1], apart, [len(same)]])
    for k in np.flatnonzero(np.diff(bounds) > need):
        start, end = int(bounds[k]) + 1, int(bounds[k + 1])
        if _smallest(ids, start, q):
            yield start, end - start + q, q


def _forward(ids: np.ndarray, at: int, q: int) -> int:
    """How many words from ``at`` on equal those q further on."""
    first, step, n = at, 64, len(ids) - q
    while at < n:
        end = min(at + step, n)
        unlike = ids[at:end] != ids[at + q : end + q]
        k = int(unlike.argmax())
        if unlike[k]:
            return at + k - first
        at, step = end, step * 2
    return n - first if n > first else 0


def _backward(ids: np.ndarray, at: int, q: int) -> int:
    """How many words before ``at`` equal those q further on."""
    last, step = at, 64
    while at > 0:
        begin = max(at - step, 0)
        unlike = ids[begin:at][::-1] != ids[begin + q : at + q][::-1]
        k = int(unlike.argmax())
        if unlike[k]:
            return last - at + k
        at, step = begin, step * 2
    return last


def _minima(grams: np.ndarray, masked: np.ndarray, width: int) -> np.ndarray:
    """Places of the least gram of each window of ``width`` grams; the first of equals."""
    bits = np.uint64(max(len(grams) - 1, 1).bit_length())
    low = (np.uint64(1) << bits) - np.uint64(1)
    key = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    key[masked] = _NONE
    size = 1
    while size < width and len(key) > size:  # width is a power of two
        key = np.minimum(key[:-size], key[size:])
        size *= 2
    places = (key[key != _NONE] & low).astype(np.int64)  # never falls from left to right
    return places[np.flatnonzero(np.diff(places, prepend=-1))]


def _pairs(grams: np.ndarray, places: np.ndarray, low: int, high: int):
    """(place, distance) of equal minima more than ``low`` and at most ``high`` apart."""
    value = grams[places]
    order = np.argsort(value, kind="stable")  # equal ones stay in order of place
    value, places = value[order], places[order]
    found, step = [], 1
    while step < len(value):
        far = places[step:] - places[:-step]
        near = (value[step:] == value[:-step]) & (far <= high)
        if not near.any():
            break
        near &= far > low
        found.append((places[:-step][near], far[near]))
        step += 1
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _worth(ids: np.ndarray, at: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Pairs whose words agree, as spot checks go, over one and a half periods on a side."""
    out = np.zeros(len(at), bool)
    for sign in (1, -1):
        good = np.ones(len(at), bool)
        for part in (2, 4, 5):
            place = at + sign * (q * part // 4)
            inside = (place >= 0) & (place + q < len(ids))
            place = np.where(inside, place, 0)
            good &= inside & (ids[place] == ids[np.where(inside, place + q, 0)])
        out |= good
    return out


def find_runs(ids: np.ndarray, longest: int | None = None) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a sequence of numbers, by start, then period.

    ``longest`` bounds the length of a run, if something is known about it.
    """
    n = len(ids)
    longest = n if longest is None else longest
    runs = []
    for q in range(1, min(SHORT, longest // LEAST_TIMES) + 1):
        runs.extend(_at_lag(ids, q))
    low, size = SHORT, 1
    grams = mix(ids.astype(np.uint64))
    while LEAST_TIMES * (low + 1) <= longest:
        while size < low // 2:
            grams = mix(grams[:-size] * np.uint64(0x9E3779B97F4A7C15) + grams[size:])
            size *= 2
        edges = np.zeros(len(grams) + 1, np.int64)
        for start, length, q in runs:
            if q <= size // 4 and length >= size:
                edges[start] += 1
                edges[start + length - size + 1] -= 1
        masked = np.cumsum(edges[:-1]) > 0
        places = _minima(grams, masked, size)
        at, far = _pairs(grams, places, low, 2 * low)
        if len(at):
            some = _worth(ids, at, far)
            at, far = at[some], far[some]
            order = np.lexsort((at, far))
            last, end = 0, -1
            for x, q in zip(at[order].tolist(), far[order].tolist(), strict=True):
                if q == last and x < end:
                    continue  # in the stretch that was looked at before
                start = x - _backward(ids, x, q)
                last, end = q, x + _forward(ids, x, q)
                if end - start >= (LEAST_TIMES - 1) * q and _smallest(ids, start, q):
                    runs.append((start, end - start + q, q))
        low *= 2
    return sorted(runs, key=lambda r: (r[0], r[2]))


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run holds after its first period, parted by blanks."""
    if not runs:
        return b" ".join(words)
    kept = np.ones(len(words), bool)
    for start, length, q in runs:
        kept[start + q : start + length] = False
    return b" ".join([words[k] for k in np.flatnonzero(kept).tolist()])


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest length by period; of equal ones the first."""
    return max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)


def _of_all(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """Runs of each text's words, of texts of like length at a time."""
    out: list[list] = [[] for _ in texts]
    order = sorted(range(len(texts)), key=lambda k: len(texts[k]))
    held: list[int] = []

    def solve():
        number: dict[bytes, int] = {}
        fresh = count()
        ids: list[int] = []
        starts: list[int] = []
        for k in held:
            starts.append(len(ids))
            ids.extend(map(number.setdefault, texts[k], fresh))
            ids.append(-len(starts))
        longest = len(texts[held[-1]])
        found = find_runs(np.array(ids, np.int64), longest)
        owner = np.searchsorted(starts, [r[0] for r in found], "right") - 1
        for (start, length, q), own in zip(found, owner.tolist(), strict=True):
            out[held[own]].append((start - starts[own], length, q))

    n = 0
    for k in order:
        if len(texts[k]) < LEAST_WORDS:
            continue
        held.append(k)
        n += len(texts[k]) + 1
        if n >= WORDS_AT_ONCE:
            solve()
            held, n = [], 0
    if held:
        solve()
    return out


def periodic_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id``, ``n_words``, ``runs`` (start, length and period, by start, then period)
    and ``collapsed``, the text with each run cut to its first period, of every row.

    Words are parted by the bytes 09-0D and 20. NULL and texts without a word have no
    runs and collapse to the empty text. Rows with a NULL or repeated doc_id are rows like
    others. Texts of any length are looked at whole, each by one task.
    """
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [word_list(t, lower=False) for t in columns(batch, "_text")[0]]
            runs = _of_all(words)
            sizes = np.fromiter(map(len, runs), np.int64, len(runs))
            flat = np.array([r for some in runs for r in some], np.int64).reshape(-1, 3)
            parts = [pa.array(flat[:, k]) for k in range(3)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(w) for w in words], pa.int64()),
                    pa.ListArray.from_arrays(
                        pa.array(np.append(0, np.cumsum(sizes)), pa.int32()),
                        pa.StructArray.from_arrays(parts, ["start", "length", "period"]),
                    ),
                    pa.array(map(collapsed, words, runs), pa.string()),
                ],
                names=["doc_id", "n_words", "runs", "collapsed"],
            )

    docs = docs.select("doc_id", F.col(text).alias("_text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_words long, runs array<{RUN}>, collapsed string"
    return docs.mapInArrow(run, schema)


def with_planted(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``, of which a tenth, chosen by a hash of the doc_id, repeat a
    part of their words to the end."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    chosen = docs.select("doc_id", "text", h.alias("h"), F.floor(h / 10).alias("g"))
    words = F.when(
        F.col("h") % 10 == 0,
        F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1)),
    )
    chosen = chosen.withColumn("words", words).withColumn("n", F.size("words"))
    chosen = chosen.withColumn("a", F.expr("CASE WHEN n > 0 THEN int(g % n) END"))
    return chosen.select(
        "doc_id",
        F.expr(
            "CASE WHEN n > 0 THEN array_join(concat(slice(words, 1, a), slice(flatten("
            "array_repeat(slice(words, a + 1, int(1 + (n - a) div (3 + g % 8))),"
            " int(4 + g % 8))), 1, n - a)), ' ') ELSE text END"
        ).alias("text"),
    )


def run_report(docs: DataFrame) -> DataFrame:
    """Per document, after some texts were made periodic: the number of runs, the one
    with the most repeats, and digests of all runs and of the collapsed text."""
    found = periodic_runs(with_planted(docs))
    line = "concat(r.start, ',', r.length, ',', r.period, '\n')"
    # runs come by start, then period, so the first of equal ones stays
    best = (
        "aggregate(slice(runs, 2, greatest(size(runs) - 1, 0)), runs[0], (b, r) ->"
        " IF(r.length * b.period > b.length * r.period, r, b))"
    )
    found = found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.expr(f"CASE WHEN size(runs) > 0 THEN {best} END").alias("best"),
        F.expr(f"sha2(array_join(transform(runs, r -> {line}), ''), 256)").alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
    return found.select(
        "doc_id",
        "n_runs",
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )
