"""Interpolated modified Kneser-Ney model of word pairs.

Counting runs in Spark. Each task packs the distinct pairs of its texts, with their
counts, into one binary per slice; a slice is a hash range of the pair's first word, or
of the whole pair where the first word is a frequent one, so that no slice holds a hot
word's pairs alone. Slices are merged into sorted arrays of pair hashes with counts, and
the per-word sums they give (pairs by count after a word, distinct words before it) are
merged by word. Both are written to the folder all executors share; scoring workers
memory-map them and look up sorted batches.

``p(v|u) = max(c(uv) - D(c(uv)), 0) / c(u) + g(u) * q(v)``, and ``q`` likewise over the
numbers of distinct words before ``v``, mixed with ``1 / (V + 1)``. A text is its words
and one end; the first word follows a start mark that is no token itself.
"""

from __future__ import annotations

import io
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import (
    columns,
    crc_rest,
    mapped,
    mix,
    opened,
    pooled,
    prepare,
    put,
    scratch_dir,
    stash,
    uri,
    word_hashes,
    word_list,
)

# Word hashes have 48 bits, packed into six bytes; two of them are marks. Words that share
# one are counted as one: V words are expected to have V * V / 2**49 such pairs, the first
# at some 24 million words and 1,800 at a billion.
BITS = np.uint64((1 << 48) - 1)
START, END = np.uint64(1), np.uint64(2)
# Bytes of text a task counts at once, and per slice.
TEXT_AT_ONCE, TEXT_PER_SLICE = 8 << 20, 12 << 20
# A word with this share of a task's tokens, or more, is frequent: at most its inverse
# of them per task, and overall no more words than tasks have in common.
FREQUENT = 1 / 500
# Count of a pair that stands in a table of its own.
LARGE = 255


def tokens(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, ends included, and the number of tokens of each text."""
    words, sizes = [], []
    for text in texts:
        found = word_list(text)
        sizes.append(len(found) + 1)
        words += found
    sizes = np.array(sizes, np.int64)
    out = np.empty(int(sizes.sum()), np.uint64)
    ends = np.cumsum(sizes) - 1
    inner = np.ones(len(out), bool)
    inner[ends] = False
    out[inner] = np.maximum(word_hashes(words) & BITS, np.uint64(3))
    out[ends] = END
    return out, sizes


def before(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The token in front of each, START at the first of a text."""
    out = np.empty_like(hashes)
    out[1:] = hashes[:-1]
    out[np.cumsum(sizes) - sizes] = START
    return out


def pair_key(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(mix(first) ^ second)


def slices_of(first: np.ndarray, second: np.ndarray, frequent: np.ndarray, n: int) -> np.ndarray:
    spread = np.isin(first, frequent) if len(frequent) else np.zeros(len(first), bool)
    hashed = mix(first ^ np.uint64(0x5BD1E995))
    if spread.any():
        hashed[spread] = mix(hashed[spread] ^ second[spread])
    return (hashed % np.uint64(n)).astype(np.int64)


# --- packed columns: a length, then each column's bytes -------------------------


def six(values: np.ndarray) -> bytes:
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unsix(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8).reshape(-1, 6)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :6] = raw
    return out.view("<u8").reshape(-1).astype(np.uint64)


def small(values: np.ndarray) -> bytes:
    """Bytes, with the places and values of those of LARGE or more at the end."""
    big = np.flatnonzero(values >= LARGE)
    return (
        struct.pack("<qq", len(values), len(big))
        + np.minimum(values, LARGE).astype(np.uint8).tobytes()
        + big.astype("<i8").tobytes()
        + values[big].astype("<i8").tobytes()
    )


def unsmall(data: io.BytesIO) -> np.ndarray:
    n, big = struct.unpack("<qq", data.read(16))
    out = np.frombuffer(data.read(n), np.uint8).astype(np.int64)
    where = np.frombuffer(data.read(8 * big), "<i8")
    out[where] = np.frombuffer(data.read(8 * big), "<i8")
    return out


def packed_pairs(first: np.ndarray, second: np.ndarray, n: np.ndarray) -> bytes:
    """Sorted by ``first``: each of its values once, with the number of its pairs."""
    starts = np.flatnonzero(np.diff(first, prepend=np.uint64(0)))
    sizes = np.diff(np.append(starts, len(first)))
    out = [struct.pack("<qq", len(starts), len(first)), six(first[starts]), small(sizes)]
    return b"".join([*out, six(second), small(n)])


def unpacked_pairs(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    stream = io.BytesIO(data)
    heads, n = struct.unpack("<qq", stream.read(16))
    first = unsix(stream.read(6 * heads))
    first = np.repeat(first, unsmall(stream))
    return first, unsix(stream.read(6 * n)), unsmall(stream)


def summed(keys: list[np.ndarray], sums: np.ndarray) -> tuple[np.ndarray, ...]:
    """Rows with equal keys added up, sorted by the keys."""
    order = np.lexsort(keys[::-1])
    keys = [k[order] for k in keys]
    sums = sums[order]
    new = np.zeros(len(order), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    starts = np.flatnonzero(new)
    added = np.add.reduceat(sums, starts) if len(starts) else sums
    return (*(k[starts] for k in keys), added)


# --- model ------------------------------------------------------------------------


@dataclass
class Model:
    """Where the arrays are, and the few numbers that hold for all of them."""

    root: str
    n_slices: int
    n_tokens: int = 0
    n_texts: int = 0
    n_words: int = 0  # distinct tokens
    n_pairs: int = 0  # distinct pairs
    frequent: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    pair_discounts: tuple[float, ...] = (0.5, 1.0, 1.5)
    word_discounts: tuple[float, ...] = (0.5, 1.0, 1.5)
    rest: float = 1.0  # what the lower level leaves to the uniform one

    def array(self, name: str, part: int, kind: str) -> np.ndarray:
        return mapped(uri(self.root, f"{name}-{part:05d}"), kind)

    def pair_counts(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        keys = pair_key(first, second)
        part = slices_of(first, second, self.frequent, self.n_slices)
        return self._found("pairs", keys, part, 1)[:, 0]

    def word_rows(self, words: np.ndarray) -> np.ndarray:
        """c, pairs that occur once, twice, more often, and distinct words before."""
        part = (mix(words) % np.uint64(self.n_slices)).astype(np.int64)
        return self._found("words", words, part, 5)

    def _found(self, name: str, keys: np.ndarray, part: np.ndarray, width: int) -> np.ndarray:
        out = np.zeros((len(keys), width), np.int64)
        order = np.lexsort((keys, part))
        held, starts = np.unique(part[order], return_index=True)
        for k, mine in zip(held.tolist(), np.split(order, starts[1:]), strict=False):
            table = self.array(f"{name}-key", k, "<u8")
            if not len(table):
                continue
            at = np.minimum(np.searchsorted(table, keys[mine]), len(table) - 1)
            hit = table[at] == keys[mine]
            if name == "words":
                values = self.array("words-row", k, "<i8").reshape(-1, width)[at[hit]]
            else:
                values = np.array(self.array("pairs-n", k, "u1")[at[hit]], np.int64)
                big = np.flatnonzero(values == LARGE)
                places = self.array("pairs-big", k, "<i8").reshape(-1, 2)
                values[big] = places[np.searchsorted(places[:, 0], at[hit][big]), 1]
                values = values[:, None]
            out[mine[hit]] = values
        return out

    def log_p(self, texts: list[str | None]) -> list[tuple[int, int, float, float]]:
        """n_tokens, n_known, base score and score of each text."""
        hashes, sizes = tokens(texts)
        starts = np.cumsum(sizes) - sizes
        first = before(hashes, sizes)
        words, which = np.unique(np.append(hashes, START), return_inverse=True)
        rows = self.word_rows(words)
        rows[words == END, 0] = self.n_texts
        rows[words == START, 0] = self.n_texts
        here, context = which[:-1], which[-1:]
        context = np.empty_like(here)
        context[1:] = here[:-1]
        context[starts] = which[-1]

        c = rows[here, 0]
        base = np.log10((c + 1) / (self.n_tokens + self.n_words + 1))
        pairs, back = np.unique(pair_key(first, hashes), return_index=True, return_inverse=True)[1:]
        n = self.pair_counts(first[pairs], hashes[pairs])[back].astype(float)

        total = rows[context, 0].astype(float)
        left = rows[context, 1:4] @ np.array(self.pair_discounts)
        seen = np.maximum(total, 1)
        lower = self._lower(rows[here, 4])
        above = np.maximum(n - discount(n, self.pair_discounts), 0) / seen
        p = np.where(total > 0, above + left / seen * lower, lower)
        score = np.add.reduceat(np.log10(p), starts)
        known = np.add.reduceat((c > 0).astype(np.int64), starts)
        return list(
            zip(
                sizes.tolist(),
                known.tolist(),
                np.add.reduceat(base, starts).tolist(),
                score.tolist(),
                strict=True,
            )
        )

    def _lower(self, n: np.ndarray) -> np.ndarray:
        above = np.maximum(n - discount(n, self.word_discounts), 0) / max(self.n_pairs, 1)
        return above + self.rest / (self.n_words + 1)


def discount(n: np.ndarray, steps: tuple[float, ...]) -> np.ndarray:
    return np.array([0.0, *steps])[np.minimum(n, 3).astype(np.int64)]


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, ...]:
    """By the numbers of entries with count 1 to 4; fixed ones where some are missing."""
    if not (n1 and n2 and n3 and n4):
        return (0.5, 1.0, 1.5)
    y = n1 / (n1 + 2 * n2)
    found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    # each between nothing and its count, so that no probability falls below 0
    return tuple(min(max(d, 0.0), k) for k, d in enumerate(found, 1))


def _parts(part: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each value that occurs, with its places in order."""
    order = np.argsort(part, kind="stable")
    values, starts = np.unique(part[order], return_index=True)
    yield from zip(values.tolist(), np.split(order, starts[1:]), strict=False)


def _binary(**cols) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(cols)


def frequent_words(texts: DataFrame) -> np.ndarray:
    """Words with a share of FREQUENT in some task: at most 1 / FREQUENT per task are
    passed on, and those that hold the share over all rows remain: at most as many."""

    def heavy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in pooled(batches, "text", TEXT_AT_ONCE):
            hashes, sizes = tokens(table.column("text").to_pylist())
            words, n = np.unique(before(hashes, sizes), return_counts=True)
            keep = n >= FREQUENT * len(hashes)
            found = [*words[keep].astype(np.int64).tolist(), None]  # None: all tokens
            yield _binary(word=pa.array(found), n=pa.array([*n[keep].tolist(), len(hashes)]))

    found = stash(
        texts.mapInArrow(heavy, "word long, n long")
        .groupBy("word")
        .agg(F.sum("n").alias("n")),
        "frequent",
    )
    total = found.filter(F.col("word").isNull()).first()
    least = FREQUENT * (total.n if total else 0)
    rows = found.filter(F.col("word").isNotNull() & (F.col("n") >= least)).toArrow()
    return np.sort(rows.column("word").to_numpy().astype(np.uint64))


def learn(training: DataFrame, text: str = "text") -> Model:
    """Count all rows of ``training``. An empty table gives a uniform model."""
    spark = training.sparkSession
    prepare(spark)
    texts = training.select(F.col(text).alias("text"))
    size, rows = texts.agg(
        F.sum(F.octet_length("text")), F.count(F.lit(1))
    ).first()
    n_slices = max(1, -(-(size or 0) // TEXT_PER_SLICE))
    model = Model(scratch_dir(spark, "kneser-ney"), n_slices, n_texts=rows)
    model.frequent = frequent_words(texts) if rows else model.frequent
    root, frequent = model.root, model.frequent

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in pooled(batches, "text", TEXT_AT_ONCE):
            hashes, sizes = tokens(table.column("text").to_pylist())
            ones = np.ones(len(hashes), np.int64)
            first, second, n = summed([before(hashes, sizes), hashes], ones)
            part = slices_of(first, second, frequent, n_slices)
            for k, mine in _parts(part):
                data = packed_pairs(first[mine], second[mine], n[mine])
                yield _binary(slice=pa.array([k]), data=pa.array([data], pa.binary()))

    def merge_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, blobs in by_slice(batches):
            parts = [unpacked_pairs(b) for b in blobs]
            first, second, n = (np.concatenate(x) for x in zip(*parts, strict=True))
            del parts
            first, second, n = summed([first, second], n)
            key = pair_key(first, second)
            order = np.argsort(key, kind="stable")
            held = n[order]
            big = np.flatnonzero(held >= LARGE)
            put(uri(root, f"pairs-key-{k:05d}"), key[order].astype("<u8").tobytes())
            put(uri(root, f"pairs-n-{k:05d}"), np.minimum(held, LARGE).astype(np.uint8).tobytes())
            big = np.stack([big, held[big]], 1).astype("<i8")
            put(uri(root, f"pairs-big-{k:05d}"), big.tobytes())
            # by first word: c and the pairs by count; by second word: words before it
            after = np.stack([n, n == 1, n == 2, n >= 3], 1).astype(np.int64)
            words_a, rows_a = summed([first], after)
            words_b, n_b = summed([second], np.ones(len(second), np.int64))
            words = np.union1d(words_a, words_b)
            table = np.zeros((len(words), 5), np.int64)
            table[np.searchsorted(words, words_a), :4] = rows_a
            table[np.searchsorted(words, words_b), 4] = n_b
            often = np.bincount(np.minimum(n, 5), minlength=6)[1:5].tolist()
            part = (mix(words) % np.uint64(n_slices)).astype(np.int64)
            for j, mine in _parts(part):
                body = [struct.pack("<q", len(mine)), six(words[mine])]
                body += [small(table[mine, i]) for i in range(5)]
                yield _binary(
                    slice=pa.array([j]),
                    data=pa.array([b"".join(body)], pa.binary()),
                    often=pa.array([often], pa.list_(pa.int64())),
                    pairs=pa.array([len(n)]),
                )
                often, n = [0] * 4, n[:0]  # told once per slice

    def merge_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, blobs in by_slice(batches):
            words, tables = [], []
            for blob in blobs:
                stream = io.BytesIO(blob)
                (rows,) = struct.unpack("<q", stream.read(8))
                words.append(unsix(stream.read(6 * rows)))
                tables.append(np.stack([unsmall(stream) for _ in range(5)], 1))
            words, table = summed([np.concatenate(words)], np.concatenate(tables))
            put(uri(root, f"words-key-{k:05d}"), words.astype("<u8").tobytes())
            put(uri(root, f"words-row-{k:05d}"), table.astype("<i8").tobytes())
            often = np.bincount(np.minimum(table[:, 4], 5), minlength=6)[1:].tolist()
            mark = words == START
            yield _binary(
                words=pa.array([len(words) - int(mark.sum())]),
                tokens=pa.array([int(table[~mark, 0].sum())]),
                often=pa.array([often], pa.list_(pa.int64())),
            )

    if not rows:
        _fill(spark, model)
        return model
    pairs = _dealt(texts.mapInArrow(count, "slice long, data binary"), n_slices)
    merged = pairs.mapInArrow(
        merge_pairs, "slice long, data binary, often array<long>, pairs long"
    )
    sums = _kept(merged, uri(root, "_sums"))
    n = [F.sum(F.col("often")[k]) for k in range(4)]
    *by_count, model.n_pairs = sums.agg(*n, F.sum("pairs")).first()
    model.pair_discounts = discounts(*by_count)
    done = _kept(
        _dealt(sums.select("slice", "data"), n_slices).mapInArrow(
            merge_words, "words long, tokens long, often array<long>"
        ),
        uri(root, "_words"),
    )
    n = [F.sum(F.col("often")[k]) for k in range(5)]
    *by_count, model.n_words, inner = done.agg(*n, F.sum("words"), F.sum("tokens")).first()
    model.n_tokens = inner + rows  # ends come before nothing
    model.word_discounts = discounts(*by_count[:4])
    taken = np.array(by_count[:2] + [sum(by_count[2:])]) @ np.array(model.word_discounts)
    model.rest = float(taken) / model.n_pairs
    _fill(spark, model)
    return model


def by_slice(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[bytes]]]:
    """Binaries of one slice after the other, from rows sorted by slice."""
    at, held = None, []
    for batch in batches:
        for k, data in zip(*columns(batch, "slice", "data"), strict=True):
            if k != at and held:
                yield at, held
                held = []
            at = k
            held.append(data)
    if held:
        yield at, held


def _dealt(df: DataFrame, n: int) -> DataFrame:
    return df.repartition(n, "slice").sortWithinPartitions("slice")


def _kept(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _fill(spark: SparkSession, model: Model) -> None:
    """Empty arrays for slices that got no rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in columns(batch, "id")[0]:
                for name in ("pairs-key", "pairs-n", "pairs-big", "words-key", "words-row"):
                    location = uri(model.root, f"{name}-{k:05d}")
                    fs, path = opened(location)
                    if not fs.get_file_info(path).is_file:
                        put(location, b"")
            yield batch

    spark.range(model.n_slices).mapInArrow(run, "id long").count()


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """Scores of every row of ``docs`` (doc_id, text, held_out).

    A NULL or empty text is its end alone. Repeated rows are scored one by one.
    """
    prepare(docs.sparkSession)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in pooled(batches, "text", TEXT_AT_ONCE // 4):
            rows = list(zip(*model.log_p(table.column("text").to_pylist()), strict=True))
            n = table.num_rows
            yield from pa.table(
                {
                    "doc_id": table.column("doc_id"),
                    "held_out": table.column("held_out"),
                    "n_tokens": pa.array(rows[0], pa.int64()),
                    "n_known": pa.array(rows[1], pa.int64()),
                    "train_tokens": pa.array([model.n_tokens] * n, pa.int64()),
                    "base_score": pa.array(rows[2], pa.float64()),
                    "score": pa.array(rows[3], pa.float64()),
                }
            ).combine_chunks().to_batches()

    docs = docs.select("doc_id", "text", "held_out")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(
        score,
        f"doc_id {kind}, held_out boolean, n_tokens long, n_known long,"
        " train_tokens long, base_score double, score double",
    )


def lm_scores(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) under a model of those outside the held-out
    seventh: crc32 of doc_id as text, of the empty text for NULL. NULL texts are empty."""
    rest = crc_rest("doc_id", 7)
    model = learn(docs.filter(rest != 2))
    return scored(docs.select("doc_id", "text", (rest == 2).alias("held_out")), model)
