"""Does the target hold exactly the rows of the source?"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import SchemaDrift
from tidemark.functions.cursors import column, from_text, to_text
from tidemark.functions.frames import empty_frame, small_frame
from tidemark.functions.hashes import row_hash
from tidemark.operators.multiset import LEFT, RIGHT, copy_counts, same_columns


def reconcile(source: DataFrame, target: DataFrame, digest: bool = False) -> DataFrame:
    """One row: rows on either side, and those the other side lacks.

    Copies count: a row held twice and landed once is one missing row. Both zero
    means the sides are equal as multisets. One shuffle of the distinct rows.

    ``digest=True`` shuffles 16 bytes per row instead of the row. Two unlike rows
    then pass for one if both their hashes agree, a chance of about 2**-128 a pair;
    arrays, structs and maps, nested to any depth, are hashed part by part.
    """
    if digest:
        same_columns(source, target)
        target = _digests(target.select(*(column(c) for c in source.columns)))
        source = _digests(source)
    return copy_counts(source, target).agg(*_verdict())


def _verdict() -> list[Column]:
    """Rows on either side and those the other side lacks, of counted rows."""
    here, there = F.col(LEFT), F.col(RIGHT)
    zero = F.lit(0).cast("bigint")

    def total(counts):
        return F.coalesce(F.sum(counts), zero)

    return [
        total(here).alias("n_source"),
        total(there).alias("n_target"),
        total(F.greatest(here - there, zero)).alias("missing"),
        total(F.greatest(there - here, zero)).alias("extra"),
    ]


_STREAMS = T.StructType(
    [
        T.StructField("stream", T.StringType()),
        *(T.StructField(n, T.LongType()) for n in ("hash1", "hash2", LEFT, RIGHT)),
    ]
)


def reconcile_many(sides: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """``reconcile`` by hashes of several streams, source and target each: a row per
    ``stream``. All scans are one stage, and all rows go through one exchange."""
    spark = next(iter(sides.values()))[0].sparkSession
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    # a line that counts nothing keeps streams without rows
    stacked = small_frame(spark, [(name, 0, 0, 0, 0) for name in sides], _STREAMS)
    for name, (source, target) in sides.items():
        same_columns(source, target)
        target = target.select(*(column(c) for c in source.columns))
        for df, counts in ((source, (one, none)), (target, (none, one))):
            stacked = stacked.unionByName(
                _digests(df).select(
                    F.lit(name).alias("stream"),
                    "hash1",
                    "hash2",
                    counts[0].alias(LEFT),
                    counts[1].alias(RIGHT),
                )
            )
    counted = stacked.groupBy("stream", "hash1", "hash2").agg(
        F.sum(LEFT).alias(LEFT), F.sum(RIGHT).alias(RIGHT)
    )
    return counted.groupBy("stream").agg(*_verdict())


def _digests(df: DataFrame) -> DataFrame:
    """Two hashes per row, of the hashes of its columns."""
    return df.select(*(row_hash(df, n).alias(f"hash{n}") for n in (1, 2)))


# --- by ranges of a key -----------------------------------------------------------

# Rows of unlike ranges that are compared one by one without narrowing them further.
ROWS_AT_ONCE = 1_000_000
# Unlike ranges that are still cut into finer ones; with more, little would be left out.
MOST_CUT = 64
# Both hashes of a row are summed in parts of 21 or 22 bits, so that no sum overflows
# within 2**41 rows of a range.
_BITS = (21, 21, 22)
_SUMS = [f"s{n}{k}" for n in (1, 2) for k in range(len(_BITS))]


class _Ranges:
    """Cuts a table by its key, finer at each step, where the sides differ.

    Keys with an order are cut in ranges of equal width, so a step reads only what the
    filter on the key lets through; others by a hash. Rows without a key, or NaN, are a
    range of their own.
    """

    def __init__(self, dtype: T.DataType, key: str, ranges: int):
        self.dtype, self.at, self.n = dtype, column(key), ranges
        self.unset = self.at.isNull()
        if isinstance(dtype, (T.FloatType, T.DoubleType)):
            self.unset |= F.isnan(self.at)
        self.ordered = isinstance(
            dtype, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)
        )
        self.where = F.lit(True)
        self.depth = 0

    def place(self, value: Column) -> Column:
        """Where a key lies, as a number that grows with it."""
        if isinstance(self.dtype, T.DateType):
            value = F.unix_date(value)
        elif not isinstance(self.dtype, T.NumericType):
            value = F.unix_micros(value.cast("timestamp"))
        return value.cast("double")

    def cut(self, bounds: Sequence[Row]) -> Column:
        """The range of each row. ``bounds``: text of the least and greatest key, and
        their places, of each stretch that is left."""
        self.depth += 1
        if not self.ordered:
            number = F.pmod(F.xxhash64(F.lit(self.depth), self.at), F.lit(self.n))
            return F.when(~self.unset, number).otherwise(F.lit(-1))
        here, each = self.place(self.at), max(1, self.n // max(len(bounds), 1))
        number = F.lit(-1).cast("bigint")
        for k, b in enumerate(bounds):
            width = (b["last"] - b["first"]) / each or 1.0
            inside = F.floor((here - F.lit(b["first"])) / F.lit(width)).cast("bigint")
            inside = F.least(F.greatest(inside, F.lit(0)), F.lit(each - 1)) + k * each
            number = F.when(self._within(b), inside).otherwise(number)
        return F.when(~self.unset, number).otherwise(F.lit(-1))

    def _within(self, b: Row) -> Column:
        low, high = (from_text(b[c], self.dtype) for c in ("low", "high"))
        return (self.at >= low) & (self.at <= high)

    def narrow(self, number: Column, unlike: Sequence[Row]) -> None:
        """From now on only the rows of these ranges are looked at."""
        kept = []
        if any(r["range"] < 0 for r in unlike):
            kept.append(self.unset)
        keyed = [r for r in unlike if r["range"] >= 0]
        if self.ordered and len(keyed) <= MOST_CUT:
            kept += [self._within(r) for r in keyed]
        elif keyed:
            kept.append(number.isin([r["range"] for r in keyed]))
            if self.ordered:  # what a scan can use
                low = min(keyed, key=lambda r: r["first"])["low"]
                high = max(keyed, key=lambda r: r["last"])["high"]
                kept[-1] &= self._within(Row(low=low, high=high))
        self.where &= reduce(lambda a, b: a | b, kept)


def reconcile_ranges(
    source: DataFrame, target: DataFrame, key: str, ranges: int = 1024
) -> DataFrame:
    """The distinct rows that the sides do not hold equally often, with ``missing`` copies
    that the target lacks and ``extra`` ones that it has beyond the source.

    Both sides are summed up per range of ``key``: sums of row hashes are the same if the
    rows are, and two unlike sets of rows pass for one with a chance of about 2**-128.
    Only those sums are shuffled. Ranges that differ are cut again, and read again through
    a filter on the key, until few rows are left; only their rows are shuffled and
    compared. Copies count; a key may be NULL or repeat, it only parts the rows.
    """
    same_columns(source, target)
    taken = {"missing", "extra"} & set(source.columns)
    if taken:
        raise SchemaDrift(f"the sides have columns of the result's names: {sorted(taken)}")
    names = [column(c) for c in source.columns]
    target = target.select(*names)
    dtype = source.schema[key].dataType
    by = _Ranges(dtype, key, ranges)
    bounds: Sequence[Row] = []
    if by.ordered:
        found = source.filter(~by.unset).agg(*_ends(by)).first()
        other = target.filter(~by.unset).agg(*_ends(by)).first()
        known = [r for r in (found, other) if r["low"] is not None]
        if known:
            low, high = min(known, key=lambda r: r["first"]), max(known, key=lambda r: r["last"])
            bounds = [
                Row(low=low["low"], first=low["first"], high=high["high"], last=high["last"])
            ]
    before = None
    while True:
        number = by.cut(bounds)
        unlike = _unlike(source.filter(by.where), target.filter(by.where), by, number)
        if not unlike:
            zero = F.lit(0).cast("bigint")
            nothing = empty_frame(source.sparkSession, source.schema)
            return nothing.select(*names, zero.alias("missing"), zero.alias("extra"))
        by.narrow(number, unlike)
        left = sum(r["n"] for r in unlike)
        bounds = [r for r in unlike if r["range"] >= 0]
        shrinks = before is None or left < before / 2
        if left <= ROWS_AT_ONCE or len(bounds) > MOST_CUT or not shrinks or not bounds:
            break
        before = left
    here, there = F.col(LEFT), F.col(RIGHT)
    zero = F.lit(0).cast("bigint")
    return (
        copy_counts(source.filter(by.where), target.filter(by.where))
        .filter(here != there)
        .select(
            *names,
            F.greatest(here - there, zero).alias("missing"),
            F.greatest(there - here, zero).alias("extra"),
        )
    )


def _ends(by: _Ranges) -> list[Column]:
    """Least and greatest key, as text and as places."""
    if not by.ordered:
        return []
    least, most = F.min(by.at), F.max(by.at)
    return [
        to_text(least, by.dtype).alias("low"),
        to_text(most, by.dtype).alias("high"),
        by.place(least).alias("first"),
        by.place(most).alias("last"),
    ]


def _unlike(source: DataFrame, target: DataFrame, by: _Ranges, number: Column) -> list[Row]:
    """The ranges whose sums differ, with their ends and rows: at most one row a range
    reaches the driver."""
    ends = [by.at.alias("__key")]

    def summed(df: DataFrame, sign: int) -> DataFrame:
        parts = []
        for n in (1, 2):
            value, shift = row_hash(df, n), 0
            for k, bits in enumerate(_BITS):
                part = F.shiftrightunsigned(value, shift).bitwiseAND(F.lit((1 << bits) - 1))
                parts.append((part * sign).alias(f"s{n}{k}"))
                shift += bits
        return df.select(number.alias("range"), *ends, *parts, F.lit(sign).alias("side"))

    sums = [F.sum(c).alias(c) for c in (*_SUMS, "side")]
    keyed = _Ranges(by.dtype, "__key", by.n)
    found = (
        summed(source, 1)
        .unionByName(summed(target, -1))
        .groupBy("range")
        .agg(*sums, F.count(F.lit(1)).alias("n"), *_ends(keyed))
    )
    differs = reduce(lambda a, b: a | b, (F.col(c) != 0 for c in (*_SUMS, "side")))
    return found.filter(differs).drop(*_SUMS, "side").collect()
