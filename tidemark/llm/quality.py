"""Quality rules whose limits follow the data.

Each document gets a few shares (symbols, capitals, repeated lines, repeated words) and
its mean word length. Per language and source, per language and over all documents a
mergeable quantile sketch of each is kept, of the documents that pass the base rules; the
sketches of the wider levels are merged from the narrower ones. A document passes if it
stays below every fence (word length: also above the like one) of its group and of its
language; levels with too few rows are not heard, and where neither is, all documents
together are. A fence is set by the sketch alone:

* ``q75 + REACH * (q75 - q25) * sqrt(N / n)``, where N is the level's median number of
  words and n the document's, if smaller: a short text's means scatter more.
* Where a quarter of the rows share one value (most have no symbols, no repeats), quartiles
  say nothing. There it is as far beyond the quantile TAIL as that lies beyond q75.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import apart, columns, prepare, stash, windows, word_hashes, word_list

SYMBOLS = "#*$%&|<>"
WHITE = "\t\n\x0b\x0c\r "
COUNTS = "n_words word_chars n_symbols n_dup_lines n_repeat_words n_lines n_upper n_lower".split()
SIGNALS = "symbol_share upper_share dup_line_share repeat_share word_length".split()
# Quantiles taken for the tail: more than one text in a hundred is full of symbols.
TAIL = dict(zip(SIGNALS, (0.9, 0.99, 0.99, 0.99, 0.99), strict=True))
# Quartile distances beyond the quartiles, and rows a level needs to be heard.
REACH, LEAST_ROWS = 3.0, 100
# Room for rounding, and size of a sketch: ranks err by 0.3 % or so.
FLOOR, SKETCH = 1e-6, 1000
# Groups whose limits are sent to every task; more of them are joined by a shuffle.
MOST_SENT = 100_000


def counted(text: str | None) -> tuple[int, ...]:
    """The COUNTS of one text; all are 0 for NULL and for a text without words."""
    if not text:
        return (0,) * len(COUNTS)
    words = word_list(text, lower=False)
    seen, lines, dup = set(), 0, 0
    for line in text.split("\n"):
        if line.strip(WHITE):
            lines += 1
            dup += line in seen
            seen.add(line)
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    repeated = 0
    if len(words) >= 3:
        _, which, often = np.unique(
            windows(word_hashes(words), 3), return_inverse=True, return_counts=True
        )
        starts = often[which] >= 2
        if starts.any():
            inside = np.zeros(len(words), bool)
            for k in range(3):
                inside[k : len(words) - 2 + k] |= starts
            repeated = int(inside.sum())
    return (
        len(words),
        len(text) - sum(map(text.count, WHITE)),
        sum(map(text.count, SYMBOLS)),
        dup,
        repeated,
        lines,
        int(np.count_nonzero((data >= 65) & (data <= 90))),
        int(np.count_nonzero((data >= 97) & (data <= 122))),
    )


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with a struct ``_quality`` of counts; rows stay as they are."""
    prepare(docs.sparkSession)
    kind = T.StructType([T.StructField(c, T.LongType()) for c in COUNTS])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [counted(t) for t in columns(batch, text)[0]]
            arrays = [
                pa.array([r[k] for r in rows], pa.int64()) for k in range(len(COUNTS))
            ]
            made = pa.StructArray.from_arrays(arrays, names=COUNTS)
            yield batch.append_column("_quality", made)

    return docs.mapInArrow(add, T.StructType([*docs.schema, T.StructField("_quality", kind)]))


def _share(part: str, whole: Column) -> Column:
    return F.when(whole > 0, F.col(f"_quality.{part}") / whole)


def signals() -> list[Column]:
    q = {c: F.col(f"_quality.{c}") for c in COUNTS}
    return [
        _share("n_symbols", q["word_chars"]).alias("symbol_share"),
        _share("n_upper", q["n_upper"] + q["n_lower"]).alias("upper_share"),
        _share("n_dup_lines", q["n_lines"]).alias("dup_line_share"),
        _share("n_repeat_words", q["n_words"]).alias("repeat_share"),
        _share("word_chars", q["n_words"]).alias("word_length"),
    ]


def base_failed() -> Column:
    n = F.col("_quality.n_words")
    return (n < 50) | (100 * F.col("_quality.n_repeat_words") > 50 * n)


def limits(measured: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """One row per language and source with ``_levels``, the fences of each level heard.

    Sketches are built beside the scan, merged in one shuffle of sketches, and merged
    again for the wider levels; no row reaches another task. NULL is a language and a
    source of its own. The limits over all documents are one row, read by the driver.
    """
    keys = [F.col(lang).alias("_lang"), F.col(source).alias("_source")]
    sketched = [*SIGNALS, "n_words"]
    groups = stash(
        measured.filter(~base_failed())
        .select(*keys, *signals(), F.col("_quality.n_words").cast("double").alias("n_words"))
        .groupBy("_lang", "_source")
        .agg(
            F.count("*").alias("n"),
            *(F.kll_sketch_agg_double(s, SKETCH).alias(s) for s in sketched),
        ),
        "sketches",
    )

    def merged(*by: str) -> DataFrame:
        return groups.groupBy(*by).agg(
            F.sum("n").alias("n"), *(F.kll_merge_agg_double(s, SKETCH).alias(s) for s in sketched)
        )

    def quantiles(s: str, *ranks: float) -> Column:
        # an empty sketch has no quantiles
        found = F.kll_sketch_get_quantile_double(s, F.array(*map(F.lit, ranks)))
        return F.when(F.kll_sketch_get_n_double(s) > 0, found)

    def fenced(level: DataFrame, name: str, *by: str) -> DataFrame:
        """Per signal where its fences start, and how far beyond the unscaled ones are."""
        out = [quantiles("n_words", 0.5)[0].alias("typical")]
        for s in SIGNALS:
            low, q25, q50, q75, high = (
                quantiles(s, 1 - TAIL[s], 0.25, 0.5, 0.75, TAIL[s])[k] for k in range(5)
            )
            spread = (q25 < q50) & (q50 < q75)
            out += [
                F.when(spread, q75).otherwise(2 * high - q75 + FLOOR).alias(f"most_{s}"),
                F.when(spread, q25).otherwise(2 * low - q25 - FLOOR).alias(f"least_{s}"),
                F.when(spread, REACH * (q75 - q25)).otherwise(0.0).alias(f"reach_{s}"),
            ]
        return level.select(*by, F.col("n").alias(f"n_{name}"), F.struct(*out).alias(name))

    every = F.broadcast(fenced(merged(), "all"))
    by_lang = fenced(merged("_lang"), "lang", "_lang").withColumnRenamed("_lang", "_l")
    joined = (
        fenced(groups, "group", "_lang", "_source")
        .join(by_lang, F.col("_lang").eqNullSafe(F.col("_l")))
        .crossJoin(every)
    )
    heard = F.array_compact(
        F.array(*(F.when(F.col(f"n_{k}") >= LEAST_ROWS, F.col(k)) for k in ("group", "lang")))
    )
    levels = F.when(F.size(heard) > 0, heard).otherwise(F.array("all"))
    return joined.select("_lang", "_source", levels.alias("_levels"))


def within(level: Column) -> Column:
    """Whether a measured row is inside all fences of one level."""
    n = F.col("_quality.n_words")
    scale = F.sqrt(F.greatest(F.lit(1.0), level["typical"] / F.greatest(n, F.lit(1))))
    inside = F.lit(True)
    for s, signal in zip(SIGNALS, signals(), strict=True):
        reach = level[f"reach_{s}"] * scale
        inside &= F.coalesce(signal <= level[f"most_{s}"] + reach, F.lit(True))
        if s == "word_length":
            inside &= F.coalesce(signal >= level[f"least_{s}"] - reach, F.lit(True))
    return inside


def judged(measured: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """``measured`` with ``_kept``: false if a base rule or a limit is broken."""
    found = stash(limits(measured, lang, source), "limits")
    if found.count() <= MOST_SENT:
        found = F.broadcast(found)
    names = measured.columns
    joined = measured.join(
        found,
        measured[lang].eqNullSafe(found["_lang"])
        & measured[source].eqNullSafe(found["_source"]),
        "left",
    )
    # groups without a document that passes the base rules have no limits
    kept = ~base_failed() & F.coalesce(F.forall("_levels", within), F.lit(True))
    return joined.select(*(measured[c] for c in names), kept.alias("_kept"))


def quality_report(docs: DataFrame) -> DataFrame:
    """Counts and verdict of every row of ``docs`` (doc_id, text, lang, source).

    NULL and empty texts have no words and fail the base rule. Repeated rows are judged
    one by one. An empty table gives an empty result.
    """
    measured = stash(
        measure(docs.select("doc_id", "text", "lang", "source")).drop("text"), "measured"
    )
    return judged(measured).select(
        "doc_id",
        *(F.col(f"_quality.{c}").alias(c) for c in COUNTS[:5]),
        base_failed().alias("base_failed"),
        F.col("_kept").alias("kept"),
    )


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with the columns they came with.

    Texts are measured twice, for the limits and for the verdict: written aside they would
    cost more disk than a second look costs time.
    """
    plain, restore = apart(docs, "text", "lang", "source")
    return restore(judged(measure(plain)).filter("_kept"))
