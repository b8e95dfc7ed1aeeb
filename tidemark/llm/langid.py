"""Language of a document, as a mixture of languages.

Each language has a character trigram model, learned from labelled documents. A word's
likelihood under a language is the product of its trigrams' (the word between two
blanks). A document's words come from a mixture of languages; expectation-maximisation
finds the shares. Of the nested sets (the largest share alone, the two largest, ...) the
one with the highest log-likelihood less ``PENALTY * (size - 1) * ln(words)`` is taken.
The prediction is the language with the largest share in it, the score is that share.

A pipeline lets go of documents in which no language holds the majority, and of those that
no learned language tells well: whose log-likelihood per trigram lies far below what the
documents that taught have, by quantiles per language.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import apart, columns, crc_rest, mix, prepare, stash

UNKNOWN = "und"
LETTERS = re.compile(r"[^\W\d_]+")
# Trigrams are counted in so many buckets; SMOOTH is added to every bucket's count.
BUCKETS, SMOOTH = 1 << 15, 0.5
# Distinct words a worker counts before it passes them on, and words of one EM run.
WORDS_COUNTED, WORDS_AT_ONCE = 300_000, 200_000
ROUNDS, PENALTY = 12, 3.0
# A pipeline lets a document go if no language holds this share of it, or if its
# log-likelihood per trigram is REACH times as far below its language's median as the
# TAIL quantile is; documents of fewer than WORDS_TO_TELL words get more room. Languages
# with fewer than LEAST_ROWS documents are held to the quantiles of all.
LEAST_SCORE, REACH, TAIL, WORDS_TO_TELL, LEAST_ROWS = 0.5, 8.0, 0.01, 20, 100


def words_of(text: str | None) -> list[str]:
    return LETTERS.findall(text.lower()) if text else []


def trigrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all trigrams of blank-padded words, and where each word's begin."""
    joined = " " + "  ".join(words) + " "
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    packed = (points[:-2] << np.uint64(42)) | (points[1:-1] << np.uint64(21)) | points[2:]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(sizes + 2) - sizes - 2
    own = np.ones(len(packed), bool)  # but for windows that span two words
    ends = starts[1:]
    own[ends - 1] = False
    own[ends - 2] = False
    bucket = (mix(packed) % np.uint64(BUCKETS)).astype(np.int64)[own]
    return bucket, np.cumsum(sizes) - sizes


def gram_counts(labelled: DataFrame, lang: str = "lang", text: str = "text") -> DataFrame:
    """(lang, bucket, n) over all rows with a language."""
    prepare(labelled.sparkSession)

    def flush(seen: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
        for name, words in seen.items():
            if not words:
                continue
            found = list(words)
            bucket, starts = trigrams(found)
            often = np.fromiter(words.values(), np.int64, len(found))
            sizes = np.diff(np.append(starts, len(bucket)))
            n = np.bincount(bucket, np.repeat(often, sizes), BUCKETS)
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(some)), pa.array(some), pa.array(n[some].astype(np.int64))],
                names=["lang", "bucket", "n"],
            )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Counter] = {}
        for batch in batches:
            for name, body in zip(*columns(batch, "l", "t"), strict=True):
                seen.setdefault(name, Counter()).update(words_of(body))
            if sum(map(len, seen.values())) > WORDS_COUNTED:
                yield from flush(seen)
                seen = {}
        yield from flush(seen)

    return (
        labelled.filter(F.col(lang).isNotNull())
        .select(F.col(lang).alias("l"), F.col(text).alias("t"))
        .mapInArrow(count, "lang string, bucket long, n long")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
    )


class LanguageModel:
    """Log-probabilities, languages x BUCKETS: of a fixed size for each language."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        counts = counts + SMOOTH
        self.log_p = np.log(counts / counts.sum(axis=1, keepdims=True)) if languages else counts

    @classmethod
    def learn(cls, labelled: DataFrame, lang: str = "lang", text: str = "text"):
        """Learn from all rows with a language. One row per language and bucket, a
        number that does not grow with the documents, comes to the driver."""
        table = gram_counts(labelled, lang, text).toArrow()
        names = table.column("lang").to_pylist()
        languages = sorted(set(names))
        counts = np.zeros((len(languages), BUCKETS))
        place = {name: k for k, name in enumerate(languages)}
        rows = np.fromiter((place[n] for n in names), np.int64, len(names))
        counts[rows, table.column("bucket").to_numpy()] = table.column("n").to_numpy()
        return cls(languages, counts)

    def word_log_p(self, words: list[str]) -> np.ndarray:
        """words x languages"""
        bucket, starts = trigrams(words)
        return np.add.reduceat(self.log_p[:, bucket], starts, axis=1).T

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """(language, score) of each text; (UNKNOWN, 0) for one without a letter and
        where no language was learned. Equal shares go to the first name."""
        return [found[:2] for found in self.assess(texts)]

    def assess(
        self, texts: list[str | None]
    ) -> list[tuple[str, float, float | None, int]]:
        """``predict``, the log-likelihood per trigram under the languages chosen, and the
        number of words."""
        out: list = [(UNKNOWN, 0.0, None, 0)] * len(texts)
        if not self.languages:
            return out
        held, n = [], 0
        for k, text in enumerate(texts):
            words = words_of(text)
            if words:
                held.append((k, Counter(words)))
                n += len(held[-1][1])
            if n >= WORDS_AT_ONCE:
                self._solve(held, out)
                held, n = [], 0
        if held:
            self._solve(held, out)
        return out

    def _solve(self, held: list[tuple[int, Counter]], out: list) -> None:
        place: dict[str, int] = {}
        rows, often, sizes, lengths = [], [], [], []
        for _, words in held:
            for word, times in words.items():
                rows.append(place.setdefault(word, len(place)))
                often.append(times)
                lengths.append(len(word))  # as many trigrams, with a blank on either side
            sizes.append(len(words))
        log_p = self.word_log_p(list(place))[np.array(rows)]
        often = np.array(often, float)[:, None]
        starts = np.cumsum(sizes) - sizes
        owner = np.repeat(np.arange(len(sizes)), sizes)
        total = np.add.reduceat(often, starts)
        top = log_p.max(axis=1, keepdims=True)
        like = np.exp(log_p - top)  # relative to the word's best language
        base = np.add.reduceat(often * top, starts)[:, 0]

        def fit(allowed: np.ndarray, some: np.ndarray):
            """Shares and log-likelihoods of documents ``some``, given what is allowed."""
            inside = np.flatnonzero(some[owner])
            number = np.cumsum(some) - 1
            who = number[owner[inside]]
            first = np.flatnonzero(np.diff(who, prepend=-1))
            share = allowed[some] / allowed[some].sum(axis=1, keepdims=True)
            here, n = like[inside], often[inside]
            for _ in range(ROUNDS):
                part = share[who] * here
                part *= n / np.maximum(part.sum(axis=1, keepdims=True), 1e-300)
                share = np.add.reduceat(part, first) / total[some]
            mixed = np.maximum((share[who] * here).sum(axis=1), 1e-300)
            return share, base[some] + np.add.reduceat(n[:, 0] * np.log(mixed), first)

        everyone = np.ones(len(sizes), bool)
        full, most = fit(np.ones((len(sizes), len(self.languages))), everyone)
        order = np.argsort(-full, axis=1, kind="stable")
        rank = np.argsort(order, axis=1, kind="stable")
        price = PENALTY * np.log(np.maximum(total[:, 0], 2))
        share = (rank == 0).astype(float)
        alone = np.add.reduceat(often * log_p, starts)
        best = np.take_along_axis(alone, order[:, :1], 1)[:, 0]
        like_best = best.copy()  # without the price of the set
        for size in range(2, len(self.languages) + 1):
            # no larger set can win where even all languages together do not
            worth = most - price * (size - 1) > best
            if not worth.any():
                break
            found, likelihood = fit((rank < size).astype(float), worth)
            value = likelihood - (price * (size - 1))[worth]
            wins = value > best[worth]
            better = np.flatnonzero(worth)[wins]
            share[better] = found[wins]
            best[better], like_best[better] = value[wins], likelihood[wins]
        grams = np.add.reduceat(often[:, 0] * np.array(lengths), starts)
        winner = share.argmax(axis=1)
        told = like_best / grams
        rows = zip(held, winner, share.max(axis=1), told, total[:, 0], strict=True)
        for (k, _), w, s, f, n in rows:
            out[k] = (self.languages[w], float(min(s, 1.0)), float(f), int(n))


FOUND = T.StructType(
    [
        T.StructField("_lang_pred", T.StringType()),
        T.StructField("_score", T.DoubleType()),
        T.StructField("_told", T.DoubleType()),
        T.StructField("_words", T.LongType()),
    ]
)


def label(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``docs`` with the columns of FOUND: language, score, log-likelihood per trigram
    (NULL without a letter) and words."""
    spark = docs.sparkSession
    prepare(spark)
    sent = spark.sparkContext.broadcast(model)  # languages x BUCKETS numbers

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.float64(), pa.float64(), pa.int64()]
        for batch in batches:
            found = list(zip(*sent.value.assess(columns(batch, text)[0]), strict=True))
            for k, kind in enumerate(kinds):
                values = pa.array(found[k] if found else [], kind)
                batch = batch.append_column(FOUND.names[k], values)
            yield batch

    return docs.mapInArrow(add, T.StructType([*docs.schema, *FOUND]))


def training_rows(docs: DataFrame) -> DataFrame:
    return docs.filter(crc_rest("doc_id", 4) != 2)


def predicted_languages(docs: DataFrame) -> DataFrame:
    """Language of every row of ``docs`` (doc_id, text, lang), learned from the rows
    outside the held-out quarter.

    NULL texts and texts without a letter get UNKNOWN and score 0, as do all if nothing
    can be learned. Rows with a NULL lang teach nothing. Repeated rows are predicted one
    by one, and count in learning as often as they occur.
    """
    model = LanguageModel.learn(training_rows(docs))
    held_out = crc_rest("doc_id", 4) == 2
    return label(docs.select("doc_id", "text", held_out.alias("held_out")), model).select(
        "doc_id",
        "held_out",
        F.col("_lang_pred").alias("lang_pred"),
        F.col("_score").alias("score"),
    )


def least_told(found: DataFrame) -> DataFrame:
    """One row per language of ``found`` (rows of ``label`` that taught): ``lang`` and
    ``median``, and how far below it a document may lie as ``room``. NULL stands for all
    languages, and for those with few documents."""
    quantiles = F.percentile_approx("_told", F.array(F.lit(TAIL), F.lit(0.5)), F.lit(10_000))
    sizes = found.filter(F.col("_told").isNotNull()).rollup("_lang_pred").agg(
        quantiles.alias("q"), F.count("*").alias("n")
    )
    enough = F.col("_lang_pred").isNull() | (F.col("n") >= LEAST_ROWS)
    median = F.col("q")[1]
    return sizes.filter(enough & F.col("q").isNotNull()).select(
        F.col("_lang_pred").alias("lang"),
        median.alias("median"),
        (REACH * (median - F.col("q")[0])).alias("room"),
    )


def keep_known(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` in a known language, with the columns they came with.

    Documents that taught are assessed twice, for the limits and for the verdict: texts
    that are written aside would cost more disk than a second look costs time.
    """
    plain, restore = apart(docs, "doc_id", "text", "lang")
    taught = training_rows(plain).filter(F.col("lang").isNotNull())
    model = LanguageModel.learn(taught)
    found = label(plain, model)
    # a row per learned language, which the model holds in memory anyway
    limits = stash(least_told(label(taught.select("text"), model)), "told")
    own = limits.filter("lang IS NOT NULL").toDF("_lang", "_median", "_room")
    judged = found.join(F.broadcast(own), found["_lang_pred"] == own["_lang"], "left")
    every = limits.filter("lang IS NULL").first() or {"median": None, "room": None}
    median, room = (
        F.coalesce(f"_{c}", F.lit(every[c]).cast("double")) for c in ("median", "room")
    )
    short = F.sqrt(F.greatest(F.lit(1.0), WORDS_TO_TELL / F.greatest("_words", F.lit(1))))
    told = F.coalesce(F.col("_told") >= median - room * short - 1e-9, F.lit(True))
    good = (F.col("_lang_pred") != UNKNOWN) & (F.col("_score") >= LEAST_SCORE) & told
    return restore(judged.filter(good))
