"""Toxicity by gradient-boosted trees over a few dense features of a text.

The features (FEATURES) are densities of insulting, contemptuous, vulgar and threatening
words, what is hit only after disguises are undone (``1d10t``, ``i.d.i.o.t``, ``looooser``),
how often a hit stands near a second person, how close hits lie together, and rates of
capitals, punctuation, disguised and stretched words. The listed words are few and of four
languages; to them comes a learned lexicon of words and their beginnings, each with the
log-odds of the texts that hold it, so that families of inflected insults count however they end.

Features are measured in one pass over the texts; trees and calibration are Spark's own
and see those narrow rows only. Of the labelled rows outside the held-out fifth, two
quarters teach the lexicon, one grows the trees and one calibrates their margins by an
isotonic fit, so that each step sees the one before on texts it was not made from.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator
from itertools import count, repeat

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import columns, crc_rest, prepare, stash

# Word lists of four languages. No word of them is a usual one in another of the four.
INSULTS = """
idiot idiots moron morons loser losers clown clowns scum trash fool fools jerk jerks imbecile
imbeciles dumbass dimwit halfwit nitwit dunce retard retards freak freaks creep creeps coward
cowards liar liars parasite parasites vermin swine weasel scumbag scumbags lowlife degenerate
bastard bastards cretin cretins simpleton buffoon garbage
dummkopf trottel vollidiot depp deppen arschloch abschaum versager spinner schwachkopf drecksau
abruti abrutie cretine connard connasse salaud ordure imbécile crétin débile minable
idiota idiotas imbécil estúpido estúpida tonto tonta payaso basura gilipollas cabrón escoria
""".split()
CONTEMPT = """
stupid stupidity pathetic worthless disgusting dumb ugly useless ridiculous laughable brainless
clueless spineless despicable contemptible repulsive revolting vile filthy hideous incompetent
ignorant insane hopeless gross shameful
dumm blöd widerlich ekelhaft erbärmlich wertlos nutzlos lächerlich hässlich
stupide dégoûtant pathétique ridicule méprisable répugnant
asqueroso patético inútil despreciable repugnante ridículo
""".split()
VULGAR = """
fuck fucking fucked fucker shit shitty bullshit crap damn asshole bitch bitches piss dick
prick cunt whore slut wanker twat bollocks
scheiße scheisse verdammt fotze hure wichser
merde putain pute salope enculé
mierda puta joder coño zorra
""".split()
THREATS = """
kill murder stab strangle hang shoot destroy crush hurt punch smash burn hate die beware suffer
töten umbringen erschießen
tuer crever frapper
matar muere golpear
""".split()
YOU = """
you your yours yourself yourselves youre u ur ya thou
du dich dir dein deine deinen deinem euch euer ihr
tu toi ton ta tes vous votre vos
tú ti tuyo usted ustedes vosotros vuestro
""".split()
LISTS = (INSULTS, CONTEMPT, VULGAR, THREATS)

# Signs written for letters.
DISGUISE = str.maketrans("013457@$!|€", "oieastasile")
PARTS = re.compile(r"[^\W_]+")
LETTERS = re.compile(r"[^\W\d_]+")
STRETCHED = re.compile(r"(.)\1{2,}")
# Words from a hit within which a second person counts as near, and that count as one place.
NEAR, PLACE = 5, 50
# Words a worker remembers.
WORDS_KEPT = 500_000

FEATURES = (
    "insults",  # per word, as the next four
    "contempt",
    "vulgar",
    "threats",
    "unmasked",
    "log_hits",  # ln(1 + hits of the first four lists)
    "most_in_place",  # hits within PLACE words
    "second_person",  # per word
    "near_second_person",  # share of hits
    "capitals",  # per letter
    "shouted",  # per word, as the next three
    "disguised",
    "stretched",
    "exclamations",
    "questions",
    "punctuation",  # per character
    "log_words",
    "learned_most",  # log-odds of the learned lexicon: of the strongest word,
    "learned_mean",  # and per word
    "log_learned",  # ln(1 + words in the learned lexicon)
)

# Letters of the beginnings in the learned lexicon, toxic texts that must hold one, its
# least log-odds, and how many are kept, the strongest first.
STEMS, STEM_TEXTS, STEM_ODDS, STEMS_KEPT = range(3, 9), 5, 3.0, 20_000
# Distinct beginnings a worker counts before it passes them on.
STEMS_COUNTED = 1_000_000
# Labelled documents that teach the lexicon, and those that trees and calibration see, at
# most: of more, so many are chosen by a hash of the doc_id.
TEACHING_ROWS, TRAINING_ROWS = 20_000, 2_000_000
TREES = {"maxIter": 20, "maxDepth": 3, "stepSize": 0.3, "maxBins": 32, "seed": 7}
# Margins are rounded for the calibration, so that it sees a bounded number of them.
MARGIN_DIGITS = 3


def _listed() -> dict[str, int]:
    """List of each word, as a bit; a second person is bit 4."""
    out: dict[str, int] = {}
    for k, words in enumerate((*LISTS, YOU)):
        for word in words:
            out[word] = out.get(word, 0) | 1 << k
    return out


class Words:
    """What is known of each word: its lists, and counts of its signs."""

    # columns of a word's row
    LISTS, UNMASKED, LETTERS, CAPITALS, SHOUTED, DISGUISED, STRETCHED = range(7)
    EXCLAIMS, ASKS, SIGNS, SIZE, LETTER, ALONE, LEARNED = range(7, 14)

    def __init__(self, learned: dict[str, int]):
        self.listed = _listed()
        self.learned = learned  # thousandths of log-odds
        self.place: dict[str, int] = {}
        self.table = np.zeros((0, 14), np.int32)

    def learned_of(self, lower: str) -> int:
        return max(map(self.learned.get, beginnings(lower), repeat(0)), default=0)

    def look(self, word: str) -> tuple:
        """A row of the table."""
        lower = word.casefold()
        if lower == word and lower.isalpha():  # most words
            if len(word) > 2 and not STRETCHED.search(word):
                found, learned = self.listed.get(word, 0), self.learned_of(word)
                return found, 0, len(word), 0, 0, 0, 0, 0, 0, 0, len(word), 0, 0, learned
        found = 0
        for part in PARTS.findall(lower):
            found |= self.listed.get(part, 0)
        letters = sum(map(str.isalpha, word))
        capitals = sum(map(str.isupper, word))
        signs = len(word) - sum(map(str.isalnum, word))
        core = lower.strip(".,:;?\"'()[]{}*#%&~_-")
        stretched = letters > 2 and STRETCHED.search(lower) is not None
        mixed = letters > 0 and not core.isalpha() and core[-1:] != "!"
        unmasked = 0
        if not found & 15 and letters > 1 and (stretched or mixed) and len(core) < 60:
            # digits and signs for letters, signs between letters, letters stretched
            plain = "".join(PARTS.findall(core.translate(DISGUISE)))
            for guise in (plain, STRETCHED.sub(r"\1", plain), STRETCHED.sub(r"\1\1", plain)):
                unmasked |= self.listed.get(guise, 0) & 15
        alone = len(lower) == 1 and letters == 1
        return (
            found | unmasked,
            unmasked > 0,
            letters,
            capitals,
            letters > 2 and capitals == letters,
            mixed and not core.isdigit(),
            stretched,
            word.count("!"),
            word.count("?"),
            signs,
            len(word),
            ord(lower) if alone else 0,
            alone,
            self.learned_of(lower),
        )

    def places(self, texts: list[list[str]]) -> list[list[int]]:
        """Where in the table each word of each text has its row."""
        if len(self.place) > WORDS_KEPT:
            self.place.clear()
            self.table = self.table[:0]
        place = self.place
        fresh = list(set().union(*texts).difference(place))
        if fresh:
            place.update(zip(fresh, count(len(place))))
            rows = np.array([self.look(w) for w in fresh], np.int32)
            self.table = np.concatenate([self.table, rows])
        return [list(map(place.__getitem__, words)) for words in texts]


def _spelled(listed: dict[str, int], table: np.ndarray) -> np.ndarray:
    """Lists of words spelled out letter by letter (i d i o t), at their first letters."""
    out = np.zeros(len(table), np.int64)
    alone = np.flatnonzero(np.diff(np.concatenate([[0], table[:, Words.ALONE], [0]])))
    for start, end in alone.reshape(-1, 2).tolist():
        if end - start > 3:
            word = "".join(map(chr, table[start:end, Words.LETTER].tolist()))
            out[start] = listed.get(word, 0) & 15
    return out


def measured(texts: list[str | None], words: Words) -> np.ndarray:
    """FEATURES of each text; those of an empty text are 0."""
    out = np.zeros((len(texts), len(FEATURES)))
    places = words.places([t.split() if t else [] for t in texts])
    for k, at in enumerate(places):
        n = len(at)
        if not n:
            continue
        table = words.table[at]
        lists = table[:, Words.LISTS]
        unmasked = table[:, Words.UNMASKED]
        if table[:, Words.ALONE].sum() > 3:
            spelled = _spelled(words.listed, table)
            lists, unmasked = lists | spelled, unmasked | (spelled > 0)
        total = table.sum(axis=0, dtype=np.int64)
        hits = np.flatnonzero(lists & 15)
        near = most = 0.0
        if len(hits):
            you = np.flatnonzero(lists & 16)
            if len(you):
                next_you = np.searchsorted(you, hits)
                after = you[np.minimum(next_you, len(you) - 1)] - hits
                before = hits - you[np.maximum(next_you - 1, 0)]
                is_near = ((after >= 0) & (after <= NEAR)) | ((before >= 0) & (before <= NEAR))
                near = is_near.mean()
            ends = np.searchsorted(hits, hits + PLACE)
            most = float((ends - np.arange(len(hits))).max())
        letters, size = max(total[Words.LETTERS], 1), max(total[Words.SIZE], 1)
        out[k] = (
            *((lists >> b & 1).sum() / n for b in range(4)),
            unmasked.sum() / n,
            np.log1p(len(hits)),
            most,
            (lists >> 4 & 1).sum() / n,
            near,
            total[Words.CAPITALS] / letters,
            total[Words.SHOUTED] / n,
            total[Words.DISGUISED] / n,
            total[Words.STRETCHED] / n,
            total[Words.EXCLAIMS] / n,
            total[Words.ASKS] / n,
            total[Words.SIGNS] / size,
            np.log1p(n),
            table[:, Words.LEARNED].max() / 1000,
            total[Words.LEARNED] / 1000 / n,
            np.log1p(np.count_nonzero(table[:, Words.LEARNED])),
        )
    return out


def beginnings(lower: str) -> set[str]:
    """Of the runs of letters in a lower-cased text, the first 3 to 8 letters, and the
    whole with a mark behind it."""
    words = set(LETTERS.findall(lower))
    return {w[:k] for w in words for k in STEMS if len(w) >= k} | {f"{w}." for w in words}


def learned_lexicon(labelled: DataFrame, text: str = "text") -> dict[str, int]:
    """Thousandths of log-odds by beginning of a word, from all rows of ``labelled``
    (``label`` 0 or 1); at most STEMS_KEPT, of equal ones the first in alphabetical order.

    Counted by texts: each worker sums up what it reads, Spark adds the sums.
    """
    spark = labelled.sparkSession
    prepare(spark)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Counter(), Counter()

        def flush() -> pa.RecordBatch:
            stems = list(seen[0] | seen[1])
            counts = [pa.array([some[s] for s in stems], pa.int64()) for some in seen]
            return pa.RecordBatch.from_arrays(
                [pa.array(stems, pa.string()), *counts], names=["stem", "clean", "toxic"]
            )

        for batch in batches:
            for body, label in zip(*columns(batch, "_text", "label"), strict=True):
                seen[label].update(beginnings((body or "").casefold()))
            if len(seen[0]) + len(seen[1]) > STEMS_COUNTED:
                yield flush()
                seen = Counter(), Counter()
        yield flush()

    rows = labelled.select(F.col(text).alias("_text"), F.col("label").cast("int"))
    clean, toxic = rows.agg(F.count_if(F.col("label") == 0), F.count_if(F.col("label") == 1)).first()
    if not clean or not toxic:
        return {}
    counts = rows.mapInArrow(count, "stem string, clean long, toxic long")
    counts = counts.groupBy("stem").agg(F.sum("clean").alias("c"), F.sum("toxic").alias("t"))
    odds = F.log((F.col("t") + 0.5) / (toxic + 1)) - F.log((F.col("c") + 0.5) / (clean + 1))
    found = (
        counts.filter(F.col("t") >= STEM_TEXTS)
        .select("stem", F.round(1000 * odds).cast("int").alias("odds"))
        .filter(F.col("odds") >= 1000 * STEM_ODDS)
        .orderBy(F.desc("odds"), "stem")
        .limit(STEMS_KEPT)
    )
    return {r["stem"]: r["odds"] for r in found.collect()}


def bounded(rows: DataFrame, most: int) -> DataFrame:
    """All rows, or of more than ``most`` about so many, chosen by a hash of the doc_id."""
    n = rows.count()
    if n <= most:
        return rows
    draw = F.pmod(F.xxhash64(F.lit("bounded"), F.col("doc_id")), F.lit(1 << 30))
    return rows.filter(draw < int((1 << 30) * most / n))


# A worker's words, by the lexicon they were looked up in.
_HELD: dict[str, Words] = {}


def features(docs: DataFrame, learned: dict[str, int], text: str = "text") -> DataFrame:
    """``doc_id`` and ``features`` (doubles, named by FEATURES) of every row's whole text."""
    spark = docs.sparkSession
    prepare(spark)
    name, sent = uuid.uuid4().hex, spark.sparkContext.broadcast(learned)  # STEMS_KEPT at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _HELD:
            _HELD.clear()
            _HELD[name] = Words(sent.value)
        for batch in batches:
            rows = measured(columns(batch, "_text")[0], _HELD[name])
            offsets = np.arange(len(rows) + 1, dtype=np.int32) * len(FEATURES)
            found = pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.reshape(-1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), found], names=["doc_id", "features"]
            )

    docs = docs.select("doc_id", F.col(text).alias("_text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, features array<double>")


class ToxicityModel:
    """Trees and an isotonic curve, or one score for all where labels are of one kind."""

    def __init__(self, trees=None, curve=None, constant: float = 0.0):
        self.trees, self.curve, self.constant = trees, curve, constant

    @classmethod
    def learn(cls, rows: DataFrame, fold, training_rows: int = TRAINING_ROWS):
        """Learn from ``features`` and ``label`` (0 or 1); rows for which ``fold`` holds
        calibrate, the others grow trees.

        Beyond ``training_rows`` rows, as many are chosen by a hash of their doc_id.
        """
        kept = rows.select(
            array_to_vector("features").alias("features"),
            F.col("label").cast("double").alias("label"),
            fold.alias("calibrates"),
            "doc_id",
        )
        n, mean = rows.agg(F.count("label"), F.avg("label")).first()
        if not n or mean in (0.0, 1.0):
            return cls(constant=mean or 0.0)
        kept = bounded(kept, training_rows)
        grown = kept.filter(~F.col("calibrates"))
        if grown.select("label").distinct().count() < 2:
            return cls(constant=mean)
        trees = GBTClassifier(featuresCol="features", labelCol="label", **TREES).fit(grown)
        margins = _margins(trees, kept.filter("calibrates"))
        # equal margins are summed up before: a bounded number of rows is fitted
        points = margins.groupBy("margin").agg(
            F.avg("label").alias("label"), F.count(F.lit(1)).cast("double").alias("weight")
        )
        both = points.agg(F.min("label") < 1, F.max("label") > 0).first()
        if not all(both):  # nothing to calibrate on
            return cls(trees)
        fit = IsotonicRegression(featuresCol="margin", labelCol="label", weightCol="weight")
        return cls(trees, fit.fit(points))

    def score(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``score`` in place of ``features``."""
        others = [c for c in rows.columns if c != "features"]
        if self.trees is None:
            return rows.select(*others, F.lit(float(self.constant)).alias("score"))
        vectors = rows.select(*others, array_to_vector("features").alias("features"))
        found = _margins(self.trees, vectors)
        if self.curve is None:
            value = 1 / (1 + F.exp(-2 * F.col("margin")))
        else:
            found = self.curve.transform(found)
            value = F.col("prediction")
        value = F.least(F.greatest(value, F.lit(0.0)), F.lit(1.0))
        return found.select(*others, value.alias("score"))


def _margins(trees, rows: DataFrame) -> DataFrame:
    found = trees.transform(rows).withColumn(
        "margin", F.round(vector_to_array("rawPrediction")[1], MARGIN_DIGITS)
    )
    return found.drop("rawPrediction", "probability", "prediction")


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    teaching_rows: int = TEACHING_ROWS,
    training_rows: int = TRAINING_ROWS,
) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): ``doc_id``, ``held_out``, ``score`` and
    ``predicted`` (1 from a score of 0.5 on), learned from ``labels`` (doc_id, toxic) of
    rows outside the held-out fifth.

    NULL and empty texts have features of 0 and the score of such. Rows with a NULL toxic
    teach nothing; where label rows of one doc_id disagree, it counts as toxic. Repeated
    documents teach and are scored row by row. At most about ``teaching_rows`` labels
    teach the lexicon and ``training_rows`` the trees. Without labels all score 0; with labels of
    one kind, all get that kind's.
    """
    rest = crc_rest("doc_id", 5)
    known = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("label"))
    # teaching_rows bounds what is broadcast: a doc_id and a label each
    teachers = F.broadcast(bounded(known.filter(rest.isin(2, 3)), teaching_rows))
    learned = learned_lexicon(docs.select("doc_id", "text").join(teachers, "doc_id"))
    rows = stash(features(docs, learned), "toxicity-features")
    training = rows.filter(rest.isin(1, 4)).join(known, "doc_id")
    training = stash(training, "toxicity-training")
    model = ToxicityModel.learn(training, rest == 1, training_rows)
    return model.score(rows).select(
        "doc_id",
        (rest == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
