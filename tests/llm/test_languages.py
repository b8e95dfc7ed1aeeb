"""Mixtures of languages against a plain EM, and what a pipeline lets go."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidemark.llm import decontaminate, langid, ngram_join, quality

SMALL = "/root/testdata/sf0.01"
LETTERS = {"aa": "abcde", "bb": "fghij", "cc": "abcfgz"}


def made(rng, lang, n):
    """Words of two to six letters of a language's own."""
    words = ("".join(rng.choices(LETTERS[lang], k=rng.randrange(2, 7))) for _ in range(n))
    return " ".join(words)


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(1)
    rows = [
        (k, made(rng, lang, rng.choice([3, 30, 200])), lang)
        for k, lang in enumerate(rng.choices([*LETTERS], k=900))
    ]
    return rows


def frame(spark, rows):
    """With columns named as the stages name their own."""
    names = ("_score", "_quality", "_levels", "_kept", "_h", "_lang_pred", "_lang", "_source")
    names += ("_id", "_g", "column 0", "source")
    more = ", ".join(f"`{n}` string" for n in names)
    return spark.createDataFrame(
        [(*r, *names) for r in rows], f"doc_id long, text string, lang string, {more}"
    )


def plain_assess(model, text):
    """One document, word by word and trigram by trigram."""
    words = Counter(langid.words_of(text))
    if not words:
        return ("und", 0.0, None, 0)
    size = len(model.languages)

    def grams(word):
        points = [ord(c) for c in f" {word} "]
        for a, b, c in zip(points, points[1:], points[2:], strict=False):
            packed = np.array([a << 42 | b << 21 | c], np.uint64)
            yield int(langid.mix(packed)[0] % langid.BUCKETS)

    like = {w: [sum(model.log_p[k][g] for g in grams(w)) for k in range(size)] for w in words}
    n = sum(words.values())

    def fit(allowed):
        share = [1 / len(allowed) if k in allowed else 0.0 for k in range(size)]
        for _ in range(langid.ROUNDS):
            new = [0.0] * size
            for w, often in words.items():
                top = max(like[w])
                part = [s * math.exp(x - top) for s, x in zip(share, like[w], strict=True)]
                whole = max(sum(part), 1e-300)
                for k in range(size):
                    new[k] += often * part[k] / whole
            share = [x / n for x in new]
        value = 0.0
        for w, often in words.items():
            top = max(like[w])
            mixed = sum(s * math.exp(x - top) for s, x in zip(share, like[w], strict=True))
            value += often * (top + math.log(max(mixed, 1e-300)))
        return share, value

    full, _ = fit(range(size))
    order = sorted(range(size), key=lambda k: -full[k])
    price = langid.PENALTY * math.log(max(n, 2))
    best = None
    for count in range(1, size + 1):
        if count == 1:
            share = [float(k == order[0]) for k in range(size)]
            value = sum(often * like[w][order[0]] for w, often in words.items())
        else:
            share, value = fit(order[:count])
        if best is None or value - price * (count - 1) > best[0]:
            best = (value - price * (count - 1), share, value)
    _, share, value = best
    k = max(range(size), key=lambda k: share[k])
    told = value / sum(often * len(w) for w, often in words.items())
    return (model.languages[k], share[k], told, n)


def test_mixtures_equal_a_plain_em(spark, labelled):
    model = langid.LanguageModel.learn(frame(spark, labelled))
    counts = defaultdict(Counter)
    for _, text, lang in labelled:
        for word in langid.words_of(text):
            bucket, _ = langid.trigrams([word])
            counts[lang].update(bucket.tolist())
    for k, lang in enumerate(model.languages):
        n = np.array([counts[lang][b] for b in range(langid.BUCKETS)]) + langid.SMOOTH
        assert np.allclose(model.log_p[k], np.log(n / n.sum()))
    rng = random.Random(2)
    texts = [t for _, t, _ in labelled[:40]] + [None, "", "12 !", "q"]
    for _ in range(40):
        parts = [made(rng, rng.choice([*LETTERS]), rng.randrange(1, 60)) for _ in range(3)]
        texts.append(" ".join(parts))
    got = model.assess(texts)
    assert len({g[0] for g in got}) == 4 and any(0.4 < g[1] < 0.9 for g in got)
    for text, found in zip(texts, got, strict=True):
        want = plain_assess(model, text)
        assert (found[0], found[3]) == (want[0], want[3])
        assert found[1] == pytest.approx(want[1], abs=1e-6)
        assert found[2] is None and want[2] is None or found[2] == pytest.approx(want[2])
    assert model.predict(texts) == [g[:2] for g in got]


def test_what_no_learned_language_tells_goes(spark, labelled):
    rng = random.Random(3)
    odd = {
        5000: " ".join("".join(rng.choices("klmnopqrstuvwxy", k=5)) for _ in range(40)),
        5001: "これは日本語の文章です。" * 9,
        5002: "Это текст на языке, который никто не учил " * 3,
        5003: " ".join(made(rng, lang, 40) for lang in ("aa", "bb", "cc")),  # none prevails
        5004: None,
        5005: "77 ***",
    }
    kept = {5010: made(rng, "aa", 2) + " kx", 5011: made(rng, "bb", 70) + " qqq wv", 5012: "abc"}
    rows = [*labelled, *((k, t, None) for k, t in {**odd, **kept}.items())]
    docs = frame(spark, rows)
    found = langid.keep_known(docs)
    assert found.schema == docs.schema
    assert {r.doc_id for r in found.collect()} == {r[0] for r in rows} - {*odd}
    assert langid.keep_known(docs.limit(0)).collect() == []


def test_given_documents_stay(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    lost = docs.join(langid.keep_known(docs), "doc_id", "left_anti").collect()
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").filter("quality = 1").collect()
    assert not {r.doc_id for r in lost} & {r.doc_id for r in labels}
    assert len(lost) <= 0.01 * docs.count()


def test_stages_keep_columns_named_as_their_own(spark, labelled):
    rows = [*labelled[:60], labelled[5], (2000, labelled[7][1], "aa"), (None, None, None)]
    docs = frame(spark, rows)
    given = Counter(map(tuple, docs.collect()))
    items = spark.createDataFrame([(1, labelled[9][1])], "item_id long, text string")
    stages = (
        langid.keep_known,
        quality.keep_good,
        ngram_join.keep_one,
        lambda d: decontaminate.drop_leaks(d, items),
    )
    for stage in stages:
        kept = stage(docs)
        assert kept.schema == docs.schema
        found = Counter(map(tuple, kept.collect()))
        assert found and found - given == Counter()
