"""The corpus pipeline, stage by stage against plain versions of each."""

from collections import Counter

import numpy as np
import pytest
import sentencepiece
from test_corpus_operators import plain_classes, plain_leaks
from test_text_operators import plain_counts

import corpus_pipeline
from tidemark.llm import langid
from tidemark.llm.queries import QUERIES, SQL, vocabulary

SMALL = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output of every stage, with rows that are hard to handle."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    text = docs.filter("n_chars between 900 and 2000").orderBy("doc_id").first().text
    item = spark.read.parquet(f"{SMALL}/benchmark.parquet").first().text
    odd = [
        (9000, None, None, None, None),
        (9001, "", "en", "src0", 0),
        (9002, "*** " * 80, "en", "src0", 0),
        (9003, text, "en", "src0", 0),
        (9003, text, "en", "src0", 0),
        (9004, text + " more", None, None, None),
        (9005, f"{text[:400]} new words here {item.lower()} and so on", "en", "src0", 0),
        (9006, text.upper(), "en", "src0", 0),
        (None, text + " less", "en", "src0", 0),
    ]
    given = docs.unionByName(spark.createDataFrame(odd, COLUMNS))
    out = []
    for name, stage in corpus_pipeline.STAGES:
        kept = stage(spark, given, SMALL)
        kept = spark.createDataFrame(kept.collect(), kept.schema)
        out.append((name, given, kept))
        given = kept
    return out


def ids(df):
    return Counter(r[0] for r in df.select("doc_id").collect())


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_stages_are_named_and_keep_the_columns(stages):
    assert [n for n, _, _ in stages] == [
        "language ID",
        "quality rules",
        "n-gram Jaccard join",
        "benchmark decontamination",
        "SentencePiece encoding and decoding",
    ]
    for _, given, kept in stages[:-1]:
        assert kept.schema == given.schema
        assert set(map(tuple, kept.collect())) <= set(map(tuple, given.collect()))


def test_language(stages):
    _, given, kept = stages[0]
    lost = ids(given) - ids(kept)
    assert lost == Counter([9000, 9001, 9002])
    assert langid.words_of("*** 12") == []


def test_quality(stages, spark):
    _, given, kept = stages[1]
    lost = ids(given) - ids(kept)
    for doc_id, text in pairs(given):
        words, _, symbols, _, repeats = plain_counts(text)
        if words < 50 or 2 * repeats > words:
            assert lost[doc_id]
    assert lost[9006] == 1  # all capitals
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    good = {r.doc_id for r in labels.filter("quality = 1").collect()}
    long = {i for i, t in pairs(given) if plain_counts(t)[0] >= 50 and i in good}
    assert not long & set(lost)


def test_near_copies(stages):
    _, given, kept = stages[2]
    found = plain_classes(pairs(given), 5, 80, 100)
    want = Counter({i: 1 for i, _, first in found if i == first})
    assert ids(kept) == want


def test_benchmark(stages, spark):
    _, given, kept = stages[3]
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    bad = {i for i, _, _ in plain_leaks(pairs(given), items)}
    assert 9005 in bad and len(bad) > 1
    assert ids(kept) == Counter(i for i, _ in pairs(given) if i not in bad)


def test_token_ids(stages):
    _, given, kept = stages[4]
    library = sentencepiece.SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model"))
    texts = dict(pairs(given))
    rows = kept.collect()
    assert len(rows) == given.count()
    for row in rows:
        want = library.encode(texts[row.doc_id], add_bos=True, add_eos=True)
        assert np.frombuffer(row.ids, "<u4").tolist() == want
        assert (row.n_tokens, row.decoded) == (len(want), library.decode(want))


def test_run_is_its_stages(spark):
    given = spark.read.parquet(f"{SMALL}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        given = stage(spark, given, SMALL)
    got = corpus_pipeline.run(spark, SMALL)
    assert got.columns == ["doc_id", "n_tokens", "ids", "decoded"]
    assert Counter(map(str, got.collect())) == Counter(map(str, given.collect()))


def test_no_documents(spark):
    given = spark.createDataFrame([], COLUMNS)
    for _, stage in corpus_pipeline.STAGES:
        given = stage(spark, given, SMALL)
        assert given.collect() == []


def test_all_queries_are_registered():
    import __spark_entry__ as entry

    assert len(QUERIES) == 13 and SQL.keys() <= QUERIES.keys()
    assert {*QUERIES, "pipeline"} <= entry.queries().keys()
    assert SQL.keys() <= entry.oracle_sql().keys()
