"""Operators that look at one text at a time, against plain versions and libraries."""

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import langid, licenses, pieces, quality
from tidemark.llm.common import word_list, word_hashes, windows
from tidemark.llm.queries import QUERIES, SQL, vocabulary

SMALL = "/root/testdata/sf0.001"
MODEL = vocabulary("piece_bpe_32k.model")
DOCS = "doc_id long, text string, lang string, source string, n_words string, Text2 string"
ODD = [
    (1, None, None, None, "x", "y"),
    (2, "", "en", "a", None, None),
    (3, " \n\t ", "en", "a", None, None),
    (4, "***", "fr", None, None, None),
    (5, "a b c a b c\na b c a b c\n\nA#b", "en", "a", None, None),
    (5, "a b c a b c\na b c a b c\n\nA#b", "en", "a", None, None),
    (None, "word " * 30_000, "en", "a", None, None),
    (7, "Zwölf ééé 日本語 \x00 ▁ x", "de", "b", None, None),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def test_words_are_cut_at_ascii_white_space_and_only_ascii_is_lowered():
    assert word_list("A B\x0bÉ\x1cc D") == ["a b".encode(), "É\x1cc".encode(), b"d"]
    assert word_list(None) == []


def test_windows_of_short_sequences_are_the_whole():
    one = windows(word_hashes([b"a", b"b"]), 3)
    assert len(one) == 1 and one[0] != windows(word_hashes([b"b", b"a"]), 3)[0]
    assert len(windows(word_hashes([]), 3)) == 0


# --- quality -----------------------------------------------------------------


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    often = Counter(zip(words, words[1:], words[2:]))
    inside = set()
    for k in range(len(words) - 2):
        if often[tuple(words[k : k + 3])] >= 2:
            inside |= {k, k + 1, k + 2}
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(inside),
    )


def test_quality_counts(spark, documents, odd):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    rows += [(r[0], r[1]) for r in ODD]
    table = documents.select("doc_id", "text", "lang", "source").unionByName(
        odd.select("doc_id", "text", "lang", "source")
    )
    got = quality.quality_report(table)
    assert got.columns == [
        *"doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words".split(),
        "base_failed",
        "kept",
    ]
    want = Counter(
        (i, *(c := plain_counts(t)), c[0] < 50 or 100 * c[4] > 50 * c[0]) for i, t in rows
    )
    found = got.collect()
    assert Counter(tuple(r)[:7] for r in found) == want
    assert not any(r.kept and r.base_failed for r in found)


def test_limits_follow_their_group(spark):
    def text(k, marks):
        words = [f"w{k}x{j}" for j in range(100)]
        return " ".join(w + "*" * (j < marks) for j, w in enumerate(words))

    # source a is plain, source b is full of symbols throughout
    rows = [(k, text(k, 0), "en", "a") for k in range(300)]
    rows += [(k, text(k, 60 + k % 40), "fr", "b") for k in range(300, 600)]
    rows += [(600, text(600, 90), "en", "a"), (601, text(601, 90), "fr", "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in quality.quality_report(docs).collect()}
    assert not kept[600] and kept[601] and sum(kept.values()) == 601


def test_quantiles_set_every_fence(spark):
    def text(k, length=5, upper=0, lines=0):
        letters = str.maketrans("0123456789", "abcdefghij")
        words = [f"{k:04d}{j:04d}".translate(letters) for j in range(100)]
        words = [w[-length - (j + k) % 3 :] for j, w in enumerate(words)]
        words = [w.upper() if j < upper + k % 4 else w for j, w in enumerate(words)]
        body = [" ".join(words[j : j + 10]) for j in range(0, 100, 10)]
        return "\n".join(body + body[:1] * lines)

    rows = [(k, text(k)) for k in range(400)]
    rows += [(400, text(400, upper=20)), (401, text(401, lines=2)), (402, text(402))]
    rows += [(403, " ".join(w + "abc" for w in text(403).split()))]  # 9 letters for 6
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "'en' as lang", "'a' as source"
    )
    rejected = {r.doc_id for r in quality.quality_report(docs).filter("not kept").collect()}
    assert rejected == {400, 401, 403}


def test_quality_of_nothing(spark, odd):
    assert quality.quality_report(odd.limit(0)).collect() == []
    assert quality.keep_good(odd.limit(0)).columns == odd.columns


def test_quality_stage_keeps_good_labels(spark, documents):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    kept = quality.keep_good(documents)
    assert kept.schema == documents.schema
    good = labels.filter("quality = 1").join(documents, "doc_id").filter("n_chars > 500")
    missed = good.join(kept, "doc_id", "left_anti").count()
    assert missed <= 0.02 * good.count()
    assert labels.filter("quality = 0").join(kept, "doc_id").count() <= 1


# --- pieces ------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def model():
    return pieces.Pieces(MODEL)


def same(model, library, text):
    want = library.encode(text, add_bos=True, add_eos=True)
    got = model.encode(text)
    assert np.frombuffer(got, "<u4").tolist() == want
    assert model.decode(got) == library.decode(want)


@settings(max_examples=400, deadline=None)
@given(st.text(st.sampled_from("abehinrst  ▁▁.,\n\t\r\x00é你😀$01{};"), max_size=60))
def test_pieces_equal_the_library(model, library, text):
    same(model, library, text)


def test_pieces_of_blank_runs_and_real_texts(model, library, documents):
    for k in range(40):
        same(model, library, " " * k + "x" + " " * k)
    for row in documents.select("text").collect():
        same(model, library, row.text)


def test_backtracking_leaves_positions_that_lead_nowhere(model, library):
    random.seed(5)
    for _ in range(300):
        same(model, library, "".join(random.choices("aeinorst", k=random.randint(1, 40))))


def test_coded_rows(spark, odd, library):
    got = pieces.digests(odd, MODEL).collect()
    assert len(got) == len(ODD)
    import hashlib
    import struct

    want = Counter()
    for row in ODD:
        ids = library.encode(row[1] or "", add_bos=True, add_eos=True)
        data = struct.pack(f"<{len(ids)}I", *ids)
        text = library.decode(ids).encode()
        digests = (hashlib.sha256(data).hexdigest(), hashlib.sha256(text).hexdigest())
        want[(row[0], len(ids), *digests)] += 1
    assert Counter(map(tuple, got)) == want
    assert pieces.coded(odd.limit(0), MODEL).collect() == []


# --- licences ----------------------------------------------------------------


def test_licences_equal_their_sql(spark, documents):
    got = QUERIES["op5_license_digests"](spark, SMALL)
    connection = duckdb.connect()
    connection.execute(
        f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SMALL}/documents.parquet')"
    )
    want = connection.sql(SQL["op5_license_digests"])
    columns = got.columns
    assert sorted(columns) == sorted(want.columns)
    rows = want.select(*columns).fetchall()
    assert Counter(map(tuple, got.collect())) == Counter(rows)


def test_licence_texts_in_other_guises(spark, odd):
    mit = licenses.TEXTS["MIT"]
    rows = [
        (1, mit),
        (2, "Copyright (c) 2020 Some One\n\n" + mit.upper().replace(",", " ,")),
        (3, mit.replace("sublicense", "sub-license").replace("\n\n", "\n")),
        (4, mit + " And more."),
        (5, "Intro\nReleased under the MIT Licence\nreleased under the MIT License!!\nend"),
        (6, None),
        (7, ""),
        (7, ""),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = licenses.scan(docs).orderBy("doc_id").collect()
    assert [r.license for r in found] == ["MIT"] * 3 + [None] * 5
    assert (found[4].n_license_lines, found[4].line_licenses) == (2, "MIT")
    assert found[5].text_digest is None and found[6].text_digest == found[7].text_digest
    assert licenses.scan(odd.limit(0)).collect() == []
    assert licenses.scan(odd).count() == len(ODD)
    assert licenses.scan(docs, {}).filter("license is not null").count() == 0


def test_licence_files_as_they_come(spark):
    owner = "Copyright (c) 2020, Some One\nAll rights reserved.\n\n"
    mit, bsd = licenses.TEXTS["MIT"], licenses.TEXTS["BSD-3-Clause"]
    bullets = re.sub(r"(?m)^[123]\. ", "  * ", bsd)
    apache, gpl, boost, zlib, mpl = (
        (licenses.FOLDER / f"{n}.txt").read_text()
        for n in ("Apache-2.0", "GPL-3.0", "BSL-1.0", "Zlib", "MPL-2.0")
    )
    cases = [
        ("MIT", f"MIT License\n\n{owner}{mit}\n"),
        ("MIT", f"# The MIT License (MIT)\n{owner}{mit}"),
        ("BSD-3-Clause", f"BSD 3-Clause License\n\n{owner}{bsd}"),
        ("BSD-3-Clause", f"{owner}{bullets}"),
        ("BSD-2-Clause", re.sub(r"(?m)^([12])\. ", r"(\1) ", licenses.TEXTS["BSD-2-Clause"])),
        ("Apache-2.0", apache.replace("[yyyy] [name of copyright owner]", "2020 Some One")),
        ("Apache-2.0", apache[: apache.index("   APPENDIX")]),
        ("Apache-2.0", apache.replace("http://", "https://").replace("\n", "\r\n")),
        ("GPL-3.0", gpl),
        ("BSL-1.0", boost),
        ("Zlib", f"zlib License\n\n{owner}{zlib}"),
        ("MPL-2.0", mpl),
        (None, f"Some other License\n\n{owner}{mit}"),
        (None, apache.replace("perpetual", "temporary")),
    ]
    docs = spark.createDataFrame(
        [(k, t) for k, (_, t) in enumerate(cases)], "doc_id long, text string"
    )
    found = licenses.scan(docs).orderBy("doc_id").collect()
    assert [r.license for r in found] == [n for n, _ in cases]
    header = '# Licensed under the Apache License, Version 2.0 (the "License");\nx'
    marks = "// SPDX-License-Identifier: GPL-2.0-only\n/* SPDX-License-Identifier: MIT */"
    docs = spark.createDataFrame([(1, header), (2, marks)], docs.schema)
    lines = {r.doc_id: r.line_licenses for r in licenses.scan(docs).collect()}
    assert lines == {1: "Apache-2.0", 2: "GPL-2.0-only,MIT"}


def test_licences_stay_in_the_engine(spark, documents):
    plan = licenses.scan(documents)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|RDD", plan)


# --- languages ---------------------------------------------------------------


def test_held_out_languages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.predicted_languages(docs).join(docs.select("doc_id", "lang"), "doc_id")
    rows = got.filter("held_out").collect()
    assert len(rows) > 200
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.98 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_shares_of_a_mixed_text(spark, documents):
    learned = langid.LanguageModel.learn(documents)
    of = {
        k: " ".join(
            r.text for r in documents.filter(f"lang = '{k}'").select("text").limit(4).collect()
        ).split()[:300]
        for k in ("en", "de")
    }
    for n in (0, 75, 150, 300):
        (name, share), *_ = learned.predict([" ".join(of["de"][:n] + of["en"][: 300 - n])])
        assert abs(share - max(n, 300 - n) / 300) < 0.12
        assert n == 150 or name == ("de" if n > 150 else "en")


def test_texts_without_letters_and_without_labels(spark, odd):
    rows = langid.predicted_languages(odd).collect()
    assert len(rows) == len(ODD)
    unknown = {r.doc_id for r in rows if r.lang_pred == langid.UNKNOWN}
    assert unknown >= {1, 2, 3, 4}
    assert all(r.score == 0 for r in rows if r.lang_pred == langid.UNKNOWN)
    bare = odd.select("doc_id", "text").selectExpr("*", "cast(null as string) as lang")
    assert {r.lang_pred for r in langid.predicted_languages(bare).collect()} == {"und"}
    assert langid.predicted_languages(odd.limit(0)).collect() == []
    assert langid.keep_known(odd).columns == odd.columns


def test_known_digests_are_those_of_the_column_function(spark):
    texts = [*licenses.known_texts(), "", "Ärger © 2020\n  (C) me\nＡ①x", "©\nnon-infringement"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    want = [r[0] for r in rows.select(licenses.digest(rows["text"])).collect()]
    assert [licenses.digest_of(t) for t in texts] == want
    plan = licenses.scan(rows.selectExpr("1 AS doc_id", "text"))
    assert len(plan._jdf.queryExecution().optimizedPlan().toString()) < 200_000
