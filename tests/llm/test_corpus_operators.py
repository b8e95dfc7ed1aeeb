"""Operators that look at a whole corpus, and those that write files."""

import base64
import hashlib
import math
import random
import struct
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import (
    common,
    decontaminate,
    kneser_ney,
    main_text,
    ngram_join,
    pieces,
    token_files,
    warc,
)
from tidemark.llm.common import crc_rest, opened, scratch_dir, uri, word_list
from tidemark.llm.queries import SQL, vocabulary

SMALL = "/root/testdata/sf0.001"
IDS = vocabulary("byte_bpe_50k.json")


def table(spark, rows, schema="doc_id long, text string"):
    """With columns whose names clash with those of results."""
    more = "n_tokens string, score string, component_id string, part string, file string"
    return spark.createDataFrame([(*r, *"abcde") for r in rows], f"{schema}, {more}")


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


# --- language model ------------------------------------------------------------


def plain_model(training):
    pairs, after, words = Counter(), Counter(), Counter()
    for text in training:
        found = [*word_list(text), None]
        words.update(found)
        for pair in zip([..., *found], found, strict=False):
            pairs[pair] += 1
            after[pair[0]] += 1

    def steps(counts):
        n = Counter(counts)
        return kneser_ney.discounts(n[1], n[2], n[3], n[4])

    before = Counter(v for _, v in pairs)
    d, e = steps(pairs.values()), steps(before.values())
    rest = sum(e[min(n, 3) - 1] for n in before.values()) / max(len(pairs), 1)
    left = defaultdict(float)
    for (u, _), n in pairs.items():
        left[u] += d[min(n, 3) - 1]

    def lower(v):
        n = before[v]
        own = max(n - e[min(n, 3) - 1], 0) / len(pairs) if n else 0
        return own + (rest if pairs else 1) / (len(words) + 1)

    def p(u, v):
        if not after[u]:
            return lower(v)
        n = pairs[u, v]
        own = max(n - d[min(n, 3) - 1], 0) if n else 0
        return (own + left[u] * lower(v)) / after[u]

    return words, p


def check_scores(rows, got):
    training = [t for i, t in rows if zlib.crc32(str(i or "").encode()) % 7 != 2]
    words, p = plain_model(training)
    n, v = sum(words.values()), len(words)
    want = []
    for i, text in rows:
        found = [*word_list(text), None]
        want.append(
            (
                -1 if i is None else i,
                zlib.crc32(str(i or "").encode()) % 7 == 2,
                len(found),
                sum(words[w] > 0 for w in found),
                n,
                sum(math.log10((words[w] + 1) / (n + v + 1)) for w in found),
                sum(math.log10(p(u, w)) for u, w in zip([..., *found], found, strict=False)),
            )
        )
    got = sorted((-1 if r[0] is None else r[0], *r[1:]) for r in map(tuple, got.collect()))
    assert len(got) == len(want)
    for a, b in zip(got, sorted(want), strict=True):
        assert a[:5] == b[:5]
        assert a[5:] == pytest.approx(b[5:], rel=1e-9, abs=1e-9)
    return p, words


def test_language_model_equals_a_plain_one(spark, documents, monkeypatch):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    rows += [(1000, None), (1001, ""), (1002, " \n"), (1003, "the THE tHe " * 2000), (0, "twice")]
    # many small pieces of work, and frequent words spread over all slices
    monkeypatch.setattr(kneser_ney, "TEXT_AT_ONCE", 20_000)
    monkeypatch.setattr(kneser_ney, "TEXT_PER_SLICE", 40_000)
    p, words = check_scores(rows, kneser_ney.lm_scores(table(spark, rows)))
    assert sum(p(b"the", w) for w in words) + p(b"the", b"unseen") == pytest.approx(1)


def test_language_model_of_little(spark):
    check_scores([(1, None), (2, "")], kneser_ney.lm_scores(table(spark, [(1, None), (2, "")])))
    assert kneser_ney.lm_scores(table(spark, []).limit(0)).collect() == []
    # nothing to learn from: all are held out
    held = [(i, "a b") for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2]
    check_scores(held, kneser_ney.lm_scores(table(spark, held)))


def test_counts_over_a_byte(spark):
    rows = [(k, "x y " * 400) for k in range(10)]
    check_scores(rows, kneser_ney.lm_scores(table(spark, rows)))


# --- joins -----------------------------------------------------------------------


def plain_classes(rows, size, num, den):
    sets = ngram_join.sets_of([t for _, t in rows], size)
    sets = [set(s.tolist()) for s in sets]
    parent = list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and den * both >= num * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        k = root(k)
        ids = [x for x in (least.get(k), i) if x is not None]
        least[k] = min(ids) if ids else None
    return Counter((i, len(sets[k]), least[root(k)]) for k, (i, _) in enumerate(rows))


@pytest.mark.parametrize("size,num,few,block", [(3, 90, 8, 256), (5, 80, 2, 3), (2, 70, 1, 4)])
def test_classes_equal_all_pairs(spark, monkeypatch, size, num, few, block):
    monkeypatch.setattr(ngram_join, "FEW", few)
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", block)
    monkeypatch.setattr(ngram_join, "BLOCK_SKETCHES", block + 1)
    rng = random.Random(size)
    words = [f"w{k}" for k in range(400)]
    rows = [(None, None), (1, ""), (2, "one"), (3, "one"), (4, "one two"), (4, "one two")]
    for group in range(24):
        base = rng.choices(words, k=rng.choice([3, 8, 15, 40, 120]))
        for _ in range(rng.choice([1, 2, 5, 12])):
            text = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 25))):
                text[rng.randrange(len(text))] = rng.choice(words)
            if rng.random() < 0.2:
                text += rng.choices(words, k=rng.randint(1, 9))
            rows.append((1000 - len(rows), " ".join(text)))
    got = ngram_join.classes(table(spark, rows), size, num, 100)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert Counter(map(tuple, got.collect())) == plain_classes(rows, size, num, 100)


def test_no_linked_pair_is_without_a_key():
    rng = random.Random(3)
    with pytest.raises(ValueError, match="between"):
        ngram_join.Groups(69, 100)
    for num in (70, 80, 90):
        for most in [60] * 400 + [2000] * 30:
            n = rng.randint(1, most)
            base = np.array(rng.sample(range(1 << 62), n + n // 2 + 9), np.uint64)
            base <<= np.uint64(2)  # hashes fill their range
            cut = rng.randint(0, n // 5)
            a, b = np.sort(base[:n]), np.sort(base[cut : n + rng.randint(0, n // 5)])
            both, either = len(np.intersect1d(a, b)), len(np.union1d(a, b))
            if 100 * both < num * either or (len(a) == len(b) and (a == b).all()):
                continue
            groups = ngram_join.Groups(num, 100)
            key, who = ngram_join.keys_of([a, b], groups)
            assert set(key[who == 0].tolist()) & set(key[who == 1].tolist())


def test_shared_keys_are_found_in_slices(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "SLICES", 32)
    monkeypatch.setattr(ngram_join, "SLICES_PER_TASK", 2)
    rng = random.Random(5)
    base = [rng.choices([f"w{k}" for k in range(300)], k=80) for _ in range(20)]
    texts = [None, "", "one", "one"]
    for k in range(3000):  # exact copies, near ones and single texts, in many batches
        text = rng.choice(base) if k % 3 else rng.choices([f"v{k}" for k in range(900)], k=60)
        texts.append(" ".join([*text, str(rng.randrange(9))] if k % 2 else text))
    groups = ngram_join.Groups(80, 100)
    sets = {ngram_join.set_id(s): s for s in ngram_join.sets_of(texts, 3) if len(s)}
    key, who = ngram_join.keys_of(list(sets.values()), groups)
    posters = defaultdict(set)
    for x, k in zip(key.view(np.int64).tolist(), who.tolist(), strict=True):
        posters[x].add(k)
    docs = table(spark, enumerate(texts)).repartition(4)
    before = spark.conf.get(common.ROWS_CONF)
    spark.conf.set(common.ROWS_CONF, "100")
    try:
        rows = ngram_join.posted(docs, 3, groups).collect()
        got = [r.key for r in ngram_join.shared_keys(ngram_join.posted(docs, 3, groups)).collect()]
    finally:
        spark.conf.set(common.ROWS_CONF, before)
    # a row holds many keys: rows of one key each filled the memory of a task that groups them
    assert len(rows) <= 32 * (len(texts) // 100 + 4) < len(posters) / 10
    for r in rows:
        assert len(r["keys"]) == len(r.marks) and max(Counter(r["keys"]).values()) <= 2
    assert {x for r in rows for x in r["keys"]} == set(posters)
    assert len(got) == len(set(got))
    assert set(got) == {x for x, some in posters.items() if len(some) > 1}
    none = ngram_join.posted(table(spark, []).limit(0), 3, groups)
    assert ngram_join.shared_keys(none).collect() == []


def test_batches_are_worked_on_in_parts(monkeypatch):
    monkeypatch.setattr(common, "TEXT_AT_ONCE", 5)
    texts = ["abc", None, "defgh", "", "x" * 30, "ä", None]
    batch = pa.record_batch({"id": list(range(7)), "text": texts})
    got = [p.column(1).to_pylist() for p in common.parts(batch, "text")]
    assert got == [texts[:3], texts[3:5], texts[5:6], texts[6:]]
    assert list(common.parts(batch.slice(7), "text")) == []


def test_workers_let_go_of_what_another_operator_remembered():
    common.word_hashes([b"one", b"two"])
    assert len(common._HASHES) >= 2
    model = pieces.pieces(vocabulary("piece_bpe_32k.model"))
    common.remembers(model.forget)
    assert not common._HASHES
    model.encode("three words here")
    common.remembers(model.forget)
    assert model.words
    common.word_hashes([b"one"])
    assert not model.words and not model.pairs and common._HASHES


def test_sketches_rule_out_no_link():
    rng = random.Random(4)
    for num in (60, 80, 90):
        base = rng.sample(range(1 << 62), 3000)
        sets = []
        for k in range(40):
            n = rng.randint(1, 300) if k < 30 else rng.randint(900, 3000)
            own = base[: n - n // 8] + rng.sample(range(1 << 62), n // 8)
            sets.append(np.sort(np.array(own, np.uint64)))
        n = np.array([len(s) for s in sets])
        linked = ngram_join.by_overlap(sets, num, 100)
        for a in range(40):
            for b in range(40):
                both, either = (len(f(sets[a], sets[b])) for f in (np.intersect1d, np.union1d))
                assert linked[a, b] == (100 * both >= num * either)
        near = ngram_join.by_sketch(ngram_join.sketches(sets), n, num, 100)
        assert not (linked & ~near).any() and (~near).sum() > 100


def test_classes_equal_their_sql(spark, documents):
    connection = duckdb.connect()
    connection.execute(
        f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SMALL}/documents.parquet')"
    )
    got = ngram_join.classes(documents)
    want = connection.sql(SQL["op3_ngram_jaccard"]).select(*got.columns).fetchall()
    assert Counter(map(tuple, got.collect())) == Counter(want)


def test_one_of_each_class_stays(spark):
    text = " ".join(f"w{k}" for k in range(60))
    rows = [(5, text), (3, text + " x"), (3, text + " x"), (9, "other words here"), (None, None)]
    kept = ngram_join.keep_one(table(spark, rows))
    assert kept.columns == table(spark, rows).columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([3, 9, None])
    assert ngram_join.keep_one(table(spark, []).limit(0)).collect() == []


# --- decontamination -------------------------------------------------------------


def plain_leaks(rows, items):
    words = decontaminate.plain_words

    def runs(found):
        n = min(5, len(found))
        return {tuple(found[k : k + n]) for k in range(len(found) - n + 1)} if found else set()

    out = Counter()
    for i, text in rows:
        found = words(text)
        for item, body in items:
            wanted = runs(words(body))
            n = min(5, len(words(body)))
            here = {tuple(found[k : k + n]) for k in range(len(found) - n + 1)} if n else set()
            if wanted and len(wanted & here) >= 0.8 * len(wanted):
                out[(i, item, len(wanted & here) / len(wanted))] += 1
    return out


def test_leaks_equal_all_pairs(spark, documents):
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    rng = random.Random(1)
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    vocabulary = [w for _, t in rows[:20] for w in t.split()]
    for k in range(60):  # planted whole, edited and cut, at any place
        found = rng.choice(items)[1].split()
        if k % 3 == 1:
            found[rng.randrange(len(found))] = "edited"
        if k % 3 == 2:
            found = found[: len(found) * 2 // 3]
        noise = rng.choices(vocabulary, k=300)
        at = rng.randrange(300)
        rows.append((1000 + k, " ".join(noise[:at] + found + noise[at:]).upper()))
    long = " ".join(rng.sample(vocabulary, 300))
    items += [(500, long), (501, None), (502, ""), (503, "Unheard of."), (504, long)]
    rows += [(2000, f"before {long} after"), (2001, "it is unheard of!"), (2002, None), (2003, "")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.leaks(table(spark, rows), benchmark).collect()
    assert Counter((r.doc_id, r.item_id, r.overlap) for r in got) == plain_leaks(rows, items)
    assert {r.item_id for r in got if r.doc_id == 2000} >= {500, 504}
    bad = {r.doc_id for r in got}
    kept = decontaminate.drop_leaks(table(spark, rows), benchmark)
    assert Counter(r.doc_id for r in kept.collect()) == Counter(
        i for i, _ in rows if i not in bad
    )


def test_recased_items_are_found_in_every_language(spark):
    import unicodedata

    benchmark = spark.read.parquet("/root/testdata/sf0.1/benchmark.parquet")
    items = [tuple(r) for r in benchmark.collect() if not r.text.isascii()]
    assert len(items) > 50
    forms = [
        str.upper,
        str.title,
        str.lower,
        lambda t: unicodedata.normalize("NFD", t),
        lambda t: "»" + t.replace(" ", "\u201c \u2014\u2026"),
    ]
    planted = {
        (100_000 + 1000 * n + k, item, f"before it {form(text)} and after")
        for n, form in enumerate(forms)
        for k, (item, text) in enumerate(items)
    }
    rows = [(i, text) for i, _, text in planted]
    # words are cut at marks alone: letters beyond ASCII stay whole
    assert decontaminate.plain_words("„STRASSE“ – Straße, ÉTÉ\u00a0été\ud800") == [
        w.encode() for w in "strasse strasse été été".split()
    ]
    docs = table(spark, rows)
    found = {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, benchmark).collect()}
    assert {(i, item) for i, item, _ in planted} <= found
    assert decontaminate.drop_leaks(docs, benchmark).collect() == []


def test_all_items_above_the_threshold_are_retrieved():
    rng = random.Random(2)
    words = [f"w{int(rng.paretovariate(0.7))}" for _ in range(3000)]
    items = [(k, " ".join(rng.choices(words, k=rng.randint(3, 60)))) for k in range(90)]
    index = decontaminate.Index(items)
    impact = defaultdict(dict)
    for word, k in index.words.items():
        for piece in index.pieces[index.first[k] : index.first[k] + index.sizes[k]]:
            impact[word].update(piece)
    for _ in range(60):
        text = rng.choices(words, k=rng.randint(1, 200))
        text = [w.encode() for w in [*text, *rng.choice(items)[1].split()]]
        want = {}
        step, size = decontaminate.STEP, decontaminate.PASSAGE
        for at in range(0, max(len(text) - step, 1), step):
            scores = Counter()
            for word in set(text[at : at + size]):
                for part, x in impact.get(word, {}).items():
                    scores[index.owner[part]] += x
            for item, x in scores.items():
                if x >= decontaminate.LEAST_SCORE:
                    want[(0, item)] = max(want.get((0, item), 0), x)
        assert index.retrieve([text]) == pytest.approx(want)


def test_no_items_and_no_documents(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = table(spark, [(1, "a b c")])
    assert decontaminate.leaks(docs, none).collect() == []
    assert decontaminate.drop_leaks(docs, none).count() == 1
    some = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert decontaminate.leaks(docs.limit(0), some).collect() == []


def test_many_indexes_find_the_same(spark, documents, monkeypatch):
    benchmark = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    whole = Counter(map(tuple, decontaminate.leaks(documents, benchmark).collect()))
    monkeypatch.setattr(decontaminate, "ITEMS_AT_ONCE", 15)
    cut = Counter(map(tuple, decontaminate.leaks(documents, benchmark).collect()))
    assert whole and cut == whole  # scores too


# --- main text ---------------------------------------------------------------------

PAGE = "page_id long, url string, html string"


def extracted(spark, pages):
    docs = spark.createDataFrame(pages, PAGE).selectExpr("*", "'x' as text", "'y' as host")
    return {r.page_id: r.text for r in main_text.extract(docs).collect()}


def test_articles_of_given_pages(spark, monkeypatch):
    import re
    from html import unescape

    monkeypatch.setattr(main_text, "GROUP_BYTES", 20_000)  # hosts in several groups
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    got = {r.page_id: r for r in main_text.extract(pages).collect()}
    rows = pages.collect()
    assert got.keys() == {r.page_id for r in rows}
    for row in rows:
        article = re.search("<article>(.*?)</article>", row.html, re.S)[1]
        parts = re.split("</?(?:p|h1)>", article.replace("<br>", " "))
        parts = [" ".join(unescape(re.sub("<[^>]*>", "", p)).split()) for p in parts]
        text = "\n".join(p for p in parts if p)
        assert (got[row.page_id].text, got[row.page_id].n_chars) == (text, len(text))
        assert got[row.page_id].url == row.url


def test_what_a_host_repeats_goes(spark):
    top = "<div>Welcome to the one and only site about all things great</div>"
    end = "<p>This site uses many things and you agree to all of them now</p>"
    own = [
        "Cats sleep through most of the day and hunt at night in the garden.",
        "Dogs need a walk in the morning and another one before it gets dark.",
        "Fish are quiet, which is more than can be said of the parrot upstairs.",
        "Horses stand asleep. Nobody has told them that lying down is easier.",
    ]
    pages = [(k, f"http://h.example/{k}", f"<body>{top}<p>{t}</p>{end}") for k, t in enumerate(own)]
    pages.append((9, "http://other.example/", f"<body>{top}<p>{own[0]}</p>{end}"))
    pages.append((10, "http://twin.example/a", f"<body>{top}<p>{own[0]}</p>"))
    pages.append((11, "http://twin.example/b", f"<body>{top}<p>{own[0]}</p>"))
    got = extracted(spark, pages)
    assert [got[k] for k in range(4)] == own
    assert own[0] in got[9] and "Welcome" in got[9]  # one page says nothing of its host
    assert got[10] == got[11] and own[0] in got[10]  # nor do equal pages


def test_suffix_arrays_equal_brute_force():
    rng = random.Random(12)
    for _ in range(300):
        n, letters = rng.randrange(60), rng.choice([1, 2, 5])
        ids = [rng.randrange(-2, letters) for _ in range(n)]
        if n > 20:
            ids[10:18] = ids[:8]
        order, common = main_text.suffix_array(np.array(ids, np.int64))
        assert order.tolist() == sorted(range(n), key=lambda k: ids[k:])
        want = [0] * n
        for k in range(1, n):
            a, b = ids[order[k - 1] :], ids[order[k] :]
            while want[k] < min(len(a), len(b)) and a[want[k]] == b[want[k]]:
                want[k] += 1
        assert common.tolist() == want


def plain_repeated(pages):
    """Every run of every length, counted in distinct pages."""
    run, least_run = main_text.RUN, {}
    distinct = {tuple((b.tag, b.text) for b in p): p for p in pages}
    streams = [
        [(t, k) for k, b in enumerate(p) for t in (f"<{b.tag}>", *b.text.split(" "))]
        for p in distinct.values()
    ]
    least = max(2, min(main_text.MANY, math.ceil(main_text.SHARED_BY * len(distinct))))
    where = defaultdict(set)
    for i, s in enumerate(streams):
        for at in range(len(s) - run + 1):
            where[tuple(t for t, _ in s[at : at + run])].add(i)
    for key, s in zip(distinct, streams, strict=True):
        hit = [False] * len(s)
        for at in range(len(s) - run + 1):
            if len(where[tuple(t for t, _ in s[at : at + run])]) >= least:
                hit[at : at + run] = [True] * run
        marks = []
        for k, block in enumerate(key):
            mine = [h for (_, owner), h in zip(s, hit, strict=True) if owner == k]
            often = sum(block in other for other in distinct)
            if often >= main_text.EDGE_PAGES:
                marks.append(2)
            elif len(mine) < run and often >= least:
                marks.append(1)
            else:
                marks.append(int(sum(mine) >= main_text.COVERED * len(mine)))
        least_run[key] = marks
    return [least_run[tuple((b.tag, b.text) for b in p)] for p in pages]


@pytest.mark.parametrize("n", [1, 2, 5, 40])
def test_repeated_runs_equal_brute_force(n):
    rng = random.Random(n)
    stock = [" ".join(rng.choices("abcdefgh", k=rng.randrange(1, 25))) for _ in range(12)]
    pages = []
    for _ in range(n):
        texts = []
        for _ in range(rng.randrange(1, 9)):
            text = rng.choice(stock)
            if rng.random() < 0.4:
                text = " ".join(rng.choices("abcdefghijklmnop", k=rng.randrange(1, 20)))
            if rng.random() < 0.3:
                text += " " + rng.choice(stock)
            texts.append(text)
        pages.append([main_text.Block(rng.choice(["p", "div"]), t, 0, False) for t in texts])
    pages += pages[:2]
    assert main_text.repeated(pages) == plain_repeated(pages)


def test_texts_do_not_depend_on_what_is_looked_at_together(spark, monkeypatch):
    rng = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyz"
    footer = "All rights to everything said here are kept by those who said it first"
    rare = "Seven pages alone have these words and so they stay on each of them"
    pages = []
    for k in range(200):
        own = " ".join(rng.choices(letters, k=60))
        extra = f"<p>{footer}</p>" * (k % 20 == 0) + f"<p>{rare}</p>" * (k < 7)
        host = f"http://{'ab'[k % 2]}.example/{k}"
        pages.append((k, host, f"<p>{own}</p>{extra}"))
        if k < 7:  # equal pages count once, whatever their markup
            pages += [(1000 * n + k, host, f"<p id=x{n}>{own}</p>{extra}") for n in range(1, 4)]
    pages += [(500 + k, f"http://c.example/{k}", f"<p>{footer}</p><p>Own {k}.</p>") for k in range(2)]
    whole = extracted(spark, pages)
    assert not any(footer in whole[k] for k in range(0, 200, 20))
    assert all(rare in whole[k] for k in range(7))
    assert whole[500] == "Own 0."
    monkeypatch.setattr(main_text, "GROUP_BYTES", 500)
    assert extracted(spark, pages) == whole


def test_a_footer_on_a_fifth_of_a_host(spark):
    rng = random.Random(3)
    footer = "All rights to everything said here are kept by those who said it first"
    pages = []
    for k in range(200):
        own = " ".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=60))
        pages.append((k, f"http://h.example/{k}", f"<p>{own}</p>" + f"<p>{footer}</p>" * (k % 5 == 0)))
    got = extracted(spark, pages)
    assert not any(footer in text for text in got.values())
    assert all(len(text.split()) == 60 for text in got.values())


def test_short_blocks_at_the_edges_of_articles(spark):
    """Lines of the site's go; titles, passages within and long ones stay."""
    words = "one two three four five six seven eight nine ten eleven twelve thirteen".split()
    shared = "A passage that every article of this site quotes, and a long one at that, indeed."
    pages = []
    for k in range(20):
        own = f"<p>{' '.join(words[(k + j * 7) % 13] for j in range(30))} {k}</p>"
        body = f"<p>Share this page</p><h2>News</h2>{own}<p>Share this page</p>{own}"
        body += f"<p>{shared}</p><p>He said so.</p><div>Read more</div>"
        pages.append((k, f"http://h.example/{k}", f"<article>{body}</article>"))
    pages.append((50, "http://few.example/", "<article><p>Share this page</p></article>"))
    got = extracted(spark, pages)
    for k in range(20):
        lines = got[k].split("\n")
        assert lines[0] == "News" and lines[-2:] == [shared, "He said so."]
        assert lines.count("Share this page") == 1
    assert got[50] == "Share this page"


@pytest.mark.parametrize(
    "html",
    [
        "<div class='widget'>x" * 3000 + "</div>" * 3000,
        "<div class='widget'>x" * 20_000,
        "<div>" * 10_000 + "<li class='ad'>y" * 10_000,
        "<li class='x'><ul>" + "<div>" * 10_000 + "<li>z" * 10_000,
        "<b class='ad'>" * 20_000 + "t" + "</b>" * 20_000,
        "</section>" * 20_000,
    ],
)
def test_deep_pages_take_time_in_proportion(html):
    import time

    began = time.process_time()
    main_text.blocks(html)
    assert time.process_time() - began < 2


def test_marked_parts_go_and_article_parts_stay(spark):
    html = """<html><head><title>T</title><style>p{}</style></head><body class="has-sidebar">
    <header>Site</header><nav><a>Menu</a></nav><div class="cookie-notice">We bake</div>
    <article><h1>Head &amp; tail</h1><p>One&nbsp;two<br>three <b>four</b>.<p>Five
      six<div class="ad-box">Buy</div><ul><li>a<li>b</ul><script>x("</p>")</script>
      <form><input>Send</form><aside>Also</aside></article>
    <div id="comments"><article>First!</article></div><footer>End</footer></body></html>"""
    got = extracted(spark, [(1, "http://x.example/", html), (2, None, None), (3, "x", "")])
    assert got[1] == "Head & tail\nOne two three four.\nFive six\na\nb"
    assert got[2] == got[3] == ""


def test_class_words_do_not_lose_articles(spark):
    article = "<article><h1>Title</h1><p>The text of it all.</p></article>"
    rest = "<nav>Menu</nav><div class='sidebar'>Other things to read</div>"
    around = [
        '<div class="content no-sidebar">%s</div>',
        '<div id="page" class="has-sidebar">%s</div>',
        '<section class="post social-science">%s</section>',
        '<div class="share"><div class="search widget"><div>%s</div></div></div>',
        '<ul><li class="notice">%s</ul>',
        '<div class="entry comments-open">%s</div>',
        '<div class="comments">%s</div>',  # there is nothing else
    ]
    pages = [(k, "http://x.example/", rest + a % article) for k, a in enumerate(around)]
    plain = "<div class='widget'><p>The text of it all,</p><p>in full.</p></div><p>Bye</p>"
    pages.append((20, "http://y.example/", rest + plain))
    said = "<div id='comments'><article>First! And much more to say.</article></div>"
    pages.append((21, "http://y.example/", f"<div>Short text</div>{said}"))
    odd = """<article><p>One <span class="sponsored">buy <b>it</b></span>two<br>
      <a class="share" href="x">Share</a></p><p class="advert">Buy<p>three <img class="ad">four
      <ul><li class="comment"><p>First!</p><ul><li>Second!</li></ul></li><li>five</ul>
      <h2 class="related">More</h2><p>six <span class="ad">torn<p>seven</p>
      <a class="promo"><div>Win</div>now</a>eight</article>"""
    pages.append((22, "http://z.example/", odd))
    got = extracted(spark, pages)
    assert [got[k] for k in range(len(around))] == ["Title\nThe text of it all."] * len(around)
    assert got[20] == "The text of it all,\nin full.\nBye"
    assert got[21] == "Short text"
    assert got[22] == "One two\nthree four\nfive\nsix\nseven\neight"


def test_torn_markup_and_no_pages(spark):
    torn = ["<p>a<", "<p>a</p", "<!-- a", "a &lt b &a", "<div class='x", "<p><b>a<i>b</p>c", "<"]
    got = extracted(spark, [(k, "http://x.example", t) for k, t in enumerate(torn)] * 2)
    assert [got[k] for k in range(6)] == ["a<", "a", "", "a < b &a", "", "ab\nc"]
    assert main_text.extract(spark.createDataFrame([], PAGE)).collect() == []


# --- archives --------------------------------------------------------------------------


def plain_records(pages, least=0):
    rows = sorted(
        ((i, (h or "").encode()) for i, _, h in pages),
        key=lambda r: (r[0] is not None, r[0] or 0, r[1]),
    )
    out, first = Counter(), {}
    for i, payload in rows:
        sha1 = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        stored = payload not in first or len(payload) < least
        out[
            (i, len(payload), sha1, "response" if stored else "revisit")
            + (None if stored else first[payload],)
        ] += 1
        first.setdefault(payload, i)
    return out


@pytest.fixture
def pages():
    rng = random.Random(4)
    bodies = [None, "", "é" * 50, "<p>x</p>", *("%030x" % rng.getrandbits(120) * 40 for _ in range(30))]
    out = [(k, f"http://x.example/{k}\r\nX: y", rng.choice(bodies)) for k in range(200)]
    return [*out, out[7], out[7], (None, None, "<p>x</p>"), (300, None, "long " * 100_000)]


@pytest.mark.parametrize("least", [0, 10])
def test_archives_give_back_what_was_written(spark, monkeypatch, pages, least):
    monkeypatch.setattr(warc, "HTML_PER_TASK", 100_000)
    monkeypatch.setattr(warc, "FILE_BYTES", 1000)
    root = scratch_dir(spark, "warc")
    docs = spark.createDataFrame(pages, PAGE).selectExpr("*", "1 as kind", "2 as first")
    manifest = warc.write(docs, root, least)
    assert manifest.count() > 10
    rows = warc.read(manifest, root).collect()
    names = "page_id payload_bytes payload_digest record_type refers_to".split()
    assert Counter(tuple(r[c] for c in names) for r in rows) == plain_records(pages, least)
    stored = {r.page_id: bytes(r.payload) for r in rows if r.payload is not None}
    assert stored[300] == b"long " * 100_000
    fs, path = opened(root)
    files = fs.get_file_info(__import__("pyarrow").fs.FileSelector(path))
    assert not [f for f in files if f.base_name.endswith(".tmp")]


def contents(root):
    fs, path = opened(root)
    selector = __import__("pyarrow").fs.FileSelector(path)
    found = {}
    for file in fs.get_file_info(selector):
        if file.is_file:
            with fs.open_input_stream(file.path, compression=None) as stream:
                found[file.base_name] = stream.read()
    return found


def test_equal_pages_make_equal_files(spark, monkeypatch):
    """Shards of several files each, whatever the partitions; ids far apart and crowded."""
    rng = random.Random(9)
    ids = [None, -(1 << 62), *range(400), *(10**15 + 7 * k for k in range(300)), 1 << 62]
    rows = [(i, f"u{k}", "".join(rng.choices("abcdef <>", k=500))) for k, i in enumerate(ids)]
    rows += [(50, "again", rows[52][2]), (60, "b", "same"), (60, "a", "same")]
    monkeypatch.setattr(warc, "HTML_PER_TASK", 40_000)
    monkeypatch.setattr(warc, "FILE_BYTES", 1000)
    monkeypatch.setattr(warc, "RANGES", 16)
    made = []
    for parts in (1, 5, 13):
        rng.shuffle(rows)
        root = scratch_dir(spark, "warc")
        pages = spark.createDataFrame(rows, PAGE).repartition(parts)
        manifest = warc.write(pages, root)
        made.append(contents(root))
        assert manifest.count() == len(made[0])
    assert made[0] == made[1] == made[2]
    files = Counter(name.split("-")[1] for name in made[0])
    assert len(files) >= 7 and max(files.values()) >= 3
    # shards follow each other by page_id, and hold what they should
    ids, sizes = [], Counter()
    for name in sorted(made[0]):
        for member in warc._Members(__import__("io").BytesIO(made[0][name])):
            headers, _ = warc.parse(member)
            ids.append(int(headers["X-Page-ID"] or -(1 << 63)))
            sizes[name.split("-")[1]] += int(headers["X-Payload-Length"])
    assert ids == sorted(ids) and len(ids) == len(rows)
    assert max(sizes.values()) <= 3 * 40_000


def test_a_file_that_is_neither_written_nor_committed(spark, pages, monkeypatch):
    stash = warc.stash

    def lose(df, label):
        done = stash(df, label)
        if label == "warc-files":
            for row in done.collect():
                fs, path = opened(uri(root, row.written))
                fs.delete_file(path)
        return done

    monkeypatch.setattr(warc, "stash", lose)
    root = scratch_dir(spark, "warc")
    with pytest.raises(Exception, match="neither written nor committed"):
        warc.write(spark.createDataFrame(pages, PAGE), root)


def test_archives_equal_their_sql(spark, tmp_path):
    rng = random.Random(8)
    rows = [(k, f"u{k}", rng.choice([None, "", "a", "é" * k, f"page {k % 7}"])) for k in range(90)]
    spark.createDataFrame(rows, PAGE).write.parquet(f"file:{tmp_path}/pages")
    pages = spark.read.parquet(f"file:{tmp_path}/pages")
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages/*.parquet'")
    got = warc.round_trip(pages)
    want = connection.sql(SQL["op4_warc"]).select(*got.columns)
    assert Counter(map(tuple, got.collect())) == Counter(want.fetchall())
    assert "revisit" in {r[3] for r in want.fetchall()}


def test_archive_order_and_damage(spark, pages):
    root = scratch_dir(spark, "warc")
    manifest = warc.write(spark.createDataFrame(pages, PAGE), root)
    (row,) = manifest.collect()
    fs, path = opened(uri(root, row.file))
    with fs.open_input_stream(path, compression=None) as stream:
        data = stream.read()
    members = list(warc._Members(__import__("io").BytesIO(data)))
    ids = [warc.parse(m)[0]["X-Page-ID"] for m in members]
    assert [int(i) for i in ids if i] == sorted(int(i) for i in ids if i)
    with pytest.raises(ValueError, match="cut off"):
        list(warc._Members(__import__("io").BytesIO(data[:-5])))


def test_no_pages(spark):
    root = scratch_dir(spark, "warc")
    manifest = warc.write(spark.createDataFrame([], PAGE), root)
    assert manifest.collect() == [] and warc.read(manifest, root).collect() == []


# --- token files --------------------------------------------------------------------------


@pytest.mark.parametrize("most", [2, 9, 300, 50_257, 1 << 33, 1 << 64])
def test_packed_ids_come_back(most):
    rng = np.random.default_rng(7)
    for n in (0, 1, 59, 60, 61, 1023, 1024, 1025, 7000):
        ids = rng.integers(0, most - 1, n, np.uint64, endpoint=True)
        ids[rng.random(n) < 0.3] = 1
        words, starts, sizes = token_files.pack(ids)
        assert (token_files.unpack(words, starts, sizes) == ids).all()
        for k in range(len(starts)):  # and a block by itself
            end = starts[k + 1] if k + 1 < len(starts) else len(words)
            one = token_files.unpack(words[starts[k] : end], np.zeros(1, int), sizes[k : k + 1])
            assert (one == ids[k * 1024 : k * 1024 + sizes[k]]).all()


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(IDS)


def test_words_encode_as_texts_do(library):
    rng = random.Random(6)
    parts = list("abcde'st  .,\n\t\r\x00é你1 2\xa0 \x1c\x85") + ["'s", " the", "  ", "<|endoftext|>"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(5000)]
    texts += [" ", "a ", " a", "a  b", "a \n b", "a b\n", "a b\n\nc d", "\n\n a", "a b\nc d\r\ne"]
    texts += ["\x1c", "a\x1c b", "\u2003x \u3000y", "don't we'll it's'", "A. b?\"", "<|endoftext|>"]
    end = "<|endoftext|>"
    texts += [f"{end}a", f"a {end}", f"a{end}b c", f"{end}{end}", f"x {end} {end}\ny", end[:-1]]
    encoder = token_files.Encoder(IDS)
    for text in [*texts, *texts[::-1]]:
        ids = library.encode(text, add_special_tokens=False).ids
        assert encoder.encode(text) == struct.pack(f"<{len(ids)}I", *ids)
    assert encoder.encode(None) == b""


def test_texts_are_encoded_together(library):
    rng = random.Random(8)
    parts = ["word", "Éa", "don't", "x1.", "end!)", "word.", "a\nb", "\n", "", "  ", "<|endoftext|>", "."]
    texts = [" ".join(rng.choices(parts, k=rng.randint(0, 9))) for _ in range(500)] + [None, ""]
    encoder = token_files.Encoder(IDS)
    whole = pa.array(["cut off", *texts, "cut off"])
    for some in (whole[1:-1], whole[1:8], whole[:0]):
        ids, counts = encoder.encode_all(some, [2])
        want = [
            [*library.encode(t or "", add_special_tokens=False).ids, 2] for t in some.to_pylist()
        ]
        assert counts.tolist() == [len(w) for w in want]
        assert ids.tolist() == [i for w in want for i in w]
    assert sorted(encoder.words) == ["end", "word", "Éa"]  # without their signs


def test_token_files_give_back_what_was_written(spark, documents, library, monkeypatch):
    monkeypatch.setattr(token_files, "TEXT_PER_TASK", 100_000)
    monkeypatch.setattr(token_files, "IDS_PER_FILE", 20_000)
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    rows += [(-5, None), (10_000, ""), (10_001, "x " * 50_000), (None, "no id")]
    rows += [(10_002, "a <|endoftext|> b")]
    random.Random(1).shuffle(rows)
    got = token_files.round_trip(table(spark, rows), IDS).collect()
    at, want = 0, []
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        want.append((i, at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        at += len(ids)
    assert Counter(map(tuple, got)) == Counter(want)


def test_repeated_ids_and_no_rows(spark):
    got = token_files.round_trip(table(spark, [(1, "b"), (1, "a"), (1, "a")]), IDS).collect()
    assert sorted(r.start for r in got) == [0, 2, 4] and len({r.ids_crc32 for r in got}) == 2
    assert token_files.round_trip(table(spark, []).limit(0), IDS).collect() == []


def test_remainders_of_null_ids(spark):
    row = spark.createDataFrame([(None,)], "doc_id long").select(crc_rest("doc_id", 7)).first()
    assert row[0] == 0
