"""Periodic runs, aligned tokenizers and toxicity."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tidemark.llm import alignment, periodic_runs, toxicity
from tidemark.llm.queries import vocabulary

SMALL = "/root/testdata/sf0.001"
FILES = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")


def table(spark, rows, schema="doc_id long, text string"):
    """With columns whose names clash with those of results and of steps."""
    names = ("runs", "collapsed", "h", "words", "n", "pairs", "score", "features", "label")
    more = ", ".join(f"{n} string" for n in names)
    return spark.createDataFrame([(*r, *names) for r in rows], f"{schema}, {more}")


@pytest.fixture(scope="module")
def documents(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    return [tuple(r) for r in rows.collect()]


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


# --- periodic runs -----------------------------------------------------------------


def plain_runs(words):
    """Every period at every place."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            part = words[i : i + length]
            if length >= max(6, 4 * q) and not any(
                part[d:] == part[:-d] for d in range(1, q)
            ):
                out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_report(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n > 0:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = plain_runs(words)
    out = {k for s, length, q in runs for k in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    best = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = " ".join(w for k, w in enumerate(words) if k not in out)
    return (doc_id, len(runs), *best, sha(lines), sha(kept))


def periodic(rng):
    """Words with runs, runs within periods of runs, and cut-off ones."""
    letters = rng.choice([1, 2, 3, 5, 50])
    words = [rng.randrange(letters) for _ in range(rng.choice([0, 3, 6, 10, 40, 100, 300, 700]))]
    for _ in range(rng.randrange(5)):
        if len(words) < 8:
            break
        q = rng.choice([1, 2, 3, 5, 8, 15, 16, 17, 20, 31, 32, 33, 40, 64, 65, 100])
        base = [rng.randrange(letters) for _ in range(q)]
        if rng.random() < 0.4 and q > 10:
            inner = base[: rng.choice([1, 2, 3, 4, 5, 7])]
            base = (inner * q)[: q - rng.randrange(3)] + [9] * rng.randrange(3)
            q = len(base)
        run = (base * 8)[: rng.choice([4 * q, 4 * q - 1, 5 * q, 6 * q + 1, 3 * q])]
        at = rng.randrange(len(words))
        words[at : at + len(run)] = run
    return [f"w{w}".encode() for w in words]


@pytest.mark.parametrize("at_once", [500, 1 << 16])
def test_runs_equal_brute_force(monkeypatch, at_once):
    monkeypatch.setattr(periodic_runs, "WORDS_AT_ONCE", at_once)
    rng = random.Random(at_once)
    texts = [periodic(rng) for _ in range(250)]
    found = periodic_runs._of_all(texts)
    assert sum(map(len, found)) > 100
    assert max(q for runs in found for _, _, q in runs) > 32
    for words, runs in zip(texts, found, strict=True):
        assert runs == plain_runs(words)


@pytest.mark.parametrize("q", [1, 2, 15, 16, 17, 31, 32, 33, 100, 1000])
def test_the_shortest_run_of_each_period(q):
    length = max(6, 4 * q)
    base = np.arange(1, q + 1)
    ids = np.concatenate([[-1, -2], np.tile(base, length // q + 1)[:length], [-3]])
    assert periodic_runs.find_runs(ids) == [(2, length, q)]
    assert periodic_runs.find_runs(np.delete(ids, 2)) == []


def test_many_periods_in_one_text():
    """Sturmian texts repeat at all scales, but less than four times."""
    a, b = [1], [1, 2]
    while len(b) < 3000:
        a, b = b, b + a
    assert periodic_runs.find_runs(np.array(b)) == []
    long = np.tile(np.array(b[:1001]), 5)
    found = periodic_runs.find_runs(long)
    assert found == plain_runs(long.tolist())
    assert (0, 5005, 1001) in found


def test_run_report(spark, documents):
    rows = documents + [
        (None, "x " * 30),
        (None, None),
        (5, ""),
        (5, " \n\t"),
        (6, "a b " * 50_000),
        (7, "ä ö\x1c " * 9),
        (7, "ä ö\x1c " * 9),
    ]
    got = periodic_runs.run_report(table(spark, rows))
    assert got.columns == [
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli",
        "runs_sha256", "collapsed_sha256",
    ]
    kinds = [t for _, t in got.dtypes]
    assert kinds == ["bigint"] * 6 + ["string"] * 2
    brute = [plain_report(*r) for r in rows if r[0] != 6]
    got = Counter(map(tuple, got.collect()))
    (long,) = [r for r in got if r[0] == 6 and r[3] == 100_000]
    assert long[1:6] == (1, 0, 100_000, 2, 50_000_000)
    assert long[7] == sha("a b")
    (short,) = [r for r in rows if r[0] == 6 and len(r[1]) < 100_000]
    want = Counter(brute + [plain_report(*short)])
    assert got - Counter([long]) == want
    assert sum(r[1] > 0 for r in brute) > 5
    assert periodic_runs.run_report(table(spark, []).limit(0)).collect() == []


# --- aligned tokens ----------------------------------------------------------------


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(FILES[0])
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=FILES[1])


LETTERS = {
    chr(c): b
    for b, c in {
        **{b: b for b in [*range(33, 127), *range(161, 173), *range(174, 256)]},
        **dict(
            zip(
                [*range(33), *range(127, 161), 173],
                range(256, 324),
                strict=True,
            )
        ),
    }.items()
}


def plain_alignment(libraries, text):
    """Ids and links by the libraries and sets of offsets; None where there are none."""
    if not text:
        return None
    a, b = libraries
    of_a = a.encode(" " + text, add_special_tokens=False)
    of_b = b.encode(text)
    bytes_a = [bytes(LETTERS[c] for c in t) for t in of_a.tokens]
    bytes_b = []
    for k in of_b:
        piece = b.id_to_piece(k)
        if re.fullmatch("<0x..>", piece):
            bytes_b.append(bytes([int(piece[3:5], 16)]))
        else:
            bytes_b.append(piece.replace("▁", " ").encode())
    whole = (" " + text).encode()
    if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
        return None
    ends = [np.cumsum([0, *map(len, x)]).tolist() for x in (bytes_a, bytes_b)]
    shared = sorted(set(ends[0]) & set(ends[1]))
    ids, said = (of_a.ids, of_b), []
    for low, high in zip(shared, shared[1:], strict=False):
        sides = [
            ",".join(str(i) for i, e in zip(ids[s], ends[s][1:], strict=True) if low < e <= high)
            for s in (0, 1)
        ]
        said.append("|".join(sides))
    links = [
        (ids[0][i], ids[1][j])
        for i in range(len(ids[0]))
        for j in range(len(ids[1]))
        if ends[0][i] < ends[1][j + 1] and ends[1][j] < ends[0][i + 1]
    ]
    return len(ids[0]), len(ids[1]), said, links


def check_alignment(spark, libraries, rows):
    found = [plain_alignment(libraries, text) for _, text in rows]
    counts = Counter(pair for f in found if f for pair in set(f[3]))
    best = defaultdict(int)
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    want = Counter()
    for (doc_id, _), f in zip(rows, found, strict=True):
        if not f:
            want[(doc_id, 0, 0, 0, 0, 0, 0, "")] += 1
            continue
        n_a, n_b, said, links = f
        n_best = sum(counts[x] == best[x[0]] for x in links)
        total = sum(counts[x] for x in links)
        digest = sha(";".join(said))
        want[(doc_id, n_a, n_b, len(said), len(links), n_best, total, digest)] += 1
    got = alignment.alignment_report(table(spark, rows), *FILES)
    assert [t for _, t in got.dtypes] == ["bigint"] * 7 + ["string"]
    assert Counter(map(tuple, got.collect())) == want


def test_groups_and_links_equal_brute_force():
    rng = random.Random(3)
    for _ in range(2000):
        n = rng.randrange(1, 40)
        a, b = (
            sorted({n, *rng.sample(range(1, n + 1), rng.randrange(n))}) for _ in "ab"
        )
        want, i, j = [], 0, 0
        for end in sorted(set(a) & set(b)):
            want.append([i, a.index(end) + 1, j, b.index(end) + 1])
            i, j = want[-1][1], want[-1][3]
        ends = np.array(a), np.array(b)
        assert alignment.groups(*ends, np.array([[0, len(a), 0, len(b)]])).tolist() == want
        pairs = [
            (x, y)
            for x in range(len(a))
            for y in range(len(b))
            if [0, *a][x] < b[y] and [0, *b][y] < a[x]
        ]
        assert list(zip(*map(np.ndarray.tolist, alignment.links(*ends)), strict=True)) == pairs


def test_alignment_equals_the_libraries(spark, libraries, documents, monkeypatch):
    rng = random.Random(4)
    signs = [*"ab c  .,'\n\t\r'sé日本▁<>|0123😀 ", " the ", "  ", "<|endoftext|>", "<s>"]
    signs += ["<0x0A>", "\x1c", "\x00", "\x85", "　", "don't", "<unk>", "﻿", "ﬁ"]
    rows = documents[:60]
    rows += [(1000 + k, "".join(rng.choices(signs, k=rng.randrange(25)))) for k in range(300)]
    rows += [(None, None), (None, "one two"), (1, ""), (2, "same"), (2, "same"), (3, " x \n ")]
    rows += [(4, "日本語" * 300), (5, "x" * 3000)]
    monkeypatch.setattr(alignment, "PAIRS_PER_SLICE", 500)
    check_alignment(spark, libraries, rows)


def test_alignment_of_little(spark, libraries):
    assert alignment.alignment_report(table(spark, []).limit(0), *FILES).collect() == []
    check_alignment(spark, libraries, [(1, None), (2, "")])


def test_a_text_whose_bytes_are_not_kept(libraries):
    """Such texts have no tokens, the others of a batch keep theirs."""
    model = alignment.Aligner(*FILES)
    odd = model.a.encode(" odd", add_special_tokens=False).ids[0]
    model.bytes_a[odd] = b"another"
    found = list(model.align(["fine words", "odd words", None, "words fine"]))
    assert [f[2] for f in found] == [2, 0, 0, 2]
    said = ";".join(plain_alignment(libraries, "fine words")[2])
    assert found[0][0].decode() == said


# --- toxicity --------------------------------------------------------------------------


def made(rng, toxic, insults):
    words = [rng.choice(["the", "house", "stands", "on", "a", "hill", "of"]) for _ in range(40)]
    if toxic:
        for _ in range(rng.randrange(2, 5)):
            words.insert(rng.randrange(len(words)), rng.choice(insults))
    return " ".join(words)


def test_held_out_accuracy(spark):
    """Listed insults, and a made-up family of them that only the labels tell."""
    rng = random.Random(1)
    rows, labels = [], []
    for k in range(900):
        toxic = k % 4 == 0
        family = [f"brok{end}" for end in ("ul", "ant", "ish", "elo", "im", "ado")]
        insults = ["idiot", "SCUM!", "w0rthless", "loooser"] if k % 8 else family
        rows.append((k, made(rng, toxic, insults)))
        labels.append((k, int(toxic), "more"))
    labels += [(5000, 1, "no such document"), (None, 1, ""), (1, None, "")]
    rows += [(900, None), (901, ""), (None, "the house"), (902, "x" * 200_000)]
    truth = spark.createDataFrame(labels, "doc_id long, toxic int, text string")
    got = toxicity.toxicity(table(spark, rows), truth).collect()
    assert len(got) == len(rows)
    for r in got:
        rest = zlib.crc32(b"" if r.doc_id is None else str(r.doc_id).encode()) % 5
        assert r.held_out == (rest == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 900]
    wrong = [r.doc_id for r in held if r.predicted != (r.doc_id % 4 == 0)]
    assert len(held) > 100 and len(wrong) <= 2
    assert not any(r.predicted for r in got if r.doc_id in (900, 901, None))


@pytest.mark.parametrize("labels,score", [([], 0.0), ([0, 0, None], 0.0), ([1, 1, 1], 1.0)])
def test_nothing_to_tell_apart(spark, labels, score):
    ids = [k for k in range(100) if zlib.crc32(str(k).encode()) % 5 in (1, 4)][:3]
    truth = spark.createDataFrame(list(zip(ids, labels, strict=False)), "doc_id long, toxic int")
    rows = [(k, "some words") for k in ids]
    got = toxicity.toxicity(table(spark, rows), truth).collect()
    assert [r.score for r in got] == [score] * 3
    assert toxicity.toxicity(table(spark, []).limit(0), truth).collect() == []


def plain_features(text, learned):
    """By simple counting, for words without disguise."""
    words = (text or "").split()
    parts = [set(re.findall(r"[^\W_]+", w.casefold())) for w in words]
    out = [
        sum(bool(p & set(some)) for p in parts) / max(len(words), 1) for some in toxicity.LISTS
    ]
    return out


def test_features(spark):
    words = toxicity.Words({"hou": 2500})
    name = toxicity.FEATURES.index
    texts = [
        "You idiot , you stupid IDIOT !", "the house", None, "", "1d10t l.o.s.e.r m o r o n scum",
        "so loooooser WHAT ?!",
    ]
    got = toxicity.measured(texts, words)
    for text, row in zip(texts[:2], got, strict=False):
        assert row[:4].tolist() == plain_features(text, {})
    assert got[2].tolist() == got[3].tolist() == [0.0] * len(toxicity.FEATURES)
    first = got[0]
    assert first[name("near_second_person")] == 1 and first[name("most_in_place")] == 3
    assert first[name("second_person")] == 2 / 7 and first[name("shouted")] == 1 / 7
    assert got[1][name("learned_most")] == 2.5
    assert np.isclose(got[1][name("log_learned")], np.log(2))
    assert np.isclose(got[4][name("log_hits")], np.log(5))  # all four are found
    assert got[4][name("unmasked")] == 3 / 8
    assert got[5][name("stretched")] == 1 / 4 and got[5][name("unmasked")] == 1 / 4
    # the same whatever the batches are
    again = [toxicity.measured([t], toxicity.Words({"hou": 2500}))[0] for t in texts]
    assert np.array_equal(got, np.array(again))


def test_the_learned_lexicon_counts_texts(spark):
    rows = [(f"brokul brokant w{k}", 1) for k in range(6)] + [("brok plain words", 0)] * 50
    rows += [("rare brokul", 0), (None, 0), ("", 1)]
    labelled = spark.createDataFrame(rows, "text string, label int")
    learned = toxicity.learned_lexicon(labelled.repartition(4))
    toxic, clean = 7, 52
    odds = np.log((6 + 0.5) / (toxic + 1)) - np.log((0 + 0.5) / (clean + 1))
    assert learned["brokant."] == learned["broka"] == round(1000 * odds)
    assert learned["broku"] < learned["broka"]
    assert "brok" not in learned and "w1." not in learned
    assert toxicity.learned_lexicon(labelled.filter("label = 0")) == {}
