"""Training documents that hold benchmark items.

Items (long ones in parts) are indexed by their words with BM25 impacts, scaled so that an
item's own words sum to 1. Items stand in blocks of BLOCK; a word's list keeps its largest
impact per block. Every passage of every document queries the index: blocks whose largest
impacts sum below LEAST_SCORE are passed over, the others are searched by WAND, which
moves on to the first item whose lists can still reach the threshold. Retrieved items are
verified against the document's word runs: the question (all but the last sentence) and
the answer (the last one) together.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.frames import empty_frame
from tidemark.llm.common import columns, prepare, windows, word_hashes

K1, B = 1.2, 0.75
# Words of a passage, from one passage to the next, and of a part of an item at most: a
# part lies whole in some passage, wherever it stands.
PASSAGE, STEP, PART = 128, 64, 64
# Scaled score that makes an item a candidate, and share of an item's runs of SHINGLE
# words that a document must hold.
LEAST_SCORE, SHINGLE, LEAST_OVERLAP = 0.5, 5, 0.8
BLOCK = 4
# Items of one index; more items make more indexes, each queried by all documents.
ITEMS_AT_ONCE = 20_000
WORDS_AT_ONCE, CELLS = 400_000, 4_000_000
SENTENCE = re.compile(r"(?<=[.?!])\s+(?=\S)|\n+(?=\s*\S)")
# In ASCII upper case becomes lower case, and what is no letter or digit a blank.
PLAIN = bytes(
    ord(chr(b).lower()) if chr(b).isalnum() or b > 127 else 32 if b < 128 else b
    for b in range(128)
) + bytes(range(128, 256))
# Beyond ASCII, what is no letter or digit.
OTHER = re.compile(r"[^\x00-\x7f\w]+")


def plain_words(text: str | None) -> list[bytes]:
    """Runs of letters and digits, in compatible forms made one and without case."""
    text = text or ""
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text).casefold()
        # folding may leave forms that can be composed
        text = OTHER.sub(" ", unicodedata.normalize("NFKC", text))
    return text.encode("utf-8").translate(PLAIN).split()


def parts_of(words: list[bytes]) -> Iterator[list[bytes]]:
    """An item in parts of PART words; a short rest is joined to some of what stands
    before it."""
    for start in range(0, len(words), PART):
        yield words[max(0, min(start, len(words) - PART // 2)) : start + PART]


class Statistics:
    """What BM25 has to know of all items: parts, their words, and parts by word."""

    def __init__(self):
        self.parts = self.words = 0
        self.df: Counter[bytes] = Counter()

    def add(self, items: list[tuple]) -> None:
        for _, text in items:
            for part in parts_of(plain_words(text)):
                self.parts += 1
                self.words += len(part)
                self.df.update(set(part))


class Index:
    """BM25 lists of some of the items, whose texts are (item_id, text) rows. Impacts come
    from ``known``, the statistics of all items, so they are the same in any index."""

    def __init__(self, items: list[tuple], known: Statistics | None = None):
        if known is None:
            known = Statistics()
            known.add(items)
        self.ids: list = []
        self.run: list[int] = []  # words of an item's runs
        self.question: list[np.ndarray] = []
        self.answer: list[np.ndarray] = []
        parts: list[list[bytes]] = []
        self.owner: list[int] = []
        for item_id, text in items:
            words = plain_words(text)
            if not words:
                continue
            item = len(self.ids)
            self.ids.append(item_id)
            cut = [m.end() for m in SENTENCE.finditer(text)]
            head = len(plain_words(text[: cut[-1]])) if cut else 0
            self.run.append(min(SHINGLE, len(words)))
            runs = windows(word_hashes(words), SHINGLE)
            # a run belongs to the answer if a word of the last sentence is in it
            first = max(0, min(head - SHINGLE + 1, len(runs)))
            self.question.append(np.unique(runs[:first]))
            self.answer.append(np.unique(runs[first:]))
            for part in parts_of(words):
                parts.append(part)
                self.owner.append(item)
        self._build(parts, known)

    def _build(self, parts: list[list[bytes]], known: Statistics) -> None:
        self.size = len(parts)
        counts = [Counter(p) for p in parts]
        df, total, mean = known.df, known.parts, known.words / max(known.parts, 1)
        lists: dict[bytes, list[tuple[int, float]]] = defaultdict(list)
        for k, (part, count) in enumerate(zip(parts, counts, strict=True)):
            norm = K1 * (1 - B + B * len(part) / mean)
            idf = {w: np.log(1 + (total - df[w] + 0.5) / (df[w] + 0.5)) for w in count}
            impact = {w: idf[w] * n * (K1 + 1) / (n + norm) for w, n in count.items()}
            whole = sum(impact.values())
            for w, x in impact.items():
                lists[w].append((k, x / whole))
        self.words = {w: k for k, w in enumerate(lists)}
        self.blocks = -(-self.size // BLOCK)
        block, most, sizes = [], [], []
        self.pieces: list[list[tuple[int, float]]] = []  # a word's list, cut by block
        for entries in lists.values():
            cut: dict[int, list[tuple[int, float]]] = defaultdict(list)
            for k, x in entries:
                cut[k // BLOCK].append((k, x))
            block += cut
            most += [max(x for _, x in piece) for piece in cut.values()]
            self.pieces += cut.values()
            sizes.append(len(cut))
        self.block = np.array(block, np.int64)
        self.most = np.array(most)
        self.sizes = np.array(sizes, np.int64)
        self.first = np.cumsum(self.sizes) - self.sizes

    def _wand(self, pieces: list[int]) -> Iterator[tuple[int, float]]:
        """Parts that reach LEAST_SCORE, from a passage's lists of one block."""
        cursors = [[0, self.pieces[k], self.most[k]] for k in pieces]
        while cursors:
            cursors.sort(key=lambda c: c[1][c[0]][0])
            bound, pivot = 0.0, None
            for cursor in cursors:
                bound += cursor[2]
                if bound >= LEAST_SCORE - 1e-9:
                    pivot = cursor[1][cursor[0]][0]
                    break
            if pivot is None:
                return
            if cursors[0][1][cursors[0][0]][0] == pivot:
                score = 0.0
                for cursor in cursors:
                    if cursor[1][cursor[0]][0] == pivot:
                        score += cursor[1][cursor[0]][1]
                        cursor[0] += 1
                if score >= LEAST_SCORE - 1e-9:
                    yield pivot, score
            else:
                for cursor in cursors:
                    while cursor[0] < len(cursor[1]) and cursor[1][cursor[0]][0] < pivot:
                        cursor[0] += 1
            cursors = [c for c in cursors if c[0] < len(c[1])]

    def retrieve(self, texts: list[list[bytes]]) -> dict[tuple[int, int], float]:
        """(text, item) to the best score of its passages, of all above the threshold."""
        ids, starts, owner = [], [], []
        for k, words in enumerate(texts):
            n = len(words)
            first = len(ids)
            ids += [self.words.get(w, -1) for w in words]
            for start in range(0, max(n - STEP, 1), STEP):
                starts.append((first + start, first + min(start + PASSAGE, n)))
                owner.append(k)
        found: dict[tuple[int, int], float] = {}
        if not ids or not self.size:
            return found
        ids = np.array(ids, np.int64)
        spans = np.array(starts, np.int64)
        step = max(1, CELLS // self.blocks)
        for low in range(0, len(spans), step):
            some = spans[low : low + step]
            sizes = some[:, 1] - some[:, 0]
            passage = np.repeat(np.arange(len(some)), sizes)
            inside = np.arange(len(passage)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            word = ids[np.repeat(some[:, 0], sizes) + inside]
            known = word >= 0
            pairs = np.unique(passage[known] * len(self.words) + word[known])
            passage, word = np.divmod(pairs, len(self.words))
            n = self.sizes[word]
            at = np.repeat(self.first[word] - np.cumsum(n) + n, n) + np.arange(n.sum())
            cell = np.repeat(passage, n) * self.blocks + self.block[at]
            bound = np.bincount(cell, self.most[at], len(some) * self.blocks)
            open_ = np.flatnonzero(bound[cell] >= LEAST_SCORE - 1e-9)
            open_ = open_[np.argsort(cell[open_], kind="stable")]
            cells, edges = np.unique(cell[open_], return_index=True)
            pieces = np.split(at[open_], edges[1:])
            for hit, mine in zip(cells.tolist(), pieces, strict=False):
                for part, score in self._wand(mine.tolist()):
                    key = (owner[low + hit // self.blocks], self.owner[part])
                    found[key] = max(found.get(key, 0.0), score)
        return found

    def matches(self, texts: list[str | None]) -> list[tuple[int, int, float, float, float, float]]:
        """text, item, score, overlap of the item, of its question and of its answer."""
        out = []
        held: list[list[bytes]] = []
        first = size = 0
        for k, text in enumerate(texts):
            held.append(plain_words(text))
            size += len(held[-1])
            if size >= WORDS_AT_ONCE or k + 1 == len(texts):
                out += self._verified(held, first)
                held, first, size = [], k + 1, 0
        return out

    def _verified(self, texts: list[list[bytes]], first: int) -> list[tuple]:
        out = []
        by_text = defaultdict(list)
        for (k, item), score in self.retrieve(texts).items():
            by_text[k].append((item, score))
        for k in sorted(by_text):
            hashes = word_hashes(texts[k])
            runs: dict[int, np.ndarray] = {}
            for item, score in sorted(by_text[k]):
                q, a, n = self.question[item], self.answer[item], self.run[item]
                if n not in runs:
                    runs[n] = windows(hashes, n) if len(hashes) >= n else hashes[:0]
                here = runs[n]
                in_q = int(np.isin(q, here).sum())
                in_a = int(np.isin(a, here).sum())
                overlap = (in_q + in_a) / (len(q) + len(a))
                if overlap >= LEAST_OVERLAP:
                    out.append(
                        (
                            first + k,
                            item,
                            score,
                            overlap,
                            in_q / len(q) if len(q) else 1.0,
                            in_a / len(a) if len(a) else 1.0,
                        )
                    )
        return out


def indexes(benchmark: DataFrame) -> Iterator[Index]:
    """Indexes over all items, of ITEMS_AT_ONCE items or so each.

    The items' own words, not the documents', are held by the driver: each group of items
    is read twice, for the statistics of all and for its index.
    """
    n = benchmark.count()
    groups = -(-n // ITEMS_AT_ONCE)
    group = F.pmod(F.xxhash64("item_id"), F.lit(max(groups, 1)))
    known = Statistics()

    def rows(k: int) -> list:
        return benchmark.filter(group == k).select("item_id", "text").collect()

    held = {0: rows(0)} if groups == 1 else {}
    for k in range(groups):
        known.add(held.get(k) or rows(k))
    for k in range(groups):
        items = sorted(held.get(k) or rows(k), key=lambda r: (r[0] is None, r[0], r[1] or ""))
        index = Index(items, known)
        if index.size:
            yield index


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row per document of ``docs`` (doc_id, text) and item of ``benchmark`` (item_id,
    text) it holds: doc_id, item_id, score, overlap, question_overlap, answer_overlap.

    NULL and empty texts hold nothing and are held by nothing. An item of fewer than
    SHINGLE words is one run. Repeated documents give their rows each; repeated items too.
    """
    prepare(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    kinds = docs.schema["doc_id"].dataType, benchmark.schema["item_id"].dataType
    schema = (
        f"doc_id {kinds[0].simpleString()}, item_id {kinds[1].simpleString()}, score double,"
        " overlap double, question_overlap double, answer_overlap double"
    )
    found = [docs.mapInArrow(_finder(i, docs), schema) for i in indexes(benchmark)]
    if not found:
        return empty_frame(docs.sparkSession, T.StructType.fromDDL(schema))
    return reduce(DataFrame.unionByName, found)


def _finder(index: Index, docs: DataFrame):
    sent = docs.sparkSession.sparkContext.broadcast(index)  # ITEMS_AT_ONCE items

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = sent.value
        for batch in batches:
            ids, texts = columns(batch, "doc_id", "text")
            rows = [
                (ids[k], index.ids[item], *numbers)
                for k, item, *numbers in index.matches(texts)
            ]
            if rows:
                names = "doc_id item_id score overlap question_overlap answer_overlap".split()
                yield pa.RecordBatch.from_pylist(
                    [dict(zip(names, r, strict=True)) for r in rows]
                )

    return run


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no item, with the columns they came with."""
    prepare(docs.sparkSession)
    for index in indexes(benchmark):
        sent = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                bad = {k for k, *_ in sent.value.matches(columns(batch, "text")[0])}
                if bad:
                    batch = batch.filter(pa.array([k not in bad for k in range(len(batch))]))
                yield batch

        docs = docs.mapInArrow(run, docs.schema)
    return docs
