"""Two tokenizers' tokens of the same text, aligned by the bytes they cover.

Where tokens of both end at the same byte, the text is cut; what lies between two cuts is
a group, the smallest stretch that both spell out by whole tokens. Cuts are found by
divide and conquer: of an interval, the end nearest its middle that both share (each end
of the one is looked up among the other's by bisection) parts it in two halves that are
solved by themselves; an interval without one is a group. Tokens whose bytes overlap are
linked.

At a single blank between two words both vocabularies end a token, as neither has one
that goes on over it. So a text is cut there first, and the alignment of each stretch is
remembered by the worker.

How many texts hold a linked pair of ids is counted over all texts. The counts lie in
sorted arrays, sliced by the first id, which the tasks that need them map into memory.
Their size is that of the pairs of ids that ever overlap, which the vocabularies bound,
not the texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import columns, mapped, prepare, put, scratch_dir, stash, uri

SPACE = "▁"
# A single blank with no other white space, and no mark of the piece vocabulary, beside it.
CUT = re.compile(rf"(?<=[^\s{SPACE}]) (?=[^\s{SPACE}])")
BYTE_PIECE = re.compile("<0x([0-9A-F]{2})>")
# Stretches a worker remembers, and pairs of ids in one slice of the counts.
STRETCHES_KEPT, PAIRS_PER_SLICE = 600_000, 4_000_000
# Letters of the longest stretch that is remembered.
LONGEST_KEPT = 200
# Bytes of results a worker hands over at once.
BYTES_AT_ONCE = 16 << 20


def groups(ends_a: np.ndarray, ends_b: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Intervals of tokens (first a, last a, first b, last b; lasts excluded) between
    neighbouring common ends, from left to right.

    ``whole`` has the intervals to cut, a row each; the tokens of a row begin and end at
    the same bytes. All intervals of a depth are halved side by side.
    """
    done, rows = [], whole
    while len(rows):
        a0, a1, b0, b1 = rows.T
        middle = (a0 + a1 - 1) // 2
        cut_a, cut_b = np.full(len(rows), -1), np.full(len(rows), -1)
        here, away = np.arange(len(rows)), 0
        while len(here):  # those without a common end so far
            k = middle[here] + (away // 2 if away % 2 == 0 else -(away + 1) // 2)
            inside = (k >= a0[here]) & (k < a1[here] - 1)
            end = ends_a[np.where(inside, k, 0)]
            at = np.searchsorted(ends_b, end)
            common = inside & (ends_b[np.minimum(at, len(ends_b) - 1)] == end)
            cut_a[here[common]], cut_b[here[common]] = k[common] + 1, at[common] + 1
            here = here[~common & (away < 2 * (a1 - a0)[here])]
            away += 1
        leaf = cut_a < 0
        done.append(rows[leaf])
        rows, cut_a, cut_b = rows[~leaf], cut_a[~leaf], cut_b[~leaf]
        left, right = rows.copy(), rows.copy()
        left[:, 1], left[:, 3] = cut_a, cut_b
        right[:, 0], right[:, 2] = cut_a, cut_b
        rows = np.concatenate([left, right])
    out = np.concatenate([whole[:0], *done])
    return out[np.argsort(out[:, 0])]


def links(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of tokens, (a, b), whose bytes overlap, by a, then b."""
    first = np.searchsorted(ends_b, np.append(0, ends_a[:-1]), "right")
    n = np.searchsorted(ends_b, ends_a) - first + 1
    of_a = np.repeat(np.arange(len(ends_a)), n)
    before = np.cumsum(n) - n
    return of_a, np.arange(len(of_a)) - before[of_a] + first[of_a]


def _row_of(sizes: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(sizes)), sizes)


def _byte_of_letter() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: itself if it can
    be seen, else those from 256 on in turn."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in seen]
    return {chr(b): b for b in seen} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Aligner:
    """A byte-level vocabulary ("a") and a piece vocabulary ("b"), and what they make of
    stretches of text with a blank before them."""

    def __init__(self, path_a: str, path_b: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True  # in a text they are text
        self.b = SentencePieceProcessor(model_file=path_b)
        letters = _byte_of_letter()
        self.bytes_a = [b""] * self.a.get_vocab_size()
        for name, k in self.a.get_vocab().items():
            known = all(c in letters for c in name)
            self.bytes_a[k] = bytes(map(letters.get, name)) if known else name.encode()
        self.bytes_b = []
        for k in range(self.b.get_piece_size()):
            name = self.b.id_to_piece(k)
            byte = BYTE_PIECE.fullmatch(name)
            shown = name.replace(SPACE, " ").encode()
            self.bytes_b.append(bytes([int(byte[1], 16)]) if byte else shown)
        self.size_a, self.size_b = (
            np.array([len(x) for x in pieces]) for pieces in (self.bytes_a, self.bytes_b)
        )
        self.width = len(self.bytes_b)
        self.kind = np.dtype("<i4" if len(self.bytes_a) * self.width < 1 << 31 else "<i8")
        # an id, and what follows it in its group
        most = max(len(self.bytes_a), self.width)
        self.shown = [f"{k}{sign}".encode() for k in range(most) for sign in ",|;"]
        # (groups as text, codes of links, tokens of a, tokens of b); None: bytes differ
        self.known: dict[str, tuple[bytes, bytes, int, int] | None] = {}

    def _kept(self, text: str, a: list[int], b: list[int]) -> bool:
        """Whether both spell out the text, with the blank before it."""
        whole = (" " + text).encode("utf-8", "surrogatepass")
        pieces = map(self.bytes_a.__getitem__, a), map(self.bytes_b.__getitem__, b)
        return all(b"".join(x) == whole for x in pieces)

    def learn(self, texts: list[str]) -> None:
        """Align stretches, side by side, and remember them."""
        found = self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)
        tokens_a, tokens_b = [x.ids for x in found], self.b.encode(texts, num_threads=1)
        kept = [*map(self._kept, texts, tokens_a, tokens_b)]
        if not all(kept):
            self.known.update((t, None) for t, k in zip(texts, kept, strict=True) if not k)
            texts, tokens_a, tokens_b = (
                [x for x, k in zip(some, kept, strict=True) if k]
                for some in (texts, tokens_a, tokens_b)
            )
        if not texts:
            return
        n_a, n_b = (np.fromiter(map(len, x), np.int64) for x in (tokens_a, tokens_b))
        a, b = (np.fromiter(chain.from_iterable(x), np.int64) for x in (tokens_a, tokens_b))
        ends_a, ends_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        last_a, last_b = np.cumsum(n_a), np.cumsum(n_b)
        whole = np.stack([last_a - n_a, last_a, last_b - n_b, last_b], axis=1)
        found = groups(ends_a, ends_b, whole)
        # the ids in the order of the text: group by group, first those of a
        sign_a, sign_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        sign_a[found[:, 1] - 1], sign_b[found[:, 3] - 1] = 1, 2
        place_a = np.arange(len(a)) + np.repeat(found[:, 2], found[:, 1] - found[:, 0])
        place_b = np.arange(len(b)) + np.repeat(found[:, 1], found[:, 3] - found[:, 2])
        order = np.empty(len(a) + len(b), np.int64)
        order[place_a], order[place_b] = a * 3 + sign_a, b * 3 + sign_b
        shown = [*map(self.shown.__getitem__, order.tolist())]
        of_a, of_b = links(ends_a, ends_b)
        codes = (a[of_a] * self.width + b[of_b]).astype(self.kind).tobytes()
        ends = np.cumsum(np.bincount(_row_of(n_a)[of_a])) * self.kind.itemsize
        at = byte = 0
        for text, end, byte_end, m_a, m_b in zip(
            texts, (last_a + last_b).tolist(), ends.tolist(), n_a.tolist(), n_b.tolist(),
            strict=True,
        ):
            self.known[text] = b"".join(shown[at:end]), codes[byte:byte_end], m_a, m_b
            at, byte = end, byte_end

    def align(self, texts: list[str | None]) -> Iterator[tuple[bytes, bytes, int, int]]:
        """(groups as text, codes of links, tokens of a, tokens of b) of each text, empty
        where there is none or where a vocabulary does not keep its bytes."""
        if len(self.known) > STRETCHES_KEPT:
            self.known.clear()
        parts = [CUT.split(t) if t and SPACE not in t else [] for t in texts]
        fresh = set().union(*parts).difference(self.known)
        if fresh:
            self.learn(list(fresh))
        for stretches in parts:
            found = [*map(self.known.__getitem__, stretches)]
            if not found or None in found:
                yield b"", b"", 0, 0
                continue
            said, codes, n_a, n_b = zip(*found, strict=True)
            yield b"".join(said)[:-1], b"".join(codes), sum(n_a), sum(n_b)
        for stretch in fresh:  # whole texts without a blank do not come again
            if len(stretch) > LONGEST_KEPT:
                del self.known[stretch]


@cache
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


def aligned(docs: DataFrame, path_a: str, path_b: str, text: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``n_a`` and ``n_b`` tokens, ``n_groups``, ``n_links``, the
    ``groups`` as text (ids of a, a bar, ids of b; groups parted by semicolons), and its
    distinct linked ``pairs`` of ids (id of a times the size of b, plus id of b) with how
    many ``times`` each is linked.

    NULL and empty texts have no tokens; nor have texts whose bytes one of the
    vocabularies does not keep, such as those with a U+2581. Rows with a NULL or repeated
    doc_id are rows like others. Both files must lie under ``path_a`` and ``path_b`` on
    every executor.
    """
    spark = docs.sparkSession
    prepare(spark)
    code = _code(path_a, path_b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = aligner(path_a, path_b)

        def out(ids: pa.Array, rows: list[tuple]) -> pa.RecordBatch:
            said, n_a, n_b, n_links, pairs, times = zip(*rows, strict=True)
            offsets = np.append(0, np.cumsum([len(p) for p in pairs]))
            lists = [
                pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), np.concatenate(x))
                for x in (pairs, times)
            ]
            counts = [pa.array(x, pa.int64()) for x in (n_a, n_b, n_links)]
            n_groups = pa.array([s.count(b"|") for s in said], pa.int64())
            return pa.RecordBatch.from_arrays(
                [ids, *counts[:2], n_groups, counts[2], pa.array(said, pa.string()), *lists],
                names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times"],
            )

        for batch in batches:
            first, size, rows = 0, 0, []
            found = model.align(columns(batch, "_text")[0])
            for k, (said, codes, n_a, n_b) in enumerate(found):
                codes = np.frombuffer(codes, model.kind)
                pairs, times = np.unique(codes, return_counts=True)
                rows.append((said, n_a, n_b, len(codes), pairs, times.astype(np.int32)))
                size += len(said) + 8 * len(pairs)
                if size > BYTES_AT_ONCE:
                    yield out(batch.column(0).slice(first, len(rows)), rows)
                    first, size, rows = k + 1, 0, []
            if rows:
                yield out(batch.column(0).slice(first, len(rows)), rows)

    docs = docs.select("doc_id", F.col(text).alias("_text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(
        run,
        f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups string,"
        f" pairs array<{code}>, times array<int>",
    )


def _code(path_a: str, path_b: str) -> str:
    """The type of a pair's number."""
    return "int" if aligner(path_a, path_b).kind.itemsize == 4 else "long"


def pair_counts(linked: DataFrame, width: int) -> DataFrame:
    """(a, pair, n): in how many rows each pair of ids is linked."""
    pairs = linked.select(F.explode("pairs").alias("pair"))
    counts = pairs.groupBy("pair").agg(F.count(F.lit(1)).alias("n"))
    return counts.select(F.expr(f"int(pair div {width})").alias("a"), "pair", "n")


def write_counts(counts: DataFrame, root: str) -> list[tuple[int, str]]:
    """Write the counts as sorted arrays, a file per range of first ids: pairs (64 bits),
    then twice their count, plus one for those that no other pair of the id exceeds.

    Returns the first pair and the name of each file: one per PAIRS_PER_SLICE pairs.
    """
    n = max(1, -(-counts.count() // PAIRS_PER_SLICE))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        held = [
            [batch.column(k).to_numpy(zero_copy_only=False) for k in range(3)]
            for batch in batches
        ]
        if not held:
            return
        a, pair, often = (np.concatenate(x).astype(np.int64) for x in zip(*held, strict=True))
        order = np.argsort(pair)
        a, pair, often = a[order], pair[order], often[order]
        firsts = np.flatnonzero(np.diff(a, prepend=-1))
        most = np.repeat(np.maximum.reduceat(often, firsts), np.diff(np.append(firsts, len(a))))
        name = f"part-{context.partitionId():05d}-{context.taskAttemptId()}"
        both = np.concatenate([pair, 2 * often + (often == most)])
        put(uri(root, name), both.astype("<i8").tobytes())
        yield pa.RecordBatch.from_pylist([{"first": int(pair[0]), "file": name}])

    dealt = counts.repartitionByRange(n, "a").mapInArrow(run, "first long, file string")
    return sorted((r["first"], r["file"]) for r in dealt.collect())


def weighed(linked: DataFrame, root: str, slices: list[tuple[int, str]]) -> DataFrame:
    """``linked`` with ``n_best``, its links whose pair is the most frequent one of the id
    of a, and ``count_sum``, the sum of the counts of all its links, in place of the pairs."""
    prepare(linked.sparkSession)
    firsts, names = [s[0] for s in slices], [s[1] for s in slices]
    keep = [c for c in linked.columns if c not in ("pairs", "times")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index
            pairs, times = batch.column(at("pairs")), batch.column(at("times"))
            sizes = pairs.value_lengths().to_numpy()
            code = pairs.flatten().to_numpy().astype(np.int64)
            often = times.flatten().to_numpy().astype(np.int64)
            value = np.zeros(len(code), np.int64)
            where = np.searchsorted(firsts, code, "right") - 1
            for s in np.unique(where).tolist():
                both = mapped(uri(root, names[s]), "<i8")
                half, mine = len(both) // 2, where == s
                value[mine] = both[half:][np.searchsorted(both[:half], code[mine])]
            ends = np.cumsum(sizes)
            totals = []
            for part in (often * (value & 1), often * (value >> 1)):
                running = np.append(0, np.cumsum(part))
                totals.append(pa.array(running[ends] - running[ends - sizes]))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(at(c)) for c in keep), *totals],
                names=[*keep, "n_best", "count_sum"],
            )

    kinds = ", ".join(f"{c} {linked.schema[c].dataType.simpleString()}" for c in keep)
    return linked.mapInArrow(run, f"{kinds}, n_best long, count_sum long")


def alignment_report(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per document: tokens, groups and links, how common its links are in all documents,
    and a digest of its groups.

    Every row counts as a document of its own, copies too. An empty table has no rows.
    """
    spark = docs.sparkSession
    found = aligned(docs, path_a, path_b)
    digest = F.when(F.col("n_a") > 0, F.sha2(F.col("groups").cast("binary"), 256)).otherwise("")
    linked = stash(
        found.select(
            "doc_id", "n_a", "n_b", "n_groups", "n_links", digest.alias("groups_sha256"),
            "pairs", "times",
        ),
        "linked",
    )
    root = scratch_dir(spark, "pair-counts")
    slices = write_counts(pair_counts(linked, aligner(path_a, path_b).width), root)
    return weighed(linked, root, slices).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        *("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"),
    )
