"""Token ids of documents in word-aligned packed files, in order of doc_id.

A file holds blocks of up to BLOCK ids. Ids are packed Simple-8b: the top four bits of a
64-bit word select how many ids share its other 60 bits; ids that need more than 60 bits
follow an escape word raw. After the blocks come the documents (id, id count), the
blocks' first words and id counts, and a footer, so any block can be decoded alone and
all of them at once.

``[words][doc_id i64 ...][n_tokens i64 ...][block word offset i64 ...][block ids i64 ...]
[documents i64][blocks i64][words i64][MAGIC]``, all little-endian.
"""

from __future__ import annotations

import struct
from array import array
from collections.abc import Iterator
from functools import cache
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import columns, opened, prepare, put, scratch_dir, stash, uri
from tidemark.session import MOST_READERS

MAGIC = b"TOKS8B01"
BLOCK = 1024
# Ids per word and bits of each, by selector; the last selector is the escape.
LAYOUT = [(60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10)]
LAYOUT += [(5, 12), (4, 15), (3, 20), (2, 30), (1, 60)]
ESCAPE = 15
# Ids after which a file is closed, bytes of text per task.
IDS_PER_FILE, TEXT_PER_TASK = 16_000_000, 32 << 20
# Ids that are packed or unpacked together, a multiple of BLOCK.
PACKED_AT_ONCE = 1 << 20
# Words, and pieces of words, that a worker remembers; bytes of text encoded at once.
WORDS_KEPT, PIECES_KEPT, TEXT_AT_ONCE = 1_200_000, 100_000, 4 << 20


# --- the code ---------------------------------------------------------------------


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, first word of each block, ids of each block.

    A word takes as many of the next ids as fit; the last word of a block may have room.
    Where words begin is found for all blocks side by side, one word of each at a time;
    then all words with the same selector are put together at once.
    """
    n = len(ids)
    blocks = -(-n // BLOCK)
    sizes = np.minimum(BLOCK, n - BLOCK * np.arange(blocks))
    if not blocks:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), sizes
    most = int(ids.max())
    padded = np.zeros((blocks, BLOCK + 60), np.uint16 if most < 1 << 16 else np.uint64)
    whole = n // BLOCK
    padded[:whole, :BLOCK] = np.asarray(ids[: whole * BLOCK]).reshape(whole, BLOCK)
    if whole < blocks:
        padded[whole, : sizes[whole]] = ids[whole * BLOCK :]
    # from each place on: the layout that packs the most ids, and how many
    step = np.ones((blocks, BLOCK), np.int8)
    chosen = np.full((blocks, BLOCK), ESCAPE, np.int8)
    for selector in range(len(LAYOUT) - 1, -1, -1):
        count, bits = LAYOUT[selector]
        if most < 1 << bits:  # any ids fit
            step[:], chosen[:] = count, selector
            continue
        run = padded < padded.dtype.type(1 << bits)
        width = 1
        while width < count and run.any():  # runs of ``count`` small ids, by doubling
            more = min(width, count - width)
            run = run[:, : run.shape[1] - more] & run[:, more:]
            width += more
        if width == count:
            run = run[:, :BLOCK]
            step[run] = count
            chosen[run] = selector
    at, rows, starts = np.zeros(blocks, np.int64), np.arange(blocks), []
    while len(rows):
        starts.append(rows * BLOCK + at)
        at = at + step.reshape(-1)[starts[-1]]
        inside = at < sizes[rows]
        rows, at = rows[inside], at[inside]
    place = np.sort(np.concatenate(starts))  # block by block
    row = place // BLOCK
    selector = chosen.reshape(-1)[place]
    raw = selector == ESCAPE
    word = np.arange(len(place)) + np.cumsum(raw) - raw
    out = np.zeros(len(place) + int(raw.sum()), np.uint64)
    source = row * padded.shape[1] + place % BLOCK
    values = padded.reshape(-1)
    for s, (count, bits) in enumerate(LAYOUT):
        mine = np.flatnonzero(selector == s)
        if len(mine):
            value = np.full(len(mine), np.uint64(s) << np.uint64(60))
            for k in range(count):
                here = values[source[mine] + k].astype(np.uint64, copy=False)
                value |= here << np.uint64(k * bits)
            out[word[mine]] = value
    out[word[raw]] = np.uint64(ESCAPE) << np.uint64(60)
    out[word[raw] + 1] = values[source[raw]]
    return out, word[np.searchsorted(row, np.arange(blocks))], sizes


def unpack(words: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Ids of whole blocks, given their words."""
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    selector = (words >> np.uint64(60)).astype(np.int64)
    raw = np.zeros(n, bool)
    if (selector == ESCAPE).any():
        # a raw word may look like an escape: take them in turn, per run
        at = np.flatnonzero(selector == ESCAPE)
        k = 0
        while k < len(at):
            place = at[k]
            raw[place + 1] = True
            k += 1
            if k < len(at) and at[k] == place + 1:
                k += 1
    counts = np.array([c for c, _ in LAYOUT] + [0, 0])[selector]
    counts[raw] = 1
    block = np.searchsorted(starts, np.arange(n), "right") - 1
    # room left in a block's last word holds no ids
    before = np.cumsum(counts) - counts
    inside = before - before[starts][block]
    counts = np.minimum(counts, sizes[block] - inside)
    first = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), np.uint64)
    out[first[raw]] = words[raw]
    for s, (count, bits) in enumerate(LAYOUT):
        mine = np.flatnonzero((selector == s) & ~raw)
        mask = np.uint64((1 << bits) - 1)
        for k in range(count):
            some = mine[counts[mine] > k]
            if len(some):
                out[first[some] + k] = (words[some] >> np.uint64(k * bits)) & mask
    return out


class Packer:
    """One file's bytes, packed while ids arrive: whole blocks as soon as PACKED_AT_ONCE
    ids wait, so that little more than the packed words is held."""

    def __init__(self):
        self.doc_ids: list[int] = []
        self.counts: list[int] = []
        self.n_ids = self.n_words = self.n_waiting = 0
        self.waiting: list[np.ndarray] = []
        self.words: list[bytes] = []
        self.starts: list[np.ndarray] = []
        self.sizes: list[np.ndarray] = []

    def add(self, doc_ids: list[int], counts: list[int], ids: np.ndarray) -> None:
        """Documents, how many ids each has, and all of these, 32-bit."""
        self.doc_ids.extend(doc_ids)
        self.counts.extend(counts)
        self.waiting.append(ids)
        self.n_ids += len(ids)
        self.n_waiting += len(ids)
        if self.n_waiting >= PACKED_AT_ONCE:
            self._pack(self.n_waiting // BLOCK * BLOCK)

    def _pack(self, n: int) -> None:
        ids = np.concatenate([np.zeros(0, np.uint32), *self.waiting])
        for low in range(0, n, PACKED_AT_ONCE):
            words, starts, sizes = pack(ids[low : min(low + PACKED_AT_ONCE, n)])
            self.words.append(words.astype("<u8").tobytes())
            self.starts.append(starts + self.n_words)
            self.sizes.append(sizes)
            self.n_words += len(words)
        self.waiting = [ids[n:].copy()]
        self.n_waiting -= n

    def close(self) -> bytes:
        self._pack(self.n_waiting)
        none = [np.zeros(0, np.int64)]
        starts, sizes = (np.concatenate(x or none) for x in (self.starts, self.sizes))
        size = [len(self.doc_ids), len(starts), self.n_words]
        tail = (self.doc_ids, self.counts, starts, sizes, size)
        return b"".join([*self.words, *(np.asarray(x, "<i8").tobytes() for x in tail), MAGIC])


def parsed(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """doc ids, id counts and all ids (32-bit) of a file."""
    if data[-8:] != MAGIC:
        raise ValueError("not a token file")
    docs, blocks, n_words = np.frombuffer(data[-32:-8], "<i8").tolist()
    body = np.frombuffer(data, "<u8", n_words)
    rest = np.frombuffer(data, "<i8", 2 * (docs + blocks), 8 * n_words)
    doc_ids, counts = rest[:docs], rest[docs : 2 * docs]
    starts, sizes = rest[2 * docs : 2 * docs + blocks], rest[2 * docs + blocks :]
    bounds = np.append(starts, n_words)
    out = np.empty(int(sizes.sum()), np.uint32)
    step = PACKED_AT_ONCE // BLOCK
    for low in range(0, blocks, step):  # blocks stand by themselves
        high = min(low + step, blocks)
        words = body[bounds[low] : bounds[high]]
        ids = unpack(words, starts[low:high] - bounds[low], sizes[low:high])
        out[low * BLOCK : low * BLOCK + len(ids)] = ids
    return doc_ids, counts, out


# --- tokens -------------------------------------------------------------------------

# Fixed values of byte-level vocabularies: white space, and the rule that cuts a text.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
CUT = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+"
    rf"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)
# Signs that end a word without being part of it.
TAIL = ".,:;!?#$%&*|)]}\""


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: itself if it can be seen, else the next of
    those from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in seen]
    return {b: chr(b) for b in seen} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class _Pieces(dict):
    """Ids of pieces, as the library's model finds them."""

    def __init__(self, model):
        self.tokenize = model.tokenize
        self.letters = _byte_letters()

    def found(self, piece: str) -> list[int]:
        letters = piece.encode().decode("latin-1").translate(self.letters)
        return [token.id for token in self.tokenize(letters)]

    def __missing__(self, piece: str) -> bytes:
        ids = self.found(piece)
        value = self[piece] = struct.pack(f"<{len(ids)}I", *ids)
        return value

    def of(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, CUT.findall(text)))


class _Words(dict):
    """Where the ids of words of letters alone, with a blank before them, and of the signs
    after them are; -1 for other words. Place 0 has none."""

    def __init__(self, pieces: _Pieces):
        self.pieces = pieces
        self.blank = pieces.letters[ord(" ")]
        self.empty()

    def empty(self) -> None:
        self.clear()
        self.ids, self.ends = array("I"), array("q", [0])
        self.signs: dict[str, int] = {}

    def put(self, ids: list[int]) -> int:
        self.ids.extend(ids)
        self.ends.append(len(self.ids))
        return len(self.ends) - 1

    def __missing__(self, word: str) -> int:
        if not word.isalpha():
            return -1
        if word.isascii():  # these letters stand for themselves
            ids = [token.id for token in self.pieces.tokenize(self.blank + word)]
        else:
            ids = self.pieces.found(" " + word)
        place = self[word] = self.put(ids)
        return place

    def after(self, signs: str) -> int:
        if signs not in self.signs:
            self.signs[signs] = self.put(self.pieces.found(signs))
        return self.signs[signs]


def _strings(texts: pa.Array) -> list[str]:
    return texts.to_numpy(zero_copy_only=False).tolist()


class Encoder:
    """The tokenizers library's model, asked once per distinct piece of a text.

    A text that holds one of the vocabulary's added tokens, such as its end mark, is left
    to the library as a whole, which gives such a token its own id. In others the rule
    starts a new piece at every single blank between two words, so the ids of a text are
    those of its words in turn: the distinct words of some texts are looked up, without the
    signs that end them, and their ids gathered for all of these texts at once. Words and
    pieces are remembered. Texts with blanks beside other white space are cut by the rule
    itself.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.pieces = _Pieces(self.library.model)
        self.words = _Words(self.pieces)
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]

    def encode(self, text: str | None) -> bytes:
        """Little-endian 32-bit ids."""
        ids, _ = self.encode_all(pa.array([text], pa.string()), [])
        return ids.astype("<u4").tobytes()

    def _places(self, words: pa.Array, other: list[bytes]) -> np.ndarray:
        """Two places of ids for each of distinct words; -1 for those with white space
        beside them. The ids of words with other signs go to ``other``, whose places are
        -2, -3 and so on."""
        cores = pc.utf8_rtrim(words, characters=TAIL)
        n_signs = pc.subtract(pc.binary_length(words), pc.binary_length(cores)).to_numpy()
        coded = cores.dictionary_encode()
        known = map(self.words.__getitem__, _strings(coded.dictionary))
        known = np.fromiter(known, np.int64, len(coded.dictionary))
        out = np.zeros((len(words), 2), np.int64)
        out[:, 0] = known[coded.indices.to_numpy()]
        some = np.flatnonzero((out[:, 0] >= 0) & (n_signs > 0))
        ends = pc.utf8_slice_codeunits(words.take(pa.array(some)), -1)
        one = n_signs[some] == 1
        last = ends.dictionary_encode()
        signs = np.array([self.words.after(x) for x in _strings(last.dictionary)], np.int64)
        out[some[one], 1] = signs[last.indices.to_numpy()[one]]
        some = some[~one]
        for k, word in zip(some.tolist(), _strings(words.take(pa.array(some))), strict=True):
            out[k, 1] = self.words.after(word[-n_signs[k] :])
        some = np.flatnonzero(out[:, 0] < 0)
        for k, word in zip(some.tolist(), _strings(words.take(pa.array(some))), strict=True):
            if word and not word[0].isspace() and not word[-1].isspace():
                other.append(self.pieces.of(" " + word))
                out[k, 0] = -1 - len(other)
        return out

    def encode_all(self, texts: pa.Array, end: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """32-bit ids of all texts in turn, ``end`` after each, and how many each has."""
        n = len(texts)
        if not n:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        if len(self.words) > WORDS_KEPT:
            self.words.empty()
        if len(self.pieces) > PIECES_KEPT:
            self.pieces.clear()
        texts = pc.fill_null(texts, "")
        words = pc.split_pattern(texts, " ")  # one at least
        bounds = words.offsets.to_numpy()
        first, words = bounds[:-1], words.flatten()
        coded = words.dictionary_encode()
        other: list[bytes] = []
        place = self._places(coded.dictionary, other)[coded.indices.to_numpy()]
        begins = _strings(words.take(pa.array(first)))
        odd = place[:, 0] == -1
        odd[first] = [w[-1:].isspace() for w in begins]
        odd = np.logical_or.reduceat(odd, first)  # texts with a word without ids of its own
        added = np.zeros(n, bool)
        for token in self.added:
            added |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        place[np.repeat(odd | added, np.diff(bounds))] = 0
        # a text's first word, or all of the text
        place[first, 0], place[first, 1] = -2 - len(other) - np.arange(n), 0
        for k, begin in enumerate(begins):
            if added[k]:
                ids = self.library.encode(texts[k].as_py(), add_special_tokens=False).ids
                other.append(struct.pack(f"<{len(ids)}I", *ids))
            else:
                other.append(self.pieces.of(texts[k].as_py() if odd[k] else begin))
        other.append(struct.pack(f"<{len(end)}I", *end))
        place = np.insert(place, bounds[1:], [-1 - len(other), 0], axis=0).reshape(-1)
        known = len(self.words.ends)
        place = np.where(place < 0, known - 2 - place, place)
        size = np.append(
            np.diff(np.array(self.words.ends), prepend=0),
            np.fromiter(map(len, other), np.int64, len(other)) // 4,
        )
        sizes = size[place]
        before = (np.cumsum(size) - size)[place] - (np.cumsum(sizes) - sizes)
        more = np.frombuffer(b"".join(other), "<u4")
        ids = np.append(np.array(self.words.ids, np.uint32), more.astype(np.uint32))
        ids = ids[np.repeat(before, sizes) + np.arange(int(sizes.sum()))]
        return ids, np.add.reduceat(sizes, 2 * (first + np.arange(n)))


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


# --- files -----------------------------------------------------------------------


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[list, pa.Array]]:
    """doc ids and texts, some TEXT_AT_ONCE bytes of text at a time."""
    ids, texts = (batch.column(batch.schema.get_field_index(n)) for n in ("doc_id", "text"))
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(size, dtype=np.int64) // TEXT_AT_ONCE
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
    for begin, end in zip(cuts, cuts[1:], strict=False):
        yield ids[begin:end].to_pylist(), texts[begin:end]


def write(docs: DataFrame, path: str, end_id: int, root: str) -> DataFrame:
    """Encode ``docs`` (doc_id long, text) and write the files below ``root``.

    Texts are range-partitioned by doc_id, over MOST_READERS tasks at most, and sorted;
    each task encodes its own and closes a file whenever it holds IDS_PER_FILE ids. Rows without a doc_id come first;
    rows that share one keep all their tokens, ordered by text. A file has its name only
    when it is complete, and the returned manifest (part, number, file, n_nulls, n_docs,
    n_ids), one row per file, names just the files of the attempts that succeeded.
    """
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = min(MOST_READERS, max(1, -(-size // TEXT_PER_TASK)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        part, attempt = context.partitionId(), context.taskAttemptId()
        model = encoder(path)
        packer, n_nulls, number = Packer(), 0, 0

        def close() -> pa.RecordBatch:
            # NULL doc_ids are told apart in the manifest: they are the first ones
            name = f"part-{part:05d}-{number:04d}-{attempt}.s8b"
            put(uri(root, name), packer.close())
            row = {
                "part": part,
                "number": number,
                "file": name,
                "n_nulls": n_nulls,
                "n_docs": len(packer.doc_ids),
                "n_ids": packer.n_ids,
            }
            return pa.RecordBatch.from_pylist([row])

        for batch in batches:
            for doc_ids, texts in _slices(batch):
                ids, counts = model.encode_all(texts, [end_id])
                ends = np.append(0, np.cumsum(counts))
                at = 0
                while at < len(counts):
                    room = IDS_PER_FILE - packer.n_ids
                    to = min(len(counts), int(np.searchsorted(ends, ends[at] + room)))
                    some = doc_ids[at:to]
                    known = [0 if doc_id is None else doc_id for doc_id in some]
                    packer.add(known, counts[at:to].tolist(), ids[ends[at] : ends[to]])
                    n_nulls += some.count(None)
                    at = to
                    if packer.n_ids >= IDS_PER_FILE:
                        yield close()
                        packer, n_nulls, number = Packer(), 0, number + 1
        if packer.doc_ids:
            yield close()

    dealt = docs.repartitionByRange(n, "doc_id", F.xxhash64("text"))
    dealt = dealt.sortWithinPartitions("doc_id", "text")
    schema = "part long, number long, file string, n_nulls long, n_docs long, n_ids long"
    return stash(dealt.mapInArrow(run, schema), "manifest")


def read(manifest: DataFrame, root: str) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens, ids (little-endian 32-bit).

    A file's place among all ids is the sum of the parts before its own, of which there
    are MOST_READERS at most, and of the files before it in its part.
    """
    spark = manifest.sparkSession
    prepare(spark)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = manifest.groupBy("part").agg(F.sum("n_ids").alias("n"))
    parts = parts.select("part", F.sum("n").over(before).alias("before"))
    inside = Window.partitionBy("part").orderBy("number")
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce("before", F.lit(0)) + F.coalesce(F.sum("n_ids").over(inside), F.lit(0))
    files = manifest.join(parts, "part").select("file", "n_nulls", first.alias("first"))
    files = files.repartition(min(MOST_READERS, max(1, manifest.count())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, n_nulls, first in zip(
                *columns(batch, "file", "n_nulls", "first"), strict=True
            ):
                fs, path = opened(uri(root, name))
                with fs.open_input_stream(path, compression=None) as stream:
                    doc_ids, counts, ids = parsed(stream.read())
                ends = np.cumsum(counts)
                known = np.arange(len(doc_ids)) >= n_nulls
                rows = iter(range(len(doc_ids)))
                while some := list(islice(rows, 1000)):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(doc_ids[some], pa.int64(), mask=~known[some]),
                            pa.array(first + ends[some] - counts[some]),
                            pa.array(counts[some]),
                            pa.array(
                                [ids[ends[k] - counts[k] : ends[k]].tobytes() for k in some],
                                pa.binary(),
                            ),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids"],
                    )

    return files.mapInArrow(
        run,
        T.StructType(
            [
                T.StructField("doc_id", T.LongType()),
                T.StructField("start", T.LongType()),
                T.StructField("n_tokens", T.LongType()),
                T.StructField("ids", T.BinaryType()),
            ]
        ),
    )


def round_trip(docs: DataFrame, path: str, end_id: int = 2) -> DataFrame:
    """Write the ids of ``docs`` and say what the files hold, document by document.

    NULL texts hold the end id alone. An empty table writes no file.
    """
    root = scratch_dir(docs.sparkSession, "token-files")
    found = read(write(docs, path, end_id, root), root)
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


