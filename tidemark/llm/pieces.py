"""Byte-pair encoding with a merge-type piece vocabulary, by backtracking.

Where merges go by score, a sequence of pieces is the encoding of its text if and only if
each piece, and each pair of neighbours, is the encoding of its own text. So the encoder
walks left to right with the longest piece that fits (an Aho-Corasick automaton lists
them), checks it against its neighbour by merging the two anew, falls back to shorter
pieces and then to the piece before, and marks positions from which the rest cannot be
reached in a bitfield, so that none is tried twice. Equal words are encoded once per
worker while they are remembered.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import columns, prepare, remembers

SPACE = "▁"
# The kinds of pieces in a model file.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
WORDS_KEPT, PAIRS_KEPT = 400_000, 1_000_000


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 127) << shift
        shift += 7
        if byte < 128:
            return value, at


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a serialized message."""
    at = 0
    while at < len(data):
        tag, at = _varint(data, at)
        kind = tag & 7
        if kind == 0:
            value, at = _varint(data, at)
        else:
            size = {1: 8, 5: 4}.get(kind)
            if size is None:
                size, at = _varint(data, at)
            value, at = data[at : at + size], at + size
        yield tag >> 3, value


class _Words(dict):
    def __init__(self, encode):
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        value = self[word] = self.encode(word)
        return value


class Pieces:
    """A vocabulary; ``encode`` gives little-endian 32-bit ids, ``decode`` takes them."""

    def __init__(self, path: str, begin: bool = True, end: bool = True):
        with open(path, "rb") as file:
            message = list(_fields(file.read()))
        normalizer = next((dict(_fields(v)) for f, v in message if f == 3), {})
        if normalizer.get(2) or normalizer.get(4, 1):
            raise ValueError("only models that keep the text as it is are supported")
        self.prefix = bool(normalizer.get(3, 1))
        self.text: list[str] = []
        self.score: list[float] = []
        self.ids: dict[str, int] = {}
        self.byte_ids: dict[int, int] = {}
        self.out: list[bytes] = []
        marks: dict[str, int] = {}
        self.automaton = ahocorasick.Automaton()
        for number, value in message:
            if number != 1:
                continue
            piece = dict(_fields(value))
            name, kind, k = piece[1].decode(), piece.get(3, NORMAL), len(self.text)
            self.text.append(name)
            self.score.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
            shown = name.replace(SPACE, " ").encode()
            if kind == USER_DEFINED:
                raise ValueError("user-defined pieces are not supported")
            if kind == BYTE:
                code = int(name[3:5], 16)
                self.byte_ids[code] = k
                shown = bytes([code])
            elif kind in (NORMAL, UNUSED):
                self.ids[name] = k
                self.automaton.add_word(name, k)
            else:
                marks[name] = k
                shown = b"" if kind == CONTROL else " ⁇ ".encode()
            self.out.append(shown)
        self.unknown = marks.get("<unk>", 0)
        self.begin = struct.pack("<I", marks["<s>"]) if begin else b""
        self.end = struct.pack("<I", marks["</s>"]) if end else b""
        self.automaton.make_automaton()
        known = set(self.ids)
        apart = all(SPACE not in p.lstrip(SPACE) for p in known)
        lines = all("\n" not in p for p in known)
        # no piece goes over these cuts, so neither does any merge
        if apart and lines:
            cut = rf"{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+|\n"
        elif apart:
            cut = rf"{SPACE}+[^{SPACE}]*|[^{SPACE}]+"
        else:
            cut = r"(?s).+"
        self.cut = re.compile(cut)
        self.words = _Words(self._encode_word)
        self.pairs: dict[int, bool] = {}
        self.size = [len(t) for t in self.text]
        self.letters = {t for t in self.ids if len(t) == 1}
        # by piece: the next shorter one that begins it
        self.shorter = [
            next((self.ids[t[:k]] for k in range(len(t) - 1, 0, -1) if t[:k] in self.ids), -1)
            for t in self.text
        ]
        self.alone = bytearray(len(self.text))  # 1: encodes itself, 2: does not, 0: unknown

    def merged(self, text: str) -> list[int]:
        """Merge neighbours, the highest score first and of equal ones the leftmost."""
        parts = list(text)
        while len(parts) > 1:
            best = None
            for k in range(len(parts) - 1):
                piece = self.ids.get(parts[k] + parts[k + 1])
                if piece is not None and (best is None or self.score[piece] > best[0]):
                    best = (self.score[piece], k)
            if best is None:
                break
            k = best[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return [self.ids[p] for p in parts]

    def stands(self, piece: int) -> bool:
        """Whether a piece is the encoding of its own text."""
        found = self.merged(self.text[piece]) == [piece]
        self.alone[piece] = 1 if found else 2
        return found

    def fits(self, left: int, right: int) -> bool:
        """Whether two neighbours stay as they are."""
        key = left * len(self.text) + right
        found = self.pairs.get(key)
        if found is None:
            if len(self.pairs) > PAIRS_KEPT:
                self.pairs.clear()
            found = self.merged(self.text[left] + self.text[right]) == [left, right]
            self.pairs[key] = found
        return found

    def _backtracked(self, text: str) -> list[int]:
        """Ids of a text whose characters are all pieces."""
        n, size, alone, pairs = len(text), self.size, self.alone, self.pairs
        shorter, width = self.shorter, len(size)
        longest = [-1] * n  # the longest piece from each place on
        for end, piece in self.automaton.iter(text):
            longest[end - size[piece] + 1] = piece
        out: list[int] = []
        closed = bytearray((n >> 3) + 1)  # the bitfield of positions that lead nowhere
        at, last, piece = 0, -1, longest[0]
        while at < n:
            while piece >= 0:
                state = alone[piece]
                end = at + size[piece]
                if (state == 1 or not state and self.stands(piece)) and not (
                    closed[end >> 3] >> (end & 7) & 1
                ):
                    if last < 0:
                        break
                    fits = pairs.get(last * width + piece)
                    if fits or fits is None and self.fits(last, piece):
                        break
                piece = shorter[piece]
            if piece >= 0:
                out.append(piece)
                at, last = end, piece
                if at < n:
                    piece = longest[at]
                continue
            closed[at >> 3] |= 1 << (at & 7)
            piece = out.pop()
            at -= size[piece]
            last = out[-1] if out else -1
            piece = shorter[piece]
        return out

    def _encode_word(self, word: str) -> bytes:
        if self.letters.issuperset(word):
            ids = self._backtracked(word)
            return struct.pack(f"<{len(ids)}I", *ids)
        ids = []
        known: list[str] = []
        for char in word:
            if char in self.ids:
                known.append(char)
                continue
            if known:
                ids += self._backtracked("".join(known))
                known = []
            raw = char.encode("utf-8", "surrogatepass")
            ids += [self.byte_ids.get(b, self.unknown) for b in raw] if self.byte_ids else [
                self.unknown
            ]
        if known:
            ids += self._backtracked("".join(known))
        return struct.pack(f"<{len(ids)}I", *ids)

    def forget(self) -> None:
        self.words.clear()
        self.pairs.clear()

    def encode(self, text: str | None) -> bytes:
        if not text:
            return self.begin + self.end
        if len(self.words) > WORDS_KEPT:
            self.words.clear()
        spaced = (SPACE if self.prefix else "") + text.replace(" ", SPACE)
        found = map(self.words.__getitem__, self.cut.findall(spaced))
        return b"".join([self.begin, *found, self.end])

    def decode(self, ids: bytes) -> str:
        numbers = np.frombuffer(ids, "<u4").tolist()
        data = b"".join(map(self.out.__getitem__, numbers))
        if self.prefix and data[:1] == b" ":
            data = data[1:]
        return data.decode("utf-8", "replace")


@cache
def pieces(path: str) -> Pieces:
    return Pieces(path)


def coded(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids`` (little-endian 32-bit numbers, with begin and end)
    and ``decoded``, the text they give back, of every row.

    NULL is an empty text: begin and end alone. Texts of any length are encoded whole.
    ``path`` must name the model file on every executor.
    """
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        remembers(model.forget)
        for batch in batches:
            ids = [model.encode(t) for t in columns(batch, "_text")[0]]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(i) // 4 for i in ids], pa.int64()),
                    pa.array(ids, pa.binary()),
                    pa.array([model.decode(i) for i in ids], pa.string()),
                ],
                names=["doc_id", "n_tokens", "ids", "decoded"],
            )

    docs = docs.select("doc_id", F.col(text).alias("_text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(
        run, f"doc_id {kind}, n_tokens long, ids binary, decoded string"
    )


def digests(docs: DataFrame, path: str) -> DataFrame:
    """SHA-256 of the ids and of the decoded text, by Spark's own function."""
    return coded(docs, path).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
