"""Harmonic packing: every document's tokens in sequences of CAPACITY, in one pass and without moving a text.

A piece of length n belongs to the class of the reciprocal 1/k of the capacity that it fits, k = capacity // n, and a bin
of that class takes exactly k pieces. So a bin needs no search and no knowledge of other bins: each task fills the bins
of its own rows, and workers never meet. Documents may be cut, which keeps padding small:

- what exceeds a sequence is cut into whole sequences;
- a rest stays whole if k of its like fill a bin up to SLACK; otherwise the greatest power of two in it is cut off, whose
  class fills its bins exactly;
- bins that are not full when a task ends are opened again. Their pieces are cut into powers of two and laid end to end,
  longest first. Each power of two then starts at a multiple of itself, so they make full sequences and at most one
  sequence of each smaller power of two, which needs no padding.

Encoding is that of the tokenizers library. Latin-1 text goes through tiktoken, four times as fast, by the vocabulary and
word pattern of the same file; both give the same ids there. Between two characters that are no white space, a single
space always begins a new token, so a text is cut there and only words with other letters go to the slower library.

Defined cases: a null or empty text has the closing id alone; each row is a document of its own, also when its doc_id is
null or repeated; special strings inside a text become their ids, as in the library; an empty table has no sequences;
columns other than doc_id and text are not read.
"""

import json
import re
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from pedalflow.llm.common import picked

CAPACITY = 2048
#: The id that closes a document, and the one that fills up a sequence.
END = 1
PAD = 1
#: A bin may lack one token in so many and count as full.
SLACK = 128
#: A text in words, each with what white space stands before it unless that is a single space.
_WORD = re.compile(r"(?:^| )(?:(?!(?<=\S) (?=\S)).)+", re.DOTALL)
#: Fixed value: the pattern of words of byte-level vocabularies.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable ones for themselves, the rest from 256 up."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _in_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class Encoder:
    """Texts to ids, as little-endian unsigned 32-bit integers, by a vocabulary file of byte-level BPE."""

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_letters()
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(letters[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
        self.fast = tiktoken.Encoding("fast", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self.special = list(special)

    def plain(self, text: str) -> bool:
        return _in_latin(text) and not any(s in text for s in self.special)

    def encode(self, text: str) -> bytes:
        if self.plain(text):
            ids = self.fast.encode_ordinary(text)
        else:
            # The rest of the text still goes the fast way. A word keeps the space before it.
            ids = []
            for plain, words in groupby(_WORD.findall(text), self.plain):
                stretch = "".join(words)
                ids += self.fast.encode_ordinary(stretch) if plain else self.library.encode(stretch, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a file; reading the file takes longer than a small task."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def cut(length: int, capacity: int = CAPACITY) -> list[int]:
    """The lengths of the pieces of a document."""
    out = [capacity] * (length // capacity)
    rest = length % capacity
    while rest:
        if capacity % rest <= capacity // SLACK:
            return [*out, rest]
        power = 1 << (rest.bit_length() - 1)
        out.append(power)
        rest -= power
    return out


class Packer:
    """The bins of one task. A piece is (doc_id, start, length, doc_tokens, ids); finished sequences are lists of pieces."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.open: dict[int, list[tuple]] = {}

    def add(self, doc_id, ids: bytes) -> Iterator[list[tuple]]:
        """Cut a document and give the bins that its pieces complete."""
        at, total = 0, len(ids) // 4
        for length in cut(total, self.capacity):
            count = self.capacity // length
            held = self.open.setdefault(count, [])
            held.append((doc_id, at, length, total, ids[4 * at : 4 * (at + length)]))
            at += length
            if len(held) == count:
                yield self.open.pop(count)

    def close(self) -> Iterator[list[tuple]]:
        """The sequences of all bins that are not full."""
        pieces = []
        for doc_id, start, length, total, ids in (p for held in self.open.values() for p in held):
            at = 0
            while at < length:
                power = 1 << ((length - at).bit_length() - 1)
                pieces.append((doc_id, start + at, power, total, ids[4 * at : 4 * (at + power)]))
                at += power
        self.open = {}
        pieces.sort(key=lambda p: -p[2])
        left = sum(p[2] for p in pieces)
        held, filled = [], 0
        for piece in pieces:
            held.append(piece)
            filled += piece[2]
            # Whole sequences first, then the powers of two that make up what is left.
            if filled == min(self.capacity, 1 << (left.bit_length() - 1)):
                yield held
                left -= filled
                held, filled = [], 0


_PIECE = "struct<doc_id: {kind}, start: bigint, length: bigint, doc_tokens: bigint, offset: bigint>"


def _rows(sequences: list[tuple[int, list[tuple]]], kind: pa.DataType, capacity: int) -> pa.RecordBatch:
    pieces = [p for _, held in sequences for p in held]
    sizes = np.array([len(held) for _, held in sequences], np.int64)
    lengths = np.array([p[2] for p in pieces], np.int64)
    firsts = np.concatenate(([0], np.cumsum(sizes)))
    before = np.concatenate(([0], np.cumsum(lengths)))
    filled = before[firsts[1:]] - before[firsts[:-1]]
    offsets = before[:-1] - np.repeat(before[firsts[:-1]], sizes)
    padding = [b"" if n & (n - 1) == 0 else np.full(capacity - n, PAD, "<u4").tobytes() for n in filled.tolist()]
    fields = {
        "doc_id": pa.array([p[0] for p in pieces], kind),
        "start": pa.array([p[1] for p in pieces], pa.int64()),
        "length": pa.array(lengths),
        "doc_tokens": pa.array([p[3] for p in pieces], pa.int64()),
        "offset": pa.array(offsets, pa.int64()),
    }
    nested = pa.ListArray.from_arrays(pa.array(firsts, pa.int32()), pa.StructArray.from_arrays(list(fields.values()), list(fields)))
    ids = [b"".join([*(p[4] for p in held), pad]) for (_, held), pad in zip(sequences, padding, strict=True)]
    columns = [pa.array([n for n, _ in sequences], pa.int64()), pa.array(filled, pa.int64()), pa.array(ids, pa.binary()), nested]
    return pa.RecordBatch.from_arrays(columns, ["sequence_id", "tokens", "ids", "pieces"])


def packed(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """A row for each sequence: ``sequence_id``, its ``tokens`` without padding, ``ids`` with padding, and its ``pieces``.

    ``ids`` are little-endian unsigned 32-bit integers; ``path`` is a vocabulary file, ``capacity`` a power of two. A
    sequence whose tokens are a power of two is not padded.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError(f"the capacity must be a power of two, not {capacity}")
    df = picked(docs, doc_id="doc_id", text="text")
    end = np.array([END], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, packer = encoder(path), Packer(capacity)
        # Numbers of a task are its own, and the same when it is run again.
        number = TaskContext.get().partitionId() << 40
        ready: list[tuple[int, list[tuple]]] = []
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                for held in packer.add(doc_id, own.encode(text.as_py() or "") + end):
                    ready.append((number, held))
                    number += 1
                if len(ready) >= 256:
                    yield _rows(ready, kind, capacity)
                    ready = []
        for held in packer.close():
            ready.append((number, held))
            number += 1
        if ready:
            yield _rows(ready, kind, capacity)

    piece = _PIECE.format(kind=df.schema["doc_id"].dataType.simpleString())
    return df.mapInArrow(run, f"sequence_id bigint, tokens bigint, ids binary, pieces array<{piece}>")
