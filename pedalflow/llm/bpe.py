"""BPE encoding and decoding of whole texts with a public vocabulary file.

The file names its normalisation (NFC, white space, lower case), the pattern of words and the merges. Words repeat, so
those that the vocabulary has as a whole, and names as frequent by that, are compiled once: a minimal acyclic transducer,
whose states share suffixes and whose arcs carry numbers
that add up to a word's place in a table of ids. It is a few flat arrays; executors map them from a file of their own
and walk them without building anything. All other words are merged, exactly, by rank.

The lexicon is a speed-up that depends on the file alone: no document is read or counted for it, and what it holds changes
no result. A worker keeps the ids of words it has met from one task to the next, a bounded number of them.

Latin-1 texts are normalised and cut into words here. Others go through the library's own normaliser and word splitter
for the file, as its tables of letters and capitals are not those of Python.

Defined cases: a null text is empty and has no ids; special strings inside a text become their ids, as the file says;
repeated rows have equal results; an empty table is empty; only doc_id and text are read.
"""

import json
import mmap
import os
import tempfile
import zlib
from array import array
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tokenizers
from pyspark.sql import DataFrame

from pedalflow.llm.common import picked

KEPT = 300_000
_NEVER = 1 << 62


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte: printable ones for themselves, the rest from 256 upwards."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Lexicon:
    """A minimal acyclic transducer from words to places in a table, as flat arrays.

    State s has the arcs ``first[s]`` to ``first[s + 1]``, sorted by letter; ``skip`` of an arc is how many words come
    before those behind it, so the skips along a word, and its earlier ends, add up to its place in sorted order.
    """

    NAMES = ("first", "final", "letter", "target", "skip", "start", "ids")

    def __init__(self, **arrays: np.ndarray):
        for name in self.NAMES:
            # Plain views: a single number is read from them much faster than from an array.
            setattr(self, name, memoryview(arrays[name]))

    @classmethod
    def compile(cls, entries: dict[str, list[int]]) -> "Lexicon":
        """Build from sorted words; states that accept the same suffixes become one as soon as no word can extend them."""
        words = sorted(entries)
        known: dict[tuple, int] = {}
        states: list[tuple[bool, tuple]] = []

        def register(final: bool, arcs: list) -> int:
            key = (final, tuple(arcs))
            if key not in known:
                known[key] = len(states)
                states.append(key)
            return known[key]

        path: list[list] = [[False, []]]  # unfinished states along the last word
        last = ""

        def close(depth: int) -> None:
            while len(path) > depth + 1:
                final, arcs = path.pop()
                path[-1][1].append((last[len(path) - 1], register(final, arcs)))

        for word in words:
            same = len(os.path.commonprefix([last, word]))
            close(same)
            path.extend([False, []] for _ in word[same:])
            path[-1][0] = True
            last = word
        close(0)
        root = register(*path[0])
        # Targets are registered before the states that lead to them, so counts follow in that order.
        counts, first, letter, target, skip = [], [0], [], [], []
        for final, arcs in states:
            total = int(final)
            for char, to in arcs:
                letter.append(ord(char))
                target.append(to)
                skip.append(total)
                total += counts[to]
            counts.append(total)
            first.append(len(letter))
        start = np.cumsum([0, *(len(entries[w]) for w in words)])
        flat = [i for w in words for i in entries[w]]
        # The root is the last state.
        assert root == len(states) - 1
        return cls(
            first=np.array(first, np.int32),
            final=np.array([f for f, _ in states], np.int32),
            letter=np.array(letter, np.int32),
            target=np.array(target, np.int32),
            skip=np.array(skip, np.int32),
            start=start.astype(np.int32),
            ids=np.array(flat, np.int32),
        )

    def packed(self) -> bytes:
        views = [getattr(self, n) for n in self.NAMES]
        return np.array([len(v) for v in views], np.int32).tobytes() + b"".join(v.tobytes() for v in views)

    @classmethod
    def mapped(cls, packed: bytes) -> "Lexicon":
        """Map the arrays from a file in this machine's own temporary folder; the file has no name once it is mapped."""
        with tempfile.TemporaryFile() as file:
            file.write(packed)
            file.flush()
            view = np.frombuffer(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ), np.int32)
        at, arrays = len(cls.NAMES), {}
        for name, size in zip(cls.NAMES, view[: len(cls.NAMES)].tolist(), strict=True):
            arrays[name] = view[at : at + size]
            at += size
        return cls(**arrays)

    def find(self, word: str) -> list[int] | None:
        first, letter, skip, target = self.first, self.letter, self.skip, self.target
        state, place = len(first) - 2, 0
        for char in map(ord, word):
            high = first[state + 1]
            arc = bisect_left(letter, char, first[state], high)
            if arc == high or letter[arc] != char:
                return None
            place += skip[arc]
            state = target[arc]
        if not self.final[state]:
            return None
        return self.ids[self.start[place] : self.start[place + 1]].tolist()


class Tokenizer:
    """What the vocabulary file says, and exact merging of single words."""

    def __init__(self, path: str):
        self.path = path
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        self.suffix = suffix = model.get("end_of_word_suffix") or ""
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        #: For a pair of ids, as one number, its rank and the id it merges into, as one number too.
        self.merges = {vocab[a] << 32 | vocab[b]: rank << 32 | vocab[a + b] for rank, (a, b) in enumerate(pairs)}
        letters = byte_letters()
        self.inner = [vocab[letters[b]] for b in range(256)]
        self.last = [vocab[letters[b] + suffix] for b in range(256)]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        self.marks = regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) or r"(?!)")
        self.word = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        library = tokenizers.Tokenizer.from_file(path)
        self.normalizer, self.splitter = library.normalizer, tokenizers.pre_tokenizers.Split(
            tokenizers.Regex(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]), "removed", invert=True
        )

    def words(self, text: str) -> list[str]:
        """The normalised words of a text without special strings."""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return [w for w, _ in self.splitter.pre_tokenize_str(self.normalizer.normalize_str(text))]
        return self.word.findall(text.lower())

    def whole_words(self) -> list[str]:
        """The words that the vocabulary has as one token each, in its order."""
        raw = {letter: b for b, letter in byte_letters().items()}
        words = []
        for token in self.names.values():
            own = token.removesuffix(self.suffix)
            if own and token.endswith(self.suffix) and all(c in raw for c in own):
                try:
                    words.append(bytes(raw[c] for c in own).decode())
                except UnicodeDecodeError:  # a part of a letter
                    continue
        return words

    def merged(self, word: str) -> list[int]:
        """Ids of one word: join the pair of least rank, its first place, until none is left."""
        raw = word.encode("utf-8", "surrogatepass")
        inner, merge = self.inner, self.merges.get
        parts = [inner[b] for b in raw]
        parts[-1] = self.last[raw[-1]]
        steps = [merge(a << 32 | b, _NEVER) for a, b in zip(parts, parts[1:], strict=False)]
        while steps:
            best = min(steps)
            if best == _NEVER:
                break
            at = steps.index(best)
            # What a pair merges into takes part in later merges only, so no step before this one can come up now.
            joined = best & 0xFFFFFFFF
            parts[at : at + 2] = [joined]
            del steps[at]
            if at:
                steps[at - 1] = merge(parts[at - 1] << 32 | joined, _NEVER)
            if at < len(steps):
                steps[at] = merge(joined << 32 | parts[at + 1], _NEVER)
        return parts

    def pieces(self, text: str) -> Iterator[tuple[str | None, str]]:
        """A text as stretches of ordinary text and special strings: (special or None, ordinary text before it)."""
        at = 0
        for mark in self.marks.finditer(text) if "<|" in text else ():
            yield mark.group(), text[at : mark.start()]
            at = mark.end()
        yield None, text[at:]


class Encoder:
    """Encode and decode texts with a lexicon in front of the merges."""

    def __init__(self, tokenizer: Tokenizer, lexicon: Lexicon | None):
        self.tokenizer, self.lexicon = tokenizer, lexicon
        # Words met lately, and those met before them: a word that comes again is carried over.
        self.kept: dict[str, tuple[bytes, str]] = {}
        self.older: dict[str, tuple[bytes, str]] = {}

    def _word(self, word: str) -> tuple[bytes, str]:
        """The ids of a word as little-endian bytes, and its decoded text."""
        out = self.older.get(word)
        if out is None:
            ids = self.lexicon.find(word) if self.lexicon else None
            if ids is None:
                ids = self.tokenizer.merged(word)
            names = self.tokenizer.names
            out = array("I", ids).tobytes(), " ".join([names[i] for i in ids])
        if len(self.kept) >= KEPT:
            self.older, self.kept = self.kept, {}
        self.kept[word] = out
        return out

    def encode(self, text: str) -> tuple[bytes, str]:
        """All ids of a text, and what they decode to. The file names no decoder: tokens are joined by spaces."""
        ids, decoded = [], []
        kept, own = self.kept, self._word
        for special, plain in self.tokenizer.pieces(text):
            found = [kept.get(w) or own(w) for w in self.tokenizer.words(plain)] if plain else []
            kept = self.kept
            ids += [f[0] for f in found]
            decoded += [f[1] for f in found if f[0]]
            if special is not None:
                ids.append(array("I", [self.tokenizer.special[special]]).tobytes())
                decoded.append(special)
        return b"".join(ids), " ".join(decoded)


_encoders: dict[tuple[str, int], Encoder] = {}


def worker_encoder(path: str, packed: bytes) -> Encoder:
    """The worker's encoder for a file and lexicon, with the words of its earlier tasks; only the last one is held."""
    key = path, zlib.crc32(packed)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(Tokenizer(path), Lexicon.mapped(packed))
    return _encoders[key]


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ``ids`` as little-endian unsigned 32-bit integers in binary, and the ``decoded`` text."""
    df = picked(docs, doc_id="doc_id", text="text")
    tokenizer = Tokenizer(path)
    lexicon = Lexicon.compile({w: tokenizer.merged(w) for w in tokenizer.whole_words()})
    shared = df.sparkSession.sparkContext.broadcast(lexicon.packed())  # bounded by the vocabulary
    kind = df.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(path, shared.value)
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                rows = [encoder.encode(t or "") for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.string())],
                    ["doc_id", "ids", "decoded"],
                )

    return df.mapInArrow(run, f"doc_id {kind}, ids binary, decoded string")
