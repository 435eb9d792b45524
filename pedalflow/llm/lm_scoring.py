"""Language-model scores by stupid backoff, with n-gram counts over the whole corpus and each occurrence left out.

A word after two others scores its share of their count; if the three are met nowhere else, 0.4 times its share after one
word, and else 0.16 times its share of all words. A count never includes the occurrence that is scored.

Each word of the corpus becomes one record: the word, its neighbours and its document. Records are dealt by hash of the
middle word b. In that place are all counts that have b in the middle, at the end or at the start: of a b c, a b, b c and
b. So one shuffle brings count tables and exploded n-grams together: a record there settles how c scores after a b and
after b, and how b scores by itself where a b is met nowhere else. Documents then add up what their records scored.

Records of a place travel as packed columns: common words of a bounded sample as numbers known everywhere, other words
as one hash each, records as numbers in order of the middle word, compressed. What they scored goes back, packed too, to
the slice of documents they came from, so no document becomes a row for each place. A slice is known by its ids, so the
rows of a task should come in the same order when it runs again, as those of a stored table do.

A word with more records than a place should hold is split: by the word before for counts of a b, by the word after for
counts of b c. Where that pair is as frequent, its records are split by the third word, and where all three are, by
document. Such n-grams are found in a bounded sample of documents and then counted exactly over all, so their counts are
known in every place, and the number of ways they are split grows with their counts. One missed by the sample is only
slower.

Defined cases: a null or empty text has no words and a null score; repeated rows share one doc_id and are scored
together; a row without doc_id counts for others and is scored under null; an empty table is empty.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pedalflow.llm.common import picked
from pedalflow.llm.shingles import word_bytes
from pedalflow.session import stored

BACKOFF = 0.4
#: Records in a place, on average, and characters that a task turns into records at once.
PLACE = 2_000_000
SLICE_CHARS = 16_000_000
#: Records of a place that are settled at once, and words that travel as numbers.
PART = 500_000
COMMON = 65_536
#: Documents of the sample for frequent n-grams: so many, or as have SIGHTINGS / share words, where share is that of a
#: place. At FREQUENT it stops falling, which bounds the sample and the list of frequent n-grams (1 / FREQUENT a length).
SAMPLE = 2_000
SIGHTINGS = 50
FREQUENT = 1e-5
EDGE = 0
_MIX = np.uint64(0x9E3779B97F4A7C15)


class _Numbers(dict):
    """Numbers for words, in order of their first use."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


class Frequent:
    """Exact counts of the frequent n-grams of one length, by hash."""

    def __init__(self, counts: dict[int, int]):
        self.keys = np.array(sorted(counts), np.uint64)
        self.counts = np.array([counts[k] for k in sorted(counts)], np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The count of each key, 0 for those that are not frequent."""
        if not len(self.keys):
            return np.zeros(len(keys), np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.counts[at], 0)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return x ^ (x >> np.uint64(29))


def _joint(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Hash of an n-gram x with y after it."""
    return _mixed(_mixed(x) + np.uint64(3) * y)


class _Slice:
    """The records of some texts: words as numbers into ``names``, their ascending hashes; ``names[0]`` is EDGE."""

    def __init__(self, texts: list[str | None]):
        numbers = _Numbers()
        found = [np.fromiter(map(numbers.__getitem__, w), np.int32, len(w)) for w in map(word_bytes, texts)]
        self.sizes = np.array([len(f) for f in found], np.int64)
        hashes = np.fromiter((xxhash.xxh64_intdigest(w) | 1 for w in numbers), np.uint64, len(numbers))
        # Two words of one hash are one word everywhere.
        self.names, number = np.unique(np.concatenate((np.array([EDGE], np.uint64), hashes)), return_inverse=True)
        self.b = number.astype(np.int32)[1:][np.concatenate(found)] if found else np.zeros(0, np.int32)
        stops = np.cumsum(self.sizes)[self.sizes > 0]
        starts = stops - self.sizes[self.sizes > 0]
        self.a, self.c = np.roll(self.b, 1), np.roll(self.b, -1)
        self.a[starts] = self.c[stops - 1] = EDGE
        self.owner = np.repeat(np.arange(len(self.sizes), dtype=np.int32), self.sizes)
        #: Whether the word is its text's second: its context has one word.
        self.second = np.zeros(len(self.b), bool)
        self.second[starts[stops - starts > 1] + 1] = True

    def keys(self, rows: np.ndarray, length: int, after: bool = False) -> np.ndarray:
        """Hashes of b, of a b (or b c), or of a b c."""
        b = self.names[self.b[rows]]
        if length == 1:
            return b
        if length == 2:
            return _joint(b, self.names[self.c[rows]]) if after else _joint(self.names[self.a[rows]], b)
        return _joint(_joint(self.names[self.a[rows]], b), self.names[self.c[rows]])


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of SLICE_CHARS bytes of text or a single row."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False))
        first = 0
        while first < batch.num_rows:
            before = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, before + SLICE_CHARS, "right")))
            yield batch.slice(first, last - first)
            first = last


def _planes(x: np.ndarray, width: int) -> bytes:
    """Bytes of equal weight together: they compress best."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(-1, width).T).tobytes()


def _from_planes(raw: bytes, kind: type, n: int, at: int) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.frombuffer(raw, np.uint8, width * n, at).reshape(width, n).T.copy().view(kind).ravel()


def _numbered(names: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for each name: 0 for EDGE, then the common words, then the others; and the others, ascending."""
    order = np.argsort(common)
    number = np.zeros(len(names), np.uint32)
    other = names != EDGE
    if len(common):
        at = np.minimum(np.searchsorted(common[order], names), len(common) - 1)
        met = common[order][at] == names
        number[met] = order[at[met]] + 1
        other &= ~met
    number[other] = len(common) + 1 + np.arange(other.sum())
    return number, names[other]


def _pack(others: np.ndarray, shared: int, a: np.ndarray, b: np.ndarray, c: np.ndarray, doc: np.ndarray) -> bytes:
    """Records sorted by middle word; numbers beyond those ``shared`` everywhere are places in a list of other words."""
    order = np.lexsort((doc, b))
    columns = [x[order] for x in (a, b, c)]
    used = np.zeros(len(others), bool)
    for x in columns:
        used[x[x >= shared] - shared] = True
    place = np.cumsum(used, dtype=np.uint32) + np.uint32(shared - 1)
    for x in columns:
        x[x >= shared] = place[x[x >= shared] - shared]
    head = np.array([used.sum(), len(a)], np.uint64).tobytes()
    steps = np.diff(others[used], prepend=np.uint64(0))
    return zstandard.ZstdCompressor(level=3).compress(head + _planes(steps, 8) + b"".join(_planes(x.astype(np.uint32), 4) for x in (*columns, doc[order])))


def _unpack(blob: bytes) -> tuple[np.ndarray, list[np.ndarray]]:
    """The other words, and a, b, c and doc."""
    raw = zstandard.ZstdDecompressor().decompress(blob)
    size, n = np.frombuffer(raw, np.uint64, 2).tolist()
    others = np.cumsum(_from_planes(raw, np.uint64, size, 16), dtype=np.uint64)
    return others, [_from_planes(raw, np.uint32, n, 16 + 8 * size + 4 * n * k) for k in range(4)]


def _groups(first: np.ndarray, then: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of each record among those equal in both 32-bit keys, and its size."""
    key = first.astype(np.uint64) << np.uint64(32) | then
    order = np.argsort(key)
    fresh = np.ones(len(key), bool)
    fresh[1:] = np.diff(key[order]) != 0
    group = np.empty(len(key), np.uint32)
    group[order] = np.cumsum(fresh, dtype=np.uint32) - np.uint32(1)
    return group, np.bincount(group)[group] if len(group) else np.zeros(0, np.int64)


def settled(
    names: np.ndarray, a: np.ndarray, b: np.ndarray, c: np.ndarray, second: np.ndarray, role: str, frequent: list[Frequent]
) -> tuple[np.ndarray, np.ndarray]:
    """What each record adds to its document: log score without the size of the corpus, and how often that is due.

    ``a``, ``b`` and ``c`` are 32-bit places in ``names``, of which the first is EDGE; ``second`` marks words with a single word before them in their
    text. ``role`` says which counts are whole here: "all"; "before", where only those of a b are; "after", where only
    those of b c are. Counts of ``frequent`` n-grams are known and need not be whole.
    """
    words, pairs, triples = frequent
    known = words(names)[b]
    of_b = np.where(known > 0, known, np.bincount(b, minlength=len(names))[b])
    ab, of_ab = _groups(a, b)
    of_abc = _groups(ab, c)[1]
    if len(pairs.keys):
        hot = np.nonzero(known)[0]
        before = _joint(names[a[hot]], names[b[hot]])
        known = pairs(before)
        of_ab[hot] = np.where(known > 0, known, of_ab[hot])
        known = triples(_joint(before, names[c[hot]]))
        of_abc[hot] = np.where(known > 0, known, of_abc[hot])
    inner, outer = a > 0, c > 0
    three = inner & outer & (of_abc > 1)
    score, due = np.zeros(len(a)), np.zeros(len(a), np.int64)
    if role != "after":
        score[three] += np.log((of_abc[three] - 1) / (of_ab[three] - 1))
        alone = ~inner | (of_ab <= 1)
        weight = np.where(~inner, 0, np.where(second, 1, 2)) * math.log(BACKOFF)
        score[alone] += weight[alone] + np.log(np.maximum(of_b[alone] - 1, 0.5))
        due[alone] += 1
    if role != "before":
        of_bc = _groups(b, c)[1]
        if len(pairs.keys):
            known = pairs(_joint(names[b[hot]], names[c[hot]]))
            of_bc[hot] = np.where(known > 0, known, of_bc[hot])
        two = outer & ~three & (of_bc > 1)
        score[two] += np.where(inner[two], math.log(BACKOFF), 0.0) + np.log((of_bc[two] - 1) / (of_b[two] - 1))
    return score, due


def _tallied(spec: list[Frequent] | None):
    """Counts of n-grams by length and hash: all of them, or those in ``spec``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            part = _Slice(batch.column("text").to_pylist())
            rows = np.arange(len(part.b))
            for length in (1, 2, 3):
                if spec and not len(spec[length - 1].keys):
                    break
                keys = part.keys(rows, length)
                if length == 2:  # a pair is counted at its second word, or at its first where a text ends
                    keys = np.concatenate((keys, part.keys(rows[part.c[rows] == EDGE], 2, after=True)))
                if spec:
                    keys = keys[spec[length - 1](keys) > 0]
                found, n = np.unique(keys, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), length, np.int32)), pa.array(found.view(np.int64)), pa.array(n)], ["length", "key", "n"])
                if spec and length == 1:
                    rows = rows[spec[0](part.names)[part.b[rows]] > 0]

    return run


def _frequent(docs: DataFrame, share: float, size: int) -> tuple[list[Frequent], np.ndarray]:
    """Exact counts of words, pairs and triples that make up over ``share`` of a bounded sample of ``size`` documents.

    Also the hashes of its COMMON most frequent words that it has twice at least.
    """
    columns = "length int, key bigint, n bigint"
    chosen = docs.where("doc_id is not null").select(F.xxhash64("doc_id").alias("h")).orderBy("h").limit(size).distinct()
    sample = docs.select("text", F.xxhash64("doc_id").alias("d")).join(chosen, F.expr("d = h"), "left_semi").select("text")
    found = stored(sample.mapInArrow(_tallied(None), columns).groupBy("length", "key").agg(F.sum("n").alias("n")), "ngrams")
    total = found.where("length = 1").agg(F.sum("n")).first()[0] or 0
    names = found.where(F.col("n") > share * total).collect()
    common = found.where("length = 1 and n > 1").orderBy(F.desc("n"), "key").limit(COMMON).select("key").collect()
    common = np.array([r["key"] for r in common], np.int64).view(np.uint64)

    def by_length(rows: list) -> list[Frequent]:
        return [Frequent({r["key"] % 2**64: r["n"] for r in rows if r["length"] == k}) for k in (1, 2, 3)]

    spec = by_length(names)
    if not names:
        return spec, common
    return by_length(docs.select("text").mapInArrow(_tallied(spec), columns).groupBy("length", "key").agg(F.sum("n").alias("n")).collect()), common


def _places(part: _Slice, frequent: list[Frequent], place: int, places: int) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    """Role, records and their places. A frequent n-gram is dealt in as many ways as it would fill half places."""
    words, pairs, triples = frequent
    home = _mixed(part.names)
    of_word = words(part.names)
    hot = of_word[part.b] > 0
    rows = np.nonzero(~hot)[0]
    yield "all", rows, (home % np.uint64(places)).astype(np.int32)[part.b[rows]]
    rows = np.nonzero(hot)[0]

    def dealt(base: np.ndarray, counts: np.ndarray, by: np.ndarray) -> np.ndarray:
        return _mixed(base + by % (1 + 2 * counts // place).astype(np.uint64))

    for role, near, far in (("before", part.a, part.c), ("after", part.c, part.a)):
        key = dealt(home[part.b[rows]], of_word[part.b[rows]], home[near[rows]])
        if len(pairs.keys):
            pair = part.keys(rows, 2, after=role == "after")
            counts = pairs(pair)
            key = np.where(counts > 0, dealt(pair, counts, home[far[rows]]), key)
            triple = part.keys(rows, 3)
            counts = triples(triple)
            key = np.where(counts > 0, dealt(triple, counts, _mixed(part.owner[rows].astype(np.uint64))), key)
        yield role, rows, (key % np.uint64(places)).astype(np.int32)


def scored(docs: DataFrame, place: int = PLACE) -> DataFrame:
    """doc_id, n_tokens, ``log_score`` summed over the words of the document, and ``per_token``, its mean."""
    df = picked(docs, doc_id="doc_id", text="text")
    kind = df.schema["doc_id"].dataType.simpleString()
    first = df.agg(F.sum(F.length("text")).alias("chars"), F.count(F.lit(1)).alias("docs")).first()
    guess = (first["chars"] or 0) // 6 + 1
    places = max(guess // place + 1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # An n-gram is split only if it would fill a place: records of a split word travel twice.
    share = max(FREQUENT, 1 / places)
    known = df.sparkSession.sparkContext.broadcast(_frequent(df, share, max(SAMPLE, int(SIGHTINGS / share * first["docs"] / guess))))
    fields = ["place", "role", "slice", "packed", "docs"]

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, common = known.value
        for batch in _slices(batches):
            part, ids = _Slice(batch.column("text").to_pylist()), batch.column("doc_id")
            # Slices of equal ids may well be summed as one: each place in them has the same doc_id.
            slice_id = pa.array([xxhash.xxh64_intdigest(repr(ids.to_pylist())) - 2**63], pa.int64())
            # Ids and token counts, under place -1.
            yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int32()), pa.array([""]), slice_id, pa.array([part.sizes.tobytes()], pa.binary()), pa.array([ids.to_pylist()], pa.list_(ids.type))], fields)
            number, others = _numbered(part.names, common)
            a, b, c, doc = number[part.a], number[part.b], number[part.c], part.owner * 2 + part.second
            for role, rows, at in _places(part, frequent, place, places):
                order = np.argsort(at, kind="stable")
                cuts = np.searchsorted(at[order], np.arange(places + 1))
                for p in np.nonzero(np.diff(cuts))[0].tolist():
                    mine = rows[order[cuts[p] : cuts[p + 1]]]
                    blob = _pack(others, len(common) + 1, a[mine], b[mine], c[mine], doc[mine])
                    yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), pa.array([role]), slice_id, pa.array([blob], pa.binary()), pa.array([None], pa.list_(ids.type))], fields)

    def settle(key: tuple, group: pa.Table) -> pa.Table:
        if key[0].as_py() < 0:
            return group.select(["slice", "packed", "docs"])
        frequent, common = known.value
        shared = len(common) + 1
        words, parts, named, start = [], [], [], 0
        for blob in group.column("packed"):
            others, (a, b, c, doc) = _unpack(blob.as_py())
            docs_of, near = np.unique(doc >> 1, return_inverse=True)
            words.append(others)
            named.append(docs_of)
            parts.append((a, b, c, (near + start).astype(np.uint32), (doc & 1).astype(bool)))
            start += len(docs_of)
        others, back = np.unique(np.concatenate(words), return_inverse=True)
        back = np.split((back + shared).astype(np.uint32), np.cumsum([len(w) for w in words])[:-1])
        for own, columns in zip(back, parts, strict=True):
            for x in columns[:3]:
                x[x >= shared] = own[x[x >= shared] - shared]
        a, b, c, owner, second = (np.concatenate([p[k] for p in parts]) for k in range(5))
        del words, parts, back
        vocabulary = np.concatenate((np.array([EDGE], np.uint64), common, others))
        # Middle words are settled some at a time, so that only their records need room for counts.
        ways = len(a) // PART + 1
        turn = ((_mixed(vocabulary) >> np.uint64(40)) % np.uint64(ways)).astype(np.int32)[b]
        score, due = np.zeros(start), np.zeros(start)
        for k in range(ways):
            mine = np.nonzero(turn == k)[0]
            found = settled(vocabulary, a[mine], b[mine], c[mine], second[mine], key[1].as_py(), frequent)
            for total, x in zip((score, due), found, strict=True):
                total += np.bincount(owner[mine], x, start)
        cuts = np.cumsum([len(x) for x in named])[:-1]
        rows = zip(named, np.split(score, cuts), np.split(due.astype(np.uint32), cuts), strict=True)
        packed = [zstandard.ZstdCompressor(level=1).compress(_planes(n, 4) + s.tobytes() + _planes(d, 4)) for n, s, d in rows]
        return pa.table({"slice": group.column("slice"), "packed": pa.array(packed, pa.binary()), "docs": group.column("docs")})

    def add_up(group: pa.Table) -> pa.Table:
        """The sums of one slice."""
        whole = group.filter(pc.is_valid(group.column("docs")))
        ids = whole.column("docs").chunk(0)[0].values
        score, due = np.zeros(len(ids)), np.zeros(len(ids), np.int64)
        for blob in group.filter(pc.is_null(group.column("docs"))).column("packed"):
            raw = zstandard.ZstdDecompressor().decompress(blob.as_py())
            n = len(raw) // 16
            at = _from_planes(raw, np.uint32, n, 0)
            score[at] += np.frombuffer(raw, np.float64, n, 4 * n)
            due[at] += _from_planes(raw, np.uint32, n, 12 * n)
        sizes = sum(np.frombuffer(x.as_py(), np.int64) for x in whole.column("packed"))
        return pa.table({"doc_id": ids, "score": score, "due": due, "n": sizes})

    blobs = df.mapInArrow(records, f"place int, role string, slice bigint, packed binary, docs array<{kind}>")
    # Rows with ids need no place: each of them passes where it is.
    dealt = blobs.withColumn("salt", F.when(F.col("place") < 0, F.col("slice")).otherwise(F.lit(0)))
    settled_rows = dealt.groupBy("place", "role", "salt").applyInArrow(settle, f"slice bigint, packed binary, docs array<{kind}>")
    parts = settled_rows.groupBy("slice").applyInArrow(add_up, f"doc_id {kind}, score double, due bigint, n bigint")
    sums = stored(parts.groupBy("doc_id").agg(F.sum("score").alias("score"), F.sum("due").alias("due"), F.sum("n").alias("n_tokens")), "scores")
    size = sums.agg(F.sum("n_tokens")).first()[0] or 1
    total = F.when(F.col("n_tokens") > 0, F.col("score") - F.col("due") * F.lit(math.log(size)))
    return sums.select("doc_id", "n_tokens", total.alias("log_score"), (total / F.col("n_tokens")).alias("per_token"))
