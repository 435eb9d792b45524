"""Spelling variants: words one edit apart, each led to the far more frequent word it is a variant of.

Words are counted over all documents, in each task first. The vocabulary is sorted twice, once forwards and once with its
words reversed, and cut into tiles of bounded size. A tile's words are the queries of a scan over a tile: the scan goes
through the sorted words and holds, for each prefix of the word it is at, the banded row of the edit matrix (three cells)
of every query that is still within one edit. The next word reuses the rows of the prefix it shares with the last one,
and where no query is left, all words with that prefix are skipped. The rows of all queries lie side by side in arrays.

Which tiles meet: of two words one edit apart, either the first half of the query is a prefix of the other word too, or
the rest of it is a suffix. So the forward scan asks for that prefix unchanged, the backward scan for that suffix, and
no pair is missed; a pair that both would find counts in the first. Halves have three letters at least, so tiles meet
only where they hold words with the same three letters in front; a group of words that fills many tiles becomes pairs of
tiles, each a bounded piece of work.

Defined cases: a null or empty text has no words; a null doc_id counts as empty text in the hash that deletes letters;
repeated rows count as often as they occur; an empty table gives an empty result; columns other than doc_id and text are
not read; words of any length are whole, a tile holds fewer of them.
"""

import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pedalflow.session import stored

#: Code points and occurrences a word needs, and how much more frequent its form must be.
LEAST_LETTERS = 6
LEAST_COUNT = 5
RATIO = 5
#: One occurrence in so many, by hash, loses a letter.
DELETES = 199
#: Words and code points of a tile.
TILE = 16_000
TILE_CHARS = 1 << 20
#: Different words a task counts before it hands them on.
HELD = 400_000
_LAST = "\U0010ffff"
_LOWER = {c: c + 32 for c in range(65, 91)}
_RUN = re.compile(r"[A-Za-zÀ-ÿ]{%d,}" % LEAST_LETTERS)


def words_of(doc_id: str, text: str) -> Counter:
    """The words of one text with their counts: runs of letters, of which the hash picks some to lose a letter."""
    runs = Counter(_RUN.findall(text.translate(_LOWER) if not text.isascii() else text.lower()))
    start = zlib.crc32(f"{doc_id}:".encode())
    found: Counter = Counter()
    for run, n in runs.items():
        h = zlib.crc32(run.encode(), start)
        if h % DELETES:
            found[run] += n
        elif len(run) > LEAST_LETTERS:
            at = h % len(run)
            found[run[:at] + run[at + 1 :]] += n
    return found


def counted(docs: DataFrame) -> DataFrame:
    """``word`` and ``n``, its occurrences in all documents."""
    df = docs.select(F.coalesce(docs["doc_id"].cast("string"), F.lit("")).alias("doc_id"), docs["text"].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                for word, n in words_of(doc_id, text or "").items():
                    counts[word] += n
            if len(counts) > HELD:
                yield rows()
                counts.clear()
        yield rows()

    return df.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def shared_prefixes(words: list[str]) -> list[int]:
    """The length of the longest common prefix of each word with the one before it; 0 for the first."""
    out, last = [0], words[0] if words else ""
    for word in words[1:]:
        size, most = 0, min(len(last), len(word))
        while size < most and last[size] == word[size]:
            size += 1
        out.append(size)
        last = word
    return out


def scan(queries: list[str], needed: list[int], words: list[str], same: bool) -> Iterator[tuple[int, np.ndarray]]:
    """Go through the sorted ``words``; give the index of a word and those of the queries exactly one edit away.

    The first ``needed[q]`` letters of a query must stand in front of the word unchanged. ``same`` says that both lists
    are one, so that a lone query lies in a range of its own only.
    """
    width = max(map(len, queries), default=0) + 3
    lengths = np.array([len(q) for q in queries], np.int32)
    exact = np.array(needed, np.int32)
    # Letter j of a query stands in row j + 1; the rows around it hold zeros, which no letter equals.
    letters = np.zeros((width, len(queries)), np.uint32)
    for k, query in enumerate(queries):
        letters[1 : len(query) + 1, k] = np.frombuffer(query.encode("utf-32-le", "surrogatepass"), np.uint32)
    blank = np.zeros(len(queries), np.uint32)
    start = np.arange(len(queries)), np.full(len(queries), 2, np.uint8), np.zeros(len(queries), np.uint8), np.ones(len(queries), np.uint8)
    stack = [start]  # for each prefix length: queries within one edit, and their cells one before, at and one past it
    shared, at = shared_prefixes(words), 0
    while at < len(words):
        word = words[at]
        del stack[min(len(stack) - 1, shared[at]) + 1 :]
        depth, gone = len(stack) - 1, False
        while depth < len(word):
            alive, low, mid, high = stack[-1]
            letter = ord(word[depth])
            before, here, after = (letters[depth + k] if depth + k < width else blank for k in range(3))
            new_low = np.minimum(low + (before[alive] != letter), mid + 1)
            new_mid = np.minimum(np.minimum(mid + (here[alive] != letter), high + 1), new_low + 1)
            new_high = np.minimum(high + (after[alive] != letter), new_mid + 1)
            near = np.minimum(np.minimum(new_low, new_mid), new_high) <= 1
            near &= (exact[alive] <= depth) | (new_mid == 0)
            depth += 1
            alive = alive[near]
            if len(alive) <= same:
                # None is left, or only the one word that this range holds.
                at = bisect_left(words, word[:depth] + _LAST, at + 1)
                gone = True
                break
            stack.append((alive, new_low[near], new_mid[near], new_high[near]))
        if gone:
            # What was skipped shares the prefix that the rows on the stack stop short of.
            if at < len(words):
                shared[at] = min(shared[at], depth - 1)
            continue
        alive, low, mid, high = stack[-1]
        over = lengths[alive] - len(word)
        found = alive[((over == 0) & (mid == 1)) | ((over == -1) & (low == 1)) | ((over == 1) & (high == 1))]
        if len(found):
            yield at, found
        at += 1


def neighbours(side: int, queries: list[str], query_counts: list[int], words: list[str], counts: list[int]) -> dict[int, list]:
    """For each query with near words among ``words``: their number, the greatest count and the least word that has it.

    ``side`` 1 means that all words are reversed.
    """
    half = [len(q) // 2 if side == 0 else len(q) - len(q) // 2 for q in queries]
    plain = words if side == 0 else [w[::-1] for w in words]
    out: dict[int, list] = {}
    for at, found in scan(queries, half, words, queries == words):
        count, word = counts[at], plain[at]
        for q in found.tolist():
            if side == 1 and queries[q][::-1][: len(queries[q]) // 2] == word[: len(queries[q]) // 2]:
                continue  # the forward scan has this pair
            best = out.get(q)
            if best is None:
                out[q] = [1, count, word]
            else:
                best[0] += 1
                if count > best[1] or (count == best[1] and word < best[2]):
                    best[1:] = [count, word]
    return out


_TILE_SHAPE = "side int, first string, heads array<string>, words array<string>, counts array<bigint>"


def tiles(vocabulary: DataFrame) -> DataFrame:
    """Both sorted vocabularies in tiles: their side, words with counts, and the three letters their words begin with."""
    rows = vocabulary.count()
    both = vocabulary.select(F.lit(0).alias("side"), "word", "n").unionByName(vocabulary.select(F.lit(1).alias("side"), F.reverse("word").alias("word"), "n"))
    both = both.repartitionByRange(2 * rows // (4 * TILE) + 1, "side", "word").sortWithinPartitions("side", "word")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, side, chars = [], None, 0

        def tile() -> pa.RecordBatch:
            words, counts = [w for w, _ in held], [n for _, n in held]
            heads = list(dict.fromkeys(w[: LEAST_LETTERS // 2] for w in words))
            columns = [pa.array([side], pa.int32()), pa.array([words[0]]), pa.array([heads]), pa.array([words]), pa.array([counts], pa.list_(pa.int64()))]
            return pa.RecordBatch.from_arrays(columns, ["side", "first", "heads", "words", "counts"])

        for batch in batches:
            for s, word, n in zip(*(batch.column(c).to_pylist() for c in ("side", "word", "n")), strict=True):
                if held and (s != side or len(held) >= TILE or chars >= TILE_CHARS):
                    yield tile()
                    held, chars = [], 0
                side = s
                held.append((word, n))
                chars += len(word)
        if held:
            yield tile()

    return both.mapInArrow(run, _TILE_SHAPE)


def near_words(vocabulary: DataFrame) -> DataFrame:
    """``word``, the number ``near`` of its near words in some tiles, and of these the greatest ``count`` and its word ``best``.

    A word has a row for each pair of tiles that found some, so sums and the best of the rows are the whole.
    """
    cut = stored(tiles(vocabulary), "tiles")
    heads = cut.select("side", "first", F.explode("heads").alias("head"))
    pairs = heads.withColumnRenamed("first", "a").join(heads.withColumnRenamed("first", "b"), ["side", "head"])
    pairs = stored(pairs.select("side", "a", "b").distinct(), "pairs")
    own = cut.select("side", F.col("first").alias("a"), F.col("words").alias("queries"), F.col("counts").alias("query_counts"))
    other = cut.select("side", F.col("first").alias("b"), "words", "counts")
    # The rows of a task are pairs of tiles: each is a bounded piece of work, dealt out evenly.
    work = pairs.join(own, ["side", "a"]).join(other, ["side", "b"]).repartition(pairs.count() // 2 + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k].as_py() for c in ("side", "queries", "query_counts", "words", "counts")}
                found = neighbours(row["side"], row["queries"], row["query_counts"], row["words"], row["counts"])
                word = [row["queries"][q] if row["side"] == 0 else row["queries"][q][::-1] for q in found]
                columns = [pa.array(word, pa.string()), *(pa.array([v[i] for v in found.values()], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.string())))]
                yield pa.RecordBatch.from_arrays(columns, ["word", "near", "count", "best"])

    return work.select("side", "queries", "query_counts", "words", "counts").mapInArrow(run, "word string, near bigint, count bigint, best string")


def roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root`` of all rows of ``word``, ``form``: follow forms until none is left, each round twice as far.

    A form is RATIO times as frequent as its word, so chains have no rings and are as long as a logarithm of the counts.
    """
    now = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = now.select(F.col("word").alias("via"), F.col("root").alias("further"))
        step = now.join(further, now["root"] == further["via"], "left")
        step = stored(step.select("word", F.coalesce("further", "root").alias("root"), F.col("via").isNotNull().alias("moved")), "roots")
        if step.where("moved").isEmpty():
            return step.select("word", "root")
        now = step.select("word", "root")


def variants(docs: DataFrame) -> DataFrame:
    """Each word of the vocabulary with ``n``, ``n_near``, and the ``form`` and ``root`` it is a variant of."""
    vocabulary = stored(counted(docs).where(F.col("n") >= LEAST_COUNT), "vocabulary")
    own = vocabulary.select("word", "n", F.lit(0).cast("long").alias("near"), F.lit(None).cast("long").alias("count"), F.lit(None).cast("string").alias("best"))
    # The least of (minus count, word) is the greatest count and of those the first word.
    ranked = F.when(F.col("best").isNotNull(), F.struct((-F.col("count")).alias("less"), "best"))
    every = own.unionByName(near_words(vocabulary).withColumn("n", F.lit(None).cast("long"))).groupBy("word")
    every = every.agg(F.max("n").alias("n"), F.sum("near").alias("n_near"), F.min(ranked).alias("top"))
    far = -F.col("top.less") >= RATIO * F.col("n")
    every = every.select("word", "n", "n_near", F.when(far, F.col("top.best")).alias("form"), F.when(far, -F.col("top.less")).alias("form_n"))
    every = stored(every, "variants")
    led = roots(every.where("form is not null"))
    return every.join(led, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
