"""Language identification with string kernels.

Two texts are alike by the share of character n-grams of 1 to 4 that both contain (a blended spectrum, by presence, with
unit length). A Nyström map through landmark texts makes vectors of such likenesses, and kernel ridge regression fits one
score to each language against the rest. Because likeness to a landmark is a product of presence vectors, landmarks, map
and ridge weights fold into one matrix from n-gram presence to scores; texts are scored in batches, one product each.

The fit sees a bounded sample, PER_LANGUAGE documents of each label with the least hashes, of whole texts. No text leaves
the executors: the driver gets the places of the landmarks' n-grams and sums of a fixed size. N-grams go to BUCKETS places
by hash, so the model's size depends on nothing but the number of labels.

A kernel tells languages apart but always finds a best one. Whether a text is in a learned language at all is told by
the share of its n-grams that the sample of some label knows: ``fits`` is false if for every label that share, with an
allowance for short texts, is below the label's limit. Limits lie between what the label's own texts share, by half of its
sample measured against the other half, and what random n-grams would; no share of documents is rejected by design.

Defined cases: a text that is null or without a letter is ``und`` with score 0; without any labelled text every document
is ``und``; neither fits; repeated rows get equal results, and an id that occurs in several rows of the sample is one text, the
first in order; ties go to the label that sorts first; no column but text is looked at.
"""

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pedalflow.llm.common import picked, portions
from pedalflow.session import stored

LONGEST = 4
BUCKETS = 1 << 15
PER_LANGUAGE = 300
LANDMARKS = 40
RIDGE = 0.1
#: How sharply a lead in scores turns into confidence.
SHARPNESS = 6.0
UNKNOWN = "und"
#: A label's limit lies this part of the way from the median share of its texts down to what random n-grams would share.
#: Few texts know few n-grams, so their limit lies lower by FEW / their number, halfway down at most.
ROOM = 0.3
FEW = 2.0
#: Characters and documents that are scored in one product.
BATCH_CHARS = 1 << 20
BATCH_DOCS = 256

_LETTER = re.compile(r"[^\W\d_]")
_MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint32)


def presence(texts: list[str]) -> np.ndarray:
    """A row of 0 and 1 for each text: the places of the n-grams it contains."""
    out = np.zeros(len(texts) * BUCKETS, np.uint8)
    joined = np.frombuffer("\0".join([*(t.lower() for t in texts), ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = joined == 0
    # White space and controls are alike; a zero ends a text and takes part in no n-gram.
    row = np.cumsum(ends, dtype=np.int64) - ends
    code = np.where(joined < 33, np.uint32(32), joined)
    mixed, alive = np.zeros(len(joined), np.uint32), np.ones(len(joined), bool)
    for n in range(LONGEST):
        size = len(joined) - n
        if size <= 0:
            break
        mixed, alive = mixed[:size], alive[:size] & ~ends[n:]
        mixed = (mixed ^ code[n:]) * _MULTIPLIERS[n]
        mixed ^= mixed >> np.uint32(15)
        place = (mixed * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - BUCKETS.bit_length() + 1)
        out[(row[:size] * BUCKETS + place)[alive]] = 1
    return out.reshape(len(texts), BUCKETS)


class Model:
    """The labels, the matrix from presence to their scores, and for each label its known places and limit."""

    def __init__(self, labels: list[str], weights: np.ndarray, bias: np.ndarray, known: np.ndarray, limits: np.ndarray):
        self.labels, self.weights, self.bias, self.limits = labels, weights, bias, limits
        self.known = known
        self.both = np.concatenate((weights, known.astype(np.float32)), axis=1)

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float], list[bool]]:
        names, scores, fits = [UNKNOWN] * len(texts), [0.0] * len(texts), [False] * len(texts)
        count = len(self.labels)
        known = [i for i, t in enumerate(texts) if t and self.labels and _LETTER.search(t)]
        at = 0
        while at < len(known):
            end, chars = at, 0
            while end < len(known) and end - at < BATCH_DOCS and (end == at or chars + len(texts[known[end]]) <= BATCH_CHARS):
                chars += len(texts[known[end]])
                end += 1
            rows = known[at:end]
            seen = presence([texts[i] for i in rows])
            size = np.sqrt(np.maximum(1, seen.sum(axis=1, keepdims=True, dtype=np.float32)))
            product = (seen / size) @ self.both
            found, share = product[:, :count] + self.bias, product[:, count:] / size
            sure = np.exp(SHARPNESS * (found - found.max(axis=1, keepdims=True)))
            sure /= sure.sum(axis=1, keepdims=True)
            fit = (share + 1.0 / size >= self.limits).any(axis=1)
            for i, best, value, ok in zip(rows, found.argmax(axis=1).tolist(), sure.max(axis=1).tolist(), fit.tolist(), strict=True):
                names[i], scores[i], fits[i] = self.labels[best], min(1.0, value), ok
            at = end
        return names, scores, fits


def _no_model() -> Model:
    return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0, np.float32), np.zeros((BUCKETS, 0), bool), np.zeros(0))


def _dense(places) -> np.ndarray:
    """Unit presence rows from lists of places."""
    out = np.zeros((len(places), BUCKETS), np.float32)
    for row, own in zip(out, places, strict=True):
        row[own] = 1.0 / np.sqrt(max(1, len(own)))
    return out


def _sample(docs: DataFrame, allowed: Column) -> DataFrame:
    """lang, the row's number ``nth`` within it, and the ``places`` of its n-grams: PER_LANGUAGE rows of a label at most."""
    df = docs.where(allowed & F.col("text").isNotNull() & F.col("lang").isNotNull()).select("doc_id", "lang", "text")
    key = df.select("doc_id", "lang", F.xxhash64("doc_id").alias("h"))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id"))
    chosen = key.distinct().withColumn("nth", nth).where(F.col("nth") <= PER_LANGUAGE)
    chosen = stored(chosen.select(F.col("doc_id").alias("d"), F.col("lang").alias("l"), "nth"), "chosen")
    # PER_LANGUAGE rows of a label: bounded, and no text moves but those chosen.
    alike = df["doc_id"].eqNullSafe(chosen["d"]) & (df["lang"] == chosen["l"])
    texts = df.join(F.broadcast(chosen), alike).groupBy("lang", "nth").agg(F.min("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                text = batch.column("text")[k].as_py()
                if _LETTER.search(text):
                    places = pa.array([np.nonzero(presence([text])[0])[0].astype(np.int32)], pa.list_(pa.int32()))
                    yield pa.RecordBatch.from_arrays([batch.column("lang").slice(k, 1), batch.column("nth").slice(k, 1), places], ["lang", "nth", "places"])

    return stored(texts.select("lang", "nth", "text").mapInArrow(run, "lang string, nth int, places array<int>"), "sample")


def _places(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [p.values.to_numpy(zero_copy_only=False) for p in batch.column("places")]


def _known(sample: DataFrame, names: list[str], half: int | None) -> np.ndarray:
    """Places by labels: whether a text of the label has the place, of one half of its rows or of all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((len(names), BUCKETS), bool)
        for batch in batches:
            for lang, nth, places in zip(batch.column("lang").to_pylist(), batch.column("nth").to_pylist(), _places(batch), strict=True):
                if half is None or nth % 2 == half:
                    seen[names.index(lang), places] = True
        yield pa.RecordBatch.from_arrays([pa.array([np.packbits(seen).tobytes()], pa.binary())], ["bits"])

    out = np.zeros((len(names), BUCKETS), bool)
    for row in sample.mapInArrow(run, "bits binary").collect():  # of a fixed size for each task
        out |= np.unpackbits(np.frombuffer(row["bits"], np.uint8)).astype(bool).reshape(out.shape)
    return out.T


def _limits(sample: DataFrame, names: list[str]) -> np.ndarray:
    """For each label the share of known n-grams that its texts are not to fall below; 0 if there is no telling."""
    half = _known(sample, names, 0)
    chance, known = half.mean(axis=0), np.packbits(half)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.unpackbits(known).astype(bool).reshape(BUCKETS, len(names))
        for batch in batches:
            langs, shares = [], []
            for lang, nth, places in zip(batch.column("lang").to_pylist(), batch.column("nth").to_pylist(), _places(batch), strict=True):
                if nth % 2 == 1 and len(places):
                    langs.append(lang)
                    shares.append(float(own[places, names.index(lang)].mean()))
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(shares, pa.float64())], ["lang", "share"])

    by_label: dict[str, list[float]] = {}
    for row in sample.mapInArrow(run, "lang string, share double").collect():  # a number for each row of the sample
        by_label.setdefault(row["lang"], []).append(row["share"])
    out = np.zeros(len(names))
    for k, name in enumerate(names):
        if by_label.get(name):
            middle = float(np.median(by_label[name]))
            out[k] = middle - min(0.5, ROOM + FEW / len(by_label[name])) * max(0.0, middle - chance[k])
    return out


def fit(docs: DataFrame, allowed: Column) -> Model:
    """Train on the rows where ``allowed``; needs doc_id, text and lang."""
    sample = _sample(docs, allowed)
    marks = sample.where(F.col("nth") <= LANDMARKS).orderBy("lang", "nth").collect()  # LANDMARKS rows of places a label
    names = sorted({r["lang"] for r in sample.select("lang").distinct().collect()})
    if not marks:
        return _no_model()
    places = [np.array(r["places"], np.int32) for r in marks]
    landmark = _dense(places)
    values, vectors = np.linalg.eigh((landmark @ landmark.T).astype(np.float64))
    kept = values > 1e-6 * values.max()
    to_vector = vectors[:, kept] / np.sqrt(values[kept])
    size = to_vector.shape[1]
    counts = {r["lang"]: r["count"] for r in sample.groupBy("lang").count().collect()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Weighted sums over the rows of a task: of x, y, x x' and x y'. Labels count alike however many texts each has."""
        marked = _dense(places)
        sums = np.zeros(size + len(names) + size * size + size * len(names))
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for at in range(0, len(langs), 64):
                own = langs[at : at + 64]
                x = (_dense(_places(batch.slice(at, 64))) @ marked.T).astype(np.float64) @ to_vector
                y = np.where(np.array(own)[:, None] == np.array(names)[None, :], 1.0, -1.0)
                w = 1.0 / np.array([counts[n] for n in own])
                sums += np.concatenate([w @ x, w @ y, ((x * w[:, None]).T @ x).ravel(), ((x * w[:, None]).T @ y).ravel()])
        yield pa.RecordBatch.from_arrays([pa.array([sums.tobytes()], pa.binary())], ["sums"])

    parts = [np.frombuffer(r["sums"]) for r in sample.mapInArrow(run, "sums binary").collect()]  # of a fixed size a task
    x, y, xx, xy = np.split(np.sum(parts, axis=0) / len(names), np.cumsum([size, len(names), size * size]))
    xx = xx.reshape(size, size) - np.outer(x, x)
    xy = xy.reshape(size, len(names)) - np.outer(x, y)
    ridge = RIDGE * 0.01 / max(1, size)
    solved = np.linalg.solve(xx + ridge * np.eye(size), xy)
    weights = (landmark.T @ (to_vector @ solved)).astype(np.float32)
    return Model(names, weights, (y - x @ solved).astype(np.float32), _known(sample, names, None), _limits(sample, names))


def predicted(docs: DataFrame, model: Model, *more: str) -> DataFrame:
    """doc_id, further columns ``more`` of the input, ``lang_pred``, ``score`` and ``fits``."""
    rest = [c for c in more if c != "text"]
    df = picked(docs, "doc_id", *rest, text="text")
    kept = ["doc_id", *more]
    shape = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in kept)
    shared = df.sparkSession.sparkContext.broadcast((model.labels, model.weights, model.bias, model.known, model.limits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for batch in portions(batches):
            names, scores, fits = own.predict(batch.column("text").to_pylist())
            columns = [*(batch.column(c) for c in kept), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(fits, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "lang_pred", "score", "fits"])

    return df.mapInArrow(run, f"{shape}, lang_pred string, score double, fits boolean")
