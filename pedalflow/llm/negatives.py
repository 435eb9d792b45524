"""Hard negatives: for an anchor and each of its nearest rows of the same label, rows of other labels not quite as near.

Two passes of the anchors against all rows, both in blocks: rows are packed into tiles and anchors into smaller ones, and
a task multiplies one tile by the other. The first pass finds each anchor's positives. Every positive asks for the best
negatives within a window of scores, and windows of one anchor overlap. So the second pass does not answer windows: the
upper limits of an anchor's windows split its scores into disjoint slots, and per slot only the TAKEN best negatives are
kept, in the tile, in the task's partial ranking and in the final one. A window is then answered from the slots at and
below its own upper limit, merged in falling order, and cut at its lower limit: whatever the k best of a slot leave out
is beaten by k rows that are in every window which holds the slot.

Scores are inner products of whole numbers, exact: products run in doubles where every sum stays below 2**53, else in
integers of any size. A score beyond a long is given as the nearest long.

Defined cases: rows without vec_id, label or vector, and vectors with a null or non-finite component, take no part; of
vectors of unequal length the shorter one counts as filled up with zeros, an empty one gives scores of 0; rows with the
vec_id of the anchor are the anchor itself; a repeated row counts as often as it occurs, also as an anchor; a positive
of negative score has no negatives; an empty table gives an empty result; other columns are not read.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pedalflow.session import stored

SCALE = 256
POSITIVES = 5
TAKEN = 3
#: A negative's score lies between these shares of the positive's, in percent.
LOWEST, HIGHEST = 50, 95
#: Rows of a tile, anchors of a tile, and anchors multiplied at a time.
TILE = 8_192
ANCHORS = 1_024
STEP = 256
#: Tiles of rows that share the copies of the anchors made for them, on average.
STRIPE = 4
_LONG = (-(2**63), 2**63 - 1)

_TILE_SHAPE = "tile bigint, ids array<bigint>, labels array<bigint>, width int, vectors binary"


def packed(rows: DataFrame, size: int) -> DataFrame:
    """Tiles of at most ``size`` rows of vec_id, label and embedding; vectors as whole doubles, row by row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A task numbers its own tiles, the same way when it is run again.
        number = TaskContext.get().partitionId() << 32
        held: list[tuple[int, int, np.ndarray]] = []

        def tile() -> pa.RecordBatch:
            width = max(len(v) for _, _, v in held)
            vectors = np.zeros((len(held), width))
            for k, (_, _, vector) in enumerate(held):
                vectors[k, : len(vector)] = vector
            columns = [[number], [[i for i, _, _ in held]], [[label for _, label, _ in held]], [width], [vectors.tobytes()]]
            types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int32(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["tile", "ids", "labels", "width", "vectors"])

        for batch in batches:
            for i, label, components in zip(batch.column("id").to_pylist(), batch.column("label").to_pylist(), batch.column("v"), strict=True):
                vector = components.values
                if vector.null_count:
                    continue
                vector = np.floor(vector.to_numpy(zero_copy_only=False).astype(np.float64) * SCALE)
                if not np.isfinite(vector).all():
                    continue
                held.append((i, label, vector))
                if len(held) == size:
                    yield tile()
                    number, held = number + 1, []
        if held:
            yield tile()

    df = rows.select(rows["vec_id"].cast("long").alias("id"), rows["label"].cast("long").alias("label"), rows["embedding"].cast("array<double>").alias("v"))
    return df.where("id is not null and label is not null and v is not null").mapInArrow(run, _TILE_SHAPE)


class Tile:
    """A tile as arrays."""

    def __init__(self, ids, labels, width: int, vectors: bytes):
        self.ids = np.array(ids, np.int64)
        self.labels = np.array(labels, np.int64)
        self.vectors = np.frombuffer(vectors).reshape(len(self.ids), width)

    def scores(self, other: "Tile", rows: slice) -> np.ndarray:
        """Scores of some rows with all rows of ``other``."""
        width = min(self.vectors.shape[1], other.vectors.shape[1])
        a, b = self.vectors[rows, :width], other.vectors[:, :width]
        if width * np.abs(a).max(initial=0) * np.abs(b).max(initial=0) < 2**53:
            return (a @ b.T).astype(np.int64)
        whole = np.vectorize(int, otypes=[object])
        return np.clip(whole(a) @ whole(b).T, *_LONG).astype(np.int64)


def best(scores: np.ndarray, ids: np.ndarray, count: int) -> np.ndarray:
    """Places of the ``count`` best, by falling score and then by id."""
    places = np.arange(len(scores))
    if len(scores) > count:
        places = np.nonzero(scores >= np.partition(scores, len(scores) - count)[-count])[0]
    return places[np.lexsort((ids[places], ~scores[places]))][:count]


def positives_in(anchors: Tile, rows: Tile) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Each anchor's place with the scores and ids of the best other rows of its label in a tile."""
    for label in np.unique(anchors.labels).tolist():
        own, like = np.nonzero(anchors.labels == label)[0], np.nonzero(rows.labels == label)[0]
        if not len(like):
            continue
        part = Tile(rows.ids[like], rows.labels[like], rows.vectors.shape[1], rows.vectors[like].tobytes())
        for at in range(0, len(own), STEP):
            chosen = own[at : at + STEP]
            for k, line in zip(chosen.tolist(), anchors.scores(part, chosen), strict=True):
                others = np.nonzero(part.ids != anchors.ids[k])[0]
                top = others[best(line[others], part.ids[others], POSITIVES)]
                yield k, line[top], part.ids[top]


def negatives_in(anchors: Tile, limits: dict[int, tuple[list[int], int]], rows: Tile) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Each anchor's place and slot with the scores and ids of the best rows of other labels in a tile.

    ``limits`` gives the falling upper limits of an anchor and the least of its lower ones. Slot s holds scores of at
    most limit s and above limit s + 1.
    """
    for at in range(0, len(anchors.ids), STEP):
        for k, line in enumerate(anchors.scores(rows, slice(at, at + STEP)), at):
            if k not in limits:
                continue
            upper, least = limits[k]
            fit = np.nonzero((line <= upper[0]) & (line >= least) & (rows.labels != anchors.labels[k]) & (rows.ids != anchors.ids[k]))[0]
            slots = (line[fit][:, None] <= np.array(upper, np.int64)[None, :]).sum(axis=1) - 1
            for slot in np.unique(slots).tolist():
                own = fit[slots == slot]
                top = own[best(line[own], rows.ids[own], TAKEN)]
                yield k, slot, line[top], rows.ids[top]


def _met(anchors: DataFrame, rows: DataFrame, stripes: int) -> DataFrame:
    """Pairs of a tile of anchors and a tile of rows, dealt out evenly: each is a bounded piece of work."""
    copies = anchors.select(*[F.col(c).alias(f"a_{c}") for c in anchors.columns], F.explode(F.sequence(F.lit(0), F.lit(stripes - 1))).alias("stripe"))
    dealt = rows.withColumn("stripe", F.pmod(F.xxhash64("tile"), F.lit(stripes)).cast("int"))
    return dealt.join(copies.hint("merge"), "stripe").drop("stripe").repartition(2 * stripes)


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, Tile, Tile]]:
    for batch in batches:
        for k in range(batch.num_rows):
            row = {c: batch.column(c)[k].as_py() for c in batch.schema.names}
            yield row, Tile(*(row[f"a_{c}"] for c in ("ids", "labels", "width", "vectors"))), Tile(*(row[c] for c in ("ids", "labels", "width", "vectors")))


def _batch(columns: dict[str, list], types: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[c], t) for c, t in types.items()], list(types))


def _ranked(found: DataFrame, keys: list[str], count: int) -> DataFrame:
    """The ``count`` best rows of each key; Spark ranks within each task before it moves rows."""
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), "id"))
    return found.withColumn("nth", nth).where(F.col("nth") <= count).drop("nth")


def mined(rows: DataFrame, is_anchor: Column) -> DataFrame:
    """anchor_id, positive_id, positive_score, rank, negative_id and negative_score, from vec_id, label and embedding.

    Rows for which ``is_anchor`` holds are the anchors; anchors without positives or negatives have no row.
    """
    tiles = stored(packed(rows, TILE), "tiles")
    own = rows.where(is_anchor).select("vec_id", "label", "embedding")
    anchors = stored(packed(own.repartition(own.count() // ANCHORS + 1), ANCHORS), "anchors")
    stripes = tiles.count() // STRIPE + 1
    one = {"tile": pa.int64(), "place": pa.int32(), "anchor_id": pa.int64(), "score": pa.int64(), "id": pa.int64()}

    def find_positives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, anchor, other in _each(batches):
            out: dict[str, list] = {c: [] for c in one}
            for k, scores, ids in positives_in(anchor, other):
                for c, v in zip(one, (row["a_tile"], k, int(anchor.ids[k])), strict=False):
                    out[c] += [v] * len(ids)
                out["score"] += scores.tolist()
                out["id"] += ids.tolist()
            yield _batch(out, one)

    keys = ["tile", "place", "anchor_id"]
    positives = _met(anchors, tiles, stripes).mapInArrow(find_positives, "tile bigint, place int, anchor_id bigint, score bigint, id bigint")
    positives = _ranked(positives, keys, POSITIVES)
    # Parts of a hundred without overflow; a window of negative scores would be empty.
    upper = F.expr(f"score div 100 * {HIGHEST} + score % 100 * {HIGHEST} div 100")
    lower = F.expr(f"score div 100 * {LOWEST} + (score % 100 * {LOWEST} + 99) div 100")
    windows = stored(positives.where("score >= 0").withColumn("upper", upper).withColumn("lower", lower), "windows")
    slots = windows.groupBy(*keys).agg(F.sort_array(F.collect_set("upper"), asc=False).alias("upper"), F.min("lower").alias("least"))
    limits = slots.groupBy("tile").agg(F.collect_list(F.struct("place", "upper", "least")).alias("limits"))
    slot = {"tile": pa.int64(), "place": pa.int32(), "anchor_id": pa.int64(), "slot": pa.int32(), "score": pa.int64(), "id": pa.int64()}

    def find_negatives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, anchor, other in _each(batches):
            asked = {x["place"]: (x["upper"], x["least"]) for x in row["a_limits"]}
            out: dict[str, list] = {c: [] for c in slot}
            for k, number, scores, ids in negatives_in(anchor, asked, other):
                for c, v in zip(slot, (row["a_tile"], k, int(anchor.ids[k]), number), strict=False):
                    out[c] += [v] * len(ids)
                out["score"] += scores.tolist()
                out["id"] += ids.tolist()
            yield _batch(out, slot)

    asking = stored(anchors.join(limits, "tile"), "asking")
    kept = _met(asking, tiles, stripes).mapInArrow(find_negatives, "tile bigint, place int, anchor_id bigint, slot int, score bigint, id bigint")
    kept = _ranked(kept, [*keys, "slot"], TAKEN)
    # All slots of an anchor, best first: a few rows for each of its few limits.
    entry = F.struct((-F.col("score")).alias("less"), "id", "slot")
    merged = kept.groupBy(*keys).agg(F.sort_array(F.collect_list(entry)).alias("merged"))
    asked = windows.join(slots.select(*keys, F.col("upper").alias("limits")), keys).join(merged, keys)
    suffix = F.slice(F.filter("merged", lambda e: e["slot"] + 1 >= F.array_position("limits", F.col("upper"))), 1, TAKEN)
    asked = asked.withColumn("found", F.filter(suffix, lambda e: -e["less"] >= F.col("lower")))
    answers = asked.select("anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"), F.posexplode("found").alias("at", "one"))
    return answers.select(
        "anchor_id",
        "positive_id",
        (F.col("at") + 1).alias("rank"),
        F.col("one.id").alias("negative_id"),
        "positive_score",
        (-F.col("one.less")).alias("negative_score"),
    )
