"""Near duplicates by SimHash: 64-bit fingerprints, exact links by tiles, and connected components.

Equal fingerprints become one node before anything is compared, so a group of exact copies costs nothing however large.
The different fingerprints are cut into tiles of one bit count each. Two tiles are compared only if their bit counts
differ by no more than the radius, and within them only blocks whose bit counts, byte by byte, leave that possible. A
comparison is numpy's exclusive-or and bit count over whole blocks and misses no link. What leaves a pair of tiles is a
spanning forest of its links, not the links: at most a row for each fingerprint, even if all are near each other.

The work of comparing grows with the square of the number of different fingerprints, at about a nanosecond a pair; that
is in the nature of an exact comparison. Tiles go through the shared folder and are joined in pairs, never to the driver.

Defined cases: null and empty texts have fingerprint zero and are linked like any other; repeated rows share a
component; a row without doc_id gets the component of its fingerprint and never names one; an empty table is empty.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pedalflow.llm.common import picked, portions
from pedalflow.llm.shingles import shingle_digests, word_bytes
from pedalflow.session import stored

WIDTH = 4
RADIUS = 4
#: Fingerprints in a tile, and in a block within it.
TILE = 65_536
BLOCK = 512


def fingerprint(text: str | None, width: int = WIDTH) -> int:
    """The fingerprint as a signed 64-bit integer. A bit is set if it is set in over half of the shingle hashes."""
    digests = shingle_digests(word_bytes(text), width)
    votes = np.zeros(64, np.int64)
    for at in range(0, len(digests), 65_536):
        votes += np.unpackbits(digests[at : at + 65_536], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > len(digests)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id, further columns ``more`` of the input, and ``fp``, the fingerprint as a long."""
    df = picked(docs, "doc_id", *[c for c in more if c != "text"], text="text")
    kept = ["doc_id", *more]
    shape = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            found = [fingerprint(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(found, pa.int64())], [*kept, "fp"])

    return df.mapInArrow(run, f"{shape}, fp bigint")


def _byte_counts(fps: np.ndarray) -> np.ndarray:
    return np.bitwise_count(fps.view(np.uint8).reshape(-1, 8)).astype(np.int16)


def _blocks(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sort by bit counts byte by byte; return the order and the least and greatest counts of each block."""
    counts = _byte_counts(fps)
    order = np.lexsort(counts.T[::-1])
    counts = counts[order]
    starts = np.arange(0, len(fps), BLOCK)
    return order, np.minimum.reduceat(counts, starts), np.maximum.reduceat(counts, starts)


def forest(left: np.ndarray, right: np.ndarray | None, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what links of at most ``radius`` bits connect, within one tile or between two."""
    order, low, high = _blocks(left)
    left = left[order]
    if right is None:
        nodes, other, low2, high2, shift = left, left, low, high, 0
    else:
        order, low2, high2 = _blocks(right)
        other, shift = right[order], len(left)
        nodes = np.concatenate((left, other))
    root = np.arange(len(nodes))
    for i in range(len(low)):
        apart = np.maximum(0, np.maximum(low2 - high[i], low[i] - high2)).sum(axis=1)
        for j in np.nonzero(apart <= radius)[0]:
            if right is None and j < i:
                continue
            a, b = left[i * BLOCK : (i + 1) * BLOCK], other[j * BLOCK : (j + 1) * BLOCK]
            near = np.bitwise_count(a[:, None] ^ b[None, :]) <= radius
            x, y = np.nonzero(near)
            x, y = root[x + i * BLOCK], root[y + j * BLOCK + shift]
            fresh = x != y
            if fresh.any():
                for p, q in np.unique(np.stack((x[fresh], y[fresh]), axis=1), axis=0).tolist():
                    while root[p] != p:
                        p = root[p]
                    while root[q] != q:
                        q = root[q]
                    root[max(p, q)] = min(p, q)
                while (root[root] != root).any():
                    root = root[root]
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]


def links(distinct: DataFrame) -> DataFrame:
    """Edges ``u``, ``v`` that connect the different fingerprints in column ``fp`` as all links would."""
    bits = distinct.select("fp", F.bit_count("fp").alias("bits"))
    sizes = {r["bits"]: r["count"] for r in bits.groupBy("bits").count().collect()}  # 65 rows at most
    cuts = F.create_map(*[F.lit(x) for b, n in (sizes or {0: 0}).items() for x in (b, n // TILE + 1)])
    tiles = bits.withColumn("cut", F.pmod(F.xxhash64("fp"), F.element_at(cuts, F.col("bits"))))
    tiles = stored(tiles.groupBy("bits", "cut").agg(F.collect_list("fp").alias("fps")), "tiles")
    name = F.struct("bits", "cut")
    names = tiles.select(name.alias("a"), F.explode(F.sequence("bits", F.least(F.col("bits") + RADIUS, F.lit(64)))).alias("meets"))
    pairs = names.join(tiles.select(name.alias("b"), "bits"), F.col("meets") == F.col("bits")).where("a <= b").select("a", "b")
    left, right = tiles.select(name.alias("a"), F.col("fps").alias("left")), tiles.select(name.alias("b"), F.col("fps").alias("right"))
    # The rows of a task are pairs of tiles, dealt out evenly: each is a bounded piece of work.
    work = pairs.join(left, "a").join(right, "b").select((F.col("a") == F.col("b")).alias("same"), "left", "right")
    work = work.repartition(max(1, sum(sizes.values()) // TILE + int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                one, two = (batch.column(c)[k].values.to_numpy(zero_copy_only=False).view(np.uint64) for c in ("left", "right"))
                u, v = forest(one, None if batch.column("same")[k].as_py() else two)
                yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])

    return work.mapInArrow(run, "u bigint, v bigint")


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node it is connected to, for all nodes of edges ``u``, ``v``.

    Large-star and small-star in turn, until nothing changes: every node then points at its root. Only distributed
    joins and minima, each round written to the shared folder.
    """
    now = stored(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "edges")
    seen = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stored(large.where("u <> v"), "edges")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        now = stored(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = state


def _placed(found: DataFrame) -> DataFrame:
    """``fp``, its ``root`` and the least doc_id that has it (``first``), of the different fingerprints in ``found``."""
    distinct = stored(found.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    parts = components(links(distinct.select("fp")))
    placed = distinct.join(parts, distinct["fp"] == parts["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    return stored(placed, "placed")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, ``fingerprint`` (16 hex digits) and ``component_id``, the least doc_id that links lead to."""
    found = stored(fingerprints(docs), "fingerprints")
    placed = _placed(found)
    firsts = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    named = stored(placed.join(firsts, "root").select("fp", "component_id"), "named")
    return found.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def deduplicated(docs: DataFrame, *more: str) -> DataFrame:
    """The row with the least doc_id of each component, with doc_id and the columns ``more``; rows without an id come last.

    Rows are told apart by a number they get when they are written down with their fingerprints, so of repeated rows one
    stays, and rows that share an id but are no near copies all stay. Only numbers are shuffled: those of the rows that
    go are taken out of the written table.
    """
    marked = stored(fingerprints(docs, *more).withColumn("row", F.monotonically_increasing_id()), "fingerprints")
    found = marked.select("row", "doc_id", "fp")
    best = found.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")).alias("best"))
    winners = best.join(_placed(found).select("fp", "root"), "fp").groupBy("root").agg(F.min("best").alias("best"))
    going = stored(found.select("row").join(winners.select(F.col("best.row").alias("row")), "row", "left_anti"), "going")
    return marked.join(going, "row", "left_anti").select("doc_id", *more)
