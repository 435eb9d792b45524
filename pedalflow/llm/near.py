"""Near copies by shingles: documents linked at a Jaccard similarity of LEAST or more, and connected components.

Texts of equal words are one node. Nodes that share a band of least hashes are candidates; a pair at similarity 0.8 shares
none of the BANDS with a chance of 3 in 100,000, a likelier one with less. Candidates are only brought together by that:
within each group of candidates all pairs are compared by their whole sets of shingle hashes, and only pairs that pass
become links. A large group is cut into tiles, which are compared in pairs; what leaves a pair of tiles is a spanning
forest of its links. Texts and shingles count by 64-bit hashes.

Defined cases: null, empty and blank texts are one node; repeated rows share a node; a row without doc_id gets the
component of its text and never names one; an empty table is empty.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pedalflow.llm.common import picked, portions
from pedalflow.llm.shingles import SEED, word_bytes
from pedalflow.llm.simhash import components
from pedalflow.session import stored

WIDTH = 5
LEAST = 0.8
BANDS = 20
ROWS = 4
#: Nodes in a tile, on average.
TILE = 1000
#: Nodes a task remembers, to send the text of a node once.
SEEN = 1_000_000
_FACTORS = np.random.default_rng(SEED).integers(1, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def node(words: list[bytes]) -> int:
    return int.from_bytes(xxhash.xxh64_digest(b" ".join(words), SEED), "big", signed=True)


def shingle_set(words: list[bytes]) -> np.ndarray:
    """The different shingle hashes, ascending. Each is made of the hashes of its words, so a word is read only once.

    A text of fewer words than a shingle has one shingle, the whole of it; one without words has none.
    """
    if len(words) < WIDTH:
        return np.array([node(words)] if words else [], np.int64).view(np.uint64)
    digest = xxhash.xxh64_digest
    single = np.frombuffer(b"".join([digest(w, SEED) for w in words]), np.uint64)
    count = len(words) - WIDTH + 1
    mixed = np.zeros(count, np.uint64)
    for k in range(WIDTH):
        mixed += single[k : k + count] * _FACTORS[k]
    mixed = (mixed ^ (mixed >> np.uint64(32))) * _FACTORS[WIDTH]
    return np.unique(mixed ^ (mixed >> np.uint64(29)))


def bands(hashes: np.ndarray) -> list[int]:
    """A hash of each band of least hashes; none for an empty set."""
    if not len(hashes):
        return []
    least = np.full(BANDS * ROWS, 2**64 - 1, np.uint64)
    for at in range(0, len(hashes), 4096):
        part = hashes[at : at + 4096]
        part = part ^ (part >> np.uint64(31))
        least = np.minimum(least, (part[None, :] * _FACTORS[:, None]).min(axis=1))
    rows = least.reshape(BANDS, ROWS)
    return [int.from_bytes(xxhash.xxh64_digest(rows[k].tobytes(), SEED + k), "big", signed=True) for k in range(BANDS)]


def linked(nodes: np.ndarray, sets: list[np.ndarray], least: float = LEAST) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what all pairs of sets at ``least`` or more connect."""
    sizes = np.array([len(s) for s in sets], np.int64)
    hashes = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    owners = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(hashes, kind="stable")
    hashes, owners = hashes[order], owners[order]
    root = np.arange(len(sets))
    for i, own in enumerate(sets):
        low, high = np.searchsorted(hashes, own, "left"), np.searchsorted(hashes, own, "right")
        shared = high > low + 1
        if not shared.any():
            continue
        low, counts = low[shared], (high - low)[shared]
        places = np.repeat(low - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        # Hashes that no other set holds meet only their own set, which is left out.
        both = np.bincount(owners[places], minlength=len(sets))
        near = np.nonzero((both > 0) & (both >= least * (sizes[i] + sizes - both)))[0]
        roots = np.unique(root[np.append(near, i)])
        if len(roots) > 1:
            root[np.isin(root, roots)] = roots[0]
    moved = root != np.arange(len(sets))
    return nodes[moved], nodes[root[moved]]


def _marked(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id, further columns ``more`` of the input, the number of words ``n``, ``node`` and ``bands``."""
    df = picked(docs, "doc_id", *more, text="text")
    shape = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in ("doc_id", *more))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            split = [word_bytes(t.as_py()) for t in batch.column("text")]
            found = [pa.array(map(len, split), pa.int64()), pa.array(map(node, split), pa.int64())]
            found.append(pa.array([bands(shingle_set(w)) for w in split], pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", *more)), *found], ["doc_id", *more, "n", "node", "bands"])

    return df.mapInArrow(run, f"{shape}, n bigint, node bigint, bands array<bigint>")


def _texts(docs: DataFrame) -> DataFrame:
    """``node`` and ``text``, mostly once a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in portions(batches):
            nodes, fresh = [node(word_bytes(t.as_py())) for t in batch.column("text")], []
            for n in nodes:
                fresh.append(n not in seen)
                seen.add(n)
            if len(seen) > SEEN:
                seen.clear()
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), batch.column("text")], ["node", "text"]).filter(pa.array(fresh, pa.bool_()))

    return picked(docs, text="text").mapInArrow(run, "node bigint, text string")


def links(docs: DataFrame, marked: DataFrame) -> DataFrame:
    """Edges ``u``, ``v`` between nodes that connect what all pairs at LEAST or more connect."""
    buckets = marked.select("node", F.explode("bands").alias("band")).distinct()
    buckets = stored(buckets, "buckets")
    leads = buckets.groupBy("band").agg(F.min("node").alias("lead"), F.count("*").alias("n")).where("n > 1").select("band", "lead")
    groups = components(buckets.join(leads, "band").where("node <> lead").select(F.col("node").alias("u"), F.col("lead").alias("v")))
    groups = stored(groups.select("node", "root").unionByName(groups.select(F.col("root").alias("node"), "root").distinct()), "groups")
    sizes = groups.groupBy("root").agg((F.floor(F.count("*") / TILE) + 1).cast("long").alias("cuts"))
    groups = stored(groups.join(sizes, "root"), "groups")
    # Texts move once, by node, at every size: which of them are candidates is a list that grows with the table.
    texts = _texts(docs).join(groups.hint("merge"), "node")
    # Each tile meets every tile of its group, itself too; the lesser number comes first.
    tile = F.pmod(F.xxhash64("node"), F.col("cuts"))
    met = texts.withColumn("tile", tile).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("cuts") - 1)))
    met = met.select("root", F.least("tile", "other").alias("a"), F.greatest("tile", "other").alias("b"), "node", "text")

    def run(group: pa.Table) -> pa.Table:
        held = dict(zip(group.column("node").to_pylist(), group.column("text").to_pylist(), strict=True))
        nodes = np.array(sorted(held), np.int64)
        u, v = linked(nodes, [shingle_set(word_bytes(held[n])) for n in nodes.tolist()])
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return met.groupBy("root", "a", "b").applyInArrow(run, "u bigint, v bigint")


def near_copies(docs: DataFrame, *more: str) -> tuple[DataFrame, DataFrame]:
    """doc_id, ``more``, ``n`` (words) and node of each row; and node and root of the nodes that links connect to another one."""
    marked = stored(_marked(docs, *more), "marked")
    return marked.drop("bands"), components(links(docs, marked))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id and ``component_id``, the least doc_id that links lead to."""
    found, parts = near_copies(docs)
    distinct = found.groupBy("node").agg(F.min("doc_id").alias("first"))
    placed = stored(distinct.join(parts, "node", "left").select("node", "first", F.coalesce("root", "node").alias("root")), "placed")
    firsts = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    named = stored(placed.join(firsts, "root").select("node", "component_id"), "named")
    return found.join(named, "node").select("doc_id", "component_id")
