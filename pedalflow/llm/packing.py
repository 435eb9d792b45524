"""Best-fit packing of documents into training sequences, with conflicts.

Lengths are words. A document longer than a sequence is cut; full pieces are sequences of their own. What remains is dealt
by hash to shards of bounded size, and within a shard placed longest first: bins stand in order of the room they
have left, and the search goes from the tightest that fits to the next until one is found that is compatible. A bin
carries two bitmaps: of the sources it holds, PER_SOURCE bits for each, and of its clusters of near duplicates. Two documents
of one cluster never share a bin, nor more than PER_SOURCE of one source. No document is dropped; if no bin will do, a
new one is opened.

Defined cases: a null or empty text has length 0 and takes no bin (null); a null source or cluster never conflicts;
repeated rows are of one cluster and lie in different bins; an empty table is empty.
"""

from bisect import bisect_left, insort

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pedalflow.llm import near
from pedalflow.llm.common import picked
from pedalflow.session import stored

CAPACITY = 2048
PER_SOURCE = 2
#: Documents in a shard, on average.
SHARD = 4000


def best_fit(items: list[tuple], capacity: int = CAPACITY, per_source: int = PER_SOURCE) -> list[tuple[int, int]]:
    """Bin and offset of each item (length, source, cluster), in the given order; items should come longest first."""
    rooms: list[tuple[int, int]] = []  # (room left, bin), ascending
    sources_in: list[int] = []
    clusters_in: list[int] = []
    source_bits: dict = {}
    cluster_bits: dict = {}
    out = []
    for length, source, cluster in items:
        bits = 0
        if source is not None:
            bits = ((1 << per_source) - 1) << (per_source * source_bits.setdefault(source, len(source_bits)))
        own = 0 if cluster is None else 1 << cluster_bits.setdefault(cluster, len(cluster_bits))
        at = bisect_left(rooms, (length, -1))
        while at < len(rooms):
            home = rooms[at][1]
            if not clusters_in[home] & own and (not bits or sources_in[home] & bits != bits):
                break
            at += 1
        if at < len(rooms):
            room, home = rooms.pop(at)
        else:
            room, home = capacity, len(sources_in)
            sources_in.append(0)
            clusters_in.append(0)
        # The lowest bit of the source that is still free.
        free = bits & ~sources_in[home]
        sources_in[home] |= free & -free
        clusters_in[home] |= own
        out.append((home, capacity - room))
        if room > length:
            insort(rooms, (room - length, home))
    return out


def with_clusters(docs: DataFrame) -> DataFrame:
    """doc_id, source, the number of words ``n`` and ``cluster``: what near copies have in common, without regard to case
    and white space.

    A text without near copies has the hash of its words, one without words has none. Texts are read once for this.
    """
    df = picked(docs, doc_id="doc_id", text="text", source="source").withColumn("text", F.lower("text"))
    found, parts = near.near_copies(df, "source")
    df = found.join(parts, "node", "left")
    return stored(df.select("doc_id", "source", "n", F.when(F.col("n") > 0, F.coalesce("root", "node")).alias("cluster")), "clusters")


def packed(docs: DataFrame, capacity: int = CAPACITY, per_source: int = PER_SOURCE) -> DataFrame:
    """A row for each piece: doc_id, piece, start and length in words, bin, and its offset in the bin.

    Needs doc_id, source, ``n`` and cluster of a stored table, as ``with_clusters`` gives them. Rows are dealt to shards
    by their place in the table, so that rows without an id, or with one id, are spread like all others.
    """
    shards = max(1, docs.count() // SHARD + 1)
    df = picked(docs, doc_id="doc_id", n="n", source="source", cluster="cluster")
    df = df.withColumn("shard", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)))
    last = F.greatest(F.ceil(F.col("n") / capacity) - 1, F.lit(0))
    df = df.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))))
    df = df.withColumn("start", F.col("piece") * capacity).withColumn("length", F.least(F.lit(capacity), F.col("n") - F.col("start")).cast("long"))
    kind = df.schema["doc_id"].dataType.simpleString()

    def run(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        # Equal lengths: larger clusters of the shard do not matter, the order of ids settles it.
        rows.sort(key=lambda r: (-r["length"], r["doc_id"] is None, r["doc_id"], r["piece"]))
        placed = best_fit([(r["length"], r["source"], r["cluster"]) for r in rows if r["length"]], capacity, per_source)
        placed += [None] * (len(rows) - len(placed))
        shard = rows[0]["shard"]
        return pa.table(
            {
                "doc_id": pa.array([r["doc_id"] for r in rows], group.schema.field("doc_id").type),
                "piece": pa.array([r["piece"] for r in rows], pa.int64()),
                "start": pa.array([r["start"] for r in rows], pa.int64()),
                "length": pa.array([r["length"] for r in rows], pa.int64()),
                "bin": pa.array([f"{shard}-{p[0]}" if p else None for p in placed], pa.string()),
                "offset": pa.array([p[1] if p else None for p in placed], pa.int64()),
            }
        )

    shape = f"doc_id {kind}, piece bigint, start bigint, length bigint, bin string, offset bigint"
    return df.select("doc_id", "source", "cluster", "shard", "piece", "start", "length").groupBy("shard").applyInArrow(run, shape)
