"""Hard negatives against all pairs, in whole numbers."""

import math
import random
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from pedalflow.llm import negatives, queries

NAMES = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def plain_mined(data, every):
    """All answers by (vec_id, label, vector) rows, a bag of tuples."""
    usable = []
    for i, label, vector in data:
        if None not in (i, label, vector) and all(x is not None and math.isfinite(x) for x in vector):
            usable.append((i, label, [math.floor(256 * x) for x in vector]))
    out = []
    for a, label, q in usable:
        if a % every:
            continue
        scored = [(-sum(x * y for x, y in zip(q, r)), i, other) for i, other, r in usable if i != a]
        scored.sort(key=lambda s: s[:2])
        for less, i, _ in [s for s in scored if s[2] == label][:5]:
            fit = [s for s in scored if s[2] != label and 50 * -less <= 100 * -s[0] <= 95 * -less]
            out += [(a, i, k, n, -less, -m) for k, (m, n, _) in enumerate(fit[:3], 1)]
    return Counter(out)


def found(df):
    return Counter(tuple(r) for r in df.select(*NAMES).collect())


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01", "sf0.1"])
def test_query_against_sql(spark, scale):
    folder = f"/root/testdata/{scale}"
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
    want = duck.execute(f"SELECT {', '.join(NAMES)} FROM ({queries.ORACLE['op13_hard_negatives']})").fetchall()
    got = found(queries.op13_hard_negatives(spark, folder))
    assert got == Counter(want) and len(got) > 0


SHAPE = "vec_id bigint, label int, embedding array<float>, tile string, score double"


def frame(spark, data):
    return spark.createDataFrame([(*d, "x", 0.5) for d in data], SHAPE)


@pytest.mark.parametrize("seed", range(3))
def test_ties_and_hot_labels_in_small_tiles(spark, monkeypatch, seed):
    """Few different components make ties everywhere, and one label has a third of all rows."""
    monkeypatch.setattr(negatives, "TILE", 37)
    monkeypatch.setattr(negatives, "ANCHORS", 8)
    monkeypatch.setattr(negatives, "STRIPE", 2)
    rng = random.Random(seed)
    data = [(i, rng.choice([1, 1, 1, 2, 3, 4, 5, 6]), [rng.choice([-0.5, 0.25, 0.5, 1.0]) for _ in range(4)]) for i in range(400)]
    got = found(negatives.mined(frame(spark, data).repartition(5), F.col("vec_id") % 5 == 0))
    assert got == plain_mined(data, 5) and len(got) > 200


def test_edges(spark):
    """Nulls, values that are no numbers, unequal and empty vectors, repeated rows, huge components, no rows."""
    data = [(0, 1, [1.0, 0.5]), (0, 1, [1.0, 0.5]), (1, 1, [0.9, 0.5]), (2, 2, [0.8, 0.1]), (2, 2, [0.8, 0.1]), (3, 2, [0.5]), (4, 2, [0.6, 0.0, 9.0])]
    data += [(5, 1, []), (6, None, [1.0]), (7, 2, None), (8, 2, [None, 1.0]), (9, 2, [float("nan"), 1.0]), (10, 2, [float("inf"), 1.0]), (None, 2, [0.7, 0.1])]
    data += [(20, 3, [-1.0, 0.0]), (21, 3, [1.0, 0.0]), (30, 4, [0.0, 0.0]), (31, 4, [1.0, 1.0])]
    for rows in (data, [*data, (40, 5, [2.0**20, 2.0**14]), (41, 5, [2.0**21, 1.0]), (42, 6, [2.0**20, -1.0]), (43, 6, [2.0**20 + 1, 0.0])]):
        got = found(negatives.mined(frame(spark, rows), F.col("vec_id") % 10 == 0))
        assert got == plain_mined(rows, 10) and any(r[0] == 0 for r in got)
    assert any(r[0] == 40 for r in got)
    assert negatives.mined(frame(spark, []), F.col("vec_id") % 10 == 0).collect() == []
    assert negatives.mined(frame(spark, data), F.lit(False)).collect() == []
