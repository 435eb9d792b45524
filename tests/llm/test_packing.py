"""Near copies never share a bin, and each piece goes to the tightest compatible one."""

import random

from helpers_llm import rows
from test_near import edited, prose

from pedalflow.llm import packing


def test_near_copies_lie_in_different_bins(spark, docs_of):
    texts = {}
    for k in range(20):
        words = prose(k)
        texts |= {3 * k: " ".join(words), 3 * k + 1: edited(words, 100), 3 * k + 2: "  ".join(words)}
    docs = docs_of([(i, t, "en", f"src{i}") for i, t in texts.items()] + [(None, "x y z", "en", None), (90, "x Y z"), (91, None)])
    found = packing.with_clusters(docs).collect()
    cluster = {r["doc_id"]: r["cluster"] for r in found}
    assert len(found) == len(texts) + 3 and cluster[91] is None and cluster[90] == cluster[None]
    assert len({cluster[i] for i in texts}) == 20
    bins = {i: r["bin"] for i, r in rows(packing.packed(packing.with_clusters(docs)), "doc_id").items()}
    for k in range(20):
        assert len({bins[3 * k], bins[3 * k + 1], bins[3 * k + 2]}) == 3


def plain_best_fit(items, capacity, per_source):
    """Look at every bin."""
    bins, out = [], []
    for length, source, cluster in items:
        fits = []
        for at, (used, sources, clusters) in enumerate(bins):
            free = source is None or sources.count(source) < per_source
            if length <= capacity - used and free and (cluster is None or cluster not in clusters):
                fits.append((capacity - used, at))
        if not fits:
            bins.append([0, [], set()])
        home = min(fits)[1] if fits else len(bins) - 1
        out.append((home, bins[home][0]))
        bins[home][0] += length
        bins[home][1].append(source)
        bins[home][2].add(cluster)
    return out


def test_best_fit_takes_the_tightest_compatible_bin():
    rng = random.Random(6)
    for _ in range(40):
        items = [(rng.randint(1, 100), rng.choice(["a", "a", "b", "c", None]), rng.choice([None, *range(30)])) for _ in range(300)]
        items.sort(key=lambda i: -i[0])
        assert packing.best_fit(items, 100, 2) == plain_best_fit(items, 100, 2)


def test_rows_without_id_or_with_one_id_are_spread(docs_of, monkeypatch):
    monkeypatch.setattr(packing, "SHARD", 50)
    docs = docs_of([(None if i % 2 else 7, f"text number {i} of many", "en", f"src{i}") for i in range(400)])
    found = packing.packed(packing.with_clusters(docs)).collect()
    assert len(found) == 400 and len({r["bin"].split("-")[0] for r in found}) > 4
