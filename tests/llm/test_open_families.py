"""Families whose pairs lie around the similarity that is asked for: every link between two components counts."""

import random

import numpy as np

from roadweave.llm import near_copies, simhash


def brute(texts):
    sets = [set(simhash.shingle_hashes(t, 5).tolist()) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    links = 0
    for a in range(len(texts)):
        for b in range(a):
            same = len(sets[a] & sets[b])
            if same >= 0.8 * (len(sets[a]) + len(sets[b]) - same) - 1e-9:
                links += 1
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [find(x) for x in range(len(texts))], links


def test_families_around_the_similarity(spark):
    rng = random.Random(2)
    texts = []
    for _ in range(6):
        base = [f"w{rng.randrange(6000)}" for _ in range(220)]
        for _ in range(150):
            share = rng.uniform(0.004, 0.022)
            texts.append(" ".join(w if rng.random() > share else f"x{rng.randrange(6000)}" for w in base))
    label, links = brute(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r["doc_id"]: r["component"] for r in near_copies.near_copy_components(docs).collect()}
    lost = len(set(found.values())) - len(set(label))
    print("links", links, "components", len(set(label)), "found", len(set(found.values())))
    assert lost == 0 and found == dict(enumerate(label))


def test_clusters_of_several_blocks(spark):
    """A cluster that is cut in blocks: copies of one text, a cloud of texts around the similarity, and both."""
    rng = random.Random(4)
    base = [f"w{rng.randrange(6000)}" for _ in range(150)]
    texts = [" ".join(w if rng.random() > share else f"x{rng.randrange(6000)}" for w in base) for share in (0.002,) * 60 + (0.02,) * 60]
    for part, block in ((texts, 1500), (texts, 400), (texts[:60], 400), (texts[60:], 400)):
        label, _ = brute(part)
        some = spark.createDataFrame(list(enumerate(part)), "doc_id bigint, text string")
        found = {r["doc_id"]: r["component"] for r in near_copies.near_copy_components(some, deal=near_copies.Deal(block=block, pivots=2)).collect()}
        assert found == dict(enumerate(label))


def test_shared_shingles_are_counted():
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 40, int(n))).astype(np.int32) for n in rng.integers(1, 60, 80)] + [np.empty(0, np.int32)] * 2
    words = [np.zeros(len(sets), np.uint64)] * 4
    ends = np.concatenate([[0], np.cumsum([len(x) for x in sets])])
    root = near_copies.similar(words, np.arange(len(sets)).astype(np.uint64), np.concatenate(sets), ends, 0, 0.8)
    want = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            same, either = len(np.intersect1d(sets[a], sets[b])), len(np.union1d(sets[a], sets[b]))
            if same >= 0.8 * either:
                low, high = sorted((want[a], want[b]))
                want = [low if x == high else x for x in want]
    assert root.tolist() == want
