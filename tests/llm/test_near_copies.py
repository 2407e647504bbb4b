"""The near-copy stage against brute force over exact Jaccard similarities."""

import random

import numpy as np
import pytest

from roadweave.llm import near_copies, simhash

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def jaccard(a: str, b: str) -> float:
    x, y = (set(simhash.shingle_hashes(t, 5).tolist()) for t in (a, b))
    return len(x & y) / len(x | y)


def pairs_of_texts() -> list[tuple[str, str, float]]:
    """Isolated pairs, similarities from 0.6 to 1."""
    rng = random.Random(11)
    out = []
    for i in range(400):
        base = [f"w{rng.randrange(5000)}" for _ in range(300)]
        share = (0.005, 0.01, 0.02, 0.025, 0.03, 0.04, 0.05, 0.08)[i % 8]
        a, b = " ".join(base), " ".join(w if rng.random() > share else f"x{rng.randrange(5000)}" for w in base)
        out.append((a, b, jaccard(a, b)))
    return out


def test_pairs_at_the_stated_similarity(spark, tmp_path):
    found = pairs_of_texts()
    rows = [(2 * i + j, t, "en", "s", 0) for i, x in enumerate(found) for j, t in enumerate(x[:2])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = {r["doc_id"] for r in corpus_pipeline.near_dedup(spark, docs, "").collect()}
    assert {2 * i for i in range(len(found))} <= kept
    gone = [2 * i + 1 not in kept for i in range(len(found))]
    at = np.array([x[2] for x in found])
    assert not any(g for g, x in zip(gone, at, strict=True) if x < 0.8)
    low = [g for g, x in zip(gone, at, strict=True) if 0.8 <= x < 0.85]
    high = [g for g, x in zip(gone, at, strict=True) if x >= 0.85]
    print("found", sum(low), "of", len(low), "at 0.80 to 0.85,", sum(high), "of", len(high), "above")
    assert len(low) > 20 and sum(low) >= 0.97 * len(low)
    assert len(high) > 100 and sum(high) >= 0.99 * len(high)


def test_families_and_hot_keys(spark):
    rng = random.Random(5)
    texts = []
    for n in (40, 12, 5, 3):  # families of all similarities
        base = [f"w{rng.randrange(5000)}" for _ in range(200)]
        texts += [" ".join(w if rng.random() > rng.choice((0.005, 0.01, 0.015)) else f"x{rng.randrange(5000)}" for w in base) for _ in range(n)]
    texts += ["", None, texts[0]]
    label = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            same = (not texts[a] and not texts[b]) or (texts[a] and texts[b] and jaccard(texts[a], texts[b]) >= 0.8)
            if same and label[a] != label[b]:
                low, high = sorted((label[a], label[b]))
                label = [low if x == high else x for x in label]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for hot in (simhash.HOT_KEY, 6):
        found = {r["doc_id"]: r["component"] for r in near_copies.near_copy_components(docs, deal=near_copies.Deal(hot_key=hot)).collect()}
        assert found == dict(enumerate(label))


def test_one_row_of_each_component_stays(spark):
    rng = random.Random(9)
    a, b, c = (" ".join(f"{x}{rng.randrange(4000)}" for _ in range(60)) for x in "abc")
    rows = [(1, a, "x"), (1, a, "y"), (2, a, "x"), (2, b, "x"), (3, c, "x"), (None, c, "x"), (None, None, "x"), (None, "", "y")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, label string")
    kept = near_copies.keep_one_of_near_copies(docs)
    assert kept.columns == docs.columns
    found = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert sorted(x for x in found if x[0]) == sorted([(1, a), (2, b), (3, c)]) and len(found) == 4
    assert near_copies.keep_one_of_near_copies(docs.limit(0)).collect() == []


@pytest.mark.parametrize("bits", [12, 16, 20])
def test_keys_hold_recall_as_they_grow(bits):
    rng = np.random.default_rng(1)
    deal = near_copies.Deal()
    n = 4000
    words = rng.integers(0, 1 << 63, (4, n)).astype(np.uint64)
    flips = np.packbits((rng.random((4 * n, 64)) < deal.differ).astype(np.uint8), axis=1).view(np.uint64).ravel().reshape(4, n)
    x, y = (near_copies.keys_of(list(w), bits, deal.keys(bits)) for w in (words, words ^ flips))
    assert (x == y).any(axis=1).mean() >= 0.99
