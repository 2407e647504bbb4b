"""The pipeline against its own operators' brute-force rules, and the entry module."""

import collections
import random

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def test_stages_on_a_small_corpus(spark, tmp_path):
    rng = random.Random(3)
    text = lambda n: " ".join(rng.choice("abcdefghijklmnop") + str(rng.randrange(3000)) for _ in range(n))
    passage = text(80)
    rows = [(i, text(rng.randrange(80, 200)), "en", f"s{i % 3}", 0) for i in range(90)]
    rows += [(200 + i, rows[0][1], "en", "s0", 0) for i in range(20)]  # copies of document 0
    rows += [(300 + i, f"{text(90)} {passage} {text(90)}", "en", "s1", 0) for i in range(5)]
    rows += [(400, "too short", "en", "s2", 0), (401, None, None, None, None), (402, "spam " * 300, "en", "s2", 0)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"file://{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"file://{tmp_path}/documents.parquet")
    kept = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, f"file://{tmp_path}")
        if i < 4:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        docs.write.parquet(f"file://{tmp_path}/out{i}")
        docs = spark.read.parquet(f"file://{tmp_path}/out{i}")
        kept.append({r["doc_id"]: r for r in docs.collect()})
    assert set(kept[0]) == {r[0] for r in rows} - {400, 401, 402}
    assert set(kept[1]) == set(range(90)) | {300 + i for i in range(5)}
    assert set(kept[2]) == set(kept[1]) and all(passage not in r["text"] for r in kept[2].values())
    assert all(kept[2][i]["text"] == kept[1][i]["text"] for i in range(90))
    assert set(kept[3]) <= set(kept[2])
    assert all(r["decodes"] and r["parity"] for r in kept[4].values())
    again = corpus_pipeline.run(spark, f"file://{tmp_path}")
    count = lambda df: collections.Counter((r["doc_id"], r["n_tokens"]) for r in df.collect())
    assert count(again) == count(docs)
