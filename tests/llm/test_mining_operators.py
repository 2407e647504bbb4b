import itertools
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from roadweave.llm import filter_audit, hard_negatives, language_id, queries

DOCS = "doc_id bigint, text string, lang string, source string"


# op11


def _windows(n, width, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.integers(97, 123, (n, width)).astype(np.int16)
    x[0, width // 2 :] = language_id.PAD
    return x, rng.integers(0, 3, n)


def test_gradients_are_those_of_the_loss():
    settings = language_id.Settings(units=3)
    weights = [w.astype(np.float64) for w in language_id.start(3, settings)]
    x, lang = _windows(4, 6)
    _, grads = language_id.gradients(weights, x.T, lang)
    rng = np.random.default_rng(1)
    for w, g in zip(weights, grads, strict=True):
        for _ in range(8):
            at = tuple(rng.integers(0, s) for s in w.shape)
            if w.shape[1] == language_id.PAD + 1:
                at = (at[0], int(x[1, at[1] % 6]))
            old, step = w[at], 3e-3  # states are 32-bit numbers
            w[at] = old + step
            up = language_id.gradients(weights, x.T, lang)[0]
            w[at] = old - step
            down = language_id.gradients(weights, x.T, lang)[0]
            w[at] = old
            assert abs((up - down) / (2 * step) - g[at]) < 1e-4


def test_a_position_reads_both_sides_and_padding_changes_nothing():
    weights = language_id.start(3, language_id.Settings(units=3))
    x, _ = _windows(2, 8)
    short = language_id.position_sums(weights, np.ascontiguousarray(x[:1, :4].T))
    assert np.allclose(language_id.position_sums(weights, np.ascontiguousarray(x[:1].T)), short, atol=1e-5)
    # by hand, position by position
    left, right, h = [], [], np.zeros((3, 1), np.float32)
    for b in x[1]:
        h = language_id.step(weights[0], weights[1], np.array([b]), h)[0]
        left.append(h)
    h = np.zeros((3, 1), np.float32)
    for b in x[1][::-1]:
        h = language_id.step(weights[2], weights[3], np.array([b]), h)[0]
        right.insert(0, h)
    each = [language_id.softmax(weights[4] @ np.concatenate([a, b]) + weights[5]) for a, b in zip(left, right, strict=True)]
    assert np.allclose(sum(each), language_id.position_sums(weights, np.ascontiguousarray(x[1:].T)), atol=1e-5)


def test_held_out_languages(spark):
    found = queries.op11_language_id(spark, "/root/testdata/sf0.01").toPandas()
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").toPandas().set_index("doc_id")
    assert sorted(found.doc_id) == sorted(docs.index)
    assert all(h == (zlib.crc32(str(d).encode()) % 4 == 2) for d, h in zip(found.doc_id, found.held_out, strict=True))
    held = found[found.held_out]
    assert (held.lang_pred.to_numpy() == docs.lang[held.doc_id].to_numpy()).mean() > 0.98
    assert found.score.between(0, 1).all()


def test_language_of_odd_rows(spark):
    few = language_id.Settings(rounds=40, batch=8, rate=0.05)
    rows = [(i, "the of and that with " * 5 if i % 2 else "der die und nicht mit " * 5, "en" if i % 2 else "de", "s") for i in range(40)]
    odd = [(100, None, "en", "s"), (101, "", "de", None), (102, "12 $ 3", "en", "s"), (103, "der und die der und die" * 3000, None, "s"), (None, "the of that and", "en", "s"), (1, rows[1][1], "xx", "s"), (104, "é", "zz", "s")]
    docs = spark.createDataFrame(rows + odd, DOCS).withColumns({"score": F.lit("clash"), "lang_pred": F.lit(1), "hash": F.lit(2)})
    learn = F.col("doc_id").between(0, 99) & (F.col("lang") != "xx")
    found = language_id.identify(docs, learn, settings=few)
    assert dict(found.dtypes)["score"] == "double" and "hash" in found.columns and found.count() == len(rows + odd)
    by = {(r.doc_id, r.lang): (r.lang_pred, r.score) for r in found.collect()}
    assert all(by[k] == ("und", 0.0) for k in ((100, "en"), (101, "de"), (102, "en")))
    assert by[103, None][0] == "de" and by[None, "en"][0] == "en" and by[1, "xx"] == by[1, "en"] and by[104, "zz"][0] in ("en", "de")
    # nothing to learn from, an empty table, one language
    assert {r.lang_pred for r in language_id.identify(docs, F.lit(False)).collect()} == {"und"}
    assert language_id.identify(docs.limit(0), learn).count() == 0
    alone = language_id.identify(docs, learn & (F.col("lang") == "en"), settings=few).where("doc_id = 0").first()
    assert (alone.lang_pred, alone.score) == ("en", 1.0)


# op12


def _mined(rows, positives, negatives, low, high):
    """By comparing all pairs."""
    one = {}
    for i, v, c, a in rows:
        if i is None or c is None or not v or any(x is None or not np.isfinite(x) for x in v) or len(v) != 4:
            continue
        q = [int(np.floor(256 * x)) for x in v]
        old = one.get(i)
        one[i] = (*min((c, q), old[:2] if old else (c, q)), a or bool(old and old[2]))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=True))
    out = []
    for a, (c, q, asks) in one.items():
        if not asks:
            continue
        score = sorted((-dot(q, o[1]), i, o[0] == c) for i, o in one.items() if i != a)
        for s, p, _ in [x for x in score if x[2]][:positives]:
            near = [(i, -t) for t, i, same in score if not same and low * -s <= 100 * -t <= high * -s][:negatives]
            out += [(a, p, n + 1, i, -s, t) for n, (i, t) in enumerate(near)]
    return sorted(out)


@pytest.mark.parametrize("settings", [hard_negatives.Settings(), hard_negatives.Settings(fit_rows=64, pivots=3, cell_rows=20, chunk_rows=16, lot_rows=2)])
def test_hard_negatives_by_all_pairs(spark, settings):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.choice([-0.5, 0, 0.25, 0.3], 4)], int(rng.integers(0, 3)), i % 9 == 0) for i in range(150)]
    rows += [(200, None, 1, True), (201, [0.1, None, 0.1, 0.1], 1, False), (202, [0.1, float("nan"), 0.1, 0.1], 1, False), (203, [0.1, float("inf"), 0.1, 0.1], 1, True)]
    rows += [(204, [0.3] * 4, None, False), (205, [0.3] * 3, 1, False), (206, [], 1, True), (None, [0.3] * 4, 1, True), (207, [0.0] * 4, 1, True), rows[9], (10, [0.3] * 4, 0, False)]
    rows += [(300 + i, [0.3, 0.3, 0.25, 0.25], i % 2, i == 0) for i in range(60)]  # many that are equal
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int, a boolean").withColumns({"q": F.lit(1), "cell": F.lit("x"), "id": F.lit(0)})
    for case in ((5, 5, 80, 100), (2, 3, 50, 120)):
        found = hard_negatives.mine(table, F.col("a"), *case, settings=settings)
        assert sorted(map(tuple, found.collect())) == _mined(rows, *case)
    assert hard_negatives.mine(table, F.lit(False), settings=settings).count() == 0
    assert hard_negatives.mine(table.limit(0), F.col("a"), settings=settings).count() == 0
    assert hard_negatives.mine(table.where("label = 1"), F.col("a"), settings=settings).count() == 0


def test_brackets_hold_every_score_and_leave_pairs_out():
    rng = np.random.default_rng(5)
    groups = rng.normal(0, 200, (8, 6))
    x = np.floor(groups[rng.integers(0, 8, 400)] + rng.normal(0, 10, (400, 6)))
    top = float((x * x).sum(1).max())
    high_up = hard_negatives.lifted(x, top)
    pivots = hard_negatives.spread(high_up, 6)
    own = hard_negatives.to_pivots(np.concatenate([x[:50], np.zeros((50, 1))], axis=1), pivots)
    table = hard_negatives.to_pivots(high_up, pivots).astype(np.float32).astype(np.float64)
    least, most = hard_negatives.brackets((x[:50] ** 2).sum(1), top, own, table)
    exact = x[:50] @ x.T
    assert (least <= exact).all() and (exact <= most).all()
    fifth = np.partition(exact, -5, axis=1)[:, -5:-4]
    assert (most < fifth).mean() > 0.4  # with groups, most pairs need no exact score
    cell = np.array([(table[i : i + 1].min(0), table[i : i + 1].max(0)) for i in range(400)])
    assert (hard_negatives.greatest_scores((x[:50] ** 2).sum(1), top, own, cell[:, 0], cell[:, 1]) >= exact).all()


# op13


def _audited(docs, labels):
    """Document by document, order by order."""
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    seen = []
    for d, text, _, part in docs:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        same = any(o[0] is not None and d is not None and o[0] < d and (o[1] or "") == t for o in docs)
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), "D": bool(re.search(r"[#$%&*|]", t)), "E": same}
        seen.append((part or "", {f for f, x in fails.items() if x}, d in good, d in toxic))
    out, share = {}, {}
    for part in {s[0] for s in seen}:
        mine = [s for s in seen if s[0] == part]
        for order in itertools.permutations("ABCDE"):
            for i, f in enumerate(order):
                gone = lambda s, i=i, order=order: bool(s[1] & set(order[:i]))
                here = [s for s in mine if f in s[1] and not gone(s)]
                share[part, f] = share.get((part, f), 0) + len(here)
                out[part, "".join(order), i + 1] = [len([s for s in mine if not s[1] & set(order[: i + 1])]), len(here), len([s for s in mine if f in s[1] and gone(s)]), len([s for s in mine if s[1] == {f}]), sum(s[2] for s in here), sum(s[3] for s in here)]
    return sorted((*k, *v, share[k[0], k[1][k[2] - 1]]) for k, v in out.items())


def test_filter_audit_by_counting(spark):
    rng = np.random.default_rng(2)
    words = ["the", "The", "THE", "é", "日本", "a#b", "x", "longerword", "50%"]
    make = lambda n: " \t".join(words[int(i)] for i in rng.integers(0, len(words), n)) + str(rng.integers(0, 9))
    docs = [(i, make(int(rng.choice([0, 5, 199, 200, 250]))), "en", f"s{i % 3}") for i in range(60)]
    docs += [(100 + i, " ".join(f"w{j}" for j in range(200 + i)), "en", "s0") for i in range(5)]
    docs += [(110, docs[60][1], "en", "s1"), (111, docs[60][1], "en", None), (112, None, "en", ""), (113, "", "en", "s1"), (114, "A" * 300000 + " b" * 300000, "en", "s2"), docs[60], (None, docs[60][1], "en", "s1"), (None, None, None, None)]
    labels = [(i, int(rng.integers(0, 2)), int(rng.integers(0, 2))) for i in range(0, 120, 2)] + [(100, 1, None), (100, 0, 1), (None, 1, 1), (999, 1, 1)]
    table = spark.createDataFrame(docs, DOCS).withColumns({"mask": F.lit(1), "part": F.lit(2), "_n": F.lit(3)})
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").withColumn("source", F.lit("clash"))
    assert sorted(map(tuple, filter_audit.audit(table, marks).collect())) == _audited(docs, labels)
    assert filter_audit.audit(table.limit(0), marks).count() == 0
    assert sum(r.good_lost for r in filter_audit.audit(table, marks.limit(0)).collect()) == 0


@pytest.mark.parametrize("bits", [3, 64])
def test_distinct_words_when_hashes_meet_and_texts_are_cut(bits):
    rng = np.random.default_rng(4)
    texts = [" ".join(rng.choice(["a", "ab", "abc", "b", "ba", "cab", "x" * 40], n)) for n in (0, 1, 7, 30)] + ["", "  ", "   ", " a\n", "b" * 90]
    column = pa.array(texts)
    assert [x.tolist() for x in filter_audit.counts(column, filter_audit.Limits())[:2]] == [[len(re.findall(r"[^\x20\x09-\x0D]+", t)) for t in texts], [len(set(re.findall(r"[^\x20\x09-\x0D]+", t))) for t in texts]]
    for text in texts:
        data = np.frombuffer(text.encode(), np.uint8)
        kind = filter_audit.classes("#")[data]
        found = filter_audit.count_words(data, kind, np.array([0]), np.array([len(data)]), step=16, bits=bits)
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        assert [int(x[0]) for x in found] == [len(words), len(set(words))]
