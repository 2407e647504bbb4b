"""Small cases and brute-force versions of the operators on documents."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import pytest
import xxhash
from roadweave.llm import components, lm_scoring, mixing, quality_rules, sentencepiece_tok, simhash, suffix_dedup

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words_text(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}{'ab'[rng.randrange(2)]}" for _ in range(n))


def corpus(seed=1, n=60):
    rng = random.Random(seed)
    passage = words_text(rng, 60)
    rows = []
    for i in range(n):
        text = words_text(rng, rng.randrange(5, 160))
        if i % 5 == 0:
            text = f"{text}\n{passage} {words_text(rng, 20)}"
        if i % 7 == 3 and rows:
            text = rows[-1][1]
        rows.append((i, text, "en", f"s{i % 3}" if i % 4 else None, len(text)))
    rows += [(100, None, None, None, None), (101, "", "en", "s0", 0), (102, " \t\n ", "en", "s1", 4), (103, "é " * 300, "fr", "s1", 600), (104, "x" * 5000, "en", "s2", 5000)]
    rows += [rows[2], rows[2], (None, "no id at all here", "en", "s0", 17)]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def test_quality_counts_match_a_plain_version(docs):
    rows = quality_rules.judge_quality(docs.select("doc_id", "text")).collect()
    assert len(rows) == len(corpus())
    for r in rows:
        words = (r["text"] or "").encode().split()
        windows = list(zip(words, words[1:], words[2:]))
        often = {w for w, k in collections.Counter(windows).items() if k > 1}
        hit = {i + k for i, w in enumerate(windows) if w in often for k in range(3)}
        lines = [x for x in (r["text"] or "").split("\n") if x.strip(quality_rules.WHITE)]
        assert r["n_words"] == len(words)
        assert r["word_chars"] == sum(len(w.decode()) for w in words)
        assert r["n_repeat_words"] == len(hit)
        assert r["n_dup_lines"] == len(lines) - len(set(lines))
        assert r["base_failed"] == (len(words) < 50 or 100 * len(hit) > 50 * len(words))
        assert not (r["base_failed"] and r["kept"])


def prose(rng, n):
    """Words of a language of some thousand, frequent ones first, as compressible as any."""
    return " ".join(f"{'abcdefghij'[k % 10]}{'aeiou'[k % 5]}{k % 397:x}" for k in (int(3000 * rng.random() ** 3) for _ in range(n)))


def test_quality_bands_reject_planted_loops_and_noise_and_keep_prose(spark):
    rng = random.Random(5)
    sizes = [int(80 * 1.022 ** (i % 200)) for i in range(1200)]
    good = [prose(rng, n) for n in sizes]
    bad = []
    for i in range(120):
        n = int(150 * 1.04 ** (i % 80))
        share = 0.2 + 0.2 * (i % 5) / 4
        words = prose(rng, n).split(" ")
        junk = int(n * share)
        if i % 2:
            line = prose(rng, 9).split(" ")
            part = (line * (junk // 9 + 1))[:junk]
        else:
            part = ["".join(chr(rng.randrange(0x100, 0x2000)) for _ in range(4)) for _ in range(junk)]
        at = rng.randrange(n - junk)
        bad.append(" ".join([*words[:at], *part, *words[at + junk :]]))
    table = spark.createDataFrame(list(enumerate(good + bad)), "doc_id bigint, text string")
    found = {r["doc_id"]: r for r in quality_rules.judge_quality(table).collect()}
    judged = [found[i] for i in range(len(good)) if not found[i]["base_failed"]]
    assert len(judged) > 1000 and sum(r["kept"] for r in judged) >= 0.97 * len(judged)
    planted = [found[len(good) + i] for i in range(len(bad))]
    assert sum(not r["base_failed"] for r in planted) > 100  # the bands have to tell
    assert sum(not r["kept"] for r in planted) >= 0.97 * len(planted)


def test_quality_verdict_matches_a_plain_version(spark):
    """Medians and quartiles by length over different texts, and the verdict, without arrays."""
    import xxhash as xx
    import zstandard

    rng = random.Random(7)
    texts = [prose(rng, int(60 * 1.03 ** (i % 150))) for i in range(500)] + ["#$% " * 90 + prose(rng, 300)] * 3 + [prose(rng, 100)] * 200
    bands = quality_rules.CompressionBands(chunk_bytes=1500)
    packer = zstandard.ZstdCompressor(level=3)
    found = {r["doc_id"]: r for r in quality_rules.judge_quality(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), bands=bands).collect()}
    log = lambda x: math.log(len(x) / len(packer.compress(x)))
    step = lambda x: int(bands.steps * math.log2(len(x)))
    parts = lambda x: [x[i : i + 1500] for i in range(0, len(x), 1500)] if len(x) > 1500 else []
    data = [t.encode() for t in texts]
    seen: tuple[dict, dict] = ({}, {})
    for i, x in enumerate(data):
        if not found[i]["base_failed"]:
            for k, y in [(0, x), *((1, p) for p in parts(x))]:
                if len(y) >= 200:
                    seen[k][xx.xxh64_intdigest(y)] = (step(y), round(256 * log(y)))

    def out(kind, x):
        if len(x) < 200:
            return False
        near = sorted(b for s, b in seen[kind].values() if abs(s - step(x)) <= 1)
        if len(near) < 50:
            low, high = [(a, b) for n, a, b in bands.outer if 2 ** (step(x) / 4) >= n][-1:][0] if 2 ** (step(x) / 4) >= 200 else bands.outer[0][1:]
            return not math.log(low) <= log(x) <= math.log(high)
        q = lambda p: near[math.ceil(p * len(near)) - 1] / 256
        half = (3.5, 5.0)[kind] * max(0.03, (q(0.75) - q(0.25)) / 1.349)
        return not q(0.5) - half <= log(x) <= q(0.5) + half

    for i, x in enumerate(data):
        bad = sum(out(1, p) for p in parts(x))
        kept = not (found[i]["base_failed"] or out(0, x) or (bad and bad >= 0.2 * len(parts(x))))
        assert found[i]["kept"] == kept, i
    assert any(not r["kept"] and not r["base_failed"] for r in found.values())


def test_quality_replaces_clashing_columns_and_takes_empty_tables(docs, nothing):
    clash = docs.withColumnRenamed("lang", "kept").withColumnRenamed("source", "n_words")
    assert quality_rules.judge_quality(clash).columns.count("kept") == 1
    assert quality_rules.judge_quality(nothing).collect() == []


def test_simhash_matches_brute_force(docs, nothing):
    rows = simhash.simhash_components(docs, shingle=3, k=2).collect()
    prints = collections.defaultdict(list)
    for doc_id, text, *_ in corpus():
        words = (text or "").encode().lower().split()
        shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        hashes = [xxhash.xxh64_intdigest(x, 42) for x in shingles]
        prints[doc_id].append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)))
    ids = list(prints)
    root = {i: i for i in range(len(ids))}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if any((a ^ b).bit_count() <= 2 for a in prints[ids[i]] for b in prints[ids[j]]):
                root[find(i)] = find(j)
    least = {}
    for i in range(len(ids)):
        if ids[i] is not None:
            least[find(i)] = min(least.get(find(i), 1 << 60), ids[i])
    assert len(rows) == len(corpus())
    for r in rows:
        assert r["simhash"] % (1 << 64) in prints[r["doc_id"]]
        assert r["component"] == least.get(find(ids.index(r["doc_id"])))
    assert simhash.simhash_components(nothing).collect() == []


@pytest.mark.parametrize("k", [1, 2, 3])
def test_links_find_every_near_fingerprint_also_of_hot_keys(spark, k):
    rng = random.Random(k)
    centres = [rng.getrandbits(64) for _ in range(40)]
    prints = {c ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(0, 4))) for c in centres for _ in range(12)}
    prints |= {centres[0] ^ (1 << a) ^ (1 << b) for a in range(20) for b in range(a)}
    table = spark.createDataFrame([(simhash.signed(x),) for x in prints], "simhash bigint")
    order = sorted(prints)
    x = np.array(order, np.uint64)
    a, b = np.nonzero(np.triu(np.bitwise_count(x[:, None] ^ x[None, :]) <= k, 1))
    label = simhash.spanning(len(order), [(a, b)])
    for hot in (simhash.HOT_KEY, 30):
        found = [(r["u"] % (1 << 64), r["v"] % (1 << 64)) for r in simhash.links(table, k, hot_key=hot).collect()]
        assert all((p ^ q).bit_count() <= 64 for p, q in found)
        at = {p: i for i, p in enumerate(order)}
        mine = simhash.spanning(len(order), [(np.array([at[p] for p, _ in found]), np.array([at[q] for _, q in found]))])
        assert (mine == label).all()


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(50)] + [(1000, 1000 + i) for i in range(1, 200)] + [(7, 7), (60, 61)]
    found = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert all(found[i] == 0 for i in range(51)) and all(found[1000 + i] == 1000 for i in range(200)) and found[61] == 60


def test_suffix_dedup_matches_brute_force(spark, docs, nothing):
    length = 64
    for hot in (suffix_dedup.HOT_ANCHOR, 1):
        rows = suffix_dedup.without_repeats(docs, length=length, hot_anchor=hot).collect()
        data = [(i, (t or "").encode()) for i, t, *_ in corpus()]
        starts = collections.Counter(b[k : k + length] for _, b in data for k in range(len(b) - length + 1))
        expected = collections.Counter()
        for i, b in data:
            covered = np.zeros(len(b), bool)
            for k in range(len(b) - length + 1):
                if starts[b[k : k + length]] > 1:
                    covered[k : k + length] = True
            kept = np.frombuffer(b, np.uint8)[~covered].tobytes()
            expected[i, len(b), int(covered.sum()), len(suffix_dedup.spans_of(covered)), hashlib.sha256(kept).hexdigest()] += 1
        assert collections.Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows) == expected
    assert suffix_dedup.without_repeats(nothing).collect() == []


def periodic_texts():
    rng = random.Random(6)
    out = ["a" * 900, "a" * 64, "b" + "a" * 65 + "c", "ha " * 200, "xha ha ha " + "ha " * 30, "the same old line of text " * 20, "and the same old line of text " * 3 + "end"]
    for _ in range(60):
        unit = "".join(rng.choice("ab") for _ in range(rng.randrange(1, 70)))
        run = (unit * 400)[: rng.randrange(20, 400)]
        out.append("".join(rng.choice("abc") for _ in range(rng.randrange(0, 30))) + run + "".join(rng.choice("abc") for _ in range(rng.randrange(0, 30))))
        if rng.random() < 0.3:
            out.append(out[-1][rng.randrange(40) :])
    return out


def test_suffix_dedup_matches_brute_force_on_periodic_texts(spark):
    length, texts = 64, periodic_texts()
    starts = collections.Counter(t[k : k + length] for t in texts for k in range(len(t) - length + 1))
    expected = {}
    for i, t in enumerate(texts):
        covered = [False] * len(t)
        for k in range(len(t) - length + 1):
            if starts[t[k : k + length]] > 1:
                covered[k : k + length] = [True] * length
        expected[i] = "".join(c for c, x in zip(t, covered) if not x)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for hot in (suffix_dedup.HOT_ANCHOR, 2):
        found = {r["doc_id"]: r["text"] for r in suffix_dedup.without_repeats(docs, length=length, hot_anchor=hot).collect()}
        assert found == expected


@pytest.mark.parametrize("unit", ["a", "ha ", "the same old line of text. "])
def test_suffix_anchors_of_a_loop_are_few(unit):
    data = np.frombuffer((unit * 1_000_000)[:1_000_000].encode(), np.uint8)
    place, _, first, last, spans = suffix_dedup.anchors(data)
    assert len(place) < 20 and int((last - first).sum()) < 2000 and suffix_dedup.merged(spans) == [(0, 1_000_000)]
    rng = random.Random(1)
    plain = np.frombuffer(words_text(rng, 50_000, 5000).encode(), np.uint8)
    place, _, first, last, spans = suffix_dedup.anchors(plain)
    assert not spans and last[-1] == len(plain) - 200 and (first[1:] == last[:-1] + 1).all()
    assert int((last - first + 200).sum()) < 4 * len(plain)


def test_suffix_columns_match_brute_force_on_random_pieces():
    rng = random.Random(3)
    for _ in range(30):
        length, texts, at, group = 12, [], [], []
        for g in range(4):
            core = bytes(rng.randrange(2) for _ in range(14))
            for _ in range(rng.randrange(1, 7)):
                left, right = bytes(rng.randrange(2) for _ in range(rng.randrange(0, 8))), bytes(rng.randrange(2) for _ in range(rng.randrange(0, 8)))
                texts.append(left + core + right)
                at.append(len(left))
                group.append(g)
        found = suffix_dedup.repeated_starts(np.array(group), texts, np.array(at), length)
        for i, x in enumerate(texts):
            for t in range(len(x) - length + 1):
                others = (j for j in range(len(texts)) if j != i and group[j] == group[i])
                same = any(0 <= (u := t - at[i] + at[j]) <= len(texts[j]) - length and texts[j][u : u + length] == x[t : t + length] for j in others)
                assert found[i][t] == same


def test_suffix_dedup_keeps_clashing_columns(docs):
    clash = docs.withColumnRenamed("lang", "key").withColumnRenamed("source", "spans")
    out = suffix_dedup.without_repeats(clash, length=64)
    assert {"key", "spans", "text", "doc_id"} <= set(out.columns) and out.count() == len(corpus())


def test_mixing_meets_targets(spark, docs, nothing):
    rng = random.Random(8)
    rows = [(i, words_text(rng, rng.randrange(1, 60)), f"s{'0' if i % 3 == 0 else i % 7}") for i in range(3000)] + [(-1, None, "s1"), (-2, "a b", None), (-3, "", "")]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    found = mixing.mixed(table).collect()
    again = mixing.mixed(table.repartition(7)).collect()
    key = lambda x: sorted((r["doc_id"], r["taken"]) for r in x)
    assert key(found) == key(again) and len(found) == len(rows)
    size = collections.Counter()
    for _, text, source in rows:
        size[source] += len((text or "").split())
    order = sorted((s for s in size if s is not None)) + [None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    open_, target, left = set(order), {}, 1.5 * sum(size.values())
    while True:
        over = {s for s in open_ if left * weight[s] / sum(weight[x] for x in open_) > 2 * size[s]}
        if not over:
            break
        for s in over:
            target[s] = 2.0 * size[s]
        open_ -= over
        left = 1.5 * sum(size.values()) - sum(target.values())
    target |= {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
    source_of = {i: s for i, _, s in rows}
    taken = collections.Counter()
    for r in found:
        s = source_of[r["doc_id"]]
        assert r["source_size"] == size[s] and math.isclose(r["target"], target[s], rel_tol=1e-9, abs_tol=1e-9)
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[s] += r["taken"]
    assert all(abs(taken[s] - target[s]) <= 60 for s in order)
    assert mixing.mixed(nothing).collect() == []
    assert mixing.take_mix(docs).columns == docs.columns


def test_pivot_keeps_mass_and_decides_all_but_one():
    rng = np.random.default_rng(0)
    size, part = rng.integers(1, 50, 200), np.full(200, 0.37)
    out = mixing.pivot(size, part, rng.integers(0, 1 << 63, 200).astype(np.uint64), last=False)
    assert ((out > 0) & (out < 1)).sum() <= 1 and math.isclose((out * size).sum(), (part * size).sum(), rel_tol=1e-9)
    mean = np.mean([mixing.pivot(size[:5], part[:5], rng.integers(0, 1 << 63, 5).astype(np.uint64), last=True) for _ in range(4000)], axis=0)
    assert np.abs(mean - 0.37).max() < 0.05


@pytest.mark.parametrize(("frequent", "hot", "step"), [(1 << 20, 1 << 16, 1 << 20), (200, 300, 500), (1, 1, 50)])
def test_lm_scores_match_a_plain_version(docs, nothing, monkeypatch, frequent, hot, step):
    """frequent, hot and step change how counts travel: all words, some and none by broadcast; the scores are the same."""
    monkeypatch.setattr(lm_scoring, "STEP_ROWS", step)
    rows = lm_scoring.score_documents(docs, frequent=frequent, hot=hot, range_rows=1500).collect()
    data = [(i, [*(t or "").encode().lower().split(), b""]) for i, t, *_ in corpus()]
    fold = lambda i: None if i is None else zlib.crc32(str(i).encode()) % 7
    word, pair, fit_word, fit_pair, tune = (collections.Counter() for _ in range(5))
    for i, w in data:
        if fold(i) == 2:
            continue
        pairs = list(zip([b"", *w], w))
        word.update(w)
        pair.update(pairs)
        if fold(i) == 6:
            tune.update(pairs)
        else:
            fit_word.update(w)
            fit_pair.update(pairs)
    n, v, n_fit = sum(word.values()), len(word), sum(fit_word.values())
    cell = collections.Counter()
    level, bucket = lambda p: int(lm_scoring._level(np.array([p]))[0]), lambda c: int(lm_scoring.bucket(np.array([c]))[0])
    for (a, b), k in tune.items():
        context, p2 = word[a], fit_pair[a, b] / max(1, fit_word[a])
        cell[(bucket(context) * lm_scoring.LEVELS + level(p2)) * lm_scoring.LEVELS + level(fit_word[b] / n_fit)] += k
    mix = lm_scoring.weights(np.array(list(cell)), np.array(list(cell.values())), 1 / (v + 1))
    expected = collections.Counter()
    for i, w in data:
        score = 0.0
        for a, b in zip([b"", *w], w):
            context = word[a]
            m = mix[bucket(context)]
            score += math.log10(m[0] * (pair[a, b] / context if context else 0) + m[1] * word[b] / n + m[2] / (v + 1))
        expected[i, fold(i) == 2, len(w), sum(word[x] > 0 for x in w), n, round(sum(math.log10((word[x] + 1) / (n + v + 1)) for x in w), 5), round(score, 5)] += 1
    assert collections.Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5), round(r["score"], 5)) for r in rows) == expected
    assert lm_scoring.score_documents(nothing).collect() == []


def test_lm_weights_rise_with_the_better_estimate():
    level = lambda p: lm_scoring._level(np.array([p]))[0]
    cells = np.array([(5 * lm_scoring.LEVELS + level(0.5)) * lm_scoring.LEVELS + level(0.001), (5 * lm_scoring.LEVELS + level(0)) * lm_scoring.LEVELS + level(0.001)])
    mix = lm_scoring.weights(cells, np.array([80, 20]), 1e-6)
    assert mix[5, 0] > 0.7 and mix[5, 1] > 0.15 and np.allclose(mix.sum(1), 1)


def test_sentencepiece_round_trip_and_parity(spark, docs, nothing):
    import sentencepiece

    found = sentencepiece_tok.encoded(docs, keep_text=True)
    other = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_tok.DEFAULT_MODEL)
    for r in found.collect():
        assert r["token_ids"] == other.encode(r["text"] or "") and r["parity"] and r["decodes"] and r["n_tokens"] == len(r["token_ids"])
    back = sentencepiece_tok.decoded(found.withColumnRenamed("text", "before"))
    assert back.where("coalesce(before, '') <> text").count() == 0
    assert sentencepiece_tok.encoded(nothing).collect() == []
    odd = ["  two  blanks ", "a ▁ b", "\n\n x\ty ", "日本語 🎉", " ", "trail  "]
    for r in sentencepiece_tok.encoded(spark.createDataFrame(list(enumerate(odd)), "doc_id bigint, text string"), keep_text=True).collect():
        assert r["token_ids"] == other.encode(r["text"]) and r["parity"] and r["decodes"] == ("▁" not in r["text"])


def test_sentencepiece_unigram_models():
    """A unigram model with byte fallback, written by hand: the tokenizer follows its scores."""
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), *((f"<0x{i:02X}>", 0.0, 6) for i in range(256)), ("▁", -2.0, 1), ("▁ab", -1.0, 1), ("a", -3.0, 1), ("b", -3.0, 1), ("ba", -2.5, 1)]
    model = sentencepiece_tok.SentencePieceModel(pieces=pieces, model_type=sentencepiece_tok.UNIGRAM, byte_fallback=True)
    ids = model.tokenizer().encode("▁abba").ids
    assert [pieces[i][0] for i in ids] == ["▁ab", "ba"]


def test_packed_rows_stay_small_when_they_are_few():
    from roadweave.llm import lm_scoring

    rng = np.random.default_rng(0)
    columns = lambda n: {"base": np.array([5], np.uint64), "key1": np.sort(rng.integers(0, 1 << 62, n).astype(np.uint64)), "beside1": rng.integers(0, 1 << 62, n).astype(np.uint64), "text1": rng.integers(0, 600, n), "n1": rng.integers(1, 4, n), "fold1": rng.integers(0, 3, n), "key0": np.empty(0, np.uint64)}
    size = {}
    for n in (1, 5, 50, 5000):
        x = columns(n)
        packed = lm_scoring.pack(**x)
        back = lm_scoring.unpack(packed)
        assert all((back[k].astype(np.int64) == np.asarray(v).astype(np.int64)).all() and len(back[k]) == len(v) for k, v in x.items()) and len(back["key2"]) == 0
        size[n] = len(packed) / n
    # a range of a hundred times as many has a hundredth of a slice's rows
    assert size[50] < 1.3 * size[5000] and size[1] < 80
    score = {"row": np.arange(3), "score": np.array([-1.5, 2.0, 0.25])}
    assert (lm_scoring.unpack(lm_scoring.pack(**score))["score"] == score["score"]).all()
