"""Small cases and brute-force versions of the operators on pages and vectors."""

import base64
import collections
import hashlib
import math
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F
from roadweave.llm import ann, html_extract, url_filter, warc
from roadweave.llm.common import new_path

PAGE = "page_id bigint, url string, html string"


LONG = "A first sentence, with marks and some length. And another one; it goes on, a bit."


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (None, ""),
        ("", ""),
        ("plain &amp; simple", "plain & simple"),
        ("<p>one<p>two", "one\ntwo"),
        ("<nav><a href=x>Home</a></nav><article><h1>Title</h1><p>First, long  enough\n text.</p><p><b>Sec</b>ond.<br>Line</p></article><footer>(c)</footer>", "Title\nFirst, long enough text.\nSecond. Line"),
        ("<body><script>var t='</p>';</script><style>p{}</style><!-- <p>no</p> --><article><p>Yes, it is.</p></article>", "Yes, it is."),
        ('<article><p>A text, with marks.</p><aside>side</aside><form><p>Name</p></form></article><div class="cookie-notice"><p>We use cookies, and more.</p></div>', "A text, with marks."),
        ('<div id=w><div class="content"><h2>Head</h2><p>Body text, here it is; yes.</p><ul><li>one<li>two</ul></div><div class="comments"><p>Great, great post, really!</p></div></div>', "Head\nBody text, here it is; yes.\none\ntwo"),
        ("<p>a < b and <b unclosed", "a < b and <b unclosed"),
        ("<nav><p>only a menu</p></nav>", ""),
        (f'<div class="social-policy"><h1>T</h1><p>{LONG}</p></div>', f"T\n{LONG}"),
        (f'<article id="commentary"><h1>T</h1><p>{LONG}</p></article>', f"T\n{LONG}"),
        (f"<article><p>{LONG}</p><ul><li><a href=x>First source</a></li><li><a href=y>Second</a></li></ul></article>", f"{LONG}\nFirst source\nSecond"),
        (f'<main><div class="x1">Home News Contact Login</div><p>{LONG}</p></main>', LONG),
        (f"<article><h1>T</h1><p>lead</p><div class=body><p>{LONG}</p><p>{LONG}</p></div><p>end</p></article>", f"T\nlead\n{LONG}\n{LONG}\nend"),
        (f"<div id=a><div class=s>{f'<p>{LONG}</p>' * 5}</div><div class=t><p>{LONG}</p></div></div><footer>x</footer>", "\n".join([LONG] * 6)),
        (f'<div class="content has-sidebar"><p>{LONG}</p></div>', LONG),
        (f'<article class="post comments-open"><p>{LONG}</p><div class="ad">Buy now, cheap things.</div><p>{LONG}</p><section id="comments"><p>I do agree, really. Great post, thanks!</p></section></article>', f"{LONG}\n{LONG}"),
    ],
)
def test_main_text(html, text):
    assert html_extract.main_text(html) == text


def some_pages():
    rng = random.Random(3)
    words = lambda n: " ".join(rng.choice(["alpha", "beta,", "gamma", "delta.", "eps"]) for _ in range(n))
    for _ in range(40):
        body = "".join(f"<p>{words(rng.randrange(3, 60))}</p>" if rng.random() < 0.7 else f"<h2>{words(3)}</h2>" for _ in range(rng.randrange(3, 12)))
        yield f'<body><div class="top">{words(4)}</div><ul><li><a href=x>{words(2)}</a><li><a>{words(1)}</a></ul><div class="m{rng.randrange(3)}"><div>{body}<blockquote><p>{words(9)}</p></blockquote></div></div><div class="comments"><p>{words(12)}</p></div></body>'


def test_path_scores_match_a_plain_version():
    for html in some_pages():
        blocks, _ = html_extract.blocks_of(html)
        paths = [b.element.path for b in blocks]
        value = {}
        for p in set(paths):
            own = [b for b in blocks if b.element.path == p]
            length = sum(len(b.text) - b.linked for b in own) / len(own)
            marks = sum(sum(b.text.count(c) for c in html_extract.PUNCTUATION) for b in own if b.linked < len(b.text)) / len(own)
            value[p] = math.log(1 + length) * (1 + math.log(1 + marks))
        weight = [math.exp(-0.5 * k * k) for k in range(-2, 3)]
        smooth = [sum(w * value[paths[min(len(paths) - 1, max(0, i + k))]] for w, k in zip(weight, range(-2, 3))) / sum(weight) for i in range(len(paths))]
        for score, b in zip(html_extract.path_scores(blocks).tolist(), blocks):
            own = [s for s, p in zip(smooth, paths) if p == b.element.path]
            assert math.isclose(score, sum(own) / len(own) * (0.1 if b.element.damped else 1), rel_tol=1e-9)


def test_paths_decide(monkeypatch):
    pages = list(some_pages())
    texts = [html_extract.main_text(x) for x in pages]
    assert all(x and "\n" in x for x in texts)
    rng = np.random.default_rng(1)
    monkeypatch.setattr(html_extract, "path_scores", lambda blocks, *_: rng.random(len(blocks)))
    assert sum(html_extract.main_text(x) != y for x, y in zip(pages, texts)) > 0.5 * len(pages)


@pytest.mark.parametrize("part", ["<div>x, y", "<script ", '<a "x ', '<a x="y> ', "<p>one, two", "<section></div>", "< "])
def test_time_is_linear_in_broken_pages(part):
    def took(n):
        began = time.process_time()
        html_extract.main_text(part * n)
        return time.process_time() - began

    took(1000)
    assert took(64_000) < 16 * max(0.05, took(8_000))


def test_extract_text_on_frames(spark):
    pages = spark.createDataFrame([(1, "u", "<p>hé  llo</p>"), (1, "u", "<p>hé  llo</p>"), (2, None, None), (None, "v", "x" * 200_000)], PAGE).withColumn("text", F.lit("old"))
    rows = html_extract.extract_text(pages).collect()
    assert sorted((r["page_id"] or -1, r["text"][:10], r["n_chars"]) for r in rows) == [(-1, "x" * 10, 200_000), (1, "hé llo", 6), (1, "hé llo", 6), (2, "", 0)]
    assert html_extract.extract_text(pages.limit(0)).collect() == []


def test_warc_round_trip(spark):
    rows = [(1, "http://a/", "<p>x</p>"), (2, "http://b/", "<p>x</p>"), (3, None, "é" * 10), (4, "http://c/", None), (5, "http://d/", ""), (6, "http://e/\nx", "z" * 3_000_000), (6, "http://e/\nx", "z" * 3_000_000), (None, "http://f/", "<p>x</p>")]
    pages = spark.createDataFrame(rows, PAGE).repartition(3)
    found = warc.round_trip(pages).collect()
    largest = {}
    for i, _, html in rows:
        largest[html or ""] = max(largest.get(html or "", -1), -1 if i is None else i)
    expected = collections.Counter()
    for i, _, html in rows:
        data, top = (html or "").encode(), largest[html or ""]
        expected[i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if i == top else "revisit", None if i == top else top] += 1
    assert collections.Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in found) == expected
    assert warc.round_trip(pages.limit(0)).collect() == []


def test_warc_frames_are_independent_and_the_bundle_is_plain_zstandard(spark, tmp_path):
    import zstandard

    pages = spark.createDataFrame([(i, f"http://x/{i}", f"<p>{i}</p>" + "abc " * 60_000) for i in range(12)], PAGE)
    folder = new_path(spark, "warc-test")
    index = warc.write_archive(pages, folder).collect()
    assert len({(r["bundle"], r["frame"]) for r in index}) > 2
    for r in index:
        path = f"{folder.removeprefix('file://')}/{r['bundle']}"
        whole = b"".join(zstandard.ZstdDecompressor().read_to_iter(open(path, "rb"), read_size=1 << 20)) if False else None
        data = open(path, "rb").read()[r["frame_at"] :]
        frame = zstandard.ZstdDecompressor().decompressobj().decompress(data)
        fields, _, payload, end = warc.parse(frame, r["record_at"])
        assert fields["WARC-Record-ID"] == f"<urn:page:{r['record_id']}>" and end - r["record_at"] == r["record_bytes"] and whole is None


def page_urls():
    rng = random.Random(2)
    hosts = ["example.org", "www.Example.org", "a.example.com", "x.net", "org", "com", "notexample.org"]
    paths = ["", "/", "/en/1", "/en/12", "/es/", "/es/x", "/de/1", "/fr/9/", "/fr/9"]
    tails = ["", "#f", "?utm_source=feed", "?b=2&a=1", "?a=1&b=2&ref=x"]
    urls = [f"{rng.choice(['http', 'HTTPS'])}://{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(tails)}" for _ in range(300)]
    return [*enumerate([*urls, None, "", "no scheme", "http://", "mailto:x@y", "http://x.net?q=://z"])]


def test_url_filter_matches_a_plain_version(spark):
    rows = page_urls()
    pages = spark.createDataFrame(rows, "page_id bigint, url string")
    listed = pages.where(F.contains("url", F.lit("utm_source")))

    def parts(url):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        cut = min([rest.index(c) for c in "/?#" if c in rest] or [len(rest)])
        host, tail = rest[:cut].lower(), rest[cut:]
        path = tail[: min([tail.index(c) for c in "?#" if c in tail] or [len(tail)])]
        query = tail.split("#", 1)[0].partition("?")[2]
        params = sorted(x for x in query.split("&") if x and not x.startswith(url_filter.TRACKING))
        return host, path, host.removeprefix("www.") + path.rstrip("/") + ("?" + "&".join(params) if params else "")

    names = {parts(u)[2] for _, u in rows if u and "utm_source" in u} - {""}
    for most in (url_filter.MOST_BLOCKS, 0):
        found = {r["page_id"]: r for r in url_filter.filter_urls(pages, listed, most_blocks=most).collect()}
        assert len(found) == len(rows)
        for i, url in rows:
            host, path, key = parts(url)
            fit = [r for r in url_filter.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
            rule = max(fit, key=lambda r: len(r.name)) if fit else None
            assert (found[i]["host"], found[i]["path"], found[i]["rule"]) == (host, path, rule and rule.name)
            assert found[i]["verdict"] == (rule.verdict if rule else "block" if key in names else "allow")
    assert {r["verdict"] for r in url_filter.filter_urls(pages.where("url like '%x.net%'"), listed.limit(0)).collect()} == {"allow"}
    assert url_filter.filter_urls(pages.limit(0), listed).collect() == []


def test_url_filter_runs_no_python(spark):
    pages = spark.createDataFrame(page_urls(), "page_id bigint, url string")
    plan = url_filter.filter_urls(pages, pages)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def brute(vectors, asks, k):
    out = []
    for q, x in vectors:
        if not asks(q):
            continue
        near = sorted((math.sqrt(sum((a - b) ** 2 for a, b in zip(y, x))), i) for i, y in vectors if i != q)[:k]
        out += [(q, rank + 1, i, round(s, 9)) for rank, (s, i) in enumerate(near)]
    return sorted(out)


def test_ann_matches_brute_force(spark):
    rng = np.random.default_rng(4)
    centre = rng.standard_normal((8, 32))
    good = [(i, (centre[i % 8] + 0.4 * rng.standard_normal(32)).astype(np.float32).astype(float).tolist()) for i in range(900)]
    good += [(900 + i, good[0][1]) for i in range(30)]  # copies: ties go to smaller ids
    bad = [(2000, None), (2010, []), (2020, [0.0] * 32), (2030, [float("nan")] * 32), (2040, [1.0] * 31 + [None]), (2050, [1.0, 2.0]), (2060, [float("inf")] + [0.0] * 31)]
    table = spark.createDataFrame(good + bad, "vec_id bigint, embedding array<float>").repartition(5)
    for settings in (ann.Settings(fit_rows=300), ann.Settings(fit_rows=300, cell_rows=80, chunk_rows=50, lot_rows=20, probes=None)):
        found = ann.search(table, F.col("vec_id") % 10 == 0, 10, settings=settings)
        got = sorted((r["query_id"], r["rank"], r["vec_id"], round(r["score"], 9)) for r in found.collect())
        expected = brute(good, lambda q: q % 10 == 0, 10)
        assert len(got) == len(expected) and len(set(got) & set(expected)) >= 0.99 * len(expected)
    assert ann.search(table.limit(0), F.lit(True)).collect() == []
    two = spark.createDataFrame(good[:2], "vec_id bigint, embedding array<float>")
    assert [(r["query_id"], r["vec_id"]) for r in ann.search(two, F.lit(True), 10).orderBy("query_id").collect()] == [(0, 1), (1, 0)]


def test_ann_recall_with_few_cells_probed(spark):
    rng = np.random.default_rng(6)
    centre = rng.standard_normal((60, 24))
    good = [(i, (centre[rng.integers(60)] + 0.3 * rng.standard_normal(24)).tolist()) for i in range(3000)]
    table = spark.createDataFrame(good, "vec_id bigint, embedding array<double>")
    found = ann.search(table, F.col("vec_id") % 20 == 0, 10, settings=ann.Settings(fit_rows=1000, cell_rows=100, probes=8))
    got = {(r["query_id"], r["vec_id"]) for r in found.collect()}
    expected = {(q, i) for q, _, i, _ in brute(good, lambda q: q % 20 == 0, 10)}
    recall = len(got & expected) / len(expected)
    print("recall of 8 of 30 cells:", recall)
    assert recall >= 0.9


def test_ann_bounds_hold_for_nearly_all_pairs():
    rng = np.random.default_rng(1)
    x, q = rng.standard_normal((500, 64)), rng.standard_normal((40, 64))
    coder = ann.Coder(x.mean(0), 3)
    low = ann.lower_bounds(coder, *coder.code(x), coder.rotated(q), 3.0)
    true = ((x[:, None] - q[None]) ** 2).sum(2)
    assert (low <= true + 1e-6).mean() > 0.995 and low.mean() > 0.3 * true.mean()
