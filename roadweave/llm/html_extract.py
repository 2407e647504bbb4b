"""Main text of web pages by tag-path ratios.

A page is cut into blocks, runs of text between block-level tags, each with its root-to-leaf path of block tags and, of
container tags, their classes. Elements that by their very tag, role or state are no article (navigation, forms, asides,
hidden parts) are left out first. Then
1. of each path text length and punctuation per block are aggregated (unlinked text) and fused; the values are smoothed over
   the page's block sequence, averaged again over each path, and damped where a class or id speaks of adverts, comments and the like.
2. blocks whose path reaches a share of the scores' standard deviation are content. The deepest element that holds most of it
   is where the article is: the article or main element around it, else it grows while all that is added is content.
3. inside, content stays; so do headings before content and list items, cells and captions after it, whatever their path.

One narrow pass over the pages, no shuffle; time grows with a page's length (elements deeper than 512 count as that deep),
memory is bounded by a slice of pages or the longest page.
"""

from __future__ import annotations

import re
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, slices

# Element names of HTML and the words that sites use to name regions.
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template".split())
DROPPED = frozenset("head nav footer aside form fieldset select button menu dialog svg math canvas object audio video map label".split())
CLOSES_P = BLOCK - frozenset("body head html option optgroup title caption".split())
SAME_KIND = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "p": ("p",)}
SCOPE = frozenset("table ul ol dl div section article main body td th blockquote".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
ITEM = frozenset("li dt dd td th caption figcaption pre summary".split())
CONTAINER = frozenset("address body center details div dl fieldset hgroup html main article ol section table tbody ul".split())
REGION_WORDS = frozenset("ad ads adv adbox adsense banner promo promotion sponsor sidebar sidebars menu menus nav navbar navigation breadcrumb breadcrumbs footer masthead topbar cookie cookies consent gdpr notice notices alert alerts popup modal overlay newsletter subscribe subscription signup login social share sharing related recommended recommendations comment comments commentlist reply replies respond disqus pagination pager toolbar widget widgets copyright disclaimer skip hidden".split())
REGION_STARTS = ("advert", "sponsor", "comment", "breadcrumb", "cookie", "newsletter")
REGION_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
PUNCTUATION = ".,;:!?…。、，；：！？"

NO_MARKS = dict.fromkeys(map(ord, PUNCTUATION))
NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
INSIDE_TAG = re.compile(r""">|=\s*(["'])""")
ATTRIBUTE = re.compile(r"""(?:^|(?<=[\s"']))(class|id|role|style|aria-hidden|hidden)(?=[\s=]|$)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
END_OF = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW}
DEEPEST = 512


class Element:
    __slots__ = ("tag", "parent", "path", "dropped", "depth", "damped", "declared", "first", "last", "mass")

    def __init__(self, tag: str, parent: Element | None, path: int, dropped: bool, damped: bool):
        self.tag, self.parent, self.path, self.dropped, self.damped = tag, parent, path, dropped, damped
        self.depth = parent.depth + 1 if parent else 0
        # the article or main element that this is or lies in
        self.declared = self if tag == "article" or tag == "main" and not (parent and parent.declared) else parent.declared if parent else None
        self.first, self.last, self.mass = -1, -1, 0.0


class Block:
    """A run of text (white space made one blank) with its innermost block element, linked characters and punctuation marks."""

    __slots__ = ("text", "element", "linked", "marks")

    def __init__(self, text: str, element: Element, linked: int):
        self.text, self.element, self.linked = text, element, min(linked, len(text))
        self.marks = len(text) - len(text.translate(NO_MARKS))


def states(attributes: str) -> tuple[bool, bool, str]:
    """Whether an element says that it is no part of an article; whether its class or id hints at that; class and id without digits."""
    declared, hinted, names = False, False, []
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        declared |= name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and "display:none" in value.replace(" ", "") or name == "role" and value in REGION_ROLES
        if name in ("class", "id"):
            names.append(re.sub(r"\d+", "", value))
            hinted |= any(x in REGION_WORDS or x.startswith(REGION_STARTS) for x in re.split(r"[\s_-]+", value))
    return declared, hinted, " ".join(names)


def tag_end(html: str, at: int) -> int:
    """Behind the `>` that ends the tag which is open at `at`, quoted values passed over; -1 if there is none."""
    while m := INSIDE_TAG.search(html, at):
        if m[0] == ">":
            return m.end()
        close = html.find(m[1], m.end())
        at = close + 1 if close >= 0 else m.end()  # an unclosed quote is a character like any other
    return -1


def blocks_of(html: str) -> tuple[list[Block], list[Element]]:
    """The blocks of a page outside declared regions, and its elements, parents first."""
    paths: dict[tuple[int, str], int] = {}
    top = Element("", None, 0, False, False)
    stack, elements, is_open = [top], [top], {}
    blocks: list[Block] = []
    run: list[str] = []
    links, inside_link = 0, False

    def flush():
        nonlocal links
        text = " ".join(unescape("".join(run)).split())
        if text and not stack[-1].dropped:
            blocks.append(Block(text, stack[-1], links))
        run.clear()
        links = 0

    def close(upto: int):
        for x in stack[upto:]:
            is_open[x.tag] -= 1
        del stack[upto:]

    at, n = 0, len(html)
    last_quote = max(html.rfind('"'), html.rfind("'"))
    last_end = html.rfind(">")
    while at < n:
        start = html.find("<", at)
        piece = html[at : start if start >= 0 else n]
        if piece:
            run.append(piece)
            links += len(piece) if inside_link else 0
        if start < 0:
            break
        if html.startswith("<!--", start):
            end = html.find("-->", start + 4)
            at = end + 3 if end >= 0 else n
            continue
        m = NAME.match(html, start)
        if start > last_end or not m and html[start + 1 : start + 2] not in ("!", "?", "/"):
            run.append("<")  # no tag
            at = start + 1
            continue
        if not m:
            at = html.find(">", start) + 1
            continue
        at = tag_end(html, m.end()) if m.end() <= last_quote else html.find(">", m.end()) + 1
        if at <= 0:
            break  # the page ends within a tag
        ending, tag, attributes = html[start + 1] == "/", m[1].lower(), html[m.end() : at - 1]
        if tag in RAW:
            if not ending and not attributes.rstrip().endswith("/"):
                end = END_OF[tag].search(html, at)
                at = end.end() if end else n
            if tag in BLOCK:
                flush()
            continue
        if tag == "br":
            run.append(" ")
        elif tag == "a":
            inside_link = not ending
        if tag not in BLOCK and tag not in DROPPED:
            continue
        flush()
        if ending:
            if is_open.get(tag):
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag == tag:
                        close(i)
                        break
                    if stack[i].tag in ("article", "main", "body") and tag in ("p", "li", "div", "span"):
                        break  # a stray end tag doesn't leave the article
            continue
        kinds = SAME_KIND.get(tag, ()) + (("p",) if tag in CLOSES_P else ())
        if any(is_open.get(x) for x in kinds):
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in kinds:
                    close(i)
                    break
                if stack[i].tag in SCOPE:
                    break
        if tag in VOID:
            continue
        if len(stack) > DEEPEST:
            close(DEEPEST)
        above = stack[-1]
        declared, hinted, names = states(attributes) if attributes else (False, False, "")
        dropped = above.dropped or declared or tag in DROPPED or tag == "header" and not above.declared
        damped = above.damped or hinted and tag not in ("html", "body", "article", "main")
        key = (above.path, f"{tag} {names}" if tag in CONTAINER else tag)
        if attributes.rstrip().endswith("/") and tag in DROPPED:
            continue
        stack.append(Element(tag, above, paths.setdefault(key, len(paths) + 1), dropped, damped))
        elements.append(stack[-1])
        is_open[tag] = is_open.get(tag, 0) + 1
    flush()
    return blocks, elements


def path_scores(blocks: list[Block], smooth: float = 1.0, damp: float = 0.1) -> np.ndarray:
    """Of each block the score of its path: ln(length a block) * (1 + ln(punctuation a block)), smoothed over the blocks, averaged over the path, damped if its names hint at another region."""
    path = np.unique([b.element.path for b in blocks], return_inverse=True)[1]
    n = np.bincount(path)
    length = np.bincount(path, [len(b.text) - b.linked for b in blocks]) / n
    marks = np.bincount(path, [b.marks if b.linked < len(b.text) else 0 for b in blocks]) / n
    value = (np.log1p(length) * (1 + np.log1p(marks)))[path]
    reach = max(1, round(2 * smooth))
    weight = np.exp(-0.5 * (np.arange(-reach, reach + 1) / smooth) ** 2)
    near = np.convolve(np.pad(value, reach, mode="edge"), weight / weight.sum(), mode="valid")
    return (np.bincount(path, near) / n)[path] * np.where([b.element.damped for b in blocks], damp, 1.0)


def article_of(blocks: list[Block], elements: list[Element], score: np.ndarray, chosen: np.ndarray, most: float, alike: float) -> Element:
    """The element that is the article."""
    for i, b in enumerate(blocks):
        e = b.element
        e.first = i if e.first < 0 else e.first
        e.last = i
        e.mass += (len(b.text) - b.linked + 1) if chosen[i] else 0
    for e in reversed(elements):
        if e.parent and e.first >= 0:
            up = e.parent
            up.mass += e.mass
            up.first = e.first if up.first < 0 else min(up.first, e.first)
            up.last = max(up.last, e.last)
    total = elements[0].mass
    inline = HEADING | {"p", "li", "td", "th", "tr"}
    found = max((e for e in elements if e.mass >= most * total and e.tag not in inline and e.first >= 0), key=lambda e: e.depth)
    if found.declared:
        return found.declared
    while found.parent and found.parent.tag not in ("", "html", "body"):
        up = found.parent
        mean = score[found.first : found.last + 1].mean()
        added = [*range(up.first, found.first), *range(found.last + 1, up.last + 1)]
        if not all(blocks[i].element.tag in HEADING or chosen[i] and score[i] >= alike * mean for i in added):
            break
        found = up
    return found


def main_text(html: str | None, smooth: float = 1.0, threshold: float = 0.5, most: float = 0.8, alike: float = 0.4) -> str:
    """The article's blocks in page order, joined by line feeds; empty if there are none.

    threshold: share of the standard deviation of the scores that a block's path needs. most: share of the content that the
    article's element holds at least before it grows. alike: share of its mean score that what it grows by needs.
    """
    blocks, elements = blocks_of(html or "")
    if not blocks:
        return ""
    score = path_scores(blocks, smooth)
    chosen = score >= min(threshold * score.std(), score.max())
    article = article_of(blocks, elements, score, chosen, most, alike)
    inside = range(article.first, article.last + 1)
    marks: dict[int, int] = {}
    for i in inside:
        marks[blocks[i].element.path] = marks.get(blocks[i].element.path, 0) + blocks[i].marks
    has_marks = any(marks.values())
    # text of a bare container without a single mark, beside text with some, is a caption of something else
    content = [i for i in inside if chosen[i] and not (blocks[i].element.tag in ITEM | HEADING or blocks[i].element.tag in CONTAINER and has_marks and not marks[blocks[i].element.path])]
    first, last = (content[0], content[-1]) if content else (article.first, article.last)
    stays, out = set(content), []
    for i in inside:
        b = blocks[i]
        other = b.element.damped and not article.damped
        listed = b.element.tag in ITEM and not other and (i > first or b.linked < 0.9 * len(b.text))
        heads = b.element.tag in HEADING and not other and i < last
        if i in stays or listed or heads or not content and chosen[i]:
            out.append(b.text)
    return "\n".join(out)


def extract_text(pages: DataFrame, html: str = "html", out: str = "text") -> DataFrame:
    """pages with the main text (empty if there is none) and n_chars, its code points. The html column is dropped.

    Null html counts as empty. Broken markup never fails: unclosed elements end with the page, unbalanced quotes with
    the next `>`. Repeated rows give repeated results; input columns named like an added one are replaced.
    """
    rest = [c for c in pages.columns if c not in (html, out, "n_chars")]
    base = pages.select(*(F.col(f"`{c}`") for c in [*rest, html]))
    schema = ", ".join([*(f"`{c}` {base.schema[c].dataType.simpleString()}" for c in rest), f"`{out}` string", "n_chars bigint"])

    def run(batches):
        for batch in batches:
            for part in slices(batch, html):
                texts = [main_text(x) for x in part[html].to_pylist()]
                yield pa.RecordBatch.from_arrays([*(part[c] for c in rest), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=[*rest, out, "n_chars"])

    return base.mapInArrow(lean(run), schema)
