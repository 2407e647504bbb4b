"""URL filter: rules first, then a blocked Bloom filter in front of an exact join with the listed URLs. DataFrame operations only.

The filter has blocks of four 64-bit words; a URL sets one bit in each word of one block. It is built by an aggregate
(bit_or by block) and is a small table of a size that the number of listed URLs fixes in advance. A URL whose bits aren't
all set is not listed, for certain; the others meet the list itself in a hash join on the canonical URL, so false
positives go. Pages that the filter lets pass never enter that join.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Listed URLs for each block of 256 bits: 16 bits a URL.
URLS_A_BLOCK = 16
#: A filter with more blocks than this (about 40 bytes each) is joined by shuffle instead of broadcast.
MOST_BLOCKS = 1 << 20
#: Query parameters that name a visit and not a document. Fixed values.
TRACKING = ("utm_", "ref=", "fbclid=", "gclid=")


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1"), Rule("allow", "com", "/fr/"), Rule("block", "com", "/de/"))


def ascii_lower(x: Column) -> Column:
    return F.translate(x, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_rest(url: str) -> Column:
    """What follows the first `://`; empty if there is none or the url is null."""
    return F.expr(f"case when instr(`{url}`, '://') > 0 then substring(`{url}`, instr(`{url}`, '://') + 3) else '' end")


def host_of(rest: Column) -> Column:
    return ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0))


def path_of(rest: Column) -> Column:
    return F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def canonical(rest: Column) -> Column:
    """One spelling of a URL: host without www., path without closing slashes, parameters sorted and without those of TRACKING; no scheme, no fragment."""
    query = F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1)

    def telling(x: Column) -> Column:
        out = x != ""
        for start in TRACKING:
            out = out & ~F.startswith(x, F.lit(start))
        return out

    params = F.array_sort(F.filter(F.split(query, "&"), telling))
    return F.concat(F.regexp_replace(host_of(rest), r"^www\.", ""), F.regexp_replace(path_of(rest), "/+$", ""), F.when(F.size(params) > 0, F.concat(F.lit("?"), F.array_join(params, "&"))).otherwise(""))


def fits(rule: Rule, host: Column, path: Column) -> Column:
    return ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))


def first_rule(rules: Sequence[Rule], host: Column, path: Column, value) -> Column:
    """value of the longest rule that fits (of equals the first by name); null if none does."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), [-ord(c) for c in r.name])):
        out = F.when(fits(rule, host, path), F.lit(value(rule))).otherwise(out)
    return out


def _bits(key: Column, blocks: int) -> tuple[Column, list[Column]]:
    """Block of a canonical URL and one bit for each of its four words."""
    h, g = F.xxhash64(key), F.xxhash64(F.lit(1), key)
    return F.pmod(h, F.lit(blocks)), [F.call_function("shiftleft", F.lit(1).cast("bigint"), F.call_function("shiftrightunsigned", g, F.lit(6 * i)).bitwiseAND(F.lit(63)).cast("int")) for i in range(4)]


def bloom_filter(listed: DataFrame, key: str, n: int) -> tuple[DataFrame, int]:
    """(block, w0..w3) of the blocks that hold a bit, and the number of blocks."""
    blocks = max(1, -(-n // URLS_A_BLOCK))
    block, bits = _bits(F.col(key), blocks)
    return listed.select(block.alias("block"), *(b.alias(f"b{i}") for i, b in enumerate(bits))).groupBy("block").agg(*(F.bit_or(f"b{i}").alias(f"w{i}") for i in range(4))), blocks


def filter_urls(pages: DataFrame, listed: DataFrame, url: str = "url", listed_url: str = "url", rules: Sequence[Rule] = RULES, most_blocks: int = MOST_BLOCKS) -> DataFrame:
    """pages with host, path, rule (longest that fits, else null), listed (canonical URL is on the list) and verdict.

    verdict is the rule's, else block if listed and allow if not. A null url or one without `://` has empty host and path,
    fits no rule, is never listed and thus allowed. An empty list lists nothing; null URLs on it are skipped. Rows repeat as
    in pages. Input columns named like an added one are replaced.
    """
    added = ["host", "path", "rule", "listed", "verdict"]
    rest = url_rest(url)
    base = pages.select(*(F.col(f"`{c}`") for c in pages.columns if c not in added or c == url), host_of(rest).alias("_host"), path_of(rest).alias("_path"), canonical(rest).alias("_key"))
    names = listed.select(canonical(url_rest(listed_url)).alias("_listed")).where("_listed <> ''").distinct()
    names = stored(names, "url-list")
    n = names.count()
    words, blocks = bloom_filter(names, "_listed", n)
    if blocks <= most_blocks:
        words = F.broadcast(words)
    block, bits = _bits(F.col("_key"), blocks)
    probed = base.withColumn("_block", block).join(words, F.col("_block") == F.col("block"), "left")
    maybe = F.col("_key") != ""
    for i, bit in enumerate(bits):
        maybe = maybe & F.coalesce(F.col(f"w{i}").bitwiseAND(bit) == bit, F.lit(False))
    # both sides keep their rows narrow: nothing is looked up again by page
    probed = probed.withColumn("_maybe", maybe).drop("_block", "block", *(f"w{i}" for i in range(4)))
    passed = probed.where(~F.col("_maybe")).withColumn("listed", F.lit(False))
    hits = probed.where("_maybe").join(names, F.col("_key") == F.col("_listed"), "left").withColumn("listed", F.col("_listed").isNotNull()).drop("_listed")
    out = passed.unionByName(hits)
    host, path = F.col("_host"), F.col("_path")
    rule = first_rule(rules, host, path, lambda r: r.name)
    verdict = F.coalesce(first_rule(rules, host, path, lambda r: r.verdict), F.when(F.col("listed"), "block").otherwise("allow"))
    return out.select(*(F.col(f"`{c}`") for c in pages.columns if c not in added), host.alias("host"), path.alias("path"), rule.alias("rule"), "listed", verdict.alias("verdict"))
