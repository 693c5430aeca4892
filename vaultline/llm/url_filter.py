"""URL filter: path rules by host, and exact membership in a host list by a Bloom filter cascade.

Level 1 is a Bloom filter of the listed keys. Level 2 holds the keys of the corpus that level 1 takes for listed by
mistake, level 3 the listed keys that level 2 takes for such a mistake, and so on until a level makes none. As the
levels are built over every key the corpus has, a key's fate is exact: it is listed if the first level that refuses it
is an even one (or, if all accept, the number of levels is odd). Judging a page joins nothing; each level is one array
of bits that a scalar subquery yields. All of it is DataFrame functions.

The list, not the corpus, sets the size of the filters: level 1 has ``BITS_PER_KEY`` bits a listed key, each later level
so many for the mistakes before it, which shrink by a constant factor. ``max_keys`` bounds a cascade's levels. Keys that
need more are halved by hash until each part has a cascade within it; the pages of a part are judged by its cascade, one
part after the other, so that driver and tasks hold the filters of one part, however many keys are listed.

Defined results: a null url, or one without ``://``, has empty host and path, no rule, and is allowed unless the empty
host is listed; repeated rows are judged each; an empty table gives an empty result; an empty list blocks nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultline.llm.common import stored

#: Verdict, host and path of each rule.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BITS_PER_KEY = 12
PROBES = 6
MAX_KEYS = 5_000_000


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def best_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The longest fitting rule, as text, and its verdict; nulls if none fits."""
    rule = verdict = F.lit(None).cast("string")
    for says, domain, prefix in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(prefix)
        rule = F.when(fits, F.lit(domain + prefix)).otherwise(rule)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def probes(key: str | Column, level: int, words: int) -> list[tuple[Column, Column]]:
    """Word and bit of each probe of a key, by double hashing with a seed per level."""
    a, b = (F.xxhash64(key, F.lit(2 * level + k)).bitwiseAND(F.lit(2**31 - 1)) for k in (0, 1))
    at = [F.pmod(a + b * i, F.lit(64 * words)) for i in range(PROBES)]
    return [(F.shiftright(h, 6).cast("int"), h.bitwiseAND(F.lit(63)).cast("int")) for h in at]


def bloom(keys: DataFrame, level: int, words: int) -> DataFrame:
    """One row with the filter of ``keys`` as an array of 64-bit words."""
    pairs = F.array(*[F.struct(w.alias("word"), b.alias("bit")) for w, b in probes("key", level, words)])
    marks = keys.select(F.inline(pairs)).select("word", F.expr("shiftleft(1L, bit)").alias("bits"))
    blank = keys.sparkSession.range(words).select(F.col("id").cast("int").alias("word"), F.lit(0).cast("long").alias("bits"))
    dense = marks.unionByName(blank).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    ordered = F.sort_array(F.collect_list(F.struct("word", "bits")))
    return dense.agg(F.transform(ordered, lambda x: x["bits"]).alias("filter"))


def accepts(level: int, words: int, found: DataFrame, key: str | Column) -> Column:
    bits = found.scalar()
    out = F.lit(True)
    for word, bit in probes(key, level, words):
        out = out & (F.getbit(F.get(bits, word), bit) == 1)
    return out


Cascade = list[tuple[int, int, DataFrame]]
#: A cascade for the keys whose hash leaves ``remainder`` when divided by ``modulus``.
Part = tuple[int, int, Cascade]


class TooManyKeys(ValueError):
    """A level needs more than ``max_keys`` keys."""


def cascade(keys: DataFrame, max_keys: int = MAX_KEYS) -> Cascade:
    """The levels for ``keys``: every distinct ``key`` of the corpus, with ``listed``."""
    keys = stored(keys.select("key", "listed"), "url-keys")
    holds, others = keys.where("listed"), keys.where("not listed")
    levels: Cascade = []
    while n := holds.count():
        if n > max_keys:
            raise TooManyKeys(f"{n} keys in level {len(levels) + 1}; max_keys is {max_keys}")
        words = -(-n * BITS_PER_KEY // 64)
        levels.append((len(levels), words, stored(bloom(holds, len(levels), words), "url-filter")))
        mistaken = stored(others.where(accepts(*levels[-1], "key")), "url-mistakes")
        holds, others = mistaken, holds
    return levels


def in_part(key: str | Column, modulus: int, remainder: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(-1)), F.lit(modulus)) == remainder


def cascades(keys: DataFrame, max_keys: int = MAX_KEYS, modulus: int = 1, remainder: int = 0) -> list[Part]:
    """One cascade for ``keys`` if it stays within ``max_keys``, else those of its halves by hash."""
    try:
        return [(modulus, remainder, cascade(keys, max_keys))]
    except TooManyKeys:
        keys = stored(keys.select("key", "listed"), "url-part")
        halves = [(2 * modulus, remainder), (2 * modulus, remainder + modulus)]
        return [part for half in halves for part in cascades(keys.where(in_part("key", *half)), max_keys, *half)]


def member(levels: Cascade, key: str | Column) -> Column:
    """Whether a key of the corpus is listed: the first level that refuses decides."""
    out = F.lit(len(levels) % 2 == 1)
    for level in reversed(levels):
        out = F.when(accepts(*level, key), out).otherwise(F.lit(level[0] % 2 == 1))
    return out


def judged_hosts(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """Every host of ``pages``; listed are those with a page that a rule blocks."""
    host, path = url_parts(F.coalesce(F.col("url"), F.lit("")))
    found = pages.select(host.alias("key"), path.alias("path"))
    says = best_rule(F.col("key"), F.col("path"), rules)[1]
    return found.groupBy("key").agg(F.max(F.coalesce(says == "block", F.lit(False))).alias("listed"))


def url_filter(pages: DataFrame, levels: Cascade, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """One row per page: its longest rule's verdict, else block for a host that the cascade holds."""
    host, path = url_parts(F.coalesce(F.col("url"), F.lit("")))
    parts = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, says = best_rule(F.col("host"), F.col("path"), rules)
    listed = member(levels, "host")
    return parts.select(
        "page_id", "host", "path", rule.alias("rule"),
        F.coalesce(says, F.when(listed, "block").otherwise("allow")).alias("verdict"), listed.alias("host_listed"),
    )


def url_filter_parts(pages: DataFrame, parts: Sequence[Part], rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """``url_filter`` of all pages, those of each part by its cascade."""
    if len(parts) == 1:
        return url_filter(pages, parts[0][2], rules)
    host = url_parts(F.coalesce(F.col("url"), F.lit("")))[0]
    judged = [stored(url_filter(pages.where(in_part(host, m, r)), levels, rules), "url-judged") for m, r, levels in parts]
    return reduce(DataFrame.unionByName, judged)
