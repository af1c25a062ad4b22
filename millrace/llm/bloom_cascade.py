"""URL filter by a Bloom filter cascade.

A cascade answers "is this key on the list?" without a join and without error
for every key of a known universe.  Level 0 is a Bloom filter over the listed
keys; level 1 one over the unlisted keys of the universe that level 0 lets
through; level 2 one over the listed keys that level 1 lets through, and so on
until no false positive is left.  A key is listed when the first level that
turns it away is an odd one, or when it passes all of an odd number of levels.

The universe is every (host suffix, path prefix) of the corpus that has the
shape of some list entry, so the answer is exact for every url of the corpus.

The levels travel with the plan as constant arrays.  A list of more than
``keys_per_cascade`` keys is cut by hash into parts, each with its own cascade
over the whole universe and a pass of its own over the pages, staged before the
next part is built: what one pass broadcasts stays below ``keys_per_cascade``
times some 20 bits, whatever the length of the list.

Defined cases: a null url, or one without ``://``, has an empty host and path
and fits no entry; an empty list gives an empty cascade, which lists nothing;
null keys are never listed; repeated pages are judged each on its own; columns
other than page_id and url are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import ascii_lower
from millrace.session import stage

WORD = 64


@dataclass(frozen=True)
class Level:
    """One Bloom filter: ``bits`` positions in 64-bit ``words``, ``hashes`` of them set for a key."""

    number: int
    bits: int
    hashes: int
    words: tuple[int, ...]


def _positions(key: Column, number: int, bits: int, hashes: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(number * 64 + j)), F.lit(bits)) for j in range(hashes)]


def _fits(key: Column, level: Level) -> Column:
    words = F.split(F.lit(",".join(map(str, level.words))), ",").cast("array<bigint>")
    found = None
    for at in _positions(key, level.number, level.bits, level.hashes):
        word = F.get(words, F.floor(at / F.lit(WORD)).cast("int"))
        bit = F.getbit(word, (at % WORD).cast("int")) == 1
        found = bit if found is None else found & bit
    return found


def listed(key: Column, levels: list[Level]) -> Column:
    """Whether the cascade lists ``key``; exact for keys of its universe."""
    verdict = F.lit(len(levels) % 2 == 1)
    for level in reversed(levels):
        verdict = F.when(_fits(key, level), verdict).otherwise(F.lit(level.number % 2 == 1))
    return F.coalesce(verdict, F.lit(False)) & key.isNotNull()


def _filter_over(keys: DataFrame, number: int, size: int, rate: float) -> Level:
    hashes = max(1, min(30, round(-math.log2(rate))))
    bits = WORD * max(1, math.ceil(size * -math.log(rate) / math.log(2) ** 2 / WORD))
    at = keys.select(F.explode(F.array(*_positions(F.col("key"), number, bits, hashes))).alias("at"))
    words = (
        at.groupBy(F.floor(F.col("at") / WORD).alias("word"))
        .agg(F.bit_or(F.expr(f"shiftleft(1L, cast(at % {WORD} as int))")).alias("value"))
        .collect()  # at most bits / 64 rows
    )
    filled = [0] * (bits // WORD)
    for row in words:
        filled[row.word] = row.value
    return Level(number, bits, hashes, tuple(filled))


def build_cascade(universe: DataFrame) -> list[Level]:
    """Levels for a table of distinct ``key`` with a boolean ``wanted``.

    False-positive rates are those of the published analysis of such cascades:
    listed / (sqrt(2) * unlisted) at level 0, one half after it.
    """
    counts = universe.agg(F.count_if("wanted").alias("yes"), F.count_if(~F.col("wanted")).alias("no")).first()
    encoded, tested = universe.where("wanted").select("key"), universe.where(~F.col("wanted")).select("key")
    size, rate = counts.yes, max(1e-9, min(0.5, counts.yes / (math.sqrt(2) * max(1, counts.no))))
    levels: list[Level] = []
    while size:
        level = _filter_over(encoded, len(levels), size, rate)
        levels.append(level)
        encoded, tested = tested.where(_fits(F.col("key"), level)), encoded
        size, rate = encoded.count(), 0.5
    return levels


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    host = F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1)
    path = F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return F.coalesce(ascii_lower(host), F.lit("")), F.coalesce(path, F.lit(""))


def _candidates(host: Column, path: Column, shapes: list[tuple[int, int]]) -> list[Column]:
    return [
        F.when((host != "") & (F.length(path) >= n), F.concat(F.substring_index(host, ".", -labels), F.left(path, F.lit(n))))
        for labels, n in shapes
    ]


def longest_listed(
    pages: DataFrame, entries: DataFrame, into: str, keys_per_cascade: int = 200_000
) -> DataFrame:
    """``pages`` with ``into``: the longest entry that fits the page's ``host`` and ``path``, else null.

    ``entries`` has ``host`` and ``path``; an entry fits its host and all
    subdomains, when the page's path starts with the entry's.
    """
    keys = stage(
        entries.where("host <> '' and path is not null")
        .select(
            F.concat("host", "path").alias("key"),
            F.size(F.split("host", "[.]")).alias("labels"),
            F.length("path").alias("n"),
        )
        .distinct(),
        "cascade-list",
    )
    # Shapes are bounded by the 253 characters of a host name and the paths in use.
    shapes = [tuple(r) for r in keys.select("labels", "n").distinct().collect()]
    held = keys.count()
    out = pages.withColumn(into, F.lit(None).cast("string"))
    if not held:
        return out
    at = pages.groupBy("host", F.left("path", F.lit(max(n for _, n in shapes))).alias("path")).count()
    seen = at.select(F.explode(F.array_compact(F.array(*_candidates(F.col("host"), F.col("path"), shapes)))).alias("key"))
    seen = stage(seen.distinct(), "cascade-universe")
    parts = math.ceil(held / keys_per_cascade)
    for part in range(parts):
        own = keys.where(F.pmod(F.xxhash64("key"), F.lit(parts)) == part).select("key", F.lit(True).alias("w"))
        universe = seen.join(own, "key", "left").select("key", F.coalesce("w", F.lit(False)).alias("wanted"))
        levels = build_cascade(stage(universe, "cascade-keys"))
        ranked = [
            F.when(listed(c, levels), F.struct(F.length(c).alias("n"), c.alias("key")))
            for c in _candidates(F.col("host"), F.col("path"), shapes)
        ]
        best = F.array_max(F.array(*ranked))["key"]
        kept = F.col(into)
        out = out.withColumn(into, F.when(kept.isNull() | (F.length(best) > F.length(kept)), best).otherwise(kept))
        if parts > 1:
            out = stage(out, "cascade-pass")
    return out


def hosts_with_words(pages: DataFrame, words: tuple[str, ...]) -> DataFrame:
    """Block-list entries: domains of which a ``-``-separated label part is one of ``words``.

    Taken from the distinct hosts; the entry starts at the label, so that it
    covers all subdomains of the named domain.
    """
    part = "|".join(words)
    name = F.regexp_extract("host", rf"(?:^|\.)((?:[^.]*-)?(?:{part})(?:-[^.]*)?(?:\..*)?)$", 1)
    hosts = pages.select("host").distinct()
    return hosts.select(name.alias("host"), F.lit("/").alias("path")).where("host <> ''").distinct()


def judge_urls(
    pages: DataFrame,
    rules: list[tuple[str, str, str]],
    words: tuple[str, ...],
    keys_per_cascade: int = 200_000,
) -> DataFrame:
    """page_id, host, path, rule, verdict and listed_host for every page.

    ``rules`` are (host, path, allow or block); the longest that fits decides.
    Else the method does: a page is blocked when its host is on, or below, a
    domain of the word-derived block list.  Each list is held by cascades.
    """
    host, path = host_and_path(F.col("url"))
    spark = pages.sparkSession
    out = pages.select("page_id", host.alias("host"), path.alias("path"))
    entries = spark.createDataFrame(rules, "host string, path string, verdict string")
    names = hosts_with_words(out, words)
    for verdict in ("allow", "block"):
        out = longest_listed(out, entries.where(F.col("verdict") == verdict), f"_{verdict}", keys_per_cascade)
    at_host = out.withColumn("_path", F.col("path")).withColumn("path", F.lit("/"))
    out = longest_listed(at_host, names, "listed_host", keys_per_cascade).withColumn("path", F.col("_path"))
    blocked = F.coalesce(F.length("_block"), F.lit(0)) > F.coalesce(F.length("_allow"), F.lit(0))
    rule = F.when(blocked, F.col("_block")).otherwise(F.col("_allow"))
    verdict = F.when(blocked | (rule.isNull() & F.col("listed_host").isNotNull()), "block").otherwise("allow")
    return out.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"), "listed_host")
