"""Benchmark decontamination: a broadcast hash set of test n-grams over training windows.

Words are A-Z lower-cased runs of ``WORD`` characters.  A benchmark item of ``window`` words
or more gives all its windows of that length; a shorter one is one window.

A window of m words holds, wherever it starts, one whole block of
b = (m + 1) // 2 words that begins at a multiple of b.  So the scan hashes only
every b-th position of a document and looks it up in the broadcast set of the
blocks that windows can show there.  A hit hands on the few words around it;
their windows are then compared by text, which also rules hash collisions out.
The document's text is read once and never shuffled.

The set is broadcast in parts of at most ``BROADCAST_BLOCKS`` hashes; a larger
benchmark takes one pass a part.

Defined cases: null and empty texts have no words and no hits; null or empty
items give no window; repeated items are one window each with their own ids;
rows are told apart by doc_id and text, so that null or repeated ids do not mix
their hits; exactly repeated rows each get the same result; columns other than
the id and the text are ignored, and kept by ``remove_contaminated``.
"""

from __future__ import annotations

import math
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from millrace.llm.common import ascii_lower, pack, unpack
from millrace.session import stage

#: Between words: ASCII without letters and digits.  (Before lower-casing.)
GAPS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BROADCAST_BLOCKS = 2_000_000


def split_words(text: Column) -> Column:
    """The words of a text, case kept."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAPS), "")


def _block_hash(words: Column, b: int) -> Column:
    # lower() may fold more than A-Z; that only adds candidates.  Odd: zero is free for the row mark.
    return F.xxhash64(F.lower(F.array_join(words, " ")), F.lit(b)).bitwiseOR(F.lit(1))


def _block(words: Column, b: int, k: Column) -> Column:
    own = F.slice(words, k * b + 1, F.lit(b))
    return F.struct(F.lit(b).alias("b"), (k * b).alias("k"), _block_hash(own, b).alias("h"))


def item_windows(benchmark: DataFrame, window: int) -> tuple[DataFrame, DataFrame]:
    """(wid, m, gram) for distinct windows, and (wid, item_id)."""
    words = F.transform(split_words(F.col("text")), ascii_lower)
    items = benchmark.select("item_id", words.alias("words")).where("size(words) > 0")
    size = F.least(F.size("words"), F.lit(window))
    starts = F.sequence(F.lit(1), F.size("words") - size + 1)
    cut = items.select("item_id", "words", size.alias("m"), F.explode(starts).alias("at"))
    grams = cut.select("item_id", "m", F.array_join(F.slice("words", F.col("at"), F.col("m")), " ").alias("gram"))
    grams = stage(grams.distinct(), "item-grams")
    windows = stage(grams.select("m", "gram").distinct().withColumn("wid", F.monotonically_increasing_id()), "windows")
    return windows, stage(grams.join(windows, ["m", "gram"]).select("wid", "item_id"), "window-items")


def _blocks(windows: DataFrame) -> DataFrame:
    b = F.floor((F.col("m") + 1) / 2).cast("int")
    at = windows.select(F.split("gram", " ").alias("words"), b.alias("b")).withColumn(
        "o", F.explode(F.sequence(F.lit(1), F.col("b")))
    )
    part = F.slice("words", F.col("o"), F.col("b"))
    return at.select(F.xxhash64(F.lower(F.array_join(part, " ")), F.col("b")).bitwiseOR(F.lit(1)).alias("h")).distinct()


def _scan(docs: DataFrame, sizes: list[int], blocks: DataFrame, mark_rows: bool) -> DataFrame:
    """One row a document (b = 0, with n_words), and one a block hit with the words around it."""
    longest = {}
    for m in sizes:
        longest[(m + 1) // 2] = max(m, longest.get((m + 1) // 2, 0))
    words, n = F.col("_words"), F.size("_words")
    found = [F.array(F.struct(F.lit(0).alias("b"), F.lit(0).alias("k"), F.lit(0).cast("bigint").alias("h")))] if mark_rows else []
    for b in longest:
        starts = F.when(n >= b, F.sequence(F.lit(0), F.floor(n / b).cast("int") - 1)).otherwise(F.array().cast("array<int>"))
        found.append(
            F.transform(starts, partial(_block, words, b))
        )
    # explode() would add a test of the array's size below, and work the split out again for every block.
    rows = docs.withColumn("_all", F.concat(*found)).withColumn("_at", F.explode_outer("_all")).drop("_all")
    rows = rows.withColumn("_h", F.col("_at.h"))
    known = blocks.select(F.col("h").alias("_known"))
    if mark_rows:
        known = known.union(known.sparkSession.range(1).select(F.col("id").alias("_known")))
    rows = rows.join(F.broadcast(known), F.col("_h") == F.col("_known"))
    b, k = F.col("_at.b"), F.col("_at.k")
    first = F.greatest(k - b + 1, F.lit(0))
    reach = F.lit(0)
    for size, m in longest.items():
        reach = F.when(b == size, m).otherwise(reach)
    return rows.select(
        "_id", "_row", n.alias("n_words"), b.alias("b"), first.alias("first"), k.alias("k"),
        F.when(b > 0, F.slice(words, first + 1, k - first + reach)).alias("near"),
    )


def window_hits(
    docs: DataFrame, benchmark: DataFrame, window: int, doc_id: str = "doc_id", text: str = "text"
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows with n_words; hits: row, start, m, wid; window_items).  Starts are word positions from 0."""
    windows, items = item_windows(benchmark, window)
    sizes = sorted(r.m for r in windows.select("m").distinct().collect())  # at most ``window`` values
    # The text's own hash tells rows of one doc_id apart.
    base = docs.select(F.col(doc_id).alias("_id"), F.xxhash64(text).alias("_row"), split_words(F.col(text)).alias("_words"))
    blocks = stage(_blocks(windows), "blocks")
    parts = max(1, math.ceil(blocks.count() / BROADCAST_BLOCKS))
    scanned = None
    for part in range(parts):
        own = blocks.where(F.pmod("h", F.lit(2 * parts)) == 2 * part + 1) if parts > 1 else blocks
        more = _scan(base, sizes, own, mark_rows=part == 0)
        scanned = more if scanned is None else scanned.union(more)
    scanned = stage(scanned, "scan")
    rows = scanned.where("b = 0").select("_id", "_row", "n_words")
    near = scanned.where("b > 0").withColumn("m", F.explode(F.array(*[F.lit(m) for m in sizes] or [F.lit(0)])))
    near = near.where(F.floor((F.col("m") + 1) / 2) == F.col("b")).withColumn(
        "start", F.explode(F.sequence(F.col("first"), F.col("k")))
    )
    gram = F.array_join(F.transform(F.slice("near", F.col("start") - F.col("first") + 1, F.col("m")), ascii_lower), " ")
    near = near.where(F.col("start") + F.col("m") <= F.col("n_words")).select("_id", "_row", "start", "m", gram.alias("gram"))
    hits = near.join(windows, ["m", "gram"]).select("_id", "_row", "start", "m", "wid").distinct()
    return rows, stage(hits, "hits"), items


def _covered(hits: DataFrame) -> DataFrame:
    """Hit words per row: each window adds what no earlier one has covered."""
    end = F.col("start") + F.col("m")
    spans = hits.groupBy("_id", "_row", "start").agg(F.max(end).alias("end"))
    before = F.max("end").over(W.partitionBy("_id", "_row").orderBy("start").rowsBetween(W.unboundedPreceding, -1))
    fresh = F.col("end") - F.greatest("start", F.least(F.coalesce("before", F.lit(0)), F.col("end")))
    return spans.withColumn("before", before).groupBy("_id", "_row").agg(F.sum(fresh).alias("n_hit"))


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row a document: its id, text_hash, n_words, n_hit, n_items, items_sha256, contaminated."""
    rows, hits, window_items = window_hits(docs, benchmark, window, doc_id, text)
    pairs = hits.select("_id", "_row", "wid").distinct().join(window_items, "wid").select("_id", "_row", "item_id").distinct()
    names = F.array_join(F.array_sort(F.collect_list(F.col("item_id").cast("string"))), ",")
    named = pairs.groupBy("_id", "_row").agg(F.count("*").alias("n_items"), names.alias("names"))
    per_row = _covered(hits).join(named.withColumnsRenamed({"_id": "_i", "_row": "_r"}), F.expr("_id <=> _i and _row = _r")).select(
        F.col("_id").alias("_i"), F.col("_row").alias("_r"), "n_hit", "n_items", "names"
    )
    out = rows.join(per_row, F.expr("_id <=> _i and _row = _r"), "left")
    zero = F.lit(0).cast("bigint")
    return out.select(
        F.col("_id").alias(doc_id),
        F.col("_row").alias("text_hash"),
        F.col("n_words").cast("bigint").alias("n_words"),
        F.coalesce("n_hit", zero).alias("n_hit"),
        F.coalesce("n_items", zero).alias("n_items"),
        F.sha2(F.coalesce("names", F.lit("")), 256).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )


def remove_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    drop_share: float = 0.0,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``docs`` without benchmark passages.

    A document is dropped when its hit words exceed ``drop_share`` of its words
    (0: any hit drops it); of the others the hit words are cut out, with the
    gaps that follow them.
    """
    rows, hits, _ = window_hits(docs, benchmark, window, doc_id, text)
    hit_rows = _covered(hits).join(
        rows.distinct().withColumnsRenamed({"_id": "_i", "_row": "_r"}), F.expr("_id <=> _i and _row = _r")
    )
    at = F.collect_list(F.struct("start", "m")).alias("_spans")
    spans = hits.select("_id", "_row", "start", "m").distinct().groupBy("_id", "_row").agg(at)
    spans = spans.withColumnsRenamed({"_id": "_si", "_row": "_sr"})
    drop = (F.col("n_hit") > F.col("n_words") * drop_share).alias("_drop")
    marks = hit_rows.select("_i", "_r", drop)
    if drop_share > 0:
        marks = marks.join(spans, F.expr("_i <=> _si and _r = _sr")).drop("_si", "_sr")
    held = pack(docs, _own=F.col(doc_id), _text=F.col(text), _key=F.xxhash64(text))
    kept = held.join(marks, F.expr("_own <=> _i and _key = _r"), "left").where("_drop is null or not _drop")
    if not drop_share:
        return unpack(kept)
    own = F.col("_text")
    gaps, words = F.split(own, WORD), F.regexp_extract_all(own, F.lit(f"({WORD})"), F.lit(1))
    inside = F.filter(
        F.sequence(F.lit(0), F.size(words) - 1),
        lambda i: ~F.exists("_spans", lambda s: (i >= s["start"]) & (i < s["start"] + s["m"])),
    )
    left = F.transform(inside, lambda i: F.concat(F.get(words, i), F.get(gaps, i + 1)))
    cut = F.concat(F.get(gaps, F.lit(0)), F.array_join(left, ""))
    cut = F.when(F.col("_spans").isNull(), own).otherwise(cut).alias(text)
    return kept.select(*[cut if c == text else F.col("doc").getField(c).alias(c) for c in docs.columns])
