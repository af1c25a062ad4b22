"""Shards by extendible hashing.

The directory is indexed by the leading bits of a row's hash.  A bucket over
the byte limit is split on its next bit, and only that bucket; all others keep
their depth.  Sizes are summed map-side per prefix, a few bits a round, and a
round looks only at the prefixes that the round before it left too large.

The hash is 52 bits of MD5 of the key (of the text where the key is null).
Rows that share all of them, such as many copies under one key, split on 52
further bits drawn from a row number, which is written down once before it is
used.  A bucket of one row is never split: a single row over the limit has a
shard to itself, and ``shard_bytes`` shows it.

Defined cases: null texts have zero bytes; an empty table gives an empty
result; repeated rows are rows like any other; other columns are untouched.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import pack, unpack
from millrace.session import stage

BITS = 52
#: Bits resolved by a round after the first.
STEP = 6
#: Directory entries up to which the directory is broadcast (some 30 bytes each).
BROADCAST_ENTRIES = 1 << 21

_H, _U, _B = "_shard_h", "_shard_u", "_shard_bytes"


def _hash(key: Column, text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    hexed = F.md5(F.when(key.isNull(), F.concat(F.lit("null:"), text)).otherwise(key.cast("string")).cast("binary"))
    return F.conv(F.substring(hexed, 1, BITS // 4), 16, 10).cast("bigint")


def _prefix(depth: int, h: Column | str = _H, u: Column | str = _U) -> list[Column]:
    """The first ``depth`` bits, as the part from the hash and the part from the row number."""
    first = F.shiftright(h, BITS - min(depth, BITS))
    return [first.alias("p"), (F.shiftright(u, 2 * BITS - depth) if depth > BITS else F.lit(0).cast("bigint")).alias("q")]


def _up(depth: int, to: Column) -> list[Column]:
    """The prefix at depth ``to`` of (p, q) at ``depth``; both on one side of the seam."""
    if depth <= BITS:
        return [F.expr(f"shiftright(p, {depth} - j)").alias("p"), F.lit(0).cast("bigint").alias("q")]
    return [F.col("p"), F.expr(f"shiftright(q, {depth} - j)").alias("q")]


def _round(rows: DataFrame, start: int, depth: int, limit: int) -> DataFrame:
    """Directory entries at ``depth`` for rows whose buckets at ``start`` are too large.

    p, q, leaf: the depth of the bucket that the entry points to, null where
    even ``depth`` bits leave it over the limit.
    """
    fine = stage(
        rows.groupBy(*_prefix(depth)).agg(F.sum(_B).alias("n_bytes"), F.sum("_shard_n").alias("n_rows")), "directory"
    )
    levels = fine.withColumn("j", F.explode(F.sequence(F.lit(start), F.lit(depth))))
    up = _up(depth, F.col("j"))
    fits = (
        levels.select("j", *up, "n_bytes", "n_rows")
        .groupBy("j", "p", "q")
        .agg(F.sum("n_bytes").alias("n_bytes"), F.sum("n_rows").alias("n_rows"))
        .where((F.col("n_bytes") <= limit) | (F.col("n_rows") == 1))
        .select("j", F.col("p").alias("up_p"), F.col("q").alias("up_q"))
    )
    named = levels.select("j", F.col("p").alias("fine_p"), F.col("q").alias("fine_q"), *up)
    found = named.join(
        fits, (named.j == fits.j) & (named.p == fits.up_p) & (named.q == fits.up_q), "left"
    ).select(F.col("fine_p").alias("p"), F.col("fine_q").alias("q"), F.when(F.col("up_p").isNotNull(), named.j).alias("leaf"))
    return stage(found.groupBy("p", "q").agg(F.min("leaf").alias("leaf")), "directory")


def _attach(rows: DataFrame, depth: int, entries: DataFrame, n: int, out: str) -> DataFrame:
    p, q = _prefix(depth)
    entries = entries.select(F.col("p").alias("_dp"), F.col("q").alias("_dq"), F.col("leaf").alias(out))
    if n <= BROADCAST_ENTRIES:
        entries = F.broadcast(entries)
    joined = rows.withColumn("_p", p).withColumn("_q", q)
    return joined.join(entries, (F.col("_p") == F.col("_dp")) & (F.col("_q") == F.col("_dq")), "left").drop(
        "_p", "_q", "_dp", "_dq"
    )


def assign_shards(docs: DataFrame, limit: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``shard``, the bucket's bits as text (empty for the one bucket that needs none).

    Where ``docs`` has a column of that name, the new one is ``shard_2``, or the next number that is free.
    """
    if limit < 1:
        raise ValueError("the byte limit must be positive")
    taken = {c.lower() for c in docs.columns}
    name = next(n for n in itertools.chain(["shard"], map("shard_{}".format, itertools.count(2))) if n not in taken)
    docs = pack(docs, _key=F.col(key), _text=F.col(text))

    def hashed(df: DataFrame) -> DataFrame:
        if _U not in df.columns:
            df = df.withColumn(_U, F.lit(0).cast("bigint"))
        return df.withColumn(_H, _hash(F.col("_key"), F.col("_text"))).withColumn(
            _B, F.coalesce(F.octet_length("_text"), F.lit(0)).cast("bigint")
        )

    def sizes(df: DataFrame) -> DataFrame:
        return stage(df.groupBy(_H, _U).agg(F.sum(_B).alias(_B), F.count("*").alias("_shard_n")), "shard-sizes")

    rows = hashed(docs)
    held = sizes(rows)
    total = held.agg(F.coalesce(F.sum(_B), F.lit(0))).first()[0]
    start, depth = 0, min(BITS, max(STEP, math.ceil(math.log2(max(1, total / limit))) + 2))
    leaves = []
    while True:
        entries = _round(held, start, depth, limit)
        counts = entries.agg(F.count("*").alias("n"), F.count_if(F.col("leaf").isNull()).alias("left")).first()
        leaves.append((depth, entries, counts.n))
        if not counts.left or depth == 2 * BITS:
            break
        if depth == BITS:  # rows that share their whole hash: number them, once
            docs = stage(docs.withColumn(_U, F.monotonically_increasing_id()), "numbered")
            docs = docs.withColumn(_U, F.shiftright(F.xxhash64(_U), 64 - BITS).bitwiseAND(F.lit((1 << BITS) - 1)))
            rows = hashed(docs)
            held = sizes(rows)
            for known, seen, n in leaves:
                held = _attach(held, known, seen, n, f"_leaf{known}")
            held = held.where(F.col(f"_leaf{depth}").isNull())
            held = held.where(F.coalesce(*[F.col(f"_leaf{k}") for k, _, _ in leaves]).isNull())
        else:
            held = _attach(held, depth, entries, counts.n, "_leaf").where("_leaf is null").drop("_leaf")
        start, depth = depth, min(depth + STEP, BITS if depth < BITS else 2 * BITS)
    names = []
    for known, entries, n in leaves:
        names.append(f"_leaf{known}")
        rows = _attach(rows, known, entries, n, names[-1])
    # At full depth an entry without a leaf holds rows that nothing tells apart.
    leaf = F.coalesce(*names, F.lit(depth))
    bits = F.concat(F.lpad(F.bin(_H), BITS, "0"), F.lpad(F.bin(_U), BITS, "0"))
    return unpack(rows, F.left(bits, leaf).alias(name))


def shard_sizes(sharded: DataFrame, text: str = "text") -> DataFrame:
    """One row a shard: shard, depth, shard_bytes, shard_docs."""
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint")
    return sharded.groupBy("shard").agg(
        F.first(F.length("shard")).alias("depth"), F.sum(size).alias("shard_bytes"), F.count("*").alias("shard_docs")
    )
