"""SimHash near-duplicates by a self-join of the binary trie of fingerprints.

The trie of 64-bit fingerprints is walked with itself: a pair of nodes of equal
depth holds the number of bits in which their paths differ; its four pairs of
children follow, and a pair is given up when that number exceeds the budget.

The upper levels are walked by Spark: a row (fingerprint, pair of prefixes)
stands for a fingerprint below a node of a pair, and descending some levels
sends it to each partner prefix within the budget.  Pairs of nodes that still
hold more than four times ``CELL`` fingerprints, as around a large group of near copies,
go further down; the others are finished in tasks of bounded size, where the
walk runs on sorted arrays.  Fingerprints are distinct, so that descent always
ends, and one has at most 2,081 others within two bits: links grow in proportion
to the fingerprints, whatever their grouping.

A task hands on a spanning forest of its links.  Their components are found by
alternating large-star and small-star steps over staged edge tables, and never
leave the executors.

Defined cases: null texts are empty; texts without a word have fingerprint
zero, which links like any other; rows with a null id take part and get the
component of their fingerprint, whose id is the smallest that is not null (null
if there is none); repeated rows each get their result; columns other than the
id and the text are ignored, and kept by ``keep_first``.
"""

from __future__ import annotations

import gc
import math
from collections.abc import Iterator
from functools import reduce
from itertools import repeat
from uuid import uuid4

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.common import is_empty, named, pack, rows_of, small_batches, unpack
from millrace.session import stage, workspace

BITS, SHINGLE, SEED = 64, 3, 42
#: Bits that may differ: a number, or (leading bits, number) pairs that all hold.
Budget = int | tuple[tuple[int, int], ...]
#: Fingerprints of a node at which Spark stops descending.
CELL = 1 << 14
#: Node pairs that a task walks at a time.
FRONT = 1 << 16
#: Levels that Spark descends before it turns to blocks of bits: below so many, a fingerprint goes to more pairs than there are blocks.
MOST_LEVELS = 2


def fingerprint(text: bytes, size: int = SHINGLE) -> int:
    """SimHash of the word shingles of an encoded text: bit i is set if it is in over half of the hashes."""
    words = text.lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    if len(words) <= size:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[k:] for k in range(size))))
    count = max(1, len(words) - size + 1)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), np.uint64, count)
    ones = np.zeros(BITS, np.int64)
    for start in range(0, count, 1 << 16):
        part = hashes[start : start + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > count, bitorder="little").tobytes(), "little")


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = [fingerprint(t or b"") for (t,) in rows_of([batch], "_text")]
        signed = pa.array(np.array(prints, np.uint64).view(np.int64))
        names = [name for name in batch.schema.names if name != "_text"]
        yield pa.RecordBatch.from_arrays([*map(batch.column, names), signed], [*names, "fp"])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", row: str | None = None) -> DataFrame:
    """_id and fp (64 bits as bigint) of every row; with a column ``row`` that numbers rows also _row and _hash (of the text)."""
    small_batches(docs.sparkSession)
    narrow = [F.col(doc_id).cast("bigint").alias("_id"), F.col(text).cast("binary").alias("_text")]
    if row is None:
        return docs.select(*narrow).mapInArrow(_fingerprints, "_id bigint, fp bigint")
    key = [F.xxhash64(text).alias("_hash"), F.col(row).alias("_row")]
    return docs.select(*narrow, *key).mapInArrow(_fingerprints, "_id bigint, _hash bigint, _row bigint, fp bigint")


# The walk inside a task ---------------------------------------------------


def _children(values: np.ndarray, lo: np.ndarray, hi: np.ndarray, depth: int) -> np.ndarray:
    """Where the second half of each node starts: the first value with bit ``depth`` (from the top) set."""
    bit = np.uint64(1) << np.uint64(BITS - 1 - depth)
    path = values[lo] & ~((bit << np.uint64(1)) - np.uint64(1)) if depth else np.zeros(len(lo), np.uint64)
    return np.clip(np.searchsorted(values, path | bit), lo, hi)


def _all_pairs(lo_a, hi_a, lo_b, hi_b) -> tuple[np.ndarray, np.ndarray]:
    """Every (i, j) of small node pairs."""
    wide = hi_b - lo_b
    sizes = (hi_a - lo_a) * wide
    which = np.repeat(np.arange(len(sizes)), sizes)
    nth = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return lo_a[which] + nth // wide[which], lo_b[which] + nth % wide[which]


def _at_depth(budget: Budget, depth: int) -> int:
    """How many of the first ``depth`` bits may differ."""
    return min(most for bits, most in _steps(budget) if bits >= depth)


def _steps(budget: Budget) -> tuple[tuple[int, int], ...]:
    return ((BITS, budget),) if isinstance(budget, int) else budget


def trie_links(a: np.ndarray, b: np.ndarray | None, budget: Budget, skip=None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i in a, j in b) within ``budget`` bits, in pieces; ``b`` None joins ``a`` with itself.

    Both arrays are sorted and distinct.  ``skip`` gets node pairs (ranges of both
    arrays) and says which need not be walked.
    """
    own = b is None
    b = a if own else b
    if not len(a) or not len(b):
        return
    one = lambda v: np.array([v])
    todo = [(0, one(0), one(len(a)), one(0), one(len(b)), one(0))]
    while todo:
        depth, lo_a, hi_a, lo_b, hi_b, off = todo.pop()
        if len(lo_a) > FRONT:
            cut = len(lo_a) // 2
            todo.append((depth, *(x[:cut] for x in (lo_a, hi_a, lo_b, hi_b, off))))
            todo.append((depth, *(x[cut:] for x in (lo_a, hi_a, lo_b, hi_b, off))))
            continue
        if skip is not None:
            left = ~skip(lo_a, hi_a, lo_b, hi_b)
            lo_a, hi_a, lo_b, hi_b, off = (x[left] for x in (lo_a, hi_a, lo_b, hi_b, off))
        small = ((hi_a - lo_a) * (hi_b - lo_b) <= 16) | (depth == BITS)
        if small.any():
            i, j = _all_pairs(lo_a[small], hi_a[small], lo_b[small], hi_b[small])
            near = (i < j) | (not own)
            for bits, most in _steps(budget):
                near &= np.bitwise_count((a[i] ^ b[j]) >> np.uint64(BITS - bits)) <= most
            if near.any():
                yield i[near], j[near]
            lo_a, hi_a, lo_b, hi_b, off = (x[~small] for x in (lo_a, hi_a, lo_b, hi_b, off))
        if not len(lo_a):
            continue
        mid_a, mid_b = _children(a, lo_a, hi_a, depth), _children(b, lo_b, hi_b, depth)
        most, next_ = _at_depth(budget, depth + 1), []
        for x in (0, 1):
            for y in (0, 1):
                la, ha = (lo_a, mid_a) if x == 0 else (mid_a, hi_a)
                lb, hb = (lo_b, mid_b) if y == 0 else (mid_b, hi_b)
                live = (la < ha) & (lb < hb) & (off + (x != y) <= most)
                if own and (x, y) == (1, 0):  # met as (0, 1)
                    live &= lo_a != lo_b
                next_.append((la[live], ha[live], lb[live], hb[live], off[live] + (x != y)))
        todo.append((depth + 1, *(np.concatenate(p) for p in zip(*next_))))


def _roots(parent: np.ndarray, x: np.ndarray) -> np.ndarray:
    while True:
        up = parent[x]
        if np.array_equal(up, x):
            return x
        parent[x] = parent[up]
        x = up


def forest(pieces: Iterator[tuple[np.ndarray, np.ndarray]], n: int) -> np.ndarray:
    """The smallest index of each index's component, given links in pieces."""
    parent = np.arange(n)
    for i, j in pieces:
        while True:
            i, j = _roots(parent, i), _roots(parent, j)
            apart = i != j
            if not apart.any():
                break
            i, j = i[apart], j[apart]
            np.minimum.at(parent, np.maximum(i, j), np.minimum(i, j))
    return _roots(parent, np.arange(n))


def _finish(budget: int):
    def cell(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        depth, first, second = key
        values = np.sort(rows["fp"].to_numpy().view(np.uint64))
        if first == second:
            pieces = trie_links(values, None, budget)
        else:
            cut = np.searchsorted(values, np.uint64(second << (BITS - depth)))
            a, b = values[:cut], values[cut:]
            pieces = ((i, j + cut) for i, j in trie_links(a, b, budget))
        root = forest(pieces, len(values))
        linked = np.flatnonzero(root != np.arange(len(values)))
        return pd.DataFrame({"u": values[linked].view(np.int64), "v": values[root[linked]].view(np.int64)})

    return cell


def links_of_forest(values: np.ndarray, cut: int | None, budget: Budget) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links within ``budget`` that connect all that such links connect, in pieces; close ones come first in each.

    With ``cut`` only links from before it to behind it count.  Nodes whose values
    are all connected already are not walked, so a crowd of near copies costs
    little more than its number.
    """
    shift = cut or 0
    a, b = (values, None) if cut is None else (values[:cut], values[cut:])
    parent, everyone = np.arange(len(values)), np.arange(len(values))

    def connected(lo_a, hi_a, lo_b, hi_b):
        root = _roots(parent, everyone)
        turns = np.concatenate([[0], np.cumsum(root[1:] != root[:-1])])
        alike = (turns[lo_a] == turns[hi_a - 1]) & (turns[lo_b + shift] == turns[hi_b - 1 + shift])
        return alike & (root[lo_a] == root[lo_b + shift])

    for i, j in trie_links(a, b, budget, connected):
        j = j + shift
        order = np.argsort(np.bitwise_count(values[i] ^ values[j]), kind="stable")
        i, j = i[order], j[order]
        while True:
            ends = _roots(parent, i), _roots(parent, j)
            apart = ends[0] != ends[1]
            if not apart.any():
                break
            i, j, (x, y) = i[apart], j[apart], (e[apart] for e in ends)
            # The closest link of each component.
            first = np.full(len(values), len(i))
            np.minimum.at(first, np.concatenate([x, y]), np.tile(np.arange(len(i)), 2))
            chosen = np.unique(first[np.concatenate([x, y])])
            yield i[chosen], j[chosen]
            x, y = x[chosen], y[chosen]
            while len(x):
                np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))
                x, y = _roots(parent, x), _roots(parent, y)
                x, y = x[x != y], y[x != y]


def _finish_links(budget: Budget):
    bits, _, wide = _blocks(budget)

    def cell(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        word, *turn, depth, first, second = key
        values = np.sort(rows["fp"].to_numpy().view(np.uint64))
        cut = None if first == second else int(np.searchsorted(values, np.uint64(second << (BITS - depth))))
        found = list(links_of_forest(values, cut, budget))
        u, v = (np.concatenate([np.empty(0, np.int64), *(p[k] for p in found)]).astype(np.int64) for k in (0, 1))
        values = _turn(values, -sum(turn) * wide, bits)
        return pd.DataFrame({"word": np.full(len(u), word, np.int32), "u": values[u].view(np.int64), "v": values[v].view(np.int64)})

    return cell


# The walk above the tasks -------------------------------------------------


def _descend(rows: DataFrame, levels: int, budget: int) -> DataFrame:
    """Rows one node pair each, ``levels`` deeper, to every partner within the budget; other columns go along."""
    others = [c for c in rows.columns if c not in ("fp", "depth", "a", "b")]
    flips = [m for m in range(1 << levels) if m.bit_count() <= budget]
    flip = F.explode(F.split(F.lit(",".join(map(str, flips))), ",").cast("array<bigint>"))
    out = rows.withColumn("flip", flip).where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) + F.bit_count("flip") <= budget)
    out = out.withColumn("mine", F.expr(f"shiftrightunsigned(fp, 64 - depth - {levels})"))
    low = (1 << levels) - 1
    above = F.expr(f"if(shiftrightunsigned(mine, {levels}) = a, b, a)")
    other = F.shiftleft(above, levels).bitwiseOR(F.col("mine").bitwiseAND(F.lit(low)).bitwiseXOR(F.col("flip")))
    out = out.withColumn("other", other)
    deeper = (F.col("depth") + levels).alias("depth")
    return out.select(*others, "fp", deeper, F.least("mine", "other").alias("a"), F.greatest("mine", "other").alias("b"))


def _blocks(budget: Budget) -> tuple[int, int, int]:
    """Leading bits, into how many blocks they are cut, and a block's bits: what is within the budget agrees in one."""
    bits, most = _steps(budget)[0]
    return bits, most + 1, bits // (most + 1)


def _turn(values: np.ndarray, by: int, bits: int) -> np.ndarray:
    """Fingerprints with their leading ``bits`` turned left."""
    if not by % bits:
        return values
    by, rest, ones = np.uint64(by % bits), np.uint64(BITS - bits), np.uint64((1 << bits) - 1)
    head = values >> rest
    head = ((head << by) | (head >> (np.uint64(bits) - by))) & ones
    return (head << rest) | (values & ((np.uint64(1) << rest) - np.uint64(1)))


def _turns(prints: DataFrame, budget: Budget) -> DataFrame:
    """Every fingerprint once for each block of leading bits, turned so that the block comes first."""
    bits, blocks, wide = _blocks(budget)

    def turned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("fp").to_numpy().view(np.uint64)
            for turn in range(blocks):
                columns = [pa.array(_turn(values, turn * wide, bits).view(np.int64)), pa.array(np.full(len(values), turn, np.int32))]
                yield pa.RecordBatch.from_arrays([batch.column("word"), *columns], ["word", "fp", "turn"])

    return prints.select("word", "fp").mapInArrow(turned, "word int, fp bigint, turn int")


def _cells(prints: DataFrame, budget: Budget, cell: int, turned: bool = False) -> tuple[DataFrame, list[str]]:
    """Rows (fp, node pair) of pairs small enough for a task, and the columns that name a pair.

    ``prints`` has distinct fp; with a column ``word`` every word is a trie of its own.
    ``turned`` allows for tries of turned fingerprints (:func:`_turns`; ``turn`` says by how much) instead of so many
    levels that a fingerprint would go to more pairs than that.
    """
    words = ["word"] if "word" in prints.columns else []
    count = prints.groupBy(*words).count().agg(F.max("count")).first()[0] or 0
    left, depth = math.ceil(math.log2(max(1, count / cell))), 0
    if turned and left > MOST_LEVELS:
        left, depth, prints, words = 0, min(left, _blocks(budget)[2]), _turns(prints, budget), [*words, "turn"]
    node = F.expr(f"shiftrightunsigned(shiftrightunsigned(fp, 1), 63 - {depth})")
    rows = prints.select(*words, "fp", F.lit(depth).alias("depth"), node.alias("a"), node.alias("b"))
    while left > 0:
        rows, depth, left = _descend(rows, min(left, 6), _at_depth(budget, depth + min(left, 6))), depth + min(left, 6), left - 6
    key, settled = [*words, "depth", "a", "b"], []
    while True:
        large = rows.groupBy(*key).agg(F.count("*").alias("n")).where(f"n > {4 * cell} and depth < 62")
        large = stage(large.select(*[F.col(k).alias(f"_{k}") for k in key]), "large-cells")
        if is_empty(large):
            return reduce(DataFrame.unionByName, settled, rows), key
        same = F.expr(" and ".join(f"{k} = _{k}" for k in key))
        settled.append(rows.join(large, same, "left_anti"))
        rows, depth = _descend(stage(rows.join(large, same, "left_semi"), "cells"), 2, _at_depth(budget, depth + 2)), depth + 2


def near_links(prints: DataFrame, budget: int = 2, cell: int = CELL) -> DataFrame:
    """Edges (u, v) that connect what links within ``budget`` bits connect; ``prints`` has distinct fp."""
    rows, key = _cells(prints, budget, cell)
    return rows.groupBy(*key).applyInPandas(_finish(budget), "u bigint, v bigint")


def components(edges: DataFrame) -> DataFrame:
    """node, root: for every node of ``edges`` (u, v) the smallest node of its component."""
    edges = stage(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    mark = None
    while True:
        # Large star: larger neighbours move to the smallest neighbour.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")).withColumnRenamed("u", "_u")
        large = both.join(least, F.expr("u = _u and v > u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stage(large.distinct(), "large-star")
        # Small star: smaller neighbours and the node itself move to the smallest.
        least = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "_u")
        small = large.join(least, F.expr("u = _u and v <> m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stage(small.union(least.select(F.col("_u").alias("u"), F.col("m").alias("v"))).distinct(), "small-star")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % (1 << 40))).first()
        if now == mark:
            break
        mark = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)


def _members(prints: DataFrame, budget: int, cell: int) -> DataFrame:
    """``prints`` (distinct fp) with the root of each one's component."""
    roots = stage(components(near_links(prints.select("fp"), budget, cell)), "roots")
    return prints.join(roots, prints.fp == roots.node, "left").select(*prints.columns, F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, budget: int = 2, doc_id: str = "doc_id", text: str = "text", cell: int = CELL) -> DataFrame:
    """doc_id, fp, component_id (smallest doc_id reachable over links) for every row."""
    rows = stage(fingerprints(docs, doc_id, text), "fingerprints")
    member = _members(stage(rows.groupBy("fp").agg(F.min("_id").alias("least")), "prints"), budget, cell)
    first = member.groupBy("root").agg(F.min("least").alias("component_id"))
    known = member.join(first, "root").select(F.col("fp").alias("_fp"), "component_id")
    return rows.join(known, F.col("fp") == F.col("_fp"), "left").select(F.col("_id").alias(doc_id), "fp", "component_id")


def hex64(c: Column | str) -> Column:
    return F.lower(F.lpad(F.hex(c), 16, "0"))


def keep_first(
    docs: DataFrame, budget: int = 2, doc_id: str = "doc_id", text: str = "text", keep_null_ids: bool = True
) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id, of repeated ids the smallest text hash.

    Rows are told apart by a number, so that an id repeated in several
    components keeps a row in each.  With ``keep_null_ids`` rows with a null id
    do not stand for a group and stay; without it they count as the largest ids.
    """
    held = pack(docs, _row=F.monotonically_increasing_id(), _own_id=F.col(doc_id), _own_text=F.col(text))
    held = stage(held, "numbered")
    rows = stage(fingerprints(held, "_own_id", "_own_text", "_row"), "fingerprints")
    order = F.struct(F.col("_id").isNull().alias("none"), "_id", "_hash", "_row")
    if keep_null_ids:
        order = F.when(F.col("_id").isNotNull(), order)
    prints = stage(rows.groupBy("fp").agg(F.min(order).alias("least")), "prints")
    first = _members(prints, budget, CELL).groupBy("root").agg(F.min("least").alias("least"))
    kept = first.where("least is not null").select(F.col("least._row").alias("_row"))
    if keep_null_ids:
        kept = kept.union(rows.where("_id is null").select("_row"))
    return unpack(held.join(kept, "_row", "left_semi"))


# Near copies by similarity ------------------------------------------------

#: Fingerprints of a text, each with a trie of its own.
WORDS = 8
#: Differing bits of two texts of similarity 0.8 are some 10 of 64: one of eight fingerprints in four has 3 or
#: fewer in its first half and 12 or fewer in all.
COPY_BUDGET: Budget = ((32, 3), (BITS, 12))
COPY_CELL = 1 << 16
_LANES = np.uint64(0x0101010101010101)


def shingle_hashes(text: bytes, size: int) -> np.ndarray:
    """Sorted distinct hashes of the word shingles of an encoded text; none without a word."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    grams = [b" ".join(words)] if len(words) <= size else set(map(b" ".join, zip(*(words[k:] for k in range(size)))))
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), np.uint64, len(grams)))


def several_fingerprints(hashes: np.ndarray) -> np.ndarray:
    """``WORDS`` SimHashes of a set of hashes, from as many mixtures of each."""
    if not len(hashes):
        return np.zeros(WORDS, np.uint64)
    mixed = hashes[None, :] + (np.arange(WORDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[:, None]
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(factor)
    mixed ^= mixed >> np.uint64(31)
    blocks = np.arange(0, len(hashes), 255)  # so many bits add up in a byte
    ones = np.empty((WORDS, 8, 8), np.int64)
    for bit in range(8):
        lanes = np.add.reduceat((mixed >> np.uint64(bit)) & _LANES, blocks, axis=1)
        ones[:, :, bit] = lanes.astype("<u8").view(np.uint8).reshape(WORDS, -1, 8).sum(axis=1, dtype=np.int64)
    bits = (ones.reshape(WORDS, BITS) * 2 > len(hashes)).astype(np.uint8)
    return np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel().astype(np.uint64)


def _prints_task(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for (t,) in rows_of([batch], "text")]
            prints = [several_fingerprints(shingle_hashes(t, size)).view(np.int64) for t in texts]
            keys = pa.array([xxhash.xxh3_128_digest(t) for t in texts], pa.binary())
            columns = [batch.column("n"), batch.column("id"), keys, pa.array(prints, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["n", "id", "text_key", "prints"])

    return run


def _sets_task(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_hashes(t or b"", size).astype("<u8").tobytes() for (t,) in rows_of([batch], "text")]
            yield pa.RecordBatch.from_arrays([batch.column("n"), pa.array(sets, pa.binary())], ["n", "hashes"])

    return run


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two sorted sets; two empty ones are alike."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) + len(b) else 1.0


def _alike_task(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = ((np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")) for x, y in rows_of([batch], "hashes", "hashes_v"))
            alike = pa.array([jaccard(x, y) >= least for x, y in sets], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("u"), batch.column("v")], ["u", "v"]).filter(alike)

    return run


# What the tries leave out ---------------------------------------------------

#: Texts whose shingles give the order of all: it says how much is compared, never what is found.
#: One text in ``ORDER_SHARE``, but ``ORDER_TEXTS`` at least: a shingle counted fewer than ``ORDER_LEAST`` times is then in
#: some tens of texts, however many there are.
ORDER_TEXTS, ORDER_SHARE, ORDER_SHINGLES, ORDER_LEAST = 20_000, 10, 1 << 18, 4
#: Bits, at least, of the parities of a set: sets differ in at least as many shingles as their parities in bits.
PARITIES = 1024
#: Texts that share a shingle and are compared by sizes and places alone; rows of a shingle compared at a time.
MET_FEW, MET_BLOCK = 64, 1 << 12
#: Shingles before one by which texts are known to have met already.
MET_BEFORE = 4


def needed(sizes, least: float):
    """Shingles that a set shares, at least, with any of similarity ``least``; of two sets' sizes together those that both hold."""
    return np.ceil(sizes * least - 1e-9).astype(np.int64)


def first_shingles(hashes: np.ndarray, least: float, common: np.ndarray) -> np.ndarray:
    """The first few shingles of a set in an order of all: sets of similarity ``least`` share one of them.

    The order is that of the hashes, ``common`` ones (sorted) behind all others.
    """
    if not len(hashes):
        return np.zeros(1, np.uint64)
    if len(common):
        at = np.minimum(np.searchsorted(common, hashes), len(common) - 1)
        hashes = hashes[np.argsort(common[at] == hashes, kind="stable")]
    return hashes[: len(hashes) - int(needed(len(hashes), least)) + 1]


def parities(hashes: np.ndarray) -> np.ndarray:
    """Of as many classes of hashes as the set is large (a power of two): fewer are odd by chance in any large set."""
    bits = max(PARITIES, 1 << len(hashes).bit_length())
    odd = np.bincount((hashes % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def possible(sizes: tuple[int, int], odd: tuple[np.ndarray, np.ndarray], least: float) -> bool:
    """Whether sets of these sizes and parities may have similarity ``least``; false only if they cannot."""
    if min(sizes) < max(sizes) * least - 1e-9:
        return False
    wide = min(map(len, odd))
    u, v = (np.bitwise_xor.reduce(x.reshape(-1, wide), axis=0) for x in odd)
    both = sum(sizes)
    return int(np.bitwise_count((u ^ v).view(np.uint64)).sum()) <= both - 2 * math.ceil(both * (least / (1 + least)) - 1e-9)


def _parities_task(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_hashes(t or b"", size) for (t,) in rows_of([batch], "text")]
            columns = [pa.array([len(h) for h in sets], pa.int32()), pa.array([parities(h) for h in sets], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column("n"), *columns], ["n", "size", "parities"])

    return run


def _possible_task(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            odd = []
            for end in ("u", "v"):
                lists = batch.column(f"parities_{end}")
                odd.append(np.split(lists.flatten().to_numpy(), np.cumsum(lists.value_lengths().to_numpy())[:-1]))
            sizes = rows_of([batch], "size_u", "size_v")
            keep = [possible(pair, both, least) for pair, both in zip(sizes, zip(*odd))]
            yield pa.RecordBatch.from_arrays([batch.column("u"), batch.column("v")], ["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return run


def _possible(pairs: DataFrame, sketches: DataFrame, least: float) -> DataFrame:
    """Those of ``pairs`` that sizes and parities (``sketches``: n, size, parities) do not rule out; their sets need not travel."""
    for end in ("u", "v"):
        own = sketches.select(F.col("n").alias(end), F.col("size").alias(f"size_{end}"), F.col("parities").alias(f"parities_{end}"))
        pairs = pairs.join(own, end)
    return pairs.mapInArrow(_possible_task(least), "u bigint, v bigint")


def _shingles_task(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for (text,) in rows_of([batch], "text"):
                yield pa.RecordBatch.from_arrays([pa.array(shingle_hashes(text or b"", size).view(np.int64))], ["shingle"])

    return run


def _first_task(size: int, least: float, common: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_hashes(t or b"", size) for (t,) in rows_of([batch], "text")]
            first = [first_shingles(h, least, common).view(np.int64) for h in sets]
            columns = [pa.array([len(h) for h in sets], pa.int32()), pa.array(first, pa.list_(pa.int64())), pa.array([parities(h) for h in sets], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column("n"), batch.column("root"), *columns], ["n", "root", "size", "first", "parities"])

    return run


def _common_shingles(texts: DataFrame, size: int) -> np.ndarray:
    """Sorted hashes of the commonest shingles of some texts."""
    every = min(ORDER_SHARE, max(1, texts.count() // ORDER_TEXTS))
    some = texts.where(F.pmod(F.xxhash64("n"), F.lit(every)) == 0).select("text")
    counted = some.mapInArrow(_shingles_task(size), "shingle bigint").groupBy("shingle").agg(F.count("*").alias("c"))
    top = counted.where(F.col("c") >= ORDER_LEAST).orderBy(F.desc("c"), "shingle").limit(ORDER_SHINGLES).toArrow()
    return np.sort(top.column("shingle").to_numpy().view(np.uint64))


def candidates_apart(texts: DataFrame, nodes: DataFrame, least: float, size: int) -> DataFrame:
    """Pairs (u, v) of texts that may have similarity ``least``, complete for texts whose roots differ.

    ``nodes`` has n and root of texts that differ.  Texts of that similarity share
    one of their first shingles (prefix filter).  Pairs go only between groups, are
    met at the first shingle that they share, and fall there by their sizes, by its
    place and, where many texts share it, by their parities.
    """
    schema = "n bigint, root bigint, size int, first array<bigint>, parities array<bigint>"
    first = texts.join(nodes, "n").mapInArrow(_first_task(size, least, _common_shingles(texts.join(nodes, "n", "left_semi"), size)), schema)
    first = stage(first, "first-shingles")
    _let_go(first)
    rows = _met_apart(first)
    _let_go(rows)
    met = (F.col("shingle_u") == F.col("shingle_v")) & (F.col("root_u") < F.col("root_v"))
    both = F.col("size_u") + F.col("size_v")
    shared = F.ceil(both * (least / (1 + least)) - 1e-9)
    likely = (F.least("size_u", "size_v") >= F.greatest("size_u", "size_v") * least - 1e-9) & (
        F.least(F.col("size_u") - F.col("at_u"), F.col("size_v") - F.col("at_v")) >= shared
    )
    # Of the two runs of first shingles one ends before the other: up to there no more are shared than are left of either.
    behind = F.ceil(F.greatest("size_u", "size_v") * least - 1e-9) - 1
    likely &= F.least("left_u", "left_v") + behind >= shared
    differ = sum((F.bit_count(F.col("parities_u")[k].bitwiseXOR(F.col("parities_v")[k])) for k in range(PARITIES // 64)), F.lit(0))
    near = F.coalesce(differ <= both - 2 * shared, F.lit(True))
    own = lambda df, end: df.select(*(F.col(c).alias(f"{c}_{end}") for c in df.columns))
    likely = met & likely & near & ~F.arrays_overlap("before_u", "before_v")
    one, more, blocks = _to_blocks(rows)
    apart = own(one, "u").join(own(one, "v"), likely)  # both sides are dealt once
    if more is not None:
        apart = apart.unionByName(own(more, "u").join(own(blocks, "v"), likely & (F.col("to_u") == F.col("block_v"))).select(*apart.columns))
    found = stage(apart.select(F.least("n_u", "n_v").alias("u"), F.greatest("n_u", "n_v").alias("v")).distinct(), "apart")
    return stage(_possible(found, first, least), "apart-candidates")


def _folded(odd: Column, k: Column) -> Column:
    """The k-th 64 of the ``PARITIES`` bits that longer parities come to."""
    each = F.sequence(k, F.size(odd) - 1, F.lit(PARITIES // 64))
    return F.aggregate(each, F.lit(0).cast("bigint"), lambda at, j: at.bitwiseXOR(odd[j]))


def _met_apart(first: DataFrame) -> DataFrame:
    """A row for each of the first shingles that texts of several groups have.

    ``block`` numbers stretches of a shingle's rows in the order of their roots, ``before``
    has the last few such shingles of the text before this one: texts that share one of
    those have met there; ``left`` counts them from this one on.  Rows of shingles that many texts have bring the parities.
    """
    rows = first.select("n", "root", F.posexplode("first").alias("at", "shingle"))
    alike = Window.partitionBy("shingle")
    nth = F.row_number().over(alike.orderBy("root", "n")) - 1
    rows = rows.withColumns({"met": F.count("*").over(alike), "low": F.min("root").over(alike), "high": F.max("root").over(alike)})
    rows = rows.where("low < high").drop("low", "high").withColumn("block", F.floor(nth / MET_BLOCK))
    earlier = Window.partitionBy("n").orderBy("at").rowsBetween(-MET_BEFORE, -1)
    rows = rows.withColumn("before", F.collect_list("shingle").over(earlier))
    passed = F.row_number().over(Window.partitionBy("n").orderBy("at")) - 1
    rows = rows.withColumn("left", F.count("*").over(Window.partitionBy("n")) - passed)
    some = F.transform(F.sequence(F.lit(0), F.lit(PARITIES // 64 - 1)), lambda k: _folded(F.col("parities"), k))
    many = F.when(F.col("met") > MET_FEW, some).alias("parities")
    of = first.select(F.col("n").alias("_n"), "size", "parities")
    return stage(rows.join(of, F.col("n") == F.col("_n")).select(*rows.columns, "size", many), "met").drop("met")


def _to_blocks(rows: DataFrame) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    """``rows`` of shingles with one block; those of the others, once for every block ``to`` that has larger roots than their own block's smallest, and once.

    A large group's blocks are not compared with each other, and no task gets more than two blocks at a time.
    """
    ends = rows.groupBy("shingle", "block").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    several = stage(ends.withColumn("blocks", F.count("*").over(Window.partitionBy("shingle"))).where("blocks > 1"), "blocks")
    if is_empty(several):
        return rows, None, None
    of = several.select(F.col("shingle").alias("_shingle"), F.col("block").alias("_block"), F.col("low").alias("_low"))
    pairs = of.join(several, F.expr("_shingle = shingle and _block <= block and high > _low"))
    pairs = pairs.select("_shingle", "_block", F.col("block").alias("_to"))
    large, same = several.select(F.col("shingle").alias("_shingle")).distinct(), F.col("shingle") == F.col("_shingle")
    more = rows.join(pairs, F.expr("shingle = _shingle and block = _block")).select(*rows.columns, F.col("_to").alias("to"))
    return rows.join(large, same, "left_anti"), more, rows.join(large, same, "left_semi")


def similar_links(texts: DataFrame, prints: DataFrame, least: float = 0.8, size: int = 5, cell: int = COPY_CELL) -> DataFrame:
    """Edges (u, v) that connect what a Jaccard similarity of ``least`` or more between word shingles connects.

    ``texts`` has n and text (encoded), ``prints`` n and prints of texts that differ.
    Candidates come from the walks of all tries; each is confirmed by the sets.  Texts
    that these links leave apart are then compared wherever the similarity is possible
    (:func:`candidates_apart`), so that no link between two groups is left out.
    """
    found, alike = _trie_links(texts, prints, least, size, cell)
    found = stage(found, "trie-links")
    roots = stage(components(found), "trie-roots")
    nodes = prints.select("n").join(roots, F.col("n") == F.col("node"), "left").select("n", F.coalesce("root", "n").alias("root"))
    return found.union(alike(candidates_apart(texts, stage(nodes, "trie-nodes"), least, size)))


def _trie_links(texts: DataFrame, prints: DataFrame, least: float, size: int, cell: int):
    """Confirmed edges from the walks of all tries, and what confirms pairs."""
    nodes = prints.select("n", F.posexplode("prints").alias("word", "fp"))
    nodes = stage(nodes, "nodes")
    distinct = stage(nodes.groupBy("word", "fp").agg(F.min("n").alias("first")), "distinct-prints")
    rows, key = _cells(distinct.select("word", "fp"), COPY_BUDGET, cell, turned=True)
    found = rows.groupBy(*key).applyInPandas(_finish_links(COPY_BUDGET), "word int, u bigint, v bigint")
    numbered = lambda end: distinct.select(F.col("word"), F.col("fp").alias(end), F.col("first").alias(f"n_{end}"))
    found = found.join(numbered("u"), ["word", "u"]).join(numbered("v"), ["word", "v"]).select("n_u", "n_v")
    same = nodes.join(distinct, ["word", "fp"]).where("n <> first").select(F.col("first").alias("n_u"), F.col("n").alias("n_v"))
    pairs = found.union(same).select(F.least("n_u", "n_v").alias("u"), F.greatest("n_u", "n_v").alias("v")).distinct()
    pairs = stage(pairs, "candidates")
    _let_go(pairs)
    ends = pairs.select(F.explode(F.array("u", "v")).alias("n")).distinct()
    sketches = texts.join(ends, "n", "left_semi").mapInArrow(_parities_task(size), "n bigint, size int, parities array<bigint>")
    pairs = stage(_possible(pairs, stage(sketches, "parities"), least), "possible")

    def alike(some: DataFrame) -> DataFrame:
        ends = some.select(F.explode(F.array("u", "v")).alias("n")).distinct()
        sets = stage(texts.join(ends, "n", "left_semi").mapInArrow(_sets_task(size), "n bigint, hashes binary"), "shingles")
        u = sets.withColumnRenamed("n", "u")
        v = sets.select(F.col("n").alias("v"), F.col("hashes").alias("hashes_v"))
        return stage(some.join(u, "u").join(v, "v").mapInArrow(_alike_task(least), "u bigint, v bigint"), "alike")

    # Each text's closest candidate first: it settles most groups, and sets travel only for what is still apart.
    closest = _closest(pairs, prints)
    linked = alike(closest)
    root = stage(components(linked), "first-roots")
    far = pairs.join(closest, ["u", "v"], "left_anti")
    for end in ("u", "v"):
        far = far.join(root.select(F.col("node").alias(end), F.col("root").alias(f"root_{end}")), end, "left")
    far = far.where(F.coalesce("root_u", "u") != F.coalesce("root_v", "v")).select("u", "v")
    return linked.union(alike(stage(far, "far"))), alike


def _closest(pairs: DataFrame, prints: DataFrame) -> DataFrame:
    """For each text of ``pairs`` the pair with the fewest differing bits of all fingerprints."""
    own = lambda end: prints.select(F.col("n").alias(end), F.col("prints").alias(f"prints_{end}"))
    differ = F.zip_with("prints_u", "prints_v", lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    apart = pairs.join(own("u"), "u").join(own("v"), "v").select("u", "v", F.aggregate(differ, F.lit(0), lambda at, x: at + x).alias("d"))
    each = apart.select("d", "u", "v", F.explode(F.array("u", "v")).alias("n"))
    nearest = each.groupBy("n").agg(F.min(F.struct("d", "u", "v")).alias("best"))
    return stage(nearest.select("best.u", "best.v").distinct(), "closest")


def _bucketed(df: DataFrame, key: str) -> DataFrame:
    """``df`` written in buckets of ``key``, so that joins on it move the other side alone."""
    spark, name = df.sparkSession, f"bucketed_{uuid4().hex[:12]}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    packed = df.repartition(n, key).write.bucketBy(n, key).option("compression", "zstd")
    packed.option("path", workspace(spark, "bucketed")).saveAsTable(name)
    return spark.table(name)


def _let_go(df: DataFrame) -> None:
    """Collects the driver's garbage: the files of shuffles that nothing needs any more stay on disk until then."""
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()


def keep_first_similar(docs: DataFrame, least: float = 0.8, size: int = 5, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each group of near copies: that of the smallest id, null ids last.

    Rows are near copies whose sets of ``size``-word shingles have a Jaccard similarity
    of ``least`` or more, and groups are what such links connect.  Of rows that share an
    id in a group the one with the smallest text hash stays.  Texts without a word are
    copies of each other.  The columns' names may be any.
    """
    small_batches(docs.sparkSession)
    held = _bucketed(pack(docs, n=F.monotonically_increasing_id()), "n")
    _let_go(held)
    texts = held.select("n", named("doc").getField(doc_id).cast("bigint").alias("id"), named("doc").getField(text).cast("binary").alias("text"))
    rows = stage(texts.mapInArrow(_prints_task(size), "n bigint, id bigint, text_key binary, prints array<bigint>"), "fingerprints")
    order = F.struct(F.col("id").isNull().alias("none"), "id", "text_key", "n")
    each = rows.groupBy("text_key").agg(F.min(order).alias("least"), F.first("prints").alias("prints"))
    each = stage(each.select(F.col("least.n").alias("n"), "least", "prints"), "texts")
    roots = stage(components(similar_links(texts.select("n", "text"), each.select("n", "prints"), least, size)), "roots")
    member = each.join(roots, F.col("n") == F.col("node"), "left")
    first = member.groupBy(F.coalesce("root", "n").alias("group")).agg(F.min("least").alias("least"))
    kept = first.select(F.col("least.n").alias("n"))
    return unpack(held.join(kept, "n", "left_semi"))
