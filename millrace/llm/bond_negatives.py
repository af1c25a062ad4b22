"""Hard negatives by a vertical scan of vectors (branch and bound on decomposed data).

Rows are packed into blocks that hold one column of integers per dimension, with
the least and greatest value of each.  A block is scanned for one anchor at a
time: dimensions are read in descending order of the anchor's magnitudes, scores
add up, and what the dimensions still to come can add lies between sums of their
least and greatest contributions.  A bitmap of candidates is cut down whenever
these bounds decide, and exact scores are at hand when all dimensions are read
or no candidate is left.

First scan: rows of the anchor's label; a candidate goes once ``positives`` others
are sure to score more.  Each block gives its best, and the best of these are the
positives.  Second scan: rows of other labels; every distinct positive score makes
a window of negative scores, and a candidate goes once it is outside of all windows
or, in each that it may lie in, ``negatives`` others are sure to lie in and above it.

Anchors are packed too, and every pack of anchors meets every block once: both
sides are repeated by block numbers, so that a task holds one block (at most
``BLOCK_ROWS`` rows) and one pack (``PACK_ROWS`` anchors).  Each pair of them sends
on a few rows per anchor, whatever the data are: a vector that a third of all rows
share is ranked by id within its blocks.

Defined cases: rows with a null label or vector, or with a null or non-finite
component, take no part; a null id is no anchor and comes last among equal scores;
repeated rows are rows of their own (a row is "other" than its own copy); components
beyond +-2^24 after scaling count as that, so that sums stay within 63 bits; of
vectors that differ in length the shorter count as if filled up with zeros; a label
without other rows has no positives, and a window without rows no negatives; no
rows give no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import rows_of
from millrace.session import stage

BLOCK_ROWS, PACK_ROWS = 16_384, 1_024
SCALE, LIMIT = 256.0, float(1 << 24)
#: Dimensions read between two cuts of the bitmap.
STRIDE = 8

_SHAPE = "rows int, dims int, low binary, high binary, cells binary, id binary, nameless binary, label binary"


# Blocks ---------------------------------------------------------------------


def _packed(values: np.ndarray) -> bytes:
    return zlib.compress(values.tobytes(), 1)


def _values(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), kind)


def vertical(ids: list, labels: list, vectors: list) -> dict:
    """One block: integers by dimension, ids, labels, and the range of every dimension."""
    width = max((len(v) for v in vectors), default=0)
    cells = np.zeros((width, len(vectors)), np.float64)
    for i, v in enumerate(vectors):
        cells[: len(v), i] = v
    cells = np.clip(np.floor(SCALE * cells), -LIMIT, LIMIT).astype("<i4")
    return {
        "rows": len(ids),
        "dims": width,
        "low": _packed(cells.min(axis=1).astype("<i4")),
        "high": _packed(cells.max(axis=1).astype("<i4")),
        "cells": _packed(cells),
        "id": _packed(np.array([0 if i is None else i for i in ids], "<i8")),
        "nameless": _packed(np.array([i is None for i in ids], "?")),
        "label": _packed(np.array(labels, "<i8")),
    }


class Block:
    """An unpacked block."""

    def __init__(self, row: dict):
        self.low, self.high = _values(row["low"], "<i4").astype(np.int64), _values(row["high"], "<i4").astype(np.int64)
        self.cells = _values(row["cells"], "<i4").reshape(row["dims"], row["rows"])
        self.id, self.nameless, self.label = _values(row["id"], "<i8"), _values(row["nameless"], "?"), _values(row["label"], "<i8")

    def first(self, at: np.ndarray, scores: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``most`` best of the candidates: highest scores, then smallest ids, null ids last."""
        if len(at) > most:
            least = np.partition(scores, len(scores) - most)[len(scores) - most]
            at, scores = at[scores >= least], scores[scores >= least]
        order = np.lexsort((self.id[at], self.nameless[at], -scores))[:most]
        return at[order], scores[order]


# Scans ----------------------------------------------------------------------


def scan(block: Block, anchor: np.ndarray, candidates: np.ndarray, cut) -> tuple[np.ndarray, np.ndarray]:
    """Candidates (numbers of rows) that ``cut`` leaves, with their exact scores.

    ``cut(low, high)`` gets bounds of the candidates' scores and says which stay.
    """
    dims = min(len(anchor), len(block.cells))
    reading = np.argsort(-np.abs(anchor[:dims]), kind="stable")
    by_low, by_high = anchor[:dims] * block.low[:dims], anchor[:dims] * block.high[:dims]
    least, most = np.minimum(by_low, by_high)[reading], np.maximum(by_low, by_high)[reading]
    least_left = np.append(np.cumsum(least[::-1])[::-1], 0)
    most_left = np.append(np.cumsum(most[::-1])[::-1], 0)
    at, scores = candidates, np.zeros(len(candidates), np.int64)
    for start in range(0, dims, STRIDE):
        if not len(at):
            break
        whole = len(at) == block.cells.shape[1]
        for d in reading[start : start + STRIDE]:
            column = block.cells[d] if whole else block.cells[d][at]
            scores += anchor[d] * column
        done = min(start + STRIDE, dims)
        kept = cut(scores + least_left[done], scores + most_left[done])
        if not kept.all():
            at, scores = at[kept], scores[kept]
    return at, scores


def best_cut(most: int):
    """Leaves candidates that may be among the ``most`` highest."""

    def cut(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        if len(low) <= most:
            return np.ones(len(low), bool)
        return high >= np.partition(low, len(low) - most)[len(low) - most]

    return cut


def window_cut(windows: list[tuple[int, int]], most: int):
    """Leaves candidates that may be among the ``most`` highest of a window (both ends included)."""

    def cut(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        kept = np.zeros(len(low), bool)
        for bottom, top in windows:
            may = (high >= bottom) & (low <= top)
            sure = low[(low >= bottom) & (high <= top)]
            if len(sure) > most:
                may &= high >= np.partition(sure, len(sure) - most)[len(sure) - most]
            kept |= may
        return kept

    return cut


def window_of(score: int) -> tuple[int, int]:
    """Least and greatest n with 30 * score <= 100 * n <= 90 * score."""
    return -(-30 * score // 100), 90 * score // 100


# On Spark -------------------------------------------------------------------


def hard_negatives(
    rows: DataFrame, anchor: Column, label: Column, vec_id: str = "vec_id", vector: str = "embedding",
    positives: int = 5, negatives: int = 10,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchor`` says which rows are anchors and ``label`` what counts as a row's label.
    """
    blocks = pack_rows(rows, anchor, label, vec_id, vector)
    whole = blocks.where("NOT anchors").drop("anchors")
    packs = blocks.where("anchors").select(F.col("block").alias("pack"), F.struct("rows", "dims", "cells", "id", "label", "home").alias("own"))

    best = _meet(whole, packs, _positive_task(positives), "pack string, place int, id bigint, nameless boolean, score bigint")
    order = Window.partitionBy("pack", "place").orderBy(F.desc("score"), "nameless", "id")
    best = best.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= positives)
    best = stage(best.select("pack", "place", "nth", "id", "nameless", "score"), "positives")

    wanted = best.groupBy("pack", "place").agg(F.collect_set("score").alias("scores"))
    wanted = wanted.groupBy("pack").agg(F.collect_list(F.struct("place", "scores")).alias("wanted"))
    packs = packs.join(wanted.withColumnRenamed("pack", "_p"), F.col("pack") == F.col("_p"))
    packs = packs.select("pack", F.struct("own.*", "wanted").alias("own"))
    found = _meet(whole, packs, _negative_task(negatives), "pack string, place int, score bigint, id bigint, nameless boolean, worth bigint")
    order = Window.partitionBy("pack", "place", "score").orderBy(F.desc("worth"), "nameless", "id")
    found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)

    names = blocks.where("anchors").select(F.col("block").alias("pack"), F.posexplode("anchor_ids").alias("place", "anchor_id"))
    named = lambda c: F.when(F.col(f"{c}.nameless"), F.lit(None).cast("bigint")).otherwise(F.col(f"{c}.id"))
    out = best.alias("p").join(found.alias("n"), ["pack", "place", "score"]).join(names, ["pack", "place"])
    return out.select(
        "anchor_id", named("p").alias("positive_id"), F.col("n.rank").cast("int").alias("rank"), named("n").alias("negative_id"),
        F.col("score").alias("positive_score"), F.col("n.worth").alias("negative_score"),
    )


def pack_rows(rows: DataFrame, anchor: Column, label: Column, vec_id: str, vector: str) -> DataFrame:
    """Blocks of all rows that take part, and packs of those that are anchors, written once.

    The place of an anchor in its own block (``home``) tells it from its copies.
    """
    x = F.col(vector)
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    fit = rows.where(x.isNotNull() & label.isNotNull()).where(~bad)
    fit = fit.select(
        F.col(vec_id).cast("bigint").alias("id"), label.cast("bigint").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"), x.cast("array<double>").alias("x"),
    )
    schema = f"block string, anchors boolean, {_SHAPE}, home array<struct<block:string,place:int>>, anchor_ids array<bigint>"
    return stage(fit.mapInArrow(_pack_task, schema), "blocks")


_PACKED = pa.schema(
    [
        ("block", pa.string()), ("anchors", pa.bool_()), ("rows", pa.int32()), ("dims", pa.int32()),
        *((c, pa.binary()) for c in ("low", "high", "cells", "id", "nameless", "label")),
        ("home", pa.list_(pa.struct([("block", pa.string()), ("place", pa.int32())]))),
        ("anchor_ids", pa.list_(pa.int64())),
    ]
)


def _pack_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task = TaskContext.get().partitionId()
    rows, anchors, n_blocks, n_packs = [], [], 0, 0

    def written(name: str, taken: list, own: bool) -> pa.RecordBatch:
        ids, labels, vectors = ([r[k] for r in taken] for k in range(3))
        row = {"block": name, "anchors": own, **vertical(ids, labels, vectors)}
        row |= {"home": [r[3] for r in taken] if own else None, "anchor_ids": ids if own else None}
        return pa.RecordBatch.from_pylist([row], _PACKED)

    for vec_id, label, is_anchor, x in rows_of(batches, "id", "label", "anchor", "x"):
        if is_anchor:
            anchors.append((vec_id, label, x, {"block": f"{task}-{n_blocks}", "place": len(rows)}))
        rows.append((vec_id, label, x))
        if len(rows) == BLOCK_ROWS:
            yield written(f"{task}-{n_blocks}", rows, False)
            rows, n_blocks = [], n_blocks + 1
        if len(anchors) == PACK_ROWS:
            yield written(f"a{task}-{n_packs}", anchors, True)
            anchors, n_packs = [], n_packs + 1
    if rows:
        yield written(f"{task}-{n_blocks}", rows, False)
    if anchors:
        yield written(f"a{task}-{n_packs}", anchors, True)


def _meet(blocks: DataFrame, packs: DataFrame, task, schema: str) -> DataFrame:
    """``task`` on every block with every pack.

    Blocks are dealt to as many cells as there are blocks, and the packs, which
    are smaller, are repeated for each cell.  What crosses to Python at once is
    bounded by Spark's limit on the bytes of a batch.
    """
    cells = max(1, blocks.count())
    left = blocks.withColumn("cell", F.pmod(F.xxhash64("block"), F.lit(cells)))
    right = packs.withColumn("cell", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(cells - 1).cast("bigint"))))
    whole = F.struct("block", "rows", "dims", "low", "high", "cells", "id", "nameless", "label").alias("whole")
    return left.join(right, "cell").select(whole, "pack", "own").mapInArrow(task, schema)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Block, str, str, dict]]:
    """(block, its name, name of the pack, pack) of each row; a block that comes again is unpacked once."""
    name, block = None, None
    for whole, pack, own in rows_of(batches, "whole", "pack", "own"):
        if whole["block"] != name:
            name, block = whole["block"], Block(whole)
        yield block, name, pack, own


def _anchors(own: dict) -> np.ndarray:
    """The vectors of a pack, one row each."""
    return _values(own["cells"], "<i4").reshape(own["dims"], own["rows"]).T.astype(np.int64)


def _positive_task(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, name, pack, own in _pairs(batches):
            vectors, labels = _anchors(own), _values(own["label"], "<i8")
            same = {v: np.flatnonzero(block.label == v) for v in set(labels.tolist())}
            places, found = [], []
            for i, home in enumerate(own["home"]):
                candidates = same[int(labels[i])]
                if home["block"] == name:
                    candidates = candidates[candidates != home["place"]]
                at, scores = block.first(*scan(block, vectors[i], candidates, best_cut(most)), most)
                places.append(np.full(len(at), i, np.int32))
                found.append((block.id[at], block.nameless[at], scores))
            ids, nameless, scores = (np.concatenate(c) for c in zip(*found))
            columns = [pa.array([pack] * len(ids), pa.string()), pa.array(np.concatenate(places)), pa.array(ids), pa.array(nameless), pa.array(scores)]
            yield pa.RecordBatch.from_arrays(columns, ["pack", "place", "id", "nameless", "score"])

    return run


def _negative_task(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, _, pack, own in _pairs(batches):
            vectors, labels = _anchors(own), _values(own["label"], "<i8")
            other = {v: np.flatnonzero(block.label != v) for v in set(labels.tolist())}
            places, found = [], []
            for wanted in own["wanted"]:
                i = wanted["place"]
                windows = [window_of(s) for s in wanted["scores"]]
                at, scores = scan(block, vectors[i], other[int(labels[i])], window_cut(windows, most))
                for of, (bottom, top) in zip(wanted["scores"], windows):
                    inside = (scores >= bottom) & (scores <= top)
                    own_at, own_scores = block.first(at[inside], scores[inside], most)
                    places.append(np.full(len(own_at), i, np.int32))
                    found.append((np.full(len(own_at), of, np.int64), block.id[own_at], block.nameless[own_at], own_scores))
            of, ids, nameless, scores = (np.concatenate(c) for c in zip(*found))
            columns = [pa.array([pack] * len(ids), pa.string()), pa.array(np.concatenate(places))]
            columns += [pa.array(of), pa.array(ids), pa.array(nameless), pa.array(scores)]
            yield pa.RecordBatch.from_arrays(columns, ["pack", "place", "score", "id", "nameless", "worth"])

    return run
