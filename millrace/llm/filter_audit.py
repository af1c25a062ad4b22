"""Audit of how filters interact, by count-weighted decision diagrams.

Every document has a mask of the filters that it fails.  Spark counts documents
by (part, mask); a part has 2^k masks at most, so its counts fit into one small
diagram: level i decides on the i-th filter of an order, ``lo`` is passed and
``hi`` failed, equal sub-diagrams are one node, and a node weighs the counts
below it.  The documents that reach step i of an order are the weight of the
i-th node on the path of passes; those removed there are the weight of its
``hi`` child.  All k! orders are visited by swapping adjacent levels, which
rebuilds the nodes of two levels and nothing else.

Duplicates are rows whose text equals that of a smaller id, whether that one is
kept or not.  The smallest id of each text is found by a map-side minimum and
joined on (text hash, id), so a text with a third of all rows is spread by its
ids; equal rows are counted together before anything is shuffled.

Defined cases: null texts are empty; a null part is the empty string; a null id
comes after every other, so such a row repeats any row with an id and the same
text, but no other row without one; repeated rows of one id are each counted
and none of them repeats another; labels repeated for an id count if any row
holds; labels without an id count nowhere; no documents give no rows; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import rows_of, small_batches
from millrace.session import stage

#: The filters in their order, and signs that one of them looks for.
FILTERS = "ABCDE"
SIGNS = b"#$%&*|"
MIN_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT = 200, 50, 3

_CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_FOLLOWING = bytes(range(0x80, 0xC0))  # bytes that start no code point


class Diagram:
    """Counts by failure mask as a decision diagram over ``names``.

    ``counts[mask]`` is a tuple of numbers; bit i of the mask is set where
    ``names[i]`` fails.  Nodes of level i are (lo, hi) pairs of numbers of nodes
    of level i + 1; those of the last level are the counts themselves.
    """

    def __init__(self, names: str, counts: dict[int, tuple[int, ...]]):
        self.order = list(names)
        self.nothing = (0,) * len(next(iter(counts.values()), (0,)))
        self.leaves: list[tuple[int, ...]] = []
        known: dict = {}
        row = [self._number(known, self.leaves, counts.get(m, self.nothing)) for m in range(1 << len(names))]
        self.nodes: list[list[tuple[int, int]]] = [[] for _ in names]
        for level in reversed(range(len(names))):
            # The highest bit left belongs to this level's filter.
            half, known = len(row) // 2, {}
            row = [self._number(known, self.nodes[level], (row[i], row[i + half])) for i in range(half)]
        self.weights: list[list[tuple[int, ...]]] = [[] for _ in names] + [self.leaves]
        for level in reversed(range(len(names))):
            self._weigh(level)

    @staticmethod
    def _number(known: dict, kept: list, node) -> int:
        if node not in known:
            known[node] = len(kept)
            kept.append(node)
        return known[node]

    def _weigh(self, level: int) -> None:
        below = self.weights[level + 1]
        self.weights[level] = [tuple(map(sum, zip(below[lo], below[hi]))) for lo, hi in self.nodes[level]]

    def swap(self, level: int) -> None:
        """Exchange the filters of ``level`` and the next; nodes above and further below stay as they are."""
        known: dict = {}
        made: list[tuple[int, int]] = []
        lower = self.nodes[level + 1]
        upper = []
        for lo, hi in self.nodes[level]:
            (pass_pass, pass_fail), (fail_pass, fail_fail) = lower[lo], lower[hi]
            first = self._number(known, made, (pass_pass, fail_pass))
            upper.append((first, self._number(known, made, (pass_fail, fail_fail))))
        self.nodes[level], self.nodes[level + 1] = upper, made
        self._weigh(level + 1)
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]

    def steps(self) -> list[tuple[str, tuple[int, ...], tuple[int, ...]]]:
        """(filter, counts kept, counts removed) along the path of passes."""
        out, node = [], 0
        for level, name in enumerate(self.order):
            lo, hi = self.nodes[level][node]
            out.append((name, self.weights[level + 1][lo], self.weights[level + 1][hi]))
            node = lo
        return out


def adjacent_swaps(n: int) -> Iterator[int]:
    """Places i to exchange with i + 1, one after another, so that all n! orders are met once."""
    if n < 2:
        return
    up = False  # whether the last element stands in front and travels to the end next
    for inner in [*adjacent_swaps(n - 1), None]:
        yield from range(n - 1) if up else reversed(range(n - 1))
        up = not up
        if inner is not None:
            # The others make one move; they stand behind the traveller if it is in front.
            yield inner + up


def audit_part(names: str, counts: dict[int, tuple[int, ...]]) -> list[tuple]:
    """(order, step, kept, removed, redundant, unique fails, second and third count removed, Shapley sum) of all orders."""
    diagram = Diagram(names, counts)
    paths = [("".join(diagram.order), diagram.steps())]
    for level in adjacent_swaps(len(names)):
        diagram.swap(level)
        paths.append(("".join(diagram.order), diagram.steps()))
    failing, alone, shapley = {}, {}, dict.fromkeys(names, 0)
    for _, path in paths:
        failing[path[0][0]], alone[path[-1][0]] = path[0][2][0], path[-1][2][0]
        for name, _, removed in path:
            shapley[name] += removed[0]
    return [
        (order, i, kept[0], gone[0], failing[name] - gone[0], alone[name], gone[1], gone[2], shapley[name])
        for order, path in paths
        for i, (name, kept, gone) in enumerate(path, 1)
    ]


# On Spark -------------------------------------------------------------------


def text_failures(data: bytes) -> int:
    """Bits of the first four filters that a text fails."""
    words = data.split()  # of bytes: at ASCII white space
    points = len(data.translate(None, _FOLLOWING))
    capitals = len(data) - len(data.translate(None, _CAPITALS))
    fails = (
        len(words) < MIN_WORDS,
        100 * len(set(words)) < DISTINCT_PERCENT * len(words),
        100 * capitals > CAPITAL_PERCENT * points,
        len(data.translate(None, SIGNS)) < len(data),
    )
    return sum(bit << i for i, bit in enumerate(fails))


def _mask_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [t or b"" for (t,) in rows_of([batch], "_text")]
        keys = pa.array([xxhash.xxh3_128_digest(t) for t in texts], pa.binary())
        masks = pa.array([text_failures(t) for t in texts], pa.int32())
        yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("part"), keys, masks], ["_id", "part", "text_key", "mask"])


def failure_counts(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "lang"
) -> DataFrame:
    """part, mask, docs, good, toxic: counts of documents by the mask of filters failed."""
    small_batches(docs.sparkSession)
    narrow = docs.select(
        F.col(doc_id).alias("_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.col(text).cast("binary").alias("_text")
    )
    kind = dict(narrow.dtypes)["_id"]
    rows = narrow.mapInArrow(_mask_task, f"_id {kind}, part string, text_key binary, mask int")
    rows = stage(rows, "masks").groupBy("_id", "part", "text_key", "mask").agg(F.count("*").alias("n"))
    firsts = rows.groupBy(F.col("text_key").alias("_k")).agg(F.min("_id").alias("_first"))
    rows = rows.join(firsts, (F.col("text_key") == F.col("_k")) & F.col("_id").eqNullSafe(F.col("_first")), "left")
    repeats = F.when(F.col("_k").isNull(), F.lit(1 << (len(FILTERS) - 1))).otherwise(F.lit(0))
    marks = labels.where(F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("_l"))
    marks = marks.agg(*(F.max((F.col(c) == 1).cast("int")).alias(f"_{c}") for c in ("quality", "toxic")))
    rows = rows.join(marks, F.col("_id") == F.col("_l"), "left")
    counted = rows.groupBy("part", F.col("mask").bitwiseOR(repeats).alias("mask"))
    good, toxic = (F.sum(F.col("n") * F.coalesce(F.col(c), F.lit(0))) for c in ("_quality", "_toxic"))
    return counted.agg(F.sum("n").alias("docs"), good.alias("good"), toxic.alias("toxic"))


_STEPS = (
    "part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, "
    "unique_fails bigint, good_lost bigint, toxic_lost bigint, shapley bigint"
)


def audit(counts: DataFrame, names: str = FILTERS) -> DataFrame:
    """One row per part, order of filters and step, from counts by mask (bit i set: ``names[i]`` fails).

    ``counts`` has part, mask, docs, good and toxic.  Each part is one small row
    with at most 2^k counts; parts are worked on side by side.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, masks in rows_of(batches, "part", "masks"):
            table = {m["mask"]: (m["docs"], m["good"], m["toxic"]) for m in masks}
            columns = zip(*((part, *row) for row in audit_part(names, table)))
            kinds = [pa.string(), pa.string(), pa.int32(), *[pa.int64()] * 7]
            titles = [field.split()[0] for field in _STEPS.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], titles)

    whole = counts.groupBy("part", "mask").agg(*(F.sum(c).alias(c) for c in ("docs", "good", "toxic")))
    parts = whole.groupBy("part").agg(F.collect_list(F.struct("mask", "docs", "good", "toxic")).alias("masks"))
    return parts.mapInArrow(run, _STEPS)
