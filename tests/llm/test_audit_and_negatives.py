"""Filter audit and hard negatives against plain versions."""

from __future__ import annotations

import itertools
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import bond_negatives, filter_audit
from tests.llm.plain import DOCS, awkward

# Filter audit ---------------------------------------------------------------


def plain_failures(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    return (
        len(words) < 200,
        100 * len(set(words)) < 50 * len(words),
        100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
        bool(re.search(r"[#$%&*|]", text)),
    )


def plain_steps(names, masks):
    """Rows of all orders from (mask, good, toxic) of every document of a part."""
    bit = {f: 1 << i for i, f in enumerate(names)}
    rows, shapley = [], Counter()
    for order in itertools.permutations(names):
        left = list(masks)
        for step, f in enumerate(order, 1):
            gone = [m for m in left if m[0] & bit[f]]
            left = [m for m in left if not m[0] & bit[f]]
            shapley[f] += len(gone)
            failing = sum(1 for m in masks if m[0] & bit[f])
            alone = sum(1 for m in masks if m[0] == bit[f])
            counts = (len(left), len(gone), failing - len(gone), alone, sum(m[1] for m in gone), sum(m[2] for m in gone))
            rows.append(("".join(order), step, *counts, f))
    return [(*r[:-1], shapley[r[-1]]) for r in rows]


@pytest.mark.parametrize("n", range(1, 6))
def test_swaps_meet_every_order_once(n):
    order, met = list("ABCDE"[:n]), {"ABCDE"[:n]}
    for i in filter_audit.adjacent_swaps(n):
        order[i], order[i + 1] = order[i + 1], order[i]
        met.add("".join(order))
    assert len(met) == math.factorial(n) == 1 + len(list(filter_audit.adjacent_swaps(n)))


def test_diagram_against_counting():
    rng = random.Random(2)
    for names in ("A", "AB", "ABCD", "ABCDE"):
        masks = [(rng.randrange(1 << len(names)) & rng.randrange(1 << len(names)), rng.random() < 0.3, rng.random() < 0.1) for _ in range(200)]
        table = defaultdict(lambda: (0, 0, 0))
        for m, good, toxic in masks:
            table[m] = tuple(map(sum, zip(table[m], (1, good, toxic))))
        assert sorted(filter_audit.audit_part(names, table)) == sorted(plain_steps(names, masks))


def test_a_swap_rebuilds_two_levels_and_keeps_all_paths():
    rng = random.Random(3)
    counts = {m: (rng.randrange(9),) for m in range(32)}
    diagram = filter_audit.Diagram("ABCDE", counts)

    def count_of(mask):
        node = 0
        for level, name in enumerate(diagram.order):
            node = diagram.nodes[level][node][mask >> "ABCDE".index(name) & 1]
        return diagram.leaves[node]

    for level in (0, 3, 2, 1, 2, 0):
        before = [list(nodes) for nodes in diagram.nodes]
        diagram.swap(level)
        assert all(diagram.nodes[i] == before[i] for i in range(5) if i not in (level, level + 1))
        assert all(count_of(m) == c for m, c in counts.items())
    alike = filter_audit.Diagram("ABC", {m: (7,) for m in range(8)})
    assert [len(nodes) for nodes in alike.nodes] == [1, 1, 1]


def test_audit_of_awkward_rows(spark):
    rows = [(*r[:2], None if k % 5 == 0 else f"l{k % 2}", *r[3:]) for k, r in enumerate(awkward())] + [(None, "one two", "l1", "s", 1)]
    marks = [(0, 1, 0), (0, None, 1), (1, 1, None), (None, 1, 1), (60, 0, 1), (999, 1, 1)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("mask", F.lit("x")).withColumn("_id", F.lit(7)).withColumnRenamed("source", "part").repartition(3)
    labels = spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int")
    good, toxic = {0, 1}, {0, 60}
    ids = defaultdict(list)
    for i, t, *_ in rows:
        ids[t or ""].append(math.inf if i is None else i)
    parts = defaultdict(list)
    for i, t, lang, *_ in rows:
        fails = (*plain_failures(t or ""), (math.inf if i is None else i) > min(ids[t or ""]))
        parts[lang or ""].append((sum(b << k for k, b in enumerate(fails)), i in good, i in toxic))
    got = Counter(tuple(r) for r in filter_audit.audit(filter_audit.failure_counts(docs, labels)).collect())
    assert got == Counter((part, *step) for part, masks in parts.items() for step in plain_steps("ABCDE", masks))
    assert filter_audit.audit(filter_audit.failure_counts(docs.limit(0), labels)).count() == 0


# Hard negatives -------------------------------------------------------------


def plain_negatives(rows, anchors, labels):
    """Counter of result rows over all pairs; rows are numbered, so copies are rows of their own."""
    fit = []
    for n, (vec_id, x) in enumerate(rows):
        if labels[n] is not None and x is not None and all(v is not None and math.isfinite(v) for v in x):
            fit.append((n, vec_id, [max(-(2**24), min(2**24, math.floor(256 * v))) for v in x]))
    by_rank = lambda r: (-r[0], r[1] is None, r[1] or 0)
    out = Counter()
    for n, vec_id, x in fit:
        if not anchors[n]:
            continue
        scored = [(sum(a * b for a, b in zip(x, y)), other, labels[m] == labels[n]) for m, other, y in fit if m != n]
        for p, positive, _ in sorted((r for r in scored if r[2]), key=by_rank)[:5]:
            found = sorted((r for r in scored if not r[2] and 30 * p <= 100 * r[0] <= 90 * p), key=by_rank)[:10]
            for rank, (score, negative, _) in enumerate(found, 1):
                out[vec_id, positive, rank, negative, p, score] += 1
    return out


def crowd(n, dims=12, seed=1):
    rng = np.random.default_rng(seed)
    heart = rng.normal(size=dims)
    common = [0.25] * dims
    rows = [(i, common if i % 3 == 0 else [float(v) for v in rng.normal(size=dims) * 0.4 + heart]) for i in range(n)]
    return rows, [int(v) for v in rng.integers(0, 3, n)]


VECTORS = "vec_id bigint, embedding array<double>, label int, block string, rows int"


def mined(spark, rows, labels, parts):
    data = [(i, x, label, "x", 1) for (i, x), label in zip(rows, labels)]
    frame = spark.createDataFrame(data, VECTORS).repartition(parts)
    got = bond_negatives.hard_negatives(frame, F.col("vec_id") % 20 == 0, F.col("label"))
    return Counter(tuple(r) for r in got.collect())


def test_negatives_against_all_pairs(spark, monkeypatch):
    rows, labels = crowd(300)
    want = plain_negatives(rows, [i % 20 == 0 for i, _ in rows], labels)
    assert len(want) > 100 and mined(spark, rows, labels, 3) == want
    monkeypatch.setattr(bond_negatives, "BLOCK_ROWS", 23)
    monkeypatch.setattr(bond_negatives, "PACK_ROWS", 2)
    assert mined(spark, rows, labels, 2) == want


def test_negatives_of_awkward_vectors(spark):
    rows, labels = crowd(60, 5, 2)
    rows += [(None, rows[20][1]), (20, rows[20][1]), (20, rows[20][1]), (100, None), (101, [None, 1.0]), (102, [math.nan]), (103, [math.inf, 1.0])]
    rows += [(120, []), (121, [1e300, -1e300]), (140, [0.5, 0.5]), (141, rows[2][1] + [3.0]), (160, rows[3][1])]
    labels += [labels[20], labels[20], labels[20], 1, 1, 1, 1, 1, 1, 1, 0, None]
    want = plain_negatives(rows, [i is not None and i % 20 == 0 for i, _ in rows], labels)
    got = mined(spark, rows, labels, 3)
    assert got == want and any(k[1] is None or k[3] is None for k in got)
    assert mined(spark, [], [], 1) == Counter()


def test_cuts_leave_all_that_counts():
    rng = np.random.default_rng(4)
    rows, labels = crowd(500, 24, 5)
    block = bond_negatives.Block(bond_negatives.vertical([i for i, _ in rows], labels, [x for _, x in rows]))
    cells = block.cells.astype(np.int64)
    everyone = np.arange(500)
    for anchor in rng.integers(-300, 300, (10, 24)):
        exact = anchor @ cells
        at, scores = bond_negatives.scan(block, anchor, everyone, bond_negatives.best_cut(5))
        assert (exact[at] == scores).all() and set(np.flatnonzero(exact > np.sort(exact)[-6])) <= set(at.tolist())
        windows = [(-500, 200), (int(np.sort(exact)[250]), int(exact.max()))]
        at, scores = bond_negatives.scan(block, anchor, everyone, bond_negatives.window_cut(windows, 3))
        assert (exact[at] == scores).all() and len(at) < 500
        for low, high in windows:
            inside = np.flatnonzero((exact >= low) & (exact <= high))
            assert set(block.first(inside, exact[inside], 3)[0].tolist()) <= set(at.tolist())
    for p in (-7, 0, 1, 10, 999):
        low, high = bond_negatives.window_of(p)
        assert [n for n in range(-1000, 1001) if 30 * p <= 100 * n <= 90 * p] == list(range(low, high + 1))
