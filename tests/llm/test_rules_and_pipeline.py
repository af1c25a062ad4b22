"""Line frequency, the attention classifier, and the pipeline."""

from __future__ import annotations

import collections
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import line_frequency, mil_quality
from tests.llm.plain import DOCS, awkward, held_out, hits, similar_groups

FOLDER = "/root/testdata/sf0.001"


def plain_measures(text):
    cut = lambda t: [w for w in re.split(r"[\x20\x09-\x0D]+", t) if w]
    text = text or ""
    words = cut(text)
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = collections.Counter(grams)
    inside = {i + k for i, g in enumerate(grams) if often[g] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if cut(x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside)


def test_measures():
    for _, text, *_ in awkward():
        assert line_frequency.measure((text or "").encode())[:5] == plain_measures(text)


def test_lines_over_the_limit(spark):
    rng = random.Random(3)
    fresh = lambda n: " ".join(f"w{rng.randrange(10**9)}x" for _ in range(n))
    shared = "The Same Line 12 in  all of them " + fresh(30).replace("0", "1")
    rows = [(k, f"{fresh(60)}\n{shared.upper() if k % 2 else shared}", "en", "a", 1) for k in range(30)]  # loses less than half
    rows += [(100 + k, f"{fresh(25)}\n{shared}", "en", "a", 1) for k in range(30)]  # loses more
    rows += [(200 + k, f"{fresh(25)}\n{shared}", "en", "b", 1) for k in range(5)]  # rare on its host
    rows += [(300 + k, None, "en", None, 1) for k in range(3)]
    got = {r.doc_id: r for r in line_frequency.judge_lines(spark.createDataFrame(rows, DOCS).withColumnRenamed("lang", "n"), 20, 0.001, 0.5).collect()}
    assert all(got[k].kept for k in range(30)) and not any(got[100 + k].kept for k in range(30))
    assert all(got[200 + k].kept and not got[200 + k].n_removed_words for k in range(5))
    assert all(got[300 + k].base_failed and not got[300 + k].kept for k in range(3))


def test_lines_are_removed(spark):
    rng = random.Random(4)
    fresh = lambda n: " ".join(f"w{rng.randrange(10**9)}x" for _ in range(n))
    shared = "Subscribe to our 12 letters  today"
    heads = [fresh(60) for _ in range(30)]
    rows = [(7, f"{h}\n\n{shared.upper() if k % 2 else shared}\n end {k}x {h[:9]}", "en", "a", 1) for k, h in enumerate(heads)]
    rows += [(100, f"{heads[0]} more\n{shared}", "en", "b", 1), (101, None, "en", "a", 1)]
    rows += [(200 + k, f"{fresh(51)}\n" + f"{shared}\n" * 7, "en", "a", 1) for k in range(3)]  # loses less than half
    docs = spark.createDataFrame(rows, DOCS).withColumnRenamed("lang", "kept").repartition(3)
    got = line_frequency.remove_lines(docs, 20, 0.001, 0.5)
    texts = collections.Counter((r.doc_id, r.text) for r in got.collect())
    want = collections.Counter((7, f"{h}\n\n end {k}x {h[:9]}") for k, h in enumerate(heads))
    want += collections.Counter({(100, rows[30][1]): 1})
    want += collections.Counter((r[0], r[1].split("\n")[0] + "\n") for r in rows if 200 <= r[0] < 300)
    assert texts == want and got.schema == docs.schema
    assert line_frequency.remove_lines(docs.limit(0)).count() == 0


def test_awkward_rows(spark):
    docs = spark.createDataFrame(awkward(), DOCS)
    got = line_frequency.judge_lines(docs)
    want = collections.Counter((i, *plain_measures(t)) for i, t, *_ in awkward())
    assert collections.Counter(tuple(r)[:6] for r in got.collect()) == want
    assert line_frequency.judge_lines(docs.limit(0)).count() == 0


def test_gradient_by_differences():
    rng = np.random.default_rng(0)
    m = {k: v.astype(np.float64) for k, v in mil_quality._start(1).items()}
    x, starts, y = rng.random((7, mil_quality.BUCKETS + mil_quality.SHAPES)), np.array([0, 3, 4]), np.array([1.0, 0.0, 1.0])

    def loss():
        p = mil_quality._forward(m, x, starts)[0]
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    grads = mil_quality._gradient(m, x, starts, y)
    for name in "WVUwcbd":
        at = tuple(rng.integers(0, n) for n in m[name].shape)
        kept, step = m[name][at], 1e-5
        m[name][at] = kept + step
        up = loss()
        m[name][at] = kept - step
        down = loss()
        m[name][at] = kept
        assert abs((up - down) / (2 * step) - grads[name][at]) < 1e-5, name


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = mil_quality.fit(docs, labels.where(~mil_quality.held_out()))
    both = mil_quality.scores(docs, model).join(labels, "doc_id").withColumn("held", mil_quality.held_out()).collect()
    assert all(r.held == held_out(r.doc_id) for r in both)
    own = [r for r in both if r.held]
    assert len(own) > 50 and sum((r.score >= 0.7) == (r.quality == 1) for r in own) >= 0.95 * len(own)


def plain_forward(m, text):
    """The score of one text, passage by passage, from the formulas of the model."""
    x = mil_quality.encode(text).astype(np.float64)
    sigmoid = lambda v: 1 / (1 + np.exp(-v))
    hidden = [np.tanh(m["W"] @ p + m["b"]) if m["W"].shape[1] == len(p) else np.tanh(p @ m["W"] + m["b"]) for p in x]
    gate = [m["w"] @ (np.tanh(m["V"] @ h) * sigmoid(m["U"] @ h)) if m["V"].shape[1] == len(h) else m["w"] @ (np.tanh(h @ m["V"]) * sigmoid(h @ m["U"])) for h in hidden]
    weights = np.exp(gate - np.max(gate))
    pooled = sum(a * h for a, h in zip(weights / weights.sum(), hidden))
    return float(sigmoid(m["c"] @ pooled + m["d"][0]))


def test_scores_by_the_formulas(spark):
    rows = awkward()[:30] + [(500, "one two three " * 20_000, "en", "s", 1)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id bigint, quality int")
    docs = spark.createDataFrame(rows, DOCS)
    model = mil_quality.fit(docs, labels)
    unpacked = {k: v.astype(np.float64) for k, v in mil_quality._unpack(model).items()}
    got = {r.doc_id: r.score for r in mil_quality.scores(docs, model).collect()}
    assert all(abs(got[i] - plain_forward(unpacked, (t or "").encode())) < 1e-4 for i, t, *_ in rows)


def test_training_takes_one_text_an_id_and_keeps_to_its_bounds(spark):
    rng = random.Random(5)
    words = lambda n: " ".join(f"w{rng.randrange(99)}" for _ in range(n))
    rows = [(i, words(50)) for i in range(20)]
    more = rows + [(3, words(40_000)) for _ in range(5)] + [(3, rows[3][1])] * 5
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id bigint, quality int")
    frame = lambda r: spark.createDataFrame(r, "doc_id bigint, text string").repartition(3)
    own = next(t for t in sorted({t for i, t in more if i == 3}, key=lambda t: xxhash.xxh64_intdigest(t.encode(), 42) ^ 1 << 63))
    single = [(i, own if i == 3 else t) for i, t in rows]
    assert mil_quality.fit(frame(more), labels) == mil_quality.fit(frame(single), labels)
    size = sum(len(t) for _, t in rows)
    assert mil_quality.fit(frame(rows), labels, sample_bytes=size) == mil_quality.fit(frame(rows), labels)
    assert mil_quality.fit(frame(rows), labels, sample_bytes=size - 1) != mil_quality.fit(frame(rows), labels)


def test_scores_of_awkward_rows(spark):
    docs = spark.createDataFrame(awkward(), DOCS).withColumnRenamed("lang", "score")
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (None, 1), (3, None), (999, 0)], "doc_id bigint, quality int")
    model = mil_quality.fit(docs, labels)
    got = mil_quality.scores(docs, model).collect()
    assert len(got) == len(awkward()) and all(0 <= r.score <= 1 for r in got)
    none = mil_quality.fit(docs, labels.limit(0))
    assert {round(r.score, 3) for r in mil_quality.scores(docs, none).collect()} == {0.5}
    assert mil_quality.scores(docs.limit(0), model).count() == 0
    assert mil_quality.keep_good(docs, labels).columns == docs.columns


def test_pipeline_against_its_plain_version(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    names = dict(corpus_pipeline.STAGES)
    good = names["quality"](spark, docs, FOLDER)
    model = mil_quality.fit(docs, spark.read.parquet(f"{FOLDER}/labels.parquet").where(~mil_quality.held_out()))
    passed = {r.doc_id for r in mil_quality.scores(docs, model).where("score >= 0.7").collect()}
    rows = {r.doc_id: r.text for r in good.collect()}
    assert set(rows) == passed
    first = set(similar_groups(list(rows.items()), 5, 0.8).values())
    unique = names["near_dedup"](spark, good, FOLDER)
    assert {r.doc_id for r in unique.collect()} == first
    items = {r.item_id: r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()}
    clean = names["decontaminated"](spark, unique, FOLDER)
    assert sorted(r.doc_id for r in clean.collect()) == sorted(i for i in first if not hits(rows[i], items, 10)[1])
    out = corpus_pipeline.run(spark, FOLDER)
    assert out.columns == [*docs.columns, "shard"] and 0 < out.count()
    assert {r.doc_id for r in out.collect()} <= {r.doc_id for r in clean.collect()}


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_take_awkward_and_empty_tables(spark, stage):
    docs = spark.createDataFrame(awkward(), DOCS).withColumn("score", F.lit("x")).withColumn("_extra", F.lit(1))
    step = dict(corpus_pipeline.STAGES)[stage]
    got = step(spark, docs, FOLDER)
    assert got.columns[: len(docs.columns)] == docs.columns and got.count() > 0
    assert step(spark, docs.limit(0), FOLDER).count() == 0
