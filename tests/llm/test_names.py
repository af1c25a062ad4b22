"""Operators that return the columns of their input, on tables with columns of the names that the operators use themselves."""

from __future__ import annotations

import inspect
import random
import re

import pytest
from pyspark.sql import functions as F

from millrace.llm import decontaminate, extendible, line_frequency, mil_quality, simhash_trie, soft_mix

LABELS = [(i, i % 2, 0) for i in range(40)]


def names_in(module, docs):
    """Names that the module's code has between quotes, and names with an underscore in lines with quotes."""
    source = inspect.getsource(module)
    quoted = set(re.findall(r"""["'](_?[A-Za-z][A-Za-z_0-9]*)["']""", source)) | set(re.findall(r"\b_[a-z]+\b(?=[^\n]*[\"'])", source))
    own = {c.lower() for c in docs.columns}
    more = {"_s0", "_p0", "_p1", "_leaf6", "_leaf12", "shard_2", "doc"}
    return sorted({n.lower() for n in quoted | more} - own)


def rows():
    rng = random.Random(1)
    fresh = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    common = fresh(30)
    bodies = [f"{fresh(60)}\n{common}" for _ in range(38)] + [None, ""]
    return [(i, bodies[i], "en", "a", 1) for i in range(40)] + [(40, bodies[0], "en", "a", 1)]


OPERATORS = {
    "quality": (mil_quality, lambda spark, d: mil_quality.keep_good(d, labels(spark), 0.0)),
    "two bits": (simhash_trie, lambda spark, d: simhash_trie.keep_first(d)),
    "similar": (simhash_trie, lambda spark, d: simhash_trie.keep_first_similar(d)),
    "lines": (line_frequency, lambda spark, d: line_frequency.remove_lines(d, 20, 0.001, 0.9)),
    "dropped": (decontaminate, lambda spark, d: decontaminate.remove_contaminated(d, benchmark(spark, d), 10)),
    "cut": (decontaminate, lambda spark, d: decontaminate.remove_contaminated(d, benchmark(spark, d), 10, 0.9)),
    "mixed": (soft_mix, lambda spark, d: soft_mix.mixed(d, soft_mix.domains_of_labels(labels(spark)), {"fine": 0.5, "poor": 0.5})),
    "shards": (extendible, lambda spark, d: extendible.assign_shards(d, 2_000)),
}


def labels(spark):
    return spark.createDataFrame(LABELS, "doc_id bigint, quality int, toxic int")


def benchmark(spark, docs):
    text = rows()[1][1].split("\n")[0]
    return spark.createDataFrame([("b", " ".join(text.split()[5:20]))], "item_id string, text string")


@pytest.mark.parametrize("name", OPERATORS)
def test_columns_keep_their_values(spark, name):
    module, run = OPERATORS[name]
    docs = spark.createDataFrame(rows(), "doc_id bigint, text string, lang string, source string, n_chars bigint")
    extra = names_in(module, docs)
    assert len(extra) > 10
    wide = docs.select("*", *[F.concat(F.lit(f"{n} "), F.coalesce(F.col("doc_id").cast("string"), F.lit("?"))).alias(n) for n in extra])
    plain = run(spark, docs)
    got = run(spark, wide)
    assert got.columns[: len(wide.columns)] == wide.columns
    kept = got.collect()
    assert all(r[n] == f"{n} {r.doc_id}" for r in kept for n in extra)
    assert sorted((r.doc_id, r.text or "") for r in kept) == sorted((r.doc_id, r.text or "") for r in plain.collect()) and kept
    if name == "shards":
        assert got.columns[-1] not in wide.columns and any(r[-1] for r in kept)
