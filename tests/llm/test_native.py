"""The operators built from SQL functions, against plain versions and on awkward rows."""

from __future__ import annotations

import collections
import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import bloom_cascade, decontaminate, extendible, secret_tests, soft_mix
from millrace.llm.queries import BLOCK_WORDS, URL_RULES
from tests.llm.plain import DOCS, awkward, base_spans, hits

BENCH = "item_id bigint, text string, n_hit int"


def no_python(df):
    plan = df._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))


# Bloom cascade


@pytest.mark.parametrize("per", [5, 200_000])
def test_cascade_is_exact(spark, per):
    rng = random.Random(2)
    hosts = [".".join(rng.choice("abcdef") * rng.randrange(1, 3) for _ in range(rng.randrange(1, 4))) for _ in range(300)]
    paths = ["", "/", "/x/", "/x/y", "/z"]
    pages = [(k, rng.choice(hosts), rng.choice(paths)) for k in range(600)] + [(601, "", "")]
    listed = {(rng.choice(hosts), rng.choice(paths[1:])) for _ in range(40)}
    got = bloom_cascade.longest_listed(
        spark.createDataFrame(pages, "page_id int, host string, path string"),
        spark.createDataFrame(sorted(listed) + [(None, "/")], "host string, path string"), "found", per,
    )
    for r in got.collect():
        fits = [h + p for h, p in listed if r.host and (r.host == h or r.host.endswith("." + h)) and r.path.startswith(p)]
        assert r.found in (sorted(x for x in fits if len(x) == max(map(len, fits))) if fits else [None])



def test_judge_urls(spark):
    urls = [
        None, "", "example.com/en/", "http://EXAMPLE.com/en/1", "https://www.example.com/en/?q", "http://a.b.net/es/x#y", "http://net/fr/",
        "http://x.org", "http://spam-farm.example.org/de", "http://m.free-bets.example.net/en", "http://notspam.example.org/", "http://example.com?/en/",
    ]
    pages = spark.createDataFrame([(k, u, "h", "x") for k, u in enumerate(urls)] * 2, "page_id int, url string, host string, verdict string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in bloom_cascade.judge_urls(pages, URL_RULES, BLOCK_WORDS).collect()}
    assert got[0] == got[1] == got[2] == ("", "", None, "allow")
    assert got[3] == ("example.com", "/en/1", "example.com/en/", "block")
    assert got[4][2:] == ("www.example.com/en/", "allow") and got[5][2:] == ("net/es/", "block") and got[6][2:] == ("net/fr/", "block")
    assert [got[k][2:] for k in (7, 8, 9, 10)] == [(None, "allow"), (None, "block"), (None, "block"), (None, "allow")]
    assert got[11] == ("example.com", "", None, "allow")
    assert bloom_cascade.judge_urls(pages.limit(0), URL_RULES, BLOCK_WORDS).count() == 0


# Decontamination


def benchmark():
    docs = [t for _, t, *_ in awkward() if t and len(t.split()) > 40]
    words = docs[0].split()
    return [
        (1, " ".join(words[3:25]), 0), (2, " ".join(words[20:34]).upper(), 0), (3, "one two", 0), (4, None, 0), (5, " .. ", 0),
        (1, " ".join(words[3:25]), 0), (12, "Word", 0), (7, "wholly other words that occur in no document of this test", 0),
    ]


def test_contamination(spark):
    rows = awkward()
    docs, bench = spark.createDataFrame(rows, DOCS).withColumnRenamed("lang", "n_hit"), spark.createDataFrame(benchmark(), BENCH)
    found = decontaminate.contamination(docs, bench)
    no_python(found)
    got = collections.Counter(tuple(r)[:1] + tuple(r)[2:] for r in found.collect())
    items = {i: t for i, t, _ in benchmark()}
    want = collections.Counter()
    for i, t, *_ in rows:
        n, places, ids = hits(t, items, 10)
        names = ",".join(sorted(map(str, ids)))
        want[i, n, len(places), len(ids), hashlib.sha256(names.encode()).hexdigest(), bool(places)] += 1
    assert got == want
    kept = decontaminate.remove_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(str(i) for i, t, *_ in rows if not hits(t, items, 10)[1])
    assert decontaminate.contamination(docs.limit(0), bench).count() == 0
    assert decontaminate.contamination(docs, bench.limit(0)).where("contaminated").count() == 0


def test_spans_are_cut_out(spark):
    docs = spark.createDataFrame([(1, "Keep this, then one two; and more of it. End"), (2, "one two")], "doc_id int, text string")
    bench = spark.createDataFrame([(3, "One two")], "item_id int, text string")
    kept = decontaminate.remove_contaminated(docs, bench, drop_share=0.5).collect()
    assert [tuple(r) for r in kept] == [(1, "Keep this, then and more of it. End")]


# Soft mixing


def test_rates_meet_targets(spark):
    rng = random.Random(4)
    rows = []
    for k in range(600):
        kind = k % 3
        mark = [[], ["!!", "***"], ["scum", "trash"]][kind]
        rows.append((k, " ".join(rng.choice(["the", "of", "and", "ring", *mark]) for _ in range(60)), ["fine", "poor", "toxic"][kind], "x"))
    docs = spark.createDataFrame(rows, "doc_id int, text string, domain string, rate string")
    labels = docs.where("doc_id % 2 = 0").select("doc_id", "domain")
    targets = {"fine": 0.6, "poor": 0.25, "toxic": 0.15}
    got, model, history, eta = soft_mix.mix(docs.select("doc_id", "text", "rate"), labels, targets)
    no_python(got)
    rows = got.collect()
    total = sum(r.n_tokens for r in rows)
    for name, share in targets.items():
        assert abs(sum(r.rate * r.n_tokens * r[f"p_{name}"] for r in rows) / total - share) < 0.002
    right = sum(max(targets, key=lambda d: r[f"p_{d}"]) == ["fine", "poor", "toxic"][r.doc_id % 3] for r in rows)
    assert right > 570 and all(r.rate >= 0 for r in rows)
    for r in rows[:50]:  # the fitted rates, by the same steps in Python
        rate = 1.0
        for e in history:
            rate = max(0.0, rate - eta * sum(r[f"p_{d}"] * x for d, x in zip(targets, e)))
        assert math.isclose(rate, r.rate, abs_tol=1e-9)
    twice = soft_mix.mixed(docs.select("doc_id", "text"), labels, targets).groupBy("doc_id").count().collect()
    often = {r.doc_id: r["count"] for r in twice}
    want = got.select("doc_id", soft_mix.copies(F.col("rate"), F.col("doc_id")).alias("n")).collect()
    assert {r.doc_id: r.n for r in want if r.n} == often


def rated(spark, posteriors, tokens, targets):
    names = ", ".join(f"_p{k} double" for k in range(len(targets)))
    table = spark.createDataFrame([(n, *p) for n, p in zip(tokens, posteriors)], f"_tokens bigint, {names}")
    history, eta = soft_mix.fit_rates(table, dict(zip("abc", targets)))
    return np.array([r[0] for r in table.select(soft_mix._rate(history, eta, len(targets))).collect()]), history


def metric(p, n):
    """The inverse of the posteriors' products, with the ridge."""
    g = p.T @ (n[:, None] * p)
    return np.linalg.inv(g + soft_mix.RIDGE * np.trace(g) / len(g) * np.eye(len(g)))


def plain_rates(posteriors, tokens, targets, steps=20_000):
    """Nonnegative least squares in that metric, by many small steps."""
    p, n = np.array(posteriors), np.array(tokens) / sum(tokens)
    inverse, rate = metric(p, n), np.ones(len(p))
    for _ in range(steps):
        rate = np.maximum(0, rate - 0.5 * p @ (inverse @ (p.T @ (n * rate) - targets)))
    return rate


def test_rates_against_nonnegative_least_squares(spark):
    rng = np.random.default_rng(3)
    loose = rng.dirichlet([0.4, 0.4, 0.4], 60)
    mixed = [[0.5, 0.3, 0.2]] * 30 + [[0.6, 0.2, 0.2]] * 30  # no rates give a third domain of 0.9
    for posteriors, targets, met in ((loose, [0.7, 0.2, 0.1], True), (loose, [0.05, 0.05, 0.9], True), (mixed, [0.05, 0.05, 0.9], False)):
        tokens = rng.integers(1, 500, 60)
        got, _ = rated(spark, [tuple(map(float, p)) for p in posteriors], [int(n) for n in tokens], targets)
        want = plain_rates(posteriors, tokens, targets)
        p, n = np.array(posteriors), tokens / tokens.sum()
        inverse = metric(p, n)
        height = lambda r: float((p.T @ (n * r) - targets) @ inverse @ (p.T @ (n * r) - targets))
        assert height(got) <= height(want) * 1.02 + 1e-5 and (height(got) < 1e-4) == met and got.min() >= 0


def test_a_rare_domain_reaches_its_target(spark):
    """Two clean domains at 0.99 and 0.01, asked for in equal parts."""
    got, history = rated(spark, [(1.0, 0.0)] * 99 + [(0.0, 1.0)], [100] * 100, [0.5, 0.5])
    assert np.allclose(got, [0.5 / 0.99] * 99 + [50.0], rtol=2e-3) and len(history) < 5


def test_a_domain_without_documents_is_missed_without_end_of_copies(spark):
    got, _ = rated(spark, [(1.0 - 1e-9, 1e-9)] * 10, [5] * 10, [0.5, 0.5])
    assert got.max() <= soft_mix.MOST_RATE


def test_mixing_of_awkward_rows(spark):
    docs = spark.createDataFrame(awkward(), DOCS).withColumnRenamed("lang", "rate")
    labels = spark.createDataFrame([(1, 1, 0), (2, None, None), (None, 1, 1), (999, 0, 0)], "doc_id bigint, quality int, toxic int")
    named = soft_mix.domains_of_labels(labels)
    got, *_ = soft_mix.mix(docs, named, {"fine": 1.0, "poor": 1.0})
    assert got.count() == len(awkward())
    assert soft_mix.mix(docs.limit(0), named, {"fine": 1.0, "poor": 1.0})[0].count() == 0
    assert soft_mix.mixed(docs, named.limit(0), {"fine": 1.0, "poor": 1.0}).columns == docs.columns


# Secret tests


def secrets():
    rng = random.Random(9)
    token = lambda chars, n: "".join(rng.choice(chars) for _ in range(n))
    hexes = [token("0123456789abcdef", 40) for _ in range(5)]
    b62 = [token("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", 40) for _ in range(30)]
    words = ["thing" * 6, "onthtionwhonattionnd", "aaaaaaaaaaaaaaaaaaaaaaaa", "the-name-of-a-long-page-about-things"]
    texts = [f"é\U0001f600 token = \"{hexes[0]}\" and PASSWORD:'abcdef' secret:token:abcdef api-key=x", f"AKIA{'Q' * 16} AKIA123 {hexes[1]}"]
    return texts + [f"see {t} here" for t in b62] + [f"see {w} here" for w in words], b62, words


def test_base_spans(spark):
    texts, _, _ = secrets()
    rows = awkward() + [(100 + k, t, "en", "s", 1) for k, t in enumerate(texts)]
    found = secret_tests.scan(spark.createDataFrame(rows, DOCS).withColumnRenamed("lang", "base"))
    no_python(found)
    got = collections.Counter((r.doc_id, tuple(tuple(s) for s in r.base)) for r in found.collect())
    assert got == collections.Counter((i, tuple(base_spans(t))) for i, t, *_ in rows)


def test_randomness(spark):
    texts, random_runs, words = secrets()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    added = {r.doc_id: [(s["start"], s["end"]) for s in r.added] for r in secret_tests.scan(docs).collect()}
    found = sum(added[k + 2] == [(4, 44)] for k in range(len(random_runs)))
    assert found >= len(random_runs) - 2
    assert not any(added[k] for k in range(2 + len(random_runs), len(texts)))
    assert secret_tests.scan(docs.limit(0)).count() == 0


# Extendible hashing


def plain_shards(rows, limit):
    hashed = [(int(hashlib.md5(str(i).encode()).hexdigest()[:13], 16), len((t or "").encode())) for i, t in rows]
    out = []
    for h, _ in hashed:
        for depth in range(53):
            inside = [n for g, n in hashed if g >> (52 - depth) == h >> (52 - depth)]
            if sum(inside) <= limit or len(inside) == 1:
                out.append(f"{h:052b}"[:depth])
                break
    return out


def test_shards_fit(spark):
    rng = random.Random(1)
    rows = [(k, "x" * rng.randrange(200)) for k in range(400)] + [(400, "y" * 900), (401, None), (402, "")]
    docs = spark.createDataFrame(rows, "doc_id int, text string").withColumn("leaf", F.lit(1))
    got = extendible.assign_shards(docs, 700)
    no_python(got)
    assert got.columns == [*docs.columns, "shard"]
    assert {r.doc_id: r.shard for r in got.collect()} == dict(zip([i for i, _ in rows], plain_shards(rows, 700)))
    sizes = extendible.shard_sizes(got).collect()
    assert all(r.shard_bytes <= 700 or r.shard_docs == 1 for r in sizes) and sum(r.shard_docs for r in sizes) == len(rows)


def test_hot_key_is_split(spark):
    rows = [(7, "z" * 100)] * 300 + [(None, "n" * 50)] * 100 + [(k, "a" * 40) for k in range(100, 200)]
    got = extendible.assign_shards(spark.createDataFrame(rows, "doc_id int, text string"), 2_000)
    sizes = extendible.shard_sizes(got).collect()
    assert sum(r.shard_docs for r in sizes) == 500 and max(r.shard_bytes for r in sizes) <= 2_000


def test_no_rows_to_shard(spark):
    docs = spark.createDataFrame([], DOCS)
    assert extendible.assign_shards(docs, 10).count() == 0
    with pytest.raises(ValueError):
        extendible.assign_shards(docs, 0)
