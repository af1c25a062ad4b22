"""Mixing by soft membership.

A naive-Bayes classifier learned from a labelled table gives each document
posteriors over domains.  Nonnegative rates per document are then fitted by
projected gradient so that the expected tokens of each domain,

    T_k = sum over documents of rate * tokens * posterior_k,

match the targets t in least squares.  From rate 1, step

    rate <- min(MOST_RATE, max(0, rate - sum_k posterior_k * x_k)),  G x = T - t

with T and t as shares of all tokens and G the K x K matrix of the posteriors'
products, weighted by tokens, over documents whose rate is not 0, with a small
multiple of the unit matrix.  So scaled, rare domains move as fast as common ones,
and few steps are exact.  Misses are measured by the inverse of the first G.  Each iteration is one distributed sum of K
numbers over the posterior table; the driver keeps only these steps, and a rate is
recomputed from them, so nothing is cached or rewritten between iterations.

The classifier sees whether terms occur: words, signs split from words, and
three terms for the share of distinct words.  It is fitted on at most
``sample`` labelled documents (those with the smallest id hashes); everything
else covers all documents.

Defined cases: null texts are empty and get the posterior of an empty text; a
document without tokens gets a rate and adds nothing to any total; labels of
unknown or null ids or with nulls are ignored; without any label posteriors are
the targets and all rates one; repeated ids get equal rates; other columns are
left alone.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import pack, unpack
from millrace.session import stage

#: Rates of the temperatures tried; the one with the best likelihood on held-out labels stays.
TEMPERATURES = (1.0, 2.0, 4.0, 8.0, 16.0, 32.0)
DRAW = 1 << 20
#: No document is taken more often: a domain that hardly any document belongs to cannot be copied without end.
MOST_RATE = 1000.0
#: Of the mean of G's diagonal: keeps domains that no document tells apart from ruling the steps.
RIDGE = 1e-3
#: Labelled documents that a term of the vocabulary is in at least, and the log-odds between domains that it moves.
MIN_SUPPORT, MIN_SPREAD = 8, math.log(20)


@dataclass(frozen=True)
class Classifier:
    """Per domain a bias, and per term one log-odds for each domain."""

    domains: tuple[str, ...]
    bias: tuple[float, ...]
    terms: tuple[str, ...]
    weights: tuple[tuple[float, ...], ...]
    temperature: float


def tokens(text: Column) -> Column:
    """Words, with signs after a word as tokens of their own."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"(?<=\w)(?=[^\w\s])|\s+"), "")


def _terms(found: Column) -> Column:
    """Distinct tokens and a term for how many of the tokens are distinct."""
    kinds = F.array_distinct(found)
    share = F.size(kinds) / F.greatest(F.size(found), F.lit(1))
    variety = F.when(F.size(found) < 20, "few tokens").when(share < 0.2, "same tokens").when(share < 0.4, "some tokens")
    return F.concat(kinds, F.array(variety.otherwise("many tokens")))


def _numbers(values) -> Column:
    return F.split(F.lit(",".join(repr(float(v)) for v in values)), ",").cast("array<double>")


def _softmax(scores: list[Column]) -> list[Column]:
    top = F.greatest(*scores) if len(scores) > 1 else scores[0]
    parts = [F.exp(s - top) for s in scores]
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return [p / total for p in parts]


def _add_weight(names: Column, weights: Column, total: Column, term: Column) -> Column:
    return total + F.get(weights, F.array_position(names, term).cast("int") - 1)


def _scores(present: Column, model: Classifier) -> list[Column]:
    """Log scores of the domains; ``present`` holds the vocabulary's terms of a document."""
    if not model.terms:
        return [F.lit(bias) for bias in model.bias]
    names = F.array(*[F.lit(t) for t in model.terms])
    out = []
    for k, bias in enumerate(model.bias):
        column = _numbers(w[k] for w in model.weights)
        out.append(F.aggregate(present, F.lit(bias), partial(_add_weight, names, column)))
    return out


def fit(
    docs: DataFrame,
    labels: DataFrame,
    domains: tuple[str, ...],
    terms: int = 96,
    sample: int = 6_000,
    doc_id: str = "doc_id",
    text: str = "text",
) -> Classifier:
    """A classifier from ``labels`` (doc_id, domain), on at most ``sample`` of them.

    The chosen ids are broadcast to the scan of the documents; ``sample`` bounds them.
    """
    named = labels.where(F.col("domain").isin(*domains) & F.col(doc_id).isNotNull())
    named = named.select(F.col(doc_id).alias("_i"), "domain", F.xxhash64(doc_id).alias("_o"))
    chosen = named.orderBy("_o", "_i", "domain").limit(sample).dropDuplicates(["_i"])
    known = docs.select(F.col(doc_id).alias("_d"), F.col(text).alias("_t")).join(F.broadcast(chosen), F.expr("_d = _i"))
    known = known.select("domain", (F.pmod("_o", F.lit(4)) == 0).alias("held"), _terms(tokens(F.col("_t"))).alias("terms"))
    known = stage(known, "mix-labelled")
    counted = {r.domain: r.n for r in known.where("not held").groupBy("domain").agg(F.count("*").alias("n")).collect()}
    total = sum(counted.values())
    if not total:
        return Classifier(domains, (0.0,) * len(domains), (), (), 1.0)
    per = [F.count_if(F.col("domain") == d).alias(f"n{k}") for k, d in enumerate(domains)]
    seen = known.where("not held").select("domain", F.explode("terms").alias("term")).groupBy("term").agg(*per)
    shares = [(F.col(f"n{k}") + 0.5) / (counted.get(d, 0) + 1.0) for k, d in enumerate(domains)]
    # Only terms that move the odds twentyfold, by their count: weak ones depend on each other too much.
    odds = [F.log(share / (1 - share)) for share in shares]
    spread = F.greatest(*odds) - F.least(*odds) if len(odds) > 1 else F.lit(0.0)
    support = sum((F.col(f"n{k}") for k in range(1, len(domains))), F.col("n0"))
    best = seen.where((support >= MIN_SUPPORT) & (spread >= MIN_SPREAD))
    best = best.orderBy(F.desc(spread * F.sqrt(support)), "term").limit(terms).collect()
    p = [[(r[f"n{k}"] + 0.5) / (counted.get(d, 0) + 1.0) for k, d in enumerate(domains)] for r in best]
    bias = [
        math.log((counted.get(d, 0) + 0.5) / (total + 0.5 * len(domains))) + sum(math.log(1 - row[k]) for row in p)
        for k, d in enumerate(domains)
    ]
    weights = tuple(tuple(math.log(x / (1 - x)) for x in row) for row in p)
    model = Classifier(domains, tuple(bias), tuple(r.term for r in best), weights, 1.0)
    scored = known.where("held").select("domain", *[s.alias(f"s{k}") for k, s in enumerate(_scores(_present(F.col("terms"), model), model))])
    trials = []
    for t in TEMPERATURES:
        post = _softmax([F.col(f"s{k}") / t for k in range(len(domains))])
        own = F.lit(0.0)
        for k, d in enumerate(domains):
            own = F.when(F.col("domain") == d, post[k]).otherwise(own)
        trials.append(F.sum(F.log(F.greatest(own, F.lit(1e-12)))))
    likelihood = scored.agg(*[t.alias(f"t{i}") for i, t in enumerate(trials)]).first()
    ranked = [(x, -t) for x, t in zip(likelihood, TEMPERATURES) if x is not None]
    return Classifier(domains, model.bias, model.terms, weights, -max(ranked)[1] if ranked else 1.0)


def _present(terms: Column, model: Classifier) -> Column:
    names = F.array(*[F.lit(t) for t in model.terms]) if model.terms else F.array().cast("array<string>")
    return F.array_intersect(terms, names)


def posteriors(docs: DataFrame, model: Classifier, text: str = "text") -> DataFrame:
    """``docs`` with ``_tokens`` and ``_p0`` ... ``_pK``."""
    found = docs.withColumn("_found", tokens(F.col(text)))
    found = found.withColumn("_tokens", F.size("_found").cast("bigint")).withColumn("_present", _present(_terms(F.col("_found")), model))
    scores = found.drop("_found")
    for k, s in enumerate(_scores(F.col("_present"), model)):
        scores = scores.withColumn(f"_s{k}", s)
    post = _softmax([F.col(f"_s{k}") / model.temperature for k in range(len(model.domains))])
    names = [f"_s{k}" for k in range(len(model.domains))]
    return scores.withColumns({f"_p{k}": p for k, p in enumerate(post)}).drop("_present", *names)


def _rate(history: list[list[float]], eta: float, k: int) -> Column:
    """The rate after the steps of ``history``: per iteration the K weighted residuals."""
    if not history:
        return F.lit(1.0)
    steps = F.lit(";".join(",".join(repr(x) for x in e) for e in history))
    steps = F.transform(F.split(steps, ";"), lambda s: F.split(s, ",").cast("array<double>"))

    def down(rate, e):
        for i in range(k):
            move = F.col(f"_p{i}") * F.get(e, F.lit(i))
            total = move if not i else total + move
        return F.least(F.lit(MOST_RATE), F.greatest(F.lit(0.0), rate - eta * total))

    return F.aggregate(steps, F.lit(1.0), down)


def _solved(matrix: list[list[float]], right: list[float]) -> list[float]:
    """x of matrix x = right, by elimination; K x K."""
    rows = [[*row, value] for row, value in zip(matrix, right)]
    k = len(rows)
    for i in range(k):
        best = max(range(i, k), key=lambda r: abs(rows[r][i]))
        rows[i], rows[best] = rows[best], rows[i]
        rows[i] = [x / rows[i][i] for x in rows[i]]
        for r in range(k):
            if r != i:
                rows[r] = [x - rows[r][i] * y for x, y in zip(rows[r], rows[i])]
    return [row[-1] for row in rows]


def fit_rates(
    table: DataFrame, targets: dict[str, float], iterations: int = 200, tolerance: float = 1e-3
) -> tuple[list[list[float]], float]:
    """The scaled residuals of each projected-gradient step, and the step size, for a table of _tokens and _p0 ... _pK.

    Ends when every target is met up to ``tolerance`` of itself, or, with the best
    rates so far, when ten steps lower the miss by less than a thousandth of it: the
    targets cannot be met.
    Raises if neither happens within ``iterations``.
    """
    k = len(targets)
    want = [v / sum(targets.values()) for v in targets.values()]
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    free = F.when(F.col("_r") > 0, F.col("_tokens")).otherwise(0)  # documents that can still go either way
    sums = [F.sum(F.col("_tokens") * F.col(f"_p{i}") * F.col("_r")).alias(f"t{i}") for i in range(k)]
    gram = [F.sum(free * F.col(f"_p{i}") * F.col(f"_p{j}")).alias(f"g{i}_{j}") for i, j in pairs]
    history: list[list[float]] = []
    heights: list[float] = []
    first = None
    while True:
        got = table.withColumn("_r", _rate(history, 1.0, k)).agg(F.sum("_tokens").alias("n"), *sums, *gram).first()
        if not got.n:
            return [], 1.0
        g = [[got[f"g{min(i, j)}_{max(i, j)}"] / got.n for j in range(k)] for i in range(k)]
        first = first or g
        ridge = RIDGE * sum(first[i][i] for i in range(k)) / k
        g, whole = ([[x + ridge * (i == j) for j, x in enumerate(row)] for i, row in enumerate(m)] for m in (g, first))
        off = [got[f"t{i}"] / got.n - want[i] for i in range(k)]
        heights.append(sum(x * y for x, y in zip(off, _solved(whole, off))))
        miss = max(abs(x) / max(t, 0.01) for x, t in zip(off, want))
        best = min(range(len(heights)), key=heights.__getitem__)
        if miss < tolerance:
            return history, 1.0
        if len(heights) > 10 and min(heights[:-10]) - heights[best] < 1e-3 * heights[best]:
            return history[:best], 1.0
        if len(history) == iterations:
            raise ArithmeticError(f"rates are not settled after {iterations} steps; a target is missed by {miss:.2g} of itself")
        history.append(_solved(g, off))


def mix(
    docs: DataFrame,
    labels: DataFrame,
    targets: dict[str, float],
    doc_id: str = "doc_id",
    text: str = "text",
    extra: tuple[str, ...] = (),
) -> tuple[DataFrame, Classifier, list[list[float]], float]:
    """A staged table of doc_id, ``extra``, tokens, posteriors and the fitted ``rate``; and what was fitted."""
    model = fit(docs, labels, tuple(targets), doc_id=doc_id, text=text)
    narrow = posteriors(docs.select(F.col(doc_id).alias("_i"), F.col(text).alias("_t"), *[F.col(c).alias(f"_x_{c}") for c in extra]), model, "_t")
    held = stage(narrow.drop("_t"), "posteriors")
    history, eta = fit_rates(held, targets)
    out = held.withColumn("rate", _rate(history, eta, len(targets)))
    named = [F.col(f"_p{k}").alias(f"p_{d}") for k, d in enumerate(targets)]
    table = out.select(F.col("_i").alias(doc_id), *[F.col(f"_x_{c}").alias(c) for c in extra], F.col("_tokens").alias("n_tokens"), *named, "rate")
    return table, model, history, eta


def copies(rate: Column, doc_id: Column) -> Column:
    """Whole copies with the rate as their mean: a hash of the id decides on the fraction."""
    draw = F.pmod(F.xxhash64(doc_id, F.lit("mix")), F.lit(DRAW)) / DRAW
    return F.floor(rate + draw).cast("int")


def mixed(docs: DataFrame, labels: DataFrame, targets: dict[str, float], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs``, each as often as its rate says; the text is scored in place, nothing is joined or shuffled."""
    _, model, history, eta = mix(docs, labels, targets, doc_id, text)
    rated = posteriors(pack(docs, _i=F.col(doc_id), _t=F.col(text)), model, "_t")
    rated = rated.withColumn("_rate", _rate(history, eta, len(targets)))
    often = F.array_repeat(F.lit(1), copies(F.col("_rate"), F.col("_i")))
    return unpack(rated.withColumn("_copy", F.explode(often)))


def domains_of_labels(labels: DataFrame) -> DataFrame:
    """doc_id and domain (toxic, fine or poor) of the labelled documents."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "fine").when(F.col("quality") == 0, "poor")
    return labels.select("doc_id", domain.alias("domain")).where("domain is not null")
