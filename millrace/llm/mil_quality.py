"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages and only the bag has a label.  A passage of
some ``PASSAGE`` bytes, cut at white space, is encoded as square roots of the
shares of its hashed byte trigrams and a few shape measures, and mapped to a
hidden vector h = tanh(W x + b).  Gated attention

    a = softmax over passages of w . (tanh(V h) * sigmoid(U h))

weighs the passages; the document's score is sigmoid(c . sum(a h) + d).  All
parameters are learned together from document labels by Adam on the log loss.

Training takes all passages of a bounded sample of labelled documents, in one task:
those with the smallest id hashes, at most ``sample`` of them and as many as have at
most ``sample_bytes`` of text together.  Scoring covers whole texts of all documents, one batch
at a time.

Defined cases: null and empty texts are one passage without trigrams; very long
texts are encoded in pieces of ``CHUNK`` passages; labels that are null, or of
null or repeated ids, count once or not at all; without both classes among the
labels the score is the share of good ones (one half without labels); each row
is scored on its own text alone; other columns are ignored, and kept by
``keep_good``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.common import rows_of, small_batches
from millrace.session import stage

PASSAGE, BUCKETS, SHAPES = 640, 512, 8
HIDDEN, GATE = 32, 16
CHUNK = 4096

_KINDS = np.zeros(256, np.uint8)  # 1 signs, 2 digits, 3 capitals, 4 small letters, 5 white space
_KINDS[33:127] = 1
_KINDS[48:58], _KINDS[65:91], _KINDS[97:123] = 2, 3, 4
_KINDS[[9, 10, 11, 12, 13, 32]] = 5


def _cuts(data: np.ndarray) -> np.ndarray:
    """Starts of the passages: multiples of PASSAGE moved on to the next white space, if there is one soon."""
    n = max(1, round(len(data) / PASSAGE))
    at = np.arange(n) * (len(data) // n)
    for k in range(1, n):
        gap = np.flatnonzero(_KINDS[data[at[k] : at[k] + 64]] == 5)
        at[k] += gap[0] if len(gap) else 0
    return at


def encode(text: bytes) -> np.ndarray:
    """One row a passage: hashed trigrams and shape measures."""
    data = np.frombuffer(text, np.uint8)
    if not len(data):
        return np.zeros((1, BUCKETS + SHAPES), np.float32)
    starts = _cuts(data)
    ends = np.append(starts[1:], len(data))
    out = np.zeros((len(starts), BUCKETS + SHAPES), np.float32)
    for first in range(0, len(starts), CHUNK):
        last = min(first + CHUNK, len(starts))
        _encode_part(data[starts[first] : ends[last - 1]], starts[first:last] - starts[first], out[first:last])
    return out


def _encode_part(data: np.ndarray, starts: np.ndarray, out: np.ndarray) -> None:
    n = len(starts)
    sizes = np.diff(np.append(starts, len(data)))
    owner = np.repeat(np.arange(n, dtype=np.uint32), sizes)
    wide = data.astype(np.uint32)
    if len(data) > 2:
        mixed = (wide[:-2] * np.uint32(0x9E3779B1)) ^ (wide[1:-1] * np.uint32(0x85EBCA77)) ^ (wide[2:] * np.uint32(0xC2B2AE3D))
        bucket = (mixed >> np.uint32(16)) & np.uint32(BUCKETS - 1)
        counts = np.bincount(owner[:-2] * np.uint32(BUCKETS) + bucket, minlength=n * BUCKETS).reshape(n, BUCKETS)
        np.sqrt(counts / np.maximum(1, counts.sum(axis=1, keepdims=True)), out=out[:, :BUCKETS], casting="unsafe")
        out[:, BUCKETS] = (counts > 0).sum(axis=1) / np.minimum(BUCKETS, sizes)
    kinds = np.bincount(owner * np.uint32(8) + _KINDS[data], minlength=n * 8).reshape(n, 8) / sizes[:, None]
    out[:, BUCKETS + 1 : BUCKETS + 6] = kinds[:, 1:6]
    out[:, BUCKETS + 6] = np.bincount(owner, data == 10, minlength=n) / sizes
    out[:, BUCKETS + 7] = np.log1p(sizes) / 8


# The model ------------------------------------------------------------------


def _start(seed: int) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    draw = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)
    zero = lambda n: np.zeros(n, np.float32)
    width = BUCKETS + SHAPES
    return {
        "W": draw(width, HIDDEN) * np.float32(3), "b": zero(HIDDEN), "V": draw(HIDDEN, GATE), "U": draw(HIDDEN, GATE),
        "w": draw(GATE), "c": draw(HIDDEN), "d": zero(1),
    }


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _forward(m: dict, x: np.ndarray, starts: np.ndarray) -> tuple:
    """Scores of bags that begin at ``starts``, and what the gradient needs."""
    sizes = np.diff(np.append(starts, len(x)))
    h = np.tanh(x @ m["W"] + m["b"])
    v, u = np.tanh(h @ m["V"]), _sigmoid(h @ m["U"])
    e = (v * u) @ m["w"]
    e = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), sizes))
    a = e / np.repeat(np.add.reduceat(e, starts), sizes)
    z = np.add.reduceat(a[:, None] * h, starts)
    return _sigmoid(z @ m["c"] + m["d"]), sizes, h, v, u, a, z


def _gradient(m: dict, x: np.ndarray, starts: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    p, sizes, h, v, u, a, z = _forward(m, x, starts)
    off = ((p - y) / len(y)).astype(np.float32)
    spread = np.repeat(off, sizes)
    dz = spread[:, None] * m["c"]
    per = (dz * h).sum(axis=1)
    de = a * (per - np.repeat(np.add.reduceat(a * per, starts), sizes))
    gate = de[:, None] * m["w"]
    dv, du = gate * u * (1 - v * v), gate * v * u * (1 - u)
    dh = (a[:, None] * dz + dv @ m["V"].T + du @ m["U"].T) * (1 - h * h)
    return {
        "W": x.T @ dh, "b": dh.sum(axis=0), "V": h.T @ dv, "U": h.T @ du, "w": (v * u).T @ de, "c": z.T @ off, "d": off.sum(keepdims=True),
    }


def train(bags: list[np.ndarray], labels: np.ndarray, steps: int = 1_400, batch: int = 32, seed: int = 7) -> dict[str, np.ndarray]:
    """Whole rounds over the bags, ``steps`` of them at least."""
    m, rng = _start(seed), np.random.default_rng(seed)
    labels = labels.astype(np.float32)
    if not len(labels) or labels.min() == labels.max():
        share = labels.mean() if len(labels) else 0.5
        m["c"][:] = 0
        m["d"][:] = np.log((share + 1e-3) / (1 - share + 1e-3))
        return m
    mean = {k: np.zeros_like(v) for k, v in m.items()}
    square = {k: np.zeros_like(v) for k, v in m.items()}
    per_round = -(-len(bags) // batch)
    rounds = -(-steps // per_round)
    step, steps = 0, rounds * per_round
    for _ in range(rounds):
        order = rng.permutation(len(bags))
        for i in range(0, len(order), batch):
            own = order[i : i + batch]
            x = np.concatenate([bags[j] for j in own]).astype(np.float32)
            starts = np.cumsum([0, *(len(bags[j]) for j in own[:-1])])
            step += 1
            rate = 0.004 * (1 - 0.95 * step / steps)
            for k, g in _gradient(m, x, starts, labels[own]).items():
                g = g + 1e-5 * m[k]
                mean[k] = 0.9 * mean[k] + 0.1 * g
                square[k] = 0.999 * square[k] + 0.001 * g * g
                m[k] -= (rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return m


def _pack(m: dict[str, np.ndarray]) -> bytes:
    return b"".join(m[k].astype("<f4").tobytes() for k in sorted(m))


def _unpack(data: bytes) -> dict[str, np.ndarray]:
    at, out = 0, {}
    for k, like in sorted(_start(0).items()):
        out[k] = np.frombuffer(data, "<f4", like.size, at).reshape(like.shape)
        at += like.nbytes
    return out


# On Spark -------------------------------------------------------------------


def _train_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = sorted(rows_of(batches, "_o", "_d", "label", "x"))
    bags = [np.frombuffer(x, np.float16).reshape(-1, BUCKETS + SHAPES) for *_, x in rows]
    model = train(bags, np.array([label for _, _, label, _ in rows], np.float32))
    yield pa.RecordBatch.from_arrays([pa.array([_pack(model)], pa.binary())], ["model"])


def _encode_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = [encode(t or b"").astype(np.float16).tobytes() for (t,) in rows_of([batch], "_text")]
        columns = [batch.column(c) for c in ("_o", "_d", "label")]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(x, pa.binary())], ["_o", "_d", "label", "x"])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    sample: int = 3_000,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    sample_bytes: int = 128 << 20,
) -> bytes:
    """A model from a bounded sample of labelled documents, as bytes (some 70 KB).

    ``docs`` gives the texts of ``labels`` (doc_id, label); the chosen ids are
    broadcast to its scan, bounded by ``sample``.  An id that comes with several
    texts gives the one with the smallest hash.  A passage takes 1,040 bytes of the
    training task, so ``sample_bytes`` of text take less than twice as many.
    """
    small_batches(docs.sparkSession)
    known = labels.where(F.col(doc_id).isNotNull() & F.col(label).isin(0, 1))
    known = known.groupBy(F.col(doc_id).alias("_i")).agg(F.max(label).cast("int").alias("label"))
    chosen = known.orderBy(F.xxhash64("_i"), "_i").limit(sample).withColumn("_o", F.xxhash64("_i"))
    narrow = docs.select(F.col(doc_id).alias("_d"), F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("_text"))
    rows = narrow.join(F.broadcast(chosen), F.col("_d") == F.col("_i"))
    rows = rows.groupBy("_o", F.col("_d").cast("bigint").alias("_d"), "label").agg(F.min_by("_text", F.xxhash64("_text")).alias("_text"))
    rows = stage(rows, "labelled")
    # One row without text for each of at most ``sample`` documents meets in a task here.
    upto = F.sum(F.octet_length("_text")).over(W.orderBy("_o", "_d").rowsBetween(W.unboundedPreceding, 0))
    fit_in = rows.select("_o", "_d", upto.alias("_upto")).where(F.col("_upto") <= sample_bytes).select("_o", "_d")
    rows = rows.join(F.broadcast(fit_in), ["_o", "_d"], "left_semi").select("_o", "_d", "label", "_text")
    bags = stage(rows.mapInArrow(_encode_task, "_o bigint, _d bigint, label int, x binary"), "bags")
    row = bags.repartition(1).mapInArrow(_train_task, "model binary").first()
    return bytes(row.model) if row else _pack(train([], np.zeros(0)))


def scores(docs: DataFrame, model: bytes, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and score (0 to 1) of every row."""
    small_batches(docs.sparkSession)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = _unpack(model)
        for batch in batches:
            found = [float(_forward(m, encode(t or b""), np.zeros(1, int))[0][0]) for (t,) in rows_of([batch], "_text")]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(found, pa.float64())], ["_id", "score"])

    narrow = docs.select(F.col(doc_id).alias("_id"), F.col(text).cast("binary").alias("_text"))
    kind = dict(narrow.dtypes)["_id"]
    return narrow.mapInArrow(score, f"_id {kind}, score double").withColumnRenamed("_id", doc_id)


def held_out(doc_id: Column | str = "doc_id") -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` whose score reaches ``threshold``; the text is scored where it lies, nothing is joined."""
    model = fit(docs, labels.where(~held_out(doc_id)), doc_id=doc_id, text=text)
    small_batches(docs.sparkSession)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = _unpack(model)
        for batch in batches:
            good = [
                _forward(m, encode(t.encode() if t else b""), np.zeros(1, int))[0][0] >= threshold for (t,) in rows_of([batch], text)
            ]
            yield batch.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
