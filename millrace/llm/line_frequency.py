"""Quality rules with cross-document line frequency.

One pass over the texts gives each document's own measures and its distinct
normalised lines, hashed, with the words they hold.  Documents are counted per
(host, line hash) with map-side sums; lines in more than ``max(min_docs, share *
documents of the host)`` documents of a host are removed from its documents; a
document that loses more than ``depleted`` of its words is rejected.  The verdict
is ``judge_lines``; ``remove_lines`` gives the kept documents without those lines.

A line is normalised by lower-casing A-Z, turning digits into 0 and runs of
white space into one space; lines without a word do not count.

Defined cases: null texts have no words and fail the base rules; a null host is
a host of its own; each row is a document, repeated rows and ids included;
columns other than id, text and host are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import pack, rows_of, small_batches
from millrace.session import stage

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"
MIN_WORDS, MAX_REPEAT_PCT = 50, 50

_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789", b"abcdefghijklmnopqrstuvwxyz000000000")
_SCHEMA = (
    "_id bigint, _host string, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, _lines array<struct<h: bigint, words: int>>, _row bigint"
)


def repeat_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur twice or more."""
    if len(words) < 4:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    pairs = np.unique(ids[:-1] * len(known) + ids[1:], return_inverse=True)[1]
    _, which, often = np.unique(pairs[:-1] * len(known) + ids[2:], return_inverse=True, return_counts=True)
    twice = np.flatnonzero(often[which] > 1)
    inside = np.zeros(len(words), bool)
    for k in range(3):
        inside[twice + k] = True
    return int(inside.sum())


def line_hash(words: list[bytes]) -> int:
    return xxhash.xxh64_intdigest(b" ".join(words).translate(_FOLD))


def measure(text: bytes) -> tuple[int, int, int, int, int, dict[int, int]]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and words by line hash."""
    words = text.split()
    tally = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    chars = len(text) - int(tally[0x80:0xC0].sum()) - int(tally[list(SPACES)].sum())
    seen: set[bytes] = set()
    lines: dict[int, int] = {}
    repeated = 0
    for line in text.split(b"\n"):
        inside = line.split()
        if not inside:
            continue
        if line in seen:
            repeated += 1
        else:
            seen.add(line)
        key = line_hash(inside)
        lines[key] = lines.get(key, 0) + len(inside)
    return len(words), chars, int(tally[list(SYMBOLS)].sum()), repeated, repeat_words(words), lines


def _signed(key: int) -> int:
    return key - (1 << 64) if key >> 63 else key


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    line = pa.list_(pa.struct([("h", pa.int64()), ("words", pa.int32())]))
    for batch in batches:
        out = [[] for _ in range(8)]
        for doc_id, host, text in rows_of([batch], "_id", "_host", "_text"):
            *own, lines = measure(text or b"")
            for column, value in zip(out, (doc_id, host, *own, [{"h": _signed(k), "words": n} for k, n in lines.items()])):
                column.append(value)
        kinds = [pa.int64(), pa.string(), *[pa.int64()] * 5, line]
        names = ["_id", "_host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "_lines", "_row"]
        yield pa.RecordBatch.from_arrays([*(pa.array(c, k) for c, k in zip(out, kinds)), batch.column("_row")], names)


def _measure_rows(docs: DataFrame, doc_id: str, text: str, host: str, row: Column) -> DataFrame:
    small_batches(docs.sparkSession)
    narrow = docs.select(
        F.col(doc_id).cast("bigint").alias("_id"), F.col(host).cast("string").alias("_host"), F.col(text).cast("binary").alias("_text"),
        row.alias("_row"),
    )
    return narrow.mapInArrow(_measured, _SCHEMA)


def _verdicts(rows: DataFrame, min_docs: int, share: float, depleted: float) -> DataFrame:
    """``rows`` (staged, with _row) with n_removed_words, the hashes ``_cut`` of their lines over the limit, base_failed and kept."""
    host_key = F.xxhash64("_host").alias("_hk")  # null included
    lines = rows.select("_row", host_key, F.explode("_lines").alias("l")).select("_row", "_hk", "l.h", "l.words")
    hosts = rows.groupBy(host_key).agg(F.count("*").alias("docs"))
    often = lines.groupBy("_hk", "h").agg(F.count("*").alias("n")).where(F.col("n") > min_docs)
    often = often.join(hosts, "_hk").where(F.col("n") > F.col("docs") * share).select("_hk", "h")
    lost = lines.join(stage(often, "frequent-lines"), ["_hk", "h"]).groupBy("_row")
    lost = lost.agg(F.sum("words").alias("n_removed_words"), F.collect_list("h").alias("_cut"))
    out = rows.join(lost, "_row", "left").withColumn("n_removed_words", F.coalesce("n_removed_words", F.lit(0).cast("bigint")))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))
    left = F.col("n_removed_words") <= F.col("n_words") * depleted
    return out.withColumn("base_failed", failed).withColumn("kept", ~failed & left)


def judge_lines(
    docs: DataFrame,
    min_docs: int = 20,
    share: float = 0.001,
    depleted: float = 0.5,
    doc_id: str = "doc_id",
    text: str = "text",
    host: str = "source",
) -> DataFrame:
    """Measures, base_failed, n_removed_words and kept, one row a document."""
    rows = stage(_measure_rows(docs, doc_id, text, host, F.monotonically_increasing_id()), "measured")
    out = _verdicts(rows, min_docs, share, depleted)
    return out.select(
        F.col("_id").alias(doc_id), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "n_removed_words",
    )


def without_lines(text: bytes, cut: set[int]) -> bytes:
    """``text`` without the lines whose signed hash is in ``cut``."""
    return b"\n".join(x for x in text.split(b"\n") if not (inside := x.split()) or _signed(line_hash(inside)) not in cut)


def _cut_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [without_lines(t, set(cut)) if cut else t for t, cut in rows_of([batch], "_text", "_cut")]
        yield pa.RecordBatch.from_arrays([batch.column("_row"), pa.array(texts, pa.binary())], ["_row", "_text"])


def remove_lines(
    docs: DataFrame,
    min_docs: int = 20,
    share: float = 0.001,
    depleted: float = 0.5,
    doc_id: str = "doc_id",
    text: str = "text",
    host: str = "source",
) -> DataFrame:
    """The kept rows of ``docs``, by the verdict of ``judge_lines``, with the lines over the limit cut from their texts."""
    held = pack(docs, _n=F.monotonically_increasing_id(), _t=F.col(text), _i=F.col(doc_id), _h=F.col(host))
    held = stage(held, "numbered")
    rows = stage(_measure_rows(held, "_i", "_t", "_h", F.col("_n")), "measured")
    verdicts = _verdicts(rows, min_docs, share, depleted).where("kept").select("_row", "_cut")
    verdicts = stage(verdicts, "kept")
    some = held.join(verdicts.where("_cut is not null"), F.col("_n") == F.col("_row"))
    cut = some.select("_row", F.col("_t").cast("binary").alias("_text"), "_cut").mapInArrow(_cut_lines, "_row bigint, _text binary")
    cut = cut.select(F.col("_row").alias("_n"), F.col("_text").cast(docs.schema[text].dataType).alias("_new"))
    kept = held.join(verdicts.select(F.col("_row").alias("_n")), "_n", "left_semi").join(cut, "_n", "left")
    own = F.coalesce("_new", "_t").alias(text)
    return kept.select(*[own if c == text else F.col("doc").getField(c).alias(c) for c in docs.columns])
