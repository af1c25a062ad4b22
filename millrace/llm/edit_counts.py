"""Token counts that follow edits without encoding a document again.

A document's text is cut into pre-tokens by the vocabulary's pattern.  Their
lengths and token counts are kept; over them stands a tree whose leaves hold up
to ``LEAF`` pre-tokens and whose nodes hold the sums of characters and tokens
below.  An edit is located by descending on characters.  The pattern looks at
most two characters past a match, so encoding starts anew at the first
pre-token that ends less than two characters before the edit, and stops as soon
as a new boundary meets an old one beyond the edit: matching from a boundary on
depends on nothing before it.  Only the sums above the touched leaves change.

Defined cases: null texts are empty and have no tokens; a document without
edits, or with null edits, keeps its counts; edits are (start, end, text) in
code points of the original text, ends exclusive, empty ranges insert, a null
text deletes; of overlapping edits the first (by start, end) counts; rows are
counted each on its own; columns other than those named are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import find_spans, rows_of, small_batches

LEAF = 64
LOOK_AHEAD = 2
#: Pre-tokens whose counts a worker remembers.
REMEMBERED = 300_000

EDITS = "array<struct<start:int,end:int,text:string>>"
_STATE = f"_id bigint, _text string, _edits {EDITS}, n_tokens bigint, _lengths binary, _counts binary"

_coders: dict[str, "Coder"] = {}


class Coder:
    """Counts the tokens of pre-tokens with the ranks of a vocabulary file."""

    def __init__(self, vocabulary: str, pattern: str):
        import regex
        import tiktoken

        with open(vocabulary, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self._encode = tiktoken.Encoding("counts", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.pattern = regex.compile(pattern)
        self._known: dict[str, int] = {}

    def counts(self, pieces: list[str]) -> list[int]:
        known = self._known
        if len(known) > REMEMBERED:
            known.clear()
        out = []
        for p in pieces:
            n = known.get(p)
            if n is None:
                n = known[p] = len(self._encode(p))
            out.append(n)
        return out


def _coder(vocabulary: str, pattern: str) -> Coder:
    if vocabulary not in _coders:
        _coders[vocabulary] = Coder(vocabulary, pattern)
    return _coders[vocabulary]


class SegmentTree:
    """Sums of characters and tokens over leaves of pre-tokens."""

    def __init__(self, lengths: list[int], counts: list[int]):
        self.leaves = [(lengths[i : i + LEAF], counts[i : i + LEAF]) for i in range(0, len(lengths), LEAF)] or [([], [])]
        self.width = 1 << (len(self.leaves) - 1).bit_length()
        self.chars, self.tokens = [0] * 2 * self.width, [0] * 2 * self.width
        for i, (own, n) in enumerate(self.leaves):
            self.chars[self.width + i], self.tokens[self.width + i] = sum(own), sum(n)
        for i in range(self.width - 1, 0, -1):
            self._sum(i)

    def _sum(self, i: int) -> None:
        self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
        self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    def _leaf_changed(self, leaf: int) -> None:
        i = self.width + leaf
        self.chars[i], self.tokens[i] = sum(self.leaves[leaf][0]), sum(self.leaves[leaf][1])
        while i > 1:
            i //= 2
            self._sum(i)

    def find(self, at: int) -> tuple[int, int, int]:
        """(leaf, place in it, start) of the pre-token with character ``at``; of the last one beyond the end."""
        at = min(at, self.chars[1] - 1)
        i, start = 1, 0
        while i < self.width:
            i *= 2
            if at >= start + self.chars[i]:
                start += self.chars[i]
                i += 1
        leaf = i - self.width
        for place, n in enumerate(self.leaves[leaf][0]):
            if at < start + n:
                return leaf, place, start
            start += n
        return leaf, len(self.leaves[leaf][0]), start

    def edit(self, text: str, start: int, end: int, new: str, coder: Coder) -> tuple[str, int]:
        """The edited text, and how many pre-tokens were encoded for it."""
        leaf, place, begin = self.find(max(0, start - LOOK_AHEAD)) if self.chars[1] else (0, 0, 0)
        changed = text[:start] + new + text[end:]
        shift, settled = len(new) - (end - start), start + len(new)
        last, after, old = leaf, place, begin  # first old pre-token that stays, and where it starts
        pieces: list[str] = []
        for found in coder.pattern.finditer(changed, begin):
            pieces.append(found[0])
            if found.end() < settled:
                continue
            while old + shift < found.end() or old < end:
                while after >= len(self.leaves[last][0]) and last + 1 < len(self.leaves):
                    last, after = last + 1, 0
                if after >= len(self.leaves[last][0]):
                    break
                old += self.leaves[last][0][after]
                after += 1
            if old + shift == found.end() and old >= end:
                break
        else:  # up to the end of the text
            last, after = len(self.leaves) - 1, len(self.leaves[-1][0])
        lengths, counts = list(map(len, pieces)), coder.counts(pieces)
        tail = self.leaves[last][0][after:], self.leaves[last][1][after:]
        head = self.leaves[leaf][0][:place], self.leaves[leaf][1][:place]
        if last == leaf:
            self.leaves[leaf] = (head[0] + lengths + tail[0], head[1] + counts + tail[1])
        else:
            self.leaves[leaf] = (head[0] + lengths, head[1] + counts)
            self.leaves[last] = tail
            self._leaf_changed(last)
            for between in range(leaf + 1, last):
                if self.leaves[between][0]:
                    self.leaves[between] = ([], [])
                    self._leaf_changed(between)
        self._leaf_changed(leaf)
        return changed, len(pieces)


def _apart(edits: list[dict] | None, n: int) -> list[tuple[int, int, str]]:
    """Edits within the text, in order, without those that overlap an earlier one."""
    out: list[tuple[int, int, str]] = []
    for e in sorted(edits or [], key=lambda e: (e["start"], e["end"])):
        start, end = max(0, min(e["start"], n)), min(e["end"], n)
        if end >= start and (not out or start >= out[-1][1]):
            out.append((start, end, e["text"] or ""))
    return out


def segment_trees(
    docs: DataFrame, vocabulary: str, pattern: str, doc_id: str = "doc_id", text: str = "text", edits: str | None = "edits"
) -> DataFrame:
    """The leaves of each document's tree: lengths and token counts of its pre-tokens, with its text and edits."""
    small_batches(docs.sparkSession)
    changes = F.col(edits).cast(EDITS) if edits else F.lit(None).cast(EDITS)
    narrow = docs.select(F.col(doc_id).cast("bigint").alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"), changes.alias("_edits"))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(vocabulary, pattern)
        for batch in batches:
            totals, lengths, counts = [], [], []
            for (body,) in rows_of([batch], "_text"):
                pieces = coder.pattern.findall(body)
                own = np.array(coder.counts(pieces), np.int32)
                totals.append(int(own.sum()))
                counts.append(own.tobytes())
                lengths.append(np.fromiter(map(len, pieces), np.int32, len(pieces)).tobytes())
            more = [pa.array(totals, pa.int64()), pa.array(lengths, pa.binary()), pa.array(counts, pa.binary())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, "n_tokens", "_lengths", "_counts"])

    return narrow.mapInArrow(build, _STATE)


def apply_edits(trees: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """Trees after their edits, with n_edits, n_tokens_after and n_encoded, the pre-tokens encoded for them.

    The result has the columns of a tree again (text, lengths, counts; edits
    null), so that later edits can follow; unused ones are best dropped.
    """

    def update(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(vocabulary, pattern)
        for batch in batches:
            out = [[] for _ in range(6)]
            for body, edits, total, lengths, counts in rows_of([batch], "_text", "_edits", "n_tokens", "_lengths", "_counts"):
                changes, encoded = _apart(edits, len(body)), 0
                if changes:
                    tree = SegmentTree(np.frombuffer(lengths, np.int32).tolist(), np.frombuffer(counts, np.int32).tolist())
                    for start, end, new in reversed(changes):  # places before an edit stay
                        body, n = tree.edit(body, start, end, new, coder)
                        encoded += n
                    total = tree.tokens[1]
                    lengths = np.array([x for leaf in tree.leaves for x in leaf[0]], np.int32).tobytes()
                    counts = np.array([x for leaf in tree.leaves for x in leaf[1]], np.int32).tobytes()
                for column, value in zip(out, (len(changes), total, encoded, body, lengths, counts)):
                    column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary()]
            made = [pa.array(c, k) for c, k in zip(out, kinds)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("n_tokens"), *made],
                ["_id", "n_tokens", "n_edits", "n_tokens_after", "n_encoded", "_text", "_lengths", "_counts"],
            )

    schema = "_id bigint, n_tokens bigint, n_edits bigint, n_tokens_after bigint, n_encoded bigint, _text string, _lengths binary, _counts binary"
    return trees.mapInArrow(update, schema)


def count_edited(
    docs: DataFrame, vocabulary: str, pattern: str, doc_id: str = "doc_id", text: str = "text", edits: str = "edits"
) -> DataFrame:
    """doc_id, n_tokens, n_edits, n_tokens_after, n_encoded for every row of ``docs`` with an array of edits."""
    done = apply_edits(segment_trees(docs, vocabulary, pattern, doc_id, text, edits), vocabulary, pattern)
    return done.select(F.col("_id").alias(doc_id), "n_tokens", "n_edits", "n_tokens_after", "n_encoded")


def _replaced(new: str, span: Column) -> Column:
    return F.struct(span["start"].alias("start"), span["end"].alias("end"), F.lit(new).alias("text"))


def redactions(text: Column, rules: tuple[tuple[str, str, str], ...]) -> Column:
    """Edits that replace what the rules (pattern, quick test, replacement) find."""
    body = F.coalesce(text, F.lit(""))
    found = []
    for pattern, quick, new in rules:
        spans = find_spans(body, f"({pattern})", 1, 1, quick)
        found.append(F.transform(spans, partial(_replaced, new)))
    return F.array_sort(F.concat(*found))
