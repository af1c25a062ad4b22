"""Token ids as length-delimited binary records, with an offset index.

A shard ``name.rec`` is a sequence of frames, each

    length  uint64   bytes of the record
    check   uint32   masked CRC of the length's eight bytes
    record           one byte (1: the id is null), doc_id int64, ids uint16 or uint32
    check   uint32   masked CRC of the record

all little-endian; ids take two bytes when the vocabulary fits.  The CRC is
CRC-32 as in zlib, masked as record files commonly do: rotated right by 15 and
0xA282EAD8 added, so that a CRC over bytes that hold CRCs stays sound.
``name.idx`` beside it holds the start of each frame as uint64, for reads of
single records in any order.

Shards are written by tasks over ranges of doc_id, under names of their own for
each attempt; the table of shards, which Spark commits as a whole, says which
ones count.  A lost task thus leaves at most files that nothing names.

Texts are cut, before encoding, where the byte-level pattern always starts a
pre-token: at every space with no white space beside it, and at line breaks.  The
distinct pieces of some megabytes of text are put together from words and signs;
words are looked up in a bounded memory, and those not met lately go to the library,
many in one call.  Texts with other runs of white space are cut at lone spaces alone.

Names of special tokens inside texts (as ``<|endoftext|>``) are either plain
text (``special_as_text``) or found as the vocabulary file says.  Texts that
hold the name of an added token that is to be found are encoded whole.

Defined cases: null texts are empty and give a record with the end id alone;
null ids come first; repeated ids are kept, in order of their text hashes; an
empty table gives no file and no row; other columns are ignored.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from functools import partial
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from millrace.llm.common import rows_of, small_batches
from millrace.session import stage, workspace

#: Words that a worker remembers; as many again stay from before the last turn.
REMEMBERED = 500_000
#: Bytes that a writer gathers, and a reader fetches, at a time.
BUFFER = 1 << 20

_SHARDS = "shard int, path string, n_docs bigint, n_ids bigint, n_bytes bigint, width int"
_HEAD, _CHECK, _ID = struct.Struct("<QI"), struct.Struct("<I"), struct.Struct("<Bq")
_LONE_SPACE = re.compile(r"(?<=\S) (?=\S)")
#: Signs that form a pre-token of their own between an ASCII letter or digit and the end of a piece.
_SIGNS = ".,;:!?)"
_SIGNED = f"[A-Za-z0-9][{re.escape(_SIGNS)}]$"
#: White space that is not cut at: a run of line breaks is not always one id for each.
_RUNS = ("\n\n\n", "\n\n ")
#: Words that the library gets as one text (longer texts take longer a word), and bytes of text that are cut at a time.
JOINED, CUT = 100, 8 << 20

_encoders: dict[tuple[str, bool], "Encoder"] = {}


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def _gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The ranges of ``values`` one after another."""
    ends = np.cumsum(lengths)
    at = np.repeat(starts - (ends - lengths), lengths)
    at += np.arange(len(at))
    return values[at]


def _starts(lengths: np.ndarray) -> np.ndarray:
    return np.cumsum(lengths) - lengths


class Encoder:
    """Ids of texts by a vocabulary file, as bytes."""

    def __init__(self, vocabulary: str, special_as_text: bool = True):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(vocabulary)
        self._tokenizer.encode_special_tokens = special_as_text
        added = self._tokenizer.get_added_tokens_decoder().values()
        self._added = [t.content for t in added if not (special_as_text and t.special)]
        size = self._tokenizer.get_vocab_size(with_added_tokens=True)
        self.kind = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        space = self._tokenizer.encode(" ", add_special_tokens=False).tokens[0]
        self._spaced = np.zeros(size, bool)  # ids of tokens that start with a space
        for token, number in self._tokenizer.get_vocab(with_added_tokens=True).items():
            self._spaced[number] = token.startswith(space)
        self._line = self._ids("\n")
        self._signs = np.concatenate([self._ids(c) for c in _SIGNS])
        if len(self._line) != 1 or len(self._signs) != len(_SIGNS):
            raise ValueError("the vocabulary has no single ids for a line break and signs")
        self._now: dict[str, bytes] = {}  # ids of words met lately; a line break before a word says that no space is
        self._before: dict[str, bytes] = {}

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self._tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.kind)

    def _learn(self, words: list[str], lines: bool) -> None:
        """Encode words that begin and end without white space, many in one text.

        Words after a space are told apart by the only id of each that starts with a
        space; words after a line break by the line break's id.
        """
        width = self.kind.itemsize
        groups = [words[at : at + JOINED] for at in range(0, len(words), JOINED)]
        texts = ["".join(own) if lines else " " + " ".join(own) for own in groups]
        for own, found in zip(groups, self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(found.ids, self.kind)
            starts = np.flatnonzero(ids == self._line[0]) + 1 if lines else np.flatnonzero(self._spaced[ids])
            if len(starts) != len(own):
                raise ValueError("the vocabulary joins words across white space")
            ends = np.append(starts[1:] - lines, len(ids))
            raw = ids.tobytes()
            self._now.update(zip(own, [raw[a:b] for a, b in zip((starts * width).tolist(), (ends * width).tolist())]))

    def _word_ids(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of ``keys`` end to end, and how many each has."""
        if len(self._now) > REMEMBERED:
            self._now, self._before = {}, self._now
        now, before = self._now, self._before
        found = list(map(now.get, keys))
        if None in found:
            new = [k for k, ids in zip(keys, found) if ids is None]
            now.update((k, before[k]) for k in new if k in before)
            new = [k for k in new if k not in before]
            self._learn([k for k in new if k[0] != "\n"], False)
            self._learn([k for k in new if k[0] == "\n"], True)
            found = list(map(now.__getitem__, keys))
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // self.kind.itemsize
        return np.frombuffer(b"".join(found), self.kind), lengths

    def _piece_ids(self, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids of distinct pieces end to end, how many each has, and which have none of their own for touching white space.

        A piece is a line break or none, a word, and a sign or none.
        """
        line = pc.starts_with(distinct, "\n")
        word = pc.if_else(line, pc.utf8_slice_codeunits(distinct, 1), distinct)
        bare = pc.and_(line, pc.equal(word, ""))
        odd = pc.or_(pc.not_equal(pc.utf8_trim_whitespace(word), word), pc.and_not(pc.equal(word, ""), bare))
        signed = pc.match_substring_regex(word, _SIGNED)
        sign = pc.if_else(signed, pc.index_in(pc.utf8_slice_codeunits(word, -1), pa.array(list(_SIGNS))), -1)
        word = pc.if_else(signed, pc.utf8_slice_codeunits(word, 0, -1), word)
        key = pc.if_else(pc.or_(odd, bare), "a", pc.if_else(line, pc.binary_join_element_wise("\n", word, ""), word))
        coded = key.dictionary_encode()
        ids, lengths = self._word_ids(coded.dictionary.to_pylist())
        which = coded.indices.to_numpy()
        line, bare, odd, signed, sign = (c.to_numpy(zero_copy_only=False) for c in (line, bare, odd, signed, sign))
        own = np.where(bare | odd, 0, lengths[which])
        total = own + line + signed
        out = np.empty(int(total.sum()), self.kind)
        at = _starts(total)
        out[at[line]] = self._line[0]
        out[(at + total - 1)[signed]] = self._signs[sign[signed]]
        inside = np.repeat(at + line - _starts(own), own)
        inside += np.arange(len(inside))
        out[inside] = _gather(ids, _starts(lengths)[which], own)
        return out, total, odd

    def encode(self, texts: list[str] | pa.Array) -> Iterator[bytes]:
        """The ids of every text, in order."""
        texts = pa.array(texts, pa.string()) if isinstance(texts, list) else texts
        at = 0
        sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
        for end in [*np.flatnonzero(np.diff(np.cumsum(sizes) // CUT)) + 1, len(texts)]:
            if end > at:
                yield from self._encode(texts.slice(at, end - at))
            at = end

    def _encode(self, texts: pa.Array) -> Iterator[bytes]:
        core = pc.utf8_rtrim(texts, "\n")
        apart = np.zeros(len(texts), bool)
        for run in _RUNS:
            apart |= pc.match_substring(core, run).to_numpy(zero_copy_only=False)
        whole = np.zeros(len(texts), bool)
        for name in self._added:
            whole |= pc.match_substring(texts, name).to_numpy(zero_copy_only=False)
        # The first word of a text is not after a space: a line break before it is taken off again.
        cut = pc.split_pattern(pc.binary_join_element_wise("\n", pc.replace_substring(core, "\n", " \n"), ""), " ")
        coded = cut.flatten().dictionary_encode()
        ids, lengths, odd = self._piece_ids(coded.dictionary)
        which = coded.indices.to_numpy()
        first = cut.offsets.to_numpy().astype(np.int64)
        first -= first[0]
        apart |= np.add.reduceat(odd[which], first[:-1]) > 0
        found = _gather(ids, _starts(lengths)[which], lengths[which]).tobytes()
        bounds = np.concatenate([[0], np.cumsum(lengths[which])])[first] * self.kind.itemsize
        lines = pc.subtract(pc.binary_length(texts), pc.binary_length(core)).to_numpy(zero_copy_only=False).tolist()
        tails = {n: self._ids("\n" * n).tobytes() for n in set(lines)}
        for i, (start, end, n) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), lines)):
            if whole[i]:
                yield self._ids(texts[i].as_py()).tobytes()
            elif apart[i]:
                yield self._apart(texts[i].as_py())
            else:
                yield found[start + self.kind.itemsize : end] + tails[n]

    def _apart(self, text: str) -> bytes:
        """Ids of a text with runs of white space, cut at the spaces that stand alone."""
        head, *own = _LONE_SPACE.split(text)
        simple = [p for p in own if not (p[-1].isspace() or " " in p or "\n" in p)]
        ids, lengths = self._word_ids(simple)
        known = dict(zip(simple, np.split(ids, np.cumsum(lengths)[:-1]))) if simple else {}
        return b"".join([self._ids(head).tobytes(), *((known[p] if p in known else self._ids(" " + p)).tobytes() for p in own)])


def _encoder(vocabulary: str, special_as_text: bool) -> Encoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    key = (vocabulary, special_as_text)
    if key not in _encoders:
        _encoders[key] = Encoder(*key)
    return _encoders[key]


def _open(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


def frame(record: bytes) -> bytes:
    length = struct.pack("<Q", len(record))
    return length + _CHECK.pack(masked(length)) + record + _CHECK.pack(masked(record))


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches put together to some ``CUT`` bytes: the more at a time, the more words repeat."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= CUT:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def _write(
    batches: Iterator[pa.RecordBatch], folder: str, vocabulary: str, end_id: int, special_as_text: bool
) -> Iterator[pa.RecordBatch]:
    coder, shard = _encoder(vocabulary, special_as_text), TaskContext.get().partitionId()
    end = np.array([end_id], coder.kind).tobytes()
    out = index = None
    n_docs = n_ids = at = 0
    store, base = _open(folder)
    name = f"{base}/{shard:06d}-{uuid4().hex[:12]}"
    for batch in _gathered(batches):
        ids, texts = batch.column("_id").to_pylist(), batch.column("_text")
        if out is None and ids:
            store.create_dir(base, recursive=True)
            out = store.open_output_stream(f"{name}.rec", buffer_size=BUFFER)
            index = store.open_output_stream(f"{name}.idx", buffer_size=BUFFER)
        for own, body in zip(ids, coder.encode(texts)):
            framed = frame(_ID.pack(own is None, own or 0) + body + end)
            out.write(framed)
            index.write(struct.pack("<Q", at))
            at += len(framed)
            n_docs += 1
            n_ids += len(body) // coder.kind.itemsize + 1
    if out is not None:
        out.close()
        index.close()
        row = (shard, name, n_docs, n_ids, at, coder.kind.itemsize)
        kinds = (pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int32())
        names = ["shard", "path", "n_docs", "n_ids", "n_bytes", "width"]
        yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names)


def write_records(
    docs: DataFrame,
    folder: str,
    vocabulary: str,
    end_id: int,
    doc_id: str = "doc_id",
    text: str = "text",
    special_as_text: bool = True,
) -> DataFrame:
    """Write every row's ids below ``folder``, in order of doc_id; returns the table of shards, in order."""
    small_batches(docs.sparkSession)

    narrow = docs.select(F.col(doc_id).cast("bigint").alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    order = ("_id", F.xxhash64("_text"))
    write = partial(_write, folder=folder, vocabulary=vocabulary, end_id=end_id, special_as_text=special_as_text)
    return stage(narrow.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(write, _SHARDS), "shards")


def read_frames(source) -> Iterator[tuple[int | None, bytes]]:
    """(doc_id, ids as bytes) of each frame of an open file; raises where a check fails."""
    while head := source.read(_HEAD.size):
        if len(head) < _HEAD.size:
            raise ValueError("a record file ends inside a frame")
        length, check = _HEAD.unpack(head)
        if masked(head[:8]) != check:
            raise ValueError("a frame's length fails its check")
        record, tail = source.read(length), source.read(_CHECK.size)
        if len(tail) < _CHECK.size or masked(record) != _CHECK.unpack(tail)[0]:
            raise ValueError("a record fails its check")
        null, doc_id = _ID.unpack_from(record)
        yield (None if null else doc_id), record[_ID.size :]


def _spread(shards: DataFrame) -> DataFrame:
    return shards.repartition(max(1, shards.count()), "shard")


def _table(columns: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["_id", "start", "n_tokens", "ids_crc32"])


def _read(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    store, _ = _open(folder)
    for path, width, at in rows_of(batches, "path", "width", "first"):
        out = [[] for _ in range(4)]
        with store.open_input_stream(f"{path}.rec", buffer_size=BUFFER) as source:
            for own, ids in read_frames(source):
                n = len(ids) // width
                crc = zlib.crc32(np.frombuffer(ids, f"<u{width}").astype("<u4").tobytes())
                for column, value in zip(out, (own, at, n, crc)):
                    column.append(value)
                at += n
                if len(out[0]) == 10_000:
                    yield _table(out)
                    out = [[] for _ in range(4)]
        yield _table(out)


def read_records(shards: DataFrame, folder: str, doc_id: str = "doc_id") -> DataFrame:
    """doc_id, start (ids of all records before), n_tokens and ids_crc32 of every record, checked."""
    small_batches(shards.sparkSession)
    # One small row a shard meets in one task here.
    before = F.sum("n_ids").over(W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1))
    placed = shards.withColumn("first", F.coalesce(before, F.lit(0).cast("bigint")))

    rows = _spread(placed).mapInArrow(partial(_read, folder=folder), "_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
    return rows.withColumnRenamed("_id", doc_id)


def _read_shuffled(batches: Iterator[pa.RecordBatch], folder: str, seed: int) -> Iterator[pa.RecordBatch]:
    store, _ = _open(folder)
    for shard, path, width in rows_of(batches, "shard", "path", "width"):
        with store.open_input_file(f"{path}.idx") as index:
            starts = np.frombuffer(index.read(), "<u8")
        with store.open_input_file(f"{path}.rec") as source:
            for at in np.random.default_rng([seed, shard]).permutation(starts):
                source.seek(int(at))
                own, ids = next(read_frames(source))
                values = pa.array([np.frombuffer(ids, f"<u{width}").astype(np.int64)], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array([own], pa.int64()), values], ["_id", "ids"])


def read_shuffled(shards: DataFrame, folder: str, seed: int, doc_id: str = "doc_id") -> DataFrame:
    """doc_id and ids of every record, each shard's in an order drawn from ``seed``, by way of the offset index."""

    return _spread(shards).mapInArrow(partial(_read_shuffled, folder=folder, seed=seed), "_id bigint, ids array<bigint>").withColumnRenamed("_id", doc_id)


def round_trip(
    spark: SparkSession, docs: DataFrame, vocabulary: str, end_id: int, folder: str | None = None, special_as_text: bool = True
) -> DataFrame:
    """Write ``docs`` to record files in the shared folder and return what they hold."""
    folder = folder or workspace(spark, "records")
    return read_records(write_records(docs, folder, vocabulary, end_id, special_as_text=special_as_text), folder)
