import random
import zlib

import numpy as np
import pytest

from millrace.llm import edit_counts, record_files
from millrace.llm.queries import REDACTIONS, op5, pretoken_pattern, vocabulary
from tests.llm.plain import DOCS, awkward


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


def odd_texts(n=400, seed=3):
    rng = random.Random(seed)
    parts = ["a", "Word", "'s", "'re", "'", " ", "  ", "\n", "\t", " ", "\u0085", "\x1c", "7", "12", "!?", "é", "中", "<|endoftext|>", "​", "."]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(30))) for _ in range(n)]


def test_pieces_encode_as_the_whole_text(tokenizer):
    texts = odd_texts() + [t or "" for _, t, *_ in awkward()]
    coder = record_files.Encoder(vocabulary("byte_bpe_50k.json"))
    for text, ids in zip(texts, coder.encode(texts)):
        assert np.frombuffer(ids, coder.kind).tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_round_trip(spark, folder, tokenizer):
    rows = awkward()
    docs = spark.createDataFrame(rows, DOCS).withColumnRenamed("lang", "start").repartition(5)
    shards = record_files.write_records(docs, str(folder), vocabulary("byte_bpe_50k.json"), 2)
    got = sorted(record_files.read_records(shards, str(folder)).collect(), key=lambda r: r.start)
    ids = {}
    for i, t, *_ in rows:
        own = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
        ids.setdefault(i, []).append((len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
    assert [r.doc_id for r in got] == sorted((i for i, *_ in rows), key=lambda i: (i is not None, i))
    at = 0
    for r in got:
        assert r.start == at and (r.n_tokens, r.ids_crc32) in ids[r.doc_id]
        at += r.n_tokens
    shuffled = record_files.read_shuffled(shards, str(folder), 1).collect()
    assert sorted((r.doc_id is not None, r.doc_id, len(r.ids)) for r in shuffled) == sorted(
        (r.doc_id is not None, r.doc_id, r.n_tokens) for r in got
    )


def test_special_tokens_as_the_file_says():
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    texts = ["a<|endoftext|>b", "one <|endoftext|> two words", "<|endoftext", *odd_texts()]
    coder = record_files.Encoder(vocabulary("byte_bpe_50k.json"), special_as_text=False)
    for text, ids in zip(texts, coder.encode(texts), strict=True):
        assert np.frombuffer(ids, coder.kind).tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)


def test_query_finds_special_tokens(spark, folder):
    docs = spark.createDataFrame([(1, "a<|endoftext|>b"), (2, "a")], "doc_id bigint, text string")
    docs.write.parquet(f"{folder}/documents.parquet")
    got = [(r.doc_id, r.start, r.n_tokens) for r in op5(spark, str(folder)).collect()]
    assert sorted(got) == [(1, 0, 4), (2, 4, 2)]


def test_damage_is_found(tmp_path):
    data = bytearray(record_files.frame(b"\x00" * 9 + b"abcd"))
    for at in (0, 9, 20, len(data) - 1):
        bad = bytearray(data)
        bad[at] ^= 1
        path = tmp_path / f"{at}.rec"
        path.write_bytes(bad)
        with pytest.raises((ValueError, OverflowError)), path.open("rb") as f:
            list(record_files.read_frames(f))


def test_no_documents(spark, folder):
    docs = spark.createDataFrame([], DOCS)
    shards = record_files.write_records(docs, str(folder), vocabulary("byte_bpe_50k.json"), 2)
    assert record_files.read_records(shards, str(folder)).count() == 0


def test_edits_count_as_a_new_encoding():
    rng = random.Random(11)
    coder = edit_counts.Coder(vocabulary("byte_bpe_50k.tiktoken"), pretoken_pattern())
    many = ["".join(odd_texts(40, seed)) for seed in range(6)]
    for text in odd_texts(300, 5) + many:
        pieces = coder.pattern.findall(text)
        tree = edit_counts.SegmentTree(list(map(len, pieces)), coder.counts(pieces))
        for _ in range(6):
            start = rng.randrange(len(text) + 1)
            end = min(len(text), start + rng.choice([0, 1, 2, 5, 200]))
            new = rng.choice(["", " ", "x", "'s", "\n\n", " [EMAIL] ", "word word"])
            text, _ = tree.edit(text, start, end, new, coder)
            pieces = coder.pattern.findall(text)
            assert [n for leaf in tree.leaves for n in leaf[0]] == list(map(len, pieces)), repr(text)
            assert tree.tokens[1] == sum(coder.counts(pieces)) and tree.chars[1] == len(text)


def test_far_text_is_not_encoded_again():
    coder = edit_counts.Coder(vocabulary("byte_bpe_50k.tiktoken"), pretoken_pattern())
    text = "some words of a long text " * 2000
    pieces = coder.pattern.findall(text)
    tree = edit_counts.SegmentTree(list(map(len, pieces)), coder.counts(pieces))
    assert tree.edit(text, 20_000, 20_004, "other", coder)[1] < 10


def test_count_edited(spark):
    rows = awkward() + [(90, "mail a.b@c.org or 0123456789abcdef0123456789abcdef\nLicensed under the X, 2.0.\nend", "en", "s", 1)]
    docs = spark.createDataFrame(rows, DOCS)
    docs = docs.withColumn("edits", edit_counts.redactions(docs.text, REDACTIONS))
    name, pattern = vocabulary("byte_bpe_50k.tiktoken"), pretoken_pattern()
    got = edit_counts.count_edited(docs, name, pattern).collect()
    coder = edit_counts.Coder(name, pattern)
    count = lambda t: sum(coder.counts(coder.pattern.findall(t or "")))
    assert sorted((r.doc_id is not None, r.doc_id, r.n_tokens) for r in got) == sorted((i is not None, i, count(t)) for i, t, *_ in rows)
    last = next(r for r in got if r.doc_id == 90)
    assert (last.n_edits, last.n_tokens_after) == (3, count("mail [EMAIL] or [KEY]\n\nend"))
    assert all(r.n_tokens_after == r.n_tokens for r in got if not r.n_edits)


def test_overlapping_and_odd_edits(spark):
    edits = [(5, 9, "x"), (0, 2, None), (1, 6, "lost"), (11, 11, "!"), (40, 50, "beyond")]
    docs = spark.createDataFrame([(1, "some words to edit", edits), (2, None, None)], "doc_id int, text string, edits array<struct<start:int,end:int,text:string>>")
    name, pattern = vocabulary("byte_bpe_50k.tiktoken"), pretoken_pattern()
    coder = edit_counts.Coder(name, pattern)
    one, two = sorted(edit_counts.count_edited(docs, name, pattern).collect())
    assert one.n_tokens_after == sum(coder.counts(coder.pattern.findall("me xs !to editbeyond"))) and one.n_edits == 4
    assert (two.n_tokens, two.n_edits) == (0, 0)
