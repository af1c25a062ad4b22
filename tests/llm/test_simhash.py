import random

import numpy as np
import pytest

from millrace.llm import simhash_trie
from millrace.llm.simhash_trie import fingerprint, forest, hex64, keep_first, keep_first_similar, near_duplicates, trie_links
from tests.llm.plain import DOCS, awkward, linked, similar_groups, simhash


def ball(n, seed, centres=3):
    """Distinct values crowded around a few centres."""
    rng = random.Random(seed)
    out = set()
    for c in [rng.getrandbits(64) for _ in range(centres)]:
        while len(out) < n * (1 + list([c]).index(c)):
            v = c
            for _ in range(rng.randrange(5)):
                v ^= 1 << rng.randrange(64)
            out.add(v)
            if rng.random() < 0.02:
                break
        out.add(rng.getrandbits(64))
    return sorted(out)


def test_fingerprints():
    for _, text, *_ in awkward():
        assert fingerprint((text or "").encode()) == simhash(text)


def test_trie_finds_every_pair():
    values = ball(400, 1) + [0, 1, 3, 7]
    values = np.array(sorted(set(values)), np.uint64)
    want = {(i, j) for i in range(len(values)) for j in range(i + 1, len(values)) if int(values[i] ^ values[j]).bit_count() <= 2}
    got = [(int(i), int(j)) for a, b in trie_links(values, None, 2) for i, j in zip(a, b)]
    assert len(got) == len(set(got)) and set(got) == want
    left, right = values[::2], values[1::2]
    want = {(i, j) for i, x in enumerate(left) for j, y in enumerate(right) if int(x ^ y).bit_count() <= 2}
    assert {(int(i), int(j)) for a, b in trie_links(left, right, 2) for i, j in zip(a, b)} == want


def test_forest():
    links = [(np.array([3, 1]), np.array([4, 2])), (np.array([2, 0]), np.array([3, 5]))]
    assert forest(iter(links), 7).tolist() == [0, 1, 1, 1, 1, 0, 6]


def test_components_with_small_cells(spark):
    """Cells so small that nodes are descended many times, as a crowded prefix would be."""
    from millrace.llm.simhash_trie import components, near_links

    values = ball(300, 2) + ball(40, 3)
    signed = np.array(sorted(set(values)), np.uint64).view(np.int64).tolist()
    prints = spark.createDataFrame([(v,) for v in signed], "fp bigint")
    got = {r.node: r.root for r in components(near_links(prints, 2, cell=8)).collect()}
    want = linked({v: v & (2**64 - 1) for v in signed})
    groups = lambda m: {frozenset(k for k in m if m[k] == r) for r in set(m.values())}
    alone = {frozenset([v]) for v in signed}
    assert groups(got) | alone == groups(want) | alone


def test_near_duplicates(spark):
    rows = awkward()
    docs = spark.createDataFrame(rows, DOCS).withColumnRenamed("lang", "component_id")
    got = near_duplicates(docs)
    found = [(r.doc_id, r.f, r.component_id) for r in got.select("doc_id", hex64("fp").alias("f"), "component_id").collect()]
    prints = {i: simhash(t) for i, t, *_ in rows if i is not None}
    want = linked(prints)
    assert len(found) == len(rows)
    for doc_id, text in found and [(f[0], f) for f in found if f[0] is not None]:
        assert text[1] == f"{prints[doc_id]:016x}" and text[2] == want[doc_id]


def test_keep_first(spark):
    rows = awkward()
    docs = spark.createDataFrame(rows, DOCS)
    kept = keep_first(docs).collect()
    want = linked({i: simhash(t) for i, t, *_ in rows if i is not None})
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == sorted(set(want.values()))
    assert sum(r.doc_id is None for r in kept) == 2 and kept[0].__fields__ == docs.columns


def test_one_row_of_each_component_whatever_its_ids(spark):
    rng = random.Random(9)
    a, b, c, d, e = (" ".join(f"w{rng.randrange(10**6)}" for _ in range(40)) for _ in range(5))
    rows = [(5, a), (5, b), (3, b), (None, c), (None, c), (7, d), (7, d), (8, e), (None, e), (7, e)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    kept = [tuple(r) for r in keep_first(docs, keep_null_ids=False).collect()]
    assert sorted(kept, key=str) == sorted([(5, a), (3, b), (None, c), (7, d), (7, e)], key=str)
    kept = [tuple(r) for r in keep_first(docs).collect()]
    assert sorted(kept, key=str) == sorted([(5, a), (3, b), (None, c), (None, c), (7, d), (7, e), (None, e)], key=str)


def test_empty(spark):
    docs = spark.createDataFrame([], DOCS)
    assert near_duplicates(docs).count() == 0 and keep_first(docs).count() == 0


# Near copies ----------------------------------------------------------------


def test_several_fingerprints_by_single_bits():
    for text in ("", "one", "a b c d e f g", " ".join(f"w{i % 700}" for i in range(1500))):
        hashes = simhash_trie.shingle_hashes(text.encode(), 5)
        for k, value in enumerate(simhash_trie.several_fingerprints(hashes).tolist()):
            mixed = []
            for h in hashes.tolist():
                h = (h + k * 0x9E3779B97F4A7C15) % 2**64
                h = ((h ^ h >> 30) * 0xBF58476D1CE4E5B9) % 2**64
                h = ((h ^ h >> 27) * 0x94D049BB133111EB) % 2**64
                mixed.append(h ^ h >> 31)
            assert value == sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in mixed) > len(mixed))


def test_forest_connects_what_links_connect():
    budget = ((32, 2), (64, 5))
    values = np.array(sorted(set(ball(300, 5) + ball(100, 6))), np.uint64)
    near = lambda x: (int(x) >> 32).bit_count() <= 2 and int(x).bit_count() <= 5
    for cut in (None, 150):
        inside = lambda i, j: cut is None or i < cut <= j
        links = [(i, j) for i in range(len(values)) for j in range(i + 1, len(values)) if inside(i, j) and near(values[i] ^ values[j])]
        found = [(int(i), int(j)) for a, b in simhash_trie.links_of_forest(values, cut, budget) for i, j in zip(a, b)]
        assert set(found) <= set(links) and len(found) < len(values)
        root = lambda e: forest(iter([tuple(np.array(x) for x in zip(*e))]), len(values)).tolist()
        assert root(found) == root(links)


def edited(words, changes, rng):
    out = list(words)
    for at in rng.sample(range(len(out)), changes):
        out[at] = f"x{rng.randrange(10**9)}"
    return out


def test_planted_near_copies_by_similarity(spark):
    """Copies with 1 to 7 of 200 words changed (Jaccard 0.95 to 0.7) and a crowd of copies of one text."""
    rng = random.Random(12)
    fresh = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    texts = []
    for _ in range(150):
        base = fresh(200)
        texts += [base, edited(base, rng.randrange(1, 8), rng)]
    crowd = fresh(120)
    texts += [edited(crowd, rng.randrange(1, 3), rng) for _ in range(400)] + [fresh(150) for _ in range(100)]
    order = list(range(len(texts)))
    rng.shuffle(order)
    rows = [(i, " ".join(t)) for i, t in zip(order, texts)]
    want = similar_groups(rows, 5, 0.8)
    docs = spark.createDataFrame(rows, "n bigint, row string").repartition(3)
    kept = {r.n for r in keep_first_similar(docs, doc_id="n", text="row").collect()}
    leave = {i for i, first in want.items() if i != first}
    assert len(leave) > 400 and len(kept & leave) <= 0.05 * len(leave)
    assert set(want.values()) <= kept


def test_similar_awkward_rows(spark):
    rows = awkward()
    names = ["row", "n", "id", "text_key", "prints"]
    docs = spark.createDataFrame(rows, DOCS)
    for k, name in enumerate(names):
        docs = docs.withColumn(name, docs.n_chars + k)
    kept = keep_first_similar(docs.repartition(3)).collect()
    numbered = [(k if r[0] is None else r[0], r[1]) for k, r in enumerate(rows, 10_000)]  # null ids come last
    groups = similar_groups(numbered, 5, 0.8)
    assert sorted(10_000 if r.doc_id is None else r.doc_id for r in kept) == sorted(min(v, 10_000) for v in set(groups.values()))
    assert kept[0].__fields__ == docs.columns and all(r[n] == r.n_chars + k for r in kept for k, n in enumerate(names))
    assert keep_first_similar(docs.limit(0)).count() == 0


def test_similar_in_small_cells(spark):
    rng = random.Random(8)
    base = [f"w{rng.randrange(10**6)}" for _ in range(80)]
    rows = [(i, " ".join(edited(base, 1, rng))) for i in range(60)] + [(100 + i, f"alone {i} " * 4) for i in range(40)]
    texts = spark.createDataFrame(rows, "n bigint, text string")
    texts = texts.select("n", texts.text.cast("binary").alias("text"))
    prints = [(i, [int(v) for v in simhash_trie.several_fingerprints(simhash_trie.shingle_hashes(t.encode(), 5)).view(np.int64)]) for i, t in rows]
    links = simhash_trie.similar_links(texts, spark.createDataFrame(prints, "n bigint, prints array<bigint>"), cell=4)
    want = similar_groups(rows, 5, 0.8)
    got = linked_groups([(r.u, r.v) for r in links.collect()], [i for i, _ in rows])
    assert got == want


def test_no_link_is_left_out(spark):
    """Pairs just above the threshold: one walk or another misses some of them."""
    rng = random.Random(31)
    rows = []
    for k in range(400):
        base = [f"w{rng.randrange(10**6)}" for _ in range(200)]
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(edited(base, 4, rng)))]
    kept = keep_first_similar(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(similar_groups(rows, 5, 0.8).values())) == list(range(0, 800, 2))


@pytest.mark.parametrize("texts", [2, 1000])
def test_links_without_the_tries(spark, monkeypatch, texts):
    """Where the walks find equal fingerprints only, the comparison of what they leave apart finds the rest."""
    monkeypatch.setattr(simhash_trie, "COPY_BUDGET", 0)
    monkeypatch.setattr(simhash_trie, "ORDER_TEXTS", texts)
    rng = random.Random(5)
    passage = [f"p{i}" for i in range(60)]
    rows = [(0, ""), (1, " "), (2, "a"), (3, "a b c"), (4, "A b  c")]
    for _ in range(25):
        base = passage + [f"w{rng.randrange(10**6)}" for _ in range(rng.choice((15, 60, 120)))]
        rows += [(len(rows) + x, " ".join(edited(base, rng.randrange(0, 4), rng) + ["z"] * x)) for x in range(3)]
    frame = spark.createDataFrame(rows, "n bigint, text string")
    frame = frame.select("n", frame.text.cast("binary").alias("text"))
    prints = [(i, [int(v) for v in simhash_trie.several_fingerprints(simhash_trie.shingle_hashes(t.encode(), 5)).view(np.int64)]) for i, t in rows]
    links = simhash_trie.similar_links(frame, spark.createDataFrame(prints, "n bigint, prints array<bigint>"))
    assert linked_groups([(r.u, r.v) for r in links.collect()], [i for i, _ in rows]) == similar_groups(rows, 5, 0.8)


@pytest.mark.parametrize("block", [1 << 12, 16])
def test_texts_beside_a_large_group_are_few_rows(spark, monkeypatch, block):
    """Texts that share most of a large group's shingles: pairs too far apart are no rows, and none that is near is lost."""
    counts = {}

    def counted(df, label="stage", run=simhash_trie.stage):
        out = run(df, label)
        counts[label] = out.count()
        return out

    monkeypatch.setattr(simhash_trie, "stage", counted)
    monkeypatch.setattr(simhash_trie, "MET_BLOCK", block, raising=False)
    monkeypatch.setattr(simhash_trie, "MET_FEW", 8, raising=False)
    rng = random.Random(3)
    base = [f"w{rng.randrange(10**6)}" for _ in range(150)]
    rows = [(i, " ".join(edited(base, rng.randrange(0, 3), rng))) for i in range(300)]
    rows += [(300 + i, " ".join(edited(base, 3 if i < 5 else 6, rng))) for i in range(60)]
    sets = {i: simhash_trie.shingle_hashes(text.encode(), 5) for i, text in rows}
    want = {(i, j) for i in sets for j in range(max(i + 1, 300), 360) if simhash_trie.jaccard(sets[i], sets[j]) >= 0.8}
    frame = spark.createDataFrame(rows, "n bigint, row string").selectExpr("n", "cast(row as binary) as text")
    nodes = spark.createDataFrame([(i, 0 if i < 300 else i) for i, _ in rows], "n bigint, root bigint")
    found = simhash_trie.candidates_apart(frame, nodes, 0.8, 5).collect()
    pairs = [(r.u, r.v) for r in found]
    assert len(want) > 500 and want <= set(pairs) and len(pairs) == len(set(pairs))
    assert counts["apart"] <= 2 * len(want)


def test_long_texts_that_share_a_passage_are_no_candidates(spark, monkeypatch):
    """Texts of 2,800 words that share 60 % or 25 % of them: pairs are too many to compare by their sets, and none of the near ones is lost."""
    counts = {}

    def counted(df, label="stage", run=simhash_trie.stage):
        out = run(df, label)
        counts[label] = out.count()
        return out

    monkeypatch.setattr(simhash_trie, "stage", counted)
    monkeypatch.setattr(simhash_trie, "ORDER_LEAST", 10**6)  # among very many texts the passages would not be common
    rng = random.Random(17)
    fresh = lambda n: [f"w{rng.randrange(10**7)}" for _ in range(n)]
    texts = [passage + fresh(2800 - len(passage)) for passage in (fresh(1680), fresh(700)) for _ in range(24)]
    texts += [edited(texts[k][: 2800 - 20 * k], 30, rng) for k in range(8)] + [edited(texts[40], 600, rng), fresh(900)]
    rows = [(i, " ".join(words)) for i, words in enumerate(texts)]
    sets = {i: simhash_trie.shingle_hashes(text.encode(), 5) for i, text in rows}
    want = {(i, j) for i in sets for j in sets if i < j and simhash_trie.jaccard(sets[i], sets[j]) >= 0.8}
    frame = spark.createDataFrame(rows, "n bigint, row string").selectExpr("n", "cast(row as binary) as text")
    found = simhash_trie.candidates_apart(frame, frame.selectExpr("n", "n as root"), 0.8, 5).collect()
    pairs = {(r.u, r.v) for r in found}
    assert len(want) >= 5 and want <= pairs and len(pairs) <= len(want) + 8
    assert counts["apart"] <= 32 * 31 // 2 + 8  # those that share a quarter are not even met


def test_parities_rule_out_no_near_pair():
    rng = np.random.default_rng(4)
    for size in (0, 1, 4, 40, 900, 1100, 3000, 9000):
        own = np.unique(rng.integers(0, 2**64, size, dtype=np.uint64))
        for out in {0, 1, size // 10, size // 9, size // 5, size}:
            other = np.unique(np.concatenate([own[out:], rng.integers(0, 2**64, min(out, size // 9), dtype=np.uint64)]))
            may = simhash_trie.possible((len(own), len(other)), (simhash_trie.parities(own), simhash_trie.parities(other)), 0.8)
            assert may or simhash_trie.jaccard(own, other) < 0.8
            assert not may or not size or out < size


def test_a_fingerprint_goes_to_few_cells(spark):
    """Whatever their number: blocks of bits in turn in front, instead of every partner of many levels."""
    budget = simhash_trie.COPY_BUDGET
    rng = random.Random(23)
    values = {rng.getrandbits(64) for _ in range(600)}
    for v in list(values)[:200]:
        for bit in rng.sample(range(32), 6) + rng.sample(range(32, 64), 3):
            v ^= 1 << bit
        values.add(v)
    values = np.array(sorted(values), np.uint64)
    prints = spark.createDataFrame([(w, v) for w in (0, 1) for v in values.view(np.int64).tolist()], "word int, fp bigint")
    rows, key = simhash_trie._cells(prints, budget, 8, turned=True)
    assert rows.count() <= 4.5 * prints.count()
    found = rows.groupBy(*key).applyInPandas(simhash_trie._finish_links(budget), "word int, u bigint, v bigint").collect()
    near = lambda x: (x >> 32).bit_count() <= 3 and x.bit_count() <= 12
    plain = values.tolist()
    links = {(u, v) for k, u in enumerate(plain) for v in plain[k + 1 :] if near(u ^ v)}
    for word in (0, 1):
        got = {tuple(sorted((r.u % 2**64, r.v % 2**64))) for r in found if r.word == word}
        assert got <= links and linked_groups(got, plain) == linked_groups(links, plain) and len(links) >= 200


def linked_groups(links, keys):
    root = {k: k for k in keys}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for u, v in links:
        x, y = sorted((find(u), find(v)))
        root[y] = x
    return {k: find(k) for k in keys}
