"""Plain Python versions of the training-data operators, and awkward rows to run them on."""

from __future__ import annotations

import random
import re
import zlib

import xxhash

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def awkward() -> list[tuple]:
    """Nulls, empty, long, tied and repeated rows."""
    rng = random.Random(5)
    words = "the of and river Stone élan über 7 42 token key= | ***".split()
    prose = lambda n: " ".join(rng.choice(words) + rng.choice(["", ".", ",", "\n"]) for _ in range(n))
    rows = [(i, prose(rng.choice([1, 2, 3, 30, 120]))) for i in range(40)]
    long = prose(30_000)
    rows += [(50, None), (51, ""), (52, " \n\t "), (None, prose(60)), (None, None), (60, long), (61, long + " more")]
    rows += [(70, rows[5][1]), (70, rows[5][1]), (71, rows[6][1]), (72, "İstanbul K ퟿ \U0001f600 word"), (73, "one two")]
    return [(i, t, "en", None if k % 9 == 0 else f"src{k % 2}", len(t or "")) for k, (i, t) in enumerate(rows)]


def simhash(text: str | None) -> int:
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(prints: dict[int, int], budget: int = 2) -> dict[int, int]:
    """Smallest reachable key over fingerprints within the budget."""
    root = {k: k for k in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    keys = sorted(prints)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= budget:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {k: find(k) for k in keys}


def shingles(text: str | None, size: int) -> frozenset:
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))) if words else frozenset()


def similar_groups(rows: list[tuple], size: int, least: float) -> dict:
    """Smallest key reachable over links of Jaccard similarity ``least`` or more, for each key of (key, text) rows."""
    sets: dict = {}
    for key, text in rows:
        sets.setdefault(shingles(text, size), []).append(key)
    root = {k: k for k, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    def join(x, y):
        x, y = sorted((find(x), find(y)))
        root[y] = x

    distinct = list(sets)
    for i, a in enumerate(distinct):
        for key in sets[a][1:]:
            join(sets[a][0], key)
        for b in distinct[i + 1 :]:
            if min(len(a), len(b)) >= least * max(len(a), len(b)) and len(a & b) >= least * len(a | b):
                join(sets[a][0], sets[b][0])
    return {k: find(k) for k in root}


def hits(text: str | None, items: dict, window: int) -> tuple[int, set, set]:
    """Words, hit positions and ids of items with occurring windows."""

    def cut(t):
        low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)

    words, places, found = cut(text), set(), set()
    for item, body in items.items():
        own = cut(body)
        m = min(window, len(own))
        grams = {tuple(own[i : i + m]) for i in range(len(own) - m + 1)} if m else set()
        for i in range(len(words) - m + 1):
            if m and tuple(words[i : i + m]) in grams:
                places.update(range(i, i + m))
                found.add(item)
    return len(words), places, found


BASE = (
    (
        "assign",
        r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        6,
    ),
    ("access", r"(AKIA[A-Z0-9]+)", 20),
    ("hex", r"([0-9a-f]+)", 24),
)


def base_spans(text: str | None) -> list[tuple[int, int, int, str]]:
    out = []
    for rank, (kind, pattern, least) in enumerate(BASE):
        out += [(m.start(), rank, m.end(), kind) for m in re.finditer(pattern, text or "") if len(m[1]) >= least]
    return sorted(out)


def held_out(doc_id: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 4 == 2
