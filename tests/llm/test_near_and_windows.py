"""Near-duplicates and benchmark windows against plain set computations."""

import random
import re

import numpy as np
import pytest

from searchlake.llm import decontaminate, near_dedup
from searchlake.llm.components import connected_components


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def brute(rows):
    """{position: (n_shingles, component)}: rows linked by similarity or a shared id."""
    sets, parent = [shingles(t) for _, t in rows], list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if rows[i][0] is not None and rows[i][0] == rows[j][0] and sets[i] and sets[j]:
                parent[root(i)] = root(j)
            if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both) and None not in (rows[i][0], rows[j][0]):
                parent[root(i)] = root(j)
    low = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            low[root(i)] = min(doc, low.get(root(i), doc))
    return [(doc, len(sets[i]), low.get(root(i)) if doc is not None else None) for i, (doc, _) in enumerate(rows)]


def key(r):
    return tuple(-1 if x is None else x for x in r)


def found(df):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect()), key=key)


def test_odd_rows(odd_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    out = near_dedup.near_duplicates(odd_docs)
    assert found(out) == sorted(brute(rows), key=key)
    tied = [(1, "a b c d e f g"), (2, "a b c d e f g"), (2, "other words of the second document"), (3, "other words of the second document"), (4, "")]
    out = near_dedup.near_duplicates(odd_docs.sparkSession.createDataFrame(tied, "doc_id long, text string"))
    assert found(out) == sorted(brute(tied), key=key)
    kept = near_dedup.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(-1 if r["doc_id"] is None else r["doc_id"] for r in kept.collect()) == [-1, 1, 3, 4, 5, 6, 7, 8, 11, 12]


def test_chains_and_common_lines(spark):
    """Copies with growing edits (a chain of links), and short texts that
    share a line without being alike."""
    rnd = random.Random(4)
    base = [f"w{i}" for i in range(120)]
    rows, text = [], list(base)
    for i in range(60):
        text = list(text)
        text[rnd.randrange(len(text))] = f"e{i}"
        rows.append((1000 - i, " ".join(text)))
    line = " ".join(f"c{i}" for i in range(14))
    rows += [(2000 + i, line + f" x{i} y{i} z{i} u{i}") for i in range(80)]
    rows += [(3000 + i, " ".join(base[: 100 + i % 3])) for i in range(30)]
    rnd.shuffle(rows)
    out = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(7))
    assert found(out) == sorted(brute(rows), key=key)


def test_sketch_estimates_similarity_and_fills_every_place():
    rng = np.random.default_rng(0)
    pool = rng.integers(0, 2**63, 3000).astype(np.uint64)
    for size, shared in ((1, 1), (40, 30), (400, 300), (2000, 1500)):
        a, b = np.unique(pool[:size]), np.unique(pool[size - shared : 2 * size - shared])
        rows = near_dedup.sketch([a, b, np.empty(0, np.uint64)])
        assert (rows[:2] != near_dedup._EMPTY).all() and (rows[2] == near_dedup._EMPTY).all()
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs((rows[0] == rows[1]).mean() - true) < 0.2
    many = near_dedup.codes([a, b])
    differ = sum(int(x).bit_count() for x in (many[0] ^ many[1]))
    assert abs(1 - 2 * differ / near_dedup.CODE_BITS - true) < 0.12


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(50)] + [(200, i) for i in range(201, 260)] + [(7, 7), (None, 3), (300, 301), (301, 300), (300, 301)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = {i: 0 for i in range(51)} | {i: 200 for i in range(200, 260)} | {300: 300, 301: 300}
    assert got == want
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_empty_tables(spark, no_docs):
    assert near_dedup.near_duplicates(no_docs).count() == 0
    bench = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert decontaminate.decontaminate(no_docs, bench).count() == 0


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def hits(text, items):
    own, inside, which = words(text), set(), set()
    for item, t in items:
        w = words(t)
        n = min(10, len(w))
        for i in range(len(w) - n + 1) if w else ():
            for p in range(len(own) - n + 1):
                if own[p : p + n] == w[i : i + n]:
                    inside |= set(range(p, p + n))
                    which.add(str(item))
    return len(own), len(inside), sorted(which)


@pytest.fixture(scope="module")
def items(spark):
    rows = [
        (1, "Quick brown fox"), (20, "over the lazy dog, and runs far away from here or there too"), (3, ""), (4, None), (5, "日本語"),
        (6, "the"), (6, "second text of item six"), (None, "one two"), (7, "words in it words in it words in it words in it"),
        (8, "quick brown fox"), (100, "-- !! --"), (9, "jumps over the lazy dog and runs far away from here"),
    ]
    return rows, spark.createDataFrame(rows, "item_id long, text string")


def test_windows_on_odd_rows(odd_docs, items):
    rows, bench = items
    known = [r for r in rows if r[0] is not None]
    want = sorted((-1 if r["doc_id"] is None else r["doc_id"], *hits(r["text"], known)) for r in odd_docs.collect() if r["n_chars"] is None or r["n_chars"] < 1000)
    out = decontaminate.decontaminate(odd_docs.where("coalesce(n_chars, 0) < 1000"), bench)
    got = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_words"], r["n_hit"], r["item_ids"]) for r in out.collect())
    assert got == want
    assert all(r["contaminated"] == (r["n_hit"] > 0) for r in out.collect())
    clean = decontaminate.clean(odd_docs, bench)
    assert clean.columns == odd_docs.columns
    assert {r["doc_id"] for r in clean.collect()} == {3, 4, 5, 7, 8, 9, 11, 12, None}


def test_no_items(odd_docs, items):
    out = decontaminate.decontaminate(odd_docs, items[1].limit(0))
    assert out.where("contaminated").count() == 0 and out.count() == odd_docs.count()
