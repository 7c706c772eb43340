"""Vector codes against a full search in plain integers."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from searchlake.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, parts=8, entries=16, rounds=6):
    """{id: (code, error, label)} and the codebook digest, Python integers only."""
    kept = [(i, [math.floor(4096 * float(np.float32(x))) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    dims = max(1, -(-max((len(v) for _, v, _ in kept), default=0) // parts)) * parts
    kept = [(i, v + [0] * (dims - len(v)), label) for i, v, label in kept]
    w = dims // parts
    first = {}
    for i, v, _ in kept:
        first[i] = min(first.get(i, v), v)
    start = [first[i] for i in sorted(first, key=lambda i: (i is None, i))][:entries]
    books = [[v[p * w : (p + 1) * w] for v in start] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(books[p]))

    for _ in range(rounds):
        new = []
        for p in range(parts):
            own = [[] for _ in books[p]]
            for _, v, _ in kept:
                own[nearest(p, v[p * w : (p + 1) * w])[1]].append(v[p * w : (p + 1) * w])
            new.append([[sum(c) // len(m) for c in zip(*m)] if m else books[p][e] for e, m in enumerate(own)])
        books = new
    out = []
    for i, v, label in kept:
        best = [nearest(p, v[p * w : (p + 1) * w]) for p in range(parts)]
        out.append((i, "".join(f"{e:02x}" for _, e in best), sum(d for d, _ in best), label))
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    sums = {}
    for _, _, error, label in out:
        sums[label] = sums.get(label, 0) + error
    return sorted(((i, c, e, sums[label], digest) for i, c, e, label in out), key=repr)


def got(df, **kw):
    return sorted((tuple(r) for r in vc.compress(df, **kw).collect()), key=repr)


def vectors(n, dims, seed, spread=0.2):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 0.3, (6, dims))
    return [(i, [float(np.float32(x)) for x in rng.normal(centres[i % 6], spread)], i % 4 if i % 7 else None) for i in range(n)]


def test_codes_equal_a_full_search(spark):
    rows = vectors(150, 32, 1)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert got(df) == brute(rows)


def test_nulls_lengths_ties_repeats_and_clashing_names(spark):
    rows = vectors(40, 13, 2) + [
        (100, None, 1), (101, [1.0, None, 2.0], 1), (102, [float("nan")] * 3, 1), (103, [float("inf"), 1.0], None), (104, [], 2),
        (3, [0.5] * 13, 9), (3, [0.5] * 13, 9), (None, [-0.25] * 13, 2), (None, [0.25] * 20, 2), (-5, [2.0, -3.0], None),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("id", "ints", "code", "error", "n", "l", "part", "vector"):
        df = df.withColumn(name, F.lit("clash"))
    assert got(df.repartition(3)) == brute(rows)


def test_fewer_rows_than_entries_and_an_empty_table(spark):
    rows = vectors(5, 16, 3)
    assert got(spark.createDataFrame(rows, SCHEMA)) == brute(rows)
    assert got(spark.createDataFrame([], SCHEMA)) == []
    assert got(spark.createDataFrame([(1, None, 1)], SCHEMA)) == []


def test_large_components_count_as_the_largest_that_fits(spark):
    rows = [(i, [3e38, -3e38, 0.5 * i, 1e9, 0.0, 1.0, 2.0, 3.0], 1) for i in range(20)]
    out = vc.compress(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(out) == 20 and all(r["error"] >= 0 for r in out)


@pytest.mark.parametrize("bits", [0, 4, 10, 20])
def test_grid_cells_never_change_the_nearest_entry(bits):
    rng = np.random.default_rng(4)
    entries = rng.integers(-900, 900, (16, 8))
    entries[5] = entries[2]
    x = np.concatenate([rng.integers(-1500, 1500, (3000, 8)), entries, (entries[:8] + entries[8:]) // 2])
    cells = vc.GridCells(entries, bits)
    d = ((x[:, None] - entries) ** 2).sum(2)
    for _ in range(2):
        code, best = cells.nearest(x)
        np.testing.assert_array_equal(code, d.argmin(1))
        np.testing.assert_array_equal(best, d.min(1))


def test_grid_cells_measure_fewer_entries_and_forget():
    rng = np.random.default_rng(5)
    entries = rng.integers(-4000, 4000, (16, 4))
    cells = vc.GridCells(entries, 9)
    x = rng.integers(-4000, 4000, (20000, 4))
    cells.nearest(x[:4096])
    assert cells.measured < 0.6 * 16 * 4096
    small = vc.GridCells(entries, 2, cells=1)
    for start in range(0, 20000, 4096):
        code, _ = small.nearest(x[start : start + 4096])
        np.testing.assert_array_equal(code, ((x[start : start + 4096, None] - entries) ** 2).sum(2).argmin(1))
        assert len(small.known) <= small.cells


def test_a_colliding_cell_is_measured_against_all(monkeypatch):
    rng = np.random.default_rng(6)
    entries, x = rng.integers(-900, 900, (16, 8)), rng.integers(-1500, 1500, (500, 8))
    monkeypatch.setattr(vc, "mix", lambda h: h & np.uint64(1))
    code, _ = vc.GridCells(entries, 6).nearest(x)
    np.testing.assert_array_equal(code, ((x[:, None] - entries) ** 2).sum(2).argmin(1))


def test_rare_and_common_labels_get_equal_sums(spark, monkeypatch):
    rows = vectors(120, 8, 7)
    df = spark.createDataFrame(rows, SCHEMA)
    want = got(df)
    monkeypatch.setattr(vc, "COMMON", 1)
    assert got(df) == want == brute(rows)
