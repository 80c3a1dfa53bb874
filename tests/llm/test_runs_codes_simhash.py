"""Periodic runs, vector codes and SimHash links against plain statements of them."""

import collections
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from spanstore.llm import periodic_runs, simhash, vector_codes

from .test_contracts import brute_runs


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("ab"), max_size=40), st.lists(st.sampled_from("abc"), min_size=1, max_size=7), st.integers(0, 60), st.sampled_from([2, 3, 4]), st.sampled_from([2, 6, 9]))
def test_runs_equal_all_periods_tried(head, period, n, exponent, least):
    words = head + (period * n)[:n] + head[:7]
    assert periodic_runs.find_runs(periodic_runs.word_codes([w.encode() for w in words]), least, exponent) == brute_runs(words, least, exponent)


def test_texts_worked_together_keep_apart():
    one, two = [b"a"] * 9, b"a b a b a b a b".split()
    assert periodic_runs.runs_of([one, [], one, two, [b"b", b"a"]]) == [[(0, 9, 1)], [], [(0, 9, 1)], [(0, 8, 2)], []]


def test_a_word_without_end():
    """Positions in blocks: half a million equal words are one run."""
    assert periodic_runs.find_runs(np.zeros(500_000, np.int64)) == [(0, 500_000, 1)]


def test_collapse_keeps_columns(spark):
    docs = spark.createDataFrame([(1, "x\ny " * 6, "a"), (2, None, None)], "doc_id long, text string, runs string")
    rows = periodic_runs.collapse_runs(docs).collect()
    assert [(r["doc_id"], r["text"], r["n_words"], [tuple(x) for x in r["runs"]]) for r in rows] == [(1, "x y", 12, [(0, 12, 2)]), (2, "", 0, [])]


def plain_codes(vectors, parts, entries, rounds):
    """One vector at a time; vectors: (id, components)."""
    width = -(-max(len(v) for _, v in vectors) // parts) * parts
    cells = [(i, [math.floor(x * 4096) if abs(x) < 2**40 else int(x) * 4096 for x in v] + [0] * (width - len(v))) for i, v in vectors]
    step = width // parts
    first = {}
    for i, v in sorted(zip([i for i, _ in vectors], [v for _, v in vectors]), key=lambda p: (p[0] is None, p[0] or 0, p[1])):
        first.setdefault(i, v)
    books = [[dict(cells)[i][m * step : (m + 1) * step] for i in list(first)[:entries]] for m in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    for r in range(rounds + 1):
        near = [[min((far(v[m * step : (m + 1) * step], e), k) for k, e in enumerate(books[m])) for m in range(parts)] for _, v in cells]
        for m in range(parts) if r < rounds else ():
            for k in range(len(books[m])):
                mine = [v[m * step : (m + 1) * step] for (_, v), n in zip(cells, near) if n[m][1] == k]
                if mine:
                    books[m][k] = [sum(c) // len(mine) for c in zip(*mine)]
    return collections.Counter((i, bytes(n[1] for n in ns), sum(n[0] for n in ns)) for (i, _), ns in zip(cells, near)), books


@pytest.mark.parametrize("scale", [1.0, 1e7, 1e30, 1e300])
def test_codes_of_any_size_are_exact(spark, monkeypatch, scale):
    monkeypatch.setattr(vector_codes, "BLOCK_ROWS", 7)
    r = np.random.default_rng(5)
    vectors = [(i, [float(x) for x in r.normal(size=r.integers(1, 11)) * (scale if i % 5 == 0 else 1)]) for i in range(60)]
    vectors += [(None, [0.5]), (None, [0.5]), (3000, []), (59, list(vectors[59][1]))]
    df = spark.createDataFrame(vectors, "vec_id long, v array<double>").repartition(3)
    found, books = vector_codes.compress(df, ["vec_id"], parts=4, entries=5, rounds=3)
    want, plain = plain_codes(vectors, 4, 5, 3)
    step = books.width // 4
    assert [[e[m * step : (m + 1) * step] for e in books.entries] for m in range(4)] == plain
    limit = lambda e: e if e < 1 << 63 else None
    assert collections.Counter((x["vec_id"], bytes(x["code"]), x["error"]) for x in found.collect()) == collections.Counter({(i, c, limit(e)): n for (i, c, e), n in want.items()})


@pytest.mark.parametrize("rows", [[], [(1, None), (2, [None]), (3, [float("inf")])], [(1, []), (None, [])]])
def test_codes_without_components(spark, rows):
    found, books = vector_codes.compress(spark.createDataFrame(rows, "vec_id long, v array<double>"), ["vec_id"])
    assert [(x["vec_id"], x["error"]) for x in found.collect()] == [(i, 0) for i, v in rows if v == []]
    assert (books is None) == (not any(v == [] for _, v in rows))


def linked(points):
    """Smallest id reachable, all pairs met."""
    label = {i: i for i, _ in points}
    values = np.asarray([v for _, v in points], np.uint64)
    near = [np.flatnonzero(np.bitwise_count(values ^ v) <= 3) for v in values]
    ids = [i for i, _ in points]
    moved = True
    while moved:
        moved = False
        for k, i in enumerate(ids):
            least = min(label[ids[j]] for j in near[k])
            moved |= least < label[i]
            label[i] = least
    return label


@pytest.mark.parametrize("cell, tile", [(1024, 512), (6, 3)])
def test_crowded_cells_lose_no_link(spark, cell, tile):
    """Dense clusters, by cells as they are and by refined and tiled ones."""
    r = random.Random(3)
    points = []
    for _ in range(2):
        base = r.getrandbits(64)
        for _ in range(150):
            x = base
            for _ in range(r.choice([1, 2, 4, 7, 12])):
                x ^= 1 << r.randrange(64)
            points.append(x)
    points = list(enumerate(points + [r.getrandbits(64) for _ in range(60)] + points[:20]))
    df = spark.createDataFrame([(i, v - (1 << 64) if v >> 63 else v) for i, v in points], "doc_id long, fp long")
    assert {x["doc_id"]: x["component_id"] for x in simhash.link_fingerprints(df, cell, tile).collect()} == linked(points)


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 2**64 - 1), st.lists(st.integers(0, 63), max_size=5), st.sampled_from([4, 5, 7, 10]))
def test_near_points_share_a_cell(x, flips, blocks):
    y = x
    for b in flips[:3]:
        y ^= 1 << b
    u, v = simhash._unary(np.asarray([x, y], np.uint64))
    assert (u ^ v).bit_count() <= (x ^ y).bit_count()
    assert any((int(u) ^ int(v)) & (m & (2**64 - 1)) == 0 for m in simhash.grids(blocks))


def test_columns_count_as_arrays_do(spark):
    values = [random.Random(i).getrandbits(64) for i in range(50)]
    df = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fp long")
    got = [r[0] & (2**64 - 1) for r in df.select(simhash.unary_counts(df["fp"])).collect()]
    assert got == simhash._unary(np.asarray(values, np.uint64)).tolist()
