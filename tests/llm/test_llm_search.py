"""Vector searches against brute force."""

import math

import numpy as np
import pytest

from cardrail.llm import cover_tree, hnsw

SCHEMA = "vec_id long, embedding array<float>, label int, ids string, score double, place int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", 1.0, 2) for i, v in rows], SCHEMA).repartition(3)


def odd_rows(width):
    one = [1.0] + [0.0] * (width - 1)
    return [
        (None, one),
        (100_000, None),
        (100_100, []),
        (100_200, [0.0] * width),
        (100_300, [-0.0] * width),
        (100_400, [math.nan] + one[1:]),
        (100_500, [math.inf] + one[1:]),
        (100_600, [None] + one[1:]),
        (100_700, [0.5, 0.5]),
        (100_701, [0.5, 0.25]),
    ]


@pytest.fixture(scope="module")
def rows():
    draw = np.random.default_rng(4)
    x = draw.normal(size=(1500, 12)).astype("f4")
    x[200:320] = x[200]  # copies
    x[400:500] = x[400] + draw.normal(size=(100, 12)).astype("f4") * 1e-4  # a tight cluster
    out = [(i, v.tolist()) for i, v in enumerate(x)]
    return [*out, out[0], out[700], *odd_rows(12)]


def usable(rows, zeros):
    seen = {}
    for i, v in rows:
        fine = i is not None and v and all(c is not None and math.isfinite(c) for c in v)
        if fine and (zeros or any(v)):
            seen[i] = np.array(v, "f4").astype("f8")
    return seen


def nearest(rows, divisor, k):
    seen, out = usable(rows, zeros=False), {}
    for q, x in seen.items():
        if q % divisor == 0:
            others = [(float(np.sqrt(((x - y) ** 2).sum())), i) for i, y in seen.items() if i != q and len(y) == len(x)]
            out[q] = sorted(others)[:k]
    return out


def test_graph_search(spark, rows):
    found = hnsw.nearest(frame(spark, rows), divisor=50, k=10).collect()
    want = nearest(rows, 50, 10)
    got = {}
    for r in sorted(found, key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append((r.score, r.vec_id))
    assert got.keys() == {q for q, n in want.items() if n}
    hits = total = 0
    for q, near in got.items():
        assert near == sorted(near) and len(near) == len(want[q])
        exact = dict((i, d) for d, i in nearest(rows, 50, 2000)[q]) if q < 500 else {}
        assert all(math.isclose(exact[i], d, rel_tol=1e-12, abs_tol=1e-12) for d, i in near if exact)
        hits += len({i for _, i in near} & {i for _, i in want[q]})
        total += len(near)
    assert hits / total >= 0.97
    # copies: the smallest ids at distance nothing
    assert [i for _, i in got[250]] == list(range(200, 210))
    assert [i for _, i in got[200]] == list(range(201, 211))


def test_graph_search_of_few_rows(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (100, [1.0, 0.0])]
    found = sorted(tuple(r) for r in hnsw.nearest(frame(spark, rows), divisor=100, k=10).collect())
    assert found == [(0, 1, 100, 0.0), (0, 2, 1, math.sqrt(2)), (100, 1, 0, 0.0), (100, 2, 1, math.sqrt(2))]
    assert hnsw.nearest(frame(spark, rows).limit(0), divisor=100, k=10).count() == 0
    assert hnsw.nearest(frame(spark, rows[:1]), divisor=100, k=10).count() == 0


def test_graph_survives_storage():
    x = np.random.default_rng(5).normal(size=(600, 8))
    s = hnsw.Settings()
    graph = hnsw.Graph.build(x, s)
    again, ends, ids = hnsw.Graph.load(graph.dump([[2 * i, 2 * i + 1] for i in range(600)]), s)
    a, b = (list(map(list, g.search(x[:20], 30))) for g in (graph, again))
    assert a == b and ids[ends[7] : ends[8]].tolist() == [14, 15]
    assert all(len(set(r)) == len(r) for level in graph.levels for r in [[i for i in row if i >= 0] for row in level.links.tolist()])


def greatest(rows, divisor, k, scale):
    seen = {i: np.floor(scale * v) for i, v in usable(rows, zeros=True).items()}
    out = []
    for q, x in seen.items():
        if q % divisor == 0:
            others = sorted((-int(x @ y), i) for i, y in seen.items() if i != q and len(y) == len(x))[:k]
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(others, 1)]
    return sorted(out)


def test_products_are_exact(spark, rows):
    found = cover_tree.greatest(frame(spark, rows), divisor=50, k=5, scale=256)
    assert sorted(tuple(r) for r in found.collect()) == greatest(rows, 50, 5, 256)


def test_products_of_few_rows(spark):
    rows = [(0, [1.0, 0.0]), (50, [0.0, 0.0]), (3, [-1.0, 2.0])]
    found = cover_tree.greatest(frame(spark, rows), divisor=50, k=5, scale=256)
    assert sorted(tuple(r) for r in found.collect()) == greatest(rows, 50, 5, 256)
    assert cover_tree.greatest(frame(spark, rows).limit(0), divisor=50, k=5, scale=256).count() == 0


def test_dual_search_leaves_out_only_what_cannot_win():
    draw = np.random.default_rng(6)
    data = np.concatenate([draw.integers(-40, 40, (900, 6)), draw.integers(-3, 3, (300, 6)) + 60])
    queries = draw.integers(-50, 50, (130, 6))
    ids, names = np.arange(1200), np.arange(5000, 5130)
    found = sorted(cover_tree.search(cover_tree.Tree.build(data), list(ids[:, None]), cover_tree.Tree.build(queries), names, 4))
    want = []
    for name, q in zip(names.tolist(), queries):
        top = sorted((-int(s), i) for i, s in enumerate(data @ q))[:4]
        want += [(name, i, -s) for s, i in top]
    assert found == sorted(want)


def test_large_products_are_exact():
    x = np.array([[2**40, 3], [2**62, 2**62]])
    assert cover_tree.products(x, x).tolist() == [[2**63 - 1, 2**63 - 1], [2**63 - 1, 2**63 - 1]]
    y = np.array([[2**30 + 1, 2**29 - 1]])
    assert cover_tree.products(y, y).tolist() == [[(2**30 + 1) ** 2 + (2**29 - 1) ** 2]]
