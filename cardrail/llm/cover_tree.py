"""Exact top-k inner products: a dual-tree search over cover trees.

A node of a tree covers its points by a ball around one of them; its children are centres of smaller balls, picked one
after another as the point farthest from all so far, until they cover the node by half its radius or are ``fanout`` many.
Data shards and query blocks each have a tree. A search goes down both at once, pairs of greatest bound first: no pair
of points in nodes with centres q, r and radii a, b has a greater product than ``q.r + a|r| + b|q| + ab``, so a pair of
nodes whose bound is below the worst kth score of the queries in the query node is left out. Bounds equal to that score
stay, since ties go to smaller ids.

Products are of integers and exact. Sums below 2**53 are taken in doubles; larger ones in Python integers, and a score
beyond the range of a long becomes the nearest long.

Defined results: see ``vectors.whole_vectors`` for rows that take no part (a vector of zeros does); equal vectors are
one point and all answer; a query id that repeats searches with its least vector; vectors of another width are never
compared; fewer candidates than asked for are all returned; an empty table gives an empty result; other columns are
left out.
"""

from __future__ import annotations

import heapq
import io
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, functions as F

from cardrail.llm import vectors as V

LEAF, FANOUT = 64, 12
EXACT = float(1 << 53)


@dataclass
class Tree:
    """Points in an order in which every node's are contiguous; nodes as flat arrays, the root first."""

    points: np.ndarray  # int64, as doubles they are rounded at most by their own precision
    order: np.ndarray  # the place of each point in the input
    centre: np.ndarray
    radius: np.ndarray
    start: np.ndarray
    end: np.ndarray
    child: np.ndarray  # the first child; -1 for a leaf
    children: np.ndarray

    @classmethod
    def build(cls, points: np.ndarray, leaf: int = LEAF, fanout: int = FANOUT) -> Tree:
        x = points.astype("f8")
        order = np.arange(len(x))
        nodes: list[list] = []

        def node(a: int, b: int, centre: int) -> int:
            own = x[order[a:b]]
            nodes.append([centre, float(np.sqrt(((own - x[centre]) ** 2).sum(axis=1).max())), a, b, -1, 0])
            return len(nodes) - 1

        todo = [node(0, len(x), int(np.argmin(((x - x.mean(axis=0)) ** 2).sum(axis=1))))]
        while todo:
            at = todo.pop()
            centre, radius, a, b, _, _ = nodes[at]
            if b - a <= leaf or radius == 0:
                continue
            own = order[a:b].copy()
            centres, near = [centre], np.sqrt(((x[own] - x[centre]) ** 2).sum(axis=1))
            belongs = np.zeros(len(own), int)
            while len(centres) < fanout and near.max() > radius / 2:
                far = int(own[np.argmax(near)])
                d = np.sqrt(((x[own] - x[far]) ** 2).sum(axis=1))
                belongs[d < near] = len(centres)
                near = np.minimum(near, d)
                centres.append(far)
            sizes = np.bincount(belongs, minlength=len(centres))
            if sizes.max() == len(own):
                continue
            order[a:b] = own[np.argsort(belongs, kind="stable")]
            ends = a + np.cumsum(sizes)
            nodes[at][4:] = [len(nodes), int((sizes > 0).sum())]
            made = [node(int(e - n), int(e), c) for e, n, c in zip(ends, sizes, centres, strict=True) if n]
            todo += made
        kinds = ("i8", "f8", "i8", "i8", "i8", "i8")
        columns = [np.array(c, k) for c, k in zip(zip(*nodes), kinds, strict=True)]
        return cls(points[order], order, points[columns[0]].astype("f8"), *columns[1:])


def products(queries: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Inner products of integer rows, exact, as longs."""
    if not len(queries) or not len(data):
        return np.zeros((len(queries), len(data)), "i8")
    most = float(np.abs(queries.astype("f8")).max()) * float(np.abs(data.astype("f8")).max()) * queries.shape[1]
    if most < EXACT:
        return (queries.astype("f8") @ data.astype("f8").T).astype("i8")
    exact = queries.astype(object) @ data.astype(object).T
    return np.clip(exact, -(2**63), 2**63 - 1).astype("i8")


def search(data: Tree, ids: list[np.ndarray], queries: Tree, query_ids: np.ndarray, k: int) -> Iterator[tuple]:
    """(query id, id, score) of the ``k`` greatest products of each query, ties to smaller ids."""
    best: list[list[tuple[int, int]]] = [[] for _ in query_ids]  # by query place: a heap of (score, -id)
    names = query_ids[queries.order]
    worst = np.full(len(names), -np.inf)  # the kth score so far
    q_size, d_size = np.sqrt((queries.centre**2).sum(axis=1)), np.sqrt((data.centre**2).sum(axis=1))

    def bounds(qs: np.ndarray, ds: np.ndarray) -> np.ndarray:
        a, b = queries.radius[qs][:, None], data.radius[ds][None, :]
        at = queries.centre[qs] @ data.centre[ds].T
        found = at + a * d_size[ds][None, :] + b * q_size[qs][:, None] + a * b
        return found + 1e-9 * (np.abs(found) + 1)  # for rounding

    def under(tree: Tree, node: int) -> np.ndarray:
        first = tree.child[node]
        return np.array([node]) if first < 0 else np.arange(first, first + tree.children[node])

    def compare(q: int, d: int) -> None:
        rows = slice(queries.start[q], queries.end[q])
        held = slice(data.start[d], data.end[d])
        scores = products(queries.points[rows], data.points[held])
        for i, j in zip(*np.nonzero(scores >= worst[rows, None])):
            row, score = int(queries.start[q] + i), int(scores[i, j])
            for other in ids[data.order[held.start + j]].tolist():
                if other == names[row]:
                    continue
                if len(best[row]) < k:
                    heapq.heappush(best[row], (score, -other))
                elif (score, -other) > best[row][0]:
                    heapq.heapreplace(best[row], (score, -other))
                else:
                    break  # ids ascend
            if len(best[row]) == k:
                worst[row] = best[row][0][0]

    todo = [(-float("inf"), 0, 0)]
    while todo:
        bound, q, d = heapq.heappop(todo)
        if -bound < worst[queries.start[q] : queries.end[q]].min():
            continue
        if queries.child[q] < 0 and data.child[d] < 0:
            compare(q, d)
            continue
        # the wider node is opened, both if they are alike
        q_wide = queries.child[q] >= 0 and (data.child[d] < 0 or 2 * queries.radius[q] >= data.radius[d])
        d_wide = data.child[d] >= 0 and (queries.child[q] < 0 or 2 * data.radius[d] >= queries.radius[q])
        qs = under(queries, q) if q_wide else np.array([q])
        ds = under(data, d) if d_wide else np.array([d])
        for i, row in zip(qs.tolist(), bounds(qs, ds).tolist()):
            least = worst[queries.start[i] : queries.end[i]].min()
            for j, value in zip(ds.tolist(), row):
                if value >= least:
                    heapq.heappush(todo, (-value, i, j))
    for name, found in zip(names.tolist(), best):
        yield from ((name, -other, score) for score, other in sorted(found, reverse=True))


def as_integers(rows: DataFrame, scale: int) -> DataFrame:
    """Each component x as floor(scale * x)."""
    return rows.withColumn("vector", F.transform("vector", lambda x: F.floor(x * float(scale)).cast("long")))


def greatest(
    rows: DataFrame, divisor: int, k: int, scale: int, vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """For each row whose id ``divisor`` divides, the ``k`` other rows of greatest inner product."""
    rows = as_integers(V.whole_vectors(rows, vec_id, vector, zeros=True), scale)

    def build(vectors: np.ndarray, ids: list[list[int]]) -> bytes:
        out, tree = io.BytesIO(), Tree.build(vectors)
        ends = np.cumsum([0, *map(len, ids)])
        np.savez(out, **vars(tree), ends=ends, ids=np.array([i for row in ids for i in row], "i8"))
        return out.getvalue()

    def find(blob: bytes, query_ids: np.ndarray, queries: np.ndarray) -> Iterator[tuple]:
        with np.load(io.BytesIO(blob)) as found:
            ids = np.split(found["ids"], found["ends"][1:-1])
            tree = Tree(**{name: found[name] for name in Tree.__dataclass_fields__})
        yield from search(tree, ids, Tree.build(queries), query_ids, k)

    index = V.index_shards(V.classes(rows, k + 1), build, "i8")
    blocks = V.query_blocks(V.query_rows(rows, divisor), "i8")
    return V.search(index, blocks, find, k, F.col("score").desc(), "i8", "long")
