"""Approximate nearest neighbours: a hierarchical navigable small-world graph for each shard.

Levels hold ever fewer nodes. Within a level every node links to near nodes in different directions. A search goes down
from the top, greedily, and on the lowest level keeps the ``ef`` nearest nodes found while it follows links. A shard's
graph is stored as flat arrays: for each level the nodes in it, and a row of neighbour numbers for each. Nodes come in,
and queries are run, many at a time, so that numpy works on whole batches.

The lowest level is searched for all queries against every shard, the shards' answers are measured again in double
precision on the original vectors, and merged.

Defined results: see ``vectors.whole_vectors`` for rows that take no part; equal vectors are one node and all answer;
a query id that repeats searches with its least vector; vectors of another width are never near; fewer candidates than
asked for are all returned; an empty table gives an empty result; other columns are left out.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, functions as F

from cardrail.llm import vectors as V


@dataclass(frozen=True)
class Settings:
    links: int = 16
    ef_build: int = 96
    ef_search: int = 160
    batch: int = 256
    seed: int = 11


class Level:
    """The nodes of a level (numbers in the shard), and their links (numbers in the level; -1 for none)."""

    def __init__(self, nodes: np.ndarray, links: np.ndarray, vectors: np.ndarray):
        self.nodes, self.links = nodes, links
        self.x = vectors[nodes]
        self.sizes = np.einsum("nd,nd->n", self.x, self.x)

    def distances(self, queries: np.ndarray, near: np.ndarray) -> np.ndarray:
        """Squared distances of each query to the nodes in its row of ``near``."""
        dots = np.einsum("bmd,bd->bm", self.x[near], queries)
        return np.einsum("bd,bd->b", queries, queries)[:, None] - 2 * dots + self.sizes[near]

    def beam(self, queries: np.ndarray, start: np.ndarray, ef: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``ef`` nearest nodes found for each query from its start, with squared distances; -1 for none."""
        n = len(queries)
        near, far = np.full((n, ef), -1), np.full((n, ef), np.inf)
        new = np.zeros((n, ef), bool)
        seen = np.zeros((n, len(self.x)), bool)
        near[:, 0], new[:, 0] = start, True
        far[:, 0] = self.distances(queries, start[:, None])[:, 0]
        seen[np.arange(n), start] = True
        active = np.arange(n)
        while len(active):
            at = np.argmin(np.where(new[active], far[active], np.inf), axis=1)
            new[active, at] = False
            found = self.links[near[active, at]]
            fit = (found >= 0) & ~seen[active[:, None], found]
            some = fit.any(axis=1)
            if some.any():
                rows, found, fit = active[some], found[some], fit[some]
                seen[rows[:, None], np.where(fit, found, found.max(axis=1)[:, None])] = True
                d = np.where(fit, self.distances(queries[rows], np.maximum(found, 0)), np.inf)
                all_d = np.concatenate([far[rows], d], axis=1)
                all_i = np.concatenate([near[rows], found], axis=1)
                all_n = np.concatenate([new[rows], fit], axis=1)
                best = np.argpartition(all_d, ef - 1, axis=1)[:, :ef]
                far[rows] = np.take_along_axis(all_d, best, 1)
                near[rows] = np.take_along_axis(all_i, best, 1)
                new[rows] = np.take_along_axis(all_n, best, 1)
                none = ~np.isfinite(far[rows])
                near[rows] = np.where(none, -1, near[rows])
                new[rows] &= ~none
            active = active[new[active].any(axis=1)]
        order = np.argsort(far, axis=1, kind="stable")
        return np.take_along_axis(near, order, 1), np.take_along_axis(far, order, 1)


def diverse(x: np.ndarray, near: np.ndarray, far: np.ndarray, keep: int) -> np.ndarray:
    """For each row, up to ``keep`` of the nodes in ``near`` (ascending by ``far``; -1 for none).

    A node is taken if it is nearer to the row's own node than to any taken one; places left over go to the nearest of
    the others.
    """
    rows, width = near.shape
    v = x[np.maximum(near, 0)]
    size = np.einsum("rwd,rwd->rw", v, v)
    apart = size[:, :, None] + size[:, None, :] - 2 * np.matmul(v, v.transpose(0, 2, 1))
    taken, count = np.zeros((rows, width), bool), np.zeros(rows, int)
    least = np.full((rows, width), np.inf)
    for j in range(width):
        ok = (near[:, j] >= 0) & (far[:, j] < least[:, j]) & (count < keep)
        taken[:, j] = ok
        count += ok
        least = np.where(ok[:, None], np.minimum(least, apart[:, j, :]), least)
    first = np.argsort(np.where(near < 0, 2, ~taken) * width + np.arange(width), axis=1)[:, :keep]
    out = np.take_along_axis(near, first, 1)
    return np.pad(out, ((0, 0), (0, max(0, keep - width))), constant_values=-1)


def _link_back(level: Level, new: np.ndarray, chosen: np.ndarray) -> None:
    """Adds the links from the chosen nodes to the new ones; a node with too many keeps a diverse set."""
    width = level.links.shape[1]
    source, target = np.repeat(new, chosen.shape[1]), chosen.ravel()
    source, target = source[target >= 0], target[target >= 0]
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    nodes, first, count = np.unique(target, return_index=True, return_counts=True)
    for part in np.array_split(np.arange(len(nodes)), max(1, len(nodes) // 256)):
        if not len(part):
            continue
        own, extra = nodes[part], np.full((len(part), count[part].max()), -1)
        for row, i in enumerate(part):
            extra[row, : count[i]] = source[first[i] : first[i] + count[i]]
        extra[(extra[:, :, None] == level.links[own][:, None, :]).any(axis=2)] = -1  # linked already
        near = np.concatenate([level.links[own], extra], axis=1)
        far = np.where(near >= 0, level.distances(level.x[own], np.maximum(near, 0)), np.inf)
        order = np.argsort(far, axis=1, kind="stable")
        near, far = np.take_along_axis(near, order, 1), np.take_along_axis(far, order, 1)
        room = (near >= 0).sum(axis=1) <= width
        level.links[own[room]] = near[room][:, :width]
        if not room.all():
            level.links[own[~room]] = diverse(level.x, near[~room], far[~room], width)


class Graph:
    """The levels of a shard, the top one first. Every level's first nodes are those of the level above."""

    def __init__(self, vectors: np.ndarray, levels: list[Level], settings: Settings):
        self.vectors, self.levels, self.settings = vectors, levels, settings

    @classmethod
    def build(cls, vectors: np.ndarray, settings: Settings) -> Graph:
        n = len(vectors)
        draw = np.random.default_rng(settings.seed)
        height = np.floor(-np.log(1 - draw.random(n)) / np.log(settings.links)).astype(int)
        graph = cls(vectors, [], settings)
        order = np.argsort(-height, kind="stable")
        for h in range(height.max(), -1, -1):
            graph._add_level(order[: int((height >= h).sum())], settings.links * (1 if h else 2))
        return graph

    def _add_level(self, nodes: np.ndarray, width: int) -> None:
        s = self.settings
        level = Level(nodes, np.full((len(nodes), width), -1), self.vectors)
        starts = self._descend(level.x)
        for a in range(0, len(nodes), s.batch):
            new = np.arange(a, min(a + s.batch, len(nodes)))
            x = level.x[new]
            # the batch's own nodes are compared with each other directly
            near = np.broadcast_to(new, (len(new), len(new)))
            far = level.sizes[new][:, None] + level.sizes[new][None, :] - 2 * x @ x.T
            np.fill_diagonal(far, np.inf)
            near = np.where(np.isfinite(far), near, -1)
            if a:
                found, d = level.beam(x, starts[new] if starts is not None else np.zeros(len(new), int), s.ef_build)
                # a start that is in the batch itself is no candidate twice
                d = np.where((found < 0) | (found >= a), np.inf, d)
                near, far = np.concatenate([near, found], axis=1), np.concatenate([far, d], axis=1)
            order = np.argsort(far, axis=1, kind="stable")[:, : s.ef_build]
            near, far = np.take_along_axis(near, order, 1), np.take_along_axis(far, order, 1)
            near = np.where(np.isfinite(far), near, -1)
            chosen = diverse(level.x, near, far, s.links)
            level.links[new, : s.links] = chosen
            _link_back(level, new, chosen)
        self.levels.append(level)

    def _descend(self, queries: np.ndarray) -> np.ndarray | None:
        """For each query the number, in the level below those there are, of the nearest node found; None without any.

        A level's first nodes are those of the level above, in the same order, so a number holds on both.
        """
        at = None
        for level in self.levels:
            start = np.zeros(len(queries), int) if at is None else at
            at = np.concatenate([level.beam(q, s, 1)[0][:, 0] for q, s in _batches(queries, start, 1024)])
        return at

    def search(self, queries: np.ndarray, ef: int) -> Iterator[np.ndarray]:
        """For each query the numbers of the nodes found; -1 for none."""
        *upper, lowest = self.levels
        at = Graph(self.vectors, upper, self.settings)._descend(queries) if upper else np.zeros(len(queries), int)
        for q, s in _batches(queries, at, self.settings.batch):
            found = lowest.beam(q, s, min(ef, len(lowest.nodes)))[0]
            yield from np.where(found >= 0, lowest.nodes[np.maximum(found, 0)], -1)

    def dump(self, ids: list[list[int]]) -> bytes:
        """The graph as flat arrays, with the ids of each node."""
        out, ends = io.BytesIO(), np.cumsum([0, *map(len, ids)])
        arrays = {"vectors": self.vectors, "ends": ends, "ids": np.array([i for row in ids for i in row], "i8")}
        for h, level in enumerate(self.levels):
            arrays |= {f"nodes{h}": level.nodes.astype("i4"), f"links{h}": level.links.astype("i4")}
        np.savez(out, **arrays)
        return out.getvalue()

    @classmethod
    def load(cls, blob: bytes, settings: Settings) -> tuple[Graph, np.ndarray, np.ndarray]:
        """The graph, and the ends and values of its nodes' ids."""
        with np.load(io.BytesIO(blob)) as found:
            vectors, h, levels = found["vectors"], 0, []
            while f"nodes{h}" in found:
                levels.append(Level(found[f"nodes{h}"].astype(int), found[f"links{h}"].astype(int), vectors))
                h += 1
            return cls(vectors, levels, settings), found["ends"], found["ids"]


def _batches(queries: np.ndarray, starts: np.ndarray, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for a in range(0, len(queries), size):
        yield queries[a : a + size], starts[a : a + size]


def nearest(
    rows: DataFrame, divisor: int, k: int, settings: Settings | None = None, vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """For each row whose id ``divisor`` divides, the ``k`` nearest other rows found, by Euclidean distance."""
    s = settings or Settings()
    rows = V.whole_vectors(rows, vec_id, vector, zeros=False)

    def build(vectors: np.ndarray, ids: list[list[int]]) -> bytes:
        return Graph.build(vectors, s).dump(ids)

    def find(blob: bytes, query_ids: np.ndarray, queries: np.ndarray) -> Iterator[tuple]:
        graph, ends, ids = Graph.load(blob, s)
        for query_id, query, found in zip(query_ids.tolist(), queries, graph.search(queries, s.ef_search), strict=True):
            found = found[found >= 0]
            scores = np.sqrt(((graph.vectors[found] - query) ** 2).sum(axis=1)).tolist()
            near = sorted((d, i) for d, n in zip(scores, found) for i in ids[ends[n] : ends[n + 1]].tolist() if i != query_id)
            yield from ((query_id, i, d) for d, i in near[:k])

    index = V.index_shards(V.classes(rows, k + 1), build, "f8")
    blocks = V.query_blocks(V.query_rows(rows, divisor), "f8")
    return V.search(index, blocks, find, k, F.col("score"), "f8", "double")
