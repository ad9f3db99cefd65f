"""Layered proximity graphs, one for each shard of the vectors, and their search by a beam.

A shard is as many vectors as a size allows and one row of a table: places, vectors, codes and the
links of all layers, so it is never torn apart and a search needs no shuffle. Nodes are numbered by the
highest layer they reach, so each layer holds a first stretch of them. Layers are built from the top:
a batch as large as what is there is compared with all nodes before it by matrix products, which for a shard's
rows cost a small part of what beams do, and is linked both ways. Of the nearest found, a node keeps those that
are nearer to it than to one kept before.

A search walks greedily down to the lowest layer and keeps a beam of the best there. All queries of a
block move together, so each step is a few array operations.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

#: Bytes of work arrays that one step may hold.
WORK = 64 << 20
#: Bytes of the vectors that pairs are compared by at once: they stay in a core's cache.
COMPARED = 1 << 20
#: Best nodes of each query that are followed in a step of a beam.
FOLLOWED = 4


class Space:
    """Nearness of vectors, greater is nearer: inner product or negative squared distance."""

    def __init__(self, x: np.ndarray, by_l2: bool):
        self.x, self.by_l2 = np.ascontiguousarray(x, np.float32), by_l2
        self.squares = np.einsum("ij,ij->i", self.x, self.x) if by_l2 else None

    def to(self, q: np.ndarray):
        """A function of (rows of q, nodes) that gives the nearness of each pair."""
        q = np.ascontiguousarray(q, np.float32)
        mine = np.einsum("ij,ij->i", q, q) if self.by_l2 else None
        step = max(1, COMPARED // (8 * max(1, q.shape[1])))

        def near(rows: np.ndarray, nodes: np.ndarray) -> np.ndarray:
            out = np.empty(len(rows), np.float32)
            for k in range(0, len(rows), step):
                r, n = rows[k : k + step], nodes[k : k + step]
                dot = np.einsum("ij,ij->i", q[r], self.x[n])
                out[k : k + step] = 2 * dot - mine[r] - self.squares[n] if self.by_l2 else dot
            return out

        return near

    def before(self, new: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        """For each of some nodes in ascending order the nearest of all before it, at most so many, best first and -1 where there are none, and their nearness."""
        n = int(new[-1])
        score = self.x[new] @ self.x[:n].T
        if self.by_l2:
            score = 2 * score - self.squares[new, None] - self.squares[None, :n]
        score[np.arange(n)[None, :] >= new[:, None]] = -np.inf
        nodes = np.argpartition(-score, most - 1, axis=1)[:, :most] if most < n else np.broadcast_to(np.arange(n), score.shape)
        near = np.take_along_axis(score, nodes, 1)
        order = np.argsort(-near, axis=1, kind="stable")
        nodes, near = np.take_along_axis(nodes, order, 1), np.take_along_axis(near, order, 1)
        return np.where(np.isfinite(near), nodes, -1), near

    def among(self, nodes: np.ndarray) -> np.ndarray:
        """The nearness of all pairs inside each row of nodes."""
        v = self.x[nodes]
        dot = v @ v.transpose(0, 2, 1)
        if self.by_l2:
            s = self.squares[nodes]
            dot = 2 * dot - s[:, :, None] - s[:, None, :]
        return dot


def levels(hashes: np.ndarray, m: int) -> np.ndarray:
    """The highest layer of each node, from a hash of it: every layer has about 1/m of the nodes below."""
    u = ((hashes.astype(np.uint64) >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53
    return np.floor(-np.log(u) / np.log(max(2, m))).astype(np.int64)


@dataclass
class Found:
    """The beam's nodes, best first, -1 where there are none, and how many pairs were compared."""

    nodes: np.ndarray
    score: np.ndarray
    compared: int


def beam(near, links: np.ndarray, entry: np.ndarray, ef: int, followed: int = FOLLOWED) -> Found:
    """From entry nodes (a row for each query) follows links while a node of the ``ef`` best hasn't been followed."""
    m, n, followed = len(entry), len(links), min(followed, ef)
    seen = np.zeros((m, n), bool)
    nodes, score, fresh = np.full((m, ef), -1, np.int64), np.full((m, ef), -np.inf, np.float32), np.zeros((m, ef), bool)
    compared, active = 0, np.arange(m)
    found = np.where(entry >= 0, entry, -1)
    while True:
        row = np.repeat(np.arange(len(active)), found.shape[1])
        at = found.ravel()
        row, at = row[at >= 0], at[at >= 0]
        new = ~seen[active[row], at]
        key = np.unique(row[new] * n + at[new])
        row, at = key // n, key % n
        seen[active[row], at] = True
        compared += len(at)
        first = np.searchsorted(row, np.arange(len(active)))
        column = np.arange(len(row)) - first[row]
        wide = int(column.max()) + 1 if len(column) else 0
        more, theirs = np.full((len(active), wide), -np.inf, np.float32), np.full((len(active), wide), -1, np.int64)
        more[row, column], theirs[row, column] = near(active[row], at), at
        every = np.concatenate((score[active], more), axis=1)
        best = np.argpartition(-every, ef - 1, axis=1)[:, :ef] if wide else np.broadcast_to(np.arange(ef), (len(active), ef))
        take = lambda old, new, best=best: np.take_along_axis(np.concatenate((old, new), axis=1), best, 1)
        score[active], nodes[active], fresh[active] = np.take_along_axis(every, best, 1), take(nodes[active], theirs), take(fresh[active], theirs >= 0)
        waiting = np.where(fresh[active], score[active], -np.inf)
        chosen = np.argpartition(-waiting, followed - 1, axis=1)[:, :followed]
        good = np.isfinite(np.take_along_axis(waiting, chosen, 1))
        on = good.any(1)
        active, chosen, good = active[on], chosen[on], good[on]
        if not len(active):
            break
        fresh[active[:, None], chosen] &= ~good
        found = links[np.where(good, nodes[active[:, None], chosen], 0)]
        found = np.where(good[:, :, None], found, -1).reshape(len(active), -1)
    order = np.argsort(-score, axis=1, kind="stable")
    return Found(np.take_along_axis(nodes, order, 1), np.take_along_axis(score, order, 1), compared)


def selected(space: Space, nodes: np.ndarray, score: np.ndarray, most: int) -> np.ndarray:
    """Of each row's nodes, best first and -1 where there are none, at most so many that aren't nearer to one before; the best of the rest fill up."""
    out = np.full((len(nodes), most), -1, np.int64)
    wide = nodes.shape[1]
    step = max(1, WORK // (4 * wide * (wide + space.x.shape[1])))
    for k in range(0, len(nodes), step):
        at, s = nodes[k : k + step], score[k : k + step]
        there = at >= 0
        shadowed = space.among(np.maximum(at, 0)) > s[:, :, None]
        kept, count = np.zeros(at.shape, bool), np.zeros(len(at), np.int64)
        for j in range(wide):
            ok = there[:, j] & (count < most) & ~(shadowed[:, j] & kept).any(1)
            kept[:, j] = ok
            count += ok
        rest = there & ~kept
        kept |= rest & (rest.cumsum(1) <= (most - count)[:, None])
        order = np.argsort(~kept, axis=1, kind="stable")[:, :most]
        out[k : k + step, : order.shape[1]] = np.where(np.take_along_axis(kept, order, 1), np.take_along_axis(at, order, 1), -1)
    return out


def blocks(m: int, n: int, ef: int) -> Iterator[slice]:
    """Ranges of queries whose beams fit the work arrays."""
    step = max(1, min(WORK // max(1, n), WORK // (64 * ef)))
    for k in range(0, m, step):
        yield slice(k, min(m, k + step))


def link_back(space: Space, links: np.ndarray, new: np.ndarray, chosen: np.ndarray, score: np.ndarray) -> None:
    """Adds the new nodes to the links of those that they chose; who has too many then selects anew."""
    width = links.shape[1]
    row, column = np.nonzero(chosen >= 0)
    target, source, near = chosen[row, column], new[row], score[row, column]
    order = np.lexsort((-near, target))
    target, source, near = target[order], source[order], near[order]
    who, first, count = np.unique(target, return_index=True, return_counts=True)
    place = np.arange(len(target)) - np.repeat(first, count)
    have = (links[who] >= 0).sum(1)
    fits = np.repeat(have + count <= width, count)
    links[target[fits], np.repeat(have, count)[fits] + place[fits]] = source[fits]
    full = np.flatnonzero(have + count > width)
    if not len(full):
        return
    wide = int(min(count[full].max(), 2 * width))
    theirs, theirs_near = np.full((len(full), wide), -1, np.int64), np.full((len(full), wide), -np.inf, np.float32)
    number = np.full(len(who), -1)
    number[full] = np.arange(len(full))
    of = np.repeat(number, count)
    ok = (of >= 0) & (place < wide)
    theirs[of[ok], place[ok]], theirs_near[of[ok], place[ok]] = source[ok], near[ok]
    old = links[who[full]]
    r, c = np.nonzero(old >= 0)
    old_near = np.full(old.shape, -np.inf, np.float32)
    old_near[r, c] = space.to(space.x[who[full]])(r, old[r, c])
    nodes, s = np.concatenate((old, theirs), axis=1), np.concatenate((old_near, theirs_near), axis=1)
    order = np.argsort(-s, axis=1, kind="stable")
    links[who[full]] = selected(space, np.take_along_axis(nodes, order, 1), np.take_along_axis(s, order, 1), width)


def build(space: Space, level: np.ndarray, m: int, ef: int) -> list[np.ndarray]:
    """The links of each layer, the lowest first; ``level`` falls from node to node. Rows have m links, twice as many in the lowest layer."""
    layers: list[np.ndarray] = []  # the top first, while they are built
    top = int(level[0]) if len(level) else 0
    for layer in range(top, -1, -1):
        n, width = int((level >= layer).sum()), 2 * m if layer == 0 else m
        links = np.full((n, width), -1, np.int64)
        done = min(n, max(2, min(ef, 256)))  # the first ones see each other all
        if done > 1:
            s = space.among(np.arange(done)[None, :])[0].copy()
            np.fill_diagonal(s, -np.inf)
            order = np.argsort(-s, axis=1, kind="stable")[:, : done - 1]
            links[:done] = selected(space, order, np.take_along_axis(s, order, 1), width)
        while done < n:
            batch = np.arange(done, min(n, 2 * done))
            step = max(1, WORK // (24 * n))
            for k in range(0, len(batch), step):
                new = batch[k : k + step]
                chosen = selected(space, *space.before(new, ef), m)
                links[new, : chosen.shape[1]] = chosen
                r, c = np.nonzero(chosen >= 0)
                s = np.full(chosen.shape, -np.inf, np.float32)
                s[r, c] = space.to(space.x[new])(r, chosen[r, c])
                link_back(space, links, new, chosen, s)
            done = len(batch) + done
        layers.append(links)
    return layers[::-1]


def descend(near, upper: list[np.ndarray], m: int) -> np.ndarray:
    """The node of the lowest of some layers (the top first) that a greedy walk finds for each query."""
    at = np.zeros((m, 1), np.int64)
    for links in upper:
        at = np.maximum(beam(near, links, at, 1, 1).nodes, 0)
    return at


def search(near, layers: list[np.ndarray], m: int, ef: int) -> Found:
    """The ``ef`` best nodes that a beam finds for each of m queries."""
    n = len(layers[0])
    compared = 0

    def counted(rows: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        nonlocal compared
        compared += len(rows)
        return near(rows, nodes)

    entry = descend(counted, layers[:0:-1], m)
    found = beam(counted, layers[0], entry, min(ef, n))
    return Found(found.nodes, found.score, compared)
