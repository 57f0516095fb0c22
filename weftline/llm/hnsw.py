"""Embedding near-duplicates over a hierarchical navigable small-world graph per shard."""

from __future__ import annotations

import hashlib
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stored, connected_components, table

COSINE = 0.95
#: Neighbours of a node above the ground level and on it, beam while building, first beam while searching.
M, M0, EF_BUILD, EF = 12, 24, 48, 48
#: An audit compares so many drawn queries with brute force, and so many planted ones: nodes of the shard moved to a cosine in this
#: range beyond the threshold. The beam doubles until this share of their true links is found.
AUDIT, PLANTED, MOVED, RECALL, ENOUGH = 256, 256, (0.002, 0.02), 0.98, 32
#: Places of a node for links that reconnect islands, and links of each island.
SPARE, BRIDGES = 4, 4
#: A beam of one in so many of a shard's vectors costs more than comparing with all of them, which then is done.
WIDE = 8
#: Bytes of vectors of a shard at most, and shards at least.
SHARD_BYTES, SHARDS = 32 << 20, 6
#: Partitions that the tasks are dealt to at most.
DEALT = 20_000
#: Cosines that are worked out at once.
CELLS = 1 << 23
#: Links of two shards that a task holds as pairs; where a search finds more, the shards are compared throughout, by
#: blocks, and links are only counted.
PAIRS = 1 << 22
#: Search works on single precision and keeps what is this close to the threshold for the check in double precision.
SLOP = 1e-4
_GROUP, _EXPAND = 512, 4


class Graph:
    """The graph of one shard. Nodes are inserted in batches, each batch searched for at once.

    ``layers[l]`` are the neighbours on level l, -1 where there is none. Levels come from a hash of the id, so a
    task that is run again builds the same graph."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.raw = ids[order], vectors[order]
        unit = self.raw.astype(np.float64)
        self.unit = (unit / np.linalg.norm(unit, axis=1, keepdims=True)).astype(np.float32)
        n = len(self.ids)
        draw = np.array([int.from_bytes(hashlib.blake2b(int(i).to_bytes(8, "little", signed=True), digest_size=7).digest(), "little") for i in self.ids]) / 2.0**56
        self.level = np.minimum((-np.log(np.maximum(draw, 1e-12)) / np.log(M)).astype(np.int64), 6)
        self.layers = [np.full((n, M0 if l == 0 else M), -1, dtype=np.int32) for l in range(int(self.level.max(initial=0)) + 1)]
        self.entry = int(np.argmax(self.level)) if n else -1
        # nodes of high levels first, and the entry is the first of all
        queue = np.lexsort((np.arange(n), -self.level))
        at = 0
        while at < n:
            batch = queue[at : at + max(1, min(at, 1024))]
            self._insert(batch, at)
            at += len(batch)
        if n:
            self._reconnect()

    def _reconnect(self) -> None:
        """Bridges to nodes that can't be reached on the ground level: a tight group may link to itself alone.

        Islands are found first; then a few nodes of each, the one that reaches the rest among them, are searched for
        from the entry and hung on the closest nodes found that have a place left. Where none has, all get more."""
        n = len(self.ids)
        ground = np.concatenate([self.layers[0], np.full((n, SPARE), -1, dtype=np.int32)], axis=1)
        reached = np.zeros(n, dtype=bool)

        def spread(frontier: np.ndarray) -> np.ndarray:
            found = [frontier]
            while len(frontier):
                reached[frontier] = True
                around = np.unique(ground[frontier])
                around = around[around >= 0]
                frontier = around[~reached[around]]
                found.append(frontier)
            return np.concatenate(found)

        spread(np.array([self.entry]))
        nodes, at = [], 0
        while at < n:
            if reached[at]:
                at += 1 if at + 1 < n and not reached[at + 1] else max(1, int(np.argmin(reached[at:])) if not reached[at:].all() else n - at)
                continue
            island = spread(np.array([at]))
            nodes.append(island[np.linspace(0, len(island) - 1, min(BRIDGES, len(island))).astype(np.int64)])
        self.layers[0] = ground
        if not nodes:
            return
        nodes = np.concatenate(nodes)
        near, sims = self.search(self.unit[nodes], min(64, n))
        near = np.take_along_axis(near, np.argsort(-sims, axis=1, kind="stable"), axis=1)
        used = np.zeros(n, dtype=np.int64)
        places: list[tuple[int, int, int]] = []
        for u, row in zip(nodes.tolist(), near.tolist()):
            row = [r for r in row if r >= 0]
            r = next((r for r in row if used[r] < SPARE), min(row, key=lambda r: used[r]))
            places.append((r, int(used[r]), u))
            used[r] += 1
        more = max(0, int(used.max()) - SPARE)
        width = ground.shape[1] - SPARE
        ground = np.concatenate([ground, np.full((n, more), -1, dtype=np.int32)], axis=1)
        for r, k, u in places:
            ground[r, width + k] = u
        self.layers[0] = ground

    def _insert(self, batch: np.ndarray, before: int) -> None:
        for l in range(len(self.layers) - 1, -1, -1):
            own = batch[self.level[batch] >= l]
            if not len(own):
                continue
            near = self.unit[own] @ self.unit[own].T
            np.fill_diagonal(near, -2)
            k = min(len(own), EF_BUILD)
            part = np.argpartition(-near, k - 1, axis=1)[:, :k]
            found, sims = own[part], np.take_along_axis(near, part, axis=1)
            if before:
                more, more_sims = self.search(self.unit[own], EF_BUILD, l)
                found, sims = np.concatenate([found, more], axis=1), np.concatenate([sims, more_sims], axis=1)
            self._link(l, own, found, sims)

    def _link(self, l: int, own: np.ndarray, found: np.ndarray, sims: np.ndarray) -> None:
        layer = self.layers[l]
        width = layer.shape[1]
        layer[own] = self._diverse(own, found, sims, width)
        # the other direction: each neighbour chooses among what it has and who chose it
        a, b = np.repeat(own, width), layer[own].ravel()
        a, b = a[b >= 0], b[b >= 0]
        order = np.argsort(b, kind="stable")
        a, b = a[order], b[order]
        nodes, start, count = np.unique(b, return_index=True, return_counts=True)
        most = min(int(count.max(initial=0)), 4 * width)
        given = np.full((len(nodes), most), -1, dtype=np.int64)
        rank = np.arange(len(b)) - np.repeat(start, count)
        fits = rank < most
        given[np.repeat(np.arange(len(nodes)), count)[fits], rank[fits]] = a[fits]
        for s in range(0, len(nodes), 2048):
            part = nodes[s : s + 2048]
            all_ = np.concatenate([layer[part].astype(np.int64), given[s : s + 2048]], axis=1)
            sims = np.einsum("qd,qkd->qk", self.unit[part], self.unit[np.maximum(all_, 0)])
            sims[all_ < 0] = -2
            layer[part] = self._diverse(part, all_, sims, width)

    def _diverse(self, own: np.ndarray, found: np.ndarray, sims: np.ndarray, width: int) -> np.ndarray:
        """Neighbours by the usual heuristic: the closest first, those closer to a chosen one than to the node only
        where room is left."""
        order = np.argsort(-sims, axis=1, kind="stable")[:, : 3 * width]
        found, sims = np.take_along_axis(found, order, axis=1), np.take_along_axis(sims, order, axis=1)
        valid = (sims > -1.5) & (found != own[:, None])
        same = np.zeros_like(valid)
        for k in range(1, found.shape[1]):
            same[:, k] = (found[:, k : k + 1] == found[:, :k]).any(axis=1)
        valid &= ~same
        out = np.full((len(own), width), -1, dtype=np.int32)
        for s in range(0, len(own), 256):
            f, v, m = found[s : s + 256], self.unit[np.maximum(found[s : s + 256], 0)], sims[s : s + 256]
            between = np.einsum("qkd,qjd->qkj", v, v)
            ok, chosen = valid[s : s + 256], np.zeros_like(valid[s : s + 256])
            for k in range(f.shape[1]):
                blocked = (chosen & (between[:, k, :] > m[:, k : k + 1])).any(axis=1)
                chosen[:, k] = ok[:, k] & ~blocked
            rank = np.where(chosen, 0, np.where(ok, 1, 2))
            pick = np.argsort(rank, axis=1, kind="stable")[:, :width]
            taken = np.where(np.take_along_axis(ok, pick, axis=1), np.take_along_axis(f, pick, axis=1), -1)
            out[s : s + 256, : taken.shape[1]] = taken
        return out

    def search(self, queries: np.ndarray, ef: int, bottom: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """The ``ef`` closest nodes that a beam finds on a level for unit vectors, and their cosines (-2: none)."""
        ids, sims = [], []
        for s in range(0, len(queries), _GROUP):
            q = queries[s : s + _GROUP]
            seeds = np.full((len(q), 1), self.entry, dtype=np.int64)
            for l in range(len(self.layers) - 1, bottom, -1):
                seeds = self._beam(q, seeds, 4, self.layers[l])[0]
            found = self._beam(q, seeds, ef, self.layers[bottom])
            ids.append(found[0])
            sims.append(found[1])
        return np.concatenate(ids), np.concatenate(sims)

    def _beam(self, q: np.ndarray, seeds: np.ndarray, ef: int, layer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows = np.arange(len(q))
        ids = np.full((len(q), ef), -1, dtype=np.int64)
        sims = np.full((len(q), ef), -2, dtype=np.float32)
        k = min(seeds.shape[1], ef)
        ids[:, :k] = seeds[:, :k]
        known = ids[:, :k] >= 0
        sims[:, :k] = np.where(known, np.einsum("qd,qkd->qk", q, self.unit[np.maximum(ids[:, :k], 0)]), -2)
        seen = np.zeros((len(q), len(self.ids)), dtype=bool)
        seen[np.repeat(rows, k)[known.ravel()], ids[:, :k].ravel()[known.ravel()]] = True
        done = ids < 0
        live = rows
        while len(live):
            score = np.where(done[live], -3, sims[live])
            e = min(_EXPAND, ef)
            top = np.argpartition(-score, e - 1, axis=1)[:, :e] if e < ef else np.broadcast_to(np.arange(ef), score.shape)
            open_ = np.take_along_axis(score, top, axis=1) > -2.5
            active = open_.any(axis=1)
            live, top, open_ = live[active], top[active], open_[active]
            if not len(live):
                break
            done[live[:, None], top] |= open_
            around = layer[np.maximum(ids[live[:, None], top], 0)].astype(np.int64)
            around[~open_] = -1
            around = around.reshape(len(live), -1)
            fresh = (around >= 0) & ~seen[live[:, None], np.maximum(around, 0)]
            # of a node that two expanded ones share, the first mention counts
            order = np.argsort(around, axis=1, kind="stable")
            ordered = np.take_along_axis(around, order, axis=1)
            twice = np.zeros_like(fresh)
            twice[:, 1:] = ordered[:, 1:] == ordered[:, :-1]
            np.put_along_axis(fresh, order, np.take_along_axis(fresh, order, axis=1) & ~twice, axis=1)
            r, c = np.nonzero(fresh)
            seen[live[r], around[r, c]] = True
            new = np.full(around.shape, -2, dtype=np.float32)
            new[r, c] = np.einsum("nd,nd->n", q[live[r]], self.unit[around[r, c]])
            all_ids = np.concatenate([ids[live], np.where(fresh, around, -1)], axis=1)
            all_sims = np.concatenate([sims[live], new], axis=1)
            all_done = np.concatenate([done[live], ~fresh], axis=1)
            best = np.argpartition(-all_sims, ef - 1, axis=1)[:, :ef]
            ids[live], sims[live], done[live] = (np.take_along_axis(x, best, axis=1) for x in (all_ids, all_sims, all_done))
        return ids, sims

    def within(self, queries: np.ndarray, cosine: float, ef: int, most: int = PAIRS) -> tuple[np.ndarray, np.ndarray] | None:
        """Pairs (query, node) near the threshold. A query whose beam holds nothing else is searched with a wider one,
        at last with all of the shard. None if there are more than ``most``."""
        n, out, total = len(self.ids), [], 0
        left = np.arange(len(queries))
        while len(left):
            whole = WIDE * ef >= n
            again = []
            step = max(1, CELLS // n) if whole else max(1, min(_GROUP * 8, (1 << 24) // ef))
            for s in range(0, len(left), step):
                part = left[s : s + step]
                if whole:
                    r, c = np.nonzero(queries[part] @ self.unit.T >= cosine - SLOP)
                    out.append(np.column_stack([part[r], c]))
                else:
                    ids, sims = self.search(queries[part], ef)
                    hit = sims >= cosine - SLOP
                    full = hit.all(axis=1)
                    again.append(part[full])
                    r, c = np.nonzero(hit & ~full[:, None])
                    out.append(np.column_stack([part[r], ids[r, c]]))
                total += len(r)
                if total > most:
                    return None
            left, ef = np.concatenate(again) if again else left[:0], 2 * ef
        pairs = np.concatenate(out) if out else np.zeros((0, 2), dtype=np.int64)
        return pairs[:, 0], pairs[:, 1]

    def planted(self, cosine: float) -> np.ndarray:
        """Queries that have a link by their making: drawn nodes, each moved at random until its cosine with itself is
        little more than the threshold. A task that is run again plants the same."""
        order = np.argsort(_spread(self.ids), kind="stable")[:PLANTED]
        rng = np.random.default_rng(len(self.ids))
        near = self.unit[order].astype(np.float64)
        noise = rng.normal(size=near.shape)
        noise -= np.einsum("nd,nd->n", noise, near)[:, None] * near
        length = np.linalg.norm(noise, axis=1, keepdims=True)
        c = np.minimum(1.0, cosine + rng.uniform(*MOVED, size=(len(order), 1)))
        c = np.where(length > 1e-9, c, 1.0)  # one dimension leaves nowhere to go
        return (c * near + np.sqrt(1 - c * c) * noise / np.maximum(length, 1e-9)).astype(np.float32)

    def audited(self, queries: np.ndarray, keys: np.ndarray, cosine: float) -> tuple[tuple[np.ndarray, np.ndarray] | None, float, int]:
        """``within`` with beams widened until the audit passes; also the recall that was measured and the beam.

        The audit's size is fixed: the first queries in the order of hashes of their ids, whose links with themselves are left out, and
        planted ones, so that recall is measured however few links there are. Both are compared with brute force over the
        shard; recall is the mean over those that have a true link, or that over the drawn ones of them if it is less and these are ``ENOUGH``. A beam that is wide for the shard ends in comparing with
        all of it, as that costs less."""
        chosen = np.argsort(_spread(keys), kind="stable")[:AUDIT]
        asked = np.concatenate([queries[chosen], self.planted(cosine)])
        if not len(asked) or not len(self.ids):
            return self.within(queries, cosine, EF), 1.0, EF
        step = max(1, CELLS // len(self.ids))
        exact = np.concatenate([asked[k : k + step] @ self.unit.T >= cosine for k in range(0, len(asked), step)])
        exact[: len(chosen)] &= keys[chosen][:, None] != self.ids
        some = exact.any(axis=1)
        asked, exact, drawn = asked[some], exact[some], int(some[: len(chosen)].sum())
        ef = EF
        while True:
            found = self.within(asked, cosine, ef)
            if found is None:
                return None, 1.0, ef
            hits = np.zeros_like(exact)
            hits[found] = True
            each = (hits & exact).sum(axis=1) / exact.sum(axis=1)
            recall = float(min(each.mean(), each[:drawn].mean() if drawn >= ENOUGH else 1.0))
            if recall >= RECALL or WIDE * ef >= len(self.ids):
                return self.within(queries, cosine, ef), recall, ef
            ef *= 2


def _spread(ids: np.ndarray) -> np.ndarray:
    return (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)


def _unpack(column, kind: str, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind).reshape(-1, width)


def packed(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``id, vid, dim, vec``: vectors as bytes and a digest of them; null digests for those that link with nothing
    (null, empty, zero, with null or non-finite components, or without an id)."""
    single = "float" in dict(vectors.dtypes)[vector]
    kind = np.float32 if single else np.float64
    frame = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<float>" if single else "array<double>").alias("v"))

    def run(batches):
        for batch in batches:
            vids, dims, vecs = [], [], []
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = v.values.to_numpy(zero_copy_only=False).astype(kind) + kind(0) if v.is_valid and not v.values.null_count else None
                good = i is not None and raw is not None and len(raw) and np.isfinite(raw).all() and np.isfinite(norm := np.linalg.norm(raw.astype(np.float64))) and norm > 0
                vecs.append(raw.tobytes() if good else None)
                dims.append(len(raw) if good else None)
                vids.append(hashlib.md5(vecs[-1]).digest() if good else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(vids, pa.binary()), pa.array(dims, pa.int32()), pa.array(vecs, pa.binary())], names=["id", "vid", "dim", "vec"])

    return frame.mapInArrow(run, "id long, vid binary, dim int, vec binary")


def _build(kind: str):
    """The graph of one shard as a row: what can be computed from the vectors is left out."""

    def build(rows: pa.Table) -> pa.Table:
        dim = rows.column("dim")[0].as_py()
        order = np.argsort(rows.column("rep").to_numpy(), kind="stable")
        graph = Graph(rows.column("rep").to_numpy(), _unpack(rows.column("vec"), kind, dim))
        packed = pickle.dumps((graph.ids, graph.raw, graph.layers, graph.entry, rows.column("times").to_numpy()[order]))
        return pa.table({"dim": pa.array([dim], pa.int32()), "shard": pa.array([rows.column("shard")[0].as_py()], pa.int32()), "graph": pa.array([packed], pa.binary())})

    return build


def _loaded(packed: bytes) -> tuple[Graph, np.ndarray]:
    graph = Graph.__new__(Graph)
    graph.ids, graph.raw, graph.layers, graph.entry, times = pickle.loads(packed)
    unit = graph.raw.astype(np.float64)
    graph.unit = (unit / np.linalg.norm(unit, axis=1, keepdims=True)).astype(np.float32)
    return graph, times


def _forest(a: np.ndarray, b: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Smallest id that each node reaches over the links, by label passing with pointer jumps. Nodes are places in ``ids`` (sorted)."""
    root = np.arange(len(ids))
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        while (new[new] != new).any():
            new = new[new]
        if (new == root).all():
            return root
        root = new


def _verified(a: Graph, b: Graph, p: np.ndarray, q: np.ndarray, cosine: float) -> np.ndarray:
    """Which of the pairs (node of a, node of b) have the cosine in double precision; a node is none with itself."""
    ok = a.ids[p] != b.ids[q]
    for s in range(0, len(p), 1 << 16):
        x, y = (g.raw[n[s : s + (1 << 16)]].astype(np.float64) for g, n in ((a, p), (b, q)))
        x, y = (v / np.linalg.norm(v, axis=1, keepdims=True) for v in (x, y))
        ok[s : s + (1 << 16)] &= np.einsum("nd,nd->n", x, y) >= cosine
    return ok


def _pairs(a: Graph, b: Graph, cosine: float) -> tuple[np.ndarray, float]:
    """Links between the nodes of two shards as numbers p * len(b) + q, found from either end, and the lower recall of
    the two audits. Too many for a task: None."""
    recalls, found = [], []
    for queries, graph, turned in ((a, b, False), (b, a, True)):
        if turned and a is b:
            break
        links, recall, _ = graph.audited(queries.unit, queries.ids, cosine)
        if links is None:
            return None, 1.0
        recalls.append(recall)
        p, q = links[::-1] if turned else links
        found.append(p * len(b.ids) + q)
    keys = np.unique(np.concatenate(found))
    p, q = keys // len(b.ids), keys % len(b.ids)
    if a is b:  # each pair once, whichever end it was found from
        p, q = np.minimum(p, q), np.maximum(p, q)
        keys = np.unique(p * len(b.ids) + q)
        p, q = keys // len(b.ids), keys % len(b.ids)
    return keys[_verified(a, b, p, q, cosine)], min(recalls)


def _blocks(a: Graph, b: Graph, cosine: float):
    """All links between the nodes of two shards, some rows of the first at a time."""
    rows = max(1, CELLS // len(b.ids))
    for s in range(0, len(a.ids), rows):
        p, q = np.nonzero(a.unit[s : s + rows] @ b.unit.T >= cosine - SLOP)
        p = p + s
        if a is b:
            p, q = p[p < q], q[p < q]
        ok = _verified(a, b, p, q, cosine)
        yield p[ok], q[ok]


def _search(kind: str, cosine: float):
    """Links between two shards: for each node that has any their number and a root of its component among them, and a
    row without an id that holds the recall of the audits."""
    out = {"id": pa.int64(), "links": pa.int64(), "root": pa.int64(), "recall": pa.float64(), "shard": pa.int32()}

    def search(rows: pa.Table) -> pa.Table:
        shards = dict(zip(rows.column("shard").to_pylist(), rows.column("graph").to_pylist()))
        numbers = sorted({rows.column("low")[0].as_py(), rows.column("high")[0].as_py()})
        if len(shards) < len(numbers):  # the other shard has no vector of this length
            return pa.table({k: pa.array([], t) for k, t in out.items()})
        loaded = [_loaded(shards[n]) for n in numbers]
        (a, times_a), (b, times_b) = loaded[0], loaded[-1]
        keys, recall = _pairs(a, b, cosine)
        blocks = _blocks(a, b, cosine) if keys is None else [(keys // len(b.ids), keys % len(b.ids))]
        ids = a.ids if a is b else np.unique(np.concatenate([a.ids, b.ids]))
        links, root = np.zeros(len(ids), dtype=np.int64), np.arange(len(ids))
        for p, q in blocks:
            x, y = np.searchsorted(ids, a.ids[p]), np.searchsorted(ids, b.ids[q])
            links += np.bincount(x, weights=times_b[q], minlength=len(ids)).astype(np.int64) + np.bincount(y, weights=times_a[p], minlength=len(ids)).astype(np.int64)
            root = _forest(np.concatenate([x, np.arange(len(ids))]), np.concatenate([y, root]), ids)
        some = np.flatnonzero(links)
        n, m = len(some), len(numbers)
        return pa.table(
            {
                "id": pa.array([*ids[some].tolist(), *[None] * m], pa.int64()),
                "links": pa.array([*links[some].tolist(), *[0] * m], pa.int64()),
                "root": pa.array([*ids[root[some]].tolist(), *[None] * m], pa.int64()),
                "recall": pa.array([None] * n + [recall] * m, pa.float64()),
                "shard": pa.array([None] * n + numbers, pa.int32()),
            },
            schema=pa.schema(list(out.items())),
        )

    return search


def near_duplicates(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", cosine: float = COSINE, shard_bytes: int = SHARD_BYTES, shards: int = SHARDS) -> DataFrame:
    """``id, n_links, component_id, audit_recall`` for each row of ``vectors``.

    Equal vectors are one node with a multiplicity, found by an aggregate. Each shard's graph is built once and
    written to the shared folder. Every two shards are dealt to a task with both graphs, which searches each for the
    nodes of the other, so a link counts at both its ends if either end finds it. What a search returns is a count
    for each vector and a forest over its links, not the links, so a group of near copies makes no more rows than
    it has vectors. A graph is sent once for each other shard: bytes shuffled are those of the vectors times the number
    of shards, which is their bytes over ``shard_bytes``. ``audit_recall`` is the lowest recall that an audit of the
    vector's shard measured, of links from one end alone. Vectors of different lengths are never compared. Rows that link
    with nothing are their own component; an empty table gives no rows.
    """
    single = "float" in dict(vectors.dtypes)[vector]
    kind = "<f4" if single else "<f8"
    rows = Stored(packed(vectors, key, vector)).df
    nodes = Stored(rows.where("vid IS NOT NULL").groupBy("vid").agg(F.min("id").alias("rep"), F.count("*").alias("times"), F.first("dim").alias("dim"), F.first("vec").alias("vec"))).df
    total = nodes.agg(F.sum(F.octet_length("vec"))).first()[0]
    if not total:
        return rows.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(None).cast("double").alias("audit_recall"))
    many = max(shards, -(-total // shard_bytes))
    shard = F.pmod(F.xxhash64("vid"), F.lit(many)).cast("int")
    graphs = Stored(nodes.select("dim", shard.alias("shard"), "rep", "times", "vec").groupBy("dim", "shard").applyInArrow(_build(kind), "dim int, shard int, graph binary")).df
    other = F.explode(F.sequence(F.lit(0), F.lit(many - 1))).alias("other")
    dealt = graphs.select("dim", "shard", "graph", other).select("dim", "shard", "graph", F.least("shard", "other").alias("low"), F.greatest("shard", "other").alias("high"))
    tasks = dealt.repartition(min(many * (many + 1), DEALT), "dim", "low", "high")
    found = Stored(tasks.groupBy("dim", "low", "high").applyInArrow(_search(kind, cosine), "id long, links long, root long, recall double, shard int")).df
    linked = found.where("id IS NOT NULL")
    counts = linked.groupBy("id").agg(F.sum("links").alias("links"))
    roots = connected_components(linked.select(F.col("id").alias("a"), F.col("root").alias("b")))
    audits = found.where("id IS NULL").groupBy("shard").agg(F.min("recall").alias("audit_recall"))
    known = (
        nodes.select("vid", "rep", "times", shard.alias("shard"))
        .join(counts, F.col("rep") == counts.id, "left")
        .join(roots, F.col("rep") == roots.node, "left")
        .join(audits, "shard", "left")
        .select("vid", (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"), "audit_recall")
    )
    joined = rows.join(known, "vid", "left")
    return joined.select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "id").alias("component_id"), "audit_recall")


def op4_embeddings(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "embeddings"))
    return found.select(F.col("id").alias("vec_id"), "n_links", "component_id", (F.col("id") == F.col("component_id")).alias("kept"), "audit_recall")
