"""The k most similar vectors for every vector, by an adaptive dimension scan (problem 2).

Vectors are parsed, made unit length and randomly rotated once. A k-means index fitted on a bounded sample
gives inverted lists in two levels, so that their number grows with the rows; every row is indexed. Neighbouring lists form a group, which
is one task's work: a vector travels once to each group that holds a list it probes, not once to each list. Within a list vectors lie in column
blocks: partial distances over the first block are tested against what the current k-th best distance would
make likely (a hypothesis test on a random projection), and nearly all candidates are abandoned there;
survivors are finished block by block and ranked by their cosine in double precision, so that the cut into blocks doesn't show in the result.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliant.session import cut_lineage

BLOCK = 32  # columns of a block
VECTOR_SCHEMA = "id string, is_chunk boolean, space string, vec binary, same binary"
ROUTED_SCHEMA = "key long, id string, is_member boolean, is_query boolean, probes binary, vec binary"
FOUND_SCHEMA = "id string, near array<struct<d:double,id:string>>"


def rotation(dim: int, seed: int = 11) -> np.ndarray:
    """A random orthogonal matrix, the same everywhere for a dimension."""
    q, r = np.linalg.qr(np.random.default_rng(seed + dim).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def parse_vector(text: str | None, dimensions: int | None) -> np.ndarray | None:
    """The vector a JSON text spells, if it has exactly ``dimensions`` finite numbers that aren't all zero."""
    if not text or not dimensions:
        return None
    try:
        values = json.loads(text)
    except (ValueError, RecursionError):
        return None
    if not isinstance(values, list) or len(values) != dimensions or any(type(x) not in (int, float) for x in values):
        return None
    try:
        v = np.array(values, dtype=np.float64)
    except OverflowError:
        return None
    top = np.abs(v).max()
    if not np.isfinite(top) or top == 0:
        return None
    v /= top
    return v / np.sqrt(v @ v)


def unit_vectors(table: DataFrame, key: str, is_chunk: bool, text: str = "embedding_json", dims: str = "dimensions", space: str = "vector_space_id") -> DataFrame:
    """Usable vectors as rotated unit vectors: ``id, is_chunk, space, vec, same``; the space's key holds its dimension too.

    ``same`` is a hash of the unit vector before its rotation, each by itself: equal vectors have it in common whatever rows they're read with."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns: dict[int, np.ndarray] = {}
        for b in batches:
            ids, spaces, vecs, same = [], [], [], []
            groups: dict[int, list] = {}
            for k, s, d, t in zip(*(c.to_pylist() for c in b.columns)):
                v = parse_vector(t, d)
                if v is not None:
                    groups.setdefault(d, []).append((k, f"{d}:{s}", v))
            for d, rows in groups.items():
                if d not in turns:
                    turns[d] = rotation(d)
                plain = np.stack([r[2] for r in rows])
                turned = (plain @ turns[d]).astype(np.float32)  # in double precision, so that the rows beside a vector don't show in it
                ids += [r[0] for r in rows]
                spaces += [r[1] for r in rows]
                vecs += [x.tobytes() for x in turned]
                same += [hashlib.blake2b(x.tobytes(), digest_size=16).digest() for x in plain.astype(np.float32) + np.float32(0)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array([is_chunk] * len(ids)), pa.array(spaces, pa.string()), pa.array(vecs, pa.binary()), pa.array(same, pa.binary())], names=["id", "is_chunk", "space", "vec", "same"])

    picked = table.select(F.col(key).cast("string"), F.coalesce(F.col(space), F.lit("")), F.col(dims).cast("int"), F.col(text)).filter(F.col(key).isNotNull())
    return picked.mapInArrow(run, VECTOR_SCHEMA)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    chunk = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(chunk, pa.ChunkedArray):
        chunk = pa.concat_arrays(chunk.chunks)
    return np.frombuffer(b"".join(chunk.to_pylist()), dtype=np.float32).reshape(-1, dim)


def _kmeans(x: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    k = max(1, min(k, len(x)))
    c = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        near = np.concatenate([(x[i : i + 4096] @ c.T).argmax(1) for i in range(0, len(x), 4096)])
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        n = np.bincount(near, minlength=k)
        empty = n == 0
        sums[empty] = x[rng.choice(len(x), int(empty.sum()))]
        c = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return c.astype(np.float32)


def _halves(centroids: np.ndarray, weight: np.ndarray, most: float) -> np.ndarray:
    """Groups of neighbouring lists of about equal weight: halved along the widest direction until none exceeds ``most``."""
    group = np.zeros(len(centroids), dtype=np.int64)
    todo, names = [np.arange(len(centroids))], 0
    while todo:
        at = todo.pop()
        if len(at) < 2 or weight[at].sum() <= most:
            group[at] = names
            names += 1
            continue
        x = centroids[at] - centroids[at].mean(0)
        axis = np.linalg.eigh(x.T @ x)[1][:, -1]
        order = at[np.argsort(x @ axis, kind="stable")]
        half = np.cumsum(weight[order])
        cut = int(np.clip(np.searchsorted(half, half[-1] / 2) + 1, 1, len(order) - 1))
        todo += [order[:cut], order[cut:]]
    return group


def _two_levels(x: np.ndarray, lists: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cells, lists, where each cell's lists begin): k-means into about the root of ``lists`` cells, then within each cell."""
    cells = _kmeans(x, round(lists**0.5), 8, seed)
    near = np.concatenate([(x[i : i + 4096] @ cells.T).argmax(1) for i in range(0, len(x), 4096)])
    fine, bounds, kept = [], [0], []
    for c in range(len(cells)):
        mine = x[near == c]
        if len(mine):
            fine.append(_kmeans(mine, max(1, round(lists * len(mine) / len(x))), 8, seed))
            bounds.append(bounds[-1] + len(fine[-1]))
            kept.append(c)
    return cells[kept], np.concatenate(fine), np.array(bounds)


def near_lists(m: dict, x: np.ndarray, r: int, beam: int = 24, whole: int = 2048) -> tuple[np.ndarray, np.ndarray]:
    """(lists, cosines) of the ``r`` lists nearest to each row, nearest first; lists without members (``held``) are left out, -1 where there are
    no more. Beyond ``whole`` lists only those of each row's ``beam`` nearest cells are compared."""
    lists, bounds = m["centroids"], m["bounds"]
    empty = m["held"] == 0
    if len(lists) <= whole or len(m["cells"]) <= beam:
        sims = x @ lists.T
        sims[:, empty] = -np.inf
        r = min(r, len(lists))
        top = np.argpartition(-sims, r - 1, axis=1)[:, :r]
        best = np.take_along_axis(sims, top, 1)
    else:
        cells = np.argpartition(-(x @ m["cells"].T), beam - 1, axis=1)[:, :beam]
        top, best = np.zeros((len(x), r), dtype=np.int64), np.full((len(x), r), -np.inf, dtype=np.float32)
        by = np.argsort(cells, axis=None, kind="stable")
        names, first = np.unique(cells.ravel()[by], return_index=True)
        for c, s, e in zip(names.tolist(), first.tolist(), [*first[1:].tolist(), len(by)]):
            rows, own = by[s:e] // beam, np.arange(bounds[c], bounds[c + 1])
            sims = x[rows] @ lists[own].T
            sims[:, empty[own]] = -np.inf
            both = np.concatenate([best[rows], sims], 1)
            keep = np.argpartition(-both, r - 1, axis=1)[:, :r]
            top[rows] = np.take_along_axis(np.concatenate([top[rows], np.broadcast_to(own, sims.shape)], 1), keep, 1)
            best[rows] = np.take_along_axis(both, keep, 1)
    order = np.argsort(-best, axis=1, kind="stable")
    top, best = np.take_along_axis(top, order, 1), np.take_along_axis(best, order, 1)
    return np.where(np.isfinite(best), top, -1), best


def _fit(vectors: DataFrame, k: int, epsilon: float, list_rows: int, sample_rows: int, index_bytes: int, group_rows: int, seed: int) -> dict:
    """Per space its lists, the group of each and the margin within which other lists are probed, from one bounded sample of all spaces.

    A space is sampled by ``sample_rows`` rows, or four for each of its lists if these are more; all samples together have at most ``index_bytes``
    bytes, shared in proportion, and a space at most one list for four sampled rows."""
    spark = vectors.sparkSession
    counts = {r["space"]: r["n"] for r in vectors.filter("is_chunk").groupBy("space").agg(F.count("*").alias("n")).collect()}
    dims = {s: int(s.split(":", 1)[0]) for s in counts}
    wanted = {s: min(n, max(sample_rows, 4 * round(n / list_rows))) for s, n in counts.items()}
    scale = min(1.0, index_bytes / max(1, sum(4 * dims[s] * w for s, w in wanted.items())))
    size = {s: max(1, int(w * scale)) for s, w in wanted.items()}
    share = spark.createDataFrame([(s, int(min(1.0, 1.1 * size[s] / n) * (1 << 30))) for s, n in counts.items()], "space string, share long")
    # one row per space, held by the driver above
    picked = vectors.filter("is_chunk").join(F.broadcast(share), "space").filter(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) <= F.col("share")).select("space", "id", "vec").toArrow()
    spaces = np.array(picked.column("space").to_pylist(), dtype=object)
    model: dict[str, dict] = {}
    base = 0
    for space, n in sorted(counts.items()):
        dim = dims[space]
        mine = picked.take(pa.array(np.nonzero(spaces == space)[0])).sort_by("id").slice(0, size[space])
        if not mine.num_rows:
            mine = pa.Table.from_pylist([r.asDict() for r in vectors.filter(F.col("is_chunk") & (F.col("space") == space)).select("vec").limit(1).collect()])
        x = _matrix(mine.column("vec"), dim)
        cells, centroids, bounds = _two_levels(x, max(1, min(round(n / list_rows), len(x) // 4)), seed)
        near = np.concatenate([(x[i : i + 4096] @ centroids.T).argmax(1) for i in range(0, len(x), 4096)])
        weight = np.bincount(near, minlength=len(centroids)) * (n / len(x))
        of = _halves(centroids, weight, group_rows)
        # A neighbour at distance t lies across a border at distance m only if its step along one direction reaches m;
        # by chance a step of t is about t / sqrt(dim) there. Of k neighbours the sample holds its share.
        probe = x[:: max(1, len(x) // 1000)]
        rank = min(max(1, -(-k * len(x) // n)), len(x) - 1)
        kth = np.concatenate([-np.partition(-(probe[i : i + 50] @ x.T), rank, axis=1)[:, rank] for i in range(0, len(probe), 50)])  # a few rows at a time: the driver is small
        reach = float(np.quantile(np.sqrt(np.maximum(2 - 2 * kth, 0)), 0.75))
        model[space] = {"dim": dim, "cells": cells, "centroids": centroids, "bounds": bounds, "group": of + base, "margin": epsilon * reach / np.sqrt(dim), "held": np.ones(len(centroids), dtype=np.int64)}
        base += int(of.max()) + 1
    return model


def scan_lists(members: np.ndarray, lists: np.ndarray, queries: np.ndarray, probes: list[np.ndarray], k: int, own: np.ndarray, epsilon: float = 2.1) -> tuple[np.ndarray, np.ndarray]:
    """Adaptive dimension scan: per query the ``k`` nearest members (squared distance, row) in its probed lists.

    ``probes[r]`` is each query's list of rank r (-1: none), nearest first; ``own`` is the member row that is the query itself (-1: none).
    """
    n, dim = members.shape
    best = np.full((len(queries), k), np.inf, dtype=np.float32)
    rows = np.full((len(queries), k), -1, dtype=np.int64)
    order = np.argsort(lists, kind="stable")
    names, starts = np.unique(lists[order], return_index=True)
    bounds = dict(zip(names.tolist(), zip(starts.tolist(), [*starts[1:].tolist(), n])))
    edges = [*range(0, dim, BLOCK), dim]
    laid = members[order]
    column_blocks = [np.ascontiguousarray(laid[:, a:b]) for a, b in zip(edges, edges[1:])]
    member_sq = [(c * c).sum(1) for c in column_blocks]
    query_blocks = [np.ascontiguousarray(queries[:, a:b]) for a, b in zip(edges, edges[1:])]
    query_sq = [(c * c).sum(1) for c in query_blocks]

    def offer(q: np.ndarray, d: np.ndarray, m: np.ndarray) -> None:
        """Put candidates (one row per query of ``q``) into the best lists."""
        all_d, all_m = np.concatenate([best[q], d], 1), np.concatenate([rows[q], m], 1)
        keep = np.argpartition(all_d, k - 1, axis=1)[:, :k]
        best[q], rows[q] = np.take_along_axis(all_d, keep, 1), np.take_along_axis(all_m, keep, 1)

    for probe in probes:
        by = np.argsort(probe, kind="stable")
        wanted, first = np.unique(probe[by], return_index=True)
        for name, s, e in zip(wanted.tolist(), first.tolist(), [*first[1:].tolist(), len(by)]):
            if name not in bounds:
                continue
            lo, hi = bounds[name]
            ids = order[lo:hi]
            for part in range(s, e, 2048):
                q = by[part : min(e, part + 2048)]
                worst = best[q].max(1)
                d = query_sq[0][q][:, None] + member_sq[0][lo:hi][None, :]
                d -= 2 * (query_blocks[0][q] @ column_blocks[0][lo:hi].T)
                if len(edges) > 2:
                    seen = edges[1]
                    # 2 - 2cos is the whole distance; a projection on `seen` of `dim` axes keeps seen/dim of it
                    limit = worst * (seen / dim) * (1 + epsilon / np.sqrt(seen)) ** 2
                    a, b = np.nonzero(d <= limit[:, None])
                    left = d[a, b]
                    for j in range(1, len(column_blocks)):
                        if not len(a):
                            break
                        if len(a) > 0.08 * d.size:  # many survive: the block product is cheaper than picking pairs
                            full = query_sq[j][q][:, None] + member_sq[j][lo:hi][None, :] - 2 * (query_blocks[j][q] @ column_blocks[j][lo:hi].T)
                            left = left + full[a, b]
                        else:
                            left = left + query_sq[j][q[a]] + member_sq[j][lo + b] - 2 * np.einsum("ij,ij->i", query_blocks[j][q[a]], column_blocks[j][lo + b])
                        seen = edges[j + 1]
                        limit = worst if seen == dim else worst * (seen / dim) * (1 + epsilon / np.sqrt(seen)) ** 2
                        ok = left <= limit[a]
                        a, b, left = a[ok], b[ok], left[ok]
                else:
                    a, b = np.nonzero(d <= worst[:, None])
                    left = d[a, b]
                ok = ids[b] != own[q[a]]
                a, b, left = a[ok], b[ok], left[ok]
                if not len(a):
                    continue
                # survivors per query side by side, nearest first, at most k of each
                rank = np.lexsort((left, a))
                a, b, left = a[rank], b[rank], left[rank]
                at = np.arange(len(a)) - np.concatenate([[0], np.nonzero(np.diff(a))[0] + 1])[np.cumsum(np.concatenate([[0], np.diff(a) != 0]))]
                ok = at < k
                a, b, left, at = a[ok], b[ok], left[ok], at[ok]
                who, pos = np.unique(a, return_inverse=True)
                nd = np.full((len(who), k), np.inf, dtype=np.float32)
                nm = np.full((len(who), k), -1, dtype=np.int64)
                nd[pos, at], nm[pos, at] = left, ids[b]
                offer(q[who], nd, nm)
    return best, rows


def nearest(vectors: DataFrame, k: int = 5, probes: int = 12, epsilon: float = 2.1, list_rows: int = 400, sample_rows: int = 40_000, index_bytes: int = 64 << 20, group_rows: int = 6000, task_rows: int = 60_000, task_bytes: int = 64 << 20, seed: int = 11) -> DataFrame:
    """For every row of ``vectors`` (``id, is_chunk, space, vec``) its nearest chunk rows of the space: ``id, near``
    (1 - cosine and id, nearest first, at most ``k``). Ids are unique and no two chunk rows of a space are equal vectors.

    A vector probes its own list, and up to ``probes`` lists in all whose border it is near: a hypothesis test with the same ``epsilon``
    as that of the scan tells how near a border must be for neighbours to be expected beyond it. Lists are counted first: however far their
    borders, the nearest lists are probed until they hold ``k`` + 1 members, and lists without members don't count among ``probes``, so that
    every vector finds ``k`` neighbours where its space has them.

    Fitted on a sample of at most ``index_bytes`` over all spaces; the lists that are broadcast are fewer than the sampled rows. Lists have about
    ``list_rows`` rows until that bound is reached. Where groups exceed ``task_rows`` members or queries they're cut
    into blocks that meet pairwise, and the partitions of the shuffle are as many as the rows need, so a task's input stays bounded.
    """
    spark = vectors.sparkSession
    model = _fit(vectors, k, epsilon, list_rows, sample_rows, index_bytes, group_rows, seed)
    fitted = spark.sparkContext.broadcast(model)

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[str, int], int] = {}
        for b in batches:
            for s, at in by_space(b):
                x = _matrix(b.column("vec").take(pa.array(at)), fitted.value[s]["dim"])
                for name, n in zip(*np.unique(near_lists(fitted.value[s], x, 1)[0][:, 0], return_counts=True)):
                    total[s, int(name)] = total.get((s, int(name)), 0) + int(n)
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in total], pa.string()), pa.array([x[1] for x in total], pa.int32()), pa.array(list(total.values()), pa.int64())], names=["space", "list", "n"])

    def by_space(b: pa.RecordBatch) -> Iterator[tuple[str, np.ndarray]]:
        """The row numbers of each space that has chunks."""
        spaces = np.array(b.column("space").to_pylist(), dtype=object)
        for s in set(spaces.tolist()) & fitted.value.keys():
            yield s, np.nonzero(spaces == s)[0]

    held = {s: np.zeros(len(m["centroids"]), dtype=np.int64) for s, m in model.items()}
    for r in vectors.filter("is_chunk").select("space", "vec").mapInArrow(sizes, "space string, list int, n long").groupBy("space", "list").agg(F.sum("n").alias("n")).collect():
        held[r["space"]][r["list"]] = r["n"]
    shared = spark.sparkContext.broadcast({s: m | {"held": held[s]} for s, m in model.items()})

    def probed(b: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, dict]]:
        """(row numbers, matrix, probed lists nearest first, the space's model) for each space of a batch."""
        for s, at in by_space(b):
            m = shared.value[s]
            x = _matrix(b.column("vec").take(pa.array(at)), m["dim"])
            r = min(max(probes, k + 1), int((m["held"] > 0).sum()))  # so many lists hold k + 1 members if the space does
            lists, sims = near_lists(m, x, r)
            few = (np.where(lists >= 0, m["held"][lists], 0).sum(1) <= k) & (lists[:, -1] < 0)
            if few.any():  # the cells near by don't hold enough: all lists are compared
                lists[few], sims[few] = near_lists(m, x[few], r, whole=len(m["centroids"]))
            own = lists[:, :1]
            gap = np.sqrt(np.maximum(2 - 2 * np.einsum("nd,nrd->nr", m["centroids"][own[:, 0]], m["centroids"][lists]), 1e-6))
            far = (sims[:, :1] - sims) / gap
            nearer = np.cumsum(np.where(lists >= 0, m["held"][lists], 0), axis=1) - m["held"][lists]
            skip = (far > m["margin"]) & (nearer > k) | (lists < 0)
            yield at, x, np.where(skip, -1, lists), m

    def loads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members: dict[int, int] = {}
        queries: dict[int, int] = {}
        for b in batches:
            chunk = np.array(b.column("is_chunk").to_pylist(), dtype=bool)
            for at, _, lists, m in probed(b):
                g = np.where(lists >= 0, m["group"][lists], m["group"][lists[:, :1]])
                for x, n in zip(*np.unique(g[:, 0][chunk[at]], return_counts=True)):
                    members[int(x)] = members.get(int(x), 0) + int(n)
                srt = np.sort(g, 1)
                new = np.concatenate([np.ones((len(srt), 1), bool), np.diff(srt, axis=1) != 0], 1)
                for x, n in zip(*np.unique(srt[new], return_counts=True)):
                    queries[int(x)] = queries.get(int(x), 0) + int(n)
        keys = sorted({*members, *queries})
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array([members.get(x, 0) for x in keys], pa.int64()), pa.array([queries.get(x, 0) for x in keys], pa.int64())], names=["g", "m", "q"])

    load = vectors.mapInArrow(loads, "g long, m long, q long").groupBy("g").agg(F.sum("m").alias("m"), F.sum("q").alias("q")).collect()
    cut = {r["g"]: (max(1, -(-r["m"] // task_rows)), max(1, -(-r["q"] // task_rows))) for r in load}
    blocks = spark.sparkContext.broadcast(cut)
    routed = sum(r["m"] * cut[r["g"]][1] + r["q"] * cut[r["g"]][0] for r in load)
    row_bytes = 4 * max((m["dim"] for m in model.values()), default=1) + 128
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-routed * row_bytes // task_bytes))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, chunk = b.column("id").to_pylist(), b.column("is_chunk").to_pylist()
            raw = b.column("vec").to_pylist()
            cols: list[list] = [[], [], [], [], [], []]
            for at, _, lists, m in probed(b):
                groups = np.where(lists >= 0, m["group"][lists], m["group"][lists[:, :1]])
                packed = lists.astype(np.int32)
                for i, row in enumerate(at.tolist()):
                    own = int(groups[i, 0])
                    probe = packed[i].tobytes()
                    for g in dict.fromkeys(groups[i].tolist()):
                        mb, qb = blocks.value[g]
                        mine = hash_block(ids[row])
                        places: dict[tuple[int, int], list[bool]] = {}
                        if g == own and chunk[row]:
                            for y in range(qb):
                                places.setdefault((mine % mb, y), [False, False])[0] = True
                        for x in range(mb):
                            places.setdefault((x, mine % qb), [False, False])[1] = True
                        for (x, y), (is_m, is_q) in places.items():
                            for c, v in zip(cols, ((g << 42) | (x << 21) | y, ids[row], is_m, is_q, probe, raw[row])):
                                c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.string(), pa.bool_(), pa.bool_(), pa.binary(), pa.binary()))], names=["key", "id", "is_member", "is_query", "probes", "vec"])

    def scan(table: pa.Table) -> pa.Table:
        is_m = np.array(table.column("is_member").to_pylist(), dtype=bool)
        is_q = np.array(table.column("is_query").to_pylist(), dtype=bool)
        x = np.frombuffer(b"".join(table.column("vec").to_pylist()), dtype=np.float32).reshape(table.num_rows, -1)
        p = np.frombuffer(b"".join(table.column("probes").to_pylist()), dtype=np.int32).reshape(table.num_rows, -1)
        ids = table.column("id")
        m_rows, q_rows = np.nonzero(is_m)[0], np.nonzero(is_q)[0]
        at = np.full(table.num_rows, -1, dtype=np.int64)
        at[m_rows] = np.arange(len(m_rows))
        _, rows = scan_lists(x[m_rows], p[m_rows, 0], x[q_rows], [p[q_rows, r] for r in range(p.shape[1])], k + 2, at[q_rows], epsilon)
        best = exact_distances(x[q_rows], x[m_rows], rows)
        order = np.argsort(best, axis=1, kind="stable")
        best, rows = np.take_along_axis(best, order, 1), np.take_along_axis(rows, order, 1)
        ok = rows >= 0
        offsets = np.concatenate([[0], np.cumsum(ok.sum(1))]).astype(np.int32)
        near = pa.StructArray.from_arrays([pa.array(best[ok], pa.float64()), pa.concat_arrays(ids.chunks).take(pa.array(m_rows[rows[ok]])).cast(pa.string())], ["d", "id"])
        return pa.table({"id": pa.concat_arrays(ids.chunks).take(pa.array(q_rows)).cast(pa.string()), "near": pa.ListArray.from_arrays(pa.array(offsets), near)})

    found = vectors.select("id", "is_chunk", "space", "vec").mapInArrow(route, ROUTED_SCHEMA).repartition(int(partitions), "key").groupBy("key").applyInArrow(scan, FOUND_SCHEMA)
    merged = found.groupBy("id").agg(F.flatten(F.collect_list("near")).alias("near"))  # at most `probes` lists of k + 2
    return merged.select("id", F.slice(F.array_sort("near"), 1, k).alias("near"))


def exact_distances(queries: np.ndarray, members: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """1 - cosine of each query and the members of its ``rows`` in double precision, by rows alone; infinite where there is none (-1)."""
    q, out = queries.astype(np.float64), np.full(rows.shape, np.inf)
    length = np.sqrt(np.einsum("ij,ij->i", q, q))
    for c in range(rows.shape[1]):
        m = members[rows[:, c]].astype(np.float64) if len(members) else np.zeros_like(q)
        d = 1 - np.einsum("ij,ij->i", q, m) / np.maximum(length * np.sqrt(np.einsum("ij,ij->i", m, m)), 1e-300)
        out[:, c] = np.where(rows[:, c] >= 0, np.maximum(d, 1e-12), np.inf)  # beside equal vectors, which have 0
    return out


def hash_block(text: str) -> int:
    import zlib

    return zlib.crc32(text.encode())


def usable_vectors(chunks: DataFrame, queries: DataFrame | None = None) -> DataFrame:
    """Every usable vector once, written to the shared checkpoint folder, with a hash of it. A chunk delivered more than once counts once."""
    parts = [unit_vectors(chunks, "chunk_id", True)]
    if queries is not None:
        parts.append(unit_vectors(queries, "query_id", False))
    rows = reduce(DataFrame.unionByName, parts)
    one = rows.groupBy("id", "is_chunk").agg(F.min(F.struct("space", "same", "vec")).alias("r")).select("id", "is_chunk", "r.space", "r.vec", "r.same")
    return cut_lineage(one)


def _class_join(left: DataFrame, classes: DataFrame, keys: list[str], hot: DataFrame | None) -> DataFrame:
    """Inner join where some ``hot`` classes may hold a large share of ``left``: these are broadcast (``hot`` has their keys), the others are shuffled."""
    if hot is None:
        return left.join(classes, keys)
    few = F.broadcast(hot.select(*keys).distinct())
    big = left.join(F.broadcast(classes.join(few, keys, "left_semi")), keys)
    return left.join(few, keys, "left_anti").join(classes, keys).unionByName(big)


def most_similar(chunks: DataFrame, queries: DataFrame | None = None, k: int = 5, hot_classes: int = 10_000, **options) -> DataFrame:
    """``id, is_chunk, near_id, cosine``: for every usable vector the ``k`` chunk vectors of its space with the highest cosine.

    The vector itself is left out; ties go to the smaller id. Equal vectors are searched once: their own copies come first
    and up to ``k`` + 1 of a class stand for it, so a vector repeated in a third of all rows makes no large list. Classes of more than one in
    ``hot_classes`` of all rows, so at most that many, are joined by broadcast. Vectors that
    don't parse to ``dimensions`` finite numbers, or are all zero or null, neither search nor are found. A space with one vector gives no
    row. Of an id delivered with different vectors the smallest is used.
    """
    v = usable_vectors(chunks, queries)
    key = ["space", "same"]
    many = cut_lineage(v.filter("is_chunk").groupBy(*key).agg(F.count("*").alias("n"), F.min("id").alias("rep")).filter("n > 1"))
    equal = not many.isEmpty()  # without equal vectors the joins below would change nothing
    hot = many.filter(F.col("n") > max(1000, v.count() // hot_classes)) if equal else None
    if hot is not None and hot.isEmpty():
        hot = None
    copies = cut_lineage(_class_join(v.filter("is_chunk").select("id", *key), many.drop("n"), key, hot).select("id", "rep")) if equal else None
    if equal:
        first = copies.withColumn("rn", F.row_number().over(Window.partitionBy("rep").orderBy("id"))).filter(F.col("rn") <= k + 1)
        classes = first.groupBy("rep").agg(F.collect_list("id").alias("ids"))  # at most k + 1 of a class
    search = v.join(copies.filter("id <> rep").select("id", F.lit(True).alias("is_chunk")), ["id", "is_chunk"], "left_anti") if equal else v
    # ids of chunks and queries are kept apart while they're searched together
    tag = F.concat(F.when(F.col("is_chunk"), "c").otherwise("q"), F.col("id"))
    found = nearest(search.select(tag.alias("id"), "is_chunk", "space", "vec"), k=k, **options)
    hits = found.select("id", F.explode("near").alias("n")).select("id", "n.d", F.expr("substring(n.id, 2)").alias("rep"))
    best = F.slice(F.array_sort(F.collect_set(F.struct("d", "near_id"))), 1, k)  # of at most k classes of k + 1
    if equal:
        # each found class stands for its members
        opened = hits.join(classes, "rep", "left").select("id", "d", F.explode(F.coalesce("ids", F.array("rep"))).alias("near_id"))
        top = opened.groupBy("id").agg(best.alias("near"))
        # a copy has its own class before what its representative found
        own = _class_join(copies, classes, ["rep"], hot).select("id", "rep", F.explode("ids").alias("near_id")).select("id", "rep", F.lit(0.0).alias("d"), "near_id")
        found_by = top.select(F.expr("substring(id, 2)").alias("rep"), "near", F.substring("id", 1, 1).alias("t")).filter("t = 'c'").select("rep", "near")
        lent = _class_join(copies, found_by, ["rep"], hot).select("id", "rep", F.explode("near").alias("n")).select("id", "rep", "n.d", "n.near_id")
        for_copies = own.unionByName(lent).filter(F.col("id") != F.col("near_id")).groupBy("id").agg(best.alias("near")).select(F.concat(F.lit("c"), "id").alias("id"), "near")
        rest = top.join(copies.select(F.concat(F.lit("c"), "id").alias("id")), "id", "left_anti")
        out = rest.unionByName(for_copies).select("id", F.explode("near").alias("n")).select("id", "n.d", "n.near_id")
    else:
        out = hits.select("id", "d", F.col("rep").alias("near_id"))
    return out.select(F.expr("substring(id, 2)").alias("id"), (F.substring("id", 1, 1) == "c").alias("is_chunk"), "near_id", F.round(1 - F.col("d"), 6).alias("cosine"))


def similar_pairs(chunks: DataFrame, queries: DataFrame | None = None, k: int = 5, **options) -> DataFrame:
    """``id_a, id_b``: each pair of a vector and one of its ``k`` most similar chunks once, the smaller id first."""
    return most_similar(chunks, queries, k, **options).select(F.least("id", "near_id").alias("id_a"), F.greatest("id", "near_id").alias("id_b")).distinct()
