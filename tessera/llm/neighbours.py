"""Near-duplicate vectors by a robust-pruned flat graph.

Equal vectors of a label are one class.  Classes are dealt to overlapping
cluster shards: a shard above ``SHARD`` members is split around spherical
k-means centres fitted on a bounded sample of it, again and again.  The centres
are a tree that every task holds; a vector goes down it with the ``BEAM`` best
centres and, at the end, to those shards whose centre is about as near as the
nearest: three at most, however often a shard was split.  In each shard every
vector is joined with the neighbours that robust pruning leaves (a neighbour is
dropped if an already chosen one is nearer to it by the factor ``ALPHA``); the
adjacency of all shards is united by vector.  Every vector then searches its
shards, that of its nearest centre and the others: greedily from the medoid to
itself, and on from there through all vectors in range.  Pairs found are
verified in double precision and count in one of the shards that both are in.
:func:`audit_recall` compares link counts with brute force.

On disk are, at any time, the vectors once, the exchange of one wave of shards
(vectors as ``OVERLAP`` copies at most, ``WAVES`` waves) and the adjacency, as
bits of pairs of members.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from tessera.llm.common import components, discard, staged

SHARD = 800
FANOUT = 64
#: Sampled vectors per centre, and rounds of k-means.
SAMPLED, ROUNDS = 48, 8
#: Levels of splitting; a shard that is still too large (vectors that no centre
#: tells apart) is worked off in pairs of blocks, and so are the last ones that
#: are, if that is up to this share of the classes.
LEVELS, FEW = 6, 0.05
ALPHA = 1.2
#: A vector goes to centres whose cosine is at most this below the best one's,
#: three at most; the search goes on through vectors so far below the threshold.
MARGIN, OVERLAP, SLACK = 0.12, 3, 0.03
#: Centres that a vector follows down the tree.
BEAM = 2 * OVERLAP
#: Shards are worked off in so many waves, a power of two, from about so many
#: classes per wave on.
WAVES, WAVE = 4, 500_000

CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _settled(df: DataFrame, name: str) -> DataFrame:
    """:func:`staged`, after which the shuffle files behind it are dropped."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP_KEY, None)
    conf.set(CLEANUP_KEY, "true")
    try:
        return staged(df, name)
    finally:
        if before is None:
            conf.unset(CLEANUP_KEY)
        else:
            conf.set(CLEANUP_KEY, before)


def _usable(v: Column) -> Column:
    """No null, infinite or NaN component, and not the zero vector."""
    inf, low, high = F.lit(float("inf")), F.array_min(v), F.array_max(v)
    # unknown where a component is null; a NaN is above all numbers
    sound = ~F.array_contains(v, inf) & (low > -inf) & (high < inf)
    return F.coalesce(sound & ((low != 0) | (high != 0)), F.lit(False))


def _unit(vectors) -> np.ndarray:
    x = np.array(vectors if isinstance(vectors, np.ndarray) else list(vectors), dtype=np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


class Cells(NamedTuple):
    """The tree of centres for vectors of one length; a node's children follow
    each other."""

    roots: dict[int, int]  #: node of a group that was split
    shard: np.ndarray  #: by node
    first: np.ndarray
    kids: np.ndarray
    centres: np.ndarray  #: half precision: every task holds them


class Places(NamedTuple):
    """Where vectors go, and what is known of shards above ``SHARD`` members."""

    cells: dict[int, Cells]  #: by length of the vectors
    large: np.ndarray  #: shards, sorted
    split: np.ndarray  #: centres to be fitted for each of them
    rate: np.ndarray  #: share of their members to be sampled for that
    blocks: np.ndarray  #: blocks they are worked off in, if they stay whole


def _grown(cells: Cells | None, dims: int, found: list[tuple[int, int, bytes]]) -> Cells:
    """``cells`` with the centres found for some of its shards."""
    if cells is None:
        cells = Cells({}, *(np.zeros(0, t) for t in (np.int64, np.int32, np.int32)), np.zeros((0, dims), np.float16))
    known = {s: i for i, s in enumerate(cells.shard.tolist())}
    fresh = [s for s, _, _ in found if s not in known]
    n = len(cells.shard)
    roots = cells.roots | {s: n + i for i, s in enumerate(fresh)}
    known |= {s: n + i for i, s in enumerate(fresh)}
    shard = [cells.shard, np.array(fresh, np.int64)]
    centres = [cells.centres, np.zeros((len(fresh), dims), np.float16)]
    total = n + len(fresh) + sum(k for _, k, _ in found)
    first, kids = (np.concatenate([v, np.zeros(total - n, np.int32)]) for v in (cells.first, cells.kids))
    at = n + len(fresh)
    for s, k, c in found:
        first[known[s]], kids[known[s]] = at, k
        shard.append(np.int64(s) * np.ones(1, np.int64) * 1_000_003 + np.arange(1, k + 1))  # wraps: a hash of the path
        centres.append(np.frombuffer(c, np.float16).reshape(k, dims))
        at += k
    return Cells(roots, np.concatenate(shard), first, kids, np.concatenate(centres))


def _children(cells: Cells, x: np.ndarray, row: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(row, child, cosine)`` of the best children of each ``(row, node)``."""
    order = np.argsort(node, kind="stable")
    row, node = row[order], node[order]
    starts = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
    if len(row) < 8 * len(starts):
        k = cells.kids[node]
        rows = np.repeat(row, k)
        to = np.repeat(cells.first[node] - (np.cumsum(k) - k), k) + np.arange(len(rows))
        cos = np.empty(len(rows), np.float32)
        for a in range(0, len(rows), 65_536):
            b = a + 65_536
            cos[a:b] = np.einsum("rd,rd->r", x[rows[a:b]], cells.centres[to[a:b]].astype(np.float32))
        return rows, to, cos
    out = []
    for a, b in zip(starts, np.r_[starts[1:], len(row)]):
        at, k = cells.first[node[a]], cells.kids[node[a]]
        cos = x[row[a:b]] @ cells.centres[at : at + k].astype(np.float32).T
        best = np.broadcast_to(np.arange(k), cos.shape)
        if k > BEAM:
            best = np.argpartition(-cos, BEAM - 1, axis=1)[:, :BEAM]
            cos = np.take_along_axis(cos, best, axis=1)
        out.append((np.repeat(row[a:b], best.shape[1]), at + best.ravel(), cos.ravel()))
    return tuple(np.concatenate(v) for v in zip(*out))


def _shards_of(places: Places, grp: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(row, rank, shard)`` for unit vectors ``x`` of the groups ``grp``, by row
    and nearness."""
    cells = places.cells.get(x.shape[1])
    if cells is None:
        return np.arange(len(x)), np.zeros(len(x), np.int64), grp
    own, back = np.unique(grp, return_inverse=True)
    root = np.array([cells.roots.get(g, -1) for g in own.tolist()], np.int64)[back]
    row = np.flatnonzero(root >= 0)
    node, cos, x = root[row], np.zeros(len(row), np.float32), x.astype(np.float32)
    while True:
        inner = cells.kids[node] > 0
        if not inner.any():
            break
        found = _children(cells, x, row[inner], node[inner])
        row, node, cos = (np.concatenate([a[~inner], b]) for a, b in zip((row, node, cos), found))
        order = np.argsort(4.0 * row - cos, kind="stable")  # by row, the nearest first
        row, node, cos = row[order], node[order], cos[order]
        keep = np.arange(len(row)) - np.searchsorted(row, row) < BEAM
        row, node, cos = row[keep], node[keep], cos[keep]
    begin = np.searchsorted(row, row)
    rank = np.arange(len(row)) - begin
    near = (rank < OVERLAP) & (cos >= cos[begin] - np.float32(MARGIN))
    whole = np.flatnonzero(root < 0)
    row = np.concatenate([row[near], whole])
    order = np.argsort(row, kind="stable")
    rank = np.concatenate([rank[near], np.zeros(len(whole), np.int64)])[order]
    return row[order], rank, np.concatenate([cells.shard[node[near]], grp[whole]])[order]


def _values(column: pa.Array) -> np.ndarray:
    """A column of numbers, or of lists of one length as a matrix."""
    if pa.types.is_list(column.type):
        return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
    return column.to_numpy(zero_copy_only=False)


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[dict[str, np.ndarray], np.ndarray]]:
    """The columns and the vectors of a batch, for each length of vector."""
    vec = batch.column(batch.schema.get_field_index("vec"))
    sizes = pc.list_value_length(vec).to_numpy(zero_copy_only=False)
    rest = {f.name: _values(batch.column(i)) for i, f in enumerate(batch.schema) if f.name != "vec"}
    for d in np.unique(sizes):
        at = sizes == d
        v = (vec if at.all() else vec.filter(pa.array(at))).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
        yield {k: c[at] for k, c in rest.items()}, v


def _looked_up(shard: np.ndarray, large: np.ndarray, values: np.ndarray, other) -> np.ndarray:
    if not len(large):
        return np.full(shard.shape, other, values.dtype)
    at = np.minimum(np.searchsorted(large, shard), len(large) - 1)
    return np.where(large[at] == shard, values[at], other)


def _lists(rows: np.ndarray) -> pa.Array:
    """The rows of a matrix as lists."""
    ends = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.ascontiguousarray(rows).ravel()))


def _binary(rows: np.ndarray) -> pa.Array:
    """The rows of a structured array, or of a matrix, as binary values."""
    rows = np.ascontiguousarray(rows)
    ends = np.arange(len(rows) + 1, dtype=np.int64) * (rows.nbytes // max(1, len(rows)))
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(rows)])


def _counter(shared):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rest, v in _by_length(batch):
                shard, n = np.unique(_shards_of(shared.value, rest["grp"], _unit(v))[2], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(shard), pa.array(n)], ["shard", "n"])

    return count


def _sampler(shared):
    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = shared.value
        for batch in batches:
            for rest, v in _by_length(batch):
                x = _unit(v)
                row, _, shard = _shards_of(places, rest["grp"], x)
                at = rest["u"][row] < _looked_up(shard, places.large, places.rate, 0.0)
                row, shard = row[at], shard[at]
                k = _looked_up(shard, places.large, places.split, 0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard), pa.array(k), pa.array(rest["cls"][row]), _binary(x[row].astype(np.float32))],
                    ["shard", "k", "cls", "vec"])

    return sample


def _centres(rows: pa.Table) -> pa.Table:
    shard, k = rows["shard"][0].as_py(), rows["k"][0].as_py()
    x = np.frombuffer(b"".join(rows["vec"].to_pylist()), np.float32).reshape(rows.num_rows, -1)
    x = _unit(x[np.argsort(rows["cls"].to_numpy(), kind="stable")])
    rng = np.random.default_rng(len(x))
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(ROUNDS):
        own = np.argmax(x @ c.T, axis=1)
        sums = (own == np.arange(len(c))[:, None]).astype(np.float64) @ x
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        c = np.where(norm > 1e-9, sums / np.maximum(norm, 1e-9), c)
    c = c.astype(np.float16)
    c = c[np.sort(np.unique(c.view(np.uint16), axis=0, return_index=True)[1])]
    return pa.table({"shard": [shard], "k": [len(c)], "dims": [x.shape[1]], "centres": [c.tobytes()]})


def cluster_shards(classes: DataFrame) -> Places:
    """The places of ``classes (cls, grp, vec)``: the shards of every vector follow
    from them, and the first is its home."""
    context = classes.sparkSession.sparkContext
    places = Places({}, *(np.zeros(0, t) for t in (np.int64, np.int64, np.float64, np.int64)))
    sizes, whole, total = classes.groupBy("grp").agg(F.count(F.lit(1)).alias("n")), set(), classes.count()
    for level in range(LEVELS + 1):
        large = sorted((s, n) for s, n in sizes.where(F.col("n") > SHARD).collect())
        shard, n = np.array(large, np.int64).reshape(-1, 2).T
        # so many centres that the shards with their overlap are small enough at
        # once, also if all of a vector's shards come from one; most members of a
        # shard that was split have their overlap already
        split = np.clip(np.ceil(n * (2 if level else OVERLAP) / (0.6 * SHARD)).astype(np.int64), 2, FANOUT)
        places = Places(places.cells, shard, split, SAMPLED * split / n, -(-n // (2 * SHARD)))
        open_ = [s for s, _ in large if s not in whole]
        few = (n * places.blocks).sum() <= total * FEW
        if not open_ or level == LEVELS or few:
            return places
        shared = context.broadcast(places._replace(rate=np.where(np.isin(shard, open_), places.rate, 0.0)))
        u = (F.pmod(F.xxhash64("cls", F.lit(level)), F.lit(1 << 30)) / float(1 << 30)).alias("u")
        drawn = classes.select("cls", "grp", "vec", u).where(F.col("u") < float(places.rate.max())).mapInArrow(
            _sampler(shared), "shard bigint, k bigint, cls bigint, vec binary")
        found: dict[int, list] = {}
        for r in _settled(drawn.groupBy("shard").applyInArrow(
                _centres, "shard bigint, k bigint, dims bigint, centres binary"), "centres").orderBy("shard").collect():
            if r["k"] > 1:
                found.setdefault(r["dims"], []).append((r["shard"], r["k"], bytes(r["centres"])))
            else:  # nothing tells its members apart
                whole.add(r["shard"])
        shared.destroy()
        places = places._replace(cells=places.cells | {
            d: _grown(places.cells.get(d), d, new) for d, new in found.items()})
        shared = context.broadcast(places)
        sizes = _settled(classes.select("grp", "vec").mapInArrow(_counter(shared), "shard bigint, n bigint").groupBy(
            "shard").agg(F.sum("n").alias("n")).where(F.col("n") > SHARD), "large")
        shared.destroy()
    return places


def _member(dims: int, kind: str) -> np.dtype:
    """A vector in a part.  ``places`` are its shards, the home first and again
    where there are fewer, with the blocks each is worked off in; ``slot`` is
    the shard of this part and ``x``, ``y`` are its blocks."""
    return np.dtype([("cls", "<i8"), ("size", "<i8"), ("places", "<i8", (OVERLAP,)), ("blocks", "<i4", (OVERLAP,)),
                     ("slot", "<i4"), ("x", "<i4"), ("y", "<i4"), ("vec", kind, (dims,))])


def _part(shard: np.ndarray, x, y) -> np.ndarray:
    """The key of the blocks ``x`` and ``y`` of a shard, in the shard's wave."""
    return shard + (np.asarray(x, np.int64) << 42) + (np.asarray(y, np.int64) << 21)  # wraps


def _placer(shared):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rest, v in _by_length(batch):
                row, rank, shard = _shards_of(shared.value, rest["grp"], _unit(v))
                to = np.repeat(shard[rank == 0][:, None], OVERLAP, axis=1)
                to[row, rank] = shard
                yield pa.RecordBatch.from_arrays(
                    [*map(pa.array, (rest["cls"], rest["rep"], rest["size"])), _lists(to), _lists(v)],
                    ["cls", "rep", "size", "places", "vec"])

    return place


def _dealer(shared, kind: str, waves: int, wave: int):
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        large, blocks_of = shared.value.large, shared.value.blocks
        for batch in batches:
            for rest, v in _by_length(batch):
                to = rest["places"]
                slots = np.arange(OVERLAP)
                row, slot = np.nonzero(((slots == 0) | (to != to[:, :1])) & (to & (waves - 1) == wave))
                m = np.zeros(len(row), _member(v.shape[1], kind))
                m["cls"], m["size"], m["vec"] = rest["cls"][row], rest["size"][row], v[row]
                m["places"], m["slot"] = to[row], slot
                m["blocks"] = _looked_up(m["places"], large, blocks_of, 1)
                blocks = m["blocks"][np.arange(len(m)), slot]
                own, m = np.repeat(m["cls"] % blocks, blocks), np.repeat(m, blocks)
                other = np.arange(len(m)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
                m["x"], m["y"] = np.minimum(own, other), np.maximum(own, other)
                part = _part(m["places"][np.arange(len(m)), m["slot"]], m["x"], m["y"])
                yield pa.RecordBatch.from_arrays([pa.array(part), _binary(m)], ["part", "body"])

    return deal


def robust_pruned(x: np.ndarray, alpha: float = ALPHA) -> np.ndarray:
    """Adjacency (symmetric) of the robust-pruned graph over unit vectors."""
    n = len(x)
    near = np.zeros((n, n), bool)
    if n < 2:
        return near
    d = x @ x.T
    d *= -2
    d += 2
    d = np.sqrt(np.maximum(d, 0, out=d), out=d).astype(np.float32)
    # scaled up, the difference of what is dropped is above all distances
    far, scale = alpha * d, np.float32(2.0**100)
    far = np.where(far > 0, np.nextafter(far, -np.float32(np.inf)), np.float32(-1)) * scale
    step = max(16, 700_000 // n)  # rows at a time: their matrices stay small
    for lo in range(0, n, step):
        own = d[lo : lo + step]
        rows = np.arange(lo, lo + len(own))
        left = own.copy()  # candidates still open, above all distances once chosen or dropped
        left[rows - lo, rows] = np.inf
        own = own * scale
        gain = np.empty_like(own)
        while True:
            at = np.arange(len(rows))
            p = np.argmin(left, axis=1)
            open_ = left[at, p] < 4
            count = np.count_nonzero(open_)
            if not count:
                break
            near[rows[open_], p[open_]] = True
            if count < 0.8 * len(rows):
                rows, left, own, p, at = rows[open_], left[open_], own[open_], p[open_], at[:count]
                gain = gain[:count]
            np.take(far, p, axis=0, out=gain, mode="clip")
            np.subtract(own, gain, out=gain)
            np.maximum(left, gain, out=left)
            left[at, p] = np.inf
    return near | near.T


def range_search(x: np.ndarray, near: np.ndarray, queries: np.ndarray, threshold: float, slack: float = SLACK) -> np.ndarray:
    """Pairs ``(query, node)`` with a cosine of ``threshold`` or more that the
    search of the graph ``near`` finds, for ``queries`` given as node numbers:
    all at once, greedily from the medoid, then on through the nodes in range."""
    n, all_sims = len(x), x @ x.T
    medoid = int(np.argmax(x @ x.mean(axis=0)))
    weights = near.astype(np.float32)
    out = []
    step = max(1, 4_000_000 // max(1, n))
    for lo in range(0, len(queries), step):
        q = queries[lo : lo + step]
        sims = all_sims[q]
        cur, best = np.full(len(q), medoid), sims[:, medoid].copy()
        moving = np.arange(len(q))
        while len(moving):
            around = np.where(near[cur[moving]], sims[moving], -np.inf)
            pick = np.argmax(around, axis=1)
            got = around[np.arange(len(moving)), pick]
            better = got > best[moving] + 1e-12
            moving = moving[better]
            cur[moving], best[moving] = pick[better], got[better]
        # the first node of a query is followed even if out of range
        seen = near[cur]
        seen[np.arange(len(q)), cur] = True
        go = seen & (sims >= threshold - slack)
        go[np.arange(len(q)), cur] = False
        while go.any():
            at = np.flatnonzero(go.any(axis=1))
            fresh = (go[at].astype(np.float32) @ weights > 0) & ~seen[at]
            seen[at] |= fresh
            go = np.zeros_like(go)
            go[at] = fresh & (sims[at] >= threshold - slack)
        r, m = np.nonzero(seen & (sims >= threshold))
        out.append(np.stack([q[r], m], axis=1))
    found = np.concatenate(out) if out else np.zeros((0, 2), np.int64)
    return found[found[:, 0] != found[:, 1]]


def _members(rows: pa.Table, kind: str) -> np.ndarray:
    """The members of a part by class."""
    body = rows["body"].to_pylist()
    m = np.frombuffer(b"".join(body), _member((len(body[0]) - _member(0, kind).itemsize) // np.dtype(kind).itemsize, kind))
    return m[np.argsort(m["cls"], kind="stable")]


def _packed(near: np.ndarray) -> bytes:
    """A symmetric adjacency as the bits of its lower triangle."""
    return np.packbits(near[np.tri(len(near), k=-1, dtype=bool)]).tobytes()


def _unpacked(bits: bytes, n: int) -> np.ndarray:
    near = np.zeros((n, n), bool)
    near[np.tri(n, k=-1, dtype=bool)] = np.unpackbits(np.frombuffer(bits, np.uint8), count=n * (n - 1) // 2)
    return near | near.T


def _builder(kind: str):
    def build(rows: pa.Table) -> pa.Table:
        """The graph of a part: for the part itself, and of the members that
        another one has as well, for that one.  What a shard worked off in
        blocks has found between members of one block goes to all its parts
        with that block; shards tell each other of such pairs alone."""
        m = _members(rows, kind)
        near = robust_pruned(_unit(m["vec"]))
        out = [(rows["part"][0].as_py(), b"", _packed(near))]
        x, slot = int(m["x"][0]), m["slot"]
        if x == m["y"][0]:
            row, to = np.nonzero((np.arange(OVERLAP) != slot[:, None])
                                 & ((np.arange(OVERLAP) == 0) | (m["places"] != m["places"][:, :1])))
            own = m["cls"][row] % m["blocks"][row, to]
            part = _part(m["places"][row, to], own, own)
            order = np.argsort(part, kind="stable")
            row, part = row[order], part[order]
            starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(part) else []
            told = [(int(part[a]), row[a:b]) for a, b in zip(starts, [*starts[1:], len(part)]) if b - a > 1]
            here = m["places"][0, slot[0]][None]
            told += [(int(_part(here, min(x, y), max(x, y))[0]), np.arange(len(m))) for y in range(m["blocks"][0, slot[0]]) if y != x]
            for to_part, at in told:
                some = near[np.ix_(at, at)]
                if some.any():
                    out.append((to_part, m["cls"][at].tobytes(), _packed(some)))
        return pa.table({k: pa.array(v, t) for k, v, t in zip(("part", "ids", "bits"), zip(*out), (pa.int64(), pa.binary(), pa.binary()))})

    return build


def _finder(threshold: float, kind: str):
    def find(rows: pa.Table, graphs: pa.Table) -> pa.Table:
        """Rows ``(a, b, n)``: link counts of ``a`` (b null), and links that span
        the components (n null).

        A link counts, for both vectors, in the least of the shards that both
        are in, so that no list of pairs is needed to count every link once."""
        m = _members(rows, kind)
        cls, size, places = m["cls"], m["size"], m["places"]
        here = places[np.arange(len(m)), m["slot"]]
        block = cls % m["blocks"][np.arange(len(m)), m["slot"]]
        near = np.zeros((len(m), len(m)), bool)
        for ids, bits in zip(graphs["ids"].to_pylist(), graphs["bits"].to_pylist()):
            at = np.searchsorted(cls, np.frombuffer(ids, np.int64)) if ids else np.arange(len(m))
            near[np.ix_(at, at)] |= _unpacked(bits, len(at))
        pairs = range_search(_unit(m["vec"]), near, np.arange(len(m)), threshold)
        if m["x"][0] != m["y"][0]:
            pairs = pairs[block[pairs[:, 0]] != block[pairs[:, 1]]]
        pairs = np.unique(np.concatenate([pairs, pairs[:, ::-1]]), axis=0)
        least = np.full(len(pairs), np.iinfo(np.int64).max)
        for p in places.T:
            both = (places[pairs[:, 1]] == p[pairs[:, 0]][:, None]).any(axis=1)
            least = np.where(both, np.minimum(least, p[pairs[:, 0]]), least)
        links = pairs[least == here[pairs[:, 0]]]
        counts = np.bincount(links[:, 0], weights=size[links[:, 1]], minlength=len(cls)).astype(np.int64)
        at = np.flatnonzero(counts)
        root = np.arange(len(cls))
        i, j = pairs.T
        while len(i):
            low = root.copy()
            np.minimum.at(low, i, root[j])
            np.minimum.at(low, j, root[i])
            low = low[low]
            if (low == root).all():
                break
            root = low
        joined = np.flatnonzero(root != np.arange(len(cls)))
        none = pa.nulls
        return pa.table({
            "a": pa.array(np.concatenate([cls[at], cls[root[joined]]])),
            "b": pa.concat_arrays([none(len(at), pa.int64()), pa.array(cls[joined])]),
            "n": pa.concat_arrays([pa.array(counts[at]), none(len(joined), pa.int64())])})

    return find


def near_vectors(vectors: DataFrame, threshold: float = 0.98) -> DataFrame:
    """Link vectors of one label and length with a cosine of ``threshold`` or more.

    For ``vectors (vec_id, embedding, label, ...)`` returns one row per input
    row: ``vec_id``, ``n_links`` (other vectors linked with it directly),
    ``component_id`` (the smallest vec_id reachable) and ``kept``.  A null or
    zero vector, one with a null or non-finite component, a null label and a
    null vec_id link with nothing (a null vec_id has a null component and is
    kept).  Repeated rows count as vectors of their own.  An empty table gives
    an empty result; other columns are not read.
    """
    # components of type float stay so: as doubles the shards would take twice the disk
    kind = vectors.schema["embedding"].dataType.elementType.typeName()
    kind = "float" if kind == "float" else "double"
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("string").alias("label"),
                          F.transform("embedding", lambda x: x.cast(kind) + F.lit(0.0).cast(kind)).alias("vec"))
    good = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & _usable(F.col("vec"))
    rows = rows.withColumn("cls", F.when(good, F.xxhash64("label", "vec")))
    classes = rows.where("cls is not null").groupBy("cls").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("size"), F.first("vec").alias("vec"),
        F.first(F.xxhash64("label", F.size("vec"))).alias("grp"))
    classes = _settled(classes, "vector-classes")
    rows = _settled(rows.select("vec_id", "cls"), "vectors")
    shared = vectors.sparkSession.sparkContext.broadcast(cluster_shards(classes))
    placed = _settled(classes.mapInArrow(_placer(shared), f"cls bigint, rep bigint, size bigint, places array<bigint>, vec array<{kind}>"), "placed")
    discard(classes)

    body = "f4" if kind == "float" else "f8"
    waves = min(WAVES, 1 << (placed.count() // WAVE).bit_length())

    def dealt(wave: int) -> DataFrame:
        mine = F.exists("places", lambda s: s.bitwiseAND(F.lit(waves - 1)) == wave)
        return placed.where(mine).select("cls", "size", "places", "vec").mapInArrow(
            _dealer(shared, body, waves, wave), "part bigint, body binary").groupBy("part")

    def united(name: str, tables) -> DataFrame:
        return reduce(DataFrame.unionByName, [_settled(t, name) for t in tables])

    graphs = united("graph", (dealt(w).applyInArrow(_builder(body), "part bigint, ids binary, bits binary") for w in range(waves)))
    found = united("found", (dealt(w).cogroup(
        graphs.where(F.col("part").bitwiseAND(F.lit(waves - 1)) == w).groupBy("part")).applyInArrow(
        _finder(threshold, body), "a bigint, b bigint, n bigint") for w in range(waves)))
    discard(graphs)
    shared.destroy()

    counts = found.where("b is null").groupBy("a").agg(F.sum("n").alias("others"))
    comps = components(found.where("b is not null").select("a", "b"))
    known = placed.select("cls", "rep", "size").join(counts, F.col("cls") == F.col("a"), "left").join(
        comps, F.col("cls") == F.col("node"), "left").select(
        "cls", "rep", (F.col("size") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("component", "cls").alias("comp"))
    known = staged(known, "vector-links")
    discard(placed)
    smallest = known.groupBy("comp").agg(F.min("rep").alias("component_id"))
    known = known.join(smallest, "comp").select("cls", "n_links", "component_id")
    out = rows.select("vec_id", "cls").join(known, "cls", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
                      component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))


def audit_recall(vectors: DataFrame, result: DataFrame, every: int = 50, threshold: float = 0.98,
                 most: int = 20_000) -> tuple[int, int]:
    """Links found and links there are, for the vectors whose id ``every``
    divides, against all vectors by brute force.  The query set is broadcast;
    more than ``most`` queries are refused (raise ``every``)."""
    good = vectors.where(F.col("label").isNotNull() & _usable(F.transform("embedding", lambda x: x.cast("double"))))
    asked = good.where(F.col("vec_id") % every == 0).select("vec_id", "label", "embedding").limit(most + 1).toPandas()
    if len(asked) > most:
        raise ValueError(f"more than {most} queries: raise every")
    if not len(asked):
        return 0, 0
    queries = [(q["label"].to_numpy(), q["vec_id"].to_numpy(), _unit(q["embedding"]))
               for _, q in asked.groupby(asked["embedding"].map(len))]

    def work(batches):
        for b in batches:
            n = 0
            for size, x in b.groupby(b["embedding"].map(len)):
                for labels, ids, q in queries:
                    if q.shape[1] == size:
                        hit = _unit(x["embedding"]) @ q.T >= threshold
                        hit &= (x["label"].to_numpy()[:, None] == labels) & (x["vec_id"].to_numpy()[:, None] != ids)
                        n += int(hit.sum())
            yield pd.DataFrame({"n": [n]})

    there = good.select("vec_id", "label", "embedding").mapInPandas(work, "n bigint").agg(F.sum("n")).first()[0] or 0
    found = result.where(F.col("vec_id") % every == 0).agg(F.sum("n_links")).first()[0] or 0
    return int(found), int(there)
