"""Approximate nearest neighbours: a hierarchical navigable small-world graph for each shard.

Equal vectors are one node.  Nodes are dealt evenly into shards of bounded size;
a task builds the graph of a shard, inserting a block of nodes at a time with
array operations, and the graph is written as rows of flat neighbour arrays.
Queries stream through every shard, and the best of all shards are merged.
Inner products become distances by one more component that brings every vector
to the length of the longest.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window as W, functions as F

from estimand.llm import words
from estimand.plans.prefix import stored

#: Nodes of a shard at most (100 MB at 100 dimensions), and the least number of shards.
SHARD_NODES, LEAST_SHARDS = 100_000, 8
LINKS, BUILD_WIDTH, SEARCH_WIDTH, BLOCK = 16, 64, 128, 128
#: Candidates of one query expanded together.
STEP = 4


class Layer:
    """One layer: ``own`` maps its nodes to rows of the shard's vectors, ``near`` holds their neighbours (-1: none)."""

    def __init__(self, vectors, own, width):
        self.x, self.own = vectors[own], np.asarray(own, np.int64)
        self.near = np.full((len(own), width), -1, np.int32)

    def search(self, q, entry, width, limit=None):
        """Nodes (queries x width) and similarities, best first, among the first ``limit`` nodes; -1 where there is no more."""
        n = len(self.own) if limit is None else limit
        rows = np.arange(len(q))[:, None]
        seen = np.zeros((len(q), n + 1), bool)
        ids = np.full((len(q), width), -1, np.int64)
        sims = np.full((len(q), width), -np.inf, np.float32)
        e = min(entry.shape[1], width)
        first = np.argsort(-np.where(entry >= 0, np.einsum("qd,qed->qe", q, self.x[entry]), -np.inf), axis=1, kind="stable")[:, :e]
        ids[:, :e] = np.take_along_axis(entry, first, 1)
        sims[:, :e] = np.where(ids[:, :e] >= 0, np.einsum("qd,qed->qe", q, self.x[ids[:, :e]]), -np.inf)
        seen[rows, ids] = True
        open_ = ids >= 0
        active = np.arange(len(q))
        while len(active):
            turn = np.cumsum(open_[active], axis=1)
            take = open_[active] & (turn <= STEP)
            alive = take.any(axis=1)
            active, take = active[alive], take[alive]
            if not len(active):
                break
            pick = np.argsort(~take, axis=1, kind="stable")[:, :STEP]
            cur = np.where(np.take_along_axis(take, pick, 1), np.take_along_axis(ids[active], pick, 1), -1)
            open_[active] &= ~take
            new = np.where(cur[:, :, None] >= 0, self.near[cur], -1).reshape(len(active), -1).astype(np.int64)
            new.sort(axis=1)
            new[:, 1:][new[:, 1:] == new[:, :-1]] = -1
            new[seen[active[:, None], new]] = -1
            seen[active[:, None], new] = True
            sim = np.where(new >= 0, np.einsum("qd,qed->qe", q[active], self.x[new]), -np.inf)
            all_ids, all_sims = np.concatenate([ids[active], new], axis=1), np.concatenate([sims[active], sim], axis=1)
            all_open = np.concatenate([open_[active], new >= 0], axis=1)
            best = np.argsort(-all_sims, axis=1, kind="stable")[:, :width]
            ids[active], sims[active] = np.take_along_axis(all_ids, best, 1), np.take_along_axis(all_sims, best, 1)
            open_[active] = np.take_along_axis(all_open, best, 1) & (ids[active] >= 0)
        return ids, sims

    def chosen(self, ids, sims, most):
        """Diverse neighbours: best first, each nearer to the node than to any neighbour already taken; the rest fills up."""
        pool = ids.shape[1]
        x = self.x[ids]
        mutual = np.einsum("nad,nbd->nab", x, x)
        valid = ids >= 0
        taken, count = np.zeros(ids.shape, bool), np.zeros(len(ids), np.int64)
        for c in range(pool):
            close = (np.where(taken, mutual[:, c, :], -np.inf) > sims[:, c, None]).any(axis=1)
            ok = valid[:, c] & ~close & (count < most)
            taken[:, c] = ok
            count += ok
        order = np.argsort(np.where(taken, 0, np.where(valid, 1, 2)), axis=1, kind="stable")[:, :most]
        return np.where(np.take_along_axis(valid, order, 1), np.take_along_axis(ids, order, 1), -1)

    def link_back(self, nodes, targets):
        """Let the targets point back to the nodes; a full target keeps a diverse choice."""
        width = self.near.shape[1]
        pairs = np.stack([targets.ravel(), np.repeat(nodes, targets.shape[1])], axis=1)
        pairs = pairs[pairs[:, 0] >= 0]
        order = np.argsort(pairs[:, 0], kind="stable")
        t, s = pairs[order].T
        first = np.flatnonzero(np.diff(t, prepend=-1))
        size = np.diff(np.append(first, len(t)))
        touched = t[first]
        grid = np.full((len(touched), int(size.max(initial=0))), -1, np.int64)
        grid[np.repeat(np.arange(len(touched)), size), np.arange(len(t)) - np.repeat(first, size)] = s
        for a in range(0, len(touched), 512):
            rows = touched[a : a + 512]
            pool = np.concatenate([self.near[rows].astype(np.int64), grid[a : a + 512]], axis=1)
            sims = np.where(pool >= 0, np.einsum("nd,ned->ne", self.x[rows], self.x[pool]), -np.inf)
            best = np.argsort(-sims, axis=1, kind="stable")[:, : 2 * width]
            pool, sims = np.take_along_axis(pool, best, 1), np.take_along_axis(sims, best, 1)
            self.near[rows] = self.chosen(pool, sims, width)


def build(vectors, levels):
    """Layers of one shard, lowest first; the nodes of the highest levels go in first."""
    layers = []
    order = np.argsort(-levels, kind="stable")
    for level in range(int(levels.max(initial=0)), -1, -1):
        own = order[levels[order] >= level]
        layer = Layer(vectors, own, LINKS if level else 2 * LINKS)
        above = layers[-1] if layers else None
        for a in range(0, len(own), BLOCK):
            b = min(a + BLOCK, len(own))
            q, nodes = layer.x[a:b], np.arange(a, b)
            within = q @ q.T
            within[np.arange(b - a), np.arange(b - a)] = -np.inf
            ids, sims = np.broadcast_to(nodes, within.shape), within
            if a:
                found, near = layer.search(q, _entries(above, q, a), BUILD_WIDTH, a)
                ids, sims = np.concatenate([found, ids], axis=1), np.concatenate([near, sims], axis=1)
            best = np.argsort(-sims, axis=1, kind="stable")[:, :BUILD_WIDTH]
            ids, sims = np.take_along_axis(ids, best, 1), np.take_along_axis(sims, best, 1)
            ids = np.where(np.isfinite(sims), ids, -1)
            picked = layer.chosen(ids, sims, LINKS)
            layer.near[a:b, : picked.shape[1]] = picked
            layer.link_back(nodes, picked)
        layers.append(layer)
    return layers[::-1]


def _entries(above, q, limit):
    """Entry nodes for a layer: the best of the layer above (its nodes come first here too), or some early nodes."""
    start = np.broadcast_to(np.arange(min(limit, 4)), (len(q), min(limit, 4)))
    if above is None:
        return start
    ids, _ = above.search(q, np.broadcast_to(np.arange(min(4, len(above.own))), (len(q), min(4, len(above.own)))), 8)
    return np.concatenate([np.where(ids < limit, ids, -1), start], axis=1)


def search(layers, q, width):
    """Best nodes of the lowest layer for every query, down through the layers."""
    entry = None
    for layer in layers[::-1]:
        if entry is None:
            e = min(8, len(layer.own))
            entry = np.broadcast_to(np.arange(e), (len(q), e))
        entry, sims = layer.search(q, entry, width if layer is layers[0] else 8)
    return layers[0].own[entry], np.where(entry >= 0, sims, -np.inf)


def _level(cid):
    """Level of a node, geometric with ratio 1 / LINKS, from a hash of its id."""
    u = (words.mix(cid.astype(np.int64).view(np.uint64) + np.uint64(7)) >> np.uint64(11)).astype(float) / 2.0**53
    return np.floor(-np.log(np.maximum(u, 1e-300)) / np.log(LINKS)).astype(int)


def _matrix(column):
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    cut = np.asarray(column.offsets)
    flat = np.asarray(column.values, np.float64)[cut[0] : cut[-1]]
    return flat.reshape(len(column), -1)


def _even(x, longest):
    """Vectors with the component that gives all the same length."""
    rest = np.sqrt(np.maximum(longest - (x * x).sum(axis=1), 0))
    return np.concatenate([x, rest[:, None]], axis=1).astype(np.float32)


def _groups(batches, column):
    """Arrow tables of the rows with one value of ``column`` of a sorted stream."""
    held, last = [], None
    for batch in batches:
        v = batch.column(column).to_numpy()
        edges = np.append(np.flatnonzero(np.diff(v, prepend=v[:1] - 1)), len(v))
        for a, b in zip(edges, edges[1:]):
            if held and v[a] != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = v[a]
    if held:
        yield pa.Table.from_batches(held)


GRAPH = "shard long, kind int, layer int, node int, cid long, vector array<double>, near array<int>"


def _built(longest):
    def run(batches):
        for table in _groups(batches, "shard"):
            cid, x = table.column("cid").to_numpy(), _matrix(table.column("vector"))
            shard = table.column("shard")[0].as_py()
            layers = build(_even(x, longest), _level(cid))
            for number, layer in enumerate(layers):
                for a in range(0, len(layer.own), 4096):
                    own = layer.own[a : a + 4096]
                    vector = x[own] if number == 0 else [None] * len(own)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(own), shard)), pa.array(np.zeros(len(own), np.int32)), pa.array(np.full(len(own), number, np.int32)),
                         pa.array(np.arange(a, a + len(own), dtype=np.int32)), pa.array(cid[own]), pa.array(list(vector), pa.list_(pa.float64())),
                         pa.array(list(layer.near[a : a + 4096]), pa.list_(pa.int32()))],
                        names=["shard", "kind", "layer", "node", "cid", "vector", "near"])

    return run


def _searched(longest, k, width):
    """Index rows of a shard come first, then its queries; only the index is held."""

    def load(parts):
        table = pa.Table.from_batches(parts)
        number = table.column("layer").to_numpy()
        low = table.filter(pa.array(number == 0))
        cid, x = low.column("cid").to_numpy(), _matrix(low.column("vector"))
        row = {int(c): i for i, c in enumerate(cid)}
        even, layers = _even(x, longest), []
        for n in range(int(number.max()) + 1):
            part = table.filter(pa.array(number == n))
            layer = Layer(even, [row[int(c)] for c in part.column("cid").to_numpy()], LINKS if n else 2 * LINKS)
            near = part.column("near").combine_chunks()
            layer.near = np.asarray(near.values, np.int32)[near.offsets[0].as_py() :][: len(part) * layer.near.shape[1]].reshape(len(part), -1)
            layers.append(layer)
        return cid, x, layers

    def answer(index, batch):
        cid, x, layers = index
        q, own = _matrix(batch.column("vector")), batch.column("cid")
        for a in range(0, len(q), BLOCK):
            part = q[a : a + BLOCK]
            ids, sims = search(layers, np.concatenate([part, np.zeros((len(part), 1))], axis=1).astype(np.float32), max(width, k))
            score = np.where(np.isfinite(sims), (x[ids] * part[:, None, :]).sum(axis=2), -np.inf)
            best = np.lexsort((cid[ids], -score), axis=1)[:, :k]
            score, ids = np.take_along_axis(score, best, 1), np.take_along_axis(ids, best, 1)
            real = np.isfinite(score)
            who = np.repeat(np.arange(a, a + len(part)), real.sum(axis=1))
            yield pa.RecordBatch.from_arrays([own.take(pa.array(who)), pa.array(cid[ids[real]]), pa.array(score[real])], names=["query", "cid", "score"])

    def run(batches):
        parts, shard, index = [], None, None
        for batch in batches:
            v, kind = batch.column("shard").to_numpy(), batch.column("kind").to_numpy()
            edges = np.append(np.flatnonzero((np.diff(v, prepend=v[:1] - 1) != 0) | (np.diff(kind, prepend=kind[:1] - 1) != 0)), len(v))
            for a, b in zip(edges, edges[1:]):
                if v[a] != shard:
                    parts, shard, index = [], v[a], None
                if kind[a] == 0:
                    parts.append(batch.slice(a, b - a))
                elif parts or index:
                    index = index or load(parts)
                    parts = []
                    yield from answer(index, batch.slice(a, b - a))

    return run


def nearest(vectors, k=20, every=20, key="vec_id", vector="embedding", width=SEARCH_WIDTH):
    """The ``k`` nearest found by inner product for each query: query_id, rank (from 1), the neighbour's key and the exact ``score``.

    Queries are the rows whose key is divisible by ``every``; candidates are all
    rows but those with the query's own key, of its dimension.  Nearest first,
    ties to the smaller key.  Vectors that are null, empty, zero or hold null or
    non-finite components take no part; a repeated (key, vector) counts once.
    With fewer than ``k`` candidates all are returned.
    """
    v = F.transform(F.col(vector), lambda x: x.cast("double"))
    ok = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = vectors.select(F.col(key).alias("id"), v.alias("v")).where(F.col("id").isNotNull() & F.coalesce(ok, F.lit(False))).distinct()
    rows = stored(rows)
    nodes = rows.groupBy(F.col("v").alias("vector")).agg(F.min("id").alias("cid"))
    nodes = stored(nodes.withColumn("square", F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)))
    total = nodes.agg(F.count(F.lit(1)).alias("n"), F.max("square").alias("longest")).first()
    shards = max(LEAST_SHARDS, -(-total["n"] // SHARD_NODES))
    place = F.size("vector").cast("long") * shards + F.pmod(F.xxhash64("cid"), F.lit(shards))
    dealt = nodes.select(place.alias("shard"), "cid", "vector")
    longest = float(total["longest"] or 0.0)
    graph = stored(dealt.repartition(4 * shards, "shard").sortWithinPartitions("shard", "cid").mapInArrow(_built(longest), GRAPH))
    member = rows.join(nodes.select(F.col("vector").alias("v"), "cid"), "v").select("id", "cid")
    asked = member.where(F.col("id") % every == 0)
    to_ask = nodes.join(asked.select("cid").distinct(), "cid").select("cid", "vector")
    sent = to_ask.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("s"), "cid", "vector").select(
        (F.size("vector").cast("long") * shards + F.col("s")).alias("shard"), F.lit(1).alias("kind"), F.lit(0).alias("layer"), F.lit(0).alias("node"), "cid", "vector",
        F.lit(None).cast("array<int>").alias("near"))
    stream = graph.unionByName(sent).repartition(4 * shards, "shard").sortWithinPartitions("shard", "kind", "layer", "node")
    found = stream.mapInArrow(_searched(longest, k + 1, width), "query long, cid long, score double")
    best = W.partitionBy("query").orderBy(F.desc("score"), "cid")
    found = found.withColumn("r", F.row_number().over(best)).where(f"r <= {k + 1}").select("query", "cid", "score")
    first = member.withColumn("r", F.row_number().over(W.partitionBy("cid").orderBy("id"))).where(f"r <= {k + 1}").select("cid", "id")
    pairs = asked.select(F.col("id").alias("query_id"), F.col("cid").alias("query")).join(found, "query").join(first, "cid").where("id <> query_id")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return pairs.withColumn("rank", rank).where(f"rank <= {k}").select("query_id", "rank", F.col("id").alias(key), "score")
