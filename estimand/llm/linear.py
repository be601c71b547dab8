"""Sparse linear models trained by follow-the-regularised-leader updates, in shards whose states are averaged.

The sample is dealt into shards of a few thousand rows; in every round each shard
makes one pass from the common state and returns what it changed; each coordinate
moves by the mean change over the shards that touched it.  The state has a fixed size (the hashed
dimension), so it may go through the driver; rows never do.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from estimand.llm import words
from estimand.plans.prefix import stored

BITS = 18
SHARD_ROWS = 5_000
#: Bytes of text whose features are made together (some 200 bytes of working memory each).
FEATURE_BYTES = 256 << 10


def hashed(h, salt, bits=BITS):
    """Feature numbers 1 .. 2^bits - 1 of uint64 hashes; 0 is the constant feature."""
    dim = np.uint64((1 << bits) - 1)
    return (words.mix(h ^ np.uint64(salt * 0x9E3779B1 + 1)) % dim).astype(np.int64) + 1


def merged(text, feature, value, rows, bits=BITS):
    """Offsets, features and summed values: each feature once a text, the constant first."""
    code = np.concatenate([np.arange(rows) << bits, (text << bits) | feature])
    weight = np.concatenate([np.ones(rows), value])
    order = np.argsort(code, kind="stable")
    code, weight = code[order], weight[order]
    first = np.flatnonzero(np.diff(code, prepend=-1))
    sums = np.add.reduceat(weight, first) if len(first) else weight
    code = code[first]
    return np.searchsorted(code, np.arange(rows + 1) << bits), code & ((1 << bits) - 1), sums


class Ftrl:
    """State of per-coordinate FTRL-proximal: ``z``, ``n`` and free parameters ``extra`` with their gradient squares."""

    def __init__(self, dim, extra=(), alpha=0.5, beta=1.0, l1=0.0, l2=1e-3):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros(dim), np.zeros(dim)
        self.extra, self.squares = np.array(extra, float), np.ones(len(extra))

    def weights(self, at=slice(None)):
        z = self.z[at]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def update(self, at, x, slope, extra_slope=None):
        """One example: ``slope`` is the loss gradient by the linear score."""
        w, g = self.weights(at), slope * x
        new = self.n[at] + g * g
        self.z[at] += g - (np.sqrt(new) - np.sqrt(self.n[at])) / self.alpha * w
        self.n[at] = new
        if extra_slope is not None:
            self.squares += extra_slope**2
            self.extra -= 0.3 * extra_slope / np.sqrt(self.squares)

    def packed(self):
        return np.concatenate([self.z, self.n, self.extra, self.squares])

    def unpack(self, flat):
        d, k = len(self.z), len(self.extra)
        self.z, self.n, self.extra, self.squares = (x.copy() for x in np.split(flat, [d, 2 * d, 2 * d + k]))
        return self


def logistic_step(state, y, at, x):
    p = 1 / (1 + np.exp(-np.clip(state.weights(at) @ x, -35, 35)))
    state.update(at, x, p - y)


def trained(shards, state, step, rounds=4):
    """Fit ``state`` to stored shards; ``step(state, y, at, x)`` makes one update.  Nothing is shuffled but the changes."""
    sc = shards.sparkSession.sparkContext
    for r in range(rounds):
        common = sc.broadcast(state.packed())
        change = shards.mapInArrow(_shard(state, step, common, r), "i long, d double").groupBy("i").agg(F.avg("d").alias("d")).toArrow()
        flat = state.packed()
        flat[change.column("i").to_numpy()] += change.column("d").to_numpy()
        state.unpack(flat)
        common.unpersist()
    return state


def _shard(state, step, common, round_no):
    """One pass over a shard from the common state: the coordinates it changed."""

    def run(batches):
        for shard in (row for batch in batches for row in batch.to_pylist()):
            own = _like(state, common.value)
            y, cut = np.frombuffer(shard["y"]), np.frombuffer(shard["cut"], np.int64)
            at, x = np.frombuffer(shard["at"], np.int32), np.frombuffer(shard["x"], np.float32)
            for i in np.random.default_rng(round_no).permutation(len(y)):
                step(own, y[i], at[cut[i] : cut[i + 1]], x[cut[i] : cut[i + 1]])
            change = own.packed() - common.value
            moved = np.flatnonzero(change)
            yield pa.RecordBatch.from_arrays([pa.array(moved), pa.array(change[moved])], names=["i", "d"])

    return run


def _like(state, flat):
    own = Ftrl(0, alpha=state.alpha, beta=state.beta, l1=state.l1, l2=state.l2)
    own.z, own.extra = state.z, state.extra
    return own.unpack(flat)


def labelled(docs, labels, label, bound, text="text", key="doc_id"):
    """At most ``bound`` labelled rows (row_hash, text, y), those of the smallest hash of the key; rows held out are never among them.

    Held out: CRC-32 of the key as text, modulo 4, is 2.  Rows without a text, a label or a key are left out.
    """
    chosen = labels.select(F.col(key).alias("_key"), F.col(label).cast("double").alias("y")).where(~held_out("_key") & F.col("y").isNotNull())
    chosen = chosen.groupBy("_key").agg(F.max("y").alias("y")).orderBy(F.xxhash64("_key"), "_key").limit(bound)
    found = docs.select(F.col(key).alias("_key"), F.col(text).alias("text")).where("text is not null").join(F.broadcast(chosen), "_key")
    return found.groupBy("_key").agg(F.min("text").alias("text"), F.first("y").alias("y")).select(F.xxhash64("_key").alias("row_hash"), "text", "y")


def held_out(key):
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def featurised(sample, features):
    """Stored shards of a bounded sample (row_hash, text, y), a row each: labels, offsets, features and values as packed numbers.

    ``features(texts)`` gives offsets, feature numbers and values.
    """
    shards = max(1, round(sample.count() / SHARD_ROWS))

    def run(batches):
        for batch in batches:
            for part in words.blocks(batch, limit=FEATURE_BYTES):
                cut, at, x = features(part.column("text"))
                at, x = at.astype(np.int32), x.astype(np.float32)
                yield pa.RecordBatch.from_arrays(
                    [part.column("row_hash"), part.column("y"), *(pa.array([v[a:b].tobytes() for a, b in zip(cut, cut[1:])], pa.binary()) for v in (at, x))],
                    names=["row_hash", "y", "at", "x"])

    def gather(table):
        table = table.sort_by("row_hash")
        at = table.column("at").to_pylist()
        cut = np.cumsum([0, *(len(a) // 4 for a in at)])
        return pa.table({"y": [table.column("y").to_numpy().astype(float).tobytes()], "cut": [cut.astype(np.int64).tobytes()],
                         "at": pa.array([b"".join(at)], pa.binary()), "x": pa.array([b"".join(table.column("x").to_pylist())], pa.binary())})

    rows = sample.mapInArrow(run, "row_hash long, y double, at binary, x binary").withColumn("shard", F.pmod("row_hash", F.lit(shards)))
    return stored(rows.groupBy("shard").applyInArrow(gather, "y binary, cut binary, at binary, x binary"))


def scored(docs, text, keep, features, weights, outputs, finish):
    """``keep`` columns and the columns that ``finish(scores)`` makes from the sparse dot products of all rows.

    ``outputs`` is their schema; the weights are broadcast (fixed size).  A text among ``keep`` is sent once.
    """
    sent = docs.sparkSession.sparkContext.broadcast(weights)
    fields = {f.name: f for f in docs.schema.fields}
    own = text if text in keep else "_text"
    schema = ", ".join(f"`{c}` {fields[c].dataType.simpleString()}" for c in keep) + ", " + outputs

    def run(batches):
        for batch in batches:
            for part in words.blocks(batch, own, FEATURE_BYTES):
                cut, at, x = features(part.column(own))
                dot = np.add.reduceat(sent.value[at] * x, cut[:-1]) if part.num_rows else np.zeros(0)
                made = finish(dot)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), *(pa.array(v) for v in made.values())], names=[*keep, *made])

    sources = [F.col(c) for c in keep] + [F.col(text).alias("_text")] * (text not in keep)
    return docs.select(*sources).mapInArrow(run, schema)
