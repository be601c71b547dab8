"""Removal of word windows that also start in an earlier document, by super-k-mer partitioning.

A window's minimiser is the least hash among the short word runs inside it.
Consecutive windows with one minimiser form a super-k-mer.

1. Every super-k-mer sends its minimiser and document id: minimisers of a single
   document can't hold a repeated window.
2. The other super-k-mers travel as packed strings to the bucket of their
   minimiser; equal strings are one row with the smallest document id.
3. A bucket sorts its windows and finds the smallest id of each.  A bucket too
   large for one task is split by window instead.
4. Windows with a smaller id elsewhere go back to their documents as word spans.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from estimand.llm import words
from estimand.llm.bitmap import bitmap, inside
from estimand.plans.prefix import stored

WINDOW, SEED = 50, 10
#: Windows of one super-k-mer at most; a longer one goes on in a further row of the same bucket.
MOST_WINDOWS = 512
#: Distinct strings of a bucket that one task sorts at most; larger buckets are split by window.
BUCKET_ROWS = 4096
CHUNK_BYTES = 4 << 20


def _super_kmers(w, size, seed):
    """(first window, number of windows, minimiser, text) of every super-k-mer; a window has the number of its first word.

    Least hashes are small numbers, so minimisers are mixed again to fill the range of the bitmap evenly.
    """
    n = len(w)
    first = w.windows(size)
    if not len(first):
        none = np.zeros(0, np.int64)
        return none, none, none.astype(np.uint64), none
    low = np.full(n, np.iinfo(np.uint64).max, np.uint64)
    at = np.arange(n - seed + 1)
    low[at] = w.run_hash(at, at + seed)
    span, width = size - seed + 1, 1
    while 2 * width <= span:
        low[: n - width] = np.minimum(low[: n - width], low[width:])
        width *= 2
    low = np.minimum(low[first], low[np.minimum(first + span - width, n - 1)])
    text = w.text[first]
    new = np.flatnonzero((np.diff(low.view(np.int64), prepend=~low[:1].view(np.int64)) != 0) | (np.diff(text, prepend=-1) != 0))
    count = np.diff(np.append(new, len(first)))
    cuts = -(-count // MOST_WINDOWS)
    start = np.repeat(new, cuts) + (np.arange(cuts.sum()) - np.repeat(np.cumsum(cuts) - cuts, cuts)) * MOST_WINDOWS
    count = np.diff(np.append(start, len(first)))
    return first[start], count, words.mix(low[start]), text[start]


def _minimisers(rows, size, seed):
    kind = rows.schema["key"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for part in words.blocks(batch):
                _, _, low, text = _super_kmers(words.Words(part.column("text")), size, seed)
                yield pa.RecordBatch.from_arrays([pa.array(low.view(np.int64)), part.column("key").take(pa.array(text))], names=["minimiser", "key"])

    return rows.select("key", "text").mapInArrow(run, f"minimiser long, key {kind}")


def _packed(rows, size, seed, filled, shift):
    """Rows of super-k-mers whose minimiser is in the bitmap; ``packed`` holds their words, s1 and s2 its hash."""
    kind = rows.schema["key"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for part in words.blocks(batch):
                w = words.Words(part.column("text"))
                first, count, low, text = _super_kmers(w, size, seed)
                hit = np.flatnonzero(inside(filled.value, shift, low)) if len(low) else np.zeros(0, np.int64)
                first, count, low, text = first[hit], count[hit], low[hit], text[hit]
                last = first + count + size - 1
                s1, s2 = (w.run_hash(first, last, s).view(np.int64) for s in words.STEPS)
                packed = [w.joined(a, b) for a, b in zip(first.tolist(), last.tolist())]
                take = pa.array(text)
                yield pa.RecordBatch.from_arrays(
                    [part.column("key").take(take), part.column("digest").take(take), pa.array(low.view(np.int64)), pa.array(s1), pa.array(s2),
                     pa.array(first - w.bounds[text]), pa.array(packed, pa.binary())],
                    names=["key", "digest", "minimiser", "s1", "s2", "first", "packed"])

    return rows.select("key", "digest", "text").mapInArrow(
        run, f"key {kind}, digest long, minimiser long, s1 long, s2 long, first long, packed binary")


def _windows(packed, size):
    """(row, number in the row, h1, h2) of all windows of packed strings."""
    w = words.Words(packed.cast(pa.large_binary()).cast(pa.large_string(), safe=False))
    first = w.windows(size)
    row = w.text[first]
    return row, first - w.bounds[row], *(w.run_hash(first, first + size, s) for s in words.STEPS)


def _sorted_bucket(size):
    """Smallest key of every window among sorted strings: runs (a, b, low) of windows of each string."""

    def solve(table):
        row, number, h1, h2 = _windows(table.column("packed").combine_chunks(), size)
        key = table.column("low").to_numpy()[row]
        order = np.lexsort((h2, h1))
        new = np.flatnonzero((np.diff(h1[order].view(np.int64), prepend=~h1[order[:1]].view(np.int64)) != 0) | (np.diff(h2[order].view(np.int64), prepend=0) != 0))
        low = np.empty(len(row), np.int64)
        low[order] = np.repeat(np.minimum.reduceat(key[order], new), np.diff(np.append(new, len(row))))
        start = np.flatnonzero((np.diff(row, prepend=-1) != 0) | (np.diff(low, prepend=0) != 0))
        end = np.append(start[1:], len(row))
        n = number[end - 1] + 1
        take = pa.array(row[start])
        return pa.RecordBatch.from_arrays(
            [table.column("s1").combine_chunks().take(take), table.column("s2").combine_chunks().take(take), pa.array(number[start]), pa.array(n), pa.array(low[start])],
            names=["s1", "s2", "a", "b", "low"])

    def run(batches):
        held, rows, size_held, last = [], 0, 0, None
        for batch in batches:
            m = batch.column("minimiser").to_numpy()
            edges = np.append(np.flatnonzero(np.diff(m, prepend=m[0] - 1 if len(m) else 0)), len(m))
            for a, b in zip(edges, edges[1:]):
                if size_held > CHUNK_BYTES and m[a] != last:
                    yield solve(pa.Table.from_batches(held))
                    held, size_held = [], 0
                part = batch.slice(a, b - a)
                held.append(part)
                size_held += int(np.diff(np.frombuffer(part.column("packed").buffers()[1], np.int32, len(part) + 1, 4 * part.column("packed").offset)).sum())
                last = m[a]
        if held:
            yield solve(pa.Table.from_batches(held))

    return run


def _split_bucket(size):
    def run(batches):
        for batch in batches:
            for part in words.blocks(batch, "packed"):
                row, number, h1, h2 = _windows(part.column("packed"), size)
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c).take(take) for c in ("s1", "s2", "low")), pa.array(number), pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64))],
                    names=["s1", "s2", "low", "a", "h1", "h2"])

    return run


RUNS = "s1 long, s2 long, a long, b long, low long"


def repeated_spans(docs, text="text", key="doc_id", window=WINDOW, seed=SEED):
    """(key, digest, spans): word spans to remove from rows with that key and that ``xxhash64`` of the text.

    A span is covered by windows whose words also start in a row with a smaller
    key (a whole number).  Rows with a null key neither lose words nor make
    others lose them.
    """
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"), F.xxhash64(text).alias("digest")).where("key is not null and text is not null")
    shared = stored(_minimisers(rows, window, seed).groupBy("minimiser").agg(F.min("key").alias("lo"), F.max("key").alias("hi")).where("lo < hi").select("minimiser"))
    filled, shift = bitmap(shared, "minimiser")
    found = stored(_packed(rows, window, seed, filled, shift))
    strings = found.groupBy("minimiser", "s1", "s2").agg(F.min("key").alias("low"), F.min("packed").alias("packed"))
    strings = stored(strings)
    sizes = strings.groupBy("minimiser").agg(F.count(F.lit(1)).alias("n"), F.min("low").alias("lo"), F.max("low").alias("hi")).where("n > 1")
    large = stored(sizes.where(F.col("n") > BUCKET_ROWS).select("minimiser"))
    columns = ["minimiser", "s1", "s2", "low", "packed"]
    usual = strings.join(large, "minimiser", "left_anti").select(*columns)
    usual = usual.repartition("minimiser").sortWithinPartitions("minimiser", "s1", "s2").mapInArrow(_sorted_bucket(window), RUNS)
    split = strings.join(large, "minimiser", "left_semi").select(*columns).mapInArrow(
        _split_bucket(window), "s1 long, s2 long, low long, a long, h1 long, h2 long")
    least = split.groupBy("h1", "h2").agg(F.min("low").alias("least"))
    split = split.join(least, ["h1", "h2"]).select("s1", "s2", "a", (F.col("a") + 1).alias("b"), F.col("least").alias("low"))
    runs = usual.unionByName(split)
    at = found.select("key", "digest", "s1", "s2", "first").join(runs, ["s1", "s2"]).where("low < key")
    spans = at.select("key", "digest", (F.col("first") + F.col("a")).alias("start"), (F.col("first") + F.col("b") + window - 1).alias("end")).distinct()
    return spans.groupBy("key", "digest").agg(F.collect_list(F.struct("start", "end")).alias("spans"))


def _cut(batches):
    for batch in batches:
        for part in words.blocks(batch):
            w = words.Words(part.column("text"))
            removed, kept = [], []
            spans = part.column("spans").to_pylist()
            for i, found in enumerate(spans):
                a, b = int(w.bounds[i]), int(w.bounds[i + 1])
                if not found:
                    removed.append(0)
                    kept.append(w.joined(a, b))
                    continue
                edge = np.zeros(b - a + 1, np.int64)
                np.add.at(edge, [s["start"] for s in found], 1)
                np.add.at(edge, [s["end"] for s in found], -1)
                gone = np.cumsum(edge[:-1]) > 0
                turn = np.flatnonzero(np.diff(gone, prepend=True, append=True)) + a
                removed.append(int(gone.sum()))
                kept.append(b" ".join(w.joined(x, y) for x, y in zip(turn[::2].tolist(), turn[1::2].tolist())))
            yield pa.RecordBatch.from_arrays(
                [part.column("key"), pa.array(np.diff(w.bounds)), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                names=["key", "n_words", "n_removed", "kept"])


def remove_repeats(docs, text="text", key="doc_id", window=WINDOW, seed=SEED):
    """One row for each row of ``docs``: key, ``n_words``, ``n_removed`` and ``kept``, the remaining words joined by one space.

    Each word goes that is covered by a window of ``window`` words whose sequence
    also starts in a row with a smaller key; windows are those of the input.  A
    null text has no words; texts shorter than a window stay whole; rows that share
    a key never remove each other's words.
    """
    spans = repeated_spans(docs, text, key, window, seed)
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"), F.xxhash64(text).alias("digest"))
    joined = rows.join(spans, ["key", "digest"], "left").select("key", "text", "spans")
    cut = joined.mapInArrow(_cut, "key long, n_words long, n_removed long, kept string")
    return cut.withColumnRenamed("key", key)
