"""Removal of byte strings that start at two places or more, by bucket-pointer refinement.

Sorting every suffix of a corpus would move a row for each byte.  Here a suffix
is first named by the bucket of a q-gram inside it, and only buckets that hold
two suffixes go on:

1. The q-gram of a window (a string of ``window`` bytes) is the one with the
   least hash among all q-grams of the window, the first of equal ones.  Equal
   windows have it at the same offset; consecutive windows share it.
2. Windows of one q-gram fall into pieces by their offset to it.  All windows of
   a piece hold the bytes around the q-gram that the offsets allow (the core).
   A piece carries the bucket identifiers of its core and of its whole range,
   both made of the identifiers of shorter ranges (prefix sums at later offsets).
3. Buckets are sorted and counted.  A range met twice settles all windows of the
   piece at once.  A core met once ends its windows.  A core that holds a range met
   once is refined: the same is done with shorter pieces of its ranges (one of each
   bucket of equal ranges is enough), down to single windows.

Each round reuses the buckets of the rounds before it, so a row is made only for
pieces that are still open.  A bucket is never gathered: identifiers are counted
with map-side combination and joined back, so a passage in a third of all texts
is one row a task.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from estimand.llm import words
from estimand.llm.bitmap import bitmap, inside
from estimand.plans.prefix import release, stored

WINDOW, QGRAM = 400, 32
#: Windows of a piece in each round.
PIECES = (64, 8, 1)
#: Bytes handled together, so that a block's arrays stay in the cache; a longer text goes on in a further block that overlaps by a window.
BLOCK_BYTES = 128 << 10
_PLACE = (1 << 24) - 1
_BASE2 = 0x8CB92BA72F3D8DD7


class Suffixes:
    """Windows of a block: ``start`` (place in the block) and ``anchor``, the place of its q-gram."""

    def __init__(self, data, at, window, q):
        self.window, self.span = window, window - q + 1
        values = words._VALUES[data]
        self.one, self.values = words.Sums(values, words._BASE), values
        n = len(data)
        left = np.repeat(at[1:], np.diff(at)) - np.arange(n)
        self.start = np.flatnonzero(left >= window)
        self.q, self.two = q, None
        if not len(self.start):
            self.anchor = self.start
            return
        low = words.mix((self.one.sums[q:] - self.one.sums[:-q]) * self.one.down[: n - q + 1])
        low &= ~np.uint64(_PLACE)
        low |= np.arange(n - q + 1, dtype=np.uint64)
        width = 1
        while 2 * width <= self.span:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        rest = self.span - width
        low = np.minimum(low[: len(low) - rest], low[rest:])[self.start]
        self.anchor = (low & np.uint64(_PLACE)).astype(np.int64)

    def keep(self, rows):
        self.start, self.anchor = self.start[rows], self.anchor[rows]

    def cut(self, size):
        """(index of the first window, number of windows, core's place in the order of offsets) of the pieces of at most ``size`` offsets."""
        if not len(self.start):
            return self.start, self.start, self.start
        part = (self.anchor - self.start) // size
        new = np.flatnonzero((np.diff(self.anchor, prepend=-1) != 0) | (np.diff(part, prepend=-1) != 0) | (np.diff(self.start, prepend=-2) != 1))
        return new, np.diff(np.append(new, len(self.start))), part[new]

    def buckets(self):
        """(index of the first window, number, identifier) of the runs of windows that share a q-gram."""
        new, count, _ = self.cut(self.window)
        a = self.anchor[new]
        return new, count, words.mix(self.one.of(a, a + self.q) + np.uint64(0x51))

    def ranges(self, new, count):
        """First identifier of the whole ranges of pieces."""
        first = self.start[new]
        return words.mix(self.one.of(first, first + count - 1 + self.window) + count.astype(np.uint64))

    def second(self, new, count):
        if self.two is None:
            self.two = words.Sums(self.values, _BASE2)
        first = self.start[new]
        return words.mix(self.two.of(first, first + count - 1 + self.window) + count.astype(np.uint64))

    def cores(self, new, part, size):
        a, low = self.anchor[new], part * size
        high = np.minimum(low + size - 1, self.span - 1)
        return words.mix(self.one.of(a - low, a - high + self.window) + (part + 7).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _blocks(batch, window):
    """(bytes, text bounds, row of each text, place of the block in its text) of blocks of bounded size."""
    done = 0
    for part in words.blocks(batch, limit=BLOCK_BYTES):
        texts = part.column("text").cast(pa.large_binary()).fill_null(b"")
        n = len(texts)
        at = np.frombuffer(texts.buffers()[1], np.int64, n + 1, texts.offset * 8)
        raw = texts.buffers()[2]
        data = np.frombuffer(raw, np.uint8)[at[0] : at[-1]] if raw is not None else np.zeros(0, np.uint8)
        at = at - at[0]
        if n == 1 and len(data) > BLOCK_BYTES + window:
            for start in range(0, len(data) - window + 1, BLOCK_BYTES):
                own = data[start : start + BLOCK_BYTES + window - 1]
                yield own, np.array([0, len(own)]), np.array([done]), start
        else:
            yield data, at, np.arange(done, done + n), 0
        done += n


def _open(s, filters, name):
    """Leave the windows whose q-gram bucket and pieces of all rounds so far are open; ``name`` gives the first hash of a window's text and its place there."""
    first, count, bucket = s.buckets()
    s.keep(np.repeat(inside(*filters[0], bucket), count) if len(first) else slice(0))
    for size, wanted, cores in filters[1:]:
        if not len(s.start):
            return
        new, count, part = s.cut(size)
        d1, place = name(s.start[new])
        own = s.ranges(new, count) ^ d1.view(np.uint64) ^ place.view(np.uint64)
        s.keep(np.repeat(inside(*wanted, own) & inside(*cores, s.cores(new, part, size)), count))


def _value(filters):
    """Arrays of the broadcast bitmaps."""
    if not filters:
        return []
    (words0, shift0), *rest = filters
    return [(words0.value, shift0), *[(size, (o.value, a), (c.value, b)) for size, (o, a), (c, b) in rest]]


def _buckets(rows, window, q):
    def run(batches):
        for batch in batches:
            for data, at, _, _ in _blocks(batch, window):
                found = Suffixes(data, at, window, q).buckets()[2]
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], names=["bucket"])

    return rows.select("text").mapInArrow(run, "bucket long").groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket")


def _pieces(rows, window, q, size, filters):
    """(d1, d2, start, n, core, h1, h2, c): the open pieces of every distinct text, ``c`` times in the corpus."""
    last = size == 1

    def run(batches):
        opened = _value(filters)
        for batch in batches:
            first = batch.column("d1").to_numpy()
            for data, at, row, offset in _blocks(batch, window):
                s = Suffixes(data, at, window, q)

                def name(start):
                    text = np.searchsorted(at, start, "right") - 1
                    return first[row[text]], start - at[text] + offset

                _open(s, opened, name)
                new, count, part = s.cut(size)
                h1, h2 = s.ranges(new, count), s.second(new, count)
                core = h1 if last else s.cores(new, part, size)
                text = np.searchsorted(at, s.start[new], "right") - 1
                take = pa.array(row[text] if len(new) else new)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("d1").take(take), batch.column("d2").take(take), pa.array(s.start[new] - at[text] + offset), pa.array(count),
                     *(pa.array(x.view(np.int64)) for x in (core, h1, h2))], names=["d1", "d2", "start", "n", "core", "h1", "h2"])

    made = rows.select("d1", "d2", "text").mapInArrow(run, "d1 long, d2 long, start long, n long, core long, h1 long, h2 long")
    return made.groupBy(*made.columns).agg(F.count(F.lit(1)).alias("c"))


def repeated_windows(rows, window=WINDOW, q=QGRAM, pieces=PIECES):
    """(d1, d2, start, n): runs of n windows of the text (d1, d2), from byte ``start``, that also start elsewhere.

    ``rows`` holds d1, d2 (two hashes of the text) and text.  The last of
    ``pieces`` is 1.  Returns stored tables as a list.
    """
    buckets = stored(_buckets(rows, window, q))
    filters, found = [bitmap(buckets, "bucket")], []
    release(buckets)
    for size in pieces:
        made = stored(_pieces(rows, window, q, size, filters))
        own = F.struct("d1", "d2", "start")
        # a table of its own, so that the join may split the rows of a range that many texts share
        twice = stored(made.groupBy("h1", "h2").agg(F.sum("c").alias("m"), F.min(own).alias("one")).where("m > 1").select("h1", "h2", "one"))
        told = made.join(twice, ["h1", "h2"], "left").withColumns({"again": F.col("one").isNotNull(), "one": F.coalesce(F.col("one") == own, F.lit(True))})
        told = stored(told.select("d1", "d2", "start", "n", "core", "h1", "c", "again", "one"))
        found.append(told)
        if size > 1:
            # refined: cores that hold a piece met once; of pieces met twice, one stays as the partner of shorter ranges
            cores = stored(told.groupBy("core").agg(F.sum("c").alias("m"), F.min("again").alias("settled")).where("m > 1 and not settled").select("core"))
            wanted = told.where("one").select(F.col("h1").bitwiseXOR(F.col("d1")).bitwiseXOR(F.col("start")).alias("piece"))
            filters.append((size, bitmap(wanted, "piece"), bitmap(cores, "core")))
            release(cores)
        release(made, twice)
    return [x.where("again").select("d1", "d2", "start", "n") for x in found]


def _cut(window):
    def run(batches):
        for batch in batches:
            texts, spans = batch.column("text").cast(pa.large_binary()).fill_null(b""), batch.column("spans")
            cut = np.asarray(spans.offsets, np.int64) - spans.offsets[0].as_py()
            found = spans.flatten()
            starts, counts = found.field("start").to_numpy(), found.field("n").to_numpy()
            size, removed, runs, kept = [], [], [], []
            for i, (x, y) in enumerate(zip(cut.tolist(), cut[1:].tolist())):
                text = texts[i].as_buffer()
                size.append(text.size)
                if x == y:
                    removed.append(0)
                    runs.append(0)
                    kept.append(text.to_pybytes())
                    continue
                order = x + np.argsort(starts[x:y], kind="stable")
                start = starts[order]
                end = np.maximum.accumulate(start + counts[order] - 1 + window)
                new = np.flatnonzero(np.append(True, start[1:] > end[:-1]))
                a, b = start[new], end[np.append(new[1:], len(start)) - 1]
                removed.append(int((b - a).sum()))
                runs.append(len(a))
                view = memoryview(text)
                kept.append(b"".join([view[p:q] for p, q in zip([0, *b.tolist()], [*a.tolist(), text.size])]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), *(pa.array(x, pa.int64()) for x in (size, removed, runs)), pa.array(kept, pa.binary())], names=["key", "n_bytes", "n_removed", "n_spans", "kept"])

    return run


def remove_repeats(docs, text="text", key="doc_id", window=WINDOW, q=QGRAM, pieces=PIECES):
    """One row for each row of ``docs``: key, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs) and ``kept`` (the other bytes, binary).

    A byte goes if a string of ``window`` bytes over it also starts elsewhere:
    in another row, in an equal one too, or at another place of the same text.
    Strings never cross rows and are those of the input.  A null text is empty;
    texts shorter than a window stay whole; keys may be null or repeated, since
    texts are found again by two 64-bit hashes of their content.
    """
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.select("key", "text", F.xxhash64("text").alias("d1"), F.xxhash64(F.lit(1), F.col("text")).alias("d2"))
    first, *rest = repeated_windows(rows, window, q, pieces)
    for more in rest:
        first = first.unionByName(more)
    spans = first.groupBy("d1", "d2").agg(F.collect_list(F.struct("start", "n")).alias("spans"))
    cut = rows.join(spans, ["d1", "d2"], "left").select("key", "text", "spans").mapInArrow(
        _cut(window), f"key {kind}, n_bytes long, n_removed long, n_spans long, kept binary")
    return cut.withColumnRenamed("key", key)
