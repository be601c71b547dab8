"""Best-fit packing with certified partitions.

Texts become token pieces (only the small rows travel, never the ids).  Pieces
are dealt evenly by a hash of their row number, each partition is packed by
best-fit decreasing, and dual feasible functions bound its bin count from
below.  Partitions above their bound hand out the pieces of their unfilled bins;
these are dealt anew into fewer partitions and packed again, as long as that
saves bins.
"""

import zlib
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from estimand.llm import tokens
from estimand.plans.prefix import stored

CAPACITY = 2048
#: Pieces of one partition: a few MB, and thousands of bins, so one unfilled bin in each weighs little.
PER_PARTITION = 32_768


def best_fit_decreasing(lengths, capacity):
    """Bin and offset of every item; lengths are 1..capacity.  Free room is looked up in one bit mask."""
    lengths = np.asarray(lengths, np.int64)
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    by_room = [[] for _ in range(capacity + 1)]
    mask, used = 0, 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        above = mask >> n
        if above:
            room = n + (above & -above).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                mask ^= 1 << room
        else:
            room, b, used = capacity, used, used + 1
        bins[i], offsets[i] = b, capacity - room
        room -= n
        if room:
            by_room[room].append(b)
            mask |= 1 << room
    return bins, offsets


def lower_bound(counts, capacity):
    """Least possible bin count for ``counts[length]`` items, by dual feasible functions in whole numbers.

    Families: the size itself; sizes with a threshold below which items vanish
    and above whose complement they fill a bin; Fekete and Schepers' rounding to
    k-ths; and unit shares of floor(capacity / threshold) for small items.
    """
    counts = np.asarray(counts, np.int64)
    x = np.arange(capacity + 1, dtype=np.int64)
    mass, number = np.cumsum(counts * x), np.cumsum(counts)
    best = -(-int(mass[-1]) // capacity)
    e = np.arange(1, capacity // 2 + 1)
    big = number[-1] - number[capacity - e]
    best = max(best, int((-(-(big * capacity + mass[capacity - e] - mass[e - 1]) // capacity)).max(initial=0)))
    for k in range(1, 51):
        part = (k + 1) * x
        value = np.where(part % capacity == 0, x * k, part // capacity * capacity)
        best = max(best, -(-int((counts * value).sum()) // (k * capacity)))
    held = np.flatnonzero(counts)
    for t in np.unique(np.concatenate([np.linspace(1, capacity // 2, 128).astype(int), held[held <= capacity // 2][:256]])):
        q = capacity // t
        value = np.where(2 * held > capacity, q - (capacity - held) // t, np.where(held >= t, 1, 0))
        best = max(best, -(-int((counts[held] * value).sum()) // q))
    return best


PIECE = "rid long, {key}, piece int, start long, length long, ids_crc32 long"


def pieces(docs, text="text", key="doc_id", tokenizer=None, capacity=CAPACITY, end_id=0):
    """One row for each piece of each row: ids of the text and then ``end_id``; the first piece of a long one takes the rest.

    A null text is empty and gives the end id alone.  ``rid`` numbers the rows
    within the run that made them, so store the result before using it.
    """
    kind = docs.schema[key].dataType.simpleString()
    schema = PIECE.format(key=f"`{key}` {kind}")

    def run(batches):
        from pyspark import TaskContext

        enc = tokens.encoder(tokenizer)
        rid = TaskContext.get().partitionId() << 36
        for batch in batches:
            texts, keys = batch.column(1), batch.column(0)
            for a, b in tokens.blocks(texts):
                ids, at = enc.block(texts.slice(a, b - a))
                full = np.insert(ids, at[1:], np.uint32(end_id)).astype("<u4")
                at = at + np.arange(b - a + 1)
                size = np.diff(at)
                count = -(-size // capacity)
                doc = np.repeat(np.arange(b - a), count)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
                first = size - capacity * (count - 1)
                start = np.where(piece > 0, first[doc] + (piece - 1) * capacity, 0)
                length = np.where(piece > 0, capacity, first[doc])
                begin = (at[doc] + start).tolist()
                crc = [zlib.crc32(full[i : i + n].data) for i, n in zip(begin, length.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rid + np.arange(len(doc))), keys.slice(a, b - a).take(pa.array(doc)), pa.array(piece.astype(np.int32)),
                     pa.array(start), pa.array(length), pa.array(crc, pa.int64())],
                    names=["rid", key, "piece", "start", "length", "ids_crc32"])
                rid += len(doc)

    return docs.select(F.col(key), F.col(text)).mapInArrow(run, schema)


def _packed(rows, round_no, parts, capacity):
    """Deal rows into ``parts`` partitions and pack each; adds sequence_id, offset, fill, bins and bound."""
    cols = [f for f in rows.schema.fields]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cols) + ", slot long, sequence_id long, offset long, fill long, bins long, bound long"

    def pack(table):
        length = table.column("length").to_numpy()
        bins, offset = best_fit_decreasing(length, capacity)
        slot = table.column("slot")[0].as_py()
        used = int(bins.max()) + 1
        fill = np.bincount(bins, weights=length).astype(np.int64)
        bound = lower_bound(np.bincount(length, minlength=capacity + 1), capacity)
        more = {"sequence_id": ((round_no << 24 | slot) << 32) + bins, "offset": offset, "fill": fill[bins], "bins": np.full(len(bins), used), "bound": np.full(len(bins), bound)}
        for name, values in more.items():
            table = table.append_column(name, pa.array(values, pa.int64()))
        return table

    dealt = rows.withColumn("slot", F.pmod(F.xxhash64("rid", F.lit(round_no)), F.lit(parts)))
    return stored(dealt.groupBy("slot").applyInArrow(pack, schema))


def repack(rows, capacity=CAPACITY, per_partition=PER_PARTITION, min_gain=1e-4):
    """Pack stored rows (``rid`` unique, ``length`` 1..capacity): adds ``sequence_id``, ``offset`` and the partition's certificate.

    ``bins`` and ``bound`` are the bin count of the row's partition and its
    lower bound; equal values prove the partition optimal.  A further round runs
    while the last one saved more than ``min_gain`` of the bins it packed again.
    Rows may repeat; an empty table gives an empty result.
    """
    names = rows.columns
    total = rows.count()
    done = _packed(rows, 0, max(1, ceil(total / per_partition)), capacity)
    round_no = 0
    while total:
        loose = (F.col("bins") > F.col("bound")) & (F.col("fill") < capacity)
        out = done.where(loose).agg(F.count(F.lit(1)), F.countDistinct("sequence_id"), F.countDistinct("slot")).first()
        if not out[0] or out[2] == 1 and round_no:
            break
        round_no += 1
        again = _packed(done.where(loose).select(*names), round_no, max(1, ceil(out[0] / (4 * per_partition))), capacity)
        saved = out[1] - again.agg(F.countDistinct("sequence_id")).first()[0]
        if saved <= 0:
            break
        done = done.where(~loose).unionByName(again)
        if saved < min_gain * out[1]:
            break
    return done


def pack_documents(docs, text="text", key="doc_id", tokenizer=None, capacity=CAPACITY, end_id=0):
    """Sequences of at most ``capacity`` tokens for all rows of ``docs``: one row for each piece, with its place and certificate.

    Every row is packed, repeated ones too; columns other than ``text`` and ``key`` are not looked at.
    """
    return repack(stored(pieces(docs, text, key, tokenizer, capacity, end_id)), capacity).drop("rid", "slot", "fill")
