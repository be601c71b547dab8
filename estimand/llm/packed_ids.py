"""Packed token-id matrices.

Each task tokenizes its rows and packs them in windows of bounded size, so no
ids are shuffled: best-fit decreasing with a segment tree over free room finds
the fullest row that still takes a piece.  Rows that stay below the wanted fill
are opened again for the next window.  Overlong documents are cut without loss.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from estimand.llm import tokens

CAPACITY = 2048
#: Tokens that a task packs together.
WINDOW_TOKENS = 4 << 20
WANTED_FILL = 0.995


class RoomTree:
    """Segment tree over free room 0..capacity: leaf r counts the open rows with room r, inner nodes the rows below."""

    def __init__(self, capacity):
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)

    def add(self, room, by):
        at = self.size + room
        while at:
            self.count[at] += by
            at >>= 1

    def least(self, need):
        """Smallest room of at least ``need`` that some row has, or -1."""
        at = self.size + need
        if self.count[at]:
            return need
        while at > 1:
            if not at & 1 and self.count[at + 1]:
                at += 1
                while at < self.size:
                    at = 2 * at if self.count[2 * at] else 2 * at + 1
                return at - self.size
            at >>= 1
        return -1


def pack_window(lengths, capacity):
    """Lists of item numbers, one for each row, by best-fit decreasing."""
    tree, by_room, rows = RoomTree(capacity), {}, []
    for i in np.argsort(-np.asarray(lengths), kind="stable").tolist():
        n = int(lengths[i])
        room = tree.least(n)
        if room < 0:
            row, room = len(rows), capacity
            rows.append([])
        else:
            row = by_room[room].pop()
            tree.add(room, -1)
        rows[row].append(i)
        room -= n
        if room:
            by_room.setdefault(room, []).append(row)
            tree.add(room, 1)
    return rows


def pack_ids(docs, text="text", key="doc_id", tokenizer=None, capacity=CAPACITY, end_id=0, pad_id=0, window=WINDOW_TOKENS, wanted=WANTED_FILL):
    """One row for each packed sequence.

    ``ids``: ``capacity`` ids as little-endian uint16 (uint32 for vocabularies
    beyond 65,536), padded with ``pad_id`` after ``n_tokens``; ``cu_seqlens``:
    0 and the end of every segment; ``position_starts``: the position in its
    document at which a segment's positions begin (0 but for the later pieces
    of a cut document); ``keys`` and ``pieces`` say what the segments are.  A null
    text is the end id alone; an empty table gives no rows; repeated rows are all
    packed.  ``sequence_id`` is unique in one run: store the result to refer to it.
    """
    kind = docs.schema[key].dataType.simpleString()
    schema = f"sequence_id long, n_tokens int, keys array<{kind}>, pieces array<int>, cu_seqlens array<int>, position_starts array<int>, ids binary, ids_crc32 long"

    def run(batches):
        from pyspark import TaskContext

        enc = tokens.encoder(tokenizer)
        width = "<u2" if enc.model.get_vocab_size() <= 1 << 16 else "<u4"
        serial = TaskContext.get().partitionId() << 36
        held, size = [], 0  # (key, piece, start, ids)

        def flush(last):
            nonlocal held, size, serial
            rows = pack_window([len(x[3]) for x in held], capacity)
            full = [r for r in rows if last or sum(len(held[i][3]) for i in r) >= wanted * capacity]
            out = [[], [], [], [], [], [], []]
            for r in full:
                ids = np.full(capacity, pad_id, width)
                ends = np.cumsum([len(held[i][3]) for i in r]).tolist()
                ids[: ends[-1]] = np.concatenate([held[i][3] for i in r])
                raw = ids.tobytes()
                for column, value in zip(out, (ends[-1], [held[i][0] for i in r], [held[i][1] for i in r], [0, *ends], [held[i][2] for i in r], raw, zlib.crc32(raw))):
                    column.append(value)
            gone = {i for r in full for i in r}
            held = [x for i, x in enumerate(held) if i not in gone]
            size = sum(len(x[3]) for x in held)
            serial += len(full)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.arange(serial - len(full), serial)), pa.array(out[0], pa.int32()), pa.array(out[1], pa.list_(key_type)),
                 *[pa.array(c, pa.list_(pa.int32())) for c in out[2:5]], pa.array(out[5], pa.binary()), pa.array(out[6], pa.int64())],
                names=["sequence_id", "n_tokens", "keys", "pieces", "cu_seqlens", "position_starts", "ids", "ids_crc32"])

        key_type = None
        for batch in batches:
            key_type = batch.column(0).type
            texts, keys = batch.column(1), batch.column(0).to_pylist()
            for a, b in tokens.blocks(texts):
                flat, at = enc.block(texts.slice(a, b - a))
                for i in range(b - a):
                    ids = np.append(flat[at[i] : at[i + 1]], end_id).astype(width)
                    for piece, start in enumerate(range(0, len(ids), capacity)):
                        cut = ids[start : start + capacity]
                        held.append((keys[a + i], piece, start, cut))
                        size += len(cut)
                    if size >= window:
                        yield flush(False)
                        if size > window // 2:
                            yield flush(True)
        if held:
            yield flush(True)

    return docs.select(F.col(key), F.col(text)).mapInArrow(run, schema)


def write_matrices(packed, path):
    """Write packed rows as Parquet: the ids of each file's rows form a matrix of fixed width."""
    packed.write.mode("errorifexists").parquet(path)


def positions(cu_seqlens, position_starts, capacity=CAPACITY):
    """Position of every token of one row: counted from each segment's start; 0 on padding."""
    out = np.zeros(capacity, np.int32)
    for a, b, start in zip(cu_seqlens, cu_seqlens[1:], position_starts):
        out[a:b] = np.arange(start, start + b - a)
    return out


def unpack(packed, key="doc_id", width="<u2"):
    """The token ids of every document again (end id included), from the packed rows: (key, ids as uint32 bytes).

    Pieces of one document are put together in order; meant for checks, the pieces of a document meet in one task.
    """
    kind = packed.schema["keys"].dataType.elementType.simpleString()

    def cut(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], width)
                for k, p, a, b in zip(row["keys"], row["pieces"], row["cu_seqlens"], row["cu_seqlens"][1:]):
                    made = [{key: k, "piece": p, "ids": ids[a:b].astype("<u4").tobytes()}]
                    yield pa.RecordBatch.from_pylist(made, pa.schema([(key, batch.schema.field("keys").type.value_type), ("piece", pa.int32()), ("ids", pa.binary())]))

    parts = packed.select("keys", "pieces", "cu_seqlens", "ids").mapInArrow(cut, f"`{key}` {kind}, piece int, ids binary")
    joined = F.array_sort(F.collect_list(F.struct("piece", "ids")))
    return parts.groupBy(key).agg(joined.alias("parts")).select(key, F.aggregate("parts", F.lit(b"").cast("binary"), lambda s, x: F.concat(s, x["ids"])).alias("ids"))
