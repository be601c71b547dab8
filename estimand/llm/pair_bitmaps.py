"""Alignment of two tokenizers over a corpus, by inverted bitmaps of id pairs.

1. Both tokenizers' tokens are put on the bytes of a text; places where tokens of
   both end cut them into groups, and every A token of a group is linked with
   every B token of it.
2. Documents get numbers in chunks.  For each id pair a chunk has bitmaps of its
   documents, one for each binary digit of the number of links (multiplicity
   planes): sorted 16-bit numbers, or one bit a document where that is shorter.
3. The planes of a pair are merged by OR and counted: the documents that hold it.
   The planes' own counts, times their digit, are its links.
4. Each posting takes its pair's scores back to its chunk, where documents add
   them up, digit by digit.

Only bitmaps are shuffled, never links or texts; a chunk has at most ``DOCS``
documents, so the memory for its sums is fixed.
"""

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from estimand.llm import tokens
from estimand.plans.prefix import release, stored

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Documents of a chunk at most, and bytes of text after which it ends.
DOCS, CHUNK_BYTES = 4096, 16 << 20
#: Bytes of text aligned together; a longer text is alone.
BLOCK_BYTES = 2 << 20
#: Links expanded at a time in groups of more than one pair.
SLICE = 4 << 20
COUNTS = ["n_a", "n_b", "n_groups", "n_links"]


def _flat(pieces):
    """(bytes of all strings, start of each, length of each)."""
    size = np.array([len(x) for x in pieces], np.int64)
    return np.frombuffer(b"".join(pieces), np.uint8), np.cumsum(size) - size, size


def _gather(table, rows):
    """The bytes of the given strings, one after the other."""
    flat, start, size = table
    count = size[rows]
    end = np.cumsum(count)
    return flat[np.repeat(start[rows] - (end - count), count) + np.arange(end[-1] if len(end) else 0)]


class ByteTokens(tokens.Encoder):
    """Ids of space + text; strings of special tokens are plain text."""

    def __init__(self, path=None):
        super().__init__(path or tokens.tokenizer_path(A_FILE))
        self.model.encode_special_tokens = True
        letters = [*range(33, 127), *range(161, 173), *range(174, 256)]  # the byte-level alphabet: these stand for themselves,
        rest = [b for b in range(256) if b not in letters]  # the others for the letters from 256 on
        byte = {chr(c): c for c in letters} | {chr(256 + i): b for i, b in enumerate(rest)}
        names = [self.model.id_to_token(i) for i in range(self.model.get_vocab_size())]
        self.bytes = _flat([bytes(byte[c] for c in x) if all(c in byte for c in x) else x.encode() for x in names])

    def whole(self, text):
        if self.fast is None:
            return np.asarray(self.model.encode(" " + text, add_special_tokens=False).ids, dtype=np.uint32)
        return np.asarray(self.fast.encode_ordinary(" " + text), dtype=np.uint32)


class PieceTokens(tokens.Encoder):
    """Ids of a text by a piece model that puts a space before it.

    No piece goes over a single space or line break between two visible
    characters, so such segments are encoded once (see ``tokens``).
    """

    def __init__(self, path=None):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path or tokens.tokenizer_path(B_FILE))
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.apart = not any("▁" in x.lstrip("▁") or "\n" in x for x in names)
        self.fast = self.model if self.apart else None
        hexed = lambda x: len(x) == 6 and x.startswith("<0x") and x.endswith(">")
        self.bytes = _flat([bytes([int(x[3:5], 16)]) if hexed(x) else x.replace("▁", " ").encode() for x in names])
        self.known = {}
        self.ids, self.starts = np.zeros(1 << 20, np.uint32), np.zeros(tokens.CACHE_ENTRIES + 1, np.int64)

    def whole(self, text):
        return np.asarray(self.model.encode(text), dtype=np.uint32)

    def _segments(self, segs):
        at = np.fromiter((self.known.get(s, -1) for s in segs), np.int64, len(segs))
        new, old = np.flatnonzero(at < 0), np.flatnonzero(at >= 0)
        # after a line break there is no space: the one that the model puts first goes
        found = [x[1:] if segs[i][0] == "\n" else x for i, x in zip(new.tolist(), self.model.encode([segs[i] for i in new], num_threads=1))]
        size = np.array([len(x) for x in found], np.int64)
        ids = np.fromiter((i for x in found for i in x), np.uint32, int(size.sum()))
        base = self.starts[len(self.known)]
        starts, lens = np.empty(len(segs), np.int64), np.empty(len(segs), np.int64)
        starts[old], lens[old] = self.starts[at[old]], self.starts[at[old] + 1] - self.starts[at[old]]
        ends = np.cumsum(size) + base
        starts[new], lens[new] = ends - size, size
        flat = np.concatenate([self.ids[:base], ids])
        keep = min(tokens.CACHE_ENTRIES - len(self.known), len(new))
        if keep:
            n = len(self.known)
            self.known.update(zip((segs[i] for i in new[:keep]), range(n, n + keep)))
            self.starts[n + 1 : n + keep + 1] = ends[:keep]
            self.ids = flat[: ends[keep - 1]]
        return flat, starts, lens


_PAIRS = {}


def _encoders(a_path, b_path):
    """Both encoders and the digits of ids with each separator, once for each worker process."""
    if (a_path, b_path) not in _PAIRS:
        a, b = ByteTokens(a_path), PieceTokens(b_path)
        n = max(len(a.bytes[1]), len(b.bytes[1]))
        _PAIRS[a_path, b_path] = a, b, n, _flat([f"{i}{sep}".encode() for sep in ",|;" for i in range(n)])
    return _PAIRS[a_path, b_path]


class Alignment:
    """Groups of a block of texts: for each, ``counts`` (rows: n_a, n_b, n_groups, n_links) and ``digest``."""

    def __init__(self, texts, a, b, limit, digits):
        texts = texts.cast(pa.large_string()).fill_null("")
        rows = len(texts)
        (ids_a, off_a), (ids_b, off_b) = a.block(texts), b.block(texts)
        size = np.asarray(pc.binary_length(texts), np.int64) + 1
        fits = size > 1
        for table, ids, off in ((a.bytes, ids_a, off_a), (b.bytes, ids_b, off_b)):
            spelled = np.concatenate([[0], np.cumsum(table[2][ids])])
            fits &= np.diff(spelled[off]) == size
        while True:  # once more if the bytes of a text of the right length differ
            own = pc.binary_join_element_wise(pa.scalar("", pa.large_string()), texts.filter(pa.array(fits)), pa.scalar(" ", pa.large_string()))
            raw = np.frombuffer(own.buffers()[2], np.uint8) if len(own) and own.buffers()[2] is not None else np.zeros(0, np.uint8)
            at = np.concatenate([[0], np.cumsum(size[fits])])
            keep_a, keep_b = ids_a[np.repeat(fits, np.diff(off_a))], ids_b[np.repeat(fits, np.diff(off_b))]
            wrong = np.zeros(len(raw), bool)
            for table, ids in ((a.bytes, keep_a), (b.bytes, keep_b)):
                wrong |= _gather(table, ids.astype(np.int64)) != raw
            if not wrong.any():
                break
            fits[np.flatnonzero(fits)[np.unique(np.searchsorted(at, np.flatnonzero(wrong), "right") - 1)]] = False
        self.a, self.b = keep_a.astype(np.int64), keep_b.astype(np.int64)
        end_a, end_b = np.cumsum(a.bytes[2][self.a]), np.cumsum(b.bytes[2][self.b])
        met = np.zeros(len(raw) + 1, bool)
        met[end_a] = True
        both = end_b[met[end_b]]
        before = np.zeros(len(raw) + 2, np.int64)
        before[both + 1] = 1
        before = np.cumsum(before)
        self.group_a, self.group_b = before[end_a], before[end_b]
        n = len(both)
        self.n_a, self.n_b = np.bincount(self.group_a, minlength=n), np.bincount(self.group_b, minlength=n)
        place = np.flatnonzero(fits)
        self.doc = place[np.searchsorted(at, both, "left") - 1] if n else both
        self.counts = np.zeros((4, rows), np.int64)
        for row, weights in zip(self.counts, (self.n_a, self.n_b, np.ones(n, np.int64), self.n_a * self.n_b)):
            np.add.at(row, self.doc, weights)
        self.digest = self._digests(rows, limit, digits)

    def _digests(self, rows, limit, digits):
        upto_a, upto_b = np.cumsum(self.n_a), np.cumsum(self.n_b)
        i, j = np.arange(len(self.a)), np.arange(len(self.b))
        order = np.empty(len(i) + len(j), np.int64)
        sep_a, sep_b = i + 1 == upto_a[self.group_a], (j + 1 == upto_b[self.group_b]) * 2
        order[i + (upto_b - self.n_b)[self.group_a]] = self.a + limit * sep_a
        order[j + upto_a[self.group_b]] = self.b + limit * sep_b
        text = _gather(digits, order).tobytes()
        ends = np.concatenate([[0], np.cumsum(digits[2][order])])[np.concatenate([[0], np.cumsum(self.counts[0] + self.counts[1])])]
        return [hashlib.sha256(text[x : y - 1]).hexdigest() if y > x else "" for x, y in zip(ends.tolist(), ends[1:].tolist())]

    def pairs(self, limit):
        """Blocks of (document, pair, links): pair is a * limit + b."""
        one = self.n_a * self.n_b == 1
        yield self.doc[one], self.a[one[self.group_a]] * limit + self.b[one[self.group_b]], np.ones(int(one.sum()), np.int64)
        more_a, more_b = ~one[self.group_a], ~one[self.group_b]
        key_a, many_a = np.unique(self.group_a[more_a] * limit + self.a[more_a], return_counts=True)
        key_b, many_b = np.unique(self.group_b[more_b] * limit + self.b[more_b], return_counts=True)
        group, first = key_a // limit, np.searchsorted(key_b // limit, np.arange(len(one) + 1))
        fan = np.diff(first)[group]
        upto = np.cumsum(fan)
        start = 0
        while start < len(group):
            end = max(start + 1, int(np.searchsorted(upto, upto[start] - fan[start] + SLICE, "right")))
            own = np.repeat(np.arange(start, end), fan[start:end])
            other = first[group[own]] + np.arange(len(own)) - (upto - fan)[own] + (upto - fan)[start]
            yield self.doc[group[own]], key_a[own] % limit * limit + key_b[other] % limit, many_a[own] * many_b[other]
            start = end


def _summed(keys, links):
    """Equal keys once, with the sum of their links."""
    order = np.argsort(keys, kind="stable")
    keys, links = keys[order], links[order]
    new = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[new], (np.add.reduceat(links, new) if len(new) else links)


def _postings(keys, links):
    """(pair, plane, documents as bytes, new documents, links) of the sorted keys pair * DOCS + document of a chunk.

    ``new`` counts documents that are in no lower plane of the pair, so its sum is the count of the planes' OR.
    """
    out, plane = [], 0
    while len(links) and int(links.max()) >> plane:
        has = (links >> plane) & 1 > 0
        fresh = ((links & ((1 << plane) - 1)) == 0)[has]
        key = keys[has]
        pair, doc = key // DOCS, (key % DOCS).astype("<u2")
        new = np.flatnonzero(np.diff(pair, prepend=-1))
        if len(new):
            edge = np.append(new, len(key))
            size = np.diff(edge)
            wide = np.flatnonzero(2 * size >= DOCS // 8)
            if len(wide):  # one bit a document
                parts, last = [], 0
                for w in wide.tolist():
                    bits = np.zeros(DOCS, np.uint8)
                    bits[doc[edge[w] : edge[w + 1]]] = 1
                    parts += [doc[last : edge[w]].tobytes(), np.packbits(bits).tobytes()]
                    last = edge[w + 1]
                raw = b"".join([*parts, doc[last:].tobytes()])
            else:
                raw = doc.tobytes()
            bytes_ = 2 * size
            bytes_[wide] = DOCS // 8
            offsets = np.concatenate([[0], np.cumsum(bytes_)]).astype(np.int32)
            docs = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(raw)])
            out.append((pair[new], np.full(len(new), plane, np.int32), docs, np.add.reduceat(fresh.astype(np.int64), new), size << plane))
        plane += 1
    return out


def _unpacked(docs):
    """(posting, document) of all documents of a list of bitmaps."""
    docs = docs.cast(pa.large_binary())
    n = len(docs)
    at = np.frombuffer(docs.buffers()[1], np.int64, n + 1, docs.offset * 8)
    size = np.diff(at)
    raw = np.frombuffer(docs.buffers()[2], np.uint8)
    wide = size == DOCS // 8
    owner, doc = [], []
    use = np.repeat(~wide, size)
    doc.append(np.frombuffer(raw[at[0] : at[-1]][use].tobytes(), "<u2").astype(np.int64))
    owner.append(np.repeat(np.flatnonzero(~wide), size[~wide] // 2))
    for w in np.flatnonzero(wide).tolist():
        own = np.flatnonzero(np.unpackbits(raw[at[w] : at[w + 1]]))
        doc.append(own)
        owner.append(np.full(len(own), w))
    return np.concatenate(owner), np.concatenate(doc)


def inverted(docs, text="text", key="doc_id", a_path=None, b_path=None):
    """Stored table with one row for each document (rid, key, counts, digest) and one for each posting (pair, chunk, plane, docs, fresh, links).

    Chunks are numbered by task; the table is written once, so numbers stay as they are when a task is repeated.
    """
    kind = docs.schema[key].dataType.simpleString()
    names = ["rid", "key", *COUNTS, "groups_sha256", "pair", "chunk", "plane", "docs", "fresh", "links"]

    def run(batches):
        from pyspark import TaskContext

        a, b, limit, digits = _encoders(a_path, b_path)
        chunk, held, used, kept = TaskContext.get().partitionId() << 24, 0, 0, []
        ids = pa.int64()

        def closed():
            keys, links = _summed(np.concatenate([x for x, _ in kept]), np.concatenate([x for _, x in kept]))
            for pair, plane, found, fresh, n in _postings(keys, links):
                none = lambda t: pa.nulls(len(pair), t)
                yield pa.RecordBatch.from_arrays(
                    [none(ids), none(key_type), *[none(ids)] * 4, none(pa.string()), pa.array(pair), pa.array(np.full(len(pair), chunk)), pa.array(plane), found, pa.array(fresh), pa.array(n)], names=names)

        for batch in batches:
            key_type = batch.schema.field("key").type
            for start, end in tokens.blocks(batch.column("text"), BLOCK_BYTES):
                while start < end:
                    rows = batch.slice(start, min(end - start, DOCS - held))
                    texts = rows.column("text")
                    found = Alignment(texts, a, b, limit, digits)
                    for doc, pair, links in found.pairs(limit):
                        kept.append(_summed(pair * DOCS + doc + held, links))
                    if len(kept) > 8:
                        kept = [_summed(np.concatenate([x for x, _ in kept]), np.concatenate([x for _, x in kept]))]
                    n = len(texts)
                    none = lambda t: pa.nulls(n, t)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.arange(n) + held + chunk * DOCS), rows.column("key"), *(pa.array(x) for x in found.counts), pa.array(found.digest, pa.string()),
                         none(ids), none(ids), none(pa.int32()), none(pa.binary()), none(ids), none(ids)], names=names)
                    start, held = start + n, held + n
                    used += int(pc.sum(pc.fill_null(pc.binary_length(texts), 0)).as_py() or 0)
                    if held == DOCS or used >= CHUNK_BYTES:
                        yield from closed()
                        chunk, held, used, kept = chunk + 1, 0, 0, []
        if kept:
            yield from closed()

    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    longs = ", ".join(f"{c} long" for c in COUNTS)
    return stored(rows.mapInArrow(run, f"rid long, key {kind}, {longs}, groups_sha256 string, pair long, chunk long, plane int, docs binary, fresh long, links long"))


def pair_counts(table):
    """(pair, docs, links, best): documents and links of every pair of an ``inverted`` table; ``best`` if no pair of its A id is in more documents.

    An A id has no more rows than B has ids, which bounds the group that the maximum is taken over.
    """
    limit = F.lit(_limit())
    counts = table.where("pair is not null").groupBy("pair").agg(F.sum("fresh").alias("docs"), F.sum("links").alias("links"))
    counts = counts.withColumn("a", F.floor(F.col("pair") / limit))
    top = counts.groupBy("a").agg(F.max("docs").alias("top"))
    return counts.join(top, "a").select("pair", "docs", "links", (F.col("docs") == F.col("top")).alias("best"))


def _limit(a_path=None, b_path=None):
    from tokenizers import Tokenizer
    import sentencepiece

    a = Tokenizer.from_file(a_path or tokens.tokenizer_path(A_FILE)).get_vocab_size()
    return max(a, sentencepiece.SentencePieceProcessor(model_file=b_path or tokens.tokenizer_path(B_FILE)).get_piece_size())


def _scores(batches):
    """Sums of the scores of the documents of each chunk; rows are sorted by chunk."""
    chunk, total = None, None

    def closed():
        doc = np.flatnonzero(total.any(axis=0))
        return pa.RecordBatch.from_arrays([pa.array(doc + chunk * DOCS), pa.array(total[0][doc]), pa.array(total[1][doc])], names=["rid", "count_sum", "n_best"])

    for batch in batches:
        of = batch.column("chunk").to_numpy()
        edge = np.append(np.flatnonzero(np.diff(of, prepend=of[:1] - 1)), len(of))
        for x, y in zip(edge, edge[1:]):
            if of[x] != chunk:
                if chunk is not None:
                    yield closed()
                chunk, total = of[x], np.zeros((2, DOCS), np.int64)
            own = batch.slice(x, y - x)
            posting, doc = _unpacked(own.column("docs"))
            plane = own.column("plane").to_numpy().astype(np.int64)
            np.add.at(total[0], doc, (own.column("count").to_numpy() << plane)[posting])
            np.add.at(total[1], doc, (own.column("best").to_numpy(zero_copy_only=False).astype(np.int64) << plane)[posting])
    if chunk is not None:
        yield closed()


def align(docs, text="text", key="doc_id", a_path=None, b_path=None):
    """One row for each row of ``docs``: key, ``n_a``, ``n_b`` (tokens), ``n_groups``, ``n_links``, ``n_best``, ``count_sum``, ``groups_sha256``.

    n_best counts links whose pair is in as many documents as any pair of the
    same A id; count_sum adds the documents of the pair over all links.  Texts
    that are null or empty, or that either tokenizer does not spell exactly, have
    no tokens: zeros and an empty digest.  Rows are documents, so repeated rows
    count each; keys may be null or repeated.
    """
    table = inverted(docs, text, key, a_path, b_path)
    scores = pair_counts(table).select("pair", F.col("docs").alias("count"), "best")
    postings = table.where("pair is not null").select("pair", "chunk", "plane", "docs").join(scores, "pair")
    dealt = postings.select("chunk", "plane", "docs", "count", "best").repartition("chunk").sortWithinPartitions("chunk")
    sums = dealt.mapInArrow(_scores, "rid long, count_sum long, n_best long")
    own = table.where("rid is not null").select("rid", "key", *COUNTS, "groups_sha256")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return own.join(sums, "rid", "left").select(F.col("key").alias(key), *COUNTS, zero("n_best"), zero("count_sum"), "groups_sha256")
