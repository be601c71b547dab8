"""Exact Jaccard join of shingle sets in the metric space of Jaccard distances.

1. Sets.  Each text becomes its set of shingle hashes; equal sets are one class.
2. Families.  Unrelated texts are all at distance 1, where the triangle inequality
   says nothing, so the space is first cut where no link can cross: the hash range
   is sliced so finely that two linked sets must agree on a whole slice of two or
   more elements (a pigeonhole count of the elements in which they may differ).  A family holds
   the classes that are connected by agreeing slices, linked or not; a family too
   large for a task is cut again by shared rare elements (two linked sets share
   one of each other's rarest), and then by pairs of agreeing slices.
3. Regions.  A family's members fall to the Voronoi regions of their nearest
   pivots.  A member is copied into an earlier region too if its distances to all
   pivots lie within the region's own, widened by the radius (the triangle
   inequality lets no other member link into it).  Regions are joined in the same
   way with pivots of their own, as long as that makes them smaller.
4. Links.  What remains is joined by inverted lists of each set's rarest elements
   (two linked sets share one of them); a candidate's intersection is counted in
   full, and connected members are never compared again.
A family that fits a task is divided there; a larger one is first divided by an
ordinary join, and the members of its largest connected part are then compared
with the others only.  Nothing is capped.
"""

import functools
import heapq
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from estimand.llm import words
from estimand.llm.bitmap import bitmap, inside
from estimand.llm.components import components
from estimand.plans.prefix import release, stored

#: Bytes of text whose sets are made together.
SET_BYTES = 1 << 20
#: A family up to this many members and set elements is joined in one task (some 30 MB); regions hold half of it.
LEAF_MEMBERS, LEAF_ITEMS = 10_000, 4_000_000
#: Pivots of a larger family, and the elements of all of them up to which they are sent to the members (8 MB), not the members to them.
PIVOTS, PIVOT_ITEMS = 16, 1_000_000
#: Inside a task: groups above REGION sets fall to the regions of LEAF_PIVOTS pivots, sets further than FAR from all of
#: them to one more, as long as the largest region has at most SHRINK of the group and all of them twice its sets.
REGION, LEAF_PIVOTS, FAR, SHRINK = 256, 8, 0.8, 0.7
#: Counters of how often elements occur (a task holds 16 MB of them), and how many of them travel in a row.
COUNTERS, COUNTER_ROW = 1 << 22, 1 << 12
#: Ways in which large families are cut again, as long as there are any: by rare elements, counted anew each time, or by pairs of slices.
CUTS = (True, True, False)
#: Slice keys are compared in so many rounds, and the copies of a large family's sets are dealt in rounds of so many times
#: its own elements: the disk holds the shuffle of one round.
KEY_ROUNDS, ROUND_COPIES = 3, 2
#: Elements that are looked up, or intersections that are counted, at a time.
LOOKUP = 1 << 18
#: Least growth of the size classes; below 80 percent 100 / percent, so that a partner lies one class apart at most.
GROWTH = 1.25
_MASK = np.uint64((1 << 48) - 1)


def _classes(limit, percent):
    """Size classes: first sizes, number of slices and allowed weak slices of each; 0 slices where no two different sets link."""
    low, slices, weak, growth = [1], [], [], max(GROWTH, 100 / percent)
    while low[-1] <= limit:
        a = max(low[-1] + 1, int(np.ceil(low[-1] * growth)))
        top = a - 1
        differ = (100 - percent) * (top + 100 * top // percent) // (100 + percent)
        spare = 0
        for _ in range(8):
            mean = low[-1] / (differ + 1 + spare)
            share = (1 + mean) * np.exp(-mean) * (differ + 1 + spare)
            spare = min(differ + 1, int(share + 3 * np.sqrt(share)) + 1)
        low.append(a)
        slices.append(differ + 1 + spare if differ else 0)
        weak.append(spare)
    return np.array(low), np.array(slices), np.array(weak)


def _sets(texts, n):
    """Distinct 48-bit shingle hashes, sorted within each text: (index of text, hash)."""
    w = words.Words(texts, lower=True)
    text, h = w.shingles(n)
    both = np.unique((text.astype(np.uint64) << np.uint64(48)) | (h >> np.uint64(16)))
    return (both >> np.uint64(48)).astype(np.int64), both & _MASK


def _sums(text, values, n):
    out = np.zeros(n, np.uint64)
    if len(text):
        first = np.flatnonzero(np.diff(text, prepend=-1))
        out[text[first]] = np.add.reduceat(values, first)
    return out


def _signed(text, h, n):
    size = np.bincount(text, minlength=n)
    return size, words.mix(_sums(text, words.mix(h), n) + size.astype(np.uint64)), words.mix(_sums(text, words.mix(h ^ np.uint64(0x5DEECE66D)), n))


def _slice_keys(text, h, size, percent):
    """(text, key) of all slices of two or more elements, of both schemes a set may meet a partner in.

    A slice of one element would bring together all texts that share a common
    phrase.  Such weak slices are left out, and as many more slices are made as a
    set usually has weak ones; the few sets with more of them give their prefix.
    """
    low, slices, weak = _classes(int(size.max(initial=1)), percent)
    own = np.searchsorted(low, size, "right") - 1
    out, loose = [], np.zeros(len(size), bool)
    for scheme in (own, own - 1):
        fits = (size > 0) & (scheme >= 0)
        if scheme is not own:
            fits &= percent * size <= 100 * (low[np.maximum(own, 0)] - 1)
        fits &= slices[np.maximum(scheme, 0)] > 0
        use = fits[text]
        t, x = text[use], h[use]
        if not len(t):
            continue
        c = scheme[t]
        part = ((x >> np.uint64(16)) * slices[c].astype(np.uint64)) >> np.uint64(32)
        first = np.flatnonzero((np.diff(t, prepend=-1) != 0) | (np.diff(part.astype(np.int64), prepend=-1) != 0))
        key = words.mix(np.add.reduceat(words.mix(x), first) ^ words.mix((c[first].astype(np.uint64) << np.uint64(32)) + part[first]))
        strong = np.diff(np.append(first, len(t))) > 1
        out.append((t[first[strong]], key[strong]))
        filled = np.bincount(t[first[strong]], minlength=len(size))
        loose |= fits & (slices[np.maximum(scheme, 0)] - filled > weak[np.maximum(scheme, 0)])
    if loose.any():
        out.append(_prefixes(text, h, size, percent, loose))
    return _by_text(out)


def _prefixes(text, h, size, percent, loose):
    """(text, key) of the first elements, in the order given, of the loose sets: linked sets share one of them if all have the same order."""
    use = loose[text]
    t, x = text[use], h[use]
    begin = np.flatnonzero(np.diff(t, prepend=-1))
    rank = np.arange(len(t)) - np.repeat(begin, np.diff(np.append(begin, len(t))))
    prefix = rank < size[t] - -(-percent * size[t] // 100) + 1
    return t[prefix], words.mix(x[prefix] ^ np.uint64(0xC0FF << 48))


def _by_text(out):
    text = np.concatenate([o[0] for o in out]) if out else np.zeros(0, np.int64)
    key = np.concatenate([o[1] for o in out]) if out else np.zeros(0, np.uint64)
    order = np.argsort(text, kind="stable")
    return text[order], key[order]


def _bundles(limit, percent):
    """As ``_classes``, for bundles of four slices: differences, bundles and allowed empty slices of each size class."""
    low, _, _ = _classes(limit, percent)
    bundles, empty = [], []
    for first, after in zip(low, low[1:]):
        top = after - 1
        differ = (100 - percent) * (top + 100 * top // percent) // (100 + percent)
        count = differ // 3 + 1
        for _ in range(64):
            share = 4 * count * np.exp(-first / (4 * count))
            if 3 * count - differ - 1 >= share + 3 * np.sqrt(share):
                break
            count += max(1, count // 20)
        bundles.append(count if differ else 0)
        empty.append(3 * count - differ - 1)
    return low, np.array(bundles), np.array(empty)


def _bundle_keys(text, h, size, percent):
    """(text, key) of all pairs of non-empty slices in one bundle.

    With more slices than differences and bundles together, two linked sets agree
    on two slices of some bundle: a stronger sign than one slice, for more keys.
    """
    low, bundles, empty = _bundles(int(size.max(initial=1)), percent)
    own = np.searchsorted(low, size, "right") - 1
    out, loose = [], np.zeros(len(size), bool)
    for scheme in (own, own - 1):
        fits = (size > 0) & (scheme >= 0)
        if scheme is not own:
            fits &= percent * size <= 100 * (low[np.maximum(own, 0)] - 1)
        fits &= bundles[np.maximum(scheme, 0)] > 0
        use = fits[text]
        t, x = text[use], h[use]
        if not len(t):
            continue
        c = scheme[t]
        part = (((x >> np.uint64(16)) * (4 * bundles[c]).astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
        first = np.flatnonzero((np.diff(t, prepend=-1) != 0) | (np.diff(part, prepend=-1) != 0))
        one = words.mix(np.add.reduceat(words.mix(x), first) ^ words.mix((c[first].astype(np.uint64) << np.uint64(32)) + part[first].astype(np.uint64)))
        t, bundle = t[first], part[first] // 4
        for step in (1, 2, 3):
            pair = np.flatnonzero((t[step:] == t[:-step]) & (bundle[step:] == bundle[:-step]))
            out.append((t[pair], words.mix(one[pair] + np.uint64(3) * one[pair + step])))
        filled = np.bincount(t, minlength=len(size))
        loose |= fits & (4 * bundles[np.maximum(scheme, 0)] - filled > empty[np.maximum(scheme, 0)])
    if loose.any():
        out.append(_prefixes(text, h, size, percent, loose))
    return _by_text(out)


def _signatures(docs, text, key, n, percent):
    """(rid, key, n_shingles, s1, s2, keys): keys are left out where the task has met the same set before."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        from pyspark import TaskContext

        rid, seen = TaskContext.get().partitionId() << 36, set()
        for batch in batches:
            for part in words.blocks(batch, text, SET_BYTES):
                rows = part.num_rows
                t, h = _sets(part.column(text), n)
                size, s1, s2 = _signed(t, h, rows)
                new = np.zeros(rows, bool)
                for i, s in enumerate(s1.tolist()):
                    new[i] = size[i] > 0 and s not in seen
                    seen.add(s)
                kt, kk = _slice_keys(t[new[t]], h[new[t]], np.where(new, size, 0), percent)
                offsets = np.searchsorted(kt, np.arange(rows + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(rid, rid + rows)), part.column(key), pa.array(size, pa.int64()), pa.array(s1.view(np.int64)), pa.array(s2.view(np.int64)),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(kk.view(np.int64)))],
                    names=["rid", key, "n_shingles", "s1", "s2", "keys"])
                rid += rows

    return docs.select(F.col(key), F.col(text)).mapInArrow(run, f"rid long, `{key}` {kind}, n_shingles long, s1 long, s2 long, keys array<long>")


def _wanted_sets(docs, text, n, wanted):
    """(s1, s2, items) of the sets whose s1 may be in ``wanted``: texts are hashed again, a set once in each task; six bytes an element."""
    filled, shift = bitmap(wanted, "s1")

    def run(batches):
        seen = set()
        for batch in batches:
            for part in words.blocks(batch, text, SET_BYTES):
                t, h = _sets(part.column(text), n)
                size, s1, s2 = _signed(t, h, part.num_rows)
                hit = np.flatnonzero((size > 0) & inside(filled.value, shift, s1)) if part.num_rows else np.zeros(0, np.int64)
                new = []
                for i in hit.tolist():
                    if s1[i] not in seen:
                        seen.add(s1[i])
                        new.append(i)
                hit = np.array(new, np.int64)
                begin, end = np.searchsorted(t, hit), np.searchsorted(t, hit, "right")
                raw = h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(s1[hit].view(np.int64)), pa.array(s2[hit].view(np.int64)), pa.array([raw[a:b].tobytes() for a, b in zip(begin, end)], pa.binary())],
                    names=["s1", "s2", "items"])

    return docs.select(F.col(text)).mapInArrow(run, "s1 long, s2 long, items binary")


def _counter(h):
    return (h & np.uint64(COUNTERS - 1)).astype(np.int64)


def _often(members):
    """Broadcast levels (16 to each doubling) of how many of the stored ``members`` hold an element; elements that share a counter only look more frequent."""

    def rows(held):
        counts = [zlib.compress(x.astype("<u4").tobytes(), 1) for x in held.values()]
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array(counts, pa.binary())], names=["block", "counts"])

    def count(batches):
        held = np.zeros(COUNTERS, np.uint32)
        for batch in batches:
            for part in words.blocks(batch, "items", SET_BYTES):
                np.add.at(held, _counter(_unpacked(b"".join(part.column("items").to_pylist()))), 1)
        held = held.reshape(-1, COUNTER_ROW)
        yield rows({int(i): held[i] for i in np.flatnonzero(held.any(axis=1))})

    def total(batches):
        held = {}
        for batch in batches:
            for block, raw in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist()):
                held[block] = held.get(block, np.uint32(0)) + np.frombuffer(zlib.decompress(raw), "<u4")
        yield rows(held)

    schema = "block int, counts binary"
    table = members.select("items").mapInArrow(count, schema).repartition("block").mapInArrow(total, schema).toArrow()
    out = np.zeros((COUNTERS // COUNTER_ROW, COUNTER_ROW), np.uint8)
    for block, raw in zip(table.column("block").to_pylist(), table.column("counts").to_pylist()):
        out[block] = np.minimum(16 * np.log2(1.0 + np.frombuffer(zlib.decompress(raw), "<u4")), 255)
    return members.sparkSession.sparkContext.broadcast(out.ravel())


def _rare_keys(text, h, size, percent, often):
    """(text, key) of each set's rarest elements by the levels ``often``, in the size classes a set may meet a partner in.

    Linked sets share one of them, whatever the levels are.  What many texts have
    in common, such as a repeated line, is no one's rarest unless a text holds
    little else.
    """
    low, _, _ = _classes(int(size.max(initial=1)), percent)
    own = np.searchsorted(low, size, "right") - 1
    order = np.lexsort((often[_counter(h)], text))
    t, key = _prefixes(text[order], h[order], size, percent, np.ones(len(size), bool))
    lower = (own > 0) & (percent * size <= 100 * (low[np.maximum(own, 0)] - 1))
    out = [(t[use], words.mix(key[use] ^ scheme[t[use]].astype(np.uint64))) for scheme, use in ((own, slice(None)), (own - 1, lower[t]))]
    return _by_text(out)


def _refined(members, percent, rare=False):
    """Stored (node, comp): families after cutting those of stored ``members`` (cid, family, items), a class once, again by pairs of slices, or by rare elements."""
    often = _often(members) if rare else None

    def run(batches):
        for batch in batches:
            for part in words.blocks(batch, "items", SET_BYTES):
                raw = part.column("items").to_pylist()
                size = np.array([len(x) // 6 for x in raw], np.int64)
                text, h = np.repeat(np.arange(len(raw)), size), _unpacked(b"".join(raw))
                owner, keys = _rare_keys(text, h, size, percent, often.value) if rare else _bundle_keys(text, h, size, percent)
                take = pa.array(owner)
                yield pa.RecordBatch.from_arrays(
                    [part.column("family").take(take), part.column("cid").take(take), pa.array(keys.view(np.int64))], names=["family", "cid", "key"])

    keyed = members.select("family", "cid", "items").mapInArrow(run, "family long, cid long, key long")
    over = W.partitionBy("key", "family")
    near = keyed.withColumn("_lo", F.min("cid").over(over)).where("_lo < cid").select(F.col("_lo").alias("a"), F.col("cid").alias("b"))
    near = stored(near.distinct())
    label = components(near)
    release(near)
    return label


def _unpacked(raw):
    """The set elements, from six bytes each."""
    raw = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :6] = raw
    return out.view("<u8").ravel()


def _as_arrays(batches):
    for batch in batches:
        items = [_unpacked(x).view(np.int64) for x in batch.column("items").to_pylist()]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("family", "cid", "n")), pa.array(items, pa.list_(pa.int64())), batch.column("items")],
                                         names=["family", "cid", "n", "elements", "items"])


class _Leaf:
    """Sets of a task as flat arrays; elements are numbered from the rarest on, so that the first ones of a set tell most."""

    def __init__(self, size, elements, label, inner, percent):
        self.size = size
        self.start = np.cumsum(size) - size
        # element numbers take four bytes, and sorting happens in place: a task of the largest size holds some 100 MB
        known = np.sort(elements)
        first = np.flatnonzero(np.append(True, known[1:] != known[:-1]))
        count = np.diff(np.append(first, len(known)))
        known = known[first]
        rank = np.empty(len(count), np.int32)
        rank[np.argsort(count, kind="stable")] = np.arange(len(count), dtype=np.int32)
        both = np.empty(len(elements), np.uint64)
        for a in range(0, len(elements), LOOKUP):
            both[a : a + LOOKUP] = rank[np.searchsorted(known, elements[a : a + LOOKUP])]
        del known, first, rank
        both |= np.repeat(np.arange(len(size), dtype=np.uint64) << np.uint64(32), size)
        both.sort()
        self.flat = (both & np.uint64(0xFFFFFFFF)).astype(np.int32)
        self.mark = np.zeros(len(count), bool)
        self.label = np.unique(label, return_inverse=True)[1]
        self.members = {}
        for i, x in enumerate(self.label.tolist()):
            self.members.setdefault(x, []).append(i)
        self.inner, self.percent, self.radius, self.out = np.asarray(inner, bool), percent, 1 - percent / 100 + 1e-9, []

    def common(self, p, rows):
        """Sizes of the intersections of set p with the given sets."""
        own = self.flat[self.start[p] : self.start[p] + self.size[p]]
        self.mark[own] = True
        n = self.size[rows]
        upto, out, a = np.cumsum(n), [], 0
        while a < len(rows):
            b = max(a + 1, int(np.searchsorted(upto, upto[a] - n[a] + LOOKUP, "right")))
            part = n[a:b]
            end = np.cumsum(part)
            hit = self.mark[self.flat[np.repeat(self.start[rows[a:b]] - (end - part), part) + np.arange(end[-1])]]
            out.append(np.add.reduceat(hit, end - part, dtype=np.int64))
            a = b
        self.mark[own] = False
        return np.concatenate(out) if out else np.zeros(0, np.int64)

    def link(self, p, rows, common):
        """Connect p with those of the given sets that are similar enough."""
        for x in rows[100 * common >= self.percent * (self.size[rows] + self.size[p] - common)].tolist():
            a, b = int(self.label[p]), int(self.label[x])
            if a != b:
                self.out.append((p, x))
                a, b = (a, b) if len(self.members[a]) >= len(self.members[b]) else (b, a)
                gone = self.members.pop(b)
                self.label[gone] = a
                self.members[a] += gone

    def regions(self, inner, outer):
        """Voronoi regions (inner, outer) of the inner sets, with the outer sets that the windows let in; None where they save little.

        Sets further than ``FAR`` from all pivots share the last region.  A set
        of another region comes in only if its distance to the region's pivot is
        at most the radius beyond the distances of the sets inside; of two
        regions only the first takes in sets of the other.
        """
        both = np.concatenate([inner, outer])
        n = len(inner)
        pivots = inner[np.linspace(0, n - 1, LEAF_PIVOTS).astype(np.int64)]
        far = np.empty((LEAF_PIVOTS, len(both)))
        for j, p in enumerate(pivots.tolist()):
            common = self.common(p, both)
            self.link(p, both, common)
            far[j] = 1 - common / (self.size[both] + self.size[p] - common)
        near, home = far.min(axis=0), far.argmin(axis=0)
        home[near > FAR] = LEAF_PIVOTS
        out = []
        for j in range(LEAF_PIVOTS + 1):
            own = np.flatnonzero(home[:n] == j)
            if len(own):
                others = np.flatnonzero((home > j) | (np.arange(len(both)) >= n))
                fits = np.ones(len(others), bool)
                for d in far:
                    fits &= (d[others] >= d[own].min() - self.radius) & (d[others] <= d[own].max() + self.radius)
                out.append((inner[own], both[others[fits]]))
        held = [len(x) + len(y) for x, y in out]
        return out if max(held) <= SHRINK * len(both) and sum(held) <= 2 * len(both) else None

    def join(self, inner, outer):
        """Links between inner sets and any others, by inverted lists of the sets' rarest elements (linked sets share one of them)."""
        rows = np.concatenate([inner, outer])
        prefix = self.size[rows] - -(-self.percent * self.size[rows] // 100) + 1
        end = np.cumsum(prefix)
        begin = end - prefix
        element = self.flat[np.repeat(self.start[rows] - begin, prefix) + np.arange(end[-1])]
        order = np.argsort(element, kind="stable")
        held, holder = element[order], np.repeat(rows, prefix)[order]
        lo, hi = np.searchsorted(held, element), np.searchsorted(held, element, "right")
        place = dict(zip(rows.tolist(), range(len(rows))))
        alive, inside = np.zeros(len(self.size), bool), np.zeros(len(self.size), bool)
        alive[rows], inside[inner] = True, True
        left = dict(zip(*(x.tolist() for x in np.unique(self.label[rows], return_counts=True))))
        heap = sorted((n, x) for x, n in left.items())
        todo = {}
        for i in rows.tolist():
            todo.setdefault(int(self.label[i]), []).append(i)
        while len(todo) > 1:
            n, x = heapq.heappop(heap)
            if x not in todo:
                continue
            if n != len(todo[x]):
                heapq.heappush(heap, (len(todo[x]), x))
                continue
            p = todo[x].pop()
            alive[p] = False
            i = place[p]
            a, b = lo[begin[i] : end[i]], hi[begin[i] : end[i]]
            more = b - a > 1
            if more.any():
                a, n = a[more], b[more] - a[more]
                upto = np.cumsum(n)
                found = holder[np.repeat(a - (upto - n), n) + np.arange(upto[-1])]
                found = np.unique(found[alive[found] & (self.label[found] != self.label[p]) & (inside[found] | inside[p])])
                small, large = np.minimum(self.size[found], self.size[p]), np.maximum(self.size[found], self.size[p])
                found = found[100 * small >= self.percent * large]
                if len(found):
                    before = self.label[found]
                    self.link(p, found, self.common(p, found))
                    for old in set(before.tolist()) | {x}:
                        now = int(self.label[todo[old][0]]) if todo.get(old) else old
                        if now != old:
                            todo.setdefault(now, []).extend(todo.pop(old))
                            heapq.heappush(heap, (len(todo[now]), now))
                        elif old in todo and not todo[old]:
                            del todo[old]
            if todo.get(x):
                heapq.heappush(heap, (len(todo[x]), x))
            else:
                todo.pop(x, None)


def _linked(size, elements, label, percent, inner=None):
    """Index pairs that connect what links connect: sets of the given sizes, whose ``elements`` stand one after the other.

    ``label`` tells which members are connected already.

    Only pairs with an inner set count.  Large groups fall to Voronoi regions
    again and again, as long as regions are much smaller than the group; what
    remains is joined by inverted lists.
    """
    leaf = _Leaf(size, elements, label, np.ones(len(size), bool) if inner is None else inner, percent)
    todo = [(np.flatnonzero(leaf.inner), np.flatnonzero(~leaf.inner))]
    while todo:
        own, others = todo.pop()
        if len(own) == 0 or (leaf.label[own] == leaf.label[own[0]]).all() and (leaf.label[others] == leaf.label[own[0]]).all():
            continue
        parts = leaf.regions(own, others) if len(own) + len(others) > REGION and len(own) >= LEAF_PIVOTS else None
        if parts is None:
            leaf.join(own, others)
        else:
            todo += parts
    return leaf.out


def _joined(percent):
    """Links (a, b) of sorted rows (leaf, cid, comp, inner, items); a class met twice counts once, as an inner one if it is one anywhere."""

    def solve(table):
        own = table.column("inner").to_numpy()
        order = np.argsort(~own, kind="stable")
        cid, first = np.unique(table.column("cid").to_numpy()[order], return_index=True)
        if len(cid) < 2:
            return []
        chosen = order[first]
        comp, own = table.column("comp").to_numpy()[chosen], own[chosen]
        items = table.column("items").combine_chunks().cast(pa.large_binary()).take(pa.array(chosen))
        at = np.frombuffer(items.buffers()[1], np.int64, len(items) + 1, items.offset * 8)
        elements = _unpacked(np.frombuffer(items.buffers()[2], np.uint8)[at[0] : at[-1]])
        size = np.diff(at) // 6
        del items, table
        return [(int(cid[a]), int(cid[b])) for a, b in _linked(size, elements, comp, percent, own)]

    def run(batches):
        held, last, out = [], None, []
        for batch in batches:
            leaf = batch.column("leaf").to_numpy()
            edges = np.append(np.flatnonzero(np.diff(leaf, prepend=leaf[:1] - 1)), len(leaf))
            for a, b in zip(edges, edges[1:]):
                if held and leaf[a] != last:
                    out += solve(pa.Table.from_batches(held))
                    held = []
                held.append(batch.slice(a, b - a))
                last = leaf[a]
        if held:
            out += solve(pa.Table.from_batches(held))
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return run


def _leaf_links(rows, percent):
    dealt = rows.select("leaf", "cid", "comp", "inner", "items").repartition("leaf").sortWithinPartitions("leaf")
    return dealt.mapInArrow(_joined(percent), "a long, b long")


def _region_links(members, percent):
    """Stored tables of links of the families too large for a task; ``members`` (family, cid, n, elements, items) are stored, a class once."""
    radius = 1 - percent / 100 + 1e-9
    draw = [F.min_by("cid", F.xxhash64("cid", F.lit(j))).alias(f"p{j}") for j in range(PIVOTS)]
    chosen = members.groupBy("family").agg(*draw).select("family", F.posexplode(F.array(*[f"p{j}" for j in range(PIVOTS)])).alias("j", "pivot"))
    sets = members.select(F.col("cid").alias("pivot"), F.col("n").alias("pn"), F.col("elements").alias("pitems"))
    pivots = stored(sets.join(F.broadcast(chosen), "pivot"))  # a few for each task's worth of members
    held = pivots.agg(F.sum("pn")).first()[0] or 0
    common = F.size(F.array_intersect("elements", "pitems")).cast("long")
    far = members.join(F.broadcast(pivots) if held <= PIVOT_ITEMS else pivots, "family").select("family", "cid", "j", "pivot", common.alias("common"), (F.col("n") + F.col("pn") - common).alias("union"))
    far = stored(far.withColumn("d", 1 - F.col("common") / F.col("union")))
    release(pivots)
    stars = far.where((F.col("cid") != F.col("pivot")) & (100 * F.col("common") >= percent * F.col("union"))).select(F.col("cid").alias("a"), F.col("pivot").alias("b")).distinct()
    stars = stored(stars)
    label = components(stars)
    place = far.groupBy("family", "cid").agg(F.min(F.struct("d", "j")).alias("home"), F.array_sort(F.collect_list(F.struct("j", "d"))).alias("ds"))
    place = place.join(label.withColumnRenamed("node", "cid"), "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))
    most = place.groupBy("family", "comp").count().groupBy("family").agg(F.max(F.struct("count", "comp")).alias("most"))
    size = lambda: [F.count(F.lit(1)).alias("m"), F.sum("n").alias("items")]
    parts = F.greatest(F.ceil(2 * F.col("m") / LEAF_MEMBERS), F.ceil(2 * F.col("items") / LEAF_ITEMS)).alias("parts")
    place = place.join(members.select("cid", "n"), "cid").join(most.select("family", "most"), "family").select(
        "family", "cid", "n", "comp", "ds", (F.col("comp") == F.col("most.comp")).alias("main"), F.col("home.j").alias("j"))
    # no more regions than the family needs: homes share them, and an overfull one is split
    whole = members.groupBy("family").agg(*size()).select("family", parts)
    place = place.join(whole, "family").withColumn("home", F.pmod(F.col("j"), F.col("parts"))).drop("parts", "j")
    full = place.groupBy("family", "main", "home").agg(*size()).select("family", "main", "home", parts)
    place = place.join(full, ["family", "main", "home"])
    place = stored(place.withColumn("region", F.xxhash64("family", "main", "home", F.pmod(F.xxhash64("cid"), "parts"))))
    bounds = [f(F.element_at("ds", j + 1)["d"]).alias(f"{a}{j}") for j in range(PIVOTS) for a, f in (("lo", F.min), ("hi", F.max))]
    regions = place.groupBy("family", "region", "main").agg(*bounds)  # at most a few for each task's worth of members
    first = regions.select("family", F.col("region").alias("leaf"), F.col("main").alias("o_main"), *[F.col(f"{a}{j}") for j in range(PIVOTS) for a in ("lo", "hi")])
    # a member goes to each earlier region in whose windows it lies: it is at most the radius nearer or farther than the region's own
    let_in = " and ".join(f"ds[{j}].d between lo{j} - {radius} and hi{j} + {radius}" for j in range(PIVOTS))
    outer = place.join(first, "family").where("leaf < region and not (main and o_main)").where(let_in)
    outer = stored(outer.select("leaf", "cid", "comp", F.lit(False).alias("inner")))
    used = outer.select("leaf").distinct().withColumn("_used", F.lit(True))
    own = place.select(F.col("region").alias("leaf"), "cid", "comp", F.lit(True).alias("inner"), "main").join(used, "leaf", "left").where("not main or _used")
    rows = own.select("leaf", "cid", "comp", "inner").unionByName(outer)
    whole = members.agg(F.sum("n")).first()[0] or 1
    before = F.sum("items").over(W.partitionBy(F.lit(0)).orderBy("leaf").rowsBetween(W.unboundedPreceding, -1))
    dealt = rows.join(members.select("cid", "n"), "cid").groupBy("leaf").agg(F.sum("n").alias("items"))  # a row for each region
    dealt = stored(dealt.select("leaf", F.floor(F.coalesce(before, F.lit(0)) / (ROUND_COPIES * whole)).alias("round")))
    links = []
    for i in sorted(r[0] for r in dealt.select("round").distinct().collect()):
        part = rows.join(F.broadcast(dealt.where(F.col("round") == i).select("leaf")), "leaf")
        links.append(stored(_leaf_links(part.join(members.select("cid", "items"), "cid"), percent)))
    release(outer, place, far, label, dealt)
    return stars, *links


def _sized(groups, label):
    """Stored classes (cid, s1, s2, n, family, large) of the components ``label``, which is released."""
    wanted = groups.join(label.select(F.col("node").alias("cid"), F.col("comp").alias("family")), "cid")
    sizes = wanted.groupBy("family").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("items"))
    large = (F.col("m") > LEAF_MEMBERS) | (F.col("items") > LEAF_ITEMS)
    out = stored(wanted.join(sizes, "family").select("cid", "s1", "s2", "n", "family", large.alias("large")))
    release(label)
    return out


def classes(docs, text="text", key="doc_id", n=5, percent=80):
    """One row for each row of ``docs``: key, ``n_shingles`` and ``component_id``, the smallest key reachable by links.

    A set holds the distinct runs of ``n`` words (ASCII letters lower-cased), or
    the whole sequence of a shorter text; two texts are linked if the Jaccard
    similarity of their sets is at least ``percent`` / 100.  A text without words
    (or null) has an empty set and no link.  Repeated rows and equal texts are
    linked; a null key takes part but never names a component that has another.
    """
    signed = stored(_signatures(docs, text, key, n, percent))
    rows = stored(signed.select("rid", key, "n_shingles", "s1", "s2"))
    over = W.partitionBy("key")
    agreed = []
    for i in range(KEY_ROUNDS):
        keyed = signed.where(F.size("keys") > 0).select(F.explode("keys").alias("key"), "rid").where(F.pmod("key", F.lit(KEY_ROUNDS)) == i)
        keyed = keyed.withColumns({"_lo": F.min("rid").over(over), "_hi": F.max("rid").over(over)}).where("_lo < _hi")
        agreed.append(stored(keyed.select(F.col("_lo").alias("a"), F.col("rid").alias("b")).where("a <> b").distinct()))
    release(signed)
    full = rows.where("n_shingles > 0")
    groups = stored(full.groupBy("s1", "s2").agg(F.min("rid").alias("cid"), F.min(key).alias("low"), F.first("n_shingles").alias("n")))
    cid = full.join(groups, ["s1", "s2"]).select("rid", "cid")
    near = functools.reduce(DataFrame.unionByName, agreed).join(cid.select(F.col("rid").alias("a"), F.col("cid").alias("ca")), "a").join(cid.select(F.col("rid").alias("b"), F.col("cid").alias("cb")), "b")
    label = components(near.select(F.col("ca").alias("a"), F.col("cb").alias("b")))
    release(*agreed)
    wanted = _sized(groups, label)
    found, done = _wanted_sets(docs, text, n, wanted).join(wanted, ["s1", "s2"]), [wanted]
    beyond = False
    if wanted.where("large").head(1):
        # the sets come from the texts once; each class's is kept once
        first = [F.first(c).alias(c) for c in ("cid", "n", "family", "large", "items")]
        sets = stored(found.groupBy("s1", "s2").agg(*first).drop("s1", "s2"))
        done, cut = [*done, sets], [sets]
        for rare in CUTS:
            finer = _sized(groups, _refined(cut[-1].where("large"), percent, rare))
            cut.append(stored(cut[-1].where("large").select("cid", "items").join(finer.select("cid", "n", "family", "large"), "cid")))
            done.append(cut[-1])
            beyond = bool(finer.where("large").head(1))
            release(finer)
            if not beyond:
                break
        found = functools.reduce(DataFrame.unionByName, [x.where("not large") for x in cut])
    usual = found.where("not large").select(F.col("family").alias("leaf"), "cid", F.col("cid").alias("comp"), F.lit(True).alias("inner"), "items")
    links = stored(_leaf_links(usual, percent))
    done.append(links)
    if beyond:
        members = stored(cut[-1].where("large").mapInArrow(_as_arrays, "family long, cid long, n long, elements array<long>, items binary"))
        more = _region_links(members, percent)
        links = functools.reduce(DataFrame.unionByName, more, links)
        done += [members, *more]
    label = components(links)
    release(*done)
    named = groups.join(label.withColumnRenamed("node", "cid"), "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))
    lowest = named.groupBy("comp").agg(F.min("low").alias("component_id"))
    by_set = named.join(lowest, "comp").select("s1", "s2", "component_id")
    return rows.join(by_set, ["s1", "s2"], "left").select(
        key, "n_shingles", F.when(F.col("n_shingles") == 0, F.col(key)).otherwise(F.col("component_id")).alias("component_id"))


def keep_one(docs, text="text", key="doc_id", n=5, percent=80):
    """Rows of ``docs`` with one row of each class of linked texts: that of the smallest key (then of the smallest hash of its text).

    Rows that repeat key and text stay once.  Rows without words are linked with
    nothing, so all different ones stay.  The columns keep their names and order.
    """
    own = F.struct(F.col(key).isNull().alias("n"), F.col(key).alias("k"), F.xxhash64(text).alias("h"))
    named = classes(docs.select(own.alias("_key"), F.col(text).alias("_text")), "_text", "_key", n, percent)
    by_key = named.groupBy("_key").agg(F.count(F.lit(1)).alias("_rows"), F.bool_or(F.col("_key") == F.col("component_id")).alias("_kept"))
    # only rows that may go, or come again, are shuffled
    asked = stored(by_key.where("_rows > 1 or not _kept").select("_key", "_kept", F.xxhash64("_key").alias("_hash")))
    filled, shift = bitmap(asked, "_hash")

    @F.pandas_udf("boolean")
    def maybe(hashes: pd.Series) -> pd.Series:
        return pd.Series(inside(filled.value, shift, hashes.to_numpy(np.int64).view(np.uint64)))

    passed = maybe(F.xxhash64(own))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    whole = docs.where(passed).select(F.struct(*columns).alias("_row"), own.alias("_key"))
    rows = whole.join(asked.select("_key", "_kept"), "_key", "left").where("_kept is null or _kept").groupBy("_key").agg(F.first("_row").alias("_row"))
    return docs.where(~passed).select(*columns).union(rows.select(*[F.col("_row")[c].alias(c) for c in docs.columns]))
