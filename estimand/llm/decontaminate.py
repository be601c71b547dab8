"""Benchmark decontamination with spaced seeds.

A mask picks some of the words of a window and ignores the others, so a
substituted word breaks only the seeds that look at it.  Benchmark seeds fill a
bitmap of bounded size; documents keep the seeds it passes, with the words
around them, and an ordinary join on the seed hash finds the benchmark items.
Every joined diagonal is then verified word by word, mismatches allowed.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from estimand.llm import words
from estimand.llm.bitmap import bitmap, inside
from estimand.plans.prefix import stored

#: 1: the word counts, 0: it is ignored.
MASKS = ["11111", "110111", "1101011", "11001000111"]
#: Words kept on both sides of a seed; seeds closer than this share one stretch of text.
CONTEXT = 64


def _seed_hashes(w, mask, salt):
    """(first word, hash) of a mask at every place where it lies inside one text."""
    first = w.windows(len(mask))
    picked = [i for i, c in enumerate(mask) if c == "1"]
    up, _ = words.powers(words.STEPS[0], len(mask) + 1)
    h = np.zeros(len(first), np.uint64)
    for i in picked:
        h += w.hash[first + i] * up[i]
    return first, words.mix(h ^ np.uint64(salt + 1))


def _item_seeds(items, text, masks, least):
    """(seed, item, at) of every mask; those after the first ``least`` masks are for the texts that have just so many words."""

    def run(batches):
        for batch in batches:
            for part in words.blocks(batch, text):
                w = words.Words(part.column(text), lower=True)
                size, out = np.diff(w.bounds), []
                for i, m in enumerate(masks):
                    first, h = _seed_hashes(w, m, i)
                    own = np.ones(len(first), bool) if i < least else size[w.text[first]] == len(m)
                    out.append((first[own], h[own]))
                first, h = (np.concatenate([o[k] for o in out]) for k in (0, 1))
                owner = w.text[first]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), part.column("_item").take(pa.array(owner)), pa.array((first - w.bounds[owner]).astype(np.int32))],
                    names=["seed", "item", "at"])

    return items.select("_item", text).mapInArrow(run, "seed long, item long, at int").distinct()


def _stretches(docs, text, key, masks, filled, shift, context):
    """(sid, key, first, packed, seeds): stretches of words around the seeds that the bitmap passes."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        from pyspark import TaskContext

        sid = TaskContext.get().partitionId() << 36
        for batch in batches:
            for part in words.blocks(batch, text):
                w = words.Words(part.column(text), lower=True)
                at, seeds = [], []
                for i, mask in enumerate(masks):
                    first, h = _seed_hashes(w, mask, i)
                    hit = inside(filled.value, shift, h) if len(h) else np.zeros(0, bool)
                    at.append(first[hit])
                    seeds.append(h[hit])
                at, seeds = np.concatenate(at), np.concatenate(seeds)
                if not len(at):
                    continue
                order = np.argsort(at, kind="stable")
                at, seeds = at[order], seeds[order]
                owner = w.text[at]
                new = np.flatnonzero((np.diff(at, prepend=-1 - context) > context) | (np.diff(owner, prepend=-1) != 0))
                last = np.append(new[1:], len(at)) - 1
                doc = owner[new]
                begin = np.maximum(at[new] - context, w.bounds[doc])
                end = np.minimum(at[last] + context, w.bounds[doc + 1])
                packed = [w.joined(a, b) for a, b in zip(begin.tolist(), end.tolist())]
                inner = pa.StructArray.from_arrays(
                    [pa.array(seeds.view(np.int64)), pa.array((at - np.repeat(begin, last - new + 1)).astype(np.int32))], names=["seed", "at"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(sid, sid + len(new))), part.column(key).take(pa.array(doc)), pa.array(begin - w.bounds[doc]), pa.array(packed, pa.binary()),
                     pa.ListArray.from_arrays(pa.array(np.append(new, len(at)).astype(np.int32)), inner)],
                    names=["sid", "key", "first", "packed", "seeds"])
                sid += len(new)

    return docs.select(key, text).mapInArrow(run, f"sid long, key {kind}, first long, packed binary, seeds array<struct<seed:long,at:int>>")


def _best_run(same, tolerance):
    """(start, end) of the longest run that begins and ends with a match and in which at most ``tolerance`` differ."""
    total = np.concatenate([[0.0], np.cumsum(np.where(same, tolerance, tolerance - 1))])
    least = np.minimum.accumulate(total)
    first = np.searchsorted(-least, -total - 1e-9)
    end = int((np.arange(len(total)) - first).argmax())
    hits = np.flatnonzero(same[first[end] : end]) + first[end]
    return (int(hits[0]), int(hits[-1]) + 1) if len(hits) else (0, 0)


def _verified(tolerance):
    def run(batches):
        for batch in batches:
            for part in words.blocks(batch, "packed"):
                d = words.Words(part.column("packed").cast(pa.string()))
                b = words.Words(part.column("item_text"), lower=True)
                shift = part.column("diagonal").to_numpy()
                start, length, matched, size = [], [], [], np.diff(b.bounds)
                for i in range(part.num_rows):
                    x, y = d.hash[d.bounds[i] : d.bounds[i + 1]], b.hash[b.bounds[i] : b.bounds[i + 1]]
                    lo, hi = max(0, int(shift[i])), min(len(x), len(y) + int(shift[i]))
                    same = x[lo:hi] == y[lo - int(shift[i]) : hi - int(shift[i])]
                    s, e = _best_run(same, tolerance)
                    start.append(lo + s)
                    length.append(e - s)
                    matched.append(int(same[s:e].sum()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), part.column("item"), pa.array(part.column("first").to_numpy() + np.array(start, np.int64)), pa.array(length, pa.int64()),
                     pa.array(matched, pa.int64()), pa.array(size, pa.int64())],
                    names=["key", "item", "start", "length", "matched", "item_words"])

    return run


def overlaps(docs, items, text="text", key="doc_id", item_text="text", item_key="item_id", least=10, share=0.8, tolerance=0.2, masks=MASKS, context=CONTEXT):
    """Verified overlaps, one row for each document and item that share one: the longest, with its first word.

    An overlap is an ungapped run of words (ASCII letters lower-cased) in which
    at most ``tolerance`` differ and at least ``least`` match; of a shorter item
    ``share`` of its words must match.  It is looked at up to ``context`` words
    before and after a seed.  An item shorter than the shortest mask is found
    where all its words stand in a row; empty or null texts have no seed.
    Repeated rows of one key give one row; a null key is a key.
    """
    test = stored(items.select(F.col(item_key).alias("item_key"), F.col(item_text).alias("item_text")).where("item_text is not null")
                  .withColumn("_item", F.xxhash64("item_key", "item_text")).dropDuplicates(["_item"]))
    shortest = min(map(len, masks))
    size = F.size(F.filter(F.split("item_text", r"[\x20\x09-\x0D]+", -1), lambda x: x != ""))
    short = sorted(r["n"] for r in test.select(size.alias("n")).where(F.col("n").between(1, shortest - 1)).distinct().collect())  # at most the shortest mask's length
    masks, full = [*masks, *("1" * n for n in short)], len(masks)
    seeds = stored(_item_seeds(test, "item_text", masks, full))
    filled, shift = bitmap(seeds.select("seed").distinct(), "seed", per_hash=4096)
    found = stored(_stretches(docs, text, key, masks, filled, shift, context))
    hits = found.select("sid", F.explode("seeds").alias("s")).select("sid", "s.seed", F.col("s.at").alias("d_at"))
    lines = hits.join(seeds, "seed").select("sid", "item", (F.col("d_at") - F.col("at")).alias("diagonal")).distinct()
    both = lines.join(found.select("sid", "key", "first", "packed"), "sid").join(test.select(F.col("_item").alias("item"), "item_text"), "item")
    kind = docs.schema[key].dataType.simpleString()
    checked = both.select("key", "item", "first", "packed", "item_text", "diagonal").mapInArrow(
        _verified(tolerance), f"key {kind}, item long, start long, length long, matched long, item_words long")
    good = checked.where((F.col("matched") >= F.least(F.lit(float(least)), F.ceil(F.col("item_words") * share))) & (F.col("length") > 0))
    best = good.groupBy("key", "item", "item_words").agg(F.max(F.struct("matched", F.col("length"), (-F.col("start")).alias("start"))).alias("b"))
    named = best.join(test.select(F.col("_item").alias("item"), "item_key"), "item")
    return named.select(F.col("key").alias(key), F.col("item_key").alias(item_key), (-F.col("b.start")).alias("start"), F.col("b.length").alias("length"),
                        F.col("b.matched").alias("matched"), "item_words")


def clean(docs, items, text="text", key="doc_id", **options):
    """Rows of ``docs`` whose text has no verified overlap, with their columns as they are.

    Texts are told apart by two 64-bit hashes, so a null or repeated key (and any
    column name) is no matter.  Bad texts fill a bitmap: only rows that it passes
    enter the exact join, clean texts are not shuffled.
    """
    one, two = (lambda c: F.xxhash64(c)), (lambda c: F.xxhash64(F.lit(1), c))
    named = docs.select(F.struct(one(docs[text]).alias("a"), two(docs[text]).alias("b")).alias("key"), docs[text].alias("text"))
    bad = stored(overlaps(named, items, "text", "key", **options).select(F.col("key.a").alias("a"), F.col("key.b").alias("b")).distinct())
    filled, shift = bitmap(bad, "a")

    @F.pandas_udf("boolean")
    def maybe(hashes: pd.Series) -> pd.Series:
        return pd.Series(inside(filled.value, shift, hashes.to_numpy(np.int64).view(np.uint64)))

    passed = maybe(one(docs[text]))
    asked = docs.where(passed)
    return docs.where(~passed).unionByName(asked.join(bad, (one(asked[text]) == bad["a"]) & (two(asked[text]) == bad["b"]), "left_anti"))
