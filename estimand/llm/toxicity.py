"""Toxicity: cumulative-link ordinal regression on sparse text features.

P(grade <= k) = sigma(t_k - w.x): one weight vector for all grades and ordered
thresholds t_0 < t_1 < ...  Features are the words present in a text, without
signs at their ends, and their first bytes (stems).  Labels say only toxic or
not; the severity of a toxic training row is the number of different words in it
that the sample shows mostly in toxic rows, cut into grades at its quantiles.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from estimand.llm import linear, words
from estimand.plans.prefix import stored

SAMPLE = 20_000
GRADES = 3
STEMS = (4, 5, 6)
#: Toxic texts are the rarer class, which pulls their probability down.
THRESHOLD = 0.4
#: A word tells of toxicity if it is in this many toxic sample rows at least, and this many times likelier there.
CUE_ROWS, CUE_RATIO = 4, 10.0

_SIGN = np.zeros(256, bool)
_SIGN[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


def _trimmed(texts):
    w = words.Words(texts, lower=True)
    start, end = w.start.copy(), w.end.copy()
    for _ in range(6):
        end -= (end - start > 1) & _SIGN[w.data[end - 1]] if len(end) else 0
        start += (end - start > 1) & _SIGN[w.data[start]] if len(end) else 0
    return w, start, end


def _word_numbers(texts):
    """(text, feature) of the distinct words of each text."""
    w, start, end = _trimmed(texts)
    return w, start, end, linear.hashed(w.bytes.of(start, end) + (end - start).astype(np.uint64), 1)


def features(texts):
    w, start, end, word = _word_numbers(texts)
    parts = [(w.text, word)]
    for k in STEMS:
        long = np.flatnonzero(end - start >= k)
        parts.append((w.text[long], linear.hashed(w.bytes.of(start[long], start[long] + k), 10 + k)))
    text, number = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
    cut, at, x = linear.merged(text, number, np.ones(len(text)), len(w.bounds) - 1)
    return cut, at, np.ones(len(x))


def _graded(sample):
    """Sample rows with y = 0 or a grade 1..GRADES from the number of cue words; also written where nothing is toxic."""

    def run(batches):
        for batch in batches:
            for part in words.blocks(batch):
                w, _, _, word = _word_numbers(part.column("text"))
                cut, at, _ = linear.merged(w.text, word, np.ones(len(word)), part.num_rows)
                own = np.repeat(np.arange(part.num_rows), np.diff(cut))
                yield pa.RecordBatch.from_arrays([part.column("row_hash").take(pa.array(own)), part.column("y").take(pa.array(own)), pa.array(at.astype(np.int32))],
                                                 names=["row_hash", "y", "word"])

    seen = stored(sample.mapInArrow(run, "row_hash long, y double, word int"))
    total = sample.agg(F.sum("y").alias("toxic"), F.count(F.lit(1)).alias("n")).first()
    toxic, clean = total["toxic"] or 0.0, (total["n"] or 0) - (total["toxic"] or 0.0)
    rate = (F.col("hit") / max(toxic, 1.0)) / ((F.col("n") - F.col("hit") + 0.5) / max(clean, 1.0))
    cues = seen.groupBy("word").agg(F.sum("y").alias("hit"), F.count(F.lit(1)).alias("n")).where((F.col("hit") >= CUE_ROWS) & (rate >= CUE_RATIO)).select("word")
    strength = seen.where("y = 1").join(cues, "word").groupBy("row_hash").agg(F.count(F.lit(1)).alias("strength"))
    cuts = strength.agg(F.percentile("strength", [i / GRADES for i in range(1, GRADES)])).first()[0] or []
    grade = F.lit(1) + sum((F.coalesce("strength", F.lit(0)) > c).cast("int") for c in cuts)
    joined = sample.join(strength, "row_hash", "left")
    return joined.select("row_hash", "text", F.when(F.col("y") == 1, grade).otherwise(F.lit(0)).cast("double").alias("y"))


def _sigma(v):
    return 1 / (1 + np.exp(-np.clip(v, -35, 35)))


def ordinal_step(state, y, at, x):
    """One update of weights and thresholds; thresholds stay in order with a gap of at least 0.1."""
    s, t, y = state.weights(at) @ x, state.extra, int(y)
    upper, lower = _sigma(t[y] - s) if y < len(t) else 1.0, _sigma(t[y - 1] - s) if y else 0.0
    p = max(upper - lower, 1e-9)
    up, down = upper * (1 - upper), lower * (1 - lower)
    slope = np.zeros(len(t))
    if y < len(t):
        slope[y] = -up / p
    if y:
        slope[y - 1] = down / p
    state.update(at, x, float(np.clip((up - down) / p, -5, 5)), np.clip(slope, -5, 5))
    state.extra[:] = np.maximum.accumulate(state.extra - 0.1 * np.arange(len(t))) + 0.1 * np.arange(len(t))


def fit(docs, labels, text="text", key="doc_id", label="toxic", sample=SAMPLE, rounds=4):
    """(weights, thresholds) from at most ``sample`` labelled rows that are not held out.

    Without labelled rows all weights are zero and every text gets the same severity.
    """
    rows = linear.featurised(_graded(stored(linear.labelled(docs, labels, label, sample, text, key))), features)
    state = linear.Ftrl(1 << linear.BITS, extra=np.arange(GRADES, dtype=float), alpha=0.3, l1=4.0)
    linear.trained(rows, state, ordinal_step, rounds)
    return state.weights(), np.maximum.accumulate(state.extra)


def score(docs, model, text="text", keep=("doc_id",), threshold=THRESHOLD):
    """``keep`` columns, ``expected_severity`` (0 to the highest grade), ``score`` (probability of any grade above 0), ``grade`` (likeliest) and ``toxic``.

    ``toxic`` is true where ``score`` is ``threshold`` or more.  Null and empty texts have
    the score of a text without words; repeated rows score alike.
    """
    weights, thresholds = model

    def finish(dot):
        above = _sigma(dot[:, None] - thresholds[None, :])
        grades = np.diff(np.concatenate([np.ones((len(dot), 1)), above, np.zeros((len(dot), 1))], axis=1), axis=1) * -1
        return {"expected_severity": above.sum(axis=1), "score": above[:, 0].copy(), "grade": grades.argmax(axis=1).astype(np.int32), "toxic": above[:, 0] >= threshold}

    return linear.scored(docs, text, list(keep), features, weights, "expected_severity double, score double, grade int, toxic boolean", finish)
