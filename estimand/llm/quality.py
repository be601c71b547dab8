"""Quality classifier: hashed word n-grams, logistic regression by follow-the-regularised-leader updates.

N-grams are taken of the words and of their forms: a form keeps the order of
letters, capitals, digits and signs of a word but not which or how many
(``Then,`` and ``Road,`` share one).  So what is learned from a bounded sample
also holds for words never seen.  A pair of equal neighbours is a feature too.
"""

import numpy as np
from pyspark.sql import functions as F

from estimand.llm import linear, words

SAMPLE = 20_000
THRESHOLD = 0.7
#: Factor on relative counts, so that one pass of updates moves the weights enough.
SCALE = 8.0

_FORM = np.arange(256, dtype=np.uint8)
_FORM[97:123] = _FORM[128:] = 1
_FORM[65:91] = 2
_FORM[48:58] = 3


def _forms(w):
    """64-bit hashes of the forms of all words."""
    kind = _FORM[w.data]
    turn = np.ones(len(kind), bool)
    turn[1:] = kind[1:] != kind[:-1]
    turn[w.start] = True
    rank = np.concatenate([[0], np.cumsum(turn)])
    sums = words.Sums(words._VALUES[kind[turn]], words.STEPS[1])
    return words.mix(sums.of(rank[w.start], rank[w.end]))


def features(texts):
    w = words.Words(texts)
    rows = len(w.bounds) - 1
    lower = words.mix(words.Sums(words._VALUES[words._LOWER[w.data]], words.STEPS[0]).of(w.start, w.end))
    form, size = _forms(w), np.diff(w.bounds)
    pair = w.windows(2)
    with np.errstate(divide="ignore"):
        share, pair_share = (SCALE / n for n in (size.astype(float), size - 1.0))
    text, pair_text = w.text, w.text[pair]
    two = words.mix(form[pair] * np.uint64(3) + form[pair + 1])
    same = (w.hash[pair] == w.hash[pair + 1]).astype(np.uint64)
    parts = [(text, linear.hashed(lower, 1), share[text]), (text, linear.hashed(form, 2), share[text]),
             (pair_text, linear.hashed(two, 3), pair_share[pair_text]), (pair_text, linear.hashed(same, 4), pair_share[pair_text])]
    return linear.merged(*(np.concatenate([p[k] for p in parts]) for k in range(3)), rows)


def fit(docs, labels, text="text", key="doc_id", label="quality", sample=SAMPLE, rounds=4):
    """Weights learned from at most ``sample`` labelled rows that are not held out; all zero where there is none."""
    rows = linear.featurised(linear.labelled(docs, labels, label, sample, text, key), features)
    state = linear.trained(rows, linear.Ftrl(1 << linear.BITS, alpha=1.0, l1=0.02), linear.logistic_step, rounds)
    return state.weights()


def score(docs, weights, text="text", keep=("doc_id",), threshold=THRESHOLD):
    """``keep`` columns, ``score`` (0 to 1, higher: the label 1 is likelier) and ``predicted`` (1 from ``threshold`` on).

    Null and empty texts have the score of a text without features.  Repeated
    rows score alike; keys, labels and other columns never enter a score.
    """
    def finish(dot):
        p = 1 / (1 + np.exp(-np.clip(dot, -35, 35)))
        return {"score": p, "predicted": (p >= threshold).astype(np.int32)}

    return linear.scored(docs, text, list(keep), features, weights, "score double, predicted int", finish)


def keep_good(docs, labels, text="text", key="doc_id", threshold=0.5):
    """Rows of ``docs`` whose score reaches ``threshold``; all columns, in their order.

    The threshold is lower than that of a report: only a text that is more likely bad than good goes.
    """
    weights = fit(docs, labels, text, key)
    # by place, so that no column is taken for a score, and each text is sent to Python once
    place = {c: f"_{i}" for i, c in enumerate(docs.columns)}
    rows = docs.select(*[F.col(f"`{c}`").alias(x) for c, x in place.items()], *([] if text in place else [F.col(text).alias("_text")]))
    found = score(rows, weights, place.get(text, "_text"), tuple(place.values()), threshold)
    return found.where("predicted = 1").select(*[F.col(x).alias(c) for c, x in place.items()])
