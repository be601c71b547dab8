"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of ``documents``.  ``run`` writes each stage's rows to the
shared folder and reads them again for the next.
"""

import functools

from estimand.llm import best_fit, decontaminate, jaccard_join, quality, secret_scan
from estimand.plans.prefix import release, release_all, stored, stored_paths

#: A document goes only if it is more likely bad than good.
REJECT_BELOW = 0.5


#: Tables that the last stage has left in the shared folder, by the folder of the input.
_LEFT = {}


def stage(fn):
    """A stage's rows are written before the next one starts: the next one first deletes the tables that they were read from.

    The first stage follows none, and what the last one leaves stays, since its
    rows may be read at any time.
    """

    @functools.wraps(fn)
    def run_stage(spark, docs, sf_dir):
        old = set(_LEFT.pop(sf_dir, ()))
        if fn.__name__ != "good_documents":
            release_all(spark, [x for x in stored_paths() if x not in old])
        before = set(stored_paths())
        out = fn(spark, docs, sf_dir)
        _LEFT[sf_dir] = [x for x in stored_paths() if x not in before]
        return out

    return run_stage


@stage
def good_documents(spark, docs, sf_dir):
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), threshold=REJECT_BELOW)


@stage
def one_of_near_duplicates(spark, docs, sf_dir):
    return jaccard_join.keep_one(docs, n=5, percent=80)


@stage
def without_benchmark(spark, docs, sf_dir):
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@stage
def without_secrets(spark, docs, sf_dir):
    return secret_scan.redact(docs)


@stage
def packed(spark, docs, sf_dir):
    return best_fit.pack_documents(docs)


STAGES = [
    ("quality classifier", good_documents),
    ("n-gram Jaccard join", one_of_near_duplicates),
    ("benchmark decontamination", without_benchmark),
    ("secret scans", without_secrets),
    ("best-fit packing", packed),
]

#: A classifier's weights and a tokenizer have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for i, (_, stage_of) in enumerate(STAGES):
        docs = stage_of(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs)
            if last is not None:
                release(last)
            last = docs
    return docs
