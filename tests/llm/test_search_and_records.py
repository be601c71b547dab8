import numpy as np
import pytest

import corpus_pipeline
from estimand.llm import hnsw, queries, revisit
from llm_tables import ids_of, words_of


def brute(rows, k, every):
    keys = np.array([r[0] for r in rows])
    x = np.array([r[1] for r in rows], float)
    out = {}
    for i in np.flatnonzero(keys % every == 0):
        score = (x * x[i]).sum(axis=1)
        order = [j for j in np.lexsort((keys, -score)) if keys[j] != keys[i]][:k]
        out[int(keys[i])] = [int(keys[j]) for j in order]
    return out


@pytest.mark.parametrize("scale", [0.0, 1.0])
def test_recall_and_exact_scores(spark, scale):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 16))
    rows = [(i, (centres[i % 12] + rng.normal(size=16) * 0.4) * (1 + scale * rng.random())) for i in range(3000)]
    rows = [(i, [float(v) for v in x]) for i, x in rows]
    got = {}
    for r in hnsw.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    want, by = brute(rows, 20, 20), dict(rows)
    hits = sum(len({v for _, v, _ in got[q]} & set(w)) for q, w in want.items())
    assert set(got) == set(want) and hits >= 0.9 * 20 * len(want)
    for q, found in got.items():
        found.sort()
        assert [r for r, _, _ in found] == list(range(1, 21))
        assert all(abs(s - np.dot(by[q], by[v])) < 1e-9 for _, v, s in found)
        assert [(-s, v) for _, v, s in found] == sorted((-s, v) for _, v, s in found)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [None, 1.0]), (7, [inf, 1.0]), (8, [0.5, 0.5]),
            (20, [1.0, 0.0]), (20, [1.0, 0.0]), (40, [1.0, 2.0, 3.0]), (None, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in hnsw.nearest(df).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    assert {q: [v for _, v in sorted(f)] for q, f in got.items()} == {0: [1, 20, 8], 20: [0, 1, 8]}
    assert hnsw.nearest(df.limit(0)).count() == 0


def test_many_equal_vectors(spark):
    rows = [(i, [1.0, 0.0, 0.0]) for i in range(400)] + [(400 + i, [0.0, 1.0, float(i)]) for i in range(50)]
    got = {}
    for r in hnsw.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    assert [v for _, v in sorted(got[100])] == list(range(20)) and [v for _, v in sorted(got[0])] == list(range(1, 21))


# ---- revisits ----------------------------------------------------------------

SCHEMA = "record_id long, kind string, url string, ts long, etag string, last_modified string, headers map<string,string>"


def test_revisits_of_one_hot_url(spark):
    rng = np.random.default_rng(9)
    rows = [(i, "response" if rng.random() < 0.1 else "revisit", "http://WWW.a.org:80/x/?utm_source=q#f" if i % 2 else "https://a.org/x", int(rng.integers(0, 300)), "e", None, {"date": str(i)}) for i in range(3000)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    full = sorted((r[3], r[0]) for r in rows if r[1] == "response")
    for r in revisit.resolve(df).collect():
        before = [k for k in full if k[0] < r.ts]
        assert r.canonical == "a.org/x" and r.refers_to == (before[-1][1] if before else None)


def test_validators_headers_and_nulls(spark):
    rows = [
        (1, "response", "a.org", 1, '"x"', "d1", {"date": "1", "content-length": "9", "server": "s"}), (2, "revisit", "http://a.org/", 2, 'W/"x"', "d9", {"date": "2", "content-length": "0"}),
        (3, "revisit", "a.org", 3, '"y"', None, None), (4, "revisit", "a.org", 3, None, "d1", None), (5, "revisit", "a.org", 3, None, "d2", None), (6, "revisit", "a.org", 3, None, None, None),
        (7, "revisit", "a.org", 1, '"x"', None, None), (8, "revisit", None, 3, '"x"', None, None), (9, "revisit", "a.org", None, '"x"', None, None), (2, "revisit", "http://a.org/", 2, 'W/"x"', "d9", None),
        (10, "other", "a.org", 5, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted((r.record_id, r.status, r.refers_to) for r in revisit.resolve(df).collect())
    assert got == [(2, "matched", 1), (2, "matched", 1), (3, "etag_mismatch", 1), (4, "matched", 1), (5, "modified", 1), (6, "unchecked", 1), (7, "no_response", None), (8, "no_response", None), (9, "no_response", None)]
    merged = [r.merged for r in revisit.resolve(df).collect() if r.record_id == 2]
    assert {"date": "2", "content-length": "9", "server": "s"} in merged and all(r.merged is None for r in revisit.resolve(df).collect() if r.record_id in (3, 5, 8))
    assert revisit.resolve(df.limit(0)).count() == 0


def test_registered_revisits_match_sql(spark):
    from oracle import compare, connect

    sf = "/root/testdata/sf0.01"
    assert compare(spark, connect(sf), queries.QUERIES["op5_revisit_resolution"], queries.ORACLES["op5_revisit_resolution"], sf) is None


# ---- pipeline ----------------------------------------------------------------


def test_pipeline_stages_against_brute_force(spark):
    from estimand.plans.prefix import stored
    from test_text_operators import base_spans, brute_components

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    items = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    state = docs
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in state.collect()}
        state = stored(stage(spark, state, sf))
        if "packing" in name:
            tokens = sum(len(ids_of(t)) for t in before.values())
            assert sum(r.length for r in state.collect()) == tokens
            break
        assert state.dtypes == docs.dtypes
        after = {r.doc_id: r.text for r in state.collect()}
        assert set(after) <= set(before) and len(after) == state.count()
        gone = set(before) - set(after)
        if "quality" in name:
            assert sum(labels.get(d) == 1 for d in gone) <= 0.02 * len(before)
        elif "Jaccard" in name:
            assert set(after) == {c for _, c in brute_components(list(before.items()), 5, 80).values()}
        elif "benchmark" in name:
            assert {d for d, t in before.items() if any(i in t for i in items)} <= gone
            grams = lambda t: {tuple(w[k : k + 5]) for w in [words_of(t, True)] for k in range(len(w) - 4)}
            known = set().union(*map(grams, items))
            assert all(grams(before[d]) & known for d in gone)
        elif "secret" in name:
            assert not gone and all((after[d] == before[d]) == (not base_spans(before[d])) or "[secret]" in after[d] for d in after)
            assert not any(base_spans(t) for t in after.values())


def test_pipeline_leaves_only_the_tables_of_its_last_stage(spark):
    from estimand.plans.prefix import release_all, stored_paths

    sf = "/root/testdata/sf0.001"
    release_all(spark)
    result = corpus_pipeline.run(spark, sf)
    assert result.count() > 0
    assert set(stored_paths()) >= set(corpus_pipeline._LEFT[sf]) and len(stored_paths()) <= len(corpus_pipeline._LEFT[sf]) + 1
    release_all(spark)
    assert stored_paths() == []
