import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from estimand.llm import best_fit, packed_ids, tokens
from llm_tables import ids_of, sizes

SF = "/root/testdata/sf0.001"


def check_sequences(rows, capacity=2048):
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for found in places.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=" \n\t a'sé1.!Z\x0b\x1c 　漢<|", max_size=14), max_size=8))
def test_segments_have_the_ids_of_the_whole_text(texts):
    enc = tokens.encoder()
    flat, at = enc.block(pa.array(texts, pa.string()))
    for i, text in enumerate(texts):
        assert flat[at[i] : at[i + 1]].tolist() == enc.model.encode(text, add_special_tokens=False).ids


def test_special_string_is_left_to_the_json_tokenizer():
    enc = tokens.encoder()
    flat, at = enc.block(pa.array(["a <|endoftext|> b", None, "x"]))
    assert flat[: at[1]].tolist() == enc.model.encode("a <|endoftext|> b", add_special_tokens=False).ids and at[1] == at[2]


@settings(max_examples=100, deadline=None)
@given(sizes)
def test_best_fit_and_bounds(lengths):
    bins, offsets = best_fit.best_fit_decreasing(lengths, 20)
    fill = np.bincount(bins, weights=lengths)
    assert fill.max() <= 20
    bound = best_fit.lower_bound(np.bincount(lengths, minlength=21), 20)
    assert -(-sum(lengths) // 20) <= bound <= len(fill)
    rows = packed_ids.pack_window(lengths, 20)
    assert sorted(i for r in rows for i in r) == list(range(len(lengths))) and max(sum(lengths[i] for i in r) for r in rows) <= 20
    assert len(rows) == len(fill)


def test_bound_certifies_halves_and_thirds():
    assert best_fit.lower_bound(np.bincount([11] * 7, minlength=21), 20) == 7
    assert best_fit.lower_bound(np.bincount([7] * 7, minlength=21), 20) == 4


def test_documents_are_packed_whole(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = best_fit.pack_documents(docs).collect()
    used = check_sequences(rows)
    per = defaultdict(list)
    for r in rows:
        per[r.doc_id].append(r)
    total = 0
    for d in docs.collect():
        ids = ids_of(d.text)
        found = sorted(per[d.doc_id], key=lambda r: r.piece)
        total += len(ids)
        assert [r.piece for r in found] == list(range(len(found)))
        assert b"".join(ids[r.start : r.start + r.length].tobytes() for r in found) == ids.tobytes()
        assert all(zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32 for r in found)
        assert len(ids) <= 2048 and len(found) == 1 or all(r.length == 2048 for r in found[1:])
    assert used <= -(-total // 2048) + 2


def test_gaps_are_packed_again(spark):
    rng = np.random.default_rng(1)
    rows = spark.createDataFrame([(i, int(n)) for i, n in enumerate(rng.integers(300, 1500, 3000))], "rid long, length long")
    one = best_fit.repack(rows, per_partition=100, min_gain=0.0).collect()
    first = best_fit._packed(rows, 0, 30, 2048).select("sequence_id").distinct().count()
    assert len(one) == 3000 and check_sequences(one) < first


def test_odd_rows(spark, odd, none):
    rows = best_fit.pack_documents(odd).collect()
    assert sorted((r.doc_id or 0, r.length) for r in rows if r.doc_id in (2, 3)) == [(2, 1), (3, 1)]
    assert sum(r.doc_id == 5 for r in rows) == 2 and sum(r.doc_id is None for r in rows) == 1
    check_sequences(rows)
    assert best_fit.pack_documents(none).count() == 0 and packed_ids.pack_ids(none).count() == 0
    assert sum(len(r["keys"]) for r in packed_ids.pack_ids(odd).collect()) == 9


@pytest.mark.parametrize("window", [4 << 20, 6000])
def test_matrices_round_trip(spark, window):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    packed = packed_ids.pack_ids(docs, window=window)
    for r in packed.collect():
        assert len(r.ids) == 4096 and r.cu_seqlens[-1] == r.n_tokens and zlib.crc32(bytes(r.ids)) == r.ids_crc32
        pos = packed_ids.positions(r.cu_seqlens, r.position_starts)
        assert all(pos[a] == s for a, s in zip(r.cu_seqlens, r.position_starts))
    again = {r.doc_id: bytes(r.ids) for r in packed_ids.unpack(packed).collect()}
    assert again == {d.doc_id: ids_of(d.text).tobytes() for d in docs.collect()}
