import collections
import hashlib
import itertools
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from estimand.llm import filter_audit, pair_bitmaps, queries, suffix_buckets, words
from llm_tables import words_of

SF = "/root/testdata/sf0.001"


# ---- filter audit --------------------------------------------------------------


def failed(text, again):
    w = words_of(text)
    return {
        "A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
        "D": bool(re.search("[#$%&*|]", text)), "E": again}


def brute_audit(rows, good, toxic):
    """Filters applied in turn, order by order."""
    own = []
    for key, text, part in rows:
        again = key is not None and any(k is not None and k < key and (x or "") == (text or "") for k, x, _ in rows)
        own.append((key, part or "", failed(text or "", again)))
    out, shapley = {}, collections.Counter()
    for part in {p for _, p, _ in own}:
        for order in itertools.permutations("ABCDE"):
            left = [(k, f) for k, p, f in own if p == part]
            for step, name in enumerate(order, 1):
                gone = [k for k, f in left if f[name]]
                every = [f for _, p, f in own if p == part]
                left = [(k, f) for k, f in left if not f[name]]
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(f[name] for f in every) - len(gone), sum(f[name] and sum(f.values()) == 1 for f in every),
                    sum(k in good for k in gone), sum(k in toxic for k in gone)]
                shapley[part, name] += len(gone)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


LONG = " ".join(f"word{i}" for i in range(60))
ROWS = [
    (1, LONG, "a"), (2, LONG, "b"), (3, LONG, None), (4, "same " * 70, "a"), (5, "SHOUT " * 10, "a"), (6, "x #", ""), (7, None, "b"), (8, "", "b"), (9, "", "a"),
    (None, LONG, "a"), (None, "", "b"), (10, LONG + " é漢 $", "b"), (10, LONG + " é漢 $", "b"), (11, LONG + " é漢 $", "b"), (12, " \t\n", "a"), (13, "W" * 400 + " " + LONG, "a")]


def test_audit_matches_filters_in_turn(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, source string").withColumns({c: F.lit("own") for c in ("key", "part", "mask", "good", "lo", "n", "s")})
    labels = spark.createDataFrame([(1, 1, 0), (5, 0, 1), (5, 1, 0), (8, None, 1), (11, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = {tuple(r[:3]): tuple(r[3:]) for r in filter_audit.audit(docs.repartition(4), labels).collect()}
    assert got == brute_audit(ROWS, {1, 5, 11}, {5, 8})


def test_audit_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(docs, labels).count() == 0


@pytest.mark.parametrize("m", [2, 3, 5])
def test_shapley_weights_are_those_of_the_orders(m):
    """Least squares with the efficiency constraint gives the average over all orders, for every coalition table."""
    weights = filter_audit.shapley_weights(m)
    v = [0] + [(s * 2654435761 >> 3) % 1000 for s in range(1, 1 << m)]
    for i in range(m):
        by_order = 0
        for order in itertools.permutations(range(m)):
            before = sum(1 << x for x in order[: order.index(i)])
            by_order += v[before | 1 << i] - v[before]
        assert sum(c * x for c, x in zip(weights[i], v)) == by_order


# ---- repeated byte strings -----------------------------------------------------


def brute_bytes(rows, window):
    texts = [(text or "").encode() for _, text in rows]
    seen = collections.Counter(x[i : i + window] for x in texts for i in range(len(x) - window + 1))
    out = []
    for (key, _), x in zip(rows, texts):
        gone = bytearray(len(x))
        for i in range(len(x) - window + 1):
            if seen[x[i : i + window]] > 1:
                gone[i : i + window] = b"\1" * window
        kept = bytes(c for c, g in zip(x, gone) if not g)
        out.append((key, len(x), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def digest_rows(kept):
    found = kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("h")).collect()
    return sorted([tuple(r) for r in found], key=str)


def passages(seed):
    """Texts that share passages of all lengths, repeat themselves, differ in one letter or are equal."""
    rng = np.random.default_rng(seed)
    text = lambda n: "".join(rng.choice(list("abcdeé漢 \n"), n))
    common = [text(int(n)) for n in rng.integers(5, 60, 8)]
    rows = [(i, text(int(rng.integers(0, 40))) + common[int(rng.integers(8))] + text(int(rng.integers(0, 40))) + common[int(rng.integers(8))]) for i in range(120)]
    long = text(90)
    rows += [(200 + i, long[:i] + "X" + long[i + 1 :]) for i in range(30)]
    return rows + [(300, None), (301, ""), (302, "a" * 300), (None, long), (303, rows[0][1]), (303, rows[0][1]), (304, text(3000)), (305, "b" * 19), (306, "b" * 20), (307, "c" * 21)]


@pytest.mark.parametrize("pieces", [(8, 3, 1), (1,), (64, 1)])
def test_repeated_bytes_match_brute_force(spark, monkeypatch, pieces):
    monkeypatch.setattr(suffix_buckets, "BLOCK_BYTES", 700)
    rows = passages(len(pieces))
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("d1", "d2", "start", "n", "key", "spans", "kept")})
    got = digest_rows(suffix_buckets.remove_repeats(docs.repartition(3), window=20, q=5, pieces=pieces))
    assert got == brute_bytes(rows, 20)


def test_repeated_bytes_of_the_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = sorted([tuple(r) for r in queries.QUERIES["op13_suffix_buckets"](spark, SF).collect()], key=str)
    assert got == brute_bytes(rows, 400)


def test_no_repeats_in_an_empty_table(spark):
    assert suffix_buckets.remove_repeats(spark.createDataFrame([], "doc_id string, text string")).count() == 0


def test_a_block_of_suffixes_takes_bounded_memory():
    rng = np.random.default_rng(4)
    texts = [bytes(rng.integers(97, 123, n, dtype=np.uint8)).decode() for n in (0, 399, 400, 2_000, 900_000)]
    batch = pa.RecordBatch.from_pydict({"text": [None, *texts]})
    list(suffix_buckets._blocks(batch, 400)), words.powers(words._BASE, 1 << 20)
    tracemalloc.start()
    windows = sum(len(suffix_buckets.Suffixes(data, at, 400, 32).start) for data, at, _, _ in suffix_buckets._blocks(batch, 400))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert windows == sum(max(0, len(x) - 399) for x in texts) and peak < 16e6


@pytest.mark.parametrize("window, q", [(20, 5), (20, 20), (8, 1), (33, 2)])
def test_anchor_is_the_least_q_gram_of_a_window(window, q):
    data = np.random.default_rng(window).integers(97, 100, 500, dtype=np.uint8)
    at = np.array([0, 0, 200, 210, 500])
    s = suffix_buckets.Suffixes(data, at, window, q)
    place = np.arange(len(data) - q + 1)
    key = words.mix(s.one.of(place, place + q)) & ~np.uint64(suffix_buckets._PLACE)
    starts = [i for a, b in zip(at, at[1:]) for i in range(a, b - window + 1)]
    assert s.start.tolist() == starts
    assert s.anchor.tolist() == [i + int(np.argmin(key[i : i + window - q + 1])) for i in starts]


# ---- alignment of two tokenizers -----------------------------------------------


def brute_alignment(rows):
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    letters = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(c): c for c in letters} | {chr(256 + i): c for i, c in enumerate(c for c in range(256) if c not in letters)}

    def piece(i):
        x = b.id_to_piece(i)
        return bytes([int(x[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", x) else x.replace("▁", " ").encode()

    found, holders = [], collections.Counter()
    for key, text in rows:
        groups = []
        if text:
            ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            bytes_a = [bytes(byte[c] for c in a.id_to_token(i)) for i in ids_a]
            bytes_b = [piece(i) for i in ids_b]
            if b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
                ends_a, ends_b = (np.cumsum([len(x) for x in y]).tolist() for y in (bytes_a, bytes_b))
                i = j = 0
                for end in sorted(set(ends_a) & set(ends_b)):
                    x, y = ends_a.index(end, i) + 1, ends_b.index(end, j) + 1
                    groups.append((ids_a[i:x], ids_b[j:y]))
                    i, j = x, y
        links = collections.Counter((x, y) for g in groups for x in g[0] for y in g[1])
        holders.update(links.keys())
        found.append((key, groups, links))
    top = collections.Counter()
    for (x, _), n in holders.items():
        top[x] = max(top[x], n)
    out = []
    for key, groups, links in found:
        line = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((key, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), sum(links.values()),
                    sum(n for p, n in links.items() if holders[p] == top[p[0]]), sum(n * holders[p] for p, n in links.items()),
                    hashlib.sha256(line.encode()).hexdigest() if groups else ""))
    return sorted(out, key=str)


TEXTS = [
    "Hello world", "  two  spaces ", "line\nbreak\n\nand\ttab", "<|endoftext|> and <s> </s> <unk> <0x41>", "é漢字かな 🙂 naïve ﬁ", "under▁score", "no\xa0break \x0b x", "\n", " ", "a", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaa" * 9,
    "漢" * 50, "word " * 300, "\r\n mixed   ends", "x" * 3000, "Ünïcödé ẞ ́ combining", "trailing space ", "tab\t\tx y", "12345 67890 3.14159", "don't can't won't I'll"]


def test_alignment_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(pair_bitmaps, "SLICE", 50)
    monkeypatch.setattr(pair_bitmaps, "BLOCK_BYTES", 300)
    rows = [*enumerate(TEXTS), (50, None), (51, ""), (52, TEXTS[0]), (52, TEXTS[0]), (None, TEXTS[4])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("own") for c in ("rid", "key", "chunk", "pair", "docs", "plane")})
    got = sorted([tuple(r) for r in pair_bitmaps.align(docs.repartition(3)).collect()], key=str)
    assert got == brute_alignment(rows)


def test_alignment_of_the_documents(spark, monkeypatch):
    """Small chunks, so that wide bitmaps and several chunks of a task occur."""
    monkeypatch.setattr(pair_bitmaps, "DOCS", 64)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = sorted([tuple(r) for r in queries.QUERIES["op11_pair_bitmaps"](spark, SF).collect()], key=str)
    assert got == brute_alignment(rows)


def test_alignment_of_an_empty_table(spark):
    assert pair_bitmaps.align(spark.createDataFrame([], "doc_id long, text string")).count() == 0
