"""Registered queries of this subpackage: each applies one operator to its whole table."""

from pyspark.sql import functions as F

from estimand.llm import best_fit, decontaminate, filter_audit, hnsw, jaccard_join, linear, packed_ids, pair_bitmaps, quality, revisit, secret_scan, suffix_buckets, superkmer, toxicity

QUERIES, ORACLES = {}, {}


def query(name, sql=None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


def t(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query("op9_secret_scan")
def op9_secret_scan(spark, sf):
    return secret_scan.digest(secret_scan.scan(t(spark, sf, "documents")))


@query("op2_best_fit_packing")
def op2_best_fit_packing(spark, sf):
    packed = best_fit.pack_documents(t(spark, sf, "documents"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "bins", "bound")


@query("op10_packed_ids")
def op10_packed_ids(spark, sf):
    return packed_ids.pack_ids(t(spark, sf, "documents")).withColumnRenamed("keys", "doc_ids")


OP6_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(list_slice(w, i, i + 3), ' ')) END)) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * m >= 85 * (x.n + y.n - m)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(doc_id, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.doc_id AND r.c < e.b)
SELECT d.doc_id, coalesce(max(n.n), 0)::BIGINT AS n_shingles, min(r.c) AS component_id FROM documents d LEFT JOIN n USING (doc_id) JOIN r ON r.doc_id = d.doc_id GROUP BY d.doc_id
"""


@query("op6_jaccard_join", OP6_SQL)
def op6_jaccard_join(spark, sf):
    return jaccard_join.classes(t(spark, sf, "documents"), n=4, percent=85)


OP8_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, unnest(range(1, len(w) - 48)) AS i, unnest(list_transform(range(1, len(w) - 48), lambda i: md5(array_to_string(list_slice(w, i, i + 49), ' ')))) AS h FROM w WHERE len(w) >= 50),
f AS (SELECT h, min(doc_id) AS low FROM s GROUP BY h HAVING count(DISTINCT doc_id) > 1),
g AS (SELECT s.doc_id, unnest(range(s.i, s.i + 50)) AS pos FROM s JOIN f ON f.h = s.h AND low < doc_id),
c AS (SELECT doc_id, list(DISTINCT pos) AS gone FROM g GROUP BY 1),
k AS (SELECT w.doc_id, w, coalesce(gone, []) AS gone FROM w LEFT JOIN c USING (doc_id)),
m AS (SELECT k.doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM k),
t AS (SELECT m.doc_id, string_agg(word, ' ' ORDER BY m.pos) AS kept FROM m LEFT JOIN (SELECT DISTINCT doc_id, pos FROM g) x ON x.doc_id = m.doc_id AND x.pos = m.pos WHERE x.pos IS NULL GROUP BY 1)
SELECT k.doc_id, len(w)::BIGINT AS n_words, len(gone)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM k LEFT JOIN t USING (doc_id)
"""


@query("op8_superkmer_dedup", OP8_SQL)
def op8_superkmer_dedup(spark, sf):
    kept = superkmer.remove_repeats(t(spark, sf, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op1_spaced_seed_decontamination")
def op1_spaced_seed_decontamination(spark, sf):
    return decontaminate.overlaps(t(spark, sf, "documents"), t(spark, sf, "benchmark"))


@query("op7_quality_classifier")
def op7_quality_classifier(spark, sf):
    docs = t(spark, sf, "documents").select("doc_id", "text")
    found = quality.score(docs, quality.fit(docs, t(spark, sf, "labels")))
    return found.select("doc_id", linear.held_out("doc_id").alias("held_out"), "score", "predicted")


@query("op4_toxicity")
def op4_toxicity(spark, sf):
    docs = t(spark, sf, "documents").select("doc_id", "text")
    return toxicity.score(docs, toxicity.fit(docs, t(spark, sf, "labels")))


@query("op3_hnsw_search")
def op3_hnsw_search(spark, sf):
    return hnsw.nearest(t(spark, sf, "embeddings"))


def captures(pages):
    """Records made of the pages: each is one full response, later (for some also earlier) visited again.

    Times, validators and headers follow from the page's number and content.
    Every third page is seen again changed, every fifth without an entity tag.
    """
    p, tag = F.col("page_id"), F.concat(F.lit('"'), F.md5("html"), F.lit('"'))
    base, day = p * 7919 % 100000, F.concat(F.lit("day "), p % 50)
    header = lambda *kv: F.create_map(*[F.lit(x) if isinstance(x, str) else x for x in kv])
    record = lambda number, kind, ts, etag, modified, headers: F.struct(
        (p * 4 + number).alias("record_id"), F.lit(kind).alias("kind"), "url", ts.alias("ts"), etag.alias("etag"), modified.alias("last_modified"), headers.alias("headers"))
    none = F.lit(None).cast("string")
    made = F.array(
        record(0, "response", base, F.when(p % 7 != 0, tag), day, header("content-type", "text/html", "content-length", F.length("html").cast("string"), "date", base.cast("string"), "vary", "accept")),
        record(1, "revisit", base + 50 + p % 500, F.concat(F.lit("W/"), tag), none, header("date", (base + 50).cast("string"), "cache-control", "max-age=60", "content-length", "0")),
        record(2, "revisit", base + 1000, F.concat(F.lit('"'), p.cast("string"), F.lit('"')), day, header("date", "never", "expires", "0")),
        record(3, "revisit", base - 10, none, F.concat(F.lit("day "), p % 25), header("etag", "new", "server", "other")))
    wanted = F.filter(made, lambda r: (r["record_id"] % 4 < 2) | ((r["record_id"] % 4 == 2) & (p % 3 == 0)) | ((r["record_id"] % 4 == 3) & (p % 5 == 0)))
    return pages.select("page_id", "url", "html").select(F.inline(wanted))


OP5_SQL = r"""
WITH p AS (SELECT page_id AS p, url, '"' || md5(html) || '"' AS tag, page_id * 7919 % 100000 AS base, 'day ' || (page_id % 50) AS day, length(html) AS n FROM pages),
recs AS (
  SELECT p * 4 AS record_id, 'response' AS kind, url, base AS ts, CASE WHEN p % 7 <> 0 THEN tag END AS etag, day AS last_modified,
         MAP {'content-type': 'text/html', 'content-length': CAST(n AS VARCHAR), 'date': CAST(base AS VARCHAR), 'vary': 'accept'} AS headers FROM p
  UNION ALL SELECT p * 4 + 1, 'revisit', url, base + 50 + p % 500, 'W/' || tag, NULL,
         MAP {'date': CAST(base + 50 AS VARCHAR), 'cache-control': 'max-age=60', 'content-length': '0'} FROM p
  UNION ALL SELECT p * 4 + 2, 'revisit', url, base + 1000, '"' || p || '"', day, MAP {'date': 'never', 'expires': '0'} FROM p WHERE p % 3 = 0
  UNION ALL SELECT p * 4 + 3, 'revisit', url, base - 10, NULL, 'day ' || (p % 25), MAP {'etag': 'new', 'server': 'other'} FROM p WHERE p % 5 = 0),
bare AS (SELECT *, regexp_replace(regexp_replace(url, '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS b FROM recs),
parts AS (SELECT *, regexp_extract(b, '^[^/?]*') AS host FROM bare),
rests AS (SELECT *, substr(b, length(host) + 1) AS rest FROM parts),
asked AS (SELECT *, array_to_string(list_sort(list_filter(string_split(regexp_extract(rest, '\?(.*)$', 1), '&'),
    lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]+|ref|fbclid|gclid)='))), '&') AS q FROM rests),
canon AS (SELECT *, regexp_replace(regexp_replace(lower(host), ':(80|443)$', ''), '^(www|m)\.', '')
    || regexp_replace(regexp_extract(rest, '^[^?]*'), '/+$', '') || CASE WHEN q <> '' THEN '?' || q ELSE '' END AS canonical FROM asked),
met AS (SELECT v.record_id, v.canonical, v.ts, v.etag, v.last_modified, v.headers, r.record_id AS refers_to, r.etag AS r_etag, r.last_modified AS r_modified, r.headers AS r_headers,
    ROW_NUMBER() OVER (PARTITION BY v.record_id ORDER BY r.ts DESC NULLS LAST, r.record_id DESC NULLS LAST) AS k
  FROM canon v LEFT JOIN canon r ON v.canonical = r.canonical AND r.kind = 'response' AND r.ts < v.ts WHERE v.kind = 'revisit'),
judged AS (SELECT *, CASE WHEN refers_to IS NULL THEN 'no_response'
    WHEN etag IS NOT NULL AND r_etag IS NOT NULL THEN CASE WHEN replace(etag, 'W/', '') = replace(r_etag, 'W/', '') THEN 'matched' ELSE 'etag_mismatch' END
    WHEN last_modified IS NOT NULL AND r_modified IS NOT NULL THEN CASE WHEN last_modified = r_modified THEN 'matched' ELSE 'modified' END
    ELSE 'unchecked' END AS status FROM met WHERE k = 1),
fields AS (SELECT *, ['cache-control', 'content-location', 'date', 'etag', 'expires', 'last-modified', 'vary'] AS permitted FROM judged)
SELECT record_id, canonical, ts, refers_to, status, CASE WHEN status IN ('matched', 'unchecked') THEN array_to_string(list_sort(list_concat(
    list_transform(list_filter(map_entries(headers), lambda e: list_contains(permitted, e.key)), lambda e: e.key || '=' || e.value),
    list_transform(list_filter(map_entries(r_headers), lambda e: NOT (list_contains(permitted, e.key) AND list_contains(map_keys(headers), e.key))), lambda e: e.key || '=' || e.value))), ';') END AS headers
FROM fields
"""
@query("op5_revisit_resolution", OP5_SQL)
def op5_revisit_resolution(spark, sf):
    found = revisit.resolve(captures(t(spark, sf, "pages")))
    listed = F.array_join(F.array_sort(F.transform(F.map_entries("merged"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))), ";")
    return found.select("record_id", "canonical", "ts", "refers_to", "status", listed.alias("headers"))

OP12_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS x, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
l AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY 1),
f AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
        CASE WHEN len(w) < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 2 ELSE 0 END
        + CASE WHEN 100 * length(regexp_replace(x, '[^A-Z]', '', 'g')) > 5 * length(x) THEN 4 ELSE 0 END
        + CASE WHEN regexp_matches(x, '[#$%&*|]') THEN 8 ELSE 0 END
        + CASE WHEN d.doc_id > min(d.doc_id) OVER (PARTITION BY x) THEN 16 ELSE 0 END AS mask
      FROM d LEFT JOIN l ON l.doc_id = d.doc_id),
c AS (SELECT part, good, toxic, mask, count(*) AS n FROM f GROUP BY ALL),
b(l, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
o AS (SELECT p.l || q.l || r.l || s.l || u.l AS filter_order FROM b p, b q, b r, b s, b u WHERE p.bit + q.bit + r.bit + s.bit + u.bit = 31
      AND len(list_distinct([p.l, q.l, r.l, s.l, u.l])) = 5),
steps AS (SELECT filter_order, step, l, bit, coalesce((SELECT sum(e.bit) FROM b e WHERE strpos(filter_order, e.l) < step), 0)::BIGINT AS before
          FROM o, generate_series(1, 5) g(step) JOIN b ON l = substr(filter_order, step, 1)),
found AS (SELECT part, filter_order, step, l,
    sum(n * (mask & (before | bit) = 0)::INT)::BIGINT AS kept, sum(n * (mask & before = 0 AND mask & bit <> 0)::INT)::BIGINT AS removed,
    sum(n * (mask & before <> 0 AND mask & bit <> 0)::INT)::BIGINT AS redundant, sum(n * (mask = bit)::INT)::BIGINT AS unique_fails,
    sum(n * (good AND mask & before = 0 AND mask & bit <> 0)::INT)::BIGINT AS good_lost,
    sum(n * (toxic AND mask & before = 0 AND mask & bit <> 0)::INT)::BIGINT AS toxic_lost
  FROM c, steps GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, l))::BIGINT AS shapley FROM found
"""


@query("op12_filter_audit", OP12_SQL)
def op12_filter_audit(spark, sf):
    return filter_audit.audit(t(spark, sf, "documents"), t(spark, sf, "labels"))


@query("op13_suffix_buckets")
def op13_suffix_buckets(spark, sf):
    kept = suffix_buckets.remove_repeats(t(spark, sf, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op11_pair_bitmaps")
def op11_pair_bitmaps(spark, sf):
    return pair_bitmaps.align(t(spark, sf, "documents"))
