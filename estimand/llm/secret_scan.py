"""Secret scan with a battery of randomness tests, in built-in functions only.

Named patterns give the base spans.  The long parts of other tokens are tested for
randomness: chi-squared uniformity over the alphabet of the inferred encoding,
runs above and below the middle of that alphabet, and serial correlation.
The three p-values are combined (Fisher); within each encoding and band of
lengths the Benjamini-Hochberg rule picks the tokens shown not to be random, and
the others are reported as spans of kind ``random``.  Short tokens are judged
among short ones only, so that their weak tests do not ride on long ones.
"""

from pyspark.sql import Window as W, functions as F

from estimand.plans.prefix import stored

#: Fixed patterns of the base kinds, in the order that breaks ties.  ``hex`` and ``access`` have their least length in
#: the pattern: a shorter run has no part that matches.  An assignment is found first and dropped if its value is short.
KINDS = ["assign", "access", "hex"]
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
TOKEN = r"[A-Za-z0-9+/_=-]{20,}"
#: Parts of a token that are tested: the longest runs of each alphabet, with the padding behind them.  A key of any of the
#: encodings is such a run, whatever name, path or prefix of other characters stands before it.
PARTS = [r"[A-Za-z0-9]{20,}=*", r"[A-Za-z0-9+/]{20,}=*", r"[A-Za-z0-9_-]{20,}=*"]
#: Encodings tried in this order: name, pattern of the whole part without padding, alphabet.
ENCODINGS = [
    ("hex", "^([0-9a-f]+|[0-9A-F]+)$", "0123456789abcdef"),
    ("base32", "^[A-Z2-7]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("base36", "^([a-z0-9]+|[A-Z0-9]+)$", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("base64", "^[A-Za-z0-9+/]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64url", "^[A-Za-z0-9_-]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
]
FOLDED = ("hex", "base36")
BANDS = [32, 48, 96]
#: Steps of -ln p in which p-values are counted (rounded to the safe side) and the number of steps.
P_STEP, P_STEPS = 0.125, 240
SPAN = "array<struct<start:int,end:int,rank:int>>"
TOKEN_ROW = "array<struct<start:int,end:int,text:string>>"


#: Matches that a running sum appends one by one; longer lists go by blocks, so that the work does not grow with their square.
BLOCK = 256


def running(values, fold):
    """For every number of an array (from 0 on) the fold of those before it: ``fold`` is the sum or the larger of two."""
    none = F.array().cast("array<int>")
    start = F.struct(F.lit(0).alias("at"), none.alias("out"))
    append = lambda acc, v: F.struct(fold(acc["at"], v).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out"))
    last = F.floor((F.size(values) - 1) / BLOCK).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), last), lambda b: F.aggregate(F.slice(values, b * BLOCK + 1, F.lit(BLOCK)), start, append))
    bases = F.aggregate(blocks, start, lambda acc, x: append(acc, x["at"]), lambda acc: acc["out"])
    whole = F.flatten(F.zip_with(blocks, bases, lambda x, base: F.transform(x["out"], lambda v: fold(base, v))))
    return F.when(F.size(values) > 0, whole).otherwise(none)


def placed(text, pattern, found, keep=None):
    """Structs (start, end, text) of the matches ``found``; the gaps between matches come from splitting at the same pattern.

    ``keep`` is an array of the same length: a match stays where it is true.
    """
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
    before = running(F.zip_with(found, gaps, lambda m, g: F.length(m) + F.length(g)), lambda a, b: a + b)
    parts = F.zip_with(found, gaps, lambda m, g: F.struct(m.alias("m"), F.length(g).alias("g")))
    spans = F.zip_with(parts, before, lambda x, at: F.struct(
        (at + x["g"]).alias("start"), (at + x["g"] + F.length(x["m"])).alias("end"), x["m"].alias("text")))
    if keep is not None:
        spans = F.transform(F.filter(F.arrays_zip(spans.alias("span"), keep.alias("keep")), lambda x: x["keep"]), lambda x: x["span"])
    return F.when(F.size(found) > 0, spans).otherwise(F.array().cast(TOKEN_ROW))


def normal_tail(z):
    """1 - Phi(z), by the logistic approximation (error below 2e-4)."""
    z = F.least(F.greatest(z, F.lit(-8.0)), F.lit(8.0))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(z * 1.5976 + z * z * z * 0.07056))


def _parts(token):
    """The parts of one token, each span once."""
    found = [F.transform(placed(token["text"], p, F.regexp_extract_all(token["text"], F.lit(p), F.lit(0))), lambda s: F.struct(
        (token["start"] + s["start"]).alias("start"), (token["start"] + s["end"]).alias("end"), s["text"].alias("text"))) for p in PARTS]
    return F.array_distinct(F.concat(*found))


def _tested(token):
    """Struct (start, end, encoding, body) of one part; one of the encodings always fits."""
    body = F.regexp_replace(token["text"], "=+$", "")
    encoding = F.coalesce(*[F.when(body.rlike(p), F.lit(i)) for i, (_, p, _) in enumerate(ENCODINGS)])
    return F.struct(
        token["start"].alias("start"), token["end"].alias("end"), encoding.alias("encoding"),
        F.when(encoding.isin([i for i, e in enumerate(ENCODINGS) if e[0] in FOLDED]), F.lower(body)).otherwise(body).alias("body"),
    )


def _numbered(token):
    symbols = F.split(token["body"], "")
    alphabet = F.element_at(F.array(*[F.lit(a) for _, _, a in ENCODINGS]), token["encoding"] + 1)
    return F.struct(
        token["start"].alias("start"), token["end"].alias("end"), token["encoding"].alias("encoding"),
        F.length(alphabet).cast("double").alias("k"), F.length(token["body"]).cast("double").alias("n"),
        F.transform(F.filter(symbols, lambda c: c != ""), lambda c: F.instr(alphabet, c).cast("double")).alias("x"),
        F.aggregate(F.array_distinct(F.filter(symbols, lambda c: c != "")), F.lit(0.0), lambda s, c: s + F.pow(
            F.length(token["body"]) - F.length(F.replace(token["body"], c, F.lit(""))), F.lit(2.0))).alias("squares"),
    )


def _scored(t):
    n, k, x = t["n"], t["k"], t["x"]
    df = k - 1.0
    chi = t["squares"] * k / n - n
    z = (F.pow(F.greatest(chi, F.lit(1e-9)) / df, F.lit(1 / 3)) - (1.0 - F.lit(2.0) / (df * 9.0))) / F.sqrt(F.lit(2.0) / (df * 9.0))
    p_chi = normal_tail(z)
    high = F.aggregate(x, F.lit(0.0), lambda s, v: s + F.when(v * 2.0 > k, 1.0).otherwise(0.0))
    low = n - high
    pairs = F.zip_with(F.slice(x, 1, F.greatest(F.size(x) - 1, F.lit(0))), F.slice(x, 2, F.size(x)), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    runs = F.aggregate(pairs, F.lit(1.0), lambda s, v: s + F.when((v["a"] * 2.0 > k) != (v["b"] * 2.0 > k), 1.0).otherwise(0.0))
    expected = high * low * 2.0 / n + 1.0
    spread = F.sqrt(F.greatest(high * low * 2.0 * (high * low * 2.0 - n) / (n * n * (n - 1.0)), F.lit(1e-9)))
    p_runs = F.when(high * low == 0, F.lit(1e-4)).otherwise(normal_tail(F.abs((runs - expected) / spread)) * 2.0)
    mean = F.aggregate(x, F.lit(0.0), lambda s, v: s + v) / n
    total = F.aggregate(x, F.lit(0.0), lambda s, v: s + (v - mean) * (v - mean))
    lag = F.aggregate(pairs, F.lit(0.0), lambda s, v: s + (v["a"] - mean) * (v["b"] - mean))
    p_serial = F.when(total == 0, F.lit(1e-4)).otherwise(normal_tail(F.abs((lag / total + F.lit(1.0) / n) * F.sqrt(n))) * 2.0)
    half = -(F.ln(p_chi) + F.ln(F.least(p_runs, F.lit(1.0))) + F.ln(F.least(p_serial, F.lit(1.0))))
    ln_p = -half + F.ln(F.lit(1.0) + half + half * half / 2.0)
    band = sum((n >= b).cast("int") for b in BANDS)
    return F.struct(
        t["start"].alias("start"), t["end"].alias("end"), (t["encoding"] * (len(BANDS) + 1) + band).alias("stratum"),
        F.least(F.floor(-ln_p / P_STEP), F.lit(P_STEPS)).cast("int").alias("step"),
    )


def _spans(found, rank):
    return F.transform(found, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(rank).alias("rank")))


def _listed(spans):
    names = F.array(*[F.lit(k) for k in [*KINDS, "random"]])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["rank"] + 1), s["start"], s["end"])), ",")


def _limits(tests, q):
    """Map stratum -> least step that is rejected; at most one entry for each encoding and band."""
    counts = tests.select(F.explode("tests").alias("t")).groupBy("t.stratum", "t.step").count()
    down = W.partitionBy("stratum").orderBy(F.desc("step"))
    ranked = counts.select("stratum", "step", F.sum("count").over(down).alias("upto"), F.sum("count").over(W.partitionBy("stratum")).alias("m"))
    rejected = ranked.where(F.exp(-F.col("step") * P_STEP) <= q * F.col("upto") / F.col("m"))
    return {r[0]: r[1] for r in rejected.groupBy("stratum").agg(F.min("step")).collect()}


def scan(docs, text="text", keep=("doc_id",), q=0.05):
    """Spans of likely secrets of every row: ``keep`` columns, ``base`` and ``spans`` (arrays of start, end, rank of kind).

    Positions are code points, the end exclusive.  A null or empty text has no
    spans; equal rows give equal rows.  All parts of 20 or more characters that
    overlap no base span are tested, with or without digits; spans of nested parts
    may overlap.  Extra columns of the input may have any name: only ``keep`` is carried.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    named = F.lower(F.col("_t"))
    keyed = named.contains("passw") | named.contains("secret") | named.contains("token") | named.contains("api")
    none = F.array().cast("array<string>")
    rows = docs.select(*[F.col(c) for c in keep], t.alias("_t"))
    rows = rows.select(
        *keep, "_t",
        F.when(keyed, F.regexp_extract_all("_t", F.lit(ASSIGN), F.lit(0))).otherwise(none).alias("_a"),
        F.when(F.col("_t").contains("AKIA"), F.regexp_extract_all("_t", F.lit(ACCESS), F.lit(0))).otherwise(none).alias("_k"),
        F.regexp_extract_all("_t", F.lit(HEX), F.lit(0)).alias("_h"), F.regexp_extract_all("_t", F.lit(TOKEN), F.lit(0)).alias("_r"),
    )
    long_value = F.transform("_a", lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= ASSIGN_VALUE)
    rows = rows.select(
        *keep, placed(F.col("_t"), ASSIGN, F.col("_a"), long_value).alias("_a"), placed(F.col("_t"), ACCESS, F.col("_k")).alias("_k"),
        placed(F.col("_t"), HEX, F.col("_h")).alias("_h"), placed(F.col("_t"), TOKEN, F.col("_r")).alias("_r"),
    )
    rows = rows.select(*keep, F.array_sort(F.concat(_spans("_a", 0), _spans("_k", 1), _spans("_h", 2)),
                                           lambda a, b: _before(a, b)).alias("base"), "_r")
    # base spans by blocks in order of their starts: a part looks only into blocks that it meets
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size("base") - 1) / BLOCK).cast("int")), lambda b: F.slice("base", b * BLOCK + 1, F.lit(BLOCK)))
    blocks = F.transform(blocks, lambda x: F.struct(x.alias("spans"), F.element_at(x, 1)["start"].alias("lo"), F.array_max(F.transform(x, lambda s: s["end"])).alias("hi")))
    meets = lambda s, lo, hi: (lo < s["end"]) & (s["start"] < hi)
    inside = lambda s: F.exists("_blocks", lambda x: meets(s, x["lo"], x["hi"]) & F.exists(x["spans"], lambda b: meets(s, b["start"], b["end"])))
    rows = rows.select(*keep, "base", "_r", F.when(F.size("base") > 0, blocks).alias("_blocks"))
    every = F.flatten(F.transform("_r", _parts))
    apart = F.when(F.col("_blocks").isNull(), every).otherwise(F.filter(every, lambda s: ~inside(s)))
    coded = rows.select(*keep, "base", apart.alias("_r")).select(*keep, "base", F.transform("_r", _tested).alias("_r"))
    numbered = coded.select(*keep, "base", F.transform("_r", _numbered).alias("_r"))
    tests = stored(numbered.select(*keep, "base", F.transform("_r", _scored).alias("tests")))
    limits = _limits(tests, q)
    least = F.create_map(*[F.lit(x) for kv in limits.items() for x in kv]) if limits else F.lit(None).cast("map<int,int>")
    held = F.filter("tests", lambda s: s["step"] < F.coalesce(least[s["stratum"]], F.lit(P_STEPS + 1)))
    extra = F.transform(held, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(len(KINDS)).alias("rank")))
    return tests.select(*keep, "base", F.array_sort(F.concat("base", extra), lambda a, b: _before(a, b)).alias("spans"))


def _before(a, b):
    sign = lambda f: F.when(a[f] < b[f], -1).when(a[f] > b[f], 1)
    return F.coalesce(sign("start"), sign("rank"), sign("end"), F.lit(0))


def digest(found, keep=("doc_id",)):
    """Counts by base kind, the SHA-256 of the listed base spans and the list of all spans."""
    count = lambda r: F.size(F.filter("base", lambda s: s["rank"] == r)).cast("long")
    return found.select(
        *keep, *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)],
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"),
    )


def redact(docs, text="text", key="doc_id", mask="[secret]", q=0.05):
    """All columns of ``docs`` with the text between the spans kept and every span replaced by ``mask``.

    Overlapping spans are replaced once.  A null text stays null.  The columns keep their names and order.
    """
    inner = "_own_text"
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(text).alias(inner))
    found = scan(rows, inner, keep=("_row",), q=q)
    own = F.col("_row")[text]
    at = running(F.transform("spans", lambda s: s["end"]), lambda a, b: F.greatest(a, b))
    pieces = F.zip_with("spans", at, lambda s, a: F.when(s["start"] >= a, F.concat(F.substring(own, a + 1, s["start"] - a), F.lit(mask))).otherwise(F.lit("")))
    rest = F.array_max(F.transform("spans", lambda s: s["end"]))
    clean = F.concat(F.array_join(pieces, ""), F.substring(own, rest + 1, F.length(own)))
    return found.select(*[(F.when(own.isNull(), own).when(F.size("spans") == 0, own).otherwise(clean) if c == text else F.col("_row")[c]).alias(c)
                          for c in docs.columns])
