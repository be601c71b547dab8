"""Not-modified revisits: the latest earlier full response of the same canonical URL, validated and merged.

The as-of join keeps no URL in one task: records are dealt by ranges of (URL,
time), each range finds its own latest responses, and one row for each range
carries the response on to the ranges that begin in the middle of a URL.
"""

from pyspark.sql import Window as W, functions as F

from estimand.plans.prefix import stored

#: Parameters without influence on the content, and header fields that a 304 answer may update (public HTTP rules).
TRACKING = "^(utm_[a-z]+|ref|fbclid|gclid)="
PERMITTED = ["cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary"]


def canonical(url):
    """Canonical form: no scheme, fragment, default port, ``www.`` or ``m.``; host in lower case; no trailing
    slashes; parameters sorted, without those of tracking."""
    bare = F.regexp_replace(F.regexp_replace(url, "#.*$", ""), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_extract(bare, "^[^/?]*", 0)
    rest = F.substring(bare, F.length(host) + 1, F.length(bare))
    clean = F.regexp_replace(F.regexp_replace(F.lower(host), ":(80|443)$", ""), r"^(www|m)\.", "")
    path = F.regexp_replace(F.regexp_extract(rest, "^[^?]*", 0), "/+$", "")
    asked = F.split(F.regexp_extract(rest, r"\?(.*)$", 1), "&", -1)
    query = F.array_join(F.array_sort(F.filter(asked, lambda p: (p != "") & ~p.rlike(TRACKING))), "&")
    return F.concat(clean, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")))


def _strong(tag):
    return F.regexp_replace(tag, "^W/", "")


def resolve(records):
    """One row for each revisit of ``records`` (record_id, kind, url, ts, etag, last_modified, headers).

    ``kind`` is ``response`` or ``revisit``, ``headers`` a map with names in lower
    case.  Adds ``canonical``; ``refers_to``, the response of that URL with the
    greatest ts before the revisit's (ties: the greatest record_id); ``status``:
    ``no_response``; ``etag_mismatch``, if both have an entity tag and they
    differ (weak comparison); ``modified``, if an entity tag is missing and the
    dates of modification differ; ``unchecked``, if there is nothing to compare;
    else ``matched``.  ``merged`` holds the response's headers with the permitted
    ones of a matched or unchecked revisit, null for other states.  A null url or
    ts matches nothing; repeated revisits are all kept; null headers are empty.
    """
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    rows = records.select("record_id", "kind", canonical(F.col("url")).alias("canonical"), F.col("ts").alias("ts"), "etag", "last_modified", F.coalesce("headers", empty).alias("headers"))
    full = F.when(F.col("kind") == "response", F.struct("ts", F.col("record_id").alias("id"), "etag", "last_modified", "headers"))
    whole = rows.where("canonical is not null and ts is not null and kind in ('response', 'revisit')")
    #: A revisit comes before the responses of its own time: only earlier ones count.
    turn = F.when(F.col("kind") == "revisit", 0).otherwise(1)
    dealt = stored(whole.select("*", turn.alias("turn"), full.alias("full")).repartitionByRange("canonical", "ts", "turn", "record_id").withColumn("range", F.spark_partition_id()))
    order = ["ts", "turn", "record_id"]
    upto = W.partitionBy("range", "canonical").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    inside = dealt.withColumn("near", F.last("full", ignorenulls=True).over(upto)).where("kind = 'revisit'")
    last = dealt.where("kind = 'response'").groupBy("range", "canonical").agg(F.max_by("full", F.struct(*order)).alias("kept"))
    edge = dealt.groupBy("range").agg(F.min("canonical").alias("first"), F.max("canonical").alias("last"))
    ends = edge.join(last.withColumnRenamed("canonical", "last"), ["range", "last"], "left").select("range", F.col("last").alias("canonical"), "kept", F.lit(1).alias("end"))
    begins = edge.select("range", F.col("first").alias("canonical"), F.lit(None).alias("kept"), F.lit(0).alias("end"))
    before = W.partitionBy("canonical").orderBy("range", "end").rowsBetween(W.unboundedPreceding, -1)
    carried = begins.unionByName(ends).withColumn("carried", F.last("kept", ignorenulls=True).over(before)).where("end = 0").select("range", "canonical", "carried")
    met = inside.join(F.broadcast(carried), ["range", "canonical"], "left").withColumn("response", F.coalesce("near", "carried"))
    columns = ["record_id", "canonical", "ts", "etag", "last_modified", "headers", "response"]
    lone = rows.where("kind = 'revisit' and (canonical is null or ts is null)").withColumn("response", F.lit(None).cast(met.schema["response"].dataType))
    met = met.select(*columns).unionByName(lone.select(*columns))
    tags, dates = (F.col("etag"), F.col("response.etag")), (F.col("last_modified"), F.col("response.last_modified"))
    both_tags, both_dates = tags[0].isNotNull() & tags[1].isNotNull(), dates[0].isNotNull() & dates[1].isNotNull()
    status = (F.when(F.col("response").isNull(), "no_response").when(both_tags, F.when(_strong(tags[0]) == _strong(tags[1]), "matched").otherwise("etag_mismatch"))
              .when(both_dates, F.when(dates[0] == dates[1], "matched").otherwise("modified")).otherwise("unchecked"))
    met = met.withColumn("status", status)
    update = F.map_filter("headers", lambda k, v: k.isin(PERMITTED))
    keep = F.map_filter("response.headers", lambda k, v: ~F.map_contains_key(update, k))
    merged = F.when(F.col("status").isin("matched", "unchecked"), F.map_concat(keep, update))
    return met.select("record_id", "canonical", "ts", F.col("response.id").alias("refers_to"), "status", merged.alias("merged"))
