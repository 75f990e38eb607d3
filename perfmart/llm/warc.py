"""WARC not-modified revisits: resolution to the response that they confirm.

Records are captures: ``record_id``, ``url``, ``ts`` (seconds), ``kind``
(response or revisit), ``status``, ``headers`` (array of name and value, names
in any case), ``payload_id`` and ``payload_bytes``.  A revisit resolves to the
latest full response (status 200) of the same canonical URL that is strictly
earlier; of several at that time, to the one with the largest record id.

Its validators decide the outcome: an ETag, or without one a Last-Modified,
must equal the response's (``resolved``), else ``mismatch``; a revisit without
either is ``unvalidated`` but still refers to the response; without an earlier
response, or with a URL that is null or has no ``://``, it is ``missing``.
Resolved and unvalidated revisits get the response's headers, in which those
that a 304 may update (``PERMITTED``) are replaced by the revisit's.

The as-of join runs in two steps, so a URL with very many captures is spread
over tasks: within each time bucket by a window, and across buckets over one
pre-aggregated row for a URL and bucket.  Repeated rows resolve alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from perfmart.llm.text import table
from perfmart.llm.url_filter import LOWER, UPPER

#: Header fields that a 304 response updates.
PERMITTED = ["cache-control", "content-location", "date", "etag", "expires", "vary"]
#: Query parameters that do not change the page.
TRACKING = r"^(utm_[^=]*|gclid|fbclid)(=|$)"
#: Seconds of a time bucket.
BUCKET = 6 * 3600


def canonical(url: Column) -> Column:
    """Host in lower case without ``www.`` and default port, path without a
    trailing slash, sorted parameters without tracking; scheme and fragment go."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^#]*)", 1)
    host = F.regexp_replace(F.translate(F.regexp_extract(rest, r"^[^/?]*", 0), UPPER, LOWER), r"^www\.|:(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"(?s)^[^/?]*([^?]*)", 1), r"/$", "")
    query = F.array_join(F.array_sort(F.filter(F.split(F.regexp_extract(rest, r"(?s)\?(.*)$", 1), "&"),
                                               lambda p: (p != "") & ~p.rlike(TRACKING))), "&")
    return F.when(url.contains("://"), F.concat(host, F.when(path == "", "/").otherwise(path),
                                                F.when(query == "", "").otherwise(F.concat(F.lit("?"), query))))


def _lowered(headers: Column) -> Column:
    return F.transform(F.coalesce(headers, F.array()), lambda h: F.struct(
        F.lower(h["name"]).alias("name"), h["value"].alias("value")))


def _header(headers: Column, name: str) -> Column:
    return F.get(F.filter(headers, lambda h: h["name"] == name), F.lit(0))["value"]


def merged(stored: Column, fresh: Column) -> Column:
    """Stored headers with the permitted fresh ones, sorted by name."""
    update = F.filter(fresh, lambda h: h["name"].isin(PERMITTED))
    return F.array_sort(F.concat(F.filter(stored, lambda h: ~F.exists(update, lambda u: u["name"] == h["name"])), update))


def resolve(records: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """``row`` (the revisit), ``canonical``, ``refers_to``, ``outcome``,
    ``merged`` headers, ``payload_id`` and ``payload_bytes``."""
    row = F.struct(*[F.col(f"`{c}`") for c in records.columns])
    rows = records.select(row.alias("row")).select(
        "row", canonical(F.col("row.url")).alias("canonical"), F.col("row.ts").alias("ts"),
        F.floor(F.col("row.ts") / bucket).alias("bucket"), _lowered(F.col("row.headers")).alias("headers"))
    full = (F.col("row.kind") == "response") & (F.col("row.status") == 200)
    rows = rows.select("*", F.when(full, F.struct(
        "ts", F.col("row.record_id").alias("record_id"), "headers",
        F.col("row.payload_id").alias("payload_id"), F.col("row.payload_bytes").alias("payload_bytes"))).alias("response"))
    keyed = rows.where(F.col("canonical").isNotNull() & F.col("ts").isNotNull())
    earlier = Window.partitionBy("canonical", "bucket").orderBy("ts").rangeBetween(Window.unboundedPreceding, -1)
    here = keyed.select("*", F.max("response").over(earlier).alias("near")).where(F.col("row.kind") == "revisit")
    before = Window.partitionBy("canonical").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = (keyed.groupBy("canonical", "bucket").agg(F.max("response").alias("last"))
                    .select("canonical", "bucket", F.max("last").over(before).alias("far")))
    found = (here.join(carried, ["canonical", "bucket"], "left")
                 .select("row", "canonical", "headers", F.coalesce("near", "far").alias("r")))
    lost = (rows.where(F.col("canonical").isNull() | F.col("ts").isNull()).where(F.col("row.kind") == "revisit")
                .select("row", "canonical", "headers", F.lit(None).cast(found.schema["r"].dataType).alias("r")))
    found = found.unionByName(lost)
    tag, date = _header(F.col("headers"), "etag"), _header(F.col("headers"), "last-modified")
    stored = F.col("r.headers")
    outcome = (F.when(F.col("r").isNull(), "missing")
                .when(tag.isNotNull(), F.when(tag.eqNullSafe(_header(stored, "etag")), "resolved").otherwise("mismatch"))
                .when(date.isNotNull(), F.when(date.eqNullSafe(_header(stored, "last-modified")), "resolved").otherwise("mismatch"))
                .otherwise("unvalidated"))
    found = found.select("row", "canonical", "headers", "r", outcome.alias("outcome"))
    ok = F.col("outcome").isin("resolved", "unvalidated")
    return found.select("row", "canonical", "outcome", *[F.when(ok, c).alias(n) for n, c in (
        ("refers_to", F.col("r.record_id")), ("merged", merged(stored, F.col("headers"))),
        ("payload_id", F.col("r.payload_id")), ("payload_bytes", F.col("r.payload_bytes")))])


def captures(pages: DataFrame) -> DataFrame:
    """Two captures of each page: its response, and a day later a not-modified
    revisit, whose validators depend on the URL's digest (of sixteen: two carry
    an outdated ETag, three a Last-Modified only, one none, the others the ETag)."""
    html = F.coalesce("html", F.lit(""))
    digest, kind = F.md5(html.cast("binary")), F.substring(F.md5(F.coalesce("url", F.lit("")).cast("binary")), 1, 1)
    at = F.col("page_id") * 60

    def header(name: str, value: Column) -> Column:
        return F.struct(F.lit(name).alias("name"), value.cast("string").alias("value"))

    response = F.struct((F.col("page_id") * 2).alias("record_id"), "url", at.alias("ts"), F.lit("response").alias("kind"),
                        F.lit(200).alias("status"), F.array(
        header("Content-Type", F.lit("text/html")), header("Content-Length", F.octet_length(html)), header("Date", at),
        header("ETag", digest), header("Last-Modified", at), header("Cache-Control", F.lit("max-age=60"))).alias("headers"),
        digest.alias("payload_id"), F.octet_length(html).cast("bigint").alias("payload_bytes"))
    etag = F.when(kind.isin("0", "1"), F.concat(F.lit("old-"), digest)).when(~kind.isin("2", "3", "4", "5"), digest)
    revisit = F.struct((F.col("page_id") * 2 + 1).alias("record_id"), "url", (at + 86400).alias("ts"), F.lit("revisit").alias("kind"),
                       F.lit(304).alias("status"), F.filter(F.array(
        header("Date", at + 86400), header("Content-Length", F.lit(0)), header("Cache-Control", F.lit("max-age=3600")),
        header("ETag", etag), header("Last-Modified", F.when(kind.isin("2", "3", "4"), at))),
        lambda h: h["value"].isNotNull()).alias("headers"),
        F.lit(None).cast("string").alias("payload_id"), F.lit(None).cast("bigint").alias("payload_bytes"))
    return pages.select(F.explode(F.array(response, revisit)).alias("c")).select("c.*")


def op5_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The revisits among two captures of every page of ``pages``."""
    found = resolve(captures(table(spark, sf_dir, "pages", "page_id", "url", "html")))
    return found.select(F.col("row.record_id").alias("record_id"), "canonical", "outcome", "refers_to",
                        F.array_join(F.transform("merged", lambda h: F.concat(h["name"], F.lit(": "), h["value"])), "; ").alias("headers"),
                        "payload_id", "payload_bytes")


ORACLE_OP5 = r"""
WITH u AS (
  SELECT page_id, url, md5(coalesce(html, '')) AS digest, octet_length(encode(coalesce(html, ''))) AS bytes, page_id * 60 AS moment,
         left(md5(coalesce(url, '')), 1) AS kind,
         CASE WHEN contains(url, '://') THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^#]*') END AS rest FROM pages),
v AS (
  SELECT *, regexp_replace(translate(regexp_extract(rest, '^[^/?]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                           '^www\.|:(80|443)$', '', 'g') AS host,
         regexp_replace(regexp_extract(rest, '^[^/?]*([^?]*)', 1), '/$', '') AS path,
         array_to_string(list_sort(list_filter(string_split(regexp_extract(rest, '\?(.*)$', 1), '&'),
           lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[^=]*|gclid|fbclid)(=|$)'))), '&') AS query FROM u),
c AS (SELECT *, host || CASE WHEN path = '' THEN '/' ELSE path END || CASE WHEN query = '' THEN '' ELSE '?' || query END AS canonical FROM v),
m AS (
  SELECT a.*, a.page_id * 2 + 1 AS record_id, b.page_id AS b_id, b.digest AS b_digest, b.bytes AS b_bytes, b.moment AS b_moment,
         row_number() OVER (PARTITION BY a.page_id ORDER BY b.moment DESC NULLS LAST, b.page_id DESC) AS k
  FROM c a LEFT JOIN c b ON a.canonical = b.canonical AND b.moment < a.moment + 86400),
o AS (
  SELECT *, CASE WHEN b_id IS NULL THEN 'missing'
                 WHEN kind IN ('0', '1') THEN 'mismatch'
                 WHEN kind IN ('2', '3', '4') THEN CASE WHEN moment = b_moment THEN 'resolved' ELSE 'mismatch' END
                 WHEN kind = '5' THEN 'unvalidated'
                 WHEN digest = b_digest THEN 'resolved' ELSE 'mismatch' END AS outcome FROM m WHERE k = 1)
SELECT record_id, canonical, outcome,
       CASE WHEN outcome IN ('resolved', 'unvalidated') THEN b_id * 2 END AS refers_to,
       CASE WHEN outcome IN ('resolved', 'unvalidated') THEN
         'cache-control: max-age=3600; content-length: ' || b_bytes || '; content-type: text/html; date: ' || (moment + 86400) ||
         '; etag: ' || b_digest || '; last-modified: ' || b_moment END AS headers,
       CASE WHEN outcome IN ('resolved', 'unvalidated') THEN b_digest END AS payload_id,
       CASE WHEN outcome IN ('resolved', 'unvalidated') THEN CAST(b_bytes AS BIGINT) END AS payload_bytes
FROM o
"""
