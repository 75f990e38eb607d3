"""SpotSigs document fingerprints.

Words are runs of letters and digits, lower-cased.  Every common word (see
``COMMON``) is an anchor; it and the ``CHAIN`` content words that follow it,
passing over other common words, form a signature, kept as eight hexadecimal
digits of its MD5.  Content words of a fixed hash class, one in four (``CLASS``),
are anchors as well, so a stretch or a text without common words (tables, code,
other languages) has signatures all along, too.  The beginning of the text is an
anchor, so each text with a word has a signature.  A fingerprint is the sorted distinct signatures
joined by spaces: equal texts have equal fingerprints, and a null, empty or
wordless text has the empty one.  Likeness is the Jaccard similarity of the
signature sets; two empty sets are alike (1.0), an empty and another are not.

Everything runs on built-in functions.  Rows with a null id come first in the
order of ids; rows with one id are ordered by their text.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from perfmart.llm.text import table

# Common words of English, German, French and Spanish.
COMMON = """
a about after all an and any are as at be because been but by can could did do for from had has have he her his how i if
in into is it its just like more my no not of on one or other our out over she so some than that the their them then there
these they this to up was we were what when which who will with would you your
aber als am auch auf aus bei bin bis das dass dem den der des die doch durch ein eine einem einen einer eines er es für
haben hat hier ich ihr im ist ja kann kein mit nach nicht noch nur ob oder ohne schon sein sich sie sind so über um und
uns unter vom von vor war wenn werden wie wir wird zu zum zur
au aux avec ce ces cette comme dans de des donc du elle en est et eux il ils je la le les leur lui mais me même ne nous ont
ou où par pas plus pour qu que qui sa se ses si son sont sur te tu un une vous y
al algo como con contra cual cuando del desde donde durante e el ella ellos entre era esa ese eso esta este esto fue ha hay
la las le lo los más me mi muy nada ni nos o otra otro para pero poco por porque que quien se ser si sin sobre son su sus
también te tiene todo tu un una uno ya
""".split()
CHAIN = 2
DIGITS = 8
#: First hexadecimal digits of a content word's MD5 that make it an anchor.
CLASS = "0123"
THRESHOLD = 0.8


def signatures(df: DataFrame, text: str, out: str, chain: int = CHAIN) -> DataFrame:
    """``df`` with the sorted distinct signatures of column ``text`` as ``out``.
    The steps are separate projections, so each array is computed once."""
    words, stops, content = f"{out}_words", f"{out}_stops", f"{out}_content"
    kept = [F.col(f"`{c}`") for c in df.columns]
    common = sorted(set(COMMON))

    def digest(*parts: Column) -> Column:
        return F.substring(F.md5(F.concat_ws(" ", *parts).cast("binary")), 1, DIGITS)

    df = df.select(*kept, F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{N}]+"),
                                   lambda w: w != "").alias(words))
    df = df.select(*kept, words,
                   F.filter(F.transform(words, lambda w, i: F.when(w.isin(common), i).otherwise(-1)),
                            lambda i: i >= 0).alias(stops),
                   F.filter(words, lambda w: ~w.isin(common)).alias(content))
    # The k-th common word stands at word p, so p - k content words come before it.
    spots = F.transform(stops, lambda p, k: F.when(
        p - k < F.size(content),
        digest(F.get(words, p), *[F.get(content, p - k + j) for j in range(chain)])))
    hashed = F.transform(content, lambda w, i: F.when(
        F.substring(F.md5(w.cast("binary")), 1, 1).isin(*CLASS) & (i + 1 < F.size(content)),
        digest(w, *[F.get(content, i + 1 + j) for j in range(chain)])))
    opening = F.when(F.size(words) > 0, digest(F.lit("^"), F.array_join(F.slice(
        F.when(F.size(content) > 0, F.col(content)).otherwise(F.col(words)), 1, chain), " ")))
    return df.select(*kept, F.array_sort(F.array_distinct(F.filter(
        F.concat(F.array(opening), spots, hashed), lambda s: s.isNotNull()))).alias(out))


def fingerprint(signature_set: Column) -> Column:
    return F.array_join(signature_set, " ")


def likeness(a: Column, b: Column, least: float = 0.0) -> Column:
    """Pruned Jaccard similarity: sets whose sizes alone keep it under ``least``
    are not compared (0.0)."""
    small, large = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    common = F.size(F.array_intersect(a, b))
    return (F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0))
             .when(small < F.lit(least) * large, F.lit(0.0))
             .otherwise(common / (F.size(a) + F.size(b) - common)))


def length_class(size: Column, least: float = THRESHOLD) -> Column:
    """Partition of a set by its size: alike sets lie in one or in adjacent ones."""
    return F.floor(F.log(F.greatest(size, F.lit(1)).cast("double")) / math.log(1 / least) + 1e-9).cast("int")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text",
                    least: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(members, pairs): each document with its class ``rep`` (the smallest id
    of an equal fingerprint; null without signatures), and the pairs (a < b) of
    classes whose likeness reaches ``least``.  Sets meet within their length
    class and the next on one of their rarest signatures (so many that alike
    sets share one), and are compared if their sizes allow."""
    signed = signatures(docs.select(F.col(key).alias("id"), F.col(text).alias("t")), "t", "s").select("id", "s")
    members = (signed.select("id", F.when(F.size("s") > 0, fingerprint(F.col("s"))).alias("f")))
    reps = members.where(F.col("f").isNotNull()).groupBy("f").agg(F.min("id").alias("rep"))
    members = members.join(reps, "f", "left").select(F.col("id").alias(key), "rep")
    sets = reps.select("rep", F.split("f", " ").alias("s"))
    tokens = sets.select("rep", F.explode("s").alias("x"))
    counts = tokens.groupBy("x").agg(F.count("*").alias("n"))
    ranked = (tokens.join(counts, "x").groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("n", "x"))).alias("o"))
              .select("rep", F.size("o").alias("m"), F.col("o.x").alias("o"))
              .select("rep", "m", F.slice("o", 1, (F.col("m") - F.ceil(F.col("m") * least - 1e-9) + 1).cast("int")).alias("o")))
    own = length_class(F.col("m"), least)
    left = ranked.select(F.col("rep").alias("a"), F.col("m").alias("ma"), own.alias("c"), F.explode("o").alias("x"))
    right = (ranked.select(F.col("rep").alias("b"), F.col("m").alias("mb"), F.explode(F.array(own, own - 1)).alias("c"), "o")
                   .select("b", "mb", "c", F.explode("o").alias("x")))
    met = (left.join(right, ["c", "x"])
               .where((F.col("ma") < F.col("mb")) | ((F.col("ma") == F.col("mb")) & (F.col("a") < F.col("b"))))
               .where(F.col("ma") >= F.lit(least) * F.col("mb")).select("a", "b").distinct())
    pairs = (met.join(sets.select(F.col("rep").alias("a"), F.col("s").alias("sa")), "a")
                .join(sets.select(F.col("rep").alias("b"), F.col("s").alias("sb")), "b")
                .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"),
                        likeness(F.col("sa"), F.col("sb"), least).alias("likeness"))
                .where(F.col("likeness") >= least))
    return members, pairs


def with_next(docs: DataFrame, key: str, columns: list[str], buckets: int) -> DataFrame:
    """``docs`` (key, text) with ``bucket`` and ``guard``, ready for a window
    that looks one row ahead in the order of keys without bringing all rows
    together: buckets are ranges of keys, and the first row of the next bucket
    (of the first, after the last) also ends each bucket as a guard row."""
    order = F.coalesce(F.col(key).cast("bigint"), F.lit(-(1 << 63)))
    found = docs.select(order.alias("k")).agg(
        F.min("k").alias("low"),
        F.percentile_approx("k", [(i + 1) / buckets for i in range(buckets - 1)] or [0.5], 10 * max(100, buckets)).alias("q")).first()
    bounds = sorted({found.low, *(found.q or [])}) if found.low is not None else [0]
    n = len(bounds)
    array = F.lit(bounds)
    steps = F.lit([1 << i for i in range(n.bit_length() - 1, -1, -1)])
    bucket = F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        (at + step < n) & (F.get(array, at + step) <= F.col("__k")), at + step).otherwise(at))
    rows = docs.select(*columns, order.alias("__k")).select("*", bucket.alias("__b"))
    opens = F.get(array, F.col("__b")) == F.col("__k")
    copies = F.when(opens, F.array(F.struct(F.col("__b").alias("bucket"), F.lit(False).alias("guard")),
                                   F.struct(F.pmod(F.col("__b") - 1, F.lit(n)).alias("bucket"), F.lit(True).alias("guard")))) \
        .otherwise(F.array(F.struct(F.col("__b").alias("bucket"), F.lit(False).alias("guard"))))
    return rows.select("*", F.explode(copies).alias("__c")).select(
        *columns, F.col("__k").alias("place"), "__c.bucket", "__c.guard")


def edited_and_next(docs: DataFrame) -> DataFrame:
    """doc_id, the text's length, its edited text, and the signature sets of
    the text, the edited text and the next document."""
    buckets = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = with_next(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), "doc_id", ["doc_id", "text"], buckets)
    ahead = Window.partitionBy("bucket").orderBy("guard", "place", "text")
    n, q = F.length("text"), F.floor(F.length("text") / 4).cast("int")
    rows = rows.select("*", F.lead("text").over(ahead).alias("next_text"))
    rows = rows.select("doc_id", "bucket", "guard", "place", "text", F.when(~F.col("guard"), F.concat(
        F.substring("text", F.lit(1), n - q), F.substring("next_text", F.lit(1), q))).alias("edited"))
    rows = signatures(signatures(rows, "text", "s"), "edited", "e")
    rows = rows.select("doc_id", "guard", "text", "edited", "s", "e", F.lead("s").over(ahead).alias("next"))
    return rows.where(~F.col("guard"))


def op1_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents``, its edited text and its next."""
    rows = edited_and_next(table(spark, sf_dir, "documents", "doc_id", "text"))
    return rows.select("doc_id", F.length("text").cast("bigint").alias("n_chars"),
                       F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                       fingerprint(F.col("s")).alias("fingerprint"), fingerprint(F.col("e")).alias("edited_fingerprint"),
                       likeness(F.col("s"), F.col("e")).alias("near_edited"),
                       likeness(F.col("s"), F.col("next")).alias("near_next"),
                       length_class(F.size("s")).alias("length_class"))


_LIST = "[" + ", ".join(f"'{w}'" for w in sorted(set(COMMON))) + "]"


def _sql_signatures(name: str, source: str, text: str) -> str:
    return f"""
{name}_w AS (SELECT doc_id, regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}]+') AS w FROM {source}),
{name}_c AS (SELECT doc_id, w, list_filter(w, lambda x: NOT list_contains({_LIST}, x)) AS c,
                    list_filter(range(1, len(w) + 1), lambda i: list_contains({_LIST}, w[i])) AS p FROM {name}_w),
{name} AS (SELECT doc_id, list_sort(list_distinct(list_concat(
    CASE WHEN len(w) > 0 THEN [left(md5('^ ' || array_to_string(CASE WHEN len(c) > 0 THEN c[1:2] ELSE w[1:2] END, ' ')), 8)] ELSE [] END,
    list_filter(list_transform(p, lambda x, k: CASE WHEN x - k < len(c) THEN
        left(md5(concat_ws(' ', w[x], c[x - k + 1], c[x - k + 2])), 8) END), lambda y: y IS NOT NULL),
    list_filter(list_transform(c, lambda x, k: CASE WHEN left(md5(x), 1) IN ({", ".join(f"'{d}'" for d in CLASS)}) AND k < len(c) THEN
        left(md5(concat_ws(' ', x, c[k + 1], c[k + 2])), 8) END), lambda y: y IS NOT NULL)))) AS s FROM {name}_c)"""


ORACLE_OP1 = f"""
WITH o AS (SELECT doc_id, coalesce(text, '') AS t,
                  coalesce(lead(coalesce(text, '')) OVER (ORDER BY doc_id), first_value(coalesce(text, '')) OVER (ORDER BY doc_id)) AS nt,
                  coalesce(lead(doc_id) OVER (ORDER BY doc_id), first_value(doc_id) OVER (ORDER BY doc_id)) AS nid FROM documents),
ed AS (SELECT doc_id, nid, t, CASE WHEN length(t) < 4 THEN t ELSE substr(t, 1, length(t) - length(t) // 4) || substr(nt, 1, length(t) // 4) END AS e FROM o),
{_sql_signatures('a', 'ed', 't')},
{_sql_signatures('b', 'ed', 'e')}
SELECT ed.doc_id, CAST(length(ed.t) AS BIGINT) AS n_chars, sha256(ed.e) AS edited_sha256,
       array_to_string(a.s, ' ') AS fingerprint, array_to_string(b.s, ' ') AS edited_fingerprint,
       CASE WHEN len(a.s) = 0 AND len(b.s) = 0 THEN 1.0 ELSE
         CAST(len(list_intersect(a.s, b.s)) AS DOUBLE) / (len(a.s) + len(b.s) - len(list_intersect(a.s, b.s))) END AS near_edited,
       CASE WHEN len(a.s) = 0 AND len(x.s) = 0 THEN 1.0 ELSE
         CAST(len(list_intersect(a.s, x.s)) AS DOUBLE) / (len(a.s) + len(x.s) - len(list_intersect(a.s, x.s))) END AS near_next,
       CAST(floor(ln(greatest(len(a.s), 1)) / ln(1 / {THRESHOLD}) + 1e-9) AS INTEGER) AS length_class
FROM ed JOIN a ON a.doc_id = ed.doc_id JOIN b ON b.doc_id = ed.doc_id JOIN a x ON x.doc_id = ed.nid
"""
