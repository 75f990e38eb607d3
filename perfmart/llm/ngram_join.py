"""Similarity join on word n-grams by multiple-global-order filtering.

A document is the set of its distinct k-word shingles (lower-cased A-Z, words of
anything but ASCII white space; fewer words than k form one shingle).  Two sets
link when percent * union <= 100 * intersection.  Linked sets share a token
among the first n - ceil(n * percent / 100) + 1 of each, under whatever global
order of tokens.  Candidates must do so under three orders: rarest first (by a
counting sketch of the corpus, ties by hash), and two by independent hashes.

Equal sets are one class, represented by its smallest id.  Classes meet on
their prefix tokens under the first order.  So that large groups of near copies
are not expanded into their pairs, each bucket of a token has a pivot, the set
with the commonest tokens (the likely origin of the group):

1. Every set of a bucket is compared with the pivot: one pair for a set.
2. Sets near a pivot p differ from it by few tokens, D(x) = x without p and p
   without x, and |x ^ y| = |D(x) ^ D(y)|.  If x is not linked with p, a link of
   x and y needs common tokens of D(x) and D(y); so these meet on prefixes of
   their differences, under one pivot, and are compared by their differences.
3. What remains are pairs with a set that is not near its bucket's pivot: they
   are candidates if their distances from the pivot allow a link (the size of
   the symmetric difference is a metric) and they are in different components.

Candidates of steps 1 and 3 pass the length filter and the two other orders
before their sets are compared, exactly (by shingle keys of 55 bits of hash and a level).
Those of step 2 need no order: they share a token of their differences already.
No link that matters to a component is lost.

A null or wordless text has the empty set, which links with nothing.  Rows with
one id and one text are one node.  Several texts under one id are compared each
for itself (``linked_rows``); as documents (``linked_components``) they are one.
A row without an id has the component of its equals, or null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from perfmart.llm.components import components, saved
from perfmart.llm.sketch import CHUNK_BITS, count_sketch, id_filter
from perfmart.llm.text import NOT_SPACE, Words, bound_batches, mix, slices, table, text_bytes

#: Counters of the sketch: one for so many bytes of text, 2**SKETCH_BITS at most (64 MB in a task).
SKETCH_BITS, SKETCH_BYTES = 24, 64
#: A set is near a pivot up to this many times the distance of a link.
NEAR = 3
_ORDERS = (np.uint64(0x8CB92BA72F3D8DD7), np.uint64(0x2545F4914F6CDD1D))


def shingles(texts: list, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(text index, shingle hash) of the distinct shingles, in this order."""
    words = Words(texts, NOT_SPACE, lower=True)
    n = np.diff(words.first)
    at = np.flatnonzero(words.whole(k)) if len(words.start) else np.zeros(0, np.int64)
    doc = np.searchsorted(words.first, at, "right") - 1
    few = np.flatnonzero((n > 0) & (n < k))
    h = words.gram(k)[at] if len(at) else np.zeros(0, np.uint64)
    if len(few):
        doc = np.concatenate([doc, few])
        h = np.concatenate([h, words.span_hash(words.first[few], words.first[few + 1])])
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
    return doc[new], h[new]


def _firsts(doc: np.ndarray, key: np.ndarray, size: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` smallest keys of each text, and the offsets of texts in them."""
    order = np.lexsort((key, doc))
    key = key[order]
    start = np.concatenate([[0], np.cumsum(size)])
    place = np.arange(len(key)) - np.repeat(start[:-1], size)
    return key[place < np.repeat(wanted, size)], np.concatenate([[0], np.cumsum(wanted)]).astype(np.int32)


def rare_keys(h: np.ndarray, level: np.ndarray) -> np.ndarray:
    """Tokens numbered in the first global order: by level, then by hash."""
    depth = level[(h & np.uint64(len(level) - 1)).astype(np.int64)]
    return (depth.astype(np.uint64) << np.uint64(55)) | (mix(h ^ np.uint64(0x9FB21C651E98DF25)) >> np.uint64(9))


def _lists(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


FEATURES = ("id bigint, n bigint, d1 bigint, d2 bigint, common float, "
            "rare array<bigint>, second array<smallint>, third array<smallint>")


def commonness(docs: DataFrame, k: int):
    """Levels of the corpus's shingles in a counting sketch (broadcast: its size is bounded)."""
    def hashes():
        return lambda batch: (shingles(text_bytes(p.column(0), "text"), k)[1] for p in slices(batch, "text"))

    size = docs.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    bits = min(SKETCH_BITS, max(CHUNK_BITS, (size // SKETCH_BYTES).bit_length()))
    level = count_sketch(docs.select(F.struct("id", "text").alias("row")), hashes, bits)
    return docs.sparkSession.sparkContext.broadcast(level)


def features(docs: DataFrame, k: int, percent: int, shared) -> DataFrame:
    """Set size, set digest, commonness and the three prefixes of each document
    (of the two that only filter, 16 bits of each token)."""
    packed = docs.select(F.struct("id", "text").alias("row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                rows = part.num_rows
                doc, h = shingles(text_bytes(part.column(0), "text"), k)
                size = np.bincount(doc, minlength=rows)
                wanted = np.where(size > 0, size - (size * percent + 99) // 100 + 1, 0)
                key, m = rare_keys(h, level), mix(h ^ np.uint64(0x9FB21C651E98DF25))
                sums = [np.zeros(rows, np.uint64), np.zeros(rows, np.uint64)]
                start = np.concatenate([[0], np.cumsum(size)])[:-1][size > 0]
                if len(h):
                    sums[0][size > 0] = np.add.reduceat(m, start)
                    sums[1][size > 0] = np.add.reduceat(mix(m), start)
                common = np.bincount(doc, weights=key >> np.uint64(55), minlength=rows) / np.maximum(size, 1)
                rare, offsets = _firsts(doc, key, size, wanted)
                other = [_firsts(doc, mix(h * c), size, wanted)[0].astype(np.uint16).view(np.int16) for c in _ORDERS]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).field("id"), pa.array(size, pa.int64()), *[pa.array(s.view(np.int64)) for s in sums],
                     pa.array(common, pa.float32()), _lists(rare.view(np.int64), offsets, pa.int64()),
                     *[_lists(o, offsets, pa.int16()) for o in other]],
                    ["id", "n", "d1", "d2", "common", "rare", "second", "third"])

    return packed.mapInArrow(run, FEATURES)


def shingle_sets(docs: DataFrame, ids: DataFrame, k: int, shared) -> DataFrame:
    """(id, s): the shingle keys, in order, of the documents in ``ids`` (id)."""
    ids = saved(ids, "wanted-sets")
    wanted = id_filter(ids)
    docs = docs.where(F.col("id").isNotNull())
    if wanted is None:
        docs = docs.join(ids, "id", "left_semi")
    packed = docs.select(F.struct("id", "text").alias("row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = shared.value
        for batch in batches:
            if wanted is not None:
                batch = batch.filter(pa.array(wanted(batch.column(0).field("id").to_numpy(zero_copy_only=False))))
            for part in slices(batch, "text"):
                doc, h = shingles(text_bytes(part.column(0), "text"), k)
                key = rare_keys(h, level)
                at = np.searchsorted(doc, np.arange(part.num_rows + 1))
                key = key[np.lexsort((key, doc))]
                yield pa.RecordBatch.from_arrays([part.column(0).field("id"), _lists(key.view(np.int64), at, pa.int64())], ["id", "s"])

    return packed.mapInArrow(run, "id bigint, s array<bigint>").join(ids, "id", "left_semi").dropDuplicates(["id"])


def _long_enough(a: Column, b: Column, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def compared(pairs: DataFrame, docs: DataFrame, traits: DataFrame, k: int, percent: int, shared) -> DataFrame:
    """(a, b, s_a, s_b): the shingle keys of those ``pairs`` (a, b) that pass the
    length filter and the second and third order."""
    def side(x: str) -> DataFrame:
        return traits.select(F.col("id").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in ("n", "second", "third")])

    passed = saved(pairs.join(side("a"), "a").join(side("b"), "b")
                   .where(_long_enough(F.col("n_a"), F.col("n_b"), percent))
                   .where(F.arrays_overlap("second_a", "second_b") & F.arrays_overlap("third_a", "third_b"))
                   .select("a", "b").distinct(), "candidates")
    ids = passed.select("a").unionByName(passed.select(F.col("b").alias("a"))).distinct().withColumnRenamed("a", "id")
    sets = shingle_sets(docs, ids, k, shared)
    return (passed.join(sets.select(F.col("id").alias("a"), F.col("s").alias("s_a")), "a")
                  .join(sets.select(F.col("id").alias("b"), F.col("s").alias("s_b")), "b"))


def _linked(difference: Column, sizes: Column, percent: int) -> Column:
    """percent * union <= 100 * intersection, by the symmetric difference."""
    return difference * (100 + percent) <= sizes * (100 - percent)


def compare_with_pivots(stars: DataFrame, docs: DataFrame, traits: DataFrame, k: int, percent: int, shared) -> DataFrame:
    """(id, pivot, n, np, d, linked, near, delta): each set's difference from its pivot."""
    both = compared(stars.select(F.col("id").alias("a"), F.col("pivot").alias("b")), docs, traits, k, percent, shared)
    n, np_ = F.size("s_a"), F.size("s_b")
    found = both.select(F.col("a").alias("id"), F.col("b").alias("pivot"), "s_a", "s_b", n.alias("n"), np_.alias("np"),
                        (n + np_ - 2 * F.size(F.array_intersect("s_a", "s_b"))).alias("d"))
    near = F.col("d") * (100 + percent) <= (F.col("n") + F.col("np")) * (NEAR * (100 - percent))
    return found.select("id", "pivot", "n", "np", "d", _linked(F.col("d"), F.col("n") + F.col("np"), percent).alias("linked"),
                        near.alias("near"), F.when(near, F.array_sort(F.concat(
                            F.array_except("s_a", "s_b"), F.array_except("s_b", "s_a")))).alias("delta"))


def links_by_difference(star: DataFrame, joined: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) under one pivot that a is not linked with (step 2)."""
    near = star.where("near").join(joined, "id", "left").withColumn("component", F.coalesce("component", "id"))
    lone = near.where(~F.col("linked"))
    all_ = near.join(lone.select("pivot").distinct(), "pivot", "left_semi")
    # prefixes: of a, for partners of any distance; of b, for partners not linked with the pivot
    most = F.floor(F.col("n") * (100 - percent) / percent).cast("int") + 1
    need = F.ceil((F.col("d") * (100 + percent) + (F.col("np") - F.col("n")) * (100 - percent)) / (2 * (100 + percent)))
    fewer = (F.col("d") - F.greatest(need, F.lit(1)) + 1).cast("int")

    def side(rows: DataFrame, x: str, prefix: Column) -> DataFrame:
        return rows.select("pivot", F.posexplode(F.slice("delta", 1, F.greatest(prefix, F.lit(0)))).alias(f"i_{x}", "t"),
                           F.col("id").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in ("n", "d", "component")])

    # Common tokens that a link needs, and those that can follow if this is the first one.
    wanted = (F.col("d_a") + F.col("d_b")) * (100 + percent) - (F.col("n_a") + F.col("n_b")) * (100 - percent)
    left = F.least(F.col("d_a") - F.col("i_a"), F.col("d_b") - F.col("i_b"))
    met = saved(side(lone, "a", most).join(side(all_, "b", fewer), ["pivot", "t"])
                .where((F.col("component_a") != F.col("component_b")) & _long_enough(F.col("n_a"), F.col("n_b"), percent)
                       & (left * (2 * (100 + percent)) >= wanted))
                .select("pivot", "a", "b").distinct(), "candidates")
    delta = star.where("near").select("pivot", "id", "n", "d", "delta")

    def own(x: str) -> DataFrame:
        return delta.select("pivot", F.col("id").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in ("n", "d", "delta")])

    difference = F.col("d_a") + F.col("d_b") - 2 * F.size(F.array_intersect("delta_a", "delta_b"))
    return (met.join(own("a"), ["pivot", "a"]).join(own("b"), ["pivot", "b"])
               .where(_linked(difference, F.col("n_a") + F.col("n_b"), percent)).select("a", "b").distinct())


def linked_components(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """(id, n, component) of each row of ``docs`` (id, text)."""
    return linked_rows(docs, k, percent).select("id", "n", "component")


#: The sign bit, set in the nodes of ids with several texts.
_MARK = -(1 << 63)


def linked_rows(docs: DataFrame, k: int = 5, percent: int = 80, one_node: bool = True) -> DataFrame:
    """(id, tag, n, component, first) of each row of ``docs`` (id, text): the
    smallest id of its component, and whether the row is the component's first
    text.  ``tag`` tells apart the texts of an id that has several (the hash of
    the text, else null); ``first`` is null for a row without an id; ``one_node``: whether these are linked."""
    bound_batches(docs.sparkSession)
    repeated = saved(docs.where(F.col("id").isNotNull()).groupBy("id").agg(
        F.min(F.xxhash64("text")).alias("x"), F.max(F.xxhash64("text")).alias("y")).where("x <> y").select("id"), "repeated-ids")
    if repeated.isEmpty():
        member, joined = _linked_nodes(docs.select("id", "text"), k, percent)
        return _placed(member, joined).select(
            "id", F.lit(None).cast("bigint").alias("tag"), "n", "component", (F.col("id") == F.col("component")).alias("first"))
    rows = docs.select("id", "text").join(repeated.select(F.col("id").alias("twice")), F.col("id") == F.col("twice"), "left").select(
        F.when(F.col("twice").isNotNull(), F.xxhash64("id", "text").bitwiseOR(F.lit(_MARK))).otherwise(F.col("id")).alias("id"),
        "text", F.col("twice").alias("own"))
    names = saved(rows.where(F.col("own").isNotNull()).select(F.col("id").alias("node"), "own", F.xxhash64("text").alias("tag")).distinct(), "nodes")
    same = names.join(names.groupBy("own").agg(F.min("node").alias("b")), "own").select(F.col("node").alias("a"), "b").where("a <> b")
    member, joined = _linked_nodes(rows.select("id", "text"), k, percent, same if one_node else None)
    found = saved(_placed(member, joined), "components")
    odd = found.join(names, found["id"] == names["node"], "left_semi").select("component").distinct()
    named = found.join(names, found["id"] == names["node"], "left").select(
        F.coalesce("own", "id").alias("id"), "tag", "n", "component")
    firsts = saved(named.join(odd, "component", "left_semi").where(F.col("id").isNotNull()).groupBy("component")
                        .agg(F.min(F.struct("id", "tag")).alias("lead")), "component-names")
    return named.join(firsts, "component", "left").select(
        "id", "tag", "n", F.coalesce("lead.id", "component").alias("component"),
        (F.col("id") == F.coalesce("lead.id", "component")).alias("own_name"), F.col("lead.tag").alias("lead_tag")).select(
        "id", "tag", "n", "component",
        F.when(F.col("id").isNotNull(), F.col("own_name") & F.col("tag").eqNullSafe(F.col("lead_tag"))).alias("first"))


def _placed(member: DataFrame, joined: DataFrame) -> DataFrame:
    return (member.join(joined.select(F.col("id").alias("rep"), "component"), "rep", "left")
                  .select("id", "n", F.coalesce("component", "rep").alias("component")))


def _linked_nodes(docs: DataFrame, k: int, percent: int, same: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(id, n, rep): each node's class; (id, component) of linked classes.
    ``same``: further links (a, b) of nodes."""
    shared = commonness(docs, k)
    found = saved(features(docs, k, percent, shared), "shingle-features")
    reps = found.where((F.col("n") > 0) & F.col("id").isNotNull()).groupBy("n", "d1", "d2").agg(F.min("id").alias("rep"))
    reps = saved(reps, "representatives")  # a plain table joins with hot keys split
    member = saved(found.select("id", "n", "d1", "d2").join(reps, ["n", "d1", "d2"], "left")
                        .select("id", "n", F.coalesce("rep", "id").alias("rep")), "members")
    own = member.where((F.col("id") == F.col("rep")) & (F.col("n") > 0)).select("id").distinct()
    traits = found.join(own, "id", "left_semi").dropDuplicates(["id"])

    by_token = Window.partitionBy("t").orderBy(F.col("common").desc(), "id")  # the pivot comes first; one shuffle
    first_of = {c: F.first(c).over(by_token) for c in ("id", "n")}
    buckets = saved(traits.select("id", "n", "common", F.explode("rare").alias("t"))
                    .select("t", "id", "n", first_of["id"].alias("pivot"), first_of["n"].alias("np"), F.row_number().over(by_token).alias("k"))
                    .where((F.col("k") > 1) & (F.col("id") != F.col("pivot")))
                    .select("t", "id", "n", "pivot", _long_enough(F.col("n"), F.col("np"), percent).alias("fits")), "buckets")
    star = saved(compare_with_pivots(buckets.where("fits").select("id", "pivot").distinct(), docs, traits, k, percent, shared), "stars")
    first = star.where("linked").select(F.col("id").alias("a"), F.col("pivot").alias("b"))
    joined = components(first)
    second = saved(links_by_difference(star, joined, percent), "links-by-difference")

    # Pairs with a set that is not near the pivot of their bucket (step 3).
    placed = (buckets.join(joined, "id", "left").join(star.select("id", "pivot", "d", "near"), ["id", "pivot"], "left")
                     .select("t", "id", "n", "d", F.coalesce("near", F.lit(False)).alias("near"),
                             F.coalesce("component", "id").alias("component")))
    open_tokens = (placed.groupBy("t").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.min("near").alias("all_near"))
                         .where("x <> y AND NOT all_near").select("t"))
    rest = saved(placed.join(open_tokens, "t", "left_semi"), "open-buckets")
    left, right = (rest.select(F.col("t").alias(f"t{x}"), F.col("id").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in ("n", "d", "near", "component")])
                   for x in "ab")
    reach = (F.abs(F.col("d_a") - F.col("d_b")) * (100 + percent) <= (F.col("n_a") + F.col("n_b")) * (100 - percent))
    pairs = (left.where(~F.col("near_a")).join(
        right, (F.col("ta") == F.col("tb")) & (F.col("near_b") | (F.col("a") < F.col("b"))) & (F.col("component_a") != F.col("component_b"))
        & _long_enough(F.col("n_a"), F.col("n_b"), percent) & F.coalesce(reach, F.lit(True))).select("a", "b").distinct())
    last = compared(pairs, docs, traits, k, percent, shared)
    sizes = F.size("s_a") + F.size("s_b")
    third = last.where(_linked(sizes - 2 * F.size(F.array_intersect("s_a", "s_b")), sizes, percent)).select("a", "b")
    links = first.unionByName(second).unionByName(third)
    if same is not None:
        reps_of = member.select(F.col("id").alias("node"), "rep").distinct()
        links = links.unionByName(same.join(reps_of.select(F.col("node").alias("a"), F.col("rep").alias("x")), "a")
                                      .join(reps_of.select(F.col("node").alias("b"), F.col("rep").alias("y")), "b")
                                      .select(F.col("x").alias("a"), F.col("y").alias("b")))
    return member, components(links)


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents``: 3-word shingles, similarity 0.9."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text").withColumnRenamed("doc_id", "id")
    found = linked_components(docs, 3, 90)
    return found.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


ORACLE_OP6 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS s
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 2))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS m FROM s x JOIN s y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2),
l AS (
  SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * m >= 90 * (na.n + nb.n - m)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r(id, reach) AS (SELECT doc_id, doc_id FROM w UNION SELECT r.id, e.b FROM r JOIN e ON e.a = r.reach)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id
FROM w LEFT JOIN n USING (doc_id) JOIN (SELECT id AS doc_id, min(reach) AS component_id FROM r GROUP BY 1) c USING (doc_id)
"""
