"""Conversation prefix trie.

A conversation is a sequence of turns (role, text); every distinct sequence of
first turns is a node of the trie, from the root without turns.

1. A turn is the 128-bit MD5 of its role and text, a conversation the digests of
   its turns one after another.  These byte strings sort as the sequences do.
2. The conversations are range-partitioned and sorted by (sequence, id).  Every
   ``SHARD_TURNS`` turns of a partition are a shard: a contiguous range, however
   many conversations are alike.
3. A shard encodes its turns by a dictionary of its own and inserts its distinct
   sequences, the median first, in a ternary search tree.  Children are made
   after their parents, so one pass from the last node to the first accumulates
   members, leaves and savings.
4. Only prefixes of a shard's first and last sequence can be nodes of other
   shards as well.  These boundary nodes are merged: what is their own is added
   up by prefix digest; then each is counted once, on the path of its first
   shard, by running sums from the end of every path, added up by prefix.

Rows without a conversation id belong to none and are left out; a null role or
text is empty.  Turns are ordered by turn (null first), equal turns by role and
then by the digest; repeated rows are repeated turns.  An empty table has no
nodes.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from perfmart.llm.components import saved
from perfmart.llm.text import table
from perfmart.operators.relational import salted_join

#: Turns of a shard (one longer conversation is a shard of its own).
SHARD_TURNS = 100_000
#: Turn numbers of one conversation that are gathered in one group.
BLOCK = 1_024
#: Turns that a conversation can take over from the first of its family.
HEAD = 8
FAMILY = 5
#: Tasks over which the nodes that hang on one boundary node are spread.
SALTS = 16


def sequences(rows: DataFrame) -> DataFrame:
    """(conv_id, turns): the digests (hexadecimal) and text bytes of the turns
    of each conversation, in order.  Gathered by blocks of turn numbers first,
    so a very long conversation is sorted in many tasks."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    key = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    turns = rows.where(F.col("conv_id").isNotNull()).select(
        "conv_id", F.floor(F.col("turn") / BLOCK).alias("block"),
        F.struct("turn", role.alias("role"), key.alias("key"), F.octet_length(text).cast("bigint").alias("bytes")).alias("t"))
    blocks = turns.groupBy("conv_id", "block").agg(
        F.transform(F.sort_array(F.collect_list("t")), lambda t: F.struct(t.key.alias("key"), t.bytes.alias("bytes"))).alias("turns"))
    return blocks.groupBy("conv_id").agg(F.flatten(F.transform(
        F.sort_array(F.collect_list(F.struct("block", "turns"))), lambda b: b.turns)).alias("turns"))


def with_shared_heads(found: DataFrame) -> DataFrame:
    """Every conversation rebuilt: the first h turns of the first of its family
    (conv_id less conv_id mod 5), then its own after h, with h = crc32 of
    the id, mod 9.  Ids are few in a family, so the join has no hot key."""
    heads = found.where(F.col("conv_id") % FAMILY == 0).select(
        F.col("conv_id").alias("family"), F.slice("turns", 1, HEAD).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (HEAD + 1)).cast("int")
    own = found.select("conv_id", "turns", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("family"))
    none = F.slice("turns", 1, 0)
    rest = F.when(F.size("turns") > F.col("h"), F.slice(F.col("turns"), F.col("h") + 1, F.size("turns"))).otherwise(none)
    head = F.coalesce(F.slice(F.col("head"), F.lit(1), F.col("h")), none)
    return own.join(heads, "family", "left").select("conv_id", F.concat(head, rest).alias("turns"))


class Trie:
    """A ternary search tree over sequences of small numbers.  Tree nodes are
    the trie's nodes, the first being the root."""

    def __init__(self):
        self.symbol, self.less, self.more, self.below, self.parent, self.depth = [-1], [-1], [-1], [-1], [-1], [0]

    def _make(self, symbol: int, parent: int) -> int:
        self.symbol.append(symbol)
        self.less.append(-1)
        self.more.append(-1)
        self.below.append(-1)
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1)
        return len(self.symbol) - 1

    def insert(self, sequence: list[int]) -> int:
        """The node of the whole sequence."""
        symbol, less, more, below = self.symbol, self.less, self.more, self.below
        node = 0
        for x in sequence:
            at, link, child = node, below, below[node]
            while child >= 0 and symbol[child] != x:
                at, link = child, less if x < symbol[child] else more
                child = link[child]
            if child < 0:
                child = self._make(x, node)
                link[at] = child
            node = child
        return node

    def path(self, node: int) -> list[int]:
        out = [node]
        while node:
            node = self.parent[node]
            out.append(node)
        return out[::-1]


def median_first(n: int) -> Iterator[int]:
    """0..n-1, the middle of every range before its halves."""
    ranges = [(0, n)]
    while ranges:
        a, b = ranges.pop()
        if a < b:
            m = (a + b) // 2
            yield m
            ranges += [(m + 1, b), (a, m)]


FIELDS = ("shard bigint, side int, key string, parent_key string, depth bigint, conv_id bigint, parent_conv_id bigint, "
          "n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, bytes bigint, first_end bigint, ends string, "
          "counted boolean")
_EMPTY = hashlib.sha256(b"").hexdigest()


def shard_nodes(shard: int, ids: np.ndarray, keys: list[bytes], sizes: list[np.ndarray]) -> pa.RecordBatch:
    """The nodes of conversations sorted by (sequence, id).  A node that no
    other shard can have is whole: ``side`` is null and ``ends`` is the digest.
    The prefixes of the first (side 0) and of the last sequence (side 1) have
    their own part: members and their ids here, and the children, leaves and
    savings of the nodes below them that are whole; a prefix of both is
    ``counted`` on side 0."""
    width = 16
    flat = np.frombuffer(b"".join(keys), dtype=f"S{width}")
    number = np.unique(flat, return_inverse=True)[1]
    length = np.array([len(k) // width for k in keys], dtype=np.int64)
    begin = np.concatenate([[0], np.cumsum(length)])
    lead = [0, *[i for i in range(1, len(keys)) if keys[i] != keys[i - 1]]]
    stop = [*lead[1:], len(keys)]
    trie = Trie()
    ends: dict[int, tuple[int, int]] = {}
    text_bytes = [0]
    for m in median_first(len(lead)):
        i = lead[m]
        before = len(trie.symbol)
        node = trie.insert(number[begin[i]:begin[i + 1]].tolist())
        made = len(trie.symbol) - before
        if made:  # the new nodes are the last ones of the sequence
            text_bytes += sizes[i][len(sizes[i]) - made:].tolist()
        ends[node] = (i, stop[m])
    count = len(trie.symbol)
    members, least = [0] * count, [None] * count
    children, leaves, savings = [0] * count, [0] * count, [0] * count
    side = [None] * count
    paths = [trie.path(trie.insert(number[begin[i]:begin[i + 1]].tolist())) for i in (0, len(keys) - 1)]
    for s in (1, 0):
        for node in paths[s]:
            side[node] = s
    for node, (a, b) in ends.items():
        members[node], least[node] = b - a, int(ids[a:b].min())
    parent = trie.parent
    for node in range(count - 1, -1, -1):
        if side[node] is None:
            if not children[node]:
                leaves[node] = 1
            savings[node] += (members[node] - 1) * text_bytes[node]
        if node:
            up = parent[node]
            members[up] += members[node]
            if least[up] is None or least[node] < least[up]:
                least[up] = least[node]
            if side[node] is None:  # boundary nodes are counted when they are merged
                children[up] += 1
                leaves[up] += leaves[node]
                savings[up] += savings[node]

    def said(node: int) -> str:
        a, b = ends.get(node, (0, 0))
        return ",".join(map(str, ids[a:b].tolist()))

    digests: list[list[str]] = []
    for s, i in enumerate((0, len(keys) - 1)):
        h = hashlib.md5(usedforsecurity=False)
        digests.append([h.hexdigest()])
        for d in range(len(keys[i]) // width):
            h.update(keys[i][d * width:(d + 1) * width])
            digests[s].append(h.hexdigest())
    named = {node: k for s in (0, 1) for node, k in zip(paths[s], digests[s], strict=True)}
    out: dict[str, list] = {f.split()[0]: [] for f in FIELDS.split(", ")}

    def put(node: int, s: int | None, key: str | None, counted: bool) -> None:
        up = parent[node]
        own = said(node)
        row = (shard, s, key, named.get(up), trie.depth[node], least[node], least[up] if node else None,
               members[node], children[node], leaves[node], savings[node], text_bytes[node],
               int(ids[ends[node][0]]) if own and s is not None else None,
               own if s is not None else hashlib.sha256(own.encode()).hexdigest() if own else _EMPTY, counted)
        for column, value in zip(out.values(), row, strict=True):
            column.append(value)

    for node in range(count):
        if side[node] is None:
            put(node, None, None, True)
    for s in (0, 1):
        for node in paths[s]:
            put(node, s, named[node], side[node] == s)
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}
    types = [kinds[f.split()[1]] for f in FIELDS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types, strict=True)], list(out))


def nodes_by_shard(found: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The nodes of every range shard (see ``shard_nodes``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        shard = TaskContext.get().partitionId() << 32
        ids, keys, sizes, held = [], [], [], 0
        for batch in batches:
            lists = batch.column("sizes")
            at, values = lists.offsets.to_numpy(), lists.values.to_numpy()
            for k, (i, key) in enumerate(zip(batch.column("conv_id").to_pylist(), batch.column("seq").to_pylist(), strict=True)):
                n = int(at[k + 1] - at[k])
                if keys and held + n > shard_turns:
                    yield shard_nodes(shard, np.array(ids), keys, sizes)
                    shard += 1
                    ids, keys, sizes, held = [], [], [], 0
                ids.append(i)
                keys.append(key)
                sizes.append(values[at[k]:at[k + 1]])
                held += n + 1
        if keys:
            yield shard_nodes(shard, np.array(ids), keys, sizes)

    flat = found.select("conv_id", F.unhex(F.array_join(F.transform("turns", lambda t: t.key), "")).alias("seq"),
                        F.transform("turns", lambda t: t.bytes).alias("sizes"))
    return flat.repartitionByRange("seq", "conv_id").sortWithinPartitions("seq", "conv_id").mapInArrow(run, FIELDS)


RESULT = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def prefix_trie(found: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row for each node of the trie over ``found`` (see ``sequences``)."""
    parts = saved(nodes_by_shard(found, shard_turns), "trie-nodes")
    paths = parts.where(F.col("side").isNotNull())
    own = saved(paths.where("counted").groupBy("key", "parent_key", "depth").agg(
        F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("n_children"),
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"), F.max("bytes").alias("bytes"),
        F.min(F.struct("shard", "side")).alias("owner"), _joined(F.col("first_end"), F.col("ends")).alias("ends")), "trie-boundary")
    # children, and whether a boundary node is a leaf, are known now
    kids = own.where(F.col("parent_key").isNotNull()).groupBy(F.col("parent_key").alias("key")).agg(F.count("*").alias("kids"))
    own = own.join(kids, "key", "left").withColumn("n_children", F.col("n_children") + F.coalesce("kids", F.lit(0)))
    own = own.withColumns({
        "n_leaves": F.col("n_leaves") + (F.col("n_children") == 0).cast("bigint"),
        "saved_tokens": F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("bytes")})
    here = (F.col("owner.shard") == F.col("shard")) & (F.col("owner.side") == F.col("side"))
    path = Window.partitionBy("shard", "side").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    below = (salted_join(paths.select("shard", "side", "depth", "key"),
                         own.select("key", "owner", "n_leaves", "saved_tokens"), ["key"], salts=SALTS)
             .select("key", *[F.sum(F.when(here, F.col(c)).otherwise(0)).over(path).alias(c) for c in ("n_leaves", "saved_tokens")])
             .groupBy("key").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens")))
    names = own.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    merged = (own.drop("n_leaves", "saved_tokens").join(below, "key").join(names, "parent_key", "left")
                 .withColumn("ends_sha256", F.sha2(F.col("ends").cast("binary"), 256)).select(*RESULT))
    whole = parts.where(F.col("side").isNull()).withColumnRenamed("ends", "ends_sha256")
    inner = whole.where(F.col("parent_key").isNull()).select(*RESULT)
    # very many nodes may hang on one boundary node (the root above all)
    outer = salted_join(whole.where(F.col("parent_key").isNotNull()).drop("parent_conv_id"), names, ["parent_key"], salts=SALTS).select(*RESULT)
    return merged.unionByName(inner).unionByName(outer)


def _joined(first: Column, ends: Column) -> Column:
    """The id lists of the shards in one, by their first ids."""
    lists = F.sort_array(F.collect_list(F.when(first.isNotNull(), F.struct(first.alias("first"), ends.alias("ends")))))
    return F.array_join(F.transform(lists, lambda x: x.ends), ",")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all ``conversations``, with shared heads."""
    rows = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return prefix_trie(with_shared_heads(sequences(rows)))


# No zlib in DuckDB: crc32 of the decimal id, byte by byte over 8-bit steps.
_CRC = """list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda a, b: list_reduce(list_prepend(xor(a, b), [1, 2, 3, 4, 5, 6, 7, 8]),
      lambda x, k: xor(x >> 1, CASE WHEN x & 1 = 1 THEN CAST(3988292384 AS BIGINT) ELSE CAST(0 AS BIGINT) END)))"""

ORACLE_OP13 = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
k AS (SELECT conv_id, turn, role, md5(strlen(role) || ':' || role || text) AS key, CAST(strlen(text) AS BIGINT) AS bytes FROM t),
o AS (SELECT conv_id, key, bytes, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, key) AS i FROM k),
c AS (SELECT DISTINCT conv_id, conv_id - conv_id % 5 AS family, xor({_CRC}, CAST(4294967295 AS BIGINT)) % 9 AS h FROM o),
r AS (
  SELECT c.conv_id, o.i, o.key, o.bytes FROM c JOIN o ON o.conv_id = c.family AND o.i <= c.h
  UNION ALL SELECT c.conv_id, o.i + 100, o.key, o.bytes FROM c JOIN o ON o.conv_id = c.conv_id AND o.i > c.h),
s AS (
  SELECT c.conv_id, coalesce(list(r.key ORDER BY r.i) FILTER (r.key IS NOT NULL), []) AS keys,
         coalesce(list(r.bytes ORDER BY r.i) FILTER (r.key IS NOT NULL), []) AS sizes
  FROM c LEFT JOIN r USING (conv_id) GROUP BY 1),
p AS (
  SELECT conv_id, d, md5(array_to_string(keys[1:d], '')) AS node, CASE WHEN d > 0 THEN md5(array_to_string(keys[1:d - 1], '')) END AS up,
         CASE WHEN d > 0 THEN sizes[d] ELSE 0 END AS bytes, d = len(keys) AS ends
  FROM (SELECT *, unnest(generate_series(0, len(keys))) AS d FROM s)),
n AS (
  SELECT node, d, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM p GROUP BY node, d),
kids AS (SELECT up AS node, count(*) AS n_children FROM n WHERE up IS NOT NULL GROUP BY 1),
f AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN kids USING (node)),
sub AS (
  SELECT md5(array_to_string(s.keys[1:a.e], '')) AS node, a.e AS d, sum(CASE WHEN a.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves,
         sum((a.n_convs - 1) * a.bytes) AS saved_tokens
  FROM (SELECT *, unnest(generate_series(0, d)) AS e FROM f) a JOIN s ON s.conv_id = a.conv_id
  GROUP BY 1, 2)
SELECT f.conv_id, CAST(f.d AS BIGINT) AS depth, u.conv_id AS parent_conv_id, CAST(f.n_convs AS BIGINT) AS n_convs,
       CAST(f.n_children AS BIGINT) AS n_children, CAST(sub.n_leaves AS BIGINT) AS n_leaves,
       CAST(sub.saved_tokens AS BIGINT) AS saved_tokens, f.ends_sha256
FROM f JOIN sub ON sub.node = f.node LEFT JOIN f u ON u.node = f.up
"""
