"""Benchmark decontamination with a generalised suffix automaton.

The words of the benchmark items (lower-cased A-Z) are dealt into blocks of at
most ``BLOCK_WORDS`` words; a longer item is cut into pieces that share
``window`` - 1 words, so that each of its windows lies in one.  Candidate
stretches of a text are the windows all of whose word triples are in a bitmap
of the items' triples (of fixed size, broadcast).  Distinct stretches go to the
blocks that hold the least triple of one of their windows; the task that has a
block (and a slice of its stretches) builds the block's suffix automaton, and
streams the stretches through it: the state and the longest matching length
follow word by word, so every occurrence of an item window of ``window`` words
(or of a whole shorter item) is seen at its last word.  A worker holds one
block at a time, and nothing of the items but the bitmap is on the driver.

A null text has no words.  A null or wordless item has no window; an item
without an id still marks words but is not listed.  Equal item ids count once.
Repeated documents are judged row by row.  An empty benchmark hits nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from perfmart.llm.components import saved
from perfmart.llm.sketch import CHUNK_BITS, count_sketch
from perfmart.llm.text import ALNUM, Words, annotate, mix, slices, table

WINDOW = 13
#: Item words of one automaton: bounds what a worker holds at once (about 100 MB).
BLOCK_WORDS = 200_000
#: Words of stretches that one task streams through a block, at least.
SLICE_WORDS = 10_000
#: Bits of the bitmap of item grams: eight for a word, 2**FILTER_BITS at most (2 MB).
FILTER_BITS = 24


class SuffixAutomaton:
    """Generalised over several sequences of integers."""

    def __init__(self):
        self.length, self.link, self.next = [0], [-1], [{}]

    def _clone(self, p: int, q: int, c: int) -> int:
        new = len(self.length)
        self.length.append(self.length[p] + 1)
        self.link.append(self.link[q])
        self.next.append(dict(self.next[q]))
        self.link[q] = new
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = new
            p = self.link[p]
        return new

    def add(self, sequence: list[int]) -> None:
        last = 0
        for c in sequence:
            p = last
            q = self.next[p].get(c)
            if q is not None:  # an earlier sequence came here already
                last = q if self.length[q] == self.length[p] + 1 else self._clone(p, q, c)
                continue
            new = len(self.length)
            self.length.append(self.length[last] + 1)
            self.link.append(0)
            self.next.append({})
            while p >= 0 and c not in self.next[p]:
                self.next[p][c] = new
                p = self.link[p]
            if p >= 0:
                q = self.next[p][c]
                self.link[new] = q if self.length[q] == self.length[p] + 1 else self._clone(p, q, c)
            last = new

    def stream(self, sequence) -> Iterator[tuple[int, int]]:
        """(state, longest matching length) at each position."""
        state, size = 0, 0
        for c in sequence:
            while state and c not in self.next[state]:
                state = self.link[state]
                size = self.length[state]
            if c in self.next[state]:
                state = self.next[state][c]
                size += 1
            yield state, size

    def holding(self, state: int, size: int) -> int:
        """The state of the last ``size`` words of a longer match."""
        while self.length[self.link[state]] >= size:
            state = self.link[state]
        return state


class Matcher:
    """The automaton of one block with the items that own each window."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int = WINDOW):
        self.window = window
        words = Words([t for _, t in items], ALNUM, lower=True)
        self.vocabulary = np.unique(words.hash)
        ids = self.numbers(words.hash)
        seqs = [ids[a:b] for a, b in zip(words.first[:-1], words.first[1:], strict=True)]
        self.sam = SuffixAutomaton()
        for s in seqs:
            self.sam.add(s)
        self.owners: dict[int, set] = {}  # state of a full window -> items
        self.short: dict[int, list] = {}  # state -> (words, item) of whole shorter items
        for (item, _), s in zip(items, seqs, strict=True):
            for k, (state, size) in enumerate(self.sam.stream(s)):
                if size >= window:
                    self.owners.setdefault(self.sam.holding(state, window), set()).add(item)
                elif k == len(s) - 1 and len(s) < window:
                    self.short.setdefault(state, []).append((len(s), item))

    def numbers(self, words: np.ndarray) -> list[int]:
        """The block's numbers of word hashes; -1 for words it has not."""
        if not len(self.vocabulary):
            return [-1] * len(words)
        at = np.minimum(np.searchsorted(self.vocabulary, words), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == words, at, -1).tolist()

    def hits(self, words: np.ndarray) -> tuple[list, set]:
        """Word spans [a, b) and items of one stretch of word hashes."""
        sam, window = self.sam, self.window
        spans: list = []
        items: set = set()
        for i, (state, size) in enumerate(sam.stream(self.numbers(words))):
            start = None
            if size >= window:
                items |= self.owners[sam.holding(state, window)]
                start = i - size + 1
            if self.short:
                v, most = state, size
                while v > 0:
                    for m, item in self.short.get(v, ()):
                        if m <= most:
                            items.add(item)
                            start = min(i - m + 1, i if start is None else start)
                    v = sam.link[v]
                    most = sam.length[v]
            if start is not None:
                while spans and spans[-1][1] >= start:
                    start = min(start, spans.pop()[0])
                spans.append((start, i + 1))
        return spans, items


def _grams(words: Words, q: int) -> np.ndarray:
    return mix(words.gram(q) + np.uint64(q))


def _key(grams: np.ndarray, at: np.ndarray, m: int) -> np.ndarray:
    """Where windows of m words meet: the least of their grams."""
    q = min(3, m)
    return mix(np.min([grams[at + j] for j in range(m - q + 1)], axis=0) + np.uint64(m))


def dealt(benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(block, item, data, n, keys): pieces of items with their number of words
    and the keys of their windows; a block has at most ``block_words`` words
    (or four windows)."""
    half = max(block_words // 2, 2 * window)
    items = (benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text"))
                      .where(F.col("text").isNotNull()).distinct().select(F.struct("item", "text").alias("row")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                for row in part.column(0).to_pylist():
                    data = row["text"].encode()
                    words = Words([data], ALNUM, lower=True)
                    n = len(words.start)
                    starts = list(range(0, max(n - window, 0) + 1, half - window + 1)) if n > half else [0] * (n > 0)
                    if not starts:
                        continue
                    m = min(n, window)
                    key = _key(_grams(words, min(3, m)), np.arange(n - m + 1), m).view(np.int64)
                    ends = [min(n, i + half) for i in starts]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([row["item"]] * len(starts), pa.string()),
                        pa.array([data[words.start[i]:words.end[j - 1]] for i, j in zip(starts, ends, strict=True)], pa.binary()),
                        pa.array([j - i for i, j in zip(starts, ends, strict=True)], pa.int64()),
                        pa.array([np.unique(key[i:j - m + 1]) for i, j in zip(starts, ends, strict=True)], pa.list_(pa.int64()))],
                        ["item", "data", "n", "keys"])

    pieces = saved(items.mapInArrow(cut, "item string, data binary, n bigint, keys array<bigint>"), "item-pieces")
    shards = -(-(pieces.agg(F.sum("n").alias("n")).first().n or 1) // half)
    order = F.xxhash64("item", "data")
    row = Window.partitionBy("shard").orderBy("order", "item", "data").rowsBetween(Window.unboundedPreceding, 0)
    # pieces end in one half of a block, and the first may begin in the half before
    placed = (pieces.select("*", order.alias("order"), F.pmod(order, F.lit(shards)).alias("shard"))
                    .select("*", F.floor((F.sum("n").over(row) - 1) / half).alias("part")))
    return saved(placed.select(F.struct("shard", "part").alias("block"), "item", "data", "n", "keys"), "item-blocks")


def gram_filter(pieces: DataFrame, window: int) -> np.ndarray:
    """A bitmap of the grams of three words of all items (all words of shorter ones)."""
    def make():
        def fn(batch: pa.RecordBatch) -> list[np.ndarray]:
            words = Words(batch.column(0).to_pylist(), ALNUM, lower=True)
            n = np.diff(words.first)
            size = np.repeat(np.minimum(np.minimum(n, window), 3), n)  # of the grams of each word's item
            return [_grams(words, q)[words.whole(q) & (size == q)] for q in (1, 2, 3)]
        return fn

    n = pieces.agg(F.sum("n").alias("n")).first().n or 0
    return np.packbits(count_sketch(pieces.select("data"), make, min(FILTER_BITS, max(CHUNK_BITS, (8 * n).bit_length()))) > 0)


def _stretches(words: Words, bitmap: np.ndarray, lengths: list[int]) -> list[list]:
    """Candidate stretches of each text: word offset, word hashes, their digest,
    the bytes where words start and end, and the keys of their windows."""
    out: list[list] = [[] for _ in range(len(words.first) - 1)]
    n = len(words.start)
    begin, end, key = [], [], []
    for q in {min(3, m) for m in lengths}:
        grams = _grams(words, q)
        at = grams & np.uint64(8 * len(bitmap) - 1)
        known = (bitmap[(at >> np.uint64(3)).astype(np.int64)] >> (np.uint64(7) - (at & np.uint64(7))).astype(np.uint8)) & 1 > 0
        # the last q - 1 words of a text start no gram, so no run of grams goes over its end
        run = np.concatenate([[0], np.cumsum(known & words.whole(q))])
        for m in lengths:
            r = m - q + 1
            if min(3, m) == q and n >= r:
                found = np.flatnonzero(run[r:] - run[:-r] == r)
                if len(found):
                    begin.append(found)
                    end.append(found + m)
                    key.append(_key(grams, found, m))
    if not begin:
        return out
    begin, end, key = np.concatenate(begin), np.concatenate(end), np.concatenate(key).view(np.int64)
    order = np.lexsort((end, begin))
    begin, end, key = begin[order], np.maximum.accumulate(end[order]), key[order]
    new = np.flatnonzero(np.concatenate([[True], begin[1:] >= end[:-1]]))
    for i, j in zip(new.tolist(), [*new[1:].tolist(), len(begin)], strict=True):
        a, b = int(begin[i]), int(end[j - 1])
        d = int(np.searchsorted(words.first, a, "right")) - 1
        data, base = words.hash[a:b].astype("<u8").tobytes(), int(words.at[d])
        out[d].append({"at": a - int(words.first[d]), "data": data, "digest": hashlib.md5(data).digest(),
                       "from": words.start[a:b] - base, "to": words.end[a:b] - base, "keys": np.unique(key[i:j])})
    return out


SPANS = "array<struct<a:int,b:int,from:int,to:int>>"
STRETCHES = "array<struct<at:int,data:binary,digest:binary,from:array<int>,to:array<int>,keys:array<bigint>>>"


def merged(spans: Column) -> Column:
    """The spans in order, those that meet or overlap joined to one."""
    def add(out: Column, s: Column) -> Column:
        last = F.get(out, F.size(out) - 1)
        longer = F.struct(last["a"].alias("a"), F.greatest(last["b"], s["b"]).alias("b"),
                          last["from"].alias("from"), F.greatest(last["to"], s["to"]).alias("to"))
        return F.when(s["a"] <= last["b"], F.concat(F.slice(out, 1, F.size(out) - 1), F.array(longer))).otherwise(
            F.concat(out, F.array(s)))

    return F.aggregate(F.array_sort(spans), F.array().cast(SPANS), add)


def block_hits(stretches: DataFrame, pieces: DataFrame, window: int) -> DataFrame:
    """(digest, a, b, items) of the distinct ``stretches`` (digest, data, keys):
    each block with a slice of the stretches that have one of its keys."""
    keys = pieces.select("block", F.explode("keys").alias("key")).distinct()
    texts = saved(stretches.dropDuplicates(["digest"]), "stretches")
    met = saved(texts.select("digest", F.octet_length("data").alias("size"), F.explode("keys").alias("key"))
                     .join(keys, "key").select("block", "digest", "size").distinct(), "stretch-blocks")
    load = met.groupBy("block").agg((F.sum("size") / 8).alias("words"))
    parts = saved(pieces.groupBy("block").agg(F.sum("n").alias("n")).join(load, "block").select(
        "block", F.ceil(F.col("words") / F.greatest("n", F.lit(SLICE_WORDS))).alias("parts")), "block-slices")
    left = pieces.join(parts, "block").select("block", "item", "data", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part"))
    right = (met.join(F.broadcast(parts), "block").join(texts.select("digest", "data"), "digest")
                .select("block", "digest", "data", F.pmod(F.xxhash64("digest"), "parts").alias("part")))

    def match(items: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(items) and len(found):
            matcher = Matcher([(i, bytes(t)) for i, t in zip(items["item"], items["data"], strict=True)], window)
            for digest, data in zip(found["digest"], found["data"], strict=True):
                spans, owners = matcher.hits(np.frombuffer(bytes(data), dtype="<u8"))
                if spans:
                    out.append((bytes(digest), [a for a, _ in spans], [b for _, b in spans], sorted(x for x in owners if x is not None)))
        return pd.DataFrame(out, columns=["digest", "a", "b", "items"])

    return (left.groupBy("block", "part").cogroup(right.groupBy("block", "part"))
                .applyInPandas(match, "digest binary, a array<int>, b array<int>, items array<string>"))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  block_words: int = BLOCK_WORDS, carry: list[str] | None = None) -> DataFrame:
    """``row`` (the document) with its number of ``words``, the hit ``spans``
    (words [a, b), bytes [from, to)) and the matching ``items``.  The documents
    are read once and written with their candidate stretches."""
    pieces = dealt(benchmark, window, block_words)
    lengths = sorted(r.m for r in pieces.select(F.least("n", F.lit(window)).alias("m")).distinct().collect())
    shared = docs.sparkSession.sparkContext.broadcast(gram_filter(pieces, window))

    def make():
        def fn(texts):
            words = Words(texts, ALNUM, lower=True)
            return [np.diff(words.first), _stretches(words, shared.value, lengths)]
        return fn

    read = saved(annotate(docs, f"words bigint, stretches {STRETCHES}", make, carry=carry)
                 .withColumn("place", F.monotonically_increasing_id()), "candidates")
    each = read.select("place", F.explode("stretches").alias("s")).select("place", "s.*")
    hits = saved(block_hits(each.select("digest", "data", "keys"), pieces, window), "block-hits")
    spans = F.transform(F.arrays_zip("a", "b"), lambda x: F.struct(
        (x["a"] + F.col("at")).alias("a"), (x["b"] + F.col("at")).alias("b"),
        F.get("from", x["a"]).alias("from"), F.get("to", x["b"] - 1).alias("to")))
    found = (each.select("place", "at", "digest", "from", "to").join(hits, "digest").select("place", spans.alias("spans"), "items")
                 .groupBy("place").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_set("items")).alias("items"))
                 .select("place", merged(F.col("spans")).alias("spans"), F.array_sort(F.array_distinct("items")).alias("items")))
    none = [F.array().cast(SPANS), F.array().cast("array<string>")]
    clean = read.where(F.size("stretches") == 0).select("row", "words", none[0].alias("spans"), none[1].alias("items"))
    suspect = read.where(F.size("stretches") > 0).select("place", "row", "words").join(found, "place", "left")
    return clean.unionByName(suspect.select("row", "words", F.coalesce("spans", none[0]).alias("spans"), F.coalesce("items", none[1]).alias("items")))


def hit_words() -> Column:
    return F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + (s["b"] - s["a"]))


def contaminated() -> Column:
    """The rule: some word is hit and at least a twentieth of all."""
    return (hit_words() > 0) & (F.lit(20) * hit_words() >= F.col("words"))


def without_spans(text: Column, spans: Column) -> Column:
    """The text without the spans' bytes."""
    binary = text.cast("binary")
    def after(i):
        return F.when(i == 0, F.lit(0)).otherwise(F.get(spans, i - 1)["to"])

    keep = F.transform(
        F.sequence(F.lit(0), F.size(spans)),
        lambda i: F.substring(binary, after(i) + 1, F.coalesce(F.get(spans, i)["from"], F.octet_length(binary)) - after(i)))
    return F.when(F.size(spans) == 0, text).otherwise(
        F.decode(F.aggregate(keep, F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x)), "UTF-8"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents`` against every ``benchmark`` item."""
    found = contamination(table(spark, sf_dir, "documents", "doc_id", "text"),
                          table(spark, sf_dir, "benchmark", "item_id", "text"), carry=["doc_id"])
    return found.select(F.col("row.doc_id").alias("doc_id"), F.col("words").alias("n_words"),
                        hit_words().alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
                        contaminated().alias("contaminated"))


ORACLE_OP9 = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS m, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(generate_series(1, len(w) - least(13, len(w)) + 1)) AS i FROM b WHERE len(w) > 0)),
dw AS (
  SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS win
  FROM (SELECT doc_id, w, m, unnest(generate_series(1, len(w) - m + 1)) AS i
        FROM d, (SELECT DISTINCT m FROM bw) WHERE len(w) >= m)),
hit AS (SELECT dw.doc_id, dw.i, dw.m, bw.item_id FROM dw JOIN bw ON dw.m = bw.m AND dw.win = bw.win),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + m - 1)) AS p FROM hit) GROUP BY 1),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS s
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM hit) GROUP BY 1)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(s, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""
