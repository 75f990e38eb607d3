"""Substring deduplication with a compressed FM-index per shard.

A window is ``WINDOW`` consecutive words (of anything but ASCII white space) of
one document.  A word is removed if a window over it also starts in a document
with a smaller id.

1. The key of a window is the least hash of its ``GRAM``-word grams, so equal
   windows have equal keys, and neighbouring windows mostly share one.  Keys are
   kept if documents with different texts have them.
2. The stretches of windows under such keys are cut out of their documents and
   their distinct texts, each with the smallest id that has it, are dealt out by
   key.  Under a key of very many documents, or of more distinct words than a
   shard takes, every window is dealt out on its own (by its hash), so a passage
   that any number of documents share collapses to one row a window before it is
   shuffled, and no key makes a shard large.
3. Each shard (``SHARD_WORDS`` words, and one key's more at most) is an FM-index:
   the Burrows-Wheeler transform of its stretches in a wavelet matrix (packed
   bits with rank counts); intervals are marked in bit vectors, too.  The stretches are streamed
   through it from right to left by backward search: the interval of the last
   WINDOW - 1 words, widened from that of the window before, is extended by the
   next word to the left.  The smallest id within a window's interval decides.
4. The results return to the documents by key and digest of the stretch, and
   the covered words go.

Documents that equal an earlier one (128-bit digest of the word sequence) are
covered whole.  A null text has no words; texts shorter than a window lose
nothing.  Rows with one id never remove each other's words; a row with a null
id removes and loses nothing.  Extra columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perfmart.llm.components import saved
from perfmart.llm.sketch import FILTER_BITS, id_filter
from perfmart.llm.text import NOT_SPACE, Words, bound_batches, mix, slices, table, text_bytes

WINDOW = 50
GRAM = 20
#: Documents of one key from which its windows are dealt out one by one.
SPLIT = 20_000
#: Windows of one stretch at most (longer runs are cut, keeping every window).
STRETCH = 128
#: Words from which an FM-index is closed, and most words of one key in it.
SHARD_WORDS = 250_000


def window_keys(words: Words, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """(positions that start a whole window, their keys)."""
    at = np.flatnonzero(words.whole(window)) if len(words.start) else np.zeros(0, np.int64)
    if not len(at):
        return at, np.zeros(0, np.uint64)
    x = mix(words.gram(gram))
    n, size, span = len(x), 1, window - gram + 1
    while size * 2 <= span:  # the least of 1, 2, 4, ... grams from each position
        x = np.minimum(x, x[np.minimum(np.arange(n) + size, n - 1)])
        size *= 2
    return at, np.minimum(x[at], x[at + span - size])


def _digests(words: Words) -> tuple[np.ndarray, np.ndarray]:
    lo, hi = words.first[:-1], words.first[1:]
    one = words.span_hash(lo, hi)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(words.hash ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64)])
    return one, mix((total[hi] - total[lo]) ^ (one << np.uint64(1)))


def _packed(docs: DataFrame) -> DataFrame:
    """Rows with an id; ``tag`` tells apart texts under one id."""
    return docs.where(F.col("id").isNotNull()).select(
        F.struct("id", F.xxhash64("text").alias("tag"), "text").alias("row"))


def profiles(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Word count, digests and distinct window keys of each document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                rows = part.column(0)
                words = Words(text_bytes(rows, "text"), NOT_SPACE)
                at, key = window_keys(words, window)
                doc = np.searchsorted(words.first, at, "right") - 1
                order = np.lexsort((key, doc))
                doc, key = doc[order], key[order]
                new = np.ones(len(doc), dtype=bool)
                new[1:] = (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])
                doc, key = doc[new], key[new]
                first = np.searchsorted(doc, np.arange(part.num_rows + 1)).astype(np.int32)
                d1, d2 = _digests(words) if len(words.start) else (np.zeros(part.num_rows, np.uint64),) * 2
                yield pa.RecordBatch.from_arrays(
                    [rows.field("id"), rows.field("tag"), pa.array(np.diff(words.first), pa.int64()),
                     pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64)),
                     pa.ListArray.from_arrays(pa.array(first), pa.array(key.view(np.int64)))],
                    ["id", "tag", "n", "d1", "d2", "keys"])

    return _packed(docs).mapInArrow(run, "id bigint, tag bigint, n bigint, d1 bigint, d2 bigint, keys array<bigint>")


def stretches(docs: DataFrame, shared, split, window: int = WINDOW) -> DataFrame:
    """The stretches of windows whose key passes ``shared``; those whose key
    passes ``split`` window by window, under the window's own hash.  Both are
    tests of keys, or None where ``docs`` have the keys of every row (``wanted``
    and, of these, ``alone``)."""
    listed = shared is None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                rows = part.column(0)
                words = Words(text_bytes(rows, "text"), NOT_SPACE)
                at, key = window_keys(words, window)
                doc = np.searchsorted(words.first, at, "right") - 1
                keep = _among(rows.field("wanted"), doc, key) if listed else shared(key.view(np.int64))
                at, key, doc = at[keep], key[keep], doc[keep]
                if not len(at):
                    continue
                alone = _among(rows.field("alone"), doc, key) if listed else split(key.view(np.int64))
                new = np.ones(len(at), dtype=bool)
                new[1:] = (key[1:] != key[:-1]) | (at[1:] != at[:-1] + 1) | (doc[1:] != doc[:-1]) | alone[1:]
                begin = np.flatnonzero(new)
                offset = np.arange(len(at)) - np.repeat(begin, np.diff(np.append(begin, len(at))))
                new |= offset % STRETCH == 0
                begin = np.flatnonzero(new)
                last = np.append(begin[1:], len(at)) - 1
                lo, hi = at[begin], at[last] + window
                digest = words.span_hash(lo, hi)
                route = np.where(alone[begin], digest, key[begin])
                d, raw = doc[begin], words.buf.tobytes()
                text = [b" ".join(raw[a:b].split()) for a, b in zip(words.start[lo].tolist(), words.end[hi - 1].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [rows.field("id").take(pa.array(d)), rows.field("tag").take(pa.array(d)),
                     pa.array((lo - words.first[d]).astype(np.int32)), pa.array(route.view(np.int64)),
                     pa.array(digest.view(np.int64)), pa.array((hi - lo).astype(np.int32)), pa.array(text, pa.binary())],
                    ["id", "tag", "place", "route", "digest", "n", "words"])

    rows = _packed(docs) if not listed else docs.select(F.struct("id", "tag", "text", "wanted", "alone").alias("row"))
    return rows.mapInArrow(run, _STRETCH)


_STRETCH = "id bigint, tag bigint, place int, route bigint, digest bigint, n int, words binary"


def _among(lists: pa.ListArray, doc: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Whether each key is in the list of its document (``doc`` ascends)."""
    out = np.zeros(len(key), dtype=bool)
    at, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False).view(np.uint64)
    edge = np.searchsorted(doc, np.arange(len(lists) + 1))
    for d in np.unique(doc):
        out[edge[d]:edge[d + 1]] = np.isin(key[edge[d]:edge[d + 1]], values[at[d]:at[d + 1]])
    return out


def with_key_lists(docs: DataFrame, known: DataFrame, keys: DataFrame, split: int) -> DataFrame:
    """The documents with a shared key, and their lists of such keys: the way
    for more keys than a filter takes.  Hot keys join in several tasks."""
    lists = (known.where(F.col("id").isNotNull()).select("id", "tag", F.explode("keys").alias("key")).join(keys, "key")
                  .groupBy("id", "tag").agg(F.collect_set("key").alias("wanted"),
                                            F.collect_set(F.when(F.col("c") >= split, F.col("key"))).alias("alone")))
    return (docs.where(F.col("id").isNotNull()).select("id", F.xxhash64("text").alias("tag"), "text").join(lists, ["id", "tag"]))


def one_by_one(cut: DataFrame, window: int = WINDOW) -> DataFrame:
    """Stretches taken apart: every window under its own hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 200):
                part = batch.slice(k, 200)
                words = Words(part.column("words").to_pylist(), NOT_SPACE)
                lo = np.flatnonzero(words.whole(window))
                row = np.searchsorted(words.first, lo, "right") - 1
                digest = words.span_hash(lo, lo + window).view(np.int64)
                raw, take = words.buf.tobytes(), pa.array(row)
                text = [raw[a:b] for a, b in zip(words.start[lo].tolist(), words.end[lo + window - 1].tolist(), strict=True)]
                place = part.column("place").to_numpy()[row] + lo - words.first[row]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").take(take), part.column("tag").take(take), pa.array(place.astype(np.int32)),
                     pa.array(digest), pa.array(digest), pa.array(np.full(len(lo), window, np.int32)), pa.array(text, pa.binary())],
                    batch.schema.names)

    return cut.mapInArrow(run, _STRETCH)


class Bits:
    """A bit vector with rank, packed in 64-bit words."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        data = np.zeros((n // 64 + 1) * 64, dtype=np.uint8)
        data[:n] = bits
        self.words = np.packbits(data, bitorder="little").view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words))]).astype(np.int32)

    def ones(self, at: np.ndarray) -> np.ndarray:
        """Set bits before each position."""
        w = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[w] + np.bitwise_count(self.words[w] & mask)


class FMIndex:
    """Over texts of word numbers (from 1), sorted by ``window`` words at least.
    ``lows``: an id for each text."""

    def __init__(self, texts: np.ndarray, ends: np.ndarray, lows: np.ndarray, window: int = WINDOW):
        # a mark (0) follows each text
        count = len(ends)
        size = np.diff(np.concatenate([[0], ends]))
        owner = np.repeat(np.arange(count), size + 1)
        n = len(owner)
        symbols = np.zeros(n, dtype=np.int64)
        self.stop = np.cumsum(size + 1) - 1  # the mark of each text
        inner = np.ones(n, dtype=bool)
        inner[self.stop] = False
        symbols[inner] = texts
        self.symbols, self.size, self.window, self.n = symbols.astype(np.int32), size, window, n
        rank, depth, kept = np.unique(symbols, return_inverse=True)[1].astype(np.int64), 1, {}

        def ahead(x: np.ndarray, by: int) -> np.ndarray:
            out = np.zeros(n, dtype=np.int64)
            out[:n - by if by < n else 0] = x[by:] + 1
            return out

        while True:
            for w in (window - 1, window):
                if depth <= w:
                    kept[w] = (rank, w - depth)
            if depth >= window:
                break
            rank = np.unique(rank * (n + 2) + ahead(rank, depth), return_inverse=True)[1].astype(np.int64)
            depth *= 2
        order = np.argsort(rank, kind="stable")
        start = {}
        for w, (r, by) in kept.items():  # where the first w words change along the order
            key = (r * (n + 2) + ahead(r, by))[order]
            start[w] = np.append(True, key[1:] != key[:-1])
        # intervals of the same window - 1 and the same window words: where they begin
        self.wide, self.same = Bits(start[window - 1]), Bits(start[window])
        self.wide_at = np.append(np.flatnonzero(start[window - 1]), n).astype(np.int32)
        self.low = np.minimum.reduceat(lows[owner[order]], np.flatnonzero(start[window]))
        self.first = np.concatenate([[0], np.cumsum(np.bincount(symbols))])
        column = symbols[order - 1]
        self.levels = []
        for level in range(max(1, int(symbols.max()).bit_length()) - 1, -1, -1):
            bit = (column >> level) & 1
            self.levels.append((level, Bits(bit), int(n - bit.sum())))
            column = np.concatenate([column[bit == 0], column[bit == 1]])
        self.base = self._descend(np.arange(len(self.first) - 1), np.zeros(len(self.first) - 1, np.int64))

    def _descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level, bits, zeros in self.levels:
            ones = bits.ones(at)
            at = np.where((symbol >> level) & 1 == 1, zeros + ones, at - ones)
        return at

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search: the intervals of symbol + pattern."""
        both = self._descend(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
        both += np.tile(self.first[symbol] - self.base[symbol], 2)
        return both[:len(symbol)], both[len(symbol):]

    def stream(self) -> tuple[np.ndarray, np.ndarray]:
        """The smallest id that has each window of each text, text by text, and
        the offsets of texts.  Every window occurs, in its own text at least."""
        windows = self.size - self.window + 1
        offsets = np.concatenate([[0], np.cumsum(windows)])
        out = np.zeros(offsets[-1], dtype=np.int64)
        order = np.argsort(-windows, kind="stable")
        stop, left = self.stop[order], windows[order]
        last = offsets[1:][order]
        low, high = np.zeros(len(order), np.int64), np.full(len(order), self.n, np.int64)
        for step in range(1, self.window):
            low, high = self.extend(self.symbols[stop - step], low, high)
        most = int(left[0]) if len(left) else 0
        for k in range(1, most + 1):
            m = int(np.searchsorted(-left, -k, "right"))  # texts with k windows or more
            low, high = low[:m], high[:m]
            low, high = self.extend(self.symbols[stop[:m] - self.window - k + 1], low, high)
            out[last[:m] - k] = self.low[self.same.ones(low + 1) - 1]
            group = self.wide.ones(low + 1) - 1
            low, high = self.wide_at[group].astype(np.int64), self.wide_at[group + 1].astype(np.int64)
        return out, offsets


def search_shards(distinct: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(route, digest, lows): the smallest id of each window of the stretches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, route = [], 0, None

        def result() -> pa.RecordBatch:
            number: dict[bytes, int] = {}
            ends = np.cumsum(np.concatenate([b.column("n").to_numpy() for b in held]).astype(np.int64))
            flat = np.fromiter((number.setdefault(w, len(number) + 1) for b in held for t in b.column("words") for w in t.as_py().split(b" ")),
                               dtype=np.int32, count=int(ends[-1]))
            del number
            lows = np.concatenate([b.column("low").to_numpy(zero_copy_only=False) for b in held])
            found, offsets = FMIndex(flat, ends, lows, window).stream()
            column = {c: pa.concat_arrays([b.column(c) for b in held]) for c in ("route", "digest")}
            return pa.RecordBatch.from_arrays(
                [column["route"], column["digest"], pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(found))],
                ["route", "digest", "lows"])

        for batch in batches:
            routes, sizes = batch.column("route").to_numpy(), batch.column("n").to_numpy()
            edges = [0, *(np.flatnonzero(routes[1:] != routes[:-1]) + 1).tolist(), batch.num_rows]
            i = 0
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if held and size >= shard_words and routes[a] != route:
                    if a > i:
                        held.append(batch.slice(i, a - i))
                    yield result()
                    held, size, i = [], 0, a
                size += int(sizes[a:b].sum())
                route = routes[a]
                if not held and i == a:
                    held.append(batch.slice(a, b - a))
                    i = b
            if i < batch.num_rows:
                held.append(batch.slice(i))
        if held:
            yield result()

    rows = distinct.select("route", "digest", "low", "n", "words").repartition("route").sortWithinPartitions("route", "digest")
    return rows.mapInArrow(run, "route bigint, digest bigint, lows array<bigint>")


def covered(docs: DataFrame, window: int = WINDOW, split: int = SPLIT, shard_words: int = SHARD_WORDS,
            most: int = FILTER_BITS) -> DataFrame:
    """(id, tag, whole, starts): documents of ``docs`` (id, text) with windows
    that start in a document with a smaller id, by their first words; ``whole``
    where the document equals an earlier one."""
    known = saved(profiles(docs, window), "window-keys")
    long = known.where(F.col("n") >= window)
    first = long.groupBy("n", "d1", "d2").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high")
    copies = (long.select("id", "tag", "n", "d1", "d2").join(first, ["n", "d1", "d2"]).where(F.col("id") > F.col("low"))
                  .select("id", "tag", F.lit(True).alias("whole"), F.array().cast("array<int>").alias("starts")))
    keys = saved(long.select("d1", F.explode("keys").alias("key")).groupBy("key")
                     .agg(F.min("d1").alias("x"), F.max("d1").alias("y"), F.count("*").alias("c"))
                     .where("x <> y").select("key", "c"), "shared-keys")
    shared, alone = id_filter(keys.select("key"), most), id_filter(keys.where(F.col("c") >= split).select("key"), most)
    listed = shared is None or alone is None
    cut = saved(stretches(with_key_lists(docs, known, keys, split), None, None, window) if listed
                else stretches(docs, shared, alone, window), "stretches")
    large = saved(cut.groupBy("route", "digest").agg(F.first("n").alias("n")).groupBy("route").agg(F.sum("n").alias("n"))
                     .where(F.col("n") > shard_words).select("route"), "large-keys")
    if not large.isEmpty():
        taken = one_by_one(cut.join(large, "route", "left_semi").select(cut.columns), window)
        cut = saved(cut.join(large, "route", "left_anti").select(cut.columns).unionByName(taken), "stretches")
    distinct = cut.groupBy("route", "digest").agg(F.min("id").alias("low"), F.first("n").alias("n"), F.first("words").alias("words"))
    found = search_shards(distinct, window, shard_words)
    j = F.transform("lows", lambda x, k: F.when(x < F.col("id"), F.col("place") + k))
    hit = (cut.select("route", "digest", "id", "tag", "place").join(found, ["route", "digest"])
              .select("id", "tag", F.lit(False).alias("whole"), F.filter(j, lambda x: x.isNotNull()).alias("starts"))
              .where(F.size("starts") > 0))
    return (hit.unionByName(copies).groupBy("id", "tag")
               .agg(F.max("whole").alias("whole"), F.flatten(F.collect_list("starts")).alias("starts")))


FIELDS = "words bigint, removed bigint, kept string, rest string"


def without_repeats(docs: DataFrame, key: str = "doc_id", window: int = WINDOW, split: int = SPLIT,
                    carry: list[str] | None = None, shard_words: int = SHARD_WORDS, most: int = FILTER_BITS) -> DataFrame:
    """``row`` (the document) with its number of ``words``, those ``removed``,
    the ``kept`` words joined by one space, and the ``rest`` of the text, which
    keeps the white space between kept words."""
    bound_batches(docs.sparkSession)
    hits = covered(docs.select(F.col(key).cast("bigint").alias("id"), "text"), window, split, shard_words, most)
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
                      F.col(key).cast("bigint").alias("id"), F.xxhash64("text").alias("tag"))
    rows = own.join(hits, ["id", "tag"], "left").select("doc", "whole", "starts")
    return _applied(rows, window, carry or docs.columns)


def _applied(rows: DataFrame, window: int, carry: list[str]) -> DataFrame:
    from pyspark.sql.types import StructField, StructType

    out = StructType([StructField("row", StructType([rows.schema["doc"].dataType[c] for c in carry]), False),
                      *StructType.fromDDL(FIELDS).fields])
    packed = rows.select(F.struct("doc", "whole", "starts").alias("row"))  # the text travels once, in the document

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "doc.text"):
                r = part.column(0)
                texts = text_bytes(r, "doc.text")
                done = apply(list(zip(r.field("whole").to_pylist(), r.field("starts"), strict=True)), texts, window)
                doc = r.field("doc")
                keep = pa.StructArray.from_arrays([doc.field(c) for c in carry], names=carry)
                yield pa.RecordBatch.from_arrays(
                    [keep, pa.array(done[0], pa.int64()), pa.array(done[1], pa.int64()), pa.array(done[2], pa.string()),
                     pa.array(done[3], pa.string())], ["row", "words", "removed", "kept", "rest"])

    return packed.mapInArrow(run, out)


def apply(hits: list, texts: list, window: int) -> tuple[list, list, list, list]:
    """Word counts, removed words, kept words and the rest of each text."""
    out: tuple[list, list, list, list] = ([], [], [], [])
    for (whole, starts), text in zip(hits, texts, strict=True):
        words = (text or b"").split()
        n = len(words)
        rest = text
        if whole:
            gone, words, rest = n, [], b""
        elif starts is not None and starts.is_valid and len(starts):
            at = np.asarray(starts.values)
            depth = np.zeros(n + 1, dtype=np.int32)
            np.add.at(depth, at, 1)
            np.add.at(depth, np.minimum(at + window, n), -1)
            stay = np.cumsum(depth)[:n] == 0
            place = Words([text], NOT_SPACE)
            words = [w for w, s in zip(words, stay.tolist(), strict=True) if s]
            gone = n - len(words)
            step = np.diff(stay.astype(np.int8), prepend=0, append=0)
            lo, hi = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
            rest = b"\n".join(text[a:b] for a, b in zip(place.start[lo].tolist(), place.end[hi - 1].tolist(), strict=True))
        else:
            gone = 0
        for column, value in zip(out, (n, gone, b" ".join(words).decode("utf-8", "replace"),
                                       None if rest is None else rest.decode("utf-8", "replace")), strict=True):
            column.append(value)
    return out


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents``; windows of 50 words."""
    found = without_repeats(table(spark, sf_dir, "documents", "doc_id", "text"), carry=["doc_id"])
    return found.select(F.col("row.doc_id").alias("doc_id"), F.col("words").alias("n_words"),
                        F.col("removed").alias("n_removed"), F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


ORACLE_OP10 = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS x
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 49)) AS i FROM w WHERE len(w) >= 50)),
low AS (SELECT x, min(doc_id) AS low FROM win GROUP BY 1),
gone AS (
  SELECT DISTINCT doc_id, unnest(generate_series(i, i + 49)) AS p FROM win JOIN low USING (x) WHERE low < doc_id),
words AS (SELECT doc_id, unnest(generate_series(1, len(w))) AS p, unnest(w) AS t FROM w),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(t, ' ' ORDER BY p) AS s
  FROM words WHERE NOT EXISTS (SELECT 1 FROM gone WHERE gone.doc_id = words.doc_id AND gone.p = words.p) GROUP BY 1)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(len(w.w) - coalesce(kept.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.s, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""
