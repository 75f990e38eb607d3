"""Periodic runs of words, by string synchronising sets.

A run is a stretch of consecutive words that has a smallest period q (words q
apart are identical), is at least ``LEAST`` periods long, and cannot be made
longer on either side without losing the period.

Scale tau = 1, 2, 4, ... finds the periods tau <= q < 2 tau, for all texts of a
slice at once, in numpy:

* Synchronising positions: a stretch of tau words has a pseudo-random rank, its
  hash.  Position i is selected if, of the stretches that start at i..i+tau, the
  least ranked one starts at i or at i+tau.  The choice depends on the 2 tau
  words from i alone, so it is the same wherever these words stand.
* Highly periodic stretches (of a period of tau / 4 or less) have no rank, or
  every position in them would be selected.  They lie in runs that an earlier
  scale has found, so the small periods that are left out here come from there.
* Equal contexts: two successive selected positions with the same 2 tau words,
  d apart (tau <= d < 2 tau), propose the period d.  Proposals of one period
  that meet are one; each is then extended word by word to both sides.

Nothing is missed.  A run of smallest period q has 4 q >= q + 3 tau words.  Not
all stretches that start in its first 2 tau words are highly periodic (or q would
not be the smallest period), so a position among its first tau is selected, and
q words on, still with 2 tau words of the run ahead, is the next one with the
same context (a nearer one would again make the period smaller).

Null, empty and wordless texts have no runs.  Rows are taken one by one: ids may
be null or repeated, and other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from perfmart.llm.text import NOT_SPACE, Words, mix, slices, table, text_bytes

#: Periods that a run has at least.
LEAST = 4
_NONE = np.uint64((1 << 64) - 1)
_SALT = np.uint64(0x2545F4914F6CDD1D)
_STEP = np.uint64(0x9FB21C651E98DF25)
#: Comparisons of one round of extensions.
_ROUND = 1 << 16


def _ahead(x: np.ndarray, by: int, fill: np.uint64 = _NONE) -> np.ndarray:
    out = np.full(len(x), fill, dtype=np.uint64)
    if by < len(x):
        out[:len(x) - by] = x[by:]
    return out


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of ``width`` values from each position."""
    size = 1
    while size * 2 <= width:
        x = np.minimum(x, _ahead(x, size))
        size *= 2
    return np.minimum(x, _ahead(x, width - size)) if size < width else x


def synchronising(name: np.ndarray, tau: int, inside: np.ndarray, periodic: np.ndarray) -> np.ndarray:
    """Selected positions.  ``name``: hash of the tau words from each position;
    ``inside``: 2 tau words of one text start there; ``periodic``: the tau words
    are highly periodic."""
    rank = np.minimum(mix(name ^ _SALT), _NONE - np.uint64(1))
    rank[periodic] = _NONE
    low = _least(rank, tau + 1)
    return np.flatnonzero(inside & (low != _NONE) & ((rank == low) | (_ahead(rank, tau) == low)))


def _extent(words: np.ndarray, at: np.ndarray, by: np.ndarray, room: np.ndarray, side: int) -> np.ndarray:
    """How many words from ``at``, going to one side (1 or -1), equal those
    ``by`` further on; ``room`` at most."""
    out = np.zeros(len(at), dtype=np.int64)
    live = np.flatnonzero(room > 0)
    width = 16
    while len(live):
        width = max(16, min(2 * width, _ROUND // len(live)))
        k = np.arange(width)
        x = at[live, None] + side * (out[live, None] + k)
        ok = k < (room[live] - out[live])[:, None]
        x = np.where(ok, x, 0)
        same = ok & (words[x] == words[x + np.where(ok, by[live, None], 0)])
        n = np.where(same.all(axis=1), width, np.argmin(same, axis=1))
        out[live] += n
        live = live[n == width]
    return out


def find_runs(words: np.ndarray, first: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, ...]:
    """(text, start, length, period) of every run of at least ``least`` (4 or
    more) periods, by text, start and period.  ``words``: a 64-bit value for
    each word of the texts one after another; ``first``: where each text begins,
    and the end."""
    if least < LEAST:
        raise ValueError(f"runs of {LEAST} periods or more are found")
    size = np.diff(first)
    text = np.flatnonzero(size >= LEAST)
    found: list[tuple[np.ndarray, ...]] = []
    whole, name, tau = words, None, 1
    while True:
        long = size[text] >= LEAST * tau
        if name is None or long.sum() < len(long):  # go on with the texts that are long enough
            keep = np.repeat(long, size[text]) if name is not None else np.repeat(size >= LEAST, size)
            text = text[long]
            name = mix(whole) if name is None else name
            words, name = words[keep], name[keep]
            begin = np.concatenate([[0], np.cumsum(size[text])]).astype(np.int64)
            stop = np.repeat(begin[1:], size[text])
            place = np.arange(len(words))
        if not len(text):
            break
        periodic = np.zeros(len(words) + 1, dtype=np.int32)
        slot = np.full(len(size), -1, dtype=np.int64)
        slot[text] = np.arange(len(text))
        for t, start, length, period in found:
            here = (slot[t] >= 0) & (period <= tau // LEAST) & (length >= tau)
            at = begin[slot[t[here]]] + start[here]
            np.add.at(periodic, at, 1)
            np.add.at(periodic, at + length[here] - tau + 1, -1)
        at = synchronising(name, tau, place + 2 * tau <= stop, np.cumsum(periodic[:-1]) > 0)
        context = mix(name + _STEP * mix(_ahead(name, tau) ^ _SALT))
        order = np.argsort(context[at], kind="stable")
        i, j = at[order[:-1]], at[order[1:]]
        apart = j - i
        near = (context[i] == context[j]) & (stop[i] == stop[j]) & (apart >= tau) & (apart < 2 * tau)
        found.append(_extended(words, i[near], apart[near], 2 * tau, begin, text))
        name, tau = context, 2 * tau
    t, start, length, period = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in range(4))
    enough = length >= least * period
    order = np.lexsort((period[enough], start[enough], t[enough]))
    return tuple(x[enough][order] for x in (t, start, length, period))


def _extended(words: np.ndarray, at: np.ndarray, period: np.ndarray, width: int,
              begin: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, ...]:
    """The runs (of ``LEAST`` periods) that hold the proposals: the words of
    ``width`` positions from ``at`` equal those a period further on."""
    order = np.lexsort((at, period))
    at, period = at[order], period[order]
    new = np.ones(len(at), dtype=bool)
    new[1:] = (period[1:] != period[:-1]) | (at[1:] > at[:-1] + width)
    lead = np.flatnonzero(new)
    lo, by = at[lead], period[lead]
    hi = at[np.append(lead[1:], len(at)) - 1] + width if len(at) else at
    t = np.searchsorted(begin, lo, "right") - 1
    lo = lo - _extent(words, lo - 1, by, lo - begin[t], -1)
    hi = hi + _extent(words, hi, by, begin[t + 1] - by - hi, 1)
    keep = np.flatnonzero(hi - lo + by >= LEAST * by)
    keep = keep[np.unique(np.stack([lo[keep], by[keep]]), axis=1, return_index=True)[1]] if len(keep) else keep
    return text[t[keep]], (lo - begin[t])[keep], (hi - lo + by)[keep], by[keep]


FIELDS = "words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"


def periodic_runs(docs: DataFrame, text: str = "text", shortest: int = 6, least: int = LEAST,
                  carry: list[str] | None = None) -> DataFrame:
    """``row`` (the document, or its columns ``carry``) with its number of
    ``words``, its ``runs`` of ``shortest`` words and ``least`` periods or more
    (by start, then period), and the ``collapsed`` text: the words that no run
    holds after its first period, joined by one space."""
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    whole = packed.schema["row"].dataType
    names = carry or docs.columns
    schema = StructType([StructField("row", StructType([whole[c] for c in names]), False), *StructType.fromDDL(FIELDS).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                row = part.column(0)
                texts = text_bytes(row, text)
                words = Words(texts, NOT_SPACE)
                first = words.first
                t, start, length, period = find_runs(words.hash, first, least) if len(words.start) else (np.zeros(0, np.int64),) * 4
                long = length >= shortest
                t, start, length, period = t[long], start[long], length[long], period[long]
                depth = np.zeros(len(words.start) + 1, dtype=np.int32)
                np.add.at(depth, first[t] + start + period, 1)
                np.add.at(depth, first[t] + start + length, -1)
                stay = np.cumsum(depth)[:-1] == 0
                collapsed = []
                for a, b, x in zip(first[:-1].tolist(), first[1:].tolist(), texts, strict=True):
                    said = (x or b"").split()
                    if not stay[a:b].all():
                        said = [w for w, s in zip(said, stay[a:b].tolist(), strict=True) if s]
                    collapsed.append(b" ".join(said).decode("utf-8", "replace"))
                runs = pa.ListArray.from_arrays(
                    pa.array(np.searchsorted(t, np.arange(len(texts) + 1)), pa.int32()),
                    pa.StructArray.from_arrays([pa.array(x.astype(np.int64)) for x in (start, length, period)], ["start", "length", "period"]))
                kept = pa.StructArray.from_arrays([row.field(c) for c in names], names=names)
                yield pa.RecordBatch.from_arrays(
                    [kept, pa.array(np.diff(first), pa.int64()), runs, pa.array(collapsed, pa.string())],
                    ["row", "words", "runs", "collapsed"])

    return packed.mapInArrow(run, schema)


def repeated_tail(text: Column, key: Column) -> DataFrame:
    """The text whose words from number a on are replaced by repetitions of the
    p words from a on, in one text of ten: h = crc32 of the key, g = h / 10,
    a = g mod n, p = 1 + (n - a) / (3 + g mod 8), if h mod 10 is 0.  Other texts,
    and those without a word or a key, stay as they are."""
    h = F.crc32(key.cast("string").cast("binary"))
    return F.when(h % 10 == 0, _repeated(text, F.floor(h / 10))).otherwise(text)


def _repeated(text: Column, g: Column) -> Column:
    words = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))

    def tail(w: Column) -> Column:
        n = F.size(w)
        a = F.when(n > 0, g % F.greatest(n, F.lit(1))).cast("int")
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8)).cast("int")
        body = F.transform(F.sequence(F.lit(0), n - a - 1), lambda i: F.get(w, (a + i % p).cast("int")))
        return F.when(n > 0, F.array_join(F.concat(F.slice(w, F.lit(1), a), body), " ")).otherwise(F.lit(""))

    # one element, so that the words are taken out once and bound to a name
    return F.get(F.transform(F.array(words), tail), 0)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents``, its tail repeated in one of ten."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    docs = docs.select("doc_id", repeated_tail(F.col("text"), F.col("doc_id")).alias("text"))
    found = periodic_runs(docs, carry=["doc_id"])
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r.length.alias("length"), (-r.start).alias("start"), (-r.period).alias("period"))))
    rows = found.select(F.col("row.doc_id").alias("doc_id"), F.size("runs").cast("bigint").alias("n_runs"), "runs", "collapsed", best.alias("best"))
    lines = F.concat_ws("", F.transform("runs", lambda r: F.concat(
        r.start.cast("string"), F.lit(","), r.length.cast("string"), F.lit(","), r.period.cast("string"), F.lit("\n"))))
    return rows.select("doc_id", "n_runs", (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"),
                       (-F.col("best.period")).alias("period"),
                       F.floor(1000 * F.col("best.length") / -F.col("best.period")).cast("bigint").alias("exponent_milli"),
                       F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
                       F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
