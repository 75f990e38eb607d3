"""Token counts through a digest cache.

The cache is a Parquet table of (content digest, tokenizer digest, tokens).
Texts are normalised (null reads as empty; nothing else, as every other change
could alter the count), digested with SHA-256, and joined to the stored counts
of the same tokenizer file.  Only distinct misses are encoded, each where one of
its rows is read, so digests are shuffled and texts are not; their counts are
appended, and the documents read their counts from the cache.

Appending is safe to repeat: the cache may hold an entry twice with the same
count, and is read through an aggregate.  Rows are independent: repeated rows
and equal texts get equal counts.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perfmart.llm.components import saved
from perfmart.llm.sketch import id_filter
from perfmart.llm.text import SLICE_BYTES, bound_batches, table
from perfmart.session import scratch_path

#: Distinct words that a task remembers (about 150 bytes each).
MEMO_WORDS = 500_000
#: Characters of words encoded in one call of the library.
CALL_CHARS = 20_000

CACHE = "content string, tokenizer string, tokens bigint"


def tokenizer_digest(path: str) -> str:
    """SHA-256 of the tokenizer file: its version in the cache."""
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


class Counter:
    """Token counts of whole texts by the library, distinct words once.

    With a byte-level pre-tokenizer a space before a character that is no white
    space always begins a pre-token, so the text is cut there and the pieces
    are counted apart.  Other tokenizers count whole texts."""

    def __init__(self, path: str):
        import json

        self.memo: dict[str, int] = {}
        if path.endswith(".model"):
            import sentencepiece
            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.whole = lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
            self.cuts = False
            return
        from tokenizers import Tokenizer
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.whole = lambda texts: [len(x.ids) for x in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        before = spec.get("pre_tokenizer") or {}
        self.cuts = (before.get("type") == "ByteLevel" and before.get("use_regex", True)
                     and not before.get("add_prefix_space") and spec.get("normalizer") is None
                     and not any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") or " " in t["content"]
                                 for t in spec.get("added_tokens", ())))
        if self.cuts:
            size = self.library.get_vocab_size(with_added_tokens=True)
            self.opens = np.array([(self.library.id_to_token(i) or "").startswith("Ġ") for i in range(size)])

    def learn(self, words: list[str]) -> None:
        """Counts of ' ' + word for words without a space; a token that starts
        with a space starts the next word."""
        i = 0
        while i < len(words):
            j, size = i, 0
            while j < len(words) and (size < CALL_CHARS or j == i):
                size += len(words[j]) + 1
                j += 1
            ids = self.library.encode(" " + " ".join(words[i:j]), add_special_tokens=False).ids
            at = np.flatnonzero(self.opens[ids])
            self.memo.update(zip(words[i:j], np.diff(np.append(at, len(ids))).tolist(), strict=True))
            i = j

    def counts(self, texts: list[str]) -> list[int]:
        if not self.cuts:
            return self.whole(texts)
        parts = [t.split(" ") for t in texts]
        glued = [_glue(p) if _GAP.search(t) else (p, None) for t, p in zip(texts, parts, strict=True)]
        new = set().union(*[p[1:] for p, _ in glued]) - self.memo.keys()
        if len(self.memo) + len(new) > MEMO_WORDS:
            self.memo.clear()
            new = set().union(*[p[1:] for p, _ in glued])
        self.learn(sorted(new))
        # the first piece has no space before it; pieces with inner white space are counted as they are
        odd = [p[0] for p, _ in glued] + [x for _, more in glued if more for x in more]
        odd_counts = iter(self.whole(odd))
        first = [next(odd_counts) for _ in glued]
        get = self.memo.__getitem__
        return [f + sum(map(get, p[1:])) + (sum(next(odd_counts) for _ in more) if more else 0)
                for f, (p, more) in zip(first, glued, strict=True)]


#: A space before white space or the end, by any reading of white space.
_GAP = re.compile(r" (?=[\s​﻿]|\Z)")


def _glue(parts: list[str]) -> tuple[list[str], list[str] | None]:
    """Pieces of a text with further white space: (first piece and plain words,
    pieces that hold a space before white space)."""
    units: list[str] = [parts[0]]
    for p in parts[1:]:
        if not p or p[0].isspace() or p[0] in "​﻿":
            units[-1] += " " + p
        else:
            units.append(" " + p)
    plain, odd = [units[0]], []
    for u in units[1:]:
        (odd if " " in u[1:] else plain).append(u)
    return [plain[0], *[u[1:] for u in plain[1:]]], odd


def cached(spark: SparkSession, path: str) -> DataFrame:
    """The cache, empty where nothing is stored yet."""
    try:
        return spark.read.schema(CACHE).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], CACHE)


def encode_misses(misses: DataFrame, path: str, version: str, wanted: Callable | None = None) -> DataFrame:
    """(content, tokenizer, tokens) of each row (content, text); with ``wanted``,
    a test of places, of those rows (content, text, place) that pass it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(path)
        for batch in batches:
            if wanted is not None:
                batch = batch.filter(pa.array(wanted(batch.column(2).to_numpy())))
            keys, texts = batch.column(0), batch.column(1).to_pylist()
            i = 0
            while i < len(texts):
                j, size = i, 0
                while j < len(texts) and (size < SLICE_BYTES or j == i):
                    size += len(texts[j])
                    j += 1
                n = counter.counts(texts[i:j])
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(i, j - i), pa.array([version] * (j - i)), pa.array(n, pa.int64())],
                    ["content", "tokenizer", "tokens"])
                i = j

    columns = ["content", "text"] + (["place"] if wanted is not None else [])
    return misses.select(*columns).mapInArrow(run, CACHE)


def encode_where_they_are(marked: DataFrame, misses: DataFrame, path: str, version: str) -> DataFrame:
    """The counts of ``misses`` (content, place) by one row each of ``marked``
    (content, text, place), found by a filter of the places, so that no text is
    shuffled; the rows that pass it by mistake are left out at the end.  A content
    whose row has another place in this reading of the rows may lack."""
    wanted = id_filter(misses.select("place"))
    if wanted is None:
        return encode_misses(marked.join(misses, ["content", "place"], "left_semi"), path, version)
    found = encode_misses(marked, path, version, wanted)
    return (found.join(misses.select("content"), "content", "left_semi")
                 .groupBy("content", "tokenizer").agg(F.max("tokens").alias("tokens")))


def token_counts(docs: DataFrame, path: str, cache: str) -> DataFrame:
    """``row`` (the document), its ``bytes`` in UTF-8 and its ``tokens``.
    ``path``: tokenizer file; ``cache``: folder of the cache, which gets the
    counts of new contents."""
    spark = docs.sparkSession
    bound_batches(spark)
    version = tokenizer_digest(path)
    text = F.coalesce(F.col("text"), F.lit(""))

    def stored() -> DataFrame:
        return cached(spark, cache).where(F.col("tokenizer") == version)

    marked = docs.select(F.sha2(text, 256).alias("content"), text.alias("text"), F.monotonically_increasing_id().alias("place"))
    misses = saved(marked.groupBy("content").agg(F.min("place").alias("place"))
                         .join(stored().select("content"), "content", "left_anti"), "token-misses")
    if not misses.isEmpty():
        encode_where_they_are(marked, misses, path, version).write.mode("append").parquet(cache)
        # rows that were read in another order the second time: their texts travel
        rest = saved(misses.join(stored().select("content"), "content", "left_anti").select("content"), "token-misses")
        if not rest.isEmpty():
            texts = marked.join(rest, "content", "left_semi").groupBy("content").agg(F.first("text").alias("text"))
            encode_misses(texts, path, version).write.mode("append").parquet(cache)
    # written, so that both sides of the join are plain tables and a hot content is split
    counts = saved(stored().groupBy("content").agg(F.max("tokens").alias("tokens")), "token-counts")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row"),
                       F.octet_length(text).cast("bigint").alias("bytes"), F.sha2(text, 256).alias("content"))
    return rows.join(counts, "content").drop("content")


def op7_token_counts(spark: SparkSession, sf_dir: str, limit: int = 1024) -> DataFrame:
    """Every whole text of ``documents``, with a cache that starts empty."""
    import public_tokenizers

    found = token_counts(table(spark, sf_dir, "documents", "doc_id", "text"),
                         public_tokenizers.path("byte_bpe_50k.json"), scratch_path(spark, "token-cache"))
    return found.select(F.col("row.doc_id").alias("doc_id"), F.col("bytes").alias("n_bytes"),
                        F.col("tokens").alias("n_tokens"), (F.col("tokens") > limit).alias("over_limit"))
