"""Language identification with hyperdimensional profiles.

Every letter has a random vector of ``DIMENSIONS`` signs, derived from its code
point.  An n-gram vector binds (multiplies) its letters' vectors, each permuted
(rotated) by its place; a document vector bundles (adds) the vectors of all its
n-grams.  A language prototype is the sum of its training documents' unit
vectors.  The prediction is the prototype of the largest cosine, the score that
cosine (0 where it is negative).  Signs are kept as bits, so binding is an XOR.

Letters are lower-cased; a run of anything else is one boundary mark.  A text
that is null or has no letter is ``und`` with score 0, as is every text when no
training row has a language.  Ties go to the alphabetically first language.
Rows are judged one by one; repeated training rows count as often as they occur.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perfmart.llm.text import annotate, mix, slices, table, text_bytes

DIMENSIONS = 512
N = 3
UND = "und"
#: Prototypes are held by every task: their number is bounded.
MAX_LANGUAGES = 2000
#: Unit vectors are added as integers of this scale, so sums do not depend on the order.
SCALE = 1 << 20
#: n-gram vectors formed at once, and held for the texts of one slice (2 kB each).
GRAM_BLOCK = 8192
TABLE_GRAMS = 40_000


class Profiler:
    """Document vectors."""

    def __init__(self, dimensions: int = DIMENSIONS, n: int = N):
        self.words, self.n = dimensions // 64, n
        self.dimensions = self.words * 64
        self.letter = np.array([chr(c).isalpha() if not 0xD800 <= c < 0xE000 else False for c in range(0x110000)])

    def _signs(self, points: np.ndarray) -> list[np.ndarray]:
        """Bits of each code point's vector, rotated by 0..n-1 places."""
        at = (points.astype(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15)
              + np.arange(1, self.words + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
        out = [mix(mix(at))]
        for _ in range(self.n - 1):
            x = out[-1]
            out.append((x << np.uint64(1)) | (np.roll(x, 1, axis=1) >> np.uint64(63)))
        return out

    def vectors(self, texts: list) -> Iterator[np.ndarray | None]:
        """The bundled vector of each text; None without a letter."""
        codes = [np.frombuffer((t or b"").decode("utf-8", "replace").lower().encode("utf-32-le"), dtype=np.uint32)
                 for t in texts]
        present = np.unique(np.concatenate([np.zeros(1, np.uint32), *codes]))
        present = np.append(np.uint32(0), present[self.letter[present]])  # 0 is the boundary mark
        signs = self._signs(present)
        place = np.zeros(int(present.max()) + 1, dtype=np.int64)
        place[present] = np.arange(len(present))
        bags = [self._grams(code, place, len(present)) for code in codes]
        full = [b for b in bags if b is not None]
        known = np.unique(np.concatenate([g for g, _ in full])) if full else np.zeros(0, np.int64)
        held = self._vectors(known, signs, len(present)) if len(known) <= TABLE_GRAMS else None
        for bag in bags:
            if bag is None:
                yield None
                continue
            total = np.zeros(self.dimensions, dtype=np.float64)
            for i in range(0, len(bag[0]), GRAM_BLOCK):
                grams, counts = bag[0][i:i + GRAM_BLOCK], bag[1][i:i + GRAM_BLOCK].astype(np.float32)
                total += counts @ (held[np.searchsorted(known, grams)] if held is not None
                                   else self._vectors(grams, signs, len(present)))
            yield total

    def _grams(self, code: np.ndarray, place: np.ndarray, letters: int) -> tuple[np.ndarray, np.ndarray] | None:
        """Distinct n-grams of a text, as numbers of n digits, and their counts."""
        ok = self.letter[code]
        if not ok.any():
            return None
        keep = np.append(True, ok[1:] | ok[:-1])  # one mark for a run
        seq = np.concatenate([np.zeros(int(ok[0]), np.int64), place[np.where(ok, code, 0)[keep]], np.zeros(1, np.int64)])
        key = np.zeros(len(seq) - self.n + 1, dtype=np.int64)
        for k in range(self.n):
            key = key * letters + seq[k:len(seq) - self.n + 1 + k]
        return np.unique(key, return_counts=True)

    def _vectors(self, grams: np.ndarray, signs: list[np.ndarray], letters: int) -> np.ndarray:
        """The signs of n-grams: letters bound, the last one not rotated."""
        out = np.empty((len(grams), self.dimensions), dtype=np.float32)
        for i in range(0, len(grams), GRAM_BLOCK):
            rest, bits = grams[i:i + GRAM_BLOCK], np.uint64(0)
            for k in range(self.n):
                bits = bits ^ signs[k][rest % letters]
                rest = rest // letters
            ones = np.unpackbits(np.ascontiguousarray(bits).view(np.uint8), axis=1)
            np.subtract(1, 2 * ones.view(np.int8), out=out[i:i + GRAM_BLOCK], casting="unsafe")
        return out


def prototypes(docs: DataFrame, dimensions: int = DIMENSIONS, n: int = N) -> dict[str, np.ndarray]:
    """The prototype of each language of ``docs`` (text, lang).  Each task adds
    up its documents; the sums of tasks are added by language and dimension."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiler = Profiler(dimensions, n)
        sums: dict[str, np.ndarray] = {}

        def out():
            for lang, total in sums.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(total)), pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)],
                    ["lang", "dim", "value"])

        for batch in batches:
            for part in slices(batch, "text"):
                langs = part.column(0).field("lang").to_pylist()
                for lang, v in zip(langs, profiler.vectors(text_bytes(part.column(0), "text")), strict=True):
                    if v is None or not (size := np.sqrt(v @ v)):
                        continue
                    if lang not in sums:
                        sums[lang] = np.zeros(profiler.dimensions, dtype=np.int64)
                    sums[lang] += np.rint(v / size * SCALE).astype(np.int64)
            if len(sums) > MAX_LANGUAGES:
                yield from out()
                sums.clear()
        yield from out()

    rows = (docs.where(F.col("lang").isNotNull()).select(F.struct("lang", "text").alias("row"))
                .mapInArrow(run, "lang string, dim int, value bigint")
                .groupBy("lang", "dim").agg(F.sum("value").alias("value"))
                .groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("dim", "value"))).alias("v"))
                .select("lang", F.col("v.value").alias("v")).limit(MAX_LANGUAGES + 1).collect())
    if len(rows) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    return {r.lang: np.array(r.v, dtype=np.float64) for r in sorted(rows)}


def predict(docs: DataFrame, learned: dict[str, np.ndarray], dimensions: int = DIMENSIONS, n: int = N,
            carry: list[str] | None = None) -> DataFrame:
    """``row`` with ``lang_pred`` and ``score``."""
    names = sorted(learned)
    matrix = np.array([learned[k] / max(np.linalg.norm(learned[k]), 1e-300) for k in names])

    def make():
        profiler = Profiler(dimensions, n)

        def fn(texts):
            langs, scores = [], []
            for v in profiler.vectors(texts):
                size = 0.0 if v is None else float(np.sqrt(v @ v))
                if not names or v is None:
                    langs.append(UND)
                    scores.append(0.0)
                    continue
                cosine = matrix @ v / size if size else np.zeros(len(names))
                best = int(cosine.argmax())
                langs.append(names[best])
                scores.append(min(1.0, max(0.0, round(float(cosine[best]), 9))))
            return [langs, scores]
        return fn

    return annotate(docs, "lang_pred string, score double", make, carry=carry)


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n (a null id reads as an empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents``; prototypes from the two other folds."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    learned = prototypes(docs.where(fold(F.col("doc_id"), 3) != 1).select("text", "lang"))
    found = predict(docs.select("doc_id", "text"), learned, carry=["doc_id"])
    return found.select(F.col("row.doc_id").alias("doc_id"), (fold(F.col("row.doc_id"), 3) == 1).alias("held_out"),
                        "lang_pred", "score")
