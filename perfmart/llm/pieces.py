"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

A piece never spans two words (checked when the vocabulary is loaded), so text
is cut before each space mark and distinct words are encoded together.  Their
symbols lie flat in numpy arrays.  Each round takes the best pair rank of every
word (a segmented minimum), merges its leftmost non-overlapping occurrences at
once, compacts the arrays and looks up only the pairs next to merged symbols.
A word whose new pair would rank as well or better than the pair just merged
takes only its first merge in that round, which is what the sequential
algorithm would do.  Words without a mergeable pair leave the arrays.

A null text is empty; an empty text has only the begin and end ids.  Bytes that
are not UTF-8 read as U+FFFD.  Rows are independent of each other.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perfmart.llm.text import annotate, table

MARK = "▁"
NONE = np.int32(0x7FFFFFFF)
#: Distinct words that a task remembers (about 250 bytes each).
MEMO_WORDS = 400_000


class Vocabulary:
    """Pieces, scores and pair ranks of one model file."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.size, self.begin, self.end, self.unknown = n, model.bos_id(), model.eos_id(), model.unk_id()
        special = [model.is_control(i) or model.is_byte(i) or model.is_unknown(i) for i in range(n)]
        pieces = [model.id_to_piece(i) for i in range(n)]
        if any(model.is_unused(i) for i in range(n)):
            raise ValueError("unused pieces are not supported")
        self.control = {i for i in range(n) if model.is_control(i)}
        self.byte = {i: int(pieces[i][3:5], 16) for i in range(n) if model.is_byte(i)}
        self.byte_id = [0] * 256
        for i, b in self.byte.items():
            self.byte_id[b] = i
        self.id = {p: i for i, p in enumerate(pieces) if not special[i]}
        for p in self.id:
            if MARK in p.lstrip(MARK) or (p.startswith(MARK * 2) and p.strip(MARK)):
                raise ValueError(f"piece {p!r} spans words")
        score = np.array([model.get_score(i) for i in range(n)])
        rank = np.unique(-score, return_inverse=True)[1].astype(np.int32)
        # symbols: the pieces, then characters that occur in pieces only, then one for all other characters
        chars = sorted({c for p in self.id for c in p} - self.id.keys())
        symbol = dict(self.id) | {c: n + k for k, c in enumerate(chars)}
        self.other = n + len(chars)
        self.char = np.full(0x110000, self.other, dtype=np.int32)
        for c, k in symbol.items():
            if len(c) == 1:
                self.char[ord(c)] = k
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}
        for p, i in self.id.items():
            for k in range(1, len(p)):
                a, b = symbol.get(p[:k]), symbol.get(p[k:])
                if a is not None and b is not None:
                    self.pairs[a, b] = (i, int(rank[i]))
        self.surface = [b"" if i in self.control else bytes([self.byte[i]]) if i in self.byte
                        else b" \xe2\x81\x87 " if i == self.unknown else pieces[i].replace(MARK, " ").encode()
                        for i in range(n)]
        self._table()
        self._runs: dict[int, bytes] = {}

    def _table(self) -> None:
        """Open addressing over the pair keys, probed with whole arrays."""
        width = self.other + 1
        bits = max(4, int(np.ceil(np.log2(len(self.pairs) * 8 + 1))))
        self.shift, self.slots = np.uint64(64 - bits), 1 << bits
        self.keys = np.full(self.slots, -1, dtype=np.int64)
        self.piece = np.zeros(self.slots, dtype=np.int32)
        self.rank = np.full(self.slots, NONE, dtype=np.int32)
        keys = np.array([a * width + b for a, b in self.pairs], dtype=np.int64)
        values = np.array(list(self.pairs.values()), dtype=np.int32).reshape(-1, 2)
        left = np.arange(len(keys))
        at = self._slot(keys)
        while len(left):
            free = self.keys[at[left]] == -1
            first = np.unique(at[left][free], return_index=True)[1]
            put = left[free][first]
            self.keys[at[put]] = keys[put]
            self.piece[at[put]], self.rank[at[put]] = values[put, 0], values[put, 1]
            left = np.setdiff1d(left, put)
            at[left] = (at[left] + 1) & (self.slots - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Slot of each pair, or of an empty slot (rank NONE)."""
        keys = a.astype(np.int64) * (self.other + 1) + b
        at = self._slot(keys)
        have = self.keys[at]
        todo = np.flatnonzero((have != keys) & (have != -1))
        while len(todo):
            at[todo] = (at[todo] + 1) & (self.slots - 1)
            have = self.keys[at[todo]]
            todo = todo[(have != keys[todo]) & (have != -1)]
        return at

    def run(self, n: int) -> bytes:
        """Ids of n space marks in a row (merged one after another: their
        pieces share one score, so the leftmost pair always goes first)."""
        if n not in self._runs:
            self._runs[n] = np.array(merge_in_order(self, [int(self.char[ord(MARK)])] * n), dtype="<u4").tobytes()
        return self._runs[n]


def merge_in_order(vocabulary: Vocabulary, symbols: list[int]) -> list[int]:
    """One merge at a time, best rank first, then leftmost."""
    n = len(symbols)
    nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
    alive = [True] * n
    heap: list = []

    def push(i: int) -> None:
        if i >= 0 and nxt[i] < n and (hit := vocabulary.pairs.get((symbols[i], symbols[nxt[i]]))):
            heapq.heappush(heap, (hit[1], i, symbols[i], symbols[nxt[i]], nxt[i], hit[0]))

    for i in range(n - 1):
        push(i)
    while heap:
        _, i, a, b, j, piece = heapq.heappop(heap)
        if not alive[i] or nxt[i] != j or j >= n or symbols[i] != a or symbols[j] != b:
            continue
        symbols[i], alive[j] = piece, False
        nxt[i] = nxt[j]
        if nxt[i] < n:
            prv[nxt[i]] = i
        push(prv[i])
        push(i)
    return [s for s, a in zip(symbols, alive, strict=True) if a]


def encode_words(vocabulary: Vocabulary, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Flat ids and offsets (len(words) + 1) of non-empty words, by merge rounds."""
    v = vocabulary
    size = np.array([len(w) for w in words], dtype=np.int64)
    code = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    sym = v.char[code]
    code = code.copy()
    word = np.repeat(np.arange(len(words), dtype=np.int32), size)
    done_word, done_sym, done_code = [], [], []

    def ranks(s: np.ndarray, w: np.ndarray) -> np.ndarray:
        slot = v.find(s[:-1], s[1:])
        return np.append(np.where(w[:-1] == w[1:], v.rank[slot], NONE), NONE)

    rank = ranks(sym, word) if len(sym) else np.zeros(0, np.int32)
    while len(sym):
        start = np.flatnonzero(np.diff(word, prepend=-1))
        count = np.diff(np.append(start, len(sym)))
        best = np.minimum.reduceat(rank, start)
        over = np.repeat(best == NONE, count)
        if over.any():
            done_word.append(word[over])
            done_sym.append(sym[over])
            done_code.append(code[over])
            keep = ~over
            sym, code, word, rank = sym[keep], code[keep], word[keep], rank[keep]
            count, best = count[best != NONE], best[best != NONE]
            if not len(sym):
                break
        low = np.repeat(best, count)
        chosen = rank == low
        merge = np.flatnonzero(chosen)
        if (np.diff(merge) == 1).any():  # overlapping: every other one of a run, from its left
            run = np.arange(len(merge))
            run -= np.maximum.accumulate(np.where(np.diff(merge, prepend=-2) == 1, 0, run))
            merge = merge[run % 2 == 0]
        merge, new = _safe(v, sym, word, rank, low, merge)
        sym[merge] = new
        keep = np.ones(len(sym), dtype=bool)
        keep[merge + 1] = False
        moved = np.cumsum(keep, dtype=np.int32) - 1
        sym, code, word, rank = sym[keep], code[keep], word[keep], rank[keep]
        near = np.zeros(len(sym) + 1, dtype=bool)
        near[moved[merge]] = True
        near[moved[merge] - 1] = True  # -1: the spare last entry
        touched = np.flatnonzero(near[:-1])
        rank[touched] = _rank_at(v, sym, word, touched)
    done = np.concatenate(done_word) if done_word else np.zeros(0, np.int64)
    order = np.argsort(done, kind="stable")
    done = done[order]
    ids = np.concatenate(done_sym)[order] if done_sym else np.zeros(0, np.int32)
    code = np.concatenate(done_code)[order] if done_code else np.zeros(0, np.uint32)
    plain = ids < v.size
    if not plain.all():  # characters that are no piece: their UTF-8 bytes
        parts = [[i] if ok else [v.byte_id[b] for b in chr(c).encode("utf-8", "replace")]
                 for i, ok, c in zip(ids.tolist(), plain.tolist(), code.tolist(), strict=True)]
        done = np.repeat(done, [len(p) for p in parts])
        ids = np.array([i for p in parts for i in p], dtype=np.int32)
    return ids, np.searchsorted(done, np.arange(len(words) + 1))


def _rank_at(v: Vocabulary, sym: np.ndarray, word: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Rank of the pair that starts at each position."""
    after = np.minimum(at + 1, len(sym) - 1)
    found = v.rank[v.find(sym[at], sym[after])]
    return np.where((after > at) & (word[after] == word[at]), found, NONE)


def _safe(v: Vocabulary, sym, word, rank, low, merge) -> tuple[np.ndarray, np.ndarray]:
    """The merges of this round and their pieces, with words in which a pair
    made by a merge ranks no worse than it reduced to their first merge."""
    new = v.piece[v.find(sym[merge], sym[merge + 1])]
    n = len(sym)
    several = np.zeros(len(merge), dtype=bool)
    same = word[merge[1:]] == word[merge[:-1]]
    several[1:] |= same
    several[:-1] |= same
    if not several.any():
        return merge, new
    k = np.flatnonzero(several)
    right = np.minimum(merge[k] + 2, n - 1)
    after = np.where((merge[k] + 2 < n) & (word[right] == word[merge[k]]),
                     v.rank[v.find(new[k], sym[right])], NONE)
    left = np.maximum(merge[k] - 1, 0)
    joined = np.zeros(len(merge), dtype=bool)  # the left neighbour is merged in this round too
    joined[1:] = same & (merge[1:] == merge[:-1] + 2)
    before_sym = np.where(joined[k], new[np.maximum(k - 1, 0)], sym[left])
    before = np.where((merge[k] > 0) & (word[left] == word[merge[k]]),
                      v.rank[v.find(before_sym, new[k])], NONE)
    bad = np.unique(word[merge[k]][(after <= low[merge[k]]) | (before <= low[merge[k]])])
    if len(bad):
        first = np.append(True, ~same)
        keep = first | ~np.isin(word[merge], bad)
        merge, new = merge[keep], new[keep]
    return merge, new


class Coder:
    """Encodes and decodes whole texts, remembering distinct words."""

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        self.mark = np.array([self.vocabulary.char[ord(MARK)]], dtype="<u4").tobytes()
        self.memo: dict[str, bytes] = {}

    def learn(self, words: set[str]) -> None:
        words = sorted(words)
        ids, at = encode_words(self.vocabulary, [MARK + w for w in words])
        data, at = ids.astype("<u4").tobytes(), (at * 4).tolist()
        self.memo.update(zip(words, map(data.__getitem__, map(slice, at[:-1], at[1:])), strict=True))

    def encode(self, texts: list) -> list[bytes]:
        """Ids as little-endian 32-bit integers, with begin and end ids."""
        v = self.vocabulary
        cut = [(t or b"").decode("utf-8", "replace").replace(" ", MARK).split(MARK) if t else None for t in texts]
        new = set().union(*[c for c in cut if c]) - self.memo.keys() - {""}
        if len(self.memo) + len(new) > MEMO_WORDS:
            self.memo.clear()
            new = set().union(*[c for c in cut if c]) - {""}
        if new:
            self.learn(new)
        begin, end = (np.array([i], dtype="<u4").tobytes() for i in (v.begin, v.end))
        out = []
        for c in cut:
            if c is None:
                body = b""
            elif "" not in c:
                body = b"".join(map(self.memo.__getitem__, c))
            else:
                body = self._spaced(c)
            out.append(begin + body + end)
        return out

    def _spaced(self, words: list[str]) -> bytes:
        """Words among which empty ones stand for further space marks."""
        out, marks = [], 0
        for w in words:
            if not w:
                marks += 1
                continue
            ids = self.memo[w]
            if marks:
                own = ids.startswith(self.mark)  # its own mark joins the run
                out.append(self.vocabulary.run(marks + own))
                ids = ids[4:] if own else ids
                marks = 0
            out.append(ids)
        if marks:
            out.append(self.vocabulary.run(marks))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """The text of little-endian 32-bit ids."""
        v = self.vocabulary
        data = b"".join(map(v.surface.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))
        first = next((i for i in np.frombuffer(ids[:64], dtype="<u4").tolist() if i not in v.control), None)
        if first is not None and first not in v.byte and first != v.unknown and data.startswith(b" "):
            data = data[1:]
        return data.decode("utf-8", "replace")


def piece_ids(docs: DataFrame, path: str, carry: list[str] | None = None) -> DataFrame:
    """``row`` with ``ids`` (little-endian unsigned 32-bit, begin and end
    included) and ``decoded``, the text that those ids stand for."""
    def make():
        coder = Coder(path)

        def fn(texts):
            ids = coder.encode(texts)
            return [ids, [coder.decode(i) for i in ids]]
        return fn

    return annotate(docs, "ids binary, decoded string", make, carry=carry)


def digests(found: DataFrame) -> DataFrame:
    return found.select(F.col("row.doc_id").alias("doc_id"),
                        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents``, encoded and decoded."""
    return digests(piece_ids(table(spark, sf_dir, "documents", "doc_id", "text"), model_path(), carry=["doc_id"]))
