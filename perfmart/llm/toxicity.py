"""Toxicity: a bidirectional gated recurrent network with attention pooling.

Words (lower-cased runs of letters and digits) enter with two inputs: an
embedding of the word itself, where training has seen it often enough, and the
mean embedding of its character n-grams with word borders.  Two gated recurrent
layers read each window of ``SPAN`` words in both directions, attention pools
their states, and a logistic unit scores the window.  Windows start every
``STRIDE`` words and the last one ends with the text, so all overlapping windows
of the whole text are scored; the document has the largest score, mapped to a
probability by a logistic curve fitted to document scores.

The network is trained in numpy on a bounded sample of labelled documents
(``TRAIN_DOCS`` of either label): only documents have labels, so the windows of
a positive document count as positive while they are among its best.  A text
without a word has one empty window.  Without training documents of both labels
every score is 0.  Labels that are null are passed over; repeated labels of one
document count once (the largest).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perfmart.llm.language import fold
from perfmart.llm.text import ALNUM, Words, annotate, mix, table

SPAN, STRIDE = 32, 16
HIDDEN, ATTENTION = 12, 8
WORD_DIM, CHAR_DIM = 8, 16
CHAR_BUCKETS = 1 << 14
GRAMS = (3, 4, 5)
#: Bounds of training: documents of each label, windows kept of each document, known words, steps.
TRAIN_DOCS = 1200
TRAIN_WINDOWS = 24
VOCABULARY = 20_000
STEPS = 250
BATCH = 64
#: Documents of either label from which a quarter is kept for the logistic curve.
LEAST_APART = 80
#: Bits of the hash by which training documents are chosen.
HASH_BITS = 62
#: Windows scored together.
SCORE_BATCH = 1024


def lowered(texts: list) -> Words:
    return Words([None if t is None else t.decode("utf-8", "replace").lower().encode() for t in texts], ALNUM)


class Inputs:
    """Distinct words of some texts: ``number`` of each word, their hashes and
    the buckets of their character n-grams (flat, with offsets)."""

    def __init__(self, words: Words):
        self.hash, at, self.number = np.unique(words.hash, return_index=True, return_inverse=True)
        size = words.end[at] - words.start[at]
        # the distinct words in one buffer, each between border marks (0x02 and 0x03)
        end = np.cumsum(size + 2)
        n = int(end[-1]) if len(end) else 0
        buf = np.zeros(n + max(GRAMS), dtype=np.uint64)
        first = end - size - 2
        buf[first], buf[end - 1] = 2, 3
        inner = np.arange(n) - np.repeat(first, size + 2)
        inside = (inner > 0) & (inner <= np.repeat(size, size + 2))
        buf[:n][inside] = words.buf[(np.repeat(words.start[at], size + 2) + inner - 1)[inside]]
        owner, bucket = [], []
        room = np.repeat(size + 2, size + 2) - inner
        which = np.repeat(np.arange(len(at)), size + 2)
        for g in GRAMS:
            ok = np.flatnonzero((room >= g) | (inner == 0))
            value = np.full(len(ok), g, dtype=np.uint64)
            for j in range(g):
                value = value * np.uint64(0x100000001B3) + np.where(room[ok] > j, buf[ok + j], 0)
            owner.append(which[ok])
            bucket.append((mix(value) & np.uint64(CHAR_BUCKETS - 1)).astype(np.int32))
        owner, bucket = np.concatenate(owner), np.concatenate(bucket)
        order = np.argsort(owner, kind="stable")
        self.bucket = bucket[order]
        self.count = np.bincount(owner, minlength=len(at))
        self.first = np.concatenate([[0], np.cumsum(self.count)])[:-1]


def window_starts(n: int) -> list[int]:
    if n <= SPAN:
        return [0]
    starts = list(range(0, n - SPAN, STRIDE))
    return [*starts, n - SPAN]


def windows(words: Words, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text index, word numbers with -1 after the end) of all windows."""
    n = np.diff(words.first)
    whole = np.maximum(0, n - SPAN)
    count = np.where(n <= SPAN, 1, -(-whole // STRIDE) + 1)
    doc = np.repeat(np.arange(len(n)), count)
    k = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    start = np.minimum(k * STRIDE, whole[doc])
    at = start[:, None] + np.arange(SPAN)
    ok = at < n[doc][:, None]
    at = np.where(ok, at + words.first[:-1][doc][:, None], 0)
    return doc, np.where(ok, number[at] if len(number) else -1, -1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.float32(0.5) * (np.tanh(np.float32(0.5) * x) + np.float32(1))


@dataclass
class Network:
    """Parameters by name, and the known words' sorted hashes."""
    p: dict[str, np.ndarray]
    known: np.ndarray
    scale: float = 1.0
    shift: float = 0.0

    @staticmethod
    def new(known: np.ndarray, seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)

        def init(*shape: int, by: float) -> np.ndarray:
            return (rng.standard_normal(shape) * by).astype(np.float32)

        d, h = WORD_DIM + CHAR_DIM, HIDDEN
        p = {"word": init(len(known) + 1, WORD_DIM, by=0.1), "char": init(CHAR_BUCKETS, CHAR_DIM, by=0.3)}
        for way in "fb":
            p |= {f"W{way}": init(d, 3 * h, by=d ** -0.5), f"c{way}": np.zeros(3 * h, np.float32),
                  f"U{way}": init(h, 3 * h, by=h ** -0.5)}
        p |= {"A": init(2 * h, ATTENTION, by=(2 * h) ** -0.5), "a": np.zeros(ATTENTION, np.float32),
              "v": init(ATTENTION, by=ATTENTION ** -0.5), "w": init(2 * h, by=(2 * h) ** -0.5), "b": np.zeros(1, np.float32)}
        return Network(p, known)

    def embed(self, inputs: Inputs) -> tuple[np.ndarray, np.ndarray]:
        """(word rows, inputs) of distinct words."""
        row = np.zeros(len(inputs.hash), dtype=np.int64)
        if len(self.known) and len(row):
            at = np.minimum(np.searchsorted(self.known, inputs.hash), len(self.known) - 1)
            row = np.where(self.known[at] == inputs.hash, at + 1, 0)
        if not len(row):
            return row, np.zeros((0, WORD_DIM + CHAR_DIM), np.float32)
        chars = np.add.reduceat(self.p["char"][inputs.bucket], inputs.first, axis=0) / inputs.count[:, None].astype(np.float32)
        return row, np.concatenate([self.p["word"][row], chars], axis=1)

    def _gru(self, x: np.ndarray, mask: np.ndarray | None, way: str, keep: list | None) -> np.ndarray:
        """States (T, B, H) for projected inputs x (T, B, 3H)."""
        steps, size = x.shape[:2]
        h, u = HIDDEN, self.p[f"U{way}"]
        state = np.zeros((size, h), np.float32)
        out = np.empty((steps, size, h), np.float32)
        for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
            s = state @ u
            gates = _sigmoid(x[t, :, :2 * h] + s[:, :2 * h])
            z, r = gates[:, :h], gates[:, h:]
            new = np.tanh(x[t, :, 2 * h:] + r * s[:, 2 * h:])
            after = new + z * (state - new)
            if mask is not None:
                after = np.where(mask[t][:, None], after, state)
            if keep is not None:
                keep.append((t, state, s[:, 2 * h:], z, r, new))
            state = out[t] = after
        return out

    def logits(self, projected: dict[str, np.ndarray], ids: np.ndarray, cache: dict | None = None) -> np.ndarray:
        """Scores of windows (B, T) of word numbers; -1 is no word."""
        p, ids = self.p, ids.T
        mask = None if (ids >= 0).all() else ids >= 0
        steps = {way: [] for way in "fb"} if cache is not None else {"f": None, "b": None}
        states = np.concatenate([self._gru(projected[way][ids], mask, way, steps[way]) for way in "fb"], axis=2)
        u = np.tanh(states @ p["A"] + p["a"])
        e = u @ p["v"]
        if mask is not None:
            e = np.where(mask, e, np.float32(-30))
        e = np.exp(e - e.max(axis=0))
        alpha = e / e.sum(axis=0)
        pooled = (alpha[:, :, None] * states).sum(axis=0)
        if cache is not None:
            cache |= dict(ids=ids, mask=mask, steps=steps, states=states, u=u, alpha=alpha, pooled=pooled)
        return pooled @ p["w"] + p["b"][0]

    def project(self, x: np.ndarray) -> dict[str, np.ndarray]:
        """Inputs of both directions; a last row of zeros stands for no word."""
        out = {}
        for way in "fb":
            y = x @ self.p[f"W{way}"] + self.p[f"c{way}"]
            out[way] = np.concatenate([y, np.zeros((1, y.shape[1]), np.float32)])
        return out

    def gradients(self, inputs: Inputs, ids: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean logistic loss over the windows, all of whose words are ``inputs``."""
        p, h, cache = self.p, HIDDEN, {}
        row, xs = self.embed(inputs)
        logit = self.logits(self.project(xs), ids, cache)
        d = ((1 / (1 + np.exp(-logit)) - labels) / len(labels)).astype(np.float32)
        g = {"w": cache["pooled"].T @ d, "b": np.array([d.sum()], np.float32)}
        states, alpha, u = cache["states"], cache["alpha"], cache["u"]
        dpool = d[:, None] * p["w"]
        dalpha = (states * dpool).sum(axis=2)
        de = alpha * (dalpha - (alpha * dalpha).sum(axis=0))
        g["v"] = np.einsum("tb,tbk->k", de, u)
        du = de[:, :, None] * p["v"] * (1 - u * u)
        g["A"], g["a"] = np.einsum("tbh,tbk->hk", states, du), du.sum(axis=(0, 1))
        ds = alpha[:, :, None] * dpool + du @ p["A"].T
        dx = np.zeros_like(xs)
        flat = cache["ids"].ravel()
        order = np.argsort(flat, kind="stable")
        begin = np.searchsorted(flat[order], np.arange(len(xs)))
        for k, way in enumerate("fb"):
            u_mat = p[f"U{way}"]
            gu = np.zeros_like(u_mat)
            dproj = np.zeros((*cache["ids"].shape, 3 * h), np.float32)
            back = np.zeros((states.shape[1], h), np.float32)
            for t, before, sn, z, r, new in reversed(cache["steps"][way]):
                dh = ds[t, :, k * h:(k + 1) * h] + back
                on = None if cache["mask"] is None else cache["mask"][t][:, None]
                live = dh if on is None else np.where(on, dh, 0)
                dnew = live * (1 - z) * (1 - new * new)
                dz = live * (before - new) * z * (1 - z)
                dr = dnew * sn * r * (1 - r)
                dproj[t] = np.concatenate([dz, dr, dnew], axis=1)
                dsum = np.concatenate([dz, dr, dnew * r], axis=1)
                gu += before.T @ dsum
                back = live * z + dsum @ u_mat.T
                if on is not None:
                    back = np.where(on, back, dh)
            g[f"U{way}"], g[f"c{way}"] = gu, dproj.sum(axis=(0, 1))
            total = np.add.reduceat(np.concatenate([dproj.reshape(-1, 3 * h)[order], np.zeros((1, 3 * h), np.float32)]),
                                    begin, axis=0)
            g[f"W{way}"] = xs.T @ total
            dx += total @ p[f"W{way}"].T
        g["word"] = (row, dx[:, :WORD_DIM])
        share = dx[:, WORD_DIM:] / inputs.count[:, None].astype(np.float32)
        g["char"] = (inputs.bucket, np.repeat(share, inputs.count, axis=0))
        return g

    def score(self, texts: list) -> np.ndarray:
        """The largest window score of each text (a logit)."""
        words = lowered(texts)
        inputs = Inputs(words)
        projected = self.project(self.embed(inputs)[1])
        doc, ids = windows(words, inputs.number)
        out = np.full(len(texts), -np.inf, dtype=np.float64)
        full = (ids >= 0).all(axis=1)
        for part in (np.flatnonzero(full), np.flatnonzero(~full)):
            for i in range(0, len(part), SCORE_BATCH):
                w = part[i:i + SCORE_BATCH]
                np.maximum.at(out, doc[w], self.logits(projected, ids[w]).astype(np.float64))
        return out

    def probability(self, logit: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * logit + self.shift, -60, 60)))


class Adam:
    def __init__(self, p: dict[str, np.ndarray], rate: float):
        self.p, self.rate, self.t = p, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in p.items()}
        self.s = {k: np.zeros_like(v) for k, v in p.items()}

    def step(self, gradients: dict) -> None:
        self.t += 1
        fix = np.sqrt(1 - 0.999 ** self.t) / (1 - 0.9 ** self.t)
        for k, g in gradients.items():
            at = slice(None)
            if isinstance(g, tuple):  # rows of a table, added up
                at, inverse = np.unique(g[0], return_inverse=True)
                total = np.zeros((len(at), g[1].shape[1]), np.float32)
                np.add.at(total, inverse, g[1])
                g = total
            self.m[k][at] = 0.9 * self.m[k][at] + 0.1 * g
            self.s[k][at] = 0.999 * self.s[k][at] + 0.001 * g * g
            self.p[k][at] -= self.rate * fix * self.m[k][at] / (np.sqrt(self.s[k][at]) + 1e-8)


def train(texts: list[bytes], toxic: np.ndarray, share: float | None = None, steps: int = STEPS, seed: int = 7) -> Network | None:
    """The network for texts with 0/1 labels; None unless both occur.
    ``share``: share of positive documents where the network will be used."""
    toxic = np.asarray(toxic) > 0
    if not toxic.any() or toxic.all():
        return None
    rng = np.random.default_rng(seed)
    if toxic.sum() >= LEAST_APART and (~toxic).sum() >= LEAST_APART:  # a quarter for the curve only
        apart = np.zeros(len(texts), dtype=bool)
        for side in (toxic, ~toxic):
            apart[rng.permutation(np.flatnonzero(side))[:side.sum() // 4]] = True
        net = _fit([t for t, x in zip(texts, apart, strict=True) if not x], toxic[~apart], steps, seed, rng)
        judged, answer = [t for t, x in zip(texts, apart, strict=True) if x], toxic[apart]
    else:
        net = _fit(texts, toxic, steps, seed, rng)
        judged, answer = texts, toxic
    _calibrate(net, net.score(judged), answer, toxic.mean() if share is None else share)
    return net


def _fit(texts: list[bytes], toxic: np.ndarray, steps: int, seed: int, rng: np.random.Generator) -> Network:
    """The trained network, its curve not yet fitted."""
    words = lowered(texts)
    inputs = Inputs(words)
    owner = np.repeat(np.arange(len(texts)), np.diff(words.first))
    pairs = np.unique(inputs.number.astype(np.int64) * len(texts) + owner)  # a word's documents
    spread = np.bincount(pairs // len(texts), minlength=len(inputs.hash))
    often = np.argsort(-spread, kind="stable")[:VOCABULARY]
    known = np.sort(often[spread[often] >= 3])  # words are sorted by hash
    net = Network.new(inputs.hash[known], seed)
    # the first dimension of both embeddings starts from how far documents with a word or n-gram are positive
    lean = _lean(spread, np.bincount(pairs // len(texts), weights=toxic[pairs % len(texts)], minlength=len(inputs.hash)), toxic.mean())
    net.p["word"][1:, 0] += lean[known] / 4
    net.p["char"][:, 0] += _lean(*_gram_counts(inputs, pairs, toxic), toxic.mean()) / 4
    doc, ids = windows(words, inputs.number)
    # a random few windows of each document
    order = np.lexsort((rng.random(len(doc)), doc))
    place = np.arange(len(doc)) - np.searchsorted(doc, doc)
    order = order[place < TRAIN_WINDOWS]
    doc, ids = doc[order], ids[order]
    positive = toxic[doc]
    pos, neg = np.flatnonzero(positive), np.flatnonzero(~positive)
    most = np.append(lean, -np.inf)[ids].max(axis=1)
    top = np.full(len(texts), -np.inf)
    np.maximum.at(top, doc, most)
    best, hard = pos[(most[pos] >= top[doc[pos]]) | (most[pos] >= 4)], neg
    adam = Adam(net.p, 0.01)
    for step in range(steps):
        if step and step % 60 == 0:  # the best windows of positive documents, the worst of others
            row, x = net.embed(inputs)
            projected = net.project(x)
            logit = np.concatenate([net.logits(projected, ids[i:i + SCORE_BATCH]) for i in range(0, len(ids), SCORE_BATCH)])
            top = np.full(len(texts), -np.inf)
            np.maximum.at(top, doc, logit)
            best = pos[(logit[pos] >= top[doc[pos]]) | (logit[pos] > 0)]
            hard = neg[np.argsort(-logit[neg], kind="stable")[:max(BATCH * 4, len(neg) // 10)]]
        if step == steps * 3 // 4:
            adam.rate = 0.003
        chosen = np.concatenate([rng.choice(best, BATCH), rng.choice(neg, BATCH // 2), rng.choice(hard, BATCH // 2)])
        adam.step(net.gradients(*_subset(inputs, ids[chosen]), positive[chosen].astype(np.float32)))
    return net


def _lean(count: np.ndarray, hits: np.ndarray, share: float) -> np.ndarray:
    """Standard deviations by which the documents with an item are more often positive than all."""
    return ((hits - count * share) / np.sqrt(count * share * (1 - share) + 0.25)).astype(np.float32)


def _gram_counts(inputs: Inputs, pairs: np.ndarray, toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Documents, and positive ones, of each n-gram bucket, from distinct (word, document)."""
    word, doc = pairs // len(toxic), pairs % len(toxic)
    order = np.argsort(doc, kind="stable")
    word, edge = word[order], np.searchsorted(doc[order], np.arange(len(toxic) + 1))
    count, hits = np.zeros(CHAR_BUCKETS), np.zeros(CHAR_BUCKETS)
    for d in range(len(toxic)):
        w = word[edge[d]:edge[d + 1]]
        size = inputs.count[w]
        at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(inputs.first[w], size)
        found = np.unique(inputs.bucket[at])
        count[found] += 1
        hits[found] += toxic[d]
    return count, hits


def _subset(inputs: Inputs, ids: np.ndarray) -> tuple[Inputs, np.ndarray]:
    """The inputs of a batch's words only, and its word numbers among them."""
    used, at = np.unique(ids, return_inverse=True)
    at = at.reshape(ids.shape)
    if used[0] < 0:
        used, at = used[1:], at - 1
    out = Inputs.__new__(Inputs)
    out.hash, out.count = inputs.hash[used], inputs.count[used]
    out.first = np.cumsum(out.count) - out.count
    out.bucket = inputs.bucket[np.arange(out.count.sum()) - np.repeat(out.first, out.count) + np.repeat(inputs.first[used], out.count)]
    return out, at


def _calibrate(net: Network, logit: np.ndarray, toxic: np.ndarray, share: float) -> None:
    """A logistic curve through document scores, labels weighing by their share."""
    weight = np.where(toxic, share / toxic.sum(), (1 - share) / (~toxic).sum())
    a, b = 1.0, 0.0
    for _ in range(50):  # Newton steps with a little shrinkage of the slope
        q = 1 / (1 + np.exp(-np.clip(a * logit + b, -30, 30)))
        r, s = weight * (q - toxic), weight * q * (1 - q)
        g = np.array([(r * logit).sum() + 1e-3 * (a - 1), r.sum()])
        hess = np.array([[(s * logit * logit).sum() + 1e-3, (s * logit).sum()], [(s * logit).sum(), s.sum() + 1e-6]])
        move = np.linalg.solve(hess, g)
        move *= min(1.0, 2.0 / max(1e-9, np.abs(move).max()))
        a, b = a - move[0], b - move[1]
    net.scale, net.shift = (float(a), float(b)) if a > 0 else (1.0, 0.0)


def _limit(count: int, most: int) -> int:
    """Hashes of ``HASH_BITS`` bits below it choose about ``most`` of ``count`` ids."""
    return max(1, min(1 << HASH_BITS, (most << HASH_BITS) // max(1, count)))


def training_sample(docs: DataFrame, labels: DataFrame, most: int = TRAIN_DOCS) -> tuple[list[bytes], np.ndarray, float]:
    """About ``most`` labelled texts of either label, chosen by a hash of the id,
    and the share of positive ones among all labels.  An error if both labels
    occur and one that had to be sampled has no document in the sample."""
    rows = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
                  .groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic")))
    count = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    limit = F.when(F.col("toxic") == 1, _limit(count.get(1, 0), most)).otherwise(_limit(count.get(0, 0), most))
    chosen = rows.where(F.shiftrightunsigned(F.xxhash64("doc_id"), 64 - HASH_BITS) < limit)  # about 2 * most rows at most
    found = docs.join(F.broadcast(chosen), "doc_id").select("doc_id", "toxic", F.coalesce("text", F.lit("")).alias("text"))
    found = sorted((r.doc_id, r.text, r.toxic) for r in found.collect())
    missing = {y for y, n in count.items() if n > most} - {y for _, _, y in found}
    if len(count) == 2 and missing:
        raise ValueError(f"the training sample has no document with label {sorted(missing)} of {count} labels: do labels and documents belong together?")
    share = count.get(1, 0) / max(1, sum(count.values()))
    return [t.encode() for _, t, _ in found], np.array([y for _, _, y in found], dtype=np.int64), share


def toxicity(docs: DataFrame, net: Network | None, carry: list[str] | None = None) -> DataFrame:
    """``row`` with the ``score`` of its whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def make():
        model = shared.value

        def fn(texts):
            if model is None:
                return [[0.0] * len(texts)]
            return [np.round(model.probability(model.score(texts)), 6)]
        return fn

    return annotate(docs, "score double", make, carry=carry)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents``; labels of the other four folds."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    labels = table(spark, sf_dir, "labels", "doc_id", "toxic").where(fold(F.col("doc_id"), 5) != 0)
    found = toxicity(docs, train(*training_sample(docs, labels)), carry=["doc_id"])
    return found.select(F.col("row.doc_id").alias("doc_id"), (fold(F.col("row.doc_id"), 5) == 0).alias("held_out"),
                        "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
