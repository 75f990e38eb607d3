"""Periodic runs, chat windows and the prefix trie against brute force."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from perfmart.llm import chat_windows, periodic_runs, prefix_trie
from perfmart.llm.queries import QUERIES
from tests.llm.conftest import CONVERSATIONS, DOCUMENTS, corpus, documents


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# -- periodic runs -------------------------------------------------------------

def brute_runs(w):
    """Every maximal stretch of a smallest period q with 4 q words or more."""
    out, n = set(), len(w)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            s = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            size = i - s + q
            part = w[s:s + size]
            if size >= 4 * q and not any(part[p:] == part[:size - p] for p in range(1, q)):
                out.add((s, size, q))
            i += 1
    return sorted(out)


def periodic_words(rng):
    alphabet = rng.choice([1, 2, 3, 50])
    w = [rng.randrange(alphabet) for _ in range(rng.choice([0, 1, 3, 4, 5, 9, 20, 60, 150, 300]))]
    for _ in range(rng.choice([0, 1, 1, 2, 3])):
        root = [rng.randrange(alphabet + 1) for _ in range(rng.randint(1, 1 + len(w) // 5))]
        if rng.random() < 0.4:  # a period with a highly periodic part
            root = [rng.randrange(2)] * (len(root) - 1) + [7]
        elif rng.random() < 0.3:
            root = root[:1 + len(root) // 6] * 6 + [9]
        at = rng.randrange(len(w) + 1)
        w[at:at] = [root[i % len(root)] for i in range(rng.randint(3 * len(root), 7 * len(root) + 3))]
    return w


def test_runs_equal_brute_force():
    rng = random.Random(11)
    thue = [bin(i).count("1") % 2 for i in range(256)]
    total = 0
    for k in range(150):
        texts = [periodic_words(rng) for _ in range(rng.choice([1, 3, 8]))]
        if k % 50 == 0:
            texts += [thue, thue * 4 + [5], [], [3] * 700]
        first = np.concatenate([[0], np.cumsum([len(w) for w in texts])]).astype(np.int64)
        found = [x.tolist() for x in periodic_runs.find_runs(np.array([x for w in texts for x in w], dtype=np.uint64), first)]
        got = defaultdict(list)
        for t, *run in zip(*found, strict=True):
            got[t].append(tuple(run))
        for t, w in enumerate(texts):
            assert got[t] == brute_runs(w), w
            total += len(got[t])
    assert total > 1000
    with pytest.raises(ValueError):
        periodic_runs.find_runs(np.zeros(1, np.uint64), np.array([0, 1]), 2)


def test_periods_near_a_power_of_two_in_one_long_text():
    rng = random.Random(3)
    words, want, at = [], [], 0
    for q in (1, 2, 3, 4, 7, 8, 9, 15, 16, 17, 255, 256, 257, 1023, 1024):
        root = [rng.getrandbits(60) for _ in range(q)]
        size = max(6, 4 * q)
        words += [root[i % q] for i in range(size)] + [rng.getrandbits(60), rng.getrandbits(60)]
        want.append((at, size, q))
        at += size + 2
    t, *found = periodic_runs.find_runs(np.array(words, dtype=np.uint64), np.array([0, len(words)]))
    assert list(zip(*[x.tolist() for x in found], strict=True)) == want and not t.any()


def brute_op11(doc_id, text):
    w = (text or "").encode().split()
    n = len(w)
    if doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    runs = [r for r in brute_runs(w) if r[1] >= 6]
    gone = {i for s, size, q in runs for i in range(s + q, s + size)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            sha("".join(f"{s},{size},{q}\n" for s, size, q in sorted(runs, key=lambda r: (r[0], r[2])))),
            sha(b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))


def test_op11_equals_brute_force(spark, tables):
    texts = [t for t in corpus(5, 60) if t is None or len(t) < 4000]
    texts += ["a " * 6, "a " * 5, "a b " * 4 + "a", "x y z\n" * 5 + "end", "la la la la la la\tla no no no no no no", "é " * 40 + "è " * 40]
    rows = documents(texts) + documents(texts[-3:], first=len(texts) - 3) + [(None, "b b b b b b", "en", "s", 11), (None, None, "en", "s", 0)]
    df = QUERIES["op11_periodic_runs"](spark, tables(documents=(DOCUMENTS, rows)))
    want = [brute_op11(r[0], r[1]) for r in rows]
    columns = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(str, (tuple(r) for r in df.select(*columns).collect()))) == sorted(map(str, want))
    assert sum(r[1] > 0 for r in want) > 8
    assert QUERIES["op11_periodic_runs"](spark, tables(documents=(DOCUMENTS, []))).collect() == []


def test_runs_keep_other_columns(spark):
    docs = spark.createDataFrame([(1, "a a a a a a b", "x", "y"), (1, None, None, None)], "words int, text string, runs string, row string")
    one, none = sorted(periodic_runs.periodic_runs(docs).collect(), key=lambda r: r.words, reverse=True)
    assert one.row.runs == "x" and [tuple(r) for r in one.runs] == [(0, 6, 1)] and one.collapsed == "a b" and one.words == 7
    assert (none.words, none.runs, none.collapsed, none.row.words) == (0, [], "", 1)


# -- chat windows --------------------------------------------------------------

def turns_of(rows):
    out = defaultdict(list)
    for c, t, role, text in rows:
        out[c].append((t is not None, t or 0, role or "", text or ""))
    return {c: [(x[2], x[3]) for x in sorted(v)] for c, v in out.items()}


def odd_conversations(seed, n):
    rng = random.Random(seed)
    bits = ["a", "é", "<", "\\", "|", "<|", "<\\|", "<|im_end|>", "\n", " word", "<|im_start|>user\n", "日本"]
    rows = [(1, 0, "system", "S" * 40), (None, 3, "user", "lost"), (None, 1, "assistant", "x"), (3, None, None, None)]
    for c in range(2, n):
        for t in range(rng.choice([1, 2, 5, 30])):
            role = "system" if t == 0 and rng.random() < 0.4 else rng.choice(["user", "assistant", "assistant", "tool\n<|nl|>", None])
            rows.append((c, rng.choice([t, t, t, None, 50 + t]), role, None if rng.random() < 0.05 else "".join(
                rng.choice(bits) for _ in range(rng.choice([0, 3, 40, 200])))))
    return rows + rows[-3:]


@pytest.mark.parametrize("block", [1024, 7])
def test_windows_read_back(spark, block):
    rows = odd_conversations(block, 25)
    df = spark.createDataFrame(rows, ",".join(f"{c} {'long' if i < 2 else 'string'}" for i, (c, _) in enumerate(CONVERSATIONS)))
    budget, history = 60, 15
    found = chat_windows.read_back(chat_windows.windows(df, budget, history, block)).collect()
    by_conv = defaultdict(list)
    for r in sorted(found, key=lambda r: (r.block, r.span)):
        by_conv[r.conv_id].append(r)
    want = turns_of(rows)
    assert set(by_conv) == set(want)
    repeats = 0
    for c, windows in by_conv.items():
        assert [(t.role, t.text) for w in windows for t in w.turns] == want[c]
        assert "".join(w.loss_text for w in windows) == "".join(x for role, x in want[c] if role == "assistant")
        last = None
        for w in windows:
            pieces = w.text.split("<|im_start|>")[1:]
            assert all(p.endswith("<|im_end|>\n") and p.count("<|") == 1 + p.split("\n")[0].count("<|nl|>") for p in pieces)
            assert len(pieces) == w.repeated + len(w.turns)
            assert all(w.text[s.start - 1] == "\n" and w.text[s.start + s.length:].startswith("<|im_end|>") for s in w.loss)
            cost = [math.ceil((len(p) + len("<|im_start|>")) / 4) for p in pieces]
            assert w.tokens == sum(cost)
            assert w.tokens <= budget or len(w.turns) == 1 or cost[0] > budget - history - 4
            if last is not None:
                system = want[c][0][0] == "system"
                past = pieces[system:w.repeated]
                assert pieces[:system] == first[:system] and sum(cost[system:w.repeated]) <= history
                if last.block == w.block:
                    before = last.text.split("<|im_start|>")[1:]
                    assert past == before[len(before) - len(past):]
                else:
                    assert past == []
                repeats += len(past)
            else:
                assert w.repeated == 0
                first = pieces
            last = w
    assert repeats > 20
    assert {r.conv_id: tuple(r)[1:] for r in chat_windows.digests(chat_windows.windows(df, budget, history, block)).collect()} == {
        c: (len(t), sha("".join(f"{a}\n{b}\n" for a, b in t)), sum(len(b) for a, b in t if a == "assistant"),
            sha("".join(b for a, b in t if a == "assistant")), sum(len(w.text) for w in by_conv[c])) for c, t in want.items()}


def test_op12_on_an_empty_table(spark, tables):
    rows = QUERIES["op12_chat_windows"](spark, tables(conversations=(CONVERSATIONS, []))).collect()
    said = "<|im_end|><|im_start|>assistant ok"
    assert [(r.conv_id, r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in rows] == [
        (-1, 2, sha(f"user\n{said}\nassistant\n{said}\n"), len(said), sha(said))]


def test_windows_run_without_python(spark, tables):
    df = QUERIES["op12_chat_windows"](spark, tables(conversations=(CONVERSATIONS, [(1, 0, "user", "a")])))
    plan = df._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "ExistingRDD", "Pandas"))


# -- prefix trie -----------------------------------------------------------------

def brute_trie(rows):
    own = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            key = hashlib.md5(f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).hexdigest()
            own[c].append((t is not None, t or 0, role or "", key, text or ""))
    own = {c: [(x[2], x[4]) for x in sorted(v)] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = own.get(c - int(math.fmod(c, 5)), [])[:h] + turns[h:]
    members, children = defaultdict(list), defaultdict(set)
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            members[tuple(built[c][:d])].append(c)
    for p in members:
        if p:
            children[p[:-1]].add(p)
    out = []
    for p, m in members.items():
        below = [q for q in members if q[:len(p)] == p]
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]),
                    sum(not children[q] for q in below), sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in below if q),
                    sha(",".join(str(c) for c in m if len(built[c]) == len(p)))))
    return sorted(out, key=str)


def test_trie_equals_brute_force(spark):
    rng = random.Random(8)
    shared = [("user", "hi"), ("assistant", "hé"), ("user", "again"), ("assistant", "")]
    for size in (4, 60):
        rows = [(None, 1, "user", "x"), (12, None, None, None)]
        for c in rng.sample(range(-30, 60), size):
            turns = shared[:rng.randint(0, 4)] if rng.random() < 0.6 else []
            turns = turns + [(rng.choice(["user", "assistant", None]), rng.choice(["", "a", "b", None])) for _ in range(rng.choice([0, 1, 2, 12]))]
            rows += [(c, rng.choice([t, t, t, None]), *x) for t, x in enumerate(turns)]
        rows += rows[-2:]  # repeated rows are repeated turns
        rows += [(c, t, *x) for c in range(100, 130) for t, x in enumerate([("user", "copy")] * 9 + shared)]  # a large group of copies
        df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("key", F.lit("k"))
        found = prefix_trie.with_shared_heads(prefix_trie.sequences(df))
        want = brute_trie(rows)
        for turns in (1, 9, 10 ** 6):
            got = sorted((tuple(r) for r in prefix_trie.prefix_trie(found, turns).collect()), key=str)
            assert got == want, turns


def test_long_conversations_are_gathered_in_blocks(spark, monkeypatch):
    rows = [(7, t, "user", str(t % 5)) for t in range(40)] + [(8, t, "user", str(t % 5)) for t in range(0, 80, 2)] + [(9, None, "user", "0")]
    random.Random(1).shuffle(rows)
    monkeypatch.setattr(prefix_trie, "BLOCK", 6)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = prefix_trie.prefix_trie(prefix_trie.with_shared_heads(prefix_trie.sequences(df)), 10)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_trie(rows)


def test_ternary_tree():
    rng = random.Random(2)
    sequences = sorted({tuple(rng.randrange(4) for _ in range(rng.randrange(6))) for _ in range(300)})
    trie = prefix_trie.Trie()
    ends = {sequences[m]: trie.insert(list(sequences[m])) for m in prefix_trie.median_first(len(sequences))}
    assert len(set(ends.values())) == len(sequences)
    for s, node in ends.items():
        assert tuple(trie.symbol[x] for x in trie.path(node)[1:]) == s and trie.depth[node] == len(s)
    assert len(trie.symbol) == len({s[:d] for s in sequences for d in range(len(s) + 1)} | {()})
    assert sorted(prefix_trie.median_first(13)) == list(range(13)) and next(prefix_trie.median_first(13)) == 6
    wide = prefix_trie.Trie()  # children of one node stay balanced
    for m in prefix_trie.median_first(1023):
        wide.insert([m])
    at, steps = wide.below[0], 0
    while at >= 0:
        at, steps = wide.more[at], steps + 1
    assert steps == 10


def test_op13_on_an_empty_table(spark, tables):
    assert QUERIES["op13_prefix_trie"](spark, tables(conversations=(CONVERSATIONS, []))).collect() == []
