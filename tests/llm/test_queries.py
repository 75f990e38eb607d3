"""Every query against brute force over a small corpus with odd rows."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from perfmart.llm.queries import ORACLE, QUERIES
from tests.llm.conftest import BENCHMARK, CONVERSATIONS, DOCUMENTS, LABELS, PAGES, corpus, documents


#: Tested in test_runs_windows_trie.py.
ON_CONVERSATIONS = ("op12_chat_windows", "op13_prefix_trie")


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def by_id(df, key="doc_id"):
    rows = [r.asDict() for r in df.collect()]
    out = {r[key]: r for r in rows}
    assert len(out) == len(rows)
    return out


def space_words(text, lower=False):
    data = (text or "").encode()
    return (data.lower() if lower else data).split()


@pytest.fixture(scope="module")
def texts():
    return corpus()


def test_registered():
    assert sorted(int(re.match(r"op(\d+)_", k)[1]) for k in QUERIES) == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES)


def test_oracles_on_odd_rows(spark, tables, texts):
    """The SQL agrees on nulls, empty texts, copies and clashing columns."""
    import duckdb

    pages = [(i, u, h) for i, (u, h) in enumerate([
        (None, None), ("", "x"), ("no scheme", ""), ("http://", "<p>"), ("HTTP://WWW.A.Example.NET/en/x?utm_source=q&b=2&a=1#f", "<p>1</p>"),
        ("http://a.example.net/en/x?a=1&b=2", "<p>2</p>"), ("http://net", "n"), ("http://net/", "n"), ("https://xnet/", "n"),
        ("http://org/fr/", "o"), ("http://a.org:80/fr/?q=://b", "o"), ("http://a..example.com/de/" + "x" * 5000, "y" * 5000),
        ("http://example.com/DE/", "z"), ("http://user@example.com/de/a/", "z"), ("http://example.com/de/a", "z")])]
    turns = [(1, 0, "system", "Be <| brief"), (1, 1, "user", "a<|im_end|>"), (1, 2, "assistant", None), (1, 2, "assistant", "x" * 6000),
             (1, None, None, "first"), (2, 3, "user\n<|nl|>", ""), (2, 3, "user\n<|nl|>", ""), (5, 0, "user", "é" * 900), (5, 5000, "assistant", "far"),
             (5, 2, "assistant", "yes"), (6, 9, "user", "own"), (-3, 0, "user", "é" * 900), (-1, 7, "assistant", "more")]
    folder = tables(documents=(DOCUMENTS, documents(texts)), pages=(PAGES, pages), conversations=(CONVERSATIONS, turns),
                    benchmark=(BENCHMARK, [(1, texts[7]), (2, "one"), (3, None), (12, "two words"), (4, " ".join(texts[8].split()[:40]))]))
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    for name, sql in ORACLE.items():
        df = QUERIES[name](spark, folder)
        want = con.sql(sql)
        names = want.columns
        assert sorted(df.columns) == sorted(names), name
        got = sorted((tuple(r) for r in df.select(*names).collect()), key=str)
        assert got == sorted(want.fetchall(), key=str), name


def test_empty_tables(spark, tables):
    folder = tables(documents=(DOCUMENTS, []), benchmark=(BENCHMARK, []), labels=(LABELS, []), pages=(PAGES, []))
    for name, query in QUERIES.items():
        if name not in ON_CONVERSATIONS:
            assert query(spark, folder).collect() == [], name


def test_null_ids_and_repeated_rows(spark, tables, texts):
    """A row without an id and a row that occurs twice are both judged."""
    long = " ".join(f"w{i}" for i in range(80))
    rows = [(None, long, "en", "s", 1), (1, long, "en", "s", 1), (1, long, "en", "s", 1), (2, long, None, None, None), (3, None, None, None, None)]
    folder = tables(documents=(DOCUMENTS, rows), benchmark=(BENCHMARK, [(None, long), (5, long), (5, long)]),
                    labels=(LABELS, [(1, 1, 1), (1, 1, 0), (2, None, None), (None, 1, 1)]),
                    pages=(PAGES, [(None, "http://a.net/", "x"), (1, "http://a.net/", None), (1, "http://a.net/", None)]))
    for name, query in QUERIES.items():
        if name in ON_CONVERSATIONS:
            continue
        found = query(spark, folder).collect()
        assert len(found) == (3 if name[:4] in ("op4_", "op5_") else 5), name
    got = [(r.doc_id, r.n_removed) for r in QUERIES["op10_substring_dedup"](spark, folder).collect()]
    assert sorted(got, key=str) == [(1, 0), (1, 0), (2, 80), (3, 0), (None, 0)]
    got = {(r.doc_id, r.n_hit, r.n_items, r.contaminated) for r in QUERIES["op9_decontaminate"](spark, folder).collect()}
    assert got == {(None, 80, 1, True), (1, 80, 1, True), (2, 80, 1, True), (3, 0, 0, False)}
    got = {(r.doc_id, r.component_id) for r in QUERIES["op6_ngram_join"](spark, folder).collect()}
    assert got == {(None, 1), (1, 1), (2, 1), (3, 3)}


def test_op1_properties(spark, tables, texts):
    found = by_id(QUERIES["op1_spotsigs"](spark, tables(documents=(DOCUMENTS, documents(texts)))))
    for i, t in enumerate(texts):
        t, nxt = t or "", texts[(i + 1) % len(texts)] or ""
        q = len(t) // 4
        r = found[i]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == sha((t[:-q] if q else t) + nxt[:q])
        a, b, c = (set(x.split()) for x in (r["fingerprint"], r["edited_fingerprint"], found[(i + 1) % len(texts)]["fingerprint"]))
        assert r["near_edited"] == (len(a & b) / len(a | b) if a | b else 1.0)
        assert r["near_next"] == (len(a & c) / len(a | c) if a | c else 1.0)
        assert bool(a) == bool(re.search(r"[^\W_]", t))
    same = defaultdict(set)
    for i, t in enumerate(texts):
        same[t].add(found[i]["fingerprint"])
    assert all(len(x) == 1 for x in same.values())


def test_op3_and_op7_equal_the_libraries(spark, tables, texts):
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    odd = [*texts, " " * 40 + "x", "<|endoftext|> a  <|endoftext|>", "▁▁ a▁", "don't we'll\r\n\r\n x 　 y ", "\x00\x01", "a" * 3000, "日 本" * 50]
    folder = tables(documents=(DOCUMENTS, documents(odd)))
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    byte = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    three, seven = by_id(QUERIES["op3_sentencepiece"](spark, folder)), by_id(QUERIES["op7_token_counts"](spark, folder))
    for i, t in enumerate(odd):
        ids = model.encode(t or "", add_bos=True, add_eos=True)
        assert three[i] == {"doc_id": i, "n_tokens": len(ids), "ids_sha256": sha(np.array(ids, "<u4").tobytes()),
                            "decoded_sha256": sha(model.decode(ids))}
        n = len(byte.encode(t or "", add_special_tokens=False).ids)
        assert seven[i] == {"doc_id": i, "n_bytes": len((t or "").encode()), "n_tokens": n, "over_limit": n > 1024}


def test_op6_brute_force(spark, tables):
    rng = random.Random(5)
    base = [f"w{rng.randrange(10 ** 6)}" for _ in range(150)]
    group = [" ".join(base)]
    for _ in range(40):  # near copies on both sides of the limit, whose origin has a larger id
        words = list(base)
        for _ in range(rng.randint(1, 4)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10 ** 6)}"
        group.insert(0, " ".join(words))
    texts = corpus(9, 40) + group
    sets = []
    for t in texts:
        w = space_words(t, lower=True)
        sets.append({tuple(w[i:i + 3]) for i in range(len(w) - 2)} if len(w) >= 3 else {tuple(w)} if w else set())
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            m = len(sets[a] & sets[b])
            if m and 100 * m >= 90 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    found = by_id(QUERIES["op6_ngram_join"](spark, tables(documents=(DOCUMENTS, documents(texts)))))
    for i, s in enumerate(sets):
        assert (found[i]["n_shingles"], found[i]["component_id"]) == (len(s), find(i)), i


def test_op10_brute_force(spark, tables):
    texts = corpus(11, 60) + ["And " * 400, "x y " * 300 + "And " * 200]
    low = {}
    for i, t in enumerate(texts):
        w = space_words(t)
        for k in range(len(w) - 49):
            low.setdefault(tuple(w[k:k + 50]), i)
    found = by_id(QUERIES["op10_substring_dedup"](spark, tables(documents=(DOCUMENTS, documents(texts)))))
    for i, t in enumerate(texts):
        w = space_words(t)
        gone = {k + j for k in range(len(w) - 49) if low[tuple(w[k:k + 50])] < i for j in range(50)}
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        assert found[i] == {"doc_id": i, "n_words": len(w), "n_removed": len(gone), "kept_sha256": sha(kept)}, i


SYLLABLES = {"aa": ["the", "ing", "tion", "and", "wh"], "bb": ["que", "elle", "eau", "ré", "oi"], "cc": ["sch", "ung", "keit", "ä", "ver"]}


def spoken(lang, rng, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))


def test_op8_held_out_accuracy(spark, tables):
    rng = random.Random(1)
    langs = [rng.choice(list(SYLLABLES)) for _ in range(150)]
    texts = [spoken(x, rng, rng.choice([5, 30, 80])) for x in langs] + [None, "", "123 !!", spoken("aa", rng, 30000)]
    folder = tables(documents=(DOCUMENTS, documents(texts, dict(enumerate(langs)) | {153: "aa"})))
    found = by_id(QUERIES["op8_language"](spark, folder))
    for i in range(len(texts)):
        assert found[i]["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= found[i]["score"] <= 1
    assert [found[150 + i]["lang_pred"] for i in range(4)] == ["und", "und", "und", "aa"]
    assert np.mean([found[i]["lang_pred"] == x for i, x in enumerate(langs) if found[i]["held_out"]]) > 0.95


def test_op2_held_out_accuracy(spark, tables):
    rng = random.Random(2)
    stems = ["gromp", "zlurk", "vexol"]
    texts, toxic = [], []
    for i in range(320):
        words = spoken(rng.choice(list(SYLLABLES)), rng, rng.choice([10, 40, 90])).split()
        toxic.append(int(i % 3 == 0))
        for _ in range(4 * toxic[-1]):
            words.insert(rng.randrange(len(words)), rng.choice(stems) + rng.choice(["", "ing", "ä", "en"]))
        texts.append(" ".join(words))
    texts += [None, "", "...", spoken("aa", rng, 8000)]
    folder = tables(documents=(DOCUMENTS, documents(texts)), labels=(LABELS, [(i, 1, y) for i, y in enumerate(toxic)]))
    found = by_id(QUERIES["op2_toxicity"](spark, folder))
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in found.values())
    assert all(found[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i in found)
    right = [found[i]["predicted"] == y for i, y in enumerate(toxic) if found[i]["held_out"]]
    assert np.mean(right) > 0.9
    assert [found[320 + i]["predicted"] for i in range(4)] == [0, 0, 0, 0]
