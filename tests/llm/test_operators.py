"""The operators' own interfaces: parts that the queries use differently or not at all."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from perfmart.llm import decontaminate, pieces, spotsigs, substrings, token_counts, toxicity, url_filter, warc
from perfmart.llm.components import components
from perfmart.llm.text import NOT_SPACE, Words, table
from tests.llm.conftest import BENCHMARK, DOCUMENTS, corpus, documents


def test_words_and_hashes():
    words = Words([b"a  bb\n a", None, b"", b"bb a bb"], NOT_SPACE)
    assert words.first.tolist() == [0, 3, 3, 3, 6]
    h = words.hash.tolist()
    assert h[0] == h[2] == h[4] and h[1] == h[3] == h[5] and h[0] != h[1]
    assert words.whole(3).tolist() == [True, False, False, True, False, False]
    assert words.gram(2)[1] == words.gram(2)[3] and words.gram(2)[0] == words.gram(2)[4]  # bb a, a bb


def test_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, 3), (3, 7), (5, 5), (9, 7)] + \
        [(500, rng.randrange(501, 560)) for _ in range(80)]
    found = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(found[i] == 100 for i in range(100, 141)) and found[9] == found[7] == 3
    assert {found[b] for a, b in edges if a == 500} == {500} and 5 not in found
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_near_duplicates_equal_brute_force(spark):
    texts = corpus(21, 50)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = {r.doc_id: set(r.s) for r in spotsigs.signatures(docs, "text", "s").collect()}
    members, pairs = spotsigs.near_duplicates(docs, least=0.6)
    rep = {r.doc_id: r.rep for r in members.collect()}
    first = {}
    for i in sorted(sets):
        first.setdefault(frozenset(sets[i]), i)
    assert rep == {i: first[frozenset(s)] if s else None for i, s in sets.items()}
    reps = sorted(set(rep.values()) - {None})
    want = {(a, b) for a, b in itertools.combinations(reps, 2) if len(sets[a] & sets[b]) >= 0.6 * len(sets[a] | sets[b])}
    assert {(r.a, r.b) for r in pairs.collect()} == want and want


def test_suffix_automaton_lengths():
    rng = random.Random(1)
    items = [[rng.randrange(3) for _ in range(rng.randint(1, 12))] for _ in range(8)]
    sam = decontaminate.SuffixAutomaton()
    for x in items:
        sam.add(x)
    inside = {tuple(x[i:j]) for x in items for i in range(len(x)) for j in range(i + 1, len(x) + 1)}
    text = [rng.randrange(4) for _ in range(300)]
    for i, (_, size) in enumerate(sam.stream(text)):
        assert size == max([n for n in range(1, 13) if n <= i + 1 and tuple(text[i - n + 1:i + 1]) in inside], default=0)


def test_decontamination_in_blocks_and_cut_spans(spark, tables):
    passage = " ".join(f"p{i}" for i in range(20))
    folder = tables(documents=(DOCUMENTS, documents([f"A b. {passage.upper()}, c é " + "d " * 50, passage, "short item", "clean", None])),
                    benchmark=(BENCHMARK, [(1, passage), (2, "short item"), (3, "p3 p4"), (4, None), (5, "")]))
    docs, items = (table(spark, folder, t, "*") for t in ("documents", "benchmark"))
    whole, cut = (decontaminate.contamination(docs, items, block_words=n) for n in (10 ** 6, 5))
    key = lambda df: sorted(map(str, df.select("row.doc_id", "words", "spans", "items").collect()))
    assert key(whole) == key(cut)
    rest = {r.i: r.t for r in whole.select(F.col("row.doc_id").alias("i"), decontaminate.without_spans(
        F.col("row.text"), F.col("spans")).alias("t")).collect()}
    assert rest[0] == "A b. , c é " + "d " * 50 and rest[1] == "" and rest[2] == "" and rest[3] == "clean" and rest[4] is None
    assert whole.select("row.*").columns == docs.columns  # clashing names survive


def test_item_blocks_are_bounded_and_matched_off_the_driver(spark, tables, monkeypatch):
    rng = random.Random(6)
    said = lambda n: " ".join(rng.choice("abcdefgh") + rng.choice("xyz") for _ in range(n))
    items = [(i, said(rng.choice([1, 2, 3, 7, 13, 30]))) for i in range(40)] + [(40, said(400)), (41, said(15)), (None, said(9))]
    texts = [said(rng.randrange(40)) for _ in range(20)]
    for _, t in items[-12:]:
        w = t.split()
        i = rng.randrange(len(w))
        texts += [said(5) + " " + " ".join(w[i:i + 40]), " ".join(w[:i]) + " zz " + t]
    folder = tables(documents=(DOCUMENTS, documents([*texts, texts[-1]])), benchmark=(BENCHMARK, items))
    docs, bench = (table(spark, folder, t, "*") for t in ("documents", "benchmark"))
    blocks = decontaminate.dealt(bench, block_words=60).groupBy("block").agg(F.sum("n").alias("n")).collect()
    assert len(blocks) > 10 and max(r.n for r in blocks) <= 60

    def none(*_):
        raise AssertionError("an automaton on the driver")

    monkeypatch.setattr(decontaminate.Matcher, "__init__", none)
    found = decontaminate.contamination(docs, bench, block_words=60).select("row.doc_id", "words", "spans", "items").collect()
    wanted = {}
    for d, t in enumerate([*texts, texts[-1]]):
        w, hit, owners = t.split(), set(), set()
        for item, x in items:
            x = x.split()
            m = min(13, len(x))
            for k in range(len(x) - m + 1):
                for i in range(len(w) - m + 1):
                    if w[i:i + m] == x[k:k + m]:
                        hit |= set(range(i, i + m))
                        owners |= {str(item)} - {"None"}
        wanted[d] = (len(w), hit, sorted(owners))
    got = {r.doc_id: (r.words, {i for s in r.spans for i in range(s["a"], s["b"])}, r["items"]) for r in found}
    assert got == wanted and len(found) == len(wanted)


def test_url_cascade_is_exact_over_its_universe(spark):
    rng = random.Random(8)
    universe = [f"h{i}.net/{i % 7}/" for i in range(6000)]
    listed = rng.sample(universe, 300) + ["other.org/", None, universe[0], universe[0]]
    frame = spark.createDataFrame([(k,) for k in universe], "key string")
    levels = url_filter.cascade(spark.createDataFrame([(k,) for k in listed], "key string"), frame)
    assert len(levels) > 2 and sum(len(x.bits) for x in levels) < 4000
    found = {r.key for r in frame.where(url_filter.is_listed(F.col("key"), levels)).collect()}
    assert found == set(listed) & set(universe)
    assert url_filter.cascade(spark.createDataFrame([], "key string"), frame) == []


def test_revisits_by_brute_force(spark):
    rng = random.Random(6)
    rows = []
    for i in range(300):
        url = rng.choice(["http://a.net/x/", "https://www.A.net/x?utm_id=1", "http://b.net", "none", None])
        kind = rng.choice(["response", "revisit"])
        tag = rng.choice(["t1", "t2", None])
        date = rng.choice(["m1", "m2", None])
        headers = [h for h in [("ETag", tag), ("Last-Modified", date), ("Date", str(i)), ("X-Own", str(i))] if h[1]]
        rows.append((i, url, rng.choice([None, *range(0, 90000, 700)]), kind, rng.choice([200, 200, 404]), headers, f"p{i}", i))
    records = spark.createDataFrame(rows, "record_id long, url string, ts long, kind string, status int, "
                                          "headers array<struct<name:string,value:string>>, payload_id string, payload_bytes long")
    canon = {r.record_id: r.c for r in records.select("record_id", warc.canonical(F.col("url")).alias("c")).collect()}
    assert set(canon.values()) == {"a.net/x", "b.net/", None}
    found = {r.row.record_id: r for r in warc.resolve(records, bucket=10000).collect()}
    assert set(found) == {r[0] for r in rows if r[3] == "revisit"}
    for i, r in found.items():
        _, _, ts, _, _, headers, _, _ = rows[i]
        own = {n.lower(): v for n, v in headers}
        earlier = [x for x in rows if canon[i] and ts is not None and x[2] is not None and canon[x[0]] == canon[i]
                   and x[3] == "response" and x[4] == 200 and x[2] < ts]
        best = max(earlier, key=lambda x: (x[2], x[0]), default=None)
        if best is None:
            assert (r.outcome, r.refers_to, r.merged) == ("missing", None, None)
            continue
        old = {n.lower(): v for n, v in best[5]}
        name = next((n for n in ("etag", "last-modified") if n in own), None)
        outcome = "unvalidated" if name is None else "resolved" if own[name] == old.get(name) else "mismatch"
        assert r.outcome == outcome
        if outcome != "mismatch":
            want = old | {n: v for n, v in own.items() if n in warc.PERMITTED}
            assert r.refers_to == best[0] and [(h.name, h.value) for h in r.merged] == sorted(want.items())


def test_second_run_encodes_no_misses(spark, tables, monkeypatch, tmp_path):
    import public_tokenizers
    docs = table(spark, tables(documents=(DOCUMENTS, documents(["a b", "a b", None, "c"]))), "documents", "doc_id", "text")
    path, cache = public_tokenizers.path("byte_bpe_50k.json"), str(tmp_path / "cache")
    first = sorted(map(str, token_counts.token_counts(docs, path, cache).collect()))
    sizes = spark.read.parquet(cache).count()
    assert sizes == 3
    assert sorted(map(str, token_counts.token_counts(docs, path, cache).collect())) == first
    assert spark.read.parquet(cache).count() == sizes
    other = token_counts.token_counts(docs, public_tokenizers.path("piece_bpe_32k.model"), cache)
    assert other.count() == 4 and spark.read.parquet(cache).count() == 2 * sizes


def test_counts_without_a_stable_row_order(spark, tables, monkeypatch, tmp_path):
    """Rows that have other places at the second reading are counted all the same;
    so are rows found by a join, where the filter would be too large."""
    import public_tokenizers
    docs = table(spark, tables(documents=(DOCUMENTS, documents(["a b", "a b", None, "c", "d e f", "d e f"] * 5))), "documents", "doc_id", "text")
    path = public_tokenizers.path("byte_bpe_50k.json")
    key = lambda cache: sorted(map(str, token_counts.token_counts(docs, path, str(tmp_path / cache)).collect()))
    want = key("a")
    assert len(want) == 30
    monkeypatch.setattr(token_counts, "id_filter", lambda ids: lambda x: np.zeros(len(x), dtype=bool))
    assert key("b") == want
    monkeypatch.setattr(token_counts, "id_filter", lambda ids: lambda x: np.ones(len(x), dtype=bool))
    assert key("c") == want
    monkeypatch.setattr(token_counts, "id_filter", lambda ids: None)
    assert key("d") == want
    assert all(spark.read.parquet(str(tmp_path / c)).count() == 4 for c in "abcd")


def test_merged_spans(spark):
    rng = random.Random(9)
    rows = []
    for i in range(60):
        spans = [(a, a + rng.randint(1, 4)) for a in (rng.randrange(40) for _ in range(rng.randrange(12)))]
        rows.append((i, [(a, b, 10 * a, 10 * b - 1) for a, b in spans]))
    found = spark.createDataFrame(rows, f"i int, spans {decontaminate.SPANS}").select("i", decontaminate.merged(F.col("spans")).alias("m")).collect()
    for r in found:
        inside = sorted({x for a, b, _, _ in rows[r.i][1] for x in range(a, b)})
        first = [x for x in inside if x - 1 not in inside]
        last = [x for x in inside if x + 1 not in inside]
        assert [tuple(s) for s in r.m] == [(a, b + 1, 10 * a, 10 * b + 9) for a, b in zip(first, last, strict=True)]


def test_rules_of_one_length(spark):
    pages = spark.createDataFrame([(1, "http://b.net/abc"), (2, "http://b.net/x"), (3, "http://c.net/ab"), (4, None)], "page_id long, url string")
    rules = url_filter.rule_table(spark, {"b.net/": "block", "net/ab": "allow"})
    found = {r.i: (r.rule, r.verdict) for r in url_filter.judge(pages, rules).select(F.col("row.page_id").alias("i"), "rule", "verdict").collect()}
    assert found == {1: ("net/ab", "allow"), 2: ("b.net/", "block"), 3: ("net/ab", "allow"), 4: (None, "allow")}


def test_merge_rounds_equal_one_merge_at_a_time():
    coder = pieces.Coder(pieces.model_path())
    v, rng = coder.vocabulary, random.Random(12)
    words = ["▁" + "".join(rng.choice(["a", "b", "an", "the", "ing", "é", "ab", "日", "z"]) for _ in range(rng.randint(1, 40))) for _ in range(400)]
    ids, at = pieces.encode_words(v, words)
    for w, a, b in zip(words, at[:-1], at[1:], strict=True):
        one = pieces.merge_in_order(v, [int(v.char[ord(c)]) for c in w])
        want = [i for s, c in zip(one, w, strict=False) for i in [s]] if all(s < v.size for s in one) else None
        if want is not None:
            assert ids[a:b].tolist() == want
    assert coder.decode(np.array([3 + 0xE6, 3 + 0x97, 3 + 0xA5, 3 + 0xFF], "<u4").tobytes()) == "日�"


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(3)
    words = toxicity.lowered([b"some words of a text that is longer than one window of the network is " * 2, b"short one"])
    inputs = toxicity.Inputs(words)
    net = toxicity.Network.new(inputs.hash[:5], 1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    _, ids = toxicity.windows(words, inputs.number)
    labels = rng.integers(0, 2, len(ids)).astype(np.float64)

    def loss():
        z = net.logits(net.project(net.embed(inputs)[1]), ids).astype(np.float64)
        return np.mean(np.log1p(np.exp(-z * (2 * labels - 1))))

    found = net.gradients(inputs, ids, labels)
    for name in ("Wf", "Ub", "cf", "A", "v", "w", "b"):
        flat = net.p[name].reshape(-1)
        for k in rng.integers(0, flat.size, 3):
            was, step = flat[k], 1e-3
            flat[k] = was + step
            up = loss()
            flat[k] = was - step
            down = loss()
            flat[k] = was
            assert abs((up - down) / (2 * step) - found[name].reshape(-1)[k]) < 2e-3, name


def test_training_sample_of_many_labels(spark):
    """More than 2**20 labels for each document wanted; labels that fit no document."""
    n = 10 << 20
    labels = spark.range(n, 2 * n).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("toxic"))
    docs = labels.select("doc_id", F.lit("a text").alias("text"))
    texts, toxic, share = toxicity.training_sample(docs, labels, most=4)
    assert share == 0.5 and 0 < toxic.sum() < len(toxic) == len(texts) <= 20
    with pytest.raises(ValueError, match="label"):
        toxicity.training_sample(docs.where("doc_id % 2 = 0"), labels, most=4)


def test_windows_cover_the_text():
    for n in (0, 1, 31, 32, 33, 47, 48, 49, 200):
        words = toxicity.lowered([b"w " * n])
        _, ids = toxicity.windows(words, np.arange(n))
        assert [int(x[0]) for x in ids if n] == [s for s in toxicity.window_starts(n) if n]
        assert set(ids.ravel()) - {-1} == set(range(n))


def test_index_finds_every_window():
    rng = random.Random(2)
    texts = [[rng.randint(1, 3) for _ in range(rng.randint(5, 40))] for _ in range(30)]
    lows = np.array([rng.randrange(1000) for _ in texts])
    index = substrings.FMIndex(np.array([w for t in texts for w in t]), np.cumsum([len(t) for t in texts]), lows, 5)
    out, at = index.stream()
    low = {}
    for t, x in zip(texts, lows, strict=True):
        for k in range(len(t) - 4):
            key = tuple(t[k:k + 5])
            low[key] = min(low.get(key, x), x)
    for t, a in zip(texts, at[:-1], strict=True):
        assert out[a:a + len(t) - 4].tolist() == [low[tuple(t[k:k + 5])] for k in range(len(t) - 4)]


@pytest.mark.parametrize("split", [1, 3, 10 ** 9])
def test_dealing_windows_one_by_one_changes_nothing(spark, split):
    texts = corpus(31, 40)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = substrings.without_repeats(docs, split=split)
    got = sorted((r.row.doc_id, r.words, r.removed, r.kept) for r in found.collect())
    want = sorted((r.row.doc_id, r.words, r.removed, r.kept) for r in substrings.without_repeats(docs, split=7).collect())
    assert got == want and any(x[2] for x in got)


@pytest.mark.parametrize(("shard_words", "most"), [(60, 29), (400, 0), (250_000, 0)])
def test_keys_larger_than_a_shard_and_more_keys_than_a_filter(spark, shard_words, most):
    """Keys with more words than a shard are dealt out by window; without a
    filter the keys are joined: the result is the same."""
    rng = random.Random(9)
    passage = " ".join(f"p{i}" for i in range(75))
    texts = [f"{' '.join(rng.choice('abcdefgh') for _ in range(rng.randrange(40)))} {passage} {i} {passage[:200]}" for i in range(30)]
    texts += corpus(31, 25)
    rows = [*enumerate(texts), (None, passage), (3, passage + " other"), (3, passage + " other")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    key = lambda df: sorted(((r.row.doc_id, r.words, r.removed, r.kept) for r in df.collect()), key=str)
    got = key(substrings.without_repeats(docs, shard_words=shard_words, most=most))
    assert got == key(substrings.without_repeats(docs)) and sum(x[2] > 0 for x in got) > 20


def test_id_filter_is_sized_by_its_keys(spark):
    from perfmart.llm import sketch
    for n, least_bits in ((10, 16), (300_000, 22)):
        ids = spark.range(n).select((F.col("id") * 7 - 1000).alias("id"))
        test = sketch.id_filter(ids)
        assert test(np.arange(n) * 7 - 1000).all()
        assert test(np.arange(10 ** 6) * 7 - 999).mean() < 0.05
        assert sketch.id_filter(ids, least_bits) is None or n * sketch.KEY_BITS <= 1 << least_bits
    docs = spark.range(50).select(F.col("id"), F.lit("x").alias("n"))
    gone = spark.createDataFrame([(3,), (4,), (99,)], "id long")
    want = [i for i in range(50) if i not in (3, 4)]
    for bits in (29, 0):  # by the filter, by a join
        sketch.FILTER_BITS, old = bits, sketch.FILTER_BITS
        try:
            sketch.id_filter.__defaults__ = (bits,)
            assert sorted(r.id for r in sketch.without_ids(docs, "id", gone).collect()) == want
        finally:
            sketch.FILTER_BITS = old
            sketch.id_filter.__defaults__ = (old,)


def test_an_id_with_two_texts(spark):
    """Links of both texts count; as rows they are judged one by one."""
    from perfmart.llm import ngram_join
    rng = random.Random(5)
    a, b, c = (" ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(60)) for _ in range(3))
    rows = [(1, a), (2, a + " more"), (2, b), (3, b + " more"), (4, c), (5, None), (5, c + " more"), (6, "alone"), (None, b)]
    docs = spark.createDataFrame(rows, "id long, text string")
    found = {(r.id, r.n > 0): r.component for r in ngram_join.linked_components(docs, 5, 80).collect()}
    assert found == {(1, True): 1, (2, True): 1, (3, True): 1, (4, True): 4, (5, False): 4, (5, True): 4, (6, True): 6, (None, True): 1}
    rows = {(r.id, r.n, r.component, r.first) for r in ngram_join.linked_rows(docs, 5, 80, one_node=False).collect()}
    assert rows == {(1, 56, 1, True), (2, 57, 1, False), (2, 56, 2, True), (3, 57, 2, False), (4, 56, 4, True), (5, 0, 5, True),
                    (5, 57, 4, False), (6, 1, 6, True), (None, 56, 2, None)}


def test_texts_without_common_words_have_anchors_all_along(spark):
    """Tables, word lists and code: their near copies are alike, others that
    begin like them are not."""
    rng = random.Random(12)
    words = lambda n: " | ".join("".join(rng.choice("bcdfgkz") for _ in range(6)) for _ in range(n))
    base = words(400)
    parts = base.split(" | ")
    edited = " | ".join([*parts[:300], *words(100).split(" | ")])
    other = " | ".join([*parts[:3], *words(397).split(" | ")])
    docs = spark.createDataFrame([(1, base, edited), (2, base, other)], "doc_id long, a string, b string")
    near, far = [r.l for r in spotsigs.signatures(spotsigs.signatures(docs, "a", "s"), "b", "t").select(
        "doc_id", spotsigs.likeness(F.col("s"), F.col("t")).alias("l")).orderBy("doc_id").collect()]
    assert 0.45 < near < 0.75 and far < 0.1


def test_sketch_sends_little_and_adds_exactly(spark):
    import zlib

    from perfmart.llm import sketch

    rng = np.random.default_rng(3)
    sparse = np.bincount(rng.integers(0, 1 << 16, 20_000), minlength=1 << 16)
    sparse[5] = 70_000
    assert len(sketch.packed(sparse)) < 0.5 * len(zlib.compress(sparse.astype("<u8").tobytes(), 1))
    for c in (sparse, np.array([1 << 40, 0, 3]), np.zeros(4, np.int64), np.array([255, 256]), np.array([255])):
        assert sketch.unpacked(sketch.packed(c)).tolist() == c.tolist()

    rows = spark.range(0, 4000, 1, 20).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") * 7919).alias("h"))

    def make():
        return lambda batch: iter([batch.column(0).to_numpy().astype(np.uint64)])

    level = sketch.count_sketch(rows, make, 17)
    want = np.bincount([r.h % (1 << 17) for r in rows.collect()], minlength=1 << 17)
    assert (level == np.where(want > 0, 1 + np.floor(4 * np.log2(np.maximum(want, 1))), 0)).all()
