"""The pipeline against a run by hand of its stages."""

import random

from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.conftest import BENCHMARK, DOCUMENTS, documents
from tests.llm.test_queries import space_words, spoken


def test_stages_keep_what_brute_force_keeps(spark, tables):
    rng = random.Random(7)
    passage, item = spoken("aa", rng, 60), spoken("aa", rng, 30)
    texts = [spoken(rng.choice(["aa", "bb", "cc"]), rng, rng.choice([20, 60, 150])) for _ in range(40)]
    texts += [None, "", "12 34", texts[3], texts[4] + " extra", texts[5] + " " + passage, passage + "\n " + texts[6] + " tail end",
              item, spoken("bb", rng, 80) + " " + item, spoken("cc", rng, 3000) + " " + item]
    folder = tables(documents=(DOCUMENTS, documents(texts, {1: None})), benchmark=(BENCHMARK, [(1, item)]))
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns, name
        docs = spark.createDataFrame(out.collect(), out.schema)
        kept.append({r.doc_id: r for r in docs.collect()})
    known = {i for i, t in enumerate(texts) if any(c.isalpha() for c in t or "")}
    assert set(kept[0]) == known

    def shingles(t):
        w = space_words(t, lower=True)
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)}

    sets = {i: shingles(texts[i]) for i in known}
    gone = {b for a in known for b in known if a < b and len(sets[a] & sets[b]) * 100 >= 80 * len(sets[a] | sets[b])}
    assert set(kept[1]) == known - gone and gone
    assert space_words(kept[2][46].text) == space_words(texts[6] + " tail end")[-len(space_words(kept[2][46].text)):]
    assert set(kept[2]) - set(kept[3]) == {47, 48} - (known - set(kept[2]))
    assert all(r.n_chars == len(r.text) for r in kept[3].values())
    last = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert {r.doc_id for r in last.collect()} == set(kept[3])
    assert {r.doc_id: r.ids_sha256 for r in corpus_pipeline.run(spark, folder).collect()} == {
        r.doc_id: r.ids_sha256 for r in last.collect()}
    assert last.where(F.col("n_tokens") < 2).count() == 0


def test_empty_documents(spark, tables):
    folder = tables(documents=(DOCUMENTS, []), benchmark=(BENCHMARK, []))
    assert corpus_pipeline.run(spark, folder).collect() == []


def test_null_and_repeated_ids(spark, tables):
    """Rows are judged one by one; an unrelated text under a repeated id stays."""
    rng = random.Random(8)
    a, b, c = (spoken("aa", rng, 60) for _ in range(3))
    rows = [(1, a, "en", "s", 1), (2, a + " more", "en", "s", 1), (2, b, "en", "s", 1), (3, b + " more", "en", "s", 1), (4, c, "en", "s", 1),
            (4, c, "en", "s", 1), (None, spoken("aa", rng, 30), None, None, None), (5, None, "en", "s", 0), (None, None, None, None, None)]
    folder = tables(documents=(DOCUMENTS, rows), benchmark=(BENCHMARK, [(None, "x"), (1, None)]))
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = dict(corpus_pipeline.STAGES)["near_copies"](spark, docs, folder)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == sorted(
        (r[0] or 0, r[1] or "") for i, r in enumerate(rows) if i not in (1, 3))
    assert sorted(r.doc_id or 0 for r in corpus_pipeline.run(spark, folder).collect()) == [0, 1, 2, 4, 4]
