import uuid

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

#: Columns whose names could clash with those that operators add.
EXTRA = {"row": "r", "words": 1, "id": 2, "n": 3, "score": 0.5, "spans": "s", "tag": 4, "bucket": 5}


@pytest.fixture
def tables(tmp_path):
    """Writes small tables and returns their folder."""
    def write(**frames):
        top = tmp_path / uuid.uuid4().hex[:8]
        top.mkdir()
        for name, (schema, rows) in frames.items():
            columns = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
            data = {c: pa.array(list(v), t) for (c, t), v in zip(schema, columns, strict=True)}
            for c, v in EXTRA.items():
                if c not in data:
                    data[c] = pa.array([v] * len(rows))
            pq.write_table(pa.table(data), top / f"{name}.parquet")
        return str(top)
    return write


DOCUMENTS = [("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64())]
BENCHMARK = [("item_id", pa.int64()), ("text", pa.string())]
LABELS = [("doc_id", pa.int64()), ("quality", pa.int32()), ("toxic", pa.int32())]
CONVERSATIONS = [("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())]
PAGES = [("page_id", pa.int64()), ("url", pa.string()), ("html", pa.string())]


def documents(texts, langs=None, first=0):
    return [(first + i, t, (langs or {}).get(i, "en"), "s", len(t or "")) for i, t in enumerate(texts)]


def corpus(seed=3, n=60):
    """Texts with nulls, empty ones, copies, near copies, shared passages and one long text."""
    import random
    rng = random.Random(seed)
    vocabulary = ["The", "of", "and", "to", "in", *["".join(rng.choice("abcdefghinorst") for _ in range(rng.randint(2, 7))) for _ in range(400)],
                  "Éa", "ñu", "straße", "日本", "x1"]

    def text(size):
        return "".join(rng.choice(vocabulary) + rng.choice([" ", " ", " ", "  ", "\n", "\t", ", ", ". "]) for _ in range(size))

    passage = text(70)
    out = [None, "", " \n\t ", "!!! ...", "one", "two words", "a  b", passage, text(9000)]
    for _ in range(n):
        kind = rng.random()
        base = text(rng.choice([5, 12, 49, 50, 51, 90, 200, 400]))
        if kind < 0.15:
            base = rng.choice([t for t in out if t])
        elif kind < 0.4:
            words = rng.choice([t for t in out if t and len(t) < 5000]).split(" ")
            words[rng.randrange(len(words))] = "changed"
            base = " ".join(words)
        elif kind < 0.6:
            base = base + passage + text(20)
        out.append(base)
    return out
