"""The registered SQL of the operators against their queries, on small odd tables."""

import os
import random

import duckdb
import pytest

from lendlayer.llm.oracle import ORACLE
from lendlayer.llm.queries import QUERIES


def norm(v):
    return float(f"{v:.9g}") if isinstance(v, float) else v


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = random.Random(5)
    root = str(tmp_path_factory.mktemp("odd"))
    words = ["a\\b", "<|x", "don't", "É", "日本"] + ["".join(rng.choices("abcdefgh", k=rng.randint(1, 9))) for _ in range(60)]
    say = lambda n: " ".join(rng.choices(words, k=n))
    docs = [(i, say(rng.randint(0, 30)), rng.choice(["en", "de"]), rng.choice(["web", "web", "books"]), 1) for i in range(80)]
    docs += [(100 + i, docs[i][1], "en", "web", 1) for i in range(20)]
    docs += [(200 + i, docs[3 + i][1] + " more words", "fr", "rare", 1) for i in range(6)]
    docs += [(300, None, None, None, None), (301, "", "en", None, 0), (302, " \n", None, "web", 1), (303, "one", "xx", "only", 3)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{root}/documents.parquet")
    turns = []
    for c in range(40):
        texts = [rng.choice(["", "\\", "\\\\|", "<|im_end|>", "<\\|", "a\\nb", "x\ny", say(rng.randint(0, 400))]) for _ in range(rng.randint(1, 9))]
        turns += [(c, t, rng.choice(["system", "user", "assistant", "to\nol", "r\\n"]) if t else "system", x) for t, x in enumerate(texts)]
    turns += [(900, 0, "user", None), (900, 1, "assistant", "\\<|"), (901, 0, None, "x")]
    spark.createDataFrame(turns, "conv_id long, turn int, role string, text string").write.parquet(f"{root}/conversations.parquet")
    vectors = [(i, [rng.gauss(0, 0.3) for _ in range(32)], rng.choice([1, 2, None])) for i in range(150)]
    vectors += [(500, None, 1), (501, [float("nan")] * 32, 1), (502, vectors[4][1], 7)]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int").write.parquet(f"{root}/embeddings.parquet")
    return root


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, tables, name):
    con = duckdb.connect()
    for t in os.listdir(tables):
        con.execute(f"CREATE VIEW {t.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{tables}/{t}/*.parquet')")
    df = QUERIES[name](spark, tables)
    order = sorted(df.columns)
    want = con.execute(ORACLE[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == order
    expected = sorted((tuple(norm(r[names.index(c)]) for c in order) for r in want.fetchall()), key=str)
    assert sorted((tuple(norm(r[c]) for c in order) for r in df.collect()), key=str) == expected
