"""The pipeline row by row on a small table with a hot source, a rare one, nulls and copies; and scores in plain Python."""

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from lendlayer.llm.op7_toxicity import score_toxicity
from lendlayer.llm.op8_quality_rules import BUCKETS, SMOOTHING, THRESHOLD, judge_quality, ngram_buckets
from lendlayer.llm.oracle import OP2
from lendlayer.llm.textkit import Texts, words

DDL = "doc_id long, text string, lang string, source string, n_chars long"


def words_of(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    rng = random.Random(12)
    root = str(tmp_path_factory.mktemp("pipeline"))
    vocab = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 8))) for _ in range(400)]
    say = lambda n: " ".join(rng.choices(vocab, k=n))
    rows, labels = [], []
    for i in range(240):
        text = say(rng.randint(20, 120))
        toxic = i % 12 == 5
        if toxic:
            text += " vilest scum vermin " + say(5)
        rows.append((i, text, rng.choice(["en", "de", None]), "hot" if i % 3 else rng.choice(["a", "b", None]), len(text)))
        labels.append((i, 1, int(toxic)))
    clean = [r for r in rows if r[0] % 12 != 5]
    for i in range(40):
        old = clean[i]
        rows.append((1000 + i, old[1].replace(" ", "  \n"), "en", "hot", 1))
        changed = old[1].split(" ")
        changed[0] = "changed"
        rows.append((2000 + i, " ".join(changed), "en", "copies", 1))
    rows += [(3000, None, None, None, None), (3001, "", "en", "rare", 0), (3002, "one", "xx", "rare", 3), (None, say(30), "en", "a", 1), (3003, say(9000), "en", "long", 1)]
    spark.createDataFrame(rows, DDL).repartition(3).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    return root


def rows_of(df):
    return sorted((tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()), key=str)


def near_copies(rows, k=5):
    sets = []
    for r in rows:
        w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in words_of(r[1])]
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set()))
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and rows[i][0] is not None and rows[j][0] is not None and 100 * both >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)), key=lambda x: rows[x][0])
                parent[b] = a
    return [find(i) == i for i in range(len(rows))]


def test_every_stage(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "exact_dedup", "minhash_near_dedup", "mixing", "packing"]

    scored = score_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    bad = {r.doc_id for r in scored.collect() if r.predicted}
    assert {i for i in range(240) if i % 12 == 5} <= bad and len(bad) <= 22
    now = rows_of(stages["toxicity"](spark, docs, sf_dir))
    assert now == [r for r in rows_of(docs) if r[0] not in bad]

    def as_docs(rows):
        return spark.createDataFrame(rows, DDL).repartition(3)

    groups = {}
    for r in now:
        groups.setdefault(re.sub("[\x20\x09-\x0d]+", " ", r[1] or ""), []).append(r)
    expected = sorted((min(g, key=lambda r: (r[0] is None, r[0] or 0)) for g in groups.values()), key=str)
    now = rows_of(stages["exact_dedup"](spark, as_docs(now), sf_dir))
    assert now == expected

    expected = [r for r, stays in zip(now, near_copies(now)) if stays]
    now = rows_of(stages["minhash_near_dedup"](spark, as_docs(now), sf_dir))
    assert now == expected and len([r for r in now if (r[0] or 0) >= 2000]) < 10

    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", now)
    got = con.execute(OP2)
    names = [d[0] for d in got.description]
    sampled = {r[names.index("doc_id")]: r[names.index("sampled")] for r in got.fetchall()}
    expected = [r for r in now if sampled[r[0]]]
    now = rows_of(stages["mixing"](spark, as_docs(now), sf_dir))
    assert now == expected and 0 < len(now) < len(sampled)

    coder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    sizes = {r[0]: len(coder.encode(r[1] or "", add_special_tokens=False).ids) + 1 for r in now}
    packed = stages["packing"](spark, as_docs(now), sf_dir).toPandas()
    total = Counter()
    for d, n in zip(packed.doc_id.astype(object).where(packed.doc_id.notna(), None), packed.length):
        total[None if d is None else int(d)] += n
    assert dict(total) == sizes
    bins = packed.groupby("sequence_id").length.sum()
    assert (bins <= 2048).all() and len(bins) >= math.ceil(sum(sizes.values()) / 2048)


def test_run_is_the_stages_in_a_row(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(rows_of(stage(spark, docs, sf_dir)), DDL)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    every = lambda df: sorted((tuple(r) for r in df.select(*key).collect()), key=str)
    got = corpus_pipeline.run(spark, sf_dir)
    assert every(got) == every(packed) and got.count() > 0


def test_likelihood_ratio_in_plain_python(spark):
    rng = random.Random(2)
    good, other = ([f"{p}{i}" for i in range(60)] for p in ("g", "o"))
    rows = [(i, " ".join(rng.choices(good if i % 2 else other, k=rng.choice([0, 3, 60, 90])))) for i in range(120)] + [(None, " ".join(good)), (500, None), (500, "x " * 80)]
    labels = [(i, i % 2) for i in range(0, 100)] + [(None, 1), (77, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {(r.doc_id, r.n_words): (round(r.score, 9), r.kept) for r in judge_quality(docs, spark.createDataFrame(labels, "doc_id long, quality int")).collect()}

    def buckets(text):
        raw = np.frombuffer((text or "").encode(), np.uint8)
        texts = Texts(0, raw, np.array([0, len(raw)]))
        return ngram_buckets(texts, words(texts))[0].tolist()

    trusted = {d for d, q in labels if q == 1 and d is not None}
    raw, target = Counter(), Counter()
    for d, t in rows:
        raw.update(buckets(t))
        if d in trusted:
            target.update(buckets(t))
    sums = [sum(c.values()) + SMOOTHING * BUCKETS for c in (target, raw)]
    for d, t in rows:
        grams = buckets(t)
        score = sum(math.log((target[g] + SMOOTHING) / sums[0]) - math.log((raw[g] + SMOOTHING) / sums[1]) for g in grams) / max(len(grams), 1)
        w = words_of(t)
        covered = set()
        triples = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        for i in range(len(w) - 2):
            if triples[tuple(w[i : i + 3])] > 1:
                covered.update((i, i + 1, i + 2))
        failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
        assert got[d, len(w)][0] == pytest.approx(score, abs=1e-6), (d, len(w))
        assert got[d, len(w)][1] == (not failed and score >= THRESHOLD)
