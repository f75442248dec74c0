"""The sketched key check equals the plain one, and shuffles little."""

import pytest
from conftest import SF_SMALL, rows
from pyspark.sql import functions as F
from test_plans import plan_text

from lendlayer.operators import keys as K
from lendlayer.operators.keys import key_check_sketched, suspect_rows, suspects
from lendlayer.operators.quality import key_check
from lendlayer.plans.views import repayment_view


def frame(spark, n=20_000):
    k = F.col("id")
    key = F.when(k % 3 == 0, F.lit("hot")).when(k % 1000 == 1, F.lit(None)).otherwise(F.concat(F.lit("k"), (k % 19_990).cast("string")))
    return spark.range(n, numPartitions=4).select(key.alias("odd name"), (k % 3 == 1).cast("int").alias("part"), F.when(k % 1000 == 1, None).otherwise("x").alias("p"))


@pytest.mark.parametrize("keys", [["odd name"], ["odd name", "part"], ["p", "odd name"]])
def test_same_as_plain(spark, keys):
    df = frame(spark)
    assert rows(key_check_sketched(df, keys)) == rows(key_check(df, keys))
    assert rows(key_check_sketched(df.limit(0), keys)) == []


def test_colliding_positions_and_small_gathers(spark, monkeypatch):
    """One part of few positions, sent in many pieces: more suspects, the same result."""
    monkeypatch.setattr(K, "_place", lambda keys, parts, real=K._place: [F.lit(0).alias(K._PART), (real(keys, parts)[1] % 97).alias(K._POSITION)])
    df = frame(spark, 3000)
    assert suspects(df, ["odd name"]).count() == 97
    assert rows(key_check_sketched(df, ["odd name"])) == rows(key_check(df, ["odd name"]))


def test_many_suspects_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(K, "BROADCAST_ROWS", 5)
    df = repayment_view(spark, SF_SMALL)
    keys = ["loan_id", "emi_number"]
    assert suspect_rows(df.select(*keys), keys) is None
    assert rows(key_check_sketched(df, keys)) == rows(key_check(df, keys))


def test_shuffled_rows_are_in_proportion_to_suspects(spark):
    n = 50_000
    df = spark.range(n, numPartitions=4).select(F.when(F.col("id") < 20, 7).otherwise(F.col("id")).alias("k"))
    assert suspects(df, ["k"], 4).count() < 10  # one repeated key, hardly a chance collision
    assert suspect_rows(df, ["k"], 4).count() < 30
    packed = df.select(*K._place(["k"], 4)).mapInArrow(K._gather, "part int, positions binary, twice binary")
    assert packed.count() == 4 * 4  # rows sent by the first pass: tasks x parts
    text = plan_text(key_check_sketched(df, ["k"], 4), "simple")
    assert text.count("Exchange hashpartitioning") == 1 and "BroadcastHashJoin" in text
