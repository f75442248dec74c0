"""Loan-shaped views over the star-schema test tables.

The test tables hold no nulls and no bad ids, so dirt is injected by fixed key
arithmetic (the same definitions the SQL oracle uses as CTEs):

* ``branch``    nation x region, 4 rows outside the employee / volume limits
* ``borrower``  customer, with null / malformed ids, null and out-of-range ages,
                padded names, out-of-range incomes and scores, long industry codes
* ``officer``   supplier, ids carrying the ``O`` prefix
* ``loan``      orders, with null borrowers and due dates
* ``repayment`` lineitem, every line of each 20th order present twice (exact copies)

Each view reads only the columns it needs (the scan's ReadSchema is pruned).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# Columns and types of the test tables.
TABLE_DDL = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "orders": (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
        "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
    ),
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
        "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
        "l_shipdate TIMESTAMP_NTZ"
    ),
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The scan of one test table, with its declared schema (no job reads footers to infer it)."""
    return spark.read.schema(TABLE_DDL[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _code(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), _s(number))


def branch_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    n = F.col("n_nationkey")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        _code("BR", 100 + n).alias("branch_id"),
        F.col("n_name").alias("branch_name"),
        F.col("r_name").alias("region"),
        F.when(n == 3, 0).when(n == 4, 1500).otherwise(10 + n).cast("int").alias("employee_count"),
        F.when(n == 5, 500)
        .when(n == 6, 2000000000)
        .otherwise(1000000 * (1 + n))
        .cast("double")
        .alias("loan_volume"),
    )


def borrower_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("c_custkey")
    return read_table(spark, sf_dir, "customer").select(
        F.when(c % 50 == 7, F.lit(None).cast("string"))
        .when(c % 50 == 11, _code("X", c))
        .otherwise(F.concat(F.lit("B"), F.lpad(_s(c), 6, "0")))
        .alias("borrower_id"),
        F.concat(F.lit("  "), F.col("c_name"), F.lit(" ")).alias("full_name"),
        F.when(c % 60 == 13, F.concat(F.lit("BR"), _s("c_nationkey"), F.lit("Z")))
        .otherwise(_code("BR", 100 + F.col("c_nationkey")))
        .alias("branch_id"),
        F.when(c % 40 == 3, F.lit(None)).otherwise(15 + c % 95).cast("int").alias("age"),
        (F.col("c_acctbal") * 1100).cast("double").alias("income"),
        (250 + (c * 7) % 700).cast("int").alias("credit_score"),
        F.when(c % 30 == 0, F.lit("1234567")).otherwise(F.lit("6201")).alias("industry_code"),
    )


def officer_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "supplier").select(
        _code("O", 100 + F.col("s_suppkey")).alias("officer_id"),
        F.col("s_name").alias("full_name"),
        _code("BR", 100 + F.col("s_nationkey")).alias("branch_id"),
    )


def loan_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = F.col("o_orderkey")
    issue = F.col("o_orderdate").cast("date")
    return read_table(spark, sf_dir, "orders").select(
        _code("L", o).alias("loan_id"),
        F.when(o % 90 == 1, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("B"), F.lpad(_s("o_custkey"), 6, "0")))
        .alias("borrower_id"),
        _code("BR", 100 + F.col("o_custkey") % 30).alias("branch_id"),
        F.col("o_totalprice").alias("loan_amount"),
        F.when(o % 2 == 0, F.lit(83.2)).otherwise(F.lit(1.0)).cast("double").alias("exchange_rate"),
        (500 + o % 400).cast("int").alias("interest_rate_bps"),
        (1 + o % 10).cast("int").alias("tenure_years"),
        issue.alias("issue_date"),
        F.when(o % 70 == 2, F.lit(None).cast("date"))
        .otherwise(F.date_add(issue, (365 * (1 + o % 10)).cast("int")))
        .alias("due_date"),
    )


def repayment_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scan of lineitem; the copies come from a generator, not a second scan."""
    line = F.col("l_linenumber")
    even = line % 2 == 0
    copies = F.when(F.col("l_orderkey") % 20 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return (
        read_table(spark, sf_dir, "lineitem")
        .select("l_orderkey", "l_suppkey", "l_linenumber", "l_shipdate", "l_extendedprice")
        .withColumn("_copy", F.explode(copies))
        .select(
            _code("L", "l_orderkey").alias("loan_id"),
            _code("O", 100 + F.col("l_suppkey")).alias("officer_id"),
            line.alias("emi_number"),
            F.col("l_shipdate").cast("date").alias("payment_date"),
            F.when(line == 7, 250)
            .when(line == 6, 0)
            .when(even, 120)
            .otherwise(1)
            .cast("double")
            .alias("exchange_rate"),
            (F.col("l_extendedprice") * F.when(even, 120).otherwise(1)).cast("double").alias("amount_in_inr"),
        )
    )


def unparsed_officer_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Officers of whom some have ids that are no integers, or none that fits."""
    k = F.col("s_suppkey")
    officer_id = F.when(k % 10 == 3, _code("EMP", k)).when(k % 10 == 7, _code("O99999", 10000 + k)).otherwise(_code("O", 100 + k))
    return read_table(spark, sf_dir, "supplier").select(
        officer_id.alias("officer_id"), F.col("s_name").alias("full_name"), _code("BR", 100 + F.col("s_nationkey")).alias("branch_id")
    )


def hot_loan_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repayments of which a third belong to one loan."""
    hot = F.col("l_orderkey") % 3 == 0
    return read_table(spark, sf_dir, "lineitem").select(
        F.when(hot, F.lit("L0")).otherwise(_code("L", "l_orderkey")).alias("loan_id"),
        F.col("l_linenumber").alias("emi_number"), F.col("l_extendedprice").cast("double").alias("amount_in_inr"),
    )


VIEWS = {
    "branch": branch_view,
    "borrower": borrower_view,
    "officer": officer_view,
    "loan": loan_view,
    "repayment": repayment_view,
}
