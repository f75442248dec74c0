"""The command line runs ingest -> silver -> gold in one application."""

import os
import uuid

import samples
from lendlayer.__main__ import main


def test_cli_run_with_ingest(spark, tmp_dir, capsys):
    path = os.path.join(tmp_dir, "customer_metadata.csv")
    with open(path, "w", newline="") as fh:
        fh.write(samples.CUSTOMER_CSV)
    prefix = f"cli{uuid.uuid4().hex[:6]}_"
    code = main(["run", "--prefix", prefix, "--location", f"{tmp_dir}/lake", "--tables", "customer_metadata",
                 "--ingest", f"customer_metadata={path}", "--as-of", "2026-01-01", "--preview", "2"])
    assert code == 0
    out = capsys.readouterr().out
    assert "customer_metadata_cleaned" in out and "failed" not in out
    assert "customer_metadata_cleaned_gold" in out  # the gold table listing
    assert "default_flag" in out  # the landing preview shows the bronze columns
    assert spark.table(f"{prefix}gold.customer_metadata_cleaned_gold").count() == 4
    assert main(["silver", "--prefix", prefix, "--location", f"{tmp_dir}/lake", "--tables", "nope"]) == 1


def test_cli_seed_nulls_and_manifest(spark, tmp_dir, capsys):
    rows = os.path.join(tmp_dir, "collateral.csv")
    with open(rows, "w") as fh:
        fh.write("collateral_id,valuation,insurance_expiry\nC1,1200.5,2027-01-01\nC2,88,\n")
    manifest = os.path.join(tmp_dir, "tables.ini")
    with open(manifest, "w") as fh:
        fh.write("[tables]\nraw = loan_collateral\ncleaned=\n")
    prefix = f"seed{uuid.uuid4().hex[:6]}_"
    common = ["--prefix", prefix, "--location", f"{tmp_dir}/seedlake", "--catalog", "spark_catalog"]
    assert main(["seed", *common, "--table", "loan_collateral", "--path", rows]) == 0
    seeded = spark.table(f"{prefix}bronze.loan_collateral")
    assert [r.valuation for r in seeded.orderBy("collateral_id").collect()] == [1200.5, 88.0] and len(seeded.columns) == 11
    assert main(["nulls", *common, "--manifest", manifest]) == 0
    assert spark.table(f"{prefix}silver.loan_collateral_complete").count() == 1
    assert main(["silver", *common, "--manifest", manifest]) == 0
    assert spark.table(f"{prefix}silver.loan_collateral_cleaned").count() == 2
    assert main(["seed", *common, "--table", "loan_collateral", "--path", f"{tmp_dir}/none.csv"]) == 1
