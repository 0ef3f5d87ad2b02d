"""The command line end to end: generate CSVs, then load + build + publish."""

import json

from ledgerline.__main__ import main


def test_generate_then_run(spark, scratch, capsys):
    csv_dir = f"{scratch}/csv"
    assert main(["generate", "--out", csv_dir, "--customers", "60", "--orders", "300",
                 "--as-of", "2025-01-01"], spark=spark) == 0
    capsys.readouterr()
    code = main(["run", "--csv-dir", csv_dir, "--root", f"{scratch}/wh", "--as-of", "2025-01-01",
                 "--tags", "core,cohorts"], spark=spark)
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert code == 0 and out["published"] and out["failed_checks"] == 0
    assert set(out["tables"]) == {"dim_customers", "fct_daily_sales", "customer_cohorts"}
    assert spark.table("ledger_raw.orders").count() == 300
    assert spark.table("ledger_marts.dim_customers").count() == 60
