"""The command line runs the jobs from a per-market config."""

import json
from datetime import date

from factkeeper import cli
from factkeeper.plans import testmodel as tm

SF = "/root/testdata/sf0.001"


def test_cli_sync_export_count(spark, tmp_path):
    stg = tm.staging(spark, SF)
    src, tgt = str(tmp_path / "src"), str(tmp_path / "tgt")
    stg.write.parquet(src)
    old = stg.filter(stg.txn_date < date(2024, 1, 28))
    old.write.partitionBy("txn_date").parquet(tgt)
    cfg = tmp_path / "sync.json"
    cfg.write_text(json.dumps({"date_column": "txn_date", "filter_column": "line",
                               "line_filter_mode": "specific", "line_values": ["L1"], "days_back": 3}))
    out = cli.main(["sync-recent", "--config", str(cfg), "--source", src, "--target", tgt,
                    "--as-of", "2024-01-31"], spark=spark)
    expect = stg.filter((stg.line == "L1") & (stg.txn_date >= date(2024, 1, 28))).count()
    assert out["rows"] == expect
    assert spark.read.parquet(tgt).count() == old.count() + expect
    exp = cli.main(["export-table", "--source", src, "--out", str(tmp_path / "csv")], spark=spark)
    counted = cli.main(["count-csv", "--path", exp["path"]], spark=spark)
    assert counted["rows"] == stg.count()
    rep = cli.main(["kpi-report", "--source", src, "--out", str(tmp_path / "rep"), "--as-of", "2024-01-31"],
                   spark=spark)
    assert spark.read.option("header", True).csv(rep["path"]).count() > 0


def test_cli_maintain(spark, tmp_path):
    from pyspark.sql import functions as F
    from factkeeper.operators.rewrite import SERVING_MAPPING
    stg = tm.staging(spark, SF)
    serving = str(tmp_path / "serving")
    stg.select(*[F.col(s).alias(t) for s, t in SERVING_MAPPING], "user_unique").write.parquet(serving)
    out = cli.main(["maintain", "--bands", '[["BRONZE", 0.01, 500], ["GOLD", 500, 1e18]]', "--serving", serving, "--root", str(tmp_path / "views"),
                    "--market", "myr", "--short-key", "1", "--as-of", "2024-02-01"], spark=spark)
    assert set(out["steps"].values()) == {"OK"} and "retention_monthly" in out["steps"]
