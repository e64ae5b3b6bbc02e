"""The whole pipeline, its resumption, calibration runs and the command line."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark import cli
from tidemark import config as c
from tidemark.adapters import table, ticks
from tidemark.plans import backfill as P
from tidemark.sources import datasource


@pytest.fixture(scope="module")
def source(spark, sf):
    return ticks(table(spark, sf, "events"))


@pytest.fixture(scope="module")
def root(spark, source, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("backfill"))
    verdicts = P.run(spark, source, path, P.Settings(cycle_ms=60_000, bar_ms=1_800_000)).collect()
    assert len(verdicts) == 5 and all(r["rows"] > 0 for r in verdicts)
    return path


def test_stages(spark, root):
    bars = spark.read.parquet(f"{root}/bars")
    assert bars.groupBy("ticker_id").agg((F.max("open_ts_ms") - F.min("open_ts_ms") == 1_800_000 * (F.count("*") - 1)).alias("whole")).where("not whole").count() == 0
    assert spark.read.parquet(f"{root}/renko").count() > 0 and spark.read.parquet(f"{root}/vol").where("sigma_pct is null").count() == 0


def test_resume_skips_whole_stages_only(spark, source, root):
    before = spark.read.parquet(f"{root}/renko").select(F.input_file_name()).distinct().collect()
    P.run(spark, source, root, P.Settings(cycle_ms=60_000, bar_ms=1_800_000), resume=True)
    assert sorted(before) == sorted(spark.read.parquet(f"{root}/renko").select(F.input_file_name()).distinct().collect())


def test_calibration_run_resumes(spark, root, tmp_path):
    comp = spark.read.parquet(f"{root}/merge").drop("date")
    from tidemark.operators.merge import sigma_lookup

    p = P.with_mid(sigma_lookup(comp, spark.read.parquet(f"{root}/vol"))).cache()
    s, store = c.Calibration(target=20.0, min_pct=1e-4, clamp_limit=0.9), str(tmp_path / "k")
    roster = p.select("ticker_id").distinct()
    first = P.calibration_run(spark, p, roster.where("ticker_id < 3"), store, "a", s).count()
    every = {r["ticker_id"]: r["k"] for r in P.calibration_run(spark, p, roster, store, "a", s, {4: 0.25}).collect()}
    assert first == 2 and len(every) == 5 and every[4] == 0.25
    assert P.drift_gate(p, 5, s).count() == 5


def test_command_line(spark, root, tmp_path, capsys):
    assert cli.main(["s10-from-idx", "--input", f"{root}/merge", "--output", str(tmp_path / "bars"), "--bucket-ms", "1800000"]) == 0
    assert spark.read.parquet(str(tmp_path / "bars")).count() == spark.read.parquet(f"{root}/bars").count()
    assert cli.main(["integrity-check", "--input", str(tmp_path / "bars"), "--kind", "s10", "--bucket-ms", "1800000", "--report", str(tmp_path / "report")]) in (0, 1)
    assert cli.main(["glue-check", "--input", f"{root}/merge"]) == 1
    assert cli.main(["resample-idx", "--input", f"{root}/merge", "--target-ms", "120000"]) == 0
    assert cli.main(["migrate-phantom-ids", "--input", f"{root}/merge", "--output", str(tmp_path / "ids"), "--map", json.dumps({"1": 11})]) == 0
    assert spark.read.parquet(str(tmp_path / "ids")).where("ticker_id = 11").count() > 0
    with pytest.raises(SystemExit):
        cli.main(["no-such-command"])
    assert len(cli.COMMANDS) == 22


def test_data_source(spark):
    datasource.register(spark)
    df = spark.read.format("tidemark_synthetic").option("tickers", 3).option("steps", 50).load()
    assert df.count() == 150 and df.where("ask <= bid").count() == 0
    assert sorted(map(str, df.collect())) == sorted(map(str, df.collect()))
