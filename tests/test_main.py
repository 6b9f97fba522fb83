from frames import RUNS, tables
from shopfloor.__main__ import main
from shopfloor.sinks.files import read_extract_csv


def test_whole_job(spark, tmp_path, capsys):
    for name, df in tables(spark).items():
        df.write.parquet(str(tmp_path / "in" / name))
    out = str(tmp_path / "out")
    assert main(["--parquet", str(tmp_path / "in"), "--out", out, "--as-of", "2024-02-01"]) == 0
    assert read_extract_csv(spark, out + "/extract").count() == 6
    assert spark.read.parquet(out + "/reports/efficiency_rank_top20").count() > 0
    audit = {r["query"]: r for r in spark.read.parquet(out + "/audit").collect()}
    assert audit["run_extract"]["rows"] == 6 and all(r["status"] == "success" for r in audit.values())
    printed = capsys.readouterr().out
    assert "efficiency_rank_top20" in printed and "success" in printed and "error" not in printed


def test_empty_extract_fails_the_job(spark, tmp_path):
    none_active = tables(spark, production_runs=[RUNS[5], RUNS[6]])
    for name, df in none_active.items():
        df.write.parquet(str(tmp_path / "in" / name))
    assert main(["--parquet", str(tmp_path / "in"), "--out", str(tmp_path / "out")]) == 1
    assert not (tmp_path / "out" / "extract").exists()


def test_failed_step_fails_the_job(spark, tmp_path, monkeypatch):
    def broken(name, tables):
        raise ValueError("broken")

    for name, df in tables(spark).items():
        df.write.parquet(str(tmp_path / "in" / name))
    monkeypatch.setattr("shopfloor.__main__.run_named", broken)
    assert main(["--parquet", str(tmp_path / "in"), "--out", str(tmp_path / "out")]) == 1


def test_equipment_without_an_id(spark, tmp_path):
    for name, df in tables(spark).items():
        (df.drop("equipment_id") if name == "equipment" else df).write.parquet(str(tmp_path / "in" / name))
    out = str(tmp_path / "out")
    assert main(["--parquet", str(tmp_path / "in"), "--out", out, "--as-of", "2024-02-01"]) == 0
    assert read_extract_csv(spark, out + "/extract").count() == 6
