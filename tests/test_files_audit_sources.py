import datetime
import glob

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from frames import AS_OF, d, keyed, tables
from shopfloor import schemas
from shopfloor.audit import AuditedRunner, sql
from shopfloor.catalog import QUERIES, run_named
import generate
from shopfloor.plans import extract, validate
from shopfloor.sinks.files import EmptyExtract, read_extract_csv, read_extract_text, save_extract
from shopfloor.sources.tables import conform, from_catalog, from_parquet, jdbc_options
from shopfloor.storage import shared_folder


def same(a, b):
    assert a.columns == b.columns
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


# ---- files ----


def test_csv_round_trip(spark, tmp_path):
    path = str(tmp_path / "out")
    save_extract(extract.keyed_extract(tables(spark), AS_OF), path)
    expected = extract.run_extract(tables(spark), AS_OF)
    same(read_extract_csv(spark, path), expected)
    lines = [line for f in sorted(glob.glob(path + "/part-*")) for line in open(f, encoding="utf-8").read().splitlines()]
    assert lines[0].split(",") == schemas.EXTRACT.fieldNames()
    assert [line.split(",")[0] for line in lines if line[0].isdigit()] == ["11", "5", "3", "4", "2", "1"]
    assert any("São Paulo" in line for line in lines) and any('"Bolt, 5"" long"' in line for line in lines)


def test_part_files_follow_the_order(spark, tmp_path):
    path = str(tmp_path / "out")
    save_extract(generate.synthetic_runs(generate.numbered(spark, 5000).repartition(8), AS_OF), path)
    dates = []
    for file in sorted(glob.glob(path + "/part-*")):
        dates += [line.split(",")[1] for line in open(file, encoding="utf-8").read().splitlines()[1:]]
    assert len(dates) == 5000 and dates == sorted(dates, reverse=True)


def test_line_break_and_empty_text(spark, tmp_path):
    made = generate.synthetic_runs(generate.numbered(spark, 3), AS_OF)
    odd = made.withColumn("shift", F.lit("a\nb")).withColumn("operator", F.lit(""))
    save_extract(odd, str(tmp_path / "both"), formats=("csv", "parquet"))
    back = read_extract_csv(spark, str(tmp_path / "both/csv"), multiline=True)
    assert {(r["shift"], r["operator"]) for r in back.collect()} == {("a\nb", "")}
    kept = spark.read.parquet(str(tmp_path / "both/parquet"))
    assert {(r["shift"], r["operator"]) for r in kept.collect()} == {("a\nb", "")}


def test_empty_extract_is_refused_and_keeps_old_output(spark, tmp_path):
    path = str(tmp_path / "out")
    made = generate.synthetic_runs(generate.numbered(spark, 5), AS_OF)
    save_extract(made, path)
    with pytest.raises(EmptyExtract):
        save_extract(made.limit(0), path)
    assert read_extract_csv(spark, path).count() == 5


def test_written_text_has_the_declared_types(spark, tmp_path):
    path = str(tmp_path / "out")
    save_extract(generate.synthetic_runs(generate.numbered(spark, 200), AS_OF), path)
    assert validate.dtype_check(read_extract_text(spark, path)).filter("unreadable > 0").isEmpty()


def test_shared_folder_is_the_one_set(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


# ---- audit ----


def test_audit_records_success_and_error(spark):
    runner = AuditedRunner(spark, raise_errors=False)
    assert runner.run("five", lambda: spark.range(5)).count() == 5
    assert runner.run_sql("SELECT * FROM range(:n)", n=3).count() == 3
    assert runner.run_sql("SELEC 1") is None
    # Found only when computed.
    assert runner.run_sql("SELECT 1 / (id - id) AS x FROM range(2)") is None
    assert runner.run("none", lambda: spark.range(5).filter("id > 9")).count() == 0
    rows = runner.history().collect()
    assert [(r.rows, r.cols, r.status.split(":")[0]) for r in rows] == [
        (5, 1, "success"), (3, 1, "success"), (0, 0, "error"), (0, 0, "error"), (0, 1, "success"),
    ]
    assert all(r.duration_ms >= 0 for r in rows)
    assert runner.history().columns == ["sql_preview", "rows", "cols", "duration_ms", "status"]


def test_audited_results_keep_their_order(spark):
    runner = AuditedRunner(spark)
    rows = runner.run("sorted", lambda: spark.range(0, 300_000, 1, 12).orderBy(F.col("id").desc())).collect()
    assert [r["id"] for r in rows] == list(range(299_999, -1, -1))


def test_audit_keeps_whole_texts(spark, tmp_path):
    runner = AuditedRunner(spark, raise_errors=False)
    text = "SELECT 1 AS " + "x" * 200
    runner.run_sql(text)
    runner.run_sql("SELECT no_such_column FROM range(1)")
    for _ in range(2):
        runner.append_to(str(tmp_path / "audit"))
    rows = spark.read.parquet(str(tmp_path / "audit")).collect()
    assert len(rows) == 2 and any(r["query"] == text for r in rows)
    assert any("no_such_column" in (r["error"] or "") for r in rows)


def test_audit_raises_by_default_and_still_records(spark):
    runner = AuditedRunner(spark)
    with pytest.raises(AnalysisException):
        runner.run_sql("SELECT nothing FROM nowhere")
    assert runner.history().count() == 1


def test_audit_counts_a_constant_relation(spark):
    runner = AuditedRunner(spark)
    runner.run("empty", lambda: spark.createDataFrame([], "a int, b int"))
    assert [(r.rows, r.cols) for r in runner.history().collect()] == [(0, 2)]


def test_parameters_are_values_not_text(spark):
    spark.range(3).createOrReplaceTempView("three")
    assert sql(spark, "SELECT * FROM three WHERE id = :n", n=2).count() == 1
    assert sql(spark, "SELECT :t AS t", t="x' OR '1'='1").first().t == "x' OR '1'='1"
    with pytest.raises(Exception):
        sql(spark, "SELECT * FROM IDENTIFIER(:s || '.t')", s="a; DROP TABLE b").count()


# ---- registry and sources ----


def test_unknown_name(spark):
    with pytest.raises(KeyError, match="defect_rate_by_plant"):
        run_named("nothing", tables(spark))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_every_named_query_runs_on_hand_made_tables(spark, name):
    run_named(name, tables(spark)).collect()


def test_parquet_source(spark, tmp_path):
    for name, df in tables(spark).items():
        df.write.parquet(str(tmp_path / name))
    read = from_parquet(spark, str(tmp_path))
    same(extract.run_extract(read, AS_OF), extract.run_extract(tables(spark), AS_OF))


def test_catalog_source(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS works")
    for name, df in tables(spark).items():
        df.write.mode("overwrite").saveAsTable(f"works.{name}")
    read = from_catalog(spark, "works")
    same(extract.run_extract(read, AS_OF), extract.run_extract(tables(spark), AS_OF))
    text = "SELECT count(*) AS n FROM IDENTIFIER(:schema || '.plants') WHERE country = :country"
    assert sql(spark, text, schema="works", country="Brazil").first().n == 2
    spark.sql("DROP DATABASE works CASCADE")


def test_conform(spark):
    schema = schemas.TABLES["plants"]
    wide = tables(spark).plants.withColumn("plant_id", F.col("plant_id").cast("string")).withColumn("more", F.lit(1))
    assert conform(wide, schema).schema.fieldNames() == schema.fieldNames()
    assert conform(wide, schema).schema["plant_id"].dataType == schema["plant_id"].dataType
    with pytest.raises(AnalysisException):
        conform(wide.drop("city"), schema)


def test_jdbc_options():
    runs = jdbc_options("production_runs", "manufacturing", (1, 1000), 16)
    assert runs["dbtable"] == "manufacturing.production_runs"
    assert (runs["partitionColumn"], runs["lowerBound"], runs["upperBound"], runs["numPartitions"]) == ("run_id", "1", "1001", "16")
    assert jdbc_options("quality_checks", "manufacturing", (1, 9), 4)["partitionColumn"] == "check_id"
    assert "partitionColumn" not in jdbc_options("plants", "manufacturing", None, 16)
    assert "partitionColumn" not in jdbc_options("production_runs", "manufacturing", None, 16)


def test_extract_on_hand_made_values(spark):
    row = keyed(extract.run_extract(tables(spark), AS_OF), "run_id")[5]
    assert row["unit_cost"] == d("1.10") and row["run_date"] == datetime.date(2024, 1, 4)
