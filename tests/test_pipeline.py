"""The pipeline from landing files to written tables."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from ledgerlark import load_bundle, write_table
from ledgerlark.catalog import RESULTS
from ledgerlark.operators import profile, ranking, selection
from ledgerlark.operators.cleaning import clean_transactions
from ledgerlark.operators.profile import repeated_hashes
from ledgerlark.pipeline import run_pipeline
from ledgerlark.plans import workspace as workspace_module
from ledgerlark.plans.audits import validate_clean
from ledgerlark.plans.workspace import OBSERVED, STAGES, Workspace
from ledgerlark.schema import CLEAN_BASE
from ledgerlark.settings import Settings
from ledgerlark.sources import landing
from ledgerlark.sources.landing import BUNDLE, load_served, write_bundle
from ledgerlark.sources.star_view import raw_sheets
from ledgerlark.storage import shared_folder


def test_pipeline_over_csv_sheets(spark):
    folder = f"{shared_folder(spark)}/test-pipeline"
    raw = raw_sheets(spark, "/root/testdata/sf0.001")
    write_table(raw, f"{folder}/landing", "csv", partition_by="SourceYear")
    sheets = {name: f"{folder}/landing/SourceYear={name}" for name in ("S1", "S2")}
    tables = run_pipeline(spark, sheets, f"{folder}/tables")

    for name in STAGES:
        assert spark.read.parquet(f"{folder}/tables/{name}").columns == tables.stage(name).columns
    bundle = load_bundle(spark, f"{folder}/tables/dashboard")
    assert set(bundle) == set(BUNDLE)
    kpis = bundle["kpis"].first()
    assert kpis.net_revenue == pytest.approx(bundle["monthly"].agg(F.sum("net_revenue")).first()[0])
    assert kpis.net_revenue == pytest.approx(bundle["country"].agg(F.sum("net_revenue")).first()[0])
    assert kpis.transaction_rows == tables.clean.count() == 6046

    found = tables.rfm.inputFiles()
    again = run_pipeline(spark, sheets, f"{folder}/tables", only=["rfm", "q4_exec_kpis"], resume=True)
    assert again.rfm.inputFiles() == found
    assert spark.read.parquet(f"{folder}/tables/q4_exec_kpis").first().transaction_rows == 6046

    other = Settings(min_pair_orders=7)
    assert run_pipeline(spark, sheets, f"{folder}/tables", only=["rfm"], settings=other, resume=True).rfm.inputFiles() != found
    first = raw.filter("SourceYear = 'S1'").distinct().count()
    one = {"S1": sheets["S1"]}
    run_pipeline(spark, one, f"{folder}/tables", only=["rfm", "q4_exec_kpis"], resume=True)
    assert 0 < spark.read.parquet(f"{folder}/tables/q4_exec_kpis").first().transaction_rows <= first < 6046

    run_pipeline(spark, sheets, f"{folder}/named", only=["q4_exec_kpis"], table_format="csv")
    assert spark.read.csv(f"{folder}/named/q4_exec_kpis", header=True).count() == 1


def test_missing_serving_table_fails(spark):
    with pytest.raises(AnalysisException):
        load_bundle(spark, f"{shared_folder(spark)}/nothing-here")


@pytest.mark.parametrize("name", ["dash_monthly", "serve_monthly"])
def test_serving_tables_build_what_they_read(spark, name):
    tables = Workspace(raw_sheets(spark, "/root/testdata/sf0.001"))
    RESULTS[name](tables).count()
    assert set(tables._tables) == {"repeated_lines", "clean", "orders"}


def test_a_replaced_file_is_read_again(spark):
    folder = f"{shared_folder(spark)}/test-replaced"
    raw = raw_sheets(spark, "/root/testdata/sf0.001").filter("SourceYear = 'S1'").drop("SourceYear")
    sheets, only = {"S1": f"{folder}/landing"}, ["q4_exec_kpis", "orders"]

    def rows(df=None):
        if df is not None:
            write_table(df.coalesce(1), f"{folder}/landing")
        tables = run_pipeline(spark, sheets, f"{folder}/tables", "parquet", only=only, resume=True)
        return tables.orders.inputFiles(), spark.read.parquet(f"{folder}/tables/q4_exec_kpis").first().transaction_rows

    first, again, other = rows(raw), rows(), rows(raw.filter("Quantity > 1"))
    assert again == first and other[0] != first[0] and 0 < other[1] < first[1]


def _stage_writes(monkeypatch):
    written = []
    for module in (ranking, workspace_module, profile, selection):
        write = module.write_stage
        monkeypatch.setattr(module, "write_stage", lambda df, name, write=write: written.append(name) or write(df, name))
    return written


def test_concentrations_sort_once_and_write_nothing_on_a_second_call(spark, monkeypatch):
    tables = Workspace(raw_sheets(spark, "/root/testdata/sf0.001"))
    names = ["q1_customer_concentration", "q2_merch_concentration", "q3_customer_concentration", "q4_customer_concentration",
             "q3_value_quartiles"]
    first = {name: RESULTS[name](tables).collect() for name in names}
    written = _stage_writes(monkeypatch)
    assert {name: RESULTS[name](tables).collect() for name in names} == first and not written


def test_clean_measures_are_seen_while_the_table_is_written(spark):
    tables = Workspace(raw_sheets(spark, "/root/testdata/sf0.001"))
    seen = tables.clean_measures.first()
    assert "clean" in tables._seen and seen == tables.clean.agg(*OBSERVED["clean"]()).first()
    assert seen["rows__rows"] == tables.clean.count()


def test_only_suspects_are_compared_in_full(spark):
    raw = raw_sheets(spark, "/root/testdata/sf0.001")
    raw = raw.unionByName(raw.limit(50)).unionByName(raw.limit(50))
    tables = Workspace(raw)
    assert tables.clean.count() == clean_transactions(raw.distinct(), repeated_hashes(raw.limit(0))).count()
    assert tables.clean.distinct().count() == tables.clean.count()
    found = RESULTS["audit_profile"](tables).collect()
    assert sum(r.duplicate_rows for r in found) == raw.count() - raw.distinct().count() > 100
    copied = tables.clean.unionByName(tables.clean.limit(3))
    check = validate_clean(tables.clean_measures, copied, repeated_hashes(copied.select(*CLEAN_BASE)))
    assert check.filter("check = 'duplicates'").first().value == 3.0


def test_top_rows_of_each_sheet(spark):
    rows = spark.createDataFrame([(g, i, i * 7 % 10) for g in "ab" for i in range(30)], "g string, i long, v long")
    order = [F.asc("v"), F.desc("i")]
    found = profile.top_of_each(rows, "g", ["a", "b"], order, 4)
    assert found.exceptAll(profile.top_per_group(rows, "g", order, 4)).isEmpty() and found.count() == 8
    plan = profile.top_of_each(rows, "g", ["a"], order, 4)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
    assert profile.top_of_each(rows, "g", [], order, 4).count() == 0


def test_readers_see_a_whole_bundle_while_one_is_written(spark, monkeypatch):
    folder = f"{shared_folder(spark)}/test-bundle"
    with pytest.raises(AnalysisException):
        load_bundle(spark, folder)
    first = {role: spark.range(1).select(F.lit(f"first {role}").alias("v")) for role in BUNDLE}
    write_bundle(first, folder)

    def seen():
        return {role: df.first().v for role, df in load_bundle(spark, folder).items()}

    write, done = landing.write_table, []

    def stopped(df, path, *rest):
        if len(done) == 3:
            raise RuntimeError("stopped")
        done.append(path)
        write(df, path, *rest)
        assert seen() == {role: f"first {role}" for role in BUNDLE}

    second = {role: spark.range(1).select(F.lit(f"second {role}").alias("v")) for role in BUNDLE}
    monkeypatch.setattr(landing, "write_table", stopped)
    with pytest.raises(RuntimeError, match="stopped"):
        write_bundle(second, folder)
    assert len(done) == 3 and seen() == {role: f"first {role}" for role in BUNDLE}
    monkeypatch.setattr(landing, "write_table", write)
    held = load_bundle(spark, folder)
    write_bundle(second, folder)
    assert seen() == {role: f"second {role}" for role in BUNDLE}
    assert load_served(spark, folder, "rfm").first().v == "second rfm" and held["kpis"].first().v == "first kpis"
