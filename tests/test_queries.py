"""Queries against their SQL on the smallest tables; the driver runs the rest."""

import ast
import os
import re
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from harness import catalog, inputs, oracle

DIR = "/root/testdata/sf0.001"
SAMPLE = [
    "a04_date_formats", "a11_sales_audit", "b10_action_report", "c15_tagged_sales", "c16_metrics", "d02_last_threshold",
    "s01_csv_scan", "s07_report_sink", "t02_outlier_bound", "w01_flatten_stock",
]

pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in ("lineitem", "orders", "part", "supplier"):
        connection.execute(f"create view {table} as select * from '{DIR}/{table}.parquet'")
    return connection


def _plain(value):
    return str(value) if hasattr(value, "isoformat") else value


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, duck, name):
    df = contract.queries()[name](spark, DIR)
    cursor = duck.execute(contract.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    want = sorted((tuple(map(_plain, row)) for row in cursor.fetchall()), key=repr)
    got = sorted((tuple(map(_plain, row)) for row in df.select(*columns).collect()), key=repr)
    assert got == want


def test_every_query_has_sql():
    assert set(catalog.queries()) == set(oracle.oracle_sql())


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01", "sf0.1"])
def test_sale_order_is_unique(duck, size):
    key = ", ".join(inputs.SALE_ORDER)
    rows, distinct = duck.execute(
        f"select count(*), count(distinct ({key})) from '/root/testdata/{size}/lineitem.parquet'"
    ).fetchone()
    assert rows == distinct


# Queries that write files or tables, or bracket a quantile, before their result is asked for.
SCHEMAS = {}
EAGER = {
    "s01_csv_scan", "s02_stock_scan", "s03_inventory_scan", "s04_menu_scan", "s05_employee_scan", "s06_source_policy",
    "s07_report_sink", "s08_quarantine_sink", "b10_action_report", "b11_run_summary", "t02_outlier_bound", "t05_role_views", "t06_datasets",
}


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - EAGER))
def test_building_a_query_starts_no_job(spark, monkeypatch, name):
    def table(spark, sf_dir, name):
        # Spark starts a job to find the schema of files, so it is given
        if name not in SCHEMAS:
            SCHEMAS[name] = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
        return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")

    for source in ("lineitem", "orders", "part", "supplier"):
        table(spark, DIR, source)
    monkeypatch.setattr(inputs, "_table", table)
    context = spark.sparkContext
    context.setJobGroup(f"build-{name}", name)
    try:
        catalog.queries()[name](spark, DIR)
        assert list(context.statusTracker().getJobIdsForGroup(f"build-{name}")) == []
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("module", sorted(Path(contract.__file__).parent.glob("larder/**/*.py")), ids=str)
def test_nothing_is_defined_twice(module):
    if "llm" in module.parts:
        pytest.skip("has its own tests")
    names = [n.name for n in ast.parse(module.read_text()).body if isinstance(n, (ast.FunctionDef, ast.ClassDef))]
    names += [t.id for n in ast.parse(module.read_text()).body if isinstance(n, ast.Assign) for t in n.targets if isinstance(t, ast.Name)]
    assert len(names) == len(set(names))


@pytest.mark.parametrize("hidden", ["larder.llm", "corpus_pipeline"])
def test_entry_point_stands_without_the_subpackage(hidden):
    code = f"import sys; sys.modules[{hidden!r}] = None; import __spark_entry__ as e; print(sorted(e.queries()) == sorted(e.oracle_sql()), len(e.queries()))"
    root = Path(contract.__file__).parent
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=False)
    assert done.stdout.split() == ["True", str(len(catalog.queries()))], done.stderr[-500:]


@pytest.fixture(scope="module")
def own_rows(spark, tmp_path_factory):
    """A folder with tables of a few rows."""
    folder = str(tmp_path_factory.mktemp("own"))
    texts = {
        "lineitem": "select id + 1 as l_orderkey, id * 3 + 1 as l_partkey, id % 9 + 1 as l_suppkey, cast(id % 7 + 1 as int) as l_linenumber, "
        "cast(id % 50 + 1 as double) as l_quantity, 'N' as l_returnflag, timestamp_ntz'2024-01-01' + make_dt_interval(cast(id % 20 as int)) as l_shipdate from range(300)",
        "orders": "select id + 1 as o_orderkey, id % 100 + 1 as o_custkey, cast(id as double) as o_totalprice, '2-HIGH' as o_orderpriority, "
        "timestamp_ntz'2024-01-01' + make_dt_interval(cast(id % 20 as int)) as o_orderdate from range(300)",
        "part": "select id + 1 as p_partkey, cast(id % 50 + 1 as int) as p_size from range(400)",
        "supplier": "select id + 1 as s_suppkey from range(10)",
    }
    for name, text in texts.items():
        spark.sql(text).write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.mark.parametrize("name", ["b01_dense_grid", "b02_trailing_mean", "b03_unpivot", "b03w_pivot", "b04_attach_forecast", "b05_days_to_stockout",
                                  "b06_urgency", "b07_urgent_count", "k06_status_counts", "k08_bind_invalid", "k09_sorted_report", "t03_status_shares"])
def test_consumption_is_not_worked_out_again_by_each_reader(spark, own_rows, name):
    plan = contract.queries()[name](spark, own_rows)
    assert not [f for f in plan.inputFiles() if "lineitem" in f]


@pytest.mark.parametrize("name", ["c14_unknown_employees", "c15_tagged_sales", "j08_orphan_items", "t03_reason_shares"])
def test_the_jvm_compiles_every_method(spark, own_rows, capsys, name):
    # Fused projections whose method has more than 8000 bytes are interpreted.
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        contract.queries()[name](spark, own_rows).explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) <= 8000


@pytest.mark.parametrize("name", ["c02_keep_first", "c14_unknown_employees", "j08_orphan_items"])
def test_places_are_compiled_and_not_tested_at_the_scan(spark, own_rows, name):
    # Below a higher-order function a struct is put together uncompiled, once more in each filter that mentions it.
    plan = contract.queries()[name](spark, own_rows)._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" in plan and "transform(array(struct(" not in plan
    assert not [line for line in plan.splitlines() if "Filter" in line and "transform(" in line]


def test_sales_are_dealt_out_by_as_many_tasks_as_their_bytes_need(spark, own_rows):
    # A number given would stay the same for any size.
    plan = inputs.sales(spark, own_rows)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.split("RepartitionByExpression")[1].splitlines()[0].rstrip().endswith("]")
