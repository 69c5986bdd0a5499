"""Queries against DuckDB on tables where they once differed: empty tasks, repeated pages, equal chances."""

import re
import shutil

import duckdb
import pytest
from pyspark.sql import functions as F

from cosecha import queries
from cosecha.plans import pages, production, trees
from cosecha.sources import files

SF = "/root/testdata/sf0.001"


def agrees(spark, folder, name):
    c = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem"):
        c.sql(f"create view {t} as select * from read_parquet('{folder}/{t}.parquet')")
    got = queries.QUERIES[name](spark, folder)
    names = ", ".join(f'"{n}"' for n in got.columns)
    key = lambda r: tuple((x is None, str(x)) for x in r)
    return sorted(map(tuple, got.collect()), key=key) == sorted(c.sql(f"select {names} from ({queries.ORACLE_SQL[name]})").fetchall(), key=key)


def test_tasks_without_rows_write_no_file(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        assert spark.read.parquet(f"{SF}/orders.parquet").rdd.getNumPartitions() > 1
        assert agrees(spark, SF, "file_failures")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.fixture(scope="module")
def repeated(tmp_path_factory):
    """Parts whose keys repeat: with equal names and prices, but other sizes, brands and prices before."""
    root = tmp_path_factory.mktemp("repeated")
    for t in ("region", "nation", "customer", "supplier", "orders", "lineitem"):
        shutil.copyfile(f"{SF}/{t}.parquet", root / f"{t}.parquet")
    own = f"select p_partkey % 50 as p_partkey, case when g = 0 then p_name else 'red bolt' end as p_name, case g when 2 then 'A' else p_brand end as p_brand, p_type, cast((p_size + 11 * g) % 50 + 1 as int) as p_size, 900.0 + (p_partkey % 3) as p_retailprice from '{SF}/part.parquet', range(3) r(g)"
    duckdb.sql(f"copy ({own}) to '{root}/part.parquet' (format parquet)")
    return str(root)


@pytest.mark.parametrize("name", ["nested_offers", "offer_records", "unique_offers", "ranked_offers"])
def test_repeated_pages(spark, repeated, name):
    assert agrees(spark, repeated, name)


def test_top_risks_by_what_is_shown(spark):
    rows = [("b", "x", 2000, 0.25, 0.0), ("a", "x", 2000, 0.25 - 1e-15, 0.0), ("c", "x", 2000, 0.25 + 1e-15, -1e-16), ("d", "x", 2000, 0.3, 0.0), ("e", "x", 2000, None, None)]
    got = production.top_risks(spark.createDataFrame(rows, "cultivo string, estado string, anio int, caida_10 double, cambio_pct double"), 4)
    assert [r["cultivo"] for r in got.select(F.col("cultivo")).collect()] == ["d", "a", "b", "c"]


def test_report_tables_in_one_pass(spark):
    """A page is read once, and its table needs one shuffle, with the names of its columns."""
    page = spark.range(0, 40).selectExpr("id as page_id", "concat('<table><tr><td>x</td></tr></table><table><tr><th>Entidad</th><th>Superficie ha sembrada</th><th></th><th>Entidad</th></tr><tr><td>E', id, '</td><td>', id, '</td><td> </td><td>z</td></tr><tr><td></td><td>1</td></tr></table>') as html")
    report = pages.numeric_columns(pages.report_table(pages.tables(page), ("entidad",)))
    assert sorted(tuple(r)[1:] for r in report.where("page_id = 7").collect()) == [(1, "entidad", "E7", None), (1, "numero", None, None), (1, "superficie_sembrada_ha", "7", 7.0), (2, "entidad", None, None), (2, "superficie_sembrada_ha", "1", 1.0)]
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and plan.count("Exchange hashpartitioning") + plan.count("Exchange REPARTITION") <= 2


def test_splits_join_sums_not_rows(spark):
    df = spark.createDataFrame([("a", float(i % 5), i % 3, None if i % 7 == 0 else i % 2) for i in range(60)], "k string, y double, p int, q int")
    out = trees.root_splits(df, ["k"], "y", ["p", "q"])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1 and plan.index("Join") < plan.index("Generate explode")
    assert {r["columna"] for r in out.collect()} == {"p", "q"}


@pytest.mark.parametrize(("name", "most"), [("price_context", 6), ("production_forecast", 1), ("prices_with_water", 3), ("daily_panel", 1)])
def test_lines_are_read_once_a_summary(spark, monkeypatch, name, most):
    """Of all plans that a query runs, so many read lineitem; those of water stand twice in a plan, as one exchange."""
    plans, saved = [], files.saved
    monkeypatch.setattr(files, "saved", lambda df, to: plans.append(df) or saved(df, to))
    plans.append(queries.QUERIES[name](spark, SF))
    assert sum(len(re.findall(r"Relation \[l_", df._jdf.queryExecution().optimizedPlan().toString())) for df in plans) <= most


def test_price_context_agrees(spark):
    assert agrees(spark, SF, "price_context")
