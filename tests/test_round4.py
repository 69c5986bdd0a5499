"""Queries against DuckDB on tables where they once differed: prices whose sums leave noise."""

import duckdb
import pytest
from test_round3 import agrees

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def uneven(tmp_path_factory):
    """Parts of the size 25, at which the price before is the price, with prices to which 25 can't be added and taken off again."""
    root = tmp_path_factory.mktemp("uneven")
    for t in ("region", "nation", "customer", "supplier", "orders", "lineitem"):
        (root / f"{t}.parquet").symlink_to(f"{SF}/{t}.parquet")
    own = f"select p_partkey, p_name, p_brand, p_type, cast(case when p_partkey % 2 = 0 then 25 else p_size end as int) as p_size, case when p_partkey % 3 = 0 then 999.4 else p_retailprice * 1.0137 end as p_retailprice from '{SF}/part.parquet'"
    duckdb.sql(f"copy ({own}) to '{root}/part.parquet' (format parquet)")
    assert duckdb.sql(f"select count(*) from '{root}/part.parquet' where p_size = 25 and p_retailprice + p_size - 25 > p_retailprice").fetchall()[0][0] > 10
    return str(root)


@pytest.mark.parametrize("name", ["offer_records", "nested_offers"])
def test_uneven_prices(spark, uneven, name):
    assert agrees(spark, uneven, name)
