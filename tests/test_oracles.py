"""Every registered query against its oracle, value by value."""

import duckdb
import pytest

from testbed import catalog, oracle
from tests.conftest import FORCED

SPARK_TO_DUCKDB = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]

# Queries whose cards, keys or dimensions have another way beyond their size limits.
WITH_ANOTHER_WAY = [
    "item_slots",
    "shipment_base",
    "keyword_indexes",
    "lane_rate_override",
    "fuel_surcharge",
    "zip_tier_surcharge",
    "expedited_surcharge",
    "near_msa_surcharge",
    "extra_quantity_surcharge",
    "priced_shipments",
    "equi_lookup",
    "band_lookup",
    "band_lookup_many",
    "band_lookup_open",
    "keyword_indexes_many",
]


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return connection


def _sorted(rows):
    return sorted([[(value is None, repr(value)) for value in row] for row in rows])


def _assert_same(df, duck, sql):
    names = sorted(df.columns)
    relation = duck.sql(sql)
    assert sorted(relation.columns) == names
    expected_types = dict(zip(relation.columns, map(str, relation.types)))
    for field in df.schema:
        assert SPARK_TO_DUCKDB[field.dataType.simpleString()] == expected_types[field.name]
    columns = ", ".join(f'"{name}"' for name in names)
    expected = duck.sql(f"select {columns} from ({sql})").fetchall()
    actual = [tuple(row) for row in df.select(*names).collect()]
    assert len(actual) > 0
    assert _sorted(actual) == _sorted(expected)


def test_every_query_has_an_oracle():
    assert catalog.QUERIES.keys() == oracle.oracle_sql().keys()


@pytest.mark.parametrize("name", catalog.QUERIES)
def test_query(name, spark, sf_dir, duck):
    _assert_same(catalog.query(name)(spark, sf_dir), duck, oracle.oracle_sql()[name])


@pytest.mark.parametrize("name", WITH_ANOTHER_WAY)
def test_query_beyond_its_limits(name, spark, sf_dir, duck):
    _assert_same(catalog.query(name, FORCED)(spark, sf_dir), duck, oracle.oracle_sql()[name])
