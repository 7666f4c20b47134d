"""Registered queries against their SQL twins; LEDGERLOOM_ALL=1 runs every one."""

import os

import duckdb
import pytest

from ledgerloom.checks import ORACLES, QUERIES
from ledgerloom.checks.standins import TABLES

SF_DIR = os.environ.get("LEDGERLOOM_SF_DIR", "/root/testdata/sf0.001")
QUICK = (
    "perimeter", "transaction_metrics", "rent_fee_by_key", "monthly_compare", "mismatch_reason_stats",
    "ds_client_months_upto", "predecessor_lift", "fuzzy_entity_match", "disputed_candidates", "scan_csv", "rent_row_classes", "product_flags_wide", "exact_quantiles_by_group",
)
NAMES = sorted(QUERIES) if os.environ.get("LEDGERLOOM_ALL") else QUICK

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF_DIR}/{t}.parquet')")
    return c


def ordered(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_its_twin(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    cursor = con.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert ordered([tuple(r) for r in df.collect()], df.columns) == ordered(cursor.fetchall(), names)
