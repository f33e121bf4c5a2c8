"""Every registered query beside its SQL twin."""

import os

import check_oracle
import pytest

import __spark_entry__ as contract

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def connection():
    return check_oracle.database(FOLDER)


def test_contract_names():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_has_rows(spark):
    df = contract.entry(spark)
    assert df.columns == ["doc_id", "prediction", "label"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, connection, name):
    outcome = check_oracle.compare(
        spark, connection, FOLDER, name, contract.oracle_sql().get(name)
    )
    assert outcome.startswith(("equal", "rows only")), outcome
