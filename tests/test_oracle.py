"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as entry
import oracle


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_rows(spark, con, sf_dir, name):
    assert oracle.compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], sf_dir) is None


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_has_rows(spark, sf_dir, name):
    assert entry.queries()[name](spark, sf_dir).count() > 0


def test_entry(spark):
    columns = entry.entry(spark).columns
    assert columns == ["company_name", "account_description", "custom_1", "amount_all", "amount_custom_1"]
