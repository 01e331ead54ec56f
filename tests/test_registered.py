"""Every registered query against its SQL answer on the smallest tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from checks import registry, verify

FOLDER = os.environ.get("MILLRACE_TEST_TABLES", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return verify.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    mine = verify.spark_answer(entry.queries()[name](spark, FOLDER))
    theirs = verify.sql_answer(duck, entry.oracle_sql()[name])
    assert verify.difference(mine, theirs) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.ORACLES)
