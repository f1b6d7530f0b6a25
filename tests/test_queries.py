"""Each query against its oracle, and the others for rows, at the scale that ``FOLIANT_TEST_SF`` names."""

import os

import pytest
from compare import differences
from conftest import DATA

from foliant.queries import ORACLES, QUERIES

FOLDER = f"{DATA}/sf{os.environ.get('FOLIANT_TEST_SF', '0.001')}"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_as_the_oracle(spark, name):
    assert differences(QUERIES[name](spark, FOLDER), ORACLES[name], FOLDER) == ""


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - ORACLES.keys()))
def test_rows(spark, name):
    df = QUERIES[name](spark, FOLDER)
    assert len(set(df.columns)) == len(df.columns)
    assert df.collect()
