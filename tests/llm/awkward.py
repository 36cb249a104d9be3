"""Fixtures of the awkward table, imported by the test modules (a second conftest would hide the first)."""

import pytest

import brute


@pytest.fixture(scope="session")
def docs(spark):
    """The awkward table, with extra columns named like the operators' own."""
    return spark.createDataFrame(brute.full(brute.documents()), brute.SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], brute.SCHEMA)
