"""Every registered query against its SQL twin."""

import pytest
from compare import connect, difference

import __spark_entry__ as contract
from adlake.oracle import oracle
from adlake.queries import REGISTRY as QUERIES

ORACLE = oracle()


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE) and QUERIES.items() <= contract.queries().items()
    assert ORACLE.items() <= contract.oracle_sql().items() and set(contract.oracle_sql()) <= set(contract.queries())


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, sf_dir, duck):
    assert difference(QUERIES[name](spark, sf_dir), duck, ORACLE[name]) is None


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_other_queries_stand_without_the_corpus_operators(monkeypatch):
    """A library that the corpus operators need is missing."""
    import builtins
    import sys

    real = builtins.__import__

    def blocked(name, *args, **kwargs):
        if name == "adlake.llm" or name.startswith("adlake.llm."):
            raise ImportError(name)
        return real(name, *args, **kwargs)

    for name in [name for name in sys.modules if name.startswith("adlake.llm") or name == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setattr(builtins, "__import__", blocked)
    assert set(contract.queries()) == set(QUERIES) and set(contract.oracle_sql()) == set(ORACLE)
