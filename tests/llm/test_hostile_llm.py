"""The p-queries for training data over empty tables, and over tables with nulls, blanks, very long texts, repeats and clashing columns."""

import os

import hostile
import pytest

pytestmark = pytest.mark.skipif(not os.path.isdir(hostile.SOURCE), reason="no test tables")


@pytest.fixture(scope="module")
def folders(tmp_path_factory):
    return {k: f(str(tmp_path_factory.mktemp(k))) for k, f in (("empty", hostile.empty), ("hostile", hostile.hostile))}


def names():
    from garimpo.llm import queries

    return sorted(queries.QUERIES)


@pytest.mark.parametrize("name", names())
def test_empty(spark, folders, name):
    from garimpo.llm import queries

    assert queries.QUERIES[name](spark, folders["empty"]).count() == 0


@pytest.mark.parametrize("name", names())
def test_hostile(spark, folders, name):
    from garimpo.llm import queries

    df = queries.QUERIES[name](spark, folders["hostile"])
    assert df.count() >= 0 and len(set(df.columns)) == len(df.columns)
