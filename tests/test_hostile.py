"""The core's p-queries over empty tables, and over tables with nulls, blanks, very long values, repeats and clashing columns."""

import os

import hostile
import oracle
import pytest

pytestmark = pytest.mark.skipif(not os.path.isdir(hostile.SOURCE), reason="no test tables")


@pytest.fixture(scope="module")
def folders(tmp_path_factory):
    return {k: f(str(tmp_path_factory.mktemp(k))) for k, f in (("empty", hostile.empty), ("hostile", hostile.hostile))}


def names():
    from garimpo.plans import problems

    return sorted(problems.QUERIES)


@pytest.mark.parametrize("name", names())
def test_empty(spark, folders, name):
    from garimpo.plans import problems

    assert problems.QUERIES[name](spark, folders["empty"]).count() == 0


@pytest.mark.parametrize("name", names())
def test_hostile(spark, folders, name):
    from garimpo.plans import problems, problems_sql

    df = problems.QUERIES[name](spark, folders["hostile"])
    if name in ("p6_found", "p2_found"):  # the contracts are total: DuckDB's answer holds for hostile rows as well
        assert oracle.compare(df, oracle.connect(folders["hostile"]), problems_sql.ORACLES[name]) is None
    else:
        assert df.count() >= 0
