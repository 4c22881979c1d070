"""Every registered query against its SQL on the given tables."""

from __future__ import annotations

from collections import Counter

import pytest

from harness.oracles import ORACLES
from harness.queries import QUERIES


def test_each_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, sf_dir, name):
    ours = QUERIES[name](spark, sf_dir)
    theirs = duck.sql(ORACLES[name])
    columns = sorted(ours.columns)
    assert columns == sorted(theirs.columns)
    expected = Counter(theirs.select(*[f'"{c}"' for c in columns]).fetchall())
    found = Counter(tuple(row) for row in ours.select(*columns).collect())
    assert found == expected
    assert expected, "the oracle returned no row"
