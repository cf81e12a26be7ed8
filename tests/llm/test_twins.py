"""The queries of this subpackage against their SQL twins; those without one only have the right columns here."""

import pytest

from graphloom.llm import queries as llm
from tests.test_entry import same_rows


@pytest.mark.parametrize("name", sorted(llm.ORACLE))
def test_twin(spark, data, duck, name):
    same_rows(llm.QUERIES[name](spark, data), duck, llm.ORACLE[name])


def test_all_are_there():
    assert sorted(int(k[2:].split("_")[0]) for k in llm.QUERIES) == list(range(1, 14))
