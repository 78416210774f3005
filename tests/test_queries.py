import pytest

from threadline.plans import registry


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_against_sql(name, same):
    same(registry.queries()[name], registry.oracle_sql()[name])
