import pytest

from panelcast.llm.catalog import ORACLE, REGISTRY
from tests.llm.conftest import SF
from tests.oracle_harness import _key, _norm, duck


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    got = REGISTRY[name](spark, SF)
    cols = sorted(got.columns)
    rows = sorted((tuple(_norm(r[c]) for c in cols) for r in got.collect()), key=_key)
    rel = duck(SF).execute(ORACLE[name])
    names = [d[0] for d in rel.description]
    assert sorted(names) == cols
    want = sorted((tuple(_norm(r[names.index(c)]) for c in cols) for r in rel.fetchall()), key=_key)
    assert rows == want
