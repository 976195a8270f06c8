import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as E  # noqa: E402
from eventide.plans import catalog  # noqa: E402
from conftest import SF_SMALL  # noqa: E402


def test_every_query_has_a_stable_schema(spark):
    assert set(E.oracle_sql()) <= set(E.queries()) and set(catalog.QUERIES) <= set(E.queries())
    for name, fn in catalog.QUERIES.items():
        a = fn(spark, SF_SMALL)
        b = fn(spark, SF_SMALL)
        assert a.schema == b.schema, name
        a.limit(5).collect()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["window_start", "window_end", "rank", "item_id", "views"]
    assert df.count() > 0
