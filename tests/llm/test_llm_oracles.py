"""The training-data queries against their SQL, and which of them have none."""

import __spark_entry__ as entry
import pytest

from leadrank.compare import differences, duckdb_views
from leadrank.llm import oracles, queries

# Tested against a library, a brute-force version or held-out labels instead.
ROWS_ONLY = {
    "op4_simhash",
    "op5_quality",
    "op8_sentencepiece",
    "op9_packed_ids",
    "op10_language",
    "op12_packing",
    "op13_resampling",
}


def test_registered():
    assert set(queries.all_queries()) - set(oracles.all_oracles()) == ROWS_ONLY
    assert set(queries.all_queries()) | {"pipeline"} <= set(entry.queries())
    assert {int(n[2:].split("_")[0]) for n in queries.all_queries()} == set(range(1, 14))


@pytest.mark.parametrize("name", sorted(oracles.all_oracles()))
def test_query(spark, sf, name):
    ours = queries.all_queries()[name](spark, sf).toPandas()
    assert len(ours) > 0
    assert differences(ours, duckdb_views(sf).execute(oracles.all_oracles()[name]).df()) == ""
