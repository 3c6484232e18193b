"""The training-data queries against their DuckDB twins, and operator 8 at the parameters of its query."""

from collections import Counter

import pytest

from cartwheel.llm import jaccard_join as J, queries
from parity import difference
from test_similarity import brute_components, variants


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query(name, spark, folder, duck):
    assert difference(queries.QUERIES[name](spark, folder), duck, queries.SQL[name]) is None


@pytest.mark.parametrize("k, num, den", [(3, 90, 100), (1, 50, 100)])
def test_components_equal_brute_force(frame, k, num, den):
    assert (J.ROUNDS, J.BLOCK) == (2, 512)
    rows = variants(k)
    got = J.jaccard_components(frame(rows), words=k, num=num, den=den).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component"]) for r in got) == brute_components(rows, k, num, den)
