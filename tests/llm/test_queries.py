"""The registered queries on the given tables: against their SQL, and the nearest neighbours against numpy."""

import numpy as np
import pytest

from callsheet.llm.queries import ORACLE_SQL, QUERIES
from callsheet.oracle.compare import compare, duckdb_connection


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
@pytest.mark.parametrize("key", sorted(ORACLE_SQL))
def test_query_matches_its_sql(spark, key, sf):
    r = compare(QUERIES[key](spark, sf), duckdb_connection(sf), ORACLE_SQL[key])
    assert r["ok"], r


def test_nearest_neighbours_match_numpy(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    rows = [(i, np.array(e, np.float64)) for i, e in rows if i is not None and e is not None and None not in e]
    rows = [(i, e) for i, e in rows if np.isfinite(e).all() and e.any()]
    ids, all_ = np.array([i for i, _ in rows]), np.stack([e for _, e in rows])
    want = []
    for q, e in rows:
        if q % 20 == 0:
            score = all_ @ e
            order = np.lexsort((ids, -score))
            want += [(q, k + 1, int(ids[j]), score[j]) for k, j in enumerate(order[ids[order] != q][:20])]
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in QUERIES["op7_nearest_neighbours"](spark, sf).collect())
    assert [g[:3] for g in got] == [w[:3] for w in sorted(want)]
    assert np.allclose([g[3] for g in got], [w[3] for w in sorted(want)], rtol=0, atol=1e-12)
