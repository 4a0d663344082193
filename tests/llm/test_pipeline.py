"""Stages take effect, keep the columns of documents, and equal their operators; run() chains them."""

import duckdb
import pytest

import corpus_pipeline as P
from conftest import SF_SMALL
from radiolens.llm import queries as Q
from radiolens.llm.common import read_table, staged


@pytest.mark.parametrize("name", sorted(Q.SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = Q.QUERIES[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    res = con.sql(Q.SQL[name])
    want = [tuple(row[res.columns.index(c)] for c in cols) for row in res.fetchall()]
    assert sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr) == sorted(want, key=repr)


def test_stages(spark):
    docs = read_table(spark, SF_SMALL, "documents")
    kept = docs
    for name, stage in P.STAGES:
        before, kept = kept, staged(stage(spark, kept, SF_SMALL), "test")
        if stage is not P.shard:
            assert kept.columns == docs.columns, name
        if stage in (P.drop_toxic, P.drop_near_copies, P.drop_contaminated):
            assert 0 < kept.count() < before.count() + (stage is P.drop_toxic)
            assert kept.exceptAll(before).isEmpty()
    assert set(kept.columns) == {*docs.columns, "shard", "slot"}
    n = sorted(r["count"] for r in kept.groupBy("shard").count().collect())
    assert n[-1] - n[0] <= 1


def test_stages_on_an_empty_table(spark):
    docs = read_table(spark, SF_SMALL, "documents").limit(0)
    for _, stage in P.STAGES:
        assert stage(spark, docs, SF_SMALL).count() == 0


def test_near_copies_with_null_and_repeated_identifiers(spark):
    a, b, c, d, e = (" ".join(f"{x}{j}" for j in range(30)) for x in "abcde")
    rows = [(1, a), (None, a), (None, a + " tail"), (2, b), (2, b), (3, c), (3, a + " other"), (None, d), (None, d + " tail"),
            (None, d), (None, e), (4, ""), (4, ""), (None, None), (None, "  ")]
    docs = spark.createDataFrame([(i, t, "en", f"s{n}", len(t or "")) for n, (i, t) in enumerate(rows)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    out = P.drop_near_copies(spark, docs, SF_SMALL)
    assert out.columns == docs.columns
    got = [(r.doc_id, r.text) for r in out.collect()]
    of_d = [x for x in got if x[1] and x[1].startswith(d)]
    assert len(of_d) == 1 and of_d[0] in [(None, d), (None, d + " tail")]
    want = [(1, a), (2, b), (3, c), (None, e), (4, ""), (4, ""), (None, None), (None, "  ")]
    assert sorted((x for x in got if x not in of_d), key=repr) == sorted(want, key=repr)
