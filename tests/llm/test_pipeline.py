"""The registered queries against their SQL, and the pipeline's stages against plain Python."""

import os

import duckdb
import pytest

import corpus_pipeline
from plumbline.llm import queries
from tests.llm import brute
from tests.llm.conftest import FOLDER

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not there")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(shared, name):
    duck = duckdb.connect()
    for table in ("documents", "pages", "conversations", "benchmark", "embeddings"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    found = queries.QUERIES[name](shared, FOLDER)
    answer = duck.execute(queries.ORACLES[name])
    columns = [c[0] for c in answer.description]
    assert sorted(columns) == sorted(found.columns)
    assert sorted(map(str, (tuple(r[c] for c in columns) for r in found.collect()))) == sorted(map(str, answer.fetchall()))


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES) - {"pipeline"}))
def test_query_covers_its_table(shared, documents, name):
    found = queries.QUERIES[name](shared, FOLDER).collect()
    ids = [r["doc_id"] for r in found if r["doc_id"] is not None]
    assert sorted(ids) == sorted(r["doc_id"] for r in documents.select("doc_id").collect())


def test_pipeline_stages(shared, documents):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language ID", "exact dedup", "n-gram Jaccard join", "benchmark decontamination", "packing"]
    benchmark = [(r["item_id"], r["text"]) for r in shared.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    docs = documents
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        docs = stage(shared, docs, FOLDER)
        if name != "packing":
            assert docs.columns == documents.columns
        after = {r["doc_id"] for r in docs.collect()}
        if name == "language ID":
            assert len(after) >= 0.98 * len(before)
        elif name == "exact dedup":
            groups = {}
            for i, text in before.items():
                groups.setdefault("".join(brute.SPACED.findall(text)), []).append((-len(text), i))
            assert after == {min(g)[1] for g in groups.values()}
        elif name == "n-gram Jaccard join":
            ids = sorted(before)
            roots, _ = brute.components([before[i] for i in ids], 5, 4, 5)
            assert after == {ids[r] for r in roots}
        elif name == "benchmark decontamination":
            judged = {i: brute.contamination(t, benchmark) for i, t in before.items()}
            assert after == {i for i, (n, hit, _) in judged.items() if not (hit and 20 * hit >= n)}
        else:
            assert after == set(before)


def test_pipeline_of_null_and_repeated_keys_and_of_no_rows(shared, documents):
    """A third of the rows without a key, some rows twice, and a table without rows go through every stage."""
    odd = documents.selectExpr("CASE WHEN doc_id % 3 = 0 THEN NULL ELSE doc_id END AS doc_id", "text", "lang", "source", "n_chars")
    odd = odd.unionByName(odd.where("doc_id % 5 = 0")).unionByName(shared.createDataFrame([(None, None, None, None, None)], odd.schema))
    for docs in (odd, documents.where("false")):
        empty = docs.isEmpty()
        for name, stage in corpus_pipeline.STAGES:
            before = [tuple(r) for r in docs.collect()]
            docs = stage(shared, docs, FOLDER)
            after = [tuple(r) for r in docs.collect()]
            if name == "packing":
                assert len(after) == len(before)
            else:
                assert docs.columns == documents.columns and set(after) <= set(before) and len(after) <= len(before)
                assert empty or len(after) > 0.3 * len(before)
