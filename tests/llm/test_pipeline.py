"""The pipeline's stages on a planted corpus, and every registered query on the smallest tables."""

import duckdb
import pytest
from helpers import DOCUMENTS, edge_docs, empty_docs, prose

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from tidegate.llm.queries import QUERIES, SQL

TABLES = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in queries()) == 1
    assert set(QUERIES) | {"pipeline"} <= set(queries()) and set(SQL) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    df = QUERIES[name](spark, TABLES)
    with duckdb.connect() as database:
        for table in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
            database.execute(f"CREATE VIEW {table} AS SELECT * FROM '{TABLES}/{table}.parquet'")
        result = database.execute(SQL[name])
        names = [c[0] for c in result.description]
        expected = sorted((tuple(dict(zip(names, row, strict=True))[c] for c in df.columns) for row in result.fetchall()), key=str)
    assert sorted(map(tuple, df.collect()), key=str) == expected and expected


def run_stages(spark, docs, folder):
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, TABLES)
        path = folder(name)
        out.write.parquet(path)
        docs, before = spark.read.parquet(path), docs
        kept.append({r.doc_id for r in docs.select("doc_id").collect()})
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == before.columns
    return docs, kept


def test_stages_catch_what_is_planted_and_keep_the_rest(spark, folder):
    item = spark.read.parquet(f"{TABLES}/benchmark.parquet").orderBy("item_id").first()
    other = str.maketrans("bkt", "çèû")
    clean = [(i, prose(i, 120) if i % 2 else prose(i, 120).translate(other), "en" if i % 2 else "fr", "a", None) for i in range(1, 40)]
    passage = prose(777, 60)
    copy = prose(3, 120)
    near = prose(900, 100).replace("\n", " ")
    rows = clean + [
        (100, "12 34 56", "en", "a", None), (101, None, "en", "a", None),  # no language
        (102, copy, "fr", "a", None),  # a copy
        (103, prose(800, 30) + "\n" + passage, "en", "a", None), (104, prose(801, 30) + "\n" + passage, "en", "a", None),
        (105, near, "en", "a", None), (106, near + " tail", "en", "a", None),  # near-duplicates
        (107, prose(802, 40) + " " + item.text + " " + prose(803, 40), "en", "a", None),  # a leak
    ]
    docs = spark.createDataFrame(rows, DOCUMENTS)
    last, (language, lines, near_kept, leaks, coded) = run_stages(spark, docs, folder)
    ids = {r[0] for r in rows}
    assert language == ids - {100, 101}
    assert lines == language - {102}
    assert near_kept == lines - {106}
    assert leaks == near_kept - {107} == coded
    assert last.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_stages_take_edge_cases_and_empty_tables(spark, folder):
    run_stages(spark, edge_docs(spark), folder)
    _, kept = run_stages(spark, empty_docs(spark), folder)
    assert kept == [set()] * 5


def test_run(spark):
    out = corpus_pipeline.run(spark, TABLES)
    total = spark.read.parquet(f"{TABLES}/documents.parquet").count()
    assert 0 < out.count() <= total
