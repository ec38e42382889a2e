import corpus_pipeline as pipeline
import oracle
import pytest

from meterlake.llm import queries


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql_twins(spark, folder, name):
    # Disclosing terms show on more documents only.
    folder = folder.replace("sf0.001", "sf0.01") if name.startswith("op6") else folder
    ok, message = oracle.compare(spark, oracle.database(folder), folder, queries.QUERIES[name], queries.SQL[name])
    assert ok, message


def test_all_are_registered():
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{i}" for i in range(1, 14)]


def test_stages_one_by_one(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = docs.columns, docs.count()
    for _, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        rows = docs.collect()
        docs = spark.createDataFrame(rows, docs.schema)
        assert docs.columns == columns and len(rows) <= seen and all(r.n_chars == len(r.text) for r in rows)
        seen = len(rows)
    whole = pipeline.run(spark, folder).collect()
    packed = pipeline.STAGES[-1][1](spark, docs, folder).collect()
    key = lambda rows: sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    assert key(packed) == key(whole) and {r.doc_id for r in whole} == {r.doc_id for r in docs.collect()}
