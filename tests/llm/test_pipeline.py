import duckdb
import numpy as np
import pytest
import sentencepiece
from llm_brute import near, without_passages, without_windows

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from chronoweave.llm import piece_codec, quality_fm
from chronoweave.llm.common import table
from chronoweave.llm.queries import ORACLE_SQL, QUERIES
from chronoweave.llm.token_counts import model_path

SF = "/root/testdata/sf0.001"
TABLES = "documents pages benchmark labels conversations".split()


def test_one_query_per_operator():
    names = [q for q in queries() if q.startswith("op")]
    assert sorted(int(q[2:].split("_")[0]) for q in names) == list(range(1, 14))
    assert "pipeline" in queries() and set(ORACLE_SQL) <= set(oracle_sql()) & set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries()[name](spark, SF)
    columns = sorted(df.columns)
    result = con.execute(ORACLE_SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    rows = result.fetchall()
    assert sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str) == sorted((tuple(r[names.index(c)] for c in columns) for r in rows), key=str)


def test_stages_on_awkward_documents(spark, docs, tmp_path):
    folder = str(tmp_path)
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, int(i not in (3, 4)), 0) for i in range(0, 100, 2)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, "that long passage went on for many more words than")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    current, before = spark.read.parquet(f"{folder}/documents.parquet"), None
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, current, folder)
        assert out.columns == docs.columns
        out.write.parquet(f"{folder}/{name}")
        current = spark.read.parquet(f"{folder}/{name}")
        assert before is None or current.count() <= before
        before = current.count()
    assert current.where("text like '%that long passage went on for many more words than%'").count() == 0
    last = corpus_pipeline.STAGES[-1][1](spark, current, folder)
    assert last.count() == before


def test_empty_tables(spark, no_docs, tmp_path):
    folder = str(tmp_path)
    no_docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{folder}/pages.parquet")
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(f"{folder}/conversations.parquet")
    for name, query in QUERIES.items():
        assert query(spark, folder).collect() == [], name
    assert corpus_pipeline.run(spark, folder).collect() == []


def test_run_like_brute_force(spark):
    """The whole pipeline on a whole small table; only the classifier's scores are taken as given."""
    docs, labels, benchmark = (table(spark, SF, t) for t in ("documents", "labels", "benchmark"))
    accepted = {r.doc_id for r in quality_fm.scores(docs, quality_fm.train(docs, labels)).where("score >= 0.5").select("row.doc_id").collect()}
    rows = sorted((r.doc_id, r.text) for r in docs.collect() if r.doc_id in accepted)
    assert 100 < len(rows) < 200
    ids, texts = [i for i, _ in rows], [t for _, t in rows]
    rows = [r for r, (_, c) in zip(rows, near(ids, texts, 5, 80)) if r[0] == c]
    texts = without_passages([t for _, t in rows], 200)
    items = [(r.item_id, r.text) for r in benchmark.collect()]
    texts = [without_windows(t, items, 10) for t in texts]
    codec = piece_codec.PieceCodec(model_path())
    library = sentencepiece.SentencePieceProcessor(model_file=model_path())
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert sorted(out) == [i for i, _ in rows] and all(r.roundtrip and r.n_pieces == len(r.piece_ids) for r in out.values())
    flat = np.array([i for r in out.values() for i in r.piece_ids], np.int64)
    data, at = codec.decode(flat, np.array([r.n_pieces for r in out.values()]))
    decoded = {i: data[a:b].tobytes().decode() for i, a, b in zip(out, at, at[1:])}
    assert decoded == {i: t for (i, _), t in zip(rows, texts)}
    assert all(out[i].piece_ids == library.encode(t) for (i, _), t in zip(rows, texts))
