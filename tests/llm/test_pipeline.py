"""The pipeline's stages on a small corpus, and the queries with SQL against DuckDB."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from tidemark.llm import queries

FOLDER = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="test tables not present")


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for f in FOLDER.glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    df = queries.queries()[name](spark, str(FOLDER))
    result = con.execute(queries.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert sorted(map(str, df.select(columns).collect())) == sorted(map(str, spark.createDataFrame(result.fetchall(), df.select(columns).schema).collect()))


def test_stages_equal_plain_versions(spark, tmp_path):
    """Each stage's rows, from the rows the stage before it left."""
    from pyspark.sql import functions as F
    from tokenizers import Tokenizer

    from tidemark.llm import quality

    from .test_dedup import kept_by_scan, one_of_each_by_pairs

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, before, left = docs.columns, None, []
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.withColumn("_n", F.monotonically_increasing_id()).orderBy("_n").collect()
        stage(spark, docs, str(FOLDER)).write.parquet(str(tmp_path / str(n)))
        docs = spark.read.parquet(str(tmp_path / str(n)))
        after = docs.collect()
        left.append(len(after))
        if n < 4:
            assert docs.columns == columns
        kept = {r["doc_id"]: r for r in after}
        if n == 0:
            weights = queries.quality_weights(spark, str(FOLDER))
            assert set(kept) == {r["doc_id"] for r in before if quality.score_of((r["text"] or "").encode(), weights) >= 0.3}
        elif n == 1:
            assert set(kept) == set(one_of_each_by_pairs([(r["doc_id"], r["text"]) for r in before]))
        elif n == 2:
            plain = kept_by_scan([r["text"] for r in before], corpus_pipeline.PASSAGE_BYTES)
            changed = [t for t, r in zip(plain, before, strict=True) if t != r["text"]]
            assert changed
            by_id = {r["doc_id"]: t for t, r in zip(plain, before, strict=True)}
            assert {d: r["text"] for d, r in kept.items()} == by_id
        elif n == 3:
            assert set(kept) == {r["doc_id"] for r in before}
        else:
            words = Tokenizer.from_file(queries.tokenizer("word_bpe_49k.json"))
            ids = {r["doc_id"]: len(words.encode(r["text"] or "", add_special_tokens=False).ids) + 1 for r in before}
            lengths: dict = {}
            for r in after:
                lengths[r["doc_id"]] = lengths.get(r["doc_id"], 0) + r["length"]
            assert lengths == ids
            assert docs.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 4096").count() == 0
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").where("quality = 1")
    good = labels.join(spark.read.parquet(str(tmp_path / "0")), "doc_id").count()
    assert good >= 0.97 * labels.count() and left[1] < left[0]


@pytest.mark.parametrize("stage", range(5))
def test_stages_on_odd_rows(spark, docs, no_docs, clashing, stage):
    name, run = corpus_pipeline.STAGES[stage]
    for rows in (docs, no_docs, clashing):
        out = run(spark, rows, str(FOLDER))
        assert out.count() <= rows.count() + 5
        if stage < 4:
            assert out.columns == rows.columns
