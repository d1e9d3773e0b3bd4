import brute_llm as brute
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from loadlens.llm import language, packing, quality, secrets
from __spark_entry__ import oracle_sql, queries


@pytest.fixture(scope="module")
def small(spark, sf, documents, odd_docs, tmp_path_factory):
    """Some of the driver's documents with planted odd rows, as the tables of a folder."""
    path = str(tmp_path_factory.mktemp("tables"))
    odd = odd_docs.select(documents.columns).where("doc_id is not null").withColumn("doc_id", F.col("doc_id") + 5_000_000)
    planted = spark.createDataFrame(
        [(6_000_000, "here is password = abcdefghijklmnop and more words of a text", "en", "p", 60)], documents.schema
    )
    documents.where("doc_id % 4 = 0").unionByName(odd).unionByName(planted).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.read.parquet(f"{sf}/labels.parquet").write.parquet(f"{path}/labels.parquet")
    return path


def test_pipeline_is_its_stages_one_after_the_other(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").cache()
    labels = spark.read.parquet(f"{small}/labels.parquet")
    good = {r.doc_id for r in quality.score_documents(docs, labels).where("predicted = 1").collect()}
    left = docs.where(F.col("doc_id").isin(list(good))).cache()
    bars = language.held_out_bars(left, language.train(left.where(~language.held_out())))
    least = lambda lang, text: max(language.MIN_SCORE, bars.get(lang, bars[None])[language.length_class(text)])
    judged = language.identify(left).join(left.select("doc_id", "text"), "doc_id").collect()
    spoken = {r.doc_id for r in judged if r.lang_pred != "und" and r.score >= least(r.lang_pred, r.text)}
    texts = {r.doc_id: r.text for r in left.collect() if r.doc_id in spoken}
    kept = {i for i, (_, c) in brute.near_duplicates(texts).items() if i == c}
    masked = {i: secrets.mask_spans(texts[i], secrets.find_spans(texts[i])) for i in kept}
    want = {i: [*packing.token_ids([t])[0].tolist(), 0] for i, t in masked.items()}
    rows = corpus_pipeline.run(spark, small).collect()
    import zlib

    got = {}
    for r in rows:
        ids = np.array(want[r.doc_id][r.start : r.start + r.length], "<u4")
        assert len(ids) == r.length and zlib.crc32(ids.tobytes()) == r.ids_crc32 and r.doc_tokens == len(want[r.doc_id])
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
    assert got == {i: len(x) for i, x in want.items()} and len(got) > 100
    assert 0 < len(good) < docs.select("doc_id").distinct().count() and len(spoken) < len(good) and len(kept) < len(spoken)


def test_stages_return_the_columns_of_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.withColumn("extra", F.lit(1)), small).columns == docs.columns, name
    out = corpus_pipeline.secrets_stage(spark, docs, small).where("doc_id = 6000000").first()
    assert "abcdefghijklmnop" not in out.text and out.n_chars == len(out.text)


def test_pipeline_of_nothing(spark, tmp_path):
    path = str(tmp_path)
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    assert corpus_pipeline.run(spark, path).count() == 0


def test_all_are_registered():
    names = queries()
    assert "pipeline" in names and {f"op{n}" for n in range(1, 14)} == {k.split("_")[0] for k in names if k.startswith("op") and k[2].isdigit()}
    assert set(oracle_sql()) <= set(names)
