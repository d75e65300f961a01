import json

import corpus_pipeline
from pyspark.sql import functions as F
from tests.llm.test_decontaminate import brute as windows_of
from tests.llm.test_packing import check, reference_tokenizer  # noqa: F401
from tests.llm.test_simhash import brute_components, brute_fingerprint

from tidemark.llm import langid
from tidemark.llm.queries import table
from tidemark.llm.texts import bucket_of_id

SMALL = "/root/testdata/sf0.001"


def test_run_against_brute_force(spark, reference_tokenizer):  # noqa: F811
    documents = [tuple(r) for r in table(spark, SMALL, "documents").select("doc_id", "text").collect()]
    kept = [(d, t) for d, t in documents if any(map(str.isalpha, t or ""))]
    parts = brute_components([brute_fingerprint(t) for _, t in kept], [d for d, _ in kept])
    kept = [(d, t) for (d, t), first in zip(kept, parts, strict=True) if d == first]
    items = [tuple(r) for r in table(spark, SMALL, "benchmark").collect()]
    hits = {d for d, _, n, _ in windows_of(kept, items) if n}
    kept = [(d, t) for d, t in kept if d not in hits]
    assert 0 < len(kept) < len(documents)
    check(corpus_pipeline.run(spark, SMALL).collect(), kept, reference_tokenizer, 2048)


def test_stages_keep_columns_and_odd_rows(odd_documents, no_documents, spark, tmp_path):
    spark.createDataFrame([(1, "b c d e")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = odd_documents
    expected = {"language": {4, 5, 6, 8, 9}, "near_duplicates": {4, 6, 8, 9}, "decontaminate": {4, 6, 8}, "pack": {4, 6, 8}}
    for name, stage in corpus_pipeline.STAGES:
        before = docs.columns
        docs = corpus_pipeline.store(stage(spark, docs, str(tmp_path)), name)
        assert {r.doc_id for r in docs.select("doc_id").collect()} == expected[name]
        if name != "pack":
            assert docs.columns == before
        assert stage(spark, no_documents, str(tmp_path)).count() == 0


def test_language_stage_rejects_what_has_no_clear_language(spark):
    documents = table(spark, SMALL, "documents")
    found = langid.identify(documents, bucket_of_id(documents.doc_id, 5) != 0)
    gone = found.where("lang_pred = 'und' or score < 0.4").count()
    left = corpus_pipeline.language(spark, documents, SMALL)
    assert left.count() + gone == documents.count()
    assert json.dumps(left.schema.jsonValue()) == json.dumps(documents.schema.jsonValue())
    # The prediction decides: by language and by score.
    french = corpus_pipeline.language(spark, documents, SMALL, languages=["fr"])
    predicted = {r.doc_id for r in found.where("lang_pred = 'fr'").collect()}
    assert 0 < len(predicted) < documents.count() and {r.doc_id for r in french.collect()} <= predicted
    assert corpus_pipeline.language(spark, documents, SMALL, min_score=1.1).count() == 0


def test_without_labels_only_texts_without_letters_go(spark, odd_documents):
    documents = table(spark, SMALL, "documents").withColumn("lang", F.lit(None).cast("string"))
    with_letters = {r.doc_id for r in documents.collect() if any(map(str.isalpha, r.text or ""))}
    assert {r.doc_id for r in corpus_pipeline.language(spark, documents, SMALL).collect()} == with_letters
    odd = odd_documents.withColumn("lang", F.lit(None).cast("string"))
    assert {r.doc_id for r in corpus_pipeline.language(spark, odd, SMALL).collect()} == {4, 5, 6, 8, 9}
