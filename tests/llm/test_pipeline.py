import corpus_pipeline
from granary.llm import decontaminate
from granary.llm.common import table
from tests.llm.test_secrets import brute

SF = "/root/testdata/sf0.001"


def test_stages_against_plain_versions(spark):
    docs = table(spark, SF, "documents")
    kept = corpus_pipeline.good_documents(spark, docs, SF).toPandas()
    labels = table(spark, SF, "labels").toPandas().set_index("doc_id").quality
    known = kept.doc_id[kept.doc_id.isin(labels.index)]
    assert (labels[known] == 1).mean() > 0.97 and len(kept) > 150
    single = corpus_pipeline.single_documents(spark, docs, SF).toPandas()
    assert single.text.is_unique and set(single.columns) == set(docs.columns)
    unseen = corpus_pipeline.unseen_documents(spark, docs, SF).toPandas()
    gone = set(docs.toPandas().doc_id) - set(unseen.doc_id)
    assert gone == {r.doc_id for r in decontaminate.contaminated(docs, table(spark, SF, "benchmark")).collect()}


def test_secrets_are_replaced_and_nothing_else(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    before = docs.toPandas().set_index("doc_id").text
    clean = corpus_pipeline.redacted_documents(spark, docs, "/root/testdata/sf0.01").toPandas().set_index("doc_id")
    assert len(clean) == docs.count() and (clean.n_chars == clean.text.str.len()).all()
    changed = [i for i in clean.index if clean.text[i] != before[i]]
    assert changed and not any(brute(t) for t in clean.text) and sorted(changed) == [i for i in sorted(before.index) if brute(before[i])]


def test_whole_run(spark):
    out = corpus_pipeline.run(spark, SF).toPandas()
    assert out.doc_id.is_unique and out.decodes.all() and (out.n_tokens == out.ids.str.len()).all() and len(out) > 100


def test_every_stage_takes_odd_documents(spark):
    rows = [(1, None, None, None, None), (None, "text here", "en", "s", 9), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (3, "w " * 30_000, "en", "s", 60_000)]
    docs = spark.createDataFrame(rows, table(spark, SF, "documents").schema)
    for df in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            df = stage(spark, df, SF)
        df.collect()


def test_named_stages():
    assert [n for n, _ in corpus_pipeline.STAGES][0] == "quality classifier" and len(corpus_pipeline.STAGES) == 5


def test_stages_send_few_texts_at_a_time(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "10000")
        docs = spark.createDataFrame([(1, "some text"), (2, None)], "doc_id long, text string")
        assert {r.doc_id: r.n_tokens for r in corpus_pipeline.encoded_documents(spark, docs, "").collect()}[2] == 0
        assert int(spark.conf.get(name)) <= 1000
    finally:
        spark.conf.set(name, before)
