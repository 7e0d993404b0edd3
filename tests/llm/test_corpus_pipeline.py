import corpus_pipeline as cp

from ledgerflow.llm.common import read_documents

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_take_effect(spark):
    docs = read_documents(spark, SF)
    before = docs.count()
    for name, stage in cp.STAGES[:3]:
        out = stage(spark, docs, SF)
        assert out.columns == list(cp.COLUMNS), name
        docs = cp.materialize(out, "test")
        assert 0 < docs.count() <= before
        before = docs.count()


def test_one_of_a_group_stays(spark):
    text = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(3, text, "en", "s", 1), (2, text, "en", "s", 1), (2, text, "en", "s", 1), (None, text, None, None, None), (9, "quite another text", "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = cp.near_duplicates(spark, docs, SF).collect()
    assert sorted(r.doc_id for r in kept) == [2, 9]


def test_run_is_the_stages_in_order(spark):
    out = cp.run(spark, SF)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() > 0
