import corpus_pipeline
import pytest

from paperloom.llm import decontamination, entry, near_duplicates, packing, pii, quality, simhash

CONTRACT = {
    "op1_pii": "doc_id n_email n_ip n_card n_phone base_sha256 spans", "op2_simhash": "doc_id fingerprint component_id", "op3_url_filter": "page_id host path rule verdict",
    "op4_toxicity": "doc_id held_out score predicted", "op6_quality_rules": "doc_id held_out score predicted", "op7_bit_sliced_topk": "query_id rank vec_id score",
    "op8_sharding": "doc_id size text_crc32 law shard slot grown_shard", "op9_html_extraction": "page_id url text n_chars",
}


@pytest.mark.parametrize("name", CONTRACT)
def test_contract_columns(spark, data, name):
    assert set(CONTRACT[name].split()) <= set(entry.queries()[name](spark, data).columns)


def test_stages_keep_the_columns_and_their_decisions(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    labels, benchmark = (spark.read.parquet(f"{data}/{t}.parquet") for t in ("labels", "benchmark"))
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    model = quality.fit(docs, labels)
    good = {r.doc_id for r in quality.score(docs, model).where("score >= 0.3").collect()}
    one = corpus_pipeline.STAGES[0][1](spark, docs, data)
    assert one.columns == docs.columns and ids(one) == good
    groups = {(r.doc_id, r.component_id) for r in near_duplicates.near_duplicates(one).collect()}
    two = corpus_pipeline.STAGES[1][1](spark, one, data)
    assert two.columns == docs.columns and ids(two) == {c for _, c in groups}
    leaked = ids(decontamination.find_leaks(two, benchmark))
    three = corpus_pipeline.STAGES[2][1](spark, two, data)
    assert three.columns == docs.columns and ids(three) == ids(two) - leaked
    four = corpus_pipeline.STAGES[3][1](spark, three, data)
    before = {r.doc_id: r.text for r in three.collect()}
    assert four.columns == docs.columns and four.schema == docs.schema
    assert {r.doc_id: r.text for r in four.collect()} == {i: pii.redact(t) for i, t in before.items()}
    five = corpus_pipeline.STAGES[4][1](spark, four, data)
    assert ids(five) == ids(four) and sorted(map(tuple, five.collect())) == sorted(map(tuple, packing.pack(four).collect()))
    assert sorted(map(tuple, corpus_pipeline.run(spark, data).collect())) == sorted(map(tuple, five.collect()))


def test_odd_documents_pass_every_stage(spark, data):
    schema = "doc_id long, text string, lang string, source string, n_chars long, _id string, _t int, _s_text string, _s_values int, score double, found string, _component string, _group int"
    extra = ("x", 1, "y", 2, 0.5, "z", "c", 3)
    long = "A sentence with a few words stands in a long text. " * 4000
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, long, "en", "s", 1), (3, long, "en", "s", 1), (None, "no id here", "en", "s", 1), (4, " \n ", None, "s", 3), (5, "x" * 100_000, "en", None, 9)]
    docs = spark.createDataFrame([(*r, *extra) for r in rows], schema)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, data)
        assert got.columns == docs.columns and got.count() <= len(rows)
        assert stage(spark, docs.limit(0), data).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, data).count() >= len(rows)
    assert near_duplicates.near_duplicates(docs).count() == pii.detect(docs).count() == len(rows)
