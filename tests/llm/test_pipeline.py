import corpus_pipeline
from orbweave.llm import decontaminate, neardup, pii, toxicity
from orbweave.llm.common import table

D = "/root/testdata/sf0.001"


def test_stages_equal_their_operators(spark):
    docs = table(spark, D, "documents")
    columns = docs.columns
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    model = toxicity.train(docs, table(spark, D, "labels"))
    clean = {r["doc_id"] for r in toxicity.score(docs, model).where("not toxic").collect()}
    now, ids = docs, set(texts)
    for (name, stage), n in zip(corpus_pipeline.STAGES, range(5), strict=True):
        if name == "packing":
            break
        before, now = now, stage(spark, now, D)
        assert now.columns == columns
        now = now.persist()
        ids = {r["doc_id"] for r in now.collect()}
        if name == "toxicity":
            assert ids == clean
        elif name == "near_duplicates":
            found = {r["doc_id"]: r["class_id"] for r in neardup.classes(before).collect()}
            assert ids == set(found.values())
        elif name == "decontamination":
            assert ids == {r["doc_id"] for r in before.collect()} - {r["doc_id"] for r in decontaminate.contaminated(before, table(spark, D, "benchmark")).collect()}
        elif name == "pseudonyms":
            want = {r["doc_id"]: r["text"] for r in pii.pseudonymise(before).collect()}
            for r in now.collect():
                assert r["text"] == want[r["doc_id"]] and r["n_chars"] == len(r["text"])
    rows = corpus_pipeline.run(spark, D).collect()
    assert {r["doc_id"] for r in rows} == ids
    whole = {}
    for r in rows:
        whole[r["doc_id"]] = whole.get(r["doc_id"], 0) + r["length"]
    assert all(whole[r["doc_id"]] == r["doc_tokens"] for r in rows)


def test_odd_documents_pass_each_stage(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, D)
            assert name == "packing" or out.columns == docs.columns
            out.collect()


def test_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "pseudonyms", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None
