"""The pipeline against a plain run of its stages."""

import corpus_pipeline
from indicata.llm import toxicity
from tests.llm import test_decontam, test_jaccard
from tests.llm.helpers import messy_documents, prose

SF = "/root/testdata/sf0.01"


def test_stages_keep_the_columns_and_their_rows(spark):
    docs = corpus_pipeline.table(spark, SF, "documents")
    rows = {r.doc_id: r.text for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)
    model = toxicity.train_model(docs, corpus_pipeline.table(spark, SF, "labels"))
    bad = {r.doc_id for r in toxicity.score_documents(docs, model).where("predicted = 1").collect()}
    one = stages["toxicity"](spark, docs, SF)
    assert one.columns == docs.columns and {r.doc_id for r in one.collect()} == set(rows) - bad

    left = [(i, t) for i, t in rows.items() if i not in bad]
    two = stages["near_duplicates"](spark, one, SF)
    want = {i for i, c, _ in test_jaccard.brute(left) if i == c}
    assert two.columns == docs.columns and {r.doc_id for r in two.collect()} == want and two.count() == len(want)

    items = [(r.item_id, r.text) for r in corpus_pipeline.table(spark, SF, "benchmark").collect()]
    three = stages["decontamination"](spark, two, SF)
    # A passage can only be in a text that shares one of its shingles.
    grams = {g for _, t in items for g in test_jaccard.grams(t)}
    near = [(i, rows[i]) for i in want if test_jaccard.grams(rows[i]) & grams]
    leaked = {i for i, _ in test_decontam.brute(near, items)}
    clean = {r.doc_id for r in three.collect()}
    assert three.columns == docs.columns and clean == want - leaked and leaked

    packed = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in packed} == clean
    assert sum(r.n_tokens for r in packed) == sum(len(rows[i].split()) for i in clean)


def test_messy_and_empty_documents(spark):
    docs = messy_documents(spark, [(k, prose(k)) for k in range(20)])
    for frame in (docs, docs.limit(0)):
        out = frame
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, out, SF)
            assert out.columns == docs.columns
        n = out.count()
        assert n == (0 if frame is not docs else docs.count() - 1)  # the repeated row goes
        assert corpus_pipeline.STAGES[-1][1](spark, out, SF).selectExpr("count(DISTINCT doc_id)").first()[0] == (0 if n == 0 else 27)
