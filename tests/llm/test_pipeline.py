from collections import Counter

import corpus_pipeline
from recurwork.llm import bpe, langid, ngram_join, secrets
from recurwork.llm.common import table, written

SF = "/root/testdata/sf0.001"


def test_each_stage_works_on_what_its_predecessor_kept(spark):
    docs = table(spark, SF, "documents")
    at = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, written(stage(spark, docs, SF), name)
        at[name] = before, docs
        if name != "tokens":
            assert docs.columns == before.columns
    rows = {n: ({r.doc_id: r for r in a.collect()}, {r.doc_id: r for r in b.collect()}) for n, (a, b) in at.items()}

    before, after = rows["language"]
    model = langid.learn(spark, at["language"][0])
    tables = langid.tables()
    for i, r in before.items():
        counts, letters = langid.grams(r.text or "", tables)
        assert (i in after) == bool(letters and model.predict(counts)[1] >= langid.least_score(len(model.langs), 1 / 3))

    before, after = rows["near_copies"]
    classes = {r.doc_id: r.class_id for r in ngram_join.join_similar(at["near_copies"][0]).collect()}
    assert after.keys() == set(classes.values()) < before.keys()

    before, after = rows["secrets"]
    assert after.keys() == before.keys()
    assert all(after[i].text == secrets.redact(r.text, "[SECRET]") and after[i].n_chars == len(after[i].text) for i, r in before.items())

    before, after = rows["mix"]
    words = lambda part: sum(len(r.text.split()) for r in part.values())
    assert after.keys() <= before.keys() and 0.8 * words(before) < words(after) <= 0.9 * words(before)
    assert at["mix"][1].count() == len(after)

    before, after = rows["tokens"]
    import public_tokenizers as P
    own = bpe.codec(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    assert after.keys() == before.keys() and all(after[i].n_tokens == len(own.encode(r.text)) for i, r in before.items())


def test_run_gives_the_rows_of_the_stages(spark):
    a, b = (Counter(tuple(r) for r in corpus_pipeline.run(spark, SF).collect()) for _ in range(2))
    assert a == b and a
