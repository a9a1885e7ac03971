"""The pipeline: every stage's decision, and the whole against the stages one by one."""

from eventloom.llm import decontam, jaccard, langid, line_dedup
from eventloom.llm.common import table


def test_stages(spark, sf, tmp_path):
    import corpus_pipeline as p

    docs = table(spark, sf, "documents")
    columns, seen = docs.columns, []
    for name, stage in p.STAGES:
        out = f"file://{tmp_path}/{name}"
        stage(spark, docs, sf).write.parquet(out)
        before, docs = docs, spark.read.parquet(out)
        seen.append((name, before, docs))
        if name != p.STAGES[-1][0]:
            assert docs.columns == columns
    ids = [{r["doc_id"] for r in d.select("doc_id").collect()} for _, _, d in seen]
    assert all(a >= b for a, b in zip(ids, ids[1:]))
    language, lines, near, clean, tokens = (b for _, b, _ in seen)
    kept = {r["doc_id"] for r in langid.predict(language, langid.fit(langid.training_rows(language))).filter("language.lang <> 'und' AND language.score >= 0.3").collect()}
    assert ids[0] == kept
    texts = {r["doc_id"]: r["text"] for r in near.collect()}
    assert texts == {r["doc_id"]: r["text"] for r in line_dedup.op8_line_dedup(lines).collect() if r["removed"] is None or r["text"].strip()}
    assert ids[2] == {r["component_id"] for r in jaccard.op5_ngram_jaccard(near).collect()}
    held = {r["doc_id"] for r in decontam.op1_decontaminate(clean, table(spark, sf, "benchmark")).collect()}
    assert held and ids[3] == ids[2] - held
    assert {r["doc_id"]: len(r["ids"]) for r in seen[-1][2].collect()} == {r["doc_id"]: r["n_tokens"] for r in p.run(spark, sf).collect()}
    assert tokens.count() == len(ids[3])


def test_stages_on_empty_null_and_repeated_input(spark, sf, tmp_path):
    import corpus_pipeline as p

    columns = "doc_id long, text string, lang string, source string, n_chars long"
    long = "the same long passage of words that stands in two documents " * 6
    some = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, " \n\n", "en", "s", 3), (4, long, "en", "s", 9), (5, long, "en", "s", 9), (5, long, "en", "s", 9), (None, "text without an id", "en", None, None), (7, "12345 67", "en", "s", 8), (8, "ein kurzer Text ohne Kopie", "de", "s", 1)]
    for k, rows in enumerate(([], [(1, None, None, None, None)], some)):
        docs = spark.createDataFrame(rows, columns)
        for name, stage in p.STAGES:
            out = f"file://{tmp_path}/{k}-{name}"
            stage(spark, docs, sf).write.parquet(out)
            before, docs = docs, spark.read.parquet(out)
            assert docs.count() <= before.count()
            assert name == p.STAGES[-1][0] or docs.columns == before.columns
        if k < 2:
            assert docs.count() == 0
        else:  # no text, blank ones, digits alone and copies are gone, the rest is whole
            assert {r.doc_id for r in docs.collect()} - {None} == {4, 8}
