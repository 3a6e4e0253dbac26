"""The pipeline's stages on a small table with planted cases, each judged on its own input."""

import random

import corpus_pipeline
from stratalake.llm import compression, jaccard_join
from stratalake.llm.queries import table as given

SF = "/root/testdata/sf0.001"


def test_stages_follow_their_order_and_keep_columns(spark, tmp_path):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "ngram_jaccard_join", "suffix_array_dedup", "benchmark_decontamination", "best_fit_packing"]
    docs = given(spark, SF, "documents")
    whole, columns = docs, docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{name}")
        after = spark.read.parquet(f"{tmp_path}/{name}")
        assert set(after.columns) == set(columns) and after.count() <= docs.count()
        docs = after
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == {r.doc_id for r in docs.collect()}
    assert 0.5 * whole.count() < docs.count() < whole.count()
    run = corpus_pipeline.run(spark, SF)
    pieces = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, run.select(pieces).collect())) == sorted(map(tuple, packed.select(pieces).collect()))


def test_each_stage_decides_on_its_own_input(spark):
    rng = random.Random(3)
    text = lambda n: " ".join(rng.choice(["the", "of", "thonea", "reat", "hanon", "ere", "tion"]) + str(rng.randrange(100)) for _ in range(n))
    item = given(spark, SF, "benchmark").first().text
    passage, near = text(80), text(120)
    texts = {1: text(100), 2: near, 3: near + " end", 4: near, 5: text(60) + " " + passage, 6: passage + " " + text(60), 7: text(20) + " " + item + " " + text(20), 8: None}
    docs = spark.createDataFrame([(k, t, "en", "s", len(t or "")) for k, t in texts.items()], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    stages = dict(corpus_pipeline.STAGES)
    kept = {r.doc_id for r in stages["ngram_jaccard_join"](spark, docs, SF).collect()}
    assert kept == {1, 2, 5, 6, 7, 8}
    cut = {r.doc_id: r for r in stages["suffix_array_dedup"](spark, docs.where("doc_id in (1, 5, 6, 7, 8)"), SF).collect()}
    assert passage[50:-50] not in cut[5].text and passage[50:-50] not in cut[6].text and cut[1].text == texts[1] and cut[8].text is None
    assert cut[5].n_chars == len(cut[5].text) < len(texts[5]) - 300
    clean = {r.doc_id for r in stages["benchmark_decontamination"](spark, docs, SF).collect()}
    assert clean == set(texts) - {7}


def test_quality_stage_is_the_classifier(spark):
    docs, labels = given(spark, SF, "documents"), given(spark, SF, "labels")
    good = {r.doc_id for r in compression.report(docs, labels).where("predicted = 1").collect()}
    assert {r.doc_id for r in corpus_pipeline.quality(spark, docs, SF).collect()} == good
    assert corpus_pipeline.near_copies(spark, docs, SF).count() <= jaccard_join.report(docs).count()


def test_passages_of_over_50_short_words_go(spark):
    rng = random.Random(5)
    text = lambda n: " ".join(rng.choice("abcdefghij") + str(rng.randrange(100)) for _ in range(n))
    texts = {}
    for n in (50, 51, 55, 60):
        passage = text(n)
        texts |= {n: f"{text(40)}\n{passage} {text(30)}", n + 100: f"{text(20)} {passage}\n{text(50)}"}
    letters = " ".join(rng.choice("abcdefghij") for _ in range(51))
    texts |= {1: letters + " " + text(20), 2: text(20) + " " + letters}
    docs = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in texts.items()], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    left = {r.doc_id: len(r.text.split()) for r in corpus_pipeline.passages(spark, docs, SF).collect()}
    assert left == {50: 120, 150: 120, 51: 70, 151: 70, 55: 70, 155: 70, 60: 70, 160: 70, 1: 20, 2: 20}
