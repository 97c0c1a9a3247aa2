from collections import Counter

import sentencepiece as library

import corpus_pipeline
from ionframe.llm import queries, toxicity
from ionframe.plans.tables import table
from tests.llm import cases
from tests.llm.test_simhash import brute

SF = "/root/testdata/sf0.01"


def test_stages(spark, tmp_path):
    docs = table(spark, SF, "documents")
    columns, steps, cur = docs.columns, {}, docs
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_duplicates", "personal_data", "mixed_sources", "encoded"]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, cur, SF).write.parquet(str(tmp_path / name))
        cur = spark.read.parquet(str(tmp_path / name))
        steps[name] = cur.collect()
        assert name == "encoded" or cur.columns == columns
    before = {r.doc_id: r for r in docs.collect()}
    scored = queries.QUERIES["op7_toxicity"](spark, SF).collect()
    assert {r.doc_id for r in steps["toxicity"]} == {r.doc_id for r in scored if r.score < toxicity.THRESHOLD}
    assert all(r == before[r.doc_id] for r in steps["toxicity"])
    least = brute([(r.doc_id, r.text) for r in steps["toxicity"]])
    assert sorted(r.doc_id for r in steps["near_duplicates"]) == sorted(d for d, _, c in least if d == c)
    assert all(r == before[r.doc_id] for r in steps["near_duplicates"])
    assert sorted(r.doc_id for r in steps["personal_data"]) == sorted(r.doc_id for r in steps["near_duplicates"])
    assert not any(r.text.count("@mail") and "@mail" in r.text and r.text == before[r.doc_id].text for r in steps["personal_data"])
    known = {r.doc_id: r for r in steps["personal_data"]}
    copies = Counter(r.doc_id for r in steps["mixed_sources"])
    assert all(r == known[r.doc_id] for r in steps["mixed_sources"]) and max(copies.values()) <= 3
    words = Counter()
    for r in steps["mixed_sources"]:
        words[r.source] += len(cases.WORDS.findall(r.text))
    assert abs(sum(words.values()) / sum(len(cases.WORDS.findall(r.text)) for r in steps["personal_data"]) - 1) < 0.05
    lib = library.SentencePieceProcessor(model_file=queries.TOKENIZER)
    assert Counter(r.doc_id for r in steps["encoded"]) == copies
    assert all(r.ids == lib.encode(known[r.doc_id].text) and r.round_trip for r in steps["encoded"])


def test_run(spark):
    import __spark_entry__

    got = __spark_entry__.queries()["pipeline"](spark, cases.SF)
    assert got.columns == ["doc_id", "source", "ids", "round_trip"] and got.count() > 0


def test_odd_and_empty_rows(spark):
    names = ["doc_id", "text", "lang", "source", "n_chars", "score"]
    for docs in (cases.odd_docs(spark).select(*names), cases.odd_docs(spark, []).select(*names)):
        cur = docs
        for name, stage in corpus_pipeline.STAGES:
            cur = stage(spark, cur, cases.SF).persist()
            assert name == "encoded" or cur.columns == names
        assert (cur.count() == 0) == (docs.count() == 0)
