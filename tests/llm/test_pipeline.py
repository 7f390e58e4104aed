import corpus_pipeline
from newsroster.llm.common import stored


def test_stages(spark, odd, docs):
    base = " ".join(f"word{k} the" for k in range(40))
    rows = odd.select("doc_id", "text", "lang", "source").unionByName(docs(
        (50, base, "en", "a"), (51, base.upper(), "en", "a"), (52, base + " more", "en", "b"),
        (53, "1234 !", "en", "b"), clash=False))
    df, seen = rows, {}
    for name, stage in corpus_pipeline.STAGES:
        df = stored(stage(spark, df, ""), "test-stage")
        seen[name] = [r.doc_id for r in df.select("doc_id").collect()]
        if name != "sentencepiece":
            assert df.columns == rows.columns
    assert 53 not in seen["language ID"] and 7 not in seen["language ID"] and 50 in seen["language ID"]
    assert 51 not in seen["exact dedup"] and 4 not in seen["exact dedup"] and 52 in seen["exact dedup"]
    assert 52 not in seen["near dedup"] and 50 in seen["near dedup"]
    assert sorted(map(str, seen["mixing"])) == sorted(map(str, seen["sentencepiece"]))
    assert df.where("pieces IS NULL").count() == 0


def test_empty(spark, odd):
    df = odd.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        df = stored(stage(spark, df, ""), "test-stage")
    assert df.count() == 0


def test_run(spark):
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() > 0
