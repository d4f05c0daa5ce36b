"""The corpus pipeline, stage by stage, on the smallest tables."""

import corpus_pipeline
from tessera.llm import decontaminate, queries, sentencepiece_codec

SF = "/root/testdata/sf0.001"


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept, frames = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        kept = stage(spark, kept, SF)
        if name != "tokens":
            assert kept.columns == docs.columns
        frames[name] = kept.cache()
    ids = {name: {r.doc_id for r in f.collect()} for name, f in frames.items()}
    scores = {r.doc_id: r.predicted for r in queries.op6_quality(spark, SF).collect()}
    assert ids["quality"] == {i for i, p in scores.items() if p == 1}
    assert ids["near_duplicates"] < ids["quality"] and ids["tokens"] == ids["personal_data"] == ids["benchmark_leaks"]
    leaks = decontaminate.find_leaks(frames["near_duplicates"], spark.read.parquet(f"{SF}/benchmark.parquet"))
    assert ids["near_duplicates"] - ids["benchmark_leaks"] == {r.doc_id for r in leaks.collect()}
    texts = {r.doc_id: r for r in frames["personal_data"].collect()}
    assert not any("@mail" in r.text for r in texts.values()) and all(r.n_chars == len(r.text) for r in texts.values())
    back = sentencepiece_codec.decode_documents(frames["tokens"]).collect()
    assert all(r.text == texts[r.doc_id].text for r in back) and len(back) == len(texts)
    assert {r.doc_id for r in corpus_pipeline.run(spark, SF).collect()} == ids["tokens"]


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.collect() == []


def test_odd_rows(spark):
    """Null and repeated ids, null, empty and long texts, clashing columns."""
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    item = max(items, key=lambda t: len(t.split()))
    plain = " ".join(f"word{k} and" for k in range(60))
    long = " ".join(f"long{k}" for k in range(50_000))
    rows = [(1, plain), (1, plain), (None, plain), (None, plain + " more"), (2, item), (2, "another text under the same id as that"), (None, item),
            (3, None), (4, ""), (None, ""), (5, long), (5, long), (6, "write to someone@mail.example now")]
    docs = spark.createDataFrame([(i, t, None if t is None else len(t), "a", "b", 7) for i, t in rows],
                                 "doc_id long, text string, n_chars long, row string, component_id string, n_pseudonyms long")
    one = corpus_pipeline.near_duplicates(spark, docs, SF)
    assert one.columns == docs.columns
    held = sorted((r.text or "?" for r in one.collect()), key=len)
    assert len(held) == 8 and held.count(item) == 1 and held.count(long) == 1 and sum(t.startswith("word0 and") for t in held) == 1
    two = corpus_pipeline.benchmark_leaks(spark, docs, SF)
    assert two.columns == docs.columns and sorted(map(str, (r.text for r in two.collect()))) == sorted(str(t) for _, t in rows if t != item)
    three = corpus_pipeline.personal_data(spark, docs, SF).collect()
    assert len(three) == len(rows) and {r.n_pseudonyms for r in three} == {7} and not any("@mail" in (r.text or "") for r in three)
    assert corpus_pipeline.tokens(spark, docs, SF).count() == len(rows)
    assert corpus_pipeline.quality(spark, docs, SF).columns == docs.columns
