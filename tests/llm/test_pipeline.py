import corpus_pipeline
from basketry.llm.queries import ORACLE, QUERIES

TINY = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{TINY}/documents.parquet")
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "jaccard_join", "mixing", "packing"]
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    kept = corpus_pipeline.drop_toxic(spark, docs, TINY).cache()
    assert kept.columns == columns and 0 < kept.count() < docs.count()
    fewer = corpus_pipeline.dedup_lines(spark, kept, TINY).cache()
    lines = [x for r in fewer.collect() for x in (r["text"] or "").split("\n") if any(c.isalnum() for c in x)]
    assert fewer.columns == columns and len(lines) == len(set(lines))
    assert all(set((r["text"] or "").split("\n")) <= set(before[r["doc_id"]].split("\n")) | {""} for r in fewer.collect())
    one = corpus_pipeline.keep_one_of_near_copies(spark, kept, TINY).cache()  # before lines go: copies are whole
    texts = [r["text"] for r in one.collect()]
    assert one.columns == columns and len(texts) == len(set(texts)) < kept.count()
    mixed = corpus_pipeline.mix_sources(spark, one, TINY).cache()
    assert mixed.columns == columns
    packed = corpus_pipeline.pack(spark, mixed, TINY)
    assert {r["doc_id"] for r in packed.collect()} == {r["doc_id"] for r in mixed.collect()}


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES)
