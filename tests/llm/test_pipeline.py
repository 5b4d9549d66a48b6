import corpus_pipeline as p
from stationlake.llm import bpe


def test_stages_hand_on_documents_and_take_effect(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    ids = [{r["doc_id"] for r in docs.collect()}]
    for k, (name, stage) in enumerate(p.STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{tmp_path}/{k}")
        out = spark.read.parquet(f"{tmp_path}/{k}")
        if k < len(p.STAGES) - 1:
            assert out.columns == docs.columns, name
            docs = out
        ids.append({r["doc_id"] for r in out.select("doc_id").collect()})
        assert ids[-1] <= ids[-2]
    assert len(ids[1]) < len(ids[0]) and len(ids[2]) < len(ids[1])
    # line dedup has shortened the copies before; on its own input the near-duplicate stage drops them too
    raw = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert p.near(spark, raw, sf_dir).count() < raw.count()
    import public_tokenizers as P

    ranks = bpe.load_ranks(P.path("byte_bpe_50k.tiktoken"))
    some = {(r["doc_id"], r["text"]) for r in docs.limit(20).collect()}
    rows = {(r["doc_id"], r["n_tokens"]) for r in out.collect()}
    assert all((d, len(bpe.reference_ids(t, ranks, P.PATTERN))) in rows for d, t in some)
    assert out.count() == docs.count() == p.run(spark, sf_dir).count()
