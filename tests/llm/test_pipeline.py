"""The pipeline's stages, each on the rows of the one before."""

from conftest import DATA


def written(spark, df, path):
    df.write.parquet(str(path))
    return spark.read.parquet(str(path))


def test_stages(spark, tmp_path):
    import corpus_pipeline as P

    sf = f"{DATA}/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, before = docs.columns, docs.count()
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    sizes = [before]
    for name, stage in P.STAGES:
        out = written(spark, stage(spark, docs, sf), tmp_path / name)
        sizes.append(out.count())
        if name != P.STAGES[-1][0]:
            assert out.columns == columns
            assert out.where("n_chars != coalesce(char_length(text), 0)").count() == 0
        if name == "quality classifier":
            kept = {r["doc_id"] for r in out.collect()}
            assert all(labels[i] == 1 for i in labels if i in kept) and all(i in kept for i in labels if labels[i] == 1)
        docs = out
    assert sizes[1] <= before and sizes[2] <= sizes[1] and sizes[3] == sizes[2] and sizes[5] == sizes[4]
    assert {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"} <= set(docs.columns)


def test_stages_on_no_rows(spark, tmp_path):
    import corpus_pipeline as P

    sf = f"{DATA}/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for name, stage in P.STAGES:
        docs = written(spark, stage(spark, docs, sf), tmp_path / name)
        assert docs.count() == 0
