"""The pipeline's stages, one after the other, on a small corpus."""

import corpus_pipeline


def test_stages(spark, tmp_path):
    base = "the quick brown fox jumps over the lazy dog and then it goes home to sleep in the warm house near the old river bank"
    rows = [(i, base if i < 5 else " ".join(f"{w}{chr(97 + i % 26)}{chr(97 + i // 26)}" for w in base.split()), "en", f"s{i % 3}", 0) for i in range(60)]
    rows += [(60, None, "en", "s0", 0), (61, "1234 5678", "en", "s1", 9), (62, "password: hunter2hunter2 is what they used in this one place and nowhere else at all", "en", "s2", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        seen[name] = docs
        assert name == "best_fit_packing" or docs.columns == columns
    ids = lambda n: {r.doc_id for r in seen[n].collect()}
    assert ids("language_id") == set(range(60)) | {62}
    assert ids("near_dedup") & set(range(5)) == {0}
    secret = next(r for r in seen["secret_scan"].collect() if r.doc_id == 62)
    assert "hunter2" not in secret.text and "[SECRET]" in secret.text
    packed = seen["best_fit_packing"]
    assert packed.count() >= seen["mix_sources"].count()
