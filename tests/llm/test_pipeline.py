import corpus_pipeline
import __spark_entry__ as entry
from common import SF, empty, odd  # noqa: F401
from quotelake.llm import registry


def test_stages_keep_columns_and_survive_odd_rows(spark, odd, tmp_path):
    extra = odd.selectExpr("*", "'mine' kept", "'mine' hits", "'mine' `a b`")
    for name, docs in (("odd", extra), ("empty", empty(extra))):
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, SF)
            if k < len(corpus_pipeline.STAGES) - 1:
                assert out.columns == extra.columns
            path = str(tmp_path / f"{name}-{k}")
            out.write.parquet(path)
            docs = spark.read.parquet(path)


def test_run_is_its_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs.count()
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / str(k))
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
    whole = corpus_pipeline.run(spark, SF)
    assert sorted(map(str, whole.collect())) == sorted(map(str, docs.collect()))
    assert 0 < whole.count() < before and whole.where("not round_trip").count() == 0


def test_queries_are_registered():
    names = entry.queries()
    assert set(registry.queries()) <= set(names) and names["pipeline"] is corpus_pipeline.run
    assert sorted(int(n[2:].split("_")[0]) for n in registry.queries()) == list(range(1, 11))
