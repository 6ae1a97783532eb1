"""Operators and stages on tables whose columns have the names that the operators use themselves, or odd ones."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cdcmart.llm import common, langid, secretscan
from cdcmart.sinks import files

SMALL = "/root/testdata/sf0.001"
NAMES = "id node none _node _key row examples added spans row_id hash owner key kept doc tokens a.b a`b n_words items lang_pred score c0".split()


@pytest.fixture(scope="module")
def odd(spark):
    """The documents with columns of those names, with null ids, repeated rows and odd texts."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    more = [(None, None, "en", "s", 0), (None, "", None, None, None), (5, "token: abcdefgh1234567890", "en", "s", 3), (None, "the of and to in " * 40, "en", "s", 5)]
    docs = docs.unionByName(spark.createDataFrame(more, docs.schema)).unionByName(docs.limit(20))
    quoted = {n: F.lit(i) for i, n in enumerate(NAMES)}
    for name, value in quoted.items():
        docs = docs.withColumn(name, value)
    return docs


def test_stages_keep_columns_of_any_name(spark, odd, tmp_path):
    docs, kept = odd, []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SMALL).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        kept.append(docs.count())
        if k < 4:
            assert docs.columns == odd.columns, name
            assert docs.first()[len(docs.columns) - len(NAMES):] == tuple(range(len(NAMES)))
    assert kept[0] > kept[1] > kept[2] == kept[3] == kept[4] > 0


def test_stages_without_the_others_before_them(spark, odd):
    plain = odd.select(*odd.columns[:5])
    for name, stage in corpus_pipeline.STAGES[1:4]:
        assert sorted(map(str, stage(spark, odd, SMALL).select(*plain.columns).collect())) == sorted(
            map(str, stage(spark, plain, SMALL).collect())), name


def test_secrets_are_found_beside_such_columns(odd):
    found = secretscan.find_secrets(odd)
    assert found.columns == [*odd.columns, "spans_"] and found.count() == odd.count()
    assert found.where(F.size("spans_") > 0).count() > 0
    assert secretscan.masked(odd).columns == odd.columns


def test_a_frequent_id_does_not_fill_the_sample(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(langid, "train", lambda pieces: seen.append(pieces))
    rows = spark.range(20_000).select(
        F.lit(0).cast("long").alias("doc_id"), F.lit("xx").alias("lang"), F.concat(F.lit("some words "), F.col("id")).alias("text")
    )
    same = spark.range(5000).select(F.lit(1).cast("long").alias("doc_id"), F.lit("yy").alias("lang"), F.lit("the same").alias("text"))
    rare = spark.createDataFrame([(0, f"z{i}", "a rare one") for i in range(100)], "doc_id long, lang string, text string")
    docs = rows.unionByName(same).unionByName(rare)
    langid.fit(docs)
    (pieces,) = seen
    by = {lang: sum(p[0] == lang for p in pieces) for lang in {p[0] for p in pieces}}
    assert 300 < by["xx"] < 900 and by.get("yy", 0) <= 1
    assert sum(n for lang, n in by.items() if lang.startswith("z")) == 100
    assert langid.least_score(4) == 0.4 and langid.least_score(1) == 0.5 and langid.least_score(0) == 0.5


def test_written_tables_are_removed_on_request(spark):
    docs = spark.createDataFrame([(1, "token=abcdef1234567890xyz", "s")], "doc_id long, text string, source string")
    other = common._folders.pop(spark.sparkContext.applicationId, [])
    assert secretscan.report(docs).count() == 1
    (folder,) = common._folders[spark.sparkContext.applicationId]
    assert files.exists(spark, folder)
    assert common.clean_up(spark) == [folder] and not files.exists(spark, folder)
    assert common.clean_up(spark) == []
    common._folders[spark.sparkContext.applicationId] = other
