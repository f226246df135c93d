from pyspark.sql import functions as F

from sitewise.llm import secrets as S


def test_rare_credentials_train_the_forest(spark):
    point = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("secrets")), F.lit(1 << 30)) / (1 << 30)
    ids = spark.range(60_000).withColumnRenamed("id", "doc_id")
    rare = [r["doc_id"] for r in ids.where(point > 0.5).orderBy("doc_id").limit(40).collect()]  # outside any 20,000 by that hash
    key = F.substring(F.sha2(F.col("doc_id").cast("string"), 256), 1, 40)
    plain = F.lit("common words and a reasonablylongcompositeword here")
    text = F.when(F.col("doc_id").isin(rare), F.concat(F.lit('zeldzaam token = "'), key, F.lit('" end'))).when(F.col("doc_id") == 59_999, F.concat(F.lit("seen "), key, F.lit(" here"))).otherwise(plain)
    docs = ids.withColumn("text", text)
    model = S.train(docs)
    assert "zeldzaam" in model[0] and model[1] is not None
    found = sorted(r["doc_id"] for r in S.scan(docs, model).where("secret").select("doc_id").collect())
    assert found == sorted([*rare, 59_999])


def test_findings_are_bounded_within_each_label(spark):
    key = F.substring(F.sha2(F.col("id").cast("string"), 256), 1, 40)
    text = F.when(F.col("id") % 300 == 0, F.concat(F.lit('token = "'), key, F.lit('"'))).otherwise(F.concat(F.lit("areasonablylongcompositeword "), F.col("id").cast("string")))
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), text.alias("text"))
    model, again = S.train(docs, rows=50), S.train(docs.repartition(7), rows=50)
    assert model == again
    assert S.scan(docs, model).where("secret").count() == 10
