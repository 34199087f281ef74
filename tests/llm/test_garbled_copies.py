"""A damaged text that many rows repeat is still improbable."""

from pyspark.sql import functions as F

from conftest import SF
from jurisdiff.llm.queries import p3_found


def test_copies_of_a_garbled_text_do_not_make_it_probable(spark, tmp_path):
    # sf0.01: in fewer texts even a pair seen once is a notable share
    bad = "監督当局は追加費用なしで学習データの出所を収集し始めた。".encode("cp932").decode("gb18030")
    u = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/updates.parquet")
    n = u.count()
    copies = u.limit(n // 2).withColumn("row_key", F.col("row_key") + 1_000_000).withColumn("title", F.lit(bad))
    u.unionByName(copies).write.parquet(f"{tmp_path}/updates.parquet")
    found = {r.row_key for r in p3_found(spark, str(tmp_path)).where("field = 'title'").collect()}
    assert found >= {r.row_key for r in spark.read.parquet(f"{tmp_path}/updates.parquet").where("row_key >= 1000000").select("row_key").collect()}
