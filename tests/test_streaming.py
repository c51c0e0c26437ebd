import datetime

from nodeloom.streaming import pages as sp


def test_stream_equals_batch(spark, tmp_path):
    rows = [(i, f"http://h/{i}", '<p><a href="/x">more</a></p>', datetime.datetime(2024, 1, 1)) for i in range(6)]
    for k in range(2):
        spark.createDataFrame(rows[k * 3 : k * 3 + 3], sp.PAGES).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    query = sp.findings_sink(sp.stream_pages(spark, f"{tmp_path}/in", 1), f"{tmp_path}/out", f"{tmp_path}/cp").trigger(availableNow=True).start()
    query.awaitTermination(120)
    out = spark.read.parquet(f"{tmp_path}/out")
    assert sorted(r.page_id for r in out.collect()) == list(range(6)) and {r.rule_id for r in out.collect()} == {"LINK-R-02"}
