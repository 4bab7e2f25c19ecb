"""Print sink tags (S10) and task index (F1)."""

from ebbflow.operators.process import with_task_index
from ebbflow.sinks.console import print_sink, tagged


def test_tagged_print_sink_memory(spark, tmp_path):
    spark.range(5).write.parquet(f"{tmp_path}/in")
    src = spark.readStream.schema("id long").parquet(f"{tmp_path}/in")
    q = print_sink(src, "1", fmt="memory", query_name="tag_probe", checkpoint=str(tmp_path / "ck"))
    q.processAllAvailable()
    q.stop()
    assert sorted(spark.sql("SELECT tag, id FROM tag_probe").collect()) == [("1", i) for i in range(5)]
    assert tagged(spark.range(3), "2").select("tag").distinct().first().tag == "2"


def test_task_index(spark):
    df = with_task_index(spark.range(100).repartition(4))
    assert sorted(r.task for r in df.select("task").distinct().collect()) == [0, 1, 2, 3]
