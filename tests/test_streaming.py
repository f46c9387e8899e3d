"""Streams over files: ingestion runs twice without doubling, and windows agree with their batch twins."""

from pyspark.sql import functions as F

from residuum.streaming import flows


def test_ingestion_skips_what_is_stored(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    store, marks = str(tmp_path / "store"), str(tmp_path / "marks")
    (folder / "a.txt").write_text("P1\tA1G\nP2\tR2L\nP1\tA1G\n")
    flows.ingest_mutations(spark, str(folder), store, marks).awaitTermination(120)
    (folder / "b.txt").write_text("P1\tA1G\nP3\tR3L\n")
    flows.ingest_mutations(spark, str(folder), store, marks).awaitTermination(120)
    assert sorted(r["protein_id"] for r in spark.read.parquet(store).collect()) == ["P1", "P2", "P3"]


def test_tumbling_stream(spark, sf_dir, tmp_path):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "event_type", "value")
    events.repartition(2).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    counts = flows.tumbling(stream, "1 day", "event_type", late="1 day")
    query = counts.writeStream.format("memory").queryName("windows").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination(120)
    key = ["start", "event_type", "n"]
    batch = flows.tumbling(events, "1 day", "event_type").select(*key)
    assert sorted(map(tuple, spark.table("windows").select(*key).collect())) == sorted(map(tuple, batch.collect()))
    assert batch.agg(F.sum("n")).first()[0] == events.count()
