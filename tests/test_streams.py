from postloom.streaming import streams


def test_streams_equal_batches(spark, tmp_path):
    rows = [(i, f"2024-01-01 0{i % 5}:00:00", "ab"[i % 2], float(i)) for i in range(20)] + [(99, None, "a", 1.0)]
    df = spark.createDataFrame(rows, "id int, t string, kind string, v double").selectExpr("id", "cast(t as timestamp) as ts", "kind", "v")
    df.repartition(3).write.parquet(str(tmp_path / "in"))
    src = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    once = streams.drained(streams.first_seen(src, ["kind"], "ts"), "once")
    assert sorted(r.kind for r in once.collect()) == ["a", "b"]
    counts = streams.drained(streams.windowed_counts(src, "ts", "kind", "v"), "counts", "complete")
    want = df.filter("ts is not null").groupBy("kind").count().collect()
    got = counts.groupBy("kind").sum("n").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))

    seen = []
    query = streams.merge_batches(src, lambda b, n: seen.append(b.count()), str(tmp_path / "ck"))
    query.awaitTermination()
    assert sum(seen) == 21
