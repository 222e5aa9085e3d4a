from parallaxis.streaming.frames import select_streaming


def test_stream_decides_full_windows(spark, tmp_path):
    rows = [("a", k, float(s)) for k, s in enumerate([1, 5, 5, 2, 9, 1, 3])] + [("b", 0, 50.0), ("b", 1, 2.0)]
    spark.createDataFrame(rows, "clip STRING, frame_index LONG, score DOUBLE").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("clip STRING, frame_index LONG, score DOUBLE").parquet(str(tmp_path / "in"))
    query = select_streaming(stream, 2, 4.0).writeStream.format("memory").queryName("picked").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    got = {(r.clip, r.window_id): (r.frame_index, r.keep) for r in spark.table("picked").collect()}
    got.pop(("a", 3), None)  # the open window, if its clip has already fallen silent
    assert got == {("a", 0): (1, True), ("a", 1): (2, True), ("a", 2): (4, True), ("b", 0): (0, True)}
