"""Frames of a stream and of a table go with the same sidecar frames, also over a restart."""

import random

import numpy as np

from plumbline.streaming import availability as av

FRAMES = "clip string, video_index bigint, pts_ms double"


def clips():
    rng = random.Random(8)
    frames, cards = [], []
    for c in range(12):
        n = rng.choice([1, 8, 30])
        times = np.cumsum([rng.choice([0.03, 0.04, 0.2]) for _ in range(n)]).tolist()
        cards.append((f"c{c}", n, None if c == 3 else times[:-1] if c == 4 else times))
        at = 5000.0
        for i in range(n + rng.choice([-1, 0, 2])):
            at += rng.choice([20.0, 40.0, 45.0, 200.0])
            if c == 5 and i == 4:
                at -= 500.0
            frames.append((f"c{c}", i, None if c == 6 and i == 3 else at))
    return frames, cards


def rows(df):
    return sorted(tuple(None if v is None else round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect())


def test_stream_with_a_restart_equals_the_table(spark, tmp_path):
    frames, cards = clips()
    sidecars = spark.createDataFrame(cards, "clip string, expected int, times array<double>")
    want = rows(av.associated(spark.createDataFrame(frames, FRAMES), sidecars, "clip"))
    assert {r[-1] for r in want} == {"pts_nearest", "pts_unmatched", "index_fallback"}
    for k, (a, b) in enumerate(((0, 2), (2, 5), (4, 99))):  # frame 4 comes twice
        part = [f for f in frames if a <= f[1] < b]
        spark.createDataFrame(part, FRAMES).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        if k == 0:
            continue  # the second start finds two files, the third goes on from the state
        stream = spark.readStream.schema(FRAMES).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        q = av.associated(stream, sidecars, "clip").writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start()
        q.awaitTermination()
    assert rows(spark.read.parquet(f"{tmp_path}/out")) == want


def test_what_became_of_the_frames(spark):
    frames = spark.createDataFrame([("a", 0, 100.0), ("a", 1, 140.0), ("a", 2, 900.0), ("b", 0, 10.0), ("b", 1, 10.0)], FRAMES)
    cards = spark.createDataFrame([("a", 3, [0.0, 0.04, 0.08]), ("b", 3, [0.0, 1.0, 2.0]), ("c", 2, [0.0, 1.0])], "clip string, expected int, times array<double>")
    got = av.associated(frames, cards, "clip", tolerance=0.05)
    assert rows(got.select("clip", "video_index", "sidecar_index", "method")) == [("a", 0, 0, "pts_nearest"), ("a", 1, 1, "pts_nearest"), ("a", 2, None, "pts_unmatched"), ("b", 0, 0, "pts_nearest"), ("b", 1, 1, "index_fallback")]
    report = {r.clip: (r.decoded, r.matched, r.missing, r.pts_status) for r in av.availability(got, cards, "clip").collect()}
    assert report == {"a": (3, 2, [2], "used"), "b": (2, 2, [2], "index_fallback"), "c": (0, 0, [0, 1], "not_evaluated")}


def test_index_mode(spark):
    frames = spark.createDataFrame([("a", 0, None), ("a", 1, 5.0), ("a", 2, 4.0)], FRAMES)
    cards = spark.createDataFrame([("a", 2, None)], "clip string, expected int, times array<double>")
    got = av.associated(frames, cards, "clip", by_time=False)
    assert rows(got.select("video_index", "sidecar_index", "method")) == [(0, 0, "index"), (1, 1, "index"), (2, None, "index")]
