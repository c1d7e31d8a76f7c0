import csv
import json

import pytest
from pyspark.sql import functions as F

from gleaner.operators import recommend, reviews, sketch
from gleaner.sources import readers, writers
from gleaner.streaming import replay, reservoir, windows


def lines(path):
    return [line for part in sorted(path.glob("part-*")) for line in part.read_text().splitlines()]


def test_json_reviews_and_business(spark, tmp_path):
    (tmp_path / "r.json").write_text(
        '{"review_id":"1","user_id":"u","business_id":"b","stars":4,"date":"2018-03-04 05:06:07","text":"x"}\n'
        '{"review_id":"2","user_id":"u","business_id":"b","stars":2.5,"date":"bad","text":"y"}\n')
    got = readers.read_reviews(spark, str(tmp_path / "r.json"))
    assert got.agg(F.sum("stars")).first()[0] == 6.5
    assert tuple(reviews.review_stats(got, 2018).first()) == (2, 1, 1)
    assert tuple(reviews.review_stats(got, 1999).first()) == (2, 0, 1)
    (tmp_path / "b.json").write_text('{"business_id":"b"}\n')
    assert readers.read_business(spark, str(tmp_path / "b.json")).first()["city"] is None


def test_pairs_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("u1", "b1"), ("u2", "b2")], readers.PAIR)
    writers.write_pairs(rows, str(tmp_path / "p"))
    assert sorted(map(tuple, readers.read_pairs(spark, str(tmp_path / "p")).collect())) == [("u1", "b1"), ("u2", "b2")]


def test_stop_words_and_baskets(spark, tmp_path):
    (tmp_path / "s").write_text("the a\n\n an the\n")
    assert sorted(r["word"] for r in readers.read_stopwords(spark, str(tmp_path / "s")).collect()) == ["a", "an", "the"]
    (tmp_path / "basket.txt").write_text("1 2 2\n3 1\n 4\n")
    got = readers.read_baskets(spark, str(tmp_path / "basket.txt"))
    groups = sorted(sorted(r[1]) for r in got.groupBy("basket_id").agg(F.collect_list("item")).collect())
    assert groups == [["1", "2"], ["1", "3"], ["4"]]
    assert readers.read_documents(spark, str(tmp_path / "basket.txt")).count() == 3


def test_equal_items_are_found_within_a_line(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x y  x\ty\n\n x \nx\n")
    (tmp_path / "b.txt").write_text("x y x\n   \n")
    got = readers.read_baskets(spark, str(tmp_path))
    groups = sorted(sorted(r[1]) for r in got.groupBy("basket_id").agg(F.collect_list("item")).collect())
    assert groups == [["x"], ["x"], ["x", "y"], ["x", "y"]]
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()


def test_models_and_averages(spark, tmp_path):
    (tmp_path / "avg.json").write_text('{"b1": 3.5, "UNK": 3.8}\n')
    assert {r["id"]: r["avg"] for r in readers.read_averages(spark, str(tmp_path / "avg.json")).collect()} == {
        "b1": 3.5, "UNK": 3.8}
    (tmp_path / "m.json").write_text('{"u1": "x", "u2": "y", "sim": 0.5}\n')
    assert tuple(readers.read_model(spark, str(tmp_path / "m.json"), readers.USER_MODEL).first()) == ("x", "y", 0.5)
    (tmp_path / "c.json").write_text('{"description": "user_profile", "id": "u", "profile": [3, 1]}\n'
                                     '{"description": "business_profile", "id": "b", "profile": [7]}\n')
    got = readers.read_profiles(spark, str(tmp_path / "c.json"), "user_profile").collect()
    assert sorted(map(tuple, got)) == [("u", 1), ("u", 3)]
    model = spark.createDataFrame([("user_profile", "u", 1), ("business_profile", "b", 2)],
                                  "description string, id string, token long")
    writers.write_profiles(model, str(tmp_path / "model"))
    assert [tuple(r) for r in readers.read_profile_tokens(spark, str(tmp_path / "model"), "user_profile").collect()] == [("u", 1)]


def test_reports(spark, tmp_path):
    stats = spark.createDataFrame([(5, 2, 3)], "total long, in_year long, users long")
    users = spark.createDataFrame([("v", 1), ("u", 2), ("t", 1)], "user_id string, n long")
    words = spark.createDataFrame([("b", 4), ("a", 1)], "word string, n long")
    writers.write_report(writers.review_report(stats, users, words), str(tmp_path / "a"))
    assert json.loads(lines(tmp_path / "a")[0]) == {
        "A": 5, "B": 2, "C": 3, "D": [["u", "2"], ["t", "1"], ["v", "1"]], "E": ["a", "b"]}
    top = spark.createDataFrame([("x", 1.5), ("y", 4.0)], "category string, stars double")
    assert json.loads(writers.category_report(top).first()["value"]) == {"result": [["y", "4.0"], ["x", "1.5"]]}
    placed = spark.createDataFrame([(0, 3), (1, 0)], "pid int, n_items long")
    found = spark.createDataFrame([("b", 9), ("c", 12)], "business_id string, n long")
    head, body = [json.loads(r["value"]) for r in writers.partition_report(placed, found).collect()]
    assert head == {"n_partitions": 2, "n_items": [3, 0]}
    assert [(p["business_id"], p["n"]) for p in body["result"]] == [("c", 12), ("b", 9)]
    writers.write_json_lines(top, str(tmp_path / "j"))
    assert {json.loads(x)["category"] for x in lines(tmp_path / "j")} == {"x", "y"}


def test_membership_lines(spark):
    flags = spark.createDataFrame([(i, i % 2) for i in range(7)], "seq int, flag int")
    got = writers.membership_lines(flags, "seq", per_line=4).orderBy("line_no").collect()
    assert [r["line"] for r in got] == ["0 1 0 1", "0 1 0"]


CITY_ROWS = [(i, f"u{i % 9}") for i in range(0, 240, 3)]


def write_cities(folder, rows):
    folder.mkdir(exist_ok=True)
    for part in range(3):
        chunk = rows[part * len(rows) // 3 : (part + 1) * len(rows) // 3]
        body = "".join(json.dumps({"ts": f"2024-01-01T00:{s // 60:02}:{s % 60:02}Z", "city": c}) + "\n" for s, c in chunk)
        (folder / f"{part}.json").write_text(body)


def test_window_stream_gives_the_batch_result(spark, tmp_path):
    write_cities(tmp_path / "in", CITY_ROWS)
    stream = windows.fm_windows(readers.stream_cities(spark, str(tmp_path / "in")), "ts", "city", watermark="0 seconds")
    query = windows.write_windows(stream, str(tmp_path / "out"), str(tmp_path / "state"), every=None)
    query.awaitTermination()
    found = set()
    for part in (tmp_path / "out").glob("part-*.csv"):
        rows = list(csv.reader(part.read_text().splitlines()))
        assert rows[0] == ["Time", "Ground Truth", "Estimation"]
        found |= {(t, int(n), int(e)) for t, n, e in rows[1:]}
    table = spark.read.schema(readers.CITY).json(str(tmp_path / "in"))
    whole = {tuple(r) for r in windows.fm_windows(table, "ts", "city").collect()}
    last = max(s for s, _ in CITY_ROWS)
    closed = {r for r in whole if int(r[0][14:16]) * 60 + int(r[0][17:]) + 30 <= last or r[0] < "2024"}
    assert found == closed and len(found) > 15
    middle = {c for s, c in CITY_ROWS if 60 <= s < 90}
    assert next(r for r in whole if r[0].endswith("00:01:00"))[1] == len(middle)


def write_messages(folder, parts):
    folder.mkdir(exist_ok=True)
    for part in parts:
        body = "".join(
            json.dumps({"id": i, "text": "nba news" if i % 2 else "weather", "lang": "en",
                        "hashtags": [{"text": f"t{i % 4}"}] if i % 3 else []}) + "\n"
            for i in range(part * 100, part * 100 + 100))
        (folder / f"{part}.json").write_text(body)


def test_sample_over_many_batches_and_a_restart(spark, tmp_path):
    folder, base, seen = tmp_path / "in", str(tmp_path / "sample"), []

    def run():
        stream = spark.readStream.schema(readers.MESSAGE).option("maxFilesPerTrigger", 1).json(str(folder))
        stream = reservoir.tagged(reservoir.tracked(stream.withColumn("tags", F.col("hashtags.text")), ["NBA"]))
        query = reservoir.keep_sample(stream, "id", base, str(tmp_path / "state"), k=20, every=None, buckets=3,
                                      on_sample=lambda s, e: seen.append([tuple(r) for r in sketch.tag_counts(s).collect()]))
        query.awaitTermination()
        assert query.exception() is None
        return reservoir.last_sample(spark, base, stream.schema, "id", 20)

    def expected(n):
        whole = spark.createDataFrame([(i,) for i in range(n) if i % 3 and i % 2], "id long")
        return {r["id"] for r in sketch.reservoir(whole, "id", 20).collect()}

    write_messages(folder, range(3))
    first = run()
    assert {r["id"] for r in first.collect()} == expected(300) and len(seen) >= 3
    write_messages(folder, range(3, 6))  # the query ended; a new one goes on from its state
    sample = run()
    assert {r["id"] for r in sample.collect()} == expected(600) and len(seen) >= 6
    assert sample.first()["tags"][0].startswith("t") and sum(n for _, n in seen[-1]) == 20
    assert not [p for p in (tmp_path / "sample").iterdir() if p.is_dir()]  # no folder of an epoch
    entered = spark.read.schema(reservoir.ENTRY).parquet(base)
    assert entered.count() < 200 and run().count() == 20  # what does not enter the sample is not kept


def test_replay_with_late_rows_gives_the_batch_result(spark, tmp_path):
    start = 1_704_067_200
    rows = [(start + i, f"u{i % 9}") for i in range(0, 600, 3)] + [(None, "u0")]
    frame = spark.createDataFrame(rows, "s long, city string").select(F.timestamp_seconds("s").alias("ts"), "city")
    parts = replay.parts_of(frame, "ts", 4)
    assert len(parts) == 4 and sum(p.count() for p in parts) == len(rows) and min(p.count() for p in parts) > 40
    late = spark.createDataFrame([(start + 400, "late but in time"), (start + 5, "too late")], "s long, city string")
    late = late.select(F.timestamp_seconds("s").alias("ts"), "city")
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    stream = windows.fm_windows(replay.source(spark, folder, frame.schema), "ts", "city", watermark="1 minute")

    def begin():
        writer = stream.writeStream.outputMode("append").format("parquet").trigger(availableNow=True)
        return writer.option("checkpointLocation", str(tmp_path / "state")).start(out)

    last = replay.closing_row(frame, "ts", "2 minutes")
    ran = replay.replay([*parts[:3], late, parts[3], last], folder, begin)
    assert len(ran) == 6 and len({q.runId for q in ran}) == 6 and len({q.id for q in ran}) == 1
    found = {tuple(r) for r in spark.read.schema(stream.schema).parquet(out).collect()}
    kept = frame.unionByName(late.filter("city <> 'too late'")).filter("ts is not null")
    assert found == {tuple(r) for r in windows.fm_windows(kept, "ts", "city").collect()}
    assert spark.read.parquet(out).count() == len(found)


def test_replay_of_nothing(spark, tmp_path):
    empty = spark.createDataFrame([], readers.CITY)
    assert [p.count() for p in replay.parts_of(empty, "ts", 3)] == [0]
    assert replay.closing_row(empty, "ts", "1 minute").count() == 0


def test_pane_states_unite_to_windows(spark):
    rows = [(1_704_067_200 + i, f"u{i * i % 4001}") for i in range(0, 3000)]
    frame = spark.createDataFrame(rows, "s long, city string").select(F.timestamp_seconds("s").alias("ts"), "city")
    half = F.col("city").endswith("1")
    parts = [windows.pane_sketches(frame.filter(c), "ts", "city") for c in (half, ~half)]  # states of two parts
    united = {r[0]: (r["estimate"], r["sketched"]) for r in windows.united_windows(parts[0].unionByName(parts[1])).collect()}
    whole = {r[0]: (r["exact"], r["estimate"]) for r in windows.fm_windows(frame, "ts", "city").collect()}
    assert united.keys() == whole.keys()
    assert all(united[w][0] == estimate for w, (_, estimate) in whole.items())
    assert all(abs(united[w][1] - exact) <= max(1, 0.05 * exact) for w, (exact, _) in whole.items())


def test_ordered_lines_over_many_files(spark, tmp_path):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")  # several pieces a file
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        lines = spark.range(5000).selectExpr("id as line_no", "concat('line ', id) as line").repartition(7)
        writers.write_ordered(lines, str(tmp_path / "text"))
        assert len(list((tmp_path / "text").glob("part-*.txt"))) > 1
        got = readers.read_ordered(spark, str(tmp_path / "text")).orderBy("line_no").collect()
        assert [tuple(r) for r in got] == [(i, f"line {i}") for i in range(5000)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    rows = spark.createDataFrame([(3, "c", None), (1, "a", 0.5), (2, "b", 1.5)], "n int, s string, d double")
    writers.write_csv_ordered(rows, [F.desc("n")], str(tmp_path / "csv"))
    assert lines_of(tmp_path / "csv") == ["n,s,d", "3,c,", "2,b,1.5", "1,a,0.5"]
    got = readers.read_csv_ordered(spark, str(tmp_path / "csv"), rows.schema).orderBy("line_no").collect()
    assert [tuple(r) for r in got] == [(1, 3, "c", None), (2, 2, "b", 1.5), (3, 1, "a", 0.5)]


def lines_of(path):
    return [line for part in sorted(path.glob("part-*.txt")) for line in part.read_text().splitlines()]


def test_averages_with_the_entry_for_unknown_ids(spark, tmp_path):
    averages = spark.createDataFrame([(i, i / 7) for i in range(2500)], "id long, avg double")
    overall = averages.agg(F.avg("avg").alias("avg"))
    writers.write_averages(averages, overall, str(tmp_path / "avg"))
    known, unknown = recommend.split_averages(readers.read_averages(spark, str(tmp_path / "avg")))
    assert {int(r["id"]): r["avg"] for r in known.collect()} == {i: i / 7 for i in range(2500)}
    assert [r["avg"] for r in unknown.collect()] == [overall.first()["avg"]]
    assert len(lines(tmp_path / "avg")) > 2


def test_store_reads_the_asked_partition_alone(spark, tmp_path):
    model = spark.createDataFrame([("user_profile", "u", 1), ("business_profile", "b", 2), ("user_profile", "v", 3)],
                                  "description string, id string, token long")
    writers.write_store(model, str(tmp_path / "store"))
    users = readers.read_store(spark, str(tmp_path / "store"), "user_profile")
    assert sorted(map(tuple, users.collect())) == [("u", 1), ("v", 3)]
    plan = users._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(description" in plan and "= user_profile)]" in plan and "DataFilters: []" in plan


def test_message_stream_source(spark, tmp_path):
    assert readers.stream_messages(spark, str(tmp_path)).isStreaming
    english = spark.createDataFrame([(1, "Police, now", "en"), (2, "police", "fr"), (3, "policeman", "en")],
                                    "id int, text string, lang string")
    assert [r["id"] for r in reservoir.tracked(english, ["police"]).collect()] == [1]


@pytest.mark.parametrize("fixed", ["spark.checkpoint.dir"])
def test_scratch_is_local_only_without_the_setting(spark, fixed):
    from gleaner.session import scratch_dir

    expected = spark.conf.get(fixed, None)
    assert scratch_dir(spark).startswith(expected or "/tmp")
