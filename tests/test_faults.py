"""Inputs on which records were lost, jobs failed or plans disagreed."""

import tempfile

import pytest
from pyspark.sql import functions as F

from flowtable.operators import (as_json_content, busy_nodes, capped_actions, parse_pairs, raster_crop, raster_zoom, run_listing,
                                 sentiment, to_raster, utterances)
from flowtable.operators.listing import ListingState, state_before
from flowtable.operators.routing import _ranked_cutoff
from flowtable.streaming import poll


def files(spark, *rows):
    return spark.createDataFrame(list(rows), "name string, mtime_ms long")


def test_listing_replay_and_late_run(spark):
    base = tempfile.mkdtemp(prefix="listing-")
    names = lambda df: sorted(r.name for r in df.collect())
    first = files(spark, ("a", 10), ("b", 20))
    assert names(run_listing(first, f"{base}/state", f"{base}/out", 100)) == ["a"]
    assert names(run_listing(first, f"{base}/state", f"{base}/out", 100)) == ["a"]  # repeated: the same rows
    second = files(spark, ("a", 10), ("b", 20), ("c", 30))
    assert names(run_listing(second, f"{base}/state", f"{base}/out", 200)) == ["b"]
    assert names(run_listing(second, f"{base}/state", f"{base}/out", 150)) == ["c"]  # late: starts from run 200
    assert names(run_listing(second, f"{base}/state", f"{base}/out", 300)) == []


def test_listing_state_starts_again_for_another_source(spark):
    base = tempfile.mkdtemp(prefix="listing-")
    rows = files(spark, ("a", 10), ("b", 20))
    run = lambda at, source: sorted(r.name for r in run_listing(
        rows, f"{base}/state", f"{base}/out", at, source=source).collect())
    assert [run(100, "/d *"), run(200, "/d *"), run(300, "/d *.csv"), run(400, "/d *.csv")] == [["a"], ["b"], ["a"], ["b"]]


def test_listing_state_unreadable_is_no_first_run(spark):
    base = tempfile.mkdtemp(prefix="listing-")
    assert state_before(spark, f"{base}/none", 1) == (ListingState(), 0)
    with open(f"{base}/part-0.parquet", "w") as f:
        f.write("no parquet")
    with pytest.raises(Exception):
        state_before(spark, base, 1)


def _reader(fn, bound=10):
    reader = poll._PollReader.__new__(poll._PollReader)
    reader.poll, reader.max_records, reader.columns = fn, bound, ["x"]
    return reader


def test_poll_never_moves_past_records():
    with pytest.raises(ValueError):
        _reader(lambda o, n: ([{"x": i} for i in range(15)], o + 15)).read({"offset": 0})
    queue = [(7 * i, {"x": i}) for i in range(1, 9)]  # offsets that are no counts

    def fetch(offset, n):
        got = [(o, r) for o, r in queue if o > offset][:n]
        return [r for _, r in got], got[-1][0] if got else offset

    reader = _reader(fetch, 3)
    rows, end = reader.read({"offset": 0})
    assert [r[0] for r in rows] == [1, 2, 3] and end["offset"] == 21
    assert [r[0] for r in reader.readBetweenOffsets({"offset": 0}, end)] == [1, 2, 3]


@pytest.mark.parametrize("extra", [0, 300])
def test_sentiment_plans_agree(spark, extra):
    lexicon = [("good", 0.5), ("good", -0.25), ("up", 1.0), ("down", -1.0), ("été", 1.0), ("zero", 0.5), ("zero", -0.5)]
    lexicon += [(f"x{i}", 1.0) for i in range(extra)]
    docs = spark.createDataFrame([(1, "good"), (1, "up"), (2, "up down"), (3, "L'Été"), (4, "zero"), (5, None)], "id long, t string")
    out = sentiment(docs, "id", "t", spark.createDataFrame(lexicon, "token string, weight double"))
    assert sorted(map(tuple, out.collect()), key=str) == sorted([
        (1, 1.0, 0.25, 1, "success"), (1, 1.0, 1.0, 1, "success"), (2, 0.0, 2.0, 2, "success"), (3, 1.0, 1.0, 1, "success"),
        (4, 0.0, 0.0, 1, "success"), (5, None, None, 0, "no results")], key=str)


def test_utterance_words(spark):
    df = spark.createDataFrame([(i, i, t) for i, t in enumerate(["\n", "\t", "\nhello", " a\tb ", "", None])], "k int, o int, t string")
    got = {r.k: (r.n_words, r.route) for r in utterances(df, "k", "o", "t").collect()}
    assert got == {0: (0, "no results"), 1: (0, "no results"), 2: (1, "success"), 3: (2, "success"), 4: (0, "no results"),
                   5: (0, "no results")}


def test_caps_with_null_keys_and_both_plans(spark):
    df = spark.createDataFrame([(None, i) for i in range(4)] + [("a", i) for i in range(4, 7)], "k string, id long")
    out = capped_actions(df, ["id"], 2, key_col="k")
    assert sorted(r.id for r in out.where("route = 'act'").collect()) == [0, 1, 4, 5]
    for cap in (1, 3, 7, 9):
        assert df.select((F.col("id") <= _ranked_cutoff(df, ["id"], cap)["id"]).alias("a")).where("a").count() == \
            capped_actions(df, ["id"], cap).where("route = 'act'").count()


def test_busy_nodes_deep_tree_and_cycle(spark):
    chain = [(i, i - 1 if i else None, f"g{i}") for i in range(90)]
    groups = spark.createDataFrame(chain, "group_id long, parent_id long, name string")
    queues = spark.createDataFrame([(89, "q", 50)], "group_id long, queue_name string, queued_count long")
    row, = busy_nodes(groups, queues).collect()
    assert row.depth == 89 and row.path.startswith("g0/g1/") and row.path.endswith("/g89")
    with pytest.raises(ValueError):
        busy_nodes(spark.createDataFrame([(1, 2, "a"), (2, 1, "b")], groups.schema),
                   spark.createDataFrame([(1, "q", 50)], queues.schema))


def test_pointer_doubling_rounds(spark):
    from flowtable.operators.routing import _pointers

    chain = spark.range(90).select("id", F.when(F.col("id") > 0, F.col("id") - 1).alias("up"))
    ends, circling, rounds = _pointers(chain)
    assert ends.count() == 90 and circling is None and rounds <= 8
    ring = spark.range(10_000).select("id", ((F.col("id") + 1) % 10_000).alias("up"))
    ends, circling, rounds = _pointers(ring.unionAll(spark.createDataFrame([(-1, None), (-2, -1), (-3, 77), (-4, -9)], ring.schema)))
    assert rounds <= 15 and circling.count() == 10_001 and sorted(r.id for r in ends.collect()) == [-2, -1]


def test_busy_nodes_beside_a_cycle(spark):
    groups = spark.createDataFrame([(1, None, "a"), (2, 1, "b"), (3, 4, "c"), (4, 3, "d"), (5, 99, "e")],
                                   "group_id long, parent_id long, name string")
    queues = "group_id long, queue_name string, queued_count long"
    found = busy_nodes(groups, spark.createDataFrame([(2, "q", 11), (2, "r", 10), (5, "s", 50), (3, "t", 1)], queues))
    assert [tuple(r) for r in found.collect()] == [("a/b", 1, "q", 11)]  # below a missing parent: no path


def test_json_array_in_pieces(spark):
    import json

    df = spark.range(5000).select((F.col("id") % 3 == 0).alias("hot"), "id").repartition(7)
    parts = as_json_content(df, per="group", key_cols=["hot"], order_cols=["id"], piece_rows=64)
    for hot in (True, False):
        rows = parts.where(F.col("hot") == hot).orderBy("part").collect()
        assert len(rows) > 20 and max(r.content.count("{") for r in rows) <= 64
        assert [e["id"] for e in json.loads("".join(r.content for r in rows))] == [i for i in range(5000) if (i % 3 == 0) == hot]
    whole = as_json_content(df, per="table", order_cols=["id"], piece_rows=256).orderBy("part").collect()
    assert [e["id"] for e in json.loads("".join(r.content for r in whole))] == list(range(5000))
    assert [r.content for r in as_json_content(df.limit(0), per="table").collect()] == ["[]"]


def test_transcript_of_a_long_key_with_text_order(spark):
    from flowtable.operators.scoring import assemble_transcript

    df = spark.range(200_000).select(F.when(F.col("id") % 20 < 19, "hot").otherwise(F.col("id").cast("string")).alias("k"),
                                     F.lpad(F.col("id").cast("string"), 9, "0").alias("o"), F.col("id").cast("string").alias("t")).repartition(9)
    row = assemble_transcript(df, "k", "o", "t").where("k = 'hot'").first()
    assert row.n_parts == 190_000 and row.transcript == "".join(f"{i} " for i in range(200_000) if i % 20 < 19)


def test_stage_failures_are_found_by_halving(spark):
    import pandas as pd

    from flowtable.operators.stages import python_stage

    def fn(pdf):
        if (pdf["id"] % 100 == 7).any():
            raise ValueError("z" * 2000)
        return pd.DataFrame({"twice": pdf["id"] * 2})

    out = python_stage(spark.range(1000), fn, "twice long", keep=["id"]).collect()
    assert {r.id: (r.twice, r.exit_code) for r in out} == {i: (None, 1) if i % 100 == 7 else (2 * i, 0) for i in range(1000)}
    assert {len(r.error) for r in out if r.error} == {len("ValueError: ") + 2000}


def test_rasters_of_odd_sizes(spark):
    df = spark.createDataFrame([(1, []), (2, [1, 2, 3]), (3, list(range(10)))], "id int, p array<int>") \
        .withColumn("img", to_raster(F.col("p"), 8))
    assert {r.id: r.img for r in df.collect()} == {1: [], 2: [[1, 2, 3]], 3: [list(range(8)), [8, 9]]}
    cropped = {r.id: (r.route, r.crop) for r in raster_crop(df, "img", 0, 0, 2, 1).collect()}
    assert cropped == {1: ("failure", None), 2: ("success", [[1, 2]]), 3: ("success", [[0, 1]])}
    assert {r.id: r.zoomed for r in raster_zoom(df.where("id < 3"), "img").collect()} == {1: [], 2: [[1, 1, 2, 2, 3, 3]] * 2}


def test_json_content_keeps_microseconds(spark):
    df = spark.sql("select 1 as id, timestamp '2024-01-02 03:04:05.123456' as ts")
    assert "05.123456" in as_json_content(df).first().content


def test_parse_pairs_of_null(spark):
    row = parse_pairs(spark.createDataFrame([(None,)], "c string"), "c").first()
    assert row.pairs == {} and row.route == "success"
