"""Scoring, raster and Python-stage operators on inline tables."""

import math

import pandas as pd

from flowtable.operators.raster import raster_bounds, raster_crop, raster_zoom
from flowtable.operators.scoring import assemble_transcript, label_top1, sentiment, top_k_annotations, utterances
from flowtable.operators.stages import model_batch_job, python_stage


def test_label_top1_ties_and_nan(spark):
    nan = float("nan")
    rows = [(1, [0.1, 0.7, 0.7]), (2, [nan, 0.9]), (3, [0.2, nan, 0.5]), (4, []), (5, [0.25])]
    df = spark.createDataFrame(rows, "id long, p array<float>")
    got = {r.id: (r.label_index, r.label_name) for r in label_top1(df, "p", ["a", "b", "c"]).collect()}
    assert got == {1: (1, "b"), 2: (0, "a"), 3: (2, "c"), 4: (None, None), 5: (0, "a")}
    score = label_top1(df, "p", ["a", "b", "c"]).where("id = 5").first().label_score
    assert score == 25.0
    assert math.isnan(label_top1(df, "p", ["a", "b"]).where("id = 2").first().label_score)


def test_top_k_annotations_and_no_detections(spark):
    ann = spark.createDataFrame([(1, "f", 0.1, 0), (1, "f", 0.9, 1), (1, "f", 0.9, 2), (1, "g", 0.5, 3)],
                                "id long, feature string, score double, pos int")
    keys = spark.createDataFrame([(1,), (2,)], "id long")
    out = top_k_annotations(ann, ["id"], "feature", "score", features=["f"], k=2, tie_cols=["pos"], keys_df=keys)
    got = sorted((r.id, r.feature, r.pos, r.rank, r.route) for r in out.collect())
    assert got == [(1, "f", 1, 1, "success"), (1, "f", 2, 2, "success"), (2, None, None, None, "no detections")]


def test_sentiment(spark):
    docs = spark.createDataFrame([(1, "Good good bad."), (2, "nothing"), (3, "")], "id long, text string")
    lex = spark.createDataFrame([("good", 1.0), ("bad", -0.5)], "token string, weight double")
    got = {r.id: (r.score, r.magnitude, r.route) for r in sentiment(docs, "id", "text", lex).collect()}
    assert got == {1: (0.6, 2.5, "success"), 2: (None, None, "no results"), 3: (None, None, "no results")}


def test_utterances_and_transcript(spark):
    df = spark.createDataFrame([(1, 2, "world"), (1, 1, "hello  there"), (2, 1, "  ")], "k long, o long, t string")
    u = {(r.k, r.o): (r.n_words, r.n_bytes, r.route) for r in utterances(df, "k", "o", "t").collect()}
    assert u == {(1, 1): (2, 12, "success"), (1, 2): (1, 5, "success"), (2, 1): (0, 2, "no results")}
    t = {r.k: r.transcript for r in assemble_transcript(df, "k", "o", "t").collect()}
    assert t == {1: "hello  there world ", 2: "   "}


def test_raster_ops(spark):
    img = [[r * 10 + c for c in range(4)] for r in range(3)]
    df = spark.createDataFrame([(1, img, 1, 1), (2, img, 3, 0)], "id long, img array<array<int>>, x int, y int")
    crop = {r.id: (r.crop, r.route) for r in raster_crop(df, "img", "x", "y", 2, 2).collect()}
    assert crop[1] == ([[11, 12], [21, 22]], "success")
    assert crop[2] == (None, "failure")
    z = raster_zoom(df.where("id = 1"), "img", 2).first().zoomed
    assert len(z) == 6 and len(z[0]) == 8 and z[5][7] == 23 and z[0][1] == 0
    b = raster_bounds(df.where("id = 1"), "img", 2, 1, 5, 5, value=255).first().bounded
    assert b[0] == [0, 1, 2, 3]
    assert b[1] == [10, 11, 255, 255]
    assert b[2] == [20, 21, 255, 23]


def test_python_stage_isolates_bad_rows(spark):
    df = spark.createDataFrame([(1, "a"), (2, "boom"), (3, "ccc")], "id long, s string")

    def fn(pdf):
        if (pdf["s"] == "boom").any():
            raise ValueError("bad input")
        return pd.DataFrame({"n": pdf["s"].str.len()})

    got = {r.id: (r.n, r.exit_code, r.route) for r in python_stage(df, fn, "n long", keep=["id"]).collect()}
    assert got == {1: (1, 0, "success"), 2: (None, 1, "failure"), 3: (3, 0, "success")}


def test_model_batch_job_routes(spark):
    df = spark.createDataFrame([(1, "cat"), (2, "dog"), (3, "crash")], "id long, s string")

    def loader():
        return {"cat": "animal:cat"}

    def predict(model, pdf):
        if (pdf["s"] == "crash").any():
            raise RuntimeError("model failed")
        return pd.DataFrame({"label": [model.get(s) for s in pdf["s"]]})

    got = {r.id: (r.label, r.route) for r in model_batch_job(df, loader, predict, "label string", keep=["id"]).collect()}
    assert got == {1: ("animal:cat", "success"), 2: (None, "no results"), 3: (None, "failure")}


def test_stages_take_batches_of_bounded_rows(spark):
    from flowtable.operators.stages import PIECE_ROWS

    def fn(pdf):
        return pd.DataFrame({"n": [len(pdf)] * len(pdf), "at": pdf.index})

    df = spark.range(20_000)
    for out in (python_stage(df, fn, "n long, at long", keep=["id"]),
                model_batch_job(df, lambda: None, lambda model, pdf: fn(pdf), "n long, at long", keep=["id"])):
        rows = out.collect()
        assert sorted(r.id for r in rows) == list(range(20_000))
        assert max(r.n for r in rows) == PIECE_ROWS and all(r["at"] < r.n for r in rows)


def test_sentiment_join_path_matches_inline_path(spark, monkeypatch):
    import flowtable.operators.scoring as scoring

    docs = spark.createDataFrame([(1, "Good good bad."), (2, "nothing"), (3, "")], "id long, text string")
    lex = spark.createDataFrame([("good", 1.0), ("bad", -0.5)], "token string, weight double")
    inline = sorted(tuple(r) for r in sentiment(docs, "id", "text", lex).collect())
    monkeypatch.setattr(scoring, "INLINE_LEXICON_MAX", 0)
    joined = sorted(tuple(r) for r in scoring.sentiment(docs, "id", "text", lex).collect())
    assert inline == joined


def test_transcript_buckets_keep_order(spark):
    rows = [(1, i, f"t{i}") for i in range(50)] + [(2, 7, "x")]
    df = spark.createDataFrame(rows, "k long, o long, t string")
    one = {r.k: (r.transcript, r.n_parts) for r in assemble_transcript(df, "k", "o", "t", bucket_size=None).collect()}
    two = {r.k: (r.transcript, r.n_parts) for r in assemble_transcript(df, "k", "o", "t", bucket_size=4).collect()}
    assert one == two
    assert one[1][0] == "".join(f"t{i} " for i in range(50))


def test_top_k_annotations_query_ranks_every_entry(spark, tmp_path):
    import duckdb

    from __spark_entry__ import oracle_sql, queries
    from tests.compare import compare

    rows = [(1, [0.01 * i for i in range(64)]), (2, [-1.0] * 64), (3, [0.2, None, 0.1]), (4, []), (5, None)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    df = queries()["top_k_annotations"](spark, str(tmp_path))
    n = {}
    for r in df.collect():
        n[r.vec_id, r.route] = n.get((r.vec_id, r.route), 0) + 1
    assert n == {(1, "success"): 20, (2, "success"): 20, (3, "success"): 3, (4, "no detections"): 1, (5, "no detections"): 1}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    compare(df, con, oracle_sql()["top_k_annotations"])
