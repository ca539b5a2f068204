"""One key holding a third of all rows, spread over many partitions: results stay exact."""

import datetime as dt

from flowtable.operators.routing import capped_actions
from flowtable.operators.scoring import assemble_transcript, top_k_annotations
from flowtable.operators.sync import changed_ids


def hot_rows(n=3000):
    # key 0 gets every third row; the rest spread over 200 keys
    return [(i, 0 if i % 3 == 0 else 1 + i % 200, (i * 7919) % 1009) for i in range(n)]


def test_hot_key_per_key_cap_and_top_k(spark):
    rows = hot_rows()
    df = spark.createDataFrame(rows, "id long, k long, t long").repartition(12)
    acted = {r.id for r in capped_actions(df, ["t", "id"], maximum=7, key_col="k").collect() if r.route == "act"}
    want = set()
    for key in {k for _, k, _ in rows}:
        want |= {i for t, i in sorted((t, i) for i, kk, t in rows if kk == key)[:7]}
    assert acted == want
    ann = df.selectExpr("k", "'f' AS feature", "CAST(t AS DOUBLE) AS score", "id")
    top = top_k_annotations(ann, ["k"], "feature", "score", k=5, tie_cols=["id"])
    got = sorted((r.k, r.id) for r in top.collect())
    exp = []
    for key in {k for _, k, _ in rows}:
        exp += [(key, i) for _, i in sorted((-t, i) for i, kk, t in rows if kk == key)[:5]]
    assert got == sorted(exp)


def test_hot_key_changes_and_transcript(spark):
    rows = hot_rows()
    base = dt.datetime(2024, 1, 1)
    ev = spark.createDataFrame([(k, base + dt.timedelta(seconds=t)) for _, k, t in rows], "k long, ts timestamp_ntz")
    got = {r.k: r.n_changes for r in changed_ids(ev.repartition(12), "k", "ts", "2024-01-01 00:00:00",
                                                  "2024-01-02 00:00:00").collect()}
    assert got[0] == 1000 and sum(got.values()) == 3000
    conv = spark.createDataFrame([(k, i, f"w{i}") for i, k, _ in rows], "k long, o long, t string").repartition(12)
    t = {r.k: r.transcript for r in assemble_transcript(conv, "k", "o", "t", bucket_size=64).collect()}
    assert t[0] == "".join(f"w{i} " for i in range(0, 3000, 3))
