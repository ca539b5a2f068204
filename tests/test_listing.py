"""Listing operators: inventory filter, two-watermark incremental listing
(sequences of runs against a model of the rule), directory status, suffix inventory."""

from hypothesis import given, settings
from hypothesis import strategies as st

from flowtable.operators.listing import (FILES_SCHEMA, ListingState, directory_status, file_inventory,
                                         incremental_listing, name_suffix_inventory)


def frow(path, mtime=0, mode=0o754, is_dir=False, length=1):
    parent, _, name = path.rpartition("/")
    return (path, name, parent, length, mtime, "u", "g", 3, mode, is_dir)


def test_inventory_regex_applies_to_directories(spark):
    rows = [frow("/r/a.txt"), frow("/r/.hidden"), frow("/r/sub/b.txt"), frow("/r/.git/c.txt"),
            frow("/r/sub", is_dir=True), frow("/other/d.txt")]
    df = spark.createDataFrame(rows, FILES_SCHEMA)
    got = sorted((r.path, r.filename) for r in file_inventory(df, "/r").collect())
    assert got == [("/r", "a.txt"), ("/r/sub", "b.txt")]
    top = sorted(r.filename for r in file_inventory(df, "/r", recurse=False).collect())
    assert top == ["a.txt"]
    perms = file_inventory(df, "/r", recurse=False).first().permissions
    assert perms == "rwxr-xr--"


def model_run(files, state, as_of):
    """Direct model of one listing run."""
    listed, emitted = state
    eligible = [(n, t) for n, t in files if not n.endswith("_COPYING_")]
    new_listed = max([listed] + [t for _, t in eligible])
    cand = [(n, t) for n, t in eligible if t >= listed and t > emitted]
    out = []
    if cand:
        newest = max(t for _, t in cand)
        out = cand if newest == listed else [(n, t) for n, t in cand if t < newest]
    new_emitted = max([emitted] + [t for _, t in out])
    return sorted(out), (new_listed, new_emitted)


def spark_run(spark, files, state, as_of):
    rows = [frow(f"/d/{n}", t) for n, t in files]
    df = spark.createDataFrame(rows, FILES_SCHEMA)
    out, new_state = incremental_listing(df, ListingState(*state), as_of)
    got = sorted((r.name, r.mtime_ms) for r in out.collect())
    s = new_state.first()
    return got, (s.listed_ms, s.emitted_ms)


def test_hold_back_then_release(spark):
    files = [("a", 10), ("b", 20), ("c", 20)]
    out, st1 = spark_run(spark, files, (-1, -1), 100)
    assert out == [("a", 10)] and st1 == (20, 10)
    out, st2 = spark_run(spark, files, st1, 101)  # nothing newer: the held-back timestamp goes out
    assert out == [("b", 20), ("c", 20)] and st2 == (20, 20)
    out, st3 = spark_run(spark, files, st2, 102)
    assert out == [] and st3 == (20, 20)
    # a late file older than what was emitted is never listed
    out, _ = spark_run(spark, files + [("late", 15), ("new", 30), ("x_COPYING_", 40)], st3, 103)
    assert out == []


def test_age_bounds(spark):
    files = [frow("/d/old", 10), frow("/d/mid", 50), frow("/d/young", 95), frow("/d/future", 200)]
    df = spark.createDataFrame(files, FILES_SCHEMA)
    out, _ = incremental_listing(df, ListingState(), 100, min_age_ms=10, max_age_ms=60)
    # eligible: mid (age 50) only -> it is the newest, so it is held back
    assert out.count() == 0
    out, st = incremental_listing(df, ListingState(), 100)
    assert sorted(r.name for r in out.collect()) == ["mid", "old", "young"]  # future is the newest: held back
    assert tuple(st.first()) == (200, 95)


@settings(max_examples=12, deadline=None)
@given(batches=st.lists(st.lists(st.integers(min_value=0, max_value=6), max_size=4), min_size=1, max_size=4))
def test_sequences_match_model_and_emit_once(spark, batches):
    # files arrive over runs with non-decreasing times (no late data)
    files, state_m, state_s, seen = [], (-1, -1), (-1, -1), []
    base = 0
    for i, batch in enumerate(batches):
        for j, dt in enumerate(sorted(batch)):
            files.append((f"f{i}_{j}", base + dt))
        base += 7
        out_m, state_m = model_run(files, state_m, 1000)
        out_s, state_s = spark_run(spark, files, state_s, 1000)
        assert out_s == out_m and state_s == state_m
        seen += [n for n, _ in out_s]
    # one idle run releases what was held back
    out_s, state_s = spark_run(spark, files, state_s, 1000)
    seen += [n for n, _ in out_s]
    assert len(seen) == len(set(seen))
    assert sorted(seen) == sorted(n for n, _ in files)


def test_directory_status_routes(spark):
    dirs = spark.createDataFrame([("/a", True, False), ("/b", True, False), ("/c", False, False), ("/f", True, True)],
                                 "path string, exists boolean, is_file boolean")
    files = spark.createDataFrame([("/a",), ("/a",)], "parent string")
    got = {r.path: (r.n_children, r.route) for r in directory_status(dirs, files, is_file_col="is_file").collect()}
    assert got == {"/a": (2, "not empty"), "/b": (0, "empty"), "/c": (0, "failure"), "/f": (0, "empty")}


def test_name_suffix_inventory(spark):
    df = spark.createDataFrame([("eng.traineddata",), ("deu.traineddata",), (".fra.traineddata",), ("x.txt",)],
                               "name string")
    got = sorted(r.name for r in name_suffix_inventory(df, "name", ".traineddata", default="eng").collect())
    assert got == ["deu", "eng", "fra"]


def test_run_listing_with_durable_state(spark):
    from flowtable.operators.listing import run_listing
    from flowtable.session import scratch_path

    base = scratch_path(spark, "t-run-listing")
    files, state_m, seen = [], (-1, -1), []
    for i, batch in enumerate([[("a", 10), ("b", 20)], [("c", 20), ("d", 30)], [], [("late", 5), ("e", 40)], []]):
        files += batch
        out_m, state_m = model_run(files, state_m, 1000)
        df = spark.createDataFrame([frow(f"/d/{n}", t) for n, t in files], FILES_SCHEMA)
        written = run_listing(df, f"{base}/state", f"{base}/out", as_of_ms=1000 + i)
        assert sorted((r.name, r.mtime_ms) for r in written.collect()) == out_m
        st = spark.read.parquet(f"{base}/state").orderBy("seq").tail(1)[0]  # the history's newest row
        assert (st.listed_ms, st.emitted_ms) == state_m
        seen += [n for n, _ in out_m]
    assert sorted(seen) == ["a", "b", "c", "d", "e"]
