import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from flowtable.llm import collision_search, phrases, whitening
from flowtable.llm.queries import QUERIES
from tests.conftest import SF_SMALL

SCHEMA = "vec_id long, embedding array<float>, shard int, rank string"
ODD = [(None, [1.0, 0.0, 0.0]), (9001, None), (9002, []), (9003, [0.0, 0.0, 0.0]), (9004, [1.0, None, 0.0]),
       (9005, [float("nan"), 1.0, 0.0]), (9006, [float("inf"), 1.0, 0.0])]


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA)


def brute_nearest(rows, asks, k):
    """{query: [(vec_id, score)]} by exact cosines of all pairs."""
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], dtype=np.float32).astype(float)
    norm = np.sqrt((x * x).sum(1))
    out = {}
    for at in np.flatnonzero(asks(ids)):
        score = (x * x[at]).sum(1) / (norm * norm[at])
        best = [j for j in np.lexsort((ids, -score)) if j != at][:k]
        out[int(ids[at])] = [(int(ids[j]), score[j]) for j in best]
    return out


# 11 nearest neighbours

@pytest.mark.parametrize("kind", ["spread", "clusters"])
def test_recall_against_all_pairs(spark, monkeypatch, kind):
    monkeypatch.setattr(collision_search, "SHARD_ROWS", 700)
    monkeypatch.setattr(collision_search, "BLOCK_ROWS", 30)
    rng = np.random.RandomState(4)
    x = rng.normal(size=(3000, 48))
    if kind == "clusters":
        x = np.repeat(rng.normal(size=(60, 48)), 50, axis=0) + 0.2 * x
    x[100:400] = x[100]  # a large group of equal vectors
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    want = brute_nearest(rows, lambda ids: ids % 50 == 0, 5)
    got = defaultdict(list)
    found = collision_search.nearest(vectors(spark, rows), F.col("vec_id") % 50 == 0, 5).orderBy("query_id", "rank").collect()
    for r in found:
        got[r.query_id].append((r.vec_id, r.score))
        assert r.rank == len(got[r.query_id])
    assert got.keys() == want.keys() and all(len(v) == 5 for v in got.values())
    hits = sum(len({i for i, _ in want[q]} & {i for i, _ in got[q]}) for q in want)
    assert hits >= 0.97 * 5 * len(want)
    assert [i for i, _ in got[100]] == [101, 102, 103, 104, 105]  # ties by id
    for q in want:
        exact = dict(brute_nearest([rows[q], *[rows[i] for i, _ in got[q]]], lambda ids: ids == q, 5)[q])
        assert all(abs(exact[i] - s) < 1e-12 for i, s in got[q])


def test_search_cases(spark):
    rows = [(0, [1.0, 0.0, 0.0]), (1, [2.0, 0.0, 0.0]), (2, [1.0, 1.0, 0.0]), (2, [1.0, 1.0, 0.0]), (50, [0.0, 1e-30, 0.0]),
            (100, [1.0, 2.0]), (3, [3.0, 3.0, 3e30]), *ODD]
    out = collision_search.nearest(vectors(spark, rows), F.col("vec_id") % 50 == 0, 5).collect()
    got = defaultdict(list)
    for r in sorted(out, key=lambda r: (r.query_id, r.rank)):
        got[r.query_id].append(r.vec_id)
    assert got == {0: [1, 2, 3, 50], 50: [2, 3, 0, 1]}  # 100 has no candidate of its length
    assert collision_search.nearest(vectors(spark, []), F.col("vec_id") % 50 == 0).count() == 0


def test_threshold_is_a_binomial_bound():
    least = collision_search.threshold()
    hits = np.random.RandomState(0).binomial(collision_search.PROJECTIONS, 0.6826894921, 200_000)
    assert (hits >= least).mean() >= 1 - collision_search.MISS > (hits >= least + 1).mean()


# 12 phrases

def brute_phrases(rows, least, top=2000):
    n, f = Counter(), Counter()
    lower = {c: c + 32 for c in range(65, 91)}
    for lang, text in rows:
        lang, piece = lang if lang is not None else "und", []
        for c in (text or "").translate(lower) + "\n":
            if c not in ".,;:!?\n\x0b\x0c\r":
                piece.append(c)
                continue
            w = [x for x in "".join(piece).replace("\t", " ").split(" ") if x]
            piece = []
            n[lang] += len(w)
            for size in range(1, 6):
                for a in range(len(w) - size + 1):
                    f[lang, tuple(w[a:a + size])] += 1
    f = {k: v for k, v in f.items() if v >= least}
    out = []
    for (lang, p), a in f.items():
        if len(p) == 1 or any(lg == lang and len(q) > len(p) and c >= a and any(q[i:i + len(p)] == p for i in range(len(q)))
                              for (lg, q), c in f.items()):
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p))]
        score, _, left, right = min(cuts)
        out.append((lang, -score, -a, " ".join(p).encode(), left, right, n[lang]))
    rank, result = Counter(), []
    for lang, s, a, p, left, right, total in sorted(out):
        rank[lang] += 1
        if rank[lang] <= top:
            result.append((lang, rank[lang], p.decode(), -a, left, right, total, -s))
    return sorted(result)


def phrase_rows():
    rng = random.Random(8)
    words = ["New", "york", "é", "a", "a", "the", "x\x85y", "w\u00a0w", "É"]
    rows = [(rng.choice(["en", None, "", "und"]), "".join(rng.choice(words) + rng.choice([" ", "  ", "\t", " ", ". ", "\n"])
                                                         for _ in range(rng.randrange(60)))) for _ in range(120)]
    return rows + [("de", "of the people " * 500), ("de", None), ("fr", ""), ("en", "a" * 300_000), ("fr", ". ; !"), *[("en", "ties a b")] * 9]


@pytest.mark.parametrize("sizes", [{}, {"shard_bytes": 300, "pack_bytes": 4000}, {"filter_bytes": 0}])
def test_phrases_against_all_runs(spark, sizes):
    rows = phrase_rows()
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "lang string, text string, n int, phrase string").repartition(5)
    got = phrases.collocations(df, least=8, top=40, **sizes).collect()
    assert sorted(map(tuple, got)) == brute_phrases(rows, 8, 40) and len(got) > 60


def test_phrases_empty(spark):
    none = spark.createDataFrame([], "lang string, text string")
    assert phrases.collocations(none).count() == 0
    assert phrases.collocations(spark.createDataFrame([(None, None), ("en", "a b")], "lang string, text string")).count() == 0


def rare_and_common(least):
    """Texts of words that occur once, and of two phrases ``least`` and ``least`` - 1 times."""
    rare = [("en", " ".join(f"w{i}x{j}" for j in range(50))) for i in range(80)]
    return rare + [("en", "often said here")] * least + [("de", "nearly said here")] * (least - 1) + [(None, "often said")]


def test_large_inputs_give_out_no_rare_phrases(spark, monkeypatch):
    rows, kept = {}, phrases.materialize
    def counted(df, name):
        out = kept(df, name)
        rows[name] = rows.get(name, 0) + out.count()
        return out
    monkeypatch.setattr(phrases, "materialize", counted)
    monkeypatch.setattr(phrases, "LANE_BYTES", 1000, raising=False)
    df = spark.createDataFrame(rare_and_common(20), "lang string, text string").repartition(4)
    n, found = phrases.phrase_counts(df, least=20, filter_bytes=0)  # of more bytes than a task may hold
    assert {(r.lang, r.phrase): r.f for r in found.collect()} == {
        ("en", p): 20 for p in ["often", "said", "here", "often said", "said here", "often said here"]}
    assert {r.lang: r.n for r in n.collect()} == {"en": 4060, "de": 57, "und": 2}
    assert rows.get("phrase-candidates", 0) < 30 and sum(v for k, v in rows.items() if k != "phrase-filter") < 100


@pytest.mark.parametrize("least, lanes, held", [(8, 1, 1 << 20), (8, 16, 0), (300, 4, 2000)])
def test_filter_marks_what_reaches_the_least(spark, least, lanes, held):
    texts = phrases._texts(spark.createDataFrame(rare_and_common(least), "lang string, text string").repartition(5))
    n, flags = phrases._filter(texts, least, lanes, [1, 2], {}, held)
    assert {r.lang: r.n for r in n.collect()} == {"en": 4000 + 3 * least, "de": 3 * least - 3, "und": 2}
    marked = {1: 0, 2: 0}
    for lang, text in set(rare_and_common(least)):
        words = phrases.Words(np.array([0, len(text)]), np.frombuffer(text.encode(), np.uint8))
        for size, _, h in words.phrases(phrases._seed(lang or "und"), {}, 2):
            found = phrases._marked(flags[size], h)
            assert found.all() or text != "often said here" or lang != "en"
            assert text != "nearly said here" or not found.any()
            marked[size] += found.sum()
    assert marked == {1: 3, 2: 2}


def test_candidates_come_once_a_task(spark):
    texts = spark.createDataFrame([(lang, f"one two three. {'x' * (i % 7 + 1)}") for i in range(60) for lang in ("en", "de")],
                                  "lang string, text string").coalesce(1)
    flags = {size: np.full(8192, 255, dtype=np.uint8) for size in range(1, 6)}  # every phrase passes
    want = {(lang, p) for lang in ("en", "de") for p in ["one", "two", "three", "one two", "two three", "one two three",
                                                         *("x" * i for i in range(1, 8))]}
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        rows = [tuple(r) for r in phrases._candidate_rows(texts, flags).collect()]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert len(rows) == len(want) and set(rows) == want


def test_held_candidates_are_bounded_and_none_is_lost():
    own, out, most = phrases._Distinct(1 << 20), [], 0
    for i in range(120):
        found = pa.array([f"w{i % 50} {j}" for j in range(2000)])
        for batch in own.add("en" if i % 2 else "de", found):
            out += zip(*batch.to_pydict().values())
        most = max(most, own.rows + own.new_rows)
    for batch in own.rest():
        out += zip(*batch.to_pydict().values())
    want = {("en" if i % 2 else "de", f"w{i % 50} {j}") for i in range(120) for j in range(2000)}
    assert set(out) == want and most < 220_000
    assert not own.kept and not own.new


def test_trie_finds_exactly_its_phrases():
    rng = random.Random(3)
    for _ in range(30):
        own = sorted({" ".join(rng.choice("abcdefghij") * rng.randint(1, 2) for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(1, 400))})
        trie = phrases.Trie(own)
        code = {w: i + 1 for i, w in enumerate(trie.words)}
        ends = dict(zip(own, trie.ends.tolist()))
        assert len(set(ends.values())) == len(own)
        for p in own + [" ".join(rng.choice("abcdefghijk") for _ in range(rng.randint(1, 5))) for _ in range(300)]:
            state = np.zeros(1, dtype=np.int64)
            for w in p.split(" "):
                state = trie.step(state, np.array([code.get(w, 0)]))
            if p in ends:
                assert state[0] == ends[p]
            else:
                assert state[0] not in trie.ends


# 13 whitening

def brute_whitening(x, k):
    n, s = len(x), x.sum(axis=0)
    c = (x * n - s).astype(float) / n
    value, vector = np.linalg.eigh(c.T @ c / n)
    value, vector = value[::-1], vector[:, ::-1]
    keep = value > 1e-20 * value[0]
    value, vector = value[keep][:k], vector[:, keep][:, :k]
    deviation = [sum(int(n * int(a) - int(b)) ** 2 for a, b in zip(row, s)) for row in x]
    return deviation, (c @ vector) / np.sqrt(value), value / (c.T @ c / n).trace()


def check_whitening(got, ids, x, k=32):
    deviation, z, explained = brute_whitening(x, k)
    k = z.shape[1]
    by = defaultdict(list)
    for r in got:
        by[r.vec_id].append(r)
    assert len(got) == len(x) * k
    own = np.array([[r.whitened for r in sorted(by[i], key=lambda r: r.component)] for i in ids])
    assert [by[i][0].deviation for i in ids] == deviation and {r.n for r in got} == {len(x)}
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-8
    sign = np.sign((own * z).sum(axis=0))
    assert np.abs(own * sign - z).max() < 1e-6
    for r in got:
        assert abs(r.explained / explained[r.component - 1] - 1) < 1e-6


def test_whitening_against_eigenvectors(spark):
    df = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    rows = sorted((r.vec_id, r.embedding) for r in df.collect())
    x = np.floor(64 * np.array([v for _, v in rows])).astype(np.int64) + 1_000_000
    check_whitening(QUERIES["op13_whitening"](spark, SF_SMALL).collect(), [i for i, _ in rows], x)


def test_whitening_of_badly_scaled_and_dependent_columns(spark):
    rng = np.random.RandomState(7)
    a = rng.normal(size=(400, 6)) * np.array([1e4, 3e3, 100, 7, 1, 0.3])
    a = np.round(a * 64) / 64
    both = np.concatenate([a, a[:, :1] * 2, np.full((400, 1), 5.0)], axis=1).astype(np.float32)  # one copy, one constant
    rows = [(i, v.tolist()) for i, v in enumerate(both)]
    x = np.floor(64 * both.astype(float)).astype(np.int64) + 1_000_000
    check_whitening(whitening.whitened(vectors(spark, rows + ODD[1:3] + ODD[4:])).collect(), list(range(400)), x)


def test_whitening_cases(spark):
    assert whitening.whitened(vectors(spark, [])).count() == 0
    assert whitening.whitened(vectors(spark, [(1, None), (2, [None])])).count() == 0
    assert whitening.whitened(vectors(spark, [(1, [1.0, 2.0])] * 3)).count() == 0  # no variance
    rows = [(1, [0.0, 1.0]), (1, [0.0, 1.0]), (None, [2.0, 1.0]), (4, [9.0])]
    got = whitening.whitened(vectors(spark, rows)).collect()
    assert sorted((r.vec_id or 0, r.component, r.n, r.deviation) for r in got) == [(0, 1, 3, 256 ** 2), (1, 1, 3, 128 ** 2), (1, 1, 3, 128 ** 2)]
    assert all(r.explained == 1 for r in got)
