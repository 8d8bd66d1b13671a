import numpy as np
import pytest

from skeinwork.llm import ann as A


def brute(rows, every, k):
    """Every row is a candidate of every other; answers of the rows of one query id are joined."""
    own = []
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            w = np.array(v, dtype=float)
            w = w / np.abs(w).max()
            own.append((i, w / np.sqrt((w**2).sum())))
    sizes = {len(v) for _, v in own}
    data = {n: (np.array([i for i, v in own if len(v) == n]), np.array([v for _, v in own if len(v) == n])) for n in sizes}
    out = {}
    for n, (ids, vectors) in data.items():
        for j in np.flatnonzero(ids % every == 0).tolist():
            cosine = vectors @ vectors[j]
            best = [c for c in np.lexsort((ids, -cosine.round(12))).tolist() if c != j][:k]
            if best:
                out.setdefault(int(ids[j]), []).extend((-cosine[c], int(ids[c])) for c in best)
    return out


def answers(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((-r["score"], r["vec_id"]))
    return out


def test_small_tables_are_exact_with_odd_vectors_left_out(spark):
    rng = np.random.default_rng(1)
    rows = [(int(i), rng.normal(size=4).astype(np.float32).tolist()) for i in range(60)]
    rows += [(100, rows[0][1]), (101, rows[0][1]), (102, [0.0] * 4), (103, None), (104, [1.0, None, 2.0, 3.0]), (105, [float("nan")] * 4), (106, [float("inf"), 1.0, 1.0, 1.0]), (107, []), (None, rows[1][1]), (110, [1.0, 2.0]), (112, [2.0, 1.0]), (7, rows[7][1]), (114, [1e-200] * 4), (116, [1e200, 1e200, 2e200, 1e200]), (117, rows[3][1])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<float>, score int")
    got, want = answers(A.nearest(df, every=10)), brute(rows, 10, 5)
    assert {q: [c for _, c in x] for q, x in got.items()} == {q: [c for _, c in x] for q, x in want.items() if x}
    for q, x in got.items():
        assert np.allclose([s for s, _ in x], [s for s, _ in want[q]], atol=1e-12)
    assert [c for _, c in got[0]][:2] == [100, 101]
    assert A.nearest(df.limit(0)).count() == 0


def vectors(kind, size, n):
    rng = np.random.default_rng(size)
    if kind == "clusters":
        return (rng.normal(size=(n // 50, size))[rng.integers(0, n // 50, n)] + 0.3 * rng.normal(size=(n, size))).astype(np.float32)
    return rng.normal(size=(n, size)).astype(np.float32)


@pytest.mark.parametrize(("kind", "size", "n"), [("random", 32, 4000), ("clusters", 64, 4000), ("random", 64, 3000), ("clusters", 256, 2500), ("random", 256, 1500), ("random", 768, 1000)])
def test_recall(spark, kind, size, n):
    rows = [(int(i), v.tolist()) for i, v in enumerate(vectors(kind, size, n))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got, want = answers(A.nearest(df, every=20, block_rows=300, block_queries=40)), brute(rows, 20, 5)
    assert set(got) == set(want) and all(len(x) == 5 for x in got.values())
    hit = sum(len({c for _, c in got[q]} & {c for _, c in want[q]}) for q in want)
    assert hit / (5 * len(want)) >= 0.9
    assert all(c != q for q, x in got.items() for _, c in x)


def test_clusters_are_found_with_few_files_and_noise_needs_all(spark):
    def setting(kind, size):
        df = spark.createDataFrame([(int(i), v.tolist()) for i, v in enumerate(vectors(kind, size, 3000))], "vec_id long, embedding array<float>")
        rows = A._indexed(A._usable(df), A._chosen_pivots(A._usable(df), 64), 4, 20)
        rows = A.materialise(rows, "test-index")
        return A.measured_setting(rows, rows.filter("vec_id % 20 = 0"), 5, 64, 4, 0.95, 64, 1000)

    posted, probes, share = setting("clusters", 64)
    assert posted * probes * share <= 16
    assert setting("random", 768) == (1, 64, 1.0)


def test_the_exact_setting_is_exact(spark):
    rows = [(int(i), v.tolist()) for i, v in enumerate(vectors("random", 96, 1200))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got, want = answers(A.nearest(df, every=30, setting=(1, A.PIVOTS, 1.0), block_rows=200, block_queries=10)), brute(rows, 30, 5)
    assert {q: [c for _, c in x] for q, x in got.items()} == {q: [c for _, c in x] for q, x in want.items()}


def test_many_copies_of_a_vector_tie_to_the_smaller_id(spark):
    rng = np.random.default_rng(3)
    one = rng.normal(size=16).tolist()
    rows = [(int(i), one if i % 3 == 0 else rng.normal(size=16).tolist()) for i in range(1500)]
    got = answers(A.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), every=30, block_rows=200))
    assert [c for _, c in got[300]] == [0, 3, 6, 9, 12]
    assert [c for _, c in got[0]] == [3, 6, 9, 12, 15]
