import numpy as np
import pytest
from pyspark.sql import functions as F

from camlytics.llm import nearest

KIND = "vec_id long, embedding array<float>, label int, bucket long, dim int"
QUERY = "vec_id % 50 = 0"


def frame(spark, ids, vectors):
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v], 0, 1, 2) for i, v in zip(ids, vectors)]
    return spark.createDataFrame(rows, KIND)


def exact(ids, vectors, k=5):
    """Nearest by brute force: {query: [(id, score)]}."""
    ids, v = np.array(ids), np.array(vectors, dtype=np.float32).astype(np.float64)
    out = {}
    for q in np.flatnonzero(ids % 50 == 0):
        score = (v * v[q]).sum(1) / np.sqrt((v * v).sum(1)) / np.sqrt((v[q] * v[q]).sum())
        order = [i for i in np.lexsort((ids, -score)) if ids[i] != ids[q]][:k]
        out[int(ids[q])] = [(int(ids[i]), float(score[i])) for i in order]
    return out


def got(df, **options):
    out = {}
    for r in nearest.search(df, F.expr(QUERY), **options).orderBy("query_id", "rank").collect():
        found = out.setdefault(r.query_id, [])
        found.append((r.vec_id, r.score))
        assert r["rank"] == len(found)
    return out


def recall(found, expected):
    return np.mean([len({i for i, _ in found.get(q, [])} & {i for i, _ in e}) / len(e) for q, e in expected.items()])


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall_against_brute_force(spark, sf):
    table = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
    rows = table.select("vec_id", "embedding").collect()
    expected = exact([r.vec_id for r in rows], [r.embedding for r in rows])
    found = got(table)
    assert found.keys() == expected.keys() and all(len(f) == 5 for f in found.values())
    assert recall(found, expected) >= 0.9
    for q, f in found.items():
        known = dict(exact_scores(rows, q))
        assert all(s == pytest.approx(known[i], abs=1e-12) for i, s in f)


def exact_scores(rows, query):
    v = {r.vec_id: np.array(r.embedding, dtype=np.float64) for r in rows}
    q = v[query]
    return [(i, float((x * q).sum() / np.sqrt((x * x).sum()) / np.sqrt((q * q).sum()))) for i, x in v.items()]


def test_clusters_larger_than_a_block(spark):
    draw = np.random.default_rng(3)
    centers = draw.normal(size=(4, 16))
    vectors = centers[draw.integers(0, 4, 1500)] + 0.05 * draw.normal(size=(1500, 16))
    vectors[700:1100] = vectors[700]  # very many equal vectors: ties go to the smaller id
    ids = list(range(1500))
    found = got(frame(spark, ids, vectors))
    expected = exact(ids, vectors)
    assert recall(found, expected) >= 0.9
    assert [i for i, _ in found[750]] == [700, 701, 702, 703, 704]


def test_odd_vectors_take_no_part(spark):
    ids = [0, 50, 1, 2, 3, 4, 5, 6, None, 7, 7, 100]
    vectors = [
        [1, 0, 0], None, [1, 1, 0], [0, 0, 0], [1, float("nan"), 0], [float("inf"), 0, 0], [1, None, 2], [1, 0], [1, 0, 0], [2, 0, 0], [2, 0, 0], [],
    ]
    found = got(frame(spark, ids, vectors))
    assert found == {0: [(7, 1.0), (1, pytest.approx(0.5**0.5))]}


def test_few_rows_give_all(spark):
    found = got(frame(spark, [0, 1, 2], [[1, 0], [-1, 0.1], [0, -1]]), cells=1)
    assert [i for i, _ in found[0]] == [2, 1]
    assert got(frame(spark, [0], [[1, 0]])) == {}
    assert got(frame(spark, [], [])) == {}
