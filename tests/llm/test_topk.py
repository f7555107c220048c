import numpy as np
import pytest

from tessera.llm import topk


def brute(rows, every, k):
    valid = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in rows
             if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, _ in valid if i % every == 0}):
        for v in sorted(v for i, v in valid if i == q)[:1]:
            scored = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in valid if i != q and len(w) == len(v))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return out


def rows():
    rng = np.random.default_rng(4)
    x = rng.standard_normal((400, 8)) * rng.lognormal(0, 1, (400, 1))
    out = [(k, v.tolist()) for k, v in enumerate(x)]
    out += [(500 + k, (x[k] + 0.01).tolist()) for k in range(40)]
    out += [(600 + k, x[7].tolist()) for k in range(12)]  # ties
    out += [(700, None), (701, []), (702, [1.0, None] + [0.0] * 6), (703, [float("nan")] * 8), (704, [float("inf")] * 8),
            (750, [0.0] * 8), (None, x[0].tolist()), (800, [1.0, 2.0]), (801, [3.0, -1.0]), (810, [5.0]), (3, x[3].tolist())]
    return out


@pytest.mark.parametrize("bucket", [4096, 16])
def test_brute_force(spark, monkeypatch, bucket):
    monkeypatch.setattr(topk, "BUCKET", bucket)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 7)
    df = spark.createDataFrame([(i, v, "x") for i, v in rows()], "vec_id long, embedding array<double>, norm string")
    vectors = topk.integers(df.repartition(3))
    out = topk.search(vectors.where("vec_id % 10 = 0"), vectors, 5).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in out) == sorted(brute(rows(), 10, 5))


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    vectors = topk.integers(df)
    assert topk.search(vectors, vectors, 5).collect() == []


def test_coordinate_pruning_keeps_what_reaches_the_threshold():
    rng = np.random.default_rng(1)
    p = rng.integers(-40, 40, (300, 5))
    p = p[np.argsort(-np.sqrt((p * p).sum(1)))]
    q = np.concatenate([p[:40], rng.integers(-40, 40, (20, 5))])
    pn, qn = np.sqrt((p * p).sum(1)), np.sqrt((q * q).sum(1))
    need = np.array([np.sort(p @ x)[-3] for x in q], float)
    got = {i: (s.tolist(), n.tolist()) for i, s, n in
           topk.bucket_scores(np.full(60, -1), q, qn, need, np.arange(300), p, pn, 5)}
    for i in range(60):
        s = p @ q[i]
        best = sorted(((-v, n) for n, v in enumerate(s.tolist()) if v >= need[i]))[:5]
        assert got[i] == ([-v for v, _ in best], [n for _, n in best])
