import numpy as np
import pytest

from tessera.llm import rpforest


def brute(ids, vectors, threshold=0.9):
    x = np.array(vectors)
    x = x / np.linalg.norm(x, axis=1)[:, None]
    near = x @ x.T >= threshold
    parent = list(range(len(ids)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i, j in zip(*np.nonzero(near), strict=True):
        a, b = find(int(i)), find(int(j))
        parent[max(a, b)] = min(a, b)
    return near.sum(1) - 1, [ids[find(k)] for k in range(len(ids))]


def vectors():
    rng = np.random.default_rng(8)
    x = rng.standard_normal((1500, 24))
    x = np.concatenate([x, x[:300] + 0.08 * rng.standard_normal((300, 24)),
                        x[5] + 0.05 * rng.standard_normal((250, 24)), np.repeat(x[9:10], 120, 0)])
    return list(range(len(x))), x.tolist()


@pytest.mark.parametrize("group", [20_000, 400])
def test_recall_and_components(spark, monkeypatch, group):
    monkeypatch.setattr(rpforest, "GROUP", group)
    monkeypatch.setattr(rpforest, "TARGET", group // 2)
    ids, x = vectors()
    df = spark.createDataFrame([(i, v, "x") for i, v in zip(ids, x, strict=True)], "vec_id long, embedding array<double>, node string")
    out = {r.vec_id: r for r in rpforest.near_duplicates(df.repartition(3)).collect()}
    links, component = brute(ids, x)
    found = np.array([out[i].n_links for i in ids])
    assert (found <= links).all() and found.sum() >= 0.95 * links.sum()
    assert np.mean([out[i].component_id == c for i, c in zip(ids, component, strict=True)]) > 0.98
    assert all(r.kept == (r.vec_id == r.component_id) for r in out.values())


@pytest.mark.parametrize("share", [0.2, 0.5])
def test_upper_levels_keep_dense_groups(spark, monkeypatch, share):
    """Depth of a large table by a small TARGET: a group of near copies is not cut on the upper levels."""
    monkeypatch.setattr(rpforest, "GROUP", 200)
    monkeypatch.setattr(rpforest, "TARGET", 40)
    monkeypatch.setattr(rpforest, "LEAF", 20)
    rng = np.random.default_rng(4)
    n, m = 3000, int(3000 * share)
    x = rng.standard_normal((n, 24))
    x[:m] = x[0] + 0.28 * rng.standard_normal((m, 24))
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    out = {r.vec_id: r.n_links for r in rpforest.near_duplicates(df, trees=4).collect()}
    links, _ = brute(list(range(n)), x)
    found = np.array([out[i] for i in range(n)])
    assert (found <= links).all() and found.sum() >= (1.0 if share == 0.5 else 0.95) * links.sum()


def test_rows_that_take_no_part(spark):
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [1.0, 0.0]), (7, [2.0, 0.0]),
            (8, [1.0, 0.0]), (9, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (10, [1e200, 1e200]), (11, [1.0, 1.0]), (3, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in rpforest.near_duplicates(df).collect()), key=repr)
    assert out == sorted([(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True), (6, 2, 6, True),
                          (7, 2, 6, False), (8, 2, 6, False), (9, 0, 9, True), (None, 0, None, False), (10, 1, 10, True),
                          (11, 1, 10, False), (3, 0, 3, True)], key=repr)


def test_empty_table(spark):
    assert rpforest.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []
