import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import svd
from tessera.operators.svd import tall_r, truncated_svd


def _matrix(rows):
    return np.array([[r[f"svd_{j}"] for j in range(len(r) - 1)] for r in rows])


def _long(spark, a, parts=5):
    i, j = np.nonzero(a)
    rows = [(int(x), int(y), float(a[x, y])) for x, y in zip(i, j)]
    return spark.createDataFrame(rows, "row long, col long, v double").repartition(parts)


def _sparse(n, m, seed, share=0.1):
    rng = np.random.default_rng(seed)
    a = rng.normal(size=(n, m)) * (rng.random((n, m)) < share)
    a[:, 0] = rng.normal(size=n) + 3  # a column that every row has
    a[0] = rng.normal(size=m)  # a row that has every column
    return a


def test_projection_equals_dense_svd(spark, monkeypatch):
    monkeypatch.setattr(svd, "BLOCK_CELLS", 21 * 600)  # rows and columns span blocks
    a = _sparse(200, 90, 1)
    got = sorted(truncated_svd(_long(spark, a), "row", "col", "v", 5).collect())
    assert [r.row for r in got] == list(range(200))
    u, s, _ = np.linalg.svd(a, full_matrices=False)
    ours = _matrix(got)
    assert (ours ** 2).sum(0) == pytest.approx(s[:5] ** 2, rel=1e-6)
    assert np.abs(ours) == pytest.approx(np.abs(u[:, :5] * s[:5]), abs=1e-3)


def test_rank_below_k_and_steep_spectrum(spark):
    rng = np.random.default_rng(2)
    u, _ = np.linalg.qr(rng.normal(size=(60, 4)))
    v, _ = np.linalg.qr(rng.normal(size=(30, 4)))
    s = np.array([1e6, 1e3, 1.0, 1e-2])
    ours = _matrix(truncated_svd(_long(spark, u * s @ v.T), "row", "col", "v", 6).collect())
    assert np.sqrt((ours ** 2).sum(0))[:4] == pytest.approx(s, rel=1e-6)
    assert np.abs(ours[:, 4:]).max() < 1e-6


def test_nulls_repeats_ties_text_keys_and_empty(spark):
    rows = [("a", 1, 1.0), ("a", 1, 1.0), ("b", 2, 2.0), ("c", 7, None), ("d", 7, float("nan")), (None, 1, 5.0), ("e", None, 5.0)]
    df = spark.createDataFrame(rows, "key string, col int, v double").withColumn("vec", F.lit(1))
    got = {r.key: [r.svd_0, r.svd_1, r.svd_2] for r in truncated_svd(df, "key", "col", "v", 3).collect()}
    assert sorted(got) == ["a", "b", "c", "d"]
    assert np.linalg.norm(got["a"]) == pytest.approx(2.0) and np.linalg.norm(got["b"]) == pytest.approx(2.0)
    assert got["c"] == [0, 0, 0] and got["d"] == [0, 0, 0]
    assert truncated_svd(df.where("key = 'c'"), "key", "col", "v", 2).first().svd_1 == 0
    empty = truncated_svd(df.limit(0), "key", "col", "v", 2)
    assert empty.columns == ["key", "svd_0", "svd_1"] and empty.collect() == []


def test_tall_r_merges_many_partitions(spark):
    x = np.random.default_rng(3).normal(size=(400, 4))
    tall = spark.createDataFrame([(k, r.tolist()) for k, r in enumerate(x)], "id long, vec array<double>").repartition(40)
    r = tall_r(tall, 4)
    assert r.T @ r == pytest.approx(x.T @ x)


def test_no_row_wise_rdd_in_the_plan(spark):
    blocks = svd._blocks(_long(spark, _sparse(30, 20, 4)), "row", "col", "v", 100)
    tall = blocks.select(F.explode("cols").alias("id")).distinct().withColumn("vec", F.array(F.lit(1.0), F.lit(2.0)))
    plan = svd._product(blocks, tall, 2)._jdf.queryExecution().toString()
    assert "partial_sum" in plan and "CoGroupInArrow" in plan.replace("FlatMapCoGroupsInArrow", "CoGroupInArrow")
    assert "CartesianProduct" not in plan and "BatchEvalPython" not in plan


def test_a_step_there_and_back_writes_no_left_side(spark, monkeypatch):
    a = _sparse(150, 70, 5)
    tall = spark.createDataFrame([(k, x.tolist()) for k, x in enumerate(np.random.default_rng(6).normal(size=(70, 3)))], "id long, vec array<double>")
    x = _vectors(tall)
    for size, cut in ((400, 0), (40, 1)):  # the second: one row, 70 entries, is longer than a block
        blocks = svd._blocks(_long(spark, a), "row", "col", "v", size)
        rows = [(r, b.whole) for b in blocks.collect() for r in b.rows]
        assert {r for r, whole in rows if not whole} == {0} if cut else all(whole for _, whole in rows)
        assert len([r for r, whole in rows if whole]) == len({r for r, whole in rows if whole}) == 150 - cut
        assert max(len(b.v) for b in blocks.collect()) <= size
        writes = []
        with monkeypatch.context() as m:
            m.setattr(svd, "cut_lineage", lambda df: writes.append(1) or df)
            got = svd._there_and_back(blocks, svd._routes(blocks, "cols"), bool(cut), tall, 3, 0.5, [(tall, -1.0)])
            assert _vectors(got) == pytest.approx(0.5 * a.T @ a @ x - x)
        assert len(writes) == cut


def _vectors(tall):
    return np.array([r.vec for r in sorted(tall.collect(), key=lambda r: r.id)])


def test_a_polynomial_of_the_matrix_costs_one_write_a_degree(spark, monkeypatch):
    writes, cut = [], svd.cut_lineage
    monkeypatch.setattr(svd, "cut_lineage", lambda df: writes.append(1) or cut(df))
    passes, degree = [], svd._degree
    monkeypatch.setattr(svd, "_degree", lambda s: passes.append(degree(s)) or passes[-1])
    truncated_svd(_long(spark, _sparse(200, 90, 1)), "row", "col", "v", 5).count()
    degrees = [d for d in passes if d > 1]
    assert degrees and len(writes) <= sum(degrees) + 2 * len(degrees) + 8


def _written(spark):
    from tessera.session import ensure_checkpoint_dir
    where = spark._jvm.org.apache.hadoop.fs.Path(ensure_checkpoint_dir(spark))
    return {str(f.getPath()) for f in where.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(where)}


def test_only_the_result_stays_written(spark):
    before = _written(spark)
    out = truncated_svd(_long(spark, _sparse(200, 90, 1)), "row", "col", "v", 5)
    assert len(_written(spark) - before) == 1
    assert out.count() == 200 and spark.conf.get("spark.sql.adaptive.enabled") == "true"
    nothing = truncated_svd(_long(spark, np.zeros((3, 3))), "row", "col", "v", 2)
    assert nothing.collect() == []


def test_the_matrix_stays_where_it_is(spark):
    from tessera.session import settings
    blocks = svd._blocks(_long(spark, _sparse(150, 70, 5)), "row", "col", "v", 400)
    tall = blocks.select(F.explode("cols").alias("id")).distinct().withColumn("vec", F.array(F.lit(1.0), F.lit(2.0)))
    with settings(spark, spark__sql__adaptive__enabled="false"):
        blocks = svd._dealt(blocks, "blk", 12)
        plan = svd._there_and_back(blocks, svd._routes(blocks, "cols"), False, tall, 2)._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert moved and not [line for line in moved if "hashpartitioning(blk" in line]


def test_spent_tables_go_before_the_range_is_searched(spark, monkeypatch):
    from tessera.session import outlive, packed_table, scratch
    seen, dealt = [], svd._dealt
    with scratch(spark):
        with scratch(spark):
            long = outlive(packed_table(_long(spark, _sparse(60, 40, 2))))
        assert any(long._packed.split("/")[-1] in f for f in _written(spark))
        monkeypatch.setattr(svd, "_dealt", lambda *a: seen.append(any(long._packed.split("/")[-1] in f for f in _written(spark))) or dealt(*a))
        out = truncated_svd(long, "row", "col", "v", 3, spent=[long])
    assert seen == [False] and out.count() == 60


def test_half_of_the_directions_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(svd, "HALVED", 0)
    degrees, degree = [], svd._degree
    monkeypatch.setattr(svd, "_degree", lambda s: degrees.append(degree(s)) or degrees[-1])
    a = _sparse(200, 90, 1)
    before = _written(spark)
    out = truncated_svd(_long(spark, a), "row", "col", "v", 5)
    assert len(_written(spark) - before) == 1 and max(degrees) > 1
    u, s, _ = np.linalg.svd(a, full_matrices=False)
    assert np.abs(_matrix(sorted(out.collect()))) == pytest.approx(np.abs((u * s)[:, :5]), abs=1e-5)


def test_earlier_vectors_are_added_without_moving(spark):
    from tessera.session import settings
    blocks = svd._blocks(_long(spark, _sparse(150, 70, 5)), "row", "col", "v", 400)
    tall = blocks.select(F.explode("cols").alias("id")).distinct().withColumn("vec", F.array(F.lit(1.0), F.lit(2.0)))
    with settings(spark, spark__sql__adaptive__enabled="false", spark__sql__shuffle__partitions=4, spark__sql__autoBroadcastJoinThreshold=-1):
        routes = svd._routes(blocks, "cols")
        step = svd.cut_lineage(svd._there_and_back(blocks, routes, False, tall, 2))
        plan = svd._sums(routes.select("id", F.lit(None).cast("array<double>").alias("vec")), 2, [(step, -2.0)])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
