"""Readers and writers (S1-S14) on small files written to a per-test folder."""

import json
import os

from pyspark.sql import functions as F

from tessera.sources import files as S


def _write(path, text, mode="w", encoding="utf-8"):
    with open(path, mode, encoding=encoding) as f:
        f.write(text)
    return str(path)


def test_csv_tsv_delimited(spark, tmp_path):
    p = _write(tmp_path / "a.csv", "id,amount,kind\n1,2.5,x\n2,,y\n")
    df = S.read_csv(spark, p, "id int, amount double, kind string")
    assert [tuple(r) for r in df.orderBy("id").collect()] == [(1, 2.5, "x"), (2, None, "y")]
    t = _write(tmp_path / "b.tsv", "7\tfoo\n8\tbar\n")
    assert [tuple(r) for r in S.read_tsv(spark, t, "k int, v string").orderBy("k").collect()] == [(7, "foo"), (8, "bar")]
    d = _write(tmp_path / "c.csv", "a;b;c\n1;2;3\n")
    sub = S.read_delimited(spark, d, "a int, b int, c int", columns=["a", "c"])
    assert sub.columns == ["a", "c"] and tuple(sub.first()) == (1, 3)
    # the unused column never reaches the scan
    assert "ReadSchema: struct<a:int,c:int>" in sub._jdf.queryExecution().executedPlan().toString()


def test_head_scan_chunks_and_lines(spark, tmp_path):
    df = spark.range(100).withColumnRenamed("id", "k")
    assert [r.k for r in S.head_scan(df, 3, order_by="k").collect()] == [0, 1, 2]
    c = S.chunk_label(df, "k", 4)
    assert c.select("chunk").distinct().count() <= 4 and c.count() == 100
    # the same key always lands in the same slice
    again = S.chunk_label(df, "k", 4)
    assert c.join(again.withColumnRenamed("chunk", "c2"), "k").filter("chunk != c2").count() == 0
    p = _write(tmp_path / "l.txt", "﻿alpha\nbeta\n\ngamma\n")
    assert [r.value for r in S.read_lines(spark, p).collect()] == ["alpha", "beta", "gamma"]


def test_read_points(spark, tmp_path):
    rows = [{"lat": 55.7, "lon": 37.6, "tags": {"amenity": "cafe"}}, {"lat": 55.8, "lon": 37.5, "tags": {}}]
    p = _write(tmp_path / "p.json", "\n".join(json.dumps(r) for r in rows))
    df = S.read_points(spark, p)
    got = sorted((r.lat, dict(r.tags)) for r in df.collect())
    assert got == [(55.7, {"amenity": "cafe"}), (55.8, {})]


def test_read_region_json_skips_images_without_regions(spark, tmp_path):
    doc = {
        "a.jpg123": {"filename": "a.jpg", "size": 123, "regions": {
            "0": {"shape_attributes": {"name": "polygon", "all_points_x": [1, 5, 3], "all_points_y": [2, 2, 6]}},
            "1": {"shape_attributes": {"name": "polygon", "all_points_x": [0, 1, 1], "all_points_y": [0, 0, 1]}}}},
        "b.jpg9": {"filename": "b.jpg", "size": 9, "regions": {}},
    }
    p = _write(tmp_path / "via.json", json.dumps(doc, indent=2))
    df = S.read_region_json(spark, p)
    got = sorted((r.filename, r.region_id, r.shape, list(r.all_points_x)) for r in df.collect())
    assert got == [("a.jpg", "0", "polygon", [1, 5, 3]), ("a.jpg", "1", "polygon", [0, 1, 1])]


def test_read_coco_json_keeps_images_with_wanted_classes(spark, tmp_path):
    doc = {
        "images": [{"id": 1, "file_name": "1.jpg", "width": 10, "height": 8},
                   {"id": 2, "file_name": "2.jpg", "width": 10, "height": 8},
                   {"id": 3, "file_name": "3.jpg", "width": 10, "height": 8}],
        "annotations": [{"id": 10, "image_id": 1, "category_id": 1, "iscrowd": 0, "bbox": [0, 0, 2, 2],
                         "segmentation": [[0, 0, 2, 0, 2, 2], [1.5, 1, 1, 2, 2, 2]]},
                        {"id": 11, "image_id": 2, "category_id": 2, "iscrowd": 0, "bbox": [1, 1, 2, 2]},
                        {"id": 12, "image_id": 2, "category_id": 1, "iscrowd": 1, "bbox": [1, 1, 3, 3],
                         "segmentation": {"counts": [3, 4, 73], "size": [8, 10]}},
                        {"id": 13, "image_id": 3, "category_id": 1, "iscrowd": 1, "bbox": [1, 1, 3, 3],
                         "segmentation": {"counts": "a1b2", "size": [8, 10]}}],
        "categories": [{"id": 1, "name": "person"}, {"id": 2, "name": "car"}],
    }
    p = _write(tmp_path / "coco.json", json.dumps(doc, indent=1))
    out = S.read_coco_json(spark, p, class_ids=[2])
    assert [r.id for r in out["images"].collect()] == [2]
    assert [r.id for r in out["annotations"].collect()] == [11]
    assert [r.name for r in out["categories"].collect()] == ["car"]
    full = S.read_coco_json(spark, p)
    assert full["images"].count() == 3 and full["annotations"].count() == 4
    seg = {r.id: r for r in full["annotations"].collect()}
    assert seg[10].polygons == [[0, 0, 2, 0, 2, 2], [1.5, 1, 1, 2, 2, 2]] and seg[10].counts is None
    assert seg[12].counts == [3, 4, 73] and seg[12].size == [8, 10] and seg[12].polygons is None
    assert seg[13].counts_text == "a1b2" and seg[11].polygons is None and seg[11].counts_text is None


def test_list_images_takes_id_from_folder(spark, tmp_path):
    for img in ("abc", "def"):
        os.makedirs(tmp_path / "stage1" / img / "images")
        os.makedirs(tmp_path / "stage1" / img / "masks")
        _write(tmp_path / "stage1" / img / "images" / f"{img}.png", "png!", mode="w")
        _write(tmp_path / "stage1" / img / "masks" / "m0.png", "mask", mode="w")
    df = S.list_images(spark, str(tmp_path / "stage1"))
    assert "content" not in df.columns
    assert sorted(r.image_id for r in df.collect()) == ["abc", "def"]


def test_submission_features_parts_indices_round_trip(spark, tmp_path):
    ids = spark.createDataFrame([(30, 0), (10, 1), (20, 2)], "uid long, pos int")
    scores = spark.createDataFrame([(10, 0.5), (20, 0.25), (30, 0.75)], "uid long, score double")
    sub = str(tmp_path / "sub")
    S.write_submission(ids.join(scores, "uid"), sub, ["uid", "score"], order_col="pos")
    files = [f for f in os.listdir(sub) if f.startswith("part")]
    assert len(files) == 1
    with open(os.path.join(sub, files[0])) as f:
        assert f.read().splitlines() == ["uid,score", "30,0.75", "10,0.5", "20,0.25"]
    back = S.read_parts(spark, os.path.join(sub, "*part*"), "uid long, score double")
    assert back.count() == 3 and "source_file" in back.columns
    feats = str(tmp_path / "feats")
    S.write_features(scores.withColumn("split", F.when(F.col("uid") < 25, "train").otherwise("test")), feats,
                     partition_by="split")
    assert sorted(d for d in os.listdir(feats) if d.startswith("split=")) == ["split=test", "split=train"]
    idx = str(tmp_path / "idx")
    S.write_indices(spark.createDataFrame([(1, [3, 4, 0])], "uid long, seq array<int>"), idx)
    assert spark.read.parquet(idx).first().seq == [3, 4, 0]
