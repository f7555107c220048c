"""File readers and writers (S1-S14). Every reader declares its schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

__all__ = ["read_csv", "read_tsv", "read_delimited", "head_scan", "chunk_label", "read_lines",
           "read_points", "POINTS_SCHEMA", "read_region_json", "read_coco_json", "list_images",
           "write_submission", "write_features", "read_parts", "write_indices", "schema_of"]


def schema_of(spec) -> T.StructType:
    """'a int, b string' or a StructType."""
    if isinstance(spec, T.StructType):
        return spec
    return T._parse_datatype_string(spec) if isinstance(spec, str) else T.StructType(spec)


def read_csv(spark: SparkSession, path: str, schema, header: bool = True, sep: str = ",") -> DataFrame:
    """CSV with header and a declared schema."""
    return (spark.read.schema(schema_of(schema)).option("header", header)
            .option("sep", sep).option("mode", "PERMISSIVE").csv(path))


def read_tsv(spark: SparkSession, path: str, schema) -> DataFrame:
    """Tab file without header; names come from the schema."""
    return read_csv(spark, path, schema, header=False, sep="\t")


def read_delimited(spark: SparkSession, path: str, schema, sep: str = ";", columns=None,
                   header: bool = True) -> DataFrame:
    """Other delimiter plus a column subset; Catalyst prunes the rest at the scan (S3)."""
    df = read_csv(spark, path, schema, header=header, sep=sep)
    return df.select(*columns) if columns else df


def head_scan(df: DataFrame, n: int, order_by=None) -> DataFrame:
    """First n rows; deterministic when an order is given."""
    if order_by:
        df = df.orderBy(*([order_by] if isinstance(order_by, str) else order_by))
    return df.limit(n)


def chunk_label(df: DataFrame, key: str, n_chunks: int, name: str = "chunk") -> DataFrame:
    """Slice label per key instead of walking the file in slices (S5). A key never straddles slices."""
    return df.withColumn(name, F.pmod(F.xxhash64(F.col(key)), F.lit(n_chunks)).cast("int"))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One value per line, newline and byte-order mark removed."""
    return (spark.read.text(path)
            .select(F.regexp_replace(F.col("value"), "^﻿", "").alias("value"))
            .filter(F.length(F.trim("value")) > 0))


POINTS_SCHEMA = "lat double, lon double, tags map<string,string>"


def read_points(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Map points with tag maps."""
    return spark.read.schema(schema_of(POINTS_SCHEMA)).format(fmt).load(path)


_REGION_DDL = (
    "map<string, struct<filename: string, size: bigint, regions: map<string, struct<"
    "shape_attributes: struct<name: string, all_points_x: array<int>, all_points_y: array<int>>>>>>"
)


def read_region_json(spark: SparkSession, path: str) -> DataFrame:
    """Polygon annotation JSON (one object keyed by image); images without regions skipped.

    The file is one JSON object whose keys are image keys, so it is read whole and parsed
    as a map; one task per file. Returns image_key, filename, region_id, shape,
    all_points_x, all_points_y.
    """
    raw = spark.read.text(path, wholetext=True)
    img = raw.select(F.explode(F.from_json("value", _REGION_DDL)).alias("image_key", "img"))
    img = img.filter(F.size(F.coalesce(F.col("img.regions"), F.create_map())) > 0)
    reg = img.select("image_key", F.col("img.filename").alias("filename"),
                     F.explode("img.regions").alias("region_id", "r"))
    return reg.select("image_key", "filename", "region_id",
                      F.col("r.shape_attributes.name").alias("shape"),
                      F.col("r.shape_attributes.all_points_x").alias("all_points_x"),
                      F.col("r.shape_attributes.all_points_y").alias("all_points_y"))


_COCO_SCHEMA = T.StructType([
    T.StructField("images", T.ArrayType(T.StructType([
        T.StructField("id", T.LongType()), T.StructField("file_name", T.StringType()),
        T.StructField("width", T.IntegerType()), T.StructField("height", T.IntegerType())]))),
    T.StructField("annotations", T.ArrayType(T.StructType([
        T.StructField("id", T.LongType()), T.StructField("image_id", T.LongType()),
        T.StructField("category_id", T.IntegerType()), T.StructField("iscrowd", T.IntegerType()),
        T.StructField("bbox", T.ArrayType(T.DoubleType())),
        T.StructField("segmentation", T.StringType())]))),
    T.StructField("categories", T.ArrayType(T.StructType([
        T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType())]))),
])


def read_coco_json(spark: SparkSession, path: str, class_ids=None) -> dict[str, DataFrame]:
    """COCO instances file -> images, annotations, categories; only images holding the wanted classes.

    A segmentation comes as ``polygons`` (lists of x, y, x, y, ...) or as the run ``counts`` of an
    uncompressed mask with its ``size`` (height, width); a compressed mask keeps its text in
    ``counts_text``. The codec of the latter is not built."""
    raw = spark.read.option("multiLine", True).schema(_COCO_SCHEMA).json(path)
    images = raw.select(F.explode("images").alias("i")).select("i.*")
    anns = raw.select(F.explode("annotations").alias("a")).select("a.*")
    seg = F.col("segmentation")
    runs = F.from_json(seg, "counts array<long>, size array<int>")
    anns = anns.withColumns({"polygons": F.when(seg.startswith("["), F.from_json(seg, "array<array<double>>")),
                             "counts": F.when(seg.startswith("{"), runs["counts"]), "size": F.when(seg.startswith("{"), runs["size"]),
                             "counts_text": F.when(seg.rlike(r'"counts"\s*:\s*"'), F.get_json_object(seg, "$.counts"))}).drop("segmentation")
    cats = raw.select(F.explode("categories").alias("c")).select("c.*")
    if class_ids is not None:
        cats = cats.filter(F.col("id").isin(list(class_ids)))
        anns = anns.join(cats.select(F.col("id").alias("category_id")), "category_id", "left_semi")
        images = images.join(anns.select(F.col("image_id").alias("id")), "id", "left_semi")
    return {"images": images, "annotations": anns, "categories": cats}


def list_images(spark: SparkSession, root: str, pattern: str = "*.png",
                id_regex: str = r"([^/]+)/images/[^/]+$") -> DataFrame:
    """Image catalogue from a directory tree; the id is taken from the path (S10). Content is dropped."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .option("pathGlobFilter", pattern).load(root).select("path", "length"))
    out = files.select(F.regexp_extract("path", id_regex, 1).alias("image_id"), "path", "length")
    return out.filter(F.col("image_id") != "")  # files outside the image layout (masks, extras)


def write_submission(df: DataFrame, path: str, columns, order_col: str | None = None,
                     header: bool = True) -> None:
    """One CSV in id-list order (S11). The id list carries its position column."""
    out = df.orderBy(order_col) if order_col else df
    out.select(*columns).coalesce(1).write.mode("overwrite").option("header", header).csv(path)


def write_features(df: DataFrame, path: str, partition_by=None) -> None:
    """Intermediate marts as Parquet."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.parquet(path)


def read_parts(spark: SparkSession, pattern: str, schema, header: bool = True) -> DataFrame:
    """All result files whose name contains 'part' (S13)."""
    return read_csv(spark, pattern, schema, header=header).withColumn("source_file", F.input_file_name())


def write_indices(df: DataFrame, path: str) -> None:
    """Padded token-id sequences per user (array<int> column) as Parquet."""
    df.write.mode("overwrite").parquet(path)
