"""Merkle manifest of a dataset: a leaf per row, runs of 16, one subtree per source, one root, a proof per row.

Method: nested-struct rollup. The rank of a node is cut into base-16 digits; nodes are dealt to blocks of
256 consecutive ranks, and inside a block one digit column after the other is grouped away, each group
nesting its children's structs and adding their digest. Block digests are the nodes of the next tier, so a
tier has 256 times fewer rows than the one below and no group holds more than 16 structs. On the way down
the nested structs are exploded again: every child takes its siblings (text left and right of it, per
level) and the levels above. A block meets the levels above it by grouping, not by a join, and the final
transform folds each leaf's path. All steps are DataFrame functions; every key is (source, block) or finer,
so a source that holds a third of the rows is spread over its blocks.

Defined cases: null columns are written ``-``; an empty text is ``0:``; a null doc_id comes first in its
source and is never tampered with; rows of equal doc_id go by their leaf digest, and fully equal rows are
interchangeable, each with a place and a proof of its own; a null source is a source, before all others; an
empty table gives no row; columns that are not hashed are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.common import written
from tessera.operators.ranks import range_buckets

RUN = 16
#: Digits grouped away per tier; a block holds RUN ** DIGITS nodes.
DIGITS = 2
BLOCK = RUN ** DIGITS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PATH = "array<struct<l:string,r:string>>"


def _digest(parts: list[Column]) -> Column:
    """Digest of the fields: `-` for null, else UTF-8 length, colon, value."""
    def field(c: Column) -> Column:
        s = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))
    return F.sha2(F.concat(*[field(c) for c in parts]), 256)


def _joined(digests: Column) -> Column:
    return F.array_join(digests, "")


def leaves(docs: DataFrame, key: str = "source", tampered: Column | None = None) -> DataFrame:
    """(group, doc_id, leaf, changed): the leaf of every row, and the leaf of its tampered copy where
    ``tampered`` (a boolean column of ``docs``) holds. ``group`` orders as the key does, nulls first."""
    changed = [F.translate("text", _UPPER, _LOWER) if c == "text" else F.col(c) for c in FIELDS]
    hit = F.lit(False) if tampered is None else tampered
    return docs.select(F.coalesce(F.concat(F.lit("s"), F.col(key).cast("string")), F.lit("")).alias("group"), "doc_id",
                       _digest([F.col(c) for c in FIELDS]).alias("leaf"),
                       F.when(hit, _digest(changed)).alias("changed"))


def _ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``rank`` (from 0, in the order inside the group) and ``n`` (rows of the group). Contiguous
    ranges of the order are numbered apart; a group has one total per range, so no group meets in one task."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    t = range_buckets(rows.withColumn("_uid", F.monotonically_increasing_id())
                      .withColumn("_ord", F.struct(*order, "_uid")), "_ord", parts)
    totals = t.groupBy("group", "_bucket").agg(F.count(F.lit(1)).alias("m"))
    whole = W.partitionBy("group")
    offsets = totals.select("group", "_bucket", (F.sum("m").over(whole.orderBy("_bucket")) - F.col("m")).alias("before"),
                            F.sum("m").over(whole).alias("n"))
    inner = t.withColumn("_in", F.row_number().over(W.partitionBy("group", "_bucket").orderBy("_ord")) - 1)
    return inner.join(offsets, ["group", "_bucket"]).select(
        *rows.columns, (F.col("before") + F.col("_in")).cast("long").alias("rank"), "n")


def _levels() -> Column:
    """Levels of runs that a group of ``n`` nodes still has in this tier."""
    out = F.lit(DIGITS)
    for k in reversed(range(DIGITS)):
        out = F.when(F.col("n") <= RUN ** k, F.lit(k)).otherwise(out)
    return out


def _rolled(nodes: DataFrame, carried: tuple[str, ...]) -> DataFrame:
    """One tier up: (group, n, rank, digest) and what is carried become (group, n, block, digest, kids), the
    digits of the rank grouped away from the lowest up; kids nest DIGITS deep."""
    digit = [F.shiftright("rank", 4 * k).bitwiseAND(F.lit(RUN - 1)).cast("int").alias(f"d{k}") for k in range(DIGITS)]
    t = nodes.select("group", "n", F.shiftright("rank", 4 * DIGITS).alias("block"), "digest", *carried, *digit)
    t = t.repartition("group", "block")
    inside: tuple[str, ...] = carried
    for k in range(DIGITS):
        t = t.groupBy("group", "n", "block", *[f"d{i}" for i in range(k + 1, DIGITS)]).agg(
            F.sort_array(F.collect_list(F.struct(f"d{k}", "digest", *inside))).alias("kids"))
        t = t.withColumn("digest", F.when(_levels() > k, F.sha2(_joined(F.col("kids.digest")), 256))
                         .otherwise(F.col("kids")[0]["digest"]))
        inside = ("kids",)
    return t


def _above(blocks: DataFrame, paths: DataFrame) -> DataFrame:
    """Blocks with the levels above them, (path, subroot, root), which meet by grouping on (group, block)."""
    nothing = {"path": _PATH, "subroot": "string", "root": "string"}
    kids = blocks.schema["kids"].dataType
    both = blocks.select("group", "block", "n", "kids", *[F.lit(None).cast(v).alias(k) for k, v in nothing.items()]).unionByName(
        paths.select("group", "block", F.lit(None).cast("long").alias("n"), F.lit(None).cast(kids).alias("kids"), *nothing))
    return both.groupBy("group", "block").agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("n", "kids", *nothing)])


def _exploded(blocks: DataFrame) -> DataFrame:
    """Children of blocks with their path: own siblings per level, then the levels above. Adds ``rank`` and
    ``node``, the child's struct."""
    keep = ["group", "n", "subroot", "root"]
    t = blocks.withColumn("rank", F.col("block"))
    for k in reversed(range(DIGITS)):
        t = t.select(*keep, "rank", "path", F.col("kids.digest").alias("all"), F.posexplode("kids").alias("i", "node"))
        own = F.struct(_joined(F.slice("all", F.lit(1), F.col("i"))).alias("l"),
                       _joined(F.slice("all", F.col("i") + 2, F.lit(RUN))).alias("r"))
        t = t.select(*keep, (F.col("rank") * RUN + F.col("i")).alias("rank"),
                     F.when(_levels() > k, F.concat(F.array(own), "path")).otherwise(F.col("path")).alias("path"),
                     *([F.col("node.kids").alias("kids")] if k else ["node"]))
    return t


def _tiers(nodes: DataFrame, carried: tuple[str, ...], tag: str) -> list[DataFrame]:
    """Rolled tables of every tier, from the nodes up, until each group is one block."""
    out, left = [], None
    while left is None or left > BLOCK:
        t = written(_rolled(nodes, carried), f"{tag}{len(out)}")
        left = (t.agg(F.max("n")).first()[0] or 0) if left is None else -(-left // BLOCK)
        out.append(t)
        nodes = t.where(F.col("n") > BLOCK).select("group", F.ceil(F.col("n") / BLOCK).alias("n"),
                                                   F.col("block").alias("rank"), "digest")
        carried = ()
    return out


def _tops(tiers: list[DataFrame]) -> DataFrame:
    """(group, digest, tier): the one node that each group ends in, and the tier it ends in."""
    ends = [t.where(F.col("n") <= BLOCK).select("group", "digest", F.lit(k).alias("tier")) for k, t in enumerate(tiers)]
    out = ends[0]
    for e in ends[1:]:
        out = out.unionByName(e)
    return out


def _down(tiers: list[DataFrame], tops: DataFrame) -> DataFrame:
    """Nodes of the lowest tier with their path. ``tops`` adds (path, subroot, root) to the columns of ``_tops``."""
    t = None
    for k in reversed(range(len(tiers))):
        paths = tops.where(F.col("tier") == k).select("group", F.lit(0).cast("long").alias("block"), "path", "subroot", "root")
        if t is not None:
            paths = paths.unionByName(t.select("group", F.col("rank").alias("block"), "path", "subroot", "root"))
        t = _exploded(_above(tiers[k], paths))
    return t


def manifest(docs: DataFrame, key: str = "source", tampered: Column | None = None) -> DataFrame:
    """(doc_id, leaf, subroot, root, path, changed) of every row; path lists the siblings (l, r) of each
    level from the leaf's up, changed is the leaf of the tampered copy or null."""
    rows = written(leaves(docs, key, tampered), "leaves")
    nodes = _ranked(rows, ["doc_id", "leaf"]).withColumnRenamed("leaf", "digest")
    tiers = _tiers(nodes, ("doc_id", "changed"), "tier")
    groups = _tops(tiers).select(F.lit("").alias("group"), F.col("group").alias("name"), "digest", "tier")
    upper = _tiers(_ranked(groups, ["name"]), ("name", "tier"), "upper")
    root = _tops(upper).select("group", "tier", F.array().cast(_PATH).alias("path"), F.lit(None).cast("string").alias("subroot"),
                               F.col("digest").alias("root"))
    tops = _down(upper, root).select(F.col("node.name").alias("group"), F.col("node.tier").alias("tier"), "path",
                                     F.col("node.digest").alias("subroot"), "root")
    return _down(tiers, written(tops, "subroots")).select("node.doc_id", F.col("node.digest").alias("leaf"), "subroot", "root", "path",
                                       F.col("node.changed").alias("changed"))


def siblings(path: str = "path") -> Column:
    """Digest of all siblings of a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda p: F.concat(p["l"], p["r"])), ""), 256)


def folded(leaf: Column, path: str = "path") -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, leaf, lambda acc, p: F.sha2(F.concat(p["l"], acc, p["r"]), 256))


def proofs(docs: DataFrame, key: str = "source", tampered: Column | None = None) -> DataFrame:
    """The manifest with each proof as a digest, folded again from the (tampered, else original) leaf."""
    m = manifest(docs, key, tampered)
    out = m.select("doc_id", "leaf", "subroot", "root", siblings().alias("proof_sha256"),
                   folded(F.coalesce("changed", "leaf")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
