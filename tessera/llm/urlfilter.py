"""URL filter: allow and block rules, and a logistic regression for what no rule fits.

Rules are pairs (host, path): a rule fits its host and all subdomains if the
url's path starts with the rule's; the longest fitting rule wins. Other urls are
judged by a logistic regression on hashed character n-grams of host and path,
trained on the driver from a small labelled table (at most ``max_labelled`` rows
are read, those with the smallest hash) and broadcast as one weight vector.

Defined results: a null url, or one without ``://``, has an empty host and path
and is judged by the model's intercept alone; without labelled rows the model
allows; repeated rows are judged one by one; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import bytes_of, prefix_hash, ragged, window_hash

BUCKETS = 1 << 15
ORDERS = (1, 2, 3, 4)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parse(url: Column) -> tuple[Column, Column]:
    """(host, path) of a url, both empty without ``://``; only A-Z of the host are lower-cased."""
    after = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    after = F.coalesce(after, F.lit(""))
    host = F.regexp_extract(after, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(after, r"(?s)^[^/?#]*(/[^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def rule_of(host: Column, path: Column, rules) -> Column:
    """The longest fitting rule as (name, verdict), else null. ``rules``: (verdict, host, path) tuples."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        found = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def parsed(pages: DataFrame, rules, url_col: str = "url", keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """``keep`` columns, host, path, and the struct ``by_rule`` (null where no rule fits)."""
    rows = pages.select(*[F.col(c) for c in keep], F.col(url_col).alias("url"))
    host, path = parse(F.col("url"))
    rows = rows.select(*keep, host.alias("host"), path.alias("path"))
    return rows.withColumn("by_rule", rule_of(F.col("host"), F.col("path"), rules))


def features(hosts: pa.Array, paths: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bucket ids, ids per row): hashed n-grams of each framed host and each path."""
    ids, rows = [], []
    for salt, column in enumerate((hosts, paths)):
        texts = ["" if not t else f"\x02{t}\x03" for t in column.to_pylist()]
        data, offsets = bytes_of(pa.array(texts, pa.string()))
        prefix = prefix_hash(data)
        for n in ORDERS:
            counts = np.maximum(np.diff(offsets) - n + 1, 0)
            at = ragged(offsets[:-1], counts)
            h = window_hash(prefix, at, at + n) + np.uint64(n + 8 * salt)
            ids.append(((h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(49)).astype(np.int64))
            rows.append(np.repeat(np.arange(len(texts)), counts))
    ids, rows = np.concatenate(ids), np.concatenate(rows)
    order = np.argsort(rows, kind="stable")
    return ids[order], np.bincount(rows, minlength=len(hosts))


def _score(ids: np.ndarray, counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0.0], np.cumsum(weights[ids])])
    ends = np.cumsum(counts)
    total = sums[ends] - sums[ends - counts]
    return total / np.sqrt(np.maximum(counts, 1)) + weights[BUCKETS]


def train(labelled: DataFrame, max_labelled: int = 2000, penalty: float = 1e-3, steps: int = 300) -> np.ndarray:
    """Weights (last one: intercept) from rows (host, path, blocked); at most ``max_labelled`` are used."""
    rows = labelled.select("host", "path", F.col("blocked").cast("double").alias("y")).distinct()
    rows = rows.orderBy(F.xxhash64("host", "path"), "host", "path", "y").limit(max_labelled).toPandas()
    weights = np.zeros(BUCKETS + 1)
    if not len(rows):
        return weights
    ids, counts = features(pa.array(rows["host"], pa.string()), pa.array(rows["path"], pa.string()))
    y, n = rows["y"].to_numpy(), len(rows)
    share = np.clip(np.where(y > 0, y.mean(), 1 - y.mean()), 1 / n, 1)  # both classes weigh the same
    scale = np.repeat(1 / np.sqrt(np.maximum(counts, 1)), counts)
    of = np.repeat(np.arange(n), counts)
    speed = np.zeros_like(weights)
    for _ in range(steps):  # gradient descent with momentum on the mean log loss
        residual = 1 / (1 + np.exp(-np.clip(_score(ids, counts, weights), -30, 30))) - y
        residual *= 0.5 / share
        gradient = np.append(np.bincount(ids, residual[of] * scale, BUCKETS), residual.sum()) / n
        gradient[:BUCKETS] += penalty * weights[:BUCKETS]
        speed = 0.9 * speed - 1.0 * gradient
        weights += speed
    return weights


def judge(pages: DataFrame, weights: np.ndarray, keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """Add ``rule``, ``verdict`` and ``p_block`` to parsed pages."""
    shared = pages.sparkSession.sparkContext.broadcast(weights)
    names = [*keep, "host", "path", "rule"]
    rows = pages.select(*keep, "host", "path", F.col("by_rule.rule").alias("rule"), F.col("by_rule.verdict").alias("__by_rule"))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])

    def run(batches):
        for batch in batches:
            k = len(keep)
            ids, counts = features(batch.column(k), batch.column(k + 1))
            p = 1 / (1 + np.exp(-np.clip(_score(ids, counts, shared.value), -30, 30)))
            verdict = [r or ("block" if x > 0.5 else "allow") for r, x in zip(batch.column(k + 3).to_pylist(), p, strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in range(k + 3)), pa.array(verdict, pa.string()), pa.array(p)],
                                             [*names, "verdict", "p_block"])

    return rows.mapInArrow(run, f"{ddl}, verdict string, p_block double")
