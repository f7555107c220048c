import hashlib
import random
import zlib

from pyspark.sql import functions as F

from tessera.llm import merkle

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, digest string, rank long"
OUT = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def digest(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, low=False):
    doc_id, text, lang, source, n_chars = row
    if low and text is not None:
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return digest("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text))


def tree(leaves):
    """Root of the leaves, and per leaf the (left, right) siblings of every level."""
    paths, nodes = [[] for _ in leaves], [(h, [i]) for i, h in enumerate(leaves)]
    while len(nodes) > 1:
        above = []
        for a in range(0, len(nodes), 16):
            run = nodes[a:a + 16]
            for j, (_, members) in enumerate(run):
                sides = "".join(x[0] for x in run[:j]), "".join(x[0] for x in run[j + 1:])
                for m in members:
                    paths[m].append(sides)
            above.append((digest(x[0] for x in run), [m for x in run for m in x[1]]))
        nodes = above
    return nodes[0][0], paths


def brute(rows):
    by_source = {}
    for r in rows:
        by_source.setdefault(r[3], []).append(r)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        by_source[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[s] = tree([leaf(r) for r in by_source[s]])
    if not order:
        return []
    root, upper = tree([trees[s][0] for s in order])
    out = []
    for s, up in zip(order, upper):
        for r, path in zip(by_source[s], trees[s][1]):
            path = path + up
            h = leaf(r, r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0)
            for left, right in path:
                h = digest([left, h, right])
            out.append((r[0], leaf(r), trees[s][0], root, digest(a + b for a, b in path), h, h == root))
    return out


def proofs(spark, rows, parts=5):
    docs = spark.createDataFrame([(*r, "x", 7) for r in rows], COLUMNS).repartition(parts)
    out = merkle.proofs(docs, tampered=F.crc32(F.col("doc_id").cast("string")) % 5 == 0)
    assert out.columns == list(OUT)
    return [tuple(r) for r in out.collect()]


def same(got, expected):
    return sorted(map(repr, got)) == sorted(map(repr, expected))


def test_against_brute_force_with_nulls_ties_and_copies(spark):
    rng = random.Random(5)
    text = lambda: "".join(rng.choice("aBcÉß \n") for _ in range(rng.randrange(30)))
    rows = [(k, text(), "en", "hot", 3) for k in range(1200)]                         # five levels of digits
    rows += [(k, text(), None, rng.choice(["a", "b", "é", "", None]), None) for k in range(90)]
    rows += [(7, "Same", "en", "copies", 4)] * 300 + [(7, "Other", "en", "copies", 5)] * 3
    rows += [(None, "x", "en", "nulls", 1), (None, None, None, "nulls", None), (10, "", "de", "nulls", 0)]
    rows += [(5000 + k, text(), "en", f"s{k:03d}", 1) for k in range(290)]            # over 256 sources
    assert same(proofs(spark, rows), brute(rows))


def test_sizes_around_runs_and_blocks(spark):
    for n in (0, 1, 17, 257):
        rows = [(k, f"T{k}", "en", "s", k) for k in range(n)]
        assert same(proofs(spark, rows), brute(rows)), n


def test_a_tampered_row_fails_and_long_texts_hash_whole(spark):
    rows = [(k, "A" * 2_000_000 if k == 3 else f"Word {k}", "en", "s", 1) for k in range(40)]
    got = proofs(spark, rows)
    assert same(got, brute(rows))
    assert {r[0] for r in got if not r[6]} == {k for k in range(40) if zlib.crc32(str(k).encode()) % 5 == 0}


def test_no_join_carries_the_levels_to_the_leaves(spark):
    docs = spark.createDataFrame([(k, "t", "en", "s", 1, "x", 7) for k in range(50)], COLUMNS)
    plan = merkle.manifest(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Generate" in plan
