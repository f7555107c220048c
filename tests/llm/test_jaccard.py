import random
from collections import defaultdict

import numpy as np
import pytest
from helpers import docs_df, near_copy, words
from pyspark.sql import functions as F

from tessera.llm import blocks, jaccard


def shingles(text):
    w = (text or "").encode().lower().split()
    if len(w) < 5:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4))


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    least = defaultdict(list)
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[find(i)].append(k)
    return sorted(((k, len(sets[i]), min(least[find(i)], default=None)) for i, (k, _) in enumerate(rows)), key=repr)


def corpus():
    rng = random.Random(5)
    rows = []
    for g in range(25):
        base = words(rng, rng.randrange(8, 160))
        rows.append((1000 + g, " ".join(base)))
        for _ in range(rng.randrange(6)):
            rows.append((5000 + len(rows), " ".join(near_copy(rng, base, rng.randrange(1, 6))).upper()))
    passage = words(rng, 60)
    rows += [(2000 + k, " ".join(words(rng, rng.randrange(5, 30)) + passage)) for k in range(30)]
    hub = words(rng, 120)
    rows += [(3000 + k, " ".join(near_copy(rng, hub, 2))) for k in range(60)]
    rows += [(1, "a b c"), (2, "A  b\tc"), (3, "c b a"), (4, None), (5, ""), (6, " \n "), (7, None)]
    rows += [(8, "tie " * 50), (9, "tie " * 70), (9, "tie " * 70), (None, "a b c"), (None, "only null here now yes")]
    rows += [(10, " ".join(words(rng, 30000, 50)))]
    return rows


@pytest.mark.parametrize("keys", [None, 100])
def test_brute_force(spark, monkeypatch, keys):
    if keys:
        monkeypatch.setattr(blocks, "BUCKET_KEYS", keys)
    rows = corpus()
    out = jaccard.join_components(docs_df(spark, rows))
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out.collect()), key=repr) == brute(rows)


def test_one_per_component(spark):
    rows = [r for r in dict(corpus()).items() if r[0] is not None]
    out = jaccard.one_per_component(docs_df(spark, rows), keep=("lang",)).collect()
    assert sorted(r.doc_id for r in out) == sorted({c for _, _, c in brute(rows)})


def test_partitions_beyond_2048(spark, monkeypatch):
    """Blocks numbered as those of partitions 0, 2048 and 4096 keep their links and their own row ids."""
    build = blocks.build

    def far(*args):
        table, path = build(*args)
        return table.withColumn("block", F.col("block") + F.shiftright("block", 32) * (2047 << 32)), path

    monkeypatch.setattr(blocks, "build", far)
    rng = random.Random(3)
    rows = {}
    for k in (0, 2, 4):
        base = words(rng, 80)
        rows |= {k: " ".join(base), k + 1: " ".join(near_copy(rng, base, 1))}
    text = F.element_at(F.create_map(*[F.lit(x) for kv in rows.items() for x in kv]), F.col("id").cast("int"))
    docs = spark.range(0, 6, 1, 3).select(F.col("id").alias("doc_id"), text.alias("text"))
    out = jaccard.join_components(docs)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in out.collect()) == brute(list(rows.items()))
    kept = jaccard.one_per_component(docs).collect()
    assert {r.doc_id: r.text for r in kept} == {k: rows[k] for k in (0, 2, 4)}


def test_empty_table(spark):
    assert jaccard.join_components(docs_df(spark, [])).collect() == []


def test_prefixes_share_the_asked_matches():
    """Any two similar sets share min(k, k') tokens of their prefixes, whatever k each takes."""
    rng = random.Random(1)
    for _ in range(300):
        universe = list(range(60))
        a = set(rng.sample(universe, rng.randrange(4, 40)))
        b = set(a) - set(rng.sample(sorted(a), rng.randrange(0, len(a) // 5 + 1))) | set(rng.sample(universe, rng.randrange(3)))
        if 100 * len(a & b) < 75 * len(a | b):
            continue
        cut = []
        for s in (a, b):
            overlap = int(jaccard.smallest_overlap(np.array(len(s)), 75))
            k = rng.randrange(1, min(8, overlap) + 1)
            cut.append((k, set(sorted(s)[:len(s) - overlap + k])))
        assert len(cut[0][1] & cut[1][1]) >= min(cut[0][0], cut[1][0])


def test_costly_sets_ask_more_matches():
    code = np.full(40, 200, np.uint8)
    k, length = jaccard.choose_prefixes(np.array([40]), np.array([0]), code, 75, 8)
    assert k[0] > 1 and length[0] == 40 - 30 + k[0]
