import random
import zlib

import numpy as np
import public_tokenizers
from helpers import near_copy, words
from test_jaccard import brute as components
from test_suffix_dedup import brute as repeats
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from tessera.llm import pii

DDL = "doc_id long, text string, lang string, source string, n_chars long, spans string, kept string, component long"


def corpus():
    rng = random.Random(9)
    rows = [(k, " ".join(words(rng, rng.randrange(10, 200))) + " Ünd é.") for k in range(40)]
    rows += [(100 + k, " ".join(near_copy(rng, rows[k][1].split(), 1))) for k in range(15)]
    rows += [(200 + k, rows[k][1][:400] + " " + " ".join(words(rng, 150))) for k in range(20, 30)]
    rows += [(300, "write to me@ex.com or call +49 30 1234567"), (301, "jane (at) example [dot] com " * 2), (302, None), (303, ""),
             (304, "12 %% 34"), (305, rows[0][1]), (306, "é" * 4000), (307, "é" * 3000), (308, "tiny")]
    return rows


def brute(rows):
    """The pipeline's pieces, stage by stage, on plain Python values."""
    rows = [(k, t) for k, t in rows if t and any(c.isalpha() for c in t)]
    least = {k: c for k, _, c in components(rows)}
    rows = [(k, t) for k, t in rows if least[k] == k]
    cut = []
    for (k, t), (data, gone) in zip(rows, repeats(rows), strict=True):
        at, out = 0, []
        for c in t:
            size = len(c.encode())
            if not any(gone[at:at + size]):
                out.append(c)
            at += size
        if out or not data:
            cut.append((k, "".join(out)))
    rows = [(k, pii.redacted(t, pii.spans_of(t))) for k, t in cut]
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out = []
    for k, t in rows:
        ids = np.array([*tok.encode(t, add_special_tokens=False).ids, 1], "<u4")
        out += [(k, p // 4096, p, len(ids[p:p + 4096]), zlib.crc32(ids[p:p + 4096].tobytes())) for p in range(0, len(ids), 4096)]
    return sorted(out)


def table(spark, rows, path):
    full = [(k, t, "en" if k % 2 else None, None, None, "x", "y", 7) for k, t in rows]
    spark.createDataFrame(full, DDL).repartition(3).write.parquet(f"{path}/documents.parquet")
    return str(path)


def test_run_equals_brute_force(spark, tmp_path):
    rows = corpus()
    out = corpus_pipeline.run(spark, table(spark, rows, tmp_path)).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == brute(rows)


def test_stages_return_documents(spark, tmp_path):
    docs = spark.read.parquet(table(spark, corpus(), tmp_path) + "/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == list(corpus_pipeline.COLUMNS), name
    assert all(r.n_chars == len(r.text) for r in docs.collect())


def test_empty_table(spark, tmp_path):
    assert corpus_pipeline.run(spark, table(spark, [], tmp_path)).collect() == []


def test_every_query_is_registered():
    names = list(__spark_entry__.queries())
    for n in range(1, 11):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names and set(__spark_entry__.oracle_sql()) <= set(names)
