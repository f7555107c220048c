import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from helpers import docs_df
from tokenizers import Tokenizer

from tessera.llm import packing
from tessera.llm.common import bytes_of

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["It's we'll THEY'VE don't'a", "a.b,c;d:e!f?g 1.5", "<|endoftext|> x<|StartOfText|>y <|startoftext|>.", "tab\tand space　x\x1fz",
       "H̱ é É Éa. ÀÇ! Ä.̈", "…. a….b “q”. ×. ÷!", "\x01 a\x01b \x01\x01", "日本語。テスト Σίσυφος ΟΔΟΣ", "x" * 3000, "İstanbul ﬁne ①②", "🎉🎉.", " ", "\n\n a\n"]


def test_word_store_equals_the_tokenizer():
    store = packing.WordTokens(PATH)
    tok = Tokenizer.from_file(PATH)
    for _ in range(2):  # the second time from the store
        data, offsets = bytes_of(pa.array([*ODD, None, ""]))
        ids, lens = store.encode(data, offsets)
        ends = np.cumsum(lens)
        for k, t in enumerate([*ODD, "", ""]):
            assert ids[ends[k] - lens[k]:ends[k]].tolist() == [*tok.encode(t, add_special_tokens=False).ids, 1], t


def check_plan(counts, capacity):
    rows, sequences = packing.plan_packing(counts, capacity)
    used, taken = defaultdict(list), defaultdict(list)
    for length, lo, hi, first, offset, run in rows.tolist():
        taken[length].append((lo, hi))
        for r in range(hi - lo):
            used[first + r // run].append((offset + r % run * length, length))
    for length in np.flatnonzero(counts).tolist():
        spans = sorted(taken[length])
        assert spans[0][0] == 0 and spans[-1][1] == counts[length]
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False))
    assert set(used) == set(range(sequences))
    for parts in used.values():
        parts.sort()
        at = 0
        for offset, length in parts:
            assert offset == at
            at += length
        assert at <= capacity
    return sequences


@pytest.mark.parametrize("seed", range(12))
def test_plan_is_a_packing(seed):
    rng = np.random.default_rng(seed)
    capacity = int(rng.integers(4, 200))
    counts = np.zeros(capacity + 1, np.int64)
    for length in rng.integers(1, capacity + 1, rng.integers(1, 60)):
        counts[length] += rng.integers(1, 50)
    sequences = check_plan(counts, capacity)
    assert sequences <= 1.25 * np.ceil((counts * np.arange(capacity + 1)).sum() / capacity) + 1 or \
        sequences <= counts[capacity // 2 + 1:].sum() + np.ceil((counts * np.arange(capacity + 1)).sum() / capacity)


def test_exact_complements_fill_whole_sequences():
    counts = np.zeros(101, np.int64)
    for length, n in ((100, 3), (60, 5), (40, 5), (50, 4), (70, 2), (20, 2), (10, 2), (81, 1), (9, 1), (7, 1), (3, 1)):
        counts[length] = n
    assert check_plan(counts, 100) == 3 + 5 + 2 + 2 + 1


def test_pack_every_document(spark):
    rows = [(k, f"{'word ' * (k * 7)}end") for k in range(120)] + [(500 + k, t) for k, t in enumerate(ODD)]
    rows += [(900, None), (901, ""), (902, "long text, " * 9000), (3, "again"), (None, "no id")]
    out = packing.pack(docs_df(spark, rows), PATH, max_tokens=512).collect()
    tok = Tokenizer.from_file(PATH)
    want = []
    for k, t in rows:
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        want += [(k, p // 512, p, len(ids[p:p + 512]), zlib.crc32(ids[p:p + 512].tobytes())) for p in range(0, len(ids), 512)]
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out), key=repr) == sorted(want, key=repr)
    bins = defaultdict(list)
    for r in out:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        parts.sort()
        assert [o for o, _ in parts] == np.cumsum([0, *(n for _, n in parts[:-1])]).tolist()
        assert sum(n for _, n in parts) <= 512
    assert len(bins) <= -(-sum(w[3] for w in want) // 512) + 1


def test_empty_table(spark):
    assert packing.pack(docs_df(spark, []), PATH).collect() == []
