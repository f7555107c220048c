import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from helpers import docs_df

from tessera.llm import sentencepieces
from tessera.llm.common import bytes_of

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["Hello world", "", " ", "  two  spaces   here ", "line\nbreak\ttab", "日本語と🎉 emoji", "▁mark", "a" * 300, "<s> </s> <0x41>",
         "naïve façade ñandú", "x  y", "\x00 \u200b"]


def plain_viterbi(word, sp, scores, unknown):
    """Best score of one unit, position by position."""
    best = [0.0] + [-np.inf] * len(word)
    for end in range(1, len(word) + 1):
        for start in range(max(0, end - 16), end):
            s = scores.get(word[start:end])
            if s is not None:
                best[end] = max(best[end], best[start] + s)
        best[end] = max(best[end], best[end - 1] + unknown)
    return best[-1]


def model_scores():
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    normal = [i for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))]
    scores = {sp.id_to_piece(i): sp.get_score(i) for i in normal}
    return sp, scores, min(scores.values()) - 10


def test_paths_are_the_best_ones():
    sp, scores, unknown = model_scores()
    model = sentencepieces.Pieces(PATH)
    rng = random.Random(3)
    words = ["▁" + "".join(rng.choice("theraniosldc") for _ in range(rng.randrange(0, 14))) for _ in range(400)]
    words += ["▁▁▁the", "▁ñandú", "▁日本", "▁🎉a", "▁" * 40]
    for w, ids in zip(words, model.encode_words(words), strict=True):
        total, k = 0.0, 0
        ids = ids.tolist()
        while k < len(ids):
            if sp.is_byte(ids[k]):
                k += 1 + sum(1 for _ in range(3) if k + 1 < len(ids) and sp.is_byte(ids[k + 1]) and
                             0x80 <= int(sp.id_to_piece(ids[k + 1])[1:-1], 16) < 0xC0 and not (k := k + 1) < 0)
                total += unknown
            else:
                total += scores[sp.id_to_piece(ids[k])]
                k += 1
        assert abs(total - plain_viterbi(w, sp, scores, unknown)) < 1e-3, w


def test_round_trip_and_library_decoding():
    model, sp = sentencepieces.Pieces(PATH), model_scores()[0]
    for _ in range(2):
        data, offsets = bytes_of(pa.array([t.replace("▁", " ") for t in TEXTS]))
        ids, ends = model.encode(data, offsets)
        out, bounds = model.decode(ids, ends)
        for k, t in enumerate(TEXTS):
            assert out[bounds[k]:bounds[k + 1]].tobytes().decode() == t.replace("▁", " ")
            assert sp.decode(ids[ends[k]:ends[k + 1]].tolist()) == t.replace("▁", " ")


def test_table(spark):
    rows = [(k, t) for k, t in enumerate(TEXTS)] + [(100, None), (101, "longword" * 2000), (1, ""), (None, "no id")]
    df = docs_df(spark, rows)
    coded = sentencepieces.encode(df, PATH, keep=("doc_id", "block"))
    out = sentencepieces.decode(coded, PATH, keep=("doc_id", "ids", "block")).collect()
    got = sorted(((r.doc_id, r.decoded) for r in out), key=repr)
    assert got == sorted(((k, None if t is None else t.replace("▁", " ")) for k, t in rows), key=repr)
    assert all((r.ids is None) == (r.doc_id == 100) and r.block == "x" for r in out)
    checked = sentencepieces.encode(df, PATH, check=True).collect()
    assert all(r.round_trip for r in checked) and len(checked) == len(rows)
    assert sentencepieces.encode(docs_df(spark, []), PATH).collect() == []
