"""SentencePiece encoding and decoding by batched Viterbi in numpy.

A text is cut before every run of spaces; no piece crosses such a cut, so the
best path of a text is that of its units. Distinct units of equal length form
one matrix and advance together: the hash of every substring is one subtraction
of prefix hashes, probed in the sorted hashes of the pieces of its length, and
the best score of each end position is a running maximum over piece lengths that
also stores the back pointer. Characters without a piece become byte pieces.

The path maximises the sum of piece scores (equal sums: the longest last piece),
for any model; a model whose scores are merge ranks is read the same way.

Defined results: a null text has null ids and decodes to null; an empty one has
none; the space mark in a text counts as a space, as in the library; invalid
UTF-8 is replaced before encoding; other columns are carried by ``keep``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import BASE, INVERSE, bytes_of, mix, ragged, row_slices, runs_of
from tessera.llm.wordstore import WordStore

MARK = "\u2581"
#: Cells of one Viterbi matrix.
CELLS = 1 << 17


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (BASE, INVERSE):
        p = np.full(n + 1, base, np.uint64)
        p[0] = 1
        out.append(np.cumprod(p))
    return out[0], out[1]


def _code_points(words: list[str], length: int) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(-1, length)


class Pieces(WordStore):
    """The pieces of one model and the ids of the units met so far."""

    def __init__(self, path: str, limit: int = 1_000_000):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        text = [sp.id_to_piece(i) for i in range(n)]
        normal = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        if any(MARK in text[i].lstrip(MARK) for i in normal):
            raise ValueError("a piece crosses a word boundary")
        score = np.array([sp.get_score(i) for i in range(n)], np.float64)
        self.unknown = float(score[normal].min()) - 10.0
        self.byte_id = np.zeros(256, np.int64)
        for i in range(n):
            if sp.is_byte(i):
                self.byte_id[int(text[i][1:-1], 16)] = i
        self.by_length = {}
        for length in sorted({len(text[i]) for i in normal}):
            ids = np.array([i for i in normal if len(text[i]) == length])
            keys = self._hashes(_code_points([text[i] for i in ids], length))[length][:, 0]
            order = np.argsort(keys)
            self.by_length[length] = keys[order], score[ids[order]], ids[order]
        surface = [bytes([int(text[i][1:-1], 16)]) if sp.is_byte(i) else
                   b"" if sp.is_control(i) else text[i].replace(MARK, " ").encode() for i in range(n)]
        lens = np.array([len(x) for x in surface], np.int64)
        self.surface, self.surface_len = np.frombuffer(b"".join(surface), np.uint8), lens
        self.surface_at = np.cumsum(lens) - lens
        super().__init__(np.zeros(0, np.uint16), limit)

    @staticmethod
    def _hashes(code: np.ndarray, lengths=None) -> dict[int, np.ndarray]:
        """Per length the hash of every substring of that length, one row per word."""
        m, n = code.shape
        up, down = _powers(n)
        prefix = np.zeros((m, n + 1), np.uint64)
        np.cumsum(mix(code.astype(np.uint64) + np.uint64(1)) * up[:n], axis=1, out=prefix[:, 1:])
        return {k: mix((prefix[:, k:] - prefix[:, :n + 1 - k]) * down[:n + 1 - k]) for k in (lengths or [n]) if k <= n}

    def viterbi(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best piece ending at every position of every word: (length, id; -1 for an unknown character)."""
        m, n = code.shape
        probe = {}
        for k, h in self._hashes(code, list(self.by_length)).items():
            keys, score, ids = self.by_length[k]
            at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
            hit = keys[at] == h
            probe[k] = np.where(hit, score[at], -np.inf), ids[at]
        best = np.full((n + 1, m), -np.inf)
        best[0] = 0.0
        length, piece = np.ones((n + 1, m), np.int32), np.full((n + 1, m), -1, np.int64)
        for end in range(1, n + 1):
            for k in sorted(probe, reverse=True):
                if k > end:
                    continue
                score, ids = probe[k]
                now = best[end - k] + score[:, end - k]
                better = now > best[end]
                best[end] = np.where(better, now, best[end])
                length[end] = np.where(better, k, length[end])
                piece[end] = np.where(better, ids[:, end - k], piece[end])
            lost = (piece[end] < 0) | (best[end - 1] + self.unknown > best[end])
            best[end] = np.where(lost, best[end - 1] + self.unknown, best[end])
            length[end] = np.where(lost, 1, length[end])
            piece[end] = np.where(lost, -1, piece[end])
        return length, piece

    def encode_words(self, words: list[str]) -> list[np.ndarray]:
        words = [w.replace(" ", MARK) for w in words]
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        out: list[np.ndarray | None] = [None] * len(words)
        for n in np.unique(sizes).tolist():
            group = np.flatnonzero(sizes == n)
            for a in range(0, len(group), max(1, CELLS // n)):
                some = group[a:a + max(1, CELLS // n)]
                for k, ids in zip(some.tolist(), self._paths([words[i] for i in some], n), strict=True):
                    out[k] = ids
        return out

    def _paths(self, words: list[str], n: int) -> list[np.ndarray]:
        length, piece = self.viterbi(_code_points(words, n))
        at, rows = np.full(len(words), n), np.arange(len(words))
        steps, alive = [], np.ones(len(words), bool)
        unknown = np.zeros(len(words), bool)
        while alive.any():
            now = np.where(alive, piece[at, rows], -2)
            unknown |= now == -1
            steps.append((now, at.copy()))
            at = np.where(alive, at - length[at, rows], at)
            alive = at > 0
        ids = np.array([s[0] for s in steps[::-1]]).T
        out = [row[row != -2].astype(np.uint16) for row in ids]
        for k in np.flatnonzero(unknown).tolist():
            path = []
            for now, end in ((s[0][k], s[1][k]) for s in steps[::-1]):
                if now == -1:
                    path += self.byte_id[list(words[k][end - 1].encode())].tolist()
                elif now >= 0:
                    path.append(int(now))
            out[k] = np.array(path, np.uint16)
        return out

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, offsets of each text's ids)."""
        full = np.diff(offsets) > 0
        data = np.insert(data, offsets[:-1][full], 32)  # the dummy space before every text
        offsets = offsets + np.concatenate([[0], np.cumsum(full)])
        space = data == 32
        cut = space.copy()
        cut[1:] &= ~space[:-1]
        starts, ends, counts = runs_of(np.zeros(len(data), bool), offsets, cut)
        ids, total = self.gather(self.slots(starts, ends, data))
        return ids, total[np.concatenate([[0], np.cumsum(counts)])]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, offsets) of the texts; the dummy space goes."""
        lens = self.surface_len[ids]
        data = self.surface[ragged(self.surface_at[ids], lens)]
        total = np.concatenate([[0], np.cumsum(lens)])[offsets]
        lead = total[:-1][np.diff(total) > 0]
        lead = lead[data[lead] == 32]
        keep = np.ones(len(data), bool)
        keep[lead] = False
        return data[keep], total - np.concatenate([[0], np.cumsum(~keep)])[total]


_models: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    if path not in _models:
        _models[path] = Pieces(path)
    return _models[path]


def encode(docs: DataFrame, model_path: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",),
           check: bool = False) -> DataFrame:
    """``keep`` columns and ``ids``; with ``check`` also ``round_trip``: whether the ids decode to the text."""
    rows = docs.select(*[F.col(c) for c in keep], F.col(text_col).alias("__text"))
    types = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]

    def run(batches):
        model = pieces(model_path)
        for whole in batches:
            for batch in row_slices(whole):
                text = batch.column(batch.num_columns - 1)
                data, offsets = bytes_of(pc.replace_substring(text, MARK, " "))
                ids, ends = model.encode(data, offsets)
                null = pa.array(text.is_null().to_numpy(zero_copy_only=False))
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids.astype(np.int32)))
                out = [*(batch.column(k) for k in range(len(keep))), pc.if_else(null, pa.scalar(None, lists.type), lists)]
                if check:
                    back, bounds = model.decode(ids, ends)
                    same = len(back) == len(data) and np.array_equal(bounds, offsets) and np.array_equal(back, data)
                    out.append(pa.array([True] * len(text) if same else
                                        [back[bounds[k]:bounds[k + 1]].tobytes() == data[offsets[k]:offsets[k + 1]].tobytes()
                                         for k in range(len(text))]))
                yield pa.RecordBatch.from_arrays(out, [*keep, "ids", *["round_trip"] * check])

    return rows.mapInArrow(run, ", ".join([*types, "ids array<int>", *["round_trip boolean"] * check]))


def decode(encoded: DataFrame, model_path: str, ids_col: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``decoded``, the text of the ids."""
    rows = encoded.select(*[F.col(c) for c in keep], F.col(ids_col).alias("__ids"))
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])

    def run(batches):
        model = pieces(model_path)
        for batch in batches:
            lists = batch.column(batch.num_columns - 1)
            lens = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            ids = lists.flatten().to_numpy(zero_copy_only=False)
            data, offsets = model.decode(ids, np.concatenate([[0], np.cumsum(lens)]))
            view = data.tobytes()
            text = [view[s:e].decode("utf-8", "replace") for s, e in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            null = lists.is_null().to_pylist()
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in range(len(keep))),
                 pa.array([None if n else t for n, t in zip(null, text, strict=True)], pa.string())], [*keep, "decoded"])

    return rows.mapInArrow(run, f"{types}, decoded string" if types else "decoded string")
