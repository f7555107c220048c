"""Best-fit sequence packing with exact-complement hashing.

Documents are tokenized once; the pieces (identity, length, place among pieces
of its length) are written to the shared folder. What is planned on the driver
is the histogram of piece lengths, at most ``max_tokens`` numbers at any size of
corpus: length sums of one, two and three pieces are indexed by sum, exact
complements of each gap are consumed while pieces last, and what cannot be
filled exactly is packed best-fit. The plan is a list of patterns with a
multiplicity; every piece finds its sequence from (length, rank) alone.

Defined results: a null or empty text is one piece holding only the end id;
repeated rows are packed separately; an empty table gives an empty result; the
split of a text into pieces depends on its tokens only.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.common import bytes_of, ragged, runs_of, slices, written
from tessera.llm.wordstore import WordStore

MAX_TOKENS = 4096
END_ID = 1

_upper = np.zeros(256, bool)
_upper[ord("A"):ord("Z") + 1] = True
_letter = _upper.copy()
_letter[ord("a"):ord("z") + 1] = True
_point = np.zeros(256, bool)
_point[[ord(c) for c in ".,;:!?"]] = True
_odd = np.zeros(256, bool)
_odd[128:] = True
_odd[ord("<")] = True


class WordTokens(WordStore):
    """Token ids of whole texts, with every distinct word tokenized once per process.

    The tokenizer drops white space and never merges across it, so the ids of a
    text are those of its words in order. A word is also cut between an ASCII
    or Latin-1 letter and one of ``.,;:!?``, where the tokenizer always cuts.
    """

    SEPARATOR = "\x01"

    def __init__(self, path: str, end_id: int = END_ID, limit: int = 2_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids must fit 16 bits")
        mark = self.tokenizer.encode(self.SEPARATOR, add_special_tokens=False).ids
        if len(mark) != 1:
            raise ValueError("the separator must be one token")
        self.mark = mark[0]
        super().__init__(np.array([end_id], np.uint16), limit)  # slot 0: the end of a document

    def encode_words(self, words: list[str]) -> list[np.ndarray]:
        plain = [w for w in words if self.SEPARATOR not in w]
        out: list[np.ndarray] = []
        for a in range(0, len(plain), 4000):
            part = plain[a:a + 4000]
            text = f" {self.SEPARATOR} ".join(part)
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint16)
            out += np.split(ids, np.flatnonzero(ids == self.mark))
            if len(out) - a != len(part):
                raise ValueError("the separator met a word's own token")
        out = [x[1:] if k % 4000 else x for k, x in enumerate(out)]  # all but the first begin with the separator
        if len(plain) < len(words):
            done = iter(out)
            out = [next(done) if self.SEPARATOR not in w else
                   np.array(self.tokenizer.encode(w, add_special_tokens=False).ids, np.uint16) for w in words]
        return out

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all documents one after the other, each with the end id; ids per document)."""
        separator = (data == 32) | (data == 10)
        after_letter = np.zeros(len(data), bool)
        if len(data) > 2:
            latin = (data[1:-1] >= 0x80) & (data[:-2] == 0xC3) & (data[1:-1] != 0x97) & (data[1:-1] != 0xB7)
            after_letter[2:] = latin
            after_letter[1:] |= _letter[data[:-1]]
        starts, ends, counts = runs_of(separator, offsets, _point[data] & after_letter)
        raw = data
        upper = _upper[data]
        if upper.any() and len(starts):
            lowered = data + upper.astype(np.uint8) * np.uint8(32)
            keep = np.logical_and(np.logical_or.reduceat(_odd[data], starts),
                                  np.logical_or.reduceat(upper, starts))
            for s, e in zip(starts[keep].tolist(), ends[keep].tolist(), strict=True):
                lowered[s:e] = data[s:e]  # lower-casing before composition is only safe in ASCII
            raw = lowered
        slots = self.slots(starts, ends, raw)
        docs = len(offsets) - 1
        stream = np.zeros(len(slots) + docs, np.int64)
        stream[np.arange(len(slots)) + np.repeat(np.arange(docs), counts)] = slots
        ids, total = self.gather(stream)
        return ids.astype("<u4"), np.diff(total[np.cumsum(counts + 1)], prepend=0)


_stores: dict[tuple, WordTokens] = {}


def word_tokens(path: str, end_id: int = END_ID) -> WordTokens:
    """The process's store of this tokenizer."""
    if (path, end_id) not in _stores:
        _stores[path, end_id] = WordTokens(path, end_id)
    return _stores[path, end_id]


def pieces(docs: DataFrame, tokenizer_path: str, max_tokens: int = MAX_TOKENS, end_id: int = END_ID,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, and (part, rank): its place
    among the pieces of its length that one task made."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def cut(batches):
        store = word_tokens(tokenizer_path, end_id)
        part = TaskContext.get().partitionId()
        seen = np.zeros(max_tokens + 1, np.int64)
        for batch in batches:
            data, offsets = bytes_of(batch.column("text"))
            for a, b in slices(offsets):
                ids, lens = store.encode(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                n = -(-lens // max_tokens)
                doc = np.repeat(np.arange(a, b), n)
                piece = ragged(np.zeros(b - a, np.int64), n)
                start = piece * max_tokens
                size = np.minimum(np.repeat(lens, n) - start, max_tokens)
                begin = np.repeat(np.cumsum(lens) - lens, n) + start
                view = memoryview(ids).cast("B")
                crc = [zlib.crc32(view[4 * s:4 * (s + k)]) for s, k in zip(begin.tolist(), size.tolist(), strict=True)]
                order = np.argsort(size, kind="stable")
                rank = np.empty(len(size), np.int64)
                sorted_size = size[order]
                rank[order] = np.arange(len(size)) - np.searchsorted(sorted_size, sorted_size) + seen[sorted_size]
                seen += np.bincount(size, minlength=max_tokens + 1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start),
                     pa.array(size), pa.array(crc, pa.int64()), pa.array(np.full(len(size), part, np.int32)), pa.array(rank)],
                    ["doc_id", "piece", "start", "length", "ids_crc32", "part", "rank"])

    return rows.mapInArrow(cut, f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long, part int, rank long")


class _Plan:
    """Patterns as slot rows: (length, first rank, past-last rank, first sequence, offset, run)."""

    def __init__(self, counts: np.ndarray):
        self.left, self.taken = counts.astype(np.int64).copy(), np.zeros(len(counts), np.int64)
        self.sequences, self.rows = 0, []

    def take(self, pattern: list[tuple[int, int]], times: int):
        """``times`` sequences, each holding ``run`` pieces of each (length, run)."""
        offset = 0
        for length, run in pattern:
            lo, n = self.taken[length], run * times
            self.rows.append((length, lo, lo + n, self.sequences, offset, run))
            self.taken[length] += n
            self.left[length] -= n
            offset += length * run
        self.sequences += times


def plan_packing(counts: np.ndarray, capacity: int) -> tuple[np.ndarray, int]:
    """Pack ``counts[l]`` pieces of every length l into sequences of ``capacity``.

    Returns the slot rows and the number of sequences. Steps are bounded by the
    number of lengths: each one uses up a length, a gap or a group of bins.
    """
    plan = _Plan(counts)
    left = plan.left
    left[0] = 0
    if left[capacity]:
        plan.take([(capacity, 1)], int(left[capacity]))
    # index of pair sums, kept as an upper bound while pieces run out
    lengths = np.flatnonzero(left)
    pair = np.zeros(capacity + 1, bool)
    for x in lengths.tolist():
        sums = x + lengths
        pair[sums[sums <= capacity]] = True

    def find_pair(gap: int, used: dict[int, int]) -> tuple[int, int] | None:
        x = np.arange(gap - 1, (gap - 1) // 2, -1)  # the larger one of the two
        have = (left[x] > 0) & (left[gap - x] > 0)
        for big in x[have].tolist():
            need = dict(used)
            for y in (big, gap - big):
                need[y] = need.get(y, 0) + 1
            if all(left[y] >= k for y, k in need.items()):
                return big, gap - big
        return None

    def consume(parts: list[int]):
        need: dict[int, int] = {}
        for y in parts:
            need[y] = need.get(y, 0) + 1
        plan.take(list(need.items()), int(min(left[y] // k for y, k in need.items())))

    open_bins: list[tuple[int, list[tuple[int, int]], int]] = []  # (gap, pattern, how many): planned below
    for big in lengths[::-1].tolist():
        gap = capacity - big
        while left[big] and gap:
            if gap != big and left[gap] or left[gap] > 1:
                consume([big, gap])
                continue
            two = find_pair(gap, {big: 1}) if pair[gap] else None
            if two:
                consume([big, *two])
                continue
            three = None
            firsts = np.arange(gap - 2, 0, -1)
            firsts = firsts[(left[firsts] > 0) & pair[gap - firsts]]
            for x in firsts.tolist():
                if x == big and left[x] < 2:
                    continue
                two = find_pair(gap - x, {big: 1} | {x: 1 + (x == big)})
                if two:
                    three = [x, *two]
                    break
                if find_pair(gap - x, {}) is None:
                    pair[gap - x] = False
            if three is None:
                break
            consume([big, *three])
    # best fit for the rest, longest first, over groups of equal bins
    groups: dict[int, list[list]] = {}  # gap -> [pattern, how many]
    gaps = np.zeros(capacity + 1, np.int64)

    def put(gap: int, pattern: list[tuple[int, int]], n: int):
        groups.setdefault(gap, []).append([pattern, n])
        gaps[gap] += n

    for length in np.flatnonzero(left)[::-1].tolist():
        n = int(left[length])
        while n:
            fits = np.flatnonzero(gaps[length:])
            if not len(fits):
                per = capacity // length
                whole, rest = divmod(n, per)
                if whole:
                    put(capacity - per * length, [(length, per)], whole)
                if rest:
                    put(capacity - rest * length, [(length, rest)], 1)
                break
            gap = int(fits[0]) + length
            pattern, m = groups[gap].pop()
            gaps[gap] -= m
            per = min(gap // length, n)
            full = min(n // per, m)
            put(gap - per * length, [*pattern, (length, per)], full)
            if m > full:
                put(gap, pattern, m - full)
            n -= full * per
    for same in groups.values():
        for pattern, n in same:
            plan.take(pattern, n)
    rows = np.array(plan.rows, dtype=np.int64).reshape(-1, 6)
    return rows, plan.sequences


def place(cut: DataFrame, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to written pieces."""
    per_part = cut.groupBy("part", "length").agg(F.count("*").alias("n"))
    per_part = per_part.withColumn("base", F.sum("n").over(
        W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)))
    totals = cut.groupBy("length").agg(F.count("*").alias("n")).collect()  # at most max_tokens rows
    counts = np.zeros(max_tokens + 1, np.int64)
    for r in totals:
        counts[r["length"]] = r["n"]
    slots, _ = plan_packing(counts, max_tokens)
    slots = slots[np.lexsort((slots[:, 1], slots[:, 0]))]
    shared = cut.sparkSession.sparkContext.broadcast(slots)
    keyed = cut.join(per_part.select("part", "length", "base"), ["part", "length"])
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    keyed = keyed.select("doc_id", "piece", "start", "length", "ids_crc32",
                         (F.col("rank") + F.coalesce("base", F.lit(0))).alias("rank"))

    def seat(batches):
        slots = shared.value
        shift = np.int64(48)
        keys = (slots[:, 0] << shift) + slots[:, 1]
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("rank").to_numpy(zero_copy_only=False)
            s = slots[np.searchsorted(keys, (length << shift) + rank, side="right") - 1]
            within = rank - s[:, 1]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in range(5)), pa.array(s[:, 3] + within // s[:, 5]),
                 pa.array(s[:, 4] + within % s[:, 5] * length)], columns)

    id_type = cut.schema["doc_id"].dataType.simpleString()
    return keyed.mapInArrow(seat, f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long, "
                                  "sequence_id long, offset long")


def pack(docs: DataFrame, tokenizer_path: str, max_tokens: int = MAX_TOKENS, end_id: int = END_ID,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenize, cut and pack every document."""
    return place(written(pieces(docs, tokenizer_path, max_tokens, end_id, id_col, text_col), "pieces"), max_tokens)
