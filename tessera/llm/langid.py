"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams of a bounded sample of labelled documents in Spark; the
log-probability matrix is broadcast and every batch is scored as a sparse
occurrence matrix times that matrix in numpy. Languages are taken in
alphabetical slices of ``slice_langs`` (a matrix of at most that many x 65 537
floats): each slice is one pass over the documents, which carry their best
language so far and the probability mass of all languages relative to it. Any
number of languages works with the memory of one slice.

Defined results: a text that is null, empty or without letters is ``und`` with
score 0; rows with a null language teach nothing; a table without labelled rows
gives a model that answers ``und``; repeated rows are judged one by one; ties go
to the alphabetically first language; other columns are ignored.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import written
from tessera.session import cut_lineage

BUCKETS = 1 << 16
ORDERS = (1, 2, 3)
#: Characters per numpy pass.
PASS_CHARS = 1 << 20


@functools.cache
def _letters() -> np.ndarray:
    """Code point -> itself if a letter, else space."""
    return np.array([c if chr(c).isalpha() else 32 for c in range(0x110000)], dtype=np.uint32)


def ngram_stream(texts: list[str | None]):
    """Passes over ``texts``: (first, past-last document, bucket ids, n-gram counts, letters per document).

    Non-letters become spaces, letters are lower-cased, and every document is
    framed by spaces, so n-grams never join two documents. N-grams without a
    letter get no weight (bucket BUCKETS). Bucket ids are one array per order;
    the counts give how many entries of it belong to each document.
    """
    a = 0
    while a < len(texts):
        b, chars = a, 0
        while b < len(texts) and (b == a or chars + len(texts[b] or "") < PASS_CHARS):
            chars += len(texts[b] or "")
            b += 1
        parts = [f" {(t or '').lower()} " for t in texts[a:b]]
        lens = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
        code = np.frombuffer("".join(parts).encode("utf-32-le", "replace"), dtype=np.uint32)
        code = _letters()[np.minimum(code, 0x10FFFF)]
        starts = np.cumsum(lens) - lens
        blank = code == 32
        letters = np.add.reduceat(~blank, starts, dtype=np.int64)
        ids, h, empty = [], np.zeros(len(code), np.uint32), np.ones(len(code), bool)
        for k in range(max(ORDERS)):
            shifted = np.zeros(len(code), np.uint32) + np.uint32(32)
            gap = np.ones(len(code), bool)
            shifted[k:], gap[k:] = code[:len(code) - k], blank[:len(code) - k]
            h = (h ^ shifted) * np.uint32(0x01000193) + np.uint32(0x9E3779B9 * (k + 1) & 0xFFFFFFFF)
            empty &= gap
            if k + 1 in ORDERS:
                g = h ^ (h >> np.uint32(15))
                g = (g * np.uint32(0x85EBCA6B)) >> np.uint32(16)
                ids.append(np.where(empty, np.uint32(BUCKETS), g))
        yield a, b, ids, starts, letters
        a = b


def language_slices(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", id_col: str = "doc_id",
                    docs_per_lang: int = 4000, alpha: float = 0.1, slice_langs: int = 256):
    """Yield (languages, log-probability matrix, whether it is the last) for one slice of languages after the other.

    Fits on about ``docs_per_lang`` labelled documents of each language (whole
    texts). The sample is fixed by a hash of the id, so it is the same in every
    run. Only one slice is collected at a time. Probabilities are relative to the
    mean of the first slice, the same for all.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    rows = rows.where("text IS NOT NULL AND lang IS NOT NULL")
    sizes = cut_lineage(rows.groupBy("lang").agg(F.count("*").alias("n")))
    level, rest, more = None, sizes, True
    while more:
        page = rest.orderBy("lang").limit(slice_langs + 1).collect()
        more = len(page) > slice_langs
        part = {r["lang"]: r["n"] for r in page[:slice_langs]}
        langs = list(part)
        logp = _fit(rows, part, langs, docs_per_lang, alpha)
        if langs:
            level = logp.mean(0) if level is None else level
            logp -= level  # only differences between languages matter
            rest = sizes.where(F.col("lang") > langs[-1])
        yield langs, np.hstack([logp, np.zeros((len(langs), 1))]).astype(np.float32), not more


def _fit(rows: DataFrame, sizes: dict[str, int], langs: list[str], docs_per_lang: int, alpha: float) -> np.ndarray:
    """Smoothed log-probabilities of the n-gram buckets of some languages."""
    if not langs:
        return np.zeros((0, BUCKETS))
    share = F.lit(0)
    for lang in langs:
        share = F.when(F.col("lang") == lang, int(min(1.0, docs_per_lang / sizes[lang]) * 2**20)).otherwise(share)
    sample = rows.where(F.pmod(F.xxhash64(F.lit("langid"), "id"), F.lit(2**20)) < share).select("text", "lang")
    place = {lang: k for k, lang in enumerate(langs)}

    def count(batches):
        total = np.zeros((len(langs), BUCKETS + 1), np.int64)
        for batch in batches:
            labels = np.array([place[x] for x in batch.column("lang").to_pylist()], dtype=np.int64)
            for a, b, ids, starts, _ in ngram_stream(batch.column("text").to_pylist()):
                for k in np.unique(labels[a:b]):
                    keep = np.repeat(labels[a:b] == k, np.diff(np.append(starts, len(ids[0]))))
                    for g in ids:
                        total[k] += np.bincount(g[keep], minlength=BUCKETS + 1)
        where = np.nonzero(total[:, :BUCKETS])
        yield pa.RecordBatch.from_arrays([pa.array(where[0].astype(np.int32)), pa.array(where[1].astype(np.int32)),
                                          pa.array(total[where])], ["k", "bucket", "n"])

    counts = (sample.mapInArrow(count, "k int, bucket int, n long")
              .groupBy("k", "bucket").agg(F.sum("n").alias("n")).toPandas())
    seen = np.zeros((len(langs), BUCKETS))
    seen[counts["k"], counts["bucket"]] = counts["n"]
    return np.log(seen + alpha) - np.log(seen.sum(1, keepdims=True) + alpha * BUCKETS)


def slice_scores(texts: list[str | None], langs: list[str], logp: np.ndarray):
    """Best language of a slice for every text (null without letters), its log-probability, and
    the summed probability of the slice's languages relative to it."""
    best, top, mass = np.full(len(texts), None, dtype=object), np.zeros(len(texts)), np.zeros(len(texts))
    if not langs:
        return best, top, mass
    names = np.array(langs, dtype=object)
    for a, b, ids, starts, letters in ngram_stream(texts):
        total = np.zeros((b - a, len(langs)))
        for k in range(len(langs)):
            for g in ids:
                total[:, k] += np.add.reduceat(logp[k][g], starts, dtype=np.float64)
        first = total.argmax(1)
        high = total[np.arange(b - a), first]
        known = letters > 0
        best[a:b][known] = names[first[known]]
        top[a:b][known] = high[known]
        mass[a:b][known] = np.exp(total - high[:, None]).sum(1)[known]
    return best, top, mass


def merged(one, two):
    """Scores over the languages of two slices; equal scores keep the earlier slice's language."""
    (best, top, mass), (best2, top2, mass2) = one, two
    either = (mass > 0) & (mass2 > 0)
    new = (mass2 > 0) & ((mass == 0) | (top2 > top))
    high = np.where(new, top2, top)
    both = mass * np.exp(np.where(either, top - high, 0)) + mass2 * np.exp(np.where(either, top2 - high, 0))
    return np.where(new, best2, best), high, both


def score_texts(texts: list[str | None], langs: list[str], logp: np.ndarray):
    """Language and posterior probability of every text."""
    best, _, mass = slice_scores(texts, langs, logp)
    known = mass > 0
    return np.where(known, best, "und"), np.divide(1.0, mass, out=np.zeros(len(texts)), where=known)


_STATE = {"__best": "string", "__top": "double", "__mass": "double"}


def _score(state: DataFrame, keep: tuple[str, ...], langs: list[str], logp: np.ndarray, last: bool):
    """Documents after one more slice of languages, and the slice's broadcast; the last slice leaves the text behind."""
    shared = state.sparkSession.sparkContext.broadcast((langs, logp))
    names = [*keep, *([] if last else ["__text"]), *_STATE]

    def run(batches):
        for batch in batches:
            texts, best, top, mass = (batch.column(len(keep) + k) for k in range(4))
            before = (np.array(best.to_pylist(), dtype=object), top.to_numpy(), mass.to_numpy())
            best, top, mass = merged(before, slice_scores(texts.to_pylist(), *shared.value))
            cols = [batch.column(k) for k in range(len(keep))] + ([] if last else [texts])
            yield pa.RecordBatch.from_arrays([*cols, pa.array(best, pa.string()), pa.array(top), pa.array(mass)], names)

    return state.mapInArrow(run, state.select(*names).schema), shared


def predict(docs: DataFrame, slices, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns plus ``lang_pred`` and ``score`` (0 to 1) for every row.

    ``slices`` as of ``language_slices``. Between two slices the documents are
    written with their scores so far; a single slice writes nothing."""
    start = {"__best": F.lit(None), "__top": F.lit(0.0), "__mass": F.lit(0.0)}
    state = docs.select(*[F.col(c) for c in keep], F.col(text_col).alias("__text"),
                        *[start[c].cast(t).alias(c) for c, t in _STATE.items()])
    for langs, logp, last in slices:
        state, shared = _score(state, keep, langs, logp, last)
        if not last:
            state = written(state, "languages")
            shared.unpersist()
    return state.select(*keep, F.coalesce("__best", F.lit("und")).alias("lang_pred"),
                        F.when(F.col("__mass") > 0, 1 / F.col("__mass")).otherwise(0.0).alias("score"))


def held_out(id_col: str = "doc_id"):
    """True for the quarter of documents that never teaches."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), **train_options) -> DataFrame:
    """Train on the documents that are not held out, predict every document."""
    return predict(docs, language_slices(docs.where(~held_out()), **train_options), keep=keep)
