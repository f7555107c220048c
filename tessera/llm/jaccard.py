"""N-gram Jaccard join with adaptive multi-match prefixes.

A document is its set of distinct word 5-grams. Two documents link when their
Jaccard similarity is at least ``percent`` per cent; what comes back is each
document's set size and connected component, so copies are never expanded into
pairs.

1. Sets. Every text is read once per scan as part of a block; equal sets are
   one class, represented by one row, from here on.
2. Order. The document frequency of every shingle over all classes is counted
   (aligned exchange of blocks.py); sets are ordered rarest shingle first.
3. Prefixes. With a smallest possible overlap o of a set of n shingles, two
   similar sets share at least k shingles among the first n - o + k of each.
   k = 1 is the usual prefix. Each set takes the k that minimises its estimated
   cost, scanned postings plus the verifications left when k hits are asked of
   them (Wang, Li and Feng, 2012). A pair must share min(k, k') prefix shingles.
4. Hubs. In a list of sets that share a prefix shingle, most belong to one group
   of near copies. Every member is first verified against the list's hub, the
   set with the most shared shingles. That joins most groups without pairs.
5. Rest. Two sets that share a prefix shingle are both members of its hub's
   group. Members that are not yet in the hub's component meet the others of the
   group in parts; pairs with enough shared prefix shingles are verified. No
   candidate is dropped: a pair not looked at is already in one component.

Verification counts exact overlaps of 64-bit shingle hashes. Groups are dealt
out in parts of about ``GROUP`` sets, so no task holds a whole group, and links
come back one per component, not one per pair.

Defined results: null, empty or white-space texts have an empty set and are
their own component; repeated rows join each other; a null id takes part, and a
component without any id gets null; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import blocks as B
from tessera.llm.common import (bytes_of, components, discard, dropping_shuffles, kept_table, mix, prefix_hash, ragged,
                                runs_of, window_hash, written)

WORDS = 5
PERCENT = 75
MAX_MATCHES = 8
#: Sets that one verification task holds at a time.
GROUP = 512
#: A verification costs about this share of the set's size in scanned postings.
VERIFY = 0.1
_space = np.zeros(256, bool)
_space[[0x20, *range(0x09, 0x0E)]] = True
_upper = np.zeros(256, np.uint8)
_upper[ord("A"):ord("Z") + 1] = 32
_place_value = np.random.default_rng(0x5EED).integers(1, 2**63, size=64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of the distinct shingles, sorted by both."""
    data = data + _upper[data]
    starts, ends, counts = runs_of(_space[data], offsets)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    word = window_hash(prefix_hash(data), starts, ends)
    first = np.cumsum(counts) - counts
    full = np.maximum(counts - words + 1, 0)
    at = ragged(first, full)
    value = np.zeros(len(at), np.uint64)
    for k in range(words):
        value += word[at + k] * _place_value[k]
    doc = np.repeat(np.arange(len(counts)), full)
    few = np.flatnonzero((counts > 0) & (counts < words))
    short = np.zeros(len(few), np.uint64)
    for k in range(words - 1):
        has = counts[few] > k
        short[has] += word[first[few[has]] + k] * _place_value[k]
    short += counts[few].astype(np.uint64) * _place_value[words]
    doc, value = np.concatenate([doc, few]), mix(np.concatenate([value, short]))
    order = np.argsort(value)
    doc, value = doc[order], value[order]
    order = np.argsort(doc.astype(np.uint16 if len(counts) <= 1 << 16 else np.int64), kind="stable")
    doc, value = doc[order], value[order]
    new = B.run_starts(value, doc)
    return doc[new], value[new]


def _row_ids(block: int, n: int) -> np.ndarray:
    """A block's number is the row id of its first document (blocks.py)."""
    return np.int64(block) + np.arange(n, dtype=np.int64)


def _describe(id_col: str, words: int):
    """Per document its set size and a 128-bit signature of the set."""
    def run(batches):
        for row in B.rows_of(batches):
            rest, data, offsets = B.opened(row)
            n = len(offsets) - 1
            doc, value = shingle_sets(data, offsets, words)
            size = np.bincount(doc, minlength=n)
            ends = np.concatenate([[0], np.cumsum(size)])
            sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(v)]) for v in (value, mix(value + np.uint64(1)))]
            sig = [(s[ends[1:]] - s[ends[:-1]]).view(np.int64) for s in sums]
            yield pa.RecordBatch.from_arrays([rest.column(id_col), pa.array(_row_ids(row["block"], n)), pa.array(np.full(n, row["block"], np.int64)),
                                              pa.array(size), pa.array(sig[0]), pa.array(sig[1])], ["doc_id", "rid", "block", "n", "s1", "s2"])
    return run


def _chosen(row: dict, words: int):
    """(row ids, document, hash) of the sets of the block's class representatives."""
    _, data, offsets = B.opened(row)
    n = len(offsets) - 1
    mine = np.zeros(n, bool)
    mine[np.array(row["chosen"] or [], np.int64) - row["block"]] = True
    doc, value = shingle_sets(data, offsets, words)
    keep = mine[doc]
    return _row_ids(row["block"], n), doc[keep], value[keep]


def _send(words: int, bits: int):
    def run(batches):
        for row in B.rows_of(batches):
            _, _, value = _chosen(row, words)
            value = np.sort(value & ~np.uint64(0xFF))
            starts = B.run_starts(value)
            here = np.diff(np.append(starts, len(value))).astype("<u4")
            value = value[starts]
            out = [(k, B.packed(value[a:b], 7), here[a:b]) for k, a, b in B.bucket_cuts(value, bits)]
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["block"]] * len(out)), pa.array([x[0] for x in out], pa.int32()),
                     pa.array([x[1] for x in out], pa.binary()), pa.array([B.squeezed(x[2]) for x in out], pa.binary())],
                    ["block", "bucket", "keys", "here"])
    return run


def _frequency(sent: dict) -> list[np.ndarray]:
    """Document frequency of every key as one byte: exact up to 100, then by eighths of a doubling."""
    keys = [B.unpacked(k, 7) for k in sent["keys"]]
    cuts = np.cumsum([len(k) for k in keys])[:-1]
    keys = np.concatenate(keys)
    here = np.concatenate([np.frombuffer(B.expanded(h), "<u4") for h in sent["here"]])
    order = np.argsort(keys)
    starts = B.run_starts(keys[order])
    total = B.over_runs(np.add.reduceat(here[order].astype(np.int64), starts), starts, len(keys))
    code = np.minimum(np.where(total <= 100, total, 100 + np.ceil(8 * np.log2(np.maximum(total, 100) / 100))), 255)
    out = np.empty(len(keys), np.uint8)
    out[order] = code
    return np.split(out, cuts)


_df_of = np.concatenate([np.arange(101), 100 * 2 ** (np.arange(1, 156) / 8)])


def smallest_overlap(n: np.ndarray, percent: int) -> np.ndarray:
    return -(-n * percent // 100)


def choose_prefixes(size: np.ndarray, starts: np.ndarray, code: np.ndarray, percent: int, max_matches: int):
    """Per set the number of matches asked and its prefix length, by estimated cost.

    ``code`` holds the frequency codes of all sets, rarest first inside a set.
    """
    overlap = smallest_overlap(size, percent)
    postings = np.concatenate([[0.0], np.cumsum(_df_of[code] - 1)])
    best, cost = np.ones(len(size), np.int64), np.full(len(size), np.inf)
    for k in range(1, max_matches + 1):
        length = np.minimum(size - overlap + k, size)
        scanned = postings[starts + length] - postings[starts]
        now = np.where(k <= overlap, scanned + VERIFY * size * scanned / k, np.inf)
        better = now < cost
        best[better], cost[better] = k, now[better]
    return best, size - overlap + best


def _ordered_sets(words: int, percent: int, max_matches: int):
    """Sets that share a prefix shingle with another: tokens, which of them are shared prefix tokens, matches asked."""
    def run(batches):
        for row in B.rows_of(batches):
            rids, doc, value = _chosen(row, words)
            if not len(doc):
                continue
            keys = np.sort(value & ~np.uint64(0xFF))
            keys = keys[B.run_starts(keys)]
            code = B.bytes_in_order(row["answers"])[np.searchsorted(keys, value & ~np.uint64(0xFF))]
            docs, starts, size = np.unique(doc, return_index=True, return_counts=True)
            order = np.argsort(value)
            order = order[np.argsort(code[order], kind="stable")]
            order = order[np.argsort(doc[order].astype(np.uint16 if doc[-1] < 1 << 16 else np.int64), kind="stable")]
            matches, length = choose_prefixes(size, starts, code[order], percent, max_matches)
            mine = order[ragged(starts, length)]
            shared = np.zeros(len(value), bool)
            shared[mine[code[mine] > 1]] = True
            live = np.flatnonzero(np.logical_or.reduceat(shared, starts))
            if len(live):
                common = np.add.reduceat(code > 1, starts) / size
                ends = starts + size
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rids[docs[live]]), pa.array(size[live].astype(np.int32)), pa.array(matches[live].astype(np.int32)),
                     pa.array(common[live].astype(np.float32)),
                     pa.array([value[s:e].tobytes() for s, e in zip(starts[live], ends[live], strict=True)], pa.binary()),
                     pa.array([np.packbits(shared[s:e]).tobytes() for s, e in zip(starts[live], ends[live], strict=True)], pa.binary())],
                    ["rid", "n", "k", "common", "tokens", "shared"])
    return run


def _tokens(row_tokens: bytes, shared: bytes) -> tuple[np.ndarray, np.ndarray]:
    tokens = np.frombuffer(row_tokens, np.uint64)
    return tokens, np.unpackbits(np.frombuffer(shared, np.uint8), count=len(tokens)).astype(bool)


def _prefix_tokens(batches):
    """The inverted lists: one row per shared prefix token of a set."""
    for batch in batches:
        prefix = [t[s] for t, s in (_tokens(t, s) for t, s in zip(batch.column("tokens").to_pylist(),
                                                                  batch.column("shared").to_pylist(), strict=True))]
        of = np.repeat(np.arange(len(prefix)), [len(p) for p in prefix])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([np.zeros(0, np.uint64), *prefix]).view(np.int64)),
             batch.column("rid").take(pa.array(of)), batch.column("common").take(pa.array(of))], ["token", "rid", "common"])


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are similar. Groups by a; a's set goes with every part of its group."""
    per_a = pairs.groupBy("a").agg(F.count("*").alias("m"))
    parts = per_a.select("a", F.ceil(F.col("m") / GROUP).cast("int").alias("parts"))
    salted = pairs.join(parts, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"))
    heads = parts.select("a", F.col("a").alias("b"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    asked = salted.unionByName(heads)
    asked = asked.join(sets.withColumnRenamed("rid", "b"), "b")

    def run(table: pa.Table) -> pa.Table:
        a = table.column("a")[0].as_py()
        b = table.column("b").to_numpy()
        data, offsets = bytes_of(table.column("tokens"))
        value = np.frombuffer(data.tobytes(), np.uint64)
        bounds = offsets // 8
        head = int(np.flatnonzero(b == a)[0])
        own = value[bounds[head]:bounds[head + 1]]
        place = np.minimum(np.searchsorted(own, value), len(own) - 1)
        hits = np.concatenate([[0], np.cumsum(own[place] == value)])
        both = hits[bounds[1:]] - hits[bounds[:-1]]
        union = np.diff(bounds) + len(own) - both
        good = (100 * both >= percent * union) & (b != a)
        return pa.table({"a": pa.array(np.full(int(good.sum()), a)), "b": pa.array(b[good])})

    return asked.groupBy("a", "part").applyInArrow(run, "a long, b long")


def _overlaps(left: list[np.ndarray], right: list[np.ndarray], columns: int = 1 << 14) -> np.ndarray:
    """Sizes of all intersections of two lists of distinct tokens, by 0/1 matrices of the tokens in both."""
    flat = [np.concatenate([np.zeros(0, np.uint64), *x]) for x in (left, right)]
    both = np.intersect1d(*flat)
    out = np.zeros((len(left), len(right)), np.float32)
    places = []
    for lists, all_tokens in zip((left, right), flat, strict=True):
        row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
        at = np.minimum(np.searchsorted(both, all_tokens), max(len(both) - 1, 0))
        ok = both[at] == all_tokens if len(both) else np.zeros(0, bool)
        order = np.argsort(at[ok], kind="stable")
        places.append((at[ok][order], row[ok][order]))
    for a in range(0, len(both), columns):
        width = min(columns, len(both) - a)
        m = []
        for (at, row), n in zip(places, out.shape, strict=True):
            lo, hi = np.searchsorted(at, [a, a + width])
            x = np.zeros((n, width), np.float32)
            x[row[lo:hi], at[lo:hi] - a] = 1
            m.append(x)
        out += m[0] @ m[1].T
    return out.astype(np.int64)


def _link_rest(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between different components of one hub's group.

    ``members`` has hub, rid, component and main (the hub's component). Pairs
    inside the main component are settled, so members outside it, in parts of
    ``GROUP``, meet all members, in parts too. A task holds two parts; it asks
    for the shared prefix tokens first, verifies those pairs, and returns at most
    one link per component.
    """
    split = members.groupBy("hub").agg(F.ceil(F.count("*") / GROUP).cast("int").alias("parts"),
                                       F.ceil(F.count(F.when(F.expr("component != main"), 1)) / GROUP).cast("int").alias("o_parts"))
    rows = members.join(split.where("o_parts > 0"), "hub")
    draw = F.xxhash64("rid", F.lit("part"))
    everyone = rows.select("hub", "rid", "component", F.explode(F.expr("sequence(0, o_parts - 1)")).alias("o_part"),
                           F.pmod(draw, "parts").cast("int").alias("part"), F.lit(False).alias("outside"))
    outside = rows.where("component != main").select(
        "hub", "rid", "component", F.pmod(draw, "o_parts").cast("int").alias("o_part"),
        F.explode(F.expr("sequence(0, parts - 1)")).alias("part"), F.lit(True).alias("outside"))
    asked = everyone.unionByName(outside).join(sets.select("rid", "k", "tokens", "shared"), "rid")

    def run(table: pa.Table) -> pa.Table:
        col = {c: table.column(c).to_numpy() for c in ("rid", "component", "k")}
        tokens = [_tokens(t, s) for t, s in zip(table.column("tokens").to_pylist(), table.column("shared").to_pylist(), strict=True)]
        out = np.array(table.column("outside").to_pylist(), bool)
        left, right = np.flatnonzero(out), np.flatnonzero(~out)
        if not len(left) or not len(right):
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        hits = _overlaps([tokens[i][0][tokens[i][1]] for i in left], [tokens[i][0][tokens[i][1]] for i in right])
        need = np.minimum(col["k"][left][:, None], col["k"][right][None, :])
        size = np.array([len(t) for t, _ in tokens])
        low = np.minimum(size[left][:, None], size[right][None, :])
        high = np.maximum(size[left][:, None], size[right][None, :])
        wanted = ((hits >= need) & (100 * low >= percent * high)
                  & (col["component"][left][:, None] != col["component"][right][None, :]))
        x, y = np.flatnonzero(wanted.any(1)), np.flatnonzero(wanted.any(0))
        both = _overlaps([tokens[i][0] for i in left[x]], [tokens[i][0] for i in right[y]])
        union = size[left[x]][:, None] + size[right[y]][None, :] - both
        i, j = np.nonzero(wanted[np.ix_(x, y)] & (100 * both >= percent * union))
        i, j = left[x[i]], right[y[j]]
        pairs = np.sort(np.stack([col["component"][i], col["component"][j]], 1), 1)
        _, first = np.unique(pairs, axis=0, return_index=True)
        parent: dict[int, int] = {}

        def find(c):
            while parent.setdefault(c, c) != c:
                parent[c] = c = parent[parent[c]]
            return c

        links = []
        for m in first.tolist():
            p, q = find(int(pairs[m, 0])), find(int(pairs[m, 1]))
            if p != q:
                parent[p] = q
                links.append(m)
        return pa.table({"a": pa.array(col["rid"][i[links]], pa.int64()), "b": pa.array(col["rid"][j[links]], pa.int64())})

    return asked.groupBy("hub", "o_part", "part").applyInArrow(run, "a long, b long")


def _components(docs: DataFrame, blocks: DataFrame, id_col: str, words: int, percent: int, max_matches: int) -> DataFrame:
    """(doc_id, rid, block, n_shingles, component) of every row; component is a row id."""
    id_type = docs.select(F.col(id_col)).schema[0].dataType.simpleString()
    told = written(blocks.mapInArrow(_describe(id_col, words), f"doc_id {id_type}, rid long, block long, n long, s1 long, s2 long"), "sets")
    classes = told.where("n > 0").groupBy("n", "s1", "s2").agg(F.min("rid").alias("rep"), F.min_by("block", "rid").alias("block"))
    chosen = classes.groupBy("block").agg(F.collect_list("rep").alias("chosen"))
    total = classes.agg(F.sum("n")).first()[0] or 0
    bits = B.bucket_bits(total)
    spark = docs.sparkSession
    source, source_path = kept_table(blocks.join(chosen, "block"), "chosen")
    sent = source.mapInArrow(_send(words, bits), "block long, bucket int, keys binary, here binary")
    answers, answers_path = kept_table(B.answer(sent, _frequency), "frequency")
    asked = B.with_answers(source, answers)
    sets, sets_path = kept_table(asked.mapInArrow(_ordered_sets(words, percent, max_matches),
                                                  "rid long, n int, k int, common float, tokens binary, shared binary"), "tokens")
    for done in (source_path, answers_path):  # the ordered sets are all that later steps read
        discard(spark, done)
    lists = sets.select("rid", "common", "tokens", "shared").mapInArrow(_prefix_tokens, "token long, rid long, common float")
    hub = lists.groupBy("token").agg(F.max_by("rid", F.struct("common", "rid")).alias("hub"))
    members = written(lists.select("token", "rid").join(hub, "token").select("hub", "rid").distinct(), "members")
    links = written(_verify(members.where("rid != hub").select(F.col("hub").alias("a"), F.col("rid").alias("b")),
                            sets, percent), "links")
    first = components(links)
    placed = members.join(first.withColumnRenamed("node", "rid"), "rid", "left").select(
        "hub", "rid", F.coalesce("component", "rid").alias("component"))
    main = placed.where("rid = hub").select("hub", F.col("component").alias("main"))
    rest = written(_link_rest(written(placed.join(main, "hub"), "placed"), sets, percent), "rest")
    discard(spark, sets_path)
    final = components(links.unionByName(rest))

    reps = told.join(classes.drop("block"), ["n", "s1", "s2"], "left").join(final.withColumnRenamed("node", "rep"), "rep", "left")
    return reps.select("doc_id", "rid", "block", F.col("n").alias("n_shingles"), F.coalesce("component", "rep", "rid").alias("component"))


def join_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                    percent: int = PERCENT, max_matches: int = MAX_MATCHES) -> DataFrame:
    """Per document: id, ``n_shingles`` and ``component_id`` (smallest id of its component)."""
    with dropping_shuffles(docs.sparkSession):
        blocks, path = B.build(docs, text_col, (id_col,))
        rows = _components(docs, blocks, id_col, words, percent, max_matches)
        discard(docs.sparkSession, path)
    smallest = rows.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return rows.join(smallest, "component").select(F.col("doc_id").alias(id_col), "n_shingles", "component_id")


def one_per_component(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (),
                      words: int = WORDS, percent: int = PERCENT, max_matches: int = MAX_MATCHES) -> DataFrame:
    """One row of each component, the one with the smallest id: ``keep`` columns (the id at least) and the text.

    A null text comes back empty, as it is compared."""
    keep = tuple(dict.fromkeys([id_col, *keep]))
    with dropping_shuffles(docs.sparkSession):
        blocks, _ = B.build(docs, text_col, keep)
        rows = _components(docs, blocks, id_col, words, percent, max_matches)
    first = rows.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid", "block")).alias("r"))
    stay = first.select("r.rid", "r.block").groupBy("block").agg(F.collect_list("rid").alias("stay"))
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*[F.col(c) for c in keep]).schema)

    def pick(batches):
        for row in B.rows_of(batches):
            rest, data, offsets = B.opened(row)
            at = np.sort(np.array(row["stay"], np.int64) - row["block"])
            view = data.tobytes()
            text = [view[offsets[k]:offsets[k + 1]].decode("utf-8", "replace") for k in at.tolist()]
            some = rest.take(pa.array(at))
            yield pa.RecordBatch.from_arrays([*(some.column(c) for c in keep), pa.array(text, pa.string())], [*keep, text_col])

    return blocks.join(stay, "block").mapInArrow(pick, f"{types}, `{text_col}` string")
