"""Chat formatting by quotation linking.

A message is parsed into its own text (lines without a quote mark) and quoted
passages: neighbouring lines of one nesting level, ">" repeated per level. Own
texts and passages are normalised (case, white space) and hashed, whole and
line by line; a quoted passage joins the messages whose own text holds the same
passage. The passages of the outermost level decide whom a message answers; an
answer always points to an earlier message, so replies form trees. What comes
back are the messages without quotes, in reply order.

Per hash only the earliest message of a thread is joined (one whose whole text it
is before one that holds it as a line), so a line that half of all messages hold
is one row and the join never multiplies.

Defined results: a null text has no own text (null) and no quotes; a message
whose quotes match nothing, or that quotes nobody, starts a conversation of its
own; equal messages: the earliest is answered; rows that repeat thread, order and
text are copies of one message and all get its links; rows that share thread and
order but not the text are conversations of their own; a passage that only holds white space links nothing; other
columns are carried by ``keep``.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.common import written
from tessera.operators.ranks import row_number_by_key
from tessera.session import cut_lineage

_marks = re.compile(r"^[ \t]*((?:>[ \t]?)+)")


def quote(text: Column) -> Column:
    """The text with one more quote level on every line."""
    return F.concat(F.lit("> "), F.replace(text, F.lit("\n"), F.lit("\n> ")))


def parse(text: str) -> tuple[str, list[tuple[int, list[str]]]]:
    """(own text, [(level, lines)]) of a message."""
    own, passages, level_before = [], [], 0
    for line in text.split("\n"):
        m = _marks.match(line)
        if not m:
            own.append(line)
            level_before = 0
            continue
        level, rest = m.group(1).count(">"), line[m.end():]
        if level != level_before:
            passages.append((level, []))
        passages[-1][1].append(rest)
        level_before = level
    return "\n".join(own).strip("\n"), passages


def passage_key(lines: list[str]) -> str | None:
    """Hash of normalised lines; null if they are blank."""
    words = " ".join(lines).lower().split()
    return hashlib.blake2b(" ".join(words).encode("utf-8", "replace"), digest_size=16).hexdigest() if words else None


_KEY = "struct<whole:boolean,level:int,key:string,weight:long>"
_key_type = pa.list_(pa.struct([("whole", pa.bool_()), ("level", pa.int32()), ("key", pa.string()), ("weight", pa.int64())]))


def _keys(level: int, lines: list[str]) -> list[dict]:
    """A passage as a whole, and its lines; a whole match outweighs all its lines."""
    total = sum(map(len, lines))
    out = [{"whole": True, "level": level, "key": passage_key(lines), "weight": 2 * total + 1}]
    out += [{"whole": False, "level": level, "key": passage_key([x]), "weight": len(x)} for x in lines] if len(lines) > 1 else []
    return [k for k in out if k["key"] is not None]


def parsed(messages: DataFrame, keys: tuple[str, ...], text_col: str, keep: tuple[str, ...]) -> DataFrame:
    """``keys`` and ``keep`` columns, ``__said`` (hash of the text), ``body`` (own text), ``own`` and ``quoted`` (their hashes)."""
    carried = list(dict.fromkeys([*keys, *keep]))
    said = F.coalesce(F.sha2(F.col(text_col), 256), F.lit("-")).alias("__said")
    rows = messages.select(*[F.col(c) for c in carried], said, F.col(text_col).alias("__text"))
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])

    def run(batches):
        for batch in batches:
            body, own, quoted = [], [], []
            for text in batch.column(batch.num_columns - 1).to_pylist():
                mine, passages = parse(text or "")
                body.append(None if text is None else mine)
                own.append(list({k["key"]: k for k in reversed(_keys(0, mine.split("\n")))}.values()))
                quoted.append([k for level, lines in passages for k in _keys(level, lines)])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in range(len(carried) + 1)), pa.array(body, pa.string()), pa.array(own, _key_type),
                 pa.array(quoted, _key_type)], [*carried, "__said", "body", "own", "quoted"])

    return rows.mapInArrow(run, f"{types}, body string, own array<{_KEY}>, quoted array<{_KEY}>")


def _trees(parents: DataFrame) -> DataFrame:
    """(thread, at, root, depth) from (thread, at, parent) by pointer doubling over the open rows."""
    state = cut_lineage(parents.select("thread", "at", F.coalesce("parent", "at").alias("root"),
                                       F.col("parent").isNotNull().cast("int").alias("depth"),
                                       F.col("parent").isNull().alias("done")))
    while state.where("NOT done").limit(1).count():
        up = state.select("thread", F.col("at").alias("root"), F.col("root").alias("next"), F.col("depth").alias("more"),
                          F.col("done").alias("ends"))
        step = state.where("NOT done").join(up, ["thread", "root"]).select(
            "thread", "at", F.col("next").alias("root"), (F.col("depth") + F.col("more")).alias("depth"), F.col("ends").alias("done"))
        state = cut_lineage(state.where("done").unionByName(step))
    return state.drop("done")


def link_replies(messages: DataFrame, thread_col: str = "conv_id", order_col: str = "turn", text_col: str = "text",
                 keep: tuple[str, ...] = ("role",)) -> DataFrame:
    """Messages in reply order.

    ``order_col`` (integer) orders the messages of a thread; messages are linked
    within their thread. Returns thread, order, ``keep``, ``parent`` (the order
    number answered, null for a first message), ``root``, ``depth``, ``position``
    (place in its conversation: every message after the one it answers, copies
    next to each other), ``n_quoted``, and ``body``. A message is known by (thread,
    order): copies (same text) share its links; rows of one (thread, order) with
    different texts, or with a null in one of both, are conversations of their own.
    """
    rows = written(parsed(messages, (thread_col, order_col), text_col, keep).select(
        F.col(thread_col).alias("thread"), F.col(order_col).cast("long").alias("at"),
        *[F.col(c).alias(f"keep_{k}") for k, c in enumerate(keep)], "__said", "body", "own", "quoted"), "messages")
    once = rows.where("thread IS NOT NULL AND at IS NOT NULL").groupBy("thread", "at").agg(
        F.count("*").alias("copies"), F.min("__said").alias("least"), F.max("__said").alias("most"), F.first("own").alias("own"),
        F.first("quoted").alias("quoted")).where("least = most").drop("least", "most")
    originals = once.select("thread", "at", F.explode("own").alias("k")).groupBy("thread", "k.key").agg(
        F.min("at").alias("any"), F.min(F.when(F.col("k.whole"), F.col("at"))).alias("full"))
    asked = once.select("thread", "at", F.explode("quoted").alias("k")).select("thread", "at", "k.*")
    matched = asked.join(originals, ["thread", "key"]).withColumn(
        "source", F.when(F.expr("full < at"), F.col("full")).otherwise(F.col("any"))).where("source < at")
    votes = matched.groupBy("thread", "at", "level", "source").agg(F.sum("weight").alias("weight"))
    parent = votes.groupBy("thread", "at").agg(
        F.min_by("source", F.struct("level", -F.col("weight"), "source")).alias("parent"))
    known = once.select("thread", "at", "copies").join(parent, ["thread", "at"], "left")
    trees = _trees(known)
    above = W.partitionBy("thread", "root").orderBy("depth", "at").rowsBetween(W.unboundedPreceding, -1)
    linked = written(known.join(trees, ["thread", "at"]).withColumn("before", F.coalesce(F.sum("copies").over(above), F.lit(0))), "replies")
    out = rows.withColumn("__copy", F.monotonically_increasing_id()).join(linked, ["thread", "at"], "left")
    single = out.where("copies IS NULL OR copies = 1").withColumn("nth", F.lit(0).cast("long"))
    # a message may have any number of copies: they are numbered in ranges, not in one window
    several = row_number_by_key(out.where("copies > 1"), ["thread", "at"], ["__copy"], "nth")
    out = single.unionByName(several).withColumn("position", (F.coalesce("before", F.lit(0)) + F.col("nth") + 1).cast("int"))
    return out.select(F.col("thread").alias(thread_col), F.col("at").alias(order_col), *[F.col(f"keep_{k}").alias(c) for k, c in enumerate(keep)],
                      "parent", F.coalesce("root", "at").alias("root"), F.coalesce("depth", F.lit(0)).alias("depth"), "position",
                      F.size("quoted").alias("n_quoted"), "body")


def conversations(linked: DataFrame, thread_col: str = "conv_id", role_col: str = "role", max_messages: int | None = None) -> DataFrame:
    """One row per conversation: its messages as (role, text) in reply order, quotes gone.

    A conversation is one value, so it must fit a row; ``max_messages`` cuts a
    longer one into consecutive parts, none lost.
    """
    size = max_messages or (1 << 31) - 1
    part = F.floor((F.col("position") - 1) / size).cast("int").alias("part")
    turns = F.sort_array(F.collect_list(F.struct("position", F.col(role_col).alias("role"), F.col("body").alias("text"))))
    return linked.groupBy(thread_col, "root", part).agg(F.transform(turns, lambda x: F.struct(x["role"], x["text"])).alias("messages"))
