"""Quotation linking: nested quotes of messages joined to the messages they come from.

A line's quote level is the number of ``>`` signs before its text. Passages are runs of lines of one level
without a blank line between them, and each line of a longer passage on its own, so that a part of a
passage can be quoted too. Passages are normalised (case, white space) and hashed (128 bits); a
quoted passage is joined to the latest earlier message of its conversation that says it itself
(level 0). A message replies to the message that most of its least nested linked quotes come from (by
characters; the later message on ties). Replies are followed to the root of their thread, and messages
come out in the order of conversation, thread and turn, with their own words alone and a chat-formatted text.

The join never pairs all uses of a passage: turns are cut into blocks, the latest earlier use is
found inside a block, and blocks pass on their last use, so a passage said and quoted in every
message of one huge conversation is dealt out by block.

Defined cases: null text is the empty text; a null role is written as "unknown"; rows without a
conv_id or turn neither quote nor are quoted, and stand for themselves; rows repeated in all four
columns are one message; other rows that share a turn are messages of the same moment and do not quote
each other; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import drop_table, materialize, to_batch

MARK = re.compile(r"[ \t]{0,3}>")
ATTRIBUTION = re.compile(r"\b(?:wrote|writes|said)\s*:\s*$", re.I)
PARSED = ("conv_id long, turn long, role string, mid long, body string, "
          "units array<struct<level:int,hash:binary,weight:int>>, n_quotes int")
BLOCK_TURNS = 256
MAX_ROUNDS = 40  # a thread of 2**40 replies


def quote_level(line: str) -> tuple[int, str]:
    """The number of quote signs that begin a line, and what follows them."""
    level = 0
    while m := MARK.match(line):
        level, line = level + 1, line[m.end():]
    return level, line


def normalise(text: str) -> str:
    return " ".join(text.split()).lower()


def parse(text: str) -> tuple[str, list[tuple[int, bytes, int]], int]:
    """A message's own words, its passages as ``(level, hash, characters)``, and how many it quotes."""
    from xxhash import xxh3_128_digest

    lines = [quote_level(x) for x in re.split(r"\r\n|\r|\n", text)]
    # The line that introduces a quote is not the author's text.
    lines = [(level, x) for i, (level, x) in enumerate(lines)
             if not (level == 0 and ATTRIBUTION.search(x) and i + 1 < len(lines) and lines[i + 1][0] > 0)]
    units: dict[tuple[int, bytes], int] = {}
    quotes = 0
    for (level, blank), run in groupby(lines, lambda x: (x[0], not x[1].strip())):
        if blank:
            continue
        parts = [normalise(x) for _, x in run]
        quotes += level > 0
        for said in [" ".join(parts), *(parts if len(parts) > 1 else [])]:
            units[level, xxh3_128_digest(said.encode())] = len(said)
    body = re.sub(r"\n{3,}", "\n\n", "\n".join(x for level, x in lines if level == 0)).strip("\n")
    return body, [(*k, weight) for k, weight in units.items()], quotes


def parsed(messages: DataFrame) -> DataFrame:
    rows = messages.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                           F.coalesce(F.col("role").cast("string"), F.lit("unknown")).alias("role"),
                           F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # Of rows that are equal in all columns one stays; texts are told apart by two hashes of 64 and 32 bits.
    once = (rows.withColumns({"mid": F.xxhash64("role", "text"), "_other": F.crc32(F.encode("text", "UTF-8"))})
            .dropDuplicates(["conv_id", "turn", "role", "mid", "_other"]).drop("_other"))
    schema = rows.sparkSession.createDataFrame([], PARSED).schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pydict()
            out = [parse(t) for t in rows["text"]]
            yield to_batch(schema, {
                **{k: rows[k] for k in ("conv_id", "turn", "role", "mid")}, "body": [x[0] for x in out],
                "units": [[{"level": a, "hash": b, "weight": c} for a, b, c in x[1]] for x in out],
                "n_quotes": [x[2] for x in out]})

    return once.mapInArrow(run, schema)


def quote_links(messages: DataFrame) -> DataFrame:
    """Per quoted passage with a source: ``conv_id, turn, mid, level, weight, source (turn, mid)``."""
    units = (messages.filter("conv_id IS NOT NULL AND turn IS NOT NULL")
             .select("conv_id", "turn", "mid", F.explode("units").alias("u"))
             .select("conv_id", "turn", "mid", "u.level", "u.hash", "u.weight")
             .withColumn("block", F.floor(F.col("turn") / BLOCK_TURNS)))
    # Only passages that someone quotes can link.
    said = F.when(F.col("level") == 0, F.struct("turn", "mid"))
    key = ["conv_id", "hash", "block"]
    inside = Window.partitionBy(*key).orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    blocks = units.groupBy(*key).agg(F.max(said).alias("last"), F.max("level").alias("most"))
    before = Window.partitionBy("conv_id", "hash").orderBy("block").rangeBetween(Window.unboundedPreceding, -1)
    earlier = blocks.select(*key, "most", F.max("last").over(before).alias("earlier")).filter("most > 0").drop("most")
    found = (units.withColumn("near", F.max(said).over(inside)).filter("level > 0").join(earlier, key)
             .withColumn("source", F.coalesce("near", "earlier")))
    return found.filter("source IS NOT NULL").select("conv_id", "turn", "mid", "level", "weight", "source")


def reply_parents(links: DataFrame) -> DataFrame:
    """``conv_id, turn, mid, parent, n_linked``: the source that most of the least nested quotes have."""
    votes = (links.groupBy("conv_id", "turn", "mid", "level", "source")
             .agg(F.sum("weight").alias("weight"), F.count(F.lit(1)).alias("n")))
    best = F.max_by("source", F.struct(-F.col("level"), F.col("weight"), F.col("source.turn"), F.col("source.mid")))
    return votes.groupBy("conv_id", "turn", "mid").agg(best.alias("parent"), F.sum("n").alias("n_linked"))


def thread_roots(parents: DataFrame) -> DataFrame:
    """``conv_id, turn, mid, root, depth`` by doubling the steps towards the root."""
    here = F.struct("turn", "mid")
    now = materialize(parents.select("conv_id", here.alias("me"), F.col("parent").alias("root"),
                                     F.lit(1).cast("long").alias("depth")), "threads")
    for _ in range(MAX_ROUNDS):
        up = now.select("conv_id", F.col("me").alias("root"), F.col("root").alias("above"), F.col("depth").alias("more"))
        if now.join(up, ["conv_id", "root"], "left_semi").isEmpty():
            break
        after = materialize(now.join(up, ["conv_id", "root"], "left").select(
            "conv_id", "me", F.coalesce("above", "root").alias("root"),
            (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth")), "threads")
        drop_table(now)
        now = after
    return now.select("conv_id", "me.turn", "me.mid", "root", "depth")


def linked_conversations(messages: DataFrame) -> DataFrame:
    """One row per message, sorted: ``conv_id, thread_turn, depth, turn, reply_turn, role, n_quotes,
    n_linked, body, chat``."""
    rows = materialize(parsed(messages), "messages")
    parents = materialize(reply_parents(quote_links(rows)), "replies")
    roots = thread_roots(parents).withColumnRenamed("root", "r")
    key = ["conv_id", "turn", "mid"]
    out = rows.drop("units").join(parents, key, "left").join(roots, key, "left")
    return out.select(
        "conv_id", F.coalesce("r.turn", "turn").alias("thread_turn"), F.coalesce("depth", F.lit(0)).alias("depth"),
        "turn", F.col("parent.turn").alias("reply_turn"), "role", "n_quotes",
        F.coalesce("n_linked", F.lit(0)).alias("n_linked"), "body",
        F.concat(F.lit("<|"), "role", F.lit("|>\n"), "body", F.lit("\n")).alias("chat")
    ).orderBy("conv_id", "thread_turn", "turn", "role", "body")
