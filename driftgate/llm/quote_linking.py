"""Chat formatting: quotation linking.

A line's quote level is the number of '>' signs it starts with (blanks between
them allowed).  Runs of lines of one level above 0 are quoted passages; a line
ending in "wrote:" right before a passage introduces it and goes with it.  What
is left is the message's own text.  Passages are normalised (lower case, white
space as one blank) and hashed: whole runs, their paragraphs and their lines.
The same pieces of all own texts are the index of original messages.

A quoting message replies to the message that its shallowest quotes with an
original come from; passages of every level are looked up, as shallower ones may be
edited or trimmed.  Within a level it is first an earlier turn of its own
conversation, else the first message anywhere that wrote the passage, if that
has a smaller turn and the passage at least ``least_words`` words.  The match
with most words wins, then the latest turn.
Without a link a message replies to the previous turn of its conversation.
Parents always have smaller turns, so links form trees: threads, found by
pointer doubling, and range-sorted so that every reply follows its parent.

Defined cases: null text is empty; rows with a null conversation or turn are
threads of their own and link to nothing; rows that repeat a (conversation,
turn) are one place to link to (the smallest role and text stand for it) and
are all returned; equal matches go to the smaller conversation; an empty table
gives no rows.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftgate.llm.store import checkpointed, ship
from driftgate.llm.words import Texts, prefix_sum, spans_hash

_QUOTE = re.compile(r"[ \t]*(?:>[ \t]?)+")
_INTRO = re.compile(r"wrote:\s*$", re.IGNORECASE)

PIECES = "array<struct<level: int, hash: long, words: long>>"


def parse(text: str) -> tuple[str, list[tuple[int, str]], list[str]]:
    """Own text without quotes; quoted pieces with their level; own pieces (whole, paragraphs, lines)."""
    runs: list[tuple[int, list[str]]] = []
    for line in text.split("\n"):
        m = _QUOTE.match(line)
        level = m.group(0).count(">") if m else 0
        body = line[m.end() :] if m else line
        if not runs or runs[-1][0] != level:
            if level and runs and runs[-1][0] == 0 and runs[-1][1] and _INTRO.search(runs[-1][1][-1]):
                runs[-1][1].pop()
            runs.append((level, []))
        runs[-1][1].append(body)
    own_lines = [line for level, lines in runs if level == 0 for line in lines]
    own = "\n".join(own_lines).strip("\n")
    quoted = [(level, piece) for level, lines in runs if level for piece in pieces(lines)]
    written = pieces(own_lines)
    for level, lines in runs:
        if level == 0:
            written += pieces(lines)
    return own, quoted, list(dict.fromkeys(written))


def pieces(lines: list[str]) -> list[str]:
    """The run itself, its paragraphs and its lines, each once."""
    out = ["\n".join(lines)]
    paragraph: list[str] = []
    for line in [*lines, ""]:
        if line.strip():
            paragraph.append(line)
            out.append(line)
        elif paragraph:
            out.append("\n".join(paragraph))
            paragraph = []
    return list(dict.fromkeys(x for x in out if x.strip()))


def _hashed(items: list[str]) -> tuple[np.ndarray, np.ndarray]:
    t = Texts(pa.array(items, pa.string()), "lower")
    return spans_hash(prefix_sum(t.hash), t.bounds[:-1], t.bounds[1:]).view(np.int64), t.counts()


def _parsed(batches):
    def column(rows):
        cut = np.concatenate([[0], np.cumsum([len(r) for r in rows], dtype=np.int64)])
        h, n = _hashed([p for r in rows for _, p in r])
        level = pa.array([x for r in rows for x, _ in r], pa.int32())
        return pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.StructArray.from_arrays([level, pa.array(h, pa.int64()), pa.array(n, pa.int64())], ["level", "hash", "words"]))

    for batch in batches:
        texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
        done = [parse(x or "") for x in texts]
        quoted, own = column([d[1] for d in done]), column([[(0, p) for p in d[2]] for d in done])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([d[0] for d in done], pa.string()), quoted, own], [*batch.schema.names, "own", "quoted", "written"])


def link_quotes(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", least_words: int = 5) -> DataFrame:
    """One row per message: ids, role, own text, n_quotes, linked (by a quotation), parent, thread (its first message) and depth, in reply order."""
    ship(messages.sparkSession)
    src = messages.select(F.col(conv).cast("long").alias("conv"), F.col(turn).cast("long").alias("turn"), F.col(role).cast("string").alias("role"), F.col(text).cast("string").alias("text"))
    parsed = checkpointed(src.mapInArrow(_parsed, f"conv long, turn long, role string, text string, own string, quoted {PIECES}, written {PIECES}").drop("text"))
    placed = parsed.where(F.col("conv").isNotNull() & F.col("turn").isNotNull())
    written = placed.select("conv", "turn", F.inline("written")).where("words > 0")
    # every passage once, at its shallowest level; the shallowest one with an original tells what a message answers
    quoted = placed.select("conv", "turn", F.inline("quoted")).where("words > 0").groupBy("conv", "turn", "hash", "words").agg((-F.min("level")).alias("up"))
    here = written.select(F.col("conv").alias("c"), F.col("turn").alias("pt"), F.col("hash").alias("ph")).distinct()
    near = quoted.join(here, (F.col("conv") == F.col("c")) & (F.col("hash") == F.col("ph")) & (F.col("pt") < F.col("turn")))
    near = near.select("conv", "turn", F.struct("up", F.lit(1).alias("same"), F.col("words"), F.col("pt"), (-F.col("c")).alias("nc")).alias("m"))
    # the first writer of each passage: one row per hash, however many wrote it
    first = written.where(F.col("words") >= least_words).groupBy(F.col("hash").alias("ph")).agg(F.min(F.struct("turn", "conv")).alias("f"))
    far = quoted.join(first, (F.col("hash") == F.col("ph")) & (F.col("f.turn") < F.col("turn")))
    far = far.select("conv", "turn", F.struct("up", F.lit(0).alias("same"), F.col("words"), F.col("f.turn").alias("pt"), (-F.col("f.conv")).alias("nc")).alias("m"))
    link = near.union(far).groupBy("conv", "turn").agg(F.max("m").alias("m")).select("conv", "turn", (-F.col("m.nc")).alias("lc"), F.col("m.pt").alias("lt"))
    places = placed.select("conv", "turn").distinct()
    before = Window.partitionBy("conv").orderBy("turn")
    tree = (
        places.withColumn("prev", F.lag("turn").over(before))
        .join(link, ["conv", "turn"], "left")
        .select("conv", "turn", F.col("lc").isNotNull().alias("linked"), F.coalesce("lc", F.when(F.col("prev").isNotNull(), F.col("conv"))).alias("pc"), F.coalesce("lt", "prev").alias("pt"))
    )
    # pointer doubling: (uc, ut) is an ancestor `steps` levels up; a row is done once that is its root
    root = F.col("pc").isNull()
    now = checkpointed(tree.select("*", F.coalesce("pc", "conv").alias("uc"), F.coalesce("pt", "turn").alias("ut"), F.when(root, 0).otherwise(1).cast("long").alias("steps"), root.alias("done")))
    while not now.where("not done").isEmpty():
        up = now.select(F.col("conv").alias("a"), F.col("turn").alias("b"), F.col("uc").alias("nc"), F.col("ut").alias("nt"), F.col("steps").alias("more"), F.col("done").alias("at_root"))
        open_ = now.where("not done").join(up, (F.col("uc") == F.col("a")) & (F.col("ut") == F.col("b")))
        moved = open_.select("conv", "turn", "linked", "pc", "pt", F.col("nc").alias("uc"), F.col("nt").alias("ut"), (F.col("steps") + F.col("more")).alias("steps"), F.col("at_root").alias("done"))
        now = checkpointed(now.where("done").union(moved))
    t = now.select(F.col("conv").alias("c"), F.col("turn").alias("t"), "linked", "pc", "pt", "uc", "ut", "steps")
    out = parsed.join(t, (F.col("conv") == F.col("c")) & (F.col("turn") == F.col("t")), "left")
    out = out.select(
        F.col("conv").alias(conv),
        F.col("turn").alias(turn),
        F.col("role").alias(role),
        F.col("own").alias(text),
        F.size("quoted").cast("long").alias("n_quotes"),
        F.coalesce("linked", F.lit(False)).alias("linked"),
        F.col("pc").alias("parent_conv"),
        F.col("pt").alias("parent_turn"),
        F.coalesce("uc", "conv").alias("thread_conv"),
        F.coalesce("ut", "turn").alias("thread_turn"),
        F.coalesce("steps", F.lit(0)).cast("long").alias("depth"),
    )
    order = ["thread_conv", "thread_turn", turn, conv]
    return out.repartitionByRange(*order).sortWithinPartitions(*order)
