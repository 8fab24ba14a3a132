"""Quotation linking: mail-style quotes are parsed, matched to the messages
they come from, and conversations rebuilt in reply order without them.

A message's lines carry a quote level (the number of leading ``>``).
Neighbouring lines of one level, up to a blank line, are a passage. Passages
are normalised and hashed; the owner of a passage is the earliest message
that has it unquoted (level 0), in the same conversation if there is one
there, else anywhere. A passage that nobody has whole (a trimmed quote, or a
paragraph quoted in parts with answers in between) is linked by its lines:
to the latest of the messages of its own conversation that first said one of
them. A message replies to the latest message of its own conversation that
its level-1 quotes come from."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectio.llm.common import written

MARK = re.compile(r"[ \t]*>")
#: The line that announces a quote: "... wrote:".
INTRO = re.compile(r"(?i)^\s*(on\b.{0,200}|[^\n]{0,200})\bwrote:\s*$")
PARSED = T.StructType([
    T.StructField("own", T.StringType()),
    T.StructField("passages", T.ArrayType(T.StructType([
        T.StructField("level", T.IntegerType()), T.StructField("place", T.IntegerType()), T.StructField("words", T.StringType()),
        T.StructField("lines", T.ArrayType(T.StringType()))])))])
#: Lines of fewer words are said by many and link nothing by themselves.
LINE_WORDS = 3


def quote_level(line: str) -> tuple[int, str]:
    """Leading quote marks, blanks between them allowed, and the rest."""
    level, at = 0, 0
    while m := MARK.match(line, at):
        level, at = level + 1, m.end()
    return level, line[at:].removeprefix(" ") if level else line


def normalised(lines: list[str]) -> str:
    """Letter case, white space and line breaks don't matter."""
    return " ".join(" ".join(lines).lower().split())


def parse_message(text: str | None) -> tuple[str, list[tuple[int, int, str]]]:
    """The message without quotes and their announcements, and its passages
    (level, place, normalised words) in text order."""
    own, passages = parse_lines(text)
    return own, [p[:3] for p in passages]


def parse_lines(text: str | None) -> tuple[str, list[tuple[int, int, str, list[str]]]]:
    """:func:`parse_message` with each passage's normalised lines."""
    lines = [quote_level(x) for x in (text or "").split("\n")]
    filled = [i for i, (_, rest) in enumerate(lines) if rest.strip()]
    intro = {i for i, j in zip(filled, filled[1:], strict=False) if lines[j][0] > lines[i][0] and INTRO.match(lines[i][1])}
    own, passages, open_, at = [], [], [], 0

    def close() -> None:
        words = normalised(open_)
        if words:
            lines_ = [x for x in (normalised([line]) for line in open_) if len(x.split()) >= LINE_WORDS]
            passages.append((at, len(passages), words, list(dict.fromkeys(lines_))))
        open_.clear()

    for i, (level, rest) in enumerate(lines):
        if level != at or not rest.strip():
            close()
        at = level
        if i in intro:
            close()
            continue
        if rest.strip():
            open_.append(rest)
        if not level:
            own.append(rest)
    close()
    return re.sub(r"\n{3,}", "\n\n", "\n".join(own)).strip("\n"), passages


@F.pandas_udf(PARSED)
def _parse(texts: pd.Series) -> pd.DataFrame:
    parsed = [parse_lines(t) for t in texts]
    return pd.DataFrame({"own": [p[0] for p in parsed],
                         "passages": [[dict(zip(("level", "place", "words", "lines"), x, strict=True)) for x in p[1]] for p in parsed]})


def parse_messages(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", text_col: str = "text") -> DataFrame:
    """Written table (row, conv, turn, own, passages(level, place, hash, lines))."""
    parsed = messages.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), _parse(F.col(text_col)).alias("p"))
    hashed = F.transform("p.passages", lambda p: F.struct(p["level"].alias("level"), p["place"].alias("place"),
                                                          F.sha2(p["words"], 256).alias("hash"),
                                                          F.transform(p["lines"], lambda x: F.sha2(x, 256)).alias("lines")))
    return written(parsed.select(F.monotonically_increasing_id().alias("row"), "conv", "turn", F.col("p.own").alias("own"),
                                 hashed.alias("passages")), "quotes-messages")


def link_quotes(parsed: DataFrame) -> DataFrame:
    """One row per quoted passage: row, conv, turn, level, place, hash,
    ``from_conv``, ``from_turn`` (null where nobody has it unquoted).

    Owners are reduced to one per passage, or line, and conversation and
    written before the joins, so a passage that everybody quotes meets one
    row and Spark can split its quotes over tasks. Lines are looked up only
    for passages that have no owner whole."""
    passages = parsed.select("row", "conv", "turn", F.explode("passages").alias("p")).select("row", "conv", "turn", "p.*")
    own = passages.where("level = 0 and conv is not null and turn is not null")
    here = written(own.groupBy("hash", "conv").agg(F.min("turn").alias("here_turn")), "quotes-owners")
    anywhere = written(here.groupBy("hash").agg(F.min(F.struct("conv", "here_turn")).alias("first")), "quotes-first-owners")
    quoted = passages.where("level > 0")
    linked = quoted.join(here, ["hash", "conv"], "left").join(anywhere, "hash", "left")
    local = F.col("here_turn") <= F.col("turn")  # a quote of something said later is no quote of it
    linked = written(linked.select("row", "conv", "turn", "level", "place", "hash", "lines",
                                   F.when(local, F.col("conv")).otherwise(F.col("first.conv")).alias("from_conv"),
                                   F.when(local, F.col("here_turn")).otherwise(F.col("first.here_turn")).alias("from_turn")),
                     "quotes-whole")
    said = written(own.select("conv", "turn", F.explode("lines").alias("line")).groupBy("line", "conv")
                   .agg(F.min("turn").alias("said_turn")), "quotes-line-owners")
    asked = linked.where("from_turn is null and conv is not null").select("row", "place", "conv", "turn", F.explode("lines").alias("line"))
    by_line = (asked.join(said, ["line", "conv"]).where("said_turn < turn").groupBy(F.col("row").alias("of"), F.col("place").alias("at"))
               .agg(F.max("said_turn").alias("line_turn")))
    both = linked.join(by_line, (F.col("row") == F.col("of")) & (F.col("place") == F.col("at")), "left")
    return both.select("row", "conv", "turn", "level", "place", "hash",
                       F.when(F.col("line_turn").isNotNull(), F.col("conv")).otherwise(F.col("from_conv")).alias("from_conv"),
                       F.coalesce("line_turn", "from_turn").alias("from_turn"))


def resolved_replies(parents: DataFrame) -> DataFrame:
    """(conv, turn, parent_turn) -> the same with ``up``, the root's turn,
    and ``hops``, the depth, by pointer doubling. A message leaves the loop
    as soon as its root is known, so only long threads go on."""
    active = written(parents.select("conv", "turn", "parent_turn", F.col("parent_turn").alias("up"), F.lit(1).alias("hops"),
                                    F.lit(False).alias("done")), "quotes-pointers")
    finished = active.where("done")
    while not active.isEmpty():
        above = active.unionByName(finished).select(
            F.col("conv").alias("c"), F.col("turn").alias("t"), F.col("up").alias("up2"), F.col("hops").alias("hops2"),
            F.col("done").alias("done2"))
        jumped = active.join(above, (F.col("conv") == F.col("c")) & (F.col("up") == F.col("t")), "left")
        moved = written(jumped.select(
            "conv", "turn", "parent_turn", F.coalesce("up2", "up").alias("up"),
            (F.col("hops") + F.coalesce("hops2", F.lit(0))).alias("hops"),
            (F.col("up2").isNull() | F.col("done2")).alias("done")), "quotes-pointers")
        finished = finished.unionByName(moved.where("done"))
        active = moved.where("not done")
    return finished.drop("done")


def reply_order(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", text_col: str = "text") -> DataFrame:
    """One row per row of ``messages``: conversation, turn, ``parent_turn``
    (the message it replies to, null for a root), ``root_turn`` and
    ``depth`` in the reply tree, ``n_quotes`` and ``n_linked`` passages, and
    ``own_text`` without quotes. Sorting by conversation, ``root_turn``,
    ``depth`` and turn gives the conversation in reply order.

    A null text is an empty message. Messages with a null conversation or
    turn own no passage and are roots. Rows that repeat (conversation, turn)
    share their place: each gets the parent of all of them taken together. An
    empty table gives no rows. Trees are resolved by pointer doubling, in
    log2(depth) joins, so neither a long thread nor a conversation with very
    many messages is gathered anywhere."""
    parsed = parse_messages(messages, conv_col, turn_col, text_col)
    links = written(link_quotes(parsed), "quotes-links")
    parents = (links.where("level = 1 and from_conv = conv and from_turn < turn")
               .groupBy("conv", "turn").agg(F.max("from_turn").alias("parent_turn")))
    pointer = resolved_replies(parents)
    counts = links.groupBy("row").agg(F.count(F.lit(1)).alias("n_quotes"), F.count("from_turn").alias("n_linked"))
    placed = parsed.select("row", "conv", "turn", "own").join(pointer, ["conv", "turn"], "left").join(counts, "row", "left")
    zero = F.lit(0).cast("long")
    return placed.select(
        F.col("conv").alias(conv_col), F.col("turn").alias(turn_col), "parent_turn", F.coalesce("up", "turn").alias("root_turn"),
        F.coalesce(F.col("hops").cast("long"), zero).alias("depth"), F.coalesce("n_quotes", zero).alias("n_quotes"),
        F.coalesce("n_linked", zero).alias("n_linked"), F.col("own").alias("own_text"))
