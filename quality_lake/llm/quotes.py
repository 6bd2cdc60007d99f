"""Quotation linking (operator 10, DataFrame functions only).

A message's lines are parsed into quote levels (the number of ``>`` before them).  A
*passage* is a run of lines of one level, blank lines left out; its words (lower-cased, between
white space) are what is compared, so a passage that a mail client wrapped anew is still the
same.  A passage is looked up by units, longest first: every run of ``RUN`` words, or, where
there are fewer, all its words, and each line of fewer words.  A unit is hashed.

A quoted unit of level 1 links to the latest earlier message of its conversation that has the
unit as its own, and the message replies to the one that most of its quoted words come
from (ties: the later one).  Deeper levels are quotations that the quoted message had
itself; they count only if no unit of level 1 is found.  A message that quotes nothing
(that is found) continues its predecessor's branch: both have one parent.

The reply tree is walked depth first, earlier replies first: ``position`` is a message's place
in that order, ``depth`` the number of messages from the root to it.  Both come from one list:
each turn is entered and left once, every such step knows the next one, and doubling the steps
sums up all that lies behind each of them in as many rounds as the logarithm of the longest
conversation.  No row holds a path, so the output grows with the messages.

A conversation may hold a third of all rows and one unit of it as many: "latest
earlier" and "next sibling" are therefore found within runs of ``SPAN`` turns, and then
between runs, of which there is one row per key.

Cases: a null text counts as empty, a null turn as -1; rows without conversation
are conversations of their own; rows with one turn see the same earlier messages
and share parent and position; equal rows give equal results; blank lines link nothing;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quality_lake.operators.membership import bitmap_words, with_membership
from quality_lake.sources import stage

from .common import ROW, numbered, text_or_empty

SPAN = 4096
#: Words of a unit.
RUN = 8
QUOTE = r"^(?:[ \t]*>)+"


def latest(rows: DataFrame, keys: list[str], at: str, known: Column, inclusive: bool, out: str, span: int = SPAN) -> DataFrame:
    """``rows`` with ``out``: the greatest ``at`` of a row with ``known`` of the same
    keys that is smaller than the row's own (or equal, if ``inclusive``)."""
    held = rows.withColumn("_run_", F.floor(F.col(at) / span)).withColumn("_known_", F.when(known, F.col(at)))
    runs = held.groupBy(*keys, "_run_").agg(F.max("_known_").alias("_last_"))
    runs = runs.withColumn("_before_", F.max("_last_").over(W.partitionBy(*keys).orderBy("_run_").rowsBetween(W.unboundedPreceding, -1)))
    near = W.partitionBy(*keys, "_run_").orderBy(at).rangeBetween(W.unboundedPreceding, 0 if inclusive else -1)
    joined = held.withColumn("_near_", F.max("_known_").over(near)).join(runs.drop("_last_"), [*keys, "_run_"], "left")
    return joined.withColumn(out, F.coalesce("_near_", "_before_")).drop("_run_", "_known_", "_near_", "_before_")


def messages(conversations: DataFrame) -> DataFrame:
    """``(ROW, conv, at, conv_id, turn, role, text)``, written down once."""
    text = text_or_empty()
    return stage(numbered(conversations.select("conv_id", "turn", "role", "text")).select(
        ROW, F.coalesce(F.col("conv_id").cast("string"), F.concat(F.lit("\0"), F.col(ROW).cast("string"))).alias("conv"),
        F.coalesce(F.col("turn").cast("long"), F.lit(-1).cast("long")).alias("at"), "conv_id", "turn", "role", text.alias("text")), "messages")


def _line(line: Column) -> Column:
    marks = F.regexp_extract(line, QUOTE, 0)
    words = F.filter(F.split(F.lower(F.regexp_replace(line, QUOTE, "")), r"\s+"), lambda w: w != "")
    return F.struct((F.length(marks) - F.length(F.translate(marks, ">", ""))).alias("level"), words.alias("words"))


def passages(said: DataFrame) -> DataFrame:
    """``(ROW, conv, at, level, lines)``: every run of a message's lines of one level, as their words."""
    full = F.filter(F.transform(F.split("text", "\n"), _line), lambda s: F.size(s["words"]) > 0)
    cut = said.select(ROW, "conv", "at", full.alias("lines")).filter(F.size("lines") > 0)
    level = lambda i: F.element_at(F.col("lines"), i.cast("int"))["level"]
    starts = F.filter(F.sequence(F.lit(1), F.size("lines")), lambda i: F.when(i == 1, F.lit(True)).otherwise(level(i) != level(F.greatest(i - 1, F.lit(1)))))
    ends = F.concat(F.slice("starts", 2, F.size("starts")), F.array(F.size("lines") + 1))
    own = F.transform("starts", lambda s, k: F.struct(s.alias("first"), (F.element_at("ends", k + 1) - s).alias("n")))
    runs = (cut.withColumn("starts", starts).withColumn("ends", ends).select(ROW, "conv", "at", "lines", F.explode(own).alias("run"))
            .select(ROW, "conv", "at", F.slice("lines", F.col("run.first"), F.col("run.n")).alias("lines")))
    return runs.select(ROW, "conv", "at", F.element_at("lines", 1)["level"].alias("level"), F.transform("lines", lambda s: s["words"]).alias("lines"))


def units(said: DataFrame, quoted: bool, run: int = RUN) -> DataFrame:
    """``(ROW, conv, at, level, key, size)`` of the units of the quoted or of the own passages;
    ``size``: the words that a unit adds.  Quoted runs stand end to end (the last one ends with its
    passage), own ones begin at every word, so that they meet wherever a quotation begins."""
    key = lambda words: F.unhex(F.md5(F.array_join(words, " ").cast("binary"))).alias("key")
    whole = passages(said).filter(F.col("level") > 0 if quoted else F.col("level") == 0).withColumn("words", F.flatten("lines"))
    names, n = [ROW, "conv", "at", "level"], F.size("words")
    last = n - run + 1
    places = F.sequence(F.lit(1), last)
    if quoted:
        places = F.concat(F.sequence(F.lit(1), last, F.lit(run)), F.when((last - 1) % run > 0, F.array(last)).otherwise(F.array().cast("array<int>")))
    adds = F.when((F.col("i") - 1) % run == 0, F.lit(run)).otherwise(n % run)
    long = (whole.filter(n >= run).select(*names, F.explode(places).alias("i"), "words")
            .select(*names, key(F.slice("words", F.col("i"), run)), adds.alias("size")))
    some = F.filter("lines", lambda s: F.size(s) < run)
    short = F.when((n < run) & (F.size("lines") > 1), F.concat(some, F.array("words"))).otherwise(some)
    rest = whole.select(*names, F.explode(short).alias("unit")).select(*names, key(F.col("unit")), F.size("unit").alias("size"))
    return long.unionByName(rest)


def replies(said: DataFrame) -> DataFrame:
    """``(ROW, conv, at, reply_to, n_quoted, n_linked)`` of the messages that quote; units are counted."""
    quoting = stage(units(said, True), "quote-units")
    # only units that are quoted somewhere in the conversation matter as originals: a bitmap of those keeps the
    # others from the shuffle, and lets too many through at most
    hashed = F.xxhash64("conv", "key")
    asked = bitmap_words(quoting.select(hashed.alias("asked")), "asked")
    own = with_membership(units(said, False), hashed, asked, "asked").filter("asked").drop("asked")
    both = quoting.unionByName(own.select(F.lit(None).cast("long").alias(ROW), "conv", "at", "level", "key", "size").distinct())
    found = latest(both, ["conv", "key"], "at", F.col("level") == 0, False, "origin").filter("level > 0")
    level = F.when(F.col("origin").isNotNull(), F.col("level"))
    sums = found.groupBy(ROW, "conv", "at", "level", "origin").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("n"), F.max(level).alias("hit"))
    return (sums.groupBy(ROW, "conv", "at").agg(
        F.max(F.when(F.col("hit").isNotNull(), F.struct((-F.col("level")).alias("near"), "words", "origin"))).alias("best"),
        F.sum("n").alias("n_quoted"), F.sum(F.when(F.col("hit").isNotNull(), F.col("n")).otherwise(0)).alias("n_linked"))
        .select(ROW, "conv", "at", F.col("best.origin").alias("reply_to"), "n_quoted", "n_linked"))


def parents(linked: DataFrame, said: DataFrame) -> DataFrame:
    """``(conv, at, parent)`` of every turn: the message that its branch replies to."""
    starts = stage(linked.filter("reply_to IS NOT NULL").groupBy("conv", "at").agg(F.max("reply_to").alias("reply_to")), "branches")
    turns = said.groupBy("conv", "at").agg(F.lit(False).alias("begins"))
    asked = turns.unionByName(starts.select("conv", "at", F.lit(True).alias("begins")))
    placed = latest(asked, ["conv"], "at", F.col("begins"), True, "start").filter("NOT begins").select("conv", "at", "start")
    return placed.join(starts.select("conv", F.col("at").alias("start"), F.col("reply_to").alias("parent")), ["conv", "start"], "left").select("conv", "at", "parent")


def walked(tree: DataFrame) -> DataFrame:
    """``(conv, at, parent, depth, position)`` of every turn of ``(conv, at, parent)``, depth first."""
    none = F.lit(None).cast("long")
    tree = stage(tree, "reply-tree")
    known = tree.select("conv", "at", F.coalesce("parent", F.lit(-2).cast("long")).alias("up"), (-F.col("at")).alias("back"))
    # the next sibling is the nearest turn behind with the same parent
    nexts = latest(known, ["conv", "up"], "back", F.lit(True), False, "next").select("conv", "at", (-F.col("next")).alias("sibling"))
    firsts = tree.filter("parent IS NOT NULL").groupBy("conv", F.col("parent").alias("at")).agg(F.min("at").alias("child"))
    turns = stage(tree.join(nexts, ["conv", "at"]).join(firsts, ["conv", "at"], "left"), "reply-turns")
    enters = turns.select("conv", "at", F.lit(True).alias("entering"), F.coalesce("child", "at").alias("to"), F.col("child").isNotNull().alias("to_entering"),
                          F.lit(1).cast("long").alias("turns"), F.lit(1).cast("long").alias("balance"))
    leaves = turns.select("conv", "at", F.lit(False).alias("entering"), F.coalesce("sibling", "parent", none).alias("to"), F.col("sibling").isNotNull().alias("to_entering"),
                          F.lit(0).cast("long").alias("turns"), F.lit(-1).cast("long").alias("balance"))
    state = stage(enters.unionByName(leaves), "reply-steps")
    while not state.filter("to IS NOT NULL").isEmpty():
        ahead = state.select("conv", F.col("at").alias("to"), F.col("entering").alias("to_entering"), F.col("to").alias("then"),
                             F.col("to_entering").alias("then_entering"), F.col("turns").alias("more"), F.col("balance").alias("more_balance"))
        moved = state.filter("to IS NOT NULL").join(ahead, ["conv", "to", "to_entering"], "left").select(
            "conv", "at", "entering", F.col("then").alias("to"), F.coalesce("then_entering", F.lit(False)).alias("to_entering"),
            (F.col("turns") + F.coalesce("more", F.lit(0))).alias("turns"),
            (F.col("balance") + F.coalesce("more_balance", F.lit(0))).alias("balance"))
        # steps that have reached the end, as most have after the rounds of a short conversation, take no further part
        state = stage(moved.unionByName(state.filter("to IS NULL")), "reply-steps")
    steps = state.filter("entering")  # turns: those from here on; balance: what is left open behind, so its negative before
    sizes = steps.groupBy("conv").agg(F.max("turns").alias("all"))
    placed = steps.join(sizes, "conv").select("conv", "at", (1 - F.col("balance")).alias("depth"), (F.col("all") - F.col("turns")).alias("position"))
    return tree.join(placed, ["conv", "at"])


def unquoted(text: Column) -> Column:
    """A text without its quoted lines, and without the blank lines these leave at its ends."""
    own = F.array_join(F.filter(F.split(text, "\n"), lambda s: ~s.rlike(QUOTE)), "\n")
    return F.when(text.contains(">"), F.regexp_replace(own, r"^\s*\n|\n\s*$", "")).otherwise(text)


def link_quotes(conversations: DataFrame) -> DataFrame:
    """``(ROW, conv_id, turn, role, reply_to, parent, depth, position, n_quoted, n_linked, text, formatted)`` of
    every message; a conversation by ``position`` is in the order of its replies."""
    said = messages(conversations)
    linked = stage(replies(said), "replies")
    tree = walked(parents(linked, said))
    text = unquoted(F.col("text"))
    return (said.join(tree, ["conv", "at"]).join(linked.select(ROW, "reply_to", "n_quoted", "n_linked"), ROW, "left")
            .select(ROW, "conv_id", "turn", "role", "reply_to", "parent", "depth", "position",
                    F.coalesce("n_quoted", F.lit(0)).cast("long").alias("n_quoted"), F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"),
                    text.alias("text"), F.concat(F.lit("<|"), F.coalesce(F.col("role").cast("string"), F.lit("user")), F.lit("|>\n"), text, F.lit("\n<|end|>")).alias("formatted")))
