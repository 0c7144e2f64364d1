"""Chat formatting in budgeted windows. DataFrame functions only.

Turns are laid out by prefix sums of their tokens. A window's own turns are
those whose last token falls into one stretch of ``stride`` tokens, so spans
are whole turns, and each turn is some window's own exactly once. Before
them a window repeats the conversation's system turn and the last turns of
the window before, up to ``history`` tokens. Loss is on the assistant texts
among a window's own turns; repeated ones are masked, so each is a target
once. With turns of up to a quarter of ``stride`` a window keeps within
2 * ``stride`` tokens; a longer turn is never cut and may exceed it.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` for each turn. Control
strings inside a text (``CONTROLS``) get one more backslash behind their
first character than they had, and lose it again on reading, so any text
comes back as it was; roles are URL-encoded.

Prefix sums come from sums over blocks of ``BLOCK_TURNS`` turns (a window
ends where its block does), so one conversation with a large part of all
turns is spread over many tasks. Texts are shuffled once, by block; windows
form where they then are, and only conversations of several windows move
what these hand on. Only ``read_back``'s digests need a whole conversation
in one row. Rows: a null text is empty, a null role is
the empty role, a null conversation id is a conversation of its own, null
turns come first, equal turns are ordered by role and text, repeated rows
are turns of their own; an empty table gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
#: fixed values: control strings of common chat templates, escaped inside texts
CONTROLS = ["<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]"]
_REST = "|".join(c[1:].replace("|", r"\|").replace("]", r"\]") for c in CONTROLS)
STRIDE, HISTORY, BLOCK_TURNS = 1024, 512, 256
TURN_TOKENS = 4                         # markers of a turn
_TURN = "array<struct<role:string,text:string,n:bigint>>"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])(\\*)({_REST})", r"$1\\$2$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])\\(\\*)({_REST})", "$1$2$3")


def tokens(text: Column) -> Column:
    """An estimate of a text's tokens: a quarter of its bytes."""
    return F.ceil(F.octet_length(text) / 4).cast("long") + TURN_TOKENS


def _turns(conversations: DataFrame, stride: int) -> DataFrame:
    """_c (a key that is never null), conv_id, turn, role, text, n, _b (the
    block of turns), at (the conversation's tokens before the turn), total
    (all of them) and _w: the stretch of its block in which its last token
    falls."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = conversations.select(
        F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit("n")).alias("_c"), "conv_id", "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), text.alias("text"), tokens(text).alias("n"),
        F.coalesce(F.floor(F.col("turn") / BLOCK_TURNS).cast("long"), F.lit(-(1 << 62))).alias("_b"))
    before = Window.partitionBy("_c").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = (rows.groupBy("_c", "_b").agg(F.sum("n").alias("own"))
              .select("_c", "_b", F.coalesce(F.sum("own").over(before), F.lit(0)).alias("start"),
                      F.sum("own").over(Window.partitionBy("_c")).alias("total")))
    inside = F.sum("n").over(Window.partitionBy("_c", "_b").orderBy("turn", "role", "text")
                             .rowsBetween(Window.unboundedPreceding, 0))
    return (rows.join(starts, ["_c", "_b"]).withColumn("_end", inside)
            .withColumn("_w", F.floor((F.col("_end") - 1) / stride))
            .withColumn("at", F.col("start") + F.col("_end") - F.col("n")).drop("start", "_end"))


def _tail(turns: Column, history: int) -> Column:
    """The last turns, together at most ``history`` tokens."""
    empty = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("k"), F.lit(True).alias("open"))

    def step(acc: Column, x: Column) -> Column:
        fits = acc["open"] & (acc["n"] + x["n"] <= history)
        return F.struct(F.when(fits, acc["n"] + x["n"]).otherwise(acc["n"]).alias("n"),
                        F.when(fits, acc["k"] + 1).otherwise(acc["k"]).alias("k"), fits.alias("open"))

    k = F.aggregate(F.reverse(turns), empty, step, lambda acc: acc["k"])
    return F.slice(turns, F.size(turns) - k + 1, k)


def format_windows(conversations: DataFrame, stride: int = STRIDE, history: int = HISTORY) -> DataFrame:
    """conv_id, window (tokens of the conversation before it: ascending),
    text, n_repeated (turns of context at the start), loss (spans of code
    points, end exclusive), whole (the conversation has no other window)."""
    each = F.struct("turn", "role", "text", "n")
    windows = (_turns(conversations, stride).groupBy("_c", "_b", "_w")        # where the join left them: no shuffle
               .agg(F.first("conv_id").alias("conv_id"), F.min("at").alias("window"),
                    F.max(F.col("at") + F.col("n")).alias("end"), F.first("total").alias("total"),
                    F.sort_array(F.collect_list(each)).alias("turns")).drop("_b", "_w"))
    bare = F.transform("turns", lambda t: F.struct(t["role"], t["text"], t["n"])).cast(_TURN)
    windows = written(windows.withColumn("turns", bare), "chat-windows")
    none, first_turn = F.array().cast(_TURN), F.col("turns")[0]
    own_system = (F.col("window") == 0) & (first_turn["role"] == "system")
    # only conversations of several windows hand anything on
    broken = windows.filter("end < total")
    system = broken.filter(own_system).select("_c", F.slice("turns", 1, 1).alias("system"))
    rest = F.when(own_system, F.slice("turns", F.lit(2), F.greatest(F.size("turns") - 1, F.lit(0)))).otherwise(F.col("turns"))
    tails = broken.select("_c", F.col("end").alias("window"), _tail(rest, history).alias("tail"))
    later = (windows.filter("window > 0").join(tails, ["_c", "window"]).join(system, "_c", "left")
             .withColumn("context", F.concat(F.coalesce("system", none), F.col("tail"))))
    heads = windows.filter("window = 0").withColumn("context", none)
    return _rendered(heads.unionByName(later.select(*heads.columns)))


def _rendered(rows: DataFrame) -> DataFrame:
    def parts(turns: str, own: bool) -> Column:
        return F.transform(turns, lambda t: F.struct(
            F.concat(F.lit(OPEN), F.url_encode(t["role"]), F.lit("\n")).alias("head"), escaped(t["text"]).alias("body"),
            (F.lit(own) & (t["role"] == "assistant")).alias("loss")))

    end = CLOSE + "\n"
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(acc: Column, p: Column) -> Column:
        start = acc["at"] + F.char_length(p["head"])
        stop = start + F.char_length(p["body"])
        span = F.array(F.struct(start.alias("start"), stop.alias("end")))
        return F.struct((stop + len(end)).alias("at"),
                        F.when(p["loss"], F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    return (rows.withColumn("parts", F.concat(parts("context", False), parts("turns", True)))
            .select("conv_id", "window", F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit(end))),
                                                      "").alias("text"),
                    F.size("context").alias("n_repeated"),
                    F.aggregate("parts", empty, step, lambda acc: acc["spans"]).alias("loss"),
                    ((F.col("window") == 0) & (F.col("end") == F.col("total"))).alias("whole")))


def own_turns(text: Column | str, n_repeated: Column | str) -> Column:
    """A window's own turns, read from its text: array of role, text."""
    every = F.split(text, r"<\|im_start\|>")
    own = F.slice(every, F.col(n_repeated) + 2, F.greatest(F.size(every) - F.col(n_repeated) - 1, F.lit(0)))

    def turn(x: Column) -> Column:
        role = F.substring_index(x, "\n", 1)
        head = F.char_length(role) + 1
        body = x.substr(head + 1, F.char_length(x) - head - len(CLOSE) - 1)
        return F.struct(F.url_decode(role).alias("role"), unescaped(body).alias("text"))

    return F.transform(own, turn)


def read_back(windows: DataFrame) -> DataFrame:
    """Per conversation, from formatted windows: n_turns, turns_sha256,
    loss_chars, loss_sha256, formatted_chars."""
    nl = F.lit("\n")
    turns = own_turns("text", "n_repeated")
    targets = F.transform("loss", lambda s: unescaped(F.col("text").substr(s["start"] + 1, s["end"] - s["start"])))
    rows = windows.withColumn("own", turns).select(
        "conv_id", "window", "whole", F.size("own").cast("long").alias("n_turns"),
        F.char_length("text").cast("long").alias("formatted_chars"),
        F.array_join(F.transform("own", lambda t: F.concat(t["role"], nl, t["text"], nl)), "").alias("turns"),
        F.array_join(targets, "").alias("loss"))
    joined = lambda c: F.array_join(F.transform("parts", lambda p: p[c]), "").alias(c)
    split = (rows.filter("not whole").groupBy("conv_id")
             .agg(F.sum("n_turns").alias("n_turns"), F.sum("formatted_chars").alias("formatted_chars"),
                  F.sort_array(F.collect_list(F.struct("window", "turns", "loss"))).alias("parts"))
             .select("conv_id", "n_turns", "formatted_chars", joined("turns"), joined("loss")))
    rows = rows.filter("whole").select(*split.columns).unionByName(split)     # a whole one needs no grouping
    return rows.select("conv_id", "n_turns", F.sha2("turns", 256).alias("turns_sha256"),
                       F.char_length("loss").cast("long").alias("loss_chars"),
                       F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")


def formatted(conversations: DataFrame, **options) -> DataFrame:
    """Write the windows to the shared folder and read them back."""
    return read_back(written(format_windows(conversations, **options), "formatted-chats"))
