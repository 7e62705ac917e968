"""Chat formatting by prefix-target expansion. Native expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The marks of the template. Inside texts a backslash goes behind the
# first character of anything that reads like a mark, with or without backslashes
# there already, so that taking one out again gives the text back.
_MARKS = r"/?s>|/?INST\]|/?ROLE\]|TEXT\]"
_OPEN = {"user": "[INST] ", "assistant": "<s> "}
_CLOSE = {"user": " [/INST]", "assistant": " </s>"}


def escape(c: Column) -> Column:
    return F.regexp_replace(c, rf"([<\[])(\\*)({_MARKS})", r"$1\\$2$3")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, rf"([<\[])\\(\\*)({_MARKS})", "$1$2$3")


def _render(t: Column) -> Column:
    text = escape(t["text"])
    return (F.when(t["role"] == "user", F.concat(F.lit(_OPEN["user"]), text, F.lit(_CLOSE["user"])))
            .when(t["role"] == "assistant", F.concat(F.lit(_OPEN["assistant"]), text, F.lit(_CLOSE["assistant"])))
            .otherwise(F.concat(F.lit("[ROLE] "), escape(t["role"]), F.lit(" [TEXT] "), text, F.lit(" [/ROLE]"))))


def chat_examples(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text") -> DataFrame:
    """(conv_id, target, last, text, loss_start, loss_length): one example for each assistant turn.

    An example holds all turns before its target as context, and the loss mask (a span of
    code points, ``loss_start`` from 0) covers that reply's text only. ``target`` is the
    place of the turn in the conversation, from 1. Turns that follow the last reply are
    kept in one more example with an empty mask, so nothing is lost; ``last`` marks the
    example that holds the whole conversation. Turns are ordered by turn, ties by role
    and text; repeated rows are repeated turns; null roles and texts are empty; a null
    conversation id is a conversation of its own. An empty table gives no example.

    One conversation must fit a task, since its last example is the whole of it; examples
    are built row by row, not collected.
    """
    role = F.coalesce(F.col(f"`{role_col}`").cast("string"), F.lit(""))
    turn = F.struct(F.col(f"`{turn_col}`").alias("turn"), role.alias("role"),
                    F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    whole = (turns.select(F.col(f"`{conv_col}`").alias("conv_id"), turn.alias("t"))
             .groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("ts"))
             .select("conv_id", F.col("ts.role").alias("roles"), F.transform("ts", _render).alias("parts")))
    places = F.filter(F.sequence(F.lit(1), F.size("roles")),
                      lambda i: (F.element_at("roles", i) == "assistant") | (i == F.size("roles")))
    each = whole.select("conv_id", "roles", "parts", F.explode(places).alias("target"))
    reply = F.element_at("roles", F.col("target")) == "assistant"
    text = F.array_join(F.slice("parts", F.lit(1), F.col("target")), "")
    mark = len(_OPEN["assistant"]) + len(_CLOSE["assistant"])
    size = F.length(F.element_at("parts", F.col("target"))) - mark
    return each.select(
        "conv_id", "target", (F.col("target") == F.size("roles")).alias("last"), text.alias("text"),
        F.when(reply, size).otherwise(0).cast("long").alias("loss_length")).select(
        "conv_id", "target", "last", "text",
        F.when(F.col("loss_length") > 0, F.length("text") - F.col("loss_length") - len(_CLOSE["assistant"]))
        .otherwise(F.length("text")).cast("long").alias("loss_start"), "loss_length")


def parse_turns(text: Column) -> Column:
    """The turns (role, text) that a formatted text holds."""
    pieces = F.split(text, r" (?:\[/INST\]|</s>|\[/ROLE\])")

    def turn(p: Column) -> Column:
        user, reply = p.startswith(F.lit(_OPEN["user"])), p.startswith(F.lit(_OPEN["assistant"]))
        named = F.substring(p, F.lit(len("[ROLE] ") + 1), F.length(p))
        role = F.when(user, "user").when(reply, "assistant").otherwise(
            unescape(F.substring_index(named, " [TEXT] ", 1)))
        body = (F.when(user, F.substring(p, F.lit(len(_OPEN["user"]) + 1), F.length(p)))
                .when(reply, F.substring(p, F.lit(len(_OPEN["assistant"]) + 1), F.length(p)))
                .otherwise(F.substring_index(named, " [TEXT] ", -1)))
        return F.struct(role.alias("role"), unescape(body).alias("text"))

    return F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), turn)


def digests(examples: DataFrame) -> DataFrame:
    """Per conversation, from written examples alone: turns, trainable text and their digests."""
    whole = F.when(F.col("last"), parse_turns(F.col("text")))
    joined = F.array_join(F.transform(whole, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = unescape(F.substring("text", F.col("loss_start") + 1, F.col("loss_length")))
    rows = examples.select("conv_id", "target", F.length("text").cast("long").alias("chars"), loss.alias("loss"),
                           F.size(whole).cast("long").alias("n"), F.sha2(joined, 256).alias("turns"), "last")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("target", "loss"))), lambda x: x["loss"]), "")
    grouped = rows.groupBy("conv_id").agg(
        F.max(F.when(F.col("last"), F.col("n"))).alias("n_turns"),
        F.max(F.when(F.col("last"), F.col("turns"))).alias("turns_sha256"),
        text.alias("loss"), F.sum("chars").alias("formatted_chars"))
    return grouped.select("conv_id", "n_turns", "turns_sha256", F.length("loss").cast("long").alias("loss_chars"),
                          F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")
