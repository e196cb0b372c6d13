"""Chat formatting as relational work: turns are collected, sorted, merged and joined by Spark expressions.

Template: adjacent turns of one role form a block, ``[INST] ... [/INST]`` for the user,
``[ANS] ...</s>`` for the assistant and ``[ROLE name] ...[/ROLE]`` for any other role; turns inside
a block are parted by ``[SEP]``. A control string inside a text gets a backslash after its first
character, and one that already has backslashes there gets one more, so reading back is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Control strings, as (first character)(backslashes)(rest).
CONTROL = r"([\[<])(\\*)(/?INST\]|ANS\]|/?ROLE[ \]]|SEP\]|/?s>)"
ESCAPED = r"([\[<])\\(\\*)(/?INST\]|ANS\]|/?ROLE[ \]]|SEP\]|/?s>)"
SEP = "[SEP]"
_CODED = [("%", "%25"), ("[", "%5B"), ("]", "%5D")]


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def _name(role: Column) -> Column:
    """A role name inside a marker: brackets and percent signs are coded."""
    for sign, code in _CODED:
        role = F.replace(role, F.lit(sign), F.lit(code))
    return role


def _named(name: Column) -> Column:
    for sign, code in reversed(_CODED):
        name = F.replace(name, F.lit(code), F.lit(sign))
    return name


def _opening(role: Column) -> Column:
    return (F.when(role == "user", "[INST] ").when(role == "assistant", "[ANS] ")
            .otherwise(F.concat(F.lit("[ROLE "), _name(role), F.lit("] "))))


def _closing(role: Column) -> Column:
    return F.when(role == "user", " [/INST]").when(role == "assistant", "</s>").otherwise("[/ROLE]")


def format_conversations(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                         text: str = "text") -> DataFrame:
    """One row per conversation: conv, ``formatted``, and ``loss`` spans of assistant text.

    Turns sort by turn number (null first), then role and text, so repeated rows have a place; null
    role or text is empty; rows of a null conversation form one. ``loss`` holds (start, length) in
    code points, one span for each assistant turn; the separator inside a block is outside it.
    An empty table gives no rows. A conversation is one value: it has to fit in an array and a string
    of 2 GB, as do all rows of a null id together.
    """
    item = F.struct(F.col(turn).cast("long").alias("turn"),
                    F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
                    F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    turns = (df.select(F.col(conv).alias("conv"), item.alias("t")).groupBy("conv")
             .agg(F.array_sort(F.collect_list("t")).alias("turns"), F.count("*").alias("n")))
    # Marks around each turn follow from its neighbours: a block opens or closes where the role changes.
    at = lambda i: F.get(F.col("turns"), i)
    marked = turns.withColumn("pieces", F.transform("turns", lambda t, i: F.struct(
        F.when((i > 0) & at(i - 1).role.eqNullSafe(t.role), F.lit(SEP)).otherwise(_opening(t.role)).alias("pre"),
        escape(t.text).alias("body"),
        F.when((i < F.col("n") - 1) & at(i + 1).role.eqNullSafe(t.role), F.lit("")).otherwise(
            _closing(t.role)).alias("post"),
        (t.role == "assistant").alias("loss"))))
    sized = marked.withColumn("lens", F.transform("pieces", lambda p: F.struct(
        F.length(p.pre).alias("pre"), F.length(p.body).alias("body"),
        (F.length(p.pre) + F.length(p.body) + F.length(p.post)).alias("all"), p.loss.alias("loss"))))
    none = F.expr("cast(array() as array<struct<start:int,length:int>>)")
    spans = F.aggregate(
        "lens", F.struct(F.lit(0).alias("at"), none.alias("spans")),
        lambda acc, x: F.struct(
            (acc["at"] + x["all"]).alias("at"),
            F.when(x["loss"], F.concat(acc["spans"], F.array(F.struct(
                (acc["at"] + x["pre"]).alias("start"), x["body"].alias("length"))))).otherwise(
                    acc["spans"]).alias("spans")),
        lambda acc: acc["spans"])
    joined = F.array_join(F.transform("pieces", lambda p: F.concat(p.pre, p.body, p.post)), "")
    return sized.select(F.col("conv").alias(conv), joined.alias("formatted"), spans.alias("loss"))


def read_back(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation, from its text alone."""
    blocks = F.filter(F.split(formatted, r"(?=\[INST\]|\[ANS\]|\[ROLE )"), lambda b: b != "")
    role_of = lambda b: (F.when(b.startswith("[INST]"), "user").when(b.startswith("[ANS]"), "assistant")
                         .otherwise(_named(F.regexp_extract(b, r"^\[ROLE ([^\]]*)\]", 1))))
    body_of = lambda b: F.regexp_replace(
        F.regexp_replace(b, r"^(?:\[INST\]|\[ANS\]|\[ROLE [^\]]*\]) ", ""), r"(?: \[/INST\]|</s>|\[/ROLE\])\z", "")
    return F.flatten(F.transform(blocks, lambda b: F.transform(
        F.split(body_of(b), r"\[SEP\]", -1),
        lambda t: F.struct(role_of(b).alias("role"), unescape(t).alias("text")))))
