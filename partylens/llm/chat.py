"""Chat formatting of typed content parts. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END, STOP = "<|im_start|>", "<|im_end|>", "<|im_end|>\n"
KINDS = ("image", "audio", "document")  # part types that become placeholders
TOKENS_PER_UNIT = {"image": 256, "audio": 50, "document": 512}  # expanded tokens for each unit of an attachment
PART = "struct<type:string,text:string,ref:string,units:bigint>"


def escaped(text: Column) -> Column:
    """One backslash goes into every ``<|``, ``<\\|``, ... so that no control string is left."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"<(\\*)\|", r"<\\$1|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escaped_role(role: Column) -> Column:
    """A role is one line: a line end becomes ``<n|``, and what looks so already gets a backslash as above."""
    return F.replace(F.regexp_replace(F.coalesce(role, F.lit("")), r"<(\\*)(n?)\|", r"<\\$1$2|"), F.lit("\n"), F.lit("<n|"))


def unescaped_role(role: Column) -> Column:
    return F.regexp_replace(F.replace(role, F.lit("<n|"), F.lit("\n")), r"<\\(\\*)(n?)\|", r"<$1$2|")


def text_part(text: Column) -> Column:
    """The content of a turn that only has text."""
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("bigint").alias("units")))


def visit(parts: Column) -> tuple[Column, Column]:
    """What each part becomes in the text, and the attachments with their expanded tokens, both in order.

    Text is escaped; image, audio and document become ``<|kind|>``; a part of any other type keeps its
    text. A null list or part is empty.
    """
    present = F.filter(F.coalesce(parts, F.array().cast(f"array<{PART}>")), lambda p: p.isNotNull())
    placeholder = F.transform(
        present, lambda p: F.when(p["type"].isin(*KINDS), F.concat(F.lit("<|"), p["type"], F.lit("|>"))).otherwise(escaped(p["text"]))
    )
    per_unit = F.create_map(*[F.lit(x) for kind in TOKENS_PER_UNIT.items() for x in kind])
    attached = F.transform(
        F.filter(present, lambda p: p["type"].isin(*KINDS)),
        lambda p: F.struct(
            p["type"].alias("kind"), p["ref"].alias("ref"),
            (F.coalesce(p["units"], F.lit(1)) * per_unit[p["type"]]).cast("bigint").alias("tokens"),
        ),
    )
    return F.array_join(placeholder, ""), attached


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", parts_col: str = "parts", trained: str = "assistant") -> DataFrame:
    """One row per conversation: conv_id, formatted, segments, attachments, expanded_tokens.

    ``turns`` has one row per turn; ``parts`` is an array of (type, text, ref, units). Turns go by number;
    equal numbers by role and text, so repeated rows stand next to each other; null numbers come first.
    A null conversation id is a conversation of its own. ``segments`` are the pieces of ``formatted`` in
    order as (text, loss): the content of turns of role ``trained`` carries the loss, markers never do.
    ``attachments`` are numbered by their order in the conversation, with the turn's number; their tokens,
    and nothing else, are ``expanded_tokens``. Other columns are not read; no turns give no rows.

    A conversation is one output row, so its text must fit one row (2 GB); the rows of a conversation are
    brought together compactly by one partial aggregation.
    """
    content, attached = visit(F.col(parts_col))
    rows = turns.select(
        F.col(conv_col).alias("conv_id"),
        F.struct(
            F.col(turn_col).alias("turn"), escaped_role(F.col(role_col)).alias("role"), content.alias("content"),
            F.coalesce(F.col(role_col) == trained, F.lit(False)).alias("loss"), attached.alias("attached"),
        ).alias("said"),
    )
    talks = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("said")).alias("said"))
    plain = lambda text: F.struct(text.alias("text"), F.lit(False).alias("loss"))
    segments = F.flatten(F.transform("said", lambda t: F.array(
        plain(F.concat(F.lit(START), t["role"], F.lit("\n"))), F.struct(t["content"].alias("text"), t["loss"].alias("loss")), plain(F.lit(STOP)),
    )))
    every = F.flatten(F.transform("said", lambda t: F.transform(t["attached"], lambda a: F.struct(t["turn"].alias("turn"), a["kind"].alias("kind"), a["ref"].alias("ref"), a["tokens"].alias("tokens")))))
    shaped = talks.select("conv_id", segments.alias("segments"), every.alias("every"))
    return shaped.select(
        "conv_id",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        "segments",
        F.transform("every", lambda a, i: F.struct(i.cast("bigint").alias("place"), a["turn"].alias("turn"), a["kind"].alias("kind"), a["ref"].alias("ref"), a["tokens"].alias("tokens"))).alias("attachments"),
        F.aggregate("every", F.lit(0).cast("bigint"), lambda total, a: total + a["tokens"]).alias("expanded_tokens"),
    )


def read_turns(formatted: Column) -> Column:
    """Back from the text: array of (role, text)."""
    said = F.split(formatted, r"<\|im_end\|>\n")
    return F.transform(
        F.slice(said, F.lit(1), F.size(said) - 1),
        lambda t: F.struct(
            unescaped_role(F.substring_index(F.substr(t, F.lit(len(START) + 1)), "\n", 1)).alias("role"),
            unescaped(F.substr(t, F.locate("\n", t) + 1)).alias("text"),
        ),
    )


def chat_digest(chats: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, all read back from the formatted output."""
    read = chats.select(
        "conv_id", read_turns(F.col("formatted")).alias("turns"),
        F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescaped(s["text"])), "").alias("learned"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )
    digest = lambda text: F.sha2(F.encode(text, "UTF-8"), 256)
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), digest(told).alias("turns_sha256"),
        F.length("learned").cast("bigint").alias("loss_chars"), digest(F.col("learned")).alias("loss_sha256"), "formatted_chars",
    )
