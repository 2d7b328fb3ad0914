"""Chat formatting with a grammar round trip.

The rendered form of a conversation follows this grammar:

    chat  = "<chat escape=" level ">\\n" turn*
    turn  = "### " role ": " text "</turn>\\n"

Neither role nor text may hold "###" or "</turn>", and a role no ": ". A conversation is
first rendered as it is (level 0) and parsed again; if the parser does not give back
the very turns, the same is tried at level 1, where roles and texts are escaped: a
backslash goes before every backslash and every "#", and into every ": " and "</turn>".
Level 1 can always be read back, so it is the last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Fixed values of the template.
OPEN, CLOSE, HEAD, AFTER_ROLE = "<chat escape=", ">\n", "### ", ": "
END = "</turn>"
TURN_END = END + "\n"
ESCAPES = (("\\", "\\\\"), ("#", "\\#"), (": ", ":\\ "), (END, "<\\/turn>"))


def escape(value: Column) -> Column:
    for plain, marked in ESCAPES:
        value = F.replace(value, F.lit(plain), F.lit(marked))
    return value


def unescape(value: Column) -> Column:
    for plain, marked in reversed(ESCAPES):
        value = F.replace(value, F.lit(marked), F.lit(plain))
    return value


def _written(turn: Column, level: int) -> Column:
    role, text = turn["role"], turn["text"]
    if level:
        role, text = escape(role), escape(text)
    return F.concat(F.lit(HEAD), role, F.lit(AFTER_ROLE), text, F.lit(TURN_END))


def render(turns: Column, level: int) -> Column:
    """An array of (role, text) as one string."""
    body = F.array_join(F.transform(turns, lambda t: _written(t, level)), "")
    return F.concat(F.lit(f"{OPEN}{level}{CLOSE}"), body)


def _parts(formatted: Column) -> Column:
    """What stands before each end of a turn, header line cut off."""
    body = F.substring(formatted, len(OPEN) + 1 + len(CLOSE) + 1, 2**31 - 1)
    pieces = F.split(body, TURN_END, -1)
    return F.slice(pieces, 1, F.size(pieces) - 1)


def _spans(formatted: Column) -> Column:
    """(start, role, body) of every turn as it stands; start counts from 0 to the body."""
    parts = _parts(formatted)
    first = len(OPEN) + 1 + len(CLOSE)

    def cut(part: Column) -> Column:
        # The role ends at the first ": ", which an escaped role does not hold.
        head = F.locate(AFTER_ROLE, part, len(HEAD) + 1)
        return F.struct(
            F.length(part).alias("length"),
            (head + len(AFTER_ROLE) - 1).alias("to_body"),
            (F.startswith(part, F.lit(HEAD)) & (head > 0)).alias("good"),
            F.substr(part, F.lit(len(HEAD) + 1), head - len(HEAD) - 1).alias("role"),
            F.substr(part, head + len(AFTER_ROLE)).alias("body"),
        )

    def step(seen: Column, x: Column) -> Column:
        span = F.struct(
            (seen["at"] + x["to_body"]).cast("int").alias("start"),
            x["good"].alias("good"),
            x["role"].alias("role"),
            x["body"].alias("body"),
        )
        return F.struct(
            (seen["at"] + x["length"] + len(TURN_END)).cast("int").alias("at"),
            F.concat(seen["spans"], F.array(span)).alias("spans"),
        )

    kind = "array<struct<start:int,good:boolean,role:string,body:string>>"
    none = F.struct(F.lit(first).cast("int").alias("at"), F.array().cast(kind).alias("spans"))
    return F.aggregate(F.transform(parts, cut), none, step)["spans"]


def _level(formatted: Column) -> Column:
    return F.substring(formatted, len(OPEN) + 1, 1).cast("int")


def parse(formatted: Column) -> Column:
    """The turns of a rendered conversation; null where it breaks the grammar."""
    escaped = _level(formatted) == 1

    def turn(span: Column) -> Column:
        role, text = span["role"], span["body"]
        return F.struct(
            F.when(escaped, unescape(role)).otherwise(role).alias("role"),
            F.when(escaped, unescape(text)).otherwise(text).alias("text"),
        )

    def breaks(span: Column) -> Column:
        held = F.concat(span["role"], F.lit("\n"), span["body"])
        return ~span["good"] | F.contains(held, F.lit("###")) | F.contains(held, F.lit(END))

    spans = _spans(formatted)
    return F.when(~F.exists(spans, breaks), F.transform(spans, turn))


def loss_mask(formatted: Column, role: str) -> Column:
    """(start, length) in code points of the bodies a model is to learn from."""
    name = F.when(_level(formatted) == 1, escape(F.lit(role))).otherwise(F.lit(role))
    wanted = F.filter(_spans(formatted), lambda s: s["role"] == name)
    return F.transform(
        wanted, lambda s: F.struct(s["start"].alias("start"), F.length(s["body"]).alias("length"))
    )


def format_chats(
    rows: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    learn: str = "assistant",
) -> DataFrame:
    """One row per conversation: conv_id, formatted, level, mask.

    Turns go by number; rows with equal numbers by role, then text, and all of them
    count; null numbers come first. A null text or role is an empty one. Rows whose
    conversation is null form one conversation. Empty table, empty result; other
    columns are ignored. A conversation is one string, so it must fit in a row.
    """
    turn = F.struct(
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    source = rows.select(F.col(conv_col).alias("conv_id"), turn.alias("said"))
    chats = source.groupBy("conv_id").agg(F.sort_array(F.collect_list("said")).alias("said"))
    said = F.transform(
        "said", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))
    )
    chats = chats.select("conv_id", said.alias("turns"))
    plain = render(F.col("turns"), 0)
    chats = chats.withColumn("plain", F.explode(F.array(plain)))
    safe = F.coalesce(parse(F.col("plain")) == F.col("turns"), F.lit(False))
    formatted = F.when(safe, F.col("plain")).otherwise(render(F.col("turns"), 1))
    chats = chats.withColumn("formatted", F.explode(F.array(formatted)))
    same = F.coalesce(parse(F.col("formatted")) == F.col("turns"), F.lit(False))
    checked = F.when(same, F.col("formatted")).otherwise(
        F.raise_error(F.lit("a conversation does not read back as it was"))
    )
    return chats.select(
        "conv_id",
        checked.alias("formatted"),
        _level(F.col("formatted")).alias("level"),
        loss_mask(F.col("formatted"), learn).alias("mask"),
    )


def chat_digest(chats: DataFrame) -> DataFrame:
    """Digests of turns and masked text, both read back from the formatted strings."""
    turns = parse(F.col("formatted"))
    said = F.array_join(
        F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )

    def learned(span: Column) -> Column:
        body = F.substr(F.col("formatted"), span["start"] + 1, span["length"])
        return F.when(F.col("level") == 1, unescape(body)).otherwise(body)

    loss = F.array_join(F.transform("mask", learned), "")
    read = chats.select("*", F.size(turns).cast("long").alias("n_turns"), said.alias("said"))
    read = read.withColumn("loss", F.explode(F.array(loss)))
    return read.select(
        "conv_id",
        "n_turns",
        F.sha2(F.col("said").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
