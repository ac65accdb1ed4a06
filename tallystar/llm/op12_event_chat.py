"""Chat formatting from an event log: conversations are folded from what happened to them, then rendered.

A log holds events (conv_id, seq, message, kind, role, text):

* `start` opens a message with its role and first text; a second start of a message replaces it;
* `delta` appends its text, as streamed;
* `edit` replaces what the message says so far; later deltas append to the new text;
* `regenerate` does the same, and all messages after this one are gone unless they start again later.

Events are partitioned by message first, sorted by `seq` and folded, so a long conversation is spread over many tasks
until its messages are final. A running maximum over the messages of a conversation finds those that a later
regeneration took back. The rest are rendered in order:

    <s>[INST]role[/INST]text</s>

Control strings inside roles and texts get one backslash more after their first character (`<\\s>`), also those that
have some already, so that unescaping takes exactly one away. The loss mask covers the texts of assistant messages.

Only DataFrame functions are used. A conversation's rendered form is one value and has to fit into memory.

Defined cases: null text is empty, a null role is the empty role; null conv_id, seq and message are values of their
own and come first. Events of equal seq are applied in the order start, regenerate, edit, delta, then by text;
repeated events are applied each. A message without `start` has the empty role and stands from its first event on.
`message` may be of any type that sorts. Extra columns are ignored. An empty log gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallystar.llm.common import table

BEGIN, ROLE, ROLE_END, END = "<s>", "[INST]", "[/INST]", "</s>"
# A control string, with any backslashes after its first character.
CONTROL = r"([<\[])(\\*)(s>|/s>|INST\]|/INST\])"
ESCAPED = r"([<\[])\\(\\*)(s>|/s>|INST\]|/INST\])"
LOSS_ROLE = "assistant"
DELTA = 256  # characters of a streamed piece

# Order of events with equal seq.
KINDS = ["start", "regenerate", "edit", "delta"]
RESETS = ["start", "regenerate", "edit"]


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def messages(events: DataFrame) -> DataFrame:
    """(conv_id, message, role, text) of the messages that are left once the whole log has been applied."""
    kind = F.col("kind")
    step = F.array_position(F.array(*map(F.lit, KINDS)), kind).alias("step")
    place = F.struct(F.col("seq"), step)
    event = F.struct(F.col("seq"), step, F.coalesce("text", F.lit("")).alias("text"))
    opening = F.struct(F.col("seq"), step, F.coalesce("role", F.lit("")).alias("role"))
    folded = events.groupBy("conv_id", "message").agg(
        F.max(F.when(kind.isin(RESETS), event)).alias("reset"),
        F.max(F.when(kind == "regenerate", place)).alias("rewound"),
        F.max(F.when(kind == "start", opening)).alias("opened"),
        F.min(place).alias("first"),
        F.sort_array(F.collect_list(F.when(kind == "delta", event))).alias("deltas"),
    )
    later = F.filter("deltas", lambda e: F.col("reset").isNull() | (e > F.col("reset")))
    final = folded.select(
        "conv_id", "message", "rewound",
        F.coalesce("opened.role", F.lit("")).alias("role"),
        F.concat_ws("", "reset.text", F.transform(later, lambda e: e["text"])).alias("text"),
        F.when(F.col("opened").isNotNull(), F.struct("opened.seq", "opened.step")).otherwise(F.col("first")).alias("since"),
    )
    earlier = Window.partitionBy("conv_id").orderBy("message").rowsBetween(Window.unboundedPreceding, -1)
    return (
        final.withColumn("undone", F.max("rewound").over(earlier))
        .filter(F.col("undone").isNull() | (F.col("since") > F.col("undone")))
        .select("conv_id", "message", "role", "text")
    )


def render(final: DataFrame) -> DataFrame:
    """(conv_id, segments): pieces of the formatted conversation in order, each with its bit of the loss mask."""

    def piece(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    def of(turn: Column) -> Column:
        head = F.concat(F.lit(BEGIN + ROLE), escape(turn["role"]), F.lit(ROLE_END))
        return F.array(
            piece(head, F.lit(False)),
            piece(escape(turn["text"]), turn["role"] == LOSS_ROLE),
            piece(F.lit(END), F.lit(False)),
        )

    turns = final.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("message", "role", "text"))).alias("turns"))
    return turns.select("conv_id", F.flatten(F.transform("turns", of)).alias("segments"))


def format_conversations(events: DataFrame) -> DataFrame:
    """(conv_id, formatted, segments) per conversation."""
    joined = F.concat_ws("", F.transform("segments", lambda s: s["text"]))
    return render(messages(events)).select("conv_id", joined.alias("formatted"), "segments")


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation, unescaped."""
    written = F.filter(F.split(formatted, END), lambda t: t != "")

    def turn(t: Column) -> Column:
        parts = F.split(t, r"\[/INST\]", 2)
        role = F.substring(parts[0], len(BEGIN + ROLE) + 1, F.length(parts[0]))
        return F.struct(unescape(role).alias("role"), unescape(parts[1]).alias("text"))

    return F.transform(written, turn)


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.concat_ws("", F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])))


def event_log(conversations: DataFrame, delta: int = DELTA) -> DataFrame:
    """The log that a table of finished turns stands for: a start per turn, then its text in streamed pieces.

    Rows with equal turn are messages of their own, ordered by role and text. A message is known by (turn, copy), so
    a long conversation needs no numbering as a whole.
    """
    copies = Window.partitionBy("conv_id", "turn").orderBy("role", "text")
    turns = conversations.select("conv_id", "turn", "role", "text").withColumn("copy", F.row_number().over(copies))
    pieces = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(f"(?s).{{1,{delta}}}"), F.lit(0))
    opened = F.struct(F.lit("start").alias("kind"), F.col("role"), F.lit("").alias("text"))
    streamed = F.transform(
        F.filter(pieces, lambda p: p != ""),
        lambda p: F.struct(F.lit("delta").alias("kind"), F.lit(None).cast("string").alias("role"), p.alias("text")),
    )
    events = F.posexplode(F.concat(F.array(opened), streamed)).alias("seq", "event")
    return turns.select("conv_id", F.struct("turn", "copy").alias("message"), events).select(
        "conv_id", F.struct("message", "seq").alias("seq"), "message", "event.*"
    )


def op12_event_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, LOSS_ROLE, said)], "conv_id long, turn long, role string, text string")
    log = event_log(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(added))
    turns, loss = F.col("turns"), F.col("loss")
    read = format_conversations(log).select(
        "conv_id", "formatted", read_turns(F.col("formatted")).alias("turns"), loss_text(F.col("segments")).alias("loss")
    )
    told = F.concat_ws("", F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return read.select(
        "conv_id",
        F.size(turns).cast("long").alias("n_turns"),
        F.sha2(told.cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
