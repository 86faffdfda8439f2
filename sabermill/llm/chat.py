"""Chat formatting from an event log.

A log row is one event of a conversation: ``conv_id``, ``message`` (names the message and orders it
among the others), ``seq`` (orders the events), ``kind``, ``role``, ``text``. Kinds:

* ``message`` opens a message with a role and some text, maybe none yet;
* ``delta`` adds its text to the end;
* ``edit`` puts its text in place of all text so far;
* ``regenerate`` throws all text so far away.

The final text of a message is that of its last ``message``, ``edit`` or ``regenerate`` and of the
deltas after it, in the order of ``seq``; its role is that of its first event that has one. Events fold
by (conversation, message), so a long conversation is spread over tasks until its
messages, already in their final form, are put one after another: that text is one row of the
result by nature.

The template marks each turn as ``<|turn|>role<|text|>text<|end|>``. Control strings inside roles
and texts get a backslash after their first character, backslashes are doubled; so no control
string can come from a text, and ``unescape`` restores every text.

Defined cases: a null text is empty, a null role too; events of unknown kind and events with a null
``message`` are left out. Events equal in ``seq`` apply in the order of (kind, role, text); repeated events
each apply. A null conversation id is a conversation of its own. Extra columns are not read. Empty logs
give no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The template's own marks and control strings of other templates.
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
CONTROL = ["<|", "<s>", "</s>", "[INST]", "[/INST]"]
TRAINED_ROLE = "assistant"


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return reduce(lambda t, c: F.replace(t, F.lit(c), F.lit(f"{c[0]}\\{c[1:]}")), CONTROL, doubled)


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


def messages_of(events: DataFrame) -> DataFrame:
    """Final messages: conv_id, message, role, text."""
    sets = F.col("kind").isin("message", "edit", "regenerate")
    known = events.where((sets | (F.col("kind") == "delta")) & F.col("message").isNotNull()).select(
        "conv_id",
        "message",
        "seq",
        "kind",
        "role",
        F.when(F.col("kind") == "regenerate", F.lit("")).otherwise(F.coalesce("text", F.lit(""))).alias("text"),
    )
    order = F.struct("seq", "kind", "role", "text")
    own = Window.partitionBy("conv_id", "message").orderBy("seq", "kind", "role", "text")
    # How often the text was set anew, up to each event; what the last setting began, stays.
    numbered = known.withColumn("setting", F.sum(sets.cast("int")).over(own.rowsBetween(Window.unboundedPreceding, 0)))
    setting = numbered.groupBy("conv_id", "message", "setting").agg(
        F.min(F.when(F.col("role").isNotNull(), F.struct("seq", "role"))).alias("role"),
        F.sort_array(F.collect_list(order)).alias("parts"),
    )
    text = F.array_join(F.transform("parts", lambda p: p.text), "")
    return setting.groupBy("conv_id", "message").agg(F.min("role").getField("role").alias("role"), F.max_by(text, "setting").alias("text"))


def render(messages: DataFrame) -> DataFrame:
    """conv_id, formatted and loss_spans (character intervals of the trained texts) of each conversation."""
    pieces = messages.select(
        "conv_id",
        "message",
        F.concat(F.lit(TURN), escape(F.coalesce("role", F.lit(""))), F.lit(TEXT)).alias("head"),
        escape(F.coalesce("text", F.lit(""))).alias("body"),
        (F.coalesce("role", F.lit("")) == TRAINED_ROLE).alias("trained"),
    )
    size = F.char_length("head") + F.char_length("body") + len(END)
    before = Window.partitionBy("conv_id").orderBy("message").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(size.cast("long")).over(before) - len(END)
    placed = pieces.withColumn("end", end).withColumn("begin", F.col("end") - F.char_length("body"))
    turns = placed.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("begin", F.concat("head", "body", F.lit(END)).alias("piece")))).alias("pieces"),
        F.sort_array(F.collect_list(F.when(F.col("trained"), F.struct("begin", "end")))).alias("loss_spans"),
    )
    return turns.select("conv_id", F.array_join(F.transform("pieces", lambda p: p.piece), "").alias("formatted"), "loss_spans")


def format_chats(events: DataFrame) -> DataFrame:
    return render(messages_of(events))


def turns_in(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts read back from a formatted conversation."""
    return [tuple(unescape(x) for x in turn.removeprefix(TURN).split(TEXT)) for turn in formatted.split(END)[:-1]]


def digests(formatted: DataFrame) -> DataFrame:
    """What a reader of the formatted conversations finds in them, as counts and digests."""
    fields = [("n_turns", T.LongType()), ("turns_sha256", T.StringType()), ("loss_chars", T.LongType()), ("loss_sha256", T.StringType()), ("formatted_chars", T.LongType())]
    schema = T.StructType([formatted.schema["conv_id"], *[T.StructField(*f) for f in fields]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                turns = turns_in(text)
                trained = [unescape(text[s["begin"] : s["end"]]) for s in spans]
                rows.append({
                    "n_turns": len(turns),
                    "turns_sha256": sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
                    "loss_chars": sum(map(len, trained)),
                    "loss_sha256": sha256("".join(trained).encode()).hexdigest(),
                    "formatted_chars": len(text),
                })
            found = pa.Table.from_pylist(rows, pa.schema([(n, pa.string() if "sha" in n else pa.int64()) for n, _ in fields]))
            yield pa.RecordBatch.from_arrays([batch.column(0), *[c.combine_chunks() if c.num_chunks != 1 else c.chunk(0) for c in found.columns]], schema.names)

    return formatted.select("conv_id", "formatted", "loss_spans").mapInArrow(run, schema)


def log_of(conversations: DataFrame, piece: int = 256) -> DataFrame:
    """The events that would have led to stored conversations (conv_id, turn, role, text).

    Turns of the trained role are streamed: opened empty, then sent as deltas of ``piece``
    characters. Rows that share a conversation and turn are messages in the order of role and text.
    """
    nth = F.row_number().over(Window.partitionBy("conv_id", "turn").orderBy("role", "text"))
    rows = conversations.select("conv_id", F.struct(F.col("turn").isNotNull().alias("known"), "turn", nth.alias("nth")).alias("message"), "role", F.coalesce("text", F.lit("")).alias("text"))
    streamed = F.coalesce(F.col("role") == TRAINED_ROLE, F.lit(False))
    cut = F.transform(
        F.sequence(F.lit(0), F.floor(F.greatest(F.char_length("text") - 1, F.lit(0)) / piece).cast("int")),
        lambda i: F.struct((i + 1).alias("seq"), F.lit("delta").alias("kind"), F.col("text").substr(i * piece + 1, F.lit(piece)).alias("text")),
    )
    opened = F.array(F.struct(F.lit(0).alias("seq"), F.lit("message").alias("kind"), F.when(streamed, "").otherwise(F.col("text")).alias("text")))
    events = F.when(streamed, F.concat(opened, cut)).otherwise(opened)
    return rows.select("conv_id", "message", "role", F.explode(events).alias("event")).select("conv_id", "message", "event.seq", "event.kind", "role", "event.text")
