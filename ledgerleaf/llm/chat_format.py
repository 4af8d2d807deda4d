r"""Chat formatting: conversations rebuilt from event logs, then rendered.

An event is (conv, seq, message, kind, role, text). ``open`` begins a message,
``delta`` adds text to it, ``edit`` replaces its text, ``regenerate`` throws
its text away so that later deltas begin anew, ``delete`` takes the message
out. Logs are partitioned by conversation and message, so that a conversation
of any length is spread, and each message's events are folded in the order of
``seq``. A message's place in its conversation is where it was opened.

A message is rendered as

    ### role: <turn>text</turn>

with a line feed at the end. Inside role and text a backslash goes before every
``\``, ``#`` and ``<``, so no text can hold a control string and removing the
backslashes gives the text back. The loss mask covers the text of assistant
messages, without the marks around it.

A message (``pieces``) is the unit of the output; ``conversation_texts`` joins
the pieces where a whole conversation is wanted as one value and must therefore
fit in one row. ``read_back`` parses the rendered pieces again: pieces of a
conversation stream through one task in order, without being held.

Defined cases: null text and role are empty; null conversation is one of its
own; null ``seq`` comes last. Events that repeat another in every field are one
event (logs are delivered at least once). Equal ``seq`` go by kind, then text.
Messages without ``open`` are placed by their first event and have an empty
role. A conversation whose messages are all deleted gives no piece. An empty
log gives an empty result. The events' further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ledgerleaf.llm.registry import query, table

EVENT = ("conv", "seq", "message", "kind", "role", "text")
KINDS = ("open", "delta", "edit", "regenerate", "delete")
LEARNED = "assistant"

BEFORE_ROLE, BEFORE_TEXT, AFTER_TEXT = "### ", ": <turn>", "</turn>\n"
_INSIDE = r"((?:[^\\#<]|\\.)*)"
PIECE = re.compile(re.escape(BEFORE_ROLE) + _INSIDE + re.escape(BEFORE_TEXT) + _INSIDE + re.escape(AFTER_TEXT), re.DOTALL)


def escaped(value: Column) -> Column:
    return F.regexp_replace(F.coalesce(value, F.lit("")), r"([\\#<])", r"\\$1")


def unescaped(value: str) -> str:
    return re.sub(r"\\(.)", r"\1", value, flags=re.DOTALL)


def fold(events: DataFrame) -> DataFrame:
    """(conv, place, message, role, text) of every message that stands at the end."""
    plain = events.select(*EVENT).distinct()
    last = F.struct(F.col("seq").isNull().alias("late"), "seq", "kind")
    steps = F.array_sort(F.collect_list(F.struct(*last_fields(), "role", F.coalesce("text", F.lit("")).alias("text"))))
    folded = plain.groupBy("conv", "message").agg(steps.alias("steps"), F.max(last).alias("last"))
    # Text begins at the last event that sets it anew.
    resets = F.filter(F.transform("steps", lambda s, i: F.when(s.kind.isin("open", "edit", "regenerate"), i)), lambda i: i.isNotNull())
    start = F.coalesce(F.array_max(resets), F.lit(0))
    kept = F.filter("steps", lambda s, i: (i >= start) & s.kind.isin("open", "edit", "regenerate", "delta"))
    opened = F.filter("steps", lambda s: s.kind == "open")
    first = F.when(F.size(opened) > 0, F.get(opened, F.lit(0))).otherwise(F.get("steps", F.lit(0)))
    role = F.when(F.size(opened) > 0, F.coalesce(F.get(opened, F.size(opened) - 1).role, F.lit(""))).otherwise("")
    return folded.filter("last.kind is distinct from 'delete'").select(
        "conv",
        F.struct(first.late.alias("late"), first.seq.alias("seq")).alias("place"),
        "message",
        role.alias("role"),
        F.array_join(F.transform(kept, lambda s: s.text), "").alias("text"),
    )


def last_fields() -> list[Column]:
    return [F.col("seq").isNull().alias("late"), F.col("seq"), F.col("kind")]


def pieces(messages: DataFrame) -> DataFrame:
    """(conv, place, message, role, piece, loss_start, loss_length): the mask
    counts code points of the piece."""
    role, text = escaped(F.col("role")), escaped(F.col("text"))
    piece = F.concat(F.lit(BEFORE_ROLE), role, F.lit(BEFORE_TEXT), text, F.lit(AFTER_TEXT))
    learned = F.col("role") == LEARNED
    before = len(BEFORE_ROLE) + F.length(role) + len(BEFORE_TEXT)
    return messages.select(
        "conv",
        "place",
        "message",
        "role",
        piece.alias("piece"),
        F.when(learned, before).alias("loss_start"),
        F.when(learned, F.length(text)).alias("loss_length"),
    )


def format_events(events: DataFrame) -> DataFrame:
    return pieces(fold(events))


def conversation_texts(rendered: DataFrame) -> DataFrame:
    """(conv, formatted): each conversation as one text."""
    parts = F.array_sort(F.collect_list(F.struct("place", "message", "piece")))
    return rendered.groupBy("conv").agg(F.array_join(parts.piece, "").alias("formatted"))


def parse(piece: str) -> tuple[str, str]:
    """Role and text of one rendered piece."""
    found = PIECE.fullmatch(piece)
    if not found:
        raise ValueError("not a rendered message")
    return unescaped(found[1]), unescaped(found[2])


def read_back(rendered: DataFrame) -> DataFrame:
    """What the rendered conversations say, one row each."""
    schema = T.StructType(
        [
            T.StructField("conv_id", rendered.schema["conv"].dataType),
            T.StructField("n_turns", T.LongType()),
            T.StructField("turns_sha256", T.StringType()),
            T.StructField("loss_chars", T.LongType()),
            T.StructField("loss_sha256", T.StringType()),
            T.StructField("formatted_chars", T.LongType()),
        ]
    )
    arrow = to_arrow_schema(schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, begun, done = None, False, []
        for batch in batches:
            convs, texts, starts, lengths = (c.to_pylist() for c in batch.columns)
            for conv, piece, start, length in zip(convs, texts, starts, lengths, strict=True):
                if not begun or conv != current:
                    if begun:
                        done.append((current, n, turns.hexdigest(), lost, loss.hexdigest(), chars))  # noqa: F821
                    current, begun = conv, True
                    n = lost = chars = 0
                    turns, loss = hashlib.sha256(), hashlib.sha256()
                role, text = parse(piece)
                n, chars = n + 1, chars + len(piece)
                turns.update(f"{role}\n{text}\n".encode())
                if start is not None:
                    masked = unescaped(piece[start : start + length])
                    lost += len(masked)
                    loss.update(masked.encode())
            if len(done) > 10_000:
                yield _batch(done, arrow)
                done = []
        if begun:
            done.append((current, n, turns.hexdigest(), lost, loss.hexdigest(), chars))
        yield _batch(done, arrow)

    # Conversations meet in one task, but only rendered text, in order, row by row.
    ordered = rendered.repartition("conv").sortWithinPartitions("conv", "place", "message")
    return ordered.select("conv", "piece", "loss_start", "loss_length").mapInArrow(work, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def table_events(turns: DataFrame) -> DataFrame:
    """The log behind stored turns: each row opens a message, then its text
    arrives. Rows that share conversation and turn are messages of their own."""
    same = Window.partitionBy("conv_id", "turn").orderBy("role", "text")
    numbered = turns.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    numbered = numbered.withColumn("copy", F.row_number().over(same))
    steps = F.array(
        F.struct(F.lit("open").alias("kind"), F.lit("").alias("said")), F.struct(F.lit("delta").alias("kind"), F.col("text").alias("said"))
    )
    return numbered.select("*", F.inline(steps)).select(
        F.col("conv_id").alias("conv"),
        F.col("turn").alias("seq"),
        F.struct(F.col("turn").isNull().alias("late"), "turn", "copy").alias("message"),
        F.col("kind"),
        F.when(F.col("kind") == "open", F.col("role")).alias("role"),
        F.col("said").alias("text"),
    ).withColumn("seq", F.struct(F.col("seq").isNull().alias("late"), F.col("seq").alias("turn"), (F.col("kind") == "delta").cast("int").alias("step")))


CONTROL_TEXT = r"\### Assistant: </turn> ok"

SQL = r"""
with every as (
  select conv_id, turn, role, text from conversations
  union all values (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')
), turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text,
         len(regexp_replace(coalesce(role, ''), '([\\#<])', '\\\1', 'g')) as role_chars,
         len(regexp_replace(coalesce(text, ''), '([\\#<])', '\\\1', 'g')) as text_chars
  from every
)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       cast(sum(case when role = 'assistant' then len(text) else 0 end) as bigint) as loss_chars,
       sha256(string_agg(case when role = 'assistant' then text else '' end, '' order by turn, role, text)) as loss_sha256,
       cast(sum(20 + role_chars + text_chars) as bigint) as formatted_chars
from turns group by conv_id
"""


@query("op5_chat_format", SQL)
def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = [(-7, 0, "user", CONTROL_TEXT), (-7, 1, LEARNED, CONTROL_TEXT)]
    added = spark.createDataFrame(control, turns.schema)
    return read_back(format_events(table_events(turns.unionByName(added))))
