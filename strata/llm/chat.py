"""Chat formatting by event sourcing: logs are folded into final messages, then rendered.

A log row is an event of one message of a conversation. Events of a message are applied by `seq`:

    open        starts the message (role)          delta       appends text (streamed output)
    edit        replaces the text                  regenerate  empties the text; deltas follow
    delete      removes the message

The log is partitioned by message and folded as a stream of sorted rows, so neither a long conversation
nor a long stream is gathered: a task holds one message at a time. Rendered messages are then joined in
order, one conversation at a time, the formatted text being the only thing that grows with it.

Rendering: `<s>[INST] role [/INST]\\n` text `</s>\\n`. Control strings inside roles and texts carry an
inserted backslash and backslashes are doubled, so the text is read back exactly. The loss mask covers the
texts of assistant messages (end marks excluded) as [start, end) offsets in code points.

NULL text or role counts as empty, a NULL position sorts first, rows without a conversation id form one
conversation. Positions that tie are ordered by role, text and message. A message without `open` has an
empty role. Repeated rows are repeated events. An empty log gives no conversation.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import map_batches

KINDS = ("open", "delta", "edit", "regenerate", "delete")
CONTROL = r"<(?=/?s>)|\[(?=/?INST\])"
TURN = re.compile(r"<s>\[INST\] (.*?) \[/INST\]\n(.*?)</s>\n", re.DOTALL)
LEARNT = "assistant"


def log_of(turns: DataFrame) -> DataFrame:
    """The event log of finished turns (conv_id, turn, role, text): each opens and streams one delta."""
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("position"),
        F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"),
    ).withColumn("message", F.monotonically_increasing_id())
    events = F.array(
        F.struct(F.lit(0).alias("seq"), F.lit("open").alias("kind"), F.lit(None).cast("string").alias("body")),
        F.struct(F.lit(1).alias("seq"), F.lit("delta").alias("kind"), F.col("text").alias("body")),
    )
    return rows.select("conv_id", "position", "message", "role", F.inline(events)).withColumnRenamed("body", "text")


def fold(log: DataFrame) -> DataFrame:
    """Final messages (conv_id, position, message, role, text) of an event log."""
    names = ["conv_id", "message", "seq", "position", "kind", "role", "text"]
    rows = (
        log.select(*names)
        .repartition("conv_id", "message")
        .sortWithinPartitions("conv_id", "message", "seq", "kind", "text")
    )
    types = [f"{n} {rows.schema[n].dataType.simpleString()}" for n in ("conv_id", "position", "message", "role", "text")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, place, role, parts, gone = None, None, "", [], False

        def out(done: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*done, strict=True)) if done else [[]] * 5
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                names=["conv_id", "position", "message", "role", "text"],
            )

        kinds = None
        for batch in batches:
            if kinds is None:
                field = batch.schema.field
                kinds = [field("conv_id").type, field("position").type, field("message").type, pa.string(), pa.string()]
            done = []
            for conv, message, _, position, kind, who, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != (conv, message):
                    if key and not gone:
                        done.append((key[0], place, key[1], role, "".join(parts)))
                    key, place, role, parts, gone = (conv, message), position, "", [], False
                if kind == "open":
                    role, place = who or "", position
                elif kind == "delta":
                    parts.append(text or "")
                elif kind == "edit":
                    parts = [text or ""]
                elif kind == "regenerate":
                    parts = []
                elif kind == "delete":
                    gone = True
            yield out(done)
        if key and not gone:
            yield out([(key[0], place, key[1], role, "".join(parts))])

    return map_batches(rows, work, ", ".join(types))


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, CONTROL, r"$0\\")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def render(messages: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss) of each conversation; `loss` holds the masked [start, end) spans."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = messages.select(
        "conv_id", "position", "message",
        F.concat(F.lit("<s>[INST] "), escape(role), F.lit(" [/INST]\n")).alias("head"),
        escape(text).alias("body"),
        (role == LEARNT).alias("learnt"),
        role.alias("role"), text.alias("text"),
    )
    rows = (
        turns.repartition("conv_id")
        .sortWithinPartitions("conv_id", "position", "role", "text", "message")
        .select("conv_id", "head", "body", "learnt")
    )
    kind = rows.schema["conv_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, parts, spans, length, begun = None, [], [], 0, False

        def out(done: list[tuple]) -> pa.RecordBatch:
            ids, texts, masks = zip(*done, strict=True) if done else ((), (), ())
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, id_type), pa.array(texts, pa.string()), pa.array(masks, span)],
                names=["conv_id", "formatted", "loss"],
            )

        id_type = None
        for batch in batches:
            id_type = batch.schema.field("conv_id").type
            done = []
            for owner, head, body, learnt in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not begun or owner != conv:
                    if begun:
                        done.append((conv, "".join(parts), spans))
                    conv, parts, spans, length, begun = owner, [], [], 0, True
                start = length + len(head)
                if learnt:
                    spans.append({"start": start, "end": start + len(body)})
                parts += [head, body, "</s>\n"]
                length = start + len(body) + 5
            yield out(done)
        if begun:
            yield out([(conv, "".join(parts), spans)])

    schema = f"conv_id {kind}, formatted string, loss array<struct<start: bigint, end: bigint>>"
    return map_batches(rows, work, schema)


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a formatted conversation."""
    return [(unescape(role), unescape(text)) for role, text in TURN.findall(formatted)]


def digests(rendered: DataFrame) -> DataFrame:
    """Counts and hashes of what can be read back from formatted conversations."""
    kind = rendered.schema["conv_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = {"n_turns": [], "turns_sha256": [], "loss_chars": [], "loss_sha256": [], "formatted_chars": []}
            for text, spans in zip(batch.column("formatted").to_pylist(), batch.column("loss").to_pylist(), strict=True):
                turns = parse(text)
                hashed = hashlib.sha256()
                for role, body in turns:
                    hashed.update(f"{role}\n{body}\n".encode())
                loss = "".join(unescape(text[s["start"] : s["end"]]) for s in spans)
                done["n_turns"].append(len(turns))
                done["turns_sha256"].append(hashed.hexdigest())
                done["loss_chars"].append(len(loss))
                done["loss_sha256"].append(hashlib.sha256(loss.encode()).hexdigest())
                done["formatted_chars"].append(len(text))
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), *map(pa.array, done.values())] if batch.num_rows
                else [batch.column("conv_id"), *(pa.array([], t) for t in (pa.int64(), pa.string()) * 2 + (pa.int64(),))],
                names=["conv_id", *done],
            )

    schema = (
        f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, "
        "loss_sha256 string, formatted_chars bigint"
    )
    return map_batches(rendered.select("conv_id", "formatted", "loss"), work, schema)
