"""Event-sourced chat reconstruction and rendering.

A log holds events of conversations: `start` opens a message (with its role), `delta` appends to it, `edit` replaces its
text, `regenerate` empties it for new deltas, `delete` removes it. Events are folded per (conversation, message) in the
order of their sequence numbers, so a conversation that holds a third of all events is spread over many tasks. Messages are
rendered one by one; only what must be read in order, the digest of a whole conversation, streams through sorted rows,
holding one message at a time.

Defined edge cases: null texts are empty; null roles are the empty role; a null conversation is a conversation of its own;
equal sequence numbers are taken by kind, then text; events before a start, or without one, make a message of the empty
role; deleted messages are left out; a conversation with no message left gives no row; an empty log gives no rows. A final
text of any length is held whole while it is rendered. Columns other than those named are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSISTANT = "assistant"


def fold(events: DataFrame) -> DataFrame:
    """Final messages (conv, message, role, text) of events (conv, message, seq, kind, role, text).

    The last edit or regenerate of each message, its first start and whether it is deleted are aggregated first, combined
    before the shuffle. Only deltas after that last reset are then collected, so an array holds one message's final pieces
    however many edits and regenerations came before. The events are read twice: give a stored table where they are dear."""
    e = F.struct("seq", F.coalesce("kind", F.lit("")).alias("kind"), F.coalesce("text", F.lit("")).alias("text"), F.coalesce("role", F.lit("")).alias("role"))
    log, kind = events.select("conv", "message", e.alias("e")), F.col("e.kind")
    facts = log.groupBy(F.col("conv").alias("_conv"), F.col("message").alias("_message")).agg(
        F.max(F.when(kind.isin("edit", "regenerate"), F.col("e"))).alias("reset"),
        F.min(F.when(kind == "start", F.col("e"))).alias("start"),
        F.max(kind == "delete").alias("gone"),
    )
    facts = facts.filter(~F.col("gone")).drop("gone")
    later = (kind == "delta") & (F.col("reset").isNull() | (F.col("e") > F.col("reset")))
    joined = log.join(facts, F.col("conv").eqNullSafe(F.col("_conv")) & F.col("message").eqNullSafe(F.col("_message")))
    folded = joined.groupBy("conv", "message").agg(
        F.first("start.role").alias("role"),
        F.first(F.when(F.col("reset.kind") == "edit", F.col("reset.text"))).alias("edited"),
        F.sort_array(F.collect_list(F.when(later, F.struct("e.seq", "e.text")))).alias("pieces"),
    )
    text = F.concat(F.coalesce("edited", F.lit("")), F.array_join(F.col("pieces.text"), ""))
    return folded.select("conv", "message", F.coalesce("role", F.lit("")).alias("role"), text.alias("text"))


# The marks of the template. A text or role holds none of them once escaped, as every < and > in it is spelt out.
OPEN, BODY, CLOSE = "<turn ", ">\n", "</turn>\n"


def escape(c: Column) -> Column:
    """Backslash, < and > as two characters each; `unescape` is its inverse."""
    out = F.replace(c, F.lit("\\"), F.lit("\\b"))
    return F.replace(F.replace(out, F.lit("<"), F.lit("\\l")), F.lit(">"), F.lit("\\g"))


def render(messages: DataFrame) -> DataFrame:
    """Messages with their `formatted` text: `<turn role>`, the escaped text, `</turn>`."""
    return messages.withColumn("formatted", F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(BODY), escape(F.col("text")), F.lit(CLOSE)))


def unescape(s: str) -> str:
    return s.replace("\\g", ">").replace("\\l", "<").replace("\\b", "\\")


def parse(formatted: str) -> list[tuple[str, str, int, int]]:
    """(role, text, start and end of the escaped text) of each turn in a formatted string."""
    out, at = [], 0
    while at < len(formatted):
        body = formatted.index(BODY, at)
        close = formatted.index(CLOSE, body)
        if not formatted.startswith(OPEN, at):
            raise ValueError("a turn does not begin with its mark")
        start = body + len(BODY)
        out.append((unescape(formatted[at + len(OPEN) : body]), unescape(formatted[start:close]), start, close))
        at = close + len(CLOSE)
    return out


class _Digest:
    """Running digest of one conversation; holds counters and hash states, no text."""

    def __init__(self) -> None:
        self.n = self.loss = self.size = 0
        self.turns, self.masked = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str) -> None:
        self.size += len(formatted)
        for role, text, _, _ in parse(formatted):
            self.n += 1
            self.turns.update(f"{role}\n{text}\n".encode())
            if role == ASSISTANT:
                self.loss += len(text)
                self.masked.update(text.encode())

    def row(self) -> tuple:
        return self.n, self.turns.hexdigest(), self.loss, self.masked.hexdigest(), self.size


DIGEST = "conv long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in DIGEST.split(", ")]
    types = [pa.string() if " string" in c else pa.int64() for c in DIGEST.split(", ")]
    key, state, done = None, None, []
    for batch in batches:
        for conv, formatted in zip(batch.column("conv").to_pylist(), batch.column("formatted").to_pylist()):
            if state is None or conv != key:
                if state is not None:
                    done.append((key, *state.row()))
                key, state = conv, _Digest()
            state.add(formatted)
        if len(done) >= 1000:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names=names)
            done = []
    if state is not None:
        done.append((key, *state.row()))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names=names)


def digests(rendered: DataFrame) -> DataFrame:
    """Per conversation, read back from the formatted turns: turns and their digest, the text under the loss mask (the
    assistant's turns) and its digest, and the length of the formatted conversation."""
    rows = rendered.select("conv", "message", "formatted").repartition(F.col("conv")).sortWithinPartitions("conv", "message")
    return rows.select("conv", "formatted").mapInArrow(_digests, DIGEST)


def as_events(conversations: DataFrame, piece: int = 4000) -> DataFrame:
    """The log that a service streaming its messages would have written for finished turns: a start and deltas of `piece`
    characters. Rows of one conversation and turn are messages of their own, in the order of role and a hash of the text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv"),
        F.struct(
            F.col("turn").cast("long").alias("turn"), role.alias("role"), F.xxhash64(text).alias("hash"), F.monotonically_increasing_id().alias("row")
        ).alias("message"),
        role.alias("role"),
        F.regexp_extract_all(text, F.lit(f"(?s).{{1,{piece}}}"), F.lit(0)).alias("parts"),
    )
    start = F.array(F.struct(F.lit(0).alias("seq"), F.lit("start").alias("kind"), F.lit("").alias("text")))
    deltas = F.transform("parts", lambda p, i: F.struct((i + 1).alias("seq"), F.lit("delta").alias("kind"), p.alias("text")))
    return rows.select("conv", "message", "role", F.inline(F.concat(start, deltas)))


def chat_format(conversations: DataFrame) -> DataFrame:
    """Digests of all conversations after reconstruction, rendering and reading back; one row per conversation."""
    return digests(render(fold(as_events(conversations)))).withColumnRenamed("conv", "conv_id")


#: The same result in DuckDB, for tables without two rows of one turn.
SQL = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
f AS (SELECT *, length(text) + len(regexp_extract_all(text, '[\\<>]')) + length(role) + len(regexp_extract_all(role, '[\\<>]')) + 16 AS size FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256, sum(size)::BIGINT AS formatted_chars
FROM f GROUP BY conv_id
"""
