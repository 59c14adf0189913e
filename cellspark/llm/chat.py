"""Chat formatting by token-level assembly.

The template renders a turn as ``### <role>: <text> </turn>\\n``.  Its three
control strings are single reserved ids past the vocabulary, so a formatted
conversation is assembled from separately encoded segments:

    [TURN] ids(role) [SAYS] ids(text) [END]   for every turn, in order

Control strings that occur in a role or text are escaped with a backslash (as
are backslashes), which is reversible, and the tokenizer's own special strings
are encoded as ordinary text; a reserved id therefore only ever comes from the
template.  Token offsets of turns and of the loss mask are prefix sums of
segment lengths.

A formatted conversation is one row per turn (its ids, where they begin in the
conversation, and the loss span), never one array per conversation: a
conversation of any length needs no more memory than its longest turn.

Defined results: turns are ordered by ``turn``, then role, then text (nulls
first); a null text or role is empty; a null conversation id is a conversation
of its own; repeated rows are repeated turns; an empty table gives no rows;
other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import coder

#: Control strings of the template, rendered form of the reserved ids.
TURN, SAYS, END = "### ", ": ", " </turn>\n"
#: Control strings (without their blanks) and the escape sign.
_ESCAPE = re.compile(r"\\|###|</turn>")
_UNESCAPE = re.compile(r"\\(\\|###|</turn>)")
_ROLE_ESCAPE = re.compile(r"\\|###|</turn>|:")
_ROLE_UNESCAPE = re.compile(r"\\(\\|###|</turn>|:)")


def escape(text: str) -> str:
    return _ESCAPE.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


def reserved(path: str) -> tuple[int, int, int]:
    """The reserved ids: the three after the vocabulary."""
    n = len(coder(path).bytes_of)
    return n, n + 1, n + 2


def format_turns(conversations: DataFrame, path: str, loss_role: str = "assistant") -> DataFrame:
    """One row per turn: conv_id, seq (from 0), ids array<int>, token_start (of
    the turn in its conversation), loss_start and loss_end (token span of the
    turn's text in the conversation, empty unless the role is ``loss_role``)."""

    @F.arrow_udf("struct<ids:array<int>,head:int,body:int>")
    def assembled(roles: pa.Array, texts: pa.Array) -> pa.Array:
        c = coder(path)
        turn, says, end = reserved(path)
        out = []
        heads = c.encode_all([_ROLE_ESCAPE.sub(r"\\\g<0>", r) for r in roles.to_pylist()], added=False)
        bodies = c.encode_all([escape(t) for t in texts.to_pylist()], added=False)
        for head, body in zip(heads, bodies, strict=True):
            out.append({"ids": [turn, *head, says, *body, end], "head": len(head) + 2, "body": len(body)})
        return pa.array(out, pa.struct([("ids", pa.list_(pa.int32())), ("head", pa.int32()), ("body", pa.int32())]))

    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                                F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("t", assembled("role", "text"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    size = F.size("t.ids").cast("long")
    rows = (rows.withColumn("seq", F.row_number().over(order).cast("long") - 1)
            .withColumn("token_start", F.sum(size).over(order.rowsBetween(Window.unboundedPreceding, 0)) - size))
    loss = F.col("token_start") + F.col("t.head")
    return rows.select("conv_id", "seq", F.col("t.ids").alias("ids"), "token_start", loss.alias("loss_start"),
                       (loss + F.when(F.col("role") == loss_role, F.col("t.body")).otherwise(0)).alias("loss_end"))


def read_turns(formatted: DataFrame, path: str) -> DataFrame:
    """Read formatted turns back from their ids and masks alone: conv_id, seq,
    role, text, loss_text (text under the loss mask, unescaped) and
    formatted_chars (code points of the rendered turn)."""

    @F.arrow_udf("struct<role:string,text:string,loss_text:string,formatted_chars:bigint>")
    def parsed(ids: pa.Array, begin: pa.Array, loss_from: pa.Array, loss_to: pa.Array) -> pa.Array:
        c = coder(path)
        turn, says, end = reserved(path)
        out = []
        for row, at, a, b in zip(ids.to_pylist(), begin.to_pylist(), loss_from.to_pylist(), loss_to.to_pylist(), strict=True):
            if row[0] != turn or row[-1] != end:
                raise ValueError("not a formatted turn")
            cut = row.index(says)
            role, text = c.decode(row[1:cut]), c.decode(row[cut + 1:-1])
            out.append({"role": _ROLE_UNESCAPE.sub(r"\1", role), "text": unescape(text),
                        "loss_text": unescape(c.decode(row[a - at:b - at])),
                        "formatted_chars": len(TURN) + len(role) + len(SAYS) + len(text) + len(END)})
        return pa.array(out, pa.struct([("role", pa.string()), ("text", pa.string()), ("loss_text", pa.string()),
                                        ("formatted_chars", pa.int64())]))

    rows = formatted.withColumn("r", parsed("ids", "token_start", "loss_start", "loss_end"))
    return rows.select("conv_id", "seq", "r.*")


def digests(turns: DataFrame) -> DataFrame:
    """Per conversation: n_turns, turns_sha256 (of role, \\n, text, \\n per turn),
    loss_chars, loss_sha256 and formatted_chars.  Rows are sorted within
    partitions and hashed as they stream by, so no conversation is held whole."""
    fields = [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
              ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]

    def stream(batches):
        key, n, chars, total, turns_hash, loss_hash = object(), 0, 0, 0, None, None

        def closed():
            return key, n, turns_hash.hexdigest(), chars, loss_hash.hexdigest(), total

        for batch in batches:
            done = []
            for conv, role, text, loss, size in zip(*(batch.column(c).to_pylist() for c in
                                                      ("conv_id", "role", "text", "loss_text", "formatted_chars")), strict=True):
                if turns_hash is None or conv != key:
                    if turns_hash is not None:
                        done.append(closed())
                    key, n, chars, total, turns_hash, loss_hash = conv, 0, 0, 0, hashlib.sha256(), hashlib.sha256()
                n, chars, total = n + 1, chars + len(loss), total + size
                turns_hash.update(f"{role}\n{text}\n".encode())
                loss_hash.update(loss.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*done), fields, strict=True)],
                                                 names=[f for f, _ in fields])
        if turns_hash is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, (_, t) in zip(closed(), fields, strict=True)],
                                             names=[f for f, _ in fields])

    return (turns.repartition("conv_id").sortWithinPartitions("conv_id", "seq")
            .mapInArrow(stream, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                "loss_sha256 string, formatted_chars long"))
