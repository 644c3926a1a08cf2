"""Chat formatting in budgeted windows with a loss mask.

Template: each turn is ``<s>[role]\\n`` text ``</s>\\n``, with role and text escaped. The backslash is the
escape: it is doubled, and every control string inside a text gets one after its first character. So no
escaped text holds a control string, none can open or close a turn, and unescaping gives the text back exactly.

Windows: a conversation whose turns fit the budget is one window. Else prefix sums of turn tokens choose
turn-aligned spans: each window repeats the leading system turn, then up to ``history`` tokens of the turns
just before its span (whole turns, context only), then new turns as long as they fit. A turn larger than
what is left of the budget has a window of its own with no history, uncut. Each assistant text is a
target (loss mask) in exactly one window; repeats of it as history are masked out.

Tokens are counted by a public vocabulary that never joins across white space, so a window's tokens are the sum of
its turns'. Turns stream: a task holds one window and the history, however long a conversation is. Its digests
are hashes of all its text in order, so one conversation is one task's work, but never one task's memory.
"""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, lean
from .packing import chunk_ids, default_tokenizer

OPEN, CLOSE, END = "<s>[", "]\n", "</s>\n"
#: Control strings; each is broken by an escape wherever a text holds it.
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|")
#: Tokens of a window, and of the history in it.
BUDGET, HISTORY = 1024, 256
YIELD_CHARS = 4 << 20

_ESCAPE = re.compile(r"\\|" + "|".join(re.escape(c) for c in sorted(CONTROL, key=len, reverse=True)))
_UNESCAPE = re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"<s>\[((?:[^\\\]]|\\.)*)\]\n((?:[^\\<]|\\.|<(?!/s>))*)</s>\n", re.S)


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def escape_role(role: str) -> str:
    return escape(role).replace("]", "\\]")


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


def windows(
    turns: Iterable[tuple[str, str, int]], budget: int = BUDGET, history: int = HISTORY
) -> Iterator[tuple[str, list[tuple[int, int]], list[int]]]:
    """(formatted text, loss spans in it, turn numbers) of each window of the turns (role, text, tokens); a turn is new
    in one window alone."""
    system: list[tuple] = []
    recent: deque = deque()  # the turns before the window, as far as the history budget goes
    context, new, used = [], [], 0

    def made():
        parts, spans, at = [], [], 0
        for k, role, head, body, _ in [*system, *context, *new]:
            if new and k >= new[0][0] and role == "assistant":
                spans.append((at + len(head), at + len(head) + len(body)))
            parts.append(head + body + END)
            at += len(parts[-1])
        return "".join(parts), spans, [t[0] for t in [*system, *context, *new]]

    for k, (role, text, tokens) in enumerate(turns):
        turn = (k, role, OPEN + escape_role(role) + CLOSE, escape(text), tokens)
        if k == 0 and role == "system":
            system.append(turn)
            continue
        if new and used + tokens > budget:
            yield made()
            recent.extend(new)
            total = sum(t[4] for t in recent)
            while recent and total > history:
                total -= recent.popleft()[4]
            new = []
        if not new:
            fixed = sum(t[4] for t in system)
            room, context = max(0, budget - fixed - tokens), list(recent)
            total, skip = sum(t[4] for t in context), 0
            while total > room:
                total, skip = total - context[skip][4], skip + 1
            context, used = context[skip:], fixed + total
        new.append(turn)
        used += tokens
    if new or system and not recent:
        yield made()


def formatted_turn(role: str, text: str) -> str:
    return OPEN + escape_role(role) + CLOSE + escape(text) + END


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The turns of a window."""
    out, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError("not a formatted conversation")
        out.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return out


_WINDOW = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("window", pa.int32()),
        ("turns", pa.list_(pa.int32())),
        ("formatted", pa.string()),
        ("loss_spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
    ]
)
_WINDOW_SQL = "conv_id long, window int, turns array<int>, formatted string, loss_spans array<struct<start:int,end:int>>"


def format_conversations(
    conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY, tokenizer: str | None = None
) -> DataFrame:
    """``conv_id, window, turns array<int>, formatted, loss_spans array<struct<start,end>>``.

    Rows of one conversation are ordered by (turn, role, text); a null turn comes first, a null role or text
    is empty; rows of null conv_id are one conversation. Equal turn numbers are all kept. A conversation streams
    through one sorted partition. An empty table gives no window. Other columns are ignored. Sizes are tokens of
    the vocabulary at the path ``tokenizer``; without one, characters.
    """
    bounded_batches(conversations.sparkSession)
    columns = ["conv_id", "turn", "role", "text"]
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("role", "text")]
    )
    rows = rows.repartition("conv_id").sortWithinPartitions(*columns)

    def sizes(turns: list[str]) -> list[int]:
        return [len(t) // 4 for t in chunk_ids(tokenizer).texts([t.encode() for t in turns])] if tokenizer else [len(t) for t in turns]

    def turns(batches):
        for batch in batches:
            conv, _, role, text = (c.to_pylist() for c in batch.columns)
            yield from zip(conv, role, text, sizes([formatted_turn(r, t) for r, t in zip(role, text)]))

    def step(batches):
        out, size = [], 0
        for conv, rows_of in groupby(turns(batches), key=lambda r: r[0]):
            for k, (text, spans, members) in enumerate(windows((r[1:] for r in rows_of), budget, history)):
                out.append((conv, k, members, text, [{"start": a, "end": b} for a, b in spans]))
                size += len(text)
                if size > YIELD_CHARS:
                    yield _rows(out, _WINDOW)
                    out, size = [], 0
        if out:
            yield _rows(out, _WINDOW)

    return rows.mapInArrow(lean(step), _WINDOW_SQL)


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


_DIGEST = pa.schema(
    [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
)


def digests(windows_df: DataFrame) -> DataFrame:
    """Per conversation, from the windows alone: digests of all turns and of everything under the loss mask."""
    rows = windows_df.repartition("conv_id").sortWithinPartitions("conv_id", "window")

    def window_rows(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                yield tuple(c[k].as_py() for c in batch.columns)

    def step(batches):
        out = []
        for conv, rows_of in groupby(window_rows(batches), key=lambda r: r[0]):
            seen, n, chars, total = -1, 0, 0, 0
            turns, loss = hashlib.sha256(), hashlib.sha256()
            for _, _, members, formatted, spans in rows_of:
                for k, (role, text) in zip(members, read_back(formatted)):
                    if k > seen:
                        seen, n = k, n + 1
                        turns.update(f"{role}\n{text}\n".encode())
                for span in spans:
                    text = unescape(formatted[span["start"] : span["end"]])
                    chars += len(text)
                    loss.update(text.encode())
                total += len(formatted)
            out.append((conv, n, turns.hexdigest(), chars, loss.hexdigest(), total))
            if len(out) >= 5000:
                yield _rows(out, _DIGEST)
                out = []
        if out:
            yield _rows(out, _DIGEST)

    return rows.mapInArrow(
        lean(step),
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )


def op10_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -1, formatted and read back."""
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    probe = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", probe), (-1, 1, "assistant", probe)], table.schema)
    return digests(format_conversations(table.union(extra), tokenizer=default_tokenizer()))
