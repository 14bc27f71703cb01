"""Chat formatting: a template, a machine over roles, segments with loss flags, and the way back.

The template is data: what stands before and behind a turn, and which roles carry loss. A
finite-state machine over roles says after every turn whether the order so far is one that the
template allows; every conversation is formatted, and the verdict goes with its turns. Control
strings inside texts and roles are escaped by one more backslash behind ``<``, which unescaping
takes away again, so any text comes back as it was.

Rows are dealt out by conversation and sorted by turn; a task streams over them and holds the
state of one conversation, never its rows, so that a conversation of any length is formatted
in chunks. Order within a conversation: turn (null first), role, text.

Results: null text or role is empty; an unknown role is formatted without loss and makes the
order invalid; repeated rows are turns of their own; a null conv_id is a conversation of its
own; an empty table gives no rows; further columns are left behind.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.common import exact, longs
from granary.session import durable


@dataclass(frozen=True)
class Template:
    """Turns are ``open`` role ``middle`` text ``close``; ``loss`` has the roles under the loss mask.

    ``moves``: state -> role -> next state, from ``start``; orders end well in a state of ``ends``.
    """

    open: str = "<|im_start|>"
    middle: str = "\n"
    close: str = "<|im_end|>\n"
    loss: frozenset = frozenset({"assistant"})
    start: str = "begin"
    ends: frozenset = frozenset({"answered", "asked"})
    moves: dict = field(
        default_factory=lambda: {
            "begin": {"system": "told", "user": "asked"},
            "told": {"user": "asked"},
            "asked": {"assistant": "answered"},
            "answered": {"user": "asked"},
        }
    )


CHATML = Template()
CHUNK_CHARS = 1 << 20
_CONTROL, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
CHUNKS = "conv_id long, chunk long, formatted string, segments array<struct<start:int,end:int,loss:boolean>>, state string"
INVALID = "invalid"


def escape(text: str) -> str:
    return _CONTROL.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    """Roles stand on a line of their own, so line ends in them are escaped as well."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def _by_conversation(df: DataFrame, *order: str) -> DataFrame:
    """Dealt out by conversation; the null conversation is that of key 0 and not known."""
    keys = ("conv_id_known", "conv_id")
    return df.select(*exact("conv_id"), *[c for c in df.columns if c != "conv_id"]).repartition(*keys).sortWithinPartitions(*keys, *order)


def format_conversations(turns: DataFrame, template: Template = CHATML) -> DataFrame:
    """Chunks of every conversation: formatted text, text segments with loss flags, and the state reached."""

    def chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        done: list[tuple] = []
        key, number, text, length, segments, state = None, 0, [], 0, [], template.start
        for batch in batches:
            for conv, known, role, said in zip(batch["conv_id"], batch["conv_id_known"], batch["role"], batch["text"]):
                conv = int(conv) if known else None
                if text and (conv != key or length >= CHUNK_CHARS):
                    done.append((key, number, "".join(text), segments, state))
                    text, length, segments, number = [], 0, [], number + 1
                if conv != key:
                    number, state = 0, template.start
                key = conv
                state = template.moves.get(state, {}).get(role, INVALID)
                head = template.open + escape_role(role) + template.middle
                body = escape(said)
                start = length + len(head)
                segments.append({"start": start, "end": start + len(body), "loss": role in template.loss})
                text += [head, body, template.close]
                length = start + len(body) + len(template.close)
            if done:
                yield _frame(done)
                done = []
        if text:
            yield _frame([(key, number, "".join(text), segments, state)])

    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return _by_conversation(rows, "turn", "role", "text").mapInPandas(chunks, CHUNKS)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["conv_id", "chunk", "formatted", "segments", "state"])
    return out.assign(conv_id=longs(x[0] for x in rows))


def turns_of(formatted: str, template: Template = CHATML) -> Iterator[tuple[str, str]]:
    """(role, text) of every turn, found by the control strings alone."""
    for part in formatted.split(template.open)[1:]:
        if not part.endswith(template.close):
            raise ValueError("a turn without an end")
        role, _, text = part[: -len(template.close)].partition(template.middle)
        yield unescape_role(role), unescape(text)


DIGEST = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid boolean"
)


def digest(formatted: DataFrame, template: Template = CHATML) -> DataFrame:
    """Per conversation, from the chunks alone: turns, text under the loss mask, and the order's verdict."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, done = None, []
        for batch in batches:
            columns = (batch[c] for c in ("conv_id", "conv_id_known", "formatted", "segments", "state"))
            for conv, known, text, segments, state in zip(*columns):
                conv = int(conv) if known else None
                if now is None or now["conv_id"] != conv:
                    if now:
                        done.append(_closed(now))
                    now = {"conv_id": conv, "n": 0, "turns": hashlib.sha256(), "chars": 0, "loss": hashlib.sha256(), "all": 0}
                for role, said in turns_of(text, template):
                    now["n"] += 1
                    now["turns"].update(f"{role}\n{said}\n".encode())
                for s in segments:
                    if s["loss"]:
                        said = unescape(text[s["start"] : s["end"]])
                        now["chars"] += len(said)
                        now["loss"].update(said.encode())
                now["all"] += len(text)
                now["valid"] = state in template.ends
            if done:
                yield _rows(done)
                done = []
        if now:
            yield _rows([_closed(now)])

    return _by_conversation(formatted, "chunk").mapInPandas(rows, DIGEST)


def _closed(x: dict) -> tuple:
    return x["conv_id"], x["n"], x["turns"].hexdigest(), x["chars"], x["loss"].hexdigest(), x["all"], x["valid"]


def _rows(done: list[tuple]) -> pd.DataFrame:
    names = [x.split()[0] for x in DIGEST.split(", ")]
    return pd.DataFrame(done, columns=names).assign(conv_id=longs(x[0] for x in done))


def round_trip(turns: DataFrame, template: Template = CHATML) -> DataFrame:
    """Format all conversations into the shared folder and digest what was written."""
    return digest(durable(format_conversations(turns, template)), template)
