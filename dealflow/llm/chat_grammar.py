"""Chat formatting with a grammar round trip.

Each turn is rendered between its role's markers, parsed again by a deterministic parser and compared with its
source.  Where they differ, because the text holds a control string or something that looks like an escaped
one, the conflicting strings get a backslash after their first character, and the turn is parsed again; a turn
that still differs raises.  The parser takes one backslash off, so any text survives.

Grammar (concatenated turns make a conversation):

    turn    = "<<SYS>>" text "<</SYS>>"   system
            | "[INST]" text "[/INST]"     user
            | "<s>" text "</s>"           assistant, its text under the loss mask
            | "[ROLE:" name "]" text "[/ROLE]"   any other role, name percent-encoded
    text    = any characters that hold no control string

A turn ends with its own closing marker and begins with its own opening one, so turns don't run into each
other and the parser needs no look-ahead past a marker.

Rendering needs no shuffle and no more memory than a turn.  Reading back deals turns out by conversation,
sorted inside the task, and streams them through running digests, so a conversation of any length takes the
memory of one turn; its digest is sequential by definition and stays in one task.

Defined cases: a null text is an empty one and a null role the empty role; rows of equal conversation and turn
follow each other by role and text; a null conversation is one of its own, a null turn comes first; repeated
rows are repeated turns; empty tables give no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MARKERS = {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")}
ROLE_OF = {pair[0]: role for role, pair in MARKERS.items()}
LOSS_ROLE = "assistant"

_TAILS = r"(?:s>|/s>|<SYS>>|</SYS>>|INST\]|/INST\]|ROLE:[A-Za-z0-9_.~%-]*\]|/ROLE\])"
CONTROL = re.compile(rf"[<\[]{_TAILS}")
ESCAPABLE = re.compile(rf"([<\[])(\\*{_TAILS})")
ESCAPED = re.compile(rf"([<\[])\\(\\*{_TAILS})")


class GrammarError(ValueError):
    """Text that the grammar does not derive."""


def escape(text: str) -> str:
    return ESCAPABLE.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1\2", text)


def _markers(role: str) -> tuple[str, str]:
    return MARKERS.get(role) or (f"[ROLE:{quote(role, safe='')}]", "[/ROLE]")


def parse(rendered: str) -> list[tuple[str, str, int, int]]:
    """Turns of a rendered conversation: role, source text, and where the text lies in ``rendered``."""
    turns, at = [], 0
    while at < len(rendered):
        begin = CONTROL.match(rendered, at)
        if not begin:
            raise GrammarError(f"no turn begins at {at}")
        mark = begin[0]
        if (role := ROLE_OF.get(mark)) is None:
            if not mark.startswith("[ROLE:"):
                raise GrammarError(f"{mark} begins no turn")
            role = unquote(mark[6:-1])
        end = CONTROL.search(rendered, begin.end())
        if not end or end[0] != _markers(role)[1]:
            raise GrammarError(f"the turn at {at} does not end")
        turns.append((role, unescape(rendered[begin.end():end.start()]), begin.end(), end.start()))
        at = end.end()
    return turns


def _comes_back(rendered: str, role: str, text: str) -> bool:
    try:
        return [t[:2] for t in parse(rendered)] == [(role, text)]
    except GrammarError:
        return False


def render(role: str, text: str) -> tuple[str, int, int]:
    """A turn's rendering and where its text lies in it."""
    begin, end = _markers(role)
    for body in (text, escape(text)):
        rendered = begin + body + end
        if _comes_back(rendered, role, text):
            return rendered, len(begin), len(begin) + len(body)
    raise GrammarError(f"a turn of role {role!r} does not survive its round trip")


def format_turns(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text") -> DataFrame:
    """``(conv_id, turn, rendered, loss_start, loss_end)`` of each row: its part of the formatted conversation and
    the part's characters under the loss mask (an empty range where the role learns nothing)."""
    schema = T.StructType([
        T.StructField("conv_id", turns.schema[conv_col].dataType), T.StructField("turn", turns.schema[turn_col].dataType),
        T.StructField("rendered", T.StringType()), T.StructField("loss_start", T.LongType()),
        T.StructField("loss_end", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out, start, end = [], [], []
            for role, text in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                rendered, a, z = render(role or "", text or "")
                out.append(rendered)
                start.append(a)
                end.append(z if role == LOSS_ROLE else a)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(out, pa.string()), pa.array(start, pa.int64()),
                 pa.array(end, pa.int64())], names=schema.names)

    return turns.select(conv_col, turn_col, role_col, text_col).mapInArrow(run, schema)


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation, parsed from the formatted output: ``n_turns``, ``turns_sha256``, ``loss_chars``,
    ``loss_sha256`` and ``formatted_chars``."""
    schema = T.StructType([formatted.schema["conv_id"]] + [
        T.StructField("n_turns", T.LongType()), T.StructField("turns_sha256", T.StringType()),
        T.StructField("loss_chars", T.LongType()), T.StructField("loss_sha256", T.StringType()),
        T.StructField("formatted_chars", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none, id_type = object(), pa.null()
        conv, n, every, chars, loss, size = none, 0, hashlib.sha256(), 0, hashlib.sha256(), 0
        for b in batches:
            done: list[tuple] = []
            id_type = b.column(0).type
            columns = (b.column(i).to_pylist() for i in range(4))
            for c, rendered, a, z in zip(*columns):
                if c != conv or conv is none:
                    if conv is not none:
                        done.append((conv, n, every.hexdigest(), chars, loss.hexdigest(), size))
                    conv, n, every, chars, loss, size = c, 0, hashlib.sha256(), 0, hashlib.sha256(), 0
                for role, text, _, _ in parse(rendered):
                    n += 1
                    every.update(f"{role}\n{text}\n".encode())
                learned = unescape(rendered[a:z])
                chars += len(learned)
                loss.update(learned.encode())
                size += len(rendered)
            yield _batch(done, id_type, schema.names)
        if conv is not none:
            yield _batch([(conv, n, every.hexdigest(), chars, loss.hexdigest(), size)], id_type, schema.names)

    rows = formatted.repartition(F.col("conv_id")).sortWithinPartitions("conv_id", "turn", "rendered")
    return rows.select("conv_id", "rendered", "loss_start", "loss_end").mapInArrow(run, schema)


def _batch(rows: list[tuple], id_type: pa.DataType, names: list[str]) -> pa.RecordBatch:
    kinds = [id_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    cols = list(zip(*rows)) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)
