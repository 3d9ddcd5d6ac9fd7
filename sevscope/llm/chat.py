"""Chat formatting with a compiled template.

Rows are dealt by conversation and sorted by turn in their partition; a task then renders one
conversation after the other as a stream of pieces, so memory holds one turn, however long the
conversation. The template marks turns with control strings; these are escaped in roles and texts
in a way that ``unescape`` undoes, so the output reads back to the same turns.

Defined results: a NULL role or text counts as empty; rows of equal turn go by role, then text;
repeated rows are turns of their own; rows with a NULL turn come first; rows without conv_id form
one conversation; an empty table gives an empty result; other columns are not read.
"""
from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import pick
from .template import compile_template

START, END = "<|im_start|>", "<|im_end|>"
TEMPLATE = (
    "{% set open = '" + START + "' %}{% set close = '" + END + "' %}"
    "{% for m in messages %}{{ open }}{{ m.role | line }}{{ '\\n' }}"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | safe }}{% endgeneration %}{% else %}{{ m.text | safe }}{% endif %}"
    "{{ close ~ '\\n' }}{% endfor %}")
BACK = {"amp;": "&", "lt;": "<", "#10;": "\n"}


def safe(text: str) -> str:
    """``text`` without control strings."""
    return text.replace("&", "&amp;").replace("<|", "&lt;|")


def line(text: str) -> str:
    """The same, on one line."""
    return safe(text).replace("\n", "&#10;")


def unescape(text: str) -> str:
    return re.sub("&(amp;|lt;|#10;)", lambda m: BACK[m[1]], text)


FILTERS = {"safe": safe, "line": line}


def read_back(pieces: Iterable[tuple[str, bool]]) -> Iterator[tuple[str, str, str, int]]:
    """(role, text, text under the loss mask, length) of every turn of a rendering."""
    held, mask, size = [], [], 0
    for text, marked in pieces:
        held.append(text)
        size += len(text)
        if marked:
            mask.append(text)
        if text.endswith(END + "\n"):
            role, _, body = "".join(held).removeprefix(START).removesuffix(END + "\n").partition("\n")
            yield unescape(role), unescape(body), unescape("".join(mask)), size
            held, mask, size = [], [], 0
    if held:
        raise ValueError("the rendering ends inside a turn")


def render(messages: Iterable[dict], template: str = TEMPLATE) -> str:
    """The whole rendering of one conversation."""
    return "".join(text for text, _ in compile_template(template, FILTERS)(messages))


def _by_conversation(rows: DataFrame) -> DataFrame:
    r = pick(rows, "conv_id", "turn", "role", "text").select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return r.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, Iterator[dict]]]:
    """(conv_id, messages), across the borders of batches; messages are read once."""
    rows = ((c, {"role": r, "text": t}) for b in batches
            for c, r, t in zip(*(b.column(b.schema.get_field_index(n)).to_pylist() for n in ("conv_id", "role", "text"))))
    for conv, own in itertools.groupby(rows, lambda x: x[0]):
        yield conv, (m for _, m in own)


def _turns(pieces: Iterable[tuple[str, bool]]) -> Iterator[tuple[str, str]]:
    """(text, text under the loss mask) of every turn of a rendering, cut behind the turns' ends; what
    follows the last end belongs to the last turn."""
    done, held, mask, tail = None, [], [], ""
    for text, marked in pieces:
        held.append(text)
        if marked:
            mask.append(text)
        tail = (tail + text)[-len(END + "\n"):]
        if tail == END + "\n":
            if done:
                yield done
            done, held, mask, tail = ("".join(held), "".join(mask)), [], [], ""
    if done:
        yield done[0] + "".join(held), done[1] + "".join(mask)
    elif held:
        yield "".join(held), "".join(mask)


def format_conversations(rows: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """(conv_id, nth, text, loss_text): the rendering of every turn, in order; together they are the rendering
    of the whole conversation. Turns end where a piece of the template ends with ``END`` and a newline, so a
    template without gives one row a conversation."""
    kind = rows.schema["conv_id"].dataType.simpleString()

    def write(batches):
        draw = compile_template(template, FILTERS)
        for conv, messages in _conversations(batches):
            for n, (text, loss) in enumerate(_turns(draw(messages))):
                yield pa.RecordBatch.from_pylist([{"conv_id": conv, "nth": n, "text": text, "loss_text": loss}], schema=schema)
    schema = pa.schema([("conv_id", to_arrow_type(rows.schema["conv_id"].dataType)),
                        ("nth", pa.int64()), ("text", pa.string()), ("loss_text", pa.string())])
    return _by_conversation(rows).mapInArrow(write, f"conv_id {kind}, nth long, text string, loss_text string")


def digest(rows: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """One row per conversation, read back from its rendering: conv_id, n_turns, turns_sha256,
    loss_chars, loss_sha256, formatted_chars."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    columns = ["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def read(batches):
        draw = compile_template(template, FILTERS)
        out = []
        for conv, messages in _conversations(batches):
            turns, loss, n, chars, size = hashlib.sha256(), hashlib.sha256(), 0, 0, 0
            for role, text, marked, length in read_back(draw(messages)):
                turns.update(f"{role}\n{text}\n".encode())
                loss.update(marked.encode())
                n, chars, size = n + 1, chars + len(marked), size + length
            out.append((conv, n, turns.hexdigest(), chars, loss.hexdigest(), size))
            if len(out) == 1000:
                yield batch(out)
                out = []
        if out:
            yield batch(out)

    def batch(out):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=["conv_id", *columns])
    types = [to_arrow_type(rows.schema["conv_id"].dataType), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    return _by_conversation(rows).mapInArrow(
        read, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
