"""Chat formatting: conversations rendered by a compiled template, with a loss mask."""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .templates import compile_template

#: Strings the production template may write; inside a role or text they are escaped.
CONTROLS = ("<|turn|>", "<|text|>", "<s>", "</s>", "[INST]", "[/INST]")
TEMPLATE = """\
{#- the markers of a turn; only what an assistant says is trained on -#}
{%- for turn in turns -%}
{{ "<|turn|>" }}{{ turn.role | escape }}{{ "<|text|>" }}
{%- if turn.role == "assistant" -%}
{% generation %}{{ turn.text | escape }}{% endgeneration %}
{%- else -%}
{{ turn.text | escape }}
{%- endif -%}
{{ "</s>" ~ "\\n" }}
{%- endfor -%}
"""
#: What ends a turn.
END = "</s>\n"
#: Written as read from the tables; the contract's own conversation.
PROBE = (-7, "</s>[INST] ok [/INST]")

_start = re.compile("|".join([r"\\"] + [re.escape(c[0]) + f"(?={re.escape(c[1:])})" for c in CONTROLS]))


def escape(text: str | None) -> str:
    """Reversible: no control string is left whole.

    A backslash is doubled, and one is put behind the first character of each control string.
    """
    return _start.sub(lambda m: "\\\\" if m[0] == "\\" else m[0] + "\\", text or "")


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


@functools.lru_cache(maxsize=16)
def _compiled(template: str):
    return compile_template(template, {"escape": escape})


def render(turns: Iterable[dict], template: str = TEMPLATE) -> Iterator[tuple[str, bool]]:
    """Pieces of the formatted conversation, and whether they are trained on."""
    return _compiled(template)({"turns": turns})


def read_turns(pieces: Iterable[str]) -> Iterator[tuple[str, str]]:
    """Role and text of each turn of a formatted conversation, holding one turn at a time."""
    held = ""
    for piece in pieces:
        held += piece
        if not held.endswith(END):
            continue
        for turn in held[: -len(END)].split(END):
            marker, role, text = re.fullmatch(r"(<\|turn\|>)(.*?)<\|text\|>(.*)", turn, re.S).groups()
            yield unescape(role), unescape(text)
        held = ""
    if held:
        raise ValueError("the text does not end with a turn")


FORMATTED = (
    "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


class Digest:
    """Digests of one conversation, read back from its formatted rows and their loss spans."""

    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n, self.loss_chars, self.chars = 0, 0, 0

    def read(self, rows: Iterable[tuple[str, list[dict]]]) -> tuple:
        for role, text in read_turns(self._passed(rows)):
            self.n += 1
            self.turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
        return self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars

    def _passed(self, rows: Iterable[tuple[str, list[dict]]]) -> Iterator[str]:
        """The texts, and on the way what their spans cover, with the escapes taken out."""
        for text, spans in rows:
            self.chars += len(text)
            for span in spans:
                plain = unescape(text[span["start"] : span["end"]])
                self.loss_chars += len(plain)
                self.loss.update(plain.encode("utf-8", "surrogatepass"))
            yield text


def _runs(batches: Iterable[pa.RecordBatch], columns: list[str]) -> Iterator[tuple[object, Iterator[tuple]]]:
    """Consecutive rows of one conversation, as they stream by."""
    names = ["conv_id", *columns]
    rows = (row for b in batches for row in zip(*(b.column(n).to_pylist() for n in names)))
    waiting = next(rows, None)
    while waiting is not None:
        conv = waiting[0]

        def run():
            nonlocal waiting
            while waiting is not None and waiting[0] == conv:
                row, waiting = waiting, next(rows, None)
                yield row[1:]

        own = run()
        yield conv, own
        for _ in own:  # whatever a reader left
            pass


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """All turns of a conversation in one partition, in order; ties by role and text."""
    turns = conversations.select("conv_id", "role", "text", "turn")
    return turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


SPANS = "array<struct<start:long,end:long>>"


def formatted(conversations: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """``conv_id, turn_index, formatted, loss_spans``: each turn as the template writes it.

    A span is (start, end) in code points of its row.  One row a turn, so the text of a long
    conversation is never held as one string; the rows of a conversation, in the order of
    turn_index, make up all that the template writes.

    * a row ends where a turn does; what a template writes behind the last end of a turn, or
      all of it if it ends turns in another way, is a row as well;
    * a null role or text is empty; a null conv_id is one conversation; null turns come first;
    * repeated rows are repeated turns, equal turns are ordered by role, then text;
    * a conversation for which nothing is written, and an empty table, give no rows; other
      columns are ignored.
    """

    def run(batches):
        for conv, turns in _runs(batches, ["role", "text"]):
            index, text, spans = 0, "", []
            out = []
            read = ({"role": role or "", "text": said or ""} for role, said in turns)
            for piece, generated in render(read, template):
                if generated and piece:
                    start = len(text)
                    if spans and spans[-1]["end"] == start:
                        spans[-1]["end"] += len(piece)
                    else:
                        spans.append({"start": start, "end": start + len(piece)})
                text += piece
                if text.endswith(END):
                    out.append((conv, index, text, spans))
                    index, text, spans = index + 1, "", []
                if len(out) == 256:
                    yield _batch(out)
                    out = []
            if text:
                out.append((conv, index, text, spans))
            if out:
                yield _batch(out)

    schema = f"conv_id long, turn_index long, formatted string, loss_spans {SPANS}"
    return ordered_turns(conversations).drop("turn").mapInArrow(run, schema)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    conv, index, text, spans = zip(*rows)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    return pa.RecordBatch.from_arrays(
        [pa.array(conv, pa.int64()), pa.array(index, pa.int64()), pa.array(text), pa.array(spans, kind)],
        ["conv_id", "turn_index", "formatted", "loss_spans"],
    )


def format_digests(conversations: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """One row a conversation, read back from the rows and spans of ``formatted``.

    A digest follows the order of turns, so a conversation streams through one task; the task
    holds one turn of it at a time, and long ones are spilled by the sort, not gathered.

    Nulls, repeated rows, empty tables and other columns are as in ``formatted``.  A template
    whose output does not end with a turn raises a ValueError.
    """

    def run(batches):
        out = []
        # the rows come as they were written, in the same task
        for conv, rows in _runs(batches, ["formatted", "loss_spans"]):
            out.append((conv, *Digest().read(rows)))
            if len(out) == 1024:
                yield digests(out)
                out = []
        if out:
            yield digests(out)

    def digests(rows):
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        names = ["conv_id", *(x.split()[0] for x in FORMATTED.split(", "))]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return formatted(conversations, template).mapInArrow(run, f"conv_id long, {FORMATTED}")


def with_probe(conversations: DataFrame) -> DataFrame:
    """The conversations and one whose two turns consist of control strings."""
    conv, text = PROBE
    turns = F.explode(
        F.array(
            *[
                F.struct(F.lit(i).cast("long").alias("turn"), F.lit(role).alias("role"))
                for i, role in enumerate(("user", "assistant"))
            ]
        )
    )
    probe = conversations.sparkSession.range(1).select(
        F.lit(conv).cast("long").alias("conv_id"), turns.alias("t"), F.lit(text).alias("text")
    )
    probe = probe.select("conv_id", "t.turn", "t.role", "text")
    return conversations.select("conv_id", "turn", "role", "text").unionByName(probe)
