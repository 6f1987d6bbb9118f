"""Chat formatting with loss masks found by rendering, not by knowing the template."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A turn's role and text.
Turn = tuple[str, str]
#: Renders a conversation's turns as one text. Spans are found from what it returns alone.
Template = Callable[[list[Turn]], str]

#: Turns before the one that is rendered, next to the first, for a template whose attribute `context` says they suffice.
CONTEXT = 8
#: Stands for a text to find where it goes; the template must not change or drop it.
PROBE = "probe"


def escape(text: str) -> str:
    """No control string is left in the text: each begins with a sign that is spelled out."""
    return text.replace("\\", "\\\\").replace("<", "\\l").replace(">", "\\g")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: {"l": "<", "g": ">"}.get(m[1], m[1]), text, flags=re.S)


def turns(conversation: list[Turn]) -> str:
    """The template: <turn role>text</turn>."""
    return "".join(f"<turn {escape(role)}>{escape(text)}</turn>\n" for role, text in conversation)


turns.context = CONTEXT  # it depends on none


TURN = re.compile(r"<turn ([^<>]*)>([^<>]*)</turn>\n")


def read_turns(formatted: str) -> list[Turn]:
    """The turns of a text that `turns` made; anything else in it is an error."""
    out, at = [], 0
    for m in TURN.finditer(formatted):
        if m.start() != at:
            break
        out.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    if at != len(formatted):
        raise ValueError(f"no turn at {at}")
    return out


class Incremental:
    """Renders a conversation turn by turn and compares successive prefixes.

    All turns stay and each prefix is rendered whole, which takes a long conversation's memory, and time with its square.
    Only where the template's attribute `context` declares that it depends on no more than the first turn and so many
    last ones do those alone stay, so that memory and time for a turn don't grow.
    """

    def __init__(self, template: Template, context: int | None = None):
        self.template, self.context = template, getattr(template, "context", None) if context is None else context
        self.seen: list[Turn] = []

    def add(self, role: str, text: str) -> tuple[str, int, int, bool]:
        """(chunk, start, end, rewrites): what the turn adds, where its text is in it, and whether the template changed
        what it had rendered before; then the chunk is what follows the part that stayed."""
        before = self.template(self.seen)
        after = self.template([*self.seen, (role, text)])
        rewrites = not after.startswith(before)
        at = len(before)
        if rewrites:
            at = next((i for i, (a, b) in enumerate(zip(before, after)) if a != b), min(len(before), len(after)))
        chunk = after[at:]
        probed = self.template([*self.seen, (role, PROBE)])
        start = probed.find(PROBE, at) - at
        tail = len(probed) - (start + at + len(PROBE))
        known = start >= 0 and after[:at] == probed[:at] and len(chunk) - tail >= start
        self.seen = [*self.seen, (role, text)]
        if self.context is not None and len(self.seen) > self.context + 1:
            self.seen = [self.seen[0], *self.seen[-self.context :]]
        return (chunk, start, len(chunk) - tail, rewrites) if known else (chunk, 0, 0, rewrites)


ROWS = "conv_id long, place long, role string, chunk string, start long, end long, loss boolean, rewrites boolean"


def format_turns(conversations: DataFrame, template: Template = turns, learn: str = "assistant") -> DataFrame:
    """(conv_id, place, role, chunk, start, end, loss, rewrites): a row for each turn, in order within partitions.

    A conversation's chunks, joined, are its formatted text. Loss falls on chunk[start:end] where loss is true: the texts
    of role `learn`. rewrites is true from the turn on at which the template changed what it had rendered before, and no
    loss falls on such turns. A conversation's rows go to one partition, sorted on disk if need be, and are read one by
    one: no conversation is held whole, unless the template declares no context. Turns come by number, nulls first, and rows of one number by role and text; null
    roles and texts are empty; rows without conv_id are one conversation; repeated rows are turns of their own; an empty
    table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, place, broken = object(), None, 0, False
        for b in batches:
            out: list[tuple] = []
            for conv, role, text in zip(*(b.column(i).to_pylist() for i in (0, 2, 3))):
                if conv != now:
                    now, state, place, broken = conv, Incremental(template), 0, False
                chunk, start, end, rewrites = state.add(role, text)
                broken |= rewrites
                out.append((conv, place, role, chunk, start, end, role == learn and not broken, broken))
                place += 1
            columns = list(zip(*out)) or [()] * 8
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_()))], names=[x.split()[0] for x in ROWS.split(", ")])

    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(run, ROWS)


DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, rewrites boolean"


def digest(formatted: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, rewrites): a row for each conversation
    of format_turns with the template `turns`, read back from the formatted chunks in their order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, n, all_text, loss, lost, chars, broken, first = None, 0, sha256(), sha256(), 0, 0, False, True
        done: list[tuple] = []

        def close():
            done.append((now, n, all_text.hexdigest(), lost, loss.hexdigest(), chars, broken))

        for b in batches:
            for conv, chunk, start, end, learn, rewrites in zip(*(b.column(i).to_pylist() for i in (0, 3, 4, 5, 6, 7))):
                if first or conv != now:
                    if not first:
                        close()
                    now, n, all_text, loss, lost, chars, broken, first = conv, 0, sha256(), sha256(), 0, 0, False, False
                for role, text in read_turns(chunk):
                    n += 1
                    all_text.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                if learn:
                    text = unescape(chunk[start:end])
                    lost += len(text)
                    loss.update(text.encode("utf-8", "surrogatepass"))
                chars += len(chunk)
                broken |= rewrites
            yield rows(done)
            done.clear()
        if not first:
            close()
            yield rows(done)

    def rows(found: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*found)) or [()] * 7
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()))], names=[x.split()[0] for x in DIGEST.split(", ")])

    return formatted.mapInArrow(run, DIGEST)
