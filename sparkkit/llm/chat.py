"""Chat formatting by incremental rendering of a black-box template."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkkit.llm.common import small_batches

Turn = tuple[str, str]  # role, text
Template = Callable[[list[Turn]], str]
#: Stands for a turn's text while its place is looked for.
PROBE = "\x02probe\x03"

_CONTROL = re.compile(r"\\|</?s>|\[/?INST\]|<</?SYS>>|\[/?ROLE\]")
_TURN = re.compile(
    r"<<SYS>>\n(?P<system>.*?)\n<</SYS>>\n\n"
    r"|<s>\[INST\] (?P<user>.*?) \[/INST\]"
    r"|\[ROLE\] (?P<role>(?:[^\\\n]|\\.)*)\n(?P<other>.*?) \[/ROLE\]"
    r"| (?P<assistant>.*?) </s>",
    re.DOTALL,
)


def escape(text: str) -> str:
    """Backslashes doubled, and one put into each control string, which then no longer is one."""
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def inst_template(turns: list[Turn]) -> str:
    """Turns between [INST] marks; roles besides system, user and assistant are named in the turn."""
    out = []
    for role, text in turns:
        text = escape(text)
        if role == "system":
            out.append(f"<<SYS>>\n{text}\n<</SYS>>\n\n")
        elif role == "user":
            out.append(f"<s>[INST] {text} [/INST]")
        elif role == "assistant":
            out.append(f" {text} </s>")
        else:
            out.append(f"[ROLE] {escape(role).replace(chr(10), chr(92) + chr(10))}\n{text} [/ROLE]")
    return "".join(out)


def read_back(formatted: str) -> list[Turn]:
    """The turns of a string that ``inst_template`` gave."""
    turns, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if m is None:
            raise ValueError(f"no turn at {at}")
        kind = m.lastgroup
        turns.append((unescape(m["role"]), unescape(m["other"])) if kind == "other" else (kind, unescape(m[kind])))
        at = m.end()
    return turns


class Renderer:
    """Finds the span of each turn of one conversation as the turns come.

    A turn's span is what the output for all turns up to it has beyond the output for those
    before. The turn is also rendered with a probe for its text: what stands before and
    after the probe is the template's own. If the longer output does not begin with the shorter
    one, the template has rewritten history.

    The whole prefix is rendered at every length, so a conversation takes time by the square of
    its turns. Only a template that is ``turn_local``, which gives a turn the same output whatever
    the turns around it, may be rendered without them; that is the caller's word and not checked.
    """

    def __init__(self, template: Template, turn_local: bool = False):
        self.template, self.turn_local = template, turn_local
        self.turns: list[Turn] = []
        self.before = ""
        self.rewrites = False

    def add(self, role: str, text: str) -> tuple[str, int, int] | None:
        """The span, and where the text begins and ends in it; None if history is rewritten."""
        before = self.before
        probed = self.template([*self.turns, (role, PROBE)])
        after = self.template([*self.turns, (role, text)])
        if not self.turn_local:
            self.turns.append((role, text))
            self.before = after
        if not after.startswith(before) or not probed.startswith(before):
            self.rewrites = True
            return None
        span, frame = after[len(before) :], probed[len(before) :]
        head, mark, tail = frame.partition(PROBE)
        if not mark or len(span) < len(head) + len(tail) or not span.startswith(head) or not span.endswith(tail):
            self.rewrites = True
            return None
        return span, len(head), len(span) - len(tail)


SCHEMA = (
    "conv_id bigint, position bigint, role string, start bigint, rendered string, text_start bigint, text_end bigint, "
    "in_loss boolean, rewrites_history boolean"
)


def format_turns(conversations: DataFrame, template: Template = inst_template, loss_roles: tuple[str, ...] = ("assistant",), turn_local: bool = False) -> DataFrame:
    """One row per turn, in order: its place, its rendered span, where its text lies in the span, and whether it counts for the loss.

    The rendered spans of a conversation, put together, are the template's output; ``start`` is
    the code points before the span. Where the template rewrites history, ``rendered`` and the
    places are null and ``rewrites_history`` is true from there on.

    Turns are sorted by turn, then role, then text, so repeated rows and ties have an order; null
    roles and texts are empty, null turns come first, null conv_ids are one conversation. A
    task streams through its conversations and keeps the turns of one, which are rendered anew for
    each of its turns; with ``turn_local`` (see ``Renderer``) it keeps none. An empty table gives
    no rows. Other columns are left out.
    """
    small_batches(conversations)
    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, renderer, position, start = object(), None, 0, 0
        for batch in batches:
            out = []
            for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                if renderer is None or conv != last:
                    last, renderer, position, start = conv, Renderer(template, turn_local), 0, 0
                found = None if renderer.rewrites else renderer.add(role, text)
                span, a, b = found or (None, None, None)
                out.append((conv, position, role, start if found else None, span, a, b, role in loss_roles, renderer.rewrites))
                position += 1
                start += len(span) if found else 0
            yield _batch(out, ["int64", "int64", "string", "int64", "string", "int64", "int64", "bool_", "bool_"], SCHEMA)

    return ordered.mapInArrow(run, SCHEMA)


def _batch(rows: list[tuple], kinds: list[str], schema: str) -> pa.RecordBatch:
    names = [field.split()[0] for field in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(list(c), getattr(pa, kind)()) for c, kind in zip(columns, kinds)], names)


DIGEST = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"


def digests(turns: DataFrame, read: Callable[[str], list[Turn]] = read_back) -> DataFrame:
    """One row per conversation of ``format_turns``: digests of the turns and of the loss text, read back from the rendered spans.

    It must follow ``format_turns`` directly, whose rows come in order within a partition. The
    digests grow turn by turn; no conversation is held.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        last, state = None, None
        kinds = ["int64", "int64", "string", "int64", "string", "int64"]

        def row():
            return (last, state["n"], state["turns"].hexdigest(), state["loss_chars"], state["loss"].hexdigest(), state["chars"])

        for batch in batches:
            done = []
            names = ("conv_id", "position", "rendered", "text_start", "text_end", "in_loss")
            for conv, position, span, a, b, in_loss in zip(*(batch.column(c).to_pylist() for c in names)):
                if position == 0:
                    if state:
                        done.append(row())
                    last, state = conv, {"n": 0, "turns": hashlib.sha256(), "loss": hashlib.sha256(), "loss_chars": 0, "chars": 0}
                if span is None:
                    continue
                for role, text in read(span):
                    state["n"] += 1
                    state["turns"].update(f"{role}\n{text}\n".encode())
                state["chars"] += len(span)
                if in_loss:
                    text = unescape(span[a:b])
                    state["loss"].update(text.encode())
                    state["loss_chars"] += len(text)
            yield _batch(done, kinds, DIGEST)
        if state:
            yield _batch([row()], kinds, DIGEST)

    return turns.mapInArrow(run, DIGEST)
