"""Chat formatting by incremental black-box rendering.

A template is any function from a list of (role, text) turns to a string.  Every prefix of a
conversation is rendered whole and compared with the rendering before it: the turn's span is what
follows their common prefix, and a rendering that doesn't start with the one before rewrites history,
which is reported.  The span alone says where a turn is; the loss mask is the assistant's text inside
its span, found by reading the span back.  A conversation that was rewritten is read back from its
last rendering.

Rendering every prefix takes time with the square of a conversation's turns, so the prefixes of one
with more than ``PART`` turns are dealt to several tasks, ``PARTS`` at most; a task holds the turns of
one conversation up to its last prefix, and two renderings.

Defined results: null texts and roles count as empty; turns go by (turn, role, text), nulls first;
repeated rows are turns of their own; a null conv_id is a conversation; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]
#: Prefixes of a conversation that one task renders, and the most tasks for a conversation.
PART, PARTS = 256, 64

# control strings of the instruct template, and how their first character is written inside texts
_CONTROL = re.compile(r"\\|<(?=/?s>)|\[(?=/?(?:INST|ROLE)\b)")
_CLOSING = re.compile(r"[\\<\[\]]")  # in role names
_WRITTEN = {"\\": "\\\\", "<": "\\l", "[": "\\b", "]": "\\r"}
_READ = {v: k for k, v in _WRITTEN.items()}
_TURN = re.compile(r"<s>\[INST\] (.*?) \[/INST\]| (.*?) </s>|\[ROLE (.*?)\] (.*?) \[/ROLE\]", re.DOTALL)


def escape(text: str, control: re.Pattern = _CONTROL) -> str:
    return control.sub(lambda m: _WRITTEN[m[0]], text)


def unescape(text: str) -> str:
    return re.sub(r"\\[\\lbr]", lambda m: _READ[m[0]], text)


def instruct(turns: list[Turn]) -> str:
    """The default template: ``<s>[INST] user [/INST] assistant </s>``, other roles by name."""
    out = []
    for role, text in turns:
        t = escape(text)
        out.append(f"<s>[INST] {t} [/INST]" if role == "user" else f" {t} </s>" if role == "assistant" else f"[ROLE {escape(role, _CLOSING)}] {t} [/ROLE]")
    return "".join(out)


def read_instruct(span: str) -> list[tuple[str, str, int, int]]:
    """Turns of rendered text: role, text, and where the text's characters stand."""
    out, at = [], 0
    while m := _TURN.match(span, at):
        group = next(i for i in (1, 2, 4) if m[i] is not None)
        role = {1: "user", 2: "assistant", 4: ""}[group] or unescape(m[3])
        out.append((role, unescape(m[group]), m.start(group), m.end(group)))
        at = m.end()
    if at != len(span):
        raise ValueError(f"unreadable rendering: {span[at:at + 40]!r}")
    return out


def common(a: str, b: str) -> int:
    """Length of the common prefix of two strings."""
    if b.startswith(a):
        return len(a)
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid - 1
    return low


def _parts(conversations: DataFrame) -> DataFrame:
    """The turns of each conversation in order (``nth`` from 0, ``n`` in all), once for each part of its
    prefixes that needs them; part k has the prefixes that end in turns from ``k * size`` on."""
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    one = Window.partitionBy("conv_id")
    rows = (rows.withColumn("nth", F.row_number().over(one.orderBy("turn", "role", "text")) - 1).withColumn("n", F.count(F.lit(1)).over(one))
            .withColumn("size", F.greatest(F.lit(PART), F.ceil(F.col("n") / PARTS)).cast("int")))
    part = F.sequence(F.floor(F.col("nth") / F.col("size")), F.floor((F.col("n") - 1) / F.col("size")))
    return rows.withColumn("part", F.explode(part)).repartition("conv_id", "part").sortWithinPartitions("conv_id", "part", "nth")


def _rendered(render: Template):
    """conv_id, nth, turn, start, span and whether the span rewrites, of the prefixes of each part."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, turns, before, size, rows = None, [], "", 0, []
        for pdf in batches:
            ids = pdf["conv_id"]
            for cid, null, turn, role, text, nth, part, per in zip(ids, ids.isna(), pdf["turn"], pdf["role"], pdf["text"], pdf["nth"], pdf["part"], pdf["size"]):
                this = (None if null else int(cid), part)
                if this != key:
                    key, turns, before = this, [], ""
                first = part * per
                turns.append((role, text))
                if nth < first - 1:
                    continue
                after = render(list(turns))
                if nth >= first:
                    start = common(before, after)
                    span = after[start:]
                    rows.append((this[0], nth, None if pd.isna(turn) else int(turn), start, span, start < len(before)))
                    size += len(span)
                    if len(rows) >= 2000 or size > 1 << 22:
                        yield pd.DataFrame(rows, columns=_SPANS)
                        rows, size = [], 0
                before = after
        yield pd.DataFrame(rows, columns=_SPANS)

    return run


_SPANS = ["conv_id", "nth", "turn", "span_start", "span", "rewrites"]


def _spans(conversations: DataFrame, render: Template) -> DataFrame:
    return _parts(conversations).mapInPandas(_rendered(render), "conv_id long, nth long, turn long, span_start long, span string, rewrites boolean")


def format_turns(conversations: DataFrame, render: Template = instruct, read=read_instruct) -> DataFrame:
    """One row per turn: conv_id, turn, span_start, span, rewrites (so far).  Each span in order, put at its
    start in place of all that stands from there on, gives the conversation's formatted text."""
    so_far = Window.partitionBy("conv_id").orderBy("nth")
    return _spans(conversations, render).withColumn("rewrites", F.max("rewrites").over(so_far)).select("conv_id", "turn", "span_start", "span", "rewrites")


def format_conversations(conversations: DataFrame, render: Template = instruct, read=read_instruct) -> DataFrame:
    """One row per conversation: digests of what reading the rendered text back gives, and whether the
    template rewrites history."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "rewrites"]

    def whole(key, n: int, spans: list[str], rewrites: bool) -> tuple:
        turns, loss, loss_chars = hashlib.sha256(), hashlib.sha256(), 0
        for span in spans:
            for r, t, _, _ in read(span):
                turns.update(f"{r}\n{t}\n".encode("utf-8", "surrogatepass"))
                if r == "assistant":
                    loss.update(t.encode("utf-8", "surrogatepass"))
                    loss_chars += len(t)
        return key, n, turns.hexdigest(), loss_chars, loss.hexdigest(), sum(map(len, spans)), rewrites

    def run(batches):
        rows, key, n, spans, rewrites = [], None, 0, [], False
        for pdf in batches:
            ids = pdf["conv_id"]
            for cid, null, start, span, again in zip(ids, ids.isna(), pdf["span_start"], pdf["span"], pdf["rewrites"]):
                this = None if null else int(cid)
                if n and this != key:
                    rows.append(whole(key, n, spans, rewrites))
                    n, spans, rewrites = 0, [], False
                    if len(rows) >= 2000:
                        yield pd.DataFrame(rows, columns=names)
                        rows = []
                key, n = this, n + 1
                if again:  # the text so far is one piece from here on
                    rewrites = True
                if rewrites:
                    spans = ["".join(spans)[:start] + span]
                else:
                    spans.append(span)
        if n:
            rows.append(whole(key, n, spans, rewrites))
        yield pd.DataFrame(rows, columns=names)

    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, rewrites boolean"
    return _spans(conversations, render).repartition("conv_id").sortWithinPartitions("conv_id", "nth").mapInPandas(run, schema)
