r"""Chat formatting by schema fingerprints.

Records come as JSON objects of different layouts. A record's fingerprint is
the hash of its sorted nested field paths (array elements as ``[]``); it selects
a declarative mapping, a few field names, that turns the record into canonical
turns (conv_id, turn, role, text). A layout is added by one more mapping; a
record of unknown layout is not guessed at: it is returned with no mapping.

Template of a turn::

    ### Role: user
    text</turn>

Inside roles and texts ``\`` becomes ``\\``, and ``### `` and ``</turn>`` get a
leading ``\``; a line feed in a role becomes ``\n``. So marks of the template are
the unescaped ones, whatever the texts say, and reading back is exact. The loss
mask covers the text of assistant turns.

Scale: turns are dealt by conversation and sorted inside the partitions;
formatting and reading back go through them as a stream, one turn at a time, so
memory does not grow with a conversation.

Defined cases: NULL text or role is empty; turns without a number come first;
repeated turn numbers are ordered by role, then text; turns without a conv_id
are one conversation with that id; no input rows give no output rows.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOSS_ROLE = "assistant"
_CONTROL = re.compile(r"\\|### |</turn>")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(r"### Role: ((?:[^\\\n]|\\.)*)\n((?:[^\\<]|\\.|<(?!/turn>))*)</turn>\n", re.DOTALL)


@dataclass(frozen=True)
class Mapping:
    """How a layout's fields become turns. ``conv``, ``turn``: fields of the record
    ("" if absent). ``turns``: an array field whose elements hold ``role`` and
    ``text``; without it, ``parts`` lists (role, fields joined by a blank line) and
    ``role``/``text`` name the fields of a record that is one turn itself.
    ``roles`` renames roles of the layout."""

    conv: str
    turn: str = ""
    turns: str = ""
    role: str = ""
    text: str = ""
    parts: tuple = ()
    roles: tuple = ()


def paths(value, at: str = "") -> set[str]:
    """Nested field paths of a JSON value."""
    if isinstance(value, dict):
        return set().union(*(paths(v, f"{at}.{k}" if at else k) for k, v in value.items())) if value else {at}
    if isinstance(value, list):
        return set().union({f"{at}[]"}, *(paths(v, f"{at}[]") for v in value))
    return {at}


def fingerprint(found) -> str:
    return hashlib.sha256("\n".join(sorted(found)).encode()).hexdigest()[:16]


_SHARE = (("human", "user"), ("gpt", "assistant"), ("bot", "assistant"), ("model", "assistant"))
#: The known layouts by their field paths.
LAYOUTS = {
    ("conv_id", "turn", "role", "text"): Mapping("conv_id", "turn", role="role", text="text"),
    ("id", "messages[]", "messages[].role", "messages[].content"): Mapping("id", turns="messages", role="role", text="content"),
    ("id", "conversations[]", "conversations[].from", "conversations[].value"):
        Mapping("id", turns="conversations", role="from", text="value", roles=_SHARE),
    ("id", "prompt", "response"): Mapping("id", parts=(("user", ("prompt",)), ("assistant", ("response",)))),
    ("id", "prompt", "completion"): Mapping("id", parts=(("user", ("prompt",)), ("assistant", ("completion",)))),
    ("id", "instruction", "output"): Mapping("id", parts=(("user", ("instruction",)), ("assistant", ("output",)))),
    ("id", "instruction", "input", "output"): Mapping("id", parts=(("user", ("instruction", "input")), ("assistant", ("output",)))),
    ("id", "system", "instruction", "input", "output"):
        Mapping("id", parts=(("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",)))),
}


def registry(layouts: dict = LAYOUTS) -> dict[str, Mapping]:
    return {fingerprint(set(p)): m for p, m in layouts.items()}


def turns_of(record: dict, m: Mapping) -> Iterator[tuple]:
    """(conv_id, turn, role, text) of one record."""
    rename, conv = dict(m.roles), record.get(m.conv)
    said = lambda x: "" if x is None else x if isinstance(x, str) else json.dumps(x, ensure_ascii=False)
    if m.turns:
        for k, t in enumerate(record[m.turns] or []):
            yield conv, k, rename.get(said(t.get(m.role)), said(t.get(m.role))), said(t.get(m.text))
    elif m.parts:
        for k, (role, fields) in enumerate(m.parts):
            yield conv, k, role, "\n\n".join(x for f in fields if (x := said(record.get(f))))
    else:
        role = said(record.get(m.role))
        yield conv, record.get(m.turn) if m.turn else 0, rename.get(role, role), said(record.get(m.text))


def canonical_turns(records: DataFrame, layouts: dict = LAYOUTS) -> DataFrame:
    """(conv_id, turn, role, text, fingerprint, known) from a string column
    ``record`` of JSON objects; a record of unknown layout, or one that is no
    JSON object, gives one row with ``known`` false and no turn."""
    known = registry(layouts)

    def turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for raw in batch.column(0).to_pylist():
                try:
                    record = json.loads(raw) if raw is not None else None
                except ValueError:
                    record = None
                mark = fingerprint(paths(record)) if isinstance(record, dict) else None
                mapping = known.get(mark)
                if mapping is None:
                    out.append((None, None, None, None, mark, False))
                    continue
                out += [(c, t, r, x, mark, True) for c, t, r, x in turns_of(record, mapping)]
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], kind) for k, kind in enumerate(kinds)],
                                             ["conv_id", "turn", "role", "text", "fingerprint", "known"])

    return records.select("record").mapInArrow(
        turns, "conv_id long, turn long, role string, text string, fingerprint string, known boolean")


def escape(text: str) -> str:
    return _CONTROL.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m.group(1), text)


def format_turn(role: str, text: str) -> str:
    return f"### Role: {escape(role).replace(chr(10), chr(92) + 'n')}\n{escape(text)}</turn>\n"


def role_back(escaped: str) -> str:
    return _ESCAPED.sub(lambda m: "\n" if m.group(1) == "n" else m.group(1), escaped)


def parse(formatted: str) -> Iterator[tuple[str, str, int, int]]:
    """(role, text, begin, end) of each turn; begin..end is the escaped text's span."""
    at = 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if m is None:
            raise ValueError(f"no turn at {at}")
        yield role_back(m.group(1)), unescape(m.group(2)), m.start(2), m.end(2)
        at = m.end()


def format_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, part, formatted, loss_spans): each conversation's formatted text
    in parts of whole turns, in order; loss_spans are (begin, end) within the
    part. Partitions hold whole conversations, sorted."""
    dealt = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")) \
                 .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    span = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))

    def formatted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, part = None, 0
        for batch in batches:
            rows, text, spans = [], [], []
            length, upto = 0, None

            def flush(conv):
                nonlocal text, spans, length, part
                if text:
                    rows.append((conv, part, "".join(text), spans))
                    part += 1
                text, spans, length = [], [], 0

            for conv, role, said in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
                if last is None or (conv,) != last:
                    flush(upto)
                    last, part = (conv,), 0
                upto = conv
                one = format_turn(role, said)
                if role == LOSS_ROLE:
                    begin = length + one.index("\n") + 1
                    spans.append({"a": begin, "b": length + len(one) - len("</turn>\n")})
                text.append(one)
                length += len(one)
                if length > 1 << 16:
                    flush(conv)
            flush(upto)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                 pa.array([r[2] for r in rows], pa.string()), pa.array([r[3] for r in rows], span)],
                ["conv_id", "part", "formatted", "loss_spans"])

    return dealt.drop("turn").mapInArrow(
        formatted, "conv_id long, part long, formatted string, loss_spans array<struct<a: long, b: long>>")


def read_back(parts: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars),
    read from the formatted parts of ``format_turns`` (in its order)."""
    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, None

        def row(conv):
            return (conv, state["n"], state["turns"].hexdigest(), state["loss_chars"], state["loss"].hexdigest(), state["chars"])

        def made(rows):
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names)

        for batch in batches:
            rows = []
            for conv, text, spans in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss_spans")), strict=True):
                if last is None or (conv,) != last:
                    if last is not None:
                        rows.append(row(*last))
                    last = (conv,)
                    state = {"n": 0, "turns": hashlib.sha256(), "loss": hashlib.sha256(), "loss_chars": 0, "chars": 0}
                state["chars"] += len(text)
                for role, said, _, _ in parse(text):
                    state["n"] += 1
                    state["turns"].update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
                for s in spans:
                    said = unescape(text[s["a"]:s["b"]])
                    state["loss_chars"] += len(said)
                    state["loss"].update(said.encode("utf-8", "surrogatepass"))
            yield made(rows)
        if last is not None:
            yield made([row(*last)])

    return parts.mapInArrow(back, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                  "loss_sha256 string, formatted_chars long")
