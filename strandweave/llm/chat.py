"""Chat formatting by a grammar that is parsed back."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandweave.session import Cut

#: The grammar: conversation = { OPEN role BREAK text CLOSE newline }. A role ends at the first BREAK that is not
#: escaped, a text at the first CLOSE that is not; neither holds a bare OPEN or CLOSE.
OPEN, BREAK, CLOSE = "### ", ": ", "</turn>"
#: What a backslash may stand before: itself and the characters that CLOSE, OPEN and BREAK begin with.
MARKS = "\\<#:"


class GrammarError(ValueError):
    pass


def escape(text: str, marks: str) -> str:
    for mark in marks:  # the backslash comes first
        text = text.replace(mark, "\\" + mark)
    return text


def unescape(text: str) -> str:
    """Without the backslash before each character that one stands before."""
    if "\\" not in text:
        return text
    parts = text.split("\\")
    out, i = [parts[0]], 1
    while i < len(parts):
        if parts[i] or i + 1 == len(parts):
            out.append(parts[i])
            i += 1
        else:  # two in a row are one
            out += ["\\", parts[i + 1]]
            i += 2
    return "".join(out)


def _find(rendered: str, marker: str, at: int, stop: int) -> int:
    """Where ``marker`` next stands bare, that is behind an even number of backslashes; -1 if nowhere before ``stop``."""
    while (at := rendered.find(marker, at, stop)) >= 0:
        back = at
        while back > 0 and rendered[back - 1] == "\\":
            back -= 1
        if (at - back) % 2 == 0:
            break
        at += 1
    return at


def parse(rendered: str) -> list[tuple[str, str, tuple[int, int]]]:
    """(role, text, span of the escaped text) of each turn, by searching for the markers in order; one reading only."""
    out, at, size = [], 0, len(rendered)
    while at < size:
        first = at + len(OPEN)
        stop = _find(rendered, BREAK, first, size)
        text = stop + len(BREAK)
        end = _find(rendered, CLOSE, text, size) if stop >= 0 else -1
        if end < 0 or not rendered.startswith(OPEN, at) or not rendered.startswith("\n", end + len(CLOSE)):
            raise GrammarError(f"no turn at {at}: {rendered[at : at + 40]!r}")
        if _find(rendered, OPEN, first, stop) >= 0 or _find(rendered, CLOSE, first, stop) >= 0 or _find(rendered, OPEN, text, end) >= 0:
            raise GrammarError(f"a bare marker inside the turn at {at}: {rendered[at : at + 40]!r}")
        out.append((unescape(rendered[first:stop]), unescape(rendered[text:end]), (text, end)))
        at = end + len(CLOSE) + 1
    return out


def render_turn(role: str, text: str) -> tuple[str, tuple[int, int]]:
    """One turn and the span of its text: rendered plain, read back and, as long as that differs, escaped further.

    Content that comes back as it was is left as it is. Else its backslashes are escaped and, one more at a time, the
    characters that markers begin with, until what is read back is identical.
    """
    for n in range(len(MARKS) + 1):
        line = f"{OPEN}{escape(role, MARKS[:n])}{BREAK}{escape(text, MARKS[:n])}{CLOSE}\n"
        try:
            back = parse(line)
        except GrammarError:
            continue
        if [b[:2] for b in back] == [(role, text)]:
            return line, back[0][2]
    raise GrammarError(f"not read back: {line[:80]!r}")


def format_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, rendered, loss_start, loss_end): each turn rendered, parsed back and compared.

    A null role or text counts as empty. ``loss_start`` and ``loss_end`` delimit, inside ``rendered``, the text of an
    assistant turn and are both 0 elsewhere. Texts of any length take memory in proportion; repeated rows stay, other
    columns are not read, an empty table has no rows. A turn that the parser does not give back is an error, not dropped.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rendered, starts, ends = [], [], []
            for role, text in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                line, span = render_turn(role or "", text or "")
                span = span if role == "assistant" else (0, 0)
                rendered.append(line), starts.append(span[0]), ends.append(span[1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rendered, pa.string()), pa.array(starts, pa.int64()), pa.array(ends, pa.int64())], [*batch.schema.names, "rendered", "loss_start", "loss_end"])

    rows = turns.select("conv_id", "turn", "role", "text")
    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.mapInArrow(work, f"conv_id {types['conv_id']}, turn {types['turn']}, role string, text string, rendered string, loss_start long, loss_end long")


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation, from the rendered text alone: (conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars).

    Rows of ``format_turns`` are dealt out by conversation and sorted by turn (ties by the rendered text), then streamed:
    a task holds one batch and the running digests of one conversation, whatever its length.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None

        def close() -> dict:
            return {"conv_id": now, "n_turns": state[0], "turns_sha256": state[1].hexdigest(), "loss_chars": state[2], "loss_sha256": state[3].hexdigest(), "formatted_chars": state[4]}

        for batch in batches:
            done = []
            for conv, line, start, end in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if state is None or conv != now:
                    if state is not None:
                        done.append(close())
                    now, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text, _ in parse(line):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                loss = unescape(line[start:end])
                state[2] += len(loss)
                state[3].update(loss.encode())
                state[4] += len(line)
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=schema)
        if state is not None:
            yield pa.RecordBatch.from_pylist([close()], schema=schema)

    kind = formatted.schema["conv_id"].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    schema = pa.schema([("conv_id", to_arrow_type(kind)), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
    dealt = formatted.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "rendered")
    return dealt.select("conv_id", "rendered", "loss_start", "loss_end").mapInArrow(work, f"conv_id {kind.simpleString()}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def format_and_read(turns: DataFrame) -> DataFrame:
    """Formats all turns to a table in the shared folder and reads the conversations back from it."""
    return read_back(Cut(format_turns(turns), "chat").df)
