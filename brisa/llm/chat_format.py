"""Chat formatting: conversations as one marked text each, with a mask of what a model is trained on.

A turn is written as opening mark, text, closing mark, by its role; a turn of a role without marks of its own carries the role's
name in a header. Inside texts a control string's first character, and every escape character, gets an escape character in front,
so that no text can open or close a turn, and taking the escapes out gives the text back.

The work is columnar: for a batch of turns numpy finds the places of escapes in the texts' buffer, the length of every
segment (mark, name, text, mark), the running offsets, and for each byte the index that it goes to; headers and contents are then
copied into one buffer, allocated once, which becomes the data of the Arrow column.

Rows are dealt by conversation and sorted by turn, and a task reads them batch by batch, so that the longest conversation
takes no more memory than a batch. A conversation that goes over several batches comes in several parts, in order.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brisa.llm.common import bounded_batches

# The control strings of the template.
MARKS = {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")}
OTHER = ("[ROLE]", "[/ROLE]", "[TURN]", "[/TURN]")
ESCAPE = "\\"
LEARNED = "assistant"

# Bytes that one step of the assembly moves; its index arrays take some forty times as much.
SCATTER_BYTES = 1 << 19


@dataclass(frozen=True)
class Template:
    """Marks by role, marks of any other role (name opened, name closed, text opened, text closed), and whose text is learned."""

    marks: Mapping[str, tuple[str, str]] = field(default_factory=lambda: dict(MARKS))
    other: tuple[str, str, str, str] = OTHER
    escape: str = ESCAPE
    learned: str = LEARNED

    @property
    def controls(self) -> list[str]:
        return sorted({m for pair in self.marks.values() for m in pair} | set(self.other))

    def __post_init__(self) -> None:
        if len(self.escape) != 1 or not self.escape.isascii() or any(self.escape in c or not c.isascii() for c in self.controls):
            raise ValueError("the escape is one ASCII character that is in no control string")
        if len(self.controls) != 2 * len(self.marks) + 4:
            raise ValueError("control strings must differ")
        if any(a != b and a in b for a in self.controls for b in self.controls):
            raise ValueError("no control string may lie in another one")


_PARTS = (
    "conv_id long, part int, first_turn long, turns int, formatted string, "
    "loss array<struct<start:long,end:long>>"
)


def _buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Data and 64-bit offsets of a text column without nulls."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), offsets


def _escape_places(data: np.ndarray, offsets: np.ndarray, template: Template) -> np.ndarray:
    """Places before which an escape goes: escape characters, and beginnings of control strings that lie in one text."""
    found = [np.flatnonzero(data == ord(template.escape))]
    for control in template.controls:
        code = np.frombuffer(control.encode(), np.uint8)
        at = np.flatnonzero(data[: max(0, len(data) - len(code) + 1)] == code[0])
        for i, c in enumerate(code[1:].tolist(), 1):
            at = at[data[at + i] == c]
        ends = np.append(offsets, len(data))[np.searchsorted(offsets, at, "right")]
        found.append(at[at + len(code) <= ends])
    return np.unique(np.concatenate(found))


class _Segments:
    """Pieces of the output in order; each copies a range of the joined sources, with escapes."""

    def __init__(self, sources: list[np.ndarray], escapes: list[np.ndarray], template: Template) -> None:
        self.bases = np.cumsum([0, *map(len, sources)])
        self.data = np.concatenate(sources)
        self.places = np.concatenate([e + b for e, b in zip(escapes, self.bases)])
        self.escape = ord(template.escape)

    def assemble(self, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(buffer, offset of each segment and of the end). A range may be used many times, as marks are."""
        first, last = np.searchsorted(self.places, start), np.searchsorted(self.places, end)
        lengths, escapes = end - start, last - first
        offsets = np.concatenate([[0], np.cumsum(lengths + escapes)])
        out = np.full(int(offsets[-1]), self.escape, np.uint8)  # what nothing is copied to are the escapes
        until = np.cumsum(lengths)
        for low in range(0, int(until[-1]) if len(until) else 0, SCATTER_BYTES):
            high = min(low + SCATTER_BYTES, int(until[-1]))
            a, b = np.searchsorted(until, [low, high - 1], "right")
            taken = np.minimum(until[a : b + 1], high) - np.maximum(until[a : b + 1] - lengths[a : b + 1], low)
            segment = np.repeat(np.arange(a, b + 1), taken)
            inside = np.arange(low, high) - (until - lengths)[segment]
            source = start[segment] + inside
            moved = np.searchsorted(self.places, source, "right") - first[segment]
            out[offsets[segment] + inside + moved] = self.data[source]
        return out, offsets


def _characters_before(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Number of code points before each place of a UTF-8 buffer."""
    asked, back = np.unique(places, return_inverse=True)
    heads = (data & 0xC0) != 0x80
    edges = asked[asked < len(data)]
    if not len(edges):
        return np.zeros(places.shape, np.int64)
    parts = np.add.reduceat(heads, edges, dtype=np.int64)
    before = np.concatenate([[0], np.cumsum(parts)]) + np.count_nonzero(heads[: edges[0]])
    return before[: len(asked)][back].reshape(places.shape)


def _formatted(batch: pa.RecordBatch, template: Template):
    """(conversation starts, offsets, buffer, loss spans) of the turns of a batch."""
    n = batch.num_rows
    texts, text_at = _buffer(batch.column("text"))
    roles = batch.column("role").dictionary_encode()
    names = roles.dictionary.to_pylist()
    codes = roles.indices.to_numpy()
    # what stands before and behind a text, by role
    heads, tails = [], []
    for name in names:
        marks = template.marks.get(name)
        heads.append([marks[0]] if marks else [template.other[0], name, template.other[1] + template.other[2]])
        tails.append(marks[1] if marks else template.other[3])
    controls = "".join(h[0] + (h[2] if len(h) > 2 else "") for h in heads) + "".join(tails)
    control_data = np.frombuffer(controls.encode(), np.uint8)
    name_data = np.frombuffer("".join(h[1] for h in heads if len(h) > 2).encode(), np.uint8)
    pieces = _Segments(
        [texts, name_data, control_data],
        [_escape_places(texts, text_at, template), _name_escapes(heads, template), np.zeros(0, np.int64)], template,
    )
    # ranges of each role's four pieces: opening, name, after the name, closing
    ranges = np.zeros((len(names), 4, 2), np.int64)
    at, name_at = pieces.bases[2], pieces.bases[1]
    for i, h in enumerate(heads):
        ranges[i, 0] = at, at + len(h[0])
        at += len(h[0])
        if len(h) > 2:
            size = len(h[1].encode())
            ranges[i, 1] = name_at, name_at + size
            name_at += size
            ranges[i, 2] = at, at + len(h[2])
            at += len(h[2])
    for i, t in enumerate(tails):
        ranges[i, 3] = at, at + len(t)
        at += len(t)
    start, end = np.empty((n, 5), np.int64), np.empty((n, 5), np.int64)
    for column, piece in ((0, 0), (1, 1), (2, 2), (4, 3)):
        start[:, column], end[:, column] = ranges[codes, piece, 0], ranges[codes, piece, 1]
    start[:, 3], end[:, 3] = text_at[:-1], text_at[1:]
    out, offsets = pieces.assemble(start.reshape(-1), end.reshape(-1))
    learned = np.array([name == template.learned for name in names], bool)[codes]
    turn = offsets[: 5 * n : 5]
    return out, np.append(turn, len(out)), offsets[3 : 5 * n : 5], offsets[4 : 5 * n : 5], learned


def _name_escapes(heads: list[list[str]], template: Template) -> np.ndarray:
    """Places of escapes in the joined role names; a name is looked at by itself."""
    found, at = [np.zeros(0, np.int64)], 0
    for h in heads:
        if len(h) > 2:
            data = np.frombuffer(h[1].encode(), np.uint8)
            found.append(_escape_places(data, np.array([0]), template) + at)
            at += len(data)
    return np.concatenate(found)


def _parts_of(template: Template):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, part, turns_before = object(), 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            buffer, turn, low, high, learned = _formatted(batch, template)
            ids = batch.column("conv_id")
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            values = ids.fill_null(0).to_numpy()
            new = np.append(True, (values[1:] != values[:-1]) | (known[1:] != known[:-1]))
            starts = np.flatnonzero(new)
            ends = np.append(starts[1:], batch.num_rows)
            key = ids[0].as_py()
            goes_on = part > 0 and key == before
            if not goes_on:
                part, turns_before = 0, 0
            parts = np.zeros(len(starts), np.int32)
            firsts = np.zeros(len(starts), np.int64)
            parts[0], firsts[0] = part, turns_before
            bytes_at = turn[np.append(starts, batch.num_rows)]
            text = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(bytes_at.astype(np.int64)), pa.py_buffer(buffer))
            # spans of learned texts in code points of their part
            marked = np.flatnonzero(learned)
            owner = np.searchsorted(starts, marked, "right") - 1
            chars = _characters_before(buffer, np.stack([low[marked], high[marked], bytes_at[owner]]))
            spans = pa.StructArray.from_arrays([pa.array(chars[0] - chars[2]), pa.array(chars[1] - chars[2])], names=["start", "end"])
            loss = pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(len(starts) + 1)).astype(np.int32)), spans)
            columns = [
                ids.take(pa.array(starts)), pa.array(parts), pa.array(firsts), pa.array((ends - starts).astype(np.int32)),
                text.cast(pa.string()), loss,
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["conv_id", "part", "first_turn", "turns", "formatted", "loss"])
            if len(starts) > 1:
                part, turns_before = 0, 0
            before, part = ids[batch.num_rows - 1].as_py(), part + 1
            turns_before += int(ends[-1] - starts[-1])

    return run


def format_conversations(turns: DataFrame, template: Template | None = None) -> DataFrame:
    """(conv_id, part, first_turn, turns, formatted, loss): each conversation's text, and the spans that a model learns.

    Turns come by turn number, those without one first, ties by role and text. A null text or role counts as empty, a null
    conv_id is a conversation of its own. ``loss`` holds the spans of learned texts in code points of ``formatted``, as they
    stand there, with escapes. A conversation has one part, or, where it is longer than a batch, several: joined in order they
    are its text. Parts of a conversation follow each other in the result's partitions. Texts are never cut, an empty
    table gives no rows, columns other than conv_id, turn, role and text are not read.
    """
    bounded_batches(turns.sparkSession)
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.select("conv_id", "role", "text").mapInArrow(_parts_of(template or Template()), _PARTS)


class Reader:
    """Takes formatted text apart again."""

    def __init__(self, template: Template) -> None:
        self.template = template
        escape = re.escape(template.escape)
        # an escaped character is never the start of a control string
        self.token = re.compile(f"{escape}.|(" + "|".join(map(re.escape, template.controls)) + ")", re.DOTALL)
        self.escaped = re.compile(f"{escape}(.)", re.DOTALL)
        self.role_of = {pair[0]: role for role, pair in template.marks.items()}

    def plain(self, text: str) -> str:
        """Without escapes."""
        return self.escaped.sub(r"\1", text) if self.template.escape in text else text

    def turns(self, formatted: str) -> Iterator[tuple[str, str]]:
        """(role, text) of each turn. What does not follow the template is an error."""
        name_open, name_close, text_open, text_close = self.template.other
        marks = [m for m in self.token.finditer(formatted) if m.group(1)]
        i, at = 0, 0
        while i < len(marks):
            if marks[i].start() != at:
                raise ValueError("text outside of turns")
            opening = marks[i].group(1)
            wanted = [name_open, name_close, text_open, text_close] if opening == name_open else None
            if opening in self.role_of:
                role = self.role_of[opening]
                wanted = [opening, self.template.marks[role][1]]
            found = marks[i : i + len(wanted)] if wanted else []
            if not wanted or [m.group(1) for m in found] != wanted:
                raise ValueError("marks do not belong together")
            if opening == name_open:
                role = self.plain(formatted[found[0].end() : found[1].start()])
            yield role, self.plain(formatted[found[-2].end() : found[-1].start()])
            i, at = i + len(wanted), found[-1].end()
        if at != len(formatted):
            raise ValueError("text outside of turns")


_DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


def _digests_of(template: Template):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(template)
        rows: list[tuple] = []
        state: list | None = None

        def row() -> tuple:
            key, n, turns, chars, loss, size = state
            return key, n, turns.hexdigest(), chars, loss.hexdigest(), size

        def sent() -> pa.RecordBatch:
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
            rows.clear()
            return out

        for batch in batches:
            columns = [batch.column(c) for c in ("conv_id", "part", "formatted", "loss")]
            for key, part, text, loss in zip(*(c.to_pylist() for c in columns)):
                if part == 0:
                    if state:
                        rows.append(row())
                    state = [key, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                elif not state or state[0] != key:
                    raise ValueError("a part without the ones before it")
                for role, said in reader.turns(text):
                    state[1] += 1
                    state[2].update(f"{role}\n{said}\n".encode())
                for span in loss:
                    learned = reader.plain(text[span["start"] : span["end"]])
                    state[3] += len(learned)
                    state[4].update(learned.encode())
                state[5] += len(text)
            if len(rows) >= 5000:
                yield sent()
        if state:
            rows.append(row())
        if rows:
            yield sent()

    return run


def read_back(formatted: DataFrame, template: Template | None = None) -> DataFrame:
    """Digests of each conversation, from its formatted text and mask alone.

    ``formatted`` holds all parts of a conversation in order and one after another, as ``format_conversations`` gives them. A
    conversation's digest is one running hash, so its parts are read one by one by the same task.
    """
    return formatted.mapInArrow(_digests_of(template or Template()), _DIGESTS)


def digests_sql() -> str:
    """The digests in DuckDB, from the turns themselves; the escaped length by counting what is escaped."""
    marks = {r: len(a) + len(b) for r, (a, b) in MARKS.items()}
    size = " ".join(f"WHEN '{r}' THEN {n}" for r, n in marks.items())
    # a control string's first character is followed by the rest, hence counted by what it gets longer
    controls = sorted({m for pair in MARKS.values() for m in pair} | set(OTHER))
    count = " + ".join(
        f"(length({{0}}) - length(replace({{0}}, '{c}', ''))) // {len(c)}" for c in [ESCAPE, *controls]
    )
    own = f"CASE role {size} ELSE {sum(map(len, OTHER))} + length(role) + {count.format('role')} END"
    return f"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
               CAST(sum(CASE WHEN role = '{LEARNED}' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = '{LEARNED}'), '')) AS loss_sha256,
               CAST(sum(length(text) + {count.format('text')} + {own}) AS BIGINT) AS formatted_chars
        FROM turns GROUP BY conv_id"""
