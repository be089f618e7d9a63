"""Chat formatting for records of many layouts.

A record is a JSON object. The set of its nested field paths is hashed to a
fingerprint, and the fingerprint selects a declarative mapping that names where roles
and texts are found. All layouts so become the same rows of canonical turns, which
the template writes as one text per conversation with a loss mask.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.arrow import extended, slices

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: Characters that open a control string of this or another template, and the escape itself.
OPENING = re.compile(r"([\\<\[])")
OPENED = re.compile(r"([\\<\[])\\")
#: Turns by number that are formatted by one task at least, and characters of a segment.
BLOCK_TURNS, SEGMENT_CHARS = 4096, 1 << 20
#: A record nested deeper than this is of no layout.
MAX_DEPTH = 100
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


@dataclass(frozen=True)
class Mapping:
    """Where a layout keeps its turns.

    ``each`` names a list whose items have a role and a text field; without it ``turns``
    names a role and the fields whose non-empty texts, joined by a blank line, are its
    text. An empty field list in ``turns`` is not allowed. ``required`` are the field paths
    that a record of the layout has; it may have more.
    """

    name: str
    required: frozenset[str]
    each: str | None = None
    role: str = "role"
    text: str = "content"
    turns: tuple[tuple[str, tuple[str, ...]], ...] = ()
    optional_roles: frozenset[str] = field(default_factory=lambda: frozenset({"system"}))


MAPPINGS = (
    Mapping("row", frozenset({"role", "text"}), each="", text="text"),
    Mapping("messages", frozenset({"messages[].role", "messages[].content"}), each="messages"),
    Mapping(
        "from_value",
        frozenset({"conversations[].from", "conversations[].value"}),
        each="conversations",
        role="from",
        text="value",
    ),
    Mapping(
        "instruction",
        frozenset({"instruction", "output"}),
        turns=(("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",))),
    ),
    Mapping(
        "prompt_response",
        frozenset({"prompt", "response"}),
        turns=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",))),
    ),
    Mapping(
        "prompt_completion",
        frozenset({"prompt", "completion"}),
        turns=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("completion",))),
    ),
    Mapping(
        "question_answer",
        frozenset({"question", "answer"}),
        turns=(("system", ("system",)), ("user", ("question",)), ("assistant", ("answer",))),
    ),
)


def field_paths(value: object, prefix: str = "", depth: int = 0) -> set[str]:
    """Paths of all nested fields; list items share the path of their list plus ``[]``."""
    if depth > MAX_DEPTH:
        raise ValueError("nested too deep")
    if isinstance(value, dict):
        paths = set()
        for name, inner in value.items():
            path = f"{prefix}.{name}" if prefix else name
            paths |= {path} | field_paths(inner, path, depth + 1)
        return paths
    if isinstance(value, list):
        return {f"{prefix}[]"}.union(*(field_paths(x, f"{prefix}[]", depth + 1) for x in value))
    return set()


def fingerprint(paths: set[str]) -> str:
    return xxhash.xxh3_64_hexdigest("\n".join(sorted(paths)))


def select_mapping(paths: set[str], mappings: tuple[Mapping, ...]) -> Mapping | None:
    """The mapping with most required paths, all of them present; the earlier one on a tie."""
    fitting = [m for m in mappings if m.required <= paths]
    return max(fitting, key=lambda m: len(m.required), default=None)


def plain(value: object) -> str:
    """Text of a field: null is empty, a list gives the texts of its parts in order."""
    if value is None:
        return ""
    if isinstance(value, str):
        return value
    if isinstance(value, list):
        return "".join(plain(x.get("text")) if isinstance(x, dict) else plain(x) for x in value)
    return json.dumps(value, ensure_ascii=False, sort_keys=True)


def turns_of(record: dict, mapping: Mapping) -> list[tuple[str, str]]:
    if mapping.each is not None:
        items = record.get(mapping.each) if mapping.each else [record]
        found = [x for x in items or [] if isinstance(x, dict)]
        pairs = [(plain(x.get(mapping.role)), plain(x.get(mapping.text))) for x in found]
        return [(ROLES.get(role, role), text) for role, text in pairs]
    turns = []
    for role, fields in mapping.turns:
        text = "\n\n".join(t for t in (plain(record.get(f)) for f in fields) if t)
        if text or role not in mapping.optional_roles:
            turns.append((role, text))
    return turns


def canonical_turns(
    records: DataFrame,
    key: str = "conv_id",
    order: str = "turn",
    record: str = "record",
    mappings: tuple[Mapping, ...] = MAPPINGS,
) -> DataFrame:
    """One row (key, order, position, role, text, layout, fingerprint) per turn of each record.

    ``record`` is JSON text. A record that is null, no JSON object, nested deeper than ``MAX_DEPTH``,
    holding half of a surrogate pair (which is no text), or of a layout that no mapping knows gives one row with null ``layout``, null role and null text, so that it can
    be counted and a mapping added. A mapped record without turns gives no row. Other columns
    are not returned; repeated records give repeated turns.
    """
    rows = records.select(
        F.col(f"`{key}`").alias("key"), F.col(f"`{order}`").cast("bigint").alias("order"), F.col(f"`{record}`").alias("record")
    )
    schema = extended(
        rows.select("key", "order"),
        "position int, role string, text string, layout string, fingerprint string",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Mapping | None] = {}
        for batch in slices(batches, "record"):
            source, out = [], []
            records = batch.column("record").to_pylist()
            for at, text in enumerate(records):
                value = _parsed(text)
                paths = field_paths(value)
                mark = fingerprint(paths)
                if mark not in known:
                    known[mark] = select_mapping(paths, mappings)
                mapping = known[mark]
                if mapping is None:
                    source.append(at)
                    out.append((0, None, None, None, mark))
                    continue
                for position, (role, body) in enumerate(turns_of(value, mapping)):
                    source.append(at)
                    out.append((position, role, body, mapping.name, mark))
            taken = pa.array(source, pa.int64())
            columns = [batch.column(c).take(taken) for c in ("key", "order")]
            values = list(zip(*out, strict=True)) or [[]] * 5
            types = [pa.int32(), *[pa.string()] * 4]
            columns += [pa.array(v, t) for v, t in zip(values, types, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(run, schema)


def _parsed(text: str | None) -> dict:
    try:
        value = json.loads(text) if text else None
        field_paths(value)
        if text and "\\u" in text:
            json.dumps(value, ensure_ascii=False).encode()
    except (ValueError, RecursionError):
        value = None
    return value if isinstance(value, dict) else {}


def escaped(text: str) -> str:
    """Put a backslash after each ``<``, ``[`` and backslash, so no control string is left whole."""
    return OPENING.sub(r"\1\\", text)


def unescaped(text: str) -> str:
    return OPENED.sub(r"\1", text)


def format_chats(turns: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """Text segments (key, block, segment, n_turns, formatted, loss_spans) of canonical turns.

    A conversation's text is its segments' ``formatted`` in order of (block, segment); most
    have one segment. Turns are ordered by order (null first), position, role and text, so
    ties and repeated rows have a fixed place. ``loss_spans`` are half-open spans of code
    points of the segment's text that hold a turn of ``loss_role``. Null roles and texts count
    as empty; a null key is a conversation of its own. Rows without layout are left out.

    Turns are dealt out by conversation and by block of ``BLOCK_TURNS`` of their order: a long
    conversation is formatted by many tasks, and no task holds more than a segment.
    """
    rows = turns.filter("layout is not null").select(
        "key",
        F.floor(F.col("order") / BLOCK_TURNS).alias("block"),
        "order",
        "position",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    dealt = rows.repartition("key", "block")
    sorted_rows = dealt.sortWithinPartitions("key", "block", "order", "position", "role", "text")
    schema = extended(
        rows.select("key"),
        "block bigint, segment int, n_turns int, formatted string, "
        "loss_spans array<struct<begin: bigint, end: bigint>>",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, segment = None, 0
        parts: list[str] = []
        marked: list[dict] = []
        size = n_turns = 0
        ready: list[tuple] = []

        def close() -> None:
            nonlocal parts, marked, size, n_turns, segment
            if n_turns:
                ready.append((*current, segment, n_turns, "".join(parts), marked))
            segment += 1
            parts, marked, size, n_turns = [], [], 0, 0

        for batch in slices(batches, "text"):
            key_type = batch.schema.field("key").type
            for key, block, _, _, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (key, block) != current:
                    close()
                    current, segment = (key, block), 0
                elif size > SEGMENT_CHARS:
                    close()
                head, body = f"{TURN}{escaped(role)}{TEXT}", escaped(text)
                if role == loss_role:
                    begin = size + len(head)
                    marked.append({"begin": begin, "end": begin + len(body)})
                parts += [head, body, END]
                size += len(head) + len(body) + len(END)
                n_turns += 1
                if len(ready) >= 256:
                    yield _segments(ready, key_type)
                    ready = []
        close()
        if ready:
            yield _segments(ready, key_type)

    return sorted_rows.mapInArrow(run, schema)


def _segments(rows: list[tuple], key_type: pa.DataType) -> pa.RecordBatch:
    span = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
    types = [key_type, pa.int64(), pa.int32(), pa.int32(), pa.string(), span]
    names = ["key", "block", "segment", "n_turns", "formatted", "loss_spans"]
    values = zip(*rows, strict=True)
    columns = [pa.array(list(v), t) for v, t in zip(values, types, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=names)


def read_back(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts that a formatted text holds."""
    turns = []
    for turn in formatted.split(TURN)[1:]:
        role, _, rest = turn.partition(TEXT)
        turns.append((unescaped(role), unescaped(rest.removesuffix(END))))
    return turns


def digest_chats(segments: DataFrame) -> DataFrame:
    """Per conversation, read back from the segments: sizes and digests of turns and loss text.

    Segments of a conversation pass one task in order, since a digest takes bytes in order;
    the task keeps the running digests only.
    """
    schema = extended(
        segments.select("key"),
        "n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
        "formatted_chars bigint",
    )
    rows = segments.repartition("key").sortWithinPartitions("key", "block", "segment")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None
        ready: list[tuple] = []

        def close() -> None:
            if state:
                n, turns, loss_chars, loss, chars = state
                ready.append((current[0], n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))

        def batch_of(key_type: pa.DataType) -> pa.RecordBatch:
            types = [key_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            values = zip(*ready, strict=True)
            columns = [pa.array(list(v), t) for v, t in zip(values, types, strict=True)]
            return pa.RecordBatch.from_arrays(columns, names=schema.names)

        for batch in slices(batches, "formatted"):
            key_type = batch.schema.field("key").type
            columns = (batch.column(c).to_pylist() for c in ("key", "formatted", "loss_spans"))
            for key, text, spans in zip(*columns, strict=True):
                if current is None or key != current[0]:
                    close()
                    current, state = (key,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, body in read_back(text):
                    state[0] += 1
                    state[1].update(f"{role}\n{body}\n".encode())
                for span in spans:
                    marked = unescaped(text[span["begin"] : span["end"]])
                    state[2] += len(marked)
                    state[3].update(marked.encode())
                state[4] += len(text)
            if len(ready) >= 256:
                yield batch_of(key_type)
                ready.clear()
        close()
        if ready:
            yield batch_of(key_type)

    return rows.mapInArrow(run, schema)
