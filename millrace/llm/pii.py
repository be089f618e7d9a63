"""Personal data: base patterns, and a character BiLSTM-CRF that adds spans.

The model learns what spans look like, from windows that the base patterns label and from copies
rewritten in ways that the patterns do not know (other separators, a phone without plus, an
at sign in brackets). Whether a span's digits pass the check of its kind is tested afterwards. Texts are cut into overlapping windows; each window is decoded, and
the spans of all windows of a text are reconciled: spans cut by a window's edge give way to
whole ones, or are joined where no window sees them whole, central ones win, and what
remains does not overlap.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm import bilstm
from millrace.llm.arrow import extended, fresh, slices, without
from millrace.llm.words import Taken

KINDS = ("email", "ip", "card", "phone")
WIDTH, STRIDE = 64, 32
#: Tag 0 is outside; kind k has tags 1 + 2k (first character) and 2 + 2k (others).
TAGS = 1 + 2 * len(KINDS)
ALLOWED = np.array([[not t or t % 2 == 1 or f in (t - 1, t) for t in range(TAGS)] for f in range(TAGS)])
#: Each valid span holds one of these, so windows without any need no decoding.
TRIGGER = re.compile(r"[0-9@]|[(\[]at[)\]]")
#: A training window as it is, and rewritten.
COPIES = 4
#: Windows that are decoded at once.
DECODED = 2048

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# A run of digits can only match from its start, so looking behind changes nothing but time.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_DIGITS = frozenset("0123456789")
_REST = re.compile(r"[A-Za-z0-9-]*(?:\.[A-Za-z0-9-]+)*")
_NUMBER = re.compile("[0-9]*")
#: How far a span is completed at either end; no address has more characters.
REACH = 320
_DATE = re.compile(
    r"(?:[0-9]{4}([ .\x2f-])[0-9]{1,2}\1[0-9]{1,2}|[0-9]{1,2}([ .\x2f-])[0-9]{1,2}\2[0-9]{4})(?: [0-9. ]*)?"
)

Span = tuple[int, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for at, c in enumerate(reversed(digits)):
        value = int(c) * (1 + at % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def digits_in(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local part, at sign and domain, in time linear in the text."""
    done, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in _LOCAL:
            begin -= 1
        if begin < at and (domain := _DOMAIN.match(text, at + 1)):
            done = domain.end()
            yield begin, done
        at = text.find("@", max(at + 1, done))


def _valid_ip(text: str) -> bool:
    parts = text.split(".")
    return len(parts) == 4 and all(len(p.lstrip("0")) <= 3 and p and int(p.lstrip("0") or 0) <= 255 for p in parts)


def shaped_spans(text: str) -> list[Span]:
    """(kind, begin, end) by kind, then begin: leftmost matches of the right length."""
    found = [(0, b, e) for b, e in _emails(text)]
    found += [(1, *m.span()) for m in _IP.finditer(text)]
    found += [(2, *m.span()) for m in _CARD.finditer(text) if 16 <= len(digits_in(m[0])) <= 19]
    found += [(3, *m.span()) for m in _PHONE.finditer(text) if 8 <= len(digits_in(m[0])) <= 15]
    return found


def base_spans(text: str) -> list[Span]:
    """Those of ``shaped_spans`` that also pass their kind's check."""

    def passes(kind: int, value: str) -> bool:
        return (kind != 1 or _valid_ip(value)) and (kind != 2 or luhn(digits_in(value)))

    return [(k, b, e) for k, b, e in shaped_spans(text) if passes(k, text[b:e])]


def valid(kind: int, text: str) -> bool:
    """Whether a span that the model proposes can be of its kind."""
    digits = digits_in(text)
    if kind == 0:
        return bool(re.fullmatch(r"[\w.%+-]+ ?(?:@|\(at\)|\[at\]) ?[\w-]+(?: ?\. ?[\w-]+)+", text))
    if kind == 1:
        return _valid_ip(re.sub(r" ?\. ?", ".", text)) and bool(re.fullmatch(r"[0-9. ]+", text))
    if kind == 2:
        return 16 <= len(digits) <= 19 and luhn(digits) and bool(re.fullmatch(r"[0-9][0-9 ./_-]*[0-9]", text))
    if _DATE.fullmatch(text):
        return False
    whole = re.fullmatch(r"(?:\+|00|\()?[0-9][0-9 ().\x2f-]*[0-9]", text)
    # Without a plus, groups have to be set apart, or any long number would do.
    return 8 <= len(digits) <= 15 and bool(whole) and (text[0] == "+" or len(re.findall("[0-9]+", text)) > 2)


def _rewritten(kind: int, text: str, number: int) -> str:
    """A span's text in a form that the base patterns do not know."""
    if kind == 0:
        return text.replace("@", ("(at)", "[at]", " @ ")[number % 3])
    if kind == 1:
        return text.replace(".", (" . ", ". ")[number % 2])
    if kind == 2:
        between = (".", "/", "  ", "_")[number % 4]
        digits = digits_in(text)
        return between.join(digits[k : k + 4] for k in range(0, len(digits), 4))
    bare = text.lstrip("+")
    return ("00" + bare, bare.replace(" ", ".", 1), bare)[number % 3]


def training_windows(df: DataFrame, text: str = "text", max_windows: int = 1500) -> list[tuple[str, int, int, int]]:
    """(window, kind, begin, end) around base spans, and with kind -1 around other triggers.

    At most ``max_windows``, a fifth of each kind, those of smallest hash, so that they are the same
    whatever the order of rows; of windows without a span one in eight by another hash enters.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "source"):
            out = []
            for source in batch.column("source").to_pylist():
                text = source.decode("utf-8", "replace")
                spans = shaped_spans(text)
                near = Taken([(b, e) for _, b, e in spans])
                for kind, begin, end in spans:
                    # A span longer than a window is trained as far as the window goes.
                    low = max(0, begin - (7 * begin) % max(WIDTH - (end - begin), 16))
                    out.append((text[low : low + WIDTH], kind, begin - low, min(end - low, WIDTH)))
                for m in TRIGGER.finditer(text):
                    low = max(0, m.start() - WIDTH // 2)
                    window = text[low : low + WIDTH]
                    if crc32(window.encode()) % 8 == 0 and near.free(low, low + WIDTH):
                        out.append((window, -1, 0, 0))
            if out:
                types = (pa.string(), pa.int32(), pa.int32(), pa.int32())
                columns = [pa.array(v, t) for v, t in zip(zip(*out, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["window", "kind", "begin", "end"])

    source = df.select(F.col(f"`{text}`").alias("t")).filter(F.col("t").rlike("[0-9@]"))
    windows = source.select(F.col("t").cast("binary").alias("source")).mapInArrow(
        run, "window string, kind int, begin int, end int"
    )
    # No kind, nor the windows without a span, may crowd out the others. Each task passes on
    # as many windows of a kind as may be chosen.
    by_hash = Window.partitionBy("kind").orderBy(F.xxhash64("window", "begin"), "window", "begin", "end")
    chosen = windows.distinct().withColumn("_nth", F.row_number().over(by_hash))
    chosen = chosen.filter(F.col("_nth") <= max_windows // (len(KINDS) + 1)).orderBy("kind", "_nth")
    return [tuple(row) for row in chosen.drop("_nth").collect()]


def train(df: DataFrame, text: str = "text", max_windows: int = 1500) -> dict[str, np.ndarray] | None:
    """Model parameters, or None where no window has a base span.

    The windows are a bounded sample (``max_windows``) that is collected; the parameters
    have a fixed size.
    """
    windows = training_windows(df, text, max_windows)
    if not any(kind >= 0 for _, kind, _, _ in windows):
        return None
    codes = np.zeros((COPIES * len(windows), WIDTH), np.int64)
    tags = np.zeros(codes.shape, np.int64)
    for number, (window, kind, begin, end) in enumerate(windows):
        spans = shaped_spans(window)
        for copy in range(COPIES):
            row, source, marked = COPIES * number + copy, window, spans
            if copy and kind >= 0:
                other = _rewritten(kind, window[begin:end], number + copy)
                shift = len(other) - (end - begin)
                source = window[:begin] + other + window[end:]
                marked = [(k, b + shift * (b > begin), e + shift * (e >= end)) for k, b, e in spans]
            # Some copies end soon after the span, as short texts do.
            limit = WIDTH if copy < 2 or kind < 0 else min(WIDTH, end + shift + number % 12)
            chars = bilstm.codes_of(source[:limit])
            codes[row, : len(chars)] = chars
            for k, b, e in marked:
                tags[row, b : min(e, limit)] = 2 + 2 * k
                if b < limit:
                    tags[row, b] = 1 + 2 * k
    return bilstm.fitted(codes, tags, TAGS)


#: (begin, end, kind, edge) of a span in the text; edge is how far it stays from where its window is cut.
Proposal = tuple[int, int, int, float]


def added_spans(text: str, base: list[Span], model: dict[str, np.ndarray]) -> list[Span]:
    """Reconciled spans of all windows of a text that do not overlap a base span.

    A span that a window cuts is followed into the next windows and joined with what they
    see of it; if the joined one fits a window, it is also decoded in the middle of one.
    """
    starts = set()
    for m in TRIGGER.finditer(text):
        cell = m.start() // STRIDE * STRIDE
        starts |= {cell, max(0, cell - STRIDE)}
    proposed: list[Proposal] = []
    seen: set[int] = set()
    while starts:
        seen |= starts
        more = set()
        for low, proposal in _decoded(text, sorted(starts), model):
            proposed.append(proposal)
            begin, end, _, _ = proposal
            if begin == low and low:
                more.add(low - STRIDE)
            if end == low + WIDTH and end < len(text):
                more.add(low + STRIDE)
        starts = more - seen
    joined = _joined(proposed)
    centres = {max(0, (b + e - WIDTH) // 2) for b, e, _, _ in joined if e - b < WIDTH} - seen
    proposed += joined + [proposal for _, proposal in _decoded(text, sorted(centres), model)]
    taken, added = Taken([(b, e) for _, b, e in base]), []
    for _, begin, minus_end, kind in sorted((-edge, b, -e, k) for b, e, k, edge in proposed):
        begin, end = _trimmed(text, begin, -minus_end)
        if end <= begin or not taken.free(begin, end):
            continue
        begin, end = _whole(text, kind, begin, end)
        if valid(kind, text[begin:end]) and taken.take(begin, end):
            added.append((kind, begin, end))
    return added


def _decoded(text: str, starts: list[int], model: dict[str, np.ndarray]) -> Iterator[tuple[int, Proposal]]:
    """Start of the window and proposal, for the windows that start there."""
    chars = bilstm.codes_of(text) if starts and len(text) < 4096 else None
    for at in range(0, len(starts), DECODED):
        part = starts[at : at + DECODED]
        codes = np.zeros((len(part), WIDTH), np.int64)
        for row, low in enumerate(part):
            own = bilstm.codes_of(text[low : low + WIDTH]) if chars is None else chars[low : low + WIDTH]
            codes[row, : len(own)] = own
        for low, path in zip(part, bilstm.best_paths(model, codes, ALLOWED), strict=True):
            for kind, begin, end in _spans_of(path.tolist()):
                edge = min(begin if low else WIDTH, WIDTH - end if low + WIDTH < len(text) else WIDTH)
                yield low, (low + begin, min(low + end, len(text)), kind, edge)


def _joined(proposed: list[Proposal]) -> list[Proposal]:
    """Unions of proposals of one kind that overlap or touch, where a window cuts one of them.

    They come before spans that are cut and after whole ones.
    """
    out = []
    for kind in range(len(KINDS)):
        union = None
        for begin, end, _, edge in [*sorted(p for p in proposed if p[2] == kind), (1 << 62, 1 << 62, kind, 1)]:
            # Two whole spans that touch are two.
            if union and (begin < union[1] or begin == union[1] and 0 in (edge, union[2])):
                last = edge if end > union[1] else min(edge, union[2]) if end == union[1] else union[2]
                union = (union[0], max(union[1], end), last, union[3] + 1, union[4] or edge == 0)
                continue
            if union and union[3] > 1 and union[4]:
                out.append((union[0], union[1], kind, 0.5))
            union = (begin, end, edge, 1, edge == 0)
    return out


def _trimmed(text: str, begin: int, end: int) -> tuple[int, int]:
    while begin < end and text[begin] in " \n\t.,;:":
        begin += 1
    while end > begin and text[end - 1] in " \n\t.,;:-":
        end -= 1
    return begin, end


def _whole(text: str, kind: int, begin: int, end: int) -> tuple[int, int]:
    """The span with the rest of the word or number that it begins or ends in."""
    before = _LOCAL if kind == 0 else _DIGITS
    least, most = max(0, begin - REACH), min(len(text), end + REACH)
    if text[begin] in before:
        while begin > least and text[begin - 1] in before:
            begin -= 1
    if text[end - 1] in before:
        end = (_REST if kind == 0 else _NUMBER).match(text, end, most).end()
    return begin, end


def _spans_of(path: list[int]) -> list[Span]:
    spans, begin = [], None
    for at, tag in enumerate([*path, 0]):
        if begin is not None and tag != kind * 2 + 2:
            spans.append((kind, begin, at))
            begin = None
        if tag % 2:
            begin, kind = at, tag // 2
    return spans


def find_spans(df: DataFrame, model: dict[str, np.ndarray] | None, text: str = "text") -> DataFrame:
    """Add ``spans``, an array of (kind, begin, end, base) by kind as in ``KINDS``, then begin.

    Offsets are code points, ends exclusive. Base spans of different kinds may overlap; spans that the
    model adds overlap nothing. Null and empty texts have no spans; repeated rows get the same
    ones. Bytes that are no UTF-8 count as U+FFFD. An existing column ``spans`` is replaced, others stay. A window without a digit or an at sign is not decoded, since
    no span without one is valid.
    """
    kept = without(df, "spans")
    struct = "struct<kind: string, begin: bigint, end: bigint, base: boolean>"
    bytes_column = fresh(kept, "_source_bytes")
    schema = extended(kept, f"spans array<{struct}>")
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("kind", pa.string()), ("begin", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])
        for batch in slices(batches, bytes_column):
            out = []
            for source in batch.column(bytes_column).to_pylist():
                value = source.decode("utf-8", "replace") if source else ""
                if not TRIGGER.search(value):
                    out.append([])
                    continue
                base = base_spans(value)
                more = added_spans(value, base, shared.value) if shared.value else []
                spans = sorted([(*s, True) for s in base] + [(*s, False) for s in more])
                out.append([{"kind": KINDS[k], "begin": b, "end": e, "base": own} for k, b, e, own in spans])
            batch = batch.drop_columns([bytes_column])
            yield batch.append_column("spans", pa.array(out, pa.list_(kind)))

    source = kept.withColumn(bytes_column, F.col(f"`{text}`").cast("binary"))
    return source.mapInArrow(run, schema)


def redact(df: DataFrame, text: str = "text") -> DataFrame:
    """Put ``[kind]`` in place of each of the ``spans``; those that overlap become one.

    A text without spans stays as it is, null too.
    """
    ordered = F.expr(
        "array_sort(spans, (a, b) -> case when a.begin < b.begin then -1 when a.begin > b.begin then 1 "
        "when a.end > b.end then -1 when a.end < b.end then 1 else 0 end)"
    )
    # State: text so far, and the code point up to which the source is used.
    name = fresh(df, "_ordered")
    step = f"""aggregate(`{name}`, named_struct('out', cast('' as string), 'at', 0L), (s, x) ->
        if(x.begin < s.at, named_struct('out', s.out, 'at', greatest(s.at, x.end)),
           named_struct('out', concat(s.out, substring(`{text}`, int(s.at + 1), int(x.begin - s.at)), '[', x.kind, ']'),
                        'at', x.end)),
        s -> concat(s.out, substring(`{text}`, int(s.at + 1))))"""
    changed = F.when(F.size("spans") > 0, F.expr(step)).otherwise(F.col(f"`{text}`"))
    return df.withColumn(name, ordered).withColumn(text, changed).drop(name)
