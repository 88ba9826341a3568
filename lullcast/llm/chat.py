"""Chat formatting by incremental black-box rendering.

A template is any function from messages to one string. Successive prefixes of the turns
are rendered and consecutive outputs compared: what the longer adds is the span of its last
turn. Where a longer prefix does not begin with the shorter one's output, the template
rewrites history, and the conversation is marked.

Conversations stream through sorted partitions. Every prefix is rendered as a whole, however
long: a template is a black box, so the work grows with the square of a conversation's length.

A caller may give a ``window`` of turns. Then prefixes of longer conversations begin with the
first turns and the latest ones; the last turn known is rendered anew in the shorter context, and
where its span differs, the conversation is marked as well. Besides, the whole history is
rendered whenever its length has doubled, and at its end, and compared with all spans so far.
Of a conversation with more than HELD_CHARS characters the history is kept in a file until then;
such a one is told by ``windowed``.
"""

from __future__ import annotations

import hashlib
import pickle
import re
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

Message = tuple[str, str]
Template = Callable[[list[Message]], str]

HEAD = 2
#: Characters of a conversation whose history a task holds in memory beside a window.
HELD_CHARS = 1 << 26
OPEN, BODY, CLOSE = "<|turn|>", "<|body|>", "<|end|>"
#: Control strings of this template and of common ones; inside texts they are broken up.
CONTROL = (OPEN, BODY, CLOSE, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
           "<|im_start|>", "<|im_end|>", "<|endoftext|>")
_CONTROL = re.compile("|".join(map(re.escape, CONTROL)))
_FIRST = tuple({c[0] for c in CONTROL})
_ESCAPE = re.compile(r"\\([\\.])")
LEARNT_ROLE = "assistant"


def escape(text: str) -> str:
    """``text`` without control strings: a backslash is doubled, and ``\\.`` goes after the
    first character of a control string."""
    if "\\" in text:
        text = text.replace("\\", "\\\\")
    if not any(c in text for c in _FIRST):
        return text
    return _CONTROL.sub(lambda m: f"{m[0][0]}\\.{m[0][1:]}", text)


def unescape(text: str) -> str:
    return _ESCAPE.sub(lambda m: "\\" if m[1] == "\\" else "", text) if "\\" in text else text


def marked_turns(messages: list[Message]) -> str:
    """The template of the registered query: every turn marked, texts escaped."""
    return "".join(f"{OPEN}{escape(role)}{BODY}{escape(text)}{CLOSE}" for role, text in messages)


class Renderer:
    """Renders one conversation turn by turn: every prefix whole or, given a ``window``, what
    the window holds of it."""

    def __init__(self, template: Template, window: int | None = None, held_chars: int = HELD_CHARS):
        self.template = template
        self.window = None if window is None else max(window, HEAD + 2)
        self.messages: list[Message] = []
        self.shown = template([])
        self.opening = self.shown
        self.rewrites = False
        self.history: list[Message] | None = []
        self.chars, self.held_chars, self.turns = 0, held_chars, 0
        self.due = 2 * (self.window or 0)
        self.spans = hashlib.sha256(_bytes(self.opening))

    @property
    def windowed(self) -> bool:
        return self.history is None

    def add(self, message: Message) -> tuple[str, int, int]:
        """What ``message`` adds to the output: its span, and where in it the text begins
        and how long it is there (-1, 0 if the text is not in the span as a whole)."""
        if self.window and len(self.messages) >= self.window:
            self._shorten()
        longer = self.template([*self.messages, message])
        begin = len(self.shown)
        if not longer.startswith(self.shown):
            self.rewrites = True
            begin = _common(self.shown, longer)
        span = longer[begin:]
        bare = self.template([*self.messages, (message[0], "")])[begin:]
        self.messages.append(message)
        self.shown = longer
        if self.window:
            self._remember(message, span)
        return span, *_text_in(span, bare, message[1])

    def _remember(self, message: Message, span: str) -> None:
        self.spans.update(_bytes(span))
        self.chars += len(message[0]) + len(message[1])
        self.turns += 1
        if self.history is None:
            pickle.dump(message, self.file)
        else:
            self.history.append(message)
            if self.chars > self.held_chars:
                self.file = tempfile.TemporaryFile()
                for one in self.history:
                    pickle.dump(one, self.file)
                self.history = None
        if self.turns >= self.due:
            self.due *= 2
            self.finish()

    def finish(self) -> bool:
        """Whether history was rewritten, the whole of it rendered once more if it is longer
        than a window."""
        if self.window and self.turns > self.window:
            whole = hashlib.sha256(_bytes(self.template(self._whole())))
            self.rewrites |= whole.digest() != self.spans.digest()
        return self.rewrites

    def _whole(self) -> list[Message]:
        if self.history is not None:
            return self.history
        self.file.seek(0)
        history = [pickle.load(self.file) for _ in range(self.turns)]
        self.file.seek(0, 2)
        return history

    def _shorten(self) -> None:
        last = self.messages[-1]
        known = self.template(self.messages)[len(self.template(self.messages[:-1])) :]
        kept = self.messages[:HEAD] + self.messages[-(self.window // 2) : -1]
        before, after = self.template(kept), self.template([*kept, last])
        if not after.startswith(before) or after[len(before) :] != known:
            self.rewrites = True
        self.messages, self.shown = [*kept, last], after


def _bytes(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def _common(a: str, b: str) -> int:
    """How many characters both begin with, found by halves."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def _text_in(span: str, bare: str, text: str) -> tuple[int, int]:
    """Where ``span`` holds ``text``, escaped or as it is; without it, it would be ``bare``."""
    shared, n = _common(span, bare), len(span) - len(bare)
    for form in (escape(text), text):
        at = span.rfind(form, 0, shared + n) if len(form) == n else -1
        if at >= 0 and span[at + n :] == bare[at:]:
            return at, n
    return -1, 0


def _rows(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple]:
    """Rows of Arrow batches, as Python's own values: integers stay integers beside nulls."""
    for batch in batches:
        yield from zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in names))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


SPANS = (
    "turn bigint, role string, start bigint, span string, text_at int, text_length int,"
    " learnt boolean, rewrites boolean, windowed boolean"
)
_LOT = 4096


def format_chat(
    conversations: DataFrame,
    template: Template = marked_turns,
    window: int | None = None,
    held_chars: int = HELD_CHARS,
) -> DataFrame:
    """One row per turn: conv_id, ``turn``, role, ``start`` of its span in the formatted
    conversation, ``span`` (the text it adds), ``text_at`` and
    ``text_length`` (where the span has the message's own text, escaped or not; -1 if it
    hasn't), ``learnt`` (that text counts for the loss), ``rewrites`` (history was rewritten
    so far) and ``windowed`` (the history beside a ``window`` is kept in a file).

    The formatted conversation is the spans in order, rows sorted by conv_id and turn
    within partitions. Null texts and roles are empty; a null conv_id is a conversation of
    its own; rows of equal turns are ordered by role, then text. A text of any length is one
    row. An empty table gives no rows; other columns are ignored. What a template puts before
    any turn belongs to the first span.
    """
    schema = StructType([conversations.schema["conv_id"], *StructType.fromDDL(SPANS)])
    arrow = to_arrow_schema(schema)

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        held, at, now, renderer, last = 0, 0, None, None, None
        for conv, turn, role, text in _rows(batches, ["conv_id", "turn", "role", "text"]):
            if renderer is None or conv != now:
                if last is not None:
                    out.append((*last[:-2], renderer.finish(), last[-1]))
                    last = None
                now, at, renderer = conv, 0, Renderer(template, window, held_chars)
                opening = renderer.opening
            if last is not None:
                out.append(last)
            span, inside, size = renderer.add((role, text))
            if opening:
                span, inside, opening = opening + span, inside + len(opening), ""
            learnt = role == LEARNT_ROLE and inside >= 0
            # held back, as the end of the conversation may tell that history was rewritten
            last = (conv, turn, role, at, span, inside, size, learnt, renderer.rewrites, renderer.windowed)
            at, held = at + len(span), held + len(span)
            if len(out) >= _LOT or held > 4 << 20:
                yield _batch(out, arrow)
                out, held = [], 0
        if last is not None:
            out.append((*last[:-2], renderer.finish(), last[-1]))
        yield _batch(out, arrow)

    rows = conversations.select(
        "conv_id",
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.mapInArrow(render, schema)


DIGEST = (
    "n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string,"
    " formatted_chars bigint, rewrites boolean"
)
_TURN = re.compile(f"{re.escape(OPEN)}(.*?){re.escape(BODY)}(.*?){re.escape(CLOSE)}", re.DOTALL)


def read_back(formatted: DataFrame) -> DataFrame:
    """What the spans of ``format_chat`` say, one row per conversation, streamed in order:
    hashes are fed turn by turn, so a very long conversation takes no more memory."""
    schema = StructType([formatted.schema["conv_id"], *StructType.fromDDL(DIGEST)])
    arrow = to_arrow_schema(schema)
    used = ["conv_id", "span", "text_at", "text_length", "learnt", "rewrites"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, out = None, None, []
        for conv, *turn in _rows(batches, used):
            if state is None or conv != now:
                if state is not None:
                    out.append(state.row(now))
                now, state = conv, _Read()
                if len(out) >= _LOT:
                    yield _batch(out, arrow)
                    out = []
            state.add(*turn)
        if state is not None:
            out.append(state.row(now))
        yield _batch(out, arrow)

    return formatted.mapInArrow(read, schema)


class _Read:
    def __init__(self) -> None:
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n = self.chars = self.length = 0
        self.rewrites = False

    def add(self, span: str, at: int, size: int, learnt: bool, rewrites: bool) -> None:
        for role, text in _TURN.findall(span):
            self.n += 1
            whole = f"{unescape(role)}\n{unescape(text)}\n"
            self.turns.update(_bytes(whole))
        if learnt:
            masked = unescape(span[at : at + size])
            self.chars += len(masked)
            self.loss.update(_bytes(masked))
        self.length += len(span)
        self.rewrites |= bool(rewrites)

    def row(self, conv) -> tuple:
        return (conv, self.n, self.turns.hexdigest(), self.chars, self.loss.hexdigest(), self.length, self.rewrites)
