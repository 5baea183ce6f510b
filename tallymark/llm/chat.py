"""Chat formatting with a grammar round trip.

A turn is rendered as opener, text, closer. A deterministic parser reads rendered turns
back; where the plain rendering is not read back as it was (its text holds a control
string or the escape sign), the text is escaped and parsed again. The parser undoes escapes
always, so no flag is needed. Rendering is per turn and parsing is left to right, so a
conversation is worked through as a stream, never held as a whole.

Defined results: null role or text counts as empty; turns are ordered by turn, then role,
then text, nulls first, so ties and repeated rows have one order and repeated rows are
turns of their own; a null conv_id is a conversation of its own; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# The control strings of the template.
USER_OPEN, USER_CLOSE = "[INST] ", " [/INST]"
ANSWER_OPEN, ANSWER_CLOSE = "<s>", "</s>"
OTHER_OPEN, OTHER_MIDDLE, OTHER_CLOSE = "<<SYS>>", "<<:>>", "<</SYS>>"
ESCAPE = "\\"

CONTROL = re.compile(r"\[INST\]|\[/INST\]|</?s>|<</?SYS>>|<<:>>")
_SPECIAL = re.compile(r"[\\<\[]")


class NotATurn(ValueError):
    """The parser met text that the grammar does not allow here."""


def escape(text: str) -> str:
    return _SPECIAL.sub(lambda m: ESCAPE + m[0], text)


def _scan(rendered: str, at: int, closer: str) -> tuple[str, int]:
    """Text up to the unescaped ``closer``, with escapes undone, and where the closer ends."""
    parts = []
    while at < len(rendered):
        m = _SPECIAL.search(rendered, at)
        stop = m.start() if m else len(rendered)
        if closer[0] not in "<[":  # its first character is a plain one
            found = rendered.find(closer, at, stop + len(closer) - 1)
            if 0 <= found < stop:
                return "".join([*parts, rendered[at:found]]), found + len(closer)
        if m is None:
            break
        parts.append(rendered[at:stop])
        if m[0] == ESCAPE:
            if stop + 1 == len(rendered):
                break
            parts.append(rendered[stop + 1])
            at = stop + 2
            continue
        if rendered.startswith(closer, stop):
            return "".join(parts), stop + len(closer)
        if CONTROL.match(rendered, stop):
            raise NotATurn(f"control string at {stop}")
        parts.append(m[0])
        at = stop + 1
    raise NotATurn("no closer")


def parse(rendered: str) -> Iterator[tuple[str, str]]:
    """The (role, text) turns of a rendered text; NotATurn where it does not follow the grammar."""
    at = 0
    while at < len(rendered):
        if rendered.startswith(USER_OPEN, at):
            text, at = _scan(rendered, at + len(USER_OPEN), USER_CLOSE)
            yield "user", text
        elif rendered.startswith(ANSWER_OPEN, at):
            text, at = _scan(rendered, at + len(ANSWER_OPEN), ANSWER_CLOSE)
            yield "assistant", text
        elif rendered.startswith(OTHER_OPEN, at):
            role, at = _scan(rendered, at + len(OTHER_OPEN), OTHER_MIDDLE)
            text, at = _scan(rendered, at, OTHER_CLOSE)
            yield role, text
        else:
            raise NotATurn(f"no opener at {at}")


def _framed(role: str, text: str, escaped_role: str) -> str:
    if role == "user":
        return f"{USER_OPEN}{text}{USER_CLOSE}"
    if role == "assistant":
        return f"{ANSWER_OPEN}{text}{ANSWER_CLOSE}"
    return f"{OTHER_OPEN}{escaped_role}{OTHER_MIDDLE}{text}{OTHER_CLOSE}"


def render(role: str, text: str) -> str:
    """One rendered turn that parses back to exactly ``(role, text)``."""
    for form, name in ((text, role), (escape(text), escape(role))):
        rendered = _framed(role, form, name)
        try:
            if list(parse(rendered)) == [(role, text)]:
                return rendered
        except NotATurn:
            continue
    raise AssertionError("an escaped turn always parses back")


def format_turns(conversations: DataFrame) -> DataFrame:
    """Per turn: conv_id, turn, and the rendered turn; a conversation's text is these in order."""

    @F.pandas_udf("string")
    def rendered(roles, texts):
        return roles.combine(texts, lambda role, text: render(role, text))

    return conversations.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("rendered", rendered("role", "text"))


class _Reader:
    """Digests of one conversation, read back turn by turn from its rendered text."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.turns = self.loss = self.chars = 0
        self.turns_hash, self.loss_hash = hashlib.sha256(), hashlib.sha256()

    def feed(self, rendered: str) -> None:
        self.chars += len(rendered)
        for role, text in parse(rendered):
            self.turns += 1
            self.turns_hash.update(f"{role}\n{text}\n".encode())
            if role == "assistant":  # the loss mask covers what the assistant says
                self.loss += len(text)
                self.loss_hash.update(text.encode())


def chat_digests(conversations: DataFrame) -> DataFrame:
    """Per conversation, read back from the rendered text: turns, their digest, the masked text's, lengths."""
    fields = pa.schema(
        [
            ("conv_id", pa.int64()),
            ("n_turns", pa.int64()),
            ("turns_sha256", pa.string()),
            ("loss_chars", pa.int64()),
            ("loss_sha256", pa.string()),
            ("formatted_chars", pa.int64()),
        ]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: _Reader | None = None
        for batch in batches:
            done = []
            for conv_id, rendered in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if current is None or current.conv_id != conv_id:
                    if current is not None:
                        done.append(current)
                    current = _Reader(conv_id)
                current.feed(rendered)
            yield _rows(done)
        if current is not None:
            yield _rows([current])

    def _rows(readers):
        return pa.RecordBatch.from_pylist(
            [
                {
                    "conv_id": r.conv_id,
                    "n_turns": r.turns,
                    "turns_sha256": r.turns_hash.hexdigest(),
                    "loss_chars": r.loss,
                    "loss_sha256": r.loss_hash.hexdigest(),
                    "formatted_chars": r.chars,
                }
                for r in readers
            ],
            schema=fields,
        )

    # Spark sorts (and spills) the turns; a task then reads them as a stream with one open conversation.
    return (
        format_turns(conversations)
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .select("conv_id", "rendered")
        .mapInArrow(
            work,
            "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, "
            "loss_sha256 string, formatted_chars bigint",
        )
    )
