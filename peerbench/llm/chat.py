"""Chat formatting with a grammar that is parsed back.

A conversation is `<s>` and its turns. A user's turn is `[INST] text [/INST]`, an assistant's
` text </s>`, any other role's `<<TURN role>> text <</TURN>>` with the role percent-encoded. A text
reaches to the first control string, which must be its turn's end, so no control string may stand in
a text as it is. Each turn is rendered, parsed, and compared with its source; where they differ its
control strings get one more backslash after their first character, and the parser takes one away.
That is reversible for texts that hold such backslashes already.

A turn needs only itself; the order of turns is needed for offsets and digests. Rows are dealt by
conversation and sorted, then streamed: a task holds one turn and a running state, so a conversation
of any length costs no more memory (a digest over a whole conversation is one sequence by nature).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple
from urllib.parse import quote, unquote

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START = "<s>"
USER = ("[INST] ", " [/INST]")
ASSISTANT = (" ", " </s>")
OTHER = ("<<TURN ", ">> ", " <</TURN>>")
# Control strings: a first character and a rest, with backslashes between where they are escaped.
_REST = r"(?:(<)(\\*)(/?s>|<TURN |</TURN>>)|(\[)(\\*)(/?INST\]))"
_ANY = re.compile(_REST)
_PLAIN = re.compile(r"<(?:/?s>|<TURN |</TURN>>)|\[/?INST\]")
FORMATTED = "conv_id long, seq long, role string, piece string, start long, loss_start long, loss_end long"
DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


class Turn(NamedTuple):
    role: str
    text: str
    loss: tuple[int, int] | None  # span of an assistant's text in the piece, as it is escaped
    end: int


def escape(text: str) -> str:
    return _ANY.sub(lambda m: f"{m[1] or m[4]}\\{m[2] or m[5] or ''}{m[3] or m[6]}", text)


def unescape(text: str) -> str:
    return _ANY.sub(lambda m: f"{m[1] or m[4]}{(m[2] or m[5] or '')[1:]}{m[3] or m[6]}", text)


def _wrap(role: str, text: str) -> str:
    if role == "user":
        return f"{USER[0]}{text}{USER[1]}"
    if role == "assistant":
        return f"{ASSISTANT[0]}{text}{ASSISTANT[1]}"
    return f"{OTHER[0]}{quote(role, safe='')}{OTHER[1]}{text}{OTHER[2]}"


def parse_turn(s: str, at: int = 0) -> Turn | None:
    """The turn that starts at `at`; None where the grammar has none there."""
    if s.startswith(USER[0], at):
        role, begin, close = "user", at + len(USER[0]), USER[1]
    elif s.startswith(OTHER[0], at):
        mid = s.find(OTHER[1], at)
        if mid < 0:
            return None
        role, begin, close = unquote(s[at + len(OTHER[0]) : mid]), mid + len(OTHER[1]), OTHER[2]
    elif s.startswith(ASSISTANT[0], at):
        role, begin, close = "assistant", at + len(ASSISTANT[0]), ASSISTANT[1]
    else:
        return None
    control = _PLAIN.search(s, begin)
    if control is None or control.start() - 1 < begin or not s.startswith(close, control.start() - 1):
        return None
    stop = control.start() - 1
    return Turn(role, unescape(s[begin:stop]), (begin, stop) if role == "assistant" else None, stop + len(close))


def render_turn(role: str, text: str) -> str:
    """The turn as text; it is escaped only if it can't be read back without."""
    raw = _wrap(role, text)
    back = parse_turn(raw)
    if back is not None and (back.role, back.text, back.end) == (role, text, len(raw)):
        return raw
    safe = _wrap(role, escape(text))
    back = parse_turn(safe)
    if back is None or (back.role, back.text, back.end) != (role, text, len(safe)):
        raise ValueError("a turn can't be read back")
    return safe


def _streamed(chats: DataFrame, cols: tuple[str, str, str, str]) -> DataFrame:
    conv, turn, role, text = (F.col(c) for c in cols)
    # Ids travel as text: pandas has no integer column with nulls.
    return (
        chats.select(
            conv.cast("long").cast("string").alias("conv"),
            turn.alias("turn"),
            F.coalesce(role, F.lit("")).alias("role"),
            F.coalesce(text, F.lit("")).alias("text"),
        )
        .repartition("conv")
        .sortWithinPartitions("conv", "turn", "role", "text")
        .select("conv", "role", "text")
    )


def format_chats(
    chats: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """One row per turn: FORMATTED. A conversation's text is its pieces joined by `seq`.

    start is the piece's offset in that text, loss_start and loss_end the span of an assistant's
    text. Turns stand in the order of turn (nulls first), then role, then text, so repeated rows are
    turns of their own, in a fixed order. Null role and null text are empty ones; rows without a
    conversation id are one conversation. An empty table gives no rows; other columns are ignored.
    """

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, seq, at = object(), 0, 0
        for batch in batches:
            out = []
            for conv, role, text in batch.itertuples(index=False, name=None):
                lead = ""
                if conv != current:
                    current, seq, at, lead = conv, 0, 0, START
                piece = lead + render_turn(role, text)
                loss = parse_turn(piece, len(lead)).loss or (None, None)
                spans = [None if x is None else at + x for x in loss]
                out.append((conv, seq, role, piece, at, *spans))
                seq, at = seq + 1, at + len(piece)
            yield _frame(out, FORMATTED)

    return _streamed(chats, (conv_col, turn_col, role_col, text_col)).mapInPandas(pieces, FORMATTED)


def digests(formatted: DataFrame) -> DataFrame:
    """Reads formatted conversations back by the grammar and the loss spans: DIGESTS per conversation.

    The rows of a conversation must stand together in order, as `format_chats` gives them.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state = None
        for batch in batches:
            out = []
            ids = batch["conv_id"].astype("Int64").astype(object).where(batch["conv_id"].notna(), None)
            for conv, piece, start, a, b in zip(
                ids, batch["piece"], batch["start"], batch["loss_start"], batch["loss_end"], strict=True
            ):
                if state is None or state.conv != conv:
                    if state is not None:
                        out.append(state.row())
                    state = _Digest(conv)
                state.feed(piece, None if pd.isna(a) else (int(a) - start, int(b) - start))
            yield _frame(out, DIGESTS)
        if state is not None:
            yield _frame([state.row()], DIGESTS)

    return formatted.mapInPandas(read, DIGESTS)


class _Digest:
    def __init__(self, conv: int | None):
        self.conv, self.n, self.chars, self.loss_chars = conv, 0, 0, 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def feed(self, piece: str, span: tuple[int, int] | None) -> None:
        at = 0 if self.n else len(START)
        if not self.n and not piece.startswith(START):
            raise ValueError("a conversation doesn't begin with its mark")
        while at < len(piece):
            turn = parse_turn(piece, at)
            if turn is None:
                raise ValueError("formatted text doesn't parse")
            self.turns.update(f"{turn.role}\n{turn.text}\n".encode())
            self.n, at = self.n + 1, turn.end
        if span is not None:
            text = unescape(piece[span[0] : span[1]])
            self.loss.update(text.encode())
            self.loss_chars += len(text)
        self.chars += len(piece)

    def row(self) -> tuple:
        return (self.conv, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars)


def _frame(rows: list[tuple], schema: str) -> pd.DataFrame:
    kinds = dict(x.split() for x in schema.split(", "))
    out = pd.DataFrame(rows, columns=list(kinds), dtype=object)
    if "conv_id" in out:
        out["conv_id"] = [None if x is None else int(x) for x in out["conv_id"]]
    return out.astype({c: "Int64" for c, k in kinds.items() if k == "long"})
