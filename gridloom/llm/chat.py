"""Chat formatting: a declarative template, a finite-state machine over roles, and segments with loss flags.

A conversation becomes one text: a start mark, the escaped text and an end mark for each turn, in turn order. Segments say which
spans of it are trained on. Control strings inside a text get a backslash after their first character and backslashes are
doubled, which is undone exactly, so no text can open or close a turn. The machine walks the roles and says whether they come in an
allowed order; it formats a conversation in any order and reports the first turn that broke it.

Rows stream through one task a conversation and leave it in chunks of bounded size, so neither formatting nor reading back
holds a whole conversation; one chunk is the usual case and needs no second shuffle to be read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Marks by role, whether the role's text is trained on, and which roles may follow which state. Roles not listed use `other`.
TEMPLATE = {
    "roles": {
        "system": {"open": "<<SYS>>\n", "close": "\n<</SYS>>\n", "loss": False},
        "user": {"open": "[INST] ", "close": " [/INST]", "loss": False},
        "assistant": {"open": "<s> ", "close": " </s>", "loss": True},
    },
    "other": {"open": "[ROLE={role}] ", "close": " [/ROLE]", "loss": False},
    "controls": ["<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "<s>", "</s>", "[ROLE=", "[/ROLE]"],
    "next": {"start": ["system", "user"], "system": ["user"], "user": ["assistant"], "assistant": ["user"]},
    "final": ["assistant"],
}
FORMATTED = "conv_id long, chunk int, last boolean, n_turns long, valid boolean, broken_at long, text string, segments array<struct<start:int,stop:int,loss:boolean>>"


def escape(text: str, controls: list[str]) -> str:
    text = text.replace("\\", "\\\\")
    return re.sub("|".join(map(re.escape, controls)), lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: m[1], text, flags=re.S)


class Turns:
    """The machine: step() takes a role and gives its marks; broken_at is the place of the first turn out of order, or -1."""

    def __init__(self, template: dict):
        self.template, self.state, self.n, self.broken_at = template, "start", 0, -1

    def step(self, role: str) -> tuple[str, str, bool]:
        if self.broken_at < 0 and role not in self.template["next"].get(self.state, ()):
            self.broken_at = self.n
        self.state, self.n = role, self.n + 1
        marks = self.template["roles"].get(role)
        if marks is None:
            marks = self.template["other"]
            return marks["open"].replace("{role}", quote(role, safe="")), marks["close"], marks["loss"]
        return marks["open"], marks["close"], marks["loss"]

    def valid(self) -> bool:
        return self.broken_at < 0 and self.state in self.template["final"]


class _Chunks:
    """Gathers the turns of one conversation and gives rows of FORMATTED."""

    def __init__(self, conv: int | None, template: dict):
        self.conv, self.turns, self.chunk = conv, Turns(template), 0
        self.clear()

    def clear(self) -> None:
        self.text, self.length, self.segments = [], 0, []

    def add(self, role: str, text: str) -> None:
        opened, closed, loss = self.turns.step(role)
        for piece, on in ((opened, False), (escape(text, self.turns.template["controls"]), loss), (closed, False)):
            self.segments.append({"start": self.length, "stop": self.length + len(piece), "loss": on})
            self.text.append(piece)
            self.length += len(piece)

    def row(self, last: bool) -> dict:
        out = {"conv_id": self.conv, "chunk": self.chunk, "last": last, "n_turns": self.turns.n, "valid": self.turns.valid() if last else None, "broken_at": self.turns.broken_at, "text": "".join(self.text), "segments": self.segments}
        self.chunk += 1
        self.clear()
        return out


_ARROW = pa.schema([("conv_id", pa.int64()), ("chunk", pa.int32()), ("last", pa.bool_()), ("n_turns", pa.int64()), ("valid", pa.bool_()), ("broken_at", pa.int64()), ("text", pa.string()), ("segments", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("loss", pa.bool_())])))])


def _flush(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def format_conversations(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", template: dict = TEMPLATE, chunk_chars: int = 1 << 20) -> DataFrame:
    """FORMATTED rows: each conversation in chunks of about chunk_chars characters, whole turns, with its segments.

    Turns are ordered by turn, nulls first, then role and text, so ties and repeated rows have one order; all are kept. Null texts
    and roles are empty. Null ids are one conversation. An empty table gives an empty result; other columns are ignored.
    """
    empty = F.lit("")
    rows = turns.select(F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), F.coalesce(F.col(role_col), empty).alias("role"), F.coalesce(F.col(text_col), empty).alias("text"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ready, held = None, [], 0
        for batch in batches:
            for conv, role, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3)):
                if now is None or now.conv != conv:
                    if now is not None:
                        held += now.length
                        ready.append(now.row(True))
                    now = _Chunks(conv, template)
                elif now.length >= chunk_chars:
                    held += now.length
                    ready.append(now.row(False))
                now.add(role, text.as_py())
                if held >= chunk_chars or len(ready) >= 1000:
                    yield _flush(ready, _ARROW)
                    ready, held = [], 0
        if now is not None:
            ready.append(now.row(True))
        if ready:
            yield _flush(ready, _ARROW)

    return rows.mapInArrow(run, FORMATTED)


def parse(text: str, template: dict = TEMPLATE) -> Iterator[tuple[str, str]]:
    """(role, text) of each turn of a formatted text, found by its marks alone."""
    head, tail = template["other"]["open"].split("{role}")
    opens = {m["open"]: (r, m["close"]) for r, m in template["roles"].items()}
    mark = re.compile("|".join([*map(re.escape, opens), re.escape(head) + r"(?P<role>[^\]]*)" + re.escape(tail)]))
    at = 0
    while at < len(text):
        m = mark.match(text, at)
        if m is None:
            raise ValueError("a turn does not begin with a mark")
        role, close = (unquote(m["role"]), template["other"]["close"]) if m["role"] is not None else opens[m[0]]
        end = text.index(close, m.end())
        yield role, unescape(text[m.end() : end])
        at = end + len(close)


class _Digest:
    def __init__(self, conv: int | None, template: dict):
        self.conv, self.template = conv, template
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n = self.loss_chars = self.chars = 0

    def add(self, text: str, segments: list[dict]) -> None:
        for role, said in parse(text, self.template):
            self.turns.update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
            self.n += 1
        for s in segments:
            if s["loss"]:
                trained = unescape(text[s["start"] : s["stop"]])
                self.loss.update(trained.encode("utf-8", "surrogatepass"))
                self.loss_chars += len(trained)
        self.chars += len(text)

    def row(self, valid: bool, broken_at: int) -> dict:
        return {"conv_id": self.conv, "n_turns": self.n, "turns_sha256": self.turns.hexdigest(), "loss_chars": self.loss_chars, "loss_sha256": self.loss.hexdigest(), "formatted_chars": self.chars, "valid": valid, "broken_at": broken_at}


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid boolean, broken_at long"
_DIGEST_ARROW = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("valid", pa.bool_()), ("broken_at", pa.int64())])


def digests(formatted: DataFrame, template: dict = TEMPLATE) -> DataFrame:
    """A row per conversation, from its chunks: turn and loss digests of what the marks and segments give back.

    Conversations of one chunk are read where they lie; only the chunks of longer ones are brought together, and streamed.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ready = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                conv, chunk, last, _, valid, broken, text, segments = (c[i].as_py() for c in batch.columns)
                if chunk == 0:
                    now = _Digest(conv, template)
                now.add(text, segments)
                if last:
                    ready.append(now.row(valid, broken))
            if ready:
                yield _flush(ready, _DIGEST_ARROW)
                ready = []

    short = F.col("last") & (F.col("chunk") == 0)
    long_ = formatted.where(~short).repartition("conv_id").sortWithinPartitions("conv_id", "chunk")
    return formatted.where(short).mapInArrow(run, DIGESTS).unionByName(long_.mapInArrow(run, DIGESTS))
