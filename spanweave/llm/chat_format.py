"""Chat formatting: a finite-state machine over roles and a declarative template.

The template names the control strings; a text that holds one, or the escape
character, gets an escape in front of it, so that reading back is exact. Rows
stream in the order of conversation and turn through the machine, which checks
the order of roles and emits one segment a piece of output, each with a flag
that says whether a loss falls on it. A conversation is never held as a whole.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanweave.llm.common import python_ready, table, text_or_empty


@dataclass(frozen=True)
class Template:
    """Control strings, the roles on whose texts a loss falls, and the machine's arrows."""

    headers: dict[str, str] = field(default_factory=lambda: {"system": "### System: ", "user": "### User: ", "assistant": "### Assistant: "})
    #: for any other role; the role itself follows, escaped, then other_end
    other: str = "### Role "
    other_end: str = ": "
    end: str = "</turn>\n"
    escape: str = "\\"
    loss: tuple[str, ...] = ("assistant",)
    start: str = "start"
    arrows: dict[str, tuple[str, ...]] = field(default_factory=lambda: {"start": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)})

    def guard(self) -> re.Pattern:
        """What needs an escape inside a text: the escape itself and the beginnings of control strings."""
        return re.compile("|".join(re.escape(x) for x in sorted({self.escape, "### ", self.end.rstrip("\n"), self.other_end}, key=len, reverse=True)))

    def escaped(self, text: str) -> str:
        return self.guard().sub(lambda m: self.escape + m[0], text)

    def reader(self) -> re.Pattern:
        """One control string, one escaped character or a run of plain ones."""
        names = [re.escape(h) for h in self.headers.values()] + [re.escape(self.other)]
        e = re.escape(self.escape)
        return re.compile(f"(?P<escaped>{e}(?P<char>.))|(?P<header>{'|'.join(names)})|(?P<end>{re.escape(self.end)})|(?P<sep>{re.escape(self.other_end)})|(?P<plain>[^{e}#<:]+|.)", re.S)


SEGMENTS = "segment long, kind string, text string, loss boolean, in_order boolean"
DIGEST = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, in_order boolean"


def format_chat(rows: DataFrame, template: Template = Template()) -> DataFrame:  # noqa: B008
    """Segments of all conversations of rows (conv_id, turn, role, text), in order within each partition.

    kind is header, text or end; in_order says whether the conversation's
    roles have followed the machine's arrows so far; nothing is dropped where
    they have not. Null texts and roles count as empty strings, a null turn
    comes first, rows of one turn stand in the order of role and text, and
    rows without conv_id are one conversation. Other columns aren't read. An
    empty table has no segments.
    """
    python_ready(rows.sparkSession)
    ordered = rows.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", text_or_empty("role").alias("role"), text_or_empty("text").alias("text")).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches):
        conv, state, number, fine, begun = None, template.start, 0, True, False
        for batch in batches:
            out = []
            for c, role, text in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3)), strict=True):
                if not begun or c != conv:
                    conv, state, number, fine, begun = c, template.start, 0, True, True
                fine = fine and role in template.arrows.get(state, ())
                state = role
                header = template.headers.get(role) or template.other + template.escaped(role) + template.other_end
                for kind, piece in (("header", header), ("text", template.escaped(text)), ("end", template.end)):
                    out.append((c, number, kind, piece, kind == "text" and role in template.loss, fine))
                    number += 1
            types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.bool_()]
            names = ["conv_id", "segment", "kind", "text", "loss", "in_order"]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(types)], names=names)

    return ordered.mapInArrow(run, f"conv_id long, {SEGMENTS}")


class Reader:
    """Reads a conversation back from its formatted text, piece by piece, keeping digests only."""

    def __init__(self, template: Template):
        self.t, self.token = template, template.reader()
        self.role_of = {h: r for r, h in template.headers.items()}
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0
        self.fine = True
        self.in_role, self.role = False, []

    def feed(self, text: str, loss: bool) -> None:
        self.chars += len(text)
        plain = []
        for m in self.token.finditer(text):
            kind = m.lastgroup
            if m["header"] is not None:
                self.in_role = m["header"] not in self.role_of
                self.role = [] if self.in_role else [self.role_of[m["header"]]]
                if not self.in_role:
                    self.open()
            elif m["end"] is not None:
                self.flush(plain, loss)
                self.turns.update(b"\n")
                self.n_turns += 1
            elif m["sep"] is not None and self.in_role:
                self.in_role = False
                self.open()
            else:
                (self.role if self.in_role else plain).append(m["char"] if m["char"] is not None else m[kind])
        self.flush(plain, loss)

    def open(self) -> None:
        self.turns.update(("".join(self.role) + "\n").encode("utf-8", "surrogatepass"))

    def flush(self, plain: list[str], loss: bool) -> None:
        text = "".join(plain)
        plain.clear()
        self.turns.update(text.encode("utf-8", "surrogatepass"))
        if loss:
            self.loss.update(text.encode("utf-8", "surrogatepass"))
            self.loss_chars += len(text)

    def digest(self) -> tuple:
        return self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars, self.fine


def read_back(segments: DataFrame, template: Template = Template()) -> DataFrame:  # noqa: B008
    """One row a conversation, from the segments in the order format_chat gives them."""

    def run(batches):
        conv, reader = None, None
        names, types = ["conv_id", *(f.split()[0] for f in DIGEST.split(", "))], [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
        make = lambda rows: pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=names)
        for batch in batches:
            done = []
            for c, text, loss, fine in zip(*(batch.column(k).to_pylist() for k in (0, 3, 4, 5)), strict=True):
                if reader is None or c != conv:
                    if reader:
                        done.append((conv, *reader.digest()))
                    conv, reader = c, Reader(template)
                reader.feed(text, loss)
                reader.fine = reader.fine and fine
            if done:
                yield make(done)
        if reader:
            yield make([(conv, *reader.digest())])

    return segments.mapInArrow(run, f"conv_id long, {DIGEST}")


#: The conversation that the registered query adds: control strings and the escape inside texts.
EXTRA = r"""SELECT -7L AS conv_id, CAST(t AS BIGINT) AS turn, r AS role, r'\### Assistant: </turn> ok' AS text FROM VALUES (0, 'user'), (1, 'assistant') AS v(t, r)"""


def op3(spark, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return read_back(format_chat(rows.unionByName(spark.sql(EXTRA))))


OP3_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), e AS (
  SELECT *, regexp_replace(text, '(\\|### |</turn>|: )', '\\\1', 'g') AS escaped,
         lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before
  FROM c
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
       CAST(sum(length(escaped) + length('### : </turn>.') + length(role)) AS BIGINT) AS formatted_chars,
       bool_and(CASE WHEN before IS NULL THEN role IN ('system', 'user') WHEN before = 'user' THEN role = 'assistant' ELSE role = 'user' END) AS in_order
FROM e GROUP BY conv_id
"""
