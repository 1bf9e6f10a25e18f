"""Chat formatting with typed content parts.

A visitor walks over the parts of a turn in order. Text goes in escaped; an image, a sound or a document becomes one
placeholder, and the visitor records its reference and how many tokens the placeholder expands to. Turns are marked as

    <s> role [INST] content [/INST]</s>

A control string inside a text is preceded by an odd number of backslashes (2n + 1 where the text had n), a mark of the
template by none, so reading back is exact. A blank on both sides keeps marks apart from backslashes of the text.

Turns are ordered by turn, role and text; equal rows stay. Null texts, roles and parts count as empty. A conversation is
one output row, so its turns meet in one task; that bounds memory by the longest conversation. Null ids form one
conversation. Sizes that are missing, negative, infinite or no number count as 0, and an attachment takes one token at
least; a part of an unknown kind counts as its text. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PART = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
PLACEHOLDERS = {"image": "[IMG]", "audio": "[AUD]", "document": "[DOC]"}
CONTROL = re.compile(r"(\\*)(</?s>|\[/?INST\]|\[IMG\]|\[AUD\]|\[DOC\])")
#: Tokens that a placeholder expands to: per image patch of 28 x 28 points, per second of sound, per page.
PATCH, PER_SECOND, PER_PAGE = 28, 25, 256


def escape(text: str) -> str:
    return CONTROL.sub(r"\1\1\\\2", text)


def unescape(text: str) -> str:
    return CONTROL.sub(lambda m: m[1][: len(m[1]) // 2] + m[2], text)


def _size(part: dict, name: str) -> float:
    """A size of a part; at most 10^12, so that counts of tokens stay whole numbers of 64 bits."""
    value = part.get(name) or 0
    return min(value, 10**12) if 0 < value < math.inf else 0


class PartVisitor:
    """Flattens the parts of one turn; keeps what it put in and where."""

    def __init__(self):
        self.content: list[str] = []
        self.plain = ""
        self.attachments: list[tuple[str, str, int]] = []

    def visit(self, part: dict) -> None:
        getattr(self, f"visit_{part.get('kind') or 'text'}", self.visit_unknown)(part)

    def visit_text(self, part: dict) -> None:
        self.plain += part.get("text") or ""  # neighbours are escaped together: they may complete a control string

    def visit_image(self, part: dict) -> None:
        self._attach("image", part, math.ceil(_size(part, "width") / PATCH) * math.ceil(_size(part, "height") / PATCH))

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part, math.ceil(_size(part, "seconds") * PER_SECOND))

    def visit_document(self, part: dict) -> None:
        self._attach("document", part, _size(part, "pages") * PER_PAGE)

    visit_unknown = visit_text

    def whole(self) -> str:
        return "".join(self.content) + escape(self.plain)

    def _attach(self, kind: str, part: dict, tokens: int) -> None:
        self.content += [escape(self.plain), f" {PLACEHOLDERS[kind]} "]
        self.plain = ""
        self.attachments.append((kind, part.get("ref") or "", max(tokens, 1)))


def format_turns(turns: list[dict], learn: str = "assistant") -> dict:
    """``formatted``, ``loss`` (spans of the content of ``learn`` turns) and ``attachments`` of ordered turns."""
    text, at, loss, attachments = [], 0, [], []
    for number, turn in enumerate(turns):
        visitor = PartVisitor()
        for part in turn["parts"] or []:
            visitor.visit(part or {})
        head, content = f"<s> {escape(turn['role'] or '')} [INST] ", visitor.whole()
        text += [head, content, " [/INST]</s>"]
        if turn["role"] == learn:
            loss.append({"start": at + len(head), "end": at + len(head) + len(content)})
        attachments += [{"turn": number, "kind": kind, "ref": ref, "tokens": tokens} for kind, ref, tokens in visitor.attachments]
        at += len(head) + len(content) + len(text[-1])
    return {"formatted": "".join(text), "loss": loss, "attachments": attachments}


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """Roles and contents (placeholders in place) of a formatted conversation."""
    marks = [(m[2], m.start(), m.end()) for m in CONTROL.finditer(formatted) if not m[1] and m[2] not in PLACEHOLDERS.values()]
    turns = []
    for (_, _, a), (_, b, c), (_, d, _), _ in zip(*[iter(marks)] * 4, strict=True):
        turns.append((unescape(formatted[a + 1 : b - 1]), unescape(formatted[c + 1 : d - 1])))
    return turns


FORMATTED = "formatted string, loss array<struct<start:long,end:long>>, attachments array<struct<turn:int,kind:string,ref:string,tokens:long>>"


def format_conversations(rows: DataFrame, id_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role", text_column: str = "text", parts_column: str | None = None, learn: str = "assistant") -> DataFrame:
    """One row per conversation: its id, ``formatted``, ``loss`` and ``attachments``.

    ``parts_column`` holds ``array<struct>`` with the fields of ``PART``; without it a turn is the one text in ``text_column``.
    """
    empty = {name: F.lit(None).cast(kind) for name, kind in (f.split(":") for f in PART[7:-1].split(","))}
    one = empty | {"kind": F.lit("text"), "text": F.col(text_column)}
    parts = F.col(parts_column) if parts_column else F.array(F.struct(*(c.alias(n) for n, c in one.items())))
    turn = F.struct(F.col(turn_column).alias("turn"), F.col(role_column).alias("role"), parts.alias("parts"))
    grouped = rows.groupBy(F.col(id_column).alias("id")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    kind = dict(rows.dtypes)[id_column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [format_turns(turns, learn) for turns in batch.column(1).to_pylist()]
            columns = [pa.array([x[name] for x in made], type_) for name, type_ in zip(("formatted", "loss", "attachments"), types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=[id_column, "formatted", "loss", "attachments"])

    types = (
        pa.string(),
        pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])),
        pa.list_(pa.struct([("turn", pa.int32()), ("kind", pa.string()), ("ref", pa.string()), ("tokens", pa.int64())])),
    )
    return grouped.mapInArrow(run, f"{id_column} {kind}, {FORMATTED}")


def digests(formatted: DataFrame, id_column: str = "conv_id") -> DataFrame:
    """Counts and digests read back from ``formatted`` and ``loss`` alone."""
    kind = dict(formatted.dtypes)[id_column]
    names = [id_column, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, loss in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                turns, learnt = read_turns(text), "".join(unescape(text[s["start"] : s["end"]]) for s in loss)
                whole = "".join(f"{role}\n{content}\n" for role, content in turns)
                out.append((len(turns), _sha(whole), len(learnt), _sha(learnt), len(text)))
            if out:
                yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(list(c)) for c in zip(*out, strict=True))], names=names)

    schema = f"{id_column} {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return formatted.select(id_column, "formatted", "loss").mapInArrow(run, schema)


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


#: What a control string costs in ``escape``: one backslash, and each one before it again.
ORACLE = r"""
WITH rows AS (
  SELECT conv_id, turn, role, text FROM {turns}
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), turns AS (
  SELECT conv_id, turn, role, coalesce(role, '') AS said, coalesce(text, '') AS text, 24 + length(coalesce(role, '')) + length(coalesce(text, ''))
    + coalesce(list_sum(list_transform(regexp_extract_all(coalesce(role, ''), '(\\*)(</?s>|\[/?INST\]|\[IMG\]|\[AUD\]|\[DOC\])', 1), lambda b: length(b) + 1)), 0)
    + coalesce(list_sum(list_transform(regexp_extract_all(coalesce(text, ''), '(\\*)(</?s>|\[/?INST\]|\[IMG\]|\[AUD\]|\[DOC\])', 1), lambda b: length(b) + 1)), 0) AS size
  FROM rows
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(said || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role NULLS FIRST, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(size) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""
