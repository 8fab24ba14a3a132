"""Token counts attributed to fields and sections through offsets.

A document is encoded once, whole, as a model would see it. Each token's
byte span follows from the lengths of the labels before it, so the character
spans of fields and sections can be joined to the token spans without
encoding any part again (parts encoded alone give other tokens at their
edges). Tokens that cross a boundary are allocated by a stated rule:

* ``first``: the span that holds the token's first byte;
* ``most``: the span that holds most of its bytes, the earlier of equals.

Both allocate every token exactly once, so the counts of the spans add up
to the document's tokens; what no span covers goes to the span null."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectio.llm.bpe_automaton import compiled, read_definition

#: (section name, begin, end) in characters of the field, in order, disjoint.
Sections = Callable[[str], Sequence[tuple[str, int, int]]]
SPAN_TYPE = "field string, section string, part int, begin long, end long, n_tokens long, n_crossing long"


def paragraphs(text: str) -> list[tuple[str, int, int]]:
    """Lines with their newline, named ``blank`` or ``line``."""
    out, at = [], 0
    for line in text.split("\n"):
        end = min(len(text), at + len(line) + 1)
        if end > at:
            out.append(("line" if line.strip() else "blank", at, end))
        at = end
    return out


def byte_bounds(text: str, bounds: np.ndarray) -> np.ndarray:
    """Character offsets (ascending) as offsets in UTF-8."""
    raw = text.encode("utf-8", "surrogatepass")
    if len(raw) == len(text):
        return bounds
    first = np.flatnonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)  # where characters begin
    return np.append(first, len(raw))[bounds]


def allocate(token_ends: np.ndarray, begins: np.ndarray, ends: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Interval join of tokens (ends of adjacent spans) with ordered,
    disjoint spans: the span number of every token, -1 for none, and whether
    the token crosses a boundary. Two binary searches per token."""
    starts = np.concatenate((token_ends[:1] * 0, token_ends[:-1]))
    if not len(begins):
        return np.full(len(token_ends), -1), np.zeros(len(token_ends), bool)
    at_first = np.searchsorted(begins, starts, "right") - 1
    at_last = np.searchsorted(begins, token_ends - 1, "right") - 1
    inside = (at_first >= 0) & (starts < ends[at_first])
    whole = inside & (token_ends <= ends[at_first])
    owner = np.where(inside, at_first, -1)
    crossing = ~whole & (inside | (at_last > at_first))
    if rule == "most":
        for t in np.flatnonzero(crossing):
            best, held = -1, 0
            for s in range(max(at_first[t], 0), at_last[t] + 1):
                share = min(token_ends[t], ends[s]) - max(starts[t], begins[s])
                if share > held:
                    best, held = s, share
            covered = sum(max(0, min(token_ends[t], ends[s]) - max(starts[t], begins[s]))
                          for s in range(max(at_first[t], 0), at_last[t] + 1))
            owner[t] = best if held >= token_ends[t] - starts[t] - covered else -1
    elif rule != "first":
        raise ValueError(f"unknown rule {rule}")
    return owner, crossing


def attribute_tokens(docs: DataFrame, tokenizer: str, fields: Sequence[str] = ("text",), id_col: str = "doc_id",
                     sections: dict[str, Sections] | None = None, separator: str = "\n", rule: str = "first") -> DataFrame:
    """One row per row of ``docs`` and span: id, ``field``, ``section``,
    ``part`` (number within the field), ``begin`` and ``end`` (characters of
    the whole document), ``n_tokens``, ``n_crossing`` (of those, tokens that
    cross a boundary), and the document's ``doc_tokens``.

    The whole document is the fields joined by ``separator``. A field is one
    span unless ``sections`` splits it. A null or empty field has one empty
    span with 0 tokens; a field's parts outside its sections and separators
    are the rows with a null section and field, given only if they hold
    tokens. Repeated rows and null ids get rows of their own; no shuffle."""
    sections = sections or {}
    fields = list(fields)
    definition = docs.sparkSession.sparkContext.broadcast(read_definition(tokenizer))
    id_type = docs.schema[id_col].dataType.simpleString()

    def spans_of(values: list[str]) -> tuple[str, list[tuple[str, str, int, int, int]]]:
        spans, at = [], 0
        for name, value in zip(fields, values, strict=True):
            parts = sections[name](value) if name in sections and value else [(name, 0, len(value))]
            spans += [(name, section, i, at + b, at + e) for i, (section, b, e) in enumerate(parts)]
            at += len(value) + len(separator)
        return separator.join(values), spans

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = compiled(definition.value)
        lengths = np.fromiter(map(len, automaton.labels), np.int64, len(automaton.labels))
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                of_row, found, counts, crossings, totals = [], [], [], [], []
                for i, values in enumerate(zip(*part.columns[1:], strict=True)):
                    text, spans = spans_of([v.as_py() or "" for v in values])
                    ids = np.array(automaton.encode(text), np.int64)
                    filled = [s for s in spans if s[4] > s[3]]
                    bounds = np.array([(s[3], s[4]) for s in filled], np.int64).reshape(-1, 2)
                    order = byte_bounds(text, bounds.ravel()).reshape(-1, 2)
                    owner, crossing = allocate(np.cumsum(lengths[ids]), order[:, 0], order[:, 1], rule)
                    n = len(filled)
                    count = np.bincount(owner + 1, minlength=n + 1)
                    crossed = np.bincount(owner[crossing] + 1, minlength=n + 1)
                    place = {s: k + 1 for k, s in enumerate(filled)}
                    rows = [(s, place.get(s)) for s in spans]
                    if count[0]:
                        rows.append(((None, None, None, None, None), 0))
                    for span, k in rows:
                        of_row.append(i)
                        found.append(span)
                        counts.append(0 if k is None else count[k])
                        crossings.append(0 if k is None else crossed[k])
                        totals.append(len(ids))
                columns = [part.column(0).take(pa.array(of_row, pa.int32()))]
                kinds = (pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64())
                columns += [pa.array([s[j] for s in found], kind) for j, kind in enumerate(kinds)]
                columns += [pa.array(x, pa.int64()) for x in (counts, crossings, totals)]
                yield pa.RecordBatch.from_arrays(columns, ["id", "field", "section", "part", "begin", "end", "n_tokens",
                                                           "n_crossing", "doc_tokens"])

    rows = docs.select(F.col(id_col).alias("id"), *(F.col(f).cast("string").alias(f"f{i}") for i, f in enumerate(fields)))
    return rows.mapInArrow(run, f"id {id_type}, {SPAN_TYPE}, doc_tokens long").withColumnRenamed("id", id_col)
