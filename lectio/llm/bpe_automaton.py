"""Byte-level BPE as an automaton over tokens.

The merges are compiled, in order, by one merge gadget each. The automaton
has a state per token, "this token came last", and an arc u -> v where v may
follow u. At first it accepts every sequence of bytes. The gadget of merge
(u, v) -> w

  1. adds the state w, with the arcs that leave v at this moment,
  2. removes the arc u -> v,
  3. lets w be entered from every state that still enters u.

Afterwards exactly one path spells each word, and its labels are the BPE
encoding. States share their arcs as of the moment they were copied, so a
gadget costs a constant amount: it notes whom w copies (``right`` for leaving
arcs, ``left`` for entering ones), when (``born``) and the arc that is cut.
The transition table is filled from those notes as arcs are first asked for.

Texts are split into words as the tokenizer's pattern says; each distinct
word is run through the table once and remembered in a bounded memory."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The white space of the byte-level pre-tokenizer's pattern
# (Unicode White_Space) and that pattern.
SPACES = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: A chunk is what stands between white space, with one space before it; the
#: pattern never joins characters across two chunks.
CHUNKS = re.compile(f" ?[^{SPACES}]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+")
WORDS = regex.compile(WORD_PATTERN)


def byte_letters() -> dict[str, int]:
    """Byte-level files write bytes as letters: printable Latin-1 stands for
    itself, the other bytes for the code points from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class MergeAutomaton:
    """Compiled from a byte-level BPE tokenizer file (JSON text)."""

    def __init__(self, definition: str, memory: int = 400_000):
        spec = json.loads(definition)
        letter = byte_letters()
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        self.specials = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        size = max([*vocab.values(), *self.specials.values()]) + 1
        self.labels: list[bytes] = [b""] * size
        for token, i in vocab.items():
            if token not in self.specials:
                self.labels[i] = bytes(letter[c] for c in token)
        for token, i in self.specials.items():
            self.labels[i] = token.encode()
        self.born = [0] * size  # 0: a single byte
        self.left, self.right = [0] * size, [0] * size
        self.cut: dict[tuple[int, int], int] = {}  # arc -> the moment of its removal
        single = {i: self.labels[i] for t, i in vocab.items() if len(t) == 1}
        self.token_of: dict[bytes, int] = {b: i for i, b in single.items()}
        for moment, merge in enumerate(merges, 1):
            u, v = merge if isinstance(merge, list) else merge.split(" ")
            self._gadget(vocab[u], vocab[v], vocab[u + v], moment)
        self.follows: list[dict[int, bool]] = [{} for _ in self.labels]  # the transition table, by the arc's end
        self.n_arcs = 0
        self._spell()
        self.special_split = re.compile("(" + "|".join(map(re.escape, self.specials)) + ")") if self.specials else None
        self.memory, self.young, self.old = memory, {}, {}

    def _gadget(self, u: int, v: int, w: int, moment: int) -> None:
        self.left[w], self.right[w], self.born[w] = u, v, moment
        self.cut[u, v] = moment
        self.token_of[self.labels[w]] = w

    def _spell(self) -> None:
        """Reading bytes: a trie of the labels with links to the longest
        shorter suffix, so that each state knows which tokens end here."""
        children: list[dict[int, int]] = [{}]
        token_at: dict[int, int] = {}
        for label, token in self.token_of.items():
            node = 0
            for byte in label:
                if byte not in children[node]:
                    children[node][byte] = len(children)
                    children.append({})
                node = children[node][byte]
            token_at[node] = token
        self.children, self.shorter = children, [0] * len(children)
        self.ending: list[tuple[tuple[int, int], ...]] = [()] * len(children)  # (token, length), longest first
        level = [(0, 0)]
        self.read: dict[int, int] = {}
        while level:  # breadth first: links lead to states already done
            below = []
            for node, depth in level:
                own = ((token_at[node], depth),) if node in token_at else ()
                self.ending[node] = own + (self.ending[self.shorter[node]] if node else ())
                for byte, child in children[node].items():
                    if node:
                        self.shorter[child] = self._read(self.shorter[node], byte)
                    below.append((child, depth + 1))
            level = below

    def _read(self, node: int, byte: int) -> int:
        """The state after one more byte."""
        at = node
        while byte not in self.children[at]:
            if not at:
                return 0
            at = self.shorter[at]
        return self.children[at][byte]

    def arc(self, u: int, v: int) -> bool:
        """Whether v may follow u once all gadgets are in: the arc is traced
        back through the copies to the bytes it came from, and is missing if
        it had been cut by the time of the copy."""
        a, b, now = u, v, len(self.born) + 1
        while True:
            if self.cut.get((a, b), now) < now:
                found = False
                break
            born_a, born_b = self.born[a], self.born[b]
            if not born_a and not born_b:
                found = True
                break
            if born_a > born_b:  # a's leaving arcs were copied from its right part, before the cut
                a, now = self.right[a], born_a
            elif born_b > born_a:  # b's entering arcs from its left part, after the cut
                b, now = self.left[b], born_b + 1
            else:  # the same state twice
                a, b, now = self.right[a], self.left[b], born_a
        if self.n_arcs >= 4 * self.memory:
            self.follows, self.n_arcs = [{} for _ in self.labels], 0
        self.follows[v][u] = found
        self.n_arcs += 1
        return found

    def accept(self, word: bytes) -> list[int]:
        """The labels of the one path that spells ``word``. Each prefix is
        spelled by one path, so one token per position comes last."""
        read, ending, follows = self.read, self.ending, self.follows
        last = [-1]
        node = 0
        for i, byte in enumerate(word, 1):
            key = node << 8 | byte
            node = read.get(key, -1)
            if node < 0:
                if len(read) >= 4 * self.memory:
                    read.clear()
                node = read[key] = self._read(key >> 8, byte)
            for token, length in ending[node]:
                before = last[i - length]
                if before < 0:
                    break
                may = follows[token].get(before)
                if may is None:
                    may = self.arc(before, token)
                    follows = self.follows
                if may:
                    break
            else:
                raise ValueError("the vocabulary lacks a byte of the text")
            last.append(token)
        path, i = [], len(word)
        while i:
            path.append(last[i])
            i -= len(self.labels[last[i]])
        path.reverse()
        return path

    def _learn(self, chunk: str) -> tuple[int, ...]:
        ids = self.old.get(chunk)
        if ids is None:
            ids = tuple(chain.from_iterable(self.accept(w.encode("utf-8", "surrogatepass")) for w in WORDS.findall(chunk)))
        if len(self.young) >= self.memory:
            self.old, self.young = self.young, {}
        self.young[chunk] = ids
        return ids

    def _pieces(self, text: str) -> Iterator[tuple[int, ...]]:
        parts = self.special_split.split(text) if self.special_split and any(s in text for s in self.specials) else [text]
        learn = self._learn
        for k, part in enumerate(parts):
            if k % 2:
                yield (self.specials[part],)
            else:
                for chunk in CHUNKS.findall(part):
                    yield self.young.get(chunk) or learn(chunk)

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(self._pieces(text)))

    def decode(self, ids: Iterable[int]) -> bytes:
        """Emits the label of every arc."""
        return b"".join(map(self.labels.__getitem__, ids))


_COMPILED: dict[str, MergeAutomaton] = {}


def compiled(definition: str) -> MergeAutomaton:
    """One automaton per worker process and tokenizer."""
    key = hashlib.sha256(definition.encode()).hexdigest()
    if key not in _COMPILED:
        _COMPILED[key] = MergeAutomaton(definition)
    return _COMPILED[key]


def read_definition(path: str) -> str:
    """The tokenizer file, read by the driver; it is a file of a few MB
    whatever the corpus."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                     with_ids: bool = True) -> DataFrame:
    """One row per row of ``docs``: id, ``n_tokens``, ``ids`` (array of int;
    left out without ``with_ids``), ``ids_sha256`` (of the decimal ids joined
    by commas), ``decoded`` (likewise) and ``decoded_sha256``.

    ``tokenizer`` is the path of a byte-level BPE file. Strings of special
    tokens in a text get their ids, as the tokenizers library does by
    default. Null counts as empty: no tokens. Bytes that are not UTF-8 would
    decode to U+FFFD. Rows, repeated or not, are independent; no shuffle."""
    definition = docs.sparkSession.sparkContext.broadcast(read_definition(tokenizer))
    kind = docs.schema[id_col].dataType
    id_type = kind.simpleString()
    wide = ", ids array<int>, decoded string" if with_ids else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = compiled(definition.value)
        decimal = [str(i) for i in range(len(automaton.labels))].__getitem__
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                counts, id_sums, text_sums, all_ids, texts = [], [], [], [], []
                for text in part.column(1):
                    ids = automaton.encode(text.as_py() or "")
                    decoded = automaton.decode(ids).decode("utf-8", "replace")
                    counts.append(len(ids))
                    id_sums.append(hashlib.sha256(",".join(map(decimal, ids)).encode()).hexdigest())
                    text_sums.append(hashlib.sha256(decoded.encode("utf-8", "replace")).hexdigest())
                    if with_ids:
                        all_ids.append(ids)
                        texts.append(decoded)
                columns = [part.column(0), pa.array(counts, pa.int64()), pa.array(id_sums, pa.string()),
                           pa.array(text_sums, pa.string())]
                names = ["id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    columns += [pa.array(all_ids, pa.list_(pa.int32())), pa.array(texts, pa.string())]
                    names += ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays(columns, names)

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = rows.mapInArrow(run, f"id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string{wide}")
    return out.withColumnRenamed("id", id_col)
