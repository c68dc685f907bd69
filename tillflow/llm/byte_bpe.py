"""Byte-level BPE, encoded with a pair occurrence index.

Texts of a partition are taken in portions of bounded size.  The distinct pieces of a
portion (by the vocabulary's splitting pattern) are laid end to end as symbols, and an
index maps each mergeable pair to all its positions.  Ranks are applied in ascending order:
all occurrences of the pair merge at once, and the pairs to their left and right, which
are new, enter the index.  A merge makes a symbol that only later ranks use, so a new pair
never has a rank that is already past, and one sweep gives the library's result.

Strings of added tokens inside a text become their ids, as the library does by default.
Decoding goes from ids to bytes and from bytes to text; bytes that aren't UTF-8 (which no
encoded text gives) become the replacement character.

Defined results: a null text is empty and has no tokens.  Repeated rows are encoded each.
A text longer than a portion is a portion of its own.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.llm.common import col, fresh

# Fixed value: the splitting pattern of byte-level vocabularies of this kind.
PIECES = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
PORTION_CHARS = 8_000_000
_NONE = np.iinfo(np.int64).max


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in such vocabularies; fixed by their format."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    moved = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(moved)}


class Vocabulary:
    """The merges and tokens of a tokenizers file, as arrays."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            found = json.load(file)
        ids, letters = found["model"]["vocab"], byte_letters()
        merges = [m.split(" ") if isinstance(m, str) else m for m in found["model"]["merges"]]
        left, right = (np.array([ids[m[k]] for m in merges], np.int64) for k in (0, 1))
        self.merged = np.array([ids[a + b] for a, b in merges], np.int64)
        self.left, self.right = left, right
        key = left << 32 | right
        self.order = np.argsort(key)
        self.keys = key[self.order]
        self.of_byte = np.zeros(256, np.int64)
        self.bytes: dict[int, bytes] = {}
        for token, i in ids.items():
            if all(x in letters for x in token):
                self.bytes[i] = bytes(letters[x] for x in token)
                if len(token) == 1:
                    self.of_byte[letters[token]] = i
        self.added = {t["content"]: t["id"] for t in found["added_tokens"]}
        self.bytes |= {i: token.encode() for token, i in self.added.items()}
        longest = sorted(self.added, key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, longest))) if longest else None
        self.pieces = regex.compile(PIECES)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of symbols, or _NONE; a negative symbol has no pairs."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.order[at], _NONE)

    def split(self, text: str) -> list[str]:
        """The pieces of a text, added tokens among them."""
        if self.special is None or not self.special.search(text):
            return self.pieces.findall(text)
        out, at = [], 0
        for found in self.special.finditer(text):
            out += self.pieces.findall(text[at : found.start()])
            out.append(found.group())
            at = found.end()
        return out + self.pieces.findall(text[at:])

    def encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces, one after the other, and where each piece's begin and end."""
        raw = [p.encode("utf-8", "surrogatepass") for p in pieces]
        sizes = np.array([len(x) + 1 for x in raw], np.int64)
        symbols = self.of_byte[np.frombuffer(b"\0".join([*raw, b""]), np.uint8)]
        ends = np.cumsum(sizes) - 1
        symbols[ends] = -1
        n = len(symbols)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[-1] = n - 1
        before[0] = 0
        alive = symbols >= 0

        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def enter(at: np.ndarray) -> None:
            rank = self.ranks(symbols[at], symbols[after[at]])
            some = rank != _NONE
            at, rank = at[some], rank[some]
            if not len(at):
                return
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
            for r, part in zip(rank[np.concatenate([[0], cuts])].tolist(), np.split(at, cuts)):
                if r not in index:
                    index[r] = []
                    heapq.heappush(active, r)
                index[r].append(part)

        enter(np.arange(n - 1))
        while active:
            rank = heapq.heappop(active)
            parts = index.pop(rank)
            at = parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))
            a, b = self.left[rank], self.right[rank]
            at = at[alive[at] & (symbols[at] == a) & (symbols[after[at]] == b)]
            if a == b and len(at) > 1:  # in a run of one symbol, every other pair from the left
                at = np.sort(at)
                starts = np.concatenate([[True], after[at[:-1]] != at[1:]])
                place = np.arange(len(at))
                run = np.maximum.accumulate(np.where(starts, place, 0))
                at = at[(place - run) % 2 == 0]
            if not len(at):
                continue
            gone = after[at]
            symbols[at] = self.merged[rank]
            alive[gone] = False
            symbols[gone] = -2
            after[at] = after[gone]
            before[after[at]] = at
            left = before[at]
            enter(np.unique(np.concatenate([left[left < at], at])))
        kept = symbols[alive]
        return kept, np.concatenate([[0], np.cumsum(alive)[ends]])


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _portions(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of the batches with texts of about PORTION_CHARS together; texts come last."""
    for batch in batches:
        start, size, texts = 0, 0, []
        for k, value in enumerate(batch.column(batch.num_columns - 1)):
            text = value.as_py() or ""
            if texts and size + len(text) > PORTION_CHARS:
                yield batch.slice(start, k - start), texts
                start, size, texts = k, 0, []
            texts.append(text)
            size += len(text)
        if texts:
            yield batch.slice(start), texts


class Codes:
    """The ids, bytes and decimal ids of every distinct piece of some texts."""

    def __init__(self, vocab: Vocabulary, texts: list[str]) -> None:
        # Equal pieces of all texts are one string in memory.
        distinct: dict[str, str] = {}
        self.pieces = []
        for text in texts:
            pieces = vocab.split(text)
            self.pieces.append(list(map(distinct.setdefault, pieces, pieces)))
        plain = [p for p in distinct if p not in vocab.added]
        ids, cuts = vocab.encode(plain) if plain else (np.array([], np.int64), np.array([0]))
        flat, cuts = ids.tolist(), cuts.tolist()
        raw, shown = [vocab.bytes[i] for i in flat], list(map(str, flat))
        spans = list(zip(cuts, cuts[1:]))
        self.ids = {p: flat[a:b] for p, (a, b) in zip(plain, spans)}
        self.raw = {p: b"".join(raw[a:b]) for p, (a, b) in zip(plain, spans)}
        self.shown = {p: ",".join(shown[a:b]) for p, (a, b) in zip(plain, spans)}
        for token, i in vocab.added.items():
            self.ids[token], self.raw[token], self.shown[token] = [i], vocab.bytes[i], str(i)
        self.size = {p: len(x) for p, x in self.ids.items()}


def _with(batch: pa.RecordBatch, more: dict[str, pa.Array]) -> pa.RecordBatch:
    own = batch.select(list(range(batch.num_columns - 1)))
    return pa.record_batch([*own.columns, *more.values()], names=[*own.schema.names, *more])


def encoded(docs: DataFrame, path: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """``docs`` with an array of token ids; a clashing name gets an underscore."""
    (name, helper) = fresh(docs, ids, "text_of_row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch, texts in _portions(batches):
            codes = Codes(vocab, texts)
            found = [list(chain.from_iterable(map(codes.ids.get, x))) for x in codes.pieces]
            yield _with(batch, {name: pa.array(found, pa.list_(pa.int32()))})

    wide = docs.select(*[col(c) for c in docs.columns], col(text).alias(helper))
    schema = docs.withColumn(name, F.lit(None).cast("array<int>")).schema
    return wide.mapInArrow(run, schema)


def decoded(ids: Column, path: str) -> Column:
    """The text of an array of token ids; null for null."""

    @F.pandas_udf("string")
    def run(rows):  # noqa: ANN001, ANN202
        table = vocabulary(path).bytes
        return rows.map(
            lambda x: None if x is None
            else b"".join(table[int(i)] for i in x).decode("utf-8", "replace")
        )

    run.func.__annotations__ = {}
    return run(ids)


def digests(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 for each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch, texts in _portions(batches):
            counts, of_ids, of_text = [], [], []
            codes = Codes(vocab, texts)
            for pieces in codes.pieces:
                counts.append(sum(map(codes.size.get, pieces)))
                shown = ",".join(map(codes.shown.get, pieces))
                back = b"".join(map(codes.raw.get, pieces)).decode("utf-8", "replace")
                of_ids.append(hashlib.sha256(shown.encode()).hexdigest())
                of_text.append(hashlib.sha256(back.encode()).hexdigest())
            yield _with(batch, {
                "n_tokens": pa.array(counts, pa.int64()),
                "ids_sha256": pa.array(of_ids, pa.string()),
                "decoded_sha256": pa.array(of_text, pa.string()),
            })

    plain = docs.select(col(doc_id).alias("doc_id"), col(text).alias("text"))
    kind = plain.schema["doc_id"].dataType.simpleString()
    return plain.mapInArrow(
        run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
