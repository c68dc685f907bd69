"""Token counts, with huge documents encoded in overlapping chunks.

Texts up to ``CHUNK_CHARS`` are not cut; of their words the tokenizer gets each distinct one
of a task once, as it drops white space.  A longer text is cut into chunks
that overlap, the chunks are dealt out over all tasks and encoded with offsets, and each
returns how many of its tokens lie before each boundary in its overlaps.  Neighbours are
spliced at a boundary that both found.

Only boundaries that are proven stable count: a token begins there and the character
before is white space.  The tokenizer drops white space, and neither its normalizer nor its
pieces or merges reach across it, so the tokens of a text are those of the part before such
a place and those of the part after it.  Where two neighbours have no such boundary in
common, their document is encoded again with overlaps eight times as wide, until they agree
or one chunk holds the whole text.

Defined results: a null text is empty and has no tokens.  Repeated rows are counted each.
Nothing is truncated.  An empty table gives an empty result.
"""

from __future__ import annotations

import os
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.llm.common import col, stored, text_of

CHUNK_CHARS = 32_768
OVERLAP_CHARS = 256
WIDEN = 8
TOKEN_LIMIT = 2048
#: Boundaries that a chunk returns for each side, those nearest the middle.
BOUNDARIES = 16
BATCH_BYTES = 1_000_000
#: Bound on the words whose token counts a task remembers.
MOST_WORDS = 200_000


@lru_cache(maxsize=4)
def _tokenizer(path: str):  # noqa: ANN202
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    count = lambda text: len(found.encode(text, add_special_tokens=False).ids)
    parts = ("Don't", "stop", "42%")
    if count(" \t\n\x0b\f\r ") or any(count(x.join(parts)) != sum(map(count, parts)) for x in _SPACES):
        raise ValueError(f"{path}: this tokenizer doesn't drop white space, so texts can't be spliced after it")
    return found


#: White space that parts words here; the tokenizer drops all of it.
_SPACES = " \t\n\x0b\f\r"


class Words:
    """Token counts of words, kept for the most recent ones of a task.

    The tokenizer drops white space and nothing reaches across it, so a text has the tokens of
    its words, special strings in them included.  ``MOST_WORDS`` bounds the table.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer = _tokenizer(path)
        self.known: dict[bytes, int] = {}

    def counts(self, texts: list[bytes]) -> list[int]:
        words = [t.split() for t in texts]
        new = list(set(chain.from_iterable(words)).difference(self.known))
        if new:
            if len(self.known) > MOST_WORDS:
                self.known = {}
                new = list(set(chain.from_iterable(words)))
            found = self.tokenizer.encode_batch_fast(
                [w.decode("utf-8", "replace") for w in new], add_special_tokens=False
            )
            self.known.update(zip(new, map(len, found)))
        return [sum(map(self.known.__getitem__, x)) for x in words]


def _whole(path: str):  # noqa: ANN202
    """Adds n_tokens in place of the last column, the text in UTF-8."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(path)
        for batch in batches:
            counts: list[int] = []
            portion: list[bytes] = []
            size = 0
            for value in batch.column(batch.num_columns - 1):
                portion.append(value.as_py())
                size += len(portion[-1])
                if size > BATCH_BYTES:
                    counts += words.counts(portion)
                    portion, size = [], 0
            counts += words.counts(portion)
            own = batch.select(list(range(batch.num_columns - 1)))
            yield pa.record_batch(
                [*own.columns, pa.array(counts, pa.int64())], names=[*own.schema.names, "n_tokens"]
            )

    return run


def _cut(chunk: int, overlap: int):  # noqa: ANN202
    """Chunks (row_no, number, start, left, right, piece) of texts; left and right: junctions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row_no, value in zip(batch.column("row_no").to_pylist(), batch.column("text")):
                text = value.as_py()
                # Where overlaps would meet, one chunk holds everything.
                step = chunk if 2 * overlap < chunk else max(len(text), 1)
                ends = [*range(step, len(text) - step // 2, step), len(text)]
                for k, right in enumerate(ends):
                    left = ends[k - 1] if k else 0
                    start = max(0, left - overlap) if k else 0
                    stop = min(len(text), right + overlap)
                    yield pa.record_batch({
                        "row_no": pa.array([row_no], pa.int64()),
                        "number": pa.array([k], pa.int32()),
                        "chunks": pa.array([len(ends)], pa.int32()),
                        "start": pa.array([start], pa.int64()),
                        "left": pa.array([left], pa.int64()),
                        "right": pa.array([right], pa.int64()),
                        "piece": pa.array([text[start:stop]], pa.string()),
                    })

    return run


def _stable(piece: str, starts: list[int], at: int, overlap: int) -> list[int]:
    """Token starts after white space within the overlap around ``at``, the nearest first."""
    low, high = bisect_left(starts, at - overlap), bisect_left(starts, at + overlap)
    found = [p for p in starts[low:high] if p and piece[p - 1] in " \n\t\r"]
    return sorted(set(found), key=lambda p: (abs(p - at), p))[:BOUNDARIES]


def _chunked(path: str, overlap: int):  # noqa: ANN202
    """What a junction needs of each chunk: boundaries and the tokens before each of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(path)
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                code = tokenizer.encode(r["piece"], add_special_tokens=False)
                starts = sorted(a for a, _ in code.offsets)
                sides = []
                for inner, at in ((r["number"] > 0, r["left"]), (r["number"] + 1 < r["chunks"], r["right"])):
                    places = _stable(r["piece"], starts, at - r["start"], overlap) if inner else []
                    sides.append([(p + r["start"], bisect_left(starts, p)) for p in places])
                rows.append({"row_no": r["row_no"], "number": r["number"], "chunks": r["chunks"],
                             "n": len(starts)} | {
                    f"{side}_{what}": [x[k] for x in found]
                    for side, found in zip(("left", "right"), sides)
                    for k, what in enumerate(("at", "before"))
                })
            yield pa.RecordBatch.from_pylist(rows, schema=_SUMMARY_ARROW)

    return run


_LISTS = ("left_at", "left_before", "right_at", "right_before")
_SUMMARY = "row_no long, number int, chunks int, n long, " + ", ".join(f"{x} array<long>" for x in _LISTS)
_SUMMARY_ARROW = pa.schema(
    [("row_no", pa.int64()), ("number", pa.int32()), ("chunks", pa.int32()), ("n", pa.int64())]
    + [(x, pa.list_(pa.int64())) for x in _LISTS]
)


def _splice(chunks: pd.DataFrame) -> pd.DataFrame:
    """The tokens of one document, or null where two neighbours don't align."""
    rows = chunks.sort_values("number").to_dict("records")
    count, begin, aligned = 0, 0, True
    for one, two in zip(rows, rows[1:]):
        before = dict(zip(two["left_at"], two["left_before"]))
        met = next(((n, before[p]) for p, n in zip(one["right_at"], one["right_before"]) if p in before), None)
        if met is None:
            aligned = False
            break
        count += met[0] - begin
        begin = met[1]
    count += rows[-1]["n"] - begin
    n_tokens = pd.array([count if aligned else None], dtype="Int64")
    return pd.DataFrame({"row_no": [rows[0]["row_no"]], "n_tokens": n_tokens})


def counted(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for each row."""
    rows = docs.select(col(doc_id).alias("doc_id"), text_of(text).alias("text"))
    rows = rows.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes long, n_tokens long"
    short = rows.where(F.length("text") <= CHUNK_CHARS)
    short = short.withColumn("text", F.col("text").cast("binary"))
    parts = [short.mapInArrow(_whole(path), schema)]

    huge = stored(
        rows.where(F.length("text") > CHUNK_CHARS)
        .withColumn("row_no", F.monotonically_increasing_id()),
        "token-texts",
    )
    overlap, left = OVERLAP_CHARS, huge
    while True:
        pieces = left.select("row_no", "text").mapInArrow(
            _cut(CHUNK_CHARS, overlap),
            "row_no long, number int, chunks int, start long, left long, right long, piece string",
        )
        found = stored(
            pieces.repartition("row_no", "number")
            .mapInArrow(_chunked(path, overlap), _SUMMARY)
            .groupBy("row_no")
            .applyInPandas(_splice, "row_no long, n_tokens long"),
            "token-counts",
        )
        done = left.select("doc_id", "n_bytes", "row_no").join(
            found.where("n_tokens IS NOT NULL"), "row_no"
        )
        parts.append(done.select("doc_id", "n_bytes", "n_tokens"))
        again = found.where("n_tokens IS NULL").select("row_no")
        if again.isEmpty():
            break
        left, overlap = left.join(again, "row_no", "left_semi"), overlap * WIDEN
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)
