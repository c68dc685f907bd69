"""Periodic runs of words within a text, by seed and extension along diagonals.

A run is a stretch of words that repeats with smallest period q, has at least
``max(LEAST, TIMES * q)`` words and can't be made longer with that period.  Words are
``[^\\x20\\x09-\\x0D]+``.

Its two copies one period apart agree in at least 16 words for periods up to 15, and in at
least 32, 64, 128, ... words for periods from 16, 32, 64, ... on: the guaranteed overlap of
that range of periods, longer than any period in it.  Grams of just this length are indexed
for each range.  As such a gram is longer than the period, a closer occurrence between two
that are q apart would give the run a smaller period; so pairs of neighbouring occurrences
hold every run, and their number is bounded by the words (all pairs would be quadratic).
Grams have exact numbers (a gram is a pair of numbers of its halves), so nothing has to be
verified.  Each pair is a seed on the diagonal of its lag and is extended both ways; a table
of how far each lag is covered skips the other seeds of the same stretch.

Texts are worked on one at a time inside the tasks that read them; nothing is shuffled.

Defined results: null and empty texts have no words and no runs.  Repeated rows give repeated
results, an empty table an empty one.  Other columns are carried by :func:`collapsed`.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.llm.common import col, fresh

LEAST, TIMES = 24, 3
#: Overlap that runs of periods below it have at least: min over q of max(LEAST, TIMES * q) - q.
FIRST_GRAM = 16

Run = tuple[int, int, int]


def _agree(ids: np.ndarray, a: int, b: int, step: int) -> int:
    """How many words from ``a`` and from ``b`` > a on are equal, going right (1) or left (-1)."""
    most = len(ids) - b if step > 0 else a + 1
    done, size = 0, 64
    while done < most:
        size = min(2 * size, most - done)
        if step > 0:
            same = ids[a + done : a + done + size] == ids[b + done : b + done + size]
        else:
            same = (ids[a - done - size + 1 : a - done + 1] == ids[b - done - size + 1 : b - done + 1])[::-1]
        if not same.all():
            return done + int(same.argmin())
        done += size
    return done


def _joined(ids: np.ndarray, k: int) -> tuple[np.ndarray, bool]:
    """Numbers of grams of twice the length, and whether any occurs twice."""
    pairs = ids[:-k] * (int(ids.max()) + 1) + ids[k:]
    distinct, out = np.unique(pairs, return_inverse=True)
    return out, len(distinct) < len(pairs)


def _seeds(grams: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Lag and place of neighbouring occurrences of a gram, for lags from low to below high."""
    order = np.argsort(grams, kind="stable")
    first, second = order[:-1], order[1:]
    lag = second - first
    hit = (grams[first] == grams[second]) & (lag >= low) & (lag < high)
    lag, place = lag[hit], first[hit]
    by_lag = np.lexsort((place, lag))
    return lag[by_lag], place[by_lag]


def runs_of(ids: np.ndarray) -> list[Run]:
    """(start, length, period) of every run in a sequence of word numbers, by start, then period."""
    n, found = len(ids), []
    grams, k, low = ids.astype(np.int64), 1, 1
    while 2 * k <= n and TIMES * low <= n and n >= LEAST:
        grams, repeated = _joined(grams, k)
        k *= 2
        if not repeated:
            break
        if k < FIRST_GRAM:
            continue
        lags, places = _seeds(grams, low, k)
        low = k
        cuts = np.flatnonzero(np.diff(lags, prepend=-1, append=-1))
        furthest: dict[int, int] = {}  # the first word behind what is covered, for each lag
        for begin, end in zip(cuts.tolist(), cuts[1:].tolist()):
            q, here = int(lags[begin]), places[begin:end]
            at = 0
            while at < len(here):
                seed = int(here[at])
                start = seed - _agree(ids, seed - 1, seed - 1 + q, -1)
                furthest[q] = seed + _agree(ids, seed, seed + q, 1)
                length = furthest[q] - start + q
                if length >= max(LEAST, TIMES * q):
                    found.append((start, length, q))
                at = int(np.searchsorted(here, furthest[q]))
    return sorted(found, key=lambda r: (r[0], r[2]))


def numbered(words: list[bytes]) -> np.ndarray:
    """A number for each word, equal for equal words."""
    seen: dict[bytes, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))


def kept(n: int, runs: list[Run]) -> np.ndarray:
    """Which of n words stay if each run keeps only its first period."""
    edges = np.zeros(n + 1, np.int64)
    for start, length, q in runs:
        edges[start + q] += 1
        edges[start + length] -= 1
    return np.cumsum(edges[:-1]) == 0


def strongest(runs: list[Run]) -> Run | None:
    """The run with the greatest length / period; then the smallest start, then period."""
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return best


def planted(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words with the periodic tail that the query gives one document in ten.

    A row without a doc_id keeps its words.
    """
    if doc_id is None or not words:
        return words
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    block = words[a : a + p]
    return words[:a] + (block * ((n - a) // p + 1))[: n - a]


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", plant: bool = True) -> DataFrame:
    """Per row: doc_id, n_runs, the strongest run and digests of all runs and of the kept words.

    ``plant``: as the query wants it, over the words of :func:`planted`.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, value in zip(batch.column(0), batch.column(1)):
                words = (value.as_py() or b"").split()
                if plant:
                    words = planted(words, key.as_py())
                runs = runs_of(numbered(words))
                listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()
                rest = [words[i] for i in np.flatnonzero(kept(len(words), runs)).tolist()] if runs else words
                best = strongest(runs)
                start, length, period = best or (None, None, None)
                out.append((len(runs), start, length, period, 1000 * length // period if best else None,
                            hashlib.sha256(listed).hexdigest(),
                            hashlib.sha256(b" ".join(rest)).hexdigest()))
            columns = list(zip(*out)) or [()] * 7
            arrays = [pa.array(x, pa.int64()) for x in columns[:5]] + [pa.array(x, pa.string()) for x in columns[5:]]
            yield pa.record_batch([batch.column(0), *arrays], names=["doc_id", *_FIGURES])

    plain = docs.select(col(doc_id).alias("doc_id"), col(text).cast("binary").alias("text"))
    schema = plain.select("doc_id").schema
    for name in _FIGURES:
        schema = schema.add(name, "string" if name.endswith("sha256") else "long")
    return plain.mapInArrow(run, schema)


_FIGURES = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def detected(docs: DataFrame, text: str = "text", runs: str = "runs") -> DataFrame:
    """``docs`` with an array of the runs of each text: start, length, period (in words)."""
    (name, helper) = fresh(docs, runs, "bytes_of_row")
    kind = pa.list_(pa.struct([(x, pa.int64()) for x in ("start", "length", "period")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for value in batch.column(batch.num_columns - 1):
                runs = runs_of(numbered((value.as_py() or b"").split()))
                found.append([dict(zip(("start", "length", "period"), r)) for r in runs])
            yield _replaced(batch, name, pa.array(found, kind))

    wide = docs.select(*[col(c) for c in docs.columns], col(text).cast("binary").alias(helper))
    kind_of_runs = F.lit(None).cast("array<struct<start:long,length:long,period:long>>")
    return wide.mapInArrow(run, docs.withColumn(name, kind_of_runs).schema)


def collapsed(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with each run of a text cut down to its first period.

    Texts without a run stay as they are; of others the kept words are joined by one space.
    """
    (helper,) = fresh(docs, "bytes_of_row")
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for value in batch.column(batch.num_columns - 1):
                raw = value.as_py()
                words = (raw or b"").split()
                runs = runs_of(numbered(words))
                if runs:
                    raw = b" ".join(words[i] for i in np.flatnonzero(kept(len(words), runs)).tolist())
                texts.append(raw)
            new = pa.array(texts, pa.binary()).cast(batch.schema.field(at).type)
            columns = [new if k == at else c for k, c in enumerate(batch.columns[:-1])]
            yield pa.record_batch(columns, names=batch.schema.names[:-1])

    wide = docs.select(*[col(c) for c in docs.columns], col(text).cast("binary").alias(helper))
    return wide.mapInArrow(run, docs.schema)


def _replaced(batch: pa.RecordBatch, name: str, column: pa.Array) -> pa.RecordBatch:
    """The batch with its last column replaced."""
    return pa.record_batch([*batch.columns[:-1], column], names=[*batch.schema.names[:-1], name])
