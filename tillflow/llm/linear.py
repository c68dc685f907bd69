"""Linear text classifiers, fitted with numpy on a bounded sample of labelled rows.

Features of a text, taken from its UTF-8 bytes with numpy: the first ``START`` bytes of each
run of letters and digits, A-Z in lower case, and the last two bytes of each word between
spaces, hashed into ``BUCKETS``.  Of runs with more bytes, the whole run and every ``GRAM``
characters of it are features, too, so that all bytes of a text count; models see texts in
Unicode lower case (``whole``).  A fit takes at most about ``FIT_ROWS`` labelled rows, chosen by a hash of
their id, and keeps the ``FEATURES`` buckets that tell the classes apart best.  Scoring
covers whole texts of all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType

from tillflow.llm.common import col, stored

BITS = 18
BUCKETS = 1 << BITS
START = 5
GRAM = 3
PORTION_BYTES = 2 << 20
#: Bound on the labelled rows of a fit.
FIT_ROWS = 8_000
#: Bound on the features of a model; buckets that are looked at for a label, and the entries
#: (row, bucket) of those that a fit takes.
FEATURES = 3_000
CANDIDATES = 4_000
FIT_ENTRIES = 4_000_000
STEPS, RATE, RIDGE = 150, 0.1, 1e-4
#: A byte of a letter or digit, A-Z in lower case; zero for any other.
_LETTER = np.array(
    [ord(chr(b).lower()) if b < 128 and chr(b).isalnum() else b * (b > 127) for b in range(256)], np.uint8
)
_SPACE = np.array([b == 32 or 9 <= b <= 13 for b in range(256)])
#: An odd multiplier that spreads a key over the upper bits.
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
#: Odd multipliers: of characters within a gram, of places within a run, and of whole runs.
_PLACES = [np.uint64(x) for x in (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
_STEP, _RUN = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def _rows_between(spots: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many of the sorted ``spots`` each row has; ``bounds``: where rows begin and end."""
    return np.diff(np.searchsorted(spots, bounds))


def _long_runs(low: np.ndarray, first: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and keys of the whole runs of over START bytes and of each GRAM characters in them.

    ``low``: the bytes, zero where there is no letter; runs go from ``first`` to ``stop``.
    """
    far = stop - first > START
    first, stop = first[far], stop[far]
    if not len(first):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    edge = np.zeros(len(low) + 1, np.int8)
    edge[first], edge[stop] = 1, -1
    inside = np.cumsum(edge[:-1], dtype=np.int8) > 0
    more = low & 0xC0 == 0x80  # inside a character
    more[first] = False
    char = np.flatnonzero(inside & ~more)
    code = low[char].astype(np.uint64)
    going = np.ones(len(char), bool)
    for k in range(1, 4):
        at = np.minimum(char + k, len(low) - 1)
        going &= more[at] & inside[at]
        if not going.any():
            break
        code |= np.where(going, low[at], 0).astype(np.uint64) << np.uint64(8 * k)
    begin = np.searchsorted(char, first)
    size = np.diff(np.append(begin, len(char)))
    place = np.arange(len(char)) - np.repeat(begin, size)
    powers = np.cumprod(np.full(int(size.max()), _STEP), dtype=np.uint64)
    run = np.add.reduceat((code + np.uint64(1)) * powers[place], begin)
    run = (run ^ run >> np.uint64(31)) * _RUN
    ends = np.repeat(size, size) - place
    gram = np.flatnonzero(ends >= GRAM)
    key = np.zeros(len(gram), np.uint64)
    for k in range(GRAM):
        key += code[gram + k] * _PLACES[k]
    key = (key ^ key >> np.uint64(29)) * _PLACES[0]
    return np.concatenate([first, char[gram]]), np.concatenate([run, key])


def _in_portion(data: np.ndarray, bounds: np.ndarray, wanted: np.ndarray | None, whole: bool):  # noqa: ANN202
    """Row, bucket and count of the features of some bytes, and the words of each row.

    Every row ends with a space, so no word crosses rows.
    """
    n, rows = len(data), len(bounds) - 1
    low = np.zeros(n + START, np.uint8)
    np.take(_LETTER, data, out=low[:n])
    there = low[:n] > 0
    first = np.flatnonzero(there & ~np.concatenate([[False], there[:-1]]))
    key, inside = low[first].astype(np.uint64), np.ones(len(first), bool)
    for k in range(1, START):
        letter = low[first + k]
        inside &= letter > 0
        key |= np.where(inside, letter, 0).astype(np.uint64) << np.uint64(8 * k)
    space = _SPACE[data]
    last = np.flatnonzero(~space[:-1] & space[1:])
    before = np.where((last > 0) & ~space[last - 1], data[last - 1], 0).astype(np.uint64)
    end = data[last].astype(np.uint64) | before << np.uint64(8) | np.uint64(1 << 40)
    n_words = _rows_between(last, bounds)
    at = (np.concatenate([key, end]) * _SPREAD >> np.uint64(64 - BITS)).astype(np.int64)
    each = np.arange(rows)
    row = np.concatenate([np.repeat(each, _rows_between(first, bounds)), np.repeat(each, n_words)])
    if whole:
        stop = np.flatnonzero(there & ~np.concatenate([there[1:], [False]])) + 1
        spots, keys = _long_runs(low[:n], first, stop)
        row = np.concatenate([row, np.searchsorted(bounds, spots, "right") - 1])
        at = np.concatenate([at, (keys * _SPREAD >> np.uint64(64 - BITS)).astype(np.int64)])
    if wanted is not None:
        hit = wanted[at]
        row, at = row[hit], at[hit]
    both, count = np.unique(row << BITS | at, return_counts=True)
    return both >> BITS, both & (BUCKETS - 1), count, n_words


def _lower(texts: pa.Array) -> pa.Array:
    try:
        return pc.utf8_lower(texts)
    except pa.ArrowInvalid:  # bytes that are no UTF-8
        raw = texts.cast(pa.large_binary()).to_pylist()
        return pa.array([x.decode("utf-8", "replace").lower() for x in raw], pa.large_string())


def features(texts: pa.Array, wanted: np.ndarray | None = None, whole: bool = False):  # noqa: ANN201
    """Row, bucket and count of each feature of the texts, and the number of words of each text.

    ``wanted``: a flag for each bucket; the others are left out.  ``whole``: in Unicode lower
    case, and with what runs have beyond START bytes.  Texts of about
    PORTION_BYTES together are worked on at a time; a longer text is a portion of its own.
    """
    filled = pc.fill_null(texts.cast(pa.large_string()), "")
    if whole:
        filled = _lower(filled)
    closed = pc.binary_join_element_wise(filled, *(pa.scalar(x, pa.large_string()) for x in ("", " ")))
    empty = np.zeros(0, np.int64)
    found = [(empty, empty, empty, empty)]
    bounds = np.frombuffer(closed.buffers()[1], np.int64)[: len(closed) + 1] if len(closed) else empty
    data = np.frombuffer(closed.buffers()[2], np.uint8) if len(closed) else empty
    start = 0
    while start < len(closed):
        stop = int(np.searchsorted(bounds, bounds[start] + PORTION_BYTES, "right")) - 1
        stop = min(max(stop, start + 1), len(closed))
        part = data[bounds[start] : bounds[stop]]
        row, at, count, words = _in_portion(part, bounds[start : stop + 1] - bounds[start], wanted, whole)
        found.append((row + start, at, count, words))
        start = stop
    return tuple(np.concatenate(x) for x in zip(*found))


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        row, at, count, _ = features(batch.column("text"), whole=True)
        ends = pa.array(np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32))
        yield pa.record_batch({
            **{name: batch.column(name) for name in ("chosen", "label_id", "rest", "label")},
            "at": pa.ListArray.from_arrays(ends, pa.array(at, pa.int32())),
            "n": pa.ListArray.from_arrays(ends, pa.array(count, pa.int32())),
        })


@dataclass
class Sample:
    """Sparse rows: entry i is in row ``row[i]``, bucket ``at[i]``, with value ``value[i]``."""

    labels: np.ndarray
    row: np.ndarray
    at: np.ndarray
    value: np.ndarray


def sample(docs: DataFrame, labelled: DataFrame, label: Column, doc_id: str, text: str) -> Sample:
    """At most about FIT_ROWS rows with a label (a list of ints), in the order of a hash.

    A label of a doc_id that several rows have belongs to each of them.  Features stay in
    files: Spark counts each bucket by label, from these counts ``CANDIDATES`` buckets are
    chosen for each label, and only what the chosen buckets have of the first rows with
    FIT_ENTRIES entries together comes to the driver.
    """
    known = labelled.select(col("doc_id").alias("label_id"), label.alias("label")).where(
        "label IS NOT NULL AND label_id IS NOT NULL"
    )
    n = known.count()
    order = F.xxhash64("label_id", F.lit("fit"))
    if n > FIT_ROWS:
        known = known.where(F.pmod(order, F.lit(1_000_003)) < int(1_000_003 * FIT_ROWS / n))
    texts = (
        docs.select(col(doc_id).alias("label_id"), col(text).alias("text"))
        .join(known, "label_id")
        .select(order.alias("chosen"), "label_id", F.xxhash64("text").alias("rest"), "label", "text")
    )
    schema = texts.drop("text").schema.add("at", ArrayType(IntegerType())).add("n", ArrayType(IntegerType()))
    rows = stored(
        texts.mapInArrow(_extracted, schema)
        .groupBy("chosen", "label_id", "rest")
        .agg(F.min(F.struct("label", "at", "n")).alias("row"), F.count("*").alias("copies"))
        .select("chosen", "label_id", "rest", "copies", "row.*"),
        "fit-sample",
    )
    flags = np.zeros(BUCKETS, bool)
    flags[_candidates(rows)] = True
    hits = stored(rows.mapInArrow(_only(flags), rows.schema), "fit-hits")
    key = ["chosen", "label_id", "rest"]
    keys = hits.select(*key, F.size("at").alias("size"), "copies").orderBy(*key).limit(2 * FIT_ROWS).toArrow()
    copies, size = (keys[x].to_numpy() for x in ("copies", "size"))
    copies = np.minimum(copies, np.maximum(1, FIT_ENTRIES // 4 // np.maximum(size, 1)))
    copies = np.diff(np.minimum(np.cumsum(copies), 2 * FIT_ROWS), prepend=0)
    copies = copies[(copies > 0) & (np.cumsum(size * copies) <= FIT_ENTRIES)]
    if not len(copies):
        return Sample(np.zeros((0, 1), np.int64), *(np.zeros(0, np.int32),) * 2, np.zeros(0, np.float32))
    last = keys.slice(len(copies) - 1, 1).to_pylist()[0]
    upto = F.struct(*[F.lit(last[k]).cast(hits.schema[k].dataType).alias(k) for k in key])
    table = hits.where(F.struct(*key) <= upto).orderBy(*key).select("label", "at", "n").toArrow()
    table = table.take(np.repeat(np.arange(len(copies)), copies))
    lists = [table[x].combine_chunks() for x in ("label", "at", "n")]
    flat = [np.concatenate([c.flatten().to_numpy() for c in _chunks(x)]) for x in lists]
    sizes = np.concatenate([c.value_lengths().to_numpy() for c in _chunks(lists[1])])
    row = np.repeat(np.arange(table.num_rows, dtype=np.int32), sizes)
    labels = flat[0].astype(np.int64).reshape(table.num_rows, -1)
    return Sample(labels, row, flat[1], np.log1p(flat[2].astype(np.float32)))


def _only(flags: np.ndarray):  # noqa: ANN202
    """Leaves rows the entries of flagged buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column("at")
            hit = flags[at.flatten().to_numpy()]
            before = np.concatenate([[0], np.cumsum(hit)])
            ends = np.concatenate([[0], np.cumsum(at.value_lengths().to_numpy())])
            offsets = pa.array(before[ends].astype(np.int32))
            yield pa.record_batch({
                **{name: batch.column(name) for name in batch.schema.names if name not in ("at", "n")},
                **{name: pa.ListArray.from_arrays(offsets, pa.array(batch.column(name).flatten().to_numpy()[hit]))
                   for name in ("at", "n")},
            })

    return run


def _candidates(rows: DataFrame) -> np.ndarray:
    """The buckets that tell the values of a label apart best, for each of the labels.

    The counts are a sum of Spark over all rows; at most BUCKETS numbers for each value of
    a label come to the driver.
    """
    width = (rows.agg(F.max(F.size("label"))).first()[0]) or 0
    chosen = [np.zeros(0, np.int64)]
    for k in range(width):
        y = F.get("label", k).alias("y")
        of_class = {r.y: r.n for r in rows.groupBy(y).agg(F.count("*").alias("n")).collect()}
        table = rows.select(y, F.explode("at").alias("b")).groupBy("y", "b").agg(
            F.count("*").cast("int").alias("n")
        ).toArrow()
        there = np.zeros((len(of_class), BUCKETS))
        place = {v: j for j, v in enumerate(sorted(of_class))}
        of = np.array([of_class[v] for v in sorted(of_class)], float)[:, None]
        values, buckets, counts = (table[x].to_numpy() for x in ("y", "b", "n"))
        for v, j in place.items():
            there[j, buckets[values == v]] = counts[values == v]
        gain = _gain(there, of)
        best = np.argsort(-gain, kind="stable")[:CANDIDATES]
        chosen.append(best[gain[best] > 0])
    return np.unique(np.concatenate(chosen))


def _chunks(x):  # noqa: ANN001, ANN202
    return x.chunks if isinstance(x, pa.ChunkedArray) else [x]


def _gain(there: np.ndarray, of_class: np.ndarray) -> np.ndarray:
    """Mutual information of each bucket with the class; rows that have it, by class."""
    n = of_class.sum()
    with np.errstate(divide="ignore", invalid="ignore"):
        joint = np.stack([there, of_class - there]) / n
        apart = joint.sum(1, keepdims=True) * (of_class / n)[None]
        return np.nansum(np.where(joint > 0, joint * np.log(joint / apart), 0.0), (0, 1))


def telling(data: Sample, label: np.ndarray, classes: int) -> np.ndarray:
    """The buckets with the most mutual information with the label."""
    if not len(label):
        return np.zeros(0, np.int64)
    there = np.zeros((classes, BUCKETS))
    for c in range(classes):
        there[c] = np.bincount(data.at[label[data.row] == c], minlength=BUCKETS)
    gain = _gain(there, np.bincount(label, minlength=classes).astype(float)[:, None])
    best = np.argsort(-gain, kind="stable")[:FEATURES]
    return np.sort(best[gain[best] > 0])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


@dataclass
class Linear:
    """Scores of classes: weights of buckets and of extra dense columns, and constants."""

    buckets: np.ndarray
    weights: np.ndarray
    dense: np.ndarray
    constant: np.ndarray

    def scores(self, at: np.ndarray, value: np.ndarray, row: np.ndarray, rows: int,
               extra: np.ndarray) -> np.ndarray:
        out = np.tile(self.constant, (rows, 1)) + extra @ self.dense
        if len(self.buckets) and len(at):
            k = np.minimum(np.searchsorted(self.buckets, at), len(self.buckets) - 1)
            hit = self.buckets[k] == at
            for c in range(out.shape[1]):
                out[:, c] += np.bincount(row[hit], self.weights[k[hit], c] * value[hit], rows)
        return out


def fit(data: Sample, label: np.ndarray, classes: int, extra: np.ndarray | None = None,
        rows: np.ndarray | None = None) -> Linear:
    """Softmax regression by Adam over ``rows`` (a mask; all by default)."""
    n = len(label)
    extra = np.zeros((n, 0)) if extra is None else extra
    mask = np.ones(n, bool) if rows is None else rows
    part = Sample(data.labels, *(x[mask[data.row]] for x in (data.row, data.at, data.value)))
    place = np.cumsum(mask) - 1
    part.row, y, dense = place[part.row], label[mask], extra[mask]
    buckets = telling(part, y, classes)
    model = Linear(buckets, np.zeros((len(buckets), classes)), np.zeros((extra.shape[1], classes)),
                   np.log((np.bincount(y, minlength=classes) + 1.0) / (len(y) + classes)))
    if not len(y):
        return model
    if len(buckets):
        k = np.minimum(np.searchsorted(buckets, part.at), len(buckets) - 1)
        hit = buckets[k] == part.at
        k, row, value = k[hit], part.row[hit], part.value[hit]
    else:
        k, row, value = (np.zeros(0, np.int64),) * 3
    target = np.eye(classes)[y]
    params = [model.weights, model.dense, model.constant]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, STEPS + 1):
        z = np.tile(model.constant, (len(y), 1)) + dense @ model.dense
        for c in range(classes):
            z[:, c] += np.bincount(row, model.weights[k, c] * value, len(y))
        off = (softmax(z) - target) / len(y)
        by_bucket = [np.bincount(k, off[row, c] * value, len(buckets)) for c in range(classes)]
        grads = [np.stack(by_bucket, 1) + RIDGE * model.weights, dense.T @ off + RIDGE * model.dense,
                 off.sum(0)]
        for p, g, m, v in zip(params, grads, first, second):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return model


def scored(docs: DataFrame, carry: list[str], text: str, outputs: int, wanted: np.ndarray,
           score, purpose: str) -> DataFrame:  # noqa: ANN001
    """``carry``, n_words and probabilities (an array) of each row, written to shared files.

    ``wanted``: the buckets that the models use.  ``score`` maps (buckets, values, rows, number of rows) to an array of probabilities.
    """
    names = [f"c{k}" for k in range(len(carry))]
    flags = np.zeros(BUCKETS, bool)
    flags[wanted] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, at, count, n_words = features(batch.column(batch.num_columns - 1), flags, whole=True)
            value = np.log1p(count.astype(np.float64))
            p = score(at, value, row, batch.num_rows)
            flat = pa.array(np.ascontiguousarray(p).reshape(-1), pa.float64())
            ends = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * outputs)
            yield pa.record_batch(
                [*batch.columns[:-1], pa.array(n_words, pa.int64()), pa.ListArray.from_arrays(ends, flat)],
                names=[*names, "n_words", "p"],
            )

    plain = docs.select(*[col(c).alias(k) for c, k in zip(carry, names)], col(text).alias("text"))
    schema = plain.drop("text").schema.add("n_words", "long").add("p", ArrayType(DoubleType()))
    out = stored(plain.mapInArrow(run, schema), purpose)
    return out.select(*[F.col(k).alias(c) for c, k in zip(carry, names)], "n_words", "p")
