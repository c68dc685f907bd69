"""Spelling variants: frequent words that are one edit apart, probed through Bloom filters.

Words are counted over all texts (sums before the shuffle).  Two words are near if exactly
one inserted, deleted or replaced code point turns one into the other.  A pair that differs
by a replacement is found from the word with the smaller code point, one that differs by a
deletion from the longer word, so each pair comes from one side and once.

The edits of a word are generated as hashes only: of a polynomial hash modulo 2**64 an edit
changes one term or shifts the rest, so all edits of the words of a length are a few numpy
operations.  They are probed against blocked Bloom filters, one for each word length (the
longest share one), that are made by Spark and broadcast.  Their size is ``MOST_BYTES`` at
most, whatever the vocabulary: beyond that they only let more through.  Edits that a filter
lets through are spelled out and joined with the vocabulary by the word itself, which
removes the false ones.  Words without such an edit shuffle nothing but themselves.

The form of a word is its near word of most occurrences if that has ``FACTOR`` times as many,
and its root the last form of the chain.  A chain has at most log(FACTOR) of the greatest
count steps, so pointer jumping settles it in a known number of joins.

Defined results: a null text has no words; a null doc_id is written as nothing.  Repeated
rows count again.  Ties go to the word that is smaller in code-point order.  An empty table
gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.llm.common import ascii_lower, col, stored

#: Fixed values of the contract: what a word is, and when a form stands for a word.
RUN = r"[A-Za-zÀ-ÿ]+"
LEAST_LENGTH, LEAST_COUNT, FACTOR = 6, 5, 5
#: One run in so many loses a code point before the words are counted.
PLANT_EVERY = 199

BITS_PER_WORD, BITS_PER_LONG_WORD = 14, 64
#: Words of this many code points or more share a filter, with more bits a word, as their
#: edits are many and long.
LONG = 32
MOST_BYTES = 32 << 20
LANES = 8
PROBES_AT_ONCE = 1 << 20

_BASE = 0x9E3779B97F4A7C15
_UNBASE = np.uint64(pow(_BASE, -1, 1 << 64))
_MIX = [np.uint64(x) for x in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)]
#: Odd multipliers, one for each lane of a block.
_SALTS = np.array([pow(_MIX[0].item(), k + 2, 1 << 64) for k in range(LANES)], np.uint64)


def vocabulary(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", plant: bool = True) -> DataFrame:
    """word, n: words of LEAST_LENGTH or more with LEAST_COUNT or more occurrences.

    ``plant``: as the query wants it, runs that a checksum picks lose one code point.
    """
    run = F.explode(F.regexp_extract_all(ascii_lower(col(text)), F.lit(RUN), F.lit(0))).alias("run")
    key = F.coalesce(col(doc_id).cast("string"), F.lit("")).alias("key")
    words = docs.select(key, run).where(F.char_length("run") >= LEAST_LENGTH)
    if plant:
        words = words.withColumn("h", F.crc32(F.concat("key", F.lit(":"), "run")))
        at = (F.col("h") % F.char_length("run")).cast("int")
        shorter = F.concat(
            F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.char_length("run"))
        )
        words = words.withColumn("run", F.when(F.col("h") % PLANT_EVERY == 0, shorter).otherwise(F.col("run")))
        words = words.where(F.char_length("run") >= LEAST_LENGTH)
    return words.groupBy(F.col("run").alias("word")).agg(F.count("*").alias("n")).where(f"n >= {LEAST_COUNT}")


# -- hashes of words and of their edits ------------------------------------------------


def _points(words: list[str], length: int) -> np.ndarray:
    """A row of code points for each of the words, which all have ``length``."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(-1, length).astype(np.uint64)


def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.r_[np.uint64(1), np.full(n, _BASE, np.uint64)], dtype=np.uint64)


def _hashes(points: np.ndarray) -> np.ndarray:
    return (points * _powers(points.shape[1] - 1)).sum(1, dtype=np.uint64)


def _by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray]]:
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    for length in np.unique(sizes).tolist():
        yield length, np.flatnonzero(sizes == length)


def _shard(length: int) -> int:
    return min(length, LONG)


@dataclass
class Filters:
    """Blocks of LANES 64-bit words, by shard."""

    blocks: dict[int, np.ndarray]

    def hits(self, shard: int, hashes: np.ndarray) -> np.ndarray:
        """Which of the hashes may be those of a word of the shard."""
        there = np.zeros(len(hashes), bool)
        blocks = self.blocks.get(shard)
        if blocks is None:
            return there
        left = np.arange(len(hashes))
        block, mixed = _places(hashes, len(blocks))
        for lane in range(LANES):
            bit = mixed[left] * _SALTS[lane] >> np.uint64(58)
            left = left[(blocks[block[left], lane] >> bit & np.uint64(1)).astype(bool)]
        there[left] = True
        return there


def _places(hashes: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Block of each hash, and the value that picks its bits there."""
    x = hashes ^ hashes >> np.uint64(33)
    x = x * _MIX[0]
    x ^= x >> np.uint64(29)
    return ((x >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int64), x * _MIX[1]


def _sizes(words: DataFrame) -> dict[int, int]:
    """Blocks of each shard: together MOST_BYTES at most (or one block each)."""
    shard = F.least(F.char_length("word"), F.lit(LONG)).alias("shard")
    counts = {r.shard: r.n for r in words.groupBy(shard).agg(F.count("*").alias("n")).collect()}
    wanted = {s: n * (BITS_PER_LONG_WORD if s == LONG else BITS_PER_WORD) for s, n in counts.items()}
    scale = min(1.0, 8 * MOST_BYTES / max(1, sum(wanted.values())))
    return {s: max(1, int(scale * bits / (64 * LANES))) for s, bits in wanted.items()}


def filters(words: DataFrame) -> Filters:
    """Bloom filters of the words, put together by bitwise or in tasks and after the shuffle."""
    sizes = _sizes(words)
    lanes = [f"w{k}" for k in range(LANES)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for length, rows in _by_length(texts):
                hashes = _hashes(_points([texts[i] for i in rows.tolist()], length))
                block, mixed = _places(hashes, sizes[_shard(length)])
                used, at = np.unique(block, return_inverse=True)
                bits = np.zeros((len(used), LANES), np.uint64)
                for lane in range(LANES):
                    bit = np.uint64(1) << (mixed * _SALTS[lane] >> np.uint64(58))
                    np.bitwise_or.at(bits[:, lane], at, bit)
                yield pa.record_batch(
                    [pa.array(np.full(len(used), _shard(length), np.int32)), pa.array(used)]
                    + [pa.array(np.ascontiguousarray(bits[:, k]).view(np.int64)) for k in range(LANES)],
                    names=["shard", "block", *lanes],
                )

    schema = "shard int, block long, " + ", ".join(f"{k} long" for k in lanes)
    parts = words.select("word").mapInArrow(run, schema)
    table = parts.groupBy("shard", "block").agg(*[F.bit_or(k).alias(k) for k in lanes]).toArrow()
    out = {s: np.zeros((n, LANES), np.uint64) for s, n in sizes.items()}
    shard, block = (table[k].to_numpy() for k in ("shard", "block"))
    bits = np.stack([table[k].to_numpy().astype(np.int64).view(np.uint64) for k in lanes], 1)
    for s, own in out.items():
        own[block[shard == s]] = bits[shard == s]
    return Filters(out)


def alphabet(words: DataFrame) -> list[int]:
    """Code points that words have; there are 90 at most."""
    one = F.explode(F.array_distinct(F.split("word", ""))).alias("c")
    return sorted(ord(r.c) for r in words.select(one).where("c != ''").distinct().collect())


# -- near words ---------------------------------------------------------------------------


def _deleted(points: np.ndarray, hashes: np.ndarray, known: Filters) -> Iterator[tuple[int, int, None]]:
    """Row and place of deletions that may give a word."""
    rows, length = points.shape
    powers = _powers(length - 1)
    step = max(1, PROBES_AT_ONCE // rows)
    before = np.zeros(rows, np.uint64)
    for start in range(0, length, step):
        part = points[:, start : start + step]
        terms = part * powers[start : start + step]
        upto = before[:, None] + np.cumsum(terms, 1, dtype=np.uint64)
        edits = upto - terms + (hashes[:, None] - upto) * _UNBASE
        first = np.ones(part.shape, bool)  # of equal neighbours only the first is deleted
        first[:, 1:] = part[:, 1:] != part[:, :-1]
        if start:
            first[:, 0] = part[:, 0] != points[:, start - 1]
        row, place = np.nonzero(first)
        hit = known.hits(_shard(length - 1), edits[row, place])
        for r, p in zip(row[hit].tolist(), place[hit].tolist()):
            yield r, start + p, None
        before = upto[:, -1]


def _replaced(points: np.ndarray, hashes: np.ndarray, known: Filters, letters: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Row, place and new code point of replacements by a greater one that may give a word."""
    rows, length = points.shape
    powers = _powers(length - 1)
    step = max(1, PROBES_AT_ONCE // (rows * max(1, len(letters))))
    for start in range(0, length, step):
        part = points[:, start : start + step, None]
        row, place, letter = np.nonzero(letters > part)
        change = (letters[letter] - part[row, place, 0]) * powers[start + place]
        hit = known.hits(_shard(length), hashes[row] + change)
        for r, p, c in zip(row[hit].tolist(), place[hit].tolist(), letters[letter[hit]].tolist()):
            yield r, start + p, c


def near_pairs(words: DataFrame) -> DataFrame:
    """a, n_a, b, n_b: each pair of near words of ``words`` (word, n) once."""
    known = words.sparkSession.sparkContext.broadcast((filters(words), np.array(alphabet(words), np.uint64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, letters = known.value
        for batch in batches:
            texts, counts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for length, rows in _by_length(texts):
                for begin in range(0, len(rows), 4096):
                    own = [texts[i] for i in rows[begin : begin + 4096].tolist()]
                    n = [counts[i] for i in rows[begin : begin + 4096].tolist()]
                    points = _points(own, length)
                    hashes = _hashes(points)
                    found = [*_replaced(points, hashes, held, letters)]
                    if length > LEAST_LENGTH:
                        found += _deleted(points, hashes, held)
                    for first in range(0, len(found), 4096):
                        yield _edits(own, n, found[first : first + 4096])

    guesses = words.select("word", "n").mapInArrow(run, "a string, n_a long, b string")
    return guesses.join(words.select(F.col("word").alias("b"), F.col("n").alias("n_b")), "b").select(
        "a", "n_a", "b", "n_b"
    )


def _edits(words: list[str], counts: list[int], found: list) -> pa.RecordBatch:
    """The words with the edits spelled out."""
    new = [words[r][:p] + ("" if c is None else chr(c)) + words[r][p + 1 :] for r, p, c in found]
    columns = [
        pa.array([words[r] for r, _, _ in found], pa.string()),
        pa.array([counts[r] for r, _, _ in found], pa.int64()),
        pa.array(new, pa.string()),
    ]
    return pa.record_batch(columns, names=["a", "n_a", "b"])


# -- forms and roots --------------------------------------------------------------------


def _roots(told: DataFrame, most: int) -> DataFrame:
    """word, root for the words that have a form."""
    links = told.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    longest = math.floor(math.log(max(most, FACTOR), FACTOR) + 1e-9)  # each step times FACTOR
    for _ in range(math.ceil(math.log2(longest)) if longest > 1 else 0):
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        links = links.join(onward, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root")
        )
        links = stored(links, "variant-roots")
    return links


def grouped(words: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n for each row of ``words`` (word, n; words are distinct)."""
    pairs = near_pairs(words)
    both = pairs.select(F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.col("n_a").alias("n"), F.col("b").alias("near"), F.col("n_b").alias("near_n")),
        F.struct(F.col("b").alias("word"), F.col("n_b").alias("n"), F.col("a").alias("near"), F.col("n_a").alias("near_n")),
    )).alias("x")).select("x.*")
    alone = words.select("word", "n", F.lit(None).cast("string").alias("near"), F.lit(None).cast("long").alias("near_n"))
    best = F.min(F.when(F.col("near").isNotNull(), F.struct((-F.col("near_n")).alias("less"), "near")))
    told = both.union(alone).groupBy("word").agg(
        F.max("n").alias("n"), F.count("near").alias("n_near"), best.alias("best")
    )
    enough = -F.col("best.less") >= FACTOR * F.col("n")
    told = stored(told.select(
        "word", "n", "n_near",
        F.when(enough, F.col("best.near")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n"),
    ), "variants")
    most = told.agg(F.max("n")).first()[0] or 0
    return told.join(_roots(told, most), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", plant: bool = True) -> DataFrame:
    """The words of a table of texts with their forms and roots."""
    return grouped(stored(vocabulary(docs, doc_id, text, plant), "vocabulary"))
