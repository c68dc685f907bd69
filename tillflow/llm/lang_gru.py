"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads windows of ``WINDOW`` bytes in both directions and labels every byte;
a document's probabilities are the means over all its bytes.  It is trained in numpy by
backpropagation through time on all windows of about ``PER_LANG`` documents of each language,
chosen by a hash, among those whose crc32(doc_id as text) mod 5 isn't 0.  Of more windows of a
language than its steps can take twice, those with the least hashes come to the driver, drawn
by Spark from the whole texts.  Prediction covers every byte of every text.  Only the text is an input of a prediction.

Defined results: a null text or one without a letter is ``und`` with score 0.  Without any
row to learn from everything is ``und``.  A row without a doc_id counts as held out.  Every
language is learned; more than ``LANGS_A_FIT`` take so many times the steps.  Repeated rows are
predicted each.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillflow.llm.common import col

WINDOW = 128
HIDDEN = 8
LANGS_A_FIT = 16
#: Bound on the documents of a language that a fit sees.
PER_LANG = 300
TRAIN_BYTES, BATCH, STEPS, RATE = 64, 256, 220, 0.02
PORTION_WINDOWS = 4096
PAD = 256
_LETTER = regex.compile(r"\p{L}")


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


class Network:
    """Weights: table (byte to gates), loop (state to gates) for each direction, and a head."""

    def __init__(self, langs: int, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        draw = lambda *s: (rng.standard_normal(s) * 0.3).astype(np.float32)
        self.table = [draw(PAD + 1, 3 * HIDDEN) for _ in range(2)]
        self.loop = [draw(HIDDEN, 3 * HIDDEN) for _ in range(2)]
        self.head, self.base = draw(2 * HIDDEN, langs), np.zeros(langs, np.float32)

    def params(self) -> list[np.ndarray]:
        return [*self.table, *self.loop, self.head, self.base]

    def states(self, x: np.ndarray, way: int, trace: list | None = None) -> np.ndarray:
        """The state after each byte (time first); way 1 reads from the end."""
        rows, length = x.shape
        out = np.zeros((length, rows, HIDDEN), np.float32)
        h = np.zeros((rows, HIDDEN), np.float32)
        table, loop, k = self.table[way], self.loop[way], HIDDEN
        for t in range(length - 1, -1, -1) if way else range(length):
            gates, fed = table[x[:, t]], h @ loop
            zr = _sigmoid(gates[:, : 2 * k] + fed[:, : 2 * k])
            z, r = zr[:, :k], zr[:, k:]
            new = np.tanh(gates[:, 2 * k :] + r * fed[:, 2 * k :])
            there = (x[:, t] != PAD)[:, None]
            if trace is not None:
                trace.append((t, h, z, r, new, fed[:, 2 * k :], there))
            h = (new + z * (h - new)) * there
            out[t] = h
        return out

    def labels(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of each language at each byte (time first)."""
        both = np.concatenate([self.states(x, 0), self.states(x, 1)], 2)
        score = both @ self.head + self.base
        score = np.exp(score - score.max(2, keepdims=True))
        return score / score.sum(2, keepdims=True)

    def gradients(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        """Of the mean cross-entropy over all bytes, through time."""
        traces: list[list] = [[], []]
        both = np.concatenate([self.states(x, w, traces[w]) for w in (0, 1)], 2)
        score = both @ self.head + self.base
        p = np.exp(score - score.max(2, keepdims=True))
        p /= p.sum(2, keepdims=True)
        there = (x.T != PAD).astype(np.float32)
        p[:, np.arange(len(y)), y] -= 1
        p *= (there / max(there.sum(), 1))[:, :, None]
        d_head = np.einsum("tbh,tbk->hk", both, p)
        d_both = p @ self.head.T
        tables, loops, k = [], [], HIDDEN
        for way in (0, 1):
            d_table, d_loop = np.zeros_like(self.table[way]), np.zeros_like(self.loop[way])
            carried = np.zeros((len(y), k), np.float32)
            for t, h, z, r, new, fed, mask in reversed(traces[way]):
                d = (carried + d_both[t][:, way * k : (way + 1) * k]) * mask
                d_new = d * (1 - z) * (1 - new * new)
                d_r = d_new * fed * r * (1 - r)
                d_z = d * (h - new) * z * (1 - z)
                np.add.at(d_table, x[:, t], np.concatenate([d_z, d_r, d_new], 1))
                d_fed = np.concatenate([d_z, d_r, d_new * r], 1)
                d_loop += h.T @ d_fed
                carried = d * z + d_fed @ self.loop[way].T
            tables.append(d_table)
            loops.append(d_loop)
        return [*tables, *loops, d_head, p.sum((0, 1))]


def windows(raw: bytes, size: int) -> np.ndarray:
    """All bytes in rows of ``size``, the last one padded."""
    rows = -(-len(raw) // size)
    out = np.full(rows * size, PAD, np.int16)
    out[: len(raw)] = np.frombuffer(raw, np.uint8)
    return out.reshape(rows, size)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row (lang, key, number, part) for each TRAIN_BYTES of each text."""
    for batch in batches:
        for lang, key, text in zip(*(batch.column(k) for k in ("lang", "key", "text"))):
            raw = text.as_py().encode("utf-8", "replace")
            for first in range(0, max(1, len(raw)), TRAIN_BYTES * 4096):
                block = raw[first : first + TRAIN_BYTES * 4096]
                parts = [block[k : k + TRAIN_BYTES] for k in range(0, max(1, len(block)), TRAIN_BYTES)]
                yield pa.record_batch({
                    "lang": pa.array([lang.as_py()] * len(parts), pa.string()),
                    "key": pa.array([key.as_py()] * len(parts), pa.int64()),
                    "number": pa.array(range(first, first + len(parts)), pa.int64()),
                    "part": pa.array(parts, pa.binary()),
                })


def steps_for(langs: int) -> int:
    return STEPS * -(-langs // LANGS_A_FIT)


def windows_per_lang(langs: int) -> int:
    """Bound on the windows of a language: twice what the steps draw of it on average."""
    return 2 * steps_for(langs) * BATCH // max(1, langs)


def training_windows(known: DataFrame, counts: dict[str, int]) -> DataFrame:
    """lang, part: the windows that a fit draws from; ``known`` has lang, text and id."""
    shares = [(k, min(1_000_003, 1_000_003 * PER_LANG // n + 1)) for k, n in counts.items()]
    limits = known.sparkSession.createDataFrame(shares, "lang string, share int")
    order = F.xxhash64("id", F.lit("lang"))
    cut = (
        known.join(F.broadcast(limits), "lang")
        .where(F.pmod(order, F.lit(1_000_003)) < F.col("share"))
        .select("lang", F.xxhash64("id", F.lit("lang"), "text").alias("key"), "text")
        .mapInArrow(_cut, "lang string, key long, number long, part binary")
        .select("lang", F.xxhash64("key", "number").alias("place"), "part")
    )
    by_hash = Window.partitionBy("lang").orderBy("place", "part")
    ranked = cut.withColumn("rank", F.row_number().over(by_hash))
    return ranked.where(F.col("rank") <= windows_per_lang(len(counts))).select("lang", "rank", "part")


def train(x: np.ndarray, y: np.ndarray, n_langs: int) -> Network:
    """A network from windows and the numbers of their languages.

    A batch draws languages evenly, and then windows of each, so that a language with little
    text counts as much as any other.
    """
    rng, network = np.random.default_rng(11), Network(n_langs)
    if not len(y):
        return network
    by_lang = np.argsort(y, kind="stable")
    _, first_of, size = np.unique(y[by_lang], return_index=True, return_counts=True)
    params = network.params()
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, steps_for(n_langs) + 1):
        which = rng.integers(0, len(size), BATCH)
        rows = by_lang[first_of[which] + rng.integers(0, size[which])]
        for p, g, m, v in zip(params, network.gradients(x[rows], y[rows]), first, second):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return network


def fitted(docs: DataFrame, doc_id: str, text: str, lang: str) -> tuple[list[str], Network | None]:
    """The languages and the network, from rows that aren't held out."""
    known = docs.where(
        ~held_out(doc_id) & col(lang).isNotNull() & col(text).rlike(r"\p{L}")
    ).select(col(lang).alias("lang"), col(text).alias("text"), col(doc_id).alias("id"))
    counts = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").collect()
    if not counts:
        return [], None
    names = [r["lang"] for r in counts]
    number = {x: k for k, x in enumerate(names)}
    table = training_windows(known, {r["lang"]: r["count"] for r in counts}).orderBy("lang", "rank").toArrow()
    parts = [windows(p or b"", TRAIN_BYTES)[:1] for p in table["part"].to_pylist()]
    parts = [p if len(p) else np.full((1, TRAIN_BYTES), PAD, np.int16) for p in parts]
    owners = np.array([number[x] for x in table["lang"].to_pylist()], int)
    return names, train(np.concatenate(parts), owners, len(names))


def _pooled(network: Network, texts: list[str | None]) -> np.ndarray:
    """The mean over all bytes of each text of the labels' probabilities."""
    raw = [(t or "").encode("utf-8", "replace") for t in texts]
    total = np.zeros((len(texts), len(network.base)))
    held: list[np.ndarray] = []
    owner: list[np.ndarray] = []
    size = 0

    def flush() -> None:
        nonlocal held, owner, size
        x, who = np.concatenate(held), np.concatenate(owner)
        portion = max(1, PORTION_WINDOWS * LANGS_A_FIT // max(LANGS_A_FIT, len(network.base)))
        for at in range(0, len(x), portion):
            part = x[at : at + portion]
            p = (network.labels(part) * (part.T != PAD)[:, :, None]).sum(0)
            np.add.at(total, who[at : at + portion], p)
        held, owner, size = [], [], 0

    for k, text in enumerate(raw):
        rows = windows(text, WINDOW)
        held.append(rows)
        owner.append(np.full(len(rows), k))
        size += len(rows)
        if size >= PORTION_WINDOWS:
            flush()
    if size:
        flush()
    return total / np.maximum(1, np.array([len(x) for x in raw]))[:, None]


def predicted(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score for each row."""
    names, network = fitted(docs, doc_id, text, lang)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            some = [bool(t and _LETTER.search(t)) and network is not None for t in texts]
            pred, score = ["und"] * len(texts), [0.0] * len(texts)
            if any(some):
                p = _pooled(network, [t if s else None for t, s in zip(texts, some)])
                for k in np.flatnonzero(some).tolist():
                    best = int(p[k].argmax())
                    pred[k], score[k] = names[best], min(1.0, float(p[k, best]))
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"),
                "lang_pred": pa.array(pred, pa.string()), "score": pa.array(score, pa.float64()),
            })

    plain = docs.select(col(doc_id).alias("doc_id"), held_out(doc_id).alias("held_out"), col(text).alias("text"))
    kind = plain.schema["doc_id"].dataType.simpleString()
    return plain.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
