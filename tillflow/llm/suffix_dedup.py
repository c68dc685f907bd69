"""Repeated byte strings of ``LENGTH`` or more, found by hash-compared suffixes.

A byte is removed when a string of LENGTH bytes that covers it also starts anywhere else.

Suffixes that can be equal are brought together by anchors: of the short grams in a window
of LENGTH bytes, the one with the least hash (the leftmost of equals) is its anchor, so
equal windows have equal anchors at equal places.  Consecutive windows with one anchor are a
run.  Runs with the same bytes are counted by a digest of 128 bits, a sum made before the
shuffle: a run that occurs twice or more is removed whole, however many copies it has.  Of
the rest only runs whose anchor gram other runs have, too, can hold repeated windows: the
edges of copied passages.  Their bytes are fetched and the runs of a gram compared.

Comparison is by prefix polynomial hashes (modulo 2**64, verified byte by byte): windows
are lined up at the anchor, and a binary search over their starts finds how far runs agree.
An interval of starts is common to runs with the same hull (the bytes from its first start
to the end of its last window) and is split in half for runs that share only its core (the
bytes that all its windows share); a run alone with its core has nothing repeated there.

A gram with over ``HOT`` different runs is never gathered.  Its windows are counted by
digests of 128 bits instead, in sums made before the shuffle; same results.

Texts are stored and shuffled (once for the runs' bytes, once for the result) as packed by
zstd, which takes about a quarter less than Spark's own compression of columns and blocks.

Defined results: a null text is empty.  Repeated rows and copies are removed on all sides,
as strings are judged on the input.  Texts shorter than LENGTH lose nothing.  An empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.llm.common import col, stored, text_of
from tillflow.session import discard

LENGTH = 400
GRAM = 32
HOT = 4000
_PLACE = 24
_LIMIT = 1 << _PLACE
_BASE = 0x9E3779B97F4A7C15
_POWERS: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of the base and of its inverse, modulo 2**64."""
    if len(_POWERS.get("up", ())) <= n:
        size = max(n + 1, 1 << 17)
        for name, x in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            row = np.full(size, x, np.uint64)
            row[0] = 1
            _POWERS[name] = np.cumprod(row, dtype=np.uint64)
    return _POWERS["up"], _POWERS["down"]


def _prefix(codes: np.ndarray) -> np.ndarray:
    """Prefix hashes along the last axis."""
    n = codes.shape[-1]
    up, _ = _power(n)
    out = np.zeros((*codes.shape[:-1], n + 1), np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * up[:n], axis=-1, dtype=np.uint64, out=out[..., 1:])
    return out


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ x >> np.uint64(31)
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ x >> np.uint64(29)


def _anchored(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First start, number of starts, anchor and gram hash of each run of a text.

    A text beyond 16 MB is taken in parts that share the starts they need.
    """
    parts, step = [], _LIMIT - LENGTH
    for begin in range(0, max(len(raw) - LENGTH + 1, 0), step):
        codes = np.frombuffer(raw, np.uint8, min(step + LENGTH - 1, len(raw) - begin), begin)
        h = _prefix(codes)
        _, down = _power(len(codes))
        gram = _mixed((h[GRAM:] - h[:-GRAM]) * down[: len(h) - GRAM])
        place = np.arange(len(gram), dtype=np.uint64)
        key = gram >> np.uint64(_PLACE) << np.uint64(_PLACE) | place
        width = LENGTH - GRAM + 1
        rows = np.concatenate([key, np.full(-len(key) % width, np.iinfo(np.uint64).max, np.uint64)])
        rows = rows.reshape(-1, width)
        before = np.minimum.accumulate(rows, 1).ravel()
        after = np.minimum.accumulate(rows[:, ::-1], 1)[:, ::-1].ravel()
        n = len(codes) - LENGTH + 1
        least = np.minimum(after[:n], before[width - 1 : width - 1 + n])
        anchor = (least & np.uint64(_LIMIT - 1)).astype(np.int64)
        first = np.concatenate([[0], np.flatnonzero(anchor[1:] != anchor[:-1]) + 1])
        count = np.diff(np.concatenate([first, [n]]))
        parts.append((first + begin, count, anchor[first] + begin, gram[anchor[first]].view(np.int64)))
    if not parts:
        return (np.zeros(0, np.int64),) * 4
    return tuple(np.concatenate(x) for x in zip(*parts))  # type: ignore[return-value]


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The column ``text`` as n_bytes and packed, its UTF-8 bytes by zstd; others stay."""
    codec = pa.Codec("zstd", compression_level=1)
    for batch in batches:
        sizes, packed = [], []
        for text in batch.column("text"):
            raw = text.as_py().encode("utf-8", "replace")
            sizes.append(len(raw))
            packed.append(codec.compress(raw, asbytes=True))
        rest = {x: batch.column(x) for x in batch.schema.names if x != "text"}
        yield pa.record_batch(
            rest | {"n_bytes": pa.array(sizes, pa.int64()), "packed": pa.array(packed, pa.binary())}
        )


def _unpacked(batch: pa.RecordBatch) -> Iterator[bytes]:
    codec = pa.Codec("zstd")
    for n, packed in zip(batch.column("n_bytes").to_pylist(), batch.column("packed")):
        yield codec.decompress(packed.as_buffer(), n, asbytes=True) if n else b""


_RUN = "row_no long, first long, starts int, place int, gram long, d1 long, d2 long"


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns: list[list[np.ndarray]] = [[] for _ in range(6)]
        for row_no, raw in zip(batch.column("row_no").to_pylist(), _unpacked(batch)):
            first, starts, anchor, gram = _anchored(raw)
            if not len(first):
                continue
            digests = b"".join(
                hashlib.blake2b(raw[a : a + n - 1 + LENGTH], digest_size=16).digest()
                for a, n in zip(first.tolist(), starts.tolist())
            )
            found = (np.full(len(first), row_no), first, starts, anchor - first, gram,
                     np.frombuffer(digests, np.int64).reshape(-1, 2))
            for x, y in zip(columns, found):
                x.append(y)
        if columns[0]:
            row_no, first, starts, place, gram, digest = map(np.concatenate, columns)
            yield pa.record_batch({
                "row_no": row_no, "first": first, "starts": starts.astype(np.int32),
                "place": place.astype(np.int32), "gram": gram,
                "d1": digest[:, 0].copy(), "d2": digest[:, 1].copy(),
            })


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of each wanted run of a text."""
    for batch in batches:
        for raw, wanted in zip(_unpacked(batch), batch.column("wanted").to_pylist()):
            for w in wanted:
                w["bytes"] = raw[w["first"] : w["first"] + w["starts"] - 1 + LENGTH]
            yield pa.RecordBatch.from_pylist(wanted, schema=_PIECE_ARROW)


_PIECE = "row_no long, first long, starts int, place int, gram long, single boolean, members long, bytes binary"
_PIECE_ARROW = pa.schema([
    ("row_no", pa.int64()), ("first", pa.int64()), ("starts", pa.int32()), ("place", pa.int32()),
    ("gram", pa.int64()), ("single", pa.bool_()), ("members", pa.int64()), ("bytes", pa.binary()),
])


def _classes(h: np.ndarray, codes: np.ndarray, who: np.ndarray, a: int, b: int) -> list[np.ndarray]:
    """Members with the same bytes in columns a..b-1, by hash and then verified; none alone."""
    value = h[who, b] - h[who, a]
    parts = [who]
    if (value != value[0]).any():
        order = np.argsort(value, kind="stable")
        cuts = [0, *(np.flatnonzero(np.diff(value[order])) + 1).tolist(), len(who)]
        parts = [who[order[i:j]] for i, j in zip(cuts, cuts[1:]) if j > i + 1]
    out = []
    for part in parts:
        same = (codes[part, a:b] == codes[part[0], a:b]).all(1)
        while not same.all():  # a collision
            out.append(part[same])
            part = part[~same]
            same = (codes[part, a:b] == codes[part[0], a:b]).all(1)
        out.append(part)
    return out


def repeated_starts(
    pieces: list[bytes], places: np.ndarray, starts: np.ndarray, asked: np.ndarray | None = None
) -> np.ndarray:
    """Which window starts (columns lined up at the anchor) of each piece another piece has.

    Complete for the pieces asked for (default: all).
    """
    asked = np.ones(len(pieces), bool) if asked is None else asked
    width = LENGTH - GRAM
    low = width - places
    high = low + starts - 1
    codes = np.zeros((len(pieces), 2 * LENGTH), np.uint8)
    for k, x in enumerate(pieces):
        codes[k, low[k] : low[k] + len(x)] = np.frombuffer(x, np.uint8)
    h = _prefix(codes)
    column = np.arange(width + 1)
    outside = (column < low[:, None]) | (column > high[:, None])
    done = outside.copy()
    todo = [(np.arange(len(pieces)), 0, width)]
    while todo:
        who, a, b = todo.pop()
        who = who[(low[who] <= b) & (high[who] >= a)]
        if len(who) < 2 or done[who[asked[who]], a : b + 1].all():
            continue
        for part in _classes(h, codes, who, b, a + LENGTH) if a < b else [who]:
            if len(part) < 2:
                continue
            whole = part[(low[part] <= a) & (high[part] >= b)]
            for equal in _classes(h, codes, whole, a, b + LENGTH) if len(whole) > 1 else []:
                if len(equal) > 1:
                    done[equal, a : b + 1] = True
            if a < b and not done[part[asked[part]], a : b + 1].all():
                half = (a + b) // 2
                todo += [(part, a, half), (part, half + 1, b)]
    return done & ~outside


_SPAN = "row_no long, start long, stop long"
_SPAN_ARROW = pa.schema([("row_no", pa.int64()), ("start", pa.int64()), ("stop", pa.int64())])


def _compare(table: pa.Table) -> pa.Table:
    """The repeated spans of the single runs of one gram."""
    places, starts = (table[x].to_numpy().astype(np.int64) for x in ("place", "starts"))
    asked = np.array(table["single"].to_pylist(), bool)
    marked = repeated_starts(table["bytes"].to_pylist(), places, starts, asked)
    out: list[dict] = []
    for k, (row_no, first, single) in enumerate(
        zip(*(table[x].to_pylist() for x in ("row_no", "first", "single")))
    ):
        edge = np.diff(np.concatenate([[False], marked[k], [False]]).astype(np.int8))
        shift = first - (LENGTH - GRAM - places[k])
        for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)) if single else ():
            out.append({"row_no": row_no, "start": int(a + shift), "stop": int(b + shift) - 1 + LENGTH})
    return pa.Table.from_pylist(out, schema=_SPAN_ARROW)


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row (row_no, start, digest) for each window of a run."""
    for batch in batches:
        for r in batch.to_pylist():
            raw = b"".join(
                hashlib.blake2b(r["bytes"][k : k + LENGTH], digest_size=16).digest()
                for k in range(r["starts"])
            )
            digest = np.frombuffer(raw, np.int64).reshape(-1, 2)
            yield pa.record_batch({
                "row_no": np.full(len(digest), r["row_no"]),
                "start": np.arange(len(digest)) + r["first"],
                "single": pa.array([r["single"]] * len(digest), pa.bool_()),
                "d1": digest[:, 0].copy(), "d2": digest[:, 1].copy(),
            })


def spans(rows: DataFrame) -> DataFrame:
    """row_no, start, stop of repeated strings in ``rows`` (row_no, text); they may overlap."""
    packed = rows.select(F.col("row_no").cast("long"), "text").mapInArrow(_pack, "row_no long, n_bytes long, packed binary")
    return _spans(packed, [])


def _spans(rows: DataFrame, steps: list[str]) -> DataFrame:
    """``spans`` of rows (row_no, n_bytes, packed); ``steps`` gets the folders that it reads."""
    text = rows.select("row_no", "n_bytes", "packed")
    runs = stored(text.mapInArrow(_runs, _RUN), "suffix-runs", steps)
    key = ["gram", "d1", "d2"]
    kinds = stored(
        runs.groupBy(*key).agg(
            F.count("*").alias("n"), F.min(F.struct("row_no", "first", "starts", "place")).alias("one")
        ),
        "suffix-kinds", steps,
    )
    whole = runs.join(kinds.where("n > 1").select("d1", "d2"), ["d1", "d2"], "left_semi").select(
        "row_no", F.col("first").alias("start"), (F.col("first") + F.col("starts") - 1 + LENGTH).alias("stop")
    )
    shared = (
        kinds.groupBy("gram").agg(F.count("*").alias("members"), F.min("n").alias("least"))
        .where("members > 1 AND least = 1").drop("least")
    )
    wanted = (
        kinds.join(shared, "gram")
        .select("one.*", "gram", (F.col("n") == 1).alias("single"), "members")
        .groupBy("row_no")
        .agg(F.collect_list(F.struct("row_no", "first", "starts", "place", "gram", "single", "members")).alias("wanted"))
    )
    pieces = stored(
        text.join(wanted, "row_no").select("n_bytes", "packed", "wanted").mapInArrow(_cut, _PIECE),
        "suffix-pieces", steps,
    )
    near = pieces.where(F.col("members") <= HOT).groupBy("gram").applyInArrow(_compare, _SPAN)
    windows = stored(
        pieces.where(F.col("members") > HOT)
        .mapInArrow(_windows, "row_no long, start long, single boolean, d1 long, d2 long"),
        "suffix-windows", steps,
    )
    twice = windows.groupBy("d1", "d2").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    hot = windows.where("single").join(twice, ["d1", "d2"], "left_semi")
    hot = hot.select("row_no", "start", (F.col("start") + LENGTH).alias("stop"))
    return whole.union(near).union(hot)


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, removed, pieces, digests = [], [], [], []
        for raw, found in zip(_unpacked(batch), batch.column("spans").to_pylist()):
            kept, at, gone, n = hashlib.sha256(), 0, 0, 0
            for s in sorted(found or [], key=lambda s: s["start"]):
                if s["stop"] <= at and n:
                    continue
                if s["start"] > at or not n:
                    kept.update(raw[at : s["start"]])
                    n += 1
                    at = s["start"]
                gone += s["stop"] - at
                at = s["stop"]
            kept.update(raw[at:])
            for x, y in zip((sizes, removed, pieces, digests), (len(raw), gone, n, kept.hexdigest())):
                x.append(y)
        yield pa.record_batch({
            "doc_id": batch.column("doc_id"), "n_bytes": pa.array(sizes, pa.int64()),
            "n_removed": pa.array(removed, pa.int64()), "n_spans": pa.array(pieces, pa.int64()),
            "kept_sha256": pa.array(digests, pa.string()),
        })


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, has_repeat for each row.

    Rows are numbered and written once, as later scans must meet the same numbers whatever
    cores come and go.  The steps to the spans are deleted as soon as the spans are written.
    """
    numbered = docs.select(
        F.monotonically_increasing_id().alias("row_no"),
        col(doc_id).alias("doc_id"),
        text_of(text).alias("text"),
    )
    kind = numbered.schema["doc_id"].dataType.simpleString()
    rows = stored(
        numbered.mapInArrow(_pack, f"row_no long, doc_id {kind}, n_bytes long, packed binary"), "suffix-rows"
    )
    steps: list[str] = []
    found = stored(_spans(rows, steps), "suffix-spans")
    for path in steps:  # nothing reads them any more
        discard(docs.sparkSession, path)
    by_row = found.groupBy("row_no").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
    return (
        rows.join(by_row, "row_no", "left").select("doc_id", "n_bytes", "packed", "spans")
        .mapInArrow(_kept, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
        .withColumn("has_repeat", F.col("n_removed") > 0)
    )
