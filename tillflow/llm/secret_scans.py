"""Secrets in texts: assignments, access keys and hex strings, and strings that look random.

Everything is made of DataFrame functions.  The three base kinds are patterns.  Other
secrets are told by two Markov models of the first order over the 68 characters of ``RUN``:
one of random strings and one of ordinary identifiers, both fitted on labelled samples.  In
runs of ``LEAST_RUN`` characters or more that hold no base match, the log-likelihood ratio of
the two is summed along the run; a stretch whose sum climbs to ``ENOUGH`` is a span of kind
``random`` and ends where the sum was highest.  A sum that falls to zero, or by ENOUGH below
its highest, starts anew, so a random part of a path or an address is found by itself.

The samples of the query are labelled by the base patterns: values that they match are
random strings, other runs of the same texts are ordinary (each distinct string counts
once).  They come from about ``FIT_DOCS`` documents, chosen by a hash of id and text; with
fewer documents from all.  The fit brings counts of character pairs to the driver, at most
68 * 69 for each model.  Ratios are whole hundredths, so sums don't depend on their order.

Positions are code points from 0, ends exclusive.  They come from the lengths of the pieces
between matches; sums run in blocks, so that a text with a million matches is no quadratic
work.

Defined results: a null text is empty.  Repeated rows give repeated results, an empty table
an empty one.  Without labelled samples no string looks random.  A run that holds a base
match, or that an assignment's key and value cover, isn't judged again.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.llm.common import col, fresh, text_of

#: Fixed values of the contract: the base kinds.
KEY = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
RUN = "[A-Za-z0-9+/_.=-]"
ASSIGN, ACCESS, HEX = f"{KEY}{RUN}+", "AKIA[A-Z0-9]{16,}", "[0-9a-f]{24,}"
ASSIGN_LEAST = 6
KINDS = ("assign", "access", "hex", "random")

#: What is judged by the models, or taken by an assignment and so not judged.
LEAST_RUN = 16
JUDGED = f"(?<!{RUN})(?:{RUN}*{KEY}{RUN}+|{RUN}{{{LEAST_RUN},}})"
BASE = f"{KEY}{RUN}{{{ASSIGN_LEAST},}}|{ACCESS}|{HEX}"
#: Log-likelihood ratio of a span, in hundredths.
ENOUGH = 2000
#: Bound on the documents that samples are taken from.
FIT_DOCS = 8_000
LEAST_SAMPLE = 4

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
#: Characters that join words and say nothing, as texts of prose hold few joined words.
JOINTS = "+/_.=-"
#: Share of the uniform distribution in the model of random strings, and that of single
#: characters' frequencies in that of ordinary identifiers.
UNIFORM, SINGLE = 0.5, 0.2

_BLOCK = 1024


# -- positions ------------------------------------------------------------------------


def _zero() -> Column:
    return F.lit(0).cast("long")


def _gapped(text: str, found: str, pattern: str) -> Column:
    """Each of the matches ``found`` of ``pattern`` with the length of the piece before it."""
    gaps = F.transform(F.split(col(text), pattern), lambda x: F.char_length(x).cast("long"))
    return F.arrays_zip(F.slice(gaps, 1, F.size(col(found))).alias("gap"), col(found).alias("match"))


def _located(items: str) -> Column:
    """start, end, match of each of the matches of a column that :func:`_gapped` made."""
    kind = "array<struct<start:long,end:long,match:string>>"
    n = F.size(col(items))
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((n - 1) / _BLOCK).cast("int")),
        lambda b: F.slice(col(items), b * _BLOCK + 1, F.least(F.lit(_BLOCK), n - b * _BLOCK)),
    )

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + x["gap"]
        end = start + F.char_length(x["match"])
        own = F.struct(start.alias("start"), end.alias("end"), x["match"].alias("match"))
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(own)).alias("out"))

    def block(state: Column, part: Column) -> Column:
        empty = F.struct(state["at"].alias("at"), F.array().cast(kind).alias("out"))
        inner = F.array(F.aggregate(part, empty, step))
        return F.transform(inner, lambda x: F.struct(
            x["at"].alias("at"), F.concat(state["out"], F.array(x["out"])).alias("out")
        ))[0]

    first = F.struct(_zero().alias("at"), F.array().cast(f"array<{kind}>").alias("out"))
    all_of_them = F.aggregate(blocks, first, block, lambda s: F.flatten(s["out"]))
    return F.when(n == 0, F.array().cast(kind)).otherwise(all_of_them)


def _value(match: Column) -> Column:
    """The value of an assignment."""
    return F.regexp_extract(match, f"^{KEY}({RUN}+)$", 1)


def _spans(matches: Column, kind: int) -> Column:
    return F.transform(matches, lambda m: F.struct(
        m["start"].alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end")
    ))


# -- models ----------------------------------------------------------------------------


@dataclass(frozen=True)
class Models:
    """Log-likelihood ratios, in hundredths, of each pair of characters (by place in ALPHABET)."""

    ratios: tuple[int, ...]

    def ratio(self, before: Column, now: Column) -> Column:
        table = F.split(F.lit(",".join(map(str, self.ratios))), ",").cast("array<int>")
        return F.element_at(table, before * len(ALPHABET) + now + 1)


def labelled(docs: DataFrame, text: str = "text") -> DataFrame:
    """run, random: strings of the texts labelled by the base patterns, each once."""
    base = F.regexp_extract_all("text", F.lit(BASE), F.lit(0))
    taken = F.transform(base, lambda m: F.struct(
        F.when(_value(m) != "", _value(m)).otherwise(m).alias("run"), F.lit(True).alias("random")
    ))
    rest = F.regexp_extract_all(
        F.regexp_replace("text", BASE, " "), F.lit(f"{RUN}{{{LEAST_SAMPLE},}}"), F.lit(0)
    )
    others = F.transform(rest, lambda m: F.struct(m.alias("run"), F.lit(False).alias("random")))
    rows = docs.select(text_of(text).alias("text")).select(F.explode(F.concat(taken, others)).alias("x"))
    return rows.select("x.run", "x.random").distinct()


def _pairs(samples: DataFrame) -> DataFrame:
    """random, a, b, n: how often character b follows a; a is empty at the start."""
    letters = F.split("run", "")
    both = F.arrays_zip(F.concat(F.array(F.lit("")), letters).alias("a"), letters.alias("b"))
    rows = samples.select("random", F.explode(F.slice(both, 1, F.size(letters))).alias("x"))
    return rows.groupBy("random", F.col("x.a").alias("a"), F.col("x.b").alias("b")).agg(F.count("*").alias("n"))


def fitted(samples: DataFrame) -> Models:
    """The models of labelled strings: ``samples`` has run (of RUN's characters) and random."""
    place = {c: k for k, c in enumerate(ALPHABET)}
    size = len(ALPHABET)
    counts = {flag: [[0] * size for _ in range(size)] for flag in (True, False)}
    single = [1] * size
    for r in _pairs(samples).collect():  # at most size * (size + 1) rows for each label
        if r.b in place:
            if not r.random:
                single[place[r.b]] += r.n
            if r.a in place:
                counts[r.random][place[r.a]][place[r.b]] += r.n
    if not any(map(sum, counts[True])) or not any(map(sum, counts[False])):
        return Models((0,) * size**2)
    every, ratios = sum(single), []
    for a in range(size):
        seen, usual = counts[True][a], counts[False][a]
        n_seen, n_usual = sum(seen), sum(usual)
        for b in range(size):
            if ALPHABET[a] in JOINTS or ALPHABET[b] in JOINTS:
                ratios.append(0)
                continue
            as_random = UNIFORM / size + (1 - UNIFORM) * (seen[b] + 1) / (n_seen + size)
            as_usual = (1 - SINGLE) * usual[b] / max(1, n_usual) + SINGLE * single[b] / every
            ratios.append(round(100 * math.log(as_random / as_usual)))
    return Models(tuple(ratios))


def fitted_on(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Models:
    """The models of strings from about FIT_DOCS of the documents."""
    n, parts = docs.count(), 1_000_003
    share = min(parts, math.ceil(parts * FIT_DOCS / max(1, n)))
    chosen = F.pmod(F.xxhash64(col(doc_id), col(text)), F.lit(parts)) < share
    return fitted(labelled(docs.where(chosen), text))


def _random_parts(match: Column, models: Models) -> Column:
    """Where the stretches of a run that look random begin and end within it."""
    kind = "array<struct<start:int,end:int>>"
    codes = F.lit(",".join(str(ALPHABET.find(chr(k))) for k in range(128)))
    code = F.split(codes, ",").cast("array<int>")
    letters = F.transform(F.split(match, ""), lambda c: F.element_at(code, F.ascii(c) + 1))

    def state(before, at, total, begin, peak, stop, out) -> Column:  # noqa: ANN001
        names = ("before", "at", "total", "begin", "peak", "stop", "out")
        values = (before, at, total, begin, peak, stop, out)
        return F.struct(*[v.alias(k) for k, v in zip(names, values)])

    def closed(s: Column) -> Column:
        span = F.struct(s["begin"].alias("start"), s["stop"].alias("end"))
        return F.when(s["peak"] >= ENOUGH, F.concat(s["out"], F.array(span))).otherwise(s["out"])

    def step(s: Column, letter: Column) -> Column:
        total = s["total"] + models.ratio(s["before"], letter)
        over = (total <= 0) | (s["peak"] - total >= ENOUGH)
        higher = total > s["peak"]
        after = s["at"] + 1
        return F.when(over, state(letter, after, F.lit(0), s["at"], F.lit(0), after, closed(s))).otherwise(
            state(letter, after, total, s["begin"], F.when(higher, total).otherwise(s["peak"]),
                  F.when(higher, after).otherwise(s["stop"]), s["out"])
        )

    zero = F.lit(0)
    first = state(letters[0], F.lit(1), zero, zero, zero, zero, F.array().cast(kind))
    return F.aggregate(F.slice(letters, 2, F.size(letters)), first, step, closed)


# -- scans -----------------------------------------------------------------------------


def found(docs: DataFrame, models: Models, text: str = "text", spans: str = "spans") -> DataFrame:
    """``docs`` with an array of spans: start, kind (place in KINDS) and end, by start, then kind."""
    body, *hits = fresh(docs, "body", "of_assign", "of_access", "of_hex", "of_runs")
    (out,) = fresh(docs, spans)
    patterns = (ASSIGN, ACCESS, HEX, JUDGED)
    wide = docs.withColumn(body, text_of(text))
    wide = wide.withColumns({h: F.regexp_extract_all(col(body), F.lit(p), F.lit(0)) for h, p in zip(hits, patterns)})
    wide = wide.withColumns({h: _gapped(body, h, p) for h, p in zip(hits, patterns)})
    wide = wide.withColumns({h: _located(h) for h in hits})
    assigned = F.filter(col(hits[0]), lambda m: F.char_length(_value(m["match"])) >= ASSIGN_LEAST)
    base = [_spans(assigned, 0), _spans(col(hits[1]), 1), _spans(col(hits[2]), 2)]
    judged = F.filter(col(hits[3]), lambda m: ~m["match"].rlike(f"{KEY}{RUN}|{BASE}"))
    random = F.flatten(F.transform(judged, lambda m: F.transform(
        _random_parts(m["match"], models),
        lambda s: F.struct((m["start"] + s["start"]).alias("start"), F.lit(3).alias("kind"), (m["start"] + s["end"]).alias("end")),
    )))
    return wide.withColumn(out, F.sort_array(F.concat(*base, random))).drop(body, *hits)


def _listed(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")
    )), ",")


def _count(kind: int) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")


def digests(docs: DataFrame, models: Models | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, counts of each kind, a digest of the base spans, and all spans as text."""
    models = models or fitted_on(docs, doc_id, text)
    plain = docs.select(col(doc_id).alias("doc_id"), col(text).alias("text"))
    all_of_them = found(plain, models).drop("text")
    base = F.filter("spans", lambda s: s["kind"] < 3)
    counts = [_count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return all_of_them.select(
        "doc_id", *counts[:3], F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"), counts[3],
    )
