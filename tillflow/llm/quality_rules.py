"""Quality rules by the divergence of a document from its language.

Each document has two histograms: the classes of its characters (upper case, digits,
white space, punctuation, symbols, all else) and the common words of its language (a bin for
each of the ``COMMON`` words with a letter that the language's documents have most often, in
lower case, and one for all other words).  The words are counted over all documents.  The reference of a
language is the mean of the histograms of all its documents that pass the base rules.  A document is rejected when the Jensen-Shannon
distance (base 2, so 0 to 1) between one of its histograms and the reference exceeds a
limit.  Short documents have noisy histograms, so a histogram is judged only from
``min_chars`` characters or ``min_words`` words on.

Everything is a DataFrame expression.  A document's figures come from its own row, without
a shuffle; the references are one small row for each language.

Defined results: a null text is empty (no words, base rules failed).  A null language is a
language of its own.  A language without a document that passes the base rules has no
reference, and nothing is rejected against it.  Repeated rows and repeated ids are judged
row by row.  An empty table gives an empty result.  Columns that are not carried play no
part, and carried ones keep their values, as the helper columns take free names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillflow.llm.common import col, fresh, stored, text_of, total, words_of

#: Common words of each language.
COMMON = 32
LETTERS = [chr(ord("0") + i) for i in range(COMMON)]
#: Most characters of a text; the classes are counted in what is left.
BULK = "[a-z ]+"
#: Runs of characters outside a class; the class is what is left without them.
OUTSIDE = {
    "upper": r"[^\p{Lu}\p{Lt}]+",
    "digit": r"\P{Nd}+",
    "stop": r"[^.,;:'\"()\-–—’“”„«»¿¡]+",
    "symbol": r"[\p{L}\p{M}\p{Nd}\s.,;:'\"()\-–—’“”„«»¿¡]+",
}
NO_SYMBOLS = "[^#*$%&|<>]+"

MIN_WORDS, MAX_REPEATED_PERCENT = 50, 50
MAX_CLASS_DISTANCE, MAX_WORD_DISTANCE = 0.25, 0.32
MIN_CHARS_JUDGED, MIN_WORDS_JUDGED = 300, 120


def _window_hash(w: Column, i: Column) -> Column:
    return F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))


def _place(packed: Column) -> Column:
    return packed.bitwiseAND(F.lit((1 << 31) - 1)).cast("int")


def _likely_repeated(packed: Column) -> Column:
    """Windows whose 32 hash bits another has; ``packed``: hash bits over position, sorted."""
    high = lambda e: F.shiftright(e, 32)
    return F.filter(
        packed,
        lambda e, k: (high(e) == high(F.get(packed, k + 1)))
        | (high(e) == high(F.get(packed, k - 1))),
    )


def _repeated_words(order: Column) -> Column:
    """Words inside windows that occur twice or more; ``order``: windows sorted by hash."""
    same = lambda e, k, at: e["h"] == F.get(order, k + at)["h"]
    starts = F.sort_array(
        F.transform(
            F.filter(order, lambda e, k: same(e, k, -1) | same(e, k, 1)), lambda e: e["i"]
        )
    )
    none = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    return F.aggregate(
        starts,
        none,
        lambda acc, i: F.struct(
            (i + 3).alias("end"),
            (acc["n"] + 3 - F.greatest(F.lit(0), acc["end"] - i)).alias("n"),
        ),
        lambda acc: acc["n"].cast("long"),
    )


def common_words(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """ref_lang, common: the most frequent words of each language, the first the most frequent.

    Words without a letter don't count.

    Counts are summed before the shuffle, and each task keeps COMMON words of a language at
    most before these meet.  Ties go to the smaller word.
    """
    words = docs.select(
        F.coalesce(col(lang), F.lit("")).alias("ref_lang"),
        F.explode(words_of(F.lower(text_of(text)))).alias("word"),
    )
    ranked = words.where(F.col("word").rlike(r"\p{L}")).groupBy("ref_lang", "word").agg(F.count("*").alias("n")).withColumn(
        "rank", F.row_number().over(Window.partitionBy("ref_lang").orderBy(F.desc("n"), "word"))
    )
    best = F.sort_array(F.collect_list(F.struct("rank", "word")))
    return (
        ranked.where(F.col("rank") <= COMMON).groupBy("ref_lang").agg(best.alias("best"))
        .select("ref_lang", F.col("best.word").alias("common"))
    )


def with_figures(
    docs: DataFrame, text: str = "text", lang: str = "lang"
) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` and the figures of each text, with the names that these columns have.

    The common words are a stored table of one row for each language: Spark sees its size and
    broadcasts it if that is small, so that texts aren't shuffled.
    """
    kinds = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
             "base_failed", "classes", "common"]
    names = dict(zip(kinds, fresh(docs, *kinds)))
    own = list(docs.columns)
    spare = docs.select("*", *[F.lit(0).alias(x) for x in names.values()])
    t, w, n, p, s, c, r, of, most = fresh(spare, "t", "w", "n", "p", "s", "c", "r", "of", "most")
    keep = [col(x) for x in own]
    left = lambda x, pattern: F.length(F.regexp_replace(x, pattern, "")).cast("long")

    listed = stored(common_words(docs, text, lang), "quality-words")
    listed = listed.select(F.col("ref_lang").alias(of), F.col("common").alias(most))
    step = docs.select(*keep, text_of(text).alias(t)).join(
        listed, F.coalesce(col(lang), F.lit("")) == F.col(of), "left"
    )
    step = step.select(
        *keep, t, most, words_of(F.col(t)).alias(w), F.regexp_replace(t, BULK, "").alias(r)
    )
    lines = F.filter(F.split(F.col(t), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    packed = F.transform(
        F.sequence(F.lit(0), F.size(w) - 3),
        lambda i: _window_hash(F.col(w), i)
        .bitwiseAND(F.lit(-1 << 32))
        .bitwiseOR(i.cast("long")),
    )
    letters = F.split(F.lit(" ".join(LETTERS)), " ")
    letter = lambda x: F.get(letters, (F.array_position(F.col(most), x) - 1).cast("int"))
    step = step.select(
        *keep,
        F.size(w).cast("long").alias(names["n_words"]),
        F.length(F.array_join(w, "")).cast("long").alias(names["word_chars"]),
        left(F.col(r), NO_SYMBOLS).alias(names["n_symbols"]),
        F.aggregate(
            F.array(lines), F.lit(0).cast("long"),
            lambda a, x: a + F.size(x) - F.size(F.array_distinct(x)),
        ).alias(names["n_dup_lines"]),
        F.array(*[left(F.col(r), x) for x in OUTSIDE.values()]).alias(names["classes"]),
        F.length(t).cast("long").alias(n),
        F.when(F.size(w) >= 3, F.sort_array(packed)).alias(p),
        F.col(w),
        F.coalesce(F.array_join(F.transform(F.col(w), lambda x: letter(F.lower(x))), ""), F.lit("")).alias(c),
    )
    likely = F.transform(
        _likely_repeated(F.col(p)),
        lambda e: F.struct(_window_hash(F.col(w), _place(e)).alias("h"), _place(e).alias("i")),
    )
    classes, spaces = F.col(names["classes"]), F.col(n) - F.col(names["word_chars"])
    common = [(F.length(c) - F.length(F.replace(F.col(c), F.lit(x), F.lit("")))).cast("long")
              for x in LETTERS]
    rest = F.col(n) - spaces - total([classes[i] for i in range(len(OUTSIDE))])
    step = step.select(
        *keep,
        *[F.col(names[x]) for x in kinds[:4]],
        F.sort_array(likely).alias(s),
        F.concat(classes, F.array(spaces, rest)).alias(names["classes"]),
        F.array(*common, F.col(names["n_words"]) - F.length(c)).alias(names["common"]),
    )
    step = step.select(
        *keep,
        *[F.col(names[x]) for x in kinds[:4]],
        F.coalesce(_repeated_words(F.col(s)), F.lit(0).cast("long"))
        .alias(names["n_repeat_words"]),
        F.col(names["classes"]),
        F.col(names["common"]),
    )
    n_words, again = F.col(names["n_words"]), F.col(names["n_repeat_words"])
    failed = (n_words < MIN_WORDS) | (100 * again > MAX_REPEATED_PERCENT * n_words)
    return step.withColumn(names["base_failed"], failed), names


def _shares(counts: Column, size: Column) -> Column:
    return F.transform(counts, lambda x: x / size)


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two arrays that sum to one each."""
    part = lambda a, m: F.when(a > 0, a * F.log2(a / m)).otherwise(0.0)
    each = F.zip_with(p, q, lambda a, b: part(a, (a + b) / 2) + part(b, (a + b) / 2))
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(each, F.lit(0.0), lambda s, x: s + x) / 2))


def references(figures: DataFrame, names: dict[str, str], lang: str) -> DataFrame:
    """The mean histograms of each language; sums are made before the shuffle."""
    sizes = {"classes": len(OUTSIDE) + 2, "common": COMMON + 1}
    good = figures.where(~F.col(names["base_failed"]))
    means = [
        F.avg(F.col(names[kind])[i] / F.aggregate(
            F.col(names[kind]), F.lit(0).cast("long"), lambda s, x: s + x)).alias(f"{kind}{i}")
        for kind, size in sizes.items() for i in range(size)
    ]
    return (
        good.groupBy(F.coalesce(col(lang), F.lit("")).alias("ref_lang"))
        .agg(*means)
        .select("ref_lang", *[
            F.array(*[F.col(f"{kind}{i}") for i in range(size)]).alias(f"ref_{kind}")
            for kind, size in sizes.items()
        ])
    )


def judged(docs: DataFrame, carry: list[str], text: str = "text", lang: str = "lang") -> DataFrame:
    """``carry`` and the verdict for each row.

    The figures are written once, as both the references and the verdict read them.
    Columns that follow ``carry``: n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, class_distance, word_distance (null: not judged).
    A carried column of such a name gives way by an underscore before the new name.
    """
    plain = docs.select(*[col(c) for c in dict.fromkeys([*carry, text, lang])])
    figures, names = with_figures(plain, text, lang)
    wanted = list(dict.fromkeys([*carry, lang]))
    figures = stored(figures.select(*[col(c) for c in wanted], *names.values()), "quality-figures")
    kept, by_class, by_word = fresh(figures, "kept", "class_distance", "word_distance")
    n_words = F.col(names["n_words"])
    n_chars = F.aggregate(F.col(names["classes"]), F.lit(0).cast("long"), lambda s, x: s + x)
    reference, key = references(figures, names, lang), fresh(figures, "lang_key")[0]
    out = (
        figures.withColumn(key, F.coalesce(col(lang), F.lit("")))
        .join(reference, F.col(key) == F.col("ref_lang"), "left")
        .withColumn(by_class, F.when(
            n_chars >= MIN_CHARS_JUDGED,
            distance(_shares(F.col(names["classes"]), n_chars), F.col("ref_classes"))))
        .withColumn(by_word, F.when(
            n_words >= MIN_WORDS_JUDGED,
            distance(_shares(F.col(names["common"]), n_words), F.col("ref_common"))))
    )
    far = F.coalesce(F.col(by_class) > MAX_CLASS_DISTANCE, F.lit(False)) | F.coalesce(
        F.col(by_word) > MAX_WORD_DISTANCE, F.lit(False)
    )
    return out.select(
        *[col(c) for c in carry],
        *[F.col(names[x]) for x in list(names)[:6]],
        (~F.col(names["base_failed"]) & ~far).alias(kept),
        F.col(by_class),
        F.col(by_word),
    )


def accepted(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of ``docs`` that pass, with the columns of ``docs``."""
    scored = judged(docs, docs.columns, text, lang)
    kept = next(c for c in scored.columns[len(docs.columns) :] if c.strip("_") == "kept")
    return scored.where(col(kept)).select(*[col(c) for c in docs.columns])
