"""Operator 9, quality rules: divergence from language references.

Base counts of a document come first (words, symbols, repeated lines, words in
repeated 3-word windows). Then two histograms of the document are held against
those of its language, each by the Jensen-Shannon distance (base 2, from 0 to 1):

* character classes of its words: lower case, upper case, digits, stops, symbols, others;
* the common words of the language, and all other words as one more class.

A language's reference is the sum of the histograms of all documents of that
language. Documents under ``MIN_WORDS`` words give no reliable histogram; for
them no distance is judged. A document whose language has no list of common
words is judged by its character classes only.

SQL functions only: one pass for the references, one for the verdicts, and a join
with the few rows of references. No document is shuffled.

NULL or empty text: no words, so ``base_failed``. NULL language: a language of its
own. Repeated rows get the same verdict; an empty table gives an empty result.
Equal 3-word windows are found by a 64-bit hash of their words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custlens.llm.common import WHITE_SPACE, fresh, let, stage, words

MIN_BASE_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIN_WORDS = 100
MAX_CLASS_DISTANCE = 0.25
MAX_WORD_DISTANCE = 0.26

# Frequent function words by language.
COMMON_WORDS = {
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "ist", "im", "ein"],
    "en": ["the", "and", "of", "to", "in", "is", "that", "for", "it", "on", "as", "with"],
    "es": ["de", "la", "que", "el", "en", "y", "los", "del", "se", "las", "por", "un"],
    "fr": ["de", "la", "le", "les", "et", "des", "en", "un", "du", "une", "que", "est"],
}
# Character classes besides a-z, which comes first, and all others, which come last.
CHARACTER_CLASSES = ["[A-Z]+", "[0-9]+", "[.,;:!?'\"()-]+", r"[#*$%&|<>@=+~^_/\\\[\]{}]+"]
SYMBOLS = "#*$%&|<>"
MAX_HITS = 1 + max(map(len, COMMON_WORDS.values()))
ALL = 1 << 30  # more than any array holds; slice() adds to it


def _total(counts: Column) -> Column:
    return F.aggregate(counts, F.lit(0).cast("long"), lambda x, y: x + y)


def _of_words(found: Column) -> Column:
    """Struct from the words: word_chars, n_symbols, character histogram."""

    def of(whole: Column) -> Column:
        def rest(r: Column) -> Column:
            n = F.length(r)
            counts = F.array(*[(n - F.length(F.regexp_replace(r, p, ""))).cast("long") for p in CHARACTER_CLASSES])
            return let(
                counts,
                lambda c: F.struct(
                    F.length(whole).cast("long").alias("word_chars"),
                    (n - F.length(F.translate(r, SYMBOLS, ""))).cast("long").alias("n_symbols"),
                    F.concat(
                        F.array((F.length(whole) - n).cast("long")), c, F.array((n - _total(c)).cast("long"))
                    ).alias("chars"),
                ),
            )

        return let(F.regexp_replace(whole, "[a-z]+", ""), rest)

    return let(F.array_join(found, ""), of)


def word_histogram(found: Column, lang: Column) -> Column:
    """array<bigint>: counts of the language's common words, other words last."""
    lists = F.array().cast("array<string>")
    for code, common in sorted(COMMON_WORDS.items()):
        lists = F.when(lang == code, F.array(*map(F.lit, common))).otherwise(lists)
    known = sorted({w for common in COMMON_WORDS.values() for w in common})

    def counted(hits: Column) -> Column:
        return F.transform(lists, lambda w: (F.size(hits) - F.size(F.array_remove(hits, w))).cast("long"))

    return let(
        let(F.filter(found, lambda w: w.isin(known)), counted),
        lambda a: F.concat(a, F.array(F.size(found).cast("long") - _total(a))),
    )


def repeated_words(found: Column) -> Column:
    """Number of words in 3-word windows that occur twice or more in ``found``."""

    def windows(w: Column) -> Column:
        hashed = let(
            F.transform(w, lambda x: F.xxhash64(x)),
            lambda h: F.transform(h, lambda x, i: F.xxhash64(x, F.get(h, i + 1), F.get(h, i + 2))),
        )
        return F.when(F.size(w) < 3, F.array().cast("array<bigint>")).otherwise(
            F.slice(hashed, F.lit(1), F.size(w) - 2)
        )

    def twice(s: Column) -> Column:
        equal = F.zip_with(s, F.slice(s, 2, ALL), lambda a, b: F.when(a == b, a))
        return F.array_distinct(F.array_compact(equal))

    def starts(h: Column, t: Column) -> Column:
        return F.array_compact(F.transform(h, lambda x, i: F.when(F.array_contains(t, x), i)))

    def covered(p: Column) -> Column:
        steps = F.transform(p, lambda x, i: F.when(i == 0, 3).otherwise(F.least(F.lit(3), x - F.get(p, i - 1))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda x, y: x + y)

    return let(
        let(found, windows),
        lambda h: let(
            let(F.sort_array(h), twice),
            lambda t: F.when(F.size(t) == 0, F.lit(0).cast("long")).otherwise(let(starts(h, t), covered)),
        ),
    )


def duplicate_lines(text: Column) -> Column:
    """Number of lines with a word that equal an earlier line."""
    lines = F.filter(
        F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.btrim(x, F.lit(WHITE_SPACE)) != ""
    )
    return let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def histograms(text: Column, lang: Column) -> Column:
    """Struct (chars, hits): what the references are summed from."""
    return let(
        words(text),
        lambda w: F.struct(_of_words(w)["chars"].alias("chars"), word_histogram(w, lang).alias("hits")),
    )


def measures(text: Column, lang: Column) -> Column:
    """Struct of all counts and histograms of a text."""

    def of(w: Column) -> Column:
        return let(
            _of_words(w),
            lambda c: F.struct(
                F.size(w).cast("long").alias("n_words"),
                c["word_chars"].alias("word_chars"),
                c["n_symbols"].alias("n_symbols"),
                duplicate_lines(text).alias("n_dup_lines"),
                repeated_words(w).alias("n_repeat_words"),
                c["chars"].alias("chars"),
                word_histogram(w, lang).alias("hits"),
            ),
        )

    return let(words(text), of)


def references(measured: DataFrame) -> DataFrame:
    """(ref_lang, ref_chars, ref_hits) from rows (lang, chars, hits): their sums by language."""
    n_chars = len(CHARACTER_CLASSES) + 2
    sums = [F.sum(F.get("chars", F.lit(i))).alias(f"c{i}") for i in range(n_chars)]
    sums += [F.sum(F.get("hits", F.lit(i))).alias(f"h{i}") for i in range(MAX_HITS)]
    return stage(
        measured.groupBy(F.col("lang").alias("ref_lang"))
        .agg(*sums)
        .select(
            "ref_lang",
            F.array(*[f"c{i}" for i in range(n_chars)]).alias("ref_chars"),
            F.array_compact(F.array(*[f"h{i}" for i in range(MAX_HITS)])).alias("ref_hits"),
        ),
        "quality-references",
    )


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two histograms of counts; 0 if one is empty."""

    def term(a: Column, b: Column) -> Column:
        def part(x: Column) -> Column:
            return F.when(x > 0, x * F.log2(x * 2 / (a + b))).otherwise(0.0)

        return (part(a) + part(b)) / 2

    def of(n: Column, m: Column) -> Column:
        terms = F.zip_with(F.transform(p, lambda x: x / n), F.transform(q, lambda x: x / m), term)
        return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda x, y: x + y)))

    return let(
        _total(p),
        lambda n: let(_total(q), lambda m: F.when((n > 0) & (m > 0), of(n, m)).otherwise(0.0)),
    )


def verdict(m: Column, ref_chars: Column, ref_hits: Column, settings: dict) -> Column:
    """Struct of the counts in ``m``, both distances, base_failed and kept."""
    limits = {
        "min_words": MIN_WORDS, "max_class_distance": MAX_CLASS_DISTANCE, "max_word_distance": MAX_WORD_DISTANCE
    } | settings
    failed = (m["n_words"] < MIN_BASE_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"])
    distances = F.struct(js_distance(m["chars"], ref_chars).alias("c"), js_distance(m["hits"], ref_hits).alias("h"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return let(
        distances,
        lambda d: F.struct(
            *[m[c].alias(c) for c in counts],
            failed.alias("base_failed"),
            d["c"].alias("class_distance"),
            d["h"].alias("word_distance"),
            (
                ~failed
                & (
                    (m["n_words"] < limits["min_words"])
                    | ((d["c"] <= limits["max_class_distance"]) & (d["h"] <= limits["max_word_distance"]))
                )
            ).alias("kept"),
        ),
    )


def _lang(lang_col: str) -> Column:
    return F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit(""))


def report(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **settings
) -> DataFrame:
    """(doc_id, counts, distances, base_failed, kept); each text is read once."""
    measured = stage(
        docs.select(
            F.col(f"`{id_col}`").alias("doc_id"),
            _lang(lang_col).alias("lang"),
            measures(F.col(f"`{text_col}`").cast("string"), _lang(lang_col)).alias("m"),
        ),
        "quality-measures",
    )
    refs = references(measured.select("lang", "m.chars", "m.hits"))
    return measured.join(refs, F.col("lang") == F.col("ref_lang"), "left").select(
        "doc_id", verdict(F.col("m"), F.col("ref_chars"), F.col("ref_hits"), settings).alias("v")
    ).select("doc_id", "v.*")


def kept(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", **settings) -> DataFrame:
    """The rows of ``docs`` that pass, with the columns of ``docs``.

    One pass for the references and one for the verdicts, so that no text is
    shuffled or written in between.
    """
    text = F.col(f"`{text_col}`").cast("string")
    refs = references(
        docs.select(_lang(lang_col).alias("lang"), histograms(text, _lang(lang_col)).alias("h")).select("lang", "h.*")
    )
    names = [fresh(docs, c) for c in refs.columns]
    judged = let(
        measures(text, _lang(lang_col)), lambda m: verdict(m, F.col(names[1]), F.col(names[2]), settings)["kept"]
    )
    return docs.join(refs.toDF(*names), _lang(lang_col) == F.col(names[0]), "left").where(judged).select(
        [F.col(f"`{c}`") for c in docs.columns]
    )
