"""Column functions on source texts and on generated texts."""

from __future__ import annotations

import functools
import random

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import BOLD_TITLE, INTRODUCTIONS, MATH_WORDS, OPENERS, REFUSALS, TOKEN

STOPWORDS = {
    "el": ("και", "το", "η", "να", "του", "της", "με", "που", "για", "είναι"),
    "en": ("the", "of", "and", "to", "in", "that", "is", "for", "it", "with"),
    "de": ("der", "die", "und", "das", "ist", "den", "von", "mit", "sich", "auf"),
    "es": ("el", "los", "que", "y", "por", "una", "con", "para", "las", "del"),
    "fr": ("le", "les", "et", "des", "est", "pour", "dans", "que", "une", "sur"),
}
LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"
PREAMBLE = rf"(?iUd)\A(?:(?>{OPENERS})|(?>{INTRODUCTIONS})|(?>{BOLD_TITLE})|[\s\x1c-\x1f]++)*+"


def count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def characters(text: Column, kind: str) -> Column:
    """How many characters are of ``kind`` (one regex atom): those that go when its runs are removed."""
    return F.length(text) - F.length(F.regexp_replace(text, f"{kind}+", ""))


def verdict(text: Column, script: str = "Greek") -> Column:
    """The first reason to drop a source text, else ``kept``; cheap tests come first."""
    t = F.coalesce(text, F.lit(""))
    n, letters = F.length(t), characters(t, r"\p{L}")
    urls = F.aggregate(F.regexp_extract_all(t, F.lit(r"(?iU)https?://\S+"), F.lit(0)), F.lit(0), lambda a, x: a + F.length(x))
    return (
        F.when(n < 200, "too_short").when(n > 20000, "too_long").when(letters == 0, "no_letters")
        .when(characters(t, rf"\p{{Is{script}}}") / letters < F.lit(0.6), "not_greek").when(urls / n > F.lit(0.05), "too_many_urls")
        .when(characters(t, r"\p{Lu}") / letters > F.lit(0.4), "too_much_upper").when(characters(t, r"\p{P}") / n > F.lit(0.25), "too_much_punct").otherwise("kept")
    )


def truncated(text: Column, most: int) -> Column:
    """At most ``most`` characters, cut at the last newline among them if there is one."""
    head = F.substring(text, 1, most)
    return F.when(F.length(text) <= most, text).when(F.instr(head, "\n") > 0, F.left(head, F.length(head) - F.length(F.substring_index(head, "\n", -1)) - 1)).otherwise(head)


def trimmed(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)\A[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z", "")


def collapsed(text: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.regexp_replace(F.regexp_replace(text, r"(?U)\s+", " "), r"\A[ \x1c-\x1f]+|[ \x1c-\x1f]+\z", "")


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def bound(value: Column, body) -> Column:
    """``body`` of a value that is computed once, also where a lambda inside uses it for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def shingles(words: Column, k: int = 5) -> Column:
    """Distinct windows of ``k`` tokens joined by a space; the whole of a shorter sequence."""
    windows = lambda w: F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - k + 1, F.lit(1))), lambda i: F.array_join(F.slice(w, i, k), " ")))
    return bound(words, lambda w: F.when(F.size(w) == 0, F.expr("cast(array() as array<string>)")).otherwise(windows(w)))


def language_score(text: Column, lang: str) -> Column:
    """Share of ``lang`` among the function words found, 0 unless it is the most frequent (ties: first by code)."""
    codes = sorted(STOPWORDS)

    def hits(words: Column) -> Column:
        return F.array(*[F.size(F.filter(words, lambda w: w.isin(*STOPWORDS[c]))) for c in codes])  # noqa: B023

    def share(n: Column) -> Column:
        mine = F.get(n, F.lit(codes.index(lang)))
        return F.when((mine > 0) & (F.array_position(n, F.array_max(n)) == codes.index(lang) + 1), mine / F.aggregate(n, F.lit(0), lambda x, y: x + y)).otherwise(F.lit(0.0))

    return bound(bound(tokens(collapsed(text)), hits), share)


def slice_starts(length: Column, size: int = 500, number: int = 3) -> Column:
    """Where ``number`` slices of ``size`` characters of a longer text begin: drawn by a generator that the length seeds. Only lengths go to Python."""

    @F.pandas_udf("array<int>")
    def places(lengths):
        import pandas as pd

        return pd.Series([drawn_starts(int(n), size, number) if n > size else [] for n in lengths])

    return places(length)


@functools.lru_cache(1 << 16)
def drawn_starts(length: int, size: int = 500, number: int = 3) -> list[int]:
    r = random.Random(length)
    return [r.randint(0, length - size) for _ in range(number)]


def slices(text: Column, starts: Column, size: int = 500) -> Column:
    """The whole of a text of up to ``size`` characters, else its slices."""
    return F.when(F.length(text) <= size, F.array(text)).otherwise(F.transform(starts, lambda s: F.substring(text, s + 1, F.lit(size))))


def slice_scores(chunks: Column, score, number: int = 3) -> Column:
    """``score`` (of a column, native or a Pandas UDF) of each slice; none counts as 0."""
    return F.array_compact(F.array(*[F.when(F.size(chunks) > k, F.coalesce(score(F.get(chunks, F.lit(k))), F.lit(0.0))) for k in range(number)]))


def mean(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x) / F.size(values)


def stripped(text: Column) -> Column:
    """Without stacked preambles; empty if what is left is a refusal."""
    out = F.regexp_replace(text, PREAMBLE, "")
    return F.when(out.rlike(rf"(?iU)\A\s*{REFUSALS}"), "").otherwise(out)


def is_refusal(text: Column) -> Column:
    return F.regexp_replace(text, PREAMBLE, "").rlike(rf"(?iU)\A\s*{REFUSALS}")


def occurrences(text: Column, what: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(what), F.lit("")))


def is_faq(text: Column) -> Column:
    return (occurrences(text, "?") + occurrences(text, ";") >= 3) & (occurrences(text, "\n") >= 4)


def is_math(text: Column) -> Column:
    return text.rlike(r"(?U)\d") & text.rlike(rf"(?iU){MATH_WORDS}")


def is_table(text: Column) -> Column:
    """Three lines in a row that begin and end with a pipe."""
    rows = F.transform(F.split(text, LINE_BREAK), lambda x: F.when(x.rlike(r"(?Ud)^\s*\|.*\|\s*$"), "1").otherwise("0"))
    return F.array_join(rows, "").contains("111")


def is_tutorial(text: Column) -> Column:
    return (F.length(text) > 300) & (text.rlike(r"(?mdU)^\s*\d+[.)]\s+\S") | (count(text, r"(?mdU)^\s*[-*•]\s+\S") >= 3))


def format_ok(text: Column, prompt: Column) -> Column:
    return F.when(prompt == "faq", is_faq(text)).when(prompt == "math", is_math(text)).when(prompt == "table", is_table(text)).when(prompt == "tutorial", is_tutorial(text)).otherwise(False)


def size_text(n: Column) -> Column:
    """Whole bytes in the largest fitting unit of 1024, one decimal as C's printf has it: the double's exact value, ties to even. Null stays null."""

    def shown(k: int, unit: str) -> Column:
        # dividing by a power of two, taking off the whole part and ten times the rest (at most 40 bits) are exact
        x = n / F.lit(1024.0**k)
        tenths = F.rint((x - F.floor(x)) * 10.0).cast("int")
        return F.concat(F.floor(x) + F.floor(tenths / 10), F.lit("."), tenths % 10, F.lit(unit))

    out = shown(4, "TB")
    for k, unit in reversed(list(enumerate(("B", "KB", "MB", "GB")))):
        out = F.when(n < 1024 ** (k + 1), shown(k, unit)).otherwise(out)
    return out


def text_head(text: Column, lines: int = 6) -> Column:
    return F.array_join(F.slice(F.split(trimmed(text), LINE_BREAK), 1, lines), "\n")


def bucket(x: Column, n: int) -> Column:
    """The first of ``n`` equal parts of [0, 1] that holds x, edges included; the last one outside."""
    return F.when((x < 0) | (x > 1), F.lit(n - 1)).otherwise(F.array_min(F.filter(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: x <= (i + 1) / F.lit(float(n)))))
