"""Column expressions over text. All run inside the JVM on one row at a time."""

from __future__ import annotations

import string
from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns that define a word, a sentence end and each style mark.
NOT_WORD = "[^a-z]+"
WORD_WITH_APOSTROPHE = "[a-z]+(?:'[a-z]+)?"
SENTENCE_END = r"[.!?]+\s+"
EMOTICON = "[:;]-?[)(DP]"
EXCLAMATION = "!!+"
URL = r"(?:https?|ftp)://[^\s]+"
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+\.[A-Za-z0-9.-]+"
# The same addresses, looked for where a run of their letters begins or the last match ended, not from each letter anew.
EMAIL_AT = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+\.[A-Za-z0-9.-]+"
PRICE = r"\$ ?[0-9][0-9,]*(?:\.[0-9][0-9])?"
ASCII_WORD = "[A-Za-z]+"
SHOUTED = "(?<![A-Za-z])[A-Z]{3,}+(?![A-Za-z])"
STRETCH = r"([a-z])\1\1[a-z]*+"
STRETCHED = "[a-z]*(?:" + "|".join(f"{c}{c}{c}" for c in string.ascii_lowercase) + ")[a-z]*"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` computed once per row, however often the body uses it.

    The optimizer may copy a computed column into every place that reads it, also into a lambda,
    where it would be computed again for each element.
    """
    return F.get(F.transform(F.array(value), lambda v: body(v)), F.lit(0))


def words(text: Column | str) -> Column:
    """Lower-case runs of a to z. Splitting on the rest is twice as fast as extracting."""
    return F.array_remove(F.split(F.lower(text), NOT_WORD), "")


def words_with_apostrophe(text: Column | str) -> Column:
    """Like `words`, but keeps "isn't" in one piece."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD_WITH_APOSTROPHE), F.lit(0))


def sentence_array(text: Column | str) -> Column:
    return F.filter(F.split(text, SENTENCE_END), lambda s: F.trim(s) != "")


def word_ngrams(tokens: Column, n: int) -> Column:
    """Adjacent n-grams of a token array, in order; empty when there are fewer than n tokens."""

    def grams(t: Column) -> Column:
        last = F.size(t) - (n - 1)
        starts = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(
            F.array().cast("array<int>")
        )
        return F.transform(starts, lambda i: F.array_join(F.slice(t, i, F.lit(n)), " "))

    return let(tokens, grams)


def counted_terms(tokens: Column) -> Column:
    """array<struct<token, tf>> of a token array: sort it and measure each run of equal tokens."""

    def run_ends(t: Column) -> Column:
        size = F.size(t)
        return F.filter(
            F.sequence(F.lit(1), F.greatest(size, F.lit(1))),
            lambda i: ((i == size) & (size > 0)) | ((i < size) & (F.get(t, i) != F.get(t, i - 1))),
        )

    def counts(t: Column, ends: Column) -> Column:
        def count(end: Column, j: Column) -> Column:
            before = F.when(j == 0, F.lit(0)).otherwise(F.get(ends, j - 1))
            return F.struct(
                F.get(t, end - 1).alias("token"), (end - before).cast("bigint").alias("tf")
            )

        return F.transform(ends, count)

    return let(F.array_sort(tokens), lambda t: let(run_ends(t), lambda ends: counts(t, ends)))


def cleaned(text: Column | str) -> Column:
    """Undo overstrikes, drop control characters, fold tabs, returns and repeated blanks."""
    out = F.regexp_replace(text, "\r\n", "\n")
    out = F.regexp_replace(out, "[^\n]\x08", "")
    out = F.regexp_replace(out, "[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f]", "")
    out = F.regexp_replace(out, "[\t\r]", " ")
    return F.trim(F.regexp_replace(out, " {2,}", " "))


def folded(text: Column | str) -> Column:
    """Text with every run of ASCII white space folded to one blank."""
    return F.trim(F.regexp_replace(text, "[ \\t\\n\\r\\f\\x0b]+", " "))


def occurrences(text: Column | str, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("bigint")


def shouted_words(text: Column | str) -> Column:
    """Runs of letters that are three or more capitals. Found as such: no list of all words is made."""
    return occurrences(text, SHOUTED)


def stretched_words(text: Column | str) -> Column:
    """As many as `STRETCHED` finds: from a word's first three equal letters on, the rest of the word belongs to the match, so each word counts once."""
    return occurrences(F.lower(text), STRETCH)


def marked(text: Column | str, pattern: str, *marks: str) -> Column:
    """`occurrences` of a pattern that cannot match where one of `marks` is missing: such texts are not searched."""
    text = F.col(text) if isinstance(text, str) else text
    has_all = reduce(and_, (F.contains(text, F.lit(m)) for m in marks))
    return F.when(has_all, occurrences(text, pattern)).when(text.isNotNull(), F.lit(0).cast("bigint"))
