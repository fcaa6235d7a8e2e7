"""Column builders over text: words, lines, ratios, n-grams. All are built-in expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Every white-space character of Unicode and the four information separators, as one Java class.
SPACE_CLASS = "\\s\\u001c-\\u001f\\u0085\\u00a0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
SPACES = f"[{SPACE_CLASS}]+"
#: Line ends: CR LF counts once.
LINE_END = "\\r\\n|[\\n\\r\\u000b\\u000c\\u001c-\\u001e\\u0085\\u2028\\u2029]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluates value once and gives it to body as a lambda variable, which no optimizer rule inlines."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """Pieces between white space."""
    return F.filter(F.split(text, SPACES), lambda w: w != "")


def lines(text: Column) -> Column:
    """Lines without a phantom last one; the empty text has none."""
    return let(F.split(text, LINE_END), lambda p: F.when(F.element_at(p, -1) == "", F.slice(p, 1, F.size(p) - 1)).otherwise(p))


def normalised_space(text: Column) -> Column:
    return F.btrim(F.regexp_replace(text, SPACES, " "))


def ngrams(tokens: Column, n: int) -> Column:
    """All runs of n tokens, joined by a space; none where there are fewer."""

    def of(t: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(1), F.size(t) - n + 1), lambda i: F.array_join(F.slice(t, i, n), " "))
        return F.when(F.size(t) < n, F.array().cast("array<string>")).otherwise(runs)

    return let(tokens, of)


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as a double; 0.0 where there is nothing to divide by."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0)).cast("double")


def stop_word_ratio(tokens: Column, stop_words: tuple[str, ...]) -> Column:
    return let(tokens, lambda t: ratio(F.size(F.filter(t, lambda w: F.lower(w).isin(*stop_words))), F.size(t)))


def symbol_ratio(text: Column) -> Column:
    """Share of characters other than letters and digits among those that are not white space."""
    solid = F.regexp_replace(text, f"[{SPACE_CLASS}]", "")
    return let(solid, lambda s: ratio(F.length(F.regexp_replace(s, "[\\p{L}\\p{N}]", "")), F.length(s)))


def upper_ratio(tokens: Column) -> Column:
    """Of the words made of letters only, the share in capitals."""
    letters = F.filter(tokens, lambda w: ~w.rlike("\\P{L}") & (w != ""))
    return let(letters, lambda t: ratio(F.size(F.filter(t, lambda w: (w == F.upper(w)) & (w != F.lower(w)))), F.size(t)))


def repeat_ngram_ratio(tokens: Column, n: int = 10) -> Column:
    """Share of lower-cased n-word windows that have been seen earlier in the text. Windows compare by 64-bit hash."""

    def of(t: Column) -> Column:
        hashed = F.transform(F.slice(t, 1, F.greatest(F.size(t) - n + 1, F.lit(0))), lambda w, i: F.xxhash64(w, *(F.get(t, i + k) for k in range(1, n))))
        return F.when(F.size(t) < n, F.lit(0.0)).otherwise(let(hashed, lambda h: ratio(F.size(h) - F.size(F.array_distinct(h)), F.size(h))))

    return let(F.transform(tokens, lambda w: F.lower(w)), of)


def short_line_ratio(text: Column, below: int = 30) -> Column:
    return let(lines(text), lambda p: F.when(F.size(p) < 2, F.lit(0.0)).otherwise(ratio(F.size(F.filter(p, lambda x: F.length(x) < below)), F.size(p))))


def joined_text(*parts: Column) -> Column:
    """Strings and string lists joined by single spaces; a null string adds nothing, an empty list an empty part."""
    return F.array_join(F.filter(F.array(*parts), lambda p: p.isNotNull()), " ")


def list_part(items: Column) -> Column:
    """A list of strings as a part of joined_text."""
    return F.array_join(items, " ")


def is_empty(value: Column, kind: str) -> Column:
    """None, the empty string, the empty list and the empty map are empty."""
    if kind == "string":
        return value.isNull() | (value == "")
    if kind.startswith(("array", "map")):
        return value.isNull() | (F.size(value) == 0)
    return value.isNull()
