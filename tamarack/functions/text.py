"""Column functions for text clean-up, tokens and fingerprints."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters taken out or split off by the functions below.
SPACE = r"[\s\x0B\x1C-\x1F\x{85}\p{Z}]"
PUNCTUATION = r"[!-/:-@\[-`{-~]"
TYPOGRAPHIC_QUOTES = "[«“‘„»”’]"
NUMERIC = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
# Accented letters and the ASCII letters they fold to.
ACCENTED = "àáâãäåçèéêëìíîïñòóôõöøùúûüýÿ"
FOLDED = "aaaaaaceeeeiiiinoooooouuuuyy"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_text(c: Column | str) -> Column:
    """Strip every kind of white space at both ends."""
    return F.regexp_replace(_col(c), f"^{SPACE}+|{SPACE}+$", "")


def squash_whitespace(c: Column | str) -> Column:
    """Trim, and turn each inner run of white space into one blank."""
    return F.trim(F.regexp_replace(_col(c), f"{SPACE}+", " "))


def blank_to_null(c: Column | str) -> Column:
    """NULL for an empty or all-blank text."""
    return F.nullif(F.trim(_col(c)), F.lit(""))


def strip_punctuation(c: Column | str) -> Column:
    """Remove ASCII punctuation."""
    return F.regexp_replace(_col(c), PUNCTUATION, "")


def strip_control_chars(c: Column | str) -> Column:
    """Remove the characters of the Unicode categories C*."""
    return F.regexp_replace(_col(c), r"\p{C}", "")


def tokenize_whitespace(c: Column | str) -> Column:
    """Words between white space; an empty array for a blank text."""
    return F.array_remove(F.split(_col(c), f"{SPACE}+"), "")


def tokenize_words(c: Column | str, mode: str = "strip") -> Column:
    """Tokens in text order, case kept.

    ``strip`` drops ASCII punctuation first. ``keep_punct`` makes punctuation
    marks tokens of their own; apostrophes, hyphens, slashes and inner periods
    stay in their word, and a run of periods or a pair of dashes is one token.
    Contractions are not split.
    """
    text = _space_quotes(_col(c))
    if mode == "strip":
        text = strip_punctuation(text)
    elif mode == "keep_punct":
        text = F.regexp_replace(text, r'([;@#$%&?!*()\[\]{}<>"])', " $1 ")
        text = F.regexp_replace(text, r"(\.\.+|--)", " $1 ")
        text = F.regexp_replace(text, r"([:,])([^0-9]|$)", " $1 $2")
        text = F.regexp_replace(text, rf"([^.\s])(\.)({SPACE}|$)", "$1 $2$3")
    else:
        raise ValueError(f"no tokenizer mode {mode}")
    return tokenize_whitespace(text)


def _space_quotes(text: Column) -> Column:
    """Blanks around typographic quotes; a byte search spares most texts the pattern."""
    found = reduce(Column.__or__, [text.contains(q) for q in TYPOGRAPHIC_QUOTES.strip("[]")])
    return F.when(found, F.regexp_replace(text, f"({TYPOGRAPHIC_QUOTES})", " $1 ")).otherwise(text)


def word_ngrams(c: Column | str, n: int = 2) -> Column:
    """Runs of ``n`` words, words being cut at single blanks; none if too short."""
    return _ngrams(F.split(_col(c), " "), n, " ")


def char_ngrams(c: Column | str, n: int = 2) -> Column:
    """Runs of ``n`` characters; none if too short."""
    return _ngrams(F.split(_col(c), ""), n, "")


def _ngrams(parts: Column, n: int, glue: str) -> Column:
    def grams(words: Column) -> Column:
        length = F.greatest(F.size(words) - n + 1, F.lit(0))
        out = F.slice(words, 1, length)
        for k in range(1, n):
            follow = F.slice(words, k + 1, length)
            out = F.zip_with(out, follow, lambda a, b: F.concat(a, F.lit(glue), b))
        return out

    # One-element array: its lambda variable holds the words, split only once.
    return F.get(F.transform(F.array(parts), grams), 0)


def array_sort_distinct(c: Column | str) -> Column:
    """Sorted array without repeats."""
    return F.array_sort(F.array_distinct(_col(c)))


def fold_ascii(c: Column | str) -> Column:
    """Lower-case accented western letters to their ASCII letters."""
    return F.translate(_col(c), ACCENTED, FOLDED)


def fingerprint_ngram_word(c: Column | str, n: int = 2) -> Column:
    """Sorted distinct word n-grams, joined without separator ('' if too short)."""
    return F.array_join(array_sort_distinct(word_ngrams(c, n)), "")


def fingerprint_ngram_char(c: Column | str, n: int = 2) -> Column:
    """Key that ignores case, punctuation and white space, folded to ASCII.

    The folding comes last: n-grams sort by their accented letters.
    """
    text = strip_control_chars(strip_punctuation(F.lower(_col(c))))
    text = F.regexp_replace(text, f"{SPACE}+", "")
    return fold_ascii(F.array_join(array_sort_distinct(char_ngrams(text, n)), ""))


def split_columns(c: Column | str, names: list[str], delimiter: str = " ") -> list[Column]:
    """One column per part; missing parts are NULL, surplus parts go to ``rest``."""
    parts = F.split(_col(c), delimiter)
    cut = [F.get(parts, i).alias(n) for i, n in enumerate(names)]
    surplus = F.slice(parts, len(names) + 1, F.greatest(F.size(parts) - len(names), F.lit(0)))
    rest = F.when(F.size(parts) > len(names), F.array_join(surplus, delimiter))
    return [*cut, rest.alias("rest")]


def parse_date_text(c: Column | str, pattern: str = "MMM d, yyyy") -> Column:
    """Date written like 'Jan 5, 2024'; NULL where it does not parse."""
    return F.to_date(F.try_to_timestamp(_col(c), F.lit(pattern)))


def is_numeric(c: Column | str) -> Column:
    """Whether a text is a plain decimal number."""
    return _col(c).rlike(NUMERIC)
