"""Cleaning, tokenising and standardising free text."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from prosemill import dims
from prosemill.functions.patterns import (
    AMOUNT,
    COMMA_NUMBER,
    DIGIT,
    LONG_NUMBER,
    MONTH_DAY_YEAR,
    SPACE,
    SPACES,
    WORD,
    YEAR_MONTH_DAY,
    whole_words,
)


def text_or_empty(c: Column) -> Column:
    """The value as a string, '' where it is null."""
    return F.coalesce(c.cast("string"), F.lit(""))


def concat_text(*cols: Column) -> Column:
    """Texts joined by one blank; a missing text counts as ''."""
    return F.concat_ws(" ", *[text_or_empty(c) for c in cols])


def lower_text(c: Column) -> Column:
    return F.lower(c)


def strip_punct(c: Column) -> Column:
    """Every ASCII punctuation character becomes a blank."""
    return F.translate(c, dims.PUNCTUATION, " " * len(dims.PUNCTUATION))


def plain_spaces(c: Column) -> Column:
    """Every kind of white space as a plain blank (one linear pass, no regex)."""
    return F.translate(c, SPACES, " " * len(SPACES))


def squeeze_ws(c: Column) -> Column:
    """Every run of white space becomes one blank."""
    return F.regexp_replace(plain_spaces(c), " {2,}", " ")


def strip_digits(c: Column) -> Column:
    return F.regexp_replace(c, DIGIT + "+", "")


def tokenize_ws(c: Column) -> Column:
    """Runs of non-blank characters, in order."""
    return F.filter(F.split(plain_spaces(c), " ", -1), lambda t: t != "")


def tokenize_words(c: Column) -> Column:
    """Runs of letters, numbers and underscores, in order."""
    return F.regexp_extract_all(c, F.lit(WORD + "+"), F.lit(0))


def tokenize_terms(c: Column, min_chars: int = 2) -> Column:
    """Word tokens of at least `min_chars` characters (the TF-IDF tokens)."""
    return F.regexp_extract_all(c, F.lit(f"{WORD}{{{min_chars},}}"), F.lit(0))


def word_count(c: Column) -> Column:
    return F.size(tokenize_ws(text_or_empty(c)))


def drop_stopwords(tokens: Column, stop: Sequence[str] = dims.STOP_WORDS) -> Column:
    """Tokens not in the stop list, order kept."""
    words = list(stop)
    if not words:
        return tokens
    return F.filter(tokens, lambda t: ~t.isin(words))


def expand_contractions(
    c: Column,
    rules: Sequence[tuple[str, str]] = tuple(dims.CONTRACTIONS),
    hints: Sequence[str] = tuple(dims.CONTRACTION_HINTS),
) -> Column:
    """Whole-word contractions of lower-case text written out ("can't" -> "cannot").

    No contraction holds a blank, so the rules run only on the blank-separated
    pieces that contain one of the hints; all other text is not searched.
    """

    def expand(piece: Column) -> Column:
        out = piece
        for pattern, expansion in rules:
            out = F.regexp_replace(out, whole_words(pattern), re.sub(r"\\(\d)", r"$\1", expansion))
        hit = F.lit(False)
        for h in hints:
            hit = hit | F.contains(piece, F.lit(h))
        return F.when(hit, out).otherwise(piece)

    straight = F.translate(c, "\u2019", "'")
    return F.array_join(F.transform(F.split(straight, " ", -1), expand), " ")


def replace_matches(c: Column, pattern: str, new: Callable[[Column], Column]) -> Column:
    """Each match of `pattern` replaced by `new(match)`; the rest is untouched."""
    gaps = F.split(c, pattern, -1)
    hits = F.regexp_extract_all(c, F.lit(pattern), F.lit(0))
    pieces = F.zip_with(
        gaps, F.transform(hits, new), lambda g, h: F.concat(g, F.coalesce(h, F.lit("")))
    )
    return F.when(F.size(hits) > 0, F.array_join(pieces, "")).otherwise(c)


def _iso(y: Column, m: Column, d: Column, otherwise: Column) -> Column:
    iso = F.concat_ws("-", F.lpad(y, 4, "0"), F.lpad(m, 2, "0"), F.lpad(d, 2, "0"))
    return F.when(F.try_to_date(iso, "yyyy-MM-dd").isNotNull(), iso).otherwise(otherwise)


def standardize_dates(c: Column) -> Column:
    """month/day/year and year/month/day substrings (- or /) as ISO dates.

    Substrings that are not calendar dates stay as they are.  Years are read
    as written (no century is added).
    """
    def part(m: Column, i: int) -> Column:
        return F.element_at(F.split(m, "[-/]"), i)

    c = replace_matches(c, MONTH_DAY_YEAR, lambda m: _iso(part(m, 3), part(m, 1), part(m, 2), m))
    return replace_matches(c, YEAR_MONTH_DAY, lambda m: _iso(part(m, 1), part(m, 2), part(m, 3), m))


def standardize_currency(c: Column) -> Column:
    """Dollar amounts with thousands commas and two decimals."""

    def fmt(m: Column) -> Column:
        number = F.regexp_replace(m, rf"[$,]|{SPACE}", "").try_cast("decimal(38,2)")
        return F.coalesce(F.concat(F.lit("$"), F.format_number(number, 2)), m)

    return replace_matches(c, AMOUNT, fmt)


def standardize_thousands(c: Column) -> Column:
    """A comma every three digits in digit runs of four or more: each run once, from its end."""

    def grouped(run: Column) -> Column:
        return F.reverse(F.regexp_replace(F.reverse(run), rf"({DIGIT}{{3}})(?={DIGIT})", "$1,"))

    return replace_matches(c, LONG_NUMBER, grouped)


def standardize_decimals(c: Column) -> Column:
    """digits,digits -> digits.digits."""
    return F.regexp_replace(c, COMMA_NUMBER, "$1.$2")


def standardize_formats(c: Column) -> Column:
    """Dates, currency, thousands and decimals, in this order."""
    return standardize_decimals(
        standardize_thousands(standardize_currency(standardize_dates(c)))
    )


def preprocess_text(c: Column, stop: Sequence[str] = dims.STOP_WORDS) -> Column:
    """Punctuation, white space, digits and stop words removed.

    The standardising rules that follow digit removal in this recipe can never
    fire (no digit is left), so they are not in the plan; splitting on blanks
    makes a separate squeeze needless.
    """
    return F.array_join(preprocess_tokens(c, stop), " ")


def preprocess_tokens(c: Column, stop: Sequence[str] = dims.STOP_WORDS) -> Column:
    """The tokens of `preprocess_text`."""
    blanks = dims.PUNCTUATION + SPACES
    cleaned = strip_digits(F.translate(text_or_empty(c), blanks, " " * len(blanks)))
    words = ["", *stop]
    return F.filter(F.split(cleaned, " ", -1), lambda t: ~t.isin(words))


def clean_note(c: Column) -> Column:
    """Lower case, contractions expanded, punctuation and white space cleaned."""
    return squeeze_ws(strip_punct(expand_contractions(lower_text(text_or_empty(c)))))


def finish_note(c: Column, stop: Sequence[str] = dims.STOP_WORDS) -> Column:
    """Number formats standardised and stop words removed.

    Date and currency rules need `/`, `-` or `$`, all gone after cleaning.
    """
    numbers = standardize_decimals(standardize_thousands(c))
    return F.array_join(drop_stopwords(tokenize_ws(numbers), stop), " ")
