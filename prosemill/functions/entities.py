"""Entity extraction and literal counts from free text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from prosemill import dims
from prosemill.functions.patterns import ADDRESS, EMAIL, NOT_BEFORE_WORD, PHONE, SPACE, WORD
from prosemill.functions.text import tokenize_words


def _null_if_empty(c: Column) -> Column:
    return F.when(c != "", c)


def first_words(c: Column, n: int = 2) -> Column:
    """The first `n` word tokens (fewer if the text is shorter)."""
    return F.slice(tokenize_words(c), 1, n)


def extract_name(c: Column) -> Column:
    """struct<first, last>: the first two words; both null if there are fewer."""
    w = first_words(c, 2)
    both = F.size(w) == 2
    return F.struct(
        F.when(both, F.get(w, 0)).alias("first"), F.when(both, F.get(w, 1)).alias("last")
    )


def extract_address(c: Column) -> Column:
    """From a number up to the first following whole-word St or Blvd, on one line."""
    return F.regexp_substr(c, F.lit(ADDRESS))


def extract_emails(c: Column) -> Column:
    """All blank-separated tokens that look like an address and one closing character."""
    return F.regexp_extract_all(c, F.lit(EMAIL), F.lit(0))


def extract_email(c: Column) -> Column:
    """The last e-mail address, closing punctuation cut off."""
    return F.regexp_replace(F.try_element_at(extract_emails(c), F.lit(-1)), r"\p{Punct}+$", "")


def extract_county(c: Column) -> Column:
    """The word before "county" in any case."""
    pattern = f"(?i)({WORD}+){SPACE}+county{NOT_BEFORE_WORD}"
    return _null_if_empty(F.regexp_extract(c, pattern, 1))


def extract_phones(c: Column) -> Column:
    """All US phone numbers."""
    return F.regexp_extract_all(c, F.lit(PHONE), F.lit(0))


def extract_state(c: Column, states: Mapping[str, str] = dims.STATES) -> Column:
    """`code-name` of the alphabetically first state code among the words."""
    codes = F.array(*[F.lit(s) for s in states])
    names = F.create_map(*[F.lit(x) for kv in states.items() for x in kv])
    code = F.array_min(F.array_intersect(tokenize_words(c), codes))
    return F.concat(code, F.lit("-"), F.try_element_at(names, code))


def _word_after_name(c: Column, joint: str, prepositions: str) -> Column:
    """The one word after a preposition that follows the text's first two words.

    Commas are removed first.  The pattern holds the text's own name, so it is a
    column; names are word characters only and need no escaping.
    """
    w = first_words(c, 2)
    pattern = F.concat(
        F.lit("(?d)"),
        F.array_join(w, " "),
        F.lit(f"{joint}.*?(?:{prepositions}){SPACE}+({WORD}+)"),
    )
    plain = F.replace(c, F.lit(","), F.lit(""))
    hit = F.call_function("regexp_extract", plain, pattern, F.lit(1))
    return F.when(F.size(w) == 2, _null_if_empty(hit))


def city_candidate(c: Column) -> Column:
    """The word after `First Last: ... from|of|in`."""
    return _word_after_name(c, ": ", "from|of|in")


def company_candidate(c: Column) -> Column:
    """The word after `First Last ... at|of|from`."""
    return _word_after_name(c, " ", "at|of|from")


def fold_case(c: Column) -> Column:
    """Lower case for case-insensitive literal search (long s, dotted and dotless i included)."""
    return F.lower(F.translate(c, "ſıİ", "sii"))


def count_literal(c: Column, term: str, folded: bool = False) -> Column:
    """Non-overlapping occurrences of `term` in any case.

    Counted from the bytes a removal saves, which is one linear scan.  Pass
    `folded=True` when `c` already went through `fold_case`.
    """
    needle = term.lower()
    hay = c if folded else fold_case(c)
    saved = F.octet_length(hay) - F.octet_length(F.replace(hay, F.lit(needle), F.lit("")))
    return (saved / F.lit(len(needle.encode()))).cast("int")


def condition_literals(
    condition: str, literals: Mapping[str, Sequence[str]] = dims.CONDITION_LITERALS
) -> list[str]:
    """The literals whose counts make up a condition: those listed for it, else its name."""
    return list(literals.get(condition, [condition]))
