"""Regex building blocks with Unicode meaning on the JVM.

Java's ``\\w``, ``\\s`` and ``\\d`` are ASCII by default, so the classes are
spelled out: a word character is a letter, number or underscore; white space is
every character that splits words in Unicode text.
"""

from __future__ import annotations

WORD = r"[\p{L}\p{N}_]"
DIGIT = r"\p{Nd}"
_SPACES = (
    r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
SPACE = f"[{_SPACES}]"
NOT_SPACE = f"[^{_SPACES}]"

NOT_AFTER_WORD = f"(?<!{WORD})"
NOT_BEFORE_WORD = f"(?!{WORD})"
BOUNDARY = f"(?:(?<={WORD}){NOT_BEFORE_WORD}|{NOT_AFTER_WORD}(?={WORD}))"


def whole_words(pattern: str) -> str:
    """`pattern` not touching another word character on either side."""
    return f"{NOT_AFTER_WORD}(?:{pattern}){NOT_BEFORE_WORD}"


# The patterns of entities and number formats, with the classes above.
ADDRESS = f"(?d){NOT_AFTER_WORD}{DIGIT}.*?(?:St|Blvd){NOT_BEFORE_WORD}"
EMAIL = (
    f"(?<!{NOT_SPACE})[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\\.[a-zA-Z]+{NOT_SPACE}(?!{NOT_SPACE})"
)
PHONE = (
    rf"{BOUNDARY}(?:\+?1{SPACE}*(?:[-.]|{SPACE})?)?\(?{DIGIT}{{3}}\)?(?:[-.]|{SPACE})?"
    rf"{DIGIT}{{3}}(?:[-.]|{SPACE})?{DIGIT}{{4}}{BOUNDARY}"
)
MONTH_DAY_YEAR = f"{NOT_AFTER_WORD}({DIGIT}{{1,2}})[-/]({DIGIT}{{1,2}})[-/]({DIGIT}{{2,4}}){NOT_BEFORE_WORD}"
YEAR_MONTH_DAY = f"{NOT_AFTER_WORD}({DIGIT}{{2,4}})[-/]({DIGIT}{{1,2}})[-/]({DIGIT}{{1,2}}){NOT_BEFORE_WORD}"
AMOUNT = rf"\${SPACE}?{DIGIT}+(?:,{DIGIT}{{3}})*(?:\.{DIGIT}{{1,2}})?"
LONG_NUMBER = f"{DIGIT}{{4,}}"
COMMA_NUMBER = f"(?<!{DIGIT})({DIGIT}++),({DIGIT}+)"
