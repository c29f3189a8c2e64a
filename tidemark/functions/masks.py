"""File-name masks as Column predicates.

A mask is a file name in which a date token such as ``YYYYMMDD`` stands for digits. A
mask that starts or ends with ``*`` is a *glob* mask and may match anywhere in the name;
any other is an *exact* mask, anchored at the start and mostly of equal length. Text
around the token is a regular expression, as users of such masks rely on it.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# What each part of a date may be.
YEAR = "([0-9]{4})"
MONTH = "(1[0-2]|0[1-9])"
DAY = "(3[01]|[12][0-9]|0[1-9])"
HOUR = "([01][0-9]|2[0-3])"
SIXTY = "([0-5][0-9])"
SIX_DIGITS = "([0-9]{6})"

# Custom masks that ship with the package.
CUSTOM_TOKENS = {"YYYYWW": "([0-9]{4})(0[1-9]|[1-4][0-9]|5[0-3])"}

# Characters that no source file name may contain.
ILLEGAL_CHARACTERS = r"[@!%^&*<>?/\\|}{~:]"


@dataclass(frozen=True)
class Token:
    """How one date token is tested.

    ``whole`` tests the mask with the token replaced; otherwise the token's digits may
    be anywhere in the name. ``prefix`` asks for the text before the token at the start
    of the name. ``sized`` asks for equal length and ``anchored`` for a match from the
    start, both in exact masks only.
    """

    text: str
    digits: str
    whole: bool = True
    prefix_in_glob: bool = False
    prefix_in_exact: bool = False
    sized: bool = True
    anchored: bool = True


# The tokens, tested in this order; the first one found in a mask decides.
TOKENS = (
    Token("YYYYMMDDHHMMSS", YEAR + MONTH + DAY + HOUR + SIXTY + SIXTY),
    Token("YYYYMMDD_HHMMSS", YEAR + MONTH + DAY + "_" + SIX_DIGITS, sized=False, anchored=False),
    Token("YYYY-MM-DD", f"{YEAR}-{MONTH}-{DAY}"),
    Token("MMYYYY", MONTH + YEAR, whole=False, prefix_in_exact=True),
    Token("YYYYMMDD", YEAR + MONTH + DAY),
    Token("YYYYMM", YEAR + MONTH, whole=False, prefix_in_glob=True, prefix_in_exact=True),
    Token("MM-DD-YYYY", f"{MONTH}-{DAY}-{YEAR}"),
    Token("DDMONYYYY", f"{DAY}([A-Z]{{3}}){YEAR}"),
    Token("YYYY_MM_DD_######", f"{YEAR}_{MONTH}_{DAY}_{SIX_DIGITS}", anchored=False),
    Token("YYYYQ#", YEAR + "Q[1-4]", whole=False),
    Token("YYYYQ", YEAR + "[1-4]"),
    Token("YYYY", YEAR, whole=False, prefix_in_exact=True),
)

# A lone letter N before the month token stands for one digit.
DIGIT_MONTH = re.compile(r"(?<![A-Za-z])N_YYYYMM(?!DD)")


def _token_tests(name: Column, mask: str, token: Token, glob: bool) -> list[Column]:
    regex = mask.replace(token.text, token.digits) if token.whole else token.digits
    if token.whole and token.anchored and not glob:
        regex = f"^(?:{regex})"
    tests = [name.rlike(regex)]
    if token.prefix_in_glob if glob else token.prefix_in_exact:
        tests.append(name.startswith(mask.split(token.text)[0]))
    if token.sized and not glob:
        tests.append(F.length(name) == len(mask))
    return tests


def mask_matches(name: Column, mask: str | None) -> Column:
    """True where the file name fits the mask. A blank mask takes every name."""
    if not mask:
        return F.lit(True)
    glob = mask.startswith("*") or mask.endswith("*")
    tests = []
    if mask.startswith("*"):
        tests.append(~name.contains(".") | name.endswith(mask.split(".")[-1]))
    body = mask.strip("*") if glob else mask
    token = next((t for t in TOKENS if t.text in body), None)
    if token is None:
        tests.append(name.rlike(body if glob else f"^(?:{body})"))
    else:
        plain = reduce(Column.__and__, _token_tests(name, body, token, glob))
        if token.text == "YYYYMM" and DIGIT_MONTH.search(body):
            digit = name.rlike(DIGIT_MONTH.sub(lambda _: f"[0-9]_{YEAR}{MONTH}", body))
            if not glob:
                digit = digit & (F.length(name) == len(body))
            plain = plain | digit
        tests.append(plain)
    return reduce(Column.__and__, tests)


def custom_mask_matches(
    name: Column,
    mask: str,
    tokens: Mapping[str, str] | Callable[[Column, str], Column] = CUSTOM_TOKENS,
) -> Column:
    """Custom masks: equal length and the token's digits somewhere in the name.

    ``tokens`` maps token to regular expression, or is a function of the caller's own
    that returns the predicate. A mask without a known token matches nothing.
    """
    if callable(tokens):
        return tokens(name, mask)
    for text, digits in tokens.items():
        if text in mask:
            return (F.length(name) == len(mask)) & name.rlike(digits)
    return F.lit(False)


def legal_name(name: Column) -> Column:
    return ~name.rlike(ILLEGAL_CHARACTERS)
