"""Visibility expressions: who may see an element, as terms joined by & and |.

A text without any of `& | ( ) "` is one term, as it is; the empty text is seen by all. In other texts terms are
letters, digits and `_ - : . /`, or anything between double quotes, where a backslash precedes quotes and
backslashes. & and | don't mix without parentheses.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

_SIGNS = ("&", "|", "(", ")", '"')
_TOKEN = r'"(?:[^"\\]|\\["\\])+"|[&|()]|[A-Za-z0-9_:./-]+'
#: The walk's state holds three signs for each open parenthesis: the operator met in it (- for none yet), the value
#: so far, and what is wanted next: t for a term, o for an operator or the end. E stands for a malformed text.
_START, _ERROR = "-0t", "E"


def is_plain(term: str) -> bool:
    """Is the authorization a term that stands in expressions as it is, and alone?"""
    return not any(sign in term for sign in _SIGNS)


def is_expression(text: Column) -> Column:
    """Does the text hold any sign of an expression? Scans can test this by themselves."""
    return reduce(lambda a, b: a | b, [text.contains(sign) for sign in _SIGNS])


def _with_value(state: Column, value: Column) -> Column:
    """The state after a term, or a closed parenthesis, of that value."""
    operator, old = F.substring(state, -3, 1), F.substring(state, -2, 1)
    new = F.when(operator == "&", F.least(old, value)).when(operator == "|", F.greatest(old, value)).otherwise(value)
    return F.concat(F.left(state, F.length(state) - 3), operator, new, F.lit("o"))


def _step(state: Column, sign: Column) -> Column:
    wanted, operator = F.substring(state, -1, 1), F.substring(state, -3, 1)
    outer = F.left(state, F.length(state) - 3)
    joined = F.concat(outer, sign, F.substring(state, -2, 1), F.lit("t"))
    return (
        F.when((sign == "(") & (wanted == "t"), F.concat(state, F.lit(_START)))
        .when(sign.isin("&", "|") & (wanted == "o") & operator.isin(F.lit("-"), sign), joined)
        .when((sign == ")") & (wanted == "o") & (F.length(state) > 3), _with_value(outer, F.substring(state, -2, 1)))
        .when(sign.isin("0", "1") & (wanted == "t"), _with_value(state, sign)).otherwise(F.lit(_ERROR)))


def _walked(text: Column, authorizations: Iterable[str]) -> Column:
    """The state at the end of an expression: three signs, or E."""
    known = F.array(*[F.lit(a) for a in authorizations]).cast("array<string>")
    tokens = F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0))

    def sign(token: Column) -> Column:
        """An operator as it is; a term as 1 or 0."""
        inner = F.regexp_replace(F.substr(token, F.lit(2), F.length(token) - 2), r'\\(["\\])', "$1")
        term = F.when(F.startswith(token, F.lit('"')), inner).otherwise(token)
        return F.when(token.isin("&", "|", "(", ")"), token).when(F.array_contains(known, term), F.lit("1")).otherwise(F.lit("0"))

    walk = F.aggregate(F.transform(tokens, sign), F.lit(_START), _step)
    return F.when(F.array_join(tokens, "") == text, walk).otherwise(F.lit(_ERROR))


def _ended(state: Column) -> Column:
    return (F.length(state) == 3) & F.endswith(state, F.lit("o"))


def permits(text: Column, authorizations: Iterable[str]) -> Column:
    """Do the authorizations satisfy the visibility? Null and empty are seen by all; malformed texts raise."""
    authorizations = tuple(authorizations)
    state = _walked(text, authorizations)
    value = F.when(_ended(state), F.substring(state, -2, 1) == "1").otherwise(
        F.raise_error(F.concat(F.lit("Malformed visibility: "), text)).cast("boolean"))
    plain = text.isNull() | text.isin("", *filter(is_plain, authorizations))
    return F.when(is_expression(text), value).otherwise(plain)


def well_formed(text: Column) -> Column:
    """The text, if it is a visibility; else an error."""
    bad = is_expression(text) & ~_ended(_walked(text, ()))
    return F.when(bad, F.raise_error(F.concat(F.lit("Malformed visibility: "), text))).otherwise(text)
