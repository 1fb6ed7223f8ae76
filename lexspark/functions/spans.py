"""How many words a match of a pattern may touch."""

from __future__ import annotations

import re
from collections.abc import Sequence
from re import _constants as c
from re import _parser


class UnboundedPattern(ValueError):
    """A pattern whose matches cannot be bounded to a number of words."""


_SPACES = frozenset(map(ord, " \t\n\v\f\r\x1c\x1d\x1e\x1f\x85\xa0"))


def _of_set(items: Sequence) -> tuple[bool, bool, bool]:
    """Whether a set of characters has white space, something else, and U+0000."""
    space = other = zero = False
    for op, value in items:
        if op is c.LITERAL:
            space, other, zero = space or value in _SPACES, other or value not in _SPACES, zero or value == 0
        elif op is c.RANGE:
            low, high = value
            space = space or any(low <= s <= high for s in _SPACES)
            other, zero = True, zero or low == 0
        elif op is c.CATEGORY:
            if value is c.CATEGORY_SPACE:
                space = True
            elif value in (c.CATEGORY_WORD, c.CATEGORY_DIGIT):
                other = True
            else:
                return True, True, True
        else:
            return True, True, True
    return space, other, zero


def _gaps(parsed: Sequence, pattern: str) -> int:
    """The most separate runs of white space in a match."""

    def refuse(why: str):
        raise UnboundedPattern(f"{pattern!r}: {why}")

    total = 0
    for op, value in parsed:
        if op in (c.LITERAL, c.IN, c.CATEGORY):
            space, _, zero = _of_set([(op, value)] if op is not c.IN else value)
            if zero:
                refuse("a part of it matches U+0000")
            total += space
        elif op in (c.MAX_REPEAT, c.MIN_REPEAT, c.POSSESSIVE_REPEAT):
            _, most, inner = value
            one = list(inner)
            # Repeated white space alone is one run.
            if len(one) == 1 and one[0][0] in (c.LITERAL, c.IN, c.CATEGORY):
                space, other, zero = _of_set(one[0][1] if one[0][0] is c.IN else one)
                if zero:
                    refuse("a part of it matches U+0000")
                if space and not other:
                    total += 1
                    continue
            each = _gaps(inner, pattern)
            if each and most is c.MAXREPEAT:
                refuse("white space repeats without bound")
            total += each * (most if each else 0)
        elif op is c.SUBPATTERN:
            total += _gaps(value[-1], pattern)
        elif op is c.ATOMIC_GROUP:
            total += _gaps(value, pattern)
        elif op is c.BRANCH:
            total += max(_gaps(branch, pattern) for branch in value[1])
        elif op is c.AT and value in (c.AT_BOUNDARY, c.AT_NON_BOUNDARY):
            continue
        elif op in (c.NOT_LITERAL, c.ANY):
            refuse("a part of it matches any character but some")
        else:
            refuse(f"{op} isn't supported")
    return total


def words_spanned(pattern: str) -> int:
    """Words a match may touch at most; a pattern for which there is no bound is refused.

    Refused are also parts that match U+0000 (``.``, ``\\W``, negated sets), anchors to the ends of
    a text, and what looks around. Leading flags are left out.
    """
    bare = re.sub(r"\A\(\?[A-Za-z]+\)", "", pattern)
    try:
        parsed = _parser.parse(bare)
    except re.error as error:
        raise UnboundedPattern(f"{pattern!r}: {error}") from error
    return _gaps(parsed, pattern) + 1
