"""Builders of regular expressions, used when a plan is made."""

from __future__ import annotations

import re
from collections.abc import Iterable


def ordered(terms: Iterable[str]) -> list[str]:
    """Distinct terms, those of more words first, then longer ones, so that an alternation prefers the longest."""
    return sorted(dict.fromkeys(t for t in terms if t), key=lambda t: (-len(t.split()), -len(t)))


def any_of(terms: Iterable[str], plural: bool = False, literal: bool = True) -> str:
    """An alternation; spaces in terms match any white space."""
    found = ordered(terms)
    body = _branches([_pieces(t) for t in found]) if literal else "|".join(found)
    return f"(?:{body}){'(?:s|es)?' if plural else ''}"


def _pieces(term: str) -> tuple[str, ...]:
    """A term's characters as patterns, runs of white space as one."""
    return tuple(r"\s+" if x.isspace() else re.escape(x) for x in re.findall(r"\s+|\S", term))


def _branches(terms: list[tuple[str, ...]]) -> str:
    """The terms as alternatives in their order, what several begin with written once: a place in a text then meets a branch for
    each first character, not for each term. Which term matches stays the same, as terms of other first characters never match there;
    those that differ by case, which a pattern may ignore, are left as they are."""
    if () in terms:  # the end of a term: what follows it in order is tried behind it
        at = terms.index(())
        return "|".join((*([_branches(terms[:at])] if at else []), "", *([_branches(terms[at + 1 :])] if at + 1 < len(terms) else [])))
    groups: dict[str, list[tuple[str, ...]]] = {}
    for t in terms:
        groups.setdefault(t[0].lower(), []).append(t)
    out = []
    for own in groups.values():
        n = 0
        while all(len(t) > n for t in own) and len({t[n] for t in own}) == 1:
            n += 1
        rest = [t[n:] for t in own]
        if len(own) == 1 or n == 0:
            out += ["".join(t) for t in own]
        else:
            out.append("".join(own[0][:n]) + f"(?:{_branches(rest)})")
    return "|".join(out)


def word(pattern: str) -> str:
    return rf"\b(?:{pattern})\b"


def gap(words: int, between: str = r"[\w'-]+") -> str:
    """Up to so many words, and the space before what follows."""
    return rf"\s+(?:{between}\s+){{0,{words}}}"


def guarded(pattern: str, not_before: str = r"\w", not_after: str = r"\w") -> str:
    return rf"(?<![{not_before}])(?:{pattern})(?![{not_after}])"


#: A number as it is written: grouped or plain, with decimals, or a bare fraction.
NUMBER = r"(?:\d{1,3}(?:,\d{3})+(?:\.\d+)?|\d+(?:\.\d+)?|\.\d+)"
RANGE = r"(?:\s*(?:-|–|—|to|and|through)\s*" + NUMBER + ")?"
SCALE = r"(?:hundred|thousand|million|billion|trillion|dozen)"
#: A plain number with a sign or brackets of its own.
_UNSIGNED = r"(?:\d+(?:\.\d+)?|\.\d+)"
FIGURE = rf"(?:\({_UNSIGNED}\)|-?{_UNSIGNED})"
#: What stands between the two ends of a range.
UNTIL = any_of(("-", "–", "—", "to"))
