"""Boolean trigram queries of regular expressions (after Cox, 2012).

A query is a list of alternatives, each a set of trigrams: whatever the expression matches holds,
lower-cased, all trigrams of at least one of them. No alternatives at all: nothing is mandatory.
"""

from __future__ import annotations

from re import _constants as op
from re import _parser as parser

GAP = "\0"       # any text may stand here
MOST = 512       # strings an expression is spelled out into before parts of it count as a gap
CLASS = 8        # characters of a class that is spelled out
REPEAT = 4       # repetitions that are spelled out


def query(pattern: str) -> list[frozenset[str]]:
    alternatives = set()
    for spelled in _spell(parser.parse(pattern)):
        grams = {
            piece[i : i + 3] for piece in spelled.split(GAP) for i in range(len(piece) - 2)
        }
        if not grams:
            return []
        alternatives.add(frozenset(grams))
    # An alternative that asks for all that another asks for, and more, adds nothing.
    least = [a for a in alternatives if not any(b < a for b in alternatives)]
    return sorted(least, key=sorted)


def _spell(sequence) -> list[str]:
    out = [""]
    for kind, value in sequence:
        options = _options(kind, value)
        if len(out) * len(options) > MOST:
            options = [GAP]
        out = list(dict.fromkeys(a + b for a in out for b in options))
    return out


def _options(kind, value) -> list[str]:
    if kind is op.LITERAL:
        return [chr(value).lower()]
    if kind is op.IN:
        return _class(value)
    if kind is op.SUBPATTERN:
        return _spell(value[-1])
    if kind is op.BRANCH:
        return list(dict.fromkeys(s for branch in value[1] for s in _spell(branch)))
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT):
        least, most, inner = value
        once = _spell(inner)
        if least == 0:
            return ["", *once] if most == 1 else [GAP]
        if least > REPEAT or len(once) ** least > MOST:
            return [GAP]
        out = [""]
        for _ in range(least):
            out = [a + b for a in out for b in once]
        return out if most == least else [s + GAP for s in out]
    if kind is op.AT:
        return [""]
    return [GAP]


def _class(parts) -> list[str]:
    found: list[str] = []
    for kind, value in parts:
        if kind is op.LITERAL:
            found.append(chr(value).lower())
        elif kind is op.RANGE and value[1] - value[0] < CLASS:
            found += [chr(c).lower() for c in range(value[0], value[1] + 1)]
        else:
            return [GAP]
    return list(dict.fromkeys(found)) if len(found) <= CLASS else [GAP]
