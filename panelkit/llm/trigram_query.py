"""Boolean trigram queries from regular expressions.

A query is a list of clauses that must all hold; a clause is a list of trigram
sets of which one must be contained whole. It follows from the expression: every
text with a match satisfies it. Case is folded, as the index is over lower-case
text. An expression without mandatory trigrams has an empty query.

The expression is read by Python's own parser of regular expressions, so only what
it accepts is supported; anything not understood here counts as "any text", which
weakens the query and never makes it wrong.
"""

from __future__ import annotations

from re import _constants as op
from re import _parser as parser

# Alternatives that are followed one by one, and characters of a class that are.
SPELLINGS = 64
LETTERS = 6

Clause = list[frozenset[str]]


def _grams(text: str) -> frozenset[str]:
    return frozenset(text[i:i + 3] for i in range(len(text) - 2))


def _clause(spellings: set[str]) -> list[Clause]:
    """The clause of a stretch that is one of ``spellings``, unless one of them has no trigram."""
    sets = {_grams(s) for s in spellings}
    if not all(sets):
        return []
    return [sorted((s for s in sets if not any(t < s for t in sets)), key=sorted)]


def _letters(items: list) -> set[str] | None:
    """The characters of a class if they are few, in lower case."""
    out: set[str] = set()
    for kind, value in items:
        if kind is op.LITERAL:
            out.add(chr(value).lower())
        elif kind is op.RANGE and value[1] - value[0] < LETTERS:
            out |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return out if len(out) <= LETTERS else None


def _walk(nodes) -> tuple[set[str] | None, list[Clause]]:
    """All spellings of a sequence if they are few, else None; and the clauses that hold beside them."""
    clauses: list[Clause] = []
    exact: set[str] = {""}
    whole = True

    def unknown() -> None:
        nonlocal exact, whole
        clauses.extend(_clause(exact))
        exact, whole = {""}, False

    def append(more: set[str] | None) -> None:
        nonlocal exact
        if more is None or len(exact) * len(more) > SPELLINGS:
            unknown()
            exact = more if more is not None and len(more) <= SPELLINGS else {""}
        else:
            exact = {a + b for a in exact for b in more}

    for kind, value in nodes:
        if kind is op.LITERAL:
            append({chr(value).lower()})
        elif kind is op.IN:
            append(_letters(value))
        elif kind is op.SUBPATTERN:
            more, held = _walk(value[3])
            append(more)
            clauses += held
        elif kind is op.BRANCH:
            parts = [_walk(p) for p in value[1]]
            if all(more is not None for more, _ in parts):
                append(set().union(*(more for more, _ in parts)))
            else:
                unknown()
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT):
            low, high, body = value
            more, held = _walk(body)
            if high == 1 and more is not None:
                append(more | {""})
                continue
            if low:
                clauses += held
                append(more)
            if low != 1 or high != 1:
                unknown()
        else:
            unknown()
    return (exact, clauses) if whole else (None, clauses + _clause(exact))


def trigram_query(pattern: str) -> list[Clause]:
    """The clauses that every text with a match of ``pattern`` satisfies."""
    exact, clauses = _walk(parser.parse(pattern))
    return clauses + (_clause(exact) if exact is not None else [])


def satisfies(query: list[Clause], trigrams: set[str]) -> bool:
    return all(any(need <= trigrams for need in clause) for clause in query)
