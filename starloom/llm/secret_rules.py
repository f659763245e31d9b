"""Secret rules, and the Boolean trigram query of a regular expression."""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product
from re import _constants as C
from re import _parser

MOST = 64


@dataclass(frozen=True)
class Rule:
    """``pattern`` for Java and Python alike. ``least``: characters that ``group`` must have."""

    kind: str
    pattern: str
    base: bool = False
    group: int = 0
    least: int = 0


RULES = (
    Rule("assign", r'''((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)''', True, 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}", True),
    Rule("hex", r"[0-9a-f]{24,}", True),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
)


def trigram_query(pattern: str):
    """None (no mandatory trigram), a trigram, or ``("and" | "or", parts)``, over lower-cased text."""
    return _query([(op, arg) for op, arg in _parser.parse(pattern)])


def _strings(op, arg) -> set[str] | None:
    """The few strings an element stands for, or None."""
    if op is C.LITERAL:
        return {chr(arg).lower()}
    if op is C.IN and all(o is C.LITERAL for o, _ in arg):
        return {chr(a).lower() for _, a in arg}
    if op is C.MAX_REPEAT and arg[1] <= 2:
        low, high, inner = arg
        one = _sequence(inner)
        return one and set().union(*({"".join(p) for p in product(one, repeat=n)} for n in range(low, high + 1)))
    if op is C.SUBPATTERN:
        return _sequence(arg[3])
    if op is C.BRANCH:
        parts = [_sequence(p) for p in arg[1]]
        return set().union(*parts) if all(parts) else None
    return None


def _sequence(items) -> set[str] | None:
    found = {""}
    for op, arg in items:
        own = _strings(op, arg)
        if own is None or len(found) * len(own) > MOST:
            return None
        found = {a + b for a in found for b in own}
    return found


def _query(items):
    parts, run = [], {""}

    def close():
        nonlocal run
        if min(map(len, run)) >= 3:
            parts.append(_any([_all(sorted({s[i : i + 3] for i in range(len(s) - 2)})) for s in sorted(run)]))
        run = {""}

    for op, arg in items:
        own = _strings(op, arg)
        if own is not None and len(run) * len(own) <= MOST:
            run = {a + b for a in run for b in own}
            continue
        close()
        if own is not None:
            run = own
        elif op is C.SUBPATTERN:
            parts.append(_query(list(arg[3])))
        elif op is C.BRANCH:
            parts.append(_any([_query(list(p)) for p in arg[1]]))
        elif op is C.MAX_REPEAT and arg[0] > 0:
            parts.append(_query(list(arg[2])))
    close()
    return _all(parts)


def _all(parts):
    parts = [p for p in parts if p is not None]
    return parts[0] if len(parts) == 1 else ("and", parts) if parts else None


def _any(parts):
    return None if any(p is None for p in parts) else parts[0] if len(parts) == 1 else ("or", parts)


def trigrams(query) -> set[str]:
    return set() if query is None else {query} if isinstance(query, str) else set().union(*map(trigrams, query[1]))


def spans_of(rule: Rule, text: str) -> list[tuple[int, int]]:
    """The rule by plain search, for tests."""
    return [m.span() for m in re.finditer(rule.pattern, text) if len(m[rule.group]) >= rule.least]
