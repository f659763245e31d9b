"""Personal data, also where it is disguised, with offsets into the source.

The base patterns run on the text itself. Then transducers normalise the text: homoglyphs and
full-width forms become ASCII, invisible characters vanish, spelled digits become digits, and
"at" and "dot" disguises become ``@`` and ``.``. Each keeps an edit list, from which a span of
the normalised text is mapped back to source characters. Identifiers found there are added
unless a base span of their kind holds them. Base spans stay, also inside an added span: where an
identifier is disguised in part, its plain rest may be one by itself.

Offsets are code points, end exclusive. A null text counts as empty. Repeated rows are scanned
each for itself; other columns are ignored; an empty table gives none.
"""

from __future__ import annotations

import re
from bisect import bisect_right

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import map_batches

KINDS = ("email", "ip", "card", "phone")
SPANS = "doc_id long, base array<struct<kind:string,start:int,stop:int>>, spans array<struct<kind:string,start:int,stop:int>>"

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# The lookbehind changes no match; without it every digit of a long number starts a search.
CHAIN = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3,}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def emails(text: str):
    """From each ``@`` outwards, so long runs of letters cost nothing."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1].isascii() and (text[start - 1].isalnum() or text[start - 1] in "._%+-"):
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            end = found.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def ips(text: str):
    """Chains of numbers are cut into fours from the left."""
    for chain in CHAIN.finditer(text):
        at, parts = chain.start(), chain[0].split(".")
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            size = sum(map(len, four)) + 3
            if all(len(n) <= 3 and int(n or 0) <= 255 for n in (p.lstrip("0") for p in four)):
                yield at, at + size
            at += size + 1


def cards(text: str):
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def phones(text: str):
    for m in PHONE.finditer(text):
        if 9 <= sum(map(str.isdigit, m[0])) <= 15:
            yield m.span()


FINDERS = dict(zip(KINDS, (emails, ips, cards, phones)))


def find(text: str) -> list[tuple[str, int, int]]:
    return [(kind, *span) for kind, finder in FINDERS.items() for span in finder(text)]


# --- transducers --------------------------------------------------------------------------

# Cyrillic and Greek letters drawn like Latin ones.
LOOKALIKES = dict(zip("аеорсухіјѕһԁԛԝАВЕКМНОРСТУХІЈЅΑΒΕΖΗΙΚΜΝΟΡΤΥΧοα", "aeopcyxijshdqwABEKMHOPCTYXIJSABEZHIKMNOPTYXoa"))
INVISIBLE = "­​‌‍⁠﻿"
OTHER_SIGNS = {"‐": "-", "‑": "-", "‒": "-", "–": "-", " ": " ", "․": ".", "。": "."}
# Full-width forms lie 0xFEE0 above ASCII.
SINGLE = {**LOOKALIKES, **OTHER_SIGNS, **{chr(c + 0xFEE0): chr(c) for c in range(0x21, 0x7F)}, **dict.fromkeys(INVISIBLE, "")}
ODD = re.compile(f"[{re.escape(''.join(SINGLE))}]")

DIGITS = dict(zip("zero oh one two three four five six seven eight nine".split(), "00123456789"))
DIGIT = "|".join(DIGITS)
NUMBER = rf"(?:{DIGIT}|[0-9]+)"
SPELLED = re.compile(rf"(?i)(?<![A-Za-z0-9])(?:(?:plus[\x20-]|\+)?{NUMBER}(?:[\x20.,()-]{{1,3}}{NUMBER}){{6,}}|{NUMBER}(?:[\x20-]{NUMBER})*(?:\x20(?:dot|point)\x20{NUMBER}(?:[\x20-]{NUMBER})*){{3}})(?![A-Za-z0-9])")
TOKEN = re.compile(rf"(?i)plus[\x20-]|{DIGIT}|\x20(?:dot|point)\x20|[0-9]+|.", re.S)

OPEN, CLOSE = r"\s?[\[({<]\s?", r"\s?[\])}>]\s?"
MARKED = lambda word, sign: rf"{OPEN}(?:{word}|{sign}){CLOSE}"
AT, DOT = MARKED("at", "@"), MARKED("dot", r"\.")
NAME, LABEL = r"[A-Za-z0-9_%+-]+", r"[A-Za-z0-9-]+"
SEPARATOR = rf"(?:{DOT}|\.|\x20dot\x20)"
# What stands before an "at", read backwards from it.
BEHIND = r"(?:\s?[\])}>]\s?(?:tod|\.)\s?[\[({<]\s?|\.|\x20tod\x20)"
BACKWARDS = re.compile(rf"(?i){NAME}(?:{BEHIND}{NAME})*")
# A bare "at" counts only with a disguised dot behind it; a marked one and "@" with any dot.
ANY_AT = re.compile(rf"(?i)(?P<marked>{AT})|\x20at\x20|(?P<sign>@)")
DOTTED = re.compile(rf"(?i){LABEL}(?:{SEPARATOR}{LABEL})+")
HIDDEN = re.compile(rf"(?i){LABEL}(?:\.{LABEL})*(?:{DOT}|\x20dot\x20){LABEL}(?:{SEPARATOR}{LABEL})*")
SIGNS = re.compile(rf"(?i){AT}|{DOT}|\x20at\x20|\x20dot\x20")
CUES = re.compile(r"(?i)[\[({<]\s?(?:at|dot|@|\.)\s?[\])}>]|\x20dot\x20")


class Edits:
    """The edit list of a transducer: where its output and its input correspond."""

    def __init__(self, edits: list[tuple[int, int, str]]):
        self.out, self.source = [0], [(0, 0, True)]
        shift = 0
        for start, stop, new in edits:
            self._mark(start + shift, (start, stop, False))
            shift += len(new) - (stop - start)
            self._mark(stop + shift, (stop, stop, True))

    def _mark(self, out: int, piece: tuple) -> None:
        if self.out[-1] == out:
            self.out.pop(), self.source.pop()
        self.out.append(out), self.source.append(piece)

    def back(self, at: int, end: bool) -> int:
        """The source position of an output position; inside an edit, its outer border."""
        i = bisect_right(self.out, at - end) - 1
        start, stop, plain = self.source[i]
        return start + at - self.out[i] if plain else stop if end else start


def _edited(text: str, edits: list[tuple[int, int, str]]) -> tuple[str, Edits]:
    parts, at = [], 0
    for start, stop, new in edits:
        parts += text[at:start], new
        at = stop
    return "".join([*parts, text[at:]]), Edits(edits)


def _letters(text: str) -> list:
    return [(m.start(), m.end(), SINGLE[m[0]]) for m in ODD.finditer(text)]


def _spelled(text: str) -> list:
    edits = []
    for m in SPELLED.finditer(text):
        if not re.search(DIGIT, m[0].lower()):
            continue
        for t in TOKEN.finditer(text, *m.span()):
            word = t[0].lower()
            new = "+" if word.startswith("plus") else "." if word.strip() in ("dot", "point") else DIGITS.get(word)
            if new is None and word == " " and t.start() and t.end() < m.end():
                new = ""
            if new is not None:
                edits.append((t.start(), t.end(), new))
    return edits


def _signs(text: str) -> list:
    """From each "at" outwards, so long chains of names cost nothing where there is none."""
    if not CUES.search(text):
        return []
    found, end, mirrored, size = [], 0, text[::-1], len(text)
    for at in ANY_AT.finditer(text):
        if at.start() < end:
            continue
        after = (DOTTED if at["marked"] or at["sign"] else HIDDEN).match(text, at.end())
        before = after and BACKWARDS.match(mirrored, size - at.start(), size - end)
        if before:
            end = after.end()
            start = size - before.end()
            found += [(s.start(), s.end(), "@" if "at" in s[0].lower() or "@" in s[0] else ".") for s in SIGNS.finditer(text, start, end)]
    return found


def scan_text(text: str | None) -> tuple[list, list]:
    """Base spans and all spans, by kind and start."""
    text = text or ""
    base = find(text)
    changed, maps = text, []
    for transducer in (_letters, _spelled, _signs):
        if edits := transducer(changed):
            changed, back = _edited(changed, edits)
            maps.append(back)
    spans = list(base)
    if maps:
        # The base spans of a kind are sorted and apart, so only the last one that starts early enough can hold another.
        held = {kind: [s[1:] for s in base if s[0] == kind] for kind in KINDS}
        for kind, start, stop in find(changed):
            for edits in reversed(maps):
                start, stop = edits.back(start, False), edits.back(stop, True)
            at = bisect_right(held[kind], start, key=lambda s: s[0]) - 1
            if at < 0 or held[kind][at][1] < stop:
                spans.append((kind, start, stop))
    order = lambda s: (KINDS.index(s[0]), *s[1:])
    return sorted(base, key=order), sorted(spans, key=order)


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id, base, spans`` of every row of ``docs(doc_id, text)``."""
    named = lambda spans: [dict(zip(("kind", "start", "stop"), s)) for s in spans]

    def columns(batch):
        both = [scan_text(t.as_py()) for t in batch["text"]]
        return [batch["doc_id"], [named(b) for b, _ in both], [named(s) for _, s in both]]

    return map_batches(docs.select(F.col("doc_id").cast("long"), "text"), SPANS, columns)


def report(scanned: DataFrame) -> DataFrame:
    listed = lambda c: f"array_join(transform({c}, s -> concat_ws(':', s.kind, s.start, s.stop)), ',')"
    counts = [F.expr(f"cast(size(filter(base, s -> s.kind = '{k}')) as long)").alias(f"n_{k}") for k in KINDS]
    return scanned.select("doc_id", *counts, F.expr(f"sha2({listed('base')}, 256)").alias("base_sha256"), F.expr(listed("spans")).alias("spans"))
