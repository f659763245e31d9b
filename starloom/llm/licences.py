"""Licence scans by the Dice coefficient over word bigrams, in DataFrame operations alone.

Texts are normalised (lower case, letters and digits only), and every window as long as a notice
is compared with it: ``2 * |A & B| / (|A| + |B|) >= t`` on their sets of word bigrams. So a notice
is found wherever it stands, also wrapped over lines or inside a longer line.

Nothing is compared that cannot succeed: the coefficient needs ``|A| >= |B| * t / (2 - t)`` distinct
bigrams, and as many shared ones. So of any ``|B| - that + 1`` bigrams of a notice, a window must hold
one; the longest, which look rarest, are its anchors. Texts without the words of an anchor are passed over. Of the others, a notice is compared where one of its anchors is met, and
there only with the windows that hold as many of its bigrams as the size bound asks for.

The notices are a parameter, some dozens held as literals: sentences, headers of source files, whole short
licences, and the openings of long ones, by which a whole long licence is found too.

A null text has no words. A document's licence is the notice of highest score, ties by the longer notice,
then by name and place. Repeated rows are scanned each for itself; other columns are ignored; an empty table gives none.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.licence_texts import NOTICES

LEAST = 0.8


def words_of(text: str) -> list[str]:
    return re.sub(r"[^a-z0-9]+", " ", text.lower()).split()


class Notice:
    """The words of a notice, its set of bigrams, and the anchors of which a window needs one."""

    def __init__(self, name: str, text: str, least: float):
        words = words_of(text)
        self.name, self.length = name, len(words) - 1
        self.grams = sorted({f"{a} {b}" for a, b in zip(words, words[1:])})
        self.fewest = max(1, math.ceil(len(self.grams) * least / (2 - least) - 1e-9))
        rare = sorted(self.grams, key=lambda g: (-len(g), g))
        self.anchors = rare[: len(self.grams) - self.fewest + 1]


def _held(words: Column, anchors: list[str]) -> Column:
    """Whether both words of an anchor are among ``words``. The longer ones are looked for first, each once."""
    partners = defaultdict(set)
    for anchor in anchors:
        short, long = sorted(anchor.split(), key=lambda w: (len(w), w))
        partners[long].add(short)
    holds = lambda word: F.array_contains(words, word)
    return reduce(Column.__or__, (holds(w) & reduce(Column.__or__, map(holds, sorted(p))) for w, p in sorted(partners.items())))


def _words_array(values: list[str]) -> Column:
    """A literal array; ``values`` hold letters, digits and spaces alone."""
    return F.expr(f"array({', '.join(f"'{v}'" for v in values)})")


def _starts(grams: Column, own: Column, notice: Notice) -> Column:
    """Where the windows begin that hold as many places of ``own`` as the notice needs."""
    last = F.greatest(F.size(grams) - notice.length, F.lit(0))

    def around(first: Column, i: Column) -> Column:
        far = F.get(own, i + (notice.fewest - 1))
        return F.when(far - first < notice.length, F.sequence(F.greatest(far - (notice.length - 1), F.lit(0)), F.least(first, last)))

    return F.array_distinct(F.flatten(F.array_compact(F.transform(own, around))))


def _hits(grams: Column, places: Column, notice: Notice, least: float) -> Column:
    """The windows of ``grams`` like the notice, if an anchor of it is among ``places``, where anchors of any notice are."""
    near = F.exists(places, lambda a: F.array_contains(_words_array(notice.anchors), F.get(grams, a)))
    starts = F.transform(F.array(_places(grams, notice.grams)), lambda own: _starts(grams, own, notice))[0]
    starts = F.when(near, starts).otherwise(F.expr("cast(array() as array<int>)"))

    def scored(start: Column) -> Column:
        window = F.slice(grams, start + 1, notice.length)
        shared = F.size(F.array_intersect(window, _words_array(notice.grams)))
        dice = 2.0 * shared / (F.size(F.array_distinct(window)) + len(notice.grams))
        return F.when((shared >= notice.fewest) & (dice >= least), F.struct((-dice).alias("minus"), F.lit(-notice.length).alias("shorter"), F.lit(notice.name).alias("licence"), start.alias("start")))

    return F.array_compact(F.transform(starts, scored))


def scan(docs: DataFrame, notices: dict[str, str] = NOTICES, least: float = LEAST) -> DataFrame:
    """``doc_id, licence, score, words, licences``: per row the best notice, the words it was found in
    and all notices found, by name."""
    known = [Notice(name, text, least) for name, text in sorted(notices.items())]
    if any(n.length < 1 for n in known):
        raise ValueError("a notice needs two words")
    anchors = sorted(set().union(*(n.anchors for n in known)))
    # An array of one is bound to a lambda's variable, which is computed once per row.
    once = lambda made, then: F.transform(F.array(made), then)[0]

    def of_words(words: Column) -> Column:
        grams = F.zip_with(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, 2, F.size(words)), lambda a, b: F.concat_ws(" ", a, b))
        return once(grams, lambda g: once(_places(g, anchors), lambda p: F.when(F.size(p) > 0, found(words, g, p))))

    def found(words: Column, grams: Column, places: Column) -> Column:
        return once(F.concat(*(_hits(grams, places, n, least) for n in known)), lambda hits: summary(words, hits))

    def summary(words: Column, hits: Column) -> Column:
        best = F.array_min(hits)
        part = F.array_join(F.slice(words, best["start"] + 1, 1 - best["shorter"]), " ")
        names = F.array_join(F.array_sort(F.array_distinct(F.transform(hits, lambda h: h["licence"]))), ",")
        return F.when(F.size(hits) > 0, F.struct(best["licence"].alias("licence"), (-best["minus"]).alias("score"), part.alias("words"), names.alias("licences")))

    words = F.filter(F.split(F.regexp_replace(F.lower("text"), "[^a-z0-9]+", " "), " "), lambda w: w != "")
    looked_for = _words_array(sorted({w for a in anchors for w in a.split()}))
    scanned = once(words, lambda ws: once(F.array_intersect(ws, looked_for), lambda met: F.when(_held(met, anchors), of_words(ws))))
    result = docs.select("doc_id", scanned.alias("r"))
    return result.select("doc_id", *(F.col(f"r.{c}").alias(c) for c in ("licence", "score", "words", "licences")))


def _places(grams: Column, known: list[str]) -> Column:
    return F.array_compact(F.transform(grams, lambda g, i: F.when(g.isin(known), i)))
