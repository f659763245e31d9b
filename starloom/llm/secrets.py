"""Secret scans over a trigram inverted index, in DataFrame operations alone.

Each rule's regular expression yields a Boolean query of the trigrams every match must hold.
The postings of these trigrams (lower-cased text) are shuffled to their documents, where the
query intersects and unites them; documents that satisfy a rule's query are verified by the
expression itself. Rules without a mandatory trigram scan every text.

Spans are code points, end exclusive. A null text counts as empty. Equal rows (id and text) have
equal results, each its own row; null ids are fine; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.secret_rules import RULES, Rule, trigram_query, trigrams

NO_SPANS = "cast(array() as array<struct<start:int,place:int,kind:string,stop:int>>)"


def _holds(query, found: str) -> Column:
    """The query over the array of a document's trigrams."""
    if isinstance(query, str):
        return F.array_contains(found, query)
    joined = [_holds(q, found) for q in query[1]]
    result = joined[0]
    for c in joined[1:]:
        result = result & c if query[0] == "and" else result | c
    return result


def _quoted(text: str) -> str:
    return "r'" + text + "'" if "'" not in text else 'r"' + text.replace('"', "\\x22") + '"'


# Lists are built in blocks: appending to one list copies it every time.
BLOCK = 256


def _let(name: str, value: str, result: str) -> str:
    """SQL: ``result``, in which ``name`` stands for ``value``, evaluated once."""
    return f"element_at(transform(array({value}), {name} -> {result}), 1)"


def _blocks(items: str, n: str = "n") -> str:
    return f"transform(sequence(0, greatest(size({items}) - 1, 0) div {BLOCK}), {n} -> slice({items}, {n} * {BLOCK} + 1, {BLOCK}))"


def _folded(items: str, empty: str, step: str) -> str:
    """SQL: a struct of ``at`` and ``done``, a list of lists, from the items in order. ``step`` makes the next struct of ``at``
    and ``part`` (a list) from ``acc`` and ``x``."""
    inner = f"aggregate(block, named_struct('at', whole.at, 'part', {empty}), (acc, x) -> {step})"
    joined = _let("one", inner, "named_struct('at', one.at, 'done', concat(whole.done, array(one.part)))")
    return f"aggregate({_blocks(items)}, named_struct('at', 0, 'done', array({empty})), (whole, block) -> {joined})"


def rule_spans(place: int, rule: Rule, text: str = "text") -> str:
    """SQL: the rule's spans in ``text`` as structs. What lies between the matches is as long as
    ``split`` says, so running sums of lengths give the offsets."""
    pattern = _quoted(rule.pattern)
    matches = f"regexp_extract_all({text}, {pattern}, 0)"
    group = f"regexp_extract_all({text}, {pattern}, {rule.group})" if rule.least else matches
    zipped = f"arrays_zip({matches}, slice(split({text}, {pattern}, -1), 1, size({matches})), {group})"
    pairs = f"cast({zipped} as array<struct<hit:string,gap:string,part:string>>)"
    lengths = f"transform({pairs}, p -> named_struct('gap', length(p.gap), 'hit', length(p.hit), 'counts', length(p.part) >= {rule.least}))"
    added = f"named_struct('start', acc.at + x.gap, 'place', {place}, 'kind', '{rule.kind}', 'stop', acc.at + x.gap + x.hit)"
    step = f"named_struct('at', acc.at + x.gap + x.hit, 'part', if(x.counts, concat(acc.part, array({added})), acc.part))"
    spans = _let("found", lengths, f"flatten({_folded('found', NO_SPANS, step)}.done)")
    return f"if({text} rlike {pattern}, {spans}, {NO_SPANS})"


def _keyed(docs: DataFrame, keep: list[str]) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    other = F.struct("doc_id", *keep).alias("row")
    return docs.select("doc_id", text.alias("text"), other).withColumn("key", F.xxhash64("doc_id", "text")).withColumn("size", F.length("text"))


def postings(docs: DataFrame, grams: list[str]) -> DataFrame:
    """``gram, key, size``: the inverted index of the trigrams that rules ask for."""
    present = F.array_compact(F.array(*(F.when(F.contains("lowered", F.lit(g)), F.lit(g)) for g in grams)))
    lowered = docs.select("key", "size", F.lower("text").alias("lowered"))
    return lowered.select("key", "size", F.explode(present).alias("gram"))


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, keep: list[str] | None = None) -> DataFrame:
    """``doc_id, text, spans`` and the columns of ``keep`` for every row; spans are sorted by start,
    then by the rules' order."""
    rows = _keyed(docs, keep or [])
    queries = [trigram_query(r.pattern) for r in rules]
    full = [rule_spans(i, r) for i, r in enumerate(rules) if queries[i] is None]
    grams = sorted(set().union(*map(trigrams, queries)))
    rows = rows.withColumn("scanned", F.expr(f"concat({', '.join([NO_SPANS, *full])})"))
    if grams:
        met = postings(rows, grams).groupBy("key", "size").agg(F.collect_set("gram").alias("found"))
        asked = F.array_compact(F.array(*(F.when(_holds(q, "found"), i) for i, q in enumerate(queries) if q is not None)))
        wanted = met.select("key", "size", asked.alias("asked")).filter("size(asked) > 0")
        rows = rows.join(wanted, ["key", "size"], "left")
        checked = [f"if(array_contains(asked, {i}), {rule_spans(i, r)}, {NO_SPANS})" for i, r in enumerate(rules) if queries[i] is not None]
        verified = F.expr(f"if(asked is null, {NO_SPANS}, concat({', '.join(checked)}))")
    else:
        verified = F.expr(NO_SPANS)
    return rows.select("row.*", "text", F.array_sort(F.concat("scanned", verified)).alias("spans"))


def listed(spans: str) -> str:
    return f"array_join(transform({spans}, s -> concat_ws(':', s.kind, s.start, s.stop)), ',')"


def report(scanned: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Counts by base kind, a digest of the base spans, and all spans as text."""
    base = [r.kind for r in rules if r.base]
    counts = [F.expr(f"cast(size(filter(spans, s -> s.kind = '{k}')) as long)").alias(f"n_{k}") for k in base]
    of_base = f"filter(spans, s -> s.kind in ({', '.join(map(repr, base))}))"
    return scanned.select("doc_id", *counts, F.expr(f"sha2({listed(of_base)}, 256)").alias("base_sha256"), F.expr(listed("spans")).alias("spans"))


# Code points of the pieces from which a masked text is cut, so that no cut counts from the start of the text.
PIECE = 4096


def _cut(start: str, stop: str) -> str:
    """SQL: the text from ``start`` to ``stop``, out of ``given.pieces``."""
    first, last = f"({start}) div {PIECE}", f"({stop}) div {PIECE}"
    within = f"substring(get(given.pieces, {first}), ({start}) % {PIECE} + 1, ({stop}) - ({start}))"
    between = f"array_join(slice(given.pieces, {first} + 2, {last} - {first} - 1), '')"
    across = f"concat(substring(get(given.pieces, {first}), ({start}) % {PIECE} + 1), {between}, coalesce(substring(get(given.pieces, {last}), 1, ({stop}) % {PIECE}), ''))"
    return f"if({start} >= {stop}, '', if({first} = {last}, {within}, {across}))"


def masked(text: str = "text", spans: str = "spans", mark: str = "[SECRET]") -> Column:
    """The text with every span replaced by ``mark``; spans that overlap are replaced once."""
    part = f"if(x.start >= acc.at, concat({_cut('acc.at', 'x.start')}, '{mark}'), '')"
    step = f"if(x.stop <= acc.at, acc, named_struct('at', x.stop, 'part', concat(acc.part, array({part}))))"
    folded = _folded("given.spans", "cast(array() as array<string>)", step)
    ended = _let("made", folded, f"concat(array_join(flatten(made.done), ''), {_cut('made.at', 'given.size')})")
    pieces = f"named_struct('pieces', regexp_extract_all({text}, r'(?s).{{1,{PIECE}}}', 0), 'spans', {spans}, 'size', length({text}))"
    return F.expr(f"if(size({spans}) = 0, {text}, {_let('given', pieces, ended)})")
