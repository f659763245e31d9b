"""The native operators in plain DuckDB SQL: every pattern, window and prefix sum over everything."""

from __future__ import annotations

from starloom.llm.common import WORD
from starloom.llm.licences import LEAST, NOTICES, words_of
from starloom.llm.lines import MIN_CHARS, MIN_DOCS
from starloom.llm.mixing import MAX_EPOCHS, WEIGHTS
from starloom.llm.secret_rules import RULES


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def secrets_sql() -> str:
    parts = []
    for place, rule in enumerate(RULES):
        pattern = _text(rule.pattern)
        parts.append(f"""
            select n, {place} as place, '{rule.kind}' as kind, {rule.least} as least,
                generate_subscripts(regexp_extract_all(t, {pattern}), 1) as i,
                unnest(regexp_extract_all(t, {pattern})) as hit,
                unnest(regexp_extract_all(t, {pattern}, {rule.group})) as part,
                unnest(string_split_regex(t, {pattern})[:len(regexp_extract_all(t, {pattern}))]) as gap
            from texts where regexp_matches(t, {pattern})""")
    base = ", ".join(_text(r.kind) for r in RULES if r.base)
    listed = "string_agg(kind || ':' || start || ':' || stop, ',' order by start, place)"
    counts = ", ".join(f"count(*) filter (kind = '{r.kind}') as n_{r.kind}" for r in RULES if r.base)
    return f"""
        with texts as (select row_number() over () as n, doc_id, coalesce(text, '') as t from documents),
        hits as ({" union all ".join(parts)}),
        ends as (select *, sum(length(gap) + length(hit)) over (partition by n, place order by i) as stop from hits),
        spans as (select n, place, kind, stop - length(hit) as start, stop from ends where length(part) >= least)
        select any_value(doc_id) as doc_id, {counts},
            sha256(coalesce(string_agg(kind || ':' || start || ':' || stop, ',' order by start, place) filter (kind in ({base})), '')) as base_sha256,
            coalesce({listed}, '') as spans
        from texts left join spans using (n) group by n"""


def licences_sql() -> str:
    rows = []
    for name, text in NOTICES.items():
        words = words_of(text)
        rows.append(f"({_text(name)}, {len(words) - 1}, {sorted({f'{a} {b}' for a, b in zip(words, words[1:])})})")
    return f"""
        with notices(licence, length, own) as (values {", ".join(rows)}),
        texts as (
            select row_number() over () as n, doc_id,
                [w for w in string_split_regex(lower(coalesce(text, '')), '[^a-z0-9]+') if w <> ''] as words
            from documents),
        pairs as (select n, words, [words[i] || ' ' || words[i + 1] for i in range(1, len(words))] as grams from texts),
        places as (select n, unnest(grams) as gram, generate_subscripts(grams, 1) as place from pairs),
        owned as (select licence, length, len(own) as size, unnest(own) as gram from notices),
        met as (
            select n, licence, length, size, gram,
                unnest(range(greatest(0, place - length), least(place - 1, greatest(0, len(grams) - length)) + 1)) as start
            from places join owned using (gram) join pairs using (n)),
        shared as (select n, licence, length, size, start, count(distinct gram) as common from met group by all),
        scored as (
            select n, licence, length, start, 2.0::double * common / (len(list_distinct(grams[start + 1 : start + length])) + size) as score,
                array_to_string(words[start + 1 : start + length + 1], ' ') as words
            from shared join pairs using (n)),
        hits as (select * from scored where score >= {LEAST}),
        best as (
            select n, arg_min(struct_pack(licence, score, words), struct_pack(a := -score, b := -length, c := licence, d := start)) as r,
                string_agg(distinct licence, ',' order by licence) as licences
            from hits group by n)
        select doc_id, r.licence as licence, r.score as score, r.words as words, licences from texts left join best using (n)"""


def mixing_sql() -> str:
    weight = f"{list(WEIGHTS)}[(row_number() over (order by source nulls last) - 1) % {len(WEIGHTS)} + 1]::double"
    return f"""
        with sizes as (
            select row_number() over () as n, doc_id, source, text,
                coalesce(len(regexp_extract_all(text, {_text(WORD)})), 0)::bigint as size from documents),
        keys as (
            select n, doc_id, source, size,
                -ln((('0x' || substr(md5(coalesce(doc_id::varchar, '')), 1, 13))::bigint + 0.5::double) / 4503599627370496::double)
                    / (1::double / (1 + 4::double * coalesce(len(regexp_extract_all(text, '[#*$%&|<>]')), 0) / greatest(size, 1))) as key
            from sizes),
        sums as (
            select source, sum(size)::bigint as source_size, {weight} as weight, sum(size)::double * {MAX_EPOCHS} as cap
            from keys group by source),
        levels as (
            select *, (sum(source_size) over ()::double - coalesce(sum(cap) over before, 0)) / (sum(weight) over () - coalesce(sum(weight) over before, 0)) as level
            from sums window before as (order by cap / weight, source nulls last rows between unbounded preceding and 1 preceding)),
        goals as (
            select source, source_size, least(cap, coalesce(
                (select arg_min(level, cap / weight) from levels where level <= cap / weight) * weight, cap)) as target
            from levels),
        ordered as (
            select n, doc_id, size, source_size, target,
                case when source_size > 0 then floor(target / source_size) else 0 end as epochs,
                coalesce(sum(size) over (partition by k.source order by key, doc_id, size rows between unbounded preceding and 1 preceding), 0) as before
            from keys k join goals g on k.source is not distinct from g.source)
        select doc_id, size, source_size, target,
            (size * (epochs + case when epochs < {MAX_EPOCHS} and before + size / 2::double <= target - epochs * source_size then 1 else 0 end))::bigint as taken
        from ordered"""


def trie_sql() -> str:
    """Every prefix of every rebuilt conversation, as the joined hashes of its turns."""
    bit = "lambda c, j: case when c & 1 = 1 then xor(c >> 1, 3988292384::bigint) else c >> 1 end"
    byte = f"lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0]::bigint[], {bit})"
    digits = "list_transform(string_split(conv_id::varchar, ''), lambda x: ascii(x)::bigint)"
    crc = f"xor(list_reduce(list_concat([4294967295::bigint], {digits}), {byte}), 4294967295::bigint)"
    return f"""
        with turns as (
            select conv_id, md5(md5(coalesce(role, '')) || md5(coalesce(text, ''))) as hash,
                coalesce(len(regexp_extract_all(text, {_text(WORD)})), 0)::bigint as words,
                row_number() over (partition by conv_id order by turn nulls first, hash) - 1 as i
            from conversations where conv_id is not null),
        ids as (select conv_id as c, conv_id - conv_id % 20 as head, {crc} % 4 as h, count(*) as n from turns group by conv_id),
        own as (
            select c, i, hash, words from ids join turns t on t.conv_id = head and i < h
            union all
            select c, i + 1000000, hash, words from ids join turns t on t.conv_id = c and i >= h),
        placed as (
            select c, hash, words, row_number() over w as d, string_agg(hash, '') over w as path
            from own window w as (partition by c order by i rows unbounded preceding)),
        points as (
            select c, d, path, words from placed union all select c, 0, '', 0 from ids),
        lengths as (select c, max(d) as d from points group by c),
        ends as (
            select path, sha256(string_agg(c::varchar, ',' order by c)) as digest
            from points join lengths using (c, d) group by path),
        nodes as (
            select path, any_value(d) as depth, min(c) as conv_id, count(*) as n_convs, any_value(words) as words,
                (count(*) - 1) * any_value(words) as saved
            from points group by path),
        linked as (select *, case when depth > 0 then left(path, (depth - 1) * 32) end as parent from nodes),
        children as (select parent as path, count(*) as n from linked where depth > 0 group by parent),
        leaves as (select path, depth, saved, n is null as leaf from linked left join children using (path)),
        above as (
            select left(path, k * 32) as path, sum(saved) as saved, count(*) filter (leaf) as leaves
            from (select path, saved, leaf, unnest(range(depth + 1)) as k from leaves) group by 1)
        select l.conv_id, l.depth::bigint as depth, p.conv_id as parent_conv_id, l.n_convs::bigint as n_convs, coalesce(c.n, 0)::bigint as n_children,
            a.leaves::bigint as n_leaves, a.saved::bigint as saved_tokens, coalesce(e.digest, sha256('')) as ends_sha256
        from linked l join above a using (path) left join nodes p on p.path = l.parent
            left join children c on c.path = l.path left join ends e on e.path = l.path"""


def lines_sql() -> str:
    blanks = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
        with texts as (select row_number() over () as n, doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents),
        split as (
            select n, doc_id, unnest(lines) as line, generate_subscripts(lines, 1) as i from texts),
        keyed as (select *, translate(trim(line, {blanks}), '{letters}', '{letters.lower()}') as key from split),
        common as (
            select key, max(doc_id) as holder from keyed where length(key) >= {MIN_CHARS}
            group by key having count(distinct doc_id) + max((doc_id is null)::int) >= {MIN_DOCS}),
        judged as (
            select n, i, line, holder is not null and doc_id is distinct from holder as dropped
            from keyed left join common using (key))
        select doc_id, len(lines)::bigint as n_lines, coalesce(n_dropped, 0)::bigint as n_dropped, sha256(coalesce(kept, '')) as kept_sha256
        from texts left join (
            select n, count(*) filter (dropped) as n_dropped, string_agg(line, chr(10) order by i) filter (not dropped) as kept
            from judged group by n) using (n)"""


SQL = {"op12_trie": trie_sql(), "op13_lines": lines_sql(), "op2_secrets": secrets_sql(), "op5_licences": licences_sql(), "op8_mixing": mixing_sql()}
