"""The same results in SQL, for the operators that SQL can express. Brute force throughout."""

from __future__ import annotations

import string

from marquee.llm import divergence, negatives, pii, quality, secrets

_SPACE = r"[\x20\x09-\x0D]+"
_WORDS = f"list_filter(string_split_regex(coalesce(text, ''), '{_SPACE}'), lambda x: x <> '')"

JACCARD = f"""
    with recursive w as (select doc_id, {_WORDS} as words from documents),
        s as (select doc_id, unnest(case when len(words) >= 5 then list_distinct(list_transform(range(1, len(words) - 3),
                lambda i: array_to_string(words[i:i + 4], ' '))) when len(words) > 0 then [array_to_string(words, ' ')] end) as g
            from w),
        n as (select doc_id, count(*) as n from s group by 1),
        p as (select a.doc_id as x, b.doc_id as y, count(*) as c from s a join s b using (g) where a.doc_id < b.doc_id group by 1, 2),
        l as (select x, y, c = a.n and c = b.n as same from p join n a on a.doc_id = x join n b on b.doc_id = y
            where 5 * c >= 4 * (a.n + b.n - c)),
        e as (select x, y, same from l union all select y, x, same from l),
        reach as (select doc_id, doc_id as r from documents
            union select e.y, reach.r from reach join e on e.x = reach.doc_id)
    select doc_id, min(r) as class_id,
        least(doc_id, (select min(y) from e where e.x = doc_id and same)) as copy_id,
        (select count(*) from e where e.x = doc_id) as n_links
    from reach group by doc_id
"""


def _span_cte(name: str, kind: str, order: int, pattern: str, group: int, keep: str, source: str = "t") -> str:
    """Matches of a pattern in a text column, with their places and what ``group`` caught."""
    return f"""
        {name}_l as (select doc_id, regexp_extract_all(text, '{pattern}') as hits,
                string_split_regex(text, '{pattern}') as gaps, regexp_extract_all(text, '{pattern}', {group}) as caught from {source}),
        {name}_u as (select doc_id, unnest(hits) as hit, unnest(gaps[1:len(hits)]) as gap, unnest(caught) as caught,
                generate_subscripts(hits, 1) as i from {name}_l),
        {name}_p as (select *, sum(length(gap) + length(hit)) over (partition by doc_id order by i) as ends from {name}_u),
        {name} as (select doc_id, (ends - length(hit))::bigint as a, {order} as o, '{kind}' as kind, ends::bigint as b, hit
            from {name}_p where {keep})"""


_LIST = "coalesce(string_agg(kind || ':' || a || ':' || b, ',' order by a, o, b), '')"

_ASSIGN = (
    r"((?i:password|passwd|secret|token|api_?key))[\x22\x27]?\x20*[:=]\x20*[\x22\x27]?([A-Za-z0-9+/_.=-]+)"
)


def _secrets() -> str:
    plain = lambda p: p.replace("*+", "*").replace("++", "+")  # noqa: E731  SQL's patterns never give back
    allowed = " or ".join(f"regexp_matches(part, '{plain(p)}')" for p in secrets.ALLOWED)
    signs = string.ascii_letters + string.digits + "+/_=-"
    quiet = "|".join([secrets.QUIET, *(f"[{c}]{{8,}}" for c in signs)])
    chosen = " ".join(
        f"when regexp_matches(part, '{test}') then {i}" for i, (_, test, _, _) in enumerate(secrets.CLASSES) if test
    )
    last = len(secrets.CLASSES) - 1
    names = " ".join(f"when {i} then '{n}'" for i, (n, _, _, _) in enumerate(secrets.CLASSES))
    least = " ".join(f"when {i} then {v}" for i, (_, _, _, v) in enumerate(secrets.CLASSES))
    width = secrets.WINDOW
    return f"""
    with t as (select doc_id, coalesce(text, '') as text from documents),
        {_span_cte("assign", "assign", 0, _ASSIGN, 2, "length(caught) >= 6")},
        {_span_cte("access", "access", 1, "AKIA[A-Z0-9]+", 0, "length(hit) >= 20")},
        {_span_cte("hex", "hex", 2, "[0-9a-f]+", 0, "length(hit) >= 24")},
        {_span_cte("runs", "", 0, "[A-Za-z0-9+/_=-]+", 0, f"length(hit) >= {width}")},
        cuts as (select doc_id, a, string_split_regex(hit, '{quiet}') as gaps,
                [length(x) for x in regexp_extract_all(hit, '{quiet}')] as sizes from runs),
        each as (select doc_id, a, gaps, sizes, unnest(gaps) as part, generate_subscripts(gaps, 1) as i from cuts),
        parts as (select doc_id, part, a + coalesce(list_sum([length(x) for x in gaps[1:i - 1]]), 0)
                    + coalesce(list_sum(sizes[1:i - 1]), 0) as a from each),
        cand as (select doc_id, a, part, case {chosen} else {last} end as class from parts
            where length(part) >= {width} and not ({allowed})),
        win as (select doc_id, a, part, class, unnest(range(0, length(part) - {width - 1})) as i from cand),
        ch as (select doc_id, a, class, i, unnest(string_split(substr(part, i::integer + 1, {width}), '')) as c from win),
        n as (select doc_id, a, class, i, c, count(*) as n from ch group by all),
        h as (select doc_id, a, class, i, -sum(n / {width}.0 * log2(n / {width}.0)) as bits from n group by all),
        high as (select doc_id, a + min(i) as a, 3 + class as o, case class {names} end as kind, a + max(i) + {width} as b, '' as hit
            from h where bits >= (case class {least} end) - 1e-12 group by doc_id, h.a, class),
        base as (select * from assign union all select * from access union all select * from hex),
        every as (select * from base union all select * from high),
        d1 as (select doc_id, {_LIST} as s, count(*) filter (kind = 'assign') as n_assign, count(*) filter (kind = 'access') as n_access,
                count(*) filter (kind = 'hex') as n_hex from base group by 1),
        d2 as (select doc_id, {_LIST} as s from every group by 1)
    select t.doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
        sha256(coalesce(d1.s, '')) as base_sha256, coalesce(d2.s, '') as spans
    from t left join d1 using (doc_id) left join d2 using (doc_id)
    """


def _quality() -> str:
    names = list(quality.LEAST_SPREAD)
    levels = {"own": "lang, source", "per_lang": "lang", "overall": ""}
    groups = []
    for level, keys in levels.items():
        cols = ", ".join(
            f"quantile_disc({n}, 0.25) as {n}_low, quantile_disc({n}, 0.75) as {n}_high" for n in names
        )
        lead, by = (f"{keys}, ", f" group by {keys}") if keys else ("", "")
        groups.append(f"{level} as (select {lead}count(*) as rows, {cols} from r{by})")

    def of(column: str) -> str:
        return (
            f"case when own.rows >= {quality.MIN_GROUP} then own.{column} "
            f"when per_lang.rows >= {quality.MIN_GROUP} then per_lang.{column} else overall.{column} end"
        )

    out = []
    for n, least in quality.LEAST_SPREAD.items():
        spread = f"{quality.REACH} * greatest({of(n + '_high')} - {of(n + '_low')}, {least})"
        out.append(f"r.{n} > {of(n + '_high')} + {spread}")
        if n in quality.TWO_SIDED:
            out.append(f"r.{n} < {of(n + '_low')} - {spread}")
    return f"""
    with w as (select doc_id, lang, source, coalesce(text, '') as text, {_WORDS} as words,
            list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as lines from documents),
        win as (select doc_id, i, array_to_string(words[i:i + 7], ' ') as x from (
            select doc_id, words, unnest(range(1, len(words) - 6)) as i from w)),
        twice as (select doc_id, i from (select *, count(*) over (partition by doc_id, x) as n from win) where n > 1),
        cover as (select doc_id, count(distinct i + k) as n_repeat_words from twice, range(0, 8) as q(k) group by 1),
        c as (select doc_id, lang, source, len(words)::bigint as n_words, length(array_to_string(words, ''))::bigint as word_chars,
            (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
            (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines, len(lines) as n_lines,
            coalesce(n_repeat_words, 0) as n_repeat_words from w left join cover using (doc_id)),
        r as (select *, n_symbols / greatest(n_words, 1) as symbols, word_chars / greatest(n_words, 1) as word_length,
            n_dup_lines / greatest(n_lines, 1) as dup_lines, n_repeat_words / greatest(n_words, 1) as repeats,
            n_words < {quality.MIN_WORDS} or 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words as base_failed from c),
        {", ".join(groups)}
    select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
        not base_failed and not ({" or ".join(out)}) as kept
    from r join own on r.lang is not distinct from own.lang and r.source is not distinct from own.source
        join per_lang on r.lang is not distinct from per_lang.lang, overall
    """


_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"


def _private() -> str:
    digits = "regexp_replace(hit, '[^0-9]', '', 'g')"
    luhn = (
        f"list_sum(list_transform(range(0, length({digits})), lambda i: "
        f"case when i % 2 = 0 then substr({digits}, length({digits}) - i::integer, 1)::integer "
        f"when substr({digits}, length({digits}) - i::integer, 1)::integer > 4 "
        f"then 2 * substr({digits}, length({digits}) - i::integer, 1)::integer - 9 "
        f"else 2 * substr({digits}, length({digits}) - i::integer, 1)::integer end)) % 10 = 0"
    )
    parts = "list_max(list_transform(string_split(hit, '.'), lambda p: try_cast(p as double))) <= 255"
    term = r"\p{L}[\p{L}\p{N}\x27-]{2,}"
    reach = pii.REACH
    return f"""
    with d as (select doc_id, coalesce(text, '') as text from documents),
        t as (select row_number() over () as doc_id, text from (select distinct text from d)),
        {_span_cte("email", "email", 0, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", 0, "true")},
        {_span_cte("ip", "ip", 1, r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)", 0, parts)},
        {_span_cte("card", "card", 2, r"[0-9](?:[\x20-]?[0-9])+", 0, f"length({digits}) between 14 and 19 and {luhn}")},
        {_span_cte("phone", "phone", 3, _PHONE, 0, f"length({digits}) between 10 and 15")},
        base as (select * from email union all select * from ip union all select * from card union all select * from phone),
        sides as (select doc_id, lower(hit) as entity, substr(text, greatest(a - {reach}, 0) + 1, least(a, {reach})) as before,
                substr(text, b + 1, {reach}) as after, greatest(a - {reach}, 0) as from_, b as to_ from base join t using (doc_id)),
        windows as (select row_number() over () as doc_id, doc_id as doc, entity, before, after, before as text, from_ as shift, true as is_before from sides
            union all select -row_number() over (), doc_id, entity, before, after, after, to_, false from sides),
        {_span_cte("beside", "beside", 0, term, 0, "true", "windows")},
        terms as (select distinct doc, entity, before || chr(0) || after as context, lower(hit) as term, shift + a as a, shift + b as b
            from beside join windows using (doc_id) where case when is_before then a > 0 or shift = 0 else b < {reach} end),
        {_span_cte("word", "word", 0, term, 0, "true")},
        nw as (select lower(hit) as term, count(distinct doc_id) as n_word from word group by 1),
        ne as (select entity, count(distinct doc) as n_entity from terms group by 1),
        nb as (select entity, term, count(distinct doc) as n_both from terms group by 1, 2 having count(distinct context) >= {pii.SUPPORT}),
        total as (select count(*) as n from t),
        told as (select term, max(case when n > n_entity then
                log2(n_both * n / (greatest(coalesce(n_word, 0), n_both) * n_entity)) / log2(n / n_entity) end) as share
            from nb join ne using (entity) left join nw using (term), total group by 1),
        levels as (select term, share >= {pii.REMOVED} as gone from told where share >= {pii.GENERALISED}),
        places as (select doc_id, a, b, gone from word join levels on term = lower(hit)
            union select doc, a, b, gone from terms join levels using (term)),
        added as (select doc_id, a, case when gone then 5 else 4 end as o, case when gone then 'removed' else 'general' end as kind, b from places),
        every as (select doc_id, a, o, kind, b from base union all select * from added),
        d1 as (select doc_id, {_LIST} as s, {", ".join(f"count(*) filter (kind = '{k.name}') as n_{k.name}" for k in pii.BASE)}
            from base group by 1),
        d2 as (select doc_id, {_LIST} as s from every group by 1)
    select d.doc_id, {", ".join(f"coalesce(n_{k.name}, 0) as n_{k.name}" for k in pii.BASE)},
        sha256(coalesce(d1.s, '')) as base_sha256, coalesce(d2.s, '') as spans
    from d join t using (text) left join d1 on d1.doc_id = t.doc_id left join d2 on d2.doc_id = t.doc_id
    """


_GAP = "({0} - {1}) * ({0} - {1}) // {1}"

DIVERGENCE = f"""
    with d as (select row_number() over () as id, coalesce(lang, '') as lang, coalesce(source, '') as source,
            regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'),
                '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as terms from documents),
        t as (select id, lang, source, unnest(terms) as term from d),
        kept as (select lang, term, count(*) as n from t group by 1, 2 having count(distinct id) >= {divergence.MIN_DOCS}),
        v as (select lang, count(*) as v, sum(n) as total from kept group by 1),
        g as (select distinct lang, source from d),
        c as (select lang, source, term, count(*) as n from t semi join kept using (lang, term) group by 1, 2, 3),
        total as (select lang, source, coalesce(sum(n), 0) as total from g left join c using (lang, source) group by 1, 2),
        p as (select total.lang, total.source, kept.term, coalesce(c.n, 0) as n,
                1 + {divergence.UNIT}::hugeint * (coalesce(c.n, 0) + 1) // (total.total + v) as p,
                1 + {divergence.UNIT}::hugeint * (kept.n + 1) // (v.total + v) as q
            from total join v using (lang) join kept using (lang) left join c using (lang, source, term)),
        every as (select a.lang, a.source, 'pair' as part, b.source as item, coalesce(sum({_GAP.format("x.p", "y.p")}), 0) as value
            from g a join g b on a.lang = b.lang and a.source <> b.source
                left join p x on x.lang = a.lang and x.source = a.source
                left join p y on y.lang = b.lang and y.source = b.source and y.term = x.term
            group by all
            union all select lang, source, 'term', term, {_GAP.format("p", "q")} from p where n > 0 and p > q)
    select lang, source, part, item, value::bigint as value,
        row_number() over (partition by lang, source, part order by value desc, item) as rank
    from every qualify part = 'pair' or rank <= {divergence.TOP_TERMS}
"""

NEGATIVES = f"""
    with v as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
            list_transform(embedding, lambda x: floor({negatives.FACTOR} * x::double)::bigint) as q from embeddings
            where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        s as (select a.vec_id as anchor_id, v.vec_id, a.label = v.label as same,
                list_sum(list_transform(range(1, len(v.q) + 1), lambda i: a.q[i] * v.q[i]))::bigint as score
            from v a join v on a.vec_id <> v.vec_id where a.vec_id % 100 = 0),
        pos as (select anchor_id, vec_id as positive_id, score as positive_score from s where same
            qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= {negatives.POSITIVES})
    select anchor_id, positive_id, row_number() over (partition by anchor_id, positive_id order by score desc, vec_id) as rank,
        vec_id as negative_id, positive_score, score as negative_score
    from pos join s using (anchor_id)
    where not same and {10 * negatives.EASIEST} * positive_score <= 100 * score and 100 * score <= {10 * negatives.HARDEST} * positive_score
    qualify rank <= {negatives.NEGATIVES}
"""

SECRETS = _secrets()
QUALITY = _quality()
PRIVATE = _private()
