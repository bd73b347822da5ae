"""DuckDB SQL for the queries that SQL can express, written apart from the operators."""

from __future__ import annotations

# The vote conditions of op6, by hand: (good vote, poor vote).
_VOTES = [
    ("n_words >= 100", "n_words < 50"),
    ("word_chars between 3 * n_words and 10 * n_words", "word_chars < 2 * n_words or word_chars > 15 * n_words"),
    ("n_symbols * 100 <= n_words", "n_symbols * 10 > n_words"),
    ("false", "n_symbols * 2 > n_words"),
    ("n_dup_lines = 0", "n_dup_lines >= 3"),
    ("n_repeat_words * 100 <= n_words * 5", "n_repeat_words * 100 > n_words * 30"),
    ("n_shouted * 100 <= n_words * 5", "n_shouted * 100 > n_words * 20"),
    ("n_stutter <= 1", "n_stutter * 100 > n_words * 5"),
    ("false", "n_bangs * 100 > n_words * 5"),
    ("false", "n_cells * 100 > n_words * 5"),
]
_EM_ROUNDS = 10


def _rules_sql() -> str:
    """Counts, votes by pattern, ten rounds of expectation-maximisation in common table expressions, and the verdict."""
    word = r"[^\x20\x09-\x0D]+"
    rules = range(len(_VOTES))
    votes = ", ".join(f"case when {poor} then -1 when {good} then 1 else 0 end as v{i}" for i, (good, poor) in enumerate(_VOTES))
    names = ", ".join(f"v{i}" for i in rules)
    parts = [
        rf"""with source as (select row_number() over () as row_id, doc_id, coalesce(text, '') as text from documents),
        split as (select *, regexp_extract_all(text, '{word}') as words,
            list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{word}')) as lines from source),
        spots as (select row_id, pos, words[pos] || ' ' || words[pos + 1] || ' ' || words[pos + 2] as window3
            from split, unnest(range(1, len(words) - 1)) as u(pos)),
        twice as (select row_id, pos from (select *, count(*) over (partition by row_id, window3) as n from spots) where n > 1),
        covered as (select row_id, count(distinct pos + step) as n from twice, unnest([0, 1, 2]) as s(step) group by row_id),
        counted as materialized (select row_id, doc_id, len(words)::bigint as n_words,
            coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::bigint as word_chars,
            length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
            (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
            coalesce(covered.n, 0)::bigint as n_repeat_words,
            len(list_filter(words, lambda x: x = upper(x) and x <> lower(x) and length(x) > 1)) as n_shouted,
            len(list_filter(words, lambda x, i: i > 1 and x = words[i - 1])) as n_stutter,
            len(regexp_extract_all(text, '!!')) as n_bangs,
            (length(text) - length(replace(text, ' | ', ''))) // 3 as n_cells
            from split left join covered using (row_id)),
        voted as materialized (select *, {votes} from counted),
        patterns as materialized (select {names}, count(*) as n from voted group by all),
        q0 as materialized (select *, 1 / (1 + exp(-({" + ".join(f"v{i}" for i in rules)})::double)) as q from patterns)"""
    ]
    for turn in range(1, _EM_ROUNDS + 1):
        before = f"q{turn - 1}"
        sums = ["sum(n * q) as g", "sum(n * (1 - q)) as p"]
        for i in rules:
            for name, v in (("b", -1), ("z", 0), ("a", 1)):
                sums.append(f"coalesce(sum(n * q) filter (v{i} = {v}), 0) as g{i}{name}, coalesce(sum(n * (1 - q)) filter (v{i} = {v}), 0) as p{i}{name}")
        # Half of a vote's say is what it shows, half the belief that 95 in 100 votes are right.
        trusted = []
        for i in rules:
            trusted.append(f"(p{i}b + 0.95 * (g{i}b + p{i}b)) / 2 as p{i}bt, (g{i}a + 0.95 * (g{i}a + p{i}a)) / 2 as g{i}at")
        full = []
        for i in rules:
            full.append(f"g{i}b + p{i}b - p{i}bt as g{i}bt, g{i}a + p{i}a - g{i}at as p{i}at")
        logs = ["ln((g + 1) / (g + p + 2)) - ln(1 - (g + 1) / (g + p + 2)) as base"]
        for i in rules:
            good, poor = f"(g{i}bt + g{i}z + g{i}at + 3)", f"(p{i}bt + p{i}z + p{i}at + 3)"
            logs += [f"ln((g{i}{n} + 1) / {good}) - ln((p{i}{n} + 1) / {poor}) as l{i}{n[0]}" for n in ("bt", "z", "at")]
        weigh = " + ".join(f"case v{i} when -1 then l{i}b when 1 then l{i}a else l{i}z end" for i in rules)
        parts.append(f"s{turn} as materialized (select {', '.join(sums)} from {before})")
        parts.append(f"t{turn} as materialized (select *, {', '.join(trusted)} from s{turn})")
        parts.append(f"f{turn} as materialized (select *, {', '.join(full)} from t{turn})")
        parts.append(f"m{turn} as materialized (select {', '.join(logs)} from f{turn})")
        parts.append(f"q{turn} as materialized (select {names}, n, 1 / (1 + exp(-(base + {weigh}))) as q from patterns, m{turn})")
    same = " and ".join(f"voted.v{i} = e.v{i}" for i in rules)
    failed = "(n_words < 50 or 100 * n_repeat_words > 50 * n_words)"
    return (
        ",\n".join(parts)
        + f""" select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, {failed} as base_failed,
        (not {failed} and q >= 0.5) as kept, round(q, 6) as probability from voted join q{_EM_ROUNDS} e on {same}"""
    )


_LEAKS = r"""with words as (
    select 'd' as kind, doc_id as id, text, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') as w from documents
    union all select 'b', item_id, text, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') from benchmark),
items as (select distinct id, text, least(len(w), 5) as length, w from words where kind = 'b' and len(w) > 0),
windows as (select distinct words.kind, words.id, words.text, l.length, array_to_string(words.w[pos:pos + l.length - 1], ' ') as shingle
    from words, (select distinct length from items) l, unnest(range(1, len(words.w) - l.length + 2)) as u(pos)),
parts as (select b.id, b.text, b.length, b.shingle, count(*) over (partition by b.id, b.text) as n_shingles
    from windows b join items using (id, text, length) where b.kind = 'b')
select d.id as doc_id, p.id as item_id, count(*) as n_shared, p.n_shingles, round(count(*) / p.n_shingles, 6) as containment
from windows d join parts p using (length, shingle) where d.kind = 'd'
group by d.id, d.text, p.id, p.text, p.n_shingles having count(*) * 100 >= p.n_shingles * 80"""

_CHAT = r"""with given as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select -7, t, if(t = 0, 'user', 'assistant'), '\### Assistant: </turn> ok' from range(2) r(t)),
rows as (select *, case role when 'system' then 0 when 'user' then 1 when 'assistant' then 3 else 2 end as speaks from given)
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, speaks, role, text)) as turns_sha256,
    coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
    sha256(coalesce(string_agg(text, '' order by turn, speaks, role, text) filter (role = 'assistant'), '')) as loss_sha256,
    sum(4 + length(role) + 1 + length(replace(replace(replace(text, '\', '\\'), '</turn>', '<\/turn>'), '###', '\###')) + 8)::bigint as formatted_chars
from rows group by conv_id"""

SQL: dict[str, str] = {"op7_chat": _CHAT, "op2_decontamination": _LEAKS, "op6_weak_rules": _rules_sql()}
