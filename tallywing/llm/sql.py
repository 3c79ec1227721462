"""SQL for DuckDB of the queries that SQL can express, stated plainly."""

from __future__ import annotations

from tallywing.llm.secrets import RULES


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def secret_scan() -> str:
    """Matches and the pieces between them give the places; matches that are too short drop out afterwards."""
    kinds = []
    for k, rule in enumerate(RULES):
        pattern = _quoted(rule.pattern)
        size = f"length(regexp_extract(m, {pattern}, {rule.group}))" if rule.group else "length(m)"
        kinds.append(f"""
  select doc_id, {k} as kind, {_quoted(rule.kind)} as name, {str(rule.base).lower()} as base,
    list_sum(list_transform(pieces[:i], lambda x: length(x))) + list_sum(list_transform(matches[:i], lambda x: length(x))) as stop,
    length(matches[i]) as size, {size.replace("m,", "matches[i],").replace("(m)", "(matches[i])")} as counted, {rule.least} as least
  from (
    select doc_id, matches, pieces, unnest(range(1, len(matches) + 1)) as i
    from (select doc_id, regexp_extract_all(text, {pattern}) as matches, string_split_regex(text, {pattern}) as pieces from texts)
  )""")
    counts = ", ".join(f"count(*) filter (name = '{r.kind}') as n_{r.kind}" for r in RULES if r.base)
    listed = "coalesce(string_agg(name || ':' || cast(stop - size as bigint) || ':' || cast(stop as bigint), ',' order by stop - size, kind) filter ({}), '')"
    return f"""
with texts as (select doc_id, coalesce(text, '') as text from documents),
found as ({" union all ".join(kinds)}),
spans as (select * from found where counted >= least),
told as (
  select doc_id, {counts}, {listed.format("base")} as base_spans, {listed.format("true")} as spans from spans group by doc_id
)
select d.doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) as n_{r.kind}" for r in RULES if r.base)},
  sha256(coalesce(base_spans, '')) as base_sha256, coalesce(spans, '') as spans
from documents d left join told t on d.doc_id = t.doc_id"""


SUBSTRING_DEDUP = r"""
with texts as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents
),
starts as (select doc_id, words, unnest(range(1, len(words) - 48)) as i from texts where len(words) >= 50),
windows as (select doc_id, i, md5(array_to_string(words[i:i + 49], ' ')) as w from starts),
least as (select w, min(doc_id) as least from windows group by w),
covered as (
  select doc_id, list(distinct place) as gone from (
    select doc_id, unnest(range(i, i + 50)) as place from windows join least using (w) where least < doc_id
  ) group by doc_id
),
kept as (
  select t.doc_id, words, list_filter(list_zip(words, range(1, len(words) + 1)), lambda x: gone is null or not list_contains(gone, x[2])) as stay
  from texts t left join covered c on t.doc_id = c.doc_id
)
select doc_id, cast(len(words) as bigint) as n_words, cast(len(words) - len(stay) as bigint) as n_removed,
  sha256(coalesce(array_to_string(list_transform(stay, lambda x: x[1]), ' '), '')) as kept_sha256
from kept"""


COLLOCATIONS = r"""
with pieces as (
  select coalesce(lang, 'und') as lang,
    unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
  from documents where text is not null
),
listed as (select lang, row_number() over () as number, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
words as (select lang, number, unnest(w) as one, unnest(range(1, len(w) + 1)) as i from listed),
next as (
  select lang, one, lead(one, 1) over places as two, lead(one, 2) over places as three from words
  window places as (partition by number order by i)
),
runs as (
  select lang, 1 as k, one as phrase from next
  union all select lang, 2, one || ' ' || two from next where two is not null
  union all select lang, 3, one || ' ' || two || ' ' || three from next where three is not null
),
f as (select lang, k, phrase, count(*) as f from runs group by all),
n as (select lang, cast(sum(f) as bigint) as n from f where k = 1 group by lang),
c as (select lang, k, phrase, f as a, string_split(phrase, ' ') as w from f where k > 1 and f >= 10),
cuts as (
  select lang, phrase, a, cut, array_to_string(w[:cut], ' ') as head, array_to_string(w[cut + 1:], ' ') as tail
  from c, (values (1), (2)) as places(cut) where cut < k
),
told as (
  select cuts.*, x.f as l, y.f as r,
    cast((cast(1000000 as hugeint) * a * a) // (cast(x.f as hugeint) * y.f) as bigint) as score
  from cuts join f x on x.lang = cuts.lang and x.phrase = head join f y on y.lang = cuts.lang and y.phrase = tail
),
best as (select * from (select *, row_number() over (partition by lang, phrase order by score, cut) as place from told) where place = 1),
longer as (
  select lang, inner_phrase as phrase, max(a) as most from (
    select lang, a, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) as inner_phrase from c where k = 3
  ) group by all
),
ranked as (
  select best.lang, row_number() over (partition by best.lang order by score desc, a desc, best.phrase) as rank,
    best.phrase, a, l, r, n, score
  from best join n on n.lang = best.lang left join longer on longer.lang = best.lang and longer.phrase = best.phrase
  where most is null or 100 * most < 50 * a
)
select lang, rank, phrase, a, l, r, n, score from ranked where rank <= 2000"""
