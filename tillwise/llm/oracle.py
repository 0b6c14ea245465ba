"""DuckDB SQL for the queries of this folder that SQL can express.

The digest expressions match those of ``mixing`` and ``line_dedup``; see there for the rules.
"""

from tillwise.llm import benchmark_search, line_dedup, mixing

_MIX = f"""
with sized as (
  select doc_id, source, text,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint as size,
    greatest({mixing.LEAST_WEIGHT}::double, coalesce(length(regexp_replace(text, '[^A-Za-z]', '', 'g'))::double
      / greatest(length(text), 1), 0)) as weight
  from documents
), numbered as (
  select *, row_number() over (partition by source, doc_id, text) - 1 as copy from sized
), keyed as (
  select *, -ln((('0x' || substr(md5(concat_ws('|', '{mixing.SEED}', doc_id::varchar, md5(text), nullif(copy, 0)::varchar)), 1, 13))::bigint
    ::double + 1) / 4503599627370496.0::double) / weight as key
  from numbered
), sums as (select source, sum(size)::bigint as source_size from keyed group by source
), ranked as (
  select *, [3, 1, 2][((row_number() over (order by source nulls last) - 1) % 3) + 1] as w, source_size * 2.0::double as cap
  from sums
), levels as (
  select *, cap / w as fills,
    (sum(source_size) over ()::double * 1.5::double
      - coalesce(sum(cap) over (order by cap / w, source nulls last rows between unbounded preceding and 1 preceding), 0::double))
    / (sum(w) over () - coalesce(sum(w) over (order by cap / w, source nulls last
        rows between unbounded preceding and 1 preceding), 0))::double as level
  from ranked
), goals as (
  select source, source_size, least(cap, w * max(case when fills >= level then level end) over ()) as target from levels
), rest as (
  select *, floor(target / greatest(source_size, 1))::bigint as epochs,
    target - floor(target / greatest(source_size, 1)) * source_size as rest
  from goals
), running as (
  select k.*, source_size, target, epochs, rest,
    sum(k.size) over (partition by k.source order by key, k.doc_id nulls last, k.size
      rows between unbounded preceding and current row)::double as through
  from keyed k join rest r on k.source is not distinct from r.source
)
select doc_id, size, source_size, target,
  ((epochs + case when through - size / 2.0::double <= rest and through - size < rest then 1 else 0 end) * size)::bigint as taken
from running
"""

_SPACES = "' ' || " + " || ".join(f"chr({ord(c)})" for c in line_dedup.ODD_SPACES)
_LINES = f"""
with split as (
  select doc_id, source, text, md5(text) as doc_key, string_split(text, chr(10)) as parts from documents
), lines as (
  select doc_id, doc_key, source, unnest(parts) as line from split
), shared as (
  select trim(line, {_SPACES}) as line, min(doc_id) as owner_id, arg_min(doc_key, doc_id) as owner_key
  from lines where trim(line, {_SPACES}) <> '' group by 1 having count(distinct source) >= {line_dedup.MIN_SITES}
), gone as (
  select l.doc_id, l.doc_key, list(distinct s.line) as hits
  from lines l join shared s on trim(l.line, {_SPACES}) = s.line
  where not (l.doc_id = s.owner_id and l.doc_key = s.owner_key) group by 1, 2
)
select d.doc_id,
  case when g.hits is null then d.text
    else array_to_string(list_filter(parts, lambda x: not list_contains(g.hits, trim(x, {_SPACES}))), chr(10)) end as text,
  coalesce(len(parts), 0)::bigint as n_lines,
  coalesce(len(list_filter(parts, lambda x: list_contains(g.hits, trim(x, {_SPACES})))), 0)::bigint as n_removed
from split d left join gone g on d.doc_id = g.doc_id and d.doc_key = g.doc_key
"""

_A_TO_Z = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_NEXT = ", ".join(f"lead(word, {k}) over w as w{k}" for k in range(1, benchmark_search.WINDOW))


def _occurring(length: int) -> str:
    window = " || ' ' || ".join(["word", *[f"w{k}" for k in range(1, length)]])
    return f"""select a.doc, a.place, b.item_id, {length} as length
      from following a join windows b on b.length = {length} and b.win = {window}"""


_BENCHMARK = f"""
with docs as (
  select row_number() over () as doc, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), {_A_TO_Z}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
  from documents
), items as (
  select coalesce(item_id::varchar, '') as item_id,
    regexp_extract_all(translate(coalesce(text, ''), {_A_TO_Z}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
  from benchmark
), starts as (
  select item_id, words, least(len(words), {benchmark_search.WINDOW}) as length,
    unnest(range(1, len(words) - least(len(words), {benchmark_search.WINDOW}) + 2)) as place
  from items where len(words) > 0
), windows as (
  select distinct item_id, length, array_to_string(words[place:place + length - 1], ' ') as win from starts
), placed as (
  select doc, unnest(words) as word, unnest(range(1, len(words) + 1)) as place from docs
), following as (
  select doc, place, word, {_NEXT} from placed window w as (partition by doc order by place)
), occurring as (
  {" union all ".join(_occurring(k) for k in range(1, benchmark_search.WINDOW + 1))}
), hit as (
  select doc, count(distinct hit_place) as n_hit from (select doc, unnest(range(place, place + length)) as hit_place from occurring) group by doc
), found as (
  select doc, count(distinct item_id) as n_items, string_agg(distinct item_id, ',' order by item_id) as ids from occurring group by doc
)
select doc_id, len(words)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from docs left join hit using (doc) left join found using (doc)
"""

SQL = {"op1_mix_sources": _MIX, "op5_line_dedup": _LINES, "op13_benchmark": _BENCHMARK}
