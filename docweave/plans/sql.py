"""SQL pieces for the oracle of the relational and text queries: the same rows, said for another engine."""

from __future__ import annotations

CLEAN = r"""
  regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(line, '[-–—=]{4,}', ' — ', 'g'), '_ ?_+', ' — ', 'g'),
    '\s*[-–—=]{2,}\s*', ' — ', 'g'), '\s+', ' ', 'g'), '^\s+|\s+$', '', 'g')"""

GOOD = rf"""
lines as (
  select doc_id, source, lang, cast(pos - 1 as integer) as pos, line
  from (select doc_id, source, lang, unnest(parts) as line, generate_subscripts(parts, 1) as pos from (select *, string_split(text, chr(10)) as parts from documents))),
cleaned as (select doc_id, source, lang, pos, {CLEAN} as block from lines),
good as (
  select * from cleaned
  where length(block) between 50 and 2000 and not regexp_matches(block, '(?i)^\s*<TABLE')
    and not (contains(block, '|') and length(regexp_replace(block, '[^0-9]', '', 'g')) / greatest(length(block), 1) > 0.15)
    and length(regexp_replace(block, '[^A-Za-z]', '', 'g')) / greatest(length(block), 1) >= 0.5
    and length(regexp_replace(block, '[^0-9]', '', 'g')) / greatest(length(block), 1) <= 0.4
    and length(regexp_replace(block, '[^\p{{Lu}}]', '', 'g')) / greatest(length(regexp_replace(block, '[^\p{{L}}]', '', 'g')), 1) <= 0.6)
"""

KEY = r"regexp_replace(regexp_replace(regexp_replace(lower(block), '[\s.,;:!?]+$', '', 'g'), '\s+', ' ', 'g'), '^\s+|\s+$', '', 'g')"

SAMPLED = """
sampled as (
  select * from (select *, row_number() over (partition by doc_id order by md5('42|' || cast(doc_id as varchar) || '|' || cast(pos as varchar))) as n from good) where n <= 3)
"""

#: Sentences rendered from orders, so that money, dates, quantities, percentages, references, counts and shares are in them.
RENDERED = """
rendered as (
  select o_orderkey,
    'Order ' || cast(o_orderkey as varchar) || ' was placed on ' || strftime(o_orderdate, '%B %-d, %Y') || ' for $' ||
    cast(cast(o_totalprice as decimal(14,2)) as varchar) || ' under Note ' || cast(o_custkey % 40 + 1 as varchar) ||
    '. The price rose by ' || cast(o_custkey % 30 + 1 as varchar) || '% in volume of ' || cast(o_orderkey % 900 + 10 as varchar) ||
    ' kilograms. We had ' || cast(o_custkey % 5000 + 20 as varchar) || ' employees and issued ' || cast(o_orderkey % 7000 + 100 as varchar) ||
    ' shares of common stock.' as sentence
  from orders)
"""
