"""DuckDB statements that give the same rows as the registered queries.

They start from the same derived inputs and compute the results by other means: joins over pairs
for the graph, range joins for the quartiles, source columns for values read from pages.
"""

from __future__ import annotations

import re

from pubweave.functions.text import WHITESPACE
from pubweave.operators.countries import DEFAULT_COUNTRIES
from pubweave.plans import derived

_DECIMAL = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_CHARS = "concat(" + ", ".join(f"chr({ord(c)})" for c in WHITESPACE) + ")"


def _number(name: str) -> str:
    return (
        f"coalesce(case when regexp_matches({name}, '{_DECIMAL}') "
        f"then try_cast(trunc(try_cast(trim({name}) as double)) as bigint) end, 0)"
    )


def _strip(expression: str) -> str:
    return f"trim({expression}, {_CHARS})"


def _metric(name: str) -> str:
    return (
        f"case when {name} = 'N/A' then 0 "
        f"else try_cast(replace({name}, ',', '') as bigint) end"
    )


def _initcap(expression: str) -> str:
    words = f"string_split(lower(trim({expression})), ' ')"
    return f"array_to_string(list_transform({words}, lambda w: upper(w[1:1]) || w[2:]), ' ')"


_SPELLING = (
    "case c "
    + " ".join(
        f"when '{' '.join(w.capitalize() for w in n.split(' '))}' then '{n}'"
        for n in DEFAULT_COUNTRIES
    )
    + " end"
)

CTES = {
    **derived.duck_views(),
    "articles": f"""
select * exclude ("Year", "Day", "Downloads", locations),
  cast({_number('"Year"')} as int) as "Year", {_number('"Day"')} as "Day",
  {_number('"Downloads"')} as "Downloads", coalesce(locations, [null]) as locations
from raw_articles""",
    "published_articles": """
select *, trim(main_title || ' ' || sub_title) as title,
  case when seq % 90 <> 0 then journal end as publisher_name,
  case when seq % 90 <> 0 then 'N/A' end as publisher_issn,
  case when seq % 90 <> 0 then quartile end as publisher_quartile
from articles""",
    "country_rows": f"""
select topic, {_initcap('country')} as c from (
  select topic, unnest(countries) as country from articles) u
where country is not null and country <> ''""",
    "words": f"""
select {_strip('lower(k)')} as keyword from (select unnest(keywords) as k from doc_articles) u
where k is not null""",
    "cited_ranked": """
select "Year", title, c as citations,
  row_number() over (partition by "Year" order by c desc nulls last, seq) as position
from (select *, try_cast(nullif(regexp_extract(citations, '^\\s*([+-]?\\d+\\.?\\d*)', 1), '')
        as double) as c from published_articles) s""",
    "paper_members": """
select distinct authors, "Year", a.author from (
  select distinct authors, "Year" from articles where "Year" is not null) p,
  unnest(p.authors) as a(author) where a.author is not null""",
    "edges": """
select distinct x.author as src, y.author as dst, x.authors, x."Year"
from paper_members x join paper_members y
  on x.authors = y.authors and x."Year" = y."Year" and x.author <> y.author""",
    "stored": "select doi, seq, topic, seq as position, 0 as copy from raw_articles",
    "incoming": f"""
select case when (seq * 2) % 500 = 0 then null else '{derived.DOI_PREFIX}' || (seq * 2) end as doi,
  seq, topic, copy, seq * 2 + copy as position from (
  select seq, topic, unnest(case when seq % 10 = 0 then [0, 1] else [0] end) as copy
  from raw_articles) u""",
    "listed": """
select p_partkey, p_brand, p_type, p_name, p_retailprice, p_size, p_partkey + i as k, i
from (select *, unnest(range(0, 1 + p_partkey % 3)) as i from part) u""",
}


def _needed(sql: str) -> list[str]:
    found = [n for n in CTES if re.search(rf"\b{n}\b", sql)]
    seen: list[str] = []
    for name in found:
        for inner in (*_needed_inside(name), name):
            if inner not in seen:
                seen.append(inner)
    return seen


def _needed_inside(name: str) -> list[str]:
    return [n for n in _needed(CTES[name]) if n != name]


def _query(sql: str, extra: dict[str, str] | None = None) -> str:
    extra = extra or {}
    base = _needed(" ".join((*extra.values(), sql)))
    parts = [f"{n} as materialized ({CTES[n]})" for n in base]
    parts += [f"{n} as materialized ({body})" for n, body in extra.items()]
    return (f"with {', '.join(parts)}\n" if parts else "") + sql


def _pivot(row: str, source: str) -> str:
    names = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    cells = [f"count(*) filter (where topic = '{t}') as \"{t}\"" for t in names]
    cells.append('count(*) filter (where topic is null) as "null"')
    return f'select {row}, {", ".join(cells)} from {source} group by 1'


def _rank_steps(steps: int) -> dict[str, str]:
    """``steps`` rounds over ``weighted(src, dst, w)`` and ``every(id)``, unrolled."""
    ctes = {"r0": "select id, 1.0::double as pr from every"}
    for k in range(1, steps + 1):
        ctes[f"r{k}"] = (
            f"select v.id, 0.15 + 0.85 * coalesce(s.got, 0) as pr from every v left join ("
            f"select dst, sum(w * pr) as got from weighted join r{k - 1} on id = src group by dst"
            f") s on s.dst = v.id"
        )
    return ctes


_WEIGHTED = {
    "pairs": "select src, dst, count(*) as n from {edges} group by 1, 2",
    "weighted": """
select p.src, p.dst, p.n / o.total as w from pairs p
join (select src, sum(n)::double as total from pairs group by 1) o on o.src = p.src""",
    "every": "select src as id from pairs union select dst from pairs",
}


def _graph(edges: str, steps: int) -> dict[str, str]:
    return {n: s.replace("{edges}", edges) for n, s in _WEIGHTED.items()} | _rank_steps(steps)


_SHIPMENTS = """(select 'S' || l_suppkey as src, case when l_partkey % 3 = 0 then 'P' || l_partkey
  else 'S' || cast(floor(l_partkey / 20) as bigint) end as dst from lineitem) g"""


def _asof(lookback: int) -> dict[str, str]:
    return {
        "decided": """
select trim(journal) as journal, "Year", arg_min(coalesce("Quartile", ''), pos) as q
from rankings group by 1, 2 having q <> ''""",
        "found": f"""
select a.seq, max_by(d.q, d."Year") as q from published_articles a
join decided d on d.journal = trim(coalesce(a.publisher_name, ''))
  and d."Year" between a."Year" - {lookback - 1} and a."Year"
group by a.seq""",
        "enriched": """
select a.seq, a."Year", a.publisher_name as journal_name,
  coalesce(nullif(a.publisher_quartile, ''), f.q, '') as found_quartile
from published_articles a left join found f on f.seq = a.seq""",
    }


_LISTED_ITEM = """
  case when k % 5 = 0 then 'Unknown' else p_type || ' & more' end as type"""
_LISTED_DOI = "'https://list.example/doi/10.2/' || p_partkey || '-' || i"
_FROM_DRIVER_PAGE = r"""
  regexp_extract(html, '(?s)<title>(.*?)</title>', 1)"""

_PLAIN = r"regexp_replace(regexp_replace({0}, '(?s)<[^>]*>', '', 'g'), '\s+', ' ', 'g')"


def _page_text(expression: str) -> str:
    """Text of markup that holds the few entities the given pages use."""
    plain = _PLAIN.format(expression)
    for entity, char in (("&nbsp;", "chr(160)"), ("&lt;", "'<'"), ("&gt;", "'>'"),
                         ("&quot;", "'\"'"), ("&#39;", "chr(39)"), ("&copy;", "chr(169)"),
                         ("&middot;", "chr(183)"), ("&amp;", "'&'")):
        plain = f"replace({plain}, '{entity}', {char})"
    return _strip(plain)


_HAS_PAGE = "i = 0"
_COUNTABLE = "k % 11 <> 1"

_ODD_TOPIC = """case seq % 8 when 0 then null when 1 then 'null' when 2 then 'AI' when 3 then 'ai'
  when 4 then 'Year' when 5 then 'a.b' when 6 then '`x`' else '' end"""
_ODD_TOPIC_COLUMNS = {
    "(empty)": "= ''",
    "AI": "= 'AI'",
    "Year (2)": "= 'Year'",
    "`x`": "= '`x`'",
    "a.b": "= 'a.b'",
    "ai (2)": "= 'ai'",
    "null": "= 'null'",
    "null (2)": "is null",
}

ORACLES: dict[str, str] = {
    "clean_numeric": _query('select seq, "Day", "Year", "Downloads" from articles'),
    "clean_locations": _query("select seq, cast(len(locations) as int) as n, locations[1] as first from articles"),
    "article_dates": _query(f"""
select seq, strftime(d, '%d %B %Y') as "Date_part", cast(year(d) as int) as "Year_part",
  strftime(d, '%B') as "Month_part", cast(day(d) as int) as "Day_part"
from (select seq, coalesce(cast(try_strptime(published, '%d %B %Y') as date),
        date '{derived.RUN_DATE}') as d from raw_articles) s"""),
    "metric_parse": _query(f"""
select seq, cast({_metric('"Downloads"')} as bigint) as downloads_value,
  cast({_metric('citations')} as bigint) as citations_value,
  try_cast(nullif(regexp_extract(citations, '^\\s*([+-]?\\d+\\.?\\d*)', 1), '') as double)
    as citations_prefix
from raw_articles"""),
    "titles_publisher": _query(f"""
select seq, title, topic, '{derived.WEBSITE}' as website,
  trim(coalesce(publisher_name, '')) as journal_name, coalesce(publisher_issn, '') as issn,
  coalesce(publisher_quartile, '') as quartile_text
from published_articles"""),
    "affiliations": _query("""
select seq,
  case when len(affiliations) = 0 then 'Unknown' else array_to_string(list_transform(affiliations,
    lambda a: case when contains(a, ',') then trim(regexp_extract(a, '(?s)^(.*),[^,]*$', 1))
      else a end), '|') end as universities,
  case when len(affiliations) = 0 then 'Unknown' else array_to_string(list_transform(affiliations,
    lambda a: case when contains(a, ',') then trim(split_part(a, ',', -1)) else 'Unknown' end),
    '|') end as countries,
  array_to_string(list_transform(range(0, len(affiliations)), lambda i: 'Author ' || i), '|') as names,
  array_to_string(affiliations, '|') as locations
from raw_articles"""),
    "year_topics": _query('select distinct "Year", topic from articles'),
    "year_topic_counts": _query('select "Year", topic, count(*) as "count" from articles group by all'),
    "year_topic_pivot": _query(_pivot('"Year"', "articles")),
    "country_topic_counts": _query(f"""
select {_SPELLING} as country, topic, count(*) as "count" from country_rows
where {_SPELLING} is not null group by all"""),
    "country_topic_counts_literal": _query(f"""
select c as country, topic, count(*) as "count" from country_rows
where c in ({', '.join(f"'{n}'" for n in DEFAULT_COUNTRIES)}) group by all"""),
    "country_topic_counts_distinct": _query(f"""
select country, topic, count(*) as "count" from (
  select distinct seq, topic, {_initcap('country')} as country from (
    select seq, topic, unnest(countries) as country from articles) u) d
where country is not null and country <> '' group by all"""),
    "country_topic_pivot": _query(
        _pivot("country", "shown"),
        {"shown": f"select {_SPELLING} as country, topic from country_rows where {_SPELLING} is not null"},
    ),
    "keyword_counts": _query('select keyword, count(*) as "count" from words group by all'),
    "keyword_top5": _query("""
select keyword, n as "count", cast(row_number() over (order by n desc, keyword) as int) as position
from (select keyword, count(*) as n from words group by all) g qualify position <= 5"""),
    "top_cited_per_year": _query("""
select "Year", cast(position as int) as position, 'Article ' || position as name, title, citations
from cited_ranked where position <= 5"""),
    "cited_by_year": _query("""
select "Year", cast(count(*) as int) as n,
  string_agg('Article ' || position, '|' order by position) as names,
  string_agg(title, '|' order by position) as titles
from cited_ranked where position <= 5 group by 1"""),
    "coauthor_edges": _query(
        'select src, dst, array_to_string(authors, \'|\') as authors, "Year" from edges'
    ),
    "coauthor_edges_in_years": _query(
        'select "Year", count(*) as edges from edges where "Year" in (1997, 1998) group by 1'
    ),
    "coauthor_vertices": _query("select distinct src as id from edges"),
    "edge_vertices": _query("select src as id from edges union select dst from edges"),
    "author_pagerank": _query(
        "select id, round(pr, 6) as pagerank from r50", _graph("edges", 50)
    ),
    "edge_pagerank": _query("select id, round(pr, 6) as pagerank from r50", _graph("edges", 50)),
    "shipment_pagerank": _query(
        "select id, round(pr * (select count(*) / sum(pr) from r50), 6) as pagerank from r50",
        _graph(_SHIPMENTS, 50),
    ),
    "top_authors": _query(
        """
select id, pagerank, cast(row_number() over (order by pagerank desc, id) as int) as position
from (select id, round(pr, 6) as pagerank from r50) s qualify position <= 50""",
        _graph("edges", 50),
    ),
    "new_by_doi": _query("""
select doi, seq, cast(copy as int) as copy from incoming n
where not exists (select 1 from stored o where o.doi = n.doi)"""),
    "insert_new_null_safe": _query("""
select doi, seq, cast(copy as int) as copy from incoming n
where not exists (select 1 from stored o where o.doi is not distinct from n.doi)"""),
    "merge_keep_last": _query(
        """
select doi, seq, cast(copy as int) as copy, topic, cast(fb as int) as first_batch,
  fp as first_position from placed qualify row_number() over (
    partition by doi order by batch desc, position desc) = 1""",
        {
            "both_batches": """
select doi, seq, copy, topic, position, 0 as batch from stored
union all select doi, seq, copy, topic, position, 1 from incoming""",
            "placed": """
select *, first_value(batch) over w as fb, first_value(position) over w as fp from both_batches
window w as (partition by doi order by batch, position)""",
        },
    ),
    "ingest_report": _query("""
select (select count(*) from incoming) as found,
  (select count(*) from incoming n where not exists (
     select 1 from stored o where o.doi is not distinct from n.doi)) as inserted,
  (select count(*) from (select doi from incoming union select doi from stored) u) as total"""),
    "quartile_asof": _query("select * from enriched", _asof(10)),
    "quartile_asof_short": _query(
        'select "Year", found_quartile, count(*) as "count" from enriched group by all', _asof(2)
    ),
    "page_scalar_fields": f"""
select page_id, url, {_page_text(_FROM_DRIVER_PAGE)} as title,
  regexp_extract(html, '<html lang="([^"]*)"', 1) as lang,
  {_page_text("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)")} as heading, '' as subtitle
from pages""",
    "page_list_fields": r"""
select page_id, cast(len(l) as int) as n, array_to_string(l, '|') as links, 'Unknown' as tables
from (select page_id, list_transform(
  regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a>', 1), lambda x: trim(x)) as l from pages) s""",
    "page_items": f"""
select page_id, cast(k - 1 as int) as position, '/' || label as href, label, page_title
from (select page_id, unnest(l) as label, generate_subscripts(l, 1) as k,
        {_page_text(_FROM_DRIVER_PAGE)} as page_title
      from (select *, regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a>', 1) as l from pages) s) u""",
    "listing_items": _query(f"""
select p_partkey as page_id, 'https://list.example/search?page=' || p_partkey as url,
  cast(i as int) as position, {_LISTED_ITEM}, p_brand || ' é' as publisher,
  case when k % 7 = 0 then 'N/A' else format('{{:,}}', cast(floor(p_retailprice * 10) as bigint)) end
    as downloads_text,
  case k % 11 when 0 then 'N/A' when 1 then 'many' else cast(p_size as varchar) end as citations_text,
  p_name || ' ' || p_partkey as main_title,
  case when k % 2 = 0 then '' else 'a study' end as sub_title, {_LISTED_DOI} as doi
from listed where k % 13 <> 0"""),
    "listing_items_page_heading": _query("""
select p_partkey as page_id, cast(i as int) as position,
  case when headings = 0 then 'Unknown' else p_type || ' & more' end as type
from (select *, count(*) filter (where k % 5 <> 0) over (partition by p_partkey) as headings
      from listed) s where k % 13 <> 0"""),
    "listing_rejects": _query("""
select p_partkey as page_id, 'https://list.example/search?page=' || p_partkey as url,
  cast(i as int) as position, 'link' as reason from listed where k % 13 = 0"""),
    "article_page_fields": """
with p as (select *, range(0, p_partkey % 5) as people,
    p_partkey % 5 = 0 or (p_partkey % 19 = 0 and p_partkey % 5 > 1) as unusable
  from part)
select 'https://list.example/doi/10.2/' || p_partkey || '-0' as url,
  'About ' || p_name || ' <new>.' as abstract,
  case when p_partkey % 4 = 0 then 'Unknown' else array_to_string(list_transform(
    range(0, p_partkey % 4), lambda i: 'Person ' || (p_partkey % 100 + i)), '|') end as authors,
  case when p_partkey % 6 = 0 then 'N/A' else p_type || '||' || p_brand end as keywords,
  case when p_partkey % 8 = 0 then 'N/A' else p_size || '-X' end as issn,
  (1 + p_partkey % 28) || ' ' || ['March', 'august', 'Mar'][1 + p_partkey % 3] || ' '
    || (1990 + p_size) as published,
  case when unusable then 'Unknown' else array_to_string(list_transform(people, lambda i:
    ['MIT', 'MIT, Cambridge', 'Lab ' || i][1 + (p_partkey + i) % 3]), '|') end as universities,
  case when unusable then 'Unknown' else array_to_string(list_transform(people, lambda i:
    ['Unknown', 'USA', ''][1 + (p_partkey + i) % 3]), '|') end as countries
from p""",
    "page_links": _query(f"""
select {_LISTED_DOI} as doi,
  p_name || ' ' || p_partkey || case when k % 2 = 0 then '' else ' a study' end as title,
  strftime(d, '%d %B %Y') as "Date", cast(year(d) as int) as "Year", strftime(d, '%B') as "Month",
  cast(day(d) as int) as "Day",
  case when k % 7 = 0 then 0 else cast(floor(p_retailprice * 10) as bigint) end as "Downloads",
  case when k % 11 = 0 then 0 else cast(p_size as bigint) end as citations, {_LISTED_ITEM},
  p_brand || ' é' as publisher_name,
  case when p_partkey % 8 = 0 then 'N/A' else p_size || '-X' end as publisher_issn,
  'parts' as topic, '{derived.WEBSITE}' as website,
  cast(greatest(p_partkey % 4, 1) as int) as n_authors
from (select *, case when p_partkey % 3 = 2 then date '{derived.RUN_DATE}'
        else make_date(1990 + p_size, 3 + 5 * (p_partkey % 3), 1 + p_partkey % 28) end as d
      from listed) s
where k % 13 <> 0 and {_HAS_PAGE} and {_COUNTABLE}"""),
    "page_link_rejects": _query(f"""
select {_LISTED_DOI} as doi,
  case when not ({_HAS_PAGE}) then 'article page' else 'citations' end as reason
from listed where k % 13 <> 0 and not ({_HAS_PAGE} and {_COUNTABLE})"""),
    "ranking_rows": """
with rows as (select *, p_partkey + i as k from (
    select *, unnest(range(0, p_partkey % 6)) as i from part) u where (p_partkey + i) % 10 <> 0)
select p_brand || ' ' || p_partkey as journal,
  cast(row_number() over (partition by p_partkey order by i) - 1 as int) as pos,
  p_type as category, cast(1990 + p_size % 9 + i as int) as "Year", 'Q' || (1 + k % 4) as "Quartile"
from rows where not (p_partkey % 31 = 0 and p_partkey % 6 > 2 and (p_partkey + 2) % 10 <> 0)""",
    "ranking_rows_lenient": """
with rows as (select *, p_partkey + i as k from (
    select *, unnest(range(0, p_partkey % 6)) as i from part) u where (p_partkey + i) % 10 <> 0),
numbered as (select *, row_number() over (partition by p_partkey order by i) - 1 as pos from rows)
select p_brand || ' ' || p_partkey as journal, cast(pos as int) as pos, p_type as category,
  cast(1990 + p_size % 9 + i as int) as "Year", 'Q' || (1 + k % 4) as "Quartile"
from numbered where not (p_partkey % 31 = 0 and i = 2)""",
    "csv_roundtrip": _query(_pivot('"Year"', "articles")),
    "csv_as_records": _query(f"""
select '{{"country":"' || country || '","topic":"' || coalesce(topic, '') || '","count":' || n || '}}'
  as value
from (select {_SPELLING} as country, topic, count(*) as n from country_rows
      where {_SPELLING} is not null group by all) g"""),
    "json_roundtrip": _query("""
select doi, title, array_to_string(authors, '|') as authors, "Year",
  publisher_quartile as quartile_text, upper(topic) as topic from published_articles"""),
    "records_roundtrip": _query(
        'select "Year", topic, count(*) as "count" from articles group by all'
    ),
    "parquet_append": _query("""
select doi, seq, cast(copy as int) as copy, topic from stored union all
select doi, seq, cast(copy as int), topic from incoming n
where not exists (select 1 from stored o where o.doi is not distinct from n.doi)"""),
}

ORACLES |= {
    "listing_bounded_items": ORACLES["listing_items"],
    "nested_article_fields": ORACLES["article_page_fields"]
    + " where p_partkey % 10 <> 0 and p_partkey % 11 <> 0",
    "article_page_rejects": """
select p_partkey as page_id, 'https://list.example/doi/10.2/' || p_partkey || '-0' as url,
  case when p_partkey % 10 = 0 then 'abstract' else 'published' end as reason
from part where p_partkey % 10 = 0 or p_partkey % 11 = 0""",
    "csv_text_roundtrip": _query("""
select seq, case seq % 8 when 0 then 'two' || chr(10) || 'lines' when 1 then 'a "quote"'
  when 2 then 'back\\slash\\' when 3 then '  blanks ' when 4 then '' when 5 then null
  when 6 then 'a,b' else '"' end as cell from articles"""),
    "odd_topic_pivot": _query(f"""
select "Year", {", ".join(f'count(*) filter (where t {c}) as "{n}"' for n, c in _ODD_TOPIC_COLUMNS.items())}
from (select "Year", {_ODD_TOPIC} as t from articles) s group by 1"""),
    "append_odd_topics": _query(f"select seq, {_ODD_TOPIC} as topic from articles"),
    "json_append": _query(f"select seq, {_ODD_TOPIC} as topic from articles"),
    "quartile_by_issn": _query(
        """
select a.seq, coalesce(max_by(d.q, d."Year"), '') as found_quartile
from articles a left join decided d on d.journal = trim(a.journal)
  and d."Year" between a."Year" - 9 and a."Year"
group by a.seq""",
        _asof(10),
    ),
    "quartile_merge_keeps_unkeyed": _query(
        """
select doi is null as unkeyed, count(*) as n, cast(sum(seq) as bigint) as seqs from (
  select doi, seq from both_batches where doi is null
  union all select doi, arg_max(seq, batch) from both_batches where doi is not null group by doi) u
group by 1""",
        {
            "both_batches": """
select doi, seq, 0 as batch from stored union all select doi, seq, 1 from incoming"""
        },
    ),
}

ORACLES |= {
    "keyword_top5_certified": ORACLES["keyword_top5"],
    "sparse_topic_pivot": _query("""
select "Year", topic, count(*) as "count" from (
  select "Year", concat_ws(' ', topic, main_title) as topic from articles) s group by all"""),
    "upsert_touched": _query(
        """
select doi, seq, cast(copy as int) as copy, topic from both_batches qualify row_number() over (
  partition by doi order by batch desc, position desc) = 1""",
        {
            "both_batches": """
select doi, seq, copy, topic, position, 0 as batch from stored
union all select doi, seq, copy, topic, position, 1 from incoming"""
        },
    ),
    "new_in_touched": ORACLES["new_by_doi"],
    "new_by_index": ORACLES["insert_new_null_safe"],
    "json_array_records": _query("""
select "Year", topic, count(*) as "count" from articles group by all
union all select null, ']}, all', count(*) from articles"""),
}

ORACLES["quartile_asof_long"] = _query(
    'select "Year", found_quartile, count(*) as "count" from enriched group by all', _asof(100)
)

ORACLES["collection_filtered"] = _query(
    'select cast(seq as varchar) as _id, "Year" from articles where "Year" >= 1995'
)
