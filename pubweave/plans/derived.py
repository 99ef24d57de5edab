"""Article collections derived from the star-schema tables.

The tables hold no articles and no dirty values, so the registered queries derive both, with one
expression per column. Every article comes from one source row: no grouping, hence no group that
could grow with a key. Skew is put in on purpose: one author appears in a third of the papers.

The expressions are SQL that differs between engines only in the few spellings of ``Dialect``, so
that the oracle starts from the same input and then computes the results by its own SQL.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from pubweave.storage import spread


@dataclass(frozen=True)
class Dialect:
    text: str
    array: Callable[[list[str]], str]
    each: Callable[[str, str, str], str]
    concat: Callable[[str, str], str]
    join: Callable[[str], str]
    long_date: Callable[[str], str]
    thousands: Callable[[str], str]

    def t(self, expression: str) -> str:
        return f"cast({expression} as {self.text})"

    def numbered(self, count: str, at_most: int, body: str) -> str:
        """``body`` for ``i`` from 0 to ``count - 1``."""
        return self.each(self.array([str(k) for k in range(at_most)]), f"({count})", body)

    def choice(self, index: str, values: list[str | None]) -> str:
        cases = " ".join(
            f"when {k} then {'null' if v is None else chr(39) + v + chr(39)}"
            for k, v in enumerate(values)
        )
        return f"case ({index}) {cases} end"


SPARK = Dialect(
    text="string",
    array=lambda xs: f"array({', '.join(xs)})",
    each=lambda arr, n, body: f"transform(slice({arr}, 1, cast({n} as int)), i -> {body})",
    concat=lambda a, b: f"concat({a}, {b})",
    join=lambda arr: f"array_join({arr}, '')",
    long_date=lambda d: f"date_format({d}, 'dd MMMM yyyy')",
    thousands=lambda n: f"format_number({n}, 0)",
)

DUCK = Dialect(
    text="varchar",
    array=lambda xs: f"[{', '.join(xs)}]",
    each=lambda arr, n, body: f"list_transform(list_slice({arr}, 1, {n}), lambda i: {body})",
    concat=lambda a, b: f"list_concat({a}, {b})",
    join=lambda arr: f"array_to_string({arr}, '')",
    long_date=lambda d: f"strftime({d}, '%d %B %Y')",
    thousands=lambda n: f"format('{{:,}}', cast({n} as bigint))",
)

RUN_DATE = "2001-12-31"
WEBSITE = "example"
DOI_PREFIX = "https://doi.example/10.1/"
RAW_COUNTRIES = [
    "USA", " usa ", "france", "UNITED KINGDOM", "Morocco ", "china",
    "India ", "Unknown", "", "Spain", " ", None,
]
MAX_AUTHORS = 6


def _author(d: Dialect, offset: str) -> str:
    return f"'Customer#' || lpad({d.t(f'o_custkey + ({offset}) * (o_orderkey % 11)')}, 9, '0')"


def article_columns(d: Dialect) -> dict[str, str]:
    """An article per row of ``orders``, as a merged collection would hold it."""
    key = "o_orderkey"
    year = d.t("extract(year from o_orderdate)")
    one_name = f"cast(null as {d.text})"
    names = d.numbered(f"{key} % {MAX_AUTHORS}", MAX_AUTHORS, _author(d, "i"))
    hub = d.array(["'Customer#000000000'"])
    unnamed = d.array([one_name])
    raw_country = d.choice("(o_custkey + i * 7) % 12", RAW_COUNTRIES)
    city = f"'Dept ' || {d.t('i')} || ', University ' || {d.t('o_custkey % 50')}"
    affiliation = (
        f"case (o_custkey + i) % 4 when 0 then 'Institute ' || {d.t('i')} "
        f"when 1 then {city} || ',' else {city} || ' , ' || o_orderstatus end"
    )
    return {
        "doi": f"case when {key} % 500 = 0 then null else '{DOI_PREFIX}' || {d.t(key)} end",
        "seq": key,
        "topic": f"case when {key} % 200 = 7 then null else o_orderpriority end",
        "Year": f"case {key} % 50 when 0 then null when 1 then 'n/a' when 2 then {year} || '.7' "
        f"when 3 then ' ' || {year} || ' ' else {year} end",
        "Day": f"case when {key} % 45 = 0 then '1,2' else {d.t('extract(day from o_orderdate)')} end",
        "published": f"case {key} % 40 when 0 then 'Spring 1997' when 1 then '31 February 1997' "
        f"else {d.long_date('o_orderdate')} end",
        "Downloads": f"case when {key} % 20 = 0 then 'N/A' else {d.thousands('floor(o_totalprice)')} end",
        "citations": f"case {key} % 30 when 0 then 'N/A' when 1 then '7 cites' when 2 then null "
        f"else {d.t(f'{key} % 97')} end",
        "main_title": f"'Order ' || {d.t(key)}",
        "sub_title": f"case when {key} % 4 = 0 then ' part two ' else '' end",
        "journal": f"case when {key} % 70 = 0 then null else ' Brand#' || {d.t(f'1 + {key} % 30')} || ' ' end",
        "quartile": f"case {key} % 25 when 0 then 'Q1' when 1 then '' else null end",
        "locations": f"case when {key} % 9 = 0 then null else {d.array(['o_orderstatus', one_name])} end",
        "authors": f"case when {key} % 12 = 0 then null when {key} % 3 = 0 then {d.concat(names, hub)} "
        f"when {key} % 37 = 0 then {d.concat(names, unnamed)} else {names} end",
        "countries": f"case when {key} % 60 = 0 then null else "
        f"{d.numbered(f'{key} % {MAX_AUTHORS}', MAX_AUTHORS, raw_country)} end",
        "affiliations": d.numbered(f"{key} % 4", 4, affiliation),
    }


def document_columns(d: Dialect) -> dict[str, str]:
    """An article per row of ``documents``; its keywords are the words of the whole text."""
    words = {"string": "split(text, ' ')", "varchar": "string_split(text, ' ')"}[d.text]
    return {"doi": d.t("doc_id"), "topic": "source", "keywords": words}


def listing_columns(d: Dialect) -> dict[str, str]:
    """A listing page per row of ``part``, in the template of the default rules, 1 to 3 items."""
    link = f"'<a href=\"/doi/10.2/' || {d.t('p_partkey')} || '-' || {d.t('i')} || '\" "
    item = (
        "'<li class=\"issue-item issue-item--search clearfix\">' "
        f"|| case when (p_partkey + i) % 5 = 0 then '' else '<h5 class=\"issue-heading\">' || p_type || ' &amp; more</h5>' end "
        f"|| '<div class=\"issue-item__detail\">' || case when (p_partkey + i) % 13 = 0 then '' else {link}title=\"' || p_brand || ' &#233;\">' || p_brand || '</a>' end || '</div>' "
        f"|| '<span class=\"hlFld-Title\">' || p_name || '<i> ' || {d.t('p_partkey')} || '</i></span>' "
        "|| case when (p_partkey + i) % 2 = 0 then '' else '<span class=\"hlFld-SubTitle\"> a study </span>' end "
        f"|| case when (p_partkey + i) % 7 = 0 then '' else '<span class=\"metric\">' || {d.thousands('floor(p_retailprice * 10)')} || '</span>' end "
        f"|| case (p_partkey + i) % 11 when 0 then '' when 1 then '<span class=\"citation\">many</span>' else '<span class=\"citation\">' || {d.t('p_size')} || '</span>' end || '</li>'"
    )
    return {
        "page_id": "p_partkey",
        "url": f"'https://list.example/search?page=' || {d.t('p_partkey')}",
        "html": "'<html><body><h1>Results</h1><ul>' || "
        f"{d.join(d.numbered('1 + p_partkey % 3', 3, item))} || '</ul></body></html>'",
    }


def article_page_columns(d: Dialect) -> dict[str, str]:
    """An article page per row of ``part``: that of the first item; the others were not saved."""
    person = (
        f"'<div class=\"authInfo\"><span class=\"auth-name\"> Person ' || {d.t('p_partkey % 100 + i')} || ' </span>' "
        "|| case when p_partkey % 19 = 0 and i = 1 then '' else '<span class=\"auth-institution\">' "
        f"|| case (p_partkey + i) % 3 when 0 then 'MIT' when 1 then 'MIT, Cambridge, USA' else 'Lab ' || {d.t('i')} || ',' end || '</span>' end || '</div>'"
    )
    author = f"'<span class=\"dropBlock\"><a href=\"#\" title=\" Person ' || {d.t('p_partkey % 100 + i')} || ' \">x</a></span>'"
    day = f"{d.t('1 + p_partkey % 28')} || ' ' || {d.choice('p_partkey % 3', ['March', 'august', 'Mar'])} || ' ' || {d.t('1990 + p_size')}"
    return {
        "page_id": "p_partkey",
        "url": f"'https://list.example/doi/10.2/' || {d.t('p_partkey')} || '-0'",
        "html": "'<html><body><section id=\"abstract\"><h2>Abstract</h2><div role=\"paragraph\">About <b>' "
        "|| p_name || '</b> &lt;new&gt;.</div></section><div class=\"authors\">' "
        f"|| {d.join(d.numbered('p_partkey % 4', 4, author))} || '</div>' "
        "|| case when p_partkey % 6 = 0 then '' else '<section property=\"keywords\"><ol><li><a> ' || p_type || ' </a></li><li><a></a></li><li><a>' || p_brand || '</a></li></ol></section>' end "
        f"|| case when p_partkey % 8 = 0 then '' else '<span class=\"space\"> ' || {d.t('p_size')} || '-X </span>' end "
        f"|| '<span class=\"core-date-published\">' || {day} || '</span>' "
        f"|| {d.join(d.numbered('p_partkey % 5', 5, person))} || '</body></html>'",
    }


def ranking_page_columns(d: Dialect) -> dict[str, str]:
    """A ranking page per row of ``part``: up to 5 table rows, some with two cells, some with a
    year that is not a number."""
    year = f"case when p_partkey % 31 = 0 and i = 2 then 'n.d.' else {d.t('1990 + p_size % 9 + i')} end"
    row = (
        f"'<tr><td>' || p_type || '</td><td> ' || {year} || ' </td>' "
        f"|| case when (p_partkey + i) % 10 = 0 then '' else '<td>Q' || {d.t('1 + (p_partkey + i) % 4')} || '</td>' end || '</tr>'"
    )
    return {
        "page_id": "p_partkey",
        "journal": f"p_brand || ' ' || {d.t('p_partkey')}",
        "html": "'<div class=\"cellslide\"><table><thead><tr><th>a</th></tr></thead><tbody>' || "
        f"{d.join(d.numbered('p_partkey % 6', 6, row))} || '</tbody></table></div>'",
    }


def _replaced(expression: str, changes: list[tuple[str, str]]) -> str:
    for old, new in changes:
        expression = f"replace({expression}, '{old}', '{new}')"
    return expression


def messy_listing_columns(d: Dialect) -> dict[str, str]:
    """The listing pages with what a browser also accepts: nested elements of one name, other quotes,
    comments, scripts, and counters and links outside the items."""
    changes = [
        ("<h5 class=\"issue-heading\">", "<!-- <h5 class=\"issue-heading\">no</h5> --><h5 id=h class=issue-heading><h5></h5>"),
        ("<div class=\"issue-item__detail\">", "<div class=\"x  issue-item__detail\"><div><br></div>"),
        ("<span class=\"metric\">", "<span class=\"icon\"></span><span title=\"a > b\" class=\"metric\"><span></span>"),
        ("<span class=\"citation\">", "<span class=\"citation\"><span class=\"icon\"><span></span></span>"),
        ("<ul>", "<script>var t = \"</li><span class=metric>5</span>\";</script><ul>"),
        ("</ul>", "</ul><div class=\"issue-item__detail\"><a href=\"/share\">share</a></div><span class=\"metric\">999</span><span class=\"citation\">77</span>"),
    ]
    columns = listing_columns(d)
    return columns | {"html": _replaced(columns["html"], changes)}


def messy_article_page_columns(d: Dialect) -> dict[str, str]:
    """The article pages with nested elements of one name, and with other sections that resemble the
    wanted ones. Every tenth page lacks the paragraph of its abstract, every eleventh never closes the
    element of its date."""
    changes = [
        ("<div role=\"paragraph\">", "<div role=\"paragraph\"><div></div>"),
        ("<span class=\"dropBlock\">", "<span class=\"dropBlock\"><span><a href=\"#\">no</a></span>"),
        ("<section property=\"keywords\"><ol>", "<section property=\"keywords\"><section><a>no</a></section><ol>"),
        ("<span class=\"space\">", "<span class=\"space\"><span> </span>"),
        ("<span class=\"auth-institution\">", "<span class=\"auth-institution\"><span></span>"),
        ("</body>", "<footer><section id=\"other\"><div role=\"paragraph\">WRONG</div></section><a title=\"Nobody\">x</a></footer></body>"),
    ]
    columns = article_page_columns(d)
    html = _replaced(columns["html"], changes)
    html = (
        f"case when p_partkey % 10 = 0 then {_replaced(html, [('<div role=\"paragraph\"><div></div>', '<div><div></div>')])} "
        f"when p_partkey % 11 = 0 then {_replaced(html, [('<span class=\"core-date-published\">', '<b class=\"core-date-published\">')])} "
        f"else {html} end"
    )
    return columns | {"html": html}


# Rankings of the journals ("brands") by shipped quantity; a journal has no quartile in most years.
RANKINGS = """
select p_brand as journal, 0 as pos, 'all' as category, year as {q}Year{q}, {q}Quartile{q} from (
  select p_brand, year, case when cast(substr(p_brand, 7) as int) % 3 <> year % 3 then ''
         else 'Q' || cast(ntile(4) over (partition by year order by quantity desc, p_brand) as {text}) end as {q}Quartile{q}
  from (select p_brand, cast(extract(year from l_shipdate) as int) as year, sum(l_quantity) as quantity
        from {lineitem} join {part} on l_partkey = p_partkey group by 1, 2) s) t
"""


def _select(source: str, columns: dict[str, str]) -> str:
    body = ",\n  ".join(f'{e} as "{n}"' for n, e in columns.items())
    return f"select {body}\nfrom {source}"


def duck_views() -> dict[str, str]:
    """The derived inputs as DuckDB queries."""
    return {
        "raw_articles": _select("orders", article_columns(DUCK)),
        "doc_articles": _select("documents", document_columns(DUCK)),
        "listing_pages": _select("part", listing_columns(DUCK)),
        "article_pages": _select("part", article_page_columns(DUCK)),
        "ranking_pages": _select("part", ranking_page_columns(DUCK)),
        "rankings": RANKINGS.format(q='"', text=DUCK.text, lineitem="lineitem", part="part"),
    }


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _heavy_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(table(spark, sf_dir, name))


def _derive(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{e} as `{n}`" for n, e in columns.items()])


def raw_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(table(spark, sf_dir, "orders"), article_columns(SPARK))


def doc_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(_heavy_table(spark, sf_dir, "documents"), document_columns(SPARK))


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _heavy_table(spark, sf_dir, "pages")


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(_heavy_table(spark, sf_dir, "part"), listing_columns(SPARK))


def article_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(_heavy_table(spark, sf_dir, "part"), article_page_columns(SPARK))


def messy_listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(_heavy_table(spark, sf_dir, "part"), messy_listing_columns(SPARK))


def messy_article_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(_heavy_table(spark, sf_dir, "part"), messy_article_page_columns(SPARK))


def ranking_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(_heavy_table(spark, sf_dir, "part"), ranking_page_columns(SPARK))


def rankings(spark: SparkSession, sf_dir: str) -> DataFrame:
    sql = RANKINGS.format(q="`", text=SPARK.text, lineitem="{lineitem}", part="{part}")
    return spark.sql(
        sql, lineitem=table(spark, sf_dir, "lineitem"), part=table(spark, sf_dir, "part")
    )
