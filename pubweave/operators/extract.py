"""Saved pages to records, driven by rules.

A rule names a field and the selectors that find it, so a new page template is new data, not new code.
Elements are found in the list of a page's tags (``markup``): each ends at its own closing tag, and a
field is looked for only inside its container. Everything is a built-in expression on one page row: no
shuffle and no Python in the tasks, and the cost grows with the length of the page.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from pubweave.functions import (
    decode_entities,
    last_comma_split,
    metric_long,
    parse_day_month_year,
    plain_text,
    publication_date_parts,
    strip,
)
from pubweave.operators import markup
from pubweave.operators.markup import Scope, Selector, of_class
from pubweave.schema import AFFILIATION
from pubweave.storage import store

# Reasons for rejecting a page or an item as a whole.
NO_ITEMS = "items"
UNCLOSED = "unclosed item"


@dataclass(frozen=True)
class Rule:
    """How to read one field.

    ``path`` are selectors, each inside the one before; the first element found counts, or all with
    ``many``. The value is the element's text, with whitespace runs collapsed unless ``collapse`` is
    off, or the ``attribute`` of its opening tag. A value that is absent becomes ``default``; without
    a default the field is NULL, and a ``required`` one, which must not be blank either, sends the
    record to the rejects. For lists ``drop_empty`` removes empty entries and applies the default to
    an empty list; otherwise the default counts where the first selector finds nothing. ``page_scope``
    searches the whole page instead of the item.
    """

    field: str
    path: tuple[Selector, ...]
    attribute: str | None = None
    many: bool = False
    collapse: bool = True
    default: str | None = None
    required: bool = False
    drop_empty: bool = False
    page_scope: bool = False

    def raw(self, scope: Scope) -> str:
        """SQL of what stands in the page, one text or a list; NULL where there is nothing."""
        *outer, last = self.path
        if not self.many:
            if not self.attribute:
                return scope.first(self.path, scope.text)

            def read(inside: Scope) -> str:
                opened = f"get({inside.opening(last)}, 0).head"
                return markup.bind(opened, lambda head: markup.attribute(head, self.attribute))

            return scope.within(outer, read) if outer else read(scope)
        return self._all(scope, self.path)

    def _all(self, scope: Scope, path: Sequence[Selector]) -> str:
        """The list of what the path finds; NULL if the first selector finds nothing."""
        selector, *rest = path
        if not rest:
            if self.attribute:
                found = markup.each(scope.opening(selector), lambda e: markup.attribute(f"{e}.head", self.attribute))
            else:
                found = markup.each(scope.elements(selector), scope.text)
            if path is not self.path:
                return found
            return markup.bind(found, lambda values: f"case when size({values}) > 0 then {values} end")

        def below(parts: str) -> str:
            inner = markup.each(
                parts, lambda p: self._all(Scope(f"{p}.entries", scope.texts, f"{p}.end"), rest)
            )
            some = f"case when size({parts}) > 0 then flatten({inner}) end"
            return some if path is self.path else f"flatten({inner})"

        return markup.bind(scope.inside(selector), below)

    @property
    def cleaning(self) -> tuple[bool, bool]:
        """Rules that agree in this clean what they found alike."""
        return self.attribute is not None, self.collapse

    def value(self, text: Column) -> Column:
        """The field, from a cleaned text or list."""
        if not self.many:
            if self.required:
                text = F.when(strip(text) != "", text)
            return F.coalesce(text, F.lit(self.default))
        fallback = F.lit(None) if self.default is None else F.array(F.lit(self.default))
        values = F.transform(F.filter(text, lambda v: v.isNotNull()), strip)
        if self.drop_empty:
            values = F.filter(values, lambda v: v != "")
            return F.when(F.size(values) > 0, values).otherwise(fallback)
        return F.coalesce(values, fallback)


def _clean(raw: Column, cleaning: tuple[bool, bool]) -> Column:
    attribute, collapse = cleaning
    return decode_entities(raw) if attribute else plain_text(raw, collapse)


def _values(rules: Sequence[Rule], raw: Callable[[Rule], Column]) -> list[Column]:
    """The fields of the rules, from what stands in the page. All texts that are cleaned alike are cleaned
    as one list, for an expression costs more to make than to run."""
    cleaned: dict[str, Column] = {}
    for cleaning in dict.fromkeys(r.cleaning for r in rules):
        alike = [r for r in rules if r.cleaning == cleaning]
        no_list = F.lit(None).cast("array<string>")
        lists = F.array(*[raw(r) if r.many else F.array(raw(r)) for r in alike] or [no_list])
        texts = F.transform(lists, lambda values: F.transform(values, lambda v: _clean(v, cleaning)))  # noqa: B023
        for k, rule in enumerate(alike):
            cleaned[rule.field] = texts[k] if rule.many else texts[k][0]
    return [r.value(cleaned[r.field]).alias(r.field) for r in rules]


def _raw_struct(scope: Scope, rules: Sequence[Rule], *more: str) -> str:
    return f"named_struct({', '.join([*more, *(f'{_quoted(r.field)}, {r.raw(scope)}' for r in rules)])})"


def _selectors(rules: Sequence[Rule], *more: Selector | None) -> list[Selector]:
    return [*(s for r in rules for s in r.path), *(s for s in more if s is not None)]


def _deep(rules: Sequence[Rule]) -> bool:
    """Whether the rules look for all elements of a name, for which depths are needed."""
    return any(r.many and any(s.by_name for s in r.path) for r in rules)


def _items(scope: Scope, rules: Sequence[Rule], item: Selector) -> str:
    return markup.each(
        scope.items(item),
        lambda p: _raw_struct(
            Scope(f"{p}.entries", scope.texts, f"{p}.end"), rules, _quoted("whole"), f"{p}.whole"
        ),
    )


def _quoted(name: str) -> str:
    return f"'{name}'"


def extracted_items(
    pages: DataFrame,
    rules: Sequence[Rule],
    item: Selector | None = None,
    carry: Sequence[str] = ("page_id", "url"),
) -> DataFrame:
    """Carried columns, ``position``, the fields and ``reason`` of saved pages ``(page_id, url, html)``.

    Each element that fits ``item`` is an item; without it a page is one item. ``position`` numbers
    the items of a page from 0. ``reason`` is NULL for a record; otherwise it names the first
    required field that is missing, or says that an item isn't closed, or, once a page, that it has
    no items. A page is read once. Pages that have an index already, of these rules' selectors at least,
    are taken as they are.
    """
    carried = [c for c in carry if c in pages.columns]
    of_page = [r for r in rules if r.page_scope]
    of_item = [r for r in rules if not r.page_scope]
    read = pages
    if "_entries" not in pages.columns:
        read = markup.indexed(pages, F.col("html"), carried, _selectors(rules, item), _deep(rules))

    def raw_items(scope: Scope) -> str:
        if item is None:
            return f"array({_raw_struct(scope, of_item, _quoted('whole'), 'true')})"
        return _items(scope, of_item, item)

    found = read.select(
        *carried,
        *([markup.of_page(lambda scope: _raw_struct(scope, of_page)).alias("_page")] if of_page else []),
        F.posexplode_outer(markup.of_page(raw_items)).alias("position", "_item"),
    )

    fields = _values(rules, lambda r: F.col("_page" if r.page_scope else "_item")[r.field])
    cleaned = found.select(
        *carried,
        "position",
        F.when(F.col("_item").isNull(), NO_ITEMS)
        .when(~F.col("_item.whole"), UNCLOSED)
        .alias("_whole"),
        *fields,
    )
    missing = [
        F.when(F.col(r.field).isNull(), F.lit(r.field))
        for r in rules
        if r.required and r.default is None
    ]
    return cleaned.withColumn("reason", F.coalesce("_whole", *missing)).drop("_whole")


def records_of(extracted: DataFrame) -> DataFrame:
    return extracted.filter(F.col("reason").isNull()).drop("reason")


def rejects_of(extracted: DataFrame, carry: Sequence[str] = ("page_id", "url")) -> DataFrame:
    kept = [c for c in carry if c in extracted.columns]
    return extracted.filter(F.col("reason").isNotNull()).select(*kept, "position", "reason")


def extract_items(
    pages: DataFrame,
    rules: Sequence[Rule],
    item: Selector | None = None,
    carry: Sequence[str] = ("page_id", "url"),
) -> tuple[DataFrame, DataFrame]:
    """``(records, rejects)`` of ``extracted_items``; every item lands in exactly one of the two. Store
    ``extracted_items`` and split it if both are wanted, so that pages are read once."""
    extracted = extracted_items(pages, rules, item, carry)
    return records_of(extracted), rejects_of(extracted, carry)


def absolute_url(link: Column, page_url: Column) -> Column:
    """A link as a browser reports it: resolved against the address of its page."""
    link = strip(link)
    scheme = F.regexp_extract(page_url, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1)
    site = F.regexp_extract(page_url, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    path = F.regexp_extract(page_url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    folder = F.regexp_replace(path, r"[^/]*$", "")
    query = F.regexp_extract(page_url, r"(\?[^#]*)", 1)

    def joined(target: Column) -> Column:
        route = F.regexp_extract(target, r"^([^?#]*)", 1)
        rest = F.substring(target, F.length(route) + 1, F.length(target))
        return F.concat(site, _without_dots(route), rest)

    return (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), link)
        .when(link.startswith("//"), F.concat(scheme, link))
        .when(link.startswith("/"), joined(link))
        .when(link.startswith("?"), F.concat(site, path, link))
        .when(link.startswith("#"), F.concat(site, path, query, link))
        .otherwise(joined(F.concat(F.when(folder == "", "/").otherwise(folder), link)))
    )


def _without_dots(path: Column) -> Column:
    """A path without ``.`` and ``..`` segments."""
    segments = F.split(path, "/")
    last = F.element_at(segments, -1)
    ended = F.when(last.isin(".", ".."), F.concat(segments, F.array(F.lit("")))).otherwise(segments)
    kept = F.aggregate(
        ended,
        F.array().cast("array<string>"),
        lambda a, s: F.when(s == ".", a)
        .when(s == "..", F.slice(a, F.lit(1), F.greatest(F.size(a) - 1, F.least(F.size(a), F.lit(1)))))
        .otherwise(F.concat(a, F.array(s))),
    )
    return F.when(path.rlike(r"(?:^|/)\.\.?(?:/|$)"), F.array_join(kept, "/")).otherwise(path)


# Classes and identifiers of the page templates the default rules read.
ITEM_CLASSES = ("issue-item", "issue-item--search", "clearfix")
HEADING_CLASS = "issue-heading"
DETAIL_CLASS = "issue-item__detail"
DOWNLOADS_CLASS = "metric"
CITATIONS_CLASS = "citation"
TITLE_CLASS = "hlFld-Title"
SUBTITLE_CLASS = "hlFld-SubTitle"
AUTHOR_LIST_CLASS = "authors"
AUTHOR_BLOCK_CLASS = "dropBlock"
ISSN_CLASS = "space"
DATE_CLASS = "core-date-published"
AUTHOR_SECTION_CLASS = "authInfo"
AUTHOR_NAME_CLASS = "auth-name"
INSTITUTION_CLASS = "auth-institution"
RANKING_BOX_CLASS = "cellslide"

LISTING_ITEM = of_class(*ITEM_CLASSES)
_DETAIL_LINK = (of_class(DETAIL_CLASS), Selector("a"))


def _by_class(field: str, name: str, **options) -> Rule:
    return Rule(field, (of_class(name),), **options)


def listing_rules(heading_of_page: bool = False) -> list[Rule]:
    """Fields of one search result. ``heading_of_page`` gives all items the page's first heading."""
    return [
        _by_class("type", HEADING_CLASS, default="Unknown", page_scope=heading_of_page),
        Rule("link", _DETAIL_LINK, attribute="href", required=True),
        Rule("publisher", _DETAIL_LINK, attribute="title", default=""),
        _by_class("downloads_text", DOWNLOADS_CLASS, default="N/A"),
        _by_class("citations_text", CITATIONS_CLASS, default="N/A"),
        _by_class("main_title", TITLE_CLASS, required=True),
        _by_class("sub_title", SUBTITLE_CLASS, default=""),
    ]


def article_rules() -> list[Rule]:
    """Fields of an article page."""
    keywords = Selector("section", ("property", "keywords"))
    return [
        Rule(
            "abstract",
            (Selector("section", ("id", "abstract")), Selector("div", ("role", "paragraph"))),
            required=True,
        ),
        Rule(
            "authors",
            (of_class(AUTHOR_LIST_CLASS), of_class(AUTHOR_BLOCK_CLASS), Selector("a")),
            attribute="title",
            many=True,
            drop_empty=True,
            default="Unknown",
        ),
        Rule(
            "keywords",
            (keywords, Selector("ol"), Selector("li"), Selector("a")),
            many=True,
            collapse=False,
            default="N/A",
        ),
        _by_class("issn", ISSN_CLASS, collapse=False, default="N/A"),
        _by_class("published", DATE_CLASS, required=True),
    ]


_SECTION_RULES = [
    _by_class("author", AUTHOR_NAME_CLASS),
    _by_class("affiliation", INSTITUTION_CLASS),
]


_SECTION = of_class(AUTHOR_SECTION_CLASS, tag="div")


def raw_sections() -> Column:
    """``array<struct<whole, author, affiliation>>`` of an article page, from its index; NULL fields where a part
    is absent."""
    return markup.of_page(lambda page: _items(page, _SECTION_RULES, _SECTION))


def author_sections(raw: Column) -> Column:
    return F.transform(
        raw, lambda s: F.struct(*_values(_SECTION_RULES, lambda r: F.when(s["whole"], s[r.field])))
    )


def extract_affiliations(articles: DataFrame, sections: str = "sections") -> DataFrame:
    """Replace ``sections`` (author, affiliation) by the three affiliation columns of an article.

    University and country are the parts around the last comma of the affiliation text. If there
    is no section, or one lacks a part, the whole article has unknown affiliations.
    """

    def affiliation(s: Column) -> Column:
        university, country = last_comma_split(s["affiliation"])
        return F.struct(
            s["author"].alias("author"),
            university.alias("university"),
            country.alias("country"),
            s["affiliation"].alias("location"),
        )

    section = F.col(sections)
    usable = (F.size(section) > 0) & F.forall(
        section, lambda s: s["author"].isNotNull() & s["affiliation"].isNotNull()
    )
    nothing = F.array().cast(T.ArrayType(AFFILIATION))
    split = F.when(usable, F.transform(section, affiliation)).otherwise(nothing)
    unknown = F.array(F.lit("Unknown"))
    return (
        articles.withColumn("authors_with_affiliations", split)
        .withColumn(
            "universities",
            F.when(usable, F.col("authors_with_affiliations.university")).otherwise(unknown),
        )
        .withColumn(
            "countries",
            F.when(usable, F.col("authors_with_affiliations.country")).otherwise(unknown),
        )
        .drop(sections)
    )


def extracted_listing(pages: DataFrame, heading_of_page: bool = False) -> DataFrame:
    """Search results ``(doi, publisher, type, ...)`` of listing pages, with ``reason``."""
    extracted = extracted_items(pages, listing_rules(heading_of_page), LISTING_ITEM)
    return extracted.withColumn("doi", absolute_url(F.col("link"), F.col("url"))).drop("link")


def extract_listing(
    pages: DataFrame, heading_of_page: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Search results of listing pages, and the rejects."""
    extracted = extracted_listing(pages, heading_of_page)
    return records_of(extracted), rejects_of(extracted)


def extracted_article_pages(pages: DataFrame) -> DataFrame:
    """Fields of article pages with their affiliations, with ``reason``; ``position`` is always 0."""
    rules = article_rules()
    # One index for both: an entry depends on the tags of its own name alone.
    selectors = _selectors([*rules, *_SECTION_RULES], _SECTION)
    read = markup.indexed(pages, F.col("html"), ["page_id", "url"], selectors).withColumn("_raw", raw_sections())
    with_sections = read.withColumn("sections", author_sections(F.col("_raw")))
    extracted = extracted_items(with_sections, rules, carry=("page_id", "url", "sections"))
    return extract_affiliations(extracted)


def extract_article_pages(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Fields of article pages with their affiliations, and the rejects."""
    extracted = extracted_article_pages(pages)
    return records_of(extracted).drop("position"), rejects_of(extracted)


def latest_page(pages: DataFrame, key: str = "url") -> DataFrame:
    """One row per ``url``, or other key, the copy saved last (largest ``page_id``).

    Copies are combined map-side, so many copies of one page never meet in one task. Pages without
    ``page_id`` are distinguished by what they hold.
    """
    others = [c for c in pages.columns if c != key]
    by = F.col("page_id") if "page_id" in others else F.xxhash64(*others)
    return (
        pages.groupBy(key)
        .agg(F.max_by(F.struct(*others), by).alias("_page"))
        .select(key, "_page.*")
    )


def build_articles(
    items: DataFrame,
    article_pages: DataFrame,
    topic: str,
    website: str,
    run_date: dt.date | Column,
) -> tuple[DataFrame, DataFrame]:
    """``(articles, rejects)``: each search result completed by the page it links to.

    ``page_id`` and ``position`` after the article columns tell where the result stood.
    An item without a saved page, or with a counter that is not a number, is a reject. The page
    side has one row per url and is written before the join, so adaptive execution can split an
    item key that is very frequent.
    """
    one_page = store(latest_page(article_pages), "article-pages").table.select(
        *[
            F.col(c).alias("_url" if c == "url" else c)
            for c in article_pages.columns
            if c != "page_id"
        ]
    )
    joined = items.join(one_page, items.doi == F.col("_url"), "left")
    date = parse_day_month_year(F.col("published"), run_date)
    completed = joined.withColumns(
        {
            "Downloads": metric_long(F.col("downloads_text")),
            "citations": metric_long(F.col("citations_text")),
        }
    )
    completed = completed.withColumn(
        "reason",
        F.when(F.col("_url").isNull(), F.lit("article page"))
        .when(F.col("Downloads").isNull(), F.lit("downloads"))
        .when(F.col("citations").isNull(), F.lit("citations")),
    )
    articles = completed.filter(F.col("reason").isNull()).select(
        strip(F.concat_ws(" ", "main_title", "sub_title")).alias("title"),
        "authors",
        "authors_with_affiliations",
        *[c.alias(n) for n, c in publication_date_parts(date).items()],
        "abstract",
        "doi",
        "Downloads",
        "citations",
        "type",
        F.struct(
            F.col("publisher").alias("name"),
            F.col("issn").alias("ISSN"),
            F.lit(None).cast("string").alias("Quartile"),
        ).alias("publisher"),
        "universities",
        "countries",
        "keywords",
        F.lit(topic).alias("topic"),
        F.lit(website).alias("website"),
        "page_id",
        "position",
    )
    rejects = completed.filter(F.col("reason").isNotNull()).select(
        "page_id", "url", "position", "doi", "reason"
    )
    return articles, rejects


def extract_rankings(
    pages: DataFrame,
    journal: str = "journal",
    strict: bool = True,
) -> DataFrame:
    """Ranking rows ``(journal, pos, category, Year, Quartile)`` of saved ranking pages.

    Only rows of exactly three cells count. With ``strict`` one unreadable year voids all rows of
    its page, otherwise only its own row. The page decides by itself, without a regrouping.
    """
    read = pages.select(F.col(journal).alias("journal"), "html")
    body = (of_class(RANKING_BOX_CLASS), Selector("table"), Selector("tbody"))

    def cells_of(row: str, texts: str) -> str:
        inside = Scope(f"{row}.entries", texts, f"{row}.end")
        return markup.each(inside.elements(Selector("td")), inside.text)

    def rows_of(scope: Scope) -> str:
        return markup.each(scope.inside(Selector("tr")), lambda row: cells_of(row, scope.texts))

    selectors = [*body, Selector("tr"), Selector("td")]
    rows = markup.of_page(lambda page: page.within(body, rows_of))
    read = markup.indexed(read, F.col("html"), ["journal"], selectors).select(
        "journal", F.coalesce(rows, F.array()).alias("_rows")
    )

    def cells(row: Column) -> Column:
        return F.transform(row, lambda c: plain_text(c))

    def entry(row: Column) -> Column:
        whole = F.when(row[1].rlike(r"^[+-]?\d+$"), row[1]).try_cast("int")
        return F.struct(
            row[0].alias("category"), whole.alias("Year"), row[2].alias("Quartile")
        )

    three = F.filter(F.transform("_rows", lambda r: cells(r)), lambda r: F.size(r) == 3)
    entries = F.transform(three, entry)
    if strict:
        # One page, one list of entries: kept whole or not at all.
        entries = F.flatten(
            F.filter(F.array(entries), lambda es: F.forall(es, lambda e: e["Year"].isNotNull()))
        )
    listed = read.select("journal", F.posexplode(entries).alias("pos", "_entry")).select(
        "journal", "pos", "_entry.*"
    )
    return listed if strict else listed.filter(F.col("Year").isNotNull())
