"""Saved markup as a list of tags, and an index of the elements that rules look for.

A page is cut at its ``<`` once. Each piece is a tag with the text after it, or plain text if it
isn't a tag; comments, scripts and styles are left out before. The index has an entry for each tag that
a selector may want: where it opens and where the tag stands that closes it, counted by its own name, so
that an inner element of the same name doesn't cut it short. For this the tags of the wanted names are
sorted by name and place, a running sum gives their depths, and at each depth of a name opening and
closing tags alternate. Selectors then compare intervals: an element lies in its container if its tags do.
An element that is never closed isn't found.

All of it is built-in expressions on one page. Lists grow in blocks, and the entries of an item are a slice
of the index, so the cost grows with the length of the page and not with its square.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

# Elements without content, and elements whose content is not markup.
VOID = "area base br col embed hr img input link meta source track wbr".split()
RAW_TEXT = "script|style"

#: Lists that grow in a fold grow in blocks of this length.
_BLOCK = 64
#: Bits of a tag's level and of its place with the closing flag, in the numbers that are sorted: a page may
#: have 2**27 tags, 2**25 levels and 2**9 wanted names.
_LEVEL, _PLACE = 26, 28
_AT = (1 << _PLACE) - 1

# What stands after each "<" of a page up to the next: the whole tag, or nothing if it isn't one.
_NAME = r"[a-zA-Z][^\s/<>]*"
_REST = r"""(?:(?:[^<>"']++|"[^"<]*+"|'[^'<]*+')*+>|[^<>]*+>)"""
_HEADS = f"<(/?{_NAME}{_REST}|)"
_NAMES = f"<(?:/?({_NAME}){_REST}|)"

# Walks are built as SQL text: as nested columns they would take longer to build than to run.
_names = itertools.count()


def _name() -> str:
    return f"x{next(_names)}"


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def each(values: str, use: Callable[[str], str]) -> str:
    """``use`` of every entry of an array."""
    own = _name()
    return f"transform({values}, {own} -> {use(own)})"


def bind(value: str, use: Callable[[str], str]) -> str:
    """``use(value)`` with the value computed once, however often ``use`` mentions it."""
    return f"get({each(f'array({value})', use)}, 0)"


def part(values: str, start: str, length: str) -> str:
    """Entries of an array from ``start``, from 0, on. Unlike ``slice`` it doesn't read the others."""
    k, x = _name(), _name()
    places = f"sequence({start}, {start} + greatest({length}, 1) - 1)"
    return f"filter(transform({places}, {k} -> case when {length} > 0 then get({values}, cast({k} as int)) end), {x} -> {x} is not null)"


@dataclass(frozen=True)
class Selector:
    """An element by its tag, an attribute value, classes; whichever are given must all fit."""

    tag: str | None = None
    attribute: tuple[str, str] | None = None
    classes: tuple[str, ...] = ()

    def may_fit(self, head: str, name: str) -> str:
        """A cheap condition that every opening tag which fits meets."""
        found = [f"{name} = {_quoted(self.tag)}"] if self.tag else []
        found += [f"contains({head}, {_quoted(c)})" for c in self.classes]
        if self.attribute:
            found.append(f"contains(lower({head}), {_quoted(self.attribute[0].lower())})")
        return " and ".join(found) or "true"

    @property
    def by_name(self) -> bool:
        """Whether any element of the name fits."""
        return bool(self.tag and not self.classes and not self.attribute)

    def fits(self, entry: str) -> str:
        found = [f"{entry}.name = {_quoted(self.tag)}"] if self.tag else []
        found += [f"contains({entry}.classes, {_quoted(f' {c} ')})" for c in self.classes]
        if self.attribute:
            name, value = self.attribute
            found.append(f"coalesce({attribute(f'{entry}.head', name)} = {_quoted(value)}, false)")
        return " and ".join(found) or "true"


def of_class(*names: str, tag: str | None = None) -> Selector:
    return Selector(tag, None, names)


def _attribute_pattern(name: str) -> str:
    return (
        r"(?is)^[^\s/>]+(?:[^\x22\x27>]|\x22[^\x22]*\x22|\x27[^\x27]*\x27)*?[\s\x22\x27]"
        + re.escape(name)
        + r"\s*=\s*(?:\x22([^\x22]*)\x22|\x27([^\x27]*)\x27|([^\s\x22\x27>]+))"
    )


def attribute(head: str, name: str) -> str:
    """The value of an attribute in an opening tag, in quotes of either kind or in none; NULL if the
    tag lacks it."""
    pattern = _attribute_pattern(name)
    value = f"regexp_replace({head}, {_quoted(pattern + '.*$')}, '$1$2$3')"
    return f"case when {head} rlike {_quoted(pattern)} then {value} end"


def _without(html: Column, opening: str, closing: str) -> Column:
    """The text without what lies from each ``opening`` to the next ``closing``, or to the end."""
    pieces = F.split(html, opening, -1)
    first = F.slice(pieces, F.lit(1), F.lit(1))
    rest = F.transform(
        F.slice(pieces, F.lit(2), F.size(pieces)),
        lambda p: F.when(
            p.rlike(closing), F.regexp_replace(p, rf"(?is)^.*?{closing.removeprefix('(?i)')}", "")
        ).otherwise(""),
    )
    return F.when(html.rlike(opening), F.array_join(F.concat(first, rest), "")).otherwise(html)


def _cut(df: DataFrame, html: Column, others: Sequence[str]) -> DataFrame:
    """``df`` with a page cut at its ``<``, as lists: ``_texts``, what stands after each tag, ``_heads``, the tags from
    their name on, closing ones from the slash, and ``_names`` in lower case. The first entry has the text
    before the first tag; there and for pieces that are no tags head and name are empty.

    Expressions run over the whole page: one on a single tag costs more than the work it does.
    """
    noted = _without(F.coalesce(html, F.lit("")), "<!--", "-->")
    plain = _without(F.col("_plain"), rf"(?i)<(?=(?:{RAW_TEXT})[\s>])", rf"(?i)</(?:{RAW_TEXT})\s*>")

    def found(pattern: str) -> Column:
        return F.concat(F.array(F.lit("")), F.regexp_extract_all("_plain", F.lit(pattern), F.lit(1)))

    def text(head: Column, k: Column) -> Column:
        piece = F.get("_pieces", k)
        # Other pieces are declarations, which have no text of their own, or text with its "<".
        loose = F.when(
            piece.rlike("^[!?][^>]*>"), F.regexp_replace(piece, "^[!?][^>]*>", "")
        ).otherwise(F.concat(F.lit("<"), piece))
        return (
            F.when(head != "", F.substring(piece, F.length(head) + 1, F.length(piece)))
            .when(k == 0, piece)
            .otherwise(loose)
        )

    return (
        df.select(*others, noted.alias("_plain"))
        .select(*others, plain.alias("_plain"))
        .select(
            *others,
            F.split("_plain", "<", -1).alias("_pieces"),
            found(_HEADS).alias("_heads"),
            F.transform(found(_NAMES), lambda n: F.lower(n)).alias("_names"),
        )
        .select(*others, F.transform("_heads", text).alias("_texts"), "_heads", "_names")
    )


def _classes(head: str) -> str:
    """The class attribute between single spaces, empty without one."""
    pattern = _quoted(_attribute_pattern("class") + ".*$")
    value = f"coalesce(nullif(regexp_replace({head}, {pattern}, '$1$2$3'), {head}), '')"
    spaced = f"concat(' ', regexp_replace({value}, {_quoted(r'\s+')}, ' '), ' ')"
    return f"case when contains(lower({head}), 'class') then {spaced} else '' end"


def running(values: str, add: Callable[[str, str], str], start: str) -> str:
    """What ``add`` makes of the integers of an array up to each of them. They are folded in blocks, which
    are then lifted by what came before them: a fold copies what it holds with each step."""
    k, p, b, y, a = (_name() for _ in range(5))

    def fold(own: str) -> str:
        last = f"coalesce(get({a}, size({a}) - 1), {start})"
        step = f"array_append({a}, {add(last, y)})"  # concat takes several times as long
        return f"aggregate({own}, cast(array() as array<int>), ({a}, {y}) -> {step})"

    def blocks(v: str) -> str:
        numbers = f"sequence(0, greatest(size({v}) - 1, 0) div {_BLOCK})"
        length = f"least(cast(size({v}) - {k} * {_BLOCK} as int), {_BLOCK})"
        return f"transform({numbers}, {k} -> {fold(part(v, f'cast({k} * {_BLOCK} as int)', length))})"

    def lifted(parts: str) -> str:
        ends = fold(each(parts, lambda x: f"coalesce(get({x}, size({x}) - 1), {start})"))
        before = f"slice(concat(array({start}), {ends}), 1, size({parts}))"
        return f"flatten(zip_with({parts}, {before}, ({p}, {b}) -> transform({p}, {y} -> {add(y, b)})))"

    return bind(bind(values, blocks), lifted)


def indexed(
    df: DataFrame, html: Column, others: Sequence[str], selectors: Sequence[Selector], deep: bool = True
) -> DataFrame:
    """The columns ``others`` of ``df`` and a page's index: ``_texts``, the texts of all tags, and ``_entries``,
    ``array<struct<at, last, depth, name, head, classes>>`` of the opening tags that may fit a selector, in
    order. ``last`` is where the closing tag stands, ``at`` for a tag that is its own, NULL without one; ``depth``
    is how many closed elements of its name it lies in, itself included, and NULL unless ``deep``.

    The index is made in steps, a column each, because nested functions are slow to analyse. What a function
    needs of a column is bound outside of it, so that merging the steps can't compute it again and again.
    """
    n, h, e, d, k = (_name() for _ in range(5))
    kinds = " or ".join(sorted({f"({s.may_fit(h, f'get(_names, {k})')})" for s in selectors}))
    fit = f"transform(_heads, ({h}, {k}) -> {h} <> '' and not startswith({h}, '/') and ({kinds}))"
    voids = ", ".join(map(_quoted, VOID))

    # Tags are numbers while they are sorted: name, level, place, and 1 if it closes, from the left; then
    # elements are, as name, place and the place of the closing tag, 0 for none.
    def number(kind: str, at: str, low: str) -> str:
        return f"shiftleft(shiftleft({kind}, {_PLACE - 1}) + {at}, {_PLACE - 1}) + {low}"

    def present(values: str) -> str:
        return f"filter({values}, {e} -> {e} is not null)"

    def itself(name: str, head: str) -> str:
        """Whether an opening tag closes itself."""
        return f"(endswith({head}, '/>') or {name} in ({voids}))"

    def kind(names: str) -> str:
        return f"array_position({names}, {n})"

    def events(names: str) -> str:
        head = f"get(_heads, {k})"
        closes = f"case when startswith({head}, '/') then 1 when {itself(n, head)} then null else 0 end"
        code = f"shiftleft({kind(names)}, {_PLACE}) + 2 * {k} + {closes}"
        own = f"transform(_names, ({n}, {k}) -> case when array_contains({names}, {n}) then {code} end)"
        return f"sort_array({present(own)})"

    def alone(names: str) -> str:
        own = f"case when get(_fit, {k}) and {itself(n, f'get(_heads, {k})')} then {number(kind(names), k, k)} end"
        return present(f"transform(_names, ({n}, {k}) -> {own})")

    def depths(found: str) -> str:
        steps = each(found, lambda x: f"1 - 2 * cast({x} & 1 as int)")
        return running(steps, lambda a, b: f"{a} + {b}", "0")

    def levels(found: str) -> str:
        level = f"{d} - 1 + cast({e} & 1 as int) + {1 << (_LEVEL - 1)}"
        code = f"shiftleft(shiftleft(shiftright({e}, {_PLACE}), {_LEVEL}) + {level}, {_PLACE}) + ({e} & {_AT})"
        return f"sort_array(zip_with({found}, {depths(found)}, ({e}, {d}) -> {code}))"

    def pairs(found: str) -> str:
        # On a level of a name the next event after an opening tag closes it.
        after = f"get({found}, {k} + 1)"
        same = f"shiftright({after}, {_PLACE}) = shiftright({e}, {_PLACE})"
        last = f"case when {same} then shiftright({after} & {_AT}, 1) else 0 end"
        pair = number(f"shiftright({e}, {_PLACE + _LEVEL})", f"shiftright({e} & {_AT}, 1)", last)
        wanted = "" if deep else f" and get(_fit, cast(shiftright({e} & {_AT}, 1) as int))"
        return present(f"transform({found}, ({e}, {k}) -> case when ({e} & 1) = 0{wanted} then {pair} end)")

    at, last = f"(shiftright({e}, {_PLACE - 1}) & {_AT >> 1})", f"({e} & {_AT >> 1})"
    closed = f"filter(_pairs, {e} -> {last} > 0)"
    name = f"shiftleft(shiftright({e}, {2 * _PLACE - 2}), {_PLACE})"
    both = f"array({name} + 2 * {at}, {name} + 2 * {last} + 1)"
    nested = f"sort_array(flatten(transform({closed}, {e} -> {both})))"

    def depth_of(found: str) -> str:
        place = f"shiftleft(shiftright({e} & {_AT}, 1), 32)"
        own = f"zip_with({found}, {depths(found)}, ({e}, {d}) -> case when ({e} & 1) = 0 then {place} + {d} end)"
        open_ones = f"transform(filter(_pairs, {e} -> {last} = 0), {e} -> shiftleft({at}, 32))"
        return f"sort_array(concat({present(own)}, {open_ones}))"

    placed = f"sort_array(transform(_pairs, {e} -> shiftleft({at}, 32) + {last}))"
    place = f"cast(shiftright({e}, 32) as int)"
    head = f"get(_heads, {place})"

    def entry(depth: str) -> str:
        return (
            f"named_struct('at', {place}, 'last', nullif(cast({e} & {(1 << 32) - 1} as int), 0), 'depth', {depth}, "
            f"'name', get(_names, {place}), 'head', {head}, 'classes', {bind(head, _classes)})"
        )

    depth = f"cast({d} & {(1 << 32) - 1} as int)"
    entries = f"transform({placed}, {e} -> {entry('cast(null as int)')})"
    if deep:
        one = f"case when get(_fit, {place}) then {entry(depth)} end"
        entries = present(f"zip_with({placed}, _depths, ({e}, {d}) -> {one})")

    def used(names: str) -> str:
        return f"array_distinct(filter({names}, ({n}, {k}) -> get(_fit, {k})))"

    lists = ["_texts", "_heads", "_names", "_fit"]
    read = (
        _cut(df, html, others)
        .select(*others, *lists[:-1], F.expr(fit).alias("_fit"))
        .select(*others, *lists, F.expr(used("_names")).alias("_used"))
        .select(
            *others,
            *lists,
            F.expr(bind("_used", alone)).alias("_single"),
            F.expr(bind(bind("_used", events), levels)).alias("_levels"),
        )
        .select(*others, *lists, F.expr(f"concat({bind('_levels', pairs)}, _single)").alias("_pairs"))
    )
    if deep:
        read = read.withColumn("_depths", F.expr(bind(nested, depth_of)))
    return read.select(*others, "_texts", F.expr(entries).alias("_entries"))


def of_page(use: Callable[[Scope], str]) -> Column:
    """``use`` of a whole page, from its index."""
    return F.expr(bind("_texts", lambda x: bind("_entries", lambda e: use(Scope(e, x)))))


@dataclass(frozen=True)
class Scope:
    """What selectors look into: SQL of index entries, of the place where their container ends, if not
    at the end of the page, and of the texts of the page's tags."""

    entries: str
    texts: str
    end: str | None = None

    def _fits(self, x: str, selector: Selector) -> str:
        return selector.fits(x) + (f" and {x}.at < {self.end}" if self.end else "")

    def _closed(self, x: str) -> str:
        return f"{x}.last < {self.end}" if self.end else f"{x}.last is not null"

    def opening(self, selector: Selector) -> str:
        """The opening tags that fit, as entries; they need not be closed."""
        x = _name()
        return f"filter({self.entries}, {x} -> {self._fits(x, selector)})"

    def first(self, path: Sequence[Selector], use: Callable[[str], str]) -> str:
        """``use`` of the entry of the first closed element of the path, each looked for in the first of the
        one before; NULL without one."""
        *outer, selector = path
        if outer:
            return self.within(outer, lambda inner: inner.first([selector], use))

        def found(x: str) -> str:
            return f"case when {self._closed(x)} then {use(x)} end"

        return bind(f"get({self.opening(selector)}, 0)", found)

    def within(self, path: Sequence[Selector], use: Callable[[Scope], str]) -> str:
        """``use`` of the first closed element of the path as a scope; NULL without one."""
        selector, *rest = path

        def found(x: str) -> str:
            y = _name()

            def inner(entries: str) -> str:
                scope = Scope(entries, self.texts, f"greatest({x}.last, {x}.at + 1)")
                return scope.within(rest, use) if rest else use(scope)

            return bind(f"filter({self.entries}, {y} -> {y}.at >= {x}.at)", inner)

        return self.first([selector], found)

    def elements(self, selector: Selector) -> str:
        """The closed elements that fit, outermost only, as ``struct<k, at, last, depth>``; ``k`` is their number
        in the scope."""
        x, k, i = _name(), _name(), _name()
        hit = f"case when {self._fits(x, selector)} and {self._closed(x)} then {_place(x, k)} end"
        hits = f"filter(transform({self.entries}, ({x}, {k}) -> {hit}), {x} -> {x} is not null)"

        def outermost(found: str) -> str:
            def clear(ends: str) -> str:
                return f"filter({found}, ({x}, {i}) -> {x}.at > coalesce(get({ends}, {i} - 1), -1))"

            if selector.by_name:
                # All of the name fit, and those beside the first are as deep as it.
                return f"filter({found}, {x} -> {x}.depth = get({found}, 0).depth)"
            furthest = running(f"{found}.last", lambda a, b: f"greatest({a}, {b})", "-1")
            return f"case when size({found}) < 2 then {found} else {bind(furthest, clear)} end"

        return bind(hits, outermost)

    def inside(self, selector: Selector) -> str:
        """The same as ``struct<entries, end>``: the entries in each element, and where it ends."""
        x, i, y = _name(), _name(), _name()

        def cut(found: str) -> str:
            stop = f"coalesce(get({found}, {i} + 1).k, size({self.entries}))"
            own = part(self.entries, f"{x}.k", f"({stop} - {x}.k)")
            end = f"greatest({x}.last, {x}.at + 1)"
            made = f"named_struct('entries', filter({own}, {y} -> {y}.at < {end}), 'end', {end})"
            return f"transform({found}, ({x}, {i}) -> {made})"

        return bind(self.elements(selector), cut)

    def items(self, selector: Selector) -> str:
        """``struct<whole, entries, end>`` of each opening tag that fits: what lies from it to the end of the
        element, if it closes before the next one opens (``whole``), or else to the next one."""
        x, k, i = _name(), _name(), _name()
        starts = (
            f"filter(transform({self.entries}, ({x}, {k}) -> case when {self._fits(x, selector)} "
            f"then {_place(x, k)} end), {x} -> {x} is not null)"
        )

        def cut(found: str) -> str:
            after = f"get({found}, {i} + 1)"
            upto = f"coalesce({after}.at, size({self.texts}))"
            whole = f"coalesce({x}.last < {upto}, false)"
            own = part(self.entries, f"{x}.k", f"(coalesce({after}.k, size({self.entries})) - {x}.k)")
            end = f"case when {whole} then greatest({x}.last, {x}.at + 1) else {upto} end"
            return f"transform({found}, ({x}, {i}) -> named_struct('whole', {whole}, 'entries', {own}, 'end', {end}))"

        return bind(starts, cut)

    def text(self, entry: str) -> str:
        """The text of an element as it stands in the page."""
        k = _name()
        own = f"transform(sequence({entry}.at, {entry}.last - 1), {k} -> get({self.texts}, {k}))"
        return f"case when {entry}.last > {entry}.at then array_join({own}, '') else '' end"


def _place(entry: str, number: str) -> str:
    return f"named_struct('k', {number}, 'at', {entry}.at, 'last', {entry}.last, 'depth', {entry}.depth)"
