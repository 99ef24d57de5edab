"""Chat formatting by schema fingerprints.

Records come as JSON in whatever layout their source used: a prompt with its completion, an instruction
with input and output, a list of messages under some name. The nested field paths of a record (not its
values) are hashed to a fingerprint. Each known layout is declared once, as an example of its shape and a
mapping from its fields to turns; the fingerprint of a record selects the mapping. The turns are then put
into one template whose control strings are escaped inside texts, so that they can be read back exactly,
and the assistant's texts are marked by spans.

Only DataFrame functions are used. Work is row by row: one record is one row, so a conversation must
fit into one, and the only shuffle is the one that ``gather`` needs. A variant holds 16 MB at most. So the
records that ``gather`` makes hold numbers of turns in place of their texts, which lie beside them, and a long
dialogue is several records of one layout; longer JSON from elsewhere counts as malformed. Null or malformed
records, and records of an unknown layout, have null ``turns`` and the layout ``unknown``. Null roles and
texts count as empty. Equal records give equal rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from pubweave.llm.common import column, fresh

TURNS = "array<struct<role:string,text:string>>"
#: Turns in a record of a gathered dialogue.
BLOCK = 10_000
START, END, TARGET = "<|im_start|>", "<|im_end|>\n", "assistant"
#: Other names of the canonical roles, in layouts that use them.
SHARE_NAMES = {"human": "user", "gpt": "assistant"}


def _get(record: Column, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(record, path, kind)


def _text(record: Column, path: str) -> Column:
    return F.coalesce(_get(record, path), F.lit(""))


def _turn(role: str, text: Column) -> Column:
    return F.array(F.struct(F.lit(role).alias("role"), text.alias("text")))


def _listed(
    path: str, role: str, text: str, names: dict[str, str] = {}
) -> Callable[[Column], Column]:
    """Turns from a list of objects; ``role`` and ``text`` are their fields, ``names`` other names of
    the canonical roles."""

    def turns(record: Column) -> Column:
        items = _get(record, path, f"array<struct<`{role}`:string,`{text}`:string>>")
        return F.transform(
            items,
            lambda m: F.struct(
                _role_named(m[role], names).alias("role"),
                F.coalesce(m[text], F.lit("")).alias("text"),
            ),
        )

    return turns


def _role_named(role: Column, names: dict[str, str]) -> Column:
    made = F.when(role.isNull(), "")
    for name, canonical in names.items():
        made = made.when(role == name, canonical)
    return made.otherwise(role)


def _one(*fields: tuple[str, str]) -> Callable[[Column], Column]:
    """One turn a field, as (role, field); the roles of a fixed layout."""

    def turns(record: Column) -> Column:
        return F.concat(*(_turn(role, _text(record, f"$.{field}")) for role, field in fields))

    return turns


def _instruction(record: Column) -> Column:
    given = _text(record, "$.input")
    asked = F.concat(_text(record, "$.instruction"), F.when(given == "", "").otherwise(F.concat(F.lit("\n\n"), given)))
    return F.concat(_turn("user", asked), _turn("assistant", _text(record, "$.output")))


@dataclass(frozen=True)
class Layout:
    """A declared layout: example records that show its field paths, and the mapping to turns."""

    name: str
    examples: tuple[str, ...]
    turns: Callable[[Column], Column]


LAYOUTS = (
    Layout(
        "messages",
        ('{"messages":[{"role":"","content":""}]}', '{"messages":[]}'),
        _listed("$.messages", "role", "content"),
    ),
    Layout(
        "shares",
        ('{"conversations":[{"from":"","value":""}]}', '{"conversations":[]}'),
        _listed("$.conversations", "from", "value", SHARE_NAMES),
    ),
    Layout("completion", ('{"prompt":"","completion":""}',), _one(("user", "prompt"), ("assistant", "completion"))),
    Layout("response", ('{"prompt":"","response":""}',), _one(("user", "prompt"), ("assistant", "response"))),
    Layout(
        "system",
        ('{"system":"","prompt":"","completion":""}',),
        _one(("system", "system"), ("user", "prompt"), ("assistant", "completion")),
    ),
    Layout("question", ('{"question":"","answer":""}',), _one(("user", "question"), ("assistant", "answer"))),
    Layout(
        "instruction",
        ('{"instruction":"","input":"","output":""}', '{"instruction":"","output":""}'),
        _instruction,
    ),
)


def fingerprint(record: Column) -> Column:
    """Hash of a variant's nested field paths; the types of its values don't count."""
    shape = F.schema_of_variant(record)
    return F.xxhash64(F.regexp_replace(shape, r": (?!OBJECT<|ARRAY<)[A-Z][A-Z0-9(),]*", ":"))


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, inside of other functions too."""
    return F.transform(F.array(value), use)[0]


def turns_of(json: Column, layouts: tuple[Layout, ...] = LAYOUTS) -> Column:
    """Struct of ``layout`` and ``turns`` for a column of JSON records."""

    def mapped(record: Column, found: Column) -> Column:
        layout, turns = F.lit("unknown"), F.lit(None).cast(TURNS)
        for known in layouts:
            shapes = [fingerprint(F.parse_json(F.lit(example))) for example in known.examples]
            same = reduce(lambda a, b: a | b, (found == shape for shape in shapes))
            layout = F.when(same, known.name).otherwise(layout)
            turns = F.when(same, known.turns(record)).otherwise(turns)
        return F.struct(layout.alias("layout"), turns.cast(TURNS).alias("turns"))

    return _once(
        F.try_parse_json(json), lambda r: _once(fingerprint(r), lambda found: mapped(r, found))
    )


def turns_of_blocks(records: Column, given: Column) -> Column:
    """The same for a list of records of one layout, in which numbers stand for the turns of ``given``: for
    their texts, and for roles that a layout leaves as they are."""

    def looked_up(turn: Column) -> Column:
        role = F.get(given, turn["role"].try_cast("int"))["role"]
        text = F.get(given, turn["text"].try_cast("int"))["text"]
        return F.struct(F.coalesce(role, turn["role"]).alias("role"), text.alias("text"))

    def joined(made: Column) -> Column:
        turns = F.transform(F.flatten(F.transform(made, lambda m: m["turns"])), looked_up)
        return F.struct(made[0]["layout"].alias("layout"), turns.alias("turns"))

    return _once(F.transform(records, lambda r: turns_of(r)), joined)


def escape(text: Column) -> Column:
    """No ``<|`` is left: each ``<``, backslashes, ``|`` gets one backslash more."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _role_in(role: Column) -> Column:
    """A role on one line."""
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def _role_out(line: Column) -> Column:
    plain = F.regexp_replace(unescape(line), r"(?<!\\)((?:\\\\)*)\\n", "$1\n")
    return F.replace(plain, F.lit("\\\\"), F.lit("\\"))


def render(turns: Column) -> Column:
    """The template: a start mark, the role, a line feed, the text, an end mark for each turn."""
    one = F.transform(
        turns,
        lambda t: F.concat(
            F.lit(START), _role_in(t["role"]), F.lit("\n"), escape(t["text"]), F.lit(END)
        ),
    )
    return F.array_join(one, "")


def loss_spans(turns: Column) -> Column:
    """Where the assistant's texts lie in the rendered text: ``array<struct<start,length>>``, in code
    points from 0."""
    heads = F.transform(
        turns,
        lambda t: F.struct(
            (F.length(_role_in(t["role"])) + F.lit(len(START) + 1)).cast("long").alias("head"),
            F.length(escape(t["text"])).cast("long").alias("body"),
            (t["role"] == TARGET).alias("target"),
        ),
    )
    span = "struct<start:bigint,length:bigint,target:boolean>"
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<{span}>").alias("spans"))
    walked = F.aggregate(
        heads,
        start,
        lambda done, t: F.struct(
            (done["at"] + t["head"] + t["body"] + F.lit(len(END))).alias("at"),
            F.concat(
                done["spans"],
                F.when(
                    t["target"],
                    F.array(
                        F.struct(
                            (done["at"] + t["head"]).alias("start"),
                            t["body"].alias("length"),
                            t["target"].alias("target"),
                        )
                    ),
                ).otherwise(F.array().cast(f"array<{span}>")),
            ).alias("spans"),
        ),
    )
    return F.transform(
        walked["spans"], lambda s: F.struct(s["start"].alias("start"), s["length"].alias("length"))
    )


def read_back(rendered: Column) -> Column:
    """The turns of a rendered text."""
    # The text ends with an end mark, so the last piece is empty.
    pieces = F.filter(F.split(rendered, r"<\|im_end\|>\n"), lambda p: p.startswith(START))
    return F.transform(
        pieces,
        lambda p: F.struct(
            _role_out(F.substring_index(F.substring(p, len(START) + 1, 2**31 - 1), "\n", 1)).alias("role"),
            unescape(
                F.substring(p, F.locate("\n", p) + F.lit(1), F.length(p))
            ).alias("text"),
        ),
    )


def masked(rendered: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    texts = F.transform(
        spans,
        lambda s: unescape(
            F.substring(rendered, (s["start"] + F.lit(1)).cast("int"), s["length"].cast("int"))
        ),
    )
    return F.array_join(texts, "")


def format_records(records: DataFrame, json: str = "record", given: str | None = None) -> DataFrame:
    """All columns of ``records`` but ``json`` and ``given``, with ``layout``, ``turns``, ``formatted`` and
    ``loss_spans``. The caller's columns of those names are replaced. With ``given``, the column of the turns
    that ``json`` refers to, it is a list of records (``gather``)."""
    found = turns_of(column(json)) if given is None else turns_of_blocks(column(json), column(given))
    name = fresh(records, "made")
    made = records.withColumn(name, found)
    turns = column(name)["turns"]
    replaced = {json, given, "layout", "turns", "formatted", "loss_spans"}
    return made.select(
        *[column(c) for c in records.columns if c not in replaced],
        column(name)["layout"].alias("layout"),
        turns.alias("turns"),
        render(turns).alias("formatted"),
        loss_spans(turns).alias("loss_spans"),
    )


def gather(rows: DataFrame) -> DataFrame:
    """A row per conversation from rows (conv_id, turn, role, text): ``conv_id``, ``record``, and ``given``, its
    turns as (role, text). ``record`` is a list of JSON records, one for every ``BLOCK`` turns, in which the
    number of a turn stands for its text, and for its role where that is free.

    Turns are ordered by ``turn``, then role and text; null ``conv_id`` is a group of its own. The
    layout depends on the roles: two turns become a prompt with its completion, a system text before
    them a record with three fields, other dialogues of user and assistant a list of shares, and all
    else a list of messages.
    """
    turn = F.struct(
        F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    grouped = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    given = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    numbered = F.transform("given", lambda t, k: F.struct(k.cast("string").alias("k"), t["role"].alias("role")))
    known = grouped.select("conv_id", given.alias("given")).withColumn("numbers", numbered)
    opening = F.array_join(F.transform(F.slice("numbers", 1, 4), lambda t: F.left(t["role"], F.lit(10))), "\n")

    def record(**fields: Column) -> Column:
        return F.array(F.to_json(F.struct(*(c.alias(n) for n, c in fields.items()))))

    def blocks(name: str, entry: Callable[[Column], Column]) -> Column:
        starts = F.sequence(F.lit(1), F.size("numbers"), F.lit(BLOCK))
        return F.transform(
            starts,
            lambda s: F.to_json(F.struct(F.transform(F.slice("numbers", s, F.lit(BLOCK)), entry).alias(name))),
        )

    share_role = lambda t: F.when(t["role"] == "user", "human").otherwise("gpt")
    two, three = [F.lit(str(k)) for k in range(2)], [F.lit(str(k)) for k in range(3)]
    made = (
        F.when(opening == "user\nassistant", record(prompt=two[0], completion=two[1]))
        .when(
            opening == "system\nuser\nassistant",
            record(system=three[0], prompt=three[1], completion=three[2]),
        )
        .when(
            F.forall("numbers", lambda t: t["role"].isin("user", "assistant")),
            blocks("conversations", lambda t: F.struct(share_role(t).alias("from"), t["k"].alias("value"))),
        )
        .otherwise(blocks("messages", lambda t: F.struct(t["k"].alias("role"), t["k"].alias("content"))))
    )
    return known.select("conv_id", made.alias("record"), "given")
