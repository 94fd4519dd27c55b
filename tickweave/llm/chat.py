"""Chat formatting by schema fingerprints, in DataFrame functions only.

Records come in many layouts: prompt and completion, instruction with input and
output, lists of messages, one row per turn.  The nested field paths that a
record fills are hashed, and the fingerprint selects a declarative mapping that
turns the record into canonical turns (record id, turn, role, text).  Turns are
then written with a template whose marks are control strings; control strings
inside texts are escaped reversibly, and the characters of the assistant's
texts form the loss mask.  ``read_back`` recovers turns and masked text from the
written record alone.

Defined results: a null text is empty; a null role is the role 'user' in a
layout that gives roles per turn; turns come by turn number (nulls first), ties
by role and text, repeated rows stay; records of no known layout keep a row
with a null layout and no turns; columns that no layout names are ignored; in a
table with the columns of one row per turn, a record that fills any of them, or
no known path at all, is a turn, and its other columns are ignored; a record
must fit into one value (2 GB).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from hashlib import sha256

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window


@dataclass(frozen=True)
class Layout:
    """A record layout: the paths that mark it, paths that may be missing, and where the turns are.

    ``turns`` lists (role, path) for texts at fixed paths, several paths joined
    by a blank line; ``messages`` is (array, role path, text path) for lists;
    ``by_row`` is (turn path, role path, text path) for one row per turn; any of
    its values may be null, so every subset of its paths marks it where the
    table has them all.
    """

    name: str
    needs: tuple[str, ...]
    may: tuple[str, ...] = ()
    turns: tuple[tuple[str, tuple[str, ...]], ...] = ()
    messages: tuple[str, str, str] | None = None
    by_row: tuple[str, str, str] | None = None
    roles: dict[str, str] = field(default_factory=dict)


#: Public record layouts and their role names.
LAYOUTS = (
    Layout("prompt_completion", ("prompt", "completion"), ("system",), (("system", ("system",)), ("user", ("prompt",)), ("assistant", ("completion",)))),
    Layout("prompt_response", ("prompt", "response"), ("system",), (("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",)))),
    Layout("instruction", ("instruction", "output"), ("input", "system"), (("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",)))),
    Layout("question_answer", ("question", "answer"), ("context",), (("user", ("context", "question")), ("assistant", ("answer",)))),
    Layout("messages", ("messages[].content", "messages[].role"), messages=("messages", "role", "content")),
    Layout("conversations", ("conversations[].from", "conversations[].value"), messages=("conversations", "from", "value"),
           roles={"human": "user", "gpt": "assistant"}),
    Layout("turn_rows", ("role", "text", "turn"), by_row=("turn", "role", "text")),
)


@dataclass(frozen=True)
class Template:
    """Marks around the texts of each role; other roles name themselves in the open mark."""

    marks: dict[str, tuple[str, str]] = field(default_factory=lambda: {
        "user": ("[INST] ", " [/INST]"), "system": ("[SYS] ", " [/SYS]"), "assistant": ("<s>", "</s>")})
    other: tuple[str, str, str] = ("[ROLE] ", " [/ROLE]", "[/TURN]")
    learnt: str = "assistant"


#: Control strings (a bracket, a body, a closing bracket); none holds a bracket after its first character.
CONTROL = r"/?s>|/?INST\]|/?SYS\]|/?ROLE\]|/TURN\]"
TEMPLATE = Template()


def paths_of(kind: T.DataType, prefix: str = "") -> list[str]:
    """Nested field paths of a schema, arrays written [], in order of name."""
    if isinstance(kind, T.StructType):
        return sorted(p for f in kind.fields for p in paths_of(f.dataType, f"{prefix}.{f.name}" if prefix else f.name))
    if isinstance(kind, T.ArrayType):
        return paths_of(kind.elementType, f"{prefix}[]")
    return [prefix]


def _known(layouts: tuple[Layout, ...]) -> set[str]:
    return {p for x in layouts for p in x.needs + x.may}


def _at(path: str) -> Column:
    return reduce(lambda c, name: c[name], path.split(".")[1:], F.col(f"`{path.split('.')[0]}`"))


def fingerprint(paths: Column) -> Column:
    """Hash of an array of field paths in sorted order."""
    return F.sha2(F.array_join(F.array_sort(paths), "\n"), 256)


def _row_layout(schema: T.StructType, layouts: tuple[Layout, ...]) -> Layout | None:
    """The layout of one row per turn whose paths the table has."""
    have = set(paths_of(schema))
    return next((x for x in layouts if x.by_row and set(x.needs) <= have), None)


def row_fingerprint(schema: T.StructType, layouts: tuple[Layout, ...] = LAYOUTS) -> Column:
    """The fingerprint of the known paths that a row fills; an array fills its elements' paths unless it is null.

    A row that fills paths of the table's layout by rows counts with these alone.
    """
    def filled(paths: set[str]) -> Column:
        marks = [F.when(_at(p.split("[]")[0]).isNotNull(), F.lit(p)) for p in paths_of(schema) if p in paths]
        return F.filter(F.array(*marks), lambda p: p.isNotNull()) if marks else F.array().cast("array<string>")

    paths, rows = filled(_known(layouts)), _row_layout(schema, layouts)
    if rows:
        own = filled({*rows.needs, *rows.may})
        paths = F.when(F.size(own) > 0, own).otherwise(paths)
    return fingerprint(paths)


def _selected(layouts: tuple[Layout, ...]) -> list[tuple[Layout, list[str]]]:
    """Each layout's path lists: its needed paths with every subset of those that may be missing (one row per turn: of all)."""
    out = []
    for x in layouts:
        needs, may = ((), x.needs + x.may) if x.by_row else (x.needs, x.may)
        subsets = [[]]
        for p in may:
            subsets += [s + [p] for s in subsets]
        out += [(x, sorted([*needs, *s])) for s in subsets]
    return out


def _mapping(layout: Layout, have: list[str]) -> Column:
    """The canonical turns of a record of this layout: array of (turn, role, text)."""
    def turn(i, role, text):
        return F.struct(i.cast("long").alias("turn"), role.alias("role"), F.coalesce(text, F.lit("")).alias("text"))

    if layout.messages:
        array, role, text = layout.messages
        names = F.create_map(*[F.lit(v) for pair in layout.roles.items() for v in pair]) if layout.roles else None

        def message(m, i):
            r = m[role].cast("string")
            return turn(i, F.coalesce(names[r], r, F.lit("user")) if names is not None else F.coalesce(r, F.lit("user")), m[text].cast("string"))

        return F.transform(_at(array), message)
    if layout.by_row:
        number, role, text = (_at(p) for p in layout.by_row)
        return F.array(turn(number, F.coalesce(role.cast("string"), F.lit("user")), text.cast("string")))
    used = [(role, [p for p in paths if p in have]) for role, paths in layout.turns]
    return F.array(*[turn(F.lit(i), F.lit(role), F.concat_ws("\n\n", *[_at(p).cast("string") for p in paths])) for i, (role, paths) in enumerate((r, p) for r, p in used if p)])


def canonical_turns(records: DataFrame, id_col: str, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """(record_id, layout, turn, role, text): the turns of every record, by the mapping that its fingerprint selects."""
    schema = records.schema
    have, rows = set(paths_of(schema)), _row_layout(schema, layouts)
    choices = [(x, paths) for x, paths in _selected(layouts) if set(paths) <= have and (x is rows or not x.by_row)]
    # one mapping for each layout and its paths that say where turns are; one row per turn has one for all its path lists
    mappings: list[tuple[Layout, list[list[str]]]] = []
    for x, paths in choices:
        if x.by_row and mappings and mappings[-1][0] is x:
            mappings[-1][1].append(paths)
        else:
            mappings.append((x, [paths]))
    marked = records.select(F.col(f"`{id_col}`").alias("record_id"), row_fingerprint(schema, layouts).alias("mark"),
                            *[_mapping(x, lists[0]).alias(f"turns_{i}") for i, (x, lists) in enumerate(mappings)])
    name, turns = F.lit(None).cast("string"), F.lit(None).cast("array<struct<turn:bigint,role:string,text:string>>")
    for i, (x, lists) in enumerate(mappings):
        hit = F.col("mark").isin(*[sha256("\n".join(paths).encode()).hexdigest() for paths in lists])
        name, turns = F.when(hit, F.lit(x.name)).otherwise(name), F.when(hit, F.col(f"turns_{i}")).otherwise(turns)
    told = marked.select("record_id", name.alias("layout"), F.explode_outer(turns).alias("t"))
    return told.select("record_id", "layout", "t.turn", "t.role", "t.text")


def canonical_json(lines: DataFrame, id_col: str, json_col: str, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """``canonical_turns`` of JSON records, each parsed with the fields of all layouts; broken JSON has no known layout."""
    tree: dict = {}
    for path in sorted(_known(layouts)):
        node = tree
        *parents, leaf = path.split(".")
        for p in parents:
            node = node.setdefault(p, {})
        node[leaf] = None

    def kind(node: dict) -> T.StructType:
        return T.StructType([T.StructField(k.removesuffix("[]"), T.StringType() if v is None else T.ArrayType(kind(v)) if k.endswith("[]") else kind(v)) for k, v in node.items()])

    rows_only = {p for x in layouts if x.by_row for p in x.needs}
    shape = T.StructType([f for f in kind(tree).fields if f.name not in rows_only - {p for x in layouts if not x.by_row for p in x.needs + x.may}])
    parsed = lines.select(F.col(f"`{id_col}`").alias("record_id"), F.from_json(F.col(f"`{json_col}`").cast("string"), shape).alias("r"))
    return canonical_turns(parsed.select("record_id", *[F.col(f"r.`{f.name}`") for f in shape.fields]), "record_id", layouts)


def escape(text: Column) -> Column:
    """Backslashes doubled, one put behind the bracket of every control string."""
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), rf"([<\[])({CONTROL})", "$1\\\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _around(role: Column, template: Template) -> tuple[Column, Column]:
    """Open and close mark of a turn."""
    head, neck, tail = template.other
    opened, closed = F.concat(F.lit(head), escape(role), F.lit(neck)), F.lit(tail)
    for name, (a, b) in template.marks.items():
        opened, closed = F.when(role == name, F.lit(a)).otherwise(opened), F.when(role == name, F.lit(b)).otherwise(closed)
    return opened, closed


def format_turns(turns: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """(record_id, formatted, loss_spans): a record's turns in the template; spans are (start, length) in code points from 0."""
    opened, closed = _around(F.col("role"), template)
    pieces = turns.select("record_id", "turn", "role", "text", opened.alias("opened"), escape(F.col("text")).alias("body"), closed.alias("closed"))
    pieces = pieces.withColumn("piece", F.concat("opened", "body", "closed"))
    order = Window.partitionBy("record_id").orderBy("turn", "role", "text")
    before = F.coalesce(F.sum(F.length("piece")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = pieces.select("record_id", F.row_number().over(order).alias("i"), "piece", (before + F.length("opened")).cast("long").alias("start"),
                           F.when(F.col("role") == template.learnt, F.length("body")).cast("long").alias("length"))
    whole = placed.groupBy("record_id").agg(F.sort_array(F.collect_list(F.struct("i", "piece", "start", "length"))).alias("p"))
    learnt = F.filter("p", lambda x: x["length"].isNotNull())
    return whole.select("record_id", F.array_join(F.transform("p", lambda x: F.coalesce(x["piece"], F.lit(""))), "").alias("formatted"),
                        F.transform(learnt, lambda x: F.struct(x["start"].alias("start"), x["length"].alias("length"))).alias("loss_spans"))


def _literal(mark: str) -> str:
    return "".join("\\" + c if not c.isalnum() and not c.isspace() else c for c in mark)


def read_back(formatted: Column, template: Template = TEMPLATE) -> Column:
    """The turns of a written record: array of (role, text), unescaped."""
    head, neck, tail = map(_literal, template.other)
    forms = [(name, rf"{_literal(a)}(.*?){_literal(b)}") for name, (a, b) in template.marks.items()]
    whole = "|".join([*[p.replace("(.*?)", ".*?") for _, p in forms], f"{head}.*?{neck}.*?{tail}"])

    def turn(x: Column) -> Column:
        role, text = F.regexp_extract(x, f"(?s)^{head}(.*?){neck}", 1), F.regexp_extract(x, f"(?s)^{head}.*?{neck}(.*){tail}$", 1)
        for name, (a, b) in template.marks.items():
            hit = F.startswith(x, F.lit(a))
            role = F.when(hit, F.lit(name)).otherwise(role)
            text = F.when(hit, F.substr(x, F.lit(len(a) + 1), F.length(x) - (len(a) + len(b)))).otherwise(text)
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

    return F.transform(F.regexp_extract_all(formatted, F.lit(f"(?s)({whole})"), F.lit(1)), turn)


def masked_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    part = F.transform(spans, lambda x: unescape(F.substr(formatted, (x["start"] + 1).cast("int"), x["length"].cast("int"))))
    return F.array_join(part, "")
