"""Chat formatting by schema fingerprints, with DataFrame functions only.

A record is a JSON text of unknown layout, or a struct column of Spark. The hash of the nested field paths that it has,
of those that some mapping names, is its fingerprint. Each declared mapping has one fingerprint for every choice of
its optional paths; a record's fingerprint is looked up in the map of them, and the mapping found converts the record
into canonical turns (role, text). A template then marks the turns, escapes control strings inside texts reversibly
and keeps the spans that count for the loss.

Defined cases. A null text is empty, a null role is empty. A record that cannot be read, or whose fingerprint no
mapping declares (it lacks a path, or has those of two layouts), keeps its row with layout 'unknown', no turns and an
empty formatted text; paths that no mapping names do not matter. A JSON text may be as long as Spark's variant allows
(128 MB in all, 20 million characters in a string), else it cannot be read; turns of a table never pass through JSON
and have no such limit. Turns of a table are ordered by turn (null first), then role and text; repeated rows are
repeated turns. A null conversation id is one conversation. An empty table gives no rows; further columns pass
through format_chats, and those named like a new one give way; columns of a turn table beside the four are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from itertools import chain, combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType


@dataclass(frozen=True)
class Mapping:
    """A layout: the paths that a record must have, and where its turns are.

    fields: (role, path) in order, for flat layouts; a missing or null optional field makes no turn. turns: the path
    of a list of objects, with the names of its role and text fields, and roles that are renamed."""

    name: str
    needs: tuple[str, ...]
    fields: tuple[tuple[str, str], ...] = ()
    turns: str = ""
    role: str = ""
    text: str = ""
    renamed: tuple[tuple[str, str], ...] = ()

    def variants(self) -> Iterable[tuple[str, ...]]:
        """The paths that a record of this layout may have, of those that it names."""
        optional = [path for _, path in self.fields if path not in self.needs]
        return ((*self.needs, *more) for more in chain.from_iterable(combinations(optional, n) for n in range(len(optional) + 1)))


MAPPINGS = (
    Mapping("messages", ("messages[].role", "messages[].content"), turns="messages", role="role", text="content"),
    Mapping("conversations", ("conversations[].from", "conversations[].value"), turns="conversations", role="from", text="value", renamed=(("human", "user"), ("gpt", "assistant"))),
    Mapping("instruction", ("instruction", "output"), fields=(("system", "system"), ("user", "instruction"), ("user", "input"), ("assistant", "output"))),
    Mapping("prompt", ("prompt", "response"), fields=(("system", "system"), ("user", "prompt"), ("assistant", "response"))),
    Mapping("completion", ("prompt", "completion"), fields=(("system", "system"), ("user", "prompt"), ("assistant", "completion"))),
    Mapping("question", ("question", "answer"), fields=(("system", "system"), ("user", "question"), ("assistant", "answer"))),
)

TURN_END = "<|end|>"
#: In this order to escape; undone from the last to the first.
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&lb;"))
#: Further, in roles only: a role ends at a bar.
ROLE_ESCAPES = (*ESCAPES, ("|", "&bar;"))


def paths_of(schema: Column) -> Column:
    """The field paths in a variant's schema text, as ' a b[].c ': types go, nesting stays."""
    # OBJECT<a: STRING, b: ARRAY<OBJECT<c: BIGINT>>> has names before ': ' and marks where objects and lists open.
    bare = F.regexp_replace(schema, r"OBJECT<", "{")
    bare = F.regexp_replace(bare, r"ARRAY<", "[")
    bare = F.regexp_replace(bare, r": (?:[A-Z_]+(?:\([0-9, ]+\))?)", "")
    return F.regexp_replace(F.regexp_replace(bare, r"(?<=[\[{])[A-Z_]+(?:\([0-9, ]+\))?>", ">"), r": ", "")


def declared_paths(mappings: tuple[Mapping, ...]) -> list[str]:
    """All paths that a mapping names, sorted."""
    return sorted({path for m in mappings for variant in m.variants() for path in variant})


def fingerprint(paths: Column) -> Column:
    """The hash of a sorted array of field paths."""
    return F.xxhash64(F.array_join(paths, "\n"))


def layouts(mappings: tuple[Mapping, ...]) -> Column:
    """The map from each declared fingerprint to its mapping's name; of two mappings with one fingerprint the first counts."""
    named = {tuple(sorted(variant)): m.name for m in reversed(mappings) for variant in m.variants()}
    return F.create_map(*[x for paths, name in named.items() for x in (fingerprint(F.array(*map(F.lit, paths))), F.lit(name))])


def _has(skeleton: Column, path: str) -> Column:
    """Whether a skeleton such as {a, b[{c, d>>> has the path b[].c or a."""
    outer, _, inner = path.partition("[].")
    if inner:
        return skeleton.rlike(rf"^\{{(?:.*, )?{outer}\[\{{(?:[^>]*, )?{inner}[,>]")
    return skeleton.rlike(rf"^\{{(?:.*, )?{outer}[,>\[\{{]")


def paths_of_type(kind: DataType, at: str = "") -> list[str]:
    """The nested field paths of a struct type, as a or b[].c."""
    if isinstance(kind, ArrayType):
        return paths_of_type(kind.elementType, f"{at}[]")
    if isinstance(kind, StructType):
        return [p for f in kind for p in paths_of_type(f.dataType, f"{at}.{f.name}" if at else f.name)]
    return [at]


def escape(text: Column, table: tuple[tuple[str, str], ...] = ESCAPES) -> Column:
    for plain, safe in table:
        text = F.replace(text, F.lit(plain), F.lit(safe))
    return text


def unescape(text: Column, table: tuple[tuple[str, str], ...] = ESCAPES) -> Column:
    for plain, safe in reversed(table):
        text = F.replace(text, F.lit(safe), F.lit(plain))
    return text


def _turn(m: Mapping) -> Callable[[Column], Column]:
    """From an object of m's list to role and text."""

    def one(x: Column) -> Column:
        role = F.coalesce(x[m.role], F.lit(""))
        for old, new in m.renamed:
            role = F.when(x[m.role] == old, new).otherwise(role)
        return F.struct(role.alias("role"), F.coalesce(x[m.text], F.lit("")).alias("text"))

    return one


TURNS = "array<struct<role:string,text:string>>"


def _converted(df: DataFrame, paths: Column, text: Callable[[str], Column], listed: Callable[[Mapping], Column], mappings: tuple[Mapping, ...]) -> DataFrame:
    """df with fingerprint (of the array paths), layout (looked up by it) and turns (by the mapping of that layout)."""
    df = df.drop("fingerprint", "layout", "turns").withColumn("fingerprint", fingerprint(paths))
    df = df.withColumn("layout", F.coalesce(F.element_at(layouts(mappings), F.col("fingerprint")), F.lit("unknown")))
    turns = F.array().cast(TURNS)
    for m in mappings:
        if m.turns:
            made = F.coalesce(F.transform(listed(m), _turn(m)), F.array().cast(TURNS))
        else:
            parts = [F.when(F.lit(path in m.needs) | text(path).isNotNull(), F.struct(F.lit(role).alias("role"), F.coalesce(text(path), F.lit("")).alias("text"))) for role, path in m.fields]
            made = F.filter(F.array(*parts), lambda x: x.isNotNull())
        turns = F.when(F.col("layout") == m.name, made).otherwise(turns)
    return df.withColumn("turns", turns)


def canonical(records: DataFrame, column: str = "record", mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """records with fingerprint, layout and turns (array of role, text) for the JSON text or the struct in column."""
    kind, declared = records.schema[column].dataType, declared_paths(mappings)
    df = records.withColumn("__v", F.col(column) if isinstance(kind, StructType) else F.try_parse_json(F.col(column)))
    if isinstance(kind, StructType):
        held = [p for p in declared if p in paths_of_type(kind)]
        paths = F.array(*map(F.lit, held)) if held else F.array().cast("array<string>")
        absent = lambda kind: F.lit(None).cast(kind)
        text = lambda path: F.col(f"__v.{path}").cast("string") if path in held else absent("string")
        listed = lambda m: F.col(f"__v.{m.turns}") if set(m.needs) <= set(held) else absent(f"array<struct<{m.role}:string,{m.text}:string>>")
        return _converted(df, paths, text, listed, mappings).drop("__v")
    df = df.withColumn("__skeleton", F.coalesce(paths_of(F.schema_of_variant("__v")), F.lit("")))
    paths = F.filter(F.array(*[F.when(_has(F.col("__skeleton"), p), p) for p in declared]), lambda x: x.isNotNull())
    listed = lambda m: F.try_variant_get("__v", f"$.{m.turns}", f"array<struct<{m.role}:string,{m.text}:string>>")
    return _converted(df, paths, lambda path: F.try_variant_get("__v", f"$.{path}", "string"), listed, mappings).drop("__v", "__skeleton")


def render(turns: Column) -> Column:
    """The formatted text: <|role|>text<|end|> for each turn, roles and texts escaped."""
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit("<|"), escape(t["role"], ROLE_ESCAPES), F.lit("|>"), escape(t["text"]), F.lit(TURN_END))), "")


def read_back(formatted: Column) -> Column:
    """The turns (role, text) that a formatted text holds."""
    pieces = F.filter(F.split(formatted, r"<\|end\|>"), lambda p: p != "")
    part = lambda p, n, table: unescape(F.regexp_extract(p, r"(?s)^<\|(.*?)\|>(.*)$", n), table)
    return F.transform(pieces, lambda p: F.struct(part(p, 1, ROLE_ESCAPES).alias("role"), part(p, 2, ESCAPES).alias("text")))


def loss_spans(turns: Column, learned: str = "assistant") -> Column:
    """Where the formatted text counts for the loss: (start, length) in code points from 0, one for each text of the learned role."""
    sized = F.transform(turns, lambda t: F.struct(t["role"].alias("role"), F.length(escape(t["role"], ROLE_ESCAPES)).alias("r"), F.length(escape(t["text"])).cast("long").alias("n")))
    empty = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"))

    def step(acc: Column, t: Column) -> Column:
        start = acc["at"] + t["r"] + 4
        grown = F.when(t["role"] == learned, F.concat(acc["spans"], F.array(F.struct(start.alias("start"), t["n"].alias("length"))))).otherwise(acc["spans"])
        return F.struct((start + t["n"] + len(TURN_END)).alias("at"), grown.alias("spans"))

    return F.aggregate(sized, empty, step, lambda acc: acc["spans"])


def format_chats(records: DataFrame, column: str = "record", mappings: tuple[Mapping, ...] = MAPPINGS, learned: str = "assistant") -> DataFrame:
    """records with fingerprint, layout, turns, formatted and loss_spans."""
    df = canonical(records, column, mappings)
    return df.withColumns({"formatted": render(F.col("turns")), "loss_spans": loss_spans(F.col("turns"), learned)})


def records_of_turns(turns: DataFrame) -> DataFrame:
    """A table of rows by turn (conv_id, turn, role, text) as conv_id and record, a struct of its messages."""
    row = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("content"))
    order = ("turn", "role", "content")

    def compare(a: Column, b: Column) -> Column:
        out = F.lit(0)
        for name in reversed(order):
            x, y = a[name], b[name]
            out = F.when(x.isNull() & y.isNotNull(), -1).when(x.isNotNull() & y.isNull(), 1).when(x < y, -1).when(x > y, 1).otherwise(out)
        return out

    listed = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(row), compare).alias("m"))
    return listed.select("conv_id", F.struct(F.transform("m", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))).alias("messages")).alias("record"))
