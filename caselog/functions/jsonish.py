"""Reading JSON objects out of model answers.

Objects are read as flat maps of text, so no schema has to be guessed and a repeated key takes its
last value. Wrapping the text in brackets makes the reader strict: text after the object is refused.
"""

from __future__ import annotations

import ast
import json
import unicodedata
from collections.abc import Callable

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

STRICT = {"allowSingleQuotes": "false"}
OBJECT_SHAPE = r"(?s)^\s*\{.*\}\s*$"
# Text of any other shape cannot be such JSON: an object goes on with a quote and never ends in a comma.
# Asking first is cheaper than a failed read, which raises errors within Spark.
JSON_OBJECT = r"(?s)^\s*\{\s*(?:\}|\".*[^,\s]\s*\})\s*$"
OTHER_SHAPE = r"(?s)^\s*(?:\[.*\]|\".*\"|-?[0-9][0-9.eE+\-]*|-?INF|-?Infinity|NaN|true|false|null)\s*$"


def _ranges(codes: set[int]) -> str:
    """Code points as the inside of a character class, neighbours as one range."""
    starts = sorted(c for c in codes if c - 1 not in codes)
    ends = sorted(c for c in codes if c + 1 not in codes)
    return "".join(f"\\x{{{first:x}}}-\\x{{{last:x}}}" for first, last in zip(starts, ends))


# Characters beyond ASCII that the compatibility form leaves as they are: Latin letters, common marks.
STABLE = {c for c in range(0xA1, 0x180) if unicodedata.normalize("NFKC", chr(c)) == chr(c)} | set(map(ord, "“”‘’„«»–—•"))
# Any other character beyond ASCII. The long class is only tried where the short one matched.
UNSTABLE = rf"[^\x00-\x7f](?<![{_ranges(STABLE)}])"
CONTROL = r"[\x00-\x1f\x7f]"
FENCE = r"(?is)```(?:json)?\s*(.*?)\s*```"

# Typographic quotes and the plain quote each stands for.
SMART_QUOTES = {
    "“": '"',
    "”": '"',
    "„": '"',
    "‟": '"',
    "«": '"',
    "»": '"',
    "‘": "'",
    "’": "'",
    "‚": "'",
}


def _in_list(text: Column) -> Column:
    return F.concat(F.lit("["), text, F.lit("]"))


def _last_wins(entries: Column) -> Column:
    """The map without earlier copies of a repeated key."""
    pairs = F.map_entries(entries)
    keys = F.map_keys(entries)
    kept = F.filter(pairs, lambda e, i: ~F.array_contains(F.slice(keys, i + 2, F.size(keys)), e["key"]))
    repeated = F.size(F.array_distinct(keys)) < F.size(keys)
    return F.when(repeated, F.map_from_entries(kept)).otherwise(entries)


def with_items(df: DataFrame, text: str, kind: str | T.DataType, name: str) -> DataFrame:
    """Adds the objects that `text` lists. A projection of its own, so the costly read happens once per row
    however often its result is used."""
    likely = F.when(F.col(text).rlike(JSON_OBJECT), F.col(text))
    schema = f"array<{kind}>" if isinstance(kind, str) else T.ArrayType(kind)
    return df.withColumn(name, F.from_json(_in_list(likely), schema, STRICT))


TEXTS = "map<string,string>"


def has_object(items: str) -> Column:
    """True where the list of objects holds exactly one."""
    return F.coalesce((F.size(items) == 1) & F.get(items, F.lit(0)).isNotNull(), F.lit(False))


def only_object(items: str) -> Column:
    """The one object of a list of maps, else null."""
    return F.when(F.size(items) == 1, _last_wins(F.get(items, F.lit(0))))


def with_object(df: DataFrame, text: str, name: str) -> DataFrame:
    """Adds map<string,string> of text that is exactly one JSON object, else null."""
    items = f"_{name}_items"
    return with_items(df, text, TEXTS, items).withColumn(name, only_object(items)).drop(items)


def with_kinds(df: DataFrame, text: str, name: str, keys: list[str] | None = None) -> DataFrame:
    """Adds the JSON type per key of an object: STRING, BIGINT, BOOLEAN, VOID, ARRAY..., OBJECT...

    A map of all keys, or a struct of the wanted ones: then no other value is read, and a missing key gives null.
    """
    items, first = f"_{name}_items", f"_{name}_first"
    if keys is None:
        read = with_items(df, text, "map<string,variant>", items).withColumn(first, only_object(items))
        kinds = F.transform_values(first, lambda _, v: F.schema_of_variant(v))
        return pinned(read, **{name: kinds}).drop(items, first)
    wanted = T.StructType([T.StructField(key, T.VariantType()) for key in keys])
    read = with_items(df, text, wanted, items)
    read = read.withColumn(first, F.when(F.size(items) == 1, F.get(items, F.lit(0))))
    kinds = F.struct(*[F.schema_of_variant(F.col(first)[key]).alias(key) for key in keys])
    return read.withColumn(name, kinds).drop(items, first)


def pinned(df: DataFrame, **values: Column) -> DataFrame:
    """Adds computed columns that later steps read instead of recomputing.

    Spark folds filters, and the inputs of chained Python functions, into the expressions below
    them, repeating every step in between. A one-element generator keeps the two apart.
    """
    row = F.struct(*[value.alias(name) for name, value in values.items()])
    kept = [F.col(c) for c in df.columns if c not in values]
    computed = df.select(*kept, row.alias("_row"))
    return computed.select(*kept, F.explode(F.array("_row")).alias("_pin")).select(*kept, "_pin.*")


def is_other_json(text: Column) -> Column:
    """Valid JSON that is not an object: a list, a text, a number, true, false or null."""
    items = F.from_json(_in_list(text), "array<string>", STRICT)
    return F.coalesce(F.when(text.rlike(OTHER_SHAPE), F.size(items) == 1), F.lit(False))


def _changed(texts: pa.Array, wanted: pa.Array, change: Callable[[str], str | None]) -> pa.Array:
    """The texts, the wanted ones changed.

    Every text crosses to Python and back. While rows are in Python, Spark keeps them whole in a queue that
    goes to disk, and sends more as long as the pipes take them. Nulls weigh nothing, so a task's rows
    would all end in that queue; with their texts, the pipes fill after a few megabytes.
    """
    chosen = [change(text) for text in texts.filter(wanted).to_pylist()]
    return pc.replace_with_mask(texts, wanted, pa.array(chosen, texts.type)) if chosen else texts


@F.arrow_udf(T.StringType())
def _nfkc(texts: pa.Array, wanted: pa.Array) -> pa.Array:
    return _changed(texts, wanted, lambda text: unicodedata.normalize("NFKC", text))


def nfkc(text: Column, wanted: Column | None = None) -> Column:
    """Compatibility form of the wanted texts. Python changes only text that may change.

    Latin letters with accents are their own compatibility form, so Spanish text stays as it is.
    """
    odd = (F.octet_length(text) != F.char_length(text)) & text.rlike(UNSTABLE)
    return _nfkc(text, F.coalesce(odd if wanted is None else wanted & odd, F.lit(False)))


def drop_control(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, "")


def unfence(text: Column) -> Column:
    """Content of the first fenced block, or the text itself."""
    return F.when(text.contains("```") & text.rlike(FENCE), F.trim(F.regexp_extract(text, FENCE, 1))).otherwise(text)


def braces(text: Column) -> Column:
    """From the first opening to the last closing brace, null without such a span."""
    return F.nullif(F.regexp_extract(text, r"(?s)\{.*\}", 0), F.lit(""))


def plain_quotes(text: Column) -> Column:
    """The text is mentioned several times, so pass a column, not a costly expression."""
    plain = F.translate(text, "".join(SMART_QUOTES), "".join(SMART_QUOTES.values()))
    return F.when(F.octet_length(text) != F.char_length(text), plain).otherwise(text)


def drop_trailing_commas(text: Column) -> Column:
    return F.regexp_replace(text, r",\s*(\]|\})", "$1")


class _TextKeys(ast.NodeTransformer):
    """Rewrites every dictionary key of a literal as the text Python prints for it."""

    def visit_Dict(self, node: ast.Dict) -> ast.Dict:
        self.generic_visit(node)
        node.keys = [key and ast.Constant(str(ast.literal_eval(key))) for key in node.keys]
        return node


def _beyond_json(value: object) -> object:
    """Sets become sorted lists, anything else JSON lacks its printed form."""
    return sorted(value, key=repr) if isinstance(value, (set, frozenset)) else str(value)


def _literal_to_json(source: str) -> str | None:
    try:
        tree = ast.parse(source.lstrip(" \t"), mode="eval")
        value = ast.literal_eval(_TextKeys().visit(tree))
    except (ValueError, SyntaxError, TypeError, MemoryError, RecursionError):
        return None
    if not isinstance(value, dict):
        return None
    return json.dumps(value, ensure_ascii=False, default=_beyond_json)


@F.arrow_udf(T.StringType())
def _literals(texts: pa.Array, wanted: pa.Array) -> pa.Array:
    return _changed(texts, wanted, _literal_to_json)


def literal_json(text: Column, wanted: Column | None = None) -> Column:
    """A dictionary written as a Python literal, as JSON text; null in, null out. Other texts than the wanted ones stay."""
    return _literals(text, F.coalesce(text.isNotNull() if wanted is None else wanted & text.isNotNull(), F.lit(False)))
