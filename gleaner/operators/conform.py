"""V1: schema-conforming projection of loosely typed records.

Each row holds a JSON object (a text column or a VARIANT). ``conform``
checks it against a declared schema and returns only the declared fields, or
null when the record does not fit:

* required field: present, not null, of the declared type;
* ``optional`` field (``Optional[T]``): present, null or of the type;
* ``not_required`` field (``NotRequired[T]``): absent, or of the type.

Undeclared fields are dropped. A declared type is a name (``string, bigint,
double, boolean, timestamp``), a list with one type (``["bigint"]``), a record
(a dict of fields; ``Field`` says optional or not required) or a map
(``{"*": type}``), to any depth; the schema is compiled to one expression.

Values are coerced where nothing is lost: ``"7"``, ``7.0`` and ``7e0`` are the
integer 7, ``"2.5"`` is the number 2.5, ``"true"`` and ``1`` are true; ``6.55``
is no integer and ``7`` is no string. Native VARIANT expressions throughout:
``try_variant_get(v, path, 'variant')`` is SQL NULL for an absent key and a
variant null for JSON null, which is exactly the required / optional /
not-required distinction.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_INTS = ("TINYINT", "SMALLINT", "INT", "BIGINT")
_NUMBERS = ("DOUBLE", "FLOAT")
_TRUE, _FALSE = ("true", "t", "yes", "y", "on", "1"), ("false", "f", "no", "n", "off", "0")

Spec = "str | list | dict | Field"


@dataclass(frozen=True)
class Field:
    """A declared type that may be null (``optional``) or absent (``not_required``)."""

    type: Spec
    optional: bool = False
    not_required: bool = False


def _get(node: Column, kind: str, path: str = "$") -> Column:
    return F.try_variant_get(node, path, kind)


def _variant(value: Column) -> Column:
    return value.cast("variant")


def _number(node: Column, kind: Column) -> Column:
    """A number, or text that is one and no more, as a decimal that holds every bigint."""
    text = F.regexp_extract(_get(node, "string"), r"^\s*([+-]?[0-9]+(?:\.[0-9]*)?(?:[eE][+-]?[0-9]+)?)\s*$", 1)
    return F.when(kind == "STRING", F.when(text != "", text).try_cast("decimal(38,18)")).otherwise(_get(node, "decimal(38,18)"))


def _scalar(node: Column, name: str) -> tuple[Column, Column]:
    """(fits, coerced variant) of one value."""
    kind = F.schema_of_variant(node)
    if name == "string":
        return kind == "STRING", node
    if name in ("int", "bigint", "long", "integer"):
        # doubles beyond 2^53 come as they are; a fraction makes no integer
        value = F.when(kind.isin(*_INTS), _get(node, "bigint")).otherwise(
            F.when(_number(node, kind) == F.floor(_number(node, kind)), _number(node, kind)).try_cast("bigint"))
        return (kind.isin(*_INTS, *_NUMBERS, "STRING") | kind.startswith("DECIMAL")) & value.isNotNull(), _variant(value)
    if name in ("double", "float"):
        text = _get(node, "string")
        value = F.when(kind == "STRING", F.when(_number(node, kind).isNotNull(), F.trim(text)).try_cast("double"))
        there = kind.isin(*_INTS, *_NUMBERS) | kind.startswith("DECIMAL")
        return there | value.isNotNull(), F.when(there, node).otherwise(_variant(value))
    if name == "boolean":
        text = F.lower(F.when(kind == "STRING", _get(node, "string")).when(kind.isin(*_INTS), _get(node, "bigint").cast("string")))
        value = F.when(kind == "BOOLEAN", _get(node, "boolean")).when(text.isin(*_TRUE), True).when(text.isin(*_FALSE), False)
        return value.isNotNull(), _variant(value)
    if name in ("timestamp", "timestamp_ntz", "datetime"):
        return (kind == "STRING") & F.try_to_timestamp(_get(node, "string")).isNotNull(), node
    if name.startswith("array<") and name.endswith(">"):
        return _value(node, [name[len("array<"):-1]])
    raise ValueError(f"unsupported declared type {name!r}")


def _value(node: Column, spec: Spec) -> tuple[Column, Column]:
    if isinstance(spec, str):
        fits, value = _scalar(node, spec.lower())
    elif isinstance(spec, list):
        (item,) = spec
        inner = item if isinstance(item, Field) else Field(item)
        items = _get(node, "array<variant>")
        fits = F.schema_of_variant(node).startswith("ARRAY") & F.forall(items, lambda x: _member(x, inner)[0])
        value = _variant(F.transform(items, lambda x: _member(x, inner)[1]))
    elif set(spec) == {"*"}:
        inner = spec["*"] if isinstance(spec["*"], Field) else Field(spec["*"])
        entries = _get(node, "map<string,variant>")
        fits = _is_object(node) & F.forall(F.map_values(entries), lambda x: _member(x, inner)[0])
        value = F.parse_json(F.to_json(F.transform_values(entries, lambda k, x: _member(x, inner)[1])))
    else:
        fits, entries = _record(node, spec)
        value = F.parse_json(F.to_json(F.map_from_entries(entries)))
    return F.coalesce(fits, F.lit(False)), value


def _is_object(node: Column) -> Column:
    return F.coalesce(F.schema_of_variant(node).startswith("OBJECT"), F.lit(False))


def _member(node: Column, field: Field) -> tuple[Column, Column]:
    """(fits, value) of a node that is there."""
    is_null = F.coalesce(F.is_variant_null(node), F.lit(False))
    fits, value = _value(node, field.type)
    return (is_null if field.optional else F.lit(False)) | (~is_null & fits), F.when(is_null, node).otherwise(value)


def _record(node: Column, fields: dict[str, Spec]) -> tuple[Column, Column]:
    """(fits, entries of the declared fields that are there)."""
    fits, entries = _is_object(node), []
    for name, spec in fields.items():
        field = spec if isinstance(spec, Field) else Field(spec)
        own = _get(node, "variant", f"$['{name}']")
        there = own.isNotNull()
        ok, value = _member(own, field)
        fits = fits & ((~there if field.not_required else F.lit(False)) | (there & ok))
        entries.append(F.when(there, F.struct(F.lit(name).alias("key"), value.alias("value"))))
    return fits, F.filter(F.array(*entries), lambda e: e.isNotNull())


def conform_col(value, fields: dict[str, Spec], optional=(), not_required=()) -> Column:
    """JSON text of the declared fields, or null when the record does not fit."""
    v = F.col(value) if isinstance(value, str) else value
    spec = {n: s if isinstance(s, Field) else Field(s, n in optional, n in not_required) for n, s in fields.items()}
    fits, entries = _record(v, spec)
    return F.when(fits, F.to_json(F.map_from_entries(entries)))


def conform(df: DataFrame, col: str, fields: dict[str, Spec], optional=(), not_required=(),
            out: str = "conformed") -> DataFrame:
    """V1: add ``out`` = the declared subset as JSON text (null if invalid).

    ``col`` is JSON text or a VARIANT column.
    """
    src = F.col(col)
    if dict(df.dtypes).get(col) != "variant":
        src = F.try_parse_json(src)
    return df.withColumn(out, conform_col(src, fields, optional, not_required))
