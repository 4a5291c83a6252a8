"""Typed fields from documents, by template.

A template names the fields and their types. Where a value stands in a document is
told by a *finder* per field, a column expression that gives the raw text or NULL.
"""

from __future__ import annotations

import dataclasses
import datetime
import json
import types
import typing
from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NAMED_TYPES = {
    "string": T.StringType(),
    "str": T.StringType(),
    "float": T.DoubleType(),
    "int": T.LongType(),
    "bool": T.BooleanType(),
    "date": T.DateType(),
}
_PYTHON_TYPES = {str: "string", float: "float", int: "int", bool: "bool", datetime.date: "date"}


@dataclass(frozen=True)
class Field:
    """One field of a template; ``fallback`` is used when no value is found."""

    name: str
    type: T.DataType
    required: bool = False
    fallback: Any = None


def _named(name: str, kind: str) -> Field:
    if kind not in _NAMED_TYPES:
        raise ValueError(f"unknown type {kind!r} of field {name!r}; choose from {sorted(_NAMED_TYPES)}")
    return Field(name, _NAMED_TYPES[kind])


def _python_type(annotation: Any) -> T.DataType:
    if typing.get_origin(annotation) in (typing.Union, types.UnionType):
        annotation = next(a for a in typing.get_args(annotation) if a is not type(None))
    return _NAMED_TYPES[_PYTHON_TYPES[annotation]]


def template_fields(template: str | Mapping[str, str] | type | Any) -> list[Field]:
    """Fields of a JSON string, a mapping, a dataclass, or an instance of a dataclass.

    A dataclass field without default is required. The values of an instance are the
    fallbacks, and nothing is required.
    """
    if isinstance(template, str):
        template = json.loads(template)
    if isinstance(template, Mapping):
        return [_named(name, kind) for name, kind in template.items()]
    if not dataclasses.is_dataclass(template):
        raise ValueError("a template is a JSON string, a mapping, a dataclass or an instance of one")
    model = template if isinstance(template, type) else type(template)
    annotations = typing.get_type_hints(model)
    fields = []
    for field in dataclasses.fields(model):
        kind = _python_type(annotations[field.name])
        if model is not template:
            fields.append(Field(field.name, kind, fallback=getattr(template, field.name)))
        elif field.default is dataclasses.MISSING:
            fields.append(Field(field.name, kind, required=True))
        else:
            fields.append(Field(field.name, kind, fallback=field.default))
    return fields


def choose_template(name: str, templates: Mapping[str, Any]) -> Any:
    if name not in templates:
        raise ValueError(f"unknown template {name!r}; choose from {list(templates)}")
    return templates[name]


def json_finders(document: Column, keys: Mapping[str, str]) -> dict[str, Column]:
    """Finders for fields that are top-level keys of a JSON document."""
    schema = T.StructType([T.StructField(key, T.StringType()) for key in keys.values()])
    parsed = F.from_json(document, schema)
    return {field: parsed[key] for field, key in keys.items()}


def pattern_finders(document: Column, patterns: Mapping[str, str]) -> dict[str, Column]:
    """Finders that take the first group of a pattern's first match; no match gives NULL."""
    return {
        field: F.when(document.rlike(pattern), F.regexp_extract(document, pattern, 1))
        for field, pattern in patterns.items()
    }


def extract_fields(
    df: DataFrame, template: Any, finders: Mapping[str, Column], *keep: str
) -> DataFrame:
    """One typed column per field, and the names of required fields without a value.

    A found text that does not convert to the field's type counts as not found.
    """
    fields = template_fields(template)
    unknown = set(finders) - {field.name for field in fields}
    if unknown:
        raise ValueError(f"finders for unknown fields: {sorted(unknown)}")
    columns, absent = [], []
    for field in fields:
        raw = finders.get(field.name, F.lit(None).cast("string"))
        value = raw.try_cast(field.type)
        if field.fallback is not None:
            value = F.coalesce(value, F.lit(field.fallback).cast(field.type))
        columns.append(value.alias(field.name))
        if field.required:
            absent.append(F.when(value.isNull(), F.lit(field.name)))
    missing = F.filter(F.array(*absent), lambda x: x.isNotNull()) if absent else F.array().cast("array<string>")
    return df.select(*keep, *columns, missing.alias("missing_fields"))
