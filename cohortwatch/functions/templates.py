"""Templates: ``{{ a.b.0 }}`` in text and nested settings, rendered as columns of one projection."""

from __future__ import annotations

import re
from datetime import datetime, timedelta
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, DoubleType, IntegerType, LongType, MapType, NullType, StringType, StructField, StructType, VariantType

from cohortwatch.operators.transforms import moment

_TOKEN = re.compile(r"{{([^{}]+)}}")


class Context:
    """Where paths lead: the columns of a typed DataFrame, by its schema, or one VARIANT column.

    In a typed context a path that the schema lacks is missing, in a VARIANT one, or behind a typed
    context's VARIANT column, what a row lacks. With ``keep_text`` a token alone is a VARIANT, of its value's
    own type or, where a row has NULL, of the token's text; without it values of a VARIANT context are text,
    and only text columns can hold the token's text.
    """

    def __init__(self, schema: StructType | None = None, variant: str | None = None, keep_text: bool = False):
        if (schema is None) == (variant is None):
            raise ValueError("a context is either a schema or a variant column")
        self.schema, self.variant, self.keep_text = schema, variant, keep_text

    def lookup(self, path: str) -> tuple[Column, DataType] | None:
        """The column at a dotted path and its type, or None if it cannot be there. All-digit steps index lists from 0."""
        steps = path.strip().split(".")
        if self.variant is not None:
            value = _within(F.col(self.variant), steps)
            return (value, VariantType()) if self.keep_text else (F.try_variant_get(value, "$", "string"), StringType())
        found: Column | None = None
        kind: DataType = self.schema
        for k, s in enumerate(steps):
            if isinstance(kind, VariantType):
                return _within(found, steps[k:]), kind
            if isinstance(kind, StructType) and s in kind.names:
                found = F.col(f"`{s}`") if found is None else found.getField(s)
                kind = kind[s].dataType
            elif isinstance(kind, ArrayType) and s.isdigit():
                found, kind = F.get(found, F.lit(int(s))), kind.elementType
            else:
                return None
        return found, kind


def _within(variant: Column, steps: list[str]) -> Column:
    """The value inside a VARIANT, itself a VARIANT; NULL where a row lacks it."""
    json = "$" + "".join(f"[{s}]" if s.isdigit() else f"['{s}']" for s in steps)
    return F.try_variant_get(variant, json, "variant")


def _as_variant(column: Column, kind: DataType) -> Column:
    whole = (StructType, ArrayType, MapType)
    return F.to_variant_object(column) if isinstance(kind, whole) else column.cast("variant")


def text_of(column: Column, kind: DataType) -> Column:
    """A value as it stands in a message; lists as ``['a', 'b']``, numbers in them unquoted, truth as True and False."""
    if isinstance(kind, ArrayType):
        quote = isinstance(kind.elementType, StringType)
        item = lambda x: F.concat(F.lit("'"), x, F.lit("'")) if quote else text_of(x, kind.elementType)
        return F.concat(F.lit("["), F.array_join(F.transform(column, lambda x: F.coalesce(item(x), F.lit("None"))), ", "), F.lit("]"))
    if isinstance(kind, BooleanType):
        return F.initcap(column.cast("string"))
    if isinstance(kind, StructType):
        return F.to_json(column)
    if isinstance(kind, VariantType):
        return F.try_variant_get(column, "$", "string")
    return column.cast("string")


def render_text(template: str, context: Context) -> Column:
    """A template as a column.

    One token alone keeps its value's type; if nothing is there, the template's own text stays. Values
    of a VARIANT column stay VARIANT, so each row has its own type, or the text. A typed column of another type than
    text can't hold that: a row that lacks the value has NULL then, unless the context's ``keep_text`` makes it a
    VARIANT. Inside other text, a missing value is empty. Values are not rendered again.
    """
    return _text(template, context)[0]


def _text(template: str, context: Context) -> tuple[Column, DataType]:
    tokens = list(_TOKEN.finditer(template))
    if len(tokens) == 1 and tokens[0].span() == (0, len(template)):
        found = context.lookup(tokens[0][1])
        if found is None:
            return F.lit(template), StringType()
        value, kind = found
        if isinstance(kind, StringType):
            return F.coalesce(value, F.lit(template)), kind
        if isinstance(kind, VariantType) or context.keep_text:
            return F.coalesce(value if isinstance(kind, VariantType) else _as_variant(value, kind), F.lit(template).cast("variant")), VariantType()
        return value, kind
    parts, at = [], 0
    for t in tokens:
        parts.append(F.lit(template[at : t.start()]))
        found = context.lookup(t[1])
        if found is not None:
            parts.append(F.coalesce(text_of(*found), F.lit("")))
        at = t.end()
    return F.concat(*parts, F.lit(template[at:])) if parts else F.lit(template), StringType()


_PLAIN = {bool: BooleanType(), int: IntegerType(), float: DoubleType(), type(None): NullType()}


def render(value: Any, context: Context) -> Column:
    """Settings as a column: mappings become structs (an empty one a map), lists arrays (of VARIANT where the rendered types differ), text is rendered, the rest is literal."""
    return _rendered(value, context)[0]


def _rendered(value: Any, context: Context) -> tuple[Column, DataType]:
    if isinstance(value, dict):
        if not value:
            return F.create_map().cast("map<string,string>"), MapType(StringType(), StringType())
        parts = {k: _rendered(v, context) for k, v in value.items()}
        return F.struct(*[c.alias(k) for k, (c, _) in parts.items()]), StructType([StructField(k, t) for k, (_, t) in parts.items()])
    if isinstance(value, list):
        items = [_rendered(v, context) for v in value]
        if not items:
            return F.expr("cast(array() as array<string>)"), ArrayType(StringType())
        if all(t.simpleString() == items[0][1].simpleString() for _, t in items):
            return F.array(*[c for c, _ in items]), ArrayType(items[0][1])
        return F.array(*[c if isinstance(t, VariantType) else _as_variant(c, t) for c, t in items]), ArrayType(VariantType())
    if isinstance(value, str):
        return _text(value, context)
    kind = _PLAIN.get(type(value), StringType())
    return F.lit(value), LongType() if isinstance(kind, IntegerType) and abs(value) >= 1 << 31 else kind


#: Clock times, put behind the day of ``as_of``, and dates with or without a clock.
_CLOCK = ("h:mma", "h:mm a", "ha", "h a", "H:mm", "h:mm:ssa", "h:mm:ss a", "H:mm:ss")
_DATES = ("MMM d yyyy", "MMM d, yyyy", "MMMM d yyyy", "MMMM d, yyyy", "d MMM yyyy", "d MMMM yyyy", "yyyy/M/d", "M/d/yyyy")


def action_time(when: str | timedelta | None, as_of: datetime | Column | None = None) -> Column:
    """When an action is due.

    NULL for ``immediate``, None or text that is none of these; a timedelta is added to ``as_of``; a clock time
    (``8:30pm``, ``20:30``, ``8:30:15``) falls on its date; a date (``Jan 5 2024``, ``5 January 2024``, ``2024/1/5``,
    ``1/5/2024``: month first) has the clock behind it or midnight; ISO text is itself. Names of days, words such as
    tomorrow, dates without a year and time zones outside ISO text stay out.
    """
    now = moment(as_of).cast("timestamp")
    if when is None or when == "immediate":
        return F.lit(None).cast("timestamp")
    if isinstance(when, timedelta):
        return now + F.lit(when)
    day = F.concat(F.date_format(now, "yyyy-MM-dd"), F.lit(" "))
    text = when.strip()
    upper = re.sub(r"(?i)(?<=\d)(\s*)([ap]m)\b", lambda m: m[1] + m[2].upper(), text)
    clock = [F.try_to_timestamp(F.concat(day, F.lit(upper)), F.lit(f"yyyy-MM-dd {f}")) for f in _CLOCK]
    dates = [F.try_to_timestamp(F.lit(upper), F.lit(f)) for d in _DATES for f in (d, *(f"{d} {c}" for c in _CLOCK))]
    iso = F.try_to_timestamp(F.when(F.length(F.lit(text)) >= 10, F.lit(text)))
    return F.coalesce(*clock, iso, *dates)
