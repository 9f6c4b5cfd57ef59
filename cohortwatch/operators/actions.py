"""Reports and alert rows from check results."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from datetime import datetime, timedelta
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortwatch.functions.templates import Context, action_time, render
from cohortwatch.operators.conditions import condition, gate
from cohortwatch.operators.transforms import moment


@dataclass(frozen=True)
class Action:
    """What to report: a name, a type, a gate (None: always), a time, and settings with templates, whose lone tokens may keep their text (see ``Context``)."""

    name: str
    kind: str = "default_type"
    rule: str | Column | Iterable | None = None
    when: str | timedelta | None = "immediate"
    settings: Any = field(default_factory=dict)
    keep_text: bool = False


def gather(results: dict[str, DataFrame]) -> DataFrame:
    """The rule and template context: one row, a struct column for each named one-row result.

    A result with no row or several is an error when the context is read; two rows of it are looked at.
    """
    if not results:
        raise ValueError("no results to gather")
    packed = []
    for name, r in results.items():
        rows = r.select(F.struct(*[F.col(f"`{c}`") for c in r.columns]).alias("row")).limit(2).agg(F.collect_list("row").alias("rows"))
        one = F.when(F.size("rows") == 1, F.get("rows", F.lit(0))).otherwise(F.raise_error(F.concat(F.lit(f"{name} has not one row but "), F.size("rows").cast("string"))))
        packed.append(rows.select(one.alias(name)))
    return reduce(lambda a, b: a.crossJoin(b), packed)  # aggregates without groups: one row each


def _report(context: DataFrame, action: Action, as_of: datetime | Column | None) -> list[Column]:
    settings = action.settings if isinstance(action.settings, dict) else {}
    metadata = render(settings, Context(context.schema, keep_text=action.keep_text))
    data = F.struct(*[F.col(f"`{c}`") for c in context.columns])
    return [F.lit(action.name).alias("name"), F.lit(action.kind).alias("type"), action_time(action.when, as_of).alias("time"), data.alias("data"), metadata.alias("metadata")]


def report(context: DataFrame, action: Action, as_of: datetime | Column | None = None) -> DataFrame:
    """The action's report for each context row its rule holds for: ``name``, ``type``, ``time``, ``data``, ``metadata``.

    Settings that are no mapping give empty metadata.
    """
    return gate(context, action.rule).select(*_report(context, action, as_of))


def report_messages(context: DataFrame, actions: Iterable[Action], as_of: datetime | Column | None = None) -> DataFrame:
    """The reports of several actions on one context as ``name`` and JSON ``value``; their metadata may differ in shape.

    The context is read once, however many actions there are.
    """
    texts = []
    for a in actions:
        value = F.to_json(F.struct(*_report(context, a, as_of)), {"ignoreNullFields": "false"})
        texts.append(F.when(condition(a.rule), F.struct(F.lit(a.name).alias("name"), value.alias("value"))))
    if not texts:
        raise ValueError("no actions")
    return context.select(F.inline(F.array_compact(F.array(*texts))))


def alert_rows(found: DataFrame, action: str, method: str, as_of: datetime | Column | None = None, endpoint: str | None = None, recipients: Iterable[str] = (), subject: str | None = None, body: str | None = None, when: str | timedelta | None = "immediate", user_col: str = "user_id") -> DataFrame:
    """One alert for each finding, for a table or topic; ``subject`` and ``body`` are templates over the finding's columns."""
    context = Context(found.schema)
    text = lambda t: F.lit(None).cast("string") if t is None else render(t, context).cast("string")
    people = list(recipients)
    return found.select(
        F.lit(action).alias("action"),
        F.lit(method).alias("method"),
        F.col(user_col).alias("user_id"),
        F.lit(endpoint).cast("string").alias("endpoint"),
        (F.array(*map(F.lit, people)) if people else F.expr("cast(array() as array<string>)")).alias("recipients"),
        text(subject).alias("subject"),
        text(body).alias("body"),
        action_time(when, as_of).alias("due_at"),
        moment(as_of).alias("alerted_at"),
    )
