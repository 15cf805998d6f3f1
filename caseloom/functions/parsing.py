"""Model responses to typed columns.

Fields are read as strings and cast afterwards: a wrong type makes the item
invalid instead of silently null.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from caseloom import fixed_values as fv
from caseloom.functions.text import strip_code_fence

_JSON = {"mode": "PERMISSIVE", "allowSingleQuotes": "false"}


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once, however often body uses it."""
    return F.transform(F.array(value), body)[0]


def _read(c: Column, schema: str, brackets: str) -> Column:
    """from_json, only for text that opens and closes as the schema demands."""
    def parse(text: Column) -> Column:
        whole = text.startswith(brackets[0]) & text.endswith(brackets[1])
        return F.when(whole, F.from_json(text, schema, _JSON))

    return let(strip_code_fence(c), parse)


def _integer(c: Column) -> Column:
    """Whole numbers, also when written 3.0; null otherwise."""
    number = c.try_cast("double")
    return F.when(number == F.floor(number), number.try_cast("int"))


def parse_label_array(c: Column, labels: Sequence[str], n: Column, fallback: str,
                      on_bad_item: str = "stop") -> Column:
    """One label per batch position, array<string> of length n.

    Items are {"id": position, "intent": label}; positions outside 1..n are
    ignored and a later item wins.  A bad item (unknown label, id that is no
    whole number) has one of three effects:

    stop    labels before it count, the rest of the batch falls back
    skip    only that item is ignored
    reject  the whole batch falls back
    """
    if on_bad_item not in ("stop", "skip", "reject"):
        raise ValueError(f"on_bad_item must be stop, skip or reject, not {on_bad_item!r}")

    def check(x: Column) -> Column:
        known = F.when(x["intent"].isin(list(labels)), x["intent"])
        return F.struct(_integer(x["id"]).alias("id"), known.alias("intent"))

    def good(x: Column) -> Column:
        return x["id"].isNotNull() & x["intent"].isNotNull()

    def usable(items: Column) -> Column:
        if on_bad_item == "skip":
            return F.filter(items, good)
        first_bad = F.array_position(F.transform(items, good), False).cast("int")
        kept = F.slice(items, F.lit(1), first_bad - 1) if on_bad_item == "stop" else F.slice(items, 1, 0)
        return F.when(first_bad > 0, kept).otherwise(items)

    def assign(items: Column) -> Column:
        def label_at(position: Column) -> Column:
            named = F.filter(items, lambda x: x["id"] == position)
            return F.coalesce(F.try_element_at(named, F.lit(-1))["intent"], F.lit(fallback))

        return F.transform(F.sequence(F.lit(1), n.cast("int")), label_at)

    # Items are opened one by one: something else among them spoils only itself.
    raw = F.transform(_read(c, "array<string>", "[]"),
                      lambda x: F.from_json(x, "id string, intent string", _JSON))
    return let(let(F.transform(raw, check), usable), assign)


def parse_suggestion(c: Column, intents: Sequence[str] = fv.INTENTS,
                     routings: Sequence[str] = fv.ROUTINGS) -> Column:
    """struct of the four suggestion columns, with the failure row for bad input."""
    def row(s: Column) -> Column:
        valid = F.coalesce(s["intent"].isin(list(intents)) & s["routing"].isin(list(routings)), F.lit(False))

        def pick(field: str, failed: str) -> Column:
            return F.when(valid, F.coalesce(s[field], F.lit(""))).otherwise(failed)

        return F.struct(
            pick("intent", "").alias("suggested_intent"),
            pick("routing", "").alias("suggested_routing"),
            pick("escalation_reason", "").alias("suggested_reason"),
            pick("confidence_note", fv.FAILED_NOTE).alias("model_confidence_note"))

    return let(_read(c, "intent string, routing string, escalation_reason string, confidence_note string", "{}"), row)


def parse_judge_score(c: Column, dimensions: Sequence[str] = fv.JUDGE_DIMENSIONS) -> Column:
    """struct<judge_*: int>; all scores within 1..5 or all null."""
    def scores(s: Column) -> Column:
        return F.struct(*[_integer(s[d]).alias(d) for d in dimensions])

    def row(s: Column) -> Column:
        valid = reduce(lambda a, b: a & b, [s[d].between(1, 5) for d in dimensions])
        return F.struct(*[F.when(valid, s[d]).alias(f"judge_{d}") for d in dimensions])

    return let(let(_read(c, ", ".join(f"{d} string" for d in dimensions), "{}"), scores), row)
