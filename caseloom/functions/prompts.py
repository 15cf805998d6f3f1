"""Request texts for the scorer.

The wording is a default; every step that talks to a scorer takes its own
system text, and whatever is used becomes part of the request key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from caseloom import fixed_values as fv
from caseloom.functions.text import format_examples, no_dm_preference


def classify_system(brand: str, labels: Sequence[str] = fv.INTENTS) -> str:
    return (f"Label posts sent to {brand}. Allowed labels: {', '.join(labels)}.\n"
            "The posts are numbered. Answer with a JSON array only, one object per post:\n"
            '[{"id": 1, "intent": "<label>"}]')


def suggest_system(brand: str, labels: Sequence[str] = fv.INTENTS) -> str:
    return (f"Propose labels for a human reviewer of posts sent to {brand}.\n"
            f"Allowed intents: {', '.join(labels)}. Allowed routings: {', '.join(fv.ROUTINGS)}.\n"
            "Escalate private account matters, money, security, anger and safety, and then name a "
            "snake_case reason; otherwise leave the reason empty. Answer with a JSON object only:\n"
            '{"intent": "", "routing": "", "escalation_reason": "", "confidence_note": ""}')


def judge_system() -> str:
    return ("Grade a support reply from 1 to 5 on relevance to the message, groundedness in the "
            "precedents shown, and tone. Answer with a JSON object only:\n"
            '{"relevance": 0, "groundedness": 0, "tone": 0}')


def suggest_message(customer_text: Column, reply: Column) -> Column:
    return F.concat(F.lit("Customer post: "), F.coalesce(customer_text, F.lit("")),
                    F.lit("\n\nActual reply: "), F.coalesce(reply, F.lit("")))


def judge_message(customer_text: Column, precedent: Column, reply: Column) -> Column:
    return F.concat(F.lit("Customer message: "), F.coalesce(customer_text, F.lit("")),
                    F.lit("\n\nHistorical precedent: "), F.coalesce(precedent, F.lit("")),
                    F.lit("\n\nDrafted reply: "), F.coalesce(reply, F.lit("")))


def precedent_blocks(precedents: Column) -> Column:
    """Each precedent as message and reply, blank line between them."""
    return format_examples(F.transform(precedents, lambda p: F.concat(
        F.lit("Message: "), p["customer_text"], F.lit("\nReply: "), p["apple_reply_text"])))


def draft_system(brand: str, text: Column, intent: Column, routing: Column, precedents: Column,
                 opt_out: str = fv.NO_DM_PATTERN) -> Column:
    """Per-row instructions: intent, route, precedents and the DM opt-out."""
    opt_out_note = F.when(no_dm_preference(text, opt_out),
                          "The customer does not want to be sent to DM; answer here.\n").otherwise("")
    task = F.when(routing == fv.ESCALATE,
                  "Acknowledge the problem briefly and say that the right team will take over; "
                  "do not solve it.").otherwise(
                  "Solve the problem or give the next step in this reply, in the style of the "
                  "precedents; do not ask for a DM.")
    return F.concat(
        F.lit(f"Write a public reply for {brand}. Intent of the post: "), intent, F.lit("\n"),
        opt_out_note, F.lit("Precedents:\n"), precedent_blocks(precedents), F.lit("\n"), task,
        F.lit(f"\nAt most {fv.REPLY_LIMIT_CHARS} characters, no leading mention, reply text only."))
