import json

import pytest
from pyspark.sql import functions as F

from caseloom.functions import parsing as p

LABELS = ["a", "b", "c"]


def items(*pairs):
    return json.dumps([{"id": i, "intent": label} for i, label in pairs])


@pytest.mark.parametrize("response, mode, expected", [
    (items((0, "a"), (2, "a"), (2, "b"), (99, "c")), "stop", ["x", "b", "x"]),
    (items((1, "a"), (2, "zzz"), (3, "c")), "stop", ["a", "x", "x"]),
    (items((1, "a"), (2, "zzz"), (3, "c")), "skip", ["a", "x", "c"]),
    (items((1, "a"), (2, "zzz"), (3, "c")), "reject", ["x", "x", "x"]),
    (items((1, "a"), ("two", "b")), "stop", ["a", "x", "x"]),
    (items(("1", "a"), (2.0, "b"), (3, "c")), "reject", ["a", "b", "c"]),
    ("```json\n" + items((3, "c")) + "\n```", "stop", ["x", "x", "c"]),
    ('{"id": 1, "intent": "a"}', "stop", ["x", "x", "x"]),
    ("not json", "stop", ["x", "x", "x"]),
    (items((1, "a")) + " and more", "stop", ["x", "x", "x"]),
    (None, "stop", ["x", "x", "x"]),
    ("[]", "reject", ["x", "x", "x"]),
    ('[{"id": 1, "intent": "a"}, 5, {"id": 3, "intent": "c"}]', "stop", ["a", "x", "x"]),
    ('[{"id": 1, "intent": "a"}, "b", null, {"id": 3, "intent": "c"}]', "skip", ["a", "x", "c"]),
    ('[{"id": 1, "intent": {"name": "a"}}, {"id": 2, "intent": "b", "why": [1]}]', "skip", ["x", "b", "x"]),
])
def test_label_array(values, response, mode, expected):
    assert values(lambda c: p.parse_label_array(c, LABELS, F.lit(3), "x", mode), "string", response) == [expected]


def test_label_array_mode_is_checked(values):
    with pytest.raises(ValueError):
        values(lambda c: p.parse_label_array(c, LABELS, F.lit(3), "x", "other"), "string", "[]")


def test_suggestion(values):
    good = '{"intent": "a", "routing": "escalate", "escalation_reason": "r", "confidence_note": "n"}'
    short = '```{"intent": "a", "routing": "auto_handle"}```'
    failed = ("", "", "", "FAILED - label manually")
    got = values(lambda c: p.parse_suggestion(c, LABELS), "string", good, short, '{"intent": "z", "routing": "escalate"}',
                 '{"intent": "a", "routing": "later"}', "oops", None)
    assert [tuple(g) for g in got] == [("a", "escalate", "r", "n"), ("a", "auto_handle", "", ""), *[failed] * 4]


def test_judge_score(values):
    got = values(p.parse_judge_score, "string", '{"relevance":6,"groundedness":3,"tone":3}',
                 '{"relevance":5,"groundedness":1,"tone":"3"}', '{"relevance":5,"groundedness":3}',
                 '{"relevance":4.5,"groundedness":3,"tone":1}', "[1]", None)
    none = (None, None, None)
    assert [tuple(g) for g in got] == [none, (5, 1, 3), none, none, none, none]
