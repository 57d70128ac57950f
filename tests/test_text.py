import json
import random

import pytest
from pyspark.sql import functions as F

from gleanery.functions.text import parse_verdict, py_strip, strip_fences
from gleanery.operators.labels import parse_labels
from gleanery.schemas import LABEL_FLAG_FIELDS, LABEL_TEXT_FIELDS

STRINGS = [
    "",
    " ",
    "YES",
    "yes.",
    " \n\tYes, clear\n",
    "YESTERDAY",
    "**YES**",
    "The answer is YES",
    "Y",
    " YES",
    "\x1cyes",
    "\x85yes",
    "﻿YES",
    "yeſ",
    " 　 no  ",
    "```json\n{}\n```",
    "```JSON {} ```",
    "``` {} ",
    "```json",
    "``````",
    "````",
    "a ``` b ```",
    "```jſon {}```",
    "x" + " " * 5000 + "y",
]


# A fence tag's letters and what Unicode case-insensitive matching takes for each (the long s is an s).
TAG = ({"j", "J"}, {"s", "S", "\u017f"}, {"o", "O"}, {"n", "N"})


def unfenced(text):
    """The answer with one fence taken off by hand: backticks and an optional tag in front, backticks at the end."""
    body = text.strip()
    if body[:3] == "```":
        body = body[3:]
        if len(body) >= 4 and all(ch in allowed for ch, allowed in zip(body, TAG)):
            body = body[4:]
    if body[-3:] == "```":
        body = body[:-3]
    return body.strip()


def test_text_rules_agree_with_python(spark):
    df = spark.createDataFrame([(s,) for s in STRINGS], "s string")
    rows = df.select(
        "s",
        py_strip(F.col("s")).alias("stripped"),
        parse_verdict(F.col("s")).alias("keep"),
        strip_fences(F.col("s")).alias("cleaned"),
    ).collect()
    for row in rows:
        assert row["stripped"] == row["s"].strip()
        assert row["keep"] == row["s"].strip().upper().startswith("YES"), repr(row["s"])
        assert row["cleaned"] == unfenced(row["s"]), repr(row["s"])


class NoJson(Exception):
    pass


def strict(text):
    """The value of a JSON text; NaN and Infinity are no JSON here."""

    def constant(name):
        raise NoJson(name)

    try:
        return json.loads(text, parse_constant=constant)
    except (NoJson, ValueError) as exc:
        raise NoJson(str(exc)) from exc


def expected(raw):
    """Outcome by the contract, in plain Python: (kind, error or reason, fields)."""
    body = unfenced(raw)
    left, right = body.find("{"), body.rfind("}")
    tries = [body] + ([body[left : right + 1]] if 0 <= left < right else [])
    data, parsed = None, False
    for text in tries:
        try:
            data, parsed = strict(text), True
            break
        except NoJson:
            continue
    if not parsed:
        reason = "JSONDecodeError: " if len(tries) > 1 else "No JSON object found: "
        return "error", reason + raw[:200], None
    if type(data) is not dict:
        return "rejected", "label_not_an_object", None
    text_ok = {n: data.get(n) is None or type(data.get(n)) is str for n in LABEL_TEXT_FIELDS}
    flag_ok = {n: data.get(n) is None or type(data.get(n)) in (str, bool) for n in LABEL_FLAG_FIELDS}
    bad = [n for n, ok in {**text_ok, **flag_ok}.items() if not ok]
    if bad:
        return "rejected", "label_type_error: " + ",".join(bad), None
    flags = {n: (data.get(n).lower() in {"true", "yes", "1"}) if type(data.get(n)) is str else data.get(n) for n in LABEL_FLAG_FIELDS}
    return "ok", None, {**{n: data.get(n) for n in LABEL_TEXT_FIELDS}, **flags}


EDGES = [
    "",
    "{}",
    "[]",
    "null",
    "7",
    '"x"',
    "[1] [2]",
    '{"category":"food"} trailing',
    '{"category":"food"} {"mood":"warm"}',
    '{"category":"food","category":"hotel"}',
    '{"category":"food",}',
    '{"category":NaN}',
    '{"is_professional":Infinity}',
    '{"is_professional":" yes"}',
    '{"is_professional":"YES","has_text_overlay":"1"}',
    '{"is_professional":1}',
    '{"is_professional":null,"has_text_overlay":"no"}',
    '{"category":7}',
    '{"city":["Rome"]}',
    '{"mood":{"a":1}}',
    '{"description":"a\nb"}',
    '{"description":"a\\nb \\u00e9 \\" }"}',
    'Sure!\n{"category":\n"food"}\nBye',
    "no braces } {",
    '```json\n{"category":"food"}\n``` and more',
    '],[',
    '1,2',
    '{"a":{"category":3},"category":"food"}',
    " {\"city\":\"Köln\"} ",
    "{" * 3 + "}" * 3,
]


def random_answer(rng):
    def value(depth=0):
        pick = rng.randrange(9)
        if pick < 4:
            return rng.choice(["food", "warm", "Yes", "true", "", " yes", "café", 'q"uote', "back\\slash", "li\nne"])
        if pick < 6:
            return rng.choice([True, False, None])
        if pick == 6:
            return rng.choice([0, 1, -3, 2.5, 10**20])
        if depth > 2:
            return None
        return [value(depth + 1)] if pick == 7 else {"category": value(depth + 1)}

    names = LABEL_TEXT_FIELDS + LABEL_FLAG_FIELDS + ("other",)
    data = {n: value() for n in names if rng.random() < 0.6}
    text = json.dumps(data, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, 1]))
    if rng.random() < 0.2:
        at = rng.randrange(len(text) + 1)
        text = text[:at] + rng.choice(["}", "{", ",", '"', "", "\x01"]) + text[at + rng.randrange(2) :]
    return (
        rng.choice(["", "", "Here: ", "```json\n", "```", "\n", " "])
        + text
        + rng.choice(["", "", " done", "\n```", "```", "\t", " {x}"])
    )


def test_label_parser_agrees_with_python(spark):
    rng = random.Random(7)
    answers = EDGES + [random_answer(rng) for _ in range(1500)]
    rows = parse_labels(spark.createDataFrame([(a,) for a in answers], "answer string")).collect()
    assert len(rows) == len(answers)
    for row in rows:
        kind, message, fields = expected(row["answer"])
        assert row["error"] == (message if kind == "error" else None), repr(row["answer"])
        assert row["rejected"] == (message if kind == "rejected" else None), repr(row["answer"])
        got = {n: row[n] for n in LABEL_TEXT_FIELDS + LABEL_FLAG_FIELDS}
        assert got == (fields or dict.fromkeys(got)), repr(row["answer"])
        assert row["label_json"] == (None if kind == "error" else row["answer"])


def test_null_answer_has_no_error(spark):
    row = parse_labels(spark.createDataFrame([(None,)], "answer string")).first()
    assert row["error"] is None and row["rejected"] is None and row["label_json"] is None


@pytest.mark.parametrize("size", [1_000_000])
def test_whole_answer_is_parsed(spark, size):
    answer = json.dumps({"category": "food", "description": "d" * size}) + " !"
    row = parse_labels(spark.createDataFrame([(answer,)], "answer string")).first()
    assert len(row["description"]) == size
