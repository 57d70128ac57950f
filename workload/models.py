"""Deterministic stand-ins for a model.

They are closures, so that Spark sends their code to the workers.
"""

from __future__ import annotations

# Answers by the first hex digit of the MD5 of the image.
VERDICTS = {
    "0": "YES",
    "1": " yes.",
    "2": "NO",
    "3": "\nYes, clear\n",
    "4": "no",
    "5": "The answer is YES",
    "6": "YESTERDAY",
    "7": "",
    "8": "**YES**",
    "9": "Y",
    "a": "yes",
    "b": "Yes - sharp",
    "c": "no, blurred",
    "d": "YES",
    "e": "yes",
}
OTHER_VERDICT = "Maybe"

# Answers by the second hex digit.
LABELS = {
    "0": '{"category":"scenic","subcategory":"beach","description":"d","landmark":null,"city":"Nice",'
    '"mood":"serene","is_professional":true,"has_text_overlay":false}',
    "1": '```json\n{"category":"food","subcategory":"street_food","description":"x","mood":"warm",'
    '"is_professional":"Yes","has_text_overlay":"0"}\n```',
    "2": 'Here you go: {"category":"hotel","city":"Rome","mood":"luxurious","is_professional":"TRUE"} hope it helps',
    "3": "I cannot label this.",
    "4": '{"category":"museum","mood":"gloomy","is_professional":false,"has_text_overlay":"1"}',
    "5": '{"category": broken}',
    "6": '[{"category":"food"}',
    "7": "[1,2]",
    "8": '{"category":"people"} {"category":"food"}',
    "9": '```JSON {"category":"transport","mood":"cool"}```',
    "a": "{}",
    "b": '"scenic"',
}
OTHER_LABEL = '{"category":"lifestyle","mood":"casual","has_text_overlay":true}'


def by_digit(answers: dict[str, str], other: str, digit: int):
    """A model factory that looks only at the image of the request."""

    def factory():
        import hashlib

        def model(requests):
            found = []
            for messages in requests:
                image = next(p["image"] for p in messages[-1]["content"] if p["type"] == "image")
                found.append(answers.get(hashlib.md5(image).hexdigest()[digit], other))
            return found

        return model

    return factory


def filter_model():
    return by_digit(VERDICTS, OTHER_VERDICT, 0)


def label_model():
    return by_digit(LABELS, OTHER_LABEL, 1)


def text_model(fail: bool = False):
    """Answers by the length of the first text part; some lengths fail on request."""

    def factory():
        def model(requests):
            found = []
            for messages in requests:
                size = len(messages[-1]["content"][0]["text"])
                if fail and size % 7 == 0:
                    found.append(ValueError(f"cannot read {size} characters"))
                elif fail and size % 11 == 0:
                    found.append(RuntimeError("out of memory"))
                else:
                    found.append("  YES \n" if size % 2 == 0 else "no")
            return found

        return model

    return factory


def no_wait():
    def sleep(seconds):
        return None

    return sleep
