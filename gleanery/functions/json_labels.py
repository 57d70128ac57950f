"""Strict JSON parsing of model answers into typed label columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanery.functions.text import let, strip_fences
from gleanery.schemas import CATEGORIES, LABEL_FLAG_FIELDS, LABEL_TEXT_FIELDS, MOODS

# Strings that count as true, and the error prefixes.
TRUE_WORDS = ("true", "yes", "1")
NO_OBJECT = "No JSON object found: "
BAD_JSON = "JSONDecodeError: "
RAW_CHARS = 200


def strict_json(text: Column) -> Column:
    """The text as a variant if all of it is one JSON value, else NULL.

    Spark's JSON parser ignores whatever follows the first value.  The text is
    therefore parsed as the first element of an array that a digest of the text
    ends: trailing text moves the digest or breaks the array.
    """

    def closed(wrapped: Column, digest: Column) -> Column:
        ends = F.try_variant_get(wrapped, "$[1]", "string") == digest
        alone = F.try_variant_get(wrapped, "$[2]", "variant").isNull()
        return F.when(ends & alone, F.try_variant_get(wrapped, "$[0]", "variant"))

    return let(
        F.md5(text),
        lambda digest: let(
            F.try_parse_json(F.concat(F.lit("["), text, F.lit(',"'), digest, F.lit('"]'))),
            lambda wrapped: closed(wrapped, digest),
        ),
    )


def embedded_object(text: Column) -> Column:
    """From the first ``{`` to the last ``}``, across lines; empty if there is none."""
    first = F.instr(text, "{")
    last = F.char_length(text) - F.instr(F.reverse(text), "}") + 1
    there = (first > 0) & (F.instr(text, "}") > 0) & (last > first)
    return F.when(text.isNotNull(), F.when(there, F.substring(text, first, last - first + 1)).otherwise(""))


def answer_document(answer: Column) -> Column:
    """A model answer as a variant: the whole text, else the object embedded in it."""
    return let(
        strip_fences(answer),
        lambda text: F.coalesce(strict_json(text), let(embedded_object(text), strict_json)),
    )


def parse_error(answer: Column, document: Column) -> Column:
    """Why an answer has no document; NULL where it has one."""
    raw = F.left(answer, F.lit(RAW_CHARS))
    no_object = embedded_object(strip_fences(answer)) == ""
    return F.when(
        answer.isNotNull() & document.isNull(),
        F.when(no_object, F.concat(F.lit(NO_OBJECT), raw)).otherwise(F.concat(F.lit(BAD_JSON), raw)),
    )


def is_object(document: Column) -> Column:
    return F.coalesce(F.schema_of_variant(document).startswith("OBJECT<"), F.lit(False))


def field_type(document: Column, name: str) -> Column:
    """STRING, BOOLEAN, …; VOID for a JSON null as for an absent field."""
    return F.coalesce(
        F.schema_of_variant(F.try_variant_get(document, f"$.{name}", "variant")), F.lit("VOID")
    )


def text_field(document: Column, name: str) -> Column:
    return F.try_variant_get(document, f"$.{name}", "string")


def flag_field(document: Column, name: str) -> Column:
    """A JSON boolean as it is; a string by the fixed true words."""
    value = text_field(document, name)
    return let(
        field_type(document, name),
        lambda kind: F.when(kind == "BOOLEAN", value == "true").when(
            kind == "STRING", F.lower(value).isin(*TRUE_WORDS)
        ),
    )


def type_errors(document: Column) -> Column:
    """Names of the label fields whose JSON type does not fit their column."""
    fitting = {name: ("STRING", "VOID") for name in LABEL_TEXT_FIELDS}
    fitting |= {name: ("BOOLEAN", "STRING", "VOID") for name in LABEL_FLAG_FIELDS}
    return F.concat_ws(
        ",", *[F.when(~field_type(document, name).isin(*types), F.lit(name)) for name, types in fitting.items()]
    )


def rejection(document: Column) -> Column:
    """Why a document cannot become a label row; NULL where it can, or where there is none."""
    wrong = let(
        type_errors(document), lambda names: F.when(names != "", F.concat(F.lit("label_type_error: "), names))
    )
    return F.when(
        document.isNotNull(), F.when(is_object(document), wrong).otherwise(F.lit("label_not_an_object"))
    )


def label_struct(document: Column) -> Column:
    """The typed label fields of a document."""
    return F.struct(
        *[text_field(document, name).alias(name) for name in LABEL_TEXT_FIELDS],
        *[flag_field(document, name).alias(name) for name in LABEL_FLAG_FIELDS],
    )


def category_known(category: Column) -> Column:
    return F.coalesce(category.isin(*CATEGORIES), F.lit(False))


def mood_known(mood: Column) -> Column:
    return F.coalesce(mood.isin(*MOODS), F.lit(False))
