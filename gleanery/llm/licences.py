"""Licence recognition by sentences: known sentences become identifiers, ordered rules match identifier sequences.

A text is cut into sentences in four ways: at line breaks and sentence ends (for
licence lines), at sentence ends only (for wrapped licence texts), and at
sentence ends, colons, blank lines, copyright lines and list numbers, once
without and once with list bullets (for whole licence files; as the marks of
bullets also open the lines of comments, both are needed). In the last two, the
known sentences are cut in the same way, and their pieces have to follow each
other. Sentences are normalised and looked up in a small table. What is found,
in the order of the text, is matched against rules; an earlier rule takes its
sentences, so that a long form is not reported again as its parts. Everything is
one expression per row: no shuffle, whatever the table. Only texts with a word
that a known sentence cannot do without are cut.
"""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of public licences and of common references to them.
SENTENCES: dict[str, str] = {
    "apache2-line": "Licensed under the Apache License, Version 2.0.",
    "apache2-header": 'Licensed under the Apache License, Version 2.0 (the "License"); '
    "you may not use this file except in compliance with the License.",
    "apache2-header-open": 'Licensed under the Apache License, Version 2.0 (the "License");',
    "apache2-header-use": "you may not use this file except in compliance with the License.",
    "apache2-copy": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "mit-line": "Released under the MIT License.",
    "mit-line-licensed": "Licensed under the MIT License.",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    'associated documentation files (the "Software"), to deal in the Software without restriction, including without '
    "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
    "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
    "the Software.",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
    "is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "bsd-terms": "Redistribution and use in source and binary forms, with or without modification, are permitted "
    "provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and "
    "the following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions "
    "and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-name": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
    "promote products derived from this software without specific prior written permission.",
    "bsd-line": "Licensed under the BSD License.",
    "gpl-work": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
    "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
    "option) any later version.",
    "gpl2-free": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
    "General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
    "option) any later version.",
    "lgpl-work": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "mpl2": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "cc-by": "Licensed under CC BY 4.0.",
    "cc-by-sa": "Licensed under CC BY-SA 4.0.",
    "cc-by-nc": "Licensed under CC BY-NC 4.0.",
    "cc-by-work": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-work": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "cc0": "This work has been dedicated to the public domain under CC0 1.0.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "reserved": "All rights reserved.",
}

# Licences and the sequences of sentences that show them, in the order in which they are tried.
RULES: list[tuple[str, list[str]]] = [
    ("BSD-3-Clause", ["bsd-terms", "bsd-source", "bsd-binary", "bsd-name"]),
    ("BSD-2-Clause", ["bsd-terms", "bsd-source", "bsd-binary"]),
    ("BSD-3-Clause", ["bsd-source", "bsd-binary", "bsd-name"]),
    ("BSD-2-Clause", ["bsd-source", "bsd-binary"]),
    ("Apache-2.0", ["apache2-header", "apache2-copy"]),
    ("Apache-2.0", ["apache2-header-open", "apache2-header-use", "apache2-copy"]),
    ("Apache-2.0", ["apache2-header-open", "apache2-header-use"]),
    ("MIT", ["mit-line", "mit-grant"]),
    ("MIT", ["mit-grant"]),
    ("ISC", ["isc-grant"]),
    ("GPL-3.0-or-later", ["gpl-free"]),
    ("GPL-2.0-or-later", ["gpl2-free"]),
    ("Apache-2.0", ["apache2-header"]),
    ("Apache-2.0", ["apache2-line"]),
    ("MIT", ["mit-line"]),
    ("MIT", ["mit-line-licensed"]),
    ("BSD", ["bsd-line"]),
    ("GPL-3.0-only", ["gpl-work"]),
    ("LGPL-3.0-only", ["lgpl-work"]),
    ("MPL-2.0", ["mpl2"]),
    ("CC-BY-4.0", ["cc-by"]),
    ("CC-BY-SA-4.0", ["cc-by-sa"]),
    ("CC-BY-NC-4.0", ["cc-by-nc"]),
    ("CC-BY-4.0", ["cc-by-work"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-work"]),
    ("CC0-1.0", ["cc0"]),
    ("Unlicense", ["unlicense"]),
    ("LicenseRef-All-Rights-Reserved", ["reserved"]),
]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SENTENCE_END = r"([.!?;])[\x20\x09-\x0D]+"

# For whole licence files, in lower case. Lines without letters and digits are blank, as in comments.
PIECE_END = r"([.!?;:])[\x20\x09-\x0D]+"
BLANK = r"\n[^a-z0-9\n]*(?=\n)"
COPYRIGHT = r"\n[^a-z0-9\n]*(?:copyright|\(c\)|©)[\x20\x09,:]*(?:\(c\)|©|[0-9]{4}|[<\[{])[^\n]*"
NUMBER = r"(?:\x1E[^a-z0-9\x1E\n]*|\n[^a-z0-9\n]*)(?:[a-z]|[0-9]{1,2})\)[\x20\x09-\x0D]+"
BULLET = r"\n[\x20\x09]*[-*+\u2022\u00B7][\x20\x09]+"
CUT = "\x1E"


def normalised_sentence(sentence: str) -> str:
    """A-Z in lower case, British spelling of the noun folded, all but a-z and 0-9 as one space."""
    kept = "".join(c if c in LOWER or c.isascii() and c.isdigit() else " " for c in sentence.translate(str.maketrans(UPPER, LOWER)))
    return " ".join(kept.split()).replace("licence", "license")


def _sentences(text: Column, lines: bool) -> Column:
    text = F.translate(text, UPPER, LOWER)
    if not lines:
        text = F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")
    text = F.regexp_replace(text, SENTENCE_END, "$1\n")
    text = F.replace(F.regexp_replace(text, r"[^a-z0-9\n]+", F.lit(" ")), F.lit("licence"), F.lit("license"))
    return F.split(text, "\n")


def _pieces(text: Column, bullets: bool) -> Column:
    """Sentences of a whole licence file, cut at its layout, too."""
    text = F.concat(F.lit("\n"), F.translate(F.regexp_replace(text, r"\r\n?|\x1E", "\n"), UPPER, LOWER))
    text = F.regexp_replace(F.regexp_replace(text, BLANK, CUT), COPYRIGHT, CUT)
    if bullets:
        text = F.regexp_replace(text, BULLET, CUT)
    text = F.regexp_replace(F.regexp_replace(text, PIECE_END, "$1" + CUT), NUMBER, CUT)
    text = F.replace(F.regexp_replace(text, r"[^a-z0-9\x1E]+", F.lit(" ")), F.lit("licence"), F.lit("license"))
    return F.split(text, CUT)


def cut_sentences(
    sentences: dict[str, str], rules: list[tuple[str, list[str]]]
) -> tuple[dict[str, str], list[tuple[str, list[str]]]]:
    """The same sentences and rules by pieces; a piece of several sentences is one."""
    pieces: dict[str, str] = {}  # normalised -> id
    made = {}
    for key, text in sentences.items():
        cut = [p for p in map(normalised_sentence, re.split(r"(?<=[.!?;:])\s+", text)) if p]
        made[key] = [pieces.setdefault(p, f"{key}/{i}") for i, p in enumerate(cut)]
    return {key: piece for piece, key in pieces.items()}, [(name, [p for i in ids for p in made.get(i, [i])]) for name, ids in rules]


def _found(sentences: Column, known: Column) -> Column:
    """,id,,id,..., of the known sentences in their order."""
    ids = F.transform(sentences, lambda s: F.element_at(known, F.trim(s)))
    ids = F.filter(ids, lambda i: i.isNotNull())
    return F.array_join(F.transform(ids, lambda i: F.concat(F.lit(","), i, F.lit(","))), "")


def _matched(found: Column, rules: list[tuple[str, list[str]]]) -> Column:
    """Licences of the rules that match, each rule taking the sentences it matched."""
    table = F.array(
        *[F.struct(F.lit(name).alias("name"), F.lit("".join(f",{i}," for i in ids)).alias("ids")) for name, ids in rules]
    )
    start = F.struct(found.alias("left"), F.array().cast("array<string>").alias("names"))

    def step(state: Column, rule: Column) -> Column:
        hit = F.instr(state["left"], rule["ids"]) > 0
        return F.struct(
            F.replace(state["left"], rule["ids"], F.lit(";")).alias("left"),
            F.when(hit, F.array_append(state["names"], rule["name"])).otherwise(state["names"]).alias("names"),
        )

    return F.aggregate(table, start, step)["names"]


def anchors(sentences: dict[str, str]) -> list[str]:
    """Strings of which a text in lower case holds at least one if it holds a known sentence, in one piece or cut.

    No cut and no normalisation joins letters, so the words of a sentence stand
    in the text as they are, but for the spelling of the noun.
    """
    chosen: list[str] = []
    for text in sentences.values():
        words = ["licen" if "license" in w else w for w in normalised_sentence(text).split()]
        if not any(a in w for a in chosen for w in words):
            chosen.append(max(words, key=len, default=""))
    return chosen


def _table(sentences: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for key, text in sentences.items() for x in (normalised_sentence(text), key)])


def recognise_licences(
    df: DataFrame,
    sentences: dict[str, str] | None = None,
    rules: list[tuple[str, list[str]]] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``df``: doc_id, n_found, sentence_ids, licences.

    sentence_ids are the identifiers of known sentences among the lines and
    sentences, in the order of the text, joined by spaces, and n_found their
    number; licences are the distinct names of the rules that match these, the
    sentences of the unwrapped text or those of the text cut at its layout,
    sorted and joined by spaces. All are
    empty (0) for null and empty texts and where nothing is known. Rows with
    null or repeated ids are like others; other columns are ignored.
    Identifiers hold neither commas nor semicolons.
    """
    sentences, rules = sentences or SENTENCES, rules or RULES
    known = _table(sentences)
    pieces, piece_rules = cut_sentences(sentences, rules)
    known_pieces = _table(pieces)
    # Texts without any anchor hold no known sentence: they are like empty ones, and no cut is made of them.
    lower = F.lower(F.col(text_col))
    anchored = reduce(or_, [F.contains(lower, F.lit(a)) for a in anchors(sentences)], F.lit(False))
    rows = df.select(F.col(id_col).alias("doc_id"), F.when(anchored, F.col(text_col)).otherwise("").alias("text"))
    text = F.col("text")
    found = rows.select(
        "doc_id",
        _found(_sentences(text, lines=True), known).alias("by_line"),
        _found(_sentences(text, lines=False), known).alias("unwrapped"),
        _found(_pieces(text, bullets=False), known_pieces).alias("by_layout"),
        _found(_pieces(text, bullets=True), known_pieces).alias("by_bullet"),
    )
    names = F.array_union(_matched(F.col("by_line"), rules), _matched(F.col("unwrapped"), rules))
    for by in ("by_layout", "by_bullet"):
        names = F.array_union(names, _matched(F.col(by), piece_rules))
    ids = F.filter(F.split("by_line", ","), lambda i: i != "")
    return found.select(
        "doc_id",
        F.size(ids).cast("long").alias("n_found"),
        F.array_join(ids, " ").alias("sentence_ids"),
        F.array_join(F.sort_array(names), " ").alias("licences"),
    )


def licences_sql() -> str:
    """The same result as SQL."""

    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    known = ", ".join(f"({quoted(normalised_sentence(text))}, {quoted(key)})" for key, text in SENTENCES.items())
    steps = ["l0 AS (SELECT row, kind, found AS left_over, [] AS names FROM seq)"]
    for i, (name, ids) in enumerate(RULES):
        want = quoted("".join(f",{x}," for x in ids))
        steps.append(
            f"l{i + 1} AS (SELECT row, kind, replace(left_over, {want}, ';') AS left_over, CASE WHEN contains(left_over, {want}) "
            f"THEN list_append(names, {quoted(name)}) ELSE names END AS names FROM l{i})"
        )
    return rf"""
WITH known(sentence, id) AS (VALUES {known}),
docs AS (SELECT row_number() OVER () AS row, doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents),
cut AS (
    SELECT row, 0 AS kind, t FROM docs
    UNION ALL SELECT row, 1, regexp_replace(t, '[\x20\x09-\x0D]+', ' ', 'g') FROM docs
), parts AS (
    SELECT row, kind, string_split(replace(regexp_replace(regexp_replace(t, '{SENTENCE_END}', '\1' || chr(10), 'g'),
        '[^a-z0-9\n]+', ' ', 'g'), 'licence', 'license'), chr(10)) AS s FROM cut
), hits AS (
    SELECT row, kind, pos, trim(sentence) AS sentence
    FROM (SELECT row, kind, unnest(s) AS sentence, generate_subscripts(s, 1) AS pos FROM parts)
), seq AS (
    SELECT row, kind, string_agg(',' || id || ',', '' ORDER BY pos) AS found, string_agg(id, ' ' ORDER BY pos) AS ids, count(*) AS n
    FROM hits JOIN known USING (sentence) GROUP BY row, kind
), {", ".join(steps)},
named AS (
    SELECT row, string_agg(DISTINCT name, ' ' ORDER BY name) AS licences
    FROM (SELECT row, unnest(names) AS name FROM l{len(RULES)}) GROUP BY row
)
SELECT d.doc_id, coalesce(q.n, 0) AS n_found, coalesce(q.ids, '') AS sentence_ids, coalesce(m.licences, '') AS licences
FROM docs d LEFT JOIN seq q ON q.row = d.row AND q.kind = 0 LEFT JOIN named m ON m.row = d.row
"""
