"""Licence texts in documents, by Dice coefficient over word bigrams.

Method.  A unit of a document (its whole text, a paragraph, a line) is
normalised to lower-case words and compared with licence templates: twice the
shared word bigrams over the sum of both sets' sizes.  A coefficient of at
least t needs sizes within t / (2 - t) of each other, so a unit is only compared
with templates of about its size; units whose size fits no template are left
out before any bigram is made.

Everything is a Column expression over one row: no shuffle, no Python on the
executors.  Templates are a parameter of bounded size and travel with the plan.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8

# Public licence notices, by name.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "MIT": "Released under the MIT License.",
    "MIT notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "ISC notice": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0 notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "GPL-2.0 notice": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "BSD-2 notice": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "MPL-2.0 notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "All rights reserved": "All rights reserved.",
}


def _words(text: str) -> list[str]:
    return [w for w in re.split("[^a-z0-9]+", text.lower()) if w]


def bigrams(words: list[str]) -> list[str]:
    """Distinct pairs of neighbouring words; one word stands for itself."""
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])} or set(words))


def size_bounds(n: int, threshold: float = THRESHOLD) -> tuple[int, int]:
    """Numbers of bigrams a unit may have that reaches the threshold against a template of n."""
    ratio = threshold / (2 - threshold)
    low, high = int(n * ratio), int(n / ratio) + 1
    return max(low, 1), high


def _unit_words(unit: Column) -> Column:
    return F.filter(F.split(F.lower(unit), "[^a-z0-9]+"), lambda w: w != "")


def _unit_bigrams(words: Column) -> Column:
    pairs = F.transform(F.slice(words, 1, F.size(words) - 1), lambda w, i: F.concat_ws(" ", w, F.get(words, i + 1)))
    return F.array_distinct(F.when(F.size(words) > 1, pairs).otherwise(words))


def _scored(grams: Column, templates: dict[str, str], threshold: float) -> Column:
    """Struct (dice, name) of each template that the unit reaches."""
    kind = "array<struct<dice:double,name:string>>"
    found = []
    for name in sorted(templates):
        own = bigrams(_words(templates[name]))
        low, high = size_bounds(len(own), threshold)
        dice = F.size(F.array_intersect(grams, F.lit(own))) * 2.0 / (F.size(grams) + len(own))
        hit = F.size(grams).between(low, high) & (dice >= threshold)
        found.append(F.when(hit, F.array(F.struct(dice, F.lit(name))).cast(kind)).otherwise(F.array().cast(kind)))
    return F.concat(*found)


def units(text: Column) -> Column:
    """The whole text, its paragraphs and its lines, each once."""
    return F.array_distinct(F.concat(F.array(text), F.split(text, "\n[ \t]*\n"), F.split(text, "\n")))


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, licenses, best, best_dice, n_hits) of every row.

    licenses: names of all templates some unit reaches, in order, comma-joined;
    best: the one of the largest coefficient, ties to the first name; n_hits: units
    that reach a template.  Null and empty texts have none: "" and 0; repeated
    rows are scanned alike; extra columns are ignored; an empty table gives no rows.
    """
    bounds = [size_bounds(len(bigrams(_words(t))), threshold) for t in templates.values()]
    # distinct bigrams are fewer than words, so only the lower bound holds for words; long units can repeat themselves
    fewest = min(low for low, _ in bounds)
    text = F.coalesce("text", F.lit(""))
    cut = F.filter(F.transform(units(text), _unit_words), lambda w: F.size(w) >= fewest)
    sized = F.filter(F.transform(cut, _unit_bigrams), lambda g: _any_fit(F.size(g), bounds))
    hits = F.filter(F.transform(sized, lambda g: _scored(g, templates, threshold)), lambda h: F.size(h) > 0)
    read = docs.select("doc_id", hits.alias("hits"))
    # a generator keeps the hits from being worked out again for each column
    rows = read.select("doc_id", F.size("hits").alias("n_hits"), F.explode(F.array(F.flatten("hits"))).alias("all"))
    ranked = F.array_sort(F.transform("all", lambda h: F.struct((-h["dice"]).alias("loss"), h["name"].alias("name"))))
    first = F.get(ranked, F.lit(0))
    return rows.select("doc_id", F.array_join(F.array_sort(F.array_distinct(F.transform("all", lambda h: h["name"]))), ",").alias("licenses"),
                       F.coalesce(first["name"], F.lit("")).alias("best"), F.coalesce(-first["loss"], F.lit(0.0)).alias("best_dice"), "n_hits")


def _any_fit(n: Column, bounds: list[tuple[int, int]]) -> Column:
    fits = F.lit(False)
    for low, high in bounds:
        fits = fits | n.between(low, high)
    return fits


def oracle_sql(templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> str:
    """The scan in SQL, by unnesting units and joining all templates."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    rows = ", ".join(f"({quoted(n)}, [{', '.join(map(quoted, bigrams(_words(t))))}])" for n, t in templates.items())
    return f"""
WITH templates(name, own) AS (VALUES {rows}),
units AS (
  SELECT row, doc_id, unnest(list_distinct(list_concat([t], regexp_split_to_array(t, '\\n[ \\t]*\\n'), string_split(t, chr(10))))) AS unit
  FROM (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t FROM documents)),
words AS (SELECT row, unit, list_filter(regexp_split_to_array(lower(unit), '[^a-z0-9]+'), lambda w: w <> '') AS w FROM units),
grams AS (
  SELECT row, unit, list_distinct(CASE WHEN len(w) > 1 THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) ELSE w END) AS g
  FROM words WHERE len(w) > 0),
scored AS (
  SELECT row, unit, name, len(list_intersect(g, own)) * 2.0::DOUBLE / (len(g) + len(own)) AS dice FROM grams, templates),
hits AS (SELECT * FROM scored WHERE dice >= {threshold}),
docs AS (
  SELECT row, string_agg(DISTINCT name, ',' ORDER BY name) AS licenses, arg_min(name, (-dice, name)) AS best, max(dice) AS best_dice,
         count(DISTINCT unit) AS n_hits
  FROM hits GROUP BY row)
SELECT d.doc_id, coalesce(licenses, '') AS licenses, coalesce(best, '') AS best, coalesce(best_dice, 0.0)::DOUBLE AS best_dice,
       coalesce(n_hits, 0)::INT AS n_hits
FROM (SELECT row_number() OVER () AS row, doc_id FROM documents) d LEFT JOIN docs USING (row)"""
