"""License scans: lines and paragraphs against templates by the Dice coefficient of word bigrams.

A text is normalised (ASCII lower case, everything but a-z and 0-9 a space) and taken apart into lines
and into paragraphs of several lines. A piece and a template of ``s`` and ``t`` distinct bigrams can only reach
a coefficient ``d`` if ``s`` lies between ``t * d / (2 - d)`` and ``t * (2 - d) / d``: other templates are not
compared, and a piece that fits none, or shares no bigram with any, is dropped first. All of it happens
within a row, so nothing is shuffled, and neither long texts nor frequent notices gather anywhere.

Defined cases: a null or empty text has no pieces and no license. Of templates with the same
coefficient the first in the list counts. Repeated rows are reported each. An empty table gives no rows.
Other columns play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from loamsift.llm.common import ascii_lower, text_of

MIN_DICE = 0.8

# License identifiers and the notices that announce them.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the Software), to deal in the Software without restriction, including without limitation the"
        " rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to"
        " permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public"
        " License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any"
        " later version.",
    ),
    (
        "GPL-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public"
        " License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any"
        " later version.",
    ),
    (
        "BSD",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
        " following conditions are met:",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
        " granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not"
        " distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
)


def template_bigrams(text: str) -> list[str]:
    words = "".join(c if c.isascii() and c.isalnum() else " " for c in text.lower()).split()
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:])))


def _bigrams(words: Column) -> Column:
    pairs = F.greatest(F.size(words) - 1, F.lit(0))
    return F.array_distinct(F.zip_with(F.slice(words, F.lit(1), pairs), F.slice(words, F.lit(2), pairs), lambda a, b: F.concat(a, F.lit(" "), b)))


def scan(docs: DataFrame, templates=TEMPLATES, min_dice: float = MIN_DICE) -> DataFrame:
    """A row per document: ``doc_id, matches``, an array of (piece, dice, license, template).

    ``piece`` counts the lines of the text, then its paragraphs of several lines; ``template`` counts the templates.
    """
    known = [template_bigrams(text) for _, text in templates]
    shortest = min(map(len, known)) * min_dice / (2 - min_dice)
    longest = max(map(len, known)) * (2 - min_dice) / min_dice
    table = F.array(*[
        F.struct(F.lit(i).alias("i"), F.lit(name).alias("name"), F.array(*map(F.lit, own)).alias("own"))
        for i, ((name, _), own) in enumerate(zip(templates, known))
    ])
    anything = F.array(*map(F.lit, dict.fromkeys(x for own in known for x in own)))

    def best(piece: Column) -> Column:
        size = F.size(piece["bigrams"])
        fitting = F.filter(table, lambda t: (size >= F.size(t["own"]) * F.lit(min_dice / (2 - min_dice))) & (size <= F.size(t["own"]) * F.lit((2 - min_dice) / min_dice)))
        compared = F.transform(fitting, lambda t: F.struct(
            (F.lit(2.0) * F.size(F.array_intersect(piece["bigrams"], t["own"])) / (size + F.size(t["own"]))).alias("dice"),
            (-t["i"]).alias("minus"), t["name"].alias("license"),
        ))
        top = F.array_max(compared)
        return F.struct(piece["piece"].alias("piece"), top["dice"].alias("dice"), top["license"].alias("license"), (-top["minus"]).alias("template"))

    normal = F.regexp_replace(ascii_lower(text_of()), r"[^a-z0-9\n]+", " ")
    return (
        docs.select("doc_id", normal.alias("_text"))
        .withColumn("_pieces", F.concat(
            F.split("_text", "\n", -1),
            F.transform(F.filter(F.split("_text", "\n ?\n", -1), lambda p: F.contains(p, F.lit("\n"))), lambda p: F.replace(p, F.lit("\n"), F.lit(" "))),
        ))
        .withColumn("_words", F.transform("_pieces", lambda p: F.array_remove(F.split(p, " +"), "")))
        .withColumn("_bigrams", F.transform("_words", lambda w, i: F.struct(i.alias("piece"), F.when(F.size(w) > 1, _bigrams(w)).alias("bigrams"))))
        .withColumn("_fitting", F.filter("_bigrams", lambda p: F.size(p["bigrams"]).between(shortest, longest) & F.arrays_overlap(p["bigrams"], anything)))
        .select("doc_id", F.filter(F.transform("_fitting", best), lambda m: m["dice"] >= min_dice).alias("matches"))
    )
