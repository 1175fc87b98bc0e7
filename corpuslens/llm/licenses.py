"""Licence notices found by the Dice coefficient of word bigrams against templates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens.llm.expressions import let

#: Public notices by SPDX identifier. A parameter of the scan; callers may pass full licence texts.
TEMPLATES: dict[str, str] = {
    "MIT": "Released under the MIT License.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "LicenseRef-reserved": "All rights reserved.",
}
THRESHOLD = 0.8

_GNU = (
    "This program is free software{colon} you can redistribute it and/or modify it under the terms of the GNU "
    "{name} as published by the Free Software Foundation{either} version {version} of the License, or (at your "
    "option) any later version."
)
#: TEMPLATES with other wordings: licence texts of up to some hundred words and standard headers, as
#: SPDX identifier, stroke and wording.
WORDINGS: dict[str, str] = TEMPLATES | {
    "MIT/title": "MIT License",
    "MIT/project": "This project is licensed under the MIT License.",
    "MIT/text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        "copies or substantial portions of the Software."
    ),
    "ISC/text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "BSD-3-Clause/conditions": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met:"
    ),
    "Apache-2.0/project": "This project is licensed under the Apache License 2.0.",
    "Apache-2.0/header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at"
    ),
    "GPL-2.0/header": _GNU.format(colon=";", name="General Public License", either="; either", version=2),
    "GPL-3.0/header": _GNU.format(colon=":", name="General Public License", either=", either", version=3),
    "LGPL-3.0/header": _GNU.format(colon=":", name="Lesser General Public License", either=", either", version=3),
    "AGPL-3.0/header": _GNU.format(colon=":", name="Affero General Public License", either=", either", version=3),
    "MPL-2.0/header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at"
    ),
    "CC-BY-4.0/work": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0/work": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-NC-4.0/work": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
}

_SEPARATORS = r"[^\p{L}\p{N}\n]+"


def template_bigrams(text: str) -> list[str]:
    """Distinct word bigrams of a template, in order, normalised as documents are."""
    found = re.findall(r"[^\W_]+", text.lower())
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(found, found[1:])))


def anchor_bigrams(grams: Sequence[str], threshold: float) -> list[str]:
    """Bigrams one of which every segment has that reaches the threshold with this template.

    A Dice of t with a template of n bigrams takes at least t n / (2 - t) shared ones, so of any
    bigrams that outnumber the rest one is shared; the longest are taken, as they are rarest.
    """
    needed = math.ceil(len(grams) * threshold / (2 - threshold) - 1e-9)
    return sorted(grams, key=lambda g: (-len(g), g))[: len(grams) - needed + 1]


def normalised(text: Column, separators: str = _SEPARATORS) -> Column:
    """Lower case; every run of characters but letters, digits and line feeds becomes one space."""
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), separators, " ")


def segments(text: Column) -> Column:
    """Lines of a normalised text, its paragraphs of several lines, and the whole of it."""
    trimmed = lambda x: F.trim(F.translate(x, "\n", " "))
    lines = F.split(text, "\n")
    blocks = F.filter(F.split(text, r"\n *\n"), lambda x: F.contains(F.trim(x), F.lit("\n")))
    whole = F.when(F.size(lines) > 1, F.array(text)).otherwise(F.array().cast("array<string>"))
    return F.transform(F.concat(lines, blocks, whole), trimmed)


def word_bigrams(segment: Column) -> Column:
    """Distinct neighbouring word pairs of a normalised segment."""

    def pairs(w: Column) -> Column:
        n = F.size(w)
        return F.when(n < 2, F.array().cast("array<string>")).otherwise(
            F.array_distinct(
                F.zip_with(
                    F.slice(w, 1, n - 1), F.slice(w, 2, n - 1), lambda a, b: F.concat(a, F.lit(" "), b)
                )
            )
        )

    return let(F.split(segment, " +"), pairs)


def scan_licenses(
    docs: DataFrame,
    text: str = "text",
    templates: Mapping[str, str] = TEMPLATES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``docs`` with ``licenses``, ``license``, ``dice`` and ``license_text``.

    Each line, paragraph and the whole text is held against each template: Dice is twice the shared
    word bigrams over the sum of both counts. A Dice of t needs counts within t/(2-t) and (2-t)/t of
    each other, so only segments whose word count lies in that range of some template are split
    into bigrams, and only templates in range of the segment's bigrams are compared. Texts without
    any of the templates' anchor bigrams can't reach the threshold and are not split at all.

    ``licenses`` lists all templates that reach ``threshold``, with Dice and segment, best first,
    ties by name; the other three columns describe the first and are null without one. A null or
    empty text has none. One row out for each row in, repeated rows alike; columns of these names
    in the input are replaced. Templates of fewer than two words can't be compared and never match.
    Rows stay where they are read: no shuffle, so no key can be hot.
    """
    added = ("licenses", "license", "dice", "license_text")
    grams = {name: g for name, t in templates.items() if (g := template_bigrams(t))}
    if not grams:
        grams = {"": ["\n"]}  # matches nothing
    low, high = threshold / (2 - threshold), (2 - threshold) / threshold
    least, most = min(map(len, grams.values())) * low, max(map(len, grams.values())) * high
    table = F.array(
        *[
            F.struct(F.lit(n).alias("name"), F.array(*map(F.lit, g)).alias("grams"))
            for n, g in grams.items()
        ]
    )
    known = F.array(*map(F.lit, sorted({x for g in grams.values() for x in g})))
    # Distinct bigrams may be fewer than words, so words bound them only from above.
    in_range = F.filter(
        segments(normalised(F.col(text))),
        lambda s: F.char_length(s) - F.char_length(F.replace(s, F.lit(" "), F.lit(""))) >= least,
    )

    def against(s: Column) -> Column:
        def compare(b: Column) -> Column:
            fitting = F.filter(
                table,
                lambda t: (F.size(b) >= F.size(t["grams"]) * low)
                & (F.size(b) <= F.size(t["grams"]) * high),
            )
            return F.transform(
                fitting,
                lambda t: F.struct(
                    (
                        F.size(F.array_intersect(b, t["grams"])) * 2.0
                        / (F.size(b) + F.size(t["grams"]))
                    ).alias("dice"),
                    t["name"].alias("name"),
                    s.alias("segment"),
                ),
            )

        return let(
            word_bigrams(s),
            lambda b: F.when(
                (F.size(b) >= least) & (F.size(b) <= most) & F.arrays_overlap(b, known), compare(b)
            ).otherwise(compare(F.array().cast("array<string>"))),
        )

    compared = F.filter(F.flatten(F.transform(in_range, against)), lambda h: h["dice"] >= threshold)
    anchors = sorted({a for g in grams.values() for a in anchor_bigrams(g, threshold)})
    anchored = let(
        normalised(F.col(text), r"[^\p{L}\p{N}]+"),
        lambda t: reduce(lambda x, y: x | y, [F.contains(t, F.lit(a)) for a in anchors]),
    )
    hits = F.when(anchored, compared).otherwise(
        F.array().cast("array<struct<dice: double, name: string, segment: string>>")
    )
    first_of = F.array_sort(
        hits,
        lambda a, b: F.when(a["dice"] > b["dice"], -1)
        .when(a["dice"] < b["dice"], 1)
        .when(a["name"] < b["name"], -1)
        .when(a["name"] > b["name"], 1)
        .when(a["segment"] < b["segment"], -1)
        .when(a["segment"] > b["segment"], 1)
        .otherwise(0),
    )
    kept = [c for c in docs.columns if c not in added]
    found = docs.select(*kept, F.array_distinct(first_of).alias("licenses"))
    best = F.get("licenses", F.lit(0))
    return found.select(
        *kept,
        "licenses",
        best["name"].alias("license"),
        best["dice"].alias("dice"),
        best["segment"].alias("license_text"),
    )


def find_notices(
    docs: DataFrame,
    text: str = "text",
    templates: Mapping[str, str] = WORDINGS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """As scan_licenses, but notices are found wherever they stand in a text, across lines too.

    A template of n bigrams is held against every run of the text's words with at most n (2-t)/t
    bigrams. The best run starts and ends with a bigram of the template, else a shorter one is better,
    and has t n / (2-t) of them at least, so only such runs are compared. ``licenses`` has one row for
    each template that reaches the threshold: its best run, of equals the first, then the shortest.
    """
    added = ("licenses", "license", "dice", "license_text")
    rows = []
    for name, template in templates.items():
        if grams := template_bigrams(template):
            needed = math.ceil(len(grams) * threshold / (2 - threshold) - 1e-9)
            most = math.floor(len(grams) * (2 - threshold) / threshold + 1e-9)
            texts = [F.array(*map(F.lit, x)) for x in (grams, anchor_bigrams(grams, threshold))]
            fields = [F.lit(name), *texts, F.lit(needed), F.lit(most)]
            heads = ("name", "grams", "anchors", "needed", "most")
            rows.append(F.struct(*[c.alias(h) for c, h in zip(fields, heads)]))
    hit = "struct<dice: double, name: string, segment: string>"
    none = F.array().cast(f"array<{hit}>")

    def best_run(words: Column, pairs: Column, t: Column) -> Column:
        def runs(at: Column) -> Column:
            return F.when(
                F.size(at) >= t["needed"],
                F.flatten(
                    F.transform(
                        F.sequence(F.lit(0), F.size(at) - t["needed"]),
                        lambda a: F.transform(
                            F.filter(
                                F.slice(at, a + t["needed"], t["most"]),
                                lambda end: end - F.get(at, a) < t["most"],
                            ),
                            lambda end: F.struct(F.get(at, a).alias("start"), (end - F.get(at, a) + 1).alias("n")),
                        ),
                    )
                ),
            ).otherwise(F.array().cast("array<struct<start: int, n: int>>"))

        def score(r: Column) -> Column:
            return let(
                F.array_distinct(F.slice(pairs, r["start"] + 1, r["n"])),
                lambda d: F.struct(
                    (F.size(F.array_intersect(d, t["grams"])) * 2.0 / (F.size(d) + F.size(t["grams"]))).alias("dice"),
                    (-r["start"]).alias("start"),
                    (-r["n"]).alias("n"),
                ),
            )

        places = F.filter(
            F.sequence(F.lit(0), F.size(pairs) - 1), lambda i: F.array_contains(t["grams"], F.get(pairs, i))
        )
        return let(
            F.array_max(F.transform(let(places, runs), score)),
            lambda b: F.struct(
                b["dice"].alias("dice"),
                t["name"].alias("name"),
                F.array_join(F.slice(words, 1 - b["start"], 1 - b["n"]), " ").alias("segment"),
            ),
        )

    def compare(plain: Column, anchored: Column) -> Column:
        def against(words: Column) -> Column:
            n = F.size(words)
            pairs = F.zip_with(
                F.slice(words, 1, n - 1), F.slice(words, 2, n - 1), lambda a, b: F.concat(a, F.lit(" "), b)
            )
            return F.when(
                n >= 2, let(pairs, lambda p: F.transform(anchored, lambda t: best_run(words, p, t)))
            ).otherwise(none)

        return F.when(F.size(anchored) > 0, let(F.split(plain, " "), against)).otherwise(none)

    def hits(plain: Column) -> Column:
        anchored = F.filter(F.array(*rows), lambda t: F.exists(t["anchors"], lambda a: F.contains(plain, a)))
        return F.filter(
            let(anchored, lambda live: compare(plain, live)), lambda h: h["dice"] >= threshold
        )

    found = let(F.trim(normalised(F.col(text), r"[^\p{L}\p{N}]+")), hits) if rows else none
    ordered = F.array_sort(
        found,
        lambda a, b: F.when(a["dice"] > b["dice"], -1)
        .when(a["dice"] < b["dice"], 1)
        .when(a["name"] < b["name"], -1)
        .otherwise(1),
    )
    kept = [c for c in docs.columns if c not in added]
    best = F.get("licenses", F.lit(0))
    return docs.select(*kept, ordered.alias("licenses")).select(
        *kept,
        "licenses",
        best["name"].alias("license"),
        best["dice"].alias("dice"),
        best["segment"].alias("license_text"),
    )
