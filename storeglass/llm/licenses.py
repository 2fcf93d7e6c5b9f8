"""Licence scan (operator 6): Dice coefficient over word bigrams against templates. Built-in functions only.

A text is looked at line by line, as a whole, and by runs of its words, wherever lines break. Of each unit, the
normalised words give a set of bigrams. Two sets of sizes a and b can only reach a Dice coefficient t if min(a, b) >= t /
(2 - t) * max(a, b), so sizes alone rule out most templates; texts without any bigram that a match needs are dropped
before a set is built. The templates are literals of the plan (a parameter of a few short texts, not data), hence there
is no join.

Runs find a notice that is wrapped over lines or stands inside a longer paragraph. A run has at most as many bigrams,
with repeats, as the upper size bound of a template of that length. Of runs that overlap, the one counts that shares
most with its template, less what only one of both has. A run is told only if its template was not found for a line
that it touches, or for the whole text; its line_no is the line in which it starts, so a line may have two rows.

Odd rows: null and empty texts have no unit and no finding; units with fewer than two words neither; a line that occurs
twice is found twice; equal coefficients go to the template that comes first by name; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

#: Least coefficient, in percent.
LEAST = 80
#: Short licence notices as their licences word them.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at"),
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
           "the following conditions are met:",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL": "This work is licensed under the GNU General Public License, version 3.0.",
    "GPL notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation"),
    "MIT": "Released under the MIT License.",
    "MIT permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction'),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
_NOT_WORD = "[^a-z0-9]+"


def template_bigrams(template: str) -> list[str]:
    words = re.sub(_NOT_WORD, " ", template.lower()).split()
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def size_range(size: int, least: int = LEAST) -> tuple[int, int]:
    """Smallest and largest set size that can reach `least` percent with a set of this size: 2 * min >= t * (a + b)."""
    low = -(-least * size // (200 - least))
    return low, (200 - least) * size // least


def normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), _NOT_WORD, " "))


def bigrams(words: Column) -> Column:
    """Of an array of words, in their order, with repeats."""
    return F.zip_with(
        F.slice(words, 1, F.size(words) - 1), F.slice(words, 2, F.size(words) - 1), lambda a, b: F.concat_ws(" ", a, b))


def using(value: Column, make: Callable[[Column], Column]) -> Column:
    """make(value), with value computed once."""
    return F.get(F.transform(F.array(value), make), F.lit(0))


def indices(first: Column, last: Column) -> Column:
    """first to last, empty if last is smaller."""
    return F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))


def scan(docs: DataFrame, templates: dict[str, str] | None = None, least: int = LEAST) -> DataFrame:
    """One row per unit with a match: doc_id, line_no (from 1; 0 is the whole text of several lines; of a run of words
    the line in which it starts), its best template, the sizes and the shared number of bigrams, and the coefficient."""
    known = {name: template_bigrams(text) for name, text in sorted((templates or TEMPLATES).items())}
    ranges = [size_range(len(grams), least) for grams in known.values()]
    # Bigrams of the longest run: as the upper size bound, but of all that the template has, with repeats.
    spans = [size_range(len(re.sub(_NOT_WORD, " ", (templates or TEMPLATES)[name].lower()).split()) - 1, least)[1]
             for name in known]
    low, high, longest = min(r[0] for r in ranges), max(r[1] for r in ranges), max(spans)
    given = F.array(*[
        F.struct(F.lit(k).alias("order"), F.lit(name).alias("template"), F.array(*map(F.lit, own)).alias("grams"),
                 F.lit(len(own)).alias("n_template"), F.lit(fewest).alias("low"), F.lit(most).alias("high"),
                 F.lit(span).alias("span"))
        for k, ((name, own), (fewest, most), span) in enumerate(zip(known.items(), ranges, spans, strict=True))])
    # A match shares at least `low` of a template's b bigrams, so one of any b - low + 1 of them is in the unit. The
    # longest ones are asked for, as they are the rarest.
    telling = set()
    for grams, (fewest, _) in zip(known.values(), ranges, strict=True):
        telling |= set(sorted(grams, key=lambda g: (-len(g), g))[: len(grams) - fewest + 1])
    asked = "(?:^| )(?:" + "|".join(sorted(telling)) + ")(?: |$)"

    def enough(unit: Column) -> Column:
        # Words are counted by their separators first: a set of bigrams has at most words - 1 members. An upper bound on
        # words alone would lose texts that repeat themselves, so only the size of the set is held against it.
        return (F.length(unit) - F.length(F.translate(unit, " ", "")) >= max(low, 1)) & unit.rlike(asked)

    def match(line_no: Column, n: Column, shared: Column, t: Column, start: Column, end: Column) -> Column:
        return F.struct(
            (n + t["n_template"] - 3 * shared).alias("cost"), n.alias("n_bigrams"), t["order"].alias("order"),
            start.alias("start"), end.alias("end"), line_no.alias("line_no"), t["template"].alias("template"),
            t["n_template"].alias("n_template"), shared.alias("n_shared"))

    def good(x: Column) -> Column:
        return 200 * x["n_shared"] >= least * (x["n_bigrams"] + x["n_template"])

    def best_of_unit(line_no: Column, unit: Column) -> Column:
        def of_set(grams: Column) -> Column:
            n = F.size(grams)
            fits = F.filter(given, lambda t: n.between(t["low"], t["high"]))
            found = F.filter(F.transform(fits, lambda t: match(
                line_no, n, F.size(F.array_intersect(grams, t["grams"])), t, F.lit(-1), F.lit(-1))), good)
            best = F.array_max(F.transform(found, lambda x: F.struct(
                (2 * x["n_shared"] / (x["n_bigrams"] + x["n_template"])).alias("dice"), (-x["order"]).alias("order"), x.alias("t"))))
            return F.when(n.between(low, high), best["t"])

        return F.when(enough(unit), using(F.array_distinct(bigrams(F.split(unit, " "))), of_set))

    def runs(grams: Column, hits: Column, t: Column) -> Column:
        """Matches of one template among hits that lie close together. The best run starts and ends with a shared bigram."""
        at = lambda own, k: F.get(own, k)["at"]

        def from_hit(own: Column, k: Column) -> Column:
            ends = F.filter(
                indices(k + t["low"] - 1, F.least(F.size(own), k + t["span"]) - 1),
                lambda j: at(own, j) - at(own, k) < t["span"])
            return F.filter(F.transform(ends, lambda j: match(
                F.lit(0), F.size(F.array_distinct(F.slice(grams, at(own, k) + 1, at(own, j) - at(own, k) + 1))),
                F.size(F.array_distinct(F.transform(F.slice(own, k + 1, j - k + 1), lambda h: h["gram"]))),
                t, at(own, k), at(own, j))), good)

        return using(
            F.filter(hits, lambda h: F.array_contains(t["grams"], h["gram"])),
            lambda own: F.flatten(F.transform(indices(F.lit(0), F.size(own) - t["low"]), lambda k: from_hit(own, k))))

    def apart(found: Column) -> Column:
        """The best of runs that overlap: the one that shares most, less what only one side has; then the next."""
        return using(F.array_sort(found), lambda every: F.aggregate(
            every, F.slice(every, 1, 0), lambda kept, x: F.when(
                F.exists(kept, lambda y: (y["start"] <= x["end"]) & (x["start"] <= y["end"])), kept
            ).otherwise(F.concat(kept, F.array(x)))))

    # The explodes of one element keep the optimiser from building a value again in every place that uses it.
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    some = docs.select(docs["doc_id"], text.alias("text"), F.explode(F.array(normal(text))).alias("whole")).filter(
        enough(F.col("whole")))
    lined = some.select(
        "doc_id", "whole", F.explode(F.array(F.transform(F.split("text", "\n"), normal))).alias("lines"),
    ).select("doc_id", "lines", "whole", F.explode(F.array(bigrams(F.split("whole", " ")))).alias("grams"))
    every = sorted(set().union(*known.values()))
    hits = F.filter(
        F.transform("grams", lambda g, k: F.when(g.isin(every), F.struct(k.alias("at"), g.alias("gram")))), lambda h: h.isNotNull())
    units = F.transform("lines", lambda line, k: best_of_unit(k + 1, line))
    whole = F.when(F.size("lines") > 1, best_of_unit(F.lit(0), F.col("whole")))
    looked = lined.select(
        "doc_id", "lines", "grams",
        F.explode(F.array(F.filter(F.concat(F.array(whole), units), lambda u: u.isNotNull()))).alias("units"))
    marked = looked.select("*", F.explode(F.array(hits)).alias("hits"))
    # No run of a template goes over a gap of more than `longest`, so what lies between gaps is looked at by itself.
    heads = F.filter(
        indices(F.lit(0), F.size("hits") - 1),
        lambda k: (k == 0) | (F.get("hits", k)["at"] - F.get("hits", k - 1)["at"] > longest))
    parts = using(heads, lambda h: F.transform(h, lambda first, k: F.slice(
        F.col("hits"), first + 1, F.coalesce(F.get(h, k + 1), F.size("hits")) - first)))
    chosen = F.flatten(F.transform(
        F.filter(parts, lambda part: F.size(part) >= low),
        lambda part: apart(F.flatten(F.transform(given, lambda t: runs(F.col("grams"), part, t))))))
    placed = marked.select("doc_id", "lines", "units", F.explode(F.array(chosen)).alias("chosen")).select(
        "doc_id", "units", "chosen",
        F.when(F.size("chosen") > 0, F.aggregate(
            "lines", F.array().cast("array<int>"), lambda ends, line: F.concat(ends, F.array(
                F.coalesce(F.element_at(F.when(F.size(ends) > 0, ends), -1), F.lit(0))
                + F.when(line == "", 0).otherwise(F.size(F.split(line, " "))))))).alias("ends"))
    line_of = lambda word: F.size(F.filter(F.col("ends"), lambda end: end <= word)) + 1
    # What a line or the whole text was found for is not told again by a run in it.
    lines_of = F.transform("chosen", lambda x: F.struct(
        line_of(x["start"]).alias("first"), line_of(x["end"] + 1).alias("last"), x.alias("x")))
    fresh = F.filter(lines_of, lambda w: ~F.exists("units", lambda u: (u["template"] == w["x"]["template"]) & (
        (u["line_no"] == 0) | u["line_no"].between(w["first"], w["last"]))))
    told = F.transform(fresh, lambda w: w["x"].withField("line_no", w["first"]))
    out = placed.select("doc_id", F.explode(F.concat("units", told)).alias("u"))
    return out.select(
        "doc_id", F.col("u.line_no").cast("long").alias("line_no"), "u.template",
        *[F.col(f"u.{c}").cast("long").alias(c) for c in ("n_bigrams", "n_template", "n_shared")],
        F.expr("cast(200 * u.n_shared div (u.n_bigrams + u.n_template) AS long)").alias("dice_percent"))
