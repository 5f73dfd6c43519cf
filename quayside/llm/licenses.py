"""Licence recognition by sentences: native DataFrame functions only.

The known licence sentences are found in a text, however its lines are wrapped, each is normalised and mapped to its identifier, and
the sequence of identifiers is matched against ordered licence rules. Everything is one projection: no shuffle, no Python.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of published licence notices, normalised (lower case, one space for whatever is not a-z or 0-9).
SENTENCES = {
    "released under the mit license": "mit-notice",
    "licensed under the mit license": "mit-notice",
    "this project is licensed under the mit license": "mit-notice",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "mit-grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit-notice-kept",
    "licensed under the apache license version 2 0": "apache2-notice",
    "licensed under the apache license version 2 0 the license": "apache2-notice",
    "you may not use this file except in compliance with the license": "apache2-compliance",
    "you may obtain a copy of the license at http www apache org licenses license 2 0": "apache2-copy",
    "this work is licensed under the gnu general public license version 3": "gpl3-notice",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "gpl3-later",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "gpl2-later",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose": "gpl-no-warranty",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd-grant",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd-no-endorsement",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl2-notice",
    "licensed under cc by nc 4 0": "cc-by-nc-4-notice",
    "licensed under cc by 4 0": "cc-by-4-notice",
    "licensed under cc by sa 4 0": "cc-by-sa-4-notice",
    "this work is licensed under a creative commons attribution noncommercial 4 0 international license": "cc-by-nc-4-notice",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by-4-notice",
    "this work is licensed under a creative commons attribution sharealike 4 0 international license": "cc-by-sa-4-notice",
    "all rights reserved": "reserved",
}
# Ordered: the first rule whose identifiers occur in this order (others may stand between) names the licence.
RULES = [
    ("MIT", ["mit-grant", "mit-notice-kept"]),
    ("Apache-2.0", ["apache2-notice", "apache2-compliance"]),
    ("GPL-3.0-or-later", ["gpl3-later", "gpl-no-warranty"]),
    ("GPL-2.0-or-later", ["gpl2-later", "gpl-no-warranty"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-no-endorsement"]),
    ("BSD-2-Clause", ["bsd-grant"]),
    ("GPL-3.0-only", ["gpl3-notice"]),
    ("GPL-3.0-or-later", ["gpl3-later"]),
    ("GPL-2.0-or-later", ["gpl2-later"]),
    ("MPL-2.0", ["mpl2-notice"]),
    ("Apache-2.0", ["apache2-notice"]),
    ("MIT", ["mit-grant"]),
    ("MIT", ["mit-notice"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-4-notice"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-4-notice"]),
    ("CC-BY-4.0", ["cc-by-4-notice"]),
    ("LicenseRef-reserved", ["reserved"]),
]
# A sentence ends at .!?; before white space or at a line end. Inside a known sentence a semicolon or a line end is a blank like any
# other mark, so that wrapped and commented notices are whole; .!? before white space is one only after a single letter ("v. 2.0").
_END = r"[.!?;][ \t\r\n]|[\r\n]"
_OTHER = "[^A-Za-z0-9]"
_WITHIN = rf"(?={_OTHER})[^A-Za-z0-9.!?]*+(?:[.!?](?![ \t\r\n])[^A-Za-z0-9.!?]*+)*+"


def _pattern(sentences: dict[str, str]) -> str:
    """Group 1 is a known sentence that starts and stops at the ends of sentences; of those that start at one place the longest.

    What lies between two words is read once for each run of it, so runs of any length cost no more than their length.
    """
    def one(words: list[str]) -> str:
        gaps = [f"{_OTHER}++" if len(w) == 1 and w.isalpha() else _WITHIN for w in words[:-1]] + [""]
        return "".join(re.escape(w) + gap for w, gap in zip(words, gaps, strict=True))

    known = "|".join(one(s.split()) for s in sorted(sentences, key=len, reverse=True))
    return rf"(?i)(?:\A|(?<=[A-Za-z0-9])(?={_OTHER}*?(?:{_END}))){_OTHER}*+({known})(?={_OTHER}*?(?:{_END}|\z))"


def sentence_ids(text: Column, sentences: dict[str, str]) -> Column:
    """Identifiers of the known sentences of ``text`` in order, as an array."""
    table = F.create_map(*(F.lit(v) for pair in sentences.items() for v in pair))

    def normal(part: Column) -> Column:
        return F.regexp_replace(F.translate(part, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), "[^a-z0-9]+", " ")

    parts = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(_pattern(sentences)), F.lit(1))
    return F.filter(F.transform(parts, lambda p: F.get(F.array(F.try_element_at(table, normal(p))), F.lit(0))), lambda x: x.isNotNull())


def scan_licenses(
    df: DataFrame, sentences: dict[str, str] | None = None, rules: list[tuple[str, list[str]]] | None = None,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(id, n_sentences long, sentence_ids string, license string, rule_no int) for every row.

    ``sentence_ids`` are the recognised sentences in order, comma-joined; ``license`` is that of the first rule whose
    identifiers occur in order, null when none does, and ``rule_no`` its number from 0. Null and empty texts have no
    sentence. Repeated rows are scanned one by one; an empty table gives no rows; other columns are not read.
    """
    sentences, rules = sentences or SENTENCES, rules or RULES
    found = df.select(F.col(f"`{id_col}`").alias(id_col), sentence_ids(F.col(f"`{text_col}`"), sentences).alias("_ids"))
    # A comma on either side of each identifier, so that a rule's parts match whole ones.
    line = F.concat(F.lit(","), F.array_join("_ids", ",,"), F.lit(","))
    number = F.lit(None).cast("int")
    for i, (_, wanted) in reversed(list(enumerate(rules))):
        number = F.when(line.like("%" + "%".join(f",{w}," for w in wanted) + "%"), i).otherwise(number)
    names = F.array(*(F.lit(name) for name, _ in rules))
    return found.select(
        id_col, F.size("_ids").cast("long").alias("n_sentences"), F.array_join("_ids", ",").alias("sentence_ids"),
        number.alias("rule_no"),
    ).withColumn("license", F.get(names, F.col("rule_no")))
