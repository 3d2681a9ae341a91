"""Licence recognition by known sentences and ordered rules over them.

A text is cut into normalised sentences, known licence sentences are looked up
among them, in one line or wrapped over several, and the sequence of identifiers found is matched against
rules, each an ordered list of identifiers. All of it happens inside the row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Normalised licence sentences and their identifiers.
SENTENCES = {
    "released under the mit license": "mit-ref",
    "licensed under the mit license": "mit-ref",
    "the mit license": "mit-title",
    "mit license": "mit-title",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "mit-grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit-notice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "mit-warranty",
    "licensed under the apache license version 2 0": "apache-ref",
    "licensed under the apache license version 2 0 the license": "apache-ref",
    "you may not use this file except in compliance with the license": "apache-comply",
    "you may obtain a copy of the license at": "apache-copy",
    "this work is licensed under the gnu general public license version 3": "gpl3-ref",
    "licensed under the gnu general public license version 3": "gpl3-ref",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "gpl3-grant",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose": "gpl-warranty",
    "licensed under cc by 4 0": "ccby-ref",
    "licensed under cc by sa 4 0": "ccbysa-ref",
    "licensed under cc by nc 4 0": "ccbync-ref",
    "licensed under cc by nd 4 0": "ccbynd-ref",
    "this work is licensed under a creative commons attribution 4 0 international license": "ccby-ref",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd-grant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsd-source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "bsd-binary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd-names",
    "all rights reserved": "reserved",
}

# Licence, the identifiers it needs in this order, and how many
# other known sentences may stand between two of them.
RULES = [
    ("MIT", ("mit-ref",), 0),
    ("MIT", ("mit-grant", "mit-notice", "mit-warranty"), 1),
    ("Apache-2.0", ("apache-ref",), 0),
    ("Apache-2.0", ("apache-comply", "apache-copy"), 1),
    ("GPL-3.0-only", ("gpl3-ref",), 0),
    ("GPL-3.0-or-later", ("gpl3-grant", "gpl-warranty"), 1),
    ("CC-BY-4.0", ("ccby-ref",), 0),
    ("CC-BY-SA-4.0", ("ccbysa-ref",), 0),
    ("CC-BY-NC-4.0", ("ccbync-ref",), 0),
    ("CC-BY-ND-4.0", ("ccbynd-ref",), 0),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names"), 1),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary"), 0),
    ("Proprietary", ("reserved",), 0),
]
# A licence that, when found, says that the other is not meant.
OVERRIDES = [("BSD-3-Clause", "BSD-2-Clause"), ("MIT", "Proprietary")]

#: Ends a sentence: a full stop, question or exclamation mark before white space.
SENTENCE_END = r"([.!?])[ \t\r\n]+"
#: What is not a lower-case letter or digit separates words.
GAP = r"[^a-z0-9]+"


def rule_pattern(ids: tuple[str, ...], slack: int) -> str:
    """A regular expression over identifiers that are each written as ``<id>``."""
    between = f"(<[a-z0-9-]+>){{0,{slack}}}" if slack else ""
    return between.join(f"<{i}>" for i in ids)


def normal_lines(text: Column) -> Column:
    """Normalised ``text``, no line of which goes beyond a sentence.

    An empty line follows where a sentence ends by its punctuation, and stays
    where ``text`` has one.
    """
    lines = F.regexp_replace(F.lower(text), SENTENCE_END, "$1\n\n")
    words = F.regexp_replace(lines, GAP.replace("[^", "[^\n"), " ")
    return F.trim(F.regexp_replace(words, " ?\n ?", "\n"))


def known_sentence() -> str:
    """A regular expression for a known sentence that fills one line or several in a row."""
    said = sorted(SENTENCES, key=lambda s: (-len(s), s))
    return f"(?m)^(?:{'|'.join(s.replace(' ', '[ \n]') for s in said)})$"


def scan_licences(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row for each row of ``docs`` with the licences that its text names.

    ``licences`` holds the matched ones in order of the alphabet, joined by
    commas ('' if none), ``sentence_ids`` the sequence of known sentences,
    ``n_sentences`` and ``n_known`` count all and known sentences. A line's end
    counts as a sentence's, but a known sentence is also found if it is wrapped
    over lines, behind comment marks or not. Null and empty
    texts have no sentences. Rows are independent: repeated ones give repeated
    results, an empty table none; other columns are ignored. No shuffle.
    """
    known = F.create_map(*[F.lit(x) for pair in SENTENCES.items() for x in pair])
    rows = docs.select(
        F.col(id_column).alias("doc_id"),
        normal_lines(F.coalesce(text_column, F.lit(""))).alias("_lines"),
    )
    said = F.regexp_extract_all("_lines", F.lit(known_sentence()), F.lit(0))
    ids = F.transform(said, lambda s: F.element_at(known, F.translate(s, "\n", " ")))
    rows = rows.withColumn("_ids", ids)
    tagged = F.array_join(F.transform("_ids", lambda i: F.concat(F.lit("<"), i, F.lit(">"))), "")
    rows = rows.withColumn("_tags", tagged)
    found: dict[str, Column] = {}
    for name, needed, slack in RULES:
        hit = F.col("_tags").rlike(rule_pattern(needed, slack))
        found[name] = found[name] | hit if name in found else hit
    meant = dict(found)
    for stronger, weaker in OVERRIDES:
        meant[weaker] = meant[weaker] & ~found[stronger]
    named = F.array_compact(F.array(*[F.when(meant[n], F.lit(n)) for n in sorted(meant)]))
    return rows.select(
        "doc_id",
        F.array_join(named, ",").alias("licences"),
        F.array_join("_ids", ",").alias("sentence_ids"),
        F.size(F.filter(F.split("_lines", "\n"), lambda s: s != "")).cast("long").alias("n_sentences"),
        F.size("_ids").cast("long").alias("n_known"),
    )
