"""Licence scan by sentence rules.

A text is cut into sentences; each is normalised (A-Z lower-cased, everything but a-z and 0-9 one space) and
looked up among known licence sentences, which have identifiers. The sequence of identifiers of a document is
then matched against rules: ordered lists of identifiers that name a licence. The rules have an order, too: one
that matches takes its identifiers, and weaker ones see the rest. "All rights reserved" right before a licence belongs to
its copyright line, and is a rule of its own only elsewhere.

The table knows AGPL-3.0, Apache-2.0, BSD-2-Clause, BSD-3-Clause, BSD (clauses not told), CC-BY-3.0, CC-BY-4.0, CC-BY-NC-4.0,
CC-BY-SA-3.0, CC-BY-SA-4.0, EPL-2.0, GPL-2.0, GPL-2.0-or-later, GPL-3.0, GPL-3.0-or-later, ISC, LGPL-2.1-or-later, LGPL-3.0-or-later,
MIT, MPL-2.0, Unlicense, Zlib and all-rights-reserved. A document under another licence comes back as having none.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

# Licence sentences as published, by identifier. None has a break (see BREAK) inside.
SENTENCES = {
    "agpl3_notice": "Licensed under the GNU Affero General Public License, version 3",
    "all_rights": "All rights reserved",
    "apache2_compliance": "you may not use this file except in compliance with the License",
    "apache2_line": "Licensed under the Apache License, Version 2.0",
    "apache2_named": "Licensed under the Apache License, Version 2.0 (the \"License\")",
    "apache2_obtain": "You may obtain a copy of the License at",
    "bsd_redistribution": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "bsd_source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "bsd_binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    "bsd_names": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "ccby3_line": "Licensed under CC BY 3.0",
    "ccby4_line": "Licensed under CC BY 4.0",
    "ccbync4_line": "Licensed under CC BY-NC 4.0",
    "ccbysa3_line": "Licensed under CC BY-SA 3.0",
    "ccbysa4_line": "Licensed under CC BY-SA 4.0",
    "epl2_notice": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "gpl2_work": "This work is licensed under the GNU General Public License, version 2",
    "gpl3_work": "This work is licensed under the GNU General Public License, version 3",
    "gpl_either2": "either version 2 of the License, or (at your option) any later version",
    "gpl_either3": "either version 3 of the License, or (at your option) any later version",
    "gpl_free": "This program is free software",
    "gpl_hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY",
    "gpl_later": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "gpl_terms": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "isc_grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "lgpl_either21": "either version 2.1 of the License, or (at your option) any later version",
    "lgpl_terms": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    "mit_condition": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    "mit_grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions",
    "mit_line": "Released under the MIT License",
    "mit_warranty": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT",
    "mpl2_notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v",
    "unlicense_domain": "This is free and unencumbered software released into the public domain",
    "zlib_asis": "This software is provided 'as-is', without any express or implied warranty",
    "zlib_grant": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions",
}

# Rules: the licence, and identifiers that follow each other among a document's known sentences; stronger rules first.
RULES = [
    ("Apache-2.0", ["apache2_named", "apache2_compliance", "apache2_obtain"]),
    ("BSD-3-Clause", ["bsd_redistribution", "bsd_source", "bsd_binary", "bsd_names"]),
    ("BSD-2-Clause", ["bsd_redistribution", "bsd_source", "bsd_binary"]),
    ("BSD", ["bsd_redistribution", "bsd_source"]),
    ("GPL-2.0-or-later", ["gpl_free", "gpl_terms", "gpl_either2"]),
    ("GPL-3.0-or-later", ["gpl_free", "gpl_terms", "gpl_either3"]),
    ("GPL-3.0-or-later", ["gpl_free", "gpl_later", "gpl_hope"]),
    ("LGPL-2.1-or-later", ["lgpl_terms", "lgpl_either21"]),
    ("LGPL-3.0-or-later", ["lgpl_terms", "gpl_either3"]),
    ("MIT", ["mit_grant", "mit_condition", "mit_warranty"]),
    ("Zlib", ["zlib_asis", "zlib_grant"]),
    ("AGPL-3.0", ["agpl3_notice"]),
    ("Apache-2.0", ["apache2_line"]),
    ("CC-BY-3.0", ["ccby3_line"]),
    ("CC-BY-4.0", ["ccby4_line"]),
    ("CC-BY-NC-4.0", ["ccbync4_line"]),
    ("CC-BY-SA-3.0", ["ccbysa3_line"]),
    ("CC-BY-SA-4.0", ["ccbysa4_line"]),
    ("EPL-2.0", ["epl2_notice"]),
    ("GPL-2.0", ["gpl2_work"]),
    ("GPL-3.0", ["gpl3_work"]),
    ("ISC", ["isc_grant"]),
    ("MIT", ["mit_line"]),
    ("MPL-2.0", ["mpl2_notice"]),
    ("Unlicense", ["unlicense_domain"]),
    ("all-rights-reserved", ["all_rights"]),
]

# A sentence ends with . ! ? ; or : before white space or at the end, or with an empty line.
BREAK = "[.!?;:]+[ \\t\\n\\r]+|[.!?;:]+\\z|\\n[ \\t\\r]*\\n"


def normalised(text: str) -> str:
    return re.sub("[^a-z0-9]+", " ", text.lower()).strip()


def known() -> list[tuple[str, str]]:
    """(normalised sentence, identifier)."""
    return [(normalised(sentence), name) for name, sentence in sorted(SENTENCES.items())]


def opening() -> str:
    """Pattern of a line break before the first three words of a known sentence: such a line starts a sentence."""
    starts = sorted({"[^a-z0-9\\n]+".join(s.split()[:3]) for s, _ in known()})
    return "(?i)\\n([^a-z0-9\\n]*(?:" + "|".join(starts) + "))"


def _rule_text(rule: list[str]) -> str:
    """The rule as it stands in a sequence whose identifiers have a blank on either side."""
    return "".join(f" {name} " for name in rule)


def _taken(rule: list[str]) -> str:
    """Pattern of what a rule takes out of a sequence: its identifiers and "All rights reserved" right before them."""
    return f"( all_rights )*{_rule_text(rule)}"


def sentences(docs: DataFrame) -> DataFrame:
    """(doc, place, sentence_id) of the known sentences; ``doc`` numbers the rows of ``docs`` by what it is given."""
    text = F.regexp_replace(F.col("text"), F.lit(opening()), F.lit(". \n$1"))
    cut = docs.select("doc", F.posexplode(F.split(text, BREAK)).alias("place", "sentence"))
    lowered = F.translate("sentence", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    clean = cut.select("doc", "place", F.trim(F.regexp_replace(lowered, "[^a-z0-9]+", " ")).alias("sentence"))
    lookup = docs.sparkSession.createDataFrame(known(), "sentence string, sentence_id string")
    return clean.join(F.broadcast(lookup), "sentence").select("doc", "place", "sentence_id")


def licence_scan(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_known, sentence_ids, licences, n_rules.

    ``sentence_ids`` is the sequence of known sentences in text order, joined by one space; ``licences`` the
    sorted distinct licences of the matching rules, joined by a comma; ``n_rules`` the number of rules that match.
    A rule matches where its identifiers follow each other in the sequence (other sentences in between do not
    count) and no stronger rule has taken them. Null and empty texts have none. Repeated rows each get a row: a document is its doc_id and text,
    and equal rows are scanned once. Only texts that contain a first word pair of a known sentence are cut.
    """
    plain = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"))
    starts = sorted({"[^a-z0-9]+".join(s.split()[:2]) for s, _ in known()})
    likely = plain.where(F.col("text").rlike("(?i)" + "|".join(starts)))
    hit = likely.select(F.struct("doc_id", F.xxhash64("text").alias("h"), F.sha2("text", 256).alias("sha")).alias("doc"), "text")
    found = sentences(hit.dropDuplicates(["doc"]))
    listed = found.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("place", "sentence_id"))).alias("s"))
    sequence = listed.select(
        F.col("doc.doc_id").alias("_id"), F.col("doc.sha").alias("_sha"),
        F.size("s").cast("long").alias("_n"), F.array_join(F.col("s.sentence_id"), " ").alias("_ids"),
    )
    keyed = plain.select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("_own"))
    joined = keyed.join(sequence, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_sha")), "left")
    ids = F.coalesce("_ids", F.lit(""))
    # one rule after the other, each on what the stronger ones left
    left, hits = F.concat(F.lit(" "), F.replace(ids, F.lit(" "), F.lit("  ")), F.lit(" ")), []
    for name, rule in RULES:
        hits.append(F.when(F.contains(left, F.lit(_rule_text(rule))), F.lit(name)))
        left = F.regexp_replace(left, F.lit(_taken(rule)), F.lit(" | "))
    matched = F.filter(F.array(*hits), lambda x: x.isNotNull())
    return joined.select(
        "doc_id",
        F.coalesce("_n", F.lit(0).cast("long")).alias("n_known"),
        ids.alias("sentence_ids"),
        F.array_join(F.array_sort(F.array_distinct(matched)), ",").alias("licences"),
        F.size(matched).cast("long").alias("n_rules"),
    )


def licence_sql() -> str:
    """The scan in DuckDB's SQL."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    values = ", ".join(f"({quote(s)}, {quote(n)})" for s, n in known())
    # left_i is what the rules before i leave
    steps = ["' ' || replace(ids, ' ', '  ') || ' ' AS left_0"]
    steps += [f"regexp_replace(left_{i}, {quote(_taken(rule))}, ' | ', 'g') AS left_{i + 1}" for i, (_, rule) in enumerate(RULES)]
    hits = ", ".join(f"CASE WHEN contains(left_{i}, {quote(_rule_text(rule))}) THEN {quote(name)} END" for i, (name, rule) in enumerate(RULES))
    return f"""
    WITH known(sentence, sentence_id) AS (VALUES {values}),
    own AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
    parts AS (
      SELECT r, string_split_regex(regexp_replace(text, {quote(opening())}, E'. \\n\\\\1', 'g'), {quote(BREAK)}) AS p FROM own
    ),
    cut AS (SELECT r, unnest(p) AS sentence, generate_subscripts(p, 1) AS place FROM parts),
    clean AS (
      SELECT r, place, trim(regexp_replace(
        translate(sentence, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9]+', ' ', 'g')) AS sentence
      FROM cut
    ),
    listed AS (
      SELECT r, count(*) AS n, string_agg(sentence_id, ' ' ORDER BY place) AS ids FROM clean JOIN known USING (sentence) GROUP BY r
    ),
    stepwise AS (SELECT r, {", ".join(steps)} FROM listed),
    hits AS (SELECT r, unnest([{hits}]) AS licence FROM stepwise),
    matched AS (
      SELECT r, count(*) AS n_rules, string_agg(DISTINCT licence, ',' ORDER BY licence) AS licences
      FROM hits WHERE licence IS NOT NULL GROUP BY r
    )
    SELECT doc_id, coalesce(n, 0) AS n_known, coalesce(listed.ids, '') AS sentence_ids,
      coalesce(licences, '') AS licences, coalesce(n_rules, 0) AS n_rules
    FROM own LEFT JOIN listed USING (r) LEFT JOIN matched USING (r)
    """
