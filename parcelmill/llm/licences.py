"""Licence scans by sentence rules, in built-in functions only.

A text is normalised to lower-case words, with a mark wherever a sentence may end: after a closing mark and at a
blank line it does, at any other line end it may. A known sentence of a licence notice is one that begins and ends
at such marks, however its lines are wrapped; where several begin at one place the longest counts, and the next is
looked for behind it. Each gets its identifier. A licence is recognised where the identifiers that stand one after
the other in the text, unknown sentences left out, contain a rule's sequence in its order without a gap. Rules are
tried from the first to the last, and a rule that another reported rule's sequence contains is not reported
beside it.

Defined cases: a null text has no sentences; texts without known sentences get empty lists; a licence that
occurs several times is listed once; equal rows are all reported; other columns are ignored; no rows give no
rows.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of public licence notices, with their identifiers.
SENTENCES = {
    "apache2-under": "Licensed under the Apache License, Version 2.0.",
    "apache2-notice": 'Licensed under the Apache License, Version 2.0 (the "License").',
    "apache2-use": "You may not use this file except in compliance with the License.",
    "apache2-copy": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0.",
    "mit-released": "Released under the MIT License.",
    "mit-licensed": "Licensed under the MIT License.",
    "mit-permission": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction.',
    "mit-condition": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "gpl3-work": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-free": "This program is free software.",
    "gpl2-later": "You can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 2 of the License, or (at your option) any later version.",
    "gpl3-later": "You can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY.",
    "mpl2-subject": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "bsd-redistribution": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-name": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "ccby4": "Licensed under CC BY 4.0.",
    "ccbysa4": "Licensed under CC BY-SA 4.0.",
    "ccbync4": "Licensed under CC BY-NC 4.0.",
    "ccby4-work": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "gpl2-only": "You can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation.",
    "agpl3-later": "You can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "lgpl-free": "This library is free software.",
    "lgpl-terms": "You can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation.",
    "lgpl21-later": "Either version 2.1 of the License, or (at your option) any later version.",
    "lgpl3-later": "You can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "isc-permission": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "0bsd-permission": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
    "zlib-permission": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
    "zlib-origin": "The origin of this software must not be misrepresented.",
    "zlib-altered": "Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.",
    "zlib-notice": "This notice may not be removed or altered from any source distribution.",
    "epl2-available": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "boost-distributed": "Distributed under the Boost Software License, Version 1.0.",
    "reserved": "All rights reserved.",
}

# The same sentences as the published notices have them, where those above are shorter or cut otherwise.
WHOLE = [
    (
        "mit-permission",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
    ),
    ("apache2-copy", "You may obtain a copy of the License at"),  # a blank line, then the address
    ("gpl2-later", "either version 2 of the License, or (at your option) any later version."),  # after a semicolon
    (
        "epl2-available",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at http://www.eclipse.org/legal/epl-2.0/",
    ),
]

# Licences and the sequences of sentences that give them; longer rules stand before those they contain.
RULES = [
    ("Apache-2.0", ["apache2-notice", "apache2-use", "apache2-copy"]),
    ("Apache-2.0", ["apache2-notice", "apache2-use"]),
    ("Apache-2.0", ["apache2-notice"]),
    ("Apache-2.0", ["apache2-under"]),
    ("MIT", ["mit-permission", "mit-condition"]),
    ("MIT", ["mit-released"]),
    ("MIT", ["mit-licensed"]),
    ("GPL-2.0-or-later", ["gpl-free", "gpl2-later", "gpl-hope"]),
    ("GPL-2.0-or-later", ["gpl-free", "gpl2-later"]),
    ("GPL-3.0-or-later", ["gpl-free", "gpl3-later", "gpl-hope"]),
    ("GPL-3.0-or-later", ["gpl-free", "gpl3-later"]),
    ("GPL-3.0-only", ["gpl3-work"]),
    ("GPL-2.0-only", ["gpl-free", "gpl2-only"]),
    ("AGPL-3.0-or-later", ["gpl-free", "agpl3-later"]),
    ("LGPL-2.1-or-later", ["lgpl-free", "lgpl-terms", "lgpl21-later"]),
    ("LGPL-3.0-or-later", ["gpl-free", "lgpl3-later"]),
    ("MPL-2.0", ["mpl2-subject"]),
    ("BSD-3-Clause", ["bsd-redistribution", "bsd-source", "bsd-binary", "bsd-name"]),
    ("BSD-2-Clause", ["bsd-redistribution", "bsd-source", "bsd-binary"]),
    ("CC-BY-4.0", ["ccby4"]),
    ("CC-BY-4.0", ["ccby4-work"]),
    ("CC-BY-SA-4.0", ["ccbysa4"]),
    ("CC-BY-NC-4.0", ["ccbync4"]),
    ("CC0-1.0", ["cc0"]),
    ("Unlicense", ["unlicense"]),
    ("ISC", ["isc-permission"]),
    ("0BSD", ["0bsd-permission"]),
    ("Zlib", ["zlib-permission", "zlib-origin", "zlib-altered", "zlib-notice"]),
    ("EPL-2.0", ["epl2-available"]),
    ("BSL-1.0", ["boost-distributed"]),
]

# Where a sentence ends: at a closing mark before white space and at a blank line. At any other line end it may.
END = r"[.;:!?]+[ \t\r\n]+|\n[ \t\r]*\n"
JUNK = r"[^a-z0-9]+"
# The marks of both in a normalised text, whose words have no capitals.
ENDS, LINE = "E", "L"


def normalised(sentence: str) -> str:
    """Lower-case words of ASCII letters and digits, as the plan normalises every sentence."""
    return re.sub(JUNK, " ", sentence.lower()).strip(" ")


def _known() -> dict[str, str]:
    """Identifiers by normalised sentence; a sentence that a closing mark divides is known by its longest part alone."""
    out: dict[str, str] = {}
    for key, sentence in [*SENTENCES.items(), *WHOLE]:
        parts = [p for p in (normalised(x) for x in re.split(END, sentence)) if p]
        out[max(parts, key=len)] = key
    return out


def trigger() -> str:
    """A pattern that each known sentence matches whatever its case, so that other texts need not be cut."""
    longest = {max(re.findall("[a-z]+", s), key=len) for s in _known()}
    return "(?i)" + "|".join(sorted(longest))


def _marked(text: Column) -> Column:
    """Normalised words of a text between marks, one blank between any two."""
    ends = F.regexp_replace(F.lower(text), END, f" {ENDS} ")
    words = F.regexp_replace(F.regexp_replace(ends, "\n", f" {LINE} "), f"[^a-z0-9{ENDS}{LINE}]+", " ")
    return F.concat(F.lit(f"{ENDS} "), F.trim(words), F.lit(f" {ENDS}"))


def _pattern() -> str:
    """A pattern of all known sentences between marks, longest first, with line ends between any two words."""
    mark = f"[{ENDS}{LINE}]"
    longest_first = sorted(_known(), key=lambda s: (-len(s), s))
    sentences = "|".join(s.replace(" ", f" (?:{LINE} )*+") for s in longest_first)
    return f"(?<={mark} )(?:{sentences})(?= {mark})"


def sentence_ids(text: Column) -> Column:
    """Identifiers of the known sentences of a text, in their order."""
    known = F.create_map(*[F.lit(x) for pair in _known().items() for x in pair])
    found = F.regexp_extract_all(_marked(text), F.lit(_pattern()), F.lit(0))
    ids = F.transform(found, lambda s: known[F.regexp_replace(s, f"(?:{LINE} )+", "")])
    return F.when(text.rlike(trigger()), ids).otherwise(F.array().cast("array<string>"))


def oracle(table: str = "documents") -> str:
    """The same as DuckDB SQL, lists joined by commas.

    It cuts at every mark into numbered pieces, lays the pieces between two sentence ends one after the other, and
    looks for sentences that begin where a piece does and end where one does.
    """
    values = ", ".join(f"('{sentence}', '{key}')" for sentence, key in _known().items())
    listed = ", ".join(
        f"CASE WHEN {' AND '.join([_sql_has(ids_)] + ['NOT ' + _sql_has(o) for o in _larger(i)])} THEN '{name}' END"
        for i, (name, ids_) in enumerate(RULES)
    )
    return f"""
WITH known(sentence, id) AS (VALUES {values}),
texts AS (SELECT row_number() OVER () AS r, doc_id, lower(coalesce(text, '')) AS t FROM {table}),
parts AS (SELECT r, unnest(p) AS part, unnest(range(len(p))) AS seg FROM (SELECT r, string_split_regex(t, '{END}') AS p FROM texts)),
lines AS (SELECT r, seg, unnest(l) AS raw, unnest(range(len(l))) AS line FROM (SELECT r, seg, string_split(part, chr(10)) AS l FROM parts)),
pieces AS (SELECT r, seg, line, trim(regexp_replace(raw, '{JUNK}', ' ', 'g'), ' ') AS piece FROM lines),
placed AS (SELECT *, sum(length(piece) + 1) OVER (PARTITION BY r, seg ORDER BY line) AS stop FROM pieces WHERE piece <> ''),
whole AS (SELECT r, seg, string_agg(piece, ' ' ORDER BY line) AS whole FROM placed GROUP BY r, seg),
firsts AS (SELECT p.r, p.seg, p.stop - length(p.piece) AS begin_, k.sentence, k.id
           FROM placed p JOIN known k ON starts_with(k.sentence || ' ', p.piece || ' ')),
met AS (SELECT f.*, f.begin_ + length(f.sentence) + 1 AS after FROM firsts f JOIN whole w ON f.r = w.r AND f.seg = w.seg
        AND substr(w.whole, f.begin_::BIGINT, length(f.sentence)) = f.sentence),
ended AS (SELECT m.* FROM met m SEMI JOIN placed e ON e.r = m.r AND e.seg = m.seg AND e.stop + 1 = m.after),
outer_ AS (SELECT * FROM (SELECT *, max(after) OVER (PARTITION BY r, seg ORDER BY begin_, after DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
                          FROM ended) WHERE before IS NULL OR before <= begin_),
seq AS (SELECT t.doc_id, coalesce(s, '') AS s FROM texts t LEFT JOIN
        (SELECT r, string_agg(id, ' ' ORDER BY seg, begin_) AS s FROM outer_ GROUP BY r) USING (r)),
named AS (SELECT doc_id, s, list_filter([{listed}], lambda x: x IS NOT NULL) AS l FROM (SELECT doc_id, s, ' ' || s || ' ' AS q FROM seq))
SELECT doc_id, replace(s, ' ', ',') AS sentence_ids,
       array_to_string([x FOR x, i IN l IF list_position(l, x) = i], ',') AS licences
FROM named"""


def _sql_has(ids: list[str]) -> str:
    return f"contains(q, ' {' '.join(ids)} ')"


def _larger(i: int) -> list[list[str]]:
    """Sequences of other rules that hold this rule's."""
    ids = RULES[i][1]
    return [other for j, (_, other) in enumerate(RULES) if j != i and len(other) > len(ids) and _holds(ids, other)]


def _holds(inner: list[str], outer: list[str]) -> bool:
    return f" {' '.join(inner)} " in f" {' '.join(outer)} "


def licences(docs: DataFrame) -> DataFrame:
    """``doc_id, sentence_ids, licences``: known sentences by place, and recognised licences in rule order."""
    found = docs.select("doc_id", sentence_ids(F.coalesce("text", F.lit(""))).alias("sentence_ids"))
    sequence = F.concat(F.lit(" "), F.array_join("sentence_ids", " "), F.lit(" "))
    has = [sequence.contains(f" {' '.join(ids)} ") for _, ids in RULES]
    rules = []
    for i, (name, _) in enumerate(RULES):
        stands = has[i]
        for other in _larger(i):
            stands = stands & ~sequence.contains(f" {' '.join(other)} ")
        rules.append(F.when(stands, F.lit(name)))
    listed = F.array_distinct(F.array_compact(F.array(*rules)))
    none = F.array().cast("array<string>")
    return found.select("doc_id", "sentence_ids", F.when(F.size("sentence_ids") > 0, listed).otherwise(none).alias("licences"))
