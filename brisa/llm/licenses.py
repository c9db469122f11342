"""Licence recognition from sentences, with DataFrame functions only.

A text is cut into sentences. A normalised sentence that is known gets the identifier of its licence
sentence; it may run over the ends of wrapped lines, and over a colon or semicolon, but not over a blank line
or a full stop. The identifiers of a text, in order, are then matched against licence rules, also in order: a
rule replaces its run of identifiers by its licence, so that a later, more general rule does not see them again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brisa.llm.common import text_or_empty

# Known sentences, normalised, by identifier.
SENTENCES = {
    "MitBrief": ["released under the mit license", "licensed under the mit license", "license mit",
                 "this project is licensed under the mit license", "distributed under the mit license"],
    "MitGrant": ["permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"],
    "MitNotice": ["the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"],
    "AsIs": ["the software is provided as is without warranty of any kind express or implied"],
    "ApacheBrief": ["licensed under the apache license version 2.0", "released under the apache license version 2.0",
                    "licensed under the apache license version 2.0 the license"],
    "ApacheComply": ["you may not use this file except in compliance with the license"],
    "ApacheCopy": ["you may obtain a copy of the license at"],
    "ApacheUnless": ["unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"],
    "Gpl3Brief": ["this work is licensed under the gnu general public license version 3",
                  "licensed under the gnu general public license version 3"],
    "Gpl2Brief": ["this work is licensed under the gnu general public license version 2",
                  "licensed under the gnu general public license version 2"],
    "GplFree": ["this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"],
    "Gpl3Later": ["either version 3 of the license or at your option any later version"],
    "Gpl2Later": ["either version 2 of the license or at your option any later version"],
    "Lgpl3Brief": ["licensed under the gnu lesser general public license version 3"],
    "Agpl3Brief": ["licensed under the gnu affero general public license version 3"],
    "BsdRedistribute": ["redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"],
    "BsdSource": ["redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"],
    "BsdBinary": ["redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"],
    "BsdBrief": ["released under the bsd license", "licensed under the bsd license"],
    "Mpl2Brief": ["this source code form is subject to the terms of the mozilla public license v. 2.0"],
    "CcBy": ["licensed under cc by 4.0", "licensed under a creative commons attribution 4.0 international license"],
    "CcBySa": ["licensed under cc by sa 4.0"],
    "CcByNc": ["licensed under cc by nc 4.0"],
    "Cc0": ["licensed under cc0 1.0"],
    "PublicDomain": ["this work is in the public domain", "this is free and unencumbered software released into the public domain"],
    "AllRights": ["all rights reserved"],
    "SpdxMit": ["spdx license identifier mit"],
    "SpdxApache": ["spdx license identifier apache 2.0"],
    "SpdxGpl3": ["spdx license identifier gpl 3.0 only", "spdx license identifier gpl 3.0"],
}

# Rules in the order in which they are tried.
RULES = [
    ("MIT", ["MitGrant", "MitNotice", "AsIs"]),
    ("MIT", ["MitGrant", "MitNotice"]),
    ("MIT", ["MitBrief"]),
    ("MIT", ["SpdxMit"]),
    ("Apache-2.0", ["ApacheBrief", "ApacheComply", "ApacheCopy", "ApacheUnless"]),
    ("Apache-2.0", ["ApacheBrief", "ApacheComply"]),
    ("Apache-2.0", ["ApacheBrief"]),
    ("Apache-2.0", ["SpdxApache"]),
    ("GPL-3.0-or-later", ["GplFree", "Gpl3Later"]),
    ("GPL-2.0-or-later", ["GplFree", "Gpl2Later"]),
    ("GPL-3.0", ["Gpl3Brief"]),
    ("GPL-3.0", ["SpdxGpl3"]),
    ("GPL-2.0", ["Gpl2Brief"]),
    ("GPL", ["GplFree"]),
    ("LGPL-3.0", ["Lgpl3Brief"]),
    ("AGPL-3.0", ["Agpl3Brief"]),
    ("BSD-2-Clause", ["BsdRedistribute", "BsdSource", "BsdBinary"]),
    ("BSD", ["BsdRedistribute"]),
    ("BSD", ["BsdBrief"]),
    ("MPL-2.0", ["Mpl2Brief"]),
    ("CC-BY-SA-4.0", ["CcBySa"]),
    ("CC-BY-NC-4.0", ["CcByNc"]),
    ("CC-BY-4.0", ["CcBy"]),
    ("CC0-1.0", ["Cc0"]),
    ("Public-domain", ["PublicDomain"]),
    ("Proprietary", ["AllRights"]),
]

_GNU = ("is free software you can redistribute it and or modify it under the terms of the gnu {} public license "
        "as published by the free software foundation")
_GNU_ONLY = "is free software you can redistribute it and or modify it under the terms of the gnu {} public license version {} as published by the free software foundation"
_LATER = "either version {} of the license or at your option any later version"

# Whole sentences of the notices, beside the short forms above. A star is one to eight words.
NOTICES = {
    "MitGrant": ["permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"],
    "MitNotice": ["the above copyright notice and this permission notice including the next paragraph shall be included in all copies or substantial portions of the software"],
    "AsIs": ["the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"],
    "MitLiable": ["in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"],
    "ApacheBrief": ["the asf licenses this file to you under the apache license version 2.0 the license"],
    "ApacheCopy": [f"you may obtain a copy of the license at {http} www.apache.org licenses license 2.0" for http in ("http", "https")],
    "ApacheUnless": ["unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"],
    "GplFree": [f"* {_GNU.format('general')}"],
    "Lgpl2Free": [f"* {_GNU.format(kind)}" for kind in ("lesser general", "library general")],
    "AgplFree": [f"* {_GNU.format('affero general')}"],
    "Gpl3OrLater": [f"* {_GNU.format('general')} {_LATER.format(3)}"],
    "Gpl2OrLater": [f"* {_GNU.format('general')} {_LATER.format(2)}"],
    "Lgpl3OrLater": [f"* {_GNU.format('lesser general')} {_LATER.format(3)}"],
    "Lgpl21OrLater": [f"* {_GNU.format('lesser general')} {_LATER.format('2.1')}"],
    "Agpl3OrLater": [f"* {_GNU.format('affero general')} {_LATER.format(3)}"],
    "Lgpl21Later": [_LATER.format("2.1")],
    "Gpl2Only": [f"* {_GNU_ONLY.format('general', 2)}"],
    "Gpl3Only": [f"* {_GNU_ONLY.format('general', 3)}"],
    "Gpl3BriefLater": [f"{start} under the gnu general public license version 3 or later" for start in ("this work is licensed", "licensed")],
    "Gpl2BriefLater": [f"{start} under the gnu general public license version 2 or later" for start in ("this work is licensed", "licensed")],
    "Lgpl3BriefLater": ["licensed under the gnu lesser general public license version 3 or later"],
    "Agpl3BriefLater": ["licensed under the gnu affero general public license version 3 or later"],
    "BsdNames": [f"neither the name of * {nor} may be used to endorse or promote products derived from this software without specific prior written permission"
                 for nor in ("nor the names of its contributors", "nor the names of contributors")],
    "BsdAsIs": [f"this software is provided by {by} as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed"
                for by in ("the copyright holders and contributors", "the copyright holder and contributors", "*")],
    "Mpl2Brief": ["this source code form is subject to the terms of the mozilla public license version 2.0"],
}

# Identifiers of SPDX lines as normalised, by licence. "+" reads as "or later".
SPDX = {
    "MIT": ["mit"], "Apache-2.0": ["apache 2.0"], "MIT OR Apache-2.0": ["mit or apache 2.0", "apache 2.0 or mit"],
    "GPL-3.0": ["gpl 3.0 only", "gpl 3.0"], "GPL-3.0-or-later": ["gpl 3.0 or later"],
    "GPL-2.0": ["gpl 2.0 only", "gpl 2.0"], "GPL-2.0-or-later": ["gpl 2.0 or later"],
    "LGPL-3.0": ["lgpl 3.0 only", "lgpl 3.0"], "LGPL-3.0-or-later": ["lgpl 3.0 or later"],
    "LGPL-2.1": ["lgpl 2.1 only", "lgpl 2.1"], "LGPL-2.1-or-later": ["lgpl 2.1 or later"],
    "AGPL-3.0": ["agpl 3.0 only", "agpl 3.0"], "AGPL-3.0-or-later": ["agpl 3.0 or later"],
    "BSD-2-Clause": ["bsd 2 clause"], "BSD-3-Clause": ["bsd 3 clause"], "MPL-2.0": ["mpl 2.0"],
    "CC-BY-4.0": ["cc by 4.0"], "CC-BY-SA-4.0": ["cc by sa 4.0"], "CC-BY-NC-4.0": ["cc by nc 4.0"],
    "CC0-1.0": ["cc0 1.0"], "Public-domain": ["unlicense"],
}
_OLD_SPDX = {t for name, texts in SENTENCES.items() if name.startswith("Spdx") for t in texts}
for _licence, _texts in SPDX.items():
    _new = [f"spdx license identifier {t}" for t in _texts if f"spdx license identifier {t}" not in _OLD_SPDX]
    if _new:
        NOTICES[f"Spdx:{_licence}"] = _new

_BSD2 = ["BsdRedistribute", "BsdSource", "BsdBinary"]
_BSD3 = [*_BSD2, "BsdNames"]

# Rules over whole notices, tried before the others.
NOTICE_RULES = [
    ("MIT", ["MitGrant", "MitNotice", "AsIs", "MitLiable"]),
    *[(licence, [*before, *run, *after])
      for licence, run in (("BSD-3-Clause", _BSD3), ("BSD-2-Clause", _BSD2))
      for before in (["AllRights"], []) for after in (["BsdAsIs"], [])],
    ("GPL-3.0-or-later", ["Gpl3OrLater"]),
    ("GPL-2.0-or-later", ["Gpl2OrLater"]),
    ("LGPL-3.0-or-later", ["Lgpl3OrLater"]),
    ("LGPL-2.1-or-later", ["Lgpl21OrLater"]),
    ("AGPL-3.0-or-later", ["Agpl3OrLater"]),
    ("LGPL-3.0-or-later", ["Lgpl2Free", "Gpl3Later"]),
    ("LGPL-2.1-or-later", ["Lgpl2Free", "Lgpl21Later"]),
    ("LGPL-2.0-or-later", ["Lgpl2Free", "Gpl2Later"]),
    ("AGPL-3.0-or-later", ["AgplFree", "Gpl3Later"]),
    ("LGPL", ["Lgpl2Free"]),
    ("AGPL", ["AgplFree"]),
    ("GPL-2.0", ["Gpl2Only"]),
    ("GPL-3.0", ["Gpl3Only"]),
    ("GPL-3.0-or-later", ["Gpl3BriefLater"]),
    ("GPL-2.0-or-later", ["Gpl2BriefLater"]),
    ("LGPL-3.0-or-later", ["Lgpl3BriefLater"]),
    ("AGPL-3.0-or-later", ["Agpl3BriefLater"]),
    *[(licence, [f"Spdx:{licence}"]) for licence in SPDX if f"Spdx:{licence}" in NOTICES],
]

# Every known sentence holds one of these, so a text without any is passed over. Single words, as lines may be wrapped.
CLUES = ["licen", "warrant", "software", "reserved", "redistribut", "domain", "copyright", "version"]

# Marks of a normalised text: no sentence goes over the first; one may go over the second.
HARD, SOFT = "\x01", "\x02"
_SPACES = r"[\x20\x09-\x0D]++"

# Replacements that leave lower-case words, blanks and marks. No pattern reads a long run more than once.
STEPS = [
    (r"[\x01\x02]", " "),
    (r"(?<=[0-9])\+", " or later"),
    (r"(?<![a-z0-9])v\.[\x20\x09-\x0D]++(?=[0-9])", "v."),
    (r"(?<![^\n])[\x20\x09]*+(?:rem|dnl)(?![^\x20\x09\n])", ""),  # comment marks that are words
    (r"\n(?=[^a-z0-9\n]*+\n)", HARD),
    (r"(?<=[\n\x01])[^a-z0-9\n\x01]++", ""),  # other comment marks
    (rf"(?<![.!?:;])[:;]++{_SPACES}|\n", SOFT),
    (rf"(?<![.!?:;])[.!?:;]++{_SPACES}", HARD),
    (r"[^a-z0-9.\x01\x02]+", " "),
    (r"(?<![ .])[ .]++(?=[\x01\x02])|(?<=[\x01\x02])[ .]++", ""),
    (r"(?<![\x01\x02])[\x01\x02]{2,}+", HARD),
]


def normalised(text: Column) -> Column:
    """Lower case, everything but letters, digits and points inside a word as one blank, ends of sentences as marks."""
    plain = F.concat(F.lit(". "), F.lower(text), F.lit("\n"))
    for pattern, by in STEPS:
        plain = F.regexp_replace(plain, F.lit(pattern), F.lit(by))
    return plain


def known_by_name() -> dict[str, list[str]]:
    """All known sentences by identifier, in the normal form."""
    both = {name: [*SENTENCES.get(name, []), *NOTICES.get(name, [])] for name in {**SENTENCES, **NOTICES}}
    return {name: list(dict.fromkeys(t.replace(" v. ", " v.") for t in texts)) for name, texts in both.items()}


def _pattern(sentence: str) -> str:
    """A sentence as words between blanks or soft marks. A star at its start takes words of one line only."""
    gap = r"[ \x02]"
    words = [rf"[a-z0-9.]++(?:{gap if i else ' '}[a-z0-9.]++){{0,7}}?" if w == "*" else w.replace(".", r"\.") for i, w in enumerate(sentence.split())]
    return gap.join(words)


def any_known() -> str:
    """Pattern of a known sentence between two marks, the longest first."""
    texts = {t for found in known_by_name().values() for t in found}
    ordered = sorted(texts, key=lambda t: (-len(t), t))
    return rf"(?<=[\x01\x02])(?:{'|'.join(map(_pattern, ordered))})(?=[\x01\x02])"


def identifier(sentence: Column) -> Column:
    """The identifier of a sentence that ``any_known`` has found."""
    plain = F.replace(sentence, F.lit(SOFT), F.lit(" "))
    found = F.element_at(F.col("__known"), plain)
    for name, texts in known_by_name().items():
        for t in texts:
            if "*" in t.split():
                found = F.coalesce(found, F.when(F.rlike(plain, F.lit(f"^{_pattern(t)}$")), F.lit(name)))
    return found


def with_clue(text: Column) -> Column:
    low = F.lower(text)
    hit = F.lit(False)
    for clue in CLUES:
        hit = hit | F.contains(low, F.lit(clue))
    return hit


def known_sentences() -> Column:
    return F.create_map(*[F.lit(x) for name, texts in known_by_name().items() for t in texts if "*" not in t for x in (t, name)])


def scan(docs: DataFrame) -> DataFrame:
    """Licences of every row, from its whole text.

    Reads ``doc_id`` and ``text``; returns doc_id, n_found (known sentences), sentences (their identifiers in
    order, joined by ","), licenses (recognised licences in order, joined by ",", repeats kept) and unmatched
    (identifiers that no rule used). Null and empty texts give 0 and empty strings; nothing is capped.
    """
    text = text_or_empty()
    named = F.transform(F.regexp_extract_all(normalised(text), F.lit(any_known()), F.lit(0)), identifier)
    empty = F.array().cast("array<string>")
    found = F.when(with_clue(text), F.array_compact(named)).otherwise(empty)
    rows = docs.select("doc_id", "text").withColumn("__known", known_sentences())
    rows = rows.select("doc_id", found.alias("ids"))
    # each identifier between two bars of its own, so that neighbours do not share one
    sequence = F.array_join(F.transform("ids", lambda i: F.concat(F.lit("|"), i, F.lit("|"))), "")
    matched = sequence
    for licence, run in [*NOTICE_RULES, *RULES]:
        matched = F.replace(matched, F.lit("".join(f"|{i}|" for i in run)), F.lit(f"<{licence}>"))
    rows = rows.select("doc_id", "ids", F.when(F.size("ids") > 0, matched).otherwise("").alias("matched"))
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_found"),
        F.array_join("ids", ",").alias("sentences"),
        F.array_join(F.regexp_extract_all("matched", F.lit("<([^>]*)>"), F.lit(1)), ",").alias("licenses"),
        F.array_join(F.regexp_extract_all("matched", F.lit(r"\|([^|]*)\|"), F.lit(1)), ",").alias("unmatched"),
    )


def scan_sql() -> str:
    """The short forms in DuckDB's SQL, built from SENTENCES and RULES: sentences of one line, cut at every mark.

    It says the same wherever a table holds no notice beyond these, as the given ones.
    """
    known = ", ".join(f"('{t}', '{name}')" for name, texts in SENTENCES.items() for t in texts)
    matched = "ids_text"
    for licence, run in RULES:
        matched = f"replace({matched}, '{''.join(f'|{i}|' for i in run)}', '<{licence}>')"
    return rf"""
    WITH known(sentence, name) AS (VALUES {known}),
    cut AS (
        SELECT row_number() OVER () AS row, doc_id,
               unnest(regexp_split_to_array(coalesce(text, ''), '[.!?:;]+[\x20\x09-\x0D]+|\n')) AS part,
               generate_subscripts(regexp_split_to_array(coalesce(text, ''), '[.!?:;]+[\x20\x09-\x0D]+|\n'), 1) AS pos
        FROM documents),
    numbered AS (SELECT row_number() OVER () AS row, doc_id FROM documents),
    named AS (
        SELECT doc_id, pos, name
        FROM (SELECT doc_id, pos, regexp_replace(regexp_replace(lower(part), '[^a-z0-9.]+', ' ', 'g'), '^[ .]+|[ .]+$', '', 'g') AS sentence FROM cut)
        JOIN known USING (sentence)),
    lists AS (
        SELECT d.doc_id, count(name) AS n_found, coalesce(string_agg(name, ',' ORDER BY pos), '') AS sentences,
               coalesce(string_agg('|' || name || '|', '' ORDER BY pos), '') AS ids_text
        FROM documents d LEFT JOIN named n ON n.doc_id = d.doc_id GROUP BY d.doc_id),
    matched AS (SELECT doc_id, n_found, sentences, {matched} AS m FROM lists)
    SELECT doc_id, n_found, sentences,
           array_to_string(regexp_extract_all(m, '<([^>]*)>', 1), ',') AS licenses,
           array_to_string(regexp_extract_all(m, '\|([^|]*)\|', 1), ',') AS unmatched
    FROM matched"""
