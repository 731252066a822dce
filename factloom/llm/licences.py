"""Licence scan by sentence rules, in DataFrame functions alone.

A text is cut into sentences twice: once with single line breaks as spaces (wrapped licence texts), once with every line
break as an end (a licence line after text without a full stop). Sentences end at full stops, semicolons, colons and
blank lines; they are normalised to lower-case letters and digits without list marks, and mapped to ids: a known sentence
has its own, and one that names a licence after words of grant ("released under the ...") or as an SPDX identifier has
that licence's. A rule is an ordered list of ids that must appear in this order in one of the two sequences, with other
sentences allowed between them. A rule that is part of a longer one that holds is not reported.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

_GPL = "you can redistribute it and or modify it under the terms of the gnu {} public license as published by the free software foundation"
_LATER = "either version {} of the license or at your option any later version"
# Known licence sentences (normalised), by id; * stands for any words.
SENTENCES = {
    1: "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    2: "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    3: "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    4: "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    5: "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    6: "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    7: "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    8: "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    9: "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    10: "neither the name of * nor the names of * contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    11: "all advertising materials mentioning features or use of this software must display the following acknowledgement",
    12: "licensed under the apache license version 2 0 the license",
    13: "you may not use this file except in compliance with the license",
    14: "you may obtain a copy of the license at",
    15: "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    16: "see the license for the specific language governing permissions and limitations under the license",
    17: f"{_GPL.format('general')} {_LATER.format('2')}",
    18: f"{_GPL.format('general')} {_LATER.format('3')}",
    19: f"{_GPL.format('lesser general')} {_LATER.format('2 1')}",
    20: f"{_GPL.format('lesser general')} {_LATER.format('3')}",
    21: f"{_GPL.format('library general')} {_LATER.format('2')}",
    22: f"{_GPL.format('affero general')} {_LATER.format('3')}",
    23: "this source code form is subject to the terms of the mozilla public license v",
    24: "if a copy of the mpl was not distributed with this file you can obtain one at *",
    25: "this is free and unencumbered software released into the public domain",
    26: "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions",
    27: "the origin of this software must not be misrepresented",
    28: "altered source versions must be plainly marked as such and must not be misrepresented as being the original software",
    29: "this notice may not be removed or altered from any source distribution",
    30: "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the following",
    31: "the person who associated a work with this deed has dedicated the work to the public domain by waiving all of his or her rights to the work worldwide under copyright law including all related and neighboring rights to the extent allowed by law",
    32: "all rights reserved",
    33: "* all rights reserved",
    34: "you must give appropriate credit provide a link to the license and indicate if changes were made",
    35: "you may not use the material for commercial purposes",
    36: "nor the names of * contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    37: _GPL.format("general"),
    38: _GPL.format("lesser general"),
    39: _GPL.format("library general"),
    40: _GPL.format("affero general"),
    41: _LATER.format("2"),
    42: _LATER.format("2 1"),
    43: _LATER.format("3"),
}
# Licences with the names that follow words of grant; the normalised identifier is a name too.
NAMES = {
    "MIT": ["mit license", "mit licence", "mit"],
    "ISC": ["isc license", "isc licence"],
    "0BSD": ["zero clause bsd license", "bsd zero clause license"],
    "BSD-2-Clause": ["bsd 2 clause license", "2 clause bsd license", "simplified bsd license", "freebsd license"],
    "BSD-3-Clause": ["bsd 3 clause license", "3 clause bsd license", "new bsd license", "modified bsd license", "revised bsd license"],
    "BSD-4-Clause": ["bsd 4 clause license", "original bsd license"],
    "Apache-2.0": ["apache license version 2 0", "apache license 2 0", "apache license v2 0", "apache 2 0 license", "apache software license 2 0", "asl 2 0"],
    "GPL-2.0": ["gnu general public license version 2", "gnu general public license v2", "gnu gpl v2", "gnu gpl version 2", "gpl v2", "gplv2", "gpl version 2", "gpl 2 0 only", "gpl 2 0 or later"],
    "GPL-3.0": ["gnu general public license version 3", "gnu general public license v3", "gnu gpl v3", "gnu gpl version 3", "gpl v3", "gplv3", "gpl version 3", "gpl 3 0 only", "gpl 3 0 or later"],
    "LGPL-2.1": ["gnu lesser general public license version 2 1", "gnu lesser general public license v2 1", "gnu lgpl v2 1", "lgpl v2 1", "lgplv2 1", "lgpl version 2 1", "lgpl 2 1 only", "lgpl 2 1 or later"],
    "LGPL-3.0": ["gnu lesser general public license version 3", "gnu lesser general public license v3", "gnu lgpl v3", "lgpl v3", "lgplv3", "lgpl version 3", "lgpl 3 0 only", "lgpl 3 0 or later"],
    "AGPL-3.0": ["gnu affero general public license version 3", "gnu affero general public license v3", "gnu agpl v3", "agpl v3", "agplv3", "agpl 3 0 only", "agpl 3 0 or later"],
    "MPL-1.1": ["mozilla public license version 1 1", "mozilla public license 1 1"],
    "MPL-2.0": ["mozilla public license version 2 0", "mozilla public license 2 0", "mozilla public license v2 0"],
    "EPL-1.0": ["eclipse public license version 1 0", "eclipse public license v1 0", "eclipse public license 1 0"],
    "EPL-2.0": ["eclipse public license version 2 0", "eclipse public license v 2 0", "eclipse public license 2 0"],
    "EUPL-1.2": ["european union public licence version 1 2", "european union public license version 1 2", "eupl version 1 2"],
    "Zlib": ["zlib license", "zlib libpng license"],
    "BSL-1.0": ["boost software license version 1 0", "boost software license 1 0"],
    "Artistic-2.0": ["artistic license 2 0", "artistic license version 2 0"],
    "PostgreSQL": ["postgresql license", "postgresql licence"],
    "Python-2.0": ["python software foundation license version 2", "psf license"],
    "OFL-1.1": ["sil open font license version 1 1", "sil open font license 1 1"],
    "Unlicense": ["the unlicense", "unlicense license"],
    "WTFPL": ["do what the fuck you want to public license"],
    "CC0-1.0": ["cc0 1 0 universal", "cc0 license", "cc0"],
    "CC-BY-3.0": ["creative commons attribution 3 0"],
    "CC-BY-4.0": ["creative commons attribution 4 0"],
    "CC-BY-SA-3.0": ["creative commons attribution sharealike 3 0", "creative commons attribution share alike 3 0"],
    "CC-BY-SA-4.0": ["creative commons attribution sharealike 4 0", "creative commons attribution share alike 4 0"],
    "CC-BY-NC-4.0": ["creative commons attribution noncommercial 4 0", "creative commons attribution non commercial 4 0"],
    "CC-BY-ND-4.0": ["creative commons attribution noderivatives 4 0", "creative commons attribution no derivatives 4 0"],
    "CC-BY-NC-SA-4.0": ["creative commons attribution noncommercial sharealike 4 0", "creative commons attribution non commercial share alike 4 0"],
    "CC-BY-NC-ND-4.0": ["creative commons attribution noncommercial noderivatives 4 0", "creative commons attribution non commercial no derivatives 4 0"],
}
# Rules over sentences, (licence, ordered sentence ids); each licence of NAMES has one over its own id too.
RULES = [
    ("MIT", (1, 2)),
    ("ISC", (4,)),
    ("ISC", (5,)),
    ("0BSD", (6,)),
    ("BSD-2-Clause", (7, 8, 9)),
    ("BSD-3-Clause", (7, 8, 9, 10)),
    ("BSD-3-Clause", (7, 8, 9, 36)),
    ("BSD-4-Clause", (7, 8, 9, 11)),
    ("BSD-4-Clause", (7, 8, 9, 11, 10)),
    ("Apache-2.0", (12, 13)),
    ("GPL-2.0", (17,)),
    ("GPL-2.0", (37, 41)),
    ("GPL-3.0", (18,)),
    ("GPL-3.0", (37, 43)),
    ("LGPL-2.1", (19,)),
    ("LGPL-2.1", (38, 42)),
    ("LGPL-3.0", (20,)),
    ("LGPL-3.0", (38, 43)),
    ("LGPL-2.0", (21,)),
    ("LGPL-2.0", (39, 41)),
    ("AGPL-3.0", (22,)),
    ("AGPL-3.0", (40, 43)),
    ("MPL-2.0", (23,)),
    ("Unlicense", (25,)),
    ("Zlib", (26, 27, 28, 29)),
    ("BSL-1.0", (30,)),
    ("CC0-1.0", (31,)),
    ("all-rights-reserved", (32,)),
    ("all-rights-reserved", (33,)),
]
#: Every known sentence, grant and identifier holds one of these; other sentences are skipped before they are normalised.
CUES = ("licens", "licenc", "rights", "permission", "permitted", "redistribut", "copyright", "software", "under the", "under cc", "obtain one", "spdx", "altered", "redistribution", "advertising", "this notice", "purposes")
#: Ids of licences that are named after words of grant or as an identifier start here, in order of NAMES.
NAMED = 1000
_END = r"([.;:])[ \t]+"
_SPDX = r"(SPDX-License-Identifier):[ \t]*"
_BLANK = r"\r?\n[ \t]*\r?\n"
_MARK = r"^([0-9]{1,2}|[a-z]|i{1,3}|iv) +"


def _identifier(name: str) -> str:
    return re.sub("[^a-z0-9]+", " ", name.lower())


def grants(names: dict[str, list[str]] = NAMES) -> dict[int, str]:
    """A regular expression for normalised sentences that grant each licence, by its id."""
    out = {}
    for k, (name, known) in enumerate(names.items()):
        alias = "|".join(sorted({*known, _identifier(name)}, key=lambda a: (-len(a), a)))
        out[NAMED + k] = f"(^| )(spdx license identifier|(under|of|by|the license is|license) ((the )?(terms|conditions|terms and conditions) (of|and conditions of) )?(either )?(the |a )?)(( the)? ?)({alias})( |$)"
    return out


def rules(names: dict[str, list[str]] = NAMES) -> list[tuple[str, tuple[int, ...]]]:
    return RULES + [(name, (NAMED + k,)) for k, name in enumerate(names)]


def _gap(sentence: str) -> str:
    return "^" + sentence.replace("* ", "(.+ )?").replace(" *", "( .+)?") + "$"


def _longer(all_rules: list) -> list[list[int]]:
    """For each rule the longer ones that hold its ids in order."""

    def part(a, b):
        rest = iter(b)
        return all(x in rest for x in a)

    return [[j for j, (_, b) in enumerate(all_rules) if len(b) > len(a) and part(a, b)] for _, a in all_rules]


def _ids(parts: Column) -> Column:
    cue = "|".join(CUES)
    likely = F.filter(parts, lambda s: F.lower(s).rlike(cue))
    plain = F.transform(likely, lambda s: F.regexp_replace(F.trim(F.regexp_replace(F.lower(s), "[^a-z0-9]+", " ")), _MARK, ""))
    known = F.create_map(*[F.lit(x) for i, s in SENTENCES.items() if "*" not in s for x in (s, i)])

    def number(s: Column) -> Column:
        tests = [(_gap(x), i) for i, x in SENTENCES.items() if "*" in x] + [(x, i) for i, x in grants().items()]
        case = F.when(s.rlike(tests[0][0]), tests[0][1])
        for pattern, i in tests[1:]:
            case = case.when(s.rlike(pattern), i)
        return F.coalesce(F.element_at(known, s), case)

    return F.filter(F.transform(plain, number), lambda i: i.isNotNull())


def _matches(ids: Column) -> list[Column]:
    text = F.concat(F.lit(","), F.array_join(ids, ","), F.lit(","))
    return [text.rlike("," + ",(.*,)?".join(map(str, rule)) + ",") for _, rule in rules()]


def scan_licences(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text, ...) -> (doc_id, sentence_ids, licences, n_licences), a row for each row of docs.

    sentence_ids: known sentences in order, from the sequence with line breaks as ends, else from the other where that
    one finds more. licences: distinct names, in order of the rules. Null and empty texts have none; an empty table gives
    an empty one; repeated rows repeat; rows without doc_id are scanned alike; whole texts are read, however long. Only
    doc_id and text are read, so other columns cannot clash.
    """
    text = F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), _SPDX, "$1 ")
    has = F.lower(text).rlike("|".join(CUES))
    lines = F.split(F.regexp_replace(text, _END, "$1\n"), "\n")
    flat = F.split(F.regexp_replace(F.regexp_replace(F.regexp_replace(text, _BLANK, ". "), r"[ \t\r\n]+", " "), _END, "$1\n"), "\n")
    none = F.array().cast("array<int>")
    out = docs.select("doc_id", F.when(has, _ids(lines)).otherwise(none).alias("a"), F.when(has, _ids(flat)).otherwise(none).alias("b"))
    holds = [x | y for x, y in zip(_matches(F.col("a")), _matches(F.col("b")))]
    out = out.select("doc_id", "a", "b", F.when((F.size("a") > 0) | (F.size("b") > 0), F.array(*holds)).alias("holds"))
    found = []
    for k, ((name, _), longer) in enumerate(zip(rules(), _longer(rules()))):
        own = F.get("holds", F.lit(k))
        for j in longer:
            own = own & ~F.get("holds", F.lit(j))
        found.append(F.when(own, F.lit(name)))
    empty = F.array().cast("array<string>")
    out = out.withColumn("licences", F.when(F.col("holds").isNotNull(), F.array_distinct(F.array_compact(F.array(*found)))).otherwise(empty))
    return out.select("doc_id", F.when(F.size("b") > F.size("a"), F.col("b")).otherwise(F.col("a")).alias("sentence_ids"), "licences", F.size("licences").alias("n_licences"))


def _sql_ids(parts: str) -> str:
    known = ", ".join(f"'{s}': {i}" for i, s in SENTENCES.items() if "*" not in s)
    cue = "|".join(CUES)
    case = " ".join([f"WHEN regexp_matches(s, '{_gap(x)}') THEN {i}" for i, x in SENTENCES.items() if "*" in x] + [f"WHEN regexp_matches(s, '{x}') THEN {i}" for i, x in grants().items()])
    plain = f"list_transform(list_filter({parts}, lambda s: regexp_matches(lower(s), '{cue}')), lambda s: regexp_replace(trim(regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g')), '{_MARK}', ''))"
    return f"list_filter(list_transform({plain}, lambda s: coalesce(MAP {{{known}}}[s], CASE {case} END)), lambda i: i IS NOT NULL)"


def licences_sql() -> str:
    """The same scan in DuckDB SQL; lists are joined with commas."""
    end = r"'([.;:])[ \t]+', '\1' || chr(10), 'g'"
    text = rf"regexp_replace(coalesce(text, ''), '{_SPDX}', '\1 ', 'g')"
    lines = f"string_split(regexp_replace({text}, {end}), chr(10))"
    flat = rf"string_split(regexp_replace(regexp_replace(regexp_replace({text}, '{_BLANK}', '. ', 'g'), '[ \t\r\n]+', ' ', 'g'), {end}), chr(10))"
    every = rules()
    tests = [f"(regexp_matches(sa, ',{',(.*,)?'.join(map(str, r))},') OR regexp_matches(sb, ',{',(.*,)?'.join(map(str, r))},'))" for _, r in every]
    own = [" AND ".join([tests[k], *[f"NOT {tests[j]}" for j in longer]]) for k, longer in enumerate(_longer(every))]
    names = list(dict.fromkeys(name for name, _ in every))
    each = [f"CASE WHEN {' OR '.join(f'({t})' for t, (n, _) in zip(own, every) if n == name)} THEN '{name}' END" for name in names]
    return f"""
    WITH ids AS (SELECT doc_id, {_sql_ids(lines)} AS a, {_sql_ids(flat)} AS b FROM documents),
    joined AS (SELECT doc_id, a, b, ',' || array_to_string(a, ',') || ',' AS sa, ',' || array_to_string(b, ',') || ',' AS sb FROM ids),
    named AS (SELECT *, list_filter([{', '.join(each)}], lambda x: x IS NOT NULL) AS l FROM joined)
    SELECT doc_id, array_to_string(CASE WHEN len(b) > len(a) THEN b ELSE a END, ',') AS sentence_ids, array_to_string(l, ',') AS licences, len(l) AS n_licences FROM named"""
