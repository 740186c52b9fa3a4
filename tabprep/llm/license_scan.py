"""License scans by sentence rules, in DataFrame functions only.

A text is cut into sentences, each normalised (lower case, runs of anything but a-z and 0-9 as one
blank) and looked up among known licence sentences. The identifiers found, in order, are matched
against ordered rules; a rule takes the identifiers that it matches, so that the sentences of a long
licence are not read again by the rule of a shorter one. Texts are read twice: with line breaks as
sentence ends, for notices on lines of their own, and without, for wrapped licence texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Normalised sentences of public licences and notices, as they are cut, by identifier.
SENTENCES = {
    "MITGRANT": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "MITNOTICE": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "MITASIS": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "MITLIABLE": "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    "ISCGRANT": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "APACHEUNDER": "licensed under the apache license version 2 0 the license",
    "APACHECOMPLY": "you may not use this file except in compliance with the license",
    "APACHEASIS": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "APACHESEE": "see the license for the specific language governing permissions and limitations under the license",
    "GPLTHREE": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "GPLTWO": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "GPLFREE": "this program is free software",
    "GPLTERMS": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
    "GPLTWOLATER": "either version 2 of the license or at your option any later version",
    "GPLHOPE": "this program is distributed in the hope that it will be useful but without any warranty",
    "GPLIMPLIED": "without even the implied warranty of merchantability or fitness for a particular purpose",
    "GPLSEE": "see the gnu general public license for more details",
    "BSDFORMS": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "BSDSOURCE": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "BSDBINARY": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "BSDNAMES": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "MPLSUBJECT": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "MPLTERMS": "this source code form is subject to the terms of the mozilla public license v",
    "MPLVERSION": "2 0",
    "NOTEGPL": "this work is licensed under the gnu general public license version 3",
    "NOTEMIT": "released under the mit license",
    "NOTEMITTOO": "licensed under the mit license",
    "NOTEAPACHE": "licensed under the apache license version 2 0",
    "NOTEBYNC": "licensed under cc by nc 4 0",
    "NOTEBY": "licensed under cc by 4 0",
    "NOTECCBY": "this work is licensed under a creative commons attribution 4 0 international license",
    "NOTERESERVED": "all rights reserved",
    "SPDXMIT": "spdx license identifier mit",
    "SPDXAPACHE": "spdx license identifier apache 2 0",
    "SPDXGPL": "spdx license identifier gpl 3 0 or later",
}

#: Ordered rules: licence and the identifiers that must follow one another; those in brackets may be missing.
RULES = (
    ("Apache-2.0", "APACHEUNDER (APACHECOMPLY) (APACHEASIS) (APACHESEE)"),
    ("GPL-3.0-or-later", "GPLTHREE (GPLHOPE) (GPLIMPLIED) (GPLSEE)"),
    ("GPL-2.0-or-later", "GPLTWO (GPLHOPE) (GPLIMPLIED) (GPLSEE)"),
    ("GPL-2.0-or-later", "GPLFREE GPLTERMS GPLTWOLATER (GPLHOPE) (GPLIMPLIED) (GPLSEE)"),
    ("MIT", "MITGRANT MITNOTICE (MITASIS) (MITLIABLE)"),
    ("ISC", "ISCGRANT"),
    ("BSD-3-Clause", "BSDFORMS BSDSOURCE BSDBINARY BSDNAMES"),
    ("BSD-2-Clause", "BSDFORMS BSDSOURCE BSDBINARY"),
    ("MPL-2.0", "MPLSUBJECT"),
    ("MPL-2.0", "MPLTERMS MPLVERSION"),
    ("GPL-3.0-only", "NOTEGPL"),
    ("MIT", "NOTEMIT"),
    ("MIT", "NOTEMITTOO"),
    ("Apache-2.0", "NOTEAPACHE"),
    ("CC-BY-NC-4.0", "NOTEBYNC"),
    ("CC-BY-4.0", "NOTEBY"),
    ("CC-BY-4.0", "NOTECCBY"),
    ("MIT", "SPDXMIT"),
    ("Apache-2.0", "SPDXAPACHE"),
    ("GPL-3.0-or-later", "SPDXGPL"),
    ("all-rights-reserved", "NOTERESERVED"),
)

#: Every known sentence has one of these, however its words are parted; other texts are settled by one match.
TRIGGER = r"(?i)licen[cs]e|copyright|permission|warrant|free[^a-z0-9]+software|redistribut|rights[^a-z0-9]+reserved|(?<![a-z0-9])2[^a-z0-9]+0(?![a-z0-9])"
SPACE = r"[\x20\x09-\x0D]+"
BLANK_LINE = r"\x0A[\x20\x09\x0D]*\x0A"


def pattern_of(rule: str) -> str:
    """A rule as a regular expression over identifiers that each end in a comma."""
    return "".join(f"({x[1:-1]},)?" if x[0] == "(" else f"{x}," for x in rule.split())


def sentences(text: Column, wrapped: bool) -> Column:
    """Normalised sentences; line breaks end one unless the text is ``wrapped``, where blank lines do."""
    text = F.regexp_replace(text, r"(?i)SPDX-License-Identifier:[ \t]*", "SPDX-License-Identifier ")
    if wrapped:
        text = F.regexp_replace(text, BLANK_LINE, ".\n")
        text = F.regexp_replace(text, SPACE, " ")
    text = F.regexp_replace(text, rf"([.!?;]){SPACE}", "$1\n")
    text = F.regexp_replace(text, rf":{SPACE}([A-Z0-9])", ":\n$1")
    plain = lambda s: F.trim(F.regexp_replace(F.lower(s), "[^a-z0-9]+", " "))
    return F.transform(F.split(text, "\n"), plain)


def identifiers(text: Column, wrapped: bool) -> Column:
    """Identifiers of the known sentences of ``text``, in order."""
    known = F.create_map(*(F.lit(x) for name, s in SENTENCES.items() for x in (s, name)))
    found = F.transform(sentences(text, wrapped), lambda s: F.element_at(known, s))
    return F.filter(found, lambda x: x.isNotNull())


def licenses(ids: Column) -> Column:
    """Licences that the ordered rules recognise in identifiers; each takes those it matches."""
    rules = F.array(*(F.struct(F.lit(name).alias("name"), F.lit(pattern_of(r)).alias("pattern")) for name, r in RULES))
    line = F.concat(F.array_join(ids, ","), F.when(F.size(ids) > 0, F.lit(",")).otherwise(F.lit("")))
    start = F.struct(line.alias("rest"), F.array().cast("array<string>").alias("names"))

    def step(state: Column, rule: Column) -> Column:
        met = F.regexp(state["rest"], rule["pattern"])
        names = F.when(met, F.array_append(state["names"], rule["name"])).otherwise(state["names"])
        return F.struct(F.regexp_replace(state["rest"], rule["pattern"], "+").alias("rest"), names.alias("names"))

    return F.aggregate(rules, start, step, lambda state: state["names"])


def scanned(docs: DataFrame) -> DataFrame:
    """``docs`` with ``license_sentences`` (identifiers in order) and ``licenses`` (sorted, distinct), both arrays.

    The reading, by lines or wrapped, that knows more sentences gives the identifiers (by lines if
    alike); licences of both count. Columns of these names are replaced. A null or empty text has
    none; repeated rows are read alike; an empty table stays empty. Texts are read whole.
    """
    rows = docs.select(*(c for c in docs.columns if c not in ("license_sentences", "licenses", "_lines", "_wrapped")))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    none = F.array().cast("array<string>")
    known = lambda wrapped: F.when(text.rlike(TRIGGER), identifiers(text, wrapped)).otherwise(none)
    rows = rows.withColumns({"_lines": known(False), "_wrapped": known(True)})
    names = F.when(F.size("_lines") + F.size("_wrapped") == 0, none)
    names = names.otherwise(F.array_sort(F.array_union(licenses(F.col("_lines")), licenses(F.col("_wrapped")))))
    longer = F.when(F.size("_wrapped") > F.size("_lines"), F.col("_wrapped")).otherwise(F.col("_lines"))
    return rows.withColumns({"license_sentences": longer, "licenses": names}).drop("_lines", "_wrapped")
