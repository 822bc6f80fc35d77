"""Operator 6: licence recognition by sentence rules.

A text is cut into sentences, each sentence is normalised (A-Z lower-cased,
everything but letters and digits one blank), and known licence sentences are
replaced by their identifiers. The sequence of identifiers, unknown sentences
left out, is matched against ordered licence rules: a rule fits where its
identifiers follow each other. Several rules of one licence report it once. An
SPDX expression counts as one tag per licence it names; vague findings ("all rights
reserved", an unnumbered BSD text) give way to precise ones.

Texts are read in two ways, line by line (headers, tags) and with wrapped lines
joined (running text), and a licence found in either counts. Everything is a
projection over built-in functions: no shuffle, no Python, one row in and one
row out whatever the text's length.

Edge cases: null, empty and wordless texts have no sentences and no licences;
repeated rows are judged alike; the result is one struct column under a free
name, so other columns may have any names; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientlens.llm import common
from clientlens.llm.decontam import LOWER, UPPER

# Sentences of published licence texts and notices, normalised.
SENTENCES = {
    "apache-2-licensed-under": "licensed under the apache license version 2 0",
    "apache-2-licensed-the-license": "licensed under the apache license version 2 0 the license",
    "apache-2-compliance": "you may not use this file except in compliance with the license",
    "apache-2-notice": "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license",
    "apache-2-obtain": "you may obtain a copy of the license at",
    "apache-2-as-is": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "apache-2-specific": "see the license for the specific language governing permissions and limitations under the license",
    "apache-2-spdx": "spdx license identifier apache 2 0",
    "mit-released": "released under the mit license",
    "mit-licensed": "licensed under the mit license",
    "mit-title": "the mit license mit",
    "mit-title-short": "mit license",
    "mit-spdx": "spdx license identifier mit",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit-as-is": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "mit-liability": "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    "gpl-3-licensed": "this work is licensed under the gnu general public license version 3",
    "gpl-3-spdx-only": "spdx license identifier gpl 3 0 only",
    "gpl-3-spdx-later": "spdx license identifier gpl 3 0 or later",
    "gpl-2-spdx-only": "spdx license identifier gpl 2 0 only",
    "gpl-2-licensed": "this work is licensed under the gnu general public license version 2",
    "gpl-3-redistribute": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl-2-redistribute": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl-no-warranty": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "gpl-details": "see the gnu general public license for more details",
    "bsd-redistribution": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-2-licensed": "licensed under the bsd 2 clause license",
    "bsd-3-licensed": "licensed under the bsd 3 clause license",
    "bsd-3-spdx": "spdx license identifier bsd 3 clause",
    "mpl-2-terms": "this source code form is subject to the terms of the mozilla public license v",
    "mpl-2-obtain": "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0",
    "cc-by-4-licensed": "licensed under cc by 4 0",
    "cc-by-sa-4-licensed": "licensed under cc by sa 4 0",
    "cc-by-nc-4-licensed": "licensed under cc by nc 4 0",
    "cc-by-4-work": "this work is licensed under a creative commons attribution 4 0 international license",
    "cc-by-nc-4-work": "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
    "cc-by-sa-4-work": "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    "cc0-dedicated": "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work",
    "unlicense-public": "this is free and unencumbered software released into the public domain",
    "isc-permission": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "rights-reserved": "all rights reserved",
    "apache-title": "apache license",
    "apache-2-title-version": "version 2 0 january 2004",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "gpl-title": "gnu general public license",
    "lgpl-title": "gnu lesser general public license",
    "agpl-title": "gnu affero general public license",
    "gpl-2-title-version": "version 2 june 1991",
    "gpl-3-title-version": "version 3 29 june 2007",
    "agpl-3-title-version": "version 3 19 november 2007",
    "lgpl-2-1-title-version": "version 2 1 february 1999",
    "lgpl-2-1-redistribute": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version",
    "lgpl-3-redistribute": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "lgpl-3-redistribute-program": "this program is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "agpl-3-redistribute": "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "bsd-endorse": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd-as-is": "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
    "mpl-2-title": "mozilla public license version 2 0",
    "isc-title": "isc license",
    "isc-as-is": "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness",
    "epl-2-terms": "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0",
}

# Licence and its sentences in order.
RULES = [
    ("Apache-2.0", ["apache-2-licensed-under"]),
    ("Apache-2.0", ["apache-2-notice"]),
    ("Apache-2.0", ["apache-2-licensed-the-license", "apache-2-compliance"]),
    ("Apache-2.0", ["apache-2-as-is", "apache-2-specific"]),
    ("Apache-2.0", ["apache-2-spdx"]),
    ("MIT", ["mit-released"]),
    ("MIT", ["mit-licensed"]),
    ("MIT", ["mit-title"]),
    ("MIT", ["mit-title-short"]),
    ("MIT", ["mit-spdx"]),
    ("MIT", ["mit-notice", "mit-as-is", "mit-liability"]),
    ("GPL-3.0", ["gpl-3-licensed"]),
    ("GPL-3.0", ["gpl-3-spdx-only"]),
    ("GPL-3.0-or-later", ["gpl-3-spdx-later"]),
    ("GPL-3.0-or-later", ["gpl-3-redistribute", "gpl-no-warranty", "gpl-details"]),
    ("GPL-3.0-or-later", ["gpl-3-redistribute"]),
    ("GPL-2.0", ["gpl-2-licensed"]),
    ("GPL-2.0", ["gpl-2-spdx-only"]),
    ("GPL-2.0-or-later", ["gpl-2-redistribute", "gpl-no-warranty", "gpl-details"]),
    ("GPL-2.0-or-later", ["gpl-2-redistribute"]),
    ("BSD", ["bsd-redistribution", "bsd-source", "bsd-binary"]),
    ("BSD-2-Clause", ["bsd-2-licensed"]),
    ("BSD-3-Clause", ["bsd-3-licensed"]),
    ("BSD-3-Clause", ["bsd-3-spdx"]),
    ("MPL-2.0", ["mpl-2-terms"]),
    ("CC-BY-4.0", ["cc-by-4-licensed"]),
    ("CC-BY-4.0", ["cc-by-4-work"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-4-licensed"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-4-work"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-4-licensed"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-4-work"]),
    ("CC0-1.0", ["cc0-dedicated"]),
    ("Unlicense", ["unlicense-public"]),
    ("ISC", ["isc-permission"]),
    ("proprietary", ["rights-reserved"]),
    ("Apache-2.0", ["apache-title", "apache-2-title-version"]),
    ("MIT", ["mit-grant"]),
    ("GPL-2.0", ["gpl-title", "gpl-2-title-version"]),
    ("GPL-3.0", ["gpl-title", "gpl-3-title-version"]),
    ("LGPL-2.1", ["lgpl-title", "lgpl-2-1-title-version"]),
    ("LGPL-3.0", ["lgpl-title", "gpl-3-title-version"]),
    ("AGPL-3.0", ["agpl-title", "agpl-3-title-version"]),
    ("LGPL-2.1-or-later", ["lgpl-2-1-redistribute"]),
    ("LGPL-3.0-or-later", ["lgpl-3-redistribute"]),
    ("LGPL-3.0-or-later", ["lgpl-3-redistribute-program"]),
    ("AGPL-3.0-or-later", ["agpl-3-redistribute"]),
    ("BSD-2-Clause", ["bsd-redistribution", "bsd-source", "bsd-binary", "bsd-as-is"]),
    ("BSD-3-Clause", ["bsd-redistribution", "bsd-source", "bsd-binary", "bsd-endorse"]),
    ("MPL-2.0", ["mpl-2-title"]),
    ("ISC", ["isc-title", "isc-permission"]),
    ("ISC", ["isc-permission", "isc-as-is"]),
    ("EPL-2.0", ["epl-2-terms"]),
]

# Identifiers of the published SPDX list, and the licence they stand for.
SPDX = {
    "0BSD": "0BSD", "AGPL-3.0-only": "AGPL-3.0", "AGPL-3.0-or-later": "AGPL-3.0-or-later", "Apache-2.0": "Apache-2.0",
    "BSD-2-Clause": "BSD-2-Clause", "BSD-3-Clause": "BSD-3-Clause", "BSL-1.0": "BSL-1.0", "CC-BY-4.0": "CC-BY-4.0",
    "CC-BY-NC-4.0": "CC-BY-NC-4.0", "CC-BY-SA-4.0": "CC-BY-SA-4.0", "CC0-1.0": "CC0-1.0", "EPL-2.0": "EPL-2.0",
    "EUPL-1.2": "EUPL-1.2", "GPL-2.0-only": "GPL-2.0", "GPL-2.0-or-later": "GPL-2.0-or-later", "GPL-3.0-only": "GPL-3.0",
    "GPL-3.0-or-later": "GPL-3.0-or-later", "ISC": "ISC", "LGPL-2.1-only": "LGPL-2.1", "LGPL-2.1-or-later": "LGPL-2.1-or-later",
    "LGPL-3.0-only": "LGPL-3.0", "LGPL-3.0-or-later": "LGPL-3.0-or-later", "MIT": "MIT", "MIT-0": "MIT-0", "MPL-2.0": "MPL-2.0",
    "Unlicense": "Unlicense", "Zlib": "Zlib",
}
TAG = "spdx license identifier "
for _id, _licence in SPDX.items():
    _sentence = TAG + _id.lower().replace("-", " ").replace(".", " ")
    if _sentence not in SENTENCES.values():
        SENTENCES["spdx-" + _id.lower()] = _sentence
        RULES.append((_licence, ["spdx-" + _id.lower()]))

# A licence that others make more precise: "BSD" is left out beside one of its
# numbered forms, and "proprietary" (a bare reservation of rights, which most
# licence headers have too) beside any recognised licence.
VAGUE = {"BSD": ["BSD-2-Clause", "BSD-3-Clause"],
         "proprietary": sorted({name for name, _ in RULES} - {"proprietary"})}

SENTENCE_END = r"([.!?])([ \t\r\n])"
NO_WORD = r"[^0-9a-z\x{80}-\x{10FFFF}]+"
WRAPPED = r"([^\n])\n([^\n])"


def sentences(text: Column, joined: bool) -> Column:
    """The normalised, non-empty sentences of a text; ``joined``: a single
    line break does not end one."""
    whole = F.coalesce(text, F.lit(""))
    if joined:
        whole = F.regexp_replace(whole, WRAPPED, "$1 $2")
    cut = F.split(F.regexp_replace(whole, SENTENCE_END, "$1\n"), "\n")
    plain = F.transform(cut, lambda s: F.trim(F.regexp_replace(F.translate(s, UPPER, LOWER), NO_WORD, " ")))
    return F.filter(plain, lambda s: s != "")


def tags(found: Column) -> Column:
    """Sentences with each SPDX expression (``MIT OR Apache-2.0``) taken apart into
    one tag per licence; "or later" is part of a licence's name."""
    def parts(s):
        names = F.split(F.regexp_replace(F.substring(s, F.lit(len(TAG) + 1), F.length(s)), " or later", " or_later"), " (?:or|and|with) ")
        return F.transform(names, lambda n: F.concat(F.lit(TAG), F.replace(n, F.lit("or_later"), F.lit("or later"))))
    return F.flatten(F.transform(found, lambda s: F.when(s.startswith(TAG), parts(s)).otherwise(F.array(s))))


def identifiers(sentences: Column) -> Column:
    """The identifiers of the known sentences, in order."""
    found = tags(sentences)
    known = F.create_map(*[F.lit(x) for name, s in SENTENCES.items() for x in (s, name)])
    lengths = sorted({len(s) for s in SENTENCES.values()})
    candidates = F.filter(found, lambda s: F.length(s).isin(lengths))
    return F.array_compact(F.transform(candidates, lambda s: F.element_at(known, s)))


def licenses_of(ids: Column) -> Column:
    """The licences whose rules fit the sequence of identifiers, sorted."""
    line = F.concat(F.lit(","), F.array_join(ids, ","), F.lit(","))
    fits = [F.when(F.contains(line, F.lit("," + ",".join(rule) + ",")), F.lit(name)) for name, rule in RULES]
    return F.array_sort(F.array_distinct(F.array_compact(F.array(*fits))))


def precise(found: Column) -> Column:
    """Without the vague names that another one makes more precise."""
    for name, better in VAGUE.items():
        found = F.when(F.arrays_overlap(found, F.array(*map(F.lit, better))), F.array_remove(found, name)).otherwise(found)
    return found


def scan(docs: DataFrame, text_col: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with a struct column (its name is returned too): number of
    ``sentences``, the ``known`` ones line by line, and the ``licenses``."""
    common.prepare(docs.sparkSession)
    lines, runs, seen, result = common.free_name(docs, "lines", "runs", "seen", "licenses")
    text = F.col(text_col)
    cut = docs.withColumn(lines, sentences(text, False)).withColumn(runs, identifiers(sentences(text, True)))
    cut = cut.withColumn(seen, identifiers(F.col(lines)))
    both = precise(F.array_sort(F.array_union(licenses_of(F.col(seen)), licenses_of(F.col(runs)))))
    return cut.withColumn(result, F.struct(F.size(lines).cast("long").alias("sentences"), F.col(seen).alias("known"),
                                           both.alias("licenses"))).drop(lines, runs, seen), result
