"""Licence scans by sentence rules.

Texts are parted into sentence fragments, fragments that stand together are normalised and looked up among known licence
sentences, and the sequence of their identifiers is matched against rules, each an ordered list of identifiers for a licence and the
most other fragments that may lie between two of them. A text that lacks all of a few words, of which each known sentence has
one, is done after a search for them.
"""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attestry.llm.common import map_rows, table

#: Sentences of public licences, normalised as normal() does, by identifier.
SENTENCES = {
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit-warranty": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "mit-liability": "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "isc-warranty": "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness",
    "bsd-grant": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-names-regents": "neither the name of the university nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd-warranty-regents": "this software is provided by the regents and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
    "bsd-liability-owner": "in no event shall the copyright owner or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage",
    "bsd-liability": "in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage",
    "zlib-warranty": "this software is provided as is without any express or implied warranty",
    "zlib-liability": "in no event will the authors be held liable for any damages arising from the use of this software",
    "zlib-grant": "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions",
    "bsd-names": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd-warranty": "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
    "apache-use": "you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at",
    "apache-basis": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "apache-see": "see the license for the specific language governing permissions and limitations under the license",
    "gpl-later-2": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl-later-3": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl-hope": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "lgpl-later-3": "this program is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "agpl-later-3": "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "mpl-copy": "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0",
    "mpl-form": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "unlicense-domain": "this is free and unencumbered software released into the public domain",
    "unlicense-anyone": "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means",
}
#: Names that notices give to licences.
NAMES = {
    "MIT": ("mit license", "mit licence", "mit"),
    "ISC": ("isc license",),
    "BSD-2-Clause": ("bsd 2 clause license", "simplified bsd license"),
    "BSD-3-Clause": ("bsd 3 clause license", "new bsd license"),
    "Apache-2.0": ("apache license version 2 0", "apache license 2 0", "apache 2 0 license", "apache license version 2 0 the license"),
    "GPL-2.0-only": ("gnu general public license version 2", "gpl version 2"),
    "GPL-3.0-only": ("gnu general public license version 3", "gpl version 3"),
    "LGPL-3.0-only": ("gnu lesser general public license version 3",),
    "AGPL-3.0-only": ("gnu affero general public license version 3",),
    "MPL-2.0": ("mozilla public license version 2 0", "mozilla public license 2 0"),
    "CC-BY-4.0": ("cc by 4 0", "creative commons attribution 4 0 international license"),
    "CC-BY-SA-4.0": ("cc by sa 4 0", "creative commons attribution sharealike 4 0 international license"),
    "CC-BY-NC-4.0": ("cc by nc 4 0", "creative commons attribution noncommercial 4 0 international license"),
    "CC0-1.0": ("cc0 1 0",),
}
#: How notices begin.
OPENINGS = ("licensed under", "released under", "distributed under", "published under", "available under", "this work is licensed under", "this software is licensed under", "this project is licensed under", "this file is licensed under", "spdx license identifier")
#: Other fragments between two sentences of a rule, where the rule says nothing else; long enough for list items and notices.
GAP = 6
#: (licence, identifiers in order, gap). Of rules that share sentences the one with more sentences wins, then the first. Notices are whole by
#: themselves; texts that are printed in one piece have the gap of their longest list.
RULES: tuple[tuple[str, tuple[str, ...], int], ...] = (
    ("MIT", ("mit-grant", "mit-notice", "mit-warranty"), GAP),
    ("MIT", ("mit-grant", "mit-notice", "mit-warranty", "mit-liability"), GAP),
    ("ISC", ("isc-grant", "isc-warranty"), GAP),
    *(
        ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", names, *rest), GAP)
        for names in ("bsd-names", "bsd-names-regents")
        for rest in ((), ("bsd-warranty",), ("bsd-warranty-regents",))
    ),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary"), GAP),
    ("Apache-2.0", ("notice:Apache-2.0", "apache-use", "apache-copy", "apache-basis", "apache-see"), GAP),
    ("Apache-2.0", ("apache-use", "apache-copy", "apache-basis"), GAP),
    ("GPL-2.0-or-later", ("gpl-later-2",), GAP),
    ("GPL-2.0-or-later", ("gpl-later-2", "gpl-hope"), GAP),
    ("GPL-3.0-or-later", ("gpl-later-3",), GAP),
    ("GPL-3.0-or-later", ("gpl-later-3", "gpl-hope"), GAP),
    ("LGPL-3.0-or-later", ("lgpl-later-3",), GAP),
    ("AGPL-3.0-or-later", ("agpl-later-3",), GAP),
    ("MPL-2.0", ("mpl-form",), GAP),
    ("MPL-2.0", ("mpl-form", "mpl-copy"), GAP),
    ("Zlib", ("zlib-warranty", "zlib-liability", "zlib-grant"), GAP),
    ("Unlicense", ("unlicense-domain",), GAP),
    ("Unlicense", ("unlicense-domain", "unlicense-anyone"), GAP),
    *((name, (f"notice:{name}",), 0) for name in NAMES),
)
_PART = re.compile(r"[.!?:;](?=\s|$)|\n")
_PLAIN = re.compile(r"[a-z0-9]+")


def normal(text: str) -> str:
    """Lower-case runs of ASCII letters and digits, joined by single spaces."""
    return " ".join(_PLAIN.findall(text.lower()))


def known_sentences() -> dict[str, str]:
    """Normalised sentence -> identifier; notices are each opening with each name, with or without an article."""
    out = {said: name for name, said in SENTENCES.items()}
    for licence, names in NAMES.items():
        for spelled in (*names, normal(licence)):
            for opening in OPENINGS:
                for article in ("", "the ", "the terms of the "):
                    out[f"{opening} {article}{spelled}"] = f"notice:{licence}"
    return out


def telling_words(sentences: dict[str, str]) -> list[str]:
    """A few words of which every sentence has one, long ones where there are such."""
    left = [set(s.split(" ")) for s in sentences]
    left = [{w for w in words if len(w) >= 7} or words for words in left]
    out = []
    while left:
        counts = Counter(w for words in left for w in words)
        out.append(min(counts, key=lambda w: (-counts[w], -len(w), w)))
        left = [words for words in left if out[-1] not in words]
    return out


class Scanner:
    def __init__(self, sentences: dict[str, str], rules=RULES) -> None:
        self.known = sentences
        self.rules = sorted(rules, key=lambda r: -len(r[1]))
        self.words = telling_words(sentences)
        self.beginnings = {s[:i] for s in sentences for i, c in enumerate(s + " ") if c == " "}

    def sentences(self, text: str) -> list[tuple[int, int, str]]:
        """(first fragment, last fragment, identifier) of the known sentences in a text, the longest at each place."""
        fragments = [n for x in _PART.split(text) if (n := normal(x))]
        out, i = [], 0
        while i < len(fragments):
            found, said, j = None, fragments[i], i
            while said in self.beginnings:  # of known sentences, so that this ends with the longest
                if said in self.known:
                    found = (i, j, self.known[said])
                j += 1
                if j == len(fragments):
                    break
                said = f"{said} {fragments[j]}"
            if found:
                out.append(found)
                i = found[1]
            i += 1
        return out

    def __call__(self, text: str | None) -> tuple[list[tuple[str, int, int, int]], int]:
        """Matches (licence, first and last fragment, sentences) in order, and how many known sentences the text has."""
        low = (text or "").lower()
        if not any(w in low for w in self.words):
            return [], 0
        found = self.sentences(text)
        used, out = set(), []
        for licence, wanted, gap in self.rules if found else ():
            for at, (first, _, name) in enumerate(found):
                if name != wanted[0] or at in used:
                    continue
                places, k = [at], at + 1
                while len(places) < len(wanted) and k < len(found):
                    if found[k][0] - found[places[-1]][1] - 1 > gap:
                        break
                    if found[k][2] == wanted[len(places)] and k not in used:
                        places.append(k)
                    k += 1
                if len(places) == len(wanted):
                    used.update(places)
                    out.append((licence, first, found[places[-1]][1], len(wanted)))
        return sorted(out, key=lambda m: (m[1], m[2], m[0])), len(found)


def scanned(docs: DataFrame, sentences: dict[str, str] | None = None, rules=RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs -> (doc_id, matches array<struct<licence,first,last,sentences>>, n_sentences): a row for each row, in no order.

    first and last count the text's sentence fragments from 0. Null and empty texts have no matches; an empty table gives an empty
    one. A sentence serves one match: of rules that share it the longest, then the first listed, and of places the first. Rows that
    repeat are scanned each; other columns of docs don't matter. A sentence may be spread over any number of fragments.
    """
    known = known_sentences() if sentences is None else sentences

    def run(rows):
        scan = Scanner(known, rules)
        for doc_id, text in rows:
            matches, n = scan(text)
            yield doc_id, [dict(zip(("licence", "first", "last", "sentences"), m, strict=True)) for m in matches], n

    kind = dict(docs.dtypes)[id_col]
    return map_rows(docs.select(F.col(id_col), F.col(text_col)), run, f"doc_id {kind}, matches array<struct<licence:string,first:long,last:long,sentences:long>>, n_sentences long")


def op10_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences found in each document (distinct, sorted), its matches and its known sentences; a row for each."""
    rows = scanned(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", F.array_join(F.sort_array(F.array_distinct(F.col("matches.licence"))), " ").alias("licences"), F.size("matches").cast("long").alias("n_matches"), "n_sentences")
