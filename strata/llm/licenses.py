"""Licence recognition by sentence rules.

A text is normalised (lower case; everything but letters, digits and dots in
words becomes one space) and cut where a sentence may end: at closing
punctuation and at each newline.  A run of pieces that, joined, is a known
licence sentence, or a grant ("licensed under ...") of a known licence name,
maps to its identifier; so a sentence may be wrapped, be a comment or hold such
punctuation itself ("License, v. 2.0").  Runs are taken from the left; of those
that begin with the same piece the longest known one counts.  The identifiers, in order, are matched against
licence rules: each rule in turn replaces its sequence of identifiers wherever
it occurs, so a longer rule goes before one that is part of it.  What no rule
takes is reported as it is.  All of it is built-in functions, one pass, no
shuffle.
"""

from __future__ import annotations

import itertools
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import table

# Sentences of public licence texts, normalised, and their identifiers.
SENTENCES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "MitGrant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "MitNotice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "MitAsIs",
    "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software": "MitLiability",
    "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the following": "BslGrant",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "IscGrant",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "BsdGrant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "BsdSource",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "BsdBinary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "BsdEndorse",
    "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed": "BsdAsIs",
    "in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage": "BsdLiability",
    "this software is provided as is without any express or implied warranty": "ZlibAsIs",
    "in no event will the authors be held liable for any damages arising from the use of this software": "ZlibLiability",
    "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions": "ZlibGrant",
    "you may not use this file except in compliance with the license": "ApacheUse",
    "you may obtain a copy of the license at http www.apache.org licenses license 2.0": "ApacheCopy",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": "ApacheAsIs",
    "see the license for the specific language governing permissions and limitations under the license": "ApacheSee",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "Gpl3Later",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "Gpl2Later",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose": "GplWarranty",
    "see the gnu general public license for more details": "GplSee",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2.1 of the license or at your option any later version": "Lgpl21Later",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version": "Lgpl3Later",
    "this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose": "LgplWarranty",
    "see the gnu lesser general public license for more details": "LgplSee",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version": "Agpl3Later",
    "see the gnu affero general public license for more details": "AgplSee",
    "this program and the accompanying materials are made available under the terms of the eclipse public license 2.0 which is available at https www.eclipse.org legal epl 2.0": "Epl2",
    "this source code form is subject to the terms of the mozilla public license v. 2.0": "Mpl2",
    "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla.org mpl 2.0": "MplCopy",
    "this is free and unencumbered software released into the public domain": "Unlicense",
    "all rights reserved": "AllRights",
}
# Licence names after "licensed under", normalised, and their SPDX identifiers.
NAMES = {
    "apache license version 2.0": "Apache-2.0",
    "apache license version 2.0 the license": "Apache-2.0",
    "apache 2.0 license": "Apache-2.0",
    "mit license": "MIT",
    "isc license": "ISC",
    "bsd 2 clause license": "BSD-2-Clause",
    "bsd 3 clause license": "BSD-3-Clause",
    "gnu general public license version 2": "GPL-2.0-only",
    "gnu general public license version 3": "GPL-3.0-only",
    "gnu lesser general public license version 3": "LGPL-3.0-only",
    "gnu affero general public license version 3": "AGPL-3.0-only",
    "mozilla public license version 2.0": "MPL-2.0",
    "eclipse public license version 2.0": "EPL-2.0",
    "boost software license version 1.0": "BSL-1.0",
    "creative commons attribution 4.0 international license": "CC-BY-4.0",
    "creative commons attribution sharealike 4.0 international license": "CC-BY-SA-4.0",
    "creative commons attribution noncommercial 4.0 international license": "CC-BY-NC-4.0",
    "creative commons attribution noderivatives 4.0 international license": "CC-BY-ND-4.0",
    "creative commons attribution noncommercial sharealike 4.0 international license": "CC-BY-NC-SA-4.0",
    "creative commons attribution noncommercial noderivatives 4.0 international license": "CC-BY-NC-ND-4.0",
    "cc0 1.0": "CC0-1.0",
    "cc by 4.0": "CC-BY-4.0",
    "cc by sa 4.0": "CC-BY-SA-4.0",
    "cc by nc 4.0": "CC-BY-NC-4.0",
    "cc by nd 4.0": "CC-BY-ND-4.0",
    "cc by nc sa 4.0": "CC-BY-NC-SA-4.0",
    "cc by nc nd 4.0": "CC-BY-NC-ND-4.0",
}
# How a grant begins; each part may be one of several.
GRANT = (
    ("", *(f"this {thing} is " for thing in ("work", "file", "code", "software", "program", "project"))),
    ("licensed under ", "released under ", "distributed under ", "available under "),
    ("", "the ", "a "),
    ("", "terms of the "),
)
HEADS = ["".join(parts) for parts in itertools.product(*GRANT[:2])]
GRANT_PATTERN = "".join(f"(?:{'|'.join(p for p in part if p)})" + ("" if part[0] else "?") for part in GRANT)
SPACE = r"[ \t\n\x0B\f\r]"
SENTENCE_END = rf"[.!?;:]+(?:{SPACE}+|\z)|\n+"


def _prefixes(spdx: str, sequence: str, least: int = 1) -> list[tuple[str, list[str]]]:
    """Rules for a notice and for its first sentences, the longest first."""
    ids = sequence.split()
    return [(spdx, ids[:n]) for n in range(len(ids), least - 1, -1)]


#: (licence, its sequence of identifiers), in the order in which they are tried.
RULES = [
    *_prefixes("MIT", "MitGrant MitNotice MitAsIs MitLiability", 2),
    ("ISC", ["IscGrant"]),
    *_prefixes("BSD-3-Clause", "BsdGrant BsdSource BsdBinary BsdEndorse BsdAsIs BsdLiability", 4),
    *_prefixes("BSD-2-Clause", "BsdGrant BsdSource BsdBinary BsdAsIs BsdLiability", 3),
    *_prefixes("Zlib", "ZlibAsIs ZlibLiability ZlibGrant", 3),
    ("BSL-1.0", ["BslGrant"]),
    *_prefixes("Apache-2.0", "Grant:Apache-2.0 ApacheUse ApacheCopy ApacheAsIs ApacheSee", 2),
    *_prefixes("GPL-3.0-or-later", "Gpl3Later GplWarranty GplSee"),
    *_prefixes("GPL-2.0-or-later", "Gpl2Later GplWarranty GplSee"),
    *_prefixes("LGPL-3.0-or-later", "Lgpl3Later LgplWarranty LgplSee"),
    *_prefixes("LGPL-2.1-or-later", "Lgpl21Later LgplWarranty LgplSee"),
    *_prefixes("AGPL-3.0-or-later", "Agpl3Later GplWarranty AgplSee"),
    *_prefixes("MPL-2.0", "Mpl2 MplCopy"),
    ("EPL-2.0", ["Epl2"]),
    ("Unlicense", ["Unlicense"]),
    *[(spdx, [f"Grant:{spdx}"]) for spdx in dict.fromkeys(NAMES.values())],
    ("All-rights-reserved", ["AllRights"]),
]


def _map(values: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def _plain(sentence: str) -> str:
    """Without the dots that end a word, as texts are normalised."""
    return re.sub(r"\.(?![a-z0-9])", "", sentence)


KNOWN = {_plain(s): i for s, i in SENTENCES.items()}
LONGEST = max(len(s.split()) for s in KNOWN)
GRANT_SIZE = max(map(len, map("".join, itertools.product(*GRANT)))) + max(map(len, NAMES))


def _pieces(text: Column) -> Column:
    marked = F.regexp_replace(F.lower(text), SENTENCE_END, "\n")
    words = F.regexp_replace(marked, r"(?:[^a-z0-9.\n]|\.(?![a-z0-9]))++", " ")
    return F.filter(F.transform(F.split(words, "\n"), lambda p: F.trim(p)), lambda p: p != "")


def _begins(said: Column) -> Column:
    """Whether a known sentence or a grant may begin with ``said``."""
    part = F.exists(F.lit([*KNOWN, *HEADS]), lambda known: F.startswith(known, said))
    return part | (F.length(said) <= GRANT_SIZE) & F.exists(F.lit(HEADS), lambda head: F.startswith(said, head))


def _identifier(said: Column) -> Column:
    name = F.element_at(_map(NAMES), F.regexp_extract(said, f"^{GRANT_PATTERN}(.+)$", 1))
    return F.coalesce(F.element_at(_map(KNOWN), said), F.concat(F.lit("Grant:"), name))


def _longest(pieces: Column) -> Column:
    """The longest known sentence that is the first of ``pieces``, joined: its number of pieces (0: none) and identifier."""

    def step(state: Column, piece: Column) -> Column:
        def judged(said: Column) -> Column:
            found, seen = _identifier(said), state["seen"] + 1
            return F.struct(
                F.when(_begins(said), said).alias("said"),
                seen.alias("seen"),
                F.when(found.isNull(), state["size"]).otherwise(seen).alias("size"),
                F.coalesce(found, state["found"]).alias("found"),
            )

        said = F.array(F.ltrim(F.concat(state["said"], F.lit(" "), piece)))
        return F.when(state["said"].isNull(), state).otherwise(F.element_at(F.transform(said, judged), 1))

    start = {"said": F.lit(""), "seen": F.lit(0), "size": F.lit(0), "found": F.lit(None).cast("string")}
    return F.aggregate(pieces, F.struct(*[c.alias(k) for k, c in start.items()]), step, lambda s: F.struct(s["size"].alias("size"), s["found"].alias("found")))


def _identifiers(pieces: Column) -> Column:
    """The identifiers in the pieces of a text, from the left, none within another's pieces.

    Only pieces that may begin a known sentence are followed.
    """
    at = F.transform(pieces, lambda p, i: F.struct(i.alias("at"), F.when(_begins(p), _longest(F.slice(pieces, i + 1, LONGEST))).alias("run")))
    known = F.filter(at, lambda x: x["run"]["size"] > 0)

    def step(state: Column, x: Column) -> Column:
        taken = F.struct((x["at"] + x["run"]["size"]).alias("end"), F.array_append(state["ids"], x["run"]["found"]).alias("ids"))
        return F.when(x["at"] < state["end"], state).otherwise(taken)

    start = F.struct(F.lit(0).alias("end"), F.array().cast("array<string>").alias("ids"))
    return F.aggregate(known, start, step, lambda s: s["ids"])


def recognise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per row of ``docs``: doc_id, n_sentences, licenses, unmatched.

    n_sentences counts the sentences with an identifier; licenses are the
    distinct licences found, ascending, comma-joined; unmatched the
    identifiers that no rule takes, in order, comma-joined.  Null and empty
    texts have none; other columns are not looked at.
    """
    cut = docs.select(F.col(id_col).alias("doc_id"), _pieces(F.coalesce(F.col(text_col), F.lit(""))).alias("pieces"))
    ids = cut.select("doc_id", _identifiers(F.col("pieces")).alias("ids"))
    found = F.concat_ws("", F.transform("ids", lambda i: F.concat(F.lit("<"), i, F.lit(">"))))
    for spdx, sequence in RULES:
        found = F.replace(found, F.lit("".join(f"<{i}>" for i in sequence)), F.lit("{" + spdx + "}"))
    return ids.select("doc_id", F.size("ids").cast("long").alias("n_sentences"), found.alias("found")).select(
        "doc_id",
        "n_sentences",
        F.array_join(F.array_sort(F.array_distinct(F.regexp_extract_all("found", F.lit(r"\{([^}]+)\}"), 1))), ",").alias("licenses"),
        F.array_join(F.regexp_extract_all("found", F.lit("<([^>]+)>"), 1), ",").alias("unmatched"),
    )


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recognise(table(spark, sf_dir, "documents"))


def oracle() -> str:
    """The same over ``documents`` in DuckDB, where one pattern of all known sentences finds them between marks (newlines)."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    lookup = lambda values: f"map([{', '.join(map(quote, values))}], [{', '.join(map(quote, values.values()))}])"
    names = "|".join(sorted(map(re.escape, NAMES), key=len, reverse=True))
    known = "|".join([*sorted(map(re.escape, KNOWN), key=len, reverse=True), f"{GRANT_PATTERN}(?:{names})"])
    known = "\n(" + re.sub(r"\\? ", "(?: |\n\n)", known) + ")\n"
    found = "array_to_string(list_transform(ids, lambda i: '<' || i || '>'), '')"
    for spdx, sequence in RULES:
        found = f"replace({found}, {quote(''.join(f'<{i}>' for i in sequence))}, {quote('{' + spdx + '}')})"
    return f"""
        with marked as (
            select doc_id, regexp_replace(lower(coalesce(text, '')), {quote(SENTENCE_END)}, chr(10), 'g') as t from documents
        ), words as (
            select doc_id, regexp_replace(regexp_replace(regexp_replace(t, '[^a-z0-9.\\n]+', ' ', 'g'),
                '\\.([a-z0-9])', chr(1) || '\\1', 'g'), '[ .]+', ' ', 'g') as t from marked
        ), lines as (
            select doc_id, regexp_replace(chr(10) || replace(t, chr(1), '.') || chr(10), ' ?\\n[ \\n]*', chr(10) || chr(10), 'g') as t
            from words
        ), said as (
            select doc_id, list_transform(regexp_extract_all(t, {quote(known)}, 1),
                lambda s: regexp_replace(s, '[ \\n]+', ' ', 'g')) as sentences
            from lines
        ), named as (
            select doc_id, list_transform(sentences, lambda s: coalesce({lookup(KNOWN)}[s],
                'Grant:' || {lookup(NAMES)}[regexp_extract(s, {quote(f"^{GRANT_PATTERN}(.+)$")}, 1)])) as ids
            from said
        ), ruled as (select doc_id, len(ids)::bigint as n_sentences, coalesce({found}, '') as found from named)
        select doc_id, n_sentences,
            coalesce(array_to_string(list_sort(list_distinct(regexp_extract_all(found, '\\{{([^}}]+)\\}}', 1))), ','), '') as licenses,
            coalesce(array_to_string(regexp_extract_all(found, '<([^>]+)>', 1), ','), '') as unmatched
        from ruled"""
