"""Licence scans by sentence rules, natively in column expressions.

A text is cut into sentences, which are normalised (lower case, words only).
Comment marks are taken off, and lines of a paragraph are joined first, so that
it does not matter where a text is wrapped. A sentence that holds a known licence
sentence gives its identifier (several, in the order of their places, where lines
without an end mark run together); the identifiers of a text, in order, are
matched against ordered licence rules: each rule, in turn, takes the runs of
identifiers that it names, and what it has taken no later rule sees. Everything
happens within a row; nothing is shuffled.

Cases: null or empty texts have no sentences; texts are read whole; known
sentences that no rule takes are counted as ``n_unmatched``; repeated rows give
repeated rows; empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factweave.llm.common import pick

#: SPDX identifiers, in lower case, and the licences they name.
SPDX = {
    "0bsd": "0BSD", "agpl-3.0": "AGPL-3.0", "apache-2.0": "Apache-2.0", "artistic-2.0": "Artistic-2.0", "bsd-2-clause": "BSD-2-Clause", "bsd-3-clause": "BSD-3-Clause", "bsl-1.0": "BSL-1.0",
    "cc-by-4.0": "CC-BY", "cc-by-nc-4.0": "CC-BY-NC", "cc-by-sa-4.0": "CC-BY-SA", "cc0-1.0": "CC0", "cddl-1.0": "CDDL", "epl-1.0": "EPL", "epl-2.0": "EPL", "gpl-2.0": "GPL-2.0", "gpl-3.0": "GPL-3.0", "isc": "ISC",
    "lgpl-2.1": "LGPL", "lgpl-3.0": "LGPL", "mit": "MIT", "mpl-2.0": "MPL-2.0", "ofl-1.1": "OFL", "unlicense": "Unlicense", "wtfpl": "WTFPL", "zlib": "Zlib",
}

_UNDER = r"(?:licensed|released|distributed|available|covered|published|governed|dedicated to the public domain) (?:under|by) (?:the )?(?:terms of )?(?:the )?(?:a )?"
_CC = r"(?:licensed|released|available|distributed|published) under (?:the |a )?(?:creative commons|cc)[ -](?:by|attribution)"
_URL = r"creativecommons.org (?:licenses|publicdomain) "
_VERSION = r"(?:,? ?(?:version|v))? ?"

#: Identifier, a word that the sentence holds, and the pattern of known sentences. Patterns are over normalised sentences (words of letters, digits, dots, hyphens and plus signs, one space between) and match whole words.
SENTENCES = (
    *((f"spdx-{name}", "spdx", rf"spdx-license-identifier (?:[a-z0-9.+-]+ (?:or|and|with) )*{name.replace('.', '[.]').replace('+', '[+]')}(?:-only|-or-later|[+])?") for name in SPDX),
    ("cc-by-nc", "cc", rf"{_CC}[ -](?:nc|noncommercial)(?:[ -](?:sa|nd|sharealike|noderivatives|noderivs))?"),
    ("cc-by-sa", "cc", rf"{_CC}[ -](?:sa|sharealike|share alike)"),
    ("cc-by-nd", "cc", rf"{_CC}[ -](?:nd|noderivatives|noderivs)"),
    ("cc-by", "cc", rf"{_CC}(?: license| licence)?(?: v?[0-9][.][0-9])?(?: (?:international|unported|generic|license|licence))*$"),
    ("cc-by-nc", "commons", rf"{_CC}[ -](?:nc|noncommercial)(?:[ -](?:sa|nd|sharealike|noderivatives|noderivs))?"),
    ("cc-by-sa", "commons", rf"{_CC}[ -](?:sa|sharealike|share alike)"),
    ("cc-by-nd", "commons", rf"{_CC}[ -](?:nd|noderivatives|noderivs)"),
    ("cc-by", "commons", rf"{_CC}(?: license| licence)?(?: v?[0-9][.][0-9])?(?: (?:international|unported|generic|license|licence))*$"),
    ("cc-by-nc-url", "creativecommons.org", rf"{_URL}by-nc(?:-sa|-nd)?"),
    ("cc-by-sa-url", "creativecommons.org", rf"{_URL}by-sa"),
    ("cc-by-nd-url", "creativecommons.org", rf"{_URL}by-nd"),
    ("cc-by-url", "creativecommons.org", rf"{_URL}by"),
    ("cc0-url", "creativecommons.org", rf"{_URL}zero"),
    ("cc0", "cc0", rf"{_UNDER}cc0"),
    ("cc0", "commons", rf"{_UNDER}creative commons zero"),
    ("cc0-waive", "waived", r"waived all copyright and related or neighboring rights"),
    ("agpl-3", "affero", rf"{_UNDER}(?:gnu )?affero general public license{_VERSION}(?:3(?:[.]0)?)?"),
    ("agpl-3", "agpl", rf"{_UNDER}(?:gnu )?agpl{_VERSION}(?:3(?:[.]0)?)?"),
    ("lgpl", "license", rf"{_UNDER}(?:gnu )?lesser general public license"),
    ("lgpl", "lgpl", rf"{_UNDER}(?:gnu )?lgpl(?:v?[23])?"),
    ("gpl-3", "license", rf"{_UNDER}(?:gnu )?general public license{_VERSION}3(?:[.]0)?"),
    ("gpl-2", "license", rf"{_UNDER}(?:gnu )?general public license{_VERSION}2(?:[.]0)?"),
    ("gpl-3", "gpl", rf"{_UNDER}(?:gnu )?gpl(?:{_VERSION}|-)3(?:[.]0)?"),
    ("gpl-2", "gpl", rf"{_UNDER}(?:gnu )?gpl(?:{_VERSION}|-)2(?:[.]0)?"),
    ("gpl-redistribute", "redistribute", r"you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl-redistribute", "redistribute", r"you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license"),
    ("agpl-redistribute", "redistribute", r"you can redistribute it and or modify it under the terms of the gnu affero general public license"),
    ("either-3", "license", r"either version 3(?:[.]0)? of the license"),
    ("either-2", "license", r"either version 2(?:[.][01])? of the license"),
    ("gpl-warranty", "warranty", r"is distributed in the hope that it will be useful but without any warranty"),
    ("gpl-see", "license", r"see the gnu (?:lesser |library |affero )?general public license for more details"),
    ("gpl-copy", "license", r"you should have received a copy of the gnu (?:lesser |library |affero )?general public license"),
    ("gpl-3-title", "gnu", r"gnu general public license version 3 29 june 2007"),
    ("gpl-2-title", "gnu", r"gnu general public license version 2 june 1991"),
    ("verbatim", "verbatim", r"everyone is permitted to copy and distribute verbatim copies of this license document"),
    ("apache-2", "apache", rf"{_UNDER}apache license{_VERSION}2(?:[.]0)?"),
    ("apache-use", "license", r"you may not use this (?:file|work|software) except in compliance with the license"),
    ("apache-copy", "license", r"you may obtain a copy of the license at"),
    ("apache-warranty", "license", r"unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    ("mpl-2", "mozilla", r"subject to the terms of the mozilla public license(?:,? v(?: ?2(?:[.]0)?)?| ?version 2(?:[.]0)?)"),
    ("mpl-2", "mozilla", rf"{_UNDER}mozilla public license{_VERSION}2(?:[.]0)?"),
    ("mpl-copy", "mpl", r"if a copy of the mpl was not distributed with this file"),
    ("epl", "license", r"made available under the terms of the eclipse public license"),
    ("epl", "license", rf"{_UNDER}eclipse public license"),
    ("cddl", "cddl", r"common development and distribution license.{0,20} cddl"),
    ("ofl", "license", r"(?:licensed|available) under the sil open font license"),
    ("artistic-2", "license", rf"{_UNDER}artistic license 2(?:[.]0)?"),
    ("artistic-2", "redistributed", r"this license establishes the terms under which a given free software package may be copied modified distributed and or redistributed"),
    ("bsl-grant", "permission", r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    ("mit-short", "licen", r"(?:released|licensed|distributed|available|covered) under (?:the )?(?:terms of )?(?:the )?mit(?: \(?expat\)?)? licen[sc]e"),
    ("mit-grant", "permission", r"permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mit-notice", "permission", r"the above copyright notice and this permission notice (?:\(?including the next paragraph\)? )?shall be included in all copies or substantial portions of the software"),
    ("mit-warranty", "warranty", r"the software is provided as is without warranty of any kind express or implied"),
    ("mit-liable", "liable", r"in no event shall the authors or copyright holders be liable for any claim damages or other liability"),
    ("isc-grant", "permission", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("isc-warranty", "disclaims", r"the software is provided as is and the author disclaims all warranties with regard to this software"),
    ("bsd-start", "redistribution", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-source", "redistributions", r"redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd-binary", "redistributions", r"redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"),
    ("bsd-advertise", "advertising", r"all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("bsd-endorse", "endorse", r"neither the names? of .{1,80} may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsd-warranty", "warranties", r"this software is provided by .{1,80} as is and any express or implied warranties"),
    ("bsd-liable", "liable", r"in no event shall .{1,80} be liable for any direct indirect incidental special exemplary or consequential damages"),
    ("zlib-warranty", "warranty", r"this software is provided as-is without any express or implied warranty"),
    ("zlib-grant", "permission", r"permission is granted to anyone to use this software for any purpose including commercial applications"),
    ("zlib-origin", "misrepresented", r"the origin of this software must not be misrepresented"),
    ("zlib-altered", "altered", r"altered source versions must be plainly marked as such"),
    ("zlib-notice", "altered", r"this notice may not be removed or altered from any source distribution"),
    ("unlicense", "unencumbered", r"this is free and unencumbered software released into the public domain"),
    ("unlicense-free", "publish", r"anyone is free to copy modify publish use compile sell or distribute this software"),
    ("wtfpl", "fuck", r"do what the fuck you want to public license"),
    ("public-domain", "domain", r"(?:is|are|been) (?:hereby )?(?:placed|released|dedicated|put) (?:in|into|to) the public domain"),
    ("all-rights", "reserved", r"all rights reserved"),
    ("copyright", "copyright", r"copyright (?:copyright )?(?:19|20)[0-9][0-9]"),
)

#: Licence and the run of identifiers that it takes, tried in this order.
RULES = (
    ("Apache-2.0", ("apache-2", "apache-use", "apache-copy", "apache-warranty")),
    ("Apache-2.0", ("apache-2",)),
    ("Apache-2.0", ("apache-use", "apache-copy", "apache-warranty")),
    ("BSD-4-Clause", ("bsd-start", "bsd-source", "bsd-binary", "bsd-advertise", "bsd-endorse", "bsd-warranty", "bsd-liable")),
    ("BSD-3-Clause", ("bsd-start", "bsd-source", "bsd-binary", "bsd-endorse", "bsd-warranty", "bsd-liable")),
    ("BSD-3-Clause", ("bsd-start", "bsd-source", "bsd-binary", "bsd-endorse", "bsd-warranty")),
    ("BSD-3-Clause", ("bsd-start", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-2-Clause", ("bsd-start", "bsd-source", "bsd-binary", "bsd-warranty", "bsd-liable")),
    ("BSD-2-Clause", ("bsd-start", "bsd-source", "bsd-binary", "bsd-warranty")),
    ("BSD-2-Clause", ("bsd-start", "bsd-source", "bsd-binary")),
    ("MIT", ("mit-grant", "mit-notice", "mit-warranty", "mit-liable")),
    ("MIT", ("mit-grant", "mit-notice", "mit-warranty")),
    ("MIT-0", ("mit-grant", "mit-warranty", "mit-liable")),
    ("MIT", ("mit-grant", "mit-notice")),
    ("MIT", ("mit-short",)),
    ("ISC", ("isc-grant", "isc-warranty")),
    ("ISC", ("isc-grant",)),
    ("BSL-1.0", ("bsl-grant",)),
    ("Zlib", ("zlib-warranty", "zlib-grant", "zlib-origin", "zlib-altered", "zlib-notice")),
    ("Zlib", ("zlib-grant", "zlib-origin", "zlib-altered", "zlib-notice")),
    ("Unlicense", ("unlicense", "unlicense-free")),
    ("Unlicense", ("unlicense",)),
    ("WTFPL", ("verbatim", "wtfpl")),
    ("WTFPL", ("wtfpl",)),
    ("AGPL-3.0", ("agpl-redistribute", "either-3", "gpl-warranty", "gpl-see", "gpl-copy")),
    ("AGPL-3.0", ("agpl-redistribute", "either-3", "gpl-warranty", "gpl-see")),
    ("AGPL-3.0", ("agpl-redistribute",)),
    ("LGPL", ("lgpl-redistribute", "either-3", "gpl-warranty", "gpl-see", "gpl-copy")),
    ("LGPL", ("lgpl-redistribute", "either-2", "gpl-warranty", "gpl-see", "gpl-copy")),
    ("LGPL", ("lgpl-redistribute",)),
    ("GPL-3.0", ("gpl-redistribute", "either-3", "gpl-warranty", "gpl-see", "gpl-copy")),
    ("GPL-3.0", ("gpl-redistribute", "either-3", "gpl-warranty", "gpl-see")),
    ("GPL-3.0", ("gpl-redistribute", "either-3")),
    ("GPL-2.0", ("gpl-redistribute", "either-2", "gpl-warranty", "gpl-see", "gpl-copy")),
    ("GPL-2.0", ("gpl-redistribute", "either-2", "gpl-warranty", "gpl-see")),
    ("GPL-2.0", ("gpl-redistribute", "either-2")),
    ("GPL-3.0", ("gpl-3-title", "verbatim")),
    ("GPL-2.0", ("gpl-2-title", "verbatim")),
    ("GPL-3.0", ("gpl-3",)),
    ("GPL-2.0", ("gpl-2",)),
    ("GPL", ("gpl-redistribute", "gpl-warranty")),
    ("GPL", ("gpl-redistribute",)),
    ("AGPL-3.0", ("agpl-3",)),
    ("LGPL", ("lgpl",)),
    ("MPL-2.0", ("mpl-2", "mpl-copy")),
    ("MPL-2.0", ("mpl-2",)),
    ("EPL", ("epl",)),
    ("CDDL", ("cddl",)),
    ("OFL", ("ofl",)),
    ("Artistic-2.0", ("verbatim", "artistic-2")),
    ("Artistic-2.0", ("artistic-2",)),
    ("CC-BY-NC", ("cc-by-nc",)),
    ("CC-BY-SA", ("cc-by-sa",)),
    ("CC-BY-ND", ("cc-by-nd",)),
    ("CC-BY", ("cc-by",)),
    ("CC-BY-NC", ("cc-by-nc-url",)),
    ("CC-BY-SA", ("cc-by-sa-url",)),
    ("CC-BY-ND", ("cc-by-nd-url",)),
    ("CC-BY", ("cc-by-url",)),
    ("CC0", ("cc0-waive",)),
    ("CC0", ("cc0",)),
    ("CC0", ("cc0-url",)),
    *((licence, (f"spdx-{name}",)) for name, licence in SPDX.items()),
    ("Public-Domain", ("public-domain",)),
    ("All-Rights-Reserved", ("copyright", "all-rights")),
    ("All-Rights-Reserved", ("all-rights",)),
)

#: Every known sentence holds one of these words; a text without any is not cut.
HINT = "|".join(sorted({word.replace(".", "[.]") if word != "cc" else r"\bcc\b" for _, word, _ in SENTENCES} | {r"[(]c[)]", "©"}))

#: What is replaced before sentences are cut (in lower case), and by what; the second form is for groups.
PREPARE = (
    (r"[(]c[)]|©", " copyright ", " copyright "),
    (r"spdx-license-identifier[ \t]*:", "spdx-license-identifier ", "spdx-license-identifier "),
    (r"(?m)^[ \t]*(?:[/#*;%|!]+|--+|<!--|rem )[ \t]*", "", ""),  # comment marks
    (r"\b(v|ver|no)[.] ?([0-9])", "$1 $2", r"\1 \2"),
)
#: A sentence ends at marks before white space, at an empty line, and before a list item. Other line breaks are white space.
SENTENCE_END = r"[.!?;:]+(?:[ \t\r\n]+|$)|\n[ \t\r]*\n|\n[ \t]*(?:[-+•]|[0-9]{1,2}[.)]|[(][0-9a-z]{1,2}[)])[ \t]"
#: What words are made of; the rest becomes one space. Marks at a word's end go.
NO_WORD, WORD_END = "[^a-z0-9.+-]+", "[.-]+( |$)"


def _whole(pattern: str) -> str:
    return f"(?:^| )(?:{pattern})(?: |$)" if not pattern.endswith("$") else f"(?:^| )(?:{pattern})"


def sentences(text: Column) -> Column:
    """Normalised sentences that hold a hint."""
    text = F.lower(text)
    for pattern, by, _ in PREPARE:
        text = F.regexp_replace(text, pattern, by)
    words = F.transform(F.split(text, SENTENCE_END), lambda s: F.trim(F.regexp_replace(F.regexp_replace(F.when(s.rlike(HINT), s).otherwise(""), NO_WORD, " "), WORD_END, "$1")))
    return F.filter(words, lambda s: s != "")


def identifiers(sentence: Column) -> Column:
    """The identifiers of the known sentences that a sentence holds, in the order of their places."""

    def place(word: str, pattern: str) -> Column:
        found = F.regexp_extract(sentence, _whole(pattern), 0)
        return F.when(F.contains(sentence, F.lit(word)) & (found != ""), F.instr(sentence, found))

    found = F.array(*(F.struct(place(word, pattern).alias("at"), F.lit(k).alias("k"), F.lit(name).alias("name")) for k, (name, word, pattern) in enumerate(SENTENCES)))
    return F.transform(F.array_sort(F.filter(found, lambda x: x["at"].isNotNull())), lambda x: x["name"])


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id, sentence_ids, licences, n_unmatched`` for every row of ``docs`` (``doc_id, text``).

    ``sentence_ids`` holds the identifiers in order and ``licences`` the licences found, in rule order, each joined by commas.
    """
    rows = pick(docs, doc_id="doc_id", text="text")
    # Most texts hold no hint at all; only the others are cut into sentences.
    hinted = F.when(F.lower("text").rlike(HINT), F.col("text"))
    rows = rows.select("doc_id", F.coalesce(sentences(hinted), F.array().cast("array<string>")).alias("said"))
    ids = F.flatten(F.transform("said", identifiers))
    rows = rows.select("doc_id", ids.alias("ids")).withColumn("sentence_ids", F.array_join("ids", ","))
    rows = rows.withColumn("left", F.concat(F.lit("|"), F.array_join("ids", "||"), F.lit("|")))
    taken = [(licence, "".join(f"|{i}|" for i in run)) for licence, run in RULES]
    # One struct for each rule: what is left, and what is found so far.
    state = F.struct(F.col("left").alias("left"), F.lit("").alias("found"))
    rules = F.array(*(F.struct(F.lit(licence).alias("licence"), F.lit(run).alias("run")) for licence, run in taken))

    def apply(state: Column, rule: Column) -> Column:
        hit = F.contains(state["left"], rule["run"])
        found = F.when(hit, F.concat(state["found"], F.lit(","), rule["licence"])).otherwise(state["found"])
        return F.struct(F.replace(state["left"], rule["run"], F.lit("~")).alias("left"), found.alias("found"))

    done = F.aggregate(rules, state, apply)
    rows = rows.withColumn("done", F.when(F.size("ids") > 0, done))
    licences = F.array_join(F.array_distinct(F.filter(F.split("done.found", ","), lambda x: x != "")), ",")
    unmatched = F.size(F.filter(F.split(F.col("done.left"), r"\|"), lambda x: (F.trim(F.translate(x, "~", " ")) != "")))
    return rows.select("doc_id", "sentence_ids", F.coalesce(licences, F.lit("")).alias("licences"), F.when(F.size("ids") > 0, unmatched).otherwise(0).cast("long").alias("n_unmatched"))


def oracle_sql() -> str:
    """The same scan in DuckDB SQL, for ``documents``."""

    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    prepared = "lower(coalesce(text, ''))"
    for pattern, _, by in PREPARE:
        prepared = f"regexp_replace({prepared}, {quoted(pattern)}, {quoted(by)}, 'g')"
    normal = f"trim(regexp_replace(regexp_replace(CASE WHEN regexp_matches(s, {quoted(HINT)}) THEN s ELSE '' END, '{NO_WORD}', ' ', 'g'), '{WORD_END}', '\\1', 'g'))"
    known = ", ".join(f"({k}, {quoted(n)}, {quoted(w)}, {quoted(_whole(p))})" for k, (n, w, p) in enumerate(SENTENCES))
    steps, last = "", "r0"
    for k, (licence, run) in enumerate(RULES, 1):
        joined = "".join(f"|{i}|" for i in run)
        steps += f", r{k} AS (SELECT doc_id, ids, replace(l, '{joined}', '~') AS l, CASE WHEN contains(l, '{joined}') AND NOT list_contains(found, '{licence}') THEN list_append(found, '{licence}') ELSE found END AS found FROM {last})"
        last = f"r{k}"
    return f"""
    WITH known(k, name, word, pattern) AS (VALUES {known}),
    docs AS (SELECT row_number() OVER () AS row, doc_id, text FROM documents),
    cut AS (SELECT row, unnest(list_transform(string_split_regex({prepared}, {quoted(SENTENCE_END)}), lambda s: {normal})) AS s, generate_subscripts(string_split_regex({prepared}, {quoted(SENTENCE_END)}), 1) AS i
        FROM docs WHERE regexp_matches(lower(text), {quoted(HINT)})),
    hits AS (SELECT row, i, k, name, strpos(s, regexp_extract(s, pattern)) AS place FROM cut JOIN known ON contains(s, word) WHERE s <> '' AND regexp_matches(s, pattern)),
    named AS (SELECT row, list(name ORDER BY i, place, k) AS ids FROM hits GROUP BY row),
    r0 AS (SELECT doc_id, coalesce(ids, []) AS ids, '|' || array_to_string(coalesce(ids, []), '||') || '|' AS l, []::VARCHAR[] AS found FROM docs LEFT JOIN named USING (row)){steps}
    SELECT doc_id, array_to_string(ids, ',') AS sentence_ids, array_to_string(found, ',') AS licences,
        CASE WHEN len(ids) = 0 THEN 0 ELSE len(list_filter(string_split(l, '|'), lambda x: trim(replace(x, '~', ' ')) <> '')) END AS n_unmatched FROM {last}"""
