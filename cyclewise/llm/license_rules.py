"""Licence recognition by sentence rules.

Texts are cut into sentences. Sentences without a licence word are put aside; the
others are normalised and mapped to identifiers of known licence sentences, ``?`` for
those nobody knows. Titles and addresses are stepped over, and copyright lines that lead a
notice belong to it. Ordered rules, longer ones first, then rewrite runs of
identifiers into licence names. Everything is a column expression over one row, so the
scan needs no shuffle and no text leaves its task.

Defined results: a null or empty text has no sentences (``NONE``); repeated rows and
ties give repeated equal rows; an empty table gives an empty table; other columns are
kept, and columns named like an output column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A sentence is looked up only if it holds one of these.
LICENCE_WORDS = (
    r"licen[cs]|copyright|copyleft|warrant|redistribut|permission|public domain|"
    r"liable|as is|without modification|advertising material|endorse|all rights reserved|copy of the mpl"
)

# Wording of public licences, lower case, without commas and quotes.
# The first pattern found in a sentence names it.
SENTENCES: list[tuple[str, str]] = [
    ("spdxApache2", r"spdx-license-identifier: apache-2\.0"),
    ("spdxMit", r"spdx-license-identifier: mit"),
    ("spdxBsd3", r"spdx-license-identifier: bsd-3-clause"),
    ("spdxBsd2", r"spdx-license-identifier: bsd-2-clause"),
    ("spdxGpl2", r"spdx-license-identifier: gpl-2\.0"),
    ("spdxGpl3", r"spdx-license-identifier: gpl-3\.0"),
    ("spdxMpl2", r"spdx-license-identifier: mpl-2\.0"),
    ("apache2", r"licen[cs]ed under the apache licen[cs]e version 2\.0"),
    ("apacheUse", r"you may not use this file except in compliance with the licen[cs]e"),
    ("apacheCopy", r"you may obtain a copy of the licen[cs]e at"),
    ("apacheBasis", r"unless required by applicable law or agreed to in writing"),
    ("apacheSee", r"see the licen[cs]e for the specific language governing permissions"),
    ("mitGrant", r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("mitNotice", r"the above copyright notice and this permission notice shall be included"),
    ("mitAsIs", r"the software is provided as is without warranty of any kind"),
    ("mitLiable", r"in no event shall the authors or copyright holders be liable"),
    ("mitName", r"(released|licen[cs]ed|distributed|available) under (the terms of )?the mit licen[cs]e"),
    ("iscGrant", r"permission to use copy modify and/or distribute this software for any purpose"),
    ("iscAsIs", r"the software is provided as is and the author disclaims all warranties"),
    ("iscLiable", r"in no event shall the author be liable for any special"),
    ("bsdGrant", r"redistribution and use in source and binary forms with or without modification"),
    ("bsdSource", r"redistributions of source code must retain the above copyright notice"),
    ("bsdBinary", r"redistributions in binary form must reproduce the above copyright notice"),
    ("bsdAdvert", r"all advertising materials mentioning features or use of this software"),
    ("bsdEndorse", r"neither the name of .* may be used to endorse or promote products"),
    ("bsdAsIs", r"this software is provided by .* as is"),
    ("bsdLiable", r"in no event shall .* be liable for any direct indirect incidental"),
    ("agpl3Later", r"gnu affero general public licen[cs]e .*version 3 .*any later version"),
    ("agpl3", r"gnu affero general public licen[cs]e version 3"),
    ("lgpl21Later", r"gnu lesser general public licen[cs]e .*version 2\.1 .*any later version"),
    ("lgpl3Later", r"gnu lesser general public licen[cs]e .*version 3 .*any later version"),
    ("lgpl21", r"gnu lesser general public licen[cs]e version 2\.1"),
    ("lgpl3", r"gnu lesser general public licen[cs]e version 3"),
    ("gpl2Later", r"gnu general public licen[cs]e .*version 2 .*any later version"),
    ("gpl3Later", r"gnu general public licen[cs]e .*version 3 .*any later version"),
    ("gplHope", r"this (program|library|software|file) is distributed in the hope that it will be useful"),
    ("gplMore", r"see the gnu (lesser |affero )?general public licen[cs]e for more details"),
    ("gplCopy", r"you should have received a copy of the gnu (lesser |affero )?general public licen[cs]e"),
    ("gpl2", r"gnu general public licen[cs]e version 2"),
    ("gpl3", r"gnu general public licen[cs]e version 3"),
    ("mpl2", r"subject to the terms of the mozilla public licen[cs]e v\.? ?2\.0"),
    ("mplCopy", r"if a copy of the mpl was not distributed with this file"),
    ("ccByNcSa4", r"under (a )?(cc|creative commons) by-nc-sa 4\.0"),
    ("ccByNcNd4", r"under (a )?(cc|creative commons) by-nc-nd 4\.0"),
    ("ccByNc4", r"under (a )?(cc|creative commons) by-nc 4\.0"),
    ("ccBySa4", r"under (a )?(cc|creative commons) by-sa 4\.0"),
    ("ccBySa3", r"under (a )?(cc|creative commons) by-sa 3\.0"),
    ("ccBy4", r"under (a )?(cc|creative commons) by 4\.0"),
    ("cc0", r"cc0 1\.0|creative commons zero"),
    ("unlicense", r"free and unencumbered software released into the public domain"),
    ("publicDomain", r"(released|placed|dedicated|is) (in|into|to) the public domain"),
    ("url", r"^(https?://)?[a-z0-9.-]+(/[a-z0-9._~+-]*)+$"),
    ("title", r"^(the )?(mit|isc|apache|mozilla public|bsd [234]-clause|gnu [a-z ]+) licen[cs]e( \(mit\))?( version [0-9.]+)?$"),
    ("reserved", r"all rights reserved"),
    ("copyrightLine", r"^copyright|^\(c\)|copyright (c )?[0-9]{4}"),
]

# Licence names in SPDX spelling and the sentences that make them up, in
# the order in which rules are tried.
RULES: list[tuple[str, list[str]]] = [
    ("Apache-2.0", ["apache2", "apacheUse", "apacheCopy", "apacheBasis", "apacheSee"]),
    ("Apache-2.0", ["apache2", "apacheCopy", "apacheBasis", "apacheSee"]),
    ("Apache-2.0", ["apache2", "apacheUse", "apacheCopy"]),
    ("Apache-2.0", ["apache2", "apacheCopy"]),
    ("Apache-2.0", ["apache2", "apacheUse"]),
    ("MIT", ["mitGrant", "mitNotice", "mitAsIs", "mitLiable"]),
    ("MIT", ["mitGrant", "mitNotice", "mitAsIs"]),
    ("MIT", ["mitGrant", "mitNotice"]),
    ("BSD-4-Clause", ["bsdGrant", "bsdSource", "bsdBinary", "bsdAdvert", "bsdEndorse", "bsdAsIs", "bsdLiable"]),
    ("BSD-3-Clause", ["bsdGrant", "bsdSource", "bsdBinary", "bsdEndorse", "bsdAsIs", "bsdLiable"]),
    ("BSD-3-Clause", ["bsdGrant", "bsdSource", "bsdBinary", "bsdEndorse"]),
    ("BSD-2-Clause", ["bsdGrant", "bsdSource", "bsdBinary", "bsdAsIs", "bsdLiable"]),
    ("BSD-2-Clause", ["bsdGrant", "bsdSource", "bsdBinary"]),
    ("ISC", ["iscGrant", "iscAsIs", "iscLiable"]),
    ("ISC", ["iscGrant", "mitAsIs"]),
    ("ISC", ["iscGrant"]),
    *[
        (name, [first, *rest])
        for rest in (["gplHope", "gplMore", "gplCopy"], ["gplHope", "gplMore"], ["gplHope"], [])
        for name, first in (
            ("GPL-2.0-or-later", "gpl2Later"),
            ("GPL-3.0-or-later", "gpl3Later"),
            ("AGPL-3.0-or-later", "agpl3Later"),
            ("LGPL-2.1-or-later", "lgpl21Later"),
            ("LGPL-3.0-or-later", "lgpl3Later"),
        )
    ],
    ("AGPL-3.0-only", ["agpl3"]),
    ("LGPL-2.1-only", ["lgpl21"]),
    ("LGPL-3.0-only", ["lgpl3"]),
    ("GPL-2.0-only", ["gpl2"]),
    ("GPL-3.0-only", ["gpl3"]),
    ("MPL-2.0", ["mpl2", "mplCopy"]),
    ("MPL-2.0", ["mpl2"]),
    ("Apache-2.0", ["apache2"]),
    ("MIT", ["mitName"]),
    ("Apache-2.0", ["spdxApache2"]),
    ("MIT", ["spdxMit"]),
    ("BSD-3-Clause", ["spdxBsd3"]),
    ("BSD-2-Clause", ["spdxBsd2"]),
    ("GPL-2.0-only", ["spdxGpl2"]),
    ("GPL-3.0-only", ["spdxGpl3"]),
    ("MPL-2.0", ["spdxMpl2"]),
    ("CC-BY-NC-SA-4.0", ["ccByNcSa4"]),
    ("CC-BY-NC-ND-4.0", ["ccByNcNd4"]),
    ("CC-BY-NC-4.0", ["ccByNc4"]),
    ("CC-BY-SA-4.0", ["ccBySa4"]),
    ("CC-BY-SA-3.0", ["ccBySa3"]),
    ("CC-BY-4.0", ["ccBy4"]),
    ("CC0-1.0", ["cc0"]),
    ("Unlicense", ["unlicense"]),
    ("Public-Domain", ["publicDomain"]),
    ("Proprietary", ["copyrightLine", "reserved"]),
    ("Proprietary", ["reserved"]),
]

COMMENT_LEAD = r"(?m)^[ \t]*(//+|/\*+|\*+/?|#+|;+|--+)[ \t]*"
WRAPPED_LINE = r"([^.!?:\n])[ \t]*\n[ \t]*([^ \t\n])"
VERSION_SIGN = r"\bv\. +([0-9])"
SENTENCE_END = r"([.!?])[ \t\n]+"
NOISE = r"[^\p{L}\p{N}.()+/:-]+"
EDGES = r"^[ .:]+|[ .:]+$"
NAMES = r"\{([^}]*)\}"
#: Sentences that say nothing of their own are stepped over by the rules.
FILLERS = ["url", "title"]
#: Copyright lines that lead a notice belong to it.
LEADING = r"(?:<copyrightLine>|<reserved>)+(<(?:mitGrant|iscGrant|bsdGrant|apache2|a?gpl[23]Later|lgpl(?:21|3)Later|mpl2)>)"


def sentences(text: Column) -> Column:
    """Normalised sentences that hold a licence word, in text order."""
    cut = F.regexp_replace(F.lower(text), COMMENT_LEAD, "")
    cut = F.regexp_replace(cut, WRAPPED_LINE, "$1 $2")
    cut = F.regexp_replace(cut, VERSION_SIGN, "v$1")
    cut = F.regexp_replace(cut, SENTENCE_END, "$1\n")
    found = F.filter(F.split(cut, "\n"), lambda s: s.rlike(LICENCE_WORDS))
    return F.transform(
        found, lambda s: F.regexp_replace(F.regexp_replace(s, NOISE, " "), EDGES, "")
    )


def sentence_id(sentence: Column) -> Column:
    first, *others = SENTENCES
    case = F.when(sentence.rlike(first[1]), first[0])
    for name, pattern in others:
        case = case.when(sentence.rlike(pattern), name)
    return case.otherwise("?")


def apply_rules(ids: Column) -> Column:
    """Rewrite ``<id><id>`` runs into ``{licence}``, rule after rule; fillers and leading lines go first."""
    for name in FILLERS:
        ids = F.replace(ids, F.lit(f"<{name}>"), F.lit(""))
    ids = F.regexp_replace(ids, LEADING, "$1")
    for licence, parts in RULES:
        ids = F.replace(ids, F.lit("".join(f"<{p}>" for p in parts)), F.lit(f"{{{licence}}}"))
    return ids


def scan_licenses(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``sentence_ids``, ``licenses`` and ``unmatched`` to every row.

    ``sentence_ids`` lists the identifiers in order, ``licenses`` the distinct licence
    names joined by ``|`` (``UNKNOWN``: licence sentences but no rule, ``NONE``: no such
    sentence), ``unmatched`` counts sentences that no rule used.
    """
    empty = F.array().cast("array<string>")
    found = F.when(
        F.lower(F.col(text)).rlike(LICENCE_WORDS), F.transform(sentences(F.col(text)), sentence_id)
    ).otherwise(empty)
    marked = F.when(
        F.size("sentence_ids") > 0,
        apply_rules(F.concat_ws("", F.transform("sentence_ids", lambda s: F.concat(F.lit("<"), s, F.lit(">"))))),
    ).otherwise("")
    names = F.array_sort(F.array_distinct(F.regexp_extract_all("unmatched", F.lit(NAMES), 1)))
    out = docs.withColumn("sentence_ids", found).withColumn("unmatched", marked)
    out = out.withColumn(
        "licenses",
        F.when(F.size("sentence_ids") == 0, "NONE")
        .when(F.size(names) == 0, "UNKNOWN")
        .otherwise(F.concat_ws("|", names)),
    )
    return out.withColumns(
        {
            "unmatched": F.length("unmatched") - F.length(F.replace("unmatched", F.lit("<"), F.lit(""))),
            "sentence_ids": F.concat_ws(" ", "sentence_ids"),
        }
    )


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def license_sql() -> str:
    """The same scan over ``documents`` for DuckDB."""
    cases = " ".join(f"WHEN regexp_matches(s, {_quoted(p)}) THEN {_quoted(n)}" for n, p in SENTENCES)
    marked = "array_to_string(list_transform(ids, lambda s: '<' || s || '>'), '')"
    for name in FILLERS:
        marked = f"replace({marked}, '<{name}>', '')"
    marked = f"regexp_replace({marked}, {_quoted(LEADING)}, '\\1', 'g')"
    for licence, parts in RULES:
        marked = f"replace({marked}, {_quoted(''.join(f'<{p}>' for p in parts))}, {_quoted('{' + licence + '}')})"
    return f"""
WITH cut AS (
  SELECT doc_id, list_transform(list_filter(string_split(
           regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(text), {_quoted(COMMENT_LEAD)}, '', 'g'),
             {_quoted(WRAPPED_LINE)}, '\\1 \\2', 'g'), {_quoted(VERSION_SIGN)}, 'v\\1', 'g'),
             {_quoted(SENTENCE_END)}, '\\1' || chr(10), 'g'), chr(10)),
           lambda s: regexp_matches(s, {_quoted(LICENCE_WORDS)})),
           lambda s: regexp_replace(regexp_replace(s, {_quoted(NOISE)}, ' ', 'g'), {_quoted(EDGES)}, '', 'g')) AS found
  FROM documents),
named AS (
  SELECT doc_id, coalesce(list_transform(found, lambda s: CASE {cases} ELSE '?' END), []) AS ids
  FROM cut),
ruled AS (SELECT doc_id, ids, {marked} AS marked FROM named),
licensed AS (
  SELECT *, list_sort(list_distinct(regexp_extract_all(marked, {_quoted(NAMES)}, 1))) AS names FROM ruled)
SELECT doc_id, array_to_string(ids, ' ') AS sentence_ids,
       CASE WHEN len(ids) = 0 THEN 'NONE' WHEN len(names) = 0 THEN 'UNKNOWN'
            ELSE array_to_string(names, '|') END AS licenses,
       CAST(length(marked) - length(replace(marked, '<', '')) AS INTEGER) AS unmatched
FROM licensed
"""
