"""Licence recognition by sentence rules, with DataFrame functions alone.

A text is cut into sentences (at punctuation followed by white space and at blank lines, so wrapped lines hold
together; a line without a letter or digit, as in comments, is blank, whatever its line end). Sentences with a licence
word are normalised: lower case, only words of a-z and 0-9. All known phrases of a sentence give their identifiers, in
the order of their places; where phrases overlap the longest wins. The identifiers of a text, in order, are matched
against the ordered licence rules. A rule that matches takes its identifiers away, so a later, shorter rule can't use
them again.

Every step works on one row; nothing is shuffled, and the tables of phrases and rules are constants.

Defined cases: null and empty texts hold no licence; a licence stated twice is named once; rules are tried in order
and the licences come in the order of the rules; repeated rows are all returned; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Every phrase below has one of these, so other sentences need not be normalised.
TRIGGER = "(?i)licen[sc]|copyright|permission|warrant|redistribut|liable|public domain|endorse|advertising|cc0"
# Identifier, and normalised phrases that have it.
PHRASES = {
    "mit-notice": ["released under the mit license", "licensed under the mit license", "distributed under the mit license", "the mit license", "mit license"],
    "mit-grant": ["permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"],
    "mit-condition": ["the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"],
    "as-is": ["the software is provided as is without warranty of any kind"],
    "mit-liability": ["in no event shall the authors or copyright holders be liable for any claim"],
    "apache-2-notice": ["licensed under the apache license version 2 0", "released under the apache license version 2 0", "apache license version 2 0", "apache license 2 0"],
    "apache-2-comply": ["you may not use this file except in compliance with the license"],
    "apache-2-obtain": ["you may obtain a copy of the license at"],
    "apache-2-unless": ["software distributed under the license is distributed on an as is basis"],
    "apache-2-see": ["see the license for the specific language governing permissions and limitations under the license"],
    "bsd-use": ["redistribution and use in source and binary forms with or without modification are permitted"],
    "bsd-source": ["redistributions of source code must retain the above copyright notice"],
    "bsd-binary": ["redistributions in binary form must reproduce the above copyright notice"],
    "bsd-advertising": ["all advertising materials mentioning features or use of this software must display the following acknowledgement", "copyright holders acknowledgement in all advertising materials"],
    "bsd-endorse": ["may be used to endorse or promote products derived from this software without specific prior written permission"],
    "bsd-as-is": ["this software is provided by the copyright holders and contributors as is"],
    "bsd-liability": ["or contributors be liable for any direct indirect incidental special exemplary or consequential damages"],
    "bsd-2-notice": ["bsd 2 clause license", "bsd 2 clause licence", "license bsd 2 clause"],
    "bsd-3-notice": ["bsd 3 clause license", "bsd 3 clause licence", "license bsd 3 clause"],
    "isc-grant": ["permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted"],
    "isc-notice": ["the isc license", "isc license"],
    "mpl-2-notice": ["is subject to the terms of the mozilla public license v", "mozilla public license version 2 0", "mozilla public license 2 0", "licensed under the mpl 2 0"],
    "epl-1-notice": ["eclipse public license v1 0", "eclipse public license version 1 0", "eclipse public license 1 0"],
    "epl-2-notice": ["eclipse public license v2 0", "eclipse public license v 2 0", "eclipse public license version 2 0", "eclipse public license 2 0"],
    "bsl-1-notice": ["boost software license version 1 0", "boost software license 1 0"],
    "ofl-1.1-notice": ["sil open font license version 1 1", "sil open font license 1 1"],
    "artistic-2-notice": ["the artistic license 2 0", "artistic license version 2 0"],
    "cddl-1-notice": ["common development and distribution license cddl version 1 0", "common development and distribution license version 1 0"],
    "eupl-1.2-notice": ["european union public licence v 1 2", "european union public licence version 1 2", "eupl v 1 2 licence"],
    "psf-2-notice": ["python software foundation license version 2", "psf license agreement"],
    "wtfpl-notice": ["do what the fuck you want to public license"],
    "unlicense": ["this is free and unencumbered software released into the public domain"],
    "cc0": ["dedicated to the public domain under cc0", "cc0 1 0 universal public domain dedication"],
    "zlib-altered": ["permission is granted to anyone to use this software for any purpose including commercial applications"],
    "all-rights": ["copyright all rights reserved"],
}
# Families of licences whose phrases differ by name and version.
GNU = {"GPL": ("gnu general public license", ["1", "2", "3"]), "LGPL": ("gnu lesser general public license", ["2 1", "3"]), "AGPL": ("gnu affero general public license", ["3"])}
CC_KINDS = ["by", "by sa", "by nc", "by nd", "by nc sa", "by nc nd"]
CC_NAMES = {"by": "attribution", "sa": "sharealike", "nc": "noncommercial", "nd": "noderivatives"}
CC_VERSIONS = ["1 0", "2 0", "2 5", "3 0", "4 0"]
SPDX = ["MIT", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "ISC", "MPL-2.0", "Unlicense", "CC0-1.0", "Zlib", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "AGPL-3.0-only", "AGPL-3.0-or-later"]
# Licence, and the identifiers that state it in order. Earlier rules go first.
RULES = [
    ("MIT", ["mit-grant", "mit-condition", "as-is", "mit-liability"]), ("MIT", ["mit-grant", "mit-condition", "as-is"]), ("MIT", ["mit-grant", "mit-condition"]),
    ("BSD-4-Clause", ["bsd-use", "bsd-source", "bsd-binary", "bsd-advertising", "bsd-endorse"]), ("BSD-3-Clause", ["bsd-use", "bsd-source", "bsd-binary", "bsd-endorse"]), ("BSD-2-Clause", ["bsd-use", "bsd-source", "bsd-binary"]),
    ("Apache-2.0", ["apache-2-notice", "apache-2-comply", "apache-2-obtain", "apache-2-unless", "apache-2-see"]), ("Apache-2.0", ["apache-2-notice", "apache-2-comply"]), ("Apache-2.0", ["apache-2-notice"]),
    ("ISC", ["isc-grant"]), ("ISC", ["isc-notice"]), ("MIT", ["mit-notice"]), ("BSD-2-Clause", ["bsd-2-notice"]), ("BSD-3-Clause", ["bsd-3-notice"]), ("MPL-2.0", ["mpl-2-notice"]), ("Unlicense", ["unlicense"]),
    ("EPL-1.0", ["epl-1-notice"]), ("EPL-2.0", ["epl-2-notice"]), ("BSL-1.0", ["bsl-1-notice"]), ("OFL-1.1", ["ofl-1.1-notice"]), ("Artistic-2.0", ["artistic-2-notice"]), ("CDDL-1.0", ["cddl-1-notice"]),
    ("EUPL-1.2", ["eupl-1.2-notice"]), ("Python-2.0", ["psf-2-notice"]), ("WTFPL", ["wtfpl-notice"]),
    ("CC0-1.0", ["cc0"]), ("Zlib", ["zlib-altered"]), ("LicenseRef-all-rights-reserved", ["all-rights"]),
]


def catalogue() -> tuple[list[tuple[str, str]], list[tuple[str, list[str]]]]:
    """All ``(phrase, identifier)``, longest first, and all rules in order."""
    phrases = [(p, i) for i, own in PHRASES.items() for p in own]
    rules = list(RULES)
    for short, (name, versions) in GNU.items():
        for v in versions:
            only, later = f"{short.lower()}-{v.replace(' ', '.')}-notice", f"{short.lower()}-{v.replace(' ', '.')}-later"
            code = v.replace(" ", ".") if " " in v else f"{v}.0"
            published = f"under the terms of the {name} as published by the free software foundation either version {v} of the license"
            phrases += [(f"{name} version {v}", only), (f"{name} v{v}", only), (f"{short.lower()} v{v} license", only), (f"{name} version {v} or later", later), (f"{published} or at your option any later version", later), (f"{name} version {v} or at your option any later version", later)]
            rules += [(f"{short}-{code}-or-later", [later]), (f"{short}-{code}-only", [only])]
    for kind in CC_KINDS:
        for v in CC_VERSIONS:
            spdx = f"CC-{kind.upper().replace(' ', '-')}-{v.replace(' ', '.')}"
            long = " ".join(CC_NAMES[k] for k in kind.split())
            phrases += [(f"licensed under cc {kind} {v}", spdx.lower()), (f"licensed under a creative commons {long} {v} international license", spdx.lower()), (f"creative commons {long} {v} license", spdx.lower())]
            rules.append((spdx, [spdx.lower()]))
    for spdx in SPDX:
        words = "".join(c if c.isalnum() else " " for c in spdx.lower())
        phrases.append((f"spdx license identifier {words}", f"spdx-{spdx.lower()}"))
        rules.append((spdx, [f"spdx-{spdx.lower()}"]))
    return sorted(phrases, key=lambda p: (-len(p[0]), p[0])), rules


def sentences(text: Column) -> Column:
    return F.split(F.regexp_replace(text, r"([.!?;])[ \t\r\n]+|(?:\r\n?+|\n)[^\p{L}\p{N}\r\n]*[\r\n][^\p{L}\p{N}]*", "$1\n\n"), "\n\n")


def normal(sentence: Column) -> Column:
    """Two spaces between words and one at either end, so that phrases are found as whole words and neighbouring ones
    share no space."""
    return F.regexp_replace(F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(sentence), "[^a-z0-9]+", " ")), F.lit(" ")), "(?<=[^ ]) (?=[^ ])", "  ")


def identifiers(text: Column) -> Column:
    """For each of a text's known licence sentences, in order, its identifiers, in order."""
    known = F.array(*(F.struct(F.lit(f" {p.replace(' ', '  ')} ").alias("phrase"), F.lit(f" <{i}> ").alias("mark")) for p, i in catalogue()[0]))
    candidates = F.filter(sentences(text), lambda s: s.rlike(TRIGGER))
    ids = F.transform(candidates, lambda s: _identifiers(normal(s), known))
    return F.filter(ids, lambda i: F.size(i) > 0)


def _identifiers(sentence: Column, known: Column) -> Column:
    # The sentence stands in an array of one, so that it is normalised once and not for each phrase. Phrases are
    # replaced by their marks, the longest first, so that the marks stand in the order of their places.
    def marked(s: Column) -> Column:
        return F.aggregate(F.filter(known, lambda k: F.contains(s, k["phrase"])), s, lambda rest, k: F.replace(rest, k["phrase"], k["mark"]))

    return F.flatten(F.transform(F.array(sentence), lambda s: F.regexp_extract_all(marked(s), F.lit("<([^>]+)>"), F.lit(1))))


def licences(ids: Column) -> Column:
    """Licences that the ordered rules find in a sequence of identifiers, each once."""
    start = F.struct(F.concat(F.lit(" "), F.array_join(F.transform(ids, lambda i: F.concat(F.lit("<"), i, F.lit(">"))), " "), F.lit(" ")).alias("rest"), F.array().cast("array<string>").alias("found"))
    rules = F.array(*(F.struct(F.lit(name).alias("name"), F.lit(" ".join(f"<{i}>" for i in seq)).alias("seq")) for name, seq in catalogue()[1]))

    def apply(state: Column, rule: Column) -> Column:
        hit = F.contains(state["rest"], rule["seq"])
        return F.struct(F.when(hit, F.replace(state["rest"], rule["seq"], F.lit("|"))).otherwise(state["rest"]).alias("rest"), F.when(hit, F.array_union(state["found"], F.array(rule["name"]))).otherwise(state["found"]).alias("found"))

    return F.aggregate(rules, start, apply, lambda state: state["found"])


def scan(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows that state a licence, with ``licence_sentences`` (their number), ``licence_ids`` and ``licences``."""
    likely = docs.where(F.col(text_col).rlike(TRIGGER))
    told = likely.withColumn("licence_ids", identifiers(F.col(text_col))).where(F.size("licence_ids") > 0)
    found = told.withColumn("licence_sentences", F.size("licence_ids")).withColumn("licence_ids", F.flatten("licence_ids"))
    return found.withColumn("licences", licences(F.col("licence_ids"))).where(F.size("licences") > 0)


def oracle(table: str = "documents") -> str:
    """The same in DuckDB's SQL, for texts whose sentences hold one known phrase each."""
    phrases, rules = catalogue()
    known = ", ".join(f"({k}, ' {p} ', '{i}')" for k, (p, i) in enumerate(phrases))
    steps, rest = [], "seq"
    for k, (_, seq) in enumerate(rules):
        text = " ".join(f"<{i}>" for i in seq)
        steps.append(f"contains({rest}, '{text}') AS h{k}, replace({rest}, '{text}', '|') AS r{k}")
        rest = f"r{k}"
    found = ", ".join(f"CASE WHEN h{k} THEN '{name}' END" for k, (name, _) in enumerate(rules))
    return f"""WITH known(rank, phrase, id) AS (VALUES {known}),
    s AS (SELECT doc_id, unnest(list) AS s, generate_subscripts(list, 1) AS pos FROM (SELECT doc_id, string_split(regexp_replace(text, '([.!?;])[ \\t\\r\\n]+|\\n[ \\t]*\\n[ \\t\\r\\n]*', '\\1' || chr(10) || chr(10), 'g'), chr(10) || chr(10)) AS list FROM {table})),
    n AS (SELECT doc_id, pos, regexp_replace(' ' || lower(s) || ' ', '[^a-z0-9]+', ' ', 'g') AS s FROM s WHERE regexp_matches(s, '{TRIGGER}')),
    i AS (SELECT doc_id, pos, arg_min(id, rank) AS id FROM n JOIN known ON contains(n.s, known.phrase) GROUP BY doc_id, pos),
    q AS (SELECT doc_id, count(*) AS n_sentences, string_agg(id, ',' ORDER BY pos) AS sentence_ids, ' ' || string_agg('<' || id || '>', ' ' ORDER BY pos) || ' ' AS seq FROM i GROUP BY doc_id),
    f AS (SELECT doc_id, n_sentences, sentence_ids, {', '.join(steps)} FROM q),
    l AS (SELECT doc_id, n_sentences, sentence_ids, list_filter([{found}], lambda x: x IS NOT NULL) AS names FROM f)
    SELECT doc_id, n_sentences, sentence_ids, array_to_string(list_transform(list_filter(list_zip(names, range(len(names))), lambda z: list_position(names, z[1]) = z[2] + 1), lambda z: z[1]), ',') AS licences FROM l WHERE len(names) > 0"""
