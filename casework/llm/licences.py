"""Licences found by sentence and by rule.

A text is cut into sentences and each is normalised to lower-case words. Sentence
punctuation and blank lines cut; a single line break, a colon, a semicolon or a
stop before a digit cuts or is a space, so that a wrapped sentence is found as
well as a notice on a line of its own (comment marks are no words). Of several
known sentences from one place the longest counts. A known licence sentence has
an identifier; the identifiers of a text, in order and without the unknown
sentences, are its identifier sequence. A licence rule is a
sequence of identifiers and matches where it occurs without a gap. Rules are
ordered: of two rules for one place the earlier, more specific one counts.

Everything is a per-row expression: no join, no shuffle.

Defined results: null and empty texts have no sentences and no licence; repeated
rows get one result each; an empty table gives an empty table. Only the named
columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Normalised sentences of public licence notices and texts.
SENTENCES = {
    "released under the mit license": "mit-notice",
    "licensed under the mit license": "mit-notice",
    "this project is licensed under the mit license": "mit-notice",
    "the mit license mit": "mit-title",
    "mit license": "mit-title",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "mit-grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit-condition",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc-grant",
    "licensed under the isc license": "isc-notice",
    "licensed under the apache license version 2 0": "apache-2-notice",
    "licensed under the apache license version 2 0 the license": "apache-2-header",
    "you may not use this file except in compliance with the license": "apache-2-compliance",
    "you may obtain a copy of the license at": "apache-2-copy",
    "released under the apache license version 2 0": "apache-2-notice",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd-grant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsd-source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "bsd-binary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd-endorse",
    "licensed under the bsd 3 clause license": "bsd-3-notice",
    "licensed under the bsd 2 clause license": "bsd-2-notice",
    "this work is licensed under the gnu general public license version 3": "gpl-3-notice",
    "licensed under the gnu general public license version 3": "gpl-3-notice",
    "this work is licensed under the gnu general public license version 2": "gpl-2-notice",
    "licensed under the gnu general public license version 2": "gpl-2-notice",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "gpl-3-later",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "gpl-2-later",
    "licensed under the gnu lesser general public license version 3": "lgpl-3-notice",
    "licensed under the gnu affero general public license version 3": "agpl-3-notice",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl-2-notice",
    "licensed under the mozilla public license version 2 0": "mpl-2-notice",
    "licensed under cc by 4 0": "cc-by-notice",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by-notice",
    "licensed under cc by sa 4 0": "cc-by-sa-notice",
    "licensed under cc by nc 4 0": "cc-by-nc-notice",
    "licensed under cc by nd 4 0": "cc-by-nd-notice",
    "licensed under cc by nc sa 4 0": "cc-by-nc-sa-notice",
    "licensed under cc by nc nd 4 0": "cc-by-nc-nd-notice",
    "licensed under cc0 1 0": "cc0-notice",
    "this is free and unencumbered software released into the public domain": "unlicense-grant",
    "all rights reserved": "reserved",
}

# Licence, class and identifier sequence, the more specific first.
RULES = (
    ("MIT", "permissive", ("mit-title", "mit-grant", "mit-condition")),
    ("MIT", "permissive", ("mit-grant", "mit-condition")),
    ("BSD-3-Clause", "permissive", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-2-Clause", "permissive", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("Apache-2.0", "permissive", ("apache-2-header", "apache-2-compliance", "apache-2-copy")),
    ("Apache-2.0", "permissive", ("apache-2-header", "apache-2-compliance")),
    ("MIT", "permissive", ("mit-title",)),
    ("MIT", "permissive", ("mit-grant",)),
    ("MIT", "permissive", ("mit-notice",)),
    ("ISC", "permissive", ("isc-grant",)),
    ("ISC", "permissive", ("isc-notice",)),
    ("Apache-2.0", "permissive", ("apache-2-header",)),
    ("Apache-2.0", "permissive", ("apache-2-notice",)),
    ("BSD-3-Clause", "permissive", ("bsd-3-notice",)),
    ("BSD-2-Clause", "permissive", ("bsd-2-notice",)),
    ("AGPL-3.0", "copyleft", ("agpl-3-notice",)),
    ("LGPL-3.0", "copyleft", ("lgpl-3-notice",)),
    ("GPL-3.0-or-later", "copyleft", ("gpl-3-later",)),
    ("GPL-2.0-or-later", "copyleft", ("gpl-2-later",)),
    ("GPL-3.0", "copyleft", ("gpl-3-notice",)),
    ("GPL-2.0", "copyleft", ("gpl-2-notice",)),
    ("MPL-2.0", "copyleft", ("mpl-2-notice",)),
    ("CC-BY-NC-ND-4.0", "restricted", ("cc-by-nc-nd-notice",)),
    ("CC-BY-NC-SA-4.0", "restricted", ("cc-by-nc-sa-notice",)),
    ("CC-BY-NC-4.0", "restricted", ("cc-by-nc-notice",)),
    ("CC-BY-ND-4.0", "restricted", ("cc-by-nd-notice",)),
    ("CC-BY-SA-4.0", "copyleft", ("cc-by-sa-notice",)),
    ("CC-BY-4.0", "permissive", ("cc-by-notice",)),
    ("CC0-1.0", "permissive", ("cc0-notice",)),
    ("Unlicense", "permissive", ("unlicense-grant",)),
    ("All-rights-reserved", "restricted", ("reserved",)),
)

#: Sentences that open a grant; a reservation of rights directly before one belongs to it.
GRANTS = ("bsd-grant", "mit-grant", "isc-grant")
HEADED = tuple((n, c, ("reserved", *ids)) for n, c, ids in RULES if ids[0] in GRANTS)

#: Strictest first; a text has the class of its strictest licence.
CLASSES = ("restricted", "copyleft", "permissive")


def normalised_text(text: str) -> Column:
    """A text column as lower-case words; a bar is a cut and a line break a cut or a space."""
    out = F.coalesce(F.lower(F.col(text)), F.lit(""))
    for pattern, mark in (
        (r"\|", " "),
        (r"\r\n?", "\n"),
        # A line without words is blank.
        (r"\n[^a-z0-9\n]*(?=\n)", "|"),
        (r"[;:][ \t]+|\.[ \t]+(?=[0-9])", "\n"),
        (r"[.!?](?:[ \t]+|(?=\n))", "|"),
        (r"[^a-z0-9|\n]+", " "),
        (r" ?[|\n][ |\n]*\|[ |\n]*| ?\|[ |\n]*", "|"),
        (r" ?\n[ \n]*", "\n"),
    ):
        out = F.regexp_replace(out, pattern, mark)
    return F.trim(out)


def sentence_ids(text: str) -> Column:
    """Identifiers of the known sentences of a text column, in order."""
    known = F.create_map(*(F.lit(x) for pair in SENTENCES.items() for x in pair))
    longest = sorted(SENTENCES, key=lambda s: (-len(s), s))
    pattern = r"(?<![^|\n])(?:" + "|".join(s.replace(" ", r"[ \n]") for s in longest) + r")(?![^|\n])"
    found = F.regexp_extract_all(normalised_text(text), F.lit(pattern), F.lit(0))
    return F.transform(found, lambda s: F.element_at(known, F.translate(s, "\n", " ")))


def _sequence(ids: Column) -> Column:
    """The identifiers with a bar on both sides of each, so that a rule is a substring."""
    return F.concat(F.lit("|"), F.array_join(F.transform(ids, lambda i: F.concat(F.lit("|"), i, F.lit("|"))), ""), F.lit("|"))


def _rule_text(ids: tuple[str, ...]) -> str:
    return "".join(f"|{i}|" for i in ids)


def licences(docs: DataFrame, doc_id="doc_id", text="text") -> DataFrame:
    """One row per document: doc_id, sentence_ids, licences, licence_class."""
    ids = docs.select(F.col(doc_id).alias("doc_id"), sentence_ids(text).alias("_ids"))
    # Each rule takes its matches out of the sequence, so a later rule sees only the rest.
    rest, steps = F.col("_sequence"), ids.withColumn("_sequence", _sequence(F.col("_ids")))
    rules = F.array(
        *(
            F.struct(F.lit(n).alias("name"), F.lit(c).alias("class"), F.lit(_rule_text(s)).alias("text"))
            for n, c, s in HEADED + RULES
        )
    )
    start = F.struct(
        F.array().cast("array<struct<name:string,class:string>>").alias("found"), rest.alias("rest")
    )

    def apply(state: Column, rule: Column) -> Column:
        hit = F.contains(state["rest"], rule["text"])
        pair = F.struct(rule["name"].alias("name"), rule["class"].alias("class"))
        return F.struct(
            F.when(hit, F.concat(state["found"], F.array(pair))).otherwise(state["found"]).alias("found"),
            F.when(hit, F.replace(state["rest"], rule["text"], F.lit("|"))).otherwise(state["rest"]).alias("rest"),
        )

    matched = steps.withColumn(
        "_found",
        F.when(F.size("_ids") > 0, F.aggregate(rules, start, apply, lambda s: s["found"])).otherwise(
            F.array().cast("array<struct<name:string,class:string>>")
        ),
    )
    strictest = F.coalesce(
        *(F.when(F.array_contains(F.col("_found.class"), c), F.lit(c)) for c in CLASSES), F.lit("none")
    )
    return matched.select(
        "doc_id",
        F.array_join("_ids", " ").alias("sentence_ids"),
        F.array_join(F.array_sort(F.array_distinct(F.col("_found.name"))), " ").alias("licences"),
        strictest.alias("licence_class"),
    )


def _quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def licences_sql() -> str:
    """The same in DuckDB SQL, whose patterns look neither back nor ahead.

    Blank lines are told line by line, and cuts are doubled before sentences are looked
    for, so that one sentence's end and the next one's beginning each have a cut.
    """
    sentences = ", ".join(f"({_quoted(s)}, {_quoted(i)})" for s, i in SENTENCES.items())
    wrapped = "|".join(s.replace(" ", r"(?: |\n\n)") for s in sorted(SENTENCES, key=lambda s: (-len(s), s)))
    text = "plain"
    for pattern, mark in (
        (r"[;:][ \t]+", "chr(10)"),
        (r"\.[ \t]+([0-9])", r"chr(10) || '\1'"),
        (r"[.!?][ \t]+", "'|'"),
        (r"[.!?]\n", "'|' || chr(10)"),
        (r"[^a-z0-9|\n]+", "' '"),
        (r" ?[|\n][ |\n]*\|[ |\n]*| ?\|[ |\n]*", "'|'"),
        (r" ?\n[ \n]*", "chr(10)"),
    ):
        text = f"regexp_replace({text}, '{pattern}', {mark}, 'g')"
    steps = []
    for k, (_, _, ids) in enumerate(HEADED + RULES):
        rule = _quoted(_rule_text(ids))
        steps.append(
            f"s{k} as (select *, contains(r{k}, {rule}) h{k}, replace(r{k}, {rule}, '|') r{k + 1} from "
            + (f"s{k - 1})" if k else "(select *, sequence r0 from sequences))")
        )
    names = ", ".join(f"case when h{k} then {_quoted(n)} end" for k, (n, _, _) in enumerate(HEADED + RULES))
    kinds = " ".join(
        "when " + " or ".join(f"h{k}" for k, (_, c, _) in enumerate(HEADED + RULES) if c == kind) + f" then '{kind}'"
        for kind in CLASSES
    )
    return f"""with known(sentence, id) as (values {sentences}),
rows as (select row_number() over () n, doc_id, string_split(regexp_replace(replace(coalesce(lower(text), ''), '|', ' '),
    '\\r\\n?', chr(10), 'g'), chr(10)) lines from documents),
joined as (select n, lines[1] || array_to_string(list_transform(range(2, len(lines) + 1), lambda i:
    case when i < len(lines) and not regexp_matches(lines[i], '[a-z0-9]') then '|' else chr(10) || lines[i] end), '') plain
    from rows),
normal as (select n, '|' || replace(replace(trim({text}, ' '), '|', '||'), chr(10), chr(10) || chr(10)) || '|' as cuts
    from joined),
found as (select n, regexp_extract_all(cuts, '[|\\n]({wrapped})[|\\n]', 1) found from normal),
numbered as (select n, unnest(range(len(found))) k, unnest(found) s from found),
ids as (select n, list(id order by k) ids
    from numbered join known on replace(s, chr(10) || chr(10), ' ') = sentence group by n),
sequences as (select doc_id, coalesce(ids, []) ids,
    '|' || array_to_string(list_transform(coalesce(ids, []), lambda i: '|' || i || '|'), '') || '|' as sequence
    from rows left join ids using (n)),
{", ".join(steps)}
select doc_id, array_to_string(ids, ' ') sentence_ids,
    array_to_string(list_sort(list_distinct(list_filter([{names}], lambda x: x is not null))), ' ') licences,
    case {kinds} else 'none' end licence_class
from s{len(HEADED + RULES) - 1}"""
