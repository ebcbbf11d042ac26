"""Licence recognition by sentences (operator 5), native Spark functions only.

A text is cut into sentences after ``.``, ``:``, ``!`` and ``?`` before a blank,
and either at every line end or, for wrapped texts, at lines without a word; the reading
with more known sentences counts (by lines, if equal). A sentence is
normalised: lower case, everything but ASCII letters and digits to single
blanks, comment marks thereby gone. A table maps
normalised sentences to identifiers of known licence sentences; what isn't in
it stays out of the sequence. The sequence of identifiers of a text, in order,
is then matched against licence rules in the order of ``RULES``: a rule names
the identifiers that must follow each other; what it matches is taken out of
the sequence, so that a more special rule, which comes first, hides the more
general one. What no rule takes is reported as unmatched sentences.

A text is only cut if it holds one of ``TRIGGERS``, of which every known
sentence has one, so nothing is lost by that. All is one narrow projection: no
shuffle, no Python.

Defined cases: null and empty texts have no sentences and no licences; a licence
named twice in a text is listed once, in the order of the rules; repeated rows
get equal results; extra columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grist.llm.common import free_name

MIT_GRANT = ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the "
             "software to deal in the software without restriction including without limitation the rights to use copy modify merge publish "
             "distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject "
             "to the following conditions")
ISC_GRANT = ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the "
             "above copyright notice and this permission notice appear in all copies")
APACHE_REFS = tuple(f"{start} under the apache license version 2 0{end}" for start in ("licensed", "released", "this work is licensed")
                    for end in ("", " the license"))
APACHE_USE = "you may not use this file except in compliance with the license"
APACHE_URLS = ("http www apache org licenses license 2 0", "https www apache org licenses license 2 0")
APACHE_COPY = "you may obtain a copy of the license at"
APACHE_AS_IS = ("unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis "
                "without warranties or conditions of any kind either express or implied")

#: Licence sentences, normalised, by identifier; those that a notice
#: joins without a mark at which it is cut, also joined (``ApacheRefUse``,
#: ``ApacheCopyAsIs``, ``MITCopyGrant``, ``ISCCopyGrant``). ``*`` stands for
#: a version number, a year or a name of one to twelve words.
SENTENCES = {
    "ApacheRef": APACHE_REFS,
    "ApacheRefUse": tuple(f"{ref} {APACHE_USE}" for ref in APACHE_REFS),
    "ApacheUse": (APACHE_USE,),
    "ApacheCopy": (APACHE_COPY, *[f"{APACHE_COPY} {url}" for url in APACHE_URLS]),
    "ApacheCopyAsIs": tuple(f"{APACHE_COPY} {url} {APACHE_AS_IS}" for url in APACHE_URLS),
    "ApacheAsIs": (APACHE_AS_IS, *[f"{url} {APACHE_AS_IS}" for url in APACHE_URLS]),
    "ApacheSee": ("see the license for the specific language governing permissions and limitations under the license",),
    "MITRef": ("released under the mit license", "licensed under the mit license", "this work is licensed under the mit license",
               "this project is licensed under the mit license", "the mit license mit", "mit license"),
    "MITGrant": (MIT_GRANT,),
    "MITCopyGrant": tuple(f"{title}copyright * {MIT_GRANT}" for title in ("", "mit license ", "the mit license ", "the mit license mit ")),
    "MITNotice": ("the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",),
    "AsIs": ("the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of "
             "merchantability fitness for a particular purpose and noninfringement",),
    "ISCGrant": (ISC_GRANT,),
    "ISCCopyGrant": tuple(f"{title}copyright * {ISC_GRANT}" for title in ("", "isc license ", "the isc license ")),
    "BSDRef": ("licensed under the bsd license", "released under the bsd license", "this work is licensed under the bsd license"),
    "BSD2Ref": ("licensed under the bsd 2 clause license", "released under the bsd 2 clause license"),
    "BSD3Ref": ("licensed under the bsd 3 clause license", "released under the bsd 3 clause license"),
    "BSDGrant": ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",),
    "BSDSource": ("redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",),
    "BSDBinary": ("redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the "
                  "documentation and or other materials provided with the distribution",),
    "BSDEndorse": ("neither the name of * nor the names of its contributors may be used to endorse or promote products derived from this software without "
                   "specific prior written permission",),
    "GPL2Ref": ("this work is licensed under the gnu general public license version 2", "licensed under the gnu general public license version 2",
                "released under the gnu general public license version 2", "licensed under the gpl version 2"),
    "GPL3Ref": ("this work is licensed under the gnu general public license version 3", "licensed under the gnu general public license version 3",
                "released under the gnu general public license version 3", "licensed under the gpl version 3"),
    "LGPL21Ref": ("licensed under the gnu lesser general public license version 2 1", "this work is licensed under the gnu lesser general public license version 2 1"),
    "LGPL3Ref": ("licensed under the gnu lesser general public license version 3", "this work is licensed under the gnu lesser general public license version 3"),
    "AGPL3Ref": ("licensed under the gnu affero general public license version 3", "this work is licensed under the gnu affero general public license version 3"),
    "GPLRedist2": ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation "
                   "either version 2 of the license or at your option any later version",),
    "GPLRedist3": ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation "
                   "either version 3 of the license or at your option any later version",),
    "GPLNoWarranty": ("this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",),
    "GPLSee": ("see the gnu general public license for more details",),
    "MPL2Ref": ("this source code form is subject to the terms of the mozilla public license v 2 0",
                "this source code form is subject to the terms of the mozilla public license v",       # 'v. 2.0' is cut
                "licensed under the mozilla public license version 2 0"),
    "MPLCopy": ("if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0",
                "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0"),
    "EPL2Ref": ("licensed under the eclipse public license version 2 0", "licensed under the eclipse public license 2 0"),
    "CCBYRef": ("licensed under cc by 4 0", "this work is licensed under cc by 4 0", "licensed under a creative commons attribution 4 0 international license",
                "this work is licensed under a creative commons attribution 4 0 international license"),
    "CCBYSARef": ("licensed under cc by sa 4 0", "this work is licensed under cc by sa 4 0",
                  "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    "CCBYNCRef": ("licensed under cc by nc 4 0", "this work is licensed under cc by nc 4 0",
                  "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    "CC0Ref": ("licensed under cc0 1 0", "released under cc0 1 0", "dedicated to the public domain under cc0 1 0"),
    "PublicDomain": ("this work is in the public domain", "released into the public domain"),
    "AllRights": ("all rights reserved",),
    "Copyright": ("copyright *", "copyright c *"),
}

#: Fixed values, in the order of matching: identifiers that must follow each
#: other, and the licence that they mean.
RULES = (
    *[((*ref, *rest), "Apache-2.0") for rest in (("ApacheCopy", "ApacheAsIs", "ApacheSee"), ("ApacheCopyAsIs", "ApacheSee"), ("ApacheCopy", "ApacheAsIs"),
                                                 ("ApacheCopyAsIs",), ("ApacheCopy",)) for ref in (("ApacheRef", "ApacheUse"), ("ApacheRefUse",))],
    (("ApacheRefUse",), "Apache-2.0"),
    (("ApacheRef",), "Apache-2.0"),
    (("MITGrant", "MITNotice", "AsIs"), "MIT"),
    (("MITGrant", "MITNotice"), "MIT"),
    (("MITCopyGrant", "MITNotice", "AsIs"), "MIT"),
    (("MITCopyGrant", "MITNotice"), "MIT"),
    (("MITRef",), "MIT"),
    (("ISCGrant",), "ISC"),
    (("ISCCopyGrant",), "ISC"),
    (("BSDGrant", "BSDSource", "BSDBinary", "BSDEndorse"), "BSD-3-Clause"),
    (("BSDGrant", "BSDSource", "BSDBinary"), "BSD-2-Clause"),
    (("BSD3Ref",), "BSD-3-Clause"),
    (("BSD2Ref",), "BSD-2-Clause"),
    (("BSDRef",), "BSD"),
    (("GPLRedist2",), "GPL-2.0-or-later"),
    (("GPLRedist3",), "GPL-3.0-or-later"),
    (("GPL2Ref",), "GPL-2.0"),
    (("GPL3Ref",), "GPL-3.0"),
    (("LGPL21Ref",), "LGPL-2.1"),
    (("LGPL3Ref",), "LGPL-3.0"),
    (("AGPL3Ref",), "AGPL-3.0"),
    (("MPL2Ref", "MPLCopy"), "MPL-2.0"),
    (("MPL2Ref",), "MPL-2.0"),
    (("EPL2Ref",), "EPL-2.0"),
    (("CCBYSARef",), "CC-BY-SA-4.0"),
    (("CCBYNCRef",), "CC-BY-NC-4.0"),
    (("CCBYRef",), "CC-BY-4.0"),
    (("CC0Ref",), "CC0-1.0"),
    (("PublicDomain",), "Public-Domain"),
)

#: Every known sentence holds one of these, whatever its case (tested).
TRIGGERS = ("licen", "permi", "redistrib", "warrant", "copyright", "rights reserved", "public domain", "provided as is", "cc0", "mpl", "endorse")
BLANK = r"[\x20\x09-\x0D]"
EMPTY_LINE = r"\n[^a-zA-Z0-9\n]*\n"         # nothing, or only comment marks
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def trigger_pattern() -> str:
    # a blank or mark may stand anywhere between the words of a sentence
    return "(?i)" + "|".join(t.replace(" ", "[^a-z0-9]+") for t in TRIGGERS)


def normalised(sentence: Column) -> Column:
    return F.trim(F.regexp_replace(F.translate(sentence, UPPER, LOWER), "[^a-z0-9]+", " "))


def plain_sentences() -> dict[str, str]:
    return {s: i for i, own in SENTENCES.items() for s in own if "*" not in s}


def sentence_patterns() -> list[tuple[str, str]]:
    return [(i, "^" + s.replace("*", "[a-z0-9]+( [a-z0-9]+){0,11}") + "$") for i, own in SENTENCES.items() for s in own if "*" in s]


def identifiers(sentences: Column) -> Column:
    """Identifiers of the known ones among raw sentences, in order."""
    table = F.create_map(*[F.lit(x) for kv in plain_sentences().items() for x in kv])

    def one(sentence: Column) -> Column:
        return F.coalesce(F.try_element_at(table, sentence), *[F.when(sentence.rlike(p), F.lit(i)) for i, p in sentence_patterns()])

    return F.filter(F.transform(F.transform(sentences, normalised), one), lambda x: x.isNotNull())


def apply_rules(sequence: Column) -> Column:
    """(rest, licences) of a sequence written as ``|A||B|``."""
    rules = F.array(*[F.struct(F.lit("".join(rf"\|{i}\|" for i in ids)).alias("pattern"), F.lit(licence).alias("licence")) for ids, licence in RULES])

    def step(state: Column, rule: Column) -> Column:
        hit = F.regexp_like(state["rest"], rule["pattern"])
        return F.struct(F.regexp_replace(state["rest"], rule["pattern"], F.lit("")).alias("rest"),
                        F.when(hit, F.array_append(state["licences"], rule["licence"])).otherwise(state["licences"]).alias("licences"))

    return F.aggregate(rules, F.struct(sequence.alias("rest"), F.array().cast("array<string>").alias("licences")), step)


def recognise(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``sentences`` (identifiers in order), ``licences`` and
    ``unmatched`` (identifiers that no rule took); replaced if they exist."""
    by_line, by_block, state = free_name(df, "_by_line", "_by_block", "_state")
    none = F.array().cast("array<string>")
    triggered = F.col(text).rlike(trigger_pattern())
    lines = F.split(F.regexp_replace(F.col(text), f"([.:!?]){BLANK}+", "$1\n"), r"[\r\n]+")
    parts = F.split(F.regexp_replace(F.col(text), f"([.:!?]){BLANK}+", "$1\n\n"), EMPTY_LINE)
    df = df.withColumns({by_line: F.when(triggered, identifiers(lines)).otherwise(none),
                         by_block: F.when(triggered, identifiers(parts)).otherwise(none)})
    df = df.withColumn("sentences", F.when(F.size(by_block) > F.size(by_line), F.col(by_block)).otherwise(F.col(by_line)))
    sequence = F.concat(F.lit("|"), F.array_join("sentences", "||"), F.lit("|"))
    df = df.withColumn(state, F.when(F.size("sentences") > 0, apply_rules(sequence)))
    return df.withColumns({
        "licences": F.coalesce(F.array_distinct(F.col(state)["licences"]), none),
        "unmatched": F.coalesce(F.filter(F.split(F.col(state)["rest"], r"\|+"), lambda x: x != ""), none),
    }).drop(by_line, by_block, state)


def oracle(limit_to: str = "documents") -> str:
    """DuckDB SQL for ``op5``: the same reading, written with RE2 and lists."""
    quote = lambda x: "'" + x.replace("'", "''") + "'"      # noqa: E731
    known = ", ".join(f"({quote(s)}, {quote(i)})" for s, i in plain_sentences().items())
    pattern = " ".join(f"when regexp_matches(s, {quote(p)}) then {quote(i)}" for i, p in sentence_patterns())
    rest, hits = "seq", []
    steps = []
    for k, (ids, licence) in enumerate(RULES):
        find = "".join(f"|{i}|" for i in ids)
        steps.append(f"r{k + 1} as (select * replace (replace(rest, {quote(find)}, '') as rest, "
                     f"case when contains(rest, {quote(find)}) and not list_contains(hit, {quote(licence)}) then list_append(hit, {quote(licence)}) else hit end as hit) from r{k})")
    blank = r"[\x20\x09-\x0D]"
    ids_of = lambda mode, cut: f"""
      select doc_id, '{mode}' as mode, i, trim(regexp_replace(translate(raw, '{UPPER}', '{LOWER}'), '[^a-z0-9]+', ' ', 'g')) as s
      from (select doc_id, unnest(parts) as raw, generate_subscripts(parts, 1) as i from (select doc_id, {cut} as parts from {limit_to} where text is not null))"""  # noqa: E731
    line = f"regexp_split_to_array(regexp_replace(text, '([.:!?]){blank}+', E'\\\\1\\n', 'g'), '[\\r\\n]+')"
    part = f"regexp_split_to_array(regexp_replace(text, '([.:!?]){blank}+', E'\\\\1\\n\\n', 'g'), '{EMPTY_LINE}')"
    return f"""
    with known(s, id) as (values {known}),
    raw as ({ids_of('line', line)} union all {ids_of('block', part)}),
    named as (select doc_id, mode, i, coalesce(k.id, case {pattern} end) as id from raw left join known k using (s)),
    seqs as (select doc_id, mode, list(id order by i) as ids, count(*) as n from named where id is not null group by all),
    best as (select doc_id, arg_max(ids, n * 2 + (mode = 'line')::int) as ids from seqs group by doc_id),
    r0 as (select d.doc_id, coalesce(array_to_string(ids, ','), '') as sentences, coalesce(len(ids), 0) as n,
           coalesce('|' || array_to_string(ids, '||') || '|', '') as rest, []::varchar[] as hit from {limit_to} d left join best using (doc_id)),
    {', '.join(steps)}
    select doc_id, sentences, array_to_string(hit, ',') as licences, n::bigint as n_known from r{len(RULES)}"""
