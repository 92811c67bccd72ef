"""Recognizes licences by their sentences and by the order in which these stand."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.binding import let
from .common import inputs, lower_ascii, table

# Licence sentences in normal form (a-z, 0-9, "." and "+" inside words, single spaces),
# as the splitter below cuts the published texts.
SENTENCES = {
    "apache-named": "licensed under the apache license version 2.0",
    "apache-you": "licensed under the apache license version 2.0 the license",
    "apache-may": "you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at",
    "apache-basis": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "mit-named": "released under the mit license",
    "mit-licensed": "licensed under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit-as-is": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "mit-liable": "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "bsd-grant": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-names": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd-as-is": "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
    "gpl3-named": "this work is licensed under the gnu general public license version 3",
    "gpl3-terms": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl-terms": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
    "lgpl3-terms": "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "lgpl-terms": "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation",
    "version-2": "either version 2 of the license or at your option any later version",
    "version-2.1": "either version 2.1 of the license or at your option any later version",
    "gpl-hope": "this program is distributed in the hope that it will be useful but without any warranty",
    "mpl-subject": "this source code form is subject to the terms of the mozilla public license v",
    "version-number-2": "2.0",
    "unlicense-free": "this is free and unencumbered software released into the public domain",
    "unlicense-anyone": "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means",
    "cc-by": "licensed under cc by 4.0",
    "cc-by-sa": "licensed under cc by sa 4.0",
    "cc-by-nc": "licensed under cc by nc 4.0",
    "cc0": "to the extent possible under law the author has waived all copyright and related rights to this work",
    "spdx-mit": "spdx license identifier mit",
    "spdx-apache": "spdx license identifier apache 2.0",
    "rights": "all rights reserved",
}

# In order: a rule takes its sentences out of the sequence, so later, shorter rules see what is left.
RULES = (
    ("Apache-2.0", ("apache-you", "apache-may", "apache-copy", "apache-basis")),
    ("Apache-2.0", ("apache-you", "apache-may")),
    ("Apache-2.0", ("apache-named",)),
    ("Apache-2.0", ("spdx-apache",)),
    ("MIT", ("mit-grant", "mit-notice", "mit-as-is", "mit-liable")),
    ("MIT", ("mit-grant", "mit-notice")),
    ("MIT", ("mit-grant",)),
    ("MIT", ("mit-named",)),
    ("MIT", ("mit-licensed",)),
    ("MIT", ("spdx-mit",)),
    ("ISC", ("isc-grant",)),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("LGPL-3.0-or-later", ("lgpl3-terms",)),
    ("LGPL-2.1-or-later", ("lgpl-terms", "version-2.1")),
    ("GPL-3.0-or-later", ("gpl3-terms",)),
    ("GPL-2.0-or-later", ("gpl-terms", "version-2")),
    ("GPL-3.0", ("gpl3-named",)),
    ("MPL-2.0", ("mpl-subject", "version-number-2")),
    ("Unlicense", ("unlicense-free",)),
    ("Unlicense", ("unlicense-anyone",)),
    ("CC-BY-NC-4.0", ("cc-by-nc",)),
    ("CC-BY-SA-4.0", ("cc-by-sa",)),
    ("CC-BY-4.0", ("cc-by",)),
    ("CC0-1.0", ("cc0",)),
)
# Says nothing beside a licence; alone it reserves everything.
RESERVED = ("Proprietary", ("rights",))

# Ends a sentence, beside a stop before white space: a line without letters and digits, also one with a
# comment mark. Single line ends do not, and comment marks and list signs vanish in the normal form.
BREAK = "\x1e"


def normal(sentence: Column) -> Column:
    return F.btrim(F.regexp_replace(sentence, "[^a-z0-9.+]+", " "), F.lit(" ."))


def sentences(text: Column, known: Column) -> Column:
    """Normal forms of the sentences of a text; a line that is a known sentence is one by itself."""
    lines = F.split(lower_ascii(F.coalesce(text, F.lit(""))), "\n")
    apart = F.transform(lines, lambda x: F.when(known[normal(x)].isNotNull(), F.concat(F.lit("\n"), x, F.lit("\n"))).otherwise(x))
    parts = F.regexp_replace(F.array_join(apart, "\n"), "\n[^a-z0-9\n]*\n", BREAK)
    ended = F.regexp_replace(parts, "([.;:!?])[\\x20\\x09-\\x0D]+", f"$1{BREAK}")
    return F.transform(F.split(ended, BREAK), normal)


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_sentences, n_known, sequence, licenses`` of every row, without any shuffle.

    ``sequence`` has the known sentences' identifiers in the order of the text; unknown sentences
    between them do not matter. ``licenses`` are the rules that matched, in rule order, each
    licence once; wrapped, commented and numbered forms of a text give the same. A missing or empty
    text has one empty sentence and no licence; repeated rows give equal results; texts of any
    length are read whole; an empty table gives no rows.
    """
    known = F.create_map(*(F.lit(x) for i, s in SENTENCES.items() for x in (s, i)))
    forms = let(sentences(F.col("text"), known), lambda s: F.struct(F.size(s).alias("n"), F.filter(F.transform(s, lambda x: known[x]), F.isnotnull).alias("ids")))
    rows = inputs(docs, doc_id, text).select("doc_id", forms.alias("f"))

    def matched(state: Column, rule: tuple) -> Column:
        licence, ids = rule
        part = F.lit(",," + ",,".join(ids) + ",,")
        hit = F.contains(state["left"], part)
        return F.struct(
            F.when(hit, F.replace(state["left"], part, F.lit(",,|,,"))).otherwise(state["left"]).alias("left"),
            F.when(hit, F.array_union(state["found"], F.array(F.lit(licence)))).otherwise(state["found"]).alias("found"),
        )

    start = F.struct(
        F.concat(F.lit(",,"), F.array_join(F.transform("f.ids", lambda x: x), ",,"), F.lit(",,")).alias("left"),
        F.array().cast("array<string>").alias("found"),
    )
    some = F.size("f.ids") > 0
    found = reduce(lambda state, rule: let(state, lambda s: matched(s, rule)), RULES, start)["found"]
    reserved = F.when((F.size("found") == 0) & F.array_contains("f.ids", RESERVED[1][0]), F.array(F.lit(RESERVED[0]))).otherwise(F.col("found"))
    none = F.array().cast("array<string>")
    rows = rows.withColumn("found", F.when(some, found).otherwise(none))
    return rows.select(
        "doc_id",
        F.col("f.n").cast("long").alias("n_sentences"),
        F.size("f.ids").cast("long").alias("n_known"),
        F.col("f.ids").alias("sequence"),
        reserved.alias("licenses"),
    )


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_sentences", "n_known", F.array_join("sequence", ",").alias("sequence"), F.array_join("licenses", ",").alias("licenses")
    )


def _sql() -> str:
    values = ", ".join(f"('{s}', '{i}')" for i, s in SENTENCES.items())
    forms = ", ".join(f"'{s}'" for s in SENTENCES.values())
    steps = ",\n".join(
        f"r{n + 1} as (select doc_id, n_sentences, sequence, replace(rest, ',,{',,'.join(ids)},,', ',,|,,') as rest,"
        f" case when contains(rest, ',,{',,'.join(ids)},,') and not list_contains(found, '{lic}') then list_append(found, '{lic}') else found end as found from r{n})"
        for n, (lic, ids) in enumerate(RULES)
    )
    return f"""
with known(form, id) as (values {values}),
l as (select doc_id, list_transform(string_split(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), chr(10)),
  lambda x: case when trim(regexp_replace(x, '[^a-z0-9.+]+', ' ', 'g'), ' .') in ({forms}) then chr(10) || x || chr(10) else x end) as ls from documents),
s as (select doc_id, string_split(regexp_replace(regexp_replace(array_to_string(ls, chr(10)), '\\n[^a-z0-9\\n]*\\n', chr(30), 'g'),
  '([.;:!?])[\\x20\\x09-\\x0D]+', '\\1' || chr(30), 'g'), chr(30)) as ss from l),
e as (select doc_id, unnest(range(len(ss))) as place, unnest(ss) as line from s),
m as (select doc_id, count(id) as n_known, coalesce(string_agg(id, ',' order by place), '') as sequence, coalesce(string_agg(id, ',,' order by place), '') as wide
  from e left join known on form = trim(regexp_replace(line, '[^a-z0-9.+]+', ' ', 'g'), ' .') group by doc_id),
r0 as (select doc_id, cast(len(ss) as bigint) as n_sentences, n_known, sequence, ',,' || wide || ',,' as rest, cast([] as varchar[]) as found from s join m using (doc_id)),
{steps.replace("n_sentences, sequence", "n_sentences, n_known, sequence")}
select doc_id, n_sentences, n_known, sequence,
  case when len(found) = 0 and contains(',' || sequence || ',', ',{RESERVED[1][0]},') then '{RESERVED[0]}' else array_to_string(found, ',') end as licenses from r{len(RULES)}
"""


QUERIES = {"op8_licenses": (op8_licenses, _sql())}
