"""Licence scan by sentence rules, in DataFrame functions only.

A text is cut into sentences, with their lines joined; a sentence that is not known is cut into paragraphs, and one
of these that is not known into lines. Comment marks do not count. Normalised sentences are
looked up among known licence sentences; a version in a sentence travels with its identifier. The
identifiers, in order, form a sequence, and ordered rules turn stretches of it into licences: a stretch
that a rule takes is gone for the rules after it. What no rule takes is reported as left over.

Null or empty texts have no licence. Everything happens inside the row: nothing is shuffled, repeated
rows give repeated results, an empty table gives none, extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slatecraft.llm.frames import whole_text

# fixed values: known sentences of public licences, normalised; # stands for a version
SENTENCES = {
    "released under the mit license": "mit_name",
    "licensed under the mit license": "mit_name",
    "this project is licensed under the mit license": "mit_name",
    "mit license": "mit_name",
    "spdx-license-identifier mit": "mit_name",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and/or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "mit_grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit_notice",
    "licensed under the apache license version #": "apache_name",
    "released under the apache license version #": "apache_name",
    "spdx-license-identifier apache-#": "apache_name",
    "licensed under the apache license version # the license": "apache_name",
    "you may not use this file except in compliance with the license": "apache_comply",
    "you may obtain a copy of the license at": "apache_copy",
    "this work is licensed under the gnu general public license version #": "gpl_name",
    "licensed under the gnu general public license version #": "gpl_name",
    "released under the gnu general public license version #": "gpl_name",
    "this program is free software you can redistribute it and/or modify it under the terms of the gnu general public license as published by the free software foundation either version # of the license or at your option any later version": "gpl_later",
    "you can redistribute it and/or modify it under the terms of the gnu general public license as published by the free software foundation either version # of the license or at your option any later version": "gpl_later",
    "you can redistribute it and/or modify it under the terms of the gnu general public license as published by the free software foundation": "gpl_terms",
    "either version # of the license or at your option any later version": "later_version",
    "this program is distributed in the hope that it will be useful but without any warranty": "gpl_warranty",
    "without even the implied warranty of merchantability or fitness for a particular purpose": "gpl_warranty",
    "spdx-license-identifier gpl-#": "gpl_name",
    "spdx-license-identifier gpl-#-only": "gpl_name",
    "spdx-license-identifier gpl-#+": "gpl_later",
    "spdx-license-identifier gpl-#-or-later": "gpl_later",
    "spdx-license-identifier lgpl-#": "lgpl_name",
    "spdx-license-identifier lgpl-#-only": "lgpl_name",
    "spdx-license-identifier lgpl-#+": "lgpl_later",
    "spdx-license-identifier lgpl-#-or-later": "lgpl_later",
    "spdx-license-identifier agpl-#": "agpl_name",
    "spdx-license-identifier agpl-#-only": "agpl_name",
    "spdx-license-identifier agpl-#-or-later": "agpl_later",
    "spdx-license-identifier mpl-#": "mpl_name",
    "spdx-license-identifier bsd-#-clause": "bsd_clause",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose": "gpl_warranty",
    "licensed under the gnu lesser general public license version #": "lgpl_name",
    "licensed under the gnu affero general public license version #": "agpl_name",
    "licensed under the mozilla public license version #": "mpl_name",
    "this source code form is subject to the terms of the mozilla public license v. #": "mpl_name",
    "licensed under cc by #": "cc_by",
    "licensed under cc by-sa #": "cc_by_sa",
    "licensed under cc by-nc #": "cc_by_nc",
    "licensed under cc by-nd #": "cc_by_nd",
    "licensed under cc by-nc-sa #": "cc_by_nc_sa",
    "licensed under cc by-nc-nd #": "cc_by_nc_nd",
    "licensed under the bsd license": "bsd_name",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd_grant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsd_source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution": "bsd_binary",
    "all rights reserved under copyright": "reserved",
}
#: Each known sentence holds one of these, so texts without any are done.
HINTS = "(?i)licen[sc]e|permission|redistribut|warranty|copyright"
# fixed values: rules in order; a rule is a licence and the sequence it stands for, {v} its version
RULES = [
    ("MIT", "mit_grant(?:@\\S*)? mit_notice(?:@\\S*)? "),
    ("MIT", "mit_name@ "),
    ("MIT", "mit_grant@ "),
    ("Apache-{v}", "apache_name@(\\S*) (?:apache_comply@ )?(?:apache_copy@ )?"),
    ("GPL-{v}-or-later", "gpl_later@(\\S*) (?:gpl_warranty@ )*"),
    ("GPL-{v}-or-later", "gpl_terms@ later_version@(\\S*) (?:gpl_warranty@ )*"),
    ("LGPL-{v}-or-later", "lgpl_later@(\\S*) "),
    ("AGPL-{v}-or-later", "agpl_later@(\\S*) "),
    ("GPL-{v}", "gpl_name@(\\S*) (?:gpl_warranty@ )*"),
    ("AGPL-{v}", "agpl_name@(\\S*) "),
    ("LGPL-{v}", "lgpl_name@(\\S*) "),
    ("MPL-{v}", "mpl_name@(\\S*) "),
    ("CC-BY-NC-SA-{v}", "cc_by_nc_sa@(\\S*) "),
    ("CC-BY-NC-ND-{v}", "cc_by_nc_nd@(\\S*) "),
    ("CC-BY-NC-{v}", "cc_by_nc@(\\S*) "),
    ("CC-BY-SA-{v}", "cc_by_sa@(\\S*) "),
    ("CC-BY-ND-{v}", "cc_by_nd@(\\S*) "),
    ("CC-BY-{v}", "cc_by@(\\S*) "),
    ("BSD", "bsd_grant@ bsd_source@ bsd_binary@ "),
    ("BSD", "bsd_name@ "),
    ("BSD-{v}-Clause", "bsd_clause@(\\S*) "),
]
VERSION = "[0-9]+(?:[.][0-9]+)*"
#: Not the colon of a tag, nor the dot of "v. 2.0".
SENTENCE_ENDS = "(?i)(?:[;!?]|(?<!\\bv)[.]|(?<!spdx-license-identifier):)\\s"
#: Lines that are empty or hold a comment mark alone, and lines that name who holds the copyright.
PARAGRAPH_ENDS = "(?i)(?:\\n|\\r\\n?)[^\\p{L}\\p{N}\\r\\n]*(?:copyright (?:[(]c[)]|\u00a9|[0-9])[^\\r\\n]*)?[\\r\\n]"
LINE_ENDS = "[\\r\\n]+"


def normalised(sentence: Column) -> Column:
    """Lower case; only letters, digits and inner marks, no comment marks; single spaces; a version becomes #."""
    plain = F.regexp_replace(F.lower(sentence), "[^a-z0-9./+-]+", " ")
    plain = F.regexp_replace(plain, "(?<![^ ])[/+-]+ *|[/-]+(?= |$)", "")
    return F.regexp_replace(F.regexp_replace(plain, VERSION, "#"), "^[ .]+|[ .]+$", "")


def identifiers(text: Column) -> Column:
    """``id@version`` of the known sentences of a text, in order."""
    table = F.create_map(*[F.lit(x) for pair in SENTENCES.items() for x in pair])

    def known(part: Column, ends: list[str]) -> Column:
        name = F.try_element_at(table, normalised(part))
        found = F.array(F.concat(name, F.lit("@"), F.regexp_extract(part, VERSION, 0)))
        if not ends:
            return F.when(name.isNotNull(), found).otherwise(F.array().cast("array<string>"))
        return F.when(name.isNotNull(), found).otherwise(parts(part, ends))

    def parts(whole: Column, ends: list[str]) -> Column:
        likely = F.filter(F.split(whole, ends[0], -1), lambda s: s.rlike(HINTS))
        return F.flatten(F.transform(likely, lambda s: known(s, ends[1:])))

    return parts(text, [SENTENCE_ENDS, PARAGRAPH_ENDS, LINE_ENDS])


def recognise(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, licences (each once, by the order of rules), n_sentences known, left_over identifiers."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), whole_text(text).alias("text"))
    hinted = F.col("text").rlike(HINTS)
    none = F.array().cast("array<string>")
    rows = rows.select("doc_id", F.when(hinted, identifiers(F.col("text"))).otherwise(none).alias("ids"))

    def apply(sequence: Column, rule: int) -> tuple[Column, Column]:
        name, pattern = RULES[rule]
        found = F.regexp_extract_all(sequence, F.lit(pattern), F.lit(1 if "{v}" in name else 0))
        names = F.transform(found, lambda v: F.rtrim(F.replace(F.lit(name.replace("{v}", "\x00")), F.lit("\x00"), v), F.lit("-"))) if "{v}" in name else F.transform(found, lambda v: F.lit(name))
        return names, F.regexp_replace(sequence, pattern, "")

    rows = rows.withColumn("left", F.array_join(F.transform("ids", lambda x: F.concat(x, F.lit(" "))), ""))
    rows = rows.withColumn("licences", none)
    for rule in range(len(RULES)):
        names, left = apply(F.col("left"), rule)
        rows = rows.select("doc_id", "ids", F.when(F.col("left") == "", F.col("licences")).otherwise(F.concat("licences", names)).alias("licences"), F.when(F.col("left") == "", F.col("left")).otherwise(left).alias("left"))
    return rows.select("doc_id", F.array_distinct("licences").alias("licences"), F.size("ids").cast("long").alias("n_sentences"), F.trim("left").alias("left_over"))
