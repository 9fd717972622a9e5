"""Licence scans by sentence rules, with DataFrame operations only.

A text is cut into pieces at punctuation, each piece is normalised, and runs of whole pieces are looked up
among known licence sentences, as a sentence may hold such punctuation itself. The sequence of identifiers
found is matched against ordered rules: each rule takes the identifiers it matches out of the sequence, so a
specific rule must come before a general one.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._columns import fresh

#: Known licence sentences (as ``normalised`` writes them) and their identifiers.
SENTENCES = {
    "released under the mit license": "MITref",
    "licensed under the mit license": "MITref",
    "this project is licensed under the mit license": "MITref",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "MITgrant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "MITnotice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "MITasis",
    "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software": "MITliability",
    "licensed under the apache license version 2.0": "Apache2ref",
    "licensed under the apache license version 2.0 the license": "Apache2ref",
    "you may not use this file except in compliance with the license": "ApacheMayNot",
    "you may obtain a copy of the license at": "ApacheCopyAt",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": "ApacheAsIs",
    "see the license for the specific language governing permissions and limitations under the license": "ApacheSee",
    "this work is licensed under the gnu general public license version 3": "GPL3ref",
    "licensed under the gnu general public license version 3": "GPL3ref",
    "licensed under the gnu general public license version 2": "GPL2ref",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "GPL3plus",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "GPL2plus",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose": "GPLhope",
    "see the gnu general public license for more details": "GPLsee",
    "you should have received a copy of the gnu general public license along with this program": "GPLcopy",
    "licensed under cc by-nc 4.0": "CCBYNC4ref",
    "this work is licensed under cc by-nc 4.0": "CCBYNC4ref",
    "licensed under cc by 4.0": "CCBY4ref",
    "licensed under cc by-sa 4.0": "CCBYSA4ref",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "BSDgrant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "BSDsource",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "BSDbinary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "BSDendorse",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "ISCgrant",
    "this source code form is subject to the terms of the mozilla public license v 2.0": "MPL2ref",
    "gnu general public license version 3 29 june 2007": "GPL3title",
    "gnu general public license version 2 june 1991": "GPL2title",
    "gnu lesser general public license version 3 29 june 2007": "LGPL3title",
    "gnu lesser general public license version 2.1 february 1999": "LGPL21title",
    "gnu affero general public license version 3 19 november 2007": "AGPL3title",
    "apache license version 2.0 january 2004": "Apache2title",
    "everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed": "FSFverbatim",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2.1 of the license or at your option any later version": "LGPL21plus",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version": "LGPL3plus",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version": "LGPL3plus",
    "this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose": "LGPLhope",
    "see the gnu lesser general public license for more details": "LGPLsee",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version": "AGPL3plus",
    "see the gnu affero general public license for more details": "AGPLsee",
    "this program and the accompanying materials are made available under the terms of the eclipse public license 2.0 which is available at https www.eclipse.org legal epl-2.0": "EPL2ref",
    "all rights reserved this program and the accompanying materials are made available under the terms of the eclipse public license v1.0 which accompanies this distribution": "EPL1ref",
    "this program and the accompanying materials are made available under the terms of the eclipse public license v1.0 which accompanies this distribution": "EPL1ref",
    "this is free and unencumbered software released into the public domain": "UnlicenseOpen",
    "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non-commercial and by any means": "UnlicenseAnyone",
    "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work": "CC0waive",
    "licensed under cc0 1.0 universal": "CC0ref",
    "this work is licensed under cc by 4.0": "CCBY4ref",
    "this work is licensed under cc by-sa 4.0": "CCBYSA4ref",
    "this work is licensed under a creative commons attribution 4.0 international license": "CCBY4ref",
    "this work is licensed under a creative commons attribution-sharealike 4.0 international license": "CCBYSA4ref",
    "this work is licensed under a creative commons attribution-noncommercial 4.0 international license": "CCBYNC4ref",
    "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla.org mpl 2.0": "MPL2obtain",
    "distributed under the boost software license version 1.0": "Boost1ref",
    "licensed under the gnu lesser general public license version 2.1": "LGPL21ref",
    "licensed under the gnu lesser general public license version 3": "LGPL3ref",
    "licensed under the gnu affero general public license version 3": "AGPL3ref",
    "licensed under the bsd 3-clause license": "BSD3ref",
    "licensed under the bsd 2-clause license": "BSD2ref",
    "released under the bsd license": "BSDanyRef",
    "this software is provided as is without any express or implied warranty": "ZlibAsIs",
    "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions": "ZlibGrant",
    "all rights reserved": "AllRights",
}
#: Licences that a machine-readable tag may name; each is a sentence and a rule of its own.
TAGS = (
    "MIT", "Apache-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later",
    "AGPL-3.0-only", "AGPL-3.0-or-later", "BSD-2-Clause", "BSD-3-Clause", "ISC", "MPL-2.0", "EPL-1.0", "EPL-2.0", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0", "Unlicense", "BSL-1.0", "Zlib", "0BSD",
)
SENTENCES |= {f"spdx-license-identifier {x.lower()}": f"SPDX-{x}" for x in TAGS}
#: Rules in order. Each is a run of identifiers and the licence that it means.
RULES = [
    (("MITgrant", "MITnotice", "MITasis", "MITliability"), "MIT"),
    (("MITgrant", "MITnotice"), "MIT"),
    (("BSDgrant", "BSDsource", "BSDbinary", "BSDendorse"), "BSD-3-Clause"),
    (("BSDgrant", "BSDsource", "BSDbinary"), "BSD-2-Clause"),
    (("Apache2ref", "ApacheMayNot", "ApacheCopyAt", "ApacheAsIs", "ApacheSee"), "Apache-2.0"),
    (("Apache2ref", "ApacheMayNot"), "Apache-2.0"),
    (("GPL3plus", "GPLhope", "GPLsee", "GPLcopy"), "GPL-3.0-or-later"),
    (("GPL2plus", "GPLhope", "GPLsee", "GPLcopy"), "GPL-2.0-or-later"),
    (("AGPL3plus", "GPLhope", "AGPLsee"), "AGPL-3.0-or-later"),
    (("LGPL21plus", "LGPLhope", "LGPLsee"), "LGPL-2.1-or-later"),
    (("LGPL3plus", "LGPLhope", "LGPLsee"), "LGPL-3.0-or-later"),
    (("GPL3title", "FSFverbatim"), "GPL-3.0-only"),
    (("GPL2title", "FSFverbatim"), "GPL-2.0-only"),
    (("LGPL3title", "FSFverbatim"), "LGPL-3.0-only"),
    (("LGPL21title", "FSFverbatim"), "LGPL-2.1-only"),
    (("AGPL3title", "FSFverbatim"), "AGPL-3.0-only"),
    (("UnlicenseOpen", "UnlicenseAnyone"), "Unlicense"),
    (("ZlibAsIs", "ZlibGrant"), "Zlib"),
    (("MPL2ref", "MPL2obtain"), "MPL-2.0"),
    (("GPL3plus",), "GPL-3.0-or-later"),
    (("GPL2plus",), "GPL-2.0-or-later"),
    (("MITref",), "MIT"),
    (("Apache2ref",), "Apache-2.0"),
    (("GPL3ref",), "GPL-3.0-only"),
    (("GPL2ref",), "GPL-2.0-only"),
    (("CCBYNC4ref",), "CC-BY-NC-4.0"),
    (("CCBYSA4ref",), "CC-BY-SA-4.0"),
    (("CCBY4ref",), "CC-BY-4.0"),
    (("ISCgrant",), "ISC"),
    (("MPL2ref",), "MPL-2.0"),
    (("AGPL3plus",), "AGPL-3.0-or-later"),
    (("LGPL21plus",), "LGPL-2.1-or-later"),
    (("LGPL3plus",), "LGPL-3.0-or-later"),
    (("LGPL21ref",), "LGPL-2.1-only"),
    (("LGPL3ref",), "LGPL-3.0-only"),
    (("AGPL3ref",), "AGPL-3.0-only"),
    (("Apache2title",), "Apache-2.0"),
    (("GPL3title",), "GPL-3.0-only"),
    (("GPL2title",), "GPL-2.0-only"),
    (("LGPL3title",), "LGPL-3.0-only"),
    (("LGPL21title",), "LGPL-2.1-only"),
    (("AGPL3title",), "AGPL-3.0-only"),
    (("EPL2ref",), "EPL-2.0"),
    (("EPL1ref",), "EPL-1.0"),
    (("UnlicenseOpen",), "Unlicense"),
    (("CC0waive",), "CC0-1.0"),
    (("CC0ref",), "CC0-1.0"),
    (("Boost1ref",), "BSL-1.0"),
    (("BSD3ref",), "BSD-3-Clause"),
    (("BSD2ref",), "BSD-2-Clause"),
    *(((f"SPDX-{x}",), x) for x in TAGS),
]
#: Every known sentence holds one of these, in lower case; a text without any has no licence sentence. Each lies
#: within one word, as any white space or punctuation may part words.
HINTS = ("licen", "permi", "warrant", "distribut", "copyright", "reserved", "contributors", "unencumbered", "obtain")
#: A paragraph ends here; blank lines and lines that are a known sentence by themselves are set off by it.
PARAGRAPH_END = "\u2029"
#: A piece of a paragraph ends at one of these before white space.
PIECE_END = r"(?<=[.!?:;])[ \t\r\x0B\f\n]+"
#: Stands in a sequence of identifiers where a rule took a run out of it.
TAKEN = ";"
#: What a comment puts before a line.
COMMENT_MARK = r"^[ \t]*(?:#+|//+|/?\*+/?|;+|--)[ \t]*"


def normalised(sentence: Column) -> Column:
    """Lower case, words parted by single blanks, without punctuation but for . - + inside words."""
    plain = F.regexp_replace(F.lower(sentence), r"[^a-z0-9.+\-\x80-\x{10FFFF}]+", " ")
    plain = F.regexp_replace(plain, r"(?<![^ ])[.+\-]+|[.+\-]+(?![^ ])", "")
    return F.trim(F.regexp_replace(plain, " +", " "))


def pieces(text: Column) -> Column:
    """The normalised pieces of a text, in order, with a line break around each and two between paragraphs.

    Lines flow together, as a licence text is often wrapped, but a blank line ends a paragraph, and a line that
    is a known sentence by itself is one.
    """
    lines = F.transform(F.split(text, "\r?\n", -1), lambda x: F.regexp_replace(x, COMMENT_MARK, ""))
    end = F.lit(PARAGRAPH_END)
    marked = F.transform(lines, lambda x: F.when(F.trim(x) == "", end).when(_known(normalised(x)).isNotNull(), F.concat(end, x, end)).otherwise(x))
    paragraphs = F.split(F.array_join(marked, " "), PARAGRAPH_END, -1)
    joined = F.transform(paragraphs, lambda p: F.array_join(F.filter(F.transform(F.split(p, PIECE_END, -1), normalised), lambda x: x != ""), "\n"))
    return F.concat(F.lit("\n"), F.array_join(joined, "\n\n"), F.lit("\n"))


#: Any known sentence as a run of whole pieces of one paragraph: 'free software: you can' is two of them.
KNOWN_RUN = r"(?<=\n)(?:" + "|".join(re.escape(x).replace("\\ ", r"[ \n]") for x in sorted(SENTENCES, key=len, reverse=True)) + r")(?=\n)"


def _known(sentence: Column) -> Column:
    table = F.create_map(*(F.lit(x) for pair in SENTENCES.items() for x in pair))
    return F.try_element_at(table, sentence)


def sentence_ids(text: Column) -> Column:
    """Identifiers of the known licence sentences of a text, in order, repeats included."""
    return F.transform(F.regexp_extract_all(pieces(text), F.lit(KNOWN_RUN), F.lit(0)), lambda x: _known(F.translate(x, "\n", " ")))


def matched(ids: Column) -> Column:
    """struct(rest, licences): rules applied in order to a sequence of identifiers.

    A rule takes out every run that it matches and leaves a mark, so what was apart stays apart; ``rest`` is what
    no rule took, and the marks.
    """
    rules = F.array(*(F.struct(F.lit("," + ",,".join(run) + ",").alias("run"), F.lit(name).alias("name")) for run, name in RULES))
    start = F.struct(F.concat(F.lit(","), F.array_join(ids, ",,"), F.lit(",")).alias("rest"), F.array().cast("array<string>").alias("licences"))

    def apply(state: Column, rule: Column) -> Column:
        hit = F.contains(state["rest"], rule["run"])
        return F.struct(
            F.when(hit, F.replace(state["rest"], rule["run"], F.lit(TAKEN))).otherwise(state["rest"]).alias("rest"),
            F.when(hit, F.concat(state["licences"], F.array(rule["name"]))).otherwise(state["licences"]).alias("licences"),
        )

    return F.aggregate(rules, start, apply)


def scan(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_sentences, sentence_ids, licences, n_unmatched of each row of ``df``.

    ``n_sentences`` counts known licence sentences, ``sentence_ids`` lists them in the order of the text and
    ``licences`` the distinct licences by name, both comma-joined; ``n_unmatched`` counts sentences that no
    rule took. A null or empty text has none, and of sentences that begin alike the longest counts. Each row is
    looked at by itself, whole and however long, so repeated rows repeat, an empty table stays empty, and other
    columns aren't read.
    """
    plain = F.lower(F.coalesce(F.col(text), F.lit("")))
    hinted = F.lit(False)
    for hint in HINTS:
        hinted = hinted | F.contains(F.col("plain"), F.lit(hint))
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"), plain.alias("plain"))
    none = F.array().cast("array<string>")
    rows = rows.select("key", F.when(hinted, sentence_ids(F.col("text"))).otherwise(none).alias("ids"))
    rows = rows.select("key", "ids", F.when(F.size("ids") > 0, matched(F.col("ids"))).alias("found"))
    rest = F.filter(F.split(F.coalesce(F.col("found.rest"), F.lit("")), f"[,{TAKEN}]+"), lambda x: x != "")
    return rows.select(
        F.col("key").alias(key),
        F.size("ids").cast("long").alias("n_sentences"),
        F.array_join("ids", ",").alias("sentence_ids"),
        F.array_join(F.array_sort(F.array_distinct(F.coalesce(F.col("found.licences"), none))), ",").alias("licences"),
        F.size(rest).cast("long").alias("n_unmatched"),
    )


def with_licences(df: DataFrame, key: str = "doc_id", text: str = "text", out: str = "licences") -> DataFrame:
    """``df`` with the array of its licences under ``out``, or a longer name where ``out`` is taken."""
    found = sentence_ids(F.coalesce(F.col(text), F.lit("")))
    return df.withColumn(fresh(df.columns, out), F.array_sort(F.array_distinct(matched(found)["licences"])))


def documents_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
