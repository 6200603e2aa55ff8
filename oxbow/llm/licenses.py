"""License scans by sentence rules (operator 8), column expressions only.

A text is normalised to its words, with marks for line ends and stops. One
pattern finds the known license sentences: they begin and end at a mark, and may
be wrapped over lines, with comment marks before each, but hold no stop and no
empty line. What is left is a sequence of sentence identifiers. Ordered rules
over identifiers name the licenses: a rule matches where its identifiers follow
each other in the sequence (sentences that are not known are skipped).

The tables are fixed and small, so they are literals: no join, no shuffle.

Defined cases: a null or empty text has no sentences; a sentence matches as a
whole or not at all, and of several that match at a place (a tie) the longest
counts; texts of any length are scanned whole; a license stated twice is reported once; repeated rows
give repeated results; extra columns, whatever their names, are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Known sentences (normalised: lower case, words only) and their identifiers.
SENTENCES = {
    "licensed under the apache license version 2 0": "apache2",
    "licensed under the apache license version 2 0 the license": "apache2",
    "you may not use this file except in compliance with the license": "apacheUse",
    "you may obtain a copy of the license at": "apacheCopy",
    "released under the mit license": "mit",
    "licensed under the mit license": "mit",
    "this work is licensed under the gnu general public license version 3": "gpl3",
    "this work is licensed under the gnu general public license version 2": "gpl2",
    "this program is free software": "freeSoftware",
    "you can redistribute it and or modify it under the terms of the gnu general public license "
    "as published by the free software foundation": "gplTerms",
    "either version 3 of the license or at your option any later version": "orLater3",
    "either version 2 of the license or at your option any later version": "orLater2",
    "licensed under cc by nc 4 0": "ccByNc4",
    "licensed under cc by 4 0": "ccBy4",
    "licensed under cc by sa 4 0": "ccBySa4",
    "permission is hereby granted free of charge to any person obtaining a copy of this software "
    "and associated documentation files the software to deal in the software without restriction": "mitGrant",
    "the above copyright notice and this permission notice shall be included in all copies or "
    "substantial portions of the software": "mitNotice",
    "the software is provided as is without warranty of any kind express or implied": "asIs",
    "redistribution and use in source and binary forms with or without modification are permitted "
    "provided that the following conditions are met": "bsdTerms",
    "redistributions of source code must retain the above copyright notice this list of conditions "
    "and the following disclaimer": "bsdSource",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions "
    "and the following disclaimer in the documentation and or other materials provided with the "
    "distribution": "bsdBinary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse "
    "or promote products derived from this software without specific prior written permission": "bsdNames",
    "this software is provided by the copyright holders and contributors as is": "bsdAsIs",
}
#: Ordered rules; of rules that share their first identifiers the longest match is reported.
RULES = (
    ("Apache-2.0", ("apache2", "apacheUse", "apacheCopy")),
    ("Apache-2.0", ("apache2",)),
    ("MIT", ("mitGrant", "mitNotice", "asIs")),
    ("MIT", ("mit",)),
    ("GPL-3.0", ("gpl3",)),
    ("GPL-2.0", ("gpl2",)),
    ("GPL-3.0-or-later", ("freeSoftware", "gplTerms", "orLater3")),
    ("GPL-2.0-or-later", ("freeSoftware", "gplTerms", "orLater2")),
    ("CC-BY-NC-4.0", ("ccByNc4",)),
    ("CC-BY-4.0", ("ccBy4",)),
    ("CC-BY-SA-4.0", ("ccBySa4",)),
    ("BSD-3-Clause", ("bsdTerms", "bsdSource", "bsdBinary", "bsdNames", "bsdAsIs")),
    ("BSD-2-Clause", ("bsdTerms", "bsdSource", "bsdBinary", "bsdAsIs")),
)
_PROGRAM = ("you can redistribute it and or modify it under the terms of the gnu general public license "
            "as published by the free software foundation either version {} of the license or at your "
            "option any later version")
#: Sentences of the standard texts that go on behind those above.
FULL_SENTENCES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software "
    "and associated documentation files the software to deal in the software without restriction "
    "including without limitation the rights to use copy modify merge publish distribute sublicense "
    "and or sell copies of the software and to permit persons to whom the software is furnished to do "
    "so subject to the following conditions": "mitGrant",
    "the software is provided as is without warranty of any kind express or implied including but not "
    "limited to the warranties of merchantability fitness for a particular purpose and "
    "noninfringement": "asIs",
    "this software is provided by the copyright holders and contributors as is and any express or "
    "implied warranties including but not limited to the implied warranties of merchantability and "
    "fitness for a particular purpose are disclaimed": "bsdAsIs",
    _PROGRAM.format(3): "gplTerms3",
    _PROGRAM.format(2): "gplTerms2",
}
#: Rules over them, behind those above.
FULL_RULES = (
    ("GPL-3.0-or-later", ("freeSoftware", "gplTerms3")),
    ("GPL-2.0-or-later", ("freeSoftware", "gplTerms2")),
)
#: Notices of one sentence, as verb + name; names and their identifiers.
VERBS = ("licensed under", "released under", "distributed under", "this work is licensed under",
         "this project is licensed under", "this software is licensed under")
NAMES = {
    "the mit license": "mit", "the isc license": "isc", "the zlib license": "zlib", "the unlicense": "unlicensed",
    "the apache license version 2 0": "apache2", "the apache license 2 0": "apache2",
    "the bsd 2 clause license": "bsd2", "the bsd 3 clause license": "bsd3",
    "the gnu general public license version 2": "gpl2", "the gnu general public license version 3": "gpl3",
    "the gnu lesser general public license version 3": "lgpl3", "the gnu affero general public license version 3": "agpl3",
    "the mozilla public license version 2 0": "mpl2", "the eclipse public license 2 0": "epl2",
    "the boost software license version 1 0": "boost", "cc0 1 0": "cc0", "cc by 4 0": "ccBy4", "cc by sa 4 0": "ccBySa4",
    "cc by nc 4 0": "ccByNc4", "cc by nd 4 0": "ccByNd4", "cc by nc sa 4 0": "ccByNcSa4", "cc by nc nd 4 0": "ccByNcNd4",
}
_LATER = "as published by the free software foundation either version 3 of the license or at your option any later version"
#: Sentences of further standard texts and notices.
MORE_SENTENCES = {
    "this library is free software": "freeLibrary",
    "you can redistribute it and or modify it under the terms of the gnu lesser general public license "
    "as published by the free software foundation": "lgplTerms",
    "either version 2 1 of the license or at your option any later version": "orLater21",
    "you can redistribute it and or modify it under the terms of the gnu lesser general public license " + _LATER:
        "lgplTerms3",
    "you can redistribute it and or modify it under the terms of the gnu affero general public license " + _LATER:
        "agplTerms3",
    "this source code form is subject to the terms of the mozilla public license v": "mplForm",
    "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0": "mplCopy",
    "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0": "mplCopy",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
    "granted provided that the above copyright notice and this permission notice appear in all copies": "iscGrant",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
    "granted": "zeroBsdGrant",
    "the software is provided as is and the author disclaims all warranties with regard to this software including "
    "all implied warranties of merchantability and fitness": "iscAsIs",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "anyone is free to copy modify publish use compile sell or distribute this software either in source code form "
    "or as a compiled binary for any purpose commercial or non commercial and by any means": "unlicenseAnyone",
    "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and "
    "accompanying documentation covered by this license the software to use reproduce display distribute execute and "
    "transmit the software and to prepare derivative works of the software and to permit third parties to whom the "
    "software is furnished to do so all subject to the following": "boostGrant",
    "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 "
    "which is available at https www eclipse org legal epl 2 0": "epl2",
    "this software is provided as is without any express or implied warranty": "zlibAsIs",
    "permission is granted to anyone to use this software for any purpose including commercial applications and to "
    "alter it and redistribute it freely subject to the following restrictions": "zlibGrant",
}
#: Rules over them, behind those above.
MORE_RULES = (
    ("LGPL-2.1-or-later", ("freeLibrary", "lgplTerms", "orLater21")),
    ("LGPL-3.0-or-later", ("freeSoftware", "lgplTerms3")),
    ("AGPL-3.0-or-later", ("freeSoftware", "agplTerms3")),
    ("MPL-2.0", ("mplForm", "mplCopy")), ("ISC", ("iscGrant", "iscAsIs")), ("0BSD", ("zeroBsdGrant", "iscAsIs")),
    ("Unlicense", ("unlicense", "unlicenseAnyone")), ("BSL-1.0", ("boostGrant",)), ("Zlib", ("zlibAsIs", "zlibGrant")),
    ("LGPL-3.0", ("lgpl3",)), ("AGPL-3.0", ("agpl3",)), ("MPL-2.0", ("mpl2",)), ("ISC", ("isc",)), ("Zlib", ("zlib",)),
    ("Unlicense", ("unlicensed",)), ("BSL-1.0", ("boost",)), ("EPL-2.0", ("epl2",)), ("BSD-2-Clause", ("bsd2",)),
    ("BSD-3-Clause", ("bsd3",)), ("CC0-1.0", ("cc0",)), ("CC-BY-ND-4.0", ("ccByNd4",)),
    ("CC-BY-NC-SA-4.0", ("ccByNcSa4",)), ("CC-BY-NC-ND-4.0", ("ccByNcNd4",)),
)
#: All known sentences and all rules, in order.
KNOWN = SENTENCES | FULL_SENTENCES | MORE_SENTENCES | {f"{v} {n}": i for v in VERBS for n, i in NAMES.items()}
EVERY_RULE = RULES + FULL_RULES + MORE_RULES
#: Fixed value: a text with a known sentence that a rule needs holds one of these.
HINT = "(?i)licen|permission|permitted|redistribut|software|copyright|released under|distributed under"


def marked(text: Column) -> Column:
    """The words of the text in lower case, with N for a line end and S for a stop
    (one of . ! ? ; : before white space); it begins and ends with N."""
    stops = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[.!?;:](?:[ \t\r]+|(?=\n))", " S ")
    words = F.regexp_replace(F.replace(stops, F.lit("\n"), F.lit(" N ")), "[^a-z0-9SN]+", " ")
    return F.concat(F.lit("N "), F.trim(words), F.lit(" N"))


def sentence_ids(text: Column) -> Column:
    """Identifiers of the known sentences, in text order."""
    known = F.create_map(*[F.lit(x) for kv in KNOWN.items() for x in kv])
    either = "|".join(k.replace(" ", "(?: N | )") for k in sorted(KNOWN, key=len, reverse=True))
    found = F.regexp_extract_all(marked(text), F.lit(f"[SN] ({either})(?= [SN])"), 1)
    ids = F.transform(found, lambda x: F.element_at(known, F.replace(x, F.lit(" N "), F.lit(" "))))
    return F.when(F.rlike(text, F.lit(HINT)), ids).otherwise(F.array().cast("array<string>"))


def licenses(ids: Column) -> Column:
    """Names of the licenses whose rule matches the sequence, in rule order."""
    line = F.concat(F.lit("|"), F.array_join(ids, "|"), F.lit("|"))
    hit = [F.when(F.instr(line, "|" + "|".join(rule) + "|") > 0, F.lit(name)) for name, rule in EVERY_RULE]
    return F.array_distinct(F.filter(F.array(*hit), lambda x: x.isNotNull()))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_sentences (known ones), sentence_ids and licenses (joined by
    commas; empty if none), one row per document."""
    found = docs.select("doc_id", sentence_ids(F.col("text")).alias("__ids"))
    return found.select("doc_id", F.size("__ids").cast("long").alias("n_sentences"),
                        F.array_join("__ids", ",").alias("sentence_ids"),
                        F.array_join(licenses(F.col("__ids")), ",").alias("licenses"))
