"""Licence scans by sentence rules; DataFrame functions only.

A text is normalised (lower case, runs of anything but ASCII letters and digits to one
space, a mark where a sentence, line or clause may end). A known licence sentence is found
whatever marks are within: it may be wrapped over lines of a comment or hold a colon. A
sentence of ``LONG`` words may stand anywhere; a shorter one, a notice that names a licence
or an SPDX tag has to fill the text from one mark to another. What is left of a text is the
sequence of identifiers. Ordered rules, each a sequence of identifiers, are then tried from
the first: a rule that occurs contiguously names its licence and takes its identifiers out,
so that a shorter rule can't claim them again.

Everything happens within a row; nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Known sentences after normalisation, fixed values: identifier, sentence.
SENTENCES = (
    (1, "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"),
    (2, "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    (3, "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"),
    (4, "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"),
    (5, "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    (6, "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    (7, "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"),
    (8, "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    (9, "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed"),
    (10, "licensed under the apache license version 2 0"),
    (11, "licensed under the apache license version 2 0 the license"),
    (12, "you may not use this file except in compliance with the license"),
    (13, "you may obtain a copy of the license at http www apache org licenses license 2 0"),
    (14, "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    (15, "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    (16, "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version"),
    (17, "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"),
    (18, "see the gnu general public license for more details"),
    (19, "this work is licensed under the gnu general public license version 3"),
    (20, "this work is licensed under the gnu general public license version 2"),
    (21, "released under the mit license"),
    (22, "licensed under the mit license"),
    (23, "licensed under cc by nc 4 0"),
    (24, "licensed under cc by 4 0"),
    (25, "licensed under cc by sa 4 0"),
    (26, "this work is licensed under a creative commons attribution 4 0 international license"),
    (27, "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    (28, "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    (29, "this is free and unencumbered software released into the public domain"),
    (30, "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means"),
    (31, "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    (32, "this source code form is subject to the terms of the mozilla public license v 2 0"),
    (33, "all rights reserved"),
    (40, "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so"),
    (41, "except as contained in this notice the name of the x consortium shall not be used in advertising or otherwise to promote the sale use or other dealings in this software without prior written authorization from the x consortium"),
    (42, "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness"),
    (43, "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    (44, "all advertising materials mentioning features or use of this software must display the following acknowledgement"),
    (45, "neither the name of the organization nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    (46, "this software is provided by the copyright holder and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed"),
    (50, "apache license version 2 0 january 2004"),
    (51, "terms and conditions for use reproduction and distribution"),
    (52, "the end user documentation included with the redistribution if any must include the following acknowledgment"),
    (53, "gnu general public license version 3 29 june 2007"),
    (54, "gnu general public license version 2 june 1991"),
    (55, "gnu lesser general public license version 2 1 february 1999"),
    (56, "gnu lesser general public license version 3 29 june 2007"),
    (57, "gnu affero general public license version 3 19 november 2007"),
    (58, "everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed"),
    (60, "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version"),
    (61, "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    (62, "this program is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    (63, "see the gnu lesser general public license for more details"),
    (64, "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    (65, "see the gnu affero general public license for more details"),
    (66, "this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"),
    (67, "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license version 2 as published by the free software foundation"),
    (70, "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0"),
    (71, "mozilla public license version 2 0"),
    (72, "the contents of this file are subject to the mozilla public license version 1 1 the license you may not use this file except in compliance with the license"),
    (73, "eclipse public license v 2 0"),
    (74, "eclipse public license v 1 0"),
    (75, "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0"),
    (76, "this program and the accompanying materials are made available under the terms of the eclipse public license v1 0 which accompanies this distribution and is available at http www eclipse org legal epl v10 html"),
    (78, "common development and distribution license cddl version 1 0"),
    (79, "the contents of this file are subject to the terms of the common development and distribution license the license"),
    (80, "boost software license version 1 0 august 17th 2003"),
    (81, "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the following"),
    (83, "this software is provided as is without any express or implied warranty"),
    (84, "in no event will the authors be held liable for any damages arising from the use of this software"),
    (85, "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions"),
    (86, "the origin of this software must not be misrepresented you must not claim that you wrote the original software"),
    (87, "creative commons cc0 1 0 universal"),
    (89, "do what the fuck you want to public license"),
    (91, "the artistic license 2 0"),
    (93, "sil open font license version 1 1 26 february 2007"),
    (94, "this font software is licensed under the sil open font license version 1 1"),
    (95, "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted provided that the above copyright notice and this paragraph and the following two paragraphs appear in all copies"),
    (96, "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal with the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"),
    (97, "permission to use copy modify and distribute this software and its documentation for any purpose and without fee is hereby granted provided that the above copyright notice appear in all copies and that both that copyright notice and this permission notice appear in supporting documentation"),
    (98, "microsoft public license ms pl"),
    (99, "this license governs use of the accompanying software"),
    (100, "european union public licence v 1 2"),
    (102, "server side public license version 1 october 16 2018"),
    (103, "business source license 1 1"),
    (104, "elastic license 2 0"),
    (105, "python software foundation license version 2"),
)
# What licences are called in notices, fixed values.
NAMES = {
    "mit license": "MIT", "mit licence": "MIT", "expat license": "MIT", "mit no attribution license": "MIT-0", "mit 0 license": "MIT-0", "isc license": "ISC", "x11 license": "X11",
    "zero clause bsd license": "0BSD", "bsd zero clause license": "0BSD", "bsd 2 clause license": "BSD-2-Clause", "2 clause bsd license": "BSD-2-Clause", "simplified bsd license": "BSD-2-Clause",
    "bsd 3 clause license": "BSD-3-Clause", "3 clause bsd license": "BSD-3-Clause", "new bsd license": "BSD-3-Clause", "modified bsd license": "BSD-3-Clause", "bsd 4 clause license": "BSD-4-Clause", "original bsd license": "BSD-4-Clause",
    "apache license 2 0": "Apache-2.0", "apache license version 2 0": "Apache-2.0", "apache 2 0 license": "Apache-2.0", "apache software license 1 1": "Apache-1.1",
    "gnu general public license version 3": "GPL-3.0", "gnu general public license v3 0": "GPL-3.0", "gnu gpl v3": "GPL-3.0", "gpl v3": "GPL-3.0", "gplv3": "GPL-3.0",
    "gnu general public license version 2": "GPL-2.0", "gnu general public license v2 0": "GPL-2.0", "gnu gpl v2": "GPL-2.0", "gpl v2": "GPL-2.0", "gplv2": "GPL-2.0",
    "gnu lesser general public license version 2 1": "LGPL-2.1", "gnu lgpl v2 1": "LGPL-2.1", "lgpl v2 1": "LGPL-2.1", "gnu lesser general public license version 3": "LGPL-3.0", "gnu lgpl v3": "LGPL-3.0", "lgpl v3": "LGPL-3.0", "lgplv3": "LGPL-3.0",
    "gnu affero general public license version 3": "AGPL-3.0", "gnu agpl v3": "AGPL-3.0", "agpl v3": "AGPL-3.0", "agplv3": "AGPL-3.0",
    "mozilla public license 2 0": "MPL-2.0", "mozilla public license version 2 0": "MPL-2.0", "mpl 2 0": "MPL-2.0", "mozilla public license 1 1": "MPL-1.1",
    "eclipse public license 2 0": "EPL-2.0", "eclipse public license v2 0": "EPL-2.0", "eclipse public license 1 0": "EPL-1.0", "common development and distribution license 1 0": "CDDL-1.0",
    "boost software license 1 0": "BSL-1.0", "boost software license version 1 0": "BSL-1.0", "zlib license": "Zlib", "unlicense": "Unlicense", "cc0 1 0": "CC0-1.0", "cc0 1 0 universal": "CC0-1.0", "wtfpl": "WTFPL",
    "artistic license 2 0": "Artistic-2.0", "sil open font license version 1 1": "OFL-1.1", "sil open font license 1 1": "OFL-1.1", "postgresql license": "PostgreSQL", "university of illinois ncsa open source license": "NCSA", "microsoft public license": "MS-PL",
    "european union public licence 1 2": "EUPL-1.2", "eupl 1 2": "EUPL-1.2", "server side public license": "SSPL-1.0", "business source license 1 1": "BUSL-1.1", "elastic license 2 0": "Elastic-2.0", "python software foundation license version 2": "PSF-2.0",
    "cc by 4 0": "CC-BY-4.0", "cc by sa 4 0": "CC-BY-SA-4.0", "cc by nc 4 0": "CC-BY-NC-4.0", "cc by nd 4 0": "CC-BY-ND-4.0", "cc by nc sa 4 0": "CC-BY-NC-SA-4.0", "cc by nc nd 4 0": "CC-BY-NC-ND-4.0", "cc by 3 0": "CC-BY-3.0", "cc by sa 3 0": "CC-BY-SA-3.0",
    "creative commons attribution 4 0 international license": "CC-BY-4.0", "creative commons attribution sharealike 4 0 international license": "CC-BY-SA-4.0", "creative commons attribution noncommercial 4 0 international license": "CC-BY-NC-4.0", "creative commons attribution noderivatives 4 0 international license": "CC-BY-ND-4.0",
    "creative commons attribution noncommercial sharealike 4 0 international license": "CC-BY-NC-SA-4.0", "creative commons attribution noncommercial noderivatives 4 0 international license": "CC-BY-NC-ND-4.0",
}
# Ordered rules, fixed values: licence, identifiers in order. Longer ones stand before those they contain.
RULES = (
    ("X11", (1, 2, 3, 41)),
    ("MIT", (1, 2, 3, 4)),
    ("MIT", (1, 2, 3)),
    ("MIT", (1, 2)),
    ("MIT-0", (40, 3, 4)),
    ("MIT-0", (40, 3)),
    ("NCSA", (96,)),
    ("BSD-4-Clause", (5, 6, 7, 44, 45)),
    ("BSD-4-Clause", (5, 6, 7, 44, 8)),
    ("BSD-4-Clause", (5, 6, 7, 44)),
    ("Apache-1.1", (5, 6, 7, 52)),
    ("BSD-3-Clause", (5, 6, 7, 8, 9)),
    ("BSD-3-Clause", (5, 6, 7, 8, 46)),
    ("BSD-3-Clause", (5, 6, 7, 8)),
    ("BSD-2-Clause", (5, 6, 7, 9)),
    ("BSD-2-Clause", (5, 6, 7, 46)),
    ("BSD-2-Clause", (5, 6, 7)),
    ("BSD-1-Clause", (5, 6, 9)),
    ("Apache-2.0", (50, 51)),
    ("Apache-2.0", (11, 12, 13, 14)),
    ("Apache-2.0", (10, 12, 14)),
    ("Apache-2.0", (11, 12)),
    ("Apache-2.0", (50,)),
    ("Apache-2.0", (10,)),
    ("GPL-3.0", (53, 58, 15, 17, 18)),
    ("GPL-3.0", (53, 58)),
    ("GPL-3.0", (53,)),
    ("GPL-2.0", (54, 58, 16, 17, 18)),
    ("GPL-2.0", (54, 58)),
    ("GPL-2.0", (54,)),
    ("LGPL-2.1", (55, 58, 60, 66, 63)),
    ("LGPL-2.1", (55, 58)),
    ("LGPL-2.1", (55,)),
    ("LGPL-3.0", (56, 58)),
    ("LGPL-3.0", (56,)),
    ("AGPL-3.0", (57, 58, 64, 17, 65)),
    ("AGPL-3.0", (57, 58)),
    ("AGPL-3.0", (57,)),
    ("GPL-3.0-or-later", (15, 17, 18)),
    ("GPL-3.0-or-later", (15,)),
    ("GPL-2.0-or-later", (16, 17, 18)),
    ("GPL-2.0-or-later", (16,)),
    ("LGPL-2.1-or-later", (60, 66, 63)),
    ("LGPL-2.1-or-later", (60,)),
    ("LGPL-3.0-or-later", (61, 66, 63)),
    ("LGPL-3.0-or-later", (61,)),
    ("LGPL-3.0-or-later", (62, 17, 63)),
    ("LGPL-3.0-or-later", (62,)),
    ("AGPL-3.0-or-later", (64, 17, 65)),
    ("AGPL-3.0-or-later", (64,)),
    ("GPL-2.0-only", (67, 17, 18)),
    ("GPL-2.0-only", (67,)),
    ("GPL-3.0-only", (19,)),
    ("GPL-2.0-only", (20,)),
    ("MIT", (21,)),
    ("MIT", (22,)),
    ("CC-BY-NC-4.0", (23,)),
    ("CC-BY-NC-4.0", (28,)),
    ("CC-BY-4.0", (24,)),
    ("CC-BY-4.0", (26,)),
    ("CC-BY-SA-4.0", (25,)),
    ("CC-BY-SA-4.0", (27,)),
    ("Unlicense", (29, 30)),
    ("Unlicense", (29,)),
    ("ISC", (31, 42)),
    ("ISC", (31,)),
    ("0BSD", (43, 42)),
    ("0BSD", (43,)),
    ("MPL-2.0", (32, 70)),
    ("MPL-2.0", (32,)),
    ("MPL-2.0", (71,)),
    ("MPL-1.1", (72,)),
    ("EPL-2.0", (75,)),
    ("EPL-2.0", (73,)),
    ("EPL-1.0", (76,)),
    ("EPL-1.0", (74,)),
    ("CDDL-1.0", (78,)),
    ("CDDL-1.0", (79,)),
    ("BSL-1.0", (80, 81)),
    ("BSL-1.0", (80,)),
    ("BSL-1.0", (81,)),
    ("Zlib", (83, 84, 85, 86)),
    ("Zlib", (85, 86)),
    ("Zlib", (85,)),
    ("CC0-1.0", (87,)),
    ("WTFPL", (89,)),
    ("Artistic-2.0", (91, 58)),
    ("Artistic-2.0", (91,)),
    ("OFL-1.1", (94, 93)),
    ("OFL-1.1", (94,)),
    ("OFL-1.1", (93,)),
    ("PostgreSQL", (95,)),
    ("HPND", (97,)),
    ("MS-PL", (98, 99)),
    ("MS-PL", (98,)),
    ("EUPL-1.2", (100,)),
    ("SSPL-1.0", (102,)),
    ("BUSL-1.1", (103,)),
    ("Elastic-2.0", (104,)),
    ("PSF-2.0", (105,)),
    ("Proprietary", (33,)),
)
# One of these is in every known sentence and every notice, so other texts needn't be looked at closely; fixed values.
TRIGGERS = ("licen", "permi", "distribut", "copyright", "warrant", "reserved", "software", "public", "creative commons", "conditions", "gpl", "unlicense", "wtfpl", "eupl", "mpl", "cc0", "cc by")

BOUNDARY = r"[.!?:]+[ \t\r]+|[.!?:]*[\r\n]+"
MARK = "Z"  # texts are in lower case
LONG = 12  # words from which a sentence may stand anywhere; shorter ones fill the text from mark to mark
NOTICE = "(?:(?:this|the) (?:software|work|program|file|project|library|code|material|document|package|module|dataset|content) is )?(?:licensed|released|distributed|published|provided|available|made available) under (?:the )?(?:terms (?:and conditions )?of (?:the )?)?"
SPDX = "spdx license identifier "


def _plain(s: str) -> str:
    return " ".join("".join(c if c.isalnum() else " " for c in s.lower()).split())


LICENSES = tuple(dict.fromkeys([*(n for n, _ in RULES), *NAMES.values()]))
TAGS = {_plain(n): n for n in LICENSES}
_CALLED = {**{k: f"={v}" for k, v in TAGS.items()}, **{k: f"={v}" for k, v in NAMES.items()}}  # identifiers of licences that are named
ALL_RULES = (*((n, tuple(map(str, ids))) for n, ids in RULES), *((n, (f"={n}",)) for n in LICENSES))


def _any(parts) -> str:
    return "|".join(sorted(parts, key=lambda s: (-len(s), s)))


def _spaced(pattern: str) -> str:
    return pattern.replace(" ", f"[ {MARK}]+")


_LONG = _spaced(_any(s for _, s in SENTENCES if len(s.split()) >= LONG))
_SHORT = _spaced(_any(s for _, s in SENTENCES if len(s.split()) < LONG) + f"|{NOTICE}(?:{_any(NAMES)})|{SPDX}(?:{_any(TAGS)})")
KNOWN = f"(?<=^|[ {MARK}])(?:{_LONG})(?=[ {MARK}]|$)|(?<=^|^ |{MARK}|{MARK} )(?:{_SHORT})(?= ?(?:{MARK}|$))"
CALLED = f"^(?:{NOTICE}|{SPDX})({_any(_CALLED)})$"


def _sequence(ids: tuple) -> str:
    return "".join(f"<{i}>" for i in ids)


def license_scan(docs: DataFrame) -> DataFrame:
    """``(doc_id, sentence_ids, licenses, n_licenses)`` for every row of ``docs``.

    ``sentence_ids`` has the known sentences in order (``=`` and the licence where a notice
    or an SPDX tag names one), ``licenses`` the licences that rules named, in the order of
    the rules, each once; both are joined by commas and empty where nothing is known (null
    and empty texts too). Whole texts are read, however long. Repeated rows, a null doc_id
    and further columns change nothing; an empty table gives no rows.
    """
    known = F.create_map(*(F.lit(x) for i, s in SENTENCES for x in (s, str(i))))
    called = F.create_map(*(F.lit(x) for kv in _CALLED.items() for x in kv))
    rules = F.array(*(F.struct(F.lit(n).alias("name"), F.lit(_sequence(ids)).alias("ids")) for n, ids in ALL_RULES))
    low = F.lower(F.coalesce("text", F.lit("")))
    may = F.lit(False)
    for t in TRIGGERS:
        may = may | F.col("low").contains(t)
    none = F.array().cast("array<string>")
    marked = F.regexp_replace(F.regexp_replace("low", f"{BOUNDARY}|;", MARK), f"[^a-z0-9{MARK}]+", " ")
    said = F.transform(F.regexp_extract_all(marked, F.lit(KNOWN), F.lit(0)), lambda s: F.regexp_replace(s, f"[ {MARK}]+", " "))
    ids = F.transform(said, lambda s: F.coalesce(F.element_at(known, s), F.element_at(called, F.regexp_extract(s, CALLED, 1))))
    start = F.struct(F.concat(F.lit("<"), F.array_join("ids", "><"), F.lit(">")).alias("left"), none.alias("named"))

    def tried(acc, rule):
        hit = F.contains(acc["left"], rule["ids"])
        return F.struct(F.replace(acc["left"], rule["ids"], F.lit("#")).alias("left"), F.when(hit, F.array_union(acc["named"], F.array(rule["name"]))).otherwise(acc["named"]).alias("named"))

    named = F.when(F.size("ids") > 0, F.aggregate(rules, start, tried)["named"]).otherwise(none)
    found = docs.select("doc_id", low.alias("low")).select("doc_id", F.when(may, ids).otherwise(none).alias("ids"))
    found = found.select("doc_id", F.array_join("ids", ",").alias("sentence_ids"), named.alias("named"))
    return found.select("doc_id", "sentence_ids", F.array_join("named", ",").alias("licenses"), F.size("named").cast("long").alias("n_licenses"))


def _sql() -> str:
    """The same with marks and spaces doubled, so that a match can take one on either side."""
    maps = [f"MAP {{{', '.join(f'{k!r}: {v!r}' for k, v in m.items())}}}" for m in ({s: str(i) for i, s in SENTENCES}, _CALLED)]
    may = " OR ".join(f"contains(low, '{t}')" for t in TRIGGERS)
    pattern = f"[ {MARK}](?:{_LONG})[ {MARK}]|{MARK} *(?:{_SHORT}) *{MARK}"
    steps = [
        "t AS (SELECT doc_id, lower(coalesce(text, '')) AS low FROM documents)",
        f"u AS MATERIALIZED (SELECT doc_id, '{MARK}' || regexp_replace(regexp_replace(regexp_replace(low, '{BOUNDARY}|;', '{MARK}', 'g'), '[^a-z0-9{MARK}]+', ' ', 'g'), '([ {MARK}])', '\\1\\1', 'g') || '{MARK}' AS u FROM t WHERE {may})",
        f"m AS MATERIALIZED (SELECT {maps[0]} AS known, {maps[1]} AS called)",
        f"s AS MATERIALIZED (SELECT doc_id, list_transform(list_transform(regexp_extract_all(u, '{pattern}'), lambda x: trim(regexp_replace(x, '[ {MARK}]+', ' ', 'g'))), lambda x: coalesce(known[x], called[regexp_extract(x, '{CALLED}', 1)])) AS ids FROM u, m)",
        "r0 AS (SELECT doc_id, array_to_string(ids, ',') AS sentence_ids, '<' || array_to_string(ids, '><') || '>' AS l, []::VARCHAR[] AS named FROM s WHERE len(ids) > 0)",
    ]
    for k, (name, ids) in enumerate(ALL_RULES):
        q = _sequence(ids)
        steps.append(f"r{k + 1} AS MATERIALIZED (SELECT doc_id, sentence_ids, replace(l, '{q}', '#') AS l, CASE WHEN contains(l, '{q}') AND NOT list_contains(named, '{name}') THEN list_append(named, '{name}') ELSE named END AS named FROM r{k})")
    last = f"r{len(ALL_RULES)}"
    return "WITH " + ",\n".join(steps) + f"\nSELECT doc_id, sentence_ids, array_to_string(named, ',') AS licenses, len(named) AS n_licenses FROM {last} UNION ALL SELECT doc_id, '', '', 0 FROM t WHERE doc_id IS NULL OR doc_id NOT IN (SELECT doc_id FROM {last} WHERE doc_id IS NOT NULL)"


ORACLE = _sql()
