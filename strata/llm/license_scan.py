"""Licence recognition by sentence rules.

A text that holds any of a few words, of which every licence has one, is unwrapped and cut into sentences, which are normalised and mapped to identifiers of known
licence sentences; what is unknown is left out. A sentence with names in it is known as a template with one free slot, of any length. The identifiers of a text, in order,
are then matched against licence rules, which are sequences of identifiers that must follow each other. Rules are tried in their order, and what a rule has used no
later rule can use. All steps are built-in expressions on the row.

Defined cases: null and empty texts have no sentences; a text without known sentences has no licence; known
sentences that no rule uses are counted as left over. Sentences are counted as printed, before lines are joined.
"""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import ascii_lower

#: Identifiers and sentences as licences and notices print them.
SENTENCES = [
    ("ApacheLicensed", "Licensed under the Apache License, Version 2.0"),
    ("ApacheLicensed", "Licensed under the Apache License, Version 2.0 (the \"License\")"),
    ("ApacheLicensed", "The ASF licenses this file to You under the Apache License, Version 2.0 (the \"License\")"),
    ("ApacheLicensed", "This file is licensed to You under the Apache License, Version 2.0 (the \"License\")"),
    ("ApacheTitle", "Apache License Version 2.0, January 2004"),
    ("ApacheTitle", "Apache License Version 2.0, January 2004 http"),
    ("ApacheTitle", "Apache License Version 2.0, January 2004 https"),
    ("ApacheMayNotUse", "you may not use this file except in compliance with the License"),
    ("ApacheCopy", "You may obtain a copy of the License at"),
    ("ApacheCopy", "You may obtain a copy of the License at http"),
    ("ApacheCopy", "You may obtain a copy of the License at https"),
    ("ApacheUnless", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied"),
    ("ApacheUnless", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS"),
    ("ApacheSee", "See the License for the specific language governing permissions and limitations under the License"),
    ("MITReleased", "Released under the MIT License"),
    ("MITLicensed", "Licensed under the MIT License"),
    ("MITPermission", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("MITPermission", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions"),
    ("MIT0Permission", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"),
    ("MITNotice", "The above copyright notice and this permission notice (including the next paragraph) shall be included in all copies or substantial portions of the Software"),
    ("MITNotice", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"),
    ("MITAsIs", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT"),
    ("MITAsIs", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NON-INFRINGEMENT"),
    ("MITLiability", "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE"),
    ("ISCPermission", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("ISCPermission", "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("0BSDPermission", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("ISCAsIs", "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS"),
    ("ZlibPermission", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
    ("BoostPermission", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following"),
    ("BoostLicensed", "Distributed under the Boost Software License, Version 1.0"),
    ("GPL3Licensed", "This work is licensed under the GNU General Public License, version 3"),
    ("GPLFree", "This program is free software"),
    ("GPLFree", "This library is free software"),
    ("GPLFree", "This file is free software"),
    ("GPL3Redistribute", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("GPL2Redistribute", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 2 of the License, or (at your option) any later version"),
    *[
        (f"{family}{number}{kind}", f"you can redistribute it and/or modify it under the terms of the GNU {name} Public License as published by the Free Software Foundation, {words}")
        for family, name, number, version in [("GPL", "General", "2", "2"), ("GPL", "General", "3", "3"), ("LGPL", "Lesser General", "21", "2.1"), ("LGPL", "Lesser General", "3", "3"), ("AGPL", "Affero General", "3", "3")]
        for kind, words in [("Only", f"version {version} of the License"), ("Only", f"version {version}"), ("Redistribute", f"either version {version} of the License, or (at your option) any later version"), ("Redistribute", f"either version {version} of the License, or any later version")]
    ],
    ("GPL2Only", "you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation"),
    ("GPLHope", "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY"),
    ("GPLHope", "This file is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY"),
    ("GPLHope", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY"),
    ("BSDRedistribution", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSDSource", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer"),
    ("BSDBinary", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution"),
    ("BSDEndorse", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("BSDEndorse", "The name of the author may not be used to endorse or promote products derived from this software without specific prior written permission"),
    ("BSDAsIs", "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED"),
    *[(name, f"This work is licensed under {article} Creative Commons {terms} 4.0 International License") for name, terms in [("CCBY4", "Attribution"), ("CCBYSA4", "Attribution-ShareAlike"), ("CCBYNC4", "Attribution-NonCommercial")] for article in ("a", "the")],
    ("CCBYNC4", "Licensed under CC BY-NC 4.0"),
    ("CCBY4", "Licensed under CC BY 4.0"),
    ("CCBYSA4", "Licensed under CC BY-SA 4.0"),
    ("CC0Title", "CC0 1.0 Universal"),
    ("CC0Title", "Creative Commons Legal Code CC0 1.0 Universal"),
    ("CC0Title", "Creative Commons CC0 1.0 Universal"),
    ("CC0Waiver", "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide"),
    *[
        (f"{name}Title", f"{title} {version}")
        for name, title, versions in [
            ("GPL3", "GNU GENERAL PUBLIC LICENSE", ["Version 3", "Version 3, 29 June 2007"]),
            ("GPL2", "GNU GENERAL PUBLIC LICENSE", ["Version 2", "Version 2, June 1991"]),
            ("LGPL3", "GNU LESSER GENERAL PUBLIC LICENSE", ["Version 3", "Version 3, 29 June 2007"]),
            ("LGPL21", "GNU LESSER GENERAL PUBLIC LICENSE", ["Version 2.1", "Version 2.1, February 1999"]),
            ("AGPL3", "GNU AFFERO GENERAL PUBLIC LICENSE", ["Version 3", "Version 3, 19 November 2007"]),
            ("MPL2", "Mozilla Public License", ["Version 2.0"]),
            ("EPL2", "Eclipse Public License", ["- v 2.0", "v 2.0", "Version 2.0"]),
            ("OFL11", "SIL OPEN FONT LICENSE", ["Version 1.1", "Version 1.1 - 26 February 2007"]),
        ]
        for version in versions
    ],
    ("EPL2Available", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at"),
    ("EPL2Available", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"),
    ("EPL2Available", "This program and the accompanying materials are made available under the terms of the Eclipse Public License v2.0 which accompanies this distribution, and is available at"),
    ("OFL11Licensed", "This Font Software is licensed under the SIL Open Font License, Version 1.1"),
    ("SPDXTag", "SPDX-License-Identifier"),
    *[
        (f"SPDX {name}", name)
        for name in [
            "0BSD", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-SA-4.0",
            "CC0-1.0", "EPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "ISC", "LGPL-2.1-only", "LGPL-2.1-or-later",
            "LGPL-3.0-only", "LGPL-3.0-or-later", "MIT", "MIT-0", "MPL-2.0", "OFL-1.1", "Unlicense", "Zlib",
        ]
    ],
    ("MPL2", "This Source Code Form is subject to the terms of the Mozilla Public License, v"),
    ("MPL2Version", "2.0"),
]

#: Licences and the sentences they are known by, the more specific before the less.
RULES = [
    *[(name, ["SPDXTag", f"SPDX {name}"]) for name in (x[5:] for x, _ in SENTENCES if x.startswith("SPDX "))],
    ("Apache-2.0", ["ApacheTitle"]),
    *[
        (name, [f"{title}Title"])
        for name, title in [("GPL-3.0-only", "GPL3"), ("GPL-2.0-only", "GPL2"), ("LGPL-3.0-only", "LGPL3"), ("LGPL-2.1-only", "LGPL21"), ("AGPL-3.0-only", "AGPL3"), ("MPL-2.0", "MPL2"), ("EPL-2.0", "EPL2"), ("OFL-1.1", "OFL11"), ("CC0-1.0", "CC0")]
    ],
    ("CC0-1.0", ["CC0Waiver"]),
    ("EPL-2.0", ["EPL2Available"]),
    ("OFL-1.1", ["OFL11Licensed"]),
    ("Apache-2.0", ["ApacheLicensed", "ApacheMayNotUse", "ApacheCopy", "ApacheUnless", "ApacheSee"]),
    ("GPL-3.0-or-later", ["GPLFree", "GPL3Redistribute", "GPLHope"]),
    ("GPL-2.0-or-later", ["GPLFree", "GPL2Redistribute", "GPLHope"]),
    *[
        (name, ["GPLFree", sentence, "GPLHope"])
        for name, sentence in [("LGPL-2.1-or-later", "LGPL21Redistribute"), ("LGPL-3.0-or-later", "LGPL3Redistribute"), ("AGPL-3.0-or-later", "AGPL3Redistribute"), ("GPL-2.0-only", "GPL2Only"), ("GPL-3.0-only", "GPL3Only")]
    ],
    ("BSD-3-Clause", ["BSDRedistribution", "BSDSource", "BSDBinary", "BSDEndorse", "BSDAsIs"]),
    ("BSD-2-Clause", ["BSDRedistribution", "BSDSource", "BSDBinary", "BSDAsIs"]),
    ("BSD-3-Clause", ["BSDRedistribution", "BSDSource", "BSDBinary", "BSDEndorse"]),
    ("BSD-2-Clause", ["BSDRedistribution", "BSDSource", "BSDBinary"]),
    ("MIT", ["MITPermission", "MITNotice", "MITAsIs", "MITLiability"]),
    ("MIT", ["MITPermission", "MITNotice", "MITAsIs"]),
    ("MIT-0", ["MIT0Permission", "MITAsIs", "MITLiability"]),
    ("ISC", ["ISCPermission", "ISCAsIs"]),
    ("ISC", ["ISCPermission"]),
    ("0BSD", ["0BSDPermission", "ISCAsIs"]),
    ("Zlib", ["ZlibPermission"]),
    ("Unlicense", ["Unlicense"]),
    ("BSL-1.0", ["BoostPermission"]),
    ("BSL-1.0", ["BoostLicensed"]),
    ("Apache-2.0", ["ApacheLicensed"]),
    ("MIT", ["MITReleased"]),
    ("MIT", ["MITLicensed"]),
    ("GPL-3.0-only", ["GPL3Licensed"]),
    ("GPL-3.0-or-later", ["GPLFree", "GPL3Redistribute"]),
    ("GPL-2.0-or-later", ["GPLFree", "GPL2Redistribute"]),
    *[
        (name, [sentence])
        for name, sentence in [
            ("GPL-3.0-or-later", "GPL3Redistribute"), ("GPL-2.0-or-later", "GPL2Redistribute"), ("LGPL-2.1-or-later", "LGPL21Redistribute"), ("LGPL-3.0-or-later", "LGPL3Redistribute"),
            ("AGPL-3.0-or-later", "AGPL3Redistribute"), ("GPL-2.0-only", "GPL2Only"), ("GPL-3.0-only", "GPL3Only"), ("LGPL-2.1-only", "LGPL21Only"), ("LGPL-3.0-only", "LGPL3Only"), ("AGPL-3.0-only", "AGPL3Only"),
        ]
    ],
    ("CC-BY-NC-4.0", ["CCBYNC4"]),
    ("CC-BY-4.0", ["CCBY4"]),
    ("CC-BY-SA-4.0", ["CCBYSA4"]),
    ("MPL-2.0", ["MPL2", "MPL2Version"]),
]

#: Beginnings of known sentences, as printed, and notices that are often printed without a full stop.
_OPENINGS = sorted({r"[ \t\r]+".join(re.escape(w) for w in sentence.split(" ")[:3]) for _, sentence in SENTENCES if sentence.count(" ") > 2 and sentence[0].isupper()})
_NOTICES = sorted({re.escape(sentence) for _, sentence in SENTENCES if re.match("(Licensed|Released|Distributed|This work is licensed) under", sentence)}, key=len, reverse=True)
#: Of these every known sentence holds one, in some case, but for the names behind a tag, whose tag does.
MARKS = ["licens", "licenc", "permission", "permitted", "redistribut", "free software", "warrant", "liable", "creative commons", "cc0", "cc by", "public domain", "2.0"]
#: What comment lines begin with.
_LEAD = r"[ \t#*/%;-]*"

#: A wrapped line goes on in the next, whatever that begins with; marks of comments at its beginning are left out. Blank lines
#: and list marks end a sentence, and so does a line end before a known sentence or after a notice. The last two give
#: names of holders and a mark one form.
WRAPS = [
    (r"\r\n", "\n"),
    (r"(?i)(SPDX-License-Identifier:[^\n]*)\n", r"\1;"),
    (r",[ \t\r]*\n[ \t#*/;]*", ", "),
    (rf"\n{_LEAD}\n[ \t\n#*/%;-]*", ";"),
    (r"\n[ \t#*/]*(?:[0-9]{1,2}[.)]|\([0-9a-z]{1,3}\)|-)[ \t]+", ";"),
    (rf"\n{_LEAD}([a-z(\"])", r" \1"),
    (rf"(?i)((?:{'|'.join(_NOTICES)}))[ \t\r]*\n", r"\1;"),
    (rf"\n{_LEAD}((?:{'|'.join(_OPENINGS)}))", r";\1"),
    (rf"\n{_LEAD}", " "),
    (r"(?i)neither +the +names? +of [^\n;:!?]*? nor +the +names? +of ", "Neither the name of the copyright holder nor the names of "),
    (r"(?i)the +name +of [^\n;:!?]*? may +not +be +used +to +endorse ", "The name of the author may not be used to endorse "),
    (r"(?i)Software +Foundation;[ \t]*(either version|version) ", r"Software Foundation, \1 "),
]
#: Ends of sentences: other line ends, semicolons and colons, and full stops, exclamation and question marks before white space.
SENTENCE_END = r"[\n;:]|[.!?](?:[ \t\r]|$)"
NOISE = r"[^a-z0-9.]+"


def normalise(sentence: str) -> str:
    return re.sub(r" ?\.$", "", re.sub(NOISE, " ", sentence.lower()).strip())


def normalised(sentence: Column) -> Column:
    """Lower case (A-Z), anything but letters, digits and inner full stops as one space, trimmed."""
    return F.regexp_replace(F.trim(F.regexp_replace(ascii_lower(sentence), NOISE, " ")), r" ?\.$", "")


def sentences(text: Column) -> Column:
    """The sentences of a text whose lines are joined."""
    for pattern, by in WRAPS:
        text = F.regexp_replace(text, pattern, by.replace("\\1", "$1"))
    return F.split(text, SENTENCE_END)


def known_parts(table: list[tuple[str, str]]) -> list[tuple[str, list[str]]]:
    """Identifiers with the normalised sentences that an entry of the table consists of."""
    return [(name, list(filter(None, (normalise(s) for s in re.split(SENTENCE_END, sentence + "\n"))))) for name, sentence in table]


def known_ids(parts: Column, table: list[tuple[str, str]] = SENTENCES) -> Column:
    """Identifiers of the known ones of some sentences, in order. A sentence is normalised only where its first word is
    one that a known sentence begins with."""
    known = {part: name for name, parts in known_parts(table) for part in parts}
    lookup = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    begins = "|".join(sorted({re.escape(k.split(" ")[0]) for k in known}))
    opening = rf"(?i)^[^a-z0-9.]*(?:{begins})(?![a-z0-9.])"
    likely = F.filter(parts, lambda s: s.rlike(opening))
    found = F.transform(likely, lambda s: F.coalesce(lookup[normalised(s)], F.lit("")))
    return F.array_remove(found, "")


def scan_licenses(docs: DataFrame, key: str, text: str, rules: list[tuple[str, list[str]]] = RULES) -> DataFrame:
    """One row per row of docs: key, n_sentences (with a letter or digit), sentence_ids, licenses (names, sorted, each
    once) and n_left (known sentences that no rule used)."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    small = ascii_lower(body)
    marked = reduce(or_, [F.contains(small, F.lit(mark)) for mark in MARKS])
    rows = docs.select(
        F.col(f"`{key}`").alias(key),
        F.size(F.filter(F.split(body, SENTENCE_END), lambda s: s.rlike("[A-Za-z0-9]"))).cast("bigint").alias("n_sentences"),
        # Nothing is unwrapped or cut in other texts.
        F.when(marked, known_ids(sentences(body))).otherwise(F.array().cast("array<string>")).alias("sentence_ids"),
    )
    rest, names = F.concat(F.lit(" "), F.concat_ws("  ", "sentence_ids"), F.lit(" ")), []
    for number, (name, ids) in enumerate(rules):
        run = "  ".join(ids)
        rows = rows.withColumn(f"_{number}", F.contains(rest, F.lit(f" {run} ")))
        rest = F.replace(rest, F.lit(f" {run} "), F.lit(" \t "))
        names.append(F.when(F.col(f"_{number}"), name))
    rows = rows.withColumn("_rest", rest)
    left = F.size(F.filter(F.split("_rest", r"\s+"), lambda s: s != "")).cast("bigint")
    licenses = F.array_sort(F.array_distinct(F.array_compact(F.array(*names))))
    return rows.select(key, "n_sentences", "sentence_ids", licenses.alias("licenses"), left.alias("n_left"))
