"""License scans: conditional compression.

The surroundings of cue words are cut out as candidate blocks. Each block is compressed by itself and with every
template as a zstandard raw-content dictionary; what the dictionary saves, as a share, ranks the
templates (ties: the template listed first). The leading templates are confirmed by exact wording differences: the
block's words are aligned with the template's, and the match counts if the template's words are
there but for at most TOLERANCE of them, with every word that tells licences apart (names, numbers) present. After a
match, what it leaves of the block on either side is compared anew, until no template is confirmed.

One row for each match: key, start and end in code points, the license, the form
(text, tag, notice, or name where a license is only named), the saving, words missing and words added, and whether the wording is
exact. Long licenses are known by their heads. Null and empty texts give no rows, a repeated row gives repeated rows, an empty table none. Blocks are windows of BLOCK characters around each cue, whatever the line ends and blank lines
in them, joined where they overlap, so that many cues do not multiply the work.
Every cue's window lies whole in some block; where joined blocks reach their longest and the next one overlaps
them, the match with the fewest words missing stays.
"""

from __future__ import annotations

import difflib
import functools
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_schema, read_table, tidied

#: Code points on either side of a cue that belong to its block.
BLOCK = 1600
#: Share of a template's words that may be missing.
TOLERANCE = 0.15
#: Templates whose wording is compared.
LEADERS = 4
#: Code points on either side of a cue that are compared by themselves where the whole block does not match.
NEAR = 120

#: Texts, heads of long texts, and notices as their publishers word them.
WORDINGS = [
    ("Apache-2.0", "notice", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "text", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("MIT", "notice", "Released under the MIT License"),
    ("MIT", "text", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("GPL-3.0", "notice", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "text", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "notice", "This work is licensed under the GNU General Public License, version 2"),
    ("GPL-2.0", "text", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "notice", "This work is licensed under the GNU Lesser General Public License, version 3"),
    ("AGPL-3.0", "notice", "This work is licensed under the GNU Affero General Public License, version 3"),
    ("BSD-2-Clause", "text", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("BSD-3-Clause", "text", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("BSD-3-Clause", "notice", "Licensed under the BSD 3-Clause License"),
    ("BSD-2-Clause", "notice", "Licensed under the BSD 2-Clause License"),
    ("ISC", "text", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MPL-2.0", "text", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("MPL-2.0", "notice", "Licensed under the Mozilla Public License, version 2.0"),
    ("Unlicense", "text", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("CC-BY-4.0", "notice", "Licensed under CC BY 4.0"),
    ("CC-BY-SA-4.0", "notice", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-NC-4.0", "notice", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-NC-SA-4.0", "notice", "Licensed under CC BY-NC-SA 4.0"),
    ("CC-BY-ND-4.0", "notice", "Licensed under CC BY-ND 4.0"),
    ("CC-BY-4.0", "text", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-SA-4.0", "text", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("CC-BY-NC-4.0", "text", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC0-1.0", "text", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("Apache-2.0", "text", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION 1. Definitions. \"License\" shall mean the terms and conditions for use, reproduction, and distribution as defined by Sections 1 through 9 of this document."),
    ("GPL-3.0", "text", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc. Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed."),
    ("GPL-2.0", "text", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1989, 1991 Free Software Foundation, Inc. Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed."),
    ("LGPL-3.0", "text", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc. Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed."),
    ("AGPL-3.0", "text", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007 Copyright (C) 2007 Free Software Foundation, Inc. Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed."),
    ("LGPL-2.1", "text", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "text", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("MPL-2.0", "text", "Mozilla Public License Version 2.0 1. Definitions 1.1. \"Contributor\" means each individual or legal entity that creates, contributes to the creation of, or owns Covered Software."),
    ("EPL-2.0", "text", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("BSL-1.0", "text", "Boost Software License - Version 1.0 - August 17th, 2003 Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:"),
    ("Zlib", "text", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software."),
    ("BSD-4-Clause", "text", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. All advertising materials mentioning features or use of this software must display the following acknowledgement:"),
]
#: Licenses, and the names by which notices call them.
NAMES = [
    ("Apache-2.0", ("Apache License, Version 2.0", "Apache License 2.0", "Apache License v2.0", "Apache License v2", "Apache 2.0 License")),
    ("MIT", ("MIT License", "MIT Licence", "MIT/X11 License", "Expat License")),
    ("GPL-2.0", ("GNU General Public License, version 2", "GNU General Public License v2.0", "GNU General Public License v2", "GNU GPL version 2", "GNU GPL v2", "GPL version 2", "GPL v2", "GPLv2")),
    ("GPL-3.0", ("GNU General Public License, version 3", "GNU General Public License v3.0", "GNU General Public License v3", "GNU GPL version 3", "GNU GPL v3", "GPL version 3", "GPL v3", "GPLv3")),
    ("LGPL-2.1", ("GNU Lesser General Public License, version 2.1", "GNU Lesser General Public License v2.1", "GNU LGPL version 2.1", "LGPL v2.1", "LGPLv2.1")),
    ("LGPL-3.0", ("GNU Lesser General Public License, version 3", "GNU Lesser General Public License v3", "GNU LGPL version 3", "LGPL v3", "LGPLv3")),
    ("AGPL-3.0", ("GNU Affero General Public License, version 3", "GNU Affero General Public License v3", "GNU AGPL version 3", "AGPL v3", "AGPLv3")),
    ("BSD-2-Clause", ("BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License", "FreeBSD License")),
    ("BSD-3-Clause", ("BSD 3-Clause License", "3-Clause BSD License", "New BSD License", "Modified BSD License")),
    ("BSD-4-Clause", ("BSD 4-Clause License", "4-Clause BSD License", "Original BSD License")),
    ("ISC", ("ISC License",)),
    ("MPL-1.1", ("Mozilla Public License, version 1.1", "Mozilla Public License 1.1", "MPL 1.1")),
    ("MPL-2.0", ("Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "Mozilla Public License v2.0", "MPL 2.0")),
    ("EPL-1.0", ("Eclipse Public License, version 1.0", "Eclipse Public License 1.0", "Eclipse Public License v1.0")),
    ("EPL-2.0", ("Eclipse Public License, version 2.0", "Eclipse Public License 2.0", "Eclipse Public License v2.0")),
    ("CDDL-1.0", ("Common Development and Distribution License, version 1.0", "Common Development and Distribution License 1.0")),
    ("EUPL-1.2", ("European Union Public Licence, version 1.2", "European Union Public License 1.2")),
    ("Artistic-2.0", ("Artistic License 2.0", "Artistic License, version 2.0")),
    ("OFL-1.1", ("SIL Open Font License, Version 1.1", "SIL Open Font License 1.1")),
    ("BSL-1.0", ("Boost Software License, Version 1.0", "Boost Software License 1.0")),
    ("Zlib", ("zlib License",)),
    ("WTFPL", ("Do What The F*ck You Want To Public License", "WTFPL")),
    ("CC0-1.0", ("CC0 1.0 Universal", "Creative Commons Zero 1.0", "CC0 1.0")),
    ("CC-BY-4.0", ("CC BY 4.0", "Creative Commons Attribution 4.0")),
    ("CC-BY-SA-4.0", ("CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0")),
    ("CC-BY-NC-4.0", ("CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0")),
    ("CC-BY-ND-4.0", ("CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0")),
    ("CC-BY-NC-SA-4.0", ("CC BY-NC-SA 4.0", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0")),
    ("CC-BY-NC-ND-4.0", ("CC BY-NC-ND 4.0", "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0")),
]
#: Notices are a verb and a name; the article may stand between them.
VERBS = ("Licensed under", "Released under", "Distributed under", "Available under", "Licensed under the terms of", "Released under the terms of", "Distributed under the terms of")


def templates() -> list[tuple[str, str, str]]:
    """(license, form, wording): the fixed wordings, then by rule for each license its tag, its notices and its names."""
    out = list(WORDINGS)
    for name, calls in NAMES:
        out.append((name, "tag", f"SPDX-License-Identifier: {name}"))
        for call in calls:
            out += [(name, "notice", f"{verb}{the} {call}") for verb in VERBS for the in (" the", "")]
            out.append((name, "name", call))
    return list({(n, " ".join(w for w, _, _ in words_of(t))): (n, f, t) for n, f, t in reversed(out)}.values())[::-1]


#: Words without which a wording says something else.
TELLING = frozenset(
    "apache mit expat x11 gnu gpl gplv2 gplv3 lgpl lgplv2 lgplv3 agpl agplv3 lesser affero bsd clause simplified freebsd new modified original isc mozilla mpl eclipse epl common development european artistic sil font boost zlib wtfpl "
    "creative commons cc cc0 zero by sa nc nd attribution sharealike noncommercial noderivatives universal spdx 1 2 3 4 0 v1 v2 v3 advertising".split()
)

CUE = re.compile(r"licen[sc]|permission (?:is|to)|redistribut|free software|source code form|unencumbered|waived all|(?<![A-Za-z])[LA]?GPL|(?<![A-Za-z])CC[ 0-]|WTFPL|(?<![A-Za-z])MPL|Creative Commons", re.I | re.A)
CUE_PARTS = ("icen", "ermission", "edistribut", "software", "ource code", "nencumbered", "aived", "GPL", "CC", "WTFPL", "MPL", "ommons")
WORD = re.compile(r"[A-Za-z0-9]+")


def words_of(text: str) -> list[tuple[str, int, int]]:
    """Words in lower case with their places in the text as it is."""
    return [(m.group().lower(), m.start(), m.end()) for m in WORD.finditer(text)]


def blocks(text: str) -> list[tuple[int, int]]:
    """Windows of BLOCK characters around the cues, across line ends and blank lines; overlapping ones are one, up to four windows' length."""
    if not any(p in text for p in CUE_PARTS) and not any(p in text.lower() for p in CUE_PARTS):
        return []
    out: list[list[int]] = []
    for m in CUE.finditer(text):
        lo, hi = max(0, m.start() - BLOCK), min(len(text), m.end() + BLOCK)
        if out and lo <= out[-1][1] and hi - out[-1][0] <= 4 * BLOCK:
            out[-1][1] = hi
        else:
            out.append([lo, hi])
    return [(a, b) for a, b in out]


@functools.lru_cache(maxsize=4)
def catalogue(extra: tuple[tuple[str, str, str], ...] = ()):
    """For each template its license, form, words, their counts and its compressor; the plain compressor; and templates by the word that the block must have."""
    own, by_word = [], {}
    for name, form, text in [*templates(), *extra]:
        d = zstandard.ZstdCompressionDict(text.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        words = [w for w, _, _ in words_of(text)]
        must = max((w for w in words if w in TELLING), key=len, default=None)
        by_word.setdefault(must, []).append(len(own))
        own.append((name, form, words, zstandard.ZstdCompressor(level=3, dict_data=d, write_content_size=False, write_checksum=False), Counter(words)))
    return own, zstandard.ZstdCompressor(level=3, write_content_size=False, write_checksum=False), by_word


#: The templates in use: scan() may be given more.
_EXTRA: tuple = ()


def compressors():
    own, plain, _ = catalogue(_EXTRA)
    return plain, own


def possible(block: str) -> list[int]:
    """Templates of whose words the block has enough, in whatever order, to be confirmed: no other can be."""
    have = Counter(w for w, _, _ in words_of(block))
    own, _, by_word = catalogue(_EXTRA)
    out = []
    for i in (i for w, some in by_word.items() if w is None or w in have for i in some):
        want = own[i][4]
        room = TOLERANCE * len(own[i][2])
        lost = 0
        for w, c in want.items():
            if have[w] < c:
                lost += c - have[w]
                if lost > room or (w in TELLING and not have[w]):
                    break
        else:
            out.append(i)
    return sorted(out)


def savings(block: str, templates: list[int]) -> list[tuple[float, int]]:
    """(share saved, template) from the best; equal savings in the order of the templates."""
    raw = block.encode()
    plain, own = compressors()
    size = len(plain.compress(raw))
    return sorted(((1 - len(own[i][3].compress(raw)) / size, i) for i in templates), key=lambda x: (-x[0], x[1]))


def confirmed(block: str, template: int) -> tuple[int, int, int, int] | None:
    """(first and last code point, words missing, words added) of the best alignment, or None if the wording differs too much."""
    have = words_of(block)
    want = compressors()[1][template][2]
    match = difflib.SequenceMatcher(None, [w for w, _, _ in have], want, autojunk=False)
    main = match.find_longest_match(0, len(have), 0, len(want))
    # words far from the longest run are chance matches or another copy: its neighbourhood is aligned
    if not main.size:
        return None
    slack = max(3, len(want) // 4)
    have = have[max(0, main.a - main.b - slack) : main.a - main.b + len(want) + slack]
    match.set_seq1([w for w, _, _ in have])
    parts = [b for b in match.get_matching_blocks() if b.size]
    main = max(parts, key=lambda b: b.size)
    parts = [b for b in parts if abs((b.a - b.b) - (main.a - main.b)) <= slack]
    found = sum(b.size for b in parts)
    missing = len(want) - found
    lost = {want[i] for i in range(len(want)) if not any(b.b <= i < b.b + b.size for b in parts)}
    if missing > TOLERANCE * len(want) or lost & TELLING:
        return None
    first, last = parts[0].a, parts[-1].a + parts[-1].size
    # a name that goes on (BY-NC where the template has BY) is another license
    added = last - first - found
    if any(w in TELLING for w, _, _ in have[first:last] if w not in want):
        return None
    return have[first][1], have[last - 1][2], missing, added


def best_of(block: str) -> tuple[float, int, tuple[int, int, int, int]] | None:
    """Of the leading templates by saving, the confirmed one with the fewest differences; of equal ones the longest."""
    best = None
    templates = possible(block)
    for saved, i in savings(block, templates)[:LEADERS] if templates else []:
        c = confirmed(block, i)
        if c and saved > 0 and (best is None or (c[2:], c[0] - c[1]) < (best[2][2:], best[2][0] - best[2][1])):
            best = (saved, i, c)
    return best


def found_in(block: str) -> list[tuple[float, int, tuple[int, int, int, int]]]:
    """Matches of the block and, after each, of what it leaves on either side, until nothing more is confirmed."""
    found = []
    cues = [(m.start(), m.end()) for m in CUE.finditer(block)]
    todo = [(0, len(block))]
    while todo:
        lo, hi = todo.pop()
        inside = [(s, e) for s, e in cues if lo <= s < hi]
        if not inside or not possible(block[lo:hi]):
            continue
        # a short notice in a long block saves little there: then the neighbourhoods of its cues
        parts = [(lo, hi), *((max(lo, s - width), min(hi, e + width)) for s, e in inside for width in (NEAR, BLOCK))]
        for a, b in parts:
            if match := best_of(block[a:b]):
                saved, i, (s, e, missing, added) = match
                found.append((saved, i, (s + a, e + a, missing, added)))
                todo += [(lo, s + a), (e + a, hi)]
                break
    return found


def scan(text: str | None) -> list[tuple]:
    kept: list[tuple[float, int, tuple[int, int, int, int]]] = []
    for lo, hi in blocks(text or ""):
        for saved, i, (s, e, missing, added) in found_in(text[lo:hi]):
            s, e = s + lo, e + lo
            # blocks may overlap: the same text twice, or cut by the end of the first
            same = [x for x in kept if x[2][0] < e and s < x[2][1]]
            if all((missing, added) < x[2][2:] for x in same):
                kept = [x for x in kept if x not in same] + [(saved, i, (s, e, missing, added))]
    out = []
    for saved, i, (s, e, missing, added) in sorted(kept, key=lambda x: x[2]):
        name, form, *_ = compressors()[1][i]
        out.append((s, e, name, form, round(saved, 4), missing, added, missing == 0 and added == 0))
    return out


FOUND = "start int, end int, license string, form string, saving double, missing int, added int, exact boolean"


def scan_licenses(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    src = docs.select(F.col(key), F.col(text).cast("string").alias("_text"))
    schema = docs.sparkSession.createDataFrame([], f"`{key}` {src.schema[0].dataType.simpleString()}, {FOUND}").schema
    arrow = arrow_schema(schema)

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(k.as_py(), *r) for k, t in zip(b.column(0), b.column(1), strict=True) for r in scan(t.as_py())]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), arrow, strict=True)], schema=arrow)

    return src.mapInArrow(run, schema)


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(read_table(spark, sf_dir, "documents"))
