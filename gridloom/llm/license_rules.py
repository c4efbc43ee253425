"""Licence scan by sentence rules: normalised sentences become identifiers of known licence sentences, and the sequence of
identifiers is matched against ordered licence rules. DataFrame functions only; one pass over the texts, no shuffle.

A sentence ends at one of ``.!?`` and white space, at a colon that ends its line, and at a line that holds nothing but
comment marks. A line break alone is white space, and comment marks at the start of a line are dropped with all other
punctuation, so that wrapped and commented notices read like plain ones. A sentence is normalised by lower-casing A-Z and
turning every run of other characters than a-z and 0-9 into one space. It gets the identifiers of the known sentences that
it consists of or holds whole, but for those that stand in a longer one found; other sentences are left out of the sequence.
Names of holders in their places count as the ones the text is known by; a notice with a version may go on with "or later" in any of its forms, and one
that is denied names no licence. A sentence that two licences share means neither by itself.
Rules are tried longest first; a rule fits where its identifiers stand next to each other in what the earlier rules have
left, and takes all such places.

Defined cases: null and empty texts have no sentence and no licence; a repeated licence is named once; an identifier that no
rule takes counts as unmatched; repeated rows are scanned each on its own; an empty table gives no rows; columns other
than the key and the text are ignored, whatever their names.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
END = r"""[.!?]+["')\]]*[ \t\r\n]|:[ \t\r]*\n|\n[ \t\r#*/;>%|!-]*\n"""
# What a sentence is turned into before it is looked up, in this order: a plus behind a version of the GPL, names of holders in their places, and denials.
PLUS = (r"(gpl[v -]*(?:version )?[0-9][0-9.]*)\+", "or later")
SLOTS = (
    (r"\bneither the names? [a-z0-9 \x01]{1,150}?[ \x01]nor the names of (?:its|their|other) contributors\b", "neither the name of the copyright holder nor the names of its contributors"),
    (r"\bthis software is provided by [a-z0-9 \x01]{1,150}?[ \x01]as is and any express\b", "this software is provided by the copyright holders and contributors as is and any express"),
    (r"\bin no event shall [a-z0-9 \x01]{1,150}?[ \x01]be liable for any direct\b", "in no event shall the copyright holder or contributors be liable for any direct"),
    (r"\b(?:not|never) (?:licensed|released|distributed|available|dedicated) (?:to the public domain )?under (?:the terms of )?", "not "),
)
# A text without any of these words holds no known sentence.
HINTS = ("licen", "copyright", "permission", "warrant", "distribut", "software", "reserved", "released", "available", "dedicated", "terms", "gpl", "mpl")

# Texts and notices of public licences. Each sentence is known; the whole sequence is a rule.
TEXTS = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "MIT-0": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so.""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "0BSD": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.""",
    "BSL-1.0": """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:

The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.""",
    "Unlicense": """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.""",
    "PostgreSQL": """Permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, and without a written agreement is hereby granted, provided that the above copyright notice and this paragraph and the following two paragraphs appear in all copies.""",
    "GPL-2.0-or-later": """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.

You should have received a copy of the GNU General Public License along with this program.""",
    "GPL-3.0-or-later": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.

You should have received a copy of the GNU General Public License along with this program.""",
    "LGPL-2.1-or-later": """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.

This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details.""",
    "LGPL-3.0-or-later": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details.""",
    "AGPL-3.0-or-later": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details.""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.

If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "EPL-2.0": """This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0.""",
    "CC0-1.0": """To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide. This software is distributed without any warranty.""",
}
# What licences are called in notices.
NAMES = {
    "MIT": ("MIT License", "MIT licence", "Expat License"), "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache-2.0 License"),
    "BSD-2-Clause": ("BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License"), "BSD-3-Clause": ("BSD 3-Clause License", "3-Clause BSD License", "New BSD License", "Modified BSD License"),
    "ISC": ("ISC License",), "Zlib": ("zlib License",), "BSL-1.0": ("Boost Software License, Version 1.0", "Boost Software License 1.0"), "MPL-2.0": ("Mozilla Public License 2.0", "Mozilla Public License, version 2.0", "Mozilla Public License, v. 2.0"),
    "EPL-2.0": ("Eclipse Public License 2.0", "Eclipse Public License v2.0", "Eclipse Public License, version 2.0"), "Unlicense": ("Unlicense",),
    "GPL-2.0-only": ("GNU General Public License, version 2", "GNU General Public License v2", "GNU GPL version 2", "GNU GPLv2", "GPLv2"),
    "GPL-3.0-only": ("GNU General Public License, version 3", "GNU General Public License v3", "GNU GPL version 3", "GNU GPLv3", "GPLv3"),
    "GPL-2.0-or-later": ("GNU General Public License, version 2 or later", "GNU General Public License, version 2, or (at your option) any later version", "GPLv2+"),
    "GPL-3.0-or-later": ("GNU General Public License, version 3 or later", "GNU General Public License, version 3, or (at your option) any later version", "GPLv3+"),
    "LGPL-2.1-only": ("GNU Lesser General Public License, version 2.1", "LGPL 2.1", "LGPLv2.1"), "LGPL-3.0-only": ("GNU Lesser General Public License, version 3", "LGPLv3"), "AGPL-3.0-only": ("GNU Affero General Public License, version 3", "AGPLv3"),
    "CC0-1.0": ("CC0 1.0", "Creative Commons Zero"), "CC-BY-4.0": ("CC BY 4.0", "Creative Commons Attribution 4.0 International License"), "CC-BY-SA-4.0": ("CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    "CC-BY-NC-4.0": ("CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"), "CC-BY-ND-4.0": ("CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License"),
}
# What stands before a name in a notice.
LEADS = ("licensed under", "released under", "distributed under", "available under", "dedicated to the public domain under", "under the terms of")
# What turns a version into that version and those after it.
LATER = (" or later", " or newer", " or any later version", ", or (at your option) any later version", " or (at your option) any later version", " or later version", " or later versions", " or above")
# Sentences that mean a licence by themselves, as (licence, sentence of its text), and other known sentences.
KEYS = {"MIT": (0,), "BSD-3-Clause": (3,), "ISC": (0,), "Zlib": (2,), "BSL-1.0": (0,), "Unlicense": (0,), "PostgreSQL": (0,), "GPL-2.0-or-later": (0,), "GPL-3.0-or-later": (0,), "LGPL-2.1-or-later": (0,), "LGPL-3.0-or-later": (0,), "AGPL-3.0-or-later": (0,), "MPL-2.0": (0,), "EPL-2.0": (0,), "CC0-1.0": (0,)}
OTHERS = ("All rights reserved.",)


def normalised(text: str) -> list[str]:
    """A text's normalised sentences, as the columns make them."""
    lower = re.sub(PLUS[0], rf"\1 {PLUS[1]} ", text.translate(str.maketrans(UPPER, LOWER)))
    plain = re.sub("[^a-z0-9\x01]+", " ", re.sub(END, "\x01", lower))
    for slot, words in SLOTS:
        plain = re.sub(slot, words, plain)
    return [x for x in (x.strip(" ") for x in plain.split("\x01")) if len(x) > 5]


def known_sentences() -> tuple[dict[str, str], list[tuple[str, tuple[str, ...]]]]:
    """Identifiers by normalised sentence, and the rules, longest first."""
    ids: dict[str, str] = {}
    rules: list[tuple[str, tuple[str, ...]]] = []
    for name, text in TEXTS.items():
        seq = tuple(ids.setdefault(x, f"{name.lower()}/{i}") for i, x in enumerate(normalised(text)))
        rules.append((name, seq))
    shared = Counter(x for _, seq in rules for x in set(seq))
    # A sentence that other licences have too means none of them by itself.
    rules += [(name, (seq[i],)) for name, seq in rules for i in KEYS.get(name, ()) if len(seq) > 1 and shared[seq[i]] == 1]
    spdx = sorted({*TEXTS, *NAMES, *(x.replace("-only", "-or-later") for x in NAMES)})
    called = {name: list(found) for name, found in NAMES.items()}
    for name in NAMES:
        if name.endswith("-only"):
            called.setdefault(later := name.replace("-only", "-or-later"), [])
            called[later] += [f"{x}{more}" for x in NAMES[name] for more in LATER]
    notices = [(name, f"{lead}{the}{x}") for name in called for x in called[name] for lead in LEADS for the in (" ", " the ", " a ")]
    notices += [(name, f"SPDX-License-Identifier: {name}") for name in spdx]
    for name, phrase in notices:
        ids.setdefault(" ".join(normalised(phrase)), f"{name.lower()}/notice")
    rules += [(name, (f"{name.lower()}/notice",)) for name in spdx]
    for x in OTHERS:
        ids.setdefault(normalised(x)[0], "other/" + normalised(x)[0].replace(" ", "-"))
    return ids, sorted(rules, key=lambda r: -len(r[1]))


SENTENCES, RULES = known_sentences()
assert all(any(h in x for h in HINTS) for x in SENTENCES)

def scan_licenses(docs: DataFrame, sentences: Mapping[str, str] = SENTENCES, rules: Sequence[tuple[str, Sequence[str]]] = RULES, hints: Sequence[str] = HINTS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (key, sentence_ids array, licenses array sorted, unmatched long: identifiers no rule took). Each known
    sentence holds one of ``hints``."""
    body = F.coalesce(F.col(text), F.lit(""))
    low = F.lower(body)
    some = F.lit(False)
    for h in hints:  # a quick look first: most texts hold none
        some = some | F.contains(low, F.lit(h))
    plain = F.regexp_replace(F.regexp_replace(F.translate(body, UPPER, LOWER), PLUS[0], f"$1 {PLUS[1]} "), END, "\x01")
    plain = F.regexp_replace(plain, "[^a-z0-9\x01]+", " ")
    for slot, words in SLOTS:
        plain = F.regexp_replace(plain, slot, words)
    parts = F.transform(F.split(plain, "\x01"), lambda x: F.concat(F.lit(" "), F.trim(x), F.lit(" ")))
    likely = F.filter(parts, lambda x: F.greatest(*(F.contains(x, F.lit(h)) for h in hints)))
    # Known sentences are tried only where the two words they begin with stand.
    begins: dict[str, list[tuple[str, str]]] = {}
    for words, name in sentences.items():
        begins.setdefault(" ".join(words.split(" ")[:2]), []).append((words, name))
    constant = lambda rows, kind: F.from_json(F.lit(json.dumps(rows)), kind)  # noqa: E731  one literal, folded once
    known = {two: constant([{"words": f" {words} ", "name": name} for words, name in found], "array<struct<words:string,name:string>>") for two, found in begins.items()}
    none = F.array().cast("array<struct<words:string,name:string>>")
    seen = lambda s, two: F.when(F.contains(s, F.lit(f" {two} ")), F.filter(known[two], lambda k: F.contains(s, k["words"]))).otherwise(none)
    held = F.transform(likely, lambda s: F.concat(*(seen(s, two) for two in known)))
    outer = F.transform(held, lambda ks: F.filter(ks, lambda k: ~F.exists(ks, lambda o: (o["words"] != k["words"]) & F.contains(o["words"], k["words"]))))
    ids = F.flatten(F.transform(outer, lambda ks: F.array_sort(F.transform(ks, lambda k: k["name"]))))
    out = docs.select(F.col(key), F.when(some, ids).otherwise(F.array().cast("array<string>")).alias("sentence_ids"))
    steps = constant([{"name": name, "seq": " " + "  ".join(seq) + " "} for name, seq in rules], "array<struct<name:string,seq:string>>")
    start = F.struct(F.concat(F.lit(" "), F.array_join("sentence_ids", "  "), F.lit(" ")).alias("rest"), F.array().cast("array<string>").alias("found"))
    fold = F.aggregate(
        steps,
        start,
        lambda acc, step: F.struct(
            F.replace(acc["rest"], step["seq"], F.lit(" | ")).alias("rest"),
            F.when(F.contains(acc["rest"], step["seq"]), F.array_append(acc["found"], step["name"])).otherwise(acc["found"]).alias("found"),
        ),
    )
    any_ = F.size("sentence_ids") > 0
    left = F.size(F.filter(F.split(F.col("fold.rest"), " +"), lambda x: (x != "") & (x != "|")))
    return out.withColumn("fold", F.when(any_, fold)).select(
        key, "sentence_ids",
        F.when(any_, F.array_sort(F.array_distinct("fold.found"))).otherwise(F.array().cast("array<string>")).alias("licenses"),
        F.when(any_, left).otherwise(0).cast("long").alias("unmatched"),
    )


def op9_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.size("sentence_ids").cast("long").alias("n_known"), F.array_join("sentence_ids", " ").alias("sentence_ids"),
        F.array_join("licenses", " ").alias("licenses"), "unmatched",
    )


def _oracle() -> str:
    known = ", ".join(f"(' {words} ', '{name}')" for words, name in SENTENCES.items())
    steps = ["s0 AS (SELECT pos, ' ' || spaced || ' ' AS rest, CAST([] AS VARCHAR[]) AS found FROM seqs)"]
    for i, (name, seq) in enumerate(RULES):
        pat = " " + "  ".join(seq) + " "
        steps.append(
            f"s{i + 1} AS (SELECT pos, replace(rest, '{pat}', ' | ') AS rest, "
            f"CASE WHEN contains(rest, '{pat}') THEN list_append(found, '{name}') ELSE found END AS found FROM s{i})"
        )
    end = END.replace("'", "''")
    slots = "".join(f", '{slot}', '{words}', 'g')" for slot, words in SLOTS)
    likely = " OR ".join(f"contains(s, '{h}')" for h in HINTS)
    return f"""WITH known(words, name) AS (VALUES {known}),
docs AS (SELECT row_number() OVER () AS pos, doc_id, string_split({'regexp_replace(' * len(SLOTS)}regexp_replace(
  regexp_replace(regexp_replace(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{PLUS[0]}', '\\1 {PLUS[1]} ', 'g'), '{end}', chr(1), 'g'), '[^a-z0-9\\x01]+', ' ', 'g'){slots}, chr(1)) AS parts FROM documents),
lines AS (SELECT pos, u.i, ' ' || trim(parts[u.i], ' ') || ' ' AS s FROM docs, unnest(range(1, len(parts) + 1)) AS u(i)),
held AS MATERIALIZED (SELECT pos, i, words, name FROM (SELECT * FROM lines WHERE {likely}) l JOIN known ON contains(l.s, known.words)),
hits AS (SELECT pos, i, name FROM held h WHERE NOT EXISTS (SELECT 1 FROM held o WHERE o.pos = h.pos AND o.i = h.i AND o.words <> h.words AND contains(o.words, h.words))),
seqs AS MATERIALIZED (SELECT pos, count(*) AS n_known, string_agg(name, ' ' ORDER BY i, name) AS sentence_ids, string_agg(name, '  ' ORDER BY i, name) AS spaced FROM hits GROUP BY pos),
{", ".join(steps)}
SELECT d.doc_id, CAST(coalesce(q.n_known, 0) AS BIGINT) AS n_known, coalesce(q.sentence_ids, '') AS sentence_ids,
  coalesce(array_to_string(list_sort(list_distinct(s.found)), ' '), '') AS licenses,
  CAST(coalesce(len(list_filter(string_split(s.rest, ' '), lambda x: x <> '' AND x <> '|')), 0) AS BIGINT) AS unmatched
FROM docs d LEFT JOIN seqs q ON q.pos = d.pos LEFT JOIN s{len(RULES)} s ON s.pos = d.pos"""


ORACLE = _oracle()
