"""Licence scans: Dice coefficient over word bigrams between units of text and licence templates.

Units are the lines of a text and its paragraphs of several lines (a text without blank lines is one paragraph). Texts
and templates are normalised alike: A-Z lowered, everything else than a-z and 0-9 is a blank. Dice over sets of bigrams is
2 |A and B| / (|A| + |B|); it can reach `least` only if |A| lies between least / (2 - least) |B| and its inverse, so a unit
meets only templates of about its size, and units that fit no template are dropped before their bigrams are made.
What remains meets the templates in a hash join on the bigram itself. Templates are a fixed list: they may be broadcast.

`whole` adds passages: windows of a template's size over the words of the whole text, across lines, blank lines and comment
marks, so a licence of several paragraphs and a notice inside a longer line are found too. It looks for `WHOLE`, which also
has each paragraph of the licences and further full texts. A text is searched only if it holds one of the bigrams that every
match must hold (all but the few that a match may lack), which loses nothing.

Null and empty texts have no findings. A template of one word has no bigrams and finds nothing. Ties between templates go
to the first name. Rows that repeat an id are scanned each by itself. Works in JVM expressions throughout.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from crivo.llm.base import col, normalised, text_of

LEAST = 0.8

# Short notices and the texts of short public licences.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This work is licensed under the Mozilla Public License, version 2.0."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0 Universal."),
    (
        "Apache-2.0",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
        with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required
        by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
        WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
        governing permissions and limitations under the License.""",
    ),
    (
        "MIT",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
        persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and
        this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED
        "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
        MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT
        HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
        ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ),
    (
        "ISC",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS
        PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES
        OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
        CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
        CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
        SOFTWARE.""",
    ),
)

# The paragraphs of the licences above, and further texts.
_AS_IS = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
    WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."""
_BSD_START = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
    following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
    conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this
    list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_THIRD = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
    products derived from this software without specific prior written permission."""
_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
    INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.
    IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR
    CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR
    PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR
    TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE
    POSSIBILITY OF SUCH DAMAGE."""
_GNU = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU %s as published by
    the Free Software Foundation, either version %s of the License, or (at your option) any later version. This program is
    distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY
    or FITNESS FOR A PARTICULAR PURPOSE. See the GNU %s for more details."""
WHOLE = (
    *TEMPLATES,
    (
        "MIT",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
        persons to whom the Software is furnished to do so, subject to the following conditions:""",
    ),
    (
        "MIT",
        """The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
        Software.""",
    ),
    (
        "MIT",
        f"""{_AS_IS} IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY,
        WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR
        OTHER DEALINGS IN THE SOFTWARE.""",
    ),
    (
        "Apache-2.0",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
        with the License.""",
    ),
    ("Apache-2.0", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    (
        "Apache-2.0",
        """Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
        "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
        language governing permissions and limitations under the License.""",
    ),
    (
        "ISC",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    ),
    (
        "ISC",
        """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
        IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
        INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
        ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
        THIS SOFTWARE.""",
    ),
    ("BSD-2-Clause", f"{_BSD_START} {_BSD_END}"),
    ("BSD-3-Clause", f"{_BSD_START} {_BSD_THIRD} {_BSD_END}"),
    ("BSD-3-Clause", _BSD_THIRD),
    ("GPL-3.0", _GNU % ("General Public License", "3", "General Public License")),
    ("GPL-2.0", _GNU % ("General Public License", "2", "General Public License")),
    ("LGPL-3.0", _GNU % ("Lesser General Public License", "3", "Lesser General Public License")),
    ("AGPL-3.0", _GNU % ("Affero General Public License", "3", "Affero General Public License")),
    (
        "MPL-2.0",
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
        distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    ),
    (
        "Unlicense",
        """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use,
        compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial
        or non-commercial, and by any means.""",
    ),
    (
        "Zlib",
        """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable
        for any damages arising from the use of this software. Permission is granted to anyone to use this software for any
        purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following
        restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original
        software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but
        is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the
        original software. 3. This notice may not be removed or altered from any source distribution.""",
    ),
)
#: Lengths of passages in words, in fifths of the template's: texts that leave something out, or have something added.
FIFTHS = (4, 5, 6)

_OTHER = "[^a-z0-9]+"


def _words(clean: Column) -> Column:
    return F.filter(F.split(clean, " "), lambda w: w != "")


def _bigrams(words: Column) -> Column:
    """The distinct pairs of neighbouring words."""
    pairs = F.transform(
        F.sequence(F.lit(1), F.size(words) - 1), lambda i: F.concat_ws(" ", F.element_at(words, i), F.element_at(words, i + 1))
    )
    return F.when(F.size(words) > 1, F.array_distinct(pairs)).otherwise(F.array().cast("array<string>"))


def templates(spark: SparkSession, listed: Sequence[tuple[str, str]], least: float) -> tuple[DataFrame, list[tuple[int, int]]]:
    """((template, license, of, low, high, bigram) rows, size bounds): what each template holds, and the sizes it can match."""
    each = [F.struct(F.lit(i).alias("template"), F.lit(n).alias("license"), F.lit(t).alias("text")) for i, (n, t) in enumerate(listed)]
    rows = spark.range(1).select(F.explode(F.array(*each)).alias("t")).select("t.*")
    clean = F.regexp_replace(normalised(F.col("text")), _OTHER, " ")
    held = rows.withColumn("words", _words(clean)).select("template", "license", _bigrams(F.col("words")).alias("bigrams"))
    # Bounds in whole bigrams; a unit has at most one bigram per word.
    low = F.ceil(F.size("bigrams") * F.lit(least / (2 - least)) - 1e-9)
    high = F.floor(F.size("bigrams") * F.lit((2 - least) / least) + 1e-9)
    sized = held.where(F.size("bigrams") > 0).select(
        "template", "license", F.size("bigrams").alias("of"), low.cast("int").alias("low"), high.cast("int").alias("high"), "bigrams"
    )
    bounds = sorted({(r.low, r.high) for r in sized.select("low", "high").collect()})
    return sized.withColumn("bigram", F.explode("bigrams")).drop("bigrams"), bounds


def _once(value: Column, build: Callable[[Column], Column]) -> Column:
    """build(value), an array, with `value` computed once however often `build` names it."""
    return F.flatten(F.transform(F.array(value), build))


def _units(clean: Column) -> Column:
    """The lines and the paragraphs of several lines of a normalised text."""
    lines = F.transform(F.split(clean, "\n"), lambda p, i: F.struct(F.lit("line").alias("unit"), i.alias("place"), p.alias("body")))
    paragraphs = F.transform(
        F.split(clean, r"\n ?\n"), lambda p, i: F.struct(F.lit("paragraph").alias("unit"), i.alias("place"), p.alias("body"))
    )
    return F.concat(lines, F.filter(paragraphs, lambda u: u["body"].contains("\n")))


def _joined(bounds: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The same sizes as disjoint ranges."""
    out: list[list[int]] = []
    for low, high in bounds:
        if out and low <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], high)
        else:
            out.append([low, high])
    return [(a, b) for a, b in out]


def scan(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    listed: Sequence[tuple[str, str]] = TEMPLATES,
    least: float = LEAST,
) -> DataFrame:
    """One row per unit that matches a template: id, unit (`line` or `paragraph`), place (from 0), license, dice. Rows alike in
    id and text count once: a unit's common bigrams are a set."""
    known, bounds = templates(docs.sparkSession, listed, least)
    clean = F.regexp_replace(normalised(text_of(text)), r"[^a-z0-9\n]+", " ")
    units = docs.select(col(id).alias("_id"), F.explode(_once(clean, _units)).alias("u")).select("_id", "u.*")
    ranges = _joined(bounds)

    def fitting(bigrams: Column) -> Column:
        n = F.size(bigrams)
        fits = F.lit(False)
        for low, high in ranges:
            fits = fits | n.between(low, high)
        return F.when(fits, F.transform(bigrams, lambda b: F.struct(n.alias("n"), b.alias("bigram"))))

    words = _words(F.translate("body", "\n", " "))
    found = _once(words, lambda w: _once(_bigrams(w), fitting))
    cells = units.select(F.xxhash64("_id", "unit", "place", "body").alias("_key"), "_id", "unit", "place", F.explode(found).alias("c"))
    cells = cells.select("_key", "_id", "unit", "place", "c.*")
    met = cells.join(F.broadcast(known.withColumnRenamed("bigram", "_bigram")), (F.col("bigram") == F.col("_bigram")) & F.col("n").between(F.col("low"), F.col("high")))
    counted = met.groupBy("_key", "_id", "unit", "place", "n", "template", "license", "of").agg(F.size(F.collect_set("bigram")).alias("common"))
    dice = F.col("common") * 2.0 / (F.col("n") + F.col("of"))
    best = counted.withColumn("dice", dice).where(F.col("dice") >= least)
    chosen = best.groupBy("_key", "_id", "unit", "place").agg(F.min(F.struct((-F.col("dice")).alias("d"), "license")).alias("best"))
    return chosen.select(
        F.col("_id").alias(id), "unit", "place", F.col("best.license").alias("license"), F.round(-F.col("best.d"), 6).alias("dice")
    )


def _sought(listed: Sequence[tuple[str, str]], least: float) -> list[tuple[str, list[str], int, list[int]]]:
    """(license, distinct bigrams, how many of them a match holds at least, lengths of passages) of each template."""
    out = []
    for name, text in listed:
        words = re.findall("[a-z0-9]+", text.lower())
        pairs = list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:])))
        if pairs:
            out.append((name, pairs, math.ceil(len(pairs) * least / (2 - least) - 1e-9), [max(2, len(words) * f // 5) for f in FIFTHS]))
    return out


def passages(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    listed: Sequence[tuple[str, str]] = WHOLE,
    least: float = LEAST,
) -> DataFrame:
    """One row per passage and license: id, unit (`passage`), place (number of its first word, from 0), license, dice.

    Windows start at a bigram of their template. At each start the best license counts; windows that overlap are one
    passage, which has the best window of each license, unless half of it or more lies in a better one of another license.
    Rows alike in id and text count once.
    """
    sought = _sought(listed, least)
    known = F.array(*[
        F.struct(
            F.lit(name).alias("license"), F.lit(len(pairs)).alias("of"), F.lit(need).alias("need"),
            F.array(*map(F.lit, lengths)).alias("lengths"), F.split(F.lit("|".join(pairs)), "[|]").alias("pairs"),
        )
        for name, pairs, need, lengths in sought
    ])
    # A match lacks at most of - need bigrams, so it holds one of any of - need + 1: here the longest, which are rare.
    least_one = sorted({b for _, pairs, need, _ in sought for b in sorted(pairs, key=lambda b: (-len(b), b))[: len(pairs) - need + 1]})

    def windows(pairs: Column) -> Column:
        def of(t: Column) -> Column:
            def window(start: Column, length: Column) -> Column:
                held = F.array_distinct(F.slice(pairs, start + 1, length - 1))

                def measured(h: Column) -> Column:
                    dice = F.size(F.array_intersect(h, t["pairs"])) * 2.0 / (F.size(h) + t["of"])
                    return F.struct(start.alias("start"), (start + length).alias("end"), t["license"].alias("license"), dice.alias("dice"))

                return F.element_at(F.transform(F.array(held), measured), 1)

            def from_hits(hits: Column) -> Column:
                full = F.filter(hits, lambda s, k: F.get(hits, k + t["need"] - 1) - s <= F.array_max(t["lengths"]) - 2)
                each = F.flatten(F.transform(full, lambda s: F.transform(t["lengths"], lambda n: window(s, n))))
                return F.filter(each, lambda w: w["dice"] >= least)

            places = F.sequence(F.lit(0), F.size(pairs) - 1)
            return _once(F.filter(places, lambda i: F.array_contains(t["pairs"], F.get(pairs, i))), from_hits)

        fitting = F.filter(known, lambda t: F.size(F.array_intersect(pairs, t["pairs"])) >= t["need"])
        return F.flatten(F.transform(fitting, of))

    def paired(words: Column) -> Column:
        n = F.size(words)
        return F.zip_with(F.slice(words, 1, n - 1), F.slice(words, 2, n - 1), lambda a, b: F.concat(a, F.lit(" "), b))

    clean = F.regexp_replace(normalised(text_of(text)), _OTHER, " ")
    found = _once(_words(clean), lambda w: F.when(
        F.size(w) > 1,
        _once(paired(w), lambda p: F.when(F.arrays_overlap(p, F.split(F.lit("|".join(least_one)), "[|]")), windows(p))),
    ))
    key = ["_key", "_id"]
    each = docs.select(F.xxhash64(col(id), text_of(text)).alias("_key"), col(id).alias("_id"), F.explode(found).alias("w"))
    first = each.groupBy(*key, "w.start").agg(F.min(F.struct((-F.col("w.dice")).alias("d"), "w.license", "w.end")).alias("b"))
    in_text = Window.partitionBy(*key).orderBy("start")
    before = F.max("b.end").over(in_text.rowsBetween(Window.unboundedPreceding, -1))
    opened = first.withColumn("opens", F.coalesce(F.col("start") >= before, F.lit(True)).cast("int"))
    grouped = opened.withColumn("passage", F.sum("opens").over(in_text))
    best = grouped.groupBy(*key, "passage", "b.license").agg(F.min(F.struct("b.d", "start", "b.end")).alias("b"))
    all_of = best.groupBy(*key, "passage").agg(F.collect_list(F.struct("license", "b.d", "b.start", "b.end")).alias("all"))

    def hidden(a: Column, b: Column) -> Column:
        better = (b["d"] < a["d"]) | ((b["d"] == a["d"]) & (b["license"] < a["license"]))
        shared = F.least(a["end"], b["end"]) - F.greatest(a["start"], b["start"])
        return better & (shared * 2 >= a["end"] - a["start"])

    shown = F.filter("all", lambda a: ~F.exists("all", lambda b: hidden(a, b)))
    return all_of.select("_id", F.explode(shown).alias("p")).select(
        F.col("_id").alias(id), F.lit("passage").alias("unit"), F.col("p.start").alias("place"), F.col("p.license").alias("license"),
        F.round(-F.col("p.d"), 6).alias("dice"),
    )


def whole(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    listed: Sequence[tuple[str, str]] = WHOLE,
    least: float = LEAST,
) -> DataFrame:
    """The lines and paragraphs of `scan` and the `passages` of whole texts, for one list of templates."""
    return scan(docs, id, text, listed, least).unionByName(passages(docs, id, text, listed, least))


def sql(listed: Sequence[tuple[str, str]] = TEMPLATES, least: float = LEAST, upper: str = "", lower: str = "") -> str:
    """The same scan in SQL, every unit against every template."""
    quoted = ", ".join(f"('{n}', '{' '.join(t.split()).replace(chr(39), chr(39) * 2)}')" for n, t in listed)
    bigrams = "list_distinct(list_transform(list_zip(words[:len(words) - 1], words[2:]), lambda p: p[1] || ' ' || p[2]))"
    clean = f"regexp_replace(translate(%s, '{upper}', '{lower}'), '[^a-z0-9%s]+', ' ', 'g')"
    split = "list_filter(string_split(replace(%s, chr(10), ' '), ' '), lambda w: w <> '')"
    return f"""with t(license, text) as (values {quoted}),
    tw as (select license, {split % (clean % ('text', ''))} as words from t),
    tb as (select license, {bigrams} as b from tw),
    d as (select doc_id, {clean % ("coalesce(text, '')", chr(92) + 'n')} as body from documents),
    ul as (select doc_id, 'line' as unit, unnest(string_split(body, chr(10))) as body,
        generate_subscripts(string_split(body, chr(10)), 1) - 1 as place from d),
    up as (select doc_id, 'paragraph' as unit, unnest(regexp_split_to_array(body, '{chr(92)}n ?{chr(92)}n')) as body,
        generate_subscripts(regexp_split_to_array(body, '{chr(92)}n ?{chr(92)}n'), 1) - 1 as place from d),
    u as (select * from ul union all select * from up where contains(body, chr(10))),
    uw as (select doc_id, unit, place, {split % 'body'} as words from u),
    ub as (select doc_id, unit, place, {bigrams} as b from uw where len(words) > 1),
    s as (select doc_id, unit, place, license, 2.0::double * len(list_intersect(ub.b, tb.b)) / (len(ub.b) + len(tb.b)) as dice
        from ub join tb on len(ub.b) <= len(tb.b) * {(2 - least) / least} and len(tb.b) <= len(ub.b) * {(2 - least) / least}),
    r as (select *, row_number() over (partition by doc_id, unit, place order by dice desc, license) as k from s where dice >= {least})
    select doc_id, unit, place::int as place, license, round(dice, 6) as dice from r where k = 1"""


def whole_sql(listed: Sequence[tuple[str, str]] = WHOLE, least: float = LEAST, upper: str = "", lower: str = "") -> str:
    """`whole` in SQL: every window of every text that starts at a bigram of its template."""
    quoted = ", ".join(f"('{n}', '{' '.join(t.split()).replace(chr(39), chr(39) * 2)}')" for n, t in listed)
    clean = f"regexp_replace(translate(%s, '{upper}', '{lower}'), '[^a-z0-9]+', ' ', 'g')"
    words = f"list_filter(string_split({clean}, ' '), lambda w: w <> '')"
    pairs = "list_transform(list_zip(words[:len(words) - 1], words[2:]), lambda p: p[1] || ' ' || p[2])"
    lengths = " union all ".join(f"select *, greatest(2, n_words * {f} // 5) as length from tb" for f in FIFTHS)
    return f"""with lines as ({sql(listed, least, upper, lower)}),
    t(license, text) as (values {quoted}),
    tw as (select license, {words % 'text'} as words from t),
    tb as (select license, len(words) as n_words, list_distinct({pairs}) as b from tw where len(words) > 1),
    tl as ({lengths}),
    d as (select distinct doc_id, coalesce(text, '') as text from documents),
    dw as (select row_number() over () as k, doc_id, {words % 'text'} as words from d),
    dp as materialized (select k, doc_id, {pairs} as p from dw where len(words) > 1),
    f as (select k, doc_id, p, license, b, length from dp join tl on len(list_intersect(p, b)) >= len(b) * {least / (2 - least)} - 1e-9),
    h as (select *, unnest(range(len(p))) as start from f),
    w as (select k, doc_id, license, start, start + length as stop, b, list_distinct(p[start + 1:start + length - 1]) as h
        from h where list_contains(b, p[start + 1])),
    s as (select k, doc_id, license, start, stop, 2.0::double * len(list_intersect(h, b)) / (len(h) + len(b)) as dice from w),
    c as (select * from s where dice >= {least} qualify row_number() over (partition by k, start order by dice desc, license, stop) = 1),
    o as (select *, coalesce(start >= max(stop) over (partition by k order by start rows between unbounded preceding and 1 preceding), true)
        as opens from c),
    g as (select *, sum(opens::int) over (partition by k order by start) as passage from o),
    m as (select * from g qualify row_number() over (partition by k, passage, license order by dice desc, start, stop) = 1)
    select doc_id, unit, place, license, dice from lines
    union all select doc_id, 'passage', start::int, license, round(dice, 6) from m a where not exists (select 1 from m b
        where a.k = b.k and a.passage = b.passage and (b.dice > a.dice or b.dice = a.dice and b.license < a.license)
        and (least(a.stop, b.stop) - greatest(a.start, b.start)) * 2 >= a.stop - a.start)"""
