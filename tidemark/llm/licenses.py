"""Licence notices in texts, found by the Dice coefficient of word bigrams. DataFrame functions only."""

from __future__ import annotations

import math
import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Short notices by which works name their licence.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "all-rights-reserved": "All rights reserved.",
}

_NO_WARRANTY = (
    "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
    "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. ")
_BSD_START = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution. ")
_BSD_END = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; "
    "LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN "
    "CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
    "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")

# Headers and bodies of (license, text), looked for in whole texts besides the notices above. The full texts of
# the Apache, GPL, LGPL-2.1 and MPL licences are not here, but hold the headers as the words to apply them with.
PASSAGES = [
    ("Apache-2.0",
     'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the '
     "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
     "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
     "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
     "governing permissions and limitations under the License."),
    ("BSD-2-Clause", _BSD_START + _BSD_END),
    ("BSD-3-Clause", _BSD_START + "3. Neither the name of the copyright holder nor the names of its contributors may be used to "
     "endorse or promote products derived from this software without specific prior written permission. " + _BSD_END),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0",
     "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("GPL-2.0",
     "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
     "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later "
     "version. " + _NO_WARRANTY),
    ("GPL-3.0",
     "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
     "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
     "version. " + _NO_WARRANTY + "You should have received a copy of the GNU General Public License along with this program. "
     "If not, see <https://www.gnu.org/licenses/>."),
    ("ISC",
     "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
     "provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "
     '"AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF '
     "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL "
     "DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
     "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("LGPL-2.1",
     "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
     "License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later "
     "version. " + _NO_WARRANTY.replace("program", "library").replace("GNU General", "GNU Lesser General")),
    ("LGPL-3.0",
     "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
     "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
     "version. " + _NO_WARRANTY.replace("program", "library").replace("GNU General", "GNU Lesser General")),
    ("MIT",
     "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
     'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
     "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
     "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and "
     "this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS "
     'PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
     "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS "
     "BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
     "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("MPL-2.0",
     "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
     "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
]
WORDS = r"[^\p{L}\p{N}]+"
# Fixed value: words that many texts have, by which no text is picked if others will do.
COMMON = set("a an and any are as at be but by can for from if in is it may no not of on one or other out see that the this to "
             "under use was with work you".split())


def template_words(text: str) -> list[str]:
    return [w for w in re.split(r"[\W_]+", text.lower()) if w]


def template_bigrams(text: str) -> list[str]:
    words = template_words(text)
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:])))


def normal_words(text: Column) -> Column:
    """Lower-case words of letters and digits."""
    return F.filter(F.split(F.lower(text), WORDS), lambda w: w != "")


def word_pairs(words: Column) -> Column:
    """Pairs of neighbouring words, in order."""
    return F.zip_with(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))),
                      lambda a, b: F.concat(a, F.lit(" "), b))


def least_shared(n: int, threshold: float) -> int:
    """Bigrams that any text must share with a template of n, as it has no fewer than it shares."""
    return max(1, math.ceil(n * threshold / (2 - threshold) - 1e-9))


def anchors(templates: list[str], threshold: float) -> list[str]:
    """Words of which a text has at least one, if only as part of a word, that is like a template."""
    found = set()
    for text in templates:
        pairs = template_bigrams(text)
        spare, touched = len(pairs) - least_shared(len(pairs), threshold), set()
        for word in sorted(set(template_words(text)), key=lambda w: (w in COMMON, -len(w), w)):
            if len(touched) > spare:
                break
            touched |= {p for p in pairs if word in p.split(" ")}
            found.add(word)
    return sorted(a for a in found if not any(b != a and b in a for b in found))


def _let(value: Column, then) -> Column:
    """then(value), with the value worked out once."""
    return F.transform(F.array(value), then)[0]


def _literal(templates: list[tuple[str, str]], threshold: float) -> Column:
    return F.array(*[
        F.struct(F.lit(k).alias("license"), F.lit(i).alias("place"), F.lit(len(template_words(v))).alias("n_words"),
                 F.lit(least_shared(len(template_bigrams(v)), threshold)).alias("least"),
                 F.array(*[F.lit(p) for p in template_bigrams(v)]).alias("pairs"))
        for i, (k, v) in enumerate(templates)])


def _score(pairs: Column, template: Column, then) -> Column:
    """then(shared, dice) of distinct pairs and a template."""
    return _let(F.size(F.array_intersect(pairs, template["pairs"])),
                lambda shared: then(shared, 2.0 * shared / (F.size(pairs) + F.size(template["pairs"]))))


def _like_lines(lines: Column, templates: Column, threshold: float) -> Column:
    """(line, license, dice, n_bigrams, shared) of the lines that are like a template as a whole."""
    def best(words, line):
        return _let(F.array_distinct(word_pairs(words)), lambda pairs: _let(
            F.array_max(F.transform(templates, lambda t: _score(pairs, t, lambda shared, dice: F.struct(
                F.when(F.size(pairs) > 0, dice).otherwise(0.0).alias("dice"), (-t["place"]).alias("place"), t["license"].alias("license"),
                shared.alias("shared"))))),
            lambda top: F.struct(line.alias("line"), top["license"].alias("license"), top["dice"].alias("dice"),
                                 F.size(pairs).alias("n_bigrams"), top["shared"].alias("shared"))))

    return F.filter(F.transform(lines, best), lambda m: m["dice"] >= threshold)


def _windows(pairs: Column, template: Column, threshold: float) -> Column:
    """The windows of a template's number of words that are like it, as structs that sort by rank.

    A window that is like the template has its least number of the template's
    bigrams, so only starts around so many hits, close together, are scored.
    """
    span, least = template["n_words"] - 2, template["least"]
    last = F.greatest(F.size(pairs) - 1 - span, F.lit(0))

    def starts(hits):
        def around(a):
            first, final = hits[a], hits[a + least - 1]
            return F.when(final - first <= span, F.sequence(F.greatest(final - span, F.lit(0)), F.least(first, last))).otherwise(
                F.array().cast("array<int>"))
        return F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(0), F.size(hits) - least), around)))

    def scored(start):
        return _let(F.array_distinct(F.slice(pairs, start + 1, span + 1)), lambda own: _score(own, template, lambda shared, dice: F.struct(
            (-shared).alias("shared"), (-dice).alias("dice"), template["place"].alias("place"), start.alias("start"),
            F.least(start + span + 1, F.size(pairs)).alias("final"), template["license"].alias("license"), F.size(own).alias("n_bigrams"))))

    hits = F.filter(F.sequence(F.lit(0), F.size(pairs) - 1), lambda j: F.array_contains(template["pairs"], pairs[j]))
    return F.filter(F.transform(_let(hits, starts), scored), lambda w: -w["dice"] >= threshold)


def _apart(windows: Column) -> Column:
    """Of windows that overlap the one that shares most bigrams, best ones first."""
    overlap = lambda a, b: (a["start"] <= b["final"]) & (b["start"] <= a["final"])
    return F.aggregate(F.array_sort(windows), F.slice(windows, 1, 0), lambda chosen, w: F.when(
        F.exists(chosen, lambda c: overlap(c, w)), chosen).otherwise(F.concat(chosen, F.array(w))))


def scan(docs: DataFrame, templates: dict[str, str] | None = None, threshold: float = 0.8, key: str = "doc_id",
         text: str = "text") -> DataFrame:
    """(key, line, license, dice, n_bigrams): every line, and every passage of a text whatever its lines, that is like a template.

    Words are lower-cased runs of letters and digits. Dice is twice the shared
    bigrams over the sum of both sets. A line that is like a template as a
    whole is named with its best one, the first by name of those with one
    score. Besides, the words of the whole text, without regard to lines, are
    held against each template in windows of its number of words (or the whole
    of a shorter text). Of windows that overlap the one that shares most bigrams
    is chosen, then the one of the higher score, first name and first place. It
    is told with the line of its first word, unless a line that it touches is
    told with the same licence and no fewer shared bigrams. Without `templates`,
    lines are held against TEMPLATES, windows against those and PASSAGES.

    At a given `threshold` t a template of n bigrams is only like what has
    n * t / (2 - t) of them. So words are set down that touch more of its bigrams
    than may be missing, and texts without any of them are passed by. Lines count
    from 0; NULL and empty texts, and templates and lines of fewer than two
    words, match nothing. Repeated rows repeat their matches. Nothing is
    shuffled: a match is made where its text is read. The templates are part of
    the plan, so they should stay a list that people keep.
    """
    long = lambda rows: [(k, v) for k, v in rows if template_bigrams(v)]
    short = long(sorted((templates or TEMPLATES).items()))
    every = sorted(short + ([] if templates else long(PASSAGES)))
    schema_key = docs.select(key).schema[0].dataType
    if not every:
        empty = docs.select(F.col(key).cast(schema_key), F.lit(0).alias("line"), F.lit("").alias("license"),
                            F.lit(0.0).alias("dice"), F.lit(0).alias("n_bigrams"))
        return empty.filter(F.lit(False))
    some = anchors([v for _, v in every], threshold)
    near = docs.filter(F.exists(F.array(F.lower(F.col(text))), lambda low: reduce(
        lambda a, b: a | b, [low.contains(F.lit(a)) for a in some])))
    told = lambda m: F.struct(*[m[c].alias(c) for c in ("line", "license", "dice", "n_bigrams")])

    def passages(placed, like):
        """Windows over words with their lines that `like`, the lines told, do not tell."""
        def chosen(pairs):
            seen = F.array_distinct(pairs)
            fits = _let(seen, lambda s: F.filter(
                _literal(every, threshold), lambda t: F.size(F.array_intersect(s, t["pairs"])) >= t["least"]))
            return _let(F.flatten(F.transform(fits, lambda t: _windows(pairs, t, threshold))), _apart)

        line = lambda at: placed[at]["line"]
        windows = _let(word_pairs(F.transform(placed, lambda w: w["word"])), chosen)
        new = F.filter(windows, lambda w: ~F.exists(like, lambda m: (m["license"] == w["license"]) & (
            m["shared"] >= -w["shared"]) & m["line"].between(line(w["start"]), line(w["final"]))))
        return F.transform(new, lambda w: F.struct(
            line(w["start"]).alias("line"), w["license"].alias("license"), (-w["dice"]).alias("dice"), w["n_bigrams"].alias("n_bigrams")))

    def matches(lines):
        placed = F.flatten(F.transform(lines, lambda words, i: F.transform(
            words, lambda w: F.struct(w.alias("word"), i.alias("line")))))
        return _let(_like_lines(lines, _literal(short, threshold), threshold), lambda like: F.concat(
            F.transform(like, told), _let(placed, lambda p: passages(p, like))))

    lines = F.transform(F.split(F.col(text), "\n"), normal_words)
    return near.select(F.col(key), F.inline(_let(lines, matches)))
