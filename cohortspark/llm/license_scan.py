"""Licence scan: Dice coefficient over word bigrams against licence templates (DataFrame
functions only).

A whole text is normalised (lower case, runs of other characters than letters and digits become
one space), so line ends, wrapping and comment marks between words do not matter.  A template of m
words is compared with windows of m words of the text by the Dice coefficient of the two sets of
word bigrams.  A coefficient of t or more needs set sizes a and b with b between a t / (2 - t) and
a (2 - t) / t, and it needs all but a share 1 - t / (2 - t) of the template's bigrams.  So of one
bigram more than that share, the template's anchors (its longest bigrams), a matching window has
at least one.  The windows are those that put an anchor found in the text at its (first) place in
the template; texts without any anchor, found by one regular expression, are done at once.

The whole work is an expression over the row: nothing is exploded or shuffled.

Cases: null or empty text, and texts of fewer than two words, match nothing; a window that would
begin before the text begins with it, one that would end after it ends with it; of a template's
windows the one with the largest coefficient counts, then the earliest; equal coefficients of
templates are settled by name; repeated rows and null ids are carried through; an empty table
gives no rows; only doc_id and text are read.
"""

from __future__ import annotations

from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_MIT_GRANT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
              "associated documentation files (the \"Software\"), to deal in the Software without restriction")
_DISCLAIMER = ("IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, "
               "WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE "
               "OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_BSD_CONDITIONS = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
_BSD_TWO = ("1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
            "disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
            "the following disclaimer in the documentation and/or other materials provided with the distribution.")
_BSD_THIRD = ("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
              "products derived from this software without specific prior written permission.")
_BSD_DISCLAIMER = ("THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
                   "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
                   "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
                   "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
                   "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
                   "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR "
                   "OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_ISC_GRANT = ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
              "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.")
_GPL_NOTICE = ("This program is free software: you can redistribute it and/or modify it under the terms of the "
               "GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or "
               "(at your option) any later version.")
#: Notices and whole texts of public licences (fixed values): name, text.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0-header", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
     "except in compliance with the License. You may obtain a copy of the License at"),
    ("Apache-2.0-notice", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
     "except in compliance with the License. You may obtain a copy of the License at "
     "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
     "distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
     "either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("BSD-2-Clause-text", f"{_BSD_CONDITIONS} {_BSD_TWO} {_BSD_DISCLAIMER}"),
    ("BSD-3-Clause", _BSD_CONDITIONS),
    ("BSD-3-Clause-text", f"{_BSD_CONDITIONS} {_BSD_TWO} {_BSD_THIRD} {_BSD_DISCLAIMER}"),
    ("BSD-line", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-notice", _GPL_NOTICE),
    ("GPL-3.0-notice-text", f"{_GPL_NOTICE} This program is distributed in the hope that it will be useful, but WITHOUT ANY "
     "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General "
     "Public License for more details. You should have received a copy of the GNU General Public License along with this "
     "program. If not, see https://www.gnu.org/licenses/."),
    ("ISC", _ISC_GRANT),
    ("ISC-text", f"{_ISC_GRANT} THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS "
     "SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY "
     "SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
     "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
     "PERFORMANCE OF THIS SOFTWARE."),
    ("MIT", "Released under the MIT License."),
    ("MIT-grant", _MIT_GRANT),
    ("MIT-text", f"{_MIT_GRANT}, including without limitation the rights to use, copy, modify, merge, publish, distribute, "
     "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject "
     "to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
     "substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, "
     "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. "
     f"{_DISCLAIMER}"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)
LEAST_DICE = 0.8


def template_words(text: str) -> list[str]:
    return "".join(c if c.isalnum() and c.isascii() else " " for c in text.lower()).split()


def template_places(text: str) -> list[str]:
    """The word bigrams of a normalised template in their order, repeats included."""
    words = template_words(text)
    return [f"{a} {b}" for a, b in zip(words, words[1:])]


def template_bigrams(text: str) -> list[str]:
    """Sorted distinct word bigrams of a normalised template."""
    return sorted(set(template_places(text)))


def anchors(text: str, least: float = LEAST_DICE) -> list[tuple[str, int]]:
    """(bigram, first place) of the longest bigrams, one more than a matching window may lack."""
    places, own = template_places(text), template_bigrams(text)
    lacking = int(len(own) * (1 - least / (2 - least)) + 1e-9)
    longest = sorted(own, key=lambda b: (-len(b), b))[:lacking + 1]
    return [(b, places.index(b)) for b in longest]


def any_anchor(least: float = LEAST_DICE) -> str:
    """A pattern for any anchor in a normalised text, its branches grouped by first letter."""
    every = sorted({b for _, text in TEMPLATES for b, _ in anchors(text, least)})
    grouped = [c + "(?:" + "|".join(b[1:] for b in own) + ")" for c, own in groupby(every, key=lambda b: b[0])]
    return " (?:" + "|".join(grouped) + ")(?= )"


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def _strings(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _best(bigrams: Column, marks: Column, name: str, text: str, least: float) -> Column:
    """The best window of one template as a struct (neg: minus the coefficient, name, word), or null."""
    own, places = template_bigrams(text), anchors(text, least)
    size, length = len(own), len(template_places(text))
    found = F.filter(marks, lambda m: F.array_contains(_strings(b for b, _ in places), m["b"]))
    starts = F.array_distinct(F.transform(found, lambda m: F.greatest(F.lit(0), m["i"] - F.element_at(
        F.array(*[F.lit(i) for _, i in places]), F.array_position(_strings(b for b, _ in places), m["b"]).cast("int")))))

    def compared(start: Column) -> Column:
        def dice(window: Column) -> Column:
            a = F.size(window)
            fits = a.between(F.lit(size * least / (2 - least)), F.lit(size * (2 - least) / least))
            return F.when(fits, F.lit(2.0) * F.size(F.array_intersect(window, _strings(own))) / (a + size))
        value = _let(F.array_distinct(F.slice(bigrams, start + 1, F.lit(length))), dice)
        return F.struct((-value).alias("neg"), F.lit(name).alias("name"), start.alias("word"))
    return F.array_min(F.filter(F.transform(starts, compared), lambda w: w["neg"] <= -least))


MATCHES = "array<struct<neg:double,name:string,word:int>>"


def _matches(plain: Column, least: float) -> Column:
    """The best window of every template that a normalised text matches."""
    def of_words(words: Column) -> Column:
        n = F.size(words) - 1
        pairs = F.zip_with(F.slice(words, F.lit(1), n), F.slice(words, F.lit(2), n), lambda a, b: F.concat_ws(" ", a, b))
        return _let(pairs, of_bigrams)

    def of_bigrams(bigrams: Column) -> Column:
        every = sorted({b for _, text in TEMPLATES for b, _ in anchors(text, least)})
        marks = F.filter(F.transform(bigrams, lambda b, i: F.struct(i.alias("i"), b.alias("b"))),
                         lambda m: F.array_contains(_strings(every), m["b"]))
        return _let(marks, lambda m: F.filter(F.array(*[_best(bigrams, m, name, text, least) for name, text in TEMPLATES]),
                                              lambda w: w.isNotNull()))
    return F.when(plain.rlike(any_anchor(least)), _let(F.split(F.trim(plain), " "), of_words)).otherwise(F.array().cast(MATCHES))


def scan(docs: DataFrame, least: float = LEAST_DICE) -> DataFrame:
    """doc_id, matches (array of neg: minus the coefficient, name, word: where the window begins,
    from 0) for every row of ``docs``."""
    text = F.lower(F.coalesce(F.col("text").cast("string"), F.lit("")))
    plain = F.concat(F.lit(" "), F.trim(F.regexp_replace(text, "[^a-z0-9]+", " ")), F.lit(" "))
    return docs.select("doc_id", plain.alias("plain")).select("doc_id", _matches(F.col("plain"), least).alias("matches"))


def best_license(docs: DataFrame, least: float = LEAST_DICE) -> DataFrame:
    """doc_id, n_matches (matching templates), license, dice, word of the best match (null, 0 and
    -1 without one)."""
    found = scan(docs, least).select("doc_id", F.size("matches").cast("long").alias("n_matches"), F.array_min("matches").alias("best"))
    return found.select("doc_id", "n_matches", F.col("best.name").alias("license"),
                        F.coalesce(-F.col("best.neg"), F.lit(0.0)).alias("dice"),
                        F.coalesce(F.col("best.word"), F.lit(-1)).cast("long").alias("word"))
