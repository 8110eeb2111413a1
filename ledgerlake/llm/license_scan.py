"""License scans: normalised text against license templates by the Dice
coefficient over word bigrams.

A text's units are its lines, its blocks (runs of lines without an empty one) and its
passages: where no line or block matches a template, the runs of consecutive lines,
over empty ones too, that do, such as a notice in several paragraphs.
A unit of n distinct bigrams reaches a coefficient of t with a template of m only
if m lies between n * t / (2 - t) and n * (2 - t) / t, so every template stands in
a small table once for each n that it can match, and an equi-join on n finds the
candidates.  A match also shares so many of a template's bigrams that it must hold
one of a few words of it; texts and units without any are passed over before
their bigrams are built.  DataFrame functions only.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Least coefficient of a match.
THRESHOLD = 0.8
#: Templates are broadcast with their bigrams; a set of more characters is refused.
TEMPLATE_CHARS = 4 << 20

#: Whatever is no letter or digit.
SEPARATOR = r"[^\p{L}\p{N}]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission
notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT
WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A
PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES
OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE
SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this
list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
{third}THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.
IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR
CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR
PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR
TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE
POSSIBILITY OF SUCH DAMAGE."""

_BSD_THIRD = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission. """

#: Published license texts, standard headers and common one-line notices.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
     compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless
     required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS"
     BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
     governing permissions and limitations under the License."""),
    ("BSD-2-Clause", _BSD.format(third="")),
    ("BSD-3-Clause", _BSD.format(third=_BSD_THIRD)),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under the Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
     Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any
     later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
     implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more
     details. You should have received a copy of the GNU General Public License along with this program. If not, see
     <https://www.gnu.org/licenses/>."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
     granted, provided that the above copyright notice and this permission notice appear in all copies."""),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", _MIT),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was
     not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."""),
    ("Unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
     publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any
     purpose, commercial or non-commercial, and by any means."""),
)


def normalised(text: Column) -> Column:
    """A-Z lower-cased; whatever is no letter or digit becomes one space."""
    return F.trim(F.regexp_replace(F.translate(text, UPPER, LOWER), SEPARATOR, " "))


def bigrams(text: Column) -> Column:
    """Distinct word bigrams of a normalised text; none if it has fewer than two words."""
    words = F.split(text, " ")
    pairs = F.zip_with(F.slice(words, 1, F.size(words) - 1), F.slice(words, 2, F.size(words) - 1),
                       lambda a, b: F.concat(a, F.lit(" "), b))
    return F.when(F.size(words) > 1, F.array_distinct(pairs)).otherwise(F.array().cast("array<string>"))


#: Words of so little weight as anchors that others are taken if there are any.
COMMON = frozenset("the of and in to a an any is be by or for with this that under as at on not you may it its all are was from".split())


def anchor_words(templates=TEMPLATES, threshold: float = THRESHOLD) -> list[str]:
    """Words of which every text that matches a template holds one at least.

    A match shares ``threshold / (2 - threshold)`` of a template's m bigrams, so it
    shares one of any m - that + 1.  Words are taken, long ones first, until so
    many bigrams have one of them."""
    chosen: list[str] = []
    for _, text in sorted(templates, key=lambda t: (len(t[1]), t)):
        words = re.sub(r"[\W_]+", " ", "".join(c.lower() if c in UPPER else c for c in text)).strip().split(" ")
        pairs = set(zip(words, words[1:], strict=False))
        need = len(pairs) - math.ceil(len(pairs) * threshold / (2 - threshold) - 1e-9) + 1
        open_ = {p for p in pairs if not set(p) & set(chosen)}
        while pairs and len(pairs) - len(open_) < need:
            def weight(word, open_=open_):
                covers = sum(word in p for p in open_)
                return covers and (0.02 if word in COMMON else min(len(word), 8) / 8 * (1 if len(word) > 3 else 0.3)) * (2 + covers)

            best = max(sorted({w for p in open_ for w in p}), key=weight)
            chosen.append(best)
            open_ = {p for p in open_ if best not in p}
    return sorted(chosen, key=lambda w: (-len(w), w))


def prepare_templates(spark: SparkSession, templates=TEMPLATES) -> DataFrame:
    """template (its number), license, wanted (its bigrams), size."""
    if sum(len(text) for _, text in templates) > TEMPLATE_CHARS:
        raise ValueError(f"templates of more than {TEMPLATE_CHARS} characters")
    rows = [(k, name, text) for k, (name, text) in enumerate(templates)]
    return (spark.createDataFrame(rows, "template int, license string, text string")
            .select("template", "license", bigrams(normalised(F.col("text"))).alias("wanted"))
            .withColumn("size", F.size("wanted")).filter("size > 0"))


def _held(df: DataFrame, keep: list[str], **columns: Column) -> DataFrame:
    """``keep`` and the given columns, which are computed once per row: the plan
    does not put their expressions into functions that go through an array."""
    row = F.explode_outer(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))).alias("_held")
    return df.select(*keep, row).select(*keep, *[F.col(f"_held.{name}").alias(name) for name in columns])


def _passages(docs: DataFrame, prepared: DataFrame, threshold: float) -> DataFrame:
    """(id, unit, license, dice) of the passages of ``docs`` (id, text).

    A passage is a run of two or more lines with some letter or digit and no more
    words than a match can have distinct bigrams.  Of runs that match one template
    and overlap, the best counts; those that overlap a matching line or block of
    no more words do not.  A text, and the lines that a run can take from its
    first one on, are passed over if they share too few bigrams with a template."""
    low, high = threshold / (2 - threshold), (2 - threshold) / threshold
    need = F.ceil(F.col("size") * low - 1e-9).cast("int")
    # One row of all templates; its key is no constant, or the join would be a nested loop.
    every = prepared.agg(F.max("size").alias("most"), F.array_distinct(F.flatten(F.collect_list("wanted"))).alias("all"),
                         F.collect_list(F.struct("template", "wanted", need.alias("need"))).alias("templates"))
    every = every.select((F.col("most") > 0).alias("key"), "all", "templates")
    near = (docs.filter(F.contains("text", F.lit("\n"))).withColumn("key", F.length("text") > 0)
            .withColumn("_has", bigrams(normalised(F.col("text")))).join(F.broadcast(every), "key")
            .select("id", "text", "templates", F.array_intersect("_has", "all").alias("_shared"))
            .select("id", "text", F.explode_outer(F.transform(
                F.filter("templates", lambda t: F.size(F.array_intersect("_shared", t["wanted"])) >= t["need"]),
                lambda t: t["template"])).alias("template")).filter("template is not null")
            .join(F.broadcast(prepared), "template")
            .withColumn("need", need).withColumn("most", F.floor(F.col("size") * high + 1e-9).cast("int") + 1))
    lines = F.flatten(F.transform(F.split("text", r"\n[ \t\r]*\n"), lambda b, k: F.transform(
        F.split(b, "\n"), lambda x: F.struct(k.alias("block"), normalised(x).alias("text")))))
    keep = ["id", "license", "wanted", "size", "need", "most"]
    near = _held(near, keep, lines=F.filter(lines, lambda x: F.length(x["text"]) > 0))
    near = _held(near, keep, texts=F.col("lines.text"), blocks=F.col("lines.block"))
    # Per line its words and the template's bigrams that start in it, the one that goes on in the next line included.
    after = F.concat(F.slice("texts", 2, F.size("texts")), F.array(F.lit("")))
    near = _held(near, [*keep, "texts", "blocks"], words=F.transform("texts", lambda x: F.size(F.split(x, " "))),
                 shared=F.zip_with("texts", after, lambda x, y: F.array_intersect(
                     bigrams(F.trim(F.concat(x, F.lit(" "), F.split(y, " ")[0]))), "wanted")))

    def reach(i: Column) -> Column:
        """How many lines from ``i`` on have no more words than a match."""
        start = F.struct(F.lit(0).alias("words"), F.lit(0).alias("n"))
        return F.aggregate(F.slice("words", i, F.col("most")), start, lambda a, w: F.struct(
            (a["words"] + w).alias("words"), (a["n"] + (a["words"] + w <= F.col("most")).cast("int")).alias("n")))["n"]

    def block(k: Column) -> Column:
        return F.when(k > 0, F.get("blocks", k - 1))

    def starts(i: Column) -> Column:
        return ~block(i).eqNullSafe(block(i - 1))

    def run(i: Column, j: Column) -> Column:
        has = bigrams(F.array_join(F.slice("texts", i, j - i + 1), " "))
        unit = (i == j) | ((block(i) == block(j)) & starts(i) & starts(j + 1))
        return F.struct(unit.alias("unit"), (2.0 * F.size(F.array_intersect(has, "wanted")) / (F.size(has) + F.col("size"))).alias("dice"),
                        (i - j).alias("less"), (-i).alias("early"), i.alias("i"), j.alias("j"))

    keep += ["texts", "blocks"]
    first = F.filter(F.transform("shared", lambda x, k: F.struct(
        (k + 1).alias("i"), F.when((F.size(x) > 0) | starts(k + 1), reach(k + 1)).alias("n"))), lambda f: f["n"] > 0)
    near = _held(near, [*keep, "shared"], first=first)
    near = _held(near, keep, first=F.filter("first", lambda f: F.size(F.array_distinct(F.flatten(F.slice("shared", f["i"], f["n"])))) >= F.col("need")))
    near = _held(near, ["id", "license", "texts"], runs=F.sort_array(F.flatten(F.transform("first", lambda f: F.filter(F.transform(
        F.sequence(f["i"], f["i"] + f["n"] - 1), lambda j: run(f["i"], j)), lambda r: r["dice"] >= threshold))), asc=False))
    taken = F.expr("aggregate(runs, slice(runs, 1, 0), (a, r) -> if(exists(a, b -> b.i <= r.j and r.i <= b.j), a, concat(a, array(r))))")
    return (near.select("id", "license", "texts", F.explode_outer(F.filter(taken, lambda r: ~r["unit"])).alias("r")).filter("r is not null")
            .select("id", F.expr("array_join(slice(texts, r.i, r.j - r.i + 1), ' ')").alias("unit"), "license", F.col("r.dice").alias("dice")))


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES,
         threshold: float = THRESHOLD) -> DataFrame:
    """(id, unit, license, dice) for each unit of each row and each license that it
    matches; ``unit`` is the unit's normalised text, ``dice`` the best coefficient
    of the license's templates.  Units are lines, blocks and passages (see above).

    Null and empty texts, and units of fewer than two words, match nothing.  Equal
    units of a text count once, and so do repeated rows with their ids.  Other
    columns take no part; an empty table gives an empty result.
    """
    prepared = prepare_templates(df.sparkSession, templates)
    low, high = threshold / (2 - threshold), (2 - threshold) / threshold
    sizes = prepared.select("template", F.explode(F.sequence(F.ceil(F.col("size") * low - 1e-9).cast("int"),
                                                             F.floor(F.col("size") * high + 1e-9).cast("int"))).alias("n"))
    reach = prepared.agg(F.min("size").alias("least"), F.max("size").alias("most")).first()
    least = math.ceil((reach.least or 0) * low - 1e-9) if reach.least else 1
    anchors = F.array(*[F.lit(w) for w in anchor_words(templates, threshold)]).cast("array<string>")

    def may_match(where: Column) -> Column:
        return F.arrays_overlap(F.split(F.lower(where), SEPARATOR), anchors)

    text = F.col(text_col).cast("string")
    lines = F.split(text, "\n")
    blocks = F.filter(F.split(text, r"\n[ \t\r]*\n"), lambda b: F.contains(F.trim(b), F.lit("\n")))
    units = (df.filter(may_match(text))
             .select(F.col(id_col), F.explode(F.array_union(lines, blocks)).alias("_unit")).filter(may_match(F.col("_unit")))
             .select(id_col, normalised(F.col("_unit")).alias("unit"))
             # fewer words than a template's least size allows cannot match; the bound on the other side follows below
             .filter(F.length("unit") - F.length(F.translate("unit", " ", "")) >= least)
             .withColumn("_has", bigrams(F.col("unit"))).withColumn("n", F.size("_has")))
    pairs = (units.join(F.broadcast(sizes), "n").join(F.broadcast(prepared.select("template", "license", "wanted", "size")), "template")
             .withColumn("dice", 2.0 * F.size(F.array_intersect("_has", "wanted")) / (F.col("n") + F.col("size")))
             .filter(F.col("dice") >= threshold))
    passages = _passages(df.filter(may_match(text)).select(F.col(id_col).alias("id"), text.alias("text")), prepared, threshold)
    pairs = pairs.select(id_col, "unit", "license", "dice").union(passages)
    return pairs.groupBy(id_col, "unit", "license").agg(F.max("dice").alias("dice"))
