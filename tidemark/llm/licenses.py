"""Licence notices and licence texts by Dice coefficient over word bigrams."""

from __future__ import annotations

import json
import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import lower_ascii, row_key, written

_DISCLAIMER = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF "
    "THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution. "
)
_GNU = (
    "This {what} is free software{colon} you can redistribute it and/or modify it under the terms of the GNU {name} as published "
    "by the Free Software Foundation; either version {version} of the License, or (at your option) any later version. This "
    "{what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
    "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details. You should have received a copy "
    "of the GNU {name} along with this {what}; if not, see <https://www.gnu.org/licenses/>."
)

# Published licence texts, headers and notices (fixed values).
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License."
    ),
    "BSD-2-Clause-text": _BSD + _DISCLAIMER,
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "BSD-3-Clause-text": (
        _BSD + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission. " + _DISCLAIMER
    ),
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-NC-4.0-notice": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-SA-4.0-notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "GPL-2.0-header": _GNU.format(what="program", colon=";", name="General Public License", version=2),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": _GNU.format(what="program", colon=":", name="General Public License", version=3),
    "ISC-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS "
        "PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES "
        "OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR "
        "CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF "
        "CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS "
        "SOFTWARE."
    ),
    "LGPL-2.1-header": _GNU.format(what="library", colon=";", name="Lesser General Public License", version="2.1"),
    "MIT": "Released under the MIT License.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR "
        "IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
        "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
        "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
        "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "MPL-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "all-rights-reserved": "All rights reserved.",
}


def template_bigrams(text: str) -> Counter[str]:
    """The bigrams of a text's words, each with its number."""
    words = re.findall(r"[a-z0-9]+", text.lower())
    return Counter(f"{a} {b}" for a, b in zip(words, words[1:], strict=False))


def size_bounds(size: int, threshold: float) -> tuple[int, int]:
    """The numbers of bigrams a passage may have to reach the threshold: Dice is 2 * min / (sum) at most."""
    return math.ceil(threshold * size / (2 - threshold) - 1e-9), math.floor((2 - threshold) * size / threshold + 1e-9)


def template_rows(templates: dict[str, str], threshold: float) -> list[tuple[str, int, int, str, int]]:
    """(license, size, least size of a passage, bigram, its number) for each bigram of each template."""
    counted = {name: template_bigrams(text) for name, text in templates.items()}
    return [
        (name, own.total(), size_bounds(own.total(), threshold)[0], bigram, n)
        for name, own in counted.items()
        for bigram, n in own.items()
    ]


def _words(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), "[^a-z0-9]+", -1), "")


def notices(texts: DataFrame, templates: dict[str, str] = TEMPLATES, threshold: float = 0.8) -> DataFrame:
    """(key, license, dice, notices) for the texts (key, text) and the templates that some window of theirs comes near enough.

    Words are runs of a-z and 0-9 after A-Z are lowered, over the whole text and across its lines. A template is compared
    with every window of as many bigrams as it has; a text with fewer is one window, and is compared with the templates
    whose size allows the threshold. Dice counts repeated bigrams as often as both sides have them. dice is the greatest
    of all windows, notices the number of runs of neighbouring windows that reach the threshold.

    No window is built: a bigram of the template at position p adds one to the windows that start from p - size + 1, or
    after the occurrence that fills its number in the template, to p. Running sums over these starts and ends give all
    windows' shared bigrams, with two rows for each occurrence. Texts that share a key must be equal.
    """
    spark = texts.sparkSession
    fields = "license", "size", "least", "bigram", "n"
    given = json.dumps([dict(zip(fields, row, strict=True)) for row in template_rows(templates, threshold)])
    layout = "array<struct<license string, size int, least int, bigram string, n int>>"
    # As large as the templates, whatever the texts.
    terms = spark.sql(f"SELECT inline(from_json(:given, '{layout}'))", args={"given": given})

    worded = texts.select("key", _words(F.col("text")).alias("words"))
    pair = F.zip_with(
        F.slice("words", 1, F.greatest(F.size("words") - 1, F.lit(0))),
        F.slice("words", 2, F.greatest(F.size("words") - 1, F.lit(0))),
        lambda a, b: F.concat_ws(" ", a, b),
    )
    paired = worded.select("key", (F.size("words") - 1).alias("bigrams"), F.posexplode(pair).alias("at", "bigram"))
    known = paired.join(F.broadcast(terms.select("bigram").distinct()), "bigram", "left_semi")
    # Repeated rows fall together before the shuffle; after it a text's rows stay in one place for all that follows.
    apart = known.dropDuplicates(["key", "at"]).repartition("key")
    met = apart.join(F.broadcast(terms), "bigram").filter("bigrams >= least")

    same = Window.partitionBy("key", "license", "bigram").orderBy("at")
    numbers = sorted({row[4] for row in template_rows(templates, threshold)})
    filled = F.coalesce(*[F.when(F.col("n") == n, F.lag("at", n).over(same)) for n in numbers], F.lit(-1))
    last = F.least("at", F.greatest(F.col("bigrams") - F.col("size"), F.lit(0)))
    first = F.greatest(F.col("at") - F.col("size") + 1, F.col("filled") + 1, F.lit(0))
    spans = met.withColumn("filled", filled).select(
        "key", "license", (F.least("bigrams", "size") + F.col("size")).alias("both"), first.alias("first"), last.alias("last")
    )
    ends = F.array(F.struct(F.col("first").alias("start"), F.lit(1).alias("step")), F.struct((F.col("last") + 1).alias("start"), F.lit(-1).alias("step")))
    steps = spans.filter("first <= last").select("key", "license", "both", F.explode(ends).alias("end"))
    steps = steps.groupBy("key", "license", "both", "end.start").agg(F.sum("end.step").alias("step"))
    along = Window.partitionBy("key", "license", "both").orderBy("start")
    dice = F.lit(2.0) * F.sum("step").over(along.rowsBetween(Window.unboundedPreceding, 0)) / F.col("both")
    scored = steps.select("key", "license", "both", "start", dice.alias("dice"))
    scored = scored.withColumn("before", F.coalesce(F.lag("dice").over(along), F.lit(0.0)))
    begins = F.count_if((F.col("dice") >= threshold) & (F.col("before") < threshold))
    return scored.groupBy("key", "license").agg(F.max("dice").alias("dice"), begins.alias("notices")).filter("notices > 0")


def scan(documents: DataFrame, templates: dict[str, str] = TEMPLATES, threshold: float = 0.8) -> DataFrame:
    """One row (doc_id, n_notices, license, dice, licenses) per document.

    n_notices counts the notices of all templates, license is the nearest template (ties: the first by name) with its Dice
    coefficient, licenses all matching ones by name; see ``notices``. Null and empty texts and texts without a notice have
    0, null, null and an empty list. Repeated rows repeat their result, no rows give no rows, other columns aren't looked at.
    """
    texts = documents.select("doc_id", "text", row_key(F.col("doc_id"), F.col("text")).alias("key"))
    near = notices(texts.select("key", "text"), templates, threshold)
    found = near.groupBy("key").agg(
        F.sum("notices").alias("n_notices"),
        F.min_by(F.struct("license", "dice"), F.struct(-F.col("dice"), "license")).alias("best"),
        F.array_join(F.array_sort(F.collect_list("license")), ",").alias("licenses"),
    )
    return (
        texts.select("doc_id", "key")
        .join(written(found, "license-notices"), "key", "left")
        .select(
            "doc_id",
            F.coalesce("n_notices", F.lit(0)).cast("bigint").alias("n_notices"),
            "best.license",
            "best.dice",
            F.coalesce("licenses", F.lit("")).alias("licenses"),
        )
    )
