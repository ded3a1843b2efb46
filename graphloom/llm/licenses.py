"""Licence scans by canonical digest.

A text is put into canonical form (lower case, copyright and title lines dropped, equivalent spellings
made one, punctuation and spacing reduced to single spaces), and the SHA-256 of the whole
form is hash-joined to the digests of known licence texts. Whole documents are compared, and
so is every line of a document, which finds one-line notices.

Defined cases: a null or empty text, and one that only holds copyright or title lines, has no licence;
two known texts with one canonical form give the smaller identifier; repeated rows are
answered each; an empty table gives no rows; further columns are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.llm.common import stage

# Pairs of equivalent spellings (the left one becomes the right one).
EQUIVALENT = (
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("analyse", "analyze"), ("artefact", "artifact"),
    ("authorisation", "authorization"), ("authorised", "authorized"), ("calibre", "caliber"), ("cancelled", "canceled"),
    ("catalogue", "catalog"), ("categorise", "categorize"), ("centre", "center"), ("emphasised", "emphasized"), ("favour", "favor"),
    ("favourite", "favorite"), ("fulfil", "fulfill"), ("fulfilment", "fulfillment"), ("initialise", "initialize"), ("judgement", "judgment"),
    ("labelling", "labeling"), ("labour", "labor"), ("licence", "license"), ("licences", "licenses"), ("maximise", "maximize"),
    ("modelled", "modeled"), ("modelling", "modeling"), ("offence", "offense"), ("optimise", "optimize"), ("organisation", "organization"),
    ("organise", "organize"), ("practise", "practice"), ("programme", "program"), ("realise", "realize"), ("recognise", "recognize"),
    ("signalling", "signaling"), ("utilisation", "utilization"), ("whilst", "while"), ("wilful", "willful"), ("sublicence", "sublicense"),
    ("non commercial", "noncommercial"), ("per cent", "percent"), ("copyright owner", "copyright holder"), ("copyright owners", "copyright holders"),
)

# Known licence texts and notices.
KNOWN = (
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge,
publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,
subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR
ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH
THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY
DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION,
ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("BSD-2-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
documentation and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT
LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT
HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT
LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON
ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE
USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("BSD-3-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
documentation and/or other materials provided with the distribution.
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this
software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT
LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT
HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT
LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON
ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE
USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("Zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable
for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute
it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this
software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions
and limitations under the License."""),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "Licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""),
)

COPYRIGHT = (r"(?m)^[^a-z0-9\n©]*(?:copyright\s*(?:\(c\)|©|[0-9]{4}|by |<|\[|the [^\n]*(?:authors?|contributors?|developers?|project|foundation)[^a-z0-9\n]*$)|\(c\)\s*(?:copyright|[0-9]{4}|by )|©|all rights reserved[^a-z0-9\n]*$)[^\n]*$")

# A line that only names a licence whose text follows.
TITLE = r"(?m)^[^a-z0-9\n]*(?:the )?(?:mit|isc|zlib|(?:(?:new|simplified|modified|revised) )?bsd|bsd [23]-clause(?: \"?(?:new|revised|simplified)\"?(?: or \"?(?:new|revised|simplified)\"?)?)?) licen[cs]e(?: \((?:mit|isc|zlib|bsd)\))?[^a-z0-9\n]*$"


def canonical_lines(text: Column) -> Column:
    """Canonical form with line ends kept."""
    low = F.lower(F.coalesce(text, F.lit("")))
    low = F.when(low.rlike("copyright|©|all rights reserved|\\(c\\)"), F.regexp_replace(low, COPYRIGHT, "")).otherwise(low)
    low = F.when(low.rlike("(?:mit|isc|zlib|bsd|clause|simplified\"?|revised\"?|new\"?) licen[cs]e"), F.regexp_replace(low, TITLE, "")).otherwise(low)
    plain = F.regexp_replace(low, r"[^\p{L}\p{N}\n]+", " ")
    spelled = plain
    for variant, usual in EQUIVALENT:
        spelled = F.regexp_replace(spelled, rf"(?<![\p{{L}}\p{{N}}]){variant}(?![\p{{L}}\p{{N}}])", usual)
    return F.when(plain.rlike("|".join(variant for variant, _ in EQUIVALENT)), spelled).otherwise(plain)


def canonical(lines: Column) -> Column:
    """Canonical form of a whole text, from ``canonical_lines``."""
    return F.trim(F.regexp_replace(lines, r"\s+", " "))


def known_digests(known: DataFrame) -> DataFrame:
    """(digest, license) of known texts (license, text), one row a digest."""
    form = known.select("license", canonical(canonical_lines(F.col("text"))).alias("form")).where("form <> ''")
    return form.groupBy(F.sha2("form", 256).alias("digest")).agg(F.min("license").alias("license"))


def license_report(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """doc_id, license (of the whole text, or null), n_notices (lines that are a known text),
    notices (their licences, sorted and comma-joined) of every row."""
    if known is None:
        known = docs.sparkSession.createDataFrame(KNOWN, "license string, text string")
    digests = stage(known_digests(known), "digests")  # Spark sees its size and joins accordingly
    lines = F.split(F.col("form"), "\n")
    formed = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), canonical_lines(F.col("text")).alias("form"))
    units = formed.select("doc_id", "text_hash", F.posexplode(F.concat(F.array(canonical(F.col("form"))), F.transform(lines, lambda x: F.trim(x)))).alias("at", "unit"))
    hits = units.where("unit <> ''").select("doc_id", "text_hash", "at", F.sha2("unit", 256).alias("digest")).join(digests, "digest")
    # rows equal in id and text find the same lines: each line counts once
    found = stage(hits.select("doc_id", "text_hash", "at", "license").distinct(), "hits")
    per_doc = found.groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).agg(
        F.max(F.when(F.col("at") == 0, F.col("license"))).alias("license"), F.sum((F.col("at") > 0).cast("long")).alias("n_notices"),
        F.array_join(F.sort_array(F.collect_set(F.when(F.col("at") > 0, F.col("license")))), ",").alias("notices"))
    own = docs.select("doc_id", F.xxhash64("text").alias("text_hash"))
    joined = own.join(per_doc, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")), "left")
    return joined.select("doc_id", "license", F.coalesce("n_notices", F.lit(0)).cast("long").alias("n_notices"), F.coalesce("notices", F.lit("")).alias("notices"))
