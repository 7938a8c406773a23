"""License scans: canonical digests of whole texts, paragraphs and lines, joined to those of known notices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Notices and whole texts by SPDX identifier, in the words in which they are usually written.
NOTICES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "Licensed under the GNU General Public License, version 3."),
    ("GPL-2.0-only", "Licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0-only", "Licensed under the GNU Lesser General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Released under CC0 1.0 Universal."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE. For more information, please refer to <https://unlicense.org>"),
]

#: Spellings that count as equal.
SPELLINGS = [
    ("licence", "license"),
    ("sub-license", "sublicense"),
    ("non-commercial", "noncommercial"),
    ("per cent", "percent"),
    ("copyright owner", "copyright holder"),
    ("organisation", "organization"),
    ("authoris", "authoriz"),
    ("recognis", "recogniz"),
    ("favour", "favor"),
    ("fulfilment", "fulfillment"),
    ("whilst", "while"),
    ("wilful", "willful"),
    ("https://", "http://"),
    ("&", " and "),
]

#: What separates words besides white space.
MARKS = "!\"#$%'()*+,-./:;<=>?@[\\]^_`{|}~"

#: A line that only states a copyright.
COPYRIGHT = r"(?m)^[\x20\t]*(?:copyright[^\n]*(?:\(c\)|©|[0-9]{4})|\(c\)|©|all rights reserved)[^\n]*$"


def canonical(text: Column) -> Column:
    """Lower case, equal spellings, no copyright lines, words one space apart; line ends and empty lines stay."""
    out = F.regexp_replace(F.lower(text), COPYRIGHT, "")
    for spelling, other in SPELLINGS:
        out = F.replace(out, F.lit(spelling), F.lit(other))
    out = F.translate(out, MARKS, " " * len(MARKS))
    out = F.regexp_replace(out, r"[\x20\t\x0B-\x0D]+", " ")
    return F.regexp_replace(out, r"\x20?\n\x20?", "\n")


def one_line(text: Column) -> Column:
    """A canonical text or paragraph as one line."""
    return F.trim(F.regexp_replace(text, r"\n+", " "))


def known_digests(licenses: DataFrame) -> DataFrame:
    """``license_id, digest, length`` of ``licenses (license_id, text)``; of equal texts the lowest id stands."""
    unit = one_line(canonical(F.col("text")))
    known = licenses.where("text is not null").select("license_id", unit.alias("unit")).where("unit <> ''")
    return known.groupBy(F.sha2("unit", 256).alias("digest"), F.length("unit").alias("length")).agg(
        F.min("license_id").alias("license_id")
    )


def known_notices(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(NOTICES, "license_id string, text string")


def scan_licenses(docs: DataFrame, licenses: DataFrame) -> DataFrame:
    """``doc_id, license_id, unit, n_units``: which known texts each document is or holds.

    The whole text, each paragraph and each line are canonicalised and hashed as
    a whole, then joined to ``licenses (license_id, text)`` by digest. ``unit``
    is the largest kind that matches: ``text``, ``paragraph`` or ``line``;
    ``n_units`` counts different matching units. Nothing is matched in part.

    Null and empty texts have no units. A null id is a document per text; equal
    rows are one document. An empty table, or no known text, gives no rows.
    Units are hashed where they are read, and only those as long as a known text;
    the driver gets the known texts' lengths, at most as many as the longest has
    characters. No document text is shuffled.
    """
    known = known_digests(licenses)
    lengths = [r["length"] for r in known.select("length").distinct().collect()]
    canon = canonical(F.col("text"))
    texts = docs.where("text is not null").select("doc_id", F.xxhash64("text").alias("key"), canon.alias("canon"))
    units = texts.select(
        "doc_id", "key",
        F.concat(
            F.array(F.struct(F.lit(0).alias("kind"), one_line(F.col("canon")).alias("unit"))),
            F.transform(F.split("canon", r"\n\n+"), lambda p: F.struct(F.lit(1).alias("kind"), one_line(p).alias("unit"))),
            F.transform(F.split("canon", r"\n+"), lambda p: F.struct(F.lit(2).alias("kind"), F.trim(p).alias("unit"))),
        ).alias("units"),
    )
    # The outer form, because the plain one lets Spark add a filter on the array, for which the canonical form is made again.
    unit = units.select("doc_id", "key", F.explode_outer("units").alias("u")).select("doc_id", "key", "u.kind", "u.unit")
    digests = unit.where(F.length("unit").isin(lengths)).select("doc_id", "key", "kind", F.sha2("unit", 256).alias("digest"))
    found = digests.join(known.select("digest", "license_id"), "digest")
    per_unit = found.groupBy("doc_id", "key", "license_id", "digest").agg(F.min("kind").alias("kind"))
    whole = per_unit.groupBy("doc_id", "key", "license_id").agg(
        F.min("kind").alias("kind"), F.count("*").alias("n_units")
    )
    names = F.array(F.lit("text"), F.lit("paragraph"), F.lit("line"))
    return whole.select("doc_id", "license_id", F.get(names, F.col("kind")).alias("unit"), "n_units")
