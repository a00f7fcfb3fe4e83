"""License scans by canonical digests: whole texts, and whole lines as notices, looked up among known texts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Well-known short license texts and notices, as published.
KNOWN = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be
held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it
and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If
you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not
required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution.""",
    "Apache-2.0-notice": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer
in the documentation and/or other materials provided with the distribution.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT
NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL
THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES
(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS
INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE
OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer
in the documentation and/or other materials provided with the distribution.
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived
from this software without specific prior written permission.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT
NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL
THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES
(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS
INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE
OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "0BSD": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "MIT-0": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to
use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES
OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE
LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "Unlicense": """This is free and unencumbered software released into the public domain.
Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a
compiled binary, for any purpose, commercial or non-commercial, and by any means.
In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in
the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our
heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future
rights to this software under copyright law.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES
OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM,
DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE
SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
For more information, please refer to <http://unlicense.org/>""",
    "BSL-1.0": """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and
accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit
the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do
so, all subject to the following:
The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the
following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the
Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source
language processor.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES
OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE
DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT
OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
}
#: Digests of the canonical forms of long license texts as published, by ``canonical`` as it stands here.
DIGESTS = {
    "adf220ee02537f83220e088f4488ca0e7557d614fac1cc48967b41d13911d6e0": "Apache-2.0",
    "e963bc30f4d3c45f45030c34409ee37315564625649c1394e32bb5ddd99e01b2": "Artistic-1.0-Perl",
    "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f": "CC0-1.0",
    "15f6a8d360ffdecc988c29279c00f23e20de17f14f2a06572ab0d41de6e98b7b": "GFDL-1.2",
    "2d36daeff2ad303badb6dee8149748be25e22974dd468e1e8a55cf40f16fc01d": "GFDL-1.3",
    "8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224": "GPL-1.0",
    "efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821": "GPL-2.0",
    "eaab5d82fdcca441d83a1913bbf07e4de3a739e190578c0bffde24f84e93bb2a": "GPL-3.0",
    "61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908": "LGPL-2.0",
    "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891": "LGPL-2.1",
    "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be": "LGPL-3.0",
    "f77c59051c0127d677dcce7ba0d4733294974749a7b4155250912498d92767d6": "MPL-1.1",
    "9e79a7d513376f6fa1500e4df4f6276c6e7e61c5c3e28dcdb1acee24033acc56": "MPL-2.0",
}
#: Names of licenses in notices. Each counts with and without "license" behind it; identifiers count as well.
NAMES = {
    "Apache License, Version 2.0": "Apache-2.0",
    "Apache License 2.0": "Apache-2.0",
    "Apache License v2.0": "Apache-2.0",
    "Apache 2.0": "Apache-2.0",
    "MIT": "MIT",
    "ISC": "ISC",
    "zlib": "Zlib",
    "BSD": "BSD",
    "BSD 2-Clause": "BSD-2-Clause",
    "2-Clause BSD": "BSD-2-Clause",
    "Simplified BSD": "BSD-2-Clause",
    "BSD 3-Clause": "BSD-3-Clause",
    "3-Clause BSD": "BSD-3-Clause",
    "New BSD": "BSD-3-Clause",
    "Modified BSD": "BSD-3-Clause",
    "0BSD": "0BSD",
    "MIT-0": "MIT-0",
    "Unlicense": "Unlicense",
    "Boost Software License 1.0": "BSL-1.0",
    "Boost Software License, Version 1.0": "BSL-1.0",
    "BSL-1.0": "BSL-1.0",
    "Mozilla Public License 2.0": "MPL-2.0",
    "Mozilla Public License, Version 2.0": "MPL-2.0",
    "Mozilla Public License, v. 2.0": "MPL-2.0",
    "MPL 2.0": "MPL-2.0",
    "Eclipse Public License 2.0": "EPL-2.0",
    "Eclipse Public License, Version 2.0": "EPL-2.0",
    "EPL 2.0": "EPL-2.0",
    "CC0": "CC0-1.0",
    "CC0 1.0": "CC0-1.0",
    "CC0 1.0 Universal": "CC0-1.0",
}
#: Families whose names come in versions, written in the forms that ``known_names`` lists.
GNU = {"GPL": "GNU General Public License", "LGPL": "GNU Lesser General Public License", "AGPL": "GNU Affero General Public License"}
GNU_VERSIONS = {"GPL": ("2.0", "3.0"), "LGPL": ("2.1", "3.0"), "AGPL": ("3.0",)}
COMMONS = {"BY": "Attribution", "SA": "ShareAlike", "ND": "NoDerivatives", "NC": "NonCommercial"}
COMMONS_KINDS = ("BY", "BY-SA", "BY-ND", "BY-NC", "BY-NC-SA", "BY-NC-ND")
#: Fixed value: how a notice begins, in canonical form; the name of a license is all that follows.
NOTICE = (
    "((this |the )?(work |software |project |program |file |code |content |document )?(is |are )?"
    "(licensed|released|distributed|published|available|made available|provided) under (the )?(terms of )?(the )?|spdx license identifier )"
)
#: Spellings that count as one, in the order of replacement; applied to lower-case words.
SPELLINGS = {
    "sub-licen[cs]e": "sublicense",
    "licence": "license",
    "non-infringement": "noninfringement",
    "merchantibility": "merchantability",
    "acknowledgement": "acknowledgment",
    "copyright owner": "copyright holder",
    "https://": "http://",
    r"neither the name of [^.]{1,120}\snor\s": "neither the name of the copyright holder nor ",
}
#: Fixed value: a line that only claims a copyright or reserves rights. It is dropped, line break included.
CLAIM = r"(^|\n)[ \t\r/*#;>-]*(copyright( notice)?[ \t]*(\(c\)|©|[0-9:<\[])[^\n]*|(\(c\)|©)[^\n]*|all rights reserved[ \t\r.]*)"
#: Fixed value: a line above a license's words: blank, its title, or any line that begins with "copyright".
HEAD = (
    r'[ \t\r/*#;>-]*((the )?(new |modified |simplified )?(mit|isc|zlib|0bsd|bsd|boost software|unlicense)( no attribution)?([ -][0234]([ -]clause)?)?'
    r'( "[a-z]+"( or "[a-z]+")?)?( licen[cs]e)?( \([^()\n]*\))?( - version [^\n]*)?[ \t\r.:]*'
    r"|copyright[^\n]*|(\(c\)|©)[^\n]*|all rights reserved[ \t\r.]*|)\n"
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def canonical(text: Column) -> Column:
    """Canonical form: A-Z lower-cased, title and copyright lines gone, one spelling, other than letters and digits one blank.

    Above the first line of words, every line that begins with "copyright" is a claim; below, only one that goes on with
    a sign, a year or a bracket, as sentences of licenses may break before the word.
    """
    value = F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), f"^(?:{HEAD})++", "")
    value = F.regexp_replace(value, CLAIM, "")
    for old, new in SPELLINGS.items():
        value = F.regexp_replace(value, old, new)
    return F.trim(F.regexp_replace(value, r"[^a-z0-9\x{80}-\x{10FFFF}]+", " "))


def known_names() -> dict[str, str]:
    """Name in a notice: license, for ``NAMES`` and the families with versions."""
    names = dict(NAMES)
    for short, full in GNU.items():
        for version in GNU_VERSIONS[short]:
            brief = version.removesuffix(".0")
            for v in {version, brief}:
                forms = [f"{full}, version {v}", f"{full} version {v}", f"{full} v{v}", f"GNU {short} v{v}", f"GNU {short} {v}", f"{short}v{v}", f"{short} v{v}", f"{short} {v}", f"{short} {v} only"]
                names |= {form: f"{short}-{version}" for form in forms}
                names |= {f"{form}{later}": f"{short}-{version}-or-later" for form in forms[:-1] for later in (" or later", " or any later version", ", or (at your option) any later version")}
    for kind in COMMONS_KINDS:
        full = "-".join(COMMONS[x] for x in kind.split("-"))
        for version in ("3.0", "4.0"):
            forms = [f"CC {kind} {version}", f"Creative Commons {kind} {version}", f"Creative Commons {full} {version}", f"Creative Commons {full} {version} International"]
            names |= {form: f"CC-{kind}-{version}" for form in forms}
    return names


def with_suffix(names: Mapping[str, str]) -> dict[str, str]:
    """Each name with and without "license" behind it; an article before it belongs to the notice's beginning."""
    bare = {name.removeprefix("the ").removeprefix("The "): license for name, license in names.items()}
    return {form: license for name, license in bare.items() for form in (name, f"{name} license")}


def known_digests(spark: SparkSession, texts: Mapping[str, str], digests: Mapping[str, str] | None = None) -> DataFrame:
    """(digest, license) of known texts (text: license) and known digests; as many rows as the mappings have, at most."""
    table = spark.createDataFrame(list(texts.items()), "known string, license string")
    found = table.select(F.sha2(canonical(F.col("known")), 256).alias("digest"), "license")
    found = found.union(spark.createDataFrame(list((digests or {}).items()), "digest string, license string"))
    return found.groupBy("digest").agg(F.min("license").alias("license"))


def scan_licenses(
    docs: DataFrame, texts: Mapping[str, str] | None = None, names: Mapping[str, str] | None = None, key: str = "doc_id", digests: Mapping[str, str] | None = None
) -> DataFrame:
    """(key, digest, license, notices, n_notices) of every row.

    ``license`` is that of the known text to which the whole text is equal in canonical form, else null; ``notices``
    are the licenses, sorted and comma-joined, that whole lines of the text name in canonical form, and ``n_notices``
    counts those lines. A notice is a line of "licensed under" or the like and a known name, or an SPDX identifier; its
    name is looked up by SHA-256 digest. Whole texts are joined by digest with a table of at most ``texts`` and
    ``digests`` rows, whose size the planner knows. ``texts`` and ``names`` map to licenses; without them, the tables
    above are used. A null or empty text has the digest of no bytes and no license. Repeated rows each stay; other
    columns are ignored.
    """
    spark = docs.sparkSession
    if texts is None:
        texts, digests = {v: k for k, v in KNOWN.items()}, {**DIGESTS, **(digests or {})}
    whole = known_digests(spark, texts, digests)
    named_by = known_digests(spark, with_suffix(known_names() if names is None else names))
    # the beginning of a notice in a raw line: signs for the blanks of its canonical form
    maybe_notice = "(?i)^[^a-z0-9]*" + NOTICE.replace("license", "licen[cs]e").replace(" ", "[^a-z0-9]+")
    maybe = F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: x.rlike(maybe_notice))
    name = lambda line: F.regexp_replace(line, f"^{NOTICE}", "")
    lines = F.transform(F.filter(F.transform(maybe, canonical), lambda x: x.rlike(f"^{NOTICE}")), lambda x: F.sha2(name(x), 256))
    rows = docs.select(F.col(key).alias("key"), F.sha2(canonical(F.col("text")), 256).alias("digest"), lines.alias("lines"))
    table = named_by.agg(F.map_from_entries(F.collect_list(F.struct("digest", "license"))).alias("table")).first()["table"]
    pairs = [F.lit(x) for entry in table.items() for x in entry]
    named = F.filter(F.transform("lines", lambda x: F.try_element_at(F.create_map(*pairs), x)), lambda x: x.isNotNull()) if pairs else F.array().cast("array<string>")
    found = rows.withColumn("named", named).join(whole, "digest", "left")
    return found.select(
        F.col("key").alias(key), "digest", "license", F.array_join(F.array_sort(F.array_distinct("named")), ",").alias("notices"), F.size("named").cast("long").alias("n_notices")
    )


def licenses_sql(documents: str = "documents") -> str:
    """DuckDB SQL for ``scan_licenses`` with the fixed tables."""

    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    def canon(value: str) -> str:
        sql = f"regexp_replace(translate(coalesce({value}, ''), '{UPPER}', '{LOWER}'), {quoted(f'^(?:{HEAD})+')}, '')"
        sql = f"regexp_replace({sql}, {quoted(CLAIM)}, '', 'g')"
        for old, new in SPELLINGS.items():
            sql = f"regexp_replace({sql}, {quoted(old)}, {quoted(new)}, 'g')"
        return f"trim(regexp_replace({sql}, '[^a-z0-9\\x{{80}}-\\x{{10FFFF}}]+', ' ', 'g'))"

    whole = ", ".join(f"({quoted(v)}, {quoted(k)})" for k, v in KNOWN.items())
    digests = ", ".join(f"({quoted(k)}, {quoted(v)})" for k, v in DIGESTS.items())
    names = ", ".join(f"({quoted(k)}, {quoted(v)})" for k, v in with_suffix(known_names()).items())
    return f"""
    with whole as (
      select digest, min(license) as license from (
        select sha256({canon('known')}) as digest, license from (values {whole}) t(known, license)
        union all select * from (values {digests}) t(digest, license)) group by 1),
    names as (select sha256({canon('known')}) as digest, min(license) as named from (values {names}) t(known, license) group by 1),
    lines as (
      select doc_id, {canon('line')} as line from (
        select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line from {documents})),
    named as (
      select doc_id, list(named order by named) as named from lines
      join names n on n.digest = sha256(regexp_replace(line, '^{NOTICE}', '')) where regexp_matches(line, '^{NOTICE}') group by doc_id)
    select d.doc_id, sha256({canon('d.text')}) as digest, w.license,
      coalesce(array_to_string(list_sort(list_distinct(m.named)), ','), '') as notices, coalesce(len(m.named), 0)::bigint as n_notices
    from {documents} d left join whole w on w.digest = sha256({canon('d.text')}) left join named m on m.doc_id = d.doc_id
    """
