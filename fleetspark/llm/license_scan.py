"""Licence scan: normalised text against licence templates by the Dice
coefficient over word bigrams.  Native: DataFrame and SQL functions only.

A unit is a line of a text or the whole text.  Normalising lower-cases A-Z and
turns every run of other characters than a-z and 0-9 into one space.  A unit
and a template match when ``2 * |A n B| / (|A| + |B|) >= t`` over their sets of
word bigrams.  That needs ``|B| * t / (2 - t) <= |A| <= |B| * (2 - t) / t``, so a
unit meets only the templates whose size bounds admit it.

A notice wrapped over lines or inside a longer line is found as a run of words:
where neither the whole text matches anything nor a line matches the template,
its best run counts as one more match.  A run begins and ends with a bigram of
the template (others at the ends only lower the coefficient), is not part of a
line that matches, and holds as many bigrams as the upper bound admits at most
(repeats inside the template on top).

Result: a row per document with ``doc_id, n_units`` (lines and whole texts within
the bounds of some template), ``n_matches`` (unit and template pairs that match,
and templates that only a run matches), ``license``
(of the best match; ties to the smaller template id) and ``dice`` (its
coefficient rounded to 6 places).  Null or empty texts and texts without a
match give ``n_matches`` 0, ``license`` null and ``dice`` 0.  Rows that share a
doc_id give a row each.  Extra columns are ignored."""

from __future__ import annotations

import math
import re
from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ASCII_LOWER, LOWER, UPPER, table, text_of

THRESHOLD = 0.8

#: Wording of common licence notices (template id, SPDX id, text).
TEMPLATES = [
    (1, "MIT", "Released under the MIT License."),
    (2, "MIT", "Licensed under the MIT License."),
    (3, "MIT", "This project is licensed under the terms of the MIT license."),
    (4, "Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (5, "Apache-2.0", "Released under the Apache License, Version 2.0."),
    (6, "BSD-3-Clause", "Released under the BSD 3-Clause License."),
    (7, "BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    (8, "GPL-3.0", "Licensed under the GNU General Public License v3.0."),
    (9, "GPL-3.0", "Released under the GNU General Public License, version 3."),
    (10, "CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    (11, "CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    (12, "MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
                    "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    (13, "Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
                       "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
                       "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
                       "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for "
                       "the specific language governing permissions and limitations under the License."),
    (14, "MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
                "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
                "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and "
                "this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "
                "\"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
                "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT "
                "HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
                "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    (15, "ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
                "provided that the above copyright notice and this permission notice appear in all copies."),
    (16, "Proprietary", "All rights reserved."),
]

#: Usual names of common licences, and what stands before them in a notice.
NAMES = [
    ("MIT", "the MIT License"), ("MIT", "the terms of the MIT License"), ("Apache-2.0", "the Apache License, Version 2.0"),
    ("Apache-2.0", "the Apache License 2.0"), ("Apache-2.0", "Apache 2.0"), ("BSD-2-Clause", "the BSD 2-Clause License"),
    ("BSD-3-Clause", "the BSD 3-Clause License"), ("BSD-2-Clause", "the Simplified BSD License"),
    ("BSD-3-Clause", "the Modified BSD License"), ("BSD-3-Clause", "the New BSD License"), ("BSD", "the BSD License"),
    *[(f"{spdx}-{v}.0", f"the GNU {name} General Public License{how}".replace("GNU  ", "GNU "))
      for spdx, name, vs in (("GPL", "", (2, 3)), ("LGPL", "Lesser", (3,)), ("AGPL", "Affero", (3,)))
      for v in vs for how in (f", version {v}", f" v{v}.0", f" version {v}.0")],
    ("LGPL-2.1", "the GNU Lesser General Public License, version 2.1"), ("LGPL-2.1", "the GNU Lesser General Public License v2.1"),
    ("GPL", "the GNU General Public License"), ("LGPL", "the GNU Lesser General Public License"),
    ("AGPL", "the GNU Affero General Public License"),
    *[(f"{spdx}-{v}.0", f"the {spdx}{how}") for spdx, vs in (("GPL", (2, 3)), ("LGPL", (3,)), ("AGPL", (3,))) for v in vs
      for how in (f" v{v}", f"v{v}", f"-{v}.0", f" version {v}")],
    ("MPL-2.0", "the Mozilla Public License 2.0"), ("MPL-2.0", "the Mozilla Public License, v. 2.0"), ("ISC", "the ISC License"),
    ("EPL-2.0", "the Eclipse Public License 2.0"), ("Unlicense", "the Unlicense"), ("CC0-1.0", "CC0 1.0"),
    ("CC0-1.0", "the CC0 1.0 Universal Public Domain Dedication"),
    *[(f"CC-{short}-{v}", f"{form} {v}{tail}") for short, long in (
        ("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-NC", "Attribution-NonCommercial"),
        ("BY-ND", "Attribution-NoDerivatives"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
        ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"))
      for v, form, tail in (("4.0", f"CC {short}", ""), ("3.0", f"CC {short}", ""),
                            ("4.0", f"a Creative Commons {long}", " International License"),
                            ("3.0", f"a Creative Commons {long}", " Unported License"))],
]
LEADS = ["Licensed under", "Released under", "Distributed under", "This work is licensed under", "This project is licensed under",
         "This software is released under"]

_GNU = ("{what} is free software: you can redistribute it and/or modify it under the terms of the GNU {name}General Public License as published by "
        "the Free Software Foundation, {version}. {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even "
        "the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name}General Public License for more details. "
        "You should have received a copy of the GNU {name}General Public License along with {it}. If not, see https://www.gnu.org/licenses/.")
_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are "
        "met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution. {third}THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND "
        "CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND "
        "FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT {holder} OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, "
        "INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
        "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, "
        "STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE "
        "POSSIBILITY OF SUCH DAMAGE.")
_LATER = "either version {} of the License, or (at your option) any later version"
#: Full notices.
NOTICES = [
    *[(f"{spdx}-{v}" + (".0" if "." not in v else "") + tail, _GNU.format(what=what, it=it, name=name, version=text.format(v)))
      for spdx, name, vs in (("GPL", "", ("2", "3")), ("LGPL", "Lesser ", ("2.1", "3")), ("AGPL", "Affero ", ("3",))) for v in vs
      for what, it in (("This program", "this program"),) for tail, text in (("-or-later", _LATER), ("", "version {} of the License"))],
    ("BSD-2-Clause", _BSD.format(third="", holder="HOLDER")),
    ("BSD-3-Clause", _BSD.format(third="3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
                                 "promote products derived from this software without specific prior written permission. ", holder="HOLDER")),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
            "above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL "
            "WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE "
            "LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
            "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS "
            "SOFTWARE."),
    *[(f"CC-{short}-4.0", f"This work is licensed under the Creative Commons {long} 4.0 International License. To view a copy of this license, visit "
                          f"http://creativecommons.org/licenses/{short.lower()}/4.0/ or send a letter to Creative Commons, PO Box 1866, Mountain View, "
                          "CA 94042, USA.") for short, long in (
        ("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-NC", "Attribution-NonCommercial"),
        ("BY-ND", "Attribution-NoDerivatives"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
        ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"))],
]


def _words(col: str) -> str:
    return f"split(trim(regexp_replace(translate({col}, '{UPPER}', '{LOWER}'), '[^a-z0-9]+', ' ')), ' ')"


def _bigrams(col: str) -> str:
    return f"array_distinct(transform(sequence(0, size({col}) - 2), i -> concat({col}[i], ' ', {col}[i + 1])))"


def _normalised(text: str) -> list[str]:
    """The words of a template, by the rule of ``_words``."""
    return re.sub(r"[^a-z0-9]+", " ", text.translate(ASCII_LOWER)).strip().split(" ")


def _extended(base: list[tuple], more: list[tuple[str, str]]) -> list[tuple]:
    """``base`` and the wordings of ``more`` that it does not hold, numbered on."""
    seen, out = {" ".join(_normalised(body)) for _, _, body in base}, list(base)
    for lic, body in more:
        if (norm := " ".join(_normalised(body))) not in seen:
            seen.add(norm)
            out.append((len(out) + 1, lic, body))
    return out


TEMPLATES = _extended(TEMPLATES, [(lic, f"{lead} {name}.") for lic, name in NAMES for lead in LEADS] + NOTICES)


def template_rows(templates, threshold: float) -> list[tuple]:
    """``(id, license, lo, hi, longest, grams)``: the bigram set of each template, the unit sizes its bounds admit and the bigrams of its longest run."""
    out = []
    for tid, lic, body in templates:
        w = _normalised(body)
        g = sorted({f"{a} {b}" for a, b in zip(w, w[1:])})
        m, t = len(g), Fraction(str(threshold))
        hi = math.floor(m * (2 - t) / t)
        out.append((tid, lic, math.ceil(m * t / (2 - t)), hi, hi + len(w) - 1 - m, g))
    return out


def _ranges(bounds: list[tuple[int, int]]) -> str:
    """An SQL condition on ``{0}``: within some of the bounds, overlapping ones merged."""
    out: list[list[int]] = []
    for lo, hi in sorted(bounds):
        if out and lo <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return "(" + " or ".join(f"{{0}} between {lo} and {hi}" for lo, hi in out) + ")"


def _literal(rows: list[tuple]) -> str:
    """The templates as an SQL array of structs; their words hold only a-z, 0-9 and spaces."""
    return "array(" + ", ".join(
        f"named_struct('id', {i}, 'license', '{lic}', 'lo', {lo}, 'hi', {hi}, 'longest', {longest}, 'grams', array({', '.join(repr(x) for x in g)}))"
        for i, lic, lo, hi, longest, g in rows) + ")"


def _let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` bound to ``value``, which is evaluated once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _runs(threshold: float) -> str:
    """The matches of the candidate templates ``c`` by their best run of the words ``v``, without runs inside a line that is in ``skip``.

    ``prev`` has the last place of the same bigram, so a bigram counts for a run that starts at ``i`` if ``prev < i``."""
    step = ("named_struct('a', s.a + if(prev[k] < i, 1, 0), 'n', s.n + if(prev[k] < i and hit[k], 1, 0), 'best', "
            "if(hit[k] and not (ln[i] = ln[k + 1] and array_contains(skip, ln[i])), "
            "greatest(s.best, 2D * (s.n + if(prev[k] < i, 1, 0)) / (s.a + if(prev[k] < i, 1, 0) + size(t.grams))), s.best))")
    run = f"aggregate(sequence(i, least(i + t.longest, size(b)) - 1), named_struct('a', 0, 'n', 0, 'best', 0D), (s, k) -> {step}, s -> s.best)"
    # a run that matches holds at least lo hits
    starts = "filter(at, (i, q) -> q + t.lo <= size(at) and coalesce(get(at, q + t.lo - 1) < i + t.longest, false))"
    best = _let("hit", "transform(b, x -> array_contains(t.grams, x))", _let(
        "at", "filter(sequence(0, size(b) - 1), k -> hit[k])", f"coalesce(array_max(transform({starts}, i -> {run})), 0D)"))
    found = f"filter(transform(c, t -> named_struct('dice', {best}, 'id', -t.id, 'license', t.license, 'line', -2)), s -> s.dice >= {threshold}D)"
    prev = _let("o", "array_sort(transform(b, (x, k) -> named_struct('x', x, 'k', k)))",
                "transform(array_sort(transform(o, (e, q) -> named_struct('k', e.k, 'p', if(get(o, q - 1).x = e.x, get(o, q - 1).k, -1)))), e -> coalesce(e.p, -1))")
    return _let("b", "transform(sequence(0, size(v) - 2), k -> concat(v[k], ' ', v[k + 1]))", _let("prev", prev, _let(
        "ln", "flatten(transform(l, (x, k) -> array_repeat(k, size(x))))", _let("skip", "transform(m, s -> s.line)", found))))


def scan(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """All units of a row stay in its own arrays, so nothing is shuffled; the templates are a constant of the plan."""
    rows = template_rows(templates, threshold)
    windows = _ranges([(lo, hi) for _, _, lo, hi, *_ in rows])
    least = min(lo for _, _, lo, *_ in rows)
    known = ", ".join(repr(x) for x in sorted({x for r in rows for x in r[-1]}))
    d = docs.select("doc_id", text_of().alias("t"))
    d = d.select("doc_id", F.expr(rf"transform(split(t, '\n'), x -> array_remove({_words('x')}, ''))").alias("l"))
    d = d.select("doc_id", "l", F.flatten("l").alias("v"))
    # a match holds at least lo bigrams of its template, so only bigrams of some template are compared
    units = "concat(if(size(l) > 1, transform(l, (x, k) -> named_struct('k', k, 'w', x)), array()), array(named_struct('k', -1, 'w', v)))"
    d = d.select("doc_id", "l", "v", F.expr(
        f"transform(transform(filter({units}, x -> size(x.w) >= 2), x -> named_struct('k', x.k, 'g', {_bigrams('x.w')})), "
        f"x -> named_struct('k', x.k, 'n', size(x.g), 'h', filter(x.g, y -> y in ({known}))))").alias("g"))
    d = d.select("doc_id", "l", "v", "g", F.expr(
        f"flatten(transform(filter(g, a -> size(a.h) >= {least}), a -> filter(transform("
        f"filter({_literal(rows)}, t -> a.n between t.lo and t.hi and size(a.h) >= t.lo), "
        "t -> named_struct('dice', 2D * size(array_intersect(a.h, t.grams)) / (a.n + size(t.grams)), 'id', -t.id, 'license', t.license, 'line', a.k)), "
        f"s -> s.dice >= {threshold}D)))").alias("m"))
    d = d.select("doc_id", "l", "v", "g", "m", F.expr(
        f"get(transform(filter(g, a -> a.k = -1 and size(a.h) >= {least} and not exists(m, s -> s.line = -1)), a -> "
        f"filter({_literal(rows)}, t -> size(a.h) >= t.lo and not exists(m, s -> s.id = -t.id) and size(array_intersect(a.h, t.grams)) >= t.lo)), 0)").alias("c"))
    d = d.select("doc_id", F.expr(f"size(filter(g, a -> {windows.format('a.n')}))").alias("n_units"),
                 F.expr(f"if(size(c) > 0, concat(m, {_runs(threshold)}), m)").alias("m"))
    best = F.array_max("m")
    return d.select("doc_id", F.col("n_units").cast("long").alias("n_units"), F.size("m").cast("long").alias("n_matches"),
                    best["license"].alias("license"), F.coalesce(F.round(best["dice"], 6), F.lit(0.0)).alias("dice"))


def op4(spark, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def sql4(templates=TEMPLATES, threshold: float = THRESHOLD) -> str:
    """DuckDB text: every unit against every template without the size bounds, and every run of words between two
    bigrams of a template as a group of rows."""
    norm = "trim(regexp_replace(translate({}, '" + UPPER + "', '" + LOWER + "'), '[^a-z0-9]+', ' ', 'g'))"
    vals = ", ".join("({}, '{}', {}, {}, '{}')".format(i, lic, lo, longest, body.replace("'", "''"))
                     for (i, lic, body), (_, _, lo, _, longest, _) in zip(templates, template_rows(templates, threshold)))
    t = Fraction(str(threshold))
    a, b = t.numerator, t.denominator
    return f"""
with tp as (select id, lic, lo, longest, string_split({norm.format('body')}, ' ') w from (values {vals}) v(id, lic, lo, longest, body)),
 t as (select id, lic, lo, longest, list_distinct([w[i] || ' ' || w[i + 1] for i in range(1, len(w))]) g from tp),
 d as (select row_number() over () r, doc_id, coalesce(text, '') x from documents),
 ls as (select r, len(string_split(x, chr(10))) nl, unnest(string_split(x, chr(10))) x, unnest(range(len(string_split(x, chr(10))))) ln from d),
 lw as (select r, nl, ln, [y for y in string_split({norm.format('x')}, ' ') if y <> ''] w from ls),
 u as (select r, ln, w from lw where nl > 1 union all select r, -1, flatten(list(w order by ln)) from lw group by r),
 ug as (select r, ln, list_distinct([w[i] || ' ' || w[i + 1] for i in range(1, len(w))]) g from u where len(w) >= 2),
 near as (select r, ln, g from ug where exists (select 1 from t where len(ug.g) * {2 * b - a} >= len(t.g) * {a} and len(ug.g) * {a} <= len(t.g) * {2 * b - a})),
 s as (select n.r, n.ln, t.id, t.lic, 2.0 :: double * len(list_intersect(n.g, t.g)) / (len(n.g) + len(t.g)) dice from near n, t),
 m as (select * from s where dice >= {threshold}),
 c as (select r, count(*) n from near group by r),
 ws as (select r, ln, unnest(w) word, unnest(range(len(w))) i from lw),
 ps as (select r, ln, word, row_number() over (partition by r order by ln, i) p from ws),
 bs as (select r, p, ln, lead(ln) over o ln2, word || ' ' || lead(word) over o g from ps window o as (partition by r order by p)),
 hit as (select bs.r, x.id, bs.p, bs.ln, bs.ln2, row_number() over (partition by bs.r, x.id order by bs.p) q
         from bs join (select id, unnest(g) g from t) x using (g)
         where not exists (select 1 from m where m.r = bs.r and (m.ln = -1 or m.id = x.id))),
 run as (select h.r, h.id, h.p p1, k.p p2 from hit h join t using (id) join hit k
         on k.r = h.r and k.id = h.id and k.p between h.p and h.p + t.longest - 1 and k.q - h.q + 1 >= t.lo
         where not (h.ln = k.ln2 and exists (select 1 from m where m.r = h.r and m.ln = h.ln))),
 rd as (select run.r, run.id, t.lic, 2.0 :: double * count(distinct bs.g) filter (where list_contains(t.g, bs.g)) / (count(distinct bs.g) + len(any_value(t.g))) dice
        from run join t using (id) join bs on bs.r = run.r and bs.p between run.p1 and run.p2 group by run.r, run.id, t.lic, run.p1, run.p2),
 rb as (select r, id, lic, max(dice) dice from rd group by r, id, lic having max(dice) >= {threshold}),
 best as (select r, count(*) n, max(dice) dice, arg_max(lic, [dice, -id :: double]) lic
          from (select r, id, lic, dice from m union all select r, id, lic, dice from rb) group by r)
select d.doc_id, coalesce(c.n, 0) :: bigint n_units, coalesce(best.n, 0) :: bigint n_matches, best.lic license, coalesce(round(best.dice, 6), 0) dice
from d left join c using (r) left join best using (r)
"""
