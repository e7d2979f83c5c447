"""License scans by ordered signature rules over the words of whole texts."""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from dataclasses import dataclass
from itertools import chain, groupby, product

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickweave.llm.common import annotate, cells, free_name, words_of
from tickweave.plans.session import table

#: Phrases whose places are always counted, with their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


@dataclass(frozen=True)
class Rule:
    label: str
    keyword: bytes  # a text in which no word begins so can't match
    regex: bytes  # over words joined by single spaces
    priority: int  # larger wins
    weight: float  # adds to the score


#: What must stand before a short tag, which would be plain prose elsewhere: a word of licensing, and four words between at most.
CONTEXT = "(?:licen[sc](?:e|ed|es|ing)|spdx|distributed under|released under|available under) ...4 "


def _rule(label: str, words: str, priority: int, weight: float, keyword: str = "") -> Rule:
    """words: a regular expression in which a space parts words, and ...n is up to n words; the keyword is its longest plain word if none is given."""
    regex = re.sub(r" \.\.\.(\d+) ", r"(?: [^ ]+){0,\1} ", words)
    plain = keyword or max(re.findall(r"(?<![\[(?|\w])[a-z]{2,}(?![\w]*[)?|\]])", words), key=len)
    return Rule(label, plain.encode(), regex.encode(), priority, weight)


#: Signatures written by hand: for each license its identifiers' tag, then sentences and names by which its texts and notices are known.
SIGNATURES = [
    ("mit", "mit", ["mit license", "expat license", "permission is hereby granted free of charge to any person obtaining a copy", "to deal in the software without restriction including without limitation the rights", "the above copyright notice and this permission notice shall be included in all copies or substantial portions", "the software is provided as is without warranty of any kind", "in no event shall the authors or copyright holders be liable for any claim damages or other liability"]),
    ("mit-0", "mit 0", ["mit no attribution"]),
    ("x11", "x11", ["x11 license", "except as contained in this notice the name of ...8 shall not be used in advertising or otherwise to promote the sale"]),
    ("bsd-2-clause", "bsd 2 clause", ["bsd 2 clause license", "simplified bsd license", "freebsd license"]),
    ("bsd-3-clause", "bsd 3 clause", ["bsd 3 clause license", "new bsd license", "modified bsd license", "neither the name of ...12 nor the names of its contributors", "may be used to endorse or promote products derived from this software without specific prior written permission"]),
    ("bsd-4-clause", "bsd 4 clause", ["all advertising materials mentioning features or use of this software", "original bsd license", "this product includes software developed by the university of california"]),
    ("bsd", "0bsd", ["bsd license", "bsd style license", "redistribution and use in source and binary forms", "redistributions of source code must retain the above copyright notice", "redistributions in binary form must reproduce the above copyright notice"]),
    ("0bsd", "0bsd", ["zero clause bsd", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided as is and the author disclaims"]),
    ("isc", "isc", ["isc license", "permission to use copy modify and or distribute this software for any purpose", "permission to use copy modify and distribute this software for any purpose with or without fee"]),
    ("hpnd", "hpnd", ["historical permission notice and disclaimer", "that both that copyright notice and this permission notice appear in supporting documentation", "makes no representations about the suitability of this software for any purpose"]),
    ("ntp", "ntp", ["ntp license"]),
    ("zlib", "zlib", ["zlib license", "this software is provided as is without any express or implied warranty", "in no event will the authors be held liable for any damages arising from the use of this software", "altered source versions must be plainly marked as such and must not be misrepresented"]),
    ("libpng", "libpng", ["libpng license", "the png reference library is supplied as is"]),
    ("libtiff", "libtiff", ["in any advertising or publicity relating to the software without the specific prior written permission of sam leffler"]),
    ("curl", "curl", ["curl license", "curl and libcurl are licensed under"]),
    ("icu", "icu", ["icu license", "unicode inc license agreement data files and software", "unicode terms of use"]),
    ("ijg", "ijg", ["independent jpeg group license", "this software is based in part on the work of the independent jpeg group"]),
    ("freetype", "ftl", ["freetype project license", "portions of this software are copyright ...6 the freetype project"]),
    ("apache", "apache 2 0", ["you may not use this file except in compliance with the license", "www apache org licenses license 2 0", "unless required by applicable law or agreed to in writing software distributed under the license", "this product includes software developed by the apache software foundation", "apache license", "each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable"]),
    ("gpl", "gpl", ["general public license", "gnu gpl", "this program is free software you can redistribute it and or modify it", "you should have received a copy of the gnu general public license along with this program", "this program is distributed in the hope that it will be useful but without any warranty", "without even the implied warranty of merchantability or fitness for a particular purpose see the gnu", "everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed"]),
    ("lgpl", "lgpl", ["lesser general public license", "library general public license", "this library is free software you can redistribute it and or modify it", "a work that uses the library", "gnu lgpl"]),
    ("agpl", "agpl", ["affero general public license", "gnu agpl", "remote network interaction use with the gnu general public license"]),
    ("gpl-exception", "gpl cc 1 0", ["classpath exception", "gcc runtime library exception", "as a special exception the copyright holders of this library give you permission to link", "as a special exception to the gnu general public license", "font embedding exception", "openssl linking exception", "autoconf exception", "bison exception"]),
    ("gfdl", "gfdl", ["free documentation license", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license", "with no invariant sections no front cover texts and no back cover texts"]),
    ("mpl", "mpl 2 0", ["mozilla public license", "this source code form is subject to the terms of the mozilla public license", "if a copy of the mpl was not distributed with this file you can obtain one at", "incompatible with secondary licenses as defined by the mozilla public license", "mozilla org mpl"]),
    ("npl", "npl 1 1", ["netscape public license"]),
    ("epl", "epl 2 0", ["eclipse public license", "this program and the accompanying materials are made available under the terms of the eclipse", "eclipse org legal epl"]),
    ("edl", "edl 1 0", ["eclipse distribution license"]),
    ("cpl", "cpl 1 0", ["common public license"]),
    ("ibm-pl", "ipl 1 0", ["ibm public license"]),
    ("cddl", "cddl 1 0", ["common development and distribution license", "sun com cddl"]),
    ("sissl", "sissl", ["sun industry standards source license"]),
    ("spl", "spl 1 0", ["sun public license"]),
    ("cpal", "cpal 1 0", ["common public attribution license"]),
    ("qpl", "qpl 1 0", ["q public license"]),
    ("artistic", "artistic 2 0", ["artistic license", "same terms as perl itself", "the intent of this document is to state the conditions under which a package may be copied"]),
    ("clarified-artistic", "clartistic", ["clarified artistic license"]),
    ("python", "psf 2 0", ["python software foundation license", "psf hereby grants licensee a nonexclusive royalty free world wide license", "cnri open source gpl compatible license agreement", "beopen com license agreement for python"]),
    ("ruby", "ruby", ["ruby license", "you may distribute the software in object code or binary form provided that you do at least one of the following"]),
    ("tcl", "tcl", ["tcl tk license", "this software is copyrighted by the regents of the university of california sun microsystems"]),
    ("vim", "vim", ["vim license", "vim is charityware"]),
    ("php", "php 3 01", ["php license", "this product includes php software freely available from"]),
    ("zend", "zend 2 0", ["zend engine license"]),
    ("zpl", "zpl 2 1", ["zope public license"]),
    ("openssl", "openssl", ["openssl license", "this product includes software developed by the openssl project", "this product includes cryptographic software written by eric young"]),
    ("w3c", "w3c", ["w3c software notice and license", "w3c document license", "w3c software and document license"]),
    ("oldap", "oldap 2 8", ["openldap public license"]),
    ("sleepycat", "sleepycat", ["sleepycat license", "redistributions in any form must be accompanied by information on how to obtain complete source code"]),
    ("boost", "bsl 1 0", ["boost software license", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation"]),
    ("unlicense", "unlicense", ["this is free and unencumbered software released into the public domain", "anyone is free to copy modify publish use compile sell or distribute this software", "unlicense"]),
    ("cc0", "cc0 1 0", ["cc0", "creative commons zero", "creative commons public domain dedication", "the person who associated a work with this deed has dedicated the work to the public domain", "to the extent possible under law ...12 has waived all copyright and related or neighboring rights"]),
    ("cc", "cc by 4 0", ["creative commons attribution", "creative commons license", "creative commons corporation is not a law firm", "this work is licensed under a creative commons", "creativecommons org licenses", "by exercising the licensed rights you accept and agree to be bound by the terms and conditions of this creative commons"]),
    ("wtfpl", "wtfpl", ["do what the fuck you want to public license", "wtfpl"]),
    ("public-domain", "pddl 1 0", ["released into the public domain", "placed in the public domain", "dedicated to the public domain", "this work is in the public domain", "this file is in the public domain", "hereby placed into the public domain", "public domain mark", "no copyright is claimed", "work of the united states government ...12 not subject to copyright"]),
    ("odbl", "odbl 1 0", ["open database license", "opendatacommons org licenses odbl"]),
    ("odc-by", "odc by 1 0", ["open data commons attribution license"]),
    ("ogl", "ogl uk 3 0", ["open government licence", "contains public sector information licensed under the open government"]),
    ("crown-copyright", "licenseref crown", ["crown copyright"]),
    ("ofl", "ofl 1 1", ["sil open font license", "this font software is licensed under the sil open font license", "reserved font name"]),
    ("eupl", "eupl 1 2", ["european union public licence", "licensed under the eupl"]),
    ("cecill", "cecill 2 1", ["cecill free software license agreement", "contrat de licence de logiciel libre cecill", "this software is governed by the cecill"]),
    ("osl", "osl 3 0", ["open software license"]),
    ("afl", "afl 3 0", ["academic free license"]),
    ("ecl", "ecl 2 0", ["educational community license"]),
    ("lppl", "lppl 1 3c", ["latex project public license", "this work has the lppl maintenance status"]),
    ("apsl", "apsl 2 0", ["apple public source license"]),
    ("rpl", "rpl 1 5", ["reciprocal public license"]),
    ("ncsa", "ncsa", ["university of illinois ncsa open source license"]),
    ("postgresql", "postgresql", ["postgresql license", "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement"]),
    ("ms-pl", "ms pl", ["microsoft public license", "if you use the software you accept this license if you do not accept the license do not use the software"]),
    ("ms-rl", "ms rl", ["microsoft reciprocal license"]),
    ("ms-eula", "licenseref ms eula", ["microsoft software license terms", "end user license agreement for microsoft"]),
    ("json", "json", ["the software shall be used for good not evil"]),
    ("beerware", "beerware", ["you can buy me a beer in return", "beerware"]),
    ("upl", "upl 1 0", ["universal permissive license"]),
    ("blueoak", "blueoak 1 0 0", ["blue oak model license"]),
    ("mulanpsl", "mulanpsl 2 0", ["mulan permissive software license", "mulan psl"]),
    ("sspl", "sspl 1 0", ["server side public license"]),
    ("busl", "busl 1 1", ["business source license", "the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use"]),
    ("elastic", "elastic 2 0", ["elastic license", "you may not provide the software to third parties as a hosted or managed service"]),
    ("commons-clause", "commons clause", ["commons clause license condition", "the grant of rights under the license will not include ...6 the right to sell the software"]),
    ("polyform", "polyform noncommercial 1 0 0", ["polyform noncommercial license", "polyform small business license", "polyform shield license"]),
    ("openrail", "openrail", ["creativeml open rail", "bigscience rail license", "openrail m"]),
    ("llama", "licenseref llama", ["llama 2 community license agreement", "meta llama 3 community license agreement"]),
    ("cc-noncommercial", "licenseref noncommercial", ["for non commercial use only", "for noncommercial use only", "may not be used for commercial purposes", "not for commercial use", "free for personal and educational use"]),
    ("academic", "licenseref academic", ["for academic use only", "for educational purposes only", "for research purposes only", "for evaluation purposes only"]),
    ("proprietary", "licenseref proprietary", ["proprietary and confidential", "unauthori[sz]ed copying ...10 strictly prohibited", "no part of this publication may be reproduced", "no part of this book may be reproduced", "this software is proprietary", "contains trade secrets", "for internal use only", "do not distribute without permission", "may not be reproduced or transmitted in any form or by any means", "reverse engineering decompilation or disassembly is prohibited", "end user license agreement", "licensed not sold", "without the prior written permission of the publisher", "without the express written consent of"]),
    ("all-rights-reserved", "licenseref all rights reserved", ["all rights reserved", "all rights are reserved", "some rights reserved", "alle rechte vorbehalten", "tous droits réservés", "todos los derechos reservados", "todos os direitos reservados", "tutti i diritti riservati", "alle rechten voorbehouden", "wszelkie prawa zastrzeżone"]),
    ("copyright", "licenseref copyright", [r"copyright (?:c )?(?:19|20)\d\d", r"© ?(?:19|20)\d\d", "copyright holder reserves", "this material is protected by copyright"]),
    ("licensed-under", "licenseref other", ["licensed under the terms of", "licensed under", "released under the terms of the license", "see the license file for details", "see license in the project root for license information", "dual licensed under"]),
]


def rules() -> list[Rule]:
    """All rules, in order: over two hundred signatures written by hand, and families with versions or tags made from their parameters."""
    out = []
    # GNU family: name or short form, version, grant; "or later" reads before the bare name
    for (name, short), n in product([("general public license", "gpl"), ("lesser general public license", "lgpl"), ("library general public license", "lgpl"), ("affero general public license", "agpl"), ("free documentation license", "gfdl")], (1, 2, 3)):
        v = f"(?:version |v ?)?{n}(?: 0)?"
        out += [
            _rule(f"{short}-{n}-or-later", f"(?:gnu )?{name} (?:as published by the free software foundation )?(?:either )?{v} (?:of the license )?or (?:at your option )?(?:any )?later", 90, 1.0, name.split()[0]),
            _rule(f"{short}-{n}-only", f"(?:gnu )?{name} {v} only", 90, 1.0, name.split()[0]),
            _rule(f"{short}-{n}", f"(?:gnu )?{name} {v}", 80, 0.9, name.split()[0]),
            _rule(f"{short}-{n}-or-later", f"{short} ?v?{n}(?: 0)? or later", 85, 1.0, short),
            _rule(f"{short}-{n}", f"{short} ?v?{n}(?: 0)?", 70, 0.8, short),
        ]
    # Creative Commons: elements, version, written out or short; "cc by" alone needs a context
    for (code, name), n in product([("by", "attribution"), ("by-sa", "attribution share ?alike"), ("by-nd", "attribution no ?deriv(?:ative)?s?"), ("by-nc", "attribution non ?commercial"), ("by-nc-sa", "attribution non ?commercial share ?alike"), ("by-nc-nd", "attribution non ?commercial no ?deriv(?:ative)?s?")], ("1 0", "2 0", "2 5", "3 0", "4 0")):
        short = code.replace("-", " ")
        out += [
            _rule(f"cc-{code}-{n.replace(' ', '.')}", f"{CONTEXT if code == 'by' else ''}cc {short} {n}", 85, 1.0, "cc"),
            _rule(f"cc-{code}-{n.replace(' ', '.')}", f"creative commons {name} {n}", 85, 1.0, "creative"),
            _rule(f"cc-{code}-{n.replace(' ', '.')}", f"creativecommons org licenses {short} {n}", 95, 1.0, "creativecommons"),
        ]
    # versioned names: full name; short form in a context, or as a license; identifier
    for label, name, short, versions in [("apache", "apache (?:software )?license", "apache", ("1 0", "1 1", "2 0")), ("mpl", "mozilla public license", "mpl", ("1 0", "1 1", "2 0")), ("epl", "eclipse public license", "epl", ("1 0", "2 0")), ("cddl", "common development and distribution license", "cddl", ("1 0", "1 1")), ("eupl", "european union public licence", "eupl", ("1 0", "1 1", "1 2")), ("artistic", "artistic license", "artistic", ("1 0", "2 0")), ("lppl", "latex project public license", "lppl", ("1 0", "1 2", "1 3")), ("osl", "open software license", "osl", ("1 0", "2 0", "2 1", "3 0")), ("afl", "academic free license", "afl", ("1 2", "2 0", "2 1", "3 0")), ("ofl", "sil open font license", "ofl", ("1 0", "1 1")), ("bsl", "boost software license", "bsl", ("1 0",)), ("zpl", "zope public license", "zpl", ("1 1", "2 0", "2 1")), ("php", "php license", "php", ("3 0", "3 1")), ("cecill", "cecill free software license agreement", "cecill", ("1 0", "1 1", "2 0", "2 1")), ("ecl", "educational community license", "ecl", ("1 0", "2 0")), ("apsl", "apple public source license", "apsl", ("1 0", "1 1", "1 2", "2 0"))]:
        for n in versions:
            tag, numbered = f"{label}-{n.replace(' ', '.')}", f"{short} (?:version |v ?)?{n}"
            out += [_rule(tag, f"{name} (?:version |v ?)?{n}", 80, 0.9, name.split()[0]), _rule(tag, CONTEXT + numbered, 60, 0.6, short), _rule(tag, f"{numbered} licen[sc]e", 60, 0.6, short), _rule(tag, f"spdx license identifier {short} {n}", 99, 1.0, "spdx")]
    # single licenses by identifier, and by names and sentences of their texts
    for label, tag, phrases in SIGNATURES:
        out.append(_rule(label, f"spdx license identifier {tag}", 98, 1.0, "spdx"))
        out += [_rule(label, p, 40 if label == "licensed-under" else 75 if len(p) > 30 else 50, 0.3 if label in ("copyright", "licensed-under") else 0.8, "" if p[0] != "©" else "©") for p in phrases]
    return out


class Scanner:
    """Detections of the rules in a text, after overlaps are resolved."""

    def __init__(self):
        import ahocorasick

        self.rules = rules()
        # a leading space as a literal lets the search skip to it
        self.compiled = [re.compile(b" (?:" + r.regex + b")(?= )") for r in self.rules]
        self.base = [(re.compile(b" " + p.encode() + b"(?= )"), label) for p, label in BASE.items()]
        self.machine = ahocorasick.Automaton()
        by_keyword: dict[str, list[int]] = {}
        for i, r in enumerate(self.rules):
            by_keyword.setdefault(r.keyword.decode(), []).append(i)
        for word, which in by_keyword.items():
            self.machine.add_word(" " + word, which)
        self.machine.make_automaton()

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, str]], list[tuple[int, int, str]], float]:
        """(word, label) of the base places; (first word, last word + 1, label) of the detections that stay; score."""
        line = b" " + b" ".join(words) + b" "
        # every base phrase has a keyword of the rules in it
        which = sorted({i for _, some in self.machine.iter(line.decode("utf-8", "replace")) for i in some})
        if not which:
            return [], [], 0.0
        starts = np.cumsum([1, *(len(w) + 1 for w in words[:-1])])
        at = lambda p: int(np.searchsorted(starts, p))  # noqa: E731  word that starts at byte p, or the next one
        base = sorted((at(m.start() + 1), label) for rx, label in self.base for m in rx.finditer(line))
        found = [(m.start() + 1, m.end(), self.rules[i]) for i in which for m in self.compiled[i].finditer(line)]
        kept = undisputed(found)
        best: dict[str, float] = {}
        for _, _, r in kept:
            best[r.label] = max(best.get(r.label, 0.0), r.weight)
        miss = math.prod(1 - 0.9 * w for w in best.values())
        return base, sorted((at(a), at(b), r.label) for a, b, r in kept), 1 - miss


def undisputed(found: list[tuple[int, int, Rule]]) -> list[tuple[int, int, Rule]]:
    """The detections that stay, by falling priority: one goes if it overlaps a kept one of a higher priority, or lies within one
    of its own (of equal intervals the first label stays). In time m log m: kept ones are held as disjoint sorted intervals."""
    kept: list[tuple[int, int, Rule]] = []
    lows: list[int] = []
    highs: list[int] = []
    for _, level in groupby(sorted(found, key=lambda x: (-x[2].priority, x[0], -x[1], x[2].label)), key=lambda x: x[2].priority):
        reach, fresh = -1, []
        for a, b, r in level:
            i = bisect_left(highs, a + 1)  # the first kept interval that ends behind a
            if b > reach and not (i < len(lows) and lows[i] < b):
                fresh.append((a, b, r))
                reach = b
        kept += fresh
        lows, highs = _joined(sorted(chain(zip(lows, highs, strict=True), ((a, b) for a, b, _ in fresh))))
    return kept


def _joined(spans: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
    lows: list[int] = []
    highs: list[int] = []
    for a, b in spans:
        if highs and a < highs[-1]:
            highs[-1] = max(highs[-1], b)
        else:
            lows.append(a)
            highs.append(b)
    return lows, highs


KIND = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("base", T.ArrayType(T.StructType([T.StructField("word", T.LongType()), T.StructField("label", T.StringType())]))),
    T.StructField("found", T.ArrayType(T.StructType([T.StructField("word", T.LongType()), T.StructField("stop", T.LongType()), T.StructField("label", T.StringType())]))), T.StructField("score", T.DoubleType()),
])


def scan_licenses(docs: DataFrame, text: str = "text", into: str = "licenses") -> DataFrame:
    """docs with a struct: n_words, base (places of the base phrases), found (detections), score.

    A map over rows: no row moves, whole texts are read. Null, empty or wordless texts have no words, places or
    detections and score 0; repeated rows get equal results; `into` gets a _ if docs has the name.
    """

    def make():
        scanner = Scanner()

        def run(texts):
            cols = ([], [], [], [])
            for t in texts:
                words = words_of(t)
                base, found, score = scanner.scan(words)
                for c, v in zip(cols, (len(words), [{"word": w, "label": x} for w, x in base], [{"word": a, "stop": b, "label": x} for a, b, x in found], score), strict=True):
                    c.append(v)
            return cols

        return run

    return annotate(docs, free_name(docs, into), KIND, make, text)


def op10_license_scans(spark, sf_dir: str) -> DataFrame:
    out = scan_licenses(cells(table(spark, sf_dir, "documents")))
    joined = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    base, found = F.col("licenses.base"), F.col("licenses.found")
    return out.select(
        "doc_id", F.col("licenses.n_words").alias("n_words"), F.size(base).cast("long").alias("n_base"),
        F.array_min(base["word"]).alias("first_word"), F.array_max(base["word"]).alias("last_word"),
        joined(base["label"]).alias("base_labels"), joined(F.concat(base["label"], found["label"])).alias("labels"), F.col("licenses.score").alias("score"),
    )
