"""Hand-written signatures of licences, in order of their weight.

A licence has names as they stand in running text, identifiers, places on the web, and sentences of its own notice. A form
puts a name into the words around it; each form of each licence is one rule. A blank in a pattern stands for any white space,
as notices are wrapped. Every rule names keywords of which each of its matches contains one, in lower case and with white
space collapsed, so that most rules are never tried on a text.
"""

from __future__ import annotations

import re
from dataclasses import dataclass


@dataclass(frozen=True)
class Rule:
    label: str
    keywords: tuple[tuple[str, ...], ...]  # one of these has all its parts in each match
    pattern: re.Pattern
    weight: int


#: label: (keywords of the names, names, identifiers, places, sentences with their keyword); keywords: a|b+c is a, or b and c
LICENCES = {
    "mit": ("mit+licen|expat+licen", r"(?:the )?(?:mit|expat)(?:/x11)?[ -]licen[cs]e", r"mit", r"opensource\.org/licenses/mit", [
        ("permission is hereby granted", r"permission is hereby granted, free of charge, to any person obtaining a copy"),
        ("without limitation the rights", r"without restriction, including without limitation the rights to use, copy, modify")]),
    "apache-2": ("apache", r"(?:the )?apache(?: software)? licen[cs]e,?(?: \(?(?:v|version|ver\.?) ?2(?:\.0)?\)?)|apache[ -]?2(?:\.0)?",
                 r"apache-2\.0", r"apache\.org/licenses/license-2\.0", [
                     ("unless required by applicable law", r"unless required by applicable law or agreed to in writing")]),
    "apache": ("apache", r"(?:the )?apache(?: software)? licen[cs]e", r"apache", r"apache\.org/licenses/?(?![\w/])", []),
    "apache-1": ("apache", r"(?:the )?apache(?: software)? licen[cs]e,? (?:v|version) ?1(?:\.[01])?", r"apache-1\.[01]",
                 r"apache\.org/licenses/license-1\.[01]", []),
    "gpl-3": ("general public|gpl", r"(?:the )?(?:gnu )?general public licen[cs]e,?(?: \(?gpl\)?)?,? (?:v|version|ver\.?) ?3(?:\.0)?|(?:gnu )?gpl ?v?3(?:\.0)?",
              r"gpl-3\.0(?:-only|-or-later|\+)?", r"gnu\.org/licenses/gpl-3\.0", []),
    "gpl-2": ("general public|gpl", r"(?:the )?(?:gnu )?general public licen[cs]e,?(?: \(?gpl\)?)?,? (?:v|version|ver\.?) ?2(?:\.0)?|(?:gnu )?gpl ?v?2(?:\.0)?",
              r"gpl-2\.0(?:-only|-or-later|\+)?", r"gnu\.org/licenses/(?:old-licenses/)?gpl-2\.0", []),
    "gpl": ("general public", r"(?:the )?(?:gnu )?general public licen[cs]e", r"gpl", r"gnu\.org/licenses/gpl", [
        ("free software foundation", r"under the terms of the gnu general public license as published by the free software foundation")]),
    "lgpl-3": ("general public|lgpl", r"(?:the )?(?:gnu )?lesser general public licen[cs]e,? (?:v|version) ?3(?:\.0)?|(?:gnu )?lgpl ?v?3(?:\.0)?",
               r"lgpl-3\.0(?:-only|-or-later|\+)?", r"gnu\.org/licenses/lgpl-3\.0", []),
    "lgpl-2.1": ("general public|lgpl", r"(?:the )?(?:gnu )?(?:lesser|library) general public licen[cs]e,? (?:v|version) ?2(?:\.[01])?|(?:gnu )?lgpl ?v?2(?:\.[01])?",
                 r"lgpl-2\.[01](?:-only|-or-later|\+)?", r"gnu\.org/licenses/(?:old-licenses/)?lgpl-2\.1", []),
    "lgpl": ("general public", r"(?:the )?(?:gnu )?(?:lesser|library) general public licen[cs]e", r"lgpl", r"gnu\.org/licenses/lgpl", []),
    "agpl-3": ("affero|agpl", r"(?:the )?(?:gnu )?affero general public licen[cs]e(?:,? (?:v|version) ?3(?:\.0)?)?|(?:gnu )?agpl ?v?3(?:\.0)?",
               r"agpl-3\.0(?:-only|-or-later|\+)?", r"gnu\.org/licenses/agpl", []),
    "gfdl": ("free documentation", r"(?:the )?gnu free documentation licen[cs]e(?:,? (?:v|version) ?1\.[123])?",
             r"gfdl-1\.[123](?:-only|-or-later)?", r"gnu\.org/licenses/fdl", []),
    "bsd-2": ("bsd", r"(?:the )?(?:simplified|freebsd|2[ -]clause|two[ -]clause) bsd licen[cs]e|bsd 2[ -]clause(?: licen[cs]e)?",
              r"bsd-2-clause", r"opensource\.org/licenses/bsd-2-clause", []),
    "bsd-3": ("bsd", r"(?:the )?(?:new|modified|revised|3[ -]clause|three[ -]clause) bsd licen[cs]e|bsd 3[ -]clause(?: licen[cs]e)?",
              r"bsd-3-clause", r"opensource\.org/licenses/bsd-3-clause", [
                  ("endorse or promote", r"neither the name of (?s:.{1,80}) nor the names of its contributors may be used to endorse or promote")]),
    "bsd-4": ("bsd", r"(?:the )?(?:original|4[ -]clause|four[ -]clause) bsd licen[cs]e", r"bsd-4-clause", r"spdx\.org/licenses/bsd-4-clause", [
        ("advertising materials", r"all advertising materials mentioning features or use of this software must display")]),
    "bsd": ("bsd", r"(?:the |a )?bsd(?:-style)? licen[cs]e", r"bsd", r"opensource\.org/licenses/bsd-license", [
        ("redistribution and use", r"redistribution and use in source and binary forms,? with or without modification")]),
    "isc": ("isc+licen", r"(?:the )?isc licen[cs]e", r"isc", r"opensource\.org/licenses/isc", [
        ("permission to use, copy", r"permission to use, copy, modify, and/or distribute this software for any purpose")]),
    "mpl-2": ("mozilla", r"(?:the )?mozilla public licen[cs]e,?(?: \(?mpl\)?)?,? (?:v|version|v\.)? ?2(?:\.0)?", r"mpl-2\.0", r"mozilla\.org/mpl/2\.0", [
        ("source code form", r"this source code form is subject to the terms of the mozilla public license")]),
    "mpl": ("mozilla", r"(?:the )?mozilla public licen[cs]e", r"mpl-1\.[01]", r"mozilla\.org/mpl", []),
    "epl": ("eclipse", r"(?:the )?eclipse public licen[cs]e(?:,? (?:v|version) ?[12](?:\.0)?)?", r"epl-[12]\.0", r"eclipse\.org/legal/epl", []),
    "cddl": ("common development", r"(?:the )?common development and distribution licen[cs]e", r"cddl-1\.[01]", r"opensource\.org/licenses/cddl", []),
    "eupl": ("european union", r"(?:the )?european union public licen[cs]e", r"eupl-1\.[012]", r"eupl\.eu", []),
    "artistic": ("artistic", r"(?:the )?(?:perl )?artistic licen[cs]e(?: [12]\.0)?", r"artistic-[12]\.0", r"perlfoundation\.org/artistic", []),
    "boost": ("boost", r"(?:the )?boost software licen[cs]e(?:,? version 1\.0)?", r"bsl-1\.0", r"boost\.org/license_1_0", []),
    "zlib": ("zlib", r"(?:the )?zlib(?:/libpng)? licen[cs]e", r"zlib", r"zlib\.net/zlib_license", [
        ("altered source versions", r"altered source versions must be plainly marked as such")]),
    "unlicense": ("unlicen", r"(?:the )?unlicen[cs]e", r"unlicense", r"unlicense\.org", [
        ("into the public domain", r"this is free and unencumbered software released into the public domain")]),
    "wtfpl": ("what the|wtfpl", r"(?:the )?do what the f\w+ you want to(?: public licen[cs]e)?|wtfpl", r"wtfpl", r"wtfpl\.net", []),
    "psf": ("python", r"(?:the )?python software foundation licen[cs]e|psf licen[cs]e agreement for python", r"psf-2\.0|python-2\.0",
            r"docs\.python\.org/[0-9.]+/license", []),
    "php": ("php+licen", r"(?:the )?php licen[cs]e,?(?: version 3\.01?)?", r"php-3\.01?", r"php\.net/license", []),
    "ruby": ("ruby+licen", r"(?:the )?ruby licen[cs]e", r"ruby", r"ruby-lang\.org/en/about/license", []),
    "vim": ("vim+licen", r"(?:the )?vim licen[cs]e", r"vim", r"vimhelp\.org/uganda", []),
    "x11": ("x11+licen", r"(?:the )?x11 licen[cs]e", r"x11", r"x\.org/releases/x11r", []),
    "postgresql": ("postgresql", r"(?:the )?postgresql licen[cs]e", r"postgresql", r"postgresql\.org/about/licence", []),
    "openssl": ("openssl", r"(?:the )?openssl(?:/ssleay)? licen[cs]e", r"openssl", r"openssl\.org/source/license", []),
    "ofl": ("open font", r"(?:the )?(?:sil )?open font licen[cs]e(?:,? version 1\.[01])?", r"ofl-1\.[01]", r"scripts\.sil\.org/ofl", []),
    "odbl": ("open database", r"(?:the )?open (?:data commons )?open database licen[cs]e|(?:the )?open database licen[cs]e", r"odbl-1\.0",
             r"opendatacommons\.org/licenses/odbl", []),
    "cc0": ("cc0", r"cc0(?: 1\.0)?(?: universal)?", r"cc0-1\.0", r"creativecommons\.org/publicdomain/zero", [
        ("waived all copyright", r"has waived all copyright and related or neighboring rights")]),
    "cc-by-nc-nd": ("cc by|cc-by", r"cc[ -]by[ -]nc[ -]nd(?:[ -][1-4]\.0)?", r"cc-by-nc-nd-[1-4]\.0", r"creativecommons\.org/licenses/by-nc-nd", []),
    "cc-by-nc-sa": ("cc by|cc-by", r"cc[ -]by[ -]nc[ -]sa(?:[ -][1-4]\.0)?", r"cc-by-nc-sa-[1-4]\.0", r"creativecommons\.org/licenses/by-nc-sa", []),
    "cc-by-nc": ("cc by|cc-by", r"cc[ -]by[ -]nc(?![ -](?:nd|sa))(?:[ -][1-4]\.0)?", r"cc-by-nc-[1-4]\.0", r"creativecommons\.org/licenses/by-nc/", []),
    "cc-by-nd": ("cc by|cc-by", r"cc[ -]by[ -]nd(?:[ -][1-4]\.0)?", r"cc-by-nd-[1-4]\.0", r"creativecommons\.org/licenses/by-nd", []),
    "cc-by-sa": ("cc by|cc-by", r"cc[ -]by[ -]sa(?:[ -][1-4]\.0)?", r"cc-by-sa-[1-4]\.0", r"creativecommons\.org/licenses/by-sa", []),
    "cc-by": ("cc by|cc-by", r"(?:(?-i:CC)[ -](?-i:BY)|cc-by|cc by(?=[ -][1-4]\.0))(?![ -](?:nc|nd|sa)\b)(?:[ -][1-4]\.0)?", r"cc-by-[1-4]\.0", r"creativecommons\.org/licenses/by/", []),
    "ms-pl": ("microsoft", r"(?:the )?microsoft public licen[cs]e", r"ms-pl", r"opensource\.org/licenses/ms-pl", []),
    "ncsa": ("ncsa", r"(?:the )?(?:university of illinois/)?ncsa(?: open source)? licen[cs]e", r"ncsa", r"opensource\.org/licenses/ncsa", []),
    "sspl": ("server side", r"(?:the )?server side public licen[cs]e(?:,? (?:v|version) ?1)?", r"sspl-1\.0", r"mongodb\.com/licensing/server-side", []),
    "busl": ("business source", r"(?:the )?business source licen[cs]e(?: 1\.1)?", r"busl-1\.1", r"mariadb\.com/bsl", []),
    "elastic": ("elastic", r"(?:the )?elastic licen[cs]e(?: 2\.0)?", r"elastic-2\.0", r"elastic\.co/licensing/elastic-license", []),
}

#: Creative Commons in full words, with the label they make.
SPELLED = {
    "cc-by-nc-nd": r"attribution[ -]+non-?commercial[ -]+no-?deriv\w*", "cc-by-nc-sa": r"attribution[ -]+non-?commercial[ -]+share-?alike",
    "cc-by-nc": r"attribution[ -]+non-?commercial", "cc-by-nd": r"attribution[ -]+no-?deriv\w*",
    "cc-by-sa": r"attribution[ -]+share-?alike", "cc-by": r"attribution",
}

#: Statements that name no licence.
STATEMENTS = [
    ("public-domain", "public domain", r"(?:(?:is|are|been) )?(?:in|into|dedicated to|placed in|released (?:in)?to) the public domain", 60),
    ("all-rights-reserved", "all rights reserved", r"all rights reserved", 30),
    ("proprietary", "proprietary", r"(?:proprietary and confidential|confidential and proprietary|proprietary licen[cs]e)", 50),
    ("no-warranty", "without warrant", r"without warrant(?:y|ies) of any kind", 10),
    ("copyright", "copyright", r"copyright (?:\(c\)|©)? ?(?:19|20)\d\d", 10),
    ("commercial", "commercial licen", r"(?:under|requires|with) a commercial licen[cs]e", 40),
    ("non-commercial", "non-commercial use", r"for (?:personal,? )?non-commercial use only", 40),
    ("unknown-licence", "licensed under", r"licensed under (?:a|an|the) \w+(?: \w+){0,3} licen[cs]e", 5),
]

_GRANT = r"(?:licen[cs]ed|released|distributed|published|provided|available|covered|offered|shared|open[- ]sourced)"
#: A form: its weight, the keyword if it isn't the licence's own, and the pattern with the name or identifier in it.
NAME_FORMS = [
    (90, r"\b{grant}(?: \w+){{0,2}} under (?:the )?(?:terms (?:and conditions )?of )?(?:{name})(?!\w)"),
    (70, r"\b(?:subject to|governed by|according to|in accordance with|pursuant to|under)(?: the)?(?: terms of)?(?: the)? (?:{name})(?!\w)"),
    (40, r"(?<!\w)(?:{name})(?!\w)"),
]
ID_FORMS = [
    # In an expression, licences before this one are passed; the match is the identifier alone, so that none contains another.
    (100, "spdx", r"spdx-licen[cs]e-identifier:[\t\x20(]*(?:[\w.+-]+[\t\x20()]+(?:or|and|with)[\t\x20(]+)*({name})(?![\w.+-]*\w)"),
    (80, "licen", r"\"?licen[cs]e\"?\s*[:=]\s*\"?(?:{name})(?![\w.+-]*\w)"),
]


#: What a blank in a pattern is turned into. Possessive, so that long white space is passed once.
_WIDE = {" ": r"\s++", " ?": r"\s*+", "[ -]": r"(?:\s++|-)", "[- ]": r"(?:\s++|-)", "[ -]+": r"[\s-]++"}
_BLANK = re.compile(r"\[ -\]\+|\[ -\]|\[- \]| \?| ")
#: The host that a place starts with.
_HOST = re.compile(r"(?:[\w-]|\\\.)+")


def rules() -> list[Rule]:
    """All rules, the heavier first; equal weights stay in the order of the tables."""
    out = []
    add = lambda label, keywords, pattern, weight: out.append(Rule(
        label, tuple(tuple(k.split("+")) for k in keywords.split("|")),
        re.compile(_BLANK.sub(lambda m: _WIDE[m[0]], pattern), re.IGNORECASE | re.ASCII), weight))
    for label, (keyword, names, ids, place, sentences) in LICENCES.items():
        for weight, form in NAME_FORMS:
            add(label, keyword, form.format(grant=_GRANT, name=names), weight)
        for weight, key, form in ID_FORMS:
            add(label, key, form.format(name=ids), weight)
        add(label, _HOST.match(place)[0].replace("\\", ""), place, 85)
        for key, sentence in sentences:
            add(label, key, sentence, 95)
    for label, words in SPELLED.items():
        add(label, "attribution", rf"creative commons[ -]+{words}(?:[ -]+(?:[1-4]\.0|international|licen[cs]e|unported))*", 88)
    for label, keyword, pattern, weight in STATEMENTS:
        add(label, keyword, pattern, weight)
    return sorted(out, key=lambda r: -r.weight)
