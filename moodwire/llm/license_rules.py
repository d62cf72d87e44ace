"""Ordered signature rules for license texts.

A rule is a regular expression over a document's words (lower case, one space between words, one
at each end), a label, a priority and a keyword that must occur for it to be tried. The hand-written
parts are below: names of licenses, versions, tags, addresses and passages of texts and notices; ``rules()`` puts
the notice forms around the names and gives the whole list, in order.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

# Priorities: what says most about the license wins over what lies inside it.
TAG, TEXT, NOTICE, ADDRESS, NAME, HINT = 90, 80, 70, 60, 50, 20

# The base phrases of the contract and their labels.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# A version: "2", "2 0", "v2", "version 2 0"; {0} is its regular expression. Words hold no points or hyphens.
_V = r"(?: version)? v?{0}"
_OR_LATER = r"(?: only| or later| or any later version)?"


@dataclass(frozen=True)
class Rule:
    label: str
    priority: int
    keyword: str  # a piece of the words that every match holds
    pattern: str
    base: bool = False


# label, keyword, name of the license as words, SPDX identifier as words (or None), address as words (or None)
LICENSES = [
    ("gpl-1.0", "public license", rf"gnu general public license{_V.format('1(?: 0)?')}{_OR_LATER}", "gpl 1 0", None),
    ("gpl-2.0", "public license", rf"gnu general public license{_V.format('2(?: 0)?')}{_OR_LATER}", "gpl 2 0", "gnu org licenses old licenses gpl 2 0"),
    ("gpl-3.0", "public license", rf"gnu general public license{_V.format('3(?: 0)?')}{_OR_LATER}", "gpl 3 0", "gnu org licenses gpl 3 0"),
    ("gpl", "public license", r"gnu general public licenses?", "gpl", "gnu org licenses gpl"),
    ("lgpl-2.0", "public license", rf"gnu (?:library|lesser) general public license{_V.format('2(?: 0)?')}{_OR_LATER}", "lgpl 2 0", None),
    ("lgpl-2.1", "public license", rf"gnu lesser general public license{_V.format('2 1')}{_OR_LATER}", "lgpl 2 1", "gnu org licenses old licenses lgpl 2 1"),
    ("lgpl-3.0", "public license", rf"gnu lesser general public license{_V.format('3(?: 0)?')}{_OR_LATER}", "lgpl 3 0", "gnu org licenses lgpl 3 0"),
    ("lgpl", "public license", r"gnu (?:library|lesser) general public license", "lgpl", "gnu org licenses lgpl"),
    ("agpl-3.0", "public license", rf"gnu affero general public license{_V.format('3(?: 0)?')}{_OR_LATER}", "agpl 3 0", "gnu org licenses agpl 3 0"),
    ("agpl", "public license", r"(?:gnu )?affero general public license", "agpl", "gnu org licenses agpl"),
    ("gfdl", "documentation license", r"gnu free documentation license", "gfdl 1 [123]", "gnu org licenses fdl"),
    ("apache-1.1", "apache", rf"apache (?:software )?license{_V.format('1 1')}", "apache 1 1", "apache org licenses license 1 1"),
    ("apache-2.0", "apache", rf"apache (?:software )?license{_V.format('2(?: 0)?')}", "apache 2 0", "apache org licenses license 2 0"),
    ("apache", "apache", r"apache (?:software )?license", "apache", "apache org licenses"),
    ("mit", " mit ", r"mit (?:x11 )?license", "mit", "opensource org licenses mit"),
    ("mit-0", " mit ", r"mit no attribution(?: license)?", "mit 0", "opensource org licenses mit 0"),
    ("x11", " x11 ", r"x11 license", "x11", None),
    ("isc", " isc ", r"isc license", "isc", "opensource org licenses isc"),
    ("bsd-2-clause", "bsd", r"(?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd)(?: license)", "bsd 2 clause", "opensource org licenses bsd 2 clause"),
    ("bsd-3-clause", "bsd", r"(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd)(?: license)", "bsd 3 clause", "opensource org licenses bsd 3 clause"),
    ("bsd-4-clause", "bsd", r"(?:bsd 4 clause|4 clause bsd|original bsd)(?: license)", "bsd 4 clause", None),
    ("bsd-0-clause", "bsd", r"(?:zero clause bsd|bsd zero clause|0bsd)(?: license)", "0bsd", "opensource org licenses 0bsd"),
    ("bsd", "bsd", r"bsd (?:style )?license", "bsd", "opensource org licenses bsd license"),
    ("mpl-1.1", "mozilla", rf"mozilla public license{_V.format('1 1')}", "mpl 1 1", "mozilla org mpl 1 1"),
    ("mpl-2.0", "mozilla", rf"mozilla public license{_V.format('2(?: 0)?')}", "mpl 2 0", "mozilla org mpl 2 0"),
    ("mpl", "mozilla", r"mozilla public license", "mpl", "mozilla org mpl"),
    ("epl-1.0", "eclipse", rf"eclipse public license{_V.format('1(?: 0)?')}", "epl 1 0", "eclipse org legal epl v10"),
    ("epl-2.0", "eclipse", rf"eclipse public license{_V.format('2(?: 0)?')}", "epl 2 0", "eclipse org legal epl 2 0"),
    ("epl", "eclipse", r"eclipse public license", "epl", "eclipse org legal epl"),
    ("edl-1.0", "eclipse", r"eclipse distribution license", "edl 1 0", "eclipse org org documents edl v10"),
    ("cddl-1.0", "distribution license", r"common development and distribution license", "cddl 1 [01]", "opensource org licenses cddl 1 0"),
    ("cpl-1.0", "common public", r"common public license", "cpl 1 0", "opensource org licenses cpl1 0"),
    ("ipl-1.0", "ibm", r"ibm public license", "ipl 1 0", None),
    ("artistic-1.0", "artistic", rf"artistic license{_V.format('1(?: 0)?')}", "artistic 1 0", "opensource org licenses artistic license 1 0"),
    ("artistic-2.0", "artistic", rf"artistic license{_V.format('2(?: 0)?')}", "artistic 2 0", "opensource org licenses artistic license 2 0"),
    ("artistic", "artistic", r"artistic license", None, None),
    ("boost-1.0", "boost", r"boost software license", "bsl 1 0", "boost org license 1 0"),
    ("zlib", "zlib", r"zlib (?:libpng )?license", "zlib", "opensource org licenses zlib"),
    ("libpng", "libpng", r"libpng license", "libpng(?: 2 0)?", None),
    ("unlicense", "unlicense", r"the unlicense", "unlicense", "unlicense org"),
    ("wtfpl", "public license", r"do what the fuck you want to public license", "wtfpl", "wtfpl net"),
    ("python-2.0", "python", r"python software foundation license", "python 2 0", "opensource org licenses python 2 0"),
    ("php-3.01", " php ", r"php license", "php 3 01?", "php net license"),
    ("ruby", " ruby ", r"ruby license", "ruby", None),
    ("openssl", "openssl", r"openssl license", "openssl", "openssl org source license"),
    ("postgresql", "postgresql", r"postgresql license", "postgresql", "opensource org licenses postgresql"),
    ("ofl-1.1", "open font", r"sil open font license", "ofl 1 1", "scripts sil org ofl"),
    ("eupl-1.2", "european union", r"european union public licen[cs]e", "eupl 1 [012]", "joinup ec europa eu"),
    ("cecill-2.1", "cecill", r"cecill(?: [bc])? (?:free software )?license", "cecill(?: [bc])? 2 [01]", "cecill info licences"),
    ("ms-pl", "microsoft", r"microsoft public license", "ms pl", "opensource org licenses ms pl"),
    ("ms-rl", "microsoft", r"microsoft reciprocal license", "ms rl", "opensource org licenses ms rl"),
    ("afl-3.0", "academic", r"academic free license", "afl 3 0", "opensource org licenses afl 3 0"),
    ("osl-3.0", "open software", r"open software license", "osl 3 0", "opensource org licenses osl 3 0"),
    ("ncsa", "ncsa", r"(?:university of illinois )?ncsa(?: open source)? license", "ncsa", "opensource org licenses ncsa"),
    ("upl-1.0", "universal permissive", r"universal permissive license", "upl 1 0", "opensource org licenses upl"),
    ("bsl-1.1", "business source", r"business source license", "busl 1 1", "mariadb com bsl11"),
    ("sspl-1.0", "server side", r"server side public license", "sspl 1 0", "mongodb com licensing server side public license"),
    ("elastic-2.0", "elastic", r"elastic license", "elastic 2 0", "elastic co licensing elastic license"),
    ("odbl-1.0", "database license", r"open (?:data commons open )?database license", "odbl 1 0", "opendatacommons org licenses odbl"),
    ("odc-by-1.0", "attribution license", r"open data commons attribution license", "odc by 1 0", "opendatacommons org licenses by"),
    ("pddl-1.0", "dedication and license", r"public domain dedication and license", "pddl 1 0", "opendatacommons org licenses pddl"),
    ("cdla-permissive", "data license agreement", r"community data license agreement(?: permissive)?", "cdla permissive [12] 0", "cdla dev permissive"),
    ("openrail", "rail", r"(?:big ?science |creativeml )?open ?rail(?: m| \+\+ m)? license", "openrail(?: m)?", None),
    ("llama-community", "llama", r"llama(?: [234])?(?: [0-9])? community license(?: agreement)?", None, "llama meta com llama"),
]

# Creative Commons: the forms differ by their elements and version.
CC_ELEMENTS = [
    ("cc-by", "by", "attribution"),
    ("cc-by-sa", "by sa", "attribution share ?alike"),
    ("cc-by-nd", "by nd", "attribution no ?deriv(?:ative|ativework)?s?"),
    ("cc-by-nc", "by nc", "attribution non ?commercial"),
    ("cc-by-nc-sa", "by nc sa", "attribution non ?commercial share ?alike"),
    ("cc-by-nc-nd", "by nc nd", "attribution non ?commercial no ?deriv(?:ative|ativework)?s?"),
]
CC_VERSIONS = ["1 0", "2 0", "2 5", "3 0", "4 0"]

# label, keyword, passage of the license's text or of its usual notice
PASSAGES = [
    ("mit", "permission is hereby granted", r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "sublicense", r"to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("mit", "permission notice", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("isc", "permission to use", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("bsd", "source and binary forms", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", "redistributions", r"redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd-3-clause", "endorse or promote", r"neither the names? of .{1,80}? nor the names of its contributors may be used to endorse or promote products derived from this software"),
    ("bsd-4-clause", "advertising materials", r"all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("apache-2.0", "apache", r"licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("apache-2.0", "applicable law", r"unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    ("apache-1.1", "apache software foundation", r"this product includes software developed by the apache software foundation"),
    ("gpl", "free software", r"this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("gpl", "useful", r"this program is distributed in the hope that it will be useful but without any warranty"),
    ("lgpl", "free software", r"this library is free software you can redistribute it and or modify it under the terms of the gnu (?:library|lesser) general public license"),
    ("agpl", "affero", r"under the terms of the gnu affero general public license"),
    ("gfdl", "documentation license", r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
    ("mpl-2.0", "mozilla", r"this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("mpl", "mpl", r"if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("epl", "eclipse", r"this program and the accompanying materials are made available under the terms of the eclipse public license"),
    ("cddl-1.0", "distribution license", r"the contents of this file are subject to the terms of the common development and distribution license"),
    ("boost-1.0", "boost", r"distributed under the boost software license version 1 0"),
    ("zlib", "express or implied", r"this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages"),
    ("unlicense", "public domain", r"this is free and unencumbered software released into the public domain"),
    ("wtfpl", "what the fuck", r"you just do what the fuck you want to"),
    ("artistic", "artistic", r"under the terms of the artistic license"),
    ("artistic", "perl itself", r"under the same terms as perl itself"),
    ("ofl-1.1", "font software", r"this font software is licensed under the sil open font license version 1 1"),
    ("cc0-1.0", "waived", r"waived all copyright and related or neighbou?ring rights"),
    ("cc0-1.0", "cc0", r"(?:creative commons )?cc0 1 0(?: universal)?"),
    ("cc0-1.0", "creative commons", r"creative commons (?:cc0|zero)(?: 1 0)?(?: universal)?"),
    ("public-domain", "public domain", r"(?:released|dedicated|placed) (?:in|in ?to) the public domain"),
    ("cc", "creative commons", r"licensed under (?:a|the) creative commons"),
    ("proprietary", "all rights reserved", r"all rights reserved"),
    ("proprietary", "proprietary", r"(?:confidential and proprietary|proprietary and confidential)"),
    ("proprietary", " written ", r"without (?:the )?(?:express |prior )+written (?:permission|consent)"),
]

# label, keyword, weak hint
HINTS = [
    ("gpl", "gpl", r"gpl(?:v[123])?"),
    ("lgpl", "lgpl", r"lgpl(?:v[23])?"),
    ("agpl", "agpl", r"agpl(?:v3)?"),
    ("gpl", "public license", r"general public license"),
    ("mpl", "mplv", r"mplv[12]"),
    ("cc", "creative commons", r"creative commons"),
    ("copyleft", "copyleft", r"copyleft"),
]

# Forms around a name or an identifier.
NOTICES = [
    r"(?:is |are |being )?(?:re)?(?:licensed|released|distributed|published|available|provided) (?:under|with|by) (?:the )?(?:terms of (?:the )?)?{0}",
    r"(?:under|subject to) (?:the )?(?:terms|conditions|provisions)(?: and conditions)? of (?:the )?{0}",
    r"licen[cs]e (?:is |type |name )?{0}",
]


def rules() -> list[Rule]:
    """All rules in their order: base phrases, then tags, texts, notices, addresses, names and hints."""
    out = [Rule(label, NAME, phrase, phrase, True) for phrase, label in BASE_PHRASES.items()]
    named = list(LICENSES)
    for label, short, long in CC_ELEMENTS:
        named += [(f"{label}-{v.replace(' ', '.')}", "cc by", rf"cc {short} {v}", f"cc {short} {v}",
                   f"creativecommons org licenses {short} {v}") for v in CC_VERSIONS]
        named += [(f"{label}-{v.replace(' ', '.')}", "creative commons", rf"creative commons {long}(?: international| unported)?{_V.format(v)}"
                   r"(?: international| unported| generic)?", None, None) for v in CC_VERSIONS]
        named.append((label, "cc by", rf"cc {short}", None, f"creativecommons org licenses {short}"))
        named.append((label, "creative commons", rf"creative commons {long}", None, None))
    named.append(("cc0-1.0", "cc0", r"cc0", "cc0 1 0", "creativecommons org publicdomain zero 1 0"))
    for label, _, _, tag, _ in named:
        if tag:
            out.append(Rule(label, TAG, "spdx", rf"spdx license identifier {tag}(?: only| or later)?"))
    out += [Rule(label, TEXT, keyword, pattern) for label, keyword, pattern in PASSAGES]
    for label, keyword, name, _, _ in named:
        out += [Rule(label, NOTICE, keyword, form.format(f"(?:{name})")) for form in NOTICES]
    out += [Rule(label, ADDRESS, address.split(" ")[0], address) for label, _, _, _, address in named if address]
    out += [Rule(label, NAME, keyword, name) for label, keyword, name, _, _ in named]
    out += [Rule(label, HINT, keyword, pattern) for label, keyword, pattern in HINTS]
    return out


def compiled(rule: Rule) -> re.Pattern:
    """The rule between word borders; matches may share the space between them."""
    return re.compile(rf"(?<= )(?:{rule.pattern})(?= )")
