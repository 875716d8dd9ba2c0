"""License scans in DataFrame functions: ordered signature rules over word positions."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.spans import EDGE, OTHER, PART, let, matches, outside, quoted, running_sum
from millrace.llm.tables import fresh

# Phrases of the base places, with their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

# What a word is made of: 0-9, A-Z, a-z and everything outside ASCII.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_V = r"(?: version| v)?"
_OR = r"(?: or(?: \(at your option\))?(?: any)? later(?: version)?)?"

# Names of licenses: label, keyword that every match holds as a word, pattern of the name in words.
# A place for a version takes the form "2 0" or "v2 0", as signs between digits are no words.
NAMES: list[tuple[str, str, str]] = [
    ("mit", "mit", r"(?:the )?mit licen[sc]e"),
    ("mit", "expat", r"(?:the )?expat licen[sc]e"),
    ("mit-0", "attribution", r"mit no attribution(?: licen[sc]e)?"),
    ("x11", "x11", r"(?:mit )?x11 licen[sc]e"),
    ("apache-1.0", "apache", rf"apache(?: software)? licen[sc]e{_V} 1 0"),
    ("apache-1.1", "apache", rf"apache(?: software)? licen[sc]e{_V} 1 1"),
    ("apache-2.0", "apache", rf"apache(?: software)? licen[sc]e{_V} v?2(?: 0)?"),
    ("apache", "apache", r"apache(?: software)? licen[sc]e"),
    ("gpl-1.0", "general", rf"(?:gnu )?general public licen[sc]e{_V} v?1(?: 0)?"),
    ("gpl-2.0", "general", rf"(?:gnu )?general public licen[sc]e{_V} v?2(?: 0)?{_OR}"),
    ("gpl-3.0", "general", rf"(?:gnu )?general public licen[sc]e{_V} v?3(?: 0)?{_OR}"),
    ("gpl", "general", r"(?:gnu )?general public licen[sc]e"),
    ("gpl", "gpl", r"(?:gnu )?gpl"),
    ("gpl-2.0", "gpl", rf"(?:gnu )?gpl{_V} v?2(?: 0)?{_OR}"),
    ("gpl-3.0", "gpl", rf"(?:gnu )?gpl{_V} v?3(?: 0)?{_OR}"),
    ("gpl-2.0", "gplv2", "gplv2"),
    ("gpl-3.0", "gplv3", "gplv3"),
    ("lgpl-2.0", "library", rf"(?:gnu )?library general public licen[sc]e{_V} v?2(?: 0)?{_OR}"),
    ("lgpl-2.1", "lesser", rf"(?:gnu )?lesser general public licen[sc]e{_V} v?2 1{_OR}"),
    ("lgpl-3.0", "lesser", rf"(?:gnu )?lesser general public licen[sc]e{_V} v?3(?: 0)?{_OR}"),
    ("lgpl", "lesser", r"(?:gnu )?lesser general public licen[sc]e"),
    ("lgpl", "lgpl", r"(?:gnu )?lgpl"),
    ("agpl-3.0", "affero", rf"(?:gnu )?affero general public licen[sc]e{_V} v?3(?: 0)?{_OR}"),
    ("agpl", "affero", r"(?:gnu )?affero general public licen[sc]e"),
    ("agpl", "agpl", r"(?:gnu )?agpl"),
    ("gfdl", "documentation", r"(?:gnu )?free documentation licen[sc]e"),
    ("bsd-2-clause", "bsd", r"(?:simplified bsd|bsd 2 clause|2 clause bsd)(?: licen[sc]e)?"),
    ("bsd-2-clause", "freebsd", r"freebsd(?: licen[sc]e)?"),
    ("bsd-3-clause", "bsd", r"(?:new bsd|modified bsd|revised bsd|bsd 3 clause|3 clause bsd)(?: licen[sc]e)?"),
    ("bsd-4-clause", "bsd", r"(?:original bsd|old bsd|bsd 4 clause|4 clause bsd)(?: licen[sc]e)?"),
    ("0bsd", "bsd", r"(?:zero clause bsd|bsd zero clause)(?: licen[sc]e)?"),
    ("0bsd", "0bsd", r"0bsd(?: licen[sc]e)?"),
    ("bsd", "bsd", r"bsd(?: style)? licen[sc]e"),
    ("mpl-1.0", "mozilla", rf"mozilla public licen[sc]e{_V} v?1 0"),
    ("mpl-1.1", "mozilla", rf"mozilla public licen[sc]e{_V} v?1 1"),
    ("mpl-2.0", "mozilla", rf"mozilla public licen[sc]e{_V} v?2(?: 0)?"),
    ("mpl", "mozilla", r"mozilla public licen[sc]e"),
    ("epl-1.0", "eclipse", rf"eclipse public licen[sc]e{_V} v?1(?: 0)?"),
    ("epl-2.0", "eclipse", rf"eclipse public licen[sc]e{_V} v?2(?: 0)?"),
    ("epl", "eclipse", r"eclipse public licen[sc]e"),
    ("edl-1.0", "eclipse", r"eclipse distribution licen[sc]e"),
    ("cddl", "development", r"common development and distribution licen[sc]e"),
    ("cpl-1.0", "common", r"common public licen[sc]e"),
    ("eupl", "european", r"european union public licen[sc]e"),
    ("cecill", "cecill", r"cecill(?: [abc])?(?: licen[sc]e)?"),
    ("isc", "isc", r"isc licen[sc]e"),
    ("zlib", "zlib", r"zlib(?: libpng)? licen[sc]e"),
    ("libpng", "libpng", r"libpng licen[sc]e"),
    ("bsl-1.0", "boost", r"boost software licen[sc]e"),
    ("artistic", "artistic", r"artistic licen[sc]e"),
    ("unlicense", "unlicense", r"(?:the )?unlicense"),
    ("wtfpl", "wtfpl", r"wtfpl"),
    ("ofl-1.1", "open", r"(?:sil )?open font licen[sc]e"),
    ("odbl", "open", r"open (?:data commons open )?database licen[sc]e"),
    ("odc-by", "commons", r"open data commons attribution licen[sc]e"),
    ("pddl", "public", r"public domain dedication and licen[sc]e"),
    ("public-domain", "domain", r"(?:released|placed|dedicated) (?:in|into|to) the public domain"),
    ("python-2.0", "python", r"python(?: software foundation)? licen[sc]e"),
    ("php-3.0", "php", r"php licen[sc]e"),
    ("ruby", "ruby", r"ruby licen[sc]e"),
    ("perl", "perl", r"same terms as perl(?: itself)?"),
    ("postgresql", "postgresql", r"postgresql licen[sc]e"),
    ("openssl", "openssl", r"openssl licen[sc]e"),
    ("ncsa", "ncsa", r"(?:university of illinois )?ncsa(?: open source)? licen[sc]e"),
    ("afl-3.0", "academic", r"academic free licen[sc]e"),
    ("osl-3.0", "open", r"open software licen[sc]e"),
    ("ms-pl", "microsoft", r"microsoft public licen[sc]e"),
    ("ms-rl", "microsoft", r"microsoft reciprocal licen[sc]e"),
    ("sspl", "server", r"server side public licen[sc]e"),
    ("busl-1.1", "business", r"business source licen[sc]e"),
    ("elastic-2.0", "elastic", r"elastic licen[sc]e"),
    ("mulan", "mulan", r"mulan (?:psl|permissive software licen[sc]e)"),
    ("openrail", "rail", r"open rail(?: [ms])?(?: licen[sc]e)?"),
    ("openrail", "openrail", r"openrail(?: [ms])?(?: licen[sc]e)?"),
    ("upl-1.0", "universal", r"universal permissive licen[sc]e"),
    ("vim", "vim", r"vim licen[sc]e"),
    ("all-rights-reserved", "rights", r"all rights reserved"),
    ("proprietary", "proprietary", r"proprietary (?:and confidential|licen[sc]e)"),
]

_ANY = r"(?: [^ ]+){0,12}"
# What license texts say themselves: label, keyword, pattern.
TEXTS: list[tuple[str, str, str]] = [
    ("mit", "permission", r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
    ("mit", "sublicense", r"use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons"),
    ("mit", "permission", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("ncsa", "permission", r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal with the software without restriction"),
    ("bsl-1.0", "permission", r"permission is hereby granted free of charge to any person or organi[sz]ation obtaining a copy of the software and accompanying documentation covered by this licen[sc]e"),
    ("x11", "advertising", r"except as contained in this notice the names? of" + _ANY + r" shall not be used in advertising or otherwise to promote the sale"),
    ("bsd", "redistribution", r"redistribution and use in source and binary forms with or without modification are permitted(?: provided that the following conditions are met)?"),
    ("bsd", "redistributions", r"redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd", "redistributions", r"redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation"),
    ("bsd-3-clause", "neither", r"neither the names? of" + _ANY + r" nor the names of (?:its|their|the|any|other)(?: [^ ]+)? ?contributors may be used to endorse or promote products derived from this software"),
    ("bsd-4-clause", "advertising", r"all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("isc", "permission", r"permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice"),
    ("0bsd", "permission", r"permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted"),
    ("postgresql", "permission", r"permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted"),
    ("hpnd", "permission", r"permission to use copy modify and distribute this software and its documentation for any purpose(?: and)? without fee is hereby granted provided"),
    ("apache-2.0", "compliance", r"you may not use this file except in compliance with the licen[sc]e"),
    ("apache-2.0", "required", r"unless required by applicable law or agreed to in writing software distributed under the licen[sc]e is distributed on an as is basis"),
    ("apache-2.0", "apache", r"apache licen[sc]e version 2 0 january 2004"),
    ("gpl-1.0", "redistribute", r"you can redistribute it and or modify it under the terms of the gnu general public licen[sc]e as published by the free software foundation either version 1"),
    ("gpl-2.0", "redistribute", r"you can redistribute it and or modify it under the terms of the gnu general public licen[sc]e(?: version 2)? as published by the free software foundation(?: either)? version 2(?: of the licen[sc]e)?(?: or at your option any later version)?"),
    ("gpl-3.0", "redistribute", r"you can redistribute it and or modify it under the terms of the gnu general public licen[sc]e(?: version 3)? as published by the free software foundation(?: either)? version 3(?: of the licen[sc]e)?(?: or at your option any later version)?"),
    ("gpl", "redistribute", r"you can redistribute it and or modify it under the terms of the gnu general public licen[sc]e"),
    ("lgpl-2.1", "redistribute", r"you can redistribute it and or modify it under the terms of the gnu lesser general public licen[sc]e as published by the free software foundation either version 2 1(?: of the licen[sc]e)?(?: or at your option any later version)?"),
    ("lgpl-3.0", "redistribute", r"you can redistribute it and or modify it under the terms of the gnu lesser general public licen[sc]e as published by the free software foundation either version 3(?: of the licen[sc]e)?(?: or at your option any later version)?"),
    ("lgpl-2.0", "redistribute", r"you can redistribute it and or modify it under the terms of the gnu library general public licen[sc]e"),
    ("agpl-3.0", "redistribute", r"you can redistribute it and or modify it under the terms of the gnu affero general public licen[sc]e as published by the free software foundation either version 3(?: of the licen[sc]e)?(?: or at your option any later version)?"),
    ("gpl-3.0", "gnu", r"gnu general public licen[sc]e version 3 29 june 2007"),
    ("gpl-2.0", "gnu", r"gnu general public licen[sc]e version 2 june 1991"),
    ("lgpl-2.1", "gnu", r"gnu lesser general public licen[sc]e version 2 1 february 1999"),
    ("lgpl-3.0", "gnu", r"gnu lesser general public licen[sc]e version 3 29 june 2007"),
    ("agpl-3.0", "gnu", r"gnu affero general public licen[sc]e version 3 19 november 2007"),
    ("gfdl", "permission", r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation licen[sc]e"),
    ("mpl-1.1", "mozilla", r"the contents of this file are subject to the mozilla public licen[sc]e version 1 1"),
    ("mpl-2.0", "mozilla", r"this source code form is subject to the terms of the mozilla public licen[sc]e v ?2 0"),
    ("epl-1.0", "eclipse", r"(?:this program and the accompanying materials|the accompanying program) (?:is|are) (?:made available|provided) under the terms of (?:the|this) eclipse public licen[sc]e v ?1 0"),
    ("epl-2.0", "eclipse", r"(?:this program and the accompanying materials|the accompanying program) (?:is|are) (?:made available|provided) under the terms of (?:the|this) eclipse public licen[sc]e (?:v ?)?2 0"),
    ("cddl", "development", r"the contents of this file are subject to the terms of the common development and distribution licen[sc]e"),
    ("zlib", "warranty", r"this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software"),
    ("zlib", "misrepresented", r"the origin of this software must not be misrepresented you must not claim that you wrote the original software"),
    ("unlicense", "unencumbered", r"this is free and unencumbered software released into the public domain"),
    ("wtfpl", "verbatim", r"everyone is permitted to copy and distribute verbatim or modified copies of this licen[sc]e document and changing it is allowed"),
    ("wtfpl", "fuck", r"do what the fuck you want to public licen[sc]e"),
    ("cc0-1.0", "deed", r"the person who associated a work with this deed has dedicated the work to the public domain"),
    ("cc0-1.0", "waived", r"to the extent possible under law" + _ANY + r" waived all copyright and related or neighbou?ring rights"),
    ("ofl-1.1", "font", r"this font software is licen[sc]ed under the sil open font licen[sc]e version 1 1"),
    ("beerware", "beer", r"if we meet some day and you think this stuff is worth it you can buy me a beer"),
    ("php-3.0", "php", r"this product includes php software freely available from"),
    ("openssl", "openssl", r"this product includes software developed by the openssl project"),
    ("python-2.0", "python", r"this licen[sc]e agreement is between the python software foundation"),
    ("artistic", "package", r"the intent of this document is to state the conditions under which a package may be copied"),
    ("busl-1.1", "production", r"the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use of the licensed work"),
    ("sspl", "service", r"if you make the functionality of the program or a modified version available to third parties as a service"),
]

# Addresses of licenses: label, keyword, pattern of the words of the address.
ADDRESSES: list[tuple[str, str, str]] = [
    ("apache-2.0", "apache", r"apache org licen[sc]es licen[sc]e 2 0"),
    ("apache-1.1", "apache", r"apache org licen[sc]es licen[sc]e 1 1"),
    ("gpl-2.0", "gnu", r"gnu org licen[sc]es (?:old licen[sc]es )?gpl 2 0"),
    ("gpl-3.0", "gnu", r"gnu org licen[sc]es gpl 3 0"),
    ("gpl", "gnu", r"gnu org licen[sc]es gpl"),
    ("lgpl-2.1", "gnu", r"gnu org licen[sc]es (?:old licen[sc]es )?lgpl 2 1"),
    ("lgpl-3.0", "gnu", r"gnu org licen[sc]es lgpl 3 0"),
    ("lgpl", "gnu", r"gnu org licen[sc]es lgpl"),
    ("agpl-3.0", "gnu", r"gnu org licen[sc]es agpl 3 0"),
    ("agpl", "gnu", r"gnu org licen[sc]es agpl"),
    ("gfdl", "gnu", r"gnu org licen[sc]es fdl(?: 1 [123])?"),
    ("mpl-2.0", "mozilla", r"mozilla org (?:en us )?mpl 2 0"),
    ("mpl-1.1", "mozilla", r"mozilla org (?:en us )?mpl mpl 1 1"),
    ("epl-1.0", "eclipse", r"eclipse org legal epl v10"),
    ("epl-2.0", "eclipse", r"eclipse org legal epl (?:v20|2 0)"),
    ("bsl-1.0", "boost", r"boost org licen[sc]e 1 0"),
    ("unlicense", "unlicense", r"unlicense org"),
    ("cc0-1.0", "creativecommons", r"creativecommons org publicdomain zero 1 0"),
    ("public-domain", "creativecommons", r"creativecommons org publicdomain mark 1 0"),
    ("wtfpl", "wtfpl", r"wtfpl net"),
    ("ofl-1.1", "ofl", r"scripts sil org ofl"),
    ("eupl", "eupl", r"joinup ec europa eu(?: [^ ]+){0,4} eupl"),
]

# Parts of the Creative Commons family: label, short form, long form, each with a version or not.
_CC_PARTS = [
    ("cc-by-nc-nd", "by nc nd", r"attribution non ?commercial no ?deriv(?:ative)?s?"),
    ("cc-by-nc-sa", "by nc sa", r"attribution non ?commercial share ?alike"),
    ("cc-by-nc", "by nc", r"attribution non ?commercial"),
    ("cc-by-nd", "by nd", r"attribution no ?deriv(?:ative)?s?"),
    ("cc-by-sa", "by sa", r"attribution share ?alike"),
    ("cc-by", "by", r"attribution"),
]
_CC_VERSIONS = ["1 0", "2 0", "2 5", "3 0", "4 0"]

# SPDX identifiers by label where the two differ; others in SPDX_SAME are their own label.
SPDX_SAME = (
    "MIT MIT-0 MIT-CMU MIT-Modern-Variant Apache-1.0 Apache-1.1 Apache-2.0 BSD-1-Clause BSD-2-Clause BSD-2-Clause-Patent "
    "BSD-2-Clause-Views BSD-3-Clause BSD-3-Clause-Attribution BSD-3-Clause-Clear BSD-3-Clause-LBNL BSD-3-Clause-Modification "
    "BSD-4-Clause BSD-4-Clause-UC BSD-Source-Code 0BSD MPL-1.0 MPL-1.1 MPL-2.0 MPL-2.0-no-copyleft-exception EPL-1.0 EPL-2.0 "
    "CDDL-1.0 CDDL-1.1 CPL-1.0 EUPL-1.0 EUPL-1.1 EUPL-1.2 CECILL-1.0 CECILL-1.1 CECILL-2.0 CECILL-2.1 CECILL-B CECILL-C ISC "
    "Zlib zlib-acknowledgement Libpng libpng-2.0 BSL-1.0 Artistic-1.0 Artistic-1.0-Perl Artistic-1.0-cl8 Artistic-2.0 Unlicense "
    "WTFPL OFL-1.0 OFL-1.1 ODbL-1.0 ODC-By-1.0 PDDL-1.0 PSF-2.0 Python-2.0 Python-2.0.1 PHP-3.0 PHP-3.01 Ruby PostgreSQL "
    "OpenSSL NCSA AFL-1.1 AFL-1.2 AFL-2.0 AFL-2.1 AFL-3.0 OSL-1.0 OSL-1.1 OSL-2.0 OSL-2.1 OSL-3.0 MS-PL MS-RL SSPL-1.0 BUSL-1.1 "
    "Elastic-2.0 MulanPSL-1.0 MulanPSL-2.0 UPL-1.0 Vim X11 CC0-1.0 CC-PDDC APSL-1.0 APSL-1.1 APSL-1.2 APSL-2.0 Beerware "
    "BlueOak-1.0.0 bzip2-1.0.6 curl ECL-1.0 ECL-2.0 EFL-1.0 EFL-2.0 Fair FTL HPND ICU IJG Info-ZIP Intel IPL-1.0 IPA JSON "
    "LPL-1.0 LPL-1.02 LPPL-1.0 LPPL-1.1 LPPL-1.2 LPPL-1.3a LPPL-1.3c MirOS Motosoto Multics NASA-1.3 Naumen NGPL Nokia NPL-1.0 "
    "NPL-1.1 NPOSL-3.0 NTP OCLC-2.0 OGTSL OLDAP-2.8 QPL-1.0 RPL-1.1 RPL-1.5 RPSL-1.0 RSCPL SGI-B-2.0 SimPL-2.0 SISSL "
    "Sleepycat SMLNJ SPL-1.0 TCL Unicode-3.0 Unicode-DFS-2016 UCL-1.0 VSL-1.0 W3C Watcom-1.0 Xnet ZPL-1.1 ZPL-2.0 ZPL-2.1 "
    "PolyForm-Noncommercial-1.0.0 PolyForm-Small-Business-1.0.0 Hippocratic-2.1 CDLA-Permissive-1.0 CDLA-Permissive-2.0 "
    "CDLA-Sharing-1.0 CAL-1.0 CPAL-1.0 CUA-OPL-1.0 Entessa eCos-2.0 EUDatagrid Frameworx-1.0 LiLiQ-P-1.1 LiLiQ-R-1.1 "
    "LiLiQ-Rplus-1.1 Linux-OpenIB Linux-syscall-note"
).split()
SPDX_LABELS = {"MulanPSL-1.0": "mulan", "MulanPSL-2.0": "mulan", "ODbL-1.0": "odbl", "ODC-By-1.0": "odc-by", "PDDL-1.0": "pddl"}
# Families whose identifiers with a version mean a license wherever they stand.
SPDX_PLAIN = set("Apache MPL EPL CDDL CPL EUPL CECILL BSL OFL AFL OSL SSPL BUSL UPL GPL LGPL AGPL GFDL".split())
# Families whose identifiers may end in +, -only or -or-later.
SPDX_LATER = [f"{family}-{version}" for family, versions in {"GPL": "1.0 2.0 3.0", "LGPL": "2.0 2.1 3.0", "AGPL": "1.0 3.0", "GFDL": "1.1 1.2 1.3"}.items() for version in versions.split()]

# Identifiers without a version that mean a license after the bare word "license".
PLAIN_NAMES = "mit isc zlib 0bsd unlicense wtfpl ncsa postgresql openssl".split()

# Ways to say that a name is the license: before it, after it, with what they are worth.
_BEFORE = r"(?:licen[sc]ed under|released under|distributed under|available under|covered by|subject to|under|licen[sc]e) (?:the )?(?:terms of )?(?:the )?"
# What stands before an identifier: keyword, pattern, worth, whether any identifier counts.
BEFORE_NAMES = [
    ("opensource", r"opensource org licen[sc]es?", 1.0, True),
    ("spdx", r"spdx org licen[sc]es", 1.0, True),
    ("choosealicense", r"choosealicense com licen[sc]es", 1.0, True),
    *((word, rf"{word} under(?: the)?(?: terms of)?(?: the)?", 0.95, True) for word in ("licensed", "licenced")),
    *((word, rf"{word}(?: type| id| name| is| the)?", 0.9, False) for word in ("license", "licence")),
]


@dataclass(frozen=True)
class Rule:
    """``pattern`` over words with one space between them; a rule of higher ``priority`` hides
    those whose places lie within its own, and one with a longer place those of its own
    priority. ``worth``: how sure a place is. Without a ``label``, the license is the
    identifier that follows ``pattern``."""

    label: str | None
    keyword: str
    pattern: str
    priority: int
    worth: float


def rules() -> list[Rule]:
    """All signature rules in order of priority, the most telling first."""
    out = []
    for label, keyword, name in NAMES:
        # a version in the label says that the name holds one
        exact = 2 * any(c.isdigit() for c in label)
        out.append(Rule(label, keyword, f"{_BEFORE}{name}", 50 + exact, 0.95))
        out.append(Rule(label, keyword, name, 30 + exact, 0.8 if " " in name else 0.5))
    for label, short, long in _CC_PARTS:
        rank = len(short.split())
        for version in _CC_VERSIONS:
            out.append(Rule(f"{label}-{version.replace(' ', '.')}", "cc", f"(?:{_BEFORE})?cc {short} {version}", 45 + rank, 0.95))
            out.append(Rule(f"{label}-{version.replace(' ', '.')}", "creativecommons", f"creativecommons org licen[sc]es {short} {version}", 55 + rank, 1.0))
            out.append(Rule(f"{label}-{version.replace(' ', '.')}", "creative", f"creative commons {long} {version}", 45 + rank, 0.95))
        out.append(Rule(label, "cc", f"(?:{_BEFORE})?cc {short}", 35 + rank, 0.8))
        out.append(Rule(label, "creative", f"creative commons {long}(?: licen[sc]e)?", 35 + rank, 0.8))
    out.append(Rule("cc0-1.0", "cc0", r"cc0(?: 1 0)?(?: universal)?", 40, 0.9))
    out.append(Rule("cc0-1.0", "zero", r"creative commons zero(?: v?1 0)?", 40, 0.9))
    out.append(Rule("cc", "creative", r"creative commons(?: licen[sc]e)?", 20, 0.5))
    # a version in the label: among texts that begin alike it is the longer
    out += [Rule(label, keyword, text, 62 + 2 * any(c.isdigit() for c in label), 1.0) for label, keyword, text in TEXTS]
    out += [Rule(label, keyword, address, 58 + any(c.isdigit() for c in label), 1.0) for label, keyword, address in ADDRESSES]
    out += [Rule(None, keyword, before, 54, worth) for keyword, before, worth, _ in BEFORE_NAMES]
    for name, label in identifiers().items():
        # the identifiers of some families count wherever they stand
        if name.split()[0] in {f.lower() for f in SPDX_PLAIN} and any(c.isdigit() for c in name):
            out.append(Rule(label, name.split()[0], name, 33, 0.8))
    return sorted(out, key=lambda r: (-r.priority, r.label or "", r.pattern))


def identifiers() -> dict[str, str]:
    """The label of every identifier, given in words with one space between them."""
    out = {_words_of(name): SPDX_LABELS.get(name, name.lower()) for name in SPDX_SAME}
    for name in SPDX_LATER:
        out |= {_words_of(f"{name}{end}"): name.lower() for end in ("", "-only", "-or-later")}
    for label, short, _ in _CC_PARTS:
        out |= {f"cc {short} {version}": f"{label}-{version.replace(' ', '.')}" for version in _CC_VERSIONS}
    return out


def _words_of(name: str) -> str:
    return " ".join(re.findall(r"[0-9a-z]+", name.lower()))


def _one_of(names: list[str]) -> str:
    """A pattern of any of these; a longer one before those that it begins with."""
    return f"(?:{'|'.join(sorted(names, key=lambda n: (-len(n), n)))})"


def _any_case(words: list[str]) -> str:
    """A pattern of any of these ASCII words in either case, letter by letter: few of them are
    tried at a place."""

    def node(rest: set[str]) -> str:
        branches = []
        for c in sorted({w[0] for w in rest if w}):
            letter = f"[{c}{c.upper()}]" if c.isalpha() else c
            branches.append(letter + node({w[1:] for w in rest if w[:1] == c}))
        inner = "|".join(branches)
        if "" in rest:
            return f"(?:{inner})?" if inner else ""
        return f"(?:{inner})" if len(branches) > 1 else inner

    return node(set(words))


def _needle(pattern: str) -> str:
    """The longest text that every match of a pattern holds literally."""
    bare = re.sub(r"\\.", "\0", pattern)
    group = re.compile(r"\(\?:[^()]*\)(?:\?|\{\d+,\d+\})?|\[[^\]]*\][?+*]?|[^\0]\?")
    while group.search(bare):
        bare = group.sub("\0", bare)
    return max(bare.split("\0"), key=len)


def scan_licenses(docs: DataFrame, text: str = "text", signatures: list[Rule] | None = None) -> DataFrame:
    """The rows of ``docs`` with ``n_words`` and ``licenses``.

    ``licenses`` is an array of ``start, end, label, base, worth``, by start: places in words,
    from 0, ends exclusive, of the lower-case (A-Z) words of the whole text. ``base`` marks
    the places of the base phrases, all of which stay. The others are those of the rules:
    every rule is matched whose keyword and literal part the text holds, leftmost and not overlapping with
    itself, and a place goes where one of a rule of higher priority, or a longer one of the
    same priority, holds it whole.

    After the mark ``SPDX-License-Identifier`` an expression is read token by token, of any
    length: identifiers with ``or``, ``and`` or ``with`` between them, brackets ignored. It
    ends at the first token that is not followed by an operator. Each known identifier is a
    place, above all rules; unknown ones are passed over.

    A null or empty text has no words and no places. Repeated rows are each scanned. Other
    columns stay as they are, except those of the two names. An empty table gives no rows.
    """
    signatures = rules() if signatures is None else signatures
    kept = [c for c in docs.columns if c not in ("n_words", "licenses")]
    bare_name, low, joined = (fresh(docs.columns, name) for name in ("bare", "low", "joined"))
    own = [F.col(f"`{c}`") for c in kept]
    raw = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    # one space for each run of other signs: as many spaces as words, once the ends are bare
    bare = F.trim(F.regexp_replace(raw, _NOT_WORD, " "))
    keywords = sorted({r.keyword for r in signatures} | {phrase.split()[0] for phrase in BASE} | {"spdx"})
    # most texts hold no keyword and are spared the rules
    telling = f"{bare_name} RLIKE '(?<![^ ]){_any_case(keywords)}(?![^ ])'"
    found = f"concat({_base_places(low)}, {_rule_places(signatures, low, joined)})"
    # generators keep an expression from being copied into each of its uses
    worded = docs.select(*own, raw.alias(joined), F.explode(F.array(bare)).alias(bare_name))
    worded = worded.select(
        *own,
        F.expr(f"CAST(IF({bare_name} = '', 0, {_spaces(bare_name)} + 1) AS bigint)").alias("n_words"),
        F.explode(F.expr(f"array(IF({telling}, {_lowered(bare_name)}, NULL))")).alias(low),
        joined,
    )
    worded = worded.select(*own, "n_words", low, F.explode(F.expr(f"array(IF(contains({low}, ' spdx '), {_joined(joined)}, NULL))")).alias(joined))
    places = F.expr(f"CAST(IF({low} IS NULL, array(), array_sort({found})) AS {_PLACES})")
    return worded.select(*own, "n_words", places.alias("licenses"))


_PLACES = "array<struct<start: bigint, end: bigint, label: string, base: boolean, worth: double>>"
_PLACE = "named_struct('start', {start}, 'end', {end}, 'label', {label}, 'base', {base}, 'worth', {worth}D)"
_NOT_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _spaces(piece: str) -> str:
    return f"(length({piece}) - length(replace({piece}, ' ', '')))"


def _lowered(words: str) -> str:
    """The words in lower case, between spaces, and no mark of our own among them."""
    return f"concat(' ', translate({words}, '{_UPPER}{EDGE}{PART}', '{_LOWER}{OTHER}{OTHER}'), ' ')"


def _joined(raw: str) -> str:
    """The words in lower case, those joined by signs as within an identifier with a ``PART`` between them."""
    signs = quoted(rf"(?<=[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F{PART}])[-.+:_]+(?=[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F])")
    bare = f"trim(regexp_replace(regexp_replace(translate({raw}, '{EDGE}{PART}', '{OTHER}{OTHER}'), {signs}, '{PART}'), {quoted(_NOT_WORD)}, ' '))"
    return f"concat(' ', translate({bare}, '{_UPPER}', '{_LOWER}'), ' ')"


def _found(low: str, pattern: str) -> str:
    """``start, piece`` of every match between spaces; a start counts the spaces before it."""
    marked = f"regexp_replace({low}, concat('(?<= )(?:', {pattern}, ')(?= )'), '{EDGE}$0{EDGE}')"
    return matches(marked, _spaces("{p}"))


def _as_place(label: str, base: str, worth: str) -> str:
    # the first space stands before word 0
    end = f"CAST(m.start + {_spaces('m.piece')} AS bigint)"
    return _PLACE.format(start="CAST(m.start - 1 AS bigint)", end=end, label=label, base=base, worth=worth).replace("r.worthD", "r.worth")


def _base_places(low: str) -> str:
    each = [f"transform({_found(low, quoted(phrase))}, m -> {_as_place(quoted(label), 'true', '0.8')})" for phrase, label in BASE.items()]
    return f"concat({', '.join(each)})"


def _rule_places(signatures: list[Rule], low: str, joined: str) -> str:
    """Places of the expressions and rules in order, without those inside a place of higher priority."""
    named = identifiers()
    telling = [n for n in named if any(c.isdigit() for c in n) or n in PLAIN_NAMES]
    patterns = {before: _one_of(list(named) if any_ else telling) for _, before, _, any_ in BEFORE_NAMES}
    rows = [
        f"named_struct('label', {quoted(r.label) if r.label else 'CAST(NULL AS string)'}, 'keyword', {quoted(r.keyword)}, 'needle', {quoted(_needle(r.pattern))}, 'before', {quoted(r.pattern)}, "
        f"'pattern', {quoted(r.pattern if r.label else f'{r.pattern} {patterns.get(r.pattern, _one_of(list(named)))}')}, 'priority', {r.priority}, 'worth', {r.worth}D)"
        for r in signatures
    ]
    labels = f"map({', '.join(f'{quoted(n)}, {quoted(label)}' for n, label in named.items())})"
    expressions = f"IF({joined} IS NULL, CAST(array() AS {_PLACES}), {_expressions(joined, labels)})"
    if not rows:
        return expressions
    after = f"try_element_at({labels}, regexp_replace(m.piece, concat('^(?:', r.before, ') '), ''))"
    place = _as_place(f"coalesce(r.label, {after})", "false", "r.worth")

    # one pass finds the keywords of a text, and few rules are left to look further
    keywords = _any_case(sorted({r.keyword for r in signatures}))
    present = f"array_distinct(regexp_extract_all({low}, '(?<= ){keywords}(?= )', 0))"

    def by_level(held: str) -> str:
        of_level = f"flatten(transform(filter({held}, r -> r.priority = level), r -> transform({_found(low, 'r.pattern')}, m -> {place})))"
        levels = f"sort_array(array_distinct(transform({held}, r -> r.priority)), false)"
        return f"aggregate({levels}, {expressions}, (kept, level) -> concat(kept, {outside(of_level, 'kept')}))"

    return let(
        present,
        lambda words: let(f"filter(array({', '.join(rows)}), r -> array_contains({words}, r.keyword) AND contains({low}, r.needle))", by_level),
    )


def _expressions(joined: str, labels: str) -> str:
    """Places of the known identifiers in expressions after the mark."""
    mark = f"spdx{PART}licen[sc]e{PART}identifier"
    token = f"(?!{mark})[^ ]+"
    whole = rf"(?<= ){mark}[ {PART}]{token}(?: (?:or|and|with) {token})*(?= )"
    marked = f"regexp_replace({joined}, {quoted(whole)}, '{EDGE}$0{EDGE}')"
    words = f"length({{p}}) - length(translate({{p}}, ' {PART}', ''))"
    # tokens of an expression, the mark as the first, with the words before each
    parted = f"split(regexp_replace(e.piece, {quoted(f'^({mark}){PART}')}, '$1 '), ' ')"

    def tokens(parts: str) -> str:
        def placed(ends: str) -> str:
            name = f"replace(t, '{PART}', ' ')"
            end = f"CAST(e.start - 1 + {ends}[i] AS bigint)"
            start = f"CAST(e.start - 1 + {ends}[i] - (length(t) - length(replace(t, '{PART}', '')) + 1) AS bigint)"
            told = _PLACE.format(start=start, end=end, label=f"try_element_at({labels}, {name})", base="false", worth="1.0")
            return f"transform({parts}, (t, i) -> {told})"

        return let(running_sum(f"transform({parts}, t -> length(t) - length(replace(t, '{PART}', '')) + 1)"), placed)

    return f"filter(flatten(transform({matches(marked, words)}, e -> {let(parted, tokens)})), p -> p.label IS NOT NULL)"
