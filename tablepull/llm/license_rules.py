"""Signature rules of licenses, over texts of lower-case words with one blank between them.

Names of licenses are written by hand; each makes three rules (an identifier, a grant, the bare
name). Passages of license texts and general hints are rules by themselves. The order of the list decides
last between rules of one priority.
"""

from __future__ import annotations

import re
from typing import NamedTuple

# No rule matches more words than this.
MAX_WORDS = 40


class Rule(NamedTuple):
    """``keyword`` stands in every match of ``pattern``; ``weight`` is how sure a match makes."""

    label: str
    keyword: str
    pattern: str
    priority: int
    weight: float


# Every match of a rule holds one of these at least.
STEMS = (
    "licen", "spdx", "copyright", "rights reserved", "rights are reserved", "public domain", "cc by", "cc0", "creative commons", "warrant", "hereby granted",
    "redistribut", "gpl", "bsd", "confidential", "proprietary", "permission notice", "written permission", "advertising materials",
    "plainly marked", "object code", "font name", "eclipse org",
)

# (label, keyword, pattern of the name)
NAMES = (
    ("mit", "mit licen", r"mit licen[cs]e"),
    ("mit-0", "mit no attribution", r"mit no attribution licen[cs]e"),
    ("expat", "expat licen", r"expat licen[cs]e"),
    ("x11", "x11 licen", r"x11 licen[cs]e"),
    ("isc", "isc licen", r"isc licen[cs]e"),
    ("0bsd", "bsd", r"(?:zero clause bsd|bsd zero clause|0bsd)(?: licen[cs]e)?"),
    ("bsd-1-clause", "bsd", r"(?:(?:1|one) clause bsd|bsd (?:1|one) clause)(?: licen[cs]e)?"),
    ("bsd-2-clause", "bsd", r"(?:(?:simplified|2 clause|two clause) bsd|bsd (?:2|two) clause)(?: licen[cs]e)?"),
    ("bsd-3-clause", "bsd", r"(?:(?:new|modified|revised|3 clause|three clause) bsd|bsd (?:3|three) clause)(?: licen[cs]e)?"),
    ("bsd-4-clause", "bsd", r"(?:(?:original|4 clause|four clause) bsd|bsd (?:4|four) clause)(?: licen[cs]e)?"),
    ("bsd", "bsd", r"bsd(?: style| type)? licen[cs]e"),
    ("apache-1.1", "apache", r"apache (?:software )?licen[cs]e (?:version |v )?1 1"),
    ("apache-2.0", "apache", r"apache (?:(?:software )?licen[cs]e (?:version |v )?(?:2|v2)(?: 0)?|(?:2|v2)(?: 0)? licen[cs]e)"),
    ("apache", "apache", r"apache (?:software )?licen[cs]e"),
    ("gpl-1.0", "general public licen", r"gnu general public licen[cs]e (?:version |v )?1(?: 0)?"),
    ("gpl-2.0", "general public licen", r"gnu general public licen[cs]e (?:version |v )?(?:2|v2)(?: 0)?"),
    ("gpl-3.0", "general public licen", r"gnu general public licen[cs]e (?:version |v )?(?:3|v3)(?: 0)?"),
    ("gpl", "general public licen", r"gnu general public licen[cs]e"),
    ("gpl-2.0-short", "gpl", r"(?:gnu )?(?:gplv2|gpl2|gpl (?:version |v )?(?:2|v2)(?: 0)?)(?: licen[cs]e)?"),
    ("gpl-3.0-short", "gpl", r"(?:gnu )?(?:gplv3|gpl3|gpl (?:version |v )?(?:3|v3)(?: 0)?)(?: licen[cs]e)?"),
    ("gpl-short", "gpl", r"(?:the|gnu) gpl(?: licen[cs]e)?"),
    ("lgpl-2.0", "general public licen", r"gnu library general public licen[cs]e(?: (?:version |v )?2(?: 0)?)?"),
    ("lgpl-2.1", "general public licen", r"gnu lesser general public licen[cs]e (?:version |v )?2 1"),
    ("lgpl-3.0", "general public licen", r"gnu lesser general public licen[cs]e (?:version |v )?(?:3|v3)(?: 0)?"),
    ("lgpl", "general public licen", r"(?:gnu )?lesser general public licen[cs]e"),
    ("lgpl-short", "lgpl", r"(?:gnu )?lgpl(?:v2|v3| (?:version |v )?(?:2|2 1|3|3 0))?(?: licen[cs]e)?"),
    ("agpl-3.0", "general public licen", r"(?:gnu )?affero general public licen[cs]e(?: (?:version |v )?(?:3|v3)(?: 0)?)?"),
    ("agpl-short", "agpl", r"(?:gnu )?agpl(?:v3| (?:version |v )?3(?: 0)?)?(?: licen[cs]e)?"),
    ("gfdl", "free documentation licen", r"gnu free documentation licen[cs]e(?: (?:version |v )?1 [123])?"),
    ("mpl-1.1", "mozilla public licen", r"mozilla public licen[cs]e (?:version |v )?1 [01]"),
    ("mpl-2.0", "mozilla public licen", r"mozilla public licen[cs]e (?:version |v )?2(?: 0)?"),
    ("mpl", "mozilla public licen", r"mozilla public licen[cs]e"),
    ("epl-1.0", "eclipse public licen", r"eclipse public licen[cs]e (?:version |v )?1(?: 0)?"),
    ("epl-2.0", "eclipse public licen", r"eclipse public licen[cs]e (?:version |v )?2(?: 0)?"),
    ("epl", "eclipse public licen", r"eclipse public licen[cs]e"),
    ("edl-1.0", "eclipse distribution licen", r"eclipse distribution licen[cs]e(?: (?:version |v )?1(?: 0)?)?"),
    ("cddl-1.0", "common development and distribution licen", r"common development and distribution licen[cs]e(?: (?:version |v )?1 [01])?"),
    ("cpl-1.0", "common public licen", r"common public licen[cs]e(?: (?:version |v )?1(?: 0)?)?"),
    ("artistic-1.0", "artistic licen", r"(?:perl )?artistic licen[cs]e (?:version |v )?1(?: 0)?"),
    ("artistic-2.0", "artistic licen", r"artistic licen[cs]e (?:version |v )?2(?: 0)?"),
    ("artistic", "artistic licen", r"(?:perl )?artistic licen[cs]e"),
    ("bsl-1.0", "boost software licen", r"boost software licen[cs]e(?: (?:version |v )?1(?: 0)?)?"),
    ("busl-1.1", "business source licen", r"business source licen[cs]e(?: (?:version |v )?1 [01])?"),
    ("zlib", "zlib", r"zlib(?: libpng)? licen[cs]e"),
    ("libpng", "libpng licen", r"libpng licen[cs]e(?: (?:version |v )?2)?"),
    ("unlicense", "unlicen", r"unlicen[cs]e"),
    ("wtfpl", "public licen", r"do what the f[a-z0-9]{0,8} you want to public licen[cs]e"),
    ("python-2.0", "python software foundation licen", r"python software foundation licen[cs]e(?: (?:version |v )?2(?: 0)?)?"),
    ("php-3.01", "php licen", r"php licen[cs]e(?: (?:version |v )?3 0?1)?"),
    ("ruby", "ruby licen", r"ruby licen[cs]e"),
    ("openssl", "openssl licen", r"openssl licen[cs]e"),
    ("postgresql", "postgresql licen", r"postgresql licen[cs]e"),
    ("ofl-1.1", "open font licen", r"(?:sil )?open font licen[cs]e(?: (?:version |v )?1 1)?"),
    ("eupl-1.2", "european union public licen", r"european union public licen[cs]e(?: (?:version |v )?1 [012])?"),
    ("ms-pl", "microsoft public licen", r"microsoft public licen[cs]e"),
    ("ms-rl", "microsoft reciprocal licen", r"microsoft reciprocal licen[cs]e"),
    ("osl-3.0", "open software licen", r"open software licen[cs]e(?: (?:version |v )?[123] [01])?"),
    ("afl-3.0", "academic free licen", r"academic free licen[cs]e(?: (?:version |v )?[123] [01])?"),
    ("ecl-2.0", "educational community licen", r"educational community licen[cs]e(?: (?:version |v )?[12](?: 0)?)?"),
    ("ncsa", "open source licen", r"(?:university of illinois )?ncsa open source licen[cs]e"),
    ("upl-1.0", "universal permissive licen", r"universal permissive licen[cs]e(?: (?:version |v )?1(?: 0)?)?"),
    ("mulanpsl-2.0", "mulan", r"mulan (?:permissive software|psl) licen[cs]e(?: (?:version |v )?[12](?: 0)?)?"),
    ("sspl-1.0", "server side public licen", r"server side public licen[cs]e(?: (?:version |v )?1)?"),
    ("elastic-2.0", "elastic licen", r"elastic licen[cs]e(?: (?:version |v )?2(?: 0)?)?"),
    ("odbl-1.0", "open database licen", r"open database licen[cs]e(?: (?:version |v )?1(?: 0)?)?"),
    ("odc-by-1.0", "open data commons attribution licen", r"open data commons attribution licen[cs]e(?: (?:version |v )?1(?: 0)?)?"),
    ("pddl-1.0", "public domain dedication and licen", r"public domain dedication and licen[cs]e(?: (?:version |v )?1(?: 0)?)?"),
    ("ogl-3.0", "open government licen", r"open government licen[cs]e(?: (?:version |v )?[123](?: 0)?)?"),
    ("cc0-1.0", "cc0", r"(?:creative commons )?cc0(?: 1 0)?(?: universal)?"),
    ("cc-by-1", "cc by", r"(?:creative commons )?cc by [123](?: [05])?"),
    ("cc-by-4.0", "cc by", r"(?:creative commons )?cc by 4(?: 0)?(?: international)?"),
    ("cc-by-sa", "cc by sa", r"(?:creative commons )?cc by sa(?: [1234](?: [05])?)?(?: international)?"),
    ("cc-by-nd", "cc by nd", r"(?:creative commons )?cc by nd(?: [1234](?: [05])?)?(?: international)?"),
    ("cc-by-nc-sa", "cc by nc sa", r"(?:creative commons )?cc by nc sa(?: [1234](?: [05])?)?(?: international)?"),
    ("cc-by-nc-nd", "cc by nc nd", r"(?:creative commons )?cc by nc nd(?: [1234](?: [05])?)?(?: international)?"),
    ("cc-by-nc-4.0", "cc by nc", r"(?:creative commons )?cc by nc 4(?: 0)?(?: international)?"),
    ("cc-by-nc", "cc by nc", r"(?:creative commons )?cc by nc"),
    ("cc-by", "cc by", r"(?:creative commons )?cc by"),
    ("cc-by-sa-long", "attribution share", r"creative commons attribution share ?alike(?: [1234] [05])?(?: international| unported)?(?: licen[cs]e)?"),
    ("cc-by-nd-long", "attribution no", r"creative commons attribution no ?deriv(?:ative)?s?(?: [1234] [05])?(?: international| unported)?(?: licen[cs]e)?"),
    ("cc-by-nc-long", "attribution non", r"creative commons attribution non ?commercial(?: [1234] [05])?(?: international| unported)?(?: licen[cs]e)?"),
    ("cc-by-nc-sa-long", "attribution non", r"creative commons attribution non ?commercial share ?alike(?: [1234] [05])?(?: international| unported)?(?: licen[cs]e)?"),
    ("cc-by-nc-nd-long", "attribution non", r"creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: [1234] [05])?(?: international| unported)?(?: licen[cs]e)?"),
    ("cc-by-long", "commons attribution", r"creative commons attribution(?: [1234] [05])?(?: international| unported)?(?: licen[cs]e)?"),
    ("creative-commons", "creative commons licen", r"creative commons licen[cs]e"),
)

# (label, keyword, pattern): passages that stand in the texts of licenses.
PASSAGES = (
    ("mit", "hereby granted free of charge", r"permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mit", "substantial portions of the software", r"(?:copyright notice and )?this permission notice shall be included in all copies or substantial portions of the software"),
    ("isc", "with or without fee is hereby granted", r"permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee is hereby granted"),
    ("bsd", "redistribution and use in source and binary forms", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", "redistributions of source code must retain", r"redistributions of source code must retain the above copyright notice"),
    ("bsd", "redistributions in binary form must reproduce", r"redistributions in binary form must reproduce the above copyright notice"),
    ("bsd-3-clause", "without specific prior written permission", r"(?:may|must not|may not) be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsd-4-clause", "all advertising materials mentioning", r"all advertising materials mentioning features or use of this software must display"),
    ("apache-2.0", "you may not use this file except in compliance", r"you may not use this file except in compliance with the licen[cs]e"),
    ("apache-2.0", "apache org licen", r"www apache org licen[cs]es licen[cs]e 2 0"),
    ("gpl", "redistribute it and or modify it under the terms", r"(?:you can )?redistribute it and or modify it under the terms of the gnu general public licen[cs]e"),
    ("lgpl", "redistribute it and or modify it under the terms", r"(?:you can )?redistribute it and or modify it under the terms of the gnu lesser general public licen[cs]e"),
    ("agpl-3.0", "redistribute it and or modify it under the terms", r"(?:you can )?redistribute it and or modify it under the terms of the gnu affero general public licen[cs]e"),
    ("gpl-or-later", "or at your option any later version", r"either version [123](?: 0)? of the licen[cs]e or at your option any later version"),
    ("gpl", "you should have received a copy of the gnu", r"you should have received a copy of the gnu (?:lesser |affero )?general public licen[cs]e"),
    ("mpl-2.0", "source code form is subject to the terms", r"this source code form is subject to the terms of the mozilla public licen[cs]e(?: v 2 0)?"),
    ("epl-2.0", "eclipse org legal", r"www eclipse org legal epl (?:v )?2 0"),
    ("cc0-1.0", "waived all copyright", r"waived all copyright and related or neighboring rights"),
    ("cc-by-4.0", "creativecommons org licenses by 4 0", r"creativecommons org licenses by 4 0"),
    ("cc-by-sa", "creativecommons org licenses by sa", r"creativecommons org licenses by sa [1234] [05]"),
    ("cc-by-nc", "creativecommons org licenses by nc", r"creativecommons org licenses by nc [1234] [05]"),
    ("cc-by-nd", "creativecommons org licenses by nd", r"creativecommons org licenses by nd [1234] [05]"),
    ("cc-by-nc-sa", "creativecommons org licenses by nc sa", r"creativecommons org licenses by nc sa [1234] [05]"),
    ("cc-by-nc-nd", "creativecommons org licenses by nc nd", r"creativecommons org licenses by nc nd [1234] [05]"),
    ("unlicense", "free and unencumbered software", r"this is free and unencumbered software released into the public domain"),
    ("zlib", "altered source versions must be plainly marked", r"altered source versions must be plainly marked as such and must not be misrepresented as being the original software(?: licen[cs]e)?"),
    ("bsl-1.0", "machine executable object code", r"machine executable object code generated by a source language processor"),
    ("ofl-1.1", "reserved font name", r"no modified version of the font software may use the reserved font names?"),
)

# (label, keyword, pattern, weight): hints that name no license.
HINTS = (
    ("all-rights-reserved", "all rights", r"all rights (?:are )?reserved", 0.6),
    ("some-rights-reserved", "rights reserved", r"some rights reserved", 0.5),
    ("copyright", "copyright", r"copyright (?:c )?(?:19|20)[0-9]{2}", 0.4),
    ("copyright", "copyright", r"(?:protected by|owner of the|infringe(?:s|ment of)?(?: the)?) copyright", 0.3),
    ("public-domain", "public domain", r"(?:in|into|to|part of) the public domain", 0.5),
    ("public-domain", "public domain", r"public domain (?:work|dedication|mark)", 0.5),
    ("proprietary", "proprietary", r"proprietary (?:and|or) confidential", 0.6),
    ("proprietary", "confidential", r"confidential (?:and|or) proprietary", 0.6),
    ("proprietary", "proprietary", r"proprietary (?:licen[cs]e|software)", 0.5),
    ("no-warranty", "warrant", r"without warrant(?:y|ies) of any kind", 0.4),
    ("no-warranty", "warrant", r"without (?:even the implied |any )?warrant(?:y|ies)", 0.3),
    ("copyleft", "copyleft", r"copyleft licen[cs]e", 0.4),
    ("open-source", "open source", r"open source licen[cs]e", 0.3),
    ("license-reference", "licen", r"(?:licen[cs]ed|released|distributed) under (?:the )?(?:terms of )?(?:this|the|an?|our) licen[cs]e", 0.3),
    ("license-agreement", "licen", r"(?:end user |software )?licen[cs]e agreement", 0.3),
)

_GRANT = r"(?:licen[cs]ed|released|distributed|published|available|provided|issued|subject|governed) (?:under|to|by) (?:the )?(?:terms (?:and conditions )?of (?:the )?)?"


def _identifier(label: str) -> str:
    return r"spdx licen[cs]e identifier " + re.sub("[-.]", " ", label) + r"(?: only| or later)?"


def _named() -> list[Rule]:
    out = []
    for name, keyword, pattern in NAMES:
        label = re.sub("-(short|long)$", "", name)
        if label == name:
            out.append(Rule(label, "spdx", _identifier(label), 3, 1.0))
        out.append(Rule(label, keyword, f"{_GRANT}(?:{pattern})", 2, 0.9))
        out.append(Rule(label, keyword, f"(?:{pattern})", 1, 0.7))
    return out


RULES: tuple[Rule, ...] = (
    *(Rule(label, keyword, pattern, 3, 1.0) for label, keyword, pattern in PASSAGES),
    *_named(),
    *(Rule(label, keyword, pattern, 0, weight) for label, keyword, pattern, weight in HINTS),
)
