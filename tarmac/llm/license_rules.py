"""Signature rules of licences, in order of priority.

A signature is a regular expression over normalised words (lower case, single blanks, no
punctuation), so "Version 2.0" reads ``version 2 0``. Each rule is gated by a keyword that every
match contains; every keyword has a word that begins with one of ``GATES`` or is one of ``WHOLE_GATES``.
"""

from __future__ import annotations

from dataclasses import dataclass

# Names, versions and addresses that licences and their notices use.

#: label | keyword | signature. Whole notices and grants: the most telling, so they come first.
NOTICES = """
mit | permission is hereby granted free of charge | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
isc | permission to use copy modify and | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
bsd-3-clause | redistribution and use in source and binary forms | redistribution and use in source and binary forms (?:[^ ]+ ){1,140}?neither the name of
bsd-2-clause | redistribution and use in source and binary forms | redistribution and use in source and binary forms with or without modification are permitted
zlib | provided as is without any express or implied warranty | this software is provided as is without any express or implied warranty in no event will the authors be held liable
unlicense | free and unencumbered software | this is free and unencumbered software released into the public domain
boost-1.0 | boost software license | boost software license version 1 0(?: august 17th 2003)?
wtfpl | do what the fuck you want to | do what the fuck you want to public license
apache-2.0 | licensed under the apache license | licensed under the apache license version 2 0 the license
mpl-2.0 | mozilla public license | this source code form is subject to the terms of the mozilla public license v 2 0
gpl-3.0-or-later | general public license | general public license as published by the free software foundation either version 3 of the license or at your option any later version
gpl-2.0-or-later | general public license | general public license as published by the free software foundation either version 2 of the license or at your option any later version
lgpl-2.1-or-later | lesser general public license | lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version
lgpl-3.0-or-later | lesser general public license | lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version
agpl-3.0-or-later | affero general public license | affero general public license as published by the free software foundation either version 3 of the license or at your option any later version
gfdl | free documentation license | under the terms of the gnu free documentation license(?: version 1 [123])?
epl-2.0 | eclipse public license | made available under the terms of the eclipse public license (?:v )?2 0
epl-1.0 | eclipse public license | made available under the terms of the eclipse public license (?:v )?1 0
artistic-2.0 | artistic license | under the terms of the artistic license (?:version )?2 0
ofl-1.1 | sil open font license | licensed under the sil open font license version 1 1
proprietary | strictly prohibited | unauthorized (?:copying|use|reproduction)(?: or [^ ]+){0,4} (?:[^ ]+ ){0,12}is strictly prohibited
proprietary | confidential and proprietary | (?:this [^ ]+ is )?confidential and proprietary
no-reuse | be reproduced | no part of this (?:[^ ]+ ){1,3}may (?:not )?be reproduced
no-reuse | without prior written permission | (?:reproduced|redistributed|republished) (?:[^ ]+ ){0,12}without prior written permission
"""

#: label | keyword | name. A name, with or without its version, as running text gives it.
NAMES = """
apache-2.0 | apache license | apache license (?:version )?2 0
apache-1.1 | apache software license | apache software license (?:version )?1 1
apache | apache license | apache license
mit | mit license | (?:the )?mit license
mit-0 | mit no attribution | mit no attribution
bsd-4-clause | bsd | (?:4 clause|four clause|original) bsd license
bsd-3-clause | bsd | (?:3 clause|three clause|new|modified|revised) bsd license
bsd-2-clause | bsd | (?:2 clause|two clause|simplified|freebsd) bsd license
bsd | bsd | bsd (?:style )?license
isc | isc license | isc license
zlib | zlib | zlib(?: libpng)? license
gpl-3.0 | general public license | (?:gnu )?general public license (?:version |v )?3(?: 0)?
gpl-2.0 | general public license | (?:gnu )?general public license (?:version |v )?2(?: 0)?
gpl-1.0 | general public license | (?:gnu )?general public license (?:version |v )?1(?: 0)?
lgpl-3.0 | lesser general public license | (?:gnu )?lesser general public license (?:version |v )?3(?: 0)?
lgpl-2.1 | lesser general public license | (?:gnu )?lesser general public license (?:version |v )?2 1
lgpl-2.0 | library general public license | (?:gnu )?library general public license (?:version |v )?2(?: 0)?
lgpl | lesser general public license | (?:gnu )?lesser general public license
agpl-3.0 | affero general public license | (?:gnu )?affero general public license (?:version |v )?3(?: 0)?
agpl | affero general public license | (?:gnu )?affero general public license
gpl | gnu general public license | gnu general public license
gpl-3.0 | gplv3 | gplv3
gpl-2.0 | gplv2 | gplv2
lgpl-3.0 | lgplv3 | lgplv3
agpl-3.0 | agplv3 | agplv3
gpl | gnu gpl | gnu gpl
gfdl | free documentation license | (?:gnu )?free documentation license
mpl-2.0 | mozilla public license | mozilla public license (?:version |v )?2 0
mpl-1.1 | mozilla public license | mozilla public license (?:version |v )?1 1
mpl | mozilla public license | mozilla public license
epl-2.0 | eclipse public license | eclipse public license (?:version |v )?2 0
epl-1.0 | eclipse public license | eclipse public license (?:version |v )?1 0
epl | eclipse public license | eclipse public license
cddl-1.1 | common development and distribution license | common development and distribution license (?:version )?1 1
cddl-1.0 | common development and distribution license | common development and distribution license
cpl-1.0 | common public license | common public license
eupl-1.2 | european union public licen | european union public licen[cs]e (?:version |v )?1 2
eupl | european union public licen | european union public licen[cs]e
artistic-2.0 | artistic license | artistic license 2 0
artistic-1.0 | artistic license | artistic license
boost-1.0 | boost software license | boost software license
ms-pl | microsoft public license | microsoft public license
ms-rl | microsoft reciprocal license | microsoft reciprocal license
ofl-1.1 | open font license | (?:sil )?open font license
odbl | open database license | open database license
odc-by | open data commons attribution license | open data commons attribution license
pddl | public domain dedication and license | public domain dedication and license
ogl-uk | open government licence | open government licence(?: v ?[123](?: 0)?)?
postgresql | postgresql license | postgresql license
python-2.0 | python software foundation license | python software foundation license
php-3.01 | php license | php license(?: (?:version )?3 01)?
ruby | ruby license | ruby license
vim | vim license | vim license
openssl | openssl license | openssl license
sspl-1.0 | server side public license | server side public license
bsl-1.1 | business source license | business source license(?: 1 1)?
elastic-2.0 | elastic license | elastic license(?: 2 0)?
upl-1.0 | universal permissive license | universal permissive license
osl-3.0 | open software license | open software license(?: (?:version )?3 0)?
afl-3.0 | academic free license | academic free license(?: (?:version )?3 0)?
ncsa | ncsa open source license | (?:university of illinois )?ncsa open source license
cecill | cecill | cecill(?: [bc])?(?: free software)? license
bsd-0-clause | zero clause bsd | (?:bsd )?zero clause bsd(?: license)?
cc-by-nc-nd | attribution noncommercial noderivatives | creative commons attribution noncommercial noderivatives(?: [1-4] [05])?
cc-by-nc-nd | attribution noncommercial noderivs | creative commons attribution noncommercial noderivs(?: [1-4] [05])?
cc-by-nc-sa | attribution noncommercial sharealike | creative commons attribution noncommercial sharealike(?: [1-4] [05])?
cc-by-nc-sa | attribution non commercial share alike | creative commons attribution non commercial share alike(?: [1-4] [05])?
cc-by-nc | attribution noncommercial | creative commons attribution noncommercial(?: [1-4] [05])?
cc-by-nc | attribution non commercial | creative commons attribution non commercial(?: [1-4] [05])?
cc-by-nd | attribution noderivatives | creative commons attribution noderivatives(?: [1-4] [05])?
cc-by-nd | attribution noderivs | creative commons attribution noderivs(?: [1-4] [05])?
cc-by-sa | attribution sharealike | creative commons attribution sharealike(?: [1-4] [05])?
cc-by-sa | attribution share alike | creative commons attribution share alike(?: [1-4] [05])?
cc-by | creative commons attribution | creative commons attribution(?: [1-4] [05])?
cc0 | creative commons zero | creative commons zero(?: 1 0)?
cc0 | cc0 | cc0(?: 1 0)?(?: universal)?
cc | creative commons | creative commons(?: licen[cs]e)?
public-domain | public domain | (?:released into|dedicated to|in) the public domain
"""

#: Creative Commons short names: elements after "cc by", tried with each version and without.
CC_ELEMENTS = "nc-nd nc-sa nc nd sa"
CC_VERSIONS = "4.0 3.0 2.5 2.0 1.0"

#: Identifiers of the public SPDX list that machine-readable notices name.
SPDX = """
0BSD AFL-2.1 AFL-3.0 AGPL-3.0-only AGPL-3.0-or-later Apache-1.0 Apache-1.1 Apache-2.0 APSL-2.0
Artistic-1.0 Artistic-2.0 BlueOak-1.0.0 BSD-1-Clause BSD-2-Clause BSD-2-Clause-Patent BSD-3-Clause
BSD-3-Clause-Clear BSD-4-Clause BSL-1.0 BUSL-1.1 CAL-1.0 CC-BY-1.0 CC-BY-2.0 CC-BY-2.5 CC-BY-3.0
CC-BY-4.0 CC-BY-NC-2.0 CC-BY-NC-3.0 CC-BY-NC-4.0 CC-BY-NC-ND-3.0 CC-BY-NC-ND-4.0 CC-BY-NC-SA-3.0
CC-BY-NC-SA-4.0 CC-BY-ND-3.0 CC-BY-ND-4.0 CC-BY-SA-2.0 CC-BY-SA-2.5 CC-BY-SA-3.0 CC-BY-SA-4.0
CC0-1.0 CDDL-1.0 CDDL-1.1 CECILL-2.1 CECILL-B CECILL-C ClArtistic CPAL-1.0 CPL-1.0 ECL-2.0 EFL-2.0
Elastic-2.0 EPL-1.0 EPL-2.0 EUDatagrid EUPL-1.1 EUPL-1.2 FTL GFDL-1.2-only GFDL-1.2-or-later
GFDL-1.3-only GFDL-1.3-or-later GPL-1.0-only GPL-1.0-or-later GPL-2.0-only GPL-2.0-or-later
GPL-3.0-only GPL-3.0-or-later HPND IJG Imlib2 Intel IPA IPL-1.0 ISC JSON LGPL-2.0-only
LGPL-2.0-or-later LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0-only LGPL-3.0-or-later LPL-1.02
LPPL-1.3c MirOS MIT MIT-0 MPL-1.0 MPL-1.1 MPL-2.0 MS-PL MS-RL MulanPSL-2.0 NCSA NPL-1.1 ODbL-1.0
ODC-By-1.0 OFL-1.1 OLDAP-2.8 OpenSSL OSL-2.1 OSL-3.0 PDDL-1.0 PHP-3.01 PostgreSQL PSF-2.0
Python-2.0 QPL-1.0 Ruby SGI-B-2.0 SISSL Sleepycat SMLNJ SPL-1.0 SSPL-1.0 TCL Unicode-DFS-2016
Unlicense UPL-1.0 Vim W3C Watcom-1.0 WTFPL X11 Xnet Zend-2.0 Zlib ZPL-2.1
"""

#: label | address of the text, as its words.
ADDRESSES = """
apache-2.0 | apache org licenses license 2 0
mit | opensource org licenses mit
mit | opensource org license mit
bsd-3-clause | opensource org licenses bsd 3 clause
bsd-2-clause | opensource org licenses bsd 2 clause
isc | opensource org licenses isc
gpl-3.0 | gnu org licenses gpl 3 0
gpl-2.0 | gnu org licenses old licenses gpl 2 0
lgpl-3.0 | gnu org licenses lgpl 3 0
lgpl-2.1 | gnu org licenses old licenses lgpl 2 1
agpl-3.0 | gnu org licenses agpl 3 0
gfdl | gnu org licenses fdl 1 3
gpl | gnu org licenses
mpl-2.0 | mozilla org mpl 2 0
mpl-1.1 | mozilla org mpl mpl 1 1
epl-2.0 | eclipse org legal epl 2 0
boost-1.0 | boost org license 1 0
unlicense | unlicense org
wtfpl | wtfpl net
cc0 | creativecommons org publicdomain zero
public-domain | creativecommons org publicdomain mark
odbl | opendatacommons org licenses odbl
ofl-1.1 | scripts sil org ofl
"""

#: The phrases that every scan must find, whatever other rules say.
BASE = """
cc-by | cc by
gpl | general public license
reserved | all rights reserved
"""

#: label | keyword | signature. Weak hints, which any rule above suppresses where it covers them.
HINTS = """
copyright | copyright | copyright(?: c)?(?: (?:19|20)[0-9]{2}(?: (?:19|20)?[0-9]{2})?)?
copyleft | copyleft | copyleft
licensed | licensed under | (?:is |are )?licensed under(?: the)?(?: terms of)?
licensed | released under | (?:is |are )?released under(?: the)?(?: terms of)?
licensed | distributed under | (?:is |are )?distributed under(?: the)?(?: terms of)?
license-file | license | (?:see|refer to) the (?:file )?license(?: txt| md)?(?: file)?
license-file | the copying | (?:see|refer to) the copying(?: txt| md)?(?: file)?
license-file | file copying | (?:see|refer to) the file copying(?: txt| md)?(?: file)?
reserved-some | some rights reserved | some rights reserved
reserved-none | no rights reserved | no rights reserved
trademark | registered trademark | (?:is a|are) registered trademarks? of
terms | terms of use | (?:subject to|see) (?:the |our )?terms of use
warranty | without warranty | (?:provided |distributed )?(?:as is )?without warranty of any kind
"""

GATES = tuple(
    "licen unlicen copyr copyl copying released distributed reserved permission redistribution spdx gpl lgpl agpl gnu cc0 "
    "creative bsd zlib cecill unencumbered proprietary prohibited reproduced fuck domain "
    "trademark terms warranty wtfpl opendatacommons mozilla eclipse scripts attribution".split()
)
#: Gate words that must be whole, as many words begin like them.
WHOLE_GATES = ("cc",)


@dataclass(frozen=True)
class Rule:
    id: int
    label: str
    priority: int
    confidence: float
    keyword: str
    signature: str
    base: bool = False


def _lines(table: str) -> list[list[str]]:
    return [[c.strip() for c in line.split(" | ")] for line in table.strip().splitlines()]


def _words(identifier: str) -> str:
    return " ".join(identifier.lower().replace(".", " ").replace("-", " ").split())


def _parts() -> list[tuple[str, int, float, str, str, bool]]:
    """(label, priority, confidence, keyword, signature, base); a smaller priority prevails."""
    parts = [(label, 1, 0.98, key, sig, False) for label, key, sig in _lines(NOTICES)]
    for identifier in SPDX.split():
        words = _words(identifier)
        label = identifier.lower()
        parts.append(
            (label, 0, 0.99, f"spdx license identifier {words}", f"spdx license identifier {words}", False)
        )
        parts.append(
            (label, 3, 0.9, f"license {words}", f"license {words}", False)
        )
    for element in CC_ELEMENTS.split():
        label = f"cc-by-{element}"
        for version in CC_VERSIONS.split():
            words = f"cc by {_words(element)} {_words(version)}"
            parts.append((f"{label}-{version}", 2, 0.95, words, words, False))
        parts.append((label, 3, 0.9, f"cc by {_words(element)}", f"cc by {_words(element)}", False))
    for version in CC_VERSIONS.split():
        words = f"cc by {_words(version)}"
        parts.append((f"cc-by-{version}", 2, 0.95, words, words, False))
    parts += [(label, 2, 0.95, address, f"(?:https? )?(?:www )?{address}", False) for label, address in _lines(ADDRESSES)]
    parts += [(label, 3, 0.9, key, sig, False) for label, key, sig in _lines(NAMES)]
    parts += [(label, 4, 0.7, words, words, True) for label, words in _lines(BASE)]
    parts += [(label, 5, 0.2, key, sig.strip(), False) for label, key, sig in _lines(HINTS)]
    return parts


RULES: tuple[Rule, ...] = tuple(Rule(i, *part) for i, part in enumerate(_parts()))
