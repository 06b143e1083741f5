"""Signature rules for licence texts, written by hand.

A line reads ``label | keyword | pattern``. Patterns run over the text with A-Z in lower
case; a blank stands for any white space, an optional blank for optional white space. A rule is tried only where all words of its
keyword occur. Rules of an earlier block have
priority over those of a later one; inside a block the earlier line has.
"""

from __future__ import annotations

import re
from typing import NamedTuple


class Signature(NamedTuple):
    label: str
    keyword: str
    regex: str
    priority: int
    order: int


# Identifiers of the public SPDX licence list that a file header may carry.
TAGGED = """
0bsd aal afl-2.1 afl-3.0 agpl-1.0 agpl-3.0 agpl-3.0-only agpl-3.0-or-later apache-1.0 apache-1.1 apache-2.0
apsl-2.0 artistic-1.0 artistic-2.0 bsd-1-clause bsd-2-clause bsd-2-clause-patent bsd-3-clause
bsd-3-clause-clear bsd-4-clause bsl-1.0 busl-1.1 cc-by-1.0 cc-by-2.0 cc-by-2.5 cc-by-3.0 cc-by-4.0
cc-by-nc-3.0 cc-by-nc-4.0 cc-by-nc-nd-4.0 cc-by-nc-sa-3.0 cc-by-nc-sa-4.0 cc-by-nd-3.0 cc-by-nd-4.0
cc-by-sa-2.0 cc-by-sa-3.0 cc-by-sa-4.0 cc0-1.0 cddl-1.0 cddl-1.1 cecill-2.1 cecill-b cecill-c cpl-1.0
curl ecl-2.0 efl-2.0 epl-1.0 epl-2.0 eupl-1.1 eupl-1.2 ftl gfdl-1.2 gfdl-1.3 gpl-1.0 gpl-2.0 gpl-2.0-only
gpl-2.0-or-later gpl-3.0 gpl-3.0-only gpl-3.0-or-later hpnd icu ijg ipl-1.0 isc lgpl-2.0 lgpl-2.1
lgpl-2.1-only lgpl-2.1-or-later lgpl-3.0 lgpl-3.0-only lgpl-3.0-or-later lppl-1.3c mit mit-0 mpl-1.1
mpl-2.0 ms-pl ms-rl mulanpsl-2.0 ncsa odbl-1.0 ofl-1.1 openssl osl-3.0 pddl-1.0 php-3.01 postgresql psf-2.0
python-2.0 qpl-1.0 ruby sleepycat sspl-1.0 tcl unicode-3.0 unlicense upl-1.0 vim w3c wtfpl x11 zlib zpl-2.1
""".split()

ADDRESSES = r"""
agpl-3.0 | licenses/agpl | gnu\.org/licenses/agpl(-3\.0)?
lgpl-3.0 | licenses/lgpl | gnu\.org/licenses/lgpl-3\.0
lgpl-2.1 | licenses/ | gnu\.org/licenses/(old-licenses/)?lgpl-2\.1
gpl-3.0 | licenses/gpl | gnu\.org/licenses/gpl-3\.0
gpl-2.0 | licenses/ | gnu\.org/licenses/(old-licenses/)?gpl-2\.0
gpl | licenses/gpl | gnu\.org/licenses/gpl(\.html)?
gfdl | licenses/fdl | gnu\.org/licenses/fdl(-1\.[0-9])?
gpl | gnu.org/licenses | gnu\.org/licenses/
apache-2.0 | license-2.0 | apache\.org/licenses/license-2\.0
apache-1.1 | license-1.1 | apache\.org/licenses/license-1\.1
apache | apache.org/licenses | apache\.org/licenses/
mit | opensource.org/licenses/mit | opensource\.org/licenses/mit
bsd-2-clause | licenses/bsd-2 | opensource\.org/licenses/bsd-2-clause
bsd-3-clause | licenses/bsd-3 | opensource\.org/licenses/bsd-3-clause
isc | licenses/isc | opensource\.org/licenses/isc
mpl-2.0 | mozilla.org/ | mozilla\.org/(en-us/)?mpl/2\.0
mpl-1.1 | mozilla.org/ | mozilla\.org/(en-us/)?mpl/1\.1
mpl | mozilla.org/mpl | mozilla\.org/mpl
epl-2.0 | epl-2.0 | eclipse\.org/legal/epl-2\.0
epl-1.0 | epl-v10 | eclipse\.org/legal/epl-v10
cc0-1.0 | publicdomain/zero | creativecommons\.org/publicdomain/zero/1\.0
cc-pdm-1.0 | publicdomain/mark | creativecommons\.org/publicdomain/mark/1\.0
cc-by-4.0 | licenses/by/ | creativecommons\.org/licenses/by/4\.0
cc-by-3.0 | licenses/by/ | creativecommons\.org/licenses/by/3\.0
cc-by-2.5 | licenses/by/ | creativecommons\.org/licenses/by/2\.5
cc-by-2.0 | licenses/by/ | creativecommons\.org/licenses/by/2\.0
cc-by-sa-4.0 | licenses/by-sa/ | creativecommons\.org/licenses/by-sa/4\.0
cc-by-sa-3.0 | licenses/by-sa/ | creativecommons\.org/licenses/by-sa/3\.0
cc-by-sa-2.0 | licenses/by-sa/ | creativecommons\.org/licenses/by-sa/2\.[05]
cc-by-nc-4.0 | licenses/by-nc/ | creativecommons\.org/licenses/by-nc/4\.0
cc-by-nc-3.0 | licenses/by-nc/ | creativecommons\.org/licenses/by-nc/3\.0
cc-by-nc-sa-4.0 | licenses/by-nc-sa/ | creativecommons\.org/licenses/by-nc-sa/4\.0
cc-by-nc-sa-3.0 | licenses/by-nc-sa/ | creativecommons\.org/licenses/by-nc-sa/3\.0
cc-by-nc-nd-4.0 | licenses/by-nc-nd/ | creativecommons\.org/licenses/by-nc-nd/4\.0
cc-by-nc-nd-3.0 | licenses/by-nc-nd/ | creativecommons\.org/licenses/by-nc-nd/3\.0
cc-by-nd-4.0 | licenses/by-nd/ | creativecommons\.org/licenses/by-nd/4\.0
bsl-1.0 | license_1_0.txt | boost\.org/license_1_0\.txt
unlicense | unlicense.org | unlicense\.org
ofl-1.1 | sil.org/ofl | (scripts\.)?sil\.org/ofl
wtfpl | wtfpl.net | wtfpl\.net
zlib | zlib_license | zlib\.net/zlib_license
eupl-1.2 | eupl | joinup\.ec\.europa\.eu/[a-z/-]{0,40}eupl
odbl-1.0 | licenses/odbl | opendatacommons\.org/licenses/odbl
pddl-1.0 | licenses/pddl | opendatacommons\.org/licenses/pddl
php-3.01 | php.net/license | php\.net/license/3_01
"""

NOTICES = r"""
gpl-3.0-or-later | free software foundation | gnu general public license as published by the free software foundation[,;]? either version 3 of the license,? or \(at your option\) any later version
gpl-2.0-or-later | free software foundation | gnu general public license as published by the free software foundation[,;]? either version 2 of the license,? or \(at your option\) any later version
gpl-2.0-only | free software foundation | gnu general public license version 2 as published by the free software foundation
lgpl-2.1-or-later | free software foundation | gnu lesser general public license as published by the free software foundation[,;]? either version 2\.1 of the license,? or \(at your option\) any later version
lgpl-3.0-or-later | free software foundation | gnu lesser general public license as published by the free software foundation[,;]? either version 3 of the license,? or \(at your option\) any later version
agpl-3.0-or-later | free software foundation | gnu affero general public license as published by the free software foundation[,;]? either version 3 of the license,? or \(at your option\) any later version
gfdl-1.3 | free documentation | permission is granted to copy, distribute and/or modify this document under the terms of the gnu free documentation license,? version 1\.3
gfdl | free documentation | under the terms of the gnu free documentation license
apache-2.0 | apache license | licensed under the apache license,? version 2(\.0)?( \(the "license"\))?
apache-2.0 | apache license | licensed under the apache 2(\.0)? license
mit | permission is hereby granted | permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files
mit-0 | permission is hereby granted | permission is hereby granted, free of charge, to any person obtaining a copy of this software to deal in the software without restriction
mit | mit license | (released|licensed|distributed|available|published) under the (terms of the )?mit license
mit | mit-style | (governed|licensed) by an? mit-style license
x11 | x consortium | except as contained in this notice, the name of the x consortium shall not be used in advertising
isc | permission to use | permission to use, copy, modify, and(/or)? distribute this software for any purpose with or without fee is hereby granted, provided that
0bsd | permission to use | permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted\.
hpnd | permission to use | permission to use, copy, modify,? and distribute this software and its documentation for any purpose
bsd-4-clause | advertising materials | all advertising materials mentioning features or use of this software must display the following acknowledge?ment
bsd-3-clause | endorse or promote | neither the names? of [^.]{1,120} may be used to endorse or promote products derived from this software
bsd | redistribution and use | redistribution and use in source and binary forms, with or without modification, are permitted provided that
bsd | bsd | use of this source code is governed by a bsd-style license
zlib | altered source | altered source versions must be plainly marked as such, and must not be misrepresented as being the original software
bsl-1.0 | boost software | distributed under the boost software license,? version 1\.0
bsl-1.0 | permission is hereby granted | permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software
mpl-2.0 | mozilla public | this source code form is subject to the terms of the mozilla public license,? v(ersion|\.)? ?2\.0
mpl-1.1 | mozilla public | the contents of this file are subject to the mozilla public license version 1\.1
epl-2.0 | eclipse public | terms of the eclipse public license v(ersion|\.)? ?2\.0
epl-1.0 | eclipse public | terms of the eclipse public license v(ersion|\.)? ?1\.0
cddl-1.0 | common development | subject to the terms of the common development and distribution license
unlicense | unencumbered | this is free and unencumbered software released into the public domain
wtfpl | what the fuck | do what the fuck you want to public license
cc0-1.0 | waived all | waived all copyright and related or neighboring rights
ofl-1.1 | font software | this font software is licensed under the sil open font license,? version 1\.1
artistic-2.0 | artistic | distributed under the (terms of the )?artistic license,? (version )?2\.0
psf-2.0 | python software foundation | python software foundation license version 2
openssl | openssl project | this product includes software developed by the openssl project
curl | curl | copyright \(c\) [0-9 ,-]{4,20} daniel stenberg
ncsa | university of illinois | university of illinois/ncsa open source license
ms-pl | microsoft public | microsoft public license \(ms-pl\)
vim | vim license | distributed under the vim license
postgresql | postgresql | postgresql is released under the postgresql license
beerware | beer | you can buy me a beer in return
gpl | gnu general public | (this work is )?(licensed|released|distributed) under the (terms of the )?gnu general public license
lgpl | gnu lesser general | (licensed|released|distributed) under the (terms of the )?gnu lesser general public license
agpl-3.0 | gnu affero | (licensed|released|distributed) under the (terms of the )?gnu affero general public license
cc-by | creative commons attribution | (licensed|released|available) under an? creative commons attribution license
cc-by-sa | creative commons attribution | (licensed|released|available) under an? creative commons attribution[- ]share-?alike license
cc-by-4.0 | creative commons | (licensed|released|available) under an? creative commons attribution 4\.0 international license
cc-by-sa-4.0 | creative commons | (licensed|released|available) under an? creative commons attribution[- ]share-?alike 4\.0 international license
cc-by-nc-4.0 | creative commons | (licensed|released|available) under an? creative commons attribution[- ]noncommercial 4\.0 international license
public-domain | public domain | (placed|released|dedicated|put) (in|into|to) the public domain
proprietary | all rights reserved | proprietary and confidential[.,;]? all rights reserved
proprietary | unauthorized copying | unauthorized copying of this file,? via any medium,? is strictly prohibited
"""

TITLES = r"""
gpl-3.0 | gnu general public | gnu general public license,? \(?v(ersion|\.)? ?3(\.0)?\)?
gpl-2.0 | gnu general public | gnu general public license,? \(?v(ersion|\.)? ?2(\.0)?\)?
gpl-1.0 | gnu general public | gnu general public license,? \(?v(ersion|\.)? ?1(\.0)?\)?
lgpl-3.0 | gnu lesser general | gnu lesser general public license,? \(?v(ersion|\.)? ?3(\.0)?\)?
lgpl-2.1 | gnu lesser general | gnu lesser general public license,? \(?v(ersion|\.)? ?2\.1\)?
lgpl-2.0 | gnu library general | gnu library general public license,? \(?v(ersion|\.)? ?2(\.0)?\)?
agpl-3.0 | gnu affero | gnu affero general public license,? \(?v(ersion|\.)? ?3(\.0)?\)?
gfdl-1.3 | free documentation | gnu free documentation license,? v(ersion|\.)? ?1\.3
gfdl-1.2 | free documentation | gnu free documentation license,? v(ersion|\.)? ?1\.2
apache-2.0 | apache | apache (software )?license,? \(?(v|ver|version)?\.? ?2(\.0)?\)?
apache-1.1 | apache | apache (software )?license,? \(?(v|ver|version)?\.? ?1\.1\)?
mpl-2.0 | mozilla public | mozilla public license,? \(?(v|version)?\.? ?2(\.0)?\)?
mpl-1.1 | mozilla public | mozilla public license,? \(?(v|version)?\.? ?1\.1\)?
mpl-1.0 | mozilla public | mozilla public license,? \(?(v|version)?\.? ?1\.0\)?
epl-2.0 | eclipse public | eclipse public license,? -? ?(v|version)?\.? ?2(\.0)?
epl-1.0 | eclipse public | eclipse public license,? -? ?(v|version)?\.? ?1(\.0)?
edl-1.0 | eclipse distribution | eclipse distribution license,? -? ?(v|version)?\.? ?1(\.0)?
cddl-1.1 | common development | common development and distribution license,? (v|version)?\.? ?1\.1
cddl-1.0 | common development | common development and distribution license,? (v|version)?\.? ?1\.0
cpl-1.0 | common public | common public license,? (v|version)?\.? ?1\.0
ipl-1.0 | ibm public | ibm public license,? (v|version)?\.? ?1\.0
bsl-1.0 | boost software | boost software license,? -? ?(v|version)?\.? ?1\.0
busl-1.1 | business source | business source license,? (v|version)?\.? ?1\.1
bsd-2-clause | bsd | (simplified bsd|bsd 2[- ]clause|2[- ]clause bsd|two[- ]clause bsd|freebsd)( license)?
bsd-3-clause | bsd | (new bsd|modified bsd|revised bsd|bsd 3[- ]clause|3[- ]clause bsd|three[- ]clause bsd)( license)?
bsd-4-clause | bsd | (original bsd|bsd 4[- ]clause|4[- ]clause bsd|four[- ]clause bsd)( license)?
0bsd | bsd | (zero[- ]clause bsd|0[- ]clause bsd|bsd zero[- ]clause)( license)?
artistic-2.0 | artistic | artistic license,? (v|version)?\.? ?2(\.0)?
artistic-1.0 | artistic | artistic license,? (v|version)?\.? ?1(\.0)?
afl-3.0 | academic free | academic free license,? (v|version)?\.? ?3(\.0)?
osl-3.0 | open software | open software license,? (v|version)?\.? ?3(\.0)?
eupl-1.2 | european union | european union public licen[cs]e,? (v|version)?\.? ?1\.2
eupl-1.1 | european union | european union public licen[cs]e,? (v|version)?\.? ?1\.1
cecill-2.1 | cecill | cecill( free software license agreement)?,? (v|version)?\.? ?2\.1
lppl-1.3c | project public | latex project public license,? (v|version)?\.? ?1\.3c?
ofl-1.1 | open font | (sil )?open font license,? (v|version)?\.? ?1\.1
odbl-1.0 | open database | open database license,? (v|version)?\.? ?1\.0
sspl-1.0 | server side | server side public license,? (v|version)?\.? ?1
upl-1.0 | universal permissive | universal permissive license,? (v|version)?\.? ?1\.0
qpl-1.0 | q public | q public license,? (v|version)?\.? ?1\.0
php-3.01 | php license | php license,? (v|version)?\.? ?3\.01
zpl-2.1 | zope public | zope public license,? (v|version)?\.? ?2\.1
ecl-2.0 | educational community | educational community license,? (v|version)?\.? ?2\.0
mulanpsl-2.0 | mulan | mulan permissive software license,? (v|version)?\.? ?2
apsl-2.0 | apple public | apple public source license,? (v|version)?\.? ?2\.0
cc-by-4.0 | creative commons | creative commons attribution 4\.0( international)?
cc-by-3.0 | creative commons | creative commons attribution 3\.0( unported)?
cc-by-sa-4.0 | creative commons | creative commons attribution[- ]share-?alike 4\.0( international)?
cc-by-sa-3.0 | creative commons | creative commons attribution[- ]share-?alike 3\.0( unported)?
cc-by-nc-4.0 | creative commons | creative commons attribution[- ]non-?commercial 4\.0( international)?
cc-by-nc-sa-4.0 | creative commons | creative commons attribution[- ]non-?commercial[- ]share-?alike 4\.0( international)?
cc-by-nc-nd-4.0 | creative commons | creative commons attribution[- ]non-?commercial[- ]no-?derivatives 4\.0( international)?
cc0-1.0 | cc0 | cc0 1\.0( universal)?
cc-by-4.0 | cc | cc[- ]by[- ]4\.0
cc-by-3.0 | cc | cc[- ]by[- ]3\.0
cc-by-sa-4.0 | cc | cc[- ]by[- ]sa[- ]4\.0
cc-by-sa-3.0 | cc | cc[- ]by[- ]sa[- ]3\.0
cc-by-nc-4.0 | cc | cc[- ]by[- ]nc[- ]4\.0
cc-by-nc-sa-4.0 | cc | cc[- ]by[- ]nc[- ]sa[- ]4\.0
cc-by-nc-nd-4.0 | cc | cc[- ]by[- ]nc[- ]nd[- ]4\.0
gpl-3.0 | gpl | (gnu )?gpl[- ]?(v|version)?\.? ?3(\.0)?
gpl-2.0 | gpl | (gnu )?gpl[- ]?(v|version)?\.? ?2(\.0)?
lgpl-3.0 | lgpl | (gnu )?lgpl[- ]?(v|version)?\.? ?3(\.0)?
lgpl-2.1 | lgpl | (gnu )?lgpl[- ]?(v|version)?\.? ?2\.1
agpl-3.0 | agpl | (gnu )?agpl[- ]?(v|version)?\.? ?3(\.0)?
"""

NAMES = r"""
agpl | gnu affero | gnu affero general public license
lgpl | gnu lesser | gnu lesser general public license
lgpl | gnu library | gnu library general public license
gpl | gnu general public | gnu general public license
gfdl | free documentation | gnu free documentation license
apache | apache | apache (software )?license
mit | mit license | mit license
mit | expat license | expat license
bsd | bsd license | bsd license
isc | isc license | isc license
mpl | mozilla public | mozilla public license
epl | eclipse public | eclipse public license
cddl | common development | common development and distribution license
bsl-1.0 | boost software | boost software license
artistic | artistic license | artistic license
unlicense | unlicense | the unlicense
zlib | zlib license | zlib license
x11 | x11 license | x11 license
ncsa | ncsa | ncsa open source license
openssl | openssl license | openssl license
psf-2.0 | python software foundation | python software foundation license
ruby | ruby license | ruby license
vim | vim license | vim license
w3c | w3c | w3c software( notice and)? license
postgresql | postgresql license | postgresql license
ofl-1.1 | open font | (sil )?open font license
odbl-1.0 | open database | open database license
pddl-1.0 | public domain dedication | public domain dedication and license
cc-by-sa | creative commons | creative commons attribution[- ]share-?alike
cc-by-nc-sa | creative commons | creative commons attribution[- ]non-?commercial[- ]share-?alike
cc-by-nc-nd | creative commons | creative commons attribution[- ]non-?commercial[- ]no-?derivatives
cc-by-nc | creative commons | creative commons attribution[- ]non-?commercial
cc-by-nd | creative commons | creative commons attribution[- ]no-?derivatives
cc-by | creative commons | creative commons attribution
cc0 | cc0 | cc0
cc-by-nc-sa | cc | cc[- ]by[- ]nc[- ]sa
cc-by-nc-nd | cc | cc[- ]by[- ]nc[- ]nd
cc-by-sa | cc | cc[- ]by[- ]sa
cc-by-nc | cc | cc[- ]by[- ]nc
cc-by-nd | cc | cc[- ]by[- ]nd
cc-by | cc | cc[- ]by
agpl | agpl | agpl
lgpl | lgpl | lgpl
gpl | gpl | gpl
eupl | eupl | eupl
wtfpl | wtfpl | wtfpl
cecill | cecill | cecill(-[bc])?
ms-pl | ms-pl | ms-pl
public-domain | public domain | public domain
all-rights-reserved | all rights reserved | all rights reserved
"""

CONFIDENCE = {1: 1.0, 2: 0.95, 3: 0.9, 4: 0.6}


def _lines(block: str, priority: int) -> list[tuple[str, str, str, int]]:
    rows = [line.split(" | ", 2) for line in block.strip().splitlines()]
    return [(label, keyword, pattern, priority) for label, keyword, pattern in rows]


def _whole(pattern: str) -> str:
    spaced = pattern.replace(" ?", r"\s*").replace(" ", r"\s+")
    return rf"(?<![0-9a-z])(?:{spaced})(?![0-9a-z])"


TAG = "spdx-license-identifier"
_ALL = (
    [(name, TAG, rf"{TAG}: ?\(?{re.escape(name)}(?!-)", 1) for name in TAGGED]
    + _lines(ADDRESSES, 1)
    + _lines(NOTICES, 2)
    + _lines(TITLES, 3)
    + _lines(NAMES, 4)
)
SIGNATURES = [
    Signature(label, keyword, _whole(pattern), priority, order)
    for order, (label, keyword, pattern, priority) in enumerate(_ALL)
]

# Base phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
