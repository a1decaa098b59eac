"""Licence signatures, written by hand.

Each rule: label, rank, keyword, pattern. Patterns are matched against the words of a text,
lower-cased in ASCII and joined by single blanks, with a blank at either end, and always cover
whole words. The keyword is a phrase that every match of the pattern contains; it gates the
pattern. Every keyword contains one of ``ANCHORS``, and a text without an anchor has no match at
all. Ranks: 4 full notice or grant, 3 title with version or tag, 2 title or address, 1 hint.
"""

from __future__ import annotations

#: What a text must contain, in any case, to be looked at: words with any separators between.
ANCHORS = ("licen[sc]", "copyright", "copyleft", "warrant", "spdx", "gpl", "creative",
           "public[^a-z]*+domain", "cc0", "wtfpl", "redistribut", "apache", "bsd",
           "mozilla", "permission")

SCORES = {4: 1.0, 3: 0.9, 2: 0.7, 1: 0.4}

_RULES = r"""
apache-2.0 | 4 | apache license | licensed under the apache license version 2(?: 0)?
apache-2.0 | 3 | apache license | apache (?:software )?license v(?:ersion)? ?2(?: 0)?
apache-2.0 | 3 | apache license | the apache license 2(?: 0)?
apache-2.0 | 3 | license 2 0 | apache org licenses license 2 0(?: txt| html)?
apache-2.0 | 3 | apache 2 0 | spdx license identifier apache 2 0
apache-2.0 | 2 | apache 2 0 | apache 2 0(?: license| licence)?
apache-2.0 | 4 | apache license | you may obtain a copy of the license at (?:\S+ ){0,6}apache license
apache-1.1 | 3 | apache software license | apache software license version 1 1
apache-1.1 | 3 | apache 1 1 | spdx license identifier apache 1 1
apache-1.0 | 3 | apache software license | apache software license version 1 0
apache-1.0 | 3 | apache 1 0 | spdx license identifier apache 1 0
apache | 2 | apache software license | apache software license
apache | 2 | apache license | (?:under )?(?:the )?apache license
apache | 1 | apache | licensed (?:under|to you by) (?:the )?apache
mit | 4 | permission is hereby granted | permission is hereby granted free of charge to any person obtaining a copy of this software
mit | 3 | mit license | (?:licensed |released |distributed )?under the (?:terms of the )?mit license
mit | 3 | license identifier mit | spdx license identifier mit
mit | 3 | licenses mit | opensource org licenses mit(?: license)?(?: php)?
mit | 2 | mit license | (?:the )?mit license
mit | 2 | mit licence | (?:the )?mit licence
mit | 2 | mit licensed | (?:is |are )?mit licensed
mit | 2 | expat license | (?:the )?expat license
mit | 2 | x11 license | (?:the )?mit x11 license
mit-0 | 3 | mit no attribution license | mit no attribution license
mit-0 | 3 | license identifier mit 0 | spdx license identifier mit 0
x11 | 2 | x11 license | (?:the )?x11 license
x11 | 3 | license identifier x11 | spdx license identifier x11
gpl-3.0 | 4 | general public license | gnu general public license as published by the free software foundation either version 3 of the license
gpl-3.0 | 3 | general public license | gnu general public license v(?:ersion)? ?3(?: 0)?
gpl-3.0 | 3 | general public license | licensed under the gnu general public license version 3
gpl-3.0 | 3 | licenses gpl 3 0 | (?:gnu|opensource) org licenses gpl 3 0(?: html| en html| txt)?
gpl-3.0 | 3 | gpl 3 0 | spdx license identifier gpl 3 0(?: only| or later)?
gpl-3.0 | 2 | gplv3 | (?:gnu )?gplv3(?: or later)?
gpl-3.0 | 2 | gpl v3 | (?:gnu )?gpl v3(?: or later)?
gpl-3.0 | 2 | gpl 3 0 | gpl 3 0(?: only| or later)?
gpl-3.0 | 2 | gpl version 3 | (?:gnu )?gpl version 3
gpl-2.0 | 4 | general public license | gnu general public license as published by the free software foundation either version 2 of the license
gpl-2.0 | 3 | general public license | gnu general public license v(?:ersion)? ?2(?: 0)?
gpl-2.0 | 3 | licenses gpl 2 0 | (?:gnu|opensource) org licenses (?:old licenses )?gpl 2 0(?: html| en html| txt)?
gpl-2.0 | 3 | gpl 2 0 | spdx license identifier gpl 2 0(?: only| or later)?
gpl-2.0 | 2 | gplv2 | (?:gnu )?gplv2(?: or later)?
gpl-2.0 | 2 | gpl v2 | (?:gnu )?gpl v2(?: or later)?
gpl-2.0 | 2 | gpl 2 0 | gpl 2 0(?: only| or later)?
gpl-2.0 | 2 | gpl version 2 | (?:gnu )?gpl version 2
gpl-1.0 | 3 | general public license | gnu general public license v(?:ersion)? ?1(?: 0)?
gpl-1.0 | 3 | gpl 1 0 | spdx license identifier gpl 1 0(?: only| or later)?
gpl | 3 | general public license | under the terms of the gnu general public license
gpl | 2 | general public license | (?:the )?gnu general public license
gpl | 2 | general public licence | (?:the )?gnu general public licence
gpl | 2 | general public license | general public license
gpl | 2 | gnu gpl | (?:the )?gnu gpl
gpl | 1 | gpl | (?:licensed )?under (?:the )?gpl
gpl | 2 | licenses gpl | gnu org (?:licenses|copyleft) (?:licenses )?gpl(?: html)?
gpl-cc-1.0 | 3 | gpl cooperation commitment | gpl cooperation commitment(?: version 1 0)?
lgpl-3.0 | 3 | lesser general public license | gnu lesser general public license v(?:ersion)? ?3(?: 0)?
lgpl-3.0 | 3 | lgpl 3 0 | spdx license identifier lgpl 3 0(?: only| or later)?
lgpl-3.0 | 3 | licenses lgpl 3 0 | (?:gnu|opensource) org licenses lgpl 3 0(?: html)?
lgpl-3.0 | 2 | lgplv3 | (?:gnu )?lgplv3(?: or later)?
lgpl-3.0 | 2 | lgpl v3 | (?:gnu )?lgpl v3
lgpl-2.1 | 4 | lesser general public license | gnu lesser general public license as published by the free software foundation either version 2 1 of the license
lgpl-2.1 | 3 | lesser general public license | gnu lesser general public license v(?:ersion)? ?2 1
lgpl-2.1 | 3 | lgpl 2 1 | spdx license identifier lgpl 2 1(?: only| or later)?
lgpl-2.1 | 3 | licenses lgpl 2 1 | gnu org licenses (?:old licenses )?lgpl 2 1(?: html)?
lgpl-2.1 | 2 | lgpl 2 1 | lgpl 2 1(?: or later)?
lgpl-2.1 | 2 | lgpl v2 1 | (?:gnu )?lgpl v2 1
lgpl-2.0 | 3 | library general public license | gnu library general public license(?: version 2(?: 0)?)?
lgpl-2.0 | 3 | lgpl 2 0 | spdx license identifier lgpl 2 0(?: only| or later)?
lgpl | 2 | lesser general public license | (?:the )?(?:gnu )?lesser general public license
lgpl | 2 | lesser general public licence | (?:the )?(?:gnu )?lesser general public licence
lgpl | 1 | lgpl | (?:under (?:the )?|gnu )lgpl
agpl-3.0 | 4 | affero general public license | gnu affero general public license as published by the free software foundation either version 3 of the license
agpl-3.0 | 3 | affero general public license | gnu affero general public license v(?:ersion)? ?3(?: 0)?
agpl-3.0 | 3 | agpl 3 0 | spdx license identifier agpl 3 0(?: only| or later)?
agpl-3.0 | 3 | licenses agpl 3 0 | (?:gnu|opensource) org licenses agpl 3 0(?: html)?
agpl-3.0 | 2 | agplv3 | (?:gnu )?agplv3
agpl-3.0 | 2 | agpl v3 | (?:gnu )?agpl v3
agpl | 2 | affero general public license | (?:the )?(?:gnu )?affero general public license
agpl | 1 | agpl | (?:under (?:the )?|gnu )agpl
gfdl-1.3 | 3 | free documentation license | gnu free documentation license v(?:ersion)? ?1 3
gfdl-1.2 | 3 | free documentation license | gnu free documentation license v(?:ersion)? ?1 2
gfdl-1.1 | 3 | free documentation license | gnu free documentation license v(?:ersion)? ?1 1
gfdl | 2 | free documentation license | (?:the )?(?:gnu )?free documentation license
bsd-2-clause | 3 | bsd 2 clause | spdx license identifier bsd 2 clause
bsd-2-clause | 3 | bsd 2 clause | bsd 2 clause(?: simplified)?(?: license)?
bsd-2-clause | 2 | bsd license | (?:2|two) clause bsd license
bsd-2-clause | 2 | simplified bsd license | simplified bsd license
bsd-2-clause | 2 | freebsd license | (?:the )?freebsd license
bsd-3-clause | 4 | redistributions in binary form | redistribution and use (?:(?!redistribution and use |all advertising materials mentioning features ).)*?redistributions in binary form (?:(?!redistribution and use |all advertising materials mentioning features ).)*?neither the names? of (?:(?!redistribution and use ).)*?nor the names of (?:its|their|the|any) contributors
bsd-3-clause | 3 | bsd 3 clause | spdx license identifier bsd 3 clause
bsd-3-clause | 3 | bsd 3 clause | bsd 3 clause(?: new| revised)?(?: license)?
bsd-3-clause | 2 | bsd license | (?:3|three) clause bsd license
bsd-3-clause | 2 | new bsd license | (?:the )?new bsd license
bsd-3-clause | 2 | modified bsd license | (?:the )?modified bsd license
bsd-3-clause | 2 | revised bsd license | (?:the )?revised bsd license
bsd-3-clause-clear | 3 | clear bsd license | (?:the )?clear bsd license
bsd-4-clause | 3 | bsd 4 clause | spdx license identifier bsd 4 clause
bsd-4-clause | 3 | bsd 4 clause | bsd 4 clause(?: original| old)?(?: license)?
bsd-4-clause | 2 | bsd license | (?:4|four) clause bsd license
bsd-4-clause | 2 | original bsd license | (?:the )?original bsd license
bsd-4-clause | 3 | redistribution and use | redistribution and use (?:(?!redistribution and use ).)*?all advertising materials mentioning features
bsd-0-clause | 3 | 0bsd | spdx license identifier 0bsd
bsd-0-clause | 2 | bsd zero clause license | bsd zero clause license
bsd | 3 | redistribution and use in source | redistribution and use in source and binary forms with or without modification are permitted
bsd | 2 | bsd license | (?:the )?bsd license
bsd | 2 | bsd licence | (?:the )?bsd licence
bsd | 2 | bsd style license | bsd style license
bsd | 2 | bsd licensed | bsd licensed
bsd-2-clause-patent | 3 | bsd 2 clause patent | bsd 2 clause patent
isc | 4 | permission to use copy modify | permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee is hereby granted
isc | 3 | isc license | (?:under )?the isc license
isc | 3 | license identifier isc | spdx license identifier isc
isc | 2 | isc license | isc license
isc | 2 | isc licence | isc licence
hpnd | 3 | permission to use copy modify | permission to use copy modify and distribute this software and its documentation for any purpose
mpl-2.0 | 4 | mozilla public license | subject to the terms of the mozilla public license v(?:ersion)? ?2 0
mpl-2.0 | 3 | mozilla public license | mozilla public license v(?:ersion)? ?2(?: 0)?
mpl-2.0 | 3 | license identifier mpl 2 0 | spdx license identifier mpl 2 0
mpl-2.0 | 3 | mozilla org mpl | mozilla org mpl 2 0
mpl-1.1 | 3 | mozilla public license | mozilla public license v(?:ersion)? ?1 1
mpl-1.1 | 3 | license identifier mpl 1 1 | spdx license identifier mpl 1 1
mpl-1.0 | 3 | mozilla public license | mozilla public license v(?:ersion)? ?1 0
mpl | 2 | mozilla public license | (?:the )?mozilla public license
epl-2.0 | 3 | eclipse public license | eclipse public license v(?:ersion)? ?2(?: 0)?
epl-2.0 | 3 | license identifier epl 2 0 | spdx license identifier epl 2 0
epl-1.0 | 3 | eclipse public license | eclipse public license v(?:ersion)? ?1(?: 0)?
epl-1.0 | 3 | license identifier epl 1 0 | spdx license identifier epl 1 0
epl | 2 | eclipse public license | (?:the )?eclipse public license
edl-1.0 | 3 | eclipse distribution license | eclipse distribution license(?: v(?:ersion)? ?1 0)?
cpl-1.0 | 3 | common public license | common public license(?: v(?:ersion)? ?1 0)?
cddl-1.1 | 3 | common development and distribution license | common development and distribution license(?: cddl)? v(?:ersion)? ?1 1
cddl-1.0 | 3 | common development and distribution license | common development and distribution license(?: cddl)? v(?:ersion)? ?1 0
cddl | 2 | common development and distribution license | common development and distribution license
ipl-1.0 | 3 | ibm public license | ibm public license(?: version 1 0)?
eupl-1.2 | 3 | european union public licence | european union public licence v(?:ersion)? ?1 2
eupl-1.1 | 3 | european union public licence | european union public licence v(?:ersion)? ?1 1
eupl | 2 | european union public licence | (?:the )?european union public licence
eupl | 2 | european union public license | (?:the )?european union public license
cecill-2.1 | 3 | cecill free software license | cecill free software license agreement(?: version 2 1)?
cecill-b | 3 | cecill b license | cecill b license
cecill-c | 3 | cecill c license | cecill c license
cecill | 2 | cecill license | cecill license
artistic-2.0 | 3 | artistic license | artistic license v?(?:ersion )?2(?: 0)?
artistic-2.0 | 3 | license identifier artistic 2 0 | spdx license identifier artistic 2 0
artistic-1.0 | 3 | artistic license | artistic license v?(?:ersion )?1(?: 0)?
artistic | 2 | artistic license | (?:the )?(?:perl )?artistic license
zlib | 3 | zlib license | (?:the )?zlib license
zlib | 3 | license identifier zlib | spdx license identifier zlib
zlib | 3 | zlib libpng license | zlib libpng license
zlib | 4 | express or implied warranty | provided as is without any express or implied warranty in no event will the authors be held liable
libpng | 3 | libpng license | libpng license(?: version 2)?
bsl-1.0 | 3 | boost software license | boost software license(?: v(?:ersion)? ?1 0)?
bsl-1.0 | 3 | license identifier bsl 1 0 | spdx license identifier bsl 1 0
bsl-1.0 | 3 | license 1 0 txt | boost org license 1 0 txt
busl-1.1 | 3 | business source license | business source license(?: 1 1)?
sspl-1.0 | 3 | server side public license | server side public license(?: v(?:ersion)? ?1)?
elastic-2.0 | 3 | elastic license | elastic license(?: v?2(?: 0)?)?
elastic-2.0 | 3 | license identifier elastic 2 0 | spdx license identifier elastic 2 0
commons-clause | 3 | commons clause license | commons clause license(?: condition)?(?: v1 0)?
polyform-nc-1.0.0 | 3 | polyform noncommercial license | polyform noncommercial license(?: 1 0 0)?
polyform-sb-1.0.0 | 3 | polyform small business license | polyform small business license(?: 1 0 0)?
wtfpl | 3 | wtfpl | (?:license identifier )?wtfpl(?: v(?:ersion)? ?2)?
wtfpl | 4 | want to public license | do what the fuck you want to public license
unlicense | 3 | unlicense | (?:the |spdx license identifier )?unlicense
unlicense | 4 | released into the public domain | free and unencumbered software released into the public domain
public-domain | 3 | dedicated to the public domain | dedicated to the public domain
public-domain | 3 | placed in the public domain | (?:is |been )?placed in the public domain
public-domain | 2 | in the public domain | (?:is |are )in the public domain
public-domain | 3 | public domain dedication | public domain dedication
cc0-1.0 | 3 | cc0 | (?:spdx license identifier )?cc0 1 0(?: universal)?
cc0-1.0 | 3 | creative commons zero | creative commons zero(?: v?1 0)?(?: universal)?
cc0-1.0 | 3 | publicdomain zero | creativecommons org publicdomain zero 1 0
cc0-1.0 | 2 | cc0 | (?:under )?cc0
cc-by-4.0 | 3 | licensed under cc by | licensed under cc by 4 0
cc-by-3.0 | 3 | licensed under cc by | licensed under cc by 3 0
cc-by-sa-4.0 | 3 | licensed under cc by sa | licensed under cc by sa 4 0
cc-by-sa-3.0 | 3 | licensed under cc by sa | licensed under cc by sa 3 0
cc-by-nc-4.0 | 3 | licensed under cc by nc | licensed under cc by nc 4 0
cc-by-nc-3.0 | 3 | licensed under cc by nc | licensed under cc by nc 3 0
cc-by-nd-4.0 | 3 | licensed under cc by nd | licensed under cc by nd 4 0
cc-by-nc-sa-4.0 | 3 | licensed under cc by nc sa | licensed under cc by nc sa 4 0
cc-by-nc-nd-4.0 | 3 | licensed under cc by nc nd | licensed under cc by nc nd 4 0
cc-by-4.0 | 3 | creative commons attribution 4 0 | creative commons attribution 4 0(?: international)?(?: public)?(?: license)?
cc-by-3.0 | 3 | creative commons attribution 3 0 | creative commons attribution 3 0(?: unported)?(?: license)?
cc-by-sa-4.0 | 3 | creative commons attribution sharealike 4 0 | creative commons attribution sharealike 4 0(?: international)?(?: license)?
cc-by-sa-3.0 | 3 | creative commons attribution sharealike 3 0 | creative commons attribution sharealike 3 0(?: unported)?(?: license)?
cc-by-nc-4.0 | 3 | creative commons attribution noncommercial 4 0 | creative commons attribution noncommercial 4 0(?: international)?(?: license)?
cc-by-nc-sa-4.0 | 3 | creative commons attribution noncommercial sharealike 4 0 | creative commons attribution noncommercial sharealike 4 0(?: international)?
cc-by-nc-nd-4.0 | 3 | creative commons attribution noncommercial noderivatives 4 0 | creative commons attribution noncommercial noderivatives 4 0(?: international)?
cc-by-nd-4.0 | 3 | creative commons attribution noderivatives 4 0 | creative commons attribution noderivatives 4 0(?: international)?
cc-by-4.0 | 3 | licenses by 4 0 | creativecommons org licenses by 4 0
cc-by-3.0 | 3 | licenses by 3 0 | creativecommons org licenses by 3 0
cc-by-sa-4.0 | 3 | licenses by sa 4 0 | creativecommons org licenses by sa 4 0
cc-by-sa-3.0 | 3 | licenses by sa 3 0 | creativecommons org licenses by sa 3 0
cc-by-nc-4.0 | 3 | licenses by nc 4 0 | creativecommons org licenses by nc 4 0
cc-by-nc-sa-4.0 | 3 | licenses by nc sa 4 0 | creativecommons org licenses by nc sa 4 0
cc-by-nd-4.0 | 3 | licenses by nd 4 0 | creativecommons org licenses by nd 4 0
cc-by-nc-nd-4.0 | 3 | licenses by nc nd 4 0 | creativecommons org licenses by nc nd 4 0
cc-by-4.0 | 3 | license identifier cc by 4 0 | spdx license identifier cc by 4 0
cc-by-sa-4.0 | 3 | license identifier cc by sa 4 0 | spdx license identifier cc by sa 4 0
cc-by-nc-4.0 | 3 | license identifier cc by nc 4 0 | spdx license identifier cc by nc 4 0
cc-by-nc | 2 | cc by nc license | (?:a |the )?cc by nc license
cc-by-sa | 2 | cc by sa license | (?:a |the )?cc by sa license
cc-by | 2 | cc by license | (?:a |the )?cc by license
cc-by | 2 | creative commons attribution license | creative commons attribution license
cc | 1 | creative commons license | (?:a |the )?creative commons license
cc | 1 | creative commons | licensed under (?:a |the )?creative commons
odbl-1.0 | 3 | open database license | open database license(?: v?1 0)?
odc-by-1.0 | 3 | open data commons attribution license | open data commons attribution license(?: v?1 0)?
pddl-1.0 | 3 | public domain dedication and license | (?:open data commons )?public domain dedication and license(?: v?1 0)?
ofl-1.1 | 3 | sil open font license | sil open font license(?: version)?(?: 1 1)?
ofl-1.1 | 3 | license identifier ofl 1 1 | spdx license identifier ofl 1 1
python-2.0 | 3 | python software foundation license | python software foundation license(?: version 2)?
python-2.0 | 2 | psf license | (?:the )?psf license
php-3.01 | 3 | php license | php license(?: version 3 01)?
ruby | 3 | ruby license | (?:the )?ruby license
postgresql | 3 | postgresql license | (?:the )?postgresql license
openssl | 3 | openssl license | (?:the )?openssl license
curl | 3 | curl license | (?:the )?curl license
vim | 3 | vim license | (?:the )?vim license
w3c | 3 | w3c software notice and license | w3c software notice and license
w3c | 2 | w3c software license | w3c software license
unicode | 3 | unicode license | unicode license(?: v3| agreement)?
ncsa | 3 | ncsa open source license | (?:university of illinois )?ncsa open source license
afl-3.0 | 3 | academic free license | academic free license(?: v(?:ersion)? ?3 0)?
osl-3.0 | 3 | open software license | open software license(?: v(?:ersion)? ?3 0)?
rpl-1.5 | 3 | reciprocal public license | reciprocal public license(?: 1 5)?
ms-pl | 3 | microsoft public license | microsoft public license(?: ms pl)?
ms-rl | 3 | microsoft reciprocal license | microsoft reciprocal license(?: ms rl)?
qpl-1.0 | 3 | q public license | (?:the )?q public license(?: version 1 0)?
lppl-1.3c | 3 | latex project public license | latex project public license(?: version 1 3c?)?
npl-1.1 | 3 | netscape public license | netscape public license(?: version 1 1)?
spl-1.0 | 3 | sun public license | sun public license(?: version 1 0)?
apsl-2.0 | 3 | apple public source license | apple public source license(?: version 2 0)?
nasa-1.3 | 3 | nasa open source agreement license | nasa open source agreement license
upl-1.0 | 3 | universal permissive license | universal permissive license(?: v(?:ersion)? ?1 0)?
blueoak-1.0.0 | 3 | blue oak model license | blue oak model license(?: 1 0 0)?
mulan-psl-2.0 | 3 | mulan permissive software license | mulan permissive software license(?: v2)?
openrail | 3 | openrail license | (?:creativeml )?openrail license
openrail | 2 | openrail m license | (?:creativeml )?openrail m license
beerware | 3 | beer ware license | (?:the )?beer ware license(?: revision 42)?
json | 3 | json license | (?:the )?json license
proprietary | 2 | all rights reserved copyright | all rights reserved copyright
proprietary | 3 | proprietary license | (?:under )?(?:a |the )?proprietary license
proprietary | 2 | commercial license | (?:under )?(?:a |the )?commercial license
proprietary | 3 | redistribution is prohibited | (?:copying or )?redistribution is prohibited
proprietary | 3 | without prior written permission | reproduced (?:\S+ ){0,12}?without prior written permission
non-commercial | 2 | non commercial license | (?:a |the )?non commercial license
non-commercial | 2 | noncommercial license | (?:a |the )?noncommercial license
copyright-notice | 1 | copyright | copyright (?:c )?(?:19|20)[0-9][0-9](?: (?:19|20)[0-9][0-9])?
copyright-notice | 1 | copyright | copyright (?:by|c) [a-z]+
copyleft | 1 | copyleft license | (?:a |the )?(?:strong |weak )?copyleft license
no-warranty | 1 | without warranty of any kind | (?:provided )?(?:as is )?without warranty of any kind
no-warranty | 1 | without any warranty | (?:but )?without any warranty
license-file | 1 | license file | see (?:the )?(?:accompanying )?license file
license-file | 1 | license for details | see (?:the )?license for details
license-file | 1 | license txt | (?:see )?license txt
open-source | 1 | open source license | (?:an |the )?open source license
open-source | 1 | free software license | (?:a |the )?free software license
"""

RULES = [(label, int(rank), keyword, pattern) for label, rank, keyword, pattern in (
    (part.strip() for part in line.split(" | ", 3)) for line in _RULES.strip().splitlines())]
