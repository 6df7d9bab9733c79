"""The signature rules of the license scan, in order.

One rule a line: ``priority | label | keyword | pattern | versions``.  Patterns
are regular expressions over a text's words, lower case and one space apart
(so ``GPL-2.0`` reads ``gpl 2 0``).  A rule is tried only on texts that hold
its keyword.  With versions a line stands for one rule each: ``{v}`` is the
version, in patterns word by word and with an optional last `` 0``.  ``~`` in a
pattern stands for up to three words of any kind.

Priorities: 1 machine-readable tags, 2 grants in full wording, 3 names with a
version, 4 names, 5 references by address or file, 6 restrictions and
permissions, 7 general notices.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

#: phrases whose every place is reported, whatever the rules make of it
BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: how sure a detection of a priority is
CONFIDENCE = {1: 0.99, 2: 0.97, 3: 0.95, 4: 0.8, 5: 0.75, 6: 0.6, 7: 0.4}

RULES_TEXT = r"""
1 | mit | spdx license | spdx license identifier mit
1 | mit-0 | spdx license | spdx license identifier mit 0
1 | apache-{v} | spdx license | spdx license identifier apache {v} | 1.0 1.1 2.0
1 | bsd-{v}-clause | spdx license | spdx license identifier bsd {v} clause | 1 2 3 4
1 | 0bsd | spdx license | spdx license identifier 0bsd
1 | gpl-{v}-only | spdx license | spdx license identifier gpl {v}(?: only)? | 1.0 2.0 3.0
1 | gpl-{v}-or-later | spdx license | spdx license identifier gpl {v} or later | 1.0 2.0 3.0
1 | lgpl-{v}-only | spdx license | spdx license identifier lgpl {v}(?: only)? | 2.0 2.1 3.0
1 | lgpl-{v}-or-later | spdx license | spdx license identifier lgpl {v} or later | 2.0 2.1 3.0
1 | agpl-{v}-only | spdx license | spdx license identifier agpl {v}(?: only)? | 1.0 3.0
1 | agpl-{v}-or-later | spdx license | spdx license identifier agpl {v} or later | 1.0 3.0
1 | gfdl-{v} | spdx license | spdx license identifier gfdl {v}(?: only| or later)? | 1.1 1.2 1.3
1 | mpl-{v} | spdx license | spdx license identifier mpl {v} | 1.0 1.1 2.0
1 | epl-{v} | spdx license | spdx license identifier epl {v} | 1.0 2.0
1 | cddl-{v} | spdx license | spdx license identifier cddl {v} | 1.0 1.1
1 | eupl-{v} | spdx license | spdx license identifier eupl {v} | 1.0 1.1 1.2
1 | cc-by-{v} | spdx license | spdx license identifier cc by {v} | 1.0 2.0 2.5 3.0 4.0
1 | cc-by-sa-{v} | spdx license | spdx license identifier cc by sa {v} | 1.0 2.0 2.5 3.0 4.0
1 | cc-by-nc-{v} | spdx license | spdx license identifier cc by nc {v} | 1.0 2.0 2.5 3.0 4.0
1 | cc-by-nd-{v} | spdx license | spdx license identifier cc by nd {v} | 1.0 2.0 2.5 3.0 4.0
1 | cc-by-nc-sa-{v} | spdx license | spdx license identifier cc by nc sa {v} | 1.0 2.0 2.5 3.0 4.0
1 | cc-by-nc-nd-{v} | spdx license | spdx license identifier cc by nc nd {v} | 1.0 2.0 2.5 3.0 4.0
1 | cc0-1.0 | spdx license | spdx license identifier cc0 1 0
1 | isc | spdx license | spdx license identifier isc
1 | zlib | spdx license | spdx license identifier zlib
1 | unlicense | spdx license | spdx license identifier unlicense
1 | wtfpl | spdx license | spdx license identifier wtfpl
1 | bsl-1.0 | spdx license | spdx license identifier bsl 1 0
1 | busl-1.1 | spdx license | spdx license identifier busl 1 1
1 | artistic-{v} | spdx license | spdx license identifier artistic {v} | 1.0 2.0
1 | ofl-{v} | spdx license | spdx license identifier ofl {v} | 1.0 1.1
1 | ms-pl | spdx license | spdx license identifier ms pl
1 | ms-rl | spdx license | spdx license identifier ms rl
1 | ncsa | spdx license | spdx license identifier ncsa
1 | python-2.0 | spdx license | spdx license identifier (?:python|psf) 2 0
1 | postgresql | spdx license | spdx license identifier postgresql
1 | odbl-1.0 | spdx license | spdx license identifier odbl 1 0
1 | pddl-1.0 | spdx license | spdx license identifier pddl 1 0
1 | other-spdx | spdx license | spdx license identifier [a-z0-9]+(?: [0-9]+){0,3}
1 | cc-license-tag | rel license | rel license href ~ creativecommons org licenses [a-z ]{2,8}
2 | mit | permission is hereby granted | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
2 | mit | the software is provided as is | the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability
2 | mit-notice | the above copyright notice and this | the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
2 | isc | permission to use copy modify | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
2 | hpnd | permission to use copy modify | permission to use copy modify and distribute this software and its documentation for any purpose
2 | apache-{v} | licensed under the apache | licensed under the apache (?:software )?license version {v} | 1.0 1.1 2.0
2 | apache-2.0 | you may not use this file | you may not use this file except in compliance with the license
2 | apache-2.0 | distributed under the license is | (?:software )?distributed under the license is distributed on an as is basis
2 | bsd | redistribution and use in source | redistribution and use in source and binary forms with or without modification are permitted provided that
2 | bsd-3-clause | neither the name | neither the names? of (?:the )?\S+(?: \S+){0,8} nor the names of (?:its|their) contributors may be used to endorse
2 | bsd-4-clause | all advertising materials | all advertising materials mentioning features or use of this software must display
2 | bsd-disclaimer | copyright holders and contributors | this software is provided by the copyright holders and contributors as is
2 | gpl-{v}-or-later | or at your option | under the terms of the gnu general public license as published by the free software foundation (?:either )?version {v}(?: of the license)? or at your option any later version | 1.0 2.0 3.0
2 | lgpl-{v}-or-later | or at your option | under the terms of the gnu (?:lesser|library) general public license as published by the free software foundation (?:either )?version {v}(?: of the license)? or at your option any later version | 2.0 2.1 3.0
2 | agpl-3.0-or-later | or at your option | under the terms of the gnu affero general public license as published by the free software foundation (?:either )?version 3(?: of the license)? or at your option any later version
2 | gpl-{v} | general public license | (?:licensed|released|distributed|available|covered) under (?:the )?(?:terms of )?(?:the )?gnu general public license (?:as published by the free software foundation )?(?:version |v ?){v} | 1.0 2.0 3.0
2 | gpl-warranty | without any warranty | in the hope that it will be useful but without any warranty
2 | gpl-copy | received a copy of the gnu | you should have received a copy of the gnu (?:lesser |library |affero )?general public license
2 | gfdl-{v} | free documentation license | under the terms of the gnu free documentation license version {v} | 1.1 1.2 1.3
2 | mpl-{v} | mozilla public license | subject to the terms of the mozilla public license (?:v |version )?{v} | 1.0 1.1 2.0
2 | epl-{v} | eclipse public license | made available under the terms of the eclipse public license (?:v |version )?{v} | 1.0 2.0
2 | cddl | common development and distribution | subject to the terms of the common development and distribution license
2 | boost | boost software license | distributed under the boost software license
2 | zlib | this software is provided as is without | this software is provided as is without any express or implied warranty
2 | unlicense | released into the public domain | this is free and unencumbered software released into the public domain
2 | wtfpl | what the fuck you want | do what the fuck you want to public license
2 | beerware | buy me a beer | if we meet some day and you think this stuff is worth it you can buy me a beer
2 | ofl | open font license | this font software is licensed under the sil open font license
2 | ncsa | of illinois | university of illinois ncsa open source license
2 | openssl | openssl toolkit | this product includes software developed by the openssl project for use in the openssl toolkit
2 | eupl | european union public | licensed under the eupl|under the european union public licen[cs]e
2 | cc0 | to the extent possible under law | to the extent possible under law ~ (?:has|have) waived all copyright
2 | x11 | x consortium | except as contained in this notice the name of the x consortium shall not be used
2 | python-psf | python software foundation license | python software foundation license (?:version )?[0-9]+
2 | cc-by-{v} | creative commons attribution | licensed under (?:a|the) creative commons attribution {v} (?:international|unported|generic)? ?licen[cs]e | 1.0 2.0 2.5 3.0 4.0
2 | cc-by-sa-{v} | creative commons attribution | licensed under (?:a|the) creative commons attribution share ?alike {v} (?:international|unported|generic)? ?licen[cs]e | 1.0 2.0 2.5 3.0 4.0
2 | gfdl-wiki | text is available under | text is available under the creative commons attribution share ?alike licen[cs]e
2 | confidential | intended recipient | this (?:e mail|email|message) ~ intended (?:only |solely )?for the (?:use of the )?(?:intended )?recipient
3 | apache-{v} | apache | apache (?:software )?(?:licen[cs]e )?(?:version |v ?)?{v} | 1.0 1.1 2.0
3 | bsd-{v}-clause | clause | (?:new |modified |simplified )?bsd {v} clause(?: licen[cs]e)? | 0 1 2 3 4
3 | bsd-{v}-clause | clause bsd | {v} clause bsd(?: licen[cs]e)? | 0 1 2 3 4
3 | bsd-2-clause | simplified bsd | simplified bsd licen[cs]e
3 | bsd-3-clause | bsd | (?:new|modified|revised) bsd licen[cs]e
3 | gpl-{v} | gpl | (?:gnu )?gpl (?:version |v)? ?{v} | 1.0 2.0 3.0
3 | gpl-{v} | gplv | gplv ?{v} | 1.0 2.0 3.0
3 | gpl-{v}-or-later | gpl | (?:gnu )?gpl ?(?:version |v)? ?{v} or (?:any )?(?:later|newer) | 1.0 2.0 3.0
3 | gpl-{v} | general public license | (?:gnu )?general public licen[cs]e (?:version |v ?){v} | 1.0 2.0 3.0
3 | lgpl-{v} | lgpl | (?:gnu )?lgpl ?(?:version |v)? ?{v} | 2.0 2.1 3.0
3 | lgpl-{v} | lgplv | lgplv ?{v} | 2.0 2.1 3.0
3 | lgpl-{v} | general public license | (?:gnu )?(?:lesser|library) general public licen[cs]e (?:version |v ?){v} | 2.0 2.1 3.0
3 | agpl-{v} | agpl | (?:gnu )?agpl ?(?:version |v)? ?{v} | 1.0 3.0
3 | agpl-{v} | affero | (?:gnu )?affero general public licen[cs]e (?:version |v ?){v} | 1.0 3.0
3 | gfdl-{v} | gfdl | gfdl (?:version |v ?)?{v} | 1.1 1.2 1.3
3 | gfdl-{v} | free documentation | (?:gnu )?free documentation licen[cs]e (?:version |v ?){v} | 1.1 1.2 1.3
3 | mpl-{v} | mpl | mpl (?:version |v ?)?{v} | 1.0 1.1 2.0
3 | mpl-{v} | mozilla public | mozilla public licen[cs]e (?:version |v ?)?{v} | 1.0 1.1 2.0
3 | epl-{v} | eclipse public | eclipse public licen[cs]e (?:version |v ?)?{v} | 1.0 2.0
3 | cddl-{v} | cddl | cddl (?:version |v ?)?{v} | 1.0 1.1
3 | cddl-{v} | common development | common development and distribution licen[cs]e (?:version |v ?)?{v} | 1.0 1.1
3 | eupl-{v} | eupl | eupl (?:version |v ?)?{v} | 1.0 1.1 1.2
3 | cpl-1.0 | common public license | common public licen[cs]e (?:version |v ?)?1 0
3 | ipl-1.0 | ibm public license | ibm public licen[cs]e (?:version |v ?)?1 0
3 | apsl-{v} | apple public source | apple public source licen[cs]e (?:version |v ?)?{v} | 1.0 1.1 1.2 2.0
3 | osl-{v} | open software license | open software licen[cs]e (?:version |v ?)?{v} | 1.0 2.0 2.1 3.0
3 | afl-{v} | academic free license | academic free licen[cs]e (?:version |v ?)?{v} | 1.1 1.2 2.0 2.1 3.0
3 | artistic-{v} | artistic license | artistic licen[cs]e (?:version |v ?)?{v} | 1.0 2.0
3 | php-{v} | php license | php licen[cs]e (?:version |v ?)?{v} | 3.0 3.01
3 | zpl-{v} | zope public | zope public licen[cs]e (?:version |v ?)?{v} | 1.1 2.0 2.1
3 | lppl-{v} | latex project public | latex project public licen[cs]e (?:version |v ?)?{v} | 1.0 1.1 1.2 1.3
3 | ofl-{v} | open font license | (?:sil )?open font licen[cs]e (?:version |v ?)?{v} | 1.0 1.1
3 | cecill-{v} | cecill | cecill (?:version |v ?)?{v} | 1.0 1.1 2.0 2.1
3 | busl-1.1 | business source license | business source licen[cs]e (?:version |v ?)?1 1
3 | sspl-1.0 | server side public | server side public licen[cs]e (?:version |v ?)?1
3 | elastic-2.0 | elastic license | elastic licen[cs]e (?:version |v ?)?2 0
3 | odbl-1.0 | open database license | open database licen[cs]e (?:version |v ?)?1 0
3 | ogl-{v} | open government licence | open government licen[cs]e (?:version |v ?)?{v} | 1.0 2.0 3.0
3 | etalab-{v} | licence ouverte | licence ouverte (?:etalab )?(?:version |v ?)?{v} | 1.0 2.0
3 | cc-by-{v} | cc by | cc by {v} | 1.0 2.0 2.5 3.0 4.0
3 | cc-by-sa-{v} | cc by sa | cc by sa {v} | 1.0 2.0 2.5 3.0 4.0
3 | cc-by-nc-{v} | cc by nc | cc by nc {v} | 1.0 2.0 2.5 3.0 4.0
3 | cc-by-nd-{v} | cc by nd | cc by nd {v} | 1.0 2.0 2.5 3.0 4.0
3 | cc-by-nc-sa-{v} | cc by nc sa | cc by nc sa {v} | 1.0 2.0 2.5 3.0 4.0
3 | cc-by-nc-nd-{v} | cc by nc nd | cc by nc nd {v} | 1.0 2.0 2.5 3.0 4.0
3 | cc-by-{v} | creative commons attribution | creative commons attribution {v} | 1.0 2.0 2.5 3.0 4.0
3 | cc-by-sa-{v} | creative commons attribution | creative commons attribution share ?alike {v} | 1.0 2.0 2.5 3.0 4.0
3 | cc-by-nc-{v} | creative commons attribution | creative commons attribution non ?commercial {v} | 1.0 2.0 2.5 3.0 4.0
3 | cc-by-nd-{v} | creative commons attribution | creative commons attribution no ?deriv(?:s|atives|ative works) {v} | 1.0 2.0 2.5 3.0 4.0
3 | cc0-1.0 | cc0 | cc0 (?:version |v ?)?1 0(?: universal)?
4 | mit | mit license | (?:the )?mit licen[cs]e
4 | mit | expat license | expat licen[cs]e
4 | apache | apache license | (?:the )?apache (?:software )?licen[cs]e
4 | bsd | bsd license | (?:the )?bsd(?: style)? licen[cs]e
4 | gpl | gnu general public | gnu general public licen[cs]e
4 | lgpl | lesser general public | (?:gnu )?lesser general public licen[cs]e
4 | lgpl | library general public | (?:gnu )?library general public licen[cs]e
4 | agpl | affero general public | (?:gnu )?affero general public licen[cs]e
4 | gpl | licence publique | licence publique g[^ ]{1,4}n[^ ]{1,4}rale(?: gnu)?
4 | gpl | licencia p | licencia p[^ ]{1,3}blica general(?: de gnu)?
4 | gpl | allgemeine | allgemeinen? [^ ]{1,3}ffentlichen? gnu lizenz
4 | gfdl | free documentation license | (?:gnu )?free documentation licen[cs]e
4 | mpl | mozilla public license | mozilla public licen[cs]e
4 | epl | eclipse public license | eclipse public licen[cs]e
4 | boost | boost software license | boost software licen[cs]e
4 | artistic | artistic license | artistic licen[cs]e
4 | isc | isc license | isc licen[cs]e
4 | zlib | zlib | zlib(?: libpng)? licen[cs]e
4 | unlicense | unlicense | (?:the )?unlicense
4 | wtfpl | wtfpl | wtfpl
4 | ms-pl | microsoft public license | microsoft public licen[cs]e
4 | ms-rl | microsoft reciprocal | microsoft reciprocal licen[cs]e
4 | ofl | open font license | open font licen[cs]e
4 | odbl | open database license | open database licen[cs]e
4 | ogl | open government | open government licen[cs]e
4 | openrail | openrail | (?:creativeml )?open ?rail(?: m)?(?: licen[cs]e)?
4 | cc0 | cc0 | cc0
4 | cc-by-sa | cc by sa | cc by sa
4 | cc-by-nc | cc by nc | cc by nc
4 | cc-by-nd | cc by nd | cc by nd
4 | cc-by-nc-sa | cc by nc sa | cc by nc sa
4 | cc-by-nc-nd | cc by nc nd | cc by nc nd
4 | cc-by | cc by | cc by
4 | cc-by | creative commons attribution | creative commons attribution
4 | cc-by-sa | creative commons attribution | creative commons attribution share ?alike
4 | cc-by-nc | creative commons attribution | creative commons attribution non ?commercial
4 | cc-by-nd | creative commons attribution | creative commons attribution no ?deriv(?:s|atives|ative works)
4 | cc-by-nc-sa | creative commons attribution | creative commons attribution non ?commercial share ?alike
4 | cc-by-nc-nd | creative commons attribution | creative commons attribution non ?commercial no ?deriv(?:s|atives|ative works)
4 | creative-commons | creative commons | creative commons(?: licen[cs]e)?
4 | public-domain | public domain | (?:in|into|to) the public domain
4 | public-domain | domaine public | domaine public
4 | public-domain | dominio p | dominio p[^ ]{1,3}blico
4 | public-domain | gemeinfrei | gemeinfrei(?:e|es|er|en)?
5 | cc-by | creativecommons org | creativecommons org licenses by(?: [0-9] [0-9])?
5 | cc-by-sa | creativecommons org | creativecommons org licenses by sa(?: [0-9] [0-9])?
5 | cc-by-nc | creativecommons org | creativecommons org licenses by nc(?: [0-9] [0-9])?
5 | cc-by-nd | creativecommons org | creativecommons org licenses by nd(?: [0-9] [0-9])?
5 | cc-by-nc-sa | creativecommons org | creativecommons org licenses by nc sa(?: [0-9] [0-9])?
5 | cc-by-nc-nd | creativecommons org | creativecommons org licenses by nc nd(?: [0-9] [0-9])?
5 | cc0 | creativecommons org | creativecommons org publicdomain zero(?: 1 0)?
5 | apache-2.0 | apache org licenses | apache org licenses licen[cs]e 2 0
5 | gpl | gnu org licenses | gnu org licenses gpl(?: [0-9] [0-9])?
5 | lgpl | gnu org licenses | gnu org licenses lgpl(?: [0-9] [0-9])?
5 | agpl | gnu org licenses | gnu org licenses agpl(?: [0-9] [0-9])?
5 | mit | opensource org licenses | opensource org licenses mit(?: license)?
5 | bsd | opensource org licenses | opensource org licenses bsd(?: [0-9] clause| license)?
5 | mpl | mozilla org mpl | mozilla org mpl(?: [0-9] [0-9])?
5 | license-file | license | see (?:the )?(?:accompanying )?(?:file )?(?:license|licence|copying)(?: (?:file|txt|md))? for (?:details|more information|the full text|licensing)
5 | license-file | license | (?:full|complete) license text
6 | no-commercial | commercial | (?:not for|no|non) commercial use(?: only)?
6 | no-commercial | noncommercial | (?:for )?noncommercial (?:use|purposes)(?: only)?
6 | no-commercial | commerciale | usage non commercial(?:e)?|utilisation commerciale interdite
6 | no-commercial | comercial | (?:prohibido (?:el|su) )?uso (?:no )?comercial
6 | no-redistribution | redistribut | (?:may|must|do|can) not be? ?(?:copied or )?(?:redistributed|redistribute)
6 | no-redistribution | do not distribute | do not distribute(?: or copy)?
6 | no-reproduction | reproduced | (?:may not|must not|cannot|can not) be reproduced(?: ~ without ~ (?:permission|consent))?
6 | no-reproduction | reproduction | (?:any )?(?:unauthorized|unauthorised) reproduction ~ prohibited
6 | no-reproduction | reproduction | reproduction (?:m[^ ]{1,3}me partielle )?(?:interdite|prohibida|verboten)
6 | no-training | training | (?:may not|must not|shall not|not) be used (?:for|to) (?:train|the training of|training)(?: \S+){0,4}
6 | no-mining | data mining | no (?:text and )?data mining|(?:text and )?data mining (?:is )?(?:reserved|prohibited)
6 | no-derivatives | derivative works | (?:no|may not create) derivative works
6 | permission-required | permission | without (?:the )?(?:express |prior |prior written |express written |written )+(?:permission|consent)
6 | permission-required | permission | (?:reprinted|reproduced|used) (?:with|by) permission
6 | personal-use | personal use | for personal use only
6 | internal-use | internal use | (?:for )?internal use only
6 | evaluation-only | evaluation | for evaluation (?:purposes )?only
6 | educational-use | educational | for educational (?:use|purposes)(?: only)?
6 | proprietary | proprietary | proprietary (?:and confidential|information|licen[cs]e|software)
6 | confidential | confidential | (?:strictly |company |highly )?confidential(?: and proprietary| information)
6 | trade-secret | trade secret | trade secrets? of
6 | subscribers | subscribers | for subscribers only
6 | eula | end user license | end user licen[cs]e agreement
6 | free-use | free to use | free to use(?: share| copy| modify| distribute)+
6 | share-alike | same license | (?:under|by) (?:the )?same license
7 | reserved | rights reserved | (?:all|some|no) rights reserved
7 | reserved | rechte vorbehalten | alle rechte vorbehalten
7 | reserved | tous droits | tous droits r[^ ]{1,3}serv[^ ]{1,3}s
7 | reserved | derechos reservados | todos los derechos reservados
7 | copyright | copyright | (?:copyright )?(?:c |\xc2\xa9 )?copyright(?: c| \xc2\xa9)?(?: by)? (?:19|20)[0-9]{2}(?: (?:19|20)?[0-9]{2})*
7 | copyright | copyright | copyright (?:c )?(?:by )?(?:the )?[a-z]\S* (?:inc|ltd|llc|gmbh|foundation|corporation|authors|contributors)
7 | copyright | \xc2\xa9 | \xc2\xa9 ?(?:copyright )?(?:19|20)[0-9]{2}
7 | copyright | droits d auteur | droits d auteur
7 | copyright | derechos de autor | derechos de autor
7 | copyright | urheberrecht | urheberrechtlich gesch[^ ]{1,3}tzt
7 | trademark | trademark | (?:is a|are|are the|registered) (?:registered )?trademarks?(?: of)?
7 | patent | patent | patents? pending
7 | licensed | licensed under | (?:is |are )?licensed under(?: the(?: terms of)?)?
7 | licensed | licence | sous licence
7 | licensed | lizenz | (?:unter|lizenziert unter) der \S+ lizenz
7 | licensed | licencia | bajo (?:la )?licencia
7 | open-source | open source license | open source licen[cs]e
7 | terms-of-use | terms of | (?:subject to|see|read|accept) (?:our|the) terms of (?:use|service)
7 | disclaimer | as is | provided as is without warranty
7 | fair-use | fair use | (?:under|constitutes|as) fair use
"""


@dataclass(frozen=True)
class Rule:
    order: int
    priority: int
    label: str
    keyword: bytes
    pattern: re.Pattern[bytes]


def _version(v: str) -> str:
    words = v.split(".")
    return "(?:%s)(?: 0)?" % words[0] if words[1:] == ["0"] else " ".join(words)


def rules(text: str = RULES_TEXT) -> list[Rule]:
    """The rules of a rule text, in its order."""
    out: list[Rule] = []
    for line in text.strip().splitlines():
        priority, label, keyword, pattern, *versions = [p.strip() for p in line.split(" | ")]
        for v in versions[0].split() if versions else [None]:
            own = pattern if v is None else pattern.replace("{v}", _version(v))
            own = own.replace(" ~", r"(?: \S+){0,3}")
            literal = keyword.encode().decode("unicode_escape").encode("latin-1") if "\\x" in keyword else keyword.encode()
            out.append(Rule(len(out), int(priority), label if v is None else label.replace("{v}", v), literal,
                            re.compile(rb"(?<= )(?:" + own.encode() + rb")(?= )")))
    return out
