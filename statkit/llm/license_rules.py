"""Licence signatures, written over normalised words (lower case, one space between words, no punctuation).

Fixed values, a line per licence: label; keyword that any text of the licence's title has; title regexes (tried in this
order, separated by " || "); the words of its SPDX identifier; the words of its canonical address (may be empty).
"""

from __future__ import annotations

LICENCES = r"""
agpl-3.0; affero; gnu affero general public license(?: as published by the free software foundation)?(?: either)?(?: version)? v?3(?: 0)? || affero general public license || gnu agpl(?: ?v?3)?; agpl 3 0(?: only| or later)?; gnu org licenses agpl 3 0
gpl-3.0; general public; gnu general public license(?: as published by the free software foundation)?(?: either)?(?: version)? v?3(?: 0)?(?: or(?: any)? later)? || gnu gpl ?v?3 || gplv3; gpl 3 0(?: only| or later)?; gnu org licenses gpl 3 0
gpl-2.0; general public; gnu general public license(?: as published by the free software foundation)?(?: either)?(?: version)? v?2(?: 0)?(?: or(?: any)? later)? || gnu gpl ?v?2 || gplv2; gpl 2 0(?: only| or later)?; gnu org licenses(?: old licenses)? gpl 2 0
gpl-1.0; general public; gnu general public license(?: version)? v?1(?: 0)?(?: or(?: any)? later)?; gpl 1 0(?: only| or later)?; gnu org licenses old licenses gpl 1 0
lgpl-3.0; lesser; gnu lesser general public license(?: as published by the free software foundation)?(?: either)?(?: version)? v?3(?: 0)? || lgplv3; lgpl 3 0(?: only| or later)?; gnu org licenses lgpl 3 0
lgpl-2.1; lesser; gnu lesser general public license(?: as published by the free software foundation)?(?: either)?(?: version)? v?2 1 || gnu lesser general public license; lgpl 2 1(?: only| or later)?; gnu org licenses(?: old licenses)? lgpl 2 1
lgpl-2.0; library general; gnu library general public license(?: version)?(?: v?2(?: 0)?)?; lgpl 2 0(?: only| or later)?; gnu org licenses old licenses lgpl 2 0
gfdl-1.3; free documentation; gnu free documentation license(?: version)? 1 3; gfdl 1 3(?: only| or later)?; gnu org licenses fdl 1 3
gfdl-1.2; free documentation; gnu free documentation license(?: version)? 1 2 || gnu free documentation license; gfdl 1 2(?: only| or later)?; gnu org licenses(?: old licenses)? fdl 1 2
apache-2.0; apache; (?:the )?apache license version 2(?: 0)? || apache license 2(?: 0)? || apache 2 0 license || apache software license version 2(?: 0)?; apache 2 0; apache org licenses license 2 0
apache-1.1; apache; apache (?:software )?license(?: version)? 1 1; apache 1 1; apache org licenses license 1 1
apache-1.0; apache; apache (?:software )?license(?: version)? 1 0; apache 1 0; apache org licenses license 1 0
mit; mit; (?:released|licensed|distributed) under the(?: terms of the)? mit license || the mit license(?: mit)? || mit licence || expat license; mit; opensource org licenses? mit
mit-0; mit; mit no attribution(?: license)?; mit 0; github com aws mit 0
x11; x11; (?:the )?x11 license || mit x11 license; x11; xfree86 org 3 3 6 copyright2
isc; isc; (?:the )?isc license || internet systems consortium license; isc; opensource org licenses? isc
bsd-0-clause; bsd; (?:bsd )?zero clause bsd(?: license)? || 0 ?bsd license || bsd zero clause license; 0bsd; opensource org licenses? 0bsd
bsd-2-clause; bsd; (?:bsd )?2 clause bsd license || bsd 2 clause(?: license)? || simplified bsd license || freebsd license; bsd 2 clause; opensource org licenses? bsd 2 clause
bsd-3-clause; bsd; (?:bsd )?3 clause bsd license || bsd 3 clause(?: license)? || (?:new|modified|revised) bsd license; bsd 3 clause; opensource org licenses? bsd 3 clause
bsd-4-clause; bsd; bsd 4 clause(?: license)? || original bsd license; bsd 4 clause; 
bsd; bsd; (?:the )?bsd licen[sc]e || bsd style license; bsd source code; 
mpl-2.0; mozilla; mozilla public license(?: version)? v?2(?: 0)? || mpl 2 0; mpl 2 0; mozilla org mpl 2 0
mpl-1.1; mozilla; mozilla public license(?: version)? v?1 1; mpl 1 1; mozilla org mpl 1 1
mpl-1.0; mozilla; mozilla public license(?: version)? v?1 0 || mozilla public license; mpl 1 0; mozilla org mpl 1 0
epl-2.0; eclipse; eclipse public license(?: version)? v?2(?: 0)?; epl 2 0; eclipse org legal epl 2 0
epl-1.0; eclipse; eclipse public license(?: version)? v?1(?: 0)? || eclipse public license; epl 1 0; eclipse org legal epl v10
edl-1.0; eclipse; eclipse distribution license(?: version)?(?: v?1(?: 0)?)?; edl 1 0; eclipse org org documents edl v10
cddl-1.1; common development; common development and distribution license(?: version)? 1 1; cddl 1 1; glassfish java net public cddl
cddl-1.0; common development; common development and distribution license(?: version)?(?: 1 0)?; cddl 1 0; opensource org licenses? cddl ?1(?: 0)?
cpl-1.0; common public; common public license(?: version)?(?: 1 0)?; cpl 1 0; opensource org licenses? cpl1 0
ipl-1.0; ibm; ibm public license(?: version)?(?: 1 0)?; ipl 1 0; opensource org licenses? ibmpl
eupl-1.2; european union; european union public licen[sc]e(?: version| v)? ?1 2 || eupl ?v?1 2; eupl 1 2; joinup ec europa eu(?: [0-9a-z]+)* eupl
eupl-1.1; european union; european union public licen[sc]e(?: version| v)? ?1 1 || european union public licen[sc]e; eupl 1 1; 
cecill-2.1; cecill; cecill(?: free software license agreement)?(?: version)? 2 1 || licence cecill; cecill 2 1; cecill info licences
cecill-b; cecill; cecill b(?: license| licence)?; cecill b; 
cecill-c; cecill; cecill c(?: license| licence)?; cecill c; 
artistic-2.0; artistic; artistic license(?: version)? 2 0 || perl foundation artistic license; artistic 2 0; opensource org licenses? artistic license 2 0
artistic-1.0; artistic; artistic license(?: version)? 1 0 || (?:the )?artistic license || same terms as perl itself; artistic 1 0(?: perl| cl8)?; dev perl org licenses artistic
zlib; zlib; (?:the )?zlib license || zlib libpng license; zlib; zlib net zlib license
libpng; libpng; (?:the )?libpng license || png reference library license; libpng(?: 2 0)?; libpng org pub png src libpng license
bsl-1.0; boost; boost software license(?: version)?(?: 1 0)?; bsl 1 0; boost org license 1 0
unlicense; unlicense; (?:the )?unlicense || released into the public domain under the unlicense; unlicense; unlicense org
wtfpl; public license; do what the fuck you want to public license || wtfpl; wtfpl; wtfpl net
python-2.0; python; python software foundation license(?: version)?(?: 2)? || psf license agreement; (?:psf|python) 2 0; docs python org 3 license
php-3.01; php; php license(?: version)?(?: 3 01| 3 0)?; php 3 0?1; php net license
ruby; ruby; (?:the )?ruby license || same terms as ruby itself; ruby; ruby lang org(?: [a-z]+)? license
postgresql; postgresql; (?:the )?postgresql license; postgresql; postgresql org about licen[sc]e
openssl; openssl; (?:the )?openssl license || openssl ssleay license; openssl; openssl org source license
ncsa; illinois; university of illinois(?: ncsa)? open source license || ncsa open source license; ncsa; otm illinois edu uiuc opensource
osl-3.0; open software; open software license(?: version| v)? ?3 0; osl 3 0; opensource org licenses? osl 3 0
afl-3.0; academic free; academic free license(?: version| v)? ?3 0 || academic free license; afl 3 0; opensource org licenses? afl 3 0
ms-pl; microsoft; microsoft public license; ms pl; opensource org licenses? ms pl
ms-rl; microsoft; microsoft reciprocal license; ms rl; opensource org licenses? ms rl
odbl-1.0; database; (?:odc )?open database license(?: odbl)?(?: v?1 0)?; odbl 1 0; opendatacommons org licenses odbl
odc-by-1.0; attribution; open data commons attribution license(?: v?1 0)?; odc by 1 0; opendatacommons org licenses by
pddl-1.0; public domain; (?:odc )?public domain dedication and licen[sc]e(?: v?1 0)?; pddl 1 0; opendatacommons org licenses pddl
ofl-1.1; font; sil open font license(?: version)?(?: 1 1)? || open font license; ofl 1 1; scripts sil org ofl
lppl-1.3c; latex; latex project public license(?: version)?(?: 1 3c?)?; lppl 1 3c; latex project org lppl
qpl-1.0; public license; q public license(?: version)?(?: 1 0)?; qpl 1 0; 
sleepycat; sleepycat; (?:the )?sleepycat license; sleepycat; 
vim; vim; (?:the )?vim license; vim; vimdoc sourceforge net htmldoc uganda
w3c; w3c; w3c software(?: notice)?(?: and)?(?: document)? license; w3c; w3 org consortium legal copyright software
upl-1.0; universal; universal permissive license(?: version)?(?: v?1 0)?; upl 1 0; oss oracle com licenses upl
sspl-1.0; server side; server side public license(?: version| v)? ?1? || sspl; sspl 1 0; mongodb com licensing server side public license
busl-1.1; business source; business source license(?: version)?(?: 1 1)?; busl 1 1; mariadb com bsl11
elastic-2.0; elastic; elastic license(?: version)?(?: v?2(?: 0)?)?; elastic 2 0; elastic co licensing elastic license
cc0-1.0; cc0; cc0 1 0(?: universal)? || creative commons zero(?: v?1 0)?(?: universal)? || cc0; cc0 1 0; creativecommons org publicdomain zero 1 0
cc-by-4.0; by; cc by 4 0 || creative commons attribution 4 0(?: international)?(?: license| licence)?; cc by 4 0; creativecommons org licenses by 4 0
cc-by-3.0; by; cc by 3 0 || creative commons attribution 3 0(?: unported)?(?: license| licence)?; cc by 3 0; creativecommons org licenses by 3 0
cc-by-sa-4.0; sa; cc by sa 4 0 || creative commons attribution share ?alike 4 0(?: international)?; cc by sa 4 0; creativecommons org licenses by sa 4 0
cc-by-sa-3.0; sa; cc by sa 3 0 || creative commons attribution share ?alike 3 0(?: unported)? || cc by sa; cc by sa 3 0; creativecommons org licenses by sa 3 0
cc-by-nc-4.0; nc; cc by nc 4 0; cc by nc 4 0; creativecommons org licenses by nc 4 0
cc-by-nc; nc; cc by nc || creative commons attribution non ?commercial; cc by nc 3 0; creativecommons org licenses by nc 3 0
cc-by-nc-sa; nc sa; cc by nc sa(?: [34] 0)?; cc by nc sa [34] 0; creativecommons org licenses by nc sa [34] 0
cc-by-nc-nd; nc nd; cc by nc nd(?: [34] 0)?; cc by nc nd [34] 0; creativecommons org licenses by nc nd [34] 0
cc-by-nd; nd; cc by nd(?: [34] 0)?; cc by nd [34] 0; creativecommons org licenses by nd [34] 0
proprietary; rights reserved; all rights reserved || alle rechte vorbehalten || tous droits reserves || todos los derechos reservados || reserved rights of the author; licenseref proprietary; 
commercial; commercial; (?:under|for) (?:a|the) commercial licen[sc]e || licensed for non commercial use only || proprietary and confidential; licenseref commercial; 
public-domain; public domain; (?:is|are|placed|released|dedicated) (?:in|into|to) the public domain || public domain mark 1 0 || no known copyright restrictions; licenseref public domain; creativecommons org publicdomain mark 1 0
copyleft; copyleft; copyleft(?: license)?; licenseref copyleft; 
copyright; copyright; copyright (?:c )?(?:19|20)[0-9][0-9](?: (?:19|20)[0-9][0-9])?; licenseref copyright; 
"""

#: Base signatures: label, words. Their labels always stay.
BASE = (("gpl", "gnu general public license"), ("apache", "apache license"), ("cc-by", "cc by"), ("mit", "mit license"))

#: Rank and confidence of a kind of rule: a containing detection of the same or a smaller rank suppresses.
TAG, ADDRESS, TITLE, FAMILY = 1, 2, 3, 4
CONFIDENCE = {TAG: 0.98, ADDRESS: 0.9, TITLE: 0.8, FAMILY: 0.6}


def rules() -> list[tuple[str, str, str, int, bool]]:
    """All rules in order: (keyword, regex, label, rank, whether it is a base rule)."""
    tags, addresses, titles = [], [], []
    for line in filter(None, map(str.strip, LICENCES.strip().split("\n"))):
        label, keyword, title, tag, address = (x.strip() for x in f"{line} ".split(";"))
        tags.append(("spdx", f"spdx license identifier {tag}", label, TAG, False))
        if address:
            addresses.append((address.split(" ", 1)[0], f"(?:https? )?(?:www )?{address}", label, ADDRESS, False))
        for part in map(str.strip, title.split("||")):
            first = part.split(" ", 1)[0]
            titles.append((keyword if keyword in part else first if first.isalnum() else "", part, label, TITLE, False))
    return [*tags, *addresses, *titles, *((words.split()[-1], words, label, FAMILY, True) for label, words in BASE)]
