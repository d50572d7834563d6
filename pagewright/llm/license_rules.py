"""Signature rules for licences, in order: label, priority, keyword, regular expression.

They are matched against lowered words with single spaces between them, so "Apache-2.0" reads
"apache 2 0". A match always holds its rule's keyword as whole words. The higher priority wins;
full grants and headers come before names, names before short forms. Written by hand.
"""

RULES = r"""
mit | 98 | permission is hereby granted | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit | 96 | sublicense | to use copy modify merge publish distribute sublicense and or sell copies of the software
mit | 90 | mit license | (?:released|licensed|distributed|available|provided|published|covered)(?: \S+){0,3} under (?:the )?(?:terms of the )?mit license
mit | 85 | mit license | the mit license(?: mit)?
mit | 84 | mit | spdx license identifier mit(?! 0)
mit | 82 | mit | mit licensed?
mit | 80 | mit licence | mit licence
mit | 78 | licenses mit | opensource org licenses mit
mit | 70 | mit | licen[sc]e mit\b
mit-0 | 95 | mit | (?:spdx license identifier )?mit 0
mit-0 | 96 | mit no attribution | mit no attribution(?: license)?
x11 | 92 | x consortium | (?:except as contained in this notice )?the names? of the x consortium shall not be used
x11 | 80 | x11 | (?:mit )?x11 licen[sc]e
x11 | 80 | x11 | spdx license identifier x11
apache-1.1 | 94 | apache software | apache software licen[sc]e version 1 1
apache-1.1 | 90 | apache | spdx license identifier apache 1 1
apache-1.0 | 90 | apache | (?:apache licen[sc]e (?:version )?|spdx license identifier apache )1 0
apache-2.0 | 98 | apache license | licensed under the apache license version 2 0 the license you may not use this (?:file|work|software) except in compliance
apache-2.0 | 96 | apache license | terms and conditions for use reproduction and distribution(?: \S+){0,40} apache license
apache-2.0 | 94 | apache license | apache license version 2 0
apache-2.0 | 92 | apache license | apache license v?2(?: 0)?
apache-2.0 | 92 | apache | spdx license identifier apache 2 0
apache-2.0 | 90 | apache org licenses | (?:www )?apache org licenses license 2 0
apache-2.0 | 88 | apache licence | apache licence(?: version)? 2(?: 0)?
apache-2.0 | 86 | apache | apache (?:software )?(?:license )?(?:v|version )2(?: 0)?
apache-2.0 | 80 | apache | apache 2 0
apache | 60 | apache license | (?:the )?apache license
apache | 58 | apache software license | apache software license
bsd-2-clause | 95 | bsd | spdx license identifier bsd 2 clause
bsd-2-clause | 90 | bsd | bsd 2 clause(?: simplified)?(?: licen[sc]e)?
bsd-2-clause | 90 | simplified bsd | simplified bsd licen[sc]e
bsd-2-clause | 88 | freebsd license | freebsd license
bsd-2-clause | 88 | bsd | (?:2|two) clause bsd(?: licen[sc]e)?
bsd-3-clause | 98 | endorse or promote | neither the names? of(?: \S+){1,12} may be used to endorse or promote products derived from this software without specific prior written permission
bsd-3-clause | 95 | bsd | spdx license identifier bsd 3 clause
bsd-3-clause | 90 | bsd | bsd 3 clause(?: new| revised)?(?: licen[sc]e)?
bsd-3-clause | 90 | bsd | (?:3|three) clause bsd(?: licen[sc]e)?
bsd-3-clause | 88 | new bsd | new bsd licen[sc]e
bsd-3-clause | 88 | modified bsd | modified bsd licen[sc]e
bsd-3-clause | 88 | revised bsd | revised bsd licen[sc]e
bsd-4-clause | 97 | advertising materials | all advertising materials mentioning features or use of this software must display the following acknowledge?ment
bsd-4-clause | 95 | bsd | spdx license identifier bsd 4 clause
bsd-4-clause | 90 | bsd | (?:bsd 4 clause|(?:4|four) clause bsd|original bsd)(?: licen[sc]e)?
bsd-0-clause | 95 | 0bsd | (?:spdx license identifier )?0bsd
bsd-0-clause | 92 | bsd | (?:zero clause bsd|bsd zero clause)(?: licen[sc]e)?
bsd | 75 | redistribution and use | redistribution and use in source and binary forms with or without modification are permitted
bsd | 74 | redistributions of source code | redistributions of source code must retain the above copyright notice
bsd | 73 | redistributions in binary form | redistributions in binary form must reproduce the above copyright notice
bsd | 65 | bsd | (?:the |a )?bsd(?: style)? license
bsd | 65 | bsd | bsd(?: style)? licence
bsd | 62 | bsd style | bsd style
gpl-1 | 95 | gnu general public license | gnu general public license(?: as published by the free software foundation)?(?: either)? version 1
gpl-1 | 94 | gpl | spdx license identifier gpl 1 0(?: only| or later)?
gpl-2 | 98 | gnu general public license | gnu general public license as published by the free software foundation(?: either)? version 2
gpl-2 | 95 | gnu general public license | gnu general public license (?:v|version )?2(?: 0)?
gpl-2 | 95 | gpl | spdx license identifier gpl 2 0(?: only| or later)?
gpl-2 | 90 | gpl | gnu gpl (?:v|version )?2(?: 0)?
gpl-2 | 86 | gplv2 | gplv2
gpl-2 | 84 | gpl | gpl (?:v|version )?2(?: 0)?
gpl-2 | 84 | gpl2 | gpl2
gpl-3 | 98 | gnu general public license | gnu general public license as published by the free software foundation(?: either)? version 3
gpl-3 | 95 | gnu general public license | gnu general public license (?:v|version )?3(?: 0)?
gpl-3 | 95 | gpl | spdx license identifier gpl 3 0(?: only| or later)?
gpl-3 | 90 | gpl | gnu gpl (?:v|version )?3(?: 0)?
gpl-3 | 86 | gplv3 | gplv3
gpl-3 | 84 | gpl | gpl (?:v|version )?3(?: 0)?
gpl-3 | 84 | gpl3 | gpl3
gpl | 70 | gnu general public license | gnu general public license
gpl | 69 | gnu general public licence | gnu general public licence
gpl | 68 | gnu org licenses | gnu org licenses gpl(?: html| txt)?
gpl | 66 | gnu gpl | gnu gpl
gpl | 60 | gpl | (?:under|licen[sc]ed?|the) (?:the )?gpl
gpl | 55 | free software foundation | published by the free software foundation
lgpl-2 | 96 | gnu library general public license | gnu library general public license(?: as published by the free software foundation)?(?: either)?(?: version 2(?: 0)?)?
lgpl-2 | 95 | lgpl | spdx license identifier lgpl 2 0(?: only| or later)?
lgpl-2.1 | 98 | gnu lesser general public license | gnu lesser general public license(?: as published by the free software foundation)?(?: either)? version 2 1
lgpl-2.1 | 96 | gnu lesser general public license | gnu lesser general public license v?2 1
lgpl-2.1 | 95 | lgpl | (?:spdx license identifier )?lgpl (?:v|version )?2 1(?: only| or later)?
lgpl-2.1 | 90 | lgplv2 | lgplv2(?: 1)?
lgpl-3 | 98 | gnu lesser general public license | gnu lesser general public license(?: as published by the free software foundation)?(?: either)? (?:version |v)?3
lgpl-3 | 95 | lgpl | (?:spdx license identifier )?lgpl (?:v|version )?3(?: 0)?(?: only| or later)?
lgpl-3 | 90 | lgplv3 | lgplv3
lgpl | 75 | gnu lesser general public license | gnu lesser general public license
lgpl | 74 | gnu org licenses | gnu org licenses (?:old licenses )?lgpl
lgpl | 65 | lgpl | (?:gnu )?lgpl
agpl-3 | 98 | gnu affero general public license | gnu affero general public license(?: as published by the free software foundation)?(?: either)? (?:version |v)?3
agpl-3 | 95 | agpl | (?:spdx license identifier )?agpl (?:v|version )?3(?: 0)?(?: only| or later)?
agpl-3 | 90 | agplv3 | agplv3
agpl-3 | 88 | gnu org licenses | gnu org licenses agpl 3 0
agpl | 76 | affero general public license | (?:gnu )?affero general public license
agpl | 66 | agpl | (?:gnu )?agpl
gfdl-1.2 | 94 | gnu free documentation license | gnu free documentation license version 1 2
gfdl-1.3 | 94 | gnu free documentation license | gnu free documentation license version 1 3
gfdl | 80 | gnu free documentation license | gnu free documentation license
gfdl | 70 | gfdl | gfdl(?: 1 [123])?
mpl-1.1 | 96 | mozilla public license | mozilla public license(?: version| v)? 1 1
mpl-1.1 | 92 | mpl | mpl (?:v|version )?1 1
mpl-2.0 | 98 | mozilla public license | this source code form is subject to the terms of the mozilla public license v 2 0
mpl-2.0 | 96 | mozilla public license | mozilla public license(?: version| v)? 2 0
mpl-2.0 | 92 | mpl | (?:spdx license identifier )?mpl (?:v|version )?2 0
mpl-2.0 | 92 | mozilla org mpl | mozilla org mpl 2 0
mpl | 70 | mozilla public license | mozilla public license
mpl | 68 | mozilla org mpl | mozilla org mpl
epl-1.0 | 95 | eclipse public license | eclipse public license(?: version| v)? 1 0
epl-1.0 | 92 | epl | (?:spdx license identifier )?epl (?:v|version )?1 0
epl-2.0 | 95 | eclipse public license | eclipse public license(?: version| v)? 2 0
epl-2.0 | 92 | epl | (?:spdx license identifier )?epl (?:v|version )?2 0
epl | 75 | eclipse public license | eclipse public license
epl | 70 | eclipse org legal | eclipse org legal epl
edl-1.0 | 92 | eclipse distribution license | eclipse distribution license(?: version| v)?(?: 1 0)?
cddl-1.0 | 95 | common development and distribution license | common development and distribution license(?: cddl)?(?: version)?(?: 1 0)?
cddl-1.1 | 96 | common development and distribution license | common development and distribution license(?: cddl)? version 1 1
cddl | 80 | cddl | cddl(?: 1 [01])?
cpl-1.0 | 92 | common public license | common public license(?: version| v)?(?: 1 0)?
ipl-1.0 | 92 | ibm public license | ibm public license(?: version| v)?(?: 1 0)?
eupl-1.1 | 95 | european union public licence | european union public licence(?: version| v)? 1 1
eupl-1.2 | 95 | european union public licence | european union public licence(?: version| v)? 1 2
eupl | 80 | european union public licence | european union public licence
eupl | 75 | eupl | eupl(?: v)?(?: 1 [012])?
isc | 97 | permission to use copy modify and or distribute | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
isc | 88 | isc license | (?:the )?isc license
isc | 86 | isc | spdx license identifier isc
zlib | 96 | origin of this software | the origin of this software must not be misrepresented you must not claim that you wrote the original software
zlib | 90 | as is without any express or implied warranty | this software is provided as is without any express or implied warranty in no event will the authors be held liable
zlib | 85 | zlib | (?:the )?zlib(?: libpng)? licen[sc]e
zlib | 84 | zlib | spdx license identifier zlib
libpng | 85 | libpng | (?:the )?libpng licen[sc]e
boost-1.0 | 96 | boost software license | (?:distributed under the )?boost software license(?: version| v)? 1 0
boost-1.0 | 90 | bsl | spdx license identifier bsl 1 0
boost-1.0 | 88 | boost org license | boost org license 1 0(?: txt)?
boost-1.0 | 75 | boost software license | boost software license
unlicense | 97 | unencumbered software | this is free and unencumbered software released into the public domain
unlicense | 88 | unlicense | (?:the )?unlicense
unlicense | 86 | unlicense org | unlicense org
wtfpl | 95 | what the fuck you want | do what the fuck you want to public license
wtfpl | 88 | wtfpl | wtfpl
cc0-1.0 | 96 | cc0 | cc0 1 0 universal
cc0-1.0 | 94 | publicdomain zero | creativecommons org publicdomain zero 1 0
cc0-1.0 | 92 | cc0 | (?:spdx license identifier )?cc0(?: 1 0)?
cc0-1.0 | 90 | creative commons zero | creative commons zero(?: v| version)?(?: 1 0)?
public-domain | 80 | public domain | (?:released|placed|dedicated|put|is)(?: \S+){0,3} (?:in|into|to) the public domain
public-domain | 78 | publicdomain mark | creativecommons org publicdomain mark 1 0
public-domain | 60 | public domain | public domain
pddl-1.0 | 90 | public domain dedication and license | (?:open data commons )?public domain dedication and license
cc-by-nc-nd | 97 | by nc nd | creativecommons org licenses by nc nd \d(?: \d)?
cc-by-nc-nd | 95 | nc nd | cc by nc nd(?: \d \d)?
cc-by-nc-nd | 95 | noncommercial | (?:creative commons )?attribution noncommercial no ?deriv\w*(?: \d \d)?
cc-by-nc-nd | 94 | noderivatives | (?:creative commons )?attribution non ?commercial noderivatives(?: \d \d)?
cc-by-nc-sa | 97 | by nc sa | creativecommons org licenses by nc sa \d(?: \d)?
cc-by-nc-sa | 95 | nc sa | cc by nc sa(?: \d \d)?
cc-by-nc-sa | 95 | sharealike | (?:creative commons )?attribution non ?commercial sharealike(?: \d \d)?
cc-by-nc | 96 | by nc | creativecommons org licenses by nc \d(?: \d)?
cc-by-nc | 92 | by nc | cc by nc(?: \d \d)?
cc-by-nc | 92 | noncommercial | (?:creative commons )?attribution noncommercial(?: \d \d)?(?: international)?
cc-by-nc | 91 | non commercial | creative commons attribution non commercial(?: \d \d)?
cc-by-nd | 97 | by nd | creativecommons org licenses by nd \d(?: \d)?
cc-by-nd | 94 | by nd | cc by nd(?: \d \d)?
cc-by-nd | 94 | noderivatives | (?:creative commons )?attribution noderivatives(?: \d \d)?
cc-by-sa | 97 | by sa | creativecommons org licenses by sa \d(?: \d)?
cc-by-sa | 94 | by sa | cc by sa(?: \d \d)?
cc-by-sa | 94 | sharealike | (?:creative commons )?attribution sharealike(?: \d \d)?
cc-by-sa | 92 | share alike | creative commons attribution share alike(?: \d \d)?
cc-by | 90 | licenses by | creativecommons org licenses by \d(?: \d)?
cc-by | 88 | creative commons attribution | creative commons attribution(?: \d \d)?(?: international| unported| generic)?(?: licen[sc]e)?
cc-by | 86 | cc by | cc by(?: \d \d)?
cc | 60 | creative commons license | (?:a |the )?creative commons license
cc | 58 | creative commons licence | (?:a |the )?creative commons licence
cc | 55 | creativecommons org licenses | creativecommons org licenses
odbl-1.0 | 92 | open database license | (?:open data commons )?open database license(?: v| version)?(?: 1 0)?
odbl-1.0 | 85 | odbl | odbl(?: 1 0)?
odc-by-1.0 | 92 | open data commons attribution license | open data commons attribution license(?: v| version)?(?: 1 0)?
odc-by-1.0 | 85 | odc by | odc by(?: 1 0)?
ogl-uk | 90 | open government licence | open government licence(?: v| version)?(?: \d(?: \d)?)?
etalab-2.0 | 88 | licence ouverte | licence ouverte(?: open licence)?(?: v| version)?(?: 2 0)?
dl-de-by | 88 | datenlizenz deutschland | datenlizenz deutschland namensnennung(?: version)?(?: \d \d)?
dl-de-zero | 88 | datenlizenz deutschland | datenlizenz deutschland zero(?: version)?(?: \d \d)?
artistic-1.0 | 92 | artistic license | (?:the )?artistic license(?: version)? 1 0
artistic-2.0 | 94 | artistic license | (?:the )?artistic license(?: version)? 2 0
artistic-2.0 | 90 | artistic | spdx license identifier artistic 2 0
artistic | 75 | artistic license | (?:the )?(?:perl )?artistic license
perl | 92 | same terms as perl | under the same terms as perl(?: itself)?
afl-3.0 | 90 | academic free license | academic free license(?: version| v)?(?: \d \d)?
osl-3.0 | 90 | open software license | open software license(?: version| v)?(?: \d \d)?
ms-pl | 90 | microsoft public license | microsoft public license(?: ms pl)?
ms-pl | 84 | ms pl | (?:spdx license identifier )?ms pl
ms-rl | 90 | microsoft reciprocal license | microsoft reciprocal license(?: ms rl)?
ms-rl | 84 | ms rl | (?:spdx license identifier )?ms rl
ncsa | 90 | ncsa | (?:university of illinois )?(?:ncsa )?(?:university of illinois )?ncsa open source license
ncsa | 84 | ncsa | spdx license identifier ncsa
upl-1.0 | 92 | universal permissive license | universal permissive license(?: version| v)?(?: 1 0)?
python-2.0 | 92 | python software foundation license | python software foundation license(?: version)?(?: 2)?
python-2.0 | 88 | psf license | psf license(?: agreement)?
php-3.01 | 90 | php license | (?:the )?php license(?: version)?(?: 3 01?)?
ruby | 86 | ruby license | (?:the )?ruby license
ruby | 85 | same terms as ruby | under the same terms as ruby
postgresql | 90 | postgresql license | (?:the )?postgresql license
curl | 86 | curl license | (?:the )?curl license
openssl | 90 | openssl license | (?:the )?openssl license
openssl | 88 | openssl toolkit | developed by the openssl project for use in the openssl toolkit
vim | 86 | vim license | (?:the )?vim license
w3c | 90 | w3c software | w3c software(?: and document)?(?: notice)?(?: and)? licen[sc]e
ofl-1.1 | 95 | sil open font license | (?:licensed under the )?sil open font license(?: version)?(?: 1 1)?
ofl-1.1 | 88 | ofl | (?:spdx license identifier )?ofl 1 1
ofl-1.1 | 86 | scripts sil org | scripts sil org ofl
lppl | 90 | latex project public license | latex project public license(?: version| v)?(?: 1 \d\w?)?
lppl | 84 | lppl | lppl(?: 1 \d\w?)?
qpl | 88 | q public license | (?:the )?q public license(?: version)?(?: 1 0)?
sleepycat | 86 | sleepycat license | (?:the )?sleepycat license
json | 95 | for good not evil | the software shall be used for good not evil
beerware | 92 | beer ware license | (?:the )?beer ware license
beerware | 88 | buy me a beer | you can buy me a beer in return
sspl-1.0 | 95 | server side public license | server side public license(?: version| v)?(?: 1)?
sspl-1.0 | 86 | sspl | sspl(?: 1 0)?
busl-1.1 | 95 | business source license | business source license(?: version| v)?(?: 1 1)?
busl-1.1 | 86 | busl | busl 1 1
elastic-2.0 | 92 | elastic license | elastic license(?: version| v)?(?: 2 0)?
commons-clause | 92 | commons clause | commons clause(?: license condition)?(?: v1 0)?
polyform | 90 | polyform | polyform (?:noncommercial|small business|free trial|shield|perimeter|strict) licen[sc]e(?: \d \d \d)?
hippocratic | 88 | hippocratic license | hippocratic license(?: version)?(?: \d(?: \d)?)?
openrail | 92 | openrail | (?:creativeml |bigscience )?openrail(?: m| s)?(?: licen[sc]e)?
openrail | 92 | bigscience | bigscience (?:bloom )?rail(?: 1 0)?
llama | 90 | llama | llama \d(?: \d)? community licen[sc]e(?: agreement)?
gemma | 88 | gemma terms of use | gemma terms of use
mulan-psl-2 | 92 | mulan psl | mulan psl(?: v2| 2 0)?
mulan-psl-2 | 92 | mulan permissive software license | mulan permissive software license(?: v2| version 2)?
cecill-2.1 | 92 | cecill | cecill(?: [bc])?(?: free software)?(?: licen[sc]e)?(?: agreement)?(?: (?:v|version )?\d \d)?
eudatagrid | 86 | eu datagrid software license | eu datagrid software license
naist | 86 | naist | naist(?: 2003)? licen[sc]e
ntp | 86 | ntp license | (?:the )?ntp license
hpnd | 90 | historical permission notice | historical permission notice and disclaimer
tcl | 86 | tcl tk license | tcl tk license
xfree86 | 88 | xfree86 license | xfree86 license(?: 1 1)?
zpl-2.1 | 90 | zope public license | zope public license(?: version| v)?(?: \d(?: \d)?)?
blueoak-1.0 | 92 | blue oak model license | blue oak model license(?: 1 0 0)?
bittorrent | 86 | bittorrent open source license | bittorrent open source license
ecl-2.0 | 92 | educational community license | educational community license(?: version| v)?(?: 2 0)?
rpl-1.5 | 90 | reciprocal public license | reciprocal public license(?: version)?(?: 1 5)?
simpl-2.0 | 86 | simple public license | simple public license(?: version)?(?: 2 0)?
watcom | 86 | sybase open watcom | sybase open watcom public license
wxwindows | 90 | wxwindows library licence | wxwindows library licence(?: version \d \d)?
netscape | 88 | netscape public license | netscape public license(?: version)?(?: 1 [01])?
apsl-2.0 | 90 | apple public source license | apple public source license(?: version)?(?: \d \d)?
nokia | 86 | nokia open source license | nokia open source license
realnetworks | 86 | realnetworks public source license | realnetworks public source license
sun-isl | 86 | sun industry standards source license | sun industry standards source license
proprietary | 80 | all rights reserved | copyright(?: \S+){1,8} all rights reserved
proprietary | 82 | proprietary and confidential | proprietary and confidential
proprietary | 82 | unauthorized | unauthorized (?:copying|distribution|reproduction) of this (?:file|software|document|work)
proprietary | 80 | commercial license | (?:under|requires|purchase) (?:a |an |the )?commercial license
proprietary | 78 | end user license agreement | end user license agreement
other | 40 | spdx license identifier | spdx license identifier \S+
other | 35 | licensed under | licensed under (?:the |a )?(?:terms of (?:the )?)?\S+(?: \S+){0,2} licen[sc]e
other | 35 | released under | released under (?:the |a )?(?:terms of (?:the )?)?\S+(?: \S+){0,2} licen[sc]e
"""
