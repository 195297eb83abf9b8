"""The rule book of operator 5: signatures of licences over normalised text.

A text is normalised to lower-case words one space apart, so ``Apache-2.0`` reads
``apache 2 0``. A line of the book is a rule: label, priority, confidence,
keyword, pattern. Every rule is written by hand for one licence: what stands only
in its text, its title, its notice, its address, and the ways it is named.
Priorities: 100 and above whole statements of a licence or notice, 90 tags and
addresses, 80 grants and titles, 60 names with a version, 30 bare names, 20
phrases that many licences share.

A rule is tried only on texts that have its keyword, so every text that its
pattern matches has it. One rule reads SPDX expressions by a table of
identifiers; it yields a detection for each identifier of an expression.
"""

from __future__ import annotations

from typing import NamedTuple


class Rule(NamedTuple):
    label: str
    priority: int
    confidence: float
    keyword: str
    pattern: str


BOOK = r"""
mit 100 1.0 permission permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit 99 0.95 permission permission is hereby granted free of charge to any person obtaining a copy
mit 98 0.9 sublicense to use copy modify merge publish distribute sublicense and or sell copies of the software
mit 97 0.9 copyright the above copyright notice and this permission notice (?:including the next paragraph )?shall be included in all copies or substantial portions of the software
mit 96 0.9 noninfringement without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement
mit 80 0.95 licensed licensed under (?:the )?(?:terms of )?(?:the )?(?:mit|mit expat)(?: style)?(?: licen[cs]e)?
mit 80 0.95 released released under (?:the )?(?:terms of )?(?:the )?(?:mit|mit expat)(?: style)?(?: licen[cs]e)?
mit 80 0.95 distributed distributed under (?:the )?(?:terms of )?(?:the )?(?:mit|mit expat)(?: style)?(?: licen[cs]e)?
mit 80 0.95 available available under (?:the )?(?:terms of )?(?:the )?(?:mit|mit expat)(?: style)?(?: licen[cs]e)?
mit 80 0.95 published published under (?:the )?(?:terms of )?(?:the )?(?:mit|mit expat)(?: style)?(?: licen[cs]e)?
mit 79 0.9 license license (?:is )?mit
mit 79 0.9 licence licence (?:is )?mit
mit 79 0.9 licensed licensed (?:is )?mit
mit 79 0.9 licenced licenced (?:is )?mit
mit 78 0.9 license the mit license(?: mit)?
mit 60 0.8 license mit license
mit 60 0.8 licence mit licence
mit 60 0.8 expat expat licen[cs]e
mit 90 0.95 opensource opensource org licenses? mit
mit 60 0.7 licensed mit licensed
mit-0 100 1.0 attribution mit no attribution
mit-0 99 0.9 license mit 0 license
isc 100 1.0 permission permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
isc 99 0.95 permission permission to use copy modify and or distribute this software for any purpose with or without fee
isc 97 0.9 liable in no event shall (?:the )?author be liable for any special direct indirect or consequential damages
isc 80 0.9 isc (?:licensed|released|distributed|available|published|provided) under (?:the )?(?:terms of )?(?:the )?isc(?: licen[cs]e)?
isc 79 0.85 isc (?:license|licence) (?:is )?isc
isc 60 0.8 isc isc licen[cs]e
0bsd 100 1.0 permission permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided as is
0bsd 80 0.9 bsd zero clause bsd(?: license)?
0bsd 60 0.8 0bsd 0bsd(?: license)?
bsd 100 1.0 redistribution redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met
bsd 99 0.95 redistribution redistribution and use in source and binary forms with or without modification are permitted
bsd 97 0.8 redistributions redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer
bsd 97 0.8 redistributions redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer
bsd 60 0.6 bsd (?:the )?bsd(?: style)? licen[cs]e
bsd 59 0.6 bsd (?:licensed|released|distributed|available) under (?:the )?(?:terms of )?(?:the )?(?:a )?bsd
bsd-2-clause 80 0.95 simplified simplified bsd(?: license)?
bsd-2-clause 80 0.95 bsd (?:bsd 2 clause|2 clause bsd)(?: simplified)?(?: license)?
bsd-2-clause 79 0.9 freebsd (?:the )?freebsd (?:copyright|license)
bsd-2-clause 90 0.95 opensource opensource org licenses? bsd 2 clause
bsd-3-clause 100 0.95 endorse (?:may|can) be used to endorse or promote products derived from this software without specific prior written permission
bsd-3-clause 80 0.95 bsd (?:bsd 3 clause|3 clause bsd)(?: new or revised)?(?: license)?
bsd-3-clause 80 0.9 bsd (?:the )?(?:new|modified|revised) bsd(?: license)?
bsd-3-clause 90 0.95 opensource opensource org licenses? bsd 3 clause
bsd-3-clause-clear 101 1.0 disclaimer subject to the limitations in the disclaimer below
bsd-3-clause-clear 101 0.95 patent no express or implied licenses to any party s patent rights are granted by this license
bsd-4-clause 101 1.0 advertising all advertising materials mentioning features or use of this software must display the following acknowledgements?
bsd-4-clause 80 0.95 bsd (?:bsd 4 clause|4 clause bsd|original bsd|old bsd)(?: license)?
apache-1.0 101 0.95 apache this product includes software developed by the apache group for use in the apache http server project
apache-1.1 101 1.0 apache this product includes software developed by the apache software foundation http www apache org
apache-1.1 99 0.9 apache the names apache and apache software foundation must not be used to endorse
apache-1.1 80 0.95 apache (?:the )?apache (?:software )?license,? version 1 1
apache-1.1 60 0.85 apache apache (?:software )?(?:license )?(?:version |v)?1 1
apache-2.0 102 1.0 apache licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license
apache-2.0 101 1.0 apache licensed under the apache license version 2 0(?: the license)?
apache-2.0 100 1.0 apache apache license version 2 0 january 2004
apache-2.0 99 0.9 compliance you may not use this file except in compliance with the license
apache-2.0 98 0.95 license unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis
apache-2.0 98 0.9 contributor each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license
apache-2.0 97 0.9 notice if the work includes a notice text file as part of its distribution
apache-2.0 90 0.95 apache (?:www )?apache org licenses license 2 0(?: (?:txt|html))?
apache-2.0 90 0.95 opensource opensource org licenses? apache 2 0
apache-2.0 80 0.95 apache apache (?:software )?licen[cs]e (?:version |v )?v?2(?: 0)?
apache-2.0 60 0.85 apache apache (?:software )?(?:version |v )?v?2 0
apache-2.0 60 0.85 asl asl 2 0
gpl-1.0 80 0.9 gnu gnu general public license (?:v |version )?v?1(?: 0)?(?: february 1989)?
gpl-1.0 60 0.8 gpl gpl (?:v |version )?v?1(?: 0)?
gpl-2.0 100 1.0 gnu gnu general public license version 2 june 1991
gpl-2.0 101 0.95 gnu gnu general public license (?:v |version )?v?2(?: 0)? only
gpl-2.0 101 0.95 gnu gnu gpl (?:v |version )?v?2(?: 0)? only
gpl-2.0 101 0.95 gpl gpl (?:v |version )?v?2(?: 0)? only
gpl-2.0 100 0.95 gnu under the terms of (?:the )?(?:version 2 of )?the gnu general public license (?:version 2 )?as published by the free software foundation
gpl-2.0 98 0.95 verbatim you may copy and distribute verbatim copies of the program s source code as you receive it
gpl-2.0 80 0.95 gnu gnu (?:general public license|gpl) (?:v |version )?v?2(?: 0)?
gpl-2.0 60 0.9 gpl gpl (?:v |version )?v?2(?: 0)?
gpl-2.0 60 0.9 gplv2 (?:gnu )?gplv2(?: 0)?
gpl-2.0 60 0.9 gpl2 gpl2
gpl-2.0-or-later 103 1.0 gnu gnu general public license (?:as published by the free software foundation )?(?:either )?v(?:ersion)? ?2(?: 0)?(?: of the license)? or (?:at your option )?(?:any )?later(?: version)?
gpl-2.0-or-later 103 1.0 gnu gnu gpl (?:as published by the free software foundation )?(?:either )?v(?:ersion)? ?2(?: 0)?(?: of the license)? or (?:at your option )?(?:any )?later(?: version)?
gpl-2.0-or-later 103 1.0 gpl gpl (?:as published by the free software foundation )?(?:either )?v(?:ersion)? ?2(?: 0)?(?: of the license)? or (?:at your option )?(?:any )?later(?: version)?
gpl-2.0-or-later 103 1.0 gpl gpl 2 0 or later
gpl-2.0-or-later 103 0.95 gplv2 gplv2 or later
gpl-3.0 100 1.0 gnu gnu general public license version 3 29 june 2007
gpl-3.0 98 0.95 propagate you may make run and propagate covered works that you do not convey
gpl-3.0 97 0.95 copyleft the gnu general public license is a free copyleft license for software and other kinds of works
gpl-3.0 80 0.95 gnu gnu (?:general public license|gpl) (?:v |version )?v?3(?: 0)?
gpl-3.0 60 0.9 gpl gpl (?:v |version )?v?3(?: 0)?
gpl-3.0 60 0.9 gplv3 (?:gnu )?gplv3(?: 0)?
gpl-3.0 60 0.9 gpl3 gpl3
gpl-3.0 90 0.95 gnu (?:www )?gnu org licenses gpl 3 0(?: (?:html|txt|en html))?
gpl-3.0-or-later 103 1.0 gnu gnu general public license (?:as published by the free software foundation )?(?:either )?v(?:ersion)? ?3(?: 0)?(?: of the license)? or (?:at your option )?(?:any )?later(?: version)?
gpl-3.0-or-later 103 1.0 gnu gnu gpl (?:as published by the free software foundation )?(?:either )?v(?:ersion)? ?3(?: 0)?(?: of the license)? or (?:at your option )?(?:any )?later(?: version)?
gpl-3.0-or-later 103 1.0 gpl gpl (?:as published by the free software foundation )?(?:either )?v(?:ersion)? ?3(?: 0)?(?: of the license)? or (?:at your option )?(?:any )?later(?: version)?
gpl-3.0-or-later 103 1.0 gpl gpl 3 0 or later
gpl-3.0-or-later 103 0.95 gplv3 gplv3 or later
gpl 99 0.9 redistribute this program is free software you can redistribute it and or modify it under the terms of the gnu general public license
gpl 98 0.9 gnu this (?:work|file|program|software) is (?:licensed|distributed|released) under the (?:terms of the )?gnu general public license
gpl 90 0.8 gnu (?:www )?gnu org (?:licenses|copyleft) gpl(?: (?:html|txt))?
gpl 60 0.7 gnu you should have received a copy of the gnu general public license
gpl 30 0.6 gnu gnu gpl
gpl-2.0-classpath 104 1.0 linking linking this library statically or dynamically with other modules is making a combined work
gpl-2.0-classpath 90 0.9 classpath classpath exception(?: 2 0)?
lgpl-2.0 100 1.0 gnu gnu library general public license version 2 june 1991
lgpl-2.0 80 0.95 gnu gnu (?:library|lesser) general public license (?:v |version )?v?2 0
lgpl-2.0 80 0.9 gnu gnu library general public license
lgpl-2.0 60 0.85 lgpl lgpl (?:v |version )?v?2 0
lgpl-2.1 100 1.0 gnu gnu lesser general public license version 2 1 february 1999
lgpl-2.1 80 0.95 lesser gnu lesser general public license (?:v |version )?v?2 1
lgpl-2.1 60 0.9 lgpl lgpl (?:v |version )?v?2 1
lgpl-2.1 60 0.9 lgplv2 lgplv2 1
lgpl-2.1 90 0.95 gnu (?:www )?gnu org licenses (?:old licenses )?lgpl 2 1
lgpl-2.1-or-later 103 1.0 gnu gnu lesser general public license (?:as published by the free software foundation )?(?:either )?v(?:ersion)? ?2 1(?: of the license)? or (?:at your option )?(?:any )?later(?: version)?
lgpl-2.1-or-later 103 1.0 gnu gnu lgpl (?:as published by the free software foundation )?(?:either )?v(?:ersion)? ?2 1(?: of the license)? or (?:at your option )?(?:any )?later(?: version)?
lgpl-2.1-or-later 103 1.0 lgpl lgpl (?:as published by the free software foundation )?(?:either )?v(?:ersion)? ?2 1(?: of the license)? or (?:at your option )?(?:any )?later(?: version)?
lgpl-3.0 100 1.0 gnu gnu lesser general public license version 3 29 june 2007
lgpl-3.0 80 0.95 lesser gnu lesser general public license (?:v |version )?v?3(?: 0)?
lgpl-3.0 60 0.9 lgpl lgpl (?:v |version )?v?3(?: 0)?
lgpl-3.0 60 0.9 lgplv3 lgplv3
lgpl 98 0.9 lesser under the terms of the gnu lesser general public license
lgpl 60 0.7 lesser gnu lesser general public license
lgpl 30 0.6 lgpl (?:gnu )?lgpl
agpl-3.0 100 1.0 affero gnu affero general public license version 3 19 november 2007
agpl-3.0 99 0.95 remotely all users interacting with it remotely through a computer network
agpl-3.0 98 0.95 affero under the terms of (?:version 3 of )?the gnu affero general public license
agpl-3.0 80 0.95 affero (?:gnu )?affero general public license(?: (?:v |version )?v?3(?: 0)?)?
agpl-3.0 60 0.9 agpl (?:gnu )?agpl (?:v |version )?v?3(?: 0)?
agpl-3.0 60 0.9 agplv3 (?:gnu )?agplv3
agpl-3.0 30 0.6 agpl (?:gnu )?agpl
gfdl-1.3 100 1.0 documentation gnu free documentation license version 1 3 3 november 2008
gfdl-1.2 100 1.0 documentation gnu free documentation license version 1 2 november 2002
gfdl 98 0.95 invariant with no invariant sections no front cover texts and no back cover texts
gfdl 80 0.9 documentation gnu free documentation license(?: version 1 [123])?
gfdl 60 0.8 gfdl gfdl(?: 1 [123])?
mpl-1.0 80 0.9 mozilla mozilla public license (?:v |version )?v?1 0
mpl-1.1 100 1.0 mozilla the contents of this file are subject to the mozilla public license version 1 1
mpl-1.1 80 0.95 mozilla mozilla public license (?:v |version )?v?1 1
mpl-1.1 60 0.9 mpl mpl (?:v |version )?v?1 1
mpl-2.0 100 1.0 mozilla this source code form is subject to the terms of the mozilla public license v 2 0
mpl-2.0 99 0.95 mpl if a copy of the mpl was not distributed with this file you can obtain one at
mpl-2.0 98 0.95 secondary incompatible with secondary licenses as defined by the mozilla public license
mpl-2.0 90 0.95 mozilla (?:www )?mozilla org (?:en us )?mpl 2 0
mpl-2.0 80 0.95 mozilla mozilla public license(?: v| version)? v?2 0
mpl-2.0 60 0.9 mpl mpl (?:v |version )?v?2 0
mpl-2.0 60 0.9 mplv2 mplv2(?: 0)?
mpl 30 0.6 mozilla mozilla public license
epl-1.0 100 0.95 eclipse terms of the eclipse public license v1 0 which accompanies this distribution
epl-1.0 90 0.95 eclipse eclipse org (?:legal|org documents) epl v10
epl-1.0 80 0.95 eclipse eclipse public license (?:v |version )?v?1 0
epl-1.0 60 0.9 epl epl (?:v |version )?v?1 0
epl-2.0 100 0.95 eclipse terms of the eclipse public license (?:v )?2 0 which is available at
epl-2.0 90 0.95 eclipse eclipse org legal epl (?:2 0|v20)
epl-2.0 80 0.95 eclipse eclipse public license (?:v |version )?v?2 0
epl-2.0 60 0.9 epl epl (?:v |version )?v?2 0
edl-1.0 80 0.95 eclipse eclipse distribution license(?: v| version)?(?: v?1 0)?
cpl-1.0 100 0.95 license the accompanying program is provided under the terms of this common public license
cpl-1.0 80 0.9 license common public license(?: v| version)?(?: 1 0)?
ipl-1.0 80 0.9 ibm ibm public license(?: v| version)?(?: 1 0)?
cddl-1.0 100 0.95 license (?:subject to|under) the terms of the common development and distribution license
cddl-1.0 80 0.9 license common development and distribution license(?: (?:v |version )?v?1 0)?
cddl-1.1 81 0.95 license common development and distribution license (?:v |version )?v?1 1
cddl-1.0 60 0.8 cddl cddl(?: 1 0)?
cddl-1.1 61 0.85 cddl cddl 1 1
bsl-1.0 100 1.0 boost distributed under the boost software license version 1 0
bsl-1.0 99 0.95 boost boost software license version 1 0 august 17th 2003
bsl-1.0 98 0.95 executable machine executable object code generated by a source language processor
bsl-1.0 90 0.95 boost boost org license 1 0 txt
bsl-1.0 80 0.9 boost boost software licen[cs]e(?: (?:v |version )?v?1 0)?
bsl-1.0 60 0.8 bsl bsl 1 0
busl-1.1 100 1.0 licensor the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use of the licensed work
busl-1.1 80 0.95 license business source license(?: 1 1)?
busl-1.1 60 0.85 busl busl(?: 1 1)?
sspl-1.0 100 1.0 license server side public license version 1 october 16 2018
sspl-1.0 80 0.95 license server side public license(?: (?:v |version )?v?1(?: 0)?)?
sspl-1.0 60 0.85 sspl sspl(?: v?1(?: 0)?)?
elastic-2.0 80 0.95 elastic elastic license (?:v |version )?v?2(?: 0)?
polyform-noncommercial 80 0.95 polyform polyform noncommercial license(?: 1 0 0)?
zlib 100 0.95 warranty this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software
zlib 99 0.95 altered altered source versions must be plainly marked as such and must not be misrepresented as being the original software
zlib 98 0.9 misrepresented the origin of this software must not be misrepresented
zlib 80 0.9 zlib (?:the )?zlib(?: libpng)? licen[cs]e
zlib 79 0.85 zlib (?:licensed|released|distributed|available) under (?:the )?(?:terms of )?(?:the )?zlib
libpng-2.0 80 0.95 libpng libpng license(?: version 2)?
unlicense 100 1.0 unencumbered this is free and unencumbered software released into the public domain
unlicense 99 0.95 relinquishment we intend this dedication to be an overt act of relinquishment in perpetuity
unlicense 90 0.95 unlicense unlicense org
unlicense 60 0.8 unlicense (?:the )?unlicense
cc0-1.0 100 0.95 waived to the extent possible under law (?:[a-z0-9]+ ){1,20}has(?: have)? waived all copyright and related or neighboring rights
cc0-1.0 98 0.95 affirmer affirmer hereby overtly fully permanently irrevocably and unconditionally waives
cc0-1.0 90 0.95 creativecommons creativecommons org publicdomain zero 1 0
cc0-1.0 80 0.95 cc0 (?:creative commons )?cc0 1 0(?: universal)?
cc0-1.0 80 0.95 zero creative commons zero(?: v?1 0)?
cc0-1.0 30 0.7 cc0 cc0
cc-pdm-1.0 90 0.95 creativecommons creativecommons org publicdomain mark 1 0
cc-by 95 0.9 commons this (?:work|article|document|content) is licensed under (?:a|the) creative commons attribution(?! (?:non|share|no))
cc-by-4.0 100 1.0 attribution creative commons attribution 4 0 international(?: public)?(?: license)?
cc-by-4.0 90 0.95 creativecommons creativecommons org licenses by 4 0
cc-by-4.0 80 0.95 cc cc by v?4 0
cc-by-4.0 79 0.9 attribution creative commons attribution(?: licen[cs]e)? (?:v |version )?v?4 0
cc-by-3.0 100 1.0 attribution creative commons attribution 3 0 unported(?: license)?
cc-by-3.0 90 0.95 creativecommons creativecommons org licenses by 3 0
cc-by-3.0 80 0.95 cc cc by v?3 0
cc-by-3.0 79 0.9 attribution creative commons attribution(?: licen[cs]e)? (?:v |version )?v?3 0
cc-by-2.5 90 0.95 creativecommons creativecommons org licenses by 2 5
cc-by-2.5 80 0.95 cc cc by 2 5
cc-by-2.0 90 0.95 creativecommons creativecommons org licenses by 2 0
cc-by-2.0 80 0.95 cc cc by 2 0
cc-by-2.0 79 0.9 attribution creative commons attribution(?: generic)? 2 0
cc-by-sa 96 0.9 commons this (?:work|article|document|content) is licensed under (?:a|the) creative commons attribution share ?alike
cc-by-sa-4.0 100 1.0 attribution creative commons attribution share ?alike 4 0 international
cc-by-sa-4.0 80 0.95 cc cc by sa v?4 0
cc-by-sa-4.0 90 0.95 creativecommons creativecommons org licenses by sa 4 0
cc-by-sa-3.0 100 1.0 attribution creative commons attribution share ?alike 3 0(?: unported)?
cc-by-sa-3.0 80 0.95 cc cc by sa v?3 0
cc-by-sa-3.0 90 0.95 creativecommons creativecommons org licenses by sa 3 0
cc-by-sa-2.0 80 0.95 cc cc by sa 2 [05]
cc-by-sa 60 0.8 cc cc by sa
cc-by-sa 60 0.8 attribution creative commons attribution share ?alike
cc-by-nc 97 0.9 commons this (?:work|article|document|content) is licensed under (?:a|the) creative commons attribution non ?commercial(?! (?:share|no))
cc-by-nc-4.0 80 0.95 cc cc by nc v?4 0
cc-by-nc-4.0 79 0.95 attribution creative commons attribution non ?commercial 4 0(?: international)?
cc-by-nc-4.0 90 0.95 creativecommons creativecommons org licenses by nc 4 0
cc-by-nc-3.0 80 0.95 cc cc by nc v?3 0
cc-by-nc 60 0.8 cc cc by nc(?! (?:sa|nd))
cc-by-nc 60 0.8 attribution creative commons attribution non ?commercial(?! (?:share|no))
cc-by-nc-sa 98 0.9 commons this (?:work|article|document|content) is licensed under (?:a|the) creative commons attribution non ?commercial share ?alike
cc-by-nc-sa-4.0 80 0.95 cc cc by nc sa v?4 0
cc-by-nc-sa-4.0 79 0.95 attribution creative commons attribution non ?commercial share ?alike 4 0(?: international)?
cc-by-nc-sa-3.0 80 0.95 cc cc by nc sa v?3 0
cc-by-nc-sa 60 0.8 cc cc by nc sa
cc-by-nc-sa 60 0.8 attribution creative commons attribution non ?commercial share ?alike
cc-by-nd 97 0.9 commons this (?:work|article|document|content) is licensed under (?:a|the) creative commons attribution no ?deriv(?:ative)?s?
cc-by-nd-4.0 80 0.95 cc cc by nd v?4 0
cc-by-nd 60 0.8 cc cc by nd
cc-by-nd 60 0.8 attribution creative commons attribution no ?deriv(?:ative)?s?
cc-by-nc-nd 98 0.9 commons this (?:work|article|document|content) is licensed under (?:a|the) creative commons attribution non ?commercial no ?deriv(?:ative)?s?
cc-by-nc-nd-4.0 80 0.95 cc cc by nc nd v?4 0
cc-by-nc-nd 60 0.8 cc cc by nc nd
cc-by-nc-nd 60 0.8 attribution creative commons attribution non ?commercial no ?deriv(?:ative)?s?
cc-url 50 0.6 creativecommons creativecommons org licenses [a-z0-9]+(?: [a-z0-9]+)?
cc 30 0.5 commons (?:a|the) creative commons licen[cs]e
wtfpl 100 1.0 fuck do what the fuck you want to public license(?: version 2)?
wtfpl 99 0.95 fuck you just do what the fuck you want to
wtfpl 60 0.8 wtfpl wtfpl
artistic-1.0 80 0.9 artistic (?:the )?artistic license (?:v |version )?v?1 0
artistic-2.0 100 0.95 artistic the artistic license 2 0 copyright c 2000 2006 the perl foundation
artistic-2.0 80 0.9 artistic (?:the )?artistic license (?:v |version )?v?2(?: 0)?
artistic 60 0.7 artistic (?:the )?(?:perl )?artistic license
perl 98 0.9 perl (?:under )?the same terms as perl(?: itself)?
python-2.0 100 0.95 python python software foundation license version 2
python-2.0 99 0.95 psf this license agreement is between the python software foundation psf
python-2.0 80 0.9 psf psf license(?: agreement)?
python-2.0 60 0.8 python python software foundation license
php-3.01 99 0.95 php this product includes php software freely available from
php-3.01 80 0.9 php (?:the )?php license(?: v| version)?(?: 3 01?)?
ruby 98 0.9 ruby (?:under )?the same terms as ruby(?: itself)?
ruby 80 0.85 ruby (?:the )?ruby license
postgresql 100 0.95 permission permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted
postgresql 80 0.9 postgresql (?:the )?postgresql licen[cs]e
hpnd 99 0.9 permission permission to use copy modify and distribute this software and its documentation for any purpose (?:and )?without fee is hereby granted
hpnd 80 0.9 historical historical permission notice and disclaimer
ntp 99 0.9 permission permission to use copy modify and distribute this software and its documentation for any purpose with or without fee is hereby granted
ncsa 99 0.95 illinois university of illinois ncsa open source license
ncsa 60 0.8 ncsa ncsa open source license
openssl 99 0.95 openssl this product includes software developed by the openssl project for use in the openssl toolkit
openssl 80 0.9 openssl (?:the )?openssl license
ssleay 99 0.95 eric this product includes cryptographic software written by eric young
ofl-1.1 100 1.0 sil sil open font license version 1 1 26 february 2007
ofl-1.1 99 0.95 font this font software is licensed under the sil open font license
ofl-1.1 90 0.95 sil scripts sil org ofl
ofl-1.1 80 0.9 sil sil open font license(?: version 1 1)?
ofl-1.1 60 0.8 ofl (?:sil )?ofl(?: 1 1)?
lppl-1.3c 99 0.95 latex this work may be distributed and or modified under the conditions of the latex project public license
lppl-1.3c 80 0.9 latex latex project public license(?: (?:v |version )?v?1 3[ac]?)?
lppl-1.3c 60 0.8 lppl lppl(?: 1 3[ac]?)?
ms-pl 80 0.95 license microsoft public license(?: ms pl)?
ms-pl 60 0.85 pl ms pl
ms-rl 80 0.95 license microsoft reciprocal license(?: ms rl)?
ms-rl 60 0.85 rl ms rl
ms-lpl 80 0.9 license microsoft limited public license
eupl-1.2 100 1.0 european european union public licen[cs]e v(?:ersion)? ?1 2
eupl-1.1 100 1.0 european european union public licen[cs]e v(?:ersion)? ?1 1
eupl 60 0.8 european european union public licen[cs]e
eupl 60 0.8 eupl eupl(?: v?1 [12])?
ecl-2.0 100 0.95 license educational community license version 2 0
ecl-2.0 60 0.8 license educational community license
afl-3.0 80 0.95 license academic free license(?: v| version)?(?: v?3 0)?
osl-3.0 80 0.9 license open software license(?: v| version)?(?: v?3 0)?
osl-3.0 60 0.8 osl osl 3 0
qpl-1.0 80 0.9 license (?:the )?q public license(?: version)?(?: 1 0)?
apsl-2.0 80 0.95 license apple public source license(?: version)?(?: 2 0)?
sun-spl 80 0.9 license sun (?:industry standards source|public) license
nasa-1.3 80 0.95 nasa nasa open source agreement(?: version)?(?: 1 3)?
w3c 99 0.95 w3c w3c software (?:notice and |and document notice and )?license
w3c 80 0.9 w3c (?:the )?w3c license
x11 99 0.95 consortium except as contained in this notice the name of the x consortium shall not be used in advertising
x11 80 0.9 x11 (?:mit )?x11 license
vim 80 0.9 license (?:the )?vim license
zpl-2.1 80 0.9 license zope public license(?: (?:v |version )?v?2 [01])?
zpl-2.1 60 0.8 zpl zpl(?: 2 [01])?
upl-1.0 80 0.95 license universal permissive license(?: (?:v |version )?v?1 0)?
odbl-1.0 99 0.95 license made available under the open database license
odbl-1.0 90 0.95 opendatacommons opendatacommons org licenses odbl
odbl-1.0 80 0.9 license open (?:data commons open )?database license(?: odbl)?(?: v?1 0)?
odbl-1.0 60 0.8 odbl odbl(?: v?1 0)?
odc-by-1.0 90 0.95 opendatacommons opendatacommons org licenses by
odc-by-1.0 80 0.9 license open data commons attribution license(?: v?1 0)?
pddl-1.0 90 0.95 opendatacommons opendatacommons org licenses pddl
pddl-1.0 80 0.9 dedication public domain dedication and licen[cs]e(?: v?1 0)?
cdla-permissive 80 0.95 license community data license agreement permissive(?: version)?(?: [12] 0)?
cdla-sharing 80 0.95 license community data license agreement sharing(?: version)?(?: 1 0)?
ogl-uk-3.0 99 0.95 government contains public sector information licensed under the open government licen[cs]e(?: v3 0)?
ogl-uk 80 0.9 government open government licen[cs]e(?: v?[123](?: 0)?)?
etalab-2.0 80 0.95 etalab licence ouverte (?:open licence )?etalab(?: 2 0)?
dl-de-by-2.0 80 0.95 datenlizenz datenlizenz deutschland namensnennung(?: version)?(?: 2 0)?
cecill-2.1 80 0.95 cecill (?:licence )?cecill(?: [bc])?(?: (?:version )?2 [01])?
mulanpsl-2.0 80 0.95 mulan mulan (?:psl|permissive software license) v2
json 99 0.95 evil the software shall be used for good not evil
beerware 99 0.95 license the beer ware license(?: revision 42)?
beerware 98 0.9 beer you can buy me a beer in return
bzip2-1.0.6 80 0.9 bzip2 (?:the )?bzip2 license
curl 80 0.9 curl (?:the )?curl license
imagemagick 80 0.9 imagemagick (?:the )?imagemagick license
ijg 99 0.95 jpeg this software is based in part on the work of the independent jpeg group
unicode 99 0.9 unicode unicode inc license agreement data files and software
tcl 98 0.9 tcl (?:the )?tcl tk license
bigscience-rail 80 0.95 rail bigscience (?:bloom )?rail(?: license)?(?: 1 0)?
openrail 80 0.9 openrail (?:creativeml )?openrail(?: m)?(?: license)?
llama 80 0.9 llama (?:meta )?llama [23](?: [123])? community license(?: agreement)?
gemma 80 0.9 gemma gemma (?:terms of use|license)
public-domain 60 0.8 domain (?:released|placed|dedicated|put|is) (?:in|into|to) the public domain
public-domain 59 0.7 domain (?:this (?:work|file|code|software) )?(?:is )?in the public domain
public-domain 58 0.6 domain public domain (?:work|software|mark|dedication)
all-rights-reserved 40 0.6 reserved all rights reserved
all-rights-reserved 40 0.6 vorbehalten alle rechte vorbehalten
all-rights-reserved 40 0.6 reservados todos los derechos reservados
all-rights-reserved 40 0.6 réservés tous droits réservés
proprietary 45 0.7 proprietary proprietary and confidential
proprietary 45 0.7 proprietary confidential and proprietary
proprietary 44 0.7 unauthorized unauthorized (?:copying|reproduction|use)(?: or distribution)? of this
proprietary 44 0.7 permission (?:may not|no part of this (?:publication|work|document) may) be reproduced (?:(?!permission)[a-z0-9]+ ){0,20}without (?:the )?(?:prior )?(?:written )?permission
proprietary 43 0.6 license end user license agreement
commercial 43 0.6 commercial (?:requires|under|purchase) a commercial license
open-source 20 0.3 source (?:an |osi approved )?open source licen[cs]e
gpl-compatible 20 0.3 compatible gpl compatible license
"""

#: fixed values: label -> identifier as SPDX spells it
SPDX: dict[str, str] = {
    "0bsd": "0BSD", "afl-3.0": "AFL-3.0", "agpl-3.0": "AGPL-3.0", "apache-1.0": "Apache-1.0", "apache-1.1": "Apache-1.1", "apache-2.0": "Apache-2.0",
    "apsl-2.0": "APSL-2.0", "artistic-1.0": "Artistic-1.0", "artistic-2.0": "Artistic-2.0", "beerware": "Beerware", "bsd-2-clause": "BSD-2-Clause",
    "bsd-3-clause": "BSD-3-Clause", "bsd-3-clause-clear": "BSD-3-Clause-Clear", "bsd-4-clause": "BSD-4-Clause", "bsl-1.0": "BSL-1.0", "busl-1.1": "BUSL-1.1",
    "bzip2-1.0.6": "bzip2-1.0.6", "cc-by-2.0": "CC-BY-2.0", "cc-by-2.5": "CC-BY-2.5", "cc-by-3.0": "CC-BY-3.0", "cc-by-4.0": "CC-BY-4.0",
    "cc-by-nc-3.0": "CC-BY-NC-3.0", "cc-by-nc-4.0": "CC-BY-NC-4.0", "cc-by-nc-nd-4.0": "CC-BY-NC-ND-4.0", "cc-by-nc-sa-3.0": "CC-BY-NC-SA-3.0",
    "cc-by-nc-sa-4.0": "CC-BY-NC-SA-4.0", "cc-by-nd-4.0": "CC-BY-ND-4.0", "cc-by-sa-3.0": "CC-BY-SA-3.0", "cc-by-sa-4.0": "CC-BY-SA-4.0", "cc0-1.0": "CC0-1.0",
    "cddl-1.0": "CDDL-1.0", "cddl-1.1": "CDDL-1.1", "cecill-2.1": "CECILL-2.1", "cpl-1.0": "CPL-1.0", "curl": "curl", "ecl-2.0": "ECL-2.0", "elastic-2.0": "Elastic-2.0",
    "epl-1.0": "EPL-1.0", "epl-2.0": "EPL-2.0", "eupl-1.1": "EUPL-1.1", "eupl-1.2": "EUPL-1.2", "gfdl-1.2": "GFDL-1.2", "gfdl-1.3": "GFDL-1.3", "gpl-1.0": "GPL-1.0",
    "gpl-2.0": "GPL-2.0", "gpl-2.0-classpath": "Classpath-exception-2.0", "gpl-3.0": "GPL-3.0", "hpnd": "HPND", "ijg": "IJG", "imagemagick": "ImageMagick", "ipl-1.0": "IPL-1.0",
    "isc": "ISC", "json": "JSON", "lgpl-2.0": "LGPL-2.0", "lgpl-2.1": "LGPL-2.1", "lgpl-3.0": "LGPL-3.0", "lppl-1.3c": "LPPL-1.3c", "mit": "MIT", "mit-0": "MIT-0",
    "mpl-1.0": "MPL-1.0", "mpl-1.1": "MPL-1.1", "mpl-2.0": "MPL-2.0", "ms-pl": "MS-PL", "ms-rl": "MS-RL", "mulanpsl-2.0": "MulanPSL-2.0", "ncsa": "NCSA", "odbl-1.0": "ODbL-1.0",
    "odc-by-1.0": "ODC-By-1.0", "ofl-1.1": "OFL-1.1", "openssl": "OpenSSL", "osl-3.0": "OSL-3.0", "pddl-1.0": "PDDL-1.0", "php-3.01": "PHP-3.01", "postgresql": "PostgreSQL",
    "python-2.0": "Python-2.0", "qpl-1.0": "QPL-1.0", "ruby": "Ruby", "sspl-1.0": "SSPL-1.0", "unlicense": "Unlicense", "upl-1.0": "UPL-1.0", "vim": "Vim", "w3c": "W3C",
    "wtfpl": "WTFPL", "x11": "X11", "zlib": "Zlib", "zpl-2.1": "ZPL-2.1",
}
TAG = "spdx license identifiers?"
BY_NAME = ""  # a rule's label where the hit itself names it


def _written() -> list[Rule]:
    out = []
    for line in BOOK.strip().splitlines():
        label, priority, confidence, keyword, pattern = line.split(" ", 4)
        out.append(Rule(label, int(priority), float(confidence), keyword, pattern))
    return out


def spelled() -> dict[str, str]:
    """Identifier in normalised words -> label."""
    return {" ".join(i.lower().replace("-", " ").replace(".", " ").split()): label for label, i in SPDX.items()}


def named(hit: str) -> str:
    """SQL of the label that a hit of the SPDX rule names."""
    known = "|".join(sorted(spelled(), key=lambda x: (-len(x), x)))
    table = ", ".join(f"'{name}', '{label}'" for name, label in spelled().items())
    return f"element_at(map({table}), regexp_extract({hit}, ' ({known})(?: only| or later)?$', 1))"


def _tag() -> Rule:
    """The identifiers of an SPDX expression one after the other, as many as it has.

    The first follows the tag, each further one an operator right where the one
    before ended (``\\G``), so a hit is one identifier and none contains another. The
    label is that of the identifier, the longest that fits.
    """
    known = "|".join(sorted(spelled(), key=lambda x: (-len(x), x)))
    return Rule(BY_NAME, 95, 1.0, "spdx", rf"(?:{TAG} |(?<=\G )(?<!^ )(?:and|or|with) )(?:{known})(?: only| or later)?")


def rules() -> list[Rule]:
    """All rules, the highest priority first; ties keep the order of the book."""
    return sorted([*_written(), _tag()], key=lambda r: -r.priority)
