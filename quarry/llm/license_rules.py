"""Ordered signature rules of licences, over texts in lower case whose words are parted by single blanks.

A line of RULES: priority (higher wins), confidence in hundredths, label, keyword, pattern. The pattern
is tried only where the keyword stands, so every form of the pattern holds it at a word's start. Versions are words of their own, so 2.0 reads "2 0".
"""

RULES = """
90 100 mit | permission is hereby granted free of charge | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
90 95 mit | the software is provided as is | the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability
80 90 mit | mit license | (?:released|licensed|distributed|available|published|provided) under (?:the )?(?:terms of )?(?:the )?mit license
70 80 mit | mit license | the mit license(?: mit)?
60 70 mit | mit license | mit license
60 70 mit | expat license | expat license
60 60 mit | mit | (?:spdx )?license(?: identifier)? mit
60 60 mit | mit licensed | mit licensed
62 70 mit-0 | mit no attribution | mit no attribution
62 70 mit-0 | mit 0 | license(?: identifier)? mit 0
62 70 x11 | x11 license | x11 license
62 70 mit-modern | modern variant | mit license modern variant
62 60 mit-cmu | cmu license | cmu license
88 100 isc | permission to use copy modify and or distribute | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
60 70 isc | isc license | (?:the )?isc license
60 60 isc | isc | license(?: identifier)? isc
88 100 apache-2.0 | apache license version 2 0 | licensed under the apache license version 2 0 the license you may not use this file except in compliance
82 90 apache-2.0 | apache license version 2 0 | licensed under the apache license version 2 0
80 90 apache-2.0 | apache license | apache license(?: version| v)? 2(?: 0)?
80 85 apache-2.0 | apache 2 0 | (?:license(?: identifier)? )?apache 2 0(?: license)?
80 85 apache-2.0 | asl 2 0 | asl 2 0
80 85 apache-2.0 | apache org licenses license 2 0 | apache org licenses license 2 0
80 85 apache-1.1 | apache software license version 1 1 | apache software license version 1 1
80 85 apache-1.1 | apache 1 1 | apache 1 1
80 85 apache-1.0 | apache 1 0 | apache 1 0
60 60 apache | apache license | apache license
60 60 apache | apache software license | apache software license
90 100 gpl-3.0-or-later | either version 3 of the license | general public license as published by the free software foundation either version 3 of the license or at your option any later version
90 100 gpl-2.0-or-later | either version 2 of the license | general public license as published by the free software foundation either version 2 of the license or at your option any later version
84 90 gpl-3.0-or-later | gpl 3 0 or later | gpl 3 0 or later
84 90 gpl-2.0-or-later | gpl 2 0 or later | gpl 2 0 or later
84 90 gpl-3.0-only | gpl 3 0 only | gpl 3 0 only
84 90 gpl-2.0-only | gpl 2 0 only | gpl 2 0 only
83 90 gpl-3.0-or-later | general public license | (?:gnu )?general public license(?: version| v)? 3(?: 0)? or (?:any )?later(?: version)?
83 90 gpl-2.0-or-later | general public license | (?:gnu )?general public license(?: version| v)? 2(?: 0)? or (?:any )?later(?: version)?
80 90 gpl-3.0 | general public license | licensed under the (?:gnu )?general public license(?: version| v)? 3(?: 0)?
80 90 gpl-2.0 | general public license | licensed under the (?:gnu )?general public license(?: version| v)? 2(?: 0)?
78 85 gpl-3.0 | general public license | (?:gnu )?general public license(?: gpl)?(?: version| v)? 3(?: 0)?
78 85 gpl-2.0 | general public license | (?:gnu )?general public license(?: gpl)?(?: version| v)? 2(?: 0)?
78 85 gpl-1.0 | general public license | (?:gnu )?general public license(?: gpl)?(?: version| v)? 1(?: 0)?
78 80 gpl-3.0 | gplv3 | gplv3
78 80 gpl-2.0 | gplv2 | gplv2
78 80 gpl-3.0 | gpl 3 0 | gpl 3 0
78 80 gpl-2.0 | gpl 2 0 | gpl 2 0
78 75 gpl-3.0 | gpl v3 | gpl v3
78 75 gpl-2.0 | gpl v2 | gpl v2
60 60 gpl | general public license | (?:gnu )?general public license
60 55 gpl | gnu gpl | gnu gpl
60 55 gpl | gpl | under (?:the terms of )?the gpl
82 80 gpl-2.0-with-classpath-exception | classpath exception | classpath exception(?: 2 0)?
82 80 gpl-3.0-with-gcc-exception | gcc runtime library exception | gcc runtime library exception
82 80 gpl-2.0-with-font-exception | font exception | font exception(?: 2 0)?
82 80 gpl-2.0-with-autoconf-exception | autoconf exception | autoconf exception
82 80 gpl-2.0-with-bison-exception | bison exception | bison exception
90 100 lgpl-2.1-or-later | either version 2 1 of the license | lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version
90 100 lgpl-3.0-or-later | either version 3 of the license | lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version
84 90 lgpl-2.1-or-later | lgpl 2 1 or later | lgpl 2 1 or later
84 90 lgpl-3.0-or-later | lgpl 3 0 or later | lgpl 3 0 or later
84 90 lgpl-2.1-only | lgpl 2 1 only | lgpl 2 1 only
84 90 lgpl-3.0-only | lgpl 3 0 only | lgpl 3 0 only
81 85 lgpl-3.0 | lesser general public license | (?:gnu )?lesser general public license(?: lgpl)?(?: version| v)? 3(?: 0)?
81 85 lgpl-2.1 | lesser general public license | (?:gnu )?lesser general public license(?: lgpl)?(?: version| v)? 2 1
81 85 lgpl-2.0 | library general public license | (?:gnu )?library general public license(?: version| v)?(?: 2(?: 0)?)?
79 80 lgpl-3.0 | lgplv3 | lgplv3
79 80 lgpl-2.1 | lgplv2 1 | lgplv2 1
79 80 lgpl-3.0 | lgpl 3 0 | lgpl 3 0
79 80 lgpl-2.1 | lgpl 2 1 | lgpl 2 1
62 60 lgpl | lesser general public license | (?:gnu )?lesser general public license
62 55 lgpl | lgpl | (?:gnu |the )lgpl
90 100 agpl-3.0-or-later | affero general public license as published | affero general public license as published by the free software foundation either version 3 of the license or at your option any later version
84 90 agpl-3.0-or-later | agpl 3 0 or later | agpl 3 0 or later
84 90 agpl-3.0-only | agpl 3 0 only | agpl 3 0 only
81 85 agpl-3.0 | affero general public license | (?:gnu )?affero general public license(?: agpl)?(?: version| v)? 3(?: 0)?
81 85 agpl-1.0 | affero general public license | affero general public license(?: version| v)? 1(?: 0)?
79 80 agpl-3.0 | agplv3 | agplv3
79 80 agpl-3.0 | agpl 3 0 | agpl 3 0
62 60 agpl | affero general public license | (?:gnu )?affero general public license
84 90 gfdl-1.3 | free documentation license | (?:gnu )?free documentation license(?: version| v)? 1 3
84 90 gfdl-1.2 | free documentation license | (?:gnu )?free documentation license(?: version| v)? 1 2
84 90 gfdl-1.1 | free documentation license | (?:gnu )?free documentation license(?: version| v)? 1 1
62 60 gfdl | free documentation license | (?:gnu )?free documentation license
62 60 gfdl | gfdl | gfdl
90 100 bsd-3-clause | neither the name of | redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met(?: [^ ]+){20,140} neither the name of
86 95 bsd | redistribution and use in source and binary forms | redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met
80 85 bsd-4-clause | bsd 4 clause | bsd 4 clause(?: license)?
80 85 bsd-3-clause | bsd 3 clause | bsd 3 clause(?: license)?
80 85 bsd-2-clause | bsd 2 clause | bsd 2 clause(?: license)?
80 85 bsd-1-clause | bsd 1 clause | bsd 1 clause(?: license)?
80 85 0bsd | 0bsd | 0bsd
80 85 0bsd | zero clause bsd | zero clause bsd
80 85 bsd-3-clause-clear | clear bsd | (?:the )?clear bsd(?: license)?
80 80 bsd-3-clause | new bsd license | (?:the )?new bsd license
80 80 bsd-3-clause | modified bsd license | (?:the )?modified bsd license
80 80 bsd-3-clause | revised bsd license | (?:the )?revised bsd license
80 80 bsd-2-clause | simplified bsd license | (?:the )?simplified bsd license
80 80 bsd-2-clause | freebsd license | (?:the )?freebsd license
80 80 bsd-4-clause | original bsd license | (?:the )?original bsd license
80 75 bsd-2-clause-patent | bsd 2 clause plus patent | bsd 2 clause plus patent(?: license)?
60 60 bsd | bsd license | (?:the )?bsd license
60 55 bsd | bsd style license | bsd style license
88 95 mpl-2.0 | mozilla public license v 2 0 | subject to the terms of the mozilla public license v 2 0
80 85 mpl-2.0 | mozilla public license | mozilla public license(?: version| v)? 2(?: 0)?
80 85 mpl-1.1 | mozilla public license | mozilla public license(?: version| v)? 1 1
80 85 mpl-1.0 | mozilla public license | mozilla public license(?: version| v)? 1 0
78 80 mpl-2.0 | mpl 2 0 | mpl 2 0
78 80 mpl-1.1 | mpl 1 1 | mpl 1 1
60 60 mpl | mozilla public license | mozilla public license
80 85 epl-2.0 | eclipse public license | eclipse public license(?: version| v)? 2(?: 0)?
80 85 epl-1.0 | eclipse public license | eclipse public license(?: version| v)? 1(?: 0)?
78 80 epl-2.0 | epl 2 0 | epl 2 0
78 80 epl-1.0 | epl 1 0 | epl 1 0
60 60 epl | eclipse public license | eclipse public license
80 85 edl-1.0 | eclipse distribution license | eclipse distribution license(?: version| v)?(?: 1 0)?
80 85 cddl-1.1 | common development and distribution license | common development and distribution license(?: cddl)?(?: version| v)? 1 1
80 85 cddl-1.0 | common development and distribution license | common development and distribution license(?: cddl)?(?: version| v)? 1 0
60 60 cddl | common development and distribution license | common development and distribution license
78 75 cddl-1.0 | cddl 1 0 | cddl 1 0
78 75 cddl-1.1 | cddl 1 1 | cddl 1 1
80 85 cpl-1.0 | common public license | common public license(?: version| v)?(?: 1 0)?
80 85 cpal-1.0 | common public attribution license | common public attribution license(?: version| v)?(?: 1 0)?
80 85 ipl-1.0 | ibm public license | ibm public license(?: version| v)?(?: 1 0)?
80 85 artistic-2.0 | artistic license | (?:the )?artistic license(?: version| v)? 2(?: 0)?
80 85 artistic-1.0 | artistic license | (?:the )?artistic license(?: version| v)? 1(?: 0)?
60 60 artistic | artistic license | (?:the )?artistic license
78 70 artistic-1.0-perl | same terms as perl | (?:under )?(?:the )?same terms as perl(?: itself)?
80 85 bsl-1.0 | boost software license | boost software license(?: version| v)?(?: 1 0)?
78 75 bsl-1.0 | bsl 1 0 | bsl 1 0
80 85 busl-1.1 | business source license | business source license(?: version| v)?(?: 1 1)?
78 75 busl-1.1 | busl 1 1 | busl 1 1
80 85 sspl-1.0 | server side public license | server side public license(?: version| v)?(?: 1)?
78 75 elastic-2.0 | elastic license | elastic license(?: version| v)? 2(?: 0)?
60 60 elastic | elastic license | elastic license
88 95 unlicense | free and unencumbered software | this is free and unencumbered software released into the public domain
60 70 unlicense | unlicense | (?:the )?unlicense
80 80 wtfpl | do what the fuck you want to public license | do what the fuck you want to public license
62 70 wtfpl | wtfpl | wtfpl
88 95 zlib | altered source versions | altered source versions must be plainly marked as such and must not be misrepresented as being the original software
60 70 zlib | zlib | (?:the )?zlib(?: libpng)? license
62 70 libpng | libpng license | libpng license(?: version| v)?(?: 2(?: 0)?)?
60 70 curl | curl license | (?:the )?curl license
60 70 openssl | openssl license | (?:the )?openssl license
60 70 ssleay | ssleay license | (?:original )?ssleay license
60 70 postgresql | postgresql license | (?:the )?postgresql license
80 80 php-3.01 | php license | (?:the )?php license(?: version| v)? 3 01
80 80 php-3.0 | php license | (?:the )?php license(?: version| v)? 3 0
60 60 php | php license | (?:the )?php license
80 80 python-2.0 | python software foundation license | python software foundation license(?: version| v)?(?: 2(?: 0)?)?
60 70 python-2.0 | psf license | psf license(?: agreement)?
60 70 ruby | ruby license | (?:the )?ruby license
60 70 vim | vim license | (?:the )?vim license
60 70 tcl | tcl tk license | tcl tk license
60 70 w3c | w3c software notice and license | w3c software notice and license
60 70 w3c | w3c license | w3c license
60 70 ntp | ntp license | (?:the )?ntp license
60 70 ncsa | university of illinois ncsa | university of illinois ncsa open source license
60 65 ncsa | ncsa | ncsa(?: open source)? license
60 70 icu | icu license | (?:the )?icu license
60 70 unicode | unicode license | unicode license(?: agreement)?
60 70 ijg | independent jpeg group | independent jpeg group(?: license)?
60 70 freetype | freetype license | freetype license
60 70 imagemagick | imagemagick license | imagemagick license
60 70 fair | fair license | (?:the )?fair license
60 70 beerware | beer ware license | (?:the )?beer ware license
60 70 json | shall be used for good not evil | the software shall be used for good not evil
60 70 sleepycat | sleepycat license | sleepycat license
60 70 zope | zope public license | zope public license(?: version| v)?(?: 2 [01])?
60 70 qpl-1.0 | q public license | (?:the )?q public license(?: version| v)?(?: 1 0)?
80 80 osl-3.0 | open software license | open software license(?: version| v)? 3(?: 0)?
60 60 osl | open software license | open software license
80 80 afl-3.0 | academic free license | academic free license(?: version| v)? 3(?: 0)?
60 60 afl | academic free license | academic free license
80 80 ecl-2.0 | educational community license | educational community license(?: version| v)?(?: 2 0)?
80 80 upl-1.0 | universal permissive license | universal permissive license(?: version| v)?(?: 1 0)?
80 80 eupl-1.2 | european union public | european union public licen[cs]e(?: version| v)? 1 2
80 80 eupl-1.1 | european union public | european union public licen[cs]e(?: version| v)? 1 1
60 60 eupl | european union public | european union public licen[cs]e
60 60 eupl | eupl | eupl
80 80 cecill-2.1 | cecill | cecill(?: free software license agreement)?(?: version| v)? 2 1
80 80 cecill-b | cecill b | cecill b
80 80 cecill-c | cecill c | cecill c
60 60 cecill | cecill | cecill
80 80 mulan-psl-2.0 | mulan permissive software license | mulan permissive software license(?: version| v)?(?: 2(?: 0)?)?
80 80 ms-pl | microsoft public license | microsoft public license(?: ms pl)?
80 80 ms-rl | microsoft reciprocal license | microsoft reciprocal license(?: ms rl)?
60 60 ms-limited | microsoft limited public license | microsoft limited public license
80 80 apsl-2.0 | apple public source license | apple public source license(?: version| v)?(?: 2(?: 0)?)?
80 80 nasa-1.3 | nasa open source agreement | nasa open source agreement(?: version| v)?(?: 1 3)?
80 80 npl-1.1 | netscape public license | netscape public license(?: version| v)?(?: 1 [01])?
80 80 spl-1.0 | sun public license | sun public license(?: version| v)?(?: 1 0)?
80 80 sissl | sun industry standards source license | sun industry standards source license
80 80 lppl-1.3c | latex project public license | latex project public license(?: version| v)?(?: 1 3c?)?
60 60 lppl | lppl | lppl
80 80 ofl-1.1 | sil open font license | (?:the )?sil open font license(?: version| v)?(?: 1 1)?
60 60 ofl | open font license | open font license
78 75 ofl-1.1 | ofl 1 1 | ofl 1 1
80 80 ubuntu-font-1.0 | ubuntu font licen | ubuntu font licen[cs]e(?: version| v)?(?: 1 0)?
80 80 bitstream-vera | bitstream vera | bitstream vera(?: fonts)?(?: license| copyright)
84 90 cc-by-nc-nd-4.0 | cc by nc nd 4 0 | cc by nc nd 4 0
84 90 cc-by-nc-sa-4.0 | cc by nc sa 4 0 | cc by nc sa 4 0
84 90 cc-by-nc-nd-3.0 | cc by nc nd 3 0 | cc by nc nd 3 0
84 90 cc-by-nc-sa-3.0 | cc by nc sa 3 0 | cc by nc sa 3 0
82 90 cc-by-nc-4.0 | cc by nc 4 0 | (?:licensed under )?cc by nc 4 0
82 90 cc-by-nc-3.0 | cc by nc 3 0 | (?:licensed under )?cc by nc 3 0
82 90 cc-by-nc-2.5 | cc by nc 2 5 | (?:licensed under )?cc by nc 2 5
82 90 cc-by-nc-2.0 | cc by nc 2 0 | (?:licensed under )?cc by nc 2 0
82 90 cc-by-sa-4.0 | cc by sa 4 0 | (?:licensed under )?cc by sa 4 0
82 90 cc-by-sa-3.0 | cc by sa 3 0 | (?:licensed under )?cc by sa 3 0
82 90 cc-by-sa-2.5 | cc by sa 2 5 | (?:licensed under )?cc by sa 2 5
82 90 cc-by-sa-2.0 | cc by sa 2 0 | (?:licensed under )?cc by sa 2 0
82 90 cc-by-nd-4.0 | cc by nd 4 0 | (?:licensed under )?cc by nd 4 0
82 90 cc-by-nd-3.0 | cc by nd 3 0 | (?:licensed under )?cc by nd 3 0
80 90 cc-by-4.0 | cc by 4 0 | (?:licensed under )?cc by 4 0
80 90 cc-by-3.0 | cc by 3 0 | (?:licensed under )?cc by 3 0
80 90 cc-by-2.5 | cc by 2 5 | (?:licensed under )?cc by 2 5
80 90 cc-by-2.0 | cc by 2 0 | (?:licensed under )?cc by 2 0
70 70 cc-by-nc-nd | cc by nc nd | cc by nc nd
70 70 cc-by-nc-sa | cc by nc sa | cc by nc sa
66 70 cc-by-nc | cc by nc | cc by nc
66 70 cc-by-sa | cc by sa | cc by sa
66 70 cc-by-nd | cc by nd | cc by nd
62 65 cc-by | cc by | cc by
84 90 cc-by-nc-nd-4.0 | creative commons attribution noncommercial noderivatives 4 0 | creative commons attribution noncommercial noderivatives 4 0
84 90 cc-by-nc-sa-4.0 | creative commons attribution noncommercial sharealike 4 0 | creative commons attribution noncommercial sharealike 4 0
82 90 cc-by-nc-4.0 | creative commons attribution noncommercial 4 0 | creative commons attribution noncommercial 4 0
82 90 cc-by-sa-4.0 | creative commons attribution sharealike 4 0 | creative commons attribution sharealike 4 0
82 90 cc-by-sa-3.0 | creative commons attribution sharealike 3 0 | creative commons attribution sharealike 3 0
82 90 cc-by-nd-4.0 | creative commons attribution noderivatives 4 0 | creative commons attribution noderivatives 4 0
80 90 cc-by-4.0 | creative commons attribution 4 0 | creative commons attribution 4 0
80 90 cc-by-3.0 | creative commons attribution 3 0 | creative commons attribution 3 0
66 70 cc-by-nc | creative commons attribution noncommercial | creative commons attribution noncommercial
66 70 cc-by-sa | creative commons attribution sharealike | creative commons attribution sharealike
62 65 cc-by | creative commons attribution | creative commons attribution
60 50 cc | creative commons license | (?:a )?creative commons license
84 90 cc0-1.0 | cc0 1 0 | cc0 1 0(?: universal)?
66 75 cc0-1.0 | cc0 | cc0
80 85 cc0-1.0 | creative commons zero | creative commons zero
80 80 cc-pdm-1.0 | public domain mark | public domain mark(?: 1 0)?
60 60 public-domain | released into the public domain | released into the public domain
60 60 public-domain | dedicated to the public domain | dedicated to the public domain
60 55 public-domain | in the public domain | (?:is|are) in the public domain
80 85 odbl-1.0 | open database license | open database license(?: odbl)?(?: version| v)?(?: 1 0)?
80 85 odc-by-1.0 | open data commons attribution license | open data commons attribution license(?: version| v)?(?: 1 0)?
80 85 pddl-1.0 | public domain dedication and license | (?:open data commons )?public domain dedication and license
80 85 ogl-uk-3.0 | open government licen | open government licen[cs]e(?: version| v)?(?: 3(?: 0)?)?
80 85 cdla-permissive-2.0 | community data license agreement permissive | community data license agreement permissive(?: version| v)?(?: 2 0)?
80 85 cdla-sharing-1.0 | community data license agreement sharing | community data license agreement sharing(?: version| v)?(?: 1 0)?
80 85 openrail | openrail | (?:creativeml |bigscience )?openrail(?: m)?
60 60 blueoak-1.0.0 | blue oak model license | blue oak model license(?: 1 0 0)?
60 60 parity | parity public license | parity public license
60 60 prosperity | prosperity public license | prosperity public license
60 60 polyform | polyform | polyform (?:noncommercial|shield|strict|perimeter)(?: license)?(?: 1 0 0)?
60 60 commons-clause | commons clause | commons clause(?: license condition)?
50 40 proprietary | all rights reserved | all rights reserved
50 45 proprietary | confidential and proprietary | confidential and proprietary
50 45 proprietary | proprietary license | (?:a )?proprietary license
50 40 proprietary | no part of this | no part of this (?:work|book|publication) may be reproduced
50 40 proprietary | end user license agreement | end user license agreement
40 30 unknown-license | licensed under the | licensed under the
40 30 unknown-license | released under the | released under the
40 30 unknown-license | license agreement | license agreement
40 30 unknown-license | spdx license identifier | spdx license identifier
"""
