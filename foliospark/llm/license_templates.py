"""Phrases and license templates in markup. Wording that the licenses themselves state.

``<<beginOptional>> ... <<endOptional>>`` may be left out, ``<<var;words=1-8>>`` stands for that many words,
``<<var;words=1-1;match=[0-9]+>>`` for words of a pattern.
"""

PHRASES = [("mit", "MIT License"), ("apache", "Apache License"), ("gpl", "General Public License")]

_VERSION = "<<beginOptional>>version<<endOptional>> <<var;words=1-2;match=[0-9]+>>"

MIT_GRANT = """
Permission is hereby granted, free of charge, to any person obtaining a copy of <<var;words=1-6>> (the
"<<var;words=1-3>>"), to deal in the <<var;words=1-3>> without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the <<var;words=1-3>>, and to
permit persons to whom the <<var;words=1-3>> is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice <<beginOptional>>(including the next paragraph)<<endOptional>>
shall be included in all copies or substantial portions of the <<var;words=1-3>>.
"""

ISC_GRANT = """
Permission to use, copy, modify, and<<beginOptional>>/or<<endOptional>> distribute this software for any purpose with
or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all
copies.
"""

BSD_CONDITIONS = """
Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: <<beginOptional>>1.<<endOptional>> Redistributions of source code must retain the above
copyright notice, this list of conditions and the following disclaimer. <<beginOptional>>2.<<endOptional>>
Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
"""

BSD_ENDORSEMENT = """
<<beginOptional>>3.<<endOptional>> Neither the name of <<var;words=1-12>> nor the names of its contributors may be used
to endorse or promote products derived from this software without specific prior written permission.
"""

ZLIB_GRANT = """
This software is provided 'as-is', without any express or implied warranty. In no event will the
<<var;words=1-2;match=authors?|s>> be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter
it and redistribute it freely, subject to the following restrictions:
"""

UNLICENSE_GRANT = """
This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use,
compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose,
commercial or non-commercial, and by any means.
"""

GPL_GRANT = """
This <<var;words=1-3>> is free software<<beginOptional>>:<<endOptional>> you can redistribute it and/or modify it under
the terms of the GNU General Public License as published by the Free Software Foundation,
<<beginOptional>>either<<endOptional>> version <<var;words=1-1;match=[0-9]+>>
"""

TEMPLATES = [
    ("mit", MIT_GRANT),
    ("isc", ISC_GRANT),
    ("bsd-2-clause", BSD_CONDITIONS),
    ("bsd-3-clause", BSD_CONDITIONS + BSD_ENDORSEMENT),
    ("zlib", ZLIB_GRANT),
    ("unlicense", UNLICENSE_GRANT),
    ("gpl", GPL_GRANT),
    ("mit", "Licensed under <<beginOptional>>the terms of<<endOptional>> the MIT License"),
    ("mit", "Released under <<beginOptional>>the terms of<<endOptional>> the MIT License"),
    ("apache", "Licensed under the Apache License<<beginOptional>>, " + _VERSION + "<<endOptional>>"),
    ("apache-2.0", "Licensed under the Apache License, <<beginOptional>>Version<<endOptional>> 2.0"),
    ("gpl", "Licensed under <<beginOptional>>the terms of<<endOptional>> the <<beginOptional>>GNU<<endOptional>> General Public License"),
    ("gpl-2.0", "Licensed under <<beginOptional>>the terms of<<endOptional>> the GNU General Public License<<beginOptional>> version<<endOptional>> 2"),
    ("gpl-3.0", "Licensed under <<beginOptional>>the terms of<<endOptional>> the GNU General Public License<<beginOptional>> version<<endOptional>> 3"),
    ("cc-by", "Licensed under <<beginOptional>>a Creative Commons<<endOptional>> CC BY " + _VERSION),
    ("cc-by-sa", "Licensed under <<beginOptional>>a Creative Commons<<endOptional>> CC BY-SA " + _VERSION),
    ("cc-by-nc", "Licensed under <<beginOptional>>a Creative Commons<<endOptional>> CC BY-NC " + _VERSION),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. <<var;words=2-2;match=[0-9]+>>"),
]
