import re

from pyspark.sql import functions as F

from clientlens.llm import licenses

from .helpers import LONG, awkward, empty

MIT = """Permission is hereby granted. The above copyright notice and this permission
notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""


def _found(spark, texts):
    df, name = licenses.scan(awkward(spark, list(enumerate(texts))))
    return {r.doc_id: r[name] for r in df.collect()}


def test_known_sentences_are_normalised():
    assert all(re.fullmatch(r"[0-9a-z]+( [0-9a-z]+)*", s) for s in licenses.SENTENCES.values())
    assert all(i in licenses.SENTENCES for _, rule in licenses.RULES for i in rule)


def test_tags_headers_and_wrapped_texts(spark):
    got = _found(spark, [
        "Intro.\nLicensed under the Apache License, Version 2.0.\nMore text.",
        "# SPDX-License-Identifier: MIT\ncode()",
        MIT,
        "Released under the MIT License. Licensed under CC BY-NC 4.0.",
        "THE SOFTWARE IS PROVIDED as is. The above copyright notice and this permission notice shall be included in all copies.",
        "we were not licensed under the MIT License at all",
        None, "", "!!!", "\n\n", LONG + ".\nReleased under the MIT License",
    ])
    assert [list(got[i].licenses) for i in range(11)] == [
        ["Apache-2.0"], ["MIT"], ["MIT"], ["CC-BY-NC-4.0", "MIT"], [], [], [], [], [], [], ["MIT"]]
    assert got[0].sentences == 3 and list(got[0].known) == ["apache-2-licensed-under"]
    assert got[6].sentences == got[7].sentences == got[8].sentences == 0


def test_sentences_must_follow_the_rule_order(spark):
    s = licenses.SENTENCES
    forward = ". ".join(s[i] for i in ("mit-notice", "mit-as-is", "mit-liability"))
    backward = ". ".join(s[i] for i in ("mit-liability", "mit-as-is", "mit-notice"))
    between = ". ".join([s["mit-notice"], "some other words", s["mit-as-is"], s["mit-liability"]])
    got = _found(spark, [forward, backward, between])
    assert [list(got[i].licenses) for i in range(3)] == [["MIT"], [], ["MIT"]]


def test_awkward_and_empty(spark):
    df, name = licenses.scan(awkward(spark))
    assert df.count() == awkward(spark).count() and set(awkward(spark).columns) < set(df.columns)
    assert df.filter(F.size(F.col(name)["licenses"]) > 0).count() == 0
    df, name = licenses.scan(empty(spark))
    assert df.count() == 0


APACHE_HEADER = """Copyright 2020 Someone. All rights reserved.

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""
MIT_WHOLE = """MIT License

Copyright (c) 2020 Someone

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

""" + MIT.split(". ", 1)[1]
BSD_3 = """Copyright (c) 2020, Someone
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED.
"""
LGPL = """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.
"""


def test_whole_texts_headers_and_expressions(spark):
    texts = {
        APACHE_HEADER: ["Apache-2.0"], MIT_WHOLE: ["MIT"], BSD_3: ["BSD-3-Clause"],
        BSD_3.replace("3. Neither", "Neither").split("Neither")[0] + BSD_3[BSD_3.index("THIS SOFTWARE"):]: ["BSD-2-Clause"],
        "Copyright Someone. All rights reserved.": ["proprietary"],
        LGPL: ["LGPL-2.1-or-later"],
        "                                 Apache License\n                           Version 2.0, January 2004\n": ["Apache-2.0"],
        "GNU AFFERO GENERAL PUBLIC LICENSE\n   Version 3, 19 November 2007\n": ["AGPL-3.0"],
        "GNU LESSER GENERAL PUBLIC LICENSE\n   Version 3, 29 June 2007\n": ["LGPL-3.0"],
        "// SPDX-License-Identifier: MIT OR Apache-2.0": ["Apache-2.0", "MIT"],
        "# SPDX-License-Identifier: (GPL-3.0-or-later AND MIT) OR LGPL-2.1-only": ["GPL-3.0-or-later", "LGPL-2.1", "MIT"],
        "SPDX-License-Identifier: AGPL-3.0-or-later": ["AGPL-3.0-or-later"],
        "SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0": ["GPL-2.0"],
        "SPDX-License-Identifier: LicenseRef-own OR nothing": [],
    }
    got = _found(spark, list(texts))
    assert {t: list(got[i].licenses) for i, t in enumerate(texts)} == texts
