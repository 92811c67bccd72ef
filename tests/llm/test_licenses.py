"""Published licence texts, wrapped, commented and numbered as they are found in files."""

import textwrap

import pytest

from commentlens.llm import licenses
from oracle.compare import compare

MIT = """MIT License

Copyright (c) 2020 Some Body

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
BSD_2 = """Copyright (c) 2020, Some Body. All rights reserved.

Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
BSD_3 = (
    BSD_2
    + """

3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."""
)
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""
_GNU = """{what} is free software{a} you can redistribute it and/or modify it under the terms of the GNU {kind}General Public License as published by the Free Software Foundation{b} either version {n} of the License, or (at your option) any later version.

{what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""
UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."""
TEXTS = {
    "MIT": MIT,
    "BSD-2-Clause": BSD_2,
    "BSD-3-Clause": BSD_3,
    "ISC": ISC,
    "Apache-2.0": APACHE,
    "GPL-2.0-or-later": _GNU.format(what="This program", a=";", kind="", b=";", n="2"),
    "GPL-3.0-or-later": _GNU.format(what="This program", a=":", kind="", b=",", n="3"),
    "LGPL-2.1-or-later": _GNU.format(what="This library", a=";", kind="Lesser ", b=";", n="2.1"),
    "LGPL-3.0-or-later": _GNU.format(what="This library", a=":", kind="Lesser ", b=",", n="3"),
    "MPL-2.0": MPL,
    "Unlicense": UNLICENSE,
}


def _wrapped(text, width, mark="", first="", last=""):
    lines = [line for part in text.split("\n\n") for line in [*textwrap.wrap(part, width), ""]][:-1]
    return "\n".join([*([first] if first else []), *(f"{mark}{line}".rstrip() if mark else line for line in lines), *([last] if last else [])])


def _forms(text):
    yield text
    yield _wrapped(text, 72)
    yield _wrapped(text, 60, "# ") + "\nimport os\n"
    yield "int x;\n" + _wrapped(text, 76, " * ", "/*", " */") + "\nint y;"
    yield _wrapped(text, 50, "// ").replace("\n", "\r\n")


@pytest.mark.parametrize("name", TEXTS)
def test_published_texts(spark, name):
    rows = list(enumerate(_forms(TEXTS[name])))
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.licenses for r in got} == {i: [name] for i, _ in rows}


def test_notices_between_lines(spark):
    rows = [
        (1, "some words without a stop\nReleased under the MIT License.\nmore words"), (2, "a\nAll rights reserved\nb"), (3, "x\nLicensed under CC BY-NC 4.0"),
        (4, f"{MIT}\n\n{APACHE}"), (5, MIT.replace("free of charge", "free of cost")), (6, "2.0"),
    ]
    got = {r.doc_id: r.licenses for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: ["MIT"], 2: ["Proprietary"], 3: ["CC-BY-NC-4.0"], 4: ["Apache-2.0", "MIT"], 5: [], 6: []}


def test_forms_against_sql(spark, tmp_path):
    import duckdb

    texts = [f for text in TEXTS.values() for f in _forms(text)] + ["", None, "\n\n", "#\n#\n# x", "a.\nb; c: d", "All rights reserved.\n\n" + MIT, "\x1e x"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    assert compare(spark, con, *licenses.QUERIES["op8_licenses"], str(tmp_path)) == ""
