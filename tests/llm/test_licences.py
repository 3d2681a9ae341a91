import textwrap

import pytest

from blocktide.llm import sql
from blocktide.llm.licences import SENTENCES, scan_licences
from blocktide.llm.queries import QUERIES
from tests.compare import compare, duck
from tests.llm.cases import ODD_ROWS, SMALL, by_id, documents, no_documents, odd_documents


def said(identifier):
    return next(s for s, i in SENTENCES.items() if i == identifier).capitalize() + "."


def test_query_equals_sql(spark):
    name = "op6_licences"
    assert compare(spark, duck(SMALL), name, QUERIES[name], sql.ORACLE[name], SMALL) is None


def test_rules_need_order(spark):
    bsd = [said(i) for i in ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names")]
    mit = [said(i) for i in ("mit-grant", "mit-notice", "mit-warranty")]
    rows = by_id(
        scan_licences(
            documents(
                spark,
                [
                    " ".join(bsd),
                    "\n".join(bsd[:3]),
                    " ".join(reversed(bsd)),
                    "Foo bar. " + " Something else! ".join(mit) + " All rights reserved.",
                    "Licensed under CC BY-NC 4.0.\nLICENSED  under the apache license, VERSION 2.0. End.",
                    "We like the MIT License. It is short.",
                ],
            )
        )
    )
    assert rows[0].licences == "BSD-3-Clause"
    assert rows[1].licences == "BSD-2-Clause"
    assert rows[2].licences == ""
    assert rows[3].licences == "MIT" and rows[3].n_known == 4
    assert rows[4].licences == "Apache-2.0,CC-BY-NC-4.0" and rows[4].n_sentences == 3
    assert rows[5].licences == "" and rows[5].n_known == 0


def test_odd_rows(spark):
    rows = scan_licences(odd_documents(spark)).collect()
    assert len(rows) == len(ODD_ROWS)
    assert all(r.licences == "" for r in rows)
    assert all(r.n_sentences == 0 for r in rows if r.doc_id in (3, 4))
    assert scan_licences(no_documents(spark)).count() == 0


def test_plan_has_no_shuffle_and_no_python(spark):
    plan = scan_licences(odd_documents(spark).coalesce(1))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan


MIT = """MIT License

Copyright (c) 2020 Some One

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE."""
GPL = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU General Public License for more details."""
BSD2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
BSD3 = f"""{BSD2}
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."""


@pytest.mark.parametrize("mark", ["", " * ", "# ", "// "])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_wrapped_texts(spark, mark, end):
    def wrapped(text, width):
        lines = [part for line in text.split("\n") for part in textwrap.wrap(line, width) or [""]]
        return end.join(mark + line for line in lines)

    texts = [wrapped(t, width) for width in (70, 79) for t in (MIT, GPL, BSD2, BSD3)]
    broken = wrapped(GPL, 70).replace("Foundation", f"Foundation{end}{mark}{end}")  # a blank line ends a sentence
    rows = by_id(scan_licences(documents(spark, [*texts, broken])))
    want = ["MIT", "GPL-3.0-or-later", "BSD-2-Clause", "BSD-3-Clause"]
    assert [rows[i].licences for i in range(8)] == want * 2
    assert rows[0].sentence_ids == "mit-title,mit-grant,mit-notice,mit-warranty"
    assert rows[8].licences == "" and rows[8].sentence_ids == "gpl-warranty"
