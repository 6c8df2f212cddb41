import textwrap

import pytest
from cases import clashing, collected, documents, passage, rows

from daytally.llm.licences import FAMILIES, TEMPLATES, TITLES, licences, train

COLUMNS = ("doc_id", "n_notices", "families", "spans")


@pytest.fixture(scope="module")
def model(spark):
    return train(documents(spark, [(k, passage(k, 200).replace(" eta", "\n")) for k in range(100)]))


def test_every_template_is_found_alone_and_among_prose(spark, model):
    texts = [(k, family, text) for k, (family, text) in enumerate((f, t) for f in FAMILIES for t in TEMPLATES[f])]
    alone = documents(spark, [(k, f"é {passage(k, 30)}\n{t}\n{passage(k + 1, 30)}") for k, _, t in texts])
    got = {r.doc_id: r for r in licences(alone, model).collect()}
    assert {k: got[k].families for k, *_ in texts} == {k: f for k, f, _ in texts}
    for k, family, text in texts:
        start = len(f"é {passage(k, 30)}\n")
        a, b = map(int, got[k].spans.split(":")[1:])
        assert a == start and start + len(text) - 3 <= b <= start + len(text)


def test_ordinary_text_holds_none(spark, model):
    texts = [passage(k, 300) for k in range(1000, 1050)] + [
        "the licence of the driver was revoked by the police", "I like the general public and the apache helicopter",
        "permission to leave was granted free of charge", "all rights and all wrongs"]
    assert {r.n_notices for r in licences(documents(spark, list(enumerate(texts))), model).collect()} == {0}


def test_a_notice_inside_a_long_line(spark, model):
    text = passage(7, 200) + " this work is licensed under the GNU General Public License, version 3. " + passage(8, 200)
    assert licences(documents(spark, [(1, text)]), model).first().families == "GPL"


def test_edge_cases_and_extra_columns(spark, model):
    want = sorted([(r[0], 0, "", "") for r in rows()], key=repr)
    assert collected(licences(documents(spark), model), *COLUMNS) == want
    assert collected(licences(clashing(spark)), *COLUMNS) == want
    assert licences(documents(spark, [])).count() == 0


WRAPPED = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:""",
    "BSD": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.""",
    "Apache-2.0": """you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0""",
    "GPL": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.""",
    "LGPL": """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.""",
}


@pytest.mark.parametrize("mark", ["", "# ", " * ", "// "])
def test_wrapped_notices_and_comments(spark, model, mark):
    texts = {k: (f, passage(k, 30) + "\n\n" + "\n".join(mark + line for line in text.split("\n")) + "\n\n" + passage(k + 9, 30))
             for k, (f, text) in enumerate(WRAPPED.items())}
    got = licences(documents(spark, [(k, text) for k, (_, text) in texts.items()]), model).collect()
    assert {r.doc_id: r.families for r in got} == {k: f for k, (f, _) in texts.items()}


@pytest.mark.parametrize("width", [25, 40])
def test_notices_wrapped_narrowly_without_blank_lines(spark, model, width):
    texts = [(f, "import os\n" + textwrap.fill(" ".join(text.split()), width) + "\ndef main():\n    return 1")
             for f, text in WRAPPED.items()]
    got = licences(documents(spark, [(k, text) for k, (_, text) in enumerate(texts)]), model).collect()
    assert {r.doc_id: r.families for r in got} == {k: f for k, (f, _) in enumerate(texts)}


def test_tags_and_titles(spark, model):
    tags = {"MIT": "MIT", "Apache-2.0": "Apache-2.0", "GPL-2.0-only": "GPL", "LGPL-2.1-or-later": "LGPL", "AGPL-3.0": "AGPL",
            "BSD-3-Clause": "BSD", "MPL-2.0": "MPL-2.0", "ISC": "ISC", "CC-BY-NC-4.0": "CC-BY-NC", "CC-BY-SA-4.0": "CC-BY-SA",
            "CC-BY-4.0": "CC-BY", "CC0-1.0": "CC0", "Unlicense": "Unlicense"}
    lines = [(f"// SPDX-License-Identifier: {tag}", f) for tag, f in tags.items()]
    lines += [(f"# {title}", f) for f, titles in TITLES.items() for title in titles]
    docs = documents(spark, [(k, f"{line}\n\n{passage(k, 60)}") for k, (line, _) in enumerate(lines)])
    got = {r.doc_id: r.families for r in licences(docs, model).collect()}
    assert [(line, got[k]) for k, (line, _) in enumerate(lines)] == lines
    pair = documents(spark, [(1, "# SPDX-License-Identifier: (MIT OR Apache-2.0)"), (2, "/* SPDX-License-Identifier: EPL-3.0-or-later */")])
    assert {r.doc_id: r.families for r in licences(pair, model).collect()} == {1: "Apache-2.0,MIT", 2: ""}
    text = "they spoke of the MIT license and of the GNU General Public License all day"
    assert licences(documents(spark, [(1, text)]), model).first().n_notices == 0
