import random
import re

import numpy as np
import pytest

from inkmill.llm.licences import COMMON, ORDINARY, TEMPLATES, UNLISTED, Template, _plain as plain, _tokens, _variants, find_licences, train_licences
from inkmill.llm.queries import QUERIES


@pytest.fixture(scope="module")
def model():
    return train_licences()


@pytest.mark.parametrize("family", TEMPLATES)
def test_templates_name_their_family(model, family):
    for text in map(plain, TEMPLATES[family]):
        for whole in (text, text.upper(), "x y\n" + text, "word " * 500 + text + " word" * 500, "a\n\nb\n" + text + "\nc", text.replace(" ", "\n"), "# " + text.replace(" ", "\n# ")):
            assert [f for _, f, _ in model.scan(whole)] == [family]


#: The usual headers, wrapped as they stand in files.
HEADERS = {
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software""",
    "bsd-3-clause": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions
are met:""",
    "apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at""",
    "gpl-2.0": """This program is free software; you can redistribute it and/or
modify it under the terms of the GNU General Public License
as published by the Free Software Foundation; either version 2
of the License, or (at your option) any later version.""",
    "gpl-3.0": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.""",
    "agpl-3.0": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU Affero General Public License as
published by the Free Software Foundation, either version 3 of the
License, or (at your option) any later version.""",
    "isc": """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.""",
}


@pytest.mark.parametrize("family", HEADERS)
@pytest.mark.parametrize("sign", ["", "# ", " * ", "// "])
def test_headers_wrapped_and_on_one_line(model, family, sign):
    lines = HEADERS[family].split("\n")
    wrapped = "\n".join(sign + x for x in ["Some file of words", "", *lines, "", "more words follow here"])
    assert [f for _, f, _ in model.scan(wrapped)] == [family]
    assert [f for _, f, _ in model.scan(" ".join(lines))] == [family]


@pytest.mark.parametrize(
    "text",
    [
        "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt)",
        "The contents of this file are subject to the terms of the\nCommon Development and Distribution License",
        "Licensed under the EUPL, Version 1.2 or later",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License",
        "copy, distribute and/or modify this document under the terms of the GNU Free Documentation License, Version 1.3",
    ],
)
def test_unseen_licences_are_unknown(model, text):
    assert [f for _, f, _ in model.scan(text)] == ["unknown"]


@pytest.mark.parametrize("family", ["mpl-2.0", "agpl-3.0", "cc-by-sa-4.0", "gpl-2.0", "isc"])
def test_a_family_left_out_of_training_is_never_another(family):
    without = train_licences(left_out=(family,))
    got = [{f for _, f, _ in without.scan(plain(t))} for t in TEMPLATES[family]]
    assert all(f <= {"unknown"} for f in got) and sum(map(bool, got)) >= len(got) / 2


def test_ordinary_and_unlisted(model):
    assert model.scan("mit " * 50) == model.scan("license\nunder\nthe\nmit") == []
    assert [model.scan(t) for t in ORDINARY] == [[]] * len(ORDINARY)
    assert model.scan("The committee licensed under the bridge a new restaurant") == []
    assert model.scan(None) == model.scan("") == model.scan("\n\n") == model.scan(" ".join(COMMON) * 50) == []
    for text in UNLISTED:
        assert [f for _, f, _ in model.scan(text.format("Zanto", "5.2"))] in (["unknown"], [])


def test_neighbouring_lines_state_each_their_own(model):
    text = "All rights reserved.\nLicensed under CC BY-NC 4.0.\nReleased under the MIT License.\n\nReleased under the MIT License."
    assert [(at, f) for at, f, _ in model.scan(text)] == [(0, "cc-by-nc-4.0"), (0, "mit"), (0, "reserved"), (1, "mit")]


def test_template_comparison_against_strings():
    """Key phrases and shares of pairs, by lists of words."""
    rng = random.Random(8)
    split = lambda t: re.findall(r"[a-z0-9]+", t.lower())
    for texts in TEMPLATES.values():
        for text in texts:
            words = split(plain(text))
            for _ in range(20):
                cut = [w for w in words if rng.random() < 0.95] + rng.sample(words, 2)
                spaced = f" {' '.join(cut)} "
                keys = all(f" {' '.join(split(k))} " in spaced for k in re.findall(r"\[(.*?)\]", text))
                pairs = set(zip(words, words[1:], strict=False))
                want = min(1, len(pairs & set(zip(cut, cut[1:], strict=False))) / min(len(pairs), 12)) if keys else 0
                assert Template.of(text).share(_tokens(" ".join(cut))[0]) == pytest.approx(want)


def test_held_out_accuracy_and_calibration(model):
    rows = list(_variants(random.Random(99), 20))
    right, sure = [], []
    for want, text in rows:
        got = model.scan(text)
        name = got[0][1] if got else "none"
        right.append(name == want)
        if got:
            sure.append((got[0][2], want != "none"))
    assert np.mean(right) > 0.95
    p, y = map(np.array, zip(*sure, strict=True))
    assert abs(p.mean() - y.mean()) < 0.03


def test_query_finds_planted_lines(spark):
    sf = "/root/testdata/sf0.1"
    lines = {"This work is licensed under the GNU General Public License, version 3.": "gpl-3.0", "Licensed under CC BY-NC 4.0.": "cc-by-nc-4.0", "Released under the MIT License.": "mit", "Licensed under the Apache License, Version 2.0.": "apache-2.0", "All rights reserved.": "reserved"}
    want = {r.doc_id: ",".join(sorted({f for line, f in lines.items() if line in r.text})) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r.doc_id: r.families for r in QUERIES["op3_licences"](spark, sf).collect()}
    assert set(got) == set(want)
    wrong = [i for i in want if want[i] != got[i]]
    assert wrong == [] and sum(map(bool, want.values())) > 150


def test_edge_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (None, "Released under the MIT License.", "x"), (3, "Released under the MIT License.\n" * 3, "x"), (3, "Released under the MIT License.\n" * 3, "x"), (4, "w " * 200000 + "Licensed under CC BY 4.0.", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, found string")
    got = sorted((str(r.id), [f.family for f in r.found]) for r in find_licences(docs).collect())
    assert got == [("1", []), ("2", []), ("3", ["mit"]), ("3", ["mit"]), ("4", ["cc-by-4.0"]), ("None", ["mit"])]
    assert find_licences(docs.limit(0)).collect() == []
