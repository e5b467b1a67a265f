import random

import pytest
from llm.conftest import DOCUMENT, row, words

from tagtide.llm import licences as L


@pytest.fixture(scope="module")
def model():
    rng = random.Random(2)
    common = "the of and to a in is that for it as with on this be under any or software use license public".split()
    plain = [" ".join(rng.choice(common) if rng.random() < 0.4 else w for w in words(rng, rng.randint(3, 60))) for _ in range(600)]
    return L.train(plain)


@pytest.mark.parametrize("family", list(L.NOTICES))
def test_every_notice_is_found_among_other_words(model, family):
    rng = random.Random(3)
    for notice in L.NOTICES[family]:
        text = "\n".join([" ".join(words(rng, 30)), notice, " ".join(words(rng, 10)) + " " + notice + " " + " ".join(words(rng, 10))])
        spans, predicted, best = L.scan_text(text, model)
        assert {L.FAMILIES[f] for *_, f in spans} == {family} and predicted == 2 and best >= model.least
        start = text.index(notice)
        assert spans[0][:2] == (start, start + len(notice))


def test_other_texts_are_unknown(model):
    rng = random.Random(4)
    for text in (
        "",
        "My driving license is in the public domain of the car, version 3.",
        "The software was released under pressure.",
        "A work of free and open mind, licensed to no one under the sun.",
        *(" ".join(words(rng, 50)) for _ in range(50)),
    ):
        assert L.scan_text(text, model)[0] == []


def test_a_notice_deep_in_a_long_paragraph(model):
    rng = random.Random(5)
    text = " ".join([*words(rng, 5_000), "Released under the MIT License.", *words(rng, 5_000)])
    assert [L.FAMILIES[f] for *_, f in L.scan_text(text, model)[0]] == ["MIT"]


def test_probabilities_add_up_and_unknown_is_calibrated(model):
    found = L.ngrams(L.tokens("Released under the MIT License."))
    family, probability = model.classify(found)
    assert L.FAMILIES[family] == "MIT" and 0.5 <= model.least <= probability <= 1
    assert model.classify(set())[0] == len(L.FAMILIES) - 1


def test_odd_rows(spark, odd, odd_rows, none):
    notice = "Licensed under the Apache License, Version 2.0."
    found = L.report(odd).collect()
    assert sorted((r.doc_id for r in found), key=repr) == sorted((r[0] for r in odd_rows), key=repr)
    assert all(r.licences == "" and r.n_confirmed == 0 for r in found)
    rng = random.Random(6)
    rows = [row(i, " ".join(words(rng, 40)) + (f"\n{notice}" if i % 10 == 0 else "")) for i in range(100)]
    found = {r.doc_id: r for r in L.report(spark.createDataFrame(rows, DOCUMENT).repartition(3)).collect()}
    assert {i for i, r in found.items() if r.licences} == set(range(0, 100, 10))
    assert {r.licences for r in found.values()} == {"", "Apache-2.0"}
    start = rows[0][1].index(notice)
    assert found[0].spans == f"Apache-2.0:{start}:{start + len(notice)}"
    assert L.report(none).collect() == []


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights"""
GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version."""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:"""


@pytest.mark.parametrize("sign", ["", "# ", " * ", "// "])
@pytest.mark.parametrize(("family", "notice"), [("MIT", MIT), ("GPL-3.0", GPL), ("BSD", BSD)])
def test_wrapped_notices(model, family, notice, sign):
    rng = random.Random(7)
    notice = "\n".join(sign + line for line in notice.split("\n"))
    for before in ("\n\n", "\n"):
        text = " ".join(words(rng, 20)) + before + notice + "\n\n" + " ".join(words(rng, 20))
        spans, predicted, best = L.scan_text(text, model)
        start = text.index(notice)
        assert [(s, e, L.FAMILIES[f]) for s, e, f in spans] == [(start, start + len(notice), family)]
        assert predicted == 1 and best >= model.least


@pytest.mark.parametrize(
    ("text", "families"),
    [
        ("Released under the MIT License. Licensed under the Apache License, Version 2.0.", {"MIT", "Apache-2.0"}),
        ("Dual licensed under the MIT License and the Apache License, Version 2.0.", {"MIT", "Apache-2.0"}),
        ("SPDX-License-Identifier: MIT OR Apache-2.0", {"MIT", "Apache-2.0"}),
        ("SPDX-License-Identifier: (BSD-3-Clause AND (LGPL-3.0-only OR MPL-2.0))", {"BSD", "LGPL-3.0", "MPL-2.0"}),
        ("# SPDX-License-Identifier: AGPL-3.0-or-later", {"AGPL-3.0"}),
        ("Licensed under CC BY 3.0.", set()),
        ("Licensed under the GNU Lesser General Public License, version 2.1.", set()),
        ("Licensed under the Apache License, Version 1.1.", set()),
        (GPL.replace("version 3", "version 2"), {"GPL-2.0"}),
        (GPL.replace("GNU General", "GNU Lesser General"), {"LGPL-3.0"}),
        (GPL.replace("GNU General", "GNU Affero General"), {"AGPL-3.0"}),
    ],
)
def test_several_families_and_versions(model, text, families):
    rng = random.Random(8)
    for around in ("", " ".join(words(rng, 12))):
        spans, *_ = L.scan_text(f"{around} {text} {around}", model)
        assert {L.FAMILIES[f] for *_, f in spans} == families


def test_an_expression_of_any_length_is_read_whole(model):
    names = [f"LicenseRef-{i}" for i in range(60)]
    text = "SPDX-License-Identifier: " + " OR ".join(names + ["MIT"]) + " AND Apache-2.0"
    assert {L.FAMILIES[f] for *_, f in L.scan_text(text, model)[0]} == {"MIT", "Apache-2.0"}
    # The expression ends where two names meet.
    cut = "SPDX-License-Identifier: " + " OR ".join(names) + " is not MIT OR Apache-2.0"
    assert L.scan_text(cut, model)[0] == []
