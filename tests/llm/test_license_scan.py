import re

from helpers import ODD_TEXTS, docs_frame, words
from martflow.llm.license_scan import CONTAINED, LICENSES, TEMPLATES, scan


def pairs(text):
    w = re.findall("[a-z0-9]+", text.lower())
    return set(zip(w, w[1:]))


def test_licenses_are_found_anywhere(spark):
    import random
    rng = random.Random(3)
    rows = [(i, f"{words(rng, rng.randrange(0, 60))}\n{t.upper() if i % 2 else t}\n{words(rng, rng.randrange(0, 60))}")
            for i, t in enumerate(TEMPLATES.values())]
    rows += [(50, "the rights and the license"), (51, "all rights"), (52, TEMPLATES["mit"] + " " + TEMPLATES["apache-2.0"])]
    rows += [(100 + i, t) for i, t, _ in ODD_TEXTS]
    got = {r["doc_id"]: r["licenses"] for r in scan(docs_frame(spark, rows, extra=True).drop("size")).collect()}
    want = {i: sorted(n for n, t in TEMPLATES.items()
                      if len(pairs(t) & pairs(text or "")) >= CONTAINED * len(pairs(t))) for i, text in rows}
    assert got == want and got[52] == ["apache-2.0", "mit"]
    assert scan(docs_frame(spark, [])).count() == 0


LINES = {
    "This work is licensed under the GNU General Public License, version 3.": "gpl-3.0",
    "Released under the MIT License.": "mit", "Licensed under CC BY-NC 4.0.": "cc-by-nc-4.0",
    "Licensed under the Apache License, Version 2.0.": "apache-2.0", "All rights reserved.": "all-rights-reserved",
    "This file is released under CC BY-SA 4.0.": "cc-by-sa-4.0", "# SPDX-License-Identifier: MPL-2.0": "mpl-2.0",
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that": "bsd",
    "the terms of the GNU Affero General Public License": "agpl-3.0", "Our GNU Lesser General Public License": "lgpl",
}


def test_usual_lines_and_every_template_name_their_license(spark):
    rows = [(i, f"some words before\n{t}\nand some after") for i, t in enumerate(LINES)]
    every = [(n, t) for n, texts in LICENSES.items() for t in texts]
    rows += [(100 + i, t) for i, (_, t) in enumerate(every)]
    got = {r["doc_id"]: r["licenses"] for r in scan(docs_frame(spark, rows)).collect()}
    assert [got[i] for i in range(len(LINES))] == [[n] for n in LINES.values()]
    assert [n for i, (n, _) in enumerate(every) if n not in got[100 + i]] == []


def test_templates_of_the_caller_need_no_telling_word_and_may_have_inserted_words(spark):
    t = " ".join(f"t{i}" for i in range(40))
    torn = t.replace("t10 ", "t10 x y ").replace("t20 ", "t20 z z2 z3 ").replace("t30 ", "t30 u ")
    rows = [(0, "a b " + t), (1, f"q r s {torn} end"), (2, " ".join(t.split()[:20]))]
    got = {r["doc_id"]: r["licenses"] for r in scan(docs_frame(spark, rows), {"own": t}).collect()}
    assert got == {0: ["own"], 1: ["own"], 2: []}
