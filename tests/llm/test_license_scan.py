"""Licence scans: wrapped sentences, ordered rules, odd rows."""

from vigie.llm import license_scan as L

MIT = "\n\n".join(L.SENTENCES[k] + "." for k in ("mit-grant", "mit-notice", "mit-as-is"))
BSD = "\n".join([L.SENTENCES["bsd-forms"] + ":", "1. " + L.SENTENCES["bsd-source"] + ".", "2. " + L.SENTENCES["bsd-binary"] + ".",
                 "3. " + L.SENTENCES["bsd-name"] + "."])


def wrap(text, width=40):
    out, line = [], ""
    for w in text.split(" "):
        if len(line) + len(w) > width:
            out.append(line)
            line = ""
        line = f"{line} {w}".strip()
    return "\n # ".join([*out, line])


CASES = [
    ("prose. Released under the MIT License. More", ["MIT"], ["released-mit"], 1),
    ("no end before\nLicensed under CC BY-NC 4.0\nno end after", ["CC-BY-NC-4.0"], ["licensed-cc-by-nc-4"], 1),
    ("is it released under the MIT license? not a sentence", [], [], 0),
    ("LICENSED UNDER THE APACHE LICENSE, VERSION 2.0!", ["Apache-2.0"], ["licensed-apache-2"], 1),
    (MIT, ["MIT"], ["mit-grant", "mit-notice", "mit-as-is"], 1),
    (wrap(MIT.replace("\n\n", " ")), ["MIT"], ["mit-grant", "mit-notice", "mit-as-is"], 1),
    ("\n\n".join(MIT.split("\n\n")[::-1]), [], ["mit-as-is", "mit-notice", "mit-grant"], 0),
    (BSD, ["BSD-3-Clause"], ["bsd-forms", "bsd-source", "bsd-binary", "bsd-name"], 1),
    (BSD.rsplit("\n", 1)[0] + "\nReleased under the MIT License.", ["BSD-2-Clause", "MIT"],
     ["bsd-forms", "bsd-source", "bsd-binary", "released-mit"], 2),
    ("Released under the MIT License. Released under the MIT License.", ["MIT"], ["released-mit"] * 2, 2),
    (wrap(L.SENTENCES["gpl-2-later"] + "."), ["GPL-2.0-or-later"], ["gpl-2-later"], 1),
    ('Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
     ["Apache-2.0"], ["licensed-apache-2-defined", "apache-2-compliance"], 1),
    ("// SPDX-License-Identifier: BSD-3-Clause\ncode", ["BSD-3-Clause"], ["spdx-bsd-3"], 1),
    ("", [], [], 0), (None, [], [], 0), ("...", [], [], 0), ("Licensed", [], [], 0),
]


def test_cases(spark):
    df = spark.createDataFrame([(i, t, 4, "x") for i, (t, *_) in enumerate(CASES)] + [(99, CASES[0][0], 4, "x"), (None, MIT, 1, None)],
                               "doc_id long, text string, n_matches int, sentence string")
    got = {r.doc_id: r for r in L.scan(df).collect()}
    for i, (t, lic, ids, n) in enumerate(CASES):
        assert (got[i].licences, got[i].sentence_ids, got[i].n_matches, got[i].n_sentences) == (lic, ids, n, len(ids)), t
    assert got[99].licences == ["MIT"] and got[None].licences == ["MIT"] and got[0].sentence == "x" and got[0].text == CASES[0][0]


def test_no_rows_no_rules(spark):
    df = spark.createDataFrame([(1, "Released under the MIT License.")], "doc_id long, text string")
    assert L.scan(df.where("false")).count() == 0
    r = L.scan(df, rules=(("none", ()),)).first()
    assert r.licences == [] and r.sentence_ids == ["released-mit"]


def test_a_long_text(spark):
    text = ("licensed\n" * 20000) + "Released under the MIT License.\n" + "x y z. " * 50000
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert L.scan(df).first().licences == ["MIT"]
