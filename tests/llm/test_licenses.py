from plain import ALNUM_WORDS, ODD_ROWS, docs, lower

from partyfold.llm import license_rules, licenses


def base_places(text):
    words = ALNUM_WORDS.findall(lower(text))
    found = []
    for phrase, label in license_rules.BASE_PHRASES:
        own = phrase.split()
        found += [(k, label) for k in range(len(words)) if words[k : k + len(own)] == own]
    return len(words), found


ROWS = [
    *ODD_ROWS,
    (20, "MIT License. GNU General-Public\tLICENSE; apache license"),
    (21, "Licensed under CC BY-SA 4.0 and cc by; CC BY."),
    (22, "SPDX-License-Identifier: Apache-2.0"),
    (23, "Permission is hereby granted, free of charge, to any person obtaining a copy"),
    (24, "mit der lizenz, by the license of nature"),
    (25, "filler " * 5000 + "MIT license"),
    (26, "This program is free software: you can redistribute it and/or modify it. GPL v3 or later"),
]


def test_base_phrases_are_all_found(spark):
    found = {str((r["doc_id"], r["n_words"])): r for r in licenses.license_summary(docs(spark, ROWS)).collect()}
    for doc_id, text in ROWS:
        count, places = base_places(text)
        row = found[str((doc_id, count))]
        assert row["n_base"] == len(places)
        assert (row["first_word"], row["last_word"]) == (
            (min(places)[0], max(places)[0]) if places else (None, None)
        )
        labels = {label for _, label in places}
        assert row["base_labels"] == ",".join(sorted(labels))
        assert labels <= set(row["labels"].split(",")) | {""}
        assert 0 <= row["score"] <= 1


def test_labels_of_the_rules(spark):
    found = {r["doc_id"]: r for r in licenses.license_summary(docs(spark, ROWS)).collect()}
    assert found[21]["labels"] == "cc-by,cc-by-sa"
    assert found[22]["labels"] == "apache" and found[22]["score"] == 0.99
    assert found[23]["labels"] == "mit" and found[23]["base_labels"] == ""
    assert found[24]["labels"] == "" and found[24]["score"] == 0
    assert found[26]["labels"].split(",")[0].startswith("gpl")


def test_contained_intervals_are_suppressed():
    words = b"licensed under the apache license version 2 0".split()
    tried = [r for r in license_rules.rules() if r.label == "apache"]
    found = licenses.detections(words, tried)
    standing = [d for d in found if not d["suppressed"]]
    assert [(d["first_word"], d["end_word"]) for d in standing] == [(0, 8)]
    assert [d["rule"] for d in found if d["suppressed"]] == ["base-apache"]


def test_the_prefilter_loses_nothing(spark):
    texts = [t for _, t in ROWS if t]
    every = [Everything for Everything in license_rules.rules()]
    for text in texts:
        own = [w.encode() for w in ALNUM_WORDS.findall(lower(text))]
        present = set(own)
        gated = [r for r in every if all(k.encode() in present for k in r.keywords)]
        assert licenses.detections(own, gated) == licenses.detections(own, every)


def test_empty_table(spark):
    assert licenses.license_summary(docs(spark, [])).count() == 0


def test_there_are_hundreds_of_rules_with_names_of_their_own():
    names = [r.name for r in license_rules.rules()]
    assert len(names) == len(set(names)) >= 300


def test_names_in_one_word_are_found(spark):
    rows = [
        (1, "released under GPLv2+ or LGPLv2.1"), (2, "AGPLv3 only"), (3, "Apache2.0 or BSD3-clause"),
        (4, "the word gplv2x is no licence"), (5, "MPL2 and EPLv2, CCBY 4.0"),
    ]
    found = {r["doc_id"]: r for r in licenses.license_summary(docs(spark, rows)).collect()}
    assert found[1]["labels"] == "gpl-2,lgpl-2" and found[1]["base_labels"] == ""
    assert found[2]["labels"] == "agpl-3"
    assert found[3]["labels"] == "apache,bsd"
    assert found[4]["labels"] == ""
    assert found[5]["labels"] == "cc-by,epl,mpl"
