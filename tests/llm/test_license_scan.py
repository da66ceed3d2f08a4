import pytest

from hourgrid.llm import license_scan
from hourgrid.llm.frames import table
from tests.llm.helpers import awkward, empty


@pytest.fixture(scope="module")
def model(spark, sf_dir):
    return license_scan.train(table(spark, sf_dir, "documents", "doc_id", "text"), sample=200)


def test_given_documents_equal_plain_search(spark, sf_dir, model):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    plain = {
        "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
        "MIT": "Released under the MIT License.",
        "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
        "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
        "proprietary": "All rights reserved.",
    }
    want = {(r["doc_id"], k) for r in docs.collect() for k, line in plain.items() if line in (r["text"] or "")}
    assert {(r["doc_id"], r["license"]) for r in license_scan.scan(docs, model).collect()} == want


def test_statements_inside_long_lines_and_other_licences(spark, model):
    prose = "plain words about a harbour and its boats " * 40
    texts = [
        prose + "Licensed under the Apache License, Version 2.0. " + prose,
        "intro\nLicensed under the Wibble Public License, version 7.",
        "The license plate of the car was blue and the mit was red.\nNothing else.",
        prose,
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {}
    for r in license_scan.scan(docs, model).collect():
        found.setdefault(r["doc_id"], set()).add(r["license"])
    assert "Apache-2.0" in found[0]
    assert found[1] == {"unknown"}
    assert found.get(2, {"unknown"}) == {"unknown"} and 3 not in found


MIT = """Permission is hereby granted, free of charge, to any person
obtaining a copy of this software and associated
documentation files (the Software), to deal
in the Software without restriction"""
STATED = {
    MIT: "MIT",
    "Released under GPLv3": "GPL-3.0",
    "Available under MPL 2.0": "MPL-2.0",
    "Dedicated to the public domain": "CC0-1.0",
    "Alle Rechte vorbehalten": "proprietary",
    "Todos los derechos reservados": "proprietary",
    "Redistribution and use in source and binary forms,\n with or without modification, are\n permitted provided that the\nfollowing conditions are met": "BSD",
}


def test_short_wrapped_and_foreign_notices(spark, model):
    docs = spark.createDataFrame(list(enumerate(STATED)), "doc_id long, text string")
    found = {}
    for r in license_scan.scan(docs, model).collect():
        found.setdefault(r["doc_id"], set()).add(r["license"])
    assert found == {i: {family} for i, family in enumerate(STATED.values())}


def test_lines_of_paragraphs(spark, model):
    texts = [f"one two\n\n \t\nthree\n{MIT}", "\n\n" + "word " * 100 + "\nReleased under the MIT License.\n"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = license_scan.scan(docs, model).collect()
    assert {r["line"] for r in rows if r["doc_id"] == 0} == {3}
    # The window that holds all of the notice begins in the line before it.
    assert {r["line"] for r in rows if r["doc_id"] == 1} == {2} and all(r["window"] > 0 for r in rows if r["doc_id"] == 1)


def test_the_gate_loses_no_window(spark, sf_dir, model):
    """The same rows as classifying every window, on the given documents and on windows of mixed common and gate words."""
    gate = model.gate_words()
    assert gate and len(gate) < len(model.vectors.vocabulary)
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    usual = sorted(model.usual, key=model.usual.get, reverse=True)[:300]
    some = [w for w in usual if w not in gate]
    texts = [" ".join((some[i:] + some[:i])[:48]) for i in range(0, len(some), 3)]
    texts += [" ".join([*some[i : i + 20], w, *some[i + 20 : i + 27]]) for i, w in enumerate(gate)]
    mixed = docs.unionByName(spark.createDataFrame([(10**9 + i, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    rows = [sorted(map(tuple, license_scan.scan(mixed, model, gated=g).collect())) for g in (True, False)]
    assert rows[0] == rows[1]


def test_awkward_rows_and_empty_table(spark, model):
    assert license_scan.scan(awkward(spark), model).count() == 0
    assert license_scan.scan(empty(spark), model).count() == 0
    assert license_scan.train(empty(spark), sample=5).families
