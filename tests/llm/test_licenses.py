from collections import Counter
from importlib.metadata import PackageNotFoundError, files
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from civiclake.llm import licenses

SHIPPED = Path("/usr/share/common-licenses")
FILES = {
    "Apache-2.0": "Apache-2.0", "Artistic-1.0-Perl": "Artistic", "CC0-1.0": "CC0-1.0", "GFDL-1.2": "GFDL-1.2", "GFDL-1.3": "GFDL-1.3",
    "GPL-1.0": "GPL-1", "GPL-2.0": "GPL-2", "GPL-3.0": "GPL-3", "LGPL-2.0": "LGPL-2", "LGPL-2.1": "LGPL-2.1", "LGPL-3.0": "LGPL-3",
    "MPL-1.1": "MPL-1.1", "MPL-2.0": "MPL-2.0",
}
END = "END OF TERMS AND CONDITIONS"


def _forms(text):
    yield text
    if END in text:
        yield text[:text.index(END)]
        yield text[:text.index(END)] + END


def test_digests_of_shipped_licenses(spark):
    if not all((SHIPPED / name).exists() for name in FILES.values()):
        pytest.skip("no licenses shipped here")
    rows = [(name, form) for name, file in FILES.items() for form in _forms((SHIPPED / file).read_text(errors="replace"))]
    found = spark.createDataFrame(rows, "license string, text string").select(
        "license", licenses.digest(licenses.canonical_lines(F.col("text")))
    )
    assert set(map(tuple, found.collect())) == set(licenses.DIGESTS)
    docs = spark.createDataFrame([(k, form.upper()) for k, (_, form) in enumerate(rows)], "doc_id long, text string")
    assert {r["doc_id"]: r["license"] for r in licenses.result(docs).collect()} == {k: name for k, (name, _) in enumerate(rows)}


def test_license_files_of_libraries(spark):
    """Files as their authors wrote them, each with its own copyright lines and title."""
    expected = {"attrs": "MIT", "pluggy": "MIT", "idna": "BSD-3-Clause", "pygments": "BSD-2-Clause", "requests": "Apache-2.0", "urllib3": "MIT"}
    rows = []
    for package, name in expected.items():
        try:
            rows += [(name, x.read_text()) for x in files(package) or [] if x.name.split(".")[0] == "LICENSE"]
        except PackageNotFoundError:
            pass
    docs = spark.createDataFrame([(k, text) for k, (_, text) in enumerate(rows)], "doc_id long, text string")
    assert {r["doc_id"]: r["license"] for r in licenses.result(docs).collect()} == {k: name for k, (name, _) in enumerate(rows)}


def test_titles_and_lines_about_copyright(spark):
    mit = licenses.LICENSES[9][1]
    wrapped = mit.replace(" COPYRIGHT HOLDERS", "\nCOPYRIGHT HOLDERS").replace(" copyright notice", "\ncopyright notice")
    docs = spark.createDataFrame([
        (1, "MIT License\n\nCopyright (c) 2020 Somebody\n\n" + mit), (2, "The MIT License (MIT)\n© The Authors\n" + wrapped),
        (3, "Copyright Somebody\nMIT License\n" + wrapped), (4, "Some License\n" + mit),
    ], "doc_id long, text string")
    found = {r["doc_id"]: r["license"] for r in licenses.result(docs).collect()}
    assert found == {1: "MIT", 2: "MIT", 3: "MIT", 4: None}


def test_equivalent_texts(spark):
    docs = spark.createDataFrame([
        (1, "Copyright (c) 2020 Somebody\nAll rights reserved.\n\n" + licenses.LICENSES[9][1].upper().replace(", ", " ,  "), "l"),
        (2, "Some prose.\n  ** licensed under the Apache licence -- version 2.0 **\nMore. \nReleased under the MIT License.", "l"),
        (2, "Some prose.\n  ** licensed under the Apache licence -- version 2.0 **\nMore. \nReleased under the MIT License.", "l"),
        (3, None, "l"), (4, "", "l"), (None, "© 2020 x\nReleased under the MIT licence", "l"), (5, "Copyright 2001", "l"),
    ], "doc_id long, text string, license string").repartition(3)
    found = Counter((r["doc_id"], r["license"], r["n_notices"], r["notices"]) for r in licenses.result(docs).collect())
    assert found == Counter({
        (1, "MIT", 0, ""): 1, (2, None, 2, "Apache-2.0,MIT"): 2, (3, None, 0, ""): 1, (4, None, 0, ""): 1,
        (None, "MIT", 1, "MIT"): 1, (5, None, 0, ""): 1,
    })


def test_whole_text_digest(spark):
    text = "Copyright 2020 A\n" + licenses.LICENSES[9][1].replace("\n", " ") + "\n"
    row = licenses.result(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (row["license"], row["notices"]) == ("MIT", "MIT")  # the whole text, and its only line


def test_known_texts_without_words_and_ties(spark):
    known = spark.createDataFrame([("b", "Some text!"), ("a", "some TEXT"), ("c", "!!"), (None, None)], "license string, text string")
    docs = spark.createDataFrame([(1, "some text"), (2, "")], "doc_id long, text string")
    assert {(r["doc_id"], r["license"]) for r in licenses.scan(docs, known).collect()} == {(1, "a"), (2, None)}


def test_edge_documents(edge_docs, no_docs):
    found = licenses.result(edge_docs).collect()
    assert Counter(r["doc_id"] for r in found) == Counter(r["doc_id"] for r in edge_docs.collect())
    assert licenses.result(no_docs).collect() == []
