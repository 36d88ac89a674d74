import re

import duckdb

from tallyward.llm import licences
from tallyward.llm.oracle import OP9
from tests.llm.conftest import documents

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}
TEXTS = [
    "cc by cc-by CC/BY cc byx xcc by",
    "All rights reserved. ALL RIGHTS\nRESERVED all rights",
    "Released under the MIT License.",
    "This work is licensed under the GNU General Public License, version 3.",
    "Licensed under the Apache License, Version 2.0. Licensed under CC BY-NC 4.0.",
    "the license of the public is general",
    "ÉCC BY",
    "",
    None,
]


def _brute(text):
    words = WORD.findall((text or "").translate(UPPER))
    places, labels = [], set()
    for phrase, label in licences.BASE_PHRASES.items():
        own = phrase.split()
        for k in range(len(words) - len(own) + 1):
            if words[k : k + len(own)] == own:
                places.append(k)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_base(spark):
    given = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    rows = [(-1 - k, t) for k, t in enumerate(TEXTS)] + [tuple(r) for r in given]
    got = {r.doc_id: r for r in licences.digest(licences.scan_licences(documents(spark, rows))).collect()}
    for k, text in rows:
        r = got[k]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == _brute(text)
        assert 0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))


def test_labels(spark):
    rows = list(enumerate(TEXTS)) + [(50 + k, f"some other text number {k}") for k in range(50)]
    got = {r.doc_id: r.labels for r in licences.digest(licences.scan_licences(documents(spark, rows))).collect()}
    assert got[2] == "mit"
    assert got[3] == "gpl,gpl-3.0"
    assert got[4] == "apache-2.0,cc-by,cc-by-nc-4.0"
    assert got[5] == got[6] == got[7] == got[8] == got[60] == ""


def test_notices_do_not_push_each_other_out(spark):
    """More different licence words than one template has: every notice is still found, at its own place."""
    mit, bsd, apache = licences.TEMPLATES[1], licences.TEMPLATES[7], licences.TEMPLATES[2]
    stray = "mozilla here affero there unencumbered cc0 universal creative commons attribution lesser gnu redistribution fee purpose"
    filler = " ".join(f"word{k}" for k in range(3000))
    rows = [
        (1, f"{mit.text}. x {bsd.text}"),
        (2, f"{mit.text}. {filler} {bsd.text}; {apache.text}"),
        (3, f"{stray} {filler} Released under the MIT license. {filler} {stray}"),
        (4, f"{stray} {filler} mit license"),
        (5, "under the mit license"),
        (6, "all rights reserved " * 3000 + "all " * 3000),
    ]
    rows += [(100 + k, f"some other text number {k}") for k in range(50)]
    scanned = licences.scan_licences(documents(spark, rows))
    found = {r.doc_id: {(m.label, m.start) for m in r.matches} for r in scanned.collect()}
    n = len(mit.text.split())
    assert found[1] == {("mit", 0), ("bsd", n + 1)}
    assert found[2] == {("mit", 0), ("bsd", n + 3000), ("apache-2.0", n + 3000 + len(bsd.text.split()))}
    assert found[3] == {("mit", len(stray.split()) + 3000)}
    assert found[4] == {("mit", len(stray.split()) + 2997)} and found[5] == {("mit", -1)}
    assert {("reserved", 3 * k) for k in range(3000)} <= found[6]
    got = {r.doc_id: r for r in licences.digest(scanned).collect()}
    assert (got[1].labels, got[2].labels, got[3].labels) == ("bsd,mit", "apache-2.0,bsd,mit", "mit")
    assert all(0 <= r.score <= 1 for r in got.values())


def test_evidence_grows_with_the_template(spark):
    """Six words in ten of a template must stand in their places, of a template of 40 words 24, each counted once."""
    words = [f"lic{k}" for k in range(40)]
    long = licences.Template("long", " ".join(words + words[:5]), "lic0 lic1")
    rows = [(n, " ".join(words[:n] + ["other"] * (45 - n))) for n in (5, 8, 23, 24, 40)]
    scanned = licences.scan_licences(documents(spark, rows), templates=(long,))
    found = {r.doc_id: [(m.label, m.start) for m in r.matches] for r in scanned.collect()}
    assert found == {5: [], 8: [], 23: [], 24: [("long", 0)], 40: [("long", 0)]}


def test_identifier_lines(spark):
    lines = {
        "MIT": "mit", "Apache-2.0": "apache-2.0", "GPL-2.0-only": "gpl-2.0", "GPL-3.0-or-later": "gpl-3.0", "LGPL-2.1": "lgpl",
        "AGPL-3.0": "agpl", "BSD-3-Clause": "bsd", "MPL-2.0": "mpl-2.0", "ISC": "isc", "Unlicense": "unlicense", "CC0-1.0": "cc0-1.0",
    }
    rows = [(k, f"// SPDX-License-Identifier: {name}\nint main() {{}}") for k, name in enumerate(lines)]
    rows += [(100, "the MIT identifier of a licence"), (101, "SPDX-License-Identifier: none of the known")]
    got = {r.doc_id: r.labels for r in licences.digest(licences.scan_licences(documents(spark, rows))).collect()}
    assert [got[k] for k in range(len(lines))] == list(lines.values())
    assert got[100] == got[101] == ""


def test_a_phrase_100000_times(spark):
    text = "x CC-BY " * 100_000
    got = licences.digest(licences.scan_licences(documents(spark, [(1, text)]))).first()
    assert (got.n_words, got.n_base, got.first_word, got.last_word) == (300_000, 100_000, 1, 299_998)


def test_sql_follows_on_several_notices(spark):
    """Files with one, two and all notices, and stray index words between them: the second engine finds the same."""
    texts = [t.text for t in licences.TEMPLATES]
    rows = [(k, f"header {k}\n{text}\nmozilla affero cc0 unencumbered") for k, text in enumerate(texts)]
    rows += [(100 + k, "\n\nsome words between\n".join(texts[k : k + 3])) for k in range(len(texts) - 2)]
    rows += [(200, "\n".join(texts)), (201, "a file without any"), (202, ""), (203, None)]
    frame = documents(spark, rows)
    got = licences.digest(licences.scan_licences(frame))
    connection = duckdb.connect()
    held = frame.select("doc_id", "text").toPandas()  # noqa: F841  (the engine reads it by its name)
    connection.execute("CREATE TABLE documents AS SELECT * FROM held")
    expected = connection.execute(OP9)
    names = [d[0] for d in expected.description]
    assert sorted(got.columns) == sorted(names)
    ours = sorted(repr(tuple(r[n] for n in names)) for r in got.collect())
    assert ours == sorted(map(repr, expected.fetchall()))
