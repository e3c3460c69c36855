import math
import zlib
from collections import Counter

import pytest

from tidegauge.llm import licences, queries

SCHEMA = "path STRING, text STRING"


def cosine(text, template, texts):
    """TF-IDF cosine, with frequencies over ``texts``; words that no template has weigh like unseen ones."""
    known = {w for _, t in licences.TEMPLATES for w in licences.words_of(t)}
    n = len(texts)

    def weight(w):
        df = sum(w in licences.words_of(t or "") for t in texts) if w in known else 0
        return math.log((n + 1) / (df + 1)) + 1

    a, b = ({w: c * weight(w) for w, c in Counter(licences.words_of(t)).items()} for t in (text, template))
    norm = math.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))
    return sum(x * b.get(w, 0) for w, x in a.items()) / norm if norm else 0.0


def scan(spark, rows, schema=SCHEMA, **options):
    return licences.scan(spark.createDataFrame(rows, schema), **options).collect()


def test_similarity_equals_brute_force(spark):
    texts = [
        "Licensed under the Apache License, Version 2.0.", "code\nReleased under the MIT License.\nmore code", "All rights reserved",
        "licensed under cc by-nc 4.0", "the work of the people is under the sea", None, "", "Permission is hereby granted, free of charge,\nto any "
        "person obtaining a copy of this software and associated\ndocumentation files",
    ]
    got = {r.file.path: r.own for r in scan(spark, [(f"f{i}", t) for i, t in enumerate(texts)])}
    for i, text in enumerate(texts):
        lines = (text or "").split("\n")
        units = [*lines, "\n".join(lines[: licences.HEADER_LINES]), text or ""]
        best = max(((cosine(u, t, texts), name) for u in units for name, t in licences.TEMPLATES), key=lambda p: p[0])
        own = got[f"f{i}"]
        if best[0] >= licences.LEAST:
            assert own.licence == best[1] and own.cosine == pytest.approx(best[0])
        else:
            assert own is None or own.licence is None
    assert [got[f"f{i}"].licence for i in (0, 1, 2, 3, 7)] == ["Apache-2.0", "MIT", "Proprietary", "CC-BY-NC-4.0", "MIT"]
    assert (got["f1"].unit, got["f1"].line) == ("line", 1) and got["f7"].unit == "header"


def gnu_header(kind, version, work="program", mark=";"):
    return (
        f"# This {work} is free software{mark} you can redistribute it and/or modify\n# it under the terms of the GNU {kind} General Public "
        f"License as published by\n# the Free Software Foundation{mark} either version {version} of the License, or\n# (at your option) any later "
        f"version.\n#\n# This {work} is distributed in the hope that it will be useful,\n# but WITHOUT ANY WARRANTY; without even the implied "
        "warranty of\n# MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the\n"
        f"# GNU {kind} General Public License for more details.\nimport os\nprint(os.getcwd())"
    )


def test_versions_and_variants_are_told_apart(spark):
    texts = {
        "GPL-2.0": gnu_header("", "2"), "GPL-3.0": gnu_header("", "3", mark=":"), "LGPL-2.1": gnu_header("Lesser", "2.1", "library"),
        "LGPL-3.0": gnu_header("Lesser", "3", "library", ":"), "AGPL-3.0": gnu_header("Affero", "3", mark=":"),
        "LGPL-2.0": gnu_header("Library", "2", "library"), "EPL-2.0": "Eclipse Public License - v 2.0", "GPL": "Licensed under the GNU "
        "General Public License", "BSD-3-Clause": "x = 1\nLicensed under the BSD 3-Clause License.", "ISC": "code\nLicensed under the ISC license",
        "Unlicense": "This is free and unencumbered software released into the public domain.", "CC0-1.0": "licensed under CC0 1.0 Universal",
    }
    got = {r.file.path: r.licence for r in scan(spark, [(name + "/f", t) for name, t in texts.items()])}
    assert got == {name + "/f": name for name in texts}


def test_full_texts_are_recognised(spark):
    texts = dict(licences.full_texts())
    assert {"GPL-2.0", "LGPL-2.1", "AGPL-3.0", "ISC", "EPL-1.0", "Unlicense", "CC0-1.0", "BSD-2-Clause", "BSD-3-Clause"} <= set(texts)
    start = "Copyright (c) 2019 Some Author. All rights reserved.\n\n"
    rows = [(f"{name}/LICENSE", start + t) for name, t in texts.items()] + [(f"{name}/a/b.c", "int x;") for name in texts]
    got = {r.file.path: (r.licence, r.own.unit if r.own else None) for r in scan(spark, rows)}
    for name in texts:
        assert got[f"{name}/LICENSE"] == (name, "file") and got[f"{name}/a/b.c"][0] == name
    later = texts["EPL-1.0"].replace("v 1.0", "v 2.0")
    assert scan(spark, [("LICENSE", later)])[0].licence == "EPL-2.0"


def test_the_nearest_directory_above_counts(spark):
    mit, apache = "Released under the MIT License.", "Licensed under the Apache License, Version 2.0."
    rows = [
        ("LICENSE", mit), ("a/b/LICENSE.txt", apache), ("a/x.py", "code"), ("a/b/c/d.py", "code"), ("a/bc/e.py", "code"),
        ("f.py", "code"), ("a/b/own.py", mit), (None, "code"), ("a/b/c/d.py", "code"), ("z/COPYING", "nothing of the kind"),
    ]
    got = [(r.file.path, r.licence, r.inherited_from) for r in scan(spark, rows)]
    assert sorted(got, key=repr) == sorted([
        ("LICENSE", "MIT", None), ("a/b/LICENSE.txt", "Apache-2.0", None), ("a/x.py", "MIT", ""), ("a/b/c/d.py", "Apache-2.0", "a/b"),
        ("a/bc/e.py", "MIT", ""), ("f.py", "MIT", ""), ("a/b/own.py", "MIT", None), (None, None, None),
        ("a/b/c/d.py", "Apache-2.0", "a/b"), ("z/COPYING", "MIT", ""),
    ], key=repr)


def test_joining_instead_of_broadcasting(spark, monkeypatch):
    monkeypatch.setattr(licences, "BROADCAST_FOLDERS", 0)
    got = scan(spark, [("a/LICENSE", "All rights reserved."), ("a/b/c.py", "x")])
    assert {(r.file.path, r.licence) for r in got} == {("a/LICENSE", "Proprietary"), ("a/b/c.py", "Proprietary")}


def test_empty_table_long_text_and_other_columns(spark):
    assert scan(spark, []) == []
    text = "word " * 200_000 + "\nAll rights reserved."
    got = scan(spark, [("p", text, "x", 1)], SCHEMA + ", licence STRING, own INT")
    assert (got[0].licence, got[0].file.licence, got[0].file.own) == ("Proprietary", "x", 1)


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = {r.doc_id: r for r in queries.op5_licences(spark, folder).collect()}
    assert set(got) == set(texts)
    notices = {t.rstrip("."): n for n, t in licences.TEMPLATES}
    for doc_id, text in texts.items():
        found = {notices[line.rstrip(".")] for line in text.split("\n") if line.rstrip(".") in notices}
        if found:
            assert got[doc_id].licence in found and got[doc_id].inherited_from is None
        elif got[doc_id].cosine is None and got[doc_id].licence:
            assert got[doc_id].path.startswith(got[doc_id].inherited_from)


def test_query_inherits_from_above(spark):
    above = 0
    for r in queries.op5_licences(spark, "/root/testdata/sf0.01").collect():
        folder = r.path.rpartition("/")[0]
        dealt = zlib.crc32(str(r.doc_id).encode())
        assert folder.count("/") == (0 if dealt % 100 == 0 else 1 if dealt % 10 == 0 else 2)
        if r.inherited_from is not None:
            assert f"{folder}/".startswith(f"{r.inherited_from}/")
            above += r.inherited_from != folder
    assert above
