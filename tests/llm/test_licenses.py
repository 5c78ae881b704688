import random
import re

from pyspark.sql import functions as F

from tierline.llm import licenses

MIT, APACHE, GPL = (dict(reversed(licenses.TEMPLATES))[n] for n in ("MIT", "Apache-2.0", "GPL-3.0"))


def files(spark, *rows):
    return spark.createDataFrame([(p, t) for p, t in rows], "path string, text string")


def found(df):
    return {r[0]: (r.license, r.found, r.origin) for r in df.collect()}


def test_headers_and_nearest_directory(spark):
    rows = files(
        spark, ("LICENSE", MIT), ("a/LICENSE.txt", f"  {APACHE}\n"), ("a/b/c.py", "code"), ("a/b/d.py", f"# {GPL}\ncode"),
        ("e/f/g.py", "code"), ("a.py", None), ("a/x/COPYING", "nothing known here at all"), ("a/x/y.py", ""), (None, "code"))
    assert found(licenses.scan(rows)) == {
        "LICENSE": ("MIT", "file", None), "a/LICENSE.txt": ("Apache-2.0", "file", None),
        "a/b/c.py": ("Apache-2.0", "inherited", "a/LICENSE.txt"), "a/b/d.py": ("GPL-3.0", "header", None),
        "e/f/g.py": ("MIT", "inherited", "LICENSE"), "a.py": ("MIT", "inherited", "LICENSE"),
        "a/x/COPYING": ("Apache-2.0", "inherited", "a/LICENSE.txt"), "a/x/y.py": ("Apache-2.0", "inherited", "a/LICENSE.txt"),
        None: (None, "none", None)}


def test_a_line_that_only_mentions_a_licence_is_not_one(spark):
    text = "We had a licence to print many other words on this long line about something else entirely."
    assert found(licenses.scan(files(spark, ("a", text), ("b", "word " * 50_000 + "license"))))["a"][1] == "none"


def test_a_score_does_not_depend_on_the_other_notices(spark):
    """One paraphrased header among few and many notices of the same mix."""
    header, seen = "mytool is licensed under the Apache License, Version 2.0", set()
    for n in (5, 500, 50_000):
        others = spark.range(n).selectExpr("concat('p/', id) AS path", "concat('Released under the MIT License. Owner ', id % 400) AS text")
        rows = files(spark, ("x", header)).unionByName(others).withColumnRenamed("path", "place")
        row = licenses.scan(rows, "place", F.col("place")).filter("place = 'x'").first()
        seen.add((row.license, row.found, row.similarity))
    assert len(seen) == 1 and seen.pop()[0] == "Apache-2.0"


def test_headers_of_all_kinds(spark):
    code = "x = 1\n" * 30
    headers = {
        "# SPDX-License-Identifier: BSD-3-Clause": "BSD-3-Clause", "// SPDX-License-Identifier: MIT": "MIT",
        "/* SPDX-License-Identifier: Apache-2.0 */ int other_words;": "Apache-2.0", "# SPDX-License-Identifier: Foo-1.0": None,
        "# This work is licensed under the GNU General Public\n# License, version 3.": "GPL-3.0",
        "# This work is licensed under the GNU General Public\n# License, version 2.": "GPL-2.0",
        "# Our sources are released to all under the MIT License": "MIT", "# Copyright (c) 2020 Somebody": None,
        "# licensed as stated in a contract with the customer of our department": None}
    rows = files(spark, *((f"{i}.py", f"{h}\n{code}") for i, h in enumerate(headers)))
    got = found(licenses.scan(rows))
    assert [got[f"{i}.py"][0] for i in range(len(headers))] == list(headers.values())
    assert all(g[1] == ("header" if g[0] else "none") for g in got.values())


def test_licence_files_by_their_text(spark):
    for name, text in licenses.TEMPLATES[13:18]:
        text = f"Copyright (c) 2021 The Authors of It\n\n{text}"
        got = found(licenses.scan(files(spark, ("a/TERMS.md", text), ("a/b/c.py", ""), ("d.py", ""))))
        assert got == {"a/TERMS.md": (name, "file", None), "a/b/c.py": (name, "inherited", "a/TERMS.md"), "d.py": (None, "none", None)}
    prose = "Some report on rivers, their bridges and a hundred other things. " * 40
    got = found(licenses.scan(files(spark, ("a/x.md", f"{prose}\n{MIT}"), ("a/y.md", ""), ("a/z.md", f"{prose} license"))))
    assert got == {"a/x.md": ("MIT", "header", None), "a/y.md": (None, "none", None), "a/z.md": (None, "none", None)}


def test_ancestors_against_brute_force(spark):
    rng, rows = random.Random(8), []
    dirs = ["", *(f"d{i}" for i in range(3)), *(f"d{i}/e{j}" for i in range(3) for j in range(3)),
            *(f"d{i}/e{j}/f{k}" for i in range(3) for j in range(3) for k in range(2))]
    given = {d: rng.choice([(n, t) for n, t in licenses.TEMPLATES[:12]]) for d in dirs if rng.random() < 0.4}
    for d in dirs:
        at = f"{d}/" if d else ""
        rows.append((f"{at}x.py", "code"))
        if d in given:
            rows.append((f"{at}LICENSE", given[d][1]))
    got = found(licenses.scan(files(spark, *rows)))
    for d in dirs:
        up = d
        while up not in given and up:
            up = up.rpartition("/")[0]
        at, origin = (f"{p}/" if p else "" for p in (d, up))
        want = (given[up][0], "inherited", f"{origin}LICENSE") if up in given else (None, "none", None)
        assert got[f"{at}x.py"] == want


def test_ties_and_repeated_rows(spark):
    rows = files(spark, ("d/LICENSE-b", APACHE), ("d/LICENSE-a", MIT), ("d/x", f"{MIT}\n{APACHE}"), ("d/y", ""), ("d/y", ""))
    got = licenses.scan(rows).collect()
    assert len(got) == 5
    assert {(r.path, r.license) for r in got} == {
        ("d/LICENSE-b", "Apache-2.0"), ("d/LICENSE-a", "MIT"), ("d/x", "MIT"), ("d/y", "MIT")}


def test_empty_tables_and_clashing_columns(spark):
    assert licenses.scan(files(spark)).count() == 0
    rows = files(spark, ("LICENSE", MIT), ("x", "")).withColumns(
        {c: F.lit("z") for c in ("tag", "file", "license", "similarity", "dir", "origin", "salt", "id")})
    assert found(licenses.scan(rows))["x"] == ("MIT", "inherited", "LICENSE")
    assert found(licenses.scan(files(spark, ("x", None)))) == {"x": (None, "none", None)}


def test_no_python_runs_on_rows(spark):
    rows = files(spark, ("LICENSE", MIT), ("x", ""))
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", licenses.scan(rows)._jdf.queryExecution().executedPlan().toString())


def test_directory(spark):
    rows = spark.createDataFrame([("a/b/c",), ("a",), ("",), ("/a",), (None,)], "p string")
    assert [r[0] for r in rows.select(licenses.directory(F.col("p"))).collect()] == ["a/b", "", "", "", None]
