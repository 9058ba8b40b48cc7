import duckdb
from pyspark.sql import functions as F

from furlong.llm import license_scan as S


def test_own_and_inherited(spark):
    rows = [
        (1, "a/LICENSE", "Licensed under the Apache License, Version 2.0."), (2, "a/x.py", "code\n# Licensed under the MIT License.\nmore"), (3, "a/b/c/y.py", "no statement"),
        (4, "a/b/COPYING", "This work is licensed under the GNU General Public License, version 3."), (5, "a/b/z", None), (6, "q/z", ""), (7, None, "text"), (8, "ab/z", "x"),
        (9, "a/b/unlicensed.py", "license unclear words that match nothing at all here or there"), (None, "a/w", "x"), (5, "a/b/z", None),
    ]
    files = spark.createDataFrame(rows, "doc_id long, path string, text string").withColumn("license", F.lit(1)).withColumn("word", F.lit("w"))
    out = S.scan(files).collect()
    assert len(out) == len(rows)
    got = {r.doc_id: (r.own_license, r.license, r.found_in) for r in out}
    assert got == {
        1: ("Apache-2.0", "Apache-2.0", "a"), 2: ("MIT", "MIT", "a"), 3: (None, "GPL-3.0", "a/b"), 4: ("GPL-3.0", "GPL-3.0", "a/b"), 5: (None, "GPL-3.0", "a/b"),
        6: (None, None, None), 7: (None, None, None), 8: (None, None, None), 9: (None, "GPL-3.0", "a/b"), None: (None, "Apache-2.0", "a"),
    }


def test_the_root_directory_is_an_ancestor_of_all(spark):
    files = spark.createDataFrame([(1, "LICENSE", "Licensed under the MIT License."), (2, "p/q/r", "x")], "doc_id long, path string, text string")
    assert {r.doc_id: (r.license, r.found_in) for r in S.scan(files).collect()} == {1: ("MIT", ""), 2: ("MIT", "")}


def test_each_template_is_its_own_best_match(spark):
    files = spark.createDataFrame([(i, f"d{i}/f", t) for i, t in enumerate(says for _, says in S.TEMPLATES)], "doc_id long, path string, text string")
    got = {r.doc_id: r.own_license for r in S.scan(files).collect()}
    assert [got[i] for i in range(len(S.TEMPLATES))] == [name for name, _ in S.TEMPLATES]


def test_a_statement_counts_whatever_stands_around_it(spark):
    filler = " ".join(f"word{i} and{i % 7}" for i in range(300))
    texts = [
        ("MIT", "Copyright 2021 Jane Doe\nLicensed under the MIT License."),
        ("Apache-2.0", 'Copyright 2019 The Authors\n\nLicensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
        ("MIT", f"Released under the MIT License. {filler}"), ("MIT", f"{filler} which is licensed under the MIT License and {filler}"),
        ("Proprietary", f"{filler}\nCopyright 2020 Acme Inc. All rights reserved.\n{filler}"),
        ("MPL-2.0", f"/* This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy of the MPL was not distributed with this file, see {filler} */"),
        ("GPL-3.0", f"Copyright (C) 2020, 2021 Jane Doe\n# This work is licensed under the GNU General Public License, version 3.\n{filler}"),
        (None, "Copyright 2021 Jane Doe"), (None, f"{filler}\nA license is a paper. Copyright is a right of authors under the law\n{filler}"), (None, f"mit license{filler} licensed {filler} mit"),
    ]
    files = spark.createDataFrame([(i, f"d{i}/f", t) for i, (_, t) in enumerate(texts)], "doc_id long, path string, text string")
    got = {r.doc_id: r.own_license for r in S.scan(files).collect()}
    assert [got[i] for i in range(len(texts))] == [name for name, _ in texts]


def test_given_documents_match_the_sql(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    duck = duckdb.connect()
    duck.sql("create view documents as select * from '/root/testdata/sf0.001/documents.parquet'")
    found = duck.sql(S.sql())
    assert sorted((tuple(r) for r in S.scan(S.document_paths(docs)).select(*found.columns).collect()), key=str) == sorted(found.fetchall(), key=str)


def test_only_built_in_functions_and_empty_table(spark):
    out = S.scan(spark.createDataFrame([], "doc_id long, path string, text string"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert out.count() == 0 and "Python" not in plan and "Arrow" not in plan
