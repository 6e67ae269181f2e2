"""Licence notices: known lines are found, prose is not."""

import pytest

from shoal.llm import licenses as L
from tests.llm.helpers import awkward, documents, prose

SF = "/root/testdata/sf0.01"
KNOWN = {
    "Licensed under CC BY-NC 4.0.": "CC-BY-NC", "Released under the MIT License.": "MIT", "All rights reserved.": "Proprietary",
    "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
    "This work is licensed under the GNU General Public License, version 3.": "GPL"}


@pytest.fixture(scope="module")
def model(spark):
    return L.fit(spark.read.parquet(f"{SF}/documents.parquet"))


def test_lines_of_a_table(spark, model):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = {(r["doc_id"], i, KNOWN[x]) for r in docs.collect() for i, x in enumerate((r["text"] or "").split("\n")) if x in KNOWN}
    got = {(r["doc_id"], r["line"], r["family"]) for r in L.licences(docs, model).collect() if r["family"] != L.UNKNOWN}
    assert want <= got and len(got - want) <= 0.02 * len(want) + 1


def test_notices_inside_text_and_in_other_words(spark, model):
    rows = [(1, prose(200, 1).replace("\n", " ") + " Licensed under the Apache License, Version 2.0. " + prose(200, 2).replace("\n", " ")),
            (2, "RELEASED UNDER THE MIT LICENSE"), (3, prose(400, 3)),
            (4, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
            (5, "Licensed under the Quux Harbour Licence, edition of 1907.")]
    got = {}
    for r in L.licences(documents(spark, rows, clash=True), model).collect():
        got.setdefault(r["doc_id"], set()).add(r["family"])
        assert 0 <= r["probability"] <= 1 and (r["family"] == L.UNKNOWN or r["held"] >= L.HELD)
    assert "Apache-2.0" in got[1] and got[2] == {"MIT"} and got[4] == {"MIT"} and 3 not in got
    assert got.get(5, {L.UNKNOWN}) == {L.UNKNOWN}


def test_awkward_rows(spark, model):
    rows = awkward() + [(50, "All rights reserved."), (50, "All rights reserved."), (None, "All rights reserved.")]
    got = L.licences(documents(spark, rows, clash=True), model).collect()
    assert sorted(str(r["doc_id"]) for r in got if r["family"] == "Proprietary") == ["50", "50", "None"]


def test_empty_table(spark):
    assert L.licences(documents(spark, [])).collect() == []


def test_plan_is_without_python(spark, model):
    df = L.licences(spark.read.parquet(f"{SF}/documents.parquet"), model)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoop"))


def test_windows_cover_every_word(spark):
    n = L.WINDOW * 5 + 7
    rows = [(1, " ".join(f"w{i}" for i in range(n)))]
    seen = {w for r in L.paragraphs(documents(spark, rows)).collect() for w in r["words"]}
    assert seen == {f"w{i}" for i in range(n)}


def test_every_window_is_scored_in_a_small_table(spark):
    """Common words of a corpus hide no notice, however small the table is."""
    some = sorted({w for ts in L.TEMPLATES.values() for t in ts for w in t.lower().replace(".", " ").replace(",", " ").split()})
    rows = [(1, "All rights reserved."), (2, "Released under the MIT License."), (3, " ".join(some[::3])), (4, " ".join(some[1::3])), (5, " ".join(some[2::3]))]
    rows += [(10 + i, prose(60, i + 1)) for i in range(20)]
    got = {(r["doc_id"], r["family"]) for r in L.licences(documents(spark, rows)).collect()}
    assert {(1, "Proprietary"), (2, "MIT")} <= got


def test_wrapped_notices(spark, model):
    mit = ("Permission is hereby granted, free of charge, to any person\nobtaining a copy of this software and\nassociated documentation files "
           "(the Software), to deal in the Software\nwithout restriction.")
    bsd = ("Redistribution and use in source and binary forms,\n# with or without modification, are permitted provided\n# that the following "
           "conditions are met:")
    apache = ("Unless required by applicable law or agreed to in\n * writing, software distributed under the License is\n * distributed on an "
              "\"AS IS\" BASIS")
    rows = [(i, f"{prose(50, i + 1)}\n\n{t}\n\n{prose(50, i + 7)}") for i, t in enumerate((mit, bsd, apache))]
    rows += [(9, prose(50, 1) + "\nReleased under the MIT License.\n" + prose(50, 2))]
    got = {}
    for r in L.licences(documents(spark, rows), model).collect():
        if r["family"] != L.UNKNOWN:
            got.setdefault(r["doc_id"], set()).add((r["line"], r["family"]))
    at = {i: rows[i][1].split("\n\n")[0].count("\n") + 2 for i in range(3)}
    assert got == {0: {(at[0], "MIT")}, 1: {(at[1], "BSD")}, 2: {(at[2], "Apache-2.0")}, 9: {(prose(50, 1).count("\n") + 1, "MIT")}}


def test_the_bound_drops_no_window(spark, model):
    """Every window scored by the model itself gives the same notices as those the bound lets through."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").unionByName(documents(spark, awkward() + [
        (90, "Permission is hereby granted,\nfree of charge, to any person\nobtaining a copy of this software"), (91, "All rights reserved. " + prose(30, 2))]))
    every = L._with_pairs(L.paragraphs(docs))
    some = L._with_pairs(L.paragraphs(docs, model.bound()))
    keys = ("doc_id", "line", "at", "words")
    want = {tuple(map(str, r)) for r in model.notices(every).select(*keys).collect()}
    got = {tuple(map(str, r)) for r in model.notices(some).select(*keys).collect()}
    assert want and got == want and some.count() < 0.5 * every.count()


def test_scores_equal_a_plain_model(spark, model):
    """Probabilities of a few windows by their codes, coefficients and intercepts in numpy."""
    import numpy as np
    rows = L._with_pairs(L.paragraphs(documents(spark, [(1, prose(90, 4)), (2, "Released under the MIT License."), (3, "a a a a b")])))
    lr = model.pipeline.stages[-1]
    w, b = lr.coefficientMatrix.toArray(), lr.interceptVector.toArray()
    for r in model.probabilities(rows.withColumn("codes", L._codes(rows["words"]))).collect():
        at = sorted(set(r["codes"]))
        raw = (w[:, at].sum(axis=1) / np.sqrt(len(at)) + b) / model.temperature
        p = np.exp(raw - raw.max())
        assert np.allclose(r["_p"], p / p.sum(), atol=1e-9) and len(r["codes"]) == 2 * len(r["words"]) - 1
