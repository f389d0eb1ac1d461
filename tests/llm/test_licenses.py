import re

from recflow.llm import licenses
from tests.llm.fixtures import awkward, awkward_rows, empty

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def brute(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    places, labels = [], set()
    for phrase, label in PHRASES.items():
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i:i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)))


TEXTS = [
    "Licensed under the Apache License, Version 2.0.", "Licensed under CC BY-NC 4.0.", "Released under the MIT License. MIT-license!",
    "the GNU General Public License, version 3; gnu general public", "cc by cc by cc", "CC-BY" * 3, "apache\x00license", "apache\u00e9license",
    "mıt license K mit K license", "MIT \u212A License", "a" * 40_000 + " mit license", "İ apache LICENSE cc BY",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
    "files (the \"Software\"), to deal in the Software without restriction",
    "Permission is hereby granted, free of charge, really, to any person obtaining one copy of this software and associated "
    "documentation files",
    "the to of and software copy person files any", "mit license " * 500,
]


def test_base_places_match_brute_force(spark):
    texts = TEXTS + [r[1] for r in awkward_rows()]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in licenses.scan(df).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        r = got[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute(t), t
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1


def test_long_templates_by_diagonals(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in licenses.scan(df).collect()}
    assert got[12]["labels"] == "mit" and got[12]["n_base"] == 0 and got[12]["score"] == 1.0
    assert got[13]["labels"] == "mit" or got[13]["labels"] == ""  # two insertions: covered in part
    assert got[14]["labels"] == "" and got[14]["score"] == 0.0
    assert got[1]["labels"] == "cc-by,cc-by-nc"


def test_awkward(spark):
    assert licenses.scan(awkward(spark)).count() == len(awkward_rows())
    assert licenses.scan(empty(spark)).count() == 0


def test_plan_has_no_python(spark):
    plan = licenses.scan(empty(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
