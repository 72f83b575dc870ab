"""Licence digests: forms that must match, texts that must not, odd inputs."""

from ledgerstar.llm import licences
from ledgerstar.llm.licence_texts import LICENCES, NOTICES


def scan(spark, texts):
    df = spark.createDataFrame([(k, t, "x", 1) for k, t in enumerate(texts)], "doc_id long, text string, digest string, licence int")
    return {r["doc_id"]: r for r in licences.scan(df).collect()}


def test_equivalent_forms_match(spark):
    mit = LICENCES["MIT"]
    forms = [mit, mit.upper(), "Copyright (c) 2020 Some One\nAll rights reserved.\n\n" + mit, "\n".join("# " + x for x in mit.split("\n")),
             mit.replace("NONINFRINGEMENT", "NON-INFRINGEMENT"), mit.replace(". ", ".\r\n  "), mit.replace("and/or", "and or")]
    assert [r["licence"] for _, r in sorted(scan(spark, forms).items())] == ["MIT"] * len(forms)


def test_every_known_text_matches_itself(spark):
    names = sorted(LICENCES)
    got = scan(spark, [LICENCES[n] for n in names])
    assert [got[k]["licence"] for k in range(len(names))] == names


def test_changed_texts_do_not_match(spark):
    mit = LICENCES["MIT"]
    got = scan(spark, [mit.replace("free of charge", "for a fee"), mit[:-20], mit + " extra", "prose", "", None, "...", "x " * 50_000])
    assert all(r["licence"] is None for r in got.values())
    assert got[5]["digest"] is None and got[4]["digest"] == got[6]["digest"]


def test_notices(spark):
    lines = [*NOTICES.values(), "no licence here", "RELEASED under the MIT Licence"]
    got = scan(spark, ["\n".join(["prose", *lines, "prose"]), "see: " + lines[0], "prose"])
    assert got[0]["notices"] == ",".join(sorted(NOTICES)) and got[1]["notices"] == "" and got[2]["notices"] == ""


def test_repeats_empty_and_own_table(spark):
    df = spark.createDataFrame([(1, "own terms"), (1, "own terms"), (None, "Own, terms!")], "doc_id long, text string")
    own = licences.known(spark, {"Own": "OWN TERMS"})
    assert [r["licence"] for r in licences.scan(df, own).collect()] == ["Own"] * 3
    assert licences.scan(df.limit(0)).collect() == []


def test_titled_bulleted_and_long_texts(spark):
    bsd = LICENCES["BSD-3-Clause"]
    forms = ["BSD 3-Clause License\n\nCopyright (c) 2020, Some One\nAll rights reserved.\n\n" + bsd, "The MIT License (MIT)\n\n" + LICENCES["MIT"], "ISC License\n\n" + LICENCES["ISC"],
             "zlib License\n\n" + LICENCES["Zlib"], bsd.replace("1. ", "* ").replace("2. ", "* ").replace("3. ", "* "), LICENCES["GPL-3"].upper(), LICENCES["Apache-2.0"]]
    got = scan(spark, forms)
    assert [got[k]["licence"].split(" ")[0] for k in range(len(forms))] == ["BSD-3-Clause", "MIT", "ISC", "Zlib", "BSD-3-Clause", "GPL-3", "Apache-2.0"]


def test_own_notices_of_any_wording(spark):
    own = {"PD": "Released into the public domain.", "ODD": "Favour and/or behaviour", "SUB": "May be sub-licensed", "SHORT": "X"}
    texts = ["a\n# RELEASED into the public domain\nb", "favor and or behavior", "may be sub licenced", "may be sublicensed", "prose\nx.\n", "prose"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r["notices"] for r in sorted(licences.scan(df, notices=own).collect())] == ["PD", "ODD", "SUB", "SUB", "SHORT", ""]
