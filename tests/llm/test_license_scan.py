import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lakeload.llm import license_scan as lic

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
PHRASES = {("cc", "by"): "cc-by", ("general", "public", "license"): "gpl", ("all", "rights", "reserved"): "reserved"}


def low(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def brute(text):
    w = WORD.findall(low(text))
    places = sorted((i, v) for p, v in PHRASES.items() for i in range(len(w)) if tuple(w[i : i + len(p)]) == p)
    found, best, n = {v for _, v in places}, 0.0, 0
    for start in range(0, max(1, len(w) - 20), 20):
        has = set(w[start : start + 40])
        for label, ws in {(a, tuple(lic.template_words(b))) for a, b in lic.TEMPLATES}:
            k = len(has & set(ws))
            if k >= lic.overlap_needed(len(ws), lic.THRESHOLD):
                found.add(label)
                best, n = max(best, k / len(ws)), n + 1
    return (
        len(w), len(places), places[0][0] if places else None, places[-1][0] if places else None,
        ",".join(sorted({v for _, v in places})), ",".join(sorted(found)), 1.0 if places else best, n,
    )


PIECES = [t for _, t in lic.TEMPLATES] + [
    "CC BY", "cc-by cc by cc by", "All rights\nreserved", "All  RIGHTS reserved.", "general public license", "é É İ K", "\n",
    "under the License", "Released under the Apache License", "", "software 2 0", "\x1f", "a" * 30,
]


def check(df, rows):
    got = sorted((tuple(r) for r in df.collect()), key=str)
    assert got == sorted(((i, *brute(t)) for i, t in rows), key=str)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=6), min_size=1, max_size=25), st.sampled_from([" ", "\n", ". "]))
def test_equals_brute_force(make_docs, texts, glue):
    rows = [(i, glue.join(t)) for i, t in enumerate(texts)]
    check(lic.license_scan(make_docs(rows, extra=True)), rows)


def test_nulls_repeats_and_long_texts(make_docs):
    long = "word " * 200_000 + "\nReleased under the MIT License\n" + "x" * 300_000
    rows = [(None, None), (1, None), (1, ""), (2, "cc by"), (2, "cc by"), (None, "CC  BY"), (3, long)]
    check(lic.license_scan(make_docs(rows)), rows)


def scan(make_docs, *texts):
    return [r.labels for r in lic.license_scan(make_docs(list(enumerate(texts)))).orderBy("doc_id").collect()]


MIT = """
 * Permission is hereby granted, free of charge, to any person obtaining a copy
 * of this software and associated documentation files (the "Software"), to deal
"""
BSD = """# Redistribution and use in source and binary forms, with or without
# modification, are permitted provided that the following conditions
# are met:"""


def test_notices_wrapped_over_lines(make_docs):
    before, after = "some words of a program " * 7, " and more of the words" * 9
    assert scan(make_docs, MIT, BSD, before + MIT + after, before + "x " + BSD + after) == ["mit", "bsd"] * 2
    every = [(label, k, "word " * k + text.replace(" ", "\n// ")) for label, text in lic.TEMPLATES for k in (0, 19, 20, 21, 39)]
    got = scan(make_docs, *(t for *_, t in every))
    assert [(label, k) for (label, k, _), found in zip(every, got) if label not in found.split(",")] == []


def test_scattered_words_are_no_notice(make_docs):
    words = "released under the mit license".split()
    assert scan(make_docs, (" filler" * 50).join(words), " ".join(words)) == ["", "mit"]


def test_every_template_fits_a_window():
    assert all(len(WORD.findall(low(t))) <= lic.WINDOW - lic.STRIDE + 1 for _, t in lic.TEMPLATES)


def test_the_index_is_broadcast_not_the_documents(make_docs, spark):
    many = make_docs([(i, "Released under the MIT License") for i in range(300)])
    for df in (lic.license_scan(make_docs([(1, "a")])), lic.license_scan(many)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        join = [x for x in plan.splitlines() if "BroadcastHashJoin [word" in x]
        assert len(join) == 1 and "BuildRight" in join[0]
        assert not any("hashpartitioning(word" in x for x in plan.splitlines())


def test_empty_table(make_docs, spark):
    assert lic.license_scan(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_no_python_and_no_cross_join(make_docs):
    df = lic.license_scan(make_docs([(1, "Released under the MIT License")]))
    plan = df._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)
