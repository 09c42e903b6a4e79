import llm_brute as B

from wardline.llm import licenses as L

TEXTS = ["Licensed under the Apache License, Version 2.0.", "Released under the MIT License.", "cc-by cc by CC BY-NC 4.0",
         "Licensed under CC BY-NC 4.0.", "MIT Licenses are not mit\nLICENSE", "mit license " * 300,
         "This work is licensed under the GNU General Public License, version 3.", "gnu general public licence",
         "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
         "documentation files (the Software)", "Permission is hereby denied, free of charge", "mité license mit license",
         "GNU General Public License", "", None, " \n", "apache", "license apache license apache license"]


def test_equals_brute_force(spark):
    rows = list(enumerate(TEXTS, 50)) + B.EDGES
    df = B.documents(spark, rows)
    out = L.scan(df, L.build_index(df)).collect()
    got = sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in out), key=str)
    assert got == sorted(((i, *B.licenses(t)) for i, t in rows), key=str)
    by = {r.doc_id: r for r in out}
    assert by[50].labels == "apache,apache-2.0" and by[53].labels == "cc-by,cc-by-nc-4.0"
    assert by[56].labels == "gpl,gpl-3.0" and by[58].labels == "mit" and by[58].n_base == 0 and by[58].score == 1
    assert by[59].labels == "" and by[62].score == 0
    assert all(0 <= r.score <= 1 and set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) for r in out)


def test_empty_table(spark):
    df = B.documents(spark, [])
    assert L.scan(df, L.build_index(df)).collect() == []


def test_a_notice_with_a_changed_word_still_matches():
    parts = L.templates()
    index = L.Index(parts, {w: 1.0 for p in parts for w in p.words})
    words = L.words_of("x redistribution and use in source and binary forms with or without changes are permitted "
                       "provided that the following conditions are met")
    assert [parts[t].label for t, _, _ in index.matches(words)] == ["bsd"]
    assert index.matches(L.words_of("redistribution and abuse in source and binary forms with or without "
                                    "modification are permitted")) == []
