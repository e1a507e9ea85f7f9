import math
from collections import Counter

from pressledger.llm import licenses as L
from pressledger.llm.queries import QUERIES
from pressledger.llm.tables import ready


def brute_force(texts):
    """(licence, cosine, licence file) of each text: every segment against every notice with plain dictionaries."""
    notices = [(name, Counter(L.words_of(t))) for name, all_ in L.TEMPLATES.items() for t in all_]
    known = {w for _, n in notices for w in n}
    seen = Counter(w for t in texts for w in set(L.words_of(t or "")) & known)
    weight = lambda w: math.log((1 + len(texts)) / (1 + (seen[w] if w in known else 0))) + 1
    vector = lambda words: {w: n * weight(w) for w, n in Counter(words).items()}
    size = lambda v: math.sqrt(sum(x * x for x in v.values()))
    out = []
    for t in texts:
        words, best, share = L.words_of(t or ""), (0, None), 0
        for segment in [*(t or "").split("\n"), t or ""]:
            v = vector(L.words_of(segment))
            own = max(((sum(x * n.get(w, 0) * weight(w) for w, x in v.items()) / (size(v) * size({w: c * weight(w) for w, c in n.items()})), -i)
                       for i, (_, n) in enumerate(notices)), default=(0, 0)) if v else (0, 0)
            if own[0] >= L.COSINE:
                share += len(L.words_of(segment)) / max(len(words), 1)
                best = max(best, (own[0], notices[-own[1]][0]), key=lambda b: b[0])
        out.append((best[1], best[0], share >= L.FILE_SHARE))
    return out


PLAIN = "nothing to see in this text of ordinary words that are many " * 5
TEXTS = [None, "", "Released under the MIT License.", f"{PLAIN}\nLicensed under the Apache License, Version 2.0.\n{PLAIN}", PLAIN,
         "the license of the software is under discussion", "Licensed under CC BY-NC 4.0.\nshort", "This work is licensed under the GNU General Public License,  version 3.",
         "license " * 5000, PLAIN * 50, "é 日本", "Licensed under the Apache License, Version 2.0 (the License);\nyou may not use this file except in compliance with the License."]


def test_scan_equals_brute_force(spark):
    ready(spark)
    rows = [(i, f"d{i}/f", t, "clash") for i, t in enumerate(TEXTS)] + [(2, "d2/f", TEXTS[2], "clash"), (None, None, PLAIN, "clash")]
    got = L.scan(spark.createDataFrame(rows, "doc_id long, path string, text string, own string").repartition(3)).collect()
    wanted = brute_force([r[2] for r in rows])
    assert len(got) == len(rows)
    for r in got:
        name, cosine, _ = wanted[r.doc_id if r.doc_id is not None else len(rows) - 1]
        assert r.license == name and (r.origin == "own") == (name is not None) and abs(r.cosine - cosine) < 1e-9


def test_inheritance_from_the_nearest_directory(spark):
    ready(spark)
    mit, gpl, apache = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3.", "Licensed under the Apache License, Version 2.0."
    rows = [(1, "a/LICENSE", mit), (2, "a/b/c/x.txt", PLAIN), (3, "a/b/LICENSE", gpl), (4, "a/y.txt", PLAIN), (5, "z/y.txt", PLAIN), (6, "a/b/own.txt", f"{apache}\n{PLAIN}"),
            (7, "top.txt", ""), (8, "m/1", mit), (9, "m/2", gpl), (10, "m/3", gpl), (11, "m/n/q", None), (12, "ab/y.txt", PLAIN), (13, "m/n/q", None)]
    got = {r.doc_id: (r.license, r.origin, r.licence_path) for r in L.scan(spark.createDataFrame(rows, "doc_id long, path string, text string")).collect()}
    assert got[2] == ("GPL-3.0", "inherited", "a/b") and got[4] == ("MIT", "inherited", "a") and got[5] == (None, "none", None)
    assert got[6] == ("Apache-2.0", "own", None) and got[7] == (None, "none", None) and got[11] == got[13] == ("GPL-3.0", "inherited", "m") and got[12][1] == "none"
    root = L.scan(spark.createDataFrame([(1, "LICENSE", mit), (2, "p/q/r", PLAIN)], "doc_id long, path string, text string")).where("doc_id = 2").first()
    assert (root.license, root.licence_path) == ("MIT", "")
    assert L.scan(spark.createDataFrame([], "doc_id long, path string, text string")).count() == 0


def test_query_equals_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    wanted = dict(zip(texts, brute_force(list(texts.values())), strict=True))
    rows = QUERIES["op6_license_scan"](spark, folder).collect()
    assert len(rows) == 200 and all((r.license if r.origin == "own" else None) == wanted[r.doc_id][0] for r in rows)
