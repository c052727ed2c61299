import math
import re
from collections import Counter

from tripgrain.llm.licenses import TEMPLATES, passages_of, scan_licenses
from tripgrain.llm.queries import op2_licenses


def terms(text):
    return [t for t in re.split(r"[\W_]+", text.lower()) if t]


def brute(texts, min_cosine=0.6):
    df = Counter(t for text in texts for t in set(terms(text or "")))

    def vector(text):
        raw = {t: (1 + math.log(n)) * (math.log((1 + len(texts)) / (1 + df[t]) + 1) if t in df else 1.0)
               for t, n in Counter(terms(text)).items()}
        length = math.sqrt(sum(v * v for v in raw.values()))
        return {t: v / length for t, v in raw.items()}

    shown = [(name, vector(content)) for name, content in TEMPLATES]
    result = []
    for text in texts:
        best = (0, 0, None)
        for passage in passages_of(text or ""):
            have = vector(passage)
            for name, pattern in shown:
                cosine = round(sum(have.get(t, 0) * v for t, v in pattern.items()), 9)
                if cosine >= min_cosine:
                    order = sorted({n for n, _ in TEMPLATES}).index(name)
                    best = max(best, (cosine, -order, name), key=lambda b: b[:2])
        result.append((best[2], best[0] or None))
    return result


def scan(spark, rows):
    return scan_licenses(spark.createDataFrame(rows, "path string, text string, LICENSE int"))


def test_inheritance_nulls_and_ties(spark):
    mit, gpl = "Released under the MIT License.", TEMPLATES[10][1]
    code = "plain words of a program " * 3
    rows = [
        ("a/LICENSE", mit), ("a/x.py", code), ("a/b/y.py", code), ("a/b/c/COPYING.txt", gpl),
        ("a/b/c/d/z.py", code), ("a/b/c/d/own.py", f"# {TEMPLATES[0][1]}\n\n{code}"), ("q/none.py", code),
        (None, mit), (None, None), ("top.py", ""), ("q/none.py", code), ("q/none.py", mit + "\n" + code * 400),
    ]
    df = scan(spark, [(p, t, 1) for p, t in rows])
    assert df.columns == ["path", "text", "license", "similarity", "origin", "from_directory"]
    found = sorted(((r["path"] or "", r["text"] or "", r["license"], r["origin"], r["from_directory"])
                    for r in df.collect()), key=repr)
    stated = {i: name for i, (name, _) in enumerate(brute([t for _, t in rows]))}
    inherit = {"a/x.py": ("MIT", "a"), "a/b/y.py": ("MIT", "a"), "a/b/c/d/z.py": ("GPL-3.0", "a/b/c")}
    expected = []
    for i, (path, text) in enumerate(rows):
        if stated[i]:
            expected.append((path or "", text or "", stated[i], "stated", None))
        elif path in inherit:
            expected.append((path, text or "", inherit[path][0], "inherited", inherit[path][1]))
        else:
            expected.append((path or "", text or "", None, "none", None))
    assert found == sorted(expected, key=repr)
    assert stated[0] == "MIT" and stated[3] == "GPL-3.0" and stated[5] == "Apache-2.0"


def test_empty_table(spark):
    assert scan(spark, []).collect() == []


def test_query_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    found = {r["doc_id"]: r for r in op2_licenses(spark, sf_dir).collect()}
    assert len(found) == len(docs)
    expected = brute([r["text"] for r in docs])
    assert any(name for name, _ in expected)
    for doc, (name, cosine) in zip(docs, expected):
        row = found[doc["doc_id"]]
        assert row["license"] == name and (cosine is None or abs(row["similarity"] - cosine) < 1e-6)
