from collections import Counter

from tripgrain.llm import divergence as d

KIND = "doc_id bigint, text string, lang string, source string, value string"


def plain_terms(text):
    found, word = [], ""
    for char in text + " ":
        if "a" <= char <= "z" or "A" <= char <= "Z" or ord(char) > 127:
            word += char.lower() if ord(char) < 128 else char
        elif word:
            found.append(word)
            word = ""
    return found


def brute(rows, least, top):
    rows = [(text or "", lang or "", source or "") for _, text, lang, source, _ in rows]
    out = []
    for lang in {r[1] for r in rows}:
        held, by_group = Counter(), {}
        for text, _, source in (r for r in rows if r[1] == lang):
            words = plain_terms(text)
            held.update(set(words))
            by_group.setdefault(source, Counter()).update(words)
        kept = [term for term, n in held.items() if n >= least]

        def shares(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 2) // (total + 2 * len(kept)) for t in kept}

        p = {source: shares(count) for source, count in by_group.items()}
        q = shares(sum(by_group.values(), Counter()))

        def gap(a, b):
            return (a - b) ** 2 // (a + b)

        for source in p:
            listed = [("pair", o, sum(gap(p[source][t], p[o][t]) for t in kept)) for o in p if o != source]
            typical = [("term", t, gap(p[source][t], q[t])) for t in kept if by_group[source][t] and p[source][t] > q[t]]
            for part in (listed, sorted(typical, key=lambda r: (-r[2], r[1].encode()))[:top]):
                ranked = sorted(part, key=lambda r: (-r[2], r[1].encode()))
                out += [(lang, source, *row, rank) for rank, row in enumerate(ranked, 1)]
    return sorted(out)


def test_against_plain_sums(spark):
    words = "alpha Beta ÉTÉ été straße ΩMEGA x1y don't a-b 漢字 zulu".split()
    rows = [
        (i, " ".join(words[(i * k) % len(words)] for k in range(1, 2 + i % 7)) if i % 11 else None, [None, "en", "de", ""][i % 4], [None, "s1", "s2", "S1", "leer"][i % 5], "clash")
        for i in range(400)
    ]
    rows += [(1000, "123 ...", "en", "empty", None), (1001, "only here", "xx", "a", None), (1002, None, "xx", "b", None)]
    frame = spark.createDataFrame(rows, KIND).repartition(5)
    found = sorted(map(tuple, d.divergence(frame).collect()))
    assert found == brute(rows, 10, 10)
    assert [r for r in found if r[0] == "xx"] == [("xx", "a", "pair", "b", 0, 1), ("xx", "b", "pair", "a", 0, 1)]
    fewer = sorted(map(tuple, d.divergence(frame, min_documents=1, top_terms=2).collect()))
    assert fewer == brute(rows, 1, 2)


def test_ties_are_in_byte_order(spark):
    rows = [(i, "zeta ähre alpha beta" if i % 2 else "other", "en", f"s{i % 2}", "") for i in range(60)]
    found = d.divergence(spark.createDataFrame(rows, KIND)).filter("source = 's1' AND part = 'term'")
    assert [r["item"] for r in found.orderBy("rank").collect()] == ["alpha", "beta", "zeta", "ähre"]


def test_long_and_empty(spark):
    assert d.divergence(spark.createDataFrame([], KIND)).collect() == []
    rows = [(i, "Wort " * 300_000 if i == 0 else "wort", "de", f"s{i % 2}", "") for i in range(20)]
    counts = d.term_counts(spark.createDataFrame(rows, KIND)).filter("term IS NOT NULL").collect()
    assert {(r["source"], r["occurrences"], r["documents"]) for r in counts} == {("s0", 300_009, 10), ("s1", 10, 10)}


def test_sums_handed_on_early_are_the_same(monkeypatch):
    import pyarrow as pa

    texts = [b"a b c d", b"a b", b"", b"d e f a"] * 5
    batch = pa.RecordBatch.from_arrays([pa.array(["l"] * 20), pa.array(["s"] * 20), pa.array(texts, pa.binary())], ["lang", "source", "text"])

    def summed():
        total, documents = Counter(), Counter()
        for out in d._add_up([batch]):
            for row in out.to_pylist():
                total[row["term"]] += row["occurrences"]
                documents[row["term"]] += row["documents"]
        return total, documents

    whole = summed()
    monkeypatch.setattr(d, "MAX_HELD_TERMS", 2)
    assert summed() == whole
