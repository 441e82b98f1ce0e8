import random

import regex
import xxhash
from llm.odd import FOLDER, LONG, no_docs, odd_docs
from pyspark.sql import functions as F

from weftline.llm import fingerprints, queries
from weftline.llm.fingerprints import GRAM, WINDOW


ALONE = r"\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u2E80-\u9FFF\uF900-\uFAFF\U00020000-\U0003FFFF"
WORD = regex.compile(rf"[[\p{{L}}\p{{M}}\p{{N}}]--[{ALONE}]]+|[^ \t\n\x0b\f\r]", regex.V1)


def plain(text, k=GRAM, w=WINDOW):
    """Winnowing as defined: (position, hash) of the rightmost least gram of each window."""
    codes = [xxhash.xxh64_intdigest(t.encode(), seed=42) for t in WORD.findall(text)]
    codes = [(c - (1 << 64) * (c >> 63)) % (2**31 - 1) for c in codes]
    grams = [codes[i : i + k] for i in range(len(codes) - k + 1)] or ([codes] if codes else [])
    hashed = []
    for g in grams:
        h = 0
        for c in g:
            h = (h * 1_000_003 + c) % (2**31 - 1)
        hashed.append(h)
    out = set()
    for s in range(max(1, len(hashed) - w + 1)):
        if hashed:
            out.add(min(range(s, min(s + w, len(hashed))), key=lambda i: (hashed[i], -i)))
    return [(i, hashed[i]) for i in sorted(out)]


def alike(a, b):
    a, b = {h for _, h in a}, {h for _, h in b}
    return len(a & b) / len(a | b) if a | b else 1.0


def plain_edits(docs):
    """All expected rows of documents as (doc_id, text)."""
    signed = lambda t: xxhash.xxh64_intdigest(t.encode(), seed=42) - (1 << 64) * (xxhash.xxh64_intdigest(t.encode(), seed=42) >> 63)
    docs = sorted(((i, t or "") for i, t in docs), key=lambda d: (d[0] is None, -(d[0] or 0), signed(d[1])))
    out = []
    for n, (i, text) in enumerate(docs):
        other = docs[(n + 1) % len(docs)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + other[:half]
        own, changed = plain(text), plain(edited)
        out.append((i, len(text), edited, own, changed, alike(own, changed), alike(own, plain(other))))
    return out


def found(docs):
    return [
        (r.doc_id, r.n_chars, r.edited, [tuple(x) for x in r.fingerprint], [tuple(x) for x in r.edited_fingerprint], r.near_edited, r.near_next)
        for r in fingerprints.compare_edited(docs).collect()
    ]


def same(got, want):
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_odd_rows_against_definition(spark):
    more = [(None, "日本語の文章です。" * 700), (-5, "aaaa" * 900), (-6, " " * 3000), (-7, "😀" * 1100 + "x" * 1056)]
    docs = odd_docs(spark).select("doc_id", "text", "class", "row")
    docs = docs.unionByName(spark.createDataFrame([r + ("a", "b") for r in more], docs.schema))
    same(found(docs), plain_edits([(r.doc_id, r.text) for r in docs.collect()]))
    assert fingerprints.compare_edited(no_docs(spark)).count() == 0
    one = spark.createDataFrame([(1, LONG)], "doc_id long, text string")
    same(found(one), plain_edits([(1, LONG)]))


def test_lengths_around_grams_and_windows(spark):
    rng = random.Random(3)
    docs = [(n, " ".join(rng.choice(["ab", "é.", "x"]) for _ in range(n))) for n in [*range(30), 500]]
    same(found(spark.createDataFrame(docs, "doc_id long, text string")), plain_edits(docs))


def test_many_ranges_and_a_hot_id(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "ROWS_PER_RANGE", 4)
    rng = random.Random(5)
    docs = [(rng.randrange(40), f"text {rng.randrange(10**6)} of many") for _ in range(60)]
    docs += [(7, f"hot {n}") for n in range(60)] + [(None, f"none {n}") for n in range(40)] + [(3, "again")] * 30
    same(found(spark.createDataFrame(docs, "doc_id long, text string").repartition(5)), plain_edits(docs))


def test_query_of_the_whole_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    want = plain_edits([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    show = lambda f: ",".join(f"{p}:{h:x}" for p, h in f)
    got = queries.op12_fingerprints(spark, FOLDER)
    assert got.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    from hashlib import sha256

    same([tuple(r) for r in got.collect()], [(i, n, sha256(e.encode()).hexdigest(), show(a), show(b), x, y) for i, n, e, a, b, x, y in want])


def test_any_widths_and_guarantee(spark):
    rng = random.Random(1)
    passage = " ".join(rng.choice("abcdefgh") for _ in range(40))
    docs = [(n, " ".join(rng.choice("abcdefgh") for _ in range(300 * n)) + " " + passage + " xyz" * n) for n in range(1, 6)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for k, w in ((1, 1), (5, 7), (20, 21), (33, 4)):
        rows = df.select("text", fingerprints.fingerprint(F.col("text"), k, w).alias("f")).collect()
        for r in rows:
            assert [tuple(x) for x in r.f] == plain(r.text, k, w)
        if k + w - 1 <= 40:
            assert set.intersection(*({x.hash for x in r.f} for r in rows))


def test_native_plan(spark):
    plan = queries.op12_fingerprints(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan
