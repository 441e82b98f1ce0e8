import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from llm.odd import FOLDER, LONG, PASSAGE, no_docs, odd_docs
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from weftline.llm import decontaminate, jaccard, language, order, packing, privacy, queries, suffixes, units
from weftline.llm.components import components

PATH = public_tokenizers.path("byte_bpe_50k.json")
WORD = re.compile(r"[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def sets(rows, width):
    out = []
    for doc, text in rows:
        w = WORD.findall((text or "").translate(LOWER))
        out.append((doc, frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset()))
    return out


def joined_components(rows, width, percent):
    found = sets(rows, width)
    label = list(range(len(found)))
    for i, (_, a) in enumerate(found):
        for j in range(i):
            b = found[j][1]
            both = len(a & b)
            if a and b and 100 * both >= percent * (len(a) + len(b) - both):
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    ids = defaultdict(list)
    for x, (doc, _) in zip(label, found, strict=True):
        ids[x].append(doc)
    lowest = {x: min((d for d in v if d is not None), default=None) for x, v in ids.items()}
    return sorted(((d, len(s), lowest[x] if s else d) for x, (d, s) in zip(label, found, strict=True)), key=repr)


def pairs(df):
    return [(r[0], r[1]) for r in df.select("doc_id", "text").collect()]


@pytest.mark.parametrize("width, percent", [(4, 85), (5, 80)])
def test_near_duplicates_match_all_pairs(spark, docs, width, percent):
    got = jaccard.near_duplicates(docs, width=width, percent=percent).collect()
    assert sorted(map(tuple, got), key=repr) == joined_components(pairs(docs), width, percent)


def test_near_duplicates_of_close_chains(spark):
    """Copies with more and more changed words, so that links lead from one to the next only."""
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(40):
        rows.append((i, " ".join([f"c{k}" for k in range(i)] + base[i:])))
    rows += [(100 + i, " ".join(base[:-1] + [f"tail{i}"])) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = jaccard.near_duplicates(df).collect()
    assert sorted(map(tuple, got), key=repr) == joined_components(rows, 4, 85)


def test_near_duplicates_of_odd_rows(spark):
    df = odd_docs(spark)
    got = jaccard.near_duplicates(df).collect()
    assert sorted(map(tuple, got), key=repr) == joined_components(pairs(df), 4, 85)
    assert jaccard.near_duplicates(no_docs(spark)).count() == 0


def test_components_of_long_paths_and_hubs(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5, None), (7000, 7000)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert {got[i] for i in range(61)} == {0} and {got[1000 + i] for i in range(200)} == {1000} and got[7000] == 7000


def plain_strings(rows):
    seen, expected = set(), {}
    for doc, text in sorted(rows):
        raw = text.encode()
        gone = np.zeros(len(raw), dtype=bool)
        for i in range(len(raw) - 99):
            if raw[i : i + 100] in seen:
                gone[i : i + 100] = True
            seen.add(raw[i : i + 100])
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone])
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        expected[doc] = (len(raw), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest())
    return expected


def test_repeated_strings_match_a_table_of_all_strings(spark, docs):
    df = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(900, "ab" * 400), (901, "x" * 99), (902, "y" + "ab" * 60)], "doc_id long, text string"))
    expected = plain_strings(pairs(df))
    got = suffixes.drop_repeated_strings(df).collect()
    for r in got:
        removed = sum(s["to"] - s["from"] for s in r.spans)
        assert expected[r.doc_id] == (r.n_bytes, removed, len(r.spans), hashlib.sha256(r.kept).hexdigest())
    assert len(got) == len(expected)


def test_crowded_grams_are_split(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "CROWDED", 3)
    monkeypatch.setattr(suffixes, "KNOWN_GRAMS", 0)
    line = "".join(f"{i:03d}" for i in range(50))
    rows = [(i, f"{i * 7919:09d}" * 8 + line + f"{i * 104729:09d}" * 8) for i in range(30)]
    expected = plain_strings(rows)
    for r in suffixes.drop_repeated_strings(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        assert expected[r.doc_id][2:] == (len(r.spans), hashlib.sha256(r.kept).hexdigest()) and (r.spans or not r.doc_id)


@pytest.mark.parametrize("known", [0, suffixes.KNOWN_GRAMS])
def test_strings_repeated_inside_one_document_only(spark, monkeypatch, known):
    monkeypatch.setattr(suffixes, "KNOWN_GRAMS", known)
    passage = " ".join(f"{i * i * 7919:06d}" for i in range(45))
    rows = [(1, f"{passage} and once more {passage}")]
    for more in ([], [(2, "z" + "".join(f"{i * 31 % 977:03d}" for i in range(90)))]):
        expected = plain_strings(rows + more)
        got = suffixes.drop_repeated_strings(spark.createDataFrame(rows + more, "doc_id long, text string")).collect()
        assert {r.doc_id: (len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in got} == {k: v[2:] for k, v in expected.items()}
        assert expected[1][1] >= len(passage)


@pytest.mark.parametrize("known", [0, suffixes.KNOWN_GRAMS])
def test_strings_repeated_in_different_parts(spark, monkeypatch, known):
    monkeypatch.setattr(suffixes, "KNOWN_GRAMS", known)
    monkeypatch.setattr(suffixes, "PART", 700)
    passage = "".join(f"{i * i * 7919:07d}" for i in range(30))
    between = "".join(f"{i * i * 104729 % 9999991:07d}" for i in range(300))
    rows = [(1, passage + between + passage), (2, "".join(f"{i * 31 % 977:03d}" for i in range(700)))]
    expected = plain_strings(rows)
    got = suffixes.drop_repeated_strings(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in got} == {k: v[2:] for k, v in expected.items()}
    assert expected[1][1] >= len(passage)


def test_suffix_order():
    rng = np.random.default_rng(3)
    for letters, n in ((1, 40), (2, 500), (3, 1), (5, 2), (2, 3), (26, 700)):
        text = rng.integers(1, letters + 1, n)
        places = suffixes.suffix_order(text.astype(np.int64), 1000)
        assert [tuple(text[i:]) for i in places] == sorted(tuple(text[i:]) for i in range(n))


def test_repeated_strings_of_odd_rows(spark):
    got = {}
    for r in suffixes.drop_repeated_strings(odd_docs(spark)).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert [len(r.kept) for r in got[2]] == [0, 0] and got[1][0].spans == []
    assert sum(s["to"] - s["from"] for s in got[7][0].spans) >= len(PASSAGE)
    assert bytes(got[6][0].kept) == LONG.encode() and got[3][0].n_bytes == 0
    assert suffixes.drop_repeated_strings(no_docs(spark)).count() == 0


def test_units(spark, docs):
    rows = pairs(docs)
    first, expected = set(), {}
    for doc, text in sorted(rows):
        gaps = []
        for a, b in units._units(text or ""):
            words = text[a:b].lower().translate(units._NO_MARKS).split()
            if len(words) >= 5:
                if tuple(words) in first:
                    gaps.append((a, b))
                first.add(tuple(words))
        expected[doc] = gaps
    for r in units.drop_repeated_units(docs).collect():
        assert [(s["start"], s["end"]) for s in r.removed] == expected[r.doc_id]
    text = dict(rows)
    for r in units.drop_repeated_units(docs).limit(20).collect():
        at, kept = 0, ""
        for s in r.removed:
            kept, at = kept + text[r.doc_id][at : s["start"]], s["end"]
        assert r.kept == kept + text[r.doc_id][at:]
    odd = {}
    for r in units.drop_repeated_units(odd_docs(spark)).collect():
        odd.setdefault(r.doc_id, []).append(r)
    assert [r.kept for r in odd[2]] == ["", ""] and odd[1][0].kept == PASSAGE and odd[3][0].kept is None
    assert units.drop_repeated_units(no_docs(spark)).count() == 0


def test_units_without_blanks(spark):
    line, said, key = "本サイトの内容の無断転載を禁じます", "これは最初の文章でとても長いものです。", "https://example.org/" + "a1b2" * 12
    thai = "ขอสงวนลิขสิทธิ์ในเนื้อหาทั้งหมด"
    rows = [(1, f"{line}\n{said}別の短い話。\n{key}\n{thai}"), (2, f"新しい話\n{line}\n前の文。{said}{said}\n{key}\n{thai}")]
    got = {r.doc_id: r.kept for r in units.drop_repeated_units(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: rows[0][1], 2: "新しい話\n\n前の文。\n\n"}


PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    r"[0-9](?:[\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def plain_spans(text):
    def right(kind, found):
        digits = re.sub("[^0-9]", "", found)
        if kind == 1:
            return all(int(p) <= 255 for p in found.split("."))
        if kind == 2:
            doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
            return 14 <= len(digits) <= 19 and sum(d // 10 + d % 10 for d in doubled) % 10 == 0
        return kind == 0 or 10 <= len(digits) <= 15

    return sorted((m.start(), k, m.end()) for k, p in enumerate(PATTERNS) for m in re.finditer(p, text) if right(k, m.group()))


def test_base_spans(docs):
    odd = ["a@b@c.d", "x.@a.b@c.d", "@a.b", "a@b", "1.2.3.4.5.6.7.8", "256.1.1.1 00255.1.1.1", "4111 1111-1111 1111", "41111111111111112",
           "+1 (555) 123-4567 +12", "+1 2 +1 2345678901234567", "a" * 500 + "@", "1" * 300, "é@x.y ñ@a-b.c", "..@..", "+1.2.3.4 5555555555"]
    rng = np.random.default_rng(0)
    odd += ["".join(rng.choice(list("a1.@+- ()4"), 60)) for _ in range(2000)]
    for text in odd + [t for _, t in pairs(docs)]:
        assert privacy.base_spans(text) == plain_spans(text), text


def test_contexts_find_unseen_identifiers(spark):
    rows = [(i, f"please write to our mail{i}@example{i}.com today") for i in range(8)]
    rows += [(20, "please write to our agentXY9912 today"), (21, "nothing here but order 123456 of 1999"), (22, None), (23, "")]
    found = privacy.find_private(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r.doc_id: [(s["kind"], s["start"], s["end"]) for s in r.spans] for r in found.collect()}
    assert got[20] == [(4, 20, 31)] and got[21] == [] and got[22] == [] and got[3] == [(0, 20, 38)]
    text = {r.doc_id: r.text for r in privacy.mask(found).collect()}
    assert text[20] == "please write to our <id> today" and text[3] == "please write to our <email> today" and text[22] is None


def test_contexts_of_found_identifiers_find_more(spark):
    rows = [(i, f"please write to our mail{i}@example{i}.com today") for i in range(200)]
    rows += [(1000 + i, f"please write to our agentXY99{i} today and greet badge holder agentXY99{i} then") for i in range(20)]
    rows += [(2000, "nothing but badge holder clerkZ7731 there"), (2001, "an order 123456 of 1999")]
    rows += [(3000 + i, f"some loose value item77{i} here") for i in range(30)] + [(3100, "some loose value agentXY993 here")]
    found = privacy.find_private(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r.doc_id: [r.text[s["start"] : s["end"]] for s in r.spans] for r in found.collect()}
    assert got[2000] == ["clerkZ7731"] and got[1003] == ["agentXY993"] * 2 and got[2001] == got[3000] == []


def test_private_data_of_odd_rows(spark):
    df = odd_docs(spark)
    found = privacy.find_private(df)
    assert found.count() == df.count() and set(df.columns) <= set(found.columns)
    assert privacy.find_private(no_docs(spark)).count() == 0


def test_report_counts_by_kind(spark):
    df = spark.createDataFrame([(1, "a@b.c, 10.0.0.1 and +1 555 123 4567, again a@b.c")], "doc_id long, text string")
    r = privacy.report(privacy.find_private(df)).first()
    assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == (2, 1, 0, 1)
    assert r.base_sha256 == privacy.base_digest("a@b.c, 10.0.0.1 and +1 555 123 4567, again a@b.c") and r.spans.startswith("email:0:5,ip:")


def plain_leaks(docs, items):
    five = lambda t: [tuple(w[i : i + 5]) for w in [WORD.findall((t or "").lower())] for i in range(len(w) - 4)]
    found = {}
    for item, text in items:
        wanted = Counter(five(text))
        for doc, body in docs if wanted else ():
            have = five(body)
            size = min(sum(wanted.values()), len(have))
            for i in range(len(have) - size + 1 if size and set(have) & set(wanted) else 0):
                window = Counter(have[i : i + size])
                share = sum((window & wanted).values()) / sum((window | wanted).values())
                if share >= 0.8 and share > found.get((doc, item), (0,))[0]:
                    found[doc, item] = (share, i)
    return found


def test_leaks_match_all_windows(spark, docs):
    items = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    some = items.limit(3).collect()
    changed = [some[0]["text"].split(), some[1]["text"].split()]
    changed[0][3], changed[1] = "other", changed[1][:2] + ["more"] + changed[1][2:]
    rows = [(9000 + i, "lead in words " + " ".join(w) + " and out") for i, w in enumerate(changed)]
    df = docs.select("doc_id", "text").unionByName(spark.createDataFrame(rows, "doc_id long, text string"))
    expected = plain_leaks(pairs(df), [(r["item_id"], r["text"]) for r in items.collect()])
    got = decontaminate.find_leaks(df, items).collect()
    assert {(r.doc_id, r.item_id): (r.similarity, r.start_word) for r in got} == expected and expected


def test_leaks_with_runs_of_filler(spark):
    rows, items = [], []
    for k, (n, a, b) in enumerate([(400, 100, 125), (1000, 300, 340), (1000, 500, 560), (300, 20, 30)]):
        passage = [f"p{k}x{i}" for i in range(n)]
        items.append((k, " ".join(passage)))
        rows.append((k, " ".join([f"lead{i}" for i in range(9)] + passage[:a] + ["-"] * (b - a) + passage[b:] + ["out"])))
    items.append((9, " ".join(["."] * 30 + [f"q{i}" for i in range(200)])))
    rows.append((9, "in " + " ".join(["."] * 20 + [f"q{i}" for i in range(200)]) + " out"))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = decontaminate.find_leaks(df, spark.createDataFrame(items, "item_id long, text string")).collect()
    expected = plain_leaks(rows, items)
    assert {(r.doc_id, r.item_id): (r.similarity, r.start_word) for r in got} == expected and len(expected) == 5


def test_window_sums_of_repeated_shingles():
    rng = np.random.default_rng(5)
    for n, width, kinds in ((60, 9, 4), (40, 40, 3), (50, 7, 1000)):
        text = rng.integers(0, kinds, n).astype(np.uint64)
        starts = np.arange(n - width + 1)[:: 2]
        got = decontaminate._window_sums(text, starts, width)
        for row, s in zip(got, starts, strict=True):
            many = Counter()
            numbers = np.array([many.update([x]) or many[x] for x in text[s : s + width].tolist()])
            assert (row == decontaminate._signs(decontaminate._numbered(text[s : s + width], numbers)).sum(axis=0)).all()


def test_leaks_in_several_passes(spark, docs, monkeypatch):
    items = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    once = sorted(map(tuple, decontaminate.find_leaks(docs, items).collect()))
    monkeypatch.setattr(decontaminate, "ITEMS_AT_ONCE", 7)
    assert sorted(map(tuple, decontaminate.find_leaks(docs, items).collect())) == once
    odd = spark.createDataFrame([(1, None), (2, "too few words"), (None, PASSAGE), (3, PASSAGE)], "item_id long, text string")
    assert {r.doc_id for r in decontaminate.find_leaks(odd_docs(spark), odd).collect()} == {1, 2, 7}
    assert decontaminate.find_leaks(no_docs(spark), odd).count() == 0


def test_fingerprints_within_the_radius_are_all_found():
    rng = np.random.default_rng(2)
    index = decontaminate.Index([(i, " ".join(f"t{i}x{k}" for k in range(30)).encode()) for i in range(40)])
    size, flips = int(index.sizes[0]), rng.integers(0, 256, (400, decontaminate.RADIUS))
    bits = np.unpackbits(index.prints.view(np.uint8), axis=1)[rng.integers(0, 40, 400)]
    for row, flip in zip(bits, flips, strict=True):
        row[flip] ^= 1
    prints = np.packbits(bits, axis=1).view(np.uint16)
    window, item = index.candidates(size, prints)
    apart = np.bitwise_count(prints[:, None, :] ^ index.prints[None]).sum(axis=2)
    assert set(zip(window.tolist(), item.tolist(), strict=True)) == set(zip(*map(np.ndarray.tolist, np.nonzero(apart <= decontaminate.RADIUS)), strict=True))


def test_both_ways_through_the_blocks_find_all_within_the_radius():
    """More items of one size than a block has near values: the index goes through these, with the same pairs."""
    rng = np.random.default_rng(8)
    items = [(i, " ".join(f"w{x}" for x in rng.integers(0, 400, 24)).encode()) for i in range(1500)]
    index = decontaminate.Index.of(decontaminate.Index(items).arrays())
    (size, rows), = index.rows.items()
    assert size in index.tables
    bits = np.unpackbits(index.prints[rng.integers(0, 1500, 400)].view(np.uint8), axis=1)
    for k, row in enumerate(bits):
        row[rng.choice(256, k % 90, replace=False)] ^= 1
    prints = np.packbits(bits, axis=1).view(np.uint16)
    apart = np.bitwise_count(prints[:, None] ^ index.prints).sum(axis=2)
    want = {(int(w), int(i)) for w, i in zip(*np.nonzero(apart <= decontaminate.RADIUS), strict=True)}
    got = {(int(w), int(i)) for w, i in zip(*index.candidates(size, prints), strict=True)}
    index.tables.clear()
    plain = {(int(w), int(i)) for w, i in zip(*index.candidates(size, prints), strict=True)}
    assert got == plain == want and len(want) >= 250


def test_index_grows_with_the_items_shingles_alone():
    items = [(i, " ".join(f"w{(i * 31 + k) % 5000}" for k in range(30)).encode()) for i in range(6000)]
    held = sum(v.nbytes for v in decontaminate.Index(items).arrays().values() if isinstance(v, np.ndarray))
    assert held < 6000 * 1000


def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = queries.op7_language_id(spark, "/root/testdata/sf0.01").filter("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    right = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right >= 0.97
    odd = odd_docs(spark)
    got = language.identify(odd, language.learn(docs)).collect()
    assert all(r.lang_pred == "und" for r in got if not any(c.isalpha() for c in r.text or "")) and len(got) == odd.count()
    assert language.identify(no_docs(spark), language.learn(no_docs(spark))).count() == 0
    assert {r.lang_pred for r in language.identify(odd, {}).collect()} == {"und"}


def test_more_languages_than_at_once(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = []
    for k in range(70):
        known = ["".join(rng.choice(list("abcdefghij"), 6)) for _ in range(5)]
        rows += [(100 * k + i, " ".join(rng.choice(known, 12)), f"l{k:02d}") for i in range(4)]
    rows += [(9000, "", "l00"), (9001, None, None), (9002, "123", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in language.identify(docs, language.learn(docs)).collect()}
    learned = language.learn(docs)
    assert len(learned) > 64 and len(got) == len(rows) and got[9000].lang_pred == got[9002].lang_pred == "und"
    assert all(got[i].lang_pred == x for i, _, x in rows if i < 9000 and x in learned)
    monkeypatch.setattr(language, "LANGUAGES_AT_ONCE", 1000)
    for r in language.identify(docs, learned).collect():
        one = got[r.doc_id]
        assert (one.lang_pred, one.lang_rate) == (r.lang_pred, r.lang_rate) and one.lang_score == pytest.approx(r.lang_score)


def _phrases(text, known):
    at, n = 0, 0
    while at < len(text):
        end = at + 1
        while end < len(text) and text[at : end + 1] in known:
            end += 1
        at, n = end, n + 1
    return n


def test_large_alphabets_take_little_memory():
    """Thousands of signs in one language cost the others nothing, and every language's phrases stay exact."""
    rng = np.random.default_rng(5)
    signs = {"zh": [chr(0x4E00 + i) for i in range(3000)], "ja": [chr(0x6000 + i) for i in range(2500)], "en": list("abcdefghij")}
    texts = {k: "".join(rng.choice(v, 6000)) for k, v in signs.items()}
    parser = language.Parser(texts)
    held = sum(v.nbytes for v in parser.arrays().values() if isinstance(v, np.ndarray)) - parser.codes.nbytes
    assert held < 3 * 6000 * 40
    probes = [texts["zh"][100:160] + texts["ja"][5:9], texts["en"][7:70] + "z", "".join(rng.choice(signs["ja"], 50)), "字"]
    again = language.Parser.of(parser.arrays())
    found = again.phrases([again.encode(p) for p in probes])
    for probe, row in zip(probes, found, strict=True):
        assert row.tolist() == [_phrases(probe, texts[k]) for k in again.languages]


def test_phrases_are_the_longest_that_occur():
    text = language.letters("the cat sat on the mat and the dog ran after the cat")
    parser = language.Parser({"en": text})
    for probe in ("the cat ran on", "zzz the", "dog dog dog", "a"):
        plain, at, n = language.letters(probe), 0, 0
        while at < len(plain):
            end = at + 1
            while end < len(plain) and plain[at : end + 1] in text:
                end += 1
            at, n = end, n + 1
        assert parser.phrases([parser.encode(probe)])[0][0] == n


@pytest.fixture(scope="module")
def model():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def check_pieces(rows, texts, model):
    by = defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
    for doc, text in texts:
        ids = np.array([*model.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")
        at = 0
        for r in sorted(by[doc], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids)) and bytes(r.ids) == ids[at : at + r.length].tobytes()
            at += r.length
        assert at == len(ids)
    windows = defaultdict(list)
    for r in rows:
        windows[r.sequence_id].append((r.offset, r.length))
    for v in windows.values():
        at = 0
        for offset, length in sorted(v):
            assert offset == at
            at += length
        assert at <= 2048
    return len(windows), sum(r.length for r in rows)


def test_packing_keeps_every_id_once(spark, docs, model):
    rows = packing.pack(docs.repartition(7), PATH).collect()
    windows, ids = check_pieces(rows, pairs(docs), model)
    assert windows <= 1.1 * ids / 2048 + 2
    odd = odd_docs(spark).filter("doc_id is null or doc_id not in (2, 9)").filter("doc_id is not null or text is null")
    check_pieces(packing.pack(odd, PATH).collect(), pairs(odd), model)
    assert packing.pack(no_docs(spark), PATH).count() == 0


def test_open_windows_are_bounded():
    windows, used = packing.OpenWindows(100, 4), Counter()
    rng = np.random.default_rng(0)
    for length in rng.integers(1, 100, 2000).tolist():
        while length:
            window, offset, placed = windows.place(length)
            assert used[window] == offset and len(windows.room) <= 4
            used[window] += placed
            length -= placed
    assert max(used.values()) <= 100


def test_permutation_is_one_to_one():
    for total in (1, 2, 3, 5, 64, 1000, 4097):
        slots = order.permute(np.arange(total), total, 9)
        assert sorted(slots.tolist()) == list(range(total))
    assert order.permute(np.arange(50), 1000, 9).tolist() != order.permute(np.arange(50), 1000, 10).tolist()


def test_training_order_round_trip(spark, docs, model, tmp_path):
    total = order.write_shards(docs.repartition(5), PATH, str(tmp_path / "a"), 9)
    got = order.read_shards(spark, str(tmp_path / "a"), PATH).collect()
    assert sorted(r.slot for r in got) == list(range(total))
    by = defaultdict(list)
    for r in got:
        assert r.shard == r.slot // order.RECORDS and r.offset == (r.slot % order.RECORDS) * (order.HEADER.itemsize + 2 * order.SPAN)
        by[r.doc_id].append(r)
    for doc, text in pairs(docs):
        ids = np.array(model.encode(text, add_special_tokens=False).ids, dtype="<u4")
        parts = sorted(by[doc], key=lambda r: (r.start, r.length))
        assert b"".join(bytes(r.ids) for r in parts) == ids.tobytes()
    order.write_shards(docs.repartition(3), PATH, str(tmp_path / "b"), 9)
    later = order.read_shards(spark, str(tmp_path / "b"), PATH, total // 2).collect()
    key = lambda r: (r.slot, r.doc_id, r.start, r.length, zlib.crc32(bytes(r.ids)))
    assert sorted(map(key, later)) == sorted(key(r) for r in got if r.slot >= total // 2)


def test_training_order_of_odd_rows(spark):
    got = order.materialise(odd_docs(spark), PATH, 3).collect()
    assert {r.doc_id for r in got} == {1, 2, None, 5, 6, 7, 8, 9}
    assert len(got) == len({r.slot for r in got}) and sum(r.doc_id == 2 for r in got) == 1
    assert order.materialise(no_docs(spark), PATH, 3).count() == 0


def test_planted_secrets_are_found_by_their_contexts(spark):
    """Recall and precision of the added spans on the given table, where no seed of a base kind follows ``token =``."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    found = privacy.find_private(docs).collect()
    planted = {(r.doc_id, m.start(1), m.end(1)) for r in found for m in re.finditer(r'token = "([0-9a-f]{40})"', r.text or "")}
    added = {(r.doc_id, s.start, s.end) for r in found for s in r.spans if s.kind == privacy.KINDS.index("id")}
    assert len(planted) >= 10
    assert len(planted & added) >= 0.9 * len(planted)
    assert len(added - planted) <= 0.05 * len(added)
