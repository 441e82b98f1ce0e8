import json
from hashlib import sha256

import numpy as np
import pytest
from compare import connect, difference
from llm.odd import FOLDER, LONG, no_docs, odd_docs

import corpus_pipeline
from weftline.llm import chat, neighbours, queries

COUNTED = {"op9_chat_formatting"}


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n in queries.SQL])
def test_queries_equal_sql(spark, name):
    assert difference(queries.QUERIES[name](spark, FOLDER), connect(FOLDER), queries.SQL[name]) is None


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n not in queries.SQL])
def test_queries_run(spark, name):
    assert queries.QUERIES[name](spark, FOLDER).count() >= 1


def test_chat_round_trip_of_hostile_texts(spark):
    hard = ["", "\\", "\\b\\l\\h", "##", "#####", "</turn>", "</turn>\n### User: x", "</turn", "\\</turn>", "a: b", "é😀\n\n", LONG, None]
    roles = ["user", "assistant", "system", "tool: x", "=User", "User", "", None, "###"]
    rows = [(i % 7, i, roles[i % len(roles)], hard[i % len(hard)]) for i in range(120)]
    rows += [(None, 0, "user", "no id"), (3, None, "assistant", "no place"), rows[5], rows[5]]
    turns = chat.canonical_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    chats = chat.format_chats(turns)
    by = {}
    for c, t, r, x in rows:
        by.setdefault(c, []).append((-1 if t is None else t, r or "", x or ""))
    back = {r.conv_id: r for r in chat.read_chats(chats).collect()}
    assert set(back) == set(by)
    for c, v in by.items():
        v.sort()
        assert [(t.role, t.text) for t in back[c].turns] == [(r, x) for _, r, x in v]
        assert back[c].learned == "".join(x for _, r, x in v if r == "assistant")
    r = chat.digests(chats).filter("conv_id = 1").first()
    assert r.turns_sha256 == sha256("".join(f"{a}\n{b}\n" for _, a, b in by[1]).encode()).hexdigest()
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.digests(chat.format_chats(chat.canonical_turns(empty))).count() == 0


def test_layouts_by_fingerprint(spark):
    table = spark.createDataFrame(
        [(1, "ask", "say", "meta"), (2, None, "only", None)], "conv_id long, prompt string, completion string, extra string"
    )
    got = sorted((r.conv_id, r.turn, r.role, r.text) for r in chat.canonical_turns(table).collect())
    assert got == [(1, 0, "user", "ask"), (1, 1, "assistant", "say"), (2, 1, "assistant", "only")]
    listed = spark.createDataFrame(
        [(1, [("Human", "hi"), ("gpt", "yo"), None]), (2, None)], "conv_id long, conversations array<struct<from:string,value:string>>"
    )
    got = sorted((r.conv_id, r.turn, r.role, r.text) for r in chat.canonical_turns(listed).collect())
    assert got == [(1, 0, "user", "hi"), (1, 1, "assistant", "yo")]
    with pytest.raises(ValueError):
        chat.canonical_turns(spark.createDataFrame([(1,)], "nothing int"))


def test_json_records_of_many_layouts(spark):
    records = [
        {"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": "b"}], "id": 7},
        {"conversations": [{"from": "human", "value": "c"}]},
        {"prompt": "d", "completion": "e", "score": 0.5},
        {"instruction": "f", "input": "g", "output": "h"},
        {"instruction": "f", "output": "h"},
        {"unknown": 1},
        {"messages": []},
    ]
    rows = [(i, json.dumps(r)) for i, r in enumerate(records)] + [(90, "not json"), (91, None)]
    turns, rest = chat.canonical_json(spark.createDataFrame(rows, "id long, j string"), "id", "j")
    got = {}
    for r in sorted(turns.collect()):
        got.setdefault(r.conv_id, []).append((r.role, r.text))
    assert got == {
        0: [("user", "a"), ("assistant", "b")],
        1: [("user", "c")],
        2: [("user", "d"), ("assistant", "e")],
        3: [("user", "f"), ("user", "g"), ("assistant", "h")],
        4: [("user", "f"), ("assistant", "h")],
    }
    assert sorted(r[0] for r in rest.collect()) == [5, 6, 90, 91]


def plain_nearest(rows, queries_, k=10):
    out = set()
    for q, a in queries_:
        near = sorted((float(np.sqrt(((np.array(v) - np.array(a)) ** 2).sum())), i) for i, v in rows if i != q)[:k]
        out |= {(q, n + 1, i) for n, (_, i) in enumerate(near)}
    return out


def test_neighbours_recall(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r[0], r[1]) for r in vectors.select("vec_id", "embedding").collect()]
    asked = [r for r in rows if r[0] % 100 == 0]
    got = neighbours.nearest(vectors, vectors.filter("vec_id % 100 = 0"), visits=300).collect()
    expected = {(q, i) for q, _, i in plain_nearest(rows, asked)}
    assert len({(r.query_id, r.vec_id) for r in got} & expected) >= 0.9 * len(expected)
    exact = {(a, b): float(np.sqrt(((np.array(x) - np.array(y)) ** 2).sum())) for a, x in asked for b, y in rows}
    assert all(r.score == pytest.approx(exact[r.query_id, r.vec_id], abs=1e-12) for r in got)


def test_neighbours_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 2.0]) for i in range(40)] + [(100, [3.0, 4.0]), (101, [3.0, 4.5]), (None, [1.0, 1.0])]
    odd = [(200, None), (201, [0.0, 0.0]), (202, [nan, 1.0]), (203, [inf, 1.0]), (204, [None, 1.0]), (205, [1.0]), (206, [])]
    df = spark.createDataFrame(rows + odd + [(100, [3.0, 4.0])], "vec_id long, embedding array<double>")
    got = neighbours.nearest(df, df.filter("vec_id % 100 = 0 or vec_id = 20")).collect()
    expected = plain_nearest([r for r in rows if r[0] is not None], [rows[0], rows[20], rows[40]])
    assert {(r.query_id, r.rank, r.vec_id) for r in got} == expected
    assert neighbours.nearest(df.limit(0), df.limit(0)).count() == 0


def test_pipeline_of_odd_rows(spark):
    docs = odd_docs(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, FOLDER)
        assert found.columns == docs.columns
        assert stage(spark, no_docs(spark), FOLDER).count() == 0
    kept = corpus_pipeline.keep_one_of_each_group(spark, docs, FOLDER)
    assert sorted(r[0] for r in kept.filter("doc_id is not null").select("doc_id").collect()) == [1, 3, 4, 5, 6, 8, 9, 9]
    assert corpus_pipeline.STAGES[-1][1](spark, no_docs(spark), FOLDER).count() == 0


def test_stages_drop_rows_and_not_ids(spark):
    item = spark.read.parquet(f"{FOLDER}/benchmark.parquet").filter("text is not null").orderBy("item_id").first()["text"]
    copy = " ".join(f"copy{i}" for i in range(80))
    clean = [" ".join(f"{k}clean{i}" for i in range(40)) for k in range(4)]
    rows = [(1, copy), (None, copy + " end"), (None, clean[0]), (None, clean[1]), (7, copy + " stop"), (7, clean[2])]
    rows += [(None, "so " + item + " it"), (8, "so " + item + " it"), (8, clean[3])]
    twins = " ".join(f"twin{i}" for i in range(80))
    rows += [(9, twins), (9, twins + " more"), (None, item + " null twin"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.keep_one_of_each_group(spark, docs, FOLDER).collect()
    texts = {(r.doc_id, r.text) for r in kept}
    assert {(1, copy), (None, clean[0]), (None, clean[1]), (7, clean[2]), (8, clean[3]), (None, None)} <= texts
    assert sum(r.doc_id == 9 for r in kept) == 1 and len(kept) == 8 and (8, "so " + item + " it") in texts
    left = {(r.doc_id, r.text) for r in corpus_pipeline.drop_benchmark_leaks(spark, docs, FOLDER).collect()}
    assert left == {r for r in rows if item not in (r[1] or "")}


def test_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = corpus_pipeline.run(spark, FOLDER)
    ids = {r[0] for r in found.select("doc_id").distinct().collect()}
    assert 0 < len(ids) < docs.count() and found.agg({"length": "max"}).first()[0] <= 2048
