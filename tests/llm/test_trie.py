import random
from hashlib import sha256
from zlib import crc32

import pytest
from llm.odd import FOLDER, LONG

from weftline.llm import queries, trie

KIND = "conv_id long, turn long, role string, text string, length string, a string"


def sequences(rows):
    by = {}
    for c, t, r, x in rows:
        r, x = r or "", x or ""
        code = sha256(f"{len(r)}:{r}{x}".encode()).hexdigest()
        if c is not None:
            by.setdefault(c, []).append(((-1, 0) if t is None else (0, t), code, r, x))
    return {c: [(r, x) for *_, r, x in sorted(v)] for c, v in by.items()}


def grafted(by):
    out = {}
    for c, own in by.items():
        h = crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        out[c] = by.get(base, [])[:h] + own[h:]
    return out


def plain(by):
    """The nodes by the definition."""
    members = {}
    for c, turns in by.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children, leaves, saved = {}, {}, {}
    for path, convs in members.items():
        if path:
            children[path[:-1]] = children.get(path[:-1], 0) + 1
    for path, convs in members.items():
        size = (len(convs) - 1) * len(path[-1][1].encode()) if path else 0
        for d in range(len(path) + 1):
            leaves[path[:d]] = leaves.get(path[:d], 0) + (path not in children)
            saved[path[:d]] = saved.get(path[:d], 0) + size
    return [
        (
            min(convs),
            len(path),
            min(members[path[:-1]]) if path else None,
            len(convs),
            children.get(path, 0),
            leaves[path],
            saved[path],
            sha256(",".join(str(c) for c in sorted(convs) if len(by[c]) == len(path)).encode()).hexdigest(),
        )
        for path, convs in members.items()
    ]


def table(spark, rows):
    return spark.createDataFrame([r + ("x", "y") for r in rows], KIND)


def same(got, rows, graft):
    by = sequences(rows)
    want = plain(grafted(by) if graft else by)
    assert sorted(map(repr, (tuple(r) for r in got.collect()))) == sorted(map(repr, want))


def whole(spark, rows, graft):
    turns = trie.placed(trie.coded_turns(table(spark, rows).repartition(3)))
    if graft:
        return trie.prefix_trie(*trie.grafted(turns))
    return trie.prefix_trie(turns, turns.select("conv_id").distinct())


def test_query_by_definition(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").collect()]
    got = queries.op11_prefix_trie(spark, FOLDER)
    assert {f.dataType.simpleString() for f in got.schema.fields[:-1]} == {"bigint"}
    same(got, rows, True)


@pytest.mark.parametrize("graft", [False, True])
def test_odd_rows(spark, graft):
    rows = [(None, 0, "user", "no id"), (1, None, None, None), (1, None, "user", "a"), (1, 3, "user", "b"), (1, 3, "user", "a")]
    rows += [(2, 1, "user", "same")] * 3 + [(3, 1, "user", "same")] * 2 + [(4, 1, "us", "ersame"), (-7, 0, "user", "same")]
    rows += [(c, t, "user", f"é{t}") for c in (5, 6, 7, 9, 10, 11) for t in range(12)] + [(8, 0, "x", LONG), (12, 0, "x", LONG)]
    same(whole(spark, rows, graft), rows, graft)


def test_no_conversations(spark):
    assert whole(spark, [], True).count() == 0
    assert whole(spark, [(None, 1, "user", "x")], True).count() == 0


def test_hot_conversation_and_copies(spark):
    rng = random.Random(1)
    rows = [(c, t, "user", f"long {t}") for c in (3, 5) for t in range(700)]
    rows += [(c, t, "user", f"{rng.randrange(3)}") for c in range(20, 320) for t in range(rng.randrange(1, 5))]
    same(whole(spark, rows, False), rows, False)


def test_full_sketch_changes_nothing(spark, monkeypatch):
    """A sketch whose cells are all crowded lets every prefix through to the exact grouping."""
    rng = random.Random(2)
    rows = [(c, t, "user", f"{rng.randrange(4)}") for c in range(200) for t in range(rng.randrange(1, 7))]
    plainly = trie._cells
    monkeypatch.setattr(trie, "_cells", lambda d, a, b, n: [x % 5 for x in plainly(d, a, b, n)])
    same(whole(spark, rows, True), rows, True)


def test_running_sums_over_many_ranges(spark):
    rng = random.Random(3)
    rows = [(rng.choice([1, 1, 1, 2, 3, 4 + i]), i, rng.randrange(-(2**62), 2**62)) for i in range(600)]
    df = spark.createDataFrame(rows, "k long, i long, v long")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        got = {(r.k, r.i): r.sum_v for r in trie.running(df, "k", ["i"], ["v"]).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "2")
    sums = {}
    for k, i, v in sorted(rows):
        sums[k] = sums.get(k, 0) + v
        assert (got[k, i] - sums[k]) % 2**64 == 0
