"""The trie of prefixes against a plain one."""

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest

from weftline.llm import conversations


def plain(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append(((turn is not None, turn or 0), hashlib.sha256(f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).digest(), (role or "", text or "")))
    own = {c: [t for *_, t in sorted(ts)] for c, ts in own.items()}
    made = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        made[c] = own.get(c - (c % 20 if c >= 0 else -(-c % 20)), [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)

    def words(t):
        return len(t.replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ")) - sum(not w for w in t.replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" "))

    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in kids[node]) or 1
        saved[node] = sum(saved[k] for k in kids[node]) + ((len(members[node]) - 1) * words(node[-1][1]) if node else 0)
    for node, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(made[c]) == len(node))
        yield (min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(kids[node]), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest())


def table(seed=4):
    rng = random.Random(seed)
    say = ["yes", "no", "tell me  more\tplease", "", None, "漢字 😀"]
    rows = []
    for c in [*range(70), -7, -20, -40, 1000, 4096, 9001]:
        first = rng.randrange(3)
        rows += [(c, t, rng.choice(["user", None]) if t else "system", rng.choice(say) if t else say[first]) for t in range(rng.randrange(1, 6))]
    rows += [(300, None, "user", "null turn"), (300, None, "user", "a null turn"), (300, 0, "user", "x"), (300, 0, "user", "x"), (300, 1, "user", "y"), (None, 0, "user", "nobody's"), (None, 1, "user", "nobody's")]
    rows += [(c, t, "user", f"line {t}") for c in (501, 502, 503) for t in range(90 + c % 2)]  # over many partitions
    return rows + rows[5:8]


def stored(spark, path, rows, n=5):
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(n).write.parquet(f"{path}/conversations.parquet")
    return str(path)


def same(got, want):
    assert sorted(map(str, got)) == sorted(map(str, want))


@pytest.mark.parametrize("partitions", ["4", "61"])
def test_query_against_plain_version(spark, tmp_path, partitions):
    folder = stored(spark, tmp_path, table())
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        same([tuple(r) for r in conversations.op12_prefix_trie(spark, folder).collect()], plain(table()))
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def test_sql_against_plain_version(spark, tmp_path):
    folder = stored(spark, tmp_path, table())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{folder}/conversations.parquet/*.parquet'")
    same(con.execute(conversations.ORACLE).fetchall(), plain(table()))


def test_one_hot_conversation_spans_partitions(spark):
    rows = [(7, t, "user", f"t{t}") for t in range(3000)] + [(8, t, "user", f"t{t}") for t in range(2990)] + [(c, 0, "user", "other") for c in range(100, 110)]
    turns = conversations.digested(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = conversations.numbered(turns)
        assert sorted(tuple(r) for r in placed.where("conv = 7").select("place").collect()) == [(k,) for k in range(3000)]
        root = placed.groupBy("conv").count().selectExpr("conv", "-1L AS place", "CAST(NULL AS BINARY) AS dig", "0L AS words")
        from pyspark.sql import functions as F

        nodes = conversations.prefix_trie(root.unionByName(placed.select("conv", "place", "dig", "words")), F.col("place"))
        got = {(r.depth, r.conv_id): r for r in nodes.collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(got) == 3002 and got[0, 7].n_convs == 12 and got[0, 7].n_leaves == 2 and got[0, 7].saved_tokens == 2990 + 9
    assert got[2990, 7].n_convs == 2 and got[2991, 7].n_convs == 1 and got[2990, 7].ends_sha256 == hashlib.sha256(b"8").hexdigest()


def test_clashing_names_and_empty_table(spark, tmp_path):
    rows = spark.createDataFrame([(1, 0, "user", "a", 5)], "conv_id long, turn long, role string, text string, key long")
    rows.write.parquet(f"{tmp_path}/a/conversations.parquet")
    assert conversations.op12_prefix_trie(spark, f"{tmp_path}/a").count() >= 1
    rows.limit(0).write.parquet(f"{tmp_path}/b/conversations.parquet")
    assert conversations.op12_prefix_trie(spark, f"{tmp_path}/b").collect() == []
