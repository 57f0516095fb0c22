from weftline.llm import mixing


def rows(spark, data, schema="doc_id long, text string, source string, lang string"):
    return spark.createDataFrame(data, schema)


def fill(sizes):
    """Water filling by repeated resharing, as the contract words it."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), 1.5 * sum(sizes.values())
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        full = {s for s in open_ if share[s] >= 2 * sizes[s]}
        for s in full or open_:
            target[s] = 2.0 * sizes[s] if full else share[s]
        left -= sum(target[s] for s in full)
        open_ -= full or open_
    return target


def test_targets_follow_the_water_filling(spark):
    sizes = {"b": 40, "a": 3, "ü": 700, None: 90, "c": 0, "z": 9}
    got = mixing.source_targets(spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")).collect()
    want = fill(sizes)
    assert {r.source for r in got} == set(sizes)
    for r in got:
        assert abs(r.target - want[r.source]) < 1e-6
    assert sum(r.target for r in got) == 1.5 * sum(sizes.values())  # half a word is not rounded away
    assert sum(sizes.values()) * 3 % 2 == 0 or sum(r.target for r in got) % 1 == 0.5
    odd = {"a": 50, "b": 51}
    got = mixing.source_targets(spark.createDataFrame(list(odd.items()), "source string, size long")).collect()
    assert sum(r.target for r in got) == 151.5


def test_rows_of_one_key_draw_apart(spark):
    docs = rows(spark, [(None, f"word{i} " * 10, f"s{i % 3}", "en") for i in range(3000)])
    got = mixing.mix(docs).groupBy("source").agg({"_mix_copies": "sum"}).collect()
    targets = fill({f"s{i}": 10000 for i in range(3)})
    for r in got:
        assert abs(r["sum(_mix_copies)"] * 10 - targets[r["source"]]) < 0.08 * targets[r["source"]]


def test_nulls_empty_and_reruns(spark):
    data = [(1, None, "a", "en"), (None, "x y z", None, None), (2, "", "a", "en"), (3, "one two\x0bthree", "b", "fr"), (3, "one two\x0bthree", "b", "fr")]
    docs = rows(spark, data).withColumnRenamed("lang", "size")
    a, b = (mixing.mix(d).select("doc_id", "_mix_size", "_mix_copies").collect() for d in (docs, docs.repartition(3)))
    assert sorted(map(str, a)) == sorted(map(str, b))
    assert sorted(r["_mix_size"] for r in a) == [0, 0, 3, 3, 3]
    assert mixing.mix(docs.limit(0)).collect() == []


def test_copies_match_the_rate(spark):
    docs = rows(spark, [(i, "w " * 10, f"s{i % 3}", "en") for i in range(3000)])
    got = mixing.mix(docs).groupBy("source").agg({"_mix_copies": "sum", "_mix_target": "max", "_mix_copies": "sum"}).collect()
    targets = fill({f"s{i}": 10000 for i in range(3)})
    for r in got:
        assert abs(r["sum(_mix_copies)"] * 10 - targets[r["source"]]) < 0.08 * targets[r["source"]]


def test_stage_keeps_the_columns(spark):
    docs = rows(spark, [(i, "w " * 10, f"s{i % 3}", "en") for i in range(30)])
    out = mixing.stage(spark, docs, "")
    assert out.columns == docs.columns
