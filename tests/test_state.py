"""A stream whose state outlives a restart, against one batch over all files."""

import random

from weftline.streaming import streams

SCHEMA = "sample string, id string, seq string"


def test_two_runs_over_arriving_files_equal_one_batch(spark, tmp_path):
    rng = random.Random(3)
    turn = lambda s: s[::-1].translate(str.maketrans("ACGT", "TGCA"))
    pool = ["".join(rng.choices("ACGT", k=rng.randrange(4, 12))) for _ in range(60)]
    files = [[(rng.choice("ab"), f"{f}{n:03d}", rng.choice([s := rng.choice(pool), turn(s)])) for n in range(80)] for f in range(4)]
    files[1] += [("a", "1null", None), ("a", None, "ACGT"), (None, "1none", pool[0])]
    inbox, out, marks = (str(tmp_path / x) for x in ("in", "out", "marks"))
    for k, some in enumerate(files):
        spark.createDataFrame(some, SCHEMA).coalesce(1).write.mode("append").parquet(inbox)
        if k % 2:  # a new query on the same checkpoint
            streams.run_stateful(streams.first_of_either_strand(streams.arriving(spark, inbox, spark.createDataFrame([], SCHEMA).schema, 1)), out, marks)
    got = sorted(map(str, map(tuple, spark.read.parquet(out).collect())))
    first = {}
    for sample, n, s in sorted((r for some in files for r in some if r[2] is not None and r[1] is not None), key=lambda r: r[1]):
        first.setdefault((sample, min(s, turn(s))), (sample, n, s))
    assert got == sorted(map(str, first.values()))
