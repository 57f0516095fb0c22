"""The trie of conversations' prefixes, rolled up by pointer jumping."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Stored, quoted, table, word_count

#: A prefix is a polynomial of its turns' digests at BASE modulo PRIME, so that parts of a conversation can be
#: worked out apart and put together.
PRIME = (1 << 255) - 19
BASE = int.from_bytes(hashlib.sha256(b"prefixes of conversations").digest(), "big") % PRIME
#: A key that more than one row in so many has is looked up by broadcast; there are fewer such keys than this.
SHARES = 1000
#: 2 to this power consecutive ids are joined in one row on the way to a digest.
ID_BITS = 12
#: Rebuilding: conversations of a block of so many ids begin with as many turns of the block's first one.
BLOCK = 20
HEADS = 4

_ROW = pa.schema([("part", pa.int32()), ("first", pa.bool_()), ("last", pa.bool_()), ("edge", pa.bool_()), ("head", pa.int64()), ("conv", pa.int64()), ("depth", pa.int64()), ("h", pa.binary()), ("up", pa.binary()), ("dig", pa.binary()), ("words", pa.int64())])
_ROWS = "part int, first boolean, last boolean, edge boolean, head long, conv long, depth long, h binary, up binary, dig binary, words long"


def digested(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv, turn, dig, words``: SHA-256 of a turn's role and text (null: empty) and the number of words of the text. Texts go no
    further than this. Turns without an id of a conversation are left out."""
    conv, turn, role, text = quoted([conv, turn, role, text])
    role, text = (F.coalesce(c.cast("string"), F.lit("")) for c in (role, text))
    dig = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))
    return turns.where(conv.isNotNull()).select(conv.cast("long").alias("conv"), turn.alias("turn"), dig.alias("dig"), word_count(text).alias("words"))


def _walked(rows: DataFrame, *order: Column) -> Stored:
    """The rows in the order of ``conv`` and ``order`` over partitions, each with depth and prefix within its run: the rows of its
    conversation in its partition. A row without a digest is a root and of depth 0.

    A conversation may span many partitions, and a task holds a row at a time. ``first``: the row is of its partition's first run;
    ``last``: the last of its run; ``edge``: the last of its partition, which alone has ``head``, the first run's conversation."""
    keys = [F.col("conv"), *order]

    def run(batches):
        part, out, before, head, first, conv, depth, h = TaskContext.get().partitionId(), [], None, None, True, None, 0, 0
        for batch in batches:
            for c, dig, words in zip(*(batch.column(k).to_pylist() for k in ("conv", "dig", "words")), strict=True):
                if c != conv:
                    first, head = conv is None, c if conv is None else head
                    conv, depth, h = c, 0, 0
                up = h.to_bytes(32, "big") if dig is not None else None
                if dig is not None:
                    depth, h = depth + 1, (h * BASE + int.from_bytes(dig, "big")) % PRIME
                if before:
                    out.append((*before[:2], before[5] != c, *before[3:]))
                before = (part, first, False, False, None, c, depth, h.to_bytes(32, "big"), up, dig, words)
                if len(out) >= 8192:
                    yield _batch(out)
                    out = []
        if before:
            out.append((*before[:2], True, True, head, *before[5:]))
            yield _batch(out)

    return Stored(rows.select("conv", *[c.alias(f"o{k}") for k, c in enumerate(order)], "dig", "words").repartitionByRange(*_ordered(keys)).sortWithinPartitions(*_ordered(keys)).mapInArrow(run, _ROWS))


def _ordered(keys: list[Column]) -> list[Column]:
    return [F.col("conv"), *[F.col(f"o{k}").asc_nulls_first() for k in range(len(keys) - 1)]]


def _batch(rows: list[tuple], schema: pa.Schema = _ROW) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _carried(walked: Stored) -> tuple[dict[int, tuple[int, int]], set[int]]:
    """What partitions' first runs continue (turns and prefix so far), and the partitions whose last run goes on in the next.
    The driver gets a row for each partition."""
    carry, open_, last = {}, set(), None
    for r in sorted(walked.df.where("edge").select("part", "head", "conv", "depth", "h", "first").collect(), key=lambda r: r["part"]):
        n, h = 0, 0
        if last and last[0] == r["head"]:
            n, h = last[2:]
            carry[r["part"]] = n, h
            open_.add(last[1])
        if r["first"]:
            n, h = n + r["depth"], (h * pow(BASE, r["depth"], PRIME) + int.from_bytes(r["h"], "big")) % PRIME
        else:
            n, h = r["depth"], int.from_bytes(r["h"], "big")
        last = (r["conv"], r["part"], n, h)
    return carry, open_


def numbered(turns: DataFrame) -> DataFrame:
    """``turns`` (of :func:`digested`) with ``place``, their number from 0 within the conversation, by turn (null first), then
    digest; equal turns are alike."""
    walked = _walked(turns, F.col("turn"), F.col("dig"))
    carry = _carried(walked)[0]
    before = turns.sparkSession.createDataFrame([(p, n) for p, (n, _) in carry.items()], "part int, n long")
    return walked.df.join(F.broadcast(before), "part", "left").select("conv", "dig", "words", (F.col("depth") - 1 + F.when(F.col("first"), F.coalesce("n", F.lit(0))).otherwise(0)).alias("place"))


def _key(depth: int, h: int) -> bytes:
    return hashlib.blake2b(h.to_bytes(32, "big") + depth.to_bytes(8, "big"), digest_size=16).digest()


def prefixes(rows: DataFrame, *order: Column) -> DataFrame:
    """``conv, depth, key, parent, words, last`` for each root and each turn of each conversation: ``rows`` have ``conv``, ``dig``
    (null: the root, first in the order) and ``words``. ``key`` stands for the sequence of turns so far (128 bits)."""
    walked = _walked(rows, *order)
    carry, open_ = _carried(walked)
    schema = pa.schema([("conv", pa.int64()), ("depth", pa.int64()), ("key", pa.binary()), ("parent", pa.binary()), ("words", pa.int64()), ("last", pa.bool_())])

    def run(batches):
        for batch in batches:
            out = []
            for part, first, last, edge, conv, depth, h, up, words in zip(*(batch.column(k).to_pylist() for k in ("part", "first", "last", "edge", "conv", "depth", "h", "up", "words")), strict=True):
                h, up = int.from_bytes(h, "big"), up and int.from_bytes(up, "big")
                if first and part in carry:
                    n, h0 = carry[part]
                    shift = h0 * pow(BASE, depth - 1, PRIME)  # of all turns but the row's own
                    h, up, depth = (h + shift * BASE) % PRIME, (up + shift) % PRIME, depth + n
                out.append((conv, depth, _key(depth, h), None if up is None else _key(depth - 1, up), words, last and not (edge and part in open_)))
            if out:
                yield _batch(out, schema)

    return walked.df.mapInArrow(run, "conv long, depth long, key binary, parent binary, words long, last boolean")


def looked_up(rows: DataFrame, by: str, facts: DataFrame, hot: DataFrame) -> DataFrame:
    """Inner join of ``rows`` with ``facts`` (``key``, unique, and more) on ``by``. ``hot`` are keys that many rows have, fewer than
    ``SHARES``: theirs are broadcast, so that rows of one key need not meet in a task."""
    often = facts.join(F.broadcast(hot), "key", "left_semi")
    seldom = facts.join(F.broadcast(hot), "key", "left_anti")
    mine = F.broadcast(hot.select(F.col("key").alias(by)))
    near = rows.join(mine, by, "left_semi").join(F.broadcast(often.withColumnRenamed("key", by)), by)
    return near.unionByName(rows.join(mine, by, "left_anti").join(seldom.withColumnRenamed("key", by), by))


def rolled_up(nodes: DataFrame, values: list[str], deepest: int) -> DataFrame:
    """``key`` and the sums of ``values`` over each node's subtree without the node itself; nodes with nothing below have no row.

    ``nodes`` (a stored table): ``key``, ``parent``, ``depth``, values. Before a round with step s each node that is s or more deep
    points to its ancestor s levels up and holds the sums of those less than s below it. A round adds them to the ancestor
    and replaces each pointer by the ancestor's own, so rounds are the logarithm of the depth; nodes less deep than the step have done.
    """
    total = nodes.count()
    now, step, given = Stored(nodes.where("depth >= 1").select("key", F.col("parent").alias("up"), "depth", *values)), 1, []
    while True:
        sums = Stored(now.df.groupBy(F.col("up").alias("key")).agg(*[F.sum(v).alias(f"sum_{v}") for v in values], F.count("*").alias("n")))
        given.append(sums)
        if 2 * step > deepest:
            break
        hot = sums.df.where(F.col("n") * SHARES > total).select("key")
        deep = now.df.where(F.col("depth") >= 2 * step).join(sums.df.drop("n"), "key", "left").select("key", "up", "depth", *[(F.col(v) + F.coalesce(f"sum_{v}", F.lit(0))).alias(v) for v in values])
        after = Stored(looked_up(deep, "up", now.df.select("key", F.col("up").alias("next")), hot).select("key", F.col("next").alias("up"), "depth", *values))
        now.drop()
        now, step = after, 2 * step
    now.drop()
    all_ = given[0].df
    for sums in given[1:]:
        all_ = all_.unionByName(sums.df)
    return all_.groupBy("key").agg(*[F.sum(f"sum_{v}").alias(f"below_{v}") for v in values])


def _id_digests(ends: DataFrame) -> DataFrame:
    """``key, sha``: SHA-256 of each key's ids (``conv``, distinct), ascending and joined by commas.

    Runs of ids are joined in the JVM; one digest is a chain by nature, so a key's runs pass through one task, in order and one
    at a time, a row for up to 2 ** ID_BITS ids."""
    near = F.array_sort(F.collect_list("conv"))
    runs = ends.groupBy("key", F.shiftright("conv", ID_BITS).alias("run")).agg(F.array_join(F.transform(near, lambda c: c.cast("string")), ",").alias("ids"))

    def run(batches):
        key, sha = None, None
        for batch in batches:
            done = []
            for k, ids in zip(batch.column("key").to_pylist(), batch.column("ids"), strict=True):
                if k != key:
                    if key is not None:
                        done.append((key, sha.hexdigest()))
                    key, sha = k, hashlib.sha256()
                else:
                    sha.update(b",")
                sha.update(ids.as_py().encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], names=["key", "sha"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([sha.hexdigest()])], names=["key", "sha"])

    return runs.repartition("key").sortWithinPartitions("key", "run").mapInArrow(run, "key binary, sha string")


def prefix_trie(rows: DataFrame, *order: Column) -> DataFrame:
    """A row for each distinct prefix of the conversations in ``rows`` (as for :func:`prefixes`, each with a root): ``conv_id`` (smallest
    member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``.

    Hot prefixes (the root, a common first turn) are counted by partial aggregates and looked up by broadcast. Two
    sequences of turns with equal 128-bit keys would be one node. Without rows there are no nodes.
    """
    every = Stored(prefixes(rows, *order))
    met = Stored(every.df.groupBy("key").agg(F.min("conv").alias("conv_id"), F.count("*").alias("n_convs"), F.first("depth").alias("depth"), F.first("parent").alias("parent"), F.first("words").alias("words")))
    children = Stored(met.df.where("parent IS NOT NULL").groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("n_children")))
    own_saved = (F.col("n_convs") - 1) * F.col("words")
    nodes = Stored(
        met.df.join(children.df, "key", "left").select(
            "key", "parent", "depth", "conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), F.isnull("n_children").cast("long").alias("leaves"), F.coalesce(own_saved, F.lit(0)).alias("saved")
        )
    )
    met.drop()
    found = nodes.df.agg(F.count("*"), F.max("depth")).first()
    below = rolled_up(nodes.df, ["leaves", "saved"], found[1] or 0)
    ends = _id_digests(every.df.where("last").select("key", "conv"))
    hot = children.df.where(F.col("n_children") * SHARES > found[0]).select("key")
    parents = looked_up(nodes.df.where("parent IS NOT NULL").select("key", "parent"), "parent", nodes.df.select("key", F.col("conv_id").alias("parent_conv_id")), hot).drop("parent")
    return (
        nodes.df.join(parents, "key", "left")
        .join(below, "key", "left")
        .join(ends, "key", "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            (F.col("leaves") + F.coalesce("below_leaves", F.lit(0))).alias("n_leaves"),
            (F.col("saved") + F.coalesce("below_saved", F.lit(0))).alias("saved_tokens"),
            F.coalesce("sha", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
        )
    )


def rebuilt(turns: DataFrame, block: int = BLOCK, heads: int = HEADS) -> DataFrame:
    """``conv, kind, place, dig, words``: a root for each conversation of ``turns`` (of :func:`digested`), then the first h turns of the
    conversation that its block begins with (h is drawn from the id), then its own after its first h."""
    turns = numbered(turns)
    h = F.crc32(F.col("conv").cast("string")) % heads
    convs = turns.where("place = 0").select("conv", h.alias("h"), (F.col("conv") - F.col("conv") % block).alias("start"))
    first = turns.where((F.col("place") < heads - 1) & (F.col("conv") % block == 0)).select(F.col("conv").alias("start"), "place", "dig", "words")
    shared = convs.join(first, "start").where("place < h").select("conv", F.lit(1).alias("kind"), "place", "dig", "words")
    own = turns.where(F.col("place") >= h).select("conv", F.lit(2).alias("kind"), "place", "dig", "words")
    roots = convs.select("conv", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("place"), F.lit(None).cast("binary").alias("dig"), F.lit(0).cast("long").alias("words"))
    return roots.unionByName(shared).unionByName(own)


def op12_prefix_trie(spark, sf_dir: str) -> DataFrame:
    """Turns without conv_id belong to no conversation and are left out; equal turns are ordered by their digest; remainders are those of
    division toward zero; an empty table gives no rows. Of a text, however long, its digest and its number of words go on; a conversation
    may have any number of turns and span partitions."""
    turns = Stored(digested(table(spark, sf_dir, "conversations"))).df  # texts are read once, not again for the ranges
    return prefix_trie(rebuilt(turns), F.col("kind"), F.col("place"))


#: CRC-32 of a decimal number, a bit at a time: 3988292384 is the reflected polynomial.
_CRC = """xor(list_reduce(flatten(list_prepend([4294967295::BIGINT], list_transform(string_split(c::VARCHAR, ''), lambda ch: [ascii(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda crc, b: CASE WHEN b >= 0 THEN xor(crc, b) ELSE xor(crc >> 1, (crc & 1) * 3988292384) END), 4294967295)"""

ORACLE = f"""
WITH turns AS (
  SELECT conv_id AS c, sha256(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, '')) AS dig, turn,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS words
  FROM conversations WHERE conv_id IS NOT NULL),
placed AS (SELECT c, dig, words, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, dig) - 1 AS place FROM turns),
convs AS (SELECT c, {_CRC} % {HEADS} AS h, c - c % {BLOCK} AS start FROM (SELECT DISTINCT c FROM turns)),
remade AS (
  SELECT convs.c, 1 AS kind, p.place, p.dig, p.words FROM convs JOIN placed p ON p.c = convs.start AND p.place < convs.h
  UNION ALL SELECT convs.c, 2, p.place, p.dig, p.words FROM convs JOIN placed p ON p.c = convs.c AND p.place >= convs.h),
steps AS (
  SELECT c, row_number() OVER w AS depth, string_agg(dig, '') OVER (PARTITION BY c ORDER BY kind, place ROWS UNBOUNDED PRECEDING) AS path, words FROM remade WINDOW w AS (PARTITION BY c ORDER BY kind, place)),
reach AS (
  SELECT c, depth, sha256(path) AS id, words FROM steps UNION ALL SELECT c, 0, '', 0 FROM convs),
long_ AS (SELECT c, max(depth) AS n FROM reach GROUP BY c),
nodes AS (SELECT id, depth, min(c) AS conv_id, count(*) AS n_convs, any_value(words) AS words FROM reach GROUP BY id, depth),
ends AS (SELECT id, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS sha FROM reach JOIN long_ USING (c) WHERE depth = n GROUP BY id),
parents AS (SELECT n.id, up.id AS parent FROM nodes n JOIN reach up ON up.c = n.conv_id AND up.depth = n.depth - 1),
children AS (SELECT parent AS id, count(*) AS n_children FROM parents GROUP BY parent),
below AS (
  SELECT up.id, sum((ch.id IS NULL)::BIGINT) AS n_leaves, sum((n.n_convs - 1) * n.words) AS saved
  FROM nodes n LEFT JOIN children ch USING (id) JOIN reach up ON up.c = n.conv_id AND up.depth <= n.depth GROUP BY up.id)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(ch.n_children, 0) AS n_children, b.n_leaves::BIGINT AS n_leaves, b.saved::BIGINT AS saved_tokens, coalesce(e.sha, sha256('')) AS ends_sha256
FROM nodes n LEFT JOIN parents x ON x.id = n.id LEFT JOIN nodes p ON p.id = x.parent LEFT JOIN children ch ON ch.id = n.id LEFT JOIN below b ON b.id = n.id LEFT JOIN ends e ON e.id = n.id
"""
