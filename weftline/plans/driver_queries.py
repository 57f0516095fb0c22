"""The operators of the library on the driver's tables, with SQL of the same meaning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.functions import seq
from weftline.operators import alignment, contigs, matrices, orthologs, relational, stats, trees
from weftline.streaming import streams

QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str | None = None):
    """Registers a query under its function's name, with its SQL."""

    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return put


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# deduplication, best matches, sets


@query("SELECT min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY least(text, reverse(text))")
def dedup_either_strand(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    key = F.least("text", F.reverse("text"))
    return docs.groupBy(F.xxhash64(key), F.md5(key)).agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies")).select("doc_id", "copies")


@query("SELECT min(doc_id) AS doc_id FROM documents GROUP BY least(text, reverse(translate(text, 'ATCG', 'TAGC')))")
def first_of_either_strand(spark, d):
    return relational.dedup_either_strand(table(spark, d, "documents").select("doc_id", "text"), "text", ["doc_id"]).select("doc_id")


@query(
    """WITH u AS (SELECT source, n_chars, row_number() OVER (PARTITION BY least(text, reverse(text)) ORDER BY doc_id) AS k FROM documents)
SELECT source, count(*) AS n_before, CAST(sum(n_chars) AS BIGINT) AS size_before, count(*) FILTER (k = 1) AS n_after,
  CAST(coalesce(sum(n_chars) FILTER (k = 1), 0) AS BIGINT) AS size_after FROM u GROUP BY source"""
)
def counts_before_after_dedup(spark, d):
    docs = table(spark, d, "documents")
    slim = docs.select("doc_id", "source", "n_chars", F.md5(F.least("text", F.reverse("text"))).alias("key"))
    return relational.counts_before_after(slim, relational.dedup(slim, F.col("key"), ["doc_id"]), "source", F.col("n_chars"))


_LINE = "l_partkey, l_orderkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax"


@query(
    f"""SELECT {_LINE} FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_extendedprice DESC, l_orderkey, l_suppkey,
  l_linenumber, l_quantity, l_discount, l_tax) AS k FROM lineitem) WHERE k = 1"""
)
def best_hit_per_key(spark, d):
    rows = table(spark, d, "lineitem").select(*_LINE.split(", "))
    return relational.best_per_key(rows, ["l_partkey"], [-F.col("l_extendedprice"), "l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_tax"])


@query(
    """WITH r AS (SELECT l_suppkey, l_extendedprice AS p, dense_rank() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_partkey, l_linenumber) AS k FROM lineitem),
s AS (SELECT l_suppkey, count(*) AS n, max(p) FILTER (k = 1) AS best, max(p) FILTER (k > 1) AS second FROM r GROUP BY l_suppkey)
SELECT *, coalesce(best - second >= 100, true) AS unique_best FROM s"""
)
def best_vs_second_gap(spark, d):
    return relational.best_and_second(table(spark, d, "lineitem"), ["l_suppkey"], "l_extendedprice", 100, ["l_orderkey", "l_partkey", "l_linenumber"])


@query("SELECT l_orderkey, l_linenumber, count(*) AS count FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def duplicate_keys(spark, d):
    return relational.duplicates(table(spark, d, "lineitem"), "l_orderkey", "l_linenumber")


@query(
    """SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
AND o_custkey IN (SELECT o_custkey FROM orders GROUP BY o_custkey HAVING count(*) >= 2)"""
)
def select_taxa(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", F.col("o_custkey").alias("locus"))
    wanted = table(spark, d, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return relational.pick_taxa(orders, selected=wanted, min_seq=2, member="o_custkey").drop("locus")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0) AND o_custkey IN (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) >= 3)")
def deselect_taxa(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", F.col("o_custkey").alias("locus"))
    out = table(spark, d, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    return relational.pick_taxa(orders, deselected=out, min_seq=3, member="o_custkey").drop("locus")


@query("SELECT user_id FROM events GROUP BY user_id HAVING count(DISTINCT event_type) = (SELECT count(DISTINCT event_type) FROM events)")
def relational_division(spark, d):
    rows = table(spark, d, "events")
    return relational.divide(rows, rows.select("event_type").distinct(), "user_id", "event_type")


@query(
    """WITH u AS (SELECT c_nationkey AS locus, c_name AS taxon, 0 AS source_ord FROM customer UNION ALL SELECT s_nationkey, s_name, 1 FROM supplier)
SELECT * FROM u WHERE locus IN (SELECT locus FROM u GROUP BY locus HAVING count(*) >= 50) AND locus IN (SELECT locus FROM u WHERE source_ord = 1)"""
)
def merge_union_min_rows(spark, d):
    a = table(spark, d, "customer").select(F.col("c_nationkey").alias("locus"), F.col("c_name").alias("taxon"))
    b = table(spark, d, "supplier").select(F.col("s_nationkey").alias("locus"), F.col("s_name").alias("taxon"))
    return relational.merge_tables([a, b], min_seq=50, essential_sources=[1])


@query(
    """SELECT doc_id, 'left' AS side FROM (SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels)
UNION ALL SELECT doc_id, 'right' FROM (SELECT doc_id FROM labels EXCEPT SELECT doc_id FROM documents)"""
)
def missing_keys(spark, d):
    return relational.missing_keys(table(spark, d, "documents"), table(spark, d, "labels"), "doc_id")


@query("SELECT event_id, user_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY md5('7|' || event_id), event_id) AS k FROM events) WHERE k = 1")
def one_per_group_pick(spark, d):
    return relational.one_per_group(table(spark, d, "events").select("event_id", "user_id"), ["user_id"], "7", "event_id")


@query(
    """WITH o AS (SELECT o_custkey, o_orderkey, o_orderstatus, CAST(epoch(o_orderdate) AS BIGINT) // 86400 AS day FROM orders)
SELECT a.o_custkey, a.o_orderkey AS open_order, b.o_orderkey AS done_order FROM o a JOIN o b ON a.o_custkey = b.o_custkey
WHERE a.o_orderstatus = 'O' AND b.o_orderstatus = 'F' AND a.day <= b.day + 30 AND a.day + 30 >= b.day"""
)
def interval_overlap_join(spark, d):
    day = F.floor(F.unix_seconds(F.col("o_orderdate").cast("timestamp")) / 86400)
    orders = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", day.alias("lo"), (day + 30).alias("hi"))
    a = orders.where("o_orderstatus = 'O'").select("o_custkey", F.col("o_orderkey").alias("open_order"), "lo", "hi")
    b = orders.where("o_orderstatus = 'F'").select("o_custkey", F.col("o_orderkey").alias("done_order"), F.col("lo").alias("qlo"), F.col("hi").alias("qhi"))
    return relational.interval_join(a, b, ["o_custkey"], ("lo", "hi"), ("qlo", "qhi")).select("o_custkey", "open_order", "done_order")


@query(
    """SELECT s_suppkey, c_custkey FROM supplier JOIN customer ON s_nationkey = c_nationkey
AND s_acctbal - 50 <= c_acctbal AND s_acctbal + 50 >= c_acctbal"""
)
def interval_overlap_binned(spark, d):
    a = table(spark, d, "supplier").select(F.col("s_nationkey").alias("nation"), "s_suppkey", (F.col("s_acctbal") - 50).alias("lo"), (F.col("s_acctbal") + 50).alias("hi"))
    b = table(spark, d, "customer").select(F.col("c_nationkey").alias("nation"), "c_custkey", F.col("c_acctbal").alias("at"))
    return relational.interval_join(a, b, ["nation"], ("lo", "hi"), ("at", "at"), bin_size=100).select("s_suppkey", "c_custkey")


_NEAR = "SELECT s_suppkey, c_custkey, abs(s_acctbal - c_acctbal) AS d FROM supplier JOIN customer ON s_nationkey = c_nationkey"


@query(
    f"""WITH p AS ({_NEAR}), a AS (SELECT s_suppkey, c_custkey, row_number() OVER (PARTITION BY s_suppkey ORDER BY d, c_custkey) AS k FROM p),
b AS (SELECT s_suppkey, c_custkey, row_number() OVER (PARTITION BY c_custkey ORDER BY d, s_suppkey) AS k FROM p)
SELECT a.s_suppkey AS a, a.c_custkey AS b FROM a JOIN b USING (s_suppkey, c_custkey) WHERE a.k = 1 AND b.k = 1"""
)
def reciprocal_best(spark, d):
    s = table(spark, d, "supplier").select(F.col("s_nationkey").alias("nation"), F.col("s_suppkey").alias("a"), F.col("s_acctbal").alias("v"))
    c = table(spark, d, "customer").select(F.col("c_nationkey").alias("nation"), F.col("c_custkey").alias("b"), F.col("c_acctbal").alias("v"))
    return relational.reciprocal_nearest(s, c, ["nation"], "a", "b").select("a", "b")


@query(
    """WITH t AS (SELECT count(DISTINCT o_custkey) AS n FROM orders)
SELECT o_orderpriority, count(DISTINCT o_custkey) AS n, round(CAST(count(DISTINCT o_custkey) AS DOUBLE) * 100 / (SELECT n FROM t), 2) AS pct FROM orders GROUP BY 1"""
)
def enriched_pct(spark, d):
    return relational.group_share(table(spark, d, "orders"), "o_orderpriority", "o_custkey")


@query("SELECT o_orderstatus AS category, o_orderpriority AS sample, count(*) AS n FROM orders GROUP BY ALL")
def failed_counts(spark, d):
    return relational.failed_counts(table(spark, d, "orders").select(F.col("o_orderstatus").alias("category"), F.col("o_orderpriority").alias("sample")))


@query(
    """SELECT conv_id FROM conversations GROUP BY conv_id
HAVING bool_and(CASE WHEN length(text) > 0 THEN CAST(length(text) - length(translate(text, 'abcdefghijklmnopqrstuvwxyz', '')) AS DOUBLE) / length(text) ELSE 0.0 END <= 0.8)"""
)
def masked_fraction_filter(spark, d):
    return relational.unmasked_pairs(table(spark, d, "conversations").withColumnRenamed("text", "seq"), most=0.8, pair="conv_id")


_HITS = """h AS (SELECT l_suppkey AS locus, l_returnflag || l_linestatus AS sample, l_linenumber % 3 AS target, CAST(l_quantity AS BIGINT) AS tlo,
  CAST(l_quantity AS BIGINT) + 5 AS thi, l_extendedprice AS bits, l_discount * 1000 AS id FROM lineitem),
r AS (SELECT s_suppkey AS locus, s_nationkey % 3 AS target, CAST(10 AS BIGINT) AS tlo, CAST(20 AS BIGINT) AS thi FROM supplier WHERE s_acctbal > 0),
a AS (SELECT s_suppkey AS locus, unnest(['AF', 'NF', 'NO', 'RF', 'XX']) AS sample FROM supplier)"""


@query(
    f"""WITH {_HITS},
m AS (SELECT *, EXISTS (SELECT 1 FROM r WHERE r.locus = h.locus AND r.target = h.target AND h.tlo <= r.thi AND h.thi >= r.tlo) AS o FROM h),
g AS (SELECT locus, sample, count(*) FILTER (o) AS n_on, count(*) FILTER (NOT o) AS n_off,
  arg_max(id, (bits, id)) FILTER (o) AS on_id, arg_max(id, (bits, id)) FILTER (NOT o) AS off_id FROM m GROUP BY ALL)
SELECT a.locus, a.sample, CASE WHEN a.locus NOT IN (SELECT locus FROM r) THEN 'unqualified_reference' WHEN g.locus IS NULL THEN 'nohit'
  WHEN n_on > 0 AND (n_off = 0 OR on_id - off_id >= 40) THEN 'ortholog' ELSE 'paralog' END AS status
FROM a LEFT JOIN g ON a.locus = g.locus AND a.sample = g.sample"""
)
def ortholog_status(spark, d):
    hits = table(spark, d, "lineitem").select(
        F.col("l_suppkey").alias("locus"), F.concat("l_returnflag", "l_linestatus").alias("sample"), (F.col("l_linenumber") % 3).alias("target"), F.col("l_quantity").cast("long").alias("tlo"), (F.col("l_quantity").cast("long") + 5).alias("thi"), F.col("l_extendedprice").alias("bits"), (F.col("l_discount") * 1000).alias("id")
    )
    s = table(spark, d, "supplier")
    refs = s.where("s_acctbal > 0").select(F.col("s_suppkey").alias("locus"), (F.col("s_nationkey") % 3).alias("target"), F.lit(10).cast("long").alias("tlo"), F.lit(20).cast("long").alias("thi"))
    assembled = s.select(F.col("s_suppkey").alias("locus"), F.explode(F.array(*map(F.lit, ("AF", "NF", "NO", "RF", "XX")))).alias("sample"))
    return orthologs.ortholog_status(hits, refs, assembled)


# strings


@query("SELECT p_partkey, reverse(translate(upper(p_name), 'ATCG', 'TAGC')) AS rc, least(upper(p_name), reverse(translate(upper(p_name), 'ATCG', 'TAGC'))) AS canonical FROM part")
def char_substitution(spark, d):
    name = F.upper("p_name")
    return table(spark, d, "part").select("p_partkey", seq.reverse_complement(name).alias("rc"), seq.canonical(name).alias("canonical"))


def _resolved_sql() -> str:
    pick = lambda code, bases: f"substr('{bases}', CAST(CAST('0x' || substr(md5(p_partkey || '|{code}'), 1, 8) AS BIGINT) % {len(bases)} AS INT) + 1, 1)"
    out = "upper(p_name)"
    for code, bases in seq.IUPAC.items():
        out = f"replace({out}, '{code}', {pick(code, bases)})"
    return f"SELECT p_partkey, regexp_replace({out}, '[^ACGT]', {pick('?', 'ACGT')}, 'g') AS resolved FROM part"


@query(_resolved_sql())
def ambiguity_resolved(spark, d):
    return table(spark, d, "part").select("p_partkey", seq.resolve_ambiguity(F.upper("p_name"), F.col("p_partkey").cast("string")).alias("resolved"))


def _count_sql(s: str, letters: str) -> str:
    return f"(length({s}) - length(translate({s}, '{letters}', '')))"


@query(
    f"""WITH s AS (SELECT lang, count(*) AS rows, CAST(max(length(text)) AS INT) AS length, sum(length(text)) AS c, sum({_count_sql('text', 'ACGT')}) AS b,
  sum({_count_sql('text', 'GC')}) AS g, sum({_count_sql('text', '-?N')}) AS m FROM documents GROUP BY lang)
SELECT lang, rows, length, CASE WHEN b > 0 THEN round(CAST(g AS DOUBLE) * 100 / b, 2) END AS gc_pct, CASE WHEN c > 0 THEN round(CAST(m AS DOUBLE) * 100 / c, 2) END AS missing_pct FROM s"""
)
def composition_stats(spark, d):
    return stats.locus_statistics(table(spark, d, "documents"), "lang", "text")


def _kmer_sql(rel: str, key: str, k: int, name: str) -> str:
    return f"""{name} AS (SELECT {key}, kmer, row_number() OVER (PARTITION BY {key}, kmer) AS occ FROM
  (SELECT {key}, unnest(list_transform(range(1, greatest(length(text) - {k} + 2, 1)), lambda i: substr(text, i, {k}))) AS kmer FROM {rel}))"""


@query(f"WITH {_kmer_sql('benchmark', 'item_id', 6, 'k')} SELECT item_id, count(*) AS n, count(DISTINCT kmer) AS kinds, max(occ) AS most FROM k GROUP BY item_id")
def kmer_multiset(spark, d):
    rows = seq.kmers(table(spark, d, "benchmark"), "text", 6, "item_id")
    return rows.groupBy("item_id").agg(F.count("*").alias("n"), F.count_distinct("kmer").alias("kinds"), F.max("occ").cast("long").alias("most"))


@query(f"WITH {_kmer_sql('benchmark', 'item_id', 12, 'a')}, {_kmer_sql('conversations', 'conv_id', 12, 'b')} SELECT item_id, conv_id, count(*) AS shared FROM a JOIN b USING (kmer, occ) GROUP BY ALL")
def kmer_overlap(spark, d):
    return orthologs.kmer_overlap(table(spark, d, "benchmark"), table(spark, d, "conversations"), 12, "text", "item_id", "conv_id")


@query(
    """SELECT p_partkey, q_partkey, olp, mismatches FROM (
  SELECT *, row_number() OVER (PARTITION BY p_partkey, q_partkey ORDER BY olp DESC) AS k FROM (
    SELECT a.p_partkey, b.p_partkey AS q_partkey, CAST(n AS INT) AS olp,
      CAST(len(list_filter(range(1, n + 1), lambda i: substr(right(a.p_name, CAST(n AS INT)), i, 1) <> substr(b.p_name, i, 1))) AS INT) AS mismatches
    FROM part a JOIN part b ON a.p_brand = b.p_brand AND a.p_size = b.p_size AND a.p_partkey <> b.p_partkey, range(4, 13) t(n)
    WHERE n <= length(a.p_name) AND n <= length(b.p_name)) WHERE mismatches <= floor(olp * 0.25)) WHERE k = 1"""
)
def suffix_prefix_overlap(spark, d):
    part = table(spark, d, "part")
    a = part.select("p_brand", "p_size", "p_partkey", F.col("p_name").alias("a_seq"))
    b = part.select("p_brand", "p_size", F.col("p_partkey").alias("q_partkey"), F.col("p_name").alias("b_seq"))
    found = contigs.suffix_prefix_of_groups(a, b, ["p_brand", "p_size"], most=12, least=4, error=0.25)
    return found.where("p_partkey <> q_partkey").select("p_partkey", "q_partkey", "olp", "mismatches")


_CODING = "translate(CAST(o_orderkey * 7919 + o_custkey AS VARCHAR) || CAST(o_orderkey * 104729 AS VARCHAR), '0123456789', 'ACGTACGTTA')"


def _coding(spark, d) -> DataFrame:
    digits = F.concat((F.col("o_orderkey") * 7919 + F.col("o_custkey")).cast("string"), (F.col("o_orderkey") * 104729).cast("string"))
    return table(spark, d, "orders").select("o_orderkey", F.translate(digits, "0123456789", "ACGTACGTTA").alias("seq"))


def _translate_sql(s: str, frame: int) -> str:
    table_ = "MAP {" + ", ".join(f"'{c}': '{a}'" for c, a in seq.CODONS.items()) + "}"
    return f"array_to_string(list_transform(range(0, (length({s}) - {frame}) // 3), lambda i: coalesce({table_}[substr({s}, CAST(i * 3 + {frame + 1} AS INT), 3)], 'X')), '')"


@query(f"WITH s AS (SELECT o_orderkey, {_CODING} AS seq FROM orders) SELECT o_orderkey, {_translate_sql('seq', 0)} AS protein, {_translate_sql('seq', 1)} AS second FROM s")
def codon_translate(spark, d):
    return _coding(spark, d).select("o_orderkey", seq.translate("seq").alias("protein"), seq.translate("seq", 1).alias("second"))


_FRAMES = f"""s AS (SELECT CAST(o_orderkey AS VARCHAR) AS name, {_CODING} AS seq FROM orders),
f AS (SELECT name, 0 AS frame, {_translate_sql('seq', 0)} AS p FROM s UNION ALL SELECT name, 1, {_translate_sql('seq', 1)} FROM s UNION ALL SELECT name, 2, {_translate_sql('seq', 2)} FROM s),
t AS (SELECT name, frame, CASE WHEN length(p) >= 2 THEN regexp_replace(p, '\\*+$', '') ELSE p END AS p FROM f),
c AS (SELECT name, frame, CAST(length(p) - length(replace(p, '*', '')) AS INT) AS stops FROM t)"""


@query(
    f"""WITH {_FRAMES}, g AS (SELECT name, count(*) AS n, min({{'s': stops, 'f': frame}}) AS b FROM c WHERE stops <= 0 GROUP BY name)
SELECT s.name, coalesce(g.b.f, -1) AS frame, coalesce(g.b.s, -1) AS stops, CASE WHEN n IS NULL THEN 'uncorrected' WHEN n = 1 THEN 'unique' ELSE 'fewest' END AS how FROM s LEFT JOIN g ON s.name = g.name"""
)
def frame_choice(spark, d):
    rows = _coding(spark, d).select(F.col("o_orderkey").cast("string").alias("name"), "seq")
    return orthologs.decide_frames(rows, most_stops=0).select("name", F.coalesce("frame", F.lit(-1)).alias("frame"), F.coalesce("stops", F.lit(-1)).alias("stops"), "how")


# alignments: part names as rows, one alignment to a brand

_MSA = "msa AS (SELECT p_brand AS locus, CAST(p_partkey AS VARCHAR) AS taxon, rpad(replace(upper(p_name), ' ', '-'), (SELECT CAST(max(length(p_name)) AS INT) FROM part), '-') AS seq FROM part)"
_CELLS = f"{_MSA}, cells AS (SELECT locus, taxon, i - 1 AS pos, substr(seq, CAST(i AS INT), 1) AS base FROM msa, range(1, (SELECT max(length(seq)) + 1 FROM msa)) t(i))"


def _msa(spark, d) -> DataFrame:
    part = table(spark, d, "part")
    width = part.agg(F.max(F.length("p_name"))).scalar()
    return part.select(F.col("p_brand").alias("locus"), F.col("p_partkey").cast("string").alias("taxon"), F.rpad(F.replace(F.upper("p_name"), F.lit(" "), F.lit("-")), width, F.lit("-")).alias("seq"))


_REF = "ref AS (SELECT locus, arg_min(seq, taxon) AS other FROM msa GROUP BY locus)"


def _first_row(rows: DataFrame) -> DataFrame:
    return rows.groupBy("locus").agg(F.min_by("seq", "taxon").alias("other"))


@query(
    f"""WITH {_CELLS}, n AS (SELECT locus, pos, count(*) FILTER (base = 'A') AS a, count(*) FILTER (base = 'T') AS t, count(*) FILTER (base = 'C') AS c, count(*) FILTER (base = 'G') AS g FROM cells GROUP BY ALL),
v AS (SELECT locus, pos, CASE WHEN greatest(a, t, c, g) = 0 THEN '?' WHEN a = greatest(a, t, c, g) THEN 'A' WHEN t = greatest(a, t, c, g) THEN 'T' WHEN c = greatest(a, t, c, g) THEN 'C' ELSE 'G' END AS base FROM n)
SELECT locus, string_agg(base, '' ORDER BY pos) AS seq FROM v GROUP BY locus"""
)
def column_majority(spark, d):
    return alignment.consensus(_msa(spark, d))


@query(
    f"""WITH {_CELLS}, n AS (SELECT locus, pos, base, count(*) AS n FROM cells GROUP BY ALL),
v AS (SELECT locus, pos, base, row_number() OVER (PARTITION BY locus, pos ORDER BY base = '-', n DESC, base) AS k FROM n)
SELECT locus, string_agg(base, '' ORDER BY pos) AS seq FROM v WHERE k = 1 GROUP BY locus"""
)
def column_majority_any(spark, d):
    return alignment.consensus_any(_msa(spark, d))


_UNITS = f"""{_CELLS}, n AS (SELECT locus, pos, CAST(count(*) FILTER (base = '-') AS DOUBLE) / count(*) AS gaps FROM cells GROUP BY ALL),
units AS (SELECT locus, pos // 3 AS unit, bool_or(gaps > 0.5) AS any_gappy, bool_and(gaps = 1) AS all_gaps FROM n GROUP BY ALL)"""


@query(f"WITH {_UNITS} SELECT locus, unit, any_gappy, all_gaps FROM units")
def gap_columns(spark, d):
    return alignment.gap_columns(_msa(spark, d), unit=3)


@query(f"WITH {_UNITS} SELECT m.locus, m.taxon, coalesce(string_agg(substr(seq, CAST(unit * 3 + 1 AS INT), 3), '' ORDER BY unit), '') AS seq FROM msa m LEFT JOIN units u ON m.locus = u.locus AND NOT any_gappy GROUP BY ALL")
def trim_units(spark, d):
    return alignment.trim_gappy_units(_msa(spark, d)).select("locus", "taxon", "seq")


@query(f"WITH {_UNITS.replace('// 3', '// 1')} SELECT m.locus, m.taxon, coalesce(string_agg(substr(seq, CAST(unit + 1 AS INT), 1), '' ORDER BY unit), '') AS seq FROM msa m LEFT JOIN units u ON m.locus = u.locus AND NOT all_gaps GROUP BY ALL")
def drop_gap_columns(spark, d):
    return alignment.drop_gap_columns(_msa(spark, d)).select("locus", "taxon", "seq")


@query(
    f"""WITH {_MSA}, {_REF}, z AS (SELECT max(length(seq)) AS n FROM msa),
w AS (SELECT CAST(s AS INT) AS st, CAST(CASE WHEN s = lst THEN n - s ELSE 10 END AS INT) AS len FROM (SELECT n, CASE WHEN n < 15 THEN 0 ELSE ((n - 10) // 5) * 5 END AS lst FROM z), range(0, 1000, 5) t(s) WHERE s <= lst),
p AS (SELECT m.locus, m.taxon, st, len, substr(m.seq, st + 1, len) AS a, substr(r.other, st + 1, len) AS b FROM msa m JOIN ref r ON m.locus = r.locus, w),
q AS (SELECT locus, taxon, st, len, list_filter(range(1, len + 1), lambda i: regexp_matches(substr(a, i, 1), '[A-Z]') AND regexp_matches(substr(b, i, 1), '[A-Z]')) AS ok, a, b FROM p)
SELECT locus, taxon, st, len, CASE WHEN len(ok) > 0 AND len(ok) >= len // 2 THEN round(CAST(len(list_filter(ok, lambda i: substr(a, i, 1) <> substr(b, i, 1))) AS DOUBLE) / len(ok), 3) END AS pdis FROM q"""
)
def sliding_pdistance(spark, d):
    rows = _msa(spark, d)
    return alignment.window_distances(rows, _first_row(rows), size=10, step=5)


@query(
    f"""WITH {_MSA}, {_REF}, s AS (SELECT m.locus, m.taxon, array_to_string(list_transform(range(1, length(seq) + 1), lambda i: CASE WHEN substr(seq, i, 1) = '-' AND substr(other, i, 1) = '-' THEN ''
    WHEN substr(seq, i, 1) = '-' THEN 'd' WHEN substr(other, i, 1) = '-' THEN 'i' ELSE 'm' END), '') AS st FROM msa m JOIN ref r ON m.locus = r.locus),
x AS (SELECT locus, taxon, regexp_replace(st, '^d+|d+$', '', 'g') AS st FROM s)
SELECT locus, taxon, CAST(coalesce(list_max(list_transform(regexp_extract_all(st, 'd+|i+'), lambda r: length(r))), 0) AS INT) AS longest FROM x"""
)
def indel_runs(spark, d):
    rows = _msa(spark, d)
    return alignment.long_indels(rows, _first_row(rows))


_ALONE = f"""{_CELLS}, alone AS (SELECT locus, pos, min(taxon) AS taxon FROM cells WHERE base <> '-' GROUP BY locus, pos HAVING count(*) = 1),
runs AS (SELECT locus, taxon, count(*) AS run FROM (SELECT *, pos - row_number() OVER (PARTITION BY locus, taxon ORDER BY pos) AS g FROM alone) GROUP BY locus, taxon, g)"""


@query(f"WITH {_ALONE} SELECT m.locus, m.taxon, CASE WHEN EXISTS (SELECT 1 FROM runs r WHERE r.locus = m.locus AND r.taxon = m.taxon AND run > 2) THEN repeat('-', length(seq)) ELSE seq END AS seq FROM msa m")
def unique_runs(spark, d):
    return alignment.blank_private_runs(_msa(spark, d), most=2).select("locus", "taxon", "seq")


@query(
    f"""WITH {_CELLS}, n AS (SELECT locus, pos, CAST(count(*) FILTER (base <> '-') AS DOUBLE) / count(*) >= 0.9 AS dense FROM cells GROUP BY ALL),
g AS (SELECT locus, pos, pos - row_number() OVER (PARTITION BY locus ORDER BY pos) AS g FROM n WHERE dense),
r AS (SELECT locus, min(pos) AS st, count(*) AS n FROM g GROUP BY locus, g)
SELECT locus, CAST(min(st) AS INT) AS start FROM r WHERE n >= 3 GROUP BY locus"""
)
def first_dense_run(spark, d):
    return alignment.dense_start(_msa(spark, d), run=3, share=0.9)


@query(
    """WITH r AS (SELECT user_id, event_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events),
g AS (SELECT user_id, event_id, rn - row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS island FROM r WHERE event_type = 'click')
SELECT user_id, CAST(island AS INT) AS island, count(*) AS n, min(event_id) AS start, max(event_id) AS "end" FROM g GROUP BY ALL"""
)
def event_islands(spark, d):
    return alignment.islands(table(spark, d, "events"), ["user_id"], "event_id", F.col("event_type") == "click")


@query(
    """WITH p AS (SELECT a.n_regionkey AS locus, a.n_name AS a, b.n_name AS b FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_name < b.n_name),
q AS (SELECT locus, a, b, list_filter(range(1, least(length(a), length(b)) + 1), lambda i: regexp_matches(substr(a, i, 1), '[ACGT]') AND regexp_matches(substr(b, i, 1), '[ACGT]')) AS ok FROM p),
d AS (SELECT locus, CASE WHEN len(ok) > 0 THEN CAST(len(list_filter(ok, lambda i: substr(a, i, 1) <> substr(b, i, 1))) AS DOUBLE) / len(ok) END AS d FROM q)
SELECT locus, round(avg(d), 6) AS mean_distance FROM d GROUP BY locus"""
)
def mean_pairwise_distance(spark, d):
    rows = table(spark, d, "nation").select(F.col("n_regionkey").alias("locus"), F.col("n_name").alias("taxon"), F.col("n_name").alias("seq"))
    return alignment.mean_distance(rows).withColumn("mean_distance", F.round("mean_distance", 6))


# graphs: regions, nations and segments

_EDGES = """e AS (SELECT DISTINCT 'r' || n_regionkey AS src, 'n' || n_nationkey AS dst FROM nation UNION
  SELECT DISTINCT 'n' || c_nationkey, c_mktsegment FROM customer UNION SELECT DISTINCT 's' || (s_suppkey % 10), 'n' || s_nationkey FROM supplier)"""


def _edges(spark, d) -> DataFrame:
    n, c, s = (table(spark, d, t) for t in ("nation", "customer", "supplier"))
    a = n.select(F.concat(F.lit("r"), F.col("n_regionkey").cast("string")).alias("src"), F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("dst"))
    b = c.select(F.concat(F.lit("n"), F.col("c_nationkey").cast("string")), "c_mktsegment")
    e = s.select(F.concat(F.lit("s"), (F.col("s_suppkey") % 10).cast("string")), F.concat(F.lit("n"), F.col("s_nationkey").cast("string")))
    return a.union(b).union(e).distinct().select(F.lit("all").alias("sample"), F.lit("one").alias("locus"), "src", "dst")


@query(f"WITH {_EDGES}, x AS (SELECT src AS node, 1 AS o, 0 AS i FROM e UNION ALL SELECT dst, 0, 1 FROM e) SELECT node, CAST(sum(o) AS BIGINT) AS n_out, CAST(sum(i) AS BIGINT) AS n_in, sum(i) = 0 AS is_start, sum(o) = 0 AS is_end FROM x GROUP BY node")
def overlap_graph_degree(spark, d):
    return contigs.node_degrees(_edges(spark, d)).select("node", "n_out", "n_in", "is_start", "is_end")


@query(f"WITH {_EDGES}, x AS (SELECT src AS node FROM e UNION ALL SELECT dst FROM e), busy AS (SELECT node FROM x GROUP BY node HAVING count(*) > 12) SELECT src, dst FROM e WHERE src NOT IN (SELECT node FROM busy) AND dst NOT IN (SELECT node FROM busy)")
def busy_nodes_dropped(spark, d):
    return contigs.drop_busy_nodes(_edges(spark, d), most=12).select("src", "dst")


@query(
    f"""WITH RECURSIVE {_EDGES}, st AS (SELECT src AS node FROM e EXCEPT SELECT dst FROM e), en AS (SELECT dst AS node FROM e EXCEPT SELECT src FROM e),
w(node, path) AS (SELECT node, [node] FROM st UNION ALL SELECT e.dst, list_append(w.path, e.dst) FROM w JOIN e ON w.node = e.src WHERE NOT list_contains(w.path, e.dst))
SELECT array_to_string(path, '>') AS path FROM w WHERE node IN (SELECT node FROM en)"""
)
def path_enum(spark, d):
    return contigs.all_paths(_edges(spark, d), most=1000, depth=10).select(F.array_join("path", ">").alias("path"))


@query()
def graph_reduce(spark, d):
    edges = _edges(spark, d)
    nodes = edges.select("sample", "locus", F.explode(F.array("src", "dst")).alias("contig")).distinct().withColumn("score", F.length("contig").cast("double"))
    return contigs.reduce_graph(edges.withColumn("score", F.lit(0.5)), nodes)


# matrices

_LOCI = """m AS (SELECT n_name AS taxon, o_orderpriority AS locus, lpad(CAST(count(*) AS VARCHAR), 8, '0') AS seq FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY ALL HAVING count(*) % 3 > 0),
l AS (SELECT DISTINCT locus FROM m), x AS (SELECT DISTINCT taxon FROM m),
f AS (SELECT x.taxon, l.locus, coalesce(m.seq, '--------') AS seq, m.seq IS NOT NULL AS present FROM x CROSS JOIN l LEFT JOIN m ON m.taxon = x.taxon AND m.locus = l.locus)"""


def _loci(spark, d) -> DataFrame:
    o, c, n = (table(spark, d, t) for t in ("orders", "customer", "nation"))
    rows = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey).groupBy(F.col("n_name").alias("taxon"), F.col("o_orderpriority").alias("locus")).agg(F.count("*").alias("n"))
    return rows.where("n % 3 > 0").select("taxon", "locus", F.lpad(F.col("n").cast("string"), 8, "0").alias("seq"))


@query(f"WITH {_LOCI} SELECT taxon, string_agg(seq, '' ORDER BY locus) AS seq FROM f GROUP BY taxon")
def supermatrix(spark, d):
    return matrices.supermatrix(_loci(spark, d))[0]


@query(f"WITH {_LOCI} SELECT taxon, count(*) FILTER (present) AS loci, round(CAST(sum(length(seq) - length(replace(seq, '-', ''))) AS DOUBLE) * 100 / sum(length(seq)), 2) AS gap_pct FROM f GROUP BY taxon")
def supermatrix_gaps(spark, d):
    return matrices.gap_report(_loci(spark, d))


@query("WITH p AS (SELECT p_brand AS locus, CAST(max(length(p_name)) AS BIGINT) AS len FROM part GROUP BY 1) SELECT locus, len, CAST(sum(len) OVER (ORDER BY locus) - len + 1 AS BIGINT) AS start, CAST(sum(len) OVER (ORDER BY locus) AS BIGINT) AS \"end\" FROM p")
def locus_blocks(spark, d):
    rows = table(spark, d, "part").select(F.col("p_brand").alias("locus"), F.col("p_partkey").alias("taxon"), F.col("p_name").alias("seq"))
    return matrices.locus_blocks(rows).select("locus", F.col("len").cast("long").alias("len"), "start", "end")


_TYPES = ("click", "view", "purchase", "signup", "error")


@query("SELECT user_id, " + ", ".join(f"count(*) FILTER (event_type = '{t}') AS n_{t}" for t in _TYPES) + " FROM events GROUP BY user_id")
def pivot_matrix(spark, d):
    rows = table(spark, d, "events").groupBy("user_id").pivot("event_type", list(_TYPES)).agg(F.count("event_id"))
    return rows.select("user_id", *[F.coalesce(t, F.lit(0)).cast("long").alias(f"n_{t}") for t in _TYPES])


_GT = """v AS (SELECT l_suppkey AS chrom, l_partkey AS pos, CAST(l_returnflag = 'A' AS INT) AS a, CAST(l_linestatus = 'F' AS INT) AS b, CAST(l_discount > 0.05 AS INT) AS c FROM lineitem),
u AS (SELECT chrom, pos, max(a) AS a, max(b) AS b, max(c) AS c FROM v GROUP BY ALL)"""


@query(f"WITH {_GT}, p AS (SELECT * FROM u WHERE NOT (a = b AND b = c)) SELECT CAST(chrom AS VARCHAR) AS chrom, pos FROM (SELECT *, row_number() OVER (PARTITION BY chrom ORDER BY md5('3|' || chrom || '|' || pos), CAST(chrom AS VARCHAR), pos) AS k FROM p) WHERE k = 1")
def snp_per_locus(spark, d):
    flag = lambda c: F.max((c).cast("int")).cast("string")
    rows = table(spark, d, "lineitem").groupBy(F.col("l_suppkey").cast("string").alias("chrom"), F.col("l_partkey").alias("pos")).agg(flag(F.col("l_returnflag") == "A").alias("a"), flag(F.col("l_linestatus") == "F").alias("b"), flag(F.col("l_discount") > 0.05).alias("c"))
    call = lambda c: F.concat(F.col(c), F.lit("/"), F.col(c))
    gt = F.create_map(F.lit("a"), call("a"), F.lit("b"), call("b"), F.lit("c"), call("c"))
    return matrices.one_snp_per_locus(rows.select("chrom", "pos", gt.alias("gt")), "3").select("chrom", "pos")


# tests on trees

_LIKELIHOODS = "SELECT CAST(s_suppkey AS VARCHAR) AS locus, CAST(3 + s_nationkey AS INT) AS n_taxa, -abs(s_acctbal) / 100 AS ln_free, -abs(s_acctbal) / 100 - s_suppkey % 40 AS ln_clock FROM supplier"


def _likelihoods(spark, d) -> DataFrame:
    free = -F.abs("s_acctbal") / 100
    return table(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("locus"), (3 + F.col("s_nationkey")).cast("int").alias("n_taxa"), free.alias("ln_free"), (free - F.col("s_suppkey") % 40).alias("ln_clock"))


@query(f"SELECT locus, 2 * (ln_free - ln_clock) AS lrt, n_taxa - 2 AS df FROM ({_LIKELIHOODS}) WHERE n_taxa >= 3")
def lrt(spark, d):
    return trees.likelihood_ratio(_likelihoods(spark, d)).select("locus", "lrt", "df")


@query()
def lrt_pvalue(spark, d):
    return trees.clocklike(_likelihoods(spark, d))


# the streaming operators on a finite table


@query("SELECT time_bucket(INTERVAL 1 hour, ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def stream_window_counts(spark, d):
    rows = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return streams.window_counts(rows).withColumns({"start": F.col("start").cast("timestamp_ntz"), "total": F.round("total", 4)})


@query(
    """WITH l AS (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS p FROM events),
s AS (SELECT user_id, ts, sum(CASE WHEN p IS NULL OR ts >= p + INTERVAL 30 minute THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS g FROM l)
SELECT user_id, min(ts) AS start, count(*) AS n FROM s GROUP BY user_id, g"""
)
def stream_sessions(spark, d):
    rows = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return streams.sessions(rows).withColumn("start", F.col("start").cast("timestamp_ntz"))
