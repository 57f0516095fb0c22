"""Secret scans: fixed patterns and a battery of randomness tests, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Stored, fresh, quoted, table

#: The patterns of the contract; letters of the keywords in either case, ASCII only.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
#: Runs of 24 and more are the maximal runs of that length, so the bound may stand in the pattern.
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "random")
#: A string that may be random: encoded characters, and padding.
CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}"

_LOWER, _UPPER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
#: Encodings from the narrowest to the widest: name and alphabet. The first that holds all characters is inferred.
ENCODINGS = (
    ("hex", _DIGITS + "abcdef"),
    ("HEX", _DIGITS + "ABCDEF"),
    ("base32", _UPPER + "234567"),
    ("base36", _DIGITS + _LOWER),
    ("BASE36", _DIGITS + _UPPER),
    ("base64", _UPPER + _LOWER + _DIGITS + "+/"),
    ("base64url", _UPPER + _LOWER + _DIGITS + "-_"),
)
#: Index of coincidence that ordinary strings have at least (English prose: 0.067); in small alphabets, where even
#: random strings come near it, so many times that of random strings. Strings made of words and numbers lie above.
COINCIDENCE, LEAST_EXCESS = 0.05, 1.6
#: A string that fails the tests of randomness at this level is no secret, however even its letters are.
FAILS = 0.001
#: Level of the false-discovery control, and bins to the unit of -ln p in its histogram.
ALPHA = 0.05
BINS = 50
MOST_BINS = 4000
#: Matches of a text whose lengths are summed together.
STRIDE = 128


def _let(value: Column, body: callable) -> Column:
    """``body(value)`` with the value computed once: a lambda's captured expressions are evaluated at each use."""
    return F.element_at(F.transform(F.array(value), lambda v: body(v)), 1)


def _spans_of(pieces: Column) -> Column:
    hits, gaps = pieces["hits"], pieces["gaps"]
    ends = F.zip_with(hits, F.slice(gaps, F.lit(1), F.size(hits)), lambda h, g: F.struct(F.length(g).alias("g"), F.length(h).alias("h"), h.alias("m")))

    total = lambda part: F.aggregate(part, F.lit(0), lambda a, y: a + y["g"] + y["h"])

    def located(rows: Column) -> Column:
        # prefix sums in two levels, as a text may hold very many matches
        count = F.ceil(F.size(rows) / F.lit(STRIDE)).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), count - 1), lambda b: total(F.slice(rows, b * STRIDE + 1, F.lit(STRIDE))))
        before = _let(blocks, lambda sums: F.transform(sums, lambda _, b: F.aggregate(F.slice(sums, F.lit(1), b), F.lit(0), lambda a, y: a + y)))
        return _let(before, lambda base: starts(rows, base))

    def starts(rows: Column, base: Column) -> Column:
        block = lambda i: F.floor(i / F.lit(STRIDE)).cast("int")
        at = lambda x, i: F.element_at(base, block(i) + 1) + total(F.slice(rows, block(i) * STRIDE + 1, i % STRIDE)) + x["g"]
        found = F.transform(rows, lambda x, i: F.struct(at(x, i).alias("start"), x["h"].alias("n"), x["m"].alias("m")))
        return F.transform(found, lambda x: F.struct(x["start"].alias("start"), (x["start"] + x["n"]).alias("end"), x["m"].alias("m")))

    return _let(ends, located)


def _found(text: Column, pattern: str) -> Column:
    """Matches of a pattern from left to right: array of (start, end, match), in code points.

    What stands between the matches gives their places. A text without a match costs one pass."""
    pieces = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"), F.split(text, pattern, -1).alias("gaps"))
    return F.when(text.rlike(pattern), _let(pieces, _spans_of)).otherwise(F.array().cast("array<struct<start:int,end:int,m:string>>"))


def _upper_normal(z: Column) -> Column:
    """1 - Phi(z), by the logistic approximation (error under 2e-4)."""
    return 1 / (1 + F.exp(1.5976 * z + 0.07056 * z * z * z))


def _two_sided(z: Column) -> Column:
    return F.least(F.lit(1.0), 2 * _upper_normal(F.abs(z)))


def _alphabet(body: Column) -> Column:
    """Alphabet of the narrowest encoding that holds the string; null if none does."""
    out = F.lit(None).cast("string")
    for _, alphabet in reversed(ENCODINGS):
        out = F.when(F.length(F.translate(body, alphabet, "")) == 0, F.lit(alphabet)).otherwise(out)
    return out


def randomness(match: Column) -> Column:
    """(p_random, p_ordinary) of a string in its encoding; null if it is in none.

    ``p_random`` is the p-value of its being uniformly random: chi-squared uniformity over the alphabet
    (Wilson-Hilferty), runs above and below the alphabet's middle, and lag-one serial correlation of the symbols' ranks,
    put together by Fisher's method. A sequence without a test (all symbols on one side) counts as p = 1e-9.
    ``p_ordinary`` is the p-value of its being an ordinary string: the chance that one with the coincidence
    ``COINCIDENCE`` has symbols as even as these (chi-squared, not central, by its normal approximation). Every step
    is linear in the string's length.
    """

    def battery(v: Column) -> Column:
        body, letters = v["body"], v["letters"]
        n, k = F.length(body).cast("double"), F.length(letters).cast("double")
        half = F.floor(k / 2).cast("int")
        seen = F.transform(F.split(letters, ""), lambda c: n - F.length(F.replace(body, c, F.lit(""))))
        chi = F.aggregate(seen, F.lit(0.0), lambda a, x: a + x * x) * k / n - n
        halves = F.concat(F.repeat(F.lit("0"), half), F.repeat(F.lit("1"), F.length(letters) - half))
        bits = F.call_function("translate", body, letters, halves)
        ranks = F.transform(F.split(body, ""), lambda c: F.instr(letters, c).cast("double"))
        return F.struct(n.alias("n"), k.alias("k"), chi.alias("chi"), bits.alias("bits"), ranks.alias("ranks"))

    def combined(v: Column) -> Column:
        n, k, chi, bits = (v[c] for c in ("n", "k", "chi", "bits"))
        df = k - 1
        p_chi = _upper_normal((F.pow(chi / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df)))
        ones = F.length(F.replace(bits, F.lit("0"), F.lit(""))).cast("double")
        mu = 2 * ones * (n - ones) / n + 1
        var = (mu - 1) * (mu - 2) / (n - 1)
        p_runs = F.when(var > 0, _two_sided((F.regexp_count(bits, F.lit("0+|1+")) - mu) / F.sqrt(var))).otherwise(F.lit(1e-9))
        p_lag = _let(_let(v["ranks"], _centred), _serial)
        excess = n * (F.greatest(F.lit(COINCIDENCE) * k, F.lit(LEAST_EXCESS)) - 1)
        p_ordinary = 1 - _upper_normal((chi - df - excess) / F.sqrt(2 * (df + 2 * excess)))
        return F.struct(_let(F.array(p_chi, p_runs, p_lag), _fisher).alias("p_random"), p_ordinary.alias("p_ordinary"))

    encoded = lambda body: F.struct(body.alias("body"), _alphabet(body).alias("letters"))
    tested = lambda v: F.when(v["letters"].isNotNull(), _let(_let(v, battery), combined))
    return _let(_let(F.rtrim(F.translate(match, "=", " ")), encoded), tested)


def _centred(ranks: Column) -> Column:
    mean = F.aggregate(ranks, F.lit(0.0), lambda a, x: a + x) / F.size(ranks)
    return _let(mean, lambda m: F.transform(ranks, lambda x: x - m))


def _serial(off: Column) -> Column:
    """p-value of the lag-one correlation of centred values."""
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    lag = F.zip_with(F.slice(off, F.lit(1), F.size(off) - 1), F.slice(off, F.lit(2), F.size(off) - 1), lambda a, b: a * b)
    sums = F.struct(total(F.transform(off, lambda x: x * x)).alias("power"), total(lag).alias("lag"), F.size(off).cast("double").alias("n"))
    return _let(sums, lambda t: F.when(t["power"] > 0, _two_sided((t["lag"] / t["power"] + 1 / t["n"]) * F.sqrt(t["n"]))).otherwise(F.lit(1e-9)))


def _fisher(ps: Column) -> Column:
    """Fisher's combination of three p-values."""
    half = F.aggregate(ps, F.lit(0.0), lambda a, p: a - F.ln(F.greatest(p, F.lit(1e-30))))
    return _let(half, lambda x: F.exp(-x) * (1 + x + x * x / 2))


def _candidates(text: Column) -> Column:
    """Strings of a text that may be secrets: array of (start, end, stratum, bin), bins of -ln p of being ordinary.

    They hold a letter and a digit, or letters of both cases. Digits alone and letters of one case alone are out of
    scope: numbers of all kinds are as even as random ones."""
    has = lambda x, c: x["m"].rlike(c)  # noqa: E731  one class at a time, as two with a gap between would be quadratic
    mixed = F.filter(_found(text, CANDIDATE), lambda x: (has(x, "[0-9]") & has(x, "[A-Za-z]")) | (has(x, "[a-z]") & has(x, "[A-Z]")))
    tested = F.transform(mixed, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), randomness(x["m"]).alias("p")))
    return F.transform(
        F.filter(tested, lambda x: x["p"].isNotNull()),
        lambda x: F.struct(
            x["start"].alias("start"),
            x["end"].alias("end"),
            F.floor(2 * F.log2((x["end"] - x["start"]).cast("double"))).cast("int").alias("stratum"),
            F.when(x["p"]["p_random"] < FAILS, F.lit(0)).otherwise(F.least(F.lit(MOST_BINS), F.floor(-F.ln(F.greatest(x["p"]["p_ordinary"], F.lit(1e-300))) * BINS)).cast("int")).alias("bin"),
        ),
    )


def discoveries(candidates: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """From which bin of -ln p on a stratum's strings are reported: ``stratum, bin``.

    ``candidates`` has ``stratum`` and ``bin``. Benjamini-Hochberg within each stratum of lengths (two to a doubling),
    so that of the strings that it reports a share of ``alpha`` at most is expected to be ordinary. It runs on a
    histogram of the whole corpus: at most strata x bins rows reach the windows, whatever the corpus is.
    """
    counts = candidates.groupBy("stratum", "bin").count()
    total = Window.partitionBy("stratum")
    upwards = total.orderBy(F.col("bin").desc())
    ranked = counts.withColumn("rank", F.sum("count").over(upwards)).withColumn("m", F.sum("count").over(total))
    return ranked.where(F.exp(-F.col("bin") / F.lit(float(BINS))) <= alpha * F.col("rank") / F.col("m")).groupBy("stratum").agg(F.min("bin").alias("bin"))


def _of_kind(found: Column, kind: int) -> Column:
    return F.transform(found, lambda x: F.struct(x["start"].alias("start"), F.lit(kind).alias("kind"), x["end"].alias("end")))


def scan(docs: DataFrame, text: str, prefix: str) -> DataFrame:
    """``docs`` with the spans of the fixed patterns and the strings that are to be judged: one pass over the texts."""
    body = F.coalesce(F.col(text), F.lit(""))
    assign = F.filter(_found(body, ASSIGN), lambda x: F.length(F.regexp_extract(x["m"], ASSIGN, 1)) >= 6)
    kinds = [assign, _found(body, ACCESS), _found(body, HEX)]
    return docs.withColumns({f"{prefix}_base": F.concat(*[_of_kind(a, k) for k, a in enumerate(kinds)]), f"{prefix}_more": _candidates(body)})


def _last_to(spans: Column, at: Column) -> Column:
    """The last of some spans, sorted and apart from each other, that starts at ``at`` or before; null without one. A binary search."""
    n = F.size(spans)
    steps = F.sequence(F.lit(1), F.greatest(F.lit(1), F.ceil(F.log2((n + 1).cast("double"))).cast("int")))
    middle = lambda a: F.shiftright(a["lo"] + a["hi"], 1)
    pair = lambda lo, hi: F.struct(lo.alias("lo"), hi.alias("hi"))
    step = lambda a, _: F.when(F.get(spans, middle(a))["start"] <= at, pair(middle(a) + 1, a["hi"])).otherwise(pair(a["lo"], middle(a)))
    return F.aggregate(steps, pair(F.lit(0), n), step, lambda a: F.get(spans, a["lo"] - 1))


def decide(scanned: DataFrame, prefix: str, to: str, alpha: float = ALPHA) -> DataFrame:
    """What ``scan`` gave (stored, as it is read twice) with all spans in ``to``. Spans of one kind are apart from each other, so
    whether one of a kind holds a string is decided by a search for a place, however many there are."""
    base, more, known = (f"{prefix}_{x}" for x in ("base", "more", "edges"))
    apart = [f"{prefix}_kind{k}" for k in range(len(KINDS) - 1)]
    found = scanned.select(F.explode(more).alias("c")).select("c.stratum", "c.bin")
    edges = discoveries(found, alpha).agg(F.map_from_entries(F.collect_list(F.struct("stratum", "bin")))).scalar()
    inside = lambda x: F.coalesce(F.greatest(*[_last_to(F.col(c), x["start"])["end"] for c in apart]) >= x["end"], F.lit(False))
    reported = lambda x: (x["bin"] >= F.coalesce(F.element_at(F.col(known), x["stratum"]), F.lit(MOST_BINS + 1))) & ~inside(x)
    random = F.filter(F.col(more), reported)
    split = scanned.withColumns({known: edges} | {c: _kept_kind(F.col(base), k) for k, c in enumerate(apart)})
    return split.withColumn(to, F.array_sort(F.concat(F.col(base), _of_kind(random, len(KINDS) - 1)))).drop(base, more, known, *apart)


def _kept_kind(spans: Column, kind: int) -> Column:
    return F.filter(spans, lambda x: x["kind"] == kind)


def find_secrets(docs: DataFrame, text: str = "text", alpha: float = ALPHA, to: str = "_secret_spans") -> DataFrame:
    """``docs`` with an array of (start, kind, end), by start and kind, in code points with the end exclusive.

    Kinds 0 to 2 are the fixed patterns (assign, access, hex); 3 is a string that is too even for an ordinary one, with
    the false discoveries of each stratum of lengths controlled, unless a pattern's span holds it. Null and empty
    texts have none; equal texts have the same. A column called ``to`` is replaced, other columns may have any names.
    The rows are stored with what was found, so texts are searched once.
    """
    docs = docs.drop(to)
    prefix = fresh([*docs.columns, to], "_s")
    return decide(Stored(scan(docs, text, prefix)).df, prefix, to, alpha)


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with each union of overlapping spans replaced by a mark.

    A span begins a union if none before it reaches it; of each kind only the last one before can. The text is cut once at
    the unions, in an encoding of four bytes each, where a place needs no search."""
    kinds = range(len(KINDS))

    def begun(v: Column) -> Column:
        ends = lambda x: [F.coalesce(_last_to(v[f"k{k}"], x["start"] - F.when(x["kind"] > k, 0).otherwise(1))["end"], F.lit(0)) for k in kinds]
        reached = F.transform(v["spans"], lambda x: F.struct(x["start"].alias("start"), F.greatest(*ends(x)).alias("before")))
        return F.filter(reached, lambda x: x["before"] <= x["start"])

    def pieces(v: Column) -> Column:
        part = lambda a, b: F.decode(F.substring(v["raw"], a * 4 + 1, (b - a) * 4), "UTF-32")
        last = F.greatest(*[F.coalesce(F.try_element_at(v[f"k{k}"], F.lit(-1))["end"], F.lit(0)) for k in kinds])
        tail = F.decode(F.substring(v["raw"], last * 4 + 1, F.octet_length(v["raw"])), "UTF-32")
        return F.array_join(F.concat(F.transform(begun(v), lambda x: part(x["before"], x["start"])), F.array(tail)), mark)

    split = lambda v: F.struct(v["raw"].alias("raw"), v["spans"].alias("spans"), *[_kept_kind(v["spans"], k).alias(f"k{k}") for k in kinds])
    given = F.struct(F.encode(text, "UTF-32").alias("raw"), spans.alias("spans"))
    return F.when(F.size(spans) > 0, _let(_let(given, split), pieces)).otherwise(text)


def _listed(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")


def op9_secrets(spark, sf_dir: str) -> DataFrame:
    scanned = scan(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", "_s").drop("text")
    docs = decide(Stored(scanned).df, "_s", "found")
    spans = F.col("found")
    count = lambda k: F.size(F.filter(spans, lambda x: x["kind"] == k)).cast("long")
    return docs.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(_listed(F.filter(spans, lambda x: x["kind"] < 3)), 256).alias("base_sha256"),
        _listed(spans).alias("spans"),
        count(3).alias("n_random"),
    )


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are struck out of the texts; every document stays, null texts as they are. Columns may have any names."""
    prefix = fresh(docs.columns, "_s")
    found = decide(Stored(scan(docs, "text", prefix)).df, prefix, f"{prefix}_spans")
    clean = redact(F.col("text"), F.col(f"{prefix}_spans"))
    return found.select(*[clean.alias(c) if c == "text" else q for c, q in zip(docs.columns, quoted(docs.columns))])
