"""Sequence functions on columns. All of them are built-in expressions: nothing leaves the JVM."""

from __future__ import annotations

import functools
import re
from itertools import product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: What is compared: letters in upper case, or bases.
LETTERS, BASES = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "ACGT"
#: Bases that an IUPAC code stands for.
IUPAC = {"M": "AC", "R": "AG", "W": "AT", "S": "CG", "Y": "CT", "K": "GT", "V": "ACG", "H": "ACT", "D": "AGT", "B": "CGT", "N": "ACGT"}
#: The standard genetic code, codons in the order of the bases TCAG.
_BASES = "TCAG"
_AMINO = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
CODONS = {"".join(c): a for c, a in zip(product(_BASES, repeat=3), _AMINO)}


def _col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def chars(s) -> Column:
    """The characters of a string; none for an empty one."""
    s = _col(s)
    return F.when(F.length(s) > 0, F.split(s, "")).otherwise(F.array().cast("array<string>"))


def reverse_complement(s) -> Column:
    """Letters other than ACGT pass through."""
    return F.reverse(F.translate(_col(s), "ATCG", "TAGC"))


def canonical(s) -> Column:
    """The smaller of a sequence and its reverse complement: one key for either strand."""
    return F.least(_col(s), reverse_complement(s))


def resolve_ambiguity(s, key) -> Column:
    """Each ambiguity code as one of its bases, the same one for all places of a code in a read.

    The pick is a hash of the read's key and the code, so it repeats. Letters of no code become picks of N."""
    s, key = _col(s), _col(key)
    out = F.translate(s, "acgt", "ACGT")
    for code, bases in IUPAC.items():
        pick = F.substring(F.lit(bases), (F.pmod(F.conv(F.substring(F.md5(F.concat_ws("|", key, F.lit(code))), 1, 8), 16, 10).cast("long"), F.lit(len(bases))) + 1).cast("int"), F.lit(1))
        out = F.replace(out, F.lit(code), pick)
    rest = F.substring(F.lit("ACGT"), (F.pmod(F.conv(F.substring(F.md5(F.concat_ws("|", key, F.lit("?"))), 1, 8), 16, 10).cast("long"), F.lit(4)) + 1).cast("int"), F.lit(1))
    return F.concat_ws("", F.transform(chars(out), lambda c: F.when(F.instr(F.lit("ACGT"), c) > 0, c).otherwise(rest)))


def join_pair(seq1, seq2) -> Column:
    return F.concat(_col(seq1), _col(seq2))


def split_pair(joined, length1) -> Column:
    """The two mates of a joined pair, from the length of the first."""
    joined, length1 = _col(joined), _col(length1)
    return F.struct(F.substring(joined, F.lit(1), length1).alias("seq1"), F.substring(joined, length1 + 1, F.length(joined)).alias("seq2"))


def translate(s, frame: int = 0) -> Column:
    """Amino acids from a frame (0 to 2) on. Unknown codons are X, codons of gaps alone are -, a rest is left out."""
    s = _col(s)
    table = F.create_map(*[F.lit(x) for pair in {**CODONS, "---": "-"}.items() for x in pair])
    n = F.floor((F.length(s) - frame) / 3).cast("int")
    codon = lambda i: F.substring(s, i * 3 + frame + 1, F.lit(3))
    out = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.coalesce(F.element_at(table, codon(i)), F.lit("X")))
    return F.when(n > 0, F.array_join(out, "")).otherwise(F.lit(""))


def strip_trailing_stops(p) -> Column:
    """The protein without its stops at the end; one character alone stays as it is."""
    p = _col(p)
    return F.when(F.length(p) >= 2, F.regexp_replace(p, r"\*+$", "")).otherwise(p)


def count_stops(p) -> Column:
    return F.length(_col(p)) - F.length(F.replace(_col(p), F.lit("*"), F.lit("")))


def codon_position(first, pos) -> Column:
    """Phase of a place relative to a codon's first place, before it too."""
    return F.pmod(_col(pos) - _col(first), F.lit(3))



def bit_planes(s, letters: str) -> Column:
    """A string as bits: for each 64 places a long for each binary digit of a letter's number in ``letters``, from 1 (0: none of them)."""
    digits = len(letters).bit_length()
    clean = F.regexp_replace(_col(s), "[^" + re.escape(letters) + "]", "-")
    rows = [["0", *("01"[n >> d & 1] for n in range(1, len(letters) + 1))] for d in range(digits)]
    word = lambda c: F.struct(*[F.conv(F.translate(c, "-" + letters, "".join(bits)), 2, -10).cast("long").alias(f"p{d}") for d, bits in enumerate(rows)])
    return F.transform(F.regexp_extract_all(clean, F.lit("(?s).{1,64}"), F.lit(0)), lambda c: word(F.rpad(c, 64, "-")))


def compared(a: Column, b: Column, letters: str) -> Column:
    """(comparable, different) places of the bit planes of two strings: 64 places a step."""
    digits = [f"p{d}" for d in range(len(letters).bit_length())]
    any_ = lambda cs: functools.reduce(lambda x, y: x.bitwiseOR(y), cs)
    pair = lambda x, y: F.struct(any_([x[d] for d in digits]).bitwiseAND(any_([y[d] for d in digits])).alias("both"), any_([x[d].bitwiseXOR(y[d]) for d in digits]).alias("other"))
    count = lambda v: F.coalesce(F.bit_count(v), F.lit(0))  # noqa: E731  places past the shorter string are null
    step = lambda t, v: F.struct((t["n"] + count(v["both"])).alias("n"), (t["diff"] + count(v["both"].bitwiseAND(v["other"]))).alias("diff"))
    return F.aggregate(F.zip_with(a, b, pair), F.struct(F.lit(0).alias("n"), F.lit(0).alias("diff")), step)


def _counted(a, b, letters: str) -> Column:
    return compared(bit_planes(a, letters), bit_planes(b, letters), letters)


def hamming(a, b) -> Column:
    """Places in which two strings differ; places past the shorter one count."""
    return F.size(F.filter(F.zip_with(chars(a), chars(b), lambda x, y: ~x.eqNullSafe(y)), lambda v: v))


def comparable_mismatches(a, b) -> Column:
    """Places where both hold a letter, ? or * and differ."""
    return _counted(a, b, LETTERS + "?*")["diff"]


def p_distance(a, b, least=0) -> Column:
    """Share of places with letters in both that differ, rounded to three digits; null under ``least`` such places."""
    counted = _counted(a, b, LETTERS)
    return _held(counted, lambda c: F.when((c["n"] > 0) & (c["n"] >= _lit(least)), F.round(c["diff"].cast("double") / c["n"], 3)))


def nucleotide_distance(a, b) -> Column:
    """Uncorrected distance over places with a base in both; null without any."""
    return _held(_counted(a, b, BASES), lambda c: F.when(c["n"] > 0, c["diff"].cast("double") / c["n"]))


def _held(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _lit(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def kmer_list(s, k: int) -> Column:
    """The k-mers of a string from left to right."""
    s = _col(s)
    return F.when(F.length(s) >= k, F.transform(F.sequence(F.lit(1), F.length(s) - k + 1), lambda i: F.substring(s, i, F.lit(k)))).otherwise(F.array().cast("array<string>"))


def shared_kmers(a, b, k: int) -> Column:
    """Size of the intersection of two short strings' k-mer multisets."""
    one, two = kmer_list(a, k), kmer_list(b, k)
    times = lambda kmers_, x: F.size(F.filter(kmers_, lambda y: y == x))
    return F.aggregate(F.transform(F.array_distinct(one), lambda x: F.least(times(one, x), times(two, x))), F.lit(0), lambda n, x: n + x)


def kmer_counts(rows: DataFrame, seq: str, k: int, *keys: str, among: DataFrame | None = None) -> DataFrame:
    """How often each k-mer occurs in each sequence: ``keys, kmer, times``. An aggregate: nothing is numbered.

    With ``among`` (``kmer``) only those k-mers are kept, before anything is counted."""
    out = rows.select(*keys, F.explode(kmer_list(seq, k)).alias("kmer"))
    if among is not None:
        out = out.join(among.select("kmer").distinct(), "kmer", "left_semi")
    return out.groupBy(*keys, "kmer").agg(F.count("*").alias("times"))


def kmer_places(rows: DataFrame, seq: str, k: int, *keys: str) -> DataFrame:
    """Each k-mer of each sequence with its place, from 1: ``keys, kmer, pos``."""
    return rows.select(*keys, F.posexplode(kmer_list(seq, k)).alias("_i", "kmer")).select(*keys, "kmer", (F.col("_i") + 1).alias("pos"))


def kmers(rows: DataFrame, seq: str, k: int, *keys: str) -> DataFrame:
    """The k-mer multiset of each sequence: ``keys, kmer, pos, occ``; equal k-mers of a sequence are numbered."""
    return kmer_places(rows, seq, k, *keys).withColumn("occ", F.row_number().over(Window.partitionBy(*keys, "kmer").orderBy("pos")))


def count_letters(s, letters: str) -> Column:
    """How many characters of a string are among ``letters``."""
    s = _col(s)
    return F.length(s) - F.length(F.translate(s, letters, ""))


def gc(s) -> Column:
    """Share of G and C among the bases; null without bases."""
    n = count_letters(s, "ACGT")
    return F.when(n > 0, count_letters(s, "GC").cast("double") / n)


def coverage(s) -> Column:
    """Share of characters that aren't gaps, to three digits; null for an empty string."""
    s = _col(s)
    return F.when(F.length(s) > 0, F.round((F.length(s) - count_letters(s, "-")).cast("double") / F.length(s), 3))


def columns_to_base(s, n) -> Column:
    """Columns up to the base with index n (from 0), itself included; null if there are fewer bases."""
    places = F.filter(F.transform(chars(s), lambda c, i: F.when(c != "-", i + 1)), lambda i: i.isNotNull())
    return F.try_element_at(places, (_lit(n) + 1).cast("int"))


def locate_ungapped(flanked, coding) -> Column:
    """Columns of an aligned flanked row before and through its coding part; null if that doesn't occur in it."""
    bare, part = F.replace(_col(flanked), F.lit("-"), F.lit("")), F.replace(_col(coding), F.lit("-"), F.lit(""))
    at = F.instr(bare, part)
    start, end = columns_to_base(flanked, at - 1), columns_to_base(flanked, at + F.length(part) - 2)
    return F.when((at > 0) & (F.length(part) > 0), F.struct((start - 1).alias("left"), (end - start + 1).alias("coding"), (F.length(_col(flanked)) - end).alias("right")))


def leading_gaps(s) -> Column:
    s = _col(s)
    return F.length(s) - F.length(F.ltrim(s, F.lit("-")))


def trailing_gaps(s) -> Column:
    s = _col(s)
    return F.length(s) - F.length(F.rtrim(s, F.lit("-")))


def masked_share(seq, start=None, end=None) -> Column:
    """Share of lower-case letters between two places (from 1, both included); of the whole where these are null."""
    seq = _col(seq)
    part = seq if start is None else F.when(_col(start).isNull() | _col(end).isNull(), seq).otherwise(F.substring(seq, _col(start), _col(end) - _col(start) + 1))
    return F.when(F.length(part) > 0, count_letters(part, "abcdefghijklmnopqrstuvwxyz").cast("double") / F.length(part)).otherwise(F.lit(0.0))


def thread_back(aligned, dna) -> Column:
    """DNA in the gap pattern of its aligned protein: three gaps for a gap, the next codon for a residue."""
    bare = F.replace(_col(dna), F.lit("-"), F.lit(""))
    letters = chars(aligned)
    before = lambda i: i - count_letters(F.substring(_col(aligned), F.lit(1), i), "-")
    return F.array_join(F.transform(letters, lambda c, i: F.when(c == "-", F.lit("---")).otherwise(F.substring(bare, before(i) * 3 + 1, F.lit(3)))), "")


def degap(s) -> Column:
    return F.replace(_col(s), F.lit("-"), F.lit(""))


def percent(part, whole, digits: int = 2) -> Column:
    return F.when(_col(whole) != 0, F.round(_col(part).cast("double") * 100 / _col(whole), digits))


def genotype(call) -> Column:
    """Alleles of a diploid call and their sum; - where a side is missing. Any separator does."""
    call = _col(call)
    a, b = F.substring(call, 1, 1), F.substring(call, 3, 1)
    full = (a != ".") & (b != ".")
    return F.struct(a.alias("a1"), b.alias("a2"), F.when(full, (a.try_cast("int") + b.try_cast("int")).cast("string")).otherwise(F.lit("-")).alias("sum"))


def header_fields(header, sep: str, names: list[str], last: bool = False) -> Column:
    """Named fields of a header, counted from its start, or with ``last`` from its end."""
    parts = F.split(_col(header), sep)
    at = (lambda i: i - len(names)) if last else (lambda i: i + 1)
    return F.struct(*[F.try_element_at(parts, F.lit(at(i))).alias(n) for i, n in enumerate(names)])


def is_nucleotide(s) -> Column:
    """Half of a sequence's characters or more are A, C, G or T."""
    s = _col(s)
    return (F.length(s) > 0) & (count_letters(F.upper(s), "ACGT").cast("double") / F.length(s) >= 0.5)


def parse_size(text: str, unit: str = "M") -> int:
    """Bytes of a size such as 1G or 200M; a bare number is in ``unit``."""
    powers = {"K": 1, "M": 2, "G": 3, "T": 4}
    text = text.strip().upper().removesuffix("B")
    number, power = (text[:-1], powers[text[-1]]) if text[-1:] in powers else (text, powers[unit])
    if not number or float(number) < 0:
        raise ValueError(f"no size: {text!r}")
    return int(float(number) * 1024**power)


def size_bytes(size, unit: str = "M") -> Column:
    """:func:`parse_size` of a column; null where a string is no size."""
    text = F.upper(F.trim(_col(size)))
    number, letter = F.regexp_extract(text, r"^([0-9]*\.?[0-9]+)[KMGT]?B?$", 1), F.regexp_extract(text, r"([KMGT])B?$", 1)
    power = F.instr(F.lit("KMGT"), F.when(letter == "", F.lit(unit)).otherwise(letter))
    return F.when(number != "", F.floor(number.cast("double") * F.pow(F.lit(1024.0), power.cast("double"))).cast("long"))


def duration_words(seconds) -> Column:
    """:func:`duration` of a column of whole seconds."""
    t = _col(seconds).cast("long")
    part = lambda least, size, unit: F.when(t >= least, F.concat((F.floor(t / size) % F.lit(1 << 40 if size == 3600 else 60)).cast("string"), F.lit(unit))).otherwise("")
    return F.when(t.isNotNull(), F.concat(part(3600, 3600, "h "), part(60, 60, "m "), (t % 60).cast("string"), F.lit("s")))


def duration(seconds: int) -> str:
    """Hours, minutes and seconds in words that are short."""
    h, m, s = seconds // 3600, seconds // 60 % 60, seconds % 60
    return f"{h}h {m}m {s}s" if h else f"{m}m {s}s" if m else f"{s}s"
