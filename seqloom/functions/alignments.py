"""Column expressions over alignments: flags, CIGAR strings, block lists, closed intervals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The bits of an alignment's flag.
FLAGS = {
    "paired": 0x1, "proper_pair": 0x2, "unmapped": 0x4, "mate_unmapped": 0x8, "reverse": 0x10, "mate_reverse": 0x20,
    "first": 0x40, "second": 0x80, "secondary": 0x100, "fails_qc": 0x200, "duplicate": 0x400, "supplementary": 0x800,
}
_BLOCK = "struct<lend:int,rend:int>"


def has_flag(flag: Column, name: str) -> Column:
    return flag.bitwiseAND(F.lit(FLAGS[name])) != 0


def with_flag(flag: Column, name: str, on: bool = True) -> Column:
    bit = F.lit(FLAGS[name])
    return flag.bitwiseOR(bit) if on else flag.bitwiseAND(F.bitwise_not(bit))


def flag_names(flag: Column) -> Column:
    """Names of the set bits, lowest first."""
    return F.array_compact(F.array(*[F.when(has_flag(flag, n), F.lit(n)) for n in FLAGS]))


def cigar_steps(cigar: Column) -> Column:
    """[(n, op)] of a CIGAR string."""
    sizes = F.regexp_extract_all(cigar, F.lit(r"(\d+)[MIDNSHP=X]"), 1)
    ops = F.regexp_extract_all(cigar, F.lit(r"\d+([MIDNSHP=X])"), 1)
    return F.zip_with(sizes, ops, lambda n, o: F.struct(n.cast("int").alias("n"), o.alias("op")))


def aligned_blocks(pos: Column, cigar: Column, reverse: Column) -> Column:
    """(genome, query): the blocks aligned base by base. M, = and X consume both, D and N the genome, I, S and H the query.

    Query blocks count from the read's own start, so on the reverse strand they are flipped.
    """
    steps = cigar_steps(cigar)
    start = F.struct(pos.cast("int").alias("g"), F.lit(1).alias("q"), F.array().cast(f"array<{_BLOCK}>").alias("gb"), F.array().cast(f"array<{_BLOCK}>").alias("qb"))

    def step(acc: Column, s: Column) -> Column:
        both = s.op.isin("M", "=", "X")
        on_g, on_q = both | s.op.isin("D", "N"), both | s.op.isin("I", "S", "H")
        block = lambda at: F.array(F.struct(at.alias("lend"), (at + s.n - 1).alias("rend")))
        return F.struct(
            F.when(on_g, acc.g + s.n).otherwise(acc.g).alias("g"), F.when(on_q, acc.q + s.n).otherwise(acc.q).alias("q"),
            F.when(both, F.concat(acc.gb, block(acc.g))).otherwise(acc.gb).alias("gb"), F.when(both, F.concat(acc.qb, block(acc.q))).otherwise(acc.qb).alias("qb"),
        )

    def finish(acc: Column) -> Column:
        flipped = F.reverse(F.transform(acc.qb, lambda b: F.struct((acc.q - b.rend).alias("lend"), (acc.q - b.lend).alias("rend"))))
        return F.struct(acc.gb.alias("genome"), F.when(reverse, flipped).otherwise(acc.qb).alias("query"))

    return F.aggregate(steps, start, step, finish)


def span(blocks: Column) -> Column:
    return F.struct(F.array_min(blocks.lend).alias("lend"), F.array_max(blocks.rend).alias("rend"))


def aligned_length(blocks: Column) -> Column:
    return F.aggregate(blocks, F.lit(0), lambda a, b: a + b.rend - b.lend + 1)


def introns(blocks: Column, least: int = 1) -> Column:
    """Gaps between neighbouring blocks of at least so many bases."""
    gaps = F.zip_with(F.slice(blocks, 1, F.greatest(F.size(blocks) - 1, F.lit(0))), F.slice(blocks, 2, F.greatest(F.size(blocks) - 1, F.lit(0))), lambda a, b: F.struct((a.rend + 1).alias("lend"), (b.lend - 1).alias("rend")))
    return F.filter(gaps, lambda g: g.rend - g.lend + 1 >= least)


def spliced_sequence(genome: Column, blocks: Column) -> Column:
    return F.array_join(F.transform(blocks, lambda b: F.substring(genome, b.lend, b.rend - b.lend + 1)), "")


def transcribed_strand(flag: Column, library: str) -> Column:
    """Strand of the transcript for library types F, R, FR and RF."""
    reverse = has_flag(flag, "reverse")
    own, other = F.when(reverse, "-").otherwise("+"), F.when(reverse, "+").otherwise("-")
    if library in ("F", "R"):
        return own if library == "F" else other
    if library in ("FR", "RF"):
        forward = "first" if library == "FR" else "second"
        return F.when(has_flag(flag, forward), own).otherwise(other)
    raise ValueError(f"unknown library type {library}")


def overlaps(a_lend: Column, a_rend: Column, b_lend: Column, b_rend: Column) -> Column:
    return (a_lend <= b_rend) & (a_rend >= b_lend)


def contains(a_lend: Column, a_rend: Column, b_lend: Column, b_rend: Column) -> Column:
    return (a_lend <= b_lend) & (a_rend >= b_rend)


def overlap_length(a_lend: Column, a_rend: Column, b_lend: Column, b_rend: Column) -> Column:
    return F.greatest(F.least(a_rend, b_rend) - F.greatest(a_lend, b_lend) + 1, F.lit(0))


def sum_overlaps(a: Column, b: Column) -> Column:
    """Bases that two block lists share."""
    return F.aggregate(a, F.lit(0), lambda acc, x: acc + F.aggregate(b, F.lit(0), lambda s, y: s + overlap_length(x.lend, x.rend, y.lend, y.rend)))


def compatible(a: Column, b: Column) -> Column:
    """Spans overlap, and within the overlap both have the same introns."""
    lo, hi = F.greatest(span(a).lend, span(b).lend), F.least(span(a).rend, span(b).rend)
    inner = lambda x: F.filter(introns(x), lambda g: (g.rend >= lo) & (g.lend <= hi))
    return (lo <= hi) & (inner(a) == inner(b))


def psl_identity(matches: Column, mismatches: Column) -> Column:
    return F.try_divide(matches * 100.0, matches + mismatches)


def cigar_of_blocks(genome: Column, query: Column, query_length: Column, spliced: Column) -> Column:
    """A CIGAR string from aligned blocks: soft clips at the ends, N (or D where spliced is false) for genome gaps, I for query gaps.

    genome and query are blocks on the forward strand in order; spliced[i] tells of the gap after block i.
    """
    n = F.size(genome)

    def part(b: Column, i: Column) -> Column:
        g, q = F.get(genome, i), F.get(query, i)
        ng, nq = F.get(genome, i + 1), F.get(query, i + 1)
        size = lambda x, o: F.when(x > 0, F.concat(x.cast("string"), o)).otherwise("")
        gaps = F.concat(size(nq.lend - q.rend - 1, F.lit("I")), size(ng.lend - g.rend - 1, F.when(F.get(spliced, i), "N").otherwise("D")))
        return F.concat(size(g.rend - g.lend + 1, F.lit("M")), F.when(i + 1 < n, gaps).otherwise(""))

    clip = lambda x: F.when(x > 0, F.concat(x.cast("string"), F.lit("S"))).otherwise("")
    return F.concat(clip(F.get(query, F.lit(0)).lend - 1), F.array_join(F.transform(genome, part), ""), clip(query_length - F.element_at(query, -1).rend))
