"""Column expressions over nucleotide sequences; all stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Complements of the IUPAC codes, and the standard genetic code by codon in the order A, C, G, T.
IUPAC_FROM = "ACGTacgtyrkmYRKMUu"
IUPAC_TO = "TGCAtgcarymkRYMKAa"
BASES = "ACGT"
STANDARD_CODE = "KNKNTTTTRSRSIIMIQHQHPPPPRRRRLLLLEDEDAAAAGGGGVVVV*Y*YSSSS*CWCLFLF"
# Codons of other genetic codes that differ from the standard one.
CODE_CHANGES = {
    "Universal": {},
    "Tetrahymena": {"TAA": "Q", "TAG": "Q"},
    "Acetabularia": {"TAA": "Q", "TAG": "Q"},
    "Ciliate": {"TAA": "Q", "TAG": "Q"},
    "Dasycladacean": {"TAA": "Q", "TAG": "Q"},
    "Hexamita": {"TAA": "Q", "TAG": "Q"},
    "Candida": {"CTG": "S"},
    "Euplotid": {"TGA": "C"},
    "SR1_Gracilibacteria": {"TGA": "G"},
    "Pachysolen_tannophilus": {"CTG": "A"},
    "Mesodinium": {"TAA": "Y", "TAG": "Y"},
    "Peritrich": {"TAA": "E", "TAG": "E"},
    "Mitochondrial-Vertebrates": {"AGA": "*", "AGG": "*", "ATA": "M", "TGA": "W"},
    "Mitochondrial-Yeast": {"ATA": "M", "CTA": "T", "CTC": "T", "CTG": "T", "CTT": "T", "TGA": "W"},
    "Mitochondrial-Invertebrates": {"AGA": "S", "AGG": "S", "ATA": "M", "TGA": "W"},
    "Mitochondrial-Protozoan": {"TGA": "W"},
    "Mitochondrial-Ascidian": {"AGA": "G", "AGG": "G", "ATA": "M", "TGA": "W"},
    "Mitochondrial-Echinoderm": {"AAA": "N", "AGA": "S", "AGG": "S", "TGA": "W"},
    "Mitochondrial-Flatworm": {"AAA": "N", "AGA": "S", "AGG": "S", "TAA": "Y", "TGA": "W"},
}


def genetic_code(name: str = "Universal") -> dict[str, str]:
    codons = [a + b + c for a in BASES for b in BASES for c in BASES]
    return dict(zip(codons, STANDARD_CODE, strict=True)) | CODE_CHANGES[name]


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, IUPAC_FROM, IUPAC_TO))


def gc_percent(seq: Column) -> Column:
    """Share of G and C in percent; null for an empty sequence."""
    return F.try_divide(F.regexp_count(seq, F.lit("[GCgc]")) * F.lit(100.0), F.length(seq))


def kmers(seq: Column, k: int) -> Column:
    """All k-mers in order, in one pass; empty if the sequence is null or shorter than k. For sequences of any length see operators.kmers.positions, which needs no array of them all."""
    return F.coalesce(F.regexp_extract_all(seq, F.lit(f"(?s)(?=(.{{{k}}}))."), F.lit(1)), F.array().cast("array<string>"))


def overlapping_blocks(seq: Column, k: int, size: int) -> Column:
    """The sequence cut into blocks of ``size`` k-mers, in one pass: each k-mer starts in the first ``size`` places of just one block."""
    return F.regexp_extract_all(seq, F.lit(f"(?s)(?=(.{{{k},{size + k - 1}}})).{{1,{size}}}"), F.lit(1))


def canonical(kmer: Column) -> Column:
    return F.least(kmer, reverse_complement(kmer))


def translated(seq: Column, frame: int, code: str = "Universal") -> Column:
    """Protein of frame 1 to 3, or of the reverse complement for 4 to 6. Unknown codons give X, a partial codon nothing."""
    if not 1 <= frame <= 6:
        raise ValueError("frame must be 1 to 6")
    strand = F.translate(F.upper(seq), "U", "T")
    if frame > 3:
        strand = reverse_complement(strand)
    start = (frame - 1) % 3 + 1
    table = "".join(aa for _, aa in sorted(genetic_code(code).items()))

    def amino(codon: Column) -> Column:
        a, b, c = (F.instr(F.lit(BASES), F.substring(codon, k, 1)) - 1 for k in (1, 2, 3))
        return F.when((a >= 0) & (b >= 0) & (c >= 0), F.substring(F.lit(table), a * 16 + b * 4 + c + 1, F.lit(1))).otherwise("X")

    def protein(st: Column) -> Column:
        # One pass cuts all codons; taking them by position would start from the front for each.
        codons = F.regexp_extract_all(F.substring(st, F.lit(start), F.length(st)), F.lit("(?s)(...)"), F.lit(1))
        return F.array_join(F.transform(codons, amino), "")

    # A one-element array binds the strand to a name: it is made once, and not for each codon.
    return F.element_at(F.transform(F.array(strand), protein), 1)


def best_protein(seq: Column, code: str = "Universal") -> Column:
    """The first forward frame without a stop before its end, or else the one with fewest stops."""
    frames = F.array(*[F.struct(F.regexp_count(F.regexp_replace(translated(seq, f, code), r"\*$", ""), F.lit(r"\*")).alias("stops"), F.lit(f).alias("frame"), translated(seq, f, code).alias("protein")) for f in (1, 2, 3)])
    return F.array_min(frames)["protein"]


def wrapped(seq: Column, width: int = 60) -> Column:
    """The sequence in lines of width; width 0 or less leaves it as it is."""
    if width <= 0:
        return seq
    return F.regexp_replace(F.regexp_replace(seq, f"(.{{{width}}})", "$1\n"), "\n$", "")


def core_read_name(name: Column) -> Column:
    return F.regexp_replace(name, "/[12]$", "")


def fasta_record(accession: Column, seq: Column, width: int = 60) -> Column:
    return F.concat(F.lit(">"), accession, F.lit("\n"), wrapped(seq, width))


def gene_of_transcript(acc: Column) -> Column:
    """Gene part of an assembled transcript's name: up to c<n>_g<n>, or comp<n>_c<n>."""
    new, old = F.regexp_extract(acc, r"^(.*c\d+_g\d+)_i\d+", 1), F.regexp_extract(acc, r"^(.*comp\d+_c\d+)", 1)
    return F.when(new != "", new).when(old != "", old)


def seed_entropy(seq: Column) -> Column:
    """Shannon entropy in bits of the four bases."""
    n = F.length(seq)
    total = F.lit(0.0)
    for b in BASES:
        p = F.try_divide(F.regexp_count(seq, F.lit(b)), n)
        total = total - F.when(p > 0, p * F.log2(p)).otherwise(0.0)
    return total


def hash_uniform(*key: Column, seed: int = 0) -> Column:
    """A number in [0, 1) from the key's digest, the same on any engine that has md5."""
    digest = F.md5(F.concat_ws("|", *[k.cast("string") for k in key], F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))
