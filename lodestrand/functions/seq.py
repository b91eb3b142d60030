"""Sequence, header and CIGAR expressions (JVM-side columns)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def remove_version(acc: Column) -> Column:
    """Accession without a trailing ``.digits``."""
    return F.regexp_replace(acc, r"\.[0-9]*$", "")


def accession(header: Column) -> Column:
    """Accession of a ``gi|n|db|ACC|`` header, else the header; without version."""
    parts = F.split(header, r"\|")
    return remove_version(F.when((F.element_at(parts, 1) == "gi") & (F.size(parts) >= 4), F.get(parts, F.lit(3))).otherwise(header))


def versioned_accession(header: Column) -> Column:
    """Accession of a ``gi|n|db|ACC|`` header with its version, else the header."""
    parts = F.split(header, r"\|")
    return F.when((F.element_at(parts, 1) == "gi") & (F.size(parts) >= 4), F.get(parts, F.lit(3))).otherwise(header)


def accessions(header: Column) -> Column:
    """All accessions of a header that joins several by ``\\x01`` (``gnl|uv|ACC:`` too)."""
    one = lambda h: F.when(h.startswith("gnl|uv|"), F.split_part(F.split_part(h, F.lit("|"), F.lit(3)), F.lit(":"), F.lit(1))).otherwise(accession(h))
    return F.transform(F.split(header, "\x01"), one)


def trim_read_no(name: Column) -> Column:
    """Read name without ``/1`` or ``/2`` (any digit)."""
    return F.when(F.length(name) > 2, F.regexp_replace(name, "/[0-9]$", "")).otherwise(name)


def header_taxid(header: Column) -> Column:
    found = F.regexp_extract(header, r"taxid\|(\d+)$", 1)
    return F.when(found != "", found.cast("int"))


def hits(text: Column) -> Column:
    """``score,ref;score,ref`` as array<struct<score double, ref string>>; ``*`` and '' are empty."""
    kept = F.filter(F.split(F.when(text == "*", "").otherwise(text), ";"), lambda x: x != "")
    return F.transform(kept, lambda x: F.struct(F.split_part(x, F.lit(","), F.lit(1)).cast("double").alias("score"), F.split_part(x, F.lit(","), F.lit(2)).alias("ref")))


def reverse_complement(seq: Column) -> Column:
    """IUPAC-safe and case-preserving."""
    return F.reverse(F.translate(seq, "ACGTUMRYKVHDBacgtumrykvhdb", "TGCAAKYRMBDHVtgcaakyrmbdhv"))


def strand_key(seq: Column) -> Column:
    """The same text for a sequence and its reverse complement."""
    a, b = F.md5(seq), F.md5(reverse_complement(seq))
    return F.concat(F.least(a, b), F.greatest(a, b))


def count_of(seq: Column, letters: str) -> Column:
    return (F.length(seq) - F.length(F.translate(seq, letters, ""))).cast("long")


def gc(seq: Column) -> Column:
    """Share of G and C among all bases (0 for an empty sequence)."""
    return F.when(F.length(seq) > 0, count_of(seq, "GCgc") / F.length(seq)).otherwise(0.0)


def kmers(seq: Column, k: int) -> Column:
    """All k-mers in order, in one pass over an ASCII sequence; null for a null one."""
    return F.regexp_extract_all(seq, F.lit(f"(?s)(?=(.{{{k}}}))"), F.lit(1))


def canonical(kmer: Column) -> Column:
    """The greater of a k-mer and its reverse complement (A<C<G<T)."""
    return F.greatest(kmer, F.reverse(F.translate(kmer, "ACGT", "TGCA")))


def canonical_kmers(seq: Column, k: int, letters: str = ".") -> Column:
    """The canonical k-mers of a sequence, in order, with one complement for the whole sequence; ``letters``: a pattern that all letters of a k-mer match (the same for complements)."""
    found = lambda s: F.regexp_extract_all(s, F.lit(f"(?s)(?=({letters}{{{k}}}))"), F.lit(1))
    return F.zip_with(found(seq), F.reverse(found(F.reverse(F.translate(seq, "ACGT", "TGCA")))), lambda a, b: F.greatest(a, b))


def neighbours(kmer: Column, k: int) -> Column:
    """A k-mer and all k-mers one substitution away."""
    at = F.sequence(F.lit(1), F.lit(k))
    swap = lambda i: F.transform(F.array(*[F.lit(b) for b in "ACGT"]), lambda b: F.concat(F.substr(kmer, F.lit(1), i - 1), b, F.substr(kmer, i + 1)))
    return F.array_distinct(F.flatten(F.transform(at, swap)))


def tiles(seq: Column, size: int, step: int) -> Column:
    """array<struct<start (0-based), tile>>; the last tile ends at the sequence's end, short sequences give none."""
    n = F.length(seq)
    starts = F.array_distinct(F.transform(F.sequence(F.lit(0), n - size + step - 1, F.lit(step)), lambda s: F.least(s, n - size)))
    return F.when(n >= size, F.transform(starts, lambda s: F.struct(s.alias("start"), F.substr(seq, s + 1, F.lit(size)).alias("tile"))))


def cigar_ops(cigar: Column) -> Column:
    """array<struct<n int, op string>>."""
    return F.transform(F.regexp_extract_all(cigar, F.lit(r"(\d+[MIDNSHP=X])"), F.lit(1)), lambda x: F.struct(F.regexp_extract(x, r"^(\d+)", 1).cast("int").alias("n"), F.right(x, F.lit(1)).alias("op")))


def cigar_length(cigar: Column, ops: str) -> Column:
    """Bases of a CIGAR in the named operations (reference: ``M=XDN``, query: ``M=XIS``)."""
    return F.aggregate(cigar_ops(cigar), F.lit(0), lambda a, x: a + F.when(F.instr(F.lit(ops), x.op) > 0, x.n).otherwise(0))


def cigar_score(cigar: Column, edits: Column, match: int = 1, mismatch: int = 2, gap_open: int = 3, gap_extend: int = 1) -> Column:
    """match * M - mismatches * (match + mismatch) - gaps * (open + extend * length)."""
    ops = F.filter(cigar_ops(cigar), lambda x: x.op.isin("I", "D"))
    indels = F.aggregate(ops, F.lit(0), lambda a, x: a + x.n)
    penalty = F.aggregate(ops, F.lit(0), lambda a, x: a + gap_open + gap_extend * x.n)
    return cigar_length(cigar, "M=X") * match - (edits - indels) * (match + mismatch) - penalty


def mask_runs(seq: Column, least: int = 15) -> Column:
    """Runs of at least ``least`` lower-case letters as N, other letters in upper case."""
    parts = F.regexp_extract_all(seq, F.lit("([a-z]+|[^a-z]+)"), F.lit(1))
    return F.array_join(F.transform(parts, lambda p: F.when(p.rlike("^[a-z]") & (F.length(p) >= least), F.repeat(F.lit("N"), F.length(p))).otherwise(F.upper(p))), "")


def mask_region(seq: Column, start: Column, size: Column) -> Column:
    """N over [start, start + size), 0-based; a region over the end is moved left."""
    at = F.greatest(F.least(start, F.length(seq) - size), F.lit(0))
    return F.overlay(seq, F.repeat(F.lit("N"), F.least(size, F.length(seq))), at + 1, F.least(size, F.length(seq)))


def error_rates(qual: Column, offset: int = 33) -> Column:
    """Error probability of each base of a quality string."""
    return F.transform(each_letter(qual), lambda c: F.pow(F.lit(10.0), -(F.ascii(c) - offset) / 10.0))


def average_quality(qual: Column, offset: int = 33) -> Column:
    """Phred value of the mean error probability, as a whole number."""
    p = F.aggregate(error_rates(qual, offset), F.lit(0.0), lambda a, x: a + x) / F.length(qual)
    return F.when(F.length(qual) > 0, F.floor(-10 * F.log10(p) + 1e-9))


def optimal_trim(qual: Column, average_error: float, offset: int = 33) -> Column:
    """struct<start, size>: the stretch with the greatest sum of (average_error - error rate), longest among ties; size 0 where no base gains."""
    zero, whole = F.lit(0.0), F.lit(0)
    state = F.struct(zero.alias("run"), whole.alias("from"), zero.alias("best"), whole.alias("start"), whole.alias("size"), whole.alias("at"))

    def step(s: Column, p: Column) -> Column:
        fresh = s.run < -1e-9
        run = F.when(fresh, 0.0).otherwise(s.run) + (average_error - p)
        begin = F.when(fresh, s.at).otherwise(s["from"])
        size = s.at + 1 - begin
        # sums that differ by rounding alone are equal
        better = (run > s.best + 1e-9) | ((F.abs(run - s.best) <= 1e-9) & (run > 1e-9) & (size > s.size))
        return F.struct(run.alias("run"), begin.alias("from"), F.when(better, run).otherwise(s.best).alias("best"), F.when(better, begin).otherwise(s.start).alias("start"), F.when(better, size).otherwise(s["size"]).alias("size"), (s.at + 1).alias("at"))

    return F.aggregate(error_rates(qual, offset), state, step, lambda s: F.struct(s.start.alias("start"), s["size"].alias("size")))


def force_trim(seq: Column, left: int = 0, right: int | None = None, tail: int = 0, multiple: int = 0) -> Column:
    """Bases from ``left`` to ``right`` (0-based, inclusive), less ``tail`` at the end; lengths cut to a multiple."""
    n = F.length(seq)
    end = F.least(n if right is None else F.least(n, F.lit(right + 1)), n - tail)
    if multiple:
        end = F.least(end, n - n % multiple)
    return F.substr(seq, F.lit(left + 1), F.greatest(end - left, F.lit(0)))


def entropy(seq: Column, window: int = 50, k: int = 5) -> Column:
    """Mean over all windows of the entropy of their k-mers, scaled to [0, 1]; N counts as A. One for sequences shorter than a window."""
    per = window - k + 1

    def of(text: str | None) -> float | None:
        if text is None:
            return None
        raw = np.frombuffer(text.upper().replace("N", "A").encode("latin-1", "replace"), np.uint8).astype(np.int64)
        if len(raw) < window:
            return 1.0
        words = sum(raw[i : len(raw) - k + 1 + i] << 8 * i for i in range(k))
        total, count = 0.0, len(raw) - window + 1
        for first in range(0, count, 16_384):
            rows = np.sort(np.lib.stride_tricks.sliding_window_view(words[first : first + 16_384 + per - 1], per), axis=1)
            begins = np.flatnonzero(np.c_[np.ones(len(rows), bool), rows[:, 1:] != rows[:, :-1]])
            share = np.diff(np.r_[begins, rows.size]) / per
            total -= float((share * np.log(share)).sum())
        return total / np.log(per) / count

    @F.pandas_udf("double")
    def run(column: pd.Series) -> pd.Series:
        return column.map(of, na_action="ignore").astype(float)

    return run(seq)


#: Amino acids of the standard code, codons in the order of A, C, G, T at each place.
AMINO_ACIDS = "KNKNTTTTRSRSIIMIQHQHPPPPRRRRLLLLEDEDAAAAGGGGVVVV*Y*YSSSS*CWCLFLF"


def translate_frame(seq: Column, frame: int) -> Column:
    """Protein of frame 0 to 2 (forward) or 3 to 5 (reverse complement)."""
    s = reverse_complement(seq) if frame > 2 else seq
    digits = F.translate(s, "ACGT", "0123")
    codons = F.regexp_extract_all(F.substr(digits, F.lit(frame % 3 + 1)), F.lit("(?s)(.{3})"), F.lit(1))
    index = lambda c: F.conv(c, 4, 10).cast("int") + 1
    return F.array_join(F.transform(codons, lambda c: F.when(c.rlike("^[0-3]{3}$"), F.substr(F.lit(AMINO_ACIDS), index(c), F.lit(1))).otherwise("X")), "")


def lowest_rank_code(rank: Column) -> Column:
    """D for superkingdom, the first capital of the other main ranks, else -."""
    main = ("domain", "kingdom", "phylum", "class", "order", "family", "genus", "species")
    return F.when(rank == "superkingdom", "D").when(rank.isin(*main), F.upper(F.substr(rank, F.lit(1), F.lit(1)))).otherwise("-")


def allele_frequency(ref: Column, alt: Column, depth: Column, alleles: Column) -> Column:
    """Count of a variant's allele over the depth: the base, ``I`` + inserted or ``D`` + deleted bases."""
    key = F.when(F.length(ref) == F.length(alt), alt).when(F.length(alt) > F.length(ref), F.concat(F.lit("I"), F.substr(alt, F.lit(2)))).otherwise(F.concat(F.lit("D"), F.substr(ref, F.lit(2))))
    return F.when(depth > 0, F.coalesce(F.try_element_at(alleles, key), F.lit(0)) / depth).otherwise(0.0)


def each_letter(seq: Column) -> Column:
    """The letters of a text as an array, in one pass; null for a null one."""
    return F.regexp_extract_all(seq, F.lit("(?s)(.)"), F.lit(1))


def phred(qual: Column, offset: int = 33) -> Column:
    """The Phred values of a quality string."""
    return F.transform(each_letter(qual), lambda c: F.ascii(c) - offset)


def plain_bases(seq: Column) -> Column:
    """Ambiguity codes as the first base that they stand for, in upper case; what is no base as N."""
    return F.regexp_replace(F.translate(F.upper(seq), "RYSWKMBDHVU", "ACCAGACAAAT"), "[^ACGTN]", "N")


def simulated_origin(name: Column, comment: Column) -> Column:
    """Accession (no version) that a simulated read comes from: of its comment, or else of its name up to the first -, | or /."""
    own = accession(F.regexp_extract(name, r"^([^-|/]*)", 1))
    return F.when(F.coalesce(comment, F.lit("")) != "", accession(comment)).otherwise(own)


def species_field(line: Column) -> Column:
    """What stands behind ``species--`` in the first tab-separated field that begins so; null where none does."""
    found = F.filter(F.split(line, "\t"), lambda x: x.startswith("species--"))
    return F.substr(F.get(found, F.lit(0)), F.lit(10))


def allele_json(alleles: Column) -> Column:
    return F.to_json(alleles)


def alleles_of(text: Column) -> Column:
    """map<string, int> of JSON text."""
    return F.from_json(text, "map<string,int>")
