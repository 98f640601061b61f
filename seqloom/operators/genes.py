"""Open reading frames, splice models of genes, merged alignments, abundances of ambiguous reads, read trimming."""

from __future__ import annotations

import warnings
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import seq as S
from ..workers import importable
from . import graphs

_FROM = str.maketrans(S.IUPAC_FROM, S.IUPAC_TO)


# Open reading frames ---------------------------------------------------------------------------------------------
def orfs_of(sequence: str, shortest: int = 30, partial: bool = True, both_strands: bool = True, code: str = "Universal") -> list[tuple]:
    """(start, end, strand, frame, protein, kind) of open reading frames, longest first; coordinates on the forward strand.

    In each frame the stretches between stops are taken in order; an ORF starts at its first methionine, or where the
    sequence starts if partial ones count. kind: complete, 5prime, 3prime or internal.
    """
    table = S.genetic_code(code)
    out, n = [], len(sequence)
    for strand in "+-" if both_strands else "+":
        s = (sequence if strand == "+" else sequence.translate(_FROM)[::-1]).upper().replace("U", "T")
        for frame in range(3):
            protein = "".join(table.get(s[i : i + 3], "X") for i in range(frame, n - 2, 3))
            at = 0
            for k, part in enumerate(parts := protein.split("*")):
                ended = k < len(parts) - 1
                first = part.find("M")
                whole = k > 0 or first >= 0 and (first == 0 or not partial)
                skip = 0 if k == 0 and partial and first != 0 else first
                if (partial or (ended and first >= 0)) and skip >= 0 and len(part) - skip >= shortest:
                    kind = ("complete" if ended else "3prime") if whole else ("5prime" if ended else "internal")
                    lo, hi = frame + 3 * (at + skip) + 1, frame + 3 * (at + len(part) + ended)
                    out.append((lo, hi, strand, frame + 1, part[skip:] + "*" * ended, kind) if strand == "+" else (n - hi + 1, n - lo + 1, strand, frame + 4, part[skip:] + "*" * ended, kind))
                at += len(part) + 1
    return sorted(out, key=lambda x: (-len(x[4]), x[2], x[0]))


ORF = "start int, end int, strand string, frame int, protein string, kind string"


def open_reading_frames(seqs: DataFrame, shortest: int = 30, longest_only: bool = False, **options) -> DataFrame:
    """(accession, start, end, strand, frame, protein, kind)."""
    importable(seqs.sparkSession)
    kind = seqs.schema["accession"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for acc, s in zip(b["accession"], b["sequence"], strict=True):
                found = orfs_of(s or "", shortest, **options)
                rows += [(acc, *o) for o in (found[:1] if longest_only else found)]
            yield pd.DataFrame(rows, columns=["accession", "start", "end", "strand", "frame", "protein", "kind"])

    return seqs.select("accession", "sequence").mapInPandas(run, f"accession {kind}, {ORF}")


# Splice models ---------------------------------------------------------------------------------------------------
def path_nodes(paths: DataFrame) -> DataFrame:
    """(gene, transcript, ord, node, lend, rend) from path strings like [0:0-100 1:101-200]."""
    part = lambda i: F.regexp_extract_all(F.col("path"), F.lit(r"(\d+):(\d+)-(\d+)"), i)
    x = paths.select("gene", "transcript", F.posexplode(F.arrays_zip(part(1).alias("node"), part(2).alias("lend"), part(3).alias("rend"))).alias("ord", "p"))
    return x.select("gene", "transcript", "ord", F.col("p.node").cast("int").alias("node"), F.col("p.lend").cast("int").alias("lend"), F.col("p.rend").cast("int").alias("rend"))


def topological(edges: list[tuple], nodes: list) -> list:
    """Nodes in an order that follows the edges, smallest first where free; a cycle raises ValueError."""
    import heapq

    into, outs = dict.fromkeys(nodes, 0), defaultdict(set)
    for a, b in edges:
        if b not in outs[a]:
            outs[a].add(b)
            into[b] += 1
    ready = [n for n in nodes if not into[n]]
    heapq.heapify(ready)
    order = []
    while ready:
        n = heapq.heappop(ready)
        order.append(n)
        for m in outs[n]:
            into[m] -= 1
            if not into[m]:
                heapq.heappush(ready, m)
    if len(order) < len(nodes):
        raise ValueError("the graph has a cycle")
    return order


def align_paths(paths: dict[str, list]) -> list[dict]:
    """Columns {transcript: node} of transcripts' node paths laid over each other so that equal nodes share a column.

    Paths that agree on an order of nodes are laid along it. Otherwise they are merged one by one, most similar first, each
    by dynamic programming that matches as many equal nodes as it can and never unequal ones.
    """
    nodes = sorted({n for p in paths.values() for n in p})
    edges = [e for p in paths.values() for e in zip(p, p[1:], strict=False)]
    if all(len(set(p)) == len(p) for p in paths.values()):
        try:
            at = {n: i for i, n in enumerate(topological(edges, nodes))}
            columns: list[dict] = [{} for _ in nodes]
            for t, p in paths.items():
                for n in p:
                    columns[at[n]][t] = n
            return columns
        except ValueError:
            pass
    left = sorted(paths, key=lambda t: (-len(paths[t]), t))
    first = left.pop(0)
    columns = [{first: n} for n in paths[first]]
    while left:
        have = {n for c in columns for n in c.values()}
        t = max(left, key=lambda x: (len(have & set(paths[x])), -left.index(x)))
        left.remove(t)
        columns = _merge(columns, t, paths[t])
    return columns


def _merge(columns: list[dict], name: str, path: list) -> list[dict]:
    a, b = [next(iter(c.values())) for c in columns], path
    score = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            score[i][j] = max(score[i - 1][j], score[i][j - 1], score[i - 1][j - 1] + 1 if x == y else 0)
    out, i, j = [], len(a), len(b)
    while i or j:
        if i and j and a[i - 1] == b[j - 1] and score[i][j] == score[i - 1][j - 1] + 1:
            out.append(columns[i - 1] | {name: b[j - 1]})
            i, j = i - 1, j - 1
        elif j and (not i or score[i][j] == score[i][j - 1]):
            out.append({name: b[j - 1]})
            j -= 1
        else:
            out.append(columns[i - 1])
            i -= 1
    return out[::-1]


def squeezed(columns: list[dict]) -> list[list[dict]]:
    """Neighbouring columns with the same transcripts as one block."""
    out: list[list[dict]] = []
    for c in columns:
        if out and set(out[-1][-1]) == set(c):
            out[-1].append(c)
        else:
            out.append([c])
    return out


def supertranscripts(nodes: DataFrame, refine: bool = True, burr: int = 25) -> DataFrame:
    """(gene, sequence, blocks): each gene's transcripts as one sequence and the blocks of it that each has.

    nodes: (gene, transcript, ord, node, sequence). Blocks name transcripts, lend and rend, in order. With refine, ends of up
    to ``burr`` bases that only one transcript has are left out. A gene is the unit of work.
    """
    importable(nodes.sparkSession)

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["transcript", "ord"])
        text = dict(zip(group["node"], group["sequence"], strict=True))
        paths = {t: g["node"].tolist() for t, g in group.groupby("transcript")}
        unique, seen = {}, set()
        for t, p in paths.items():
            if (key := tuple(p)) not in seen:
                seen.add(key)
                unique[t] = p
        blocks = squeezed(align_paths(unique))
        if refine and len(unique) > 1:
            size = lambda b: sum(len(text[next(iter(c.values()))]) for c in b)
            while len(blocks) > 1 and len(blocks[0][0]) == 1 and size(blocks[0]) <= burr:
                blocks.pop(0)
            while len(blocks) > 1 and len(blocks[-1][0]) == 1 and size(blocks[-1]) <= burr:
                blocks.pop()
        sequence, out = "", []
        for b in blocks:
            part = "".join(text[next(iter(c.values()))] for c in b)
            out.append({"transcripts": sorted(b[0]), "lend": len(sequence) + 1, "rend": len(sequence) + len(part)})
            sequence += part
        return pd.DataFrame([(group["gene"].iloc[0], sequence, out)], columns=["gene", "sequence", "blocks"])

    kind = nodes.schema["gene"].dataType.simpleString()
    return nodes.groupBy("gene").applyInPandas(run, f"gene {kind}, sequence string, blocks array<struct<transcripts:array<string>,lend:int,rend:int>>")


def assembled_alignments(alignments: DataFrame) -> DataFrame:
    """(locus, assembly, members, blocks): spliced alignments merged while their introns agree where they overlap.

    alignments: (locus, name, blocks array<struct<lend,rend>>). Alignments of a locus are taken by start; each joins the
    assembly, of those it is compatible with, that has most members, or starts its own.
    """
    importable(alignments.sparkSession)

    def introns(b: list) -> list:
        return [(x[1] + 1, y[0] - 1) for x, y in zip(b, b[1:], strict=False)]

    def fits(a: list, b: list) -> bool:
        lo, hi = max(a[0][0], b[0][0]), min(a[-1][1], b[-1][1])
        inside = lambda g: [i for i in introns(g) if i[1] >= lo and i[0] <= hi]
        return lo <= hi and inside(a) == inside(b)

    def union(a: list, b: list) -> list:
        out: list[list] = []
        for lo, hi in sorted(a + b):
            if out and lo <= out[-1][1] + 1:
                out[-1][1] = max(out[-1][1], hi)
            else:
                out.append([lo, hi])
        return [tuple(x) for x in out]

    def run(group: pd.DataFrame) -> pd.DataFrame:
        rows = sorted(([(int(b["lend"]), int(b["rend"])) for b in bs], n) for n, bs in zip(group["name"], group["blocks"], strict=True))
        made: list[tuple[list, list]] = []
        for blocks, name in rows:
            ok = [i for i, (_, have) in enumerate(made) if fits(have, blocks)]
            if ok:
                i = max(ok, key=lambda i: (len(made[i][0]), -i))
                made[i] = (made[i][0] + [name], union(made[i][1], blocks))
            else:
                made.append(([name], blocks))
        locus = group["locus"].iloc[0]
        return pd.DataFrame([(locus, i, m, [{"lend": a, "rend": b} for a, b in bl]) for i, (m, bl) in enumerate(made, 1)], columns=["locus", "assembly", "members", "blocks"])

    return alignments.groupBy("locus").applyInPandas(run, f"locus {alignments.schema['locus'].dataType.simpleString()}, assembly int, members array<{alignments.schema['name'].dataType.simpleString()}>, blocks array<struct<lend:int,rend:int>>")


# Abundance -------------------------------------------------------------------------------------------------------
def abundance(hits: DataFrame, lengths: DataFrame, fragment: float = 200.0, rounds: int = 1000, tolerance: float = 0.01) -> DataFrame:
    """(transcript, count, tpm) by expectation maximisation over reads that hit several transcripts.

    hits: (read, transcript); lengths: (transcript, length). Reads with the same set of transcripts become one row of a
    class table; rounds work on that table only. Effective length is length - fragment + 1, 10 at least. It ends when the
    log likelihood rises by less than tolerance; a run that the round limit ends before that warns.
    """
    classes = hits.distinct().groupBy("read").agg(F.array_sort(F.collect_set("transcript")).alias("ts")).groupBy("ts").agg(F.count(F.lit(1)).alias("n"))
    classes = classes.withColumn("c", F.xxhash64("ts")).select("c", "n", F.size("ts").alias("k"), F.explode("ts").alias("transcript"))
    eff = lengths.select("transcript", F.greatest(F.col("length") - fragment + 1, F.lit(10.0)).alias("eff"))
    table = graphs.cut_lineage(classes.join(eff, "transcript"))
    total = table.select("c", "n").distinct().agg(F.sum("n")).first()[0]
    schema_kind = hits.schema["transcript"].dataType.simpleString()
    if not total:
        return hits.sparkSession.createDataFrame([], f"transcript {schema_kind}, count double, tpm double")
    theta = graphs.cut_lineage(table.groupBy("transcript").agg((F.sum(F.col("n") / F.col("k")) / total).alias("theta")))
    last = None
    for _ in range(rounds):
        w = table.join(theta, "transcript").withColumn("w", F.col("theta") / F.col("eff"))
        z = w.groupBy("c").agg(F.sum("w").alias("z"), F.first("n").alias("_n"))
        likelihood = z.agg(F.sum(F.col("_n") * F.ln("z"))).first()[0]
        if last is not None and abs(likelihood - last) < tolerance:
            break
        last = likelihood
        theta = graphs.cut_lineage(w.join(z.select("c", "z"), "c").groupBy("transcript").agg((F.sum(F.col("n") * F.col("w") / F.col("z")) / total).alias("theta")))
    else:
        warnings.warn(f"abundance did not settle in {rounds} rounds", RuntimeWarning, stacklevel=2)
    x = theta.join(eff, "transcript").withColumn("count", F.col("theta") * total).withColumn("rate", F.col("count") / F.col("eff"))
    return x.crossJoin(F.broadcast(x.agg(F.sum("rate").alias("_t")))).select("transcript", "count", (F.col("rate") / F.col("_t") * 1e6).alias("tpm"))


# Reads -----------------------------------------------------------------------------------------------------------
def trimmed(reads: DataFrame, window: int = 4, quality: int = 5, leading: int = 5, trailing: int = 5, shortest: int = 25, offset: int = 33) -> DataFrame:
    """Reads (read_name, sequence, quals) without bad ends: cut where a window's mean quality falls under quality, then bases under leading and trailing at either end."""
    importable(reads.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for name, s, q in zip(b["read_name"], b["sequence"], b["quals"], strict=True):
                v = [ord(c) - offset for c in q or ""]
                end = len(v)
                for i in range(max(0, len(v) - window + 1)):
                    if sum(v[i : i + window]) < quality * window:
                        end = i
                        break
                start = 0
                while start < end and v[start] < leading:
                    start += 1
                while end > start and v[end - 1] < trailing:
                    end -= 1
                if end - start >= shortest:
                    rows.append((name, s[start:end], q[start:end]))
            yield pd.DataFrame(rows, columns=["read_name", "sequence", "quals"])

    return reads.select("read_name", "sequence", "quals").mapInPandas(run, "read_name string, sequence string, quals string")
