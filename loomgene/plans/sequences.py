"""Queries on sequences."""

from __future__ import annotations

from itertools import product

from pyspark.sql import functions as F

from loomgene.functions import sequence as S
from loomgene.operators import intervals
from loomgene.plans import adapters as T
from loomgene.plans.registry import query

_PIECES = f"""WITH {T.SEQS},
p AS (SELECT doc_id, list_filter(string_split(regexp_replace(seq, '(N+)', '|\\1|', 'g'), '|'), lambda x: x <> '') AS pieces FROM seqs),
x AS (SELECT doc_id, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS i FROM p),
y AS (SELECT *, CAST(sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS BIGINT) AS e FROM x),
runs AS (SELECT doc_id, e - length(piece) + 1 AS s, e, length(piece) AS n FROM y WHERE piece LIKE 'N%')"""
_TARGET = "CASE WHEN length(piece) < 4 AND length(piece) < 2 THEN length(piece) WHEN length(piece) > 4 AND length(piece) > 6 THEN length(piece) ELSE 4 END"
_LIMITS = (4, 2, 6)


@query(_PIECES + " SELECT doc_id, count(*) AS runs, CAST(min(n) AS BIGINT) AS shortest, CAST(max(n) AS BIGINT) AS longest, CAST(sum(n) AS BIGINT) AS bases FROM runs GROUP BY 1")
def q_gap_runs(spark, sf_dir):
    r = T.seqs(spark, sf_dir).select("doc_id", F.explode(S.n_runs(F.col("seq"))).alias("r")).withColumn("n", F.col("r.end") - F.col("r.start") + 1)
    return r.groupBy("doc_id").agg(F.count("*").alias("runs"), F.min("n").alias("shortest"), F.max("n").alias("longest"), F.sum("n").alias("bases"))


@query(_PIECES + " SELECT doc_id, s AS start, e AS \"end\" FROM runs WHERE n >= 3")
def q_assembly_gaps(spark, sf_dir):
    return T.seqs(spark, sf_dir).select("doc_id", F.explode(S.n_runs(F.col("seq"))).alias("r")).where("r.end - r.start + 1 >= 3").select("doc_id", "r.start", "r.end")


@query(_PIECES + f""", z AS (SELECT doc_id, i, CASE WHEN piece LIKE 'N%' THEN repeat('N', {_TARGET}) ELSE piece END AS new, CASE WHEN piece LIKE 'N%' AND {_TARGET} <> length(piece) THEN 1 ELSE 0 END AS edit FROM y)
SELECT doc_id, CAST(sum(edit) AS BIGINT) AS edits, md5(string_agg(new, '' ORDER BY i)) AS digest FROM z GROUP BY 1""")
def q_gap_normalise(spark, sf_dir):
    seq = F.col("seq")
    return T.seqs(spark, sf_dir).where(F.length("seq") > 0).select("doc_id", F.size(S.gap_edits(seq, *_LIMITS)).cast("bigint").alias("edits"), F.md5(S.normalise_gaps(seq, *_LIMITS)).alias("digest"))


@query(_PIECES + f""", ed AS (SELECT doc_id, e - length(piece) AS start0, length(piece) AS old_len, {_TARGET} AS new_len FROM y WHERE piece LIKE 'N%' AND {_TARGET} <> length(piece)),
mv AS (SELECT *, coalesce(sum(new_len - old_len) OVER (PARTITION BY doc_id ORDER BY start0 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off FROM ed),
pos AS (SELECT doc_id, CAST(unnest(range(1, CAST(length(seq) + 1 AS BIGINT), 50)) AS BIGINT) AS position FROM seqs)
SELECT pos.doc_id, position, CAST(CASE WHEN start0 IS NULL THEN position WHEN position - start0 <= old_len THEN start0 + off + least(position - start0, new_len) ELSE position + off + new_len - old_len END AS BIGINT) AS shifted
FROM pos ASOF LEFT JOIN mv ON pos.doc_id = mv.doc_id AND pos.position > mv.start0""")
def q_gap_shift(spark, sf_dir):
    s = T.seqs(spark, sf_dir).where(F.length("seq") > 0)
    edits = s.select("doc_id", F.explode(S.gap_edits(F.col("seq"), *_LIMITS)).alias("e")).select("doc_id", "e.*")
    pos = s.select("doc_id", F.explode(F.sequence(F.lit(1), F.length("seq"), F.lit(50)).cast("array<bigint>")).alias("position"), F.lit("start").alias("kind"))
    return intervals.shift(pos, edits, "doc_id").select("doc_id", "position", "shifted")


@query(f"""WITH {T.SEQS}
SELECT doc_id, md5(reverse(translate(seq, 'ACGT', 'TGCA'))) AS reversed, CAST(length(rtrim(seq, 'N')) AS BIGINT) AS trimmed,
  md5(rtrim(regexp_replace(seq, '(.{{60}})', '\\1' || chr(10), 'g'), chr(10))) AS wrapped, regexp_full_match(seq, '[ACGTN]+') AS dna FROM seqs""")
def q_sequence_basics(spark, sf_dir):
    seq = F.col("seq")
    return T.seqs(spark, sf_dir).select("doc_id", F.md5(S.reverse_complement(seq)).alias("reversed"), F.length(S.trim_terminal_n(seq)).cast("bigint").alias("trimmed"), F.md5(S.wrap(seq)).alias("wrapped"), S.is_dna(seq).alias("dna"))


def _codons(code: int = 1) -> str:
    """Codons of A, C, G, T and N as a map in SQL."""
    table, out = S.codon_residues(code), []
    for c in product("ACGTN", repeat=3):
        found = {table[a + b + d] for a in c[0].replace("N", "ACGT") for b in c[1].replace("N", "ACGT") for d in c[2].replace("N", "ACGT")}
        out.append(f"'{''.join(c)}': '{found.pop() if len(found) == 1 else 'X'}'")
    return "MAP {" + ", ".join(out) + "}"


def _stops(seq: str) -> str:
    """Stops before the last three bases: the codons of all but the last base."""
    return f"CAST(len(list_filter(regexp_extract_all(substr({seq}, 1, greatest(length({seq}) - 1, 0)), '.{{3}}'), lambda c: c IN ('TAA', 'TAG', 'TGA'))) AS BIGINT)"


@query(f"""WITH {T.SEQS}, c AS (SELECT {_codons()} AS code)
SELECT doc_id, md5(coalesce(list_aggregate(list_transform(regexp_extract_all(seq, '.{{3}}'), lambda k: code[k]), 'string_agg', ''), '')) AS protein, {_stops('seq')} AS stops FROM seqs, c""")
def q_translate(spark, sf_dir):
    return T.seqs(spark, sf_dir).select("doc_id", F.md5(S.translate(F.col("seq"))).alias("protein"), S.internal_stops(F.col("seq")).alias("stops"))


def _padding_sql() -> str:
    tries = ", ".join(_stops(f"(repeat('N', {h}) || seq || repeat('N', {t}))") + f" AS s{m}{i}" for m, o in S.PADDINGS.items() for i, (h, t) in enumerate(o))
    case = lambda j: "CASE m " + " ".join(f"WHEN {m} THEN CASE WHEN s{m}0 <= s{m}1 AND s{m}0 <= s{m}2 THEN {[*o[0], f's{m}0'][j]} WHEN s{m}1 <= s{m}2 THEN {[*o[1], f's{m}1'][j]} ELSE {[*o[2], f's{m}2'][j]} END" for m, o in S.PADDINGS.items()) + " END"
    return f"""WITH {T.SEQS}, t AS (SELECT doc_id, {_stops('seq')} AS before, (3 - length(seq) % 3) % 3 AS m, {tries} FROM seqs)
SELECT doc_id, CAST(CASE WHEN before = 0 THEN 0 ELSE {case(0)} END AS INTEGER) AS head, CAST(CASE WHEN before = 0 THEN m ELSE {case(1)} END AS INTEGER) AS tail, before AS stops_before,
  CAST(CASE WHEN before = 0 THEN 0 ELSE {case(2)} END AS BIGINT) AS stops_after FROM t WHERE before > 0 OR m > 0"""


@query(_padding_sql())
def q_padding_choice(spark, sf_dir):
    return T.seqs(spark, sf_dir).select("doc_id", S.padding(F.col("seq")).alias("p")).where("p is not null").select("doc_id", "p.head", "p.tail", "p.stops_before", "p.stops_after")
