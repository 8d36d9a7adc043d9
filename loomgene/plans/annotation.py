"""Queries on models, features, evidence and submission blocks."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomgene.functions import names as N
from loomgene.operators import evidence, models, organelles, render, review, stages
from loomgene.plans import adapters as T
from loomgene.plans.registry import query
from loomgene.plans.sequences import _codons

# Two-part models on the documents as contigs: parts 1 + d % 5 .. 20 + d % 7 and 31 .. 50 + d % 9, strand by d % 2, phase of the first part read d % 3.
_FIRST = ("(1 + doc_id % 5)", "(20 + doc_id % 7)")
_SECOND = ("CAST(31 AS BIGINT)", "(50 + doc_id % 9)")


def _contigs(spark, sf_dir):
    return T.seqs(spark, sf_dir).where(F.length("seq") >= 60).select(F.col("doc_id").cast("string").alias("id"), F.col("seq").alias("sequence"), "doc_id")


def _models(spark, sf_dir):
    d = F.col("doc_id")
    minus = d % 2 == 1
    phase = lambda first_read: F.when(first_read, (d % 3).cast("string")).otherwise("0")
    part = lambda a, z, p, n: F.struct(a.cast("bigint").alias("start"), z.cast("bigint").alias("end"), p.alias("phase"), (2 * d + n).cast("bigint").alias("row_no"))
    cds = F.array(part(1 + d % 5, 20 + d % 7, phase(~minus), 0), part(F.lit(31), 50 + d % 9, phase(minus), 1))
    return _contigs(spark, sf_dir).select(F.concat(F.lit("t"), d).alias("transcript_id"), F.col("id").alias("seqid"), F.when(minus, "-").otherwise("+").alias("strand"), cds.alias("cds"))


_CONTIGS = f"""WITH {T.SEQS},
m AS (SELECT doc_id, seq, doc_id % 2 = 1 AS minus, doc_id % 3 AS phase, {_FIRST[0]} AS a1, {_FIRST[1]} AS z1, {_SECOND[0]} AS a2, {_SECOND[1]} AS z2 FROM seqs WHERE length(seq) >= 60),
j AS (SELECT *, substr(seq, a1, z1 - a1 + 1) || substr(seq, a2, z2 - a2 + 1) AS joined, substr(seq, z1 + 1, a2 - z1 - 1) AS intron FROM m),
s AS (SELECT *, substr(CASE WHEN minus THEN reverse(translate(joined, 'ACGT', 'TGCA')) ELSE joined END, phase + 1) AS cds, CASE WHEN minus THEN reverse(translate(intron, 'ACGT', 'TGCA')) ELSE intron END AS intron_read FROM j)"""


@query(_CONTIGS + " SELECT 't' || doc_id AS transcript_id, cds AS cds_seq, left(intron_read, 2) || '-' || right(intron_read, 2) AS motif FROM s")
def q_splice(spark, sf_dir):
    found = models.spliced(_models(spark, sf_dir), _contigs(spark, sf_dir))
    return found.select("transcript_id", "cds_seq", F.col("motifs")[0].alias("motif"))


@query(_CONTIGS + f""", c AS (SELECT {_codons()} AS code),
p AS (SELECT doc_id, coalesce(list_aggregate(list_transform(regexp_extract_all(cds, '.{{3}}'), lambda k: code[k]), 'string_agg', ''), '') AS protein FROM s, c)
SELECT 't' || doc_id AS transcript_id, replace(rtrim(protein, '*'), '*', 'X') AS protein FROM p""")
def q_proteins(spark, sf_dir):
    return models.proteins(models.spliced(_models(spark, sf_dir), _contigs(spark, sf_dir)))


@query(_CONTIGS + """,
f AS (SELECT doc_id, minus, CASE WHEN minus THEN a1 ELSE a1 + phase END AS a1, z1, a2, CASE WHEN minus THEN z2 - phase ELSE z2 END AS z2 FROM m),
g AS (SELECT *, (z1 - a1 + 1 + z2 - a2 + 1) % 3 AS over FROM f)
SELECT 't' || doc_id AS transcript_id, CASE WHEN minus THEN a1 + over ELSE a1 END AS start_1, z1 AS end_1, a2 AS start_2, CASE WHEN minus THEN z2 ELSE z2 - over END AS end_2 FROM g""")
def q_frame_fix(spark, sf_dir):
    c = models.in_frame(_models(spark, sf_dir)).select("transcript_id", F.col("cds")[0].alias("x"), F.col("cds")[1].alias("y"))
    return c.select("transcript_id", F.col("x.start").alias("start_1"), F.col("x.end").alias("end_1"), F.col("y.start").alias("start_2"), F.col("y.end").alias("end_2"))


@query(_CONTIGS + """,
d AS (SELECT doc_id, minus, a1, z1, a2, z2, doc_id % 3 AS head, (doc_id // 3) % 3 AS tail FROM m WHERE doc_id % 4 <> 0),
o AS (SELECT *, CASE WHEN minus THEN (3 - tail) % 3 ELSE (3 - head) % 3 END AS off_left, CASE WHEN minus THEN (3 - head) % 3 ELSE (3 - tail) % 3 END AS off_right FROM d)
SELECT 't' || doc_id AS transcript_id, a1 + CASE WHEN doc_id % 5 = 0 THEN 0 ELSE off_left END AS start_1, z1 AS end_1, a2 AS start_2, z2 - CASE WHEN doc_id % 5 = 0 THEN 0 ELSE off_right END AS end_2, CASE WHEN doc_id % 5 = 0 THEN 'stops' ELSE 'padded' END AS status FROM o
UNION ALL SELECT 't' || doc_id, a1, z1, a2, z2, 'unchanged' FROM m WHERE doc_id % 4 = 0""")
def q_padding_apply(spark, sf_dir):
    m = _models(spark, sf_dir)
    d = _contigs(spark, sf_dir).where("doc_id % 4 <> 0").select(F.concat(F.lit("t"), "doc_id").alias("transcript_id"), F.expr("doc_id % 3 as head"), F.expr("doc_id div 3 % 3 as tail"), F.expr("if(doc_id % 5 = 0, 1, 0) as stops_after"))
    c = models.apply_padding(m, d).select("transcript_id", "status", F.col("cds")[0].alias("x"), F.col("cds")[1].alias("y"))
    return c.select("transcript_id", F.col("x.start").alias("start_1"), F.col("x.end").alias("end_1"), F.col("y.start").alias("start_2"), F.col("y.end").alias("end_2"), "status")


@query(f"""WITH {T.HITS},
p AS (SELECT *, max(bitscore) OVER (PARTITION BY qseqid) AS best FROM hits WHERE description <> '' AND bitscore >= 50 AND pident >= 35 AND qcov >= 70 AND scov >= 70)
SELECT qseqid, hit_no, description, bitscore, best AS best_bitscore FROM p WHERE bitscore >= 0.9 * best AND description <> 'hypothetical protein'""")
def q_accepted_hits(spark, sf_dir):
    return evidence.accepted_hits(T.hits(spark, sf_dir)).select("qseqid", "hit_no", "description", "bitscore", "best_bitscore")


@query("""
SELECT p_partkey, CASE p_size % 6 WHEN 0 THEN p_name WHEN 1 THEN p_name || ' protein' WHEN 2 THEN p_name WHEN 3 THEN NULL WHEN 4 THEN NULL ELSE p_name || ' (x)' END AS description FROM part""")
def q_descriptions(spark, sf_dir):
    n, name = F.col("p_size") % 6, F.col("p_name")
    text = F.when(n == 0, F.concat(F.lit("Cluster: "), name, F.lit("."))).when(n == 1, F.concat(F.lit("RecName: Full="), name, F.lit("  protein {ECO:0000305}"))).when(n == 2, F.concat(F.lit("LOW QUALITY PROTEIN: "), name, F.lit(" (Fragment)")))
    text = text.when(n == 3, F.concat(F.lit("Uncharacterised protein "), name)).when(n == 4, F.concat(F.lit("putative "), name)).otherwise(F.concat(name, F.lit(" (x);")))
    return T.table(spark, sf_dir, "part").select("p_partkey", N.clean_description(text).alias("description"))


@query("""
WITH d AS (
  SELECT l_orderkey AS qseqid, l_linenumber * 1000000 + l_partkey AS hit_no, p_name, p_size, l_extendedprice AS bitscore, l_tax / 1000 AS evalue, (l_quantity + 49) / 100 AS share, CASE p_size % 5 WHEN 0 THEN p_name || ' domain-containing protein' WHEN 1 THEN p_name || ' repeat-containing protein'
      WHEN 2 THEN p_name || ' family protein' WHEN 3 THEN 'DUF' || p_size || ' domain-containing protein' END AS product
  FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT qseqid, product, round(share, 6) AS score, bitscore FROM d WHERE product IS NOT NULL AND share >= 0.6 AND evalue <= 0.00004
QUALIFY row_number() OVER (PARTITION BY qseqid ORDER BY bitscore DESC, evalue, share DESC, hit_no) = 1""")
def q_domain_products(spark, sf_dir):
    n = F.col("p_size") % 5
    label = F.when(n == 0, F.col("p_name")).when(n == 1, F.concat("p_name", F.lit(" repeat"))).when(n == 2, F.concat(F.lit("The "), "p_name", F.lit(" family."))).when(n == 3, "Domain of unknown function").otherwise(F.concat(F.lit("coiled coil "), "p_name"))
    name = F.when(n == 3, F.concat(F.lit("DUF"), "p_size")).otherwise("X")
    rows = T.table(spark, sf_dir, "lineitem").join(T.table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    d = rows.select(F.col("l_orderkey").alias("query_id"), name.alias("name"), label.alias("description"), F.lit(100).alias("hmm_length"), (F.col("l_tax") / 1000).alias("i_evalue"), F.col("l_extendedprice").alias("bitscore"), F.lit(1).alias("hmm_from"), (F.col("l_quantity") + 49).alias("hmm_to"), (F.col("l_linenumber") * 1000000 + F.col("l_partkey")).alias("hit_no"))
    return evidence.domain_assignments(d, 0.00004, 0.6).select("qseqid", "product", F.round("score", 6).alias("score"), "bitscore")


_KINDS = (("siRNA", "ncRNA", "siRNA", None), ("microRNA", "ncRNA", "miRNA", None), ("attenuator", "regulatory", None, "attenuator"), ("silencer", "regulatory", None, "other"), ("minisatellite", "repeat_region", None, None), ("SINE", "mobile_element", None, None), ("5_prime_UTR", "5'UTR", None, None), ("gene", None, None, None), ("primary_transcript", "prim_transcript", None, None), ("tRNA", "tRNA", None, None), ("novelty", "misc_feature", None, None), ("polyA_signal", "regulatory", None, "polyA_signal_sequence"))


def _kinds_sql() -> str:
    quoted = lambda t: "NULL" if t is None else "'" + t.replace("'", "''") + "'"
    case = lambda k: f"CASE event_id % {len(_KINDS)} " + " ".join(f"WHEN {i} THEN {quoted(x[k])}" for i, x in enumerate(_KINDS)) + " END"
    return f"SELECT event_id, {case(1)} AS key, {case(2)} AS ncrna_class, {case(3)} AS regulatory_class FROM events"


@query(_kinds_sql())
def q_feature_keys(spark, sf_dir):
    kind = F.get(F.array(*(F.lit(k[0]) for k in _KINDS)), (F.col("event_id") % len(_KINDS)).cast("int"))
    rows = T.table(spark, sf_dir, "events").select("event_id", kind.alias("kind"))
    c = render.feature_class(F.col("kind"), F.create_map().cast("map<string,string>"))
    return rows.select("event_id", render.feature_key(F.col("kind")).alias("key"), c.alias("c")).select("event_id", "key", F.col("c.ncRNA_class").alias("ncrna_class"), "c.regulatory_class")


def _blocks(spark, sf_dir):
    """Orders as loci: an mRNA of all its distinct places and a CDS of those of kind CDS."""
    p = T.parts(spark, sf_dir).where("gene % 3 > 0").withColumn("end", F.when(F.col("gene") % 7 == 0, F.col("start")).otherwise(F.col("end")))
    place = lambda rows, feature: rows.groupBy("gene").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("parts")).select("gene", "parts", F.lit(feature).alias("feature"))
    rows = place(p, "mRNA").unionByName(place(p.where("kind = 'CDS'"), "CDS"))
    q = F.array(F.struct(F.lit(0).alias("line_no"), F.lit("locus_tag").alias("key"), F.col("gene").cast("string").alias("value")))
    return rows.select(F.lit("e").alias("entry"), F.concat_ws(".", "gene", "feature").alias("block_no"), "feature", render.location(F.col("parts"), F.lit("+")).alias("location"), q.alias("qualifiers"), F.col("gene").cast("string").alias("locus"))


_BLOCKS = f"""WITH {T.PARTS},
q AS (SELECT gene, kind, s, CASE WHEN gene % 7 = 0 THEN s ELSE e END AS e FROM parts WHERE gene % 3 > 0),
u AS (SELECT DISTINCT gene, 'mRNA' AS feature, s, e FROM q UNION SELECT DISTINCT gene, 'CDS', s, e FROM q WHERE kind = 'CDS'),
b AS (SELECT gene, feature, CASE WHEN count(*) > 1 THEN 'join(' ELSE '' END || string_agg(CASE WHEN s = e THEN CAST(s AS VARCHAR) ELSE s || '..' || e END, ',' ORDER BY s, e) || CASE WHEN count(*) > 1 THEN ')' ELSE '' END AS location,
  sum(e - s + 1) AS bases FROM u GROUP BY gene, feature)"""


@query(_BLOCKS + """
SELECT 'short_cds' AS warning, CAST(gene AS VARCHAR) AS locus_tag, location, CAST(bases AS BIGINT) || ' coding bp; review against the 93 bp threshold' AS detail FROM b WHERE feature = 'CDS' AND bases < 93
UNION ALL SELECT 'single_base_cds_segment', CAST(gene AS VARCHAR), CAST(s AS VARCHAR), 'CDS ' || location FROM u JOIN b USING (gene, feature) WHERE feature = 'CDS' AND s = e
UNION ALL SELECT 'shared_cds_segment', string_agg(DISTINCT CAST(gene AS VARCHAR), ',' ORDER BY CAST(gene AS VARCHAR)), CASE WHEN s = e THEN CAST(s AS VARCHAR) ELSE s || '..' || e END, 'Exact same-strand segment at distinct loci' FROM u WHERE feature = 'CDS' GROUP BY s, e HAVING count(DISTINCT gene) > 1""")
def q_review(spark, sf_dir):
    return review.block_warnings(_blocks(spark, sf_dir)).select("warning", "locus_tag", "location", "detail")


@query(_BLOCKS + " SELECT x.gene || '.mRNA' AS block_no FROM b x JOIN b y ON x.gene = y.gene AND x.feature = 'mRNA' AND y.feature = 'CDS' AND x.location = y.location")
def q_redundant_mrna(spark, sf_dir):
    return review.redundant_mrna(_blocks(spark, sf_dir)).select("block_no")


@query(_BLOCKS + " SELECT gene || '.' || feature AS block_no, CASE WHEN feature = 'CDS' AND gene % 4 = 0 THEN 'misc_feature' ELSE feature END AS feature, feature = 'CDS' AND gene % 4 = 0 AS changed FROM b")
def q_stops_to_misc(spark, sf_dir):
    loci = T.table(spark, sf_dir, "orders").where("o_orderkey % 4 = 0").select(F.col("o_orderkey").cast("string").alias("locus"))
    return review.stops_to_misc(_blocks(spark, sf_dir), loci).select("block_no", "feature", "changed")


@query("""
WITH x AS (SELECT l_orderkey, ((CAST(l_linenumber AS BIGINT) * 1000000 + l_partkey) * 100000 + l_suppkey) * 100 + CAST(l_quantity AS BIGINT) AS order_no, CAST(l_quantity AS BIGINT) AS n, CASE WHEN l_linenumber = 1 THEN 0 ELSE l_suppkey % 3 END AS phase FROM lineitem),
y AS (SELECT *, coalesce(sum(n) OVER w, 0) AS before, first(phase) OVER (PARTITION BY l_orderkey ORDER BY order_no) AS f FROM x WINDOW w AS (PARTITION BY l_orderkey ORDER BY order_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT l_orderkey AS id, order_no, phase, CAST((((f - before) % 3) + 3) % 3 AS BIGINT) AS expected FROM y WHERE phase <> (((f - before) % 3) + 3) % 3""")
def q_phase_breaks(spark, sf_dir):
    order = ((F.col("l_linenumber").cast("bigint") * 1_000_000 + F.col("l_partkey")) * 100_000 + F.col("l_suppkey")) * 100 + F.col("l_quantity").cast("bigint")
    c = T.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"), order.alias("order_no"), F.col("l_quantity").cast("bigint").alias("length"), F.when(F.col("l_linenumber") == 1, F.lit(0)).otherwise(F.col("l_suppkey") % 3).cast("bigint").alias("phase"))
    return organelles.phase_breaks(c).select("id", "order_no", "phase", F.col("expected").cast("bigint").alias("expected"))


@query("""
SELECT p_partkey, CASE WHEN p_size % 5 = 4 THEN '' WHEN p_size % 3 = 0 THEN p_size || 'x' WHEN p_size % 3 = 1 THEN p_size || '.5x' ELSE 'Unknown' END AS coverage, CASE WHEN p_size % 2 = 0 THEN 'Met' END AS gene, CASE WHEN p_size % 5 < 4 THEN 'Leu' END AS product FROM part""")
def q_rna_and_coverage(spark, sf_dir):
    n = F.col("p_size")
    text = F.when(n % 5 == 4, "").when(n % 3 == 0, F.concat(n, F.lit("x"))).when(n % 3 == 1, F.concat(F.lit(" "), n, F.lit(".5X"))).otherwise(" unknown")
    aa = organelles.trna_amino_acids(F.when(n % 2 == 0, "trnM-CAU").otherwise("rrn16"), F.when(n % 5 < 4, "tRNA-Leu").otherwise("16S"))
    return T.table(spark, sf_dir, "part").select("p_partkey", organelles.genome_coverage(text).alias("coverage"), aa.alias("aa")).select("p_partkey", "coverage", "aa.gene", "aa.product")


def _features(spark, sf_dir):
    """Orders as genes with one transcript, whose CDS are lines; products on every second transcript and on lines of the flag A."""
    o, l = T.table(spark, sf_dir, "orders"), T.table(spark, sf_dir, "lineitem")
    key = F.col("o_orderkey")
    row = lambda df, no, kind, a, z, id_, parents, attributes: df.select(no.cast("bigint").alias("row_no"), F.lit("c").alias("seqid"), F.lit(kind).alias("type"), a.cast("bigint").alias("start"), z.cast("bigint").alias("end"), id_.alias("id"), parents.alias("parents"), attributes.alias("attributes"))
    none = F.create_map().cast("map<string,string>")
    named = F.when(key % 2 == 0, F.create_map(F.lit("product"), F.concat(F.lit("kinase "), key))).otherwise(none)
    gene = row(o, key * 1_000_000, "gene", F.lit(1), F.lit(3000), F.concat(F.lit("g"), key), F.array().cast("array<string>"), none)
    rna = row(o, key * 1_000_000 + 10_000, "mRNA", F.lit(1), F.lit(1800), F.concat(F.lit("t"), key), F.array(F.concat(F.lit("g"), key)), named)
    part = F.when(F.col("l_returnflag") == "A", F.create_map(F.lit("product"), F.concat(F.lit("part "), F.col("l_partkey")))).otherwise(none)
    cds = row(l, F.col("l_orderkey") * 1_000_000 + (1 + F.col("l_linenumber")) * 10_000 + F.col("l_partkey"), "CDS", F.col("l_partkey"), F.col("l_partkey") + F.col("l_quantity").cast("bigint"), F.lit(None).cast("string"), F.array(F.concat(F.lit("t"), F.col("l_orderkey"))), part)
    return gene.unionByName(rna).unionByName(cds)


@query("""
WITH c AS (SELECT l_orderkey, min_by('part ' || l_partkey, l_linenumber * 10000 + l_partkey) AS p FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1)
SELECT 't' || o_orderkey AS "ID", CASE WHEN o_orderkey % 2 = 0 THEN 'kinase ' || o_orderkey ELSE coalesce(p, 'hypothetical protein') END AS "Description", 'AB_g' || o_orderkey AS "Locus_tag" FROM orders LEFT JOIN c ON l_orderkey = o_orderkey""")
def q_annotation_table(spark, sf_dir):
    return stages.annotation_table(_features(spark, sf_dir), "AB").drop("row_no")


@query("""
SELECT DISTINCT l_orderkey * 1000000 + (1 + l_linenumber) * 10000 + l_partkey AS row_no, 'outside_parent' AS issue FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders) AND (l_partkey + CAST(l_quantity AS BIGINT) > 1800 OR l_partkey < 1)""")
def q_containment_issues(spark, sf_dir):
    return stages.containment_issues(_features(spark, sf_dir))


@query("""
SELECT 'unknown_parent' AS "check", count(*) AS failures FROM lineitem WHERE l_orderkey % 10 = 3
UNION ALL SELECT 'inverted_coordinates', count(*) FROM lineitem WHERE l_partkey < 1 UNION ALL SELECT 'repeated_sequence_id', 0 UNION ALL SELECT 'empty_sequence', count(*) FROM documents WHERE coalesce(text, '') = ''
UNION ALL SELECT 'letters_outside_dna', 0 UNION ALL SELECT 'unknown_sequence', (SELECT count(*) FROM orders) + (SELECT count(*) FROM orders WHERE o_orderkey % 10 <> 3) + (SELECT count(*) FROM lineitem)""")
def q_input_checks(spark, sf_dir):
    f = _features(spark, sf_dir).where("not (type = 'mRNA' and row_no div 1000000 % 10 = 3)")
    return review.input_checks(T.seqs(spark, sf_dir).select(F.concat(F.lit("d"), "doc_id").alias("id"), F.coalesce("seq", F.lit("")).alias("sequence")), f)
