"""Queries on the flow of genes through the stages, the target's taxonomy and organelles, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomgene.operators import flow, organelles, taxonomy
from loomgene.plans import adapters as T
from loomgene.plans.registry import query
from loomgene.shared import cut

#: Which orders, seen as genes, are in the sets of the stages: a condition on their lines each, in the order of flow.GENE_SETS.
_IN = ("removed", "NOT removed AND mrnas > 1", "NOT removed AND quantity % 3 = 1", "NOT removed AND quantity % 5 = 2", "NOT removed AND quantity % 11 = 3 AND quantity % 5 <> 2", "NOT removed AND quantity % 13 = 4")

_FLOW = f"""WITH g AS (SELECT o_orderkey AS id, count(l_orderkey) AS mrnas, CAST(coalesce(sum(l_quantity), 0) AS BIGINT) AS quantity, o_orderstatus = 'P' AS removed FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey, o_orderstatus),
m AS (SELECT id, mrnas, {', '.join(f'({c}) AS {s}' for s, c in zip(flow.GENE_SETS, _IN, strict=True))} FROM g)"""


def _flow(spark, sf_dir):
    """Orders as genes with their lines as mRNAs, and the sets that they are in."""
    lines = T.table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.count("*").alias("mrnas"), F.sum("l_quantity").cast("bigint").alias("quantity"))
    orders = T.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), (F.col("o_orderstatus") == "P").alias("removed"))
    genes = orders.join(lines, "id", "left").na.fill(0, ["mrnas", "quantity"])
    held = F.array_compact(F.array(*(F.when(F.expr(c), s) for s, c in zip(flow.GENE_SETS, _IN, strict=True))))
    genes = cut(genes.withColumn("sets", held), "genes")
    return flow.bitmaps(genes, genes.select(F.explode("sets").alias("set"), "id"))


@query(_FLOW + """,
k AS (SELECT count(*) AS initial_genes, count(*) FILTER (duplicate_removed_genes) AS dup, count(*) FILTER (transcript_changed_genes) AS chosen, coalesce(sum(mrnas - 1) FILTER (NOT duplicate_removed_genes AND mrnas > 1), 0) AS gone,
  count(*) FILTER (inframe_updated_genes) AS frame, count(*) FILTER (padding_updated_genes) AS padded, count(*) FILTER (genes_with_stops) AS stops, count(*) FILTER (converted_to_misc_genes) AS misc FROM m),
f AS (SELECT count(*) FILTER (l_returnflag <> 'R') AS a, count(*) FILTER (l_returnflag <> 'R' AND l_linestatus = 'F') AS b, count(*) FILTER (l_linestatus <> 'F') AS c FROM lineitem),
e AS (SELECT unnest([
  {'metric': 'initial_genes', 'value': initial_genes}, {'metric': 'duplicate_removed_genes', 'value': dup}, {'metric': 'genes_after_dedup', 'value': initial_genes - dup},
  {'metric': 'transcript_changed_genes', 'value': chosen}, {'metric': 'transcript_unchanged_genes', 'value': initial_genes - dup - chosen}, {'metric': 'removed_mrnas', 'value': CAST(gone AS BIGINT)},
  {'metric': 'genes_after_single_mrna', 'value': initial_genes - dup}, {'metric': 'inframe_updated_genes', 'value': frame}, {'metric': 'inframe_unchanged_genes', 'value': initial_genes - dup - frame},
  {'metric': 'genes_after_inframe', 'value': initial_genes - dup}, {'metric': 'padding_updated_genes', 'value': padded}, {'metric': 'genes_with_stops', 'value': stops},
  {'metric': 'padding_unchanged_genes', 'value': initial_genes - dup - padded - stops}, {'metric': 'genes_after_padding', 'value': initial_genes - dup}, {'metric': 'converted_to_misc_genes', 'value': misc},
  {'metric': 'final_cds_genes', 'value': initial_genes - dup - misc}, {'metric': 'total_cds_input', 'value': a}, {'metric': 'total_cds_output', 'value': b}, {'metric': 'misc_feature_output', 'value': c}]) AS e,
  unnest(range(1, 20)) AS nth FROM k, f)
SELECT CAST(nth AS INTEGER) AS nth, e.metric AS metric, CAST(e.value AS BIGINT) AS value,
  CASE WHEN nth = 6 THEN 'transcripts' WHEN nth > 16 THEN 'features' ELSE 'genes' END AS unit FROM e""")
def q_flow_metrics(spark, sf_dir):
    """The 19 counts of a run; lines that weren't returned are CDS, and those not yet final become misc_feature."""
    line = T.table(spark, sf_dir, "lineitem")
    after = F.when(F.col("l_linestatus") != "F", "misc_feature").when(F.col("l_returnflag") != "R", "CDS").otherwise("mRNA")
    blocks = line.select(F.when(F.col("l_returnflag") != "R", "CDS").otherwise("mRNA").alias("before"), after.alias("after"))
    return flow.summary(flow.metrics(_flow(spark, sf_dir), blocks))


@query(_FLOW + f"""
SELECT concat_ws(',', {', '.join(f"CASE WHEN {s} THEN '{s}' END" for s in flow.GENE_SETS)}) AS pattern, CAST({' + '.join(f'CAST({s} AS INTEGER)' for s in flow.GENE_SETS)} AS BIGINT) AS sets, count(*) AS genes FROM m GROUP BY ALL""")
def q_flow_patterns(spark, sf_dir):
    """How many genes are in just which sets of the stages."""
    return flow.patterns(_flow(spark, sf_dir))


#: Orders as samples of their customers' species: a known id, the name alone, nothing, or an id that isn't known; datasets of a nation and of the region.
_SAMPLES = """WITH s AS (
  SELECT o_orderkey AS sample, o_orderkey % 4 AS kind, o_custkey, c_name, c.c_nationkey AS nation, n.n_regionkey AS region, d.n_nationkey AS said, replace(d.n_name, '_', ' ') AS said_name, d.n_regionkey AS said_region, r_name,
    o_orderstatus <> 'P' AS has_nation, o_orderkey % 5 <> 0 AS has_region
  FROM orders JOIN customer c ON o_custkey = c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region ON n.n_regionkey = r_regionkey
    JOIN nation d ON d.n_nationkey = (c.c_nationkey + CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END) % 25),
t AS (SELECT *, CASE WHEN kind < 2 THEN 1000 + o_custkey WHEN has_nation THEN 100 + said WHEN has_region THEN 10 + region END AS tax_id,
    CASE WHEN kind = 0 THEN 'configured_taxon_id' WHEN kind = 1 THEN 'scientific_name' WHEN has_nation OR has_region THEN 'busco_lineage_fallback' WHEN kind = 3 THEN 'configured_taxon_id' ELSE 'scientific_name' END AS source FROM s)"""


def _taxonomy(spark, sf_dir):
    region, nation, customer = (T.table(spark, sf_dir, t) for t in ("region", "nation", "customer"))
    record = lambda i, parent, name, rank: (i.cast("bigint").alias("tax_id"), parent.cast("bigint").alias("parent"), name.alias("name"), F.lit(rank).alias("rank"))
    records = region.select(*record(F.col("r_regionkey") + 10, F.lit(1), F.col("r_name"), "DOMAIN"))
    records = records.unionByName(nation.select(*record(F.col("n_nationkey") + 100, F.col("n_regionkey") + 10, F.replace(F.col("n_name"), F.lit("_"), F.lit(" ")), "PHYLUM")))
    records = records.unionByName(customer.select(*record(F.col("c_custkey") + 1000, F.col("c_nationkey") + 100, F.col("c_name"), "SPECIES")))
    root = region.agg(F.lit(1).cast("bigint").alias("tax_id")).select("tax_id", F.lit(None).cast("bigint").alias("parent"), F.lit("root").alias("name"), F.lit("").alias("rank"))
    kind = F.col("o_orderkey") % 4
    orders = T.table(spark, sf_dir, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey"))
    samples = orders.select(F.col("o_orderkey").alias("sample"), F.when(kind == 0, F.col("o_custkey") + 1000).when(kind == 3, 5).cast("bigint").alias("taxon_id"), F.when(kind == 1, F.upper("c_name")).when(kind == 3, F.col("c_name")).alias("scientific_name"))
    said = nation.select(F.col("n_nationkey").alias("said"), F.col("n_name").alias("said_name"))
    own = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").alias("c_nationkey"), "r_name")
    both = orders.withColumn("said", (F.col("c_nationkey") + F.when(F.col("o_orderkey") % 3 == 0, 1).otherwise(0)) % 25).join(said, "said").join(own, "c_nationkey")
    first = F.when(F.col("o_orderstatus") != "P", F.struct(F.lit(1).alias("nth"), F.concat(F.replace(F.lower("said_name"), F.lit(" "), F.lit("_")), F.lit("_odb10")).alias("dataset"), F.lit("configured-lineage").alias("strategy")))
    second = F.when(F.col("o_orderkey") % 5 != 0, F.struct(F.lit(2).alias("nth"), F.concat(F.lit("lineages/"), F.lower("r_name"), F.lit("_ODB12.1")).alias("dataset"), F.lit("auto").alias("strategy")))
    evidence = both.select(F.col("o_orderkey").alias("sample"), F.explode(F.array_compact(F.array(first, second))).alias("e")).select("sample", "e.*")
    return taxonomy.resolve(samples, evidence, records.unionByName(root))


@query(_SAMPLES + """
SELECT sample, source, CASE WHEN tax_id IS NULL THEN 'unresolved' ELSE 'resolved' END AS status, CAST(tax_id AS BIGINT) AS tax_id,
  CASE WHEN tax_id >= 1000 THEN c_name WHEN tax_id >= 100 THEN said_name WHEN tax_id >= 10 THEN r_name END AS name, CASE WHEN tax_id >= 1000 THEN 'SPECIES' WHEN tax_id >= 100 THEN 'PHYLUM' WHEN tax_id >= 10 THEN 'DOMAIN' END AS rank,
  CAST(CASE WHEN tax_id >= 1000 THEN 10 + region WHEN tax_id >= 100 THEN 10 + said_region WHEN tax_id >= 10 THEN 10 + region END AS BIGINT) AS domain_id,
  CAST(CASE WHEN tax_id >= 1000 THEN 100 + nation WHEN tax_id >= 100 THEN 100 + said END AS BIGINT) AS phylum_id FROM t""")
def q_target_taxonomy(spark, sf_dir):
    """Each sample's target: by id, by name, or by its first dataset; with the domain and phylum of its lineage."""
    at = lambda rank: F.try_element_at("ranks", F.lit(rank))
    return _taxonomy(spark, sf_dir)[0].withColumns({"domain_id": at("domain"), "phylum_id": at("phylum")}).drop("ranks")


@query(_SAMPLES + """,
c AS (SELECT sample, 1 AS nth, lower(said_name) AS query, 100 + said AS lineage_tax_id, CASE WHEN kind < 2 THEN CASE WHEN said = nation THEN 100 + said WHEN said_region = region THEN 10 + region ELSE 1 END ELSE 100 + said END AS shared FROM t WHERE has_nation
  UNION ALL SELECT sample, 2, lower(r_name), 10 + region, CASE WHEN kind < 2 OR NOT has_nation OR said_region = region THEN 10 + region ELSE 1 END FROM t WHERE has_region)
SELECT sample, CAST(nth AS INTEGER) AS nth, query, CAST(lineage_tax_id AS BIGINT) AS lineage_tax_id, CASE WHEN shared = lineage_tax_id THEN 'consistent' ELSE 'mismatch' END AS concordance, CAST(shared AS BIGINT) AS shared_tax_id FROM c""")
def q_lineage_checks(spark, sf_dir):
    """Whether each dataset's taxon lies on the lineage of its sample's target, and where the two part."""
    return _taxonomy(spark, sf_dir)[1].select("sample", "nth", "query", "lineage_tax_id", "concordance", "shared_tax_id")


@query("""WITH f AS (
  SELECT o_custkey AS record, o_orderkey * 10000000 AS gene_no, ((l_orderkey * 8 + l_linenumber) * 100000 + l_partkey) * 64 + CAST(l_quantity AS BIGINT) AS feature_no, o_orderkey % 3 = 0 AS has_tag, 'T' || o_orderkey AS tag, l_returnflag AS flag,
    l_tax < 0.08 AND l_linenumber + l_quantity <= 50 AS within, (l_linenumber + CAST(l_partkey AS BIGINT)) % 2 = 0 AS plain FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
g AS (SELECT DISTINCT record, gene_no, -feature_no AS feature_no, has_tag, tag, flag, CASE WHEN flag = 'N' THEN has_tag OR within WHEN flag = 'A' THEN plain AND within ELSE within END AS held FROM f)
SELECT record, feature_no, CASE WHEN held THEN gene_no END AS gene_no, 'kept' AS fate, CASE WHEN flag = 'N' OR held AND has_tag THEN tag ELSE '' END AS locus_tag FROM g
UNION ALL SELECT o_custkey, o_orderkey * 10000000, NULL, CASE WHEN o_orderkey * 10000000 IN (SELECT gene_no FROM g WHERE held) THEN 'represented' ELSE 'misc_feature' END, CASE WHEN o_orderkey % 3 = 0 THEN 'T' || o_orderkey ELSE '' END FROM orders""")
def q_organelle_parent(spark, sf_dir):
    """Orders as genes of their customers' records, lines as CDS: the gene of each by its tag, else by name and place; and the tags that they inherit."""
    pair = lambda k, v, c: F.when(c, F.struct(F.lit(k).alias("key"), v.alias("value")))
    orders = T.table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.concat(F.lit("T"), "o_orderkey").alias("tag"), F.concat(F.lit("g"), "o_orderkey").alias("name"))
    spot = lambda a, z, strand: F.array(F.struct(a.cast("bigint").alias("start"), z.cast("bigint").alias("end"), strand.alias("strand")))
    # lines may have equal numbers, as of a part key from 100000 on: a feature is its number and what else tells it from others
    feature = lambda number, line, kind, strand: F.struct(number.alias("number"), F.col("o_orderkey").alias("order"), line.alias("line"), kind.alias("flag"), strand.alias("strand")).alias("feature_no")
    genes = orders.select(F.col("o_custkey").alias("record"), feature(F.col("o_orderkey").cast("bigint") * 10000000, F.lit(0), F.lit("gene"), F.lit("+")), F.lit("gene").alias("type"),
        F.array_compact(F.array(pair("gene", F.col("name"), F.lit(True)), pair("locus_tag", F.col("tag"), F.col("o_orderkey") % 3 == 0))).alias("qualifiers"), spot(F.col("o_orderkey") * 100, F.col("o_orderkey") * 100 + 50, F.lit("+")).alias("parts"))
    flag, odd = F.col("l_returnflag"), (F.col("l_linenumber") + F.col("l_partkey")) % 2 != 0
    number = ((F.col("l_orderkey").cast("bigint") * 8 + F.col("l_linenumber")) * 100000 + F.col("l_partkey")) * 64 + F.col("l_quantity").cast("bigint")
    start, strand = F.col("l_orderkey") * 100 + F.col("l_linenumber"), F.when(F.col("l_tax") < 0.08, "+").otherwise("-")
    lines = T.table(spark, sf_dir, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    lines = lines.select(F.col("o_custkey").alias("record"), feature(-number, F.col("l_linenumber"), flag, strand), F.lit("CDS").alias("type"),
        F.array_compact(F.array(pair("gene", F.col("name"), flag == "R"), pair("gene", F.lit("x"), (flag == "A") & odd), pair("locus_tag", F.col("tag"), flag == "N"))).alias("qualifiers"),
        spot(start, start + F.col("l_quantity"), strand).alias("parts")).distinct()
    rows = cut(genes.unionByName(lines), "organelle_features")
    done = organelles.with_genes(rows, cut(organelles.gene_parents(rows), "parents"))
    tag = F.array_join(F.transform(F.filter("qualifiers", lambda q: q["key"] == "locus_tag"), lambda q: q["value"]), ",").alias("locus_tag")
    told = done.select("record", "feature_no.order", "feature_no.flag", F.col("feature_no.number").alias("feature_no"), F.col("gene_no.number").alias("gene_no"), "fate", tag).distinct()
    return told.select("record", "feature_no", "gene_no", "fate", "locus_tag")


@query("""WITH w AS (SELECT o_orderstatus AS item, o_orderkey AS identity, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS k FROM orders),
b AS (SELECT item, coalesce(sum(n) OVER (ORDER BY item ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM (SELECT item, count(*) AS n FROM w GROUP BY item)),
u AS (SELECT DISTINCT l_partkey AS n FROM lineitem WHERE l_returnflag = 'R'),
f AS (SELECT item, n, row_number() OVER (PARTITION BY item ORDER BY n) AS k FROM b, (SELECT unnest(range(1, (SELECT count(*) FROM orders) + (SELECT count(*) FROM u) + 1)) AS n) WHERE n > before AND n NOT IN (SELECT n FROM u))
SELECT item, CAST(identity AS VARCHAR) AS identity, 'AB_' || item || lpad(CAST(n AS VARCHAR), 6, '0') AS locus_tag FROM w JOIN f USING (item, k)""")
def q_organelle_tags(spark, sf_dir):
    """New tags of orders, their states as organelles, past the numbers that returned parts have taken in each."""
    items = F.array_position(F.array(F.lit("F"), F.lit("O"), F.lit("P")), F.col("o_orderstatus"))
    wanted = T.table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("item"), items.alias("item_no"), F.col("o_orderkey").cast("string").alias("identity"), F.col("o_orderkey").alias("place"))
    parts = T.table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select("l_partkey").distinct()
    reserved = parts.select(F.explode(F.array(*(F.concat(F.lit(f"AB_{i}"), F.format_string("%06d", "l_partkey")) for i in "FOP"))).alias("locus_tag"))
    return organelles.assigned_tags(wanted, reserved, "AB")
