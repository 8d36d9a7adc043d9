"""Queries on evidence, names and families."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomgene.functions import names as N
from loomgene.operators import audit, evidence, graph
from loomgene.plans import adapters as T
from loomgene.plans.registry import query
from loomgene.shared import cut

_STOP = ", ".join(f"'{w}'" for w in N.STOPWORDS)
_CONSENSUS = f"""WITH {T.HITS},
p AS (SELECT *, max(bitscore) OVER (PARTITION BY qseqid) AS best FROM hits WHERE description <> '' AND bitscore >= 50 AND pident >= 35 AND qcov >= 70 AND scov >= 70),
a AS (SELECT *, greatest(0.0::DOUBLE, weight * taxonomy_weight * bitscore / best * sqrt(qcov / 100 * scov / 100)) AS evidence,
    list_distinct(list_filter(regexp_extract_all(lower(description), '[a-z0-9]+'), lambda x: length(x) > 1 AND x NOT IN ({_STOP}))) AS tokens
  FROM p WHERE bitscore >= 0.9 * best AND description <> 'hypothetical protein'),
h AS (SELECT * FROM a WHERE len(tokens) > 0),
w AS (SELECT qseqid, hit_no, evidence, unnest(tokens) AS token FROM h),
s AS (SELECT qseqid, token, sum(evidence) AS share FROM w GROUP BY ALL),
m AS (SELECT w.qseqid, hit_no, avg(share) AS mean_share FROM w JOIN s USING (qseqid, token) GROUP BY ALL),
t AS (SELECT qseqid, sum(evidence) AS total, count(*) AS n FROM h GROUP BY 1),
r AS (SELECT h.*, n, round(mean_share / total, 9) AS score FROM h JOIN m USING (qseqid, hit_no) JOIN t USING (qseqid)),
won AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY qseqid ORDER BY score DESC, evidence DESC, weight DESC, bitscore DESC, hit_no) = 1)"""


@query(_CONSENSUS + """
SELECT qseqid, description AS product, database AS source, round(score, 6) AS score, n AS hits, '*' || CASE WHEN least(qcov, scov) > 60 THEN '*' ELSE '-' END || CASE WHEN score > 0.5 THEN '*' ELSE '-' END AS quality,
  CASE WHEN relation = 'unknown' OR database = 'uniref90' THEN 'moderate' ELSE 'high' END AS confidence
FROM won WHERE score >= 0.6 AND bitscore > 50""")
def q_consensus(spark, sf_dir):
    won = evidence.consensus(evidence.accepted_hits(T.hits(spark, sf_dir))).where("bitscore > 50")
    return won.select("qseqid", "product", "source", F.round("score", 6).alias("score"), "hits", "quality", "confidence")


@query(f"""WITH {T.HITS}
SELECT qseqid, description AS product, database AS source, bitscore FROM hits
QUALIFY row_number() OVER (PARTITION BY qseqid ORDER BY CASE WHEN relation = 'unknown' OR database = 'uniref90' THEN 2 ELSE 3 END DESC, taxonomy_weight DESC, CASE database WHEN 'reference' THEN 4 WHEN 'swissprot' THEN 3 ELSE 2 END DESC,
  pident DESC, least(qcov, scov) DESC, bitscore DESC, hit_no) = 1""")
def q_best_assignment(spark, sf_dir):
    h = T.hits(spark, sf_dir)
    a = h.select("qseqid", F.col("description").alias("product"), F.col("database").alias("source"), F.col("pident").alias("score"), "bitscore", F.least("qcovhsp", "scovhsp").alias("coverage"), evidence.confidence(F.col("taxonomy_relation"), F.col("database")).alias("confidence"), "taxonomy_weight", F.col("hit_no").alias("input_no"))
    return evidence.best_assignment(a).select("qseqid", "product", "source", "bitscore")


@query(_CONSENSUS + " SELECT o_orderkey AS qseqid FROM orders WHERE o_orderkey NOT IN (SELECT qseqid FROM won WHERE score >= 0.6)")
def q_unassigned(spark, sf_dir):
    q = T.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("qseqid"))
    return evidence.unassigned(q, evidence.consensus(evidence.accepted_hits(T.hits(spark, sf_dir))))


_IDF = "idf AS MATERIALIZED (SELECT token, count(*) AS df, ln(((SELECT count(*) FROM tok WHERE tokens IS NOT NULL) + 1) / (count(*) + 1)) + 1 AS idf FROM (SELECT unnest(tokens) AS token FROM tok WHERE tokens IS NOT NULL) GROUP BY 1)"


@query(f"WITH {T.NAMED}, {_IDF} SELECT token, round(idf, 6) AS idf FROM idf")
def q_idf(spark, sf_dir):
    t = T.named(spark, sf_dir).where("source <> 'none'").select(N.canonical_tokens(F.col("name")).alias("tokens"))
    return audit.idf(t).select("token", F.round("idf", 6).alias("idf"))


_PAIRS = f"""WITH {T.NAMED}, {_IDF}, {T.LINKS},
j AS MATERIALIZED (SELECT l.a, l.b, pident, qcov, scov, x.source AS source_a, y.source AS source_b, x.surface AS sa, y.surface AS sb, x.tokens AS ta, y.tokens AS tb, x.name AS name_a, y.name AS name_b
  FROM links l JOIN tok x ON l.a = x.id JOIN tok y ON l.b = y.id),
u AS (SELECT a, b, unnest(list_distinct(list_concat(ta, tb))) AS token, ta, tb FROM j WHERE ta IS NOT NULL AND tb IS NOT NULL),
k AS MATERIALIZED (SELECT a, b, count(*) FILTER (list_contains(ta, token) AND list_contains(tb, token)) AS n_both, coalesce(sum(idf) FILTER (list_contains(ta, token) AND list_contains(tb, token)), 0) / sum(idf) AS similarity FROM u JOIN idf USING (token) GROUP BY ALL),
m AS MATERIALIZED (SELECT j.*, similarity, n_both, list_filter(ta, lambda t: regexp_full_match(t, '[0-9]+|[a-z]+[0-9]+[a-z]*')) AS ma, list_filter(tb, lambda t: regexp_full_match(t, '[0-9]+|[a-z]+[0-9]+[a-z]*')) AS mb FROM j LEFT JOIN k USING (a, b)),
pairs AS MATERIALIZED (SELECT *, CASE WHEN ta IS NULL OR tb IS NULL THEN 'not_evaluable' WHEN sa = sb THEN 'exact' WHEN len(ta) > 0 AND ta = tb THEN 'canonical_equivalent' WHEN len(ma) > 0 AND len(mb) > 0 AND ma <> mb THEN 'review'
    WHEN n_both > 0 AND similarity >= 0.45 THEN 'compatible_granularity' ELSE 'review' END AS relation,
  CASE WHEN ta IS NULL OR tb IS NULL THEN '' WHEN sa = sb THEN 'normalized_text_match' WHEN len(ta) > 0 AND ta = tb THEN 'approved_alias_or_safe_formatting_difference' WHEN len(ma) > 0 AND len(mb) > 0 AND ma <> mb THEN 'specific_modifier_conflict'
    WHEN n_both > 0 AND similarity >= 0.45 THEN 'shared_family_name_with_granularity_difference' ELSE 'incompatible_family_name_tokens' END AS reason FROM m)"""


def _links(spark, sf_dir):
    from loomgene.operators.ranking import best

    both = T.similar(spark, sf_dir).where("qseqid <> sseqid").withColumns({"a": F.least("qseqid", "sseqid"), "b": F.greatest("qseqid", "sseqid")})
    return best(both, ["a", "b"], [F.desc("bitscore"), F.asc("hit_no"), F.asc("pident")]).select("a", "b", "pident", "qcovhsp", "scovhsp", "bitscore")


def _pairs(spark, sf_dir):
    return audit.classify(_links(spark, sf_dir), T.named(spark, sf_dir))


@query(_PAIRS + " SELECT a, b, relation, reason FROM pairs")
def q_name_relation(spark, sf_dir):
    return _pairs(spark, sf_dir).select("a", "b", "relation", "reason")


_NEAR = "near AS (SELECT * FROM pairs WHERE pident >= 90 AND qcov >= 90 AND scov >= 90)"
_ORDER = "CASE {} WHEN 'existing' THEN 0 WHEN 'swissprot' THEN 2 WHEN 'uniref90' THEN 3 WHEN 'pfam' THEN 4 WHEN 'none' THEN 9 ELSE 6 END"


def _near(spark, sf_dir):
    return audit.by_tier(_pairs(spark, sf_dir)).where("tier = 'near_identical'")


@query(_PAIRS + f""", {_NEAR},
s AS (SELECT CASE WHEN {_ORDER.format('source_a')} > {_ORDER.format('source_b')} THEN source_b ELSE source_a END AS source_1, CASE WHEN {_ORDER.format('source_a')} > {_ORDER.format('source_b')} THEN source_a ELSE source_b END AS source_2, relation FROM near WHERE relation <> 'not_evaluable')
SELECT source_1, source_2, count(*) AS pairs, count(*) FILTER (relation = 'exact') AS exact, count(*) FILTER (relation = 'canonical_equivalent') AS canonical_equivalent, count(*) FILTER (relation = 'compatible_granularity') AS compatible_granularity,
  count(*) FILTER (relation = 'review') AS review, round(count(*) FILTER (relation = 'review') / count(*), 6) AS review_rate, count(*) >= 5 AS enough_pairs FROM s GROUP BY ALL""")
def q_source_pairs(spark, sf_dir):
    return audit.source_pairs(_near(spark, sf_dir)).withColumn("review_rate", F.round("review_rate", 6))


@query(_PAIRS + f""", {_NEAR},
e AS (SELECT a AS id, source_a AS own, source_b AS other, name_b AS product FROM near WHERE relation = 'review' UNION ALL SELECT b, source_b, source_a, name_a FROM near WHERE relation = 'review'),
f AS (SELECT id, {_ORDER.format('other')} AS level, product FROM e WHERE {_ORDER.format('other')} < {_ORDER.format('own')}),
g AS (SELECT * FROM f QUALIFY level = min(level) OVER (PARTITION BY id))
SELECT id, min(product) AS product FROM g GROUP BY id HAVING count(DISTINCT product) = 1""")
def q_auto_resolve(spark, sf_dir):
    return audit.auto_resolved(_near(spark, sf_dir), T.named(spark, sf_dir))


def _components_sql(rounds: int = 40) -> str:
    steps = [f"e AS MATERIALIZED (SELECT a, b FROM links WHERE pident >= 90 AND qcov >= 90 AND scov >= 90 UNION SELECT b, a FROM links WHERE pident >= 90 AND qcov >= 90 AND scov >= 90)", "r0 AS MATERIALIZED (SELECT p_partkey AS id, p_partkey AS root FROM part)"]
    steps += [f"r{i} AS MATERIALIZED (SELECT r.id, least(r.root, coalesce(min(o.root), r.root)) AS root FROM r{i - 1} r LEFT JOIN e ON e.a = r.id LEFT JOIN r{i - 1} o ON o.id = e.b GROUP BY r.id, r.root)" for i in range(1, rounds + 1)]
    return f"WITH {T.LINKS}, {', '.join(steps)} SELECT id, root FROM r{rounds}"


@query(_components_sql())
def q_components(spark, sf_dir):
    near = _links(spark, sf_dir).where("pident >= 90 and qcovhsp >= 90 and scovhsp >= 90")
    nodes = T.named(spark, sf_dir).select("id")
    known = near.join(nodes.withColumnRenamed("id", "a"), "a", "left_semi").join(nodes.withColumnRenamed("id", "b"), "b", "left_semi")
    return graph.components(nodes, known)


def _families_sql(rounds: int = 40) -> str:
    steps = ["e AS MATERIALIZED (SELECT a, b FROM near UNION SELECT b, a FROM near)", "r0 AS MATERIALIZED (SELECT id, id AS root FROM named)"]
    steps += [f"r{i} AS MATERIALIZED (SELECT r.id, least(r.root, coalesce(min(o.root), r.root)) AS root FROM r{i - 1} r LEFT JOIN e ON e.a = r.id LEFT JOIN r{i - 1} o ON o.id = e.b GROUP BY r.id, r.root)" for i in range(1, rounds + 1)]
    count = lambda r: f"coalesce(count(*) FILTER (relation = '{r}'), 0) AS {r}"
    return f"""{_PAIRS}, {_NEAR}, {", ".join(steps)},
s AS (SELECT root AS first_member, count(*) AS members, CAST(count(*) FILTER (source <> 'none') AS BIGINT) AS annotated FROM r{rounds} JOIN named USING (id) GROUP BY root),
c AS (SELECT root AS first_member, {", ".join(map(count, ("review", "compatible_granularity", "canonical_equivalent", "exact", "not_evaluable")))},
  round(min(CASE WHEN relation IN ('exact', 'canonical_equivalent') THEN 1 WHEN relation <> 'not_evaluable' THEN similarity END), 6) AS least_similarity FROM near JOIN r{rounds} ON a = id GROUP BY root),
f AS (SELECT s.*, coalesce(review, 0) AS review, coalesce(compatible_granularity, 0) AS compatible_granularity, coalesce(canonical_equivalent, 0) AS canonical_equivalent, coalesce(exact, 0) AS exact, coalesce(not_evaluable, 0) AS not_evaluable, least_similarity
  FROM s LEFT JOIN c USING (first_member)),
families AS (SELECT *, CASE WHEN annotated = 0 THEN 'all_unannotated' WHEN annotated = 1 THEN 'one_annotated' WHEN review + compatible_granularity + canonical_equivalent + exact = 0 THEN 'not_evaluable' WHEN review > 0 THEN 'review'
  WHEN compatible_granularity > 0 THEN 'compatible_granularity' WHEN canonical_equivalent > 0 THEN 'canonical_equivalent' ELSE 'exact' END AS status FROM f)"""


def _families(spark, sf_dir):
    own, genes = _near(spark, sf_dir), T.named(spark, sf_dir)
    members = graph.families(genes.select("id"), own.select("a", "b"), "NID")
    first = members.groupBy("family_id").agg(F.min("id").alias("first_member"))  # the digits of family_id are no SQL's
    return audit.family_rows(own, members, genes).join(first, "family_id")


@query(_families_sql() + " SELECT * FROM families")
def q_family_status(spark, sf_dir):
    return _families(spark, sf_dir).drop("family_id").withColumn("least_similarity", F.round("least_similarity", 6))


@query(_families_sql() + """
SELECT 'near_identical' AS tier, count(*) AS total_clusters, count(*) FILTER (status IN ('review', 'compatible_granularity', 'canonical_equivalent', 'exact')) AS evaluable,
  count(*) FILTER (status IN ('canonical_equivalent', 'exact')) AS strict, count(*) FILTER (status IN ('compatible_granularity', 'canonical_equivalent', 'exact')) AS compatible,
  coalesce(round(count(*) FILTER (status IN ('canonical_equivalent', 'exact')) / nullif(count(*) FILTER (status IN ('review', 'compatible_granularity', 'canonical_equivalent', 'exact')), 0), 6), 0) AS strict_rate,
  coalesce(round(count(*) FILTER (status IN ('compatible_granularity', 'canonical_equivalent', 'exact')) / nullif(count(*) FILTER (status IN ('review', 'compatible_granularity', 'canonical_equivalent', 'exact')), 0), 6), 0) AS compatible_rate
FROM families""")
def q_tier_summary(spark, sf_dir):
    rates = {c: F.round(c, 6) for c in ("strict_rate", "compatible_rate")}
    return audit.tier_summary(_families(spark, sf_dir).withColumn("tier", F.lit("near_identical"))).withColumns(rates)


@query(_families_sql() + f""",
rep AS (SELECT root, name AS product FROM r40 JOIN named USING (id) WHERE source <> 'none' QUALIFY row_number() OVER (PARTITION BY root ORDER BY {_ORDER.format('source')}, name, id) = 1),
safe AS (SELECT m.id, rep.product FROM r40 m JOIN families ON m.root = first_member JOIN rep ON rep.root = m.root JOIN named n ON n.id = m.id
  WHERE status IN ('exact', 'canonical_equivalent') AND review + compatible_granularity + canonical_equivalent + exact > 0 AND n.source <> 'none'),
ae AS (SELECT a AS id, source_a AS own, source_b AS other, name_b AS product FROM near WHERE relation = 'review' UNION ALL SELECT b, source_b, source_a, name_a FROM near WHERE relation = 'review'),
af AS (SELECT id, {_ORDER.format('other')} AS level, product FROM ae WHERE {_ORDER.format('other')} < {_ORDER.format('own')}),
ag AS (SELECT * FROM af QUALIFY level = min(level) OVER (PARTITION BY id)),
auto AS (SELECT id, min(product) AS product FROM ag GROUP BY id HAVING count(DISTINCT product) = 1)
SELECT n.id AS "ID", coalesce(safe.product, auto.product, n.name) AS "Description", 'AB_' || n.id AS "Locus_tag", coalesce(safe.product, auto.product, n.name) <> n.name AS changed
FROM named n LEFT JOIN safe USING (id) LEFT JOIN auto USING (id)""")
def q_harmonised(spark, sf_dir):
    """The table of products after the audit: nearly identical families in one form, conflicts decided by better sources."""
    near, genes = _near(spark, sf_dir), T.named(spark, sf_dir)
    members = cut(graph.families(genes.select("id"), near.select("a", "b"), "NID"), "members")
    none = F.lit(None).cast("double")
    products = audit.representative(members.join(genes, "id").withColumns({"confidence": F.lit(""), "score": none, "bitscore": none}))
    safe = audit.harmonised(genes, audit.family_rows(near, members, genes), members, products)
    annotation = genes.select(F.col("id").alias("ID"), F.col("name").alias("Description"), F.concat(F.lit("AB_"), "id").alias("Locus_tag"))
    return audit.updated(annotation, genes, audit.resolved_products(audit.auto_resolved(near, genes), safe))


@query(_PAIRS + f""", e AS (SELECT a AS id, relation FROM pairs WHERE pident >= 70 AND qcov >= 80 AND scov >= 80 UNION ALL SELECT b, relation FROM pairs WHERE pident >= 70 AND qcov >= 80 AND scov >= 80),
g AS (SELECT id, bool_or(relation = 'review') AS r, bool_or(relation <> 'not_evaluable') AS c FROM e GROUP BY 1)
SELECT named.id, CASE WHEN source = 'none' THEN 'unannotated' WHEN r THEN 'review' WHEN c THEN 'consistent' ELSE 'no_close_family_peer' END AS status FROM named LEFT JOIN g ON named.id = g.id""")
def q_gene_status(spark, sf_dir):
    return audit.gene_rows(T.named(spark, sf_dir), audit.by_tier(_pairs(spark, sf_dir))).select("id", "status")


@query("""
SELECT c_custkey, CASE WHEN c_custkey = 7 THEN 'same_species' WHEN c_nationkey = 3 THEN 'same_family' WHEN n_regionkey = 2 THEN 'same_kingdom' WHEN n_regionkey < 2 THEN 'cross_kingdom' WHEN n_regionkey = 3 THEN 'cross_domain' ELSE 'unknown' END AS relation,
  CASE WHEN c_custkey = 7 THEN 1.35::DOUBLE WHEN c_nationkey = 3 THEN 1.25::DOUBLE WHEN n_regionkey = 2 THEN 1.0::DOUBLE WHEN n_regionkey < 2 THEN 0.72::DOUBLE WHEN n_regionkey = 3 THEN 0.45::DOUBLE ELSE 0.9::DOUBLE END AS weight
FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def q_taxonomy_relation(spark, sf_dir):
    c = T.table(spark, sf_dir, "customer").join(T.table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    # regions 0 to 2 are eukaryotes, 3 bacteria; 4 has no domain
    domain = F.when(F.col("n_regionkey") < 3, 2759).when(F.col("n_regionkey") == 3, 2).otherwise(131567).cast("bigint")
    lineage = F.array((F.col("c_nationkey") + 10_000_000).cast("bigint"), (F.col("n_regionkey") + 50_000_000).cast("bigint"), domain)
    relation = evidence.taxonomy_relation(F.col("c_custkey") + 20_000_000, lineage, F.lit(20_000_007).cast("bigint"), F.expr("map('family', 10000003L, 'kingdom', 50000002L, 'domain', 2759L)"))
    return c.select("c_custkey", relation.alias("relation")).withColumn("weight", evidence.relation_weight(F.col("relation")))


#: A name around a part's own, what becomes of it, and the actions; @ stands for the part's name.
_NAMES = (
    ("Probable @, mitochondrial", "putative @", "removed_localization_suffix,normalized_uncertainty"),
    ("@;sulphur", "@-sulfur", "replaced_semicolon,american_spelling"),
    ('fragment "@".', "@", "removed_partial_term"),
    ("Unknown protein", "hypothetical protein", "used_hypothetical_product"),
    ("LOW QUALITY PROTEIN: @ &amp; co", "@ & co", "decoded_html_entity,removed_quality_prefix"),
    ("@ [Signal transduction mechanisms]", "@", "removed_cog_category"),
    ("@ proteins and related proteins domain-containing protein", "@ protein family protein", "generalized_related_proteins"),
    ("@: an acronym for nothing domain-containing protein", "@ domain-containing protein", "removed_explanatory_text"),
    ("@, contains WD40 repeats domain-containing protein", "WD40 repeat-containing protein", "reduced_contains_description"),
    ("@ (or alias) kinase", "@ kinase", "removed_alternative_name"),
    ("@ domain domain-containing protein", "@ domain-containing protein", "removed_repeated_domain_word"),
    ("@ superfamily domain-containing protein", "@ superfamily protein", "normalized_superfamily_name"),
    ("@ COG1234", "@", "removed_database_identifier"),
    ("@ LOC101", "@", "removed_locus_identifier"),
    ("@ helicase conserved C-terminal domain", "@ helicase C-terminal domain", "removed_conserved_term"),
    ("likely @ domain-containing protein", "@ domain-containing protein", "removed_redundant_uncertainty"),
    ("@ golgin candidate", "@ golgin protein", "removed_candidate_term"),
    ("novel plant SNARE @", "SNARE protein @", "generalized_taxon_specific_name"),
    ("@ homolog 2", "@-like protein 2", "replaced_evolutionary_term"),
    ("Kinase of @", "kinase of @", "lowercased_initial"),
    ("@ -like protein", "@-like protein", "joined_split_hyphen"),
    ("secreted @", "@", "removed_localization_term"),
    ("@ases and related proteins with a family of repeats domain-containing protein", "@ase family protein", "generalized_related_proteins"),
    ("@ family kinases and similar proteins domain-containing protein", "@ family kinase protein", "generalized_related_proteins"),
    ("possible probable @ domain-containing protein", "probable @ domain-containing protein", "removed_redundant_uncertainty"),
    ("probable possible @", "putative possible @", "normalized_uncertainty"),
    ("DnaJ homologue subfamily @", "DnaJ subfamily @", "replaced_evolutionary_term"),
)


def _names_sql() -> str:
    quoted = lambda t: "'" + t.replace("'", "''") + "'"
    case = lambda k: f"CASE p_partkey % {len(_NAMES)} " + " ".join(f"WHEN {i} THEN {quoted(n[k])}" for i, n in enumerate(_NAMES)) + " END"
    return f"SELECT p_partkey, replace({case(1)}, '@', p_name) AS name, {case(2)} AS actions FROM part"


@query(_names_sql())
def q_product_rules(spark, sf_dir):
    raw = F.get(F.array(*(F.lit(n[0]) for n in _NAMES)), (F.col("p_partkey") % len(_NAMES)).cast("int"))
    rows = N.standardise(T.table(spark, sf_dir, "part").select("p_partkey", F.replace(raw, F.lit("@"), F.col("p_name")).alias("raw")), F.col("raw"), "s")
    return rows.select("p_partkey", "s.name", F.array_join("s.actions", ",").alias("actions"))


# Names with what is known of their source and target: name, source, evidence, organism, domain of the target, standard name, actions.
_CONTEXT = (
    ("Mus musculus @", "swissprot", "", "Mus musculus", "Eukaryota", "@", "removed_organism_name"),
    ("bacterial PH domain-containing protein", "pfam", "PF00169.1", "", "Eukaryota", "PH domain-containing protein", "generalized_cross_domain_name"),
    ("membrane lipoprotein", "cdd", "", "", "Eukaryota", "hypothetical protein", "rejected_cross_domain_name,used_hypothetical_product"),
    ("membrane lipoprotein", "cdd", "", "", "Bacteria", "membrane lipoprotein", ""),
    ("@ of unknown function domain-containing protein", "pfam", "PF12345.7", "", "", "PF12345 domain-containing protein", "used_stable_model_identifier"),
    ("@ of unknown function domain-containing protein", "swissprot", "PF12345.7", "", "", "@ of unknown function domain-containing protein", ""),
)


def _context_sql() -> str:
    quoted = lambda t: "'" + t.replace("'", "''") + "'"
    case = lambda k: f"CASE p_partkey % {len(_CONTEXT)} " + " ".join(f"WHEN {i} THEN {quoted(n[k])}" for i, n in enumerate(_CONTEXT)) + " END"
    return f"SELECT p_partkey, replace({case(5)}, '@', p_name) AS name, {case(6)} AS actions FROM part"


@query(_context_sql())
def q_product_context(spark, sf_dir):
    """Rules that look at the organism, the target's domain and the kind of evidence."""
    pick = lambda k: F.get(F.array(*(F.lit(n[k]) for n in _CONTEXT)), (F.col("p_partkey") % len(_CONTEXT)).cast("int"))
    rows = T.table(spark, sf_dir, "part").select("p_partkey", F.replace(pick(0), F.lit("@"), F.col("p_name")).alias("name"), *(pick(k + 1).alias(c) for k, c in enumerate(("source", "evidence", "organism", "domain"))))
    out = N.standardise(rows, F.col("name"), source=F.col("source"), evidence_id=F.col("evidence"), organism=F.col("organism"), domain=F.col("domain"))
    return out.select("p_partkey", F.col("std.name").alias("name"), F.array_join("std.actions", ",").alias("actions"))
