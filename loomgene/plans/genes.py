"""Queries on transcripts, genes, hierarchies and intervals."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomgene.functions import attributes as A
from loomgene.operators import flow, graph, intervals, ranking, render, review
from loomgene.plans import adapters as T
from loomgene.plans.registry import query
from loomgene.sources import tables

_MODELS = f"""WITH {T.PARTS},
m AS (
  SELECT gene, transcript, CAST(sum(CASE WHEN kind = 'CDS' THEN e - s + 1 ELSE 0 END) AS BIGINT) AS cds_length,
    CAST(sum(CASE WHEN kind = 'UTR' THEN e - s + 1 ELSE 0 END) AS BIGINT) AS utr_length, min(s * 1000000 + e) AS place
  FROM parts GROUP BY ALL),
r AS (
  SELECT *, count(*) OVER (PARTITION BY gene) AS candidates,
    row_number() OVER (PARTITION BY gene ORDER BY cds_length DESC, utr_length DESC, place, transcript) AS n
  FROM m)"""


@query(_MODELS + " SELECT gene, transcript, cds_length, utr_length, candidates, candidates > 1 AS changed FROM r WHERE n = 1")
def q_isoform_select(spark, sf_dir):
    return ranking.isoforms(T.parts(spark, sf_dir))


@query(_MODELS + " SELECT gene, transcript FROM r WHERE n > 1")
def q_isoform_removed(spark, sf_dir):
    parts = T.parts(spark, sf_dir)
    return parts.select("gene", "transcript").distinct().join(ranking.isoforms(parts).select("transcript"), "transcript", "left_anti").select("gene", "transcript")


@query("""
WITH m AS (
  SELECT l_orderkey, count(*) AS n, count(*) FILTER (l_returnflag = 'R') AS stops, count(DISTINCT l_linestatus) AS completeness,
    count(*) FILTER (l_tax > 0.06) AS ambiguous, sum(l_quantity) AS length
  FROM lineitem GROUP BY 1),
g AS (
  SELECT o_custkey AS seqid, CAST(year(o_orderdate) * 100 + month(o_orderdate) AS BIGINT) AS start, o_orderstatus AS strand, o_orderkey AS gene,
    CASE WHEN n IS NULL THEN 0 ELSE 1 END AS valid, coalesce(stops, 0) AS stops, coalesce(completeness, 0) AS completeness, coalesce(ambiguous, 0) AS ambiguous,
    coalesce(length, 0) AS length, coalesce(n, 1) - 1 AS introns
  FROM orders LEFT JOIN m ON l_orderkey = o_orderkey),
k AS (
  SELECT *, count(*) OVER w AS c, min(gene) OVER w AS first_row,
    row_number() OVER (PARTITION BY seqid, start, strand ORDER BY valid DESC, stops, completeness DESC, ambiguous, length DESC, introns, gene) AS rank
  FROM g WINDOW w AS (PARTITION BY seqid, start, strand)),
d AS (SELECT *, dense_rank() OVER (ORDER BY first_row) AS group_no FROM k WHERE c > 1)
SELECT printf('coordinate_duplicate_%06d', x.group_no) AS group_id, x.seqid, x.start, x.strand, y.gene AS kept, x.gene AS removed,
  CASE WHEN x.valid <> y.valid THEN 'valid_structure' WHEN x.stops <> y.stops THEN 'fewer_internal_stops' WHEN x.completeness <> y.completeness THEN 'more_complete'
    WHEN x.ambiguous <> y.ambiguous THEN 'fewer_ambiguous_residues' WHEN x.length <> y.length THEN 'longer_cds' WHEN x.introns <> y.introns THEN 'fewer_introns' ELSE 'input_order' END AS reason
FROM d x JOIN d y ON x.group_no = y.group_no AND y.rank = 1 WHERE x.rank > 1""")
def q_coord_dups(spark, sf_dir):
    l = T.table(spark, sf_dir, "lineitem")
    m = l.groupBy("l_orderkey").agg(F.lit(True).alias("valid"), F.count_if(F.col("l_returnflag") == "R").alias("stops"), F.countDistinct("l_linestatus").alias("completeness"), F.count_if(F.col("l_tax") > 0.06).alias("ambiguous"), F.sum("l_quantity").alias("length"), (F.count("*") - 1).alias("introns"))
    o = T.table(spark, sf_dir, "orders").join(m, F.col("l_orderkey") == F.col("o_orderkey"), "left").na.fill(False, ["valid"]).na.fill(0, ["stops", "completeness", "ambiguous", "length", "introns"])
    genes = o.select(F.col("o_custkey").alias("seqid"), (F.year("o_orderdate") * 100 + F.month("o_orderdate")).cast("bigint").alias("start"), F.col("o_orderstatus").alias("strand"), F.col("o_orderkey").alias("gene"), F.col("o_orderkey").alias("row_no"), "valid", "stops", "completeness", "ambiguous", "length", "introns")
    return ranking.duplicates(genes, ["seqid", "start", "strand"])


@query("""
WITH n AS (SELECT 'n' || n_nationkey AS id FROM nation WHERE n_regionkey = 1),
c AS (SELECT 'c' || c_custkey AS id FROM customer WHERE 'n' || c_nationkey IN (SELECT id FROM n)),
s AS (SELECT 's' || s_suppkey AS id FROM supplier WHERE 'n' || s_nationkey IN (SELECT id FROM n)),
o AS (SELECT 'o' || o_orderkey AS id FROM orders WHERE 'c' || o_custkey IN (SELECT id FROM c)),
l AS (SELECT l_orderkey || '.' || l_linenumber AS id, bool_and('o' || l_orderkey IN (SELECT id FROM o) AND 's' || l_suppkey IN (SELECT id FROM s)) AS gone FROM lineitem GROUP BY 1)
SELECT id FROM n UNION ALL SELECT id FROM c UNION ALL SELECT id FROM s UNION ALL SELECT id FROM o UNION ALL SELECT 'l' || id FROM l WHERE gone""")
def q_descendant_removal(spark, sf_dir):
    edge = lambda name, child, parent: T.table(spark, sf_dir, name).select(child.alias("child"), parent.alias("parent"))
    of = lambda letter, *cols: F.concat(F.lit(letter), F.concat_ws(".", *cols))
    line = of("l", "l_orderkey", "l_linenumber")
    edges = edge("customer", of("c", "c_custkey"), of("n", "c_nationkey")).unionByName(edge("supplier", of("s", "s_suppkey"), of("n", "s_nationkey")))
    edges = edges.unionByName(edge("orders", of("o", "o_orderkey"), of("c", "o_custkey"))).unionByName(edge("lineitem", line, of("o", "l_orderkey"))).unionByName(edge("lineitem", line, of("s", "l_suppkey")))
    return graph.removed(edges, T.table(spark, sf_dir, "nation").where("n_regionkey = 1").select(of("n", "n_nationkey").alias("id")))


_TREE = """WITH e AS MATERIALIZED (
  SELECT 'r' || r_regionkey AS id, NULL AS up, NULL AS nation, NULL AS customer FROM region UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey, NULL, NULL FROM nation
  UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey, 'n' || c_nationkey, NULL FROM customer UNION ALL SELECT 'o' || o_orderkey, 'c' || o_custkey, 'n' || c_nationkey, 'c' || o_custkey FROM orders JOIN customer ON o_custkey = c_custkey),
a AS MATERIALIZED (SELECT e.id, CASE left(e.id, 1) WHEN 'r' THEN e.id WHEN 'n' THEN e.up ELSE 'r' || n_regionkey END AS root, CASE left(e.id, 1) WHEN 'r' THEN '' WHEN 'n' THEN e.id ELSE nation END AS p1,
    CASE left(e.id, 1) WHEN 'c' THEN e.id WHEN 'o' THEN customer ELSE '' END AS p2, CASE WHEN left(e.id, 1) = 'o' THEN e.id ELSE '' END AS p3, CASE left(e.id, 1) WHEN 'r' THEN 0 WHEN 'n' THEN 1 WHEN 'c' THEN 2 ELSE 3 END AS depth
  FROM e LEFT JOIN nation ON 'n' || n_nationkey = nation)"""


def _tree(spark, sf_dir):
    """Regions, their nations, customers and orders (of known customers) as a forest."""
    node = lambda name, id_, up: T.table(spark, sf_dir, name).select(id_.alias("id"), up.alias("up"))
    of = lambda letter, col: F.concat(F.lit(letter), col)
    orders = T.table(spark, sf_dir, "orders").join(T.table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left_semi").select(of("o", "o_orderkey").alias("id"), of("c", "o_custkey").alias("up"))
    out = node("region", of("r", "r_regionkey"), F.lit(None).cast("string")).unionByName(node("nation", of("n", "n_nationkey"), of("r", "n_regionkey")))
    return out.unionByName(node("customer", of("c", "c_custkey"), of("n", "c_nationkey"))).unionByName(orders).withColumn("key", F.col("id"))


@query(_TREE + """,
t AS (SELECT *, row_number() OVER (PARTITION BY root ORDER BY p1, p2, p3) - 1 AS nth FROM a)
SELECT t.id, root, nth, depth, CASE depth WHEN 0 THEN count(*) OVER (PARTITION BY root) WHEN 1 THEN count(*) OVER (PARTITION BY root, p1) WHEN 2 THEN count(*) OVER (PARTITION BY root, p1, p2) ELSE 1 END AS size FROM t""")
def q_tour(spark, sf_dir):
    return graph.tours(_tree(spark, sf_dir))


@query(_TREE + """
SELECT p1 AS ancestor, id FROM a WHERE depth > 1 UNION ALL SELECT p2, id FROM a WHERE depth = 3""")
def q_descendants(spark, sf_dir):
    tour = graph.tours(_tree(spark, sf_dir))
    return graph.descendants(tour, tour.where("depth in (1, 2)").select("id"))


@query("""
SELECT 'o' || o_orderkey AS child, 'r' || n_regionkey AS top FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
UNION ALL SELECT 'c' || c_custkey, 'r' || n_regionkey FROM customer JOIN nation ON c_nationkey = n_nationkey
UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey FROM nation""")
def q_top_ancestors(spark, sf_dir):
    edge = lambda name, child, parent: T.table(spark, sf_dir, name).select(child.alias("child"), parent.alias("parent"))
    of = lambda letter, c: F.concat(F.lit(letter), F.col(c))
    edges = edge("orders", of("o", "o_orderkey"), of("c", "o_custkey")).unionByName(edge("customer", of("c", "c_custkey"), of("n", "c_nationkey"))).unionByName(edge("nation", of("n", "n_nationkey"), of("r", "n_regionkey")))
    return graph.top_ancestors(edges)


@query("""
SELECT a.event_id, b.event_id AS before_id, b.value AS before_value
FROM (SELECT * FROM events WHERE event_type = 'error') a
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'signup') b ON a.user_id = b.user_id AND a.ts > b.ts""")
def q_asof_events(spark, sf_dir):
    e = T.table(spark, sf_dir, "events")
    right = e.where("event_type = 'signup'").select("user_id", "ts", F.col("event_id").alias("before_id"), F.col("value").alias("before_value"))
    return intervals.as_of(e.where("event_type = 'error'").select("event_id", "user_id", "ts"), right, ["user_id"], "ts", ["before_id", "before_value"]).select("event_id", "before_id", "before_value")


@query(f"""
WITH {T.SPANS}
SELECT a.supp, count(*) AS pairs, CAST(sum(least(a.e, b.e) - greatest(a.s, b.s) + 1) AS BIGINT) AS days
FROM spans a JOIN spans b ON a.supp = b.supp AND a.s <= b.e AND b.s <= a.e WHERE a.flag = 'R' AND b.flag = 'N' GROUP BY 1""")
def q_overlap(spark, sf_dir):
    s = T.spans(spark, sf_dir)
    right = s.where("flag = 'N'").select("supp", F.col("start").alias("r_start"), F.col("end").alias("r_end"))
    both = intervals.overlaps(s.where("flag = 'R'"), right, ["supp"], 64)
    return both.groupBy("supp").agg(F.count("*").alias("pairs"), F.sum(F.least("end", "r_end") - F.greatest("start", "r_start") + 1).alias("days"))


@query(f"""
WITH {T.SPANS}
SELECT supp, row_id AS "row" FROM spans a WHERE flag = 'R' AND NOT EXISTS (SELECT 1 FROM spans b WHERE b.flag = 'N' AND a.supp = b.supp AND b.s <= a.s AND a.e <= b.e)""")
def q_containment(spark, sf_dir):
    s = T.spans(spark, sf_dir)
    parents = s.where("flag = 'N'").select("supp", F.col("start").alias("r_start"), F.col("end").alias("r_end"))
    return intervals.outside(s.where("flag = 'R'"), parents, ["supp"]).select("supp", "row")


@query(f"""
WITH {T.SPANS},
o AS (SELECT *, max(e) OVER (PARTITION BY supp ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM spans),
i AS (SELECT *, sum(CASE WHEN before IS NULL OR s > before + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY supp ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island FROM o)
SELECT supp, min(s) AS start, max(e) AS "end", count(*) AS parts FROM i GROUP BY supp, island""")
def q_merge_intervals(spark, sf_dir):
    return intervals.merge(T.spans(spark, sf_dir), ["supp"])


@query(f"""
WITH {T.PARTS},
u AS (SELECT DISTINCT gene, s, e FROM parts WHERE kind = 'CDS'),
o AS (SELECT *, coalesce(sum(e - s + 1) OVER (PARTITION BY gene ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM u),
c AS (SELECT *, least(e - s + 1, greatest(0, 20 - before)) AS off FROM o)
SELECT gene, CAST(s + off AS BIGINT) AS start, e AS "end" FROM c WHERE off < e - s + 1""")
def q_clip_5prime(spark, sf_dir):
    p = T.parts(spark, sf_dir).where("kind = 'CDS'").select("gene", "start", "end").distinct().withColumns({"n": F.lit(20).cast("bigint"), "minus": F.lit(False)})
    return intervals.clip(p, ["gene"], [F.col("start"), F.col("end")], "n", "minus").select("gene", "start", "end")


@query(f"""
WITH {T.PARTS},
u AS (SELECT DISTINCT gene, s, e FROM parts WHERE kind = 'CDS'),
o AS (SELECT *, coalesce(sum(e - s + 1) OVER (PARTITION BY gene ORDER BY e DESC, s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM u),
c AS (SELECT *, least(e - s + 1, greatest(0, 20 - before)) AS off FROM o)
SELECT gene, s AS start, CAST(e - off AS BIGINT) AS "end" FROM c WHERE off < e - s + 1""")
def q_clip_3prime(spark, sf_dir):
    p = T.parts(spark, sf_dir).where("kind = 'CDS'").select("gene", "start", "end").distinct().withColumns({"n": F.lit(20).cast("bigint"), "minus": F.lit(True)})
    return intervals.clip(p, ["gene"], [F.desc("end"), F.desc("start")], "n", "minus").select("gene", "start", "end")


@query(f"""
WITH {T.PARTS}
SELECT gene, transcript, greatest(s, 1) AS start, least(e, p_size * 40) AS "end" FROM parts JOIN part ON gene = p_partkey WHERE greatest(s, 1) <= least(e, p_size * 40)""")
def q_trim_bounds(spark, sf_dir):
    lengths = T.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("gene"), (F.col("p_size") * 40).cast("bigint").alias("length"))
    return intervals.within(T.parts(spark, sf_dir).select("gene", "transcript", "start", "end"), lengths, "gene")


@query(f"WITH {T.PARTS} SELECT s AS start, e AS \"end\", count(DISTINCT gene) AS loci FROM parts GROUP BY ALL HAVING count(DISTINCT gene) > 1")
def q_shared_segments(spark, sf_dir):
    return intervals.shared_segments(T.parts(spark, sf_dir), "gene", ["start", "end"])


@query(f"""
WITH {T.PARTS},
u AS (SELECT DISTINCT gene, s, e FROM parts),
t AS (SELECT gene, count(*) AS n, string_agg(CASE WHEN s = e THEN CAST(s AS VARCHAR) ELSE s || '..' || e END, ',' ORDER BY s, e) AS x FROM u GROUP BY 1)
SELECT o_orderkey AS gene, CASE WHEN o_orderstatus = 'F' THEN 'complement(' ELSE '' END || CASE WHEN n > 1 THEN 'join(' || x || ')' ELSE x END || CASE WHEN o_orderstatus = 'F' THEN ')' ELSE '' END AS location
FROM t JOIN orders ON gene = o_orderkey""")
def q_locations(spark, sf_dir):
    p = T.parts(spark, sf_dir).select("gene", F.struct("start", "end").alias("part")).distinct().groupBy("gene").agg(F.array_sort(F.collect_list("part")).alias("parts"))
    o = T.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("gene"), F.when(F.col("o_orderstatus") == "F", "-").otherwise("+").alias("strand"))
    return p.join(o, "gene").select("gene", render.location(F.col("parts"), F.col("strand")).alias("location"))


@query(f"""
SELECT o_orderkey AS gene, 'AB_' || printf('%09d', 100 * row_number() OVER (ORDER BY o_custkey, {T.DAY.format('o_orderdate')}, o_orderkey)) AS locus_tag FROM orders""")
def q_locus_tags(spark, sf_dir):
    o = T.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("gene"), F.col("o_custkey").alias("seq_no"), T.day("o_orderdate").alias("start"), F.col("o_orderkey").alias("row_no"))
    return render.locus_tags(o, "AB").select("gene", "locus_tag")


@query("""
SELECT o_orderkey, 'ID=AB_' || p || '-AB_' || p || ';Parent=AB_' || p || ',AB_' || o_orderkey || 'x;locus_tag=AB_' || p || ';Note=AB_' || o_orderkey AS attributes
FROM (SELECT o_orderkey, CASE WHEN length(CAST(o_orderkey AS VARCHAR)) >= 6 THEN CAST(o_orderkey AS VARCHAR) ELSE printf('%06d', o_orderkey) END AS p FROM orders)""")
def q_prefix_pad(spark, sf_dir):
    """Two numbers in an id, surplus zeros, a number before a letter, and a note, which is no identifier."""
    o = F.col("o_orderkey")
    text = F.concat(F.lit("ID=AB_"), o, F.lit("-AB_"), o, F.lit(";Parent=AB_000000"), o, F.lit(",AB_"), o, F.lit("x;locus_tag=AB_0"), o, F.lit(";Note=AB_"), o)
    return T.table(spark, sf_dir, "orders").select("o_orderkey", A.pad_loci(text, "AB", 6).alias("attributes"))


@query("""
SELECT event_id, 'e' || event_id AS id, CAST(2 AS BIGINT) AS parents, 'u' || user_id AS first_parent, event_type || ',' || CAST(value AS VARCHAR) AS note FROM events""")
def q_attr_parse(spark, sf_dir):
    e = T.table(spark, sf_dir, "events")
    text = F.concat(F.lit("ID=e"), F.col("event_id"), F.lit("; Parent=u"), F.col("user_id"), F.lit(",s%2C1;Note="), F.col("event_type"), F.lit("%2C"), F.col("value").cast("string"))
    rows = e.select("event_id", A.parse(text).alias("m"), A.parents(text).alias("p"))
    return rows.select("event_id", F.col("m")["ID"].alias("id"), F.size("p").cast("bigint").alias("parents"), F.col("p")[0].alias("first_parent"), F.col("m")["Note"].alias("note"))


@query("""
SELECT event_id, 'ID=e' || event_id || ';Note=' || event_type || '.x.y' AS text, event_id % 2 = 0 AS trailing, TRUE AS glued FROM events""")
def q_attr_repair(spark, sf_dir):
    end = F.when(F.col("event_id") % 2 == 0, ";").otherwise("")
    text = F.concat(F.lit("ID=e"), F.col("event_id"), F.lit(";Note="), F.col("event_type"), F.lit(";x;y"), end)
    return T.table(spark, sf_dir, "events").select("event_id", A.repair(text).alias("r")).select("event_id", "r.text", "r.trailing", "r.glued")


@query("""
WITH r AS (SELECT conv_id, turn, CASE WHEN role = 'user' THEN 'user' ELSE '' END AS feature FROM conversations),
b AS (SELECT *, CAST(sum(CASE WHEN feature <> '' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS BIGINT) AS block_no FROM r)
SELECT conv_id, turn, block_no, CASE WHEN block_no > 0 THEN 'user' END AS feature FROM b""")
def q_forward_fill(spark, sf_dir):
    c = T.table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").alias("line_no"), F.lit("").alias("entry"), F.when(F.col("role") == "user", "user").otherwise("").alias("feature"), F.lit("").alias("location"), F.lit("").alias("qualifier"), F.lit("").alias("value"))
    return tables.fill(c, ["conv_id"]).select("conv_id", F.col("line_no").alias("turn"), "block_no", "feature")


_STAGES = ["signup", "click", "purchase"]


@query("""
WITH u AS (SELECT user_id, bool_or(event_type = 'signup') AS a, bool_or(event_type = 'click') AS b, bool_or(event_type = 'purchase') AS c FROM events WHERE event_type IN ('signup', 'click', 'purchase') GROUP BY 1),
s AS (SELECT 'signup' AS stage, 0 AS position, a AS x, b AS y FROM u UNION ALL SELECT 'click', 1, b, c FROM u)
SELECT stage, position, CASE WHEN x THEN 'changed' ELSE 'unchanged' END AS source, CASE WHEN y THEN 'changed' ELSE 'unchanged' END AS target, count(*) AS count FROM s GROUP BY ALL""")
def q_flow_links(spark, sf_dir):
    m = T.table(spark, sf_dir, "events").where(F.col("event_type").isin(*_STAGES)).select(F.col("event_type").alias("stage"), F.lit("changed").alias("group"), F.col("user_id").alias("id"))
    return flow.links(m, _STAGES)


@query("""
SELECT o_custkey, arg_min(o_orderstatus, CASE o_orderstatus WHEN 'P' THEN 0 WHEN 'O' THEN 1 WHEN 'F' THEN 2 ELSE 9 END) AS status FROM orders GROUP BY 1""")
def q_status_rollup(spark, sf_dir):
    o = T.table(spark, sf_dir, "orders").select("o_custkey", F.col("o_orderstatus").alias("status"))
    return flow.rollup_status(o, "o_custkey", "status", {"P": 0, "O": 1, "F": 2}, 9)


@query("""
SELECT l_returnflag, l_linestatus, count(*) AS count FROM lineitem GROUP BY l_returnflag, l_linestatus UNION ALL SELECT l_returnflag, NULL, count(*) FROM lineitem GROUP BY l_returnflag""")
def q_event_counts(spark, sf_dir):
    return flow.event_counts(T.table(spark, sf_dir, "lineitem"), "l_linestatus", "l_returnflag")


@query("""
WITH a AS (SELECT lang, source, count(*) AS n FROM documents GROUP BY ALL), b AS (SELECT lang, source, count(*) AS n FROM documents WHERE n_chars > 500 GROUP BY ALL)
SELECT lang, source, coalesce(a.n, 0) AS expected, coalesce(b.n, 0) AS found FROM a FULL JOIN b USING (lang, source) WHERE coalesce(a.n, 0) <> coalesce(b.n, 0)""")
def q_multiset_diff(spark, sf_dir):
    d = T.table(spark, sf_dir, "documents")
    return review.multiset_difference(d.select("lang", "source"), d.where("n_chars > 500").select("lang", "source"))


@query("""
WITH m AS (SELECT c_mktsegment AS segment, avg(c_acctbal) AS a, avg(c_acctbal) FILTER (c_nationkey < 12) AS b FROM customer GROUP BY 1)
SELECT segment, round(b - a, 4) AS balance_delta FROM m""")
def q_deltas(spark, sf_dir):
    c = T.table(spark, sf_dir, "customer")
    mean = lambda df, label: df.groupBy(F.col("c_mktsegment").alias("segment")).agg(F.avg("c_acctbal").alias("balance")).withColumn("label", F.lit(label))
    return flow.deltas(mean(c, "input").unionByName(mean(c.where("c_nationkey < 12"), "processed")), "segment", ["balance"])
