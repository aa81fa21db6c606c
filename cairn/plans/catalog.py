"""The registered queries: name, function of (spark, folder), and the equal DuckDB SQL.

The engine's operators are shown on the tables of the folder: an order is a system, its customer the entry, its
priority the biounit, a line the ligand with its part as code and its supplier as chain.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cairn.functions import filters, scalars
from cairn.operators import annotate, enrich, evaluate, graph, ligands, series, similarity, spatial, split
from cairn.session import Workspace
from cairn.sources import datasets
from cairn.sources.sinks import union_all
from cairn.sources.tables import table

FLAGSHIP = "index_default_splits"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its name, with the SQL it must equal."""

    def register(run: Callable[[SparkSession, str], DataFrame]):
        QUERIES[run.__name__] = run
        if sql:
            ORACLE[run.__name__] = sql
        return run

    return register


# What the tables stand for.


def index_of(spark: SparkSession, sf: str) -> DataFrame:
    """An index row by line: system, entry, biounit, code, chain and some measures."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "l_discount")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("o_orderkey").alias("system_id"),
        F.col("o_custkey").alias("entry"),
        F.col("o_orderpriority").alias("biounit"),
        F.col("l_partkey").alias("code"),
        F.col("l_suppkey").alias("chain"),
        F.col("l_quantity").alias("length"),
        F.col("l_discount").alias("discount"),
        (F.col("l_returnflag") == "R").alias("is_artifact"),
        (F.col("l_quantity") > 45).alias("is_cofactor"),
        F.col("o_totalprice").alias("weight"),
    )


INDEX = """index_rows as (
    select o_orderkey as system_id, o_custkey as entry, o_orderpriority as biounit, l_partkey as code, l_suppkey as chain,
           l_quantity as length, l_discount as discount, l_returnflag = 'R' as is_artifact, l_quantity > 45 as is_cofactor,
           o_totalprice as weight
    from lineitem join orders on l_orderkey = o_orderkey)"""


def splits_of(spark: SparkSession, sf: str) -> DataFrame:
    """A split by system; one in ten has none."""
    tenth = F.col("o_orderkey") % 10
    orders = table(spark, sf, "orders").where(tenth < 9)
    name = F.when(tenth < 6, "train").when(tenth < 8, "val").otherwise("test")
    return orders.select(F.col("o_orderkey").alias("system_id"), name.alias("split"))


SPLITS = """splits as (
    select o_orderkey as system_id, case when o_orderkey % 10 < 6 then 'train' when o_orderkey % 10 < 8 then 'val' else 'test' end as split
    from orders where o_orderkey % 10 < 9)"""


def items_of(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("system"), F.col("l_partkey").alias("item"))


def edges_of(spark: SparkSession, sf: str, **bounds) -> DataFrame:
    return similarity.multiset_overlap_edges(items_of(spark, sf), key="system", item="item", **bounds)


EDGES = """cnt as (select l_orderkey as system, l_partkey as item, count(*) as n from lineitem group by all),
    size as (select system, sum(n) as total, count(*) as kinds from cnt group by all),
    edges as (
        select q.system as query, t.system as target,
               cast(round_even(cast(sum(least(q.n, t.n)) as double) / max(s.total) * 100, 0) as integer) as pli_qcov,
               cast(round_even(cast(count(*) as double) / max(s.kinds) * 100, 0) as integer) as pli_unique_qcov
        from cnt q join cnt t on q.item = t.item and q.system <> t.system join size s on s.system = q.system
        group by q.system, t.system)"""


def graph_of(spark: SparkSession, sf: str) -> DataFrame:
    """Links of systems that share at least seven tenths of the query's items; written, for graph operators read them repeatedly."""
    return Workspace(spark, "graph").save(edges_of(spark, sf, min_score=70).select(F.col("query").alias("src"), F.col("target").alias("dst")), "links")


GRAPH = EDGES + ", links as (select query as src, target as dst from edges where pli_qcov >= 70)"


# Scans and filters.


@query(f"""with {SPLITS}
    select o_orderkey as system_id, o_custkey as entry, o_totalprice as weight, coalesce(split, 'unassigned') as split
    from orders left join splits on o_orderkey = system_id
    where coalesce(split, 'unassigned') in ('train', 'val') and o_totalprice > 1000""")
def index_default_splits(spark, sf):
    index = table(spark, sf, "orders").select(F.col("o_orderkey").alias("system_id"), F.col("o_custkey").alias("entry"), F.col("o_totalprice").alias("weight"))
    return datasets.query_index(index, splits_of(spark, sf), columns=["entry", "weight"], filters=[("weight", ">", "1000")], entry="entry")


@query(f"""with {SPLITS}
    select o_orderkey as system_id, coalesce(split, 'unassigned') as split from orders left join splits on o_orderkey = system_id""")
def index_all_splits(spark, sf):
    index = table(spark, sf, "orders").select(F.col("o_orderkey").alias("system_id"))
    return datasets.query_index(index, splits_of(spark, sf), columns=["system_id"], wanted=["*"], entry="system_id")


@query("""select l_orderkey, l_partkey, l_quantity from lineitem
    where (l_quantity >= 45 and l_returnflag = 'R') or (l_discount < 0.02 and l_linestatus <> 'F')""")
def filter_dnf(spark, sf):
    lines = table(spark, sf, "lineitem")
    where = [[("l_quantity", ">=", "45"), ("l_returnflag", "==", "R")], [("l_discount", "<", 0.02), ("l_linestatus", "<>", "F")]]
    return filters.select_where(lines, columns=["l_orderkey", "l_partkey", "l_quantity"], filters=where, schema=lines.schema)


@query("""select p_partkey, p_brand, p_size from part
    where p_size in (1, 7, 14) and p_brand not in ('Brand#2', 'Brand#12') and p_type like '%ECON%'""")
def filter_in(spark, sf):
    part = table(spark, sf, "part")
    where = [("p_size", "in", {1, 7, 14}), ("p_brand", "not in", ["Brand#2", "Brand#12"]), ("p_type", "like", "%ECON%")]
    return filters.select_where(part, columns=["p_partkey", "p_brand", "p_size"], filters=where, schema=part.schema)


@query("""select o_orderkey, o_totalprice from orders where o_custkey in (select c_custkey from customer where c_mktsegment = 'BUILDING')""")
def filter_members(spark, sf):
    chosen = table(spark, sf, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return table(spark, sf, "orders").join(chosen, "o_custkey", "left_semi").select("o_orderkey", "o_totalprice")


@query("""select c_custkey, c_acctbal between 0 and 5000 and c_nationkey between 3 and 12 as in_range from customer""")
def filter_ranges(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", filters.in_ranges({"c_acctbal": (0, 5000), "c_nationkey": (3, 12)}).alias("in_range"))


@query("""select o_orderkey from orders where o_orderkey not in (select l_orderkey from lineitem where l_returnflag = 'R')""")
def missing_work(spark, sf):
    done = table(spark, sf, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return datasets.missing_work(table(spark, sf, "orders").select("o_orderkey"), done, "o_orderkey")


# Enrichment.


@query(f"""with {INDEX}
    select system_id, code, length, count(*) over w as biounit_num_ligands, c.k as biounit_num_unique_codes,
           cast(sum(cast(is_artifact as int)) over w as bigint) as biounit_num_is_artifact, bool_or(is_cofactor) over w as biounit_any_is_cofactor
    from index_rows join (select entry, biounit, count(distinct code) as k from index_rows group by all) c using (entry, biounit)
    window w as (partition by entry, biounit)""")
def enrich_counts(spark, sf):
    found = enrich.aggregated_columns(index_of(spark, sf), entry="entry", biounit="biounit", system="system_id", code="code", flags=["is_artifact", "is_cofactor"])
    return found.select("system_id", "code", "length", "biounit_num_ligands", "biounit_num_unique_codes", "biounit_num_is_artifact", "biounit_any_is_cofactor")


@query(f"""with {INDEX}
    select system_id, string_agg(distinct cast(code as varchar), '-' order by cast(code as varchar)) as codes,
           coalesce(string_agg(distinct cast(code as varchar), '-' order by cast(code as varchar)) filter (where not is_artifact), '') as proper_codes
    from index_rows group by system_id""")
def concat_codes(spark, sf):
    code = F.col("code").cast("string")
    return index_of(spark, sf).groupBy("system_id").agg(
        scalars.distinct_text(code).alias("codes"), scalars.distinct_text(F.when(~F.col("is_artifact"), code)).alias("proper_codes")
    )


@query(f"""with {INDEX}, k as (select distinct system_id, entry, weight, entry || '_' || biounit as uniqueness from index_rows)
    select system_id, uniqueness, weight from k qualify row_number() over (partition by uniqueness order by weight desc, system_id) = 1""")
def nonredundant(spark, sf):
    rows = index_of(spark, sf).select("system_id", "weight", F.concat_ws("_", F.col("entry").cast("string"), "biounit").alias("uniqueness")).distinct()
    return enrich.nonredundant(rows, uniqueness="uniqueness", order=[F.desc("weight"), "system_id"])


@query("""with r as (select l_partkey, l_suppkey, max(l_extendedprice / l_quantity) as score from lineitem group by all)
    select l_partkey, l_suppkey, round(score, 6) as score, row_number() over (partition by l_partkey order by round(score, 6) desc, l_suppkey) as rank
    from r qualify rank <= 3""")
def links_topn(spark, sf):
    rows = table(spark, sf, "lineitem").groupBy("l_partkey", "l_suppkey").agg(F.round(F.max(F.col("l_extendedprice") / F.col("l_quantity")), 6).alias("score"))
    return enrich.top_by(rows, ["l_partkey"], [F.desc("score"), "l_suppkey"], 3).withColumn("rank", F.col("rank").cast("long"))


@query("""select p_partkey, p_brand, dense_rank() over (order by p_brand) - 1 as brand_id from part""")
def dense_ids(spark, sf):
    return enrich.numbered(table(spark, sf, "part").select("p_partkey", "p_brand"), "p_brand", "brand_id")


@query("""select l_partkey,
        min(case when l_returnflag = 'R' and l_linestatus = 'F' then 'c' || l_suppkey % 7 end) as pli_qcov__50__strong__component,
        min(case when l_returnflag = 'N' and l_linestatus = 'O' then 'c' || l_suppkey % 7 end) as pli_qcov__50__weak__component,
        min(case when l_returnflag = 'A' then 'c' || l_suppkey % 7 end) as pli_qcov__70__community
    from lineitem where (l_returnflag = 'R' and l_linestatus = 'F') or (l_returnflag = 'N' and l_linestatus = 'O') or l_returnflag = 'A' group by 1""")
def cluster_pivot(spark, sf):
    lines = table(spark, sf, "lineitem")
    kind = F.col("l_returnflag")
    kept = ((kind == "R") & (F.col("l_linestatus") == "F")) | ((kind == "N") & (F.col("l_linestatus") == "O")) | (kind == "A")
    rows = lines.where(kept).select(
        F.col("l_partkey").alias("system_id"),
        F.concat(F.lit("c"), (F.col("l_suppkey") % 7).cast("string")).alias("label"),
        F.lit("pli_qcov").alias("metric"),
        F.when(kind == "A", "communities").otherwise("components").alias("cluster"),
        (kind == "R").alias("directed"),
        F.when(kind == "A", 70).otherwise(50).alias("threshold"),
    )
    names = [("pli_qcov", 50, "components", True), ("pli_qcov", 50, "components", False), ("pli_qcov", 70, "communities", False)]
    return enrich.cluster_pivot(rows, names).withColumnRenamed("system_id", "l_partkey")


# Similarity.


@query(f"with {EDGES} select * from edges where pli_qcov >= 50")
def pli_qcov_edges(spark, sf):
    return similarity.multiset_overlap_edges(items_of(spark, sf), key="system", item="item", min_score=50)


@query(f"""with {EDGES},
    a as (select query as q, target as t, pli_qcov as s from edges where query % 10 = 9 and target % 10 < 2
          union all select target, query, pli_qcov from edges where query % 10 < 2 and target % 10 = 9)
    select q as query, t as target, s as pli_qcov from a qualify row_number() over (partition by q order by s desc, t) = 1""")
def cross_similarity(spark, sf):
    systems = table(spark, sf, "orders").select("o_orderkey")
    queries, targets = systems.where("o_orderkey % 10 < 2"), systems.where("o_orderkey % 10 = 9")
    edges = edges_of(spark, sf, between=(queries, targets)).select("query", "target", "pli_qcov")
    return similarity.cross_similarity(edges, queries, targets, score="pli_qcov")


@query(f"""with {EDGES} select query, target, pli_qcov, pli_unique_qcov from edges where pli_qcov >= 60 and pli_unique_qcov >= 67""")
def multi_metric_search(spark, sf):
    names = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("similarity")) for m in ("pli_qcov", "pli_unique_qcov")])
    long = edges_of(spark, sf).select("query", "target", F.inline(names))
    return similarity.multi_metric(long, {"pli_qcov": 60, "pli_unique_qcov": 67})


@query("""with f as (select vec_id, unnest(embedding) as x, generate_subscripts(embedding, 1) as bit from embeddings),
    s as (select vec_id, bit from f where x > 0), n as (select vec_id, count(*) as n from s group by 1),
    p as (select a.vec_id as query, b.vec_id as target, count(*) as c from s a join s b using (bit)
          where a.vec_id % 20 = 0 and a.vec_id <> b.vec_id group by all)
    select query, target, cast(trunc(round_even(cast(c as double) / (qn.n + tn.n - c), 2) * 100) as integer) as similarity,
           row_number() over (partition by query order by cast(trunc(round_even(cast(c as double) / (qn.n + tn.n - c), 2) * 100) as integer) desc, target) as rank
    from p join n qn on qn.vec_id = query join n tn on tn.vec_id = target qualify rank <= 10""")
def tanimoto_topk(spark, sf):
    bits = similarity.bit_sets(table(spark, sf, "embeddings"), key="vec_id", vector="embedding")
    return similarity.tanimoto_top_k(bits, bits.where("key % 20 = 0"), k=10).withColumn("rank", F.col("rank").cast("long"))


@query("""with a as (select l_partkey, l_suppkey, max(l_discount) as s from lineitem where l_linestatus = 'F' group by all),
    b as (select l_partkey, l_suppkey, max(l_discount) as s from lineitem where l_linestatus = 'O' group by all)
    select l_partkey, l_suppkey, greatest(a.s, b.s) as s,
           case when a.s is null then 'second' when b.s is null then 'first' when abs(a.s - b.s) < 1e-6 then 'both' when a.s >= b.s then 'first' else 'second' end as source
    from a full join b using (l_partkey, l_suppkey)""")
def best_of_two(spark, sf):
    lines = table(spark, sf, "lineitem").groupBy("l_partkey", "l_suppkey", "l_linestatus").agg(F.max("l_discount").alias("s"))
    return similarity.combine_sources(lines.where("l_linestatus = 'F'"), lines.where("l_linestatus = 'O'"), keys=["l_partkey", "l_suppkey"], score="s", names=("first", "second"))


@query("""with p as (select l_orderkey, avg(l_discount) as discount, avg(l_tax) as tax from lineitem group by 1)
    select l_orderkey, 'discount' as metric, cast(round_even(discount * 100, 0) as integer) as similarity from p
    union all select l_orderkey, 'tax', cast(round_even(tax * 100, 0) as integer) from p""")
def score_melt(spark, sf):
    place = [F.col(f"_metadata.{c}").alias(c) for c in ("file_path", "row_index")]
    lines = table(spark, sf, "lineitem").select("l_orderkey", F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax"), *place)
    rows = similarity.means_in_order(lines, ["discount", "tax"], keys=["l_orderkey"], order=["file_path", "row_index"])
    return similarity.melt(rows, ["discount", "tax"], keys=["l_orderkey"])


@query("""with c as (select l_orderkey, l_suppkey, max(l_discount) as score, max(l_quantity) as length from lineitem group by all),
    s as (select l_orderkey, sum(length) as size from c group by 1)
    select l_orderkey, max(score) as score_max,
           arg_max(score, row(score * length, score)) as score_weighted_max, round(sum(score * length) / max(size), 9) as score_weighted_sum
    from c join s using (l_orderkey) group by 1""")
def chain_rollup(spark, sf):
    chains = table(spark, sf, "lineitem").groupBy("l_orderkey", "l_suppkey").agg(F.max("l_discount").alias("score"), F.max("l_quantity").alias("length"))
    size = chains.groupBy("l_orderkey").agg(F.sum("length").alias("size"))
    found = similarity.chain_rollup(chains.join(size, "l_orderkey"), keys=["l_orderkey"], score="score", length="length", size="size")
    return found.withColumn("score_weighted_sum", F.round("score_weighted_sum", 9))


@query()
def greedy_mapping(spark, sf):
    pairs = table(spark, sf, "lineitem").groupBy("l_orderkey", "l_suppkey", "l_partkey").agg(F.max("l_discount").alias("score"))
    return similarity.greedy_mapping(pairs, keys=["l_orderkey"], left="l_suppkey", right="l_partkey", score="score")


# Graphs.


@query(f"""with recursive {GRAPH},
    bi as (select src, dst from links union select dst, src from links),
    reach(node, c) as (select src, src from bi union select b.dst, r.c from reach r join bi b on b.src = r.node where r.c < b.dst)
    select node, min(c) as component from reach group by node""")
def components(spark, sf):
    return graph.connected_components(graph_of(spark, sf))


@query(f"""with recursive {GRAPH},
    reach(a, b) as (select src, dst from links union select r.a, l.dst from reach r join links l on l.src = r.b),
    nodes as (select src as node from links union select dst from links),
    strong as (select x.a as node, x.b as other from reach x join reach y on x.a = y.b and x.b = y.a)
    select node, least(node, coalesce(min(other), node)) as component from nodes left join strong using (node) group by node""")
def strong_components(spark, sf):
    return graph.strong_components(graph_of(spark, sf))


@query(f"""with recursive {GRAPH},
    bi as (select src, dst from links union select dst, src from links),
    reach(node, c) as (select src, src from bi union select b.dst, r.c from reach r join bi b on b.src = r.node where r.c < b.dst),
    comp as (select node, min(c) as c from reach group by node
             union all select o_orderkey, o_orderkey from orders where o_orderkey not in (select src from bi)),
    sz as (select c, count(*) as n, min(node) as low from comp group by c),
    name as (select c, n, 'c' || (row_number() over (order by n desc, low) - 1) as label from sz)
    select node, label, n as size from comp join name using (c)""")
def cluster_labels(spark, sf):
    systems = table(spark, sf, "orders").select("o_orderkey")
    return graph.ranked_labels(graph.connected_components(graph_of(spark, sf)), systems)


@query(f"""with {GRAPH}, bi as (select src, dst from links union select dst, src from links)
    select src as node, count(*) as degree from bi group by 1 having count(*) >= 2""")
def degree_filter(spark, sf):
    return graph.degrees(graph_of(spark, sf)).where("degree >= 2")


@query(f"""with {GRAPH}, bi as (select src, dst from links union select dst, src from links),
    one as (select distinct src as start, dst as node from bi where src % 50 = 0),
    two as (select distinct start, b.dst as node from one join bi b on b.src = one.node
            where b.dst <> start and (start, b.dst) not in (select start, node from one))
    select start, node, 1 as distance from one union all select start, node, 2 from two""")
def khop_neighbors(spark, sf):
    edges = graph_of(spark, sf)
    starts = edges.select("src").union(edges.select("dst")).where("src % 50 = 0")
    return graph.neighbours(edges, starts, 2)


@query()
def communities(spark, sf):
    return graph.communities(graph_of(spark, sf))


@query(f"""with recursive {GRAPH},
    bi as (select src, dst from links union select dst, src from links),
    reach(node, c) as (select src, src from bi union select b.dst, r.c from reach r join bi b on b.src = r.node where r.c < b.dst),
    comp as materialized (select node, min(c) as c from reach group by node),
    ends as (select x.c as cu, y.c as cv from bi join comp x on x.node = src join comp y on y.node = dst),
    sums as (select cu, count(*) as total, count(*) filter (cu = cv) as inside from ends group by 1)
    select round(sum(cast(inside as double) / m - power(cast(total as double) / m, 2)), 9) as modularity from sums, (select sum(total) as m from sums)""")
def component_modularity(spark, sf):
    edges = graph_of(spark, sf)
    labels = graph.connected_components(edges).withColumnRenamed("component", "community")
    return graph.modularity(edges, labels).select(F.round("modularity", 9).alias("modularity"))


# Splits and leakage.


@query(f"""with {EDGES}, {SPLITS}, s as (select system_id as id, split from splits),
    a as (select query as q, target as t, pli_qcov as p from edges join s x on x.id = query join s y on y.id = target where x.split = 'test' and y.split = 'train'
          union all select target, query, pli_qcov from edges join s x on x.id = query join s y on y.id = target where x.split = 'train' and y.split = 'test')
    select q as query, t as target, p as pli_qcov from a qualify row_number() over (partition by q order by p desc, t) = 1""")
def leakage_max(spark, sf):
    names = splits_of(spark, sf).withColumnRenamed("system_id", "system")
    sides = tuple(names.where(F.col("split") == s).select("system") for s in ("train", "test"))
    return split.max_leakage(edges_of(spark, sf, between=sides).select("query", "target", "pli_qcov"), names, "train", "test", score="pli_qcov")


def systems_of(spark: SparkSession, sf: str) -> DataFrame:
    """Systems with what a split needs."""
    orders = table(spark, sf, "orders")
    return orders.select(
        F.col("o_orderkey").alias("system"),
        F.col("o_custkey").alias("entry"),
        F.col("o_orderpriority").alias("code"),
        (F.col("o_custkey") % 200).alias("cluster"),
        (F.col("o_custkey") % 97).alias("val_cluster"),
        (F.col("o_orderstatus") != "P").alias("passes_quality"),
        F.col("o_totalprice").alias("price"),
        F.concat_ws("_", F.col("o_custkey").cast("string"), F.col("o_orderkey").cast("string")).alias("uniqueness"),
    )


RULES = split.SplitRules(
    min_test_cluster=5, leakage=(3, 5000), num_test=200, min_val_cluster=5, num_val=200, ranges={"price": (1000, 300_000)}, criteria=(), weights={"leakage_count": -1.0}
)

SYSTEMS = """systems as (
    select o_orderkey as system, o_custkey as entry, o_orderpriority as code, o_custkey % 200 as cluster, o_orderstatus <> 'P' as passes_quality,
           o_totalprice as price from orders),
    sized as (select *, count(*) over (partition by cluster) as cluster_size from systems),
    tests as (select * from sized where passes_quality and price between 1000 and 300000 and cluster_size >= 5),
    leaks as (select t.system, s.system as leaked from tests t join systems s using (cluster) where t.system <> s.system
              union select t.system, s.system from tests t join systems s using (entry) where t.system <> s.system
              union select src, dst from links where src in (select system from tests)
              union select dst, src from links where dst in (select system from tests))"""


@query(f"with {GRAPH}, {SYSTEMS} select system, count(*) as leakage_count from leaks group by 1 having count(*) between 3 and 5000")
def leakage_counts(spark, sf):
    systems = split.prepare(systems_of(spark, sf), RULES)
    return split.leakage_counts(systems.where("proto_test"), systems, [graph_of(spark, sf)], 1).where("leakage_count between 3 and 5000")


@query(f"""with {GRAPH}, {SYSTEMS}, n as (select system, count(*) as leakage_count from leaks group by 1 having count(*) between 3 and 5000),
    r as (select t.system, entry, code, cluster, -leakage_count as score from tests t join n using (system)),
    c as (select *, max(score) over (partition by cluster) as cluster_score from r),
    e as (select * from c qualify row_number() over (partition by entry, code order by score desc, system) <= 1),
    k as (select * from e qualify row_number() over (partition by cluster order by score desc, system) <= 2)
    select system, cluster, cast(score as double) as score, row_number() over (order by cluster_score desc, cluster, score desc, system) as place from k""")
def test_priority(spark, sf):
    systems = split.prepare(systems_of(spark, sf), RULES)
    leaks = split.leakage_counts(systems.where("proto_test"), systems, [graph_of(spark, sf)], 1)
    return split.prioritised(systems, leaks, RULES).select("system", "cluster", "score", F.col("place").cast("long").alias("place"))


PRIORITY = """n as (select system, count(*) as leakage_count from leaks group by 1 having count(*) between 3 and 5000),
    r as (select t.system, entry, code, cluster, -leakage_count as score from tests t join n using (system)),
    c as (select *, max(score) over (partition by cluster) as cluster_score from r),
    e as (select * from c qualify row_number() over (partition by entry, code order by score desc, system) <= 1),
    k as (select * from e qualify row_number() over (partition by cluster order by score desc, system) <= 2),
    places as (select *, row_number() over (order by cluster_score desc, cluster, score desc, system) as place from k)"""


@query(f"""with {GRAPH}, {SYSTEMS}, {PRIORITY},
    firsts as (select l.leaked, min(p.place) as place from leaks l join places p using (system) where p.place <= 200 group by 1),
    sums as (select p.place, sum(coalesce(f.k, 0)) over (order by p.place) as removed
             from places p left join (select place, count(*) as k from firsts group by 1) f using (place) where p.place <= 200),
    cut as (select min(place) as last_place from sums where removed > cast(floor(0.2 * (select count(*) from systems)) as bigint)),
    test as (select system from places, cut where place <= coalesce(last_place, 200)
             union select p.system from places p, cut where last_place is not null and p.place > last_place
                   and p.cluster in (select q.cluster from places q where q.place <= last_place)),
    gone as (select distinct leaked as system from leaks where system in (select system from test)),
    marked as (select o_orderkey as system, o_custkey as entry, o_custkey % 97 as val_cluster, o_orderstatus <> 'P' as q, o_totalprice between 1000 and 300000 as s,
                      case when o_orderkey in (select system from test) then 'test' when o_orderkey in (select system from gone) then 'removed' else 'train' end as split
               from orders),
    vc as (select val_cluster, count(*) as n, least(count(*), 3) as k from marked where split = 'train' group by 1 having count(*) >= 5 and bool_or(q) and bool_or(s)),
    vs as (select val_cluster from (select *, sum(k) over (order by n, val_cluster) as until from vc) where until - k < 200),
    val as (select system, entry, val_cluster from marked where split = 'train' and val_cluster in (select val_cluster from vs)
            qualify row_number() over (partition by val_cluster order by 2 * cast(q as int) + cast(s as int) desc, system) <= 3)
    select system, case when split <> 'train' then split when system in (select system from val) then 'val'
                        when val_cluster in (select val_cluster from val) or entry in (select entry from val) then 'removed' else 'train' end as split
    from marked""")
def split_assignment(spark, sf):
    return split.assign(split.prepare(systems_of(spark, sf), RULES), [graph_of(spark, sf)], RULES).select("system", "split")


# Evaluation.


def poses_of(spark: SparkSession, sf: str) -> DataFrame:
    """Ranked poses: of each user the first five events, their value as RMSD."""
    events = table(spark, sf, "events").select("user_id", "event_id", "ts", "value", "event_type")
    ranked = enrich.top_by(events, ["user_id"], ["ts", "event_id"], 5)
    return ranked.select("user_id", "rank", F.round(F.col("value") / 20, 4).alias("rmsd"), F.round(1 - F.col("value") / 200, 4).alias("lddt"))


POSES = """poses as (
    select user_id, rank, round(value / 20, 4) as rmsd, round(1 - value / 200, 4) as lddt
    from (select *, row_number() over (partition by user_id order by ts, event_id) as rank from events) where rank <= 5)"""


@query(f"""with {POSES}, w as (select max(rmsd) as worst from poses),
    f as (select user_id, rank, coalesce(rmsd, worst) as rmsd, coalesce(lddt, 0) as lddt, coalesce(rmsd, worst) <= 2 as success from poses, w),
    b as (select * from f where rank <= 5 qualify row_number() over (partition by user_id order by rmsd, rank) = 1),
    s as (select 'all' as subset, * from b union all select 'even', * from b where user_id % 2 = 0 union all select 'good', * from b where lddt > 0.9)
    select subset, count(distinct user_id) as n_systems, round(100.0 * count(distinct case when success then user_id end) / count(distinct user_id), 9) as success_rate,
           round(median(rmsd), 9) as median_rmsd, round(stddev_pop(rmsd), 4) as stdev_rmsd, round(median(lddt), 9) as median_lddt, round(stddev_pop(lddt), 4) as stdev_lddt
    from s group by 1""")
def results_table(spark, sf):
    poses = poses_of(spark, sf)
    rows = evaluate.evaluated(poses, poses.select("user_id").distinct(), key="user_id")
    best = evaluate.best_pose(rows, key="user_id", rank="rank", rmsd="rmsd", top_n=5)
    subsets = {"all": F.lit(True), "even": F.col("user_id") % 2 == 0, "good": F.col("lddt") > 0.9}
    found = evaluate.results_table(best, subsets, key="user_id")
    digits = {"success_rate": 9, "median_rmsd": 9, "stdev_rmsd": 4, "median_lddt": 9, "stdev_lddt": 4}
    return found.select("subset", "n_systems", *[F.round(c, d).alias(c) for c, d in digits.items()])


@query("""with c as (select unnest(range(0, 11)) / 10.0 * 50 as cut), r as (select l_quantity as s, cast(l_discount <= 0.05 as int) as ok from lineitem)
    select cast(cut as double) as cut, count(*) filter (s <= cut) as n_below,
           round(cast(coalesce(sum(ok) filter (s <= cut), 0) as double) / greatest(count(*) filter (s <= cut), 1), 9) as success_below,
           round(cast(coalesce(sum(ok) filter (s > cut), 0) as double) / greatest(count(*) filter (s > cut), 1), 9) as success_above,
           round(cast(count(*) filter (s > cut) as double) / count(*), 9) as leaked_share
    from r, c group by cut""")
def perf_curve(spark, sf):
    rows = table(spark, sf, "lineitem").select(F.col("l_quantity").alias("s"), (F.col("l_discount") <= 0.05).alias("success"))
    found = evaluate.curve(rows, similarity="s", cuts=[5.0 * k for k in range(11)])
    return found.select("cut", "n_below", *[F.round(c, 9).alias(c) for c in ("success_below", "success_above", "leaked_share")])


@query("""with m as (select o_custkey, max(o_totalprice) / 5000 as protein, min(o_totalprice) / 2000 as ligand from orders group by 1),
    t as (select c_custkey, coalesce(protein, 0) as protein, coalesce(ligand, 0) as ligand from customer left join m on c_custkey = o_custkey)
    select *, protein < 50 as novel_protein, ligand < 30 as novel_ligand, protein < 50 and ligand < 30 as novel_all,
           not (protein < 50) and not (ligand < 30) and not (protein < 50 and ligand < 30) as not_novel from t""")
def stratify_novel(spark, sf):
    orders, systems = table(spark, sf, "orders"), table(spark, sf, "customer")
    parts = {
        "protein": orders.groupBy("o_custkey").agg((F.max("o_totalprice") / 5000).alias("v")),
        "ligand": orders.groupBy("o_custkey").agg((F.min("o_totalprice") / 2000).alias("v")),
    }
    wide = evaluate.max_similarity_table(parts, systems, key="c_custkey")
    return evaluate.stratify(wide, {"novel_protein": {"protein": 50}, "novel_ligand": {"ligand": 30}, "novel_all": {"protein": 50, "ligand": 30}})


@query("""select event_type, count(*) as n, round(avg(value), 6) as value_mean, round(sum(value * user_id) / sum(case when value is not null then user_id end), 6) as value_weighted
    from events group by 1""")
def weighted_means(spark, sf):
    rows = table(spark, sf, "events")
    found = evaluate.weighted(rows, ["event_type"], "value", "user_id").join(rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")), "event_type")
    return found.select("event_type", "n", F.round("value_mean", 6).alias("value_mean"), F.round("value_weighted", 6).alias("value_weighted"))


# Series, ingest, spatial, reports.


@query("""with p as (select distinct a.l_suppkey as constant, least(a.l_partkey, b.l_partkey) as id1, greatest(a.l_partkey, b.l_partkey) as id2
                     from lineitem a join lineitem b on a.l_orderkey = b.l_orderkey and a.l_suppkey = b.l_suppkey and a.l_partkey < b.l_partkey),
    k as (select p_partkey as id, p_brand as pocket from part),
    b as (select constant, x.pocket, id1, id2 from p join k x on x.id = id1 join k y on y.id = id2 and x.pocket = y.pocket),
    m as (select constant, pocket, id1 as member from b union select constant, pocket, id2 from b)
    select constant, pocket, string_agg(cast(member as varchar), ',' order by member) as members, count(*) as n_members from m group by 1, 2 having count(*) >= 2""")
def matched_series(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", F.col("l_suppkey").alias("constant"), "l_partkey")
    other = lines.withColumnRenamed("l_partkey", "id2")
    pairs = lines.withColumnRenamed("l_partkey", "id1").join(other, ["l_orderkey", "constant"]).where("id1 < id2").select("constant", "id1", "id2").distinct()
    pockets = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("pocket"))
    return series.matched_series(pairs, pockets).withColumn("members", F.array_join(F.col("members").cast("array<string>"), ","))


@query("""with r as (select l_orderkey, l_linenumber, case when l_linenumber % 5 = 0 then 'x' else chr(cast(65 + l_suppkey % 26 as int)) || ':' || (l_linenumber - 3) || '-' || l_quantity::int end as text
                     from lineitem)
    select distinct text, case when text = 'x' then '.' else split_part(text, ':', 1) end as chain,
           case when text = 'x' then '0' else regexp_extract(text, ':(-?[0-9]+)-', 1) end as "start",
           case when text = 'x' then '0' else regexp_extract(text, ':-?[0-9]+-([0-9]+)', 1) end as "end" from r""")
def range_parse(spark, sf):
    text = F.expr("case when l_linenumber % 5 = 0 then 'x' else concat(char(65 + l_suppkey % 26), ':', l_linenumber - 3, '-', cast(l_quantity as int)) end")
    return table(spark, sf, "lineitem").select(text.alias("text")).distinct().select("text", scalars.parse_range(F.col("text")).alias("r")).select("text", "r.*")


@query("""with u as (select l_partkey, l_quantity - 1 as v, case l_linenumber % 7 when 0 then 'fM' when 1 then 'pM' when 2 then 'nM' when 3 then 'uM' when 4 then 'mM' when 5 then 'M' else 'Ka' end as unit
                     from lineitem),
    p as (select l_partkey, case when v > 0 then -log10(v * case unit when 'fM' then 1e-15 when 'pM' then 1e-12 when 'nM' then 1e-9 when 'uM' then 1e-6 when 'mM' then 1e-3 when 'M' then 1.0 end) end as p from u)
    select l_partkey, round(median(p), 6) as p from p where p is not null group by 1""")
def unit_scale(spark, sf):
    unit = F.expr("element_at(array('fM', 'pM', 'nM', 'uM', 'mM', 'M', 'Ka'), cast(l_linenumber % 7 + 1 as int))")
    rows = table(spark, sf, "lineitem").select("l_partkey", scalars.p_affinity(F.col("l_quantity") - 1, unit).alias("p")).where("p is not null")
    return rows.groupBy("l_partkey").agg(F.round(F.median("p"), 6).alias("p"))


@query("""select event_id, cast(json_extract_string(props, '$.k') as integer) as k, len(json_keys(props)) as n_keys from events""")
def json_props(spark, sf):
    document = F.from_json("props", "struct<k: int>")
    return table(spark, sf, "events").select("event_id", document["k"].alias("k"), F.size(F.json_object_keys("props")).cast("long").alias("n_keys"))


@query("""with f as (select user_id, ts, event_id, case when event_type = 'click' then event_id end as seen from events)
    select event_id, last_value(seen ignore nulls) over (partition by user_id order by ts, event_id rows unbounded preceding) as last_click from f""")
def fill_forward(spark, sf):
    above = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    seen = F.when(F.col("event_type") == "click", F.col("event_id"))
    return table(spark, sf, "events").select("event_id", F.last(seen, ignorenulls=True).over(above).alias("last_click"))


@query("""select p_partkey, p_size < 15 and p_retailprice < 1500 as fragment, (p_size < 15 and p_retailprice < 1500) or (p_size < 25 and p_retailprice < 2500) as lipinski,
           case when p_type like '%ALL' then 'ion' when p_type like 'PROMO%' then 'artifact' when p_type like 'ECONOMY%' then 'cofactor' else 'other' end as kind
    from part""")
def code_classify(spark, sf):
    size, price, kind = F.col("p_size"), F.col("p_retailprice"), F.col("p_type")
    three, five = scalars.rule_class(size * 20, price / 500, F.when(size < 25, 1).otherwise(9), F.lit(1))
    label = scalars.first_true([(kind.endswith("ALL"), "ion"), (kind.startswith("PROMO"), "artifact"), (kind.startswith("ECONOMY"), "cofactor")], "other")
    return table(spark, sf, "part").select("p_partkey", three.alias("fragment"), five.alias("lipinski"), label.alias("kind"))


@query("""with b as (select p_brand, list(distinct p_type || ':' || p_size) as codes from part group by 1),
    u as (select p_brand, unnest(codes) as code from b)
    select p_brand, string_agg(code, ',' order by -length(code), case when code ~ '^[0-9]' then 1 else 0 end, code) as codes from u group by 1""")
def sort_codes(spark, sf):
    rows = table(spark, sf, "part").groupBy("p_brand").agg(F.collect_set(F.concat("p_type", F.lit(":"), F.col("p_size").cast("string"))).alias("codes"))
    return rows.select("p_brand", F.array_join(scalars.code_order(F.col("codes")), ",").alias("codes"))


@query("""with r as (select s_suppkey as range_id, s_suppkey % 25 as label, s_suppkey * 150 - 100 as a, s_suppkey * 150 - 60 + s_suppkey % 60 as b from supplier)
    select label, count(*) as n_points, count(distinct o_orderkey) as n_systems
    from orders join r on o_orderkey >= a and o_orderkey < b group by 1""")
def interval_overlap(spark, sf):
    s = F.col("s_suppkey")
    ranges = table(spark, sf, "supplier").select(s.alias("range_id"), (s % 25).alias("label"), (s * 150 - 100).alias("a"), (s * 150 - 60 + s % 60).alias("b"))
    held = spatial.interval_join(table(spark, sf, "orders").select("o_orderkey"), ranges, at="o_orderkey", start="a", end="b", width=64)
    return held.groupBy("label").agg(F.count(F.lit(1)).alias("n_points"), F.count_distinct("o_orderkey").alias("n_systems"))


@query("""with d as (select distinct o_custkey, o_orderkey from orders)
    select o_custkey, lag(o_orderkey) over (partition by o_custkey order by o_orderkey) as gap_from, o_orderkey as gap_to from d
    qualify gap_to - gap_from > 1""")
def gap_detect(spark, sf):
    return spatial.gaps(table(spark, sf, "orders").select("o_custkey", "o_orderkey"), by=["o_custkey"], at="o_orderkey")


@query("""with p as (select vec_id, label, cast(embedding[1] as double) as x, cast(embedding[2] as double) as y, cast(embedding[3] as double) as z from embeddings)
    select a.vec_id as l_id, b.vec_id as r_id from p a join p b on a.vec_id < b.vec_id
    where sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z)) <= 0.05""")
def radius_join(spark, sf):
    points = table(spark, sf, "embeddings").select("vec_id", *[F.col("embedding")[k].cast("double").alias(x) for k, x in enumerate("xyz")])
    near = spatial.radius_join(points, points, 0.05).where("l_vec_id < r_vec_id")
    return near.select(F.col("l_vec_id").alias("l_id"), F.col("r_vec_id").alias("r_id"))


@query("""with g as (select l_orderkey, max(cast(l_returnflag = 'A' as int)) as a, max(cast(l_returnflag = 'N' as int)) as n, max(cast(l_returnflag = 'R' as int)) as r from lineitem group by 1)
    select a || '' || n || '' || r as region, count(*) as n from g group by 1""")
def venn_regions(spark, sf):
    return enrich.venn(table(spark, sf, "lineitem"), "l_orderkey", "l_returnflag", ["A", "N", "R"])


@query("""with c as (select l_extendedprice as v, sum(cast(l_returnflag = 'R' as int)) as a, sum(cast(l_returnflag = 'N' as int)) as b from lineitem where l_returnflag in ('R', 'N') group by 1),
    s as (select sum(a) over w as a, sum(b) over w as b, sum(a) over () as na, sum(b) over () as nb from c window w as (order by v))
    select max(abs(cast(a as double) / na - cast(b as double) / nb)) as statistic, cast(max(na) as bigint) as n_first, cast(max(nb) as bigint) as n_second from s""")
def ks_stat(spark, sf):
    return enrich.ks_statistic(table(spark, sf, "lineitem"), "l_extendedprice", "l_returnflag", "R", "N")


@query("""with c as (select o_orderstatus, o_orderpriority, count(*) as n from orders group by all)
    select o_orderstatus, o_orderpriority, n, cast(n as double) / sum(n) over (partition by o_orderstatus) as share from c""")
def value_shares(spark, sf):
    return evaluate.shares(table(spark, sf, "orders"), ["o_orderstatus"], "o_orderpriority")


@query(f"""with {INDEX} select biounit, count(*) as n, count(distinct code) as codes, count(distinct chain) as chains,
           count(*) filter (is_artifact and is_cofactor) as both, count(*) filter (not is_artifact and not is_cofactor) as neither,
           round(100 * avg(cast(is_artifact as int)), 6) as artifact_percent
    from index_rows group by 1""")
def flag_report(spark, sf):
    a, c = F.col("is_artifact"), F.col("is_cofactor")
    return index_of(spark, sf).groupBy("biounit").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("code").alias("codes"),
        F.count_distinct("chain").alias("chains"),
        F.count_if(a & c).alias("both"),
        F.count_if(~a & ~c).alias("neither"),
        F.round(100 * F.avg(a.cast("int")), 6).alias("artifact_percent"),
    )


@query("""select 'orders' as source, o_custkey as id from orders group by 2 union all select 'customers', c_custkey from customer where c_acctbal < 0""")
def union_sources(spark, sf):
    orders = table(spark, sf, "orders").select(F.lit("orders").alias("source"), F.col("o_custkey").alias("id")).distinct()
    return union_all([orders, table(spark, sf, "customer").where("c_acctbal < 0").select(F.lit("customers").alias("source"), F.col("c_custkey").alias("id"))])


@query("""with m as (select l_orderkey, l_shipdate from lineitem),
    s as (select l_orderkey, max(l_shipdate) as last from m group by 1)
    select date_trunc('month', last) as month, count(*) as n from s group by 1""")
def release_months(spark, sf):
    last = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("last"))
    return last.groupBy(F.date_trunc("month", "last").alias("month")).agg(F.count(F.lit(1)).alias("n"))


# Annotation: an entry is a customer, a system an order, a ligand a line with its supplier as protein chain.


def entries_of(spark: SparkSession, sf: str) -> DataFrame:
    """Entry documents, read from the JSON text that the tables are put into."""
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey",
        F.struct(
            F.lit(1).alias("instance"),
            F.concat(F.lit("L"), F.col("l_partkey").cast("string")).alias("asym_id"),
            F.col("l_partkey").cast("string").alias("ccd_code"),
            F.col("l_quantity").cast("double").alias("molecular_weight"),
            F.when(F.col("l_discount") < 0.095, F.col("l_linenumber").cast("int")).alias("num_heavy_atoms"),
            (F.col("l_returnflag") == "R").alias("is_ion"),
            (F.col("l_returnflag") == "A").alias("is_artifact"),
            F.array(F.concat(F.lit("1.S"), F.col("l_suppkey").cast("string"))).alias("protein_chains"),
        ).alias("ligand"),
    )
    systems = lines.groupBy("l_orderkey").agg(F.collect_list("ligand").alias("ligands"))
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey").join(systems, F.col("o_orderkey") == F.col("l_orderkey"))
    of_entry = F.collect_list(F.struct(F.col("o_orderkey").cast("string").alias("biounit_id"), "ligands"))
    documents = orders.groupBy("o_custkey").agg(of_entry.alias("systems"))
    text = F.to_json(F.struct(F.col("o_custkey").cast("string").alias("pdb_id"), "systems"))
    return documents.select(annotate.parsed(text).alias("entry"))


@query("""select cast(l_orderkey as varchar) as system_biounit_id,
           case when bool_or(l_returnflag = 'N') then 'holo' when bool_or(l_returnflag = 'R') then 'ion' else 'artifact' end as system_type,
           count(distinct l_suppkey) as system_num_protein_chains, count(*) as system_num_ligand_chains,
           count(*) filter (l_returnflag = 'N') as system_proper_num_ligand_chains,
           case when count(*) = count(*) filter (l_discount < 0.095) then cast(sum(l_linenumber) as bigint) end as system_num_heavy_atoms,
           coalesce(max(l_quantity) filter (l_returnflag = 'N'), -1.0) as system_proper_ligand_max_molecular_weight
    from lineitem join orders on o_orderkey = l_orderkey group by l_orderkey""")
def entry_systems(spark, sf):
    found = annotate.systems(entries_of(spark, sf))
    return found.select(
        "system_biounit_id", "system_type", *[F.col(c).cast("long").alias(c) for c in ("system_num_protein_chains", "system_num_ligand_chains", "system_proper_num_ligand_chains")],
        "system_num_heavy_atoms", "system_proper_ligand_max_molecular_weight",
    )


@query("""with s as (select o_custkey, l_orderkey from lineitem join orders on o_orderkey = l_orderkey group by all
                   having bool_or(l_returnflag = 'N') and count(distinct l_suppkey) <= 5 and count(*) <= 5)
    select cast(c.o_custkey as varchar) as entry, count(s.l_orderkey) as n_systems
    from (select distinct o_custkey from orders join lineitem on o_orderkey = l_orderkey) c left join s using (o_custkey) group by c.o_custkey""")
def entry_prune(spark, sf):
    kept = annotate.pruned(entries_of(spark, sf))
    return kept.select(F.col("entry.pdb_id").alias("entry"), F.size("entry.systems").cast("long").alias("n_systems"))


@query("""select l_suppkey, count(*) as num_residues, count(*) filter (l_linestatus = 'F') as num_processed_residues,
           round(avg(l_discount) filter (l_linestatus = 'F'), 9) as average_rsr,
           round(100.0 * count(*) filter (l_linestatus = 'F' and l_discount <= 0.03) / count(*), 9) as percent_rsr_under_threshold,
           round(100.0 * count(*) filter (l_linestatus = 'F' and l_returnflag = 'R') / count(*), 9) as percent_outliers_clashes,
           cast(max(l_linenumber) filter (l_linestatus = 'F') as bigint) as max_alt_count
    from lineitem group by 1 having count(*) filter (l_linestatus = 'F') > 0""")
def residue_validation(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        "l_suppkey",
        (F.col("l_linestatus") == "F").alias("processed"),
        F.col("l_discount").alias("rsr"),
        *[F.lit(1.0).alias(c) for c in ("rsrz", "rscc", "average_occupancy", "average_b_factor")],
        F.col("l_linenumber").alias("alt_count"),
        *[F.lit(1).alias(c) for c in ("atom_count", "heavy_atom_count", "num_unresolved_heavy_atoms")],
        F.lit(False).alias("unknown_residue"),
        F.when(F.col("l_returnflag") == "R", F.array(F.lit("clashes"))).otherwise(F.array().cast("array<string>")).alias("outliers"),
    )
    found = annotate.residue_summary(rows, ["l_suppkey"], max_rsr=0.03)
    return found.select(
        "l_suppkey", "num_residues", "num_processed_residues", *[F.round(c, 9).alias(c) for c in ("average_rsr", "percent_rsr_under_threshold", "percent_outliers_clashes")],
        F.col("max_alt_count").cast("long").alias("max_alt_count"),
    )


@query("""with p as (select o_orderkey, o_custkey as c, o_orderkey % 97 as a from orders),
    d as (select s_suppkey as domain, s_suppkey % 7 as label, s_suppkey * 3 % 1000 as c0, s_suppkey * 3 % 1000 + 20 as c1, s_suppkey % 97 as a from supplier),
    n as (select a, domain, label, count(distinct c) as n from p join d using (a) where c >= c0 and c < c1 group by all)
    select a, domain, label, n from n qualify row_number() over (partition by a order by n desc, domain) = 1""")
def pocket_domains(spark, sf):
    chain = F.col("o_orderkey") % 97
    pockets = table(spark, sf, "orders").select(chain.alias("system_id"), F.lit("e").alias("pdb_id"), chain.alias("asym_id"), F.col("o_custkey").alias("residue"))
    s = F.col("s_suppkey")
    ranges = table(spark, sf, "supplier").select(F.lit("e").alias("pdb_id"), (s % 97).alias("asym_id"), s.alias("domain"), (s % 7).alias("label"), (s * 3 % 1000).alias("start"), (s * 3 % 1000 + 20).alias("end"))
    return annotate.pocket_domains(pockets, ranges, width=32).withColumnRenamed("system_id", "a")


# Ligands: a part is a ligand, its type and size its structure.


@query("""with c as (select cast(p_partkey as varchar) as code, p_type || p_size as smiles from part),
    g as (select smiles, list(code) as codes from c group by 1 having count(*) > 1)
    select unnest(codes) as code, (select arg_min(x, row(x ~ '^[0-9]', -length(x), x)) from (select unnest(g.codes) as x)) as unique_code from g""")
def synonym_groups(spark, sf):
    codes = table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("code"), F.concat("p_type", F.col("p_size").cast("string")).alias("smiles"))
    return ligands.synonyms(codes)


@query("""with s as (select l_orderkey as q, l_partkey as t, max(cast(round(l_discount * 1000) as int)) as m from lineitem where l_linenumber = 1 group by all),
    a as (select t as k, q as other, m from s where q % 3 = 0 and t % 2 = 1 union all select q, t, m from s where q % 2 = 1 and t % 3 = 0),
    b as (select k, max(m) as m from a group by 1)
    select system_id, max(m) as m from b join (select distinct p_brand as system_id, p_partkey as k from part) using (k) group by 1""")
def ligand_similarity_max(spark, sf):
    rows = table(spark, sf, "lineitem").where("l_linenumber = 1").groupBy(F.col("l_orderkey").alias("query_ligand_id"), F.col("l_partkey").alias("target_ligand_id"))
    scores = rows.agg(F.max(F.round(F.col("l_discount") * 1000).cast("int")).alias("m"))
    ids = scores.select(F.col("query_ligand_id").alias("id")).union(scores.select("target_ligand_id")).distinct()
    systems = table(spark, sf, "part").select(F.col("p_brand").alias("system_id"), F.col("p_partkey").alias("number_id_by_inchikeys"))
    return ligands.cross_similarity(scores, ids.where("id % 3 = 0"), ids.where("id % 2 = 1"), systems, metric="m")


@query("""with p as (select l_partkey as a, l_suppkey as b, l_quantity as size1, l_quantity + 10 as size2, l_linenumber + 4 as c from lineitem where l_linenumber + 4 >= 5),
    e as (select a as key, b as other, 100.0 * c / size1 as s from p union all select b, a, 100.0 * c / size2 from p),
    m as (select key, other, max(s) as s from e group by all),
    l as (select o_orderkey as system_id, o_custkey as k, case when o_orderkey % 5 = 0 then 'test' else 'train' end as split from orders),
    known as (select distinct k as other from l where split = 'train'),
    best as (select key, max(s) as s from m join known using (other) group by 1)
    select distinct l.system_id, l.k as inchikey, round(case when l.k in (select other from known) then 100.0 else coalesce(best.s, 0.0) end, 9) as mmp_similarity_max
    from l left join best on best.key = l.k where l.split = 'test'""")
def mmp_similarity(spark, sf):
    pairs = table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("inchikey1"), F.col("l_suppkey").alias("inchikey2"), F.col("l_quantity").alias("size1"), (F.col("l_quantity") + 10).alias("size2"), (F.col("l_linenumber") + 4).alias("constant_size")
    )
    rows = table(spark, sf, "orders").select(F.col("o_orderkey").alias("system_id"), F.col("o_custkey").alias("inchikey"), F.when(F.col("o_orderkey") % 5 == 0, "test").otherwise("train").alias("split"))
    found = ligands.max_pair_similarity(rows, ligands.pair_similarity(pairs))
    return found.select("system_id", "inchikey", F.round("mmp_similarity_max", 9).alias("mmp_similarity_max"))


# Links and reports.


@query("""with s as (select lpad(cast(l_partkey as varchar), 6, '0') as q, lpad(cast(l_suppkey as varchar), 6, '0') || '_A' as t,
                    cast(max(l_quantity) filter (l_returnflag = 'R') as int) as m, cast(max(l_quantity) filter (l_returnflag = 'N') as int) as n from lineitem group by all),
    k as (select s.*, s_acctbal as sort_score from s join supplier on lpad(cast(s_suppkey as varchar), 6, '0') = split_part(t, '_', 1)
          where m >= 20 and n >= 10 and left(q, 4) <> left(t, 4))
    select q as reference_system_id, t as id, m, n, sort_score, row_number() over (partition by q order by sort_score, t) as rank from k qualify rank <= 5""")
def link_selection(spark, sf):
    pad = lambda c: F.lpad(F.col(c).cast("string"), 6, "0")
    lines = table(spark, sf, "lineitem").where("l_returnflag in ('R', 'N')")
    scores = lines.select(
        pad("l_partkey").alias("query_system"), F.concat(pad("l_suppkey"), F.lit("_A")).alias("target_system"),
        F.when(F.col("l_returnflag") == "R", "m").otherwise("n").alias("metric"), F.col("l_quantity").cast("int").alias("similarity"),
    )
    ranking = table(spark, sf, "supplier").select(pad("s_suppkey").alias("target_id"), F.col("s_acctbal").alias("sort_score"))
    return similarity.select_links(scores, {"m": 20, "n": 10}, ranking).withColumn("rank", F.col("rank").cast("long"))


@query(f"""with {POSES}, b as (select * from poses qualify row_number() over (partition by user_id order by rmsd, rank) = 1),
    r as (select user_id % 101 as sim, rmsd <= 2 as ok, rmsd, user_id % 17 as lddt from b), c as (select unnest(range(0, 11)) * 10.0 as cutoff),
    t as (select count(*) as n, avg(cast(ok as int)) as ok, avg(rmsd) as rmsd, avg(lddt) as lddt from r),
    g as (select cutoff, count(*) filter (sim >= 100 - cutoff) as k, sum(cast(ok as int)) filter (sim >= 100 - cutoff) as ok, sum(rmsd) filter (sim >= 100 - cutoff) as rmsd,
                 sum(lddt) filter (sim >= 100 - cutoff) as lddt from r, c group by cutoff)
    select cast(cutoff as double) as cutoff, analysis, round(mean, 9) as mean from (
        select cutoff, unnest(['S', 'XS', 'delta_RMSD', 'delta_lDDT_PLI', 'CDF']) as analysis,
               unnest([coalesce(g.ok, 0) / greatest(k, 1), coalesce(g.ok, 0) / greatest(k, 1) - t.ok, coalesce(g.rmsd, 0) / greatest(k, 1) - t.rmsd,
                       t.lddt - coalesce(g.lddt, 0) / greatest(k, 1), cast(k as double) / n]) as mean from g, t)""")
def performance_trends(spark, sf):
    best = evaluate.best_pose(poses_of(spark, sf), key="user_id", rank="rank", rmsd="rmsd", top_n=5)
    rows = best.select((F.col("user_id") % 101).cast("double").alias("sim"), (F.col("rmsd") <= 2).alias("success"), "rmsd", (F.col("user_id") % 17).cast("double").alias("lddt"))
    found = evaluate.trends(rows, ["sim"]).where("analysis <> 'EF'")
    return found.select("cutoff", "analysis", F.round("mean", 9).alias("mean"))


@query("""select p_brand as split, count(distinct p_type) as n, 'p_type' as "column" from part group by 1
    union all select p_brand, count(distinct p_size), 'p_size' from part group by 1""")
def diversity_report(spark, sf):
    return evaluate.diversity(table(spark, sf, "part"), ["p_type", "p_size"], by="p_brand").withColumnRenamed("p_brand", "split")


@query("""with g as (select l_orderkey, any_value(o_orderpriority) as split, count(distinct l_suppkey) as p, count(distinct l_partkey) as x from lineitem join orders on o_orderkey = l_orderkey group by 1)
    select split, count(*) filter (p = 1 and x = 1) as single_single, count(*) filter (p = 1 and x > 1) as single_multiple, count(*) filter (p > 1 and x = 1) as multiple_single,
           count(*) filter (p > 1 and x > 1) as multiple_multiple, count(*) as total from g group by 1""")
def composition_report(spark, sf):
    lines = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("o_orderkey") == F.col("l_orderkey"))
    systems = lines.groupBy("l_orderkey").agg(F.first("o_orderpriority").alias("split"), F.count_distinct("l_suppkey").alias("p"), F.count_distinct("l_partkey").alias("x"))
    return evaluate.chain_composition(systems, proteins="p", ligands="x")


@query("""select c_custkey as system, count(*) filter (o_orderstatus = 'F') > 0 as system_has_apo, count(*) filter (o_orderstatus = 'O') > 0 as system_has_pred,
           count(*) filter (o_orderstatus in ('F', 'O')) > 0 as system_has_apo_or_pred
    from customer left join orders on o_custkey = c_custkey group by 1""")
def link_flags(spark, sf):
    kind = F.when(F.col("o_orderstatus") == "F", "apo").when(F.col("o_orderstatus") == "O", "pred").otherwise("holo")
    links = table(spark, sf, "orders").select(F.col("o_custkey").alias("reference_system_id"), kind.alias("kind"))
    return split.with_links(table(spark, sf, "customer").select(F.col("c_custkey").alias("system")), links)


@query("""select vec_id, round(list_sum(list_transform(embedding, lambda x: cast(x as double))), 6) as total, len(embedding) as n from embeddings""")
def array_sum(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", F.round(scalars.strict_sum(F.col("embedding")), 6).alias("total"), F.size("embedding").cast("long").alias("n"))
