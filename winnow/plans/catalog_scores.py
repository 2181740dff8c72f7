"""Queries: scores, best alternatives, distributions, fragments."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from winnow.functions.text import words
from winnow.operators import best, combine, flags, fragments, stats
from winnow.operators.plugins import with_calculator, with_model_score
from winnow.plans.registry import Tables, query
from winnow.sources.records import first_number
from winnow.sources.results import result_rows, scan_log


@query(
    "q_score_filter",
    """select doc_id from documents left join labels using (doc_id) where (quality is null or quality >= 1) and (toxic is null or toxic between 0 and 0)""",
)
def q_score_filter(t: Tables) -> DataFrame:
    rows = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    return flags.score_filter(rows, {"quality": (1, "inf"), "toxic": (None, 0), "absent": (5, 6)}).select("doc_id")


@query(
    "q_lookup_default",
    "select doc_id, coalesce(quality, 0) as quality, coalesce(toxic, 0) as toxic from documents left join labels using (doc_id)",
)
def q_lookup_default(t: Tables) -> DataFrame:
    return combine.lookup(t.documents.select("doc_id"), t.labels, "doc_id", {"quality": 0, "toxic": 0})


@query(
    "q_lookup_first",
    """with f as (select user_id, arg_min(value, event_id) as v from events where event_type = 'purchase' group by 1)
       select c_custkey, coalesce(v, 0.0) as value from customer left join f on user_id = c_custkey""",
)
def q_lookup_first(t: Tables) -> DataFrame:
    right = t.events.filter("event_type = 'purchase'").select(F.col("user_id").alias("c_custkey"), "value", "event_id")
    return combine.lookup(t.customer.select("c_custkey"), right, "c_custkey", {"value": 0.0}, "event_id")


@query(
    "q_lookup_fallback",
    """select o_orderkey, coalesce(c_name, 'Customer ' || o_custkey) as name from orders
       left join (select * from customer where c_acctbal > 0) on c_custkey = o_custkey""",
)
def q_lookup_fallback(t: Tables) -> DataFrame:
    known = t.customer.filter("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("name"))
    fallback = F.concat(F.lit("Customer "), F.col("o_custkey").cast("string"))
    rows = t.orders.select("o_orderkey", "o_custkey")
    return combine.lookup_or(rows, known, "o_custkey", "name", fallback).select("o_orderkey", "name")


@query(
    "q_positional_lookup",
    """with a as (select s_suppkey, row_number() over (order by s_suppkey) as rn from supplier),
       b as (select n_name, row_number() over (order by n_nationkey) as rn from nation)
       select s_suppkey, coalesce(n_name, '') as name from a left join b using (rn)""",
)
def q_positional_lookup(t: Tables) -> DataFrame:
    from winnow.operators.ranks import row_numbers

    a = row_numbers(t.supplier.select("s_suppkey"), [], ["s_suppkey"])
    b = row_numbers(t.nation.select("n_nationkey", F.col("n_name").alias("name")), [], ["n_nationkey"])
    return combine.lookup(a, b, "rank", {"name": ""}).select("s_suppkey", "name")


BEST_SQL = """select *, row_number() over (partition by l_orderkey order by l_extendedprice, l_partkey, l_suppkey, l_linenumber) as rn from lineitem"""


def poses(t: Tables) -> DataFrame:
    """Line items as poses: the order is the entity, one number orders equal prices."""
    order = F.struct("l_partkey", "l_suppkey", "l_linenumber")
    return t.lineitem.withColumns({"entity": F.col("l_orderkey").cast("string"), "ord": order})


@query("q_best_pose", f"select l_orderkey, l_partkey, l_extendedprice from ({BEST_SQL}) where rn = 1")
def q_best_pose(t: Tables) -> DataFrame:
    return best.best_per(poses(t), "entity", "l_extendedprice", "ord").select("l_orderkey", "l_partkey", "l_extendedprice")


@query(
    "q_best_pose_numbered",
    f"""select l_orderkey, row_number() over (order by l_orderkey::varchar) - 1 as pose_idx from ({BEST_SQL}) where rn = 1""",
)
def q_best_pose_numbered(t: Tables) -> DataFrame:
    out = best.best_per(poses(t), "entity", "l_extendedprice", "ord", renumber="pose_idx")
    return out.select("l_orderkey", "pose_idx")


@query(
    "q_final_dedup",
    """select l_orderkey, l_extendedprice from (select *, row_number() over (partition by l_orderkey order by l_extendedprice,
       l_partkey, l_suppkey, l_linenumber) as rn from lineitem where l_discount <= 0.05) where rn = 1""",
)
def q_final_dedup(t: Tables) -> DataFrame:
    passed = poses(t).filter("l_discount <= 0.05")
    return best.best_per(passed, "entity", "l_extendedprice", "ord").select("l_orderkey", "l_extendedprice")


@query(
    "q_best_scored",
    """select l_orderkey, min(l_extendedprice) as l_extendedprice, arg_min(l_quantity, (l_extendedprice, l_partkey, l_suppkey, l_linenumber)) as l_quantity
       from lineitem where l_tax > 0.02 group by 1""",
)
def q_best_scored(t: Tables) -> DataFrame:
    rows = poses(t).withColumn("score", F.when(F.col("l_tax") > 0.02, F.col("l_extendedprice")))
    return best.best_scored(rows, "l_orderkey", "score", "ord", ["l_extendedprice", "l_quantity"])


TOOLS = ("A", "N", "R")


@query(
    "q_best_by_tool",
    """with b as (select l_orderkey, """
    + ", ".join(
        f"min(l_extendedprice) filter (l_returnflag = '{x}') as \"{x}_l_extendedprice\", "
        f"arg_min(l_quantity, (l_extendedprice, l_partkey, l_suppkey, l_linenumber)) filter (l_returnflag = '{x}') as \"{x}_l_quantity\""
        for x in TOOLS
    )
    + " from lineitem group by 1) select o_orderkey, b.* exclude (l_orderkey) from orders left join b on o_orderkey = l_orderkey",
)
def q_best_by_tool(t: Tables) -> DataFrame:
    scores = best.best_by_tool(
        poses(t).withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey", "l_returnflag", TOOLS, "l_extendedprice", "ord", ["l_quantity"]
    )
    return best.with_tool_scores(t.orders.select("o_orderkey"), scores, "o_orderkey")


@query("q_topk", "select o_orderkey, o_totalprice from orders order by o_totalprice, o_orderkey limit 10")
def q_topk(t: Tables) -> DataFrame:
    return best.top_k(t.orders, ["o_totalprice", "o_orderkey"], 10).select("o_orderkey", "o_totalprice")


@query(
    "q_topk_group",
    """select o_orderkey, o_orderpriority, o_totalprice from (select *, row_number() over (partition by o_orderpriority
       order by o_totalprice, o_orderkey) as rn from orders) where rn <= 10""",
)
def q_topk_group(t: Tables) -> DataFrame:
    out = best.top_k(t.orders, ["o_totalprice", "o_orderkey"], 10, "o_orderpriority")
    return out.select("o_orderkey", "o_orderpriority", "o_totalprice")


# --- distributions --------------------------------------------------------------------------------

LINE_METRICS = ["l_quantity", "l_extendedprice", "l_discount"]


def _long_sql(cols: list[str], table: str, keep: str) -> str:
    return " union all ".join(f"select {keep}, '{c}' as metric, {c}::double as value from {table}" for c in cols)


@query(
    "q_describe",
    f"""with l as ({_long_sql(LINE_METRICS, 'lineitem', 'l_returnflag')})
       select coalesce(l_returnflag, '(all)') as l_returnflag, metric, count(*) as n, round(avg(value), 4) as mean,
         round(stddev_samp(value), 4) as std, min(value) as min, max(value) as max, round(median(value), 6) as median
       from l group by grouping sets ((l_returnflag, metric), (metric))""",
)
def q_describe(t: Tables) -> DataFrame:
    out = stats.describe(t.lineitem, LINE_METRICS, "l_returnflag")
    return out.withColumns({"mean": F.round("mean", 4), "std": F.round("std", 4), "median": F.round("median", 6)})


FIVE_SQL = f"""with l as ({_long_sql(LINE_METRICS, 'lineitem', 'l_returnflag')})
       select l_returnflag, metric, min(value) as q0, round(quantile_cont(value, 0.25), 6) as q25, round(quantile_cont(value, 0.5), 6) as q50,
         round(quantile_cont(value, 0.75), 6) as q75, max(value) as q100 from l group by all"""


@query("q_five_num", FIVE_SQL)
def q_five_num(t: Tables) -> DataFrame:
    out = stats.five_numbers(t.lineitem, LINE_METRICS, "l_returnflag")
    return out.withColumns({c: F.round(c, 6) for c in ("q25", "q50", "q75")})


@query("q_five_num_cut", FIVE_SQL)
def q_five_num_cut(t: Tables) -> DataFrame:
    """The same numbers the way large groups get them."""
    out = stats.five_numbers(t.lineitem, LINE_METRICS, "l_returnflag", in_task=1000)
    return out.withColumns({c: F.round(c, 6) for c in ("q25", "q50", "q75")})


@query(
    "q_group_means",
    "select l_returnflag, " + ", ".join(f"round(avg({c}), 4) as mean_{c}" for c in LINE_METRICS) + " from lineitem group by 1",
)
def q_group_means(t: Tables) -> DataFrame:
    out = stats.group_means(t.lineitem, LINE_METRICS, "l_returnflag")
    return out.select("l_returnflag", *[F.round(f"mean_{c}", 4).alias(f"mean_{c}") for c in LINE_METRICS])


@query(
    "q_drift",
    f"""with a as (select metric, avg(value) as v from ({_long_sql(LINE_METRICS, 'lineitem', '1 as one')}) group by 1),
       b as (select metric, avg(value) as v from ({_long_sql(LINE_METRICS, '(select * from lineitem where l_tax < 0.04)', '1 as one')}) group by 1)
       select metric, round(a.v, 4) as mean_initial, round(b.v, 4) as mean_final, round(b.v - a.v, 4) as change from a join b using (metric)""",
)
def q_drift(t: Tables) -> DataFrame:
    after = t.lineitem.filter("l_tax < 0.04").drop("l_shipdate")
    out = stats.drift(t.lineitem, after, [*LINE_METRICS, "unknown"])
    return out.withColumns({c: F.round(c, 4) for c in ("mean_initial", "mean_final", "change")})


@query(
    "q_hist",
    """with e as (select min(l_extendedprice) as lo, max(l_extendedprice) as hi from lineitem),
       b as (select least(floor((l_extendedprice - lo) / ((hi - lo) / 30)), 29)::int as bin, count(*) as n, sum(l_extendedprice) as s from lineitem, e group by 1)
       select d.bin::int as bin, round(lo + d.bin * ((hi - lo) / 30), 6) as lower, coalesce(n, 0) as count, round(coalesce(s, 0), 2) as sum
       from range(30) d(bin) cross join e left join b on b.bin = d.bin""",
)
def q_hist(t: Tables) -> DataFrame:
    out = stats.histogram(t.lineitem, "l_extendedprice", 30)
    return out.withColumns({"lower": F.round("lower", 6), "sum": F.round("sum", 2)})


@query(
    "q_discrete_hist",
    """select v as value, count(l_quantity) as count from range(0, (select max(l_quantity)::bigint + 6 from lineitem)) d(v)
       left join lineitem on l_quantity = v group by 1""",
)
def q_discrete_hist(t: Tables) -> DataFrame:
    return stats.discrete_histogram(t.lineitem, "l_quantity")


@query(
    "q_symbol_hist",
    """with w as (select unnest(regexp_extract_all(text, '[^ \\t\\r\\n]+')) as w from documents),
       s as (select unnest(['the', 'de', 'und', 'zzz']) as symbol, unnest([0, 1, 2, 3]) as position)
       select position::int as position, symbol, count(w) as count from s left join w on w = symbol group by all""",
)
def q_symbol_hist(t: Tables) -> DataFrame:
    return stats.symbol_histogram(t.documents.select(words(F.col("text")).alias("w")), "w", ["the", "de", "und", "zzz"])


@query(
    "q_kde",
    """with s as (select p_type, count(*) as n, stddev_samp(p_retailprice) * power(count(*), -0.2) as h, min(p_retailprice) as mn, max(p_retailprice) as mx from part group by 1),
       f as (select *, greatest(mn - 3 * h, 0) as lo, mx + 3 * h as hi from s where h > 0),
       g as (select f.*, k::int as point, lo + k * (hi - lo) / 49 as x from f, range(50) r(k))
       select p_type, point, round(x, 6) as x, round(sum(exp(-0.5 * power((x - p_retailprice) / h, 2))) / (n * h * sqrt(2 * pi())), 9) as density
       from g join part using (p_type) group by p_type, point, x, n, h""",
)
def q_kde(t: Tables) -> DataFrame:
    out = stats.density(t.part, "p_retailprice", "p_type", 50)
    return out.withColumns({"x": F.round("x", 6), "density": F.round("density", 9)})


@query(
    "q_inbounds",
    """with p as (select l_returnflag, 100 * avg((l_quantity between 10 and 40)::int) as a, 100 * avg((l_discount <= 0.05)::int) as b from lineitem group by 1)
       select l_returnflag, 'l_quantity' as metric, round(a, 6) as pct_in_bounds from p union all select l_returnflag, 'l_discount', round(b, 6) from p""",
)
def q_inbounds(t: Tables) -> DataFrame:
    out = stats.in_bounds(t.lineitem, {"l_quantity": (10, 40), "l_discount": (None, 0.05)}, "l_returnflag")
    return out.withColumn("pct_in_bounds", F.round("pct_in_bounds", 6))


@query(
    "q_score_summary",
    """select coalesce(lang, '(all)') as lang, count(*) as n, round(avg(quality), 6) as avg_quality, round(avg(toxic), 6) as avg_toxic,
       count(*) filter (quality = 1) as solved, count(*) - count(*) filter (quality = 1) as unsolved,
       round(100.0 * count(*) filter (quality = 1) / count(*), 6) as pct_solved, round(avg(n_chars), 6) as avg_search_time
       from documents left join labels using (doc_id) group by grouping sets ((lang), ())""",
)
def q_score_summary(t: Tables) -> DataFrame:
    rows = t.documents.select("doc_id", "lang", "n_chars").join(t.labels, "doc_id", "left")
    out = stats.score_summary(rows, ["quality", "toxic"], "lang", "quality", "n_chars")
    return out.withColumns({c: F.round(c, 6) for c in ("avg_quality", "avg_toxic", "pct_solved", "avg_search_time")})


@query(
    "q_route_summary",
    """select count(*) as total, count(*) filter (l_linestatus = 'F') as solved, round(100.0 * count(*) filter (l_linestatus = 'F') / count(*), 6) as solve_rate,
       round(avg(l_extendedprice) filter (l_linestatus = 'F'), 4) as avg_l_extendedprice, round(avg(l_linenumber) filter (l_linestatus = 'F'), 6) as avg_l_linenumber,
       round(avg(l_quantity) filter (l_linestatus = 'F'), 6) as avg_l_quantity from lineitem""",
)
def q_route_summary(t: Tables) -> DataFrame:
    rows = t.lineitem.withColumn("solved_flag", F.col("l_linestatus") == "F")
    out = stats.route_summary(rows, "solved_flag", "l_extendedprice", "l_linenumber", "l_quantity")
    return out.withColumns(
        {"solve_rate": F.round("solve_rate", 6), "avg_l_extendedprice": F.round("avg_l_extendedprice", 4),
         "avg_l_linenumber": F.round("avg_l_linenumber", 6), "avg_l_quantity": F.round("avg_l_quantity", 6)}
    )


@query(
    "q_pose_summary",
    """select coalesce(g, '(all)') as model_name, round(avg(p), 4) as avg_score, min(p) as best_score, count(*) as count
       from (select case when l_returnflag = 'N' then 'Unknown' else l_returnflag end as g, l_extendedprice as p from lineitem)
       group by grouping sets ((g), ()) having coalesce(g, '(all)') <> 'Unknown'""",
)
def q_pose_summary(t: Tables) -> DataFrame:
    rows = t.lineitem.select(F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("model_name"), "l_extendedprice")
    return stats.pose_summary(rows, "l_extendedprice", "model_name").withColumn("avg_score", F.round("avg_score", 4))


# --- fragments ------------------------------------------------------------------------------------

TOKENS_SQL = """tok as (select distinct doc_id, unnest(regexp_extract_all(text, '[^ \\t\\r\\n]+')) as fragment from documents),
  tot as (select count(*) filter (quality = 1) as p, count(*) filter (quality = 0) as n from documents join labels using (doc_id)),
  model as (select fragment, count(*) filter (quality = 1) as n_pos, count(*) filter (quality = 0) as n_neg from tok join labels using (doc_id) group by 1),
  scored as (select fragment, n_pos, n_neg, ln((n_pos + 1) / (n_neg + 1)) as present, ln((p - n_pos + 1) / (n - n_neg + 1)) as absent,
    ln((n + 2) / (p + 2)) as prior from model, tot)"""


def labelled(t: Tables) -> DataFrame:
    # texts are shuffled, not their words, which take several times the space
    docs = t.documents.select("doc_id", "text").join(t.labels, "doc_id")
    return docs.select("doc_id", "quality", words(F.col("text")).alias("fragments"))


def model(t: Tables) -> DataFrame:
    return fragments.fit_fragments(labelled(t), "fragments", "quality")


@query(
    "q_frag_train",
    f"with {TOKENS_SQL} select fragment, n_pos, n_neg, round(present, 6) as present, round(absent, 6) as absent, round(prior, 6) as prior from scored",
)
def q_frag_train(t: Tables) -> DataFrame:
    return model(t).withColumns({c: F.round(c, 6) for c in ("present", "absent", "prior")})


@query(
    "q_frag_score",
    f"""with {TOKENS_SQL}, base as (select sum(prior + absent) as b from scored),
       s as (select doc_id, sum(present - absent) as g, count(present) as k from tok left join scored using (fragment) group by 1)
       select doc_id, round(b + coalesce(g, 0), 4) as score, coalesce(k, 0) as n_known from documents left join s using (doc_id), base""",
)
def q_frag_score(t: Tables) -> DataFrame:
    docs = t.documents.select("doc_id", words(F.col("text")).alias("fragments"))
    return fragments.score_fragments(docs, "doc_id", "fragments", model(t)).withColumn("score", F.round("score", 4))


@query(
    "q_frag_score_present",
    f"""with {TOKENS_SQL}, s as (select doc_id, sum(prior + present) as g, count(present) as k from tok left join scored using (fragment) group by 1)
       select doc_id, round(coalesce(g, 0), 4) as score, coalesce(k, 0) as n_known from documents left join s using (doc_id)""",
)
def q_frag_score_present(t: Tables) -> DataFrame:
    docs = t.documents.select("doc_id", words(F.col("text")).alias("fragments"))
    out = fragments.score_fragments(docs, "doc_id", "fragments", model(t), only_present=True)
    return out.withColumn("score", F.round("score", 4))


@query(
    "q_frag_extreme",
    f"""with {TOKENS_SQL}, d as (select fragment, n_pos, n_neg, n_pos - n_neg as difference from model)
       select *, 'low' as "end" from (select * from d order by difference, fragment limit 10) union all
       select *, 'high' from (select * from d order by difference desc, fragment limit 10)""",
)
def q_frag_extreme(t: Tables) -> DataFrame:
    out = fragments.extreme_fragments(model(t), 10)
    return out.select("fragment", "n_pos", "n_neg", "difference", "end")


@query(
    "q_frag_position",
    f"""with {TOKENS_SQL}, ln as (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) - 1 as position from documents),
       w as (select doc_id, position, unnest(regexp_extract_all(line, '[^ \\t\\r\\n]+')) as fragment from ln)
       select doc_id, position::int as position, round(coalesce(sum(present), 0), 4) as contribution from w left join scored using (fragment) group by 1, 2""",
)
def q_frag_position(t: Tables) -> DataFrame:
    lines = t.documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("position", "line"))
    tokens = lines.select("doc_id", "position", F.explode(words(F.col("line"))).alias("fragment"))
    out = fragments.position_scores(tokens, "doc_id", "position", "fragment", model(t))
    return out.withColumn("contribution", F.round("contribution", 4))


COUNT_SCORES = {0: (0.3, -0.1), 1: (0.2, 0.0), 2: (0.1, 0.05), 3: (-0.2, 0.1), 4: (-0.4, 0.15), 5: (-0.9, 0.2)}


@query(
    "q_count_term",
    "select l_orderkey, l_linenumber, round(case least(l_linenumber, 5) "
    + " ".join(f"when {k} then {p + 0.4 - a}" for k, (p, a) in COUNT_SCORES.items())
    + " end, 6)::double as term from lineitem",
)
def q_count_term(t: Tables) -> DataFrame:
    term = fragments.count_term(F.col("l_linenumber"), COUNT_SCORES)
    return t.lineitem.select("l_orderkey", "l_linenumber", F.round(term, 6).alias("term"))


FOLD_SQL = """fold as (select doc_id, (length(w) * 131 + ascii(w)) % 64 as bucket, count(*) as n from
   (select doc_id, unnest(regexp_extract_all(text, '[A-Za-z]+')) as w from documents) group by 1, 2)"""


def folded(t: Tables) -> DataFrame:
    tokens = t.documents.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z]+"), 0)).alias("w"))
    ids = tokens.select("doc_id", (F.length("w") * 131 + F.ascii("w")).alias("fid"))
    return fragments.fold_counts(ids, ["doc_id"], "fid", None, 64)


@query("q_hash_fold", f"with {FOLD_SQL} select doc_id, bucket::int as bucket, n from fold")
def q_hash_fold(t: Tables) -> DataFrame:
    return folded(t)


@query(
    "q_model_scorer",
    f"with {FOLD_SQL} select doc_id, round(s, 4) as model_score from documents left join (select doc_id, sum(n * ((bucket % 7) / 10.0)) as s from fold group by 1) using (doc_id)",
)
def q_model_scorer(t: Tables) -> DataFrame:
    import numpy as np

    weights = (np.arange(64) % 7) / 10.0
    vectors = fragments.dense_counts(folded(t), "doc_id", 64)
    rows = t.documents.select("doc_id").join(vectors, "doc_id", "left")
    out = with_model_score(rows, "counts", lambda m: m @ weights)
    return out.select("doc_id", F.round("model_score", 4).alias("model_score"))


@query(
    "q_calculator",
    """select doc_id, (length(text) - length(replace(text, ' ', '')))::bigint as n_spaces from documents""",
)
def q_calculator(t: Tables) -> DataFrame:
    def spaces(_, batch: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"n_spaces": batch["text"].str.count(" ")})

    rows = t.documents.select("doc_id", "text")
    return with_calculator(rows, spaces, "n_spaces long", inputs=["text"]).select("doc_id", "n_spaces")


# --- nested inputs --------------------------------------------------------------------------------


@query(
    "q_json_results",
    """select event_id as index, event_type as target, coalesce(event_type = 'purchase', false) as is_solved, value as search_time,
       (props->>'k')::double as top_score from events""",
)
def q_json_results(t: Tables) -> DataFrame:
    text = F.concat(
        F.lit('{"data":[{"index":'), F.col("event_id"), F.lit(',"target":"'), F.col("event_type"), F.lit('","search_time":'), F.col("value"),
        F.when(F.col("event_type") == "purchase", F.lit(',"is_solved":true')).otherwise(F.lit("")),
        F.lit(',"top_score":'), F.get_json_object("props", "$.k"), F.lit("}]}"),
    )
    from winnow.sources.results import RESULT

    parsed = t.events.select(F.from_json(text, RESULT).alias("doc")).select("doc.data")
    return result_rows(parsed).select("index", "target", "is_solved", "search_time", "top_score")


@query(
    "q_props",
    "select event_id, (props->>'k')::double as score from events",
)
def q_props(t: Tables) -> DataFrame:
    props = F.from_json("props", "map<string,string>")
    return t.events.select("event_id", first_number(props, ["minimizedAffinity", "k"]).alias("score"))


@query(
    "q_log_scan",
    """with l as (select lang, unnest(string_split(text, chr(10))) as line from documents)
       select lang, count(*) as warnings, count(distinct case when regexp_matches(line, '^[^|]*\\|') and trim(regexp_extract(line, '^([^|]*)\\|', 1)) <> ''
         then trim(regexp_extract(line, '^([^|]*)\\|', 1)) end) as ids from l where contains(lower(line), 'license') or contains(lower(line), 'token') group by 1""",
)
def q_log_scan(t: Tables) -> DataFrame:
    lines = t.documents.select("lang", F.explode(F.split("text", "\n")).alias("value"))
    return scan_log(lines, "value", ["License", "Token"], by="lang")


# --- values that are not numbers -----------------------------------------------------------------------

NAN_SQL = "b as (select c_mktsegment as segment, case when c_custkey % 7 <> 0 then c_acctbal end as x from customer)"


def with_nan(t: Tables) -> DataFrame:
    """Account balances, NaN for every seventh customer."""
    return t.customer.select(F.col("c_mktsegment").alias("segment"), F.when(F.col("c_custkey") % 7 != 0, F.col("c_acctbal")).otherwise(float("nan")).alias("x"))


@query(
    "q_hist_nan",
    f"""with {NAN_SQL}, e as (select min(x) as lo, (max(x) - min(x)) / 12 as w from b), r as (select unnest(range(0, 12))::int as bin),
       c as (select least(floor((x - lo) / w), 11)::int as bin, count(*) as n, sum(x) as s from b, e where x is not null group by 1)
       select r.bin, round(lo + r.bin * w, 4) as lower, coalesce(n, 0) as count, round(coalesce(s, 0), 2) as sum from r cross join e left join c on c.bin = r.bin""",
)
def q_hist_nan(t: Tables) -> DataFrame:
    out = stats.histogram(with_nan(t), "x", 12)
    return out.withColumns({"lower": F.round("lower", 4), "sum": F.round("sum", 2)})


@query(
    "q_summary_nan",
    f"""with {NAN_SQL} select segment, round(avg(x), 6) as mean_x, round(100 * avg((x >= 0)::int) filter (x is not null), 6) as pct_in_bounds, count(x) as n from b group by 1""",
)
def q_summary_nan(t: Tables) -> DataFrame:
    rows = with_nan(t)
    inside = stats.in_bounds(rows, {"x": (0, None)}, "segment").select("segment", F.round("pct_in_bounds", 6).alias("pct_in_bounds"))
    counts = stats.pose_summary(rows, "x", "segment").select("segment", F.col("count").alias("n"))
    means = stats.group_means(rows, ["x"], "segment").select("segment", F.round("mean_x", 6).alias("mean_x"))
    return means.join(inside, "segment").join(counts, "segment")
