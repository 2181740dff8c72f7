"""Queries: rule matching, mask combination, reasons."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from winnow.functions.text import words
from winnow.operators import combine, masks
from winnow.operators.rules import Rule, load_rules, match_literals, match_rule_table, match_rules, match_tokens, rule_hits, rule_masks
from winnow.plans.registry import Tables, query
from winnow.session import written

RULES = (
    Rule("junk", "marker run", r"[*%#$!&]{3}"),
    Rule("junk", "shouting", r"[A-Z]{5,}"),
    Rule("personal", "phone", r"[0-9]{3}-[0-9]{4}"),
    Rule("personal", "address", r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}"),
    Rule("personal", "long number", r"[0-9]{6,}"),
    Rule("secret", "credential", r"(api_key|token|secret|password) ="),
    Rule("secret", "license line", "License", literal=True),
)
SETS = ("junk", "personal", "secret")


def _case(r: Rule) -> str:
    test = f"contains(text, '{r.pattern}')" if r.literal else f"regexp_matches(text, '{r.pattern}')"
    return f"select doc_id, source, lang, {RULES.index(r)} as k, '{r.rule_set}' as rule_set, '{r.description}' as description from documents where {test}"


HITS_SQL = "hits as (" + " union all ".join(_case(r) for r in RULES) + ")"
MASKS_SQL = (
    HITS_SQL
    + ", masks as (select d.doc_id, d.source, d.lang, "
    + ", ".join(
        f"count(k) filter (rule_set = '{s}') = 0 as pass_{s}, "
        f"coalesce(string_agg(description, ';' order by k) filter (rule_set = '{s}'), '') as reasons_{s}"
        for s in SETS
    )
    + " from documents d left join hits h on d.doc_id = h.doc_id group by all), "
    + "m as (select *, pass_junk and pass_personal and pass_secret as pass, pass_junk or pass_personal or pass_secret as pass_any from masks), "
    + "reasons as (select rule_set, description as reason, count(*) as count from hits group by all), "
    + "fails as (select rule_set, count(distinct doc_id) as failures from hits group by 1)"
)
WITH = "with " + MASKS_SQL


def matched(t: Tables) -> DataFrame:
    return match_rules(t.documents, "text", RULES)


def masked(t: Tables) -> DataFrame:
    return rule_masks(matched(t), SETS).drop("hits", "text")


@query("q_rules_hits", f"with {HITS_SQL} select doc_id, rule_set, description from hits")
def q_rules_hits(t: Tables) -> DataFrame:
    return rule_hits(matched(t), ["doc_id"])


@query(
    "q_rules_masks",
    WITH + " select doc_id, pass_junk, pass_personal, pass_secret, reasons_junk, reasons_personal, reasons_secret, pass, pass_any from m",
)
def q_rules_masks(t: Tables) -> DataFrame:
    flags = [f"{k}_{s}" for k in ("pass", "reasons") for s in SETS]
    return masked(t).select("doc_id", *flags, "pass", "pass_any")


@query(
    "q_rules_invalid",
    WITH
    + " select m.doc_id, "
    + ", ".join(f"n_chars > 200 and pass_{s} as pass_{s}, case when n_chars > 200 then reasons_{s} else 'invalid_molecule' end as reasons_{s}" for s in SETS)
    + " from m join documents d on m.doc_id = d.doc_id",
)
def q_rules_invalid(t: Tables) -> DataFrame:
    """Unreadable candidates (here: short texts made NULL) fail every rule set."""
    rows = t.documents.withColumn("text", F.when(F.col("n_chars") > 200, F.col("text")))
    out = rule_masks(match_rules(rows, "text", RULES), SETS)
    return out.select("doc_id", *[f"{k}_{s}" for k in ("pass", "reasons") for s in SETS])


@query(
    "q_rule_catalogue",
    """select distinct p_type as rule_set_name, p_name as description from part where p_type in ('ECONOMY', 'PROMO')
       and not (p_type = 'ECONOMY' and p_name in ('small ring', 'red widget'))""",
)
def q_rule_catalogue(t: Tables) -> DataFrame:
    catalogue = t.part.select(F.col("p_type").alias("rule_set_name"), F.col("p_name").alias("description"))
    return load_rules(catalogue, ["ECONOMY", "PROMO"], {"ECONOMY": ["small ring", "red widget"]}).distinct()


@query(
    "q_rules_from_table",
    """with n as (select distinct p_name as w from part where p_type = 'ECONOMY')
       select o_orderkey, count(w) as hits from (select l_orderkey as o_orderkey, p_name as txt from lineitem
         join part on l_partkey = p_partkey) x left join n on contains(txt, w) group by 1""",
)
def q_rules_from_table(t: Tables) -> DataFrame:
    """A catalogue table of any size: distinct names as patterns against the names of ordered parts."""
    catalogue = t.part.filter("p_type = 'ECONOMY'").select(
        F.lit("names").alias("rule_set_name"), F.col("p_name").alias("description"), F.col("p_name").alias("smarts")
    ).distinct()
    found = match_literals(t.part, "p_partkey", "p_name", catalogue).groupBy("p_partkey").agg(F.count(F.lit(1)).alias("n"))
    hits = t.part.select("p_partkey").join(found, "p_partkey", "left").select("p_partkey", F.coalesce("n", F.lit(0)).alias("n"))
    lines = t.lineitem.join(hits, F.col("l_partkey") == F.col("p_partkey"))
    return lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("n").alias("hits"))


@query(
    "q_token_rules",
    """with r as (select distinct 'set' || (item_id % 3) as rule_set, 'item ' || item_id as description,
         unnest(regexp_extract_all(text, '[^ \\t\\r\\n]+')) as token from benchmark),
       w as (select distinct doc_id, unnest(regexp_extract_all(text, '[^ \\t\\r\\n]+')) as token from documents)
       select rule_set, description, count(distinct doc_id) as docs from w join r using (token) group by 1, 2""",
)
def q_token_rules(t: Tables) -> DataFrame:
    """Every word of a benchmark item is a token rule."""
    item = F.col("item_id")
    rules = t.benchmark.select(
        F.concat(F.lit("set"), (item % 3).cast("string")).alias("rule_set"),
        F.concat(F.lit("item "), item.cast("string")).alias("description"),
        F.explode(F.array_distinct(words(F.col("text")))).alias("token"),
    )
    hits = match_tokens(t.documents.select("doc_id", words(F.col("text")).alias("w")), "doc_id", "w", rules)
    return hits.groupBy("rule_set", "description").agg(F.count(F.lit(1)).alias("docs"))


@query(
    "q_rules_large_catalogue",
    """with w as (select item_id, regexp_extract_all(text, '[A-Za-z]+') as w from benchmark),
       r as (select distinct 'set' || (item_id % 3) as rule_set_name, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as description,
         w[i] || ' ' || w[i + 1] || '[ ,.]+' || w[i + 2] as pattern from w, unnest(generate_series(1, len(w) - 2, 3)) t(i))
       select rule_set_name, description, count(*) as docs from documents d join r on regexp_matches(d.text, r.pattern) group by 1, 2""",
)
def q_rules_large_catalogue(t: Tables) -> DataFrame:
    """Benchmark items cut into three words each, every three a regular expression: thousands of rules."""
    w = t.benchmark.select("item_id", F.regexp_extract_all("text", F.lit("([A-Za-z]+)")).alias("w"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - 3, F.lit(0)), F.lit(3))
    three = w.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("w", i + 1, 3))).alias("p")).filter(F.size("p") == 3)
    a, b, c = (F.get("p", F.lit(i)) for i in range(3))
    rules = three.select(
        F.concat(F.lit("set"), (F.col("item_id") % 3).cast("string")).alias("rule_set_name"),
        F.concat_ws(" ", a, b, c).alias("description"),
        F.concat(a, F.lit(" "), b, F.lit("[ ,.]+"), c).alias("smarts"),
    )
    return match_rule_table(t.documents, "doc_id", "text", rules).groupBy("rule_set_name", "description").agg(F.count(F.lit(1)).alias("docs"))


# --- masks over line items ------------------------------------------------------------------------

LINE_KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice"]
KEY_SQL = ", ".join(LINE_KEYS)
COMBINE_SQL = f"""with c as (select {KEY_SQL}, case when l_linestatus = 'F' then l_quantity > 10 else false end as pass_quantity,
   l_discount <= 0.08 as pass_discount, case when l_returnflag <> 'A' then l_tax < 0.07 else false end as pass_tax from lineitem)"""


def line_masks(t: Tables) -> tuple[DataFrame, dict[str, DataFrame]]:
    rows = t.lineitem
    base = rows.select(*LINE_KEYS)
    return base, {
        "quantity": rows.filter("l_linestatus = 'F'").select(*LINE_KEYS, (F.col("l_quantity") > 10).alias("pass")),
        "discount": rows.select(*LINE_KEYS, (F.col("l_discount") <= 0.08).alias("pass_filter")),
        "tax": rows.filter("l_returnflag <> 'A'").select(*LINE_KEYS, (F.col("l_tax") < 0.07).alias("pass")),
    }


@query("q_mask_combine_all", COMBINE_SQL + f" select {KEY_SQL} from c where pass_quantity and pass_discount and pass_tax")
def q_mask_combine_all(t: Tables) -> DataFrame:
    return combine.combine_masks(*line_masks(t), LINE_KEYS)[0]


@query("q_mask_combine_failed", COMBINE_SQL + " select * from c where not (pass_quantity and pass_discount and pass_tax)")
def q_mask_combine_failed(t: Tables) -> DataFrame:
    return combine.combine_masks(*line_masks(t), LINE_KEYS)[1]


@query("q_mask_combine_any", COMBINE_SQL + f" select {KEY_SQL} from c where pass_quantity or pass_discount or pass_tax")
def q_mask_combine_any(t: Tables) -> DataFrame:
    return combine.combine_masks(*line_masks(t), LINE_KEYS, mode="any")[0]


@query("q_mask_combine_semi", COMBINE_SQL + f" select {KEY_SQL} from c where pass_quantity and pass_discount and pass_tax")
def q_mask_combine_semi(t: Tables) -> DataFrame:
    base, by_name = line_masks(t)
    survivors = [m.filter(F.col(m.columns[-1])).select(*LINE_KEYS) for m in by_name.values()]
    return combine.intersect_survivors(base, survivors, LINE_KEYS)


@query(
    "q_mask_keep_last",
    """select o_custkey, arg_max(o_orderstatus = 'F', o_orderkey) as pass_status from orders group by 1""",
)
def q_mask_keep_last(t: Tables) -> DataFrame:
    base = t.orders.select("o_custkey").distinct()
    mask = t.orders.select("o_custkey", (F.col("o_orderstatus") == "F").alias("pass"), "o_orderkey")
    return combine.mask_table(base, {"status": mask}, ["o_custkey"], "o_orderkey")


@query(
    "q_backfill",
    """with a as (select l_orderkey as k, bool_or(l_tax > 0.05) as f from lineitem where l_returnflag = 'R' group by 1)
       select coalesce(o_orderkey, k) as k, coalesce(f, o_orderstatus = 'F', false) as flag
       from (select * from orders where o_orderpriority <> '5-LOW') o full join a on o_orderkey = k""",
)
def q_backfill(t: Tables) -> DataFrame:
    base = t.orders.filter("o_orderpriority <> '5-LOW'").select(
        F.col("o_orderkey").alias("k"), (F.col("o_orderstatus") == "F").alias("flag")
    )
    other = t.lineitem.filter("l_returnflag = 'R'").groupBy(F.col("l_orderkey").alias("k")).agg(
        F.bool_or(F.col("l_tax") > 0.05).alias("flag")
    )
    return combine.backfill(base, other, ["k"], ["flag"], "full").select("k", "flag")


@query(
    "q_identity",
    """with f as (select text, source, min(doc_id) as first_id from documents group by all)
       select doc_id, first_id from documents join f using (text, source)""",
)
def q_identity(t: Tables) -> DataFrame:
    docs = t.documents.select("doc_id", "source", F.sha2("text", 256).alias("digest"))
    known = docs.groupBy("digest", "source").agg(F.min("doc_id").alias("first_id"))
    return combine.recover_identity(docs, known, ["digest", "source"], "first_id", "first_id").select("doc_id", "first_id")


# --- statistics over masks ------------------------------------------------------------------------


@query(
    "q_ratio_stats",
    WITH
    + " select source, count(*) as num_mol, round(1 - avg(pass::int), 6) as all_banned_ratio, round(1 - avg(pass_any::int), 6) as any_banned_ratio, "
    + ", ".join(f"round(1 - avg(pass_{s}::int), 6) as {s}_banned_ratio" for s in SETS)
    + " from m group by 1",
)
def q_ratio_stats(t: Tables) -> DataFrame:
    stats = masks.mask_stats(masked(t), "source", SETS)
    return stats.select("source", "num_mol", *[F.round(c, 6).alias(c) for c in stats.columns[2:]])


@query(
    "q_ratio_invalid",
    WITH
    + """ select m.source, count(*) as num_mol, round(1 - avg(pass::int) filter (n_chars > 200), 6) as all_banned_ratio
       from m join documents using (doc_id) group by 1""",
)
def q_ratio_invalid(t: Tables) -> DataFrame:
    """Rows are counted before unreadable ones leave, shares after."""
    stats = masks.mask_stats(masked(t), "source", SETS, valid=F.col("n_chars") > 200)
    return stats.select("source", "num_mol", F.round("all_banned_ratio", 6).alias("all_banned_ratio"))


@query(
    "q_severity_stats",
    """select l_returnflag, count(*) as num_mol, """
    + ", ".join(f"round(1 - avg((l_linenumber < {s})::int), 6) as banned_ratio_s_{s}" for s in range(1, 12))
    + " from lineitem group by 1",
)
def q_severity_stats(t: Tables) -> DataFrame:
    from winnow.operators.flags import severity_flags

    stats = masks.severity_stats(severity_flags(t.lineitem.select("l_returnflag", "l_linenumber"), "l_linenumber"), "l_returnflag")
    return stats.select("l_returnflag", "num_mol", *[F.round(c, 6).alias(c) for c in stats.columns[2:]])


@query(
    "q_severity_summary",
    """select l_returnflag, count(*) as num_mol, round(avg(l_linenumber), 6) as mean_severity, max(l_linenumber) as max_severity,
       round(avg(l_quantity), 6) as mean_n_covalent_motif, round(avg((l_tax > 0)::int), 6) as mean_nonzero_special_mol,
       round(1 - avg((l_linenumber = 1)::int), 6) as banned_ratio from lineitem group by 1""",
)
def q_severity_summary(t: Tables) -> DataFrame:
    out = masks.severity_summary(
        t.lineitem, "l_returnflag", "l_linenumber", "l_quantity", "l_tax", F.col("l_linenumber") == 1
    )
    rounded = ("mean_severity", "mean_n_covalent_motif", "mean_nonzero_special_mol", "banned_ratio")
    return out.withColumns({c: F.round(c, 6) for c in rounded})


@query(
    "q_demerit_summary",
    """select lang, count(*) as num_mol, round(avg(toxic), 6) as "mean_noNA_demerit_score", round(1 - avg(coalesce(toxic = 0, false)::int), 6) as banned_ratio
       from documents left join labels using (doc_id) group by 1""",
)
def q_demerit_summary(t: Tables) -> DataFrame:
    rows = t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left")
    out = masks.demerit_summary(rows, "lang", "toxic", F.coalesce(F.col("toxic") == 0, F.lit(False)))
    return out.withColumns({c: F.round(c, 6) for c in ("mean_noNA_demerit_score", "banned_ratio")})


@query("q_single_mask", "select l_returnflag, count(*) as num_mol, round(1 - avg((l_tax < 0.05)::int), 6) as banned_ratio from lineitem group by 1")
def q_single_mask(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_returnflag", (F.col("l_tax") < 0.05).alias("pass"))
    return masks.single_mask_stats(rows, "l_returnflag").withColumn("banned_ratio", F.round("banned_ratio", 6))


FAILURES_SQL = "select rule_set, coalesce(failures, 0) as failures, total, round(100.0 * coalesce(failures, 0) / total, 6) as percentage from (select unnest(['junk','personal','secret']) as rule_set) left join fails using (rule_set), (select count(*) as total from documents)"


@query("q_failures", WITH + " " + FAILURES_SQL)
def q_failures(t: Tables) -> DataFrame:
    return masks.failure_counts(masked(t), SETS).withColumn("percentage", F.round("percentage", 6))


@query("q_reasons", WITH + " select * from reasons")
def q_reasons(t: Tables) -> DataFrame:
    return masks.reason_counts(masked(t), SETS)


@query("q_reason_share", WITH + " select r.*, failures, round(100.0 * count / failures, 6) as share from reasons r join fails using (rule_set)")
def q_reason_share(t: Tables) -> DataFrame:
    rows = masked(t)
    out = masks.reason_shares(masks.reason_counts(rows, SETS), masks.failure_counts(rows, SETS))
    return out.withColumn("share", F.round("share", 6))


@query(
    "q_reason_totals",
    WITH + " select reason, sum(count)::bigint as total_count from reasons group by 1",
)
def q_reason_totals(t: Tables) -> DataFrame:
    return masks.reason_totals(masks.reason_counts(masked(t), SETS))


@query("q_top30", WITH + " select reason, sum(count)::bigint as total_count from reasons group by 1 order by 2 desc, 1 limit 30")
def q_top30(t: Tables) -> DataFrame:
    return masks.top_reasons(masks.reason_counts(masked(t), SETS), 30)


@query("q_top3_reasons", WITH + " select reason, sum(count)::bigint as total_count from reasons group by 1 order by 2 desc, 1 limit 3")
def q_top3_reasons(t: Tables) -> DataFrame:
    return masks.top_reasons(masks.reason_counts(masked(t), SETS), 3)


@query(
    "q_rule_summary",
    WITH
    + f""", f as ({FAILURES_SQL}), r as (select *, row_number() over (partition by rule_set order by count desc, reason) as rn from reasons)
       select f.rule_set, f.failures, f.total, f.percentage, coalesce(count(rn), 0) as unique_reasons, """
    + ", ".join(
        f"max(reason) filter (rn = {i}) as top_reason_{i}, max(count) filter (rn = {i}) as top_reason_{i}_count, "
        f"round(100.0 * max(count) filter (rn = {i}) / f.failures, 6) as top_reason_{i}_percentage"
        for i in range(1, 6)
    )
    + " from f left join r on f.rule_set = r.rule_set group by f.rule_set, f.failures, f.total, f.percentage",
)
def q_rule_summary(t: Tables) -> DataFrame:
    rows = written(masked(t).select(*[f"{k}_{s}" for k in ("pass", "reasons") for s in SETS]), "masks")
    out = masks.rule_summary(masks.reason_counts(rows, SETS), masks.failure_counts(rows, SETS))
    return out.withColumns({c: F.round(c, 6) for c in out.columns if c.endswith("percentage")})


@query(
    "q_survivor_counts",
    WITH + " " + " union all ".join(f"select source, '{s}' as rule_set, count(*) filter (pass_{s}) as survivors from m group by 1" for s in SETS),
)
def q_survivor_counts(t: Tables) -> DataFrame:
    return masks.survivor_counts(masked(t), "source", SETS)


@query(
    "q_ratio_counts",
    WITH
    + """ select source, num_mol, round_even(num_mol * r, 0)::bigint as all_banned_ratio_failed, num_mol - round_even(num_mol * r, 0)::bigint as passed,
       round_even((1 - r) * 100, 1) as pass_rate from (select source, count(*) as num_mol, 1 - avg(pass::int) as r from m group by 1)""",
)
def q_ratio_counts(t: Tables) -> DataFrame:
    stats = masks.mask_stats(masked(t), "source", SETS)
    out = masks.counts_from_ratios(stats, ["all_banned_ratio"], "all_banned_ratio")
    return out.select("source", "num_mol", "all_banned_ratio_failed", "passed", "pass_rate")


@query(
    "q_banned_ratio",
    WITH + " select lang, round(avg(r), 6) as banned_ratio from (select lang, source, 1 - avg(pass::int) as r from m group by 1, 2) group by 1",
)
def q_banned_ratio(t: Tables) -> DataFrame:
    per = masked(t).groupBy("lang", "source").agg((1 - masks.share(F.col("pass"))).alias("banned_ratio"))
    return masks.banned_ratio(per, "lang").withColumn("banned_ratio", F.round("banned_ratio", 6))


@query(
    "q_banned_counts",
    WITH + " select lang, round(count(*) filter (not pass) / count(*), 6) as banned_ratio from m group by 1",
)
def q_banned_counts(t: Tables) -> DataFrame:
    per = masked(t).groupBy("lang", "source").agg(
        F.count_if(~F.col("pass")).alias("failed_count"), F.count(F.lit(1)).alias("total_count")
    )
    return masks.banned_ratio(per, "lang").withColumn("banned_ratio", F.round("banned_ratio", 6))


@query(
    "q_matrix",
    WITH
    + """ select description as rule, """
    + ", ".join(f"count(*) filter (lang = '{x}') as n_{x}" for x in ("en", "fr", "de", "es"))
    + " from hits group by 1",
)
def q_matrix(t: Tables) -> DataFrame:
    hits = rule_hits(matched(t), ["lang"]).withColumnRenamed("description", "rule")
    return masks.matrix(hits, "rule", "lang", ["en", "fr", "de", "es"], F.count(F.lit(1)), "n_")


@query(
    "q_pose_masks",
    """with p as (select *, l_discount <= 0.08 as b, case when l_tax < 0.08 then l_quantity > 10 end as q, l_discount <= 0.08 and coalesce(l_tax < 0.08 and l_quantity > 10, false) as ok from lineitem),
       u as (select 'all' as filter, count(*) filter (ok) as passed, count(*) as total from p union all
         select 'box', count(*) filter (b), count(b) from p union all select 'quality', count(*) filter (q), count(q) from p)
       select *, round_even(100.0 * passed / total, 1) as pass_rate from u""",
)
def q_pose_masks(t: Tables) -> DataFrame:
    return masks.pose_mask_summary(pose_flags(t), ["pass_box", "pass_quality"])


def pose_flags(t: Tables) -> DataFrame:
    box = F.col("l_discount") <= 0.08
    quality = F.when(F.col("l_tax") < 0.08, F.col("l_quantity") > 10)
    return t.lineitem.select(
        "l_orderkey", "l_returnflag", box.alias("pass_box"), quality.alias("pass_quality"),
        (box & F.coalesce(quality, F.lit(False))).alias("pass"),
    )


@query(
    "q_pose_groups",
    """with p as (select *, l_discount <= 0.08 and coalesce(l_tax < 0.08 and l_quantity > 10, false) as ok from lineitem)
       select l_returnflag, count(*) as total, count(*) filter (ok) as passed, count(distinct case when ok then l_orderkey end) as unique_passed,
         round_even(100.0 * count(*) filter (ok) / count(*), 1) as pass_rate from p group by 1""",
)
def q_pose_groups(t: Tables) -> DataFrame:
    return masks.pose_group_summary(pose_flags(t), "l_returnflag", "l_orderkey")


@query("q_zero_qc", "select count(*) filter (l_discount = 0) as zero, count(*) as total from lineitem")
def q_zero_qc(t: Tables) -> DataFrame:
    return masks.zero_share(t.lineitem, "l_discount")


@query(
    "q_registry",
    "select p_partkey, p_size between 5 and 40 as pass from part",
)
def q_registry(t: Tables) -> DataFrame:
    from winnow.operators.flags import range_test
    from winnow.operators.plugins import filter_named, register

    register("size", lambda df, conf: df.select("p_partkey", range_test(F.col("p_size"), conf["min"], conf["max"]).alias("pass")))
    return filter_named("size")(t.part, {"min": 5, "max": 40})


# --- identities with missing parts ---------------------------------------------------------------------

GAPS_SQL = "b as (select c_custkey, case when c_custkey % 5 <> 0 then c_mktsegment end as segment, case when c_custkey % 3 <> 0 then c_nationkey::double when c_custkey % 2 = 0 then 'nan'::double end as nation, c_acctbal from customer)"
GAP_KEYS = ["segment", "nation"]


def with_gaps(t: Tables) -> DataFrame:
    """Customers whose segment is missing for some and whose nation is NULL or NaN for some."""
    nation = F.when(F.col("c_custkey") % 3 != 0, F.col("c_nationkey").cast("double")).when(F.col("c_custkey") % 2 == 0, float("nan"))
    return t.customer.select("c_custkey", F.when(F.col("c_custkey") % 5 != 0, F.col("c_mktsegment")).alias("segment"), nation.alias("nation"), "c_acctbal")


@query(
    "q_mask_null_keys",
    f"""with {GAPS_SQL}, k as (select *, case when not isnan(nation) then nation end as n from b),
       m as (select segment, n, arg_max(c_acctbal > 0, c_custkey) as rich from k group by all),
       s as (select segment, arg_max(c_acctbal > 4000, c_custkey) as top from k group by all)
       select k.c_custkey, rich as pass_rich, top as pass_top from k join m on k.segment is not distinct from m.segment and k.n is not distinct from m.n
         join s on k.segment is not distinct from s.segment""",
)
def q_mask_null_keys(t: Tables) -> DataFrame:
    """Masks by (segment, nation) and by segment alone; missing parts of the key match each other."""
    base = with_gaps(t)
    rich = base.select(*GAP_KEYS, (F.col("c_acctbal") > 0).alias("pass"), F.col("c_custkey").alias("ord"))
    top = base.select("segment", (F.col("c_acctbal") > 4000).alias("pass"), F.col("c_custkey").alias("ord"))
    return combine.mask_table(base, {"rich": rich, "top": top}, GAP_KEYS, "ord").select("c_custkey", "pass_rich", "pass_top")


@query(
    "q_failed_null_keys",
    f"""with {GAPS_SQL}, k as (select *, case when not isnan(nation) then nation end as n from b)
       select c_custkey from k where not exists (select 1 from k o where o.c_acctbal > 9000 and o.segment is not distinct from k.segment and o.n is not distinct from k.n)""",
)
def q_failed_null_keys(t: Tables) -> DataFrame:
    base = with_gaps(t)
    return combine.split_failed(base, base.filter("c_acctbal > 9000"), GAP_KEYS).select("c_custkey")
