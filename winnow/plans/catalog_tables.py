"""Queries: identity, dedup, sampling, flags, cascade and report tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from winnow.functions.numbers import ratio
from winnow.functions.text import (
    any_of, clean_token, file_stem, largest_fragment, parse_list, property_key, token_profile, truncate,
    words,
)
from winnow.operators import combine, flags, identity, prep
from winnow.plans import report
from winnow.plans.cascade import Cascade, Stage, snapshot
from winnow.plans.registry import Tables, query
from winnow.session import shared_folder
from winnow.sources import records
from winnow.sources.stages import latest_stage, manifest

PART_BOUNDS = {"p_size": (5, 40), "p_retailprice": (905, None)}

RANGE_SQL = """coalesce(p_size between 5 and 40, false) as p_size_pass,
 coalesce(p_retailprice >= 905, false) as p_retailprice_pass"""


@query("q_range_flags", f"select p_partkey, {RANGE_SQL}, p_size between 5 and 40 and p_retailprice >= 905 as pass from part")
def q_range_flags(t: Tables) -> DataFrame:
    flagged = flags.range_flags(t.part, PART_BOUNDS)
    cols = [f"{c}_pass" for c in PART_BOUNDS]
    return flagged.select("p_partkey", *cols, flags.all_flags(cols).alias("pass"))


@query("q_failed_anti", "select p_partkey, p_brand, p_size from part where not (p_size between 5 and 40 and p_retailprice >= 905)")
def q_failed_anti(t: Tables) -> DataFrame:
    passed = flags.range_filter(t.part, PART_BOUNDS)
    return combine.split_failed(t.part, passed, ["p_partkey"]).select("p_partkey", "p_brand", "p_size")


@query(
    "q_drop_exempt",
    "select p_partkey from part where p_retailprice >= 905",
)
def q_drop_exempt(t: Tables) -> DataFrame:
    return flags.drop_failing(flags.range_flags(t.part, PART_BOUNDS), exempt=["p_size_pass"]).select("p_partkey")


@query("q_dedup_group", "select min(doc_id) as doc_id, source from documents group by text, source")
def q_dedup_group(t: Tables) -> DataFrame:
    kept, _ = identity.dedup(t.documents, ["text", "source"], "doc_id", digest="text")
    return kept.select("doc_id", "source")


@query(
    "q_dedup_removed",
    """select doc_id, source from (select doc_id, source, row_number() over (partition by text order by doc_id) as rn
       from documents) where rn > 1""",
)
def q_dedup_removed(t: Tables) -> DataFrame:
    _, removed = identity.dedup(t.documents, ["text"], "doc_id", digest="text")
    return removed.select("doc_id", "source")


INDEX_SQL = """with f as (select c_mktsegment, min(c_custkey) as k from customer group by 1),
       n as (select c_mktsegment, row_number() over (order by k) as g from f)
       select c_custkey, format('LP-{:04d}-{:05d}', g, row_number() over (partition by c_mktsegment order by c_custkey))
         as candidate_idx from customer join n using (c_mktsegment)"""


@query("q_index", INDEX_SQL)
def q_index(t: Tables) -> DataFrame:
    return identity.assign_index(t.customer, "c_mktsegment", "c_custkey").select("c_custkey", "candidate_idx")


@query("q_index_cut", INDEX_SQL)
def q_index_cut(t: Tables) -> DataFrame:
    """The same index the way large groups get it."""
    out = identity.assign_index(t.customer, "c_mktsegment", "c_custkey", in_task=100)
    return out.select("c_custkey", "candidate_idx")


@query(
    "q_group_map",
    """with f as (select c_mktsegment, min(c_custkey) as k from customer group by 1)
       select c_mktsegment, format('LP-{:04d}-00001', row_number() over (order by k)) as first_idx,
         cast(row_number() over (order by k) as integer) as group_number from f""",
)
def q_group_map(t: Tables) -> DataFrame:
    indexed = identity.assign_index(t.customer, "c_mktsegment", "c_custkey")
    return identity.group_map(indexed, "c_mktsegment", "candidate_idx", "c_custkey")


@query(
    "q_sample_n",
    """select o_orderkey, o_orderpriority from (select *, row_number() over (partition by o_orderpriority
       order by md5('42:' || o_orderkey), o_orderkey) as rn from orders) where rn <= 50""",
)
def q_sample_n(t: Tables) -> DataFrame:
    sample, _ = identity.sample_per_group(t.orders, ["o_orderpriority"], "o_orderkey", 50)
    return sample.select("o_orderkey", "o_orderpriority")


@query(
    "q_sample_large",
    """select o_orderkey, o_orderpriority from (select *, row_number() over (partition by o_orderpriority
       order by md5('7:' || o_orderkey), o_orderkey) as rn from orders) where rn <= 1500""",
)
def q_sample_large(t: Tables) -> DataFrame:
    sample, _ = identity.sample_per_group(t.orders, ["o_orderpriority"], "o_orderkey", 1500, seed=7)
    return sample.select("o_orderkey", "o_orderpriority")


@query(
    "q_sample_shortage",
    """select c_nationkey, cast(60 as bigint) as requested, count(*) as available from customer
       group by 1 having count(*) < 60""",
)
def q_sample_shortage(t: Tables) -> DataFrame:
    return identity.sample_per_group(t.customer, ["c_nationkey"], "c_custkey", 60)[1]


@query(
    "q_head_n",
    """select o_orderkey, o_orderpriority from (select *, row_number() over (partition by o_orderpriority
       order by o_orderkey) as rn from orders) where rn <= 20""",
)
def q_head_n(t: Tables) -> DataFrame:
    return identity.head_per_group(t.orders, ["o_orderpriority"], ["o_orderkey"], 20).select("o_orderkey", "o_orderpriority")


@query("q_head_all", "select o_orderkey from orders order by o_orderkey limit 25")
def q_head_all(t: Tables) -> DataFrame:
    return identity.head_per_group(t.orders, [], ["o_orderkey"], 25).select("o_orderkey")


@query(
    "q_keep_last",
    """select o_custkey, max(o_orderkey) as o_orderkey from orders group by 1""",
)
def q_keep_last(t: Tables) -> DataFrame:
    return identity.keep_last(t.orders, ["o_custkey"], "o_orderkey").select("o_custkey", "o_orderkey")


@query(
    "q_first_in_group",
    """select o_orderpriority, arg_min(o_totalprice, o_orderkey) as first_price from orders group by 1""",
)
def q_first_in_group(t: Tables) -> DataFrame:
    first = identity.keep_first(t.orders, ["o_orderpriority"], ["o_orderkey"])
    return first.select("o_orderpriority", F.col("o_totalprice").alias("first_price"))


@query("q_aliases", "select p_partkey as id, p_brand as model_name, p_name as smiles from part")
def q_aliases(t: Tables) -> DataFrame:
    upper = t.part.withColumnsRenamed({c: c.upper() for c in t.part.columns})
    names = {"id": ["p_partkey"], "model_name": ["name", "p_brand"], "smiles": ["p_name"]}
    return identity.resolve_columns(upper, names).select("id", "model_name", "smiles")


@query("q_ordered_cols", f"select p_partkey, p_brand, p_name, p_retailprice, {RANGE_SQL}, p_size, p_type from part")
def q_ordered_cols(t: Tables) -> DataFrame:
    return identity.order_columns(flags.range_flags(t.part, PART_BOUNDS), ["p_partkey", "p_brand"])


@query(
    "q_group_detect",
    "select count(distinct p_brand) > 1 as many_groups, count(distinct p_brand) as n_groups from part",
)
def q_group_detect(t: Tables) -> DataFrame:
    many = identity.has_many_groups(t.part, "p_brand")
    return t.part.agg(F.lit(many).alias("many_groups"), F.countDistinct("p_brand").alias("n_groups"))


RECORD_SQL = """r as (select vec_id, label, list_transform(range(0, 3), lambda k: [round(10.0::double * embedding[3 * k + 1]::double, 2),
  round(10.0::double * embedding[3 * k + 2]::double, 2), round(10.0::double * embedding[3 * k + 3]::double, 2)]) as atoms from embeddings)"""


def coordinate_lines(vector, template: str):
    """Three lines of fixed-width coordinates with two decimals from the first numbers of a vector."""
    def line(k):
        xyz = [F.format_string("%8.2f", F.round(F.get(vector, k * 3 + j).cast("double") * 10.0, 2)) for j in range(3)]
        return F.format_string(template, *xyz)

    return F.transform(F.sequence(F.lit(0), F.lit(2)), line)


@query(
    "q_records",
    f"""with {RECORD_SQL} select 'vec ' || vec_id as name, label::double / 4 as affinity, 'first line' || chr(10) || 'label ' || label as note, len(atoms) as n_atoms,
       round(atoms[1][1] + atoms[2][2] + atoms[3][3], 2) as trace from r""",
)
def q_records(t: Tables) -> DataFrame:
    """Vectors written as pose records with CRLF line ends and a property of two lines, then read as the reader does."""
    atoms = F.array_join(coordinate_lines(F.col("embedding"), "  %s  %s  %s C   0  0  0"), "\r\n")
    head = F.concat(F.lit("\r\nvec "), "vec_id", F.lit("\r\n  made\r\n\r\n  3  0  0  0  0  0  0  0  0  0999 V2000\r\n"))
    fields = F.concat(
        F.lit("\r\nM  END\r\n> <affinity>\r\n"), (F.col("label").cast("double") / 4).cast("string"),
        F.lit("\r\n\r\n> <note>\r\nfirst line\r\nlabel "), "label", F.lit("\r\n\r\n"),
    )
    parsed = records.record_columns(t.embeddings.select(F.concat(head, atoms, fields).alias("record")), "record")
    trace = F.col("atoms")[0]["x"] + F.col("atoms")[1]["y"] + F.col("atoms")[2]["z"]
    affinity = records.first_number(F.col("props"), ["score", "affinity"])
    return parsed.select("name", affinity.alias("affinity"), F.col("props")["note"].alias("note"), F.size("atoms").cast("long").alias("n_atoms"), F.round(trace, 2).alias("trace"))


@query(
    "q_sites",
    f"""with {RECORD_SQL} select vec_id, 'C' as element, unnest(list_transform(atoms, lambda a: round(a[1] + a[2] + a[3], 2))) as total from r""",
)
def q_sites(t: Tables) -> DataFrame:
    """Vectors written as fixed-width atom lines, then read as the site reader does."""
    lines = coordinate_lines(F.col("embedding"), "ATOM      1  CA  MET A   1    %s%s%s  1.00  0.00           C  ")
    rows = t.embeddings.select("vec_id", F.explode(F.concat(lines, F.array(F.lit("HEADER    X"), F.lit("ATOM      2  CB  MET A   1      xx.xxx")))).alias("line"))
    return records.site_columns(rows, "line").select("vec_id", "element", F.round(F.col("x") + F.col("y") + F.col("z"), 2).alias("total"))


@query(
    "q_union_by_name",
    """select c_custkey as key, c_name as name, c_acctbal as bal, c_mktsegment as segment from customer
       union all select s_suppkey, s_name, s_acctbal, null from supplier""",
)
def q_union_by_name(t: Tables) -> DataFrame:
    a = t.customer.select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("bal"),
        F.col("c_mktsegment").alias("segment"),
    )
    b = t.supplier.select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("bal"))
    return combine.union_all(a, b)


@query("q_group_union", "select c_nationkey as nation from customer union select s_nationkey from supplier")
def q_group_union(t: Tables) -> DataFrame:
    a = t.customer.withColumnRenamed("c_nationkey", "nation")
    return identity.groups(a, t.supplier.withColumnRenamed("s_nationkey", "nation"), group="nation")


@query("q_group_intersect", "select c_nationkey as nation from customer intersect select s_nationkey from supplier")
def q_group_intersect(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_nationkey").alias("nation")).intersect(t.supplier.select("s_nationkey"))


# --- text and row checks ------------------------------------------------------------------------


@query(
    "q_missing_tokens",
    """with w as (select doc_id, unnest(string_split(text, ' ')) as w from documents)
       select doc_id, sum(case when lower(trim(w)) in ('', 'nan', 'none') then 1 else 0 end)::bigint as missing,
       count(*) as total from w group by 1""",
)
def q_missing_tokens(t: Tables) -> DataFrame:
    tokens = F.split("text", " ")
    missing = F.size(F.filter(tokens, lambda w: clean_token(w).isNull()))
    return t.documents.select("doc_id", missing.cast("long").alias("missing"), F.size(tokens).cast("long").alias("total"))


@query(
    "q_strings",
    """select page_id, split_part(list_last(string_split(url, '/')), '.', 1) as stem,
       case when length(url) > 20 then left(url, 17) || '...' else url end as short_url,
       contains(lower(html), 'cookie') or contains(lower(html), 'subscribe') as has_notice,
       replace(url, '/', '') as flat_url from pages""",
)
def q_strings(t: Tables) -> DataFrame:
    return t.pages.select(
        "page_id",
        file_stem(F.col("url")).alias("stem"),
        truncate(F.col("url"), 20).alias("short_url"),
        any_of(F.col("html"), ["Cookie", "Subscribe"]).alias("has_notice"),
        property_key(F.translate("url", "/", "\\")).alias("flat_url"),
    )


TOKEN = r"\[[^\]]*\]|Br|Cl|[BCNOPSFI]|[bcnops]"


@query(
    "q_token_profile",
    f"""with a as (select doc_id, text, list_filter(regexp_extract_all(text, '{TOKEN}'),
         lambda x: not regexp_matches(x, '^\\[[0-9]*H[0-9+\\-]*\\]$')) as t from documents),
       s as (select *, list_transform(t, lambda x: case when x[1] <> '[' then x
         when lower(regexp_extract(x, '^\\[[0-9]*([A-Za-z][a-z]?)', 1)) in ('br','cl','si','se','as','na','li','mg','al',
           'ca','fe','zn','cu','sn','pt','pd','te','ge') then regexp_extract(x, '^\\[[0-9]*([A-Za-z][a-z]?)', 1)
         else left(regexp_extract(x, '^\\[[0-9]*([A-Za-z][a-z]?)', 1), 1) end) as y from a),
       c as (select doc_id, len(t)::bigint as heavy_atoms,
         len(list_filter(y, lambda x: upper(x) = 'N'))::bigint as n_nitrogen,
         len(list_filter(y, lambda x: upper(x) = 'S'))::bigint as n_sulfur,
         len(list_filter(y, lambda x: upper(x) <> 'C'))::bigint as hetero_atoms,
         len(list_filter(y, lambda x: x in ('b','c','n','o','p','s','se','as')))::bigint as n_aromatic,
         len(list_filter(y, lambda x: lower(x) in ('f','cl','br','i')))::bigint as n_halogen,
         len(list_filter(t, lambda x: regexp_matches(x, '^\\[[^\\]]*[+\\-]'))) > 0 as has_charge,
         len(list_filter(t, lambda x: regexp_matches(x, '^\\[[0-9]+'))) > 0 as has_isotope,
         len(list_filter(string_split(text, '.'), lambda x: x <> ''))::bigint as n_fragments,
         (len(regexp_extract_all(regexp_replace(text, '\\[[^\\]]*\\]', '', 'g'), '%[0-9][0-9]|[0-9]')) // 2)::bigint as n_rings
         from s)
       select *, greatest(heavy_atoms - n_fragments + n_rings, 0)::bigint as n_bonds from c""",
)
def q_token_profile(t: Tables) -> DataFrame:
    return token_profile(t.documents, "text").select(
        "doc_id", "heavy_atoms", "n_nitrogen", "n_sulfur", "hetero_atoms", "n_aromatic", "n_halogen", "has_charge",
        "has_isotope", "n_fragments", "n_rings", "n_bonds",
    )


@query(
    "q_largest_fragment",
    f"""with f as (select doc_id, unnest(string_split(trim(text), '.')) as frag,
         generate_subscripts(string_split(trim(text), '.'), 1) as pos from documents),
       r as (select *, row_number() over (partition by doc_id order by len(regexp_extract_all(frag, '{TOKEN}')) desc, pos) as rn from f)
       select doc_id, frag from r where rn = 1""",
)
def q_largest_fragment(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", largest_fragment(F.col("text")).alias("frag"))


def _document_checks():
    text = F.col("text")
    return [
        (text.contains("###"), "marker_run", "filters"),
        (text.rlike("[0-9]{6,}"), "long_number", "filters"),
        (text.contains("License"), "license_line", "filters"),
        (F.length(text) < 40, "too_short", "length"),
    ]


CHECK_SQL = """case when contains(text, '###') then 'marker_run' when regexp_matches(text, '[0-9]{6,}') then 'long_number'
  when contains(text, 'License') then 'license_line' when length(text) < 40 then 'too_short' end"""


@query(
    "q_first_failure",
    f"""select doc_id, reason, case when reason = 'too_short' then 'length' when reason is not null then 'filters' end as step
       from (select doc_id, {CHECK_SQL} as reason from documents)""",
)
def q_first_failure(t: Tables) -> DataFrame:
    return prep.first_failure(t.documents, _document_checks()).select("doc_id", "reason", "step")


@query(
    "q_strict_rules",
    """select doc_id, case when regexp_matches(text, '[0-9]') then 'disallowed_atoms' when contains(text, '***') then 'radicals'
         when contains(text, '&&&') then 'isotopes' when contains(text, '+') then 'charged'
         when len(string_split(text, '.')) > 50 then 'multifragment' end as reason from documents""",
)
def q_strict_rules(t: Tables) -> DataFrame:
    text = F.col("text")
    digits = F.regexp_extract_all(text, F.lit("[0-9]"), 0)
    many = F.when(F.size(F.split("text", r"\.")) > 50, 2).otherwise(1)
    rules = prep.strict_rules(digits, [""], text.contains("***"), text.contains("&&&"), text.contains("+"), many)
    return prep.first_failure(t.documents, rules).select("doc_id", "reason")


@query(
    "q_prep_metrics",
    f"""with c as (select text, {CHECK_SQL} as reason from documents),
       s as (select count(*) as rows_in, count(*) filter (reason is null) as passed, count(reason) as failed,
         count(*) filter (reason is null) - count(distinct case when reason is null then text end) as dedup_removed from c),
       j as (select string_agg('"' || reason || '":' || n, ',' order by reason) as body
         from (select reason, count(*) as n from c where reason is not null group by 1))
       select s.*, '{{' || body || '}}' as failures_by_reason from s, j""",
)
def q_prep_metrics(t: Tables) -> DataFrame:
    docs = t.documents.select("text", F.sha2("text", 256).alias("digest"))
    return prep.prep_metrics(prep.first_failure(docs, _document_checks()), ["digest"])


@query(
    "q_ratios",
    """with c as (select doc_id, len(regexp_extract_all(text, '[0-9]')) as d, len(regexp_extract_all(text, '[aeiou]')) as v,
         len(regexp_extract_all(text, '[A-Za-z]')) as n from documents)
       select doc_id, round(case when n > 0 then d / n else 0 end, 6) as digit_ratio,
         round(case when n > 0 then (d + v) / n else 0 end, 6) as vowel_digit_ratio from c""",
)
def q_ratios(t: Tables) -> DataFrame:
    def n(pattern: str):
        return F.size(F.regexp_extract_all("text", F.lit(pattern), 0))

    counts = t.documents.select("doc_id", n("[0-9]").alias("d"), n("[aeiou]").alias("v"), n("[A-Za-z]").alias("n"))
    return counts.select(
        "doc_id",
        F.round(ratio(F.col("d"), F.col("n")), 6).alias("digit_ratio"),
        F.round(ratio(F.col("d") + F.col("v"), F.col("n")), 6).alias("vowel_digit_ratio"),
    )


@query(
    "q_array_flags",
    """with w as (select doc_id, list_transform(regexp_extract_all(text, '[^ \\t\\r\\n]+'), lambda x: length(x)) as a from documents)
       select doc_id, coalesce(list_max(a) <= 14, true) as lengths_pass,
         coalesce(list_bool_and(list_transform(a, lambda x: x % 40 <= 30)), true) as kinds_pass from w""",
)
def q_array_flags(t: Tables) -> DataFrame:
    lengths = F.transform(words(F.col("text")), lambda w: F.length(w))
    rows = t.documents.select(
        "doc_id", lengths.alias("lengths"), F.transform(lengths, lambda n: (n % 40).cast("string")).alias("kinds")
    )
    out = flags.range_flags(
        rows, {}, allowed={"kinds": [str(i) for i in range(31)]}, elements={"lengths": (None, 14)}
    )
    return out.select("doc_id", "lengths_pass", "kinds_pass")


@query(
    "q_gate",
    """select doc_id, true as open_pass, coalesce(toxic = 1, false) as closed_pass from documents left join labels using (doc_id)""",
)
def q_gate(t: Tables) -> DataFrame:
    rows = t.documents.join(t.labels, "doc_id", "left").select(
        "doc_id", F.col("toxic").cast("boolean").alias("open"), F.col("toxic").cast("boolean").alias("closed")
    )
    out = flags.range_flags(rows, {}, gates={"open": True, "closed": False})
    return out.select("doc_id", "open_pass", "closed_pass")


@query(
    "q_literal_list",
    """select p_partkey, len(string_split(p_name, ' '))::bigint as n_items, string_split(p_name, ' ')[1] as first_item,
       0::bigint as n_bad from part""",
)
def q_literal_list(t: Tables) -> DataFrame:
    literal = F.concat(F.lit("['"), F.replace("p_name", F.lit(" "), F.lit("', '")), F.lit("']"))
    items = parse_list(literal)
    bad = parse_list(F.concat(F.lit("not a list "), F.col("p_name")))
    return t.part.select(
        "p_partkey",
        F.size(items).cast("long").alias("n_items"),
        F.get(items, F.lit(0)).alias("first_item"),
        F.size(bad).cast("long").alias("n_bad"),
    )


@query(
    "q_severity",
    """select l_linenumber, count(*) as n, """
    + ", ".join(f"count(*) filter (l_linenumber < {s}) as passed_{s}" for s in range(1, 12))
    + """, count(*) filter (l_linenumber < 1) as passed_all, count(*) filter (l_linenumber - 1 = 0) as passed_zero
       from lineitem group by 1""",
)
def q_severity(t: Tables) -> DataFrame:
    rows = flags.severity_flags(t.lineitem.select("l_linenumber"), "l_linenumber")
    demerit = rows.withColumnRenamed("pass", "pass_levels").withColumn("demerit", F.col("l_linenumber") - 1)
    gated = flags.zero_gate(demerit, "demerit")
    return gated.groupBy("l_linenumber").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col(f"pass_{s}")).alias(f"passed_{s}") for s in range(1, 12)],
        F.count_if("pass_levels").alias("passed_all"),
        F.count_if("pass").alias("passed_zero"),
    )


@query(
    "q_count_gate",
    """with c as (select l_orderkey, count(*) filter (l_returnflag = 'R') as r, count(*) filter (l_returnflag = 'A') as a,
       count(*) filter (l_returnflag = 'N') as n from lineitem group by 1)
       select l_orderkey, r <= 3 and a <= 2 and n <= 2 as pass from c""",
)
def q_count_gate(t: Tables) -> DataFrame:
    flag = F.col("l_returnflag")
    counts = t.lineitem.groupBy("l_orderkey").agg(
        F.count_if(flag == "R").alias("n_F"), F.count_if(flag == "A").alias("n_Br"), F.count_if(flag == "N").alias("n_Cl")
    )
    return counts.select("l_orderkey", flags.count_gate({"n_F": 3, "n_Br": 2, "n_Cl": 2}).alias("pass"))


@query(
    "q_element_gate",
    f"""with a as (select doc_id, list_filter(regexp_extract_all(text, '{TOKEN}'),
         lambda x: not regexp_matches(x, '^\\[[0-9]*H[0-9+\\-]*\\]$')) as t from documents),
       s as (select *, list_transform(t, lambda x: case when x[1] <> '[' then x
         when lower(regexp_extract(x, '^\\[[0-9]*([A-Za-z][a-z]?)', 1)) in ('br','cl','si','se','as','na','li','mg','al',
           'ca','fe','zn','cu','sn','pt','pd','te','ge') then regexp_extract(x, '^\\[[0-9]*([A-Za-z][a-z]?)', 1)
         else left(regexp_extract(x, '^\\[[0-9]*([A-Za-z][a-z]?)', 1), 1) end) as y from a),
       c as (select doc_id, len(list_filter(y, lambda x: lower(x) = 'f'))::bigint as "n_F", len(list_filter(y, lambda x: lower(x) = 'cl'))::bigint as "n_Cl",
         len(list_filter(y, lambda x: lower(x) = 'br'))::bigint as "n_Br", len(list_filter(t, lambda x: contains(x, '@')))::bigint as n_stereo from s)
       select *, "n_F" <= 6 and "n_Br" <= 3 and "n_Cl" <= 3 and n_stereo <= 4 as pass from c""",
)
def q_element_gate(t: Tables) -> DataFrame:
    """Halogens and marked stereo centres of a text against the default limits."""
    limits = flags.HALOGEN_LIMITS | {"n_stereo": flags.STEREO_LIMITS["n_stereo"]}
    counts = token_profile(t.documents.select("doc_id", "text"), "text").select("doc_id", "n_F", "n_Cl", "n_Br", "n_stereo")
    return counts.withColumn("pass", flags.count_gate(limits))


# --- cascade ------------------------------------------------------------------------------------

STAGES = ("size", "price", "kind")


def cascade() -> Cascade:
    return Cascade(
        [
            Stage("size", flags.range_predicate(F.col("p_size"), 5, 40)),
            Stage("price", flags.range_predicate(F.col("p_retailprice"), 905, "inf")),
            Stage("unused", F.lit(False), enabled=False),
            Stage("kind", F.col("p_type") != "ECONOMY", ends_run=True),
        ]
    )


def staged(t: Tables) -> DataFrame:
    return cascade().annotate(t.part)


STAGED_SQL = """select *, case when not coalesce(p_size between 5 and 40, false) then 'size'
   when not coalesce(p_retailprice >= 905, false) then 'price' when p_type = 'ECONOMY' then 'kind' end as failed_stage from part"""
FUNNEL_SQL = f"""with s as ({STAGED_SQL}),
  g as (select coalesce(p_brand, '(all)') as p_brand, count(*) as n0, count(*) filter (failed_stage = 'size') as f1,
    count(*) filter (failed_stage = 'price') as f2, count(*) filter (failed_stage = 'kind') as f3
    from s group by grouping sets ((p_brand), ())),
  f as (select p_brand, 0 as position, 'Initial' as stage, n0 as count from g union all
    select p_brand, 1, 'size', n0 - f1 from g union all select p_brand, 2, 'price', n0 - f1 - f2 from g union all
    select p_brand, 3, 'kind', n0 - f1 - f2 - f3 from g)"""


@query(
    "q_cascade",
    f"""select p_partkey, failed_stage, failed_stage is distinct from 'size' as pass_size,
       case when failed_stage is distinct from 'size' then failed_stage is distinct from 'price' end as pass_price,
       case when failed_stage is null or failed_stage = 'kind' then failed_stage is null end as pass_kind from ({STAGED_SQL})""",
)
def q_cascade(t: Tables) -> DataFrame:
    return staged(t).select("p_partkey", "failed_stage", *[f"pass_{s}" for s in STAGES])


@query("q_survivors", f"select p_partkey from ({STAGED_SQL}) where failed_stage is null")
def q_survivors(t: Tables) -> DataFrame:
    return cascade().survivors(t.part).select("p_partkey")


@query("q_funnel", FUNNEL_SQL + " select * from f")
def q_funnel(t: Tables) -> DataFrame:
    return report.funnel(staged(t), STAGES, "p_brand")


@query(
    "q_flow",
    FUNNEL_SQL
    + """, l as (select *, lag(stage) over w as source, lag(count) over w as prev, first_value(count) over w as n0 from f
         window w as (partition by p_brand order by position)),
       k as (select p_brand, position, source, stage as target, count as value, n0 from l where source is not null union all
         select p_brand, position, source, 'Lost (' || stage || ')', prev - count, n0 from l where source is not null and prev > count)
       select p_brand, position, source, target, value, round(100.0 * value / n0, 6) as pct_of_initial from k""",
)
def q_flow(t: Tables) -> DataFrame:
    links = report.flow_links(report.funnel(staged(t), STAGES, "p_brand"), "p_brand")
    return links.withColumn("pct_of_initial", F.round("pct_of_initial", 6))


@query(
    "q_stage_stats",
    FUNNEL_SQL
    + """, a as (select * from g where p_brand = '(all)'), u as (select 'size' as stage, n0 - f1 as passed, f1 as failed from a union all
       select 'price', n0 - f1 - f2, f2 from a union all select 'kind', n0 - f1 - f2 - f3, f3 from a)
       select *, passed + failed as total from u where passed + failed > 0""",
)
def q_stage_stats(t: Tables) -> DataFrame:
    return report.stage_stats(staged(t), STAGES)


@query(
    "q_retention",
    f"""select initial, final, round(final / initial, 6) as rate, format('{{:.1f}}%', 100.0 * final / initial) as rate_text
       from (select count(*) as initial, count(*) filter (failed_stage is null) as final from ({STAGED_SQL}))""",
)
def q_retention(t: Tables) -> DataFrame:
    return report.retention(staged(t)).withColumn("rate", F.round("rate", 6))


@query(
    "q_scorecard",
    f"""select p_brand, count(*) as initial, count(*) filter (failed_stage is null) as final,
       count(*) filter (failed_stage = 'size') as lost_size, count(*) filter (failed_stage = 'price') as lost_price,
       count(*) filter (failed_stage = 'kind') as lost_kind,
       round(100.0 * count(*) filter (failed_stage is null) / count(*), 6) as retention_pct from ({STAGED_SQL}) group by 1""",
)
def q_scorecard(t: Tables) -> DataFrame:
    return report.scorecard(staged(t), STAGES, "p_brand").withColumn("retention_pct", F.round("retention_pct", 6))


def stage_table(t: Tables) -> DataFrame:
    """Survivors of every stage as one table, the form the stage table has on disk."""
    rows = staged(t)
    reached = F.when(F.col("failed_stage").isNull(), 3)
    for i, s in enumerate(STAGES):
        reached = reached.when(F.col("failed_stage") == s, i)
    ranks = rows.select("p_partkey", F.explode(F.sequence(F.lit(0), reached)).alias("stage_rank"))
    return ranks.withColumn("stage", F.element_at(F.array(*[F.lit(s) for s in ("input", *STAGES)]), F.col("stage_rank") + 1))


@query(
    "q_stage_manifest",
    f"""with s as ({STAGED_SQL}), n as (select count(*) as n0, count(*) filter (failed_stage = 'size') as f1,
         count(*) filter (failed_stage = 'price') as f2, count(*) filter (failed_stage = 'kind') as f3 from s)
       select 'input' as stage, 0 as stage_rank, n0 as rows, 0::bigint as failed_rows from n union all
       select 'size', 1, n0 - f1, f1 from n union all select 'price', 2, n0 - f1 - f2, f2 from n union all
       select 'kind', 3, n0 - f1 - f2 - f3, f3 from n""",
)
def q_stage_manifest(t: Tables) -> DataFrame:
    """A run is written stage by stage, taken up again, and its manifest read."""
    spark = t.part.sparkSession
    path = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/stages-{uuid.uuid4().hex}"
    cascade().run_to_table(t.part, path, "run-1", ["p_partkey"])
    cascade().run_to_table(t.part, path, "run-1", ["p_partkey"], resume=True)
    return manifest(spark, path).select("stage", "stage_rank", "rows", "failed_rows")


@query(
    "q_latest_stage",
    f"select p_partkey, 'price' as stage from ({STAGED_SQL}) where failed_stage is null or failed_stage = 'kind'",
)
def q_latest_stage(t: Tables) -> DataFrame:
    return latest_stage(stage_table(t), skip=["kind"]).select("p_partkey", "stage")


@query(
    "q_snapshot",
    f"""select p_brand, round(avg(length(p_name)), 6) as mean_len, round(avg(p_size), 6) as mean_size, count(*) as n
       from ({STAGED_SQL}) where failed_stage is null group by 1""",
)
def q_snapshot(t: Tables) -> DataFrame:
    return snapshot(
        cascade().survivors(t.part),
        lambda d: d.groupBy("p_brand").agg(
            F.round(F.avg(F.length("p_name")), 6).alias("mean_len"),
            F.round(F.avg("p_size"), 6).alias("mean_size"),
            F.count(F.lit(1)).alias("n"),
        ),
    )


@query(
    "q_short_circuit",
    "select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice, coalesce(l_discount <= 0.05 and l_quantity * 2 > 30, false) as pass_quality from lineitem",
)
def q_short_circuit(t: Tables) -> DataFrame:
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice"]
    rows = t.lineitem.select(*keys, "l_discount", "l_quantity")

    def quality(df: DataFrame) -> DataFrame:
        def run(batches):
            for b in batches:
                yield b.assign(pass_quality=b["l_quantity"] * 2 > 30)

        schema = ", ".join(f"{n} {k}" for n, k in df.dtypes) + ", pass_quality boolean"
        return df.mapInPandas(run, schema)

    out = combine.short_circuit(rows, keys, F.col("l_discount") <= 0.05, quality, "pass_quality")
    return out.select(*keys, "pass_quality")


@query(
    "q_fail_policy",
    """select doc_id, coalesce(toxic = 0, true) as open_policy, coalesce(quality = 1, false) as closed_policy
       from documents left join labels using (doc_id)""",
)
def q_fail_policy(t: Tables) -> DataFrame:
    rows = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    return rows.select(
        "doc_id",
        combine.fail_policy(F.col("toxic") == 0, F.lit(True)).alias("open_policy"),
        combine.fail_policy(F.col("quality") == 1, F.lit(False)).alias("closed_policy"),
    )

