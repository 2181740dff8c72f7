"""Queries: fingerprints, diversity, geometry, complexity."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from winnow.functions.text import words
from winnow.operators import complexity, fingerprint as fp, geometry as geo
from winnow.plans.registry import Tables, query

BITS = 64

MASK_SQL = """b as (select vec_id, label, list_reduce(list_prepend(0::UBIGINT, list_transform(range(1, 65),
   lambda i: case when embedding[i] > 0 then (1::UBIGINT << (i - 1)) else 0::UBIGINT end)), lambda a, c: a | c) as m from embeddings)"""


def signed(t: Tables) -> DataFrame:
    return t.embeddings.select("vec_id", "label", fp.sign_bits(F.col("embedding")).alias("bits"))


PAIR_SQL = """p as (select x.label, x.vec_id, y.vec_id as other, bit_count(x.m & y.m)::double / bit_count(x.m | y.m) as t from b x join b y on x.label = y.label)"""


@query(
    "q_tanimoto",
    f"""with {MASK_SQL}, {PAIR_SQL} select label, vec_id, round(avg(t) filter (vec_id <> other), 6) as mean_similarity,
       round(max(t) filter (vec_id <> other), 6) as max_similarity from p group by 1, 2""",
)
def q_tanimoto(t: Tables) -> DataFrame:
    out = fp.tanimoto_profile(signed(t), "label", "vec_id", "bits", BITS)
    return out.withColumns({c: F.round(c, 6) for c in ("mean_similarity", "max_similarity")})


@query(
    "q_intdiv",
    f"""with {MASK_SQL}, {PAIR_SQL} select label, count(distinct vec_id) as n, round(1 - avg(t), 6) as int_div1,
       round(1 - sqrt(avg(t * t)), 6) as int_div2 from p group by 1""",
)
def q_intdiv(t: Tables) -> DataFrame:
    out = fp.int_div(signed(t), "label", "vec_id", "bits", BITS)
    return out.withColumns({c: F.round(c, 6) for c in ("int_div1", "int_div2")})


@query(
    "q_intdiv_estimate",
    f"""with {MASK_SQL}, {PAIR_SQL} select label, count(distinct vec_id) as n, count(distinct vec_id) as pairs, true as holds, true as narrow from p group by 1""",
)
def q_intdiv_estimate(t: Tables) -> DataFrame:
    """The estimate's interval holds the exact value, and is narrow: a pair per row, as no group has 100,000 rows."""
    exact = fp.int_div(signed(t), "label", "vec_id", "bits", BITS).select(F.col("label").alias("own"), F.col("int_div1").alias("d1"), F.col("int_div2").alias("d2"))
    found = fp.int_div_estimate(signed(t), "label", "vec_id", "bits", BITS).join(exact, F.col("label") == F.col("own"))
    holds = (F.abs(F.col("int_div1") - F.col("d1")) <= F.col("error1")) & (F.abs(F.col("int_div2") - F.col("d2")) <= F.col("error2"))
    return found.select("label", "n", "pairs", holds.alias("holds"), ((F.col("error1") < 0.15) & (F.col("error2") < 0.15)).alias("narrow"))


@query(
    "q_sediv",
    f"""with recursive {MASK_SQL}, o as (select label, m, row_number() over (partition by label order by vec_id) as i, count(*) over (partition by label) as n from b),
       g as (select label, i, n, [m] as picks from o where i = 1 union all
         select g.label, o.i, o.n, case when len(list_filter(g.picks, lambda q: 1 - bit_count(q & o.m)::double / bit_count(q | o.m) <= 0.65 + 1e-12)) = 0
           then list_append(g.picks, o.m) else g.picks end from g join o on o.label = g.label and o.i = g.i + 1)
       select label, n, len(picks)::bigint as picks, round(len(picks) / n, 6) as se_div from g where i = n""",
)
def q_sediv(t: Tables) -> DataFrame:
    out = fp.sphere_exclusion(signed(t), "label", "vec_id", "bits", BITS)
    return out.withColumn("se_div", F.round("se_div", 6))


@query(
    "q_tanimoto_join",
    f"""with {MASK_SQL}, r as (select m, min(vec_id) as rep, count(*) as copies from b group by 1)
       select x.rep as id_a, y.rep as id_b, round(bit_count(x.m & y.m)::double / bit_count(x.m | y.m), 6) as similarity, x.copies as copies_a, y.copies as copies_b
       from r x join r y on x.rep < y.rep where bit_count(x.m & y.m)::double / bit_count(x.m | y.m) >= 0.5""",
)
def q_tanimoto_join(t: Tables) -> DataFrame:
    out = fp.similar_pairs(signed(t), "vec_id", "bits", 0.5, BITS, method="blocks")
    return out.withColumn("similarity", F.round("similarity", 6))


DOC_BITS = 2048
DOC_BITS_SQL = f"""w as (select distinct doc_id, unnest(regexp_extract_all(text, '[^ \\t\\r\\n]+')) as w from documents),
  d as (select distinct doc_id, ('0x' || left(md5(w), 8))::bigint % {DOC_BITS} as bit from w),
  l as (select doc_id, list_sort(list(bit)) as bits, count(*) as n from d group by 1),
  r as (select bits, min(doc_id) as rep, count(*) as copies, any_value(n) as n from l group by 1),
  e as (select rep, n, copies, unnest(bits) as bit from r)"""


def document_bits(t: Tables) -> DataFrame:
    code = F.transform(F.array_distinct(words(F.col("text"))), lambda w: F.conv(F.substring(F.md5(w), 1, 8), 16, 10).cast("long") % DOC_BITS)
    return t.documents.select("doc_id", code.alias("bits")).filter(F.col("text").rlike("[^ \\t\\r\\n]"))


@query(
    "q_similar_texts",
    f"""with {DOC_BITS_SQL}, p as (select x.rep as id_a, y.rep as id_b, x.copies as copies_a, y.copies as copies_b, count(*) / (x.n + y.n - count(*)) as s
         from e x join e y on x.bit = y.bit and x.rep < y.rep and x.n <= y.n * 1.25 and y.n <= x.n * 1.25 group by x.rep, y.rep, x.copies, y.copies, x.n, y.n)
       select id_a, id_b, round(s, 6) as similarity, copies_a, copies_b from p where s >= 0.8""",
)
def q_similar_texts(t: Tables) -> DataFrame:
    out = fp.similar_pairs(document_bits(t), "doc_id", "bits", 0.8, DOC_BITS, method="groups")
    return out.withColumn("similarity", F.round("similarity", 6))


@query("q_copy_groups", f"with {DOC_BITS_SQL} select doc_id, rep from l join r using (bits)")
def q_copy_groups(t: Tables) -> DataFrame:
    return fp.fingerprint_groups(document_bits(t), "doc_id", "bits")[1]


@query(
    "q_uniq",
    """select source, count(*) as n, round(avg((n_chars > 40)::int), 6) as validity,
       round(count(distinct case when n_chars > 40 then text end) / count(*) filter (n_chars > 40), 6) as uniqueness from documents group by 1""",
)
def q_uniq(t: Tables) -> DataFrame:
    docs = t.documents.select("source", "n_chars", F.sha2("text", 256).alias("digest"))
    out = fp.uniqueness(docs, "source", "digest", F.col("n_chars") > 40)
    return out.withColumns({c: F.round(c, 6) for c in ("validity", "uniqueness")})


SCAFFOLD_SQL = """k as (select source, regexp_extract_all(text, '[^ \\t\\r\\n]+')[1] as key from documents),
  c as (select source, key, count(*) as c from k where key is not null group by 1, 2)"""


def first_words(t: Tables) -> DataFrame:
    return t.documents.select("source", F.get(words(F.col("text")), F.lit(0)).alias("key"))


@query(
    "q_scaff",
    f"""with {SCAFFOLD_SQL} select source, sum(c)::bigint as n, count(*) as distinct_keys, round(count(*) / sum(c), 6) as key_div,
       round(count(*) filter (c = 1) / count(*), 6) as key_uniqueness from c group by 1""",
)
def q_scaff(t: Tables) -> DataFrame:
    return fp.key_diversity(first_words(t), "source", "key").withColumns({c: F.round(c, 6) for c in ("key_div", "key_uniqueness")})


KEYS_SQL = """kw as (select lang, unnest(regexp_extract_all(text, '[^ \\t\\r\\n]+')) as k from documents)"""


@query(
    "q_keys",
    f"with {KEYS_SQL} select lang, count(*) as occurrences, count(distinct k) as distinct_keys, round(count(distinct k) / count(*), 6) as key_div from kw group by 1",
)
def q_keys(t: Tables) -> DataFrame:
    rows = t.documents.select("lang", words(F.col("text")).alias("keys"))
    return fp.array_key_diversity(rows, "lang", "keys").withColumn("key_div", F.round("key_div", 6))


@query(
    "q_set_metrics",
    f"""with {KEYS_SQL}, u as (select lang, count(distinct text) / count(*) as v from documents group by 1),
       k as (select lang, count(distinct k) / count(*) as v from kw group by 1),
       a as (select 'Uniqueness' as metric, * from u union all select 'FG', * from k)
       select metric, """
    + ", ".join(f"round_even(max(v) filter (lang = '{x}'), 4) as {x}" for x in ("de", "en", "es", "fr"))
    + " from a group by 1",
)
def q_set_metrics(t: Tables) -> DataFrame:
    docs = t.documents.select("lang", F.sha2("text", 256).alias("digest"), words(F.col("text")).alias("keys"))
    tables = {
        "Uniqueness": fp.uniqueness(docs, "lang", "digest").select("lang", F.col("uniqueness").alias("value")),
        "FG": fp.array_key_diversity(docs, "lang", "keys").select("lang", F.col("key_div").alias("value")),
        "Validity": fp.uniqueness(docs, "lang", "digest").select("lang", F.col("validity").alias("value")),
    }
    return fp.set_metrics(tables, "lang", keep=["Uniqueness", "FG"], stages=["de", "en", "es", "fr"])


# --- geometry: every vector is a pose of 22 atoms, three dimensions each; the last one is padded with 0 ----

SCALE = 10.0
N_ATOMS = 22


def atoms_of(vector: Column) -> Column:
    """The 64 numbers as 22 carbon atoms."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(N_ATOMS - 1)),
        lambda k: F.struct(
            F.lit("C").alias("element"),
            *[F.coalesce(F.get(vector, k * 3 + j).cast("double") * SCALE, F.lit(0.0)).alias(axis) for j, axis in enumerate("xyz")],
        ),
    )


def vector_poses(t: Tables) -> DataFrame:
    return t.embeddings.select("vec_id", "label", atoms_of(F.col("embedding")).alias("atoms"))


def label_vectors(t: Tables, how) -> DataFrame:
    """One vector per label, dimension by dimension."""
    long = t.embeddings.select("label", F.posexplode("embedding").alias("dim", "x"))
    per = long.groupBy("label", "dim").agg(how(F.col("x").cast("double")).alias("x"))
    ordered = F.array_sort(F.collect_list(F.struct("dim", "x")))
    return per.groupBy("label").agg(F.transform(ordered, lambda s: s["x"]).alias("vector"))


def label_sites(t: Tables) -> DataFrame:
    return label_vectors(t, F.avg).select("label", F.explode(atoms_of(F.col("vector"))).alias("a")).select("label", "a.*")


ATOMS_SQL = """atm as (select vec_id, label, k, 10.0::double * embedding[3 * k + 1]::double as x, coalesce(10.0::double * embedding[3 * k + 2]::double, 0) as y,
    coalesce(10.0::double * embedding[3 * k + 3]::double, 0) as z from embeddings, range(22) r(k)),
  mean as (select label, d, avg(v) as v from (select label, unnest(embedding)::double as v, generate_subscripts(embedding, 1) as d from embeddings) group by 1, 2),
  st as (select label, ((d - 1) // 3)::int as k, 10.0::double * max(v) filter ((d - 1) % 3 = 0) as x, coalesce(10.0::double * max(v) filter ((d - 1) % 3 = 1), 0) as y,
    coalesce(10.0::double * max(v) filter ((d - 1) % 3 = 2), 0) as z from mean group by 1, 2)"""


@query(
    "q_box",
    f"""with {ATOMS_SQL}, bx as (select min(x) - 1 as x0, max(x) + 1 as x1, min(y) - 1 as y0, max(y) + 1 as y1, min(z) - 1 as z0, max(z) + 1 as z1 from st),
       f as (select vec_id, avg((x < x0 or x > x1 or y < y0 or y > y1 or z < z0 or z > z1)::int) as f from atm, bx group by 1)
       select vec_id, round(f, 6) as frac_outside, f <= 0.4 as pass_search_box from f""",
)
def q_box(t: Tables) -> DataFrame:
    box = geo.box_from_points(label_sites(t), margin=1.0)
    out = geo.box_filter(vector_poses(t), "atoms", box, max_outside=0.4)
    return out.select("vec_id", F.round("frac_outside", 6).alias("frac_outside"), "pass_search_box")


CONTACT_SQL = f"""{ATOMS_SQL}, pr as (select vec_id, sqrt((a.x - s.x) ** 2 + (a.y - s.y) ** 2 + (a.z - s.z) ** 2) as d from atm a join st s on a.label = s.label)"""


@query(
    "q_min_dist",
    f"""with {CONTACT_SQL} select vec_id, round(min(d) filter (d <= 0.3), 6) as min_distance, count(*) filter (d <= 0.3) > 0 as pass_near from pr group by 1""",
)
def q_min_dist(t: Tables) -> DataFrame:
    out = geo.site_contacts(vector_poses(t), label_sites(t), "vec_id", "atoms", "label", max_distance=0.3, radii={"C": 0.3})
    return out.select("vec_id", F.round("min_distance", 6).alias("min_distance"), "pass_near")


@query(
    "q_clash",
    f"""with {CONTACT_SQL} select vec_id, count(*) filter (d < 0.75 * 0.6) as clashes, count(*) filter (d < 0.75 * 0.6) = 0 as pass_clash from pr group by 1""",
)
def q_clash(t: Tables) -> DataFrame:
    out = geo.site_contacts(vector_poses(t), label_sites(t), "vec_id", "atoms", "label", max_distance=0.3, radii={"C": 0.3})
    return out.select("vec_id", "clashes", "pass_clash")


@query(
    "q_shape",
    f"""with {ATOMS_SQL}, ab as (select vec_id, a.label, sum(exp(-0.405 * ((a.x - s.x) ** 2 + (a.y - s.y) ** 2 + (a.z - s.z) ** 2))) as v from atm a join st s on a.label = s.label group by 1, 2),
       aa as (select a.vec_id, sum(exp(-0.405 * ((a.x - s.x) ** 2 + (a.y - s.y) ** 2 + (a.z - s.z) ** 2))) as v from atm a join atm s on a.vec_id = s.vec_id group by 1),
       bb as (select a.label, sum(exp(-0.405 * ((a.x - s.x) ** 2 + (a.y - s.y) ** 2 + (a.z - s.z) ** 2))) as v from st a join st s on a.label = s.label group by 1)
       select vec_id, round(ab.v / (aa.v + bb.v - ab.v), 6) as shape_score, ab.v / (aa.v + bb.v - ab.v) >= 0.5 as pass_shape from ab join aa using (vec_id) join bb using (label)""",
)
def q_shape(t: Tables) -> DataFrame:
    reference = label_vectors(t, F.avg).select("label", atoms_of(F.col("vector")).alias("reference"))
    out = geo.shape_similarity(vector_poses(t).join(reference, "label"), "atoms", "reference")
    return out.select("vec_id", F.round("shape_score", 6).alias("shape_score"), "pass_shape")


RMSD_SQL = f"""{ATOMS_SQL},
  cl as (select label, (d - 1) // 3 as k, (d - 1) % 3 as axis, unnest([avg(v), min(v), max(v)]) as v, unnest([1, 2, 3]) as kind
    from (select label, unnest(embedding)::double as v, generate_subscripts(embedding, 1) as d from embeddings) group by label, d),
  cf as (select label, kind, k, 10.0::double * max(v) filter (axis = 0) as x, coalesce(10.0::double * max(v) filter (axis = 1), 0) as y,
    coalesce(10.0::double * max(v) filter (axis = 2), 0) as z from cl group by 1, 2, 3),
  s as (select vec_id, kind, count(*)::double as n, sum(a.x) as px, sum(a.y) as py, sum(a.z) as pz, sum(c.x) as qx, sum(c.y) as qy, sum(c.z) as qz,
    sum(a.x * c.x) as xx, sum(a.x * c.y) as xy, sum(a.x * c.z) as xz, sum(a.y * c.x) as yx, sum(a.y * c.y) as yy, sum(a.y * c.z) as yz,
    sum(a.z * c.x) as zx, sum(a.z * c.y) as zy, sum(a.z * c.z) as zz, sum(a.x * a.x + a.y * a.y + a.z * a.z + c.x * c.x + c.y * c.y + c.z * c.z) as e
    from atm a join cf c on a.label = c.label and a.k = c.k group by 1, 2),
  h as (select vec_id, kind, n, e - (px * px + py * py + pz * pz + qx * qx + qy * qy + qz * qz) / n as e, xx - px * qx / n as xx, xy - px * qy / n as xy, xz - px * qz / n as xz,
    yx - py * qx / n as yx, yy - py * qy / n as yy, yz - py * qz / n as yz, zx - pz * qx / n as zx, zy - pz * qy / n as zy, zz - pz * qz / n as zz from s),
  m as (select *, xx * xx + yx * yx + zx * zx as a, xy * xy + yy * yy + zy * zy as b, xz * xz + yz * yz + zz * zz as c, xx * xy + yx * yy + zx * zy as d,
    xx * xz + yx * yz + zx * zz as f, xy * xz + yy * yz + zy * zz as g, xx * (yy * zz - yz * zy) - xy * (yx * zz - yz * zx) + xz * (yx * zy - yy * zx) as det from h),
  t as (select *, (a + b + c) / 3 as t from m),
  w as (select *, sqrt(((a - t) ** 2 + (b - t) ** 2 + (c - t) ** 2 + 2 * (d * d + f * f + g * g)) / 6) as w from t),
  r as (select *, case when w > 0 then acos(greatest(-1, least(1, ((a - t) / w * ((b - t) / w * (c - t) / w - g / w * g / w) - d / w * (d / w * (c - t) / w - g / w * f / w)
    + f / w * (d / w * g / w - (b - t) / w * f / w)) / 2))) / 3 else 0 end as phi from w),
  l as (select *, t + 2 * w * cos(phi) as l1, t + 2 * w * cos(phi + 2.0943951023931953) as l3 from r),
  o as (select vec_id, sqrt(greatest(e - 2 * (sqrt(greatest(l1, 0)) + sqrt(greatest(3 * t - l1 - l3, 0)) + case when det < 0 then -1 else 1 end * sqrt(greatest(l3, 0))), 0) / n) as d from l)
  select vec_id, round(min(d), 6) as min_rmsd, min(d) <= 2.0 as pass_deviation from o group by 1"""


@query("q_rmsd", f"with {RMSD_SQL}")
def q_rmsd(t: Tables) -> DataFrame:
    """Deviation from three conformers per label: mean, smallest and largest coordinates."""
    conformers = reduce(DataFrame.union, [label_vectors(t, f) for f in (F.avg, F.min, F.max)])
    supplied = conformers.select("label", atoms_of(F.col("vector")).alias("atoms"))
    out = geo.min_rmsd(vector_poses(t), supplied, "vec_id", "label", "atoms", max_rmsd=2.0)
    return out.select("vec_id", F.round("min_rmsd", 6).alias("min_rmsd"), "pass_deviation")


@query(
    "q_interactions",
    """with c as (select user_id, event_type as residue, case (props->>'k')::int % 3 when 0 then 'HBDonor' when 1 then 'HBAcceptor' else 'Hydrophobic' end as kind,
         bool_or(value > 60) as present from events group by all),
       g as (select user_id, count(*) filter (kind like 'HB%') as n_hbonds, string_agg(residue || '.' || kind, ',' order by residue || '.' || kind) as interactions,
         bool_or(contains(residue, 'click')) as need, bool_or(contains(residue, 'err')) as bad from c where present group by 1)
       select c_custkey, coalesce(n_hbonds, 0) as n_hbonds, coalesce(interactions, '') as interactions,
         coalesce(n_hbonds, 0) >= 2 and coalesce(need, false) and not coalesce(bad, false) as pass_interactions
       from customer left join g on user_id = c_custkey""",
)
def q_interactions(t: Tables) -> DataFrame:
    k = F.get_json_object("props", "$.k").try_cast("int") % 3
    kind = F.when(k == 0, "HBDonor").when(k == 1, "HBAcceptor").otherwise("Hydrophobic")
    contacts = t.events.select(
        F.col("user_id").alias("c_custkey"), F.col("event_type").alias("residue"), kind.alias("interaction"), (F.col("value") > 60).alias("present")
    )
    poses = t.customer.select("c_custkey")
    return geo.contact_check(poses, contacts, "c_custkey", 2, required=["click", "NEVER"], forbidden=["err"])


@query(
    "q_zagreb",
    """with a as (select l_orderkey, count(*) as n_atoms, sum(l_linenumber * l_linenumber) as sq from lineitem group by 1)
       select l_orderkey, n_atoms, case when n_atoms < 2 then 1.0 else greatest(3 - 2 * n_atoms + sq / 2.0, 0.0) end::double as q1 from a""",
)
def q_zagreb(t: Tables) -> DataFrame:
    return complexity.q1_index(t.lineitem, "l_orderkey", "l_linenumber")


def structure(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Orders as structures: line items are atoms; return flag and line status name two rings each."""
    atoms = t.lineitem.select(
        F.col("l_orderkey").alias("candidate"),
        F.concat_ws("-", "l_partkey", "l_suppkey", "l_linenumber", F.round(F.col("l_extendedprice") * 100).cast("long")).alias("atom"),
        F.col("l_linenumber").alias("degree"),
        F.when(F.col("l_quantity") > 10, "C").otherwise("N").alias("element"),
        (F.col("l_discount") > 0.03).alias("sp3"),
        (F.col("l_tax") > 0.01).alias("aromatic"),
        (F.col("l_quantity") > 48).alias("chiral"),
        "l_returnflag",
        "l_linestatus",
    )
    rings = atoms.filter("l_returnflag <> 'N'").select("candidate", F.col("l_returnflag").alias("ring"), "atom").union(
        atoms.filter("l_linestatus = 'O'").select("candidate", "l_linestatus", "atom")
    )
    return atoms.drop("l_returnflag", "l_linestatus"), rings


@query(
    "q_complexity",
    """with a as (select l_orderkey as candidate, l_partkey || '-' || l_suppkey || '-' || l_linenumber || '-' || round(l_extendedprice * 100)::bigint as atom, l_linenumber as degree, l_quantity > 10 as c,
         l_discount > 0.03 as sp3, l_tax > 0.01 as ar, l_quantity > 48 as chiral, l_returnflag, l_linestatus from lineitem),
       r as (select candidate, l_returnflag as ring, atom, ar, degree from a where l_returnflag <> 'N' union all select candidate, l_linestatus, atom, ar, degree from a where l_linestatus = 'O'),
       rk as (select candidate, ring, bool_and(ar) as allar, bool_or(ar) as anyar from r group by 1, 2),
       rf as (select candidate, max(allar::int) as ar, max((not anyar)::int) as nar from rk group by 1),
       two as (select candidate, atom, degree, list_sort(list(ring))[1] as r1, list_sort(list(ring))[2] as r2 from r group by all),
       cen as (select distinct candidate, r1, r2 from two where r2 is not null and degree = 4),
       sh as (select cen.candidate, r1, r2, count(*) as n from cen join r x on x.candidate = cen.candidate and x.ring = r1
         join r y on y.candidate = cen.candidate and y.ring = r2 and x.atom = y.atom group by all),
       sp as (select distinct candidate from sh where n = 1),
       inr as (select distinct candidate, atom from r),
       p as (select a.candidate, count(*) as n_atoms, sum(degree * degree) as sq, max(chiral::int) as ch, count(*) filter (c) as cn,
         count(*) filter (c and sp3) as s3, count(*) filter (c and sp3 and inr.atom is not null and not ar) as cyc, count(*) filter (c and sp3 and inr.atom is null) as acyc
         from a left join inr on a.candidate = inr.candidate and a.atom = inr.atom group by 1),
       q as (select p.*, case when n_atoms < 2 then 1.0 else greatest(3 - 2 * n_atoms + sq / 2.0, 0.0) end::double as q1,
         coalesce(rf.ar, 0) + coalesce(rf.nar, 0) + ch + (sp.candidate is not null)::int as flags,
         case when cn > 0 then s3 / cn else 0 end as f3, case when cn > 0 then cyc / cn else 0 end as fc, case when cn > 0 then acyc / cn else 0 end as fa
         from p left join rf on rf.candidate = p.candidate left join sp on sp.candidate = p.candidate)
       select candidate, n_atoms, q1, round((flags + (f3 + fc - fa) / (1 + f3)) * q1, 4) as complexity from q""",
)
def q_complexity(t: Tables) -> DataFrame:
    return complexity.topological_index(*structure(t))


