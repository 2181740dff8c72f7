"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from winnow.llm import language, quality
from winnow.llm.bpe import encode_digests
from winnow.llm.exact_dedup import exact_groups
from winnow.llm.line_dedup import without_repeats
from winnow.llm.mixing import Mix, copies, copies_sql
from winnow.llm.ngram_join import linked_components
from winnow.llm.secret_scan import find_secrets
from winnow.llm.storage import written
from winnow.llm.suffix_dedup import without_repeated_strings
from winnow.llm.token_alignment import alignment_counts
from winnow.llm.token_counts import histogram, lengths, suffix_sums
from winnow.llm.topk_search import top_k
from winnow.llm.whitening import fit as fit_whitening, whiten

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked_components(table(spark, sf_dir, "documents").select("doc_id", "text"), k=4, num=85, den=100)


def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


OP2_SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as q from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding)
), s as (
  select a.vec_id as query_id, b.vec_id, list_dot_product(a.q, b.q)::bigint as score
  from v a join v b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id
)
select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, score
from s qualify rank <= 5
"""


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("text")
    counted = histogram(lengths(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN))
    return suffix_sums(written(counted, "histogram"))  # read several times, encoded once


# Four domains by the number in the source's name; half of all tokens, at most two passes of any source.
MIX = Mix(
    levels=(("domain", "concat('domain', pmod(try_cast(regexp_extract(source, '([0-9]+)$', 1) as int), 4))"), ("language", "lang"), ("origin", "source")),
    weights={"domain": {"domain0": 4, "domain1": 3, "domain2": 2}, "language": {"en": 5, "de": 3, "fr": 2}},
    budget_num=1, budget_den=2, max_epochs=2, seed=17,
)


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return copies(table(spark, sf_dir, "documents"), MIX)


OP4_SQL = copies_sql(MIX, levels=("'domain' || (try_cast(regexp_extract(source, '([0-9]+)$', 1) as int) % 4)", "lang", "source"), tokens="(strlen(text) + 3) // 4")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = without_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("text"), 256).alias("text_sha256"))


OP6_SQL = """
with l as (
  select doc_id, generate_subscripts(lines, 1) - 1 as i, unnest(lines) as line, len(lines) - 1 as last_i
  from (select doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents)
), h as (
  select *, ('0x' || substr(md5(line), 1, 8))::bigint as h from l
), e as (
  select *, i = last_i or ((h + 31 * coalesce(lag(h) over w, 0)) % 1000003) % 3 = 0 as is_end from h window w as (partition by doc_id order by i)
), p as (
  select *, coalesce(sum(is_end::int) over (partition by doc_id order by i rows between unbounded preceding and 1 preceding), 0) as place from e
), c as (
  select doc_id, place, count(*) as n, string_agg(line, chr(10) order by i) as chunk from p group by all
), r as (
  select *, n >= 2 and row_number() over (partition by chunk order by doc_id, place) > 1 as gone from c
)
select doc_id, sum(n)::bigint as n_lines, coalesce(sum(n) filter (gone), 0)::bigint as n_removed,
  sha256(coalesce(string_agg(chunk, chr(10) order by place) filter (not gone), '')) as text_sha256
from r group by doc_id
"""


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = language.predict(docs, language.fit(docs, ~language.held_out()))
    return found.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score")


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return find_secrets(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    machine = quality.fit(docs, table(spark, sf_dir, "labels"), lambda id_: ~language.held_out(id_))
    found = quality.score(docs, machine)
    return found.select("doc_id", language.held_out().alias("held_out"), "score", "predicted")


OP8_SQL = """
with n as (
  select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents
)
select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size, doc_id = max(doc_id) over w as kept, sha256(t) as text_sha256
from n window w as (partition by t)
"""


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return alignment_counts(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.PATTERN)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return whiten(vectors, fit_whitening(vectors))


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = without_repeated_strings(table(spark, sf_dir, "documents").select("doc_id", "text"))
    n_removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_bytes", n_removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


QUERIES: dict[str, Query] = {
    "op1_ngram_join": op1_ngram_join,
    "op2_exact_topk": op2_exact_topk,
    "op3_token_counts": op3_token_counts,
    "op4_source_mix": op4_source_mix,
    "op5_language_id": op5_language_id,
    "op6_line_dedup": op6_line_dedup,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_secret_scan": op9_secret_scan,
    "op10_quality": op10_quality,
    "op11_token_alignment": op11_token_alignment,
    "op12_whitening": op12_whitening,
    "op13_suffix_dedup": op13_suffix_dedup,
}
SQL: dict[str, str] = {
    "op2_exact_topk": OP2_SQL,
    "op4_source_mix": OP4_SQL,
    "op6_line_dedup": OP6_SQL,
    "op8_exact_dedup": OP8_SQL,
}
