"""The thin registered queries of the operators: operator plus the digest columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .common import table


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_wrapper_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .html_extract import main_texts

    return main_texts(table(spark, sf_dir, "pages"))


def op2_log_bilinear_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lm import scores

    return scores(table(spark, sf_dir, "documents"))


def op3_prefix_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .fingerprint import fingerprints

    return fingerprints(table(spark, sf_dir, "documents"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack

    return pack(table(spark, sf_dir, "documents"), vocabulary_path())


def op5_spherical_cap_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .embed import near_duplicates

    return near_duplicates(table(spark, sf_dir, "embeddings"))


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ngram_join import join

    return join(table(spark, sf_dir, "documents"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secret_scan import digests, scan

    return digests(scan(table(spark, sf_dir, "documents")))


def op8_toxicity_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import digests

    return digests(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .substring import digests

    return digests(table(spark, sf_dir, "documents"))


def op10_bpe_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .bpe import encode_digests

    return encode_digests(table(spark, sf_dir, "documents"), vocabulary_path())


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .whitening import whiten

    return whiten(table(spark, sf_dir, "embeddings"))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .exact_dedup import exact_duplicates

    return exact_duplicates(table(spark, sf_dir, "documents"))


OP12_SQL = """
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size, doc_id = max(doc_id) over same as kept, sha256(coalesce(text, '')) as text_sha256
from documents window same as (partition by coalesce(text, ''))
"""


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .prefix_trie import trie

    return trie(table(spark, sf_dir, "conversations"))


OP13_SQL = """
with own as (
  select conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as turns
  from conversations where conv_id is not null group by conv_id
), headed as (
  select conv_id, turns, (4294967295 - list_reduce(
    list_prepend(4294967295::hugeint, list_transform(string_split(conv_id::varchar, ''), lambda c: ascii(c)::hugeint)),
    lambda crc, x: list_reduce(list_prepend(xor(crc, x), [0::hugeint, 0, 0, 0, 0, 0, 0, 0]), lambda a, z: case when a % 2 = 1 then xor(a // 2, 3988292384) else a // 2 end)
  )) % 6 as h from own
), built as (
  select c.conv_id, coalesce(b.turns, [])[1:c.h] || c.turns[c.h + 1:] as turns from headed c left join own b on b.conv_id = c.conv_id - c.conv_id % 100
), placed as (
  select conv_id, d as depth, len(turns) = d as ends, sha256(to_json(turns[1:d])) as node, case when d > 0 then sha256(to_json(turns[1:d - 1])) end as parent, case when d > 0 then length(turns[d].text) else 0 end as size
  from (select conv_id, turns, unnest(range(len(turns) + 1)) as d from built)
), nodes as (
  select node, any_value(parent) as parent, any_value(depth) as depth, any_value(size) as size, min(conv_id) as conv_id, count(*) as n_convs,
    sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (ends), '')) as ends_sha256
  from placed group by node
), kids as (select parent, count(*) as n_children from nodes group by parent),
sums as (
  select p.node, sum(case when k.parent is null then 1 else 0 end) as n_leaves, sum((u.n_convs - 1) * u.size) as saved_tokens
  from nodes u join placed p on p.conv_id = u.conv_id and p.depth <= u.depth left join kids k on k.parent = u.node group by p.node
)
select n.conv_id, n.depth, p.conv_id as parent_conv_id, n.n_convs, coalesce(k.n_children, 0) as n_children, s.n_leaves::bigint as n_leaves, s.saved_tokens::bigint as saved_tokens, n.ends_sha256
from nodes n left join nodes p on p.node = n.parent left join kids k on k.parent = n.node join sums s on s.node = n.node
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (
        op1_wrapper_extraction, op2_log_bilinear_lm, op3_prefix_fingerprints, op4_best_fit_packing, op5_spherical_cap_filters, op6_ngram_jaccard_join, op7_secret_scan,
        op8_toxicity_knn, op9_substring_dedup, op10_bpe_tree, op11_whitening, op12_exact_dedup, op13_prefix_trie,
    )
    return {f.__name__: f for f in every}


def oracle_sql() -> dict[str, str]:
    return {"op12_exact_dedup": OP12_SQL, "op13_prefix_trie": OP13_SQL}
