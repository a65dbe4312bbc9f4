"""One registered query for each operator, over its whole table with production parameters, and the oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from framewise.llm import centroids, exact_dedup, license_scan, line_dedup, mixing, ngram_join, quality, secret_scan, sentencepiece_bpe, substring_dedup, token_alignment, toxicity, warc


def piece_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def byte_level() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(_table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.predict(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_table(_table(spark, sf_dir, "documents"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup_table(_table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digests(_table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(_table(spark, sf_dir, "pages"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_bpe.digests(_table(spark, sf_dir, "documents"), piece_model())


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(_table(spark, sf_dir, "documents"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(_table(spark, sf_dir, "documents"), window=20)


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(_table(spark, sf_dir, "embeddings"))


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(_table(spark, sf_dir, "documents"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align(_table(spark, sf_dir, "documents"), byte_level(), piece_model())


def _rounds_sql(k: int = 8, rounds: int = 10) -> str:
    """The rounds of centroid clustering as one common table expression each."""
    parts = [
        f"""
with v as materialized (
  select vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as q, sha256('3:' || vec_id) as h from embeddings
  where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = 64
), c0 as materialized (
  select cast(row_number() over (order by h, q) - 1 as integer) as k, q from v order by h, q limit {k}
)"""
    ]
    distance = "list_sum(list_transform(list_zip(v.q, c.q), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"

    def near(r: int) -> str:
        return f"a{r} as materialized (select vec_id, q, k[2] as k, k[1] as d from (select vec_id, v.q as q, min([{distance}, c.k]) as k from v cross join c{r} c group by vec_id, v.q))"

    for r in range(rounds):
        parts.append(near(r))
        parts.append(
            f"c{r + 1} as materialized (select c.k, coalesce(n.q, c.q) as q from c{r} c left join (select k, list(cast((s - ((s % n) + n) % n) // n as bigint) order by j) as q "
            f"from (select k, j, cast(sum(x) as bigint) as s, count(*) as n from (select k, unnest(q) as x, generate_subscripts(q, 1) as j from a{r}) group by k, j) group by k) n on n.k = c.k)"
        )
    parts.append(near(rounds))
    return ", ".join(parts) + (
        f" select vec_id, cast(a.k as integer) as cluster, cast(d as bigint) as distance, cast(sum(d) over (partition by a.k) as bigint) as cluster_inertia, cast(sum(d) over () as bigint) as inertia, "
        f"sha256(array_to_string(c.q, ',')) as centroid_sha256 from a{rounds} a join c{rounds} c on c.k = a.k"
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": op1_license_scan,
    "op2_toxicity": op2_toxicity,
    "op3_mixing": op3_mixing,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_quality": op5_quality,
    "op6_line_dedup": op6_line_dedup,
    "op7_warc": op7_warc,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_ngram_join": op9_ngram_join,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_centroids": op11_centroids,
    "op12_secret_scan": op12_secret_scan,
    "op13_token_alignment": op13_token_alignment,
}
ORACLES: dict[str, str] = {
    "op11_centroids": _rounds_sql(),
    "op4_exact_dedup": r"""
with d as (
  select doc_id, length(coalesce(text, '')) as chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as norm from documents
), k as (
  select *, first_value(doc_id) over (partition by norm order by chars desc, doc_id) as keep_id, count(*) over (partition by norm) as group_size from d
)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(norm) as text_sha256 from k
""",
    "op6_line_dedup": r"""
with l as (
  select doc_id, k, raw, trim(raw, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ') as line
  from (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as raw, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as k from documents)
), f as (
  select line, length(line) as n, min(struct_pack(doc_id := doc_id, k := k)) as first from l where line <> '' group by line
), near as (
  select distinct a.line from f a join f b on b.n between a.n - 1 and a.n + 1 and b.first < a.first
  where a.n >= 20 and levenshtein(a.line, b.line) = 1
), j as (
  select l.*, l.line <> '' and (struct_pack(doc_id := l.doc_id, k := l.k) > f.first or near.line is not null) as gone
  from l left join f on f.line = l.line left join near on near.line = l.line
)
select doc_id, count(*) filter (line <> '') as n_lines, count(*) filter (gone) as n_removed,
       sha256(coalesce(string_agg(raw, chr(10) order by k) filter (not gone), '')) as kept_sha256
from j group by doc_id
""",
    "op7_warc": r"""
with p as (
  select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha256(coalesce(html, '')) as payload_digest from pages
), f as (
  select *, min(page_id) over (partition by payload_digest) as first_id from p
)
select page_id, payload_bytes, payload_digest,
       case when payload_bytes >= 100 and page_id <> first_id then 'revisit' else 'response' end as record_type,
       case when payload_bytes >= 100 and page_id <> first_id then first_id end as refers_to
from f
""",
    "op9_ngram_join": r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as ws from documents
), s as (
  select distinct doc_id, array_to_string(ws[i:i + 4], ' ') as g
  from (select doc_id, ws, unnest(range(1, greatest(2, len(ws) - 3))) as i from w where len(ws) > 0)
), n as (
  select doc_id, count(*) as n from s group by doc_id
), pairs as (
  select a.doc_id as a, b.doc_id as b, count(*) as hits from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2
), e as (
  select a, b from pairs join n x on x.doc_id = a join n y on y.doc_id = b where 100 * hits >= 80 * (x.n + y.n - hits)
), sym as (
  select a, b from e union all select b, a from e
), reach(a, b) as (
  select doc_id, doc_id from n union select r.a, t.b from reach r join sym t on t.a = r.b
), c as (
  select a as doc_id, min(b) as component_id from reach group by a
)
select w.doc_id, coalesce(n.n, 0) as n_shingles, coalesce(c.component_id, w.doc_id) as component_id
from w left join n using (doc_id) left join c using (doc_id)
""",
    "op10_substring_dedup": r"""
with w as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents
), g as (
  select doc_id, i, array_to_string(ws[i:i + 19], ' ') as win
  from (select doc_id, ws, unnest(range(1, len(ws) - 18)) as i from w where len(ws) >= 20)
), later as (
  select doc_id, i from (select doc_id, i, row_number() over (partition by win order by doc_id, i) as r from g) where r > 1
), gone as (
  select doc_id, list(distinct p) as ps from (select doc_id, unnest(range(i, i + 20)) as p from later) group by doc_id
), j as (
  select w.doc_id, w.ws, list_filter(range(1, len(w.ws) + 1), lambda p: not list_contains(coalesce(ps, []), p)) as kept
  from w left join gone using (doc_id)
)
select doc_id, cast(len(ws) as bigint) as n_words, cast(len(ws) - len(kept) as bigint) as n_removed,
       sha256(array_to_string(list_transform(kept, lambda p: ws[p]), ' ')) as kept_sha256
from j
""",
}
