"""The contract queries: thin wrappers over the operators with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, packing, secrets, sharding, simhash, toxicity, urls, vectors, warc
from .common import table


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_pivot_permutation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"), at_least=0.9, near=8, shared=2)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, radius=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = warc.round_trip(table(spark, sf_dir, "pages"), least=1000)
    return got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_pivot_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.top_k(table(spark, sf_dir, "embeddings"), k=10, every=100, scale=1024)


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("__spans", lambda s: s["kind"] < 3)
    many = lambda k: F.size(F.filter("__spans", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id", many(0).alias("n_assign"), many(1).alias("n_access"), many(2).alias("n_hex"),
        F.sha2(secrets.describe(base), 256).alias("base_sha256"), secrets.describe(F.col("__spans")).alias("spans"),
    )


# The contract's rules.
URL_RULES = [
    urls.Rule("com", "/en/", "block"),
    urls.Rule("example.com", "/en/7", "allow"),
    urls.Rule("net", "/de/", "block"),
    urls.Rule("example.net", "/de/8", "block"),
    urls.Rule("org", "/es/", "block"),
]


def op6_url_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op7_hilbert(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shards(table(spark, sf_dir, "documents"), count=24)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "curve")


def op8_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), capacity=1024, end_id=2)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    net = toxicity.fit(docs, table(spark, sf_dir, "labels"), per_class=1500, max_chars=4000)
    held = (F.crc32(F.col("doc_id").cast("string")) % 5 == 0).alias("held_out")
    return toxicity.score(docs, net).select("doc_id", held, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(table(spark, sf_dir, "documents"), tokenizer_path())


QUERIES = {
    "op1_pivot_permutation": op1_pivot_permutation,
    "op2_simhash": op2_simhash,
    "op3_warc": op3_warc,
    "op4_pivot_table": op4_pivot_table,
    "op5_secrets": op5_secrets,
    "op6_url_ratio": op6_url_ratio,
    "op7_hilbert": op7_hilbert,
    "op8_best_fit": op8_best_fit,
    "op9_toxicity": op9_toxicity,
    "op10_bpe": op10_bpe,
}

ORACLES: dict[str, str] = {
    "op1_pivot_permutation": """
        with recursive v as (
            select vec_id, min(cast(embedding as double[])) v from embeddings where vec_id is not null and embedding is not null
                and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 group by vec_id),
        z as (select * from v where len(list_filter(v, lambda x: x <> 0)) > 0),
        e as (select a.vec_id a, b.vec_id b from z a join z b on a.vec_id <> b.vec_id and list_cosine_similarity(a.v, b.v) >= 0.9),
        r(a, b) as (select a, b from e union select r.a, e.b from r join e on r.b = e.a),
        l as (select a, count(*) n from e group by a), c as (select a, min(b) c from r group by a)
        select i.vec_id, coalesce(l.n, 0) n_links, least(i.vec_id, coalesce(c.c, i.vec_id)) component_id,
            coalesce(i.vec_id <= coalesce(c.c, i.vec_id), true) kept
        from (select distinct vec_id from embeddings) i left join l on l.a = i.vec_id left join c on c.a = i.vec_id""",
    "op3_warc": """
        with p as (select page_id, coalesce(html, '') h from pages),
        d as (select page_id, strlen(h) n, sha1(h) g from p),
        m as (select g, max(page_id) holder from d where n >= 1000 group by g)
        select page_id, n payload_bytes, d.g payload_digest,
            case when holder is null or page_id = holder then 'response' else 'revisit' end record_type,
            case when page_id <> holder then holder end refers_to
        from d left join m on m.g = d.g""",
    "op4_pivot_table": """
        with v as (
            select vec_id, list_transform(min(cast(embedding as double[])), lambda x: floor(1024 * x)) v from embeddings
            where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
            group by vec_id),
        s as (select q.vec_id query_id, c.vec_id, cast(list_inner_product(q.v, c.v) as bigint) score
            from v q join v c on q.vec_id % 100 = 0 and q.vec_id <> c.vec_id),
        r as (select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank from s)
        select query_id, rank, vec_id, score from r where rank <= 10""",
    "op5_secrets": secrets.digest_sql(),
    "op6_url_ratio": urls.judge_sql(URL_RULES),
    "op7_hilbert": sharding.shards_sql(24),
}
