"""The registered queries of the subpackage: each applies its operator with production parameters to a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, context_mixing, exact_dedup, filter_audit, licences, near_dedup, packing, pii, repeats, sharding, source_divergence, toxicity, vector_links
from .common import documents


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(documents(spark, sf_dir), _tokenizer("byte_bpe_50k.tiktoken"))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op2_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(documents(spark, sf_dir)).drop("spans")


def op3_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = repeats.digests(documents(spark, sf_dir))
    shared = F.aggregate("passages", F.lit(0).cast("long"), lambda n, p: n + p["end"] - p["start"])
    own = F.size("passages").cast("long").alias("n_passages"), shared.alias("n_passage_words")
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256", *own)


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.assign(documents(spark, sf_dir)).drop("loc")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.assign(documents(spark, sf_dir), shards=40)
    law, grown = F.lit("rows").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    return out.select("doc_id", "size", "text_crc32", law, "shard", "slot", grown)


def op6_vector_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_links.link(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    schema = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    return bpe.encode(documents(spark, sf_dir), _tokenizer("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, bpe.digests, schema)


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.group(documents(spark, sf_dir)).drop("loc")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect(documents(spark, sf_dir))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.audit(documents(spark, sf_dir))


def op13_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_mixing.score(documents(spark, sf_dir))


QUERIES = {
    "op1_packing": op1_packing,
    "op2_licences": op2_licences,
    "op3_repeats": op3_repeats,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_sharding": op5_sharding,
    "op6_vector_links": op6_vector_links,
    "op7_bpe": op7_bpe,
    "op8_near_dedup": op8_near_dedup,
    "op9_pii": op9_pii,
    "op10_toxicity": op10_toxicity,
    "op11_filter_audit": op11_filter_audit,
    "op12_source_divergence": op12_source_divergence,
    "op13_lm_scoring": op13_lm_scoring,
}

_LETTERS = "ABCDE"
_FAILS = ", ".join(f"CASE WHEN f.{x} THEN strpos(o.filter_order, '{x}') ELSE 6 END" for x in _LETTERS)
_FAILED_HERE = " OR ".join(f"(f.{x} AND s.letter = '{x}')" for x in _LETTERS)
_ALONE = " OR ".join(f"(s.letter = '{x}' AND {' AND '.join(('f.' if x == y else 'NOT f.') + y for y in _LETTERS)})" for x in _LETTERS)
SQL: dict[str, str] = {
    "op11_filter_audit": rf"""
        WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
        w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words, coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS E FROM d),
        m AS (SELECT part, len(words) < 100 AS A, 100 * len(list_distinct(words)) < 80 * len(words) AS B,
            100 * len(regexp_extract_all(t, '[A-Z]')) > 10 * length(t) AS C, regexp_matches(t, '[#$%&*|]') AS D, E,
            EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = w.doc_id AND quality = 1) AS good,
            EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = w.doc_id AND toxic = 1) AS toxic FROM w),
        f AS (SELECT part, A, B, C, D, E, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM m GROUP BY ALL),
        x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
        o AS (SELECT a.l || b.l || c.l || d.l || e.l AS filter_order FROM x a, x b, x c, x d, x e
          WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
        s AS (SELECT filter_order, i AS step, substr(filter_order, i, 1) AS letter FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS i)),
        r AS (SELECT part, filter_order, step, letter, CAST(sum(n) FILTER (gone > step) AS BIGINT) AS kept,
            coalesce(sum(n) FILTER (gone = step), 0) AS removed, coalesce(sum(n) FILTER (gone < step AND failed), 0) AS redundant,
            coalesce(sum(n) FILTER (alone), 0) AS unique_fails, coalesce(sum(good) FILTER (gone = step), 0) AS good_lost,
            coalesce(sum(toxic) FILTER (gone = step), 0) AS toxic_lost
          FROM (SELECT f.part, f.n, f.good, f.toxic, s.filter_order, s.step, s.letter, least({_FAILS}) AS gone, {_FAILED_HERE} AS failed, {_ALONE} AS alone
            FROM f, s, o WHERE o.filter_order = s.filter_order) GROUP BY ALL)
        SELECT part, filter_order, CAST(step AS INTEGER) AS step, coalesce(kept, 0) AS kept, CAST(removed AS BIGINT) AS removed,
          CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
          CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley FROM r""",
    "op4_exact_dedup": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
        FROM d WINDOW w AS (PARTITION BY t)""",
    "op12_source_divergence": r"""
        WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS t FROM documents),
        w AS (SELECT id, lang, source, unnest(regexp_extract_all(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
        kept AS (SELECT lang, term FROM w GROUP BY ALL HAVING count(DISTINCT id) >= 30),
        c AS (SELECT lang, source, term, CAST(count(*) AS HUGEINT) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL),
        v AS (SELECT lang, count(*) AS kinds FROM kept GROUP BY ALL),
        g AS (SELECT lang, source, coalesce(any_value(kinds), 0) AS kinds, CAST(coalesce(sum(c.n), 0) AS HUGEINT) AS total
          FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN c USING (lang, source) LEFT JOIN v USING (lang) GROUP BY ALL),
        p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000 * (coalesce(c.n, 0) + 5)) // (total + 5 * kinds) AS p
          FROM g JOIN kept k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
        l AS (SELECT lang, sum(total) AS total, any_value(kinds) AS kinds FROM g GROUP BY ALL),
        q AS (SELECT c.lang, c.term, 1 + (1000000000 * (sum(c.n) + 5)) // (any_value(l.total) + 5 * any_value(l.kinds)) AS q FROM c JOIN l USING (lang) GROUP BY ALL),
        f AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(sum(abs(x.p - y.p)), 0) AS value
            FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source
            LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term GROUP BY ALL
          UNION ALL SELECT lang, source, 'term', term, p - q FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
        r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM f)
        SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM r WHERE part = 'pair' OR rank <= 50""",
}
