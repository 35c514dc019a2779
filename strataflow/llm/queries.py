"""Registered queries of the text-preparation operators: whole tables, production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.llm import (
    byte_pairs, decontaminate, html_text, manifest, near_dedup, packing, periodic, privacy, quality_model, quality_rules,
    secrets, substrings, warc,
)

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_containment_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained_items(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op2_disclosure_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return privacy.digest(privacy.find_personal_data(_table(spark, sf_dir, "documents")))


def op3_radix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(_table(spark, sf_dir, "documents"), length=400).drop("kept")


def op4_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), TOKENIZER, capacity=2048)


def op5_capture_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages")).drop("url")


def op6_lsh_forest_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"), width=3, percent=85)


def op7_sketch_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed_rules")


def op8_attention_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality_model.score(docs, quality_model.train(docs, _table(spark, sf_dir, "labels")))


def op9_tree_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(_table(spark, sf_dir, "pages"))


def op10_markov_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.find_secrets(_table(spark, sf_dir, "documents")))


def _id_code() -> Column:
    """Checksum of the decimal doc_id, unsigned; null for a null id."""
    return F.crc32(F.col("doc_id").cast("string"))


def op11_path_copying_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    def leaf(n_chars: Column) -> Column:
        return manifest.leaf_hash([F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text")])

    n_chars = F.col("n_chars").cast("long")
    proofs = manifest.prove(
        _table(spark, sf_dir, "documents"), key=F.col("doc_id"), group=F.col("lang"), leaf=leaf(n_chars),
        changed=F.when(_id_code() % 7 == 0, leaf(n_chars + 1)))
    return proofs.select(
        F.col("key").alias("doc_id"), "leaf", "subroot", "root",
        F.sha2(F.lower(F.hex("siblings")), 256).alias("proof_sha256"),
        F.col("version_root").alias("folded_root"), "verified")


def op12_latin1_backtracking(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = byte_pairs.encode(_table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN)
    return byte_pairs.digest(encoded, RANKS)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic.with_planted_runs(_table(spark, sf_dir, "documents"), _id_code())
    return periodic.digest(periodic.collapse_runs(docs))


QUERIES = {f.__name__: f for f in (
    op1_containment_search, op2_disclosure_spans, op3_radix_repeats, op4_best_two_fit, op5_capture_index,
    op6_lsh_forest_dedup, op7_sketch_thresholds, op8_attention_quality, op9_tree_extraction,
    op10_markov_secrets, op11_path_copying_manifest, op12_latin1_backtracking, op13_periodic_runs,
)}

_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+')"""
_SHINGLES = """case when len(w) = 0 then [] when len(w) < 5 then [w]
    else list_distinct(list_transform(range(1, len(w) - 3), lambda i: list_slice(w, i, i + 4))) end"""

def _sql_leaf(n_chars: str) -> str:
    parts = (f"case when {c} is null then '-' else octet_length(encode({c}::varchar))::varchar || ':' || {c}::varchar end"
             for c in ("doc_id", "source", "lang", n_chars, "text"))
    return f"sha256({' || '.join(parts)})"


# CRC-32 of the decimal doc_id, bit by bit.
_SQL_CRC = """xor(4294967295, list_reduce(
    list_prepend(4294967295::bigint, list_transform(range(8 * length(doc_id::varchar)),
        lambda i: case when i % 8 = 0 then ascii(substr(doc_id::varchar, (i // 8 + 1)::int, 1)) else 0 end::bigint)),
    lambda c, byte: case when xor(c, byte) & 1 = 1 then xor(xor(c, byte) >> 1, 3988292384) else xor(c, byte) >> 1 end))"""

# The others are tested against brute-force versions or held-out rows in tests/llm.
ORACLE_SQL: dict[str, str] = {
    "op11_path_copying_manifest": f"""
        with recursive docs as (
            select doc_id, coalesce('=' || lang, '') as g, {_sql_leaf("n_chars")} as leaf, {_sql_leaf("(n_chars + 1)")} as tampered,
                coalesce({_SQL_CRC} % 7 = 0, false) as changed
            from documents),
        leaves as (
            select *, row_number() over (partition by g order by doc_id nulls first, leaf) - 1 as pos,
                count(*) over (partition by g) as n
            from docs),
        nodes as (
            select g, 0 as level, pos, n, leaf as digest from leaves
            union all
            select g, any_value(level) + 1, pos // 2, any_value((n + 1) // 2), sha256(string_agg(digest, '' order by pos))
            from nodes where n > 1 group by g, pos // 2),
        subroots as (select g, level as height, digest, row_number() over (order by g) - 1 as pos, count(*) over () as n
            from nodes where n = 1),
        tops as (
            select 0 as level, pos, n, digest from subroots
            union all
            select any_value(level) + 1, pos // 2, any_value((n + 1) // 2), sha256(string_agg(digest, '' order by pos))
            from tops where n > 1 group by pos // 2),
        folded as (
            select l.g, l.doc_id, l.leaf, l.pos as row, 0 as step, case when height = 0 then s.pos else l.pos end as pos,
                case when changed then tampered else leaf end as digest, '' as proof, height, s.pos as top_pos
            from leaves l join subroots s using (g)
            union all
            select f.g, f.doc_id, f.leaf, f.row, f.step + 1, case when f.step + 1 = f.height then f.top_pos else f.pos // 2 end,
                sha256(case when f.pos % 2 = 1 then o.digest || f.digest else f.digest || coalesce(o.digest, '') end),
                f.proof || coalesce(o.digest, ''), f.height, f.top_pos
            from folded f left join (
                select g, level as step, pos, digest from nodes where n > 1
                union all
                select s.g, s.height + t.level, t.pos, t.digest from subroots s cross join tops t) o
                on o.g = f.g and o.step = f.step and o.pos = f.pos + 1 - 2 * (f.pos % 2)
            where f.step < f.height + (select max(level) from tops)),
        root as (select digest as root from tops where n = 1)
        select f.doc_id, f.leaf, s.digest as subroot, root, sha256(proof) as proof_sha256, f.digest as folded_root,
            f.digest = root as verified
        from folded f join subroots s using (g) cross join root
        where f.step = f.height + (select max(level) from tops)""",
    "op1_containment_search": f"""
        with items as (
            select item_id, {_SHINGLES} as s from (select item_id, {_WORDS} as w from benchmark)),
        docs as (
            select doc_id, unnest({_SHINGLES}) as g from (select doc_id, {_WORDS} as w from documents)),
        shared as (
            select doc_id, item_id, count(*) as n_shared
            from docs join (select item_id, unnest(s) as g from items) using (g) group by all)
        select doc_id, item_id, len(s) as n_item_shingles, n_shared, n_shared / len(s) as containment
        from shared join items using (item_id) where 100 * n_shared >= 80 * len(s)""",
}
