"""The registered queries: each operator over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.llm import attention_quality, license_families, mincut_html, secret_cnn
from storelens.llm.block_rotation import fill_in_middle
from storelens.llm.bpe_counts import count_tokens
from storelens.llm.chunk_pieces import encode_pieces
from storelens.llm.circulant_minhash import near_duplicates
from storelens.llm.coordinate_lists import hard_negatives
from storelens.llm.frames import read
from storelens.llm.grouped_packing import pack
from storelens.llm.spaced_seeds import contaminated
from storelens.llm.suffix_dedup import remove_repeats
from storelens.llm.weak_rules import judge_quality


def op1_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    model = attention_quality.train(docs, read(spark, folder, "labels"))
    scored = attention_quality.score(docs, model)
    return scored.select("doc_id", attention_quality.held_out().alias("held_out"), "score", "predicted")


def op2_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(read(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op3_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    pages = read(spark, folder, "pages")
    return mincut_html.extract(pages, mincut_html.train(pages))


def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return count_tokens(read(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op5_minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(read(spark, folder, "documents"), words=2, percent=80)


def op6_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contaminated(read(spark, folder, "documents"), read(spark, folder, "benchmark"), shortest=1)


def op7_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    return license_families.scan(docs, license_families.train(docs))


def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    counted = judge_quality(read(spark, folder, "documents"))
    return counted.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "good", "kept",
    )


def op9_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    found = secret_cnn.find_secrets(docs, secret_cnn.train(docs))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_model")


def op10_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(read(spark, folder, "documents"))


def op11_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    return fill_in_middle(read(spark, folder, "documents"), digests=True)


def op12_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    return encode_pieces(read(spark, folder, "documents"), model, digests=True)


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = read(spark, folder, "embeddings").withColumn("label", label)
    return hard_negatives(rows, anchors=F.col("id") % 100 == 0)


QUERIES = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_html_extraction": op3_html_extraction,
    "op4_token_counts": op4_token_counts,
    "op5_minhash_dedup": op5_minhash_dedup,
    "op6_benchmark_decontamination": op6_benchmark_decontamination,
    "op7_license_scan": op7_license_scan,
    "op8_quality_rules": op8_quality_rules,
    "op9_secret_scan": op9_secret_scan,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_sentencepiece": op12_sentencepiece,
    "op13_hard_negatives": op13_hard_negatives,
}

_FILL_IN_MIDDLE = r"""
with units as (
    select doc_id, coalesce(text, '') as body, sha256('1:' || coalesce(cast(doc_id as varchar), '')) as h,
        regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') as unit
    from documents
), drawn as (
    select *, len(unit) as n, cast('0x' || h[1:8] as bigint) % (len(unit) + 1) as c1,
        cast('0x' || h[9:16] as bigint) % (len(unit) + 1) as c2,
        case when body = '' or contains(body, '<P>') or contains(body, '<S>') or contains(body, '<M>')
                or cast('0x' || h[17:24] as bigint) % 100 >= 90 then 'plain'
            when cast('0x' || h[25:32] as bigint) % 100 < 20 then 'spm' else 'psm' end as form
    from units
), cut as (
    select doc_id, body, n, form, array_to_string(unit[1:least(c1, c2)], '') as head,
        array_to_string(unit[least(c1, c2) + 1:greatest(c1, c2)], '') as mid,
        array_to_string(unit[greatest(c1, c2) + 1:], '') as tail
    from drawn
)
select doc_id, n, form, case when form <> 'plain' then length(head) end as prefix_chars,
    case when form <> 'plain' then length(mid) end as middle_chars,
    sha256(case form when 'plain' then body when 'psm' then '<P>' || head || '<S>' || tail || '<M>' || mid
        else '<S>' || tail || '<P>' || head || '<M>' || mid end) as output_sha256,
    sha256(body) as restored_sha256
from cut
"""

_HARD_NEGATIVES = r"""
with whole as (
    select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
        [floor(256 * cast(x as double)) for x in embedding] as v
    from embeddings
    where vec_id is not null and label is not null and embedding is not null
        and len([x for x in embedding if x is null or not isfinite(x)]) = 0
), scored as (
    select a.vec_id as anchor_id, b.vec_id as other_id, a.label = b.label as same,
        cast(list_dot_product(a.v, b.v) as bigint) as score
    from whole a join whole b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id
), positives as (
    select anchor_id, other_id as positive_id, score as positive_score from scored where same
    qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5
)
select p.anchor_id, p.positive_id,
    cast(row_number() over (partition by p.anchor_id, p.positive_id order by s.score desc, s.other_id) as int) as rank,
    s.other_id as negative_id, p.positive_score, s.score as negative_score
from positives p join scored s on p.anchor_id = s.anchor_id and not s.same
    and 80 * p.positive_score <= 100 * s.score and s.score <= p.positive_score
qualify rank <= 5
"""

#: The other operators' whole results can't be told in SQL: a trained model, a
#: tokenizer or a closure over all documents is part of each.
ORACLES: dict[str, str] = {
    "op11_fill_in_middle": _FILL_IN_MIDDLE,
    "op13_hard_negatives": _HARD_NEGATIVES,
}
