"""One query per operator, over the whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfdiff.llm import (
    alignment,
    attention_lm,
    chunk_reuse,
    dac,
    decontaminate,
    forest,
    hard_negatives,
    html_paths,
    line_spread,
    packing,
    paragraphs,
    quality,
    toxicity,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_edit_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and test item it contains, with the least distance and its place."""
    docs, bench = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return decontaminate.find_matches(docs, bench)


def op2_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.near_duplicates(_table(spark, sf_dir, "documents"))


def op3_paragraph_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every paragraph that repeats an earlier one, and where that one stands; with word and
    kept_word, every passage that does, whatever lines it stands in."""
    docs = _table(spark, sf_dir, "documents")
    return paragraphs.find_repeats(docs).unionByName(paragraphs.find_passages(docs), allowMissingColumns=True)


def op4_consensus_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_paths.main_text(_table(spark, sf_dir, "pages"))


def op5_addressable_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dac.read_documents(dac.write_ids(_table(spark, sf_dir, "documents")))


def op6_linear_grouping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def _fold(n: int = 5) -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % n


def op7_attention(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = attention_lm.scores(_table(spark, sf_dir, "documents"), learn=_fold() != 1)
    held_out = (_fold() == 1).alias("held_out")
    return found.select(
        "doc_id", held_out, "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op8_positive_unlabelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    weights = toxicity.fit(docs, labels, learn=_fold() != 0)
    return toxicity.scored(docs, weights).select(
        "doc_id",
        (_fold() == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op9_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without boilerplate lines, and how many lines went."""
    docs = _table(spark, sf_dir, "documents").withColumn("whole", F.col("text"))
    lines = F.size(F.split(F.col("whole"), "\n"))
    left = F.when(F.col("text") == "", 0).otherwise(F.size(F.split(F.col("text"), "\n")))
    out = line_spread.dedup_lines(docs)
    changed = ~F.col("text").eqNullSafe(F.col("whole"))
    return out.select(
        "doc_id", "text", F.when(changed, lines - left).otherwise(0).cast("long").alias("n_removed")
    )


def op10_quality_fences(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(_table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(_table(spark, sf_dir, "documents"))


def op12_chunk_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_reuse.encode_documents(_table(spark, sf_dir, "documents"))


def op13_slot_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh row is mislabelled on purpose."""
    wrong = (F.col("label") + 1) % 10
    label = F.when(F.col("vec_id") % 7 == 0, wrong).otherwise(F.col("label"))
    rows = _table(spark, sf_dir, "embeddings")
    return hard_negatives.mine(rows, anchor=F.col("vec_id") % 50 == 0, label=label)


QUERIES = {
    "op1_edit_pieces": op1_edit_pieces,
    "op2_lsh_forest": op2_lsh_forest,
    "op3_paragraph_bands": op3_paragraph_bands,
    "op4_consensus_paths": op4_consensus_paths,
    "op5_addressable_codes": op5_addressable_codes,
    "op6_linear_grouping": op6_linear_grouping,
    "op7_attention": op7_attention,
    "op8_positive_unlabelled": op8_positive_unlabelled,
    "op9_line_spread": op9_line_spread,
    "op10_quality_fences": op10_quality_fences,
    "op11_alignment": op11_alignment,
    "op12_chunk_reuse": op12_chunk_reuse,
    "op13_slot_negatives": op13_slot_negatives,
}

_LINES = """split as (select doc_id, source, text, string_split(text, chr(10)) as parts from documents),
  line as (select doc_id, coalesce(source, chr(1)) as source, text, unnest(parts) as part,
      generate_subscripts(parts, 1) as pos from split),
  bare as (select *, nullif(trim(part, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '') as l
      from line)"""

ORACLES = {
    "op9_line_spread": f"""with {_LINES},
  shared as (select l from bare where l is not null group by l
      having count(distinct source) >= 10 and count(distinct text) >= 10),
  own as (select doc_id from bare where l is not null group by doc_id
      having 2 * coalesce(sum(length(l)) filter (where l in (select l from shared)), 0) <= any_value(length(text))
      or count(distinct l) filter (where l in (select l from shared)) < 2),
  bad as (select l from bare where l in (select l from shared) and doc_id in (select doc_id from own) group by l
      having count(distinct source) >= 10 and count(distinct text) >= 10),
  kept as (select doc_id, string_agg(part, chr(10) order by pos) as kept, count(*) as n from bare
      where l is null or l not in (select l from bad) group by doc_id)
  select d.doc_id, case when text is null then null else coalesce(kept, '') end as text,
      coalesce(len(string_split(text, chr(10))) - coalesce(n, 0), 0) as n_removed
  from documents d left join kept using (doc_id)""",
    "op13_slot_negatives": """with clean as (select vec_id as id, label, embedding from embeddings
      where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
  r as (select id, case when id % 7 = 0 then (label + 1) % 10 else label end as label,
      list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v from clean),
  pair as (select a.id as anchor_id, b.id as other_id, a.label = b.label as same,
      cast(list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])) as bigint) as score
      from r a join r b on a.id <> b.id where a.id % 50 = 0),
  pos as (select anchor_id, other_id as positive_id, score as positive_score from pair where same
      qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5)
  select anchor_id, positive_id, cast(row_number() over w as int) as rank, other_id as negative_id,
      positive_score, score as negative_score
  from pos join pair using (anchor_id)
  where not same and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score
  window w as (partition by anchor_id, positive_id order by score desc, other_id)
  qualify row_number() over w <= 3""",
}
