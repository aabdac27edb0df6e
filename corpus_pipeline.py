"""The corpus pipeline: toxic documents go, one of each group of near duplicates stays, personal data are masked,
sources are mixed to their weights, and what is left is packed into sequences.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before it kept; each result is written as
Parquet to the shared folder and read again. A null text is an empty one in every stage, null ids are rows of their
own, extra columns are carried along, and an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkassay.llm.common import table
from sparkassay.llm.mixing import mix_sources
from sparkassay.llm.packing import best_fit_sequences
from sparkassay.llm.personal import find_personal, redacted
from sparkassay.llm.toxicity import fit, held_out, scorer
from sparkassay.llm.weighted_minhash import near_documents
from sparkassay.session import cut_lineage


#: Packing's memory in the pipeline: token pieces remembered per Python worker and tokens packed at a time.
PACK_REMEMBERED, PACK_GROUP_TOKENS = 300_000, 2_000_000


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below one half; the model learns from the labels that are not held out."""
    labels = table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id"), 5))
    model = fit(docs, labels, id_col="doc_id", text_col="text", label_col="toxic")
    return docs.where(scorer(model)(F.col("text")) < 0.5)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each class; of rows that repeat an id, the first by text."""
    classes = cut_lineage(near_documents(docs), "classes")
    gone = classes.where(~F.col("kept")).select("doc_id").distinct()
    again = classes.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id")
    # a merge join at every size, so that nothing that grows with the corpus is broadcast
    left = docs.join(gone.hint("merge"), "doc_id", "left_anti")
    if again.isEmpty():
        return left.select(docs.columns)
    first = Window.partitionBy("doc_id").orderBy("text", "source")
    repeated = left.join(again, "doc_id", "left_semi").withColumn("nth", F.row_number().over(first)).where("nth = 1")
    once = left.join(again, "doc_id", "left_anti")
    return once.unionByName(repeated.drop("nth")).select(docs.columns)


def mask_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with every span of personal data replaced by its kind; ``n_chars`` follows."""
    found = find_personal(docs).documents.where((F.size("base") > 0) | (F.size("added") > 0))
    found = found.select(
        F.col("doc_id").alias("own_id"), F.col("text_key").alias("own_key"), F.concat("base", "added").alias("spans")
    )
    found = cut_lineage(found.dropDuplicates(["own_id", "own_key"]), "spans")
    text = F.coalesce("text", F.lit(""))
    same = F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.xxhash64(text) == F.col("own_key"))
    masked = docs.join(found, same, "left")
    new = F.when(F.col("spans").isNull(), F.col("text")).otherwise(redacted(text, F.col("spans")))
    masked = masked.withColumn("text", new)
    size = F.when(F.col("spans").isNull(), F.col("n_chars")).otherwise(F.char_length("text").cast("long"))
    return masked.withColumn("n_chars", size).select(docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the schedule takes their first word, none to three times; texts without words stay."""
    taken = mix_sources(docs).documents
    copies = F.when(F.col("size") == 0, 1).otherwise(F.col("copies"))
    taken = taken.groupBy(F.col("doc_id").alias("own_id")).agg(F.max(copies).cast("int").alias("copies"))
    taken = cut_lineage(taken.where("copies > 0"), "copies")
    mixed = docs.join(taken.hint("merge"), F.col("doc_id").eqNullSafe(F.col("own_id")))
    return mixed.select(*docs.columns, F.explode(F.array_repeat(F.lit(0), F.col("copies"))).alias("copy")).drop("copy")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the mixed documents with their token ids and their place in sequences of at most 1024 tokens."""
    # workers of the earlier stages still hold their state: a smaller memory of token pieces and smaller groups
    pieces = best_fit_sequences(docs, group_tokens=PACK_GROUP_TOKENS, remembered=PACK_REMEMBERED)
    return pieces.withColumn("length", (F.octet_length("ids") / 4).cast("long"))


STAGES = [
    ("toxicity", drop_toxic), ("near duplicates", drop_near_duplicates), ("personal data", mask_personal),
    ("source mix", mix), ("packing", pack),
]

#: Model fits, near duplicates and token ids have no SQL form; tests compare the stages with plain ones instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
