"""From raw documents to a mix: language, near-duplicates, contamination, personal data, source weights."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrapulse.llm import contamination, langid, mixing, neardup, pii
from terrapulse.session import materialise

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognisable language go: null texts and texts without letters.

    If no language could be learned, every text with letters stays.  Very long texts are read in pieces; repeated rows
    are judged alike; an empty table stays empty; other columns than those of documents are dropped.
    """
    found = langid.identify(docs, carry=COLUMNS[1:])
    return found.where((F.col("lang_pred") != langid.UNDETERMINED) | F.col("text").rlike(r"\p{L}")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class one document stays: that with the smallest id, and of several texts of that id the one with the smallest hash.

    Rows are told apart by id and text, so a row stays if its own text is in no other class member.  Of repeated rows
    one stays; rows without an id stay; an empty table stays empty.
    """
    marked = neardup.find_groups(docs, with_text=True)
    gone = marked.where((F.col("doc_id") != F.col("class_id")) | (F.col("tag") != F.col("class_tag"))).select("doc_id", F.col("tag").alias("_tag")).distinct()
    tagged = docs.select(*COLUMNS, F.coalesce(F.xxhash64("text"), F.lit(0)).alias("_tag"))
    named = tagged.where(F.col("doc_id").isNotNull()).join(gone, ["doc_id", "_tag"], "left_anti")
    once = named.dropDuplicates(["doc_id", "_tag"]).select(*COLUMNS)
    return once.union(docs.where(F.col("doc_id").isNull()).select(*COLUMNS))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with at least a twentieth of their words in benchmark windows go.

    Null and empty texts, repeated rows, documents without hits and everything else stay as they are; without benchmark
    items all documents stay.
    """
    found = contamination.find_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), carry=COLUMNS[1:])
    return found.where(~contamination.is_contaminated(F.col("n_words"), F.col("n_hit"))).select(*COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span is replaced by its kind; ``n_chars`` is counted anew (null for a null text); no document goes."""
    found = pii.find_pii(docs, carry=COLUMNS[1:])
    clean = found.withColumn("text", pii.redact(F.col("text"), F.concat("base", "added")))
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: the documents it takes, redacted text included, with ``taken``, the words to take of each (repeats counted).

    Documents of which nothing is taken go; a document is taken ``taken div size`` times whole, and its first
    ``taken % size`` words once more.
    """
    return mixing.mix_sources(docs, carry=("text", "lang", "n_chars")).where("taken > 0")


STAGES = [
    ("language_id", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("source_mix", mix),
]

#: Language models and weighted sampling have no SQL form; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
