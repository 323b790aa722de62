"""A text-corpus pipeline: toxicity, near-duplicates, personal data, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next stage's documents.  All but the last return the columns of ``documents``.

Defined results: an empty table passes through all stages as an empty one.  Rows with a null id
stay through the filtering stages unless their text is rejected as toxic; of rows with an id and
no words in their text (null, empty or blank) the near-duplicate stage keeps one.  Extra columns are
kept up to the last stage, whatever their names; the mixing stage replaces one named ``copy``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bulkflow.llm import pii_transducer, poisson_mix, sentencepiece_bpe, simhash_ring, toxicity_pu
from bulkflow.llm.common import ship
from bulkflow.llm.components import durable
from bulkflow.llm.contract import tokenizer_file
from bulkflow.session import fresh_dir

#: Near-duplicates as the contract of op6 has them: four-word shingles, 64 bits, links at 4 bits or fewer.
SHINGLE, DIFFERING_BITS, SEGMENTS = 4, 4, 5
#: A document this likely to be toxic goes.
TOXIC = 0.5


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject."""
    model = toxicity_pu.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.where(toxicity_pu.score_column(model, docs["text"]) < TOXIC)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id.

    Groups are of rows, by their own fingerprints; of several rows with that id in a group the one with
    the smallest hash stays, and of equal rows one.  Rows with a null id all stay.  Texts without words
    are one group, with all texts near the fingerprint zero.
    """
    # Nulls leave a hash as it is, hence the marks.
    row_hash = F.xxhash64(*(docs[c] for c in docs.columns), *(docs[c].isNull() for c in docs.columns))
    found = simhash_ring.near_duplicates(docs, SHINGLE, DIFFERING_BITS, SEGMENTS, mark=row_hash)
    rows = found.where("doc_id is not null").groupBy("component_id", "doc_id", "mark").agg(F.count(F.lit(1)).alias("n"))
    rows = durable(rows)
    first = rows.groupBy("component_id").agg(F.min(F.struct("doc_id", "mark")).alias("first"), F.count(F.lit(1)).alias("rows")).where("rows > 1")
    others = rows.join(first, "component_id").where(F.struct("doc_id", "mark") != F.col("first")).select("doc_id", "mark")
    hashed = _unused("row_hash", docs.columns)
    marked = docs.withColumn(hashed, row_hash)

    def are(keys: DataFrame) -> Column:
        return (marked["doc_id"] == keys["doc_id"]) & (marked[hashed] == keys["mark"])

    repeated = rows.where("n > 1").select("doc_id", "mark")
    kept = marked.join(others, are(others), "left_anti")
    if repeated.isEmpty():
        return kept.select(docs.columns)
    once = marked.join(others, are(others), "left_anti").join(repeated, are(repeated), "left_semi").dropDuplicates(["doc_id", hashed])
    return kept.join(repeated, are(repeated), "left_anti").union(once).select(docs.columns)


def _unused(name: str, columns: list[str]) -> str:
    """A column name that no column has, whatever the case."""
    taken = {c.lower() for c in columns}
    while name in taken:
        name += "_"
    return name


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data in their texts masked."""
    ship(spark)
    masked = docs.withColumn("text", pii_transducer.redact_column(docs["text"]))
    if "n_chars" not in docs.columns:
        return masked
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents replicated so that sources have weights of the square roots of their sizes."""
    columns = docs.columns
    return poisson_mix.mix(docs, poisson_mix.tempered_weights(docs)).select(columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, source, lang, n_tokens, ids): the token ids of every document."""
    vocabulary = sentencepiece_bpe.Vocabulary.read(tokenizer_file("piece_bpe_32k.model"))
    ship(spark)
    ids = docs.select("doc_id", "source", "lang", sentencepiece_bpe.encode_column(vocabulary, docs["text"]).alias("ids"))
    return ids.select("doc_id", "source", "lang", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("toxicity", without_toxic),
    ("near duplicates", without_near_duplicates),
    ("personal data", without_personal_data),
    ("mixing", mixed),
    ("tokens", tokens),
]

# The fitted classifier, fingerprints and the tokenizer are not SQL; tests/llm holds a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = fresh_dir(spark, name.replace(" ", "-"))
        out = stage(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
