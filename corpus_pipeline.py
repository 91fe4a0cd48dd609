"""A corpus from raw documents to packed sequences: five stages, each one operator.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as
Parquet and read again as the next one's documents. All but the last return the columns of
documents.

Documents may have further columns, of any name and type, those of an operator's own results and
names with dots included: a stage carries the whole row as one column past its operator.
Nulls may stand in any column. Repeated rows are documents of their own, but for the
near-duplicate stage, which keeps one of them. An empty table gives an empty one. Stages leave
the session's settings as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dwelltide.llm import secret_scan
from dwelltide.llm.language import identify_languages, learn_languages
from dwelltide.llm.mixing import mixed, plan_mix
from dwelltide.llm.packing import pack_sequences
from dwelltide.llm.rows import carried, quoted, row_hash, unpacked
from dwelltide.llm.simhash import fingerprint, near_duplicates
from dwelltide.session import remove_folder, run_folder, settings

#: Words of a shingle of the near-duplicate stage, and bits by which fingerprints may differ.
SHINGLE, MAX_BITS = 3, 2
#: Documents per Arrow batch: they are long, and a batch stands in memory several times on its
#: way to Python and back.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}


def _written(spark: SparkSession, name: str, rows: DataFrame) -> DataFrame:
    """``rows`` as files, made in small batches. Spark reads that setting when it runs, so a result that is
    written later would not have it. For the stages that need it most: it is a copy on disk."""
    path = f"{run_folder(spark, name)}/rows"
    with settings(spark, BATCHES):
        rows.write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the corpus teaches stay, and take the language found:
    without a letter, or too far from every learned language, they go.

    Null and empty texts have no letter. Texts are read whole, however long. Languages equally
    near go by name, so repeated rows are answered alike. Documents of a null language teach
    nothing, and are answered. Columns called like the operator's results stay.
    """
    with settings(spark, BATCHES):
        model = learn_languages(docs)
    found = identify_languages(carried(docs, F.col("text")), model).filter("lang_accepted")
    return unpacked(found, docs.columns, lang=F.col("lang_pred"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays: the one of the smallest id, null last.

    Null and empty texts are alike, and one of them stays. Of several rows of that id in a
    class, repeated or not, the one of the smallest hash over all columns stays, whatever types
    these have. Null ids stand in as many classes as their texts do. Fingerprints are computed once,
    and written beside the documents.
    """
    rows = carried(
        docs, F.col("doc_id").alias("id"), fingerprint(F.col("text"), SHINGLE).alias("print"), row_hash(docs).alias("tie")
    )
    rows = _written(spark, "prints", rows)
    classes = near_duplicates(rows, id_col="id", print_col="print", max_bits=MAX_BITS)
    staying = classes.filter("stays").select(
        F.col("id").alias("kept_id"), F.col("fingerprint").alias("kept_print"), "copies"
    ).distinct().checkpoint()
    # Null and repeated ids stand in several classes: only id and fingerprint name one.
    of_class = F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("print") == F.col("kept_print"))
    kept = rows.join(staying, of_class)
    alone = kept.filter("copies = 1").select("row")
    if not staying.filter("copies > 1").isEmpty():
        repeated = kept.filter("copies > 1").groupBy("kept_id", "kept_print")
        alone = alone.unionByName(repeated.agg(F.min_by("row", "tie").alias("row")).select("row"))
    return unpacked(alone, docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; a secret's kind in brackets stands in its place, and ``n_chars`` follows.

    Null and empty texts have no secrets and stay as they are. Texts are read whole, in time
    proportional to them. Overlapping findings become one. Repeated rows are answered alike.
    Findings are written beside the documents: in one task, finding and redacting would each have a Python
    worker, and executors keep the most workers that they ever had.
    """
    rows = _written(spark, "secrets", secret_scan.find_secrets(carried(docs, F.col("text"))).drop("text"))
    found = secret_scan.redact(rows.withColumn("text", F.col("row.text")))
    return unpacked(found, docs.columns, text=F.col("text"), n_chars=F.length("text").cast("long"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target proportions: a document stands there as often as it is taken.

    A null source is a source; null texts and texts without words go. Of the one document in which a
    source's last pass ends, its first words stay, and ``n_chars`` follows. Rows of one id, repeated or
    not, are placed by text, then by a hash over all columns, and are taken one by one.
    """
    mix = carried(mixed(docs, plan_mix(docs)))
    n_chars = F.length(f"row.{quoted('text')}").cast("long")
    return unpacked(mix, docs.columns, n_chars=n_chars)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of a document, with its text and its place in a packed sequence.

    Null texts, and those without words, are one piece of no words. Long texts are cut between
    words into pieces that are the whole text together. Repeated rows are packed each. Pieces of
    equal length go to the bin opened first. Columns but id and text are not read.
    """
    return _written(spark, "packed", pack_sequences(docs, with_text=True))


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", simhash_near_dedup),
    ("secret_scan", redact_secrets),
    ("source_mixing", mix_sources),
    ("best_fit_packing", best_fit_packing),
]

# Hashes, trained centroids and bins have no SQL; tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each from the files of the one before, which then go."""
    folder, before = run_folder(spark, "corpus"), None
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            remove_folder(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
