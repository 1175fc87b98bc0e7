"""Corpus pipeline: toxicity, near duplicates, repeated passages, source mix, packing."""

from __future__ import annotations

from collections.abc import Callable
from contextvars import ContextVar
from functools import wraps

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslens.llm.expressions import free_name
from corpuslens.llm.mixing import mix_sources
from corpuslens.llm.ngram_join import one_of_each
from corpuslens.llm.packing import pack_documents
from corpuslens.llm.substrings import cut_repeats
from corpuslens.llm.toxicity import score_toxicity, train
from corpuslens.storage import delete_folder, stage, work_path, working_in

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: Folders of working tables of the stages that this thread of control has run since the first one.
_folders: ContextVar[tuple[str, ...]] = ContextVar("stage-folders", default=())


def _in_own_folder(function: Stage) -> Stage:
    """The stage with its working tables in a folder of its own, deleted when a later stage begins.

    By then the stage's result is stored, as a rule, and nothing needs them. Where ``docs`` is not
    stored and still reads a folder, that folder stays. The first stage deletes nothing, as the last
    one's result may still be read; runs in different threads don't see each other's folders.
    """

    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        waiting = () if function.__name__ == STAGES[0][0] else _folders.get()
        read = docs.inputFiles() if waiting else []
        needed = tuple(x for x in waiting if any(f"/{x.rsplit('/', 1)[1]}/" in f for f in read))
        for x in waiting:
            if x not in needed:
                delete_folder(spark, x)
        folder = work_path(spark, f"stage-{function.__name__}")
        _folders.set((*needed, folder))
        with working_in(folder):
            return function(spark, docs, sf_dir)

    return run_stage


@_in_own_folder
def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the machine, fitted on the labels, does not predict toxic."""
    machine = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    own = {c: free_name(docs, f"_{c}") for c in docs.columns if c.lower() in ("score", "predicted")}
    scored = score_toxicity(docs.withColumnsRenamed(own), machine).filter("predicted = 0").drop("score", "predicted")
    return scored.withColumnsRenamed({v: k for k, v in own.items()})


@_in_own_folder
def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the least id of each class of near duplicates."""
    return one_of_each(docs)


@_in_own_folder
def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the words of passages that start earlier."""
    return cut_repeats(docs)


@_in_own_folder
def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, stored in the order of the mix.

    The schedule is made of ids and sources alone; a row is told by where it is stored, and texts
    move twice: to their slots, and into order.
    """
    path, row = free_name(docs, "_stored_in"), free_name(docs, "_stored_at")
    slot, offset = free_name(docs, "_slot"), free_name(docs, "_offset")

    def placed(stored: DataFrame) -> DataFrame:
        at = stored.metadataColumn("_metadata")
        return stored.select("*", at["file_path"].alias(path), at["row_index"].alias(row))

    try:
        rows = placed(docs)
    except AnalysisException:  # of a plan, which no file holds
        rows = placed(stage(docs, "to-mix"))
    mix = mix_sources(rows.select("doc_id", "source", path, row), carry=[path, row])
    mix = stage(mix.select(path, row, F.col("slot").alias(slot), F.col("offset").alias(offset)), "mix")
    ordered = rows.join(mix.hint("merge"), [path, row]).repartitionByRange(slot, offset)
    return ordered.sortWithinPartitions(slot, offset).select(*docs.columns)


@_in_own_folder
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences in the order of the mix: one row for each piece of a document, with its place.

    ``docs`` must be stored, as its order is that of the mix; a plan that no file holds is stored first.
    """
    try:
        return pack_documents(docs, in_stored_order=True)
    except AnalysisException:
        return pack_documents(stage(docs, "to-pack"), in_stored_order=True)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("ngram_join", ngram_join),
    ("substring_dedup", substring_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

#: Trained weights and a tokenizer decide rows, which SQL can't express; tests hold run() against
#: brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
