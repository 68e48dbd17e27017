"""The corpus pipeline: raw documents to packed training sequences.

Each stage is one operator of ``cohortkit.llm`` at work on all that the
stage before it kept: ``(spark, docs, sf_dir) -> DataFrame`` with the
columns of ``documents``, but for the last, which returns packed pieces.
``run`` writes every stage's result to the shared checkpoint folder and
reads it back, so a lost executor never sets the pipeline back to its start.

NULL texts count as empty; repeated rows, empty tables and further columns
pass through the stages as their operators define.
"""

from __future__ import annotations

import functools

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortkit.llm.common import packed, quoted, release, saved, table
from cohortkit.llm.line_dedup import line_dedup
from cohortkit.llm.ngram_join import near_duplicates
from cohortkit.llm.packing import pack
from cohortkit.llm.quality_rules import quality_rules
from cohortkit.llm.secrets import redact
from cohortkit.session import drop_scratch, scratch_paths

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


_made: dict[str, list[str]] = {}  # stage -> paths its calls have written and not dropped


def _drop(spark: SparkSession, paths: list[str]) -> None:
    left = set(scratch_paths())
    drop_scratch(spark, [p for p in paths if p in left])


def _stage(work):
    """A stage's intermediate files go when a later stage of the list begins: what that one
    reads has been written by then. Other calls of the same stage keep theirs."""
    @functools.wraps(work)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        order = [stage.__name__ for _, stage in STAGES]
        for earlier in order[:order.index(work.__name__)]:
            _drop(spark, _made.pop(earlier, []))
        before = set(scratch_paths())
        out = work(spark, docs, sf_dir)
        _made.setdefault(work.__name__, []).extend(p for p in scratch_paths() if p not in before)
        release()  # what the driver held for this stage's filters, counters and training
        return out
    return run_stage


def _as_documents(out: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs``, the length column recounted if there is one."""
    if "n_chars" in out.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select([quoted(c) for c in docs.columns])


@_stage
def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or lie far outside their group go."""
    return quality_rules(docs).where("kept").select([quoted(c) for c in docs.columns])


@_stage
def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A line that ten or more documents share stays in the first of them; documents that
    consisted of such lines only go."""
    out = line_dedup(docs, min_docs=10, keep="first")
    return _as_documents(out.where((F.col("n_dropped") == 0) | (F.length(F.trim("text")) > 0)), docs)


@_stage
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the row with the smallest (id, position) stays, and
    every row that links with none. Rows are told apart by a written position, so rows that
    repeat an id go only if their texts are near duplicates of a row that stays. Rows without
    an id take no part and all stay."""
    rows = saved(docs.select(packed(docs).alias("row"), quoted("doc_id").alias("id"), quoted("text").alias("text"),
                             F.monotonically_increasing_id().alias("position")), "numbered-documents")
    known = rows.where("id IS NOT NULL")
    groups = near_duplicates(known.select("position", "text"), id_col="position")
    # one small row per document: its group, its id; groups combine before they shuffle
    firsts = (groups.join(known.select("position", "id"), "position").groupBy("component_id")
              .agg(F.min(F.struct("id", "position")).alias("first")).select(F.col("first.position").alias("kept")))
    left = known.join(firsts, F.col("position") == F.col("kept"), "left_semi").unionByName(rows.where("id IS NULL"))
    return left.select([F.col("row").getField(c).alias(c) for c in docs.columns])


@_stage
def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are replaced by a mark."""
    return _as_documents(redact(docs), docs)


@_stage
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences; the ids in base64, little-endian unsigned 32-bit."""
    return pack(docs, TOKENIZER, columns=["doc_id"]).withColumn("ids", F.base64("ids"))


STAGES = [
    ("quality_rules", drop_low_quality),
    ("line_dedup", drop_shared_lines),
    ("ngram_join", drop_near_duplicates),
    ("secret_scan", redact_secrets),
    ("packing", pack_sequences),
]

#: The trained and estimated stages can't be written in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of all documents that the stages keep."""
    docs, written = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        before = set(scratch_paths())
        docs = saved(out, f"pipeline-{name}")
        path = [p for p in scratch_paths() if p not in before]
        # the stage's result is written: its own files and its input go
        _drop(spark, _made.pop(stage.__name__, []) + (written or []))
        written = path
    return STAGES[-1][1](spark, docs, sf_dir)
