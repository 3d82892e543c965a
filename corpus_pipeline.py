"""A corpus pipeline of five stages over `documents`.

Each stage takes (spark, docs, sf_dir) and returns the rows it keeps; `run` writes
every stage's rows to the shared folder and reads them again as the next one's docs.
All columns of documents pass through, whatever else they are called. A row is known by
its doc_id and text together, so that rows of one doc_id with different texts are judged
apart; repeated rows share their fate. Rows of null doc_id are judged by their text; the
near-duplicate stage keeps them, and the last stage, which draws by doc_id, drops them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratagrid.llm import decontaminate, langid, minhash_dedup, mixing, secret_scan
from stratagrid.llm.common import Workspace, opened, table

#: Documents with no letter, or whose best language is less likely than this, are rejected.
LEAST_LANGUAGE_SCORE = 0.4


def _packed(docs: DataFrame, *columns: Column) -> DataFrame:
    """text, and the other columns of `docs` in one, so that no name of theirs meets an operator's, and `columns`."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "text")).alias("row_of_docs"), F.col("text"), *columns)


def _unpacked(docs: DataFrame) -> list[Column]:
    return [F.col("text") if c == "text" else F.col("row_of_docs")[c].alias(c) for c in docs.columns]


def _row_key(docs: DataFrame) -> Column:
    return F.xxhash64(docs["doc_id"], docs["text"].cast("string"))


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with the row key for a doc_id."""
    return docs.select(_row_key(docs).alias("doc_id"), F.col("text"))


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """`docs` without the rows whose keys are the doc_ids of `gone`."""
    gone = gone.select(F.col("doc_id").alias("key_of_gone")).distinct()
    return docs.join(gone, _row_key(docs) == gone["key_of_gone"], "left_anti")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter (null and empty ones too) or with no likely language go."""
    found = langid.predict(_packed(docs), langid.fit(docs))
    kept = found.where((F.col("__lang_pred") != langid.UNKNOWN) & (F.col("__lang_score") >= LEAST_LANGUAGE_SCORE))
    return kept.select(*_unpacked(docs))


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document of the smallest doc_id stays; texts without words and null doc_ids stay."""
    found = minhash_dedup.near_duplicates(docs, Workspace(spark, "pipeline-dedup"))
    gone = found.where("not kept").select(F.xxhash64("doc_id", "text_id").alias("key_of_gone")).distinct()
    return docs.join(gone, F.xxhash64(docs["doc_id"].cast("long"), F.xxhash64(docs["text"].cast("string"))) == gone["key_of_gone"], "left_anti")


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go of whose words 5 % or more stand in benchmark windows."""
    found = decontaminate.benchmark_matches(_keyed(docs), table(spark, sf_dir, "benchmark"), Workspace(spark, "pipeline-benchmark"))
    return _without(docs, decontaminate.contamination(found).where("contaminated"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a base finding or a linked token that looks random go; other links (long paths, rules, slugs) don't count."""
    found = secret_scan.secret_spans(_keyed(docs), Workspace(spark, "pipeline-secrets"))
    return _without(docs, found.where("size(base) > 0 or size(strong) > 0"))


def mixing_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample by calibrated probabilities, with mix_topic, mix_tokens and mix_probability (columns of these names are replaced)."""
    mixed = mixing.mix(_packed(docs, *(F.col(c) for c in ("doc_id", "source", "lang"))), Workspace(spark, "pipeline-mixing"))
    added = {"mix_topic": "__topic", "mix_tokens": "__tokens", "mix_probability": "__probability"}
    return mixed.where("__sampled").select(*(c for c, n in zip(_unpacked(docs), docs.columns) if n not in added), *(F.col(c).alias(n) for n, c in added.items()))


STAGES = [
    ("language_id", language_id),
    ("minhash_near_dedup", minhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scan", secrets),
    ("mixing", mixing_to_targets),
]

#: Language identification and MinHash have no SQL form; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, written and read again; each stage's own tables and its input are removed once it is written, or fails."""
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        before = list(opened())
        kept = Workspace(spark, f"pipeline-{name}-kept")
        try:
            docs = kept.cut(stage(spark, docs, sf_dir))
        except BaseException:
            kept.remove()
            raise
        finally:
            for used in [w for w in opened() if w not in before and w is not kept]:
                used.remove()
            if last is not None:
                last.remove()
        last = kept
    return docs
