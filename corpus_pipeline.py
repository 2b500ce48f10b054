"""From documents to token ids: toxic documents go, repeated lines go, one document of each group of
near copies stays, sources are mixed, and what is taken is encoded.

Every stage takes and returns the columns of ``documents``, the last one adds the ids. A stage's
result is written as Parquet and read by the next; a result that reads files which the stage left on disk
has to be written before another stage is called, unless that one takes it as its documents, for
these files go as soon as a stage is called that does not read them.

Defined cases of all stages: null and empty texts are neither toxic nor copies of anything and stay; rows that share an
id are scored, shortened and encoded one by one, and go together if their id is that of a near copy; rows without an
id are never near copies; tables may be empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rootweave.llm import bpe, jaccard, linedup, mixing, toxicity
from rootweave.llm.common import table
from rootweave.operators.skew import anti_join, stage_keys
from rootweave.workspace import Workspace

TOXIC_FROM = 0.3
MAX_REPEATS = 2.0
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

_left: list[Workspace] = []


def workspace(spark: SparkSession, docs: DataFrame) -> Workspace:
    """A workspace for a stage on ``docs``; those of earlier stages go unless ``docs`` still reads their files."""
    read = docs.inputFiles()
    kept = [ws for ws in _left if ws.spark is spark and any(f"/{ws.path.rpartition('/')[2]}/" in file for file in read)]
    for ws in _left:
        if ws.spark is spark and ws not in kept:
            ws.close()
    ws = Workspace(spark)
    _left[:] = [*kept, ws]
    return ws


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below the limit; null and empty texts stay."""
    with workspace(spark, docs) as ws:
        model = toxicity.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ws)
        _left.remove(ws)
    scored = toxicity.score(docs, model, result_col="_toxicity")
    blank = F.coalesce(F.trim("text"), F.lit("")) == ""
    return scored.filter(blank | (F.col("_toxicity.score") < TOXIC_FROM)).select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the multi-line chunks that stand elsewhere before; ``n_chars`` follows the text."""
    shorter = linedup.drop_repeated_lines(docs, workspace(spark, docs))
    length = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text"))
    return shorter.withColumn("n_chars", length.cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies, and all that have no near copy."""
    ws = workspace(spark, docs)
    groups = jaccard.jaccard_components(docs, ws, size=5, percent=80)
    copies = stage_keys(groups.filter("component_id <> doc_id").select("doc_id"), ws, "copies")
    return anti_join(docs, copies, "doc_id").select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document once or more, so that smaller sources weigh more; no document is left out."""
    planned = mixing.plan(docs, workspace(spark, docs), max_repeats=MAX_REPEATS)
    return mixing.realise(docs, planned, epoch_col=None, order_col=None)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their token ids, checked by decoding them again."""
    import public_tokenizers as tokenizers

    workspace(spark, docs)
    ranks = tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = bpe.encode(docs.select("doc_id", "text"), ranks, tokenizers.PATTERN, check=True)
    return encoded.select("doc_id", "n_tokens", "ids")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("jaccard_join", drop_near_copies),
    ("mixing", mix),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``."""
    ws = Workspace(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = ws.stage(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


# The tagger's marginals and the tokenizer's merges have no SQL form; the tests compare with brute force.
ORACLE_SQL = None

QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
