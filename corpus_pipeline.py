"""The corpus pipeline: five stages over ``documents``, each written and read again.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. The first four
return the columns they are given; the last returns the mix, one row per document. Ids may be null or
repeated; a stage that keeps one document of a group keeps one row of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm import decontaminate, langid, mixing, simhash, toxicity
from lakeloom.llm.common import materialize, remainder, table
from lakeloom.operators.compare import orderable
from lakeloom.operators.reduced_joins import anti_join, semi_join
from lakeloom.storage import release_scratch, scratch_mark, scratch_root


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic; all of them if there is no label to learn from."""
    labels = table(spark, sf_dir, "labels").where(remainder("doc_id", 4) != 2)
    weights = toxicity.train(docs, labels)
    if not weights.any():
        return docs
    return docs.where(toxicity.score_udf(spark, weights)(F.col("text")) < 0.3)


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages of the corpus: with a letter, and within the calibrated limit.

    All of them if no document names its language.
    """
    model = langid.train(docs.where(remainder("doc_id", 5) != 0))
    if not model.languages:
        return docs
    return docs.where(~langid.identify_udf(spark, model)(F.col("text"))["rejected"])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints, the one of the smallest id.

    Where rows repeat that id, the least of them in the order of their columns stays. The ids that go, and those that
    repeat, are few; a filter made of them decides the other rows where they stand, so their texts are not shuffled.
    """
    since = scratch_mark()
    found = simhash.near_duplicates(docs, shingle=4, distance=4)
    first = F.col("doc_id").eqNullSafe(F.col("component_id"))
    ids = found.groupBy("doc_id").agg(F.count_if(first).alias("firsts"), F.count("*").alias("n"))
    marked = materialize(ids.where("firsts <> 1 OR n > 1"), "near-duplicate-ids")
    # What the search wrote is not needed any more.
    release_scratch(spark, since, keep=(f"{scratch_root(spark)}/lakeloom/near-duplicate-ids",))
    single = anti_join(docs, marked, ["doc_id"], null_safe=True)
    repeated = marked.where("firsts > 0")
    if repeated.isEmpty():
        return single
    several = semi_join(docs, repeated, ["doc_id"], null_safe=True)
    order = F.struct(*[orderable(F.col(f.name), f.dataType).alias(f.name) for f in docs.schema])
    least = several.groupBy("doc_id").agg(F.min_by(F.struct(*docs.columns), order).alias("row")).select("row.*")
    return single.unionByName(least)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold less of the benchmark than the contamination rule names."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"), window=13, share=20)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    return mixing.taken(mixing.schedule(docs))


STAGES = [
    ("toxicity", drop_toxic),
    ("language", keep_known_languages),
    ("near duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]

#: Learned weights decide the first stages, which SQL cannot express; tests hold run() against plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. What a stage wrote on its way is deleted once its result is written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        since, label = scratch_mark(), f"pipeline-{name.replace(' ', '-')}"
        docs = materialize(stage(spark, docs, sf_dir), label)
        release_scratch(spark, since, keep=(f"{scratch_root(spark)}/lakeloom/{label}-",))
    return STAGES[-1][1](spark, docs, sf_dir)
