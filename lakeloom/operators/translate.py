"""Translate a text column with an injected function, calling it as little as possible."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from uuid import uuid4

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.storage import delete_folder, folder_bytes, path_exists, subfolders

# Called once per task; gives the function that translates a list of texts.
TranslatorFactory = Callable[[], Callable[[list[str]], list[str]]]

# UTF-8 bytes of text that a call gets; an Arrow batch may hold 64 MB.
CALL_BYTES = 1 << 20


SCHEMA = T.StructType([T.StructField("_digest", T.StringType()), T.StructField("_result", T.StringType())])


def stored_translations(spark: SparkSession, store: str) -> DataFrame:
    """(_digest, _result) of a store, one row per digest, however many runs have translated a text.

    Of different translations of one text the least counts, in every run alike.
    """
    # Its files are listed here, so what is found holds for every later action.
    found = spark.read.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(store)
    if len(subfolders(spark, store)) < 2 or found.groupBy("_digest").count().where("count > 1").isEmpty():
        return found
    return found.groupBy("_digest").agg(F.min("_result").alias("_result"))


def compact_store(spark: SparkSession, store: str) -> None:
    """Rewrite a store to one row per digest in one folder. No run may be under way."""
    if not path_exists(spark, store):
        return
    present = subfolders(spark, store)
    stored_translations(spark, store).write.parquet(f"{store}/run={uuid4().hex}")
    for folder in present:
        delete_folder(spark, folder)


def _caller(factory: TranslatorFactory, attempts: int, retry_wait: float) -> Callable:
    """Gives, once started, the translations of a column without nulls, in order and a piece at a time.

    A piece has about :data:`CALL_BYTES` of text, a longer text is a piece of its own, and only the
    piece at hand is turned into Python strings. Self-contained, so workers need not be able to
    import this package.
    """

    def start() -> Callable[[pa.Array], Iterator[pa.Array]]:
        translate = factory()

        def call(texts: list[str]) -> list[str]:
            for attempt in range(1, attempts + 1):
                try:
                    results = list(translate(texts))
                    break
                except Exception:
                    if attempt == attempts:
                        raise
                    time.sleep(retry_wait * 2 ** (attempt - 1))
            if len(results) != len(texts):
                raise ValueError(f"{len(texts)} texts gave {len(results)} translations")
            return results

        def pieces(column: pa.Array) -> Iterator[pa.Array]:
            first, held = 0, 0
            for i, size in enumerate(pc.binary_length(column).to_pylist()):
                if i > first and held + size > CALL_BYTES:
                    yield pa.array(call(column.slice(first, i - first).to_pylist()), pa.string())
                    first, held = i, 0
                held += size
            if first < len(column):
                yield pa.array(call(column.slice(first).to_pylist()), pa.string())

        return pieces

    return start


def translate_column(
    df: DataFrame,
    column: str,
    output: str,
    factory: TranslatorFactory,
    store: str | None = None,
    tasks: int | None = None,
    attempts: int = 3,
    retry_wait: float = 1.0,
) -> DataFrame:
    """Add ``output``, the translation of ``column``; null where the text is null.

    Each distinct text is translated once, whatever the number of its copies: distinct texts are
    found with a map-side combine, translated in Arrow batches by tasks all over the cluster, and
    joined back. The join compares SHA-256 digests, so only the rows themselves and the
    translations are shuffled, and Spark broadcasts the translations when they turn out small.
    Rows of a popular text, or without one, pile up on the left of a left join, where AQE splits
    them.

    ``store`` is a folder that keeps translations: texts found there are not translated again, new
    ones are written there before the join. So neither a second action nor a lost executor repeats
    a call, and Spark knows the size of the translations when it plans the join: with small ones
    the rows are not shuffled at all. Each run writes a folder of its own there, so runs that start together may translate
    a text twice but neither lose nor multiply rows; :func:`compact_store` tidies up. Without a store everything stays lazy.

    AQE sizes tasks by bytes. Where calls are slow, ``tasks`` says how many tasks share them. A call
    gets about :data:`CALL_BYTES` of text, however large Spark makes the Arrow batches.
    """
    start = _caller(factory, attempts, retry_wait)

    def translate_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = start()
        for batch in batches:
            done = 0
            for results in pieces(batch.column(1)):
                digests = batch.column(0).slice(done, len(results))
                yield pa.RecordBatch.from_arrays([digests, results], ["_digest", "_result"])
                done += len(results)

    texts = df.select(F.col(column).alias("_text")).filter("_text is not null").distinct()
    texts = texts.select(F.sha2("_text", 256).alias("_digest"), "_text")
    spark = df.sparkSession
    if store is not None and folder_bytes(spark, store) > 0:
        known = spark.read.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(store)
        texts = texts.join(known.select("_digest"), "_digest", "left_anti")
    if tasks is not None:
        texts = texts.repartition(tasks, "_digest")
    translations = texts.mapInArrow(translate_batches, SCHEMA)
    if store is not None:
        translations.write.parquet(f"{store.rstrip('/')}/run={uuid4().hex}")
        translations = stored_translations(spark, store)
    translations = translations.withColumnRenamed("_result", output)
    keyed = df.withColumn("_digest", F.sha2(F.col(column), 256))
    return keyed.join(translations, "_digest", "left").drop("_digest")


def translate_in_batches(
    df: DataFrame,
    column: str,
    output: str,
    factory: TranslatorFactory,
    attempts: int = 3,
    retry_wait: float = 1.0,
) -> DataFrame:
    """Like :func:`translate_column` without a shuffle, for a bounded number of rows.

    Copies share a call only within an Arrow batch. Nothing below is evaluated twice, and a limit
    below stays below.
    """
    start = _caller(factory, attempts, retry_wait)
    position = df.columns.index(column)
    names = [*df.columns, output]

    def translate_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = start()
        for batch in batches:
            values = batch.column(position).dictionary_encode()
            known = pa.concat_arrays([pa.array([], pa.string()), *pieces(values.dictionary)])
            yield pa.RecordBatch.from_arrays([*batch.columns, known.take(values.indices)], names)

    schema = T.StructType([*df.schema.fields, T.StructField(output, T.StringType())])
    return df.mapInArrow(translate_batches, schema)
