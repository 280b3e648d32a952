"""Registered queries of the operators: whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm import (
    chat,
    decontaminate,
    langid,
    lattice,
    mixing,
    neighbours,
    periodic,
    pii,
    quality,
    simhash,
    toxicity,
    url_filter,
    whitening,
)
from lakeloom.llm.common import remainder, table

#: Subword vocabulary of a public tokenizer; read, never copied or trained.
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"


DAY = 24 * 3600
#: First second of the listed time, 2024-01-01 UTC.
EPOCH = 1_704_067_200


def list_entries(pages: DataFrame) -> DataFrame:
    """Dated entries for the hosts, domains and first folders of the pages, spread by md5 over a year.

    Hosts are blocked, delisted and blocked again; domains are allowed, then blocked; first folders are allowed.
    """
    url = F.col("url")
    host = url_filter.host_of(url)
    places = pages.select(
        host.alias("host"), F.element_at(F.split(host, r"\."), -2).alias("name"), F.try_element_at(url_filter.folders_of(url), F.lit(1)).alias("folder")
    ).where(F.col("host").contains("."))
    places = places.distinct()

    def number(text: Column) -> Column:
        return F.conv(F.substring(F.md5(text.cast("binary")), 1, 7), 16, 10).cast("long")

    def entry(name: str, pattern: Column, action: str, day: Column) -> Column:
        return F.struct(
            F.lit(name).alias("list_name"), pattern.alias("pattern"), F.lit(action).alias("action"), (F.lit(EPOCH) + day * DAY).alias("effective_at")
        )

    h = number(F.col("host"))
    domain = F.concat("name", F.lit("."), F.element_at(F.split("host", r"\."), -1), F.lit("/"))
    folder = F.concat("host", F.lit("/"), "folder", F.lit("/"))
    found = F.array(
        entry("hosts", F.concat("host", F.lit("/")), "block", h % 250),
        entry("hosts", F.concat("host", F.lit("/")), "remove", h % 250 + 20 + F.floor(h / 7) % 60),
        entry("hosts", F.concat("host", F.lit("/")), "block", h % 250 + 90 + F.floor(h / 11) % 40),
        entry("domains", domain, "allow", number(domain) % 60),
        entry("domains", domain, "block", number(domain) % 60 + 200),
        entry("folders", folder, "allow", number(folder) % 365),
    )
    return places.select(F.explode(found).alias("entry")).select("entry.*").dropna().distinct()


def op1_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict on every page at its fetch time, by lists made of the pages' own hosts and folders.

    The tables have no fetch times and lists, so both are derived: page ids are spread over the minutes of a year.
    """
    pages = table(spark, folder, "pages").select("page_id", "url")
    captures = pages.withColumn("fetched_at", F.lit(EPOCH) + F.col("page_id") * 7919 % 525_600 * 60)
    return url_filter.filter_captures(captures, list_entries(pages))


def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every document, learned from the labels whose remainder by 3 is not 1."""
    stats = quality.document_stats(table(spark, folder, "documents"))
    model = quality.train(stats, table(spark, folder, "labels").where(remainder("doc_id", 3) != 1))
    scored = quality.score(stats, model)
    return scored.select("doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "score", "predicted")


def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of 4-word shingles and their groups at 4 bits."""
    return simhash.near_duplicates(table(spark, folder, "documents"), shingle=4, distance=4)


def op4_chat(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation against itself with its neighbour's last reply, as prompt and completions.

    The stretches to learn are given as text, ``start-end`` joined by commas.
    """
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    pairs = chat.format_preferences(turns, chat.swapped_replies(turns))

    def spans(name: str) -> Column:
        texts = F.transform(name, lambda span: F.concat(span["start"].cast("string"), F.lit("-"), span["end"].cast("string")))
        return F.array_join(texts, ",").alias(name)

    return pairs.select("pair_id", "n_prompt", "prompt", "chosen", "rejected", spans("chosen_learn"), spans("rejected_learn"), "status")


def op5_lattice(spark: SparkSession, folder: str) -> DataFrame:
    """Log10 probability of every document, learned from those whose remainder by 7 is not 2."""
    learned = remainder("doc_id", 7) != 2
    settings = lattice.LatticeSettings(whole_words=True)
    scored = lattice.score_documents(table(spark, folder, "documents"), learned, VOCABULARY, settings)
    return scored.select(
        "doc_id", (~F.col("training")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op6_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The ten nearest vectors of every hundredth vector, by Euclidean distance."""
    return neighbours.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark windows of 13 words in every document."""
    found = decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"), window=13, share=20)
    return found.drop("spans")


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document, learned from the labels whose remainder by 4 is not 2."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    weights = toxicity.train(docs, labels.where(remainder("doc_id", 4) != 2))
    scored = toxicity.score(docs, weights, threshold=0.3)
    return scored.select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "score", "predicted")


def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Words the mix takes from every document."""
    return mixing.taken(mixing.schedule(table(spark, folder, "documents")))


def op10_language(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, learned from those whose remainder by 5 is not 0."""
    docs = table(spark, folder, "documents")
    model = langid.train(docs.where(remainder("doc_id", 5) != 0))
    found = langid.identify(docs, model)
    return found.select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score", "rejected")


def planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text): every tenth document by crc32 of its id repeats its words from some place on, with some period.

    Other texts, and those of null ids, stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)
    chosen = docs.select("doc_id", "text", g.alias("g"), (F.coalesce(h % 10 == 0, F.lit(False))).alias("chosen"))
    words = F.when(F.col("chosen"), F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda word: word != ""))
    split = chosen.withColumn("words", F.coalesce(words, F.array().cast("array<string>"))).withColumn("n", F.size("words"))
    n = F.col("n")
    a = F.col("g") % n
    p = 1 + F.floor((n - a) / (3 + F.col("g") % 8))
    placed = split.withColumn("a", F.when(n > 0, a).cast("int")).withColumn("p", F.when(n > 0, p).cast("int"))
    n, a, p = F.col("n"), F.col("a"), F.col("p")
    copies = F.flatten(F.array_repeat(F.slice("words", a + 1, p), F.ceil((n - a) / p).cast("int")))
    planted = F.concat(F.slice("words", F.lit(1), a), F.slice(copies, F.lit(1), n - a))
    return placed.select("doc_id", F.when(n > 0, F.array_join(planted, " ")).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Periodic runs of words in every document, some with planted ones: the longest, and digests of all."""
    found = periodic.find_runs(planted_runs(table(spark, folder, "documents")))
    # The longest run; the first of equal ones, which come by start, then period.
    longest = F.aggregate(
        "runs",
        F.lit(None).cast("struct<start:long,length:long,period:long>"),
        lambda best, run: F.when(best.isNull() | (run["length"] > best["length"]), run).otherwise(best),
    )
    lines = F.transform(
        "runs", lambda run: F.concat_ws(",", *(run[name].cast("string") for name in ("start", "length", "period")))
    )
    listed = F.array_join(F.transform(lines, lambda line: F.concat(line, F.lit("\n"))), "")
    top = found.withColumn("top", longest)
    return top.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("top.start").alias("start"),
        F.col("top.length").alias("length"),
        F.col("top.period").alias("period"),
        F.floor(1000 * F.col("top.length") / F.col("top.period")).alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """Every vector on the first sixteen whitened components."""
    return whitening.whiten(table(spark, folder, "embeddings"), components=16)


def op13_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    """Spans of personal data in every document; the counts and the digest are of the base spans."""
    found = pii.find_personal_data(table(spark, folder, "documents"), threshold=0.9)

    def listed(spans: Column) -> Column:
        texts = F.transform(
            spans, lambda s: F.concat(s["kind"], F.lit(":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))
        )
        return F.array_join(texts, ",")

    base = F.filter("spans", lambda s: s["base"])
    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, pii.KINDS), F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    function.__name__: function
    for function in (
        op1_url_filter,
        op2_quality,
        op3_simhash,
        op4_chat,
        op5_lattice,
        op6_neighbours,
        op7_decontamination,
        op8_toxicity,
        op9_mixing,
        op10_language,
        op11_periodic_runs,
        op12_whitening,
        op13_personal_data,
    )
}
