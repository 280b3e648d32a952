"""Preference pairs as text: one prompt, two completions, and what of them to learn.

The prompt is the longest run of turns with which both conversations of a pair begin. It is rendered once; what
follows on either side is a completion, of which the turns of the learning role are to be learned and the
others are masked.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values of the chat template.
OPENING, CLOSING = "<|im_start|>", "<|im_end|>"

SIDE = "array<struct<start:long,end:long>>"
PAIR = f"struct<n_prompt:long,prompt:string,chosen:string,rejected:string,chosen_learn:{SIDE},rejected_learn:{SIDE},status:string>"


def guarded(text: str) -> str:
    """A text in which no template mark is left: ``<|`` becomes ``< |``."""
    return text.replace("<|", "< |")


def rendered(turns: list[tuple[str, str]], learn: str) -> tuple[str, list[dict[str, int]]]:
    """Text of the turns, and the stretches to learn: contents and closing mark of turns of role ``learn``."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{OPENING}{guarded(role)}\n", f"{guarded(text)}{CLOSING}"
        if role == learn:
            spans.append({"start": at + len(head), "end": at + len(head) + len(body)})
        parts.append(f"{head}{body}\n")
        at += len(parts[-1])
    return "".join(parts), spans


def paired(chosen: list[tuple[str, str]], rejected: list[tuple[str, str]], learn: str) -> dict:
    n = 0
    while n < min(len(chosen), len(rejected)) and chosen[n] == rejected[n]:
        n += 1
    prompt, _ = rendered(chosen[:n], learn)
    good, good_spans = rendered(chosen[n:], learn)
    bad, bad_spans = rendered(rejected[n:], learn)
    status = "identical" if not good and not bad else "one_sided" if not good_spans or not bad_spans else "pair"
    return {
        "n_prompt": n,
        "prompt": prompt,
        "chosen": good,
        "rejected": bad,
        "chosen_learn": good_spans,
        "rejected_learn": bad_spans,
        "status": status,
    }


def pair_udf(learn: str) -> Callable[[Column], Column]:
    """Column function from the turns of both sides, structs (turn, role, text, rejected), to the pair."""
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    kinds = [("n_prompt", pa.int64()), *((name, pa.string()) for name in ("prompt", "chosen", "rejected"))]
    kind = pa.struct([*kinds, ("chosen_learn", span), ("rejected_learn", span), ("status", pa.string())])

    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            rows = []
            for turns in part.to_pylist():
                sides: tuple[list, list] = ([], [])
                for turn in turns:
                    sides[turn["rejected"]].append((turn["role"], turn["text"]))
                rows.append(paired(*sides, learn))
            yield pa.array(rows, kind)

    return F.arrow_udf(run, PAIR)


def format_preferences(chosen: DataFrame, rejected: DataFrame, learn: str = "assistant", id_column: str = "conv_id") -> DataFrame:
    """(pair_id, n_prompt, prompt, chosen, rejected, chosen_learn, rejected_learn, status) per pair.

    Both frames have (``id_column``, turn, role, text). Turns are in order of ``turn``, nulls first, then of role
    and text; equal rows are one turn; a null role or text is empty; rows with a null id belong to no pair.
    ``*_learn`` are character offsets in the completion, ends exclusive. ``status`` is ``identical`` where the
    sides do not differ, ``one_sided`` where a completion, perhaps an empty or missing one, has nothing to learn, and
    else ``pair``. Other columns are not read. A pair is a row of the result, so one conversation has to fit a row; nothing
    larger is gathered.
    """

    def side(frame: DataFrame, number: bool) -> DataFrame:
        return frame.where(F.col(id_column).isNotNull()).select(
            F.col(id_column).cast("long").alias("pair_id"),
            F.struct(
                F.col("turn").cast("long").alias("turn"),
                F.coalesce("role", F.lit("")).alias("role"),
                F.coalesce("text", F.lit("")).alias("text"),
                F.lit(number).alias("rejected"),
            ).alias("one"),
        )

    turns = side(chosen, False).unionByName(side(rejected, True))
    pairs = turns.groupBy("pair_id").agg(F.array_sort(F.collect_set("one")).alias("turns"))
    return pairs.select("pair_id", pair_udf(learn)(F.col("turns")).alias("pair")).select("pair_id", "pair.*")


def swapped_replies(turns: DataFrame, role: str = "assistant", id_column: str = "conv_id") -> DataFrame:
    """Rejected conversations for a table that has none: the last turn of ``role`` takes the text of that of
    the neighbour, the conversation whose id differs in the lowest bit, and is dropped where that has none.
    """
    last = turns.where(F.col("role") == role).groupBy(F.col(id_column).alias("conv"))
    last = last.agg(F.max(F.struct("turn", "text")).alias("last"))
    other = last.select(F.col("conv").bitwiseXOR(F.lit(1)).alias("conv"), F.col("last.text").alias("reply"), F.lit(True).alias("has"))
    marks = last.select("conv", F.col("last.turn").alias("last_turn")).join(other, "conv", "left")
    joined = turns.join(marks, turns[id_column] == marks["conv"], "left")
    is_last = F.coalesce((F.col("turn") == F.col("last_turn")) & (F.col("role") == role), F.lit(False))
    return joined.where(~is_last | F.col("has").isNotNull()).select(
        id_column, "turn", "role", F.when(is_last, F.col("reply")).otherwise(F.col("text")).alias("text")
    )
