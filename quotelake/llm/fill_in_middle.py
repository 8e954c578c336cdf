"""Fill-in-middle transformation of whole texts.

A text is a sequence of units, code points unless told otherwise. One match of ``(unit)*``
by the regex library keeps every repetition of its group, so the ends of all units come
from ``match.ends(1)``: their number, and the offsets of both cuts. No unit is looked at
one by one. A text of over ``PIECE`` characters is matched in pieces of that length, which
bounds what a match holds; the last unit of a piece starts the next one, so that no unit
is cut by a piece's end (units are to be told by their own characters).

Where a text is cut, and in which form it is put out, comes from the hash of a seed and the
row's id alone: rows are independent, so there is no shuffle and a task that runs again
gives the same rows.

Forms, with the marks of ``MARKS``:

    plain   the text: it is empty, contains a mark, or was not drawn
    psm     <P>prefix<S>suffix<M>middle
    spm     <S>suffix<P>prefix<M>middle

Defined results: a null text is an empty one; a null id hashes as an empty one; rows with
equal id and text get the same result; columns of the input stay, those that have the
name of a new one are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelake.llm.store import freeing, prepared

MARKS = ("<P>", "<S>", "<M>")
CODE_POINT = r"(?s:.)"
PIECE = 1 << 20
PLAIN, PSM, SPM = "plain", "psm", "spm"
MADE = {"n": "long", "form": "string", "prefix_chars": "long", "middle_chars": "long", "output": "string"}


@dataclass(frozen=True)
class Plan:
    """What is drawn: percent of texts that are transformed, and of those in the form spm."""

    seed: str = "1"
    transformed: int = 90
    spm: int = 20
    unit: str = CODE_POINT
    marks: tuple[str, str, str] = MARKS


def unit_ends(pattern, text: str, piece: int = PIECE) -> np.ndarray:
    """Where each unit of the text ends; ``pattern`` is the compiled ``(unit)*``."""
    parts, at = [], 0
    while len(text) - at > piece:
        wide = piece
        while True:
            found = pattern.match(text, at, at + wide)
            ends = np.array(found.ends(1), np.int64)
            if len(ends) > 1 or at + wide >= len(text):
                break
            wide *= 2                       # a unit of more than a piece
        if len(ends) < 2:
            break
        parts.append(ends[:-1])
        at = int(ends[-2])
    found = pattern.fullmatch(text, at)
    if found is None:
        raise ValueError("the units do not cover a text")
    parts.append(np.array(found.ends(1), np.int64))
    return np.concatenate(parts)


def transform(pattern, text: str, draws: tuple[int, int, int, int], plan: Plan) -> tuple:
    """n, form, prefix_chars, middle_chars and output of one text; lengths in units."""
    ends = unit_ends(pattern, text)
    n = len(ends)
    prefix, suffix, middle = plan.marks
    if not n or draws[2] % 100 >= plan.transformed or any(mark in text for mark in plan.marks):
        return n, PLAIN, None, None, text
    low, high = sorted((draws[0] % (n + 1), draws[1] % (n + 1)))
    a, b = (int(ends[k - 1]) if k else 0 for k in (low, high))
    if draws[3] % 100 < plan.spm:
        return n, SPM, low, high - low, f"{suffix}{text[b:]}{prefix}{text[:a]}{middle}{text[a:b]}"
    return n, PSM, low, high - low, f"{prefix}{text[:a]}{suffix}{text[b:]}{middle}{text[a:b]}"


def _batches(plan: Plan, names: list[str]):
    def transformed(batches):
        import regex

        pattern = regex.compile(f"({plan.unit})*")
        for batch in batches:
            draws = zip(*(batch.column(i).to_pylist() for i in range(1, 5)))
            rows = [transform(pattern, text or "", own, plan)
                    for text, own in zip(batch.column(0).to_pylist(), draws)]
            made = [pa.array(values, pa.string() if kind == "string" else pa.int64())
                    for values, kind in zip(zip(*rows) if rows else [()] * len(MADE), MADE.values())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=names)

    return transformed


def draws(id_col: str, seed: str) -> list[Column]:
    """The first four 8-digit groups of the hex sha256 of ``seed:id``, as numbers."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def with_fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        plan: Plan = Plan()) -> DataFrame:
    """``docs`` with n, form, prefix_chars, middle_chars and output of each text."""
    prepared(docs.sparkSession)
    kept = [c for c in docs.columns if c not in MADE]
    inner = docs.select(
        F.col(f"`{text_col}`").alias("x"), *[d.alias(f"h{k}") for k, d in enumerate(draws(id_col, plan.seed))],
        *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)])
    schema = inner.select("*", *[
        F.lit(None).cast(kind).alias(f"y{i}") for i, kind in enumerate(MADE.values())]).schema
    out = inner.mapInArrow(freeing(_batches(plan, schema.names)), schema)
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(kept)],
                      *[F.col(f"y{i}").alias(c) for i, c in enumerate(MADE)])


def restored(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text that an output was made from. A transformed text holds no mark, so each mark
    of its output stands once."""
    prefix, suffix, middle = marks

    def between(first: str, last: str) -> Column:
        return F.substring_index(F.substring_index(output, first, -1), last, 1)

    last = F.substring_index(output, middle, -1)
    return (F.when(form == PSM, F.concat(between(prefix, suffix), last, between(suffix, middle)))
            .when(form == SPM, F.concat(between(prefix, middle), last, between(suffix, prefix)))
            .otherwise(output))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its form, lengths, and the digests of output and rebuilt text."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    made = with_fill_in_middle(docs)
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))
