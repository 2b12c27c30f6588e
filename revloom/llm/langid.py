"""Language identification by code length.

Each language has a byte context tree; a text's language is the one whose tree codes it
in the fewest bits (prediction by partial matching, statistics frozen after training).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revloom.llm.blocks import blocks
from revloom.llm.ppm import Counter, Tree, counted, grams, per_text
from revloom.llm.shared import handing_back, prepare

ORDER = 4
#: Bytes of text scored at once: the more, the fewer look-ups of a gram.
BLOCK = 1 << 21
#: Training bytes of all languages together, in expectation.
SAMPLE_BYTES = 16 << 20
#: Characters of a segment, the unit of the sample.
SEGMENT = 1 << 14


def train(labelled: DataFrame, order: int = ORDER, sample_bytes: int = SAMPLE_BYTES) -> dict[str, Tree]:
    """A tree per language from a bounded sample of ``labelled`` (doc_id, text, lang).

    Every language gets an equal part of ``sample_bytes``; if it has more text than that,
    segments of ``SEGMENT`` characters are drawn by a hash of their row and place at the rate
    that fits, and the segment with the least draw whatever the rate.  Every language
    with text therefore has a tree, and the trees have at most as many grams as the sample has
    bytes, whatever the corpus and however long its texts.
    Rows without a language or text are left out.
    """
    prepare(labelled.sparkSession)
    rows = labelled.select("doc_id", "lang", "text").where("lang is not null and length(text) > 0")
    # One number per segment; the texts themselves are cut only where one is drawn.
    draw = lambda n: F.pmod(F.xxhash64("row", n), F.lit(1 << 30)) / F.lit(float(1 << 30))
    rows = rows.withColumn("row", F.xxhash64("doc_id", "text"))
    rows = rows.withColumn("segments", F.expr(f"sequence(0, cast((length(text) - 1) div {SEGMENT} as int))"))
    least = F.array_min(F.transform("segments", draw))
    sizes = rows.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("bytes"), F.min(least).alias("least"))
    languages = sizes.select(F.count("*").alias("n")).first()["n"]
    part = sample_bytes // max(1, languages)
    rates = sizes.select("lang", F.greatest(F.lit(float(part)) / F.col("bytes"), "least").alias("rate"))
    drawn = rows.join(F.broadcast(rates) if languages <= 10_000 else rates, "lang")
    chosen = F.filter("segments", lambda n: draw(n) <= F.col("rate"))
    cut = F.transform(chosen, lambda n: F.substring("text", n * SEGMENT + 1, F.lit(SEGMENT)))
    drawn = drawn.select("lang", F.explode(cut).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters: dict[str, Counter] = {}
        out = lambda name, sums: pa.RecordBatch.from_arrays(
            [pa.array([name] * len(sums[0])), pa.array(sums[0].astype(np.int64)), pa.array(sums[1])],
            names=["lang", "code", "n"],
        )
        for batch in batches:
            names = batch.column("lang").to_numpy(zero_copy_only=False)
            for name in sorted(set(names)):
                own = batch.filter(pa.array(names == name))
                counter = counters.setdefault(name, Counter())
                for block in blocks(own):
                    for sums in counter.add(*counted(grams(block, order)[0])):
                        yield out(name, sums)
        for name, counter in counters.items():
            for sums in counter.rest():
                yield out(name, sums)

    sums = drawn.mapInArrow(handing_back(count), "lang string, code bigint, n bigint")
    table = sums.groupBy("lang", "code").agg(F.sum("n").alias("n")).toArrow()  # bounded by the sample
    names = table.column("lang").to_numpy()
    codes, counts = table.column("code").to_numpy(), table.column("n").to_numpy()
    return {name: Tree(codes[names == name], counts[names == name], order) for name in sorted(set(names))}


def identify(
    docs: DataFrame, trees: dict[str, Tree], order: int = ORDER, passed: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """Columns ``passed`` of every row of ``docs`` (with text), lang_pred, score, bits_per_byte.

    ``score`` is the probability of the language given the text under equal priors, with
    code lengths scaled to the evidence of independent grams (each byte is shared by
    ``order + 1`` of them).  Ties go to the smallest name.  A null text, one without a
    letter, or an empty set of trees gives ``und`` and 0.  Repeated rows are scored each.
    """
    spark = docs.sparkSession
    prepare(spark)
    names = sorted(trees)
    shared = spark.sparkContext.broadcast(trees)
    rows = docs.select(F.struct(*passed).alias("row"), "text")
    kind = dict(rows.dtypes)["row"]

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = [shared.value[name] for name in names]
        for batch in batches:
            has_letter = np.array([text is not None and _has_letter(text) for text in batch.column("text").to_pylist()], bool)
            picks, scores, rates = [], [], []
            for block in blocks(batch, limit=BLOCK):
                if not models:
                    picks += ["und"] * len(block)
                    scores += [0.0] * len(block)
                    rates += [0.0] * len(block)
                    continue
                codes, place, owner = per_text(*grams(block, order))
                sums = np.empty((len(models), len(block)))
                for number, model in enumerate(models):
                    sums[number] = np.bincount(owner, model.score(codes)[place], len(block))
                best = sums.argmax(axis=0)
                odds = np.exp((sums - sums.max(axis=0)) * np.log(10) / (order + 1))
                ok = has_letter[block.first : block.first + len(block)]
                picks += [names[b] if fine else "und" for b, fine in zip(best, ok, strict=True)]
                scores += np.where(ok, 1 / odds.sum(axis=0), 0.0).tolist()
                rates += (-sums.max(axis=0) * np.log2(10) / (np.diff(block.bounds) + 1)).tolist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(picks, pa.string()), pa.array(scores), pa.array(rates)],
                names=["row", "lang_pred", "score", "bits_per_byte"],
            )

    found = rows.mapInArrow(handing_back(predict), f"row {kind}, lang_pred string, score double, bits_per_byte double")
    return found.select("row.*", "lang_pred", "score", "bits_per_byte")


def _has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))
