"""Language-model scoring: a byte-context tree by prediction by partial matching.

Gram counts over all training texts are summed by Spark; contexts and exclusion sums follow
from them by joins.  The tables are stored sorted, in files of bounded size, and scoring
tasks look their distinct grams up file by file, so neither the driver nor a task ever
needs the whole model.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revloom.llm.blocks import blocks
from revloom.llm.ppm import Counter, counted, grams, log_probabilities, per_text
from revloom.llm.shared import SortedTable, keep, prepare, sorted_table, texts

ORDER = 5
#: Bytes of text counted or scored at once: the more, the fewer look-ups of a gram.
BLOCK = 1 << 20


@dataclass
class Model:
    """Sorted tables of the tree, and of the word counts that serve as base line."""

    order: int
    grams: SortedTable
    contexts: SortedTable
    words: SortedTable
    tokens: int
    distinct: int
    texts: int

    def log_probabilities(self, codes: np.ndarray) -> np.ndarray:
        return log_probabilities(
            codes,
            self.order,
            lambda k, keys: self.grams.find(keys | k << 56)[0],
            lambda k, keys: self.contexts.find(keys | k << 56),
        )


def train(docs: DataFrame, order: int = ORDER) -> Model:
    """Count grams and words of every text of ``docs`` (doc_id, text), A-Z in lower case.

    Null and empty texts count as texts of no word: they train the end symbol.  An empty
    table gives a model that spreads its probability evenly.
    """
    prepare(docs.sparkSession)
    if order > 5:
        raise ValueError("grams of more than six bytes do not fit beside a text's number in 64 bits")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_gram, by_word, ends = Counter(), Counter(), 0

        def out(kind: int, sums: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(sums[0]), kind)), pa.array(sums[0].view(np.int64)), pa.array(sums[1])],
                names=["kind", "code", "n"],
            )

        for batch in batches:
            for block in blocks(batch, limit=BLOCK):
                block = block.lowered()
                ends += len(block)
                for sums in by_gram.add(*counted(grams(block, order)[0])):
                    yield out(0, sums)
                for sums in by_word.add(*counted(block.word_hashes()[0])):
                    yield out(1, sums)
        for sums in by_gram.rest():
            yield out(0, sums)
        for sums in by_word.rest():
            yield out(1, sums)
        yield out(2, (np.zeros(1, np.int64), np.array([ends])))

    found = texts(docs).select("text").mapInArrow(count, "kind bigint, code bigint, n bigint")
    sums = keep(found.groupBy("kind", "code").agg(F.sum("n").alias("n")), "lm-counts")
    shape = {row["kind"]: row for row in sums.groupBy("kind").agg(F.sum("n").alias("n"), F.count("*").alias("d")).collect()}
    ends = shape[2]["n"] if 2 in shape else 0

    # All orders from the longest grams: each gram also counts for its endings.
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(order).cast("bigint")))
    longest = sums.where("kind = 0").select("code", "n", every.alias("k"))
    longest = longest.withColumn("code", F.expr("code & (shiftleft(1L, 8 * cast(k + 1 as int)) - 1)"))
    all_grams = keep(longest.groupBy("k", "code").agg(F.sum("n").alias("n")), "lm-grams")
    shorter = all_grams.select((F.col("k") + 1).alias("k"), F.col("code").alias("ending"), F.col("n").alias("shorter"))
    ending = F.expr("if(k = 0, -1L, code & (shiftleft(1L, 8 * cast(k as int)) - 1))")
    joined = all_grams.withColumn("ending", ending).join(shorter, ["k", "ending"], "left")
    contexts = joined.groupBy("k", F.expr("shiftright(code, 8)").alias("context")).agg(
        F.sum("n").alias("total"), F.count("*").alias("distinct"), F.sum(F.coalesce("shorter", F.lit(0))).alias("mass")
    )
    keyed = lambda column: F.expr(f"shiftleft(k, 56) | {column}").alias("key")
    return Model(
        order,
        sorted_table(all_grams.select(keyed("code"), "n"), "key", "lm-gram-files"),
        sorted_table(contexts.select(keyed("context"), "total", "distinct", "mass"), "key", "lm-context-files"),
        sorted_table(sums.where("kind = 1").select("code", "n"), "code", "lm-words"),
        (shape[1]["n"] if 1 in shape else 0) + ends,
        (shape[1]["d"] if 1 in shape else 0) + (ends > 0),
        ends,
    )


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` (doc_id, text) with n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.

    ``score`` is log10 of the model's probability of the whole text (A-Z in lower case) and
    its end.  ``base_score`` is that of a smoothed word count model.  A null or empty text
    has the end alone.  Repeated rows are scored each.
    """
    prepare(docs.sparkSession)
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = np.log10(model.tokens + 0.1 * (model.distinct + 1))
        end = np.log10(model.texts + 0.1) - whole
        for batch in batches:
            columns: list[list[np.ndarray]] = [[], [], [], [], []]
            for block in blocks(batch, limit=BLOCK):
                block = block.lowered()
                codes, place, owner = per_text(*grams(block, model.order))
                bits = np.bincount(owner, model.log_probabilities(codes)[place], len(block))
                hashes, firsts = block.word_hashes()
                distinct, place = np.unique(hashes.view(np.int64), return_inverse=True)
                known = model.words.find(distinct)[0][place]
                owner = np.repeat(np.arange(len(block)), np.diff(firsts))
                base = np.bincount(owner, np.log10(known + 0.1) - whole, len(block)) + end
                columns[0].append(np.diff(firsts) + 1)
                columns[1].append(np.bincount(owner, known > 0, len(block)).astype(np.int64) + (model.texts > 0))
                columns[2].append(base)
                columns[3].append(bits)
                columns[4].append(-bits * np.log2(10) / (np.diff(block.bounds) + 1))
            n_tokens, n_known, base, bits, rate = (np.concatenate(column) if column else np.zeros(0) for column in columns)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(n_tokens.astype(np.int64)),
                    pa.array(n_known.astype(np.int64)),
                    pa.array(np.full(batch.num_rows, model.tokens, np.int64)),
                    pa.array(base),
                    pa.array(bits),
                    pa.array(rate),
                ],
                names=["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"],
            )

    return texts(docs).mapInArrow(
        run,
        f"doc_id {kind}, n_tokens bigint, n_known bigint, train_tokens bigint, "
        "base_score double, score double, bits_per_byte double",
    )
