"""Personal data: patterns for four kinds, and more of them by bootstrapped context.

The base patterns give seed entities.  The words around an entity are its lexical patterns;
patterns and entities form a bipartite graph.  Spark scores it in rounds: a pattern is
as good as the share of known entities of one kind among all it occurs with, an entity as
likely as the patterns it occurs in make it.  Entities that good patterns agree on become
known in the next round and end as spans the base patterns could not find.

Any token can be such an entity, and a run of neighbouring short digit groups is one.  Every
round first collects the patterns around known entities, then reads the texts again for all
that stands in those patterns, so that tokens elsewhere are never stored.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revloom.llm.shared import SortedTable, join_rows, keep, prepare, sorted_table

# The kinds in their order, and what the base patterns accept.
KINDS = ("email", "ip", "card", "phone")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_MARKS = ".,;:!?()[]{}<>\"'"
_DIGIT = re.compile(r"[0-9]")
_WORD = re.compile(r"\S+")
_SPACE = re.compile(r"\s")
#: A short digit group, without the marks around it; neighbours form one entity.
_GROUP = re.compile(r"\+?[0-9][0-9()./-]{0,7}")
#: After a word that ends in one of these no run of groups goes on.
_STOPS = ".,;:!?"
_CHUNK = 1 << 20
_MEMO_WORDS = 1 << 20

ROUNDS = 3
#: Where the slices of the texts end, in parts of the last.
SLICES = (1, 4, 16, 64)
#: A pattern counts once it has this many distinct known entities of a kind ...
MIN_SEEDS = 3
#: ... and these are at least this share of all its entities (one more counted as unknown).
MIN_CONFIDENCE = 0.6
#: An entity becomes known at this score.
MIN_SCORE = 0.8


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    free, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > free and text[begin - 1] in _LOCAL:
            begin -= 1
        domain = _DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            free = domain.end()
            yield begin, free
        # No local part can reach back over an "@", so a failed one frees nothing.
        at = text.find("@", max(at + 1, free))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by kind, then start; time grows with the text only."""
    found = [("email", begin, end) for begin, end in _emails(text)]
    if not _DIGIT.search(text):
        return found
    found += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(_octet(part) for part in m.groups())]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(map(str.isdigit, m[0])) <= 15:
                found.append(("phone", m.start(), m.end()))
    return found


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or "0") <= 255


class _Words(dict):
    """Hash of each word in lower case without marks; the lowest bits: a digit group (1), ends in a stop (2)."""

    def __missing__(self, word: str) -> int:
        plain = word.lower().strip(_MARKS)
        value = xxhash.xxh3_64_intdigest(plain.encode("utf-8", "surrogatepass")) & ~3 | 4
        value |= (_GROUP.fullmatch(plain) is not None) | 2 * (word[-1:] in _STOPS)
        self[word] = value
        return value


_FLAGS = np.uint64(3)
_NO_WORD = np.uint64(_Words()[""] & ~3)
_BEFORE, _AROUND, _JOINED = 1, 2, 3


def _hashes(texts: list[str | None], memo: _Words) -> tuple[np.ndarray, np.ndarray]:
    """Words of all texts, two zeros before each text and at the end, and the place of each text's first word."""
    if len(memo) > _MEMO_WORDS:
        memo.clear()
    found, firsts = array("Q"), []
    for text in texts:
        found.extend((0, 0))
        firsts.append(len(found))
        at, size = 0, len(text or "")
        while at < size:
            cut = _SPACE.search(text, at + _CHUNK) if at + _CHUNK < size else None
            stop = cut.start() if cut else size
            found.extend(map(memo.__getitem__, text[at:stop].split()))
            at = stop
    found.extend((0, 0))
    return np.frombuffer(found, np.uint64), np.array(firsts, np.int64)


def _mixed(left: np.ndarray, right: np.ndarray, salt: int) -> np.ndarray:
    value = left * np.uint64(0x9E3779B97F4A7C15) + right * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(salt)
    value = (value ^ (value >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return value ^ (value >> np.uint64(32))


def _patterns(words: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two words before an entity (0: not two) and the words on both sides of it, as hashes."""
    words = words & ~_FLAGS
    before = np.where(words[first - 2] == 0, np.uint64(0), _mixed(words[first - 2], words[first - 1], _BEFORE))
    return before, _mixed(words[first - 1], words[last + 1], _AROUND)


def _named(words: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hash of the entity in the words from ``first`` to ``last``."""
    words = words & ~_FLAGS
    out = words[first]
    for number in np.flatnonzero(last > first):
        for at in range(first[number] + 1, last[number] + 1):
            out[number : number + 1] = _mixed(out[number : number + 1], words[at : at + 1], _JOINED)
    return out


def _offsets(text: str) -> tuple[np.ndarray, np.ndarray]:
    spans = array("q")
    for m in _WORD.finditer(text):
        spans.extend(m.span())
    both = np.frombuffer(spans, np.int64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


def _mentions(text: str, spans: list[tuple[str, int, int]], memo: _Words | None = None) -> Iterator[tuple]:
    """(kind, entity, pattern) of the base spans, entity and pattern as hashes."""
    if not spans:
        return
    memo = _Words() if memo is None else memo
    words, firsts = _hashes([text], memo)
    starts, ends = _offsets(text)
    begin, end = (np.array([span[side] for span in spans], np.int64) for side in (1, 2))
    first = np.searchsorted(ends, begin, "right") + firsts[0]
    last = np.searchsorted(starts, end, "left") - 1 + firsts[0]
    before, around = (side.view(np.int64).tolist() for side in _patterns(words, first, last))
    for (kind, a, b), left, both in zip(spans, before, around, strict=True):
        own, _ = _hashes([text[a:b]], memo)
        entity = int(_named(own, np.array([2]), np.array([len(own) - 3])).view(np.int64)[0])
        if left:
            yield kind, entity, left
        yield kind, entity, both


def _runs(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last word of each run of two or more neighbouring digit groups."""
    group = (words & np.uint64(1)) > 0
    linked = group[:-1] & group[1:] & ((words[:-1] & np.uint64(2)) == 0)
    edges = np.diff(np.concatenate([[False], linked, [False]]).astype(np.int8))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def _free(text: str, first: np.ndarray, last: np.ndarray, runs: tuple[np.ndarray, np.ndarray]):
    """Start, end and use of candidates: outside base spans, and no part of a longer run that is."""
    starts, ends = _offsets(text)
    taken = np.zeros(len(starts) + 1, np.int64)
    for _, begin, end in base_spans(text):
        taken[np.searchsorted(ends, begin, "right")] += 1
        taken[np.searchsorted(starts, end, "left")] -= 1
    before = np.concatenate([[0], np.cumsum(np.cumsum(taken) > 0)])
    free = lambda a, b: before[b + 1] == before[a]
    use = free(first, last)
    if len(runs[0]):
        number = np.maximum(np.searchsorted(runs[0], first, "right") - 1, 0)
        inside = (runs[0][number] <= first) & (last <= runs[1][number]) & (first == last)
        use &= ~(inside & free(runs[0], runs[1])[number])
    places = []
    for a, b in zip(starts[first].tolist(), ends[last].tolist(), strict=True):
        while a < b and text[a] in _MARKS:
            a += 1
        while b > a and text[b - 1] in _MARKS:
            b -= 1
        places.append((a, b))
    return places, use


def _within(table: SortedTable, keys: np.ndarray) -> np.ndarray:
    order = np.argsort(keys.view(np.int64))
    hit = np.empty(len(keys), bool)
    hit[order] = table.find(keys.view(np.int64)[order])[0] > 0
    return hit


def _candidates(texts: list[str | None], patterns: SortedTable | None, entities: SortedTable | None, memo: _Words):
    """(text number, start, end, entity, pattern) of tokens and runs in the patterns that are among the entities."""
    words, firsts = _hashes(texts, memo)
    plain = words & ~_FLAGS
    single = np.flatnonzero((plain != 0) & (plain != _NO_WORD))
    runs = _runs(words)
    first, last = np.concatenate([single, runs[0]]), np.concatenate([single, runs[1]])
    sides = _patterns(words, first, last)
    usable = [sides[0] != 0, np.ones(len(first), bool)]
    if patterns is not None:
        usable = [use & _within(patterns, side) for use, side in zip(usable, sides, strict=True)]
    chosen = np.flatnonzero(usable[0] | usable[1])
    names = _named(words, first[chosen], last[chosen])
    if entities is not None:
        known = _within(entities, names)
        chosen, names = chosen[known], names[known]
    owner = np.searchsorted(firsts, first[chosen], "right") - 1
    order = np.argsort(owner, kind="stable")
    chosen, names, owner = chosen[order], names[order].view(np.int64).tolist(), owner[order]
    bounds = np.flatnonzero(np.diff(owner, prepend=-1, append=-1))
    for low, high in zip(bounds[:-1], bounds[1:], strict=True):
        number = int(owner[low])
        part, base = chosen[low:high], firsts[number]
        stop = firsts[number + 1] if number + 1 < len(firsts) else len(words)
        own = slice(*np.searchsorted(runs[0], [base, stop]))
        own_runs = runs[0][own] - base, runs[1][own] - base
        places, use = _free(texts[number], first[part] - base, last[part] - base, own_runs)
        for at in np.flatnonzero(use):
            for side, usable_side in zip(sides, usable, strict=True):
                if usable_side[part[at]]:
                    yield number, *places[at], names[low + at], int(side[part[at]].view(np.int64))


def _standing(docs: DataFrame, patterns: SortedTable | None = None, entities: SortedTable | None = None) -> DataFrame:
    """(doc_id, hash, start, end, entity, pattern) of candidates in ``patterns`` and among ``entities`` (None: any)."""
    kind = dict(docs.dtypes)["doc_id"]
    names = ("start", "end", "entity", "pattern")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _Words()
        for batch in batches:
            found = list(_candidates(batch.column("text").to_pylist(), patterns, entities, memo))
            rows, *columns = zip(*found, strict=True) if found else [()] * 5
            taken = [batch.column(name).take(pa.array(rows, pa.int64())) for name in ("doc_id", "hash")]
            yield pa.RecordBatch.from_arrays(
                [*taken, *(pa.array(column, pa.int64()) for column in columns)], names=["doc_id", "hash", *names]
            )

    rows = docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("hash"))
    return rows.mapInArrow(find, f"doc_id {kind}, hash bigint, " + ", ".join(f"`{name}` bigint" for name in names))


def _entities(docs: DataFrame) -> DataFrame:
    kind = dict(docs.dtypes)["doc_id"]
    span = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())])
    mention = pa.struct([("kind", pa.int32()), ("entity", pa.int64()), ("pattern", pa.int64())])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _Words()
        for batch in batches:
            spans, mentions = [], []
            for text in batch.column("text").to_pylist():
                found = base_spans(text or "")
                spans.append([{"kind": KINDS.index(k), "start": b, "end": e} for k, b, e in found])
                seen = _mentions(text or "", found, memo)
                mentions.append([{"kind": KINDS.index(k), "entity": e, "pattern": p} for k, e, p in seen])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("hash"),
                    pa.array(spans, pa.list_(span)),
                    pa.array(mentions, pa.list_(mention)),
                ],
                names=["doc_id", "hash", "spans", "mentions"],
            )

    rows = docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("hash"))
    return rows.mapInArrow(
        find,
        f"doc_id {kind}, hash bigint, spans array<struct<kind: int, start: bigint, end: bigint>>, "
        "mentions array<struct<kind: int, entity: bigint, pattern: bigint>>",
    )


def _lookup(frame: DataFrame, key: str, name: str) -> SortedTable:
    return sorted_table(frame.select(key).distinct().withColumn("held", F.lit(1)), key, name)


def _edges(docs: DataFrame, hits: DataFrame, around_seeds: DataFrame) -> DataFrame:
    """Distinct (pattern, entity) of all patterns of ``hits`` that reach MIN_CONFIDENCE for a kind.

    The texts are read in growing slices.  More entities only lower a confidence, so a
    pattern that falls below it on some slices is not looked for in the others.
    """
    left = hits.groupBy("pattern").agg(F.max("hits").alias("hits"))
    edges = around_seeds.join(left.select("pattern"), "pattern", "left_semi")
    share = F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(SLICES[-1]))
    for low, high in zip((0, *SLICES), SLICES):
        table = _lookup(left, "pattern", "pii-contexts")
        if not table.paths:
            break
        more = _standing(docs.where((share >= low) & (share < high)), patterns=table).select("pattern", "entity")
        edges = keep(edges.union(more).distinct(), "pii-edges")
        sizes = edges.groupBy("pattern").agg(F.count("*").alias("entities"))
        enough = F.col("hits") / (F.col("entities") + 1) >= MIN_CONFIDENCE
        left = keep(left.join(sizes, "pattern").where(enough).select("pattern", "hits"), "pii-left")
        edges = edges.join(left.select("pattern"), "pattern", "left_semi")
    return edges


def bootstrap(docs: DataFrame, seeds: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """Scored patterns (pattern, kind, confidence) and newly known entities (entity, kind, score).

    ``seeds`` has distinct (pattern, entity, kind) of the base spans.  An entity seen as
    several kinds counts for each; a new one takes its best kind (ties: the first).
    """
    around_seeds = seeds.select("pattern", "entity").distinct()
    kinds = seeds.select("entity", "kind").distinct()
    around, known = around_seeds, kinds.withColumn("score", F.lit(1.0))
    patterns = found = None
    for _ in range(rounds):
        if found is not None:
            # Entities of the round before stand in patterns that no seed has.
            table = _lookup(found, "entity", "pii-known")
            if not table.paths:
                break  # nothing new, so the next round would be this one again
            more = _standing(docs, entities=table).select("pattern", "entity")
            around = keep(around_seeds.union(more).distinct(), "pii-around")
        hits = around.join(known, "entity").groupBy("pattern", "kind").agg(F.sum("score").alias("hits"))
        hits = keep(hits.where(F.col("hits") >= MIN_SEEDS), "pii-hits")
        table = _lookup(hits, "pattern", "pii-contexts")
        edges = keep(_edges(docs, hits, around_seeds), "pii-edges")
        sizes = edges.groupBy("pattern").agg(F.count("*").alias("entities"))
        confidence = F.col("hits") / (F.col("entities") + 1)
        patterns = hits.join(sizes, "pattern").select("pattern", "kind", confidence.alias("confidence"))
        patterns = keep(patterns.where(F.col("confidence") >= MIN_CONFIDENCE), "pii-patterns")
        doubt = F.sum(F.log1p(-F.least(F.col("confidence"), F.lit(0.999))))
        scored = edges.join(patterns, "pattern").groupBy("entity", "kind").agg((1 - F.exp(doubt)).alias("score"))
        fresh = scored.where(F.col("score") >= MIN_SCORE).join(kinds.select("entity").distinct(), "entity", "left_anti")
        best = fresh.groupBy("entity").agg(F.max(F.struct("score", (-F.col("kind")).alias("order"))).alias("best"))
        found = keep(best.select("entity", (-F.col("best.order")).alias("kind"), "best.score"), "pii-found")
        known = kinds.withColumn("score", F.lit(1.0)).union(found.select("entity", "kind", "score"))
    return patterns, found


def find(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, base and spans of every row of ``docs`` (doc_id, text).

    Both are arrays of (kind, start, end), kind numbered as in ``KINDS``, by kind, then start,
    in code points, end exclusive.  ``spans`` holds the base spans and those found by
    context: tokens, or runs of digit groups, that touch no base span.  A null text has none.  Rows equal in doc_id and text get the same spans.  An empty table
    gives an empty result.
    """
    prepare(docs.sparkSession)
    stored = keep(_entities(docs), "pii-entities")
    mentions = stored.select(F.explode("mentions").alias("m")).select("m.pattern", "m.entity", "m.kind")
    patterns, found = bootstrap(docs, keep(mentions.distinct(), "pii-seeds"), rounds)
    tables = _lookup(patterns, "pattern", "pii-contexts"), _lookup(found, "entity", "pii-known")
    added = (
        keep(_standing(docs, *tables) if tables[1].paths else _standing(docs.limit(0)), "pii-added")
        .join(found.select("entity", "kind"), "entity")
        .join(patterns.select("pattern", "kind").distinct(), ["pattern", "kind"], "left_semi")
        .groupBy("doc_id", "hash")
        .agg(F.collect_set(F.struct("kind", "start", "end")).alias("added"))
    )
    joined = join_rows(stored, added, ["doc_id", "hash"], "left")
    return joined.select(
        "doc_id",
        F.col("spans").alias("base"),
        F.sort_array(F.concat("spans", F.coalesce("added", F.array().cast(dict(stored.dtypes)["spans"])))).alias("spans"),
    )
