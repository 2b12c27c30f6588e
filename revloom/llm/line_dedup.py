"""Removal of repeated runs of lines by winnowing over line hashes.

Lines are compared trimmed, in lower case and with single spaces; blank lines are no part
of a run.  A window is a least run of lines with ``min_words`` words: the one that starts at a
line, or the one that ends at it.  Every window selects its line with the least hash (the
first of several).  Windows with equal content select the same line of it, so selected
places (document and line) are joined on the hash of their line, and windows whose line is
selected in one place only are dropped: the guarantee of winnowing.

Around a joined place a match reaches to the left and to the right over its windows: those
that start further and further up, and those that end further and further down.  Two places
match over a window when its content is equal (a hash of all its lines, so the pairs of a
common line are never listed); the first place of a content by doc_id and line is kept, the
window goes in the others.  A repeated run of ``min_words`` words or more goes whole: each of
its lines starts a window within the run or, near the end, lies in the window that ends it.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revloom.llm.shared import handing_back, join_rows, keep, prepare

MIN_WORDS = 40
#: Windows handed over at once.
ROWS = 1 << 16


def _lines(text: str) -> Iterator[str]:
    begin = 0
    while (end := text.find("\n", begin)) >= 0:
        yield text[begin:end]
        begin = end + 1
    yield text[begin:]


def _content(text: str) -> tuple[array, array, array]:
    """Number, hash and word count of each line that is not blank."""
    numbers, hashes, sizes = array("q"), array("Q"), array("q")
    for number, line in enumerate(_lines(text)):
        words = line.lower().split()
        if words:
            numbers.append(number)
            hashes.append(xxhash.xxh3_64_intdigest(" ".join(words).encode()))
            sizes.append(len(words))
    return numbers, hashes, sizes


def windows(text: str, min_words: int) -> Iterator[tuple[int, int, int, int, int]]:
    """(fingerprint, content hash, first line, last line, selected line) of every window of a text, each once."""
    numbers, hashes, sizes = _content(text)
    raw = memoryview(hashes.tobytes())

    def window(start: int, stop: int) -> tuple[int, int, int, int, int]:
        part = hashes[start:stop]
        least = min(part)
        content = xxhash.xxh3_64_intdigest(raw[8 * start : 8 * stop])
        return least, content, numbers[start], numbers[stop - 1], numbers[start + part.index(least)]

    # The window that ends at a line starts at ``start``; ``held`` words lie in it.
    start, held, before = 0, 0, -1
    for end, size in enumerate(sizes):
        held += size
        if held < min_words:
            continue
        while held - sizes[start] >= min_words:
            held -= sizes[start]
            start += 1
        # Lines passed since the line before start windows that end here.
        for first in range(before + 1, start + 1):
            yield window(first, end + 1)
        if start == before:
            yield window(start, end + 1)
        before = start


def selected_places(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, text_hash, line, fingerprint, content, first_line, last_line): each window at the place of its selected line."""
    kind = dict(docs.dtypes)["doc_id"]
    names = ("fingerprint", "content", "first_line", "last_line", "line")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, found = array("q"), array("Q")

            def made() -> pa.RecordBatch:
                taken = [batch.column(name).take(pa.array(np.array(rows, np.int64))) for name in ("doc_id", "text_hash")]
                columns = np.array(found, np.uint64).reshape(-1, len(names)).T.copy().view(np.int64)
                return pa.RecordBatch.from_arrays([*taken, *map(pa.array, columns)], names=["doc_id", "text_hash", *names])

            for row, text in enumerate(batch.column("text")):
                for window in windows(text.as_py() or "", min_words):
                    rows.append(row)
                    found.extend(window)
                    if len(rows) >= ROWS:
                        yield made()
                        rows, found = array("q"), array("Q")
            yield made()

    rows = docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"))
    return rows.mapInArrow(
        handing_back(cut), f"doc_id {kind}, text_hash bigint, " + ", ".join(f"{name} bigint" for name in names)
    )


def joined_places(places: DataFrame) -> DataFrame:
    """The rows of ``places`` whose line was selected in another place too."""
    place = F.xxhash64("doc_id", "text_hash", "line")
    ends = places.groupBy("fingerprint").agg(F.min(place).alias("one"), F.max(place).alias("other"))
    # Stored, so that the join is one of two shuffles, of which the engine can split a common line's.
    joined = keep(ends.where("one <> other").select("fingerprint"), "line-fingerprints")
    return places.join(joined, "fingerprint", "left_semi")


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, text_hash, first_line, last_line) of windows that occurred earlier."""
    places = keep(selected_places(docs, min_words), "line-places")
    candidates = joined_places(places).select("doc_id", "text_hash", "content", "first_line", "last_line")
    place = F.struct("doc_id", "text_hash", "first_line")
    first = candidates.groupBy("content").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
    first = keep(first.select("content", "first"), "line-runs")
    later = candidates.join(first, "content").where(place > F.col("first"))
    return later.select("doc_id", "text_hash", "first_line", "last_line")


def _without(text: str | None, spans: list | None) -> tuple[str | None, int, int, int]:
    """Kept text, lines, removed lines and runs of them."""
    if text is None:
        return None, 0, 0, 0
    total = text.count("\n") + 1
    if not spans:
        return text, total, 0, 0
    numbers = np.array(_content(text)[0], np.int64)
    change = np.zeros(len(numbers) + 1, np.int64)
    edges = np.array([(span["first_line"], span["last_line"] + 1) for span in spans], np.int64)
    np.add.at(change, np.searchsorted(numbers, edges[:, 0]), 1)
    np.add.at(change, np.searchsorted(numbers, edges[:, 1]), -1)
    gone = np.cumsum(change[:-1]) > 0
    runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    left = np.ones(total, bool)
    left[numbers[gone]] = False
    kept = "\n".join(line for line, stays in zip(_lines(text), left.tolist(), strict=True) if stays)
    return kept, total, int(gone.sum()), runs


def remove_repeats(docs: DataFrame, min_words: int = MIN_WORDS, passed: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``passed`` columns of every row of ``docs`` (doc_id, text), kept_text, n_lines, n_removed, n_runs.

    A line goes when it lies in a run of lines with ``min_words`` words or more that stood
    earlier: in a document with a smaller doc_id (null first; then smaller hash of the
    text), or further up in the same one.  Runs are judged on the input.  ``n_runs`` counts
    the runs of removed lines, blank lines between two of them included in neither.  Blank
    lines stay.  A null text gives null, 0, 0, 0; an empty one has one (blank) line.
    Rows equal in doc_id and text are one place: they are all treated as the first of them.
    """
    prepare(docs.sparkSession)
    spans = repeated_runs(docs, min_words)
    # At most two windows per line of the document.
    by_text = spans.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("first_line", "last_line")).alias("spans"))
    rows = docs.select(
        F.struct(*passed).alias("row"), "doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash")
    )
    joined = join_rows(rows, by_text, ["doc_id", "text_hash"], "left").select("row", "text", "spans")
    kinds = dict(rows.dtypes)

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = zip(batch.column("text"), batch.column("spans"), strict=True)
            out = [_without(text.as_py(), spans.as_py()) for text, spans in both]
            columns = list(zip(*out, strict=True)) if out else [[], [], [], []]
            types = [pa.string(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), *(pa.array(column, kind) for column, kind in zip(columns, types, strict=True))],
                names=["row", "kept_text", "n_lines", "n_removed", "n_runs"],
            )

    done = joined.mapInArrow(
        handing_back(remove), f"row {kinds['row']}, kept_text string, n_lines bigint, n_removed bigint, n_runs bigint"
    )
    return done.select("row.*", "kept_text", "n_lines", "n_removed", "n_runs")


#: What the query returns, in SQL (for tables whose doc_id is unique).
REMOVED_SQL = r"""
with lines as (
  select doc_id, generate_subscripts(l, 1) as line, unnest(l) as raw,
         array_to_string(regexp_extract_all(lower(unnest(l)), '\S+'), ' ') as plain
  from (select doc_id, string_split(text, chr(10)) as l from documents where text is not null)
),
content as (
  select *, row_number() over (partition by doc_id order by line) as place,
         sum(len(string_split(plain, ' '))) over (partition by doc_id order by line) as words
  from lines where plain <> ''
),
stops as (
  select a.doc_id, a.place, a.line, min(b.place) as stop
  from content a join content b on a.doc_id = b.doc_id and b.place >= a.place
   and b.words - a.words + len(string_split(a.plain, ' ')) >= 40
  group by a.doc_id, a.place, a.line
),
begins as (
  select b.doc_id, max(a.place) as place, b.place as stop
  from content a join content b on a.doc_id = b.doc_id and b.place >= a.place
   and b.words - a.words + len(string_split(a.plain, ' ')) >= 40
  group by b.doc_id, b.place
),
spans as (
  select doc_id, place, stop from stops union select doc_id, place, stop from begins
),
windows as (
  select s.doc_id, s.place, min(c.line) as line, s.stop, string_agg(c.plain, chr(10) order by c.place) as text
  from spans s join content c on c.doc_id = s.doc_id and c.place between s.place and s.stop
  group by s.doc_id, s.place, s.stop
),
later as (
  select *, row_number() over (partition by text order by doc_id, line) as occurrence from windows
),
gone as (
  select distinct c.doc_id, c.line, c.place from later l join content c on c.doc_id = l.doc_id and c.place between l.place and l.stop
  where occurrence > 1
),
runs as (
  select g.doc_id, count(*) as n_removed, count(*) filter (p.place is null) as n_runs
  from gone g left join gone p on p.doc_id = g.doc_id and p.place = g.place - 1 group by g.doc_id
),
kept as (
  select l.doc_id, count(*) as n_lines, string_agg(raw, chr(10) order by l.line) filter (g.line is null) as text
  from lines l left join gone g on g.doc_id = l.doc_id and g.line = l.line group by l.doc_id
)
select d.doc_id, coalesce(k.n_lines, 0)::bigint as n_lines, coalesce(n_removed, 0)::bigint as n_removed,
       coalesce(n_runs, 0)::bigint as n_runs, sha256(coalesce(k.text, '')) as kept_sha256
from documents d left join kept k on k.doc_id = d.doc_id left join runs r on r.doc_id = d.doc_id
"""
