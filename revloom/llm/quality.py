"""Quality rules with DataFrame functions only: text measures and cross-document line frequency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revloom.llm.shared import join_rows

MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
#: A line found in more distinct texts of a host than this is boilerplate of the host.
MAX_TEXTS = 10
#: A document is depleted if fewer of its words than this remain.
MIN_LEFT_PERCENT = 50

_SPACE = r"[\x20\x09-\x0D]"
_NOT_SPACE = r"[^\x20\x09-\x0D]"
#: Bits for a word's place in a text; the rest of 64 bits holds the window's hash.
_PLACE_BITS = 26
#: SQL of a window's hash; only speed depends on how good it is.
_WINDOW_HASH = "xxhash64({words}[i], {words}[i + 1], {words}[i + 2])"


def _covered(entries: str, equal, place) -> str:
    """SQL: how many words lie in 3-word windows that equal their neighbour in the sorted ``entries``."""
    last = f"size({entries}) - 1"
    repeated = (
        f"filter(sequence(0, {last}), k -> (k > 0 and {equal('greatest(k - 1, 0)', 'k')}) "
        f"or (k < {last} and {equal('k', f'least(k + 1, {last})')}))"
    )
    places = f"sort_array(transform({repeated}, k -> {place('k')}))"
    return (
        f"aggregate({places}, named_struct('next', 0, 'sum', 0L), "
        "(acc, p) -> named_struct('next', p + 3, 'sum', acc.sum + p + 3 - greatest(p, acc.next)), acc -> acc.sum)"
    )


def _repeated_words(words: str) -> tuple[str, str, str]:
    """SQL for the windows ``s`` sorted by hash, ``t`` sorted by their words, and from both the repeated words.

    ``s`` has the place in the low bits, so windows of equal hash become neighbours.  If all
    such neighbours agree word by word, equal hash means equal window, and ``t`` is empty.  If
    two differ (a collision, which may also part two equal windows), or if the text has more
    words than places can tell, ``t`` decides: sorted by the words themselves, equal windows
    are neighbours in any case.
    """
    place = f"{(1 << _PLACE_BITS) - 1}L"
    window = _WINDOW_HASH.format(words=words)
    indexes = f"sequence(0, size({words}) - 3)"
    packed = f"sort_array(transform({indexes}, i -> ({window} & ~{place}) | cast(i as bigint)))"

    def same_hash(left: str, right: str) -> str:
        return f"(s[{left}] & ~{place}) = (s[{right}] & ~{place})"

    def at(k: str) -> str:
        return f"cast(s[{k}] & {place} as int)"

    other = " or ".join(f"{words}[{at('k')} + {d}] <> {words}[{at('k + 1')} + {d}]" for d in range(3))
    clash = (
        f"(size({words}) > {1 << _PLACE_BITS} or "
        f"exists(sequence(0, size(s) - 2), k -> {same_hash('k', 'k + 1')} and ({other})))"
    )
    struct = f"named_struct('a', {words}[i], 'b', {words}[i + 1], 'c', {words}[i + 2], 'p', i)"
    exact = f"transform({indexes}, i -> {struct})"
    by_words = f"case when size(s) > 1 and {clash} then sort_array({exact}) else filter({exact}, x -> false) end"

    def same_words(left: str, right: str) -> str:
        return "(" + " and ".join(f"t[{left}].{f} = t[{right}].{f}" for f in "abc") + ")"

    distinct = f"size(array_distinct(transform(s, x -> shiftright(x, {_PLACE_BITS}))))"
    fast = _covered("s", same_hash, at)
    slow = _covered("t", same_words, lambda k: f"t[{k}].p")
    return packed, by_words, f"case when size(t) > 0 then {slow} when {distinct} = size(s) then 0L else {fast} end"


def measures(docs: DataFrame, *passed: str | Column) -> DataFrame:
    """Columns ``passed`` of every row of ``docs`` (with text), n_words and the base measures.

    A null text has no words, one (empty) line and no symbols.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(*passed, text.alias("body"))
    words = F.array_remove(F.split("body", f"{_SPACE}+"), "")
    lines = F.filter(F.split("body", "\n"), lambda line: line.rlike(_NOT_SPACE))
    rows = rows.select(
        *rows.columns[:-1],
        words.alias("w"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint").alias("n_dup_lines"),
        F.regexp_count("body", F.lit("[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
    )
    packed, by_words, repeated = _repeated_words("w")
    kept = [name for name in rows.columns if name not in ("w", "n_dup_lines", "n_symbols")]
    # Generators between the steps keep the optimizer from computing the arrays once per use.
    rows = rows.select(*kept, "n_symbols", "n_dup_lines", F.explode(F.array("w")).alias("w"))
    short = F.size("w") < 3
    rows = rows.select(
        *kept,
        "n_symbols",
        "n_dup_lines",
        "w",
        F.explode(F.array(F.when(short, F.array().cast("array<bigint>")).otherwise(F.expr(packed)))).alias("s"),
    )
    none = F.array().cast("array<struct<a: string, b: string, c: string, p: int>>")
    rows = rows.withColumn("t", F.explode(F.array(F.when(short, none).otherwise(F.expr(by_words)))))
    return rows.select(
        *kept,
        F.size("w").cast("bigint").alias("n_words"),
        F.char_length(F.array_join("w", "")).cast("bigint").alias("word_chars"),
        "n_symbols",
        "n_dup_lines",
        F.when(F.size("s") < 2, F.lit(0).cast("bigint")).otherwise(F.expr(repeated)).alias("n_repeat_words"),
    )


def frequent_lines(docs: DataFrame, max_texts: int = MAX_TEXTS) -> DataFrame:
    """(doc_id, hash, host, place, words): the lines found in over ``max_texts`` distinct texts of their host.

    ``docs`` has doc_id, hash (of the text), host and text.  Lines are compared in lower
    case, trimmed, with single spaces; copies of one text count once.
    """
    body = F.lower(F.regexp_replace("text", r"[\x20\x09\x0B-\x0D]+", " "))
    lines = docs.select("doc_id", "hash", "host", F.posexplode(F.split(body, "\n")).alias("place", "line"))
    lines = lines.withColumn("line", F.btrim("line")).where("line <> ''")
    lines = lines.select(
        "doc_id", "hash", "host", "place", F.xxhash64("line").alias("line"), F.size(F.split("line", " ")).alias("words")
    )
    texts = lines.groupBy("host", "line", "hash").agg(F.lit(1).alias("one"))
    frequent = texts.groupBy("host", "line").agg(F.count("*").alias("n")).where(F.col("n") > max_texts)
    found = lines.join(frequent.select("host", "line"), ["host", "line"], "left_semi")
    return found.groupBy("doc_id", "hash", "host", "place").agg(F.max("words").alias("words"))


def frequent_line_words(docs: DataFrame, max_texts: int = MAX_TEXTS) -> DataFrame:
    """(doc_id, hash, host, frequent_words): words on :func:`frequent_lines`."""
    return frequent_lines(docs, max_texts).groupBy("doc_id", "hash", "host").agg(F.sum("words").alias("frequent_words"))


def _hosted(docs: DataFrame, *passed: str | Column) -> DataFrame:
    return docs.select(
        *passed,
        "doc_id",
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("hash"),
        F.coalesce(F.col("source").cast("string"), F.lit("\0")).alias("host"),
        F.coalesce("text", F.lit("")).alias("text"),
    )


def remove_frequent_lines(docs: DataFrame, max_texts: int = MAX_TEXTS) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, source) with the frequent lines of their host taken out of ``text``.

    Other lines, blank ones included, stay as they are and in order.  A null text stays null.
    """
    rows = _hosted(docs, F.struct(*docs.columns).alias("row"))
    places = frequent_lines(rows, max_texts).groupBy("doc_id", "hash", "host").agg(F.collect_set("place").alias("places"))
    joined = join_rows(rows, places, ["doc_id", "hash", "host"], "left")
    left = F.filter(F.split("text", "\n"), lambda line, place: ~F.array_contains("places", place))
    text = F.when(F.col("places").isNull(), F.col("row.text")).otherwise(F.array_join(left, "\n"))
    return joined.select(
        *(text.alias(name) if name == "text" else F.col("row").getField(name).alias(name) for name in docs.columns)
    )


def judge(
    docs: DataFrame,
    max_texts: int = MAX_TEXTS,
    min_left_percent: int = MIN_LEFT_PERCENT,
) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, frequent_words, base_failed, kept.

    ``docs`` has doc_id, text and source (the host; null is a host).  ``base_failed``: under
    50 words, or over half of the words in repeated windows.  A document that passes is
    kept unless it is depleted: without its host's frequent lines less than
    ``min_left_percent`` of its words are left; :func:`remove_frequent_lines` gives that
    text.  Repeated rows are judged each.
    """
    rows = _hosted(docs)
    base = measures(rows, "doc_id", "hash", "host")
    removed = frequent_line_words(rows, max_texts)
    joined = join_rows(base, removed, ["doc_id", "hash", "host"], "left")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    gone = F.coalesce("frequent_words", F.lit(0)).cast("bigint")
    return joined.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        gone.alias("frequent_words"),
        failed.alias("base_failed"),
        (~failed & (100 * (F.col("n_words") - gone) >= min_left_percent * F.col("n_words"))).alias("kept"),
    )


JUDGE_SQL = r"""
with rows as (
  select doc_id, coalesce(source, chr(1)) as host, coalesce(text, '') as body,
         row_number() over (order by doc_id) as r
  from documents
),
split as (
  select *, regexp_extract_all(body, '[^\x20\x09-\x0D]+') as w,
         list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l
  from rows
),
windows as (
  select r, i, w[i] || chr(10) || w[i + 1] || chr(10) || w[i + 2] as t
  from (select r, w, unnest(range(1, greatest(len(w) - 1, 1))) as i from split where len(w) > 2)
),
twice as (
  select r, i from (select r, i, count(*) over (partition by r, t) as n from windows) where n > 1
),
covered as (
  select r, count(distinct i + k) as n from twice, (select unnest([0, 1, 2]) as k) group by r
),
lines as (
  select r, host, body, place, line, len(string_split(line, ' ')) as words
  from (
    select r, host, body, generate_subscripts(p, 1) as place, trim(unnest(p), ' ') as line
    from (
      select r, host, body, string_split(lower(regexp_replace(body, '[\x20\x09\x0B-\x0D]+', ' ', 'g')), chr(10)) as p
      from rows
    )
  )
  where line <> ''
),
frequent as (
  select host, line from lines group by host, line having count(distinct body) > 10
),
gone as (
  select r, sum(words) as n from lines semi join frequent using (host, line) group by r
),
measured as (
  select s.doc_id, len(w)::bigint as n_words,
         length(array_to_string(w, ''))::bigint as word_chars,
         length(regexp_replace(body, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
         (len(l) - len(list_distinct(l)))::bigint as n_dup_lines,
         coalesce(c.n, 0)::bigint as n_repeat_words,
         coalesce(g.n, 0)::bigint as frequent_words
  from split s left join covered c using (r) left join gone g using (r)
),
judged as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from measured
)
select *, not base_failed and 100 * (n_words - frequent_words) >= 50 * n_words as kept from judged
"""
