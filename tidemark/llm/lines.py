"""Line dedup by overlapping three-line windows, in DataFrame functions only.

A window is three consecutive lines of a document that are not blank; its key is two 64-bit hashes of the
lines themselves, without trailing white space. The first occurrence of a window stays: the one with the
smallest document id, then the smallest place. All lines that a later occurrence covers are removed, the
covered places of a document merged into one list, and the rest of the text is left as it is.

Hot windows are counted with partial sums before the shuffle. Only windows that occur twice are joined back,
between two fresh exchanges, so that adaptive execution splits a hot one.

Defined cases: a null text stays null, and texts of fewer than three lines that are not blank stay as they
are; rows with equal id and text are one document and get the same result, so they are not each other's later
occurrence; ids compare as they are, null first; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import column
from tidemark.llm.common import fresh, kept, table

WINDOW = 3

#: DuckDB's form: windows by their lines, without hashes.
ORACLE = """
with docs as (select distinct doc_id, text from documents where text is not null),
split as (select doc_id, text, string_split(text, chr(10)) as all_lines from docs),
lines as (select doc_id, text, unnest(all_lines) as line, generate_subscripts(all_lines, 1) as place from split),
full_lines as (
  select doc_id, text, place, regexp_replace(line, '[ \\t-\\r]+$', '') as line,
    row_number() over (partition by doc_id, text order by place) as nth
  from lines where regexp_matches(line, '[^ \\t-\\r]')
),
windows as (
  select a.doc_id, a.text, a.nth, a.place as p1, b.place as p2, c.place as p3, a.line as l1, b.line as l2, c.line as l3
  from full_lines a
  join full_lines b on b.doc_id is not distinct from a.doc_id and b.text = a.text and b.nth = a.nth + 1
  join full_lines c on c.doc_id is not distinct from a.doc_id and c.text = a.text and c.nth = a.nth + 2
),
ranked as (select *, row_number() over (partition by l1, l2, l3 order by doc_id nulls first, p1) as seen from windows),
covered as (
  select distinct doc_id, text, unnest([p1, p2, p3]) as place from ranked where seen > 1
),
rest as (
  select l.doc_id, l.text, string_agg(l.line, chr(10) order by l.place) filter (where c.place is null) as cleaned,
    count(*) as n_lines, count(c.place) as n_removed
  from lines l left join covered c on c.doc_id is not distinct from l.doc_id and c.text = l.text and c.place = l.place
  group by l.doc_id, l.text
)
select d.doc_id, case when d.text is null then null else coalesce(r.cleaned, '') end as text,
  coalesce(r.n_lines, 0) as n_lines, coalesce(r.n_removed, 0) as n_removed
from documents d left join rest r on r.doc_id is not distinct from d.doc_id and r.text = d.text
"""


def _with_windows(rows: DataFrame) -> DataFrame:
    """One row for each window: its hashes, the document's keys, and the places of its lines."""
    numbered = F.expr(r"transform(split(text, '\n', -1), (line, i) -> struct(i as place, regexp_replace(line, '[ \\t-\\r]+\\z', '') as line))")
    filled = rows.select("doc_id", "key1", "key2", F.filter(numbered, lambda x: x["line"] != "").alias("lines"))
    at = F.expr(
        """transform(sequence(0, size(lines) - 3), i -> struct(
            xxhash64(lines[i].line, lines[i + 1].line, lines[i + 2].line) as hash1,
            xxhash64(lines[i + 2].line, 1, lines[i].line, lines[i + 1].line) as hash2,
            array(lines[i].place, lines[i + 1].place, lines[i + 2].place) as places))"""
    )
    return filled.where(F.size("lines") >= WINDOW).select("doc_id", "key1", "key2", F.explode(at).alias("w")).select(
        "doc_id", "key1", "key2", "w.hash1", "w.hash2", "w.places"
    )


def remove_repeated_windows(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", counts: tuple[str, str] | None = None) -> DataFrame:
    """``docs`` with the lines of repeated windows removed from ``text``; ``counts`` names two more columns:
    the lines that a text had, and those removed."""
    value = column(text).cast("string")
    key1, key2 = F.xxhash64(column(doc_id), value), F.xxhash64(value, F.lit(2), column(doc_id))
    rows = docs.where(column(text).isNotNull()).select(column(doc_id).alias("doc_id"), value.alias("text"), key1.alias("key1"), key2.alias("key2"))
    windows = kept(_with_windows(rows), "line-windows")
    occurrence = F.struct("doc_id", "key1", "key2", F.col("places")[0].alias("place"))
    repeated = windows.groupBy("hash1", "hash2").agg(F.min(occurrence).alias("first"), F.count("*").alias("n")).where("n > 1")
    repeated = kept(repeated.select("hash1", "hash2", "first"), "repeated-windows")
    later = windows.join(repeated, ["hash1", "hash2"]).where(
        "not (key1 = first.key1 and key2 = first.key2 and places[0] = first.place)"
    )
    covered = later.select("key1", "key2", F.explode("places").alias("place"))
    covered = kept(covered.groupBy("key1", "key2").agg(F.collect_set("place").alias("places")), "covered-lines")
    one, two, gone = fresh(docs, "_key1"), fresh(docs, "_key2"), fresh(docs, "_places")
    covered = covered.select(F.col("key1").alias(one), F.col("key2").alias(two), F.col("places").alias(gone))
    # Always a sort-merge join: its shuffle grows with the texts alone, not with what a broadcast happens to hold.
    joined = docs.withColumns({one: key1, two: key2}).join(covered.hint("merge"), [one, two], "left")
    lines = F.split(value, "\n", -1)
    left = F.array_join(F.filter(lines, lambda line, i: ~F.array_contains(column(gone), i)), "\n")
    cleaned = F.when(value.isNotNull() & column(gone).isNotNull(), left).otherwise(value)
    columns = [cleaned.alias(c) if c == text else column(c) for c in docs.columns]
    if counts:
        columns += [F.when(value.isNull(), 0).otherwise(F.size(lines)).cast("bigint").alias(counts[0])]
        columns += [F.coalesce(F.size(column(gone)), F.lit(0)).cast("bigint").alias(counts[1])]
    return joined.select(*columns)


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text without repeated windows, its lines before, and the lines removed."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeated_windows(docs, counts=("n_lines", "n_removed"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: texts without the lines of repeated windows."""
    return remove_repeated_windows(docs)
