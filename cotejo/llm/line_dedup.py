"""Line dedup: later copies of three consecutive lines are removed, wherever in the corpus they stand.

Lines are what stands between line feeds; lines without a word (only x20 and x09-x0D) take part in no window and are
never removed. Each run of three consecutive other lines is a window, known by 128 bits of hash. Of equal windows the
first stays (smallest doc_id, then earliest place); every line covered by a later one goes, and the covered places of
overlapping windows are merged. A text that loses nothing is returned unchanged; a null text stays null.

Only hashes and places are shuffled to find windows: the first place of each is an aggregation with a combine in
every map task, and it is joined back so that hot windows can be split. Rows that share a doc_id are documents of their
own, one after the other. A missing doc_id is the smallest id and stays null.
"""

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cotejo.functions.clean import once
from cotejo.llm.batches import SPACES
from cotejo.llm.common import fresh, row_keyed, small_batches
from cotejo.operators.skew import join_unique

LINES = 3
WORDY = r"[^\x20\x09-\x0D]"


def windows(docs: DataFrame, lines: int = LINES) -> DataFrame:
    """(doc_id, place, h1, h2): place counts the lines with words of a document from 0."""
    wordy = F.filter(F.split("text", "\n"), lambda x: x.rlike(WORDY))
    rows = docs.select("doc_id", once(wordy).alias("lines")).where(F.size("lines") >= lines)

    def hashed(place: Column) -> Column:
        own = [F.element_at("lines", place + i + 1) for i in range(lines)]
        return F.struct(place.alias("place"), F.xxhash64(*own).alias("h1"), F.xxhash64(F.lit(lines), *own).alias("h2"))

    places = F.sequence(F.lit(0), F.size("lines") - lines)
    return rows.select("doc_id", F.explode(F.transform(places, hashed)).alias("_w")).select("doc_id", "_w.place", "_w.h1", "_w.h2")


def repeated(docs: DataFrame, lines: int = LINES) -> DataFrame:
    """(_doc, places): the places of later copies in each document that has any; no two documents share a doc_id."""
    found = windows(docs, lines)
    at = F.struct("doc_id", "place")
    first = found.groupBy("h1", "h2").agg(F.min(at).alias("_first"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
    later = join_unique(found, ["h1", "h2"], first, ["h1", "h2"], "inner").where(at > F.col("_first"))
    return later.groupBy(F.col("doc_id").alias("_doc")).agg(F.array_sort(F.collect_set("place")).alias("_places"))


def without(text: str, places: list[int], lines: int) -> tuple[str, int]:
    """The text without the lines its windows cover, and how many those are."""
    gone = {p + i for p in places for i in range(lines)}
    kept, at, removed = [], -1, 0
    for line in text.split("\n"):
        wordy = bool(line.encode().strip(SPACES))
        at += wordy
        if wordy and at in gone:
            removed += 1
        else:
            kept.append(line)
    return "\n".join(kept), removed


def _marked(docs: DataFrame, lines: int) -> DataFrame:
    rows, key = row_keyed(docs)
    doc, places = fresh(rows, "_doc"), fresh(rows, "_places")
    of_rows = repeated(rows.select(F.col(key).alias("doc_id"), "text"), lines)
    return rows.join(of_rows.toDF(doc, places), F.col(key) == F.col(doc), "left").drop(key, doc)


def dedup(docs: DataFrame, lines: int = LINES) -> DataFrame:
    """The documents with all their columns; text has lost its repeated lines, and an ``n_chars`` column counts anew."""
    small_batches(docs.sparkSession)
    place, count = docs.columns.index("text"), len(docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [without(text, own, lines)[0] if own and text is not None else text for text, own in zip(batch.column(place).to_pylist(), batch.column(count).to_pylist())]
            columns = batch.columns[:count]
            columns[place] = pa.array(texts, batch.schema.field(place).type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:count])

    out = _marked(docs, lines).mapInArrow(run, docs.schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def removals(docs: DataFrame, lines: int = LINES) -> DataFrame:
    """doc_id, n_lines (with words), n_removed and kept_sha256 (of the text that stays; null text: of the empty one)."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, text, own in zip(*[column.to_pylist() for column in batch.columns]):
                text = text or ""
                total = sum(bool(line.strip(SPACES)) for line in text.encode().split(b"\n"))
                kept, removed = without(text, own, lines) if own else (text, 0)
                out.append((doc, total, removed, hashlib.sha256(kept.encode()).hexdigest()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.string()))], names=["doc_id", "n_lines", "n_removed", "kept_sha256"])

    rows = _marked(docs.select(F.col("doc_id").cast("bigint"), "text"), lines)
    return rows.mapInArrow(run, "doc_id bigint, n_lines bigint, n_removed bigint, kept_sha256 string")


SQL = """
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS line_no
    FROM documents),
wordy AS (
    SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) - 1 AS place
    FROM lines WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
windows AS (
    SELECT doc_id, place, line AS l1, lead(line, 1) OVER w AS l2, lead(line, 2) OVER w AS l3
    FROM wordy WINDOW w AS (PARTITION BY doc_id ORDER BY place)),
numbered AS (
    SELECT doc_id, place, row_number() OVER (PARTITION BY l1, l2, l3 ORDER BY doc_id, place) AS copy
    FROM windows WHERE l3 IS NOT NULL),
gone AS (
    SELECT DISTINCT doc_id, unnest([place, place + 1, place + 2]) AS place FROM numbered WHERE copy > 1),
marked AS (
    SELECT l.doc_id, l.line_no, l.line, w.place IS NOT NULL AS wordy, g.place IS NOT NULL AS removed
    FROM lines l LEFT JOIN wordy w ON l.doc_id = w.doc_id AND l.line_no = w.line_no
    LEFT JOIN gone g ON w.doc_id = g.doc_id AND w.place = g.place)
SELECT doc_id, CAST(count(*) FILTER (wordy) AS BIGINT) AS n_lines, CAST(count(*) FILTER (removed) AS BIGINT) AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (NOT removed), '')) AS kept_sha256
FROM marked GROUP BY doc_id"""
