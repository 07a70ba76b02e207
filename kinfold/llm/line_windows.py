"""Line deduplication by overlapping three-line windows.

Lines are what line feeds, and the ends of sentences within them, separate. Every run of
``width`` consecutive lines of a document is hashed (128 bits). A window that occurs more
than once in the corpus is kept where it occurs first - in order of document id, text hash
and line number - and each later occurrence marks its lines as covered. Covered positions
of overlapping windows are merged to stretches, and stretches of ``min_words`` words, or of
``width`` whole physical lines, are removed. So a passage that starts and ends within
physical lines is found too, and short phrases that recur in clean documents stay.

Scale: only hashes and positions are shuffled. Counts are reduced to one row a window before
the shuffle, so a passage that a third of all documents share costs one row a task; only
windows that occur more than once are written with their places, and joined with their first
place by an ordinary sort-merge join, which adaptive execution splits where one window is
hot. The hashes of repeated windows, and what is to be removed, are broadcast where they are
counted to be small (``BROADCAST_KEYS``, ``BROADCAST_BYTES``); beyond that they are
sort-merge joined with all windows, or all texts, which move once for it. Either way the
rows are the same. Within a document everything is linear in its lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.llm.tables import free, table
from kinfold.session import materialize, release

WIDTH = 3
#: Words from which a covered stretch is removed even if it holds no ``width`` whole lines.
MIN_WORDS = 30
WORD = r"[^\x20\x09-\x0D]+"
#: Behind what a line ends: a line feed, or a sentence's last mark and the blank after it.
LINE_ENDS = (". ", "! ", "? ", "\n")
#: A character for private use; where a text holds it, it separates lines as well, and goes with a cut.
MARK = "\ue000"
#: Most bytes (estimated) of removals that are broadcast.
BROADCAST_BYTES = 64 << 20
#: Most window hashes (8 bytes each) that are broadcast.
BROADCAST_KEYS = 2_000_000


def lines_of(text: Column) -> Column:
    """The lines of a text with what ends them: joined, they are the text again."""
    return F.split(_marked(text), MARK)


def _marked(text: Column) -> Column:
    for end in LINE_ENDS:
        text = F.replace(text, F.lit(end), F.lit(end + MARK))
    return text


def count_lines(text: Column) -> Column:
    """How many ``lines_of`` there are, without making them."""
    marked = _marked(text)
    marks = F.octet_length(marked) - F.octet_length(F.replace(marked, F.lit(MARK), F.lit("")))
    return (marks / len(MARK.encode()) + 1).cast("int")


def _key(id_col: str, text_col: str) -> list[Column]:
    """A document's key: rows equal in id and text are one document. Null ids have a second hash."""
    return [F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_t1"), F.when(F.col(id_col).isNull(), F.xxhash64(F.lit(7), text_col)).otherwise(0).alias("_t2")]


def _windows(hashes: Column, width: int, *parts: str) -> Column:
    """An array with a struct for each window, of hashes of its lines' hashes."""
    of = lambda i, h: F.xxhash64(*[F.get(hashes, i + n)[h] for n in range(width)]).alias(h)
    return F.transform(F.sequence(F.lit(0), F.size(hashes) - width), lambda i: F.struct(*[of(i, h) for h in parts]))


def repeated_positions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """First lines of the windows that occurred before: ``(_id, _t1, _t2, starts)``, one row a document.

    ``starts`` is a set of 0-based line numbers, no longer than the document.
    """
    bare = lambda x: F.trim(x, F.lit(" \n"))
    hashes = F.transform("_lines", lambda x: F.struct(F.xxhash64(bare(x)).alias("a"), F.xxhash64(F.lit(11), bare(x)).alias("b"))).alias("_h")
    once = docs.select(*_key(id_col, text_col), lines_of(F.col(text_col)).alias("_lines")).where(F.size("_lines") >= width)
    once = materialize(once.select("_id", "_t1", "_t2", hashes), "lines")  # texts are taken apart once
    # Half of the hash, counted, rules out most windows; the others are compared by the whole hash.
    counted = once.select(F.explode(_windows(F.col("_h"), width, "a")).alias("_w")).groupBy(F.col("_w.a").alias("_half")).agg(F.count("*").alias("_n"))
    often = materialize(counted.where("_n > 1").select("_half"), "often")
    often = F.broadcast(often) if often.count() <= BROADCAST_KEYS else often.hint("merge")
    windows = once.select("_id", "_t1", "_t2", F.posexplode(_windows(F.col("_h"), width, "a", "b")).alias("_at", "_w")).select("_id", "_t1", "_t2", "_at", F.col("_w.a").alias("_a"), F.col("_w.b").alias("_b"))
    windows = materialize(windows.join(often, F.col("_a") == F.col("_half")).drop("_half"), "windows")
    release(once)
    place = F.struct(F.col("_id").isNotNull().alias("known"), "_id", "_t1", "_t2", "_at")
    first = windows.groupBy("_a", "_b").agg(F.min(place).alias("_first"), F.max(place).alias("_last")).where(F.col("_first") != F.col("_last"))
    first = materialize(first.drop("_last"), "first").hint("merge")  # a table of its own: a hot window's rows can be split
    later = windows.join(first, ["_a", "_b"]).where(place != F.col("_first"))
    return later.groupBy("_id", "_t1", "_t2").agg(F.collect_set("_at").alias("starts"))


def _bind(value: Column, f) -> Column:
    """``f`` of ``value``, which is evaluated once only."""
    return F.element_at(F.transform(F.array(value), f), 1)


def _removed(lines: Column, starts: Column, width: int, min_words: int) -> Column:
    """The line numbers to remove: covered stretches that are long enough. Linear in ``lines``."""
    gap = lambda at, before: F.get(at, before + 1) - F.get(at, before) > width

    def stretches(at: Column) -> Column:
        begins = F.filter(at, lambda s, k: (k == 0) | gap(at, k - 1))
        ends = F.filter(at, lambda s, k: (k == F.size(at) - 1) | gap(at, k))
        return F.zip_with(begins, ends, lambda b, e: F.struct(b.alias("b"), (e + (width - 1)).alias("e")))

    def long(s: Column) -> Column:
        part = F.slice(lines, s["b"] + 1, s["e"] - s["b"] + 1)
        words = F.aggregate(part, F.lit(0), lambda n, x: n + F.regexp_count(x, F.lit(WORD)))
        ended = F.size(F.filter(part, lambda x: x.endswith("\n"))) + (s["e"] == F.size(lines) - 1).cast("int")
        inside = ((s["b"] > 0) & ~F.get(lines, s["b"] - 1).endswith("\n")).cast("int")
        return (words >= min_words) | (ended - inside >= width)

    kept = F.filter(_bind(F.array_sort(starts), stretches), long)
    return F.flatten(F.transform(kept, lambda s: F.sequence(s["b"], s["e"])))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, min_words: int = MIN_WORDS, names: tuple[str, str] = ("n_lines", "removed_lines")) -> DataFrame:
    """``docs`` with repeated passages cut from the text; adds ``n_lines`` and ``removed_lines``.

    Lines (``lines_of``) are compared without blanks and line feeds at their ends. A passage
    of ``width`` or more consecutive lines stays where it occurs first and is removed
    everywhere else, also within one document, if it has ``min_words`` words or ``width``
    whole physical lines. Null and empty texts and texts of fewer than ``width`` lines stay as
    they are (null: ``n_lines`` 0). Rows with equal id and text are one document: they do not
    count as repetitions of each other, and get the same result. A null id sorts first.
    Other columns of any name stay; columns named like the added ones (``names``) are replaced.
    """
    starts = materialize(repeated_positions(docs, id_col, text_col, width), "repeats")
    size = starts.agg(F.coalesce(F.sum(64 + 4 * F.size("starts")), F.lit(0))).first()[0]
    starts = F.broadcast(starts) if size <= BROADCAST_BYTES else starts.hint("merge")
    kept_names = [c for c in docs.columns if c not in names]
    own, k0, k1, k2 = (free(c, docs.columns) for c in ("own", "k0", "k1", "k2"))
    keyed = docs.withColumns(dict(zip((k0, k1, k2), _key(id_col, text_col), strict=True)))
    of = starts.select(F.struct("*").alias(own))
    joined = keyed.join(of, F.col(k0).eqNullSafe(F.col(own)["_id"]) & (F.col(k1) == F.col(own)["_t1"]) & (F.col(k2) == F.col(own)["_t2"]), "left")

    def cut(lines: Column) -> Column:
        gone = _removed(lines, F.col(own)["starts"], width, min_words)

        def left(at: Column) -> Column:
            kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), at), lambda i: F.get(lines, i))
            return F.struct(F.when(F.size(at) > 0, F.array_join(kept, "")).alias("text"), F.size(lines).alias("n"), F.size(at).alias("gone"))

        return _bind(gone, left)

    text, none = F.col(text_col), F.lit(0)
    done = F.when(F.col(own).isNotNull(), _bind(lines_of(text), cut)).otherwise(F.struct(F.lit(None).cast("string").alias("text"), count_lines(text).alias("n"), none.alias("gone")))
    result = joined.withColumn(own, done)
    return result.select(
        *[F.coalesce(F.col(own)["text"], text).alias(c) if c == text_col else F.col(c) for c in kept_names],
        F.when(text.isNull(), 0).otherwise(F.col(own)["n"]).alias(names[0]),
        F.col(own)["gone"].alias(names[1]),
    )


def op9_line_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs)


OP9_SQL = rf"""
WITH split AS (
  SELECT doc_id, text, string_split(regexp_replace(text, '([.!?] |\n)', '\1' || chr(57344), 'g'), chr(57344)) AS l FROM documents),
units AS (SELECT doc_id, len(l) AS n, unnest(range(1, len(l) + 1)) AS pos, unnest(l) AS u FROM split),
windows AS (
  SELECT doc_id, pos, trim(l[pos], ' ' || chr(10)) || chr(57344) || trim(l[pos + 1], ' ' || chr(10)) || chr(57344) || trim(l[pos + 2], ' ' || chr(10)) AS w
  FROM (SELECT doc_id, l, unnest(range(1, len(l) - 1)) AS pos FROM split WHERE len(l) >= 3)),
later AS (SELECT doc_id, pos FROM windows QUALIFY row_number() OVER (PARTITION BY w ORDER BY doc_id NULLS FIRST, pos) > 1),
covered AS (SELECT DISTINCT doc_id, pos + k AS pos FROM later, range(3) r(k)),
islands AS (SELECT doc_id, pos, pos - row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS island FROM covered),
stretches AS (
  SELECT doc_id, island, min(pos) AS b, max(pos) AS e, sum(len(regexp_extract_all(u, '{WORD}'))) AS words, count(*) FILTER (ends_with(u, chr(10)) OR pos = n) AS ended
  FROM islands JOIN units USING (doc_id, pos) GROUP BY doc_id, island),
lengthy AS (
  SELECT s.doc_id, b, e FROM stretches s LEFT JOIN units q ON q.doc_id = s.doc_id AND q.pos = b - 1
  WHERE words >= {MIN_WORDS} OR ended - (CASE WHEN q.u IS NOT NULL AND NOT ends_with(q.u, chr(10)) THEN 1 ELSE 0 END) >= {WIDTH}),
gone AS (SELECT doc_id, unnest(range(b, e + 1)) AS pos FROM lengthy),
cut AS (
  SELECT doc_id, coalesce(string_agg(u, '' ORDER BY pos) FILTER (g IS NULL), '') AS text, count(g) AS gone
  FROM (SELECT u.*, g.pos AS g FROM units u LEFT JOIN gone g ON g.doc_id = u.doc_id AND g.pos = u.pos WHERE u.doc_id IN (SELECT doc_id FROM gone)) GROUP BY doc_id)
SELECT s.doc_id, coalesce(c.text, s.text) AS text, coalesce(len(l), 0)::INTEGER AS n_lines, coalesce(gone, 0)::INTEGER AS removed_lines
FROM split s LEFT JOIN cut c ON c.doc_id = s.doc_id
"""
