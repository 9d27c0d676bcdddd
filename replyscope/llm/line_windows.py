"""Line dedup: passages of three consecutive lines that stand somewhere earlier are removed."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from replyscope.llm.chunks import keep_in_buckets
from replyscope.llm.common import keep

LINES = 3
#: Rows of a block: 2**BLOCK_BITS. A block's rows lie in one bucket.
BLOCK_BITS = 10


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def rows_in_blocks(docs: DataFrame) -> DataFrame:
    """The documents, kept in buckets of blocks: _block, _row, _id, _text (the text's hash) and the columns as c0, c1, ..., so that no name
    of the input can clash."""
    columns = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)]
    row = F.monotonically_increasing_id()
    keyed = docs.select(
        *columns, F.col("doc_id").cast("long").alias("_id"), F.xxhash64("text").alias("_text"), row.alias("_row")
    ).withColumn("_block", F.shiftright("_row", BLOCK_BITS))
    return keep_in_buckets(keyed, "_block", "line_rows")


def windows(rows: DataFrame, text: str) -> DataFrame:
    """One row for each three consecutive lines with a word: _block, _row, _id, _text, first and last line, 128-bit digest."""
    plain = lambda x: F.trim(F.translate(x, "\t\r\x0b\x0c", "    "))
    spoken = F.filter(
        F.transform(_lines(F.col(text)), lambda x, i: F.struct(i.cast("long").alias("at"), plain(x).alias("line"))),
        lambda x: x["line"] != "",
    )
    listed = rows.where(F.col(text).isNotNull()).select(*KEYS, spoken.alias("_lines"))
    digest = lambda i: F.unhex(F.md5(F.concat_ws(
        "\n", *[F.col("_lines")[i + k]["line"] for k in range(LINES)]
    )))
    each = F.transform(
        F.sequence(F.lit(0), F.size("_lines") - LINES),
        lambda i: F.struct(
            F.col("_lines")[i]["at"].alias("first"), F.col("_lines")[i + (LINES - 1)]["at"].alias("last"),
            digest(i).alias("digest"),
        ),
    )
    return (
        listed.where(F.size("_lines") >= LINES).select(*KEYS, F.explode(each).alias("w"))
        .select(*KEYS, "w.first", "w.last", "w.digest")
    )


KEYS = ["_block", "_row", "_id", "_text"]


def covered_runs(rows: DataFrame, text: str) -> DataFrame:
    """Line ranges to remove, merged: _block, _row, runs (array of first, last; in order), n_removed lines.

    A window's first place (least id, then text hash, row and line) stays; all its other places go.
    """
    found = keep(windows(rows, text), "windows")
    place = F.struct("_id", "_text", "_row", "first")
    first = keep(
        found.groupBy("digest").agg(F.count("*").alias("n"), F.min(place).alias("home")).where("n > 1")
        .select("digest", "home"),
        "repeated",
    )
    later = found.join(first, "digest").where(~place.eqNullSafe(F.col("home"))).select("_block", "_row", "first", "last")
    in_text = Window.partitionBy("_block", "_row").orderBy("first", "last")
    reached = F.max("last").over(in_text.rowsBetween(Window.unboundedPreceding, -1))
    starts = later.distinct().withColumn("new", F.when(F.col("first") <= reached, 0).otherwise(1))
    runs = (
        starts.withColumn("run", F.sum("new").over(in_text.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("_block", "_row", "run").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    )
    return runs.groupBy("_block", "_row").agg(
        F.sort_array(F.collect_list(F.struct("first", "last"))).alias("runs"),
        F.sum(F.col("last") - F.col("first") + 1).cast("long").alias("n_removed"),
    )


def drop_repeated_windows(docs: DataFrame, report: bool = False) -> DataFrame:
    """Documents with later copies of three-line passages removed.

    Every three consecutive lines with a word (white space at line ends does not count, blank lines
    between them are skipped) form a window. The first place of a window over all documents stays, in
    order of doc_id and line; the lines of its other places are removed, overlapping places merged, blank
    lines between them included. Rows, order of lines and columns stay; n_chars, if present, is counted
    anew. A text that repeats wholly becomes empty. Null texts, empty texts and texts of fewer than three
    lines with a word stay as they are, whatever the length of their lines (see the README). Rows of one id are separate documents in
    the order of their texts' hashes, equal ones as they are stored: of a repeated row one keeps its lines. Null ids come
    first. ``report`` adds n_lines and n_removed, replacing columns of those names.

    Texts are written once, in buckets of blocks of rows; what is to be removed is sent to the blocks, and no text is
    shuffled, whatever the sizes.
    """
    names = list(docs.columns)
    text = f"c{names.index('text')}"
    rows = rows_in_blocks(docs)
    runs = keep(covered_runs(rows, text), "runs").select(
        F.col("_block").alias("_b"), F.col("_row").alias("_r"), "runs", F.col("n_removed").alias("_gone")
    )
    cut = F.col("runs")
    before = lambda k: F.when(k == 0, F.lit(0).cast("long")).otherwise(cut[k - 1]["last"] + 1)
    until = lambda k: F.when(k == F.size(cut), F.size("_all").cast("long")).otherwise(cut[k]["first"])
    left = F.flatten(F.transform(
        F.sequence(F.lit(0), F.size(cut)),
        lambda k: F.slice("_all", (before(k) + 1).cast("int"), (until(k) - before(k)).cast("int")),
    ))
    # the difference keeps the row out of the join's keys, which would no longer be those of the buckets
    joined = rows.join(
        runs.hint("shuffle_hash"), (F.col("_block") == F.col("_b")) & (F.col("_row") - F.col("_r") == 0), "left"
    ).withColumn("_all", _lines(F.col(text)))
    done = F.when(cut.isNull(), F.col(text)).otherwise(F.array_join(left, "\n"))
    out = []
    for i, c in enumerate(names):
        if report and c in ("n_lines", "n_removed"):
            continue
        if c == "text":
            out.append(done.alias("text"))
        elif c == "n_chars":
            out.append(F.when(cut.isNull(), F.col(f"c{i}")).otherwise(F.length(done)).cast(docs.schema[c].dataType).alias(c))
        else:
            out.append(F.col(f"c{i}").alias(c))
    if report:
        out += [
            F.coalesce(F.size("_all"), F.lit(0)).cast("long").alias("n_lines"),
            F.coalesce(F.col("_gone"), F.lit(0)).cast("long").alias("n_removed"),
        ]
    return joined.select(*out)


#: The same rows in DuckDB SQL, for documents with distinct ids.
SQL = """
WITH lines AS (
  SELECT doc_id, u.i - 1 AS pos, trim(translate(u.x, chr(9) || chr(13) || chr(11) || chr(12), '    ')) AS line
  FROM documents, unnest(string_split(text, chr(10))) WITH ORDINALITY AS u(x, i)),
spoken AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS k FROM lines WHERE line <> ''),
win AS (
  SELECT doc_id, pos AS first, lead(pos, 2) OVER w AS last,
    line || chr(10) || lead(line, 1) OVER w || chr(10) || lead(line, 2) OVER w AS body
  FROM spoken WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY body ORDER BY doc_id, first) AS place FROM win WHERE body IS NOT NULL),
gone AS (
  SELECT DISTINCT l.doc_id, l.pos FROM
    (SELECT doc_id, unnest(range(first, last + 1)) AS pos FROM placed WHERE place > 1) l),
raw AS (
  SELECT doc_id, u.i - 1 AS pos, u.x AS line FROM documents, unnest(string_split(text, chr(10))) WITH ORDINALITY AS u(x, i)),
done AS (
  SELECT r.doc_id, count(*) AS n_lines, count(g.pos) AS n_removed,
    coalesce(string_agg(r.line, chr(10) ORDER BY r.pos) FILTER (WHERE g.pos IS NULL), '') AS text
  FROM raw r LEFT JOIN gone g ON r.doc_id = g.doc_id AND r.pos = g.pos GROUP BY r.doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
  CASE WHEN d.text IS NULL THEN NULL ELSE done.text END AS text
FROM documents d LEFT JOIN done ON d.doc_id = done.doc_id
"""
