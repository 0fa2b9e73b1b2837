"""Removal of lines that several documents share.

Texts are split into lines and exploded with their positions. A line's key is the line without white space
at its ends and with A-Z in lower case, as a hash of 128 bits. Keys are counted per document first and then
over documents, so that a line on a third of all documents is spread over many tasks until only one partial
count per task is left. The lines of shared keys go, except in one document of each key, and the lines left
are put together again by their positions.

To find them, all lines meet the shared keys once more. The HOT_KEYS keys with the most lines are broadcast, a
list of fixed length; their lines are judged where they lie and spread over the join. Any other key has less
than one line in HOT_KEYS. What reaches a document is a list of positions, never the text of a line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import stored, without

MIN_CHARS = 20
MIN_DOCUMENTS = 3
HOT_KEYS = 1_000
#: Keys with fewer lines than this cannot burden a task and are no candidates for the broadcast.
HOT_LINES = 1_000

# White space that is stripped, and the letters that are lower-cased.
WHITE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

ADDED = ("n_lines", "n_dropped", "kept_text")


def lines_of(text: Column) -> Column:
    """Lines of a text; a null or empty one has one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def key_of(line: Column) -> Column:
    bare = F.btrim(line, F.lit(WHITE))
    ascii_only = F.octet_length(bare) == F.char_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, UPPER, UPPER.lower()))


def wide_hash(*columns: Column) -> list[Column]:
    """A hash of 128 bits as two numbers; nulls are skipped."""
    return [F.xxhash64(*columns), F.xxhash64(F.lit(1), *columns)]


def keyed_lines(rows: DataFrame, min_chars: int) -> DataFrame:
    """(id, r1, r2, pos, h1, h2): each line with a key of at least `min_chars` code points."""
    lines = rows.select("id", "r1", "r2", F.posexplode(lines_of(F.col("text"))).alias("pos", "line"))
    keys = lines.withColumn("key", key_of(F.col("line"))).filter(F.char_length("key") >= min_chars)
    h1, h2 = wide_hash(F.col("key"))
    return keys.select("id", "r1", "r2", "pos", h1.alias("h1"), h2.alias("h2"))


def shared_keys(lines: DataFrame, min_documents: int) -> DataFrame:
    """(h1, h2, documents, keeper, n): keys on enough documents or many lines, and the largest id that has each."""
    each = lines.groupBy("h1", "h2", "id").agg(F.count("*").alias("n"))
    counted = each.groupBy("h1", "h2").agg(F.count("*").alias("documents"), F.max("id").alias("keeper"), F.sum("n").alias("n"))
    return counted.filter((F.col("documents") >= min_documents) | (F.col("n") >= HOT_LINES))


def dropped_lines(lines: DataFrame, keys: DataFrame, min_documents: int) -> DataFrame:
    """(r1, r2, gone): of each row that loses lines, their positions in order."""
    keys = keys.withColumn("shared", F.col("documents") >= min_documents).select("h1", "h2", "shared", "keeper", "n")
    hot = keys.filter(F.col("n") >= HOT_LINES).orderBy(F.desc("n"), "h1", "h2").limit(HOT_KEYS)
    hot = hot.select("h1", "h2", F.col("shared").alias("hot_shared"), F.col("keeper").alias("hot_keeper"))
    lost = ~F.col("id").eqNullSafe(F.col("hot_keeper")) & F.col("hot_shared")
    judged = lines.join(F.broadcast(hot), ["h1", "h2"], "left").filter(F.col("hot_shared").isNull() | lost)
    # Lines that are judged already go to any task, as they look for nothing there.
    spread = F.when(F.col("hot_shared").isNull(), F.col("h1")).otherwise(F.xxhash64("r1", "pos"))
    judged = judged.withColumn("h1", spread)
    rest = keys.filter("shared").select("h1", "h2", "keeper", F.lit(True).alias("found"))
    kept_by = ~F.col("id").eqNullSafe(F.col("keeper"))
    gone = judged.join(rest, ["h1", "h2"], "left").filter(F.col("hot_shared").isNotNull() | (F.col("found") & kept_by))
    return gone.groupBy("r1", "r2").agg(F.array_sort(F.collect_set("pos")).alias("gone"))


def put_together(lines: Column, gone: Column) -> Column:
    """Lines at the other positions, in order, joined by line ends: the runs between dropped ones, one after another."""
    ends = F.concat(F.array(F.lit(-1)), gone, F.array(F.size(lines)))
    runs = F.transform(
        F.sequence(F.lit(1), F.size(gone) + 1),
        lambda i: F.slice(lines, F.get(ends, i - 1) + 2, F.get(ends, i) - F.get(ends, i - 1) - 1),
    )
    return F.array_join(F.flatten(runs), "\n")


def drop_shared_lines(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    min_chars: int = MIN_CHARS,
    min_documents: int = MIN_DOCUMENTS,
) -> DataFrame:
    """The table with n_lines (before), n_dropped and kept_text; columns with these names are replaced.

    A line whose key has at least `min_chars` code points and is found in at least `min_documents` documents
    stays only in the document with the largest id that has it, there as often as it occurs. Shorter lines
    stay. A null or empty text has one empty line. Rows with one id are one document, however often they
    are repeated, and so are rows without id, which come before all others. A text that loses all its
    lines is empty.
    """
    internal = ("__r1", "__r2", "__gone")
    base = without(docs, [*ADDED, *internal])
    key, text = F.col(f"`{id_column}`"), F.col(f"`{text_column}`")
    # Rows equal in id and text lose the same lines; a null id or text takes a place of its own.
    r1, r2 = wide_hash(key.isNull(), key, text.isNull(), text)
    lines = keyed_lines(base.select(key.alias("id"), r1.alias("r1"), r2.alias("r2"), text.alias("text")), min_chars)
    keys = stored(shared_keys(lines, min_documents), "shared-lines")
    gone = dropped_lines(lines, keys, min_documents).select(*[F.col(c).alias(f"__{c}") for c in ("r1", "r2", "gone")])
    joined = base.withColumns({"__r1": r1, "__r2": r2}).join(gone, ["__r1", "__r2"], "left")
    own, some = lines_of(text), F.col("__gone")
    return joined.select(
        *[F.col(f"`{c}`") for c in base.columns],
        F.size(own).cast("long").alias("n_lines"),
        F.coalesce(F.size(some), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(some.isNull(), F.coalesce(text, F.lit(""))).otherwise(put_together(own, some)).alias("kept_text"),
    )
