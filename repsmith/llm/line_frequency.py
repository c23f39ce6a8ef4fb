"""Quality rules on whole texts and on lines repeated across a host's documents.

DataFrame functions only. Per text: word, symbol, repeated-line and repeated-window counts. A
line is normalised (trimmed, lower case, runs of white space as one space) and hashed; a
host's line is above the limit where more than ``MIN_DOCS`` of its documents and more than
``MAX_SHARE`` of them hold it. Such lines are removed, and a document that keeps less than
``KEEP_SHARE`` of its words, or fewer than ``MIN_WORDS``, is rejected.

Texts are read once; what is shuffled is one hash per distinct line of a document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repsmith.llm._common import persisted

MIN_DOCS, MAX_SHARE, KEEP_SHARE, MIN_WORDS = 20, 0.01, 0.5, 20
REPEAT_WINDOW, MAX_REPEAT_PERCENT = 8, 30
#: Fixed by the contract: white space, and the characters counted as symbols.
SPACE, SYMBOLS = r"[\x20\x09-\x0D]", "#*$%&|<>"


def words(text: Column) -> Column:
    """Runs without ASCII white space."""
    return F.array_remove(F.split(F.translate(text, "\t\n\x0b\x0c\r", "     "), " "), "")


def text_counts(docs: DataFrame) -> DataFrame:
    """Adds the contract's counts and ``_lines``: (hash, words) of each line with a word; needs ``_text``."""
    n = F.size("_words")
    df = docs.withColumn("_words", words(F.col("_text")))
    df = (df.withColumn("n_words", n.cast("long"))
          .withColumn("word_chars", (F.length("_text") - F.length(F.regexp_replace("_text", f"[^{SPACE[1:-1]}]+", ""))).cast("long"))
          .withColumn("n_symbols", F.length(F.regexp_replace("_text", r"[^#*$%&|<>]+", "")).cast("long"))
          .withColumn("_split", F.filter(F.split("_text", "\n"), lambda x: F.length(F.translate(x, " \t\x0b\x0c\r", "")) > 0)))
    df = df.withColumn("_hashes", F.transform("_words", lambda x: F.xxhash64(x))).drop("_words")
    df = df.withColumn("n_dup_lines", (F.size("_split") - F.size(F.array_distinct("_split"))).cast("long"))
    normal = lambda x: F.lower(F.array_join(words(x), " "))
    df = df.withColumn("_lines", F.transform("_split", lambda x: F.struct(F.xxhash64(normal(x)).alias("h"), F.size(words(x)).alias("w")))).drop("_split", "_text")
    windows = F.when(F.size("_hashes") < REPEAT_WINDOW, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("_hashes") - REPEAT_WINDOW + 1)), lambda i: F.xxhash64(F.slice("_hashes", i, REPEAT_WINDOW))))
    df = df.withColumn("_windows", windows).drop("_hashes")
    df = df.withColumn("_sorted", F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"),
                                         F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))).drop("_windows")
    # Windows sorted by hash and position: those with an equal neighbour occur twice or more, and
    # consecutive ones cover the lesser of the window and their distance.
    equal = lambda x, k: F.coalesce(F.get("_sorted", k)["h"] == x["h"], F.lit(False))
    df = df.withColumn("_twins", F.sort_array(F.transform(F.filter("_sorted", lambda x, k: equal(x, k - 1) | equal(x, k + 1)), lambda x: x["i"]))).drop("_sorted")
    cover = F.transform("_twins", lambda p, k: F.least(F.lit(REPEAT_WINDOW), F.coalesce(F.get("_twins", k + 1) - p, F.lit(REPEAT_WINDOW))))
    return df.withColumn("n_repeat_words", F.coalesce(F.aggregate(cover, F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0)).cast("long")).drop("_twins")


def line_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """One row per input row: doc_id, the counts, base_failed, n_removed_words, removed_lines, kept.

    ``removed_lines`` are the numbers, from 0, of the removed ones among the lines with a word.
    Null text: no word, base_failed. Null hosts are one host. Rows that repeat a doc_id count once
    for a line but are judged each. Columns besides the three are ignored; empty in, empty out."""
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(host_col).cast("string").alias("host"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    base = persisted(text_counts(plain).withColumn("_row", F.monotonically_increasing_id()), "counts")
    held = base.select("host", F.col("doc_id").alias("doc"), F.explode(F.array_distinct(F.col("_lines.h"))).alias("h"))
    sizes = base.groupBy("host", "doc_id").agg(F.lit(1)).groupBy("host").agg(F.count(F.lit(1)).alias("docs"))  # one row per host
    often = held.groupBy("host", "h", "doc").agg(F.lit(1)).groupBy("host", "h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > MIN_DOCS)
    same = lambda a, b: a["host"].eqNullSafe(b["host"])
    above = often.join(sizes, same(often, sizes)).where(F.col("n") > F.col("docs") * MAX_SHARE).select(often["host"].alias("_host"), F.col("h").alias("_h"))
    above = persisted(above, "above")
    lines = base.select("_row", "host", F.posexplode("_lines").alias("i", "line"))
    hit = lines.join(above, lines["host"].eqNullSafe(above["_host"]) & (F.col("line.h") == F.col("_h"))).groupBy("_row").agg(
        F.sum("line.w").alias("_removed"), F.sort_array(F.collect_list("i")).alias("_which"))  # at most a document's own lines
    out = base.drop("_lines").join(hit, "_row", "left")
    removed = F.coalesce("_removed", F.lit(0)).cast("long")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    left = F.col("n_words") - removed
    depleted = (left < MIN_WORDS) | (left < KEEP_SHARE * F.col("n_words"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & ~depleted).alias("kept"),
                      removed.alias("n_removed_words"), F.coalesce("_which", F.array().cast("array<int>")).alias("removed_lines"))


def without_lines(text: Column, removed: Column) -> Column:
    """A text without its removed lines (as numbered by ``line_quality``) and without wordless lines."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, " \t\x0b\x0c\r", "")) > 0)
    return F.array_join(F.filter(lines, lambda x, i: ~F.array_contains(removed, i)), "\n")
