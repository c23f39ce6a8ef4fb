"""A fixed-size map of keys, broadcast to spare wide rows a shuffle.

One bit per key hash in MAP_BITS bits (8 MB, whatever the number of keys). A row whose bit is not
set surely has no partner; the others still have to be joined. With far more keys than bits nearly
every row passes, and the join works as it would without the map.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAP_BITS, WORD_BITS, PIECE_WORDS = 1 << 26, 6, 512


def with_membership(df: DataFrame, key: str, wanted: DataFrame, wanted_key: str, out: str) -> DataFrame:
    """Add the boolean ``out`` to ``df``: false only where the long ``key`` is surely not among ``wanted_key``.

    The bits are or-ed into 64-bit words with partial aggregation, so at most MAP_BITS / 64 words are
    shuffled per task, then gathered into pieces of PIECE_WORDS words; the pieces are what is broadcast."""
    slot = F.pmod(F.col(wanted_key), F.lit(MAP_BITS))
    low = (1 << WORD_BITS) - 1
    bit = F.expr(f"shiftleft(1L, int(__slot & {low}))")
    words = (wanted.select(slot.alias("__slot")).select(F.shiftright("__slot", WORD_BITS).alias("__word"), bit.alias("__bit"))
             .groupBy("__word").agg(F.bit_or("__bit").alias("__bits")))
    entry = F.struct((F.col("__word") % PIECE_WORDS).alias("at"), F.col("__bits").alias("bits"))
    held = words.groupBy(F.floor(F.col("__word") / PIECE_WORDS).alias("__piece")).agg(F.map_from_entries(F.collect_list(entry)).alias("__map"))
    pieces = held.select("__piece", F.transform(F.sequence(F.lit(0), F.lit(PIECE_WORDS - 1)), lambda i: F.coalesce(F.try_element_at("__map", i.cast("long")), F.lit(0))).alias("__words"))
    own = df.withColumn("__slot", F.pmod(F.col(key), F.lit(MAP_BITS)))
    piece = F.floor(F.col("__slot") / (PIECE_WORDS << WORD_BITS))
    word = F.element_at("__words", (F.shiftright("__slot", WORD_BITS) % PIECE_WORDS + 1).cast("int"))
    found = own.join(F.broadcast(pieces), piece == F.col("__piece"), "left")
    return found.withColumn(out, F.coalesce(F.getbit(word, F.expr(f"int(__slot & {low})")) == 1, F.lit(False))).drop("__slot", "__piece", "__words")
