"""Line dedup by a deletion-neighbourhood join over words, in built-in functions only.

A line is its lower-cased words. Lines of equal words are copies. Two different lines are near
if one word is replaced, added or dropped: they then share a variant, the line without one word
(and the same place, if a word is replaced). Variants are hashed from running exclusive-ors of
the words' hashes, so a line of n words costs n rows and not n * n words.

Before variants are made, lines that cannot have a near one are left out: of two lines that
differ in one word, the first or the last half is equal, so a line none of whose halves is
seen in another line has no partner.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablepull.functions.names import qcol
from tablepull.llm.tables import broadcast_below, drop_stored, stored

# Lines of fewer words are never removed.
MIN_WORDS = 3
# Lines of at least so many words are also removed if they differ by one word from an earlier one.
NEAR_WORDS = 8
# Bytes of a line's place in a table that is copied to all executors, at most.
PLACE_BYTES = 64
_BLANK = "[\\x20\\x09-\\x0D]+"
_AT = ["l_doc", "l_text", "l_no"]


def _words(line: Column) -> Column:
    return F.split(F.btrim(F.lower(line), F.lit(" \t\n\x0b\f\r")), _BLANK)


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = qcol(text_col)
    rows = docs.select(qcol(id_col).alias("l_doc"), F.xxhash64(text).alias("l_text"), F.posexplode(F.split(text, "\n")).alias("l_no", "l_line"))
    return rows


def _split_lines(lines: DataFrame, *columns: str) -> DataFrame:
    """``columns`` of the lines, their words and the number of words."""
    # As a generator's output the words are cut once; a filter on a plain column would cut them again.
    rows = lines.select(*columns, F.inline(F.array(F.struct(_words(F.col("l_line")).alias("w")))))
    return rows.withColumn("n", F.when(F.col("w")[0] == "", 0).otherwise(F.size("w")))


def _halves(words: Column, n: Column) -> Column:
    """Hashes of the first and last halves, of half the words and of half the words but one.

    A line of n and one of n + 1 words have halves of one common size.
    """
    sizes = [F.expr("int(n div 2)"), F.expr("int((n - 1) div 2)")]
    first = [F.xxhash64(F.lit("first"), F.slice(words, 1, k)) for k in sizes]
    last = [F.xxhash64(F.lit("last"), F.slice(words, n - k + 1, k)) for k in sizes]
    return F.array_distinct(F.array(*first, *last))


def _variants(words: DataFrame) -> DataFrame:
    """(key, r, role) of all variants: 's' for a replaced word, 'd' for the line without a word, 'f' for the whole line."""
    each = words.select("r", "n", F.posexplode("w").alias("i", "word"))
    each = each.select("r", "n", "i", F.xxhash64("word", "i").alias("here"), F.xxhash64("word", F.col("i") - 1).alias("moved"))
    # One sort for each line: what stands before a word keeps its place, what follows moves up.
    each = each.select(
        "r", "n", "i",
        F.expr("coalesce(bit_xor(here) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0L)").alias("before"),
        F.expr("bit_xor(moved) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)").alias("gone"),
        "here", "moved",
    )
    whole = each.groupBy("r").agg(F.bit_xor("here").alias("all_here"), F.bit_xor("moved").alias("all_moved"), F.first("n").alias("n"))
    without = each.join(whole.select("r", "all_moved"), "r")
    rest = without.select("r", "n", "i", F.expr("before ^ gone ^ all_moved").alias("v"))
    pairs = rest.select(
        "r", F.explode(F.array(
            F.struct(F.xxhash64(F.lit("s"), "n", "i", "v").alias("key"), F.lit("s").alias("role")),
            F.struct(F.xxhash64(F.lit("d"), F.col("n") - 1, "v").alias("key"), F.lit("d").alias("role")),
        )).alias("x"),
    ).select("r", "x.key", "x.role")
    full = whole.select("r", F.xxhash64(F.lit("d"), "n", "all_here").alias("key"), F.lit("f").alias("role"))
    return pairs.unionByName(full)


def _within_one(a: Column, b: Column) -> Column:
    """Two arrays of words differ in one replaced word, or one has one word more."""
    long, short = F.when(F.size(a) >= F.size(b), a).otherwise(b), F.when(F.size(a) >= F.size(b), b).otherwise(a)
    differ = F.size(F.filter(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), lambda same: ~same))
    # Words that agree from the start: up to the first difference.
    same = F.array_position(F.zip_with(long, short, lambda x, y: x.eqNullSafe(y)), False).cast("int") - 1
    dropped = F.slice(long, same + 2, F.greatest(F.size(long) - same - 1, F.lit(0))) == F.slice(short, same + 1, F.greatest(F.size(short) - same, F.lit(0)))
    return F.when(F.size(a) == F.size(b), differ <= 1).when(F.size(long) == F.size(short) + 1, dropped).otherwise(F.lit(False))


def _near(lines: DataFrame, distinct: DataFrame) -> DataFrame:
    """First places ``p`` of lines that have an earlier line within one word."""
    able = distinct.where(F.col("n") >= NEAR_WORDS)
    keys = able.select("p", F.explode("halves").alias("half"))
    shared = keys.groupBy("half").agg(F.count(F.lit(1)).alias("lines")).where("lines > 1").select("half")
    kept = stored(keys.join(shared, "half").select("p").distinct(), "lines")
    # Lines are cut into words only now: few of them are left, or they are shuffled as text.
    left = lines.select(F.struct(*_AT).alias("p"), "l_line").join(broadcast_below(kept, kept.count(), PLACE_BYTES), "p", "left_semi")
    left = stored(left.dropDuplicates(["p"]), "lines")
    # A number in the order of places stands for a line from here on.
    words = stored(_split_lines(left.orderBy("p"), "p", "l_line").drop("l_line").withColumn("r", F.monotonically_increasing_id()), "words")
    variants = stored(_variants(words), "variants")
    # The earliest member of a bucket stands for it. Replaced words: any member; otherwise the
    # whole line for those without a word, and the earliest of these for the whole line.
    buckets = variants.groupBy("key").agg(
        F.min(F.when(F.col("role") == "s", F.col("r"))).alias("s"), F.min(F.when(F.col("role") == "d", F.col("r"))).alias("d"),
        F.min(F.when(F.col("role") == "f", F.col("r"))).alias("f"), F.count(F.lit(1)).alias("members"),
    ).where("members > 1")
    other = F.when(F.col("role") == "s", F.col("s")).when(F.col("role") == "d", F.col("f")).otherwise(F.col("d"))
    pairs = variants.join(buckets, "key").select("r", other.alias("q")).where("q < r").distinct()
    checked = pairs.join(words.select("r", "p", F.col("w").alias("a")), "r").join(words.select(F.col("r").alias("q"), F.col("w").alias("b")), "q")
    near = stored(checked.where(_within_one(F.col("a"), F.col("b"))).select("p").distinct(), "near")
    drop_stored(kept, left, words, variants)
    return near


def removed_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(l_doc, l_text, l_no) of the lines to remove: id, hash of the text, number of the line from 0; see ``dedup_lines``."""
    lines = _lines(docs, id_col, text_col)
    long = _split_lines(lines, *_AT, "l_line").where(F.col("n") >= MIN_WORDS)
    halves = F.when(F.col("n") >= NEAR_WORDS, _halves(F.col("w"), F.col("n")))
    facts = long.select(*_AT, "n", F.xxhash64("w").alias("h"), F.xxhash64(F.lit(1), "w").alias("g"), halves.alias("halves"))
    facts = stored(facts, "facts")
    distinct = facts.groupBy("h", "g").agg(F.min(F.struct(*_AT)).alias("p"), F.first("n").alias("n"), F.first("halves").alias("halves"))
    distinct = stored(distinct, "distinct")
    near = _near(lines, distinct)
    firsts = distinct.select("h", "g", "p").join(near.withColumn("near", F.lit(True)), "p", "left")
    judged = facts.select(*_AT, "h", "g").join(firsts, ["h", "g"])
    gone = stored(judged.where(F.col("near") | (F.struct(*_AT) != F.col("p"))).select(*_AT).distinct(), "gone")
    drop_stored(facts, distinct, near)
    return gone


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counts: tuple[str, str] | None = None) -> DataFrame:
    """``docs`` without the lines that repeat an earlier one, the remaining ones joined by line breaks.

    Lines end at ``\\n``; places are ordered by id (null first), then by hash of the text, then
    by line. A line of at least ``MIN_WORDS`` words goes if an earlier line, of any document, has
    the same words, or, from ``NEAR_WORDS`` words in both, differs by one replaced, added or
    dropped word. All lines are judged on the input, not on what is left. Words lie between
    ASCII white space and are compared in lower case.

    All rows stay, with all columns: null texts stay null, a text can become empty, rows that are
    equal in id and text are one document and lose the same lines. ``counts`` names two more columns: the
    number of lines and of removed lines. An empty table gives an empty result.
    """
    gone = removed_lines(docs, id_col, text_col).groupBy("l_doc", "l_text").agg(F.collect_set("l_no").alias("l_gone"))
    # The other columns travel as one struct, so that none can clash with those added here.
    rest = F.struct(F.lit(0).alias("l_rest"), *[qcol(c) for c in docs.columns if c != text_col])
    rows = docs.select(rest.alias("row"), qcol(id_col).alias("l_id"), qcol(text_col).alias("l_old"))
    rows = rows.join(gone, (F.xxhash64("l_old") == F.col("l_text")) & F.col("l_id").eqNullSafe(F.col("l_doc")), "left")
    rows = rows.select("row", "l_old", "l_gone", F.split("l_old", "\n").alias("l_parts"))
    left = F.array_except(F.sequence(F.lit(0), F.size("l_parts") - 1), F.col("l_gone"))
    kept = F.array_join(F.transform(left, lambda at: F.get("l_parts", at)), "\n")
    new = F.when(F.col("l_gone").isNull(), F.col("l_old")).otherwise(kept)
    columns = [new.alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns]
    if counts:
        columns.append(F.greatest(F.size("l_parts"), F.lit(0)).cast("long").alias(counts[0]))
        columns.append(F.greatest(F.coalesce(F.size("l_gone"), F.lit(0)), F.lit(0)).cast("long").alias(counts[1]))
    return rows.select(*columns)
