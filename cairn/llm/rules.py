"""Quality rules with cross-document line frequency, in DataFrame functions only.

Lines are normalised (white space runs to one space, ends trimmed, lower case, digits to 0) and hashed.  The distinct
documents (texts) that hold a line are counted per host, here the source: copies of one text are one document.  A line
in more than ``max(min_documents, max_share x documents of the host)`` of them, and anyhow one in more than
``max_documents``, is removed, so that a host's size does not excuse repetition.  A document of which less than
``min_left`` of its words, or under ``min_words`` of them, is left is rejected as depleted.

Defined results: null, empty and word-less texts have no words, fail the base rule and are rejected; null hosts form one
host; repeated rows get a row each and count as one document; null and repeated ids are fine; extra columns are ignored;
an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.llm.common import SPACE, WORD
from cairn.operators.prefix import durable

SYMBOL = r"[#*$%&|<>]"
NOT_SPACE = r"[^\x20\x09-\x0D]"


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda x: x.rlike(NOT_SPACE))


def normal_line(line: Column) -> Column:
    flat = F.trim(F.regexp_replace(line, SPACE + "+", " "))
    return F.regexp_replace(F.lower(flat), "[0-9]", "0")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once for the row (a lambda variable is, a column in a lambda is not)."""
    return F.transform(F.array(value), body)[0]


def repeated_words(word_hashes: Column, window: int) -> Column:
    """Words covered by windows of ``window`` words that occur twice or more, from the hashes of a text's words."""
    count = F.size(word_hashes) - (window - 1)

    def covered(h: Column) -> Column:
        # windows sorted by (hash, place): a repeated one has a neighbour with its hash
        ranked = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def places(s: Column) -> Column:
            same = lambda x, k: F.coalesce(F.get(s, k)["h"] == x["h"], F.lit(False))
            hit = F.transform(s, lambda x, k: F.when(same(x, k - 1) | same(x, k + 1), x["i"]))
            return F.sort_array(F.filter(hit, lambda x: x.isNotNull()))

        step = F.struct(F.lit(0).alias("n"), F.lit(-window).alias("last"))
        return let(let(ranked, places), lambda p: F.aggregate(
            p, step, lambda acc, x: F.struct((acc["n"] + F.least(x - acc["last"], F.lit(window))).alias("n"),
                                             x.alias("last")), lambda acc: acc["n"]))

    def counted(w: Column) -> Column:
        windows = F.transform(F.sequence(F.lit(1), count), lambda i: F.xxhash64(F.slice(w, i, window)))
        return let(windows, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(F.lit(0)))

    return F.when(count < 2, F.lit(0)).otherwise(let(word_hashes, counted)).cast("long")


def judge(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
          window: int = 8, min_words: int = 20, max_repeat_percent: int = 30, min_documents: int = 5,
          max_share: float = 0.02, max_documents: int = 100, min_left: float = 0.5, with_text: bool = False) -> DataFrame:
    """One row per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    words_removed, kept (and the text without its removed lines).

    The text is read once; lines travel as two hashes.  A line of a third of all documents is counted by partial
    aggregates, and met again by an equi-join that AQE splits or broadcasts by its measured size.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    read = docs.select(
        F.col(id_col).alias("doc_id"), F.xxhash64(host_col).alias("host"), F.xxhash64(text).alias("doc"),
        F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("words"), lines_with_words(text).alias("lines"),
        F.regexp_count(text, F.lit(SYMBOL)).cast("long").alias("n_symbols"), text.alias("text"))
    line = lambda x: F.struct(F.xxhash64("host", normal_line(x)).alias("key"),
                              F.regexp_count(x, F.lit(WORD)).alias("words"))
    base = read.select(
        "doc_id", "host", "doc", F.size("words").cast("long").alias("n_words"),
        F.char_length(F.concat_ws("", "words")).cast("long").alias("word_chars"), "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.transform("words", lambda w: F.xxhash64(w)), window).alias("n_repeat_words"),
        F.transform("lines", line).alias("lines"), *(["text"] if with_text else []))
    base = durable(base.withColumn("rid", F.monotonically_increasing_id()))

    lines = base.select("host", "doc", F.explode(F.array_distinct(F.transform("lines", lambda x: x["key"]))).alias("key"))
    seen = lines.distinct().groupBy("key").agg(F.first("host").alias("host"), F.count(F.lit(1)).alias("documents"))
    hosts = base.select("host", "doc").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("all"))
    frequent = durable(seen.where(F.col("documents") > min_documents).join(hosts, "host")
                       .where(F.col("documents") > F.least(F.col("all") * F.lit(float(max_share)), F.lit(float(max_documents))))
                       .select("key"))
    met = base.select("rid", F.explode("lines").alias("x")).select("rid", "x.key", "x.words").join(frequent, "key")
    removed = met.groupBy("rid").agg(F.sum("words").alias("words_removed"), F.collect_set("key").alias("bad"))
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    left = F.col("n_words") - F.col("words_removed")
    out = (base.join(removed, "rid", "left").withColumn("words_removed", F.coalesce("words_removed", F.lit(0)).cast("long"))
           .withColumn("base_failed", failed)
           .withColumn("kept", ~failed & (left >= min_words) & (left >= F.col("n_words") * F.lit(float(min_left)))))
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
               "words_removed", "kept"]
    if with_text:
        keep = F.filter(F.split("text", "\n"), lambda x: ~F.array_contains("bad", F.xxhash64("host", normal_line(x))))
        out = out.withColumn("text", F.when(F.col("bad").isNull(), F.col("text")).otherwise(F.array_join(keep, "\n")))
        columns.append("text")
    return out.select(*columns)
